"""Distinct counts and quantiles that can be continued: small sketches per column, stored and united.

A sketch of new rows is made without reading old ones and united with those stored before. Each holds a
bounded number of bytes however many rows it has seen, so tables of sketches are one row per column and run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart.functions.parsing import without_nan
from tidecart.operators.outliers import numeric_columns

DISTINCT_LOG_K = 12   # 2 ** 12 registers: a standard error of about 1.6 %
QUANTILE_K = 400      # a rank error of about 0.7 %


def _wide(df: DataFrame, columns: list[str], of) -> DataFrame:
    """(column, sketch) from one aggregate over all columns."""
    row = without_nan(df).agg(*[of(F.col(f"`{c}`")).alias(f"__{i}") for i, c in enumerate(columns)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("sketch")) for i, c in enumerate(columns)])))


def distinct_sketches(df: DataFrame, columns: list[str] | None = None, log_k: int = DISTINCT_LOG_K) -> DataFrame:
    """(column, sketch) of the different non-null values, as texts, of each column."""
    return _wide(df, columns or df.columns, lambda c: F.hll_sketch_agg(c.cast("string"), F.lit(log_k)))


def quantile_sketches(df: DataFrame, columns: list[str] | None = None, k: int = QUANTILE_K) -> DataFrame:
    """(column, sketch) of the values of each numeric column; nulls and NaN are left out."""
    return _wide(df, columns or numeric_columns(df), lambda c: F.kll_sketch_agg_double(c.cast("double"), F.lit(k)))


def _united(tables: tuple[DataFrame, ...], merge) -> DataFrame:
    rows = reduce(DataFrame.unionByName, [t.select("column", "sketch") for t in tables])
    return rows.groupBy("column").agg(merge("sketch").alias("sketch"))


def united_distinct(*tables: DataFrame) -> DataFrame:
    """The sketches of several runs as one per column, as if made in one pass."""
    return _united(tables, F.hll_union_agg)


def united_quantiles(*tables: DataFrame) -> DataFrame:
    return _united(tables, F.kll_merge_agg_double)


def estimated_distinct(sketches: DataFrame) -> DataFrame:
    """(column, n_unique), estimated."""
    return sketches.select("column", F.hll_sketch_estimate("sketch").alias("n_unique"))


def estimated_quantiles(sketches: DataFrame, ranks: list[float]) -> DataFrame:
    """(column, rank, value), estimated; a column without values has nulls."""
    def at(rank: float) -> Column:
        value = F.when(F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(rank)))
        return F.struct(F.lit(rank).alias("rank"), value.alias("value"))

    return sketches.select("column", F.inline(F.array(*[at(float(r)) for r in ranks])))
