"""Rankings, value counts, group means and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.functions.parsing import without_nan


def _col(name: str):
    return F.col(f"`{name}`")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-null values with their counts, most frequent first; the value settles ties."""
    return (
        without_nan(df).where(_col(column).isNotNull())
        .groupBy(_col(column)).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), _col(column))
    )


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return value_counts(df, column).limit(n)


def top_rows(df: DataFrame, columns: list[str], by: str, n: int = 10) -> DataFrame:
    """The n rows with the largest value, nulls last; the other columns settle ties."""
    ties = [_col(c) for c in columns if c != by]
    return without_nan(df.select(*map(_col, columns))).orderBy(_col(by).desc_nulls_last(), *ties).limit(n)


def group_means(df: DataFrame, group: str, value: str, name: str | None = None) -> DataFrame:
    """Mean per non-null group, largest first, groups without a value last."""
    name = name or value
    return (
        without_nan(df).where(_col(group).isNotNull())
        .groupBy(_col(group)).agg(F.avg(_col(value)).alias(name))
        .orderBy(F.col(name).desc_nulls_last(), _col(group))
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max] of the non-null values, the last one closed on the right.

    A column with a single value gets the unit interval around it. Empty bins are listed too.
    """
    df = without_nan(df.select(_col(column).cast("double").alias(column)))
    x = _col(column)
    low, high = df.agg(F.min(x), F.max(x)).first()
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin int, low double, high double, count bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    counted = (
        df.where(x.isNotNull())
        .groupBy(F.least(F.width_bucket(x, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (F.lit(low) + (F.col("bin") - 1) * width).alias("low"),
        (F.lit(low) + F.col("bin") * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("count"),
    ).orderBy("bin")
