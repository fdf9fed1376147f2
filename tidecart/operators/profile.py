"""Table profiles: counts, nulls, distinct values, describe, correlations, column documents."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecart.functions.parsing import without_nan
from tidecart.operators.outliers import numeric_columns
from tidecart.operators.quantiles import exact_quantiles


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def table_size(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def _per_column(df: DataFrame, columns: list[str], facts, extra: list[Column] = ()) -> DataFrame:
    """One aggregate over the table, turned into one row per column.

    ``facts(name)`` gives the row's aggregates by field name.
    """
    wide = without_nan(df).agg(*extra, *[
        F.struct(F.lit(c).alias("column"), *[v.alias(k) for k, v in facts(c).items()]).alias(f"__{i}")
        for i, c in enumerate(columns)
    ])
    rows = F.array(*[F.col(f"__{i}") for i in range(len(columns))])
    return wide.select(F.inline(rows))


def null_counts(df: DataFrame) -> DataFrame:
    return _per_column(df, df.columns, lambda c: {"null_count": F.count_if(_col(c).isNull())})


def null_shares(df: DataFrame) -> DataFrame:
    """Null count, missing share and completeness in percent; null shares for an empty table."""
    def facts(c: str) -> dict[str, Column]:
        missing = F.count_if(_col(c).isNull())
        share = F.try_divide(missing.cast("double") * 100, F.count(F.lit(1)))
        return {"null_count": missing, "missing_pct": share, "complete_pct": 100 - share}

    return _per_column(df, df.columns, facts)


def missing_report(df: DataFrame, n: int = 15) -> DataFrame:
    """The columns with most missing values; empty when nothing is missing."""
    return (
        null_shares(df)
        .where(F.col("missing_pct") > 0)
        .select("column", F.col("null_count").alias("missing_count"), "missing_pct")
        .orderBy(F.col("missing_pct").desc(), "column")
        .limit(n)
    )


def table_info(df: DataFrame) -> DataFrame:
    types = dict(df.dtypes)
    return _per_column(df, df.columns, lambda c: {"dtype": F.lit(types[c]), "non_null": F.count(_col(c))})


def value_frequencies(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, value as text, n) for every non-null value of the columns.

    The key is (column, value) with counting before the shuffle: neither a wide column nor a
    frequent value ends up in one task.
    """
    columns = columns or df.columns
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), _col(c).cast("string").alias("value")) for c in columns
    ])
    return (
        without_nan(df).select(F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _every_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per listed column, so that an all-null column is not lost from a report."""
    return df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in columns])).alias("column")
    )


def distinct_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    counted = value_frequencies(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    return _every_column(df, columns).join(F.broadcast(counted), "column", "left").select(
        "column", F.coalesce("n_unique", F.lit(0)).alias("n_unique")
    )


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max, one row per column."""
    columns = columns or numeric_columns(df)
    probs = [0.25, 0.5, 0.75]
    quartiles = exact_quantiles(df, {c: probs for c in columns})

    def facts(c: str) -> dict[str, Column]:
        x = _col(c).cast("double")
        return {
            "count": F.count(x),
            "mean": F.avg(x),
            "std": F.stddev_samp(x),
            "min": F.min(x),
            **{name: F.lit(quartiles[c][p]).cast("double")
               for name, p in zip(("p25", "p50", "p75"), probs)},
            "max": F.max(x),
        }

    return _per_column(df, columns, facts)


def describe_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, number of different values, most frequent value (smallest on a tie), its frequency."""
    best = (
        value_frequencies(df, columns)
        .groupBy("column", "n")
        .agg(F.min("value").alias("value"), F.count(F.lit(1)).alias("values"))
        .groupBy("column")
        .agg(
            F.sum(F.col("n") * F.col("values")).alias("count"),
            F.sum("values").alias("unique"),
            F.max_by("value", "n").alias("top"),
            F.max("n").alias("freq"),
        )
    )
    return _every_column(df, columns).join(F.broadcast(best), "column", "left").select(
        "column",
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("unique", F.lit(0)).alias("unique"),
        "top", "freq",
    )


def describe_all(df: DataFrame) -> DataFrame:
    """Both describes in one table, one row per column of the input."""
    numeric = numeric_columns(df)
    other = [c for c in df.columns if c not in numeric]
    parts = []
    if numeric:
        parts.append(describe_numeric(df, numeric))
    if other:
        parts.append(describe_values(df, other))
    if len(parts) == 2:
        return parts[0].unionByName(parts[1], allowMissingColumns=True)
    return parts[0]


def correlations(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of each pair of columns over the rows where both are present."""
    columns = columns or numeric_columns(df)
    pairs = list(combinations(columns, 2))
    wide = without_nan(df).agg(*[F.corr(_col(a).cast("double"), _col(b).cast("double")).alias(f"__{i}")
                    for i, (a, b) in enumerate(pairs)])
    rows = []
    for i, (a, b) in enumerate(pairs):
        for left, right in ((a, b), (b, a)):
            rows.append(F.struct(F.lit(left).alias("left_column"), F.lit(right).alias("right_column"),
                                 F.col(f"__{i}").alias("corr")))
    rows += [F.struct(F.lit(c).alias("left_column"), F.lit(c).alias("right_column"),
                      F.lit(1.0).alias("corr")) for c in columns]
    return wide.select(F.inline(F.array(*rows)))


def most_correlated_of(df: DataFrame, targets: list[str], columns: list[str], n: int = 6) -> dict[str, list[str]]:
    """For each target, itself and the columns with the largest absolute correlation to it; one aggregate for all."""
    pairs = sorted({tuple(sorted((t, c))) for t in targets for c in columns if c != t})
    if not pairs:
        return {t: [t] for t in targets}
    row = without_nan(df).agg(*[F.corr(_col(a).cast("double"), _col(b).cast("double")).alias(str(i)) for i, (a, b) in enumerate(pairs)]).first()
    strength = {p: -1.0 if v is None or v != v else abs(v) for p, v in zip(pairs, row)}
    found = {}
    for t in targets:
        others = [c for c in columns if c != t]
        others.sort(key=lambda c: -strength[tuple(sorted((t, c)))])  # stable: ties keep their order
        found[t] = [t, *others[: n - 1]]
    return found


def most_correlated(df: DataFrame, target: str, columns: list[str], n: int = 6) -> list[str]:
    """The target itself and the columns with the largest absolute correlation to it."""
    return most_correlated_of(df, [target], columns, n)[target]


def column_documents(df: DataFrame, n_samples: int = 5) -> DataFrame:
    """One row per column: type, nulls, distinct values, then sample values or min, max and mean.

    The samples of a text column are its smallest values, so that they do not depend on row order.
    """
    numeric = numeric_columns(df)
    types = dict(df.dtypes)
    sampled = [c for c in df.columns if types[c] in ("string", "boolean")]
    basics = _per_column(df, df.columns, lambda c: {
        "dtype": F.lit(types[c]),
        "null_count": F.count_if(_col(c).isNull()),
        "null_pct": F.try_divide(F.count_if(_col(c).isNull()).cast("double") * 100, F.count(F.lit(1))),
        "min": F.lit(None).cast("string") if c in sampled else F.min(_col(c)).cast("string"),
        "max": F.lit(None).cast("string") if c in sampled else F.max(_col(c)).cast("string"),
        "mean": F.avg(_col(c).cast("double")) if c in numeric else F.lit(None).cast("double"),
    })
    # the n smallest per column are kept in each task before the shuffle (WindowGroupLimit)
    smallest_first = Window.partitionBy("column").orderBy("value")
    samples = (
        value_frequencies(df, sampled or df.columns[:1])
        .withColumn("place", F.row_number().over(smallest_first))
        .where((F.col("place") <= n_samples) & F.col("column").isin(sampled))
        .groupBy("column")
        .agg(F.array_sort(F.collect_list("value")).alias("sample_values"))
    )
    unique = distinct_counts(df).withColumnRenamed("n_unique", "unique_count")
    return basics.join(F.broadcast(unique), "column").join(F.broadcast(samples), "column", "left")
