"""Per-group repair: drop a group's incomplete rows, or fill them with the group's means."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart.functions.parsing import without_nan
from tidecart.operators.attach import BROADCAST_BYTES, attach
from tidecart.operators.schema import has_columns
from tidecart.session import pin

# Fixed value: a group's incomplete rows go when they are at most this share of it.
DROP_SHARE = 0.05


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in columns])


def group_null_rates(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Rows, incomplete rows and their share for each group; the null group is left out."""
    incomplete = F.count_if(any_null(columns))
    return (
        without_nan(df).where(F.col(f"`{group}`").isNotNull())
        .groupBy(F.col(f"`{group}`"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            incomplete.alias("n_incomplete"),
            (incomplete / F.count(F.lit(1))).alias("null_rate"),
        )
    )


def _dropping(threshold: float) -> Column:
    return (F.col("null_rate") <= threshold) | (F.col("n_incomplete") == F.col("n_rows"))


def drop_incomplete_rows(
    df: DataFrame, group: str, columns: list[str], threshold: float = DROP_SHARE,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Drop incomplete rows of groups where they are few (at most the threshold) or everything.

    Rows of the null group always stay.
    """
    if not has_columns(df, [group, *columns]):
        return df
    df = without_nan(df)
    rates = group_null_rates(df, group, columns).where(F.col("n_incomplete") > 0)
    verdict = pin(rates.select(F.col(f"`{group}`"), F.col("n_rows"), _dropping(threshold).alias("__drop")))
    holed, whole = _split(df, group, columns)
    marked = attach(holed, verdict, [group], "n_rows", max_bytes)
    return marked.where(~F.coalesce(F.col("__drop"), F.lit(False))).drop("__drop").unionByName(whole)


def fill_with_group_mean(
    df: DataFrame, group: str, columns: list[str], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Null values become the mean of their group; a group without any value stays null."""
    if not has_columns(df, [group, *columns]):
        return df
    df = without_nan(df)
    means = pin(
        df.where(F.col(f"`{group}`").isNotNull())
        .groupBy(F.col(f"`{group}`"))
        .agg(F.count(F.lit(1)).alias("n_rows"),
             *[F.avg(F.col(f"`{c}`")).alias(f"__mean_{c}") for c in columns])
    )
    holed, whole = _split(df, group, columns)
    return _fill(attach(holed, means, [group], "n_rows", max_bytes), columns).unionByName(_fill(whole, columns))


def with_group_mean(
    df: DataFrame, group: str, column: str, name: str, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The mean of the row's group as a new column; null where the group is null.

    Aggregate and join, as a window over the group would put a large group in one task.
    """
    df = without_nan(df)
    means = pin(
        df.where(F.col(f"`{group}`").isNotNull())
        .groupBy(F.col(f"`{group}`"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(f"`{column}`")).alias(name))
    )
    return attach(df, means, [group], "n_rows", max_bytes)


def _split(df: DataFrame, group: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a hole in a named group, and the rest, which needs nothing and so no join.

    The null group and groups without a hole, which may hold most rows, never meet in a task.
    """
    holed = any_null(columns) & F.col(f"`{group}`").isNotNull()
    return df.where(holed), df.where(~holed)


def _fill(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cells as doubles, holes filled from the group's mean where one was attached."""
    mean = lambda c: [F.col(f"`__mean_{c}`")] if f"__mean_{c}" in df.columns else []
    filled = {c: F.coalesce(F.col(f"`{c}`").cast("double"), *mean(c)) for c in columns}
    return df.withColumns(filled).drop(*[f"__mean_{c}" for c in columns])


def repair_groups(
    df: DataFrame, group: str, columns: list[str], threshold: float = DROP_SHARE,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``drop_incomplete_rows`` then ``fill_with_group_mean`` from one aggregate and one join.

    The mean is wanted after the drop. A group that loses its incomplete rows has nothing left to
    fill, and a group that keeps them keeps all its rows, so the mean over the whole group serves.
    """
    if not has_columns(df, [group, *columns]):
        return df
    df = without_nan(df)
    incomplete = F.count_if(any_null(columns))
    facts = (
        df.where(F.col(f"`{group}`").isNotNull())
        .groupBy(F.col(f"`{group}`"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            incomplete.alias("n_incomplete"),
            (incomplete / F.count(F.lit(1))).alias("null_rate"),
            *[F.avg(F.col(f"`{c}`")).alias(f"__mean_{c}") for c in columns],
        )
        .where(F.col("n_incomplete") > 0)
        .withColumn("__drop", _dropping(threshold))
        .drop("n_incomplete", "null_rate")
    )
    holed, whole = _split(df, group, columns)
    marked = attach(holed, pin(facts), [group], "n_rows", max_bytes)
    kept = marked.where(~F.coalesce(F.col("__drop"), F.lit(False))).drop("__drop")
    return _fill(kept, columns).unionByName(_fill(whole, columns))
