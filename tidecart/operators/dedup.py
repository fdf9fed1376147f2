"""Exact and keep-latest deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

# Key columns of the product feed in order of preference, and its time column.
LATEST_KEYS = ["us_item_id", "product_id"]
LATEST_TIME = "fetch_time"


def drop_exact_copies(df: DataFrame) -> DataFrame:
    """Full-row distinct. Copies collapse before the shuffle, so a mass of copies stays cheap."""
    return df.dropDuplicates()


def drop_exact_copies_counted(df: DataFrame) -> tuple[DataFrame, Observation, Observation]:
    """The same with row counts on both sides, filled in by whatever job runs the result."""
    before, after = Observation("rows_before"), Observation("rows_after")
    seen = df.observe(before, F.count(F.lit(1)).alias("rows"))
    return seen.dropDuplicates().observe(after, F.count(F.lit(1)).alias("rows")), before, after


def keep_latest(
    df: DataFrame, keys: list[str] | None = None, time: str = LATEST_TIME
) -> DataFrame:
    """Last row per key in time order.

    The key is the first of ``keys`` the table has; without one nothing is dropped. A null time
    counts as latest and all null keys form one group, as in a stable sort that puts nulls last.
    Ties in time are settled by the other columns, so the result does not depend on row order.
    Spark limits each group before the shuffle (``WindowGroupLimit``), so a hot key sends at most
    one row per task.
    """
    key = next((k for k in (keys or LATEST_KEYS) if k in df.columns), None)
    if key is None:
        return df
    order = []
    if time in df.columns:
        order.append(F.col(f"`{time}`").desc_nulls_first())
    for name, dtype in df.dtypes:
        if name in (key, time):
            continue
        c = F.col(f"`{name}`")
        order.append((F.to_json(c) if "map<" in dtype else c).desc_nulls_first())
    newest_first = Window.partitionBy(F.col(f"`{key}`")).orderBy(*(order or [F.lit(1)]))
    return (
        df.withColumn("__place", F.row_number().over(newest_first))
        .where(F.col("__place") == 1)
        .drop("__place")
    )
