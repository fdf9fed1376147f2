"""Attach per-key values to a large table without letting a hot key land in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_KEYS = 1000
HOT_BYTES = 16 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """Size of a row, near enough to decide about a broadcast: texts and arrays are measured."""
    sizes = [F.lit(16)]
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        if dtype in ("string", "binary"):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif dtype.startswith("array"):
            sizes.append(F.coalesce(F.size(c) * 16, F.lit(0)))
        else:
            sizes.append(F.lit(8))
    return reduce(lambda a, b: a + b, [s.cast("bigint") for s in sizes])


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measured, not estimated: one aggregate over the (already pinned) table."""
    total = df.select(row_bytes(df).alias("b")).agg(F.sum("b")).first()[0]
    return (total or 0) <= max_bytes


def attach(
    df: DataFrame,
    table: DataFrame,
    keys: list[str],
    weight: str,
    max_bytes: int = BROADCAST_BYTES,
    n_bytes: int | None = None,
) -> DataFrame:
    """Left-join ``table`` (one row per key, pinned) to ``df``; null keys match null keys.

    ``weight`` is the column of ``table`` with the number of rows of ``df`` behind each key; it is
    not part of the result. A table measured to fit (or known to, by ``n_bytes``) is broadcast. A larger one is split: keys that
    hold half a shuffle task's share of the rows or more are broadcast, as far as they are measured to
    fit, and else those with a thousandth of all rows, of which there are at most 1000. The other keys
    are shuffled; rows of hot keys, and of null keys where the table has none, are spread over that
    shuffle by a salt that matches nothing.
    """
    values = [c for c in table.columns if c not in keys and c != weight]
    renamed = table.select(
        *[F.col(f"`{k}`").alias(f"__key_{i}") for i, k in enumerate(keys)],
        F.struct(*[F.col(f"`{v}`") for v in values]).alias("__values"),
        F.col(f"`{weight}`").alias("__weight"),
    )
    matches = [df[f"`{k}`"].eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(keys)]
    key_columns = [f"__key_{i}" for i in range(len(keys))]
    unpack = [F.col("__values")[v].alias(v) for v in values]
    own = [F.col(f"`{c}`") for c in df.columns]

    if n_bytes <= max_bytes if n_bytes is not None else fits_broadcast(table, max_bytes):
        small = F.broadcast(renamed.drop("__weight"))
        return df.join(small, matches, "left").select(*own, *unpack)

    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key_columns])
    total, nulls = renamed.agg(F.sum("__weight"), F.count_if(no_key)).first()
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(HOT_KEYS, 2 * tasks)
    if share > HOT_KEYS and not fits_broadcast(renamed.where(F.col("__weight") * share >= F.lit(total)), max(max_bytes, HOT_BYTES)):
        share = HOT_KEYS
    is_hot = F.col("__weight") * share >= F.lit(total)
    hot = F.broadcast(renamed.where(is_hot).drop("__weight").withColumnRenamed("__values", "__hot"))
    marked = df.join(hot, matches, "left").drop(*key_columns)
    unmatched = F.lit(False) if nulls else reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    salt = F.when(F.col("__hot").isNull() & ~unmatched, F.lit(0)).otherwise(
        F.lit(1) + F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("int")
    )
    marked = marked.withColumn("__salt", salt)
    cold = renamed.where(~is_hot).drop("__weight").withColumn("__cold", F.lit(0))
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(keys)]
    joined = marked.join(cold, on + [F.col("__salt") == F.col("__cold")], "left")
    picked = F.coalesce(F.col("__hot"), F.col("__values"))
    return joined.withColumn("__values", picked).select(*own, *unpack)
