"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOT_KEYS = 1000


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def bucket_of(name: str, n: int) -> Column:
    """crc32 of the id as text, modulo n: the fold rule of the queries."""
    return F.pmod(F.crc32(column(name).cast("string")), F.lit(n))


def kept_in_worker(slot: str, version, build: Callable):
    """A value that a Python worker builds once and keeps for its later tasks, until another version is asked for."""
    store = sys.modules.setdefault("_tidecart_worker_store", types.ModuleType("_tidecart_worker_store"))
    if getattr(store, slot, (None, None))[0] != version:
        setattr(store, slot, (version, build()))
    return getattr(store, slot)[1]


def attach_unique(big: DataFrame, small: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Left-join ``small`` (one row per key) to ``big`` where a key may hold a third of the rows.

    ``weight`` is the column of ``small`` with the number of rows of ``big`` behind a key. Keys with
    a thousandth of the rows or more, of which there are at most 1000 by that definition, are
    broadcast; the other keys are shuffled, and rows that have their value already are spread over
    that shuffle by a salt that matches nothing. Null keys match null keys.
    """
    values = [c for c in small.columns if c not in keys and c != weight]
    total = small.agg(F.sum(weight)).first()[0] or 0
    named = small.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.struct(*values).alias("__v"), F.col(weight).alias("__w"))
    is_hot = F.col("__w") * HOT_KEYS >= F.lit(total)
    match = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    hot = named.where(is_hot).withColumnRenamed("__v", "__hot").drop("__w")
    marked = big.join(F.broadcast(hot), match, "left").drop(*[f"__k{i}" for i in range(len(keys))])
    marked = marked.withColumn("__salt", F.when(F.col("__hot").isNull(), 0).otherwise(
        1 + F.pmod(F.xxhash64(*[column(c) for c in big.columns]), F.lit(4096)).cast("int")))
    cold = named.where(~is_hot).drop("__w").withColumn("__zero", F.lit(0))
    joined = marked.join(cold, [*match, F.col("__salt") == F.col("__zero")], "left")
    picked = joined.withColumn("__v", F.coalesce("__hot", "__v"))
    return picked.select(*[column(c) for c in big.columns], *[F.col("__v")[v].alias(v) for v in values])


def appended(df: DataFrame, inputs: list[Column], run: Callable, fields: str, keep: list[str] | None = None,
             batch_bytes: float = 32e6) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``fields`` appended, worked out in Python workers batch by batch.

    ``run`` gets one list of values per input, of about ``batch_bytes`` or of one row, and returns one
    sequence per field; it may be called any number of times on any cut of the rows. The kept columns pass through as Arrow arrays,
    whatever they are named and hold; a new field may have the name of none of them.
    """
    names = df.columns if keep is None else keep
    kept = [f"k{i}" for i in range(len(names))]
    asked = [f"t{i}" for i in range(len(inputs))]
    added = StructType.fromDDL(fields).fields
    new = [(f.name, to_arrow_type(f.dataType)) for f in added]

    def batches(found):
        import pyarrow as pa

        for batch in found:
            cut = max(1, min(batch.num_rows, 1 + int(batch.num_rows * batch_bytes / max(1, batch.nbytes))))
            for at in range(0, batch.num_rows, cut):
                part = batch.slice(at, cut)
                values = run(*[part.column(len(kept) + i).to_pylist() for i in range(len(asked))])
                made = [pa.array(v, type=kind) for v, (_, kind) in zip(values, new)]
                yield pa.RecordBatch.from_arrays(part.columns[:len(kept)] + made, names=kept + [f for f, _ in new])

    source = df.select(*[column(c).alias(k) for c, k in zip(names, kept)], *[c.alias(t) for c, t in zip(inputs, asked)])
    shape = source.select(*kept).schema
    out = source.mapInArrow(batches, StructType(shape.fields + added))
    return out.select(*[F.col(k).alias(c) for c, k in zip(names, kept)], *[F.col(f) for f, _ in new])
