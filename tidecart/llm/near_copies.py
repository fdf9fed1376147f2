"""Links between texts whose sets of five-word shingles are alike, for near copies beyond the reach of a SimHash ball.

The minima of a text's shingle hashes under a family of permutations go in bands; texts that share a band
meet in its bucket. No pairs are made within a bucket: each round its first texts (one, then eight, then 64, ...) lead,
all others are compared with the leaders, and those that are linked leave the bucket with them. A group of
thousands of near copies is linked in one round, and a bucket of unlike texts empties in as many
rounds as its size has octal digits. Each link is verified on the whole sets of shingles.
"""

from __future__ import annotations

import sys
from itertools import islice

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecart.llm._common import appended, column
from tidecart.operators.attach import fits_broadcast
from tidecart.session import pin, pin_result

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH, SIMILARITY = 5, (4, 5)   # words of a shingle; least Jaccard similarity, as a fraction
BANDS, ROWS = 14, 5             # a pair of similarity 0.8 meets in one band at least with probability 0.996
LEADERS_GROW = 8
BROADCAST_BYTES = 8 * 1024 * 1024
_SEED = 5
_BLOCK = 4096                   # shingles whose hashes are permuted at a time


def _multipliers():
    import numpy as np

    return np.random.default_rng(_SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def sketch_of(text: str | None, multipliers, width: int = WIDTH):
    """(bands, shingles) of one text: a number per band, and the distinct shingles as 32-bit hashes.

    Words are what ASCII white space divides, A-Z are lower-cased; fewer words than ``width`` are one
    shingle. A text without words has neither.
    """
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(width)))) if len(words) >= width else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.unique(np.fromiter((digest(s, _SEED) for s in shingles), np.uint64, n))
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _BLOCK):
        np.minimum(least, (hashes[at:at + _BLOCK, None] * multipliers).min(axis=0), out=least)
    bands = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column_of_rows in least.reshape(BANDS, ROWS).T:
        bands = (bands ^ column_of_rows) * np.uint64(0x9E3779B97F4A7C15)
        bands ^= bands >> np.uint64(29)
    return bands.view(np.int64), np.unique((hashes >> np.uint64(32)).astype(np.uint32)).view(np.int32)


def sketches(docs: DataFrame, text_column: str = "text", width: int = WIDTH) -> DataFrame:
    """(text_hash, bands, shingles) of every row."""
    source = docs.select(F.xxhash64(column(text_column)).alias("text_hash"), column(text_column).cast("string").alias("text"))

    def run(texts: list) -> list:
        multipliers = _multipliers()
        made = [sketch_of(t, multipliers, width) for t in texts]
        return [[m[0] for m in made], [m[1] for m in made]]

    return appended(source, [F.col("text")], run, "bands array<long>, shingles array<int>", ["text_hash"], batch_bytes=4e6)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets of shingles are alike."""
    above, below = SIMILARITY
    of_b = sets.select(F.col("text_hash").alias("b"), F.col("shingles").alias("set_b"))
    of_a = sets.select(F.col("text_hash").alias("a"), F.col("shingles").alias("set_a"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    alike = common * F.lit(above + below) >= (F.size("set_a") + F.size("set_b")) * F.lit(above)
    return pairs.join(of_b, "b").join(of_a, "a").where(alike).select("a", "b")


def similar_links(docs: DataFrame, text_column: str = "text", width: int = WIDTH) -> DataFrame:
    """(a, b) with a < b: links between different texts of Jaccard similarity 0.8 or more, by the xxhash64 of the texts.

    Not every pair is returned, but the components are those of the pairs that meet in a band, up to
    chains whose only link is between two texts of which one was linked to a leader first in every band they share.
    Shingles are told apart by 32 bits when similarity is verified. Texts without words have no link; an
    empty table gives an empty result; repeated rows count once.
    """
    return pin_result(docs.sparkSession, lambda: _links(docs, text_column, width))


def _links(docs: DataFrame, text_column: str, width: int) -> DataFrame:
    above, below = SIMILARITY
    texts = pin(sketches(docs, text_column, width))
    entries = pin(texts.select("text_hash", F.size("shingles").alias("n"), F.explode("bands").alias("key")).distinct())
    crowded = entries.groupBy("key").count().where("count > 1").select("key")
    state = pin(entries.join(crowded, "key", "left_semi"))
    wanted = pin(state.select("text_hash").distinct())
    small = fits_broadcast(wanted, BROADCAST_BYTES)
    sets = pin(texts.join(F.broadcast(wanted) if small else wanted, "text_hash", "left_semi").groupBy("text_hash").agg(
        F.first("shingles").alias("shingles")))
    n_leaders, found = 1, []
    while True:
        place = F.row_number().over(Window.partitionBy("key").orderBy("text_hash"))
        leaders = pin(state.withColumn("place", place).where(F.col("place") <= n_leaders).select(
            "key", F.col("text_hash").alias("a"), F.col("n").alias("n_a")))
        met = state.join(leaders, "key").where(F.col("a") < F.col("text_hash")).where(
            (F.col("n") * below >= F.col("n_a") * above) & (F.col("n_a") * below >= F.col("n") * above))
        met = pin(met.select("key", "a", F.col("text_hash").alias("b")))
        linked = pin(_verified(met.select("a", "b").distinct(), sets))
        found.append(linked)
        gone = met.join(linked, ["a", "b"], "left_semi").select("key", F.col("b").alias("text_hash")).unionAll(
            leaders.select("key", F.col("a").alias("text_hash"))).distinct()
        left = state.join(gone, ["key", "text_hash"], "left_anti")
        still = left.groupBy("key").count().where("count > 1").select("key")
        state = pin(left.join(still, "key", "left_semi"))
        if not state.limit(1).count():
            break
        n_leaders *= LEADERS_GROW
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionAll(more)
    return edges.distinct()
