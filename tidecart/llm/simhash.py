"""Near-duplicate documents by SimHash fingerprints and multi-index hashing.

A fingerprint has 64 bits in two segments of 32. Of two fingerprints that differ in at most two bits one
segment at least differs in at most one. So each distinct fingerprint stands in a table for either
segment, keyed by the segment, and asks for the 33 words of the small Hamming ball around either of
its own; what meets is verified by its complete distance.

A bucket of more than ``CROWDED`` fingerprints, and the buckets one bit beside it, are divided exactly by
the other segment instead: fingerprints that ask for such a bucket are looked up by all 64 bits. Two that
differ in at most two bits have a word between them that is at most one bit away from each; 65
fingerprints at most meet at such a word, and no pairs are made. Copies have one fingerprint and are
one class throughout.
"""

from __future__ import annotations

import sys
from itertools import islice

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecart.llm._common import appended, attach_unique, column, fresh
from tidecart.operators.attach import fits_broadcast
from tidecart.session import pin

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENTS, SEGMENT_BITS, RADIUS = 2, 32, 2
CROWDED = 64              # fingerprints in a bucket of a segment's table, beyond which it is divided by the other segment
BROADCAST_BYTES = 16 * 1024 * 1024
_BLOCK = 255 * 256  # hashes counted at a time: 255 bytes can be added without leaving a byte


def fingerprint_of(text: str | None, width: int) -> int:
    """The 64-bit fingerprint of one text, as a signed integer."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(width)))) if len(words) >= width else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, 42) for s in shingles), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        bits = np.unpackbits(hashes[at:at + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        if whole:
            counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).astype(np.int64).sum(axis=0)
        counts += bits[whole:].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 3) -> DataFrame:
    """(id, text_hash, fp) of every row; fp is the fingerprint as a signed long.

    Words are what ASCII white space divides, A-Z are lower-cased, and shingles of ``width`` words
    count as often as they occur; a shorter text is one shingle. Null, empty and blank texts have
    fingerprint zero. ``text_hash`` only tells rows with the same id apart.
    """

    source = docs.select(column(id_column).cast("long").alias("id"), F.xxhash64(column(text_column)).alias("text_hash"),
                         column(text_column).cast("string").alias("text"))
    return appended(source, [F.col("text")], lambda texts: [[fingerprint_of(t, width) for t in texts]], "fp long", ["id", "text_hash"],
                    batch_bytes=4e6)


def places(fp: str) -> list[str]:
    """SQL for the buckets of a fingerprint: each segment, with its number above it."""
    mask, above = (1 << SEGMENT_BITS) - 1, 1 << SEGMENT_BITS
    return [f"((shiftrightunsigned({fp}, {s * SEGMENT_BITS}) & {mask}L) + {s * above}L)" for s in range(SEGMENTS)]


def ball(words: list[str], bits: range) -> F.Column:
    """Each word and all that differ from it in one of the bits."""
    near = [x for w in words for x in (w, *(f"{w} ^ shiftleft(1L, {b})" for b in bits))]
    return F.expr(f"array({', '.join(near)})")


def crowd_links(distinct: DataFrame) -> DataFrame:
    """(a, b) with a < b: links whose components are those of all pairs within two bits, by words of all 64 bits."""
    met = distinct.select("fp", F.explode(ball(["fp"], range(SEGMENTS * SEGMENT_BITS))).alias("word"))
    w = Window.partitionBy("word").orderBy("fp")
    pairs = met.select(F.lag("fp").over(w).alias("a"), F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    return pairs.where(F.col("a").isNotNull() & near)


def links(distinct: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(a, b) with a < b: links between distinct fingerprints ``fp`` whose components are those of all pairs within two bits."""
    segment = range(SEGMENT_BITS)
    table = distinct.select(F.col("fp").alias("b"), F.explode(F.array(*map(F.expr, places("fp")))).alias("place"))
    asks = distinct.select(F.col("fp").alias("a"), F.explode(ball(places("fp"), segment)).alias("place"))
    full = table.groupBy("place").count().where(F.col("count") > crowded)
    full = pin(full.select(F.explode(ball(["place"], segment)).alias("place")).distinct())
    divided = bool(full.limit(1).count())
    if divided:
        full = F.broadcast(full) if fits_broadcast(full, BROADCAST_BYTES) else full
        crowd = asks.join(full, "place", "left_semi").select(F.col("a").alias("fp")).distinct()
        asks = asks.join(full, "place", "left_anti")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    found = asks.join(table, "place").where((F.col("a") < F.col("b")) & near).select("a", "b")
    return (found.unionAll(crowd_links(crowd)) if divided else found).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), where root is the smallest node reachable.

    Large-star and small-star rounds, each a few aggregations and joins; links are written between
    rounds, so a lost executor costs one round. The number of rounds follows the logarithm of the
    longest chain.
    """
    edges = pin(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    before = None
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        edges = pin(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 3,
                    similar: DataFrame | None = None) -> DataFrame:
    """(id, text_hash, fp, component) of every row; component is the smallest id reachable over links.

    ``similar`` may give further links (a, b) between texts, by their ``text_hash``; as texts of one
    fingerprint are linked already, each of them joins two fingerprints.

    An id of null is larger than any other; a component of such rows only has component null. Rows
    that repeat an id are rows of their own with the same answer where their texts agree. An empty
    table gives an empty result.
    """
    rows = pin(fingerprints(docs, id_column, text_column, width))
    classes = pin(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n_rows")))
    edges = links(classes.select("fp"))
    if similar is not None:
        names = rows.select("text_hash", "fp").distinct()
        ends = similar.join(names.select(F.col("text_hash").alias("a"), F.col("fp").alias("fp_a")), "a")
        ends = ends.join(names.select(F.col("text_hash").alias("b"), F.col("fp").alias("fp_b")), "b")
        edges = edges.unionAll(ends.where("fp_a != fp_b").select("fp_a", "fp_b"))
    roots = components(edges)
    grouped = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", "n_rows", F.coalesce("root", "fp").alias("root"))
    grouped = pin(grouped)
    least = grouped.groupBy("root").agg(F.min("first").alias("component"), F.count("*").alias("n_classes"))
    least = least.where("n_classes > 1 or component is null").select("root", "component")
    named = grouped.join(least, "root", "left").select("fp", F.coalesce("component", "first").alias("component"), "n_rows")
    return attach_unique(rows, pin(named), ["fp"], "n_rows")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 3,
                similar: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` with one row left of each group of near-duplicates: that of its smallest id.

    ``similar`` is as in ``near_duplicates``.

    Rows that repeat both id and text count as one. Of rows without an id one stays for each group
    that has no row with an id (for each fingerprint where no row of the group has one).
    """
    found = near_duplicates(docs, id_column, text_column, width, similar)
    lead = found.where(F.col("id").eqNullSafe(F.col("component")))
    # ids can repeat: of the texts that share the leading id the one with the smallest hash stays
    nameless = F.when(F.col("id").isNull(), F.col("fp"))
    lead = lead.groupBy("component", nameless.alias("nameless"), "text_hash").agg(F.count("*").alias("n"))
    lead = lead.groupBy("component", "nameless").agg(F.min(F.struct("text_hash", "n")).alias("first"))
    lead = lead.groupBy(F.col("component").alias("__id"), F.col("first.text_hash").alias("__hash")).agg(F.max("first.n").alias("n"), F.count("*").alias("m"))
    lead = pin(lead.select("__id", "__hash", ((F.col("n") > 1) | (F.col("m") > 1)).alias("repeated")))
    mark = fresh(docs, "__text_hash")
    own = docs.withColumn(mark, F.xxhash64(column(text_column)))
    small = fits_broadcast(lead, BROADCAST_BYTES)  # beyond that the texts are shuffled once

    def rows_of(keys: DataFrame) -> DataFrame:
        keys = F.broadcast(keys) if small else keys
        return own.join(keys, own[mark].eqNullSafe(F.col("__hash")) & column(id_column).cast("long").eqNullSafe(F.col("__id")), "left_semi")

    kept = rows_of(lead.where("not repeated")).drop(mark)
    if not lead.where("repeated").limit(1).count():
        return kept
    once = rows_of(lead.where("repeated")).groupBy(column(id_column).cast("long").alias("__id"), column(mark).alias("__hash")).agg(
        F.first(F.struct(*[column(c) for c in docs.columns])).alias("__row"))
    return kept.unionAll(once.select(*[F.col("__row")[c].alias(c) for c in docs.columns]))


def fingerprint_links(spark, folder: str) -> DataFrame:
    """Query op8: fingerprints of all documents and the components of those within two bits."""
    found = near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))
