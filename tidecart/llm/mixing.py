"""Mix sources to target weights by Poisson replication.

A source's target is its share of a total size; its rate is the target over its own size. Each
document is repeated Poisson(rate) times: the distribution function, inverted at a number hashed from
the seed and the document, gives the count, so no state is kept and a retried task draws the same.
Copies are then dealt out and sorted by a hash of their own, which shuffles the whole corpus. All of it
is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart.llm._common import attach_unique, column
from tidecart.operators.attach import fits_broadcast
from tidecart.session import pin

SEED = "mix-1"
LARGEST_MEAN = 16.0       # a larger mean is the sum of draws with smaller ones
STEPS = 96                # the distribution function of mean 16 is 1 - 1e-40 there
BROADCAST_BYTES = 8 * 1024 * 1024


def hashed_unit(text: Column) -> Column:
    """A double in [0, 1) with 52 bits of the md5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(2.0 ** 52)


def shares(docs: DataFrame, source_column: str = "source", size: Column | None = None, weights: dict | None = None) -> DataFrame:
    """(source, n_docs, size, rate): the rate that brings each source to its share of the corpus' size.

    ``weights`` maps sources to numbers; a source that it doesn't name is dropped from the mix by
    weight 0. Without it each source weighs the square root of its size, which lifts small sources.
    Sizes are code points unless ``size`` says otherwise. Null is a source like any other; a source of
    size 0 keeps its documents once each.
    """
    size = F.coalesce(F.length("text"), F.lit(0)) if size is None else size
    own = docs.groupBy(column(source_column).alias("source")).agg(F.count("*").alias("n_docs"), F.sum(size.cast("bigint")).alias("size"))
    own = pin(own)
    if weights is None:
        weighed = own.withColumn("w", F.ceil(F.sqrt("size")))
    else:
        named = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "name string, w double")
        weighed = own.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("name")), "left").drop("name").na.fill(0.0, ["w"])
    total, mass = weighed.agg(F.sum("size"), F.sum("w")).first()
    rate = F.when(F.col("size") == 0, 1.0).otherwise(F.col("w") * F.lit(float(total or 0)) / F.lit(float(mass or 1)) / F.col("size"))
    return weighed.select("source", "n_docs", "size", rate.alias("rate"))


def distribution(rate: Column) -> Column:
    """The Poisson distribution function at 0, 1, ... ``STEPS`` - 1, by its recurrence."""
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c"))

    def step(acc, k):
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS - 1)), start, step)["c"]


def copies(key: Column, parts: Column, function: Column, seed: str) -> Column:
    """Poisson draws for a document: as many values of its distribution function as lie at or below the hashed number, over all parts."""
    draw = lambda i: F.size(F.filter(function, lambda c: c <= hashed_unit(F.concat(F.lit(f"{seed}/"), key, F.lit("/"), i.cast("string")))))
    return F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), lambda acc, i: acc + draw(i))


def mix(docs: DataFrame, rates: DataFrame, id_column: str = "doc_id", source_column: str = "source", seed: str = SEED,
        text_column: str = "text") -> DataFrame:
    """``docs`` repeated by their sources' rates and shuffled: its columns, copy (from 0) and shuffle_key.

    Rows are dealt to partitions and sorted there by ``shuffle_key``, which is also a global order.
    Rows that repeat an id are drawn together; a row without an id draws by the md5 of its text (null as
    empty), so such rows are drawn together only where they are copies. An empty table gives an empty result. Columns of ``docs`` named copy or shuffle_key are replaced.
    """
    # the distribution function is worked out once per source, not per document
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_MEAN)).cast("int")
    rates = rates.select(F.col("source").alias("__source"), F.col("n_docs").alias("__n"), "rate", parts.alias("__parts"))
    rates = pin(rates.withColumn("__cdf", distribution(F.col("rate") / F.col("__parts"))).drop("rate"))
    own = docs.select(*[column(c) for c in docs.columns if c.lower() not in ("copy", "shuffle_key")])
    names = own.columns
    own = own.withColumn("__source", column(source_column))
    if fits_broadcast(rates, BROADCAST_BYTES):
        right = F.broadcast(rates.drop("__n").withColumnRenamed("__source", "__named"))
        joined = own.join(right, own["__source"].eqNullSafe(F.col("__named")), "left")
    else:
        joined = attach_unique(own, rates, ["__source"], "__n")
    key = F.coalesce(column(id_column).cast("string"), F.concat(F.lit("null/"), F.md5(F.coalesce(column(text_column).cast("string"), F.lit("")))))
    drawn = joined.withColumn("__copies", copies(key, F.col("__parts"), F.col("__cdf"), seed)).where("__copies > 0")
    repeated = drawn.select(*[column(c) for c in names], F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)).alias("copy"))
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), key, F.lit("#"), F.col("copy").cast("string"))), 1, 15), 16, 10)
    return repeated.withColumn("shuffle_key", place.cast("bigint")).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def poisson_mixing(spark, folder: str) -> DataFrame:
    """Query op2: the shuffled mix of all documents, texts by their md5."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    mixed = mix(docs, shares(docs))
    return mixed.select("doc_id", "source", "copy", "shuffle_key", F.md5("text").alias("text_md5"))


POISSON_MIXING_SQL = f"""
WITH s AS (
    SELECT source, sum(length(text)) AS size, ceil(sqrt(sum(length(text)))) AS w FROM documents GROUP BY source),
r AS (
    SELECT source, w * CAST(sum(size) OVER () AS DOUBLE) / CAST(sum(w) OVER () AS DOUBLE) / size AS rate FROM s),
p AS (
    SELECT source, rate, CAST(greatest(1, ceil(rate / {LARGEST_MEAN})) AS INTEGER) AS parts FROM r),
k AS (
    WITH RECURSIVE k(source, parts, mean, i, term, total) AS (
        SELECT source, parts, rate / parts, 0, exp(-(rate / parts)), exp(-(rate / parts)) FROM p
        UNION ALL
        SELECT source, parts, mean, i + 1, term * mean / (i + 1), total + term * mean / (i + 1) FROM k WHERE i + 1 < {STEPS})
    SELECT source, parts, list(total ORDER BY i) AS cdf FROM k GROUP BY source, parts),
n AS (
    SELECT doc_id, source, text, list_sum(list_transform(range(1, parts + 1), lambda i: len(list_filter(cdf, lambda c: c <=
        CAST(('0x' || substr(md5('{SEED}/' || doc_id || '/' || i), 1, 13)) AS BIGINT) / {2.0 ** 52})))) AS copies
    FROM documents JOIN k USING (source)),
e AS (
    SELECT doc_id, source, text, CAST(unnest(range(0, CAST(copies AS BIGINT))) AS INTEGER) AS copy FROM n)
SELECT doc_id, source, copy,
    CAST(('0x' || substr(md5('{SEED}/' || doc_id || '#' || copy), 1, 15)) AS BIGINT) AS shuffle_key, md5(text) AS text_md5
FROM e
"""
