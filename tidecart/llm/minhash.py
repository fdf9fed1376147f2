"""Document fingerprints by one-permutation MinHash, as DataFrame expressions.

Shingles of five words are hashed once. The high bits of a hash choose its bin and the smallest hash of
a bin represents it. An empty bin takes the value of another one (optimal densification): a sequence of
bins that depends on nothing but the empty bin's number is tried until one has a value, first by hashed
probes and then through all bins in hashed order, which comes to the smallest hash among those that have
values. Of each bin the four low-order bits are stored; as different values agree in them by chance in a
sixteenth of the cases, likeness is corrected for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecart.llm._common import column
from tidecart.session import pin

BIN_BITS = 8
BINS = 1 << BIN_BITS
LOW_BITS = 4
WIDTH = 5                 # words of a shingle
PROBES = 8
BLANKS = r" \t\n\x0B\f\r"
ROWS_PER_RANGE = 2000     # rows of a range of ids
MOST_RANGES = 65_536


def _bin(x: Column) -> Column:
    """The bin of a signed hash, so that sorted hashes have their bins in order."""
    return (F.shiftright(x, 64 - BIN_BITS) + BINS // 2).cast("int")


def _low(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << LOW_BITS) - 1)).cast("int")


def with_codes(df: DataFrame, text_column: str, name: str) -> DataFrame:
    """``df`` with ``name``: one code (0 to 15) per bin, or an empty array for a text without words.

    Words are what ASCII white space divides. A text of fewer than five words is one shingle. Each step
    is a projection of its own, so that an array which the next step reads many times is made once.
    """
    own = [column(c) for c in df.columns]
    text = F.regexp_replace(F.coalesce(column(text_column), F.lit("")), f"^[{BLANKS}]+", "")
    words = df.select(*own, F.split(text, f"[{BLANKS}]+").alias("__w"))
    # what follows the last white space is empty: it is no word
    words = words.select(*own, F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"),
                         (F.size("__w") - (F.element_at("__w", -1) == "").cast("int")).alias("__n"))
    shingle = F.transform(F.sequence(F.lit(0), F.col("__n") - WIDTH), lambda i: F.xxhash64(*[F.get("__h", i + k) for k in range(WIDTH)]))
    hashes = F.when(F.col("__n") >= WIDTH, shingle).when(F.col("__n") > 0, F.array(F.xxhash64(F.slice(F.col("__h"), F.lit(1), F.col("__n")))))
    sorted_ = words.select(*own, F.sort_array(F.coalesce(hashes, F.array().cast("array<bigint>"))).alias("__s"))
    first = F.filter("__s", lambda x, i: (i == 0) | (_bin(x) != _bin(F.get("__s", i - 1))))
    firsts = sorted_.select(*own, first.alias("__f"))
    gap = lambda i, x: _bin(x) - F.when(i == 0, 0).otherwise(_bin(F.get("__f", i - 1)) + 1)
    filled = F.flatten(F.transform("__f", lambda x, i: F.concat(F.array_repeat(F.lit(None).cast("int"), gap(i, x)), F.array(_low(x)))))
    rest = F.array_repeat(F.lit(None).cast("int"), F.lit(BINS - 1) - _bin(F.element_at("__f", -1)))
    slots = firsts.select(*own, "__f", F.when(F.size("__f") > 0, F.concat(filled, rest)).alias("__b"))

    def densified(code: Column, at: Column) -> Column:
        probe = [F.get("__b", F.pmod(F.xxhash64(at, F.lit(k)), F.lit(BINS)).cast("int")) for k in range(PROBES)]
        order = F.transform("__f", lambda x: F.shiftleft(F.shiftright(F.xxhash64(_bin(x), at), LOW_BITS), LOW_BITS).bitwiseOR(_low(x).cast("bigint")))
        return F.coalesce(code, *probe, _low(F.array_min(order)))

    codes = F.when(F.col("__b").isNotNull(), F.transform("__b", densified)).otherwise(F.array().cast("array<int>"))
    return slots.select(*own, codes.alias(name))


def packed(codes: Column) -> Column:
    """Codes as a string of one hexadecimal digit per bin; all zeros for a text without words."""
    digits = F.array_join(F.transform(codes, lambda c: F.substring(F.lit("0123456789abcdef"), c + 1, F.lit(1))), "")
    return F.when(F.size(codes) == 0, "0" * BINS).otherwise(digits)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts from their codes, 0 to 1; texts without words are alike to each other only."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    by_chance = 1.0 / (1 << LOW_BITS)
    estimate = F.greatest(F.lit(0.0), (equal / BINS - by_chance) / (1 - by_chance))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), ((F.size(a) == 0) & (F.size(b) == 0)).cast("double")).otherwise(estimate)


def id_ranges(ids: DataFrame, rows_per_range: int) -> list[int]:
    """Bounds that cut the ids (a column ``id``) into ranges of about equal size; at most ``MOST_RANGES`` of them."""
    n = ids.count()
    ranges = min(MOST_RANGES, -(-n // rows_per_range))
    if ranges < 2:
        return []
    at = [i / ranges for i in range(1, ranges)]
    found = ids.agg(F.percentile_approx("id", at, max(10_000, 20 * ranges))).first()[0]
    return sorted(set(found or []))


def range_of(id_: Column, bounds: list[int]) -> Column:
    """How many bounds lie at or below an id; searched in two steps. Null is in the first range."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    numbers = lambda xs: F.expr(f"cast(split('{','.join(map(str, xs))}', ',') as array<bigint>)")
    upper = F.size(F.filter(numbers(bounds[step - 1::step]), lambda b: b <= id_))
    within = F.slice(numbers(bounds), upper * step + 1, F.lit(step))
    return upper * step + F.size(F.filter(within, lambda b: b <= id_))


def with_next(docs: DataFrame, id_column: str, payload: list[str], name: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``docs`` with ``name``: the payload columns, as a struct, of the next row by ascending id (after the last: of the first).

    Rows are dealt to ranges of ids. Within a range the next row is the following one; the first row of
    each range is also sent to the end of the range before it, as a ghost that only its last row sees.
    So all is done by one shuffle, and what is broadcast are ids, one per range. Rows that repeat an id
    follow each other in the order of their payload, a null id comes first.
    """
    own = [column(c) for c in docs.columns]
    ids = docs.select(column(id_column).cast("bigint").alias("id"))
    bounds = id_ranges(ids, rows_per_range)
    heads = ids.groupBy(range_of(F.col("id"), bounds).alias("__range")).agg(F.min(F.struct("id")).alias("__head"))
    # one row per range, so one task orders them
    before = F.coalesce(F.lag("__range").over(Window.orderBy("__range")), F.max("__range").over(Window.partitionBy()))
    before = pin(heads.select(F.col("__head.id").alias("__head"), before.alias("__before")))
    ranged = docs.withColumn("__r", range_of(column(id_column).cast("bigint"), bounds)).withColumn("__ghost", F.lit(0))
    ghosts = docs.join(F.broadcast(before), column(id_column).cast("bigint").eqNullSafe(F.col("__head")))
    ghosts = ghosts.select(*own, F.col("__before").alias("__r"), F.lit(1).alias("__ghost"))
    both = ranged.unionAll(ghosts).withColumn("__p", F.struct(*[column(c) for c in payload]))
    following = F.lead("__p").over(Window.partitionBy("__r").orderBy("__ghost", column(id_column), "__p"))
    return both.withColumn(name, following).where(F.col("__ghost") == 0).select(*own, name)


def edited(text: Column, n_chars: Column, following: Column) -> Column:
    """The text with its last quarter (rounded down) replaced by as many first code points of the following text, or all."""
    quarter = F.floor(n_chars / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n_chars - quarter).cast("int")), F.substring(following, F.lit(1), quarter))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Fingerprints of every text and of its edited text, and what they say of each other and the next document's.

    Null texts are empty ones. Rows that repeat an id are documents of their own. A single row is its
    own next one. An empty table gives an empty result.
    """
    plain = docs.select(column(id_column).alias("doc_id"), F.coalesce(column(text_column), F.lit("")).alias("text"))
    coded = with_codes(plain, "text", "codes").withColumn("codes", F.col("codes").cast("array<tinyint>"))
    beside = with_next(coded, "doc_id", ["text", "codes"], "following", rows_per_range)
    n = F.length("text").cast("bigint")
    changed = beside.select("doc_id", n.alias("n_chars"), "codes", F.col("following.codes").alias("next_codes"),
                            edited(F.col("text"), n, F.col("following.text")).alias("edited"))
    both = with_codes(changed, "edited", "edited_codes").withColumn("edited_codes", F.col("edited_codes").cast("array<tinyint>"))
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), packed(F.col("codes")).alias("fingerprint"),
        packed(F.col("edited_codes")).alias("edited_fingerprint"), likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
        likeness(F.col("codes"), F.col("next_codes")).alias("near_next"))


def minhash_fingerprints(spark, folder: str) -> DataFrame:
    """Query op6: fingerprints of all documents and of their edited texts."""
    return fingerprints(spark.read.parquet(f"{folder}/documents.parquet"))
