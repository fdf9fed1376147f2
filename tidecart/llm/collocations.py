"""Phrases that stick together, mined by SON partitioning with exact global counts.

A shard is as many documents as a task holds at a time. A phrase with a global count of at least the
support has, in one shard at least, its share of it: the support times the shard's part of the
language's words, rounded up. Texts are divided into words once; shards are kept as word numbers and read
by every pass. So each shard is mined completely at that lowered support, level by level
(pairs, then phrases of one word more whose parts are frequent), and the union of what shards find is counted
exactly over all documents. Where there are as many shards as the support or more, the lowered support is
one and the shards' counts add up; the union is then cut to the phrases whose sum reaches the support. Candidates travel to the counting tasks as a bit table of fixed size, by hash: phrases
that share a bit by chance are counted too and fall to the support afterwards, so no result depends on
hashes and no task holds a table that grows with the corpus.
"""

from __future__ import annotations

import sys
import zlib

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecart.llm._common import column
from tidecart.operators.attach import fits_broadcast
from tidecart.session import pin, release_shuffles, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUPPORT = 30
LONGEST = 4               # words of a phrase
ABSORBED_PERCENT = 80     # of a phrase's count: a longer phrase with that many replaces it
TOP = 2000
SCORE_SCALE = 2_000_000
SHARD_WORDS = 500_000     # words that a task mines at a time
TABLE_BITS = 27           # the bit table of candidates has 2 ** 27 bits: 16 MiB
KEY_BITS = 40             # of a mined phrase's hash, which are summed by; phrases that share them are candidates together
BUCKET_BITS = 10          # mined keys are summed in at least two to the power of this many buckets
BUCKET_WORDS = 1 << 21    # of the corpus for each bucket, beyond that
BROADCAST_BYTES = 16 * 1024 * 1024
_CHUNK = 1 << 20          # bytes of a text divided into words at a time

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# fixed values: what ends a piece (with the line breaks 0A to 0D), and what divides words
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_TABLE = bytes(0xFF if b in ENDS else 0x20 if b in BLANKS else b for b in range(256))
_TABLE = bytes(_TABLE[b + 32] if 65 <= b <= 90 else _TABLE[b] for b in range(256))


SHARD = "langs array<string>, words binary, of binary, numbers binary"


class Known(dict):
    """Numbers of a language's words, given when a word is first met."""

    def __init__(self, code: int, words: list, of: list) -> None:
        super().__init__({b"\xff": 0})
        self.code, self.words, self.of = code, words, of

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.of.append(self.code)
        return number


class Writer:
    """The words of some documents, one after the other, as numbers of (language, word); number 0 ends a piece."""

    def __init__(self) -> None:
        self.langs: dict[str, Known] = {}
        self.words: list[bytes] = [b""]
        self.of: list[int] = [0]
        self.parts: list = []
        self.n = 0

    def add(self, lang: str, text: bytes) -> None:
        import numpy as np

        if lang not in self.langs:
            self.langs[lang] = Known(len(self.langs), self.words, self.of)
        number = self.langs[lang].__getitem__
        plain = text.translate(_TABLE)
        at = 0
        while at < len(plain):
            end = plain.find(b"\xff", at + _CHUNK)
            end = len(plain) if end < 0 else end
            words = plain[at:end].replace(b"\xff", b" \xff ").split()  # of white space only blanks are left
            self.parts.append(np.fromiter(map(number, words), np.int32, len(words)))
            self.n += len(words)
            at = end
        self.parts.append(np.zeros(1, np.int32))

    def row(self) -> tuple:
        """The fields of ``SHARD``, compressed: the executor holds them outside Python, too."""
        import numpy as np

        planes = np.concatenate(self.parts).astype("<i4").view(np.uint8).reshape(-1, 4).T  # bytes of equal weight together
        packed = [zlib.compress(x, 1) for x in (b" ".join(self.words), np.array(self.of, "<i4").tobytes(), planes.tobytes())]
        return list(self.langs), *packed


class Shard:
    """A shard as it was written: languages, words, the language of each word, the words of the texts by number."""

    def __init__(self, langs: list[str], words: bytes, of: bytes, numbers: bytes) -> None:
        import numpy as np

        self.langs, self.words, self.of = langs, zlib.decompress(words).split(b" "), np.frombuffer(zlib.decompress(of), "<i4")
        self.numbers = np.frombuffer(zlib.decompress(numbers), np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()

    def hashes(self):
        """A 64-bit hash of each (language, word), the same in all shards."""
        import numpy as np
        import xxhash

        digest = xxhash.xxh64_intdigest
        seeds = [digest(lang.encode()) for lang in self.langs]
        return np.fromiter(map(digest, self.words, map(seeds.__getitem__, self.of.tolist())), np.uint64, len(self.words))

    def support(self, totals: dict[str, int], support: int):
        """For each number the lowered support of its language in this shard."""
        import numpy as np

        words = np.bincount(self.of[self.numbers], weights=self.numbers > 0, minlength=len(self.langs)).astype(np.int64)
        least = np.array([-(-support * int(words[i]) // max(1, totals.get(lang, 1))) for i, lang in enumerate(self.langs)])
        return np.maximum(1, least)[self.of]


def mixed(hashes, length: int, at):
    """The hash of the phrase of ``length`` words from each place on."""
    import numpy as np

    out = np.full(len(at), length, np.uint64)
    for k in range(length):
        out = (out ^ hashes[at + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def set_bits(table, hashes):
    """Whether the bit of each hash is set; ``table`` is bytes of a power of two."""
    import numpy as np

    slot = hashes & np.uint64(len(table) * 8 - 1)
    return (table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def places(numbers, length: int):
    """Where a phrase of ``length`` words within a piece begins."""
    import numpy as np

    n = max(0, len(numbers) - length + 1)
    whole = np.ones(n, bool)
    for k in range(length):
        whole &= numbers[k:n + k] > 0
    return np.flatnonzero(whole)


def classes(numbers, at, length: int):
    """Number the phrases that begin at the places: (class of each place, first place of each class, count of each class)."""
    import numpy as np

    base = np.int64(numbers.max(initial=0) + 1)
    key = numbers[at].astype(np.int64)
    for k in range(1, length):
        if k > 1:  # two numbers of 31 bits fit a word; longer phrases go by the class of what came before
            _, key = np.unique(key, return_inverse=True)
        key = key * base + numbers[at + k]
    _, first, of, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return of, at[first], counts


def sharded(docs: DataFrame, lang_column: str, text_column: str, shard_words: int) -> DataFrame:
    """The shards of ``docs``, a row each: as many documents as reach ``shard_words`` words."""

    def run(batches):
        import pyarrow as pa

        def rows(shard):
            return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(shard.row(), kinds)], names=names)

        shard = Writer()
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):  # a document at a time
                shard.add(lang.as_py(), text.as_py())
                if shard.n >= shard_words:
                    yield rows(shard)
                    shard = Writer()
        if shard.parts:
            yield rows(shard)

    names, kinds = arrow_fields(SHARD)
    source = docs.select(F.coalesce(column(lang_column).cast("string"), F.lit("und")).alias("lang"),
                         F.coalesce(column(text_column).cast("string"), F.lit("")).cast("binary").alias("t"))
    return source.mapInArrow(run, SHARD)


def arrow_fields(fields: str) -> tuple[list[str], list]:
    """Names and Arrow types of the fields."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    found = StructType.fromDDL(fields).fields
    return [f.name for f in found], [to_arrow_type(f.dataType) for f in found]


def over_shards(shards: DataFrame, work, fields: str) -> DataFrame:
    """Rows that ``work`` makes of each of the ``shards``: it gets a Shard and returns one sequence per field."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for values in zip(*batch.columns):  # a shard at a time
                made = work(Shard(*(v.as_py() for v in values)))
                yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, type=t) for v, t in zip(made, kinds)], names=names)

    names, kinds = arrow_fields(fields)
    return shards.mapInArrow(run, fields)


def spelled(shard: Shard, first, length: int) -> list[str]:
    words, numbers = shard.words, shard.numbers
    return [b" ".join([words[n] for n in numbers[f:f + length].tolist()]).decode("utf-8", "replace") for f in first.tolist()]


def word_counts(shards: DataFrame) -> DataFrame:
    """(lang, phrase, f) of every word."""

    def work(shard):
        import numpy as np

        counts = np.bincount(shard.numbers, minlength=len(shard.words))[1:]
        return [shard.langs[i] for i in shard.of[1:].tolist()], [w.decode("utf-8", "replace") for w in shard.words[1:]], counts

    found = over_shards(shards, work, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def phrase_hashes(part, at, length: int, table):
    """(places, hashes) of the phrases from ``at`` on whose two parts of one word less ``table`` holds."""
    for k in range(2):
        at = at[set_bits(table, mixed(part, length - 1, at + k))]
    return at, mixed(part, length, at)


def packed(keys, counts) -> bytes:
    """Sorted keys and their counts, compressed: the steps between keys, bytes of equal weight together."""
    import numpy as np

    values = np.concatenate([np.diff(keys, prepend=0), counts]).astype("<i8")
    return zlib.compress(values.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(block: bytes):
    """(keys, counts) as ``packed`` got them."""
    import numpy as np

    values = np.frombuffer(zlib.decompress(block), np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()
    n = len(values) // 2
    return np.cumsum(values[:n]), values[n:]


def bucket_bits(words: int) -> int:
    """Mined keys are summed in as many buckets as this many of their first bits tell apart: the bucket of a corpus has a bounded share of it."""
    return min(KEY_BITS, max(BUCKET_BITS, (words // BUCKET_WORDS).bit_length()))


def mined_keys(shards: DataFrame, lengths: list[int], table, totals: dict[str, int], support: int, shard_words: int) -> DataFrame:
    """(key) of phrases of the lengths that can reach the support; ``table`` has the parts that they may consist of.

    Where the corpus has as many shards as the support or more, a shard's share of the support is one: what
    shards report are then all occurrences, and their sum is exact. With fewer shards each reports by its own
    share, and all that is reported stays. A shard's keys travel as a compressed block per bucket.
    """
    words = sum(totals.values())
    complete = words >= support * shard_words
    shift = KEY_BITS - bucket_bits(words)

    def work(shard):
        import numpy as np

        numbers = shard.numbers
        part = shard.hashes()[numbers]
        least = None if complete else shard.support(totals, support)
        keys, found = [], []
        for length in lengths:
            at, hashed = phrase_hashes(part, places(numbers, length), length, table)
            if complete:
                key, counts = np.unique(hashed, return_counts=True)
            else:
                key, first, counts = np.unique(hashed, return_index=True, return_counts=True)
                often = counts >= least[numbers[at[first]]]
                key, counts = key[often], counts[often]
            keys.append((key & np.uint64((1 << KEY_BITS) - 1)).view(np.int64))
            found.append(counts)
        key, counts = np.concatenate(keys), np.concatenate(found)
        order = np.argsort(key)
        key, counts = key[order], counts[order]
        buckets, first = np.unique(key >> shift, return_index=True)
        ends = [*first[1:].tolist(), len(key)]
        within = key & ((1 << shift) - 1)
        return buckets, [packed(within[i:j], counts[i:j]) for i, j in zip(first.tolist(), ends)]

    def often(blocks):
        import numpy as np
        import pyarrow as pa

        keys, counts = map(np.concatenate, zip(*(unpacked(b.as_py()) for b in blocks.column("block"))))
        key, of = np.unique(keys, return_inverse=True)
        if complete:
            key = key[np.bincount(of, weights=counts) >= support]
        return pa.table({"key": key + (blocks.column("bucket")[0].as_py() << shift)})

    return over_shards(shards, work, "bucket long, block binary").groupBy("bucket").applyInArrow(often, "key long")


def counted_phrases(shards: DataFrame, lengths: list[int], table, support: int) -> DataFrame:
    """(lang, phrase, f) of phrases of the lengths that reach the support, counted exactly where ``table`` holds them."""

    def work(shard):
        import numpy as np

        numbers = shard.numbers
        part = shard.hashes()[numbers]
        langs, phrases, found = [], [], []
        for length in lengths:
            at = places(numbers, length)
            at = at[set_bits(table, mixed(part, length, at))]
            _, first, counts = classes(numbers, at, length)
            langs += [shard.langs[i] for i in shard.of[numbers[first]].tolist()]
            phrases += spelled(shard, first, length)
            found.append(counts)
        return langs, phrases, np.concatenate(found)

    found = over_shards(shards, work, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= support)


def passed(shards: DataFrame, counted: list[int], mined: list[int], table, totals: dict[str, int], support: int, shard_words: int) -> DataFrame:
    """One pass over the shards: ``counted_phrases`` of the lengths ``counted`` or, where there are none, ``mined_keys`` of ``mined``."""
    return counted_phrases(shards, counted, table, support) if counted else mined_keys(shards, mined, table, totals, support, shard_words)


def bit_table(keys: DataFrame, bits: int):
    """The keys' bits as an array of bytes of fixed size, put together from words of 64 bits."""
    import numpy as np

    slot = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    words = keys.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("word"))
    found = words.toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[found["at"].to_numpy()] = found["word"].to_numpy()
    return table.astype("<i8").view(np.uint8)


def frequent(docs: DataFrame, lang_column: str = "lang", text_column: str = "text", support: int = SUPPORT, longest: int = LONGEST,
             shard_words: int = SHARD_WORDS, table_bits: int = TABLE_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f, length) of all phrases of one to ``longest`` words that reach the support; (lang, n) with all words counted."""
    shards = pin(sharded(docs, lang_column, text_column, shard_words))
    words = pin(word_counts(shards))
    sizes = pin(words.groupBy("lang").agg(F.sum("f").alias("n")))
    totals = {r.lang: r.n for r in sizes.collect()}  # one row a language
    release_shuffles(docs.sparkSession)
    often = words.where(F.col("f") >= support)
    table = bit_table(often.select(hash_of_words("lang", "phrase").alias("key")), table_bits)
    parts = [often.withColumn("length", F.lit(1))]
    levels = [[length] for length in range(2, longest + 1)]
    for level in levels:
        table = bit_table(passed(shards, [], level, table, totals, support, shard_words), table_bits)
        release_shuffles(docs.sparkSession)
        found = pin(passed(shards, level, [], table, totals, support, shard_words))
        parts.append(found.withColumn("length", F.size(F.split("phrase", " "))))
        release_shuffles(docs.sparkSession)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return pin(whole), sizes


def hash_of_words(lang: str, phrase: str) -> Column:
    """The key of single words, as ``mixed`` makes it, worked out in batches."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("long")
    def key(langs, words):
        import numpy as np
        import pandas as pd
        import xxhash

        digest = xxhash.xxh64_intdigest
        seeds = {x: digest(x.encode()) for x in set(langs)}
        hashes = np.fromiter((digest(w.encode("utf-8", "surrogatepass"), seeds[x]) for x, w in zip(langs, words)), np.uint64, len(words))
        return pd.Series(mixed(hashes, 1, np.arange(len(words))).view(np.int64))

    return key(lang, phrase)


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates (two words or more) with a, and l, r and score of their lowest-scoring cut.

    A cut after k words has the counts l and r of its parts and the score floor(2000000 * a / (l + r)); among
    equal scores the smallest k counts. The parts of a frequent phrase are frequent, so each is found.
    """
    whole = phrases.where("length > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"), "length")
    cuts = whole.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("tail"))
    counts = phrases.select("lang", "phrase", "f")
    small = fits_broadcast(counts, BROADCAST_BYTES)  # beyond that by shuffles, whose hot keys adaptive execution divides

    for name, count in (("head", "l"), ("tail", "r")):
        part = counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
        cuts = cuts.join(F.broadcast(part) if small else part, ["lang", name]).drop(name)
    score = F.expr(f"cast({SCORE_SCALE} as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return cuts.groupBy("lang", "phrase", "a").agg(least.alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "x.score")


def absorbed(phrases: DataFrame, percent: int = ABSORBED_PERCENT) -> DataFrame:
    """(lang, phrase) of the phrases that lie within a longer one with at least that part of their count."""
    long_ = phrases.where("length > 2").select("lang", "f", F.split("phrase", " ").alias("words"), "length")
    inner = F.expr("flatten(transform(sequence(2, length - 1), m -> transform(sequence(1, length - m + 1), i -> array_join(slice(words, i, m), ' '))))")
    most = long_.select("lang", "f", F.explode(F.array_distinct(inner)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    met = phrases.where("length > 1").join(most, ["lang", "phrase"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    return met.where(wide("longer") * 100 >= wide("f") * percent).select("lang", "phrase")


def collocations(docs: DataFrame, lang_column: str = "lang", text_column: str = "text", support: int = SUPPORT, longest: int = LONGEST,
                 top: int = TOP, shard_words: int = SHARD_WORDS, table_bits: int = TABLE_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases.

    A null language is ``und``, a null text empty. Rows that repeat count as often as they occur; ties are
    settled by count and then by the phrase's bytes. Languages without a frequent phrase and empty tables
    give no rows. Other columns of ``docs`` are ignored, whatever their names.
    """
    phrases, sizes = frequent(docs, lang_column, text_column, support, longest, shard_words, table_bits)
    kept = scored(phrases).join(absorbed(phrases), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # first within parts of a language, so that one language with most phrases is no single task's work
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(tasks)))
    within = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    first = dealt.withColumn("rank", within).where(F.col("rank") <= top).drop("rank", "part")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = first.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(sizes), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def phrase_collocations(spark, folder: str) -> DataFrame:
    """Query op13: the best phrases of each language over all documents."""
    small_batches(spark)
    return collocations(spark.read.parquet(f"{folder}/documents.parquet"))


_WORDS = r"regexp_extract_all(piece, '[^\x20\x09]+')"
COLLOCATIONS_SQL = rf"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(coalesce(translate(text, '{UPPER}', '{UPPER.lower()}'), ''), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
w AS (
    SELECT lang, {_WORDS} AS words FROM p),
m AS (
    SELECT lang, words, unnest(range(1, {LONGEST + 1})) AS length FROM w),
s AS (
    SELECT lang, length, words, unnest(range(1, len(words) - length + 2)) AS pos FROM m WHERE len(words) >= length),
f AS (
    SELECT lang, length, array_to_string(words[pos:pos + length - 1], ' ') AS phrase, count(*) AS f FROM s GROUP BY ALL),
n AS (
    SELECT lang, sum(f) AS n FROM f WHERE length = 1 GROUP BY lang),
c AS (
    SELECT lang, length, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE length > 1 AND f >= {SUPPORT}),
k AS (
    SELECT lang, phrase, a, words, unnest(range(1, length)) AS k FROM c),
x AS (
    SELECT k.lang, k.phrase, k.a, k.k, h.f AS l, t.f AS r, (CAST({SCORE_SCALE} AS HUGEINT) * k.a) // (CAST(h.f AS HUGEINT) + t.f) AS score
    FROM k JOIN f h ON k.lang = h.lang AND h.phrase = array_to_string(k.words[1:k.k], ' ')
    JOIN f t ON k.lang = t.lang AND t.phrase = array_to_string(k.words[k.k + 1:], ' ')
    QUALIFY row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY score, k.k) = 1),
i AS (
    SELECT lang, a, words, length, unnest(range(2, length)) AS m FROM c WHERE length > 2),
j AS (
    SELECT lang, a, words, m, unnest(range(1, length - m + 2)) AS pos FROM i),
g AS (
    SELECT lang, array_to_string(words[pos:pos + m - 1], ' ') AS phrase, max(a) AS longer FROM j GROUP BY ALL),
z AS (
    SELECT x.*, row_number() OVER (PARTITION BY x.lang ORDER BY x.score DESC, x.a DESC, x.phrase) AS rank
    FROM x LEFT JOIN g ON x.lang = g.lang AND x.phrase = g.phrase WHERE g.longer IS NULL OR 100 * g.longer < {ABSORBED_PERCENT} * x.a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM z JOIN n USING (lang) WHERE rank <= {TOP}
"""
