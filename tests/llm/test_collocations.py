import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidecart.llm import collocations as col


def brute(docs, support, longest=4, top=2000):
    counts, sizes = {}, Counter()
    for lang, text in docs:
        lang = lang if lang is not None else "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall(r"[^ \t]+", piece)
            sizes[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i:i + m])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        gone = {p[i:i + m] for p, a in often.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
                if 100 * a >= 80 * often[p[i:i + m]]}
        rows = []
        for p, a in often.items():
            if p not in gone:
                score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top]):
            out.append((lang, rank + 1, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def corpus():
    rng = random.Random(4)
    words = ["new", "York", "is", "the", "of", "É", "日本", "e f", "w1", "w2", "w3"]
    docs = []
    for i in range(150):
        lang = rng.choice(["en", "en", "de", None, "und"])
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts.append(rng.choice(["new york city is", "the of the", rng.choice(words), rng.choice(words)]))
            parts.append(rng.choice([" ", " ", "  ", "\t", ". ", "\n", ",", " ;", "\x0b"]))
        docs.append((lang, "".join(parts)))
    return docs + [("en", None), ("en", ""), (None, " .,\n"), ("fr", "x"), ("en", "the of " * 3000)]


@pytest.mark.parametrize("shard_words, bits", [(100, 20), (2000, 20), (10 ** 7, 20), (100, 8)])
def test_phrases_match_brute_force(spark, shard_words, bits):
    docs = corpus()
    table = spark.createDataFrame([(a, b, 1, "x") for a, b in docs], "lang string, text string, n int, phrase string").repartition(3)
    got = col.collocations(table, support=5, shard_words=shard_words, table_bits=bits).collect()
    want = brute(docs, 5)
    assert sorted(tuple(r) for r in got) == want and len(want) > 50
    few = col.collocations(table, support=5, top=4, shard_words=shard_words, table_bits=20).collect()
    assert sorted(tuple(r) for r in few) == [r for r in want if r[1] <= 4]


def test_empty_table(spark):
    assert col.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_texts_are_divided_into_words_once(spark):
    met = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        met.add(1)
        return text

    table = spark.createDataFrame([("en", "a b c d. a b c")] * 60, "lang string, text string").withColumn("text", seen("text"))
    got = {r.phrase: r.a for r in col.collocations(table, support=5, shard_words=50).collect()}
    assert got == {"a b c": 120, "a b c d": 60} and met.value == 60


def test_a_shard_is_read_as_it_was_written():
    writer = col.Writer()
    writer.add("en", "New york. new".encode())
    writer.add("de", "new É".encode())
    shard = col.Shard(*writer.row())
    named = [(shard.langs[i], w.decode()) for i, w in zip(shard.of, shard.words)]
    assert [named[n] if n else "." for n in shard.numbers] == [
        ("en", "new"), ("en", "york"), ".", ("en", "new"), ".", ("de", "new"), ("de", "É"), "."]
    assert len(set(shard.hashes()[shard.numbers[shard.numbers > 0]].tolist())) == 4


def test_phrases_of_four_words_are_mined_by_their_parts_of_three():
    import numpy as np

    words = np.array([col.mixed(np.array([n], np.uint64), 1, np.arange(1))[0] for n in range(1, 6)])
    table = np.zeros(1 << 17, np.uint8)
    for length in (1, 2, 3):  # all words and pairs of the five, but the first three together only
        for key in col.mixed(words, length, np.arange(6 - length if length < 3 else 1)):
            slot = int(key) & ((1 << 20) - 1)
            table[slot >> 3] |= 1 << (slot & 7)
    assert col.phrase_hashes(words, np.arange(3), 3, table)[0].tolist() == [0, 1, 2]
    assert col.phrase_hashes(words, np.arange(2), 4, table)[0].tolist() == []


def test_mined_keys_are_short(spark):
    table = spark.createDataFrame([("en", "a b c d")] * 60, "lang string, text string")
    shards = col.sharded(table, "lang", "text", 50)
    import numpy as np

    found = col.passed(shards, [], [2], np.full(1 << 17, 255, np.uint8), {"en": 240}, 5, 50).collect()
    assert len(found) == 3 and all(0 <= r.key < 1 << 40 for r in found)


def test_mined_keys_travel_in_blocks(spark):
    import numpy as np

    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(40)]
    pairs = Counter(p for t in texts for p in zip(t.split(), t.split()[1:]))
    shards = col.sharded(spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(2), "lang", "text", 800)
    found = col.mined_keys(shards, [2], np.full(1 << 17, 255, np.uint8), {"en": 16000}, 3, 800)  # as many shards as the support
    assert found.count() == sum(n >= 3 for n in pairs.values()) > 0
    keys = np.sort(np.array([rng.getrandbits(30) for _ in range(5000)]))
    counts = np.array([rng.choice([1, 1, 1, 1, 300]) for _ in keys])
    block = col.packed(keys, counts)
    assert len(block) < 5 * len(keys)  # a row of key and count took nine bytes of a compressed shuffle
    assert [x.tolist() for x in col.unpacked(block)] == [keys.tolist(), counts.tolist()]


def test_buckets_grow_with_the_corpus():
    assert col.bucket_bits(0) == col.bucket_bits(10 ** 9) == 10
    assert all(words >> col.bucket_bits(words) <= col.BUCKET_WORDS for words in (10 ** 10, 10 ** 11, 10 ** 12))
