import math
from collections import Counter
from hashlib import md5

from tidecart.llm import mixing

SCHEMA = "doc_id long, text string, source string, copy string"


def brute_copies(doc_id, rate, seed):
    parts = max(1, math.ceil(rate / 16))
    mean, count = rate / parts, 0
    for i in range(1, parts + 1):
        u = int(md5(f"{seed}/{doc_id}/{i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        p = total = math.exp(-mean)
        k = 0
        while total <= u:
            k += 1
            p *= mean / k
            total += p
        count += k
    return count


def own_key(row):
    return f"null/{md5((row.text or '').encode()).hexdigest()}" if row.doc_id is None else row.doc_id


def corpus(spark):
    rows = [(i, "x" * (i % 50), "big", "c") for i in range(3000)] + [(5000 + i, "y" * 20, "small", None) for i in range(40)]
    rows += [(9000 + i, "z" * 5, None, "n") for i in range(5)] + [(9100, None, "empty", "e"), (None, "text", "big", "q")]
    return spark.createDataFrame(rows, SCHEMA)


def test_counts_match_brute_force(spark):
    docs = corpus(spark)
    for weights in (None, {"big": 1, "small": 9, None: 1}):
        rates = mixing.shares(docs, weights=weights)
        rate = {r.source: r.rate for r in rates.collect()}
        got = mixing.mix(docs, rates).collect()
        counts = Counter(r.doc_id for r in got)
        want = {r.doc_id: brute_copies(own_key(r), rate[r.source], mixing.SEED) for r in docs.collect()}
        assert counts == Counter({k: v for k, v in want.items() if v})
        assert all(sorted(r.copy for r in got if r.doc_id == d) == list(range(n)) for d, n in list(counts.items())[::97])
    sizes = Counter()
    for r in got:
        sizes[r.source] += len(r.text or "")
    total = sum(sizes.values())
    # big rate: one document counts many times, so the shares are near and not exact
    assert abs(sizes["small"] / total - 9 / 11) < 0.05 and abs(sizes["big"] / total - 1 / 11) < 0.03


def test_both_joins_draw_alike(spark, monkeypatch):
    docs = corpus(spark)
    one = mixing.mix(docs, mixing.shares(docs)).collect()
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
    two = mixing.mix(docs, mixing.shares(docs)).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_the_shuffle_spreads_a_hot_source(spark):
    docs = corpus(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mixed = mixing.mix(docs, mixing.shares(docs))
        parts = mixed.rdd.glom().map(lambda rows: [r.shuffle_key for r in rows]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(map(len, parts)) < 2 * sum(map(len, parts)) / len(parts)
    assert all(p == sorted(p) for p in parts)
    assert mixing.mix(docs.limit(0), mixing.shares(docs.limit(0))).count() == 0


def test_rows_without_ids_draw_by_their_texts(spark):
    docs = spark.createDataFrame([(None, f"text {i}", "s", None) for i in range(2000)] + [(None, None, "s", None), (None, "", "s", None)], SCHEMA)
    rates = mixing.shares(docs).selectExpr("source", "n_docs", "size", "1.0d rate")
    got = mixing.mix(docs, rates).collect()
    counts = Counter(r.text for r in got)
    assert all(counts[f"text {i}"] == brute_copies(own_key(r), 1.0, mixing.SEED) for i, r in enumerate(docs.collect()[:2000]))
    assert len({r.shuffle_key for r in got}) > 0.9 * len(got) and len(set(counts.values())) > 2
    assert counts[None] == counts[""]
