import random

import numpy as np
from pyspark.sql import functions as F

from tidecart.llm import toxicity

DOCS = "doc_id long, text string, score string, toxic int"
BAD = ["vileword", "nastyone", "grimterm"]


def corpus(rng, n=500):
    rows = []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(rng.randint(10, 80))]
        hits = rng.choice([0, 0, 0, 1, 2])
        for _ in range(hits):
            words.insert(rng.randrange(len(words)), rng.choice(BAD).upper() + rng.choice(["", ",", "!"]))
        rows.append((i, " ".join(words), int(hits > 0)))
    return rows


def test_held_out_rows(spark):
    rows = corpus(random.Random(3))
    odd = [(9000, None, "x", 1), (9001, "", "x", 1), (None, "vileword " * 50_000, "x", 1), (9002, "a" * 300_000, "x", 1)]
    docs = spark.createDataFrame([(i, t, "x", 9) for i, t, _ in rows] + odd, DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 4] + [(0, None), (None, 1)], "doc_id long, toxic int")
    chain = toxicity.fit(docs, labels, ["toxic"], derive=toxicity.graded)
    found = toxicity.predict(docs, chain, ["a", "b", "c"], ["doc_id"])
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == 504
    held = [(got[i].c >= toxicity.THRESHOLD) == bool(y) for i, _, y in rows if i % 4 == 0]
    assert sum(held) / len(held) > 0.97
    assert got[None].c > 0.9 and got[9000].c < 0.2 and got[9000].c == got[9001].c == got[9002].c
    hits = {i: sum(w.strip(",!").lower() in BAD for w in t.split()) for i, t, _ in rows}
    twice = [got[i].b for i, t, _ in rows if len({w.strip(",!").lower() for w in t.split()} & set(BAD)) >= 2]
    never = [got[i].b for i in hits if not hits[i]]
    assert np.mean(twice) > 0.6 > 0.2 > np.mean(never)


def test_the_chain_uses_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    x = (rng.random((300, 6)) < 0.4).astype(float)
    first = (rng.random(300) < 0.1 + 0.7 * x[:, 0]).astype(float)
    y = np.stack([first, np.maximum(first, x[:, 1])], axis=1)
    fold = np.arange(300) % toxicity.FOLDS
    one, two = toxicity.train(x, y, fold, 6)
    assert len(one) == 7 and len(two) == 8
    held = np.zeros(300)
    for f in range(toxicity.FOLDS):
        held[fold == f] = toxicity.probability(x[fold == f], toxicity.logistic(x[fold != f], y[fold != f, 0]))
    assert np.allclose(two, toxicity.logistic(np.hstack([x, held[:, None]]), y[:, 1]))
    # the gradient vanishes at the weights
    z = np.hstack([x, np.ones((300, 1))])
    penalty = np.r_[np.full(6, toxicity.RIDGE), 1e-3]
    assert np.abs(z.T @ (1 / (1 + np.exp(-z @ one)) - y[:, 0]) + penalty * one).max() < 1e-4


def test_telling_words_match_brute_force(spark):
    rng = random.Random(5)
    data = [(sorted({rng.choice("abcdefghij") * 2 for _ in range(4)} | ({"zz"} if y and rng.random() < 0.8 else set())), y)
            for y in [int(rng.random() < 0.3) for _ in range(300)]]
    df = spark.createDataFrame(data, "words array<string>, y int")
    n, n1 = len(data), sum(y for _, y in data)

    def ratio(word):
        table = [[sum((word in w) == a and y == b for w, y in data) for b in (1, 0)] for a in (True, False)]
        rows, cols = [sum(r) for r in table], [n1, n - n1]
        return 2 * sum(o * np.log(o * n / (rows[i] * cols[j])) for i, r in enumerate(table) for j, o in enumerate(r) if o)

    want = [w for w in sorted({w for ws, _ in data for w in ws}, key=lambda w: -ratio(w)) if ratio(w) >= toxicity.MIN_RATIO]
    assert toxicity.telling_words(df, F.col("y")) == want and "zz" in want


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a", "x", 1), (2, None, "x", 1)], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(docs, none, ["toxic"], derive=toxicity.graded) is None
    assert [r.c for r in toxicity.predict(docs, None, ["c"], ["doc_id"]).collect()] == [0.0, 0.0]
    same = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    chain = toxicity.fit(docs, same, ["toxic"], derive=toxicity.graded)
    assert all(r.c < 0.5 for r in toxicity.predict(docs, chain, ["a", "b", "c"], ["doc_id"]).collect())
    assert toxicity.predict(docs.limit(0), chain, ["a", "b", "c"], ["doc_id"]).count() == 0
