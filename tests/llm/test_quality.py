import random

import numpy as np

from tidecart.llm import quality

DOCS = "doc_id long, text string, label string, stats int"


def text(rng, good):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(20, 120))]
    if not good:
        return " | ".join(words) if rng.random() < 0.5 else " ".join(w.upper() + "!!" for w in words)
    return "\n".join(" ".join(words[i:i + 9]).capitalize() + "." for i in range(0, len(words), 9))


def corpus(n=400):
    rng = random.Random(2)
    return [(i, text(rng, i % 4 > 0), int(i % 4 > 0)) for i in range(n)]


def test_held_out_scores(spark):
    rows = corpus()
    odd = [(1000, None, "x", 1), (1001, "", "x", 1), (None, "Some words here.", "x", 1), (1002, " \n ", "x", 1), (1003, "w " * 300_000, "x", 1)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows] + odd, DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5] + [(1, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    assert len(got) == 405 and all(0 <= s <= 1 for s in got.values())
    held = [(got[i] >= 0.3) == bool(y) for i, _, y in rows if i % 5 == 0]
    assert sum(held) / len(held) > 0.97


def test_normal_equations_and_calibration_match_one_task(spark):
    rows = corpus(200)
    stats = np.array([quality.statistics(t) for _, t, _ in rows])
    label, fold = np.array([y for *_, y in rows], float), np.arange(200) % 5
    df = spark.createDataFrame([(s.tolist(), int(y), int(k)) for s, y, k in zip(stats, label, fold)], "stats array<double>, label int, fold int")
    model = quality.fit(df.repartition(7))
    z = model.cosines(stats)
    penalty = quality.RIDGE * np.eye(z.shape[1])
    penalty[0, 0] = 1e-6
    assert np.allclose(model.weights, np.linalg.solve(z.T @ z + penalty, z.T @ label), atol=1e-8)
    assert np.all(np.diff(model.levels) >= 0)
    # cosines approximate the kernel
    a = np.clip((stats[:40] - model.mean) / model.scale, -quality.CLIP, quality.CLIP)
    kernel = np.exp(-quality.GAMMA * ((a[:, None] - a[None]) ** 2).sum(-1))
    assert np.abs(z[:40, 1:] @ z[:40, 1:].T - kernel).mean() < 0.06


def test_pooling_is_isotonic_regression():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = rng.integers(1, 9)
        total = rng.integers(1, 6, n).astype(float)
        good = np.floor(rng.random(n) * (total + 1))
        got = quality.pooled(good, total)
        y, w = good / total, total
        # the min-max formula of isotonic regression
        want = [max(min(np.average(y[a:b + 1], weights=w[a:b + 1]) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        assert np.allclose(got, want)


def test_no_rows(spark):
    docs = spark.createDataFrame([(1, "a", "x", 1)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality_scores(docs, none).first().score == 0.5
    assert quality.quality_scores(docs.limit(0), none).count() == 0
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert 0 <= quality.quality_scores(docs, one).first().score <= 1
