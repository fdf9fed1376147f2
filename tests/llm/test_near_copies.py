import random

import pytest

from tidecart.llm import near_copies, simhash

SCHEMA = "doc_id long, text string"


def shingles(text, width=5):
    words = (text or "").lower().split()
    return {" ".join(words[i:i + width]) for i in range(len(words) - width + 1)} or ({" ".join(words)} if words else set())


def alike(x, y):
    return len(x & y) * 9 >= (len(x) + len(y)) * 4


def all_pairs(texts):
    sets = [shingles(t) for t in texts]
    return {(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and texts[i] != texts[j] and alike(sets[i], sets[j])}


def roots_of(pairs, n):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def edited(rng, words, n_edits, vocabulary):
    out = list(words)
    for _ in range(n_edits):
        out[rng.randrange(len(out))] = rng.choice(vocabulary)
    return out


def linked(spark, texts):
    """The links as places of texts."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    place = {r.h: r.doc_id for r in df.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    return {tuple(sorted((place[r.a], place[r.b]), reverse=True)) for r in near_copies.similar_links(df).collect()}


def test_links_against_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts = []
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(40, 400))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            texts.append(" ".join(edited(rng, base, rng.randint(1, max(1, len(base) // 40)), vocabulary)))
    texts = list(dict.fromkeys(texts))
    want, got = all_pairs(texts), linked(spark, texts)
    assert got <= want
    truth, found = roots_of(want, len(texts)), roots_of(got, len(texts))
    assert sum(found[i] == found[j] for i, j in want) >= 0.98 * len(want) > 0
    assert sum(f != i for i, f in enumerate(found)) >= 0.98 * sum(t != i for i, t in enumerate(truth))


def test_large_groups_and_unlike_texts_with_a_common_passage(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = [rng.choice(vocabulary) for _ in range(300)]
    group = list(dict.fromkeys(" ".join(edited(rng, base, 2, vocabulary)) for _ in range(150)))
    passage = [rng.choice(vocabulary) for _ in range(80)]
    shared = [" ".join(passage + [rng.choice(vocabulary) for _ in range(25)]) for _ in range(120)]
    got = linked(spark, group + shared)
    found = roots_of(got, len(group) + len(shared))
    assert all(found[i] == 0 for i in range(len(group)))
    assert all(found[i] == i for i in range(len(group), len(found)))
    assert len(got) < 6 * len(group)  # no pairs within a group


def test_stage_keeps_one_of_each(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(2000)]
    base = [rng.choice(vocabulary) for _ in range(200)]
    near = " ".join(edited(rng, base, 3, vocabulary))
    other = " ".join(rng.choice(vocabulary) for _ in range(200))
    rows = [(4, " ".join(base), 1), (2, near, 2), (9, near.upper(), 3), (9, near.upper(), 3), (7, other, 4), (8, None, 5), (11, "", 6), (None, other, 7),
            (12, "three short words", 8), (13, "Three  short words", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bands int")
    kept = simhash.one_of_each(docs, similar=near_copies.similar_links(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 8, 12]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, ""), (2, "")], [(1, "one text"), (1, "one text")]])
def test_tables_without_links(spark, rows):
    assert near_copies.similar_links(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_long_text_is_taken_whole():
    multipliers = near_copies._multipliers()
    words = [str(i) for i in range(30_000)]
    bands, sets = near_copies.sketch_of(" ".join(words), multipliers)
    assert len(bands) == near_copies.BANDS and 29_900 < len(sets) <= 29_996
    changed, _ = near_copies.sketch_of(" ".join(words[:-1] + ["x"]), multipliers)
    assert (bands == changed).sum() >= near_copies.BANDS - 1


def test_only_the_links_stay_in_the_shared_folder(spark, tmp_path, monkeypatch):
    from tidecart import session

    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    docs = spark.createDataFrame([(1, text), (2, text + " one"), (3, "no such words here at all")], SCHEMA)
    monkeypatch.setattr(session, "shared_folder", lambda s: f"file://{tmp_path}")
    with session.pinned_tables():
        with session.pinned_tables():
            session.pin(docs)
        assert near_copies.similar_links(docs).count() == 1
        assert len(list(tmp_path.iterdir())) == 1
    assert list(tmp_path.iterdir()) == []
