import random

import pytest
import xxhash

from tidecart.llm import simhash

SCHEMA = "doc_id long, text string"


def brute_fingerprint(text, width=3):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Smallest id reachable, by union over all pairs."""
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in fps:
        for j in fps:
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in fps}


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["É", "ß", "DE", "日本"]
    texts = [None, "", "  \n\t ", "One", "one", "a B c", "A b C d"]
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(5, 400))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(words)
            texts.append("\n".join(near))
        texts.append(" ".join(base))
    texts.append(" ".join(rng.choice(words) for _ in range(70_000)))
    return texts


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_and_components_match_brute_force(spark):
    texts = corpus()
    got = {r.id: r for r in simhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: r.fp for i, r in got.items()} == {i: signed(f) for i, f in fps.items()}
    assert {i: r.component for i, r in got.items()} == brute_components(fps)


@pytest.mark.parametrize("crowded", [0, 3, 64])
def test_links_join_all_pairs_within_two_bits(spark, crowded):
    rng = random.Random(1)
    fps = {0, 1, (1 << 63), (1 << 63) | 1}
    for _ in range(30):
        f = rng.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            if rng.random() < 0.3:
                fps.add(f & 0xFFFFFFFF | rng.getrandbits(32) << 32)  # a crowded bucket of unlike fingerprints
            for _ in range(rng.choice([1, 2, 2, 3])):
                f ^= 1 << rng.randrange(64)
    fps = sorted(signed(f) for f in fps)
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), crowded)
    assert all(bin((r.a ^ r.b) & (2 ** 64 - 1)).count("1") <= 2 for r in edges.collect())
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    want = brute_components({f: f & (2 ** 64 - 1) for f in fps})
    assert {f: got.get(f, f) for f in fps} == want


def test_one_row_of_each_group_stays(spark):
    rows = [(7, "a b c d", 1), (3, "a b c d", 2), (3, "a b c d", 2), (None, "a b c d", 3), (5, "x y z", 4), (None, None, 5), (None, "", 6), (9, "x  y\nz", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __text_hash long")
    kept = simhash.one_of_each(docs).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id is not None) == [(3, "a b c d"), (5, "x y z")]
    assert len([r for r in kept if r.doc_id is None]) == 1
    assert kept[0].asDict().keys() == {"doc_id", "text", "__text_hash"}


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_tiny_tables(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert simhash.near_duplicates(df).count() == len(rows)
    assert simhash.one_of_each(df).count() == len(rows)
