import random
import zlib
from array import array

import pytest

from tidecart.llm import packing

TOKENIZER = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    with open(TOKENIZER, encoding="utf-8") as f:
        return packing.WordEncoder(f.read())


def test_ids_are_those_of_the_tokenizer(encoder):
    rng = random.Random(0)
    parts = [" ", "\n", " ", "a", "B", "The", ".", ",", "1", "23", "é", "'s", "'", "\t", "\xa0", "\n\n", "<|endoftext|>", "日", "\x01", "#", "\U0001f600"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    for t in texts:
        assert encoder.encode(t) == array("I", encoder.whole(t)).tobytes(), repr(t)


def test_pieces():
    ids = array("I", range(10)).tobytes()
    assert packing.pieces_of(ids, 4) == ([0, 2, 6], [2, 4, 4], [zlib.crc32(array("I", r).tobytes()) for r in (range(2), range(2, 6), range(6, 10))])
    assert packing.pieces_of(ids, 10)[:2] == ([0], [10])
    assert packing.pieces_of(ids, 5)[:2] == ([0, 5], [5, 5])
    assert packing.pieces_of(b"\2\0\0\0", 4)[:2] == ([0], [1])


def test_best_fit_is_that_of_a_plain_search():
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randint(1, 40) for _ in range(rng.randint(0, 60))]
        loads = []
        for s in sorted(sizes, reverse=True):
            fits = [b for b in range(len(loads)) if loads[b] + s <= 50]
            if fits:
                loads[max(fits, key=lambda b: loads[b])] += s
            else:
                loads.append(s)
        got = packing.best_fit(sizes, 50)
        assert sorted(sum(sizes[i] for i in b) for b in got) == sorted(loads)
        assert sorted(i for b in got for i in b) == list(range(len(sizes)))


def check(rows, capacity, count):
    assert len(rows) == count
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("window", [200_000, 300])
def test_rounds_lose_nothing_and_pack_well(spark, monkeypatch, window):
    monkeypatch.setattr(packing, "TASK_PIECES", window)
    rng = random.Random(4)
    sizes = [rng.choice([1, 7, 60, 300, 511, 513, 900, 1024, rng.randint(1, 1024)]) for _ in range(4000)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "i long, length long").repartition(20)
    rows = packing.pack(df).collect()
    assert {r.i: r.length for r in rows} == dict(enumerate(sizes))
    assert check(rows, 1024, 4000) <= 1.02 * len(packing.best_fit(sizes, 1024))


def test_sizes_that_never_pair_end_the_rounds(spark):
    df = spark.range(2000).selectExpr("id as i", "600L as length").repartition(16)
    assert check(packing.pack(df).collect(), 1024, 2000) == 2000


def test_documents_round_trip(spark, encoder):
    texts = [None, "", "a", "the cat sat\non the mat. " * 900, "  \n\n\t é日本 \U0001f600", "x", "x"]
    docs = spark.createDataFrame([(i, t, "p") for i, t in enumerate(texts)] + [(5, "x", "p")], "doc_id long, text string, piece string")
    rows = packing.packed_documents(docs.select("doc_id", "text"), ["doc_id"], TOKENIZER).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for i, t in enumerate(texts):
        ids = encoder.whole(t or "") + [2]
        at = 0
        copies = 2 if i == 5 else 1
        assert sum(n for _, _, n, _ in got[i]) == copies * len(ids)
        for piece, start, n, crc in sorted(set(got[i])):
            assert start == at and n <= 1024 and crc == zlib.crc32(array("I", ids[at:at + n]).tobytes())
            at += n
    check(rows, 1024, len(rows))
    assert packing.packed_documents(docs.select("doc_id", "text").limit(0), ["doc_id"], TOKENIZER).count() == 0
