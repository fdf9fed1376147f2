import random
import re

import pytest

from tidecart.llm import decontamination as dec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    """Per text: number of words, words hit, ids of the items with an occurring window."""
    wins = []
    for item, text in items:
        w = words(text)
        wins += [(item, w[i:i + window]) for i in range(max(1, len(w) - window + 1)) if w]
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for item, win in wins:
            for i in range(len(w) - len(win) + 1):
                if w[i:i + len(win)] == win:
                    hit |= set(range(i, i + len(win)))
                    found |= {str(item)} if item is not None else set()
        out.append((len(w), len(hit), sorted(found)))
    return out


def corpus():
    rng = random.Random(6)
    pool = ["a", "b", "c", "d", "É", "日本", "x1", "the"]
    text = lambda n: "".join(rng.choice(pool) + rng.choice([" ", ", ", "\n", "-", "\x7f"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 6, 9, 20]))) for i in range(25)]
    items += [(3, text(7)), (None, text(5)), (90, None), (91, " ,;"), (92, items[0][1].upper()), (93, "the the the the the the")]
    docs = [text(rng.choice([0, 1, 4, 30, 200])) for _ in range(60)] + [None, "", " .,", "the " * 300]
    docs += [rng.choice(docs[:60]) + t[1] for t in items[:20]] + [items[5][1]] * 4
    return docs, items


@pytest.mark.parametrize("window, block_bytes", [(5, 1 << 20), (5, 300), (3, 1 << 20)])
def test_hits_match_brute_force(spark, monkeypatch, window, block_bytes):
    docs, items = corpus()
    monkeypatch.setattr(dec, "_PAIRS", 50)
    monkeypatch.setattr(dec, "_CHUNK", 40)
    rows = [(i if i % 9 else None, t, i, 1) for i, t in enumerate(docs)] + [(1, docs[1], 1, 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_words int, windows int")
    bench = spark.createDataFrame([(a, b, 5) for a, b in items], "item_id long, text string, w int")
    got = dec.contamination(table, bench, window=window, block_bytes=block_bytes).collect()
    want = brute(docs, items, window)
    key = lambda doc_id, n, hit, found: (str(doc_id), n, hit, found)
    assert sorted(key(r.doc_id, r.n_words, r.n_hit, r.items) for r in got) == sorted(
        key(r[0], *want[i if i < len(docs) else 1]) for i, r in enumerate(rows))
    assert all(r.n_items == len(r.items) and r.contaminated == (r.n_hit > 0) for r in got)
    assert all(sum(s.stop - s.start for s in r.spans) == r.n_hit for r in got)


def test_a_share_of_the_shingles_finds_edited_passages(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"x {passage} y"), (2, f"x {passage} y".replace("ten", "more")), (3, "nothing of it")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, passage)], "item_id long, text string")
    strict = {r.doc_id: r.n_hit for r in dec.contamination(docs, bench).collect()}
    loose = {r.doc_id: r.n_hit for r in dec.contamination(docs, bench, share=0.8).collect()}
    assert (strict, loose) == ({1: 10, 2: 0, 3: 0}, {1: 10, 2: 10, 3: 0})


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "a b c")], "item_id long, text string")
    assert dec.contamination(docs.limit(0), bench).count() == 0
    assert [(r.n_words, r.n_hit, r.items) for r in dec.contamination(docs, bench.limit(0)).collect()] == [(3, 0, [])]
