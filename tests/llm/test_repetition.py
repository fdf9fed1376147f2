import random
from collections import Counter

from tidecart.llm import repetition as rules

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]


def brute(text):
    text = text or ""
    words = text.encode().split()
    n = len(words)
    windows = Counter(tuple(words[i:i + 3]) for i in range(n - 2))
    repeated, covered, longest = set(), set(), 0
    for i in range(n - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            repeated.update(range(i, i + 3))
    for i in range(n):
        for j in range(i):
            k = 0
            while i + k < n and words[i + k] == words[j + k]:
                k += 1
            if k >= 3:
                longest = max(longest, k)
            if k >= rules.MIN_REPEAT:
                covered.update(range(i, i + k))
                covered.update(range(j, j + k))
    lines = [x for x in text.split("\n") if x.encode().split()]
    return [n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(repeated), len(covered), longest]


def texts():
    rng = random.Random(3)
    out = [None, "", " \n\t", "one", "a b c a b c", "For " * 200, "x y " * 60, "a b c d #*$%&|<> é日本 \U0001f600\nz\nz\n \nz"]
    for _ in range(60):
        pool = [f"w{i}" for i in range(rng.choice([3, 20, 400]))]
        words = [rng.choice(pool) for _ in range(rng.randint(1, 150))]
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(words))
            words += words[i:i + rng.randint(1, 60)]
        out.append(" ".join(w + rng.choice(["", "", "\n"]) for w in words))
    return out + out[10:14]


def test_figures_match_brute_force(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    got = {r.doc_id: [r[n] for n in NAMES] for r in rules.figures(docs, ["doc_id"]).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts())}
    monkeypatch.setattr(rules, "_CHUNK_WORDS", 50)
    assert [list(map(int, x)) for x in zip(*rules.chunk_figures([t.encode().split() if t else [] for t in texts()], 8))] == [
        brute(t)[4:] for t in texts()]


def test_very_long_text():
    words = [b"w%d" % (i % 1_200_003) for i in range(1_200_100)]
    assert [int(x[0]) for x in rules.chunk_figures([words], 8)] == [194, 194, 97]


def test_rows_pass_whole(spark):
    prose = " ".join(f"word{i}" for i in range(60))
    passage = " ".join(f"p{i}" for i in range(30))
    filler = " ".join(f"f{i}" for i in range(70))
    rows = [(1, prose, "x", None), (None, prose, None, 1), (2, prose[:100], "y", 2), (3, "For " * 300, "z", 3), (4, None, "n", 4),
            (2 ** 60 + 1, f"{passage} {filler} {passage}", "r", 5), (1, prose, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    kept = rules.without_repetitive(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if r.text == prose)
    row = rules.verdicts(rules.figures(docs.where("text like 'p0%'"), ["doc_id"])).first()
    assert not row.base_failed and not row.kept and row.doc_id == 2 ** 60 + 1 and row.covered_words == 60
    assert rules.without_repetitive(docs.limit(0)).count() == 0
