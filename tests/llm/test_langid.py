import itertools
import random

import numpy as np

from tidecart.llm import langid

SCHEMA = "doc_id long, text string, lang string"
PARTS = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sche", "brin", "gulf", "dorn"], "ru": ["мол", "ста", "кри", "вод"]}


def words(rng, lang, n):
    return ["".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def rows(rng):
    out = []
    for i in range(240):
        lang = rng.choice(sorted(PARTS))
        out.append((i, " ".join(words(rng, lang, rng.randint(3, 60))), lang))
    return out


def test_path_is_the_best_of_all_paths():
    rng = np.random.default_rng(0)
    for penalty in (0.0, 0.7, 3.0):
        lengths = np.array([0, 1, 5, 0, 6, 3, 6])
        starts = np.cumsum(lengths) - lengths
        scores = rng.normal(size=(lengths.sum(), 3)).astype(np.float32)
        path = langid.paths(scores, starts, lengths, penalty)
        value = lambda s, p: sum(s[t, k] for t, k in enumerate(p)) - penalty * sum(a != b for a, b in zip(p, p[1:]))
        for s, n in zip(starts, lengths):
            own = scores[s:s + n]
            best = max(value(own, p) for p in itertools.product(range(3), repeat=n)) if n else 0
            assert n == 0 or abs(value(own, tuple(path[s:s + n])) - best) < 1e-4


def test_held_out_accuracy_and_spans(spark):
    rng = random.Random(7)
    data = rows(rng)
    docs = spark.createDataFrame(data, SCHEMA)
    model = langid.fit(docs.where(langid.learnable()))
    mixed = words(rng, "aa", 30) + words(rng, "bb", 25) + words(rng, "ru", 20)
    odd = words(rng, "aa", 20) + words(rng, "bb", 1) + words(rng, "aa", 20)
    more = [(1000, " ".join(mixed), None), (1001, " ".join(odd), None), (1002, None, "aa"), (1003, "123 !?", None), (1004, "", "bb"),
            (None, "ka lo", None), (1005, "ка" * 40_000 + " ka", None)]
    all_docs = docs.unionAll(spark.createDataFrame(more, SCHEMA))
    got = {r.doc_id: r for r in langid.predict(all_docs, model, ["doc_id"], spans=True).collect()}
    held = {r.doc_id for r in docs.where(~langid.learnable()).collect()}
    right = [got[i].lang_pred == lang for i, _, lang in data if i in held]
    assert held and sum(right) / len(right) > 0.97
    text = " ".join(mixed)
    spans = [(s.lang, text[s.start:s.end]) for s in got[1000].lang_spans]
    assert spans == [("aa", " ".join(mixed[:30])), ("bb", " ".join(mixed[30:55])), ("ru", " ".join(mixed[55:]))]
    assert got[1000].lang_pred in PARTS and got[1000].n_spans == 3 and 0.2 < got[1000].score < 0.9
    assert got[1001].lang_pred == "aa"
    stiff = langid.predict(all_docs.where("doc_id = 1001"), model, ["doc_id"], penalty=200.0).first()
    assert stiff.n_spans == 1 < got[1001].n_spans  # the penalty is what keeps an odd word from breaking a span
    for i in (1002, 1003, 1004):
        assert (got[i].lang_pred, got[i].score, got[i].n_spans) == ("und", 0.0, 0)
    assert got[None].lang_pred == "aa" and got[1005].lang_pred == "ru"


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "ka lo", None)], SCHEMA)
    assert langid.fit(docs) is None
    assert langid.predict(docs, None, ["doc_id"], spans=True).first().lang_pred == "und"
    model = langid.fit(spark.createDataFrame([(1, "ka lo", "aa")], SCHEMA))
    assert langid.predict(docs.limit(0), model, ["doc_id"]).count() == 0
    assert langid.predict(docs, model, ["doc_id"]).first().lang_pred == "aa"


def test_bounded_sample_learns_from_each_language(spark):
    docs = spark.createDataFrame(rows(random.Random(1)), SCHEMA)
    model = langid.fit(docs, train_docs=25)
    assert model.languages == sorted(PARTS)
    good = langid.predict(docs, model, ["lang"]).where("lang = lang_pred").count()
    assert good > 230


def test_long_texts_are_labelled_as_in_exact_arithmetic():
    rng = np.random.default_rng(3)
    n, k, penalty = 600_000, 3, 8
    whole = rng.integers(-30_000, -29_990, (n, k))  # near ties; sums reach two times ten to the tenth
    path = langid.paths(whole.astype(np.float32), np.array([0]), np.array([n]), float(penalty))
    best = [int(x) for x in whole[0]]
    for row in whole[1:].tolist():
        top = max(best) - penalty
        best = [max(b, top) + x for b, x in zip(best, row)]
    value = int(whole[np.arange(n), path].sum()) - penalty * int((path[1:] != path[:-1]).sum())
    assert value == max(best)


def test_only_letters_are_words(spark):
    assert langid.words_of("ka½lo ² Ⅷ① mi_tu 5x 一二") == ["ka", "lo", "mi", "tu", "x", "一二"]
    model = langid.fit(spark.createDataFrame([(1, "ka lo", "aa"), (2, "sche brin", "bb")], SCHEMA))
    docs = spark.createDataFrame([(1, "½", None), (2, "² ⅷ ①", None), (3, "½ka ²", None)], SCHEMA)
    got = {r.doc_id: r for r in langid.predict(docs, model, ["doc_id"], spans=True).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und", "und", "aa"]
    assert [(s.start, s.end) for s in got[3].lang_spans] == [(1, 3)]


def test_word_scores_and_scripts_match_brute_force(spark):
    late = " ".join(["ka lo"] * 300 + ["мол ста"] * 300)  # the second script comes after 600 words
    texts = [("aa", late), ("bb", "sche brin gulf"), ("ru", "мол ста кри")]
    model = langid.fit(spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(texts)], SCHEMA))
    number = {g: i for i, g in enumerate(model.languages)}
    assert [model.scripts["Cyrillic"][number[g]] for g in ("aa", "bb", "ru")] == [True, False, True]
    assert [model.scripts["Latin"][number[g]] for g in ("aa", "bb", "ru")] == [True, True, False]
    counts = np.full((langid.BUCKETS, 3), 0.5)
    for g, t in texts:
        for w in t.split():
            for b in langid.gram_buckets([w])[0]:
                counts[b, number[g]] += 1
    logs = np.log(counts / counts.sum(axis=0))
    for w in ("ka", "brin", "мол"):
        buckets = langid.gram_buckets([w])[0]
        want = logs[buckets].mean(axis=0) * len(w) ** 0.5
        want = [x if model.scripts[langid.script_of(w)][k] else x - 1e3 for k, x in enumerate(want)]
        assert np.allclose(model.word_scores([w])[0], want, rtol=1e-5)
