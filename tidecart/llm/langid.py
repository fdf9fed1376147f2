"""Language identification of mixed texts: script ranges, word scores, and Viterbi with a switching penalty.

A model holds, per language, the log-probabilities of hashed letter n-grams of words. The script of a
word (by code-point ranges) leaves as candidates the languages that use it. The path of
languages over the words of a text maximises the sum of word scores less a penalty for each change, so
single odd words don't break a span. The language of a text is the one with most letters on that path.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections import Counter
from itertools import chain

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart.llm._common import appended, bucket_of, column, kept_in_worker

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
SWITCH_PENALTY = 6.0
TRAIN_DOCS = 40_000       # labelled documents per language that a model learns from, at most about
SCRIPT_SHARE = 0.02       # of a language's letters, for a script to be one of its own
CACHED_WORDS = 400_000
UNKNOWN = "und"

# fixed values: code-point ranges of scripts
SCRIPTS = {
    "Latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
_WORD = re.compile(r"[^\W\d_]+")


def _letters_only(text: str | None) -> str:
    """The text with a blank for each sign that is no letter, if ``_WORD`` alone would take one (as numerals) for a letter."""
    text = text or ""
    return text if all(map(str.isalpha, _WORD.findall(text))) else "".join(c if c.isalpha() else " " for c in text)


def words_of(text: str | None) -> list[str]:
    """The words of a text: runs of letters."""
    found = _WORD.findall(text or "")
    return found if all(map(str.isalpha, found)) else _WORD.findall(_letters_only(text))


def script_of(word: str) -> str:
    """The script of a word's first letter, or 'Other'."""
    c = ord(word[0])
    for name, ranges in SCRIPTS.items():
        for low, high in ranges:
            if low <= c <= high:
                return name
    return "Other"


def gram_buckets(words: list[str]):
    """Buckets of the n-grams of each word (as ``_word_``, lower case): flat numbers and the word's place of each."""
    import numpy as np

    text = "".join(f"\x00{w.lower()}\x00" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    mark = codes == 0
    word = np.cumsum(mark) - 1 >> 1
    found, owner = [], []
    mixed = np.zeros(len(codes), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        size = len(codes) - n + 1
        if size <= 0:
            break
        mixed = mixed[:size] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:] + np.uint64(n)
        if n in GRAMS:
            inside = word[:size] == word[n - 1:]
            if n == 1:
                inside = inside & ~mark
            h = mixed[inside]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            found.append((h >> np.uint64(40)) % np.uint64(BUCKETS))
            owner.append(word[:size][inside])
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64), np.concatenate(owner) if owner else np.zeros(0, np.int64)


class Model:
    """Languages, their n-gram log-probabilities [BUCKETS, languages] and their scripts."""

    def __init__(self, languages: list[str], scores, scripts: dict[str, list[bool]]) -> None:
        self.languages, self.scores, self.scripts = languages, scores, scripts

    def word_scores(self, words: list[str]):
        """[words, languages]: mean n-gram score times the square root of the length; unlikely scripts are ruled out."""
        import numpy as np

        gram, owner = gram_buckets(words)
        total = np.zeros((len(words), len(self.languages)), np.float32)
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(owner, self.scores[gram, k], len(words))
        count = np.maximum(1, np.bincount(owner, minlength=len(words)))
        total *= (np.sqrt([len(w) for w in words]) / count)[:, None]
        every = [True] * len(self.languages)
        allowed = np.array([self.scripts.get(script_of(w), every) for w in words], bool).reshape(total.shape)
        return np.where(allowed, total, total - 1e3)


def _counts(docs: DataFrame, languages: list[str], lang_column: str, text_column: str) -> DataFrame:
    """(key, counts by language): n-gram buckets from 0, scripts after them."""
    number = {lang: i for i, lang in enumerate(languages)}
    names = [*SCRIPTS, "Other"]
    place = {name: i for i, name in enumerate(names)}

    def run(batches):
        import numpy as np
        import pyarrow as pa

        grams = np.zeros((len(languages), BUCKETS), np.int64)
        scripts = np.zeros((len(languages), len(names)), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                for at in range(0, len(words), 100_000):
                    times = Counter(words[at:at + 100_000])
                    gram, owner = gram_buckets(list(times))
                    weight = np.fromiter(times.values(), np.int64, len(times))
                    grams[number[lang]] += np.bincount(gram, weight[owner], BUCKETS).astype(np.int64)
                    for w, n in times.items():
                        scripts[number[lang], place[script_of(w)]] += len(w) * n
        both = np.concatenate([grams, scripts], axis=1)
        for i, lang in enumerate(languages):
            at = np.flatnonzero(both[i])
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "key": pa.array(at, pa.int64()), "n": pa.array(both[i, at], pa.int64())})

    source = docs.select(column(lang_column).cast("string"), column(text_column).cast("string"))
    return source.mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", id_column: str = "doc_id", train_docs: int = TRAIN_DOCS) -> Model | None:
    """Learn from rows with a language; about ``train_docs`` rows of each language are taken, by a hash of their id and text.

    Returns None where no row has a language and a text. What comes to the driver is a table of
    ``BUCKETS`` counts per language.
    """
    import numpy as np

    known = docs.where(column(lang_column).isNotNull() & column(text_column).isNotNull())
    sizes = known.groupBy(column(lang_column).cast("string").alias("lang")).count().collect()
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return None
    part = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, train_docs / r["count"]))])
    place = F.pmod(F.xxhash64(column(id_column), F.length(text_column)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = known.where(place < part[column(lang_column).cast("string")])
    scores = np.full((BUCKETS, len(languages)), 0.5, np.float64)
    names = [*SCRIPTS, "Other"]
    letters = np.zeros((len(names), len(languages)))
    found = _counts(sample, languages, lang_column, text_column).toPandas()
    lang = found["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int)
    key, n = found["key"].to_numpy(int), found["n"].to_numpy(float)
    gram = key < BUCKETS
    np.add.at(scores, (key[gram], lang[gram]), n[gram])
    np.add.at(letters, (key[~gram] - BUCKETS, lang[~gram]), n[~gram])
    scores = np.log(scores / scores.sum(axis=0))
    share = letters / np.maximum(1, letters.sum(axis=0))
    scripts = {s: (share[i] >= SCRIPT_SHARE).tolist() for i, s in enumerate(names) if (share[i] >= SCRIPT_SHARE).any()}
    return Model(languages, scores.astype(np.float32), scripts)


def paths(scores, starts, lengths, penalty: float):
    """The best language of each word; ``scores`` are those of all texts one after the other.

    All texts of a batch take their steps together, longest first, so a step costs one operation on
    those that are still running. Sums are in double precision and relative to the best language of
    the step before, so they don't grow with the length of a text.
    """
    import numpy as np

    order = np.argsort(-lengths, kind="stable")
    first, length = starts[order], lengths[order]
    steps = int(length[0]) if len(length) else 0
    running = np.searchsorted(-length, -np.arange(1, steps + 1), side="right")
    total = scores[first[:running[0] if steps else 0]].astype(np.float64)  # of the texts, at the step reached
    back = np.zeros(scores.shape, bool)
    top = np.zeros(len(scores), np.int32)
    for t in range(1, steps):
        now = first[:running[t]] + t
        before = total[:running[t]]
        best = before.argmax(axis=1)
        before = before - np.take_along_axis(before, best[:, None], 1)
        stays = before >= -penalty
        total[:running[t]] = scores[now] + np.where(stays, before, -penalty)
        back[now], top[now] = stays, best
    path = np.zeros(len(scores), np.int32)
    for t in range(steps - 1, -1, -1):
        now = first[:running[t]] + t
        ends = length[:running[t]] == t + 1
        here = np.where(ends, total[:running[t]].argmax(axis=1), 0)
        going = now[~ends]
        after = path[going + 1]
        here[~ends] = np.where(back[going + 1, after], after, top[going + 1])
        path[now] = here
    return path


def _scorer(model: Model):
    """Scores of words, kept for as many words as ``CACHED_WORDS`` from task to task."""
    import numpy as np

    state = {"number": {}, "scores": np.zeros((0, len(model.languages)), np.float32)}

    def score(words: list[str]):
        if len(state["number"]) > CACHED_WORDS:
            state["number"], state["scores"] = {}, state["scores"][:0]
        number = state["number"]
        new = list(set(words).difference(number))
        if new:
            number.update(zip(new, range(len(number), len(number) + len(new))))
            state["scores"] = np.concatenate([state["scores"], model.word_scores(new)])
        return state["scores"][np.fromiter(map(number.__getitem__, words), np.int64, len(words))]

    return score


def label(model: Model, texts: list[str | None], penalty: float, score, spans: bool = False) -> list[list]:
    """Language, score, number of spans and, if asked for, spans of each text."""
    import numpy as np

    if spans:
        matches = [list(_WORD.finditer(_letters_only(t))) for t in texts]
        words = [[m.group() for m in found] for found in matches]
    else:
        words = [words_of(t) for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(lengths) - lengths
    flat = [w for found in words for w in found]
    path = paths(score(flat), starts, lengths, penalty)
    letters = np.fromiter(map(len, flat), np.int64, len(flat))
    text_of = np.repeat(np.arange(len(texts)), lengths)
    k = len(model.languages)
    mass = np.bincount(text_of * k + path, letters, len(texts) * k).reshape(len(texts), k)
    best, total = mass.argmax(axis=1), mass.sum(axis=1)
    change = np.ones(len(flat), bool)
    change[1:] = (path[1:] != path[:-1]) | (text_of[1:] != text_of[:-1])
    n_spans = np.bincount(text_of[change], minlength=len(texts))
    out = [[model.languages[b] if t else UNKNOWN for b, t in zip(best, total)],
           (mass.max(axis=1) / np.maximum(1, total)).tolist(), n_spans.tolist()]
    if spans:
        found = [[] for _ in texts]
        heads = np.flatnonzero(change)
        for a, b in zip(heads, [*heads[1:], len(flat)]):
            i = int(text_of[a])
            found[i].append({"start": matches[i][a - starts[i]].start(), "end": matches[i][b - 1 - starts[i]].end(), "lang": model.languages[path[a]]})
        out.append(found)
    return out


def predict(docs: DataFrame, model: Model | None, keep: list[str], text_column: str = "text", penalty: float = SWITCH_PENALTY,
            spans: bool = False) -> DataFrame:
    """The kept columns with lang_pred, score (share of the letters) and n_spans, and lang_spans if asked for.

    ``lang_spans`` are (start, end, lang) with code points of the text, from the first letter of a span
    to its last. A null text, one without a letter, or any text without a model is ``und`` with score 0
    and no span.
    """
    fields = "lang_pred string, score double, n_spans long" + (", lang_spans array<struct<start: long, end: long, lang: string>>" if spans else "")
    text = column(text_column).cast("string")
    if model is None:
        plain = docs.select(*[column(c) for c in keep], F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_spans"))
        return plain.withColumn("lang_spans", F.expr("array()").cast("array<struct<start: long, end: long, lang: string>>")) if spans else plain
    version = uuid.uuid4().hex

    def run(texts: list) -> list:
        score = kept_in_worker("langid", version, lambda: _scorer(model))
        parts = [label(model, texts[at:at + 2000], penalty, score, spans) for at in range(0, len(texts), 2000)]
        return [list(chain(*x)) for x in zip(*parts)] or [[], [], []] + [[]] * spans

    return appended(docs, [text], run, fields, keep)


def learnable(id_column: str = "doc_id") -> Column:
    return bucket_of(id_column, 4) != 2


def language_id(spark, folder: str) -> DataFrame:
    """Query op1: the language of all documents, learned from those whose fold isn't held out."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = fit(docs.where(learnable()))
    found = predict(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.withColumn("held_out", F.coalesce(~learnable(), F.lit(False)))
