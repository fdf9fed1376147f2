"""Toxicity by a chain of linear classifiers over words.

Categories are predicted one after the other. Each model is a logistic regression over the presence of
telling words and the probabilities of the categories before it; in training those probabilities come
from models that have not seen the row (out-of-fold), as at prediction time. Telling words are chosen by the
likelihood ratio of their document counts, which Spark works out over the labelled rows.
"""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart.llm._common import appended, column
from tidecart.session import pin

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRAIN_DOCS = 20_000       # labelled rows that a chain learns from, at most about
WORDS = 600               # telling words of a chain
BEGINNINGS = (4, 5, 7)    # letters of the beginnings of words that count as words themselves
MIN_DOCS = 3              # labelled documents a telling word is in
MIN_RATIO = 15.0          # of its likelihood ratio (chi-square with one degree of freedom)
FOLDS = 5
RIDGE = 0.3
SEED = 23
THRESHOLD = 0.35
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """The distinct words of a text, lower case, and their beginnings, which end in ``*``."""
    words = set(_WORD.findall((text or "").lower()))
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in BEGINNINGS))


def sample(docs: DataFrame, labels: DataFrame, categories: list[str], id_column: str, text_column: str, train_docs: int) -> DataFrame:
    """(fold, words, y: labels in the order of the categories) of distinct labelled texts, chosen by a hash of the text.

    Copies of a text count once, with the largest of their labels: a passage that was copied often
    would otherwise look telling. Rows without a label or text are left out.
    """
    known = labels.where(" and ".join(f"`{c}` is not null" for c in categories)).select(
        column(id_column).alias("__id"), *[column(c).cast("int").alias(f"y{i}") for i, c in enumerate(categories)])
    n = known.count()
    texts = docs.select(column(id_column).alias("id"), column(text_column).cast("string").alias("text")).where("text is not null")
    place = F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(1 << 20))
    part = int(min(1.0, train_docs / max(1, n)) * (1 << 20)) or 1
    rows = texts.withColumn("place", place).where(F.col("place") < part).join(known, F.col("id") == F.col("__id"))
    rows = rows.select("text", "place", F.xxhash64("text").alias("h"), *[f"y{i}" for i in range(len(categories))])
    cut = appended(rows, [F.col("text")], lambda texts: [[sorted(words_of(t)) for t in texts]], "words array<string>",
                   ["h", "place", *[f"y{i}" for i in range(len(categories))]])
    one = cut.groupBy("h").agg(F.pmod(F.first("place"), F.lit(FOLDS)).alias("fold"), F.first("words").alias("words"),
                               F.array(*[F.max(f"y{i}") for i in range(len(categories))]).alias("y"))
    return one.drop("h")


def telling_words(rows: DataFrame, label: Column, most: int = WORDS) -> list[str]:
    """The words whose presence says most about a label, by likelihood ratio; ``most`` at most."""
    n, n1 = rows.agg(F.count("*"), F.sum(label)).first()
    if not n or not n1 or n1 == n:
        return []
    counts = rows.select(F.explode("words").alias("word"), label.alias("y")).groupBy("word").agg(
        F.count("*").alias("k"), F.sum("y").alias("k1")).where(F.col("k") >= MIN_DOCS)

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    k, k1, n0 = F.col("k"), F.col("k1"), n - n1
    k0 = k - k1
    ratio = 2 * (term(k1, k * n1 / n) + term(k0, k * n0 / n) + term(n1 - k1, (n - k) * n1 / n) + term(n0 - k0, (n - k) * n0 / n))
    best = counts.withColumn("ratio", ratio).where(F.col("ratio") >= MIN_RATIO).orderBy(F.desc("ratio"), "word").limit(most)
    return [r["word"] for r in best.collect()]


def logistic(x, y, ridge: float = RIDGE, steps: int = 25):
    """Weights of a ridge logistic regression by Newton steps; the last one is the constant."""
    import numpy as np

    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + penalty * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, g)
        size = np.abs(step).max()
        w -= step * min(1.0, 4.0 / size) if size > 0 else step
        if size < 1e-6:
            break
    return w


def probability(x, w):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


class Chain:
    """Words, and weights per category over the words and the probabilities of the categories before."""

    def __init__(self, words: list[str], weights: list) -> None:
        self.number, self.weights = {w: i for i, w in enumerate(words)}, weights
        begin = [w[:-1] for w in words if w[-1] == "*"]
        self.starts = {n: {w for w in begin if len(w) == n} for n in sorted(set(map(len, begin)))}

    def probabilities(self, texts: list[str | None]):
        import numpy as np

        x = np.zeros((len(texts), len(self.number) + len(self.weights)))
        for i, t in enumerate(texts):
            words = set(_WORD.findall((t or "").lower()))
            found = words & self.number.keys()
            for n in self.starts:
                found |= {w + "*" for w in self.starts[n] & {w[:n] for w in words if len(w) > n}}
            for w in found:
                x[i, self.number[w]] = 1
        return chained(x, len(self.number), self.weights)


def chained(x, n_words: int, weights: list):
    """Fill the columns after the words with one probability after the other and return them."""
    for k, w in enumerate(weights):
        x[:, n_words + k] = probability(x[:, :n_words + k], w)
    return x[:, n_words:]


def train(x, y, fold, n_words: int) -> list:
    """Weights of each category; a category's inputs are the words and out-of-fold probabilities of those before."""
    import numpy as np

    inputs, weights = x[:, :n_words], []
    for k in range(y.shape[1]):
        weights.append(logistic(inputs, y[:, k]))
        held = np.zeros(len(x))
        for f in range(FOLDS):
            mine = fold == f
            if mine.any():
                seen = ~mine if (~mine).any() else mine
                held[mine] = probability(inputs[mine], logistic(inputs[seen], y[seen, k]))
        inputs = np.hstack([inputs, held[:, None]])
    return weights


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], id_column: str = "doc_id", text_column: str = "text",
        train_docs: int = TRAIN_DOCS, derive=None) -> Chain | None:
    """Learn a chain; None where there is no labelled text.

    ``categories`` are 0/1 columns of ``labels`` in the order of the chain. ``derive(rows)`` may put
    further categories into ``y`` of the sample. What comes to the driver are the telling words that each
    of the sampled rows has (``train_docs`` rows, ``WORDS`` words).
    """
    import numpy as np

    rows = pin(sample(docs, labels, categories, id_column, text_column, train_docs))
    if derive is not None:
        rows = pin(derive(rows))
    first = rows.first()
    if first is None:
        return None
    words: list[str] = []
    for k in range(len(first["y"])):
        words += [w for w in telling_words(rows, F.col("y")[k], WORDS // len(first["y"])) if w not in words]
    words.sort()
    chosen = F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")
    found = rows.select("fold", "y", F.array_intersect("words", chosen).alias("words")).toPandas()
    number = {w: i for i, w in enumerate(words)}
    x = np.zeros((len(found), len(words)))
    for i, own in enumerate(found["words"]):
        x[i, [number[w] for w in own]] = 1
    y = np.array(found["y"].tolist(), float)
    return Chain(words, train(x, y, found["fold"].to_numpy(int), len(words)))


def predict(docs: DataFrame, chain: Chain | None, names: list[str], keep: list[str], text_column: str = "text") -> DataFrame:
    """The kept columns and a probability for each name, in the order of the chain; 0 without a chain."""
    if chain is None:
        return docs.select(*[column(c) for c in keep], *[F.lit(0.0).alias(n) for n in names])

    def run(texts: list) -> list:
        if not texts:
            return [[] for _ in names]
        parts = [chain.probabilities(texts[at:at + 2000]) for at in range(0, len(texts), 2000)]
        return [[v for p in parts for v in p[:, k].tolist()] for k in range(len(names))]

    return appended(docs, [column(text_column).cast("string")], run, ", ".join(f"{n} double" for n in names), keep)


def graded(rows: DataFrame) -> DataFrame:
    """Categories derived from the label toxic: insulting (toxic and has a telling word), abusive (has two or more), toxic itself."""
    words = telling_words(rows, F.col("y")[0], 40)
    # only words that speak for the label
    sides = rows.select(F.explode("words").alias("w"), F.col("y")[0].alias("y")).where(F.col("w").isin(words or [""])).groupBy("w").agg(F.avg("y").alias("p"))
    bad = [r["w"] for r in sides.where("p > 0.5").collect()]
    hits = F.size(F.array_intersect("words", F.array(*[F.lit(w) for w in bad]) if bad else F.array().cast("array<string>")))
    toxic = F.col("y")[0]
    return rows.select("fold", "words", F.array((toxic * (hits >= 1).cast("int")), (toxic * (hits >= 2).cast("int")), toxic).alias("y"))


def toxicity_chain(spark, folder: str) -> DataFrame:
    """Query op5: probabilities of the three categories for all documents, learned from all labels; ``predicted`` is 1 for a toxic one."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    chain = fit(docs, labels, ["toxic"], derive=graded)
    found = predict(docs, chain, ["p_insulting", "p_abusive", "score"], ["doc_id"])
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
