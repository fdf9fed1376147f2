"""Quality scores from document statistics: random Fourier features, ridge regression, isotonic calibration.

Statistics of a text are standardised and mapped to random cosines whose inner products approximate a
Gaussian kernel. Tasks sum the normal equations of their labelled rows per fold; the sums
give one ridge model per left-out fold and one for all. Scores of left-out folds, counted in narrow
bins, are calibrated by pooling adjacent violators, so a score is the share of good documents around it.
"""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.llm._common import appended, bucket_of, column
from tidecart.session import pin

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES = 256            # random cosines
GAMMA = 0.06              # of the Gaussian kernel over standardised statistics
RIDGE = 1.0
FOLDS = 5
BINS = 2000               # of left-out scores, for the calibration
TRAIN_DOCS = 200_000      # labelled rows that a model learns from, at most about
CLIP = 6.0                # standard deviations beyond which a statistic counts no more
SEED = 17

STATISTICS = [
    "log_chars", "log_words", "mean_word", "long_words", "distinct_words", "top_word", "adjacent_repeats", "log_lines",
    "mean_line", "distinct_lines", "ends_with_mark", "letters", "upper", "upper_words", "digits", "marks", "symbols", "pipes",
    "bangs", "non_ascii", "capital_starts",
]
_UPPER = re.compile(rb"[A-Z]")


def statistics(text: str | None) -> list[float]:
    """Numbers that describe the look of a text; those of an empty text are zeros. No word is looked up anywhere."""
    from math import log1p

    text = text or ""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [log1p(chars)] + [0.0] * (len(STATISTICS) - 1)
    lines = [x for x in text.split("\n") if x.strip()]
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    sizes = list(map(len, words))
    solid = sum(sizes)
    upper = sum(map(str.isupper, words))
    marks = sum(map(text.count, ".,;:?!'\"()-"))
    symbols = sum(map(text.count, "#*$%&<>{}[]=+@~^\\/_"))
    digits = sum(map(text.count, "0123456789"))
    pipes, bangs = text.count("|"), text.count("!")
    raw = text.encode("utf-8", "surrogatepass")
    capitals = len(_UPPER.findall(raw))
    return [
        log1p(chars), log1p(n), solid / n, sum(s > 12 for s in sizes) / n, len(seen) / n, max(seen.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n, log1p(len(lines)), log1p(n / len(lines)), len(set(lines)) / len(lines),
        sum(x.rstrip()[-1] in ".!?:;\"')" for x in lines) / len(lines), 1 - (digits + marks + symbols + pipes) / solid,
        capitals / solid, upper / n, digits / solid, marks / solid, symbols / solid, pipes / n, bangs / n,
        (len(raw) - chars) / chars, sum(map(str.istitle, words)) / n,
    ]


def measured(docs: DataFrame, keep: list[str], text_column: str = "text") -> DataFrame:
    """The kept columns and ``stats``, the statistics of each whole text."""
    return appended(docs, [column(text_column).cast("string")], lambda texts: [[statistics(t) for t in texts]], "stats array<double>", keep)


class Model:
    """Standardisation, cosines, ridge weights and calibration steps; scores are shares of good documents."""

    def __init__(self, mean, scale, frequency, phase, weights, edges, levels) -> None:
        self.mean, self.scale, self.frequency, self.phase = mean, scale, frequency, phase
        self.weights, self.edges, self.levels = weights, edges, levels

    def cosines(self, stats):
        return cosines(stats, self.mean, self.scale, self.frequency, self.phase)

    def score(self, stats):
        import numpy as np

        raw = self.cosines(stats) @ self.weights
        return np.interp(raw, self.edges, self.levels)


def cosines(stats, mean, scale, frequency, phase):
    """[rows, FEATURES + 1] random features with a constant."""
    import numpy as np

    z = np.clip((stats - mean) / scale, -CLIP, CLIP)
    out = np.ones((len(z), frequency.shape[1] + 1))
    out[:, 1:] = np.cos(z @ frequency + phase) * np.sqrt(2.0 / frequency.shape[1])
    return out


def _blocks(df: DataFrame, run, fields: str) -> DataFrame:
    """``run`` over (stats, label, fold) of each batch; sums stay in the task until its end."""

    def task(batches):
        import numpy as np
        import pyarrow as pa

        state = None
        for b in batches:
            if b.num_rows:
                stats = np.array(b.column(0).to_pylist(), float)
                state = run(state, stats, b.column(1).to_numpy(), b.column(2).to_numpy())
        if state is not None:
            at = np.flatnonzero(state.ravel())
            yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "v": pa.array(state.ravel()[at], pa.float64())})

    rows = df.select("stats", F.col("label").cast("double"), F.col("fold").cast("int")).mapInArrow(task, fields)
    return rows.groupBy("at").agg(F.sum("v").alias("v"))


def _gathered(sums: DataFrame, shape: tuple):
    import numpy as np

    out = np.zeros(int(np.prod(shape)))
    found = sums.toPandas()
    out[found["at"].to_numpy(int)] = found["v"].to_numpy(float)
    return out.reshape(shape)


def pooled(good, total):
    """Isotonic regression of good/total by pooling adjacent violators: a level for each bin."""
    import numpy as np

    blocks: list[list[float]] = []
    for g, t in zip(good, total):
        blocks.append([g, t, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g1, t1, n1 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g1, blocks[-1][1] + t1, blocks[-1][2] + n1]
    return np.concatenate([np.full(int(n), g / t if t else 0.0) for g, t, n in blocks]) if blocks else np.zeros(0)


def fit(labelled: DataFrame) -> Model | None:
    """Learn from (stats, label 0/1, fold 0..FOLDS-1, weight of a row is 1). None without a row.

    What comes to the driver are sums: two per statistic, (FEATURES + 1) squared per fold, and BINS.
    """
    import numpy as np

    d, p = len(STATISTICS), FEATURES + 1

    def moments(state, stats, label, fold):
        state = np.zeros((3, d)) if state is None else state
        state[0] += len(stats)
        state[1] += stats.sum(0)
        state[2] += (stats ** 2).sum(0)
        return state

    count, total, square = _gathered(_blocks(labelled, moments, "at long, v double"), (3, d))
    if not count[0]:
        return None
    mean = total / count
    scale = np.sqrt(np.maximum(square / count - mean ** 2, 0))
    scale = np.where(scale > 1e-9, scale, 1.0)
    rng = np.random.default_rng(SEED)
    frequency = rng.normal(0, np.sqrt(2 * GAMMA), (d, FEATURES))
    phase = rng.uniform(0, 2 * np.pi, FEATURES)

    def equations(state, stats, label, fold):
        state = np.zeros((FOLDS, p, p + 1)) if state is None else state
        z = cosines(stats, mean, scale, frequency, phase)
        for k in range(FOLDS):
            own = z[fold == k]
            state[k] += own.T @ np.concatenate([own, label[fold == k, None]], axis=1)
        return state

    sums = _gathered(_blocks(labelled, equations, "at long, v double"), (FOLDS, p, p + 1))

    def solved(a):
        penalty = RIDGE * np.eye(p)
        penalty[0, 0] = 1e-6
        return np.linalg.solve(a[:, :p] + penalty, a[:, p])

    whole = sums.sum(0)
    weights = solved(whole)
    others = np.stack([solved(whole - sums[k]) if (whole - sums[k])[0, 0] > 0 else weights for k in range(FOLDS)])
    low, high = -0.5, 1.5  # of raw scores; beyond lies the outermost bin

    def bins(state, stats, label, fold):
        state = np.zeros((2, BINS)) if state is None else state
        raw = (cosines(stats, mean, scale, frequency, phase) * others[fold]).sum(1)
        at = np.clip(((raw - low) / (high - low) * BINS).astype(int), 0, BINS - 1)
        state[0] += np.bincount(at, label, BINS)
        state[1] += np.bincount(at, minlength=BINS)
        return state

    good, total = _gathered(_blocks(labelled, bins, "at long, v double"), (2, BINS))
    some = np.flatnonzero(total)
    levels = pooled(good[some], total[some])
    # half a document more at either end, so that no score is a certainty
    if levels[0] == 0:
        levels[levels == 0] = 0.5 / (total[some][levels == 0].sum() + 1)
    if levels[-1] == 1:
        n = total[some][levels == 1].sum()
        levels[levels == 1] = (n + 0.5) / (n + 1)
    centres = low + (some + 0.5) * (high - low) / BINS
    return Model(mean, scale, frequency, phase, weights, centres, levels)


def scored(measurements: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The kept columns and score, 0 to 1; 0.5 without a model."""
    if model is None:
        return measurements.select(*[column(c) for c in keep], F.lit(0.5).alias("score"))

    def run(stats: list) -> list:
        import numpy as np

        return [model.score(np.array(stats, float)).tolist() if stats else []]

    return appended(measurements, [F.col("stats")], run, "score double", keep)


def labelled_rows(measurements: DataFrame, labels: DataFrame, id_column: str, label_column: str, train_docs: int) -> DataFrame:
    """(stats, label, fold) of about ``train_docs`` labelled rows at most, chosen and folded by a hash of the id.

    Labels that are null are left out; a document with several labels counts once per label.
    """
    known = labels.where(column(label_column).isNotNull() & column(id_column).isNotNull())
    n = known.count()
    place = F.pmod(F.xxhash64(column(id_column).cast("string"), F.lit(SEED)), F.lit(1 << 20))
    known = known.where(place < F.lit(int(min(1.0, train_docs / max(1, n)) * (1 << 20)) or 1))
    known = known.select(column(id_column).alias("__id"), column(label_column).alias("label"), F.pmod(place, F.lit(FOLDS)).alias("fold"))
    return measurements.join(known, column(id_column) == F.col("__id")).select("stats", "label", "fold")


def quality_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
                   train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(id, score) of every row of ``docs``; null and empty texts are scored like any other by their statistics."""
    stats = pin(measured(docs, [id_column], text_column))
    model = fit(pin(labelled_rows(stats, labels, id_column, label_column, train_docs)))
    return scored(stats, model, [id_column])


def quality_classifier(spark, folder: str) -> DataFrame:
    """Query op7: quality of all documents, learned from labels outside the held-out fold."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(bucket_of("doc_id", 5) != 0)
    found = quality_scores(docs, labels)
    held_out = F.coalesce(bucket_of("doc_id", 5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
