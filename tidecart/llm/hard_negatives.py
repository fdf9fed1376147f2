"""Hard negatives by an inverted multi-index with certified windows.

Two codebooks, one for each half of a vector, form cells. Rows lie sorted by cell; each Arrow batch of
them is a part of the index with a directory of its own: the half-cells that occur and the radius
within which their rows lie around the centroid. For an anchor a half-cell's score is at most the inner
product with the centroid plus radius times norm, and a cell's at most the sum of its halves. A heap
walks the cells by descending sum (multi-sequence) and stops once no further cell can hold a row of a
window that is still open: the results are exact. Anchors, a stated part of the rows, meet all rows in
blocks of a fixed size, first to find their positives and then the negatives in the window below each.
"""

from __future__ import annotations

import heapq
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecart.llm._common import column
from tidecart.session import pin

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOW_PERCENT, HIGH_PERCENT = 80, 100   # of the positive's score
CODEBOOK = 64             # centroids of a half
SAMPLE_ROWS = 8192        # rows at most that codebooks and first thresholds are learned from
BLOCK_ANCHORS = 4096
_EXACT = 2 ** 53          # integers up to here are exact in double precision
_LAST = 2 ** 63 - 1       # stands for an id of null, which comes last among ties
_GATHER = 256             # rows scored at a time


def valid_rows(table: DataFrame, id_column: str, label: Column, vector_column: str, scale: int = SCALE) -> DataFrame:
    """(id, label, vec) of the rows that take part: vec holds the scaled, floored components.

    Rows that repeat an id count once, as the one with the smallest label and vector.
    """
    vec = column(vector_column).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = table.select(column(id_column).cast("long").alias("id"), label.cast("long").alias("label"),
                        F.when(finite, F.transform(vec, lambda x: F.floor(x * scale).cast("double"))).alias("vec"))
    rows = rows.where("label is not null and vec is not null")
    repeated = pin(rows.where("id is not null").groupBy("id").count().where("count > 1").select("id"))
    if not repeated.limit(1).count():
        return rows
    once = rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x")).select("id", "x.*")
    return rows.join(repeated, "id", "left_anti").unionAll(once)


def matrix(rows: list, dim: int):
    """Vectors as rows of one array; missing components at the end are zeros."""
    import numpy as np

    out = np.zeros((len(rows), dim))
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out


def matrix_of(vectors, dim: int):
    """The same from an Arrow column of lists."""
    flat = vectors.flatten()
    if len(flat) == len(vectors) * dim and set(vectors.value_lengths().to_pylist()) <= {dim}:
        return flat.to_numpy(zero_copy_only=False).reshape(len(vectors), dim)
    return matrix(vectors.to_pylist(), dim)


def codebook(sample, size: int, rounds: int = 8):
    """Centroids of the sample's rows by Lloyd's rounds from rows evenly spread over the sample."""
    import numpy as np

    centroids = sample[np.linspace(0, len(sample) - 1, min(size, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(sample, centroids)
        counts = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        centroids[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centroids


def nearest(vectors, centroids):
    """The number of the nearest centroid of each vector."""
    return ((centroids ** 2).sum(axis=1) - 2 * (vectors @ centroids.T)).argmin(axis=1)


def products(vectors, anchor):
    """Inner products as integers: in double precision where that is exact, else in whole numbers of any size."""
    import numpy as np

    bound = np.abs(vectors).max(initial=0.0) * np.abs(anchor).max(initial=0.0) * len(anchor)
    if bound < _EXACT:
        return (vectors @ anchor).astype(np.int64)
    whole = np.array([[int(x) for x in v] for v in vectors], dtype=object).reshape(vectors.shape)
    return (whole @ np.array([int(x) for x in anchor], dtype=object)).astype(np.int64)


def in_order(scores, ids, most: int):
    """The places of the first ``most`` by descending score and ascending id."""
    import numpy as np

    if len(scores) > 4 * most:
        cut = np.partition(scores, len(scores) - most)[len(scores) - most]
        some = np.flatnonzero(scores >= cut)
        return some[np.lexsort((ids[some], -scores[some]))][:most]
    return np.lexsort((ids, -scores))[:most]


class Part:
    """A batch of rows as a part of the index: its rows by cell, and what bounds the scores within each half-cell."""

    def __init__(self, ids, labels, vectors, halves: int, books: tuple, cells) -> None:
        import numpy as np

        order = np.lexsort((cells[1], cells[0]))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.sides = []
        numbers = []
        for side, book, cell in ((slice(0, halves), books[0], cells[0][order]), (slice(halves, None), books[1], cells[1][order])):
            used, number = np.unique(cell, return_inverse=True)
            radius = np.zeros(len(used))
            np.maximum.at(radius, number, np.sqrt(((self.vectors[:, side] - book[cell]) ** 2).sum(axis=1)))
            self.sides.append((side, book[used], radius))
            numbers.append(number)
        first = np.flatnonzero(np.diff(numbers[0] * len(book) + numbers[1], prepend=-1))
        self.rows_of = {(int(numbers[0][a]), int(numbers[1][a])): (int(a), int(b)) for a, b in zip(first, np.append(first[1:], len(ids)))}

    def walk(self, anchor, least):
        """Slices of rows by descending bound; ends where the next bound is below ``least()``, asked each time."""
        import numpy as np

        bounds = []
        for side, book, radius in self.sides:
            q = anchor[side]
            bound = book @ q + radius * np.sqrt(q @ q)
            order = np.argsort(-bound, kind="stable")
            bounds.append((bound[order], order))
        (one, first), (two, second) = bounds
        slack = 1 + 1e-9 * (np.abs(one).max() + np.abs(two).max())  # rounding never hides a row
        heap, seen = [(-(one[0] + two[0]), 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            if -bound + slack < least():
                return
            for step in ((i + 1, j), (i, j + 1)):
                if step[0] < len(one) and step[1] < len(two) and step not in seen:
                    seen.add(step)
                    heapq.heappush(heap, (-(one[step[0]] + two[step[1]]), *step))
            rows = self.rows_of.get((int(first[i]), int(second[j])))
            if rows:
                yield rows


class Wanted:
    """The best rows so far of one anchor's window: scores from ``low`` to ``high``."""

    def __init__(self, low: int, high: int, most: int) -> None:
        import numpy as np

        self.low, self.high, self.most = low, high, most
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self):
        """No row below this score can still matter."""
        return self.low if len(self.scores) < self.most else max(self.low, int(self.scores[-1]))

    def take(self, scores, ids) -> None:
        import numpy as np

        good = (scores >= self.least()) & (scores <= self.high)
        if good.any():
            scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
            best = in_order(scores, ids, self.most)
            self.scores, self.ids = scores[best], ids[best]


def first_threshold(sample: tuple, anchor: tuple, most: int, low: int, high: int, same: bool) -> int:
    """A score that the last row wanted reaches for certain, as enough rows of the sample do."""
    import numpy as np

    ids, labels, vectors = sample
    a_id, a_label, a_vec = anchor
    some = (labels == a_label) & (ids != a_id) if same else labels != a_label
    scores = products(vectors[some], a_vec)
    scores = scores[(scores >= low) & (scores <= high)]
    return int(np.partition(scores, len(scores) - most)[len(scores) - most]) if len(scores) >= most else low


def searched(index: DataFrame, anchors: list[tuple], windows: list[list[tuple[int, int]]], books: tuple, dim: int, most: int, same: bool) -> DataFrame:
    """(anchor, number, score, id): for each window of each anchor the first ``most`` rows of every task.

    ``index`` has (id, label, vec, c1, c2); an anchor is (id, label, vector), a window (low, high) of scores.
    With ``same`` the rows of the anchor's label but for itself are searched, else those of other labels.
    """
    halves = dim // 2

    def run(batches):
        import numpy as np
        import pyarrow as pa

        wanted = [[Wanted(low, high, most) for low, high in w] for w in windows]
        for batch in batches:
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            vectors = matrix_of(batch.column(2), dim)
            part = Part(ids, labels, vectors, halves, books, (batch.column(3).to_numpy(), batch.column(4).to_numpy()))
            for (a_id, a_label, a_vec), lists in zip(anchors, wanted):
                if not lists:
                    continue
                least = lambda: min(w.least() for w in lists)  # noqa: E731, B023
                waiting, held = [], 0

                def score() -> None:
                    at = np.concatenate([np.arange(a, b) for a, b in waiting])  # noqa: B023
                    at = at[(part.labels[at] == a_label) & (part.ids[at] != a_id) if same else part.labels[at] != a_label]  # noqa: B023
                    scores = products(part.vectors[at], a_vec)  # noqa: B023
                    for w in lists:  # noqa: B023
                        w.take(scores, part.ids[at])  # noqa: B023

                for a, b in part.walk(a_vec, least):
                    waiting.append((a, b))
                    held += b - a
                    if held >= _GATHER:
                        score()
                        waiting, held = [], 0
                if waiting:
                    score()
        found = [(a, n, int(s), int(i)) for (a, _, _), lists in zip(anchors, wanted) for n, w in enumerate(lists) for s, i in zip(w.scores, w.ids)]
        columns = list(zip(*found)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "number", "score", "id"])

    return index.select("id", "label", "vec", "c1", "c2").mapInArrow(run, "anchor long, number long, score long, id long")


def best(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each window, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def indexed(rows: DataFrame, size: int = CODEBOOK, sample_rows: int = SAMPLE_ROWS):
    """The rows with their cells (c1, c2), sorted by them; the codebooks; the sample; the longest vector's length.

    Codebooks are learned from at most ``sample_rows`` rows, those of smallest hash; every row is indexed.
    """
    import numpy as np

    dim = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    some = rows.orderBy(F.xxhash64("id", "vec"), "id").limit(sample_rows).collect()
    vectors = matrix([r.vec for r in some], dim)
    books = (codebook(vectors[:, :dim // 2], size), codebook(vectors[:, dim // 2:], size)) if some else (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = matrix_of(batch.column(2), dim)
            cells = [pa.array(nearest(found[:, s], b).astype(np.int32)) for s, b in ((slice(0, dim // 2), books[0]), (slice(dim // 2, None), books[1]))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cells], names=["id", "label", "vec", "c1", "c2"])

    placed = rows.withColumn("id", F.coalesce("id", F.lit(_LAST))).select("id", "label", "vec")
    placed = placed.mapInArrow(run, "id long, label long, vec array<double>, c1 int, c2 int")
    # an id at the end divides a cell that holds many rows
    index = pin(placed.repartitionByRange("c1", "c2", "id").sortWithinPartitions("c1", "c2"))
    sample = (np.array([_LAST if r.id is None else r.id for r in some], np.int64), np.array([r.label for r in some], np.int64), vectors)
    return index, books, sample, dim


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT,
         high_percent: int = HIGH_PERCENT, block_anchors: int = BLOCK_ANCHORS, size: int = CODEBOOK, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among ``rows``.

    ``rows`` has (id, label, vec) with whole numbers as components, as ``valid_rows`` gives them, and an
    id at most once; rows without an id are found but are no anchors, and come last among ties. Vectors
    of different lengths meet as if padded by zeros. A positive without a negative in its window gives no
    row, nor does an anchor without positives; an empty table gives no rows. Scores must fit a long.
    """
    index, books, sample, dim = indexed(rows, size, sample_rows)
    asked = pin(index.where(is_anchor & (F.col("id") != _LAST)).select("id", "label", "vec"))
    n_blocks = max(1, -(-asked.count() // block_anchors))
    parts = []
    for b in range(n_blocks):
        block = asked.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == b).collect()
        anchors = [(r.id, r.label, v) for r, v in zip(block, matrix([r.vec for r in block], dim))]
        everything = (-(2 ** 63), 2 ** 63 - 1)
        open_ = [[(first_threshold(sample, a, positives, *everything, True), everything[1])] for a in anchors]
        near = best(searched(index, anchors, open_, books, dim, positives, True), ["anchor"], positives)
        near = pin(near.select(F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                               (F.col("rank") - 1).cast("long").alias("number")))
        scores: dict[int, dict[int, int]] = {}
        for r in near.select("anchor_id", "number", "positive_score").collect():  # a block's anchors, a few rows each
            scores.setdefault(r.anchor_id, {})[r.number] = r.positive_score
        windows = []
        for a in anchors:
            own = []
            for _, score in sorted(scores.get(a[0], {}).items()):
                low, high = -(-low_percent * score // 100), high_percent * score // 100
                own.append((first_threshold(sample, a, negatives, low, high, False) if low <= high else low, high))
            windows.append(own)
        # a window in which no score fits (low above high) is left with nothing to find
        windows = [[(low if low <= high else 2 ** 63 - 1, high) for low, high in own] for own in windows]
        found = best(searched(index, anchors, windows, books, dim, negatives, False), ["anchor", "number"], negatives)
        joined = found.join(near, (F.col("anchor") == F.col("anchor_id")) & (found["number"] == near["number"]))
        real = lambda c: F.when(F.col(c) != _LAST, F.col(c)).alias(c)
        parts.append(pin(joined.withColumn("negative_id", F.col("id")).select(
            "anchor_id", real("positive_id"), "rank", real("negative_id"), "positive_score", F.col("score").alias("negative_score"))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def hard_negatives(spark, folder: str) -> DataFrame:
    """Query op12: negatives below each of the first positives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = valid_rows(spark.read.parquet(f"{folder}/embeddings.parquet"), "vec_id", label, "embedding")
    return mine(rows, F.col("id") % 100 == 0)


HARD_NEGATIVES_SQL = f"""
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        CAST(list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM r a, r b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
n AS (
    SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM p JOIN s USING (anchor_id)
    WHERE NOT s.same AND {LOW_PERCENT} * positive_score <= 100 * s.score AND 100 * s.score <= {HIGH_PERCENT} * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
