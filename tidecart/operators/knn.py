"""Exact nearest-neighbour imputation as a block join.

Rows with equal vectors get equal results, so the work is done on distinct vectors with their
multiplicity. A receiver and a donor meet in the columns both have. For each missing pattern with many
donors, and each set of columns in which receivers meet it, there is a view: the donors by those columns
and the target alone, of which the k smallest values at a point are enough. The views are cut into blocks
of nearby vectors (a k-d cut, with cut points from a sample; their number is bounded, and a large block
is stored in chunks). A receiver first looks at its home block, which bounds the distance
of its k-th neighbour, and then only at the blocks whose bounding box comes closer than that. The
blocks left out cannot hold a neighbour, so the result is exact. Receivers meet donors in an equi-join on
(block, salt); crowded blocks get several salts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from tidecart.operators.attach import BROADCAST_BYTES, attach
from tidecart.session import pin

# The small numpy helpers below travel with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: neighbours used, weighted by inverse distance.
NEIGHBOURS = 5

BLOCK_ROWS = 2048
_RECEIVERS_AT_ONCE = 4096
_SAMPLES_PER_LEAF = 16
_MAX_LEAVES = 65_536
_DISTANCES_AT_ONCE = 1_000_000
_TILE = 1 << 16
_LEAF_BITS = 20
_MAX_VIEWS = 8             # views of a pattern and target by sets of columns; further sets share a view by all columns
_RECEIVERS_PER_TASK = 50_000
_GROUPS_PER_TASK = 256     # blocks with their receivers that a task gets at once, at most
_NEAR_RECEIVERS = 32       # receivers that choose among the same boxes


@dataclass
class Cut:
    """A k-d cut of one missing pattern: inner nodes send values <= cut to the left."""

    dims: list[int] = field(default_factory=list)
    cuts: list[float] = field(default_factory=list)
    children: list[tuple[int, int]] = field(default_factory=list)
    leaf_chunks: list[int] = field(default_factory=list)

    def grow(self, points: np.ndarray, chunks_of, leaf_points: int) -> int:
        """Node number of the subtree over these points; leaves are numbered below zero."""
        if len(points) > leaf_points:
            spread = points.max(axis=0) - points.min(axis=0)
            dim = int(np.argmax(spread))
            if spread[dim] > 0:
                column = points[:, dim]
                cut = float(np.median(column))
                if cut == column.max():
                    cut = float(column[column < cut].max())
                node = len(self.dims)
                self.dims.append(dim)
                self.cuts.append(cut)
                self.children.append((0, 0))
                left = self.grow(points[column <= cut], chunks_of, leaf_points)
                right = self.grow(points[column > cut], chunks_of, leaf_points)
                self.children[node] = (left, right)
                return node
        self.leaf_chunks.append(chunks_of(len(points)))
        return -len(self.leaf_chunks)

    def leaves(self, points: np.ndarray) -> np.ndarray:
        """Leaf number of each point."""
        if not self.dims:
            return np.zeros(len(points), dtype=np.int64)
        dims, cuts = np.array(self.dims), np.array(self.cuts)
        children = np.array(self.children)
        node = np.zeros(len(points), dtype=np.int64)
        while True:
            inner = np.flatnonzero(node >= 0)
            if not len(inner):
                return -node - 1
            at = node[inner]
            goes_right = points[inner, dims[at]] > cuts[at]
            node[inner] = children[at, goes_right.astype(np.int64)]


def _tasks(distances: float, groups: int = 0) -> int:
    """Tasks for so many distances and groups. Adaptive execution sees only bytes and would merge them all."""
    return int(max(distances / 2e7, groups / _GROUPS_PER_TASK, 1))


def _pattern(columns: list[str]) -> Column:
    """A row's missing pattern as text: 1 for each column that is present."""
    return F.concat(*[F.when(F.col(f"`{c}`").isNull(), "0").otherwise("1") for c in columns])


def _present(patterns: list[str], width: int) -> np.ndarray:
    """(pattern, column): whether it is present."""
    return np.array([[bit == "1" for bit in p] for p in patterns], dtype=bool).reshape(len(patterns), width)


def _text(present: np.ndarray) -> str:
    return "".join("1" if bit else "0" for bit in present)


def _vectors(df: DataFrame, columns: list[str], count: str) -> DataFrame:
    """Distinct vectors with their number of rows; copies collapse before the shuffle."""
    x = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(c) for c in columns]
    return df.select(*x).groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias(count))


@dataclass
class _Index:
    """Views of the donors, their blocks, and the bounding boxes of these.

    A view is (pattern of the donors, columns it is met in, target): it keeps these columns and the target
    only. One with neither keeps the whole vectors and serves whoever has no view of its own. The
    number of a block is that of its view and that of a leaf.
    """

    views: list[tuple[str, str | None, int | None]]
    blocks: DataFrame
    boxes: dict[str, np.ndarray]

    def united(self, other: _Index) -> _Index:
        """With the views of another index, numbered after its own."""
        boxes = {name: np.concatenate([own, other.boxes[name]]) for name, own in self.boxes.items()}
        return _Index(self.views + other.views, self.blocks.unionByName(other.blocks), boxes)


class _Server:
    """The boxes that may serve a missing pattern and target; made anew in each task."""

    def __init__(self, views: list[tuple[str, str | None, int | None]], boxes: dict[str, np.ndarray]) -> None:
        self.patterns = sorted({p for p, _, _ in views})
        self.has = _present(self.patterns, boxes["low"].shape[1])
        number = {p: i for i, p in enumerate(self.patterns)}
        self.whole = np.full(len(self.patterns), -1, dtype=np.int64)
        self.by_columns: dict[int, dict[tuple[str, int], int]] = {}
        for view, (p, columns, target) in enumerate(views):
            if columns is None:
                self.whole[number[p]] = view
            else:
                self.by_columns.setdefault(number[p], {})[columns, target] = view
        self.view = boxes["block"] >> _LEAF_BITS
        self.known: dict[tuple[bytes, int], np.ndarray] = {}

    def boxes_for(self, present: np.ndarray, target: int) -> np.ndarray:
        key = (present.tobytes(), target)
        if key not in self.known:
            shared = self.has & present
            able = self.has[:, target] & shared.any(axis=1)
            serving = self.whole.copy()
            for p, own in self.by_columns.items():
                serving[p] = own.get((_text(shared[p]), target), serving[p])
            self.known[key] = np.flatnonzero(np.isin(self.view, serving[able & (serving >= 0)]))
        return self.known[key]


def _bounds(lo, hi, low, high, shared, scale):
    """Least and greatest distance from each box (lo, hi) to each box (low, high), rounded outwards."""
    nearest, farthest = np.zeros((len(lo), len(low))), np.zeros((len(lo), len(low)))
    for i in range(lo.shape[1]):
        below, above = low[None, :, i] - hi[:, i, None], lo[:, i, None] - high[None, :, i]
        nearest += np.where(shared[None, :, i], np.maximum(np.maximum(below, above), 0.0) ** 2, 0.0)
        down, up = hi[:, i, None] - low[None, :, i], high[None, :, i] - lo[:, i, None]
        farthest += np.where(shared[None, :, i], np.maximum(np.abs(down), np.abs(up)) ** 2, 0.0)
    return np.sqrt(nearest * scale) * (1 - 1e-12), np.sqrt(farthest * scale) * (1 + 1e-12)


def _choices(x, reach, low, high, shared, scale, rows, k, which) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(receivers, boxes) to look at, for receivers of one missing pattern and the boxes that may serve it.

    Receivers are halved until few nearby ones are left. Each half keeps only the boxes that come closer
    than some with k rows surely are; every receiver's home boxes are among them, so that the
    choice depends on the receiver alone.
    """
    stack = [(np.arange(len(x)), np.arange(len(low)))]
    while stack:
        mine, boxes = stack.pop()
        some = x[mine]
        lo, hi = some.min(axis=0), some.max(axis=0)
        if which is not None:
            nearest, farthest = _bounds(lo[None], hi[None], low[boxes], high[boxes], shared[boxes], scale[boxes])
            order = np.argsort(farthest[0], kind="stable")
            enough = np.searchsorted(np.cumsum(rows[boxes][order]), k)
            if enough < len(boxes):
                boxes = boxes[nearest[0] <= farthest[0][order[enough]]]
            dim = int(np.argmax(hi - lo))
            if len(mine) > _NEAR_RECEIVERS and len(boxes) > 8 and hi[dim] > lo[dim]:
                order, half = np.argsort(some[:, dim], kind="stable"), len(mine) // 2
                stack += [(mine[order[:half]], boxes), (mine[order[half:]], boxes)]
                continue
        at_once = max(1, _DISTANCES_AT_ONCE // max(1, len(boxes)))
        for start in range(0, len(mine), at_once):
            part = mine[start : start + at_once]
            if which is None:
                able = np.ones((len(part), len(boxes)), dtype=bool)
            else:
                nearest, farthest = _bounds(x[part], x[part], low[boxes], high[boxes], shared[boxes], scale[boxes])
                # every block holds a row at least, so the k closest by farthest corner are enough
                first = np.argsort(farthest, axis=1, kind="stable")[:, :k]
                held = rows[boxes][first]
                able = np.zeros(farthest.shape, dtype=bool)
                np.put_along_axis(able, first, np.cumsum(held, axis=1) - held < k, axis=1)
                if which == "far":
                    able = ~able & (nearest <= reach[part, None])
            receiver, box = np.nonzero(able)
            if len(receiver):
                yield part[receiver], boxes[box]


@dataclass
class KnnImputer:
    """Fill holes of ``targets`` with the weighted mean of the k nearest rows that have a value.

    Distance: root of (all coordinates / shared coordinates) times the sum of squared differences
    over the shared ones. Neighbours at distance zero take all the weight. Ties at the last place
    go to the smaller value. A row that shares no coordinate with any donor gets the column mean.
    """

    columns: list[str]
    k: int = NEIGHBOURS
    targets: list[str] | None = None
    block_rows: int = BLOCK_ROWS
    single_round: float = 0.0  # up to so many distances every block is looked at; by default blocks are always ruled out
    max_bytes: int = BROADCAST_BYTES

    def fit(self, df: DataFrame) -> KnnImputer:
        self.targets = self.targets or list(self.columns)
        self.donors = pin(_vectors(df, self.columns, "__n").withColumn("__pattern", _pattern(self.columns)))
        cols = [F.col(f"`{c}`") for c in self.columns]
        totals = self.donors.agg(
            *[F.try_divide(F.sum(c * F.col("__n")), F.sum(F.when(c.isNotNull(), F.col("__n")))).alias(f"m{i}")
              for i, c in enumerate(cols)],
        ).first()
        self.means = {c: totals[f"m{i}"] for i, c in enumerate(self.columns)}
        # a row per missing pattern, of which there is a block at least anyway
        self.kinds = dict(sorted(tuple(r) for r in self.donors.groupBy("__pattern").count().collect()))
        self.index = self._build(self._views(self.kinds, []))
        return self

    def _views(self, receivers: dict[str, int], known: list[tuple[str, str | None, int | None]]) -> list[tuple[str, str | None, int | None]]:
        """The views that receivers of these patterns (with their number) need besides the known ones."""
        have = set(known)
        patterns = list(receivers)
        has, weight = _present(patterns, len(self.columns)), np.array(list(receivers.values()))
        at = [self.columns.index(t) for t in self.targets]
        wanted = []
        for p, n in self.kinds.items():
            own, left, whole = _present([p], len(self.columns))[0], False, (p, None, None)
            if whole in have or not own[at].any():
                continue
            if n <= self.block_rows:
                wanted.append(whole)
                continue
            for t in at:
                asking = ~has[:, t] & (has & own).any(axis=1)
                if own[t] and asking.any():
                    sets, of = np.unique(has[asking] & own, axis=0, return_inverse=True)
                    numbers = np.bincount(of.ravel(), weight[asking])
                    views = [(p, _text(sets[i]), t) for i in np.argsort(-numbers, kind="stable")]
                    views = [v for v in views if v not in have]
                    wanted += views[:_MAX_VIEWS]
                    left |= len(views) > _MAX_VIEWS
            if left:
                wanted.append(whole)
        return wanted

    def _build(self, views: list[tuple[str, str | None, int | None]], first: int = 0) -> _Index:
        """Blocks and boxes of the views, numbered from ``first``."""
        width, spark = len(self.columns), self.donors.sparkSession
        cols = [F.col(f"`{c}`") for c in self.columns]
        target_of = {first + i: t for i, (_, _, t) in enumerate(views) if t is not None}
        table = []
        for i, (p, columns, t) in enumerate(views):
            kept = p if columns is None else columns[:t] + "1" + columns[t + 1:]
            table.append((p, first + i, kept, -1 if t is None else t))
        table = F.broadcast(spark.createDataFrame(table, "__pattern string, __view bigint, __kept string, __t int"))
        seen = self.donors.join(table, "__pattern").withColumns(
            {c: F.when(F.substring("__kept", i + 1, 1) == "1", F.col(f"`{c}`")) for i, c in enumerate(self.columns)})
        value = F.coalesce(*[F.when(F.col("__t") == i, c) for i, c in enumerate(cols)])
        point = [F.when(F.col("__t") != i, c) for i, c in enumerate(cols)]
        place = F.row_number().over(Window.partitionBy("__view", *point).orderBy(value))
        fields = ["__view", *cols, "__n"]
        # donors at one point are equally far from any receiver, so the k smallest values there are enough
        parts = []
        if target_of:
            parts.append(seen.where("__t >= 0").withColumn("__place", place).where(F.col("__place") <= self.k).select(*fields))
        if len(target_of) < len(views) or not views:
            parts.append(seen.where("__t < 0").select(*fields))
        vectors = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        if target_of:
            vectors = pin(vectors)
        cuts = self._cut(vectors, target_of)

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                points = np.nan_to_num(batch.iloc[:, 1 : width + 1].to_numpy(dtype=float))
                view = batch["__view"].to_numpy(dtype=np.int64)
                leaf = np.zeros(len(batch), dtype=np.int64)
                chunks = np.ones(len(batch), dtype=np.int64)
                for v in np.unique(view):
                    if v in cuts:
                        rows = np.flatnonzero(view == v)
                        leaf[rows] = cuts[v].leaves(points[rows])
                        chunks[rows] = np.array(cuts[v].leaf_chunks)[leaf[rows]]
                chunk = batch["__hash"].to_numpy(dtype=np.int64) % chunks
                yield batch.drop(columns="__hash").assign(__block=(view << _LEAF_BITS) + leaf, __chunk=chunk)

        schema = StructType([*vectors.schema.fields, StructField("__block", LongType()), StructField("__chunk", LongType())])
        if cuts:
            hashed = vectors.withColumn("__hash", F.pmod(F.xxhash64(*cols), F.lit(1 << 40)))
            placed = hashed.mapInPandas(assign, schema)
        else:
            placed = vectors.withColumns({"__block": F.col("__view") * F.lit(1 << _LEAF_BITS), "__chunk": F.lit(0).cast("bigint")})
        low, high = [f"low{i}" for i in range(width)], [f"high{i}" for i in range(width)]
        blocks = pin(
            placed.groupBy("__block", "__chunk").agg(
                F.count(F.lit(1)).alias("vectors"),
                F.sum("__n").alias("rows"),
                *[F.min(c).alias(n) for c, n in zip(cols, low)],
                *[F.max(c).alias(n) for c, n in zip(cols, high)],
                F.flatten(F.collect_list(F.array(*cols, F.col("__n").cast("double")))).alias("__donors"),
            )
        )
        # at most _MAX_LEAVES boxes and one per view, however many donors there are
        boxes = blocks.groupBy("__block").agg(
            F.sum("vectors").alias("vectors"), F.sum("rows").alias("rows"),
            *[F.min(n).alias(n) for n in low], *[F.max(n).alias(n) for n in high]).toPandas().sort_values("__block")
        return _Index(views, blocks, {
            "block": boxes["__block"].to_numpy(dtype=np.int64),
            "vectors": boxes["vectors"].to_numpy(dtype=np.int64),
            "rows": boxes["rows"].to_numpy(dtype=np.int64),
            "low": boxes[low].to_numpy(dtype=float),
            "high": boxes[high].to_numpy(dtype=float),
        })

    def _cut(self, vectors: DataFrame, target_of: dict[int, int]) -> dict[int, Cut]:
        """Cut points of each view from a sample. They only place the borders of blocks."""
        n = vectors.count()
        leaves = min(_MAX_LEAVES, -(-n // self.block_rows))
        if leaves <= 1:
            return {}
        fraction = min(1.0, leaves * _SAMPLES_PER_LEAF / n)
        sample = vectors.drop("__n").sample(fraction, seed=1).toPandas().to_numpy(dtype=float)
        view, points = sample[:, 0].astype(np.int64), np.nan_to_num(sample[:, 1:])
        leaf_points = max(1, int(n / leaves * fraction))
        chunks_of = lambda points: max(1, round(points / fraction / self.block_rows))
        cuts = {}
        for v in np.unique(view):
            mine = points[view == v]
            if v in target_of:  # donors are found by the other columns
                mine[:, target_of[v]] = 0.0
            cut = Cut()
            cut.grow(mine, chunks_of, leaf_points)
            cuts[int(v)] = cut
        return cuts

    def fills(self, df: DataFrame) -> DataFrame:
        """``df`` (with the columns as doubles) plus ``__fill_<target>`` for its holes."""
        df = df.withColumns({c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in self.columns})
        hole = F.lit(False)
        for t in self.targets:
            hole = hole | F.col(f"`{t}`").isNull()
        receivers = pin(_vectors(df.where(hole), self.columns, "__w"))
        kinds = dict(sorted(tuple(r) for r in receivers.groupBy(_pattern(self.columns)).count().collect()))
        n = sum(kinds.values())
        unseen = self._views(kinds, self.index.views)
        index = self.index.united(self._build(unseen, len(self.index.views))) if unseen else self.index
        solved = pin(self._solve(receivers, n, index))
        n_bytes = n * 8 * (len(self.columns) + len(self.targets) + 3)  # one row of numbers per receiver
        if n_bytes <= self.max_bytes:
            joined = attach(df, solved, self.columns, "__w", self.max_bytes, n_bytes)
        else:
            complete = df.where(~hole).withColumns(
                {f"__fill_{t}": F.lit(None).cast("double") for t in self.targets})
            joined = attach(df.where(hole), solved, self.columns, "__w", self.max_bytes, n_bytes).unionByName(complete)
        means = {f"__fill_{t}": F.coalesce(F.col(f"`__fill_{t}`"), F.lit(self.means[t]).cast("double")) for t in self.targets}
        return joined.withColumns(means)

    def transform(self, df: DataFrame) -> DataFrame:
        filled = {t: F.coalesce(F.col(f"`{t}`"), F.col(f"`__fill_{t}`")) for t in self.targets}
        names = [f"__fill_{t}" for t in self.targets]
        return self.fills(df).withColumns(filled).drop(*names)

    # ---- the search -------------------------------------------------------------------------

    def _solve(self, receivers: DataFrame, n: int, index: _Index) -> DataFrame:
        boxes = index.boxes
        if len(boxes["block"]) <= 1 or n * float(boxes["vectors"].sum()) <= self.single_round:
            candidates = pin(self._candidates(receivers, n, None, index))
            found = self._search(candidates, self._load(candidates), index)
        else:
            candidates = pin(self._candidates(receivers, n, "home", index))
            home = pin(self._search(candidates, self._load(candidates), index))
            reach = self._best(home, with_reach=True)
            far = pin(self._candidates(reach, n, "far", index))
            found = home.unionByName(self._search(far, self._load(far), index))
        return self._best(found, with_reach=False)

    def _best(self, found: DataFrame, with_reach: bool) -> DataFrame:
        """Merge the blocks' nearest donors per receiver; then the weighted mean of the best k."""
        keys = [F.col(f"`{c}`") for c in self.columns]
        lists = {}
        for i, t in enumerate(self.targets):
            nearest = F.struct("__distance", "__value", "__count")
            lists[t] = F.slice(F.array_sort(F.collect_list(F.when(F.col("__target") == i, nearest))), 1, self.k)
        grouped = found.groupBy(*keys).agg(
            F.max("__w").alias("__w"), *[v.alias(f"__near_{t}") for t, v in lists.items()])
        names = [f"__near_{t}" for t in self.targets]
        if with_reach:
            reach = [self._kth_distance(F.col(f"`{n}`")) for n in names]
            return grouped.withColumn("__reach", F.array(*reach)).drop(*names)
        means = {f"__fill_{t}": self._weighted_mean(F.col(f"`__near_{t}`")) for t in self.targets}
        return grouped.withColumns(means).drop(*names)

    def _kth_distance(self, near: Column) -> Column:
        """Distance of the k-th neighbour so far; infinite while there are fewer than k."""
        enough = F.aggregate(near, F.lit(0.0), lambda a, d: a + d["__count"]) >= self.k
        start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("d"))
        walk = F.aggregate(
            near, start,
            lambda a, d: F.when(a["n"] >= self.k, a).otherwise(
                F.struct((a["n"] + d["__count"]).alias("n"), d["__distance"].alias("d"))),
        )
        return F.when(enough, walk["d"]).otherwise(F.lit(float("inf")))

    def _weighted_mean(self, near: Column) -> Column:
        start = F.struct(*[F.lit(0.0).alias(n) for n in ("n", "exact", "exact_sum", "w", "w_sum")])

        def step(a: Column, d: Column) -> Column:
            take = F.least(d["__count"], F.lit(float(self.k)) - a["n"])
            zero = d["__distance"] == 0
            w = F.when(zero, F.lit(0.0)).otherwise(F.try_divide(take, d["__distance"]))
            exact = F.when(zero, take).otherwise(F.lit(0.0))
            return F.struct(
                (a["n"] + take).alias("n"),
                (a["exact"] + exact).alias("exact"),
                (a["exact_sum"] + exact * d["__value"]).alias("exact_sum"),
                (a["w"] + w).alias("w"),
                (a["w_sum"] + w * d["__value"]).alias("w_sum"),
            )

        total = F.aggregate(near, start, step)
        return F.when(total["exact"] > 0, total["exact_sum"] / total["exact"]).otherwise(
            F.try_divide(total["w_sum"], total["w"]))

    def _candidates(self, receivers: DataFrame, n_receivers: int, which: str | None, index: _Index) -> DataFrame:
        """Receivers with the blocks they must look at: (vector, weight, target, distance to beat, block)."""
        width, k = len(self.columns), self.k
        views, boxes = index.views, index.boxes
        target_at = [self.columns.index(t) for t in self.targets]

        def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            server = _Server(views, boxes)
            box_has = ~np.isnan(boxes["low"])
            low, high = np.nan_to_num(boxes["low"]), np.nan_to_num(boxes["high"])
            for batch in batches:
                x = batch.iloc[:, :width].to_numpy(dtype=float)
                reach = np.stack(batch["__reach"])
                kinds, kind = np.unique(~np.isnan(x), axis=0, return_inverse=True)
                for i, present in enumerate(kinds):
                    mine, dims = np.flatnonzero(kind.ravel() == i), np.flatnonzero(present)
                    for number, t in enumerate(target_at):
                        able = server.boxes_for(present, t) if len(dims) and not present[t] else ()
                        if not len(able):
                            continue
                        shared = box_has[able][:, dims]
                        for rows, box in _choices(
                                x[mine][:, dims], reach[mine, number], low[able][:, dims], high[able][:, dims], shared,
                                width / shared.sum(axis=1), boxes["rows"][able], k, which):
                            some = batch.iloc[mine[rows]]
                            yield some.assign(__reach=reach[mine[rows], number], __target=np.int32(number),
                                              __block=boxes["block"][able[box]])

        keys = [F.col(f"`{c}`") for c in self.columns]
        if which != "far":
            receivers = receivers.withColumn("__reach", F.array_repeat(F.lit(float("inf")), len(self.targets)))
        used = receivers.select(*keys, "__w", "__reach").repartition(-(-n_receivers // _RECEIVERS_PER_TASK) or 1)
        schema = StructType([*used.schema.fields[:-1], StructField("__reach", DoubleType()), StructField("__target", IntegerType()),
                             StructField("__block", LongType())])
        return used.mapInPandas(expand, schema)

    def _load(self, candidates: DataFrame) -> dict[int, int]:
        """Receivers per block: at most an entry per box."""
        counted = candidates.groupBy("__block").agg(F.count(F.lit(1)).alias("c")).toPandas()
        return dict(zip(counted["__block"], counted["c"]))

    def _search(self, candidates: DataFrame, load: dict[int, int], index: _Index) -> DataFrame:
        """Nearest donors of each candidate within its block: (vector, weight, target, donor)."""
        width, k = len(self.columns), self.k
        keys = [F.col(f"`{c}`") for c in self.columns]
        vectors = dict(zip(index.boxes["block"], index.boxes["vectors"]))
        pairs = sum(float(c) * vectors[b] for b, c in load.items())
        # a block's receivers are divided among salts, and its chunks are rows of their own
        groups = sum(-(-int(c) // _RECEIVERS_AT_ONCE) * -(-int(vectors[b]) // self.block_rows) for b, c in load.items())
        salts = F.broadcast(candidates.sparkSession.createDataFrame(
            [(int(b), -(-int(c) // _RECEIVERS_AT_ONCE)) for b, c in load.items()], "__b bigint, __salts int"))
        packed = (
            candidates.join(salts, F.col("__block") == F.col("__b")).drop("__b")
            .withColumn("__salt", F.pmod(F.xxhash64(*keys), F.col("__salts")).cast("int"))
            .repartition(_tasks(pairs, groups), "__block", "__salt")
            .groupBy("__block", "__salt")
            .agg(F.flatten(F.collect_list(
                F.array(*keys, F.col("__w").cast("double"), F.col("__target").cast("double"), F.col("__reach"))))
                .alias("__receivers"))
        )
        spread = (
            index.blocks.join(salts, F.col("__block") == F.col("__b"))
            .select("__block", "__donors", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)).alias("__salt"))
        )
        met = packed.join(spread.hint("shuffle_hash"), ["__block", "__salt"]).select("__receivers", "__donors")
        target_at = [self.columns.index(t) for t in self.targets]
        columns = list(self.columns)

        def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for receivers, donors in zip(batch["__receivers"], batch["__donors"]):
                    r = np.asarray(receivers, dtype=float).reshape(-1, width + 3)
                    d = np.asarray(donors, dtype=float).reshape(-1, width + 1)
                    yield from _nearest_in_block(r, d, width, k, target_at, columns)

        fields = "".join(f"`{c}` double, " for c in columns)
        return met.mapInPandas(
            nearest, fields + "__w bigint, __target int, __distance double, __value double, __count double")


def _nearest_in_block(r, d, width, k, target_at, columns) -> Iterator[pd.DataFrame]:
    """The k nearest donors of each receiver and target in one block, by (distance, value).

    ``r``: vector, weight, target and the distance to beat; ``d``: vector, count.
    Receivers go through in tiles of one missing pattern and target, small enough for the processor's cache.
    """
    x, target, reach = r[:, :width], r[:, width + 1].astype(np.int64), r[:, width + 2]
    y, count = d[:, :width], d[:, width]
    donor_has = ~np.isnan(y[0])
    by_column = np.ascontiguousarray(y.T)
    tile_rows = max(1, _TILE // len(y))
    squares, gaps = np.empty((tile_rows, len(y))), np.empty((tile_rows, len(y)))
    found = []
    kinds, kind = np.unique(np.column_stack([target, ~np.isnan(x)]), axis=0, return_inverse=True)
    for p in range(len(kinds)):
        mine = np.flatnonzero(kind.ravel() == p)
        i = int(kinds[p, 0])
        value = by_column[target_at[i]]
        dims = np.flatnonzero((kinds[p, 1:] == 1) & donor_has)
        for start in range(0, len(mine), tile_rows):
            rows = mine[start : start + tile_rows]
            square, gap = squares[: len(rows)], gaps[: len(rows)]
            square[:] = 0.0
            for c in dims:
                np.subtract(x[rows, c, None], by_column[c], out=gap)
                np.multiply(gap, gap, out=gap)
                square += gap
            square *= width / len(dims)
            near = _k_smallest(square, np.arange(len(rows)), reach[rows], value, count, k)
            if near is not None:
                at, donor, distance = near
                found.append((rows[at], np.full(len(at), i), distance, value[donor], count[donor]))
    if found:
        at, target, distance, value, count = (np.concatenate(part) for part in zip(*found))
        out = pd.DataFrame(x[at], columns=columns)
        yield out.assign(__w=r[at, width].astype(np.int64), __target=target.astype(np.int32),
                         __distance=distance, __value=value, __count=count)


def _k_smallest(square, asked, reach, value, count, k):
    """(row, donor, distance) of the k nearest per asked row, each donor counted as often as it occurs."""
    slack = 1 + 1e-12  # squares this close can be equal as distances
    limit = reach[asked] * reach[asked]
    some = square if len(asked) == len(square) else square[asked]
    unbounded = np.flatnonzero(np.isinf(limit))
    if len(unbounded) and some.shape[1] > k:
        limit[unbounded] = np.partition(some[unbounded], k - 1, axis=1)[:, k - 1]
    at, donor = np.nonzero(some <= (limit * slack)[:, None])
    if not len(at):
        return None
    distance = np.sqrt(some[at, donor])
    order = np.lexsort((value[donor], distance, at))
    at, donor, distance = at[order], donor[order], distance[order]
    before = np.cumsum(count[donor]) - count[donor]
    is_first = np.append(True, at[1:] != at[:-1])
    first = np.maximum.accumulate(np.where(is_first, np.arange(len(at)), 0))
    kept = before - before[first] < k
    return asked[at[kept]], donor[kept], distance[kept]
