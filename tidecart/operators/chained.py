"""Chained-equation imputation in two passes over the data, however many rounds it takes.

Each round regresses one column after the other on the rest and overwrites the cells that were
missing. All regressions are linear, so for the rows of one missing pattern every filled cell is a
linear function of the cells that are present. The cross products of the *filled* table therefore
follow from the cross products of the *present* cells per pattern: one aggregate. All rounds are
then small matrix algebra, a second aggregate finds the round at which the changes became small,
and the result is one projection. Only patterns that occur are ever looked at, so the number of
columns is not limited; those of new rows are worked out from the regressions, batch by batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart.session import pin

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rounds and stopping share of the largest present value; the regression's priors,
# iterations and tolerance.
ROUNDS = 10
STOP_SHARE = 1e-3
PRIOR = 1e-6
RIDGE_ITERATIONS = 300
RIDGE_TOLERANCE = 1e-3

_FEW = 10  # columns whose patterns are few enough without a count
PATTERN_BYTES = 64 * 1024 * 1024  # of cross products per pattern that the driver takes

Regression = tuple[int, np.ndarray, float]  # column, weights of the other columns, constant


def bayesian_ridge(gram: np.ndarray, cross: np.ndarray, square: float, n: int) -> np.ndarray:
    """Weights of a ridge regression whose two precisions maximize the evidence.

    Takes centred sums only: predictors' cross products, predictor-target products, target's sum of
    squares and the row count.
    """
    eigenvalues, axes = np.linalg.eigh(gram)
    eigenvalues = np.clip(eigenvalues, 0.0, None)
    turned = axes.T @ cross
    noise = 1.0 / (square / n + np.finfo(float).eps)
    spread = 1.0

    def solve() -> tuple[np.ndarray, float]:
        w = axes @ (turned / (eigenvalues + spread / noise))
        return w, max(square - 2 * w @ cross + w @ gram @ w, 0.0)

    previous = None
    for _ in range(RIDGE_ITERATIONS):
        weights, residual = solve()
        effective = np.sum(noise * eigenvalues / (spread + noise * eigenvalues))
        spread = (effective + 2 * PRIOR) / (weights @ weights + 2 * PRIOR)
        noise = (n - effective + 2 * PRIOR) / (residual + 2 * PRIOR)
        if previous is not None and np.abs(previous - weights).sum() < RIDGE_TOLERANCE:
            break
        previous = weights
    return solve()[0]


def presence(patterns: list[str]) -> np.ndarray:
    """Patterns such as ``1101`` as rows of booleans."""
    return np.array([[c == "1" for c in p] for p in patterns], dtype=bool)


def replayed(present: np.ndarray, rounds: list[list[Regression]]) -> list[np.ndarray]:
    """Per round, the maps (pattern, column, 1 + columns) from present to filled cells."""
    n, k = present.shape
    maps = np.zeros((n, k, k + 1))
    maps[:, np.arange(k), np.arange(1, k + 1)] = present
    history = [maps.copy()]
    for regressions in rounds:
        for j, w, base in regressions:
            _refill(maps, present, j, w, base)
        history.append(maps.copy())
    return history


def _refill(maps: np.ndarray, present: np.ndarray, j: int, w: np.ndarray, base: float) -> None:
    holes = ~present[:, j]
    update = np.einsum("o,poc->pc", w, np.delete(maps[holes], j, axis=1))
    update[:, 0] += base
    maps[holes, j] = update


def advance(x: np.ndarray, present: np.ndarray, regressions: list[Regression]) -> None:
    """Fill the holes of rows (centred, zero where nothing was filled yet) by the regressions, one after the other."""
    for j, w, base in regressions:
        holes = ~present[:, j]
        x[holes, j] = np.delete(x[holes], j, axis=1) @ w + base


def regression(total: np.ndarray, j: int) -> Regression:
    """The regression of column ``j`` from the cross products of (1, filled columns) over the rows that have it."""
    n, sums, products = total[0, 0], total[0, 1:], total[1:, 1:]
    others = [i for i in range(len(sums)) if i != j]
    centred = products - np.outer(sums, sums) / n
    w = bayesian_ridge(centred[np.ix_(others, others)], centred[others, j], centred[j, j], int(n))
    return j, w, (sums[j] - w @ sums[others]) / n


def _rows_of(batch) -> tuple[np.ndarray, np.ndarray]:
    """Filled values and presence of a batch of (x array<double>, pattern)."""
    x = np.array(batch.column(0).to_pylist(), dtype=float)
    return x, presence(batch.column(1).to_pylist())


@dataclass
class ChainedImputer:
    """Fill the holes of ``targets`` from regressions among ``columns``."""

    columns: list[str]
    targets: list[str] | None = None
    rounds: int = ROUNDS
    pattern_bytes: int = PATTERN_BYTES
    means: dict[str, float] = field(default_factory=dict)

    def _centred(self) -> list[Column]:
        """Distance from the column mean, 0 where missing."""
        return [F.coalesce(F.col(f"`{c}`").cast("double") - F.lit(self.means[c]), F.lit(0.0))
                for c in self.columns]

    def _pattern(self) -> Column:
        """A text with 1 where a column is present."""
        return F.concat(*[F.when(F.col(f"`{c}`").isNotNull(), F.lit("1")).otherwise(F.lit("0")) for c in self.columns])

    def fit(self, df: DataFrame) -> ChainedImputer:
        k = len(self.columns)
        self.targets = self.targets or list(self.columns)
        df = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(c) for c in self.columns])
        x = [F.col(f"`{c}`") for c in self.columns]
        row = df.agg(*[a for i, c in enumerate(x) for a in (
            F.avg(c).alias(f"mean{i}"), F.max(F.abs(c)).alias(f"size{i}"), F.count(c).alias(f"n{i}"))]).first()
        if any(row[f"n{i}"] == 0 for i in range(k)):
            raise ValueError("a column without any value cannot be chained")
        self.means = {c: row[f"mean{i}"] for i, c in enumerate(self.columns)}
        stop = STOP_SHARE * max(row[f"size{i}"] for i in range(k))
        order = sorted(range(k), key=lambda i: -row[f"n{i}"])  # fewest missing first, stable

        z = self._centred()
        patterns = df.select(self._pattern().alias("pattern")).distinct().count() if k > _FEW else 1
        if patterns * (k + 1) ** 2 * 8 > self.pattern_bytes:
            rows = pin(df.select(F.array(*z).alias("x"), self._pattern().alias("pattern")))
            self.regressions = self._run_over_rows(rows, order)
            self._choose(df, stop)
            return self
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        sums = df.groupBy(self._pattern().alias("pattern")).agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.sum(z[i]).alias(f"s{i}") for i in range(k)],
            *[F.sum(z[i] * z[j]).alias(f"p{i}_{j}") for i, j in pairs],
        ).toPandas()
        moments = np.zeros((len(sums), k + 1, k + 1))
        moments[:, 0, 0] = sums["rows"]
        for i in range(k):
            moments[:, 0, i + 1] = moments[:, i + 1, 0] = sums[f"s{i}"]
        for i, j in pairs:
            moments[:, i + 1, j + 1] = moments[:, j + 1, i + 1] = sums[f"p{i}_{j}"]

        self.regressions = self._run(presence(list(sums["pattern"])), moments, order)
        self._choose(df, stop)
        return self

    def _run(self, present: np.ndarray, moments: np.ndarray, order: list[int]) -> list[list[Regression]]:
        """The regressions of every round over the patterns that occur."""
        k = len(self.columns)
        if k == 1:
            return []
        maps = replayed(present, [])[0]
        rounds = []
        for _ in range(self.rounds):
            done = []
            for j in order:
                has = present[:, j]
                t, m = maps[has], moments[has]
                total = np.empty((k + 1, k + 1))
                total[1:, 1:] = np.einsum("pac,pcd,pbd->ab", t, m, t, optimize=True)
                total[0, 1:] = total[1:, 0] = np.einsum("pac,pc->a", t, m[:, :, 0])
                total[0, 0] = m[:, 0, 0].sum()
                done.append(regression(total, j))
                _refill(maps, present, *done[-1])
            rounds.append(done)
        return rounds

    def _run_over_rows(self, rows: DataFrame, order: list[int]) -> list[list[Regression]]:
        """The same from a table of (x, pattern): a pass per regression brings (columns + 1) squared sums to the driver."""
        k = len(self.columns)

        def total_of(table: DataFrame, j: int, done: list[Regression]) -> np.ndarray:
            def sums(batches):
                import pyarrow as pa

                total = np.zeros((k + 1, k + 1))
                for batch in batches:
                    x, present = _rows_of(batch)
                    has = present[:, j]
                    x, present = x[has], present[has]
                    advance(x, present, done)
                    one = np.column_stack([np.ones(len(x)), x])
                    total += one.T @ one
                yield pa.RecordBatch.from_pydict({"cell": pa.array(range((k + 1) ** 2), pa.int32()), "value": pa.array(total.ravel())})

            found = table.mapInArrow(sums, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
            total = np.zeros((k + 1) ** 2)
            total[found["cell"]] = found["value"]
            return total.reshape(k + 1, k + 1)

        def after(table: DataFrame, done: list[Regression]) -> DataFrame:
            def filled(batches):
                import pyarrow as pa

                for batch in batches:
                    x, present = _rows_of(batch)
                    advance(x, present, done)
                    values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), pa.array(x.ravel()))
                    yield pa.RecordBatch.from_arrays([values, batch.column(1)], names=["x", "pattern"])

            return pin(table.mapInArrow(filled, "x array<double>, pattern string"))

        rounds = []
        for r in range(self.rounds):
            done: list[Regression] = []
            for j in order:
                done.append(regression(total_of(rows, j, done), j))
            rounds.append(done)
            if r + 1 < self.rounds:
                rows = after(rows, done)
        return rounds

    def _choose(self, df: DataFrame, stop: float) -> None:
        """Stop after the first round in which no row changed by ``stop`` or more in total."""
        rounds = self.regressions
        if not rounds:
            return
        n_rounds, whole = len(rounds), "1" * len(self.columns)

        def changes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                z = np.column_stack([np.ones(len(batch)), batch.drop(columns="__pattern").to_numpy(dtype=float)])
                largest = np.zeros(n_rounds)
                if batch["__pattern"].nunique() * z.shape[1] > len(z):  # row by row is less work than a map for each pattern
                    present, now = presence(list(batch["__pattern"])), z[:, 1:].copy()
                    for i, regressions in enumerate(rounds):
                        before = now.copy()
                        advance(now, present, regressions)
                        largest[i] = np.abs(now - before).sum(axis=1).max()
                    yield pd.DataFrame([largest], columns=[f"r{i}" for i in range(n_rounds)])
                    continue
                for pattern, at in batch.groupby("__pattern").indices.items():
                    maps = np.concatenate(replayed(presence([pattern]), rounds))
                    moved = np.abs(np.einsum("rjc,nc->rnj", np.diff(maps, axis=0), z[at])).sum(axis=2)
                    largest = np.maximum(largest, moved.max(axis=1))
                yield pd.DataFrame([largest], columns=[f"r{i}" for i in range(n_rounds)])

        named = [c.alias(f"z{i}") for i, c in enumerate(self._centred())]
        moved = (
            df.select(self._pattern().alias("__pattern"), *named)
            .where(F.col("__pattern") != whole)
            .mapInPandas(changes, ", ".join(f"r{i} double" for i in range(n_rounds)))
            .agg(*[F.max(f"r{i}").alias(f"r{i}") for i in range(n_rounds)])
            .first()
        )
        for i in range(n_rounds):
            if moved[i] is None or moved[i] < stop:
                self.regressions = rounds[: i + 1]
                break

    @property
    def rounds_used(self) -> int:
        return len(self.regressions)

    def fills(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``__fill_<target>``, lazily: one projection that asks Python for the fills of rows with a hole."""
        rounds, width = self.regressions, len(self.targets)
        target_at = [self.columns.index(t) for t in self.targets]
        means = [self.means[t] for t in self.targets]

        @F.pandas_udf("array<double>")
        def filled(pattern: pd.Series, *z: pd.Series) -> pd.Series:
            cells = [np.ones(len(pattern)), *[c.to_numpy(dtype=float) for c in z]]
            out = np.empty((len(pattern), width))
            if pattern.nunique() * len(z) > len(pattern):
                x = np.column_stack(cells[1:])
                for regressions in rounds:
                    advance(x, presence(list(pattern)), regressions)
                return pd.Series(list(x[:, target_at] + np.array(means)), index=pattern.index)
            for p, at in pattern.groupby(pattern).indices.items():
                maps = replayed(presence([p]), rounds)[-1][0]
                for i, (row, mean) in enumerate(zip(target_at, means)):
                    value = np.full(len(at), mean)
                    for weight, cell in zip(maps[row], cells):
                        value = value + weight * cell[at]
                    out[at, i] = value
            return pd.Series(list(out), index=pattern.index)

        clean = df.withColumns({c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in self.columns})
        with_fills = clean.withColumn("__fills", filled(self._pattern(), *self._centred()))
        whole = self._pattern() == "1" * len(self.columns)
        picked = {f"__fill_{t}": F.when(~whole, F.col("__fills")[i]) for i, t in enumerate(self.targets)}
        return with_fills.withColumns(picked).drop("__fills")

    def transform(self, df: DataFrame) -> DataFrame:
        filled = {t: F.coalesce(F.col(f"`{t}`"), F.col(f"`__fill_{t}`")) for t in self.targets}
        return self.fills(df).withColumns(filled).drop(*[f"__fill_{t}" for t in self.targets])
