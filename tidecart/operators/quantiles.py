"""Exact, linearly interpolated quantiles without a whole column in one buffer.

Spark's ``percentile`` keeps every distinct value of a column in one aggregation buffer. Here a
sketch only proposes a bracket around each wanted rank; counting the rows below and inside the
bracket makes the answer exact, and the bracket is narrowed until its values are few enough to
look at. Every pass is one map-side aggregate over all columns at once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GATHER_VALUES = 5_000
_SKETCH = 10_000
_STEPS = 256


@dataclass
class _Bracket:
    column: str
    prob: float
    first: int  # zero-based ranks of the two order statistics to interpolate
    last: int
    weight: float
    low: float
    high: float
    expected: float
    answer: float | None = None

    def settle(self, a: float, b: float) -> None:
        self.answer = a + (b - a) * self.weight if b != a else a


def exact_quantiles(
    df: DataFrame, wanted: dict[str, list[float]], gather: int = GATHER_VALUES
) -> dict[str, dict[float, float | None]]:
    """``{column: [probability, ...]}`` -> ``{column: {probability: value or None}}``."""
    columns = list(wanted)
    if not columns:
        return {}
    x = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in columns}
    aggregates = []
    for i, c in enumerate(columns):
        edges = [e for p in wanted[c] for e in (max(0.0, p - 2 / _SKETCH), min(1.0, p + 2 / _SKETCH))]
        aggregates += [
            F.count(x[c]).alias(f"n{i}"),
            F.min(x[c]).alias(f"lo{i}"),
            F.max(x[c]).alias(f"hi{i}"),
            F.percentile_approx(x[c], edges or [0.5], _SKETCH).alias(f"q{i}"),
        ]
    first = df.agg(*aggregates).first()

    result: dict[str, dict[float, float | None]] = {c: {} for c in columns}
    ends: dict[str, tuple[float, float]] = {}
    open_brackets: list[_Bracket] = []
    for i, c in enumerate(columns):
        n = first[f"n{i}"]
        for j, p in enumerate(wanted[c]):
            if n == 0:
                result[c][p] = None
                continue
            ends[c] = (first[f"lo{i}"], first[f"hi{i}"])
            place = p * (n - 1)
            low, high, expected = first[f"q{i}"][2 * j], first[f"q{i}"][2 * j + 1], n * 5 / _SKETCH
            if n <= gather:  # few enough to look at all; a sketch's bracket could miss the next rank
                low, high, expected = *ends[c], n
            open_brackets.append(
                _Bracket(c, p, math.floor(place), math.ceil(place), place - math.floor(place), low, high, expected))
    todo = open_brackets
    while todo:
        small = [b for b in todo if b.expected <= gather]
        large = [b for b in todo if b.expected > gather]  # before the next line makes missed ones large
        large += _gather(df, x, small, gather) if small else []
        assert len(set(map(id, large))) == len(large)
        if large:
            _narrow(df, x, large, ends)
        todo = [b for b in large if b.answer is None]
    for b in open_brackets:
        result[b.column][b.prob] = b.answer
    return result


def _merged(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Disjoint spans in ascending order that cover the given ones."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _gather(df, x, brackets, gather) -> list[_Bracket]:
    """Count each value inside a bracket, and the rows between brackets as one; settle the ranks.

    Every cell gets the number of its span (odd inside a bracket, even between two), so that one
    pass gives both. Returns the brackets this did not settle.
    """
    columns = sorted({b.column for b in brackets})
    cells = []
    for i, c in enumerate(columns):
        spans = _merged([(b.low, b.high) for b in brackets if b.column == c])
        place = F.when(x[c].isNull(), F.lit(None).cast("int"))
        for number, (low, high) in enumerate(spans):
            place = place.when(x[c] < low, 2 * number).when(x[c] <= high, 2 * number + 1)
        place = place.otherwise(2 * len(spans))
        cells.append(F.struct(F.lit(i).alias("i"), place.alias("span"), x[c].alias("v")))
    inside = F.col("span") % 2 == 1
    limit = 4 * gather * len(brackets)
    rows = (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("span").isNotNull())
        .groupBy("i", "span", F.when(inside, F.col("v")).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .limit(limit)
        .toPandas()
    )
    missed = []
    for i, c in enumerate(columns):
        mine = rows[rows["i"] == i].sort_values(["span", "v"])
        reach = mine["n"].cumsum().to_numpy()
        values = mine["v"].to_numpy()
        for b in (b for b in brackets if b.column == c):
            held = [math.nan, math.nan]
            if len(rows) < limit:
                held = [float(values[k]) for k in np.searchsorted(reach, [b.first, b.last], side="right")]
            if any(map(math.isnan, held)):
                b.expected = math.inf
                missed.append(b)
            else:
                b.settle(*held)
    return missed


def _narrow(df, x, brackets, ends) -> None:
    """Count around and inside each bracket, then move to the part that holds the wanted ranks."""
    steps = [s / _STEPS for s in range(_STEPS + 1)]
    aggregates = []
    for i, b in enumerate(brackets):
        c = x[b.column]
        inside = (c > b.low) & (c < b.high)
        aggregates += [
            F.count_if(c < b.low).alias(f"below{i}"),
            F.count_if(c == b.low).alias(f"low{i}"),
            F.count_if(inside).alias(f"inside{i}"),
            F.count_if(c == b.high).alias(f"high{i}"),
            F.percentile_approx(F.when(inside, c), steps, _SKETCH).alias(f"q{i}"),
        ]
    counts = df.agg(*aggregates).first()
    for i, b in enumerate(brackets):
        start = counts[f"below{i}"]
        after_low = start + counts[f"low{i}"]
        after_inside = after_low + counts[f"inside{i}"]
        after_high = after_inside + (counts[f"high{i}"] if b.high != b.low else 0)
        if b.first < start or b.last >= after_high:
            # the sketch missed: fall back to the whole range on that side
            b.low = ends[b.column][0] if b.first < start else b.low
            b.high = ends[b.column][1] if b.last >= after_high else b.high
            b.expected = math.inf
            continue
        held = [b.low if r < after_low else b.high if r >= after_inside else None for r in (b.first, b.last)]
        if None not in held:
            b.settle(*held)
            continue
        size, cuts = counts[f"inside{i}"], counts[f"q{i}"]
        if b.first >= after_low:
            step = math.floor((b.first - after_low) / size * _STEPS) - 1
            b.low = cuts[step] if step >= 0 else b.low
        if b.last < after_inside:
            step = math.ceil((b.last - after_low + 1) / size * _STEPS) + 1
            b.high = cuts[step] if step <= _STEPS else b.high
        b.expected = size * 5 / _STEPS
