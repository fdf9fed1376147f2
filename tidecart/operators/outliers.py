"""Outlier treatment by interquartile fences."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.functions.features import clip
from tidecart.functions.parsing import without_nan
from tidecart.operators.quantiles import exact_quantiles

# Fence width, the percentages that choose the treatment, the winsorizing quantiles.
FENCE_WIDTH = 1.5
WINSORIZE_BELOW_PERCENT = 5
CAP_BELOW_PERCENT = 15
WINSOR_LOW, WINSOR_HIGH = 0.01, 0.99

NUMERIC_TYPES = ("double", "float", "int", "bigint", "smallint", "tinyint")


def numeric_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t in NUMERIC_TYPES or t.startswith("decimal")]


@dataclass
class OutlierRule:
    low_fence: float
    high_fence: float
    n_outliers: int = 0
    share: float = 0.0  # percent of all rows, nulls included
    action: str = "none"
    low: float | None = None
    high: float | None = None


@dataclass
class OutlierTreatment:
    """Fences and shares come from two rounds of aggregates over all columns together.

    ``exact=False`` replaces the exact quantiles by Spark's sketch: one pass, approximate bounds.
    """

    columns: list[str]
    exact: bool = True
    rules: dict[str, OutlierRule] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> OutlierTreatment:
        self.rules = {}
        df = without_nan(df)
        numeric = numeric_columns(df)
        columns = [c for c in self.columns if c in numeric]
        probs = [WINSOR_LOW, 0.25, 0.75, WINSOR_HIGH]
        if not columns:
            return self
        if self.exact:
            found = exact_quantiles(df, {c: probs for c in columns})
        else:
            row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), probs, 10_000).alias(str(i))
                           for i, c in enumerate(columns)]).first()
            found = {c: dict(zip(probs, row[i] or [None] * 4)) for i, c in enumerate(columns)}
        columns = [c for c in columns if found[c][0.25] is not None]
        for c in columns:
            q1, q3 = found[c][0.25], found[c][0.75]
            margin = FENCE_WIDTH * (q3 - q1)
            self.rules[c] = OutlierRule(q1 - margin, q3 + margin)
        if not columns:
            return self
        counts = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if((F.col(f"`{c}`") < self.rules[c].low_fence) | (F.col(f"`{c}`") > self.rules[c].high_fence))
              .alias(f"out{i}") for i, c in enumerate(columns)],
        ).first()
        for i, c in enumerate(columns):
            rule = self.rules[c]
            rule.n_outliers = counts[f"out{i}"]
            rule.share = rule.n_outliers / counts["rows"] * 100
            if rule.n_outliers == 0:
                continue
            if rule.share < WINSORIZE_BELOW_PERCENT:
                rule.action, rule.low, rule.high = "winsorize", found[c][WINSOR_LOW], found[c][WINSOR_HIGH]
            elif rule.share < CAP_BELOW_PERCENT:
                rule.action, rule.low, rule.high = "cap", rule.low_fence, rule.high_fence
            else:
                rule.action = "keep"
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        df = without_nan(df)
        treated = {
            c: clip(F.col(f"`{c}`").cast("double"), F.lit(r.low), F.lit(r.high))
            for c, r in self.rules.items() if r.low is not None
        }
        return df.withColumns(treated) if treated else df
