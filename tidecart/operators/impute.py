"""Imputation chosen per column from its missing share."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.operators.chained import ChainedImputer
from tidecart.operators.knn import NEIGHBOURS, KnnImputer
from tidecart.operators.profile import most_correlated_of
from tidecart.operators.quantiles import exact_quantiles

# Shares in percent that choose the strategy, and features for a per-column search.
KNN_BELOW_PERCENT = 5
CHAINED_BELOW_PERCENT = 30
SKIP_FROM_PERCENT = 95
KNN_FEATURES = 6


def missing_percent(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """One aggregate; NaN counts as missing. None for an empty table."""
    if not columns:
        return {}
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))).alias(f"n{i}") for i, c in enumerate(columns)],
    ).first()
    rows = row["rows"]
    return {c: (rows - row[f"n{i}"]) / rows * 100 if rows else None for i, c in enumerate(columns)}


def strategy_for(percent: float | None) -> str:
    if percent is None or percent <= 0 or percent >= SKIP_FROM_PERCENT:
        return "none"
    if percent < KNN_BELOW_PERCENT:
        return "knn"
    if percent < CHAINED_BELOW_PERCENT:
        return "chained"
    return "median"


def imputation_plan(df: DataFrame, columns: list[str]) -> DataFrame:
    """The decision as a table: (column, missing_pct, strategy)."""
    shares = missing_percent(df, [c for c in columns if c in df.columns])
    rows = [(c, p, strategy_for(p)) for c, p in shares.items()]
    return df.sparkSession.createDataFrame(rows, "column string, missing_pct double, strategy string")


def medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact medians; 0 for a column without values."""
    found = exact_quantiles(df, {c: [0.5] for c in columns})
    return {c: 0.0 if found[c][0.5] is None else found[c][0.5] for c in columns}


def fill_median(df: DataFrame, columns: list[str]) -> DataFrame:
    values = medians(df, columns)
    return df.withColumns({
        c: F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), F.lit(v)) for c, v in values.items()
    })


def complete_rows(df: DataFrame, sets: dict[str, list[str]]) -> dict[str, int]:
    """For each set of columns the rows that have them all, in one aggregate."""
    if not sets:
        return {}
    present = lambda c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).isNotNull()
    counts = [F.count_if(reduce(lambda a, b: a & b, map(present, columns))).alias(str(i)) for i, columns in enumerate(sets.values())]
    return dict(zip(sets, df.agg(*counts).first()))


@dataclass
class SmartImputer:
    """Nearest neighbours below 5 % missing, chained equations below 30 %, the median from there on.

    ``per_column=False``: the columns of one strategy are imputed together, from each other only.
    ``per_column=True``: each nearest-neighbour column searches on itself and the five columns most
    correlated with it, and the chained equations use all columns that need imputing; only the
    column a step is for is written.
    """

    columns: list[str]
    per_column: bool = False
    strategies: dict[str, str] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> SmartImputer:
        present = [c for c in self.columns if c in df.columns]
        shares = missing_percent(df, present)
        self.strategies = {c: s for c in present if (s := strategy_for(shares[c])) != "none"}
        eligible = list(self.strategies)
        knn = [c for c in eligible if self.strategies[c] == "knn"]
        chained = [c for c in eligible if self.strategies[c] == "chained"]
        median = [c for c in eligible if self.strategies[c] == "median"]
        self.models = []
        if self.per_column:
            if len(eligible) == 1:  # no second column to learn from
                median, knn, chained = eligible, [], []
            features_of = most_correlated_of(df, knn, eligible, KNN_FEATURES)
            complete = complete_rows(df, features_of)
            for c in knn:
                features, k = features_of[c], min(NEIGHBOURS, complete[c])
                if k == 0:
                    median.append(c)
                else:
                    self.models.append(KnnImputer(features, k, [c]).fit(df))
            if chained:
                self.models.append(ChainedImputer(eligible, chained).fit(df))
        else:
            if knn:
                self.models.append(KnnImputer(knn).fit(df))
            if chained:
                self.models.append(ChainedImputer(chained).fit(df))
        self.median_values = medians(df, median) if median else {}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        columns = df.columns
        for model in self.models:
            df = model.fills(df)
        filled = {}
        for c in self.strategies:
            x = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))
            fill = F.lit(self.median_values[c]) if c in self.median_values else F.col(f"`__fill_{c}`")
            filled[c] = F.coalesce(x, fill)
        return df.withColumns(filled).select(*[F.col(f"`{c}`") for c in columns]) if filled else df
