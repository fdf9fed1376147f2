"""Column selection, renaming and the search for columns that carry no information."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Identifier columns that go when nearly unique, and the two shares in percent.
IDENTIFIER_COLUMNS = ["Uniq Id", "Pageurl"]
MOSTLY_MISSING_PERCENT = 95
NEARLY_UNIQUE_SHARE = 0.95


def keep_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Listed columns in the table's own order; absent ones are ignored."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in wanted])


def has_columns(df: DataFrame, wanted) -> bool:
    return set(wanted) <= set(df.columns)


def normal_name(name: str) -> str:
    return re.sub(r"\W", "", name.strip().lower().replace(" ", "_"))


def normalize_names(df: DataFrame) -> DataFrame:
    """Trimmed, lower-case names with underscores; two columns may not end up with one name."""
    names = [normal_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns share a name after normalizing: {twice}")
    return df.toDF(*names)


@dataclass
class LowValueColumns:
    """Columns to drop, with the reason for each, decided once on the data it was fitted to."""

    identifiers: list[str] = field(default_factory=lambda: list(IDENTIFIER_COLUMNS))
    reasons: dict[str, str] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> LowValueColumns:
        """One aggregate for all columns: null counts, and min = max as the one-value test.

        Texts are tested by their hashes, which Spark aggregates without keeping texts: two hashes
        mean two values, and the rare column with one hash is looked at again.
        """
        self.reasons = {}
        texts = {n for n, t in df.dtypes if t == "string"}
        aggregates = [F.count(F.lit(1)).alias("rows")]
        for i, name in enumerate(df.columns):
            c = F.col(f"`{name}`")
            aggregates.append(F.count(c).alias(f"filled{i}"))
            key = F.when(c.isNotNull(), F.xxhash64(c)) if name in texts else c
            orderable = "map<" not in dict(df.dtypes)[name]
            single = F.min(key) == F.max(key) if orderable else F.lit(False)
            aggregates.append(single.alias(f"single{i}"))
        row = df.agg(*aggregates).first().asDict()
        again = [i for i, n in enumerate(df.columns) if n in texts and row[f"single{i}"]]
        if again:
            exact = [(F.min(F.col(f"`{df.columns[i]}`")) == F.max(F.col(f"`{df.columns[i]}`"))).alias(f"single{i}")
                     for i in again]
            row.update(df.agg(*exact).first().asDict())
        if row["rows"] == 0:
            return self
        asked = []
        for i, name in enumerate(df.columns):
            missing = (row["rows"] - row[f"filled{i}"]) / row["rows"] * 100
            if missing > MOSTLY_MISSING_PERCENT:
                self.reasons[name] = f"{missing:.1f}% missing"
            elif row[f"single{i}"]:
                self.reasons[name] = "one value only"
            elif name in self.identifiers:
                asked.append(name)
        for name in self._nearly_unique(df, asked, row["rows"] * NEARLY_UNIQUE_SHARE):
            self.reasons[name] = "identifier"
        return self

    def _nearly_unique(self, df: DataFrame, names: list[str], least: float) -> list[str]:
        """The columns with more than ``least`` different values.

        Different hashes are different values, so counting hashes, for all columns in one job, proves
        nearly every case; only a column that falls just short is counted by its values.
        """
        if not names:
            return []
        cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{n}`").isNotNull().alias("there"), F.xxhash64(F.col(f"`{n}`")).alias("h"))
                          for i, n in enumerate(names)])
        counted = df.select(F.inline(cells)).where("there").select("i", "h").distinct().groupBy("i").count()
        hashes = {r["i"]: r["count"] for r in counted.collect()}
        found = [n for i, n in enumerate(names) if hashes.get(i, 0) > least]
        for i, n in enumerate(names):
            if n not in found and hashes.get(i, 0) > 0.999 * least:
                exact = df.where(F.col(f"`{n}`").isNotNull()).select(f"`{n}`").distinct().count()
                found += [n] if exact > least else []
        return found

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in self.reasons])
