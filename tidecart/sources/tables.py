"""Catalog tables and file sinks."""

from __future__ import annotations

import re
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREVIEW_ROWS = 5


def table_name_for(path: str) -> str:
    """Catalog name of a file: its stem with anything but letters, digits and _ replaced."""
    stem = PurePosixPath(path).name.split(".")[0]
    name = re.sub(r"[^0-9a-zA-Z_]", "_", stem)
    return f"t_{name}" if name[:1].isdigit() else name


def load_table(df: DataFrame, name: str, overwrite: bool = False, path: str | None = None) -> None:
    """Create the table. An existing one is left untouched unless ``overwrite`` is set.

    With ``path`` its files go there instead of the warehouse.
    """
    writer = df.write.mode("overwrite" if overwrite else "ignore")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def preview_tables(spark: SparkSession, n: int = PREVIEW_ROWS) -> dict[str, DataFrame]:
    """The first rows of every table; empty when the catalog is."""
    return {name: preview(spark.table(name), n) for name in list_tables(spark)}


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return df.limit(n)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """UTF-8 CSV with a header, replacing what was there. ``single_file`` is for short reports.

    Nested columns are written as JSON text, as CSV has no form for them.
    """
    flat = df.select(*[
        F.to_json(F.col(f"`{n}`")).alias(n) if t.startswith(("struct", "array", "map")) else F.col(f"`{n}`")
        for n, t in df.dtypes
    ])
    (flat.coalesce(1) if single_file else flat).write.mode("overwrite").option("header", True).option(
        "escape", '"').option("encoding", "UTF-8").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, characters kept as they are."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
