"""A folder of raw CSV files to clean CSV folders and catalog tables."""

from __future__ import annotations

import traceback
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidecart.plans import recipes
from tidecart.session import pin
from tidecart.sources import csv_files, search_results, tables


@dataclass
class TableResult:
    path: str
    table: str
    rows: int | None = None
    error: str | None = None
    trace: str | None = None


def run_etl(
    spark: SparkSession, source_folder: str, clean_folder: str, overwrite: bool = False,
    multi_line: bool | None = None,
) -> list[TableResult]:
    """Clean every file, write it as CSV and load it as a table.

    A file that fails does not stop the others; the failures are raised together at the end.
    """
    results = []
    for path in csv_files.csv_files(spark, source_folder):
        result = TableResult(path, tables.table_name_for(path))
        results.append(result)
        try:
            raw = csv_files.read_csv(spark, path, multi_line=multi_line)
            clean = pin(recipes.recipe_for(result.table)(raw))
            written = Observation()
            counted = clean.observe(written, F.count(F.lit(1)).alias("rows"))
            name = path.rsplit("/", 1)[-1]
            tables.write_csv(counted, f"{clean_folder.rstrip('/')}/cleaned_{name}")
            result.rows = written.get["rows"]
            tables.load_table(clean, result.table, overwrite)
        except Exception as failure:
            result.error, result.trace = f"{type(failure).__name__}: {failure}", traceback.format_exc()
    failed = [r for r in results if r.error]
    if failed:
        raise RuntimeError("; ".join(f"{r.table}: {r.error}" for r in failed))
    return results


@dataclass
class ProductRun:
    products: DataFrame
    profile: dict[str, DataFrame]
    reports: dict[str, DataFrame]


def run_product_search(spark: SparkSession, responses: DataFrame, out_folder: str) -> ProductRun:
    """Landed search responses -> records -> latest per item -> files, profile and reports."""
    out = out_folder.rstrip("/")
    records = pin(search_results.explode_responses(responses))
    tables.write_json(records, f"{out}/save_data/products_json")
    tables.write_csv(records, f"{out}/save_data/products_csv")
    products = pin(recipes.latest_products(records))
    tables.write_csv(products, f"{out}/clean_data/cleaned_products_csv")
    tables.write_json(products, f"{out}/clean_data/cleaned_products_json")
    found = recipes.explore_products(products)
    for name in ("top_reviews", "top_sellers", "mean_price_by_query"):
        if name in found:
            tables.write_csv(found[name], f"{out}/reports/{name}", single_file=True)
    return ProductRun(products, recipes.profile_tables(records), found)
