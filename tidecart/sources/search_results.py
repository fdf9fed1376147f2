"""Landed product-search responses and product record files (JSON)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_records(spark: SparkSession, path: str, schema: StructType | str | None = None, lines: bool = False) -> DataFrame:
    """JSON objects as rows, from one array per file or, splittable, from one object per line."""
    reader = spark.read.option("multiLine", not lines)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def explode_responses(responses: DataFrame, query: Column | None = None, fetch_time: Column | None = None) -> DataFrame:
    """One row per found item, tagged with its search term and fetch time; error responses are left out.

    By default the term comes from the response's ``query`` column and the time from its
    ``fetch_time`` column, or from the file's modification time where there is none.
    """
    ok = responses
    if "error" in responses.columns:
        ok = ok.where(F.col("error").isNull())
    if query is None:
        query = F.col("query")
    if fetch_time is None:
        fetch_time = (
            F.col("fetch_time") if "fetch_time" in responses.columns
            else F.date_format("_metadata.file_modification_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        )
    items = ok.select(
        F.explode("organic_results").alias("item"), query.alias("__query"), fetch_time.alias("__time")
    )
    return items.select("item.*", "__query", "__time").drop("query", "fetch_time").withColumnsRenamed(
        {"__query": "query", "__time": "fetch_time"}
    )


def concatenate(parts: list[DataFrame]) -> DataFrame:
    """Bag union by name; a column missing in one part is null there."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole
