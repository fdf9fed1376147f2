"""Replay a fitted model on a growing folder of landed files.

The folder run reads everything again each time. A model that is already fitted needs only the new
files, which Structured Streaming keeps track of.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidecart.functions.parsing import latin1_to_cp1252, null_markers_to_null
from tidecart.session import pinned_tables
from tidecart.sources.csv_files import CHARSETS, WIDE, encoding_name


def read_landing(
    spark: SparkSession, folder: str, columns: list[str], encoding: str = "utf-8", multi_line: bool = True
) -> DataFrame:
    """New CSV files of a folder as an all-string stream with null markers turned into null.

    A stream cannot test a file before it reads it: the encoding is named, and files are read as a
    whole so that quoted newlines are kept. ``multi_line=False`` splits large files without any.
    """
    encoding = encoding_name(encoding)
    layout = ", ".join(f"`{c}` string" for c in columns)
    raw = (
        spark.readStream.schema(layout).option("header", True).option("escape", '"')
        .option("multiLine", multi_line or encoding in WIDE).option("encoding", CHARSETS[encoding]).csv(folder)
    )
    cell = lambda c: latin1_to_cp1252(c) if encoding == "cp1252" else c
    return raw.select(*[null_markers_to_null(cell(F.col(f"`{c}`"))).alias(c) for c in columns])


def append_clean(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Clean what has landed since the last run, append it as parquet, and stop.

    Tables that the model pins go with their batch. Each micro-batch replaces its own folder, so a batch that is run again after a failure does
    not add its rows twice.
    """
    def write(batch: DataFrame, number: int) -> None:
        with pinned_tables():
            transform(batch).write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
