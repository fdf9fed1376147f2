"""Session settings and the one way intermediate tables are kept."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tidecart", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # beyond this size the JVM does not compile a method, and wide parsing runs at half speed
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str | None:
    """The folder every executor can reach, as named by the cluster, or None."""
    return spark.conf.get("spark.checkpoint.dir", None)


BATCH_ROWS, BATCH_BYTES = 1000, 1024 * 1024


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand Python workers less at a time, for the rest of the session: JVM and worker each hold a batch of whole texts."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        held = spark.conf.get(name).removesuffix("b")  # Spark's own default too, which get(name, None) would not tell
        if not held.isdigit() or not 0 < int(held) <= most:
            spark.conf.set(name, most)


_open: list[list[tuple[SparkSession, DataFrame | str]]] = []  # what each open ``pinned_tables`` has to release


def pin(df: DataFrame) -> DataFrame:
    """Keep a table that several jobs read, until the ``pinned_tables`` around it closes, if there is one.

    With a shared folder it is written there as parquet: later jobs prune columns, the lineage is
    cut, and a lost executor costs nothing. Without one it is cached and rebuilt from its lineage
    where blocks are lost.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession)
    if folder is None:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        held: DataFrame | str = kept
    else:
        held = f"{folder.rstrip('/')}/tidecart-{uuid.uuid4().hex}"
        df.write.parquet(held)
        kept = spark.read.parquet(held)
    if _open:
        _open[-1].append((spark, held))
    return kept


def pin_result(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """Pin what ``make`` returns; what it pinned on the way goes from the shared folder at once.

    Without such a folder the result is not yet worked out, so the tables on the way stay as long as it does.
    """
    if shared_folder(spark) is None:
        return pin(make())
    with pinned_tables():
        kept = pin(make())
        if len(_open) > 1:
            _open[-2].append(_open[-1][-1])
        _open[-1].pop()
    release_shuffles(spark)
    return kept


def release_shuffles(spark: SparkSession) -> None:
    """Let the driver collect its garbage: Spark deletes the files of a shuffle once no plan refers to it any more."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def pinned_tables() -> Iterator[None]:
    """Release on leaving what was pinned inside: write results before that.

    ``with pinned_tables(): clean(raw).write.parquet(out)``
    """
    held: list[tuple[SparkSession, DataFrame | str]] = []
    _open.append(held)
    try:
        yield
    finally:
        _open[:] = [x for x in _open if x is not held]  # not by what they hold: nested ones may hold the same
        for spark, what in held:
            if isinstance(what, str):
                place = spark._jvm.org.apache.hadoop.fs.Path(what)
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
            else:
                what.unpersist()
