"""CSV folders with mixed encodings and ragged rows."""

from __future__ import annotations

import codecs
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidecart.functions.parsing import latin1_to_cp1252, null_markers_to_null, repair_mojibake
from tidecart.sources import quoted_records

# Candidate encodings in order of preference. latin-1 reads any byte and so ends the list.
ENCODINGS = ["utf-8", "cp1252", "latin-1"]
_CORRUPT, _PATH = "_corrupt_record", "_source_path"
# What Spark's reader is told for an encoding. cp1252 is read as latin-1 and moved afterwards.
CHARSETS = {"utf-8": "UTF-8", "cp1252": "ISO-8859-1", "latin-1": "ISO-8859-1", "utf-16": "UTF-16", "utf-32": "UTF-32"}
_NAMES = {"ascii": "utf-8", "utf_8_sig": "utf-8", "iso8859-1": "latin-1", "utf-16-le": "utf-16", "utf-16-be": "utf-16"}
WIDE = ("utf-16", "utf-32")


def encoding_name(name: str) -> str:
    """One of the encodings that are read here, whatever its spelling; an error for any other."""
    try:
        known = codecs.lookup(name).name
    except LookupError:
        known = name
    known = _NAMES.get(known, known)
    if known not in CHARSETS:
        raise ValueError(f"cannot read encoding {name!r}; known are {', '.join(CHARSETS)}")
    return known


def csv_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the CSV files in a folder; an error when there are none."""
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
        .select("path").orderBy("path")
    )
    paths = [r["path"] for r in listing.collect()]
    if not paths:
        raise ValueError(f"no CSV files in {folder}")
    return paths


def detect_encodings(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """(path, encoding) for each file, decided on all of its bytes.

    The text source hands lines over undecoded, so large files are read in splits and each file
    comes down to two flags: is every line valid UTF-8, and is it free of the bytes cp1252 leaves
    undefined.
    """
    return file_facts(spark, paths).select("path", "encoding")


def file_facts(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """(path, encoding, multi_line) for each file, from one pass over all of its bytes.

    A byte-order mark of UTF-16 or UTF-32 at the start settles the encoding. ``multi_line`` is set
    where a line has an odd number of quotes: a quoted field may go on in the next line.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = F.col("value").cast("binary")
    undefined = F.decode(raw, "ISO-8859-1").rlike("[\\x81\\x8d\\x8f\\x90\\x9d]")
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    mark = F.hex(F.substring(raw, 1, 4))
    at_start = F.col("_metadata.file_block_start") == 0
    flags = (
        spark.read.text(paths)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.bool_and(~undefined).alias("cp1252"),
             F.bool_or(quotes % 2 == 1).alias("odd"),
             F.bool_or(at_start & mark.rlike("^(FFFE0000|0000FEFF)")).alias("utf32"),
             F.bool_or(at_start & mark.rlike("^(FFFE|FEFF)")).alias("utf16"))
    )
    utf8, cp1252, latin1 = ENCODINGS
    narrow = F.when(F.col("utf8"), utf8).when(F.col("cp1252"), cp1252).otherwise(latin1)
    encoding = F.when(F.col("utf32"), "utf-32").when(F.col("utf16"), "utf-16").otherwise(narrow)
    return flags.select("path", encoding.alias("encoding"), F.col("odd").alias("multi_line"))


def _reader(spark: SparkSession, encoding: str, multi_line: bool):
    # lines are cut before they are decoded, so wide characters need whole files
    return (
        spark.read.option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line or encoding in WIDE).option("mode", "PERMISSIVE")
        .option("encoding", CHARSETS[encoding])
    )


def _tagged_rows(spark, path, names, encoding, multi_line) -> DataFrame:
    """All columns and, for rows with too few or too many fields, the raw record.

    Columns are not pruned in the parser, which would compare a row with the columns asked for
    instead of the header.
    """
    schema = StructType([StructField(n, StringType()) for n in [*names, _CORRUPT]])
    return (
        _reader(spark, encoding, multi_line).option("columnNameOfCorruptRecord", _CORRUPT)
        .option("columnPruning", False).schema(schema).csv(path)
    )


def spark_splits(spark: SparkSession, paths: list[str]) -> int:
    """The number of splits in which files are read."""
    return spark.read.text(paths).select("_metadata.file_path", "_metadata.file_block_start").distinct().count()


def _split_rows(spark: SparkSession, paths: list[str], names: list[str], encoding: str, tagged: bool) -> DataFrame:
    """The columns of files with quoted newlines, read in splits; ``tagged`` as in ``_tagged_rows``."""
    found = quoted_records.texts(quoted_records.records(spark, paths), CHARSETS[encoding])
    fields = [f"c{i} string" for i in range(len(names))] + ([f"{_CORRUPT} string"] if tagged else [])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"} | ({"columnNameOfCorruptRecord": _CORRUPT} if tagged else {})
    parsed = found.select(F.from_csv("record", ", ".join(fields), options).alias("r"), F.col("path").alias(_PATH))
    own = [F.col("r")[f"c{i}"].alias(n) for i, n in enumerate(names)]
    return parsed.select(*own, *([F.col("r")[_CORRUPT].alias(_CORRUPT)] if tagged else []), _PATH)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    encoding: str | None = None,
    long_rows: str = "truncate",
    multi_line: bool | None = None,
    repair_text: bool = False,
    path_column: str | None = None,
) -> DataFrame:
    """A headered CSV as an all-string table with null markers turned into null.

    Short rows are padded with null. Rows with too many fields are cut to the header
    (``long_rows='truncate'``) or left out (``'drop'``). Quoted newlines are kept: files that may hold
    some, by a test over all of their bytes, are read in splits by ``quoted_records`` (those of wide
    characters as a whole, each by one task). ``multi_line`` settles this without the test.
    ``repair_text`` undoes UTF-8 that was decoded as latin-1 before the file was written.
    ``path_column`` names a column with the file that a row comes from.
    """
    if long_rows not in ("truncate", "drop"):
        raise ValueError("long_rows must be 'truncate' or 'drop'")
    encoding = None if encoding is None else encoding_name(encoding)
    if encoding is None or multi_line is None:
        facts = file_facts(spark, [path] if isinstance(path, str) else path)
        found = facts.agg(F.collect_set("encoding"), F.bool_or("multi_line")).first()
        multi_line = bool(found[1]) if multi_line is None else multi_line
        if encoding is None and len(found[0]) > 1:
            raise ValueError("files of different encodings: use read_csv_files")
        encoding = encoding or (found[0] or ENCODINGS)[0]

    names = _reader(spark, encoding, multi_line).csv(path).columns
    raw = StructType([StructField(n, StringType()) for n in names])
    in_splits = multi_line and encoding not in WIDE
    if in_splits:
        df = _split_rows(spark, [path] if isinstance(path, str) else path, names, encoding, long_rows == "drop")
    elif long_rows == "drop":
        df = _tagged_rows(spark, path, names, encoding, multi_line).withColumn(_PATH, F.col("_metadata.file_path"))
    else:
        df = _reader(spark, encoding, multi_line).schema(raw).csv(path).withColumn(_PATH, F.col("_metadata.file_path"))
    if long_rows == "drop":
        # short rows are marked as well; the second test always holds and keeps a plain count legal,
        # as Spark refuses to read the raw record alone
        fits = F.col(_CORRUPT).isNull() | (_field_count(F.col(_CORRUPT)) <= len(names))
        df = df.where(fits & (F.coalesce(F.octet_length(F.col(f"`{names[0]}`")), F.lit(0)) >= 0)).drop(_CORRUPT)

    def cell(name: str):
        c = F.col(f"`{name}`")
        if encoding == "cp1252":
            c = latin1_to_cp1252(c)
        if repair_text:
            c = repair_mojibake(c)
        return null_markers_to_null(c).alias(_decode_name(name, encoding))

    source = [] if path_column is None else [F.col(_PATH).alias(path_column)]
    return df.select(*[cell(n) for n in names], *source)


def _decode_name(name: str, encoding: str) -> str:
    return name.encode("latin-1").decode("cp1252") if encoding == "cp1252" else name


def _field_count(record):
    """Fields in a raw record: commas outside quotes, plus one. A doubled quote closes and reopens."""
    unquoted = F.regexp_replace(record, '"[^"]*+"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1


def ragged_row_counts(spark: SparkSession, path: str, encoding: str = "utf-8", multi_line: bool = False) -> DataFrame:
    """How many rows have fewer or more fields than the header: (n_rows, n_short, n_long)."""
    encoding = encoding_name(encoding)
    names = _reader(spark, encoding, multi_line).csv(path).columns
    rows = _tagged_rows(spark, path, names, encoding, multi_line)
    fields, last = _field_count(F.col(_CORRUPT)), F.col(f"`{names[-1]}`")
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if((fields < len(names)) & last.isNull()).alias("n_short"),
        F.count_if(fields > len(names)).alias("n_long"),
    )


def read_csv_files(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """Several files of one layout, each in its own encoding, as one table."""
    groups: dict[tuple[str, bool], list[str]] = {}
    for row in file_facts(spark, paths).collect():
        groups.setdefault((row["encoding"], row["multi_line"]), []).append(row["path"])
    parts = [read_csv(spark, group, **{"encoding": e, "multi_line": m} | options) for (e, m), group in sorted(groups.items())]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole
