"""One query per operator on the test tables, each with the SQL that gives the same rows.

``QUERIES`` maps a name to ``(run, sql)``; ``sql`` is None where SQL cannot express the operator.
The tables hold no nulls, so holes and messy texts are derived from them by expressions that both
engines read alike.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecart.functions import dates, features, parsing
from tidecart.operators import dedup, groups, profile, reports, schema, sketches
from tidecart.operators.chained import ChainedImputer
from tidecart.operators.impute import SmartImputer, fill_median, imputation_plan
from tidecart.operators.knn import KnnImputer
from tidecart.operators.outliers import OutlierTreatment
from tidecart.operators.quantiles import exact_quantiles
from tidecart.plans import recipes
from tidecart.session import shared_folder
from tidecart.sources import csv_files, search_results, tables

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Run, str | None]] = {}


def query(name: str, sql: str | None = None):
    def register(run: Run) -> Run:
        QUERIES[name] = (run, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder for files that a query writes and reads back."""
    folder = shared_folder(spark)
    if folder is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidecart-")
    return f"{folder.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def hole(column: str, key: str, n: int, at: int = 0) -> str:
    """The column with every n-th row blanked."""
    return f"CASE WHEN {key} % {n} = {at} THEN NULL ELSE {column} END"


# ---- one question end to end --------------------------------------------------------------------

@query("latest_order_mean_by_priority", """
    SELECT o_orderpriority, round(avg(o_totalprice), 6) AS mean_price
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders)
    WHERE place = 1 GROUP BY o_orderpriority""")
def latest_order_mean_by_priority(spark, sf):
    latest = dedup.keep_latest(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate")
    means = reports.group_means(latest, "o_orderpriority", "o_totalprice", "mean_price")
    return means.withColumn("mean_price", F.round("mean_price", 6))


# ---- scans and sinks ----------------------------------------------------------------------------

@query("csv_write_and_scan", """
    SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'F') AS o_orderstatus, o_totalprice, o_orderpriority
    FROM orders""")
def csv_write_and_scan(spark, sf):
    out = scratch(spark)
    orders = table(spark, sf, "orders").withColumn(
        "o_orderstatus", F.expr("CASE WHEN o_orderstatus = 'F' THEN 'n/a' ELSE o_orderstatus END"))
    tables.write_csv(orders, out)
    back = csv_files.read_csv(spark, out)
    return back.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderstatus",
                       F.col("o_totalprice").cast("double"), "o_orderpriority")


ONE_LINE = r"regexp_replace(text, '[\n\r]', ' '{g})"
NOT_LATIN1 = r"regexp_replace({c}, '[^\x00-\xff]', '?'{g})"


@query("csv_mixed_encodings", f"""
    SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN '€ ' ELSE '' END ||
        CASE WHEN doc_id % 3 = 0 THEN {ONE_LINE.format(g=", 'g'")}
             ELSE {NOT_LATIN1.format(c=ONE_LINE.format(g=", 'g'"), g=", 'g'")} END AS text
    FROM documents""")
def csv_mixed_encodings(spark, sf):
    out = scratch(spark)
    docs = table(spark, sf, "documents")
    one_line = F.regexp_replace("text", r"[\n\r]", " ")
    latin1 = F.regexp_replace(one_line, r"[^\x00-\xff]", "?")
    for i, (encoding, text) in enumerate([
        ("UTF-8", one_line),
        ("ISO-8859-1", F.concat(F.lit("\x80 "), latin1)),  # byte 80 is the euro sign of cp1252
        ("ISO-8859-1", latin1),
    ]):
        part = docs.where(F.col("doc_id") % 3 == i).select("doc_id", text.alias("text"))
        part.write.option("header", True).option("escape", '"').option("encoding", encoding).csv(f"{out}/{i}")
    files = [p for i in range(3) for p in csv_files.csv_files(spark, f"{out}/{i}")]
    return csv_files.read_csv_files(spark, files).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query("csv_encodings_detected", f"""
    WITH t AS (SELECT doc_id % 4 AS folder, {ONE_LINE.format(g=", 'g'")} AS line FROM documents)
    SELECT folder, CASE folder WHEN 1 THEN 'cp1252' WHEN 2 THEN 'latin-1'
        WHEN 3 THEN CASE WHEN bool_or(regexp_matches(line, '[\\x{{80}}-\\x{{ff}}]')) THEN 'cp1252' ELSE 'utf-8' END
        ELSE 'utf-8' END AS encoding FROM t GROUP BY folder""")
def csv_encodings_detected(spark, sf):
    out = scratch(spark)
    docs = table(spark, sf, "documents")
    one_line = F.regexp_replace("text", r"[\n\r]", " ")
    latin1 = F.regexp_replace(one_line, r"[^\x00-\xff]", "?")
    for i, (encoding, text) in enumerate([
        ("UTF-8", one_line),
        ("ISO-8859-1", F.concat(F.lit("\x80 "), latin1)),
        ("ISO-8859-1", F.concat(F.lit("\x81 "), latin1)),  # a byte cp1252 does not define
        ("ISO-8859-1", latin1),
    ]):
        part = docs.where(F.col("doc_id") % 4 == i).select(text.alias("text"))
        part.write.option("header", True).option("escape", '"').option("encoding", encoding).csv(f"{out}/{i}")
    files = [p for i in range(4) for p in csv_files.csv_files(spark, f"{out}/{i}")]
    order = F.array(*map(F.lit, csv_files.ENCODINGS))
    return (  # the least common encoding found in a folder stands for it
        csv_files.detect_encodings(spark, files)
        .groupBy(F.regexp_extract("path", r"/(\d)/[^/]+\z", 1).cast("bigint").alias("folder"))
        .agg(F.max_by("encoding", F.array_position(order, F.col("encoding"))).alias("encoding"))
    )


@query("csv_quoted_newlines", """
    SELECT doc_id, replace(text, chr(13), ' ') AS text FROM documents WHERE trim(text) <> ''""")
def csv_quoted_newlines(spark, sf):
    out = scratch(spark)
    docs = table(spark, sf, "documents").where("trim(text) <> ''")
    docs.select("doc_id", F.replace("text", F.lit("\r"), F.lit(" ")).alias("text")).write.option("header", True).option(
        "escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(out)
    return csv_files.read_csv_files(spark, csv_files.csv_files(spark, out)).withColumn("doc_id", F.col("doc_id").cast("bigint"))


LARGE_FILE_BYTES = 256 * 1024 * 1024  # of text in a file that is read in splits


@query("csv_quoted_newlines_in_splits", """
    SELECT doc_id, text, n_chars FROM documents""")
def csv_quoted_newlines_in_splits(spark, sf):
    """Large files, of which every split cuts its own records. A task writes one, whatever the size of the table."""
    out = scratch(spark)
    docs = table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs.coalesce(n_bytes // LARGE_FILE_BYTES + 1).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(out)
    back = csv_files.read_csv(spark, csv_files.csv_files(spark, out), multi_line=True)
    return back.select(F.col("doc_id").cast("bigint"), "text", F.col("n_chars").cast("bigint"))


@query("csv_latin1_repaired", f"""
    SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN {ONE_LINE.format(g=", 'g'")} ELSE 'Müller – ' || doc_id END AS text FROM documents""")
def csv_latin1_repaired(spark, sf):
    """UTF-8 that was read as latin-1 before the file was written, repaired while it is read; plain rows stay as they are."""
    out = scratch(spark)
    text = F.when(F.col("doc_id") % 2 == 0, F.regexp_replace("text", r"[\n\r]", " ")).otherwise(F.concat(F.lit("Müller – "), F.col("doc_id").cast("string")))
    broken = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    rows = table(spark, sf, "documents").select("doc_id", broken.alias("text"))
    rows.write.option("header", True).option("escape", '"').csv(out)
    back = csv_files.read_csv_files(spark, csv_files.csv_files(spark, out), repair_text=True)
    return back.withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query("csv_source_files", """
    SELECT l_linenumber % 3 AS part, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_parts FROM lineitem GROUP BY ALL""")
def csv_source_files(spark, sf):
    """The file that a row comes from: rows of different parts lie in different files."""
    out = scratch(spark)
    rows = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") % 3).alias("part"))
    for i in range(3):
        rows.where(F.col("part") == i).write.option("header", True).csv(f"{out}/{i}")
    files = [p for i in range(3) for p in csv_files.csv_files(spark, f"{out}/{i}")]
    back = csv_files.read_csv_files(spark, files, path_column="file")
    of = F.regexp_extract("file", "/([0-9])/[^/]*$", 1)
    return back.groupBy(F.col("part").cast("int").alias("part")).agg(F.count("*").alias("n_rows"), F.countDistinct(of).alias("n_parts"))


@query("csv_utf16", f"SELECT doc_id, {ONE_LINE.format(g=", 'g'")} AS text FROM documents WHERE trim(text) <> ''")
def csv_utf16(spark, sf):
    out = scratch(spark)
    docs = table(spark, sf, "documents").where("trim(text) <> ''")
    docs.select("doc_id", F.regexp_replace("text", r"[\n\r]", " ").alias("text")).write.option("header", True).option(
        "escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("encoding", "UTF-16").csv(out)
    return csv_files.read_csv_files(spark, csv_files.csv_files(spark, out)).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _ragged(spark, sf):
    """Order lines as raw text rows: every 7th too long, every 5th too short."""
    out = scratch(spark)
    line = F.expr("""concat(l_orderkey, ',', l_partkey, ',', l_linenumber,
        CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE concat(',', l_returnflag) END,
        CASE WHEN l_orderkey % 7 = 0 AND l_orderkey % 5 <> 0 THEN ',extra' ELSE '' END)""")
    rows = table(spark, sf, "lineitem").select(line.alias("l_orderkey,l_partkey,l_linenumber,l_returnflag"))
    rows.write.option("header", True).option("sep", "\x01").option("quote", "").csv(out)
    return out


@query("csv_ragged_rows", """
    SELECT l_orderkey, l_partkey, l_linenumber,
        CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem""")
def csv_ragged_rows(spark, sf):
    back = csv_files.read_csv(spark, _ragged(spark, sf), encoding="utf-8")
    return back.select(F.col("l_orderkey").cast("bigint"), F.col("l_partkey").cast("bigint"),
                       F.col("l_linenumber").cast("int"), "l_returnflag")


@query("csv_long_rows_dropped", """
    SELECT l_orderkey, l_partkey, l_linenumber,
        CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem
    WHERE l_orderkey % 5 = 0 OR l_orderkey % 7 <> 0""")
def csv_long_rows_dropped(spark, sf):
    back = csv_files.read_csv(spark, _ragged(spark, sf), encoding="utf-8", long_rows="drop")
    return back.select(F.col("l_orderkey").cast("bigint"), F.col("l_partkey").cast("bigint"),
                       F.col("l_linenumber").cast("int"), "l_returnflag")


@query("csv_ragged_row_counts", """
    SELECT count(*) AS n_rows, count(*) FILTER (l_orderkey % 5 = 0) AS n_short,
        count(*) FILTER (l_orderkey % 7 = 0 AND l_orderkey % 5 <> 0) AS n_long FROM lineitem""")
def csv_ragged_row_counts(spark, sf):
    return csv_files.ragged_row_counts(spark, _ragged(spark, sf))


@query("json_write_and_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def json_write_and_scan(spark, sf):
    out = scratch(spark)
    customers = table(spark, sf, "customer")
    tables.write_json(customers, out)
    return search_results.read_records(spark, out, customers.schema, lines=True)


@query("search_responses_exploded", """
    WITH items AS (
        SELECT 'user ' || user_id AS query, CAST(epoch_us(ts) AS STRING) AS fetch_time, event_id, value, event_type
        FROM events)
    SELECT event_id AS item_id, value AS price, query, fetch_time, CAST(NULL AS BIGINT) AS seller
        FROM items WHERE event_type NOT IN ('error', 'purchase')
    UNION ALL SELECT -event_id - 1, value * 2, query, fetch_time, NULL
        FROM items WHERE event_type NOT IN ('error', 'purchase')
    UNION ALL SELECT event_id, value, query, fetch_time, event_id FROM items WHERE event_type = 'purchase'""")
def search_responses_exploded(spark, sf):
    events = table(spark, sf, "events")
    response = [
        F.concat(F.lit("user "), "user_id").alias("query"),
        F.unix_micros(F.col("ts").cast("timestamp")).cast("string").alias("fetch_time"),
        F.when(F.col("event_type") == "error", F.lit("no results")).alias("error"),
    ]
    found = F.expr("""array(named_struct('item_id', event_id, 'price', value),
                            named_struct('item_id', -event_id - 1, 'price', value * 2))""")
    sold = F.expr("array(named_struct('item_id', event_id, 'price', value, 'seller', event_id))")
    pages = events.where("event_type <> 'purchase'").select(*response, found.alias("organic_results"))
    orders = events.where("event_type = 'purchase'").select(*response, sold.alias("organic_results"))
    return search_results.concatenate([search_results.explode_responses(p) for p in (pages, orders)])


@query("table_load_keeps_existing", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def table_load_keeps_existing(spark, sf):
    name = tables.table_name_for(f"/landing/{uuid.uuid4().hex} nation.csv")
    nation = table(spark, sf, "nation")
    tables.load_table(nation, name, path=scratch(spark))
    tables.load_table(nation.where("n_nationkey < 3"), name)
    return tables.scan_table(spark, name)


@query("table_load_overwrites", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal < 0")
def table_load_overwrites(spark, sf):
    name, path = f"customers_{uuid.uuid4().hex}", scratch(spark)
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    tables.load_table(customers, name, path=path)
    tables.load_table(customers.where("c_acctbal < 0").drop("c_acctbal"), name, overwrite=True, path=path)
    return tables.scan_table(spark, name)


@query("table_previews", "SELECT r_regionkey, r_name FROM region")
def table_previews(spark, sf):
    name = f"regions_{uuid.uuid4().hex}"
    tables.load_table(table(spark, sf, "region"), name, path=scratch(spark))
    return tables.preview_tables(spark)[name]


# ---- parsing ------------------------------------------------------------------------------------

MESSY = """CASE l_orderkey % 12
    WHEN 0 THEN concat('$', CAST(l_quantity AS STRING)) WHEN 1 THEN ' N/A ' WHEN 2 THEN '1-2'
    WHEN 3 THEN concat('(', CAST(l_partkey AS STRING), ')') WHEN 4 THEN 'none'
    WHEN 5 THEN concat('1,', CAST(l_partkey + 100 AS STRING), '.5') WHEN 6 THEN concat('USD ', CAST(l_tax AS STRING))
    WHEN 7 THEN '' WHEN 8 THEN concat('-', CAST(l_extendedprice AS STRING)) WHEN 9 THEN '1.2.3'
    WHEN 10 THEN '-' ELSE concat(CAST(l_linenumber AS STRING), 'e2') END"""


@query("parse_number", f"""
    SELECT l_orderkey, l_linenumber, s, TRY_CAST(CASE WHEN lower(trim(s)) IN ('na', 'n/a', 'null', 'none', '') THEN NULL
        ELSE regexp_replace(s, '[^0-9\\-.]', '', 'g') END AS DOUBLE) AS number
    FROM (SELECT l_orderkey, l_linenumber, {MESSY} AS s FROM lineitem)""")
def parse_number(spark, sf):
    messy = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(MESSY).alias("s"))
    return messy.withColumn("number", parsing.parse_number(F.col("s")))


@query("parse_money", f"""
    SELECT l_orderkey, l_linenumber, CASE WHEN s IN ('NA', 'na', 'N/A', '', 'NULL', 'null') THEN NULL
        ELSE TRY_CAST(regexp_replace(s, '[,$€£]', '', 'g') AS DOUBLE) END AS money
    FROM (SELECT l_orderkey, l_linenumber, {MESSY} AS s FROM lineitem)""")
def parse_money(spark, sf):
    messy = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(MESSY).alias("s"))
    return messy.select("l_orderkey", "l_linenumber", parsing.parse_money(F.col("s")).alias("money"))


RE2_SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def clean_text_sql(c: str) -> str:
    spaced = rf"regexp_replace({c}, '{RE2_SPACE}+', ' ', 'g')"
    bare = rf"regexp_replace(regexp_replace({spaced}, '^[^\p{{L}}\p{{N}}_]+', ''), '[^\p{{L}}\p{{N}}_]+$', '')"
    return (f"CASE WHEN {c} IS NULL OR {c} IN ('NA', 'na', 'N/A', '', 'NULL', 'null') OR {bare} = '' "
            f"THEN 'Unknown' ELSE {bare} END")


MESSY_TEXT = """CASE conv_id % 5 WHEN 0 THEN 'NA' WHEN 1 THEN concat(' -- ', text, ' !?') WHEN 2 THEN '...'
    WHEN 3 THEN NULL ELSE text END"""


@query("clean_text_documents", f"SELECT doc_id, {clean_text_sql('text')} AS cleaned FROM documents")
def clean_text_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", parsing.clean_text(F.col("text")).alias("cleaned"))


@query("clean_text_conversations", f"""
    SELECT conv_id, turn, {clean_text_sql('s')} AS cleaned
    FROM (SELECT conv_id, turn, {MESSY_TEXT} AS s FROM conversations)""")
def clean_text_conversations(spark, sf):
    messy = table(spark, sf, "conversations").select("conv_id", "turn", F.expr(MESSY_TEXT).alias("s"))
    return messy.select("conv_id", "turn", parsing.clean_text(F.col("s")).alias("cleaned"))


FLAG_TEXT = """CASE event_id % 9 WHEN 0 THEN 'true' WHEN 1 THEN 'T' WHEN 2 THEN '1' WHEN 3 THEN 'tRuE'
    WHEN 4 THEN 'False' WHEN 5 THEN NULL WHEN 6 THEN '' WHEN 7 THEN 'TRUE' ELSE event_type END"""


@query("parse_flag", f"""
    SELECT event_id, coalesce(({FLAG_TEXT}) IN ('true', 'True', 'TRUE', 't', 'T', '1'), false) AS flag FROM events""")
def parse_flag(spark, sf):
    return table(spark, sf, "events").select("event_id", parsing.parse_flag(F.expr(FLAG_TEXT)).alias("flag"))


@query("normalize_null_markers", f"""
    SELECT l_orderkey, l_linenumber, CASE WHEN s IN ('', 'N/A', 'none', 'None', 'NA', 'null', 'NULL') AND s <> 'none'
        THEN NULL ELSE s END AS s
    FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 4 = 0 THEN 'N/A' ELSE {MESSY} END AS s FROM lineitem)""")
def normalize_null_markers(spark, sf):
    messy = f"CASE WHEN l_partkey % 4 = 0 THEN 'N/A' ELSE {MESSY} END"
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", parsing.null_markers_to_null(F.expr(messy)).alias("s"))


def _stamped(spark, sf):
    written = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").select("event_id", F.expr("""CASE event_id % 5
        WHEN 0 THEN concat(w, ' +0000') WHEN 1 THEN concat(w, ' +0530') WHEN 2 THEN concat(w, ' -05:00')
        WHEN 3 THEN w ELSE 'yesterday' END""".replace("w,", "date_format(ts, 'yyyy-MM-dd HH:mm:ss'),")
        .replace("THEN w", "THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')")).alias("s"), written.alias("w"))


@query("parse_zoned_timestamp", """
    SELECT event_id,
        CASE event_id % 5 WHEN 0 THEN s WHEN 1 THEN s - 19800 WHEN 2 THEN s + 18000 END AS seconds,
        CASE WHEN event_id % 5 < 3 THEN year(ts)::INT END AS crawl_year,
        CASE WHEN event_id % 5 < 3 THEN month(ts)::INT END AS crawl_month,
        CASE WHEN event_id % 5 < 3 THEN day(ts)::INT END AS crawl_day,
        CASE WHEN event_id % 5 < 3 THEN (isodow(ts) - 1)::INT END AS crawl_dayofweek
    FROM (SELECT *, epoch_us(date_trunc('second', ts)) // 1000000 AS s FROM events)""")
def parse_zoned_timestamp(spark, sf):
    c = F.col("s")
    parts = dates.crawl_parts(dates.zoned_wall_clock(c))
    return _stamped(spark, sf).select(
        "event_id", F.unix_seconds(dates.parse_zoned_timestamp(c)).alias("seconds"),
        *[v.alias(k) for k, v in parts.items()])


@query("parse_any_timestamp", """
    SELECT event_id,
        CASE event_id % 5 WHEN 0 THEN s WHEN 1 THEN s - 19800 WHEN 2 THEN s + 18000 WHEN 3 THEN s END AS seconds,
        CASE WHEN event_id % 5 < 4 THEN (isodow(ts) - 1)::INT END AS crawl_dayofweek
    FROM (SELECT *, epoch_us(date_trunc('second', ts)) // 1000000 AS s FROM events)""")
def parse_any_timestamp(spark, sf):
    c = F.col("s")
    return _stamped(spark, sf).select(
        "event_id", F.unix_seconds(dates.parse_any_timestamp(c)).alias("seconds"),
        F.weekday(dates.any_wall_clock(c)).alias("crawl_dayofweek"))


@query("parse_short_date", """
    SELECT o_orderkey, d::DATE AS day, year(d)::INT AS "Year", month(d)::INT AS "Month", dayname(d) AS "DayOfWeek"
    FROM (SELECT o_orderkey, try_strptime(CASE WHEN o_orderkey % 10 = 0 THEN '13-40-99'
        WHEN o_orderkey % 10 = 1 THEN '1-5-' || (60 + o_custkey % 20) ELSE strftime(o_orderdate, '%m-%d-%y') END,
        '%m-%d-%y') AS d FROM orders)""")
def parse_short_date(spark, sf):
    text = F.expr("""CASE WHEN o_orderkey % 10 = 0 THEN '13-40-99'
        WHEN o_orderkey % 10 = 1 THEN concat('1-5-', 60 + o_custkey % 20)
        ELSE date_format(o_orderdate, 'MM-dd-yy') END""")
    day = table(spark, sf, "orders").select("o_orderkey", dates.parse_short_date(text).alias("day"))
    return day.withColumns(dates.purchase_parts(F.col("day")))


DISCOUNT_TEXT = "concat('$', CAST(l_discount AS STRING))"


@query("parse_discount", f"""
    SELECT l_orderkey, l_linenumber, CAST(replace(s, '$', '') AS DOUBLE) AS discount,
        TRY_CAST(replace(junk, '$', '') AS DOUBLE) AS lenient
    FROM (SELECT *, {hole(DISCOUNT_TEXT, 'l_orderkey', 6)} AS s,
        CASE WHEN l_orderkey % 6 = 1 THEN '$1,200' ELSE {DISCOUNT_TEXT} END AS junk FROM lineitem)""")
def parse_discount(spark, sf):
    clean = F.expr(hole(DISCOUNT_TEXT, "l_orderkey", 6))
    junk = F.expr(f"CASE WHEN l_orderkey % 6 = 1 THEN '$1,200' ELSE {DISCOUNT_TEXT} END")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", parsing.parse_discount(clean).alias("discount"),
        parsing.parse_discount(junk, on_error="null").alias("lenient"))


@query("repair_mojibake", "SELECT doc_id, text FROM documents")
def repair_mojibake(spark, sf):
    broken = F.decode(F.encode(F.col("text"), "UTF-8"), "ISO-8859-1")
    return table(spark, sf, "documents").select("doc_id", parsing.repair_mojibake(broken).alias("text"))


# ---- derived columns ----------------------------------------------------------------------------

@query("offer_price_from_struct", """
    SELECT event_id, coalesce(nullif(CASE WHEN k % 4 = 0 THEN 0.0 WHEN k % 4 = 1 THEN NULL ELSE value END, 0.0),
        CASE WHEN k % 3 = 0 THEN NULL ELSE k::DOUBLE END) AS price
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)""")
def offer_price_from_struct(spark, sf):
    events = table(spark, sf, "events").withColumn("k", F.from_json("props", "k int")["k"])
    offer = F.expr("""named_struct('offer_price', CASE WHEN k % 4 = 0 THEN 0D WHEN k % 4 = 1 THEN NULL ELSE value END,
        'min_price', CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END)""")
    return events.withColumn("offer", offer).select("event_id", features.offer_price(F.col("offer")).alias("price"))


@query("offer_price_from_text", """
    SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN p_retailprice WHEN 1 THEN p_size::DOUBLE
        WHEN 2 THEN p_size::DOUBLE WHEN 3 THEN p_retailprice END AS price FROM part""")
def offer_price_from_text(spark, sf):
    text = F.expr("""CASE p_partkey % 6
        WHEN 0 THEN concat("{'offer_id': '", p_name, "', 'offer_price': ", p_retailprice, ", 'min_price': ", p_size, '}')
        WHEN 1 THEN concat("{'offer_price': 0, 'min_price': ", p_size, ", 'sale': True}")
        WHEN 2 THEN concat("{'offer_price': None, 'min_price': ", p_size, '}')
        WHEN 3 THEN concat("{'min_price': ", p_retailprice, '}') WHEN 4 THEN p_name ELSE '[1, 2]' END""")
    return table(spark, sf, "part").select("p_partkey", features.offer_price_from_text(text).alias("price"))


@query("price_range", """
    SELECT event_id, CASE WHEN p <= 0 THEN NULL WHEN p <= 50 THEN 'Budget' WHEN p <= 100 THEN 'Mid'
        WHEN p <= 200 THEN 'Premium' WHEN p <= 500 THEN 'High-end' ELSE 'Luxury' END AS price_range
    FROM (SELECT event_id, value * 2 - 20 AS p FROM events)""")
def price_range(spark, sf):
    price = F.col("value") * 2 - 20
    return table(spark, sf, "events").select("event_id", features.price_range(price).alias("price_range"))


@query("rating_quality", """
    SELECT l_orderkey, l_linenumber, CASE WHEN r IS NULL OR r <= 0 THEN NULL WHEN r <= 2 THEN 'Poor' WHEN r <= 3 THEN 'Fair'
        WHEN r <= 4 THEN 'Good' WHEN r <= 5 THEN 'Excellent' END AS rating_quality
    FROM (SELECT l_orderkey, l_linenumber, l_quantity / 9 AS r FROM lineitem)""")
def rating_quality(spark, sf):
    rating = F.col("l_quantity") / 9
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", features.rating_quality(rating).alias("rating_quality"))


STAR_SQL = [hole(f"CAST((l_partkey + {i}) % {m} AS DOUBLE)", "l_orderkey", 13, i) for i, m in enumerate((9, 7, 5, 4, 3))]


@query("derived_features", f"""
    SELECT l_orderkey, l_linenumber, s0 + s1 + s2 + s3 + s4 AS total_star_ratings,
        CASE WHEN s0 > 0 THEN 1 ELSE 0 END AS has_reviews,
        s0 / (s1 + 1.0::DOUBLE) AS review_density, l_extendedprice / (s2 + 0.1::DOUBLE) AS price_per_rating
    FROM (SELECT *, {', '.join(f'{e} AS s{i}' for i, e in enumerate(STAR_SQL))} FROM lineitem)""")
def derived_features(spark, sf):
    stars = [F.col(f"s{i}") for i in range(5)]
    lines = table(spark, sf, "lineitem").withColumns({f"s{i}": F.expr(e) for i, e in enumerate(STAR_SQL)})
    return lines.select(
        "l_orderkey", "l_linenumber",
        features.total_of(stars).alias("total_star_ratings"),
        features.positive_flag(stars[0]).alias("has_reviews"),
        features.review_density(stars[0], stars[1]).alias("review_density"),
        features.price_per_rating(F.col("l_extendedprice"), stars[2]).alias("price_per_rating"))


@query("clip_values", """
    SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_acctbal < 0 THEN 0.0
        WHEN c_acctbal > 5000 THEN 5000.0 ELSE c_acctbal END AS clipped FROM customer""")
def clip_values(spark, sf):
    balance = F.expr(hole("c_acctbal", "c_custkey", 10))
    return table(spark, sf, "customer").select(
        "c_custkey", features.clip(balance, F.lit(0.0), F.lit(5000.0)).alias("clipped"))


# ---- deduplication ------------------------------------------------------------------------------

@query("distinct_rows", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_rows(spark, sf):
    return dedup.drop_exact_copies(table(spark, sf, "customer").select("c_nationkey", "c_mktsegment"))


@query("distinct_wide_rows", f"""
    SELECT DISTINCT * REPLACE ({hole('l_tax', 'l_orderkey', 4)} AS l_tax) FROM (
        FROM lineitem UNION ALL FROM lineitem UNION ALL FROM lineitem WHERE l_returnflag = 'A')""")
def distinct_wide_rows(spark, sf):
    lines = table(spark, sf, "lineitem")
    copies = lines.union(lines).union(lines.where("l_returnflag = 'A'"))
    return dedup.drop_exact_copies(copies.withColumn("l_tax", F.expr(hole("l_tax", "l_orderkey", 4))))


@query("latest_event_per_user", """
    SELECT event_id, ts, user_id, event_type, value FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events) WHERE place = 1""")
def latest_event_per_user(spark, sf):
    return dedup.keep_latest(table(spark, sf, "events").drop("props"), ["user_id"], "ts")


@query("latest_with_null_keys_and_times", f"""
    SELECT k, t, o_orderkey FROM (SELECT *, row_number() OVER (
        PARTITION BY k ORDER BY t DESC NULLS FIRST, o_orderkey DESC) AS place
        FROM (SELECT o_orderkey, {hole('o_custkey', 'o_orderkey', 3)} AS k,
            {hole('o_orderdate', 'o_orderkey', 50, 1)} AS t FROM orders)) WHERE place = 1""")
def latest_with_null_keys_and_times(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.expr(hole("o_custkey", "o_orderkey", 3)).alias("k"),
        F.expr(hole("o_orderdate", "o_orderkey", 50, 1)).alias("t"))
    return dedup.keep_latest(orders, ["k"], "t")


# ---- schema -------------------------------------------------------------------------------------

@query("keep_listed_columns", "SELECT p_partkey, p_name, p_retailprice FROM part")
def keep_listed_columns(spark, sf):
    return schema.keep_columns(table(spark, sf, "part"), ["p_retailprice", "absent", "p_name", "p_partkey"])


@query("normalize_column_names", """
    SELECT s_suppkey AS supplier_key, s_name AS name_of_supplier, s_acctbal AS acctbal_usd FROM supplier""")
def normalize_column_names(spark, sf):
    messy = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias(" Supplier Key"), F.col("s_name").alias("Name Of Supplier "),
        F.col("s_acctbal").alias("Acctbal (USD)"))
    return schema.normalize_names(messy)


@query("drop_low_value_columns", """
    SELECT l_orderkey, l_linenumber, l_quantity,
        CASE WHEN l_orderkey % 10 = 0 THEN l_tax END AS often_null FROM lineitem""")
def drop_low_value_columns(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.expr("CASE WHEN l_orderkey % 10 = 0 THEN l_tax END").alias("often_null"),
        F.expr("CASE WHEN l_orderkey % 40 = 0 THEN l_tax END").alias("mostly_null"),
        F.lit("same").alias("constant"),
        F.expr("CASE WHEN l_orderkey % 2 = 0 THEN 1 END").alias("one_value"),
        F.expr("concat(l_orderkey, '/', l_linenumber, '/', l_partkey, '/', l_suppkey, '/', l_shipdate)").alias("Uniq Id"))
    return schema.LowValueColumns().fit(lines).transform(lines)


# ---- groups -------------------------------------------------------------------------------------

GROUPED = """SELECT p_partkey, g, a, b FROM (SELECT p_partkey, brand,
        CASE WHEN brand % 5 = 4 THEN NULL ELSE p_brand END AS g,
        CASE WHEN brand % 5 = 0 AND p_partkey % 40 = 0 THEN NULL WHEN brand % 5 = 1 AND p_partkey % 3 = 0 THEN NULL
             WHEN brand % 5 = 2 THEN NULL WHEN brand % 5 = 4 AND p_partkey % 4 = 0 THEN NULL ELSE p_retailprice END AS a,
        CASE WHEN brand % 5 = 1 AND p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS b
    FROM (SELECT *, CAST(replace(p_brand, 'Brand#', '') AS INT) AS brand FROM {part}))"""
RATES = """rates AS (SELECT g, count(*) AS n_rows, count(*) FILTER (a IS NULL OR b IS NULL) AS n_incomplete
    FROM t WHERE g IS NOT NULL GROUP BY g)"""
DROPPED = f"""t AS ({GROUPED.format(part='part')}), {RATES}, kept AS (
    SELECT t.* FROM t LEFT JOIN rates r ON t.g = r.g
    WHERE NOT ((a IS NULL OR b IS NULL) AND coalesce(n_incomplete::DOUBLE / n_rows <= 0.05 OR n_incomplete = n_rows, false)))"""


def _grouped(spark, sf):
    return spark.sql(GROUPED.format(part="{part}"), part=table(spark, sf, "part"))


@query("group_null_rates", f"""
    WITH t AS ({GROUPED.format(part='part')}), {RATES}
    SELECT g, n_rows, n_incomplete, n_incomplete::DOUBLE / n_rows AS null_rate FROM rates""")
def group_null_rates(spark, sf):
    return groups.group_null_rates(_grouped(spark, sf), "g", ["a", "b"])


@query("drop_sparse_incomplete_rows", f"WITH {DROPPED} SELECT p_partkey, g, a, b FROM kept")
def drop_sparse_incomplete_rows(spark, sf):
    return groups.drop_incomplete_rows(_grouped(spark, sf), "g", ["a", "b"])


@query("fill_with_group_mean", f"""
    SELECT l_orderkey, l_linenumber, l_returnflag, round(coalesce(x, CASE WHEN l_returnflag IS NOT NULL
        THEN avg(x) OVER (PARTITION BY l_returnflag) END), 4) AS x
    FROM (SELECT l_orderkey, l_linenumber, {hole('l_returnflag', 'l_partkey', 17)} AS l_returnflag,
        {hole('l_extendedprice', 'l_orderkey', 11)} AS x FROM lineitem)""")
def fill_with_group_mean(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(hole("l_returnflag", "l_partkey", 17)).alias("l_returnflag"),
        F.expr(hole("l_extendedprice", "l_orderkey", 11)).alias("x"))
    return groups.fill_with_group_mean(lines, "l_returnflag", ["x"]).withColumn("x", F.round("x", 4))


@query("group_mean_per_row", """
    SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_orderpriority), 4) AS mean_price FROM orders""")
def group_mean_per_row(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    with_mean = groups.with_group_mean(orders, "o_orderpriority", "o_totalprice", "mean_price")
    return with_mean.select("o_orderkey", F.round("mean_price", 4).alias("mean_price"))


LINE_GROUPS = f"""SELECT l_orderkey, l_linenumber, {hole('l_returnflag', 'l_partkey', 17)} AS g,
    CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN {{nan}} ELSE l_extendedprice END AS x FROM {{lines}}"""


@query("group_repair_with_nan", f"""
    SELECT l_orderkey, l_linenumber, g, round(coalesce(x, CASE WHEN g IS NOT NULL THEN avg(x) OVER (PARTITION BY g) END), 4) AS x
    FROM ({LINE_GROUPS.format(nan='NULL', lines='lineitem')})""")
def group_repair_with_nan(spark, sf):
    """Each group misses over a twentieth, so all rows stay; the values are attached by a shuffle."""
    lines = spark.sql(LINE_GROUPS.format(nan="double('NaN')", lines="{l}"), l=table(spark, sf, "lineitem"))
    return groups.repair_groups(lines, "g", ["x"], max_bytes=0).withColumn("x", F.round("x", 4))


@query("repair_groups_by_shuffle", f"""
    WITH {DROPPED} SELECT p_partkey, g,
        round(coalesce(a, CASE WHEN g IS NOT NULL THEN avg(a) OVER (PARTITION BY g) END), 6) AS a,
        round(coalesce(b, CASE WHEN g IS NOT NULL THEN avg(b) OVER (PARTITION BY g) END), 6) AS b FROM kept""")
def repair_groups_by_shuffle(spark, sf):
    return groups.repair_groups(_grouped(spark, sf), "g", ["a", "b"], max_bytes=0).withColumns(
        {"a": F.round("a", 6), "b": F.round("b", 6)})


@query("repair_groups", f"""
    WITH {DROPPED} SELECT p_partkey, g,
        round(coalesce(a, CASE WHEN g IS NOT NULL THEN avg(a) OVER (PARTITION BY g) END), 6) AS a,
        round(coalesce(b, CASE WHEN g IS NOT NULL THEN avg(b) OVER (PARTITION BY g) END), 6) AS b FROM kept""")
def repair_groups(spark, sf):
    return groups.repair_groups(_grouped(spark, sf), "g", ["a", "b"]).withColumns(
        {"a": F.round("a", 6), "b": F.round("b", 6)})


@query("rows_with_any_null", f"""
    SELECT o_orderkey FROM orders WHERE {hole('o_totalprice', 'o_orderkey', 4)} IS NULL
        OR {hole('o_orderpriority', 'o_custkey', 9)} IS NULL""")
def rows_with_any_null(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.expr(hole("o_totalprice", "o_orderkey", 4)).alias("a"),
        F.expr(hole("o_orderpriority", "o_custkey", 9)).alias("b"))
    return orders.where(groups.any_null(["a", "b"])).select("o_orderkey")


# ---- missing values -----------------------------------------------------------------------------

MISSING = {
    "whole": "l_tax", "k": hole("l_quantity", "l_orderkey", 50), "m": hole("l_discount", "l_orderkey", 9),
    "md": hole("l_extendedprice", "l_orderkey", 3), "gone": "CASE WHEN l_orderkey % 30 = 0 THEN l_tax END",
    "nothing": "CAST(NULL AS DOUBLE)",
}


@query("imputation_plan", "WITH t AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in MISSING.items()) + """ FROM lineitem),
    shares AS (""" + " UNION ALL ".join(
        f"SELECT '{n}' AS \"column\", (count(*) - count({n}))::DOUBLE / count(*) * 100 AS missing_pct FROM t" for n in MISSING) + """)
    SELECT "column", round(missing_pct, 8) AS missing_pct, CASE WHEN missing_pct <= 0 OR missing_pct >= 95 THEN 'none'
        WHEN missing_pct < 5 THEN 'knn' WHEN missing_pct < 30 THEN 'chained' ELSE 'median' END AS strategy FROM shares""")
def imputation_plan_query(spark, sf):
    lines = table(spark, sf, "lineitem").select(*[F.expr(e).alias(n) for n, e in MISSING.items()])
    return imputation_plan(lines, list(MISSING)).withColumn("missing_pct", F.round("missing_pct", 8))


def rounded(value: str, digits: int | None) -> str:
    return value if digits is None else f"round({value}, {digits})"


def knn_sql(source: str, key: str, columns: list[str], targets: list[str], digits: int | None = 4) -> str:
    """Brute force: every row with a hole against every donor, the nearest five by (distance, value)."""
    present = " + ".join(f"CASE WHEN r.{c} IS NOT NULL AND d.{c} IS NOT NULL THEN 1 ELSE 0 END" for c in columns)
    total = " + ".join(f"coalesce((r.{c} - d.{c}) * (r.{c} - d.{c}), 0)" for c in columns)
    parts, fills = [], []
    for t in targets:
        parts.append(f"""near_{t} AS (
            SELECT id, CASE WHEN count(*) FILTER (distance = 0) > 0 THEN avg(v) FILTER (distance = 0)
                ELSE sum(v / distance) / sum(1 / distance) END AS fill
            FROM (SELECT id, v, distance, row_number() OVER (PARTITION BY id ORDER BY distance, v) AS place
                FROM (SELECT r.{key} AS id, d.{t} AS v,
                    sqrt(({total}) * ({len(columns)}::DOUBLE / ({present}))) AS distance
                    FROM src r JOIN src d ON r.{t} IS NULL AND d.{t} IS NOT NULL AND ({present}) > 0))
            WHERE place <= 5 GROUP BY id)""")
        fill = f"coalesce(s.{t}, near_{t}.fill, (SELECT avg({t}) FROM src))"
        fills.append(f"{rounded(fill, digits)} AS {t}")
    others = [c for c in columns if c not in targets]
    joins = " ".join(f"LEFT JOIN near_{t} ON near_{t}.id = s.{key}" for t in targets)
    keep = "".join(f", s.{c}" for c in others)
    return f"WITH src AS ({source}), {', '.join(parts)} SELECT s.{key}{keep}, {', '.join(fills)} FROM src s {joins}"


def _rounded(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


CUSTOMER_HOLES = f"""SELECT c_custkey, {hole('c_acctbal', 'c_custkey', 25)} AS balance,
    {hole('CAST(c_nationkey AS DOUBLE)', 'c_custkey', 30, 1)} AS nation,
    {hole('CAST(c_custkey % 100 AS DOUBLE)', 'c_custkey', 40, 0)} AS score FROM customer"""


@query("knn_customers", knn_sql(CUSTOMER_HOLES, "c_custkey", ["balance", "nation", "score"], ["balance", "nation", "score"]))
def knn_customers(spark, sf):
    columns = ["balance", "nation", "score"]
    source = spark.sql(CUSTOMER_HOLES.replace("FROM customer", "FROM {c}"), c=table(spark, sf, "customer"))
    return _rounded(KnnImputer(columns).fit(source).transform(source), columns)


ORDER_HOLES = f"""SELECT o_orderkey, {hole('o_totalprice', 'o_orderkey', 30)} AS price,
    {hole('CAST(o_custkey AS DOUBLE)', 'o_orderkey', 40, 1)} AS customer FROM orders"""


@query("knn_orders", knn_sql(ORDER_HOLES, "o_orderkey", ["price", "customer"], ["price", "customer"]))
def knn_orders(spark, sf):
    columns = ["price", "customer"]
    source = spark.sql(ORDER_HOLES.replace("FROM orders", "FROM {o}"), o=table(spark, sf, "orders"))
    return _rounded(KnnImputer(columns).fit(source).transform(source), columns)


@query("knn_one_target", knn_sql(CUSTOMER_HOLES, "c_custkey", ["balance", "nation", "score"], ["balance"]))
def knn_one_target(spark, sf):
    source = spark.sql(CUSTOMER_HOLES.replace("FROM customer", "FROM {c}"), c=table(spark, sf, "customer"))
    columns = ["balance", "nation", "score"]
    return _rounded(KnnImputer(columns, targets=["balance"]).fit(source).transform(source), ["balance"])


PER_COLUMN_HOLES = f"""SELECT o_orderkey, {hole('o_totalprice', 'o_orderkey', 30)} AS price,
    {hole('CAST(o_custkey AS DOUBLE)', 'o_orderkey', 40, 1)} AS customer,
    {hole('CAST(month(o_orderdate) AS DOUBLE)', 'o_orderkey', 3, 1)} AS month FROM orders"""


@query("knn_per_column", knn_sql(
    PER_COLUMN_HOLES, "o_orderkey", ["price", "customer", "month"], ["price", "customer"]).replace(
        "SELECT s.o_orderkey, s.month", "SELECT s.o_orderkey, coalesce(s.month, (SELECT median(month) FROM src)) AS month"))
def knn_per_column(spark, sf):
    columns = ["price", "customer", "month"]
    source = spark.sql(PER_COLUMN_HOLES.replace("FROM orders", "FROM {o}"), o=table(spark, sf, "orders"))
    filled = SmartImputer(columns, per_column=True).fit(source).transform(source)
    return _rounded(filled, ["price", "customer"])


CHAINED_COLUMNS = ["price", "quantity", "tax", "part"]


def _chained_source(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(hole("l_extendedprice", "l_orderkey", 11)).alias("price"),
        F.expr(hole("l_quantity", "l_orderkey", 7, 1)).alias("quantity"),
        F.expr(hole("l_tax", "l_partkey", 9)).alias("tax"),
        F.expr(hole("CAST(l_partkey AS DOUBLE)", "l_suppkey", 8)).alias("part"))


@query("chained_equations")
def chained_equations(spark, sf):
    source = _chained_source(spark, sf)
    return _rounded(ChainedImputer(CHAINED_COLUMNS).fit(source).transform(source), CHAINED_COLUMNS)


@query("chained_single_column_is_mean", f"""
    SELECT o_orderkey, round(coalesce(x, avg(x) OVER ()), 4) AS x
    FROM (SELECT o_orderkey, {hole('o_totalprice', 'o_orderkey', 8)} AS x FROM orders)""")
def chained_single_column_is_mean(spark, sf):
    source = table(spark, sf, "orders").select("o_orderkey", F.expr(hole("o_totalprice", "o_orderkey", 8)).alias("x"))
    return _rounded(ChainedImputer(["x"]).fit(source).transform(source), ["x"])


@query("smart_imputer_per_column")
def smart_imputer_per_column(spark, sf):
    orders = table(spark, sf, "orders")
    source = orders.select(
        "o_orderkey", F.expr(hole("o_totalprice", "o_orderkey", 31)).alias("price"),
        F.expr(hole("CAST(o_custkey AS DOUBLE)", "o_orderkey", 9)).alias("customer"),
        F.expr(hole("CAST(month(o_orderdate) AS DOUBLE)", "o_orderkey", 3, 1)).alias("month"))
    columns = ["price", "customer", "month"]
    return _rounded(SmartImputer(columns, per_column=True).fit(source).transform(source), columns)


@query("smart_imputer_grouped", knn_sql(
    f"""SELECT o_orderkey, {hole('o_totalprice', 'o_orderkey', 30)} AS price,
        {hole('CAST(o_custkey AS DOUBLE)', 'o_orderkey', 40, 1)} AS customer,
        coalesce({hole('CAST(month(o_orderdate) AS DOUBLE)', 'o_orderkey', 3, 1)}, m) AS month,
        coalesce({hole('CAST(day(o_orderdate) AS DOUBLE)', 'o_orderkey', 10, 3)}, d) AS day
    FROM orders, (SELECT median({hole('CAST(month(o_orderdate) AS DOUBLE)', 'o_orderkey', 3, 1)}) AS m,
        avg({hole('CAST(day(o_orderdate) AS DOUBLE)', 'o_orderkey', 10, 3)}) AS d FROM orders)""",
    "o_orderkey", ["price", "customer"], ["price", "customer"]).replace(
        "SELECT s.o_orderkey,", "SELECT s.o_orderkey, s.month, round(s.day, 4) AS day,"))
def smart_imputer_grouped(spark, sf):
    source = table(spark, sf, "orders").select(
        "o_orderkey", F.expr(hole("o_totalprice", "o_orderkey", 30)).alias("price"),
        F.expr(hole("CAST(o_custkey AS DOUBLE)", "o_orderkey", 40, 1)).alias("customer"),
        F.expr(hole("CAST(month(o_orderdate) AS DOUBLE)", "o_orderkey", 3, 1)).alias("month"),
        F.expr(hole("CAST(day(o_orderdate) AS DOUBLE)", "o_orderkey", 10, 3)).alias("day"))
    columns = ["price", "customer", "month", "day"]
    return _rounded(SmartImputer(columns).fit(source).transform(source), ["price", "customer", "day"])


@query("fill_median", f"""
    WITH t AS (SELECT l_orderkey, l_linenumber, {hole('l_quantity', 'l_orderkey % 5', 5)} AS q,
        CASE WHEN l_orderkey % 5 < 2 THEN NULL ELSE l_extendedprice END AS p, CAST(NULL AS DOUBLE) AS e FROM lineitem)
    SELECT l_orderkey, l_linenumber, coalesce(q, (SELECT median(q) FROM t)) AS q,
        coalesce(p, (SELECT median(p) FROM t)) AS p, 0.0::DOUBLE AS e FROM t""")
def fill_median_query(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(hole("l_quantity", "l_orderkey % 5", 5)).alias("q"),
        F.expr("CASE WHEN l_orderkey % 5 < 2 THEN NULL ELSE l_extendedprice END").alias("p"),
        F.lit(None).cast("double").alias("e"))
    return fill_median(lines, ["q", "p", "e"])


def chained_pair_sql(source: str, key: str, a: str, b: str, digits: int | None = 4) -> str:
    """Chained equations of two columns as a recursion over scalars.

    A step of the recursion is one iteration of one regression. A cell that is filled is a constant plus a
    weight times the cell that is present: (c, d) for rows with one hole, (u, v) for rows with two.
    """
    both, only_a, only_b = "za IS NOT NULL AND zb IS NOT NULL", "za IS NOT NULL AND zb IS NULL", "za IS NULL AND zb IS NOT NULL"
    total = lambda e, where: f"coalesce(sum({e}) FILTER ({where}), 0)::DOUBLE"
    return f"""WITH RECURSIVE src AS ({source}),
    m AS (SELECT avg({a}) AS ma, avg({b}) AS mb, 1e-3 * greatest(max(abs({a})), max(abs({b}))) AS stop, count({a}) >= count({b}) AS a_first FROM src),
    z AS (SELECT {a} - ma AS za, {b} - mb AS zb FROM src, m),
    f AS (SELECT stop, a_first, {total('1', both)} AS n2, {total('za', both)} AS sa2, {total('zb', both)} AS sb2, {total('za * za', both)} AS aa2,
        {total('zb * zb', both)} AS bb2, {total('za * zb', both)} AS ab2, {total('1', only_a)} AS na, {total('za', only_a)} AS sa, {total('za * za', only_a)} AS aa,
        {total('1', only_b)} AS nb, {total('zb', only_b)} AS sb, {total('zb * zb', only_b)} AS bb,
        min(za) FILTER ({only_a}) AS la, max(za) FILTER ({only_a}) AS ha, min(zb) FILTER ({only_b}) AS lb, max(zb) FILTER ({only_b}) AS hb,
        count(*) FILTER (za IS NULL AND zb IS NULL) AS n0 FROM z, m GROUP BY ALL),
    walk(r, second, it, spread, noise, prev, ca, da, cb, db, ua, ub, oca, oda, ocb, odb, oua, oub, moved) AS (
        SELECT 0, false, 0, 1.0::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE,
            0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE
        UNION ALL
        SELECT CASE WHEN ended AND second THEN r + 1 ELSE r END, CASE WHEN ended THEN NOT second ELSE second END,
            CASE WHEN ended THEN 0 ELSE it + 1 END, CASE WHEN ended THEN 1.0 ELSE spread2 END, CASE WHEN ended THEN NULL ELSE noise2 END,
            CASE WHEN ended THEN NULL ELSE w END, nca, nda, ncb, ndb, nua, nub,
            CASE WHEN ended AND second THEN nca ELSE oca END, CASE WHEN ended AND second THEN nda ELSE oda END,
            CASE WHEN ended AND second THEN ncb ELSE ocb END, CASE WHEN ended AND second THEN ndb ELSE odb END,
            CASE WHEN ended AND second THEN nua ELSE oua END, CASE WHEN ended AND second THEN nub ELSE oub END,
            CASE WHEN ended AND second THEN greatest(
                coalesce(abs(nca - oca + (nda - oda) * lb), 0), coalesce(abs(nca - oca + (nda - oda) * hb), 0),
                coalesce(abs(ncb - ocb + (ndb - odb) * la), 0), coalesce(abs(ncb - ocb + (ndb - odb) * ha), 0),
                CASE WHEN n0 > 0 THEN abs(nua - oua) + abs(nub - oub) ELSE 0 END) END
        FROM (SELECT *,
                CASE WHEN ended AND on_a THEN base ELSE ca END AS nca, CASE WHEN ended AND on_a THEN wf ELSE da END AS nda,
                CASE WHEN ended AND NOT on_a THEN base ELSE cb END AS ncb, CASE WHEN ended AND NOT on_a THEN wf ELSE db END AS ndb,
                CASE WHEN ended AND on_a THEN base + wf * ub ELSE ua END AS nua, CASE WHEN ended AND NOT on_a THEN base + wf * ua ELSE ub END AS nub
            FROM (SELECT *, (st - wf * sp) / n AS base
            FROM (SELECT *, cr / (g + spread2 / noise2) AS wf, it = 299 OR coalesce(abs(prev - w) < 1e-3, false) AS ended
            FROM (SELECT *, (eff + 2e-6) / (w * w + 2e-6) AS spread2, (n - eff + 2e-6) / (greatest(sq - 2 * w * cr + w * w * g, 0) + 2e-6) AS noise2
            FROM (SELECT *, cr / (g + spread / noise1) AS w, noise1 * g / (spread + noise1 * g) AS eff
            FROM (SELECT *, coalesce(noise, 1 / (sq / n + 2.220446049250313e-16)) AS noise1
            FROM (SELECT *, tp - sp * sp / n AS g, tc - sp * st / n AS cr, tt - st * st / n AS sq
            FROM (SELECT walk.*, f.*, second <> a_first AS on_a,
                CASE WHEN second <> a_first THEN n2 + na ELSE n2 + nb END AS n,
                CASE WHEN second <> a_first THEN sa2 + sa ELSE sb2 + sb END AS st,
                CASE WHEN second <> a_first THEN aa2 + aa ELSE bb2 + bb END AS tt,
                CASE WHEN second <> a_first THEN sb2 + cb * na + db * sa ELSE sa2 + ca * nb + da * sb END AS sp,
                CASE WHEN second <> a_first THEN bb2 + cb * cb * na + 2 * cb * db * sa + db * db * aa
                    ELSE aa2 + ca * ca * nb + 2 * ca * da * sb + da * da * bb END AS tp,
                CASE WHEN second <> a_first THEN ab2 + cb * sa + db * aa ELSE ab2 + ca * sb + da * bb END AS tc
                FROM walk, f WHERE r < 10 AND NOT (it = 0 AND NOT second AND coalesce(moved < stop, false))))))))))),
    final AS (SELECT * FROM walk WHERE it = 0 AND NOT second ORDER BY r DESC LIMIT 1)
    SELECT {key}, {rounded(f"coalesce({a}, ma + CASE WHEN {b} IS NULL THEN ua ELSE ca + da * ({b} - mb) END)", digits)} AS {a},
        {rounded(f"coalesce({b}, mb + CASE WHEN {a} IS NULL THEN ub ELSE cb + db * ({a} - ma) END)", digits)} AS {b}
    FROM src, m, final"""


PAIR = f"""SELECT l_orderkey, l_linenumber, {hole('l_extendedprice', '(l_orderkey + l_linenumber)', 7)} AS price,
    {hole('l_quantity', '(l_orderkey + l_partkey)', 5)} AS quantity FROM lineitem"""


@query("chained_pair", chained_pair_sql(PAIR, "l_orderkey, l_linenumber", "price", "quantity"))
def chained_pair(spark, sf):
    source = spark.sql(PAIR.replace("FROM lineitem", "FROM {l}"), l=table(spark, sf, "lineitem"))
    return _rounded(ChainedImputer(["price", "quantity"]).fit(source).transform(source), ["price", "quantity"], 4)


ORDER_PAIR = f"""SELECT o_orderkey, {hole('o_totalprice', 'o_orderkey', 31)} AS price,
    {hole('CAST(o_custkey AS DOUBLE)', 'o_orderkey', 9)} AS customer FROM orders"""


@query("smart_imputer_pair", f"""
    SELECT o_orderkey, k.price, c.customer FROM ({knn_sql(ORDER_PAIR, "o_orderkey", ["price", "customer"], ["price"])}) k
    JOIN ({chained_pair_sql(ORDER_PAIR, "o_orderkey", "price", "customer")}) c USING (o_orderkey)""")
def smart_imputer_pair(spark, sf):
    """Per column: the price by its neighbours, the customer by chained equations over both."""
    source = spark.sql(ORDER_PAIR.replace("FROM orders", "FROM {o}"), o=table(spark, sf, "orders"))
    columns = ["price", "customer"]
    return _rounded(SmartImputer(columns, per_column=True).fit(source).transform(source), columns, 4)


# ---- outliers -----------------------------------------------------------------------------------

def outlier_sql(source: str, key: str, columns: list[str], digits: int | None = 6) -> str:
    stats, out = [], []
    for c in columns:
        stats.append(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3, "
                     f"quantile_cont({c}, 0.01) AS {c}_p1, quantile_cont({c}, 0.99) AS {c}_p99")
        lo, hi = f"({c}_q1 - 1.5 * ({c}_q3 - {c}_q1))", f"({c}_q3 + 1.5 * ({c}_q3 - {c}_q1))"
        share = f"{c}_share"
        low = f"CASE WHEN {share} < 5 THEN {c}_p1 WHEN {share} < 15 THEN {lo} END"
        high = f"CASE WHEN {share} < 5 THEN {c}_p99 WHEN {share} < 15 THEN {hi} END"
        value = (f"CASE WHEN {share} = 0 OR {share} >= 15 THEN {c} WHEN {c} < {low} THEN {low} "
                 f"WHEN {c} > {high} THEN {high} ELSE {c} END")
        out.append(f"{rounded(value, digits)} AS {c}")
    shares = [f"count(*) FILTER ({c} < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) OR {c} > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1))"
              f"::DOUBLE / count(*) * 100 AS {c}_share" for c in columns]
    return f"""WITH src AS ({source}), q AS (SELECT {', '.join(stats)} FROM src),
        s AS (SELECT {', '.join(shares)} FROM src, q)
        SELECT {key}, {', '.join(out)} FROM src, q, s"""


def _treated(df: DataFrame, columns: list[str]) -> DataFrame:
    return _rounded(OutlierTreatment(columns).fit(df).transform(df), columns, 6)


EVENT_VALUES = f"SELECT event_id, value, {hole('value', 'event_id', 9)} AS holed FROM events"


@query("outliers_events", outlier_sql(EVENT_VALUES, "event_id", ["value", "holed"]))
def outliers_events(spark, sf):
    source = spark.sql(EVENT_VALUES.replace("FROM events", "FROM {e}"), e=table(spark, sf, "events"))
    return _treated(source, ["value", "holed"])


DOCUMENT_SIZES = "SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars FROM documents"


@query("outliers_documents", outlier_sql(DOCUMENT_SIZES, "doc_id", ["n_chars"]))
def outliers_documents(spark, sf):
    source = spark.sql(DOCUMENT_SIZES.replace("FROM documents", "FROM {d}"), d=table(spark, sf, "documents"))
    return _treated(source, ["n_chars"])


LINE_VALUES = """SELECT l_orderkey, l_linenumber, l_extendedprice AS price,
    CASE WHEN l_orderkey % 5 = 0 THEN l_quantity * 100 ELSE l_quantity END AS many,
    CASE WHEN l_orderkey % 12 = 0 THEN l_quantity * 100 ELSE l_quantity END AS several,
    CASE WHEN l_orderkey % 40 = 0 THEN -l_quantity * 100 ELSE l_quantity END AS few FROM lineitem"""


@query("outliers_lines", outlier_sql(LINE_VALUES, "l_orderkey, l_linenumber", ["price", "many", "several", "few"]))
def outliers_lines(spark, sf):
    source = spark.sql(LINE_VALUES.replace("FROM lineitem", "FROM {l}"), l=table(spark, sf, "lineitem"))
    return _treated(source, ["price", "many", "several", "few"])


PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@query("exact_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS prob, round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount") for p in PROBS))
def exact_quantiles_query(spark, sf):
    found = exact_quantiles(table(spark, sf, "lineitem"), {c: PROBS for c in ("l_quantity", "l_extendedprice", "l_discount")})
    rows = [(c, p, v) for c, values in found.items() for p, v in values.items()]
    return spark.createDataFrame(rows, "column string, prob double, value double").withColumn("value", F.round("value", 6))


SPARSE = ", ".join(f"CASE WHEN event_id % {k} = 0 THEN value END AS every{k}" for k in (3, 7, 29, 131))
SPARSE_EVENTS = f"SELECT event_id, {SPARSE} FROM events"
SPARSE_COLUMNS = ["every3", "every7", "every29", "every131"]


def _sparse(spark, sf):
    return spark.sql(SPARSE_EVENTS.replace("FROM events", "FROM {e}"), e=table(spark, sf, "events"))


@query("quantiles_small_groups", f"WITH t AS ({SPARSE_EVENTS}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS prob, round(quantile_cont({c}, {p}), 6) AS value FROM t" for c in SPARSE_COLUMNS for p in PROBS))
def quantiles_small_groups(spark, sf):
    found = exact_quantiles(_sparse(spark, sf), dict.fromkeys(SPARSE_COLUMNS, PROBS))
    rows = [(c, p, v) for c, values in found.items() for p, v in values.items()]
    return spark.createDataFrame(rows, "column string, prob double, value double").withColumn("value", F.round("value", 6))


@query("outliers_sparse_column", outlier_sql(SPARSE_EVENTS, "event_id", SPARSE_COLUMNS))
def outliers_sparse_column(spark, sf):
    return _treated(_sparse(spark, sf), SPARSE_COLUMNS)


NAN_EVENTS = "SELECT event_id, event_type, CASE WHEN event_id % 6 = 1 THEN {nan} WHEN event_id % 10 = 3 THEN NULL ELSE value END AS value FROM {events}"


def _with_nan(spark, sf):
    return spark.sql(NAN_EVENTS.format(nan="double('NaN')", events="{e}"), e=table(spark, sf, "events"))


@query("outliers_with_nan", outlier_sql(NAN_EVENTS.format(nan="NULL", events="events"), "event_id", ["value"]))
def outliers_with_nan(spark, sf):
    return _treated(_with_nan(spark, sf).drop("event_type"), ["value"])


# ---- profile ------------------------------------------------------------------------------------

PROFILED = f"""SELECT o_orderkey, {hole('o_custkey', 'o_orderkey', 10)} AS o_custkey,
    {hole('o_orderstatus', 'o_orderkey', 7)} AS o_orderstatus, {hole('o_totalprice', 'o_orderkey', 4)} AS o_totalprice,
    o_orderdate, {hole('o_orderpriority', 'o_orderkey', 2)} AS o_orderpriority FROM orders"""
PROFILED_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
PROFILED_TYPES = ["bigint", "bigint", "string", "double", "timestamp_ntz", "string"]


def _profiled(spark, sf):
    return spark.sql(PROFILED.replace("FROM orders", "FROM {o}"), o=table(spark, sf, "orders"))


def per_column(select: str, columns=PROFILED_COLUMNS) -> str:
    return f"WITH t AS ({PROFILED}) " + " UNION ALL ".join(
        select.format(c=c, name=f"'{c}' AS \"column\"") for c in columns)


@query("table_size", "SELECT count(*) AS n_rows, 6 AS n_columns FROM orders")
def table_size(spark, sf):
    return profile.table_size(_profiled(spark, sf))


@query("null_counts", per_column("SELECT {name}, count(*) - count({c}) AS null_count FROM t"))
def null_counts(spark, sf):
    return profile.null_counts(_profiled(spark, sf))


SHARE = "(count(*) - count({c}))::DOUBLE * 100 / count(*)"


@query("null_shares", per_column(
    "SELECT {name}, count(*) - count({c}) AS null_count, round(" + SHARE + ", 8) AS missing_pct, "
    "round(100 - " + SHARE + ", 8) AS complete_pct FROM t"))
def null_shares(spark, sf):
    return _rounded(profile.null_shares(_profiled(spark, sf)), ["missing_pct", "complete_pct"], 8)


@query("missing_report", "SELECT * FROM (" + per_column(
    "SELECT {name}, count(*) - count({c}) AS missing_count, round(" + SHARE + ", 8) AS missing_pct FROM t") +
    ") WHERE missing_count > 0 ORDER BY missing_pct DESC, \"column\" LIMIT 15")
def missing_report(spark, sf):
    return _rounded(profile.missing_report(_profiled(spark, sf)), ["missing_pct"], 8)


@query("table_info", f"WITH t AS ({PROFILED}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{d}' AS dtype, count({c}) AS non_null FROM t"
    for c, d in zip(PROFILED_COLUMNS, PROFILED_TYPES)))
def table_info(spark, sf):
    return profile.table_info(_profiled(spark, sf))


@query("distinct_counts", per_column("SELECT {name}, count(DISTINCT {c}) AS n_unique FROM t"))
def distinct_counts(spark, sf):
    return profile.distinct_counts(_profiled(spark, sf))


@query("distinct_counts_documents", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM documents"
    for c in ("doc_id", "text", "lang", "source", "n_chars")))
def distinct_counts_documents(spark, sf):
    return profile.distinct_counts(table(spark, sf, "documents"))


DESCRIBE = """SELECT {name}, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
    min({c})::DOUBLE AS min, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25,
    round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75,
    max({c})::DOUBLE AS max{extra} FROM t"""
DESCRIBED = ["mean", "std"]


def _describe_rounded(df: DataFrame) -> DataFrame:
    return _rounded(_rounded(df, ["mean", "std"], 4), ["p25", "p50", "p75"], 6)


@query("describe_numeric", per_column(DESCRIBE.replace("{extra}", ""), ["o_orderkey", "o_custkey", "o_totalprice"]))
def describe_numeric(spark, sf):
    return _describe_rounded(profile.describe_numeric(_profiled(spark, sf)))


VALUES = """SELECT * FROM (SELECT {name}, sum(n)::BIGINT AS count, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std,
    CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS p25, CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p75,
    CAST(NULL AS DOUBLE) AS max, count(*) AS "unique", arg_max(v, (n, -place)) AS top, max(n) AS freq
    FROM (SELECT v, n, row_number() OVER (ORDER BY v) AS place
        FROM (SELECT CAST({c} AS STRING) AS v, count(*) AS n FROM t WHERE {c} IS NOT NULL GROUP BY ALL)))"""


@query("describe_sparse_columns", f"WITH t AS ({SPARSE_EVENTS}) " + " UNION ALL ".join(
    DESCRIBE.replace("{extra}", "").format(c=c, name=f"'{c}' AS \"column\"") for c in SPARSE_COLUMNS))
def describe_sparse_columns(spark, sf):
    return _describe_rounded(profile.describe_numeric(_sparse(spark, sf), SPARSE_COLUMNS))


@query("profile_with_nan", "WITH t AS (" + NAN_EVENTS.format(nan="NULL", events="events") + ") SELECT n.*, d.* EXCLUDE (\"column\") FROM ("
       + "SELECT 'value' AS \"column\", count(*) - count(value) AS null_count FROM t) n JOIN ("
       + DESCRIBE.replace("{extra}", "").format(c="value", name="'value' AS \"column\"") + ") d USING (\"column\")")
def profile_with_nan(spark, sf):
    events = _with_nan(spark, sf)
    return profile.null_counts(events).join(_describe_rounded(profile.describe_numeric(events, ["value"])), "column")


@query("histogram_with_nan", "WITH t AS (" + NAN_EVENTS.format(nan="NULL", events="events") + """),
    m AS (SELECT min(value) AS lo, max(value) AS hi FROM t), b AS (SELECT unnest(range(1, 21))::INT AS bin)
    SELECT bin, round(lo + (bin - 1) * ((hi - lo) / 20), 6) AS low, round(lo + bin * ((hi - lo) / 20), 6) AS high,
        (SELECT count(*) FROM t WHERE value IS NOT NULL AND least(20, floor((value - lo) / (hi - lo) * 20) + 1) = bin) AS count
    FROM b, m""")
def histogram_with_nan(spark, sf):
    return _rounded(reports.histogram(_with_nan(spark, sf), "value"), ["low", "high"], 6)


@query("describe_all", f"WITH t AS ({PROFILED}) " + " UNION ALL ".join(
    [DESCRIBE.format(c=c, name=f"'{c}' AS \"column\"", extra=", CAST(NULL AS BIGINT) AS \"unique\", "
                     "CAST(NULL AS STRING) AS top, CAST(NULL AS BIGINT) AS freq")
     for c in ("o_orderkey", "o_custkey", "o_totalprice")] +
    [VALUES.format(c=c, name=f"'{c}' AS \"column\"") for c in ("o_orderstatus", "o_orderdate", "o_orderpriority")]))
def describe_all(spark, sf):
    return _describe_rounded(profile.describe_all(_profiled(spark, sf)))


@query("column_documents", f"WITH t AS ({PROFILED}) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{d}' AS dtype, count(*) - count({c}) AS null_count,
        round({SHARE.format(c=c)}, 8) AS null_pct, count(DISTINCT {c}) AS unique_count,
        {f'min({c})' if d != 'string' else 'NULL'}::STRING AS min, {f'max({c})' if d != 'string' else 'NULL'}::STRING AS max,
        {f'round(avg({c}), 4)' if d in ('bigint', 'double') else 'NULL'}::DOUBLE AS mean,
        {f"(SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM t WHERE {c} IS NOT NULL ORDER BY v LIMIT 5))"
         if d == 'string' else 'NULL'}::STRING AS samples FROM t""" for c, d in zip(PROFILED_COLUMNS, PROFILED_TYPES)))
def column_documents(spark, sf):
    documents = profile.column_documents(_profiled(spark, sf))
    return _rounded(_rounded(documents, ["null_pct"], 8), ["mean"]).withColumn(
        "samples", F.when(F.col("sample_values").isNotNull(), F.array_join("sample_values", "|"))).drop("sample_values")


CORRELATED = {"price": hole("l_extendedprice", "l_orderkey", 6), "quantity": "l_quantity",
              "discount": hole("l_discount", "l_partkey", 5), "tax": "l_tax"}


@query("correlations", "WITH t AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in CORRELATED.items()) +
       " FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{a}' AS left_column, '{b}' AS right_column, round({'1.0::DOUBLE' if a == b else f'corr({a}, {b})'}, 8) AS corr FROM "
    + ("(SELECT 1)" if a == b else "t") for a in CORRELATED for b in CORRELATED))
def correlations(spark, sf):
    lines = table(spark, sf, "lineitem").select(*[F.expr(e).alias(n) for n, e in CORRELATED.items()])
    return _rounded(profile.correlations(lines), ["corr"], 8)


@query("most_correlated_columns", "WITH t AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in CORRELATED.items()) +
       " FROM lineitem), c AS (" + " UNION ALL ".join(
    f"SELECT '{b}' AS \"column\", abs(corr(price, {b})) AS strength FROM t" for b in CORRELATED if b != "price") + """)
    SELECT 'price' AS "column", 1 AS place UNION ALL
    SELECT "column", 1 + row_number() OVER (ORDER BY strength DESC)::INT FROM c ORDER BY place LIMIT 3""")
def most_correlated_columns(spark, sf):
    lines = table(spark, sf, "lineitem").select(*[F.expr(e).alias(n) for n, e in CORRELATED.items()])
    ranked = profile.most_correlated(lines, "price", list(CORRELATED), 3)
    return spark.createDataFrame(list(zip(ranked, range(1, 4))), "column string, place int")


# ---- reports ------------------------------------------------------------------------------------

@query("value_counts", """
    SELECT source, count(*) AS count FROM (SELECT CASE WHEN doc_id % 9 = 0 THEN NULL ELSE source END AS source
        FROM documents) WHERE source IS NOT NULL GROUP BY source""")
def value_counts(spark, sf):
    docs = table(spark, sf, "documents").select(F.expr(hole("source", "doc_id", 9)).alias("source"))
    return reports.value_counts(docs, "source")


@query("top_values", """
    SELECT user_id, count(*) AS count FROM events GROUP BY user_id ORDER BY count DESC, user_id LIMIT 10""")
def top_values(spark, sf):
    return reports.top_values(table(spark, sf, "events"), "user_id")


@query("group_means", f"""
    SELECT event_type, round(avg(x), 6) AS mean_value FROM (SELECT {hole('event_type', 'user_id', 8)} AS event_type,
        CASE WHEN event_type = 'error' OR event_id % 5 = 0 THEN NULL ELSE value END AS x FROM events)
    WHERE event_type IS NOT NULL GROUP BY event_type""")
def group_means(spark, sf):
    events = table(spark, sf, "events").select(
        F.expr(hole("event_type", "user_id", 8)).alias("event_type"),
        F.expr("CASE WHEN event_type = 'error' OR event_id % 5 = 0 THEN NULL ELSE value END").alias("x"))
    return _rounded(reports.group_means(events, "event_type", "x", "mean_value"), ["mean_value"], 6)


@query("top_rows", f"""
    SELECT o_orderkey, price, o_orderpriority FROM (SELECT *, {hole('o_totalprice', 'o_orderkey', 3)} AS price FROM orders)
    ORDER BY price DESC NULLS LAST, o_orderkey LIMIT 10""")
def top_rows(spark, sf):
    orders = table(spark, sf, "orders").withColumn("price", F.expr(hole("o_totalprice", "o_orderkey", 3)))
    return reports.top_rows(orders, ["o_orderkey", "price", "o_orderpriority"], "price")


@query("histogram", f"""
    WITH t AS (SELECT {hole('value', 'event_id', 6)} AS x FROM events), r AS (SELECT min(x) AS lo, max(x) AS hi FROM t),
    n AS (SELECT least(floor((x - lo) / ((hi - lo) / 20)) + 1, 20)::INT AS bin, count(*) AS n FROM t, r
        WHERE x IS NOT NULL GROUP BY ALL)
    SELECT b::INT AS bin, round(lo + (b - 1) * (hi - lo) / 20, 6) AS low, round(lo + b * (hi - lo) / 20, 6) AS high,
        coalesce(n, 0) AS count FROM range(1, 21) AS g(b) CROSS JOIN r LEFT JOIN n ON n.bin = b""")
def histogram(spark, sf):
    events = table(spark, sf, "events").select(F.expr(hole("value", "event_id", 6)).alias("x"))
    return _rounded(reports.histogram(events, "x"), ["low", "high"], 6)


# ---- recipes ------------------------------------------------------------------------------------

@query("recipe_product_feed", """
    SELECT product_id, fetch_time, title FROM (SELECT *, row_number() OVER (PARTITION BY product_id
        ORDER BY fetch_time DESC NULLS FIRST, title DESC) AS place FROM (
        SELECT DISTINCT CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_partkey END AS product_id,
            CASE WHEN l_orderkey % 90 = 0 THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS fetch_time,
            l_returnflag || l_linenumber AS title FROM lineitem)) WHERE place = 1""")
def recipe_product_feed(spark, sf):
    feed = table(spark, sf, "lineitem").select(
        F.expr("CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_partkey END").alias("product_id"),
        F.expr("CASE WHEN l_orderkey % 90 = 0 THEN NULL ELSE date_format(l_shipdate, 'yyyy-MM-dd') END").alias("fetch_time"),
        F.expr("concat(l_returnflag, l_linenumber)").alias("title"))
    return recipes.recipe_for("feed_products_API")(feed)


@query("recipe_purchases", """
    SELECT "Purchase_Date", customer, year("Purchase_Date")::INT AS "Year", month("Purchase_Date")::INT AS "Month",
        dayname("Purchase_Date") AS "DayOfWeek"
    FROM (SELECT DISTINCT CASE WHEN o_orderkey % 20 <> 0 THEN o_orderdate::DATE END AS "Purchase_Date",
        o_custkey % 40 AS customer FROM orders)""")
def recipe_purchases(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.expr("CASE WHEN o_orderkey % 20 = 0 THEN 'unknown' ELSE date_format(o_orderdate, 'MM-dd-yy') END")
        .alias("Purchase_Date"), (F.col("o_custkey") % 40).alias("customer"))
    return recipes.recipe_for("shop_customers_purchases")(raw)


PRODUCTS = """SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_retailprice AS final_price,
        CASE WHEN brand % 5 = 0 AND p_partkey % 40 = 0 THEN NULL WHEN brand % 5 = 1 AND p_partkey % 3 = 0 THEN NULL
             WHEN brand % 5 = 2 THEN NULL ELSE p_retailprice + p_size END AS initial_price,
        CASE WHEN brand % 5 = 1 AND p_partkey % 7 = 0 THEN NULL ELSE {discount} END AS discount,
        CASE WHEN brand % 5 = 4 THEN NULL ELSE p_brand END AS root_category_name {more}
    FROM (SELECT *, CAST(replace(p_brand, 'Brand#', '') AS INT) AS brand FROM {part} UNION ALL
        SELECT *, CAST(replace(p_brand, 'Brand#', '') AS INT) AS brand FROM {part} WHERE p_size > 25)"""


@query("recipe_products", "WITH p AS (SELECT DISTINCT * FROM (" + PRODUCTS.format(
    part="part", discount="CAST(p_size AS DOUBLE)", more="") + """)), rates AS (
    SELECT root_category_name AS g, count(*) AS n, count(*) FILTER (initial_price IS NULL OR discount IS NULL) AS bad
    FROM p WHERE root_category_name IS NOT NULL GROUP BY ALL),
    kept AS (SELECT p.* FROM p LEFT JOIN rates ON g = root_category_name
        WHERE NOT ((initial_price IS NULL OR discount IS NULL) AND coalesce(bad::DOUBLE / n <= 0.05 OR bad = n, false)))
    SELECT product_id, product_name, brand, final_price, root_category_name,
        round(coalesce(initial_price, CASE WHEN root_category_name IS NOT NULL
            THEN avg(initial_price) OVER (PARTITION BY root_category_name) END), 6) AS initial_price,
        round(coalesce(discount, CASE WHEN root_category_name IS NOT NULL
            THEN avg(discount) OVER (PARTITION BY root_category_name) END), 6) AS discount FROM kept""")
def recipe_products(spark, sf):
    text = PRODUCTS.format(part="{part}", discount="concat('$', CAST(p_size AS STRING))", more=", p_type AS unwanted")
    raw = spark.sql(text, part=table(spark, sf, "part"))
    return _rounded(recipes.recipe_for("shop_products")(raw), ["initial_price", "discount"], 6)


@query("recipe_exploration_mean_price", """
    SELECT query, round(avg(price), 6) AS price FROM (SELECT event_type AS query,
        coalesce(nullif(CASE WHEN event_id % 4 = 0 THEN 0.0 ELSE value END, 0.0), user_id::DOUBLE) AS price FROM events)
    GROUP BY query""")
def recipe_exploration_mean_price(spark, sf):
    feed = table(spark, sf, "events").select(
        F.col("event_type").alias("query"),
        F.expr("""concat("{'offer_price': ", CASE WHEN event_id % 4 = 0 THEN '0' ELSE CAST(value AS STRING) END,
            ", 'min_price': ", user_id, ", 'free': False}")""").alias("primary_offer"))
    return _rounded(recipes.explore_products(feed)["mean_price_by_query"], ["price"], 6)


def _reports(spark, sf):
    feed = table(spark, sf, "events").selectExpr(
        "event_type as query", "concat('title ', event_id) as title", "CAST(user_id AS STRING) as reviews",
        "CAST(event_id % 50 / CAST(10.0 AS DOUBLE) AS STRING) as rating", "concat('seller ', user_id % 40) as seller_name",
        """concat("{'offer_price': ", value, "}") as primary_offer""")
    return recipes.explore_products(feed)


@query("recipe_exploration_query_counts", "SELECT event_type AS query, count(*) AS count FROM events GROUP BY ALL")
def recipe_exploration_query_counts(spark, sf):
    return _reports(spark, sf)["query_counts"]


@query("recipe_exploration_top_sellers", """
    SELECT 'seller ' || (user_id % 40) AS seller_name, count(*) AS count FROM events GROUP BY ALL ORDER BY count DESC, seller_name LIMIT 10""")
def recipe_exploration_top_sellers(spark, sf):
    return _reports(spark, sf)["top_sellers"]


@query("recipe_exploration_top_reviews", """
    SELECT 'title ' || event_id AS title, user_id::DOUBLE AS reviews, CAST((event_id % 50 / 10.0::DOUBLE) AS STRING) AS rating
    FROM events ORDER BY user_id DESC, title LIMIT 10""")
def recipe_exploration_top_reviews(spark, sf):
    return _reports(spark, sf)["top_reviews"]


@query("recipe_exploration_rating_describe", "WITH t AS (SELECT event_id % 50 / 10.0::DOUBLE AS rating FROM events) "
       + DESCRIBE.replace("{extra}", "").format(c="rating", name="'rating' AS \"column\""))
def recipe_exploration_rating_describe(spark, sf):
    return _describe_rounded(_reports(spark, sf)["rating_describe"])


@query("recipe_exploration_price_describe", "WITH t AS (SELECT nullif(value, 0.0) AS price FROM events) "
       + DESCRIBE.replace("{extra}", "").format(c="price", name="'price' AS \"column\""))
def recipe_exploration_price_describe(spark, sf):
    return _describe_rounded(_reports(spark, sf)["price_describe"])


@query("recipe_profile_nulls_and_distinct", per_column(
    "SELECT {name}, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS n_unique FROM t"))
def recipe_profile_nulls_and_distinct(spark, sf):
    found = recipes.profile_tables(_profiled(spark, sf))
    return found["nulls"].join(found["unique"], "column")


def _marketing(spark, sf, holes: dict[str, int]) -> DataFrame:
    """Orders dressed up as the raw marketing table: every cell is text, some are blank."""
    def blank(text: str, name: str) -> str:
        return hole(text, "o_orderkey", holes[name], 1) if name in holes else text

    price = "concat('$', CAST(o_totalprice AS STRING))"
    cells = {
        "Uniq Id": "concat('u', o_orderkey)",
        "Price": blank(price, "Price"),
        "Monthly Price": blank("CAST(o_custkey % 90 AS STRING)", "Monthly Price"),
        "Num Of Reviews": blank("CAST(o_orderkey % 61 AS STRING)", "Num Of Reviews"),
        "Average Rating": blank("CAST((o_orderkey % 50) / 10D AS STRING)", "Average Rating"),
        "Number Of Ratings": "CAST(o_orderkey % 77 AS STRING)",
        **{s: f"CAST((o_orderkey + {i}) % 11 AS STRING)" for i, s in enumerate(recipes.STAR_COLUMNS)},
        "Title": "concat(' -', o_orderpriority, '! ')",
        "Carrier": "CASE WHEN o_orderkey % 2 = 0 THEN 'NA' ELSE o_orderstatus END",
        "Stock": "CASE WHEN o_orderkey % 3 = 0 THEN 'TRUE' ELSE 'no' END",
        "Discontinued": "'FALSE'",
        "Crawl Timestamp": "concat(date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'), ' +0000')",
    }
    return table(spark, sf, "orders").select(*[F.expr(e).alias(n) for n, e in cells.items()])


_PRICED = knn_sql(
    f"""SELECT o_orderkey, {hole('o_totalprice', 'o_orderkey', 30, 1)} AS price,
        {hole('(o_orderkey % 50) / 10.0::DOUBLE', 'o_orderkey', 40, 1)} AS average_rating FROM orders""",
    "o_orderkey", ["price", "average_rating"], ["price", "average_rating"], digits=None)
_FILLED = f"""SELECT f.*, coalesce(monthly, (SELECT median(monthly) FROM m)) AS monthly_price,
    reviews AS num_of_reviews, ratings AS number_of_ratings FROM ({_PRICED}) f JOIN m USING (o_orderkey)"""


@query("recipe_marketing", f"""
    WITH m AS (SELECT o_orderkey, {hole('(o_custkey % 90)::DOUBLE', 'o_orderkey', 3, 1)} AS monthly,
        (o_orderkey % 61)::DOUBLE AS reviews, (o_orderkey % 77)::DOUBLE AS ratings FROM orders),
    treated AS ({outlier_sql(_FILLED, "o_orderkey",
        ["price", "monthly_price", "average_rating", "num_of_reviews", "number_of_ratings"], digits=None)})
    SELECT round(t.price, 4) AS price, monthly_price, num_of_reviews, round(average_rating, 4) AS average_rating, number_of_ratings,
        ((t.o_orderkey + 0) % 11)::DOUBLE AS five_star, ((t.o_orderkey + 1) % 11)::DOUBLE AS four_star,
        ((t.o_orderkey + 2) % 11)::DOUBLE AS three_star, ((t.o_orderkey + 3) % 11)::DOUBLE AS two_star,
        ((t.o_orderkey + 4) % 11)::DOUBLE AS one_star, o_orderpriority AS title,
        CASE WHEN t.o_orderkey % 2 = 0 THEN 'Unknown' ELSE o_orderstatus END AS carrier, t.o_orderkey % 3 = 0 AS stock,
        epoch(o_orderdate)::BIGINT AS crawl_seconds, year(o_orderdate)::INT AS crawl_year,
        month(o_orderdate)::INT AS crawl_month, day(o_orderdate)::INT AS crawl_day,
        (isodow(o_orderdate) - 1)::INT AS crawl_dayofweek,
        ((t.o_orderkey % 11) + ((t.o_orderkey + 1) % 11) + ((t.o_orderkey + 2) % 11) + ((t.o_orderkey + 3) % 11)
            + ((t.o_orderkey + 4) % 11))::DOUBLE AS total_star_ratings,
        (num_of_reviews > 0)::INT AS has_reviews,
        CASE WHEN average_rating <= 0 THEN NULL WHEN average_rating <= 2 THEN 'Poor' WHEN average_rating <= 3 THEN 'Fair'
            WHEN average_rating <= 4 THEN 'Good' WHEN average_rating <= 5 THEN 'Excellent' END AS rating_quality,
        num_of_reviews / (number_of_ratings + 1) AS review_density,
        round(t.price / (average_rating + 0.1::DOUBLE), 6) AS price_per_rating
    FROM treated t JOIN orders o ON t.o_orderkey = o.o_orderkey""")
def recipe_marketing(spark, sf):
    raw = _marketing(spark, sf, {"Price": 30, "Average Rating": 40, "Monthly Price": 3})
    clean = recipes.recipe_for("Marketing_Data")(raw)
    rounded = _rounded(_rounded(clean, ["price", "average_rating"]), ["price_per_rating"], 6)
    return rounded.withColumn(
        "crawl_seconds", F.unix_seconds("crawl_timestamp")).drop("crawl_timestamp")


@query("recipe_marketing_older")
def recipe_marketing_older(spark, sf):
    raw = _marketing(spark, sf, {"Price": 30, "Average Rating": 9, "Num Of Reviews": 7, "Monthly Price": 3})
    return recipes.clean_marketing_older(raw)


# ---- sketches that unite over runs --------------------------------------------------------------

@query("sketched_distinct_counts", """
    SELECT c AS "column", true AS within FROM (VALUES ('l_orderkey'), ('l_partkey'), ('l_shipdate'), ('l_quantity')) t(c)""")
def sketched_distinct_counts(spark, sf):
    """Sketches of two halves, united, against exact counts: within four standard errors."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_quantity")
    halves = [sketches.distinct_sketches(lines.where(F.col("l_orderkey") % 2 == i)) for i in range(2)]
    found = sketches.estimated_distinct(sketches.united_distinct(*halves)).withColumnRenamed("n_unique", "estimate")
    exact = profile.distinct_counts(lines)
    return found.join(exact, "column").select("column", (F.abs(F.col("estimate") - F.col("n_unique")) <= 1 + 0.065 * F.col("n_unique")).alias("within"))


@query("sketched_quantiles", """
    SELECT c AS "column", r AS rank, true AS within FROM (VALUES ('l_quantity'), ('l_extendedprice')) t(c), (VALUES (0.1), (0.5), (0.9)) q(r)""".replace(
    "r AS rank", "CAST(r AS DOUBLE) AS rank"))
def sketched_quantiles(spark, sf):
    """Sketches of two halves, united: the share of values below the estimate is near its rank."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_quantity").cast("double"), F.col("l_extendedprice").cast("double"))
    columns = ["l_quantity", "l_extendedprice"]
    halves = [sketches.quantile_sketches(lines.where(F.col("l_orderkey") % 2 == i), columns) for i in range(2)]
    found = sketches.estimated_quantiles(sketches.united_quantiles(*halves), [0.1, 0.5, 0.9])
    cells = lines.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("x")) for c in columns])))
    met = cells.join(F.broadcast(found), "column")  # six rows of estimates
    shares = met.groupBy("column", "rank").agg(F.avg((F.col("x") < F.col("value")).cast("int")).alias("below"), F.avg((F.col("x") <= F.col("value")).cast("int")).alias("upto"))
    return shares.select("column", "rank", ((F.col("below") <= F.col("rank") + 0.02) & (F.col("upto") >= F.col("rank") - 0.02)).alias("within"))
