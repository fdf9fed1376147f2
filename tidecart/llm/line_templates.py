"""Drop lines whose template recurs across documents, found with a log-template tree.

The tree has a fixed depth: a line descends by its number of tokens and then by its leading tokens,
where tokens with a digit count as a variable field. In the leaf it reaches, a token stays constant
where enough documents have it at that place; every other token is a variable field. What results is
the line's template. A template that enough documents share, mostly of constant tokens, is boilerplate:
only its first line in the corpus stays. All of it is joins and aggregations.

A template leaves so few places open that, with the places below the tree cut into one block more, the
lines of the template agree in a whole block. So leaves in which no block of constant tokens recurs
have no template and are left out; over the whole corpus only hashes of leaves and blocks are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart.llm._common import column, fresh
from tidecart.operators.attach import fits_broadcast
from tidecart.session import pin

DEPTH = 3
MIN_DOCS = 3
MIN_TOKENS = 6
CONSTANT_PERCENT = 70
BROADCAST_BYTES = 16 * 1024 * 1024
VARIABLE = "<*>"


def single_blanks(line: Column) -> Column:
    """The tokens of a line, which blanks divide, with one blank between them. As most lines are so already, no token is cut out."""
    odd = line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    return F.when(odd, F.regexp_replace(F.trim(line), " +", " ")).otherwise(line)


def masked(plain: Column) -> Column:
    """Tokens with one blank between them, those that hold a digit made variable."""
    # possessive, from the start of a token on: each character is looked at once
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", VARIABLE)).otherwise(plain)


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, h, line_no, n, leaf, plain) of every line, those of fewer than ``MIN_TOKENS`` tokens too; (id, h) names a document."""
    source = docs.select(column(id_column).alias("id"), F.xxhash64(column(text_column)).alias("h"), column(text_column).alias("text"))
    lines = source.select("id", "h", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    cut = lines.select("id", "h", "line_no", single_blanks(F.col("line")).alias("plain"))
    n = F.octet_length("plain") - F.octet_length(F.replace("plain", F.lit(" "), F.lit(""))) + 1
    return cut.withColumn("n", n).select("id", "h", "line_no", "n", F.xxhash64("n", masked(F.substring_index("plain", " ", DEPTH))).alias("leaf"), "plain")


def blocks() -> Column:
    """Hashes of the blocks of a line (``n``, ``tokens``, ``leaf``) that hold no variable field.

    At most n * (100 - CONSTANT_PERCENT) / 100 places of a template are open; the places below the tree
    are cut into one block more, so one at least is constant throughout.
    """
    open_ = F.floor(F.col("n") * (100 - CONSTANT_PERCENT) / 100).cast("int")
    edge = lambda b: (DEPTH + F.floor(b.cast("bigint") * (F.col("n") - DEPTH) / (open_ + 1))).cast("int")
    # token by token: a slice within a lambda would copy the whole line for each block

    def added(h: Column, i: Column) -> Column:
        token = F.get("tokens", i)
        return F.when(h.isNotNull() & (token != VARIABLE), F.xxhash64(h, token))

    hashes = F.transform(F.sequence(F.lit(0), open_), lambda b: F.aggregate(F.sequence(edge(b), edge(b + 1) - 1), F.xxhash64("leaf", b), added))
    return F.filter(hashes, lambda h: h.isNotNull())


def candidates(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, h, line_no, n, masked, leaf) of all lines of the leaves that can have a template.

    These are the leaves of which a block occurs in ``MIN_DOCS`` lines. Leaves with fewer lines are left
    out before, where the others are measured to fit a broadcast.
    """
    rows = _rows(docs, id_column, text_column)
    # a leaf's lines have one number of tokens; asked after the aggregate and by the joins, it's worked out once a line
    shared = rows.groupBy("leaf").agg(F.count("*").alias("n_lines"), F.first("n").alias("n"))
    shared = pin(shared.where((F.col("n_lines") >= MIN_DOCS) & (F.col("n") >= MIN_TOKENS)).select("leaf"))
    small = fits_broadcast(shared, BROADCAST_BYTES)
    met = rows.join(F.broadcast(shared), "leaf", "left_semi") if small else rows.where(F.col("n") >= MIN_TOKENS)
    cut = met.select("leaf", "n", F.split(masked(F.col("plain")), " ").alias("tokens"))
    counts = cut.select("leaf", F.explode(blocks()).alias("block")).groupBy("block").agg(F.count("*").alias("n_lines"), F.first("leaf").alias("leaf"))
    leaves = pin(counts.where(F.col("n_lines") >= MIN_DOCS).select("leaf").distinct())
    right = F.broadcast(leaves) if fits_broadcast(leaves, BROADCAST_BYTES) else leaves
    met = rows.join(right, "leaf", "left_semi")
    return met.select("id", "h", "line_no", "n", masked(F.col("plain")).alias("masked"), "leaf")


def boilerplate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, h, line_no) of the lines to drop."""
    named = candidates(docs, id_column, text_column)
    # two hashes stand for a line from here on; its text is carried once
    lines = pin(named.withColumns({"m1": F.xxhash64("leaf", "masked"), "m2": F.xxhash64("masked", F.lit(1))}))

    # distinct lines of each leaf with the documents that have them
    docs_of = lines.select("m1", "m2", "id", "h").distinct().groupBy("m1", "m2").agg(F.count("*").alias("docs"))
    texts = lines.groupBy("m1", "m2").agg(F.first(F.struct("leaf", "n", "masked")).alias("x"))
    distinct = pin(texts.join(docs_of, ["m1", "m2"]).select("m1", "m2", "x.*", "docs"))
    # the leading tokens are constant by the tree; the others where enough documents agree
    placed = distinct.select("leaf", "docs", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    constant = placed.where((F.col("at") >= DEPTH) & (F.col("token") != VARIABLE)).groupBy("leaf", "at", "token").agg(F.sum("docs").alias("docs"))
    constant = constant.where(F.col("docs") >= MIN_DOCS).select("leaf", "at", "token")
    # a line that enough documents have as it is settles its own tokens; the others look theirs up
    common, rare = distinct.where(F.col("docs") >= MIN_DOCS), distinct.where(F.col("docs") < MIN_DOCS)
    spread = rare.select("m1", "m2", "leaf", F.posexplode(F.split("masked", " ")).alias("at", "token")).where(F.col("at") >= DEPTH)
    met = spread.join(constant.withColumn("constant", F.lit(True)), ["leaf", "at", "token"], "left")
    part = F.struct("at", F.when(F.col("constant"), F.col("token")).otherwise(VARIABLE).alias("token"))
    met = met.groupBy("m1", "m2").agg(F.count("constant").alias("deep"), F.sort_array(F.collect_list(part)).alias("parts")).where(F.col("deep") > 0)
    lead = F.slice(F.split("masked", " "), 1, DEPTH)
    fixed = lambda tokens: F.size(F.filter(tokens, lambda t: t != VARIABLE))
    template = F.array_join(F.concat(lead, F.transform("parts", lambda x: x["token"])), " ")
    narrow = ["m1", "m2", "n", "leaf"]
    named = common.select(*narrow, F.col("masked").alias("template"), fixed(lead).alias("lead"), fixed(F.split("masked", " ")).alias("all"))
    kept = named.select(*narrow, "template", "lead", (F.col("all") - F.col("lead")).alias("deep")).where(F.col("deep") > 0)
    kept = kept.unionAll(rare.join(met, ["m1", "m2"]).select(*narrow, template.alias("template"), fixed(lead).alias("lead"), F.col("deep").cast("int")))
    # only whole candidates go on: enough constant places, fields of the tree included
    templates = kept.where((F.col("deep") + F.col("lead")) * 100 >= F.col("n") * CONSTANT_PERCENT)
    templates = templates.select("m1", "m2", F.xxhash64("leaf", "template").alias("t1"), F.xxhash64("template", F.lit(1)).alias("t2"))

    # lines of recurring templates, and the first of each
    found = pin(lines.select("m1", "m2", "id", "h", "line_no").join(templates, ["m1", "m2"]).drop("m1", "m2"))
    counts = found.select("t1", "t2", "id", "h").distinct().groupBy("t1", "t2").agg(F.count("*").alias("n_docs"))
    firsts = found.groupBy("t1", "t2").agg(F.min(F.struct("id", "h", "line_no")).alias("first"))
    recurring = pin(counts.where(F.col("n_docs") >= MIN_DOCS).join(firsts, ["t1", "t2"]).select("t1", "t2", "first"))
    right = F.broadcast(recurring) if fits_broadcast(recurring, BROADCAST_BYTES) else recurring
    drops = found.join(right, ["t1", "t2"]).where(~F.struct("id", "h", "line_no").eqNullSafe(F.col("first")))
    return drops.select("id", "h", "line_no")


def without_boilerplate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the recurring lines gone from its texts, and n_lines and n_dropped.

    Null texts stay null with no lines. Lines of fewer than ``MIN_TOKENS`` tokens stay. Rows that
    repeat both id and text count as one document and get the same answer. Columns of ``docs`` named
    n_lines or n_dropped are replaced. An empty table gives an empty result.
    """
    own = docs.select(*[column(c) for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")])
    drops = boilerplate(own, id_column, text_column).groupBy("id", "h").agg(F.collect_set("line_no").alias("__drops"))
    drops = pin(drops.select(F.col("id").alias("__id"), F.col("h").alias("__h"), "__drops"))
    if fits_broadcast(drops, BROADCAST_BYTES):  # beyond that the texts are shuffled once
        drops = F.broadcast(drops)
    mark = fresh(own, "__text_hash")
    marked = own.withColumn(mark, F.xxhash64(column(text_column)))
    joined = marked.join(drops, column(id_column).eqNullSafe(F.col("__id")) & (F.col(mark) == F.col("__h")), "left")
    lines = fresh(joined, "__lines")
    cut = joined.withColumn(lines, F.split(column(text_column), "\n"))  # a column: within the lambda the text would be cut for each line
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__drops"))
    text = F.when(F.col("__drops").isNull(), column(text_column)).otherwise(
        F.array_join(F.transform(left, lambda i: F.element_at(F.col(lines), i + 1)), "\n"))
    n_lines = F.when(column(text_column).isNull(), 0).otherwise(F.size(lines))
    return cut.select(*[text.alias(c) if c == text_column else column(c) for c in own.columns], n_lines.alias("n_lines"),
                      F.coalesce(F.size("__drops"), F.lit(0)).alias("n_dropped"))


def line_dedup(spark, folder: str) -> DataFrame:
    """Query op3: every document with the md5 of what is left of its text."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return without_boilerplate(docs).select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("kept_md5"))


LINE_DEDUP_SQL = f"""
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS line_no
    FROM documents),
t AS (
    SELECT doc_id, line_no, line, list_transform(list_filter(string_split(line, ' '), lambda t: t <> ''),
        lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{VARIABLE}' ELSE t END) AS tokens FROM l),
r AS (
    SELECT doc_id, line_no, len(tokens) AS n, tokens, array_to_string(list_prepend(CAST(len(tokens) AS VARCHAR), tokens[1:{DEPTH}]), ' ') AS leaf
    FROM t WHERE len(tokens) >= {MIN_TOKENS}),
s AS (
    SELECT leaf FROM r GROUP BY leaf HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
d AS (
    SELECT leaf, tokens, count(DISTINCT doc_id) AS docs FROM r SEMI JOIN s USING (leaf) GROUP BY leaf, tokens),
p AS (
    SELECT leaf, tokens, docs, unnest(tokens) AS token, unnest(range(0, len(tokens))) AS place FROM d),
c AS (
    SELECT leaf, place, token FROM p WHERE place >= {DEPTH} AND token <> '{VARIABLE}' GROUP BY leaf, place, token HAVING sum(docs) >= {MIN_DOCS}),
m AS (
    SELECT p.leaf, p.tokens, list(CASE WHEN p.place < {DEPTH} OR c.token IS NOT NULL THEN p.token ELSE '{VARIABLE}' END ORDER BY p.place) AS template,
        count(CASE WHEN p.token <> '{VARIABLE}' AND (p.place < {DEPTH} OR c.token IS NOT NULL) THEN 1 END) AS constant,
        count(c.token) AS deep
    FROM p LEFT JOIN c ON p.leaf = c.leaf AND p.place = c.place AND p.token = c.token GROUP BY p.leaf, p.tokens),
f AS (
    SELECT r.doc_id, r.line_no, m.leaf, m.template FROM r JOIN m USING (leaf, tokens)
    WHERE m.constant * 100 >= len(m.tokens) * {CONSTANT_PERCENT} AND m.deep > 0),
k AS (
    SELECT leaf, template, min(doc_id * 100000000 + line_no) AS first FROM f GROUP BY leaf, template HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
x AS (
    SELECT doc_id, line_no FROM f JOIN k USING (leaf, template) WHERE doc_id * 100000000 + line_no <> first)
SELECT l.doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(x.line_no) AS INTEGER) AS n_dropped,
    md5(coalesce(string_agg(CASE WHEN x.line_no IS NULL THEN l.line END, chr(10) ORDER BY l.line_no), '')) AS kept_md5
FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.line_no = x.line_no GROUP BY l.doc_id
"""
