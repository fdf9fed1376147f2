"""Link tool calls and results, order them, validate arguments and write canonical JSON.

Calls and results are joined by their identifier. Calls wait for the calls they depend on: each round
gives a level to those whose dependencies all have one, so a level is the longest chain below a call
and (level, turn, call_id) is a topological order. Arguments are checked against the parameters of
their tool, and every call becomes one line of JSON with sorted keys and no blanks. All of it is joins,
aggregations and expressions; a conversation is never gathered into one row or task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart.operators.attach import fits_broadcast
from tidecart.session import pin

BROADCAST_BYTES = 16 * 1024 * 1024
KINDS = ("string", "integer", "number", "boolean", "array", "object")

#: calls: conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>
#: results: call_id string, content string, turn long
#: schemas: name string, parameter string, kind string, required boolean, allowed array<string>, at_most double


def _problem(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of every call that can be ordered; what waits for itself or for a missing call has none.

    One round per level: dependencies that have their level are struck out, and a call with none left
    gets the next one. Rounds stop when none is given. A round reads only edges that are left.
    """
    # structs compare their fields null-safely
    waits = F.array_distinct(F.coalesce("depends_on", F.array().cast("array<string>")))
    nodes = pin(calls.select(F.struct("conv_id", "call_id").alias("call"), waits.alias("waits")))
    edges = pin(nodes.select("call", F.explode("waits").alias("on")).select("call", F.struct(F.col("call.conv_id"), F.col("on").alias("call_id")).alias("on")).distinct())
    free = nodes.select("call").distinct().join(edges.select("call"), "call", "left_anti")
    last = pin(free.withColumn("level", F.lit(0)))
    found, level = last, 0
    while last.limit(1).count():
        level += 1
        met = last.select(F.col("call").alias("on"))
        left = pin(edges.join(met, "on", "left_anti").select("call", "on"))
        touched = edges.join(met, "on", "left_semi").select("call").distinct()
        last = pin(touched.join(left.select("call"), "call", "left_anti").withColumn("level", F.lit(level)))
        found, edges = found.unionAll(last), left
    return found.select("call.conv_id", "call.call_id", "level")


def kind_matches(value: Column, kind: Column) -> Column:
    """Whether a JSON value, as its raw text, is of a kind."""
    return (
        F.when(kind == "string", value.startswith('"'))
        .when(kind == "integer", value.rlike(r"^-?[0-9]+$"))
        .when(kind == "number", value.rlike(r"^-?[0-9]+([.][0-9]+)?([eE][+-]?[0-9]+)?$"))
        .when(kind == "boolean", value.isin("true", "false"))
        .when(kind == "array", value.startswith("["))
        .when(kind == "object", value.startswith("{"))
        .otherwise(F.lit(False)))


def raw_fields(arguments: Column) -> Column:
    """A JSON object as a map from keys to the raw canonical text of their values; null where the text is no object."""
    fields = F.try_variant_get(F.try_parse_json(arguments), "$", "map<string,variant>")
    return F.transform_values(fields, lambda _, v: F.to_json(v))


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with fields (name to raw JSON text) and problems, sorted; an empty list means valid.

    A call of an unknown tool, arguments that are no object, missing, unknown and ill-typed
    parameters, values that are not allowed and numbers or lengths above ``at_most`` are problems. The
    table of tools is one row per tool here: tools are what a prompt can list. It is broadcast where it
    is measured to fit.
    """
    tools = schemas.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("parameter", "kind", "required", "allowed", "at_most"))).alias("__params"))
    tools = F.broadcast(tools) if fits_broadcast(schemas, BROADCAST_BYTES) else tools
    own = [F.col(c) for c in calls.columns]
    read = calls.select(*own, raw_fields(F.col("arguments")).alias("fields")).join(tools, "name", "left").select(*own, "fields", "__params")

    def wrong(p: Column) -> Column:
        value = F.element_at("fields", p["parameter"])
        text = F.when(value.startswith('"'), F.try_variant_get(F.try_parse_json(value), "$", "string"))
        size = F.coalesce(F.length(text).cast("double"), value.try_cast("double"))
        return (
            F.when(value.isNull() | (value == "null"), F.when(p["required"], _problem("missing ", p["parameter"])))
            .when(~kind_matches(value, p["kind"]), _problem(p["parameter"], " is no ", p["kind"]))
            .when(p["allowed"].isNotNull() & ~F.coalesce(F.array_contains(p["allowed"], F.coalesce(text, value)), F.lit(False)),
                  _problem(p["parameter"], " is not allowed"))
            .when(size > p["at_most"], _problem(p["parameter"], " is above its limit")))

    known = F.transform("__params", lambda p: p["parameter"])
    unknown = F.transform(F.array_except(F.map_keys("fields"), known), lambda k: _problem("unknown ", k))
    found = F.concat(F.filter(F.transform("__params", wrong), lambda x: x.isNotNull()), unknown)
    problems = F.when(F.col("__params").isNull(), F.array(F.lit("unknown tool"))).when(
        F.col("fields").isNull(), F.array(F.lit("arguments are no object"))).otherwise(F.sort_array(found))
    return read.select(*own, "fields", problems.alias("problems"))


def canonical(row: dict[str, Column]) -> Column:
    """A JSON object with its keys in order and no blanks, from the raw JSON text of its values."""
    pieces = []
    for k in sorted(row):
        pieces += [F.lit(f'{"," if pieces else ""}"{k}":'), row[k]]
    return F.concat(F.lit("{"), *pieces, F.lit("}"))


def text_json(text: Column) -> Column:
    """A text as a JSON string, null as null."""
    return F.coalesce(F.to_json(F.array(text)).substr(F.lit(2), F.length(F.to_json(F.array(text))) - 2), F.lit("null"))


def fields_json(fields: Column) -> Column:
    """A map of raw JSON texts as an object with sorted keys."""
    inside = F.transform(F.array_sort(F.map_keys(fields)), lambda k: F.concat(text_json(k), F.lit(":"), F.element_at(fields, k)))
    return F.coalesce(F.concat(F.lit("{"), F.array_join(inside, ","), F.lit("}")), F.lit("null"))


def linked(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and result of it, and per result without a call.

    Columns: conv_id, turn, call_id, name, level, status, problems, record. ``status`` is linked, early
    (the result comes before its call), unanswered, orphan (a result without a call), or unordered (the
    call waits for itself or for one that is missing). ``record`` is the canonical JSON line. Calls that repeat an identifier
    within a conversation are rows of their own; a null identifier never links. Empty tables give
    empty results.
    """
    checked = validated(calls, schemas)
    numbered = levels(calls).select(F.col("conv_id").alias("__c"), F.col("call_id").alias("__i"), "level")
    same = checked["conv_id"].eqNullSafe(F.col("__c")) & checked["call_id"].eqNullSafe(F.col("__i"))
    ordered = checked.join(numbered, same, "left").withColumn("called", F.lit(True)).drop("__c", "__i")
    answers = results.select(F.col("conv_id").alias("__conv"), F.col("call_id").alias("__id"), F.col("turn").alias("result_turn"), "content")
    # identifiers are unique or nearly so: the join's keys spread, whatever a conversation holds
    both = ordered.join(answers.hint("shuffle_hash"), (F.col("conv_id") == F.col("__conv")) & (F.col("call_id") == F.col("__id")), "full")
    status = (
        F.when(F.col("called").isNull(), "orphan")
        .when(F.col("level").isNull(), "unordered").when(F.col("__id").isNull(), "unanswered")
        .when(F.col("result_turn") < F.col("turn"), "early").otherwise("linked"))
    rows = both.withColumn("status", status).withColumn("conv_id", F.coalesce("conv_id", "__conv")).withColumn(
        "call_id", F.coalesce("call_id", "__id")).withColumn("turn", F.coalesce("turn", "result_turn"))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    record = canonical({
        "arguments": fields_json(F.col("fields")), "call_id": text_json(F.col("call_id")), "conv_id": number("conv_id"), "level": number("level"),
        "name": text_json(F.col("name")), "problems": F.coalesce(F.to_json("problems"), F.lit("[]")), "result": text_json(F.col("content")),
        "status": text_json(F.col("status")), "turn": number("turn")})
    return rows.select("conv_id", "turn", "call_id", "name", "level", "status", F.coalesce("problems", F.array().cast("array<string>")).alias("problems"),
                       record.alias("record"))


def from_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results drawn from the turns of conversations, which hold no tool calls of their own.

    A user's turn calls a tool that its length chooses, with arguments from its text, some of them
    faulty; it waits for the call half as far into the conversation. The assistant's next turn is the result.
    """
    n = "length(text)"
    asked = "translate(text, '\n', ' ')"
    search = (f"to_json(struct(IF({n} % 11 = 0, null, {asked}) as query, IF({n} % 7 = 0, null, {n} % 30) as limit, "
              f"IF({n} % 7 = 0, 'many', null) as limit_, element_at(array('en', 'fr', 'xx'), {n} % 3 + 1) as lang))")
    lookup = f"to_json(struct(IF({n} % 2 = 0, turn, null) as key, IF({n} % 2 = 0, null, {asked}) as key_, IF({n} % 13 = 0, true, null) as extra))"
    plain = lambda e: f"regexp_replace({e}, '_\":', '\":')"  # noqa: E731  a second column gives a key its other kind
    half = "2 * (((turn - turn % 2) div 2) div 2) + turn % 2"
    calls = conversations.where("role = 'user'").selectExpr(
        "conv_id", "turn", "concat('c', turn) as call_id", f"CASE WHEN {n} % 5 < 3 THEN 'search' WHEN {n} % 5 = 3 THEN 'lookup' ELSE 'guess' END as name",
        f"CASE WHEN {n} % 17 = 0 THEN '[1]' WHEN {n} % 5 < 3 THEN {plain(search)} ELSE {plain(lookup)} END as arguments",
        f"IF(turn < 2, array(), array(concat('c', {half}))) as depends_on")
    results = conversations.where("role = 'assistant'").selectExpr("conv_id", "turn", "concat('c', turn - 1) as call_id", "text as content")
    return calls, results


TOOLS = [
    ("search", "query", "string", True, None, 60.0), ("search", "limit", "integer", True, None, 20.0),
    ("search", "lang", "string", False, ["de", "en", "es", "fr"], None), ("lookup", "key", "string", True, None, None),
]


def tools(spark) -> DataFrame:
    return spark.createDataFrame(TOOLS, "name string, parameter string, kind string, required boolean, allowed array<string>, at_most double")


def tool_call_linking(spark, folder: str) -> DataFrame:
    """Query op4: the calls drawn from all conversations, linked to their results, with the md5 of each record."""
    calls, results = from_turns(spark.read.parquet(f"{folder}/conversations.parquet"))
    found = linked(calls, results, tools(spark))
    return found.select("conv_id", "turn", "call_id", "name", "level", "status", F.array_join("problems", "; ").alias("problems"), F.md5("record").alias("record_md5"))


TOOL_CALL_SQL = """
WITH RECURSIVE u AS (
    SELECT conv_id, turn, 'c' || turn AS call_id, length(text) AS n, replace(text, chr(10), ' ') AS asked,
        2 * (((turn - turn % 2) // 2) // 2) + turn % 2 AS half FROM conversations WHERE role = 'user'),
lv(conv_id, turn, level) AS (
    SELECT conv_id, turn, 0 FROM u WHERE turn < 2
    UNION ALL SELECT u.conv_id, u.turn, lv.level + 1 FROM u JOIN lv ON u.conv_id = lv.conv_id AND u.half = lv.turn AND u.turn >= 2),
c AS (
    SELECT *, CASE WHEN n % 5 < 3 THEN 'search' WHEN n % 5 = 3 THEN 'lookup' ELSE 'guess' END AS name,
        CASE n % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' ELSE 'xx' END AS lang FROM u),
v AS (
    SELECT *,
        CASE WHEN n % 17 = 0 THEN NULL
            WHEN name = 'search' THEN '{"lang":"' || lang || '","limit":' || CASE WHEN n % 7 = 0 THEN '"many"' ELSE CAST(n % 30 AS VARCHAR) END
                || CASE WHEN n % 11 = 0 THEN '' ELSE ',"query":' || CAST(to_json(asked) AS VARCHAR) END || '}'
            ELSE '{' || CASE WHEN n % 13 = 0 THEN '"extra":true,' ELSE '' END || '"key":'
                || CASE WHEN n % 2 = 0 THEN CAST(turn AS VARCHAR) ELSE CAST(to_json(asked) AS VARCHAR) END || '}' END AS arguments,
        CASE WHEN name = 'guess' THEN ['unknown tool'] WHEN n % 17 = 0 THEN ['arguments are no object']
            WHEN name = 'search' THEN list_filter([CASE WHEN lang = 'xx' THEN 'lang is not allowed' END,
                CASE WHEN n % 7 = 0 THEN 'limit is no integer' WHEN n % 30 > 20 THEN 'limit is above its limit' END,
                CASE WHEN n % 11 = 0 THEN 'missing query' WHEN n > 60 THEN 'query is above its limit' END], lambda x: x IS NOT NULL)
            ELSE list_filter([CASE WHEN n % 2 = 0 THEN 'key is no string' END, CASE WHEN n % 13 = 0 THEN 'unknown extra' END], lambda x: x IS NOT NULL) END AS problems
    FROM c),
r AS (
    SELECT conv_id, turn, 'c' || (turn - 1) AS call_id, text FROM conversations WHERE role = 'assistant'),
j AS (
    SELECT coalesce(v.conv_id, r.conv_id) AS conv_id, coalesce(v.turn, r.turn) AS turn, coalesce(v.call_id, r.call_id) AS call_id, v.name, lv.level,
        CASE WHEN v.conv_id IS NULL THEN 'orphan' WHEN lv.level IS NULL THEN 'unordered' WHEN r.conv_id IS NULL THEN 'unanswered'
            WHEN r.turn < v.turn THEN 'early' ELSE 'linked' END AS status,
        coalesce(v.problems, []) AS problems, v.arguments, r.text
    FROM v LEFT JOIN lv ON v.conv_id = lv.conv_id AND v.turn = lv.turn FULL JOIN r ON v.conv_id = r.conv_id AND v.call_id = r.call_id)
SELECT conv_id, turn, call_id, name, level, status, array_to_string(problems, '; ') AS problems,
    md5('{"arguments":' || coalesce(arguments, 'null') || ',"call_id":"' || call_id || '","conv_id":' || conv_id || ',"level":' || coalesce(CAST(level AS VARCHAR), 'null')
        || ',"name":' || coalesce('"' || name || '"', 'null') || ',"problems":[' || array_to_string(list_transform(problems, lambda x: '"' || x || '"'), ',')
        || '],"result":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"status":"' || status || '","turn":' || turn || '}') AS record_md5
FROM j
"""
