import json

from tidecart.llm import chat_tools

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, turn long, call_id string, content string"


def tables(spark, calls, results):
    return spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), chat_tools.tools(spark)


def brute_levels(calls):
    waits = {}
    for conv, _, call, _, _, on in calls:
        waits.setdefault((conv, call), set()).update((conv, x) for x in on or [])
    level, n = {}, 0
    while ready := [k for k, v in waits.items() if k not in level and v <= level.keys()]:
        level.update(dict.fromkeys(ready, n))
        n += 1
    return level


def test_links_levels_and_records(spark):
    good = '{"query": "a \\"q\\" \\u00e9", "limit": 5, "lang": "en"}'
    calls = [
        (1, 0, "a", "search", good, None), (1, 2, "b", "search", good, ["a"]), (1, 4, "c", "lookup", '{"key":"k"}', ["a", "b", "b"]),
        (1, 6, "d", "lookup", '{"key":1,"more":[1, {"z":1,"a":null}]}', ["e"]), (1, 6, "e", "lookup", '{"key":"k"}', ["d"]),
        (1, 8, "f", "lookup", '{"key":"k"}', ["nowhere"]), (2, 0, "a", "guess", "{}", []), (2, 1, "b", "search", "[1]", []),
        (2, 2, "c", "search", "not json", ["a"]), (2, 3, "d", "search", None, ["c"]),
        (2, 4, "e", "search", '{"limit": 21, "lang": "xx"}', ["a", "d"]), (2, 5, "f", "search", '{"query":"' + "x" * 61 + '","limit":"5"}', []),
        (None, 0, "n", "lookup", '{"key":"k"}', None),
        (None, 1, "m", "lookup", '{"key":"k"}', ["n"]), (3, 0, None, "lookup", '{"key":null}', None),
    ]
    results = [(1, 1, "a", "one\n\"two\""), (1, 1, "b", "early"), (2, 9, "a", None), (2, 9, "zz", "orphan"), (3, 1, None, "no id"), (1, 3, "a", "again")]
    rows = chat_tools.linked(*tables(spark, calls, results)).collect()
    level = brute_levels(calls)
    by = {}
    for r in rows:
        by.setdefault((r.conv_id, r.call_id), []).append(r)
    for key, found in by.items():
        assert all(r.level == level.get(key) for r in found if r.status != "orphan"), key
    status = {k: sorted(r.status for r in v) for k, v in by.items()}
    assert status[1, "a"] == ["linked", "linked"] and status[1, "b"] == ["early"] and status[1, "c"] == ["unanswered"]
    assert status[1, "d"] == status[1, "e"] == status[1, "f"] == ["unordered"]
    assert status[2, "a"] == ["linked"] and status[2, "zz"] == ["orphan"] and status[3, None] == ["orphan", "unanswered"]
    assert status[None, "n"] == ["unanswered"]
    problems = {k: v[0].problems for k, v in by.items()}
    assert problems[1, "a"] == problems[1, "c"] == [] and problems[1, "d"] == ["key is no string", "unknown more"]
    assert problems[2, "a"] == ["unknown tool"]
    assert problems[2, "b"] == problems[2, "c"] == problems[2, "d"] == ["arguments are no object"]
    assert problems[2, "e"] == ["lang is not allowed", "limit is above its limit", "missing query"]
    assert problems[2, "f"] == ["limit is no integer", "query is above its limit"]
    for r in rows:
        data = json.loads(r.record)
        assert r.record == json.dumps(data, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert data["status"] == r.status and data["call_id"] == r.call_id
    assert json.loads(by[1, "a"][0].record)["arguments"] == json.loads(good)
    assert len(rows) == len(calls) + 1 + 2  # a second result, and the two orphans


def test_order_is_topological_in_a_hot_conversation(spark):
    calls = [(7, i, f"c{i}", "lookup", '{"key":"k"}', [f"c{i // 2}"] if i else None) for i in range(3000)]
    calls += [(8, 0, "c0", "lookup", None, ["c0"])]
    got = {(r.conv_id, r.call_id): r.level for r in chat_tools.levels(spark.createDataFrame(calls, CALLS)).collect()}
    assert got == brute_levels(calls)
    assert all(got[7, f"c{i}"] > got[7, f"c{i // 2}"] for i in range(1, 3000))


def test_empty_tables(spark):
    calls, results, schemas = tables(spark, [(1, 0, "a", "lookup", '{"key":"k"}', None)], [(1, 1, "a", "x" * 1_000_000)])
    assert chat_tools.linked(calls.limit(0), results.limit(0), schemas).count() == 0
    assert [r.status for r in chat_tools.linked(calls.limit(0), results, schemas).collect()] == ["orphan"]
    assert [r.status for r in chat_tools.linked(calls, results.limit(0), schemas).collect()] == ["unanswered"]
    assert [r.problems for r in chat_tools.linked(calls, results, schemas.limit(0)).collect()] == [["unknown tool"]]
