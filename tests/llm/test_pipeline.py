import random

import corpus_pipeline
from tidecart.llm import line_templates, repetition

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_hash string, component string"


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    body = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, body(rng.randint(80, 200)), "en", rng.choice(["web", "wiki", None])) for i in range(60)]
    base = rows[1][1].split()
    near = base[:40] + ["changed"] + base[41:]
    rows += [(100, rows[0][1], "en", "web"), (101, " ".join(near), None, "wiki")]            # a copy, a near copy
    rows += [(102, "too short", "en", "web"), (103, "again and again " * 60, "en", "web")]   # rejected by the rules
    rows += [(104 + i, f"{body(90)}\nprinted on page {i} of the old town archive\n{body(20)}", "en", "book") for i in range(5)]
    rows += [(200, None, None, None), (201, "", "en", "web"), (None, body(90), "en", "web"), (300, body(9000), "de", "book")]
    rows += [rows[5], rows[5]]                                                               # repeated rows
    return [(i, t, lang, source, None if t is None else len(t), "x", "y") for i, t, lang, source in rows]


def test_each_stage_works_on_what_its_predecessor_kept(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    columns = set(corpus_pipeline.COLUMNS)
    rows = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.between(spark, stage(spark, docs, "unused"))
        assert columns <= set(docs.columns)
        rows[name] = docs.collect()
    ids = {name: [r.doc_id for r in found] for name, found in rows.items()}
    judged = repetition.without_repetitive(spark.createDataFrame(corpus(), SCHEMA))
    assert sorted(map(str, ids["quality rules"])) == sorted(str(r.doc_id) for r in judged.collect())
    gone = {102, 103, 200, 201}
    assert not gone & set(ids["quality rules"])
    assert {r[0] for r in corpus()} - gone == set(ids["quality rules"]) == set(ids["line dedup"])
    printed = [r.text for r in rows["line dedup"] if "printed on page" in r.text]
    assert len(printed) == 1 and all(r.n_chars == len(r.text) for r in rows["line dedup"])
    kept = ids["SimHash near-dedup"]
    assert 0 in kept and not {100, 101} & set(kept) and kept.count(5) == 1
    assert set(kept) == set(ids["line dedup"]) - {100, 101} and None in kept
    assert set(ids["mixing sources to target weights"]) <= set(kept)
    name, pack = corpus_pipeline.STAGES[-1]
    pieces = pack(spark, docs, "unused").collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}
    held = {}
    for p in pieces:
        held.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in held.values():
        places.sort()
        assert sum(n for _, n in places) <= 1024
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
    assert max(p.piece for p in pieces if p.doc_id == 300) > 3 if 300 in {p.doc_id for p in pieces} else True


def test_every_stage_takes_a_row_of_nulls(spark):
    docs = spark.createDataFrame([(None,) * 7], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "unused").count() <= 1


def test_all_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.between(spark, stage(spark, docs, "unused"))
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "unused").count() == 0


def test_line_stage_drops_documents_of_boilerplate_only(spark):
    line = "all of this line is the same in each of these documents"
    docs = spark.createDataFrame([(i, line, "en", "web", len(line)) for i in range(4)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in corpus_pipeline.line_dedup(spark, docs, "unused").collect()] == [0]
    assert line_templates.without_boilerplate(docs).count() == 4


def test_python_workers_get_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for held, now in (("10000", "1000"), ("0", "1000"), ("500", "500")):
            spark.conf.set(name, held)
            corpus_pipeline.quality_rules(spark, spark.createDataFrame([(1, "a", "en", "x", 1)], corpus_pipeline.COLUMNS), "")
            assert spark.conf.get(name) == now
    finally:
        spark.conf.set(name, before)


def test_a_stage_leaves_its_rows_only(spark, tmp_path, monkeypatch):
    from tidecart import session

    spark.createDataFrame(corpus(), SCHEMA).select(*corpus_pipeline.COLUMNS).write.parquet(f"{tmp_path}/in/documents.parquet")
    for module in (session, corpus_pipeline):
        monkeypatch.setattr(module, "shared_folder", lambda s: f"file://{tmp_path}/shared")
    left, pack = [], lambda s, docs, d: left.append(sorted(p.name[:8] for p in (tmp_path / "shared").iterdir())) or docs
    monkeypatch.setattr(corpus_pipeline, "STAGES", [*corpus_pipeline.STAGES[:-1], ("pack", pack)])
    assert corpus_pipeline.run(spark, f"{tmp_path}/in").count() > 0
    assert left == [["pipeline"] * 4]


def test_python_workers_get_small_batches_where_nothing_is_set(spark):
    import pyarrow as pa

    from tidecart.session import small_batches

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    docs = spark.range(0, 4000, 1, 1).selectExpr("if(id < 2000, 'x', repeat('x', 5000)) as text")
    most = lambda: max(r.n for r in docs.mapInArrow(rows, "n long").collect())
    names = [f"spark.sql.execution.arrow.{n}" for n in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    for name in names:
        spark.conf.unset(name)
    try:
        assert most() == 4000
        small_batches(spark)
        assert most() == 1000 and int(spark.conf.get(names[1])) == 1 << 20
    finally:
        for name in names:
            spark.conf.unset(name)
