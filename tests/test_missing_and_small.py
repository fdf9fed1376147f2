"""Small columns, NaN cells, hot groups and odd files: cases that round sizes and clean tables never meet."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecart.operators import groups, profile, reports
from tidecart.operators.attach import attach
from tidecart.operators.outliers import OutlierTreatment
from tidecart.operators.quantiles import exact_quantiles
from tidecart.sources import csv_files

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("gather", [5_000, 8])
@pytest.mark.parametrize("kind", ["smooth", "tied"])
def test_exact_quantiles_of_every_size(spark, gather, kind):
    sizes = [*range(1, 40), *range(40, 601, 37)]
    rows = []
    for r in range(max(sizes)):
        v = float(r * 7919 % 601) if kind == "smooth" else float(r * 7919 % 5)
        rows.append([v if r < n else (None if r % 2 else math.nan) for n in sizes])
    df = spark.createDataFrame(rows, ", ".join(f"c{n} double" for n in sizes)).coalesce(2)
    found = exact_quantiles(df, {f"c{n}": PROBS for n in sizes}, gather)
    for i, n in enumerate(sizes):
        values = [row[i] for row in rows[:n]]
        for p in PROBS:
            assert found[f"c{n}"][p] == pytest.approx(np.quantile(values, p), abs=1e-9), (n, p)


def test_outlier_fences_of_a_small_column(spark):
    rule = OutlierTreatment(["v"]).fit(spark.range(150).selectExpr("cast(id as double) as v")).rules["v"]
    assert (rule.low_fence, rule.high_fence) == (37.25 - 1.5 * 74.5, 111.75 + 1.5 * 74.5)


def test_nan_is_missing(spark):
    rows = [("a", 1.0), ("a", math.nan), ("a", 3.0), ("b", None), ("b", 100.0), (None, math.nan)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert {r["column"]: r.null_count for r in profile.null_counts(df).collect()} == {"g": 1, "v": 3}
    described = profile.describe_numeric(df, ["v"]).first()
    assert (described["count"], described["mean"], described["max"]) == (3, 104 / 3, 100.0)
    assert sum(r["count"] for r in reports.histogram(df, "v", 4).collect()) == 3
    filled = groups.fill_with_group_mean(df, "g", ["v"]).where("g = 'a'").collect()
    assert sorted(r.v for r in filled) == [1.0, 2.0, 3.0]
    many = df.unionAll(spark.range(100).selectExpr("'c'", "cast(id % 7 as double)"))
    treated = OutlierTreatment(["v"]).fit(many)
    assert treated.rules["v"].n_outliers == 1
    assert treated.transform(many).where("v is null").count() == 3


def parts(df):
    return df.rdd.glom().map(len).collect()


def test_hot_groups_never_meet_in_a_task(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # the null group holds half of the rows, one complete group most of the others
        df = spark.range(8000).selectExpr(
            "id", "case when id % 2 = 0 then null when id % 10 < 8 then 'hot' else concat('g', id % 50) end as g",
            "case when id % 10 = 9 and id % 3 = 0 then null else cast(id as double) end as v").repartition(8)
        for out in (groups.repair_groups(df, "g", ["v"], max_bytes=0), groups.fill_with_group_mean(df, "g", ["v"], max_bytes=0),
                    groups.drop_incomplete_rows(df, "g", ["v"], max_bytes=0), groups.with_group_mean(df, "g", "v", "m", max_bytes=0)):
            sizes = parts(out)
            assert max(sizes) <= 2 * 8000 / 8, sizes
        table = df.where("g is not null").groupBy("g").agg(F.count("*").alias("n"), F.avg("v").alias("m"))
        joined = attach(df, table, ["g"], "n", max_bytes=0)
        assert joined.where("g is null and m is not null").count() == 0 and joined.where("g = 'hot' and m is null").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_encodings_by_name_and_mark(spark, tmp_path):
    for name, encoding in (("a", "utf-8"), ("b", "cp1252"), ("c", "utf-16"), ("d", "utf-32")):
        (tmp_path / f"{name}.csv").write_bytes("k,v\n1,é €\n2,\"x\ny\"\n".encode(encoding))
    for name, spelling in (("a", "UTF-8"), ("a", "utf8"), ("b", "windows-1252"), ("c", "UTF_16"), ("d", "utf32"), ("a", None), ("b", None), ("c", None), ("d", None)):
        rows = csv_files.read_csv(spark, str(tmp_path / f"{name}.csv"), encoding=spelling).collect()
        assert sorted((r.k, r.v) for r in rows) == [("1", "é €"), ("2", "x\ny")], (name, spelling)
    with pytest.raises(ValueError, match="cannot read encoding"):
        csv_files.read_csv(spark, str(tmp_path / "a.csv"), encoding="klingon")
    found = {r.path[-5]: (r.encoding, r.multi_line) for r in csv_files.file_facts(spark, str(tmp_path)).collect()}
    assert {k: v[0] for k, v in found.items()} == {"a": "utf-8", "b": "cp1252", "c": "utf-16", "d": "utf-32"}
    assert found["a"][1] and found["b"][1]


def test_chained_equations_take_any_number_of_columns(spark):
    from tests.test_impute import brute_chained
    from tidecart.operators.chained import ChainedImputer

    rng = np.random.default_rng(4)
    base = rng.normal(size=(120, 3))
    full = base @ rng.normal(size=(3, 16)) + 0.1 * rng.normal(size=(120, 16))
    table = np.where(rng.random(full.shape) < 0.1, np.nan, full)
    names = [f"c{i}" for i in range(16)]
    df = spark.createDataFrame([(i, *[None if math.isnan(v) else float(v) for v in r]) for i, r in enumerate(table)],
                               "i int, " + ", ".join(f"{n} double" for n in names))
    model = ChainedImputer(names).fit(df)
    got = np.array([[r[n] for n in names] for r in model.transform(df).orderBy("i").collect()])
    want = brute_chained(table)
    want = want[0] if isinstance(want, tuple) else want
    assert np.allclose(got, want, atol=1e-6)


def test_pinned_tables_are_released(spark, tmp_path, monkeypatch):
    from tidecart import session
    from tidecart.operators.knn import KnnImputer

    rows = [(float(i), float(i % 7) if i % 9 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double")
    monkeypatch.setattr(session, "shared_folder", lambda spark: f"file://{tmp_path}")
    with session.pinned_tables():
        assert KnnImputer(["a", "b"]).fit(df).transform(df).where("b is null").count() == 0
        assert len(list(tmp_path.glob("tidecart-*"))) > 1
    assert list(tmp_path.iterdir()) == []
    monkeypatch.setattr(session, "shared_folder", lambda spark: None)
    with session.pinned_tables():
        kept = session.pin(df)
        assert kept.count() == 200 and kept.storageLevel.useMemory
    assert not kept.storageLevel.useMemory
