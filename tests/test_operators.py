import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecart.operators import attach, dedup, groups, profile, reports, schema
from tidecart.operators.outliers import OutlierTreatment
from tidecart.operators.quantiles import exact_quantiles


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---- quantiles ----------------------------------------------------------------------------------

@pytest.mark.parametrize("gather", [200_000, 50])
def test_exact_quantiles_match_pandas(spark, gather):
    rng = np.random.default_rng(3)
    n = 20_000
    pdf = pd.DataFrame({
        "smooth": rng.normal(size=n),
        "ties": np.where(rng.random(n) < 0.4, 0.0, rng.integers(0, 7, n)).astype(float),
        "money": np.round(rng.exponential(50, n), 2),
        "same": np.full(n, 4.0),
    })
    pdf.loc[rng.random(n) < 0.1, "smooth"] = np.nan
    probs = [0.0, 0.01, 0.25, 0.333, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf).repartition(7), {c: probs for c in pdf}, gather=gather)
    for c in pdf:
        np.testing.assert_allclose([got[c][p] for p in probs], pdf[c].quantile(probs).to_numpy(), rtol=1e-12)


def test_quantile_edges(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (10.0, None), (20.0, None)], "a double, b double")
    assert exact_quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": {0.5: 6.0}, "b": {0.5: None}}
    assert exact_quantiles(df, {}) == {}


# ---- attach -------------------------------------------------------------------------------------

@pytest.mark.parametrize("max_bytes", [10**9, 0])
def test_attach_small_and_split(spark, max_bytes):
    left = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 101 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"))
    table = left.groupBy("k").agg(F.count("*").alias("w"), F.max("id").alias("v")).where("k is null or k <> 'k4'")
    got = attach.attach(left, table, ["k"], "w", max_bytes).toPandas()
    want = left.toPandas().merge(table.toPandas()[["k", "v"]], on="k", how="left")
    assert got.shape == (3000, 3)
    pd.testing.assert_frame_equal(
        got.sort_values("id").reset_index(drop=True), want.sort_values("id").reset_index(drop=True), check_dtype=False)


# ---- dedup --------------------------------------------------------------------------------------

FEED = [("a", "2024-01-01", 1), ("a", "2024-01-02", 2), ("b", None, 3), ("b", "2024-05-01", 4),
        (None, "2024-01-01", 5), (None, "2024-01-03", 6), ("c", "2024-01-01", 7), ("c", "2024-01-01", 8)]


def test_keep_latest(spark):
    df = spark.createDataFrame(FEED, "us_item_id string, fetch_time string, n int")
    kept = dedup.keep_latest(df)
    assert {(r[0], r[2]) for r in kept.collect()} == {("a", 2), ("b", 3), (None, 6), ("c", 8)}
    assert dedup.keep_latest(kept).count() == 4
    assert dedup.keep_latest(df.drop("us_item_id")).count() == 8
    assert dedup.keep_latest(df.withColumnRenamed("us_item_id", "product_id")).count() == 4
    both = df.withColumn("product_id", F.lit("p"))
    assert dedup.keep_latest(both).count() == 4
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("WindowGroupLimit") == 2


def test_exact_copies(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert dedup.drop_exact_copies(df).count() == 2
    out, before, after = dedup.drop_exact_copies_counted(df)
    out.collect()
    assert before.get["rows"] - after.get["rows"] == 1


# ---- schema -------------------------------------------------------------------------------------

def test_names_and_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Num Of Reviews", " Prix (é) ", "x"])
    assert schema.normalize_names(df).columns == ["num_of_reviews", "prix_é", "x"]
    assert schema.normalize_names(schema.normalize_names(df)).columns == ["num_of_reviews", "prix_é", "x"]
    with pytest.raises(ValueError):
        schema.normalize_names(spark.createDataFrame([(1, 2)], ["a b", "A_B"]))
    assert schema.keep_columns(df, ["x", "absent", "Num Of Reviews"]).columns == ["Num Of Reviews", "x"]


def test_low_value_columns(spark):
    df = spark.range(200).select(
        F.col("id").cast("string").alias("Uniq Id"), F.col("id").alias("other_id"), F.lit("x").alias("constant"),
        F.when(F.col("id") < 8, F.col("id")).alias("mostly_null"),
        F.when(F.col("id") < 10, F.col("id")).alias("just_kept"),
        F.when(F.col("id") < 100, F.lit(1)).alias("one_value_and_null"),
        F.lit(None).cast("string").alias("empty"),
        (F.col("id") % 190).cast("string").alias("Pageurl"))
    found = schema.LowValueColumns().fit(df)
    assert found.reasons == {
        "Uniq Id": "identifier", "constant": "one value only", "mostly_null": "96.0% missing",
        "one_value_and_null": "one value only", "empty": "100.0% missing"}
    assert found.transform(df).columns == ["other_id", "just_kept", "Pageurl"]
    assert schema.LowValueColumns().fit(df.limit(0)).reasons == {}


# ---- groups -------------------------------------------------------------------------------------

def group_table(spark):
    data = []
    for g, n, holes in (("none", 10, 0), ("five", 20, 1), ("more", 19, 1), ("all", 5, 5), (None, 10, 3)):
        for i in range(n):
            data.append((g, None if i < holes else float(i), 1.0 if i != holes else None if g == "more" else 1.0, i))
    return spark.createDataFrame(data, "g string, a double, b double, i int")


@pytest.mark.parametrize("max_bytes", [10**9, 0])
def test_group_repair(spark, max_bytes):
    df = group_table(spark)
    step = groups.drop_incomplete_rows(df, "g", ["a", "b"], max_bytes=max_bytes)
    sizes = {r[0]: r[1] for r in step.groupBy("g").count().collect()}
    assert sizes == {"none": 10, "five": 19, "more": 19, None: 10}
    two_steps = groups.fill_with_group_mean(step, "g", ["a", "b"], max_bytes)
    one_step = groups.repair_groups(df, "g", ["a", "b"], max_bytes=max_bytes)
    assert sorted(map(str, two_steps.collect())) == sorted(map(str, one_step.collect()))
    more = {r["i"]: (r["a"], r["b"]) for r in one_step.where("g = 'more'").collect()}
    assert more[0][0] == pytest.approx(np.mean(range(1, 19))) and more[1][1] == 1.0
    assert one_step.where("g is null and a is null").count() == 3
    assert groups.drop_incomplete_rows(df, "absent", ["a"]) is df


def test_group_repair_broadcasts(spark):
    plan = groups.repair_groups(group_table(spark), "g", ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


# ---- outliers -----------------------------------------------------------------------------------

def test_outlier_regimes(spark):
    n = 1000
    share = {"few": 30, "some": 100, "edge": 150, "none": 0, "five": 50}
    pdf = pd.DataFrame({c: [float(i % 100) for i in range(n - k)] + [5000.0 + i for i in range(k)] for c, k in share.items()})
    pdf["text"] = "x"
    df = spark.createDataFrame(pdf)
    model = OutlierTreatment([*share, "text", "absent"]).fit(df)
    assert {c: r.action for c, r in model.rules.items()} == {
        "few": "winsorize", "some": "cap", "edge": "keep", "none": "none", "five": "cap"}
    out = model.transform(df).toPandas()
    assert out["few"].max() == pytest.approx(pdf["few"].quantile(0.99))
    q1, q3 = pdf["some"].quantile([0.25, 0.75])
    assert out["some"].max() == pytest.approx(q3 + 1.5 * (q3 - q1))
    assert out["edge"].max() == pdf["edge"].max()
    rough = OutlierTreatment(["some"], exact=False).fit(df)
    assert rough.rules["some"].action == "cap"


# ---- profile ------------------------------------------------------------------------------------

@pytest.fixture
def small(spark):
    data = [(1.0, "x", True), (2.0, "y", False), (10.0, "y", True), (20.0, None, True), (None, "z", True)]
    return spark.createDataFrame(data, "a double, b string, c boolean")


def test_counts(small):
    assert rows(profile.table_size(small)) == [(5, 3)]
    assert rows(profile.null_counts(small), "column") == [("a", 1), ("b", 1), ("c", 0)]
    assert rows(profile.null_shares(small), "column")[0] == ("a", 1, 20.0, 80.0)
    assert rows(profile.null_shares(small.limit(0)), "column")[0] == ("a", 0, None, None)
    assert rows(profile.distinct_counts(small), "column") == [("a", 4), ("b", 3), ("c", 2)]
    assert rows(profile.table_info(small), "column") == [("a", "double", 4), ("b", "string", 4), ("c", "boolean", 5)]
    assert rows(profile.missing_report(small)) == [("a", 1, 20.0), ("b", 1, 20.0)]
    assert profile.missing_report(small.select("c")).count() == 0


def test_describe(small):
    a, b, c = rows(profile.describe_all(small), "column")
    pdf = pd.Series([1.0, 2, 10, 20]).describe()
    assert a[:4] == ("a", 4, pdf["mean"], pytest.approx(pdf["std"]))
    d = {r["column"]: r for r in profile.describe_all(small).collect()}
    assert [d["a"][k] for k in ("min", "p25", "p50", "p75", "max")] == list(pdf[["min", "25%", "50%", "75%", "max"]])
    assert [d["b"][k] for k in ("count", "unique", "top", "freq", "mean")] == [4, 3, "y", 2, None]
    assert [d["c"][k] for k in ("count", "unique", "top", "freq")] == [5, 2, "true", 4]


def test_correlations(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(size=(200, 3)), columns=["a", "b", "c"])
    pdf["b"] += pdf["a"]
    pdf.loc[::7, "b"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("b", F.nanvl("b", F.lit(None)))
    want = pdf.corr()
    got = profile.correlations(df).collect()
    assert len(got) == 9
    for r in got:
        assert r["corr"] == pytest.approx(want.loc[r[0], r[1]])
    assert profile.most_correlated(df, "a", ["a", "b", "c"], 2) == ["a", "b"]


def test_column_documents(small):
    docs = {r["column"]: r.asDict() for r in profile.column_documents(small).collect()}
    assert docs["a"]["min"] == "1.0" and docs["a"]["mean"] == 8.25 and docs["a"]["sample_values"] is None
    assert docs["b"]["sample_values"] == ["x", "y", "z"] and docs["b"]["unique_count"] == 3
    assert docs["b"]["min"] is None and docs["c"]["null_pct"] == 0.0


# ---- reports ------------------------------------------------------------------------------------

def test_reports(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), ("b", 9.0), (None, 5.0), ("c", None)], "k string, v double")
    assert [tuple(r) for r in reports.value_counts(df, "k").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert [tuple(r) for r in reports.top_values(df, "k", 1).collect()] == [("a", 2)]
    assert [tuple(r) for r in reports.group_means(df, "k", "v", "m").collect()] == [("b", 9.0), ("a", 2.0), ("c", None)]
    assert [r[0] for r in reports.top_rows(df, ["k", "v"], "v", 2).collect()] == ["b", None]
    plan = reports.top_rows(df, ["k", "v"], "v", 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_histogram(spark):
    values = np.random.default_rng(5).gamma(2, size=500)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    want, edges = np.histogram(values, bins=20)
    got = reports.histogram(df, "v").collect()
    assert [r["count"] for r in got] == list(want)
    np.testing.assert_allclose([r["low"] for r in got], edges[:-1])
    single = reports.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v").collect()
    assert sum(r["count"] for r in single) == 2 and single[10]["count"] == 2 and single[0]["low"] == 2.5
    assert reports.histogram(df.where("v is null"), "v").count() == 0


# ---- kept tables --------------------------------------------------------------------------------

def test_pinned_tables(spark, tmp_path, monkeypatch):
    from tidecart import session

    df = spark.range(10).select(F.col("id"), F.lit("x").alias("odd name (1)"))
    monkeypatch.setattr(session, "shared_folder", lambda s: str(tmp_path))
    kept = session.pin(df)
    assert kept.columns == df.columns and kept.count() == 10
    assert list(tmp_path.glob("tidecart-*/*.parquet"))
    monkeypatch.setattr(session, "shared_folder", lambda s: None)
    cached = session.pin(df)
    assert cached.storageLevel.useDisk and cached.storageLevel.useMemory
    cached.unpersist()
