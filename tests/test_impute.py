import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecart.operators.chained import ChainedImputer
from tidecart.operators.impute import SmartImputer, fill_median, imputation_plan, strategy_for
from tidecart.operators.knn import KnnImputer


def to_spark(spark, pdf):
    df = spark.createDataFrame(pdf.reset_index().rename(columns={"index": "id"}))
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) for c in pdf})


def back(df, columns):
    return df.toPandas().sort_values("id")[columns].to_numpy(dtype=float)


def brute_knn(x, k):
    """Row by row, as plainly as the definition."""
    out = x.copy()
    width = x.shape[1]
    for i in range(len(x)):
        for t in np.flatnonzero(np.isnan(x[i])):
            near = []
            for j in range(len(x)):
                shared = ~np.isnan(x[i]) & ~np.isnan(x[j])
                if np.isnan(x[j, t]) or not shared.any():
                    continue
                gaps = x[i, shared] - x[j, shared]
                near.append((np.sqrt(width / shared.sum() * (gaps * gaps).sum()), x[j, t]))
            near = sorted(near)[:k]
            if not near:
                out[i, t] = np.nanmean(x[:, t])
                continue
            d, v = np.array(near).T
            if (d == 0).any():
                out[i, t] = v[d == 0].mean()
            else:
                out[i, t] = (v / d).sum() / (1 / d).sum()
    return out


def holes(pdf, share, seed):
    rng = np.random.default_rng(seed)
    out = pdf.copy()
    for c in out:
        out.loc[rng.random(len(out)) < share, c] = np.nan
    return out


@pytest.mark.parametrize("block_rows, single_round", [(2048, 1e9), (16, 1e9), (16, 0)])
@pytest.mark.parametrize("kind", ["smooth", "coarse"])
def test_knn_matches_brute_force(spark, block_rows, single_round, kind):
    rng = np.random.default_rng(11)
    if kind == "smooth":
        pdf = pd.DataFrame(rng.normal(size=(400, 4)) * [1, 5, 20, 1], columns=["a b", "c", "d", "e"])
    else:  # many equal rows, zero distances and ties
        pdf = pd.DataFrame(rng.integers(0, 4, size=(400, 4)).astype(float), columns=["a b", "c", "d", "e"])
    pdf = holes(pdf, 0.08, 1)
    pdf.iloc[0] = np.nan
    columns = list(pdf)
    df = to_spark(spark, pdf)
    model = KnnImputer(columns, block_rows=block_rows, single_round=single_round).fit(df)
    got = back(model.transform(df), columns)
    np.testing.assert_allclose(got, brute_knn(pdf.to_numpy(), 5), rtol=1e-9)


@pytest.mark.parametrize("block_rows", [2048, 16])
@pytest.mark.parametrize("width", [45, 70])
def test_knn_of_wide_tables_matches_brute_force(spark, block_rows, width):
    rng = np.random.default_rng(width)
    pdf = holes(pd.DataFrame(rng.normal(size=(60, width)), columns=[f"c{i}" for i in range(width)]), 0.02, 2)
    columns = list(pdf)
    df = to_spark(spark, pdf)
    got = back(KnnImputer(columns, block_rows=block_rows).fit(df).transform(df), columns)
    np.testing.assert_allclose(got, brute_knn(pdf.to_numpy(), 5), rtol=1e-9)


def test_knn_edges(spark):
    one = to_spark(spark, pd.DataFrame({"a": [1.0, 2.0, 6.0, np.nan]}))
    assert back(KnnImputer(["a"]).fit(one).transform(one), ["a"]).ravel().tolist() == [1, 2, 6, 3]
    few = to_spark(spark, pd.DataFrame({"a": [1.0, 2.0, np.nan], "b": [0.0, 4.0, 1.0]}))
    assert back(KnnImputer(["a", "b"]).fit(few).transform(few), ["a"])[2, 0] == pytest.approx((1 / 1 + 2 / 3) / (1 + 1 / 3))
    whole = to_spark(spark, pd.DataFrame({"a": [1.0, 2.0], "b": [0.0, 4.0]}))
    assert back(KnnImputer(["a", "b"]).fit(whole).transform(whole), ["a"]).ravel().tolist() == [1, 2]


def test_knn_new_rows_and_target_only(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(200, 3)), columns=list("abc"))
    old = holes(pdf, 0.05, 5)
    model = KnnImputer(list("abc"), targets=["b"]).fit(to_spark(spark, old))
    new = pd.DataFrame({"a": [0.1, np.nan], "b": [np.nan, 1.0], "c": [0.2, 0.3]})
    got = back(model.transform(to_spark(spark, new)), list("abc"))
    both = pd.concat([old, new.iloc[:1]]).to_numpy()
    assert got[0, 1] == pytest.approx(brute_knn(both, 5)[-1, 1])
    assert np.isnan(got[1, 0])


@pytest.mark.parametrize("max_bytes", [1 << 26, 0])
def test_knn_hot_vector(spark, max_bytes):
    base = pd.DataFrame({"a": [1.0] * 500 + list(range(100)), "b": [np.nan] * 500 + list(range(100)), "c": 2.0})
    df = to_spark(spark, base)
    model = KnnImputer(list("abc"), block_rows=16, single_round=0, max_bytes=max_bytes).fit(df)
    got = back(model.transform(df), list("abc"))
    np.testing.assert_allclose(got, brute_knn(base.to_numpy(), 5))


def test_knn_meets_few_donors_in_the_columns_both_have(spark):
    """Donors at one point of the shared columns are equally far: the work must not grow with their number."""
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"a": rng.normal(size=1500), "m": rng.integers(0, 4, 1500).astype(float)})
    pdf.loc[:20, "a"] = np.nan
    df = to_spark(spark, pdf)
    model = KnnImputer(["a", "m"], targets=["a"], block_rows=16).fit(df)
    np.testing.assert_allclose(back(model.transform(df), ["a", "m"]), brute_knn(pdf.to_numpy(), 5), rtol=1e-9)
    boxes = model.index.boxes
    assert sum(boxes["vectors"]) <= 4 * 5
    receivers = df.where("a is null").groupBy("a", "m").agg(F.count(F.lit(1)).alias("__w"))
    looked_at = model._candidates(receivers, 4, "home", model.index)
    assert looked_at.where(F.col("a").isNotNull()).count() == 0 and looked_at.count() <= 4 * 5


@pytest.mark.parametrize("max_views", [8, 1])
def test_knn_views_of_patterns_that_fit_has_not_seen(spark, monkeypatch, max_views):
    monkeypatch.setattr("tidecart.operators.knn._MAX_VIEWS", max_views)
    rng = np.random.default_rng(7)
    old = pd.DataFrame(rng.integers(0, 9, size=(300, 3)).astype(float), columns=list("abc"))
    old.loc[:30, "a"] = np.nan
    old.loc[20:50, "b"] = np.nan
    model = KnnImputer(list("abc"), targets=["a"], block_rows=16).fit(to_spark(spark, old))
    new = pd.DataFrame({"a": np.nan, "b": [np.nan, 2.0, 3.0], "c": [4.0, np.nan, 1.0]})
    got = back(model.transform(to_spark(spark, new)), ["a"]).ravel()
    for i in range(3):
        both = pd.concat([old, new.iloc[[i]]]).to_numpy()
        donors = np.vstack([both[:-1][~np.isnan(both[:-1, 0])], both[-1:]])
        assert got[i] == pytest.approx(brute_knn(donors, 5)[-1, 0])


def brute_chained(x, rounds=10, share=1e-3):
    """Sequential regressions on the filled table itself."""
    def ridge(a, y):
        n = len(y)
        am, ym = a.mean(0), y.mean()
        a, y = a - am, y - ym
        u, s, vt = np.linalg.svd(a, full_matrices=False)
        alpha, lam = 1 / (y.var() + np.finfo(float).eps), 1.0
        old = None
        def fit():
            w = vt.T @ (vt @ (a.T @ y) / (s**2 + lam / alpha))
            return w, ((y - a @ w) ** 2).sum()
        for _ in range(300):
            w, sse = fit()
            g = (alpha * s**2 / (lam + alpha * s**2)).sum()
            lam = (g + 2e-6) / ((w**2).sum() + 2e-6)
            alpha = (n - g + 2e-6) / (sse + 2e-6)
            if old is not None and np.abs(old - w).sum() < 1e-3:
                break
            old = w
        w, _ = fit()
        return w, ym - w @ am

    gaps = np.isnan(x)
    filled = np.where(gaps, np.nanmean(x, axis=0), x)
    if x.shape[1] == 1:
        return filled, 0
    for r in range(rounds):
        before = filled.copy()
        for j in np.argsort(gaps.mean(axis=0), kind="stable"):
            others = [i for i in range(x.shape[1]) if i != j]
            if not gaps[:, j].any():
                continue
            w, b = ridge(filled[~gaps[:, j]][:, others], filled[~gaps[:, j], j])
            filled[gaps[:, j], j] = filled[gaps[:, j]][:, others] @ w + b
        if np.abs(filled - before).sum(axis=1).max() < share * np.nanmax(np.abs(x)):
            break
    return filled, r + 1


@pytest.mark.parametrize("noise", [0.2, 2.0])
def test_chained_matches_sequential_rounds(spark, noise):
    rng = np.random.default_rng(4)
    a = rng.normal(size=500)
    pdf = pd.DataFrame({
        "a": a * 10 + 200, "b": a + noise * rng.normal(size=500), "c": 3 - 2 * a + noise * rng.normal(size=500),
        "d": rng.normal(size=500) * 1000})
    pdf = holes(pdf, 0.2, 9)
    pdf.loc[3] = np.nan
    columns = list(pdf)
    df = to_spark(spark, pdf)
    model = ChainedImputer(columns).fit(df)
    want, rounds = brute_chained(pdf.to_numpy())
    assert model.rounds_used == rounds
    np.testing.assert_allclose(back(model.transform(df), columns), want, rtol=1e-6)


def test_chained_over_rows_gives_the_same(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))
    pdf = holes(pd.DataFrame(base, columns=[f"c{i}" for i in range(12)]), 0.1, 3)
    df = to_spark(spark, pdf)
    want = back(ChainedImputer(list(pdf), rounds=2).fit(df).transform(df), list(pdf))
    model = ChainedImputer(list(pdf), rounds=2, pattern_bytes=0).fit(df)
    np.testing.assert_allclose(back(model.transform(df), list(pdf)), want, rtol=1e-6, atol=1e-8)


def test_chained_wide_table_with_scattered_holes(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(400, 3)) @ rng.normal(size=(3, 40))
    pdf = holes(pd.DataFrame(base, columns=[f"c{i}" for i in range(40)]), 0.1, 4)
    df = to_spark(spark, pdf)
    model = ChainedImputer(list(pdf), rounds=1, pattern_bytes=1_000_000).fit(df)
    got = back(model.transform(df), list(pdf))
    hole = pdf.isna().to_numpy()
    assert not np.isnan(got).any() and np.abs(got - base)[hole].mean() < 0.5 * np.abs(base)[hole].mean()


def test_chained_edges(spark):
    one = to_spark(spark, pd.DataFrame({"a": [1.0, 5.0, np.nan]}))
    assert back(ChainedImputer(["a"]).fit(one).transform(one), ["a"]).ravel().tolist() == [1, 5, 3]
    with pytest.raises(ValueError):
        ChainedImputer(["a"]).fit(one.where("a is null"))


def test_chained_reads_the_data_twice_only(spark):
    """Ten rounds over four columns must not turn into forty jobs."""
    rng = np.random.default_rng(4)
    df = to_spark(spark, holes(pd.DataFrame(rng.normal(size=(300, 4)), columns=list("abcd")), 0.2, 1))
    spark.sparkContext.setJobGroup("chained", "")
    ChainedImputer(list("abcd")).fit(df)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("chained")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 8


def test_strategy_borders():
    got = [strategy_for(p) for p in (None, 0, 0.001, 4.999, 5, 29.9, 30, 94.9, 95, 100)]
    assert got == ["none", "none", "knn", "knn", "chained", "chained", "median", "median", "none", "none"]


SHARES = {"full": 0, "k1": 4, "k2": 3, "m1": 20, "m2": 10, "med": 40, "gone": 96}


@pytest.fixture
def mixed(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({c: rng.normal(size=300) + i for i, c in enumerate(SHARES)})
    for i, (c, s) in enumerate(SHARES.items()):
        pdf.loc[rng.permutation(300)[: 3 * s], c] = np.nan
    return pdf, to_spark(spark, pdf)


def test_plan_table(mixed):
    plan = {r["column"]: r["strategy"] for r in imputation_plan(mixed[1], [*SHARES, "absent"]).collect()}
    assert plan == {"full": "none", "k1": "knn", "k2": "knn", "m1": "chained", "m2": "chained", "med": "median", "gone": "none"}


@pytest.mark.parametrize("per_column", [False, True])
def test_smart_imputer(mixed, per_column):
    pdf, df = mixed
    model = SmartImputer([*SHARES, "absent"], per_column).fit(df)
    out = model.transform(df)
    assert out.columns == df.columns
    got = pd.DataFrame(back(out, list(SHARES)), columns=list(SHARES))
    for c in SHARES:
        seen = pdf[c].notna()
        np.testing.assert_array_equal(got.loc[seen, c], pdf.loc[seen, c])
    assert got[["k1", "k2", "m1", "m2", "med"]].notna().all().all()
    assert got["gone"].isna().sum() == 288
    np.testing.assert_allclose(got.loc[pdf["med"].isna(), "med"], pdf["med"].median())
    if not per_column:
        np.testing.assert_allclose(got[["k1", "k2"]], brute_knn(pdf[["k1", "k2"]].to_numpy(), 5))
        np.testing.assert_allclose(got[["m1", "m2"]], brute_chained(pdf[["m1", "m2"]].to_numpy())[0], rtol=1e-6)
    else:
        eligible = ["k1", "k2", "m1", "m2", "med"]
        np.testing.assert_allclose(got[["m1", "m2"]], brute_chained(pdf[eligible].to_numpy())[0][:, 2:4], rtol=1e-6)
        np.testing.assert_allclose(got["k1"], brute_knn(pdf[eligible].to_numpy(), 5)[:, 0])


def test_single_column_per_column_uses_the_median(spark):
    df = to_spark(spark, pd.DataFrame({"a": [1.0] * 10 + [4.0] * 20 + [np.nan]}))
    assert back(SmartImputer(["a"], per_column=True).fit(df).transform(df), ["a"])[-1, 0] == 4.0


def test_same_result_whatever_the_partitions(mixed):
    _, df = mixed
    results = []
    for n in (1, 8):
        parts = df.repartition(n)
        results.append(back(SmartImputer(list(SHARES)).fit(parts).transform(parts), list(SHARES)))
    np.testing.assert_allclose(*results, rtol=1e-9)


def test_median_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert [r[0] for r in fill_median(df, ["a"]).collect()] == [0.0, 0.0]
