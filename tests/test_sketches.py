from pyspark.sql import functions as F

from tidecart.operators import sketches


def test_runs_unite_to_what_one_pass_gives(spark):
    df = spark.range(40_000).select(F.col("id"), (F.col("id") % 900).alias("k"), F.when(F.col("id") % 3 > 0, F.sqrt("id")).alias("x"),
                                    F.lit(None).cast("double").alias("none"))
    old, new = df.where("id < 25000"), df.where("id >= 25000")
    counts = sketches.united_distinct(sketches.distinct_sketches(old), sketches.distinct_sketches(new))
    got = {r.column: r.n_unique for r in sketches.estimated_distinct(counts).collect()}
    want = {"id": 40_000, "k": 900, "x": 26_666, "none": 0}
    assert got.keys() == want.keys() and all(abs(got[c] - n) <= 0.05 * n for c, n in want.items())
    whole = sketches.united_quantiles(sketches.quantile_sketches(old), sketches.quantile_sketches(new))
    ranks = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = {(r.column, r.rank): r.value for r in sketches.estimated_quantiles(whole, ranks).collect()}
    for rank in ranks:
        assert abs(found["id", rank] / 40_000 - rank) < 0.02
        assert abs(found["x", rank] ** 2 / 40_000 - rank) < 0.02
        assert found["none", rank] is None
