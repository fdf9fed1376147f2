import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecart.plans import recipes

STARS = recipes.STAR_COLUMNS


@pytest.fixture(scope="module")
def raw(spark):
    """300 distinct marketing rows as text, with holes of 2, 15 and 40 %, and 20 exact copies."""
    rng = np.random.default_rng(1)
    n = 300
    price = np.round(rng.uniform(20, 300, n), 2)
    price[:2] = 9000.0
    cells = {
        "Uniq Id": [f"u{i}" for i in range(n)],
        "Pageurl": ["same" if i < 100 else f"p{i}" for i in range(n)],
        "Price": [f"${p:,.2f}" for p in price],
        "Monthly Price": [f"USD {i % 30}" for i in range(n)],
        "Num Of Reviews": [str(i % 40) for i in range(n)],
        "Average Rating": [str(round(1 + 4 * rng.random(), 1)) for _ in range(n)],
        "Number Of Ratings": [str(i % 50) for i in range(n)],
        **{s: [str((i * (k + 2)) % 9) for i in range(n)] for k, s in enumerate(STARS)},
        "Title": [f"  *phone\t{i}!" for i in range(n)],
        "Carrier": ["NA" if i % 2 else "-- x --" for i in range(n)],
        "Stock": ["TRUE" if i % 3 else "maybe" for i in range(n)],
        "Discontinued": ["f"] * n,
        "Crawl Timestamp": [f"2019-0{1 + i % 9}-10 23:30:00 -0500" if i % 10 else "junk" for i in range(n)],
    }
    pdf = pd.DataFrame(cells)
    for column, share in (("Price", 6), ("Average Rating", 9), ("Num Of Reviews", 45), ("Two Star", 45), ("Monthly Price", 120)):
        pdf.loc[rng.permutation(n)[:share], column] = "n/a"
    return spark.createDataFrame(pd.concat([pdf, pdf.head(20)]))


def sorted_rows(df):
    return df.toPandas().sort_values(["title", "five_star"]).reset_index(drop=True)


def test_marketing(spark, raw):
    model = recipes.MarketingRecipe()
    out = model.fit_transform(raw)
    got = sorted_rows(out)
    assert len(got) == 300
    assert model.imputer.strategies == {
        "Price": "knn", "Average Rating": "knn", "Num Of Reviews": "chained", "Two Star": "chained", "Monthly Price": "median"}
    assert {"uniq_id", "discontinued"}.isdisjoint(out.columns) and "pageurl" in out.columns
    assert [r["column"] for r in model.missing.collect()][:2] == ["Monthly Price", "Num Of Reviews"]
    numbers = [c for c in ("price", "monthly_price", "average_rating", "num_of_reviews", "two_star", "review_density",
                           "price_per_rating", "total_star_ratings")]
    assert got[numbers].notna().all().all()
    assert model.outliers.rules["Price"].action == "winsorize" and got["price"].max() < 9000
    assert set(got["carrier"]) == {"Unknown", "x"} and got["title"].str.fullmatch(r"phone \d+").all()
    # the day in the row's own offset is always the 10th, so that column carries nothing
    assert model.low_value.reasons["crawl_day"] == "one value only" and "crawl_month" in out.columns
    assert set(got["crawl_timestamp"].dropna().dt.day) == {11} and got["crawl_timestamp"].isna().sum() == 30
    assert got["has_reviews"].isin([0, 1]).all() and got["rating_quality"].notna().all()
    again = sorted_rows(model.transform(raw))
    pd.testing.assert_frame_equal(got, again, rtol=1e-9)


def test_marketing_new_rows(raw):
    model = recipes.MarketingRecipe().fit(raw)
    some = model.transform(raw.limit(5))
    assert some.columns == model.transform(raw).columns and some.count() == 5


def test_marketing_older(spark, raw):
    out = recipes.clean_marketing_older(raw)
    got = out.toPandas()
    assert len(got) == 320  # this variant keeps exact copies
    # "USD 5" is no number for the strict parser, so the column is empty and goes
    assert "monthly_price" not in out.columns and got["price"].notna().all()


def test_parsing_stays_in_the_jvm(raw):
    parsed = recipes.add_marketing_features(recipes.parse_marketing(raw))
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and plan.count("Exchange") == 0


def test_guards(spark):
    df = spark.createDataFrame([("5",)], ["Price"])
    out = recipes.clean_marketing(df.union(df.select(F.lit("700"))))
    assert sorted(out.columns) == ["price", "price_range"]
    empty = recipes.clean_marketing(df.limit(0))
    assert empty.count() == 0 and "price_range" in empty.columns


def test_recipe_lookup():
    assert recipes.recipe_for("cleaned_products_API") is recipes.clean_product_feed
    assert recipes.recipe_for("marketing_data") is recipes.clean_marketing
    assert recipes.recipe_for("Shop_customer_purchases") is recipes.clean_purchases
    assert recipes.recipe_for("shop_products") is recipes.clean_products
    with pytest.raises(KeyError):
        recipes.recipe_for("other")


def test_profile_tables(raw):
    tables = recipes.profile_tables(raw)
    assert set(tables) == {"size", "types", "describe", "nulls", "unique"}
    assert tables["unique"].where("column = 'Uniq Id'").first()["n_unique"] == 300


def test_explore_text_feed(spark):
    feed = spark.createDataFrame(
        [("a", "4.5", "10", "s", "q", "{'offer_price': 2.0}"), ("b", None, "9", "s", "q", "{'min_price': 4}"),
         ("c", "3.0", None, "t", None, None)],
        "title string, rating string, reviews string, seller_name string, query string, primary_offer string")
    found = recipes.explore_products(feed)
    assert [r["title"] for r in found["top_reviews"].collect()] == ["a", "b", "c"]
    assert [tuple(r) for r in found["mean_price_by_query"].collect()] == [("q", 3.0)]
    assert found["price_describe"].first()["count"] == 2
    assert sum(r["count"] for r in found["rating_histogram"].collect()) == 2
    assert set(recipes.explore_products(feed.select("title"))) == {"info"}
