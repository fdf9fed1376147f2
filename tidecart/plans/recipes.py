"""Cleaning recipes per table and the reports on the product feed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.functions import dates, features, parsing
from tidecart.operators import dedup, groups, profile, reports, schema
from tidecart.operators.impute import SmartImputer
from tidecart.operators.outliers import OutlierTreatment
from tidecart.session import pin

# Column roles of the marketing table.
MARKETING_NUMBERS = [
    "Price", "Monthly Price", "Num Of Reviews", "Average Rating", "Number Of Ratings",
    "Five Star", "Four Star", "Three Star", "Two Star", "One Star",
]
MARKETING_TEXTS = [
    "Title", "Manufacturer", "Model Name", "Carrier", "Color Category", "Internal Memory",
    "Screen Size", "Specifications",
]
MARKETING_FLAGS = ["Stock", "Discontinued", "Broken Link"]
MARKETING_TIME = "Crawl Timestamp"
MARKETING_IMPUTED = [
    "Price", "Monthly Price", "Average Rating", "Num Of Reviews", "Number Of Ratings",
    "Five Star", "Four Star", "Three Star", "Two Star", "One Star",
]
MARKETING_OUTLIERS = ["Price", "Monthly Price", "Average Rating", "Num Of Reviews", "Number Of Ratings"]
STAR_COLUMNS = ["Five Star", "Four Star", "Three Star", "Two Star", "One Star"]

# Column roles of the product table.
PRODUCT_COLUMNS = [
    "product_id", "product_name", "brand", "final_price", "initial_price", "discount",
    "review_count", "rating", "category_name", "root_category_name", "available_for_delivery",
    "available_for_pickup",
]
PRODUCT_NUMBERS = ["final_price", "initial_price", "rating"]
PRODUCT_FLAGS = ["available_for_delivery", "available_for_pickup"]
PRODUCT_GROUP = "root_category_name"
PRODUCT_REPAIRED = ["initial_price", "discount"]

PURCHASE_DATE = "Purchase_Date"


def parse_marketing(df: DataFrame, strict_money: bool = False) -> DataFrame:
    """Typed columns from the all-string marketing table, without a shuffle.

    ``strict_money`` is the older script's parser, which also accepts free-form timestamps. The wall
    clock is a column of its own first, so that its four parts do not parse the text four times.
    """
    number = parsing.parse_money if strict_money else parsing.parse_number
    typed = {}
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c in MARKETING_NUMBERS:
            typed[c] = number(col)
        elif c in MARKETING_TEXTS:
            typed[c] = parsing.clean_text(col)
        elif c in MARKETING_FLAGS:
            typed[c] = parsing.parse_flag(col)
    if MARKETING_TIME in df.columns:
        col = F.col(f"`{MARKETING_TIME}`")
        wall = dates.any_wall_clock(col) if strict_money else dates.zoned_wall_clock(col)
        typed[MARKETING_TIME] = dates.parse_any_timestamp(col) if strict_money else dates.parse_zoned_timestamp(col)
        typed["__wall"] = wall
        return df.withColumns(typed).withColumns(dates.crawl_parts(F.col("__wall"))).drop("__wall")
    return df.withColumns(typed)


def add_marketing_features(df: DataFrame) -> DataFrame:
    """Each derived column whose inputs the table has."""
    def has(*columns: str) -> bool:
        return schema.has_columns(df, columns)

    def c(name: str):
        return F.col(f"`{name}`")

    new = {}
    if has(*STAR_COLUMNS):
        new["total_star_ratings"] = features.total_of([c(s) for s in STAR_COLUMNS])
    if has("Num Of Reviews"):
        new["has_reviews"] = features.positive_flag(c("Num Of Reviews"))
    if has("Price"):
        new["price_range"] = features.price_range(c("Price"))
    if has("Average Rating"):
        new["rating_quality"] = features.rating_quality(c("Average Rating"))
    if has("Num Of Reviews", "Number Of Ratings"):
        new["review_density"] = features.review_density(c("Num Of Reviews"), c("Number Of Ratings"))
    if has("Price", "Average Rating"):
        new["price_per_rating"] = features.price_per_rating(c("Price"), c("Average Rating"))
    return df.withColumns(new)


@dataclass
class MarketingRecipe:
    """Parse, impute, treat outliers, derive features, drop empty columns, rename.

    ``fit`` decides everything that depends on the data; ``transform`` replays the decisions.
    ``older=True`` is the standalone variant: no deduplication, strict money parsing, per-column
    imputation.
    """

    older: bool = False
    missing: DataFrame | None = field(default=None, repr=False)

    def parse(self, raw: DataFrame) -> DataFrame:
        rows = raw if self.older else dedup.drop_exact_copies(raw)
        return parse_marketing(rows, strict_money=self.older)

    def fit_transform(self, raw: DataFrame) -> DataFrame:
        parsed = pin(self.parse(raw))
        return self._fit(parsed)

    def fit(self, raw: DataFrame) -> MarketingRecipe:
        self.fit_transform(raw)
        return self

    def _fit(self, parsed: DataFrame) -> DataFrame:
        self.missing = profile.missing_report(parsed)
        self.imputer = SmartImputer(MARKETING_IMPUTED, per_column=self.older).fit(parsed)
        imputed = self.imputer.transform(parsed)
        if self.imputer.strategies:
            imputed = pin(imputed)
        self.outliers = OutlierTreatment(MARKETING_OUTLIERS).fit(imputed)
        featured = add_marketing_features(self.outliers.transform(imputed))
        self.low_value = schema.LowValueColumns().fit(featured)
        return schema.normalize_names(self.low_value.transform(featured))

    def transform(self, raw: DataFrame) -> DataFrame:
        parsed = self.parse(raw)
        treated = self.outliers.transform(self.imputer.transform(parsed))
        return schema.normalize_names(self.low_value.transform(add_marketing_features(treated)))


def clean_marketing(raw: DataFrame) -> DataFrame:
    return MarketingRecipe().fit_transform(raw)


def clean_marketing_older(raw: DataFrame) -> DataFrame:
    return MarketingRecipe(older=True).fit_transform(raw)


def clean_purchases(raw: DataFrame) -> DataFrame:
    """Exact dedup, then the purchase date and its calendar parts."""
    distinct = dedup.drop_exact_copies(raw)
    dated = distinct.withColumn(PURCHASE_DATE, dates.parse_short_date(F.col(PURCHASE_DATE)))
    return dated.withColumns(dates.purchase_parts(F.col(PURCHASE_DATE)))


def clean_products(raw: DataFrame, on_bad_discount: str = "fail") -> DataFrame:
    """Exact dedup over all columns, column choice, types, then repair by root category."""
    kept = schema.keep_columns(dedup.drop_exact_copies(raw), PRODUCT_COLUMNS)
    typed = {}
    for name, dtype in kept.dtypes:
        c = F.col(name)
        if dtype != "string":
            continue
        if name == "discount":
            typed[name] = parsing.parse_discount(c, on_bad_discount)
        elif name in PRODUCT_NUMBERS:
            typed[name] = c.try_cast("double")
        elif name == "review_count":
            typed[name] = c.try_cast("double").try_cast("bigint")
        elif name in PRODUCT_FLAGS:
            typed[name] = c.try_cast("boolean")
    products = pin(kept.withColumns(typed) if typed else kept)
    return groups.repair_groups(products, PRODUCT_GROUP, PRODUCT_REPAIRED)


def clean_product_feed(raw: DataFrame) -> DataFrame:
    """Exact dedup, then the latest record per item."""
    return dedup.keep_latest(dedup.drop_exact_copies(raw))


def latest_products(raw: DataFrame) -> DataFrame:
    """The search job's own cleaning step: latest record per item only."""
    return dedup.keep_latest(raw)


def profile_tables(df: DataFrame) -> dict[str, DataFrame]:
    """Size, types, describe, null counts and distinct counts of a table."""
    return {
        "size": profile.table_size(df),
        "types": profile.table_info(df),
        "describe": profile.describe_all(df),
        "nulls": profile.null_counts(df),
        "unique": profile.distinct_counts(df),
    }


def explore_products(df: DataFrame) -> dict[str, DataFrame]:
    """Reports on the cleaned product feed, each present if its columns are."""
    out = {"info": profile.table_info(df)}
    types = dict(df.dtypes)
    if "rating" in types:
        rated = df.withColumn("rating", F.col("rating").try_cast("double")) if types["rating"] == "string" else df
        out["rating_describe"] = profile.describe_numeric(rated, ["rating"])
        out["rating_histogram"] = reports.histogram(rated, "rating")
    if schema.has_columns(df, ["title", "reviews", "rating"]):
        by_number = df.withColumn("reviews", F.col("reviews").try_cast("double")) if types["reviews"] == "string" else df
        out["top_reviews"] = reports.top_rows(by_number, ["title", "reviews", "rating"], "reviews")
    if "query" in types:
        out["query_counts"] = reports.value_counts(df, "query")
    if "seller_name" in types:
        out["top_sellers"] = reports.top_values(df, "seller_name")
    if "primary_offer" in types:
        offer = F.col("primary_offer")
        price = features.offer_price_from_text(offer) if types["primary_offer"] == "string" else features.offer_price(offer)
        priced = df.withColumn("price", price)
        out["price_describe"] = profile.describe_numeric(priced, ["price"])
        if "query" in types:
            out["mean_price_by_query"] = reports.group_means(priced, "query", "price")
    return out


# Recipes by the last words of a table name; the first match counts.
RECIPES: list[tuple[tuple[str, ...], Callable[[DataFrame], DataFrame]]] = [
    (("products_api",), clean_product_feed),
    (("marketing_data",), clean_marketing),
    (("customers_purchases", "customer_purchases"), clean_purchases),
    (("products",), clean_products),
]


def recipe_for(table: str) -> Callable[[DataFrame], DataFrame]:
    """The recipe of a table, whatever the case of its name and the words before it."""
    name = table.lower()
    for endings, recipe in RECIPES:
        if name.endswith(endings):
            return recipe
    raise KeyError(f"no recipe for table {table!r}")
