"""Derived columns: buckets, sums, flags, ratios, clipping and offer prices."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket edges (right-closed) and their labels in ascending order.
PRICE_EDGES = [0.0, 50.0, 100.0, 200.0, 500.0, float("inf")]
PRICE_LABELS = ["Budget", "Mid", "Premium", "High-end", "Luxury"]
RATING_EDGES = [0.0, 2.0, 3.0, 4.0, 5.0]
RATING_LABELS = ["Poor", "Fair", "Good", "Excellent"]


def bucketize(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval that holds the value; null outside all of them."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one edge more than labels")
    inside = F.when(c <= F.lit(edges[0]), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        inside = inside.when(c <= F.lit(upper), F.lit(label))
    return inside


def bucket_rank(label: Column, labels: Sequence[str]) -> Column:
    """Position of a bucket label, for ordering by bucket: the first label is 0."""
    position = F.array_position(F.array(*map(F.lit, labels)), label)
    return F.when(position > 0, (position - 1).cast("int"))


def price_range(price: Column) -> Column:
    return bucketize(price, PRICE_EDGES, PRICE_LABELS)


def rating_quality(rating: Column) -> Column:
    return bucketize(rating, RATING_EDGES, RATING_LABELS)


def total_of(columns: Sequence[Column]) -> Column:
    """Sum that is null as soon as one part is null."""
    return reduce(lambda a, b: a + b, columns)


def positive_flag(c: Column) -> Column:
    """1 for a positive value, 0 otherwise; null counts as 0."""
    return F.coalesce((c > 0).cast("int"), F.lit(0))


def review_density(reviews: Column, ratings: Column) -> Column:
    return F.try_divide(reviews, ratings + F.lit(1.0))


def price_per_rating(price: Column, rating: Column) -> Column:
    return F.try_divide(price, rating + F.lit(0.1))


def clip(c: Column, low: Column, high: Column) -> Column:
    """Clamp into [low, high]; null stays null (greatest/least would skip it)."""
    return F.when(c < low, low).when(c > high, high).otherwise(c)


def offer_price(offer: Column) -> Column:
    """Price of an offer struct: the offer price unless missing or zero, else the lowest price."""
    return F.coalesce(F.nullif(offer["offer_price"], F.lit(0.0)), offer["min_price"])


def offer_price_from_text(c: Column) -> Column:
    """The same for an offer kept as a dict literal in text; unreadable text gives null.

    Bare None/True/False after ':', '[' or ',' become JSON words; single quotes are legal for
    Spark's JSON parser.
    """
    text = c
    for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
        text = F.regexp_replace(text, rf"([:\[,]\s*){word}\b", f"$1{json_word}")
    offer = F.from_json(text, "offer_price double, min_price double")
    return offer_price(offer)
