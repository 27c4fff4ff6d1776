"""Reviews and businesses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import to_float


def businesses_in(businesses: DataFrame, place: str) -> DataFrame:
    """Businesses whose address contains `place`, upper and lower case kept apart."""
    return businesses.where(F.col("full_address").contains(place))


def reviews_of(reviews: DataFrame, businesses: DataFrame) -> DataFrame:
    """Reviews of the given businesses, once per listing of the business."""
    return reviews.join(businesses.select("business_id"), "business_id")


def average_stars(reviews: DataFrame) -> DataFrame:
    """(business_id, avg_stars); stars that are no numbers do not count."""
    return (
        reviews.select("business_id", to_float(F.col("stars").cast("string")).alias("stars"))
        .groupBy("business_id")
        .agg(F.avg("stars").alias("avg_stars"))
    )


def with_listing(rated: DataFrame, businesses: DataFrame) -> DataFrame:
    """Rated businesses with address and categories; unlisted ones drop out."""
    listing = businesses.select("business_id", "full_address", "categories")
    return rated.join(listing, "business_id").select(
        "business_id", "full_address", "categories", "avg_stars"
    )
