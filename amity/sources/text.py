"""Line-oriented sources.

Each `parse_*` takes a DataFrame with one text column `value`, so the same
parsing serves files, directories of files and lines that come from elsewhere.
All of them are narrow: a scan followed by projections and filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import split_fields, to_integer
from ..operators.friendship import distinct_edges


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of a file or of all files of a directory, as column `value`."""
    return spark.read.text(path)


def well_formed(lines: DataFrame, separator: str, width: int) -> DataFrame:
    """Lines with exactly `width` fields, split into the array column `fields`.

    Separators at the end of a line open no field, as in the tab and comma
    formats read here.
    """
    trimmed = F.rtrim(F.col("value"), F.lit(separator))
    return lines.select(split_fields(trimmed, separator).alias("fields")).where(
        F.size("fields") == width
    )


def named(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with positional column names under the names of the schema."""
    return rows.toDF(*schema.names)


def parse_adjacency(lines: DataFrame, distinct: bool = True) -> DataFrame:
    """`user <TAB> friend,friend,...` lines as (user_id, friend_id) rows.

    Lines without a friend list, ids that are no numbers and users listing
    themselves are dropped. `distinct=False` leaves repeated friendships in and
    saves a shuffle; the graph operators accept such edges.
    """
    fields = F.col("fields")
    edges = (
        well_formed(lines, "\t", 2)
        .select(
            to_integer(F.get(fields, 0)).alias("user_id"),
            F.explode(split_fields(F.get(fields, 1), ",")).alias("friend"),
        )
        .select("user_id", to_integer(F.col("friend")).alias("friend_id"))
        .where(F.col("user_id") != F.col("friend_id"))
    )
    return distinct_edges(edges) if distinct else edges


def read_adjacency(
    spark: SparkSession, path: str | list[str], distinct: bool = True
) -> DataFrame:
    return parse_adjacency(read_lines(spark, path), distinct)


def parse_profiles(lines: DataFrame) -> DataFrame:
    """Comma-separated profile lines of exactly ten fields, without quoting."""
    return (
        well_formed(lines, ",", len(schemas.PROFILES))
        .select(*_typed(F.col("fields"), schemas.PROFILES))
        .where(F.col("user_id").isNotNull())
    )


def read_profiles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_profiles(read_lines(spark, path))


def parse_reviews(lines: DataFrame) -> DataFrame:
    """`review::user::business::stars` lines; short ones are padded with NULL."""
    return _double_colon(lines, schemas.REVIEWS, ["user_id", "business_id"])


def read_reviews(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_reviews(read_lines(spark, path))


def parse_businesses(lines: DataFrame) -> DataFrame:
    """`business::address::categories` lines; short ones are padded with NULL."""
    return _double_colon(lines, schemas.BUSINESSES, ["business_id"])


def read_businesses(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_businesses(read_lines(spark, path))


def _double_colon(
    lines: DataFrame, schema: T.StructType, keys: list[str]
) -> DataFrame:
    rows = lines.where(F.col("value") != "").select(
        split_fields(F.col("value"), "::").alias("fields")
    )
    parsed = rows.select(*_typed(F.col("fields"), schema))
    return parsed.dropna(subset=keys)


def _typed(fields: Column, schema: T.StructType) -> list[Column]:
    """The positional fields under the names and types of the schema."""
    return [
        F.get(fields, i).try_cast(field.dataType).alias(field.name)
        for i, field in enumerate(schema)
    ]
