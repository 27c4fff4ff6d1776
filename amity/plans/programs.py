"""The eight questions from files to files.

Inputs are the text formats of `amity.sources`. Answers have a bounded number
of rows or grow with the input; only the bounded ones are written as one file.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas, sinks, sources
from ..functions import address_label, joined_text
from . import questions

# The pairs asked for if none are given.
PROBE_PAIRS = [(0, 1), (20, 28193), (1, 29826), (6222, 19272), (28041, 28056)]


def write_mutual_friends(
    spark: SparkSession,
    adjacency: str,
    output: str,
    pairs: DataFrame | list[tuple[int, int]] = PROBE_PAIRS,
) -> None:
    """Lines `a, b <TAB> c, d, ...`."""
    if isinstance(pairs, list):
        pairs = spark.createDataFrame(pairs, schemas.PAIRS)
    answer = questions.mutual_friends(_edges(spark, adjacency), pairs)
    line = joined_text("\t", _pair(), F.col("mutual_friends"))
    sinks.write_lines(answer.select(line), output)


def write_mutual_friend_counts(spark: SparkSession, adjacency: str, output: str) -> None:
    """Lines `('a, b', n)`."""
    answer = questions.mutual_friend_counts(_edges(spark, adjacency))
    line = F.format_string("('%d, %d', %d)", "a", "b", "n")
    sinks.write_lines(answer.select(line), output)


def write_top_mutual_pairs(
    spark: SparkSession, adjacency: str, output: str, k: int = 10
) -> None:
    """Lines `a, b <TAB> n`, best pair first."""
    answer = questions.top_mutual_pairs(_edges(spark, adjacency), k)
    line = joined_text("\t", _pair(), F.col("n"))
    sinks.write_lines(answer.select(line), output, single_file=True)


def write_top_mutual_pairs_with_profiles(
    spark: SparkSession, adjacency: str, profiles: str, output: str, k: int = 10
) -> None:
    """Lines of n and first name, last name and address of both, tab-separated."""
    answer = questions.top_mutual_pairs_with_profiles(
        _edges(spark, adjacency), sources.read_profiles(spark, profiles), k
    )
    sinks.write_tab_text(answer, output, single_file=True)


def write_mutual_friend_info(
    spark: SparkSession, adjacency: str, profiles: str, output: str, a: int, b: int
) -> None:
    """The line `a b <TAB> [first: dob, ...]`."""
    answer = questions.mutual_friend_info(
        _edges(spark, adjacency), sources.read_profiles(spark, profiles), a, b
    )
    users = joined_text(" ", F.col("user_a"), F.col("user_b"))
    line = joined_text("\t", users, F.col("friends"))
    sinks.write_lines(answer.select(line), output, single_file=True)


def write_oldest_friend_top(
    spark: SparkSession,
    adjacency: str,
    profiles: str,
    output: str,
    as_of: datetime.date | Column | None = None,
    k: int = 10,
) -> None:
    """Lines `user <TAB> address, city, state, age`; `null` for an unknown address."""
    answer = questions.oldest_friend_top(
        _edges(spark, adjacency), sources.read_profiles(spark, profiles), as_of, k
    )
    known = F.col("address").isNotNull()
    place = address_label(F.col("address"), F.col("city"), F.col("state"))
    line = joined_text(
        "\t",
        F.col("user_id"),
        joined_text(", ", F.when(known, place).otherwise("null"), F.col("max_age")),
    )
    sinks.write_lines(answer.select(line), output, single_file=True)


def write_reviewers_in_place(
    spark: SparkSession, reviews: str, businesses: str, output: str, place: str
) -> None:
    """CSV with header `user_id,stars`."""
    answer = questions.reviewers_in_place(
        sources.read_reviews(spark, reviews),
        sources.read_businesses(spark, businesses),
        place,
    )
    sinks.write_csv_header(answer, output)


def write_top_rated_businesses(
    spark: SparkSession, reviews: str, businesses: str, output: str, k: int = 10
) -> None:
    """CSV with header `business_id,full_address,categories,avg(stars)`."""
    answer = questions.top_rated_businesses(
        sources.read_reviews(spark, reviews),
        sources.read_businesses(spark, businesses),
        k,
    )
    sinks.write_csv_header(
        answer.withColumnRenamed("avg_stars", "avg(stars)"), output, single_file=True
    )


def _edges(spark: SparkSession, adjacency: str) -> DataFrame:
    # The questions accept repeated edges, so they need not be removed here.
    return sources.read_adjacency(spark, adjacency, distinct=False)


def _pair() -> Column:
    return joined_text(", ", F.col("a"), F.col("b"))
