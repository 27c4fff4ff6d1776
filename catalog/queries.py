"""Every operator and question as a query over the shared tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amity import functions as fn
from amity import schemas, sinks, sources
from amity.operators import friendship, listings, people, ranking
from amity.plans import questions

from . import views
from .shared import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime.date(2024, 12, 31)
PLACE = "ring"
# Suppliers 1 and 2 as users of the graph.
USER_A = 5
USER_B = 9


# --- sources -------------------------------------------------------------


def _exported(spark: SparkSession, lines: DataFrame, name: str) -> str:
    path = fresh_path(spark, name)
    sinks.write_lines(lines, path)
    return path


def src_text_lines(spark, sf_dir):
    path = _exported(spark, views.adjacency_lines(spark, sf_dir), "adjacency")
    return sources.read_lines(spark, path)


def src_adjacency_list(spark, sf_dir):
    path = _exported(spark, views.adjacency_lines(spark, sf_dir), "adjacency")
    return sources.read_adjacency(spark, path)


def src_profiles(spark, sf_dir):
    path = _exported(spark, views.profile_lines(spark, sf_dir), "profiles")
    return sources.read_profiles(spark, path)


def src_reviews(spark, sf_dir):
    path = _exported(spark, views.review_lines(spark, sf_dir), "reviews")
    return sources.read_reviews(spark, path)


def src_businesses(spark, sf_dir):
    path = _exported(spark, views.business_lines(spark, sf_dir), "businesses")
    return sources.read_businesses(spark, path)


# --- sinks ---------------------------------------------------------------


def sink_tab_text(spark, sf_dir):
    path = fresh_path(spark, "tab-text")
    sinks.write_tab_text(views.profiles(spark, sf_dir), path)
    return sources.read_lines(spark, path)


def sink_single_text(spark, sf_dir):
    path = fresh_path(spark, "single-text")
    sinks.write_tab_text(topk_max_age(spark, sf_dir), path, single_file=True)
    return sources.read_lines(spark, path)


def sink_csv_header(spark, sf_dir):
    path = fresh_path(spark, "csv-header")
    sinks.write_csv_header(q7_reviewers_in_place(spark, sf_dir), path)
    return spark.read.csv(path, header=True, schema="user_id bigint, stars string")


# --- projections and row generation --------------------------------------


def proj_rename(spark, sf_dir):
    rows = views.reviews(spark, sf_dir).toDF("_1", "_2", "_3", "_4")
    return sources.named(rows, schemas.REVIEWS)


def proj_select(spark, sf_dir):
    return views.reviews(spark, sf_dir).select("user_id", "stars")


def proj_explode_friends(spark, sf_dir):
    return friendship.explode_friends(views.friend_lists(spark, sf_dir))


def proj_canonical_pairs(spark, sf_dir):
    return friendship.friend_pairs(views.friend_arcs(spark, sf_dir))


def proj_profile_labels(spark, sf_dir):
    return views.profiles(spark, sf_dir).select(
        "user_id",
        fn.person_label(F.col("first_name"), F.col("dob")).alias("person"),
        fn.address_label(F.col("address"), F.col("city"), F.col("state")).alias("place"),
        fn.joined_text(
            "\t", F.col("first_name"), F.col("last_name"), F.col("address")
        ).alias("card"),
    )


# --- filters -------------------------------------------------------------


def filter_well_formed(spark, sf_dir):
    # Customers in debt list nobody; their lines have a single field.
    friends = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("string"))
    lines = views.table(spark, sf_dir, "customer").select(
        F.concat(
            F.col("c_custkey").cast("string"), F.lit("\t"), F.coalesce(friends, F.lit(""))
        ).alias("value")
    )
    fields = F.col("fields")
    return sources.well_formed(lines, "\t", 2).select(
        F.get(fields, 0).alias("user_text"), F.get(fields, 1).alias("friends_text")
    )


def filter_pair_set(spark, sf_dir):
    pairs = friendship.friend_pairs(views.friend_arcs(spark, sf_dir))
    return friendship.in_pair_set(pairs, views.asked_pairs(spark, sf_dir))


def filter_user_in(spark, sf_dir):
    edges = friendship.edges_of(views.friend_arcs(spark, sf_dir), [USER_A, USER_B])
    return edges.distinct()


def filter_contains(spark, sf_dir):
    return listings.businesses_in(views.businesses(spark, sf_dir), PLACE)


def having_count(spark, sf_dir):
    edges = friendship.edges_of(views.friend_arcs(spark, sf_dir), [USER_A, USER_B])
    return friendship.listed_by_all(friendship.friend_arrivals(edges), users=2)


# --- joins ---------------------------------------------------------------


def join_pair_adjacency(spark, sf_dir):
    _, rows = friendship.asked_friends(
        views.friend_arcs(spark, sf_dir), views.asked_pairs(spark, sf_dir)
    )
    return rows


def join_friend_profile(spark, sf_dir):
    return people.with_friend_profiles(
        views.friend_edges(spark, sf_dir), views.profiles(spark, sf_dir)
    )


def join_friend_age(spark, sf_dir):
    return people.with_friend_ages(
        views.friend_edges(spark, sf_dir), views.profiles(spark, sf_dir), AS_OF
    )


def join_user_address(spark, sf_dir):
    return people.with_addresses(
        topk_max_age(spark, sf_dir), views.profiles(spark, sf_dir)
    )


def join_pair_profiles(spark, sf_dir):
    return people.with_pair_profiles(
        q3_top_mutual_pairs(spark, sf_dir), views.profiles(spark, sf_dir)
    )


def join_after_topk(spark, sf_dir):
    return listings.with_listing(
        topk_avg_stars(spark, sf_dir), views.businesses(spark, sf_dir)
    )


# --- aggregations --------------------------------------------------------


def agg_mutual_list(spark, sf_dir):
    pairs = friendship.friend_pairs(views.friend_arcs(spark, sf_dir))
    rows = friendship.mutual_friend_rows(friendship.closed_pairs(pairs))
    return friendship.mutual_friend_lists(pairs, rows)


def agg_friend_arrivals(spark, sf_dir):
    return friendship.friend_arrivals(views.friend_arcs(spark, sf_dir))


def agg_bracket_list(spark, sf_dir):
    return people.bracket_list(
        people.friend_labels(
            having_count(spark, sf_dir), views.profiles(spark, sf_dir)
        )
    )


def agg_max_friend_age(spark, sf_dir):
    return people.oldest_friend_age(
        people.with_friend_ages(
            views.friend_arcs(spark, sf_dir), views.profiles(spark, sf_dir), AS_OF
        )
    )


def agg_avg_stars(spark, sf_dir):
    return listings.average_stars(views.reviews(spark, sf_dir))


# --- top-k ---------------------------------------------------------------


def topk_avg_stars(spark, sf_dir):
    return ranking.top_businesses(agg_avg_stars(spark, sf_dir))


def topk_max_age(spark, sf_dir):
    return ranking.top_users_by_age(agg_max_friend_age(spark, sf_dir))


# --- set operations ------------------------------------------------------


def set_array_intersect(spark, sf_dir):
    rows = friendship.common_friends(views.friend_edges(spark, sf_dir), views.asked_pairs(spark, sf_dir))
    ids = F.array_sort(F.collect_list("friend_id")).cast("array<string>")
    return rows.groupBy("a", "b").agg(F.array_join(ids, ", ").alias("common"))


# --- scalar functions ----------------------------------------------------


def fn_split(spark, sf_dir):
    fields = fn.split_fields(F.col("value"), "::")
    return views.review_lines(spark, sf_dir).select(
        *[F.get(fields, i).alias(c) for i, c in enumerate(schemas.REVIEWS.names)],
        fn.list_length(fields).alias("n_fields"),
    )


def fn_to_integer(spark, sf_dir):
    parts = fn.split_fields(F.col("c_name"), "#")
    return views.table(spark, sf_dir, "customer").select(
        "c_custkey",
        fn.to_integer(F.get(parts, 0)).alias("word"),
        fn.to_integer(F.get(parts, 1)).alias("number"),
    )


def fn_to_float(spark, sf_dir):
    return views.reviews(spark, sf_dir).select(
        "review_id", fn.to_float(F.col("stars")).alias("stars")
    )


def fn_least_greatest(spark, sf_dir):
    user, friend = F.col("user_id"), F.col("friend_id")
    return views.friend_arcs(spark, sf_dir).select(
        "user_id",
        "friend_id",
        fn.smaller_id(user, friend).alias("a"),
        fn.larger_id(user, friend).alias("b"),
    )


def fn_parse_dob(spark, sf_dir):
    return views.profiles(spark, sf_dir).select(
        "user_id", "dob", fn.parse_dob(F.col("dob")).alias("born")
    )


def fn_yyyymmdd(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.yyyymmdd(F.col("o_orderdate").cast("date")).alias("day"),
    )


def fn_age_years(spark, sf_dir):
    return views.profiles(spark, sf_dir).select(
        "user_id", fn.age_years(F.col("dob"), AS_OF).alias("age")
    )


def fn_concat(spark, sf_dir):
    return views.profiles(spark, sf_dir).select(
        "user_id",
        fn.joined_text(
            ", ",
            F.col("address"),
            F.col("city"),
            F.col("state"),
            fn.age_years(F.col("dob"), AS_OF),
        ).alias("line"),
    )


def fn_list_size(spark, sf_dir):
    return views.friend_lists(spark, sf_dir).select(
        "user_id", fn.list_length(F.col("friends")).alias("n")
    )


# --- the eight questions -------------------------------------------------


def q1_mutual_friend_list(spark, sf_dir):
    return questions.mutual_friends(
        views.friend_arcs(spark, sf_dir), views.asked_pairs(spark, sf_dir)
    )


def q2_mutual_friend_counts(spark, sf_dir):
    return questions.mutual_friend_counts(views.friend_arcs(spark, sf_dir))


def q3_top_mutual_pairs(spark, sf_dir):
    return questions.top_mutual_pairs(views.friend_arcs(spark, sf_dir))


def q4_top_pairs_profiles(spark, sf_dir):
    return questions.top_mutual_pairs_with_profiles(
        views.friend_arcs(spark, sf_dir), views.profiles(spark, sf_dir)
    )


def q5_mutual_friend_info(spark, sf_dir):
    return questions.mutual_friend_info(
        views.friend_arcs(spark, sf_dir), views.profiles(spark, sf_dir), USER_A, USER_B
    )


def q6_oldest_friend_top(spark, sf_dir):
    return questions.oldest_friend_top(
        views.friend_arcs(spark, sf_dir), views.profiles(spark, sf_dir), AS_OF
    )


def q7_reviewers_in_place(spark, sf_dir):
    return questions.reviewers_in_place(
        views.reviews(spark, sf_dir), views.businesses(spark, sf_dir), PLACE
    )


def q8_top_rated(spark, sf_dir):
    return questions.top_rated_businesses(
        views.reviews(spark, sf_dir), views.businesses(spark, sf_dir)
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        src_text_lines,
        src_adjacency_list,
        src_profiles,
        src_reviews,
        src_businesses,
        sink_tab_text,
        sink_single_text,
        sink_csv_header,
        proj_rename,
        proj_select,
        proj_explode_friends,
        proj_canonical_pairs,
        proj_profile_labels,
        filter_well_formed,
        filter_pair_set,
        filter_user_in,
        filter_contains,
        having_count,
        join_pair_adjacency,
        join_friend_profile,
        join_friend_age,
        join_user_address,
        join_pair_profiles,
        join_after_topk,
        agg_mutual_list,
        agg_friend_arrivals,
        agg_bracket_list,
        agg_max_friend_age,
        agg_avg_stars,
        topk_avg_stars,
        topk_max_age,
        set_array_intersect,
        fn_split,
        fn_to_integer,
        fn_to_float,
        fn_least_greatest,
        fn_parse_dob,
        fn_yyyymmdd,
        fn_age_years,
        fn_concat,
        fn_list_size,
        q1_mutual_friend_list,
        q2_mutual_friend_counts,
        q3_top_mutual_pairs,
        q4_top_pairs_profiles,
        q5_mutual_friend_info,
        q6_oldest_friend_top,
        q7_reviewers_in_place,
        q8_top_rated,
    )
}
