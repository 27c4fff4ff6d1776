"""What the physical plans must and must not contain."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from amity import sources
from amity.operators import friendship, people
from amity.plans import questions
from catalog import views
from catalog.queries import QUERIES

from graphs import edges, star_arcs

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]

def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan as adaptive execution left it, up to the outer initial plan."""
    df.collect()
    text = re.split(r"(?m)^\+- == Initial Plan ==", plan(df))[0]
    assert "Initial Plan" not in text  # no nested plans
    return text


@pytest.mark.parametrize(
    "name",
    [
        "q3_top_mutual_pairs",
        "q4_top_pairs_profiles",
        "q6_oldest_friend_top",
        "topk_avg_stars",
        "topk_max_age",
    ],
)
def test_top_k_keeps_k_rows_per_task(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR))


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["q7_reviewers_in_place"](spark, SF_DIR))
    assert "StringContains(p_name,ring)" in text
    assert sorted(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == [
        "l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_tax:double",
        "o_orderkey:bigint,o_custkey:bigint",
        "p_partkey:bigint,p_name:string,p_size:int",
    ]
    text = plan(QUERIES["agg_avg_stars"](spark, SF_DIR))
    assert "o_totalprice" not in text and "l_extendedprice" not in text


def test_partial_aggregation_before_shuffles(spark):
    assert "partial_avg" in plan(QUERIES["agg_avg_stars"](spark, SF_DIR))
    assert "partial_max" in plan(QUERIES["agg_max_friend_age"](spark, SF_DIR))
    assert "partial_bit_or" in plan(QUERIES["proj_canonical_pairs"](spark, SF_DIR))


def test_the_graph_is_shuffled_into_pairs_once(spark):
    df = questions.mutual_friend_counts(views.friend_arcs(spark, SF_DIR))
    text = final_plan(df)
    assert text.count("partial_bit_or") == 1
    assert "ReusedExchange" in text


def test_asked_pairs_are_met_before_their_friends(spark):
    df = questions.mutual_friends(views.friend_arcs(spark, SF_DIR), views.asked_pairs(spark, SF_DIR))
    text = final_plan(df)
    assert text.count("partial_bit_or") == 1
    # No list is intersected, and friends are looked up by a filter join.
    assert "array_intersect" not in text and "LeftSemi" in text


def test_later_friends_of_one_user_are_split(spark, no_broadcast, tmp_path):
    # Users 0 to 59 are friends of each other. Each also has many friends with
    # two friends only, who are ranked first: u is never crowded, v is sliced.
    path = str(tmp_path / "pairs")
    clique = spark.range(60).crossJoin(spark.range(60).toDF("b")).where("id < b").toDF("a", "b")
    spread = spark.range(4000).selectExpr("0 AS a", "id + 100 AS b")
    crowd = clique.union(spread).withColumn("listing", F.lit(3))
    crowd.repartition(20).write.parquet(path)
    pairs = spark.read.parquet(path)
    ranked = friendship.ranked_pairs(pairs)
    sliced = ranked.select("v", friendship._slice_of("u", "degree_v", 100).alias("slice"))
    assert sliced.groupBy("v", "slice").count().agg(F.max("count")).first()[0] < 200
    text = final_plan(friendship.closed_pairs(pairs, 100))
    # Both sides of the join on u stand on a shuffle of their own.
    join = next(x for x in text.splitlines() if re.search(r"Join.*\[~u#\d+L\], \[own", x))
    assert "Inner" in join
    assert re.search(r"Exchange hashpartitioning\(own#\d+L", text)


@pytest.mark.parametrize(
    "name",
    ["q4_top_pairs_profiles", "q6_oldest_friend_top", "join_user_address", "join_pair_profiles"],
)
def test_profiles_of_a_top_k_are_not_shuffled(spark, no_broadcast, name):
    df = QUERIES[name](spark, SF_DIR)
    lines = final_plan(df).splitlines()
    # The joins that look up cards have the broadcast top-k on one side.
    assert any("BroadcastHashJoin" in x and "LeftSemi" in x for x in lines)


def test_counts_join_their_pairs_without_a_shuffle(spark, no_broadcast):
    df = questions.mutual_friend_counts(edges(spark, star_arcs(50)))
    lines = final_plan(df).splitlines()
    top = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    below = []
    for line in lines[top + 1 :]:
        if "Exchange" in line:
            break
        below.append(line)
    assert any("HashAggregate" in line for line in below)


@pytest.fixture
def no_broadcast(spark):
    """Joins as on large tables, with skew handling at the size of test data."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_a_friend_of_everybody_is_split_in_profile_joins(spark, no_broadcast, tmp_path):
    # Written first, so that the join input is spread over map tasks.
    path = str(tmp_path / "edges")
    edges(spark, star_arcs(30_000)).repartition(20).write.parquet(path)
    arcs = spark.read.parquet(path)
    profiles = spark.range(30_002).selectExpr(
        "id AS user_id", "'x' AS first_name", "'01/01/1980' AS dob"
    )
    for joined in (
        people.with_friend_ages(arcs, profiles),
        people.with_friend_profiles(arcs, profiles),
    ):
        assert "skew=true" in final_plan(joined)
        assert joined.count() == arcs.count()


def test_a_business_of_most_reviews_is_split(spark, no_broadcast, tmp_path):
    path = str(tmp_path / "reviews")
    spark.range(60_000).selectExpr(
        "id AS user_id",
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS business_id",
        "'5' AS stars",
    ).repartition(20).write.parquet(path)
    reviews = spark.read.parquet(path)
    businesses = spark.range(60_000).selectExpr(
        "id AS business_id", "concat('Stanford ', id) AS full_address"
    )
    df = questions.reviewers_in_place(reviews, businesses, "Stanford")
    assert "skew=true" in final_plan(df)
    assert df.count() == 60_000


def test_crowded_users_and_pairs_are_split_in_filters(spark, no_broadcast, tmp_path):
    # User 0 holds a third of the rows on both sides.
    path = str(tmp_path / "edges")
    spark.range(90_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS user_id", "id + 1 AS friend_id"
    ).repartition(20).write.parquet(path)
    arcs = spark.read.parquet(path)
    own = friendship.lists_of(arcs, arcs)
    assert "skew=true" in final_plan(own)
    assert own.count() == arcs.count()

    rows = arcs.selectExpr(
        "user_id AS a", "IF(user_id = 0, 1, friend_id) AS b", "friend_id"
    )
    kept = friendship.in_pair_set(rows, rows)
    assert "skew=true" in final_plan(kept)
    assert kept.count() == rows.where("a < b").count() == rows.count()


def test_edges_are_not_sorted_to_meet_profiles(spark, no_broadcast):
    for name in ("agg_max_friend_age", "join_friend_age", "join_friend_profile"):
        text = final_plan(QUERIES[name](spark, SF_DIR))
        assert re.search(r"ShuffledHashJoin.*LeftOuter, BuildRight", text)


def test_lines_are_not_sorted_to_meet_orders(spark, no_broadcast):
    text = final_plan(QUERIES["agg_max_friend_age"](spark, SF_DIR))
    assert re.search(r"ShuffledHashJoin \[l_orderkey.*BuildRight", text)


def test_pairs_are_not_shuffled_to_be_ranked(spark, no_broadcast):
    pairs = friendship.friend_pairs(edges(spark, star_arcs(300)))
    text = final_plan(friendship.ranked_pairs(pairs))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 2


def test_texts_join_pairs_that_stay_where_they_are(spark, no_broadcast):
    text = final_plan(QUERIES["agg_mutual_list"](spark, SF_DIR))
    top = text[text.index("SortMergeJoin") :].split("Exchange")[0]
    assert "LeftOuter" in top and "HashAggregate" in top


def test_edges_of_asked_users_are_met_once(spark, no_broadcast):
    df = questions.mutual_friends(views.friend_arcs(spark, SF_DIR), views.asked_pairs(spark, SF_DIR))
    # Two shuffles by user, of all edges and of those kept, whoever reads them.
    lines = [x for x in final_plan(df).splitlines() if "ReusedExchange" not in x]
    assert len([x for x in lines if "Exchange hashpartitioning(~user_id" in x]) <= 2


def test_adjacency_is_made_distinct_by_pair(spark):
    lines = spark.createDataFrame([("1\t2,3",), ("2\t1",)], "value string")
    assert "partial_bit_or" in plan(sources.parse_adjacency(lines))


def test_library_runs_no_actions():
    words = r"\.(collect|toPandas|rdd|localCheckpoint|count|first|take|cache|persist)\b\(?"
    for path in (ROOT / "amity").rglob("*.py"):
        if "llm" in path.parts:  # iterative operators, which have to look
            continue
        for line in path.read_text().splitlines():
            found = re.search(words, line)
            if found and "F.count(" not in line:
                raise AssertionError(f"{path.name}: {line.strip()}")
