"""Mutual friends against plain Python, on graphs with every kind of edge."""

import math

import pytest
from pyspark.sql import functions as F

from amity import schemas
from amity.operators import friendship
from amity.plans import questions

from graphs import edges, mutual, random_arcs, star_arcs

GRAPHS = {
    "random": random_arcs(seed=1, users=60, arcs=500),
    "sparse": random_arcs(seed=2, users=300, arcs=300),
    "star": star_arcs(120),
}

# Graph, and how long slices are.
CASES = [("random", 200_000), ("random", 1), ("sparse", 1), ("star", 200_000), ("star", 3)]


@pytest.mark.parametrize("name, slice_rows", CASES)
def test_counts_and_rows(spark, name, slice_rows):
    arcs = GRAPHS[name]
    expected = mutual(arcs)
    pairs = friendship.friend_pairs(edges(spark, arcs))
    closed = friendship.closed_pairs(pairs, slice_rows)

    counts = friendship.mutual_friend_counts(pairs, closed).collect()
    assert len(counts) == len(expected)
    assert {(r.a, r.b): r.n for r in counts} == {p: len(s) for p, s in expected.items()}

    rows = friendship.mutual_friend_rows(closed).collect()
    got = {(r.a, r.b, r.friend_id) for r in rows}
    assert len(rows) == len(got)
    assert got == {(a, b, w) for (a, b), ws in expected.items() for w in ws}


def test_each_pair_has_one_row(spark):
    arcs = GRAPHS["star"]
    expected = mutual(arcs)
    pairs = friendship.friend_pairs(edges(spark, arcs))
    rows = friendship.mutual_friend_rows(friendship.closed_pairs(pairs))
    lists = friendship.mutual_friend_lists(pairs, rows).collect()
    assert len(lists) == len(expected)
    assert {(r.a, r.b): r.mutual_friends for r in lists} == {
        p: ", ".join(map(str, sorted(ws))) for p, ws in expected.items()
    }


def test_asked_pairs(spark):
    arcs = GRAPHS["random"]
    expected = mutual(arcs)
    asked = [p for i, p in enumerate(sorted(expected)) if i % 3 == 0]
    swapped = [(b, a) for a, b in asked]
    strangers = [(5, 5), (1000, 1001)]
    pairs = spark.createDataFrame(swapped + asked + strangers, schemas.PAIRS)
    got = questions.mutual_friends(edges(spark, arcs), pairs).collect()
    assert {(r.a, r.b): r.mutual_friends for r in got} == {
        p: ", ".join(map(str, sorted(expected[p]))) for p in asked
    }
    assert len(got) == len(asked)


def test_counts_do_not_depend_on_direction_in_a_two_way_graph(spark):
    arcs = GRAPHS["star"]
    back = [(y, x) for x, y in arcs]
    there = questions.mutual_friend_counts(edges(spark, arcs)).collect()
    assert sorted(there) == sorted(
        questions.mutual_friend_counts(edges(spark, back)).collect()
    )


def test_count_is_within_the_smaller_degree(spark):
    arcs = GRAPHS["random"]
    lists = {}
    for x, y in arcs:
        if x != y:
            lists.setdefault(x, set()).add(y)
    for a, b, n in questions.mutual_friend_counts(edges(spark, arcs)).collect():
        assert 0 <= n <= min(len(lists.get(a, ())), len(lists.get(b, ())))


def test_top_k_is_the_start_of_the_full_order(spark):
    arcs = GRAPHS["random"]
    counts = questions.mutual_friend_counts(edges(spark, arcs)).collect()
    full = sorted(map(tuple, counts), key=lambda r: (-r[2], r[0], r[1]))
    for k in (1, 10, 10_000):
        top = questions.top_mutual_pairs(edges(spark, arcs), k).collect()
        assert [tuple(r) for r in top] == full[:k]


def test_lists_of_later_friends_are_short(spark):
    arcs = star_arcs(2000)
    pairs = friendship.friend_pairs(edges(spark, arcs))
    m = pairs.count()
    lists = friendship.later_friends(friendship.ranked_pairs(pairs))
    size = F.size("mutual") + F.size("listed") + F.size("listed_by")
    assert lists.agg(F.max(size)).first()[0] <= math.sqrt(2 * m)


def test_rows_are_made_for_asked_pairs_only(spark):
    arcs = GRAPHS["random"]
    expected = mutual(arcs)
    asked = sorted(expected)[::5]
    friends, rows = friendship.asked_friends(
        edges(spark, arcs), spark.createDataFrame(asked, schemas.PAIRS)
    )
    assert sorted((r.a, r.b) for r in friends.collect()) == asked
    got = [tuple(r) for r in rows.collect()]
    assert sorted(got) == sorted((a, b, w) for a, b in asked for w in expected[a, b])


@pytest.mark.parametrize("name", list(GRAPHS))
def test_common_friends_of_any_two_users(spark, name):
    arcs = GRAPHS[name]
    listed = {}
    for user, friend in arcs:
        listed.setdefault(user, set()).add(friend)
    users = sorted(listed)[:12]
    asked = [(x, y) for x in users for y in users if x < y]
    given = asked + [(y, x) for x, y in asked[:9]] + asked[:5] + [(users[0], users[0]), (users[0], 10**9)]
    rows = friendship.common_friends(
        edges(spark, arcs + arcs[:20]), spark.createDataFrame(given, "a long, b long")
    ).collect()
    got = [tuple(r) for r in rows]
    assert len(got) == len(set(got))
    assert set(got) == {(x, y, w) for x, y in asked for w in listed[x] & listed[y]}


def test_lists_of_unasked_users_are_not_gathered(spark):
    rows = friendship.common_friends(
        edges(spark, GRAPHS["random"]), spark.createDataFrame([(1, 2)], "a long, b long")
    )
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "LeftSemi" in plan


def test_pairs_of_a_crowded_user_are_sliced(spark):
    slice_rows = 100
    pairs = friendship.friend_pairs(edges(spark, star_arcs(2000)))
    ranked = friendship.ranked_pairs(pairs)
    largest = (
        ranked.groupBy(
            "v", friendship._slice_of("u", "degree_v", slice_rows).alias("slice")
        )
        .count()
        .agg(F.max("count"))
        .first()[0]
    )
    assert largest < 2 * slice_rows


def test_empty_graph(spark):
    nothing = edges(spark, [])
    assert questions.mutual_friend_counts(nothing).count() == 0
    pairs = spark.createDataFrame([(1, 2)], schemas.PAIRS)
    assert questions.mutual_friends(nothing, pairs).count() == 0


@pytest.mark.parametrize("name", list(GRAPHS))
def test_long_lists_are_met_in_pieces(spark, monkeypatch, name):
    monkeypatch.setattr(friendship, "LIST_ROWS", 3)
    arcs = GRAPHS[name]
    listed = {}
    for user, friend in arcs:
        listed.setdefault(user, set()).add(friend)
    users = sorted(listed)[:9]
    asked = [(x, y) for x in users for y in users if x < y]
    given = edges(spark, arcs + arcs[:20])
    pieces = friendship._list_pieces(given)
    assert pieces.agg(F.max(F.size("friends"))).first()[0] < max(map(len, listed.values()))
    got = [tuple(r) for r in friendship.common_friends(given, spark.createDataFrame(asked, schemas.PAIRS)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(x, y, w) for x, y in asked for w in listed[x] & listed[y]}


def test_lists_of_asked_pairs_travel_as_lists(spark):
    arcs = spark.createDataFrame(GRAPHS["random"], schemas.EDGES)
    rows = friendship.common_friends(arcs, spark.createDataFrame([(1, 2)], schemas.PAIRS))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # A row per pair and listed friend is not made: lists are met, then unfolded.
    assert "collect_set" in plan and "array_intersect" in plan


@pytest.mark.parametrize("crowd, slice_rows", [(0, 1), (3, 3), (10**6, 2)])
def test_any_users_may_be_crowded(spark, monkeypatch, crowd, slice_rows):
    monkeypatch.setattr(friendship, "CROWD", crowd)
    for arcs in (GRAPHS["random"], GRAPHS["star"]):
        pairs = friendship.friend_pairs(edges(spark, arcs))
        closed = friendship.closed_pairs(pairs, slice_rows)
        counts = friendship.mutual_friend_counts(pairs, closed).collect()
        assert len(counts) == len(mutual(arcs))
        assert {(r.a, r.b): r.n for r in counts} == {p: len(s) for p, s in mutual(arcs).items()}


def test_distinct_edges_keeps_unknown_users_and_self_edges(spark):
    arcs = [(1, 2), (2, 1), (1, 2), (3, 1), (4, 4), (4, 4), (None, 5), (5, None), (None, None), (-7, 2)]
    got = friendship.distinct_edges(spark.createDataFrame(arcs, "user_id long, friend_id long"))
    assert got.columns == ["user_id", "friend_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(set(arcs), key=repr)


def test_lists_are_read_on_for_pairs_that_list_each_other(spark, monkeypatch):
    # 1 and 2 list each other, 3 lists 4 only, 5 and 6 are strangers. Edges come twice.
    arcs = [(1, 2), (2, 1), (1, 9), (2, 9), (3, 4), (3, 9), (4, 9), (5, 9), (6, 9), (1, 1), (None, 9), (2, None)] * 2
    met = []
    in_both_lists = friendship._in_both_lists

    def seen(pairs, own):
        met.append({tuple(r) for r in own.collect()})
        return in_both_lists(pairs, own)

    monkeypatch.setattr(friendship, "_in_both_lists", seen)
    given = spark.createDataFrame(arcs, "user_id long, friend_id long")
    pairs = spark.createDataFrame([(2, 1), (1, 2), (3, 4), (5, 6), (None, 1)], "a long, b long")
    friends, rows = friendship.asked_friends(given, pairs)
    assert met == [{(1, 2), (2, 1), (1, 9), (2, 9)}]
    assert sorted(map(tuple, friends.collect())) == [(1, 2, 3), (3, 4, 1)]
    assert [tuple(r) for r in rows.collect()] == [(1, 2, 9)]
