"""Edges, pairs and the friends two users have in common.

Edges are (user_id, friend_id) rows: the user lists the friend. Repeated edges,
self edges and edges listed by only one side are all accepted.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import id_set_intersection, larger_id, list_length, smaller_id

# A user met as the far end of more pairs than this is looked up in slices of
# about this size, each a separate join key.
SLICE_ROWS = 200_000

# Users in more pairs than this are ordered by their number of pairs.
CROWD = 256

# A list of more friends than this is met in pieces of at most about this size.
LIST_ROWS = 100_000

# Values of the column `listing` of a pair (x, y).
X_LISTS_Y = 1
Y_LISTS_X = 2
BOTH_LIST = 3


def explode_friends(lists: DataFrame) -> DataFrame:
    """(user_id, friends array) rows as one row per user and friend."""
    return lists.select("user_id", F.explode("friends").alias("friend_id"))


def edges_of(edges: DataFrame, users: Iterable[int]) -> DataFrame:
    """The friends listed by the given users."""
    return edges.where(F.col("user_id").isin(list(users)))


def distinct_edges(edges: DataFrame) -> DataFrame:
    """Each edge once, unknown users and self edges included.

    Edges are met by pair with a flag for each direction: most friendships are
    listed by both sides, so there are about half as many pairs as edges.
    """
    user, friend = F.col("user_id"), F.col("friend_id")
    turned = F.coalesce(user > friend, F.lit(False))
    pairs = (
        edges.select(
            F.when(turned, friend).otherwise(user).alias("a"),
            F.when(turned, user).otherwise(friend).alias("b"),
            F.when(turned, Y_LISTS_X).otherwise(X_LISTS_Y).alias("listing"),
        )
        .groupBy("a", "b")
        .agg(F.bit_or("listing").alias("listing"))
    )
    return _listed_edges(pairs)


def friend_pairs(edges: DataFrame) -> DataFrame:
    """One row (a, b, listing) per pair of friends, a < b.

    `listing` tells whether a lists b, b lists a, or both do.
    """
    return _met_pairs(_listings(edges))


def canonical_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs given in any order as (a, b) with a < b. Repeated pairs are kept."""
    return pairs.select(
        smaller_id(F.col("a"), F.col("b")).alias("a"),
        larger_id(F.col("a"), F.col("b")).alias("b"),
    ).where(F.col("a") < F.col("b"))


def in_pair_set(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows whose (a, b) is one of the given pairs, however often it is given."""
    asked = canonical_pairs(pairs).distinct()
    asked = asked.select(_spread("a").alias("asked_a"), F.col("b").alias("asked_b"))
    same = (_spread("a") == F.col("asked_a")) & (F.col("b") == F.col("asked_b"))
    return rows.join(asked, same, "left_semi")


def lists_of(edges: DataFrame, users: DataFrame) -> DataFrame:
    """The edges whose user_id is in `users`, however often it is there."""
    asked = users.select("user_id").distinct().select(_spread("user_id").alias("asked"))
    return edges.join(asked, _spread("user_id") == F.col("asked"), "left_semi")


def degrees(pairs: DataFrame) -> DataFrame:
    """(user_id, degree): in how many pairs each user is."""
    ends = _in_use(pairs, "listing").select(F.explode(F.array("a", "b")).alias("user_id"))
    return ends.groupBy("user_id").agg(F.count("*").alias("degree"))


def ranked_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs as (u, v, listing, degree_u, degree_v), u the less crowded end.

    Users in more than CROWD pairs come last, ordered by degree; the others are
    ordered by id and have degree 0 here. Seen from any user at most CROWD or
    sqrt(2m) friends come later in this order (m pairs): a crowded user has few
    that are more crowded. Lists of later friends therefore stay short even if
    one user is a friend of everybody.

    There are fewer than 2m / CROWD crowded users. They are broadcast, so that
    the pairs stay as they were shuffled.
    """
    crowd = degrees(pairs).where(F.col("degree") > CROWD)
    of_a = crowd.select(F.col("user_id").alias("key_a"), F.col("degree").alias("crowd_a"))
    of_b = crowd.select(F.col("user_id").alias("key_b"), F.col("degree").alias("crowd_b"))
    nobody = F.lit(0).cast("bigint")
    degree_a, degree_b = F.coalesce("crowd_a", nobody), F.coalesce("crowd_b", nobody)
    a_first = F.struct(degree_a, F.col("a")) < F.struct(degree_b, F.col("b"))
    listing = F.col("listing")
    return (
        pairs.join(F.broadcast(of_a), F.col("a") == F.col("key_a"), "left")
        .join(F.broadcast(of_b), F.col("b") == F.col("key_b"), "left")
        .select(
            F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("u"),
            F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("v"),
            F.when(a_first | (listing == BOTH_LIST), listing)
            .otherwise(BOTH_LIST - listing)
            .alias("listing"),
            F.least(degree_a, degree_b).alias("degree_u"),
            F.greatest(degree_a, degree_b).alias("degree_v"),
        )
    )


def later_friends(ranked: DataFrame) -> DataFrame:
    """Per user u the later friends, by who lists whom: mutual, listed, listed_by."""
    listing, v = F.col("listing"), F.col("v")
    return ranked.groupBy("u").agg(
        F.collect_list(F.when(listing == BOTH_LIST, v)).alias("mutual"),
        F.collect_list(F.when(listing == X_LISTS_Y, v)).alias("listed"),
        F.collect_list(F.when(listing == Y_LISTS_X, v)).alias("listed_by"),
        F.max("degree_u").alias("degree"),
    )


def closed_pairs(pairs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Ranked pairs with the friends that close a triangle over them.

    One row per pair (u, v), u ranked first, where v has later friends. All
    arrays hold users w ranked after v:

    - `uv`: mutual friends of u and v
    - `uw`: users w such that v is a mutual friend of u and w
    - `vw`: users w such that u is a mutual friend of v and w

    Together the three hold each (pair, mutual friend) exactly once. Friends
    count as mutual only for pairs that list each other.
    """
    ranked = ranked_pairs(pairs)
    lists = _in_use(later_friends(ranked), "degree")

    # v may be a friend of everybody: its pairs are spread over slices and its
    # list, which is short, is repeated for each slice.
    heads = ranked.select(
        "u",
        "v",
        "listing",
        _slice_of("u", "degree_v", slice_rows).alias("slice"),
    )
    tails = lists.select(
        _spread("u").alias("tail"),
        F.col("mutual").alias("v_mutual"),
        F.col("listed").alias("v_listed"),
        F.col("listed_by").alias("v_listed_by"),
        F.explode(F.sequence(F.lit(0), _slices("degree", slice_rows) - 1)).alias("part"),
    )
    # u may have as many later friends as a list can have. The key made anew has
    # both sides shuffled, so that adaptive execution can split such a user.
    own = lists.select(_spread("u").alias("own"), "mutual", "listed", "listed_by")
    same = (_spread("v") == F.col("tail")) & (F.col("slice") == F.col("part"))
    # Sorted by v, copies of a list are neighbours, which halves what is shuffled
    # by u. There the lists are hashed and the pairs, many more, are not sorted.
    met = heads.join(tails, same).join(
        own.hint("shuffle_hash"), _spread("u") == F.col("own")
    )

    # In a graph in which friends list each other `both` is all there is, so it
    # is found once and the rest is looked for only where it can be.
    both = met.withColumn("both", id_set_intersection(F.col("mutual"), F.col("v_mutual")))
    known_by_v = F.concat("v_mutual", "v_listed")
    uv = F.concat(
        "both",
        _found("mutual", "v_listed"),
        _found("listed", known_by_v),
    )
    uw = F.concat("both", _found("mutual", "v_listed_by"))
    vw = F.concat("both", _found("listed_by", "v_mutual"))
    listing = F.col("listing")
    return both.select(
        "u",
        "v",
        F.when(listing == BOTH_LIST, uv).alias("uv"),
        F.when(listing != Y_LISTS_X, uw).alias("uw"),
        F.when(listing != X_LISTS_Y, vw).alias("vw"),
    )


def mutual_friend_counts(pairs: DataFrame, closed: DataFrame) -> DataFrame:
    """(a, b, n) for every pair of friends, n = 0 included."""
    u, v = F.col("u"), F.col("v")
    found = list_length(F.col("uv"))
    one = F.lit(1).cast("bigint")
    shares = closed.select(
        F.inline(
            F.array(
                _share(u, F.when(found > 0, F.array(v)), found),
                _share(u, F.col("uw"), one),
                _share(v, F.col("vw"), one),
            )
        )
    ).select("x", F.explode("ys").alias("y"), "n")
    x, y = F.col("x"), F.col("y")
    counts = shares.groupBy(
        smaller_id(x, y).alias("a"), larger_id(x, y).alias("b")
    ).agg(F.sum("n").alias("n"))
    # Both sides are already partitioned by (a, b).
    return _in_use(pairs, "listing").join(counts, ["a", "b"], "left").select(
        "a", "b", F.coalesce("n", F.lit(0)).alias("n")
    )


def mutual_friend_rows(closed: DataFrame) -> DataFrame:
    """(a, b, friend_id) for every pair of friends and each mutual friend."""
    u, v, w, role = F.col("u"), F.col("v"), F.col("w"), F.col("role")
    roles = F.array(
        *[
            F.struct(F.lit(name).alias("role"), F.col(name).alias("ws"))
            for name in ("uv", "uw", "vw")
        ]
    )
    rows = closed.select("u", "v", F.inline(roles)).select(
        "u", "v", "role", F.explode("ws").alias("w")
    )
    x = F.when(role == "vw", v).otherwise(u)
    y = F.when(role == "uv", v).otherwise(w)
    friend = F.when(role == "uv", w).when(role == "uw", v).otherwise(u)
    return rows.select(
        smaller_id(x, y).alias("a"), larger_id(x, y).alias("b"), friend.alias("friend_id")
    )


def asked_friends(edges: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The given pairs that are friends, and (a, b, friend_id) of their mutual friends.

    Only pairs that list each other have mutual friends, so lists are read on for
    users in such pairs. No row is made for a pair that is not asked for.
    """
    edges = _keyed(edges)
    friends = _met_pairs(in_pair_set(_listings(edges), pairs))
    both = friends.where(F.col("listing") == BOTH_LIST)
    return friends, _in_both_lists(both, _asked_edges(edges, both))


def common_friends(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, friend_id): whom both users of a pair list, each once.

    The pairs need not be friends; how often one is given makes no difference.
    Only lists of users in some pair are read on. The list of the end with fewer
    friends travels in one cell to the list of the other end, both in pieces of
    about LIST_ROWS friends, so a hub's list is not repeated for its pairs.
    """
    own = _asked_edges(edges, pairs)
    both = _by_list_size(canonical_pairs(pairs).distinct(), own)
    lists = _list_pieces(own)
    shorter = lists.select(_spread("user_id").alias("owner"), "piece", "friends")
    longer = lists.select(
        _spread("user_id").alias("knower"),
        F.col("piece").alias("met"),
        F.col("friends").alias("known"),
    )
    # Numbers of pieces are powers of two, so piece i of s pieces has its ids
    # in the pieces i, i + s, i + 2s, ... of any larger number.
    longer = longer.hint("shuffle_hash")
    sent = both.join(shorter, _spread("shorter") == F.col("owner")).select(
        "a",
        "b",
        "longer",
        "friends",
        F.explode(
            F.sequence(
                F.col("piece"), _pieces("longer_size") - 1, _pieces("shorter_size")
            )
        ).alias("part"),
    )
    found = sent.join(
        longer, (_spread("longer") == F.col("knower")) & (F.col("part") == F.col("met"))
    )
    return found.select(
        "a", "b", F.explode(id_set_intersection(F.col("friends"), F.col("known"))).alias("friend_id")
    )


def _listings(edges: DataFrame) -> DataFrame:
    """Each edge between two users as (a, b, listing), a < b."""
    user, friend = F.col("user_id"), F.col("friend_id")
    return edges.select(
        smaller_id(user, friend).alias("a"),
        larger_id(user, friend).alias("b"),
        F.when(user < friend, X_LISTS_Y).otherwise(Y_LISTS_X).alias("listing"),
    ).where(F.col("a") < F.col("b"))


def _met_pairs(listings: DataFrame) -> DataFrame:
    return listings.groupBy("a", "b").agg(F.bit_or("listing").alias("listing"))


def _listed_edges(pairs: DataFrame) -> DataFrame:
    """(user_id, friend_id) for each direction that the pairs (a, b, listing) are listed in."""
    listing = F.col("listing")
    there = F.struct(F.col("a").alias("user_id"), F.col("b").alias("friend_id"))
    back = F.struct(F.col("b").alias("user_id"), F.col("a").alias("friend_id"))
    listed = (
        F.when(listing == X_LISTS_Y, F.array(there))
        .when(listing == Y_LISTS_X, F.array(back))
        .otherwise(F.array(there, back))
    )
    return pairs.select(F.inline(listed))


def _keyed(edges: DataFrame) -> DataFrame:
    """Edges between two different known users.

    The tests are those that readers of the edges would each push down for
    themselves. Made here, all readers have one plan, which Spark runs once.
    """
    user, friend = F.col("user_id"), F.col("friend_id")
    return edges.where(
        (smaller_id(user, friend) < larger_id(user, friend))
        & (user != friend)
        & _spread("user_id").isNotNull()
        & _spread("friend_id").isNotNull()
    )


def _asked_edges(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    return lists_of(edges, pairs.select(F.explode(F.array("a", "b")).alias("user_id")))


def _list_sizes(own: DataFrame) -> DataFrame:
    # Counting friends, not rows, reads the same columns as the lists do.
    return own.groupBy("user_id").agg(F.count("friend_id").alias("size"))


def _by_list_size(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """Pairs as (a, b, shorter, longer, shorter_size, longer_size) by lists in `own`."""
    sizes = _list_sizes(own)
    of_a = sizes.select(_spread("user_id").alias("key_a"), F.col("size").alias("size_a"))
    of_b = sizes.select(_spread("user_id").alias("key_b"), F.col("size").alias("size_b"))
    size_a, size_b = F.col("size_a"), F.col("size_b")
    a_first = size_a <= size_b
    return (
        pairs.join(of_a, _spread("a") == F.col("key_a"))
        .join(of_b, _spread("b") == F.col("key_b"))
        .select(
            "a",
            "b",
            F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("shorter"),
            F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("longer"),
            F.least(size_a, size_b).alias("shorter_size"),
            F.greatest(size_a, size_b).alias("longer_size"),
        )
    )


def _list_pieces(own: DataFrame) -> DataFrame:
    """(user_id, piece, friends): the lists, those of crowded users in pieces by friend.

    Crowded users have more than LIST_ROWS edges each and are therefore few.
    """
    crowded = _list_sizes(own).where(F.col("size") > LIST_ROWS)
    crowded = crowded.select(_spread("user_id").alias("crowded"), "size")
    pieces = _pieces(F.coalesce("size", F.lit(1)))
    piece = F.coalesce(F.pmod(F.xxhash64("friend_id"), pieces).cast("int"), F.lit(0))
    return (
        own.join(F.broadcast(crowded), _spread("user_id") == F.col("crowded"), "left")
        .groupBy("user_id", piece.alias("piece"))
        .agg(F.collect_set("friend_id").alias("friends"))
    )


def _in_both_lists(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """(a, b, friend_id) for friends that `own` lists for both ends.

    The list of the end with fewer friends is looked up among the edges of the
    other end, so a hub's list is not repeated for each pair it is in.
    """
    # Distinct edges are already partitioned by user and friend, as they are met.
    own = own.distinct()
    both = _by_list_size(pairs, own)
    listed = own.select(_spread("user_id").alias("owner"), "friend_id")
    known = own.select(F.col("user_id").alias("knower"), F.col("friend_id").alias("known"))
    rows = both.join(listed, _spread("shorter") == F.col("owner")).join(
        known,
        (F.col("longer") == F.col("knower")) & (F.col("friend_id") == F.col("known")),
        "left_semi",
    )
    return rows.select("a", "b", "friend_id")


def mutual_friend_lists(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b, mutual_friends) with the ids ascending, joined by a comma and a blank.

    One row per pair; a pair without rows gets an empty text. The ids of a pair
    have to fit a cell; mutual_friend_rows and asked_friends give them as rows.
    """
    ids = F.array_sort(F.collect_list("friend_id")).cast("array<string>")
    texts = rows.groupBy("a", "b").agg(F.array_join(ids, ", ").alias("mutual_friends"))
    # All pairs of a graph are already partitioned by (a, b).
    return _in_use(pairs, "listing").join(texts, ["a", "b"], "left").select(
        "a", "b", F.coalesce("mutual_friends", F.lit("")).alias("mutual_friends")
    )


def friend_arrivals(edges: DataFrame) -> DataFrame:
    """(friend_id, arrivals): by how many users each friend is listed."""
    return (
        edges.where(F.col("user_id") != F.col("friend_id"))
        .groupBy("friend_id")
        .agg(F.count_distinct("user_id").alias("arrivals"))
    )


def listed_by_all(arrivals: DataFrame, users: int = 2) -> DataFrame:
    """The friends that all of the users list."""
    return arrivals.where(F.col("arrivals") == users).select("friend_id")


def _in_use(df: DataFrame, column: str) -> DataFrame:
    """`df` with a test on a number that always holds.

    Readers of `df` then all need the column. Their plans stay equal down to
    the shuffle below, which Spark runs once for all of them.
    """
    return df.where(F.col(column) >= 0)


def _spread(key: str) -> Column:
    """The key of a filter join whose small side was made distinct before.

    Joined on the column itself, that side would be used as it was shuffled to
    make it distinct. Adaptive execution splits a key that holds much of the
    other side only if both sides were shuffled for the join. With the
    complement of the column they are, unless one is small enough to broadcast.
    """
    return F.bitwise_not(F.col(key))


def _found(left: str, right: str | Column) -> Column:
    """The ids found in both lists, not looked for if one of them is empty."""
    right = F.col(right) if isinstance(right, str) else right
    nothing = F.array().cast("array<bigint>")
    return F.when(
        (F.size(left) > 0) & (F.size(right) > 0),
        id_set_intersection(F.col(left), right),
    ).otherwise(nothing)


def _share(x: Column, ys: Column, n: Column) -> Column:
    return F.struct(x.alias("x"), ys.alias("ys"), n.alias("n"))


def _pieces(size: str | Column) -> Column:
    """The least power of two that many pieces of LIST_ROWS hold a list of the size in."""
    size = F.col(size) if isinstance(size, str) else size
    doublings = F.greatest(F.lit(0), F.ceil(F.log2(size / LIST_ROWS)))
    return F.pow(F.lit(2), doublings).cast("int")


def _slices(degree: str, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col(degree) / size)).cast("int")


def _slice_of(key: str, degree: str, size: int) -> Column:
    return F.pmod(F.xxhash64(key), _slices(degree, size)).cast("int")
