"""Friend graph, profiles, reviews and businesses seen in the shared tables.

The graph takes customers, suppliers, parts and nations for users. An order
line makes friends of its customer, its supplier and its part; customers and
suppliers are friends of their nation. The number of edges grows with the
tables, and suppliers and nations have very many friends. A supplier lists a
customer only for lines that were not returned, so some friendships are listed
by one side only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.operators import friendship

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared table. With its schema given no file is opened to plan a query."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def customer_id(key: Column) -> Column:
    return _user_id(key, 0)


def supplier_id(key: Column) -> Column:
    return _user_id(key, 1)


def part_id(key: Column) -> Column:
    return _user_id(key, 2)


def nation_id(key: Column) -> Column:
    return _user_id(key, 3)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer, supplier, part, returned), the three users of each order line.

    Orders are hashed, so that the lines, several for each, are not sorted.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"
    )
    return lines.join(
        orders.hint("shuffle_hash"), lines.l_orderkey == orders.o_orderkey
    ).select(
        customer_id(F.col("o_custkey")).alias("customer"),
        supplier_id(F.col("l_suppkey")).alias("supplier"),
        part_id(F.col("l_partkey")).alias("part"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )


def citizens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(citizen, nation) of customers and suppliers."""
    customers = table(spark, sf_dir, "customer").select(
        customer_id(F.col("c_custkey")).alias("citizen"),
        nation_id(F.col("c_nationkey")).alias("nation"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        supplier_id(F.col("s_suppkey")).alias("citizen"),
        nation_id(F.col("s_nationkey")).alias("nation"),
    )
    return customers.unionByName(suppliers)


def friend_arcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, friend_id) with repetitions."""
    customer, supplier, part = F.col("customer"), F.col("supplier"), F.col("part")
    of_lines = _arcs(
        order_lines(spark, sf_dir),
        (customer, supplier),
        (customer, part),
        (supplier, F.when(~F.col("returned"), customer)),
        (supplier, part),
        (part, customer),
        (part, supplier),
    ).where(F.col("friend_id").isNotNull())
    citizen, nation = F.col("citizen"), F.col("nation")
    of_nations = _arcs(citizens(spark, sf_dir), (citizen, nation), (nation, citizen))
    return of_lines.unionByName(of_nations)


def friend_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, friends array), several short lists per user with repeated friends."""
    customer, supplier, part = F.col("customer"), F.col("supplier"), F.col("part")
    kept = F.when(~F.col("returned"), customer)
    of_lines = _lists(
        order_lines(spark, sf_dir),
        (customer, F.array(supplier, part)),
        (supplier, F.array_compact(F.array(kept, part))),
        (part, F.array(customer, supplier)),
    )
    citizen, nation = F.col("citizen"), F.col("nation")
    of_nations = _lists(
        citizens(spark, sf_dir), (citizen, F.array(nation)), (nation, F.array(citizen))
    )
    return of_lines.unionByName(of_nations)


def friend_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, friend_id), each edge once."""
    return friendship.distinct_edges(friend_arcs(spark, sf_dir))


def asked_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs to ask mutual friends for, not all of them friends.

    Customer and supplier of each returned line, and its customer with the part
    that has the supplier's number.
    """
    returned = order_lines(spark, sf_dir).where("returned")
    namesake = F.col("supplier") + 1
    return returned.select(
        F.inline(
            F.array(
                F.struct(F.col("customer").alias("a"), F.col("supplier").alias("b")),
                F.struct(F.col("customer").alias("a"), namesake.alias("b")),
            )
        )
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of customers and suppliers; parts and nations have none."""
    customers = table(spark, sf_dir, "customer").select(
        customer_id(F.col("c_custkey")).alias("user_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        supplier_id(F.col("s_suppkey")).alias("user_id"),
        F.lit("SUPPLIER").alias("first_name"),
        F.col("s_name").alias("last_name"),
        F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"),
    )
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    born = F.date_add(
        F.lit("1940-01-01").cast("date"),
        F.floor((F.col("acctbal") + 1000) * 2).cast("int"),
    )
    return (
        customers.unionByName(suppliers)
        .join(nation, F.col("nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "user_id",
            "first_name",
            "last_name",
            F.concat(F.lit("Addr "), F.col("user_id").cast("string")).alias("address"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.date_format(born, "MM/dd/yyyy").alias("dob"),
        )
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review per order line; stars are text and unreadable for untaxed lines."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax"
    )
    stars = F.when(F.col("l_tax") == 0, "x").otherwise(F.col("l_quantity").cast("string"))
    return lines.join(
        orders, lines.l_orderkey == orders.o_orderkey
    ).select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("review_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("business_id"),
        stars.alias("stars"),
    )


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A business per part; those with a large part are listed twice."""
    copies = F.when(F.col("p_size") > 25, 2).otherwise(1)
    return (
        table(spark, sf_dir, "part")
        .select(
            F.col("p_partkey").alias("business_id"),
            F.col("p_name").alias("full_address"),
            F.col("p_type").alias("categories"),
            F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
        )
        .drop("copy")
    )


def adjacency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The friend lists as `user <TAB> friend,friend` text lines."""
    friends = F.array_join(F.col("friends").cast("array<string>"), ",")
    return friend_lists(spark, sf_dir).select(
        F.concat(F.col("user_id").cast("string"), F.lit("\t"), friends).alias("value")
    )


def profile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profiles as comma-separated lines of ten fields."""
    return profiles(spark, sf_dir).select(
        F.concat_ws(
            ",",
            F.col("user_id").cast("string"),
            "first_name",
            "last_name",
            "address",
            "city",
            "state",
            F.lit("zip"),
            F.lit("country"),
            F.lit("login"),
            "dob",
        ).alias("value")
    )


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(reviews(spark, sf_dir), "::")


def business_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(businesses(spark, sf_dir), "::")


def _joined(df: DataFrame, separator: str) -> DataFrame:
    cells = [df[c].cast("string") for c in df.columns]
    return df.select(F.concat_ws(separator, *cells).alias("value"))


def _user_id(key: Column, kind: int) -> Column:
    return key.cast("bigint") * 4 + kind


def _arcs(df: DataFrame, *arcs: tuple[Column, Column]) -> DataFrame:
    return df.select(
        F.inline(
            F.array(
                *[F.struct(u.alias("user_id"), f.alias("friend_id")) for u, f in arcs]
            )
        )
    )


def _lists(df: DataFrame, *lists: tuple[Column, Column]) -> DataFrame:
    return df.select(
        F.inline(
            F.array(
                *[F.struct(u.alias("user_id"), f.alias("friends")) for u, f in lists]
            )
        )
    )
