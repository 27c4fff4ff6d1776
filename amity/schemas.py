"""Column layouts of the four inputs."""

from pyspark.sql import types as T

EDGES = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("friend_id", T.LongType()),
    ]
)

# Fields 6 to 8 of a profile line belong to the format but no question reads them.
PROFILES = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("field_6", T.StringType()),
        T.StructField("field_7", T.StringType()),
        T.StructField("field_8", T.StringType()),
        T.StructField("dob", T.StringType()),
    ]
)

REVIEWS = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("business_id", T.StringType()),
        T.StructField("stars", T.StringType()),
    ]
)

BUSINESSES = T.StructType(
    [
        T.StructField("business_id", T.StringType()),
        T.StructField("full_address", T.StringType()),
        T.StructField("categories", T.StringType()),
    ]
)

PAIRS = T.StructType(
    [
        T.StructField("a", T.LongType()),
        T.StructField("b", T.LongType()),
    ]
)
