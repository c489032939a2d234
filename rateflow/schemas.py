"""Schemas of the engine's tables."""

from pyspark.sql import types as T

ITEMS = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
])

RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("old_rating", T.DoubleType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

# A recommendation request; K is a parameter of the call, or each request's own.
REQUESTS = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
])

REQUESTS_WITH_K = T.StructType([*REQUESTS.fields, T.StructField("k", T.IntegerType())])
