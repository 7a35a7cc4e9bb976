"""Explicit schemas for the tables the operators exchange."""

from pyspark.sql import types as T

POST_COLUMNS = [
    "source", "query_page", "text", "post_timestamp",
    "scraped_timestamp", "user", "post_url",
]


def _strings(names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


POSTS = _strings(POST_COLUMNS)

CARDS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("query_page", T.StringType()),
    T.StructField("query_kind", T.StringType()),
    T.StructField("blocks", T.ArrayType(T.StringType())),
    T.StructField("utime", T.LongType()),
    T.StructField("time_iso", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("scraped_at", T.StringType()),
])

SPANS = T.StructType([
    T.StructField("post_id", T.LongType()),
    T.StructField("model", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("word", T.StringType()),
    T.StructField("entity_group", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

SCORES = T.StructType([
    T.StructField("post_id", T.LongType()),
    T.StructField("label", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

PLACE_MATCH = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("matched_name", T.StringType()),
])

GAZETTEER = T.StructType([
    T.StructField("level", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("code", T.StringType()),
    T.StructField("parent_code", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("name_norm", T.StringType()),
    T.StructField("name_core_norm", T.StringType()),
])
