"""Captured cards to posts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.text_queries import PLACE_WORDS, SQL_WS, lit, sub
from stormledger import dictionaries as D
from stormledger.operators import capture as K
from stormledger.sources.snapshots import union_posts

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


# corpus words stand in for hazard words; two with capitals can never match
WORDS = ["tion", "queaux", "LPA", "Taal", "und", "stay safe", "lely"]
CUTOFF_PAGE, CUTOFF_QUERY, CUTOFF_X = "2024-01-01 20:00:00", "2024-01-02 09:30:00", "2024-01-05 08:00:00"


def sql_strip(expr: str) -> str:
    return sub(expr, f"^{SQL_WS}+|{SQL_WS}+$")


_B1, _B2 = sql_strip("block_1"), sql_strip("block_2")
SQL_CAPTION = f"concat_ws(' ', nullif({_B1}, ''), nullif({_B2}, ''))"
_TAIL = "(stay safe|ingat|commented|replied|shared|🙏|po$|tagged)|^see more comments|^view more replies"


def sql_cut(expr: str) -> str:
    lines = f"string_split_regex({expr}, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]')"
    return sql_strip(
        f"(SELECT array_to_string(l[1:coalesce(nullif(list_position(list_transform(l, lambda x: "
        f"regexp_matches({sql_strip('lower(x)')}, '{_TAIL}')), true), 0) - 1, len(l))], ' ') FROM (SELECT {lines} AS l))"
    )


def sql_words(expr: str) -> str:
    return f"len(list_filter(string_split_regex({expr}, '{SQL_WS}+'), lambda w: w <> ''))"


_CAPTIONS = f"SELECT *, {sql_cut(SQL_CAPTION)} AS cut FROM ({V.CARDS})"


@query("caption", f"SELECT conv_id, turn, {SQL_CAPTION} AS caption FROM ({V.CARDS})")
def _(spark, d):
    return V.cards(spark, d).select("conv_id", "turn", K.caption(F.col("blocks")).alias("caption"))


@query("cut_comment_tail", f"SELECT conv_id, turn, cut FROM ({_CAPTIONS})")
def _(spark, d):
    return V.cards(spark, d).select("conv_id", "turn", K.cut_comment_tail(K.caption(F.col("blocks"))).alias("cut"))


@query("cut_comment_tail_of_documents", f"SELECT doc_id, {sql_cut('text')} AS cut FROM documents")
def _(spark, d):
    return V.texts(spark, d).select("doc_id", K.cut_comment_tail(F.col("text")).alias("cut"))


_SHORT = "CASE WHEN doc_id % 3 = 0 THEN substring(text, 1, 9) WHEN doc_id % 3 = 1 THEN concat('  ', substring(text, 1, 5), '   ') ELSE text END"


# whole texts, and beside them rows on the border
_WORDED = f"""SELECT doc_id, text AS t FROM documents
UNION ALL SELECT doc_id, {_SHORT} FROM documents"""


@query("min_words", f"SELECT doc_id, CASE WHEN {sql_words('t')} >= 3 THEN t END AS kept FROM ({_WORDED})")
@query("min_words_of_documents", f"SELECT doc_id, CASE WHEN {sql_words('t')} >= 3 THEN t END AS kept FROM ({_WORDED})")
def _(spark, d):
    return V.view(spark, d, _WORDED).select("doc_id", K.min_words(F.col("t")).alias("kept"))


def sql_any(expr: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({expr}), {lit(w)})" for w in words) + ")"


@query("keyword_filter", f"SELECT doc_id FROM documents WHERE {sql_any('text', WORDS)}")
def _(spark, d):
    return K.keyword_filter(V.texts(spark, d), WORDS).select("doc_id")


@query("keyword_filter_of_posts", f"SELECT post_id FROM ({V.POSTS}) WHERE {sql_any('text', D.CAPTURE_KEYWORDS)}")
def _(spark, d):
    return K.keyword_filter(V.posts(spark, d)).select("post_id")


@query("truncate", "SELECT doc_id, substring(text, 1, 5000) AS text FROM documents")
def _(spark, d):
    return V.texts(spark, d).select("doc_id", K.truncate(F.col("text")).alias("text"))


_LOCAL = "TIMESTAMP '1970-01-01 00:00:00' + to_seconds(utime + 28800)"
_FB_RECENT = f"""
SELECT *, coalesce(strftime(at_local, '%Y-%m-%d %H:%M:%S'), 'Unknown') AS post_timestamp
FROM (SELECT *, CASE WHEN utime <> 0 THEN {_LOCAL} END AS at_local FROM ({_CAPTIONS}))
WHERE at_local IS NULL OR at_local >= CASE WHEN query_kind = 'query' THEN TIMESTAMP '{CUTOFF_QUERY}' ELSE TIMESTAMP '{CUTOFF_PAGE}' END"""
_ISO = "TRY_CAST(replace(replace(time_iso, 'T', ' '), 'Z', '') AS TIMESTAMP)"
_X_RECENT = f"""
SELECT *, strftime(at_local, '%Y-%m-%d %H:%M') AS post_timestamp
FROM (SELECT *, {_ISO} + to_hours(8) AS at_local FROM ({V.CARDS})) WHERE at_local >= TIMESTAMP '{CUTOFF_X}'"""


@query("recent_fb", f"SELECT conv_id, turn, post_timestamp FROM ({_FB_RECENT})")
def _(spark, d):
    return K.recent_fb(V.cards(spark, d), CUTOFF_PAGE, CUTOFF_QUERY).select("conv_id", "turn", "post_timestamp")


@query("recent_x", f"SELECT conv_id, turn, post_timestamp FROM ({_X_RECENT})")
def _(spark, d):
    return K.recent_x(V.cards(spark, d), CUTOFF_X).select("conv_id", "turn", "post_timestamp")


@query("recent_events", """
SELECT event_id, strftime(at_local, '%Y-%m-%d %H:%M:%S') AS fb, strftime(at_local, '%Y-%m-%d %H:%M') AS x
FROM (SELECT event_id, date_trunc('second', ts) + to_hours(8) AS at_local FROM events) WHERE at_local >= TIMESTAMP '2024-01-20 10:00:00'""")
def _(spark, d):
    seconds = F.expr("CAST(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', date_trunc('second', ts)) AS bigint)")
    at = V.table(spark, d, "events").select("event_id", K.local_time_of_epoch(seconds).alias("at"))
    return at.filter(F.col("at") >= F.lit("2024-01-20 10:00:00").cast("timestamp_ntz")).select(
        "event_id", K.format_ts(F.col("at"), "Facebook").alias("fb"), K.format_ts(F.col("at"), "X").alias("x")
    )


_USER = "CASE WHEN link IS NULL OR link = '' OR len(string_split(link, '/')) < 4 THEN 'unknown' ELSE split_part(link, '/', 4) END"
_LINK = "CASE WHEN link = '' OR len(string_split(link, '/')) >= 4 THEN link END"


@query("user_and_link", f"SELECT conv_id, turn, {_USER} AS who, {_LINK} AS where_to FROM ({V.CARDS})")
def _(spark, d):
    who = K.user_and_link(F.col("link"))
    return V.cards(spark, d).select("conv_id", "turn", who["user"].alias("who"), who["link"].alias("where_to"))


@query("user_of_page_url", """
SELECT page_id, CASE WHEN len(string_split(url, '/')) < 4 THEN 'unknown' ELSE split_part(url, '/', 4) END AS who FROM pages""")
def _(spark, d):
    return V.table(spark, d, "pages").select("page_id", K.user_and_link(F.col("url"))["user"].alias("who"))


_PLACES = [w for w in PLACE_WORDS if w == w.lower()] + ["th", "qu"]
FACEBOOK = f"""
SELECT 'Facebook' AS source, query_page, substring(cut, 1, 5000) AS text, post_timestamp, scraped_at AS scraped_timestamp,
  coalesce("user", 'Unknown') AS "user", coalesce(link, page_url) AS post_url
FROM ({_FB_RECENT}) WHERE source = 'Facebook' AND {sql_words('cut')} >= 3 AND {sql_any('cut', WORDS)} AND {sql_any('cut', _PLACES)}"""
X_POSTS = f"""
SELECT 'X' AS source, query_page, substring(block_1, 1, 5000) AS text, post_timestamp, scraped_at AS scraped_timestamp,
  {_USER} AS "user", {_LINK} AS post_url
FROM ({_X_RECENT}) WHERE source = 'X' AND {sql_any('block_1', WORDS)} AND {sql_any('block_1', _PLACES)}"""


def _vocab(spark):
    return spark.createDataFrame([(w,) for w in _PLACES], "name string")


def _facebook(spark, d):
    return K.capture_facebook(V.cards(spark, d), _vocab(spark), CUTOFF_PAGE, CUTOFF_QUERY, WORDS)


def _x(spark, d):
    return K.capture_x(V.cards(spark, d), _vocab(spark), CUTOFF_X, WORDS)


@query("capture_facebook", FACEBOOK)
def _(spark, d):
    return _facebook(spark, d)


@query("capture_x", X_POSTS)
def _(spark, d):
    return _x(spark, d)


_UNION = f"SELECT * FROM ({FACEBOOK}) UNION ALL SELECT * FROM ({X_POSTS})"


@query("union_posts", _UNION)
def _(spark, d):
    return union_posts(_facebook(spark, d), _x(spark, d))


@query("ingest_stats", f"""
WITH p AS MATERIALIZED ({_UNION}), f AS (
  SELECT c.source, c.query_page, c.scanned, coalesce(a.added, 0) AS added
  FROM (SELECT source, query_page, count(*) AS scanned FROM ({V.CARDS}) GROUP BY 1, 2) c
  LEFT JOIN (SELECT source, query_page, count(*) AS added FROM p GROUP BY 1, 2) a ON a.source = c.source AND a.query_page = c.query_page)
SELECT source, query_page, scanned, added FROM f
UNION ALL SELECT source, NULL, CAST(sum(scanned) AS bigint), CAST(sum(added) AS bigint) FROM f GROUP BY 1""")
def _(spark, d):
    return K.ingest_stats(V.cards(spark, d), union_posts(_facebook(spark, d), _x(spark, d)))
