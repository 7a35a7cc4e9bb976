"""Captured cards to posts: captions, filters, recency, post rows, feed statistics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stormledger import dictionaries as D
from stormledger.functions import text as X
from stormledger.functions.columns import add_once, let
from stormledger.functions.matching import contains_any, filter_contains_any

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def caption(blocks: Column) -> Column:
    """First two blocks by position, trimmed, empty ones dropped; null without blocks."""
    first = F.transform(F.slice(blocks, 1, 2), X.strip_ends)
    kept = F.filter(first, lambda b: b.isNotNull() & (b != ""))
    return F.when(F.size(blocks) > 0, F.array_join(kept, " "))


def cut_comment_tail(text: Column, patterns: Sequence[str] = tuple(D.COMMENT_PATTERNS)) -> Column:
    """Lines before the first one that looks like a comment, joined by spaces."""
    def before_tail(lines: Column) -> Column:
        is_tail = F.transform(
            lines,
            lambda line: reduce(
                lambda a, b: a | b,
                [X.strip_ends(F.lower(line)).rlike(rf"(?U){p}") for p in patterns],
            ),
        )
        stop = F.array_position(is_tail, True).cast("int")
        return F.slice(lines, F.lit(1), F.when(stop == 0, F.size(lines)).otherwise(stop - 1))

    lines = F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
    return X.strip_ends(F.array_join(let(lines, before_tail), " "))


def min_words(text: Column, least: int = D.MIN_CAPTION_WORDS) -> Column:
    return let(text, lambda t: F.when(F.size(X.words(t)) >= least, t))


def keyword_filter(
    df: DataFrame, words: Iterable[str] = tuple(D.CAPTURE_KEYWORDS), text_col: str = "text",
    strict: bool = False,
) -> DataFrame:
    """Rows whose lower-cased text holds a keyword.

    Keywords are compared as written, so one with a capital letter never
    matches; ``strict`` lowers them first.
    """
    used = [w.lower() for w in words] if strict else list(words)
    return df.filter(contains_any(F.lower(text_col), used))


def truncate(text: Column, size: int = D.MAX_TEXT_CHARS) -> Column:
    return F.substring(text, 1, size)


def local_time_of_epoch(utime: Column) -> Column:
    """Epoch seconds to the local zone, without the session zone; 0 is missing."""
    moment = F.expr(_EPOCH) + F.make_dt_interval(
        F.lit(0), F.lit(D.LOCAL_OFFSET_HOURS), F.lit(0), utime.cast("decimal(18,6)")
    )
    return F.when(utime != 0, moment)


def local_time_of_iso(time_iso: Column) -> Column:
    """ISO time with zone to the local zone; null when it cannot be read."""
    zoned = F.when(time_iso.rlike(r"(?:[Zz]|[+-]\d{2}:?\d{2})\z"), time_iso).otherwise(
        F.concat(time_iso, F.lit("Z"))
    )
    micros = F.unix_micros(F.try_to_timestamp(zoned))
    return F.expr(_EPOCH) + F.make_dt_interval(
        F.lit(0), F.lit(D.LOCAL_OFFSET_HOURS), F.lit(0),
        (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)"),
    )


def format_ts(moment: Column, platform: str) -> Column:
    return F.date_format(moment, D.FB_TIME_FORMAT if platform == "Facebook" else D.X_TIME_FORMAT)


def _cutoff(value) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def recent_fb(df: DataFrame, cutoff_page, cutoff_query) -> DataFrame:
    """Adds ``post_timestamp``; drops posts before the cutoff of their feed kind.

    A post without a time is kept as ``Unknown``.
    """
    cutoff = F.when(F.col("query_kind") == "query", _cutoff(cutoff_query)).otherwise(
        _cutoff(cutoff_page)
    )
    return (
        df.withColumn("_at", local_time_of_epoch(F.col("utime")))
        .filter(F.col("_at").isNull() | (F.col("_at") >= cutoff))
        .withColumn("post_timestamp", F.coalesce(format_ts(F.col("_at"), "Facebook"), F.lit("Unknown")))
        .drop("_at")
    )


def recent_x(df: DataFrame, cutoff) -> DataFrame:
    """Adds ``post_timestamp``; drops posts before the cutoff or without a readable time."""
    return (
        df.withColumn("_at", local_time_of_iso(F.col("time_iso")))
        .filter(F.col("_at") >= _cutoff(cutoff))
        .withColumn("post_timestamp", format_ts(F.col("_at"), "X"))
        .drop("_at")
    )


def user_and_link(link: Column) -> Column:
    """``{user, link}``: the link's 4th ``/``-piece.

    An empty link keeps itself with user ``unknown``; a link too short to hold a
    user loses both.
    """
    user = F.try_element_at(F.split(link, "/"), F.lit(4))
    return F.struct(
        F.when(link != "", F.coalesce(user, F.lit("unknown"))).otherwise(F.lit("unknown")).alias("user"),
        F.when((link == "") | user.isNotNull(), link).alias("link"),
    )


def _feed_text(df: DataFrame, words, vocab: DataFrame, strict: bool) -> DataFrame:
    return filter_contains_any(keyword_filter(df, words, "text", strict), "text", vocab)


def capture_facebook(
    cards: DataFrame, vocab: DataFrame, cutoff_page, cutoff_query,
    words: Iterable[str] = tuple(D.CAPTURE_KEYWORDS), strict: bool = False,
) -> DataFrame:
    # the cheap filter first: only recent cards are captioned and searched for names
    facebook = recent_fb(cards.filter(F.col("source") == "Facebook"), cutoff_page, cutoff_query)
    captioned = add_once(
        facebook, text=min_words(cut_comment_tail(caption(F.col("blocks"))))
    ).filter("text is not null")
    return _feed_text(captioned, words, vocab, strict).select(
        F.lit("Facebook").alias("source"), "query_page",
        truncate(F.col("text")).alias("text"), "post_timestamp",
        F.col("scraped_at").alias("scraped_timestamp"),
        F.coalesce("user", F.lit("Unknown")).alias("user"),
        F.coalesce("link", "page_url").alias("post_url"),
    )


def capture_x(
    cards: DataFrame, vocab: DataFrame, cutoff,
    words: Iterable[str] = tuple(D.CAPTURE_KEYWORDS), strict: bool = False,
) -> DataFrame:
    texts = (
        recent_x(cards.filter(F.col("source") == "X"), cutoff)
        .withColumn("text", F.try_element_at("blocks", F.lit(1)))
        .filter("text is not null")
    )
    return _feed_text(texts, words, vocab, strict).withColumn("_who", user_and_link(F.col("link"))).select(
        F.lit("X").alias("source"), "query_page",
        truncate(F.col("text")).alias("text"), "post_timestamp",
        F.col("scraped_at").alias("scraped_timestamp"),
        F.col("_who.user").alias("user"), F.col("_who.link").alias("post_url"),
    )


def ingest_stats(cards: DataFrame, posts: DataFrame) -> DataFrame:
    """Cards scanned and posts added per feed, and per source (``query_page`` null).

    Both tables are read once and summed together; a feed without a name is a feed.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    events = cards.select("source", "query_page", one.alias("scanned"), none.alias("added")).unionByName(
        posts.select("source", "query_page", none.alias("scanned"), one.alias("added"))
    )
    sums = [F.sum(c).alias(c) for c in ("scanned", "added")]
    per = events.groupingSets([["source", "query_page"], ["source"]], "source", "query_page").agg(*sums)
    return per.filter("scanned > 0").select("source", "query_page", "scanned", "added")
