"""Post cleaning: text choice, filters, page sources, output columns, row accounting."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

from stormledger import dictionaries as D
from stormledger.functions import text as X
from stormledger.functions.columns import add_once
from stormledger.functions.matching import filter_contains_any


def choose_text(df: DataFrame) -> Column:
    """``text`` when the table has it, else ``text_content``; null becomes ``""``."""
    for name in ("text", "text_content"):
        if name in df.columns:
            return F.coalesce(F.col(name), F.lit(""))
    return F.lit("")


def clean_posts(df: DataFrame, min_len: int = X.MIN_CLEAN_CHARS) -> DataFrame:
    return add_once(df, text_content=X.clean_text(choose_text(df), min_len))


def drop_empty(df: DataFrame, text_col: str = "text_content") -> DataFrame:
    return df.filter(~X.is_blank(F.col(text_col)))


def mentions_location(
    df: DataFrame, vocab: DataFrame, text_col: str = "text_content"
) -> DataFrame:
    """Posts whose lower-cased text holds any name of ``vocab`` as a substring."""
    return filter_contains_any(df, text_col, vocab)


def display_name(handle: Column, names: Mapping[str, str]) -> Column:
    """Known handles get their display name; hashtags and others stay as they are."""
    table = F.create_map(*[
        F.lit(v) for pair in names.items() if not pair[0].startswith("#") for v in pair
    ])
    return F.coalesce(F.try_element_at(table, handle), handle)


def page_source(
    url: Column,
    hosts: tuple[str, ...] = D.SOURCE_HOSTS,
    names: Mapping[str, str] = D.SOURCE_NAMES,
) -> Column:
    handle = X.page_handle(url, hosts)
    return display_name(handle, names) if names else handle


def source_name(df: DataFrame, names: DataFrame, handle_col: str, out_col: str) -> DataFrame:
    """Display names from a table ``(handle, name)`` with one row per handle."""
    looked_up = names.select(
        F.col("handle").alias("_handle"), F.col("name").alias("_name")
    )
    hashtag = F.col(handle_col).startswith("#")
    return (
        df.join(looked_up, (F.col(handle_col) == F.col("_handle")) & ~hashtag, "left")
        .withColumn(out_col, F.coalesce("_name", handle_col))
        .drop("_handle", "_name")
    )


def keep_trusted_or_local(
    df: DataFrame,
    vocab: DataFrame,
    trusted: Iterable[str] = tuple(D.TRUSTED_SOURCES),
    text_col: str = "text_content",
) -> DataFrame:
    """Posts that mention a place or come from a trusted page."""
    is_trusted = F.coalesce(F.lower("page_source").isin([t.lower() for t in trusted]), F.lit(False))
    return filter_contains_any(df, text_col, vocab, keep=is_trusted)


def format_columns(df: DataFrame) -> DataFrame:
    """Rename to the output names and keep the output columns that exist."""
    for old, new in D.OUTPUT_RENAMES.items():
        if old in df.columns and new in df.columns:
            raise ValueError(f"renaming {old!r} would give a second column {new!r}")
    df = df.withColumnsRenamed({o: n for o, n in D.OUTPUT_RENAMES.items() if o in df.columns})
    return df.select([c for c in D.OUTPUT_COLUMNS if c in df.columns])


def stage_counts(df: DataFrame, stages: Mapping[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Rows before, after and dropped for each stage, in the order given.

    The stages run once: every one of them counts the rows that pass through it.
    """
    names = ["input", *stages]
    counters = [Observation() for _ in names]
    frame = df.observe(counters[0], F.count(F.lit(1)).alias("n"))
    for counter, stage in zip(counters[1:], stages.values(), strict=True):
        frame = stage(frame).observe(counter, F.count(F.lit(1)).alias("n"))
    frame.write.format("noop").mode("overwrite").save()
    counts = [c.get["n"] for c in counters]
    before = [counts[0], *counts]
    return df.sparkSession.createDataFrame(
        [(k, name, b, n, b - n) for k, (name, b, n) in enumerate(zip(names, before, counts))],
        "step int, stage string, rows_in bigint, rows_out bigint, dropped bigint",
    )
