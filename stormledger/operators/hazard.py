"""Hazard type of a post from keywords and model scores."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stormledger import dictionaries as D
from stormledger.functions.columns import add_once, let
from stormledger.functions.matching import join_names, prefix_pattern, quote, scan_names
from stormledger.runtime import cut

OTHER = "other"


def choose_text_column(df: DataFrame) -> str:
    for name in ("text_content", "text"):
        if name in df.columns:
            return name
    raise KeyError("neither 'text_content' nor 'text' is a column")


def _implied_keywords(keywords: Sequence[str], suffixes: Sequence[str]) -> dict[str, list[str]]:
    """For every form a keyword can take, the keywords that match at its start.

    Keywords nest ("storm" in "storm surge"), so one matched form can stand for
    several of them. The answer depends on the form alone.
    """
    forms = {k: [k] + [k + s for s in suffixes] for k in keywords}

    def ends_at_boundary(form: str, whole: str) -> bool:
        if not whole.startswith(form):
            return False
        if len(form) == len(whole):
            return True
        before, after = form[-1], whole[len(form)]
        return (before.isalnum() or before == "_") != (after.isalnum() or after == "_")

    return {
        whole: [k for k in keywords if any(ends_at_boundary(f, whole) for f in forms[k])]
        for whole in dict.fromkeys(f for k in keywords for f in forms[k])
    }


def _found_forms(text: Column, keywords: Sequence[str], suffixes: Sequence[str]) -> Column:
    """The longest forms of keywords in ``text`` as whole words, an ending allowed, in one scan.

    The look-ahead consumes nothing, so matches that overlap are all seen; the
    longest keyword at each position comes first and implies the shorter ones.
    """
    # most words begin like no keyword
    starts = "".join(quote(c) for c in dict.fromkeys(k[0] for k in keywords))
    # shared beginnings are tried once, and the longer keyword before the shorter
    pattern = (
        rf"(?U)\b(?=[{starts}])(?=({prefix_pattern(keywords)}"
        "(?:" + "|".join(quote(s) for s in suffixes) + r")?\b))"
    )
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(pattern), 1))


def _constant(value: object, kind: str) -> Column:
    """A nested constant as one literal; built of columns, a large one takes seconds to plan."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _looked_up(forms: Column, table: Mapping[str, Sequence], kind: str) -> Column:
    """All that ``table`` lists for ``forms``. Maps are searched entry by entry, so the table is dealt by hash."""
    size = 1 << len(table).bit_length()
    dealt: list[dict] = [{} for _ in range(size)]
    for form, listed in table.items():
        dealt[zlib.crc32(form.encode()) % size][form] = list(listed)
    maps = _constant(dealt, f"array<map<string,array<{kind}>>>")
    at = lambda form: (F.crc32(form.cast("binary")) % size).cast("int")
    return F.flatten(F.transform(forms, lambda f: F.try_element_at(F.get(maps, at(f)), f)))


def found_keywords(
    text: Column, keywords: Sequence[str], suffixes: Sequence[str] = D.KEYWORD_SUFFIXES
) -> Column:
    """All keywords in ``text`` as whole words, an ending allowed."""
    keywords = list(dict.fromkeys(keywords))
    return _looked_up(_found_forms(text, keywords, suffixes), _implied_keywords(keywords, suffixes), "string")


def keyword_hits(
    text: Column, dictionary: Mapping[str, Sequence[str]] = D.HAZARD_KEYWORDS
) -> Column:
    """Array of ``{label, keywords}`` in dictionary order, labels with hits only."""
    listed = [(label, k) for label, words in dictionary.items() for k in dict.fromkeys(words)]
    keywords = list(dict.fromkeys(k for _, k in listed))
    places: dict[str, list[int]] = {k: [] for k in keywords}
    for i, (_, k) in enumerate(listed):
        places[k].append(i)
    implied = _implied_keywords(keywords, D.KEYWORD_SUFFIXES)
    found = _looked_up(
        _found_forms(F.coalesce(text, F.lit("")), keywords, D.KEYWORD_SUFFIXES),
        {form: [i for k in ks for i in places[k]] for form, ks in implied.items()}, "int",
    )
    return let(F.array_sort(F.array_distinct(found)), lambda at: _hits_of(at, listed, list(dictionary)))


def _hits_of(at: Column, listed: Sequence[tuple[str, str]], labels: Sequence[str]) -> Column:
    """Hits from the places of the found keywords in ``listed``, ascending."""
    names, words = _constant(list(labels), "array<string>"), _constant([k for _, k in listed], "array<string>")
    owners = _constant([labels.index(label) for label, _ in listed], "array<int>")
    met = F.array_distinct(F.transform(at, lambda i: F.get(owners, i)))
    return F.transform(
        met,
        lambda m: F.struct(
            F.get(names, m).alias("label"),
            F.transform(F.filter(at, lambda i: F.get(owners, i) == m), lambda i: F.get(words, i)).alias("keywords"),
        ),
    )


def with_keyword_hits(
    df: DataFrame,
    text_col: str | None = None,
    dictionary: Mapping[str, Sequence[str]] = D.HAZARD_KEYWORDS,
    out_col: str = "keyword_hits",
) -> DataFrame:
    return add_once(df, **{out_col: keyword_hits(F.col(text_col or choose_text_column(df)), dictionary)})


# ---------------------------------------------------------------------------
# dictionaries as tables
# ---------------------------------------------------------------------------


def _pieces(text: Column) -> Column:
    """A text as its runs of word characters and of others, in turn; joined they are the text."""
    return F.regexp_extract_all(text, F.lit(r"(?U)\w+|\W+"), F.lit(0))


def _hashes(pieces: Column) -> Column:
    return F.transform(pieces, lambda p: F.xxhash64(p))


def keyword_forms(dictionary: DataFrame, suffixes: Sequence[str] = D.KEYWORD_SUFFIXES) -> DataFrame:
    """``(form, label, keyword, label_at, at, opens, closes)``: each keyword, and with each suffix.

    ``dictionary`` has ``label`` and ``keyword`` and may have ``seq``, its order; without it labels and
    keywords are in code point order. ``opens`` and ``closes`` tell whether the form begins and ends with a
    word character: a form that does not needs one before or behind it.
    """
    listed = dictionary.select("label", "keyword", F.col("seq") if "seq" in dictionary.columns else F.lit(0).alias("seq"))
    once = listed.filter("label IS NOT NULL AND keyword <> ''").groupBy("label", "keyword").agg(F.min("seq").alias("at"))
    first = once.groupBy(F.col("label").alias("_label")).agg(F.min("at").alias("label_at"))
    ends = F.array(F.lit(""), *[F.lit(s) for s in suffixes])
    return (
        once.join(first, F.col("label") == F.col("_label"))
        .select("label", "keyword", "label_at", "at", F.explode(F.transform(ends, lambda s: F.concat("keyword", s))).alias("form"))
        .withColumn("opens", F.col("form").rlike(r"(?U)\A\w")).withColumn("closes", F.col("form").rlike(r"(?U)\w\z"))
    )


def keyword_hits_of_table(
    df: DataFrame, dictionary: DataFrame, key_col: str = "post_id", text_col: str | None = None,
    suffixes: Sequence[str] = D.KEYWORD_SUFFIXES,
) -> DataFrame:
    """``(key_col, keyword_hits)`` of the rows with hits, for a dictionary of any size.

    The same hits as ``keyword_hits`` gives for the dictionary as a mapping. Runs of pieces of a text
    that may be forms of keywords are written once and joined with the forms; a keyword held by very many
    texts is spread over all tasks. ``key_col`` is unique.
    """
    text = F.lower(F.coalesce(F.col(text_col or choose_text_column(df)), F.lit("")))
    forms = cut(keyword_forms(dictionary, suffixes), "keyword-forms")
    names = forms.select("form").distinct()
    pieces = add_once(df.select(F.col(key_col).alias("_key"), text.alias("_text")), _pieces=_pieces(F.col("_text")))
    start, size = F.shiftright("_run", 32).cast("int"), F.col("_run").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")

    def places(runs: Callable[[Column], Column]) -> DataFrame:
        found = pieces.filter(F.size("_pieces") > 0).select("_key", "_pieces", F.explode(runs(_hashes(F.col("_pieces")))).alias("_run"))
        return found.select(
            "_key", F.array_join(F.slice("_pieces", start + 1, size), "").alias("form"), (start == 0).alias("_first"),
            (start + size == F.size("_pieces")).alias("_last"),
        ).groupBy("_key", "form").agg(F.min("_first").alias("_first"), F.min("_last").alias("_last"), F.min(F.struct("_first", "_last")).alias("_both"))

    found = join_names(scan_names(names, _hashes(_pieces(F.col("form"))), True, places, "keyword-runs"), forms, "form")
    # a form of other characters at its edge needs a word character beyond it, so not the edge of the text
    edge = (
        F.when(F.col("opens") & F.col("closes"), True)
        .when(F.col("opens"), ~F.col("_last")).when(F.col("closes"), ~F.col("_first"))
        .otherwise(~F.col("_both._first") & ~F.col("_both._last"))
    )
    hits = found.filter(edge).groupBy("_key", "label", "label_at").agg(
        F.array_sort(F.collect_set(F.struct("at", "keyword"))).alias("found")
    )
    entry = F.struct("label_at", "label", F.col("found.keyword").alias("keywords"))
    return hits.groupBy(F.col("_key").alias(key_col)).agg(F.array_sort(F.collect_list(entry)).alias("_hits")).select(
        key_col, F.transform("_hits", lambda h: F.struct(h["label"].alias("label"), h["keywords"].alias("keywords"))).alias("keyword_hits")
    )


def with_keyword_hits_of_table(
    df: DataFrame, dictionary: DataFrame, key_col: str = "post_id", text_col: str | None = None, out_col: str = "keyword_hits",
    suffixes: Sequence[str] = D.KEYWORD_SUFFIXES,
) -> DataFrame:
    """``df`` with the hits of a dictionary table; an empty array where there are none."""
    hits = keyword_hits_of_table(df, dictionary, key_col, text_col, suffixes).select(F.col(key_col).alias("_k"), F.col("keyword_hits").alias("_hits"))
    none = F.array().cast(hits.schema["_hits"].dataType)
    kept = [df[c] for c in df.columns if c != out_col]
    return df.join(hits, df[key_col] == F.col("_k"), "left").select(*kept, F.coalesce("_hits", none).alias(out_col))


def base_label(label: Column) -> Column:
    """Label without its description in brackets, lower case."""
    return F.lower(F.split_part(label, F.lit(" ("), F.lit(1)))


def _priority(label: Column, priority: Sequence[str]) -> Column:
    """1-based place in the priority list, 0 when not in it."""
    return F.array_position(F.array(*[F.lit(p) for p in priority]), label)


def keyword_weighted_label(
    hits: Column, scores: Column, bonus: float = 0.02, priority: Sequence[str] = D.HAZARD_PRIORITY
) -> Column:
    """Best label among those with hits: score plus bonus per hit, hits, priority.

    A label outside the priority list cannot be ranked: the post becomes ``other``.
    """
    ranked = F.transform(
        hits,
        lambda h: F.struct(
            (F.coalesce(F.try_element_at(scores, h["label"]), F.lit(0.0))
             + F.lit(bonus) * F.size(h["keywords"])).alias("score"),
            F.size(h["keywords"]).alias("n"),
            (-_priority(h["label"], priority)).alias("rank"),
            h["label"].alias("label"),
        ),
    )
    return let(ranked, lambda r: F.when(
        F.exists(r, lambda h: h["rank"] == 0), F.lit(OTHER)
    ).otherwise(F.array_max(r)["label"]))


def model_only_label(
    scores: Column,
    threshold: float = 0.25,
    confidence_gap: float = 0.08,
    floor: float = 0.8,
    priority: Sequence[str] = D.HAZARD_PRIORITY,
) -> Column:
    """Best-scored label, or ``other`` when it is weak or not clearly ahead.

    A label outside the priority list cannot be ranked: the post becomes ``other``.
    """
    by_score = F.sort_array(F.map_values(scores), asc=False)
    top = F.try_element_at(by_score, F.lit(1))
    second = F.coalesce(F.try_element_at(by_score, F.lit(2)), F.lit(0.0))
    active = F.filter(
        F.transform(
            F.map_entries(scores),
            lambda e: F.struct(
                e["value"].alias("score"),
                (-_priority(e["key"], priority)).alias("rank"),
                e["key"].alias("label"),
            ),
        ),
        lambda e: e["score"] >= threshold,
    )
    unknown = F.exists(active, lambda e: e["rank"] == 0)
    return (
        F.when(top.isNull() | ((top - second) < confidence_gap) | (top < floor), OTHER)
        .when((F.size(active) == 0) | unknown, OTHER)
        .otherwise(F.array_max(active)["label"])
    )


# labels that are columns while the scores of a post are gathered; all others are rows
MOST_COLUMNS = 32


def _columns_of(priority: Sequence[str]) -> list[str]:
    return sorted(set(priority or D.HAZARD_PRIORITY))[:MOST_COLUMNS]


def _scores_by_post(scores: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``(post_id, _listed, _others)``: the lowest score of each label, one row per post.

    ``_listed`` has the scores of ``labels``, and a bit for each that is there; ``_others`` has
    ``{label, score}`` of all other labels. Rows of a post that lie together leave their task as one.
    """
    label = F.col("label")
    at = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in labels]), label), F.lit(0)).cast("int")
    placed = scores.select("post_id", base_label(label).alias("label"), "score").select("post_id", "label", "score", at.alias("_at"))
    lowest = [f"_s{i}" for i in range(len(labels))]
    per_label = (
        placed.groupBy("post_id", F.when(F.col("_at") == 0, label).alias("_other")).agg(
            F.bit_or(F.when(F.col("_at") > 0, F.expr("shiftleft(1L, _at - 1)")).otherwise(F.lit(0).cast("long"))).alias("_met"),
            *[F.min(F.when(F.col("_at") == i, F.col("score"))).alias(s) for i, s in enumerate(lowest, 1)],
            F.min(F.when(F.col("_at") == 0, F.col("score"))).alias("_score"),
            F.max(F.col("_at") == 0).alias("_is_other"),
        )
    )
    other = F.when(F.col("_is_other"), F.struct(F.col("_other").alias("label"), F.col("_score").alias("score")))
    return per_label.groupBy("post_id").agg(
        F.bit_or("_met").alias("_met"), *[F.min(s).alias(s) for s in lowest], F.collect_list(other).alias("_others")
    ).select("post_id", F.struct(F.col("_met").alias("met"), F.array(*lowest).alias("scores")).alias("_listed"), "_others")


def _as_map(listed: Column, others: Column, labels: Sequence[str]) -> Column:
    """The scores of ``_scores_by_post`` as a map in the order of the labels."""
    entries = F.array(*[F.struct(F.lit(x).alias("label"), listed["scores"][i].alias("score")) for i, x in enumerate(labels)])
    bits = F.array(*[F.lit(1 << i).cast("long") for i in range(len(labels))])
    here = F.filter(entries, lambda e, i: listed["met"].bitwiseAND(F.get(bits, i)) != 0)
    return F.map_from_entries(F.when(F.size(others) == 0, here).otherwise(F.sort_array(F.concat(here, others))))


def score_map(scores: DataFrame) -> DataFrame:
    """``(post_id, label, score)`` rows as one map per post, base labels as keys.

    Of two labels with one base name the lower score counts: a classifier lists its
    labels by falling score, and the later one replaces the earlier.
    """
    labels = _columns_of(D.HAZARD_PRIORITY)
    return _scores_by_post(scores, labels).select("post_id", _as_map(F.col("_listed"), F.col("_others"), labels).alias("_scores"))


def classify(
    df: DataFrame,
    scores: DataFrame | None = None,
    dictionary: Mapping[str, Sequence[str]] = D.HAZARD_KEYWORDS,
    threshold: float = 0.25,
    confidence_gap: float = 0.08,
    floor: float = 0.8,
    bonus: float = 0.02,
    priority: Sequence[str] = D.HAZARD_PRIORITY,
    text_col: str | None = None,
) -> DataFrame:
    """Adds ``disaster_type``, ``keyword_hits`` and ``label_scores``.

    Without a score table every score counts as 0, so keywords alone decide.
    """
    hit = with_keyword_hits(df, text_col, dictionary)
    none = F.create_map().cast("map<string,double>")
    if scores is None:
        scored = hit.withColumn("label_scores", none)
    else:
        # As columns until the join is done: a map of every post would be sorted for it. Merged, as Catalyst's
        # estimate of labels unfolded from one row is that row's, and would send the scores of all posts to the driver.
        labels = _columns_of(priority)
        scored = (
            hit.join(_scores_by_post(scores, labels).hint("merge"), "post_id", "left")
            .withColumn("label_scores", F.when(F.col("_listed").isNull(), none).otherwise(_as_map(F.col("_listed"), F.col("_others"), labels)))
            .drop("_listed", "_others")
        )
    hits, label_scores = F.col("keyword_hits"), F.col("label_scores")
    return add_once(
        scored,
        disaster_type=F.when(
            F.size(hits) > 0, keyword_weighted_label(hits, label_scores, bonus, priority)
        ).otherwise(model_only_label(label_scores, threshold, confidence_gap, floor, priority)),
    )


def score_batches(
    df: DataFrame,
    make_predictor: Callable[[], Callable[[list[str], list[str]], list[list[float]]]],
    labels: Sequence[str] = tuple(D.HAZARD_LABELS),
    batch: int = 16,
    text_col: str = "text_content",
) -> DataFrame:
    """``(post_id, label, score)`` from a caller's model, loaded once per task."""
    labels = list(labels)

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        predict = make_predictor()
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start:start + batch]
                rows = predict(part["text"].tolist(), labels)
                yield pd.DataFrame({
                    "post_id": part["post_id"].repeat(len(labels)).to_numpy(),
                    "label": labels * len(part),
                    "score": [float(s) for row in rows for s in row],
                })

    texts = df.select("post_id", F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInPandas(run, "post_id bigint, label string, score double")


def label_counts(df: DataFrame, label_col: str = "disaster_type") -> DataFrame:
    return (
        df.groupBy(label_col)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), label_col)
    )


def drop_other(df: DataFrame, label_col: str = "disaster_type") -> DataFrame:
    return df.filter(F.col(label_col) != OTHER)


def render_scores(scores: Column) -> Column:
    return F.to_json(scores)


def render_hits(hits: Column) -> Column:
    """``label:word|word, label:word``"""
    return F.array_join(
        F.transform(
            hits, lambda h: F.concat(h["label"], F.lit(":"), F.array_join(h["keywords"], "|"))
        ),
        ", ",
    )
