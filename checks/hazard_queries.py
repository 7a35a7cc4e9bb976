"""Keyword hits, hazard labels and score tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.text_queries import lit, sql_clean
from stormledger import dictionaries as D
from stormledger.operators import cleaning as C
from stormledger.operators import hazard as H
from stormledger.operators.exact_duplicates import drop_exact_duplicates
from stormledger.sources.snapshots import load_scores

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


# words of the given texts, nested and overlapping like the default dictionary
CORPUS_WORDS = {
    "english": ["the", "and of", "that", "on the", "the the", "for", "inon"],
    "french": ["que", "le", "ou", "eau", "éçon", "on le"],
    "german": ["und", "der", "ein", "sch", "und der"],
    "shared": ["the", "le", "on"],
}
_EDGE = r"[^\p{L}\p{M}\p{N}_]"


def _escape(word: str) -> str:
    return "".join(c if c.isalnum() or c in " _" else "\\" + c for c in word)


def sql_hits(source: str, key: str, dictionary) -> str:
    """``(key, label, lpos, kpos, kw)`` of every keyword found in ``text``; one pattern per branch."""
    found = " UNION ALL ".join(
        f"SELECT {key}, {lit(label)} AS label, {i} AS lpos, {j} AS kpos, {lit(kw)} AS kw FROM low "
        f"WHERE contains(t, {lit(kw)}) AND regexp_matches(t, {lit(f'(^|{_EDGE}){_escape(kw)}(s|es|ing|ed)?($|{_EDGE})')})"
        for i, (label, kws) in enumerate(dictionary.items()) for j, kw in enumerate(kws)
    )
    return f"WITH low AS MATERIALIZED (SELECT {key}, lower(text) AS t FROM ({source})) {found}"


def sql_rendered(source: str, key: str, dictionary) -> str:
    return f"""
SELECT s.{key}, coalesce(r.hits, '') AS hits FROM ({source}) s LEFT JOIN (
  SELECT {key}, string_agg(concat(label, ':', kws), ', ' ORDER BY lpos) AS hits FROM (
    SELECT {key}, label, lpos, string_agg(kw, '|' ORDER BY kpos) AS kws
    FROM ({sql_hits(source, key, dictionary)}) GROUP BY 1, 2, 3) GROUP BY 1) r ON s.{key} = r.{key}"""


@query("keyword_hits_of_posts", sql_rendered(f"SELECT post_id, text FROM ({V.POSTS})", "post_id", D.HAZARD_KEYWORDS))
def _(spark, d):
    hit = H.with_keyword_hits(V.posts(spark, d), "text")
    return hit.select("post_id", H.render_hits(F.col("keyword_hits")).alias("hits"))


@query("keyword_hits_of_documents", sql_rendered("SELECT doc_id, text FROM documents", "doc_id", CORPUS_WORDS))
def _(spark, d):
    hit = H.with_keyword_hits(V.texts(spark, d), "text", CORPUS_WORDS)
    return hit.select("doc_id", H.render_hits(F.col("keyword_hits")).alias("hits"))


# a dictionary as a table: names of parts and benchmark openings in documents, of places in posts
KEYWORDS = """
SELECT p_type AS label, p_name AS keyword, min(p_partkey) AS seq FROM part GROUP BY p_type, p_name
UNION ALL SELECT concat('item ', CAST(item_id % 7 AS STRING)), trim(translate(lower(concat(split_part(text, ' ', 1), ' ', split_part(text, ' ', 2))), '.,', '  ')), min(1000000 + item_id) FROM benchmark GROUP BY 1, 2
UNION ALL SELECT 'sitio', concat('sitio ', CAST(p_partkey AS STRING)), min(2000000 + p_partkey) FROM part GROUP BY 1, 2
UNION ALL SELECT 'town', concat('town ', CAST(s_suppkey AS STRING)), min(2000000 - s_suppkey) FROM supplier GROUP BY 1, 2
UNION ALL SELECT concat('in ', CAST(n_nationkey % 3 AS STRING)), concat('nation ', CAST(n_nationkey AS STRING)), min(n_nationkey) FROM nation GROUP BY 1, 2
"""


def sql_table_hits(source: str, key: str) -> str:
    """Labels and keywords of a dictionary table found in ``text``, rendered, in the table's order."""
    escaped = "regexp_replace(keyword, '([^\\p{L}\\p{N}_ ])', '\\\\\\1', 'g')"
    return f"""
WITH low AS MATERIALIZED (SELECT {key}, lower(text) AS t FROM ({source})), kw AS MATERIALIZED ({KEYWORDS}),
met AS MATERIALIZED (SELECT {key}, label, keyword, seq FROM low JOIN kw ON contains(t, keyword)
  WHERE regexp_matches(t, concat('(^|{_EDGE})', {escaped}, '(s|es|ing|ed)?($|{_EDGE})')))
SELECT {key}, string_agg(concat(label, ':', kws), ', ' ORDER BY label_at, label) AS hits FROM (
  SELECT {key}, label, label_at, string_agg(keyword, '|' ORDER BY seq, keyword) AS kws
  FROM met JOIN (SELECT label, min(seq) AS label_at FROM kw GROUP BY label) USING (label) GROUP BY 1, 2, 3) GROUP BY 1"""


@query("keyword_table_hits_of_posts", sql_table_hits(f"SELECT post_id, text FROM ({V.POSTS})", "post_id"))
def _(spark, d):
    hits = H.keyword_hits_of_table(V.posts(spark, d), V.view(spark, d, KEYWORDS), "post_id", "text")
    return hits.select("post_id", H.render_hits(F.col("keyword_hits")).alias("hits"))


@query("keyword_table_hits_of_documents", sql_table_hits("SELECT doc_id, text FROM documents", "doc_id"))
def _(spark, d):
    hits = H.keyword_hits_of_table(V.texts(spark, d), V.view(spark, d, KEYWORDS), "doc_id", "text")
    return hits.select("doc_id", H.render_hits(F.col("keyword_hits")).alias("hits"))


def _priority_sql(expr: str) -> str:
    arms = " ".join(f"WHEN {lit(p)} THEN {i}" for i, p in enumerate(D.HAZARD_PRIORITY))
    return f"(CASE {expr} {arms} END)"


_POSTS = f"SELECT post_id, text FROM ({V.POSTS})"


def _base(scores: str) -> str:
    return f"SELECT post_id, lower(split_part(label, ' (', 1)) AS label, score FROM ({scores})"


_BASE, _ALL_BASE = _base(V.SCORES), _base(V.ALL_SCORES)


def _by_keyword(scores: str, posts: str = _POSTS) -> str:
    hits = f"SELECT post_id, label, count(*) AS n FROM ({sql_hits(posts, 'post_id', D.HAZARD_KEYWORDS)}) GROUP BY 1, 2"
    return f"""
SELECT post_id, label AS disaster_type FROM (
  SELECT h.post_id, h.label, row_number() OVER (PARTITION BY h.post_id ORDER BY
      coalesce(s.score, CAST(0 AS DOUBLE)) + CAST(0.02 AS DOUBLE) * h.n DESC, h.n DESC, {_priority_sql('h.label')}) AS r
  FROM ({hits}) h LEFT JOIN ({scores}) s ON h.post_id = s.post_id AND h.label = s.label) WHERE r = 1"""


def _by_model(base: str) -> str:
    return f"""
SELECT post_id, CASE WHEN top - coalesce(second, 0) < CAST(0.08 AS DOUBLE) OR top < CAST(0.8 AS DOUBLE) OR top < CAST(0.25 AS DOUBLE)
  THEN 'other' ELSE best END AS disaster_type
FROM (SELECT post_id, max(CASE WHEN r = 1 THEN score END) AS top, max(CASE WHEN r = 2 THEN score END) AS second,
    max(CASE WHEN r = 1 THEN label END) AS best
  FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY score DESC, {_priority_sql('label')}) AS r FROM ({base}))
  GROUP BY 1)"""


_BY_MODEL = _by_model(_BASE)


def sql_classified(posts: str) -> str:
    return f"""
SELECT p.post_id, coalesce(k.disaster_type, m.disaster_type, 'other') AS disaster_type FROM ({posts}) p
LEFT JOIN ({_by_keyword(_BASE, posts)}) k ON p.post_id = k.post_id LEFT JOIN ({_BY_MODEL}) m ON p.post_id = m.post_id"""


_CLASSIFIED = sql_classified(_POSTS)
_NO_SCORES = "SELECT CAST(NULL AS bigint) AS post_id, '' AS label, CAST(0 AS double) AS score"
_KEYWORDS_ONLY = f"""
SELECT p.post_id, coalesce(k.disaster_type, 'other') AS disaster_type FROM ({_POSTS}) p
LEFT JOIN ({_by_keyword(_NO_SCORES)}) k ON p.post_id = k.post_id"""


@query("classify_with_scores", _CLASSIFIED)
def _(spark, d):
    return H.classify(V.posts(spark, d), load_scores(V.scores(spark, d)), text_col="text").select(
        "post_id", "disaster_type"
    )


@query("classify_by_keywords", _KEYWORDS_ONLY)
def _(spark, d):
    return H.classify(V.posts(spark, d), text_col="text").select("post_id", "disaster_type")


@query("model_only_label", _by_model(_ALL_BASE))
@query("model_only_label_of_all_orders", _by_model(_ALL_BASE))
def _(spark, d):
    maps = H.score_map(V.all_scores(spark, d))
    return maps.select("post_id", H.model_only_label(F.col("_scores")).alias("disaster_type"))


@query("base_label_counts", f"SELECT label, count(*) AS n_rows, max(score) AS top FROM ({_ALL_BASE}) GROUP BY 1")
@query("base_label_counts_of_all_orders", f"SELECT label, count(*) AS n_rows, max(score) AS top FROM ({_ALL_BASE}) GROUP BY 1")
def _(spark, d):
    return (
        V.all_scores(spark, d).groupBy(H.base_label(F.col("label")).alias("label"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.max("score").alias("top"))
    )


@query("label_counts", f"SELECT disaster_type, count(*) AS n_rows FROM ({_CLASSIFIED}) GROUP BY 1")
def _(spark, d):
    return H.label_counts(H.classify(V.posts(spark, d), V.scores(spark, d), text_col="text"))


@query("drop_other", f"SELECT post_id, disaster_type FROM ({_KEYWORDS_ONLY}) WHERE disaster_type <> 'other'")
def _(spark, d):
    return H.drop_other(H.classify(V.posts(spark, d), text_col="text")).select("post_id", "disaster_type")


@query("render_scores", f"""
SELECT post_id, concat('{{', string_agg(concat('"', label, '":', CAST(score AS STRING)), ',' ORDER BY label), '}}') AS scores
FROM (SELECT doc_id AS post_id, CASE x WHEN 0 THEN 'quality' ELSE 'toxic' END AS label,
    CAST(CASE x WHEN 0 THEN quality ELSE toxic END AS double) AS score
  FROM labels, (VALUES (0), (1)) t(x)) GROUP BY 1""")
def _(spark, d):
    labels = V.table(spark, d, "labels")
    long = labels.select(
        F.col("doc_id").alias("post_id"),
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("label"), F.col(c).cast("double").alias("score")) for c in ("quality", "toxic")
        ])).alias("s"),
    ).select("post_id", "s.*")
    return H.score_map(long).select("post_id", H.render_scores(F.col("_scores")).alias("scores"))


_BATCH_LABELS = ["calm", "windy", "wet"]




@query("score_batches", f"""
SELECT doc_id AS post_id, label, CAST(length(text) % 97 + i AS DOUBLE) / 100 AS score
FROM documents, (VALUES {', '.join(f"({lit(x)}, {i})" for i, x in enumerate(_BATCH_LABELS))}) t(label, i)""")
def _(spark, d):
    docs = V.texts(spark, d).select(F.col("doc_id").alias("post_id"), "text")

    # built here so that it travels to the workers by value
    def make():
        def predict(texts, labels):
            return [[(len(t) % 97 + i) / 100 for i in range(len(labels))] for t in texts]

        return predict

    return H.score_batches(docs, make, _BATCH_LABELS, text_col="text")


_CLEAN = f"""
SELECT post_id, text FROM (SELECT post_id, text, row_number() OVER (PARTITION BY text ORDER BY post_id) AS n
  FROM (SELECT post_id, {sql_clean('text', 40)} AS text FROM ({V.POSTS})) WHERE trim(text) <> '') WHERE n = 1"""
_CLEAN_HITS = f"SELECT post_id, label, count(*) AS n FROM ({sql_hits(_CLEAN, 'post_id', D.HAZARD_KEYWORDS)}) GROUP BY 1, 2"


@query("hazard_counts_of_cleaned_posts", f"""
SELECT disaster_type, count(*) AS n_rows FROM (
  SELECT c.post_id, coalesce(k.label, 'other') AS disaster_type FROM ({_CLEAN}) c LEFT JOIN (
    SELECT post_id, label, row_number() OVER (PARTITION BY post_id ORDER BY n DESC, {_priority_sql('label')}) AS r
    FROM ({_CLEAN_HITS})) k ON c.post_id = k.post_id AND k.r = 1) GROUP BY 1""")
def _(spark, d):
    """Clean, deduplicate, label by keywords, count."""
    cleaned = C.drop_empty(C.clean_posts(V.posts(spark, d), 40)).select("post_id", "text_content")
    return H.label_counts(H.classify(drop_exact_duplicates(cleaned, "text_content", ["post_id"])))
