"""Text cleaning, filters, page sources and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from stormledger import dictionaries as D
from stormledger.functions import similarity as S
from stormledger.functions import text as X
from stormledger.operators import cleaning as C
from stormledger.operators import near_duplicates as N
from stormledger.operators.exact_duplicates import drop_exact_duplicates
from stormledger.plans.cleaning import cleaning_steps, run_cleaning
from stormledger.sources.gazetteer import location_vocab

QUERIES, ORACLE = {}, {}

# white space of Unicode texts, spelled out for an engine whose \s is ASCII only
SQL_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SQL_NOT_WS = SQL_WS.replace("[", "[^", 1)
SQL_WORD = r"[\p{L}\p{M}\p{N}_]"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(expr: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(to)}, 'g')"


def sql_collapse(expr: str) -> str:
    return f"trim({sub(expr, SQL_WS + '+', ' ')})"


def sql_norm(expr: str) -> str:
    return sql_collapse(f"lower({expr})")


def sql_clean(expr: str, min_len: int = 90) -> str:
    """The cleaning stages as nested SQL."""
    out = f"CASE WHEN trim(lower({expr})) IN ('', 'nan', 'none') THEN '' ELSE {expr} END"
    out = f"strip_accents({out})"
    out = sub(out, rf"https?://{SQL_NOT_WS}+|www\.{SQL_NOT_WS}+")
    out = sub(out, r"<[^\n]*?>")
    out = sub(out, rf"&{SQL_WORD}+;")
    out = sub(out, r"[-=*_]{3,}", " ")
    out = sub(out, rf"(\.{SQL_WS}*){{3,}}", " ")
    out = sub(out, r"[^\x00-\x7F]")
    out = f"lower({sql_collapse(out)})"
    out = sub(out, "(?i)(shared a post|see more|commented|replied)")
    return (
        f"(SELECT CASE WHEN length(z) < {min_len} OR regexp_full_match(z, '[. ]+') "
        f"OR regexp_full_match(z, '([0-9:/.-]|\\s){{6,}}') THEN '' ELSE z END FROM (SELECT {out} AS z))"
    )


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


# -- cleaning stages ---------------------------------------------------------
@query("clean_text", f"SELECT doc_id, {sql_clean('text')} AS text_content FROM documents")
def _(spark, d):
    docs = V.texts(spark, d)
    return docs.select("doc_id", X.clean_text(F.col("text")).alias("text_content"))


@query("clean_html_text", f"SELECT page_id, {sql_clean('html', 40)} AS text_content FROM pages")
def _(spark, d):
    pages = V.texts(spark, d, "pages")
    return pages.select("page_id", X.clean_text(F.col("html"), 40).alias("text_content"))


@query("fold_unicode", "SELECT doc_id, strip_accents(text) AS folded FROM documents")
def _(spark, d):
    return V.texts(spark, d).select("doc_id", X.fold_unicode(F.col("text")).alias("folded"))


_NOISY = (
    "concat(CASE doc_id % 6 WHEN 0 THEN 'https://a.b/' WHEN 1 THEN 'www.x.y ' WHEN 2 THEN '<b>' "
    "WHEN 3 THEN '&amp;' WHEN 4 THEN '====' ELSE '. . . .' END, text, "
    "' Shared a post See More. - -- --- <i> x </i> &nbsp; *** ... ..')"
)


@query("strip_noise_stages", f"""
SELECT doc_id, {sub('t', rf"https?://{SQL_NOT_WS}+|www[.]{SQL_NOT_WS}+")} AS no_urls, {sub('t', r"<[^\n]*?>")} AS no_tags,
  {sub('t', rf"&{SQL_WORD}+;")} AS no_entities, {sub('t', r"[-=*_]{3,}", " ")} AS no_separators,
  {sub('t', rf"(\.{SQL_WS}*){{3,}}", " ")} AS no_dots, {sub('t', r"[^\x00-\x7F]")} AS ascii_only,
  {sub('t', "(?i)(shared a post|see more|commented|replied)")} AS no_boilerplate
FROM (SELECT doc_id, {_NOISY} AS t FROM documents)""")
def _(spark, d):
    t = F.col("t")
    return V.texts(spark, d).select("doc_id", F.expr(_NOISY).alias("t")).select(
        "doc_id", X.strip_urls(t).alias("no_urls"), X.strip_tags(t).alias("no_tags"),
        X.strip_entities(t).alias("no_entities"), X.blank_separators(t).alias("no_separators"),
        X.blank_dot_runs(t).alias("no_dots"), X.drop_non_ascii(t).alias("ascii_only"),
        X.strip_boilerplate(t).alias("no_boilerplate"),
    )


# whole texts, and beside them rows on the border of each gate
_GATED = """SELECT doc_id, text AS t FROM documents
UNION ALL SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN ' NaN ' WHEN 1 THEN 'none' WHEN 2 THEN '' WHEN 3 THEN '2025-10-27 21:39'
  WHEN 4 THEN '. . .' WHEN 5 THEN substring(text, 1, 89) ELSE substring(text, 1, 90) END FROM documents"""


@query("text_gates", f"""
SELECT doc_id, CASE WHEN trim(lower(t)) IN ('', 'nan', 'none') THEN '' ELSE t END AS not_placeholder,
  CASE WHEN length(t) < 90 OR regexp_full_match(t, '[. ]+') THEN '' ELSE t END AS long_enough,
  CASE WHEN regexp_full_match(t, '([0-9:/.-]|\\s){{6,}}') THEN '' ELSE t END AS not_numeric
FROM ({_GATED})""")
def _(spark, d):
    t = F.col("t")
    return V.view(spark, d, _GATED).select(
        "doc_id", X.blank_placeholders(t).alias("not_placeholder"),
        X.quality_gate(t).alias("long_enough"), X.numeric_gate(t).alias("not_numeric"),
    )


_BLANKS = """SELECT doc_id, text FROM documents UNION ALL
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN CAST(NULL AS STRING) WHEN doc_id % 3 = 1 THEN concat('  ', chr(10), ' ') ELSE 'x ' END FROM documents"""


@query("drop_empty_texts", f"""
SELECT doc_id, t AS text_content FROM (SELECT doc_id, coalesce(text, '') AS t FROM ({_BLANKS})) WHERE NOT regexp_full_match(t, '{SQL_WS}*')""")
def _(spark, d):
    docs = V.view(spark, d, _BLANKS)
    chosen = docs.select("doc_id", C.choose_text(docs).alias("text_content"))
    return C.drop_empty(chosen)


# -- place filter, sources, output columns ----------------------------------
# words of the given texts stand in for place names
PLACE_WORDS = ["thwhesou", "queaux", "Éç", "inonble thinly", "ph", "onthti"]


_VOCAB_SQL = (
    "SELECT lower(trim(n_name)) AS w FROM nation UNION SELECT lower(trim(r_name)) FROM region"
    + "".join(f" UNION SELECT {lit(w)}" for w in PLACE_WORDS)
)


def _vocab(spark, d):
    names = V.table(spark, d, "nation").select(F.lower(F.trim("n_name")).alias("name")).union(
        V.table(spark, d, "region").select(F.lower(F.trim("r_name")))
    )
    return names.union(spark.createDataFrame([(w,) for w in PLACE_WORDS], "name string")).distinct()


@query("mentions_location", f"""
SELECT doc_id FROM documents
WHERE EXISTS (SELECT 1 FROM ({_VOCAB_SQL}) v WHERE contains(lower(text), v.w))""")
def _(spark, d):
    return C.mentions_location(V.texts(spark, d), _vocab(spark, d), "text").select("doc_id")


@query("mentions_location_long_list", f"""
SELECT doc_id FROM documents
WHERE EXISTS (SELECT 1 FROM ({_VOCAB_SQL} UNION SELECT lower(p_name) FROM part UNION SELECT lower(trim(text)) FROM benchmark) v
  WHERE contains(lower(text), v.w))""")
def _(spark, d):
    """A list of thousands of whole names and passages."""
    names = _vocab(spark, d).union(V.table(spark, d, "part").select(F.lower("p_name"))).union(
        V.table(spark, d, "benchmark").select(F.lower(F.trim("text")))
    )
    return C.mentions_location(V.texts(spark, d), names, "text").select("doc_id")


_JUNK = """
SELECT doc_id, concat(text, ' ', CASE doc_id % 5 WHEN 0 THEN repeat('.', 20000) WHEN 1 THEN repeat('. ', 20000)
  WHEN 2 THEN repeat('7', 20000) WHEN 3 THEN repeat('-', 20000) ELSE repeat('1:2 ', 20000) END, ' end') AS text FROM documents
UNION ALL SELECT -1 - doc_id, repeat(CASE doc_id % 3 WHEN 0 THEN '. ' WHEN 1 THEN '7' ELSE '2025-10-27 ' END, 20000) FROM documents"""


@query("clean_junk_runs", f"SELECT doc_id, {sql_clean('text')} AS text_content FROM ({_JUNK})")
def _(spark, d):
    return V.view(spark, d, _JUNK).select("doc_id", X.clean_text(F.col("text")).alias("text_content"))


_HOSTS = ("example.com", "example.net")
_HOST_RE = r"(?:example[.]com|example[.]net)"


def sql_page(url: str, host: str) -> str:
    """Page handle without look-ahead: later matches of the host are tried in turn."""
    part = r"([^/?#\s]+)"
    return (
        f"CASE WHEN regexp_matches({url}, '{host}/hashtag/{part}') "
        f"THEN concat('#', lower(regexp_extract({url}, '{host}/hashtag/{part}', 1))) "
        f"ELSE (SELECT trim(lower(p), '.@/') FROM (SELECT unnest(regexp_extract_all({url}, '{host}/{part}', 1)) AS p) "
        "WHERE NOT regexp_matches(p, '^(hashtag|watch|reel)') LIMIT 1) END"
    )


@query("page_source_of_urls", f"SELECT page_id, {sql_page('url', _HOST_RE)} AS page_source FROM pages")
def _(spark, d):
    pages = V.table(spark, d, "pages")
    return pages.select("page_id", C.page_source(F.col("url"), _HOSTS, {}).alias("page_source"))


def _sql_names() -> str:
    return " UNION ALL ".join(f"SELECT {lit(h)} AS handle, {lit(n)} AS name" for h, n in D.SOURCE_NAMES.items())


_POST_HOST = r"(?:facebook[.]com|x[.]com)"
_SOURCED = f"""
SELECT s.post_id, s.text, coalesce(n.name, s.h) AS page_source
FROM (SELECT post_id, text, {sql_page('post_url', _POST_HOST)} AS h FROM ({V.POSTS})) s
LEFT JOIN ({_sql_names()}) n ON s.h = n.handle"""


@query("page_source_of_posts", f"SELECT post_id, page_source FROM ({_SOURCED})")
def _(spark, d):
    return V.posts(spark, d).select("post_id", C.page_source(F.col("post_url")).alias("page_source"))


@query("source_name_join", f"""
SELECT c_custkey, coalesce(n.n_name, h) AS shown FROM (
  SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN concat('#', c_mktsegment) ELSE concat('NATION_', CAST(c_custkey % 40 AS STRING)) END AS h
  FROM customer) c LEFT JOIN (SELECT n_name AS handle, concat('Nation desk ', CAST(n_nationkey AS STRING)) AS n_name FROM nation) n
ON c.h = n.handle AND NOT starts_with(h, '#')""")
def _(spark, d):
    names = V.table(spark, d, "nation").select(
        F.col("n_name").alias("handle"), F.expr("concat('Nation desk ', n_nationkey)").alias("name")
    )
    handles = V.table(spark, d, "customer").select("c_custkey", F.expr(
        "CASE WHEN c_custkey % 4 = 0 THEN concat('#', c_mktsegment) ELSE concat('NATION_', c_custkey % 40) END"
    ).alias("h"))
    return C.source_name(handles, names, "h", "shown").select("c_custkey", "shown")


@query("keep_trusted_or_local", f"""
SELECT post_id, page_source FROM ({_SOURCED}) WHERE
  coalesce(lower(page_source) IN ({', '.join(lit(t) for t in D.TRUSTED_SOURCES)}), false)
  OR EXISTS (SELECT 1 FROM (SELECT lower(concat('nation ', CAST(n_nationkey AS STRING), ' ')) AS w FROM nation) v WHERE contains(lower(text), v.w))""")
def _(spark, d):
    posts = V.posts(spark, d).withColumn("page_source", C.page_source(F.col("post_url")))
    vocab = V.table(spark, d, "nation").select(F.expr("lower(concat('nation ', n_nationkey, ' '))").alias("name"))
    return C.keep_trusted_or_local(posts, vocab, text_col="text").select("post_id", "page_source")


@query("format_columns", f"""
SELECT source, text AS text_content, post_timestamp AS datetime, post_url AS url FROM ({V.POSTS})""")
def _(spark, d):
    posts = V.posts(spark, d).withColumn("text_content", F.col("text")).withColumn(
        "event_time_primary", F.col("post_timestamp")
    )
    return C.format_columns(C.format_columns(posts))


_CLEANED = f"SELECT doc_id, {sql_clean('text')} AS text_content FROM documents"
_FIRST = f"""
SELECT doc_id, text_content FROM (SELECT *, row_number() OVER (PARTITION BY text_content ORDER BY doc_id) AS n
  FROM ({_CLEANED}) WHERE trim(text_content) <> '') WHERE n = 1"""


@query("drop_exact_duplicates", _FIRST)
def _(spark, d):
    docs = C.clean_posts(V.texts(spark, d)).select("doc_id", "text_content")
    return drop_exact_duplicates(C.drop_empty(docs), "text_content", ["doc_id"])


@query("stage_counts", f"""
WITH c AS MATERIALIZED ({_CLEANED}),
k AS (SELECT text_content, count(*) AS n FROM c WHERE trim(text_content) <> '' GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM c) AS a, (SELECT count(*) FROM c WHERE trim(text_content) <> '') AS b,
  (SELECT count(*) FROM k) AS c3,
  (SELECT count(*) FROM k WHERE EXISTS (SELECT 1 FROM ({_VOCAB_SQL}) v WHERE contains(lower(text_content), v.w))) AS d4)
SELECT 0 AS step, 'input' AS stage, a AS rows_in, a AS rows_out, 0 AS dropped FROM n
UNION ALL SELECT 1, 'clean text', a, a, 0 FROM n
UNION ALL SELECT 2, 'drop empty', a, b, a - b FROM n
UNION ALL SELECT 3, 'drop exact duplicates', b, c3, b - c3 FROM n
UNION ALL SELECT 4, 'keep located', c3, d4, c3 - d4 FROM n""")
def _(spark, d):
    steps = cleaning_steps(_vocab(spark, d), "doc_id", near=False)
    steps.pop("page source")
    return C.stage_counts(V.texts(spark, d).select("doc_id", "text"), steps)


_POST_VOCAB = (
    'SELECT lower(trim("regDesc")) AS w FROM (' + V.REGIONS + ') UNION SELECT lower(trim("provDesc")) FROM (' + V.PROVINCES
    + ') UNION SELECT lower(trim("citymunDesc")) FROM (' + V.CITIES + ")"
    + "".join(f" UNION SELECT {lit(w)}" for w in D.EXTRA_PLACE_NAMES)
)


@query("cleaned_posts_exact", f"""
SELECT source, page_source, text_content, url FROM (
  SELECT *, row_number() OVER (PARTITION BY text_content ORDER BY post_id) AS n FROM (
    SELECT p.post_id, p.source, p.post_url AS url, {sql_clean('p.text', 40)} AS text_content, s.page_source
    FROM ({V.POSTS}) p JOIN ({_SOURCED}) s ON p.post_id = s.post_id) WHERE trim(text_content) <> '')
WHERE n = 1 AND EXISTS (SELECT 1 FROM ({_POST_VOCAB}) v WHERE contains(lower(text_content), v.w))""")
def _(spark, d):
    vocab = location_vocab(V.gazetteer(spark, d))
    return run_cleaning(V.posts(spark, d), vocab, "post_id", min_len=40, near=False)


# -- near duplicates ---------------------------------------------------------
_WORD_BITS = 60  # bits of a bit vector that one number holds
_FULL = (1 << _WORD_BITS) - 1


def sql_common(pairs: str) -> str:
    """``(k, common)``: longest common subsequence of ``a`` and ``b`` for rows ``(k, a, b)``.

    The usual recurrence over the characters of ``b``, a column at a time: bit i of ``v`` is cleared once
    the i-th character of ``a`` ends a longer common subsequence. Columns are lists of numbers; carries run through them.
    """
    return f"""
WITH pr AS MATERIALIZED ({pairs}),
ch AS (SELECT k, unnest(string_split(a, '')) AS c, generate_subscripts(string_split(a, ''), 1) - 1 AS i, (length(a) + {_WORD_BITS - 1}) // {_WORD_BITS} AS n FROM pr),
wd AS (SELECT k, c, n, i // {_WORD_BITS} AS w, bit_or(CAST(1 AS bigint) << CAST(i % {_WORD_BITS} AS int)) AS bits FROM ch GROUP BY k, c, n, w),
ms AS (SELECT k, map_from_entries(list((c, l))) AS m FROM (
  SELECT k, c, list_transform(range(0, any_value(n)), lambda j: coalesce(map_extract_value(map_from_entries(list((w, bits))), j), 0)) AS l FROM wd GROUP BY k, c) GROUP BY k)
SELECT k, CASE WHEN a = '' OR b = '' THEN 0 ELSE len(list_filter(string_split(list_aggregate(list_transform(
    list_reduce(string_split(b, ''), lambda v, c: CASE WHEN m[c] IS NULL THEN v ELSE
      list_reduce(range(1, len(v) + 1), lambda s, i: {{'c': (v[i] + (v[i] & m[c][i]) + s.c) >> {_WORD_BITS},
        'o': list_append(s.o, ((v[i] + (v[i] & m[c][i]) + s.c) & {_FULL}) | (v[i] - (v[i] & m[c][i])))}}, {{'c': CAST(0 AS bigint), 'o': CAST([] AS bigint[])}}).o END,
      list_transform(range(0, (length(a) + {_WORD_BITS - 1}) // {_WORD_BITS}), lambda x: CAST({_FULL} AS bigint))),
    lambda x: substring(CAST(CAST(x AS bit) AS varchar), {64 - _WORD_BITS + 1})), 'string_agg', ''), ''), lambda x: x = '0')) END AS common
FROM pr LEFT JOIN ms USING (k)"""


_KINDS = "abcdefghijklmnopqrstuvwxyz0123456789 "


def sql_near(rows: str, prefix: int = 97, full: int = 90) -> str:
    """``(idx, absorbed_by)`` by the sequential rule over rows ``(idx, text)``.

    Pairs are bounded by their lengths and by the letters they have not in common; all that are left are
    compared in full, beginnings first. One fold over the rows in order keeps the list of kept ones.
    """
    counts = ", ".join(f"length(p) - length(replace(p, '{c}', '')) AS c{i}" for i, c in enumerate(_KINDS))
    apart = " + ".join(f"abs(x.c{i} - y.c{i})" for i in range(len(_KINDS)))
    kept = "STRUCT(idx bigint, len bigint, c bigint)[]"
    gone = "STRUCT(idx bigint, absorbed_by bigint)[]"
    return f"""
WITH nt AS MATERIALIZED (SELECT CAST(idx AS bigint) AS idx, {sql_norm("coalesce(text, '')")} AS w FROM ({rows})),
ct AS MATERIALIZED (SELECT *, length(p) AS pl, {counts} FROM (
  SELECT min(idx) AS c, w, length(w) AS len, substring(w, 1, 300) AS p FROM nt GROUP BY w)),
cd AS MATERIALIZED (
  SELECT row_number() OVER () AS k, x.c AS ca, y.c AS cb, x.p AS pa, y.p AS pb, x.w AS wa, y.w AS wb FROM ct x JOIN (SELECT unnest(range(-18, 19)) AS d) o ON true
  JOIN ct y ON y.pl = x.pl + o.d AND x.c < y.c
  WHERE abs(x.len - y.len) * 100 <= (x.len + y.len) * {100 - full} AND abs(x.pl - y.pl) * 100 <= (x.pl + y.pl) * {100 - prefix}
    AND ({apart}) * 100 <= (x.pl + y.pl) * {100 - prefix}),
fp AS MATERIALIZED ({sql_common("SELECT k, pa AS a, pb AS b FROM cd")}),
s1 AS MATERIALIZED (SELECT cd.* FROM cd JOIN fp USING (k) WHERE (length(pa) + length(pb) - 2 * common) * 100 <= (length(pa) + length(pb)) * {100 - prefix}),
fw AS MATERIALIZED ({sql_common("SELECT k, wa AS a, wb AS b FROM s1")}),
ed AS (SELECT ca, cb FROM s1 JOIN fw USING (k) WHERE (length(wa) + length(wb) - 2 * common) * 100 <= (length(wa) + length(wb)) * {100 - full}),
nb AS (SELECT c, list(o) AS nb FROM (SELECT ca AS c, cb AS o FROM ed UNION ALL SELECT cb, ca FROM ed) GROUP BY c),
rw AS (SELECT list({{'idx': nt.idx, 'len': ct.len, 'c': ct.c, 'nb': list_append(coalesce(nb.nb, []), ct.c)}} ORDER BY nt.idx) AS l
  FROM nt JOIN ct USING (w) LEFT JOIN nb USING (c)
  WHERE nb.nb IS NOT NULL OR c IN (SELECT c FROM nt JOIN ct USING (w) GROUP BY c HAVING count(*) > 1)),
fd AS (SELECT list_reduce(l, lambda s, r: CASE
    WHEN len(list_filter(s.kept, lambda k: list_contains(r.nb, k.c))) = 0
      THEN {{'kept': list_append(s.kept, {{'idx': r.idx, 'len': r.len, 'c': r.c}}), 'gone': s.gone}}
    WHEN r.len < list_filter(s.kept, lambda k: list_contains(r.nb, k.c))[1].len
      THEN {{'kept': list_append(list_filter(s.kept, lambda k: k.idx <> list_filter(s.kept, lambda k: list_contains(r.nb, k.c))[1].idx), {{'idx': r.idx, 'len': r.len, 'c': r.c}}),
             'gone': list_append(s.gone, {{'idx': list_filter(s.kept, lambda k: list_contains(r.nb, k.c))[1].idx, 'absorbed_by': r.idx}})}}
    ELSE {{'kept': s.kept, 'gone': list_append(s.gone, {{'idx': r.idx, 'absorbed_by': list_filter(s.kept, lambda k: list_contains(r.nb, k.c))[1].idx}})}} END,
  {{'kept': CAST([] AS {kept}), 'gone': CAST([] AS {gone})}}) AS s FROM rw)
SELECT g.idx AS idx, g.absorbed_by AS absorbed_by FROM (SELECT unnest(s.gone) AS g FROM fd WHERE s IS NOT NULL)"""


_NEAR_DOCS = sql_near("SELECT doc_id AS idx, text FROM documents")


@query("normalize_for_compare", f"""
SELECT doc_id, {sql_norm('text')} AS whole, substring({sql_norm('text')}, 1, 300) AS prefix FROM documents""")
def _(spark, d):
    return V.texts(spark, d).select(
        "doc_id", N.normalize_for_compare(F.col("text")).alias("whole"),
        N.compare_prefix(F.col("text")).alias("prefix"),
    )


@query("drop_near_duplicates", f"""
SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT idx FROM ({_NEAR_DOCS}))""")
def _(spark, d):
    return N.drop_near_duplicates(V.texts(spark, d), "text", "doc_id").select("doc_id", "n_chars")


@query("near_duplicate_matches", f"SELECT idx AS doc_id, absorbed_by FROM ({_NEAR_DOCS})")
def _(spark, d):
    return N.near_duplicate_matches(V.texts(spark, d), "text", "doc_id")


_TURN_PAIRS = f"""
SELECT row_number() OVER () AS k, t.conv_id, t.turn, {sql_norm("coalesce(t.text, '')")} AS a, {sql_norm("coalesce(e.text, '')")} AS b
FROM conversations t JOIN conversations e ON t.conv_id = e.conv_id AND t.turn = e.turn + 1"""


@query("indel_ratio", f"""
WITH tp AS MATERIALIZED ({_TURN_PAIRS})
SELECT conv_id, turn, CASE WHEN length(a) + length(b) = 0 THEN CAST(100 AS double)
  ELSE (CAST(1 AS double) - CAST(length(a) + length(b) - 2 * common AS double) / (length(a) + length(b))) * CAST(100 AS double) END AS ratio
FROM tp JOIN ({sql_common("SELECT k, a, b FROM tp")}) USING (k)""")
def _(spark, d):
    """Similarity of each whole turn and the one before it."""
    turns = V.table(spark, d, "conversations").select("conv_id", "turn", "text")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("earlier"))
    return turns.join(before, ["conv_id", "turn"]).select(
        "conv_id", "turn",
        S.indel_ratio(N.normalize_for_compare(F.col("text")), N.normalize_for_compare(F.col("earlier"))).alias("ratio"),
    )


def sql_cleaned(posts: str, min_len: int) -> str:
    """``(post_id, source, page_source, text_content, url)`` of cleaned posts, exact and near duplicates dropped, that name a place."""
    return f"""
WITH fx AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text_content ORDER BY post_id) AS n FROM (
    SELECT p.post_id, p.source, p.post_url AS url, {sql_clean('p.text', min_len)} AS text_content, s.page_source
    FROM ({posts}) p JOIN ({_SOURCED}) s ON p.post_id = s.post_id) WHERE trim(text_content) <> '') WHERE n = 1)
SELECT post_id, source, page_source, text_content, url FROM fx
WHERE post_id NOT IN (SELECT idx FROM ({sql_near("SELECT post_id AS idx, text_content AS text FROM fx")}))
  AND EXISTS (SELECT 1 FROM ({_POST_VOCAB}) v WHERE contains(lower(text_content), v.w))"""


@query("cleaned_posts", f"SELECT source, page_source, text_content, url FROM ({sql_cleaned(V.POSTS, 40)})")
def _(spark, d):
    vocab = location_vocab(V.gazetteer(spark, d))
    return run_cleaning(V.posts(spark, d), vocab, "post_id", min_len=40)
