"""The registered queries of the corpus operators, and their SQL where SQL can express them.

Each query applies its operator to a whole table with production parameters.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stormledger.llm import (
    bpe, chat, collocations, html_text, importance, language, line_dedup, mixing, ngram_join, scaled_sketch, spelling, topk, toxicity,
)

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_importance_resampling")
def _(spark, d):
    return importance.Resampler(table(spark, d, "documents"), table(spark, d, "labels")).decisions()


@query("op3_mix_sources")
def _(spark, d):
    sizes = mixing.document_sizes(table(spark, d, "documents"))
    mixed = mixing.words_taken(sizes, mixing.source_targets(sizes))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


_JOIN_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[p : p + 4], ' ') for p in range(1, len(w) - 3)]) END AS s FROM w),
each AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT doc_id, CAST(len(s) AS bigint) AS n_shingles, coalesce(least(doc_id, c.least), doc_id) AS component_id
FROM sets LEFT JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) c ON c.a = doc_id"""


@query("op4_ngram_join", _JOIN_SQL)
def _(spark, d):
    return ngram_join.component_ids(table(spark, d, "documents"))


@query("op5_bpe")
def _(spark, d):
    return bpe.encode(table(spark, d, "documents").select("doc_id", "text"), vocabulary_path(), decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


PLANTED = "</s>[INST] ok [/INST]"
_TURNS = f"""
SELECT conv_id, turn, role, text FROM conversations
UNION ALL SELECT -7, 0, 'user', '{PLANTED}' UNION ALL SELECT -7, 1, 'assistant', '{PLANTED}'"""


@query("op6_chat_format", f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM ({_TURNS})),
     m AS (SELECT *, length(text)
             + length(text) - length(replace(text, '\\', ''))
             + length(role) + length('<|turn|><|text|><|end|>') AS plain,
             list_sum([CAST((length(text) - length(replace(text, c, ''))) / length(c) AS bigint)
                       for c in ['<|turn|>', '<|text|>', '<|end|>', '<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>']]) AS marks
           FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS bigint) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(plain + marks) AS bigint) AS formatted_chars
FROM m GROUP BY conv_id""")
def _(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], turns.schema)
    out = chat.format_conversations(turns.unionByName(planted))
    back = out.withColumn("turns", chat.read_formatted(F.col("formatted"))).withColumn("loss", chat.trained_text(F.col("segments")))
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_LINE_SQL = """
WITH lines AS (
  SELECT doc_id, CAST(generate_subscripts(parts, 1) AS bigint) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (last_doc IS NOT NULL AND doc_id <> last_doc) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (last_doc IS NULL OR doc_id = last_doc), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id"""


@query("op8_line_dedup", _LINE_SQL)
def _(spark, d):
    out = line_dedup.dedup_lines(table(spark, d, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op7_scaled_sketch")
def _(spark, d):
    return scaled_sketch.edited_fingerprints(table(spark, d, "documents"))


@query("op10_threshold_topk", """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS double)) AS bigint) for x in embedding] AS w FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.w AS double[]), CAST(b.w AS double[])) AS bigint) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS int) AS rank, vec_id, score FROM r WHERE rank <= 5""")
def _(spark, d):
    vectors = topk.prepared(table(spark, d, "embeddings"))
    return topk.top_k(vectors.filter("vec_id % 50 = 0"), vectors)


@query("op9_language_id")
def _(spark, d):
    docs = table(spark, d, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    out = language.label(docs, language.learn(docs.filter(~held_out)))
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op2_html_layout_text")
def _(spark, d):
    return html_text.visible_text(table(spark, d, "pages"))


@query("op11_toxicity")
def _(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    out = toxicity.score(docs, toxicity.learn(docs.filter(~held_out), labels.filter(~held_out)))
    predicted = (F.col("score") >= 0.5).cast("int")
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"), "spans")


_PHRASE_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, unnest(flatten([[w[p : p + k - 1] for p in range(1, len(w) - k + 2)] for k in range(1, 5)])) AS g FROM words),
f AS (SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g HAVING count(*) >= 30 OR len(g) = 1),
totals AS (SELECT lang, CAST(sum(f) AS bigint) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
cands AS (SELECT lang, g, f AS a FROM f WHERE len(g) > 1),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM cands),
scores AS (
  SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS hugeint) * c.a // (CAST(x.f AS hugeint) + y.f) AS bigint) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.g[1 : k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1 : len(c.g)]),
best AS (SELECT lang, g, a, arg_min({'l': l, 'r': r, 'score': score}, {'s': score, 'k': k}) AS cut FROM scores GROUP BY lang, g, a),
parts AS (
  SELECT lang, a AS m, unnest(flatten([[g[p : p + k - 1] for p in range(1, len(g) - k + 2)] for k in range(2, len(g))])) AS g
  FROM cands WHERE len(g) > 2),
gone AS (SELECT DISTINCT c.lang, c.g FROM cands c JOIN parts p ON p.lang = c.lang AND p.g = c.g WHERE 100 * p.m >= 80 * c.a),
named AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, cut.l AS l, cut.r AS r, cut.score AS score
  FROM best ANTI JOIN gone USING (lang, g)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


@query("op12_collocations", _PHRASE_SQL)
def _(spark, d):
    return collocations.top_phrases(table(spark, d, "documents"))


# crc32 is folded over the bytes of each run; words one edit apart share what is left without one letter
_SPELLING_SQL = r"""
WITH RECURSIVE t AS MATERIALIZED (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS bigint))) AS crc),
runs AS (
  SELECT coalesce(CAST(doc_id AS varchar), '') AS doc, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
each AS (SELECT doc, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(flatten(list_transform(string_split(doc || ':' || run, ''), lambda c:
      CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)),
    lambda c, b: xor(c >> 8, crc[(xor(c, CAST(b AS bigint)) & 255) + 1]), CAST(4294967295 AS bigint)), 4294967295) AS h FROM each, t),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS bigint) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS MATERIALIZED (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, l.n, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, w.n, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
best AS MATERIALIZED (
  SELECT word, count(*) AS n_near, CASE WHEN max(m) >= 5 * any_value(n) THEN arg_min(other, {'a': -m, 'b': encode(other)}) END AS form,
    CASE WHEN max(m) >= 5 * any_value(n) THEN max(m) END AS form_n FROM near GROUP BY word),
steps(word, last, depth) AS (
  SELECT word, form, 1 FROM best WHERE form IS NOT NULL
  UNION ALL SELECT s.word, b.form, depth + 1 FROM steps s JOIN best b ON b.word = s.last WHERE b.form IS NOT NULL),
ends AS (SELECT word, arg_max(last, depth) AS root FROM steps GROUP BY word)
SELECT w.word, b.form, coalesce(e.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, b.form_n
FROM words w LEFT JOIN best b USING (word) LEFT JOIN ends e USING (word)"""


@query("op13_spelling_variants", _SPELLING_SQL)
def _(spark, d):
    return spelling.spelling_groups(table(spark, d, "documents"))
