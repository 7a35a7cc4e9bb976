"""Inputs derived from the given tables, as SQL that Spark and DuckDB both read.

The tables hold no hazard posts, so posts, cards, model spans and scores are
built from their rows. One SQL text per view serves both engines; the operators
under test are then written separately for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _pick(n: str, values: list[str]) -> str:
    """One of the SQL expressions, by ``n`` modulo their number."""
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"(CASE {n} % {len(values)} {arms} END)"


def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


MONTHS = [
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
]
TAGALOG = [
    "Enero", "Pebrero", "Marso", "Abril", "Mayo", "Hunyo", "Hulyo",
    "Agosto", "Setyembre", "Oktubre", "Nobyembre", "Disyembre",
]
_D, _M, _Y = "day(o_orderdate)", "month(o_orderdate)", "year(o_orderdate)"


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _pad(expr: str) -> str:
    return f"lpad({_text(expr)}, 2, '0')"


_MONTH = _pick(f"({_M} - 1)", [_s(m) for m in MONTHS])
_MONTH_TL = _pick(f"({_M} - 1)", [_s(m) for m in TAGALOG])
_HOUR = "(o_orderkey % 12 + 1)"
_MINUTE = "(o_orderkey % 60)"
_CLOCK = f"concat({_pad(_HOUR)}, ':', {_pad(_MINUTE)})"

# a time mention as one or two fragments; the second may be null
_FRAGMENT_1 = _pick("o_orderkey", [
    f"concat({_CLOCK}, ' PM ', {_text(_D)})",
    f"concat({_pad(_D)}, ' ', {_MONTH}, ' ', {_text(_Y)})",
    f"concat('(', {_CLOCK}, ' AM')",
    f"concat({_MONTH_TL}, ' ', {_text(_D)}, ', ', {_text(_Y)})",
    f"concat('alas ', {_CLOCK}, ' ng gabi')",
    "'Monday'",
    f"concat({_text(_HOUR)}, ' pm')",
    f"concat({_text(_D)}, substring({_MONTH}, 1, 3), {_text(_Y)})",
    "'soon'",
])
_FRAGMENT_2 = _pick("o_orderkey", [
    f"concat({_MONTH}, ' ', {_text(_Y)})",
    f"concat({_CLOCK}, ' PM')",
    f"concat(substring({_MONTH}, 1, 3), ' ', {_text(_D)}, ', ', {_text(_Y)}, ')')",
    f"concat({_CLOCK}, ' AM')",
    f"concat({_MONTH_TL}, ' ', {_text(_D)}, ', ', {_text(_Y)})",
    f"concat({_MONTH}, ' ', {_text(_D)})",
    f"concat({_MONTH}, ' ', {_text(_D)}, ' ', {_text(_Y)})",
    "NULL",
    "NULL",
])

_OPENING = _pick("o_orderkey", [_s(t) for t in [
    "Thunderstorm Advisory No. 4, heavy rain and flooding issued at ",
    "Earthquake Information No.1: Magnitude 4.6 lindol, aftershocks at ",
    "Sunog sa bayan! Fires burning since ",
    "Bagyong lumakas, storm surge and landslides feared ",
    "Taal Volcano eruption, ashfall and hibok-hibok lava seen ",
    "Market day and concert on ",
    "TSUNAMI threat, daluyong, tidal waves by ",
    "Pag-apaw ng ilog, baha at rains noong ",
    "Slope erosion, nahulog na bato #LandslidePH ",
    "Nothing to report, only songs and dance on ",
    "Fire near the so2 plume, firefighters and rainwater ",
]])

_PLACE = _pick("o_custkey", [
    "concat('Nation ', " + _text("c_nationkey") + ")",
    "concat('Town ', " + _text("o_custkey % 150") + ", ' City')",
    "concat('City of Town ', " + _text("o_custkey % 150") + ")",
    "concat('Sitio ', " + _text("o_custkey % 1900") + ", ' Road')",
    "concat('Region ', " + _text("c_nationkey % 7") + ")",
    "'Northern Luzon'",
    "'Freedom Park'",
    "'Visayas'",
    "'Taal Volcano'",
    "concat('Brgy. Sitio ', " + _text("o_custkey % 1900") + ")",
    "concat('Nation ', " + _text("c_nationkey") + ", ' (', r_name, ')')",
    "'Metro Africa'",
    "'Old Seven'",
    "concat('Town ', " + _text("o_custkey % 150") + ")",
    "'area of responsibility'",
    "'bulkang kanlaon'",
    "concat(lower(r_name), ' region')",
])

POSTS = f"""
SELECT o_orderkey AS post_id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Facebook' ELSE 'X' END AS source,
  concat('feed_', {_text("o_custkey % 20")}) AS query_page,
  concat({_OPENING}, {_FRAGMENT_1}, ' ', coalesce({_FRAGMENT_2}, 'and later'), ' in ', {_PLACE},
    {_pick("o_orderkey", [
        "concat(' #Nation', " + _text("c_nationkey") + ", '_PH')", "''",
        "' #DavaoCity-2Day at 11.01°N, 123.99°E - 019 km'",
        "concat(' (', r_name, ' Region) near Region II and region xiii')",
        "concat('. Keep safe everyone! ', o_orderpriority, ' ', c_mktsegment)",
    ])}) AS text,
  {_pick("o_orderkey", [
      "'Unknown'",
      "concat(" + _text(_Y) + ", '-', " + _pad(_M) + ", '-', " + _pad(_D) + ", ' ', " + _pad(_HOUR) + ", ':', " + _pad(_MINUTE) + ")",
      "concat(" + _text(_Y) + ", '-', " + _pad(_M) + ", '-', " + _pad(_D) + ", ' ', " + _pad(_HOUR) + ", ':', " + _pad(_MINUTE) + ", ':07')",
      "'garbled'",
  ])} AS post_timestamp,
  CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '2025-10-27 21:27' END AS scraped_timestamp,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE c_name END AS "user",
  {_pick("o_orderkey", [
      "concat('https://www.facebook.com/', replace(c_name, '#', '.'), '/posts/', " + _text("o_orderkey") + ")",
      "concat('https://x.com/Town', " + _text("o_custkey % 150") + ", '/status/', " + _text("o_orderkey") + ")",
      "concat('https://www.facebook.com/hashtag/Nation', " + _text("c_nationkey") + ", '?_rdc=1')",
      "'https://www.facebook.com/watch/live'",
      "'https://web.facebook.com/GMANews/posts/1'",
      "'https://www.netflix.com/PHIVOLCS?x=1'",
      "'https://example.org/none'",
  ])} AS post_url
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

_WIDE = f"""
SELECT o_orderkey AS post_id, {_FRAGMENT_1} AS t1, {_FRAGMENT_2} AS t2, {_PLACE} AS p1,
  {_pick("o_orderkey", ["'Mindanao'", "concat('NATION  ', " + _text("c_nationkey") + ")",
                        "'Luzon'", "concat('town ', " + _text("o_custkey % 150") + ")", "'   '"])} AS p2
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

SPANS = f"""
WITH w AS ({_WIDE})
SELECT post_id, 'loc' AS model, 1 AS pos, p1 AS word, 'LOC' AS entity_group, CAST(0.9 AS double) AS score FROM w
UNION ALL SELECT post_id, 'loc', 2, p2, 'GPE', CAST(0.8 AS double) FROM w
UNION ALL SELECT post_id, 'loc', 3, p1, 'PER', CAST(0.7 AS double) FROM w
UNION ALL SELECT post_id, 'time', 1, concat(' ', t1, ' '), 'DAT', CAST(0.9 AS double) FROM w WHERE post_id % 13 <> 0
UNION ALL SELECT post_id, 'time', 2, t2, 'TIM', CAST(0.9 AS double) FROM w WHERE t2 IS NOT NULL AND post_id % 13 <> 0
UNION ALL SELECT post_id, 'time', 3, t1, 'DAT', CAST(0.6 AS double) FROM w WHERE post_id % 4 = 0 AND post_id % 13 <> 0
UNION ALL SELECT post_id, 'time', 4, '2001', 'ORG', CAST(0.6 AS double) FROM w
"""

REGIONS = """
SELECT CAST(r_regionkey AS bigint) AS seq,
  concat(CASE r_regionkey WHEN 0 THEN 'REGION I' WHEN 1 THEN 'REGION II' WHEN 2 THEN 'REGION III'
    WHEN 3 THEN 'REGION IV-A' ELSE 'REGION XIII' END, ' (', r_name, ' REGION)') AS "regDesc",
  lpad(CAST(CASE WHEN r_regionkey = 4 THEN 16 ELSE r_regionkey + 1 END AS STRING), 2, '0') AS "regCode"
FROM region
"""

PROVINCES = """
SELECT CAST(n_nationkey AS bigint) AS seq, concat('NATION ', CAST(n_nationkey AS STRING), ' (', r_name, ')') AS "provDesc",
  lpad(CAST(n_nationkey + 100 AS STRING), 4, '0') AS "provCode",
  lpad(CAST(n_regionkey + 1 AS STRING), 2, '0') AS "regCode"
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

CITIES = """
SELECT CAST(s_suppkey AS bigint) AS seq,
  CASE s_suppkey % 3 WHEN 0 THEN concat('TOWN ', CAST(s_suppkey AS STRING))
    WHEN 1 THEN concat('CITY OF  TOWN ', CAST(s_suppkey AS STRING))
    ELSE concat('TOWN ', CAST(s_suppkey AS STRING), ' (Old Town)') END AS "citymunDesc",
  lpad(CAST(s_suppkey AS STRING), 6, '0') AS "citymunCode",
  lpad(CAST(s_nationkey + 100 AS STRING), 4, '0') AS "provCode"
FROM supplier
"""

BARANGAYS = """
SELECT CAST(p_partkey AS bigint) AS seq,
  concat('Sitio ', CAST(p_partkey AS STRING), CASE WHEN p_partkey % 4 = 0 THEN ' (Pob.)' ELSE '' END) AS "brgyDesc",
  lpad(CAST(p_partkey AS STRING), 9, '0') AS "brgyCode", '000001' AS "citymunCode"
FROM part
"""

ALIASES = {
    "metro africa": "REGION I (AFRICA REGION)",
    "Old Seven": "NATION 7 (ASIA)",
    "region 2": "REGION III (ASIA REGION)",
    "lost": "Nowhere",
}

# cards: one per conversation turn, event times joined by position
CARDS = """
SELECT CASE WHEN c.conv_id % 2 = 0 THEN 'Facebook' ELSE 'X' END AS source,
  concat('feed_', CAST(c.conv_id % 10 AS STRING)) AS query_page,
  CASE WHEN c.conv_id % 4 = 0 THEN 'query' ELSE 'page' END AS query_kind,
  c.text AS block_1,
  CASE WHEN c.turn % 3 = 0 THEN concat('  ', c.role, ' says stay safe
Ingat') ELSE '   ' END AS block_2,
  c.role AS block_3,
  CASE WHEN c.turn = 0 THEN CAST(0 AS bigint) WHEN c.turn % 5 = 4 THEN CAST(NULL AS bigint)
    ELSE CAST(1704067200 + c.conv_id * 3600 + c.turn * 61 AS bigint) END AS utime,
  CASE c.conv_id % 6 WHEN 5 THEN 'yesterday'
    ELSE concat('2024-01-', lpad(CAST(c.conv_id % 28 + 1 AS STRING), 2, '0'), 'T',
      lpad(CAST(c.conv_id % 24 AS STRING), 2, '0'), ':', lpad(CAST(c.turn % 60 AS STRING), 2, '0'), ':30.000Z') END AS time_iso,
  CASE c.turn % 4 WHEN 0 THEN NULL WHEN 1 THEN concat('https://x.com/', c.role, CAST(c.conv_id AS STRING), '/status/1')
    WHEN 2 THEN 'x.com/short' ELSE '' END AS link,
  CASE WHEN c.turn % 2 = 0 THEN c.role END AS "user",
  concat('https://www.facebook.com/feed_', CAST(c.conv_id % 10 AS STRING)) AS page_url,
  '2024-01-20 10:00' AS scraped_at, c.conv_id AS conv_id, c.turn AS turn
FROM conversations c
"""

# scores of every label for the posts whose number is not a multiple of 3
SCORE_LABELS = [
    "other (not a natural disaster or emergency, unrelated to calamities)",
    "rainfall / flood (rainfall, heavy rain)", "landslide (pagguho ng lupa)", "earthquake (lindol)",
    "tsunami (sea wave after earthquake)", "fire (sunog)", "volcanic eruption (bulkan)", "typhoon (bagyo)",
]
SCORES = (
    "SELECT post_id, label, CAST(score AS double) / 1000 AS score FROM ("
    + " UNION ALL ".join(
        f"SELECT o_orderkey AS post_id, {_s(label)} AS label, "
        f"CASE WHEN o_orderkey % 8 = {i} THEN 500 + (o_orderkey * 7) % 500 ELSE (o_orderkey * {13 + i * 10}) % 820 END AS score "
        "FROM orders WHERE o_orderkey % 3 <> 0"
        for i, label in enumerate(SCORE_LABELS)
    )
    + ") s"
)

# scores of every label for all orders, from one scan
_LABEL_ROWS = ", ".join(f"({i}, {_s(label)})" for i, label in enumerate(SCORE_LABELS))
ALL_SCORES = f"""
SELECT o_orderkey AS post_id, label, CAST(
  CASE WHEN o_orderkey % 8 = i THEN 500 + (o_orderkey * 7) % 500 ELSE (o_orderkey * (13 + i * 10)) % 820 END AS double) / 1000 AS score
FROM orders, (VALUES {_LABEL_ROWS}) l(i, label)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows spread over the cores when the files alone would not fill them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def texts(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spread(table(spark, sf_dir, name))


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A derived view on Spark; table names in the text become the given tables."""
    import re

    used = [t for t in TABLES if re.search(rf"\b(?:FROM|JOIN) {t}\b", sql)]
    frames = {t: table(spark, sf_dir, t) for t in used}
    for t in used:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}} AS {t}" if f"{t} c" not in sql else rf"\1 {{{t}}}", sql)
    return spark.sql(sql.replace('"', "`"), **frames)


def posts(spark, sf_dir):
    return spread(view(spark, sf_dir, POSTS))


def spans(spark, sf_dir):
    return view(spark, sf_dir, SPANS)


def cards(spark, sf_dir):
    from pyspark.sql import functions as F

    return (
        view(spark, sf_dir, CARDS)
        .withColumn("blocks", F.array("block_1", "block_2", "block_3"))
        .drop("block_1", "block_2", "block_3")
    )


def scores(spark, sf_dir):
    """The rows of ``SCORES``, from one scan."""
    return all_scores(spark, sf_dir).filter("post_id % 3 <> 0")


def all_scores(spark, sf_dir):
    from pyspark.sql import functions as F

    labels = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(label).alias("label")) for i, label in enumerate(SCORE_LABELS)])
    key, i = F.col("o_orderkey"), F.col("l.i")
    score = F.when(key % 8 == i, 500 + (key * 7) % 500).otherwise((key * (13 + i * 10)) % 820)
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", F.explode(labels).alias("l"))
        .select(key.alias("post_id"), "l.label", (score.cast("double") / 1000).alias("score"))
    )


def gazetteer(spark, sf_dir):
    from stormledger.sources.gazetteer import gazetteer_of, level_table

    return gazetteer_of(
        region=level_table(view(spark, sf_dir, REGIONS), "region", "seq"),
        province=level_table(view(spark, sf_dir, PROVINCES), "province", "seq"),
        citymun=level_table(view(spark, sf_dir, CITIES), "citymun", "seq"),
        barangay=level_table(view(spark, sf_dir, BARANGAYS), "barangay", "seq"),
    )
