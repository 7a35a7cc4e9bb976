import re

from pyspark.sql import functions as F

from stormledger import dictionaries as D
from stormledger.operators import hazard as H

TEXTS = [
    "Storm surge and storms, rains; RAINFALL warning", "firefighters fired at fires", "hibok-hibok lava, so2 plume",
    "pag-apaw ng baha, bahas, bahaing", "no words at all", "rain showerss", "thunderstorm watches and thunderstorm watch",
    "éfire firé fire_", "tidal wave daluyong", "lpa-itcz; apo apos apoy", "floodinged flooding floods",
]


def by_regex(text):
    out = {}
    for label, words in D.HAZARD_KEYWORDS.items():
        hits = [w for w in words if re.search(rf"\b{re.escape(w)}(s|es|ing|ed)?\b", text.lower())]
        if hits:
            out[label] = hits
    return out


def test_one_scan_finds_what_one_pattern_per_keyword_finds(values):
    got = values(H.keyword_hits, TEXTS)
    assert [{h["label"]: h["keywords"] for h in row} for row in got] == [by_regex(t) for t in TEXTS]


def test_ties_follow_hits_then_priority(spark):
    df = spark.createDataFrame([(1, "storm surge"), (2, "daluyong"), (3, "quiet")], "post_id bigint, text string")
    got = {r.post_id: r.disaster_type for r in H.classify(df).collect()}
    assert got == {1: "typhoon", 2: "tsunami", 3: "other"}


def test_scores_decide_and_weak_scores_do_not(spark):
    df = spark.createDataFrame([(i, "quiet") for i in range(1, 6)] + [(6, "flood fire")], "post_id bigint, text string")
    scores = spark.createDataFrame([
        (1, "fire (sunog)", 0.95), (1, "typhoon", 0.5),
        (2, "fire (sunog)", 0.95), (2, "typhoon", 0.9),
        (3, "fire (sunog)", 0.79),
        (4, "unheard of", 0.99),
        (5, "Typhoon (x)", 0.9),
        (6, "fire", 0.4), (6, "rainfall / flood", 0.3),
    ], "post_id bigint, label string, score double")
    got = {r.post_id: r.disaster_type for r in H.classify(df, scores).collect()}
    assert got == {1: "fire", 2: "other", 3: "other", 4: "other", 5: "typhoon", 6: "fire"}


def test_rendering(spark):
    df = spark.createDataFrame([("rain and flood, lindol",)], "text string")
    row = H.with_keyword_hits(df).select(H.render_hits(F.col("keyword_hits"))).first()[0]
    assert row == "rainfall / flood:rain|flood, earthquake:lindol"


def test_batches_score_every_row(spark):
    df = spark.range(50).select(F.col("id").alias("post_id"), F.col("id").cast("string").alias("text_content"))

    def make():
        return lambda texts, labels: [[float(len(t)) for _ in labels] for t in texts]

    assert H.score_batches(df, make, ["a", "b"], batch=7).count() == 100


def test_a_label_without_priority_cannot_be_ranked(spark):
    df = spark.createDataFrame([(1, "big wave"), (2, "sudden wave and rock")], "post_id bigint, text string")
    dictionary = {"tsunami": ["wave"], "my label": ["rock"]}
    got = {r.post_id: r.disaster_type for r in H.classify(df, dictionary=dictionary).collect()}
    assert got == {1: "tsunami", 2: "other"}
    scores = spark.createDataFrame([(1, "fire (a)", 0.9), (1, "fire (b)", 0.4)], "post_id bigint, label string, score double")
    assert H.score_map(scores).first()["_scores"] == {"fire": 0.4}


def by_rule(rows):
    """Post and base label to the lowest score, null where a label has no other."""
    out = {}
    for post, label, score in rows:
        scores = out.setdefault(post, {})
        old = scores.setdefault(label.split(" (")[0].lower(), score)
        if score is not None and (old is None or score < old):
            scores[label.split(" (")[0].lower()] = score
    return {post: dict(sorted(scores.items())) for post, scores in out.items()}


def test_scores_of_listed_and_other_labels_make_one_map(spark):
    rows = [
        (1, "Fire (a)", 0.9), (1, "fire (b)", 0.4), (1, "my label", 0.3), (1, "My label (x)", 0.2), (1, "tsunami", None),
        (2, "my label", None), (2, "another", 1.0), (None, "fire", 0.5), (None, "wet", 0.1), (None, "fire", 0.3),
        (3, "typhoon", None), (3, "typhoon (bagyo)", 0.7), (4, "tsunami", -1.0), (4, "earthquake", 0.0), (5, "zzz", 2.0),
    ]
    scores = spark.createDataFrame(rows, "post_id bigint, label string, score double").repartition(3)
    entries = H.score_map(scores).select("post_id", F.map_entries("_scores").alias("entries"))
    got = [(r.post_id, [tuple(e) for e in r.entries]) for r in entries.collect()]
    assert len(got) == len(dict(got))
    assert dict(got) == {post: list(m.items()) for post, m in by_rule(rows).items()}
    posts = spark.createDataFrame([(i, "quiet") for i in (1, 2, 3, 4, 5, 6, None)], "post_id bigint, text string")
    maps = {r.post_id: r.label_scores for r in H.classify(posts, scores).collect()}
    assert maps == {p: by_rule(rows).get(p, {}) if p else {} for p in (1, 2, 3, 4, 5, 6, None)}
    own = H.classify(posts, scores, priority=["my label", "another", "zzz"]).collect()
    assert {r.post_id: r.label_scores for r in own} == maps


def test_places_of_keywords_follow_the_dictionary(values):
    words = {"b": ["rock", "big rock", "#rock"], "a": ["wave", "rock", "ock"], "c": ["big", "rock's", "é"], "d": ["wave", "wave"]}
    texts = ["a big rock, waves", "#rock x#rock big rocks", "rock's ock É", "nothing", "", None]
    got = [[(h["label"], h["keywords"]) for h in row] for row in values(lambda t: H.keyword_hits(t, words), texts)]
    for text, hits in zip(texts, got):
        found = {
            label: [w for w in dict.fromkeys(ws) if re.search(rf"\b{re.escape(w)}(s|es|ing|ed)?\b", (text or "").lower())]
            for label, ws in words.items()
        }
        assert hits == [(label, ws) for label, ws in found.items() if ws]


def rows_shuffled(plan):
    """Rows written by the exchanges of an executed plan, and its broadcasts."""
    own = plan.metrics().apply("shuffleRecordsWritten").value() if plan.nodeName() == "Exchange" else 0
    below = [rows_shuffled(plan.children().apply(i)) for i in range(plan.children().size())]
    return own + sum(n for n, _ in below), (plan.nodeName() == "BroadcastExchange") + sum(b for _, b in below)


def test_the_scores_of_a_post_are_shuffled_as_one_row_and_never_broadcast(spark, tmp_path):
    n, labels = 2000, ["fire (sunog)", "typhoon", "other (none)", "tsunami", "earthquake", "landslide"]
    spark.range(n).write.parquet(f"{tmp_path}/posts")
    ids = spark.read.parquet(f"{tmp_path}/posts").withColumnRenamed("id", "post_id")
    scores = ids.select("post_id", F.explode(F.array(*[F.lit(x) for x in labels])).alias("label"), F.lit(0.5).alias("score"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = H.classify(ids.withColumn("text", F.lit("quiet")), scores)
        plan = df._jdf.queryExecution().executedPlan()
        assert df._jdf.queryExecution().toRdd().count() == n
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    shuffled, broadcasts = rows_shuffled(plan)
    # posts, scores by label and scores by post
    assert shuffled <= 3 * n and broadcasts == 0
