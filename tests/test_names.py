"""Tables of names of any size: sharded filters, keyword dictionaries as tables, mentions."""

import random

import pytest
from pyspark.sql import functions as F

from stormledger import dictionaries as D
from stormledger.functions import matching as M
from stormledger.operators import hazard as H, places as P


@pytest.mark.parametrize("most", [27, 12])
def test_shards_give_one_answer(spark, monkeypatch, most):
    monkeypatch.setattr(M, "MOST_BITS_LOG2", most)  # 12: many shards of 4,096 bits
    rng = random.Random(5)
    names = ["".join(rng.choices("abcdef", k=rng.randint(1, 9))) for _ in range(300)]
    texts = ["".join(rng.choices("abcdefgh ", k=rng.randrange(40))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    table = spark.createDataFrame([(n,) for n in names], "w string")
    long = [n for n in names if len(n) > 4]
    got = M.filter_contains_any(df, "t", table.filter("length(w) > 4"))
    assert sorted(r.i for r in got.collect()) == [i for i, t in enumerate(texts) if t and any(n in t for n in long)]


def test_few_false_places_are_written(spark, monkeypatch):
    """Rows written per text stay near the true hits, also where the table needs many shards."""
    monkeypatch.setattr(M, "MOST_BITS_LOG2", 18)  # 4,096 names a shard: 50 shards
    names = spark.range(200_000).select(F.concat(F.lit("town number "), F.col("id").cast("string")).alias("w"))
    texts = spark.range(400).select(
        "id", F.concat(F.lit("a long text about nothing at all but town number "), (F.col("id") * 700).cast("string"), F.lit(" and more words")).alias("t")
    )
    found = M.scan_names(names, F.col("w"), False, lambda parts: texts.select("id", F.explode(parts(F.col("t"))).alias("part")), "few")
    true = found.join(names, F.col("part") == F.col("w")).count()
    assert true >= 286 and found.count() < 1.1 * true + 40


def mapping_hits(spark, rows, dictionary):
    df = spark.createDataFrame(rows, "post_id long, text string")
    return {r.post_id: r.keyword_hits for r in H.with_keyword_hits(df, "text", dictionary).collect()}


def table_hits(spark, rows, dictionary):
    df = spark.createDataFrame(rows, "post_id long, text string").withColumn("label", F.lit(1)).withColumn("keyword_hits", F.lit(2))
    table = spark.createDataFrame(
        [(label, k, i * 1000 + j) for i, (label, ks) in enumerate(dictionary.items()) for j, k in enumerate(ks)], "label string, keyword string, seq int"
    )
    out = H.with_keyword_hits_of_table(df, table)
    assert out.columns == ["post_id", "text", "label", "keyword_hits"]
    return {r.post_id: r.keyword_hits for r in out.collect()}


def test_table_dictionary_equals_mapping(spark):
    texts = [
        "Heavy rain, flooding and a storm surge; rains again", "storms", "rain-soaked", "FIRE! fires firing fired", "so2 plume", "hibok-hibok lava",
        "brainstorm", "storm  surge", None, "", "   ", "lindol" * 3, "rain " * 5000, "pag-apaw ng ilog at baha", "é storm é", "storm_surge", "rain's", "(rain)",
    ]
    rng = random.Random(2)
    words = [k for ks in D.HAZARD_KEYWORDS.values() for k in ks]
    texts += [rng.choice(["", " ", "-", "x"]).join(rng.choice([rng.choice(words), rng.choice(words) + rng.choice(["s", "es", "ing", "ed", "er"]), "the"]) for _ in range(12)) for _ in range(150)]
    rows = list(enumerate(texts))
    assert table_hits(spark, rows, D.HAZARD_KEYWORDS) == mapping_hits(spark, rows, D.HAZARD_KEYWORDS)


def test_odd_keywords(spark):
    odd = {"b": ["-x", "x-", "--", "a b", "a", "Capital"], "a": ["x", "#tag", "é", "a b c", "+"], "c": ["nothing"]}
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices(["a", "b", "c", "x", "-", "--", " ", "#tag", "é", "+", "s", "Capital", "ing"], k=rng.randrange(14)))) for i in range(400)]
    assert table_hits(spark, rows, odd) == mapping_hits(spark, rows, odd)


def test_empty_dictionary_and_no_order(spark):
    rows = [(1, "storm and fire"), (2, None)]
    df = spark.createDataFrame(rows, "post_id long, text string")
    none = spark.createDataFrame([], "label string, keyword string")
    assert H.keyword_hits_of_table(df, none).count() == 0
    table = spark.createDataFrame([("w", "storm"), ("h", "fire"), ("h", "fire"), (None, "and"), ("h", ""), ("h", None)], "label string, keyword string")
    got = H.keyword_hits_of_table(df, table).collect()
    assert [(r.post_id, [(h.label, h.keywords) for h in r.keyword_hits]) for r in got] == [(1, [("h", ["fire"]), ("w", ["storm"])])]


def test_plain_mentions_join_nothing(spark):
    """Mentions that need no gazetteer are settled in their rows, heavy names from a map: neither is shuffled."""
    names = ["Philippines"] * 300 + ["Northern Luzon"] * 100 + ["Cebu City"] * 200 + [f"Town {k}" for k in range(50)]
    mentions = spark.createDataFrame([(i, 1, n) for i, n in enumerate(names)], "post_id long, pos int, entity string")
    gaz = P.prepare_gazetteer(spark.createDataFrame(
        [("citymun", 1, "000001", "01", "CEBU CITY"), ("citymun", 2, "000002", "01", "TOWN 7")], "level string, seq int, code string, parent_code string, name string"
    ))
    out = P.match_mentions(mentions, gaz)
    got = {(r.entity): (r.level, r.matched_name) for r in out.collect()}
    assert out.count() == len(names)
    assert got["Philippines"][0] == "country" and got["Northern Luzon"] == ("island_group", "Luzon") and got["Cebu City"] == ("citymun", "CEBU CITY")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    parts = plan.split("Join Inner")
    assert len(parts) == 2 and "isnotnull(_plain" in parts[0] and "isnull(_plain" in parts[1]


def test_longer_beginnings_are_asked_where_shorter_ones_were_found(monkeypatch):
    """One pass over the places of a text, whatever the number of bands; no name is missed."""
    import numpy as np

    rng = random.Random(1)
    names = ["".join(rng.choices("pqrst", k=k)) for k in (4, 5, 9, 17, 40, 70, 130)]
    units, offsets = M._points(names)
    n, runs, sizes = np.diff(offsets), M._Runs(units), {}
    for k in map(len, names):
        sizes.setdefault(M._band(k), []).append(k)
    held, whole = np.zeros(1 << 10, np.int64), runs.hashes(offsets[:-1], n, M._WHOLE)
    cells = [M._cell(whole, 16, k) for k in range(1, M.WHOLE_CELLS + 1)]
    cells += [M._cell(runs.hashes(offsets[:-1][n >= b], b, M._LEAD), 16) for b in sizes]
    for cell in np.concatenate(cells).tolist():
        held.view(np.uint64)[cell >> 6] |= np.uint64(1 << (cell & 63))
    text = "".join("".join(rng.choices("abcdefgh", k=3000)) + name for name in names)
    asked, hashes = [], M._Runs.hashes
    monkeypatch.setattr(M._Runs, "hashes", lambda self, at, *a: asked.append(len(at)) or hashes(self, at, *a))
    points, edges = M._points([text])
    start, size = M._found(points, edges, M.Shard(0, 1, 16, held, sizes))
    assert {text[i:i + k] for i, k in zip(start.tolist(), size.tolist())} >= set(names)
    assert sum(asked) < len(text) / 10
