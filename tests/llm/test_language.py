import itertools

import numpy as np
import pytest

from stormledger.llm import language as L

EN, DE, RU = "the cat and the dog are in the house with that thing", "der hund und die katze sind nicht im haus", "кошка и собака живут в большом доме"
TAUGHT = [(EN, "en"), (DE, "de"), (RU, "ru"), (None, "en"), ("no language", None), ("", "de")]


def model_of(spark, rows=TAUGHT):
    return L.learn(spark.createDataFrame(rows, "text string, lang string"))


def brute_path(scores, switch):
    best = max(
        itertools.product(range(scores.shape[1]), repeat=len(scores)),
        key=lambda p: sum(scores[k, s] for k, s in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:])),
    )
    return sum(scores[k, s] for k, s in enumerate(best)) - switch * sum(a != b for a, b in zip(best, best[1:]))


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(3)
    sizes = np.array([0, 5, 1, 7, 3, 0, 6])
    scores = rng.normal(size=(sizes.sum(), 3)).astype(np.float32) * 2
    path = L.best_paths(scores, sizes, 1.5)
    at = 0
    for n in sizes:
        own, p = scores[at : at + n], path[at : at + n]
        got = sum(own[k, s] for k, s in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))
        assert got == pytest.approx(brute_path(own, 1.5) if n else 0, abs=1e-4)
        at += n


def test_spans_of_mixed_text_and_edge_cases(spark):
    model = model_of(spark)
    rows = [
        (1, f"{EN} {DE} {RU}"), (2, None), (3, ""), (4, "12 34 !!"), (5, "中文字"), (6, EN.upper() + " 99"), (7, DE * 2000), (6, DE), (None, RU),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lang_pred string")
    got = [r for r in L.label(docs, model).collect()]
    by = {r.doc_id: r for r in got if r.doc_id not in (6, None)}
    assert len(got) == len(rows)
    spans = [(s.lang, s.first_word, s.n_words) for s in by[1].spans]
    assert spans == [("en", 0, 12), ("de", 12, 9), ("ru", 21, 7)]
    assert by[1].lang_pred == "en" and 0 < by[1].score < 1
    assert by[5].lang_pred in ("de", "en", "ru") and by[5].score == 0.0 and len(by[5].spans) == 1
    for k in (2, 3, 4):
        assert (by[k].lang_pred, by[k].score, by[k].spans) == ("und", 0.0, [])
    assert sorted(r.lang_pred for r in got if r.doc_id == 6) == ["de", "en"]
    assert by[7].lang_pred == "de" and by[7].score == 1.0 and by[7].spans[0].n_words == len((DE * 2000).split())
    assert L.label(docs.filter("doc_id < 0"), model).count() == 0


def test_three_hundred_languages(spark):
    taught = [(f"{a}{b}{a}{a} {b}{b}{a} {a}{b}", f"l{k:03}") for k, (a, b) in enumerate(itertools.product("bcdfghjklmnpqrstvwxz", "aeiouyäöüéèàùîô"))]
    model = model_of(spark, taught)
    assert len(model.languages) == 300
    rows = [(k, t) for k, (t, _) in enumerate(taught)]
    got = {r.doc_id: r for r in L.label(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [got[k].lang_pred for k in range(300)] == [lang for _, lang in taught]
    assert all(got[k].score == 1.0 for k in range(300))
    scores = np.random.default_rng(1).normal(size=(40, 300)).astype(np.float32)
    assert (L.best_paths(scores, np.array([40]), 0.0) == scores.argmax(axis=1)).all()


def test_rare_second_script_and_unlearned_scripts(spark):
    taught = TAUGHT[:3] + [(EN + " " + DE, "xx")] * 300 + [("ξένος λόγος", "xx")]
    docs = spark.createDataFrame([(1, "ξένος λόγος"), (2, "中文字"), (3, "中文字 the cat")], "doc_id long, text string")
    got = {r.doc_id: r for r in L.label(docs, model_of(spark, taught)).collect()}
    assert (got[1].lang_pred, got[1].score) == ("xx", 1.0)
    assert got[2].lang_pred in ("en", "de", "ru", "xx") and got[2].score == 0
    assert got[3].lang_pred != "und" and got[3].score < 1


def test_nothing_learned(spark):
    model = model_of(spark, [(None, "en"), ("a", None)])
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    assert {(r.lang_pred, r.score) for r in L.label(docs, model).collect()} == {("und", 0.0)}


def test_held_out_accuracy(spark):
    from stormledger.llm import queries

    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op9_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").filter("held_out AND lang IS NOT NULL")
    right, n = got.selectExpr("avg(int(lang = lang_pred))", "count(*)").first()
    assert n > 150 and right > 0.97
