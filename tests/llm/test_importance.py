import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormledger.llm import importance as I

WORDS = ["river", "storm", "house", "garden", "the", "and", "of", "walk", "light", "morning", "Paper", "stone,", "cloud."]


def corpus(n=400):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        good = i % 5 != 0
        size = rng.randrange(3, 200)
        words = [rng.choice(WORDS) for _ in range(size)]
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else [words[0]] * size
        rows.append((i, " ".join(words)))
        if i % 3 == 0 or i < 60:
            labels.append((i, int(good)))
    return rows, labels


def tables(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, quality string").repartition(3)
    return docs, spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int")


def test_junk_goes_and_good_text_stays(spark):
    rows, labels = corpus()
    rows += [(900, None), (901, ""), (902, " \n"), (2, rows[2][1])]
    docs, known = tables(spark, rows, [*labels, (None, 1), (3, None), (12345, 1)])
    drawn = I.Resampler(docs, known)
    got = drawn.decisions().collect()
    assert len(got) == len(rows)
    wrong = [r.doc_id for r in got if r.doc_id < 900 and r.kept != (r.doc_id % 5 != 0)]
    assert len(wrong) <= 2
    assert not any(r.kept or r.log_weight is not None for r in got if r.doc_id >= 900)
    again = I.Resampler(docs, known)
    assert {(r.doc_id, r.kept) for r in again.decisions().collect()} == {(r.doc_id, r.kept) for r in got}
    kept = again.kept(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def test_top_k_keeps_its_number(spark):
    rows, labels = corpus(200)
    docs, known = tables(spark, rows, labels)
    assert I.Resampler(docs, known, keep=0.25).decisions().filter("kept").count() == 50
    loose = I.Resampler(docs, known, keep=0.25, temperature=100.0).decisions().filter("kept")
    assert loose.count() == 50 and loose.filter("doc_id % 5 = 0").count() > 0  # noise decides


def test_weights_equal_a_plain_count(spark):
    rows, labels = corpus(60)
    docs, known = tables(spark, rows, labels)
    sample = I._label_sample(known, 1000)
    ratios = I.fit(docs, sample)
    raw, target = np.zeros(I.CELLS), np.zeros(I.CELLS)
    good = {i for i, q in labels if q}
    cells = {}
    for i, t in rows:
        data = np.frombuffer(t.encode(), np.uint8)
        cells[i] = I._features(data, np.array([0, len(data)]))[0]
        np.add.at(raw, cells[i], 1)
        if i in good:
            np.add.at(target, cells[i], 1)
    p = (raw + 0.01) / (raw + 0.01).sum()
    target = target + I.CELLS * p
    want = np.log(target / target.sum() / p)
    assert np.allclose(ratios, want)
    for r in I.weighted(docs, ratios, sample).collect():
        assert r["__weight"] == pytest.approx(want[cells[r.doc_id]].sum() / len(cells[r.doc_id]) ** 0.5)


def test_kth_largest(spark):
    rng = random.Random(3)
    values = [rng.gauss(0, 1) * 10 ** rng.randrange(-3, 6) for _ in range(9000)] + [5.0] * 6000
    keys = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    values.sort(reverse=True)
    for k in (1, 2, 100, 5000, 9000, 14999, 15000):
        assert I.kth_largest(keys, k) == values[k - 1]
    assert I.kth_largest(keys, 0) == np.inf and I.kth_largest(keys, 15001) == -np.inf


def test_no_labels_and_empty_table(spark):
    docs, known = tables(spark, [(1, "a b c"), (2, None)], [(1, 0)])
    assert {(r.doc_id, r.kept) for r in I.Resampler(docs, known.filter("doc_id > 5")).decisions().collect()} == {(1, True), (2, False)}
    assert I.Resampler(docs.filter("doc_id > 5"), known).decisions().count() == 0
