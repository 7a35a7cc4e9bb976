import itertools
import math
import random
import zlib

import numpy as np
import pytest

from stormledger.llm import toxicity as X

WORDS = [a + b for a in ("ner", "tho", "la", "ciu", "wei", "öst") for b in ("en", "re", "ti", "ó", "ly", "ng")]
BAD = ["blister", "scorn", "vermin", "oaf"]


def by_hand(field, emissions):
    """Marginals and the probability of no toxic token, over all tag sequences."""
    moves, n = field.moves(), len(emissions)
    total, toxic, clean = 0.0, np.zeros(n), 0.0
    for tags in itertools.product((0, 1), repeat=n):
        w = math.exp(field.start * tags[0])
        for k, t in enumerate(tags):
            w *= emissions[k] ** t * (moves[tags[k - 1], t] if k else 1)
        total += w
        toxic += w * np.array(tags)
        clean += w * (not any(tags))
    return toxic / total, clean / total


@pytest.mark.parametrize("seed", range(4))
def test_forward_backward_equals_all_sequences(seed, monkeypatch):
    monkeypatch.setattr(X, "CHUNK", [1, 3, 64, 5][seed])
    rng = np.random.default_rng(seed)
    field = X.Field(np.zeros(1), 0.0, *rng.normal(0, 2, 4).tolist())
    sizes = rng.integers(1, 9, 12)
    e = np.exp(rng.normal(0, 3, sizes.sum()))
    fresh = np.zeros(len(e), bool)
    fresh[np.cumsum(sizes) - sizes] = True
    chain = X.forward_backward(field, e, fresh)
    at = 0
    for n in sizes:
        marginal, clean = by_hand(field, e[at : at + n])
        assert np.allclose(chain.marginal[at : at + n], marginal)
        assert np.isclose(math.exp(-chain.any_toxic[at : at + n].sum()), clean)
        at += n


def test_gradient_leads_to_the_tags():
    rng = random.Random(5)
    windows = []
    for _ in range(300):
        words = rng.choices(WORDS, k=10)
        tags = [0] * 10
        if rng.random() < 0.5:
            at = rng.randrange(9)
            words[at : at + 2], tags[at : at + 2] = rng.sample(BAD, 2), [1, 1]
        windows.append((" ".join(words), tags))
    field = X.train(windows)
    for text, tags in windows[:50]:
        data, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])
        assert ((X.signs(field, data, offsets)[3] >= 0.5) == np.array(tags, bool)).all()


def corpus(n, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for d in range(n):
        words = rng.choices(WORDS, k=rng.choice([4, 30, 200]))
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(BAD) + rng.choice(["", ".", ","])
        docs.append((d, " ".join(words)))
        labels.append((d, toxic))
    return docs, labels


def frame(spark, docs, labels):
    d = spark.createDataFrame([(i, t, 0.5, "x") for i, t in docs], "doc_id long, text string, score double, toxic string")
    return d, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy_and_offsets(spark):
    docs, labels = corpus(2000)
    docs += [(9000, None), (9001, ""), (9002, " .,! "), (9003, "la " * 30_000), (9004, "la " * 15_000 + "scorn " + "la " * 15_000), (None, "oaf tholy"), (7, docs[7][1])]
    labels += [(5, None), (None, 1), (7, 0), (123456, 1)]
    table, marks = frame(spark, docs, labels)
    held = {i for i, _ in docs if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    model = X.learn(table.filter("crc32(cast(doc_id as string)) % 5 <> 0"), marks.filter("crc32(cast(doc_id as string)) % 5 <> 0"))
    got = X.score(table, model).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    truth = dict(r for r in labels[:2000])
    wrong = [r for r in got if r["doc_id"] in held and r["doc_id"] < 2000 and (r["score"] >= 0.5) != bool(truth[r["doc_id"]])]
    assert len(wrong) <= 2
    text = dict(docs)
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 2000:
            found = [text[r["doc_id"]][s["start"] : s["end"]] for s in r["spans"]]
            assert set(" ".join(found).replace(".", "").replace(",", "").split()) <= set(BAD)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[k]["spans"] == [] and by_id[k]["score"] < 0.5 for k in (9000, 9001, 9002, 9003))
    assert [(s["start"], s["end"]) for s in by_id[9004]["spans"]] == [(45_000, 45_005)]
    assert by_id[9004]["score"] >= 0.5 and by_id[None]["score"] >= 0.5


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, None), (None, 1)], [(1, 1)], [(1, 1), (2, 0)]])
def test_nothing_to_learn(spark, labels):
    table, marks = frame(spark, [(1, "la la"), (2, "ti"), (3, None)], labels)
    known = [t for i, t in labels if i is not None and t is not None]
    share = sum(known) / len(known) if known else 0
    got = X.score(table, X.learn(table, marks)).collect()
    assert [(r["score"], r["spans"]) for r in got] == [(share, [])] * 3


def test_empty_table(spark):
    table, marks = frame(spark, [], [(1, 1), (2, 0)])
    assert X.score(table, X.learn(table, marks)).collect() == []
