import random

import pytest

from stormledger.llm import ngram_join as N


def rows_of(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id long, text string")


def mutated(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(25):
        size = rng.choice([1, 3, 4, 5, 6, 8, 9, 12, 20, 40, 80, 170, 400, 1500])
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(rng.choice([1, 1, 2, 5, 20])):
            words = mutated(rng, base, rng.randrange(0, 2 + size // 60))
            if rng.random() < 0.2:
                words = words[: max(1, int(size * 0.85))]
            rows.append(" ".join(words))
    rows += [" ".join(passage + [rng.choice(vocabulary) for _ in range(12)]) for _ in range(40)]  # alike, not similar
    chain = [rng.choice(vocabulary) for _ in range(60)]
    for k in range(12):  # each like the one before only
        chain = chain[2:] + [f"c{k}", f"d{k}"]
        rows.append(" ".join(chain))
    rows += [" ".join(passage)] * 30 + [None, "", " \t\n", "one two", "ONE\ttwo ", "One two"]
    rng.shuffle(rows)
    return [(k * 3, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, brute_components, seed):
    rows = corpus(seed)
    got = sorted(tuple(r) for r in N.component_ids(rows_of(spark, rows)).collect())
    assert got == sorted(brute_components(rows))


def test_doubled_segments_equal_brute_force(spark, brute_components):
    """With too few segments the one-deletion neighbourhoods must find the links."""
    rows, layout = corpus(3), N.Layout(spare=0.75, small_segments=2)
    docs = rows_of(spark, rows)
    assert N._profiles(docs, layout).filter("doubled > 0").count() > 0
    got = sorted(tuple(r) for r in N.component_ids(docs, layout).collect())
    assert got == sorted(brute_components(rows))


@pytest.mark.parametrize("seed", [5, 6])
def test_large_groups_of_near_copies(spark, brute_components, seed):
    """Two families whose members are mostly too far from the centre and from each other."""
    rng = random.Random(seed)
    rows = []
    for _ in range(2):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([60, 90]))]
        for _ in range(150):
            words = list(base)
            for _ in range(rng.randrange(0, 7)):
                at = rng.randrange(len(words))
                kind = rng.random()
                words[at : at + (kind < 0.7)] = [] if kind < 0.35 else [rng.choice(["x", "y", f"z{rng.randrange(40)}"])]
            rows.append(" ".join(words))
    rows = list(enumerate(rows))
    got = sorted(tuple(r) for r in N.component_ids(rows_of(spark, rows)).collect())
    assert got == sorted(brute_components(rows))


def test_other_threshold(spark, brute_components):
    rows = corpus(4)
    got = sorted(tuple(r) for r in N.component_ids(rows_of(spark, rows), N.Layout(percent=60)).collect())
    assert got == sorted(brute_components(rows, 60))


def test_nulls_repeats_empty_table(spark):
    got = N.component_ids(rows_of(spark, [(None, "a b"), (4, "a b"), (4, "a b"), (7, None), (None, None)])).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, [(None, 1, 4), (4, 1, 4), (4, 1, 4), (7, 0, 7), (None, 0, None)]))
    assert N.component_ids(rows_of(spark, [])).count() == 0


def test_representatives_keep_other_columns(spark):
    docs = spark.createDataFrame([(5, "a b c d e f", 1), (2, "a b c d e f", 2), (9, None, 3)], "doc_id long, text string, key int")
    assert {(r.doc_id, r.key) for r in N.representatives(docs).collect()} == {(2, 2), (9, 3)}
