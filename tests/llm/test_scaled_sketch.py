import hashlib

import numpy as np
import pytest

from stormledger.llm import scaled_sketch as S


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        out[doc] = (len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest())
    return out


ROWS = [(10, "abc déf 😀😀 x"), (3, None), (7, ""), (8, "a"), (-5, "one two three four five six seven " * 300), (12, "z " * 40), (None, "last"), (11, "é" * 9)]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], [(k * 7 % 101, f"text {k} " * k) for k in range(101)]])
def test_edited_texts(spark, rows):
    got = S.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == expected(rows)
    assert len(got) == len(rows) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(4, "a b c")] * 3 + [(2, "q")], "doc_id long, text string")
    got = S.edited_fingerprints(docs).collect()
    assert sorted(r.doc_id for r in got) == [2, 4, 4, 4]
    assert len({r.fingerprint for r in got if r.doc_id == 4}) == 1
    assert S.edited_fingerprints(docs.filter("doc_id > 9")).count() == 0


def test_estimates_follow_the_truth():
    rng = np.random.default_rng(1)
    pool = rng.permutation(np.unique(rng.integers(0, 2**64, 60_000, dtype=np.uint64)))
    long, short = pool[:50_000], np.sort(pool[45_000:50_500])
    a, b = S.sketch(np.sort(long)), S.sketch(short)
    assert abs(S.containment(b, a) - 5_000 / 5_500) < 0.05
    assert abs(S.likeness(a, b) - 5_000 / 50_500) < 0.02
    whole = S.sketch(np.union1d(long, short))
    assert np.array_equal(S.merge(a, b)[1], whole[1])
    assert S.read(S.spell(a))[::2] == a[::2] and np.array_equal(S.read(S.spell(a))[1], a[1])
    few = S.sketch(np.sort(pool[45_000:45_100]))
    assert S.containment(few, a) == 1.0
    assert S.likeness(S.sketch(pool[:0]), S.sketch(pool[:0])) == 1.0
    one, two = S.sketch(pool[:1] | np.uint64(1 << 63)), S.sketch(pool[1:2] | np.uint64(1 << 63))  # nothing kept
    assert not len(one.kept) and S.likeness(one, two) == 0.0 and S.likeness(one, one) == 1.0


def test_columns_and_udfs(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (3, None, "z")], "doc_id long, text string, fingerprint string")
    got = S.fingerprints(docs)
    assert got.columns == ["doc_id", "fingerprint"]
    prints = {r.doc_id: r.fingerprint for r in got.collect()}
    assert prints[1] == prints[2] != prints[3]
    pair = spark.createDataFrame([(prints[1], prints[2], prints[3])], "a string, b string, c string")
    r = pair.select(S.fingerprint_likeness("a", "b"), S.fingerprint_likeness("a", "c"), S.fingerprint_containment("a", "b")).first()
    assert tuple(r) == (1.0, 0.0, 1.0)


def test_likeness_of_texts_of_all_sizes(spark):
    def shingles(text):
        words = text.split()
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}

    def true(a, b):
        return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))

    rng = np.random.default_rng(2)
    texts = []
    for n in [200, 250, 257, 300, 300, 400, 500, 700, 1000, 1500, 2000] * 4:
        words = [f"w{k}" for k in rng.integers(0, 5_000, n)]
        texts.append(" ".join(words))
        for part in (10, 3):  # a near copy and a third of it replaced
            texts.append(" ".join([f"x{k}" for k in rng.integers(0, 5_000, n // part)] + words[n // part:]))
    got = {r.doc_id: r for r in S.edited_fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    errors = {}
    for k, text in enumerate(texts):
        after = texts[k - 1]  # falling doc_id; behind the last comes the first
        half = len(text) // 2
        for value, other in ((got[k].near_edited, text[: len(text) - half] + after[:half]), (got[k].near_next, after)):
            n = len(shingles(text) | shingles(other))
            assert abs(value - true(text, other)) < 4 / np.sqrt(n)  # four times the most that n / 4 hashes may deviate
            errors.setdefault(len(text.split()) > 600, []).append(abs(value - true(text, other)))
    assert np.mean(errors[True]) < 0.02 and np.mean(errors[False]) < 0.04


def test_fraction_is_fixed_and_fractions_are_nested():
    hashes = np.unique(np.random.default_rng(4).integers(0, 2**64, 40_000, dtype=np.uint64))
    picks = np.random.default_rng(5).permutation(hashes)
    for n in (0, 5, 1_000, 40_000):
        own = S.sketch(np.sort(picks[:n]))
        assert own[0] == S.FRACTION_LOG2 and abs(len(own[1]) - n / 4) <= 4 * np.sqrt(n * 3 / 16)
        thin = S.sketch(np.sort(picks[:n]), 5)
        assert set(thin[1].tolist()) <= set(own[1].tolist())
        assert S.likeness(own, thin) == 1.0
