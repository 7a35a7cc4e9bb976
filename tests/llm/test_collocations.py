import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stormledger.llm import collocations as C, quotient_filter as Q


def brute(rows, least=30, top=2000, longest=4):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for p in range(len(words) - k + 1):
                    f[lang][tuple(words[p : p + k])] += 1
    out = []
    for lang, found in f.items():
        cands = {g: a for g, a in found.items() if len(g) > 1 and a >= least}
        gone = {g[p : p + m] for g, a in cands.items() for m in range(2, len(g)) for p in range(len(g) - m + 1) if 100 * a >= 80 * found[g[p : p + m]]}
        rows = []
        for g, a in cands.items():
            score, k = min((2_000_000 * a // (found[g[:k]] + found[g[k:]]), k) for k in range(1, len(g)))
            if g not in gone:
                rows.append((-score, -a, " ".join(g).encode(), found[g[:k]], found[g[k:]]))
        for rank, (s, a, g, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def run(spark, rows, **options):
    docs = spark.createDataFrame([(t, la, 1, "x") for t, la in rows], "text string, lang string, rank int, phrase string")
    got = C.top_phrases(docs, **options)
    assert got.dtypes == [(c, "string" if c in ("lang", "phrase") else "bigint") for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")]
    return sorted(tuple(r) for r in got.collect())


def corpus(seed, words, docs=150):
    rng = random.Random(seed)
    phrases = [" ".join(rng.choices(words, k=rng.randint(2, 5))) for _ in range(8)]
    rows = []
    for _ in range(docs):
        parts = [rng.choice(phrases) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 60))]
        text = "".join(p.title() + rng.choice([" ", " ", "\t ", ". ", ",", "\n", "!?", "  "]) for p in parts)
        rows.append((text, rng.choice(["en", "en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize("seed,words,sizes", [
    (1, ["a", "b", "c"], {}),
    (2, ["storm", "été", "Été", "the", "ÿ'x", "日本", "of", "x y"], dict(block_bytes=700, shard_words=64, entries=100)),
    (3, [f"w{k}" for k in range(60)], dict(block_bytes=1, shard_words=1, entries=1)),
])
def test_equals_brute_force(spark, seed, words, sizes):
    rows = corpus(seed, words) + [(None, "en"), ("", None), (" .,;\n", "fr"), ("aa bb " * 4000, "en"), ("long " * 40 + "tail", "de")]
    assert run(spark, rows, **sizes) == brute(rows)
    assert run(spark, rows, least=3, top=5, **sizes) == brute(rows, 3, 5)


def test_repeated_rows_ties_and_empty_tables(spark):
    rows = [("one two three four five", "en")] * 40 + [("b c", "x"), ("a c", "x"), ("a b", "x")] * 30
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(None, None), ("", "en")]) == []


def test_scores_past_64_bits(spark):
    big = 2**62
    counts = spark.createDataFrame([([1], big), ([2], big + 7), ([1, 2], big - 1)], "gram array<long>, n long")
    got = C.scored(counts.filter("size(gram) = 2"), counts).first()
    assert got["score"] == 2_000_000 * (big - 1) // (2 * big + 7)


@pytest.mark.parametrize("half", [1, 5, 17, 32, 40, 64])
def test_filters_are_lossless(half):
    rng = np.random.default_rng(half)
    top = 2**half - 1
    left, right = (rng.integers(0, top, 5000, dtype=np.uint64, endpoint=True) for _ in range(2))
    left[:2000], right[:2000] = left[0], right[0]
    both = Q.Permutation(half)
    there = both.forward(left, right)
    assert all((a == b).all() for a, b in zip(both.back(*there), (left, right), strict=True))
    want = Counter(zip(there[0].tolist(), there[1].tolist(), strict=True))
    bits = min(half, 3)
    parts = []
    for some in (slice(0, 2500), slice(2500, 5000)):  # two shards' filters, cut, encoded, decoded and merged
        a, b, n = Q.summed(half, there[0][some], there[1][some])
        assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == list(zip(a.tolist(), b.tolist(), strict=True))
        cut = (a >> np.uint64(half - bits)).astype(int)
        back = [Q.decode(half, bits, s, Q.encode(half, bits, a[cut == s], b[cut == s], n[cut == s])) for s in np.unique(cut).tolist()]
        parts.append(tuple(np.concatenate(c) for c in zip(*back, strict=True)))
    merger = Q.Merger(half)
    for p in parts:
        merger.add(p)
    a, b, n = merger.result()
    assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True)) == want


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**32, 2**63, 2**64 - 1], np.uint64)
    assert (Q.unpack_numbers(Q.pack_numbers(values)) == values).all()
    assert len(Q.unpack_numbers(Q.pack_numbers(values[:0]))) == 0
