import random
import re
import zlib
from collections import Counter

import pytest

from stormledger.llm import spelling as S


def brute_words(rows, letters=6, times=5, noise=199):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= letters and k >= times}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def brute(rows, **options):
    words = brute_words(rows, **options)
    out, forms = {}, {}
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * n:
            forms[w] = best
        out[w] = (n, len(near))
    def root(w):
        while w in forms:
            w = forms[w]
        return w
    return sorted((w, forms.get(w), root(w), n, k, words[forms[w]] if w in forms else None) for w, (n, k) in out.items())


def run(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], "doc_id long, text string, word string, n string")
    got = S.spelling_groups(docs, **options)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in got.collect())


def corpus(seed, alphabet, base, docs=120):
    rng = random.Random(seed)
    words = ["".join(rng.choices(alphabet, k=rng.randint(5, 9))) for _ in range(base)]
    for w in words[: base // 2]:
        at = rng.randrange(len(w))
        words += [w[:at] + w[at + 1 :], w[:at] + rng.choice(alphabet) + w[at + 1 :], w[:at] + rng.choice(alphabet) + w[at:]]
    weights = [1 / (k % 97 + 1) ** 1.3 for k in range(len(words))]
    return [(d, " ".join(w.title() if rng.random() < 0.1 else w for w in rng.choices(words, weights, k=80))) for d in range(docs)]


@pytest.mark.parametrize("seed,alphabet,block", [(1, "abc", 512), (2, "etaoinséÿ×", 7), (3, "abcdefghijklmnopqrstuvwxyzàÀß", 3)])
def test_equals_brute_force(spark, seed, alphabet, block):
    rows = corpus(seed, alphabet, 60)
    rows += [(1000, None), (1001, ""), (None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1]), (1002, "abcabc," * 3000)]
    assert run(spark, rows, block_words=block) == brute(rows)


def test_chain_of_forms_ends_at_the_last(spark):
    words = [("stormy", 5), ("stormya", 26), ("stormyab", 140), ("stormyabc", 800), ("zzzzzz", 6)]
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(words)]
    got = {r[0]: r[1:3] for r in run(spark, rows, noise=0)}
    assert got["stormy"] == ("stormya", "stormyabc")
    assert got["stormyabc"] == (None, "stormyabc") and got["zzzzzz"] == (None, "zzzzzz")


def test_ties_take_the_smaller_form(spark):
    rows = [(1, " ".join(["rivera"] * 25 + ["riverb"] * 25 + ["riveré"] * 5))]
    got = {r[0]: r for r in run(spark, rows, noise=0)}
    assert got["riveré"] == ("riveré", "rivera", "rivera", 5, 2, 25)


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, ""), (None, "1234 -- _")]) == []


def test_deleted_letters_are_found_again(spark):
    """Every planted variant that is frequent enough is near its word."""
    rows = [(d, "mountain harbour lantern") for d in range(40_000)]
    got = run(spark, rows)
    assert got == brute(rows)
    short = [r for r in got if len(r[0]) < len("lantern") or r[0] not in ("mountain", "harbour", "lantern")]
    assert short and all(r[2] in ("mountain", "harbour", "lantern") for r in short)
