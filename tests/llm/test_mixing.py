import random
import re

import pytest

from stormledger.llm import mixing as M

SCHEMA = "doc_id long, text string, lang string, source string, row long, turn long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, s, 0, 1) for i, t, s in rows], SCHEMA)


def brute_targets(sizes, most=3):
    """Shares by weight; what is above the brim is shared out again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: [1, 2, 3][k % 3] for k, s in enumerate(names)}
    target, full, left = {}, set(), float(sum(sizes.values()))
    while len(full) < len(names):
        total = sum(weight[s] for s in names if s not in full)
        over = [s for s in names if s not in full and left * weight[s] / total >= most * sizes[s]]
        if not over:
            break
        for s in over:
            target[s], left = most * sizes[s], left - most * sizes[s]
            full.add(s)
    total = sum(weight[s] for s in names if s not in full)
    return target | {s: left * weight[s] / total for s in names if s not in full}


def corpus(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice([None, "a", "b", "b", "b", "é", "z", "tiny" if rng.random() < 0.05 else "b"])
        rows.append((i, rng.choice([None, "", " \n", "w " * rng.randrange(1, 60), "long " * 900 if rng.random() < 0.02 else "x y\x0bz z"]), source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken_words(spark, seed):
    rows = corpus(seed)
    docs = docs_of(spark, rows)
    sizes = M.document_sizes(docs)
    got = M.words_taken(sizes, M.source_targets(sizes)).collect()
    again = M.words_taken(sizes, M.source_targets(sizes)).collect()
    count = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    per = {}
    for i, _, s in rows:
        per[s] = per.get(s, 0) + count[i]
    want = brute_targets(per)
    taken = {}
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again) and len(got) == len(rows)
    for r in got:
        assert (r.size, r.source_size) == (count[r.doc_id], per[r.source])
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert taken[s] == pytest.approx(t, abs=0.5001)


def test_long_tail_of_tiny_sources(spark):
    """Sources far below a slot reach their targets too, and stay in the mix of documents."""
    rows = [(i, "w " * 2000, "a") for i in range(5000)]
    rows += [(10_000 + i, "x " * (1 + i % 30), f"b{i:03}") for i in range(200)] + [(20_000, "y y y", "z")]
    docs = docs_of(spark, rows)
    sizes = M.document_sizes(docs)
    taken, target = {}, {}
    for r in M.words_taken(sizes, M.source_targets(sizes)).collect():
        taken[r.source], target[r.source] = taken.get(r.source, 0) + r.taken, r.target
    assert len(taken) == 202 and all(abs(taken[s] - t) <= 0.5001 for s, t in target.items())
    assert {r.source for r in M.mixed_documents(docs).select("source").distinct().collect()} == set(taken)


def test_schedule_is_spread_evenly_and_blocks_are_equal(spark):
    docs = docs_of(spark, [(i, "w " * 50, "ab"[i % 2]) for i in range(80)])
    sizes = M.document_sizes(docs)
    pieces = M.mix(sizes, M.source_targets(sizes)).collect()
    slots = {}
    for p in pieces:
        slots.setdefault((p.slot, p.source), [p.source, 0])[1] += p.n_words
    order = [slots[k][0] for k in sorted(slots)]
    share = order.count("a") / len(order)
    for n in range(1, len(order) + 1):
        assert abs(order[:n].count("a") - share * n) <= 8
    assert sum(n > 2 for _, n in slots.values()) <= 2  # a source's last, shortened slot may join one of its own


def test_reversed_bits(spark):
    got = spark.range(16).select(M.reversed_bits(M.F.col("id"), 4)).collect()
    assert [r[0] for r in got] == [int(f"{k:04b}"[::-1], 2) for k in range(16)]


def test_mixed_documents(spark):
    docs = docs_of(spark, [(i, f"w{i} " * 20, "abc"[i % 3]) for i in range(60)] + [(99, None, "a"), (7, "w7 " * 20, "b"), (None, "q " * 20, "a")])
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    per = {s: sum(r.source == s for r in rows) for s in "abc"}
    assert per["a"] < per["b"] < per["c"] and all(r.text for r in rows)
    assert abs(sum(per.values()) - 62) <= 6


def test_empty_table_and_no_words(spark):
    empty = docs_of(spark, [])
    sizes = M.document_sizes(empty)
    assert M.words_taken(sizes, M.source_targets(sizes)).count() == 0
    sizes = M.document_sizes(docs_of(spark, [(1, None, "a"), (2, "", None)]))
    assert sorted((r.doc_id, r.target, r.taken) for r in M.words_taken(sizes, M.source_targets(sizes)).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]
