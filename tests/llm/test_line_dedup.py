import random
import re

import pytest

from stormledger.llm import line_dedup as L


def key_of(line):
    bare = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in bare)


def brute(rows, least=3):
    holders = {}
    for k, (doc, text) in enumerate(rows):
        for key in {key_of(x) for x in (text or "").split("\n")}:
            if len(key) >= 20:
                holders.setdefault(key, []).append(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(h := holders.get(key_of(x), [])) >= least and doc != max(h, key=lambda d: (d is not None, d or 0)))]
        out.append((str(doc), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    common = ["A Common Line of twenty characters", "  a common line of TWENTY characters\t", "été ÉTÉ " * 4, "ÀB" * 12, "àb" * 12, "short", "", "x" * 19, "Y" * 20, "only in two documents, never three"]
    rows = []
    for i in range(120):
        lines = [rng.choice(common[:9]) if rng.random() < 0.6 else f"own line number {rng.randrange(10**6)} of document" for _ in range(rng.randrange(0, 8))]
        rows.append((rng.randrange(10**6) - 500, rng.choice([None, "", "\n"]) if rng.random() < 0.05 else "\n".join(lines)))
    rows += [(3_000_000, common[9]), (2_000_000, common[9]), (None, common[0] + "\nkept line"), (77, "\n".join(common[:1] * 500)), (77, "\n".join(common[:1] * 500))]
    return rows


@pytest.mark.parametrize("batches,fanout", [(4, 2), (1, 2), (7, 3)])
def test_equals_brute_force(spark, batches, fanout):
    rows = corpus(batches)
    docs = spark.createDataFrame([(i, t, "k", 9) for i, t in rows], "doc_id long, text string, h1 string, n_lines int").repartition(3)
    out = L.dedup_lines(docs, batches=batches, fanout=fanout)
    assert out.columns == ["doc_id", "text", "h1", "n_lines", "n_dropped"]
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text or "") for r in out.collect()) == brute(rows)


def batch(spark, doc, text):
    return L.held_lines(L.hashed_lines(spark.createDataFrame([(doc, text)], "doc_id long, text string")))


def test_runs_are_levelled_and_later_batches_are_not_new(spark):
    runs = L.LineRuns(spark, fanout=2)
    for k in range(5):
        runs.add(batch(spark, 9 - k, f"the very same line of text\nline of its own number {k}"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    rows = [r for run in runs.tables() for r in run.collect()]
    assert sorted(r.n_docs for r in rows) == [1, 1, 1, 1, 1, 1, 4] and sum(r.last_doc is not None for r in rows) == 6
    assert sorted((r.n_docs, r.last_doc) for r in runs.whole().collect()) == [(1, 5), (1, 6), (1, 7), (1, 8), (1, 9), (5, 9)]
    names = [name for level in runs.levels for name, _ in level]
    runs.drop()
    assert names and not any(spark.catalog.tableExists(name) for name in names)


def test_runs_are_merged_without_shuffle_or_sort(spark):
    runs = L.LineRuns(spark, fanout=9)
    for k in range(3):
        runs.add(batch(spark, 9 - k, f"the very same line of text\nline of its own number {k}"))
    held = batch(spark, 1, "the very same line of text")
    with L.in_order(spark):
        plan = runs.known(held)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and "Bucketed: true" in plan
    assert plan.count("Exchange") == held._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert plan.count("Sort [") == 1  # the batch
    runs.drop()


def test_empty_table_and_untouched_nulls(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in L.dedup_lines(docs).collect()) == [(1, None, 1, 0), (2, "", 1, 0)]
    assert L.dedup_lines(docs.filter("doc_id > 5")).count() == 0
