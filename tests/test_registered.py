import duckdb
import pytest

import __spark_entry__ as entry
from checks.views import TABLES

SF = "/root/testdata/sf0.001"
QUICK = ["text_gates", "page_source_of_posts", "keyword_hits_of_documents", "region_alias_map", "display_time", "capture_x", "newest_run"]


def test_every_sql_text_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUICK)
def test_spark_and_sql_agree(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()

    def rows(frame):
        frame = frame[sorted(frame.columns)].astype(object)
        return sorted(tuple("" if v is None or v != v else str(v) for v in r) for r in frame.itertuples(index=False))

    assert rows(got) == rows(want)


def test_run_with_skipped_stages(spark, tmp_path):
    import datetime as dt

    from checks import views as V
    from stormledger.plans.run import run, run_summary

    inputs = (V.posts(spark, SF).filter("post_id < 200"), V.gazetteer(spark, SF), V.spans(spark, SF), V.scores(spark, SF))
    ts = dt.datetime(2025, 10, 27, 21, 39)
    first = run(*inputs, "2025-10-27 21:40:00", save_root=str(tmp_path), run_ts=ts, near=False)
    again = run(*inputs, "2025-10-27 21:40:00", skip=("location", "datetime"), save_root=str(tmp_path), near=False)
    assert first.final.count() == again.final.count() > 0
    rows = {r.stage: (r.ran, r.rows) for r in run_summary(again).collect()}
    assert rows["location"] == (False, None) and rows["classify"][1] == first.final.count()
    with pytest.raises(ValueError):
        run(*inputs, "2025-10-27 21:40:00", skip=("location",))


def test_min_words_of_documents_reads_whole_texts(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = entry.queries()["min_words_of_documents"](spark, SF).toPandas()
    kept = sorted((i, t) for i, t in zip(got["doc_id"], got["kept"]) if t is not None)
    want = con.execute(entry.oracle_sql()["min_words_of_documents"]).fetchall()
    assert kept == sorted(r for r in want if r[1] is not None) and len(got) == len(want)
    texts = con.execute("select doc_id, text from documents").fetchall()
    assert len(got) == 2 * len(texts)
    assert {r for r in texts if len(r[1].split()) >= 3} <= set(kept)


def test_scores_of_all_orders(spark):
    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{SF}/orders.parquet'")
    orders = [r[0] for r in con.execute("select o_orderkey from orders order by 1").fetchall()]
    got = {}
    for name in ("load_scores", "model_only_label", "base_label_counts"):
        name += "_of_all_orders"
        got[name] = sorted(tuple(r) for r in entry.queries()[name](spark, SF).collect())
        assert got[name] == sorted(con.execute(entry.oracle_sql()[name]).fetchall())
    assert sorted({r[0] for r in got["load_scores_of_all_orders"]}) == orders
    assert [r[0] for r in got["model_only_label_of_all_orders"]] == orders
    assert sum(r[1] for r in got["base_label_counts_of_all_orders"]) == 8 * len(orders)
    assert sorted(tuple(r) for r in entry.queries()["load_scores"](spark, SF).collect()) == got["load_scores_of_all_orders"]
