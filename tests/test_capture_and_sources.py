import datetime as dt

import pytest

from stormledger import dictionaries as D
from stormledger.operators import capture as K
from stormledger.schemas import CARDS
from stormledger.sources import gazetteer as G
from stormledger.sources import snapshots as S


def test_caption_takes_blocks_by_position(values):
    got = values(K.caption, [[" a ", " ", "c"], ["a", "b", "c"], [], None], "array<string>")
    assert got == ["a", "a b", None, None]


def test_comment_tail(values):
    got = values(K.cut_comment_tail, [
        "flood now\nkeep going\nIngat kayo\nmore", "salamat po", "po first\nlast po", "x\nsee more comments", "we see more comments",
        "pusong po lang\n", "Stay safe\nall",
    ])
    assert got == ["flood now keep going", "", "po first", "x", "we see more comments", "pusong po lang", ""]


def test_min_words(values):
    assert values(K.min_words, ["a b", " a  b\nc ", "", None]) == [None, " a  b\nc ", None, None]


def test_keywords_with_capitals_never_match(spark):
    df = spark.createDataFrame([("taal is calm",), ("LPA",), ("Big FLOOD",)], "text string")
    assert [r[0] for r in K.keyword_filter(df).collect()] == ["Big FLOOD"]
    assert K.keyword_filter(df, strict=True).count() == 3


def cards(spark, *rows):
    names = [f.name for f in CARDS]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], CARDS)


def test_facebook_and_x_posts(spark):
    vocab = spark.createDataFrame([("davao",)], "name string")
    base = {"source": "Facebook", "query_page": "p", "query_kind": "page", "blocks": ["Flood in Davao today"], "page_url": "u"}
    x = {"source": "X", "query_page": "q", "blocks": ["Flood in Davao"], "time_iso": "2025-10-27T10:09:00.000Z"}
    table = cards(
        spark,
        base | {"utime": 1761560940}, base | {"utime": 0, "user": "me", "link": "l"}, base | {"utime": 5},
        base | {"utime": 1761560940, "query_kind": "query"}, base | {"blocks": ["Flood Davao"]}, base | {"blocks": ["Flood in Cebu now"]},
        x | {"link": "https://x.com/me/status/1"}, x | {"link": "x.com/me"}, x | {"time_iso": "soon"}, x | {"time_iso": "2025-10-26T10:09:00Z"},
        x,
    )
    fb = K.capture_facebook(table, vocab, "2025-10-27 00:00:00", "2025-10-28 00:00:00").collect()
    assert sorted((r.post_timestamp, r.user, r.post_url) for r in fb) == [
        ("2025-10-27 18:29:00", "Unknown", "u"), ("Unknown", "me", "l"),
    ]
    got = K.capture_x(table, vocab, "2025-10-27 00:00:00")
    assert sorted((r.post_timestamp, r.user, str(r.post_url)) for r in got.collect()) == [
        ("2025-10-27 18:09", "me", "https://x.com/me/status/1"), ("2025-10-27 18:09", "unknown", "None"),
        ("2025-10-27 18:09", "unknown", "None"),
    ]
    stats = {(r.source, r.query_page): (r.scanned, r.added) for r in K.ingest_stats(table, got).collect()}
    assert stats[("X", None)] == (5, 3) and stats[("Facebook", "p")] == (6, 0)


def test_csv_with_mark_and_lines(spark, tmp_path):
    path = tmp_path / "raw_2025.csv"
    path.write_text(
        "﻿source,query_page,text,post_timestamp,scraped_timestamp,user,post_url\n"
        'X,p,"two\nlines, ""quoted""",Unknown,2025-10-27 21:27,u,https://x.com/u\n', encoding="utf-8",
    )
    row = S.read_posts(spark, str(path)).first()
    assert (row.source, row.text, row.post_url) == ("X", 'two\nlines, "quoted"', "https://x.com/u")
    with pytest.raises(FileNotFoundError):
        S.read_posts(spark, str(tmp_path / "none.csv"))


def test_newest_file_and_inventory(spark, tmp_path):
    import os

    for i, name in enumerate(["raw_1.csv", "raw_3.csv", "raw_2.csv", "other_9.csv"]):
        (tmp_path / name).write_text(f"a\n{name}\n")
        os.utime(tmp_path / name, (1000 + min(i, 2), 1000 + min(i, 2)))
    assert S.read_latest(spark, str(tmp_path), "raw").first().a == "raw_2.csv"
    assert S.snapshot_inventory(spark, str(tmp_path)).count() == 4
    assert S.snapshot_inventory(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(FileNotFoundError):
        S.read_latest(spark, str(tmp_path), "missing")


def test_snapshots_are_never_replaced(spark, tmp_path):
    ts = dt.datetime(2025, 10, 27, 21, 40)
    path = S.write_snapshot(spark.range(3), str(tmp_path), "final_output", ts)
    assert path.endswith("final_output/run_ts=2025-10-27_2140")
    with pytest.raises(Exception):
        S.write_snapshot(spark.range(3), str(tmp_path), "final_output", ts)


def test_gazetteer_files_keep_leading_zeros(spark, tmp_path):
    (tmp_path / "r.csv").write_text('"id","psgcCode","regDesc","regCode"\n"1","010000000","REGION I (ILOCOS REGION)","01"\n')
    (tmp_path / "p.csv").write_text('"id","psgcCode","provDesc","regCode","provCode"\n"1","012800000","ILOCOS NORTE","01","0128"\n')
    gaz = G.load_gazetteer(spark, str(tmp_path / "r.csv"), str(tmp_path / "p.csv"))
    assert sorted((r.level, r.code, r.parent_code, r.name_norm) for r in gaz.collect()) == [
        ("province", "0128", "01", "ilocos norte"), ("region", "01", None, "region i (ilocos region)"),
    ]
    names = {r.name for r in G.location_vocab(gaz).collect()}
    assert names == {"ilocos norte", "region i (ilocos region)"} | set(D.EXTRA_PLACE_NAMES)


def test_newest_snapshot_is_read_whole_and_folders_are_not_searched(spark, tmp_path):
    rows = spark.range(10).selectExpr("cast(id as string) a")
    old = S.write_snapshot(rows.filter("a = '1'"), str(tmp_path), "raw", dt.datetime(2025, 1, 1), "csv")
    S.write_snapshot(rows.repartition(3), str(tmp_path), "raw", dt.datetime(2025, 1, 2), "csv")
    assert S.read_latest(spark, str(tmp_path / "raw"), "run_ts", "=").count() == 10
    assert S.snapshot_inventory(spark, str(tmp_path / "raw")).count() == 0
    assert S.snapshot_inventory(spark, old).count() == 1
    S.write_snapshot(rows, str(tmp_path), "table", dt.datetime(2025, 1, 2))
    S.write_snapshot(rows.limit(4), str(tmp_path), "table", dt.datetime(2025, 1, 3))
    assert S.newest_run(spark, str(tmp_path), "table").count() == 4


def test_union_numbers_rows_in_order(spark):
    first = spark.range(0, 50, 1, 3).selectExpr("id a")
    second = spark.range(50, 57, 1, 2).selectExpr("id a", "'x' b")
    got = S.union_posts(first, second, index_col="post_id").collect()
    assert sorted((r.post_id, r.a) for r in got) == [(i, i) for i in range(57)]
    assert S.union_posts(first.limit(0), index_col="post_id").count() == 0
