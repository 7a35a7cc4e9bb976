from pyspark.sql import functions as F

from stormledger.functions import matching, text as X
from stormledger.functions.matching import contains_any, filter_contains_any, prefix_pattern
from stormledger.operators import cleaning as C


def test_unicode_letters_are_folded(values):
    assert values(X.fold_unicode, ["𝗘𝗔𝗥𝗟𝗜𝗘𝗥 é ﬁ x²", "plain", None]) == ["EARLIER e fi x2", "plain", None]


def test_clean_text_stages(values):
    tail = "rain over the hills of the whole province, " * 3
    got = values(X.clean_text, [
        f"See https://a.b/c?d=1 <b>NOW</b> &amp; ==== . . . . {tail}",
        "NaN", None, "short", "2025-10-27 21:39 " * 9, ". . " * 40, "shared a post " + tail,
    ])
    assert got[0] == "see now " + tail.strip()
    assert got[1:6] == ["", "", "", "", ""]
    assert got[6] == " " + tail.strip()  # boilerplate goes without a second trim


def test_quality_gate_border(values):
    assert values(X.quality_gate, ["x" * 89, "x" * 90, "a\nb" * 40]) == ["", "x" * 90, "a\nb" * 40]


def test_tags_stop_at_line_ends(values):
    assert values(X.strip_tags, ["a <b\nc> d", "a <b\x85c> d"]) == ["a <b\nc> d", "a  d"]


def test_page_source(values):
    got = values(C.page_source, [
        "https://www.facebook.com/hashtag/BahaPH?_rdc=1", "https://web.facebook.com/PHIVOLCS/posts/1",
        "https://x.com/phivolcs_dost/status/1", "https://www.netflix.com/GMANews?x", "https://facebook.com/watch/1",
        "https://facebook.com/.Some.Page./x", None, "https://example.org/a",
    ])
    assert got == ["#bahaph", "PHIVOLCS", "phivolcs_dost", "GMA News", None, "some.page", None, None]


def test_contains_any_is_a_substring_test(values):
    assert values(lambda c: contains_any(c, ["ph", "davao city", "a.b"]), ["photo", "axb", "a.b", None]) == [
        True, False, True, False,
    ]


def test_prefix_pattern_matches_exactly_its_words(values):
    words = ["rain", "rains", "rain showers", "so2", "a+b", "hibok-hibok"]
    pattern = r"\A(?:" + prefix_pattern(words) + r")\z"
    texts = words + ["rai", "rain ", "a", "hibok"]
    assert values(lambda c: c.rlike(pattern), texts) == [t in words for t in texts]


def test_word_lists_of_any_length_give_one_answer(spark, monkeypatch):
    texts = ["flood in davao", "nothing", "Photo", "", "the quick brown fox jumps", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")

    def kept(*words):
        table = spark.createDataFrame([(w,) for w in words], "w string")
        return sorted(r.i for r in filter_contains_any(df, "t", table).collect())

    words = ["davao", "ph", "quick brown fox", "zzz", "g", None]
    for size in (10_000, 2, 1):
        monkeypatch.setattr(matching, "PATTERN_WORDS", size)
        assert kept(*words) == [0, 1, 2, 4]
        assert kept("", "zzz") == kept("") == [0, 1, 2, 3, 4]
        assert kept(None) == []
    monkeypatch.setattr(matching, "PATTERN_WORDS", 10_000)
    assert kept(*[f"name number {i}" for i in range(25_000)], "avao") == [0]


def test_junk_runs_of_any_length(values):
    n = 1_000_000
    runs = ["." * n, ". " * n, "7" * n, "7 " * n, "-" * n, "<" * n, "&a" * n, "www." * n, "# " * n]
    assert [len(t) for t in values(X.clean_text, runs)] == [0, 0, 0, 0, 0, n, 2 * n, 0, 2 * n - 1]
    assert values(X.blank_dot_runs, ["a" + "." * n + "b", "a. . .b", "a..b"]) == ["a b", "a b", "a..b"]
    assert values(X.numeric_gate, ["7" * n, "7" * n + "x"]) == ["", "7" * n + "x"]


def test_display_names_are_not_trusted_handles(spark):
    vocab = spark.createDataFrame([("cebu",)], "name string")
    df = spark.createDataFrame(
        [("a", "MPRSD CDO"), ("b", "PHIVOLCS"), ("cebu", None), ("c", None)], "text_content string, page_source string"
    )
    kept = C.keep_trusted_or_local(df, vocab)
    assert sorted(r.text_content for r in kept.collect()) == ["b", "cebu"]


def test_format_columns_refuses_two_locations(spark):
    df = spark.createDataFrame([("a", "b")], "location string, location_matched_json string")
    try:
        C.format_columns(df)
    except ValueError:
        return
    raise AssertionError("expected ValueError")


def test_cleaning_is_not_repeated_by_later_filters(spark):
    df = spark.createDataFrame([("x",)], "text string")
    plan = C.drop_empty(C.clean_posts(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 2 and plan.count("shared a post") == 1


def test_stage_counts_add_up(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, "a")], "row_id int, text_content string")
    steps = {"empty": C.drop_empty, "ones": lambda d: d.filter("row_id = 1")}
    rows = C.stage_counts(df, steps).orderBy("step").collect()
    assert [(r.stage, r.rows_in, r.rows_out, r.dropped) for r in rows] == [
        ("input", 3, 3, 0), ("empty", 3, 2, 1), ("ones", 2, 1, 1),
    ]


def test_long_word_tables_stay_on_spark(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    taken, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: taken.append(collect(self)) or taken[-1])
    table = spark.range(60_000).select(F.concat(F.lit("name "), F.col("id").cast("string"), F.lit(".")).alias("w"))
    texts = ["xname 59999.x", "name 60000.", "Name 7.", None, "", "name 7", "😀name 12345. name 1."]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = filter_contains_any(df, "t", table)
    assert max(map(len, taken), default=0) < 100
    assert len(rows._jdf.queryExecution().toString()) < 50_000
    assert rows.columns == ["i", "t"] and sorted(r.i for r in rows.collect()) == [0, 2, 6]


def test_word_tables_match_as_a_plain_search_does(spark):
    import random

    rng = random.Random(3)
    texts = ["".join(rng.choices("ab é😀", k=rng.randrange(30))) for _ in range(400)]
    words = ["".join(rng.choices("ab é😀", k=rng.randrange(3, 12))) for _ in range(40)]
    df = spark.createDataFrame([(i, t, i % 5 == 0) for i, t in enumerate(texts)], "i int, t string, k boolean").repartition(3)
    table = spark.createDataFrame([(w,) for w in words * 2], "w string")
    want = [i for i, t in enumerate(texts) if any(w in t for w in words)]
    assert sorted(r.i for r in filter_contains_any(df, "t", table).collect()) == want
    kept = filter_contains_any(df, "t", table, keep=F.col("k")).collect()
    assert sorted(r.i for r in kept) == sorted({*want, *range(0, 400, 5)})


def test_every_character_folds_in_the_jvm(spark):
    """The same as normalising in Python, for each character, without rows that wait for a worker."""
    import sys
    import unicodedata

    from pyspark.sql import functions as F

    chars = [chr(c) for c in (*range(1, 0xD800), *range(0xE000, sys.maxunicode + 1)) if unicodedata.category(chr(c)) != "Cn"]
    texts = ["".join(chars[i:i + 400]) for i in range(0, len(chars), 400)] + ["a\u0323\u0307b q\u0307\u0323", "각 ﬁ ½ 가"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("x", X.fold_unicode(F.col("t")))
    assert "EvalPython" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r.i: r.x for r in df.collect()}
    assert got == {i: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for i, t in enumerate(texts)}


def test_stages_scan_only_texts_that_hold_what_they_change(spark, values):
    """Junk runs of 20,000 characters went through every pattern, a replacement for each single space."""
    rows = spark.createDataFrame([("1:2 " * 500, "a\t b \x1c\u00a0c\u00a0d  e \u3000")], "plain string, mixed string")
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern))
    assert rows.select(count("plain", X.WS_RUN_PATTERN), count("mixed", X.WS_RUN_PATTERN)).first()[:] == (0, 5)
    assert values(X.collapse_ws, ["1:2 " * 3, "a\t b \x1c\u00a0c\u00a0d  e \u3000", " \n"]) == ["1:2 1:2 1:2", "a b c d e", ""]
    for stage in (X.strip_urls, X.strip_tags, X.strip_entities, X.blank_separators, X.blank_dot_runs, X.strip_boilerplate):
        assert "contains(" in rows.select(stage(F.col("plain")))._jdf.queryExecution().optimizedPlan().toString()
    # runs of folded characters at the ends, beside one another and alone
    assert values(X.fold_unicode, ["éﬁ", "a\u0301", "é\nﬁ x ½é", "\u0301", "x\n"]) == ["efi", "a", "e\nfi x 1\u20442e", "", "x\n"]
    assert values(X.strip_urls, ["hhttp://q wwwww.k www. http:// https://x"]) == ["h ww www. http:// "]
    assert values(X.blank_dot_runs, ["a. .\t.\n.b..c. . ", "..."]) == ["a b..c. . ", " "]
    assert values(X.blank_separators, ["--a-=*b _ **"]) == ["--a b _ **"]
    assert values(X.strip_boilerplate, ["Shared A post scommented rREPLIED see  more see mores"]) == [" s r see  more s"]
