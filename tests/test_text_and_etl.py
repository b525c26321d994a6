"""Tokenising, ETL filters, JSON and sinks, with the edge rows of FIXTURES.md."""
import json
import os

from pyspark.sql import functions as F

from kestrel.functions import text
from kestrel.operators import aggregate, etl
from kestrel.sources import files, sinks


def _words(spark, lines, unicode=False, punct=False):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    toks = (text.split_lower_words("value", unicode) if punct
            else text.split_words("value", unicode))
    via_arrays = [r.word for r in text.explode_words(df, "value", tokens=toks).collect()]
    direct = [r.word for r in text.explode_words(df, "value", lower=punct, punct=punct,
                                                 unicode=unicode).collect()]
    assert via_arrays == direct
    return direct


def test_whitespace_split_drops_empty_tokens(spark):
    assert _words(spark, ["  leading blanks here", "", "a\tb\nc"]) == \
        ["leading", "blanks", "here", "a", "b", "c"]


def test_nbsp_is_not_ascii_whitespace(spark):
    line = "one\u00a0two three"
    assert _words(spark, [line]) == ["one\u00a0two", "three"]
    assert _words(spark, [line], unicode=True) == ["one", "two", "three"]


def test_punct_split_lowercases(spark):
    assert _words(spark, ["Hello, World! it's-OK..."], punct=True) == \
        ["hello", "world", "it", "s", "ok"]


def test_word_count(spark):
    df = spark.createDataFrame([("a b a",), ("b a",)], "value string")
    counts = aggregate.count_by_key(text.explode_words(df, "value"), "word", "n")
    assert {r.word: r.n for r in counts.collect()} == {"a": 3, "b": 2}


def test_csv_space_delimited_title_with_quote(spark, tmp):
    p = os.path.join(tmp, "pages.txt")
    with open(p, "w") as f:
        f.write('en "Foo 12 34\nen Bar 5 6\n')
    schema = "locale string, title string, views int, bytes long"
    quoted = files.read_csv(spark, p, schema, sep=" ").collect()
    plain = files.read_csv(spark, p, schema, sep=" ", quote="").collect()
    assert [r.views for r in plain] == [12, 5]
    assert plain[0].title == '"Foo'
    assert quoted[0].views != 12  # the default quote swallows the line


def test_source_file_and_stamp(spark, tmp):
    for name in ("pagecounts-20160801-120000", "nodate"):
        with open(os.path.join(tmp, name), "w") as f:
            f.write("en A 1 1\n")
    df = files.with_source_file(files.read_csv(spark, tmp, "locale string, title string, views int, bytes long", sep=" "))
    stamp = F.nullif(F.regexp_extract("file_path", r"(\d{8}-\d{2})[^/]*$", 1), F.lit(""))
    got = {r.file_path.rsplit("/", 1)[1]: r.s for r in df.select("file_path", stamp.alias("s")).collect()}
    assert got == {"pagecounts-20160801-120000": "20160801-12", "nodate": None}
    assert all(tmp in r.file_path for r in df.collect())  # the full path: equal names stay apart


def test_json_missing_key_and_malformed(spark, tmp):
    p = os.path.join(tmp, "c.json")
    with open(p, "w") as f:
        f.write('{"subreddit": "a", "score": 3, "author": "x"}\n')
        f.write('{"subreddit": "a", "author": "y"}\n')
        f.write('{not json\n')
    df = files.read_json(spark, p, "subreddit string, score long, author string")
    rows = df.collect()
    assert len(rows) == 3
    assert rows[1].score is None
    avg = aggregate.avg_by_key(df.filter("subreddit is not null"), "subreddit", "score")
    assert avg.collect()[0]["avg"] == 3.0


def test_observation_filter_flags_and_prefix(spark):
    rows = [("CA1", "20200101", "TMAX", 123, None), ("CA1", "20200101", "TMAX", 50, "X"),
            ("US1", "20200101", "TMAX", 10, None), ("CA2", "20200101", "TMIN", 5, None)]
    df = spark.createDataFrame(rows, "station string, date string, observation string, value int, qflag string")
    out = etl.observations(df, "qflag", "station", "CA", "observation", "TMAX", "value", "date").collect()
    assert [(r.station, r.tmax) for r in out] == [("CA1", 12.3)]


def test_split_write_two_sides(spark, tmp):
    df = spark.createDataFrame([("ae", 1, "x"), ("be", -1, "y"), ("ce", None, "z")],
                               "subreddit string, score long, author string")
    out = os.path.join(tmp, "split")
    sinks.split_write(df, F.col("score") > 0, out)
    pos = spark.read.json(os.path.join(out, "side=positive")).collect()
    neg = spark.read.json(os.path.join(out, "side=negative")).collect()
    assert [r.author for r in pos] == ["x"]
    assert sorted(r.author for r in neg) == ["y", "z"]


def test_json_line_and_variant(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"b": "q"}',), ("oops",)], "t string")
    got = df.select(etl.variant_path("t", "$.a", "bigint").alias("a"),
                    etl.variant_path("t", "$.b", "string").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(1, None), (None, "q"), (None, None)]
    line = df.limit(1).select(etl.to_json_line(F.lit(1).alias("x"))).first()[0]
    assert json.loads(line) == {"x": 1}


def test_text_sink_format(spark, tmp):
    df = spark.createDataFrame([("a", 3)], "word string, n long")
    out = os.path.join(tmp, "wc")
    sinks.write_lines(df, out, fmt="%s %d")
    assert [r.value for r in spark.read.text(out).collect()] == ["a 3"]
    sinks.write_csv(df, out + "_csv")
    assert spark.read.csv(out + "_csv").count() == 1
    sinks.write_json(df, out + "_gz", compression="gzip")
    assert any(n.endswith(".gz") for n in os.listdir(out + "_gz"))
    assert spark.read.json(out + "_gz").count() == 1


def test_preview_and_literal_rows(spark):
    df = files.rows(spark, [(1, "a", [1, 2]), (2, "b", [])], "k int, s string, xs array<bigint>")
    assert [tuple(r) for r in df.collect()] == [(1, "a", [1, 2]), (2, "b", [])]
    assert sinks.preview(df, 1).count() == 1


def test_split_trim_literal_separator(spark):
    df = spark.createDataFrame([("6:  1 5 ",), ("a.b . c",)], "v string")
    got = df.select(text.split_trim("v", ":").alias("p")).first().p
    assert got == ["6", "1 5"]
    assert df.select(text.split_trim("v", ".").alias("p")).collect()[1].p == ["a", "b", "c"]


def test_most_viewed_page_per_hour_from_files(spark, tmp):
    """The page-view job end to end: space-delimited files whose names carry
    the hour, filters, per-hour maximum with ties kept."""
    from kestrel.operators import peaks
    files_ = {"pagecounts-20160801-120000": ["en Main_Page 500 1", "en Special:Search 400 1",
                                             "en A 7 1", "en B 7 1", "fr C 99 1", 'en "Q 3 1'],
              "pagecounts-20160801-130000": ["en A 2 1", "en D 9 1"]}
    for name, lines in files_.items():
        with open(os.path.join(tmp, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    raw = files.with_source_file(files.read_csv(
        spark, tmp, "locale string, title string, views int, bytes long", sep=" ", quote=""))
    hour = F.nullif(F.regexp_extract("file_path", r"(\d{8}-\d{2})[^/]*$", 1), F.lit(""))
    pages = etl.page_views(raw.withColumn("hour", hour))
    top = peaks.rows_at_group_max_join(pages, "hour", "views", broadcast="checked")
    got = sorted((r.hour, r.title, r.views) for r in top.collect())
    assert got == [("20160801-12", "A", 7), ("20160801-12", "B", 7), ("20160801-13", "D", 9)]


def test_append_to_catalog_table_and_read_back(spark):
    df = spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d2")], "host string, bytes int, day string")
    spark.sql("DROP TABLE IF EXISTS kestrel_logs_t")
    sinks.append_table(df, "kestrel_logs_t", partition_by=["day"], as_table=True)
    sinks.append_table(df, "kestrel_logs_t", partition_by=["day"], as_table=True)
    t = files.read_table(spark, "kestrel_logs_t", fmt="table")
    assert t.count() == 4 and t.filter("day = 'd1'").count() == 2
    spark.sql("DROP TABLE kestrel_logs_t")
