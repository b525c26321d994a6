"""Group maxima, arg-max, relative scores, yesterday join, audits; each
form checked against the other form or a hand answer."""
import datetime as dt

from pyspark.sql import functions as F

from kestrel.operators import aggregate, audit, joins, peaks


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_group_max_keeps_ties_and_negatives(spark):
    df = spark.createDataFrame(
        [("h1", "a", 5), ("h1", "b", 5), ("h1", "c", 1), ("h2", "x", -3), ("h2", "y", -7),
         ("h3", "n", None)], "hour string, title string, views int")
    want = [("h1", "a", 5), ("h1", "b", 5), ("h2", "x", -3)]
    assert _rows(peaks.rows_at_group_max(df, "hour", "views"), "hour", "title", "views") == want
    for b in ("auto", "checked", "never"):
        got = peaks.rows_at_group_max_join(df, "hour", "views", broadcast=b)
        assert _rows(got, "hour", "title", "views") == want
    mx = aggregate.max_by_key(df, "hour", "views", "m")
    assert _rows(mx, "hour", "m") == [("h1", 5), ("h2", -3), ("h3", None)]


def test_argmax_tie_goes_to_greatest_payload(spark):
    df = spark.createDataFrame([("h", "a", 5), ("h", "b", 5), ("h", "c", 1), ("g", "z", None)],
                               "hour string, title string, views int")
    got = aggregate.argmax_by_key(df, "hour", "views", "title")
    assert _rows(got, "hour", "views", "title") == [("g", None, None), ("h", 5, "b")]


def test_partial_sums_merge_to_exact_average(spark):
    df = spark.createDataFrame([("d1", "k", 1.0), ("d1", "k", 2.0), ("d2", "k", 6.0),
                                ("d2", "j", None)], "day string, key string, v double")
    merged = aggregate.merge_partial_sums(aggregate.partial_sums(df, "day", "key", "v"), "key")
    got = {r.key: (r.n, r.total, r.avg) for r in merged.collect()}
    assert got == {"k": (3, 9.0, 3.0), "j": (0, None, None)}


def test_relative_score_forms_agree_and_skip_nonpositive_means(spark):
    df = spark.createDataFrame(
        [("a", "u1", 2.0), ("a", "u2", 4.0), ("b", "u3", -1.0), ("b", "u4", 1.0), ("c", "u5", -2.0)],
        "sub string, author string, score double")
    forms = [joins.relative_to_group_mean(df, "sub", "score", "author", broadcast=b)
             for b in ("auto", "checked", "never")]
    forms.append(joins.relative_to_group_mean_window(df, "sub", "score", "author"))
    for f in forms:
        assert _rows(f, "author", "relative_score") == [("u1", 2.0 / 3.0), ("u2", 4.0 / 3.0)]
    top = forms[0].first()
    assert top.author == "u2"  # sorted descending


def test_checked_broadcast_picks_broadcast_only_when_small(spark):
    big = spark.range(1000).withColumn("k", F.col("id") % 10)
    small = spark.range(10).withColumnRenamed("id", "k")
    plan = joins.join(big, small, "k", broadcast="checked", max_rows=100)._jdf \
        .queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    plan2 = joins.join(big, small, "k", broadcast="checked", max_rows=5)
    assert plan2.count() == 1000


def test_yesterday_join_skips_gaps_and_multiplies_duplicates(spark):
    d = dt.date
    df = spark.createDataFrame(
        [("s", d(2020, 1, 1), 1.0), ("s", d(2020, 1, 2), 2.0), ("s", d(2020, 1, 4), 4.0),
         ("t", d(2020, 1, 2), 9.0), ("t", d(2020, 1, 3), 8.0), ("t", d(2020, 1, 3), 7.0)],
        "station string, date date, tmax double")
    got = joins.previous_day_join(df, "station", "date", "tmax")
    assert _rows(got, "station", "date", "tmax", "yesterday_tmax") == [
        ("s", d(2020, 1, 2), 2.0, 1.0), ("t", d(2020, 1, 3), 7.0, 9.0), ("t", d(2020, 1, 3), 8.0, 9.0)]


def test_first_per_group_is_total_order(spark):
    df = spark.createDataFrame([(1, 10, 5), (1, 10, 3), (1, 11, 1), (2, 1, 9)],
                               "g int, ts int, id int")
    got = peaks.first_per_group(df, "g", ["ts", "id"])
    assert _rows(got, "g", "id") == [(1, 3), (2, 9)]


def test_audits(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "pk int")
    child = spark.createDataFrame([(1,), (3,), (None,)], "fk int")
    assert _rows(audit.duplicate_keys(parent, ["pk"]), "pk", "n_rows") == [(2, 2)]
    assert _rows(audit.orphans(child, "fk", parent, "pk"), "fk") == [(3,)]
    s = audit.orphan_summary(child, "c", "fk", parent, "p", "pk").first()
    assert (s.n_checked, s.n_orphans) == (2, 1)
    nulls = {r.column_name: r.n_nulls for r in audit.null_counts(child).collect()}
    assert nulls == {"fk": 1}


def test_relative_score_skips_rows_without_score(spark):
    df = spark.createDataFrame([("a", "u1", 2.0), ("a", "u2", None), ("a", "u3", 4.0)],
                               "sub string, author string, score double")
    for rel in (joins.relative_to_group_mean(df, "sub", "score", "author"),
                joins.relative_to_group_mean_window(df, "sub", "score", "author")):
        assert _rows(rel, "author", "relative_score") == [("u1", 2.0 / 3.0), ("u3", 4.0 / 3.0)]
