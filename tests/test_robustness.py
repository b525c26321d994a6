"""NULL keys, tables as folders, large numbers, order of sorted results, planted audit rows,
the shared folder."""
import glob
import os
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kestrel.functions.numeric import fixed
from kestrel.operators import aggregate, audit, joins, peaks, scan
from kestrel.plans.oracle import ORACLE
from kestrel.plans.queries import QUERIES
from tools.compare import digest


@pytest.fixture(scope="module")
def folder_tables(spark, tmp_path_factory):
    """The smallest tables as folders of part files, events and orders with rows
    of NULL keys and values."""
    out = str(tmp_path_factory.mktemp("folders"))
    for path in glob.glob(f"{SF_SMALL}/*.parquet"):
        name = os.path.basename(path)
        df = spark.read.parquet(path)
        if name == "events.parquet":
            df = df.unionByName(df.limit(40).withColumn("value", F.lit(None).cast("double"))
                                .withColumn("event_id", F.col("event_id") + 10_000_000))
        if name == "customer.parquet":
            lost = df.limit(10).withColumn("c_custkey", F.col("c_custkey") + 100_000) \
                .withColumn("c_acctbal", F.lit(None).cast("double"))
            df = df.unionByName(lost)
        if name == "orders.parquet":
            lost = df.limit(10).withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000) \
                .withColumn("o_custkey", F.lit(None).cast(df.schema["o_custkey"].dataType))
            df = df.unionByName(lost)
        df.repartition(3).write.parquet(f"{out}/{name}")
    return out


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_folder_tables_with_nulls(spark, folder_tables, name):
    con = duckdb.connect()
    for path in glob.glob(f"{folder_tables}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    df = QUERIES[name](spark, folder_tables)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(cols, want)[0]


def test_running_sum_keeps_null_groups_and_values(spark):
    rows = [("a", 1, 5.0), ("a", 2, None), ("a", 3, 7.0), (None, 1, 2.0), (None, 2, 3.0)]
    df = spark.createDataFrame(rows, "g string, o int, v double")
    for chunks in (1, 4, 5):
        got = {(r.g, r.o): (r.position, r.running_sum) for r in scan.running_sum(df, "g", ["o"], "v", chunks).collect()}
        assert got == {("a", 1): (1, 5.0), ("a", 2): (2, 5.0), ("a", 3): (3, 12.0), (None, 1): (1, 2.0), (None, 2): (2, 5.0)}
    got = {r.g: r.steps for r in scan.first_crossing(df, "g", ["o"], "v", 5.0, 4).collect()}
    assert got == {"a": 1, None: 2}


@pytest.mark.parametrize("broadcast", ["auto", "checked", "never"])
def test_both_forms_of_group_maximum_keep_the_null_group(spark, broadcast):
    rows = [(None, 3, "x"), (None, 3, "y"), (None, 1, "z"), ("a", None, "n"), ("a", 2, "p"), ("b", None, "q")]
    df = spark.createDataFrame(rows, "g string, v int, p string")
    win = sorted(map(str, peaks.rows_at_group_max(df, "g", "v").collect()))
    join = sorted(map(str, peaks.rows_at_group_max_join(df, "g", "v", broadcast, rows_per_task=1).collect()))
    assert win == join and len(win) == 3


def test_argmax_of_ties_and_nulls(spark):
    rows = [("a", 1.0, 5), ("a", 2.0, 3), ("a", 2.0, 4), ("a", None, 99), ("b", None, 1), (None, 1.0, 7)]
    df = spark.createDataFrame(rows, "k string, v double, p long")
    got = {r.k: (r.v, r.p) for r in aggregate.argmax_by_key(df, "k", "v", "p").collect()}
    assert got == {"a": (2.0, 4), "b": (None, None), None: (1.0, 7)}


def test_large_numbers_are_not_cut(spark):
    df = spark.createDataFrame([(1e20,), (-1e20,), (9.5e14,), (0.95625,), (None,)], "x double")
    got = [r[0] for r in df.select(fixed("x", 4).alias("x")).collect()]
    assert got == [1e20, -1e20, 9.5e14, 0.9563 if got[3] == 0.9563 else 0.9562, None]


def test_two_sides_are_complementary(spark):
    from kestrel.operators import etl
    df = spark.createDataFrame([("sE", 1.0), ("sE", -1.0), ("sE", None), ("x", 1.0)], "s string, v double")
    sides = [etl.segment_rows(df, "s", "E", "v", p, ["s", "v"]).count() for p in (True, False)]
    assert sides == [1, 2]


def test_audits_find_planted_rows(spark):
    child = spark.createDataFrame([(1, 10), (1, 10), (2, 99), (3, None), (4, 99)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (11,), (None,)], "pk int")
    assert [tuple(r) for r in audit.duplicate_keys(child, ["id"]).collect()] == [(1, 2)]
    assert sorted(r.id for r in audit.orphans(child, "fk", parent, "pk").collect()) == [2, 4]
    row = audit.orphan_summary(child, "c", "fk", parent, "p", "pk").first()
    assert (row.n_checked, row.n_orphans) == (4, 2)
    assert {r.column_name: r.n_nulls for r in audit.null_counts(child).collect()} == {"id": 0, "fk": 1}


@pytest.mark.parametrize("name, keys", [
    ("wordcount_ws", [("word", False)]), ("wordcount_punct", [("word", False)]),
    ("relative_score", [("relative_score", True), ("c_name", False)]),
    ("daily_range_peak", [("day", False), ("user_id", False)]), ("temp_range_csv", [("date", False), ("station", False)]),
    ("peak_ties", [("hour", False), ("event_type", False)])])
def test_sorted_results_are_in_order(spark, name, keys):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    marks = [tuple((-r[k] if down else r[k].encode() if isinstance(r[k], str) else r[k]) for k, down in keys) for r in rows]
    assert marks == sorted(marks) and len(rows) > 1


def test_partitions_are_sorted(spark):
    parts = QUERIES["within_partition_sort"](spark, SF_SMALL).withColumn("p", F.spark_partition_id()).collect()
    by = {}
    for r in parts:
        by.setdefault(r.p, []).append(r.word.encode())
    assert all(w == sorted(w) for w in by.values()) and sum(map(len, by.values())) == len(parts)


def test_small_is_measured_in_rows_and_bytes(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.is_small(df, 100) and not joins.is_small(df, 99) and not joins.is_small(df, 100, 50_000)


def test_salts_are_the_same_in_every_attempt(spark):
    big = spark.range(3000).selectExpr("id % 2 AS k", "id AS v")
    per = big.groupBy("k").agg(F.count("*").alias("n"))
    a, b = (sorted(tuple(r) for r in joins.join_per_key(big.repartition(n), per, "k", "n", rows_per_task=100)
                   .select("k", "v").collect()) for n in (3, 7))
    assert a == b and len(a) == 3000


def test_loading_the_same_days_again_changes_nothing(spark, tmp):
    from kestrel.sources import sinks
    df = spark.createDataFrame([("a", "d1"), ("b", "d2")], "v string, day string")
    sinks.replace_partitions(df, tmp + "/t", ["day"])
    sinks.replace_partitions(df.filter("day = 'd2'"), tmp + "/t", ["day"])
    assert spark.read.parquet(tmp + "/t").count() == 2


def test_a_cluster_needs_a_shared_folder():
    """Off local masters a missing checkpoint folder raises; no folder of the driver's is taken."""
    from kestrel import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_scratch_goes_when_the_application_ends(tmp):
    """A run of its own: its scratch tables are gone afterwards."""
    import subprocess
    import sys
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from kestrel.session import local_session, scratch_path
spark = local_session(1, 1, extra_conf={{"spark.checkpoint.dir": {tmp + '/ck'!r}}})
path = scratch_path(spark, "t")
spark.range(5).write.parquet(path)
print("THERE", spark.read.parquet(path).count())
spark.stop()
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240)
    assert "THERE 5" in out.stdout, out.stderr[-500:]
    assert not glob.glob(f"{tmp}/ck/**/t-*", recursive=True)
    shutil.rmtree(tmp + "/ck", ignore_errors=True)
