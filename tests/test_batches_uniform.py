"""Appended batches, stored parts, restarted streams, and numbers that belong to rows."""
import pytest
from pyspark.sql import functions as F

from kestrel.functions.uniform import sample_rows, uniform
from kestrel.sources import batches
from kestrel.streaming import regression


def test_a_batch_is_appended_once(spark, tmp):
    table = tmp + "/t"
    a, b = spark.range(5), spark.range(5, 12)
    assert batches.read_batches(spark, table, a.schema).count() == 0
    assert batches.append_batch(a, table, "2024-01-01") and batches.append_batch(b, table, "01")
    assert not batches.append_batch(b, table, "01")
    got = batches.read_batches(spark, table, a.schema)
    assert sorted(r.id for r in got.collect()) == list(range(12))
    assert {r.batch for r in got.collect()} == {"2024-01-01", "01"}
    for bad in ("", "a/b", "_x", ".x", "a b"):
        with pytest.raises(ValueError):
            batches.append_batch(a, table, bad)


def test_a_batch_that_broke_off_is_not_seen(spark, tmp):
    table = tmp + "/t"
    batches.append_batch(spark.range(3), table, "a")
    spark.range(100, 150).write.parquet(f"{table}/data/batch=b")  # data without an entry
    assert batches.read_batches(spark, table, "id bigint").count() == 3
    assert batches.append_batch(spark.range(3, 5), table, "b")
    assert sorted(r.id for r in batches.read_batches(spark, table, "id bigint").collect()) == [0, 1, 2, 3, 4]
    assert batches.append_batch(spark.range(0), table, "empty")
    assert batches.read_batches(spark, table, "id bigint").count() == 5


def test_replacing_one_stored_part(spark, tmp):
    rows = [("d1", "x", 1.0), ("d1", "x", 3.0), ("d1", "y", None), ("d2", "x", 5.0), ("d2", None, 7.0)]
    df = spark.createDataFrame(rows, "day string, k string, v double")
    batches.store_partial_sums(df, tmp + "/p", "day", ["k"], "v")
    schema = "k string, n bigint, total double, day string"

    def totals():
        return {r.k: (r.n, r.total, r.avg) for r in batches.stored_averages(spark, tmp + "/p", schema, ["k"]).collect()}

    assert totals() == {"x": (3, 9.0, 3.0), "y": (0, None, None), None: (1, 7.0, 7.0)}
    batches.store_partial_sums(spark.createDataFrame([("d2", "x", 9.0)], df.schema), tmp + "/p", "day", ["k"], "v")
    assert totals() == {"x": (3, 13.0, 13 / 3), "y": (0, None, None)}


def test_a_stream_goes_on_after_a_failure(spark, tmp):
    """Each file is one micro-batch; the second fails after its rows are written."""
    for k in range(4):
        spark.createDataFrame([(f"{k * 3 + j} {k * j + 1}",) for j in range(3)], "value string").coalesce(1) \
            .write.mode("append").text(tmp + "/in")
    fit = regression.running_fit(regression.parse_points(
        regression.read_stream(spark, tmp + "/in", max_files_per_trigger=1)))
    ran = []

    def fail(number):
        ran.append(number)
        if number == 1:
            raise RuntimeError("broken off")

    with pytest.raises(Exception, match="broken off"):
        regression.run_to_folder(fit, tmp + "/out", tmp + "/state", fail)
    before = regression.latest_result(spark, tmp + "/out", fit.schema).first()
    regression.run_to_folder(fit, tmp + "/out", tmp + "/state", ran.append)
    assert before.n == 6 and ran == [0, 1, 1, 2, 3]
    whole = regression.running_fit(regression.parse_points(spark.read.text(tmp + "/in"))).first()
    last = regression.latest_result(spark, tmp + "/out", fit.schema).collect()
    assert len(last) == 1 and last[0].n == whole.n == 12 and abs(last[0].slope - whole.slope) < 1e-9
    regression.run_to_folder(fit, tmp + "/out", tmp + "/state", ran.append)  # nothing new
    assert regression.latest_result(spark, tmp + "/out", fit.schema).first().n == 12


def test_numbers_do_not_depend_on_partitions(spark):
    df = spark.range(2000).withColumn("k", (F.col("id") % 7).cast("string"))
    one = {r.id: r.u for r in df.coalesce(1).withColumn("u", uniform(1, "id", "k")).collect()}
    many = {r.id: r.u for r in df.repartition(9).withColumn("u", uniform(1, "id", "k")).collect()}
    assert one == many and all(0 <= u < 1 for u in one.values()) and len(set(one.values())) == 2000
    assert abs(sum(one.values()) / 2000 - 0.5) < 0.03
    assert 0.07 < sample_rows(df, 0.1, 5, "id").count() / 2000 < 0.13
    assert sample_rows(df, 0.0, 5, "id").count() == 0 and sample_rows(df, 1.0, 5, "id").count() == 2000
    odd = spark.createDataFrame([("a", "b"), ("ab", None), (None, "ab"), (None, None), ("", ""), ("-", "-")], "x string, y string")
    assert odd.select(uniform(1, "x", "y").alias("u")).distinct().count() == 6
    assert df.filter(uniform(1, "id") == uniform(2, "id")).count() == 0
