"""Log parsing, the streaming regression, catalog DDL and partitions."""
import os

import pytest
from pyspark.sql import functions as F

from kestrel.functions import logs
from kestrel.sources import catalog
from kestrel.streaming import regression

LINES = [
    'in24.inetnebr.com - - [01/Aug/1995:00:00:01 -0400] "GET /shuttle/missions/sts-68/news/sts-68-mcc-05.txt HTTP/1.0" 200 1839',
    'uplherc.upl.com - - [01/Aug/1995:00:00:07 -0400] "GET / HTTP/1.0" 304 0',
    'uplherc.upl.com - - [01/Aug/1995:00:00:08 -0400] "GET /images/ksclogo-medium.gif HTTP/1.0" 304 -',
    'ix-esc-ca2-07.ix.netcom.com - - [01/Aug/1995:00:00:09 -0400] "GET /images/launch-logo.gif HTTP/1.0" 200 1713',
    'garbage line',
    'h - - [01/Aug/1995:00:00:10 -0400] "GET /old" 200 5',
]


def test_parse_log_lines(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    got = logs.parse_log_lines(df).collect()
    assert [(r.host, r.path, r.bytes) for r in got] == [
        ("in24.inetnebr.com", "/shuttle/missions/sts-68/news/sts-68-mcc-05.txt", 1839),
        ("uplherc.upl.com", "/", 0),
        ("ix-esc-ca2-07.ix.netcom.com", "/images/launch-logo.gif", 1713)]
    assert str(got[0].datetime) == "1995-08-01 00:00:01"
    every = logs.parse_log_lines(df, keep_bad=True).collect()  # all columns, bad rows too
    assert sum(1 for r in every if not r.ok) == 3
    assert all(r.datetime is None and r.bytes is None for r in every if not r.ok)


def test_row_ids_repeatable(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "h string, b int")
    a = [r.id for r in logs.with_row_id(df).collect()]
    b = [r.id for r in logs.with_row_id(df).collect()]
    assert a == b and len(set(a)) == 2
    assert len({r.id for r in logs.with_row_id(df, random=True).collect()}) == 2


def test_equal_rows_get_different_ids(spark, monkeypatch):
    monkeypatch.setattr(logs, "_COPIES", 7)
    df = spark.createDataFrame([("a", 1)] * 50 + [(None, 1), (None, 1), ("a", None), ("", 1)], "h string, b int")
    ids = sorted(r.id for r in logs.with_row_id(df.repartition(4)).collect())
    assert len(set(ids)) == 54 and ids == sorted(r.id for r in logs.with_row_id(df).collect())


def test_times_that_do_not_exist_are_rejected(spark):
    line = 'h - - [{} -0400] "GET / HTTP/1.0" 200 5'
    times = ["01/Foo/1995:00:00:01", "31/Feb/1995:00:00:01", "01/anF/1995:00:00:01", "x", "01/Dec/1995:23:59:59",
             "01/Jan/1995:24:00:00"]
    df = spark.createDataFrame([(line.format(t),) for t in times] + [(None,)], "value string")
    assert [str(r.datetime) for r in logs.parse_log_lines(df).collect()] == ["1995-12-01 23:59:59"]
    assert [tuple(r) for r in logs.dropped_lines(df).collect()] == [(7, 6)]


def test_hours_do_not_follow_the_session_zone(spark):
    """02:30 does not exist in that zone on that day; the data has no zone."""
    import datetime

    from kestrel.sources import tables
    old = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(datetime.datetime(2024, 3, 10, 2, 30),)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/Vancouver")
    try:
        row = df.select(tables.hour_text().alias("h"), tables.day_text().alias("d")).first()
        assert (row.h, row.d) == ("2024-03-10 02", "2024-03-10")
        line = spark.createDataFrame([('h - - [10/Mar/2024:02:30:00 -0800] "GET / HTTP/1.0" 200 5',)], "value string")
        assert logs.parse_log_lines(line).select(F.col("datetime").cast("string")).first()[0] == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_a_stream_that_does_not_end_in_time_raises(spark, tmp):
    src = os.path.join(tmp, "msgs3")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("1 2\n2 4\n")
    msgs = regression.read_stream(spark, src, fmt="text")
    fit = regression.running_fit(regression.parse_points(msgs))
    with pytest.raises(TimeoutError):
        regression.run_to_table(spark, fit, timeout=0.05)
    with pytest.raises(ValueError):
        regression.run_to_table(spark, fit, available_now=False)


def test_stream_regression_from_text_files(spark, tmp):
    src = os.path.join(tmp, "msgs")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("1 2\n2 4\nnot a number\n")
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("3 7\n\n")
    msgs = regression.read_stream(spark, src, fmt="text")
    out = regression.run_to_table(spark, regression.running_fit(regression.parse_points(msgs)))
    r = out.first()
    assert r.n == 3
    assert r.slope == pytest.approx(2.5) and r.intercept == pytest.approx(-0.6666667, abs=1e-7)


def test_catalog_partitioned_external_table(spark, tmp):
    loc = os.path.join(tmp, "ext_purchases")
    for day, amount in (("2021-08-01", "1.234"), ("2021-08-02", "5.5")):
        d = os.path.join(loc, f"pdate={day}")
        os.makedirs(d)
        with open(os.path.join(d, "part.csv"), "w") as f:
            f.write(f"p1,c1,m1,a1,{amount}\n")
    catalog.create_schema(spark, "s3ext")
    catalog.create_table(spark, "s3ext.purchases",
                         "purchid STRING, custid STRING, pmid STRING, amenid STRING, "
                         "amount DECIMAL(7,2), pdate DATE", fmt="csv", location=loc,
                         partitioned_by=["pdate"])
    assert spark.table("s3ext.purchases").count() == 0
    catalog.add_partitions(spark, "s3ext.purchases", "pdate", ["2021-08-01"])
    assert spark.table("s3ext.purchases").count() == 1
    assert float(spark.table("s3ext.purchases").first().amount) == pytest.approx(1.23)
    catalog.discover_partitions(spark, "s3ext.purchases")
    assert spark.table("s3ext.purchases").count() == 2
    q = spark.table("s3ext.purchases").filter("pdate = DATE'2021-08-02'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2021-08-02" in plan
    catalog.drop_schema(spark, "s3ext")
    assert os.path.isdir(loc)  # external files stay


def test_star_schema_typed_tables_and_varchar_check(spark, tmp):
    catalog.create_schema(spark, "star")
    names = catalog.star_schema_ddl(spark, "star")
    assert len(names) == 5
    p = os.path.join(tmp, "prefixes.csv")
    with open(p, "w") as f:
        f.write("Vancouver,V5K\n")
    catalog.load_csv_into(spark, p, "star.greater_vancouver_prefixes")
    assert spark.table("star.greater_vancouver_prefixes").count() == 1
    with open(p, "w") as f:
        f.write("Burnaby,V5A,extra\n")
    with pytest.raises(catalog.BadRows):
        catalog.load_csv_into(spark, p, "star.greater_vancouver_prefixes")
    with open(p, "w") as f:
        f.write(",V5A\nSurrey,V3R\n")
    catalog.load_csv_into(spark, p, "star.greater_vancouver_prefixes", ["city"], os.path.join(tmp, "bad"))
    assert spark.table("star.greater_vancouver_prefixes").count() == 2
    assert spark.read.json(os.path.join(tmp, "bad")).count() == 1
    with open(p, "w") as f:
        f.write("A city name far too long for it,V5K\n")
    with pytest.raises(Exception):
        catalog.load_csv_into(spark, p, "star.greater_vancouver_prefixes")
    j = os.path.join(tmp, "amen.json")
    with open(j, "w") as f:
        f.write('{"amenid": "a1", "lat": 1.0, "timestamp": "2021-01-01 00:00:00", '
                '"amenity": "cafe", "tags": {"brand": "x"}}\n{broken\n')
    with pytest.raises(catalog.BadRows):
        catalog.load_json_into(spark, j, "star.amenities", renames={"timestamp": "ts"})
    catalog.load_json_into(spark, j, "star.amenities", renames={"timestamp": "ts"}, tolerant=True)
    brand = spark.sql("SELECT try_variant_get(tags, '$.brand', 'string') AS b FROM star.amenities").collect()
    assert sorted(str(r.b) for r in brand) == ["None", "x"]
    rows = spark.table("star.amenities").drop("tags").orderBy("amenid").collect()
    assert len(rows) == 2 and rows[1].amenid == "a1".ljust(11) and rows[1].ts is not None  # CHAR pads
    catalog.drop_schema(spark, "star")


def test_declared_struct_vs_variant(spark, tmp):
    """A declared STRUCT rejects an unknown field; a semi-structured value
    gives NULL for a missing key."""
    from kestrel.operators import etl
    p = os.path.join(tmp, "amen.json")
    with open(p, "w") as f:
        f.write('{"amenid": "a1", "tags": {"brand": "x", "cuisine": "thai"}}\n')
        f.write('{"amenid": "a2", "tags": {"brand": "y"}}\n')
    catalog.create_table(spark, "ext_amenities", "amenid STRING, tags STRUCT<brand: STRING, cuisine: STRING>",
                         fmt="json", location=p)
    t = spark.table("ext_amenities")
    assert sorted((r.amenid, r.tags.cuisine) for r in t.collect()) == [("a1", "thai"), ("a2", None)]
    with pytest.raises(Exception):
        t.select("tags.operator").collect()
    raw = spark.read.text(p)
    v = raw.select(etl.variant_path("value", "$.tags.operator", "string").alias("op")).collect()
    assert [r.op for r in v] == [None, None]
    catalog.drop_table(spark, "ext_amenities")
    assert os.path.exists(p)


def test_console_sink_bounded_run(spark, tmp):
    """Console output goes to the JVM's stdout; check the run is bounded and
    leaves no active query behind."""
    import time
    src = os.path.join(tmp, "msgs2")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("1 2\n2 4\n3 7\n")
    msgs = regression.read_stream(spark, src, fmt="text")
    t0 = time.time()
    regression.run_to_console(regression.running_fit(regression.parse_points(msgs)), seconds=5)
    assert time.time() - t0 < 60
    assert not [q for q in spark.streams.active if q.isActive]


def test_many_partitions_in_one_statement(spark, tmp):
    spark.sql("DROP TABLE IF EXISTS many_parts")
    catalog.create_table(spark, "many_parts", "x int, p string", location=tmp + "/t", partitioned_by=["p"])
    try:
        catalog.add_partitions(spark, "many_parts", "p", [f"v{k}" for k in range(120)], tmp + "/t", per_statement=50)
        assert spark.sql("SHOW PARTITIONS many_parts").count() == 120
    finally:
        catalog.drop_table(spark, "many_parts")
