"""Plan checks: pushdown, pruning, partial aggregation, window group limit."""
from conftest import SF_SMALL
from kestrel.plans import queries as Q


def _plan(df):
    """The text ``df.explain('formatted')`` prints."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(Q.etl_positive(spark, SF_SMALL))
    assert "PushedFilters" in plan and "GreaterThan(c_acctbal,0.0)" in plan
    assert "ReadSchema: struct<c_name:string,c_acctbal:double,c_mktsegment:string>" in plan


def test_wordcount_reads_one_column_and_aggregates_partially(spark):
    df = Q.wordcount_ws(spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    ex = _plan(df)
    assert "ReadSchema: struct<text:string>" in ex
    assert "partial_count" in ex or "PartialAggregate" in plan or "HashAggregate" in ex


def test_rank_filter_becomes_window_group_limit(spark):
    ex = _plan(Q.daily_range_peak(spark, SF_SMALL))
    assert "WindowGroupLimit" in ex


def test_partition_pruning(spark):
    ex = _plan(Q.partition_pruned(spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(o_month" in ex and "1996-03" in ex


def test_star_spend_pre_aggregates_orders_before_join(spark):
    ex = _plan(Q.star_spend(spark, SF_SMALL))
    # the first aggregate (per customer) sits below the customer join
    assert ex.count("HashAggregate") >= 4


def test_spread_only_when_asked(spark):
    from kestrel.operators.partitioning import spread_for_cpu
    one = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text")
    assert spread_for_cpu(one) is one
    assert "RoundRobinPartitioning(4)" in _plan(spread_for_cpu(one, 4))


def test_argmax_hashes(spark):
    """Neither aggregate of the arg-max needs sorted rows."""
    plan = _plan(Q.argmax_by_hour(spark, SF_SMALL))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_writers_deal_rows_by_their_folders(spark, tmp):
    """A task writes few folders: one file per day here, not one per task and day."""
    import glob

    from kestrel.sources import sinks
    rows = spark.range(20_000).selectExpr("id", "id % 30 AS day").repartition(8)
    for write in (lambda p: sinks.append_table(rows, p, partition_by=["day"]),
                  lambda p: sinks.replace_partitions(rows, p, ["day"])):
        path = f"{tmp}/t{id(write)}"
        write(path)
        assert len(glob.glob(f"{path}/day=*/*.parquet")) == 30
