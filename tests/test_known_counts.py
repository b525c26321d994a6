"""Driver-table counts at sf0.01 known from independent probes (FIXTURES.md)."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from kestrel.functions import text
from kestrel.operators import graph, weather
from kestrel.plans import queries as Q
from kestrel.sources.tables import load


def test_token_counts(spark):
    docs = load(spark, SF_MID, "documents")
    ws = text.explode_words(docs, "text")
    assert ws.count() == 390171
    assert ws.distinct().count() == 93796
    pu = text.explode_words(docs, "text", lower=True, punct=True)
    assert pu.count() == 385538
    assert pu.distinct().count() == 68844


def test_peak_and_yesterday_counts(spark):
    assert Q.peak_ties(spark, SF_MID).count() == 971
    assert Q.yesterday_join(spark, SF_MID).count() == 3438


def test_first_crossing_known_mean(spark):
    r = Q.first_crossing(spark, SF_MID).first()
    assert r.n_groups == 150
    assert r.mean_steps == pytest.approx(11.006667, abs=1e-6)


def test_new_nodes_per_round_on_urgent_orders(spark):
    """Edges from urgent orders only: new nodes per round 1, 4, 7, 14, 28, 54, 103."""
    orders = load(spark, SF_MID, "orders").filter(F.col("o_orderpriority").startswith("1"))
    edges = orders.select(F.col("o_custkey").alias("src"), (F.col("o_orderkey") % 1500).alias("dest"))
    p = graph.bfs(spark, edges, 1, max_rounds=6)
    per_round = {r.distance: r["count"] for r in p.groupBy("distance").count().collect()}
    assert [per_round[k] for k in range(7)] == [1, 4, 7, 14, 28, 54, 103]


def test_weather_range_with_duplicates_and_flags(spark):
    rows = [("S1", "20200101", "TMAX", 300, None), ("S1", "20200101", "TMAX", 310, None),
            ("S1", "20200101", "TMIN", 100, None), ("S1", "20200101", "TMIN", 50, "X"),
            ("S2", "20200101", "TMAX", 290, None), ("S2", "20200101", "TMIN", 80, None),
            ("S3", "20200101", "TMAX", 400, None)]
    obs = spark.createDataFrame(
        [(s, d, o, v, None, q, None, None) for s, d, o, v, q in rows], weather.WEATHER_SCHEMA)
    rng = {r.station: r.range for r in weather.daily_range(obs).collect()}
    assert rng == {"S1": 21.0, "S2": 21.0}
    top = weather.widest_range_per_day(obs).collect()
    assert [(r.station, r.range) for r in top] == [("S1", 21.0), ("S2", 21.0)]
