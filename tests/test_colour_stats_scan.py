"""Colour conversions, regression/correlation, first crossing: hand answers
and brute force."""
import math
import random

import pytest
from pyspark.sql import functions as F

from kestrel.functions import colour
from kestrel.operators import scan, stats

LAB = {(255, 0, 0): (53.2406, 80.0923, 67.2028), (0, 0, 0): (0.0, 0.0, 0.0),
       (255, 255, 255): (100.0, -0.0025, 0.0047), (117, 60, 0): (31.8404, 21.2894, 42.2742)}


def test_lab_known_values(spark):
    df = spark.createDataFrame(list(LAB), "R int, G int, B int")
    for r in colour.with_lab(df).collect():
        want = LAB[(r.R, r.G, r.B)]
        assert (round(r.labL, 4), round(r.labA, 4), round(r.labB, 4)) == pytest.approx(want, abs=1e-4)


def test_lab_sql_statement_matches_columns(spark):
    from pyspark.ml.feature import SQLTransformer
    df = spark.createDataFrame(list(LAB), "R int, G int, B int")
    t = SQLTransformer(statement=colour.lab_statement(["R", "G", "B"]))
    a = {(r.R, r.G, r.B): (r.labL, r.labA, r.labB) for r in t.transform(df).collect()}
    b = {(r.R, r.G, r.B): (r.labL, r.labA, r.labB) for r in colour.with_lab(df).collect()}
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-9)


def test_hsv_against_colorsys(spark):
    import colorsys
    rnd = random.Random(3)
    rows = [(rnd.randrange(256), rnd.randrange(256), rnd.randrange(256)) for _ in range(200)]
    rows += [(10, 10, 10), (255, 0, 0), (0, 255, 0), (0, 0, 255), (255, 255, 0)]
    df = spark.createDataFrame(rows, "R int, G int, B int")
    for r in colour.with_hsv(df).collect():
        h, s, v = colorsys.rgb_to_hsv(r.R / 255, r.G / 255, r.B / 255)
        assert (r.H, r.S, r.V) == pytest.approx((h, s, v), abs=1e-9)


def test_regression_known_answer_and_single_point(spark):
    pts = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 7.0)], "x double, y double")
    fit = stats.linear_fit(pts, "x", "y").first()
    assert fit.slope == pytest.approx(2.5) and fit.intercept == pytest.approx(-0.6666667, abs=1e-7)
    c = stats.correlation(pts, "x", "y").first()
    assert c.r == pytest.approx(0.9933993, abs=1e-7)
    m = stats.correlation_from_moments(stats.moments(pts, "x", "y")).first()
    assert m.r == pytest.approx(c.r)
    one = pts.limit(1)
    f1 = stats.linear_fit(one, "x", "y").first()
    assert (f1.slope, f1.intercept) == (None, None)
    assert stats.correlation(one, "x", "y").first().r is None


def _brute_crossing(rows, limit):
    by = {}
    for g, t, i, v in sorted(rows):
        by.setdefault(g, []).append(v)
    out = {}
    for g, vs in by.items():
        s = 0.0
        for k, v in enumerate(vs, 1):
            s += v
            if s >= limit:
                out[g] = k
                break
    return out


def test_first_crossing_with_hot_group_equals_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(6000):  # group 0 holds half of all rows
        g = 0 if i % 2 == 0 else rnd.randrange(1, 40)
        rows.append((g, rnd.randrange(1000), i, rnd.choice([-1.0, 1.0]) * rnd.random() + 0.4))
    df = spark.createDataFrame(rows, "g int, t int, i int, v double")
    got = scan.first_crossing(df, "g", ["t", "i"], "v", 60.0, chunks=16)
    assert {r.g: r.steps for r in got.collect()} == _brute_crossing(rows, 60.0)
    run = scan.running_sum(df, "g", ["t", "i"], "v", chunks=16)
    hot = run.filter("g = 0").agg(F.max("position").alias("p")).first().p
    assert hot == 3000


def test_first_crossing_of_uniforms_tends_to_e(spark):
    """The Monte Carlo estimate of e: draws per trial until the sum reaches 1."""
    from kestrel.sources.files import trials
    n = 20000
    draws = trials(spark, n * 12, 8).select(
        (F.col("id") % n).alias("trial"), (F.col("id") / n).cast("int").alias("k"),
        F.rand(7).alias("u"))
    c = scan.mean_first_crossing(scan.first_crossing(draws, "trial", ["k"], "u", 1.0)).first()
    assert c.n_groups == n
    assert abs(c.mean_steps - math.e) < 0.05
