"""The file-to-file jobs on small input files in the reference's formats."""
import datetime as dt
import json
import math
import os
import random

import pytest

from kestrel import jobs


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def _lines(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


def test_wordcounts(spark, tmp):
    _write(f"{tmp}/in/a.txt", ["  The cat, the hat.", "", "cat hat"])
    jobs.wordcount(spark, f"{tmp}/in", f"{tmp}/wc")
    assert _lines(spark, f"{tmp}/wc") == ["The 1", "cat, 1", "cat hat 1", "hat. 1", "the 1"]
    jobs.wordcount_improved(spark, f"{tmp}/in", f"{tmp}/wc2")
    assert _lines(spark, f"{tmp}/wc2") == ["cat 1", "cat hat 1", "hat 1", "the 2"]


COMMENTS = [
    {"subreddit": "science", "score": 10, "author": "a"},
    {"subreddit": "science", "score": 20, "author": "b"},
    {"subreddit": "neg", "score": -5, "author": "c"},
    {"subreddit": "neg", "score": -1, "author": "d"},
    {"subreddit": "science", "author": "e"},
]


def test_reddit_jobs(spark, tmp):
    _write(f"{tmp}/c/part-0", [json.dumps(c) for c in COMMENTS] + ["{broken"])
    jobs.reddit_average(spark, f"{tmp}/c", f"{tmp}/avg")
    got = {r.subreddit: r.average for r in spark.read.json(f"{tmp}/avg").collect()}
    assert got == {"neg": -3.0, "science": 15.0}
    jobs.relative_score(spark, f"{tmp}/c", f"{tmp}/rel")
    assert _lines(spark, f"{tmp}/rel") == ["1.333333 b", "0.666667 a"]
    jobs.reddit_etl(spark, f"{tmp}/c", f"{tmp}/etl")
    pos = spark.read.json(f"{tmp}/etl/side=positive").collect()
    neg = spark.read.json(f"{tmp}/etl/side=negative").collect()
    assert sorted(r.author for r in pos) == ["a", "b"]
    assert sorted(r.author for r in neg) == ["c", "d", "e"]


WEATHER = [
    "CA001,20160101,TMAX,150,,,S,", "CA001,20160101,TMIN,-20,,,S,", "CA001,20160101,TMAX,170,,,S,",
    "CA002,20160101,TMAX,100,,,S,", "CA002,20160101,TMIN,-90,,,S,",
    "US003,20160101,TMAX,400,,X,S,", "US003,20160101,TMIN,0,,,S,",
    "CA001,20160102,TMAX,50,,,S,", "CA001,20160102,TMIN,10,,,S,",
]


def test_weather_jobs(spark, tmp):
    _write(f"{tmp}/w/obs.csv", WEATHER)
    jobs.temp_range(spark, f"{tmp}/w", f"{tmp}/range")
    got = sorted(tuple(r) for r in spark.read.csv(f"{tmp}/range").collect())
    assert got == [("20160101", "CA001", "19.0"), ("20160101", "CA002", "19.0"),
                   ("20160102", "CA001", "4.0")]
    jobs.weather_etl(spark, f"{tmp}/w", f"{tmp}/etl")
    rows = spark.read.json(f"{tmp}/etl").collect()
    assert sorted((r.station, r.tmax) for r in rows) == [
        ("CA001", 5.0), ("CA001", 15.0), ("CA001", 17.0), ("CA002", 10.0)]


def test_correlate_and_load_logs(spark, tmp):
    lines, counts = [], {}
    rnd = random.Random(1)
    for i in range(60):
        h = f"h{i % 7}"
        b = rnd.randrange(100, 9000)
        lines.append(f'{h} - - [01/Aug/1995:00:00:{i % 60:02d} -0400] "GET /p{i} HTTP/1.0" 200 {b}')
        n, s = counts.get(h, (0, 0))
        counts[h] = (n + 1, s + b)
    lines.append('bad - - [01/Aug/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 -')
    _write(f"{tmp}/logs/a.log", lines)
    r, r2 = jobs.correlate_logs(spark, f"{tmp}/logs")
    xs, ys = zip(*counts.values())
    mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
    cov = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
    want = cov / math.sqrt(sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys))
    assert r == pytest.approx(want) and r2 == pytest.approx(want ** 2)
    jobs.load_logs(spark, f"{tmp}/logs", f"{tmp}/table")
    jobs.load_logs(spark, f"{tmp}/logs", f"{tmp}/table")
    t = spark.read.parquet(f"{tmp}/table")
    assert t.count() == 60 and t.select("id").distinct().count() == 60  # the same load again changes nothing


def test_shortest_path_job(spark, tmp):
    _write(f"{tmp}/g/links-simple-sorted.txt", ["1: 3 5", "2: 4", "3: 2 5", "4: 3", "5:", "6: 1 5"])
    assert jobs.shortest_path(spark, f"{tmp}/g", f"{tmp}/out", "1", "4") == [1, 3, 2, 4]
    assert _lines(spark, f"{tmp}/out/path") == ["1", "3", "2", "4"]
    assert jobs.shortest_path(spark, f"{tmp}/g", f"{tmp}/out6", "1", "6") == []


def test_wikipedia_popular_job(spark, tmp):
    _write(f"{tmp}/pv/pagecounts-20160801-120000",
           ["en Main_Page 500 1", "en Special:Search 400 1", "en A 7 1", "en B 7 1", 'en "Q 3 1'])
    jobs.wikipedia_popular(spark, f"{tmp}/pv", f"{tmp}/pop")
    got = sorted((r.hour, r.title, r.views) for r in spark.read.json(f"{tmp}/pop").collect())
    assert got == [("20160801-12", "A", 7), ("20160801-12", "B", 7)]


def test_weather_model_jobs(spark, tmp):
    rows = []
    for s, (lat, lon, el) in {"S1": (49.0, -123.0, 10.0), "S2": (45.0, -75.0, 100.0)}.items():
        for k in range(60):
            d = dt.date(2016, 1, 1) + dt.timedelta(days=k)
            rows.append(f"{s},{d},{lat},{lon},{el},{10 + 5 * math.sin(k / 9.0):.2f}")
    _write(f"{tmp}/tmax/part.csv", rows)
    r2, rmse = jobs.weather_train(spark, f"{tmp}/tmax", f"{tmp}/model")
    assert rmse >= 0
    jobs.weather_test(spark, f"{tmp}/model", f"{tmp}/tmax")
    jobs.weather_tomorrow(spark, f"{tmp}/model", f"{tmp}/tmax", f"{tmp}/tomorrow")
    out = spark.read.csv(f"{tmp}/tomorrow").collect()
    assert sorted((r[0], r[1]) for r in out) == [("S1", "2016-03-01"), ("S2", "2016-03-01")]


def test_colour_predict_job(spark, tmp):
    from kestrel.functions.colour import COLOUR_RGB
    rnd = random.Random(4)
    rows = []
    for word, (r, g, b) in COLOUR_RGB.items():
        for _ in range(30):
            c = [min(255, max(0, v + rnd.randint(-20, 20))) for v in (r, g, b)]
            rows.append(f"{c[0]},{c[1]},{c[2]},{word},high")
    _write(f"{tmp}/colours/c.csv", rows)
    scores = jobs.colour_predict(spark, f"{tmp}/colours")
    assert set(scores) == {"rgb", "lab"} and scores["lab"] > 0.5


def test_first_crossing_job(spark, tmp):
    rows = [(g, t, v) for g in range(3) for t, v in enumerate([0.5, 0.4, 0.3, 0.9])]
    spark.createDataFrame(rows, "g int, t int, v double").write.parquet(f"{tmp}/draws")
    mean = jobs.first_crossing(spark, f"{tmp}/draws", "g", "t", "v", "1", f"{tmp}/steps")
    assert mean == 3.0
    assert sorted(tuple(r) for r in spark.read.csv(f"{tmp}/steps").collect()) == [
        ("0", "3"), ("1", "3"), ("2", "3")]
