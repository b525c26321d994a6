"""File-to-file jobs with the same inputs and outputs as the reference's
command-line programs, built from the library's operators.

    python -m kestrel <job> <args...>

Each job reads its input format with an explicit schema, runs the operators,
and writes its output folder; nothing is collected to the driver except the
few numbers a job prints (a correlation, a score).
"""

from __future__ import annotations

import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions import logs, text
from kestrel.ml import pipelines
from kestrel.operators import aggregate, graph, joins, peaks, scan, stats, weather
from kestrel.operators import etl as etl_ops
from kestrel.sources import files, sinks

# Fixed schemas of the reference's inputs.
COMMENT_FIELDS = "subreddit string, score long, author string"
PAGE_VIEWS = "locale string, title string, views int, bytes long"
TMAX_SCHEMA = ("station string, date date, latitude float, longitude float, "
               "elevation float, tmax float")
COLOUR_SCHEMA = "R int, G int, B int, word string, confidence string"


def wordcount(spark: SparkSession, inputs: str, output: str) -> None:
    """Whitespace word count, ``'word count'`` lines sorted by word."""
    words = text.explode_words(files.read_lines(spark, inputs), "value")
    counts = aggregate.count_by_key(words, "word", "n").orderBy("word")
    sinks.write_lines(counts, output, fmt="%s %d")


def wordcount_improved(spark: SparkSession, inputs: str, output: str) -> None:
    """Lower-cased words split on punctuation and whitespace."""
    lines = files.read_lines(spark, inputs)
    words = text.explode_words(lines, "value", lower=True, punct=True)
    counts = aggregate.count_by_key(words, "word", "n").orderBy("word")
    sinks.write_lines(counts, output, fmt="%s %d")


def reddit_average(spark: SparkSession, inputs: str, output: str) -> None:
    """Average score per subreddit from JSON comments, as JSON lines.
    Malformed lines (read as all-NULL rows) and comments without a
    subreddit form no group; a missing score is ignored by the average."""
    comments = files.read_json(spark, inputs, COMMENT_FIELDS).filter(F.col("subreddit").isNotNull())
    avg = aggregate.avg_by_key(comments, "subreddit", "score", "average").orderBy("subreddit")
    sinks.write_json(avg, output)


def reddit_etl(spark: SparkSession, inputs: str, output: str) -> None:
    """Comments of subreddits containing 'e', split by score sign into
    ``output/side=positive`` and ``output/side=negative`` (JSON)."""
    comments = files.read_json(spark, inputs, COMMENT_FIELDS) \
        .filter(F.col("subreddit").contains("e"))
    sinks.split_write(comments, F.col("score") > 0, output)


def relative_score(spark: SparkSession, inputs: str, output: str,
                   broadcast: str = "auto") -> None:
    """``'%f author'`` lines: score over the subreddit's (positive) mean,
    highest first."""
    comments = files.read_json(spark, inputs, COMMENT_FIELDS)
    rel = joins.relative_to_group_mean(comments, "subreddit", "score", "author", broadcast)
    sinks.write_lines(rel, output, fmt="%f %s", columns=["relative_score", "author"])


def wikipedia_popular(spark: SparkSession, inputs: str, output: str) -> None:
    """Most-viewed English pages per hour (ties kept) from space-delimited
    page-view files whose names carry the hour; JSON output."""
    raw = files.with_source_file(files.read_csv(spark, inputs, PAGE_VIEWS, sep=" ", quote=""))
    hour = F.nullif(F.regexp_extract("file_path", r"(\d{8}-\d{2})[^/]*$", 1), F.lit(""))
    pages = etl_ops.page_views(raw.withColumn("hour", hour))
    top = peaks.rows_at_group_max_join(pages, "hour", "views", broadcast="checked")
    sinks.write_json(top.select("hour", "title", "views").orderBy("hour", "title"), output)


def wikipedia_popular_rows(spark: SparkSession, inputs: str, output: str) -> None:
    """Most-viewed English page per hour from white-space separated lines whose
    first field is the hour: ``hour``, a tab, ``(views, title)`` (of equal views
    the greatest title), sorted by hour.  Lines without five fields are left out."""
    pages = etl_ops.page_views(etl_ops.hourly_page_lines(files.read_lines(spark, inputs)))
    top = aggregate.argmax_by_key(pages, "hour", "views", "title").orderBy("hour")
    pair = F.format_string("(%s, '%s')", F.col("views").cast("string"), F.col("title"))
    sinks.write_lines(top.select("hour", pair.alias("top")), output)


def weather_etl(spark: SparkSession, inputs: str, output: str, prefix: str = "CA") -> None:
    """Clean TMAX readings of stations with a prefix, in degrees, gzip JSON."""
    obs = files.read_csv(spark, inputs, weather.WEATHER_SCHEMA)
    out = etl_ops.observations(obs, "qflag", "station", prefix, "observation", "TMAX",
                               "value", "date", 10.0, "tmax")
    sinks.write_json(out, output, compression="gzip")


def temp_range(spark: SparkSession, inputs: str, output: str) -> None:
    """Stations with the widest daily temperature range (ties kept), CSV."""
    obs = files.read_csv(spark, inputs, weather.WEATHER_SCHEMA)
    sinks.write_csv(weather.widest_range_per_day(obs), output)


def correlate_logs(spark: SparkSession, inputs: str) -> tuple[float, float]:
    """Correlation of requests and bytes per host over access-log files
    (plain or gzip); prints and returns r and r^2."""
    parsed = logs.parse_log_lines(files.read_lines(spark, inputs))
    per_host = aggregate.count_and_sum(parsed, "host", "bytes", "n", "total")
    row = stats.correlation(per_host, "n", "total").first()
    print(f"r = {row.r}\nr^2 = {row.r2}")
    return row.r, row.r2


def load_logs(spark: SparkSession, inputs: str, table: str, fmt: str = "parquet") -> None:
    """Parse access logs into a table partitioned by day, with unique and
    repeatable ids; the days of the input are replaced, so the same load
    again gives the same table."""
    parsed = logs.parse_log_lines(files.read_lines(spark, inputs))
    rows = logs.with_row_id(parsed.select("host", F.col("datetime").cast("string").alias("datetime"),
                                          "path", "bytes"))
    sinks.replace_partitions(rows.withColumn("day", F.substring("datetime", 1, 10)), table, ["day"], fmt)


def shortest_path(spark: SparkSession, inputs: str, output: str, source: str,
                  dest: str, rounds: str = "6") -> list[int]:
    """Hop search on an adjacency-list graph: per-round table partitioned by
    round (CSV) and the path as text, one node per line; returns the path."""
    edges = graph.parse_adjacency(files.read_lines(spark, inputs))
    found_by = graph.bfs_rounds(spark, edges, int(source), max_rounds=int(rounds), target=int(dest))
    graph.write_rounds(reduce(DataFrame.union, found_by), f"{output}/rounds")
    graph.write_path(found_by, int(dest), f"{output}/path")
    found = [r.node for r in graph.path_to(found_by, int(dest)).orderBy("step").collect()]
    if not found:
        print("The path was not found")
    return found


def first_crossing(spark: SparkSession, inputs: str, group: str, order: str, value: str,
                   limit: str = "1", output: str | None = None) -> float:
    """Mean number of ordered rows until each group's running sum reaches
    ``limit`` (parquet input); prints and returns the mean."""
    df = spark.read.parquet(inputs)
    crossings = scan.first_crossing(df, group, order.split(","), value, float(limit))
    if output:
        sinks.write_csv(crossings, output)
    mean = scan.mean_first_crossing(crossings).first().mean_steps
    print(mean)
    return mean


def colour_predict(spark: SparkSession, inputs: str) -> dict:
    """Validation f1 of the RGB and LAB colour classifiers; prints them."""
    data = files.read_csv(spark, inputs, COLOUR_SCHEMA)
    scores = {r.model: r.f1 for r in pipelines.colour_models(data).collect()}
    for name, f1 in scores.items():
        print(f"Validation score for {name.upper()} model: {f1:g}")
    return scores


def weather_train(spark: SparkSession, inputs: str, model_path: str) -> tuple[float, float]:
    """Fit the next-day TMAX forest on a daily TMAX CSV and save it; prints
    validation r^2 and RMSE."""
    daily = files.read_csv(spark, inputs, TMAX_SCHEMA)
    keys = ["station", "date"]
    train, valid = pipelines.split(pipelines.labelled(pipelines.tmax_features(daily), pipelines.FEATURES), keys)
    model = pipelines.fit_cached(pipelines.forest_pipeline(), pipelines.bounded(train, keys))
    model.write().overwrite().save(model_path)
    r2, rmse = pipelines.regression_scores(model.transform(valid))
    print(f"r2 = {r2}\nrmse = {rmse}")
    return r2, rmse


def weather_test(spark: SparkSession, model_path: str, inputs: str) -> tuple[float, float]:
    """Score a saved forest on a daily TMAX CSV; prints r^2, RMSE and the
    feature importances."""
    from pyspark.ml import PipelineModel
    model = PipelineModel.load(model_path)
    scored = model.transform(pipelines.tmax_features(files.read_csv(spark, inputs, TMAX_SCHEMA)))
    r2, rmse = pipelines.regression_scores(scored)
    print(f"r2 = {r2}\nrmse = {rmse}\nimportances = {pipelines.feature_importances(model)}")
    return r2, rmse


def weather_tomorrow(spark: SparkSession, model_path: str, inputs: str, output: str) -> None:
    """Predict the day after each station's last day with a saved forest (CSV)."""
    from pyspark.ml import PipelineModel
    model = PipelineModel.load(model_path)
    daily = files.read_csv(spark, inputs, TMAX_SCHEMA)
    pred = model.transform(pipelines.tomorrow_inputs(daily))
    sinks.write_csv(pred.select("station", "date", F.col("prediction").alias("tmax")), output)


def read_stream(spark: SparkSession, source: str, fmt: str = "text",
                seconds: str = "600", servers: str | None = None) -> None:
    """Running regression line of ``"x y"`` messages, printed each trigger."""
    from kestrel.streaming import regression
    msgs = regression.read_stream(spark, source, fmt=fmt, servers=servers)
    regression.run_to_console(regression.running_fit(regression.parse_points(msgs)),
                              float(seconds))


JOBS = {f.__name__: f for f in (
    wordcount, wordcount_improved, reddit_average, reddit_etl, relative_score,
    wikipedia_popular, wikipedia_popular_rows, weather_etl, temp_range, correlate_logs, load_logs, shortest_path,
    first_crossing, colour_predict, weather_train, weather_test, weather_tomorrow,
    read_stream)}


def main(argv: list[str] | None = None) -> None:
    argv = list(sys.argv[1:] if argv is None else argv)
    if not argv or argv[0] not in JOBS:
        print("usage: python -m kestrel <job> <args...>\njobs: " + ", ".join(sorted(JOBS)))
        raise SystemExit(2)
    spark = SparkSession.builder.appName(f"kestrel {argv[0]}").getOrCreate()
    JOBS[argv[0]](spark, *argv[1:])


if __name__ == "__main__":
    main()
