"""The query catalogue: each job bound to the driver tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame without
collecting it.  Computed columns carry the same names as in the oracle SQL
(:mod:`kestrel.plans.oracle`); doubles that come out of sums are rounded on
both sides so that summation order does not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions import colour, logs, text
from kestrel.functions.numeric import fixed
from kestrel.operators import aggregate, audit, etl, graph, joins, peaks, scan, stats
from kestrel.sources import tables
from kestrel.sources.tables import load

_hour, _day = tables.hour_text, tables.day_text


# --------------------------------------------------------------- text

def _documents(spark, d):
    return load(spark, d, "documents").select("text")


def wordcount_ws(spark: SparkSession, d: str) -> DataFrame:
    """Whitespace tokens per word, sorted by word (STR1 PRJ7 FLT7 AGG1 SRT1)."""
    words = text.explode_words(_documents(spark, d), "text")
    return aggregate.count_by_key(words, "word", "n").orderBy("word")


def wordcount_punct(spark: SparkSession, d: str) -> DataFrame:
    """Lower-cased words split on punctuation/whitespace (STR2 STR3 FLT7 AGG1)."""
    docs = _documents(spark, d)
    words = text.explode_words(docs, "text", lower=True, punct=True)
    return aggregate.count_by_key(words, "word", "n").orderBy("word")


def within_partition_sort(spark: SparkSession, d: str, reducers: int | None = None) -> DataFrame:
    """Word counts laid out as a MapReduce job writes them: hashed by word
    into reducer partitions (the session's shuffle partitions unless
    ``reducers`` is given), each sorted by word, no global order (SRT4)."""
    docs = _documents(spark, d)
    words = text.explode_words(docs, "text", lower=True, punct=True)
    counts = aggregate.count_by_key(words, "word", "n")
    laid = counts.repartition(reducers, "word") if reducers else counts.repartition("word")
    return laid.sortWithinPartitions("word")


def text_format(spark: SparkSession, d: str) -> DataFrame:
    """``'word count'`` text lines of the whitespace word count (STR7)."""
    counts = wordcount_ws(spark, d)
    return counts.select(text.format_line("%s %d", "word", "n").alias("line"))


# ------------------------------------------------------ averages

def avg_by_key(spark: SparkSession, d: str) -> DataFrame:
    """Average value per event type (AGG3)."""
    ev = load(spark, d, "events")
    return aggregate.avg_by_key(ev, "event_type", "value", "avg_value") \
        .select("event_type", fixed("avg_value", 6).alias("avg_value"))


def avg_by_key_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The same average from daily (count, sum) parts that are stored once and merged (AGG2 RE5).
    The last day is stored twice: the second time replaces it."""
    from kestrel.session import scratch_path
    from kestrel.sources import batches
    ev = load(spark, d, "events").withColumn("day", _day())
    table = scratch_path(spark, "daily_sums")
    batches.store_partial_sums(ev, table, "day", ["event_type"], "value")
    last = ev.agg(F.max("day")).first()[0]
    batches.store_partial_sums(ev.filter(F.col("day") == F.lit(last)), table, "day", ["event_type"], "value")
    merged = batches.stored_averages(spark, table, "event_type string, n bigint, total double, day string",
                                     ["event_type"], "avg_value")
    return merged.select("event_type", "n", fixed("total", 4).alias("total"),
                         fixed("avg_value", 6).alias("avg_value"))


def max_by_hour(spark: SparkSession, d: str) -> DataFrame:
    """Largest value per hour (AGG4)."""
    ev = load(spark, d, "events").withColumn("hour", _hour())
    return aggregate.max_by_key(ev, "hour", "value", "max_value")


def argmax_by_hour(spark: SparkSession, d: str) -> DataFrame:
    """The event with the largest value per hour; tie -> larger id (AGG5)."""
    ev = load(spark, d, "events").withColumn("hour", _hour())
    return aggregate.argmax_by_key(ev, "hour", "value", "event_id")


def _hour_type_counts(spark, d):
    ev = load(spark, d, "events").withColumn("hour", _hour())
    return aggregate.count_by_key(ev, ["hour", "event_type"], "n")


def peak_ties(spark: SparkSession, d: str) -> DataFrame:
    """Per hour, every event type at the hour's top count, ties kept; the
    per-hour maxima joined back with a size-checked broadcast (JN4 JN5)."""
    counts = _hour_type_counts(spark, d)
    return peaks.rows_at_group_max_join(counts, "hour", "n", broadcast="checked") \
        .select("hour", "event_type", "n").orderBy("hour", "event_type")


def peak_ties_window(spark: SparkSession, d: str) -> DataFrame:
    """Same rows by ``rank() == 1`` (JN4, window form)."""
    counts = _hour_type_counts(spark, d)
    return peaks.rows_at_group_max(counts, "hour", "n") \
        .select("hour", "event_type", "n").orderBy("hour", "event_type")


# ----------------------------------------------------------------- ETL

_SEGMENT_FIELDS = ["c_mktsegment", "c_acctbal", "c_name"]


def etl_positive(spark: SparkSession, d: str) -> DataFrame:
    """Customers in segments containing 'E' with a positive balance: the
    first side of the two-way split (FLT3 FLT5 PRJ1)."""
    return etl.segment_rows(load(spark, d, "customer"), "c_mktsegment", "E",
                            "c_acctbal", True, _SEGMENT_FIELDS)


def etl_nonpositive(spark: SparkSession, d: str) -> DataFrame:
    """The complementary side of the split: balance <= 0 or missing (FLT3 FLT5)."""
    return etl.segment_rows(load(spark, d, "customer"), "c_mktsegment", "E",
                            "c_acctbal", False, _SEGMENT_FIELDS)


def json_fields(spark: SparkSession, d: str) -> DataFrame:
    """Parse the JSON ``props`` field and serialise a record back (JSN1 JSN2)."""
    ev = load(spark, d, "events")
    k = etl.json_field("props", "k bigint").getField("k")
    rec = ev.select("event_id", k.alias("k"))
    return rec.select("event_id", "k",
                      etl.to_json_line(F.col("event_id"), F.col("k")).alias("json"))


def variant_fields(spark: SparkSession, d: str) -> DataFrame:
    """Semi-structured paths: a present key and a missing one (JSN3)."""
    ev = load(spark, d, "events")
    return ev.select("event_id",
                     etl.variant_path("props", "$.k", "bigint").alias("k"),
                     etl.variant_path("props", "$.missing", "string").alias("missing"))


def _scored_customers(spark, d):
    return load(spark, d, "customer").select(
        "c_name", "c_nationkey", (F.col("c_acctbal") - 4500).alias("score"))


def relative_score(spark: SparkSession, d: str) -> DataFrame:
    """Score over the group's mean, for groups with a positive mean; equi-join
    back with hot groups salted, no broadcast hint (AGG3 FLT5 JN1 MTH1 SRT2)."""
    rel = joins.relative_to_group_mean(_scored_customers(spark, d), "c_nationkey",
                                       "score", "c_name", broadcast="auto")
    return rel.select(fixed("relative_score", 6).alias("relative_score"),
                      "c_name", "c_nationkey")


def relative_score_broadcast(spark: SparkSession, d: str) -> DataFrame:
    """Same, with the group means broadcast after a size check (JN2)."""
    rel = joins.relative_to_group_mean(_scored_customers(spark, d), "c_nationkey",
                                       "score", "c_name", broadcast="checked")
    return rel.select(fixed("relative_score", 6).alias("relative_score"),
                      "c_name", "c_nationkey")


def observation_etl(spark: SparkSession, d: str) -> DataFrame:
    """Clean purchase readings from stations 'U1*', scaled by 1/10
    (FLT1 FLT2 FLT4 PRJ1 PRJ2).  Station = 'U' || user_id; flagged readings go."""
    ev = load(spark, d, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("station"),
        _day().alias("date"), "event_type", "value", tables.reading_flag().alias("qflag"))
    return etl.observations(ev, "qflag", "station", "U1", "event_type", "purchase",
                            "value", "date", 10.0, "tmax") \
        .select("station", "date", fixed("tmax", 4).alias("tmax"))


# ----------------------------------------------------- temperature range

def _daily_range(spark, d):
    """Per (day, user): largest purchase minus smallest click, one scan and
    one shuffle (conditional aggregates instead of a self-join)."""
    ev = load(spark, d, "events")
    daily = ev.groupBy(_day().alias("day"), "user_id").agg(
        F.max(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("hi"),
        F.min(F.when(F.col("event_type") == "click", F.col("value"))).alias("lo"))
    return daily.filter(F.col("hi").isNotNull() & F.col("lo").isNotNull()) \
        .select("day", "user_id", (F.col("hi") - F.col("lo")).alias("value_range"))


def daily_range_peak(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: per day, the users with the widest purchase-click range,
    ties kept, sorted by day and user (JN4 PRJ2 SRT3)."""
    top = peaks.rows_at_group_max(_daily_range(spark, d), "day", "value_range")
    return top.select("day", "user_id", fixed("value_range", 4).alias("value_range")) \
        .orderBy("day", "user_id")


def daily_range_peak_sql(spark: SparkSession, d: str) -> DataFrame:
    """Same answer through chained SQL temp views (CAT1 CAT2 JN3)."""
    v = "kestrel_events"
    load(spark, d, "events").createOrReplaceTempView(v)
    spark.sql(f"""CREATE OR REPLACE TEMP VIEW kestrel_hi AS
        SELECT substring(CAST(ts AS STRING), 1, 10) AS day, user_id, max(value) AS hi
        FROM {v} WHERE event_type = 'purchase' GROUP BY 1, 2""")
    spark.sql(f"""CREATE OR REPLACE TEMP VIEW kestrel_lo AS
        SELECT substring(CAST(ts AS STRING), 1, 10) AS day, user_id, min(value) AS lo
        FROM {v} WHERE event_type = 'click' GROUP BY 1, 2""")
    spark.sql("""CREATE OR REPLACE TEMP VIEW kestrel_range AS
        SELECT h.day, h.user_id, h.hi - l.lo AS value_range
        FROM kestrel_hi h JOIN kestrel_lo l ON h.day = l.day AND h.user_id = l.user_id""")
    spark.sql("""CREATE OR REPLACE TEMP VIEW kestrel_range_max AS
        SELECT day AS max_day, max(value_range) AS max_range FROM kestrel_range GROUP BY day""")
    return spark.sql("""
        SELECT r.day, r.user_id, floor(r.value_range * 1e4 + 0.5) / 1e4 AS value_range
        FROM kestrel_range r JOIN kestrel_range_max m
          ON r.day = m.max_day AND r.value_range = m.max_range
        ORDER BY r.day, r.user_id""")


def rows_by_source_file(spark: SparkSession, d: str) -> DataFrame:
    """Rows of two tables per table and their number of source files, from the
    files' full paths; a table may be a file or a folder (SRC6)."""
    from kestrel.sources.files import with_source_file
    parts = [with_source_file(load(spark, d, name).select(F.lit(f"{name}.parquet").alias("table")))
             for name in ("events", "orders")]
    return parts[0].unionByName(parts[1]).groupBy("table").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.contains("file_path", "table").cast("int")).alias("path_names_table"))


# ------------------------------------------------------------ logs

def _parsed_logs(spark, d):
    return logs.parse_log_lines(tables.access_log_lines(load(spark, d, "events")))


def log_parse(spark: SparkSession, d: str) -> DataFrame:
    """Parse access-log lines; malformed ones dropped (STR6 DAT3 FLT8)."""
    p = _parsed_logs(spark, d)
    return p.select("host", F.col("datetime").cast("string").alias("datetime"), "path", "bytes")


def log_dropped(spark: SparkSession, d: str) -> DataFrame:
    """Access-log lines read, and those the parser rejects (FLT8)."""
    return logs.dropped_lines(tables.access_log_lines(load(spark, d, "events")))


def host_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Per host request count and bytes, then Pearson r and r^2 between
    them (AGG6 AGG7 AGG8)."""
    per_host = aggregate.count_and_sum(_parsed_logs(spark, d), "host", "bytes",
                                       "n_requests", "sum_bytes")
    c = stats.correlation(per_host, "n_requests", "sum_bytes")
    return c.select(F.col("n").alias("n_hosts"), fixed("r", 6).alias("r"),
                    fixed("r2", 6).alias("r2"))


def moments_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Same r from the six raw sums in one aggregate (AGG7 MTH2 MTH3)."""
    per_host = aggregate.count_and_sum(_parsed_logs(spark, d), "host", "bytes",
                                       "n_requests", "sum_bytes")
    r = stats.correlation_from_moments(stats.moments(per_host, "n_requests", "sum_bytes"))
    return r.select(F.col("n").alias("n_hosts"), fixed("r", 6).alias("r"))


def linear_fit(spark: SparkSession, d: str) -> DataFrame:
    """Least-squares line of value on props.k (AGG9)."""
    ev = load(spark, d, "events").select(
        F.get_json_object("props", "$.k").try_cast("double").alias("x"), F.col("value").alias("y"))
    fit = stats.linear_fit(ev, "x", "y")
    return fit.select("n", fixed("slope", 9).alias("slope"),
                      fixed("intercept", 9).alias("intercept"))


def stream_linear_fit(spark: SparkSession, d: str) -> DataFrame:
    """The same line computed by a Structured Streaming query over a file
    stream of ``"x y"`` messages, complete mode into a memory table, run
    until the available input is done (SRC10 STM1-STM5)."""
    from kestrel.streaming import regression
    # The table's own path: a file, or a folder of part files.
    stream = regression.read_stream(spark, f"{d}/events.parquet", fmt="parquet",
                                    schema=load(spark, d, "events").schema)
    points = regression.parse_points(tables.point_messages(stream))
    table = regression.run_to_table(spark, regression.running_fit(points))
    return table.select("n", fixed("slope", 9).alias("slope"),
                        fixed("intercept", 9).alias("intercept"))


# ---------------------------------------------------------- dates

def _daily_max(spark, d):
    ev = load(spark, d, "events")
    return ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.max("value").alias("tmax"))


def yesterday_join(spark: SparkSession, d: str) -> DataFrame:
    """Daily max per user with the previous day's max; gaps do not match
    (JN6 DAT2)."""
    j = joins.previous_day_join(_daily_max(spark, d), "user_id", "day", "tmax")
    return j.select("user_id", F.col("day").cast("string").alias("day"), "tmax",
                    "yesterday_tmax")


def day_of_year(spark: SparkSession, d: str) -> DataFrame:
    """Day of the year of each order date (DAT1)."""
    return load(spark, d, "orders").select(
        "o_orderkey", F.dayofyear("o_orderdate").alias("day_of_year"))


def top1_row_number(spark: SparkSession, d: str) -> DataFrame:
    """Each user's first event by time, id breaking ties (WIN1)."""
    ev = load(spark, d, "events").select("user_id", "event_id", "ts", "value")
    return peaks.first_per_group(ev, "user_id", ["ts", "event_id"]) \
        .select("user_id", "event_id", "value")


def union_bag(spark: SparkSession, d: str) -> DataFrame:
    """Customer and supplier names as one bag with a kind tag (SET1 PRJ3 PRJ5)."""
    c = load(spark, d, "customer").select(F.col("c_name").alias("name"),
                                          F.col("c_nationkey").alias("nationkey"))
    s = load(spark, d, "supplier").select(F.col("s_name").alias("name"),
                                          F.col("s_nationkey").alias("nationkey"))
    return etl.tag(c, "kind", "customer").unionByName(etl.tag(s, "kind", "supplier"))


# ----------------------------------------------------------- graph

BFS_SOURCE = 1


def _edges(spark, d):
    return tables.order_edges(load(spark, d, "orders"), load(spark, d, "customer"))


def bfs_distance(spark: SparkSession, d: str) -> DataFrame:
    """Hop distance and smallest parent from node 1, until no new node is found
    (GRF3 JN7 SET1 AGG11)."""
    return graph.bfs(spark, _edges(spark, d), BFS_SOURCE)


def bfs_six_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Nodes per round of a search of at most 6 rounds, written as one table
    partitioned by round and read back (GRF2 GRF4)."""
    from kestrel.session import scratch_path
    path = scratch_path(spark, "rounds")
    graph.write_rounds(graph.bfs(spark, _edges(spark, d), BFS_SOURCE, max_rounds=6), path)
    back = spark.read.schema(graph.TREE_SCHEMA).csv(path)
    return back.groupBy("distance").agg(F.count(F.lit(1)).alias("n_nodes"), F.min("node").alias("first_node"))


def bfs_path(spark: SparkSession, d: str) -> DataFrame:
    """Shortest path (via smallest parents) to every reached node (GRF5)."""
    p = graph.with_paths(graph.bfs_rounds(spark, _edges(spark, d), BFS_SOURCE))
    return p.select("node", "distance", F.array_join("path", ",").alias("path"))


def bfs_one_path(spark: SparkSession, d: str) -> DataFrame:
    """The path from node 1 to the largest node that the search reaches, found by
    walking back from it (FLT9 GRF5)."""
    rounds = graph.bfs_rounds(spark, _edges(spark, d), BFS_SOURCE)
    far = reduce(DataFrame.union, rounds).agg(F.max("node")).first()[0]
    return graph.path_to(rounds, far)


def adjacency_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges written as ``src: d1 d2 ...`` lines, read as text and parsed back
    (GRF1 SRC1)."""
    from kestrel.session import scratch_path
    from kestrel.sources import files, sinks
    path = scratch_path(spark, "adjacency")
    lines = _edges(spark, d).groupBy("src").agg(
        F.array_join(F.array_sort(F.collect_set(F.col("dest"))).cast("array<string>"), " ").alias("out"))
    sinks.write_lines(lines.select(F.concat("src", F.lit(": "), "out").alias("line")), path)
    return graph.parse_adjacency(files.read_lines(spark, path))


# ------------------------------------------------------ colours

def rgb_to_lab(spark: SparkSession, d: str) -> DataFrame:
    """CIELAB of part colours (ML12 FLT10 MTH2)."""
    lab = colour.with_lab(tables.part_colours(load(spark, d, "part")))
    return lab.select("p_partkey", "R", "G", "B", *[fixed(c, 4).alias(c)
                                                    for c in ("labL", "labA", "labB")])


def rgb_to_hsv(spark: SparkSession, d: str) -> DataFrame:
    """HSV of part colours (ML13 MTH4)."""
    hsv = colour.with_hsv(tables.part_colours(load(spark, d, "part")))
    return hsv.select("p_partkey", "R", "G", "B", "H", "S", "V")


# ------------------------------------------------- first crossing

CROSSING_LIMIT = 500.0


def first_crossing_by_user(spark: SparkSession, d: str) -> DataFrame:
    """Per user, events (by time, id) until the running value sum reaches
    500; skew-safe two-level scan (RE2)."""
    ev = load(spark, d, "events")
    return scan.first_crossing(ev, "user_id", ["ts", "event_id"], "value", CROSSING_LIMIT)


def first_crossing(spark: SparkSession, d: str) -> DataFrame:
    """Mean steps to the crossing over all users that reach it (RE2 AGG10)."""
    m = scan.mean_first_crossing(first_crossing_by_user(spark, d))
    return m.select("n_groups", fixed("mean_steps", 6).alias("mean_steps"))


# ------------------------------------------------- star schema

def star_spend(spark: SparkSession, d: str) -> DataFrame:
    """Orders and exact decimal spend per nation and region over the star
    schema orders -> customer -> nation -> region (AGG6 JN1).

    Orders are reduced to one row per customer *before* the join, so the
    join moves one row per customer instead of one per order; nation and
    region are fixed-size dimensions.
    """
    orders = load(spark, d, "orders").select(
        "o_custkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    per_cust = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"),
                                                F.sum("price").alias("spend"))
    cust = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    per_nation = per_cust.join(cust, per_cust["o_custkey"] == cust["c_custkey"]) \
        .groupBy("c_nationkey").agg(F.sum("n").alias("n_orders"), F.sum("spend").alias("spend"))
    nation = load(spark, d, "nation")
    region = load(spark, d, "region")
    out = per_nation.join(nation, per_nation["c_nationkey"] == nation["n_nationkey"]) \
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
    return out.select("r_name", "n_name", "n_orders",
                      F.col("spend").cast("decimal(38,2)").alias("spend"))


PRUNE_MONTH = "1996-03"


def partition_pruned(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as a folder partitioned by month, then one month read
    back: the scan lists only that partition (partition layout and pruning)."""
    from kestrel.sources import catalog
    path = catalog.write_partitioned(
        load(spark, d, "orders").withColumn("o_month", F.substring(F.col("o_orderdate").cast("string"), 1, 7)),
        "orders_by_month", ["o_month"])
    month = spark.read.parquet(path).filter(F.col("o_month") == PRUNE_MONTH)
    return month.groupBy("o_month").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("decimal(38,2)").alias("spend"))


def key_audit(spark: SparkSession, d: str) -> DataFrame:
    """Duplicate values of lineitem's declared key (l_orderkey, l_linenumber) (CAT9)."""
    return audit.duplicate_keys(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


FOREIGN_KEYS = [
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("labels", "doc_id", "documents", "doc_id"),
]


def fk_audit(spark: SparkSession, d: str) -> DataFrame:
    """Rows checked and orphans per declared foreign key (CAT9)."""
    out = None
    for child, fk, parent, pk in FOREIGN_KEYS:
        s = audit.orphan_summary(load(spark, d, child), child, fk,
                                 load(spark, d, parent), parent, pk)
        out = s if out is None else out.unionByName(s)
    return out


def null_audit(spark: SparkSession, d: str) -> DataFrame:
    """NULL count of every orders column (CAT10)."""
    return audit.null_counts(load(spark, d, "orders"))


QUERIES = {
    "wordcount_ws": wordcount_ws,
    "wordcount_punct": wordcount_punct,
    "within_partition_sort": within_partition_sort,
    "text_format": text_format,
    "avg_by_key": avg_by_key,
    "avg_by_key_pairs": avg_by_key_pairs,
    "max_by_hour": max_by_hour,
    "argmax_by_hour": argmax_by_hour,
    "peak_ties": peak_ties,
    "peak_ties_window": peak_ties_window,
    "etl_positive": etl_positive,
    "etl_nonpositive": etl_nonpositive,
    "json_fields": json_fields,
    "variant_fields": variant_fields,
    "relative_score": relative_score,
    "relative_score_broadcast": relative_score_broadcast,
    "observation_etl": observation_etl,
    "daily_range_peak": daily_range_peak,
    "daily_range_peak_sql": daily_range_peak_sql,
    "rows_by_source_file": rows_by_source_file,
    "log_parse": log_parse,
    "log_dropped": log_dropped,
    "host_correlation": host_correlation,
    "moments_correlation": moments_correlation,
    "linear_fit": linear_fit,
    "stream_linear_fit": stream_linear_fit,
    "yesterday_join": yesterday_join,
    "day_of_year": day_of_year,
    "top1_row_number": top1_row_number,
    "union_bag": union_bag,
    "bfs_distance": bfs_distance,
    "bfs_six_rounds": bfs_six_rounds,
    "bfs_path": bfs_path,
    "bfs_one_path": bfs_one_path,
    "adjacency_edges": adjacency_edges,
    "rgb_to_lab": rgb_to_lab,
    "rgb_to_hsv": rgb_to_hsv,
    "first_crossing_by_user": first_crossing_by_user,
    "first_crossing": first_crossing,
    "star_spend": star_spend,
    "partition_pruned": partition_pruned,
    "key_audit": key_audit,
    "fk_audit": fk_audit,
    "null_audit": null_audit,
}


# ------------------------------------------------------------- ML
# Model scores vary with partitioning even when seeded, so these have no
# SQL oracle; the driver checks their rows and schema.

def _labelled_colours(spark, d):
    c = tables.part_colours(load(spark, d, "part"))
    return c.withColumn("word", colour.nearest_colour_word())


def ml_colour_scores(spark: SparkSession, d: str) -> DataFrame:
    """RGB -> word and RGB -> LAB (SQL stage) -> word MLP classifiers,
    validation f1 of each (ML1-ML3 ML5 ML7 ML8 ML12 UDF4)."""
    from kestrel.ml import pipelines
    return pipelines.colour_models(_labelled_colours(spark, d))


def ml_label_scores(spark: SparkSession, d: str) -> DataFrame:
    """MLP on the embedding vectors predicting their label; split sizes and f1."""
    from kestrel.ml import pipelines
    return pipelines.vector_label_scores(load(spark, d, "embeddings"), "vec_id", "embedding", "label")


def split_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Rows per label on either side of the embedding split (ML1)."""
    from kestrel.ml import pipelines
    train, valid = pipelines.split(load(spark, d, "embeddings").select("vec_id", "label"), ["vec_id"])
    both = etl.tag(train, "side", "train").unionByName(etl.tag(valid, "side", "valid"))
    return aggregate.count_by_key(both, ["side", "label"], "n")


def tmax_features(spark: SparkSession, d: str) -> DataFrame:
    """Day of year and yesterday's value of each station's days: the forest's
    features (JN6 DAT1 DAT2 UDF4)."""
    from kestrel.ml import pipelines
    f = pipelines.tmax_features(_daily_series(spark, d))
    return f.select("station", F.col("date").cast("string").alias("date"), "day_of_year", "tmax", "yesterday_tmax")


def next_day_inputs(spark: SparkSession, d: str) -> DataFrame:
    """The row that each station's next day is predicted from (RE3)."""
    from kestrel.ml import pipelines
    f = pipelines.tomorrow_inputs(_daily_series(spark, d))
    return f.select("station", F.col("date").cast("string").alias("date"), "day_of_year", "yesterday_tmax")


def _daily_series(spark, d):
    """Daily max value per user as a station series; per-user constants
    stand in for latitude, longitude and elevation."""
    ev = load(spark, d, "events")
    uid = F.col("user_id")
    return ev.groupBy(uid.cast("string").alias("station"), F.to_date("ts").alias("date")) \
        .agg(F.max("value").alias("tmax"),
             F.first(((uid % 180) - 90).cast("float")).alias("latitude"),
             F.first((((uid * 7) % 360) - 180).cast("float")).alias("longitude"),
             F.first(((uid * 13) % 1000).cast("float")).alias("elevation"))


def _fit_tmax(spark, d):
    from kestrel.ml import pipelines
    from kestrel.session import scratch_path
    daily, keys = _daily_series(spark, d), ["station", "date"]
    data = pipelines.labelled(pipelines.tmax_features(daily), [*pipelines.FEATURES, "tmax"])
    train, valid = pipelines.split(data, keys)
    model = pipelines.fit_cached(pipelines.forest_pipeline(), pipelines.bounded(train, keys))
    return daily, train, valid, pipelines.save_and_load(model, scratch_path(spark, "tmax_model"))


def ml_next_day(spark: SparkSession, d: str) -> DataFrame:
    """Random-forest model of tomorrow's max from yesterday's; saved, loaded,
    then used to predict the day after the last one for every user
    (ML6 ML7 ML10 RE3 JN6)."""
    daily, _, _, model = _fit_tmax(spark, d)
    from kestrel.ml import pipelines
    pred = model.transform(pipelines.tomorrow_inputs(daily))
    return pred.select("station", F.col("date").cast("string").alias("date"),
                       "yesterday_tmax", F.col("prediction").alias("predicted_tmax"))


def ml_next_day_scores(spark: SparkSession, d: str) -> DataFrame:
    """Validation R^2 and RMSE, and the most important feature (ML9 ML11)."""
    from kestrel.ml import pipelines
    _, train, valid, model = _fit_tmax(spark, d)
    r2, rmse = pipelines.regression_scores(model.transform(valid))
    imp = pipelines.feature_importances(model)
    top = max(imp, key=imp.get)
    from kestrel.sources.files import rows
    return rows(spark, [(r2, rmse, top, imp[top])],
                                 "r2 double, rmse double, top_feature string, importance double")


def ml_grid(spark: SparkSession, d: str) -> DataFrame:
    """A 256 x 256 LAB slice at L=70 scored by the RGB colour model trained
    on the part colours, with the predicted word attached (RE4 ML4)."""
    from kestrel.ml import pipelines
    columns = ["R", "G", "B", "word"]
    with pipelines.stored(_labelled_colours(spark, d).select(*columns)) as colours:
        model = pipelines.fit_dealt(
            pipelines.mlp_pipeline(["R", "G", "B"], "word", len(colour.COLOUR_WORDS)),
            pipelines.bounded(pipelines.labelled(colours, columns), columns))
    return pipelines.grid_predictions(model, colour.lab_grid(spark, 70.0, 256))


def label_index(spark: SparkSession, d: str) -> DataFrame:
    """Index of the part types by falling frequency, then text (ML3)."""
    from kestrel.ml import scoring
    return scoring.label_index(load(spark, d, "part"), "p_type")


def _centroid_confusion(spark, d):
    from kestrel.ml import pipelines, scoring
    train, valid = pipelines.split(load(spark, d, "embeddings"), ["vec_id"])
    network = scoring.centroid_network(train, "embedding", "label").persist()
    try:
        scored = scoring.with_outputs(valid.dropna(subset=["embedding", "label"]), "embedding", network)
        labels = F.array(*[F.lit(r["label"]) for r in network.orderBy("unit").select("label").collect()])
    finally:
        network.unpersist()
    scored = scored.withColumn("predicted", F.get(labels, scoring.best_unit("outputs").cast("int")))
    return scoring.confusion(scored, "label", "predicted")


def network_confusion(spark: SparkSession, d: str) -> DataFrame:
    """Label and predicted label of the held-out embeddings, scored by a network whose
    weights are a table (ML5 ML7 ML8)."""
    return _centroid_confusion(spark, d)


def network_f1(spark: SparkSession, d: str) -> DataFrame:
    """Weighted F1 from the confusion counts, to nine digits (ML8)."""
    from kestrel.ml import scoring
    return scoring.weighted_f1(_centroid_confusion(spark, d)).select(F.round("f1", 9).alias("f1"), "n")


QUERIES.update({
    "label_index": label_index,
    "network_confusion": network_confusion,
    "network_f1": network_f1,
    "split_sizes": split_sizes,
    "tmax_features": tmax_features,
    "next_day_inputs": next_day_inputs,
    "ml_colour_scores": ml_colour_scores,
    "ml_label_scores": ml_label_scores,
    "ml_next_day": ml_next_day,
    "ml_next_day_scores": ml_next_day_scores,
    "ml_grid": ml_grid,
})


# ---------------------------------------------- sources and sinks round trips

def temp_range_csv(spark: SparkSession, d: str) -> DataFrame:
    """Weather readings written as header-less CSV, read back with an
    explicit schema, then the widest daily range per day (SNK2 SRC3 FLT4
    JN4 SRT3)."""
    from kestrel.operators import weather
    from kestrel.session import scratch_path
    from kestrel.sources import files, sinks
    path = scratch_path(spark, "weather_csv")
    sinks.write_csv(tables.weather_observations(load(spark, d, "events")), path)
    obs = files.read_csv(spark, path, weather.WEATHER_SCHEMA)
    return weather.widest_range_per_day(obs).select("date", "station", fixed("range", 4).alias("range"))


def json_source_average(spark: SparkSession, d: str) -> DataFrame:
    """Customers written as gzip JSON lines and read back with a fixed
    schema that names a key the files lack (NULL); average balance per
    segment (SNK3 SRC5 AGG3)."""
    from kestrel.session import scratch_path
    from kestrel.sources import files, sinks
    path = scratch_path(spark, "customer_json")
    sinks.write_json(load(spark, d, "customer").select(
        F.col("c_mktsegment").alias("subreddit"), F.col("c_acctbal").alias("score"),
        F.col("c_name").alias("author")), path, compression="gzip")
    rows = files.read_json(spark, path, "subreddit string, score double, author string, "
                                        "gilded long")
    return rows.groupBy("subreddit").agg(
        fixed(F.avg("score"), 6).alias("avg_score"), F.count("gilded").alias("n_gilded"))


def text_source_wordcount(spark: SparkSession, d: str) -> DataFrame:
    """Document text written as plain text files, read back as lines, then
    the whitespace word count (SNK1 SRC1 STR1 AGG1)."""
    from kestrel.session import scratch_path
    from kestrel.sources import files, sinks
    path = scratch_path(spark, "documents_txt")
    sinks.write_lines(load(spark, d, "documents").select("text"), path)
    words = text.explode_words(files.read_lines(spark, path), "value")
    return aggregate.count_by_key(words, "word", "n")


def _ingest_logs(spark, d):
    """RE1: access-log text as gzip files -> parsed rows with unique, repeatable
    ids -> the days' partitions of a table; returns the table path."""
    from kestrel.session import scratch_path
    from kestrel.sources import files, sinks
    raw = scratch_path(spark, "logs_gz")
    sinks.write_lines(tables.access_log_lines(load(spark, d, "events")), raw,
                      compression="gzip")
    parsed = logs.parse_log_lines(files.read_lines(spark, raw))
    rows = logs.with_row_id(parsed.select("host", F.col("datetime").cast("string").alias("datetime"),
                                          "path", "bytes"))
    table = scratch_path(spark, "logs_by_day")
    sinks.replace_partitions(rows.withColumn("day", F.substring("datetime", 1, 10)), table, ["day"])
    return table


def log_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the ingested log table (RE1: SRC2 STR6 DAT3 UID1 SNK5 SRC9)."""
    from kestrel.sources import files
    table = files.read_table(spark, _ingest_logs(spark, d))
    return table.select("id", "host", "datetime", "path", "bytes")


def host_correlation_from_table(spark: SparkSession, d: str) -> DataFrame:
    """Request count vs bytes correlation read from the ingested log table
    (SRC9 AGG6 AGG7 AGG8)."""
    from kestrel.sources import files
    table = files.read_table(spark, _ingest_logs(spark, d))
    per_host = aggregate.count_and_sum(table, "host", "bytes", "n_requests", "sum_bytes")
    c = stats.correlation(per_host, "n_requests", "sum_bytes")
    return c.select(F.col("n").alias("n_hosts"), fixed("r", 6).alias("r"),
                    fixed("r2", 6).alias("r2"))


QUERIES.update({
    "temp_range_csv": temp_range_csv,
    "json_source_average": json_source_average,
    "text_source_wordcount": text_source_wordcount,
    "log_ingest": log_ingest,
    "host_correlation_from_table": host_correlation_from_table,
})


# ------------------------------------------------------- catalog, page views

def _schema(spark, name: str) -> str:
    """A fresh namespace of this driver's."""
    import uuid

    from kestrel.session import scratch_path
    from kestrel.sources import catalog
    name = f"{name}_{uuid.uuid4().hex[:8]}"
    catalog.create_schema(spark, name, scratch_path(spark, name))
    return name


def _kept(spark, df, name: str):
    """``df`` written to the scratch folder: its tables may be dropped then."""
    from kestrel.session import scratch_path
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def typed_load(spark: SparkSession, d: str) -> DataFrame:
    """Customers as JSON lines and orders as CSV, bulk loaded into typed tables
    with NOT NULL checks; rows that don't fit are diverted.  Purchases per
    province code, and the rows of either side diverted (CAT3 CAT8 SRC11 SRC12)."""
    from kestrel.session import scratch_path
    from kestrel.sources import catalog, sinks
    paths = {n: scratch_path(spark, n) for n in ("customers_json", "orders_csv", "bad_json", "bad_csv")}
    cust = load(spark, d, "customer")
    sinks.write_json(cust.select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("custid"), F.col("c_name").alias("name"),
        # every 50th customer has no province, which the table does not allow
        F.when(F.col("c_custkey") % 50 != 0, F.concat(F.lit("P"), F.col("c_nationkey") % 10)).alias("province")),
        paths["customers_json"])
    sinks.write_csv(load(spark, d, "orders").select(
        F.concat(F.lit("O"), F.col("o_orderkey")), F.concat(F.lit("C"), F.col("o_custkey")),
        # every 40th date is text that is no date
        F.when(F.col("o_orderkey") % 40 != 0, F.col("o_orderdate").cast("date").cast("string")).otherwise("soon"),
        F.col("o_totalprice").cast("decimal(12,2)")), paths["orders_csv"])
    db = _schema(spark, "typed")
    catalog.create_table(spark, f"{db}.customers", "custid VARCHAR(12), custname STRING, province CHAR(2)")
    catalog.create_table(spark, f"{db}.purchases", "purchid VARCHAR(12), custid VARCHAR(12), pdate DATE, amount DECIMAL(12,2)")
    catalog.load_json_into(spark, paths["customers_json"], f"{db}.customers", {"name": "custname"},
                           ["custid", "province"], paths["bad_json"])
    catalog.load_csv_into(spark, paths["orders_csv"], f"{db}.purchases", ["purchid", "custid", "pdate"], paths["bad_csv"])
    result = spark.sql(f"""
        SELECT c.province, count(*) AS n_purchases, CAST(sum(p.amount) AS DECIMAL(38,2)) AS spend
        FROM {db}.purchases p JOIN {db}.customers c ON p.custid = c.custid GROUP BY c.province""")
    bad = [spark.read.text(paths[n]).agg(F.lit(n).alias("province"), F.count("*").alias("n_purchases"),
                                         F.lit(None).cast("decimal(38,2)").alias("spend")) for n in ("bad_json", "bad_csv")]
    kept = _kept(spark, result.unionByName(bad[0]).unionByName(bad[1]), "typed")
    catalog.drop_schema(spark, db)
    return kept


def external_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Orders as CSV files in a folder per month, an external partitioned table
    over them, one month's partition added by name and the rest discovered;
    rows and spend per month after either step.  The files outlive the
    dropped schema (CAT4 CAT5 CAT7 CAT8)."""
    from kestrel.sources import catalog
    rows = load(spark, d, "orders").select(
        F.col("o_orderkey").alias("purchid"), F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 7).alias("month"))
    path = catalog.write_partitioned(rows, "external", ["month"], "csv")
    db = _schema(spark, "external")
    catalog.create_table(spark, f"{db}.purchases", "purchid BIGINT, amount DECIMAL(12,2), month STRING", "csv",
                         path, ["month"])
    per_month = f"""SELECT month, count(*) AS n, CAST(sum(amount) AS DECIMAL(38,2)) AS spend
                    FROM {db}.purchases GROUP BY month"""
    catalog.add_partitions(spark, f"{db}.purchases", "month", [PRUNE_MONTH], path)
    one = _kept(spark, etl.tag(spark.sql(per_month), "step", "added"), "one_month")
    catalog.discover_partitions(spark, f"{db}.purchases")
    rest = _kept(spark, etl.tag(spark.sql(per_month), "step", "discovered"), "all_months")
    catalog.drop_schema(spark, db)
    return one.unionByName(rest)


def struct_vs_variant(spark: SparkSession, d: str) -> DataFrame:
    """Events' properties as JSON lines, read through an external table with a
    declared struct, and loaded as VARIANT into a typed table: a declared
    field, the same by path, and a path that is not there (CAT6 SRC13 JSN3)."""
    from kestrel.session import scratch_path
    from kestrel.sources import catalog, sinks
    path = scratch_path(spark, "events_json")
    sinks.write_json(load(spark, d, "events").select(
        "event_id", F.struct(F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
                             F.col("event_type").alias("kind")).alias("tags")), path)
    db = _schema(spark, "semi")
    catalog.create_table(spark, f"{db}.declared", "event_id BIGINT, tags STRUCT<k: BIGINT, kind: STRING>", "json", path)
    catalog.create_table(spark, f"{db}.loaded", "event_id BIGINT, tags VARIANT")
    catalog.load_json_into(spark, path, f"{db}.loaded", tolerant=True)
    kept = _kept(spark, spark.sql(f"""
        SELECT a.event_id, a.tags.k AS declared_k, try_variant_get(b.tags, '$.k', 'bigint') AS variant_k,
               try_variant_get(b.tags, '$.kind', 'string') AS kind, try_variant_get(b.tags, '$.none', 'string') AS none
        FROM {db}.declared a JOIN {db}.loaded b ON a.event_id = b.event_id"""), "semi")
    catalog.drop_schema(spark, db)
    return kept


def page_peak(spark: SparkSession, d: str) -> DataFrame:
    """Space-delimited page views in files whose path names the hour: the most
    viewed English pages per hour, ties kept, without the main page and
    special pages (SRC4 SRC6 STR5 FLT1 FLT2 FLT6 JN4)."""
    from kestrel.session import scratch_path
    from kestrel.sources import files, sinks
    path = scratch_path(spark, "pagecounts")
    views = tables.page_view_lines(load(spark, d, "events"))
    line = F.concat_ws(" ", "locale", "title", F.col("views").cast("string"), F.col("bytes").cast("string"))
    views.select("hour", line.alias("value")).hint("rebalance", "hour").write.partitionBy("hour").text(path)
    raw = files.read_csv(spark, f"{path}/*", "locale string, title string, views bigint, bytes bigint", sep=" ", quote="")
    stamp = F.nullif(F.regexp_extract("file_path", r"(\d{8}-\d{2})/[^/]*$", 1), F.lit(""))
    pages = etl.page_views(files.with_source_file(raw).withColumn("stamp", stamp))
    return peaks.rows_at_group_max(pages, "stamp", "views").select("stamp", "title", "views")


def page_peak_rows(spark: SparkSession, d: str) -> DataFrame:
    """Page views as white-space separated lines with the hour in the line: the
    most viewed English page per hour, of equal views the greatest title,
    written as tab-separated lines and read back (SRC1 AGG5 PRJ8 SNK1)."""
    from kestrel.session import scratch_path
    from kestrel.sources import files, sinks
    path, out = scratch_path(spark, "pageviews"), scratch_path(spark, "popular")
    sinks.write_lines(tables.page_view_lines(load(spark, d, "events")), path, sep=" ")
    pages = etl.page_views(etl.hourly_page_lines(files.read_lines(spark, path)))
    sinks.write_lines(aggregate.argmax_by_key(pages, "hour", "views", "title"), out)
    return files.read_csv(spark, out, "hour string, views bigint, title string", sep="\t", quote="")


def etl_split(spark: SparkSession, d: str) -> DataFrame:
    """Customers as JSON lines, read back and written as two complementary
    outputs in one pass; rows, and sum of balances in cents, per side (SRC5
    FLT3 SNK4)."""
    from kestrel.session import scratch_path
    from kestrel.sources import files, sinks
    path, out = scratch_path(spark, "comments"), scratch_path(spark, "sides")
    sinks.write_json(load(spark, d, "customer").select(
        F.col("c_mktsegment").alias("subreddit"), F.col("c_acctbal").alias("score"), F.col("c_name").alias("author")), path)
    rows = files.read_json(spark, path, "subreddit string, score double, author string") \
        .filter(F.col("subreddit").contains("E"))
    sinks.split_write(rows, F.col("score") > 0, out)
    back = spark.read.schema("subreddit string, score double, author string, side string").json(out)
    return back.groupBy("side", "subreddit").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("score") * 100).cast("bigint")).alias("cents"))


QUERIES.update({f.__name__: f for f in (
    typed_load, external_partitions, struct_vs_variant, page_peak, page_peak_rows, etl_split)})


# ------------------------------------- stored models, batches, restarts, row numbers

def forest_from_table(spark: SparkSession, d: str) -> DataFrame:
    """Each held-out day of each station: whether the stored forest's node table gives the loaded
    model's prediction (ML6 ML7 ML10)."""
    from kestrel.ml import forest, pipelines
    from kestrel.session import scratch_path
    _, _, valid, model = _fit_tmax(spark, d)
    path = scratch_path(spark, "forest")
    model.write().save(path)
    scored = forest.with_forest(model.transform(valid), pipelines.FEATURES, forest.node_table(spark, path), "by_table")
    return scored.select("station", F.col("date").cast("string").alias("date"),
                         (F.abs(F.col("by_table") - F.col("prediction")) < 1e-9).alias("equal"))


def forest_importances(spark: SparkSession, d: str) -> DataFrame:
    """Feature importances from the stored node table: all are there, sum to one, and equal
    the loaded model's (ML11)."""
    from kestrel.ml import forest, pipelines
    from kestrel.session import scratch_path
    _, _, _, model = _fit_tmax(spark, d)
    path = scratch_path(spark, "forest")
    model.write().save(path)
    of_model = F.array(*[F.lit(float(x)) for x in model.stages[-1].featureImportances.toArray()])
    near = F.abs(F.get(of_model, F.col("feature")) - F.col("importance")) < 1e-9
    return forest.split_gains(spark, path).agg(F.min(near).alias("equal"), F.round(F.sum("importance"), 9).alias("total"))


def append_batches(spark: SparkSession, d: str) -> DataFrame:
    """Events appended as three batches, the second twice: rows and sum per batch (SNK5)."""
    from kestrel.session import scratch_path
    from kestrel.sources import batches
    ev, table = load(spark, d, "events").select("event_id", "event_type"), scratch_path(spark, "batches")
    for k in (0, 1, 1, 2):
        batches.append_batch(ev.filter(F.pmod("event_id", F.lit(3)) == k), table, f"b{k}")
    back = batches.read_batches(spark, table, ev.schema)
    return back.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("sum_ids"))


def stream_restarted_fit(spark: SparkSession, d: str) -> DataFrame:
    """The running line over events in eight files, two a micro-batch; the run breaks off in its second
    batch, after that batch is written, and a second run goes on from the checkpoint (STM2 STM3 SNK6)."""
    from kestrel.session import scratch_path
    from kestrel.streaming import regression
    source, folder, checkpoint = (scratch_path(spark, n) for n in ("points", "fits", "fit_state"))
    ev = load(spark, d, "events")
    tables.point_messages(ev).select("value").repartition(8).write.text(source)
    points = regression.parse_points(regression.read_stream(spark, source, max_files_per_trigger=2))
    fit = regression.running_fit(points)

    def stop(number: int) -> None:
        if number == 1:
            raise InterruptedError("the run breaks off")

    try:
        regression.run_to_folder(fit, folder, checkpoint, stop)
    except Exception as e:
        if "the run breaks off" not in str(e):
            raise
    regression.run_to_folder(fit, folder, checkpoint)
    last = regression.latest_result(spark, folder, fit.schema)
    return last.select("n", fixed("slope", 9).alias("slope"), fixed("intercept", 9).alias("intercept"))


#: Seed and share of the row numbers' queries.
UNIFORM_SEED, UNIFORM_SHARE = 42, 0.1


def key_uniforms(spark: SparkSession, d: str) -> DataFrame:
    """Every event's number in [0, 1), and whether a sample of a tenth holds it (RND1 SRC8)."""
    from kestrel.functions.uniform import uniform
    u = uniform(UNIFORM_SEED, "event_id")
    return load(spark, d, "events").select("event_id", u.alias("u"), (u < UNIFORM_SHARE).alias("sampled"))


def uniform_crossing(spark: SparkSession, d: str) -> DataFrame:
    """Per user, numbers of its events (by time, id) drawn until their sum reaches one; the mean count
    tends to e (RND1 RE2)."""
    from kestrel.functions.uniform import uniform
    draws = load(spark, d, "events").withColumn("u", uniform(UNIFORM_SEED, "event_id"))
    return scan.first_crossing(draws, "user_id", ["ts", "event_id"], "u", 1.0)


def preview_membership(spark: SparkSession, d: str) -> DataFrame:
    """A preview of 20 orders: how many rows, and how many of them are orders (LIM1)."""
    from kestrel.sources.sinks import preview
    orders = load(spark, d, "orders")
    few = preview(orders, 20)
    return few.join(orders.select(F.col("o_orderkey").alias("k")).distinct(), F.col("o_orderkey") == F.col("k"), "left") \
        .agg(F.count(F.lit(1)).alias("n"), F.count("k").alias("n_known"))


QUERIES.update({f.__name__: f for f in (
    forest_from_table, forest_importances, append_batches, stream_restarted_fit, key_uniforms, uniform_crossing,
    preview_membership)})
