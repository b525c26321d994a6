"""Independent DuckDB SQL for each query in :mod:`kestrel.plans.queries`.

Written from the meaning of each job, not from the Spark plan.  Table
names are the driver's pre-registered views.  Column names and rounding
match the Spark side.
"""

from __future__ import annotations

from kestrel.functions.logs import LOG_LINE

# Java's \s (ASCII) and \p{Punct} (ASCII punctuation) as RE2 classes.
_WS = r"[ \t\n\x0B\f\r]+"
_PUNCT = r"[!-/:-@\[-`{-~ \t\n\x0B\f\r]+"

_WORDS_WS = f"""
  SELECT w AS word FROM (
    SELECT unnest(regexp_split_to_array(text, '{_WS}')) AS w FROM documents) WHERE w <> ''"""

_WORDS_PUNCT = f"""
  SELECT w AS word FROM (
    SELECT unnest(regexp_split_to_array(lower(text), '{_PUNCT}')) AS w FROM documents) WHERE w <> ''"""

_HOUR = "strftime(ts, '%Y-%m-%d %H')"
_DAY = "strftime(ts, '%Y-%m-%d')"

_LOG_LINES = r"""
  SELECT printf('%s - - [%s -0800] "GET %s HTTP/1.0" 200 %s',
                'host' || CAST(user_id AS VARCHAR),
                strftime(ts, '%d/%b/%Y:%H:%M:%S'),
                '/' || event_type || '/' || CAST(event_id AS VARCHAR),
                CASE WHEN event_type = 'error' THEN '-'
                     ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END) AS line
  FROM events"""

_LOG_RE = "'" + LOG_LINE + "'"  # the line's shape is a fixed value, stated once

_PARSED = f"""
  SELECT regexp_extract(line, {_LOG_RE}, 1) AS host,
         strptime(regexp_extract(line, {_LOG_RE}, 2), '%d/%b/%Y:%H:%M:%S') AS datetime,
         regexp_extract(line, {_LOG_RE}, 3) AS path,
         CAST(regexp_extract(line, {_LOG_RE}, 4) AS BIGINT) AS bytes
  FROM ({_LOG_LINES}) WHERE regexp_matches(line, {_LOG_RE})"""

_PER_HOST = f"""
  SELECT host, count(*) AS n_requests, sum(bytes) AS sum_bytes FROM ({_PARSED}) GROUP BY host"""

_HOUR_TYPE = f"SELECT {_HOUR} AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2"

_RANGE = f"""
  SELECT day, user_id, hi - lo AS value_range FROM (
    SELECT {_DAY} AS day, user_id,
           max(CASE WHEN event_type = 'purchase' THEN value END) AS hi,
           min(CASE WHEN event_type = 'click' THEN value END) AS lo
    FROM events GROUP BY 1, 2) WHERE hi IS NOT NULL AND lo IS NOT NULL"""

_DAILY_RANGE_PEAK = f"""
  WITH r AS ({_RANGE}), m AS (SELECT day, max(value_range) AS mr FROM r GROUP BY day)
  SELECT r.day, r.user_id, (floor((r.value_range) * 1e4 + 0.5) / 1e4) AS value_range
  FROM r JOIN m ON r.day = m.day AND r.value_range = m.mr
  ORDER BY r.day, r.user_id"""

_REL = """
  WITH s AS (SELECT c_name, c_nationkey, c_acctbal - 4500 AS score FROM customer),
       m AS (SELECT c_nationkey, avg(score) AS mean FROM s GROUP BY 1 HAVING avg(score) > 0)
  SELECT (floor((s.score / m.mean) * 1e6 + 0.5) / 1e6) AS relative_score, s.c_name, s.c_nationkey
  FROM s JOIN m USING (c_nationkey) WHERE s.score IS NOT NULL ORDER BY relative_score DESC"""

_BFS_BASE = """
  WITH RECURSIVE e AS (
    SELECT DISTINCT o_custkey AS src, o_orderkey % (SELECT count(*) FROM customer) AS dest FROM orders),
  walk(node, distance) AS (
    SELECT CAST(1 AS BIGINT), 0
    UNION
    SELECT e.dest, w.distance + 1 FROM walk w JOIN e ON w.node = e.src WHERE w.distance < {rounds}),
  dist AS (SELECT node, min(distance) AS distance FROM walk GROUP BY node),
  parents AS (SELECT e.dest AS node, p.distance + 1 AS distance, min(e.src) AS source
              FROM e JOIN dist p ON p.node = e.src GROUP BY 1, 2),
  tree AS (SELECT d.node, coalesce(pa.source, d.node) AS source, d.distance
           FROM dist d LEFT JOIN parents pa ON pa.node = d.node AND pa.distance = d.distance)"""

# No shortest path has as many hops as there are rounds here: 40 is far beyond
# the depth of these graphs, and the walk keeps (node, distance) pairs distinct.
_SIX = _BFS_BASE.replace("{rounds}", "6")
_BFS_BASE = _BFS_BASE.replace("{rounds}", "40")

_PATHS = _BFS_BASE + """,
  paths(node, distance, path) AS (
    SELECT node, distance, CAST(node AS VARCHAR) FROM tree WHERE distance = 0
    UNION ALL
    SELECT t.node, t.distance, p.path || ',' || CAST(t.node AS VARCHAR)
    FROM paths p JOIN tree t ON t.source = p.node AND t.distance = p.distance + 1)"""

_COLOURS = """
  SELECT p_partkey, CAST(p_partkey % 256 AS INTEGER) AS R, CAST((p_size * 5) % 256 AS INTEGER) AS G,
         CAST(CAST(trunc(p_retailprice) AS BIGINT) % 256 AS INTEGER) AS B FROM part"""

# Colour standard (sRGB to XYZ at D65, then CIELAB) as relations: a row per
# channel, a row per (axis, channel) of the matrix, a row per axis.  Fixed values.
_LAB = f"""
  WITH c AS ({_COLOURS}),
  matrix(axis, channel, weight, white) AS (VALUES
    ('X', 'R', 0.412453::DOUBLE, 0.95047::DOUBLE), ('X', 'G', 0.357580, 0.95047), ('X', 'B', 0.180423, 0.95047),
    ('Y', 'R', 0.212671, 1.0), ('Y', 'G', 0.715160, 1.0), ('Y', 'B', 0.072169, 1.0),
    ('Z', 'R', 0.019334, 1.08883), ('Z', 'G', 0.119193, 1.08883), ('Z', 'B', 0.950227, 1.08883)),
  channels AS (SELECT p_partkey, channel, byte / 255.0::DOUBLE AS u FROM c UNPIVOT (byte FOR channel IN (R, G, B))),
  axes AS (
    SELECT p_partkey, axis, sum(weight * CASE WHEN u <= 0.04045 THEN u / 12.92
                                              ELSE ((u + 0.055) / 1.055) ** 2.4::DOUBLE END) / any_value(white) AS t
    FROM channels JOIN matrix USING (channel) GROUP BY p_partkey, axis),
  bent AS (
    PIVOT (SELECT p_partkey, axis, CASE WHEN t <= 0.008856 THEN 7.787 * t + 16 / 116::DOUBLE
                                        ELSE t ** (1 / 3::DOUBLE) END AS f FROM axes)
    ON axis IN ('X', 'Y', 'Z') USING any_value(f))
  SELECT c.*, floor((116 * Y - 16) * 1e4 + 0.5) / 1e4 AS labL, floor(500 * (X - Y) * 1e4 + 0.5) / 1e4 AS labA,
         floor(200 * (Y - Z) * 1e4 + 0.5) / 1e4 AS labB
  FROM c JOIN bent USING (p_partkey)"""

# Hue by the place of the last largest channel: sixths of the circle from red, plus
# the signed distance of the two channels after it.
_HSV = f"""
  WITH c AS ({_COLOURS}),
  v AS (SELECT *, [R / 255::DOUBLE, G / 255::DOUBLE, B / 255::DOUBLE] AS u FROM c),
  e AS (SELECT *, list_max(u) AS top, list_max(u) - list_min(u) AS spread,
               4 - list_position(list_reverse(u), list_max(u)) AS place FROM v),
  h AS (SELECT *, CASE WHEN spread = 0 THEN 0::DOUBLE
                       ELSE (2 * (place - 1) + (u[place % 3 + 1] - u[(place + 1) % 3 + 1]) / spread) / 6 END AS turn
        FROM e)
  SELECT p_partkey, R, G, B, turn + CASE WHEN turn < 0 THEN 1 ELSE 0 END AS H,
         CASE WHEN spread = 0 THEN 0 ELSE spread / top END AS S, top AS V FROM h"""

_CROSSING = """
  SELECT user_id, min(pos) AS steps FROM (
    SELECT user_id,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
           sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
    FROM events) WHERE run >= 500 GROUP BY user_id"""

_FIT = """
  SELECT CAST(regr_count(value, CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS BIGINT) AS n,
         (floor((regr_slope(value, CAST(json_extract_string(props, '$.k') AS DOUBLE))) * 1e9 + 0.5) / 1e9) AS slope,
         (floor((regr_intercept(value, CAST(json_extract_string(props, '$.k') AS DOUBLE))) * 1e9 + 0.5) / 1e9) AS intercept
  FROM events"""

_FK = [("orders", "o_custkey", "customer", "c_custkey"),
       ("lineitem", "l_orderkey", "orders", "o_orderkey"),
       ("lineitem", "l_partkey", "part", "p_partkey"),
       ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
       ("customer", "c_nationkey", "nation", "n_nationkey"),
       ("labels", "doc_id", "documents", "doc_id")]

_FK_AUDIT = "\n  UNION ALL\n".join(
    f"""  SELECT '{c}.{fk} -> {p}.{pk}' AS relationship, count(*) AS n_checked,
         count(*) FILTER (WHERE {fk} NOT IN (SELECT {pk} FROM {p} WHERE {pk} IS NOT NULL)) AS n_orphans
  FROM {c} WHERE {fk} IS NOT NULL""" for c, fk, p, pk in _FK)

ORACLE = {
    "wordcount_ws": f"SELECT word, count(*) AS n FROM ({_WORDS_WS}) GROUP BY word ORDER BY word",
    "wordcount_punct": f"SELECT word, count(*) AS n FROM ({_WORDS_PUNCT}) GROUP BY word ORDER BY word",
    "within_partition_sort": f"SELECT word, count(*) AS n FROM ({_WORDS_PUNCT}) GROUP BY word",
    "text_format": f"SELECT word || ' ' || CAST(count(*) AS VARCHAR) AS line FROM ({_WORDS_WS}) GROUP BY word",
    "avg_by_key": "SELECT event_type, (floor((avg(value)) * 1e6 + 0.5) / 1e6) AS avg_value FROM events GROUP BY 1",
    "avg_by_key_pairs": """SELECT event_type, count(value) AS n, (floor((sum(value)) * 1e4 + 0.5) / 1e4) AS total,
                                  (floor((avg(value)) * 1e6 + 0.5) / 1e6) AS avg_value FROM events GROUP BY 1""",
    "max_by_hour": f"SELECT {_HOUR} AS hour, max(value) AS max_value FROM events GROUP BY 1",
    "argmax_by_hour": f"""SELECT hour, value, event_id FROM (
        SELECT {_HOUR} AS hour, value, event_id,
               row_number() OVER (PARTITION BY {_HOUR} ORDER BY value DESC, event_id DESC) AS rn
        FROM events WHERE value IS NOT NULL) WHERE rn = 1""",
    "peak_ties": f"""WITH c AS ({_HOUR_TYPE}), m AS (SELECT hour, max(n) AS n FROM c GROUP BY 1)
        SELECT c.hour, c.event_type, c.n FROM c JOIN m USING (hour, n) ORDER BY 1, 2""",
    "peak_ties_window": f"""SELECT hour, event_type, n FROM (
        SELECT *, rank() OVER (PARTITION BY hour ORDER BY n DESC) AS rk FROM ({_HOUR_TYPE}))
        WHERE rk = 1 ORDER BY 1, 2""",
    "etl_positive": """SELECT c_mktsegment, c_acctbal, c_name FROM customer
        WHERE contains(c_mktsegment, 'E') AND c_acctbal > 0""",
    "etl_nonpositive": """SELECT c_mktsegment, c_acctbal, c_name FROM customer
        WHERE contains(c_mktsegment, 'E') AND NOT coalesce(c_acctbal > 0, false)""",
    "json_fields": """SELECT event_id, k, json_object('event_id', event_id, 'k', k)::VARCHAR AS json
        FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
    "variant_fields": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
        json_extract_string(props, '$.missing') AS missing FROM events""",
    "relative_score": _REL,
    "relative_score_broadcast": _REL,
    "observation_etl": f"""SELECT 'U' || CAST(user_id AS VARCHAR) AS station, {_DAY} AS date,
        (floor((value / 10) * 1e4 + 0.5) / 1e4) AS tmax FROM events
        WHERE event_id % 29 <> 0
          AND starts_with('U' || CAST(user_id AS VARCHAR), 'U1') AND event_type = 'purchase'""",
    "daily_range_peak": _DAILY_RANGE_PEAK,
    "daily_range_peak_sql": _DAILY_RANGE_PEAK,
    "rows_by_source_file": """SELECT 'events.parquet' AS "table", count(*) AS n_rows, 1 AS path_names_table
        FROM events UNION ALL SELECT 'orders.parquet', count(*), 1 FROM orders""",
    "log_parse": f"""SELECT host, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, path, bytes
        FROM ({_PARSED})""",
    "log_dropped": f"""SELECT count(*) AS n_lines,
        count(*) FILTER (WHERE NOT coalesce(regexp_matches(line, {_LOG_RE}), false)) AS n_dropped FROM ({_LOG_LINES})""",
    "host_correlation": f"""SELECT count(*) AS n_hosts, (floor((corr(n_requests, sum_bytes)) * 1e6 + 0.5) / 1e6) AS r,
        (floor((pow(corr(n_requests, sum_bytes), 2)) * 1e6 + 0.5) / 1e6) AS r2 FROM ({_PER_HOST})""",
    "moments_correlation": f"""SELECT count(*) AS n_hosts, (floor((corr(n_requests, sum_bytes)) * 1e6 + 0.5) / 1e6) AS r
        FROM ({_PER_HOST})""",
    "linear_fit": _FIT,
    "stream_linear_fit": _FIT,
    "yesterday_join": f"""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS tmax
                                   FROM events GROUP BY 1, 2)
        SELECT t.user_id, strftime(t.day, '%Y-%m-%d') AS day, t.tmax, y.tmax AS yesterday_tmax
        FROM d t JOIN d y ON t.user_id = y.user_id AND t.day - INTERVAL 1 DAY = y.day""",
    "day_of_year": "SELECT o_orderkey, CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year FROM orders",
    "top1_row_number": """SELECT user_id, event_id, value FROM (
        SELECT user_id, event_id, value,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
        WHERE rn = 1""",
    "union_bag": """SELECT c_name AS name, c_nationkey AS nationkey, 'customer' AS kind FROM customer
        UNION ALL SELECT s_name, s_nationkey, 'supplier' FROM supplier""",
    "bfs_distance": _BFS_BASE + "\n  SELECT node, source, distance FROM tree",
    "bfs_path": _PATHS + "\n  SELECT node, distance, path FROM paths",
    "bfs_six_rounds": _SIX + "\n  SELECT distance, count(*) AS n_nodes, min(node) AS first_node FROM tree GROUP BY 1",
    "bfs_one_path": _PATHS + """,
  longest AS (SELECT string_split(path, ',') AS p FROM paths ORDER BY node DESC LIMIT 1)
  SELECT CAST(i - 1 AS INTEGER) AS step, CAST(p[i] AS BIGINT) AS node
  FROM (SELECT p, unnest(range(1, len(p) + 1)) AS i FROM longest)""",
    "adjacency_edges": """SELECT DISTINCT o_custkey AS src, o_orderkey % (SELECT count(*) FROM customer) AS dest
        FROM orders WHERE o_custkey IS NOT NULL""",
    "rgb_to_lab": _LAB,
    "rgb_to_hsv": _HSV,
    "first_crossing_by_user": _CROSSING,
    "first_crossing": f"""SELECT count(*) AS n_groups, (floor((avg(steps)) * 1e6 + 0.5) / 1e6) AS mean_steps
        FROM ({_CROSSING})""",
    "star_spend": """
        WITH pc AS (SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS spend
                    FROM orders GROUP BY 1)
        SELECT r_name, n_name, CAST(sum(n) AS BIGINT) AS n_orders, CAST(sum(spend) AS DECIMAL(38,2)) AS spend
        FROM pc JOIN customer ON o_custkey = c_custkey
                JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
        GROUP BY r_name, n_name""",
    "partition_pruned": """SELECT strftime(o_orderdate, '%Y-%m') AS o_month, count(*) AS n_orders,
        CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS spend
        FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1996-03' GROUP BY 1""",
    "key_audit": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "fk_audit": _FK_AUDIT,
    "null_audit": """SELECT column_name, n_nulls FROM (
        SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey,
               count(*) FILTER (WHERE o_custkey IS NULL) AS o_custkey,
               count(*) FILTER (WHERE o_orderstatus IS NULL) AS o_orderstatus,
               count(*) FILTER (WHERE o_totalprice IS NULL) AS o_totalprice,
               count(*) FILTER (WHERE o_orderdate IS NULL) AS o_orderdate,
               count(*) FILTER (WHERE o_orderpriority IS NULL) AS o_orderpriority FROM orders)
        UNPIVOT (n_nulls FOR column_name IN (o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                                             o_orderdate, o_orderpriority))""",
}


_WEATHER = """
  SELECT 'U' || CAST(user_id AS VARCHAR) AS station, strftime(ts, '%Y%m%d') AS date,
         CASE WHEN event_type = 'purchase' THEN 'TMAX' WHEN event_type = 'click' THEN 'TMIN'
              ELSE upper(event_type) END AS observation,
         CAST(round(value * 10) AS INTEGER) AS value,
         CASE WHEN event_id % 29 = 0 THEN 'X' END AS qflag
  FROM events"""

_TEMP_RANGE = f"""
  WITH d AS (SELECT date, station,
                    max(CASE WHEN observation = 'TMAX' THEN value END) AS tmax,
                    min(CASE WHEN observation = 'TMIN' THEN value END) AS tmin
             FROM ({_WEATHER}) WHERE qflag IS NULL GROUP BY 1, 2),
       r AS (SELECT date, station, (tmax - tmin) / 10.0 AS range FROM d
             WHERE tmax IS NOT NULL AND tmin IS NOT NULL),
       m AS (SELECT date, max(range) AS mr FROM r GROUP BY 1)
  SELECT r.date, r.station, (floor((r.range) * 1e4 + 0.5) / 1e4) AS range
  FROM r JOIN m ON r.date = m.date AND r.range = m.mr ORDER BY 1, 2"""

_LOG_ROWS = f"""
  SELECT host, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, path, bytes FROM ({_PARSED})"""

ORACLE.update({
    "temp_range_csv": _TEMP_RANGE,
    "json_source_average": """SELECT c_mktsegment AS subreddit,
        (floor((avg(c_acctbal)) * 1e6 + 0.5) / 1e6) AS avg_score, CAST(0 AS BIGINT) AS n_gilded
        FROM customer GROUP BY 1""",
    "text_source_wordcount": f"SELECT word, count(*) AS n FROM ({_WORDS_WS}) GROUP BY word",
    "log_ingest": f"""SELECT sha256(concat_ws(chr(1), host, datetime, path, CAST(bytes AS VARCHAR),
          CAST(row_number() OVER (PARTITION BY host, datetime, path, bytes) AS VARCHAR))) AS id,
        host, datetime, path, bytes FROM ({_LOG_ROWS})""",
    "host_correlation_from_table": ORACLE["host_correlation"],
})


_DAILY = """
  SELECT CAST(user_id AS VARCHAR) AS station, CAST(ts AS DATE) AS date, max(value) AS tmax
  FROM events GROUP BY 1, 2"""

_CONFUSION = """
  WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label,
                    ('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8))::BIGINT % 4 = 0 AS held
             FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
  m AS (SELECT label, pos, avg(x) AS x
        FROM (SELECT label, unnest(v) AS x, unnest(range(len(v))) AS pos FROM e WHERE NOT held) GROUP BY 1, 2),
  w AS (SELECT label AS predicted, list(x ORDER BY pos) AS w, -sum(x * x) / 2 AS b FROM m GROUP BY 1),
  s AS (SELECT label, predicted, row_number() OVER (
          PARTITION BY vec_id ORDER BY list_dot_product(v, w) + b DESC, predicted) AS r
        FROM e, w WHERE held)
  SELECT label, predicted, count(*) AS n FROM s WHERE r = 1 GROUP BY 1, 2"""

ORACLE.update({
    "label_index": """SELECT p_type AS label, n, row_number() OVER (ORDER BY n DESC, p_type) - 1 AS label_index
        FROM (SELECT p_type, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY 1)""",
    "network_confusion": _CONFUSION,
    "network_f1": f"""WITH c AS ({_CONFUSION}),
        k AS (SELECT label AS k, n, 0 AS said, CASE WHEN label = predicted THEN n ELSE 0 END AS hit FROM c
              UNION ALL SELECT predicted, 0, n, 0 FROM c),
        p AS (SELECT k, sum(n) AS n, sum(said) AS said, sum(hit) AS hit FROM k GROUP BY 1)
        SELECT round(sum(n * 2 * hit / (n + said)) / sum(n), 9) AS f1, CAST(sum(n) AS BIGINT) AS n FROM p""",
    "split_sizes": """SELECT CASE WHEN ('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8))::BIGINT % 4 = 0
          THEN 'valid' ELSE 'train' END AS side, label, count(*) AS n FROM embeddings GROUP BY 1, 2""",
    "tmax_features": f"""WITH d AS ({_DAILY})
        SELECT t.station, strftime(t.date, '%Y-%m-%d') AS date, CAST(dayofyear(t.date) AS INTEGER) AS day_of_year,
               t.tmax, y.tmax AS yesterday_tmax
        FROM d t JOIN d y ON y.station = t.station AND y.date + 1 = t.date""",
    "next_day_inputs": f"""WITH d AS ({_DAILY})
        SELECT station, strftime(date + 1, '%Y-%m-%d') AS date, CAST(dayofyear(date + 1) AS INTEGER) AS day_of_year,
               tmax AS yesterday_tmax
        FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY date DESC) AS r FROM d) WHERE r = 1""",
})

_VIEWS = """
  SELECT strftime(ts, '%Y%m%d-%H') AS hour, CASE WHEN event_type = 'error' THEN 'fr' ELSE 'en' END AS locale,
         CASE WHEN user_id % 11 = 0 THEN 'Main_Page' WHEN user_id % 7 = 0 THEN 'Special:' || user_id
              WHEN user_id % 5 = 0 THEN '"Page_' || user_id ELSE 'Page_' || user_id END AS title,
         event_id % 97 AS views
  FROM events"""

_PAGES = f"""SELECT * FROM ({_VIEWS}) WHERE locale = 'en' AND title <> 'Main_Page' AND NOT starts_with(title, 'Special:')"""

_MONTHS = """
  SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n,
         CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS spend FROM orders GROUP BY 1"""

ORACLE.update({
    "typed_load": """
        WITH c AS (SELECT c_custkey, 'P' || (c_nationkey % 10) AS province FROM customer WHERE c_custkey % 50 <> 0),
             p AS (SELECT o_custkey, CAST(o_totalprice AS DECIMAL(12,2)) AS amount FROM orders WHERE o_orderkey % 40 <> 0)
        SELECT province, count(*) AS n_purchases, CAST(sum(amount) AS DECIMAL(38,2)) AS spend
        FROM p JOIN c ON o_custkey = c_custkey GROUP BY 1
        UNION ALL SELECT 'bad_json', count(*), NULL FROM customer WHERE c_custkey % 50 = 0
        UNION ALL SELECT 'bad_csv', count(*), NULL FROM orders WHERE o_orderkey % 40 = 0 OR o_custkey IS NULL""",
    "external_partitions": f"""SELECT *, 'added' AS step FROM ({_MONTHS}) WHERE month = '1996-03'
        UNION ALL SELECT *, 'discovered' FROM ({_MONTHS})""",
    "struct_vs_variant": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS declared_k,
        CAST(json_extract(props, '$.k') AS BIGINT) AS variant_k, event_type AS kind, CAST(NULL AS VARCHAR) AS none
        FROM events""",
    "page_peak": f"""SELECT hour AS stamp, title, views FROM (
        SELECT *, rank() OVER (PARTITION BY hour ORDER BY views DESC) AS r FROM ({_PAGES})) WHERE r = 1""",
    "page_peak_rows": f"""SELECT hour, views, title FROM (
        SELECT *, row_number() OVER (PARTITION BY hour ORDER BY views DESC, title DESC) AS r FROM ({_PAGES}))
        WHERE r = 1""",
    "etl_split": """SELECT CASE WHEN coalesce(c_acctbal > 0, false) THEN 'positive' ELSE 'negative' END AS side,
        c_mktsegment AS subreddit, count(*) AS n, CAST(sum(round(c_acctbal * 100)) AS BIGINT) AS cents
        FROM customer WHERE contains(c_mktsegment, 'E') GROUP BY 1, 2""",
})

_UNIFORM = "CAST(('0x' || substr(md5('42' || chr(31) || '=' || event_id), 1, 13)) AS BIGINT) / 4503599627370496.0"

ORACLE.update({
    "forest_from_table": f"""WITH d AS ({_DAILY})
        SELECT t.station, strftime(t.date, '%Y-%m-%d') AS date, true AS equal
        FROM d t JOIN d y ON y.station = t.station AND y.date + 1 = t.date
        WHERE t.tmax IS NOT NULL AND y.tmax IS NOT NULL
          AND ('0x' || substr(md5(t.station || '|' || strftime(t.date, '%Y-%m-%d')), 1, 8))::BIGINT % 4 = 0""",
    "forest_importances": "SELECT true AS equal, 1.0::DOUBLE AS total",
    "append_batches": """SELECT 'b' || (event_id % 3) AS batch, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS sum_ids
        FROM events GROUP BY 1""",
    "stream_restarted_fit": _FIT,
    "key_uniforms": f"SELECT event_id, CAST({_UNIFORM} AS DOUBLE) AS u, {_UNIFORM} < 0.1 AS sampled FROM events",
    "uniform_crossing": f"""SELECT user_id, min(p) AS steps FROM (
        SELECT user_id, row_number() OVER w AS p, sum(CAST({_UNIFORM} AS DOUBLE)) OVER w AS s FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)) WHERE s >= 1 GROUP BY 1""",
    "preview_membership": "SELECT least(count(*), 20) AS n, least(count(*), 20) AS n_known FROM orders",
})
