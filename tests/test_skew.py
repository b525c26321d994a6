"""Hot keys: one key holds a third (or more) of the rows.  Results must be
whole and exact, and the plans must split or pre-combine the hot key."""
import random
from collections import defaultdict, deque

from pyspark.sql import functions as F

from kestrel.operators import aggregate, audit, graph, joins, peaks


def _plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _hot_rows(n=30000, seed=5):
    rnd = random.Random(seed)
    return [(0 if i % 3 == 0 else rnd.randrange(1, 500), f"a{i}", float(rnd.randrange(-50, 100)))
            for i in range(n)]


def test_hot_key_join_back_is_salted_and_exact(spark):
    """AQE cannot split a join against an aggregate's output, so the join-back
    salts hot keys itself: same rows as a plain join, and the hot key's rows
    land in several shuffle partitions."""
    rows = _hot_rows()
    df = spark.createDataFrame(rows, "k int, author string, score double").repartition(8)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        per_key = df.groupBy("k").agg(F.avg("score").alias("m"), F.count(F.lit(1)).alias("n"))
        big = df.select("k", "author")
        salted = joins.join_per_key(big, per_key, "k", "n", rows_per_task=1000)
        plain = joins.join_per_key(big, per_key, "k", "n", broadcast="never")
        a = sorted((r.k, r.author, r.m, r.n) for r in salted.collect())
        b = sorted((r.k, r.author, r.m, r.n) for r in plain.collect())
        assert a == b and len(a) == len(rows)
        parts = salted.filter("k = 0").select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1
        sums, cnts = defaultdict(float), defaultdict(int)
        for k, _, s in rows:
            sums[k] += s
            cnts[k] += 1
        want = sum(cnts[k] for k in cnts if sums[k] / cnts[k] > 0)
        rel = joins.relative_to_group_mean(df, "k", "score", "author", rows_per_task=1000)
        assert rel.count() == want
        top = peaks.rows_at_group_max_join(df, "k", "score", rows_per_task=1000)
        win = peaks.rows_at_group_max(df, "k", "score")
        assert sorted((r.k, r.author, r.score) for r in top.collect()) == \
            sorted((r.k, r.author, r.score) for r in win.collect())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_aggregates_combine_map_side(spark):
    df = spark.createDataFrame(_hot_rows(), "k int, author string, score double")
    best = aggregate.argmax_by_key(df, "k", "score", "author")
    assert "partial_max" in _plan(best)
    hot = best.filter("k = 0").first()
    want = max((s, a) for k, a, s in _hot_rows() if k == 0)
    assert (hot.score, hot.author) == want
    top = peaks.rows_at_group_max(df, "k", "score")
    assert "WindowGroupLimit" in _plan(top)
    n_hot_top = top.filter("k = 0").count()
    assert n_hot_top == sum(1 for k, a, s in _hot_rows() if k == 0 and s == want[0])


def test_hot_foreign_key_audit(spark):
    child = spark.createDataFrame([(0,)] * 5000 + [(i,) for i in range(1, 100)] + [(777,)], "fk int")
    parent = spark.createDataFrame([(i,) for i in range(100)], "pk int")
    s = audit.orphan_summary(child, "c", "fk", parent, "p", "pk").first()
    assert (s.n_checked, s.n_orphans) == (5100, 1)


def test_bfs_with_hub_node_matches_brute_force(spark):
    rnd = random.Random(2)
    edges = [(0, i) for i in range(1, 3000)]  # hub: a large share of all edges
    edges += [(rnd.randrange(1, 3000), rnd.randrange(1, 3000)) for _ in range(3000)]
    edges += [(5000, 0), (5000, 5001), (5001, 5002)]
    e = spark.createDataFrame(edges, "src bigint, dest bigint")
    got = {r.node: (r.distance, r.source) for r in graph.bfs(spark, e, 5000).collect()}
    adj = defaultdict(set)
    for a, b in edges:
        adj[a].add(b)
    dist, parent, q = {5000: 0}, {5000: 5000}, deque([5000])
    while q:
        u = q.popleft()
        for v in sorted(adj[u]):
            if v not in dist:
                dist[v] = dist[u] + 1
                parent[v] = u
                q.append(v)
    # smallest parent among the previous round's nodes
    for v in dist:
        if dist[v] > 0:
            parent[v] = min(u for u in dist if dist[u] == dist[v] - 1 and v in adj[u])
    assert got == {v: (dist[v], parent[v]) for v in dist}
