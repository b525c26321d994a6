"""Shortest paths on the six-node graph with its known answers."""
from kestrel.operators import graph

GRAPH_1 = ["1: 3 5", "2: 4", "3: 2 5", "4: 3", "5:", "6: 1 5"]


def _edges(spark):
    lines = spark.createDataFrame([(x,) for x in GRAPH_1 + ["", "   "]], "value string")
    return graph.parse_adjacency(lines)


def test_parse_adjacency_drops_edgeless(spark):
    e = _edges(spark)
    assert sorted(tuple(r) for r in e.collect()) == [
        (1, 3), (1, 5), (2, 4), (3, 2), (3, 5), (4, 3), (6, 1), (6, 5)]


def test_bfs_distances_and_parents(spark):
    p = graph.bfs(spark, _edges(spark), 1)
    got = sorted((r.node, r.source, r.distance) for r in p.collect())
    assert got == [(1, 1, 0), (2, 3, 2), (3, 1, 1), (4, 2, 3), (5, 1, 1)]


def test_rows_known_after_each_round(spark):
    e = _edges(spark)
    assert [graph.bfs(spark, e, 1, max_rounds=k).count() for k in (1, 2, 3)] == [3, 4, 5]


def test_path_and_unreachable(spark):
    r = graph.bfs_rounds(spark, _edges(spark), 1, target=4)
    assert [x.node for x in graph.path_to(r, 4).orderBy("step").collect()] == [1, 3, 2, 4]
    assert graph.path_to(r, 6).count() == 0
    assert graph.bfs(spark, _edges(spark), 1, target=6).filter("node = 6").count() == 0
    paths = {x.node: x.path for x in graph.with_paths(graph.bfs_rounds(spark, _edges(spark), 1)).collect()}
    assert paths == {1: [1], 3: [1, 3], 5: [1, 5], 2: [1, 3, 2], 4: [1, 3, 2, 4]}


def test_stop_at_target(spark):
    p = graph.bfs(spark, _edges(spark), 1, target=3)
    assert max(r.distance for r in p.collect()) == 1


def test_rounds_written_partitioned_and_path_file(spark, tmp):
    import os
    r = graph.bfs_rounds(spark, _edges(spark), 1)
    out = os.path.join(tmp, "rounds")
    graph.write_rounds(graph.bfs(spark, _edges(spark), 1), out)
    back = spark.read.csv(out, schema="node bigint, source bigint, distance int")
    assert [back.filter(f"distance <= {k}").count() for k in (0, 1, 2, 3)] == [1, 3, 4, 5]
    graph.write_path(r, 4, os.path.join(tmp, "path"))
    assert [x.value for x in spark.read.text(os.path.join(tmp, "path")).collect()] == ["1", "3", "2", "4"]


def _plain_search(edges, source):
    """Per node: distance, and the smallest parent of the round before."""
    out, seen, frontier, k = {}, {}, {source}, 0
    for s, d in edges:
        out.setdefault(s, set()).add(d)
    seen[source] = (0, source)
    while frontier:
        k += 1
        new = {}
        for s in frontier:
            for d in out.get(s, ()):
                if d not in seen:
                    new[d] = min(s, new.get(d, s))
        seen.update({d: (k, s) for d, s in new.items()})
        frontier = set(new)
    return seen


def test_a_hundred_nodes_against_a_plain_search(spark):
    """Edges by rule, repeated ones and loops among them, and a long tail."""
    pairs = [(n, (n * n + 7 * j) % 101) for n in range(1, 101) for j in range(n % 4)]
    pairs += [(5, 5), (6, 7), (6, 7)] + [(n, n + 1) for n in range(200, 230)] + [(100, 200)]
    edges = spark.createDataFrame(pairs + [(None, 3), (3, None)], "src long, dest long")
    for source in (53, 92):
        rounds = graph.bfs_rounds(spark, edges, source)
        want = _plain_search(pairs, source)
        got = {r.node: (r.distance, r.source) for t in rounds for r in t.collect()}
        assert got == want
        for k, n in enumerate(rounds):
            assert n.count() == sum(d == k for d, _ in want.values())
        far = max(want, key=lambda x: want[x][0])
        steps = [r.node for r in graph.path_to(rounds, far).orderBy("step").collect()]
        chain = [far]
        while chain[-1] != source:
            chain.append(want[chain[-1]][1])
        assert steps == chain[::-1]


def test_rounds_do_not_shuffle_the_edges_again(spark):
    """The prepared edges keep their layout, so a join on the source deals out
    only the frontier."""
    conf = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in conf}
    for k in conf:
        spark.conf.set(k, "-1")
    try:
        e = spark.table(graph.prepared_edges(spark.range(1000).selectExpr("id % 50 AS src", "id AS dest")))
        joined = e.join(spark.createDataFrame([(1,), (2,)], "src long"), "src")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and joined.count() == 40
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_visited_tables_stay_few(spark, monkeypatch):
    """A path of 40 nodes: the tables that a round looks at grow with the logarithm of the rounds."""
    seen, kept = [], graph._visited

    def counted(tiers, new):
        out = kept(tiers, new)
        seen.append(len(out))
        return out

    monkeypatch.setattr(graph, "_visited", counted)
    e = spark.range(1, 40).selectExpr("id AS src", "id + 1 AS dest").union(
        spark.range(2, 41).selectExpr("id AS src", "1L AS dest"))
    got = sorted((r.node, r.source, r.distance) for r in graph.bfs(spark, e, 1).collect())
    assert got == [(1, 1, 0)] + [(k, k - 1, k - 1) for k in range(2, 41)]
    assert len(seen) == 40 and max(seen) <= 3 * (graph.MERGE - 1)
