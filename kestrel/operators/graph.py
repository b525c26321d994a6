"""Hop distances and shortest paths on an edge table (GRF1-GRF5, JN7,
SET1, AGG11).

Breadth-first search as a short driver loop of DataFrame rounds.  The edges
are made distinct once and written as a table bucketed by their source node in
the shared scratch folder, so that no round shuffles them again.  Each round joins
only the *frontier* (nodes first reached in the previous round) with them,
keeps for every newly reached node the smallest parent, and removes nodes
already known with an anti-join.  Known nodes lie in visited tables that are merged in tiers,
so the plan of a round grows with the logarithm of the rounds only.  A round's new rows (node, parent, distance)
go to the shared folder (reliable, so a lost executor does not lose them) and
the plan of the next round starts from those files; lineage never grows.  Only
one number per round comes to the driver: how many new nodes there are, or
whether the target is among them.

Distances need no paths.  Paths are put together afterwards, one round after
the other, by joining each round's nodes with the paths of their parents.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import checkpoint_root, scratch_path
from kestrel.sources.files import rows

TREE_SCHEMA = "node bigint, source bigint, distance int"

#: Visited tables that are merged into one of the next tier.
MERGE = 4


def parse_adjacency(lines: DataFrame, col: str = "value") -> DataFrame:
    """``'src: d1 d2 ...'`` lines to ``(src, dest)`` rows (GRF1).

    Nodes without out-edges produce no row.  Blank lines, and ids that are
    not integers, are ignored.
    """
    parts = F.split(F.col(col), ":", 2)
    src = F.trim(F.get(parts, 0))
    dests = F.filter(F.split(F.trim(F.coalesce(F.get(parts, 1), F.lit(""))), r"\s+"),
                     lambda d: d != F.lit(""))
    return lines.filter(F.trim(F.col(col)) != "") \
        .select(src.try_cast("bigint").alias("src"), F.explode(dests).alias("dest")) \
        .select("src", F.col("dest").try_cast("bigint").alias("dest")) \
        .filter(F.col("src").isNotNull() & F.col("dest").isNotNull())


def prepared_edges(edges: DataFrame, src: str = "src", dest: str = "dest") -> str:
    """Name of a table of the distinct edges, bucketed by source node, in the shared
    scratch folder.  Drop it when the search is done."""
    spark = edges.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"kestrel_edges_{uuid.uuid4().hex[:12]}"
    edges.select(F.col(src).cast("bigint").alias("src"), F.col(dest).cast("bigint").alias("dest")) \
        .filter(F.col("src").isNotNull() & F.col("dest").isNotNull()).distinct().repartition(n, "src") \
        .write.bucketBy(n, "src").option("path", scratch_path(spark, "edges")).saveAsTable(name)
    return name


def _visited(tiers: list[tuple[int, DataFrame]], new: DataFrame) -> list[tuple[int, DataFrame]]:
    """The visited tables after a round: ``new`` joins them, and whenever the last ``MERGE`` tables
    are of one tier, one table of the next tier, dealt out by node, replaces them.  So there are at most
    ``MERGE - 1`` tables a tier, and a row is rewritten once a tier, the logarithm of the rounds."""
    tiers = [*tiers, (0, new)]
    while len(tiers) >= MERGE and len({t for t, _ in tiers[-MERGE:]}) == 1:
        tier, last = tiers[-1][0], [df for _, df in tiers[-MERGE:]]
        merged = reduce(DataFrame.union, last).hint("rebalance", "node").checkpoint(eager=True)
        tiers = [*tiers[:-MERGE], (tier + 1, merged)]
    return tiers


def bfs_rounds(spark: SparkSession, edges: DataFrame, source: int, max_rounds: int | None = None,
               target: int | None = None, src: str = "src", dest: str = "dest") -> list[DataFrame]:
    """The search as one table ``node, source, distance`` per round, from the
    seed on (GRF2, GRF3).

    The parent (``source``) of a node is the smallest node of the previous
    round with an edge to it.  Stops when no new node is found (GRF3),
    after ``max_rounds`` rounds, or -- when ``target`` is given -- after
    the round that reaches it (GRF2).
    """
    return _search(spark, edges, source, max_rounds, target, src, dest)[0]


def _search(spark: SparkSession, edges: DataFrame, source: int, max_rounds: int | None, target: int | None,
            src: str, dest: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """The tables of the rounds, and the visited tables that hold the same rows."""
    rounds = [rows(spark, [(int(source), int(source), 0)], TREE_SCHEMA)]
    tiers = _visited([], rounds[0])
    if target is not None and int(target) == int(source):
        return rounds, rounds
    checkpoint_root(spark)
    table = prepared_edges(edges, src, dest)
    try:
        e = spark.table(table)
        while max_rounds is None or len(rounds) <= max_rounds:
            known = reduce(DataFrame.union, [v.select("node") for _, v in tiers])
            frontier = rounds[-1].select(F.col("node").alias("src"))
            new = e.join(frontier, "src").groupBy(F.col("dest").alias("node")).agg(F.min("src").alias("source")) \
                .join(known, "node", "left_anti") \
                .select("node", "source", F.lit(len(rounds)).alias("distance")).checkpoint(eager=True)
            hit = F.max(F.col("node") == F.lit(target)) if target is not None else F.lit(False)
            stats = new.agg(F.count(F.lit(1)).alias("n"), hit.alias("hit")).first()
            if stats["n"] == 0:
                break
            rounds.append(new)
            tiers = _visited(tiers, new)
            if stats["hit"]:
                break
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return rounds, [v for _, v in tiers]


def bfs(spark: SparkSession, edges: DataFrame, source: int, max_rounds: int | None = None,
        target: int | None = None, src: str = "src", dest: str = "dest") -> DataFrame:
    """``node, source, distance`` of every node reached (see :func:`bfs_rounds`)."""
    return reduce(DataFrame.union, _search(spark, edges, source, max_rounds, target, src, dest)[1])


def with_paths(rounds: list[DataFrame]) -> DataFrame:
    """``node, source, distance, path`` from the tables of the rounds (GRF5): each
    round's paths are its parents' paths and the node itself."""
    paths = rounds[0].withColumn("path", F.array("node"))
    done = [paths]
    for new in rounds[1:]:
        parents = paths.select(F.col("node").alias("source"), F.col("path").alias("__p"))
        paths = new.join(parents, "source").select(
            "node", "source", "distance", F.concat("__p", F.array("node")).alias("path")).checkpoint(eager=True)
        done.append(paths)
    return reduce(DataFrame.union, done)


def path_to(rounds: list[DataFrame], target: int) -> DataFrame:
    """The path to one node as rows ``(step, node)``; empty when the node was not
    reached (GRF5).  Walks back from the target, one node a round, so only the
    path itself (at most one number per round) comes to the driver."""
    spark = rounds[0].sparkSession
    found, node = [], target
    for r in reversed(rounds):
        row = r.filter(F.col("node") == F.lit(node)).select("source", "distance").first()
        if row is not None:
            found.append((row["distance"], int(node)))
            node = row["source"]
    return rows(spark, found[::-1], "step int, node bigint")


def write_rounds(tree: DataFrame, output: str, fmt: str = "csv") -> None:
    """Write the search as one table partitioned by round (GRF4): folder
    ``distance=k`` holds the nodes first reached in round k, so the state
    after round k is ``distance <= k`` -- one write instead of one full copy
    per round."""
    tree.select("node", "source", "distance").write.mode("overwrite").partitionBy("distance").format(fmt).save(output)


def write_path(rounds: list[DataFrame], target: int, output: str) -> None:
    """Write the path to ``target`` as text, one node per line, in order (GRF5)."""
    path_to(rounds, target).orderBy("step").select(F.col("node").cast("string").alias("value")) \
        .coalesce(1).write.mode("overwrite").text(output)
