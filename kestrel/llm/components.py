"""Connected components of an edge table by repeated contraction.

Each round every node moves to its smallest neighbour (or stays) in an order
that a hash draws anew each round, and the edges are renamed and made distinct.
So the number of nodes shrinks by a constant factor in expectation, long
chains included, and edges of a hub collapse.  All steps are joins and
aggregates on tables in the shared scratch folder; only the number of edges
left comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import stored


def representatives(edges: DataFrame) -> DataFrame:
    """(node, rep) for every node of ``edges`` (u, v); nodes of one component
    share one rep, which is one of them.

    Loops and repeated edges are allowed, null ends are not.  No edges give no rows.
    """
    edges = stored(edges.select("u", "v").filter("u <> v"), "edges")
    label, round_no = None, 0
    while not edges.isEmpty():
        def rank(node):
            return F.struct(F.xxhash64(node, F.lit(round_no)).alias("h"), F.col(node).alias("to"))

        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the node itself competes with its neighbours
        best = both.select("u", rank("v").alias("x")).groupBy("u").agg(F.min("x").alias("x"))
        moves = stored(best.select(F.col("u").alias("node"), F.least("x", rank("u"))["to"].alias("to")), "moves")
        onward = moves.select(F.col("node").alias("to"), F.col("to").alias("next"))
        moves = stored(moves.join(onward, "to").select("node", F.col("next").alias("to")), "moves")
        a = moves.select(F.col("node").alias("u"), F.col("to").alias("a"))
        b = moves.select(F.col("node").alias("v"), F.col("to").alias("b"))
        edges = stored(edges.join(a, "u").join(b, "v").filter("a <> b")
                       .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
        if label is None:
            label = moves.withColumnRenamed("to", "rep")
        else:
            step = moves.select(F.col("node").alias("rep"), "to")
            label = stored(label.join(step, "rep", "left")
                           .select("node", F.coalesce("to", "rep").alias("rep")), "labels")
        round_no += 1
    if label is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("rep"))
    return label
