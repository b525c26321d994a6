"""A stored forest as a table, and scoring from that table (ML6 ML10 ML11).

A saved forest is a table of nodes.  :func:`node_table` reads it; :func:`with_forest`
scores rows from it by column expressions: each tree is walked from its root, one
split a step, as many steps as the deepest leaf has.  Node tables are as large as the
model, not the data, so the trees become one constant of the expression, and rows are
scored where they are, without a shuffle.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left_node int, right_node int, prediction double"
_TREES = "array<struct<feature: array<int>, threshold: array<double>, left_node: array<int>, " \
         "right_node: array<int>, prediction: array<double>>>"

#: Nodes that a forest may have at most; more raise.
MAX_NODES = 500_000


def _stored_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The node rows that Spark stored with a forest, or with a pipeline that holds one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for pattern in ("/data", "/stages/*/data"):
        for status in fs.globStatus(hadoop.suffix(pattern)) or []:
            stored = spark.read.parquet(status.getPath().toString())
            if "nodeData" in stored.columns:
                return stored
    raise ValueError(f"no forest is stored in {path}")


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """``NODE_SCHEMA`` rows of a saved forest, or of the forest in a saved pipeline (ML10).

    A leaf has no feature, threshold or children.  Nodes are numbered from 0, the root, in
    each tree.  Forests that split on categories are refused."""
    stored, n = _stored_nodes(spark, path), F.col("nodeData")
    inner = n["leftChild"] >= 0
    by_category = inner & (n["split"]["numCategories"] >= 0)
    if not stored.filter(by_category).isEmpty():
        raise ValueError("the forest splits on categories")
    return stored.select(
        F.col("treeID").cast("int").alias("tree"), n["id"].alias("node"),
        F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner, n["leftChild"]).alias("left_node"), F.when(inner, n["rightChild"]).alias("right_node"),
        n["prediction"].alias("prediction"))


def _trees(nodes: DataFrame) -> tuple[list[dict], int]:
    """The trees as arrays by node number, and the steps to the deepest leaf."""
    rows = nodes.orderBy("tree", "node").limit(MAX_NODES + 1).collect()
    if len(rows) > MAX_NODES:
        raise ValueError(f"a forest of more than {MAX_NODES} nodes")
    trees: dict[int, list] = {}
    for r in rows:
        trees.setdefault(r["tree"], []).append(r)
    fields, out, deepest = ("feature", "threshold", "left_node", "right_node", "prediction"), [], 0
    for t, own in sorted(trees.items()):
        if [r["node"] for r in own] != list(range(len(own))):
            raise ValueError(f"the nodes of tree {t} are not numbered from 0")
        level, depth, seen = [0], -1, 0
        while level:
            depth, seen = depth + 1, seen + len(level)
            level = [k for i in level if own[i]["feature"] is not None
                     for k in (own[i]["left_node"], own[i]["right_node"])]
            if seen > len(own):
                raise ValueError(f"tree {t} has a cycle")
        deepest = max(deepest, depth)
        out.append({f: [r[f] for r in own] for f in fields})
    if not out:
        raise ValueError("a forest without trees")
    return out, deepest


def with_forest(df: DataFrame, features: list[str | Column], nodes: DataFrame, out: str = "prediction") -> DataFrame:
    """``df`` with the mean of the trees' leaf predictions for ``features``.

    A value up to the threshold goes left, a greater one or NaN right; a null feature gives a null
    prediction.  ``df`` may have any columns but ``out``."""
    if out in df.columns:
        raise ValueError(f"there is a column {out} already")
    trees, depth = _trees(nodes)
    constant = F.from_json(F.lit(json.dumps(trees)), _TREES)
    values = F.array(*[(F.col(f) if isinstance(f, str) else f).cast("double") for f in features])

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            left = F.get(values, F.get(tree["feature"], at)) <= F.get(tree["threshold"], at)
            below = F.when(left, F.get(tree["left_node"], at)).otherwise(F.get(tree["right_node"], at))
            return F.when(F.get(tree["feature"], at).isNull(), at).otherwise(below)
        at = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) if depth else F.lit(0)
        return F.get(tree["prediction"], at)

    mean = F.aggregate(F.transform(constant, leaf), F.lit(0.0), lambda s, x: s + x) / len(trees)
    missing = F.exists(values, lambda v: v.isNull())
    return df.withColumn(out, F.when(~missing, mean))


def split_gains(spark: SparkSession, path: str) -> DataFrame:
    """(feature, importance) of a saved forest: each split's gain times its rows, as a share of its
    tree, averaged over the trees that split at all, as a share of the whole (ML11)."""
    stored, n = _stored_nodes(spark, path), F.col("nodeData")
    per = stored.filter(n["leftChild"] >= 0).groupBy("treeID", n["split"]["featureIndex"].alias("feature")) \
        .agg(F.sum(n["gain"] * n["rawCount"]).alias("gain"))
    whole = per.groupBy("treeID").agg(F.sum("gain").alias("__tree"))
    shares = per.join(whole, "treeID").groupBy("feature").agg(F.sum(F.col("gain") / F.col("__tree")).alias("gain"))
    total = shares.agg(F.sum("gain")).first()[0]
    return shares.select("feature", (F.col("gain") / F.lit(total)).alias("importance"))
