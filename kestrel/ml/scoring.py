"""Scoring without the fitting pipeline: label index, confusion counts, and
networks whose weights are a table (ML3 ML4 ML5 ML7 ML8).

A network is a table (layer, unit, weights, bias): a row per unit.  It is as
large as the model, not the data, so it is read at the driver and becomes part of
the scoring expression, which stays in the JVM.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators import aggregate
from kestrel.sources.files import rows as literal_rows

#: Units that a network may have at most; more raise.
MAX_UNITS = 10_000


def label_index(df: DataFrame, label: str) -> DataFrame:
    """(label, label_index, n): labels by falling frequency, then text; null is none.
    The numbering looks at one row per label."""
    counts = aggregate.count_by_key(df.dropna(subset=[label]).select(F.col(label).alias("label")), ["label"], "n")
    order = Window.orderBy(F.desc("n"), F.col("label").cast("string"))
    return counts.select("label", (F.row_number().over(order) - 1).cast("long").alias("label_index"), "n")


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """(label, predicted, n): rows per pair, in one aggregate."""
    pairs = df.select(F.col(label).alias("label"), F.col(predicted).alias("predicted"))
    return aggregate.count_by_key(pairs, ["label", "predicted"], "n")


def weighted_f1(counts: DataFrame) -> DataFrame:
    """(f1, n) from :func:`confusion` rows: F1 per label, weighted by its rows.  A label that
    is never predicted counts with an F1 of 0."""
    real = counts.select(F.col("label").alias("k"), "n", F.lit(0).alias("said"),
                         F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"))
    said = counts.select(F.col("predicted").alias("k"), F.lit(0).alias("n"), F.col("n").alias("said"),
                         F.lit(0).alias("hit"))
    per = real.unionByName(said).groupBy("k").agg(*[F.sum(c).alias(c) for c in ("n", "said", "hit")])
    return per.agg((F.sum(F.col("n") * 2 * F.col("hit") / (F.col("n") + F.col("said"))) / F.sum("n")).alias("f1"),
                   F.sum("n").cast("long").alias("n"))


def scoring_model(model: PipelineModel, out: str = "predicted") -> PipelineModel:
    """The fitted stages that scoring needs, and the decoder of the label: rows need no
    label column, and none is left out.  Statements must not name the label."""
    indexer = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    label = indexer.getInputCol()
    for s in model.stages:
        if isinstance(s, SQLTransformer) and label in s.getStatement():
            raise ValueError(f"the pipeline's statement reads the label {label}")
    decoder = IndexToString(inputCol="prediction", outputCol=out, labels=indexer.labels)
    return PipelineModel([s for s in model.stages if s is not indexer] + [decoder])


def network_table(model) -> DataFrame:
    """(layer, unit, weights, bias) of a fitted perceptron."""
    from pyspark.sql import SparkSession
    sizes, flat, rows, at = list(model.getLayers()), model.weights.toArray(), [], 0
    for layer, (n_in, n_out) in enumerate(zip(sizes, sizes[1:])):
        matrix = flat[at:at + n_in * n_out].reshape(n_in, n_out)  # column by column: inputs lie apart
        at += n_in * n_out
        rows += [(layer, u, [float(x) for x in matrix[:, u]], float(flat[at + u])) for u in range(n_out)]
        at += n_out
    return literal_rows(SparkSession.active(), rows, "layer int, unit int, weights array<double>, bias double")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def with_outputs(df: DataFrame, features: str, network: DataFrame, out: str = "outputs") -> DataFrame:
    """``df`` with the last layer's sums for the array column ``features``; units
    between layers are logistic."""
    units = network.orderBy("layer", "unit").limit(MAX_UNITS + 1).collect()
    if len(units) > MAX_UNITS:
        raise ValueError(f"a network of more than {MAX_UNITS} units")
    layers: dict[int, list] = {}
    for u in units:
        layers.setdefault(u["layer"], []).append(F.struct(
            F.array(*[F.lit(float(w)) for w in u["weights"]]).alias("w"), F.lit(float(u["bias"])).alias("b")))
    df = df.withColumn("__layer", F.transform(features, lambda x: x.cast("double")))
    for k, layer in sorted(layers.items()):
        sums = F.transform(F.array(*layer), lambda u: u["b"] + _dot(F.col("__layer"), u["w"]))
        last = k == max(layers)
        df = df.withColumn("__layer", sums if last else F.transform(sums, lambda x: 1 / (1 + F.exp(-x))))
    return df.withColumnRenamed("__layer", out)


def best_unit(outputs: Column | str) -> Column:
    """Index of the greatest output, the first of equals."""
    return (F.array_position(F.col(outputs) if isinstance(outputs, str) else outputs, F.array_max(outputs)) - 1) \
        .cast("long")


def centroid_network(train: DataFrame, vector: str, label: str) -> DataFrame:
    """(layer, unit, weights, bias, label): one linear unit per label whose greatest output
    names the label of the nearest mean vector."""
    means = train.dropna(subset=[vector, label]).select(F.col(label).alias("label"), F.posexplode(vector).alias("pos", "x")) \
        .groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    weights = means.groupBy("label").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda e: e["x"]).alias("weights"))
    order = Window.orderBy("label")
    return weights.select(F.lit(0).alias("layer"), (F.row_number().over(order) - 1).alias("unit"), "weights",
                          (-_dot(F.col("weights"), F.col("weights")) / 2).alias("bias"), "label")
