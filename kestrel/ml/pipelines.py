"""Spark ML jobs (ML1-ML11, RE3, RE4, UDF4).

Feature engineering is SQL or column expressions inside the pipeline
(``SQLTransformer``), so the same stages run at fit and at scoring time.
Splits go by a hash of the rows' keys; features are built *before* the split, so a row's
"yesterday" neighbour is found even when the two rows land in different
splits.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions import colour
from kestrel.ml.scoring import scoring_model
from kestrel.operators.joins import previous_day_join
from kestrel.operators.partitioning import spread_for_cpu
from kestrel.sources.files import rows as literal_rows

SEED = 1234


#: Labelled rows that a model is fitted on at most, where :func:`bounded` is called
#: (not in :func:`colour_models`); every row is scored.
MAX_TRAIN_ROWS = 200_000

#: Training rows in a task of a learner that passes over them a hundred times.
ROWS_PER_TASK = 20_000


def key_bucket(keys: list[str], buckets: int = 4) -> Column:
    """Bucket 0 .. buckets - 1 of a row's keys, from the MD5 of their text."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def split(df: DataFrame, keys: list[str], buckets: int = 4):
    """Train/validation split by a hash of the row's keys (ML1): about three
    quarters of the rows train.  The same row lands on the same side whatever
    the partitioning."""
    marked = df.withColumn("__bucket", key_bucket(keys, buckets))
    return (marked.filter("__bucket > 0").drop("__bucket"), marked.filter("__bucket = 0").drop("__bucket"))


def bounded(train: DataFrame, keys: list[str], max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """At most about ``max_rows`` training rows, chosen by a hash of their keys."""
    every = -(-train.count() // max_rows)
    return train if every <= 1 else train.filter(F.pmod(F.xxhash64(*keys), F.lit(every)) == 0)


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` persisted within the block.  Derived columns are computed once here:
    a filter on a derived column repeats its expression, in every pass, so persist
    first and filter the persisted rows."""
    from pyspark import StorageLevel
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def fit_cached(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit with the training rows persisted for the duration of the fit:
    iterative learners (L-BFGS, tree levels) pass over them many times."""
    from pyspark import StorageLevel
    cached = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(cached)
    finally:
        cached.unpersist()


def fit_dealt(pipeline: Pipeline, train: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> PipelineModel:
    """:func:`fit_cached` with the training rows dealt evenly over a task per
    ``rows_per_task`` rows, for L-BFGS: its passes would otherwise take as many
    cores as the input has splits, often one.  Up to ``rows_per_task`` rows stay as they
    are: there a task's overhead outweighs the compute."""
    with stored(train) as kept:
        tasks = -(-kept.count() // rows_per_task)
        return fit_cached(pipeline, spread_for_cpu(kept, tasks if tasks > 1 else None))


# ----------------------------------------------------------- classification

def mlp_pipeline(features: list[str], label: str, n_classes: int, hidden: int = 30,
                 sql: str | None = None, max_iter: int = 100, seed: int = SEED) -> Pipeline:
    """[optional SQL stage] -> assemble -> index label -> MLP (ML2 ML3 ML5 ML7 UDF4).

    A label that fitting never saw gets an index that is never predicted, so that
    such rows stay and count as errors."""
    stages = []
    if sql:
        stages.append(SQLTransformer(statement=sql))
    stages += [
        VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error"),
        StringIndexer(inputCol=label, outputCol="label_index", handleInvalid="keep"),
        MultilayerPerceptronClassifier(layers=[len(features), hidden, n_classes],
                                       maxIter=max_iter, blockSize=128, seed=seed,
                                       labelCol="label_index", featuresCol="features"),
    ]
    return Pipeline(stages=stages)


def labelled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that have all of ``columns``: a missing label is no class of its own,
    and a missing feature is no number."""
    return df.dropna(subset=columns)


def f1_score(predictions: DataFrame) -> float:
    """Multiclass score, default metric f1 (ML8)."""
    return MulticlassClassificationEvaluator(labelCol="label_index").evaluate(predictions)


def colour_models(colours: DataFrame, seed: int = SEED) -> DataFrame:
    """Fit RGB -> word and RGB -> LAB -> word classifiers on every training row;
    one score row each."""
    spark, columns = colours.sparkSession, ["R", "G", "B", "word"]
    n = len(colour.COLOUR_WORDS)
    rows = []
    with stored(colours.select(*columns)) as kept:
        train, valid = split(labelled(kept, columns), columns)
        for name, feats, sql in (
                ("rgb", ["R", "G", "B"], None),
                ("lab", ["labL", "labA", "labB"], colour.lab_statement(columns))):
            model = fit_dealt(mlp_pipeline(feats, "word", n, sql=sql, seed=seed), train)
            rows.append((name, float(f1_score(model.transform(valid)))))
    return literal_rows(spark, rows, "model string, f1 double")


def vector_label_scores(df: DataFrame, key: str, vector: str, label: str, seed: int = SEED) -> DataFrame:
    """Classify array features with an MLP; one row with split sizes and f1."""
    spark = df.sparkSession
    data = labelled(df, [key, vector, label]).select(
        key, array_to_vector(F.col(vector)).alias("features_in"), F.col(label).cast("string").alias("label"))
    dim = len(data.first()["features_in"])
    n_classes = data.select("label").distinct().count()
    train, valid = split(data, [key])
    train = bounded(train, [key])
    pipe = Pipeline(stages=[
        StringIndexer(inputCol="label", outputCol="label_index", handleInvalid="keep"),
        MultilayerPerceptronClassifier(layers=[dim, 30, n_classes], maxIter=100,
                                       blockSize=128, seed=seed, labelCol="label_index",
                                       featuresCol="features_in")])
    model = fit_dealt(pipe, train)
    score = float(f1_score(model.transform(valid)))
    return literal_rows(spark, [(train.count(), valid.count(), score)],
                                 "n_train long, n_valid long, f1 double")


def grid_predictions(model: PipelineModel, grid: DataFrame) -> DataFrame:
    """Score a generated feature grid and attach the label text (RE4)."""
    return scoring_model(model).transform(grid).select("id", "lab_a", "lab_b", "R", "G", "B", "predicted")


# ---------------------------------------------------------------- regression

#: Both derived columns in one statement: a day is paired with the row that names
#: it as its next day, an equi-join on plain columns.
FEATURE_SQL = """
    SELECT d.*, dayofyear(d.date) AS day_of_year, p.tmax_before AS yesterday_tmax
    FROM __THIS__ d
    JOIN (SELECT station AS p_station, date_add(date, 1) AS next_date, tmax AS tmax_before FROM __THIS__) p
      ON p.p_station = d.station AND p.next_date = d.date"""

FEATURES = ["latitude", "longitude", "elevation", "day_of_year", "yesterday_tmax"]


def tmax_features(daily: DataFrame) -> DataFrame:
    """Day of year and yesterday's value as columns, built before any split."""
    with_day = daily.withColumn("day_of_year", F.dayofyear("date"))
    return previous_day_join(with_day, "station", "date", "tmax")


def forest_pipeline(label: str = "tmax", depth: int = 10, bins: int = 40,
                    seed: int = SEED, sql_stages: bool = False) -> Pipeline:
    """Assemble -> random forest regressor, depth 10, 40 bins (ML2 ML6 ML7).

    ``sql_stages=True`` puts the statement of both derived columns inside the
    pipeline, as a stage (UDF4).  Then the yesterday join runs on
    whatever rows the pipeline is given, so a row whose previous day went to
    the other split has no neighbour.  The default expects features built
    first (:func:`tmax_features`), before any split.
    """
    stages = []
    if sql_stages:
        stages.append(SQLTransformer(statement=FEATURE_SQL))
    stages += [
        VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep"),
        RandomForestRegressor(labelCol=label, featuresCol="features", maxDepth=depth,
                              maxBins=bins, seed=seed)]
    return Pipeline(stages=stages)


def regression_scores(predictions: DataFrame, label: str = "tmax") -> tuple[float, float]:
    """R^2 and RMSE (ML9), of predictions that are made once."""
    kept = predictions.select(label, "prediction").persist()
    try:
        r2 = RegressionEvaluator(labelCol=label, metricName="r2").evaluate(kept)
        rmse = RegressionEvaluator(labelCol=label, metricName="rmse").evaluate(kept)
    finally:
        kept.unpersist()
    return float(r2), float(rmse)


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    """Write the fitted pipeline and read it back (ML10)."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def feature_importances(model: PipelineModel) -> dict:
    """Feature -> importance of the fitted forest (ML11)."""
    imp = model.stages[-1].featureImportances
    return {f: float(imp[i]) for i, f in enumerate(FEATURES)}


def tomorrow_inputs(daily: DataFrame) -> DataFrame:
    """For every station: a row for the day after its last day, with that
    last day's value as ``yesterday_tmax`` (RE3).  Features that come from
    the station itself are carried over."""
    from pyspark.sql import Window
    w = Window.partitionBy("station").orderBy(F.col("date").desc())
    last = daily.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    return last.select("station", F.date_add("date", 1).alias("date"),
                       "latitude", "longitude", "elevation",
                       F.col("tmax").alias("yesterday_tmax")) \
        .withColumn("day_of_year", F.dayofyear("date")) \
        .withColumn("tmax", F.lit(None).cast("double"))
