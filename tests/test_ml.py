"""Spark ML jobs: shapes, save/load, and a quality floor on the colour model."""
from conftest import SF_MID, SF_SMALL
from kestrel.functions import colour
from kestrel.plans import queries as Q


def test_colour_models_learn(spark):
    rows = {r.model: r.f1 for r in Q.ml_colour_scores(spark, SF_MID).collect()}
    assert set(rows) == {"rgb", "lab"}
    assert rows["lab"] > 0.6


def test_next_day_scores_every_user(spark):
    pred = Q.ml_next_day(spark, SF_SMALL)
    users = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("user_id").distinct().count()
    assert pred.count() == users
    assert pred.filter("predicted_tmax IS NULL").count() == 0
    s = Q.ml_next_day_scores(spark, SF_SMALL).first()
    assert s.top_feature in ("latitude", "longitude", "elevation", "day_of_year", "yesterday_tmax")


def test_lab_grid_round_trips(spark):
    grid = colour.lab_grid(spark, 70.0, 9)
    back = colour.with_lab(grid).collect()
    inside = [r for r in back if 0 < r.R < 255 and 0 < r.G < 255 and 0 < r.B < 255]
    assert inside
    for r in inside:
        assert abs(r.labL - 70.0) < 1e-6 and abs(r.labA - r.lab_a) < 1e-6 and abs(r.labB - r.lab_b) < 1e-6


def test_forest_with_sql_stages_in_the_pipeline(spark):
    """The stage form: raw daily rows in, the pipeline derives its features."""
    from kestrel.ml import pipelines
    daily = Q._daily_series(spark, SF_SMALL)
    train, valid = pipelines.split(daily, ["station", "date"])
    model = pipelines.fit_cached(pipelines.forest_pipeline(sql_stages=True, depth=4), train)
    scored = model.transform(valid)
    assert "prediction" in scored.columns
    assert scored.count() <= pipelines.tmax_features(valid).count()


def test_scores_are_those_of_the_stored_predictions(spark, tmp):
    """r2 and RMSE again, by plain sums over stored predictions; with a floor."""
    from kestrel.ml import pipelines
    _, train, valid, model = Q._fit_tmax(spark, SF_MID)
    model.transform(valid).select("tmax", "prediction").write.parquet(tmp + "/p")
    p = spark.read.parquet(tmp + "/p")
    r2, rmse = pipelines.regression_scores(p)
    row = p.selectExpr("avg(pow(tmax - prediction, 2)) AS mse", "var_pop(tmax) AS v").first()
    assert abs(rmse - row.mse ** 0.5) < 1e-9 and abs(r2 - (1 - row.mse / row.v)) < 1e-9
    assert rmse < 1.5 * row.v ** 0.5
    n, m = train.count(), valid.count()
    assert 0.6 < n / (n + m) < 0.9


def test_f1_is_that_of_the_confusion_counts(spark):
    from kestrel.ml import pipelines
    pairs = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 4 + [(2.0, 1.0)] + [(2.0, 2.0)] * 3
    df = spark.createDataFrame(pairs, "label_index double, prediction double")
    total = 0
    for k in (0.0, 1.0, 2.0):
        hit = sum(a == b == k for a, b in pairs)
        n, said = sum(a == k for a, _ in pairs), sum(b == k for _, b in pairs)
        total += n * 2 * hit / (n + said) / len(pairs)
    assert abs(pipelines.f1_score(df) - total) < 1e-9


def test_rows_without_label_or_feature_do_not_train(spark):
    from kestrel.ml import pipelines
    rows = [(i % 200, (i * 7) % 200, (i * 13) % 200, "dark" if i % 200 < 100 else "light") for i in range(300)]
    df = spark.createDataFrame(rows + [(None, 1, 1, "dark"), (1, 1, 1, None)], "R int, G int, B int, word string")
    kept = pipelines.labelled(df, ["R", "G", "B", "word"])
    assert kept.count() == 300
    model = pipelines.fit_cached(pipelines.mlp_pipeline(["R", "G", "B"], "word", 2, max_iter=60), kept)
    assert list(model.stages[-1].getLayers()) == [3, 30, 2]
    assert pipelines.f1_score(model.transform(kept)) > 0.7
    assert pipelines.bounded(kept, ["R", "G", "B"], 50).count() < 120


def test_split_follows_the_keys(spark):
    from kestrel.ml import pipelines
    df = spark.range(1000)
    a, b = pipelines.split(df.repartition(7), ["id"])
    c, d = pipelines.split(df.coalesce(1), ["id"])
    assert sorted(a.collect()) == sorted(c.collect()) and sorted(b.collect()) == sorted(d.collect())
    assert a.count() + b.count() == 1000 and 700 < a.count() < 800


def test_grid_is_scored_whole(spark):
    """Every grid point comes back with a word, the one that its colour gets when scored directly."""
    from kestrel.ml import pipelines, scoring
    n = len(colour.COLOUR_WORDS)
    data = Q._labelled_colours(spark, SF_SMALL).select("R", "G", "B", "word")
    model = pipelines.fit_cached(pipelines.mlp_pipeline(["R", "G", "B"], "word", n, max_iter=20), data)
    grid = colour.lab_grid(spark, 70.0, 24)
    got = {r.id: (r.R, r.G, r.B, r.predicted) for r in pipelines.grid_predictions(model, grid).collect()}
    assert len(got) == 24 * 24 and {p for *_, p in got.values()} <= set(colour.COLOUR_WORDS)
    known = data.first().word
    direct = model.transform(grid.selectExpr("*", f"'{known}' AS word")).select("id", "prediction").collect()
    labels = model.stages[1].labels
    assert {r.id: labels[int(r.prediction)] for r in direct} == {i: p for i, (*_, p) in got.items()}
    # the same weights as a table
    table = scoring.network_table(model.stages[-1])
    scored = scoring.with_outputs(grid.selectExpr("id", "array(R, G, B) AS v"), "v", table)
    plain = scored.select("id", scoring.best_unit("outputs").alias("k")).collect()
    assert {r.id: labels[r.k] for r in plain} == {i: p for i, (*_, p) in got.items()}


def test_ml_grid_query_returns_every_point(spark):
    out = Q.ml_grid(spark, SF_SMALL)
    assert out.count() == 65_536
    assert {r.predicted for r in out.select("predicted").distinct().collect()} <= set(colour.COLOUR_WORDS)


def test_grid_colours_against_sql(spark):
    import duckdb
    import numpy as np
    m = np.linalg.inv(np.array(colour._XYZ_FROM_RGB))
    inv = "CASE WHEN {0} ** 3 > 0.008856 THEN {0} ** 3 ELSE ({0} - 16.0 / 116) / 7.787 END"
    lin = [" + ".join(f"({float(m[i][k])!r}) * {c}" for k, c in enumerate("xyz")) for i in range(3)]
    out = ", ".join(f"255 * least(greatest(CASE WHEN {e} > 0.0031308 THEN 1.055 * ({e}) ** (1 / 2.4) - 0.055 "
                    f"ELSE 12.92 * ({e}) END, 0), 1)" for e in lin)
    want = duckdb.sql(f"""
        WITH g AS (SELECT id, -100 + (id % 16) * 200.0::DOUBLE / 15 a, -100 + (id // 16) * 200.0::DOUBLE / 15 b
                   FROM range(256) t(id)),
        f AS (SELECT *, 86.0::DOUBLE / 116 + a / 500 fx, 86.0::DOUBLE / 116 fy, 86.0::DOUBLE / 116 - b / 200 fz FROM g),
        x AS (SELECT *, ({inv.format('fx')}) * 0.95047 x, {inv.format('fy')} y, ({inv.format('fz')}) * 1.08883 z FROM f)
        SELECT id, a, b, {out} FROM x ORDER BY id""").fetchall()
    got = colour.lab_grid(spark, 70.0, 16).orderBy("id").collect()
    assert np.allclose(np.array([tuple(r) for r in got], float), np.array(want, float), atol=1e-9)


def test_unseen_labels_count_as_errors(spark):
    from kestrel.ml import pipelines, scoring
    rows = [(i % 200, (i * 7) % 200, (i * 13) % 200, "dark" if i % 200 < 100 else "light") for i in range(200)]
    df = spark.createDataFrame(rows, "R int, G int, B int, word string")
    model = pipelines.fit_cached(pipelines.mlp_pipeline(["R", "G", "B"], "word", 2, max_iter=30), df)
    more = df.unionByName(df.limit(100).selectExpr("R", "G", "B", "'new' AS word"))
    scored = model.transform(more)
    assert scored.count() == 300
    low = pipelines.f1_score(scored)
    assert low < pipelines.f1_score(model.transform(df))
    counts = scoring.confusion(scored, "label_index", "prediction")
    assert abs(scoring.weighted_f1(counts).first().f1 - low) < 1e-9


def test_label_index_is_the_indexers(spark):
    from pyspark.ml.feature import StringIndexer

    from kestrel.ml import scoring
    df = spark.createDataFrame([(w,) for w in ["b", "a", "c", "b", "a", "d", None, "é"]], "w string")
    want = StringIndexer(inputCol="w", outputCol="i", handleInvalid="skip").fit(df).labels
    got = [r.label for r in scoring.label_index(df, "w").orderBy("label_index").collect()]
    assert got == want


def test_forest_from_its_node_table(spark, tmp):
    """Every held-out row: the stored nodes give the loaded model's prediction; importances too."""
    import pytest
    from pyspark.sql import functions as F
    from kestrel.ml import forest, pipelines
    _, _, valid, model = Q._fit_tmax(spark, SF_SMALL)
    model.write().save(tmp + "/m")
    nodes = forest.node_table(spark, tmp + "/m").persist()
    assert nodes.select("tree").distinct().count() == model.stages[-1].getNumTrees
    scored = forest.with_forest(model.transform(valid), pipelines.FEATURES, nodes, "by_table")
    bad = scored.filter(~(F.abs(F.col("by_table") - F.col("prediction")) < 1e-9) | F.col("by_table").isNull())
    assert scored.count() == valid.count() > 0 and bad.count() == 0
    assert forest.node_table(spark, f"{tmp}/m/stages/1_{model.stages[-1].uid}").count() == nodes.count()
    gains = {r.feature: r.importance for r in forest.split_gains(spark, tmp + "/m").collect()}
    want = model.stages[-1].featureImportances
    assert all(abs(gains.get(i, 0.0) - want[i]) < 1e-9 for i in range(len(pipelines.FEATURES)))
    with pytest.raises(ValueError, match="no forest"):
        forest.node_table(spark, tmp)


def test_forest_walk_by_hand(spark, monkeypatch):
    """Thresholds, NaN, nulls, a tree of one leaf, clashing columns, damaged tables."""
    import pytest
    from kestrel.ml import forest
    nodes = [(0, 0, 0, 1.5, 1, 2, 0.0), (0, 1, None, None, None, None, 10.0), (0, 2, 1, 0.0, 3, 4, 0.0),
             (0, 3, None, None, None, None, 20.0), (0, 4, None, None, None, None, 30.0),
             (1, 0, None, None, None, None, 2.0)]
    table = spark.createDataFrame(nodes, forest.NODE_SCHEMA)
    df = spark.createDataFrame([(1.5, 9.0), (1.6, 0.0), (1.6, 0.1), (float("nan"), 0.0), (None, 0.0)],
                               "a double, node double")
    got = [r.p for r in forest.with_forest(df, ["a", "node"], table, "p").collect()]
    assert got == [6.0, 11.0, 16.0, 11.0, None]
    assert [r.p for r in forest.with_forest(df.limit(1), ["a", "node"], table.filter("tree = 1"), "p").collect()] == [2.0]
    with pytest.raises(ValueError, match="already"):
        forest.with_forest(df, ["a", "node"], table, "a")
    with pytest.raises(ValueError, match="numbered"):
        forest.with_forest(df, ["a", "node"], table.filter("node <> 1"), "p")
    with pytest.raises(ValueError, match="without trees"):
        forest.with_forest(df, ["a", "node"], table.limit(0), "p")
    monkeypatch.setattr(forest, "MAX_NODES", 5)
    with pytest.raises(ValueError, match="more than 5"):
        forest.with_forest(df, ["a", "node"], table, "p")


def test_colour_words_are_made_once_and_fits_are_dealt(spark, monkeypatch):
    """However many passes a fit and its scores take, a row's word is computed once, and the training rows of a
    one-split input lie in a task per ROWS_PER_TASK rows, each row once."""
    from functools import partial

    from pyspark.sql import functions as F

    from kestrel.ml import pipelines
    made, dealt, fit, n = spark.sparkContext.accumulator(0), [], pipelines.fit_cached, 45_000

    def word(r):
        made.add(1)
        return None if r == 7 else ("red", "green", "blue")[r % 3]

    def seen(pipeline, train):
        dealt.append(train.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
        return fit(pipeline, train)

    monkeypatch.setattr(pipelines, "mlp_pipeline", partial(pipelines.mlp_pipeline, max_iter=2))
    monkeypatch.setattr(pipelines, "fit_cached", seen)
    colours = spark.range(0, n, 1, 1).selectExpr(*[f"CAST(id * {k} % 256 AS INT) AS {c}" for c, k in (("R", 1), ("G", 3), ("B", 7))]) \
        .withColumn("word", F.udf(word, "string")("R"))
    assert [r.model for r in pipelines.colour_models(colours).collect()] == ["rgb", "lab"]
    assert made.value == n
    rows = pipelines.split(pipelines.labelled(colours, ["R", "G", "B", "word"]), ["R", "G", "B", "word"])[0].count()
    assert [sum(x) for x in dealt] == [rows, rows]
    assert all(len(x) == -(-rows // pipelines.ROWS_PER_TASK) > 1 and max(x) - min(x) <= 1 for x in dealt)
    # the grid's model takes the same steps
    before = made.value
    monkeypatch.setattr(Q, "_labelled_colours", lambda *_: colours)
    assert Q.ml_grid(spark, SF_SMALL).count() == 65_536 and made.value == before + n
    assert len(dealt[2]) == 3 and sum(dealt[2]) == sum(i % 256 != 7 for i in range(n))


def test_few_training_rows_stay_where_they_are(spark):
    from kestrel.ml import pipelines

    class Parts:
        def fit(self, df):
            return df.rdd.glom().map(len).collect()

    one, four = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, 4)
    assert pipelines.fit_dealt(Parts(), one, 100) == [100] and pipelines.fit_dealt(Parts(), four, 100) == [25] * 4
    assert sorted(pipelines.fit_dealt(Parts(), one, 30)) == [25] * 4
    assert pipelines.fit_dealt(Parts(), one.limit(0), 30) == [] or sum(pipelines.fit_dealt(Parts(), one.limit(0), 30)) == 0


def test_colour_models_fit_every_training_row(spark, monkeypatch):
    """More training rows than MAX_TRAIN_ROWS: both fits get all of them, each once."""
    from functools import partial

    from kestrel.ml import pipelines
    seen, fit, columns = [], pipelines.fit_cached, ["R", "G", "B", "word"]

    def counted(pipeline, train):
        seen.append((train.count(), train.distinct().count()))
        return fit(pipeline, train)

    monkeypatch.setattr(pipelines, "mlp_pipeline", partial(pipelines.mlp_pipeline, max_iter=1))
    monkeypatch.setattr(pipelines, "fit_cached", counted)
    colours = spark.range(0, pipelines.MAX_TRAIN_ROWS * 3 // 2, 1, 4).selectExpr(
        "CAST(id % 256 AS INT) AS R", "CAST(id DIV 256 % 256 AS INT) AS G", "CAST(id DIV 65536 AS INT) AS B",
        "CASE WHEN id % 1000 <> 7 THEN element_at(array('red', 'green', 'blue'), CAST(id % 3 + 1 AS INT)) END AS word")
    assert [r.model for r in pipelines.colour_models(colours).collect()] == ["rgb", "lab"]
    rows = pipelines.split(pipelines.labelled(colours, columns), columns)[0].count()
    assert rows > pipelines.MAX_TRAIN_ROWS and seen == [(rows, rows)] * 2
