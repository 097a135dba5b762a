import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from rigwatch.operators import features, training
from rigwatch.schemas import SENSOR_NAMES


@pytest.fixture(scope="module")
def data(spark):
    """Cycles whose PS1 mean tells the cooler condition."""
    base = spark.range(400).select(F.col("id").cast("int").alias("cycle"), (F.col("id") % 3).alias("k"))
    columns = [(F.rand(n) + (F.col("k") * 5 if s == "PS1" else 0)).alias(f"{s}_{kind}")
               for n, (s, kind) in enumerate((s, kind) for s in SENSOR_NAMES for kind in ("mean", "std"))]
    code = F.element_at(F.array(F.lit(3), F.lit(20), F.lit(100)), (F.col("k") + 1).cast("int"))
    return base.select("cycle", *columns, code.alias("label_cooler"),
                       *[F.lit(0).alias(n) for n in ("label_valve", "label_pump", "label_accumulator", "label_stable")])


def test_feature_columns_leave_out_leakage(data):
    columns = features.feature_columns(data)
    assert len(columns) == 30
    assert not any(c.startswith(("CE_", "CP_", "label_", "cycle")) for c in columns)


def test_split_is_disjoint_and_layout_free(data):
    train, test = training.split(data)
    again, _ = training.split(data.repartition(13).orderBy("PS1_mean"))
    a = {r.cycle for r in train.select("cycle").collect()}
    assert a == {r.cycle for r in again.select("cycle").collect()}
    assert a.isdisjoint({r.cycle for r in test.select("cycle").collect()})
    assert 0.7 < len(a) / 400 < 0.9


def test_metrics_equal_the_evaluator(spark):
    rows = [(float(a), float(p)) for a, p in [(0, 0)] * 50 + [(0, 1)] * 9 + [(1, 1)] * 20 + [(1, 2)] * 3 + [(2, 0)] * 8 + [(3, 1)] * 2]
    df = spark.createDataFrame(rows, "label_cooler_indexed double, prediction double")
    got = {r.metric: r.score for r in training.evaluate(df).collect()}
    for name, score in got.items():
        judge = MulticlassClassificationEvaluator(labelCol="label_cooler_indexed", predictionCol="prediction", metricName=name)
        assert score == pytest.approx(judge.evaluate(df)), name
    assert set(got) == {"accuracy", "weightedPrecision", "weightedRecall", "f1"}


def test_training_finds_the_signal_and_is_reproducible(spark, data, out):
    models, metrics, weights = training.train(data)
    score = {(r.model, r.metric): r.score for r in metrics.collect()}
    assert score["RandomForest", "accuracy"] > 0.9 and score["DecisionTree", "accuracy"] > 0.9
    top = weights.filter("model = 'DecisionTree'").orderBy(F.desc("importance")).first()
    assert top.feature in ("PS1_mean", "PS1_std")
    assert models["RandomForest"].getNumTrees == 20 and models["RandomForest"].numFeatures == 30
    _, again, _ = training.train(data)
    assert sorted(metrics.collect()) == sorted(again.collect())
    training.save_run(models, metrics, weights, {"model_type": "trees", "seed": 42}, out)
    assert spark.read.parquet(out + "/metrics").count() == 8
    assert spark.read.parquet(out + "/importances").count() == 60
    assert RandomForestClassificationModel.load(out + "/models/RandomForest").numClasses == 3


def test_other_targets(data):
    models, metrics, _ = training.train(data.withColumn("label_pump", F.col("cycle") % 2), target="label_pump")
    assert metrics.count() == 8 and set(models) == {"RandomForest", "DecisionTree"}


def test_signal_is_found_among_features_that_go_along_with_it(spark, monkeypatch):
    from rigwatch.plans import cycles

    base = spark.range(400).select(F.col("id").cast("int").alias("cycle"), (F.col("id") % 20 * 5.0).alias("x"))
    columns = [F.col("x").alias("PS1_mean")] + [(F.col("x") + F.rand(n) * 6 - 3).alias(c) for n, c in enumerate(cycles.FEATURES) if c != "PS1_mean"]
    table = base.select("cycle", *columns, *[F.lit(0).alias(n) for n in ("label_cooler", "label_valve", "label_pump", "label_accumulator", "label_stable")])
    monkeypatch.setattr(cycles, "training_table", lambda spark, sf: table)
    weights, train = [], training.train
    monkeypatch.setattr(training, "train", lambda *a, **k: [out := train(*a, **k), weights.append(out[2])][0])
    rows = sorted(tuple(r) for r in cycles.train_signal(spark, "").collect())
    assert all(r.importance > 0.5 for r in weights[0].where("feature = 'PS1_mean'").collect())
    assert rows == [(m, 400, 200, "PS1_mean", True, True) for m in ("DecisionTree", "RandomForest")]


def test_fill_and_missing_flags(spark):
    wide = spark.createDataFrame([(1, 2.0, None), (2, None, None)], "cycle int, PS1_mean double, PS1_std double")
    labels = spark.createDataFrame([(1, 3), (3, 20)], "cycle int, label_cooler int")
    assert [tuple(r) for r in features.join_labels(wide, labels, fill=True).collect()] == [(1, 2.0, 0.0, 3)]
    left = features.join_labels(wide, labels, "left").orderBy("cycle").collect()
    assert [(r.cycle, r.label_cooler) for r in left] == [(1, 3), (2, None)]
    flags = features.missing_flags(wide, ["PS1"]).orderBy("cycle").collect()
    assert [r.PS1_missing for r in flags] == [0, 1]


def test_duplicate_labels_do_not_multiply(spark):
    labels = spark.createDataFrame([(1, 3, 1.0), (1, 20, 2.0), (2, 100, 1.0)], "cycle int, label_cooler int, timestamp double")
    assert sorted(tuple(r) for r in features.newest_labels(labels).collect()) == [(1, 20, 2.0), (2, 100, 1.0)]


def test_train_job_reads_the_archives(spark, out, capsys):
    from rigwatch.__main__ import main
    from rigwatch.plans import inputs

    sf = "/root/testdata/sf0.01"
    inputs.readings(spark, sf).write.partitionBy("sensor").parquet(out + "/archive/raw")
    inputs.labels(spark, sf).withColumn("timestamp", F.lit(1.0)).write.parquet(out + "/archive/labels")
    main(["train", "--archive", out + "/absent", out + "/archive", "--out", out + "/run"])
    assert spark.read.parquet(out + "/run/labelled").count() == 150
    assert spark.read.parquet(out + "/run/metrics").count() == 8
    assert "accuracy" in capsys.readouterr().out
