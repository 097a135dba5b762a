"""Training and evaluation of tree classifiers on labelled cycle features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigwatch.operators.features import feature_columns

TREES = 20
TRAIN_PERCENT = 80
SEED = 42


def split_bucket(seed: int = SEED, key: str = "cycle"):
    """0..99 from a hash of the cycle: the split does not depend on row layout."""
    text = F.concat_ws(":", F.lit(seed), F.col(key))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % 100).cast("int")


def split(data: DataFrame, train_percent: int = TRAIN_PERCENT, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    bucket = split_bucket(seed)
    return data.filter(bucket < train_percent), data.filter(bucket >= train_percent)


def preparation(data: DataFrame, target: str = "label_cooler", columns: Sequence[str] | None = None) -> PipelineModel:
    """Fitted target index (most frequent code first) and feature assembly."""
    columns = list(columns or feature_columns(data))
    return Pipeline(stages=[
        StringIndexer(inputCol=target, outputCol=f"{target}_indexed", stringOrderType="frequencyDesc"),
        VectorAssembler(inputCols=columns, outputCol="features"),
    ]).fit(data)


def classifiers(target: str = "label_cooler", seed: int = SEED, offered: str = "auto") -> dict:
    """``offered``: features that each split of the forest may choose from, as Spark names it."""
    common = {"labelCol": f"{target}_indexed", "featuresCol": "features", "seed": seed}
    return {
        "RandomForest": RandomForestClassifier(numTrees=TREES, featureSubsetStrategy=offered, **common),
        "DecisionTree": DecisionTreeClassifier(**common),
    }


def evaluate(predictions: DataFrame, target: str = "label_cooler") -> DataFrame:
    """Accuracy and support-weighted precision, recall and f1 in one pass.

    The confusion counts (classes squared) are formed map-side; everything
    after works on them.
    """
    label = F.col(f"{target}_indexed")
    cells = predictions.groupBy(label.alias("label"), "prediction").agg(F.count(F.lit(1)).alias("n"))
    # One side of every cell is its true class, the other its predicted class.
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("actual"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hits")))))
    classes = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("actual") > 0, F.col("hits") / F.col("actual")).otherwise(0.0)
    scored = classes.withColumns({"p": precision, "r": recall}).withColumn(
        "f", F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0))
    total = F.sum("actual")
    wide = scored.agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(F.col("p") * F.col("actual")) / total).alias("weightedPrecision"),
        (F.sum(F.col("r") * F.col("actual")) / total).alias("weightedRecall"),
        (F.sum(F.col("f") * F.col("actual")) / total).alias("f1"))
    names = ["accuracy", "weightedPrecision", "weightedRecall", "f1"]
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("score")) for n in names])))


def importances(spark: SparkSession, model, columns: Sequence[str]) -> DataFrame:
    """Importance per feature, highest first (as many rows as features)."""
    values = [(name, float(v)) for name, v in zip(columns, model.featureImportances.toArray())]
    return spark.createDataFrame(values, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature")


def train(data: DataFrame, target: str = "label_cooler", seed: int = SEED, offered: str = "auto") -> tuple[dict, DataFrame, DataFrame]:
    """Train every classifier on one split.

    Returns the models, the metrics and the importances. ``data`` is used by
    several passes: hand in a written table, not a long plan.
    """
    spark = data.sparkSession
    columns = feature_columns(data)
    ready = preparation(data, target, columns).transform(data).select("cycle", f"{target}_indexed", "features")
    train_rows, test_rows = split(ready, seed=seed)
    train_rows = train_rows.cache()
    models, metrics, weights = {}, [], []
    for name, classifier in classifiers(target, seed, offered).items():
        model = classifier.fit(train_rows)
        models[name] = model
        metrics.append(evaluate(model.transform(test_rows), target).select(F.lit(name).alias("model"), "*"))
        weights.append(importances(spark, model, columns).select(F.lit(name).alias("model"), "*"))
    train_rows.unpersist()
    return models, reduce(DataFrame.unionByName, metrics), reduce(DataFrame.unionByName, weights)


def save_run(models: dict, metrics: DataFrame, weights: DataFrame, params: dict, path: str) -> None:
    """Record a training run: parameters, metrics, importances and the models."""
    spark = metrics.sparkSession
    rows = [(str(k), str(v)) for k, v in params.items()]
    spark.createDataFrame(rows, "name string, value string").write.mode("overwrite").parquet(f"{path}/params")
    metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    weights.write.mode("overwrite").parquet(f"{path}/importances")
    for name, model in models.items():
        model.write().overwrite().save(f"{path}/models/{name}")
