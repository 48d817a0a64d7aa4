"""Model operators: random forest per category, splits, prediction, metrics
(m06-m11, m17).

Metrics come from one ``groupBy(label, prediction).count()`` table per model,
from which accuracy, weighted precision and weighted recall all derive, instead
of one evaluator pass per metric.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def forest(features: str = "features", label: str = "recommend", seed: int = 42,
           **params) -> RandomForestClassifier:
    """m06: the classifier (one is fitted per category)."""
    return RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed, **params)


def fit(stages: Sequence, train: DataFrame) -> PipelineModel:
    """m06: fit a stage list on the training rows only (no leakage from test)."""
    return Pipeline(stages=list(stages)).fit(train)


def split_random(df: DataFrame, train_fraction: float = 0.7, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """m07: seeded random split (as the reference)."""
    train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return train, test


def hash_bucket(key: Column | str, buckets: int = 100) -> Column:
    """m07: stable bucket of a key from its MD5 (first 32 bits)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def split_hash(df: DataFrame, key: str, train_fraction: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """m07: deterministic split on the key hash, stable under repartitioning and retries."""
    cut = int(round(train_fraction * 100))
    b = hash_bucket(key)
    return df.filter(b < cut), df.filter(b >= cut)


def predict(model: PipelineModel, df: DataFrame, out: str = "predicted_recommend") -> DataFrame:
    """m08: apply the model; the prediction is also exposed under ``out``."""
    return model.transform(df).withColumn(out, F.col("prediction"))


def metrics(pred: DataFrame, label: str = "recommend", prediction: str = "prediction",
            digits: int | None = 6, keys: Sequence[str] = ()) -> DataFrame:
    """m09/m10: accuracy, weighted precision and weighted recall in one pass,
    per group of ``keys`` (one row per group; a single row when no keys).

    Weighted over the label classes present, precision 0 for a class that is
    never predicted (MulticlassMetrics semantics).  All work after the first
    aggregate is on the (groups x classes^2) cell table.
    """
    keys = list(keys)
    cells = pred.groupBy(*keys, F.col(label).cast("double").alias("_y"),
                         F.col(prediction).cast("double").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    by_label = cells.groupBy(*keys, "_y").agg(
        F.sum("_n").alias("n_c"),
        F.sum(F.when(F.col("_y") == F.col("_p"), F.col("_n")).otherwise(0)).alias("tp_c"))
    by_pred = cells.groupBy(*keys, F.col("_p").alias("_y")).agg(F.sum("_n").alias("p_c"))
    per = by_label.join(by_pred, [*keys, "_y"], "left")
    total = F.sum("n_c").cast("double")
    prec = F.coalesce(F.try_divide(F.col("tp_c").cast("double"), F.col("p_c").cast("double")), F.lit(0.0))
    recall = F.try_divide(F.col("tp_c").cast("double"), F.col("n_c").cast("double"))
    out = per.groupBy(*keys).agg(
        (F.sum("tp_c") / total).alias("accuracy"),
        (F.sum(F.col("n_c") * prec) / total).alias("weighted_precision"),
        (F.sum(F.col("n_c") * recall) / total).alias("weighted_recall"),
    )
    if digits is not None:
        out = out.select(*keys, *[F.round(c, digits).alias(c) for c in
                                  ("accuracy", "weighted_precision", "weighted_recall")])
    return out


def metric_rows(pred: DataFrame, label: str = "recommend", prediction: str = "prediction",
                keys: Sequence[str] = ()) -> DataFrame:
    """m11: metrics as long rows ``(keys..., metric, value)`` for a report table."""
    wide = metrics(pred, label, prediction, keys=keys)
    names = ("accuracy", "weighted_precision", "weighted_recall")
    long = wide.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names])).alias("_m"))
    return long.select(*keys, "_m.metric", "_m.value")


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names of the assembled vector slots, from the column's ML attribute metadata."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    names: dict[int, str] = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a.get("name", f"f{a['idx']}")
    size = meta.get("num_attrs", len(names))
    return [names.get(i, f"f{i}") for i in range(size)]


def feature_importance(model, transformed: DataFrame, features: str = "features") -> DataFrame:
    """m17: (feature, importance) table from a fitted forest and its feature metadata.

    The vector has one slot per feature (model metadata, not data), so building
    the small table on the driver is bounded by the feature count.
    """
    rf = model.stages[-1] if isinstance(model, PipelineModel) else model
    imp = rf.featureImportances.toArray().tolist()
    names = feature_names(transformed, features)
    names += [f"f{i}" for i in range(len(names), len(imp))]
    spark = transformed.sparkSession
    return spark.createDataFrame(list(zip(names, [float(x) for x in imp])), "feature string, importance double")
