"""Toxicity (operator 10): bags of subword embeddings averaged into a linear softmax.

A misspelled word shares character n-grams, and so vectors, with the words seen in
training.  Within a text a word counts with its number to the power ``squash``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm import subword
from rankflow.llm.common import doc_crc32


@dataclass(frozen=True)
class ToxicitySpec:
    """``per_class`` in ``features`` bounds the labelled documents of each label that are used."""

    features: subword.SubwordSpec = subword.SubwordSpec(
        sizes=(2, 3, 4), buckets=1 << 17, dim=16, epochs=12, rate=1.8, squash=0.7, per_class=3000)
    folds: int = 5
    held_out_fold: int = 0
    threshold: float = 0.5


def held_out(spec: ToxicitySpec = ToxicitySpec()):
    return F.pmod(doc_crc32(), F.lit(spec.folds)) == spec.held_out_fold


def train(docs: DataFrame, labels: DataFrame, spec: ToxicitySpec = ToxicitySpec()) -> subword.SubwordModel | None:
    """The model from the texts whose ``labels.toxic`` is 0 or 1 outside the held-out fold; None
    without both labels.  A doc_id labelled more than once has its greatest label."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    usable = F.col("text").isNotNull() & ~held_out(spec)
    bags, y, _, counts = subword.sampled_bags(docs, F.col("toxic"), usable, spec.features, known)
    if sorted(counts) != [0, 1]:
        return None
    priors = np.array([counts[0], counts[1]], float)
    model = subword.fit(bags, y, [0, 1], spec.features, priors / priors.sum())
    del bags
    pa.default_memory_pool().release_unused()  # the driver keeps the model alone
    return model


def score(docs: DataFrame, model: subword.SubwordModel | None, spec: ToxicitySpec = ToxicitySpec()) -> DataFrame:
    """Per row: doc_id, held_out, score (probability of label 1), predicted (1 from the threshold on).

    A null, empty or wordless text has the score of the bias alone; without a model all
    scores are 0.  Scoring looks at the text alone.
    """
    spark, id_kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)  # buckets x 2 numbers
    threshold = spec.threshold

    def run(batches):
        m = shared.value
        for batch in batches:
            for part, p, _, _ in (subword.score_batches(batch, m) if m else ((batch, None, None, None),)):
                s = p[:, 1] if m else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.coalesce("text", F.lit("")).alias("text"), "doc_id", held_out(spec).alias("held_out")).mapInArrow(
        run, f"doc_id {id_kind}, held_out boolean, score double, predicted int")


def clean_documents(docs: DataFrame, labels: DataFrame, spec: ToxicitySpec = ToxicitySpec()) -> DataFrame:
    """``docs`` without the rows whose texts the model rejects; all columns unchanged."""
    model = train(docs, labels, spec)
    spark, names = docs.sparkSession, docs.columns
    shared, threshold, at = spark.sparkContext.broadcast(model), spec.threshold, docs.columns.index("text")

    def run(batches):
        m = shared.value
        for batch in batches:
            if m is None:
                yield batch
                continue
            text = batch.column(at).fill_null("")
            probe = pa.RecordBatch.from_arrays([text, pa.array(np.arange(batch.num_rows))], names=["text", "row"])
            keep = np.concatenate([p[:, 1] < threshold for _, p, _, _ in subword.score_batches(probe, m)] or [np.zeros(0, bool)])
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema).select(*names)
