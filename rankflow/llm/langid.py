"""Language identification (operator 5): averaged subword embeddings, linear softmax,
calibrated rejection.

A part of the sample (every ``calibrate_every``-th document) is kept from training; on
it the softmax's temperature is fitted and the probability under which predictions are
rejected is set so that at most ``reject_share`` of the right ones are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm import subword
from rankflow.llm.common import doc_crc32

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageSpec:
    """``per_class`` in ``features`` bounds the labelled documents of each language that are used."""

    features: subword.SubwordSpec = subword.SubwordSpec(sizes=(1, 2, 3), buckets=1 << 15, dim=12, epochs=6, rate=0.5, per_class=600)
    folds: int = 4
    held_out_fold: int = 2
    calibrate_every: int = 5
    reject_share: float = 0.01


def held_out(spec: LanguageSpec = LanguageSpec()):
    return F.pmod(doc_crc32(), F.lit(spec.folds)) == spec.held_out_fold


def train(docs: DataFrame, spec: LanguageSpec = LanguageSpec()) -> subword.SubwordModel | None:
    """The model from texts and non-null ``lang`` outside the held-out fold; None without any."""
    usable = F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(spec)
    bags, labels, _, counts = subword.sampled_bags(docs, F.col("lang"), usable, spec.features)
    classes = sorted(counts)
    if not classes:
        return None
    y = [classes.index(x) for x in labels]
    check = [i for i in range(len(y)) if i % spec.calibrate_every == spec.calibrate_every - 1]
    fitted = sorted(set(range(len(y))) - set(check))
    # Sources of errors are short texts, where shares of languages would decide: classes count alike.
    model = subword.fit([bags[i] for i in fitted], [y[i] for i in fitted], classes, spec.features)
    if check:
        z = np.array([model.bias + (w @ model.table[ids] if len(ids) else 0.0) for ids, w in (bags[i] for i in check)])
        truth = np.array([y[i] for i in check])
        model.temperature = subword.temperature(z, truth)
        p = subword._softmax(z / model.temperature)
        right = p.max(1)[p.argmax(1) == truth]
        if len(right):
            model.reject_below = float(np.quantile(right, spec.reject_share))
    return model


def identify(docs: DataFrame, model: subword.SubwordModel | None, spec: LanguageSpec = LanguageSpec()) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (the prediction's probability), accepted.

    ``lang_pred`` is always a learned value but for a null text or one without a letter,
    which is ``und`` with score 0, and for a table without labels, where all is ``und``.
    ``accepted`` is false for ``und`` and below the calibrated probability.  Prediction
    looks at the text alone.
    """
    spark, id_kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)  # buckets x classes numbers

    def run(batches):
        m = shared.value
        for batch in batches:
            for part, p, _, letters in (subword.score_batches(batch, m) if m else ((batch, None, None, None),)):
                n = part.num_rows
                if m:
                    best = p.argmax(1)
                    langs = [m.classes[k] if ok else UNDETERMINED for k, ok in zip(best, letters)]
                    score = np.where(letters, p[np.arange(n), best], 0.0)
                    accepted = letters.astype(bool) & (score >= m.reject_below)
                else:
                    langs, score, accepted = [UNDETERMINED] * n, np.zeros(n), np.zeros(n, bool)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(accepted)],
                    names=["doc_id", "held_out", "lang_pred", "score", "accepted"])

    return docs.select(F.coalesce("text", F.lit("")).alias("text"), "doc_id", held_out(spec).alias("held_out")).mapInArrow(
        run, f"doc_id {id_kind}, held_out boolean, lang_pred string, score double, accepted boolean")
