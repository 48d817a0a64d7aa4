"""Averaged hashed subword embeddings with a linear softmax, trained in numpy.

A text is a bag of words; a word is the bag of its character n-grams (as UTF-8 bytes,
with marks at both ends) and itself, each hashed into a fixed number of buckets.  A
bucket has an embedding; a text's vector is the mean over its words of the mean over
their buckets; a linear softmax on it gives the classes.  Embeddings and softmax are
trained together by stochastic gradient descent, a document at a time, with steps
scaled by each bucket's past gradients, so that rare n-grams learn as fast as common
ones.  Features are made in tasks; only a bounded sample of labelled documents
reaches the trainer.  Since everything before the softmax is linear, scoring needs one
number a class for every bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import ALNUM, STEP_BYTES, mix64, span_hashes, steps, text_bytes, word_spans

_B = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class SubwordSpec:
    """Features and training.  ``per_class``: labelled documents of each class that are used at most,
    those with the least hash of their id.  ``labels``: the most frequent labels that are learned.  ``squash``: power of a word's count within a text
    (1: the plain mean over words, 0: the mean over distinct words)."""

    sizes: tuple[int, ...] = (2, 3, 4)
    buckets: int = 1 << 16
    dim: int = 16
    epochs: int = 12
    rate: float = 0.5
    decay: float = 1e-6
    per_class: int = 2000
    labels: int = 200
    squash: float = 1.0
    seed: int = 17


@dataclass
class SubwordModel:
    spec: SubwordSpec
    classes: list
    #: Logits of each bucket (buckets x classes) and the bias; temperature of the softmax.
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    #: Probability under which a prediction is rejected.
    reject_below: float = 0.0
    extra: dict = field(default_factory=dict)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, start and end of each distinct lower-case word, and per word of the texts its
    distinct word and its text."""
    data, off = text_bytes(pc.utf8_lower(texts))
    s, e, per = word_spans(data, off, ALNUM)
    h = span_hashes(data, s, e)
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    return data, s[first], e[first], which, np.repeat(np.arange(len(per)), per)


def subwords(data: np.ndarray, s: np.ndarray, e: np.ndarray, spec: SubwordSpec) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, word after word, and how many each word has (at least one)."""
    n = len(s)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length = e - s + 2
    base = np.cumsum(length) - length
    total = int(length.sum())
    cell = np.zeros(total, np.uint64)
    owner = np.repeat(np.arange(n), length)
    inside = np.arange(total) - np.repeat(base, length)
    real = (inside > 0) & (inside < np.repeat(length, length) - 1)
    cell[real] = data[(np.repeat(s, length) + inside - 1)[real]].astype(np.uint64) + np.uint64(3)
    cell[base], cell[base + length - 1] = 1, 2
    left = np.repeat(length, length) - inside
    keys, owners = [span_hashes(data, s, e) ^ np.uint64(0xABCDEF)], [np.arange(n)]
    for size in spec.sizes:
        at = np.flatnonzero(left >= size)
        h = np.zeros(len(at), np.uint64)
        for j in range(size):
            h = h * _B + cell[at + j]
        keys.append(mix64(h + np.uint64(size)))
        owners.append(owner[at])
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return (keys[order] % np.uint64(spec.buckets)).astype(np.int64), np.bincount(owners, minlength=n)


def bags(texts: pa.Array, spec: SubwordSpec) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct buckets and their weights, adding up to 1 (empty without words)."""
    data, s, e, which, text = words(texts)
    grams, per = subwords(data, s, e, spec)
    base = np.cumsum(per) - per
    out = []
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        own, count = np.unique(which[a:b], return_counts=True)
        if not len(own):
            out.append((np.zeros(0, np.int32), np.zeros(0, np.float32)))
            continue
        weight = count.astype(np.float64) ** spec.squash
        weight /= weight.sum()
        n = per[own]
        cells = np.repeat(base[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        ids, back = np.unique(grams[cells], return_inverse=True)
        out.append((ids.astype(np.int32), np.bincount(back, np.repeat(weight / n, n)).astype(np.float32)))
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(-1, keepdims=True))
    return z / z.sum(-1, keepdims=True)


def fit(samples: Sequence[tuple[np.ndarray, np.ndarray]], labels: list[int], classes: list, spec: SubwordSpec,
        priors: np.ndarray | None = None) -> SubwordModel:
    """Train on the bags; ``priors`` are the classes' shares among all labelled rows, for
    a bias that undoes an uneven sample.  The same samples give the same model."""
    rng = np.random.default_rng(spec.seed)
    k = len(classes)
    v = (rng.random((spec.buckets, spec.dim), dtype=np.float32) - 0.5) / spec.dim
    w = (rng.random((k, spec.dim), dtype=np.float32) - 0.5)
    b = np.zeros(k, np.float32)
    past_v, past_w, past_b = np.full(spec.buckets, 1e-8, np.float32), np.full((k, spec.dim), 1e-4, np.float32), np.full(k, 1e-2, np.float32)
    for epoch in range(spec.epochs):
        rate = spec.rate * (1 - epoch / spec.epochs)
        for i in rng.permutation(len(samples)):
            ids, weight = samples[i]
            if not len(ids):
                continue
            rows = v[ids]
            x = weight @ rows
            g = _softmax(w @ x + b)
            g[labels[i]] -= 1
            gx = g @ w
            gw = np.outer(g, x)
            past_w += gw * gw
            past_b += g * g
            past = past_v[ids] + (weight * weight) * float(gx @ gx)
            past_v[ids] = past
            v[ids] = rows * (1 - rate * spec.decay) - (rate * weight / np.sqrt(past))[:, None] * gx
            w -= 0.1 * rate * gw / np.sqrt(past_w)
            b -= 0.1 * rate * g / np.sqrt(past_b)
    table, bias = (v @ w.T).astype(np.float64), b.astype(np.float64)
    if priors is not None and len(labels):
        share = np.bincount(labels, minlength=k) / len(labels)
        bias = bias + np.log(np.maximum(priors, 1e-12)) - np.log(np.maximum(share, 1e-12))
    return SubwordModel(spec, classes, table, bias)


def logits(texts: pa.Array, model: SubwordModel) -> tuple[np.ndarray, np.ndarray]:
    """Logits (texts x classes) before the temperature, and the number of words of each text."""
    spec, n, k = model.spec, len(texts), len(model.classes)
    data, s, e, which, text = words(texts)
    n_words = np.bincount(text, minlength=n)
    out = np.tile(model.bias, (n, 1))
    if not len(s):
        return out, n_words
    grams, per = subwords(data, s, e, spec)
    base = np.cumsum(per) - per
    if spec.squash == 1.0:
        weight, own, doc = 1.0 / n_words[text], which, text
    else:  # count each word once a text, to the power
        key, count = np.unique(text * np.int64(len(s)) + which, return_counts=True)
        own, doc = key % len(s), key // len(s)
        weight = count.astype(np.float64) ** spec.squash
        weight /= np.bincount(doc, weight, minlength=n)[doc]
    for j in range(k):
        word = np.add.reduceat(model.table[grams, j], base) / per
        out[:, j] += np.bincount(doc, word[own] * weight, minlength=n)
    return out, n_words


def temperature(all_logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature (of a fixed grid) that makes the labels likeliest."""
    if not len(labels):
        return 1.0
    best = min((-np.log(np.maximum(_softmax(all_logits / t)[np.arange(len(labels)), labels], 1e-12)).mean(), t)
               for t in np.exp(np.linspace(-1.5, 2.0, 36)))
    return float(best[1])


def sampled_bags(docs: DataFrame, label: Column, usable: Column, spec: SubwordSpec, known: DataFrame | None = None) -> tuple[Sequence, list, list, dict]:
    """Bags and labels of at most ``per_class`` usable documents of each label, in a fixed
    order, and the labels' counts among all usable rows.

    ``label`` is a column of ``docs``, or of ``known``, which is met by doc_id.  The sample is chosen
    by (hash of the id, id) from ids alone; texts meet only the ids chosen and become bags
    in tasks, so the driver gets at most ``per_class`` bags of each of ``labels`` labels, of at
    most ``buckets`` entries each, compressed, and opens one at a time.
    """
    h = F.xxhash64(F.lit(spec.seed), "doc_id").alias("h")
    ids, own = docs.where(usable), ["doc_id", "text"]
    if known is None:
        rows, own = ids.select("doc_id", label.alias("label"), h), [*own, label.alias("label")]
    else:
        rows = ids.select("doc_id").join(known.select("doc_id", label.alias("label")), "doc_id").select("doc_id", "label", h)
    most = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(spec.labels)
    counts = {r["label"]: r["count"] for r in most.collect()}
    if not counts:
        return [], [], [], counts
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h", "doc_id"))
    chosen = rows.where(F.col("label").isin(list(counts))).withColumn("rank", rank).where(F.col("rank") <= spec.per_class)
    chosen = F.broadcast(chosen.select("doc_id", "label", "h").distinct())  # per_class ids of each of labels labels
    own = ids.select(*own).join(chosen, ["doc_id", "label"] if known is None else "doc_id")

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in steps(batch, 0):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array([_packed(bag, press) for bag in bags(part.column(0), spec)], pa.binary())],
                    names=["label", "h", "doc_id", "bag"])

    kind, id_kind = rows.schema["label"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    made = own.select(F.coalesce("text", F.lit("")).alias("text"), "label", "h", "doc_id").mapInArrow(
        run, f"label {kind}, h long, doc_id {id_kind}, bag binary").toArrow()
    got = sorted(zip(made["h"].to_pylist(), made["doc_id"].to_pylist(), made["label"].to_pylist(), range(made.num_rows)),
                 key=lambda r: (r[0], r[1], str(r[2])))
    return PackedBags(made["bag"], [r[3] for r in got]), [r[2] for r in got], [r[0] for r in got], counts


def _packed(bag: tuple[np.ndarray, np.ndarray], press: zstandard.ZstdCompressor) -> bytes:
    """A bag without loss: steps between its ascending buckets and its weights, equal bytes of all
    numbers side by side, compressed."""
    ids, weights = bag
    both = np.concatenate([np.diff(ids, prepend=0).astype(np.int32).view(np.uint8), weights.view(np.uint8)])
    return press.compress(both.reshape(-1, 4).T.tobytes())


class PackedBags(Sequence):
    """The bags of a binary column in a given order, each opened when it is asked for."""

    def __init__(self, column: pa.ChunkedArray, order: list[int]) -> None:
        self._column, self._order, self._open = column, order, zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self._order)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        raw = self._open.decompress(self._column[self._order[i]].as_buffer())
        both = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).reshape(-1)
        half = len(both) // 2
        return np.cumsum(both[:half].view(np.int32), dtype=np.int32), both[half:].view(np.float32)


def score_batches(batch: pa.RecordBatch, model: SubwordModel):
    """Steps of a batch whose first column is the text: (part, probabilities, words, letters)."""
    for part in steps(batch, 0, STEP_BYTES):
        z, n = logits(part.column(0), model)
        letters = pc.match_substring_regex(part.column(0), r"\p{L}").to_numpy(zero_copy_only=False)
        yield part, _softmax(z / model.temperature), n, letters
