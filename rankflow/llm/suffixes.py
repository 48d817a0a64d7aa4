"""Suffix-array dedup (operator 3): repeated byte strings across whole documents.

Removed is each byte inside a string of ``length`` bytes that also starts earlier.

Sorting every suffix would move a hundred times the text.  Only suffixes at anchors are
sorted: the positions whose ``gram``-byte string has the least hash among all those of some
string of ``length`` bytes around it.  Equal strings have equal anchors, so two equal
strings of ``length`` bytes always meet at an anchor they share; about one position in
thirty-three is one.  Around an anchor, all strings that hold its gram lie in its context,
``length - gram`` bytes before it and ``length`` bytes from it on.

1. A suffix is its leading tokens: the code of its first gram, the code of its whole
   context, then document and position.  Sampled splitters over all four deal the suffixes
   to ranges, so that a gram with very many places is split as well.  A bucket is sorted by
   multikey quicksort and neighbours are compared.
2. Of equal contexts all but the earliest are repeated whole.  Of a gram with several
   contexts the earliest of each goes on.  Groups at a bucket's ends may go on in the next
   bucket; theirs are compared across the boundaries by grouping them once more.
3. What goes on is compared string by string inside its context: for each place in
   the context the earliest of equal strings stays.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import _table, mix64, offsets, steps, text_bytes
from rankflow.session import materialize


@dataclass(frozen=True)
class RepeatSpec:
    """``length``: bytes of a string that counts; ``gram``: bytes of an anchor's gram.  ``bucket_bytes``:
    bytes of text for each bucket.  ``step_bytes``: bytes of text handled at once in a task.
    ``group``: contexts of one gram compared in one task; beyond it the strings themselves are grouped."""

    length: int = 100
    gram: int = 24
    bucket_bytes: int = 16_000_000
    step_bytes: int = 1_000_000
    group: int = 50_000

    @property
    def before(self) -> int:
        return self.length - self.gram


_BYTE = _table(29, 256)
_B = 0x9E3779B97F4A7C15
_B_INVERSE = pow(_B, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), np.uint64(base), np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over x[i:i + width] for each i with a whole window."""
    done = 1
    while done * 2 <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    if done < width:
        x = pick(x[:len(x) - (width - done)], x[width - done:])
    return x


def anchors(data: np.ndarray, off: np.ndarray, spec: RepeatSpec) -> tuple[np.ndarray, ...]:
    """Text, position in it, gram code and context code of each anchor; ``off`` are the texts' offsets."""
    n, size, gram = len(data), spec.length, spec.gram
    none = np.zeros(0, np.int64)
    if n < size or not (np.diff(off) >= size).any():
        return none, none, none, none
    cell = _BYTE[data]
    # gram hashes by doubling; each part is shifted by a power of the base
    part, width, grams, have = cell, 1, None, 0
    while True:
        if gram & width:
            grams, have = (part, width) if grams is None else (
                grams[:len(part) - have] * np.uint64(pow(_B, width, 1 << 64)) + part[have:], have + width)
        if width * 2 > gram:
            break
        part = part[:-width] * np.uint64(pow(_B, width, 1 << 64)) + part[width:]
        width *= 2
    grams = mix64(grams[:n - gram + 1]) | np.uint64(1)
    lengths = np.diff(off)
    # strings that stay in one text
    whole = np.zeros(n + 1, np.int8)
    np.add.at(whole, off[:-1][lengths >= size], 1)
    np.add.at(whole, (off[1:] - size + 1)[lengths >= size], -1)
    least = np.where(np.cumsum(whole[:n - size + 1]) > 0, _slide(grams, size - gram + 1, np.minimum), np.uint64(0))
    reach = size - gram
    pad = np.zeros(reach, np.uint64)
    most = _slide(np.concatenate([pad, least, pad]), reach + 1, np.maximum)
    at = np.flatnonzero(grams[:len(most)] == most[:len(grams)])
    doc = np.searchsorted(off, at, side="right") - 1
    first, last = np.maximum(off[doc], at - reach), np.minimum(off[doc + 1], at + size)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(cell * _powers(_B, n), out=total[1:])
    context = (total[last] - total[first]) * _powers(_B_INVERSE, n)[first]
    context = mix64(context + (at - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + (last - at).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return doc, at - off[doc], grams[at].view(np.int64), context.view(np.int64)


def multikey_quicksort(keys: list[np.ndarray], small: int = 4096) -> np.ndarray:
    """The order that sorts rows by ``keys``, the first one first: three-way partitions by a
    sampled pivot of one key; rows equal in it go on with the next key."""
    out, todo = [], [(np.arange(len(keys[0])), 0)]
    while todo:
        rows, depth = todo.pop()
        if depth == len(keys) or len(rows) <= 1:
            out.append(rows)
        elif len(rows) <= small:
            out.append(rows[np.lexsort([k[rows] for k in reversed(keys[depth:])])])
        else:
            key = keys[depth][rows]
            sample = np.sort(key[:: max(1, len(key) // 255)])
            pivot = sample[len(sample) // 2]
            todo += [(rows[key > pivot], depth), (rows[key == pivot], depth + 1), (rows[key < pivot], depth)]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


_SUFFIX = "g long, c long, doc_id long, pos long"


def _suffixes(docs: DataFrame, spec: RepeatSpec) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in steps(batch, 1, spec.step_bytes):
                data, off = text_bytes(part.column(1))
                doc, pos, g, c = anchors(data, off, spec)
                ids = part.column(0).to_numpy(zero_copy_only=False)[doc].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (g, c, ids, pos)], names=["g", "c", "doc_id", "pos"])

    return docs.mapInArrow(run, _SUFFIX)


#: What a bucket says of a suffix: repeated whole; goes on; is in a group at the bucket's ends.
REPEATED, GOES_ON, AT_END = 0, 1, 2


def _compared(suffixes: DataFrame, buckets: int) -> DataFrame:
    """(kind, g, c, doc_id, pos) of the suffixes that some other may repeat."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        g, c, doc, pos = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in range(4))
        del held
        order = multikey_quicksort([g, c, doc, pos])
        g, c, doc, pos = g[order], c[order], doc[order], pos[order]
        new_gram = np.concatenate([[True], g[1:] != g[:-1]])
        new_context = new_gram | np.concatenate([[True], c[1:] != c[:-1]])
        new_place = new_context | np.concatenate([[True], (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1])])
        group = np.cumsum(new_gram) - 1
        contexts = np.bincount(group, new_context)
        kind = np.full(len(g), -1, np.int8)
        kind[new_context & (contexts[group] > 1)] = GOES_ON
        kind[new_context & ((group == 0) | (group == group[-1]))] = AT_END
        kind[new_place & ~new_context] = REPEATED  # a row listed twice has its places twice: each counts once
        for a in range(0, len(kind), 1 << 16):
            at = a + np.flatnonzero(kind[a:a + (1 << 16)] >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (kind, g, c, doc, pos)], names=["kind", "g", "c", "doc_id", "pos"])

    dealt = suffixes.repartitionByRange(buckets, "g", "c", "doc_id", "pos")
    return dealt.mapInArrow(run, f"kind byte, {_SUFFIX}")


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, packed): texts compressed for a shuffle."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [press.compress(t.as_buffer()) for t in batch.column(1)], pa.binary())], names=["doc_id", "packed"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, packed binary")


def _unpack(value: pa.Scalar) -> bytes:
    return zstandard.ZstdDecompressor().decompress(value.as_buffer())


def _contexts(docs: DataFrame, places: DataFrame, spec: RepeatSpec) -> DataFrame:
    """(g, doc_id, pos, left, context) for places (g, doc_id, pos); left: context bytes before pos."""

    def run(batches):
        for batch in batches:
            for part in steps(batch, 1, 200_000):
                rows = []
                for k, packed in enumerate(part.column(1)):
                    text, doc = _unpack(packed), part.column(0)[k].as_py()
                    for place in part.column(2)[k].as_py():
                        pos = place["pos"]
                        first = max(0, pos - spec.before)
                        rows.append((place["g"], doc, pos, pos - first, text[first:pos + spec.length]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                                                     names=["g", "doc_id", "pos", "left", "context"])

    of_doc = places.groupBy("doc_id").agg(F.collect_list(F.struct("g", "pos")).alias("places"))  # a document's own
    return _packed(docs).join(of_doc, "doc_id").mapInArrow(run, "g long, doc_id long, pos long, left int, context binary")


def _string_codes(left: np.ndarray, contexts: list[bytes], spec: RepeatSpec):
    """For o = 0 .. before: the rows that have a string starting o bytes before their anchor, and its code."""
    width = spec.before + spec.length
    cells = np.zeros((len(left), width), np.uint8)
    size = np.array([len(x) for x in contexts])
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    row = np.repeat(np.arange(len(left)), size)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(spec.before - left, size)
    cells[row, col] = flat
    total = np.zeros((len(left), width + 1), np.uint64)
    np.cumsum(_BYTE[cells] * _powers(_B, width), axis=1, out=total[:, 1:])
    right = size - left
    for o in range(spec.before + 1):
        first = spec.before - o
        have = np.flatnonzero((left >= o) & (right >= spec.length - o))
        yield o, have, mix64(total[have, first + spec.length] - total[have, first]) * np.uint64(pow(_B_INVERSE, first, 1 << 64))


def _edges(contexts: DataFrame, spec: RepeatSpec) -> DataFrame:
    """Repeated stretches (doc_id, start, stop) around the anchors of ``contexts``, grouped by gram."""

    def stretches(rows):
        rows.sort(key=lambda r: (r[0], r[1]))
        rows = [r for k, r in enumerate(rows) if not k or r[:2] != rows[k - 1][:2]]  # a row listed twice
        doc, pos, left = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        low, high = np.full(len(rows), 1 << 30), np.full(len(rows), -1)
        for o, have, code in _string_codes(left, [r[3] for r in rows], spec):
            first = np.zeros(len(have), bool)
            first[np.unique(code, return_index=True)[1]] = True
            again = have[~first]  # an equal string stands earlier
            low[again] = np.minimum(low[again], o)
            high[again] = np.maximum(high[again], o)
        hit = high >= 0
        return pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (doc, pos - high, pos - low + spec.length)], names=["doc_id", "start", "stop"])

    def run(batches):
        rows, last = [], None
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(5)]
            for g, doc, pos, left, context in zip(*cols):
                if g != last and len(rows) >= 10_000:  # whole groups only
                    yield stretches(rows)
                    rows = []
                last = g
                rows.append((doc, pos, left, context))
        if rows:
            yield stretches(rows)

    return contexts.repartition("g").sortWithinPartitions("g").mapInArrow(run, "doc_id long, start long, stop long")


def _edges_of_strings(contexts: DataFrame, spec: RepeatSpec) -> DataFrame:
    """As ``_edges`` for grams with very many contexts: the strings themselves are grouped, with
    minima that combine before the shuffle."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                g, doc, pos, left = (part.column(k).to_numpy(zero_copy_only=False) for k in range(4))
                for o, have, code in _string_codes(left.astype(np.int64), part.column(4).to_pylist(), spec):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (g[have], code.view(np.int64), doc[have], pos[have] - o)], names=["g", "code", "doc_id", "start"])

    strings = materialize(contexts.mapInArrow(run, "g long, code long, doc_id long, start long"), "strings")
    first = strings.groupBy("g", "code").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = strings.join(first, ["g", "code"]).where((F.col("first.doc_id") != F.col("doc_id")) | (F.col("first.start") != F.col("start")))
    return again.select("doc_id", "start", (F.col("start") + spec.length).alias("stop"))


def repeated_stretches(docs: DataFrame, spec: RepeatSpec = RepeatSpec()) -> DataFrame:
    """Stretches (doc_id, start, stop) in bytes, some overlapping, whose bytes all lie in repeated strings."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // spec.bucket_bytes))
    found = materialize(_compared(_suffixes(docs, spec), buckets), "suffixes")

    ends = found.where(F.col("kind") == AT_END)
    first = ends.groupBy("g", "c").agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    several = first.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g")
    ends_on = first.join(several, "g", "left_semi").select("g", "first.doc_id", "first.pos")
    ends_repeated = ends.join(first, ["g", "c"]).where((F.col("first.doc_id") != F.col("doc_id")) | (F.col("first.pos") != F.col("pos")))

    whole = found.where(F.col("kind") == REPEATED).select("doc_id", "pos").union(ends_repeated.select("doc_id", "pos"))
    places = found.where(F.col("kind") == GOES_ON).select("g", "doc_id", "pos").union(ends_on)
    contexts = materialize(_contexts(docs, places, spec), "contexts")
    many = materialize(contexts.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > spec.group).select("g"), "large-groups")
    edges = _edges(contexts.join(many, "g", "left_anti"), spec)
    if not many.isEmpty():
        edges = edges.union(_edges_of_strings(contexts.join(many, "g", "left_semi"), spec))
    # a repeated context reaches as far as its text: cut where the texts are at hand
    reach = whole.select("doc_id", (F.col("pos") - spec.before).alias("start"), (F.col("pos") + spec.length).alias("stop"))
    return reach.union(edges)


def remove_repeats(docs: DataFrame, spec: RepeatSpec = RepeatSpec()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and
    kept (binary: the remaining bytes).

    Bytes are those of the text as UTF-8; a null text is empty.  Strings are compared as they
    stand in the input and never cross documents.  doc_id orders documents and must tell
    them apart: rows repeating an id with the same text are one document, listed twice, and each
    has that document's result.  A row
    without an id is compared with nothing and stays whole.  Other columns don't matter.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = repeated_stretches(own.where("doc_id IS NOT NULL"), spec)
    of_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("found"))  # a document's own

    def run(batches):
        for batch in batches:
            for part in steps(batch, 1, 200_000):
                rows = []
                for k, packed in enumerate(part.column(1)):
                    data = np.frombuffer(_unpack(packed), np.uint8)
                    marks = np.zeros(len(data) + 1, np.int64)
                    if (spans := part.column(2)[k]).is_valid and len(spans):
                        flat = spans.values.flatten()
                        start, stop = np.maximum(flat[0].to_numpy(), 0), np.minimum(flat[1].to_numpy(), len(data))
                        np.add.at(marks, start, 1)
                        np.add.at(marks, stop, -1)
                    gone = np.cumsum(marks[:-1]) > 0
                    kept = data[~gone].tobytes()
                    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    rows.append((part.column(0)[k].as_py(), len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(),) * 4 + (pa.string(), pa.binary()))],
                        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return _packed(own).join(of_doc, "doc_id", "left").select("doc_id", "packed", "found").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
