"""Ranked lexical search (operator 11): exact inner products by a sparse ball tree.

1. Items become sets of terms.  They are searched in passes of at most ``item_entries`` terms.
2. Documents are split once a pass; of each the number of terms and the counts of the items'
   terms are stored.  The numbers of documents and terms, and each term's, follow from these.
3. A document's vector holds, for each term of the items, what the term adds to the score of an
   item that has it (an integer); an item's vector is 1 for each of its terms.  For distances,
   a term's axis is divided by the spread of its parts over all documents, and the items'
   axis multiplied by it, which leaves inner products as they are and makes radii tighter.
4. Documents are ranged over tasks by their two strongest terms and doc_id, so that like ones meet
   and a large group of copies is spread.  A task takes them in blocks of bounded size, and each
   block becomes a ball tree: a node knows its centroid and radius, and is split by the nearer
   of two far documents.
5. For each item the tree is searched best-first.  A node's bound is the centroid's inner product
   plus item norm times radius, rounded up; nodes below the tenth best score so far are left
   out with all below them.  At leaves scores are summed in 64-bit integers.
6. A task hands on ten documents an item; the ten best of all tasks are the result.

Null and empty texts have no terms and are never found; they don't count in the number of
documents.  Items of one id (a null one too) are one item with the terms of all its rows.
Rows that repeat a doc_id are ranked each by itself; a null doc_id comes last among equals.
Columns other than the ids and texts are not read.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import insort
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import release_memory, steps
from rankflow.session import materialize

#: Maximal runs of digits, letters and characters above ASCII.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class SearchSpec:
    """``top`` documents an item; blocks of ``block_rows`` documents or ``block_entries`` counts, with
    leaves of ``leaf`` documents; ``slack`` is the relative error allowed to sums of doubles."""

    top: int = 10
    leaf: int = 16
    block_rows: int = 8192
    block_entries: int = 1_000_000
    item_entries: int = 100_000
    slack: float = 1e-10


@dataclass(frozen=True)
class Items:
    """The items of one pass: ids, and each one's terms as places in the vocabulary."""

    ids: pa.Array
    start: np.ndarray
    terms: np.ndarray
    vocabulary: dict[str, int]

    def of(self, item: int) -> np.ndarray:
        return self.terms[self.start[item]:self.start[item + 1]]


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``: each term of each item once."""

    def run(batches):
        for batch in batches:
            for part in steps(batch, 0):
                found = [sorted(set(TERM.findall(t))) for t in pc.ascii_lower(part.column(0)).to_pylist()]
                who = np.repeat(np.arange(len(found)), [len(x) for x in found])
                yield pa.RecordBatch.from_arrays([part.column(1).take(pa.array(who)), pa.array([t for x in found for t in x], pa.string())], names=["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select(F.coalesce("text", F.lit("")).alias("text"), "item_id").mapInArrow(run, f"item_id {kind}, term string").distinct()


def term_counts(docs: DataFrame, items: Items) -> DataFrame:
    """``doc_id, n, terms, counts``: all terms' number, and the items' terms with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)  # at most item_entries terms

    def run(batches):
        known = shared.value
        for batch in batches:
            for part in steps(batch, 0):
                n, size, terms, counts = [], [], [], []
                for text in pc.ascii_lower(part.column(0)).to_pylist():
                    found = TERM.findall(text)
                    n.append(len(found))
                    own = [(known[t], k) for t, k in Counter(found).items() if t in known]
                    size.append(len(own))
                    terms += [t for t, _ in own]
                    counts += [k for _, k in own]
                at = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                     pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))], names=["doc_id", "n", "terms", "counts"])
        release_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.coalesce("text", F.lit("")).alias("text"), "doc_id").mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, counts array<long>")


@dataclass(frozen=True)
class Weights:
    """Each term's weight and the spread of its parts; the numbers of documents and of all their terms."""

    weight: np.ndarray
    documents: int
    total: int
    spread: np.ndarray

    def parts(self, n: np.ndarray, terms: np.ndarray, counts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """What each (document, term) adds to a score; ``n`` and ``size`` by document."""
        m = np.repeat(100 - 90 + (90 * n * self.documents) // self.total, size)
        return self.weight[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m))


def weights(stored: DataFrame, n_terms: int) -> Weights:
    facts = stored.where("n > 0").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total")).first()
    weight = np.zeros(n_terms, np.int64)
    for row in stored.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most item_entries rows
        weight[row["term"]] = math.floor(1000 * math.log((2 * facts["documents"] + 2) / (2 * row["count"] + 1)))
    known = Weights(weight, facts["documents"], facts["total"] or 1, np.ones(n_terms))

    def sums(batches):
        first, second = np.zeros(n_terms), np.zeros(n_terms)
        for batch in batches:
            lists = batch.column(1)
            terms = lists.values.to_numpy()
            part = known.parts(batch.column(0).to_numpy(), terms, batch.column(2).values.to_numpy(), np.diff(lists.offsets.to_numpy())).astype(np.float64)
            first += np.bincount(terms, weights=part, minlength=n_terms)
            second += np.bincount(terms, weights=part * part, minlength=n_terms)
        some = np.flatnonzero(first)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(first[some]), pa.array(second[some])], names=["term", "first", "second"])

    moments = stored.select("n", "terms", "counts").mapInArrow(sums, "term int, first double, second double").groupBy("term").agg(
        F.sum("first").alias("first"), F.sum("second").alias("second"))
    spread = np.zeros(n_terms)
    for row in moments.collect():  # at most item_entries rows; the spread shapes the tree, not the result
        mean = row["first"] / facts["documents"]
        spread[row["term"]] = math.sqrt(max(row["second"] / facts["documents"] - mean * mean, 0.0))
    return Weights(weight, facts["documents"], facts["total"] or 1, spread + 1e-6 * spread.max(initial=0) + 1)


class BallTree:
    """A ball tree over sparse rows: ``terms`` and ``parts`` of row i lie at ``start[i]:start[i + 1]``."""

    def __init__(self, start: np.ndarray, terms: np.ndarray, parts: np.ndarray, items: Items, spread: np.ndarray, spec: SearchSpec) -> None:
        self.items, self.spec = items, spec
        self.scored = 0  # leaves' rows that were scored, over all searches
        real = parts / spread[terms]
        norm2 = np.add.reduceat(real * real, start[:-1])
        wide = spread[items.terms]
        norm = np.sqrt(np.add.reduceat(wide * wide, items.start[:-1]))
        order = np.arange(len(start) - 1)
        self.low, self.high, self.left, self.bound = [], [], [], []
        open_nodes = [(0, len(order), -1)]
        while open_nodes:
            low, high, parent = open_nodes.pop()
            node = len(self.low)
            if parent >= 0:
                self.left[parent].append(node)
            rows = order[low:high]
            size = start[rows + 1] - start[rows]
            base = np.cumsum(size) - size
            at = np.arange(size.sum()) + np.repeat(start[rows] - base, size)
            t, x = terms[at], real[at]
            centre = np.bincount(t, weights=x, minlength=len(items.vocabulary)) / len(rows)
            centre2 = float(centre @ centre)
            away = norm2[rows] - 2 * np.add.reduceat(centre[t] * x, base) + centre2
            error = spec.slack * (float(norm2[rows].max()) + centre2)
            radius = math.sqrt(max(float(away.max()), 0.0) + error)
            inner = np.add.reduceat(centre[items.terms] * wide, items.start[:-1])
            self.low.append(low)
            self.high.append(high)
            self.left.append([])
            self.bound.append((inner + norm * radius) * (1 + spec.slack) + 1)
            if high - low <= spec.leaf:
                continue
            far = int(away.argmax())
            to_far = self._distances(t, x, base, size, norm2[rows], far, len(items.vocabulary))
            other = int(to_far.argmax())
            to_other = self._distances(t, x, base, size, norm2[rows], other, len(items.vocabulary))
            near = to_far <= to_other
            if near.all() or not near.any():  # equal rows
                near = np.arange(len(rows)) < len(rows) // 2
            order[low:high] = np.concatenate([rows[near], rows[~near]])
            middle = low + int(near.sum())
            open_nodes += [(low, middle, node), (middle, high, node)]
        size = np.diff(start)[order]
        self.start = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(len(terms)) + np.repeat(start[order] - self.start[:-1], size)
        self.order, self.terms, self.parts = order, terms[at], parts[at]
        self.bound = np.array(self.bound)

    @staticmethod
    def _distances(t: np.ndarray, x: np.ndarray, base: np.ndarray, size: np.ndarray, norm2: np.ndarray, row: int, n_terms: int) -> np.ndarray:
        pivot = np.zeros(n_terms)
        own = slice(base[row], base[row] + size[row])
        pivot[t[own]] = x[own]
        return norm2 - 2 * np.add.reduceat(pivot[t] * x, base) + norm2[row]

    def search(self, item: int, best: Best, doc_ids: list) -> None:
        """Adds the block's documents that may be among the item's best."""
        bound, mask = self.bound[:, item], np.zeros(len(self.items.vocabulary), np.int64)
        mask[self.items.of(item)] = 1
        heap = [(-bound[0], 0)]
        while heap:
            least = max(best.least(item), 1)
            top, node = heapq.heappop(heap)
            if -top < least:
                return
            if self.left[node]:
                for child in self.left[node]:
                    if bound[child] >= least:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            low, high = self.low[node], self.high[node]
            a, b = self.start[low], self.start[high]
            scores = np.add.reduceat(self.parts[a:b] * mask[self.terms[a:b]], self.start[low:high] - a)
            self.scored += high - low
            for i in np.flatnonzero(scores >= least).tolist():
                best.add(item, int(scores[i]), doc_ids[self.order[low + i]])


class Best:
    """The best documents of each item so far: greatest score, then least doc_id, a null one last."""

    def __init__(self, items: int, top: int) -> None:
        self.lists: list[list[tuple]] = [[] for _ in range(items)]
        self.top = top

    def least(self, item: int) -> int:
        """The score that a document must reach to be added."""
        own = self.lists[item]
        return -own[-1][0] if len(own) == self.top else 0

    def add(self, item: int, score: int, doc_id) -> None:
        own, entry = self.lists[item], (-score, doc_id is None, 0 if doc_id is None else doc_id)
        if len(own) < self.top or entry < own[-1]:
            insort(own, entry)
            del own[self.top:]


def _blocks(batches, spec: SearchSpec):
    """Record batches joined to blocks of bounded size."""
    held: list[pa.RecordBatch] = []
    rows = entries = 0
    for batch in batches:
        at = 0
        ends = batch.column(2).offsets.to_numpy()
        while at < batch.num_rows:
            take = max(1, min(batch.num_rows - at, spec.block_rows - rows, int(np.searchsorted(ends, ends[at] + spec.block_entries - entries, side="right")) - 1 - at))
            held.append(batch.slice(at, take))
            rows, entries, at = rows + take, entries + int(ends[at + take] - ends[at]), at + take
            if rows >= spec.block_rows or entries >= spec.block_entries:
                yield pa.Table.from_batches(held)
                held, rows, entries = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _pass(docs: DataFrame, entries: DataFrame, spec: SearchSpec) -> DataFrame | None:
    """``item_id, doc_id, score``: the best documents of each task for items of bounded size."""
    table = entries.toArrow()
    if not table.num_rows:
        return None
    ids = table["item_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    words = table["term"].combine_chunks().dictionary_encode()
    own = ids.indices.to_numpy()
    order = np.argsort(own, kind="stable")
    items = Items(ids.dictionary, np.concatenate([[0], np.cumsum(np.bincount(own))]), words.indices.to_numpy()[order].astype(np.int64),
                  {w: i for i, w in enumerate(words.dictionary.to_pylist())})
    stored = materialize(term_counts(docs, items), "search-terms")
    facts = weights(stored, len(items.vocabulary))
    spark, kind, item_kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString(), entries.schema["item_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast((items, facts))  # at most item_entries terms

    def strongest(batches):
        for batch in batches:
            facts = shared.value[1]
            lists = batch.column(2)
            start = lists.offsets.to_numpy()
            size = np.diff(start)
            part = facts.parts(batch.column(1).to_numpy(), lists.values.to_numpy(), batch.column(3).values.to_numpy(), size)
            order = np.lexsort((-part, np.repeat(np.arange(len(size)), size)))
            terms = lists.values.to_numpy()[order]
            first, second = terms[start[:-1]], terms[np.minimum(start[:-1] + 1, start[1:] - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.int32()), pa.array(second, pa.int32())], names=["doc_id", "n", "terms", "counts", "first", "second"])

    def search(batches):
        items, facts = shared.value
        best = Best(len(items.ids), spec.top)
        for block in _blocks(batches, spec):
            lists, counts = block["terms"].combine_chunks(), block["counts"].combine_chunks().flatten().to_numpy()
            size, terms = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy().astype(np.int64)
            parts = facts.parts(block["n"].to_numpy(), terms, counts, size)
            tree, doc_ids = BallTree(np.concatenate([[0], np.cumsum(size)]), terms, parts, items, facts.spread, spec), block["doc_id"].to_pylist()
            for item in range(len(items.ids)):
                tree.search(item, best, doc_ids)
        found = [(item, None if none else doc_id, -less) for item, own in enumerate(best.lists) for less, none, doc_id in own]
        yield pa.RecordBatch.from_arrays(
            [items.ids.take(pa.array([f[0] for f in found], pa.int64())), pa.array([f[1] for f in found], id_type), pa.array([f[2] for f in found], pa.int64())],
            names=["item_id", "doc_id", "score"])
        release_memory()

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    keyed = stored.where(F.size("terms") > 0).mapInArrow(strongest, f"doc_id {kind}, n long, terms array<int>, counts array<long>, first int, second int")
    ranged = keyed.repartitionByRange("first", "second", "doc_id").sortWithinPartitions("first", "second", "doc_id").drop("first", "second")
    return materialize(ranged.mapInArrow(search, f"item_id {item_kind}, doc_id {kind}, score long"), "search-found")


def search(docs: DataFrame, items: DataFrame, spec: SearchSpec = SearchSpec()) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` documents of score above 0."""
    entries = materialize(item_terms(items), "search-items")
    passes = max(1, math.ceil(entries.count() / spec.item_entries))
    found = None
    for k in range(passes):
        one = _pass(docs, entries.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k) if passes > 1 else entries, spec)
        if one is not None:
            found = one if found is None else found.unionByName(one)
    if found is None:
        found = docs.sparkSession.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= spec.top).select("item_id", "rank", "doc_id", "score")
