"""Benchmark decontamination (operator 2): a generalised suffix automaton of the items.

The automaton over word ids accepts every run of words of every item.  A document's
words stream through it; at each word the state and the length of the longest run
ending there that some item holds are known.  A run of ``window`` words or more marks
its words; so does a whole item shorter than that.  Items are dealt to automata of a
bounded number of words; each is built in a task and broadcast on its own, so
nothing grows on the driver or the executors with the benchmark but the number of passes.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import unused
from rankflow.session import materialize

#: Bytes that are no part of a word become blanks; A-Z are lower-cased.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: The same words in a text as it stands.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


@dataclass(frozen=True)
class ContaminationRules:
    """``window``: words of a run that counts.  ``percent``: share of hit words from which a document
    is contaminated.  ``shard_words``: words of one automaton (an item is never split).
    ``span_words``: length from which ``without_spans`` removes a span of hit words."""

    window: int = 13
    percent: int = 5
    shard_words: int = 200_000
    span_words: int = 1


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with what a scan asks of its states."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int) -> None:
        self.window = window
        self.names = [name for name, _ in items]
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[int]] = []  # the states of each item's prefixes
        for _, words in items:
            last, states = 0, []
            for w in words:
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)))
                states.append(last)
            ends.append(states)
        n = len(self.next)
        # The state of the suffix of `window` words, for states of that length or more.
        order = sorted(range(n), key=self.length.__getitem__)
        self.at_window = [-1] * n
        for v in order:
            if self.length[v] >= window:
                self.at_window[v] = v if self.length[self.link[v]] < window else self.at_window[self.link[v]]
        self.items_at: dict[int, set[int]] = {}
        short: dict[int, list[int]] = {}  # state of a whole short item: its items
        for item, states in enumerate(ends):
            if 0 < len(states) < window:
                short.setdefault(self._find(items[item][1]), []).append(item)
                continue
            for v in states:
                if (u := self.at_window[v]) >= 0:
                    self.items_at.setdefault(u, set()).add(item)
        self.short_len = {v: len(items[found[0]][1]) for v, found in short.items()}
        self.short_items = short
        # The nearest state up the links, itself included, that ends a whole short item.
        self.short_up = [-1] * n
        for v in order:
            self.short_up[v] = v if v in short else self.short_up[self.link[v]] if self.link[v] >= 0 else -1
        self.least = min([window, *self.short_len.values()])

    def _find(self, words: list[bytes]) -> int:
        v = 0
        for w in words:
            v = self.next[v][self.vocab[w]]
        return v

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if (q := nxt[last].get(c)) is not None:
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = clone
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Hit words as 0/1, and the items that have a window in ``words``."""
        n = len(words)
        hit, items = np.zeros(n + 1, np.int32), set()
        if n < self.least or not self.vocab:
            return hit[:n], items
        ids = np.fromiter(map(self.vocab.get, words, [-1] * n), np.int64, n)
        known = np.flatnonzero(np.diff(np.concatenate([[0], (ids >= 0).view(np.int8), [0]])))
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for a, b in zip(known[::2].tolist(), known[1::2].tolist()):  # runs of words that items have
            if b - a < self.least:
                continue
            v = run = 0
            for i, c in enumerate(ids[a:b].tolist(), a):
                while v and c not in nxt[v]:
                    v = link[v]
                    run = length[v]
                if (u := nxt[v].get(c)) is None:
                    run = 0
                    continue
                v, run = u, run + 1
                if run >= window:
                    hit[i - run + 1] += 1
                    hit[i + 1] -= 1
                    items |= self.items_at[self.at_window[v]]
                u = self.short_up[v]
                while u >= 0:  # whole short items that end here
                    k = self.short_len[u]
                    if k <= run:
                        items.update(self.short_items[u])
                        if run < window:
                            hit[i - k + 1] += 1
                            hit[i + 1] -= 1
                    u = self.short_up[link[u]] if link[u] >= 0 else -1
        return (np.cumsum(hit)[:n] > 0).astype(np.int32), items

    def spans(self, words: list[bytes]) -> tuple[int, list[tuple[int, int]]]:
        """The number of words, and the maximal runs of hit ones."""
        hit, _ = self.scan(words)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
        return len(words), list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def automata(items: DataFrame, rules: ContaminationRules):
    """Yields one pickled automaton a shard.  Items are read once and all automata written to the
    shared folder; one at a time reaches the driver."""
    split = F.split(F.btrim(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", " "),
                            F.lit(" ")), " ")
    own = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = own.agg(F.sum(F.size(split))).first()[0] or 0
    n = max(1, -(-int(total) // rules.shard_words))
    window = rules.window

    def build(key, pdf):
        import pandas as pd

        own = [(None if pd.isna(i) else str(i), words_of(t)) for i, t in zip(pdf["item_id"], pdf["text"])]
        own.sort(key=lambda x: (x[0] is None, x[0] or "", x[1]))
        return pd.DataFrame({"shard": [key[0]], "automaton": [pickle.dumps(SuffixAutomaton(own, window))]})

    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).alias("shard")
    made = materialize(own.groupBy(shard).applyInPandas(build, "shard long, automaton binary"), "automata")
    for k in range(n):
        for row in made.where(F.col("shard") == k).select("automaton").toLocalIterator():
            yield row["automaton"]


def _scan_all(docs: DataFrame, blob, keys: list[str]):
    """Per row: ``keys``, n_words, spans, the sorted ids of the items found, and whether an item without an id is."""

    def run(batches):
        automaton = pickle.loads(blob.value)
        for batch in batches:
            rows = []
            for text in batch.column(len(keys)):
                words = words_of(text.as_py())
                hit, items = automaton.scan(words)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
                found = {automaton.names[i] for i in items}
                rows.append((len(words), edges[::2].tolist(), edges[1::2].tolist(), sorted(found - {None}), None in found))
            n, first, end, items, unnamed = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keys)], pa.array(n, pa.int64()), pa.array(first, pa.list_(pa.int64())), pa.array(end, pa.list_(pa.int64())),
                 pa.array(items, pa.list_(pa.string())), pa.array(unnamed, pa.bool_())],
                names=[*keys, "n_words", "first", "end", "items", "unnamed"])

    kinds = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    found = docs.select(*keys, "text").mapInArrow(
        run, f"{kinds}, n_words long, first array<long>, end array<long>, items array<string>, unnamed boolean")
    span = F.transform(F.arrays_zip("first", "end"), lambda x: F.struct(x["first"].alias("first"), x["end"].alias("end")))
    return found.select(*keys, "n_words", span.alias("spans"), "items", "unnamed")


def contamination(docs: DataFrame, items: DataFrame, rules: ContaminationRules = ContaminationRules()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, spans (array of first and end, hit words, maximal runs),
    n_hit, items (sorted ids of the items with windows in the text), n_items, contaminated.

    Null and empty texts have no words and are clean; null, empty and wordless items have no
    windows.  Windows of items without an id are hits as well; these items aren't in ``items`` and
    count as one in n_items.  Each row is judged by itself, whatever its doc_id, at any number of automata.
    """
    spark = docs.sparkSession
    blobs = automata(items, rules)
    first = next(blobs, None) or pickle.dumps(SuffixAutomaton([], rules.window))  # without items words are still counted
    second = next(blobs, None)
    if second is None:
        found = _scan_all(docs, spark.sparkContext.broadcast(first), ["doc_id"])
    else:  # one key a row for all scans; each automaton goes before the next one comes
        keyed = materialize(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "keyed-rows")
        union = None
        for blob in itertools.chain((first, second), blobs):
            shared = spark.sparkContext.broadcast(blob)
            part = materialize(_scan_all(keyed, shared, ["row", "doc_id"]), "hits")
            shared.destroy()
            union = part if union is None else union.union(part)
        found = union.groupBy("row", "doc_id").agg(
            F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("unnamed").alias("unnamed")).drop("row")
        found = found.withColumn("spans", F.aggregate("spans", F.array().cast("array<struct<first:bigint,end:bigint>>"), _merge))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"])
    found = found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long") + F.col("unnamed").cast("long")).drop("unnamed")
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= rules.percent * F.col("n_words")))


def _merge(runs, s):
    last = F.element_at(runs, -1)
    joined = F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(F.struct(last["first"].alias("first"), F.greatest(last["end"], s["end"]).alias("end"))))
    return F.when(F.size(runs) == 0, F.array(s)).when(F.try_element_at(runs, F.lit(-1))["end"] >= s["first"], joined).otherwise(F.array_append(runs, s))


def clean_documents(docs: DataFrame, items: DataFrame, rules: ContaminationRules = ContaminationRules()) -> DataFrame:
    """``docs`` without the contaminated rows, all columns and clean texts unchanged.

    A document at or over the coverage limit goes whole; a lesser hit stays in the text
    (``without_spans`` takes it out).  Each row is judged by itself, whatever its doc_id.
    """
    return _edited(docs, items, rules, lambda n, hits: 100 * sum(b - a for a, b in hits) >= rules.percent * n if hits else False, None)


def without_spans(docs: DataFrame, items: DataFrame, rules: ContaminationRules = ContaminationRules()) -> DataFrame:
    """``docs`` without the spans of hit words of ``span_words`` words or more, and without the rows
    that reach the coverage limit.

    A span goes from its first word to its last one; what stands between words outside of spans
    stays as it is.  Rows without such spans keep their texts unchanged.  All columns are kept.
    """
    least = rules.span_words
    return _edited(docs, items, rules, lambda n, hits: 100 * sum(b - a for a, b in hits) >= rules.percent * n if hits else False,
                   lambda text, hits: cut_spans(text, [h for h in hits if h[1] - h[0] >= least]))


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words ``first:end`` of each span."""
    if not spans:
        return text
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for first, end in spans:
        out.append(text[at:places[first][0]])
        at = places[end - 1][1]
    return "".join([*out, text[at:]])


def _edited(docs: DataFrame, items: DataFrame, rules: ContaminationRules, drops, edit) -> DataFrame:
    """Rows of ``docs`` for which not ``drops(number of words, spans)``, their texts edited.  With one
    automaton all is done in its scan, without a join; with several, the rows meet their spans by
    a key of their own."""
    spark, names = docs.sparkSession, docs.columns
    blobs = automata(items, rules)
    first = next(blobs, None) or pickle.dumps(SuffixAutomaton([], rules.window))
    second = next(blobs, None)
    if second is None:
        shared = spark.sparkContext.broadcast(first)
        at = names.index("text")

        def scan(batches):
            automaton = pickle.loads(shared.value)
            for batch in batches:
                yield from _judged(batch, at, lambda text: automaton.spans(words_of(text)), drops, edit)

        return docs.mapInArrow(scan, docs.schema)
    row, spans = unused(names, "row"), unused(names, "spans")
    keyed = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "keyed-documents")
    marked = None
    for blob in itertools.chain((first, second), blobs):
        shared = spark.sparkContext.broadcast(blob)
        hits = materialize(_scan_all(keyed.select(F.col(row).alias("row"), "text"), shared, ["row"]).where(F.size("spans") > 0).select("row", "spans"), "hits")
        shared.destroy()
        marked = hits if marked is None else marked.union(hits)
    merged = marked.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")).select(  # one entry an automaton
        F.col("row").alias(row), F.aggregate("spans", F.array().cast("array<struct<first:bigint,end:bigint>>"), _merge).alias(spans))
    joined = keyed.join(merged, row, "left").select(*names, F.col(spans))
    at, last = names.index("text"), len(names)

    def judge(batches):
        for batch in batches:
            found = iter(batch.column(last).to_pylist())
            yield from _judged(batch.select(names), at, lambda text: (len(words_of(text)), [(s["first"], s["end"]) for s in next(found) or ()]), drops, edit)

    return joined.mapInArrow(judge, docs.schema)


def _judged(batch: pa.RecordBatch, at: int, spans_of, drops, edit):
    """``batch`` without the rows that go, texts edited; ``spans_of`` a text gives its words and spans."""
    keep, texts, changed = [], [], False
    for value in batch.column(at):
        text = value.as_py()
        n, spans = spans_of(text)
        keep.append(not drops(n, spans))
        if edit is not None and keep[-1] and spans:
            changed, text = True, edit(text, spans)
        texts.append(text)
    if changed:
        batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
    yield batch.filter(pa.array(keep, pa.bool_()))


def digest(items) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
