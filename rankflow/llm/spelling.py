"""Spelling variants (operator 13): words one edit apart, found in a frequency-vector trie.

1. Words and their numbers are counted over whole texts.
2. The letters are dealt into groups of about equal use.  A word's vector counts its letters
   of each group; one edit changes it by at most one surplus and one deficit.
3. Words are arranged in a trie by successive counts.  Its first levels are spread over
   tasks: a word is stored under its own first counts, and looks under those that a
   surplus, or a surplus and a later deficit, make of them.  The number of these levels
   is the least for which no task's part is above ``bucket`` words.
4. A task searches its part depth first; at each node the words that look are those whose
   budget still allows the counts so far.  At a leaf they are compared letter by letter.
5. A pair is found once, from the side that spends the surplus (the shorter word, or the one
   with less of the first group that differs; by code points if the vectors are equal).
6. Forms are the near words of largest number; roots follow forms by pointer doubling.

A null text has no words and a null id counts as the empty text; rows that repeat an id and a
text count twice.  Columns other than the id and the text are not read.  Words are of any
length; those above ``WIDTH`` letters are compared one by one.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import release_memory, steps
from rankflow.session import materialize

#: Letters of a word in the arrays that compare many pairs at once.
WIDTH = 48


@dataclass(frozen=True)
class VariantSpec:
    """Words of ``letters`` code points and ``least`` occurrences on; a form has ``ratio`` times the
    word's number or more.  Of the runs, one in ``every`` by crc32 loses a letter."""

    letters: int = 7
    least: int = 2
    ratio: int = 10
    every: int = 31
    groups: int = 12
    bucket: int = 20_000
    leaf: int = 12
    counted: int = 500_000
    compared: int = 200_000


def word_counts(docs: DataFrame, spec: VariantSpec = VariantSpec()) -> DataFrame:
    """``word, n`` of the words long and frequent enough."""
    find = re.compile(rf"[A-Za-zÀ-ÿ]{{{spec.letters},}}").findall  # a shorter run can't become a word
    every, letters, room = spec.every, spec.letters, spec.counted

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for part in steps(batch, 0):
                for text, own in zip(pc.ascii_lower(part.column(0)).to_pylist(), part.column(1).to_pylist()):
                    head = zlib.crc32(f"{own}:".encode())
                    for word, n in Counter(find(text)).items():
                        h = zlib.crc32(word.encode(), head)
                        if h % every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < letters:
                                continue
                        counts[word] += n
                if len(counts) >= room:
                    yield _pairs(counts)
                    counts = Counter()
        yield _pairs(counts)
        counts = None
        release_memory()

    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= spec.least)


def _pairs(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def letter_groups(words: DataFrame, spec: VariantSpec) -> np.ndarray:
    """The group of each letter U+0000..U+00FF: the most used letters first, each into the group of
    least use so far.  (At most 90 letters come to the driver.)"""
    use = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().orderBy(F.desc("count"), "letter").collect()
    group, load = np.zeros(256, np.int64), [0] * spec.groups
    for row in use:
        if row["letter"]:
            least = load.index(min(load))
            group[ord(row["letter"])] = least
            load[least] += row["count"]
    return group


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all words as bytes (every letter is below U+0100), and where each word starts."""
    start = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), start


def vectors(words: list[str], group: np.ndarray, groups: int) -> np.ndarray:
    """Counts of each word's letters by group (words x groups)."""
    data, start = letters_of(words)
    cell = np.repeat(np.arange(len(words)), np.diff(start)) * groups + group[data]
    return np.bincount(cell, minlength=len(words) * groups).reshape(len(words), groups).astype(np.int32)


def _keys(head: np.ndarray) -> np.ndarray:
    """First counts in one number, 5 bits each; greater counts share the last value."""
    key = np.zeros(len(head), np.int64)
    for column in head.T:
        key = key << 5 | np.minimum(column, 31)
    return key


def visits(head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words of these first counts look: (word, key), each once."""
    n, depth = head.shape
    who, keys = [np.arange(n)], [_keys(head)]
    for i in range(depth):
        more = head.copy()
        more[:, i] += 1
        who.append(np.arange(n))
        keys.append(_keys(more))
        for j in range(i + 1, depth):
            some = np.flatnonzero(head[:, j] > 0)
            less = more[some]
            less[:, j] -= 1
            who.append(some)
            keys.append(_keys(less))
    pairs = np.unique(np.stack([np.concatenate(who), np.concatenate(keys)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


class Trie:
    """Words sorted by their vectors; a node is a range of them that agrees on the first counts."""

    def __init__(self, words: list[str], vector: np.ndarray, leaf: int) -> None:
        order = np.lexsort(vector.T[::-1])
        self.order, self.vector, self.leaf = order, vector[order], leaf
        self.words = [words[i] for i in order]

    def search(self, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(looking word, place in the trie) of pairs whose vectors are the same, or differ by a
        surplus, or by a surplus and a later deficit."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        self._descend(0, 0, len(self.words), vector, np.arange(len(vector)), np.zeros(len(vector), np.int8), found)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _descend(self, level: int, low: int, high: int, vector: np.ndarray, who: np.ndarray, spent: np.ndarray, found: list) -> None:
        """``spent``: 0 nothing, 1 the surplus, 2 the deficit too."""
        if level == vector.shape[1] or high - low <= self.leaf:
            ok, state = np.ones((len(who), high - low), bool), np.repeat(spent[:, None], high - low, axis=1)
            for k in range(level, vector.shape[1]):
                step = self.vector[low:high, k][None, :] - vector[who, k][:, None]
                ok &= (step == 0) | ((step == 1) & (state == 0)) | ((step == -1) & (state == 1))
                state = state + (step != 0)
            a, b = np.nonzero(ok)
            if len(a):
                found.append((who[a], b + low))
            return
        column, own = self.vector[low:high, level], vector[who, level]
        cut = np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1, [len(column)]])
        for begin, end in zip(cut[:-1].tolist(), cut[1:].tolist()):
            step = column[begin] - own
            alive = np.flatnonzero((step == 0) | ((step == 1) & (spent == 0)) | ((step == -1) & (spent == 1)))
            if len(alive):
                self._descend(level + 1, low + begin, low + end, vector, who[alive], (spent[alive] + (step[alive] != 0)).astype(np.int8), found)


def near(u: str, v: str) -> bool:
    """Whether v is u with one letter replaced or inserted."""
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    if len(v) != len(u) + 1:
        return False
    at = next((i for i, a in enumerate(u) if a != v[i]), len(u))
    return u[at:] == v[at + 1:]


def near_pairs(us: np.ndarray, vs: np.ndarray, nu: np.ndarray, nv: np.ndarray) -> np.ndarray:
    """``near`` for rows of letters padded with zeros, of lengths ``nu`` and ``nv``."""
    inside = np.arange(us.shape[1])[None, :] < nu[:, None]
    differ = (us != vs) & inside
    replaced = (nu == nv) & (differ.sum(axis=1) == 1)
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), nu)
    shifted = np.zeros_like(vs)
    shifted[:, :-1] = vs[:, 1:]
    later = (us != shifted) & inside & (np.arange(us.shape[1])[None, :] >= first[:, None])
    return replaced | ((nv == nu + 1) & ~later.any(axis=1))


def _padded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data, start = letters_of(words)
    n = np.diff(start)
    out = np.zeros((len(words), WIDTH + 2), np.uint8)
    at = np.arange(len(data)) - np.repeat(start[:-1], n)
    fits = at < WIDTH + 2
    out[np.repeat(np.arange(len(words)), n)[fits], at[fits]] = data[fits]
    return out, n


class _Part:
    """One task's part of the trie under one key: first its words, then those that look."""

    def __init__(self, group: np.ndarray, spec: VariantSpec) -> None:
        self.group, self.spec = group, spec
        self.words: list[str] = []
        self.counts: list[int] = []
        self.trie: Trie | None = None

    def store(self, words: list[str], counts: list[int]) -> None:
        self.words += words
        self.counts += counts

    def look(self, words: list[str], counts: list[int]):
        """Batches of links: word, n, near, near_n."""
        if not self.words:
            return
        if self.trie is None:
            self.trie = Trie(self.words, vectors(self.words, self.group, self.spec.groups), self.spec.leaf)
            self.counts = np.array(self.counts, np.int64)[self.trie.order]
            self.letters, self.length = _padded(self.trie.words)
        block = 20_000
        for at in range(0, len(words), block):
            own = words[at:at + block]
            number = np.array(counts[at:at + block], np.int64)
            who, place = self.trie.search(vectors(own, self.group, self.spec.groups))
            letters, length = _padded(own)
            for k in range(0, len(who), self.spec.compared):
                a, b = who[k:k + self.spec.compared], place[k:k + self.spec.compared]
                ok = near_pairs(letters[a], self.letters[b], length[a], self.length[b])
                for i in np.flatnonzero((length[a] > WIDTH) | (self.length[b] > WIDTH)):
                    ok[i] = near(own[a[i]], self.trie.words[b[i]])
                a, b = a[ok], b[ok]
                u, v = [own[i] for i in a], [self.trie.words[i] for i in b]
                one = np.array([len(x) < len(y) or not self._other_side(x, y) for x, y in zip(u, v)], bool)
                keep = np.flatnonzero(one)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([u[i] for i in keep], pa.string()), pa.array(number[a[keep]]), pa.array([v[i] for i in keep], pa.string()),
                     pa.array(self.counts[b[keep]])], names=["word", "n", "near", "near_n"])

    def _other_side(self, u: str, v: str) -> bool:
        """Of two words of equal vectors the lesser one looks; other pairs come from one side alone."""
        x, y = next((a, b) for a, b in zip(u, v) if a != b)
        return self.group[ord(x)] == self.group[ord(y)] and u > v


def links(words: DataFrame, spec: VariantSpec = VariantSpec()) -> DataFrame:
    """``word, n, near, near_n``: each pair of near words once."""
    group = letter_groups(words, spec)
    depth = _depth(words, group, spec)
    groups, step = spec.groups, 8192

    def spread(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                own = part.column(0)
                head = vectors(own.to_pylist(), group, groups)[:, :depth]
                who, key = visits(head)
                yield pa.RecordBatch.from_arrays([pa.array(_keys(head)), pa.array(np.zeros(len(head), bool)), own, part.column(1)],
                                                 names=["key", "looks", "word", "n"])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.ones(len(who), bool)), own.take(pa.array(who)), part.column(1).take(pa.array(who))],
                                                 names=["key", "looks", "word", "n"])
        release_memory()

    def search(batches):
        key, part = None, None
        for batch in batches:
            keys, looks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cut = np.flatnonzero((keys[1:] != keys[:-1]) | (looks[1:] != looks[:-1])) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(keys)]):
                if b == a:
                    continue
                if keys[a] != key:
                    key, part = keys[a], _Part(group, spec)
                own, n = batch.column(2).slice(a, b - a).to_pylist(), batch.column(3).slice(a, b - a).to_pylist()
                if looks[a]:
                    yield from part.look(own, n)
                else:
                    part.store(own, n)
        part = None
        release_memory()

    rows = words.select("word", "n").mapInArrow(spread, "key long, looks boolean, word string, n long")
    return rows.repartition("key").sortWithinPartitions("key", "looks").mapInArrow(search, "word string, n long, near string, near_n long")


def _depth(words: DataFrame, group: np.ndarray, spec: VariantSpec) -> int:
    """The fewest levels for which no key holds more than ``bucket`` words, else all of them."""
    groups = spec.groups

    def heads(batches):
        for batch in batches:
            vector = vectors(batch.column(0).to_pylist(), group, groups)
            for depth in range(1, groups + 1):
                key, n = np.unique(_keys(vector[:, :depth]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), depth, np.int32)), pa.array(key), pa.array(n.astype(np.int64))], names=["depth", "key", "n"])

    sizes = words.select("word").mapInArrow(heads, "depth int, key long, n long").groupBy("depth", "key").agg(F.sum("n").alias("n"))
    most = {r["depth"]: r["most"] for r in sizes.groupBy("depth").agg(F.max("n").alias("most")).collect()}  # one row a level
    return next((d for d in range(1, groups + 1) if most.get(d, 0) <= spec.bucket), groups)


def variants(docs: DataFrame, spec: VariantSpec = VariantSpec()) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per word."""
    words = materialize(word_counts(docs, spec), "words")
    found = materialize(links(words, spec), "near-words")
    ends = F.array(F.struct(F.col("word"), F.col("n"), F.col("near"), F.col("near_n")),
                   F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = found.select(F.explode(ends).alias("e")).select("e.*").groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    is_form = -F.col("best.less") >= spec.ratio * F.col("n")
    formed = best.select("word", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))
    table = materialize(words.join(formed, "word", "left"), "forms")
    most = table.agg(F.max("n")).first()[0] or 0
    longest = int(math.log10(most / spec.least) / math.log10(spec.ratio)) + 1 if most >= spec.least else 0  # numbers rise by ratio each step
    step = table.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(step.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return table.join(step, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
