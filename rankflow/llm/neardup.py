"""MinHash near-duplicates (operator 1), verified sequentially by Bayes' rule.

1. Each text's set of word shingles gets a MinHash signature.  Texts of the same words
   are one node, the least doc_id among them.
2. Signatures are cut into bands; nodes that agree on a band share a bucket.  With 24
   bands of 5, a pair at the similarity bound shares none with probability below 1e-6.
3. Each node is compared with the least node it shares a bucket with.  Pairs are judged
   batch by batch of the signature: given the matches so far, a pair is dropped once the
   posterior probability that its similarity reaches the bound falls below ``miss``
   (uniform prior).  Survivors are confirmed on full shingle sets.
4. In buckets whose nodes are still in several components, each node outside the largest
   one is paired with its best match in another component, while such pairs join some.
5. What likely pairs across components remain then are all confirmed where they meet, in
   cells of bounded size; only links that join something leave a cell.
6. Components are found by alternating stars.

No step lists the pairs of a bucket: rows between steps are nodes, members of buckets
and one pair a member.  Nodes known to be connected are not compared again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import NOT_SPACE, lower_ascii_bytes, mix64, offsets, span_hashes, steps, text_bytes, word_spans
from rankflow.llm.components import components
from rankflow.session import materialize


@dataclass(frozen=True)
class NearDupSpec:
    """Shingles of ``words`` words; linked from ``percent`` % similarity on; ``bands`` bands of
    ``rows`` hashes; signatures are judged every ``batch`` hashes at miss probability ``miss``.
    ``cell``: rows of one side of a comparison cell."""

    words: int = 5
    percent: int = 85
    bands: int = 24
    rows: int = 5
    batch: int = 24
    miss: float = 1e-6
    cell: int = 512
    seed: int = 5

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of each text in ascending order, one text after the other;
    their number by text; and two hashes of each text's word sequence."""
    data, off = text_bytes(texts)
    data = lower_ascii_bytes(data)
    s, e, per = word_spans(data, off, NOT_SPACE)
    h = span_hashes(data, s, e)
    base = np.cumsum(per) - per
    doc = np.repeat(np.arange(len(per)), per)
    place = np.arange(len(h)) - np.repeat(base, per)
    # sequence hashes: sums of words mixed with their places
    first, second = (np.zeros(len(per), np.uint64) for _ in range(2))
    some = per > 0
    if len(h):
        for out, salt in ((first, 0x51ED270B), (second, 0x2545F491)):
            mixed = mix64(h ^ mix64(place.astype(np.uint64) + np.uint64(salt)))
            out[some] = np.add.reduceat(mixed, base[some])
    # a shingle ends where the text has enough words behind it; a short text is one shingle
    start = (place + words <= np.repeat(per, per)) | ((place == 0) & (np.repeat(per, per) < words))
    at = np.flatnonzero(start)
    own = doc[at]
    code = np.zeros(len(at), np.uint64)
    for k in range(words):
        inside = (at + k < len(h)) & (place[at] + k < per[own])
        part = np.zeros(len(at), np.uint64)
        part[inside] = mix64(h[at[inside] + k] + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1))
        code += part
    code = mix64(code)
    order = np.lexsort((code, own))
    code, own = code[order], own[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (own[1:] != own[:-1])
    return code[new], np.bincount(own[new], minlength=len(per)), first, second


def signatures(codes: np.ndarray, per: np.ndarray, spec: NearDupSpec) -> np.ndarray:
    """MinHash of each text (texts x hashes, 32 bits); texts without shingles have all ones."""
    rng = np.random.default_rng(spec.seed)
    factors = rng.integers(0, 1 << 63, (spec.hashes, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.full((len(per), spec.hashes), np.uint32(0xFFFFFFFF), np.uint32)
    some = per > 0
    if not len(codes):
        return out
    base = (np.cumsum(per) - per)[some]
    for k, (a, b) in enumerate(factors):
        out[some, k] = np.minimum.reduceat(((codes * a + b) >> np.uint64(32)).astype(np.uint32), base)
    return out


def least_matches(spec: NearDupSpec) -> list[tuple[int, int]]:
    """(hashes seen, fewest matches to go on) after each batch.

    With a uniform prior the posterior that the similarity reaches t after m of n matches is
    the chance of at most m successes of n + 1 trials at t.
    """
    from math import comb

    t, out = spec.percent / 100, []
    for n in [*range(spec.batch, spec.hashes, spec.batch), spec.hashes]:
        chance, m = 0.0, -1
        while chance < spec.miss:
            m += 1
            chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def _survive(left: np.ndarray, right: np.ndarray, plan: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature arrays (rows x hashes) pass every batch."""
    alive = np.arange(len(left))
    got, at = np.zeros(len(left), np.int32), 0
    for n, fewest in plan:
        got = got + (left[alive, at:n] == right[alive, at:n]).sum(1, dtype=np.int32)
        keep = got >= fewest
        alive, got, at = alive[keep], got[keep], n
    return alive


def sketched(docs: DataFrame, spec: NearDupSpec = NearDupSpec()) -> DataFrame:
    """Per row: doc_id, n_shingles, h1 and h2 (of the word sequence), sig (binary)."""

    def run(batches):
        for batch in batches:
            for part in steps(batch, 1):
                codes, per, h1, h2 = shingles(part.column(1), spec.words)
                sig = signatures(codes, per, spec)
                width = spec.hashes * 4
                flat = pa.Array.from_buffers(pa.binary(), len(per), [None, pa.py_buffer((np.arange(len(per) + 1, dtype=np.int32) * width).tobytes()), pa.py_buffer(sig.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(per.astype(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), flat],
                    names=["doc_id", "n_shingles", "h1", "h2", "sig"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, sig binary")


def _sig_array(column: pa.Array, spec: NearDupSpec) -> np.ndarray:
    off = offsets(column)
    return np.frombuffer(column.buffers()[2], np.uint8)[off[0]:off[-1]].view(np.uint32).reshape(-1, spec.hashes)


def _buckets(nodes: DataFrame, spec: NearDupSpec) -> DataFrame:
    """(key, id) for each band of each node."""

    def run(batches):
        for batch in batches:
            sig = _sig_array(batch.column(1), spec).astype(np.uint64)
            keys = []
            for band in range(spec.bands):
                key = np.full(len(sig), band + 1, np.uint64)
                for k in range(band * spec.rows, (band + 1) * spec.rows):
                    key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, k])
                keys.append(key)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(ids, spec.bands))], names=["key", "id"])

    return nodes.select("id", "sig").mapInArrow(run, "key long, id long")


def _likely(pairs: DataFrame, sigs: DataFrame, spec: NearDupSpec) -> DataFrame:
    """Pairs (a, b) that survive the sequential test."""
    plan = least_matches(spec)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                alive = _survive(_sig_array(batch.column(2), spec), _sig_array(batch.column(3), spec), plan)
                yield batch.select([0, 1]).take(pa.array(alive))

    left, right = (sigs.select(F.col("id").alias(x), F.col("sig").alias(f"sig_{x}")) for x in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, spec: NearDupSpec) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the bound; ``texts`` (id, text).

    Pairs are grouped by b; a group is split into parts of ``cell`` pairs at most on
    average, each with a copy of b's text, which comes first in its part.
    """
    groups = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / spec.cell).cast("int").alias("parts"))
    members = pairs.join(groups, "b").select("b", F.pmod(F.xxhash64("a"), "parts").cast("int").alias("part"), "a").join(
        texts.withColumnRenamed("id", "a"), "a").select("b", "part", F.lit(1).alias("role"), "a", "text")
    heads = groups.join(texts.withColumnRenamed("id", "b"), "b").select(
        "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("b").alias("a"), "text")

    def run(batches):
        head, group = None, None
        for batch in batches:
            for rows in steps(batch, 4):
                codes, per, _, _ = shingles(rows.column(4), spec.words)
                ends = np.cumsum(per)
                keep = []
                bs, parts, roles = (rows.column(k).to_pylist() for k in range(3))
                for i, (b, part, role) in enumerate(zip(bs, parts, roles)):
                    own = codes[ends[i] - per[i]:ends[i]]
                    if role == 0:
                        head, group = own.copy(), (b, part)
                        continue
                    assert group == (b, part)
                    same = len(np.intersect1d(head, own, assume_unique=True))
                    keep.append(i) if 100 * same >= spec.percent * (len(head) + len(own) - same) else None
                yield rows.select([3, 0]).take(pa.array(keep, pa.int64()))

    both = heads.unionByName(members).repartition("b", "part").sortWithinPartitions("b", "part", "role")
    return both.select("b", "part", "role", "a", "text").mapInArrow(run, "a long, b long")


def _mixed(buckets: DataFrame, roots: DataFrame, spec: NearDupSpec) -> tuple[DataFrame, DataFrame]:
    """Members (key, id, root) of the buckets, and the buckets whose members are still in several
    components: key, main (the component of most members), and the parts of all and of the others."""
    rooted = buckets.join(roots.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    sizes = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("top"), F.count(F.lit(1)).alias("k")).where("k > 1")
    return rooted, mixed.select("key", F.col("top.root").alias("main"), F.ceil(F.col("n") / spec.cell).cast("int").alias("rows"),
                                F.ceil((F.col("n") - F.col("top.n")) / spec.cell).cast("int").alias("fews"))


def _cells(members: DataFrame, few: DataFrame, payload: list[str]) -> DataFrame:
    """Both sides of each bucket's comparison, dealt to cells (key, i, j): all members by i, those of
    other components than the main one (side 0, sorted first) by j."""
    part = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = members.select("key", part("rows").alias("i"), every("fews").alias("j"), F.lit(1).alias("side"), "id", "root", *payload)
    fews = few.select("key", every("rows").alias("i"), part("fews").alias("j"), F.lit(0).alias("side"), "id", "root", *payload)
    return fews.unionByName(rows).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")


def _by_cell(batches, spec: NearDupSpec, extra=None):
    """(few, rows) of each cell; a row is (id, root, signature, extra)."""
    cell, few, rows = None, [], []
    for batch in batches:
        for part in steps(batch, 6 if extra is None else 7):
            sig, more = _sig_array(part.column(6), spec), extra(part.column(7)) if extra else [None] * part.num_rows
            cols = [part.column(k).to_pylist() for k in range(6)]
            for n, (key, i, j, side, node, root) in enumerate(zip(*cols)):
                if (key, i, j) != cell:
                    if few and rows:
                        yield cell, few, rows
                    cell, few, rows = (key, i, j), [], []
                (few if side == 0 else rows).append((node, root, sig[n].copy(), more[n]))
    if few and rows:
        yield cell, few, rows


def _likely_rows(one, ids, roots, sigs, plan):
    """Rows of other components that pass the sequential test against ``one``, best match first."""
    other = np.flatnonzero(roots != one[1])
    if not len(other):
        return other
    other = other[_survive(np.broadcast_to(one[2], (len(other), len(one[2]))), sigs[other], plan)]
    matches = (sigs[other] == one[2]).sum(1)
    return other[np.lexsort((ids[other], -matches))]


def _best_across(members: DataFrame, mixed: DataFrame, sigs: DataFrame, spec: NearDupSpec) -> DataFrame:
    """(key, id, a, b, likely): for members outside the main component that have likely partners
    in other components, the best one (a pair a > b) and how many there are."""
    plan = least_matches(spec)

    def run(batches):
        for (key, _, _), few, rows in _by_cell(batches, spec):
            ids, roots, sigs_ = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.stack([r[2] for r in rows])
            found = []
            for one in few:
                order = _likely_rows(one, ids, roots, sigs_, plan)
                if len(order):
                    best = int(ids[order[0]])
                    found.append((key, one[0], max(best, one[0]), min(best, one[0]), len(order)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["key", "id", "a", "b", "likely"])

    own = members.join(mixed, "key").join(sigs, "id")
    cells = _cells(own, own.where("root <> main"), ["sig"])
    return cells.mapInArrow(run, "key long, id long, a long, b long, likely long")


def _rest_across(members: DataFrame, mixed: DataFrame, undecided: DataFrame, sigs: DataFrame, texts: DataFrame, spec: NearDupSpec) -> DataFrame:
    """Links (a, b) between components among all likely pairs of the ``undecided`` (key, id).

    Confirmed on full sets inside the cell; of the links found there only those that join
    something new are returned, so rows grow with the members, not with their pairs.
    """
    plan = least_matches(spec)

    def run(batches):
        sets = lambda column: [x for x in _split(*shingles(column, spec.words)[:2])]
        for _, few, rows in _by_cell(batches, spec, sets):
            ids, roots, sigs_ = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.stack([r[2] for r in rows])
            up: dict[int, int] = {}

            def top(x):
                while (y := up.get(x, x)) != x:
                    x = y
                return x

            found = []
            for one in few:
                for k in _likely_rows(one, ids, roots, sigs_, plan).tolist():
                    if (x := top(one[1])) == (y := top(rows[k][1])):
                        continue
                    same = len(np.intersect1d(one[3], rows[k][3], assume_unique=True))
                    if 100 * same >= spec.percent * (len(one[3]) + len(rows[k][3]) - same):
                        up[max(x, y)] = min(x, y)
                        found.append((max(one[0], rows[k][0]), min(one[0], rows[k][0])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    open_keys = undecided.select("key").distinct()
    own = members.join(mixed, "key").join(open_keys, "key", "left_semi").join(sigs, "id").join(texts, "id")
    few = own.join(undecided.select("key", "id").distinct(), ["key", "id"], "left_semi")
    return _cells(own, few, ["sig", "text"]).mapInArrow(run, "a long, b long").distinct()


def _split(codes: np.ndarray, per: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum(per)
    return [codes[e - n:e].copy() for e, n in zip(ends.tolist(), per.tolist())]


def near_duplicates(docs: DataFrame, spec: NearDupSpec = NearDupSpec()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the least doc_id reachable over links), kept.

    Texts without words have no shingles and no links; a text of fewer words than a shingle
    has one shingle.  Rows of one doc_id count as one document: links of either bind
    both, and each has its own n_shingles.  A row without a doc_id is no link's end; it has a
    null component and is kept.  Empty tables give empty results; other columns of
    ``docs`` don't matter.
    """
    rows = materialize(sketched(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), spec), "sketches")
    worded = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = worded.groupBy("h1", "h2").agg(F.min("doc_id").alias("id"))
    members = materialize(worded.select("doc_id", "h1", "h2").join(same, ["h1", "h2"]).select("doc_id", "id").distinct(), "members")
    nodes = worded.join(same.select("id", "h1", "h2"), (F.col("doc_id") == F.col("id")) & worded["h1"].eqNullSafe(same["h1"]) & worded["h2"].eqNullSafe(same["h2"]))
    sigs = materialize(nodes.groupBy("id").agg(F.min("sig").alias("sig")), "signatures")

    every = materialize(_buckets(sigs, spec), "buckets")
    shared = every.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("key", "least")
    buckets = materialize(every.join(shared, "key").select("key", "id", "least"), "shared-buckets")
    ids = buckets.select("id").distinct()
    texts = materialize(docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).join(ids, "id", "left_semi").dropDuplicates(["id"]), "texts")

    stars = buckets.groupBy("id").agg(F.min("least").alias("b")).where("b < id").select(F.col("id").alias("a"), "b")
    near = materialize(_confirmed(materialize(_likely(stars, sigs, spec), "likely"), texts, spec), "near")
    roots = components(near, "a", "b")
    links = near
    while True:  # each node's best partner outside its component, until that joins nothing more
        members_of, mixed = _mixed(buckets.select("key", "id"), roots, spec)
        members_of, mixed = materialize(members_of.join(mixed, "key", "left_semi"), "members"), materialize(mixed, "mixed")
        best = materialize(_best_across(members_of, mixed, sigs, spec), "best")
        near = materialize(_confirmed(best.select("a", "b").distinct(), texts, spec), "near")
        if near.isEmpty():
            break
        links = links.union(near)
        roots = components(links, "a", "b")
    undecided = best.groupBy("key", "id").agg(F.sum("likely").alias("n")).where("n > 1")
    more = materialize(_rest_across(members_of, mixed, undecided, sigs, texts, spec), "near")
    # rows of one doc_id with several texts tie their nodes together
    tied = members.where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    tied = tied.join(sigs.select(F.col("id").alias("a")), "a", "left_semi")
    final = components(links.union(more).union(tied), "a", "b")
    of_doc = members.groupBy("doc_id").agg(F.min("id").alias("id")).join(final.withColumnRenamed("node", "id"), "id", "left").select(
        "doc_id", F.coalesce("root", "id").alias("component_id"))
    out = rows.select("doc_id", "n_shingles").join(of_doc, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def distinct_documents(docs: DataFrame, spec: NearDupSpec = NearDupSpec()) -> DataFrame:
    """``docs`` with one document of each component (that of the least doc_id); all columns unchanged.

    Rows that repeat a kept doc_id stay.
    """
    gone = near_duplicates(docs, spec).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
