"""Near-duplicates, components and suffix dedup against brute force."""

import hashlib
import random

import numpy as np

from rankflow.llm import neardup, suffixes
from rankflow.llm.components import components


def sets(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < 5 else frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def roots(rows):
    up = {i: i for i, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    shingles = [(i, sets(t)) for i, t in rows]
    for k, (i, x) in enumerate(shingles):
        for j, y in shingles[:k]:
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return {i: top(i) for i in up}


def near_copies(seed, n, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9999)}"
        out.append(" ".join(words))
    return out


def test_neardup_matches_brute_force(spark):
    texts = near_copies(1, 60, 9) + near_copies(2, 20, 5) + ["a b c", "A b  c", "", None, "one", "a b c d e f g"] + [f"own text number {i} of this kind {i * i}" for i in range(20)]
    rows = list(enumerate(texts))
    random.Random(3).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = roots(rows)
    for spec in (neardup.NearDupSpec(), neardup.NearDupSpec(cell=7)):  # cells smaller than the groups
        got = {r.doc_id: r for r in neardup.near_duplicates(docs, spec).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
        assert all(r.kept == (r.component_id == i) and r.n_shingles == len(sets(dict(rows)[i])) for i, r in got.items())


def test_neardup_odd_rows(odd, empty):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[5].component_id == 4 and by[7].component_id == 6 and by[9].component_id == 8
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[3].kept
    assert by[None].component_id is None and by[None].kept
    kept = neardup.distinct_documents(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 6, 8, 10, 11, None, 12}
    assert neardup.near_duplicates(empty).count() == 0


def test_sequential_test_keeps_pairs_at_the_bound():
    spec = neardup.NearDupSpec()
    rng = np.random.default_rng(0)
    left = rng.integers(0, 1 << 32, (20_000, spec.hashes), dtype=np.uint32)
    right = np.where(rng.random(left.shape) < 0.85, left, left + np.uint32(1))
    assert len(neardup._survive(left, right, neardup.least_matches(spec))) >= 19_995
    far = np.where(rng.random(left.shape) < 0.5, left, left + np.uint32(1))
    assert len(neardup._survive(left, far, neardup.least_matches(spec))) <= 5


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (205, 203), (204, 205)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "p long, q long"), "p", "q").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{k: 100 for k in range(101, 160)}, 204: 203, 205: 203}


def brute(rows, length):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if data[i:i + length] in seen:
                gone[i:i + length] = True
            seen.add(data[i:i + length])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(bool(g) and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_suffixes_match_brute_force(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefé \n") for _ in range(500))
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    rows = [(1, base), (2, base[50:300] + "x" + base[301:]), (3, "a" * 400), (4, "ab" * 200 + "a" * 200), (5, None), (6, ""), (7, base[:80]),
            (8, "é" * 150), (9, base + base), (10, noise(30) + base[200:330] + noise(9) + base[200:310])]
    rows += [(20 + i, noise(50) + base[100:180 + i] + noise(50)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for spec in (suffixes.RepeatSpec(), suffixes.RepeatSpec(group=3, bucket_bytes=2000, step_bytes=700), suffixes.RepeatSpec(length=30, gram=8)):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(docs, spec).collect()}
        assert got == brute(rows, spec.length)


def test_suffixes_odd_rows(odd, empty):
    rows = suffixes.remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].n_bytes == by[2].n_bytes == 0 and by[6].n_removed < by[6].n_bytes and by[7].n_removed >= by[6].n_bytes
    assert suffixes.remove_repeats(empty).count() == 0


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    keys = [rng.integers(0, n, 5000) for n in (3, 5, 1000)]
    assert (suffixes.multikey_quicksort(keys, small=16) == np.lexsort(keys[::-1])).mean() > 0.9  # ties aside
    order = suffixes.multikey_quicksort(keys, small=16)
    rows = list(zip(*(k[order].tolist() for k in keys)))
    assert rows == sorted(rows)
