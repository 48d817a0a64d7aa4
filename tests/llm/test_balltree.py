"""Ranked lexical search against brute force."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rankflow.llm import balltree, catalog

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    tf = [(i, Counter(terms(t))) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    n_docs, total = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for item, own in wanted.items():
        scores = []
        for i, c in tf:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [(1, "one two"), (2, "w3 W7 w11 w3, é 日本語"), (3, None), (4, "!!"), (5, "unknownword"), (6, "a b c f zz 123"), (6, "one"), (None, "z ONE"), (None, "two"), (7, "ÉCLAIR é")]


@pytest.mark.parametrize("spec", [balltree.SearchSpec(), balltree.SearchSpec(leaf=1, block_rows=5, item_entries=4), balltree.SearchSpec(block_entries=1, leaf=2),
                                  balltree.SearchSpec(top=2)])
def test_search_equals_brute_force(spark, odd, spec):
    docs = odd.select("doc_id", "text", "rows").unionByName(
        spark.createDataFrame([(50 + i, f"one {'two ' * (i % 3)} w{i % 7}", 0) for i in range(60)], "doc_id long, text string, rows int"))
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, score string")
    assert found(balltree.search(docs, items, spec)) == brute([(r.doc_id, r.text) for r in docs.collect()], ITEMS, spec.top)


def test_query_equals_brute_force(spark, sf):
    read = lambda name, key: [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(key, "text").collect()]
    assert found(catalog.op11_search(spark, sf)) == brute(read("documents", "doc_id"), read("benchmark", "item_id"))


def test_empty_tables(spark, odd, empty):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert found(balltree.search(empty, items)) == []
    assert found(balltree.search(odd, items.limit(0))) == []
    assert found(balltree.search(odd, items)) != []


@pytest.mark.parametrize("even", [True, False])
def test_subtrees_are_pruned_and_bounds_hold(even):
    """Of 2000 documents in 40 groups an item of one group's words scores a small part; bounds hold
    and results are right on any axes."""
    rng = np.random.default_rng(3)
    groups, own = 40, 12
    rows = [np.sort(rng.choice(own, 8, replace=False)) + own * (i % groups) for i in range(2000)]
    start, flat = np.arange(2001) * 8, np.concatenate(rows)
    parts = rng.integers(10**8, 10**9, len(flat))
    items = balltree.Items(pa.array([0, 1]), np.array([0, own, 2 * own]), np.arange(12, 12 + 2 * own), {str(i): i for i in range(groups * own)})
    spread = np.ones(groups * own) if even else rng.uniform(0.1, 9, groups * own)
    tree = balltree.BallTree(start, flat, parts, items, spread, balltree.SearchSpec(leaf=8))
    exact = np.array([[parts[s:s + 8][np.isin(flat[s:s + 8], items.of(k))].sum() for k in range(2)] for s in start[:-1]])
    for node in range(len(tree.low)):
        inside = tree.order[tree.low[node]:tree.high[node]]
        assert (exact[inside].max(axis=0) <= tree.bound[node]).all()
    best = balltree.Best(2, 10)
    for k in range(2):
        tree.search(k, best, list(range(2000)))
        assert [(-s, i) for s, _, i in best.lists[k]] == sorted(((int(exact[i, k]), i) for i in range(2000)), key=lambda e: (-e[0], e[1]))[:10]
    assert not even or tree.scored < 400  # of 4000
