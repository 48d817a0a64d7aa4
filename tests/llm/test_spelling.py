"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rankflow.llm import catalog, spelling


def brute(rows, spec=spelling.VariantSpec()):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % spec.every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= spec.letters and n >= spec.least}
    by_key, near = defaultdict(set), defaultdict(set)
    for w in words:  # words that share one deletion, or one is the other's
        for key in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by_key[key].add(w)
    for group in by_key.values():
        for u in group:
            near[u] |= {v for v in group if u != v and (spelling.near(u, v) or spelling.near(v, u))}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= spec.ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


TEXTS = ["orantion " * 300 + "orantio orantio orantion Orantian orantian ORANTION's oranton",  # links of forms
         "oranton orantn orantn " * 3, "listening " * 40 + "silenting tensiling listenin listenin silenting tensiling",  # equal vectors
         "éclaircie éclairciÉ éclaircie ÷÷÷÷÷÷÷×× ÷÷÷÷÷÷÷×× ÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿÿ",
         ("a" * 60 + " ") * 2 + ("a" * 61 + " ") * 30 + ("a" * 30 + "b" + "a" * 29 + " ") * 2, "short words", None, "", "aaaaaaab aaaaaaab baaaaaaa baaaaaaa aaaaaaaa " * 2]


@pytest.mark.parametrize("spec", [spelling.VariantSpec(), spelling.VariantSpec(bucket=1, leaf=1, counted=3, compared=2), spelling.VariantSpec(groups=2, bucket=3),
                                  spelling.VariantSpec(every=2, least=1, ratio=2)])
def test_variants_equal_brute_force(spark, odd, spec):
    rows = [*enumerate(TEXTS), (0, TEXTS[0]), (None, TEXTS[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd, allowMissingColumns=True)
    assert found(spelling.variants(docs, spec)) == brute([(r.doc_id, r.text) for r in docs.collect()], spec)


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert found(catalog.op13_spelling(spark, sf)) == brute([(r.doc_id, r.text) for r in docs])


def test_empty_table(spark, empty):
    assert found(spelling.variants(empty)) == []


def test_search_prunes(spark):
    """Of 4000 random words a leaf is compared with the few that can still be near it."""
    rng = np.random.default_rng(1)
    words = sorted({"".join(rng.choice(list("abcdefghijklmnopqrst"), 9)) for _ in range(4000)})
    group = np.arange(256) % 12
    vector = spelling.vectors(words, group, 12)
    who, _ = spelling.Trie(words, vector, 12).search(vector)
    assert len(who) < 40 * len(words)
