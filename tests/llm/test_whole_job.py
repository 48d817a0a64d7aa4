"""Whole samples, all places and all rows: what the operators once left out."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F
from test_pairs import brute
from test_text_rules import brute_hits

from rankflow.llm import decontaminate, licenses, quality, subword, suffixes, toxicity


def crc(i):
    return zlib.crc32(str(i).encode())


def test_toxicity_sample_takes_3000_texts_a_label(spark):
    ids = [i for i in range(8100) if crc(i) % 5]
    docs = spark.createDataFrame([(i, f"word{i % 7} other{i}") for i in ids], "doc_id long, text string")
    spec = toxicity.ToxicitySpec()
    bags, y, order, counts = subword.sampled_bags(docs, (F.col("doc_id") % 2).cast("int"), F.lit(True), spec.features)
    assert min(counts.values()) > 3000 and [y.count(0), y.count(1)] == [3000, 3000] and len(bags) == 6000 and order == sorted(order)


def test_packed_bags_lose_nothing():
    made = subword.bags(pa.array(["ab ab cde", "", "é " * 30 + "x" * 500, "!!"]), subword.SubwordSpec(buckets=1 << 17, squash=0.7))
    press = zstandard.ZstdCompressor()
    held = subword.PackedBags(pa.chunked_array([[subword._packed(b, press) for b in made[:1]], [subword._packed(b, press) for b in made[1:]]]), [3, 2, 1, 0])
    for (ids, weights), (want_ids, want_weights) in zip(held, made[::-1]):
        assert ids.dtype == np.int32 and (ids == want_ids).all() and weights.dtype == np.float32 and (weights == want_weights).all()


def test_texts_without_common_words_of_their_language_are_rejected(spark):
    rng = random.Random(4)
    letters = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(4, 9)))
    own = {x: quality.COMMON_WORDS[x].split() for x in ("en", "de")}

    def prose(lang, n=400):
        return " ".join(rng.choice(own[lang]) if k % 4 == 0 else letters() for k in range(n))

    rows = [(2 * i + k, prose(x), x) for i in range(60) for k, x in enumerate(("en", "de"))]
    planted = {1000: " ".join(letters() for _ in range(300)), 1001: "\n".join(letters() for _ in range(300)),
               1002: prose("de"), 1003: " ".join(f"the&&& {letters()}" for _ in range(200)), 1004: " - " * 200}
    marked = {2000: prose("en").replace(" ", "\n"), 2001: prose("en").replace(" ", "\t"), 2002: prose("en").replace(" ", "), ("),
              2003: "“" + prose("en").replace(" ", "”\r\n- “") + "”"}
    other = {3000: " ".join(letters() for _ in range(300))}  # a language without a list is not judged by lists
    table = rows + [(i, t, "en") for i, t in (planted | marked).items()] + [(3000, other[3000], "fi"), (3001, other[3000], None)]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string")
    rules = quality.QualityRules(max_repeat_percent=100, max_class_distance=1.0)  # the words alone decide
    got = {r.doc_id: r for r in quality.quality(docs, rules).collect()}
    assert not any(got[i].kept for i in planted)
    assert all(got[i].kept for i in [r[0] for r in rows] + list(marked) + [3000, 3001])
    plain = got[0].word_distance
    assert all(got[i].word_distance < plain + 0.1 for i in marked)


def strings(parsed):
    """Strings that a parsed pattern matches: each branch, repeats none or once, ends of ranges."""
    out = [""]
    for op, arg in parsed:
        kind = str(op)
        some = {"LITERAL": lambda a: [chr(a)], "IN": lambda a: [chr(x if str(o) == "LITERAL" else x[0]) for o, x in a],
                "SUBPATTERN": lambda a: strings(a[3]), "BRANCH": lambda a: [x for b in a[1] for x in strings(b)],
                "MAX_REPEAT": lambda a: [x * k for k in {a[0], min(a[1], max(a[0], 1))} for x in strings(a[2])], "ASSERT": lambda a: [" "]}[kind](arg)
        out = [x + y for x in out for y in some]
    return out


def test_license_keywords_are_part_of_every_match():
    for r in licenses.rules():
        found = strings(re._parser.parse(r["pattern"]))
        assert found and all(r["keyword"] in x and re.search(r["pattern"], x) for x in found), r


def test_licenses_are_found_without_other_words(spark):
    cases = [("Creative Commons Zero", "cc0"), ("CC Zero", "cc0"), ("see https://creativecommons.org/publicdomain/zero/1.0/", "cc0"),
             ("released under the Expat license", "mit"), ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
             ("ASL 2.0", "apache-2"), ("Unless required by applicable law or agreed to in writing, software", "apache-2"), ("PSF license", "psf-2"),
             ("made available under the Open Database License", "odbl-1"), ("Berkeley License", "bsd"), ("zero-clause BSD", "0bsd"),
             ("Unauthorized copying of this file, via any medium, is strictly prohibited", "proprietary"), ("free and unencumbered software", "unlicense"),
             ("No part of this book may be reproduced", "all-rights-reserved"), ("opensource.org/licenses/MS-PL", "ms-pl")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(docs).collect()}
    assert [got[i] for i in range(len(cases))] == [x for _, x in cases]


def test_a_row_listed_twice_keeps_its_text(spark):
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    base = noise(500)
    rows = [(1, base), (2, noise(400)), (3, noise(60) + base[100:300] + noise(60)), (4, noise(90) + base[150:280] + noise(300)), (5, "ab" * 200)]
    rows += [(20 + i, noise(50) + base[100:180 + i] + noise(50)) for i in range(30)]
    want = brute(rows, 100)
    docs = spark.createDataFrame(rows + [r for r in rows if r[0] in (1, 2, 4, 5, 25)], "doc_id long, text string")
    for spec in (suffixes.RepeatSpec(), suffixes.RepeatSpec(group=3, bucket_bytes=2000, step_bytes=700)):
        got = suffixes.remove_repeats(docs, spec).collect()
        assert len(got) == len(rows) + 5
        assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in got)


def test_rows_are_judged_alone_at_any_number_of_automata(spark):
    item = " ".join(f"q{i % 9}" for i in range(30))
    items = [("b", item), ("a", "short one here"), ("c", item.upper()), ("c", "another text of c"), ("g", "q1 q2 q3 " * 6), (None, "lost words"), (None, "other lost ones")]
    rows = [(1, item), (1, "x " * 300), (1, "x " * 300), (None, "short one here"), (None, "clean words"), (None, None), (2, "some lost words"),
            (2, "other lost ones and lost words and q1 q2 q3"), (3, "another text of c " + item), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id string, text string")
    want = []
    for i, text in rows:
        n, hit, found = brute_hits(text, [(str(k), t) for k, t in enumerate(t for _, t in items)])
        ids = {items[int(k)][0] for k in found}
        want.append((str(i), n, hit, sorted(ids - {None}), len(ids), hit > 0 and 20 * hit >= n))
    for rules in (decontaminate.ContaminationRules(), decontaminate.ContaminationRules(shard_words=20)):
        got = decontaminate.contamination(docs, table, rules).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"], r.n_items, r.contaminated) for r in got) == sorted(want)
    got = decontaminate.contamination(docs, table.limit(0)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit) for r in got) == sorted((i, n, 0) for i, n, *_ in want)
