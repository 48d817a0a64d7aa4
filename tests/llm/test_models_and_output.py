"""Classifiers on held-out rows, token stores as exact round trips, mixing against its contract, the pipeline."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from rankflow.llm import huffman, langid, mixing, subword, tokens, toxicity


def crc(i):
    return zlib.crc32(str(i).encode())


def test_language_held_out(spark, sf, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    rows = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    own = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in own) >= 0.98 * len(own)
    by = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert by[1].lang_pred == by[2].lang_pred == by[11].lang_pred == "und" and by[10].lang_pred != "und" and by[1].score == 0
    assert langid.identify(empty, model).count() == 0 and langid.train(empty) is None
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}


def test_toxicity_learns_misspellings(spark):
    rng = random.Random(1)
    clean = [f"{a}{b}" for a in ("ba", "ko", "li", "mu", "ne", "ro", "ta") for b in ("rin", "sel", "dor", "mik", "pan")]
    bad = ["worthless", "disgusting", "pathetic"]
    text = lambda extra: " ".join(sorted([rng.choice(clean) for _ in range(40)] + extra, key=lambda _: rng.random()))
    rows = [(i, text([rng.choice(bad) for _ in range(2)]) if i % 4 == 0 else text([]), int(i % 4 == 0)) for i in range(600)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    spec = toxicity.ToxicitySpec(features=subword.SubwordSpec(sizes=(2, 3, 4), buckets=1 << 14, epochs=12, rate=1.8, squash=0.7, per_class=300))
    model = toxicity.train(docs, labels, spec)
    got = {r.doc_id: r for r in toxicity.score(docs, model, spec).collect()}
    own = [i for i, _, _ in rows if crc(i) % 5 == 0]
    assert all(got[i].held_out == (crc(i) % 5 == 0) for i in got)
    assert np.mean([got[i].predicted == rows[i][2] for i in own]) >= 0.95
    new = spark.createDataFrame([(1, text(["worthles", "disgustingg"])), (2, text([])), (3, None), (4, "")], "doc_id long, text string")
    out = {r.doc_id: r for r in toxicity.score(new, model, spec).collect()}
    assert out[1].predicted == 1 and out[2].predicted == 0 and 0 <= out[3].score <= 1 and out[3].score == out[4].score
    assert sorted(r.doc_id for r in toxicity.clean_documents(docs, labels, spec).collect() if crc(r.doc_id) % 5 == 0) == [i for i in own if not got[i].predicted]
    assert toxicity.train(docs, labels.limit(0), spec) is None
    assert {r.score for r in toxicity.score(new, None, spec).collect()} == {0.0}


@pytest.mark.parametrize("n,limit", [(1, 18), (2, 18), (3, 4), (300, 9), (5000, 14)])
def test_huffman_round_trip(n, limit):
    rng = np.random.default_rng(n)
    counts = rng.zipf(1.3, n) % 10**6
    counts[0] += 1
    lengths = huffman.code_lengths(counts, limit)
    used = np.flatnonzero(lengths)
    assert lengths.max() <= max(limit, int(np.ceil(np.log2(max(2, n))))) and (n == 1 or abs((2.0 ** -lengths[used].astype(float)).sum() - 1) < 1e-9)
    for m in (0, 1, 127, 128, 129, 3000):
        ids = rng.choice(used, m)
        stream, marks, _ = huffman.encode(ids, lengths, huffman.canonical(lengths))
        assert (huffman.decode(stream, marks, m, huffman.decode_table(lengths)) == ids).all()


def test_words_give_the_tokenizers_ids():
    words = tokens.WordTokenizer(tokens.tokenizer_path("word_bpe_49k.json"))
    texts = ["", "  ", "a\x0bb\x0cc", "don't STOP  é ÉÉ é á̀", "x y z\x85w", "<|startoftext|> hi<|endoftext|>bye <|x", "日本語 12345 1½ ΣΑΣ İ ŉ",
             "'s 't 're'll we'd it's.", "\n a \t\r\nb ", "́abc ́", "﻿abc​def", "ÀÉÎ, Straße. ÿ... Ø.x ab,.,c ªº µm ß. K", "tail., ., ... A$$$ b_c d- -e"]
    for _ in range(2):  # the second time from memory
        ids, per = words.encode(pa.array(texts), 2)
        want = [words.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        assert [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])] == want


def test_token_store_round_trip(spark, odd, empty, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd.select((odd["doc_id"] + 10**6).alias("doc_id"), "text"))
    path, words = tokens.store_path(spark), tokens.WordTokenizer(tokens.tokenizer_path("word_bpe_49k.json"))
    tokens.write_tokens(docs, path, tokens.TokenSpec(block_tokens=3000))
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(words.tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2])
    stored = tokens.read_tokens(spark, path).orderBy("part", "seq", "pos").collect()
    assert [r.doc_id for r in stored] == sorted((r.doc_id for r in stored), key=lambda x: (x is not None, x))
    got = {}
    for r in stored:
        got.setdefault(r.doc_id, []).append(r.ids)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    index = sorted(tokens.token_index(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for r, s in zip(index, stored):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (s.doc_id, at, len(s.ids), zlib.crc32(np.array(s.ids, "<u4").tobytes()))
        at += r.n_tokens
    none = tokens.store_path(spark)
    tokens.write_tokens(empty, none)
    assert tokens.token_index(spark, none).count() == 0


def test_mix_meets_targets(spark, odd, empty):
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice([0, 1, 3, 20, 100, 400]), rng.choice(["a", "b", "c", "c", "c", "d", None])) for i in range(600)] + [(999, "w w", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    size = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in {r[2] for r in rows}}
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight, target, free = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, {}, set(names)
    while True:
        level = (sum(size.values()) - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * size[s]]
        if not over:
            break
        target |= {s: 3 * size[s] for s in over}
        free -= set(over)
    target |= {s: level * weight[s] for s in free}
    for s in names:
        own = [r for r in out if r.source == s]
        assert all(r.source_size == size[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s]) and 0 <= r.taken <= 3 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - target[s]) <= 0.01 * target[s] + 2
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(docs.orderBy("text").repartition(3)).collect()))
    assert mixing.mix(empty).count() == 0 and mixing.mix(odd).count() == odd.count()
    named = mixing.repeated(odd.withColumnsRenamed({"rows": "_n", "copies": "_size", "b": "_copy"}))  # names that the operator uses itself
    assert named.where("_n <> 8 OR _size <> 7 OR _copy <> 9").isEmpty() and named.count() == mixing.repeated(odd).count()
    again = mixing.repeated(odd)
    assert again.columns == odd.columns and again.count() == sum(r.copies for r in mixing.mix(odd).collect())


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near-duplicates", "decontamination", "mixing", "tokens"]
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() > 0
        assert out.select("doc_id").subtract(docs.select("doc_id")).isEmpty()
        docs = out
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
