"""Byte-level BPE against the tiktoken library."""

import hashlib

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from rankflow.llm import bpe, catalog


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.public_vocabulary()


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})


def test_merges_of_the_public_vocabulary_rise(vocabulary):
    assert vocabulary.merges_rise()  # joining a pair everywhere at once is exact then


def test_a_vocabulary_whose_merges_fall_is_told_apart():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"ab": 301, b"abc": 256}
    assert not bpe.Vocabulary(ranks, ".").merges_rise()
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0}, ".")


@pytest.mark.parametrize("words, hashed", [(0, 0), (40, 3000), (1 << 18, 1 << 21)])  # all words in rows, some in each place, none in rows
def test_ids_equal_the_library(spark, odd, vocabulary, library, words, hashed):
    texts = ["it's  a\t\ttest\n\n  of x1234567 'LL we'll", "é" * 300, "=" * 1000 + " " * 99, "日本語テキスト 𝔘𝔫𝔦 \u0000Āā ĀāĀ", "<|endoftext|>",
             "aaa aaa aaa bbb aaa", "a" * 5000, "zqxjk" * 40, "ñandú  x", "\r\n", "'s't're"]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    encoded = bpe.encode(docs, vocabulary, bpe.EncodeSpec(words=words, hashed=hashed, held=words, short=5 if words == 40 else 64)).persist()
    assert sorted((r.doc_id or -1, list(r.ids)) for r in encoded.collect()) == sorted((r.doc_id or -1, library.encode_ordinary(r.text or "")) for r in docs.collect())
    assert sorted((r.doc_id or -1, bytes(r.bytes)) for r in bpe.decode(encoded, vocabulary).collect()) == sorted((r.doc_id or -1, (r.text or "").encode()) for r in docs.collect())


def test_query_digests(spark, sf, library):
    got = {r.doc_id: r for r in catalog.op12_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4")
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())


def test_empty_table_and_unknown_ids(spark, empty, vocabulary):
    assert bpe.digests(empty, vocabulary).count() == 0
    for wrong in (50256, -1):
        with pytest.raises(Exception, match="not in the vocabulary"):
            bpe.decode(spark.range(1).select(F.col("id").alias("doc_id"), F.array(F.lit(wrong)).alias("ids")), vocabulary).collect()


def test_coarse_parts_hold_whole_words(vocabulary):
    """For every character: the pattern splits the coarse parts as it splits the text."""
    import regex

    find, coarse = regex.compile(vocabulary.pattern).findall, regex.compile(vocabulary.coarse)
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x32000)]):
        for text in (f"a{c}b {c} {c}1  {c}!\n{c}{c} \u2003x", f"{c} {c}"):
            assert find(text) == [w for part in coarse.findall(text) for w in bpe._words_of(part, find, True)], hex(ord(c))


@pytest.mark.parametrize("short", [0, 5, 64])
def test_many_words_at_once_equal_the_library(vocabulary, short):
    """Each word is encoded by itself, whatever stands before and after it."""
    rng = np.random.default_rng(4)
    whole = tiktoken.Encoding("whole", pat_str="(?s).+", mergeable_ranks=vocabulary.ranks, special_tokens={})
    words = ["", *("".join(rng.choice(list("aabceinost \n=é日𝔘\0"), rng.integers(1, top))) for top in (3, 12, 200) for _ in range(300)), "a" * 3001, "", "ab" * 999, "é" * 7, ""]
    ids, at = bpe.Merges(vocabulary, short).encode(words)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [whole.encode_ordinary(w) for w in words] and len(at) == len(words) + 1
    assert [x.tolist() for x in bpe.Merges(vocabulary, short).encode([])] == [[], [0]]


def test_short_words_join_the_leftmost_pair_of_any_vocabulary():
    """Merges that fall in rank: joining "ab" makes a pair, "aba", of lower rank than another "ab"."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"ba": 301, b"aba": 256}
    library = tiktoken.Encoding("falling", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
    words = ["abab", "ababab", "baab", "aabab"]
    ids, at = bpe.Merges(bpe.Vocabulary(ranks, "."), 64).encode(words)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [library.encode_ordinary(w) for w in words]


def test_the_plan_has_no_fold(spark, empty, vocabulary):
    """Words are encoded where their texts are: one pass of Python, no lambda over pieces."""
    plan = bpe.digests(empty, vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "lambda" not in plan
