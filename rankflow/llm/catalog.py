"""The queries of the corpus operators: name -> builder, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm import balltree, bpe, decontaminate, langid, licenses, mixing, neardup, quality, secrets, spelling, suffixes, tokens, toxicity
from rankflow.llm.oracles import ORACLES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs)).select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.store_path(spark)
    tokens.write_tokens(_table(spark, sf_dir, "documents"), path)
    return tokens.token_index(spark, path)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    n_base = F.aggregate("base_counts", F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", "n_words", n_base.alias("n_base"), "first_word", "last_word", "base_labels", "labels", "score")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(_table(spark, sf_dir, "documents")).drop("n_linked")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), bpe.public_vocabulary())


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_neardup, op2_decontaminate, op3_suffixes, op4_quality, op5_language, op6_tokens, op7_mixing, op8_licenses, op9_secrets, op10_toxicity,
                            op11_search, op12_bpe, op13_spelling)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
