"""The corpus pipeline: raw documents to a token store, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's ``docs``; all but the last return the columns of
``documents``.  Tables beside the documents are read from ``sf_dir``.  A stage that begins
removes the scratch tables of the one before it, whose result it reads as written.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankflow.llm import decontaminate, mixing, neardup, tokens, toxicity
from rankflow.session import materialize, remove_scratch, scratch_scope


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Scratch tables of the stage before.
_HELD: list[str] = []


def _stage(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``stage`` with its scratch tables kept until the next one begins.  Tables that ``docs`` itself
    reads stay (a caller that has not written the result before)."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if stage.__name__ != "without_toxic":  # the first one follows nothing
            read = docs.inputFiles()
            remove_scratch(spark, [p for p in _HELD if not any(p in file for file in read)])
        with scratch_scope() as made:
            out = stage(spark, docs, sf_dir)
        _HELD[:] = made
        return out

    return run


@_stage
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.clean_documents(docs, _table(spark, sf_dir, "labels"))


@_stage
def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the least id stays."""
    return neardup.distinct_documents(docs)


@_stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    return decontaminate.clean_documents(docs, _table(spark, sf_dir, "benchmark")).select(*docs.columns)


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it: 0 to 3 times."""
    return mixing.repeated(docs)


@_stage
def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written to a store in the shared folder; its index, read from the store."""
    path = tokens.store_path(spark)
    tokens.write_tokens(docs, path)
    return tokens.token_index(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near-duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("tokens", tokenized),
]

#: The stages fit models, solve for rates and run a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs, before = _table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with scratch_scope() as made:
            docs = stage(spark, docs, sf_dir)
        with scratch_scope() as result:
            docs = materialize(docs, f"stage-{name}")
        remove_scratch(spark, [*made, *before])  # the result is written
        before = result
    _HELD.clear()
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(spark, sf_dir)

    return {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
