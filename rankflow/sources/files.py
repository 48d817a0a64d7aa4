"""File scans and sinks (s01-s13).

CSV is only the edge format: scans use fixed schemas (no inference pass),
everything after is Parquet, partitioned by category/date where it helps
pruning.  No sink goes through the driver (no ``toPandas``/``collect``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow import schemas
from rankflow.functions.metrics import format_2dp
from rankflow.operators.aggregates import one_per_key
from rankflow.operators.relational import without_keys
from rankflow.sources.records import read_records

# Fixed value: category file-name pattern ("20241127-ranking-bags-summary.csv").
CATEGORY_FROM_FILE = "ranking-(.*?)-summary\\.csv"
UNKNOWN_CATEGORY = "unknown"


#: Every column that a snapshot file may name.
KNOWN_COLUMNS = tuple(dict.fromkeys(f.name for s in (schemas.RANKING, schemas.DETAIL) for f in s.fields))


def read_snapshot(spark: SparkSession, path: str | Sequence[str], kind: str = "ranking") -> DataFrame:
    """s01: CSV snapshot(s) with header, conformed by name to the fixed schema.

    Each file is read through its own header, so files whose header differs in case
    (``ProductID``) or column order line up, and quoted fields may hold newlines
    (``sources.records``).
    """
    raw = read_records(spark, path, KNOWN_COLUMNS, glob="*").drop("_file")
    return schemas.conform(schemas.normalise_columns(raw), schemas.SCHEMAS[kind])


def category_from_filename(name: Column | str) -> Column:
    """s03: category from a file name; ``unknown`` when the pattern is absent."""
    c = F.col(name) if isinstance(name, str) else name
    got = F.regexp_extract(c, CATEGORY_FROM_FILE, 1)
    return F.when(got == "", F.lit(UNKNOWN_CATEGORY)).otherwise(schemas.normalise_category(got))


def read_tree(spark: SparkSession, root: str, kind: str = "ranking",
              categories: Iterable[str] | None = None, by_name: bool = False) -> DataFrame:
    """s02-s04: every ``*.csv`` below ``root`` (recursive), each through its own header.

    The category comes from each file's name when the file has none, and an
    include-list keeps these categories.  With ``by_name`` file names are trusted: files whose
    name gives a category outside the list are left out when files are listed and never opened
    (rows of a listed category in them too).
    """
    only = None
    if by_name and categories is not None:
        categories = list(categories)
        only = lambda name: category_from_filename(name).isin([*categories, UNKNOWN_CATEGORY])
    df = schemas.normalise_columns(read_records(spark, root, KNOWN_COLUMNS, only=only))
    df = df.withColumn("category", F.coalesce("category", category_from_filename("_file")))
    out = schemas.conform(df, schemas.SCHEMAS[kind], extra=("category",))
    return out if categories is None else filter_categories(out, categories)


def filter_categories(df: DataFrame, categories: Iterable[str], col: str = "category") -> DataFrame:
    """s04: include-list; on a category-partitioned table this prunes partitions."""
    return df.filter(F.col(col).isin(list(categories)))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                fmt: str = "parquet") -> str:
    """s07: distributed table write (Parquet by default), overwrite."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_observed(df: DataFrame, path: str, ranges: Sequence[str] = (), partition_by: Sequence[str] = (), mode: str = "overwrite") -> dict[str, object]:
    """s07 with a12/a14: writes the table and returns what was seen on the way: ``rows``, ``nulls.<column>``
    of each column, and ``min.<column>``, ``max.<column>`` of ``ranges``.  There is no second scan."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"nulls.{c}") for c in df.columns]]
    for c in ranges:
        metrics += [F.min(c).alias(f"min.{c}"), F.max(c).alias(f"max.{c}")]
    write_table(df.observe(seen, *metrics), path, partition_by, mode)
    return seen.get


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int,
                   partition_by: Sequence[str] = ()) -> DataFrame:
    """s07 variant: a table bucketed (and sorted) by ``keys`` at ``path``.

    Two tables bucketed the same way on the join keys join without a shuffle
    (sort-merge over matching buckets).  Rows are first hash-partitioned into
    ``buckets`` tasks so each bucket is one file per partition value, not one
    per writing task.  Returns the catalog table (its scan carries the
    bucketing).
    """
    spark = df.sparkSession
    w = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.option("path", path).saveAsTable(name)
    return spark.table(name)


def flatten_arrays(df: DataFrame, sep: str = ",") -> DataFrame:
    """Arrays become ``sep``-joined text (CSV cannot hold arrays)."""
    cols = [F.concat_ws(sep, F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> str:
    """s08: distributed CSV with header; array columns flattened to text.  Quotes inside a field are
    doubled, so fields may hold quotes, commas and newlines."""
    flatten_arrays(df, sep).write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def append_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ("category", "date")) -> str:
    """s09: append-only snapshot log, partitioned for pruning; no dedupe."""
    return write_table(df, path, partition_by=partition_by, mode="append")


def append_distinct(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str] | None = None,
                    partition_by: Sequence[str] = (), range_col: str | None = None) -> None:
    """s10: append only rows not already stored (full row, or ``keys`` when given).

    The new batch keeps one row per key (the least; a null key equals a null key) and is
    anti-joined against what is stored, then appended: stored files are never rewritten, so a
    failed run leaves them intact.  With ``range_col`` (e.g. the snapshot date the table is
    partitioned by) only stored rows inside the batch's [min, max] of that column are read, so the
    check does not grow with the whole history.  ``sources.ledger`` makes a delivery atomic too.
    """
    from rankflow.session import materialize, path_exists

    new = materialize(one_per_key(df, keys) if keys else df.distinct(), "append")  # range and rows are of one pick
    # Only a missing path means that nothing is stored; a store that can't be read raises.
    existing = spark.read.parquet(path) if path_exists(spark, path) else None
    if existing is not None:
        if range_col is not None:
            lo, hi = new.agg(F.min(range_col), F.max(range_col)).first()  # two values
            existing = existing.filter(F.col(range_col).isNull() | F.col(range_col).between(lo, hi))
        new = without_keys(new, existing, keys) if keys else new.subtract(existing.select(*new.columns))
    write_table(new, path, partition_by=partition_by, mode="append")


def publish(spark: SparkSession, src_root: str, dst: str, kind: str = "ranking",
            partition_by: Sequence[str] = ("category",)) -> str:
    """s11: land a folder of CSV snapshots in the lake as partitioned Parquet; a delivery
    overwrites the partitions it holds and leaves the others."""
    df = read_tree(spark, src_root, kind)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(dst)
    return dst


def to_tsv_lines(df: DataFrame, cols: Sequence[str], two_dp: Sequence[str] = (), none: str = "None") -> DataFrame:
    """s12: one tab-separated text line per row; NULL prints as ``None``,
    ``two_dp`` columns as ``%.2f``.  Write it with ``df.write.text`` (no collect)."""
    parts = []
    for c in cols:
        v = format_2dp(c) if c in two_dp else F.col(c).cast("string")
        parts.append(F.coalesce(v, F.lit(none)))
    return df.select(F.concat_ws("\t", *parts).alias("value"))


def preview(df: DataFrame, n: int = 20) -> None:
    """s13: print the first rows (driver display of a bounded sample)."""
    df.show(n, truncate=False)
