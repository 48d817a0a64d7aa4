"""Window operators, sorts and top-k (w01-w03, o01-o04).

``row_number() <= n`` lets Catalyst insert a partial ``WindowGroupLimit``
before the shuffle, so each map task forwards at most ``n`` rows per key: a hot
key never ships all of its rows to one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str,
                   tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """w01: the newest row per key; ``tiebreak`` decides equal stamps (descending)."""
    order = [F.col(ts).desc()] + [F.col(t).desc() if isinstance(t, str) else t for t in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_by_max(df: DataFrame, keys: Sequence[str], ts: str,
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """w02: newest row per key as an aggregate: ``max_by(row, (ts, tiebreak...))``.

    Rows are combined before the shuffle, so a hot key is safe; Spark sorts on the keys for
    it (struct buffers take no hash aggregate), which :func:`latest_per_key` does too.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in (ts, *tiebreak)])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int,
                    rank_col: str | None = None) -> DataFrame:
    """w03: first ``n`` rows per group under ``order`` (make it total for determinism)."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


def sort_desc(df: DataFrame, col: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """o01: global descending sort (presentation only; range-partitioned sort).

    ``tiebreak`` columns make the order total; they also let the range
    partitioner split a heavily repeated value (e.g. every rank-1 row) across
    partitions instead of sending all of its rows to one.
    """
    return df.orderBy(F.col(col).desc(), *[F.col(t) for t in tiebreak])


def sort_by(df: DataFrame, *order: str | Column) -> DataFrame:
    """o02: multi-key mixed-direction sort."""
    return df.orderBy(*_order(order))


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """o03/o04: global top-k -> ``TakeOrderedAndProject`` (per-task heaps of k)."""
    return df.orderBy(*_order(order)).limit(k)


def order_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
               num_partitions: int | None = None) -> DataFrame:
    """First half of :func:`rank_in_groups`: range-partition on ``(keys, order)``
    so a hot group spans many partitions, sort each partition, and tag rows with
    their partition (``_pid``) and a partition-local increasing id (``_mid``).

    The result must be written once (``session.materialize``) before
    :func:`rank_from_runs` reads it: range bounds come from sampling, so only a
    stored copy guarantees every reader sees the same ids.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(k) for k in keys] + _order(order)
    ranged = df.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
    return ranged.withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})


def rank_from_runs(runs: DataFrame, keys: Sequence[str], out: str = "rank") -> DataFrame:
    """Second half of :func:`rank_in_groups` (lazy): per (partition, group) run
    counts form a small table (about groups + partitions rows) whose running sum
    in partition order is each run's offset; rank = offset + position in run."""
    counts = runs.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    r = counts.select(F.col("_pid").alias("_rpid"), *[F.col(k).alias(f"_r_{k}") for k in keys], "_off", "_first")
    cond = F.col("_pid") == F.col("_rpid")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    joined = runs.join(r, cond, "inner")
    rank = (F.col("_off") + F.col("_mid") - F.col("_first") + 1).cast("int")
    return joined.withColumn(out, rank).drop("_pid", "_mid", "_rpid", "_off", "_first",
                                             *[f"_r_{k}" for k in keys])


def rank_in_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "rank",
                   num_partitions: int | None = None) -> DataFrame:
    """Row number 1..n within each group under a total ``order``, safe for hot groups.

    ``row_number()`` over ``partitionBy(keys)`` sorts a whole group in one task;
    a group holding a third of all rows would stall one executor.  Here the
    group is split across range partitions (:func:`order_runs`), the tagged
    rows are written once to the shared checkpoint folder, and ranks are
    offsets plus positions (:func:`rank_from_runs`).
    """
    from rankflow.session import materialize

    return rank_from_runs(materialize(order_runs(df, keys, order, num_partitions), "rank-runs"), keys, out)
