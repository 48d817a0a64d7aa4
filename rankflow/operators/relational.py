"""Projections, filters, joins and set operations (p01-p12, j01-j06, u01-u05).

Joins are plain equi-joins: Catalyst/AQE pick broadcast only when the measured
side is under the configured threshold, else sort-merge with skew splitting.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.functions.metrics import stamp_prefix
from rankflow.operators.aggregates import one_per_key

SNAPSHOT_KEY = ("productId", "date")


# -- projections / filters -------------------------------------------------

def drop(df: DataFrame, *cols: str) -> DataFrame:
    """p01: drop columns (pruned from the scan by Catalyst)."""
    return df.drop(*cols)


def project(df: DataFrame, *cols: str | Column) -> DataFrame:
    """p02: column projection."""
    return df.select(*cols)


def non_empty(df: DataFrame, col: str) -> DataFrame:
    """p03: keep rows whose array is non-empty; NULL arrays drop too (size(NULL) is NULL)."""
    return df.filter(F.size(col) > 0)


def at_snapshot(df: DataFrame, stamp: str | int, col: str = "date", width: int = 10) -> DataFrame:
    """p05: rows whose stamp shares the first ``width`` characters with ``stamp``."""
    return df.filter(stamp_prefix(col, width) == F.lit(str(stamp)[:width]))


def at_stamp(df: DataFrame, value: int, col: str = "date") -> DataFrame:
    """p06: coerce to a number, drop rows that fail, keep equality matches."""
    n = F.col(col).cast("string").try_cast("bigint")
    return df.filter(n.isNotNull() & (n == F.lit(value)))


def label_top(df: DataFrame, col: str = "ranking", k: int = 150, out: str = "recommend") -> DataFrame:
    """p07: ``1 if col <= k else 0``."""
    return df.withColumn(out, F.when(F.col(col) <= k, 1).otherwise(0))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """p08: constant fill per column (NULL -> default)."""
    return df.fillna(dict(defaults))


def for_category(df: DataFrame, category: str, col: str = "category") -> DataFrame:
    """p09: one category's rows (pushed to the scan / partition pruned)."""
    return df.filter(F.col(col) == F.lit(category))


def stamp(df: DataFrame, **constants: object) -> DataFrame:
    """p10: add constant columns such as the snapshot date and category
    (integers as BIGINT, like the snapshot schemas)."""
    def lit(v: object) -> Column:
        return F.lit(v).cast("bigint") if isinstance(v, int) and not isinstance(v, bool) else F.lit(v)

    return df.withColumns({k: lit(v) for k, v in constants.items()})


def copy_column(df: DataFrame, src: str, dst: str) -> DataFrame:
    """p11: the same values under a new name."""
    return df.withColumn(dst, F.col(src))


def where_all(df: DataFrame, *conds: Column) -> DataFrame:
    """p12: conjunction of predicates built with ``& | ~ isin isNull``."""
    return df.filter(functools.reduce(lambda a, b: a & b, conds))


# -- joins -------------------------------------------------------------------

def join_snapshots(ranking: DataFrame, detail: DataFrame,
                   keys: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """j01: inner join of ranking and detail snapshots on the composite key.

    Detail rows are reduced to one per key first, the least (a product can appear in
    several category files, which would fan the join out), and a detail-side
    ``totalSales`` is kept as ``detailTotalSales`` so the ranking side wins.
    """
    d = detail
    if "totalSales" in d.columns and "totalSales" in ranking.columns:
        d = d.withColumnRenamed("totalSales", "detailTotalSales")
    return ranking.join(one_per_key(d, keys), on=list(keys), how="inner")


def join_on(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
            how: str = "inner") -> DataFrame:
    """j02: ON-semantics equi-join with qualified (aliased) sides, both keys kept."""
    l, r = left.alias("l"), right.alias("r")
    cond = functools.reduce(lambda a, b: a & b,
                            [F.col(f"l.{a}") == F.col(f"r.{b}") for a, b in zip(left_keys, right_keys)])
    return l.join(r, cond, how)


def join_keywords(rankings: DataFrame, keywords: DataFrame, key: str = "productId") -> DataFrame:
    """j03/j04: rankings x keywords on the product key; ``productName`` kept from rankings."""
    k = keywords.drop("productName") if "productName" in rankings.columns else keywords
    return rankings.join(k, on=key, how="inner")


def without_keys(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key ``stored`` lacks; a null key equals a null key."""
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return new.alias("n").join(stored.select(*keys).alias("s"), functools.reduce(lambda a, b: a & b, same), "left_anti").select("n.*")


def not_yet_collected(new: DataFrame, done: DataFrame, keys: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """j05: rows of ``new`` whose key is absent from ``done`` (left anti join).  As in SQL a null key
    equals none, so such rows are always to be collected; :func:`without_keys` is null-safe."""
    return new.join(done.select(*keys), on=list(keys), how="left_anti")


def already_collected(new: DataFrame, done: DataFrame, keys: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """j06: rows of ``new`` whose key is already in ``done`` (left semi join)."""
    return new.join(done.select(*keys), on=list(keys), how="left_semi")


# -- set operations ------------------------------------------------------------

def union_all(dfs: Iterable[DataFrame]) -> DataFrame:
    """u01/u02/u04: UNION ALL by column name (missing columns NULL)."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def except_rows(df: DataFrame, other: DataFrame) -> DataFrame:
    """u03: EXCEPT DISTINCT."""
    return df.subtract(other)


def key_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """u05: INTERSECT DISTINCT of the key sets."""
    return a.select(*keys).intersect(b.select(*keys))
