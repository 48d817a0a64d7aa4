"""Aggregations (a01-a14).

Every grouping is a hash aggregate with a map-side partial step, so a key that
holds a third of all rows is pre-combined before the shuffle.  Nothing collects
an unbounded group: ``collect_list`` is only used per product (bounded by the
tokens of one name) and scalar results stay inside the plan as subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.functions.metrics import round_half_even


def dedupe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """a01/a02: distinct rows on a column subset (``None`` = full row)."""
    return df.dropDuplicates(list(cols)) if cols else df.distinct()


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the least in the order of the other columns, so reruns agree (null keys are
    equal).  Columns that have no order are compared as JSON."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = [F.to_json(F.struct(c)) if "map<" in df.schema[c].dataType.simpleString() else F.col(c) for c in rest]
    least = F.min_by(F.struct(*rest), F.struct(*order)).alias("_least")
    return df.groupBy(*keys).agg(least).select(*keys, "_least.*").select(*df.columns)


def regroup_tokens(exploded: DataFrame, keys: Sequence[str], token: str = "keyword",
                   pos: str = "pos", out: str = "keywords") -> DataFrame:
    """a03: rebuild an array per key from exploded rows, in ``pos`` order.

    Only for data that arrives exploded; arrays produced in-row should stay in
    row (higher-order functions) and never pay this shuffle.
    """
    # Distinct (key, pos, token) first: the list per key is bounded by the
    # distinct tokens of that key, however many times its rows were repeated.
    distinct = exploded.select(*keys, pos, token).dropDuplicates([*keys, pos, token])
    grouped = distinct.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(pos, token))).alias("_t"))
    return grouped.select(*keys, F.transform("_t", lambda x: x[token]).alias(out))


def conditional_max_below(df: DataFrame, col: str, bound: float = 1.0) -> Column:
    """a04: ``max(col)`` over rows with ``col < bound`` as a scalar-subquery Column.

    The aggregate runs once as part of the consuming plan; no value travels
    through Python.
    """
    return df.select(F.max(F.when(F.col(col) < bound, F.col(col))).alias("cap")).scalar()


def keyword_counts(df: DataFrame, keyword: str = "keyword") -> DataFrame:
    """a05: global keyword frequency."""
    return df.groupBy(keyword).agg(F.count(F.lit(1)).alias("count"))


def keyword_counts_by(df: DataFrame, keys: Sequence[str], out: str = "count") -> DataFrame:
    """a06: count per key tuple; rows with a NULL key are dropped (pandas groupby)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def mean_ratio(df: DataFrame, value: str, key: str = "category", label: str = "recommend",
               prefix: str | None = None) -> DataFrame:
    """a07/a08: per key the mean of ``value`` for label 1 and 0 and their ratio 0/1.

    A missing side reports mean 0 and ratio NULL, like the reference's table.
    """
    p = prefix or value
    m1 = F.avg(F.when(F.col(label) == 1, F.col(value)))
    m0 = F.avg(F.when(F.col(label) == 0, F.col(value)))
    has1 = F.max((F.col(label) == 1).cast("int")) == 1
    has0 = F.max((F.col(label) == 0).cast("int")) == 1
    agg = df.groupBy(key).agg(m1.alias("_m1"), m0.alias("_m0"), has1.alias("_h1"), has0.alias("_h0"))
    return agg.select(
        key,
        F.coalesce("_m1", F.lit(0.0)).alias(f"{p}_mean_1"),
        F.coalesce("_m0", F.lit(0.0)).alias(f"{p}_mean_0"),
        F.when(F.col("_h1") & F.col("_h0"), F.try_divide(F.col("_m0"), F.col("_m1"))).alias("ratio"),
    )


def _cells(label: Column, pred: Column) -> list[Column]:
    return [
        F.count_if((pred == 1) & (label == 1)).alias("tp"),
        F.count_if((pred == 0) & (label == 1)).alias("fn"),
        F.count_if((pred == 1) & (label == 0)).alias("fp"),
        F.count_if((pred == 0) & (label == 0)).alias("tn"),
    ]


def confusion(df: DataFrame, label: str = "recommend", pred: str = "predicted_recommend") -> DataFrame:
    """a09: TP/FN/FP/TN in one aggregate (one job instead of four)."""
    return df.agg(*_cells(F.col(label), F.col(pred)))


def _with_rates(df: DataFrame) -> DataFrame:
    def rate(num: str, other: str) -> Column:
        return F.coalesce(round_half_even(F.try_divide(F.col(num), F.col(num) + F.col(other)), 2), F.lit(0.0))

    return df.withColumns({"recall": rate("tp", "fn"), "precision": rate("tp", "fp")})


def confusion_by(df: DataFrame, key: str = "category", label: str = "recommend",
                 pred: str = "predicted_recommend", overall: str = "ALL") -> DataFrame:
    """a10: confusion cells and 2-digit precision/recall per key plus an overall row.

    ``rollup`` yields per-key and grand-total rows from a single aggregate; the
    total row carries ``overall`` as its key.
    """
    agg = df.rollup(key).agg(*_cells(F.col(label), F.col(pred)), F.grouping(key).alias("_g"))
    agg = agg.withColumn(key, F.when(F.col("_g") == 1, F.lit(overall)).otherwise(F.col(key).cast("string")))
    return _with_rates(agg.drop("_g"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """a11: distinct values of one column."""
    return df.select(col).distinct()


def row_count(df: DataFrame, out: str = "n") -> DataFrame:
    """a12: row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(out))


def work_list(df: DataFrame, key: str = "productId", n: int | None = None) -> DataFrame:
    """a13: distinct product ids, optionally the first ``n`` in key order."""
    out = df.select(key).distinct()
    return out.orderBy(key).limit(n) if n is not None else out


def shape(df: DataFrame) -> DataFrame:
    """a14: (rows, columns) of a DataFrame as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))
