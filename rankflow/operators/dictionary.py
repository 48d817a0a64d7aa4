"""Label and term dictionaries as stored tables (m01-m04, m15): nothing reaches the driver.

A dictionary is a table of values with ids from 0 by frequency, ties by value.  Ids are offsets
of sorted runs plus places in them (``windows.rank_in_groups``), so no task holds all values.
Values meet their ids by a join: a small dictionary is broadcast by its measured size, a large
one is shuffled and skewed keys are split at run time.  Encoded values are sparse: a struct of
``size``, ``indices`` (ascending) and ``values``, built in the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.operators.windows import rank_in_groups

SPARSE = "struct<size:int,indices:array<int>,values:array<double>>"


def label_table(df: DataFrame, col: str) -> DataFrame:
    """m01: ``label, id``: the non-null values of a column, ids by frequency, ties by value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return _numbered(counts, "label")


def term_table(df: DataFrame, terms: str, min_rows: int = 1, times: str | None = None) -> DataFrame:
    """m04: ``term, id``: the non-null terms of an array column that ``min_rows`` rows hold or more, ids
    by the number of occurrences, ties by term.  ``times``: a column that says how many rows each stands for."""
    own, n = F.filter(terms, lambda t: t.isNotNull()), F.lit(1) if times is None else F.col(times)
    found = df.select(F.explode(own).alias("term"), n.alias("n")) if min_rows <= 1 else df.select(
        F.explode(_counted(F.col(terms))).alias("t"), n.alias("rows")).select("t.term", (F.col("t.n") * F.col("rows")).alias("n"), "rows")
    counts = found.groupBy("term").agg(F.sum("n").alias("n")) if min_rows <= 1 else found.groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("rows").alias("rows")).where(F.col("rows") >= min_rows).drop("rows")
    return _numbered(counts, "term")


def _numbered(counts: DataFrame, value: str) -> DataFrame:
    ranked = rank_in_groups(counts, [], [F.desc("n"), F.asc(value)], "rank")
    return ranked.select(value, (F.col("rank") - 1).alias("id"))


def _counted(terms: Column) -> Column:
    """Distinct non-null terms of a row with their numbers."""
    own = F.filter(terms, lambda t: t.isNotNull())
    return F.transform(F.array_distinct(own), lambda t: F.struct(t.alias("term"), F.size(F.filter(own, lambda x: x == t)).alias("n")))


def with_index(df: DataFrame, col: str, table: DataFrame, out: str) -> DataFrame:
    """m01: the value's id as a double; null and unknown values share the id after the last one."""
    size = table.agg(F.count(F.lit(1)).cast("double")).scalar()
    ids = table.select(F.col("label").alias("_label"), F.col("id").alias("_id"))
    kept = [F.col(c) for c in df.columns if c != out]
    return df.join(ids, F.col(col) == F.col("_label"), "left").select(*kept, F.coalesce(F.col("_id").cast("double"), size).alias(out))


def one_hot(index: Column | str, table: DataFrame) -> Column:
    """m02, m15: the sparse one-hot vector of an index; unknown values are all zeros."""
    i = F.col(index) if isinstance(index, str) else index
    size = table.agg(F.count(F.lit(1)).cast("int")).scalar()
    known = i < size
    return F.struct(size.alias("size"), F.when(known, F.array(i.cast("int"))).otherwise(F.array().cast("array<int>")).alias("indices"),
                    F.when(known, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"))


def encode(df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """m03: for each column its index (``<column>_index``) and sparse one-hot vector (``<column>_ohe``).
    Tables come from training rows; values they lack are unknown."""
    for col, table in tables.items():
        df = with_index(df, col, table, f"{col}_index")
        df = df.withColumn(f"{col}_ohe", one_hot(f"{col}_index", table))
    return df


def term_vectors(df: DataFrame, terms: str, table: DataFrame, keys: Sequence[str], out: str = "vector") -> DataFrame:
    """m04: ``keys`` (unique in ``df``) and the sparse counts of each row's known terms.

    Terms are counted in their rows before they are dealt out, so a term that many rows hold
    comes once a row; rows without known terms have an empty vector.
    """
    size = table.agg(F.count(F.lit(1)).cast("int")).scalar()
    cells = df.select(F.struct(*keys).alias("row"), F.explode_outer(_counted(F.col(terms))).alias("t")).select("row", "t.term", "t.n")
    met = cells.join(table, "term", "left")
    entry = F.when(F.col("id").isNotNull(), F.struct(F.col("id").alias("id"), F.col("n").cast("double").alias("n")))
    rows = met.groupBy("row").agg(F.array_sort(F.collect_list(entry)).alias("cells"))  # a row's own terms
    return rows.select("row.*", F.struct(size.alias("size"), F.transform("cells", lambda c: c["id"]).alias("indices"),
                                         F.transform("cells", lambda c: c["n"]).alias("values")).alias(out))


def numbers(parts: Sequence[Column | str], first: Column | int = 0, digits: int | None = None) -> Column:
    """m05: a sparse vector of numbers; zeros and missing ones have no cell.  Places count from ``first``;
    the cells that are left are rounded to ``digits``, if given."""
    start, indices, values = F.lit(first) if isinstance(first, int) else first, [], []
    for i, part in enumerate(parts):
        c = F.col(part) if isinstance(part, str) else part
        known, cell = F.coalesce(c, F.lit(0.0)) != 0, c.cast("double")
        if digits is not None:  # rounding goes by decimals, whole numbers stay
            cell = F.when(F.rint(cell) == cell, cell).otherwise(F.round(cell, digits))
        indices.append(F.when(known, F.array(start + i)).otherwise(F.array().cast("array<int>")))
        values.append(F.when(known, F.array(cell)).otherwise(F.array().cast("array<double>")))
    return F.struct(F.lit(len(parts)).alias("size"), F.concat(*indices).alias("indices"), F.concat(*values).alias("values"))


def join_vectors(vectors: Sequence[Column | str | Callable[[Column], Column]]) -> Column:
    """m05: sparse vectors one after the other.  A vector may be a function of its first place, which
    spares it the moving of its places (a lambda, and all below it, runs uncompiled)."""
    def moved(places: Column, by: Column) -> Column:
        return F.transform(places, lambda i: i + by)

    size, indices, values = F.lit(0), [], []
    for v in vectors:
        c = v(size) if callable(v) else F.col(v) if isinstance(v, str) else v
        indices.append(c["indices"] if callable(v) else moved(c["indices"], size))
        values.append(c["values"])
        size = size + c["size"]
    return F.struct(size.alias("size"), F.concat(*indices).alias("indices"), F.concat(*values).alias("values"))
