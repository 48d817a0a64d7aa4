"""Feature operators on Spark MLlib (m01-m05, m12-m16).

Estimators are fitted inside a ``Pipeline`` on training rows only; statistics
(means, modes, label frequencies) are distributed aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (CountVectorizer, Imputer, OneHotEncoder, StandardScaler,
                                StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def label_indexer(col: str, out: str | None = None) -> StringIndexer:
    """m01: frequency-ordered index (ties alphabetical); unseen/NULL -> extra bucket."""
    return StringIndexer(inputCol=col, outputCol=out or f"{col}_index",
                         handleInvalid="keep", stringOrderType="frequencyDesc")


def one_hot(col: str, out: str | None = None) -> OneHotEncoder:
    """m02/m15: one-hot, last level dropped.  After a ``keep`` indexer the last
    level is the unknown bucket, so unknown values encode as all zeros."""
    return OneHotEncoder(inputCol=col, outputCol=out or f"{col}_ohe", dropLast=True)


def encoder_stages(cols: Sequence[str]) -> list:
    """m03: indexer + encoder stages for each categorical column."""
    stages: list = []
    for c in cols:
        stages += [label_indexer(c, f"{c}_index"), one_hot(f"{c}_index", f"{c}_ohe")]
    return stages


def fit_encoders(df: DataFrame, cols: Sequence[str]) -> PipelineModel:
    """m03: fit the encoder pipeline (one aggregate job per indexed column)."""
    return Pipeline(stages=encoder_stages(cols)).fit(df)


def keyword_vectorizer(col: str = "filtered_keywords", out: str = "keyword_features",
                       vocab_size: int = (1 << 31) - 1, min_df: float = 1.0) -> CountVectorizer:
    """m04: bag-of-keywords counts, over all terms unless ``vocab_size`` is given (the driver
    holds the vocabulary)."""
    return CountVectorizer(inputCol=col, outputCol=out, vocabSize=vocab_size, minDF=min_df)


def assembler(cols: Sequence[str], out: str = "features", handle_invalid: str = "keep") -> VectorAssembler:
    """m05: assemble vectors and numerics into one feature vector."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)


def mean_imputer(cols: Sequence[str], suffix: str = "") -> Imputer:
    """m12: replace NULL/NaN by the column mean."""
    return Imputer(inputCols=list(cols), outputCols=[c + suffix for c in cols], strategy="mean")


def mean_impute(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """m12 as a transform: fit on ``df`` and fill in place."""
    cast = df.withColumns({c: F.col(c).cast("double") for c in cols})
    return mean_imputer(cols).fit(cast).transform(cast)


def mode_of(df: DataFrame, col: str) -> Column:
    """m13: most frequent non-NULL value (ties -> smallest) as a scalar subquery."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.select(F.min_by(F.col(col), F.struct((-F.col("_n")).alias("a"), F.col(col).alias("b")))).scalar()


def modes_of(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """m13: ``column, value, n``: the most frequent non-null value of each text column (ties: the least), all
    columns counted in one scan."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = df.select(F.explode(cells).alias("c")).select("c.*").where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("value").alias("value"))).alias("b")
    return counts.groupBy("column").agg(best).select("column", "b.value", (-F.col("b.less")).alias("n"))


def mode_impute(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """m13: fill NULLs of text columns with their modes, found together (one map of a value a column)."""
    if not cols:
        return df
    modes = modes_of(df, cols).agg(F.map_from_entries(F.collect_list(F.struct("column", "value")))).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), F.try_element_at(modes, F.lit(c)).cast(df.schema[c].dataType)) for c in cols})


def standard_scale(df: DataFrame, cols: Sequence[str], population: bool = True,
                   suffix: str = "_scaled") -> DataFrame:
    """m14: ``(x - mean) / sd`` with population sd (sklearn) or sample sd (Spark).

    Mean and sd come from one aggregate (scalar subqueries over the same plan
    are merged by Catalyst); a zero sd scales to 0 like sklearn.
    """
    sd = F.stddev_pop if population else F.stddev_samp
    stats = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                   *[sd(c).alias(f"s_{i}") for i, c in enumerate(cols)])
    out = {}
    for i, c in enumerate(cols):
        m, s = stats.select(f"m_{i}").scalar(), stats.select(f"s_{i}").scalar()
        out[c + suffix] = F.when(s == 0, F.lit(0.0)).otherwise(F.try_divide(F.col(c) - m, s))
    return df.withColumns(out)


def scaler(col: str, out: str, population: bool = False) -> StandardScaler:
    """m14, MLlib form (sample sd); use :func:`standard_scale` for sklearn's population sd."""
    return StandardScaler(inputCol=col, outputCol=out, withMean=True, withStd=True)


def split_by_dtype(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """m16: numeric and string columns of ``df`` (the ColumnTransformer split)."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, NUMERIC_TYPES):
            num.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            cat.append(f.name)
    return num, cat


def sparse_parts(col: str) -> Column:
    """A sparse vector as a struct with ``size``, ``indices`` and ``values`` (only its non-zero cells)."""
    return F.unwrap_udt(F.col(col))


def vector_cells(col: str, out: str | None = None) -> Column:
    """Expose a vector as ``array<double>`` (for SQL-comparable output)."""
    return vector_to_array(F.col(col)).alias(out or col)
