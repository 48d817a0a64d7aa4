"""End-to-end jobs c01-c10 over ranking/detail snapshot DataFrames.

Each job is a lazy DataFrame plan built from the operators; only c08 (model
fitting) and the sinks run actions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions import metrics as M
from rankflow.functions import text as X
from rankflow.operators import aggregates as A
from rankflow.operators import features as FE
from rankflow.operators import model as MO
from rankflow.operators import relational as R
from rankflow.operators import trees as TR
from rankflow.operators import windows as W
from rankflow.sources import files as IO

LIVE_COUNTERS = ("currentlyViewing", "currentlyBuying")


# -- c01 ---------------------------------------------------------------------

def cap_rate(df: DataFrame, col: str = "conversionRate", bound: float = 1.0) -> DataFrame:
    """f27 + a04: values above ``bound`` become the largest value below it.

    The cap is a scalar subquery inside the same plan (no driver round trip);
    a value equal to ``bound`` is kept, and with no value below it the cap is NULL.
    """
    cap = A.conditional_max_below(df, col, bound)
    return df.withColumn(col, F.when(F.col(col) > bound, cap).otherwise(F.col(col)))


def build_product_rankings(ranking: DataFrame, detail: DataFrame, materialize: bool = True) -> DataFrame:
    """c01: ranking minus live counters, joined with detail, conversion rate capped.

    The cap needs a global aggregate before the final projection, so the joined
    table is read twice.  By default it is written once (Parquet) to the shared
    checkpoint folder and both passes read that: the join runs once and the cap
    pass reads a single column (measured faster even at sf0.1).  With
    ``materialize=False`` Catalyst recomputes the join for the subquery.
    """
    r = ranking.drop(*[c for c in LIVE_COUNTERS if c in ranking.columns])
    joined = R.join_snapshots(r, detail)
    rated = joined.withColumn("conversionRate", M.conversion_rate("totalSales", "views"))
    if materialize:
        from rankflow.session import materialize as write_once

        rated = write_once(rated, "product-rankings")
    return cap_rate(rated)


# -- c02 ---------------------------------------------------------------------

def build_product_keywords(ranking: DataFrame, name: str = "productName", key: str = "productId") -> DataFrame:
    """c02: keywords per distinct (product, name), in token order.

    One dedupe shuffle; the token work is a single higher-order expression per
    row, where the reference exploded and regrouped twice.
    """
    # Keywords wait for the group's count: else the filter moves below the dedupe and cuts every row's name.
    products = ranking.groupBy(key, name).agg(F.count(F.lit(1)).alias("_rows"))
    kept = R.non_empty(products.withColumn("keywords", F.when(F.col("_rows") > 0, X.product_keywords(name))), "keywords")
    return kept.select(key, name, "keywords")


# -- c03 ---------------------------------------------------------------------

ENRICHED_COLUMNS = ("productId", "date", "brandName", "productName", "colors", "ranking", "price",
                    "originalPrice", "discountRate", "totalSales", "category", "views", "likes",
                    "rating", "ratingCount", "conversionRate", "season")


def enrich_with_price_and_season(ranking: DataFrame, detail: DataFrame) -> DataFrame:
    """c03: joined snapshot rows with original price, timestamp and season."""
    j = R.join_on(ranking, detail, ["productId", "date"], ["productId", "date"])
    rows = j.select(
        *[F.col(f"l.{c}") for c in ("productId", "date", "brandName", "productName", "colors", "ranking",
                                     "price", "discountRate", "totalSales", "category")],
        *[F.col(f"r.{c}") for c in ("views", "likes", "rating", "ratingCount")],
        M.conversion_rate_nullable(F.col("l.totalSales"), F.col("r.views")).alias("conversionRate"),
    ).distinct()
    ts = M.parse_stamp("date")
    out = rows.withColumns({"originalPrice": M.original_price("price", "discountRate"), "date": ts})
    return out.withColumn("season", M.season("date")).select(*ENRICHED_COLUMNS)


def enriched_lines(enriched: DataFrame) -> DataFrame:
    """c03 output: TSV text lines (s12), discount as ``%.2f``, NULL as ``None``."""
    return IO.to_tsv_lines(enriched, ENRICHED_COLUMNS, two_dp=("discountRate",))


# -- c04 ---------------------------------------------------------------------

def stopword_keywords(df: DataFrame, name: str = "productName", key: str = "productId") -> DataFrame:
    """c04: cleaned, whitespace-tokenised, stop-word-free keywords per row."""
    tokens = df.select(key, X.whitespace_tokens(X.clean_name(name)).alias("_tokens"))
    return X.remove_stop_words_df(tokens, "_tokens", "keywords").select(key, "keywords")


# -- c05 / c06 ---------------------------------------------------------------

def latest_labelled(rankings: DataFrame, keywords: DataFrame, k: int = 150,
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """Shared head of c05-c07: merge, newest row per product, label by rank."""
    merged = R.join_keywords(rankings, keywords)
    latest = W.latest_per_key(merged, ["productId"], "date", tiebreak)
    return R.label_top(latest, "ranking", k)


def keyword_frequency_by_label(labelled: DataFrame, n: int = 20) -> DataFrame:
    """c05: the ``n`` most frequent keywords per (category, recommend)."""
    exploded = labelled.select("category", "recommend", F.explode_outer("keywords").alias("keyword"))
    counts = A.keyword_counts_by(exploded, ["category", "recommend", "keyword"])
    return W.top_n_per_group(counts, ["category", "recommend"], [F.col("count").desc(), F.col("keyword")], n)


def views_ratio_by_label(labelled: DataFrame) -> DataFrame:
    """c06: mean views for recommended vs not, per category."""
    return A.mean_ratio(labelled, "views")


def sales_ratio_by_label(labelled: DataFrame) -> DataFrame:
    """c06: mean totalSales for recommended vs not, per category."""
    return A.mean_ratio(labelled, "totalSales")


# -- c07 ---------------------------------------------------------------------

def feature_importance(labelled: DataFrame, drop: Sequence[str] = ("category", "keywords", "date", "productId",
                                                                  "ranking"),
                       label: str = "recommend", top: int = 10, seed: int = 42,
                       train_fraction: float = 0.7) -> DataFrame:
    """c07: impute/scale numerics, impute/one-hot categoricals, forest, top features."""
    # Hash split on the product key (stable under recomputation), then drop the key.
    train, _ = MO.split_hash(labelled, "productId", train_fraction)
    train = train.drop(*[c for c in drop if c in labelled.columns])
    num, cat = FE.split_by_dtype(train, exclude=(label,))
    train = FE.mode_impute(train.withColumns({c: F.col(c).cast("double") for c in num}), cat)
    # Every estimator below is a pass over the training rows: write them once.
    from rankflow.session import materialize

    train = materialize(train, "importance-train")
    stages = [FE.mean_imputer(num, "_imp"), FE.assembler([c + "_imp" for c in num], "_num"),
              FE.scaler("_num", "_num_scaled")]
    for c in cat:
        stages += [FE.label_indexer(c, f"{c}_idx"), FE.one_hot(f"{c}_idx", f"{c}_ohe")]
    stages += [FE.assembler(["_num_scaled"] + [f"{c}_ohe" for c in cat]),
               MO.forest(label=label, seed=seed)]
    model = MO.fit(stages, train.withColumn(label, F.col(label).cast("double")))
    transformed = model.transform(train.limit(0).withColumn(label, F.col(label).cast("double")))
    names = MO.feature_names(transformed)
    num_names = dict(enumerate(num))
    names = [num_names.get(i, n) if n.startswith("_num_scaled") else n for i, n in enumerate(names)]
    imp = model.stages[-1].featureImportances.toArray().tolist()
    table = labelled.sparkSession.createDataFrame(list(zip(names, [float(x) for x in imp])),
                                                  "feature string, importance double")
    return W.top_k(table, [F.col("importance").desc(), F.col("feature")], top)


# -- c08 ---------------------------------------------------------------------

NUMERIC_FEATURES = ("price", "discountRate", "conversionRate", "trending", "totalSales", "views", "likes",
                    "rating", "ratingCount")


def vocabulary(df: DataFrame, col: str = "keywords", k: int = 100) -> Column:
    """Top-``k`` keywords (count desc, keyword asc) as a bounded array scalar subquery."""
    kw = df.select(F.explode(col).alias("keyword"))
    top = W.top_k(A.keyword_counts(kw), [F.col("count").desc(), F.col("keyword")], k)
    return top.agg(F.collect_list("keyword")).scalar()


def recommendation_features(rankings: DataFrame, keywords: DataFrame, k: int = 150,
                            top_keywords: int = 100, tiebreak: Sequence[str] = (),
                            materialize_input: bool = True) -> DataFrame:
    """c08 feature table: newest row per product, label, keywords cleaned once and
    restricted to the top vocabulary (same cleaned tokens on both sides).

    The per-product table is written once (``materialize_input``) so the
    vocabulary subquery and the final projection read it instead of re-running
    the joins and windows behind it."""
    latest = W.latest_per_key(rankings, ["productId"], "date", tiebreak)
    labelled = R.label_top(latest, "ranking", k).drop("ranking")
    joined = R.join_keywords(labelled, keywords)
    filled = R.fill_defaults(joined, {"colors": "unknown", "rating": 0, "ratingCount": 0})
    cleaned = filled.withColumn("keywords", X.drop_blank(F.transform(F.coalesce(
        "keywords", F.array().cast("array<string>")), X.normalise_keyword)))
    if materialize_input:
        from rankflow.session import materialize

        cleaned = materialize(cleaned, "recommend-features")
    vocab = vocabulary(cleaned, "keywords", top_keywords)
    return X.with_vocabulary(cleaned, "keywords", vocab, "filtered_keywords")


def feature_stages() -> list:
    """Encoders shared by every category: brand/colour one-hot (unknown -> zeros),
    keyword counts over the top vocabulary, mean-imputed numerics, one vector."""
    numeric = list(NUMERIC_FEATURES)
    return [
        *FE.encoder_stages(["brandName", "colors"]),
        FE.keyword_vectorizer("filtered_keywords", "keyword_features"),
        FE.mean_imputer(numeric, "_imp"),
        FE.assembler(["brandName_ohe", "colors_ohe", "keyword_features", *[c + "_imp" for c in numeric]]),
    ]


def recommend_stages(seed: int = 42, label: str = "recommend") -> list:
    """Encoders plus the forest, as one pipeline (for a single model)."""
    return [*feature_stages(), MO.forest(label=label, seed=seed)]


def recommendation_cells(features: DataFrame, train: DataFrame) -> DataFrame:
    """The feature table with ``cells``: numerics (missing ones at the training rows' mean) in bins between
    the training rows' quantiles, and a cell for the brand, the colours and each keyword."""
    means = train.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in NUMERIC_FEATURES]).first()
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(means[c])) for c in NUMERIC_FEATURES}
    cuts = TR.quantile_cuts(train.withColumns(filled), NUMERIC_FEATURES)
    cells = F.concat(TR.numeric_cells(cuts), TR.value_cells("brandName"), TR.value_cells("colors"), TR.item_cells("filtered_keywords"))
    return features.withColumns(filled).withColumn("cells", cells)


def recommend(features: DataFrame, categories: Sequence[str] | None = None, train_fraction: float = 0.7,
              seed: int = 42, split: str = "hash", forest: TR.ForestSpec | None = None
              ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """c08: one forest per category; returns (test predictions, metric report, confusion).

    * All forests grow in one job, a pass a level (``operators.trees``): neither jobs nor plans grow
      with the number of categories, and a hot category is counted by all tasks.
    * Without ``categories`` every category with training rows gets a forest, rows of a null category
      one of their own; the report names those trained.
    * Means and bins come from the training rows of all categories.
    * Every row is scored once into a stored table; all metrics (every category x split) and the
      confusion counts are aggregates over it.
    * ``split="hash"`` (default) is an MD5 split on the product key: stable under recomputation and
      repartitioning; ``"random"`` draws each row of the stored feature table with ``seed``.
    """
    from rankflow.session import materialize

    spec = forest or TR.ForestSpec(seed=seed)
    data = features if categories is None else features.where(F.col("category").isin(list(categories)))
    drawn = MO.hash_bucket("productId") < int(round(train_fraction * 100)) if split == "hash" else F.rand(seed) < train_fraction
    data = materialize(data.withColumn("split", F.when(drawn, "train").otherwise("test")), "recommend-input")
    train = data.where("split = 'train' AND recommend IS NOT NULL")
    if train.isEmpty():
        raise ValueError("no category has training rows")
    data = materialize(recommendation_cells(data, train).select("productId", "category", "recommend", "split", "cells"), "recommend-cells")
    model = TR.fit_forests(data.where("split = 'train'"), "category", "recommend", key="productId", spec=spec)
    scored = TR.predict_forests(data, model, "category", spec=spec, how="inner")
    scored = materialize(scored.select("productId", "category", F.col("recommend").cast("double").alias("recommend"), "split", "probability", "prediction",
                                       F.col("prediction").alias("predicted_recommend")), "recommend-scores")
    report = MO.metric_rows(scored, "recommend", "prediction", keys=("category", "split"))
    test = scored.filter(F.col("split") == "test").select(
        "productId", "category", F.col("recommend").cast("int").alias("recommend"), "predicted_recommend")
    return test, report, A.confusion_by(test, "category")


# -- c09 / c10 ---------------------------------------------------------------

def ingest_batch(spark: SparkSession, landing: str, done: DataFrame | None, stamp: str | int,
                 categories: Sequence[str] | None = None, width: int = 10) -> DataFrame:
    """c10 (batch form): snapshot rows of ``stamp`` not yet collected, one per key.

    ``done`` holds what is already stored; the result is the work list to
    fetch or append (j05 + a13), never a driver-side list.
    """
    ranking = IO.read_tree(spark, landing, "ranking", categories)
    current = R.at_snapshot(ranking, stamp, "date", width)
    if done is not None:
        hour = lambda d: d.withColumn("_hour", M.stamp_prefix("date", 10))
        current = R.not_yet_collected(hour(current), hour(done).select("productId", "_hour"),
                                      ["productId", "_hour"]).drop("_hour")
    return A.one_per_key(current, ["productId", "date"])
