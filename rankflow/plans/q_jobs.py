"""Queries for the composite jobs c01-c08 (c09, c10 live with the sources)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.operators import windows as W
from rankflow.plans import driver as D
from rankflow.plans import jobs as J
from rankflow.plans.q_functions import _SQL_CLEAN, sql_stop_words
from rankflow.plans.q_ml import _features
from rankflow.plans.q_relational import (_LABELLED_SQL, _SQL_KEYWORD, _mean_ratio_sql, labelled,
                                         labelled_detail)
from rankflow.plans.registry import query
from rankflow.session import scratch_path
from rankflow.sources import files as IO

_RATED = """rated AS (
  SELECT r.productId, r.date, r.brandName, r.productName, r.price, r.discountRate, r.ranking, r.trending,
         r.totalSales, r.colors, r.category, d.views, d.likes, d.rating, d.ratingCount,
         d.totalSales AS detailTotalSales,
         CASE WHEN d.views <> 0 THEN r.totalSales / d.views ELSE 0.0 END AS rate
  FROM ranking r JOIN detail d ON r.productId = d.productId AND r.date = d.date)"""


@query("c01_product_rankings", D.with_ctes(D.RANKING_SQL, D.DETAIL_SQL, _RATED) + """
SELECT * EXCLUDE (rate), CASE WHEN rate > 1 THEN (SELECT max(rate) FROM rated WHERE rate < 1) ELSE rate END
       AS conversionRate FROM rated""")
def c01(spark: SparkSession, sf: str) -> DataFrame:
    return J.build_product_rankings(*D.snapshots(spark, sf))


_EV_RATED = """rated AS (
  SELECT s.productId, s.date, s.totalSales, v.views, v.likes,
         CASE WHEN v.views <> 0 THEN s.totalSales / v.views ELSE 0.0 END AS rate
  FROM event_sales s JOIN event_views v ON s.productId = v.productId AND s.date = v.date)"""

FLAGSHIP_SQL = D.with_ctes(D.EVENT_SALES_SQL, D.EVENT_VIEWS_SQL, _EV_RATED) + """
SELECT productId, date, totalSales, views, likes,
       CASE WHEN rate > 1 THEN (SELECT max(rate) FROM rated WHERE rate < 1) ELSE rate END AS conversionRate
FROM rated QUALIFY row_number() OVER (PARTITION BY productId ORDER BY date DESC) = 1"""


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Per user: newest day's purchases, views and capped conversion rate (c01 on events)."""
    daily = D.events_daily(spark, sf)
    rated = J.build_product_rankings(D.event_sales(spark, sf, daily), D.event_views(spark, sf, daily))
    latest = W.latest_per_key(rated, ["productId"], "date")
    return latest.select("productId", "date", "totalSales", "views", "likes", "conversionRate") \
                 .orderBy(F.col("conversionRate").desc(), "productId")


query("c01_event_rankings", FLAGSHIP_SQL)(flagship)


def _c02_name() -> F.Column:
    tag = F.concat(F.lit("[단독|"), F.lower("p_type"), F.lit("]"))
    line = F.when(F.col("p_size") > 25, F.lit("A-라인")).otherwise(F.lit("T2"))
    return F.concat_ws(" ", "p_name", tag, "p_brand", line)


_C02_NAME_SQL = ("concat_ws(' ', p_name, '[단독|' || lower(p_type) || ']', p_brand, "
                 "CASE WHEN p_size > 25 THEN 'A-라인' ELSE 'T2' END)")
_C02_TOKENS = f"list_filter(string_split({_C02_NAME_SQL}, ' '), lambda x: {_SQL_KEYWORD})"
_C02_STRIP = f"list_filter(list_transform({_C02_TOKENS}, lambda x: trim(regexp_replace(x, '[\\|]', '', 'g'))), lambda x: trim(x) <> '')"
_C02_SPLIT = (f"list_filter(list_transform(flatten(list_transform({_C02_STRIP}, "
              f"lambda x: regexp_split_to_array(x, '[^가-힣a-zA-Z0-9]'))), lambda x: trim(x)), lambda x: trim(x) <> '')")


@query("c02_product_keywords", f"""
SELECT productId, productName, keywords FROM (
  SELECT p_partkey AS productId, {_C02_NAME_SQL} AS productName, {_C02_SPLIT} AS keywords FROM part)
WHERE len(keywords) > 0""")
def c02(spark: SparkSession, sf: str) -> DataFrame:
    part = D.table(spark, sf, "part").select(F.col("p_partkey").alias("productId"), _c02_name().alias("productName"))
    return J.build_product_keywords(part)


@query("c03_enriched", D.with_ctes(D.RANKING_SQL, D.DETAIL_SQL, D.ENRICHED_SQL) + "SELECT * FROM enriched")
def c03(spark: SparkSession, sf: str) -> DataFrame:
    e = J.enrich_with_price_and_season(*D.snapshots(spark, sf))
    return e.withColumn("date", F.col("date").cast("timestamp_ntz"))


@query("c04_stopword_keywords", f"""
SELECT doc_id, array_to_string(list_filter(regexp_split_to_array({_SQL_CLEAN}, '\\s+'),
                                           lambda x: NOT list_contains({sql_stop_words()}, lower(x))), ',') AS keywords
FROM documents""")
def c04(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.table(spark, sf, "documents")
    kw = J.stopword_keywords(docs, name="text", key="doc_id")
    path = IO.write_csv(kw, scratch_path(spark, "c04"))
    # keywords hold no white space, so every line is a record and files can be split
    return (spark.read.schema("doc_id bigint, keywords string").option("header", True).option("escape", '"')
            .csv(path).fillna({"keywords": ""}))


@query("c05_keyword_frequency", D.with_ctes(D.RANKING_SQL, _LABELLED_SQL) + """
SELECT category, recommend, keyword, count FROM (
  SELECT category, recommend, keyword, count(*) AS count
  FROM (SELECT category, recommend, unnest(keywords) AS keyword FROM labelled)
  WHERE keyword IS NOT NULL GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY category, recommend ORDER BY count DESC, keyword) <= 20""")
def c05(spark: SparkSession, sf: str) -> DataFrame:
    return J.keyword_frequency_by_label(labelled(spark, sf), 20)


@query("c06_views_ratio", _mean_ratio_sql("views"))
def c06v(spark: SparkSession, sf: str) -> DataFrame:
    return J.views_ratio_by_label(labelled_detail(spark, sf))


@query("c06_sales_ratio", _mean_ratio_sql("totalSales"))
def c06s(spark: SparkSession, sf: str) -> DataFrame:
    return J.sales_ratio_by_label(labelled_detail(spark, sf))


@query("c07_feature_importance")
def c07(spark: SparkSession, sf: str) -> DataFrame:
    ranking, detail = D.snapshots(spark, sf)
    l = labelled(spark, sf, ranking=ranking).join(detail.drop("totalSales"), ["productId", "date"])
    return J.feature_importance(l)


@query("c08_recommend")
def c08(spark: SparkSession, sf: str) -> DataFrame:
    _, _, confusion = J.recommend(_features(spark, sf))
    return confusion
