"""Queries for projections, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions import metrics as M
from rankflow.functions import text as X
from rankflow.operators import aggregates as A
from rankflow.operators import relational as R
from rankflow.operators.incremental import KeptAggregate, Measure
from rankflow.operators import windows as W
from rankflow.plans import driver as D
from rankflow.plans import jobs as J
from rankflow.plans.registry import query
from rankflow.session import materialize, scratch_path
from rankflow.sources.ledger import BatchLedger

_R = D.with_ctes(D.RANKING_SQL)
_RD = D.with_ctes(D.RANKING_SQL, D.DETAIL_SQL)
_D = D.with_ctes(D.DETAIL_SQL)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return D.table(spark, sf, name)


# -- p01-p12 -------------------------------------------------------------------

@query("p01_drop", _R + "SELECT productId, brandName, productName, price, discountRate, ranking, totalSales, "
                        "date, category FROM ranking")
def p01(spark, sf):
    return R.drop(D.ranking(spark, sf), "colors", "trending")


@query("p02_select", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def p02(spark, sf):
    return R.project(_t(spark, sf, "lineitem"), "l_orderkey", "l_partkey", "l_quantity")


_P03_NAME = "NULLIF(CASE WHEN p_size > 25 THEN p_name ELSE p_brand END, CASE WHEN p_size = 1 THEN p_brand END)"
_SQL_KEYWORD = ("(regexp_matches(x, '[가-힣]') OR regexp_matches(x, '^[a-zA-Z]+$')) "
                "AND NOT regexp_matches(x, '[a-zA-Z].*[0-9]|[0-9].*[a-zA-Z]')")


def sql_keyword_tokens(expr: str) -> str:
    return f"list_filter(string_split({expr}, ' '), lambda x: {_SQL_KEYWORD})"


@query("p03_non_empty", f"""
SELECT p_partkey, keywords FROM (SELECT p_partkey, {sql_keyword_tokens(_P03_NAME)} AS keywords FROM part)
WHERE len(keywords) > 0""")
def p03(spark, sf):
    part = _t(spark, sf, "part")
    name = F.nullif(F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(F.col("p_brand")),
                    F.when(F.col("p_size") == 1, F.col("p_brand")))
    return R.non_empty(part.select("p_partkey", X.keyword_tokens(name).alias("keywords")), "keywords")


@query("p04_drop_blank", """
SELECT p_partkey, list_filter(string_split(concat(' ', p_name, '  ', p_type, ' '), ' '),
                              lambda x: trim(x) <> '') AS tokens FROM part""")
def p04(spark, sf):
    part = _t(spark, sf, "part")
    arr = F.split(F.concat(F.lit(" "), "p_name", F.lit("  "), "p_type", F.lit(" ")), " ")
    return part.select("p_partkey", X.drop_blank(arr).alias("tokens"))


@query("p05_at_snapshot", _R + """SELECT productId, date, ranking FROM ranking
WHERE substr(CAST(date AS VARCHAR), 1, 6) = '199803'""")
def p05(spark, sf):
    return R.at_snapshot(D.ranking(spark, sf), "19980315", "date", 6).select("productId", "date", "ranking")


_P06_STAMP = "CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE strftime(o_orderdate, '%Y%m%d') END"


@query("p06_at_stamp", f"""
SELECT o_orderkey, stamp FROM (SELECT o_orderkey, {_P06_STAMP} AS stamp FROM orders)
WHERE TRY_CAST(stamp AS BIGINT) IS NOT NULL AND TRY_CAST(stamp AS BIGINT) = 19970101""")
def p06(spark, sf):
    o = _t(spark, sf, "orders")
    stamp = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return R.at_stamp(o.select("o_orderkey", stamp.alias("stamp")), 19970101, "stamp")


@query("p07_label_top", _R + """SELECT productId, date, ranking,
       CASE WHEN ranking <= 2 THEN 1 ELSE 0 END AS recommend FROM ranking""")
def p07(spark, sf):
    return R.label_top(D.ranking(spark, sf).select("productId", "date", "ranking"), "ranking", 2)


@query("p08_fill_defaults", _D + """SELECT productId, date, COALESCE(views, 0.0) AS views,
       COALESCE(rating, 0.0) AS rating, likes FROM detail""")
def p08(spark, sf):
    d = D.detail(spark, sf).select("productId", "date", "views", "rating", "likes")
    return R.fill_defaults(d, {"views": 0.0, "rating": 0.0})


@query("p09_for_category", _R + "SELECT productId, date, totalSales FROM ranking WHERE category = 'promo'")
def p09(spark, sf):
    return R.for_category(D.ranking(spark, sf), "promo").select("productId", "date", "totalSales")


@query("p10_stamp", "SELECT p_partkey, p_name, CAST(2024112700 AS BIGINT) AS date, 'parts' AS category FROM part")
def p10(spark, sf):
    return R.stamp(_t(spark, sf, "part").select("p_partkey", "p_name"), date=2024112700, category="parts")


@query("p11_copy_column", "SELECT l_orderkey, l_linenumber, l_quantity, l_quantity AS qty FROM lineitem")
def p11(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return R.copy_column(li, "l_quantity", "qty")


@query("p12_predicates", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
WHERE (l_returnflag = 'R' OR l_discount > 0.05) AND NOT (l_linestatus IN ('O')) AND l_tax IS NOT NULL""")
def p12(spark, sf):
    li = _t(spark, sf, "lineitem")
    out = R.where_all(li, (F.col("l_returnflag") == "R") | (F.col("l_discount") > 0.05),
                      ~F.col("l_linestatus").isin("O"), F.col("l_tax").isNotNull())
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")


# -- j01-j06 -----------------------------------------------------------------------

@query("j01_join_snapshots", _RD + """
SELECT r.productId, r.date, r.totalSales, r.ranking, d.views, d.likes, d.totalSales AS detailTotalSales
FROM ranking r JOIN detail d ON r.productId = d.productId AND r.date = d.date""")
def j01(spark, sf):
    j = R.join_snapshots(*D.snapshots(spark, sf))
    return j.select("productId", "date", "totalSales", "ranking", "views", "likes", "detailTotalSales")


@query("j02_join_on", _RD + """
SELECT r.productId, r.date, d.productId AS detailProductId, r.category, d.views
FROM ranking r JOIN detail d ON r.productId = d.productId AND r.date = d.date""")
def j02(spark, sf):
    j = R.join_on(*D.snapshots(spark, sf), ["productId", "date"], ["productId", "date"])
    return j.select("l.productId", "l.date", F.col("r.productId").alias("detailProductId"), "l.category", "r.views")


_KW_SQL = f"""keywords AS (
  SELECT DISTINCT productId, productName FROM ranking)"""


@query("j03_join_keywords", D.with_ctes(D.RANKING_SQL, _KW_SQL) + """
SELECT r.productId, r.date, r.ranking, string_split(k.productName, ' ') AS keywords
FROM ranking r JOIN keywords k ON r.productId = k.productId""")
def j03(spark, sf):
    r = D.ranking(spark, sf)
    kw = A.dedupe(r.select("productId", "productName"), ["productId", "productName"]).select(
        "productId", F.split("productName", " ").alias("keywords"))
    return R.join_keywords(r.select("productId", "date", "ranking"), kw)


@query("j04_join_keep_name", D.with_ctes(D.RANKING_SQL, _KW_SQL) + """
SELECT r.productId, r.date, r.productName, upper(k.productName) AS upperName
FROM ranking r JOIN keywords k ON r.productId = k.productId""")
def j04(spark, sf):
    r = D.ranking(spark, sf)
    kw = A.dedupe(r.select("productId", "productName"), ["productId", "productName"]).withColumn(
        "upperName", F.upper("productName"))
    return R.join_keywords(r.select("productId", "date", "productName"), kw)


@query("j05_not_yet_collected", _RD + """
SELECT r.productId, r.date, r.ranking FROM ranking r
WHERE NOT EXISTS (SELECT 1 FROM detail d WHERE d.views IS NOT NULL AND d.productId = r.productId
                  AND d.date = r.date)""")
def j05(spark, sf):
    ranking, detail = D.snapshots(spark, sf)
    done = detail.filter(F.col("views").isNotNull())
    return R.not_yet_collected(ranking.select("productId", "date", "ranking"), done)


@query("j06_already_collected", _RD + """
SELECT r.productId, r.date, r.ranking FROM ranking r
WHERE EXISTS (SELECT 1 FROM detail d WHERE d.views IS NOT NULL AND d.productId = r.productId
              AND d.date = r.date)""")
def j06(spark, sf):
    ranking, detail = D.snapshots(spark, sf)
    done = detail.filter(F.col("views").isNotNull())
    return R.already_collected(ranking.select("productId", "date", "ranking"), done)


# -- a01-a14 ------------------------------------------------------------------------

@query("a01_dedupe_subset", _R + "SELECT DISTINCT productId, productName FROM ranking")
def a01(spark, sf):
    return A.dedupe(D.ranking(spark, sf).select("productId", "productName"), ["productId", "productName"])


@query("a02_distinct_rows", """
SELECT DISTINCT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM lineitem""")
def a02(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("ship_year"))
    return A.dedupe(li)


@query("a03_regroup_tokens", """
SELECT p_partkey, list_filter(string_split(concat_ws(' ', p_name, p_type, p_brand), ' '),
                              lambda x: NOT regexp_matches(x, '[0-9]')) AS keywords
FROM part WHERE len(list_filter(string_split(concat_ws(' ', p_name, p_type, p_brand), ' '),
                                lambda x: NOT regexp_matches(x, '[0-9]'))) > 0""")
def a03(spark, sf):
    part = _t(spark, sf, "part")
    toks = part.select("p_partkey", F.posexplode(F.split(F.concat_ws(" ", "p_name", "p_type", "p_brand"), " "))
                       .alias("pos", "keyword"))
    return A.regroup_tokens(toks.filter(~F.col("keyword").rlike("[0-9]")), ["p_partkey"])


_RATE = "CASE WHEN d.views <> 0 THEN r.totalSales / d.views ELSE 0.0 END"


@query("a04_capped_max", _RD + f"""
SELECT max(rate) FILTER (WHERE rate < 1) AS cap FROM
  (SELECT {_RATE} AS rate FROM ranking r JOIN detail d ON r.productId = d.productId AND r.date = d.date)""")
def a04(spark, sf):
    j = R.join_snapshots(*D.snapshots(spark, sf))
    rated = j.withColumn("rate", M.conversion_rate("totalSales", "views"))
    return spark.range(1).select(A.conditional_max_below(rated, "rate").alias("cap"))


_DOC_WORDS = "list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\r]+'), lambda x: x <> '')"


@query("a05_keyword_counts", f"""
SELECT keyword, count(*) AS count FROM (SELECT unnest({_DOC_WORDS}) AS keyword FROM documents)
GROUP BY keyword""")
def a05(spark, sf):
    docs = _t(spark, sf, "documents")
    words = docs.select(F.explode(X.drop_blank(F.split(F.lower("text"), "[ \\t\\n\\r]+"))).alias("keyword"))
    return A.keyword_counts(words)


_LABELLED_SQL = """labelled AS (
  SELECT *, CASE WHEN ranking <= 2 THEN 1 ELSE 0 END AS recommend,
         string_split(productName, ' ') AS keywords
  FROM (SELECT * FROM ranking QUALIFY row_number() OVER (PARTITION BY productId ORDER BY date DESC) = 1))"""


def labelled(spark: SparkSession, sf: str, k: int = 2, ranking: DataFrame | None = None) -> DataFrame:
    """Rankings with stored keywords, the newest row per product, labelled (the head of c05-c07)."""
    r = ranking if ranking is not None else materialize(D.ranking(spark, sf), "labelled-ranking")
    return J.latest_labelled(r, J.build_product_keywords(r), k, tiebreak=(F.col("ranking").asc(),))


@query("a06_keyword_counts_by", D.with_ctes(D.RANKING_SQL, _LABELLED_SQL) + """
SELECT category, recommend, keyword, count(*) AS count
FROM (SELECT category, recommend, unnest(keywords) AS keyword FROM labelled)
WHERE category IS NOT NULL AND recommend IS NOT NULL AND keyword IS NOT NULL
GROUP BY ALL""")
def a06(spark, sf):
    ex = labelled(spark, sf).select("category", "recommend", F.explode("keywords").alias("keyword"))
    return A.keyword_counts_by(ex, ["category", "recommend", "keyword"])


@query("a06_kept_counts", D.with_ctes(D.RANKING_SQL, """kw AS (SELECT category, date, totalSales, discountRate / 20 AS rate, unnest(string_split(productName, ' ')) AS keyword FROM ranking)""") + """
SELECT category, keyword, count(*) AS count, CAST(sum(totalSales) AS BIGINT) AS sales, max(rate) FILTER (WHERE rate < 0.25) AS capped, CAST(max(date) AS BIGINT) AS last_date
FROM kw GROUP BY category, keyword""")
def a06_kept(spark, sf):
    """Keyword figures kept by deliveries, one of them repeated, the first two merged before the last comes."""
    r = materialize(D.ranking(spark, sf), "kept-ranking")
    rows = r.select("category", "date", "totalSales", (F.col("discountRate") / 20).alias("rate"), F.explode(F.split("productName", " ")).alias("keyword"))
    kept = KeptAggregate(BatchLedger(spark, scratch_path(spark, "kept-counts")), ["category", "keyword"],
                         [Measure("count", "count"), Measure("sales", "sum", "totalSales"), Measure("capped", "max_below", "rate", 0.25), Measure("last_date", "max", "date")])
    kept.deliver("1995", rows.where("date < 19960101"))
    kept.deliver("1997", rows.where("date >= 19960101 AND date < 19980101"))
    kept.compact("to-1997")
    kept.deliver("1997", rows.where("date >= 19960101 AND date < 19980101"))  # comes again
    kept.deliver("later", rows.where("date >= 19980101"))
    return kept.read()


_LABELLED_DETAIL_SQL = """ld AS (
  SELECT l.category, l.recommend, d.views, CAST(l.totalSales AS DOUBLE) AS totalSales
  FROM labelled l JOIN detail d ON l.productId = d.productId AND l.date = d.date)"""


def _mean_ratio_sql(value: str) -> str:
    m1 = f"avg({value}) FILTER (WHERE recommend = 1)"
    m0 = f"avg({value}) FILTER (WHERE recommend = 0)"
    return (D.with_ctes(D.RANKING_SQL, D.DETAIL_SQL, _LABELLED_SQL, _LABELLED_DETAIL_SQL) + f"""
SELECT category, COALESCE({m1}, 0.0) AS {value}_mean_1, COALESCE({m0}, 0.0) AS {value}_mean_0,
       CASE WHEN bool_or(recommend = 1) AND bool_or(recommend = 0) THEN {m0} / NULLIF({m1}, 0.0) END AS ratio
FROM ld GROUP BY category""")


def labelled_detail(spark: SparkSession, sf: str) -> DataFrame:
    ranking, detail = D.snapshots(spark, sf)
    l = labelled(spark, sf, ranking=ranking).select("productId", "date", "category", "recommend",
                                                    F.col("totalSales").cast("double").alias("totalSales"))
    return l.join(detail.select("productId", "date", "views"), ["productId", "date"])


@query("a07_mean_ratio_views", _mean_ratio_sql("views"))
def a07(spark, sf):
    return A.mean_ratio(labelled_detail(spark, sf), "views")


@query("a08_mean_ratio_sales", _mean_ratio_sql("totalSales"))
def a08(spark, sf):
    return A.mean_ratio(labelled_detail(spark, sf), "totalSales")


_CELLS = """count(*) FILTER (WHERE toxic = 1 AND quality = 1) AS tp,
       count(*) FILTER (WHERE toxic = 0 AND quality = 1) AS fn,
       count(*) FILTER (WHERE toxic = 1 AND quality = 0) AS fp,
       count(*) FILTER (WHERE toxic = 0 AND quality = 0) AS tn"""


@query("a09_confusion", f"SELECT {_CELLS} FROM labels")
def a09(spark, sf):
    return A.confusion(_t(spark, sf, "labels"), "quality", "toxic")


def sql_round2(expr: str) -> str:
    """Python ``round(x, 2)``: correctly rounded text of the exact double, read back."""
    return f"CAST(printf('%.2f', {expr}) AS DOUBLE)"


@query("a10_confusion_by", f"""
SELECT key AS lang, tp, fn, fp, tn,
       COALESCE({sql_round2('tp / NULLIF(tp + fn, 0)')}, 0.0) AS recall,
       COALESCE({sql_round2('tp / NULLIF(tp + fp, 0)')}, 0.0) AS precision
FROM (SELECT COALESCE(d.lang, 'ALL') AS key, {_CELLS.replace('toxic', 'l.toxic').replace('quality', 'l.quality')}
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY ROLLUP (d.lang))""")
def a10(spark, sf):
    l = _t(spark, sf, "labels").join(_t(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return A.confusion_by(l, "lang", "quality", "toxic")


@query("a11_distinct_values", _R + "SELECT DISTINCT category FROM ranking")
def a11(spark, sf):
    return A.distinct_values(D.ranking(spark, sf), "category")


@query("a12_row_count", "SELECT count(*) AS n FROM lineitem")
def a12(spark, sf):
    return A.row_count(_t(spark, sf, "lineitem"))


@query("a13_work_list", _R + "SELECT DISTINCT productId FROM ranking")
def a13(spark, sf):
    return A.work_list(D.ranking(spark, sf))


@query("a14_shape", "SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def a14(spark, sf):
    return A.shape(_t(spark, sf, "lineitem"))


# -- w01-w03, o01-o04 -------------------------------------------------------------------

_LATEST_ORDER_SQL = """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


@query("w01_latest_per_key", _LATEST_ORDER_SQL)
def w01(spark, sf):
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return W.latest_per_key(o, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query("w02_latest_by_max", _LATEST_ORDER_SQL)
def w02(spark, sf):
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return W.latest_by_max(o, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query("w03_top_n_per_group", """
SELECT p_type, p_partkey, p_retailprice FROM part
QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) <= 3""")
def w03(spark, sf):
    p = _t(spark, sf, "part").select("p_type", "p_partkey", "p_retailprice")
    return W.top_n_per_group(p, ["p_type"], [F.col("p_retailprice").desc(), F.col("p_partkey")], 3)


@query("o01_sort_desc", _R + "SELECT productId, date, ranking FROM ranking ORDER BY ranking DESC")
def o01(spark, sf):
    return W.sort_desc(D.ranking(spark, sf).select("productId", "date", "ranking"), "ranking", ["date", "productId"])


@query("o02_sort_multi", D.with_ctes(D.RANKING_SQL, _LABELLED_SQL) + """
SELECT category, recommend, keyword, count(*) AS count
FROM (SELECT category, recommend, unnest(keywords) AS keyword FROM labelled)
GROUP BY ALL ORDER BY category, recommend, count DESC""")
def o02(spark, sf):
    ex = labelled(spark, sf).select("category", "recommend", F.explode("keywords").alias("keyword"))
    counts = A.keyword_counts_by(ex, ["category", "recommend", "keyword"])
    return W.sort_by(counts, "category", "recommend", F.col("count").desc())


@query("o03_top_k", f"""
SELECT keyword, count(*) AS count FROM (SELECT unnest({_DOC_WORDS}) AS keyword FROM documents)
GROUP BY keyword ORDER BY count DESC, keyword LIMIT 100""")
def o03(spark, sf):
    docs = _t(spark, sf, "documents")
    words = docs.select(F.explode(X.drop_blank(F.split(F.lower("text"), "[ \\t\\n\\r]+"))).alias("keyword"))
    return W.top_k(A.keyword_counts(words), [F.col("count").desc(), F.col("keyword")], 100)


@query("o04_top10", """
SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 10""")
def o04(spark, sf):
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    return W.top_k(s, [F.col("s_acctbal").desc(), F.col("s_suppkey")], 10)


# -- u01-u05 -------------------------------------------------------------------------

@query("u01_union_all", _R + "SELECT productId, date, category FROM ranking")
def u01(spark, sf):
    r = D.ranking(spark, sf).select("productId", "date", "category")
    first = F.coalesce(F.col("category") < "medium", F.lit(False))  # the other half holds a null category too
    return R.union_all([r.filter(first), r.filter(~first)])


@query("u02_union_predictions", """
SELECT doc_id AS productId, 'quality' AS category, quality AS recommend, CAST(toxic AS DOUBLE) AS predicted_recommend,
       NULL AS note FROM labels
UNION ALL
SELECT doc_id, 'toxic', toxic, CAST(quality AS DOUBLE), 'swapped' FROM labels""")
def u02(spark, sf):
    l = _t(spark, sf, "labels")
    a = l.select(F.col("doc_id").alias("productId"), F.lit("quality").alias("category"),
                 F.col("quality").alias("recommend"), F.col("toxic").cast("double").alias("predicted_recommend"))
    b = l.select(F.col("doc_id").alias("productId"), F.lit("toxic").alias("category"),
                 F.col("toxic").alias("recommend"), F.col("quality").cast("double").alias("predicted_recommend"),
                 F.lit("swapped").alias("note"))
    return R.union_all([a, b])


@query("u03_except", f"""
SELECT p_partkey, {sql_keyword_tokens('p_name || chr(32) || p_brand')} AS keywords FROM part
EXCEPT
SELECT p_partkey, {sql_keyword_tokens('p_name || chr(32) || p_brand')} FROM part
WHERE len({sql_keyword_tokens('p_name || chr(32) || p_brand')}) = 0 OR p_size > 40""")
def u03(spark, sf):
    p = _t(spark, sf, "part").select(
        "p_partkey", "p_size", X.keyword_tokens(F.concat_ws(" ", "p_name", "p_brand")).alias("keywords"))
    empty = p.filter((F.size("keywords") == 0) | (F.col("p_size") > 40))
    return R.except_rows(p.drop("p_size"), empty.drop("p_size"))


@query("u04_concat", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < DATE '1998-01-01'
UNION ALL
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1997-01-01'""")
def u04(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return R.union_all([o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")),
                        o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))])


@query("u05_intersect", _RD + """
SELECT productId, date FROM ranking INTERSECT SELECT productId, date FROM detail WHERE views IS NOT NULL""")
def u05(spark, sf):
    ranking, detail = D.snapshots(spark, sf)
    return R.key_overlap(ranking, detail.filter(F.col("views").isNotNull()), ["productId", "date"])
