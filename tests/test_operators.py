"""Relational, aggregate, window and job operators on hand-written rows."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from rankflow.operators import aggregates as A
from rankflow.operators import relational as R
from rankflow.operators import windows as W
from rankflow.plans import jobs as J


def test_non_empty_p03(spark):
    df = spark.createDataFrame([(1, None), (2, "123 T2"), (3, "nike")], "id long, name string")
    from rankflow.functions.text import keyword_tokens

    out = R.non_empty(df.withColumn("k", keyword_tokens("name")), "k")
    assert [r.id for r in out.collect()] == [3]


def test_cap_rate_f27(spark):
    df = spark.createDataFrame([(x,) for x in (0.2, 0.5, 1.0, 1.7)], "conversionRate double")
    assert [r[0] for r in J.cap_rate(df).collect()] == [0.2, 0.5, 1.0, 0.5]
    df = spark.createDataFrame([(x,) for x in (1.0, 1.7)], "conversionRate double")
    assert [r[0] for r in J.cap_rate(df).collect()] == [1.0, None]


def test_latest_per_key_w01(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (1, 2, 7)], "k long, ts long, id long")
    assert W.latest_per_key(df, ["k"], "ts", ["id"]).first().id == 7
    assert W.latest_by_max(df, ["k"], "ts", ["id"]).first().id == 7


def test_latest_per_key_one_row_per_key(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("ts"))
    out = W.latest_per_key(df, ["k"], "ts")
    assert out.count() == 7 and out.select("k").distinct().count() == 7


def test_not_yet_collected_j05(spark):
    new = spark.createDataFrame([(k, 1) for k in (1, 2, 3)], "productId long, date long")
    done = spark.createDataFrame([(2, 1)], "productId long, date long")
    assert sorted(r.productId for r in R.not_yet_collected(new, done).collect()) == [1, 3]
    assert [r.productId for r in R.already_collected(new, done).collect()] == [2]


def test_join_snapshots_dedupes_detail_j01(spark):
    r = spark.createDataFrame([(1, 2024, 10)], "productId long, date long, totalSales long")
    d = spark.createDataFrame([(1, 2024, 100.0, 3.0), (1, 2024, 100.0, 3.0)],
                              "productId long, date long, views double, totalSales double")
    out = R.join_snapshots(r, d).collect()
    assert len(out) == 1 and out[0].totalSales == 10 and out[0].detailTotalSales == 3.0


def test_mean_ratio_a07(spark):
    df = spark.createDataFrame([("A", 1, 4.0), ("A", 1, 4.0), ("B", 1, 2.0), ("B", 0, 1.0)],
                               "category string, recommend int, views double")
    got = {r.category: tuple(r)[1:] for r in A.mean_ratio(df, "views").collect()}
    assert got["A"] == (4.0, 0.0, None)
    assert got["B"] == (2.0, 1.0, 0.5)


def test_confusion_by_a10(spark):
    rows = [("c", 1, 0.0)] * 2 + [("c", 0, 0.0)] * 3
    df = spark.createDataFrame(rows, "category string, recommend int, predicted_recommend double")
    got = {r.category: r for r in A.confusion_by(df).collect()}
    c = got["c"]
    assert (c.tp, c.fn, c.fp, c.tn, c.precision, c.recall) == (0, 2, 0, 3, 0.0, 0.0)
    assert got["ALL"].fn == 2


def test_confusion_cells_sum_to_count(spark):
    df = spark.range(200).select((F.col("id") % 2).alias("recommend"),
                                 ((F.col("id") % 3) == 0).cast("double").alias("predicted_recommend"))
    r = A.confusion(df).first()
    assert r.tp + r.fn + r.fp + r.tn == 200


def test_regroup_tokens_keeps_order_a03(spark):
    df = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, "b")], "id long, pos int, keyword string")
    assert A.regroup_tokens(df, ["id"]).first().keywords == ["a", "b", "c"]


def test_higher_order_keywords_equal_explode_regroup(spark):
    """f01-f04 in-row equals the reference's explode/clean/regroup path (as a set per product)."""
    from rankflow.functions import text as X

    names = [(1, "오버핏 후드 T2 black. NB-12A [단독] 123 A-라인 nike"), (2, "a|b [c] 바지")]
    df = spark.createDataFrame(names, "productId long, productName string")
    fast = {r.productId: r.keywords for r in J.build_product_keywords(df).collect()}
    ex = df.select("productId", F.posexplode(X.keyword_tokens("productName")).alias("pos", "keyword"))
    ex = ex.withColumn("keyword", F.trim(F.regexp_replace("keyword", "[|]", ""))).filter("keyword != ''")
    ex = ex.select("productId", "pos", F.posexplode(F.split("keyword", X.SYMBOL_SPLIT)).alias("p2", "keyword"))
    ex = ex.withColumn("keyword", F.trim("keyword")).filter("keyword != ''")
    ex = ex.withColumn("pos", F.col("pos") * 1000 + F.col("p2"))
    slow = {r.productId: r.keywords for r in A.regroup_tokens(ex, ["productId"]).collect()}
    assert fast == slow


def test_union_all_count(spark):
    a = spark.range(10).select("id")
    b = spark.range(5).select("id", F.lit(1).alias("x"))
    assert R.union_all([a, b]).count() == 15


def test_top_k_ties_are_deterministic(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "keyword string, count long")
    out = W.top_k(df, [F.col("count").desc(), F.col("keyword")], 2).collect()
    assert [r.keyword for r in out] == ["a", "b"]


def test_recommend_smoke(spark):
    """Model smoke: fixed seed, predictions only for test rows, metrics in [0, 1]."""
    rows = []
    for i in range(120):
        cat = "pants" if i % 2 else "shoes"
        rows.append(Row(productId=i, category=cat, brandName=f"b{i % 5}", colors="black" if i % 3 else None,
                        keywords=["nike", "air"] if i % 4 else ["바지"], price=1000 + i, discountRate=float(i % 30),
                        conversionRate=0.1, trending=i % 2, totalSales=i * 10, views=float(i * 20),
                        likes=None if i % 7 == 0 else float(i), rating=4.0, ratingCount=10.0,
                        recommend=int(i < 60)))
    df = spark.createDataFrame(rows)
    df = df.withColumn("filtered_keywords", F.col("keywords")).fillna({"colors": "unknown"})
    preds, report, confusion = J.recommend(df, ["pants", "shoes"])
    vals = [r.value for r in report.collect()]
    assert vals and all(0.0 <= v <= 1.0 for v in vals)
    total = confusion.filter("category = 'ALL'").first()
    assert total.tp + total.fn + total.fp + total.tn == preds.count()


def test_rank_in_groups_matches_row_number_with_hot_group(spark):
    """A group holding most rows is split across range partitions; ranks equal row_number."""
    from pyspark.sql import Window

    df = spark.range(3000).select(
        F.when(F.col("id") < 2000, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("g"),
        (F.col("id") * 7919 % 1000).alias("v"), F.col("id"))
    got = W.rank_in_groups(df, ["g"], [F.col("v").desc(), F.col("id")], "r", num_partitions=8)
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("id"))
    want = df.withColumn("r", F.row_number().over(w))
    assert sorted(got.select("id", "r").collect()) == sorted(want.select("id", "r").collect())


def test_rank_in_groups_null_key(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, v long")
    got = {(r.g, r.v): r.r for r in W.rank_in_groups(df, ["g"], ["v"], "r").collect()}
    assert got == {(None, 1): 1, (None, 3): 2, ("a", 2): 1}


def test_metrics_equal_mllib_evaluator(spark):
    """m09/m10 from one cell table equal MulticlassClassificationEvaluator's numbers."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    from rankflow.operators import model as MO

    df = spark.range(500).select(
        ((F.col("id") * 7919 % 13) < 6).cast("double").alias("recommend"),
        ((F.col("id") * 104729 % 11) < 4).cast("double").alias("prediction"))
    got = MO.metrics(df, digits=None).first()
    for metric, col in (("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"),
                        ("weightedRecall", "weighted_recall")):
        ev = MulticlassClassificationEvaluator(labelCol="recommend", predictionCol="prediction", metricName=metric)
        assert abs(ev.evaluate(df) - got[col]) < 1e-12, metric
