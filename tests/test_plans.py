"""Plan-shape checks: the scale properties the operators rely on, read from
``explain`` output (physical plans), so a regression shows up as a test failure."""

import os

import pytest
from pyspark.sql import functions as F

from rankflow.operators import aggregates as A
from rankflow.operators import windows as W
from rankflow.plans import jobs as J

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    return spark.range(20000).select((F.col("id") % 50).alias("user_id"), F.col("id").alias("ts"),
                                     (F.col("id") % 3).alias("kind")).repartition(8)


def test_latest_per_key_limits_before_shuffle(spark, events):
    p = plan(W.latest_per_key(events, ["user_id"], "ts"))
    assert "WindowGroupLimit" in p and "Partial" in p
    # the partial limit sits below the exchange on user_id
    assert p.index("Partial") > p.index("Exchange hashpartitioning(user_id")


def test_top_n_per_group_limits_before_shuffle(spark, events):
    p = plan(W.top_n_per_group(events, ["kind"], [F.col("ts").desc()], 3))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_group_aggregates_combine_map_side(spark, events):
    p = plan(A.keyword_counts_by(events, ["user_id", "kind"]))
    assert "partial_count" in p


def test_confusion_by_is_one_aggregate(spark, events):
    df = events.select((F.col("kind") == 1).cast("int").alias("recommend"),
                       (F.col("kind") == 2).cast("double").alias("predicted_recommend"),
                       (F.col("user_id") % 4).cast("string").alias("category"))
    p = plan(A.confusion_by(df))
    assert "Expand" in p
    assert p.count("Exchange hashpartitioning") == 1


def test_keywords_shuffle_only_for_dedupe(spark):
    df = spark.createDataFrame([(i % 100, f"name {i % 100} 바지") for i in range(1000)],
                               "productId long, productName string").repartition(4)
    p = plan(J.build_product_keywords(df))
    # the input repartition plus the dedupe: no explode/regroup shuffles
    assert p.count("Exchange") == 2
    assert "collect_list" not in p and "Generate" not in p


def test_cap_is_a_subquery_not_a_cross_join(spark):
    df = spark.range(1000).select((F.col("id") / 500.0).alias("conversionRate"))
    p = plan(J.cap_rate(df))
    assert "Subquery" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_vocabulary_filter_is_a_subquery_not_a_cross_join(spark):
    from rankflow.functions import text as X

    df = spark.createDataFrame([(i, ["a", "b", f"w{i % 7}"]) for i in range(200)], "id long, kw array<string>")
    out = X.with_vocabulary(df, "kw", J.vocabulary(df, "kw", 3), "kept")
    p = plan(out)
    assert "Subquery" in p and "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_scan_prunes_columns_and_pushes_filters(spark):
    import __spark_entry__ as entry

    q = entry.queries()
    p02 = plan(q["p02_select"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p02
    p12 = plan(q["p12_predicates"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_linestatus)" in p12


def test_no_python_udfs_in_keyword_and_unit_plans(spark):
    from rankflow.functions import numbers as N
    from rankflow.functions import text as X

    df = spark.createDataFrame([("22만 회 이상 black 후드",)], "t string")
    p = plan(df.select(X.product_keywords("t"), N.parse_unit_number("t"), X.extract_colors("t")))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_bucketed_tables_join_without_shuffle(spark):
    import uuid

    from rankflow.session import scratch_path
    from rankflow.sources import files as IO

    a = spark.range(2000).select((F.col("id") % 300).alias("productId"), (F.col("id") % 7).alias("date"),
                                 F.col("id").alias("x"))
    b = a.select("productId", "date", (F.col("x") * 2).alias("y")).dropDuplicates(["productId", "date"])
    ta = IO.write_bucketed(a, f"ta_{uuid.uuid4().hex[:8]}", scratch_path(spark, "ta"), ["productId", "date"], 8)
    tb = IO.write_bucketed(b, f"tb_{uuid.uuid4().hex[:8]}", scratch_path(spark, "tb"), ["productId", "date"], 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = ta.join(tb, ["productId", "date"])
        assert "Exchange" not in plan(j) and "SortMergeJoin" in plan(j)
        assert j.count() == a.join(b, ["productId", "date"]).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_keywords_are_cut_once_a_product(spark):
    ranking = spark.createDataFrame([(1, "blue ring"), (1, "blue ring"), (1, None), (2, "-"), (None, "old bolt")], "productId long, productName string")
    found = J.build_product_keywords(ranking)
    assert sorted((str(r.productId), r.productName) for r in found.collect()) == [("1", "blue ring"), ("None", "old bolt")]
    lines = optimized(found).splitlines()
    at = next(i for i, line in enumerate(lines) if "Aggregate" in line)
    assert any("Filter" in line for line in lines[:at]) and not any("Filter" in line for line in lines[at:])


def test_rankings_alone_carry_no_detail_figures(spark, tmp_path):
    from rankflow.plans import driver as D

    part = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame([(i, "blue ring", "B", "LARGE" if i % 2 else "SMALL", 1, 900.0) for i in range(6)], part).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(60).selectExpr("id % 6 AS l_partkey", "timestamp_ntz'1997-01-01 00:00:00' AS l_shipdate", "CAST(id AS double) AS l_quantity", "0.05D AS l_discount",
                               "10.0D AS l_extendedprice", "CAST(id % 5 + 1 AS int) AS l_linenumber", "0.02D AS l_tax").write.parquet(f"{tmp_path}/lineitem.parquet")
    short = D.lineitem_daily(spark, str(tmp_path), with_detail=False)
    assert not {"views", "max_line", "rating"} & set(short.columns)
    whole = D.lineitem_daily(spark, str(tmp_path))
    assert sorted(D.ranking(spark, str(tmp_path)).collect()) == sorted(D.ranking(spark, str(tmp_path), whole).collect())
    assert D.detail(spark, str(tmp_path)).where("views IS NOT NULL").count() > 0


def test_details_alone_are_not_ordered(spark, tmp_path):
    from rankflow.plans import driver as D

    part = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame([(i, "blue ring", "B", "LARGE", 1, 900.0) for i in (0, 1, 1, None)], part).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(60).selectExpr("nullif(id % 4, 3) AS l_partkey", "date_add(DATE'1997-01-01', CAST(id % 5 AS int)) AS l_shipdate", "CAST(id AS double) AS l_quantity", "0.05D AS l_discount",
                               "10.0D AS l_extendedprice", "CAST(id % 7 + 1 AS int) AS l_linenumber", "0.02D AS l_tax").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert not {"_pid", "_mid"} & set(D.lineitem_daily(spark, str(tmp_path), ranked=False).columns)
    rows = sorted(D.detail(spark, str(tmp_path)).collect(), key=str)
    assert rows == sorted(D.detail(spark, str(tmp_path), D.lineitem_daily(spark, str(tmp_path))).collect(), key=str) and len(rows) == 15


def test_costly_rows_are_dealt_to_several_tasks_a_core(spark):
    from rankflow.plans import driver as D

    rows = spark.range(1000).select(F.col("id").alias("productId"), F.lit(1).alias("date")).coalesce(1)
    found = D.dealt(rows, "productId", "date")
    assert found.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism and found.count() == 1000
