"""Scans, sinks, JSON and HTML sources, and the streaming ingest."""

import json
import os

import pytest

from pyspark.sql import functions as F

from rankflow import schemas
from rankflow.session import scratch_path
from rankflow.sources import files as IO
from rankflow.sources import html as H
from rankflow.sources import json_items as JS
from rankflow.streaming.ingest import ingest_snapshots

BOM = "\ufeff"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_read_snapshot_bom_and_header_case(spark):
    root = scratch_path(spark, "t-csv")
    _write(f"{root}/bags_details.csv", BOM + "ProductID,Date,Views,Likes,Rating,RatingCount,TotalSales\n"
                                            "1,2024112800,12.0,3.0,,,\n2,2024112800,,1.0,4.5,2.0,7.0\n")
    df = IO.read_snapshot(spark, f"{root}/bags_details.csv", "detail")
    assert df.schema == schemas.DETAIL
    rows = sorted(df.collect())
    assert rows[0].productId == 1 and rows[0].views == 12.0 and rows[1].views is None and rows[1].rating == 4.5


def test_read_tree_category_from_file_name(spark):
    root = scratch_path(spark, "t-tree")
    header = "productId,brandName,productName,price,discountRate,currentlyViewing,currentlyBuying,ranking," \
             "trending,colors,date\n"
    _write(f"{root}/bags/20241127-ranking-bags-summary.csv", BOM + header + "1,b,n,100,10,1,2,1,0,,20241127\n")
    _write(f"{root}/x/20241127-ranking-clothes-top-summary.csv", header + "2,b,n,100,10,1,2,1,0,,20241127\n")
    _write(f"{root}/x/readme.txt", "not a csv")
    _write(f"{root}/x.csv", header + "3,b,n,100,10,1,2,1,0,,20241127\n")
    got = {r.productId: r.category for r in IO.read_tree(spark, root).collect()}
    assert got == {1: "bags", 2: "clothes_top", 3: "unknown"}
    assert IO.read_tree(spark, root, categories=["bags"]).count() == 1


def test_require_columns_s05(spark):
    df = spark.createDataFrame([(1,)], "productId long")
    assert schemas.require_columns(df, ["productId"]) is df
    assert schemas.require_columns(df, ["productId", "date"], on_missing="skip") is None


def test_append_distinct_s10(spark):
    path = scratch_path(spark, "t-append")
    a = spark.createDataFrame([(1, 1), (2, 1)], "productId long, date long")
    b = spark.createDataFrame([(2, 1), (3, 1), (3, 1)], "productId long, date long")
    IO.append_distinct(spark, a, path, ["productId", "date"])
    IO.append_distinct(spark, b, path, ["productId", "date"])
    assert sorted(r.productId for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_tsv_lines_s12(spark):
    df = spark.createDataFrame([(1, None, 12.345)], "a long, b string, d double")
    assert IO.to_tsv_lines(df, ["a", "b", "d"], two_dp=["d"]).first().value == "1\tNone\t12.35"


def test_ranking_json_s14_c09(spark):
    doc = {"data": {"modules": [
        {"items": [
            {"id": "77", "info": {"brandName": "B", "productName": "P", "additionalInformation": [
                {"text": "1.2천명이 보는 중"}, {"text": "62명이 구매 중"}]},
             "onClick": {"url": "/p/77", "eventLog": {
                 "ga4": {"payload": {"price": 9000, "original_price": 10000, "discount_rate": 10}},
                 "amplitude": {"payload": {"reviewCount": "12", "reviewScore": "96"}}}},
             "image": {"rank": 3, "url": "/i.jpg", "labels": [{"text": "급상승"}, {"text": "판매 2.2천개"}]}},
            {"id": "ad", "image": {"url": "/banner.jpg"}}]},
        {"title": "no items"}]}}
    df = spark.createDataFrame([(json.dumps(doc, ensure_ascii=False),)], "value string")
    rows = JS.flatten_ranking_json(df, "202411271530").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.product_id, r.rank, r.final_price, r.original_price, r.discount_rate) == ("77", 3, 9000, 10000, 10)
    assert (r.viewing, r.purchasing, r.trending, r.sold_count) == (1200, 62, 1, 2200)
    assert (r.review_count, r.review_score, r.date) == (12, 96.0, "202411271530")
    assert list(JS.FLAT_COLUMNS) == rows[0].__fields__


def test_html_extraction_s15_s16(spark):
    html = ('<div><span class="x">조회수</span><span>22만 회 이상</span>'
            '<span>누적판매</span><span> 1,234 </span>'
            '<a class="t" href="/p/1">first</a><a href="/p/2"> second </a></div>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    tiles = H.extract_tiles(pages).collect()
    assert [(t.pos, t.href, t.text) for t in tiles] == [(1, "/p/1", "first"), (2, "/p/2", "second")]
    r = pages.select(H.extract_labelled("html", "조회수").alias("v"), H.extract_labelled("html", "누적판매").alias("s"),
                     H.extract_labelled("html", "없음").alias("n")).first()
    assert (r.v, r.s, r.n) == ("22만 회 이상", "1,234", None)


def test_stream_ingest_t01_each_key_once(spark):
    src, sink, ckpt = (scratch_path(spark, f"t-stream-{n}") for n in ("src", "sink", "ckpt"))
    schema = "productId long, date long, views double"
    first = spark.createDataFrame([(1, 2024112800, 1.0), (2, 2024112800, 2.0)], schema)
    second = spark.createDataFrame([(2, 2024112800, 2.0), (3, 2024112900, 3.0)], schema)
    first.write.mode("append").parquet(src)
    ingest_snapshots(spark, src, sink, ckpt, first.schema, fmt="parquet", event_time="date")
    second.write.mode("append").parquet(src)
    ingest_snapshots(spark, src, sink, ckpt, first.schema, fmt="parquet", event_time="date")
    keys = sorted((r.productId, r.date) for r in spark.read.parquet(sink).collect())
    assert keys == [(1, 2024112800), (2, 2024112800), (3, 2024112900)]


def test_stream_ingest_watermark_policy(spark):
    src, sink, ckpt = (scratch_path(spark, f"t-wm-{n}") for n in ("src", "sink", "ckpt"))
    df = spark.createDataFrame([(1, "2024-11-28 10:00:00"), (1, "2024-11-28 10:00:00"), (2, "2024-11-28 11:00:00")],
                               "productId long, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.mode("append").parquet(src)
    ingest_snapshots(spark, src, sink, ckpt, df.schema, keys=("productId", "ts"), fmt="parquet",
                     policy="watermark", event_time="ts", delay="1 day")
    assert spark.read.parquet(sink).count() == 2


def test_read_tree_per_file_header_orders(spark):
    """Header families in different column order and case still line up."""
    root = scratch_path(spark, "t-tree-hdr")
    _write(f"{root}/a/20241127-ranking-bags-summary.csv",
           BOM + "productId,brandName,ranking,date\n1,b1,5,20241127\n2,b2,6,20241127\n")
    _write(f"{root}/b/20241127-ranking-shoes-summary.csv",
           "Date,Ranking,ProductID,BrandName\n20241128,7,3,b3\n")
    rows = sorted(IO.read_tree(spark, root).collect())
    got = [(r.productId, r.brandName, r.ranking, r.date, r.category) for r in rows]
    assert got == [(1, "b1", 5, 20241127, "bags"), (2, "b2", 6, 20241127, "bags"),
                   (3, "b3", 7, 20241128, "shoes")]


def test_ingest_batch_c10(spark):
    """Snapshot rows of the requested hour not yet collected, one per key."""
    from rankflow.plans import jobs as J

    root = scratch_path(spark, "t-ingest")
    header = "productId,brandName,productName,price,discountRate,currentlyViewing,currentlyBuying,ranking," \
             "trending,colors,date\n"
    _write(f"{root}/a/2024120120-ranking-bags-summary.csv", BOM + header +
           "1,b,n,100,10,1,2,1,0,,2024120120\n2,b,n,100,10,1,2,2,0,,2024120120\n"
           "2,b,n,100,10,1,2,2,0,,2024120120\n3,b,n,100,10,1,2,3,0,,2024120119\n")
    done = spark.createDataFrame([(1, 2024120120)], "productId long, date long")
    got = J.ingest_batch(spark, root, done, "202412012035").collect()
    assert sorted((r.productId, r.date, r.category) for r in got) == [(2, 2024120120, "bags")]


def test_enriched_lines_c03(spark):
    from rankflow.plans import jobs as J

    r = spark.createDataFrame([(1, 2024112800, "B", "black tee", "black", 3, 7000, 30.0, 5, "tops")],
                              "productId long, date long, brandName string, productName string, colors string, "
                              "ranking int, price long, discountRate double, totalSales long, category string")
    d = spark.createDataFrame([(1, 2024112800, 10.0, 2.0, None, None)],
                              "productId long, date long, views double, likes double, rating double, "
                              "ratingCount double")
    e = J.enrich_with_price_and_season(r, d)
    row = e.first()
    assert row.originalPrice == 10000.0 and row.season == "fall" and row.conversionRate == 0.5
    line = J.enriched_lines(e).first().value.split("\t")
    assert line[0] == "1" and line[1] == "2024-11-28 00:00:00" and line[8] == "30.00" and line[13] == "None"


def test_appends_keep_null_ranges_once_and_publish_keeps_other_partitions(spark, tmp_path):
    from rankflow.sources import files as IO
    from rankflow.sources import html
    from rankflow.streaming.ingest import _append_new

    rows = spark.createDataFrame([(1, 10), (2, None), (None, None)], "k long, day long")
    for write in (lambda p: IO.append_distinct(spark, rows, p, keys=["k"], range_col="day"),
                  lambda p: _append_new(rows, p, ["k", "day"], "day", ())):
        path = str(tmp_path / f"sink{id(write)}")
        write(path)
        first = spark.read.parquet(path).where("k = 2").count()
        write(path)
        assert first == 1 and spark.read.parquet(path).where("k = 2").count() == 1
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("no parquet")
    for write in (lambda: IO.append_distinct(spark, rows, str(broken)), lambda: _append_new(rows, str(broken), ["k"], None, ())):
        with pytest.raises(Exception):
            write()
    page = spark.createDataFrame([("<h1>T</h1><br>not bold<b>bold</b>",)], "html string")
    assert page.select(html.extract_labelled("html", "T", "h1", "b")).first()[0] == "bold"
