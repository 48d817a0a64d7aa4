"""Scalar functions against the hand-written cases (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from rankflow.functions import metrics as M
from rankflow.functions import numbers as N
from rankflow.functions import text as X

NAME = "오버핏 후드 T2 black. NB-12A [단독] 123 A-라인 nike"


def one(spark, expr, data=None, schema="v string"):
    df = spark.createDataFrame(data or [(None,)], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_keyword_tokens_f02(spark):
    assert one(spark, X.keyword_tokens("v"), [(NAME,)]) == [["오버핏", "후드", "[단독]", "A-라인", "nike"]]


def test_strip_symbols_f03(spark):
    assert one(spark, X.strip_symbols(F.array("v")), [("a[b|c]d",)]) == [["a[bc]d"]]


def test_product_keywords_c02(spark):
    assert one(spark, X.product_keywords("v"), [(NAME,)]) == [["오버핏", "후드", "단독", "A", "라인", "nike"]]


def test_clean_tokens_stop_words_f05_f07(spark):
    toks = X.whitespace_tokens(X.clean_name("v"))
    assert one(spark, toks, [(" The Best (BLACK) 후드-티",)]) == [["", "the", "best", "black", "후드티"]]
    assert one(spark, X.remove_stop_words(toks), [(" The Best (BLACK) 후드-티",)]) == [["", "best", "black", "후드티"]]


def test_stop_words_equal_spark_default(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(X.english_stop_words()) == StopWordsRemover.loadDefaultStopWords("english")


def test_extract_colors_f13(spark):
    assert one(spark, X.extract_colors("v"), [("Navy 블랙 knit",), ("plain",)]) == ["navy | 블랙", None]


def test_unit_numbers_f14_f15_f18(spark):
    rows = [("22만 회 이상",), ("1,234",), ("1.2천",), ("2.3백",), ("",), (None,), ("4.1천만",)]
    assert one(spark, N.parse_unit_number("v"), rows) == [220000, 1234, 1200, 230, None, None, 41000000]
    assert one(spark, N.parse_unit_number("v", N.RANKING_UNITS, (" ",)), [("1,234",)]) == [1]
    assert one(spark, N.parse_unit_number("v", null_as=0), [(None,)]) == [0]
    # Decimal arithmetic: float multiply-then-truncate would give 229 and 32299.
    assert one(spark, N.parse_unit_number("v"), [("2.3백",), ("32.3천",)]) == [230, 32300]


def test_viewing_buying_f19(spark):
    infos = F.array(F.struct(F.lit("1.2천명이 보는 중").alias("text")), F.struct(F.lit("62명이 구매 중").alias("text")))
    df = spark.range(1).select(infos.alias("i"))
    r = df.select(N.viewing_count("i"), N.buying_count("i")).first()
    assert tuple(r) == (1200, 62)


def test_sales_count_f20(spark):
    assert one(spark, N.sales_count("v"), [("판매 2.2천개",), ("판매 500개",), (None,)]) == [2200, None, None]


def test_label_flags_f21(spark):
    labels = F.array(F.struct(F.lit("급상승").alias("text")), F.struct(F.lit("판매 2.2천개").alias("text")))
    r = spark.range(1).select(N.trending_from_labels(labels), N.sales_text_from_labels(labels)).first()
    assert tuple(r) == (1, "판매 2.2천개")
    empty = F.array().cast("array<struct<text:string>>")
    r = spark.range(1).select(N.trending_from_labels(empty), N.sales_text_from_labels(empty)).first()
    assert tuple(r) == (0, None)


def test_conversion_rates_f25_f26(spark):
    rows = [(5.0, 10.0), (5.0, 0.0), (5.0, None)]
    df = spark.createDataFrame(rows, "s double, v double")
    assert [r[0] for r in df.select(M.conversion_rate("s", "v")).collect()] == [0.5, 0.0, 0.0]
    assert [r[0] for r in df.select(M.conversion_rate_nullable("s", "v")).collect()] == [0.5, 0.0, None]


def test_original_price_f29(spark):
    rows = [(70, 30.0), (75, 0.25), (50, 0.0), (50, 1.0), (50, 100.0)]
    df = spark.createDataFrame(rows, "p long, d double")
    assert [r[0] for r in df.select(M.original_price("p", "d")).collect()] == [100.0, 100.0, 50.0, None, None]


def test_parse_stamp_f30(spark):
    got = one(spark, M.parse_stamp("v"), [("20241128",), ("2024120120",), ("202412012035",), ("x",)])
    assert got == [dt.datetime(2024, 11, 28), dt.datetime(2024, 12, 1, 20), dt.datetime(2024, 12, 1, 20, 35), None]


def test_season_f31(spark):
    rows = [(dt.date(2024, m, 1),) for m in (2, 3, 6, 9, 10, 11, 12)]
    assert one(spark, M.season("v"), rows, "v date") == ["winter", "spring", "summer", "summer", "fall", "fall",
                                                          "winter"]


def test_round_and_format_f34_f35(spark):
    rows = [(0.125,), (0.675,), (0.575,), (1.125,)]
    assert one(spark, M.round_half_even("v"), rows, "v double") == [round(x, 2) for (x,) in rows]
    assert one(spark, M.format_2dp("v"), rows + [(None,)], "v double") == \
        ["{:.2f}".format(x) for (x,) in rows] + [None]


def test_stamp_prefix_and_snapshot_stamp_f32_f36(spark):
    assert one(spark, M.stamp_prefix("v"), [(202412012035,)], "v long") == ["2024120120"]
    at = F.lit(dt.datetime(2024, 12, 1, 20, 35)).cast("timestamp")
    assert spark.range(1).select(M.snapshot_stamp(at)).first()[0] == "2024120120"


def test_safe_rating_and_first_numeric_s17_s18(spark):
    from rankflow.sources import html as H

    assert one(spark, H.safe_rating("v"), [("4.5",), ("45",), (".5",), ("4.5.1",), ("",), ("-1",)]) == \
        [4.5, 45.0, 0.5, None, None, None]
    arr = F.array(F.lit("조회"), F.lit("1,234"), F.lit("56"))
    assert spark.range(1).select(H.first_numeric(arr)).first()[0] == 1234


def test_trending_and_strip_f23_f24(spark):
    assert one(spark, X.trending_flag("v"), [("급상승 1위",), ("x",), (None,)]) == [1, 0, 0]
    assert one(spark, X.strip_text("v"), [("\n\t a b \t",)]) == ["a b"]
