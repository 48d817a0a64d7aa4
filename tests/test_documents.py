"""Drifted and broken JSON documents, observed writes, modes in one scan."""

import json

from pyspark.sql import functions as F

from rankflow.operators import features as FE
from rankflow.sources import files as IO
from rankflow.sources import json_items as JS


def _item(**change):
    item = {"id": "7", "info": {"brandName": "b", "productName": "p", "additionalInformation": [{"text": "3명이 보는 중"}, {"text": "2명이 구매 중"}]},
            "onClick": {"url": "/p", "eventLog": {"ga4": {"payload": {"price": 100, "original_price": 120, "discount_rate": 5}},
                                                  "amplitude": {"payload": {"reviewCount": "4", "reviewScore": "4.5"}}}},
            "image": {"rank": 3, "url": "/i", "labels": [{"text": "급상승"}, {"text": "판매 2천개"}]}}
    for path, value in change.items():
        at = item
        *way, last = path.split("__")
        for step in way:
            at = at[step]
        if value is ...:
            at.pop(last)
        else:
            at[last] = value
    return item


def _doc(*items):
    return json.dumps({"data": {"modules": [{"title": "x"}, {"items": list(items)}, {"items": None}]}}, ensure_ascii=False)


def _read(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "k long, value string")
    items, bad = JS.read_documents(df, keep=("k",))
    return JS.flatten_documents(items, "20241127", keep=("k",)), bad


def test_plain_documents_read_as_with_a_schema(spark):
    docs = [_doc(_item(), _item(image=...)), _doc(), _doc(_item(id="8", image__labels=[], onClick__eventLog__amplitude=...))]
    got, bad = _read(spark, docs)
    df = spark.createDataFrame(list(enumerate(docs)), "k long, value string")
    want = JS.flatten_ranking_json(df, "20241127", keep=("k",))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 2 and bad.isEmpty()
    assert got.columns == want.columns and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]


def test_drifted_values_keep_their_meaning(spark):
    plain = _read(spark, [_doc(_item())])[0].drop("k").first()
    drifts = [_item(image__rank="3"), _item(image__rank=3.0), _item(id=7), _item(onClick__eventLog__ga4__payload__price="100"),
              _item(info__additionalInformation=["3명이 보는 중", "2명이 구매 중"]), _item(onClick__eventLog__amplitude__payload={"reviewCount": 4, "reviewScore": 4.5}),
              _item(extra={"deep": [1, {"x": None}]})]
    for item in drifts:
        assert _read(spark, [_doc(item)])[0].drop("k").first() == plain, item
    one = _read(spark, [_doc(_item(image__labels={"text": "급상승"}))])[0].first()
    assert one.trending == 1 and one.sold_count is None
    odd = _read(spark, [_doc(_item(info=[1], image__labels=5, onClick__eventLog="none"))])[0].first()  # whole branches of another type
    assert (odd.brand_name, odd.trending, odd.final_price, odd.discount_rate, odd["rank"]) == (None, 0, None, 0, 3)


def test_unreadable_documents_are_kept_and_counted(spark):
    docs = [_doc(_item()), None, "", "{", "[1, 2", '"text"', "{}", '{"data": {"modules": {}}}', '{"data": {"modules": []}}', '{"data": {"modules": [3, {"items": "x"}]}}']
    got, bad = _read(spark, docs)
    assert {(r.k, r.value, r.reason) for r in bad.collect()} == {
        (1, None, "no document"), (2, "", "not JSON"), (3, "{", "not JSON"), (4, "[1, 2", "not JSON"), (5, '"text"', "no modules"), (6, "{}", "no modules"),
        (7, '{"data": {"modules": {}}}', "no modules")}
    assert [r.k for r in got.collect()] == [0]


def test_a_write_is_observed_without_a_second_scan(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.range(100).select("id", F.when(F.col("id") % 4 != 0, F.col("id")).alias("v")).mapInArrow(once, "id long, v long")
    seen = IO.write_observed(df, str(tmp_path / "t"), ranges=["v"])
    assert seen == {"rows": 100, "nulls.id": 0, "nulls.v": 25, "min.v": 1, "max.v": 99} and reads.value == 100
    empty = IO.write_observed(df.limit(0), str(tmp_path / "e"), ranges=["v"])
    assert empty["rows"] == 0 and empty["max.v"] is None


def test_modes_of_many_columns_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("b", None, None), ("b", "x", None), ("a", "x", None), ("a", None, None)], "p string, q string, r string").write.parquet(path)
    df = spark.read.parquet(path)
    assert {(r.column, r.value, r.n) for r in FE.modes_of(df, ["p", "q", "r"]).collect()} == {("p", "a", 2), ("q", "x", 2)}
    filled = FE.mode_impute(df, ["p", "q", "r"])
    assert sorted(map(tuple, filled.collect())) == [("a", "x", None)] * 2 + [("b", "x", None)] * 2
    filled.collect()
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedSubquery") >= 2  # the modes are found once for all columns
