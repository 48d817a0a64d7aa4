"""Deliveries that are killed, repeated, corrected and read beside a writer."""

import os

import pytest
from pyspark.sql import functions as F

from rankflow.functions import metrics as M
from rankflow.operators import aggregates as A
from rankflow.operators import relational as R
from rankflow.sources import files as IO
from rankflow.sources.ledger import BatchLedger
from rankflow.streaming.ingest import ingest_snapshots

SCHEMA = "k long, day long, v string"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_null_key_delivered_three_times_is_one_row(spark, tmp_path):
    df = spark.createDataFrame([(None, 20240101, "a"), (1, None, "b"), (1, 20240101, "c"), (1, 20240101, "b2")], SCHEMA)
    ledger = BatchLedger(spark, str(tmp_path / "t"), df.schema)
    assert [ledger.deliver(f"b{i}", df, ["k", "day"], range_col="day") for i in range(3)] == [True] * 3
    assert _rows(ledger.read()) == [(1, 20240101, "b2"), (1, None, "b"), (None, 20240101, "a")]
    plain = str(tmp_path / "plain")
    for _ in range(3):
        IO.append_distinct(spark, df, plain, ["k", "day"], range_col="day")
    assert _rows(spark.read.parquet(plain)) == _rows(ledger.read())


def test_a_killed_batch_shows_nothing_and_is_repeated_whole(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, 1, "x") for i in range(50)], SCHEMA)
    ledger = BatchLedger(spark, str(tmp_path / "t"), df.schema)
    commit = BatchLedger._commit
    monkeypatch.setattr(BatchLedger, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        ledger.deliver("b1", df)
    assert ledger.read().count() == 0 and not ledger.committed("b1") and len(os.listdir(tmp_path / "t" / "attempts")) == 1
    monkeypatch.setattr(BatchLedger, "_commit", commit)
    assert ledger.deliver("b1", df) is True and ledger.deliver("b1", df) is False
    assert ledger.read().count() == 50
    assert ledger.remove_orphans() == 1 and ledger.remove_orphans() == 0 and ledger.read().count() == 50


def test_two_writers_of_one_batch_leave_one(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "x")], SCHEMA)
    ledger = BatchLedger(spark, str(tmp_path / "t"), df.schema)
    first = {"batch": "b", "attempt": "b-1", "rows": 1, "replaces": []}
    df.write.parquet(str(tmp_path / "t" / "attempts" / "b-1"))
    df.write.parquet(str(tmp_path / "t" / "attempts" / "b-2"))
    assert ledger._commit(first) is True and ledger._commit(first | {"attempt": "b-2"}) is False
    assert [m["attempt"] for m in ledger.manifests()] == ["b-1"] and ledger.read().count() == 1


def test_a_reader_keeps_its_batches(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "x")], SCHEMA)
    ledger = BatchLedger(spark, str(tmp_path / "t"), df.schema)
    ledger.deliver("b1", df)
    seen = ledger.read()
    ledger.deliver("b2", df.withColumn("k", F.lit(2).cast("long")))
    assert seen.count() == 1 and ledger.read().count() == 2


def test_a_correction_replaces_a_batch(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "wrong"), (2, 1, "right")], SCHEMA)
    ledger = BatchLedger(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        ledger.read()
    ledger.deliver("b1", df, ["k"])
    ledger.deliver("b2", df.withColumn("v", F.lit("right")), ["k"], replaces=["b1"])
    assert _rows(ledger.read()) == [(1, 1, "right"), (2, 1, "right")]
    with pytest.raises(ValueError):
        ledger.deliver("../b", df)


def test_an_empty_batch_is_a_batch(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    ledger = BatchLedger(spark, str(tmp_path / "t"), df.schema)
    assert ledger.deliver("b1", df, ["k"], range_col="day") and not ledger.deliver("b1", df) and ledger.read().count() == 0


def test_a_stream_without_its_checkpoint_adds_nothing(spark, tmp_path):
    src, sink = str(tmp_path / "src"), str(tmp_path / "sink")
    df = spark.createDataFrame([(1, 1, "x"), (None, 1, "y"), (None, 1, "y")], SCHEMA)
    df.write.parquet(src)
    for name in ("a", "b", "c"):
        ingest_snapshots(spark, src, sink, str(tmp_path / name), df.schema, ("k", "day"), fmt="parquet", policy="ledger", event_time="day", name=name)
    assert _rows(BatchLedger(spark, sink, df.schema).read()) == [(1, 1, "x"), (None, 1, "y")]


def test_one_per_key_is_the_least_row_in_any_order(spark):
    rows = [(1, 5, "a"), (1, 3, "z"), (1, 3, "b"), (None, 2, "n"), (None, None, "m")]
    for order in (rows, rows[::-1]):
        got = A.one_per_key(spark.createDataFrame(order, SCHEMA).repartition(3), ["k"])
        assert _rows(got) == [(1, 3, "b"), (None, None, "m")] and got.columns == ["k", "day", "v"]
    maps = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 0})], "k long, m map<string,int>")
    assert A.one_per_key(maps, ["k"]).first().m == {"a": 0}
    assert A.one_per_key(maps.select("k"), ["k"]).count() == 1
    detail = spark.createDataFrame([(1, 1, 9.0), (1, 1, 4.0)], "productId long, date long, views double")
    ranking = spark.createDataFrame([(1, 1, 2)], "productId long, date long, ranking int")
    for d in (detail, detail.orderBy("views")):
        assert R.join_snapshots(ranking, d).first().views == 4.0


def test_rounding_passes_infinity_and_nan(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (0.125,), (None,)], "x double")
    got = df.select(M.round_half_even("x").alias("r"), M.format_2dp("x").alias("t")).collect()
    assert [str(r.r) for r in got] == ["inf", "-inf", "nan", "0.12", "None"] and [r.t for r in got] == ["inf", "-inf", "nan", "0.12", None]
