"""Kept aggregates against recomputation, and files left out by name."""

import os
import random

import pytest

from rankflow.operators.incremental import KeptAggregate, Measure
from rankflow.sources import files as IO
from rankflow.sources.ledger import BatchLedger

SCHEMA = "g string, v long, x double"
MEASURES = [Measure("n", "count"), Measure("nv", "count", "v"), Measure("s", "sum", "v"), Measure("low", "min", "x"), Measure("high", "max", "x"), Measure("cap", "max_below", "x", 0.5)]


def _rows(df):
    return sorted((tuple(r) for r in df.select("g", "n", "nv", "s", "low", "high", "cap").collect()), key=str)


def test_deliveries_equal_recomputation(spark, tmp_path):
    rng = random.Random(3)
    batches = [[(rng.choice(["a", "b", None]), rng.choice([None, 1, 2]), rng.choice([None, 0.1, 0.4, 0.5, 0.9])) for _ in range(rng.randint(0, 30))] for _ in range(6)]
    kept = KeptAggregate(BatchLedger(spark, str(tmp_path / "t")), ["g"], MEASURES)
    whole = []
    for k, rows in enumerate(batches):
        df = spark.createDataFrame(rows, SCHEMA)
        assert kept.deliver(f"d{k}", df) is True and kept.deliver(f"d{k}", df) is False
        whole += rows
        if k in (2, 4):
            before = _rows(kept.read())
            assert kept.compact(f"upto-{k}") and _rows(kept.read()) == before
            assert kept.deliver(f"d{k}", df) is False  # a replaced batch stays delivered
        want = spark.createDataFrame(whole, SCHEMA).groupBy("g").agg(*[m.partial() for m in MEASURES])
        assert _rows(kept.read()) == _rows(want)


def test_stored_partials_are_as_many_as_keys(spark, tmp_path):
    ledger = BatchLedger(spark, str(tmp_path / "t"))
    kept = KeptAggregate(ledger, ["g"], MEASURES)
    kept.deliver("d", spark.createDataFrame([("a", i, 0.1) for i in range(500)], SCHEMA))
    assert [m["rows"] for m in ledger.manifests()] == [1]


def test_files_are_left_out_by_name(spark, tmp_path):
    def put(name, text):
        path = tmp_path / "landing" / name
        os.makedirs(path.parent, exist_ok=True)
        path.write_text(text)

    put("a/20241127-ranking-bags-summary.csv", "productId,date\n1,20241127\n")
    put("b/20241127-ranking-clothes-top-summary.csv", "date,productId\n20241127,2\n")
    put("c/20241127-ranking-shoes-summary.csv", "no header\n3\n")  # would be an error if it were opened
    put("d/plain.csv", "productId,category\n4,bags\n5,shoes\n")
    root = str(tmp_path / "landing")
    read = lambda wanted, **kw: sorted((r.productId, r.category) for r in IO.read_tree(spark, root, categories=wanted, **kw).collect())
    assert read(["bags", "clothes_top"], by_name=True) == [(1, "bags"), (2, "clothes_top"), (4, "bags")]
    with pytest.raises(ValueError, match="shoes"):
        read(["bags"])
