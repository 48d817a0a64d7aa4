"""Delimited files in many splits against Python's csv module reading them whole."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from rankflow.sources import files as IO
from rankflow.sources import records as R
from rankflow.sources.records import _lines, _splits, read_records


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def _text(rows, names, end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end, quoting=quoting)
    w.writerow(names)
    w.writerows(rows)
    return out.getvalue()


@pytest.fixture
def small_splits(spark):
    """Splits of 300 bytes, so that records and single fields cross many of them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _names(rng):
    parts = ["plain", "comma, inside", 'a "quoted" word', "new\nline", "\n\n", "", '"', "ends with quote\"", "é 한글", "x" * 50, "\n" * 3 + "y", "line\n1,2,3"]
    return rng.choice(parts) + rng.choice(parts)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_fields_with_newlines_over_many_splits(spark, tmp_path, small_splits, end):
    rng = random.Random(4)
    want = []
    for k in range(3):
        names = ["productId", "Name", "price"]
        rng.shuffle(names)
        rows = [{"productId": f"{k}-{i}", "Name": _names(rng), "price": str(rng.randint(1, 99))} for i in range(200)]
        if k == 2:
            rows[50]["Name"] = "very long\n" * 400  # one field over many splits
        _write(f"{tmp_path}/d{k}/f{k}.csv", ("﻿" if k else "") + _text([[r[c] for c in names] for r in rows], names, end))
        want += [(f"f{k}.csv", r["productId"], r["Name"] or None, r["price"]) for r in rows]
    got = read_records(spark, str(tmp_path), ["productId", "name", "price", "absent"])
    assert got.where("absent IS NOT NULL").count() == 0
    assert sorted(tuple(r)[:4] for r in got.collect()) == sorted(want, key=lambda r: r)
    assert _splits(_lines(spark, str(tmp_path), "*.csv")).groupBy("path").count().agg(F.min("count")).first()[0] > 20


def test_without_torn_fields_nothing_is_joined(spark, tmp_path):
    _write(f"{tmp_path}/a.csv", _text([["1", 'x "y", z'], ["2", ""]], ["productId", "name"]))
    got = read_records(spark, str(tmp_path), ["productId", "name"])
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(r) for r in got.collect()) == [("a.csv", "1", 'x "y", z'), ("a.csv", "2", None)]


def test_odd_files(spark, tmp_path, small_splits):
    _write(f"{tmp_path}/short.csv", 'productId,name\n\n1\n\n2,b,c,d\n3,""\n4,a\rb\n')
    _write(f"{tmp_path}/open.csv", 'NAME,PRODUCTID\nx,5\n"never closed,6\n' + "more\n" * 200)
    _write(f"{tmp_path}/head.csv", "productId,name")
    _write(f"{tmp_path}/empty.csv", "")
    _write(f"{tmp_path}/with space.csv", 'productId,name\n7,"a\n' + "b" * 400 + '"\n')
    got = sorted((r for r in read_records(spark, str(tmp_path), ["productId", "name"]).collect()), key=str)
    assert [tuple(r) for r in got if r["_file"] == "short.csv"] == [("short.csv", "1", None), ("short.csv", "2", "b"), ("short.csv", "3", ""), ("short.csv", "4", "a b")]
    assert [tuple(r) for r in got if r["_file"] == "with space.csv"] == [("with space.csv", "7", "a\n" + "b" * 400)]
    assert sorted((r.productId or "", r.name[:12]) for r in got if r["_file"] == "open.csv") == [("", "never closed"), ("5", "x")]
    assert {r["_file"] for r in got} == {"short.csv", "with space.csv", "open.csv"}


def test_a_file_without_its_header_is_an_error(spark, tmp_path):
    _write(f"{tmp_path}/good.csv", "productId,name\n1,a\n")
    _write(f"{tmp_path}/bad.csv", "id,name\n1,a\n")
    with pytest.raises(ValueError, match="no header row naming productId in .*bad.csv"):
        read_records(spark, str(tmp_path), ["productId", "name"])


def test_round_trip_through_the_csv_sink(spark, tmp_path):
    names = ["a,b", 'say "hi"', "two\nlines", 'all, of "it"\r\nhere', "back\\slash", "tail\\", None, "\"", "plain"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "productId long, productName string")
    IO.write_csv(df.repartition(2), f"{tmp_path}/out")
    got = IO.read_snapshot(spark, f"{tmp_path}/out").orderBy("productId").collect()
    assert [r.productName for r in got] == names


def test_plain_lines_are_cut_as_by_csv():
    names, columns = ["productid", "name", "x", "x"], ("productId", "x", "missing")
    plain = ["1,a,b,c", "2, é ,,", "", "3,,x y,'"]
    fields = R._plain_fields(plain, names, columns, ",")
    assert [f.to_pylist() for f in fields] == R._named(plain, names, columns, ",") == [["1", "2", "3"], ["b", None, "x y"], [None] * 3]
    assert [len(f) for f in R._plain_fields(["", ""], names, columns, ",")] == [0, 0, 0]
    for other in ('1,"a",b,c', "1,a,b", "1,a,b,c,d", "1,a\r,b,c", "﻿1,a,b,c", "1,a\0,b,c", " "):
        assert R._plain_fields([other], names, columns, ",") is None
        batches = list(R._named_batches(["4,a,b,c", other], "f", names, columns, ","))
        assert [b.to_pydict()["x"] for b in batches] == [R._named(["4,a,b,c", other], names, columns, ",")[1]]
