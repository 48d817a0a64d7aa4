"""Dictionaries without the driver and forests of all groups in one job, against plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rankflow.operators import dictionary as DI
from rankflow.operators import trees as TR


def test_label_ids_follow_frequency_then_value(spark):
    values = ["b"] * 5 + ["a"] * 5 + ["c"] * 9 + [None] * 20 + ["", "é"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    table = DI.label_table(df, "v")
    assert {r.label: r.id for r in table.collect()} == {"c": 0, "a": 1, "b": 2, "": 3, "é": 4}
    probe = spark.createDataFrame([("c",), ("zz",), (None,)], "v string")
    got = {r.v: (r.v_index, r.v_ohe) for r in DI.encode(probe, {"v": table}).collect()}
    assert got["c"][0] == 0.0 and got["zz"][0] == got[None][0] == 5.0
    assert got["c"][1].asDict() == {"size": 5, "indices": [0], "values": [1.0]} and got[None][1].asDict() == {"size": 5, "indices": [], "values": []}


def test_nothing_of_a_dictionary_is_collected(spark, monkeypatch):
    from pyspark.sql import DataFrame
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    for kind in {DataFrame, Classic}:
        for name in ("collect", "toPandas", "toArrow", "first", "take", "toLocalIterator"):
            monkeypatch.setattr(kind, name, lambda *a, **b: pytest.fail("rows reached the driver"), raising=False)
    df = spark.range(500).select((F.col("id") % 37).cast("string").alias("v"), F.array((F.col("id") % 41).cast("string")).alias("t"), "id")
    DI.encode(df, {"v": DI.label_table(df, "v")}).write.format("noop").mode("overwrite").save()
    DI.term_vectors(df, "t", DI.term_table(df, "t"), ["id"]).write.format("noop").mode("overwrite").save()


@pytest.mark.parametrize("least", [1, 2])
def test_term_vectors_count_known_terms(spark, least):
    rng = random.Random(2)
    rows = [(i, [rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))] if i % 7 else None) for i in range(60)] + [(60, ["rare", None, "rare"])]
    df = spark.createDataFrame(rows, "k long, t array<string>")
    held = Counter(x for _, t in rows for x in set(t or []) if x is not None)
    total = Counter(x for _, t in rows for x in t or [] if x is not None and held[x] >= least)
    ids = {t: i for i, (t, _) in enumerate(sorted(total.items(), key=lambda e: (-e[1], e[0])))}
    table = DI.term_table(df, "t", min_rows=least)
    assert {r.term: r.id for r in table.collect()} == ids
    got = {r.k: r.vector for r in DI.term_vectors(df, "t", table, ["k"]).collect()}
    for k, t in rows:
        want = sorted((ids[x], float(n)) for x, n in Counter(x for x in t or [] if x in ids).items())
        assert got[k].size == len(ids) and list(zip(got[k].indices, got[k]["values"])) == want


def brute_tree(rows, depth, min_rows=1):
    """Splits {node: (feature, bin)} and shares {node: share} of one tree on rows of (cells, label)."""
    splits, shares, queue = {}, {}, [(0, rows)]
    for node, own in queue:
        n, n1 = len(own), sum(y for _, y in own)
        shares[node] = n1 / n
        score = lambda k, k1: (k1 * k1 + (k - k1) * (k - k1)) / k
        best = None
        if node < 2**depth - 1:
            for feature, bound in sorted({(f, b) for cells, _ in own for f, b in cells.items()}):
                right = [r for r in own if r[0].get(feature, 0) >= bound]
                r, r1 = len(right), sum(y for _, y in right)
                if r >= min_rows and n - r >= min_rows:
                    s = score(float(r), r1) + score(float(n - r), n1 - r1)
                    if best is None or s > best[0]:
                        best = (s, feature, bound)
        if best and best[0] - score(float(n), n1) > 1e-9:
            splits[node] = best[1:]
            for child, side in ((2 * node + 1, False), (2 * node + 2, True)):
                queue.append((child, [r for r in own if (r[0].get(best[1], 0) >= best[2]) is side]))
    return splits, shares


def _rows(spark, n=400):
    rng = random.Random(5)
    out = []
    for i in range(n):
        group = rng.choice(["a", "a", "a", "b", None, "one"]) if i else "single"
        x, brand, words = rng.randint(0, 9), rng.choice("pqr"), rng.sample("uvwxyz", rng.randint(0, 3))
        y = int((x > 5) ^ (brand == "p") or "u" in words and rng.random() < 0.7) if group != "one" else 1
        out.append((group, i, y, float(x) if i % 11 else None, brand if i % 13 else None, words))
    df = spark.createDataFrame(out, "g string, row long, y int, x double, brand string, words array<string>")
    return df.withColumn("cells", F.concat(TR.numeric_cells({"x": [0.0, 2.0, 4.0, 5.0, 7.0]}), TR.value_cells("brand"), TR.item_cells("words")))


@pytest.mark.parametrize("depth, least", [(0, 1), (1, 1), (4, 1), (3, 9)])
def test_a_tree_equals_brute_force_in_every_group(spark, depth, least):
    spec = TR.ForestSpec(trees=1, depth=depth, features="all", bootstrap=False, min_rows=least)
    df = _rows(spark).persist()
    model = TR.fit_forests(df, "g", "y", spec=spec)
    groups = defaultdict(list)
    for r in df.collect():
        groups[r.g].append(({c.feature: c.bin for c in r.cells}, r.y))
    scored = {r.row: (r.g, r.probability, r.prediction) for r in TR.predict_forests(df, model, "g", spec=spec).collect()}
    for g, own in groups.items():
        splits, shares = brute_tree(own, depth, least)
        mine = model.where(F.col("group").eqNullSafe(F.lit(g))).collect()
        assert {r.node: (r.feature, r.bin) for r in mine if r.feature is not None} == splits, g
        assert {r.node: r.n1 / r.n for r in mine} == shares, g
    for r in df.collect():
        splits, shares = brute_tree(groups[r.g], depth, least)
        node, cells = 0, {c.feature: c.bin for c in r.cells}
        while node in splits:
            node = 2 * node + (2 if cells.get(splits[node][0], 0) >= splits[node][1] else 1)
        assert scored[r.row] == (r.g, shares[node], float(shares[node] > 0.5))


def test_forests_agree_however_rows_are_dealt(spark):
    spec = TR.ForestSpec(trees=5, depth=3)
    key = lambda m: sorted((str(r.group), r.tree, r.node, r.n, r.n1, str(r.feature), str(r.bin)) for r in m.collect())
    df = _rows(spark)
    first = key(TR.fit_forests(df, "g", "y", spec=spec))
    assert key(TR.fit_forests(df.repartition(7), "g", "y", spec=spec)) == first
    trees = {t for _, t, *_ in first}
    assert trees == set(range(5)) and len({tuple(e[3:] for e in first if e[1] == t) for t in trees}) > 1  # the trees differ


def test_a_forest_learns_and_importances_add_up(spark):
    df = _rows(spark, 900).where("g IN ('a', 'b')")
    spec = TR.ForestSpec(trees=15, depth=4)
    model = TR.fit_forests(df, "g", "y", spec=spec)
    right = TR.predict_forests(df, model, "g", spec=spec).select(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert right > 0.8
    found = {r.feature: r.importance for r in TR.importances(model).collect()}
    assert abs(sum(found.values()) - 1) < 1e-9 and found["x"] > found["words=z"]
    assert {round(r.s, 9) for r in TR.importances(model, by_group=True).groupBy("group").agg(F.sum("importance").alias("s")).collect()} == {1.0}


def test_groups_without_a_model_and_without_labels(spark):
    df = _rows(spark)
    spec = TR.ForestSpec(trees=1, depth=1, features="all", bootstrap=False)
    model = TR.fit_forests(df.where("g = 'b'").withColumn("y", F.when(F.col("row") % 2 == 0, F.col("y"))), "g", "y", spec=spec)
    got = TR.predict_forests(df, model, "g", spec=spec)
    assert got.where("g = 'b' AND prediction IS NULL").isEmpty() and got.where("g = 'a' AND prediction IS NOT NULL").isEmpty()
    assert got.count() == df.count()


def test_plans_do_not_grow_with_groups(spark, monkeypatch):
    counts = []
    for n in (2, 40):
        df = spark.range(400).select(F.col("id").alias("row"), (F.col("id") % n).cast("string").alias("g"), (F.col("id") % 3 == 0).cast("int").alias("y"),
                                     F.array(F.struct(F.lit("f").alias("feature"), (F.col("id") % 3).cast("int").alias("bin"))).alias("cells"))
        calls = []
        with monkeypatch.context() as m:
            real = TR.materialize
            m.setattr(TR, "materialize", lambda d, name: calls.append(name) or real(d, name))
            TR.fit_forests(df, "g", "y", spec=TR.ForestSpec(trees=1, depth=2, features="all", bootstrap=False))
        counts.append(len(calls))
    assert counts[0] == counts[1]


def test_scores_of_groups_with_a_model_walk_the_trees_once(spark):
    df = _rows(spark).persist()
    spec = TR.ForestSpec(trees=3, depth=2)
    model = TR.fit_forests(df.where("g IN ('a', 'b') OR g IS NULL"), "g", "y", spec=spec, stored=True)
    key = lambda d: sorted((r.row, r.probability, r.prediction) for r in d.collect())
    inner = TR.predict_forests(df, model, "g", spec=spec, how="inner")
    assert key(inner) == key(TR.predict_forests(df, model, "g", spec=spec).where("prediction IS NOT NULL"))
    assert inner.where("g IS NULL").count() == df.where("g IS NULL").count()
    plan = inner._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "array_position" in line]


def test_the_splits_stay_behind_when_trees_are_dealt_out(spark, monkeypatch):
    plans, real = [], TR.materialize
    monkeypatch.setattr(TR, "materialize", lambda d, name: plans.append((name, d._jdf.queryExecution().optimizedPlan().toString())) or real(d, name))
    TR.fit_forests(_rows(spark), "g", "y", spec=TR.ForestSpec(trees=3, depth=1))
    dealt = [line for name, plan in plans if name == "forest-histogram" for line in plan.splitlines() if "Generate explode(filter" in line]
    assert dealt and not any("Generate explode([0,1,2])" in plan for _, plan in plans)


def test_cells_of_few_and_many_bounds_count_alike(spark):
    bounds = [float(x) for x in range(20)]
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (0.5,), (7.0,), (7.5,), (99.0,), (float("nan"),)], "x double")
    for cuts in (bounds[:8], bounds):
        for r in df.withColumn("c", TR.numeric_cells({"x": cuts})).collect():
            n = 0 if r.x is None else len(cuts) if r.x != r.x else sum(b < r.x for b in cuts)
            assert [tuple(c) for c in r.c] == ([("x", n)] if n else [])


def test_numbers_start_where_told_and_are_rounded_late(spark):
    df = spark.createDataFrame([(1.23456789012, 1e-12, None, 7.0, float("inf"))], "a double, b double, c double, d double, e double")
    got = df.select(DI.join_vectors([lambda at: DI.numbers(["a"], at), lambda at: DI.numbers(["b", "c", "d", "e"], at, 9)]).alias("v")).first().v
    assert (got.size, got.indices, got["values"]) == (5, [0, 1, 3, 4], [1.23456789012, 0.0, 7.0, float("inf")])


@pytest.mark.parametrize("least", [1, 2])
def test_term_table_of_rows_that_stand_for_many(spark, least):
    rows = [(["a", "b", "a"], 3), (["b", None], 4), (None, 9), (["c"], 1)]
    whole = spark.createDataFrame([(t,) for t, n in rows for _ in range(n)], "t array<string>")
    want = {r.term: r.id for r in DI.term_table(whole, "t", min_rows=least).collect()}
    table = DI.term_table(spark.createDataFrame(rows, "t array<string>, n long"), "t", min_rows=least, times="n")
    assert {r.term: r.id for r in table.collect()} == want and table.schema == DI.term_table(whole, "t", min_rows=least).schema


def test_assembling_makes_a_products_keywords_once(spark, tmp_path, monkeypatch):
    """Not once a product and day; the vectors are those of the SQL."""
    import datetime

    import duckdb

    from rankflow.plans import q_ml
    from rankflow.plans.catalog import oracle_sql

    parts = [(i, f"Brand#{i % 3}", ["navy blue rose", "rose rose", "", "tin  BLUE"][i % 4], ["PROMO TIN", "LARGE TIN"][i % 2], 900.0 + i) for i in range(9)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_name string, p_type string, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    rng = random.Random(3)
    lines = [(rng.randrange(9), datetime.date(1997, 1, 1) + datetime.timedelta(rng.randrange(20)), float(rng.randint(1, 50)), rng.randint(100, 900000) / 100,
              rng.randint(0, 10) / 100, rng.randint(0, 8) / 100, rng.randint(1, 7)) for _ in range(200)]
    spark.createDataFrame(lines, "l_partkey long, l_shipdate date, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_linenumber int"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    dealt, vectors = [], DI.term_vectors
    monkeypatch.setattr(DI, "term_vectors", lambda df, *a, **b: dealt.append(df.count()) or vectors(df, *a, **b))
    got = sorted((r.productId, r.date, r.size, r.indices, r["values"]) for r in q_ml.m05_whole(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert got == sorted(con.execute(oracle_sql()["m05_assemble_whole"]).fetchall())
    assert dealt == [9] and len(got) > 90
