"""Classification forests for all groups in one job (m06, m08, m17, c08).

Trees grow level by level.  A level is one aggregate over the rows: the histogram of
(group, tree, node, feature, bin), from which every node's split follows.  So the number of
passes is the depth and the plan doesn't grow with the number of groups (product categories),
trees or features; a large group is counted by all tasks, a thousand small ones too.

A row's features are cells ``feature, bin``; bin 0 is left out, so one-hot and keyword features
cost a cell only where they are present.  A split sends the rows whose bin reaches a bound to
the right.  Nodes are numbered as in a heap (root 0, children 2n + 1 and 2n + 2).  A row's node is
found by walking the splits of its group, which stand in one array; rows are never rewritten.

Bootstrap weights (Poisson of mean 1) and the features that a node may split on follow from hashes of
the row, the tree, the node and the feature: reruns agree however rows are dealt out.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.session import materialize


@dataclass(frozen=True)
class ForestSpec:
    """``features``: how many features a node may split on ("sqrt" of those present in it, "all", or a
    number).  A split has ``min_rows`` rows (by weight) on both sides and a gain above ``min_gain``."""

    trees: int = 20
    depth: int = 5
    features: str | int = "sqrt"
    bootstrap: bool = True
    min_rows: int = 1
    min_gain: float = 1e-9
    seed: int = 42

    @property
    def nodes(self) -> int:
        return 2 ** (self.depth + 1) - 1


def quantile_cuts(df: DataFrame, cols: Sequence[str], bins: int = 32, accuracy: int = 10_000) -> dict[str, list[float]]:
    """Up to ``bins - 1`` bounds a column, from approximate quantiles of all rows in one pass."""
    at = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), at, accuracy).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return {c: sorted(set(row[f"c{i}"] or [])) for i, c in enumerate(cols)}


def numeric_cells(cuts: Mapping[str, Sequence[float]]) -> Column:
    """Cells of numeric columns: the bin is the number of bounds below the value (null: 0)."""
    empty = F.array().cast("array<struct<feature:string,bin:int>>")

    def cell(col: str, bounds: Sequence[float]) -> Column:
        x = F.col(col).cast("double")
        if len(bounds) <= 8:  # compared in compiled code
            below = functools.reduce(operator.add, [(F.lit(float(b)) < x).cast("int") for b in bounds], F.lit(0))
        else:
            below = F.size(F.filter(F.array(*[F.lit(float(b)) for b in bounds]), lambda b: b < x))
        n = F.when(x.isNotNull(), below).otherwise(0)
        return F.when(n > 0, F.array(F.struct(F.lit(col).alias("feature"), n.alias("bin")))).otherwise(empty)

    return F.concat(*[cell(c, bounds) for c, bounds in cuts.items()]) if cuts else empty


def value_cells(col: str) -> Column:
    """A cell for the value of a text column, or for each distinct value of an array column."""
    def cell(value: Column) -> Column:
        return F.struct(F.concat(F.lit(f"{col}="), value).alias("feature"), F.lit(1).alias("bin"))

    return F.when(F.col(col).isNull(), F.array().cast("array<struct<feature:string,bin:int>>")).otherwise(F.array(cell(F.col(col).cast("string"))))


def item_cells(col: str) -> Column:
    own = F.array_distinct(F.filter(F.coalesce(F.col(col), F.array().cast("array<string>")), lambda x: x.isNotNull()))
    return F.transform(own, lambda x: F.struct(F.concat(F.lit(f"{col}="), x).alias("feature"), F.lit(1).alias("bin")))


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)).cast("double") / F.lit(float(1 << 40))


def _poisson(u: Column) -> Column:
    """The Poisson variate of mean 1 at probability ``u``."""
    chance, total, bounds = math.exp(-1), 0.0, []
    for k in range(12):
        total += chance
        bounds.append(total)
        chance /= k + 1
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= u))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _walk(splits: Column, names: Column, bins: Column, tree: Column, depth: int, spec: ForestSpec) -> Column:
    """The node of a row in a tree after ``depth`` levels of the splits.  ``names`` and ``bins``: the row's cells."""
    def step(node: Column, _: Column) -> Column:
        def go(split: Column) -> Column:
            own = F.get(bins, F.array_position(names, split["feature"]).cast("int") - 1)
            return F.when(split.isNull(), node).when(F.coalesce(own, F.lit(0)) >= split["bin"], 2 * node + 2).otherwise(2 * node + 1)

        return _let(F.get(splits, tree * spec.nodes + node), go)

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) if depth else F.lit(0)


def _walks(splits: Column, cells: Column, depth: int, spec: ForestSpec, use) -> Column:
    """``use(tree, node)`` of each tree: an array.  The cells are taken apart once a row."""
    trees = F.sequence(F.lit(0), F.lit(spec.trees - 1))
    return _let(F.struct(cells["feature"].alias("names"), cells["bin"].alias("bins")), lambda own: F.transform(
        trees, lambda t: use(t, _walk(splits, own["names"], own["bins"], t, depth, spec))))


def fit_forests(rows: DataFrame, group: str, label: str, cells: str = "cells", key: str = "row", spec: ForestSpec = ForestSpec(),
                stored: bool = False) -> DataFrame:
    """``group, tree, node, n, n1, feature, bin, gain`` of every node of every group's forest; the last
    three are null at leaves.  ``label`` is 0 or 1; rows without a label are left out; a null group is a
    group.  ``key`` identifies a row (it draws the row's weights).  ``stored``: the rows are read from a
    written table, so that each level may read them from there."""
    made = None
    own = [F.col(group).alias("group"), F.col(label).cast("long").alias("y"), F.col(cells).alias("cells")]
    data = rows.where(F.col(label).isNotNull())
    if spec.bootstrap:  # a row's weights, drawn once
        weights = F.transform(F.sequence(F.lit(0), F.lit(spec.trees - 1)), lambda t: _poisson(_unit(F.lit(spec.seed), t, F.col(key))).cast("byte"))
        data = materialize(data.select(*own, weights.alias("w")), "forest-rows")
    else:
        data = data.select(*own) if stored else materialize(data.select(*own), "forest-rows")
    for depth in range(spec.depth + 1):
        if made is None:
            at = data.withColumn("splits", F.lit(None).cast("array<struct<feature:string,bin:int>>"))
        else:
            model = split_table(made, spec)
            at = data.alias("d").join(model.alias("m"), F.col("d.group").eqNullSafe(F.col("m.group"))).select("d.*", "m.splits")
        # nodes of this level; the splits, which are wide, stay behind before the trees are dealt out
        nodes = _walks(F.col("splits"), F.col("cells"), depth, spec, lambda t, node: F.struct(
            t.alias("tree"), node.alias("node"), (F.get("w", t).cast("long") if spec.bootstrap else F.lit(1).cast("long")).alias("w")))
        nodes = F.filter(nodes, lambda x: (x["node"] >= 2**depth - 1) & (x["w"] > 0))
        placed = at.select("group", "y", "cells", F.explode(nodes).alias("p")).select("group", "y", "cells", "p.*")
        whole = F.array(F.struct(F.lit("").alias("feature"), F.lit(0).alias("bin")))
        counted = placed.select("group", "tree", "node", "w", "y", F.explode(F.concat(whole, "cells") if depth < spec.depth else whole).alias("c"))
        hist = materialize(counted.groupBy("group", "tree", "node", F.col("c.feature").alias("feature"), F.col("c.bin").alias("bin")).agg(
            F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("n1")), "forest-histogram")
        totals = hist.where("feature = ''").select("group", "tree", "node", "n", "n1")
        best = _best_splits(hist, totals, spec) if depth < spec.depth else None
        if best is None:
            level = totals.select("*", F.lit(None).cast("string").alias("feature"), F.lit(None).cast("int").alias("bin"), F.lit(None).cast("double").alias("gain"))
        else:
            same = F.col("t.group").eqNullSafe(F.col("b.group")) & (F.col("t.tree") == F.col("b.tree")) & (F.col("t.node") == F.col("b.node"))
            level = totals.alias("t").join(best.alias("b"), same, "left").select("t.*", "b.feature", "b.bin", "b.gain")
        level = materialize(level, "forest-level")
        made = level if made is None else made.unionByName(level)
        if level.where("feature IS NOT NULL").isEmpty():
            break
    return made


def _score(n: Column, n1: Column) -> Column:
    """Sum of squared class counts over the count: the larger, the purer."""
    return (n1 * n1 + (n - n1) * (n - n1)) / n


def _best_splits(hist: DataFrame, totals: DataFrame, spec: ForestSpec) -> DataFrame:
    """Each node's split of largest gain, ties by feature, then by bin."""
    node = ["group", "tree", "node"]
    down = Window.partitionBy(*node, "feature").orderBy(F.desc("bin"))
    right = hist.where("feature <> ''").select(*node, "feature", "bin", F.sum("n").over(down).alias("r"), F.sum("n1").over(down).alias("r1"))
    same = F.col("h.group").eqNullSafe(F.col("t.group")) & (F.col("h.tree") == F.col("t.tree")) & (F.col("h.node") == F.col("t.node"))
    both = right.alias("h").join(totals.alias("t"), same).select(
        *[F.col(f"h.{c}").alias(c) for c in (*node, "feature", "bin")],
        *[F.col(c).cast("double").alias(c) for c in ("n", "n1", "r", "r1")])
    left, left1 = F.col("n") - F.col("r"), F.col("n1") - F.col("r1")
    able = both.where((F.col("r") >= spec.min_rows) & (left >= spec.min_rows) & (left > 0) & (F.col("r") > 0)).withColumn(
        "score", _score(F.col("r"), F.col("r1")) + _score(left, left1)).withColumn("gain", F.col("score") - _score(F.col("n"), F.col("n1")))
    if spec.features != "all":
        drawn = F.xxhash64(F.lit(spec.seed + 1), "tree", "node", "feature")
        by_feature = able.groupBy(*node, "feature").agg(F.min_by(F.struct("bin", "gain"), F.struct((-F.col("score")).alias("s"), F.col("bin"))).alias("b"), F.max("score").alias("score"))
        place = F.row_number().over(Window.partitionBy(*node).orderBy(drawn, "feature"))
        most = F.ceil(F.sqrt(F.count(F.lit(1)).over(Window.partitionBy(*node)).cast("double"))) if spec.features == "sqrt" else F.lit(int(spec.features))
        able = by_feature.withColumn("place", place).withColumn("most", most).where(F.col("place") <= F.col("most")).select(*node, "feature", "b.bin", "b.gain", "score")
    found = able.groupBy(*node).agg(F.min_by(F.struct("feature", "bin", "gain"), F.struct((-F.col("score")).alias("s"), F.col("feature"), F.col("bin"))).alias("b"))
    return found.select(*node, "b.*").where(F.col("gain") > spec.min_gain)


def split_table(model: DataFrame, spec: ForestSpec) -> DataFrame:
    """``group, splits, shares``: a row a group, arrays with a place for each node of each tree (at most
    ``trees`` x ``nodes``): the split (null at leaves) and the share of label 1."""
    entry = F.struct((F.col("tree") * spec.nodes + F.col("node")).cast("int").alias("place"),
                     F.when(F.col("feature").isNotNull(), F.struct("feature", "bin")).alias("split"), (F.col("n1") / F.col("n")).alias("share"))
    own = model.groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct(entry["place"], entry))).alias("at"))
    places = F.sequence(F.lit(0), F.lit(spec.trees * spec.nodes - 1))
    return own.select("group", F.transform(places, lambda i: F.col("at")[i]["split"]).alias("splits"), F.transform(places, lambda i: F.col("at")[i]["share"]).alias("shares"))


def predict_forests(rows: DataFrame, model: DataFrame, group: str, cells: str = "cells", spec: ForestSpec = ForestSpec(), how: str = "left") -> DataFrame:
    """``rows`` with ``probability`` (mean share of label 1 at the row's leaves) and ``prediction`` (1 above
    one half).  Rows of a group without a model have null in both; ``how="inner"`` leaves them out, where
    a filter on the prediction would walk the trees again."""
    names = [F.col(f"r.{c}") for c in rows.columns if c not in ("probability", "prediction")]
    met = rows.alias("r").join(split_table(model, spec).alias("m"), F.col(f"r.{group}").eqNullSafe(F.col("m.group")), how)
    leaf = _walks(F.col("m.splits"), F.col(f"r.{cells}"), spec.depth, spec, lambda t, node: F.get(F.col("m.shares"), t * spec.nodes + node))
    mean = F.aggregate(leaf, F.lit(0.0), lambda a, x: a + x) / F.lit(float(spec.trees))
    out = met.select(*names, F.when(F.col("m.splits").isNotNull(), mean).alias("probability"))
    return out.withColumn("prediction", (F.col("probability") > 0.5).cast("double"))


def importances(model: DataFrame, by_group: bool = False) -> DataFrame:
    """m17: ``feature, importance``: each tree's gains add up to 1, the trees' mean, adding up to 1 (of
    each group with ``by_group``)."""
    tree = ["group", "tree"]
    gains = model.where("feature IS NOT NULL").groupBy(*tree, "feature").agg(F.sum("gain").alias("gain"))
    share = gains.withColumn("share", F.col("gain") / F.sum("gain").over(Window.partitionBy(*tree)))
    keys = ["group"] if by_group else []
    summed = share.groupBy(*keys, "feature").agg(F.sum("share").alias("share"))
    total = F.sum("share").over(Window.partitionBy(*keys)) if keys else summed.agg(F.sum("share")).scalar()
    return summed.select(*keys, "feature", (F.col("share") / total).alias("importance"))
