"""Mixing sources to target weights (operator 7): entropy balancing.

Each document has a rate, the expected number of its copies.  Among all rates that give
every source its target of words, those with the least relative entropy to one copy
each are ``exp(lambda * words)`` with one multiplier a source, at most ``max_copies``.
The multipliers solve the convex dual by Newton steps, kept inside a bracket; each step
is one aggregate over the words-per-document histogram, for all sources at once.
Rates are rounded to copies by systematic rounding along documents ordered by
size: whole copies follow the running sum of the rates, so the words taken stay within
the longest document of the target; single documents are then switched to close the gap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import SPACES, unused
from rankflow.session import materialize


@dataclass(frozen=True)
class MixSpec:
    """``weights`` go to sources in code-point order, null last, and repeat.  ``max_copies`` bounds
    a document's copies and a source's target.  ``tolerance``: relative gap at which a source's
    Newton steps end; ``max_steps`` bounds them.  A group of documents of equal source and size is
    numbered in parts of about ``part_rows``.  ``repairs``: rounds of switching single documents."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    max_copies: int = 3
    tolerance: float = 1e-4
    max_steps: int = 30
    part_rows: int = 20_000
    repairs: int = 3


def text_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    blanks = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(blanks == "", F.lit(0)).otherwise(F.size(F.split(blanks, "[\\x20\\x09-\\x0D]+"))).cast("long")


def targets(sizes: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """Per source of ``sizes`` (source, size): source, source_size, target.

    Targets share all words by weight; one at its cap passes the excess on by weight, until
    none is above.  Sources are numbered by code point over range partitions, so no task
    holds them all.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = materialize(totals.withColumn("_last", F.col("source").isNull()).repartitionByRange("_last", "source")
                          .sortWithinPartitions("_last", "source").withColumn("_id", F.monotonically_increasing_id())
                          .withColumn("_part", F.spark_partition_id()), "sources")
    parts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("first"))
    parts = parts.select("_part", "first", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("before"))
    number = F.pmod(F.col("before") + F.col("_id") - F.col("first"), F.lit(len(spec.weights))).cast("int")
    cap = (F.col("source_size") * spec.max_copies).cast("double")
    table = ordered.join(parts, "_part").select(
        "source", "source_size", F.element_at(F.array(*map(F.lit, spec.weights)), number + 1).alias("weight"), cap.alias("cap"))
    table = materialize(table, "source-weights")
    # A share a unit of weight; raised until what is not capped fits it.
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("cap") <= F.lit(level) * F.col("weight")
        n, taken, free = table.agg(F.count_if(over), F.sum(F.when(over, F.col("cap")).otherwise(0.0)),
                                   F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if n == capped or not free:
            break
        capped, level = n, (total - taken) / free
    target = F.when(F.col("cap") <= F.lit(level) * F.col("weight"), F.col("cap")).otherwise(F.lit(level) * F.col("weight"))
    return materialize(table.select("source", "source_size", target.alias("target")), "source-targets")


def _rate(size: Column, multiplier: Column, mean: Column, spec: MixSpec) -> Column:
    top = F.log(F.lit(float(spec.max_copies)))
    return F.exp(F.least(top, multiplier * size / mean))


def multipliers(cells: DataFrame, goals: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """Per source: multiplier (of words over the source's mean) and mean, from the histogram
    ``cells`` (source, size, n) and ``goals`` (source, source_size, target).

    A source at its cap, or without words, has no finite multiplier and takes the largest.
    Each step writes the sources' small state to the shared folder, which cuts lineage.
    """
    top = 1e9
    mean = F.greatest(F.lit(1.0), F.col("source_size") / F.col("n"))
    n_docs = cells.groupBy("source").agg(F.sum("n").alias("n"))
    state = goals.join(n_docs, goals["source"].eqNullSafe(n_docs["source"])).select(
        goals["source"], "source_size", "target", mean.alias("mean"),
        (F.col("target") >= spec.max_copies * F.col("source_size") * (1 - 1e-12)).alias("full"))
    state = state.withColumns({"low": F.lit(-top), "high": F.lit(top), "x": F.when(F.col("full"), F.lit(top)).otherwise(
        F.log(F.col("target") / F.greatest(F.lit(1.0), F.col("source_size").cast("double")))),
        "done": F.col("full") | (F.col("source_size") == 0)})
    state = materialize(state, "dual-state")
    for _ in range(spec.max_steps):
        s = state.where(~F.col("done")).alias("s")
        rate = _rate(F.col("size"), F.col("x"), F.col("mean"), spec)
        inner = F.when(rate < spec.max_copies - 1e-9, rate).otherwise(0.0)
        sums = cells.alias("c").join(s, F.col("c.source").eqNullSafe(F.col("s.source"))).groupBy(F.col("s.source").alias("source")).agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("got"),
            F.sum(F.col("n") * F.col("size") * F.col("size") / F.col("mean") * inner).alias("slope"))
        gap = F.col("got") - F.col("target")
        low = F.when(gap < 0, F.col("x")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("x")).otherwise(F.col("high"))
        joined = state.alias("t").join(sums.alias("g"), F.col("t.source").eqNullSafe(F.col("g.source")), "left").select(
            "t.*", "got", "slope", low.alias("_low"), high.alias("_high"), gap.alias("gap"))
        # Newton on the gradient's logarithm, which is nearly straight: words grow exponentially in x.
        newton = F.col("x") - F.log(F.col("got") / F.col("target")) * F.col("got") / F.col("slope")
        # Outside its bracket a Newton point is replaced: by the middle, or a doubling where one end is open.
        middle = F.when((F.col("_low") > -top) & (F.col("_high") < top), (F.col("_low") + F.col("_high")) / 2).when(
            F.col("_high") < top, F.col("x") * 2 - F.abs(F.col("x")) - 1).otherwise(F.col("x") * 2 + 1 + F.abs(F.col("x")))
        fine = (F.col("slope") > 0) & (newton > F.col("_low")) & (newton < F.col("_high")) & (F.abs(newton - F.col("x")) <= 2 * (1 + F.abs(F.col("x"))))
        met = F.col("done") | (F.abs(F.col("gap")) <= spec.tolerance * F.col("target"))
        state = materialize(joined.select(
            "source", "source_size", "target", "mean", "full", F.when(met, F.col("low")).otherwise(F.col("_low")).alias("low"),
            F.when(met, F.col("high")).otherwise(F.col("_high")).alias("high"),
            F.when(met, F.col("x")).when(fine, newton).otherwise(middle).alias("x"), met.alias("done")), "dual-state")
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("source", "source_size", "target", "mean", F.col("x").alias("multiplier"))


def mix(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, rate, copies, taken
    (= copies * size).

    Null texts have size 0 and, like all documents without words, one copy.  Null is a source of
    its own.  An empty table gives an empty result.  Reruns on the same rows agree: the order
    that rounding follows is by size, then by a hash of doc_id, doc_id; rows equal in all
    of these may swap their copies.
    """
    sized = materialize(docs.select("doc_id", "source", text_words(F.col("text")).alias("size")), "sized")
    goals = targets(sized.select("source", "size"), spec)
    cells = materialize(sized.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    salts = -(-(cells.agg(F.max("n")).first()[0] or 1) // spec.part_rows)  # the largest group's parts
    rows = sized.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    salted = rows.where("size > 0").groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("n"))
    solved = materialize(multipliers(cells, goals, spec), "multipliers")

    # Running sum of the rates' fractions: over a source's sizes, then over a size's salts, then over its documents.
    rate = _rate(F.col("size"), F.col("multiplier"), F.col("mean"), spec)
    rate = F.when(F.abs(rate - F.round(rate)) < 1e-9, F.round(rate)).otherwise(rate)
    rated = cells.alias("c").join(solved.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select(
        F.col("c.source").alias("source"), "size", "n", "target", "source_size", rate.alias("rate"))
    part = F.col("rate") - F.floor("rate")
    over_sizes = Window.partitionBy("source").orderBy(F.col("size").desc())
    rated = rated.withColumn("before", F.sum(F.col("n") * part).over(over_sizes) - F.col("n") * part)
    same = (F.col("r.source").eqNullSafe(F.col("h.source"))) & (F.col("r.size") == F.col("h.size"))
    spread = salted.alias("h").join(rated.alias("r"), same).select(
        F.col("h.source").alias("source"), F.col("h.size").alias("size"), "salt", "rate", "target", "source_size",
        (F.col("before") + (F.sum("h.n").over(Window.partitionBy("h.source", "h.size").orderBy("salt")) - F.col("h.n")) * part).alias("before"))
    own = Window.partitionBy("source", "size", "salt").orderBy(F.xxhash64("doc_id"), "doc_id")
    numbered = rows.where("size > 0").withColumn("rank", F.row_number().over(own))
    same = F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.size") == F.col("s.size")) & (F.col("d.salt") == F.col("s.salt"))
    extra = (F.floor(F.col("before") + F.col("rank") * part + 0.5) - F.floor(F.col("before") + (F.col("rank") - 1) * part + 0.5))
    names = ["doc_id", "source", "size"]
    rounded = numbered.alias("d").join(spread.alias("s"), same).select(
        *[F.col(f"d.{c}").alias(c) for c in names], "rate", (F.floor("rate") + extra).cast("long").alias("copies"))
    worded = _repair(materialize(rounded.withColumn("row", F.monotonically_increasing_id()), "copies"), goals, spec)
    wordless = sized.where("size = 0").select(*names, F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"))
    both = worded.select(*names, "rate", "copies").unionByName(wordless).alias("d")
    return both.join(goals.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source"))).select(
        "doc_id", "d.source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _repair(rounded: DataFrame, goals: DataFrame, spec: MixSpec) -> DataFrame:
    """Add or take a copy of the one document a source whose size comes nearest to its gap, while that helps.

    All switches are found on the histogram of (source, size, copies), then documents are taken for
    them by (hash of the id, id), and the rows meet these few once.  ``rounded`` is a written table with a ``row`` key.
    """
    cells = materialize(rounded.groupBy("source", "size", "copies").agg(F.count(F.lit(1)).alias("n")), "copies-histogram")
    switched = None
    for k in range(spec.repairs):
        taken = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("copies") * F.col("size")).alias("taken"))
        gap = goals.alias("g").join(taken.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source"))).select(
            F.col("g.source").alias("source"), (F.col("target") - F.col("taken")).alias("gap"))
        step = F.when(F.col("gap") > 0, 1).otherwise(-1)
        able = F.when(F.col("gap") > 0, F.col("copies") < spec.max_copies).otherwise(F.col("copies") > 0)
        left = F.abs(F.abs(F.col("gap")) - F.col("size"))
        best = cells.alias("c").join(gap.alias("g"), F.col("c.source").eqNullSafe(F.col("g.source"))).where(
            able & (left < F.abs(F.col("gap")))).groupBy(F.col("g.source").alias("source")).agg(
            F.min(F.struct(left.alias("left"), F.col("size").alias("size"), F.col("copies").alias("copies"), step.alias("step"))).alias("b"))
        best = materialize(best.select("source", "b.size", "b.copies", "b.step"), "switches")  # one row a source
        if best.isEmpty():
            break
        switched = best if switched is None else switched.unionByName(best)
        moved = cells.unionByName(best.select("source", "size", "copies", F.lit(-1).cast("long").alias("n"))).unionByName(
            best.select("source", "size", (F.col("copies") + F.col("step")).alias("copies"), F.lit(1).cast("long").alias("n")))
        cells = materialize(moved.groupBy("source", "size", "copies").agg(F.sum("n").alias("n")).where("n > 0"), "copies-histogram")
    if switched is None:
        return rounded
    # A document switched to c copies and one switched away from c cancel out, as far as they go.
    change = switched.select("source", "size", "copies", F.lit(1).alias("out")).unionByName(
        switched.select("source", "size", (F.col("copies") + F.col("step")).alias("copies"), F.lit(-1).alias("out"))).groupBy("source", "size", "copies").agg(
        F.sum("out").cast("int").alias("out"))
    leave = change.where("out > 0")
    same = F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.size") == F.col("c.size")) & (F.col("r.copies") == F.col("c.copies"))
    own = Window.partitionBy("source", "size", "copies").orderBy(F.xxhash64("doc_id"), "doc_id", "row")
    able = rounded.alias("r").join(leave.alias("c"), same).select("r.row", "r.doc_id", "r.source", "r.size", "r.copies", "out")
    gone = able.withColumn("k", F.row_number().over(own)).where(F.col("k") <= F.least("out", F.lit(spec.repairs)))
    # documents that leave cells of a (source, size), in order, go to the cells that gain there
    seat = Window.partitionBy("source", "size")
    leaving = gone.withColumn("seat", F.row_number().over(seat.orderBy("copies", "k")))
    gains = change.where("out < 0").select("source", "size", F.col("copies").alias("to"), F.explode(F.sequence(F.lit(1), -F.col("out"))).alias("k"))
    arriving = gains.withColumn("seat", F.row_number().over(seat.orderBy("to", "k")))
    meet = F.col("l.source").eqNullSafe(F.col("a.source")) & (F.col("l.size") == F.col("a.size")) & (F.col("l.seat") == F.col("a.seat"))
    moves = leaving.alias("l").join(arriving.alias("a"), meet).select("l.row", "to")
    return rounded.join(moves, "row", "left").withColumn("copies", F.coalesce("to", "copies")).drop("to")


def repeated(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (0 to ``max_copies`` times).

    Copies are decided on ids and sizes; the texts are joined to them once.  Rows of one
    doc_id are told apart by their source and size; equal ones share their copies.
    """
    names = docs.columns
    plan = mix(docs, spec).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    own, n = unused(names, "size"), unused(names, "n")
    d = docs.withColumn(own, text_words(F.col("text"))).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col(f"d.{own}") == F.col("p.size"))
    single = d.join(plan.where("rows = 1 AND copies > 0").alias("p"), same).select("d.*", F.col("p.copies").alias(n))
    within = Window.partitionBy("d.doc_id", "d.source", f"d.{own}").orderBy("d.text")
    several = d.join(plan.where("rows > 1 AND copies > 0").alias("p"), same).select("d.*", (
        F.floor(F.col("p.copies") / F.col("p.rows")) + (F.row_number().over(within) <= F.col("p.copies") % F.col("p.rows")).cast("int")).alias(n))
    both = single.unionByName(several)
    return both.select(*[both[c] for c in names], F.explode(F.array_repeat(F.lit(0), both[n].cast("int"))).alias(own)).select(*names)
