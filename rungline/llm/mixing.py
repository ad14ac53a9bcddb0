"""Mixing sources to target weights by entropy balancing, in DataFrame operations alone.

Among all rates with the wanted words per source, those of least relative entropy are exponentially tilted:
``rate = min(limit, exp(lambda * size / mean size))``. Newton steps on the convex dual, each one aggregation over the
sizes of all documents, find every source's lambda at once; a bracket catches steps that leave it. Rates become whole copies so
that each source's words stay next to the target.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rungline.llm import common

WEIGHTS = (5.0, 2.0, 1.0)


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(common.WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = 3.0) -> DataFrame:
    """``source, source_size, n, smallest, target`` of each source of ``sizes (source, size)``.

    Sources by code point, null last, take the weights in turn and share the sum of all sizes; none gets more than ``limit`` times its own
    size, the rest is shared by weight among the others.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("n"),
                                       F.min(F.when(F.col("size") > 0, F.col("size"))).alias("smallest"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    each = each.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")))
    full = limit * F.col("source_size")
    order = Window.orderBy(F.col("full_at"), F.col("source").asc_nulls_last())
    each = each.withColumn("full_at", full / F.col("weight"))
    total = F.sum("source_size").over(Window.partitionBy())
    spent = F.coalesce(F.sum(full).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    each = each.withColumn("share", (total - spent) / rest)
    # sources are full in the order of full_at; the first that is not full fixes the share of one unit of weight
    unit = F.min(F.when(F.col("share") <= F.col("full_at"), F.struct("full_at", "share"))).over(Window.partitionBy())["share"]
    return each.withColumn("unit", unit).select(
        "source", "source_size", "n", "smallest",
        F.least(F.coalesce(F.col("weight") * F.col("unit"), full), full).alias("target"))


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["source"].eqNullSafe(right["source"])


def tilts(histogram: DataFrame, goal: DataFrame, limit: float = 3.0, tolerance: float = 1e-9, most: int = 200) -> DataFrame:
    """``goal`` with ``lam``, each source's multiplier; ``histogram (source, size, m)`` counts documents by size."""
    mean = F.col("source_size") / F.col("n")
    low = F.when(F.col("target") < F.col("source_size"), F.log(F.col("target") / F.col("source_size")) * mean / F.col("smallest")).otherwise(0.0)
    high = F.when(F.col("target") < F.col("source_size"), 0.0).otherwise(F.log(F.lit(limit)) * mean / F.col("smallest"))
    goal = goal.where("n > 0").withColumn("mean", mean)
    full = F.col("target") >= limit * F.col("source_size") * (1 - 1e-12)
    state = common.written(goal.withColumn("low", low).withColumn("high", high)
                           .withColumn("lam", F.when(full, F.col("high")).otherwise(0.0)).withColumn("off", F.lit(1.0)), "dual")
    for _ in range(most):
        x = F.col("size") / F.col("mean")
        tilted = F.exp(F.col("lam") * x)
        met = histogram.join(state.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
        sums = met.groupBy("source").agg(
            F.sum(F.col("m") * F.col("size") * F.least(F.lit(limit), tilted)).alias("got"),
            F.sum(F.when(tilted < limit, F.col("m") * F.col("size") * x * tilted).otherwise(0.0)).alias("slope"),
        ).withColumnRenamed("source", "__s")
        gap = F.col("got") - F.col("target")
        after = (state.join(sums, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
                 .withColumn("off", F.abs(gap) / F.greatest(F.col("target"), F.lit(1.0)))
                 .withColumn("low", F.when(gap < 0, F.col("lam")).otherwise(F.col("low")))
                 .withColumn("high", F.when(gap > 0, F.col("lam")).otherwise(F.col("high")))
                 .withColumn("step", F.col("lam") - F.when(F.col("slope") > 0, gap / F.col("slope"))))
        inside = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        after = after.withColumn("lam", F.when(F.col("off") <= tolerance, F.col("lam")).when(inside, F.col("step"))
                                 .otherwise((F.col("low") + F.col("high")) / 2)).drop("got", "slope", "step")
        state = common.written(after, "dual")
        if not (state.agg(F.max("off")).first()[0] or 0.0) > tolerance:
            break
    return state


def class_copies(histogram: DataFrame, tilted: DataFrame, limit: int = 3) -> DataFrame:
    """``source, size, m, copies``: how many copies the documents of a source and size get together.

    Shares of copies are carried on from size to size (largest first); what is then missing in words is mended by single
    copies, again largest first. A source's list has one entry per distinct size.
    """
    x = F.col("size") / F.col("mean")
    rate = F.least(F.lit(float(limit)), F.exp(F.col("lam") * x))
    met = histogram.join(tilted.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
    run = F.sum(F.col("m") * F.col("rate")).over(Window.partitionBy("source").orderBy(F.col("size").desc())
                                                 .rowsBetween(Window.unboundedPreceding, 0))
    whole = met.withColumn("rate", rate).withColumn("__run", F.floor(F.round(run, 6) + 0.5))
    last = F.lag("__run", 1, 0).over(Window.partitionBy("source").orderBy(F.col("size").desc()))
    whole = whole.withColumn("copies", F.least(F.col("__run") - last, limit * F.col("m")).cast("long"))
    listed = F.sort_array(F.collect_list(F.struct("size", "m", "copies")), asc=False)
    sources = whole.groupBy("source", "target").agg(listed.alias("c"), F.sum(F.col("size") * F.col("copies")).alias("got"))
    nothing = F.expr("cast(array() as array<struct<size: bigint, by: bigint>>)")

    def mend(state: Column, c: Column) -> Column:
        more = (state["left"] * 2 >= c["size"]) & (c["copies"] < limit * c["m"])
        less = (state["left"] * -2 > c["size"]) & (c["copies"] > 0)
        by = F.when(more, 1).when(less, -1).otherwise(0).cast("long")
        note = F.array(F.struct(c["size"].alias("size"), by.alias("by")))
        return F.struct((state["left"] - by * c["size"]).alias("left"),
                        F.when(by != 0, F.concat(state["done"], note)).otherwise(state["done"]).alias("done"))

    start = F.struct((F.col("target") - F.col("got")).cast("double").alias("left"), nothing.alias("done"))
    mended = sources.withColumn("done", F.aggregate("c", start, mend, lambda s: F.map_from_entries(s["done"])))
    return (mended.select("source", "done", F.explode("c").alias("c"))
            .select("source", "c.size", "c.m", (F.col("c.copies") + F.coalesce(F.element_at("done", F.col("c.size")), F.lit(0))).alias("copies")))


def rated(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: int = 3) -> DataFrame:
    """``sizes (doc_id, source, size, ...)``, a written table, with ``source_size``, ``target``, ``copies`` and ``taken``.

    Within a source and size, ranks by hash and doc_id decide who gets the odd copy. Size 0: no copies, nothing taken.
    Null sources are one source; null ids and repeated rows are documents of their own. An empty table gives no rows.
    """
    goal = common.written(targets(sizes, weights, limit), "targets")
    histogram = common.written(sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("m")), "histogram")
    by_class = common.written(class_copies(histogram, tilts(histogram, goal, limit), limit), "copies").select(
        F.col("source").alias("__s"), F.col("size").alias("__z"), "m", F.col("copies").alias("__c"))
    numbered = common.ranked(sizes, ["source", "size"], [F.col("doc_id")], "__rank")
    copies = F.expr("__c div m + CASE WHEN __rank < __c % m THEN 1 ELSE 0 END")
    met = numbered.join(by_class, F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z")), "left")
    met = met.withColumn("copies", F.coalesce(copies, F.lit(0)).cast("long")).drop("__s", "__z", "__c", "__rank", "m")
    goal = goal.select(F.col("source").alias("__s"), "source_size", "target")
    return (met.join(goal, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
            .withColumn("taken", F.col("copies") * F.col("size")))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: int = 3) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of ``docs (doc_id, source, text)``."""
    sizes = common.written(docs.select("doc_id", "source", words(F.col("text")).alias("size")), "sizes")
    return rated(sizes, weights, limit).select("doc_id", "size", "source_size", "target", "taken")


def copied(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: int = 3) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns as they are."""
    key = ["doc_id", "source", "t"]
    again = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))
    code = F.xxhash64("text").alias("t")
    sizes = common.written(docs.select("doc_id", "source", code, words(F.col("text")).alias("size")), "sizes")
    rows = docs.select("doc_id", "source", code, F.struct(*[docs[c] for c in docs.columns]).alias("row")).withColumn("n", again)
    often = rated(sizes, weights, limit).withColumn("n", again).where("copies > 0")
    often = often.select(F.col("doc_id").alias("i"), F.col("source").alias("s"), F.col("t").alias("c"), F.col("n").alias("k"), "copies")
    met = rows["doc_id"].eqNullSafe(often["i"]) & rows["source"].eqNullSafe(often["s"]) & (rows["t"] == often["c"]) & (rows["n"] == often["k"])
    return (rows.join(often, met).select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
            .select("row.*"))
