"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors at cosine ``c`` lie at distance ``eps = sqrt(2 - 2c)``. They are rotated to principal axes and sorted by the grid cells (of side eps)
of the leading axes; stretches of that order become blocks with bounding boxes. Pairs of stretches are split into
pairs of shorter stretches, level by level; a pair whose boxes are farther apart than eps is dropped. What is
left at the end are pairs of blocks, which are compared exactly, in double precision.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rungline.llm import common, graph

BLOCK = 1024
FAN = 8
_PLACE = 1 << 12  # places per block number
BLOCKS = ("label int, dims int, part int, seq int, low array<double>, high array<double>, h1 array<long>, h2 array<long>, "
          "first array<long>, weight array<long>, data binary")


def _usable() -> object:
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.coalesce(F.col("label").isNotNull() & good & (norm > 0) & (norm < float("inf")), F.lit(False))


def _axes(distinct: DataFrame, rows: int) -> dict[int, np.ndarray]:
    """Principal axes by dimension count, from at most ``rows`` vectors; they order the work and change no result."""
    out = {}
    sample = distinct.orderBy("h1").limit(rows).select("dims", "embedding").toPandas()
    for dims, some in sample.groupby("dims"):
        x = np.array(some["embedding"].tolist(), dtype=float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        out[int(dims)] = np.linalg.eigh(np.cov(x.T).reshape(dims, dims) if len(x) > 1 else np.eye(dims))[1][:, ::-1]
    return out


def _blocks(distinct: DataFrame, eps: float, leading: int, boxed: int, sample: int) -> DataFrame:
    axes = _axes(distinct, sample)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for v in batch.column("embedding").to_pylist():
                x = np.array(v, dtype=float)
                turned = (x / np.linalg.norm(x)) @ axes[len(x)] if len(x) in axes else x / np.linalg.norm(x)
                cells.append(np.floor(turned[:leading] / eps).astype(int).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, held = TaskContext.get().partitionId(), 0, []
        names = [c.split()[0] for c in BLOCKS.split(", ")]
        kinds = [pa.int32()] * 4 + [pa.list_(pa.float64())] * 2 + [pa.list_(pa.int64())] * 4 + [pa.binary()]

        def flush() -> pa.RecordBatch:
            x = np.array([r["embedding"] for r in held], dtype="<f4")
            unit = x.astype(float)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            turned = unit @ axes[x.shape[1]] if x.shape[1] in axes else unit
            turned = turned[:, :boxed]
            row = [held[0]["label"], held[0]["dims"], part, seq, turned.min(0), turned.max(0),
                   *[[r[c] for r in held] for c in ("h1", "h2", "first", "weight")], x.tobytes()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) == BLOCK or (held[0]["label"], held[0]["dims"]) != (row["label"], row["dims"])):
                    yield flush()
                    seq += 1
                held.append(row)
        if held:
            yield flush()

    schema = "label int, dims int, h1 long, h2 long, first long, weight long, embedding array<float>"
    placed = distinct.select(*[c.split()[0] for c in schema.split(", ")]).mapInArrow(place, schema + ", cells array<int>")
    order = ["label", "dims", "cells", "h1", "h2"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, BLOCKS)


def _apart(limit: float):
    """Whether two boxes (columns low, high and low2, high2) can hold vectors within ``limit`` of each other."""
    gap = lambda a, b: F.greatest(F.lit(0.0), a, b)
    one = F.zip_with("low", "high2", lambda l, h: l - h)
    two = F.zip_with("low2", "high", lambda l, h: l - h)
    return F.aggregate(F.zip_with(one, two, gap), F.lit(0.0), lambda s, g: s + g * g) <= limit * limit


def _pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """``a, b`` (a <= b): numbers of the blocks that may hold links, by descent through stretches of the order."""
    nodes = blocks.select("label", "dims", "block", "low", "high")
    top = nodes.agg(F.max("block")).first()[0]
    if top is None:
        return nodes.select(F.col("block").alias("a"), F.col("block").alias("b"))
    levels, size = 0, top + 1
    while size > FAN:
        levels, size = levels + 1, -(-size // FAN)
    boxed = len(nodes.select("low").first()[0])

    def level(k: int) -> DataFrame:
        """A stretch of FAN ** k blocks per label: its number, its parent's, its box."""
        if not k:
            return nodes.select("label", "dims", F.col("block").alias("node"), "low", "high")
        ends = [F.array(*[f(F.get(c, F.lit(i))) for i in range(boxed)]).alias(c) for c, f in (("low", F.min), ("high", F.max))]
        return nodes.groupBy("label", "dims", F.expr(f"block div {FAN ** k}").alias("node")).agg(*ends)

    def met(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        far = right.withColumnsRenamed({"node": "node2", "low": "low2", "high": "high2"})
        return left.join(far, on).where((F.col("node") <= F.col("node2")) & _apart(eps + 1e-9)).select("label", "dims", "node", "node2")

    upper = level(levels)
    found = met(upper, upper, ["label", "dims"])  # FAN stretches at most
    for k in range(levels - 1, -1, -1):
        lower = level(k).withColumn("up", F.expr(f"node div {FAN}"))
        left = found.withColumnsRenamed({"node": "up", "node2": "up2"}).join(lower, ["label", "dims", "up"]).drop("up")
        found = met(left, lower.withColumnRenamed("up", "up2"), ["label", "dims", "up2"])
    return found.select(F.col("node").alias("a"), F.col("node2").alias("b"))


LINKS = "place long, links long, root long"


def _compare(threshold: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b = row["a"], row["b"]
                x, y = (np.frombuffer(row[c], dtype="<f4").reshape(-1, row["dims"]).astype(float) for c in ("data", "data2"))
                x, y = x / np.linalg.norm(x, axis=1, keepdims=True), y / np.linalg.norm(y, axis=1, keepdims=True)
                near = x @ y.T >= threshold
                if a == b:
                    np.fill_diagonal(near, False)
                w1, w2 = np.array(row["weight"]), np.array(row["weight2"])
                at1, at2 = a * _PLACE + np.arange(len(x)), b * _PLACE + np.arange(len(y))
                some1, some2 = near.any(axis=1), near.any(axis=0)
                near = near[some1][:, some2]
                at1, at2, w1, w2 = at1[some1], at2[some2], w1[some1], w2[some2]
                r1, r2 = at1.copy(), at2.copy()
                while near.size:  # smallest place reachable within the two blocks
                    n1 = np.minimum(r1, np.where(near, r2, np.iinfo(np.int64).max).min(axis=1))
                    n2 = np.minimum(r2, np.where(near, n1[:, None], np.iinfo(np.int64).max).min(axis=0))
                    if a == b:
                        n1 = n2 = np.minimum(n1, n2)
                    if (n1 == r1).all() and (n2 == r2).all():
                        break
                    r1, r2 = n1, n2
                out = [(at1, near @ w2, r1)] + ([(at2, w1 @ near, r2)] if a != b else [])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=["place", "links", "root"])

    return compare


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, leading: int = 6, boxed: int = 16, sample: int = 20_000) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors (vec_id, embedding, label)``.

    Rows link when their labels are equal and not null, their vectors have as many dimensions and the cosine is ``threshold`` or more.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing and keep their own id.
    Equal vectors of a label are compared once and count as often as they occur; a null vec_id counts as a vector but names no
    component. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    eps = float(np.sqrt(2 - 2 * threshold))
    usable = vectors.select("vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<float>").alias("embedding")).withColumn(
        "ok", _usable()).withColumns({"h1": F.when(F.col("ok"), F.xxhash64("embedding")),
                                      "h2": F.when(F.col("ok"), F.xxhash64(F.lit(1), "embedding"))})
    distinct = common.written(usable.where("ok").groupBy("label", F.size("embedding").alias("dims"), "h1", "h2").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight"), F.min("embedding").alias("embedding")), "distinct")
    cut = common.written(_blocks(distinct, eps, leading, boxed, sample), "blocks")
    parts = cut.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition of the order
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    blocks = common.written(cut.join(parts, "part").withColumn("block", F.col("base") + F.col("seq")).drop("base"), "numbered")

    data = blocks.select("block", "dims", "weight", "data")
    far = data.drop("dims").withColumnsRenamed({"block": "b", "weight": "weight2", "data": "data2"})
    pairs = common.written(_pairs(blocks, eps), "pairs")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")  # a row holds two blocks
    found = common.written(pairs.join(data.withColumnRenamed("block", "a"), "a").join(far, "b")
                           .mapInArrow(_compare(threshold), LINKS), "links")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    roots = graph.components(found.select(F.col("place").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("place").agg(F.sum("links").alias("links"))
    listed = blocks.select("label", "dims", "block", F.posexplode(F.arrays_zip("h1", "h2", "first", "weight")).alias("at", "v"))
    nodes = listed.select("label", "dims", (F.col("block") * _PLACE + F.col("at")).alias("place"), "v.*")
    nodes = (nodes.join(counts, "place", "left").join(roots.withColumnRenamed("node", "place"), "place", "left")
             .withColumn("root", F.coalesce("root", "place")))
    smallest = nodes.groupBy("root").agg(F.min("first").alias("component"))
    known = nodes.join(smallest, "root").select(
        F.col("label").alias("l"), F.col("dims").alias("d"), F.col("h1").alias("k1"), F.col("h2").alias("k2"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), "component")
    same = ((F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & (F.col("label") == F.col("l")) & (F.size("embedding") == F.col("d")))
    out = usable.join(known, same, "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("ok"), F.col("component")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
