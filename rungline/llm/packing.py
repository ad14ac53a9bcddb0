"""Packing by cutting-stock column generation.

A document's ids are cut into pieces of at most ``length`` ids. The histogram of piece lengths is a cutting-stock
problem: a linear program over patterns (how many pieces of each length class share a sequence), whose columns a
knapsack dynamic program prices. Rounded-down patterns and a tail for the remainder are then assigned to
the pieces by their rank within their length class.

Only the histogram (at most ``length / unit`` rows) reaches the driver.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rungline.llm import common, tokens

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pieces(docs: DataFrame, vocabulary: str, length: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of every document (``doc_id``, ``text``): whole sequences of ``length`` ids and the rest.

    A null text is an empty one: its only id is ``end_id``. Rows with a null or repeated ``doc_id`` are documents of
    their own. An empty table gives no pieces. ``with_ids`` adds the ids as binary (little-endian uint32).
    """
    common.text_batches(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = PIECE + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabulary).encode
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                ids += end
                for at in range(0, len(ids), 4 * length):
                    part = ids[at:at + 4 * length]
                    rows.append((doc_id, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, part))
            columns = list(zip(*rows)) or [()] * 6
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
            if with_ids:
                arrays.append(pa.array(columns[5], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def _best_pattern(sizes: np.ndarray, values: np.ndarray, room: int) -> np.ndarray:
    """Unbounded knapsack: counts of each size with the greatest total value in ``room``."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        fits = np.searchsorted(sizes, c, side="right")
        best[c], pick[c] = best[c - 1], -1
        if fits:
            total = values[:fits] + best[c - sizes[:fits]]
            i = int(total.argmax())
            if total[i] > best[c] + 1e-12:
                best[c], pick[c] = total[i], i
    counts, c = np.zeros(len(sizes), dtype=np.int64), room
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            counts[pick[c]] += 1
            c -= sizes[pick[c]]
    return counts


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, tolerance: float = 1e-6) -> list[tuple[np.ndarray, float]]:
    """The linear program: patterns with how often each is used, ``sum(use * pattern) = demand``.

    Revised simplex from one pattern per size; a pattern enters while its value at the current prices exceeds 1.
    """
    m = len(sizes)
    patterns = [np.eye(m, dtype=np.int64)[i] * (room // s) for i, s in enumerate(sizes)]
    inverse = np.diag([1.0 / (room // s) for s in sizes])
    use = inverse @ demand
    while True:
        prices = inverse.sum(axis=0)
        column = _best_pattern(sizes, prices, room)
        if prices @ column <= 1 + tolerance:
            return list(zip(patterns, use))
        step = inverse @ column
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            return list(zip(patterns, use))
        grow = ratio[leave]
        use = np.maximum(use - grow * step, 0)
        use[leave] = grow
        pivot = inverse[leave] / step[leave]
        inverse -= np.outer(step, pivot)
        inverse[leave] = pivot
        patterns[leave] = column


def _fill(sizes: np.ndarray, left: np.ndarray, room: int) -> np.ndarray:
    """One sequence for the remainder: the largest piece, then the pieces that fill it best."""
    counts = np.zeros(len(sizes), dtype=np.int64)
    first = int(np.flatnonzero(left)[-1])
    counts[first] = 1
    free = room - int(sizes[first])
    how = {0: None}
    for i in np.flatnonzero(left)[::-1]:
        have = int(left[i]) - (i == first)
        reach = list(how)
        for c in reach:
            for k in range(1, min(have, (free - c) // int(sizes[i])) + 1):
                how.setdefault(c + k * int(sizes[i]), (c, i, k))
        if free in how:
            break
    c = max(how)
    while how[c] is not None:
        c, i, k = how[c]
        counts[i] += k
    return counts


def plan(histogram: dict[int, int], room: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(class, first rank, end rank, pieces per sequence, first sequence, slot)`` that cover every piece once."""
    sizes = np.array(sorted(k for k, n in histogram.items() if n), dtype=np.int64)
    if not len(sizes):
        return []
    left = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    chosen: list[tuple[np.ndarray, int]] = []
    for pattern, use in solve(sizes, left.astype(float), room):
        times = int(use + 1e-9)
        fits = min((int(n) // int(p) for n, p in zip(left, pattern) if p), default=0)
        if times := min(times, fits):
            chosen.append((pattern, times))
            left = left - times * pattern
    while left.any():
        pattern = _fill(sizes, left, room)
        times = min(int(n) // int(p) for n, p in zip(left, pattern) if p)
        chosen.append((pattern, times))
        left = left - times * pattern
    runs, done, sequence = [], dict.fromkeys(sizes.tolist(), 0), 0
    for pattern, times in chosen:
        slot = 0
        for i in np.flatnonzero(pattern)[::-1]:
            size, each = int(sizes[i]), int(pattern[i])
            runs.append((size, done[size], done[size] + each * times, each, sequence, slot))
            done[size] += each * times
            slot += each
        sequence += times
    return runs


def pack(cut: DataFrame, length: int = 1024, unit: int = 8) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` (gapless from 0) to pieces (``doc_id``, ``start``, ``length``, ...).

    Lengths are planned in units of ``unit`` ids, rounded up; ``cut`` is read three times and should be a written table.
    """
    spark = cut.sparkSession
    classed = cut.withColumn("__class", F.ceil(F.col("length") / unit).cast("int"))
    counts = {r[0]: r[1] for r in classed.groupBy("__class").count().collect()}  # at most length / unit rows
    runs = spark.createDataFrame(plan(counts, length // unit) or [(0, 0, 0, 1, 0, 0)],
                                 "__size int, __from long, __to long, __each long, __sequence long, __slot long")
    order = [F.col("doc_id"), F.col("start"), F.col("ids_crc32")]
    at = F.col("__rank") - F.col("__from")
    placed = (common.ranked(classed, ["__class"], order, "__rank")
              # the plan's size depends on the number of length classes alone
              .join(F.broadcast(runs), (F.col("__class") == F.col("__size")) & (F.col("__rank") >= F.col("__from"))
                    & (F.col("__rank") < F.col("__to")))
              .withColumn("sequence_id", F.expr("__sequence + (__rank - __from) div __each"))
              .withColumn("__place", F.col("__slot") + at % F.col("__each")))
    before = Window.partitionBy("sequence_id").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*cut.columns, "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))


def packed(docs: DataFrame, vocabulary: str, length: int = 1024, end_id: int = 0, unit: int = 8) -> DataFrame:
    """Pieces of all documents with their sequence and offset; see ``pieces`` for nulls, empty texts and repeated rows."""
    return pack(common.written(pieces(docs, vocabulary, length, end_id), "pieces"), length, unit)
