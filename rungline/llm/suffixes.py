"""Removal of repeated byte strings with suffix arrays built by linear grouping.

The suffix array (``suffix_array``) is built in two phases. Suffixes are grouped by their Lyndon prefix: groups are processed from the
greatest down, each suffix points to the nearest one before it in a lower group (its previous smaller), and
the suffixes so pointed at move to new groups right above their old one, by how often they are pointed at. Then each group's order
is emitted in one pass over the array, along the same pointers. No names are given anew and nothing is recursive.

Texts too large for one machine meet by anchors (``anchors``): equal windows pick equal anchors. Anchors met once
cannot lie in a repeated window. Contexts equal as a whole are counted; where an anchor has different contexts these are cut into cells that share all
but a few bytes, and the suffix array of a cell's contexts tells which of their windows are equal.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rungline.llm import common
from rungline.llm.anchors import anchors

WINDOW, GRAM = 400, 100
#: Words of a passage that stays, at most, and the fewest bytes a longer one can have: 51 words of one byte and the blanks between.
WORDS = 50
PASSAGE, PASSAGE_GRAM = 2 * WORDS + 1, 40
#: Words of the gram by which documents that share a passage of words meet.
WORD_GRAM = 10
#: Window starts a cell spans, level by level; a cell of one start has equal contexts by itself.
CELLS = (25, 5, 1)
#: Different contexts of a cell that are sorted in one array; a cell with more is cut finer.
CONTEXTS = 10_000
#: Symbols after which a batch of cells is sorted.
BATCH = 1 << 15


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of the suffixes of ``symbols`` in ascending order; the last symbol must be smaller than all others."""
    n = len(symbols)
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(symbols):
        by_symbol.setdefault(c, []).append(i)
    group, members, higher, lower = [0] * n, [], [], []
    for number, c in enumerate(sorted(by_symbol)):
        members.append(by_symbol[c])
        lower.append(number - 1)
        higher.append(number + 1)
        for i in by_symbol[c]:
            group[i] = number
    higher[-1] = -1
    before, processed, order = [-1] * n, bytearray(n), []
    now = len(members) - 1
    while now >= 0:
        own = [i for i in members[now] if group[i] == now]
        if own:
            members[now] = own
            order.append(now)
            moved: dict[tuple[int, int], list[int]] = {}
            last, times = -1, 0
            for i in own:
                p = i - 1
                while p >= 0 and processed[p]:
                    p = before[p]
                before[i] = p
                processed[i] = 1
                if p == last:
                    times += 1
                else:
                    if last >= 0:
                        moved.setdefault((group[last], times), []).append(last)
                    last, times = p, 1
            if last >= 0:
                moved.setdefault((group[last], times), []).append(last)
            # of one group's suffixes those pointed at more often are greater: each new group goes right above the old one,
            # the most often pointed at first
            for old, times in sorted(moved, reverse=True):
                new, above, who = len(members), higher[old], moved[old, times]
                members.append(who)
                higher.append(above)
                lower.append(old)
                higher[old] = new
                if above >= 0:
                    lower[above] = new
                for p in who:
                    group[p] = new
        now = lower[now]
    return _emit(n, order, members, group, before)


def _emit(n: int, order: list[int], members: list[list[int]], group: list[int], before: list[int]) -> list[int]:
    free, at = [0] * len(members), 0
    for g in reversed(order):
        free[g] = at
        at += len(members[g])
    out, done = [-1] * n, bytearray(n)
    out[0] = n - 1
    done[n - 1] = 1
    for k in range(n):
        s = out[k] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            done[s] = 1
            s = before[s]
    return out


def equal_windows(cells: list[list[tuple[bytes, bytes]]], width: int) -> list[list[list[int]]]:
    """For each context ``(left, right)`` of each cell, the starts ``e`` (bytes before the shared core) whose window is met again.

    A window is ``e`` bytes, the core (one symbol of its cell) and ``width - 1 - e`` bytes.
    """
    symbols: list[int] = []
    where: list[tuple[int, int, int]] = []  # first symbol, cell, context
    for k, contexts in enumerate(cells):
        for j, (left, right) in enumerate(contexts):
            where.append((len(symbols), k, j))
            symbols += [b + 2 for b in left]
            symbols.append(258 + k)
            symbols += [b + 2 for b in right]
            symbols.append(1)
    symbols.append(0)
    owner = [0] * len(symbols)
    for w, (first, k, j) in enumerate(where):
        left, right = cells[k][j]
        for e in range(width - 1 - len(right), len(left) + 1):
            owner[first + len(left) - e] = w + 1
    text = "".join(map(chr, symbols))
    found: list[list[list[int]]] = [[[] for _ in contexts] for contexts in cells]
    last, known = -1, False
    for s in suffix_array(symbols):
        if not owner[s]:
            continue
        same = last >= 0 and text[s:s + width] == text[last:last + width]
        for i in ([s] if known else [last, s]) if same else []:
            first, k, j = where[owner[i] - 1]
            found[k][j].append(first + len(cells[k][j][0]) - i)
        last, known = s, same
    return found


#: An anchor's place is one number: its position, and how far before it the first and the last window start that pick it.
_BITS, _FAR = 12, (1 << 12) - 1
#: Share of all anchors, and count, from which a hash is very frequent; there are at most as many of them as the share's inverse.
SHARE, OFTEN = 4096, 4096
#: Documents whose anchors tell which hashes are very frequent: one of so many, by the text's hash. Only the routing depends on it.
TOLD = 16


def _words(raw: bytes) -> np.ndarray:
    """A hash of each word, the words being what ASCII white space parts."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, raw.split()), np.uint64)


def _anchored(docs: DataFrame, window: int, gram: int, words: bool = False) -> DataFrame:
    """Anchors of every text: ``doc_id, t, place, h`` (its bytes) and ``c`` (its whole context).

    With ``words`` all lengths and places count words, and a document's equal contexts have one row, that of the first.
    """
    schema = "doc_id long, t long, place long, h long, c long"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = xxhash.xxh3_64_intdigest
        for batch in batches:
            columns: list[list] = [[] for _ in range(5)]
            for doc_id, t, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = (text or "").encode()
                symbols = _words(raw) if words else raw
                at, first, last, h = anchors(symbols, window, gram)
                spans = zip(at.tolist(), first.tolist(), last.tolist())
                held, size = (symbols.tobytes(), symbols.itemsize) if words else (raw, 1)
                c = np.array([code(held[size * a:size * (b + window)], x - a) for x, a, b in spans], dtype=np.uint64).astype(np.int64)
                place, h = at << 2 * _BITS | at - first << _BITS | at - last, h.astype(np.int64)
                if words:
                    _, once = np.unique(c, return_index=True)
                    place, h, c = place[once], h[once], c[once]
                for column, values in zip(columns, ([doc_id] * len(c), [t] * len(c), place, h, c)):
                    column.append(pa.array(values, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) if c else pa.array([], pa.int64()) for c in columns],
                                             names=[c.split()[0] for c in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), "text").mapInArrow(find, schema)


def _window_starts(place: Column) -> tuple[Column, Column, Column]:
    """An anchor's position, and the first and the last window start that pick it."""
    at = F.shiftright(place, 2 * _BITS)
    return at, at - F.shiftright(place, _BITS).bitwiseAND(_FAR), at - place.bitwiseAND(_FAR)


MET = "again boolean, doc_id long, t long, place long, weight int"


def _met(found: DataFrame, partitions: int) -> DataFrame:
    """Anchors met again: with ``again`` those whose whole context is met again; without it, once per context, those met in several contexts.

    Anchors of equal bytes go to one task and are read there in the order of their contexts, one row after the other. Very frequent anchors are dealt by
    their contexts instead; of very frequent contexts, all of which are met again, only one row is dealt at all.
    """
    told = found.where(F.pmod("t", F.lit(TOLD)) == 0)
    often = common.written(told.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "often")
    least = max(OFTEN, -(-told.count() // SHARE))
    hot = [r.h for r in often.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h").collect()]
    pairs = often.where(F.col("n") >= least).select("h", F.xxhash64("h", "c").alias("code")).collect()
    common.dropped(often)
    certain = F.col("h").isin([r.h for r in pairs]) & F.xxhash64("h", "c").isin([r.code for r in pairs]) if pairs else F.lit(False)
    again = found.where(certain)
    one = again.groupBy("h", "c").agg(F.min(F.struct("doc_id", "t", "place")).alias("o")).select("o.*", "h", "c")
    rest = found.where(~certain).unionByName(one).unionByName(one)  # twice, as it is met again
    route = F.when(F.col("h").isin(hot), F.xxhash64("h", "c")).otherwise(F.xxhash64("h")) if hot else F.xxhash64("h")
    dealt = rest.withColumn("route", route).repartition(partitions, "route").sortWithinPartitions("h", "c")
    met = dealt.select("h", "c", "doc_id", "t", "place").mapInArrow(_runs(np.array(sorted(hot), np.int64)), MET)
    return met.unionByName(again.select(F.lit(True).alias("again"), "doc_id", "t", "place", F.lit(0).alias("weight")))


def _runs(hot: np.ndarray):
    """Sorted anchors ``h, c, doc_id, t, place`` to those met again, batch by batch: of the last run of a batch at most two rows are kept for the next."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the first rows of a run that may go on, at most two
        told, leads = False, True  # whether they have been told as met again; whether their run is the first of its anchor
        for batch in _then_none(batches):
            rows = [b for b in (held, batch) if b is not None and b.num_rows]
            if not rows:
                continue
            table = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            h, c = (table.column(k).to_numpy() for k in (0, 1))
            n = len(h)
            new_h = np.concatenate(([True], h[1:] != h[:-1]))
            new = new_h | np.concatenate(([True], c[1:] != c[:-1]))
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, n))
            lead = new_h[first]
            lead[0] = leads
            over = batch is None
            # the last run may go on; before the end it is only told, not closed
            go_on = np.append(lead[1:], True)
            several = ~lead | ~go_on | np.isin(h[first], hot)
            again = np.repeat(size > 1, size)
            if told:
                again[:min(2, n)] &= np.arange(min(2, n)) >= (held.num_rows if held is not None else 0)
            closed = several.copy()
            if not over:
                closed[-1] = False
            yield _picked(table, np.flatnonzero(again), first[closed], np.minimum(size[closed], 2))
            if over:
                return
            k = int(first[-1])
            told, leads = bool(size[-1] > 1), bool(lead[-1])
            held = table.slice(k, min(2, n - k))

    return read


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _picked(table: pa.RecordBatch, again: np.ndarray, owners: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
    some = table.take(pa.array(np.concatenate([again, owners])))
    flags = np.arange(len(again) + len(owners)) < len(again)
    weights = np.concatenate([np.zeros(len(again), np.int32), weight.astype(np.int32)])
    return pa.RecordBatch.from_arrays([pa.array(flags), *some.columns[2:], pa.array(weights)], names=[c.split()[0] for c in MET.split(", ")])


CELL = "key binary, left binary, right binary, doc_id long, t long, base long, weight int"
SPAN = "doc_id long, t long, first long, last long"


def _cells(rows: DataFrame, width: int, window: int) -> DataFrame:
    """Cells of the anchors listed with their text: ``doc_id, t, z, todo array<struct<at, first, last, weight>>``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                raw = unpack(row["z"]) if row["z"] else b""
                for todo in row["todo"]:
                    at, low, high = todo["at"], todo["at"] - todo["last"], todo["at"] - todo["first"]
                    for j in range(low // width, high // width + 1):
                        base, tail = at - j * width, at + window - j * width - width + 1
                        key = xxhash.xxh3_128_digest(raw[base:tail], j)
                        out.append((key, raw[at - min(high, j * width + width - 1):base],
                                    raw[tail:at + window - max(low, j * width)], row["doc_id"], row["t"], base, todo["weight"]))
            yield _batch(out, CELL)

    return rows.mapInArrow(cut, CELL)


def _finer(cells: DataFrame, width: int, finer: int) -> DataFrame:
    """The same contexts in cells of fewer window starts."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, left, right, doc_id, t, base, weight in zip(*(c.to_pylist() for c in batch.columns)):
                low, high = width - 1 - len(right), len(left)
                for j in range(low // finer, high // finer + 1):
                    a, b = len(left) - j * finer, width - 1 - (j * finer + finer - 1)
                    inner = xxhash.xxh3_128_digest(key + bytes([j]) + left[a:] + right[:b])
                    out.append((inner, left[len(left) - min(high, j * finer + finer - 1):a],
                                right[b:width - 1 - max(low, j * finer)], doc_id, t, base - j * finer, weight))
            yield _batch(out, CELL)

    return cells.select(*[c.split()[0] for c in CELL.split(", ")]).mapInArrow(cut, CELL)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _sorted(contexts: DataFrame, width: int, partitions: int) -> DataFrame:
    """Repeated windows of contexts met once, by suffix arrays over batches of whole cells."""
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            out = []
            for rows, found in zip(held, equal_windows([[(r[1], r[2]) for r in rows] for rows in held], width)):
                for (_, _, _, doc_id, t, base, n), starts in zip(rows, found):
                    if n == 1 and starts:
                        starts.sort()
                        cuts = [0, *[i for i in range(1, len(starts)) if starts[i] != starts[i - 1] + 1], len(starts)]
                        out += [(doc_id, t, base - starts[b - 1], base - starts[a]) for a, b in zip(cuts, cuts[1:])]
            held.clear()
            return _batch(out, SPAN)

        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for _, cell in groupby(rows, key=lambda r: r[0]):
            held.append(list(cell))
            size += sum(len(r[1]) + len(r[2]) + 2 for r in held[-1])
            if size >= BATCH:
                yield flush()
                size = 0
        if held:
            yield flush()

    rows = contexts.select("key", "left", "right", "owner.doc_id", "owner.t", "owner.base", "n")
    return rows.repartition(partitions, "key").sortWithinPartitions("key").mapInArrow(sort, SPAN)


@F.pandas_udf(T.BinaryType())
def packed(texts: pd.Series) -> pd.Series:
    """Texts as bytes, compressed for the shuffle; null becomes empty."""
    pack = zstandard.ZstdCompressor(level=1).compress
    return pd.Series([pack((t or "").encode()) for t in texts], dtype=object)


def _same(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["__id"]) & (left["t"] == right["__t"])


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"doc_id": "__id", "t": "__t"})


def repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, t, spans``: window starts (first and last, inclusive) whose ``window`` bytes also start anywhere else.

    ``t`` is the hash of the text; rows equal in id and text are documents of their own and repeat each other. Texts shorter than the window, null and empty
    ones have no rows. Each span is listed once, however many rows are equal, so a list is bounded by its text's length.
    """
    if window < max(CELLS[0], gram):
        raise ValueError("a window holds its anchor and a whole cell")
    spark = docs.sparkSession
    common.text_batches(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if window - gram > _FAR:
        raise ValueError(f"a window is at most {_FAR} bytes longer than its anchor")
    found = common.written(_anchored(docs, window, gram), "anchors")
    met = common.written(_met(found, partitions), "met")
    common.dropped(found)
    at, first, last = _window_starts(F.col("place"))
    met = met.select("again", "doc_id", "t", at.alias("at"), first.alias("first"), last.alias("last"), "weight")
    spans = [met.where("again").select("doc_id", "t", "first", "last")]
    todo = (met.where("NOT again").groupBy("doc_id", "t")
            .agg(F.collect_list(F.struct("at", "first", "last", "weight")).alias("todo")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), packed("text").alias("z"))
    named = _named(todo)
    cells = common.written(_cells(texts.join(named, _same(texts, named)).select("doc_id", "t", "z", "todo"), CELLS[0], window), "cells")
    made = [met]
    for width, finer in zip(CELLS, (*CELLS[1:], 0)):
        contexts = common.written(cells.groupBy("key", "left", "right").agg(
            F.sum("weight").alias("n"), F.min(F.struct("doc_id", "t", "base")).alias("owner")), "contexts")
        low, high = F.lit(width - 1) - F.length("right"), F.length("left")
        equal = (cells.join(contexts.where("n > 1").select("key", "left", "right"), ["key", "left", "right"])
                 .select("doc_id", "t", (F.col("base") - high).cast("long").alias("first"), (F.col("base") - low).cast("long").alias("last")))
        kinds = contexts.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        some = contexts.join(kinds.where(F.col("kinds") <= CONTEXTS).select("key"), "key")
        made.append(common.written(equal.unionByName(_sorted(some, width, partitions)), "sorted"))
        spans.append(made[-1])
        many = kinds.where(F.col("kinds") > CONTEXTS).select("key")
        coarse = cells
        if finer and not many.isEmpty():
            cells = common.written(_finer(cells.join(many, "key"), width, finer), "cells")
        common.dropped(coarse)
        common.dropped(contexts)
        if cells is coarse:
            break
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    found = common.written(every.groupBy("doc_id", "t").agg(F.collect_set(F.struct("first", "last")).alias("spans")), "spans")
    for table in made:
        common.dropped(table)
    return found


def shared_passages(docs: DataFrame, words: int = WORDS, gram: int = WORD_GRAM) -> DataFrame:
    """``doc_id, t`` of the documents with a passage of more than ``words`` words that another document has too, each once.

    A passage is ``words + 1`` words one after the other, whatever white space parts them. ``t`` is the hash of the text; rows equal in id and text are
    documents of their own. A passage that only one document repeats is not shared.
    """
    spark, window = docs.sparkSession, words + 1
    if not 0 < gram <= window or window - gram > _FAR:
        raise ValueError(f"a passage holds its anchor and is at most {_FAR} words longer")
    common.text_batches(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = common.written(_anchored(docs, window, gram, words=True), "words")
    met = common.written(_met(found, partitions), "met")
    common.dropped(found)
    at, first, last = _window_starts(F.col("place"))
    todo = (met.where("NOT again").select("doc_id", "t", first.alias("first"), last.alias("last")).distinct()
            .groupBy("doc_id", "t").agg(F.collect_list(F.struct("first", "last")).alias("todo")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), packed("text").alias("z"))
    named = _named(todo)
    passages = common.written(_passages(texts.join(named, _same(texts, named)).select("doc_id", "t", "z", "todo"), window), "passages")
    who = F.struct("doc_id", "t")
    several = common.written(passages.groupBy("w").agg(F.min(who).alias("a"), F.max(who).alias("b"), F.count(F.lit(1)).alias("n"))
                             .where("NOT a <=> b").select("w", "n"), "several")
    # very frequent passages, few by their share, are told by their hash and need no join
    least = max(OFTEN, -(-passages.count() // SHARE))
    often = F.col("w").isin([r.w for r in several.where(F.col("n") >= least).select("w").collect()])
    every = (met.where("again").select("doc_id", "t").unionByName(passages.where(often).select("doc_id", "t"))
             .unionByName(passages.where(~often).join(several.where(F.col("n") < least), "w").select("doc_id", "t")))
    shared = common.written(every.distinct(), "shared")
    for table in (met, passages, several):
        common.dropped(table)
    return shared


def _passages(rows: DataFrame, window: int) -> DataFrame:
    """The hash ``w`` of every passage that starts in the spans listed, each once per row, of ``doc_id, t, z, todo array<struct<first, last>>``."""
    schema = "w long, doc_id long, t long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, code = zstandard.ZstdDecompressor().decompress, xxhash.xxh3_64_intdigest
        for batch in batches:
            columns: list[list] = [[pa.array([], pa.int64())] for _ in range(3)]
            for row in batch.to_pylist():
                symbols = _words(unpack(row["z"]))
                held, size = symbols.tobytes(), symbols.itemsize
                found = {code(held[size * i:size * (i + window)]) for s in row["todo"] for i in range(s["first"], s["last"] + 1)}
                w = np.fromiter(found, np.uint64, len(found)).astype(np.int64)
                for column, values in zip(columns, (w, [row["doc_id"]] * len(w), [row["t"]] * len(w))):
                    column.append(pa.array(values, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], names=[c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(cut, schema)


def removed_runs(spans: list | None, size: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal runs of bytes that repeated windows cover."""
    runs: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in (spans if spans is not None else [])):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last + window)
        else:
            runs.append([first, last + window])
    return [(a, min(b, size)) for a, b in runs]


def _kept(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *[b for _, b in runs]]
    starts = [*[a for a, _ in runs], len(raw)]
    return b"".join(raw[a:b] for a, b in zip(ends, starts))


def _long(raw: bytes, a: int, b: int, words: int) -> bool:
    """Whether a run has more than ``words`` whole words, or a window's bytes."""
    if b - a >= WINDOW:
        return True
    # a word that goes on before or after the run is not whole
    cut = sum(i > 0 and len(raw[i - 1:i + 1].strip()) == 2 for i in (a, b))
    return len(raw[a:b].split()) - cut > words


def with_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shared: DataFrame | None = None) -> DataFrame:
    """``row`` (all columns but the text), ``z`` (the text, packed) and ``spans`` (its repeated windows; null: none) of every row.

    ``shares`` is 1 in rows whose ``doc_id, t`` is in ``shared``, else 0.
    """
    found = _named(repeated(docs.select("doc_id", "text"), window, gram))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), packed("text").alias("z"),
                       F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row"))
    joined, shares = rows.join(found, _same(rows, found), "left"), F.lit(0)
    if shared is not None:
        others = _named(shared).withColumn("__shares", F.lit(1))
        joined, shares = joined.join(others, _same(rows, others), "left"), F.coalesce("__shares", F.lit(0))
    return joined.select("row", "z", "spans", shares.alias("shares"))


def digests(docs: DataFrame, words: int | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept`` of every row of ``docs (doc_id, text)``.

    Null texts are empty; texts shorter than 400 bytes stay whole; null ids and repeated rows are documents of their own. An empty table gives no rows.
    With ``words`` one column more: ``shares_passage`` is 1 if another document has a passage of more than ``words`` words of the text too, however many
    bytes that is, else 0. It only tells; no more is removed.
    """
    docs = docs.select("doc_id", "text")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long, shares_passage int"
    kinds = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.int32()]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                raw = unpack(row["z"])
                runs = removed_runs(row["spans"], len(raw))
                kept = _kept(raw, runs)
                rows.append((row["doc_id"], len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), len(kept), row["shares"]))
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in schema.split(", ")])

    rows = with_spans(docs, shared=None if words is None else shared_passages(docs, words)).select("row.doc_id", "z", "spans", "shares")
    found = rows.mapInArrow(digest, schema)
    return found if words is not None else found.drop("shares_passage")


def _cut(window: int, words: int | None):
    """A column function: packed texts and their spans to the texts without the repeated runs."""
    @F.pandas_udf(T.StringType())
    def cut(packed_texts: pd.Series, spans: pd.Series) -> pd.Series:
        unpack, out = zstandard.ZstdDecompressor().decompress, []
        for z, found in zip(packed_texts, spans):
            raw = unpack(z)
            runs = []
            for a, b in removed_runs(found, len(raw), window):
                if words is not None and not _long(raw, a, b, words):
                    continue
                while a < b and a < len(raw) and raw[a] & 0xC0 == 0x80:  # a character that is cut stays whole
                    a += 1
                while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                    b -= 1
                runs.append((a, b))
            out.append(_kept(raw, runs).decode())
        return pd.Series(out, dtype=object)

    return cut


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, words: int | None = None) -> DataFrame:
    """The rows of ``docs`` with the repeated stretches taken out of ``text`` (whole characters only) and ``n_chars`` counted anew.

    With ``words`` a stretch of no more whole words and under 400 bytes stays. A stretch is what repeated windows cover without a break.
    All rows and columns stay, also where no text is left; null texts become empty.
    """
    cut = with_spans(docs, window, gram).select("row", _cut(window, words)("z", "spans").alias("text"))
    made = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return cut.select(*[made.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
