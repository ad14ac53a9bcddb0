"""Repair of conversations to the grammar ``(system? (user assistant)+)?`` at least cost, with Four-Russians block tables.

A conversation's rows are symbols: the role's initial, and whether the row must go (blank, or said before) or breaks off. The state is what the
repaired conversation ends with so far; a cost vector holds, per state, the least cost from here to the end. Less its least entry a vector is one of a
few dozen, so its change by every block of ``BLOCK`` symbols is tabulated once: a block is a look-up of the next vector, of what it adds to the cost and of the state
it ends in. Long conversations are cut into chunks; a chunk maps vectors to vectors, the chunks of a conversation are chained, and each chunk is
traced by itself: its blocks are expanded backward from the vector behind them, and of the edits that keep to the least cost the first letter counts. As the
letters of a state's edits differ, this gives the least string of all cheapest ones.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungline.llm import common

#: What the repaired conversation ends with: nothing yet, a system row, a user row, an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Symbols: no row (fills up the last block), a row that must go, then user, assistant, system and other rows, whole and broken off.
FILL, GO, ROWS = 0, 1, "uaso"
SYMBOLS = 2 + 2 * len(ROWS)
REROLE, DELETE, INSERT, BROKEN = 2, 3, 2, 1
#: Symbols of a block, rows of a chunk.
BLOCK, CHUNK = 4, 4096
BLANKS = " \t\n\x0b\x0c\r"

#: After an insertion, after a row by its role.
_INSERTED = (USER, USER, ASSISTANT, USER)
_NEXT = {"u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None), "s": (SYSTEM, None, None, None), "o": (None,) * 4}


def _row_edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row without insertions: letter, state after it, cost."""
    edits = [("D", state, DELETE)]
    if symbol != GO:
        broken, role = divmod(symbol - 2, len(ROWS))
        kept = _NEXT[ROWS[role]][state]
        if kept is not None:
            edits.append(("K", kept, BROKEN * broken))
        edits.append(("R", _INSERTED[state], REROLE + BROKEN * broken))
    return edits


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """All edits of a row, by letters; up to two rows may be inserted before it."""
    out, cost, letters = [], 0, ""
    for _ in range(3):
        out += [(letters + e, to, cost + c) for e, to, c in _row_edits(symbol, state)]
        letters, cost, state = letters + "I", cost + INSERT, _INSERTED[state]
    return sorted(out)


class Tables:
    """Cost vectors, numbered, and their changes by symbols and by blocks of symbols."""

    def __init__(self, block: int = BLOCK):
        self.block, self.last = block, (0, 4, 2, 0)  # from the end on: an assistant row is lacking, or a whole pair
        numbers, todo = {self.last: 0}, [self.last]
        steps: dict[tuple[int, int], tuple[int, int, tuple]] = {}
        while todo:
            vector = todo.pop()
            for symbol in range(1, SYMBOLS):
                best = [min((c + vector[to], letters, to) for letters, to, c in _edits(symbol, q)) for q in range(4)]
                least = min(c for c, _, _ in best)
                after = tuple(c - least for c, _, _ in best)
                if after not in numbers:
                    numbers[after] = len(numbers)
                    todo.append(after)
                steps[symbol, numbers[vector]] = numbers[after], least, tuple((letters, to) for _, letters, to in best)
        self.costs = np.array(list(numbers))
        n = len(numbers)
        #: letters and state after the row, by symbol, vector behind it and state before it
        self.traces = {key: found for key, (_, _, found) in steps.items()}
        self.step = np.tile(np.arange(n), (SYMBOLS, 1))
        added, ends = np.zeros((SYMBOLS, n), np.int64), np.tile(np.arange(4), (SYMBOLS, n, 1))
        for (symbol, v), (after, least, found) in steps.items():
            self.step[symbol, v], added[symbol, v], ends[symbol, v] = after, least, [to for _, to in found]
        # one symbol more in front at a time: first the vector behind it, then its own step
        self.vector, self.added, self.ends = self.step, added, ends
        for _ in range(block - 1):
            behind = self.vector[None]
            self.added = (self.added[None] + added[:, behind[0]].reshape(SYMBOLS, *self.added.shape)).reshape(-1, n)
            entered = ends[:, behind[0]].reshape(SYMBOLS, *self.vector.shape, 4)
            self.ends = np.take_along_axis(np.broadcast_to(self.ends[None], entered.shape), entered, axis=3).reshape(-1, n, 4)
            self.vector = self.step[:, behind[0]].reshape(-1, n)

    def blocks(self, symbols: list[int]) -> list[int]:
        """Numbers of the blocks, filled up in front."""
        symbols = [FILL] * (-len(symbols) % self.block) + symbols
        numbers = []
        for i in range(0, len(symbols), self.block):
            code = 0
            for s in symbols[i:i + self.block]:
                code = code * SYMBOLS + s
            numbers.append(code)
        return numbers

    def summary(self, symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every vector behind the symbols: the vector before them, what they add, and the state they end in for every state before."""
        blocks = self.blocks(symbols)
        v, added, behind = np.arange(len(self.costs)), np.zeros(len(self.costs), np.int64), []
        for b in reversed(blocks):
            behind.append(v)
            added = added + self.added[b, v]
            v = self.vector[b, v]
        state = np.tile(np.arange(4), (len(self.costs), 1))
        for b, w in zip(blocks, reversed(behind)):
            state = np.take_along_axis(self.ends[b, w], state, axis=1)
        return v, added, state

    def trace(self, symbols: list[int], behind: int, state: int) -> tuple[list[str], int]:
        """Letters for every symbol, and the state after the last, from the vector behind them and the state before them."""
        blocks, vectors = self.blocks(symbols), [behind]
        for b in reversed(blocks):
            vectors.append(int(self.vector[b, vectors[-1]]))
        vectors.reverse()
        padded = [FILL] * (-len(symbols) % self.block) + symbols
        out = []
        for k in range(len(blocks)):
            inner = padded[k * self.block:(k + 1) * self.block]
            after = [vectors[k + 1]]
            for s in inner[:0:-1]:
                after.append(int(self.step[s, after[-1]]))
            for s, v in zip(inner, reversed(after)):
                if s != FILL:
                    letters, state = self.traces[s, v][state]
                    out.append(letters)
        return out, state


def repaired(symbols: list[int], tables: Tables) -> tuple[int, str]:
    """Least cost and least audit of one conversation."""
    v, added, _ = tables.summary(symbols)
    letters, state = tables.trace(symbols, 0, NOTHING)
    return int(added[0] + tables.costs[v[0], NOTHING]), "".join(letters) + "I" * (tables.last[state] // INSERT)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times``: the rows of ``conversations`` with faults by the CRC-32 of ``conv_id:turn``; nulls as one space."""
    space = F.lit(" ")
    fault = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                             F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    text = F.coalesce("text", space)
    return rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
                       F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                       F.when(fault == 3, 2).otherwise(1).cast("long").alias("times"), fault.alias("fault")).where("fault <> 0").drop("fault")


def _same(left: DataFrame, right: DataFrame, *keys: str) -> Column:
    met = left[keys[0]].eqNullSafe(right["__" + keys[0]])
    for k in keys[1:]:
        met = met & left[k].eqNullSafe(right["__" + k])
    return met


def _named(df: DataFrame, *keys: str) -> DataFrame:
    return df.withColumnsRenamed({k: "__" + k for k in keys})


KEYS = ("conv_id", "turn", "role", "digest")


def _digested(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def placed(rows: DataFrame) -> DataFrame:
    """Different rows of ``rows (conv_id, turn, role, text, times)`` in their order, without their texts.

    ``conv_id, turn, role, digest, times, blank, duplicate, broken, symbol, pos``: ``pos`` grows along a conversation by turn (null first), role and digest
    of the text. ``times`` counts equal rows; all but the first of them are duplicates.
    """
    kept = F.rtrim("text", F.lit(BLANKS))
    last = F.substring(kept, -1, 1)
    narrow = _digested(rows).select(*KEYS, "times", (kept == "").alias("blank"), (~last.isin(".", "!", "?")).alias("broken"))
    narrow = narrow.groupBy(*KEYS, "blank", "broken").agg(F.sum("times").alias("times"))
    said = narrow.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("told"), "turn")).alias("first"))
    said = _named(said, "conv_id", "role", "digest")
    every = narrow.join(said, _same(narrow, said, "conv_id", "role", "digest")).withColumn("duplicate", ~F.col("blank") & ~F.col("turn").eqNullSafe(F.col("first.turn")))
    broken = F.col("broken") & ~F.col("blank") & ~F.col("duplicate")
    initial = F.coalesce(F.nullif(F.instr(F.lit(ROWS[:-1]), F.substring("role", 1, 1)) * (F.col("role") != "").cast("int"), F.lit(0)), F.lit(len(ROWS))) - 1
    symbol = F.when(F.col("blank") | F.col("duplicate"), GO).otherwise(2 + initial + len(ROWS) * broken.cast("int"))
    every = every.select(*KEYS, "times", "blank", "duplicate", broken.alias("broken"), initial.alias("initial"), symbol.cast("int").alias("symbol"))
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = [F.col("conv_id"), F.col("turn"), F.substring("role", 1, 32), F.col("digest")]
    return common.written(every.repartitionByRange(partitions, *near).sortWithinPartitions(*KEYS)
                          .withColumn("pos", F.monotonically_increasing_id()), "placed")


def _legal(first: int, then: int) -> bool:
    return ROWS[first] + ROWS[then] in ("su", "ua", "au")


SUMMARY = "conv_id long, chunk long, vectors binary, added binary, ends binary, first int, last int, illegal long, extra long"
CHAIN = "conv_id long, cost long, illegal long, chunk long, behind int, state int, closing boolean"
TRACED = "conv_id long, chunk long, audit string, tail string, pos array<long>, edits array<string>"


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(),
             "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _per_batch(function, schema: str):
    """A function of rows (dictionaries) to tuples, with the tables built once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables()
        for batch in batches:
            yield _table([out for row in batch.to_pylist() for out in function(tables, row)], schema)

    return run


def _summed(tables: Tables, row: dict) -> Iterator[tuple]:
    rows = row["rows"]
    v, added, ends = tables.summary([r["symbol"] for r in rows])
    initials = [r["initial"] for r in rows]
    extra = sum(r["times"] - 1 for r in rows)
    illegal = extra + sum(not _legal(a, b) for a, b in zip(initials, initials[1:]))
    yield (row["conv_id"], row["chunk"], v.astype(np.int16).tobytes(), added.tobytes(), ends.astype(np.int8).tobytes(), initials[0], initials[-1],
           illegal, extra)


def _chained(tables: Tables, row: dict) -> Iterator[tuple]:
    chunks = row["chunks"]
    v, cost, behind = 0, 0, []
    for c in reversed(chunks):
        behind.append(v)
        cost += int(np.frombuffer(c["added"], np.int64)[v]) + DELETE * c["extra"]
        v = int(np.frombuffer(c["vectors"], np.int16)[v])
    cost += int(tables.costs[v, NOTHING])
    illegal = sum(c["illegal"] for c in chunks) + sum(not _legal(a["last"], b["first"]) for a, b in zip(chunks, chunks[1:]))
    state = NOTHING
    for c, w in zip(chunks, reversed(behind)):
        yield row["conv_id"], cost, illegal, c["chunk"], w, state, c is chunks[-1]
        state = int(np.frombuffer(c["ends"], np.int8)[4 * w + state])


def _traced(tables: Tables, row: dict) -> Iterator[tuple]:
    rows, state = row["rows"], row["state"]
    letters, _ = tables.trace([r["symbol"] for r in rows], row["behind"], state)
    edits = []
    for some in letters:
        told = ""
        for e in some:  # rows inserted and reroled are named by their role
            if e in "IR":
                state = _INSERTED[state]
                told += "ua"[state == ASSISTANT] if e == "I" else "UA"[state == ASSISTANT]
            else:
                told += e
        edits.append(told)
        if some[-1] == "K":
            state = _NEXT[ROWS[rows[len(edits) - 1]["initial"]]][state]
    tail = {2: "a", 4: "ua"}.get(tables.last[state], "") if row["closing"] else ""
    audit = "".join(e + "D" * (r["times"] - 1) for e, r in zip(letters, rows)) + "I" * len(tail)
    yield row["conv_id"], row["chunk"], audit, tail, [r["pos"] for r in rows], edits


def _lines(edit: Column, role: Column, text: Column) -> Column:
    """The lines an edit gives: rows inserted, then the row itself."""
    own = (F.when(edit.endswith("K"), F.concat(role, F.lit(":"), text)).when(edit.endswith("U"), F.concat(F.lit("user:"), text))
           .when(edit.endswith("A"), F.concat(F.lit("assistant:"), text)))
    before = F.transform(F.split(F.regexp_replace(edit, "[A-Z]", ""), ""), lambda c: F.when(c == "u", "user:").when(c == "a", "assistant:"))
    return F.array_join(F.concat(before, F.array(own)), "\n")


def _hashed(lines: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: a conversation's lines go through the digest one by one, in their order."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, begun = None, None, False
        for batch in batches:
            done = []
            for conv_id, line in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or conv_id != now:
                    if begun:
                        done.append((now, state.hexdigest()))
                    now, state, begun = conv_id, hashlib.sha256(line.encode()), True
                else:
                    state.update(b"\n" + line.encode())
            yield _table(done, "conv_id long, repaired_sha256 string")
        if begun:
            yield _table([(now, state.hexdigest())], "conv_id long, repaired_sha256 string")

    ordered = lines.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "pos", "part").select("conv_id", "line")
    return ordered.mapInArrow(digest, "conv_id long, repaired_sha256 string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edits of all conversations in ``rows (conv_id, turn, role, text, times)``: conversations, rows and lines.

    * ``conv_id, blank, duplicate, truncated, gaps, illegal, cost, audit``, a row per conversation;
    * ``conv_id, pos, turn, role, digest, edit``, a row per different row: roles inserted before it (``u``, ``a``), then what becomes of it (``K`` kept,
      ``U``/``A`` made user or assistant, ``D`` deleted); equal rows after the first are deleted;
    * ``conv_id, pos, part, line``, the repaired conversations: ``part`` is 1 for rows inserted at the end.

    Rows go by turn (null first), role and the SHA-256 of the text. Roles count by their first letter, others than user, assistant and system can't be
    kept. A null conv_id is a conversation like any other; null roles and texts are one space, so empty. No rows: no conversations. A conversation's audit is one
    value and its digest one pass over its lines, in one task with flat memory; everything else is split by chunks.
    """
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "times")
    spots = placed(rows)
    flags = spots.groupBy("conv_id").agg(
        F.sum(F.when(F.col("blank"), F.col("times")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("times") - 1 + F.col("duplicate").cast("int"))).alias("duplicate"),
        F.sum(F.col("broken").cast("long")).alias("truncated"))
    span = (spots.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id")
            .agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")))
    chunks = common.written(spots.groupBy("conv_id", F.expr(f"pos div {CHUNK}").alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "symbol", "initial", "times"))).alias("rows")), "chunks")
    summed = chunks.mapInArrow(_per_batch(_summed, SUMMARY), SUMMARY)
    listed = summed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "chunk", "vectors", "added", "ends", "first", "last", "illegal", "extra"))).alias("chunks"))
    chain = common.written(listed.mapInArrow(_per_batch(_chained, CHAIN), CHAIN), "chain")
    steps = _named(chain.select("conv_id", "chunk", "behind", "state", "closing"), "conv_id", "chunk")
    todo = chunks.join(steps, _same(chunks, steps, "conv_id", "chunk")).select("conv_id", "chunk", "rows", "behind", "state", "closing")
    traced = common.written(todo.mapInArrow(_per_batch(_traced, TRACED), TRACED), "traced")
    audits = traced.groupBy("conv_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda c: c["audit"]), "").alias("audit"))
    told = chain.where("closing").select("conv_id", "cost", "illegal")
    talks = flags
    for more in (span, told, audits):
        more = _named(more, "conv_id")
        talks = talks.join(more, _same(talks, more, "conv_id")).drop("__conv_id")
    edits = _named(traced.select(F.explode(F.arrays_zip("pos", "edits")).alias("e")).select("e.pos", F.col("e.edits").alias("edit")), "pos")
    edited = spots.select(*KEYS, "pos").join(edits, F.col("pos") == F.col("__pos")).drop("__pos")
    texts = _named(_digested(rows).groupBy(*KEYS).agg(F.min("text").alias("text")), *KEYS)
    some = edited.where("edit <> 'D'")
    own = some.join(texts, _same(some, texts, *KEYS)).select(
        "conv_id", "pos", F.lit(0).alias("part"), _lines(F.col("edit"), F.col("role"), F.col("text")).alias("line"))
    tails = traced.where("tail <> ''").select("conv_id", F.array_max("pos").alias("pos"), F.lit(1).alias("part"), F.when(
        F.col("tail") == "a", "assistant:").otherwise("user:\nassistant:").alias("line"))
    return talks, edited, own.unionByName(tails)


def audited(conversations: DataFrame) -> DataFrame:
    """Every conversation of ``conversations (conv_id, turn, role, text)``, damaged and repaired, as counts, audit and digest.

    Conversations without rows after the damage have zeros, an empty audit and the digest of nothing. An empty table gives no rows.
    """
    talks, _, lines = repair(damaged(conversations))
    ids = conversations.select("conv_id").distinct()
    talks, hashes = _named(talks, "conv_id"), _named(_hashed(lines), "conv_id")
    every = ids.join(talks, _same(ids, talks, "conv_id"), "left").drop("__conv_id")
    every = every.join(hashes, _same(every, hashes, "conv_id"), "left")
    counts = [F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
