"""Token ids written as Re-Pair grammars.

Documents are sorted by id over the cluster, encoded, and gathered into shards of about ``SHARD`` ids. In a shard
the most frequent pairs of neighbouring symbols are replaced by nonterminals, again and again. A shard is one row of a Parquet table:

``part, shard``      place of the shard in the order of all documents
``doc_ids, n_tokens``  its documents
``first_symbol``     where each document's symbols begin: a document is read without the ones before it
``rules``            two uint16 symbols per nonterminal (nonterminal k is ``terminals + k``)
``expansions``       uint32 ids under each nonterminal
``symbols``          uint16, pairs never cross documents
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rungline.llm import common, tokens

SHARD = 1 << 21
SCHEMA = ("part int, shard int, doc_ids array<long>, n_tokens array<long>, first_symbol array<long>, total long, "
          "rules binary, expansions binary, symbols binary")
_MIX = np.uint32(0x9E3779B1)  # spreads pair codes over the look-up table
_BITS = 18
_NONE = np.uint32(0xFFFFFFFF)  # no pair: symbol 65535 is never used


def _slots(codes: np.ndarray) -> np.ndarray:
    return (codes * _MIX) >> np.uint32(32 - _BITS)


def compress(ids: np.ndarray, lengths: np.ndarray, terminals: int, rounds: int = 16, per_round: int = 4096,
             least: int = 16, gain: float = 0.05) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``rules, symbols, first symbol of each document``.

    A round replaces up to ``per_round`` of the most frequent pairs at once (pairs met ``least`` times or more; of overlapping
    occurrences the left one). The round that shortens the shard by less than ``gain`` is the last, or the ``rounds``-th.
    """
    room = 65535 - terminals
    if room < 0 or len(ids) and ids.max() >= terminals:
        raise ValueError("symbols are 16-bit numbers; the ids need more")
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(symbols), dtype=bool)
    ends = np.cumsum(lengths)
    last[ends[lengths > 0] - 1] = True
    rules: list[np.ndarray] = []
    made = 0
    for _ in range(rounds):
        if made >= room or len(symbols) < 2:
            break
        codes = (symbols[:-1] << np.uint32(16)) | symbols[1:]
        ordered = np.sort(codes[~last[:-1]])
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.array([], int)
        counts = np.diff(np.append(first, len(ordered)))
        often = np.flatnonzero(counts >= least)
        often = often[np.argsort(-counts[often], kind="stable")][:min(per_round, room - made)]
        if not len(often):
            break
        pairs = ordered[first[often]]
        slots = _slots(pairs)
        pairs = pairs[np.sort(np.unique(slots, return_index=True)[1])]  # of pairs that share a slot the most frequent
        slots = _slots(pairs)
        known, names = np.full(1 << _BITS, _NONE), np.zeros(1 << _BITS, dtype=np.uint32)
        known[slots], names[slots] = pairs, terminals + made + np.arange(len(pairs))
        at = _slots(codes)
        hit = (known[at] == codes) & ~last[:-1]
        where = np.flatnonzero(hit)
        run = np.concatenate([[True], where[1:] != where[:-1] + 1]) if len(where) else np.array([], bool)
        begin = np.maximum.accumulate(np.where(run, np.arange(len(where)), 0))
        where = where[(np.arange(len(where)) - begin) % 2 == 0]
        small = len(where) < gain * len(symbols)
        symbols[where] = names[at[where]]
        last[where] = last[where + 1]
        keep = np.ones(len(symbols), dtype=bool)
        keep[where + 1] = False
        symbols, last = symbols[keep], last[keep]
        rules.append(pairs)
        made += len(pairs)
        if small:
            break
    pairs = np.concatenate(rules) if rules else np.array([], dtype=np.uint32)
    table = np.stack([pairs >> np.uint32(16), pairs & np.uint32(0xFFFF)], axis=1).astype("<u2")
    counts = np.zeros(len(lengths), dtype=np.int64)
    counts[lengths > 0] = np.diff(np.flatnonzero(last), prepend=-1)
    return table, symbols.astype("<u2"), np.cumsum(counts) - counts


def expansions(rules: np.ndarray, terminals: int) -> np.ndarray:
    """Ids under each nonterminal; a rule only names symbols made before it."""
    sizes = [1] * len(rules)
    for k, (a, b) in enumerate(rules.tolist()):
        sizes[k] = (sizes[a - terminals] if a >= terminals else 1) + (sizes[b - terminals] if b >= terminals else 1)
    return np.array(sizes, dtype="<u4")


class Decoder:
    """Expands any stretch of a shard's symbols."""

    def __init__(self, rules: bytes, sizes: bytes, terminals: int):
        table = np.frombuffer(rules, dtype="<u2").reshape(-1, 2).tolist()
        self.sizes = np.concatenate([np.ones(terminals, np.int64), np.frombuffer(sizes, dtype="<u4").astype(np.int64)])
        self.starts = np.cumsum(self.sizes) - self.sizes
        under: list[list[int]] = []
        for a, b in table:
            under.append((under[a - terminals] if a >= terminals else [a]) + (under[b - terminals] if b >= terminals else [b]))
        self.flat = np.concatenate([np.arange(terminals), np.array([i for u in under for i in u], dtype=np.int64)]).astype("<u4")

    def __call__(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.sizes[symbols]
        total = int(sizes.sum())
        shift = self.starts[symbols] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(total)]


def write(docs: DataFrame, vocabulary: str, path: str, terminals: int, end_id: int = 2, shard: int = SHARD) -> None:
    """Writes the shards of ``docs (doc_id, text)`` to ``path`` in ascending doc_id order, ties by a hash of the text.

    Null texts are empty (the end id alone); a null id comes first; repeated rows are documents of their own. No rows: an empty table.
    """
    common.text_batches(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        codec = tokens.encoder(vocabulary).encode

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(x) // 4 for _, x in held], dtype=np.int64)
            ids = np.frombuffer(b"".join([x for _, x in held]), dtype="<u4")
            rules, symbols, first = compress(ids, lengths, terminals)
            values = [part, number, [d for d, _ in held], lengths, first, len(ids), rules.tobytes(),
                      expansions(rules, terminals).tobytes(), symbols.tobytes()]
            kinds = [pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 3, pa.int64(), *[pa.binary()] * 3]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                              names=[c.split()[0] for c in SCHEMA.split(", ")])

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), codec(batch.column(1).to_pylist())):
                held.append((doc_id, ids + end))
                size += len(ids) // 4 + 1
                if size >= shard:
                    yield flush()
                    number, size = number + 1, 0
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(encode, SCHEMA)
     .write.option("compression", "none").option("parquet.block.size", str(32 << 20)).parquet(path))


def read(spark: SparkSession, path: str, terminals: int, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the shards at ``path``; ``with_ids`` adds the ids."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # a row is a whole shard
    shards = spark.read.schema(SCHEMA).parquet(path)
    schema = "part int, shard int, doc_id long, before long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Decoder(row["rules"], row["expansions"], terminals)(np.frombuffer(row["symbols"], dtype="<u2"))
                lengths = np.array(row["n_tokens"], dtype=np.int64)
                before = np.cumsum(lengths) - lengths
                parts = [ids[a:a + n].tobytes() for a, n in zip(before.tolist(), lengths.tolist())]
                n = len(parts)
                arrays = [pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()),
                          pa.array(row["doc_ids"], pa.int64()), pa.array(before), pa.array(lengths), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                if with_ids:
                    arrays.append(pa.array(parts, pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in schema.split(", ")])

    # one number per shard of about two million ids
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))
    found = shards.drop("total", "first_symbol").mapInArrow(decode, schema).join(starts, ["part", "shard"])
    return found.select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def read_document(shard: dict, at: int, terminals: int) -> np.ndarray:
    """The ids of the ``at``-th document of a shard (a row as a dict), from its own symbols alone."""
    first = shard["first_symbol"]
    symbols = np.frombuffer(shard["symbols"], dtype="<u2")
    end = first[at + 1] if at + 1 < len(first) else len(symbols)
    return Decoder(shard["rules"], shard["expansions"], terminals)(symbols[first[at]:end])
