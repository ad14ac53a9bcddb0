"""Phrases whose words occur together more often than their parts suggest.

Every word of a text points to the suffix that begins there, cut after ``DEPTH`` words or at the end of its piece. Pointers are first combined
where the texts are read, then routed by their leading words: all suffixes of a leading word meet in one task, those of a very frequent word are
routed by two words, and by three where both are very frequent. There a multikey three-way quicksort compares one word at a time:
the pointers equal to the pivot are one partition, whose size is the count of the phrase that leads there, and go on with the next word;
partitions of fewer pointers than a phrase must have are abandoned. Words are bytes or numbers of a task's own; no vocabulary is sent around.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rungline.llm import common

#: Words of a phrase, at most, and occurrences, at least.
DEPTH, LEAST = 3, 10
#: A word is very frequent from this share of all words and this count on; so there are at most as many of them as the share's inverse.
SHARE, FREQUENT = 4096, 1 << 16
#: Words after which the suffixes read so far are combined; a piece is never split.
HELD = 1 << 19
#: Phrases of a batch handed on, bytes of a batch taken in: a block is a large row.
ROWS, BATCH = 1 << 14, 1 << 22
#: Suffixes a task holds, about; with more of them there are more tasks. Of these so many are sorted at once, all that begin with some of its words.
SORTED, SLICE = 2_000_000, 1 << 18

#: Parts of a language that are ranked each by itself first.
PARTS = 64
#: Bytes of a text that are split into words at once.
SLAB = 1 << 24

_UPPER = bytes(range(65, 91))
_TABLE = bytes.maketrans(_UPPER + b"\t" + b".,;:!?\x0b\x0c\r", _UPPER.lower() + b" " + b"\n" * 9)


class Numbers(dict):
    """Words in the order they are met first, numbered from 1; 0 is the end of a piece, -1 what stands between two blanks."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 1
        return n

    def names(self) -> list[bytes]:
        return [b"", *list(self)[2:]]


def numbered(text: str | None, known: Numbers) -> Iterator[np.ndarray]:
    """The words of a text as numbers, 0 after each piece, slab by slab: lower-cased, split at blanks and tabs."""
    raw = (text or "").encode().translate(_TABLE).replace(b"\n", b" \n ") + b" \n"
    at = 0
    while 0 <= at < len(raw):
        end = raw.find(b" ", at + SLAB)
        some = np.fromiter(map(known.__getitem__, raw[at:end if end >= 0 else len(raw)].split(b" ")), np.int32)
        yield some[some >= 0]
        at = end


def multikey(words: np.ndarray, weight: np.ndarray, least: int, always: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Counts of the leading words of suffixes, by three-way quicksort: ``(depth, suffixes, counts)``, one suffix for each phrase.

    ``words`` has a row per depth and a column per suffix, 0 where the suffix has ended. All partitions of a depth are split at once, each by its own
    pivot into smaller, equal and greater; the equal ones are done with the depth and wait for the next. Partitions with a total weight under ``least``
    are abandoned, unless a suffix of theirs has an ``always`` of more than the depth: those phrases are told whatever their count.
    """
    depth, n = words.shape
    if always is None:
        always = np.zeros(n, np.int8)
    at, sizes = np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64), np.full(min(n, 1), n)
    for d in range(depth):
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        rows = at, words[d][at], weight[at], always[at]
        while len(sizes):
            value, first = rows[1], np.cumsum(sizes) - sizes
            three = np.sort([value[first], value[first + sizes // 2], value[first + sizes - 1]], axis=0)
            pivot = three[1]
            wide = np.repeat(pivot, sizes)
            less, equal = value < wide, value == wide
            parts = []
            for side in (less, equal, ~(less | equal)):
                count = np.add.reduceat(side, first, dtype=np.int64)
                full = count > 0
                size = count[full]
                if not len(size):
                    continue
                some = [r[side] for r in rows]
                begin = np.cumsum(size) - size
                total = np.add.reduceat(some[2], begin)
                go = (total >= least) | (np.maximum.reduceat(some[3], begin) > d)
                if side is equal:
                    go &= pivot[full] != 0
                    if go.any():
                        yield d, some[0][begin[go]], total[go]
                        waiting.append((some[0][np.repeat(go, size)], size[go]))
                elif go.any():
                    keep = np.repeat(go, size)
                    parts.append(([r[keep] for r in some], size[go]))
            rows = tuple(np.concatenate([p[0][k] for p in parts]) for k in range(4)) if parts else ()
            sizes = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        if not waiting:
            return
        at, sizes = (np.concatenate([w[k] for w in waiting]) for k in range(2))


BLOCK = "lang string, names binary, codes binary, counts binary, words long, often array<struct<word:binary,f:long>>"


_BITS = 21


def _sorted_suffixes(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different suffixes of the words held, a row per depth, in order, and how often each is there."""
    codes = np.concatenate([*held, np.zeros(DEPTH, np.int32)])
    at = np.flatnonzero(codes)
    one, two, three = codes[at], codes[at + 1], codes[at + 2]
    three = np.where(two == 0, 0, three)
    if not len(one):
        return np.zeros((DEPTH, 0), np.int32), np.zeros(0, np.int64)
    if codes.max() < 1 << _BITS:  # three words fit one number
        key = np.sort(one.astype(np.int64) << 2 * _BITS | two.astype(np.int64) << _BITS | three)
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        some, low = key[first], (1 << _BITS) - 1
        words = np.stack([some >> 2 * _BITS, some >> _BITS & low, some & low]).astype(np.int32)
    else:
        order = np.lexsort((three, two, one))
        one, two, three = one[order], two[order], three[order]
        first = np.flatnonzero(np.concatenate(([True], (np.diff(one) != 0) | (np.diff(two) != 0) | (np.diff(three) != 0))))
        words = np.stack([one[first], two[first], three[first]])
    return words, np.diff(np.append(first, len(one)))


def _packed(names: np.ndarray, words: np.ndarray) -> tuple[bytes, bytes]:
    """The names that ``words`` has, joined by blanks, and ``words`` as numbers into them: 16 bits where these are enough."""
    seen = np.zeros(len(names), bool)
    seen[0] = True  # the end of a piece is always 0
    seen[words] = True
    codes = (np.cumsum(seen) - 1)[words]
    used = np.flatnonzero(seen)
    return b" ".join(names[used[1:]].tolist()), codes.astype("<u2" if len(used) < 1 << 16 else "<u4").tobytes()


def _unpacked(names: bytes, codes: bytes, n: int) -> tuple[list[bytes], np.ndarray]:
    """Names, the end of a piece first, and the suffixes' words as numbers into them."""
    return [b"\n", *(names.split(b" ") if names else [])], np.frombuffer(codes, "<u2" if len(codes) == 2 * DEPTH * n else "<u4").reshape(DEPTH, n)


def suffixes(docs: DataFrame) -> DataFrame:
    """Blocks of different suffixes ``lang, names, codes, counts, words, often``, as combined from a run of texts; ``often``: leading words with a share."""
    def block(lang: str, known: Numbers, held: list[np.ndarray]) -> pa.RecordBatch:
        words, counts = _sorted_suffixes(held)
        names = np.array(known.names(), dtype=object)
        packed, codes = _packed(names, words)
        total = int(counts.sum())
        by_word = np.bincount(words[0], counts, len(names)).astype(np.int64)
        often = [{"word": names[i], "f": int(by_word[i])} for i in np.flatnonzero(by_word * 2 * SHARE >= max(total, 1)).tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([packed], pa.binary()), pa.array([codes], pa.binary()), pa.array([counts.astype("<u4").tobytes()], pa.binary()),
             pa.array([total]), pa.array([often], pa.list_(pa.struct([("word", pa.binary()), ("f", pa.int64())])))], names=_names(BLOCK))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, Numbers] = {}
        held: dict[str, list[np.ndarray]] = {}
        words = 0
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                known, parts = numbers.setdefault(lang, Numbers()), held.setdefault(lang, [])
                for some in numbered(text, known):
                    parts.append(some)
                    words += len(some)
                if words >= HELD:
                    for lang in held:
                        yield block(lang, numbers[lang], held[lang])
                    numbers, held, words = {}, {}, 0
        for lang in held:
            yield block(lang, numbers[lang], held[lang])

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(read, BLOCK)


def _names(schema: str) -> list[str]:
    return re.findall(r"(?:^|, )(\w+) ", schema)


ROUTED = "route int, lang string, names binary, codes binary, counts binary"
FOUND = "lang string, words int, phrase binary, count long"


def _routed(blocks: DataFrame, hot: frozenset[tuple[str, bytes]], routes: int) -> DataFrame:
    """Blocks cut by route: the leading word, with the second one if the first is very frequent, with the third if both are."""
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, packed, codes, counts in zip(*(c.to_pylist() for c in batch.columns)):
                counts = np.frombuffer(counts, "<u4")
                names, words = _unpacked(packed, codes, len(counts))
                code = np.fromiter((xxhash.xxh3_64_intdigest(lang.encode() + b"\n" + w) for w in names), np.uint64, len(names))
                frequent = np.fromiter(((lang, w) in hot for w in names), bool, len(names))
                lead = frequent[words[0]]
                both = lead & frequent[words[1]]
                mixed = code[words[0]]
                mixed = np.where(lead, mixed * _MIX ^ code[words[1]], mixed)
                mixed = np.where(both, mixed * _MIX ^ code[words[2]], mixed)
                to = ((mixed * _MIX >> np.uint64(32)) % np.uint64(routes)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                to, words, counts = to[order], words[:, order], counts[order]
                cuts = np.append(np.flatnonzero(np.concatenate(([True], np.diff(to) != 0))), len(to)) if len(to) else np.zeros(1, np.int64)
                listed = np.array([b"", *names[1:]], dtype=object)
                rows = [(int(to[a]), *_packed(listed, words[:, a:b]), counts[a:b].tobytes()) for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
                columns = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array([lang] * len(rows), pa.string()),
                                                  *[pa.array(c, pa.binary()) for c in columns[1:]]], names=_names(ROUTED))

    return blocks.select("lang", "names", "codes", "counts").mapInArrow(route, ROUTED)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _joined(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Words, a row per depth, and counts of suffixes as one array each."""
    return np.concatenate([words for words, _ in held], axis=1), np.concatenate([counts for _, counts in held])


def _slices(held: list[tuple[np.ndarray, np.ndarray]], names: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The suffixes held, those of one leading word together, ``SLICE`` of them at once or those of a single word."""
    sizes = np.zeros(names, np.int64)
    for words, _ in held:
        sizes += np.bincount(words[0], minlength=names)
    ends = np.flatnonzero(np.diff((np.cumsum(sizes) - 1) // SLICE, append=-2)) + 1  # the last word of each slice, and one on
    for low, high in zip(np.append(0, ends[:-1]).tolist(), ends.tolist()):
        chosen = [(words[:, some], counts[some]) for words, counts in held if (some := (words[0] >= low) & (words[0] < high)).any()]
        if chosen:
            yield _joined(chosen)


def _counted(routed: DataFrame, hot: frozenset[tuple[str, bytes]], least: int) -> DataFrame:
    """Counts of phrases, from all suffixes of a task; those led by very frequent words only may be parts of a count.

    All suffixes of a task are held as numbers, 16 bytes each; the quicksort, which needs several times as much, goes by slices of leading words.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, Numbers] = {}
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        small: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting: dict[str, int] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                lang, packed, codes, counts = (c[k].as_py() for c in batch.columns[1:])
                known, parts = numbers.setdefault(lang, Numbers()), small.setdefault(lang, [])
                weight = np.frombuffer(counts, "<u4")
                names, words = _unpacked(packed, codes, len(weight))
                parts.append((np.fromiter(map(known.__getitem__, names), np.int32, len(names))[words], weight))
                waiting[lang] = waiting.get(lang, 0) + len(weight)
                if waiting[lang] >= SLICE // 4:  # many small arrays would take more than their numbers
                    held.setdefault(lang, []).append(_joined(parts))
                    small[lang], waiting[lang] = [], 0
        for lang in list(small):
            names = numbers.pop(lang).names()
            frequent = np.fromiter(((lang, name) in hot for name in names), bool, len(names))
            for words, weight in _slices(held.pop(lang, []) + small.pop(lang), len(names)):
                lead = frequent[words[0]]
                always = lead.astype(np.int8) + (lead & frequent[words[1]])
                for d, found, counts in multikey(words, weight.astype(np.int64), least, always):
                    for a in range(0, len(found), ROWS):
                        at = found[a:a + ROWS]
                        phrases = [b" ".join([names[w] for w in path]) for path in zip(*(words[k, at].tolist() for k in range(d + 1)))]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(at)), pa.array(np.full(len(at), d + 1, np.int32)), pa.array(phrases, pa.binary()),
                             pa.array(counts[a:a + ROWS])], names=_names(FOUND))

    return routed.mapInArrow(count, FOUND)


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``lang, words, phrase, f`` of all phrases of at most three words with ``f >= least``, and ``lang, n`` (its words)."""
    spark = docs.sparkSession
    # a bound of bytes, which only makes batches smaller, whatever else the session runs
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    blocks = common.written(suffixes(docs), "suffixes")
    total = blocks.groupBy("lang").agg(F.sum("words").alias("n"))
    words, rows = blocks.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum(F.length("counts") / 4), F.lit(0))).first()
    # blocks tell the words with half the share; at most SHARE words can have the whole one
    told = blocks.select("lang", F.explode("often").alias("o")).groupBy("lang", "o.word").agg(F.sum("o.f").alias("f"))
    many = told.where((F.col("f") * SHARE >= words) & (F.col("f") >= FREQUENT)).select("lang", "word").collect()
    hot = frozenset((r.lang, bytes(r.word)) for r in many)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(rows) // SORTED))
    routed = _routed(blocks, hot, tasks).repartition(tasks, "route")
    counts = _counted(routed, hot, least).groupBy("lang", "words", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("count").alias("f"))
    return common.written(counts.where(F.col("f") >= least), "phrases"), total


def collocations(docs: DataFrame, top: int = 2000, least: int = LEAST, covered: int = 50) -> DataFrame:
    """Per language the ``top`` phrases of two to three words by how much more often they occur than their parts suggest.

    ``docs (lang, text)`` to ``lang, rank, phrase, a, l, r, n, score``; a null language is ``und``, a null text empty. Texts end pieces at
    ``[.,;:!?]`` and line ends, words are what stands between blanks and tabs, A-Z lower-cased. ``a`` counts the phrase, ``l`` and ``r`` the parts of the cut
    with the lowest ``score = floor(1000000 * a * a / (l * r))`` (ties: the earlier cut), ``n`` all words of the language. Phrases under ``least``
    occurrences, and those inside a longer candidate that has ``covered`` percent of their count, are left out. Ties in the score: larger ``a``, then the
    phrase in byte order. Repeated rows count as often as they are there; an empty table gives no rows.
    """
    found, total = phrase_counts(docs, least)
    part = F.split("phrase", " ")
    words = F.when(F.col("words") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    cuts = (found.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), F.explode(words).alias("k"))
            .withColumn("first", F.array_join(F.slice(part, F.lit(1), F.col("k")), " "))
            .withColumn("rest", F.array_join(F.slice(part, F.col("k") + 1, F.col("words") - F.col("k")), " ")))
    left = found.select(F.col("lang").alias("__ll"), F.col("phrase").alias("__lp"), F.col("f").alias("l"))
    right = found.select(F.col("lang").alias("__rl"), F.col("phrase").alias("__rp"), F.col("f").alias("r"))
    cuts = (cuts.join(left, (F.col("lang") == F.col("__ll")) & (F.col("first") == F.col("__lp")))
            .join(right, (F.col("lang") == F.col("__rl")) & (F.col("rest") == F.col("__rp"))))
    whole = [F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")]
    # a is at most l and at most r, so the quotient is at most a million; the products may pass 64 bits
    score = F.expr("cast(cast(1000000 as decimal(7,0)) * a19 * a19 as decimal(38,0)) div cast(l19 * r19 as decimal(38,0))")
    scored = (cuts.withColumns(dict(zip(("a19", "l19", "r19"), whole))).withColumn("score", score)
              .groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")))
    inner = (found.where("words = 3").select("lang", "f", F.explode(F.array(
        F.array_join(F.slice(part, 1, 2), " "), F.array_join(F.slice(part, 2, 2), " "))).alias("phrase"))
        .groupBy(F.col("lang").alias("__il"), F.col("phrase").alias("__ip")).agg(F.max("f").alias("__longer")))
    kept = (scored.join(inner, (F.col("lang") == F.col("__il")) & (F.col("phrase") == F.col("__ip")), "left")
            .where(F.coalesce(F.col("__longer") * 100 < F.col("a") * covered, F.lit(True))))
    # first within parts of a language, so that one task reads at most PARTS times as many phrases as are told
    order = [F.desc("best.score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    some = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
            .join(total.select(F.col("lang").alias("__nl"), "n"), F.col("lang") == F.col("__nl"))
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", F.col("best.score").cast("long").alias("score")))
