"""Quality rules: gradient-boosted trees over document statistics.

Trees are grown on histograms of a bounded labelled sample, with monotonic constraints on chosen statistics, and flattened
into numpy arrays of nodes; a batch of documents walks all trees level by level.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rungline.llm import common, labelled

SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "digits", "shouts", "stops", "distinct",
            "stutter", "lines", "wide"]
#: -1: quality never rises with the statistic.
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeats": -1, "shouts": -1, "stutter": -1}
_CAPITALS, _DIGITS, _STOPS = bytes(range(65, 91)), b"0123456789", b".,;:?"


def repeated_words(words: list[bytes], window: int = 3) -> tuple[int, int, int]:
    """Words in windows found at least twice, distinct words, words equal to the one before."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    stutter = int((ids[1:] == ids[:-1]).sum())
    n = len(ids) - window + 1
    if n < 2:
        return 0, len(number), stutter
    codes = ids[:n]
    for k in range(1, window):
        codes = codes * len(number) + ids[k:n + k]
        if len(number) > 2_000_000:  # the next product would pass 63 bits
            codes = np.unique(codes, return_inverse=True)[1]
    ordered = np.sort(codes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0, len(number), stutter
    found = np.isin(codes, twice)
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(window):
        covered[k:n + k] |= found
    return int(covered.sum()), len(number), stutter


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The five base counts and the features of one whole text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes split at the six ASCII white-space characters
    n, chars = len(words), len(text) - len(raw) + sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.encode().split()] if "\n" in text else [text] * (n > 0)
    dup_lines = len(lines) - len(set(lines))
    repeats, distinct, stutter = repeated_words(words) if words else (0, 0, 0)
    per, size = max(n, 1), max(len(raw), 1)
    without = lambda some: len(raw) - len(raw.translate(None, some))
    return [n, chars, symbols, dup_lines, repeats], [
        float(np.log1p(n)), chars / per, symbols / per, dup_lines / max(len(lines), 1), repeats / per, without(_CAPITALS) / size,
        without(_DIGITS) / size, raw.count(b"!") / per, without(_STOPS) / per, distinct / per, stutter / per, len(lines) / per,
        (len(raw) - len(text)) / size]


def described(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts and ``features`` of every row of ``docs (doc_id, text)``; null texts are empty."""
    common.text_batches(docs.sparkSession)
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", features array<double>"

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for t in batch.column(1).to_pylist()]
            arrays = [batch.column(0), *[pa.array([r[0][i] for r in rows], pa.int64()) for i in range(len(BASE))],
                      pa.array([r[1] for r in rows], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *BASE, "features"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(describe, schema)


@dataclass
class Trees:
    """Nodes of all trees in flat arrays; a leaf points to itself."""
    start: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    depth: int

    def probability(self, x: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.low[at], self.high[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, monotone: dict[int, int], trees: int = 80, depth: int = 4, rate: float = 0.2, bins: int = 48,
        penalty: float = 1.0, least: int = 10) -> Trees:
    """Newton boosting of the logistic loss. ``monotone``: sign by feature; bounds are handed down so that no later split breaks them.

    Without rows, or with one class alone, the model is a constant.
    """
    mean = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    nodes: list[list[float]] = []
    roots = []
    margin = np.full(len(y), np.log(mean / (1 - mean)))
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        coded = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)

        def leaf(g: float, h: float, lo: float, hi: float) -> float:
            return float(np.clip(-g / (h + penalty), lo, hi))

        def grow(rows: np.ndarray, level: int, lo: float, hi: float) -> int:
            me = len(nodes)
            g, h = grad[rows].sum(), hess[rows].sum()
            nodes.append([0, np.inf, me, me, rate * leaf(g, h, lo, hi)])
            best = (1e-6, None)
            if level < depth and len(rows) >= 2 * least:
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    part = coded[rows, f]
                    gs = np.cumsum(np.bincount(part, grad[rows], len(e) + 1))[:-1]
                    hs = np.cumsum(np.bincount(part, hess[rows], len(e) + 1))[:-1]
                    ns = np.cumsum(np.bincount(part, minlength=len(e) + 1))[:-1]
                    left, right = np.clip(-gs / (hs + penalty), lo, hi), np.clip(-(g - gs) / (h - hs + penalty), lo, hi)
                    score = lambda v, a, b: -(a * v + 0.5 * (b + penalty) * v * v)
                    gain = score(left, gs, hs) + score(right, g - gs, h - hs) - score(leaf(g, h, lo, hi), g, h)
                    good = (ns >= least) & (len(rows) - ns >= least)
                    if sign := monotone.get(f):
                        good &= sign * (right - left) >= 0
                    if good.any():
                        i = int(np.where(good, gain, -np.inf).argmax())
                        if gain[i] > best[0]:
                            best = (gain[i], (f, i, left[i], right[i]))
            if best[1]:
                f, i, left, right = best[1]
                below = coded[rows, f] <= i
                middle, sign = (left + right) / 2, monotone.get(f, 0)
                a = (lo, middle) if sign > 0 else (middle, hi) if sign < 0 else (lo, hi)
                b = (middle, hi) if sign > 0 else (lo, middle) if sign < 0 else (lo, hi)
                nodes[me][0], nodes[me][1] = f, edges[f][i]
                nodes[me][2] = grow(rows[below], level + 1, *a)
                nodes[me][3] = grow(rows[~below], level + 1, *b)
            else:
                margin[rows] += nodes[me][4]
            return me

        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
    table = np.array(nodes or [[0, np.inf, 0, 0, 0.0]], dtype=float)
    return Trees(float(np.log(mean / (1 - mean))), np.array(roots or [0]), table[:, 0].astype(int), table[:, 1],
                 table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4], depth)


def train(features: DataFrame, labels: DataFrame, rows: int = labelled.SAMPLE) -> Trees:
    """Fitted to at most ``rows`` labelled documents; ``features (doc_id, features)``."""
    seen = (labelled.joined(features.select("doc_id", "features"), labels, "quality", rows)
            .groupBy("doc_id").agg(F.min("features").alias("features"), F.max("__label").alias("__label")).orderBy("doc_id").toPandas())
    x = np.array(seen["features"].tolist(), dtype=float).reshape(len(seen), len(FEATURES))
    return fit(x, seen["__label"].to_numpy(dtype=float), {FEATURES.index(k): v for k, v in MONOTONE.items()})


def judged(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Base counts, ``base_failed``, ``quality`` (the trees' probability) and ``kept`` of every row of ``docs (doc_id, text)``.

    Null and empty texts have no words and fail the base rules. Rows with null or repeated ids are judged like any other.
    Without labels the trees are undecided and the base rules decide.
    """
    known = common.written(described(docs), "statistics")
    model = train(known, labels)
    names = ["doc_id", *BASE]
    schema = ", ".join(f"{c} long" for c in names) + ", quality double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(model.probability(x))], names=[*names, "quality"])

    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (known.mapInArrow(score, schema).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))
