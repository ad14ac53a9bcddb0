"""Toxicity by a weighted lexicon.

Texts are folded (case, look-alike letters, digits and signs that stand for letters inside a word), then an
Aho-Corasick automaton finds the lexicon's word beginnings. Hits inside exception phrases don't count; the weights of the others are
summed and normalised by length. Lexicon, exceptions and the two score coefficients are learnt from labelled documents.
"""
from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rungline.llm import common, labelled

#: Look-alikes of Latin letters (Cyrillic, Greek and a few others), in pairs.
_ALIKE = dict(zip("абвгдезікмнорстухѕјһԁԛԝαβγεηικνορτυχωɑɡɩɪıƖℓ", "abbrge3ikmhopctyxsjhdqwabyenikvoptuxwagiiiil"))
#: Signs read as letters where they stand in a word; l and i fold into one letter, as 1 may mean either.
_SIGNS = dict(zip("013456789@$!|+€£", "oieasgtbgasiiteł"))
_INSIDE = re.compile(r"(?<=[^\W\d_])[0-9@$!|+€£]+(?=[^\W\d_])|(?<![^\W_])[0-9@$]+(?=[^\W\d_]{2})|(?<=[^\W\d_]{3})[013457]+(?![^\W_])")
_JOINED = dict.fromkeys(map(ord, "​‌‍⁠﻿­"))


class _Letters(dict):
    def __missing__(self, code: int) -> int | str:
        c = chr(code)
        plain = _ALIKE.get(c, c)
        if code > 0x24F and plain == c:
            plain = unicodedata.normalize("NFKC", c).lower()
        self[code] = plain
        return plain


class _Blanks(dict):
    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = "i" if c == "l" else c if c.isalpha() else " "
        return self[code]


_LETTERS, _BLANKS = _Letters(_JOINED), _Blanks()
_SIGN_TABLE = str.maketrans(_SIGNS)


def fold(text: str | None) -> str:
    """Folded words, each after one or more blanks, and a blank at the end."""
    text = (text or "").lower()
    if not text.isascii():
        text = text.translate(_LETTERS)
    text = _INSIDE.sub(lambda m: m[0].translate(_SIGN_TABLE), text)
    return " " + text.translate(_BLANKS) + " "


def stems(folded: str, shortest: int = 4, longest: int = 8) -> set[str]:
    """What may become a lexicon entry: word beginnings, and whole words (with a blank at the end)."""
    out = set()
    for word in set(folded.split()):
        out.update([" " + word[:k] for k in range(shortest, min(longest, len(word)) + 1)])
        out.add(f" {word} ")
    return out


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    bias: float = 0.0
    by_density: float = 1.0
    by_weight: float = 1.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for stem, weight in self.weights.items():
            found.add_word(stem, (len(stem.rstrip()), weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        if len(found):
            found.make_automaton()
        return found

    def measures(self, text: str | None, automaton) -> tuple[float, float]:
        """The summed weight of the hits, and its share by square root of the words."""
        folded = fold(text)
        total = 0.0
        if len(automaton):
            spans, hits = [], {}
            for end, (length, weight) in automaton.iter(folded):
                if weight is None:
                    spans.append((end - length + 1, end))
                else:
                    at = folded.rfind(" ", 0, end) if folded[end] != " " else folded.rfind(" ", 0, end - 1)
                    hits[at] = max(weight, hits.get(at, 0.0))  # a word counts once, with its heaviest stem
            total = sum(w for at, w in hits.items() if not any(a <= at <= b for a, b in spans)) if spans else sum(hits.values())
        return total, total / math.sqrt(folded.count(" ") + 1)

    def score(self, total: np.ndarray, density: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + self.by_density * density + self.by_weight * np.log1p(total), -30, 30)))


def _counted(texts: DataFrame, only: frozenset[str] | None, flush: int = 300_000) -> DataFrame:
    """``stem, toxic, clean``: documents that hold each stem; counts are summed before they are shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = [*dict.fromkeys([*counts[0], *counts[1]])]
            columns = [pa.array(keys, pa.string()), *[pa.array([counts[k][s] for s in keys], pa.int64()) for k in (1, 0)]]
            counts[0].clear(), counts[1].clear()
            return pa.RecordBatch.from_arrays(columns, names=["stem", "toxic", "clean"])

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = stems(fold(text))
                counts[int(label > 0)].update(found if only is None else found & only)
                if len(counts[0]) + len(counts[1]) > flush:
                    yield out()
        yield out()

    got = texts.select("text", "__label").mapInArrow(count, "stem string, toxic long, clean long")
    return got.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn(docs: DataFrame, labels: DataFrame, rows: int = labelled.SAMPLE, share: float = 0.01, ratio: float = 20.0,
          least_odds: float = 2.0, exceptions: list[str] | None = None) -> Lexicon:
    """The lexicon from at most ``rows`` labelled documents that are not held out.

    Entries are stems in at least ``share`` of the toxic documents (which bounds their number whatever the size of the corpus)
    and ``ratio`` times as common there as in clean ones, with log odds that stay over ``least_odds`` less 1.5 standard errors; of nested stems the shortest stays unless it is much weaker. A pair of words
    that holds an entry and is met in clean documents but hardly in toxic ones becomes an exception, like ``exceptions`` (given phrases).
    A document counts once, with its smallest text where its id is repeated.
    Without toxic or clean documents the lexicon is empty and every score is the share of toxic labels.
    """
    common.text_batches(docs.sparkSession)
    seen = labelled.joined(docs.select("doc_id", "text"), labels, "toxic", rows)
    once = seen.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("__label").alias("__label"))
    seen = common.written(once, "labelled")
    n = {r[0]: r[1] for r in seen.groupBy("__label").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return Lexicon({}, bias=math.log((toxic + 0.5) / (clean + 0.5)))
    least = max(3, math.ceil(share * toxic))
    common_stems = {r["stem"]: r["toxic"] for r in _counted(seen.where("__label > 0"), None).where(F.col("toxic") >= least).collect()}
    in_clean = {r["stem"]: r["clean"] for r in _counted(seen.where("__label = 0"), frozenset(common_stems)).collect()}
    odds = {}
    for stem, t in common_stems.items():
        c = in_clean.get(stem, 0)
        weight = math.log((t + 0.5) / (toxic - t + 0.5)) - math.log((c + 0.5) / (clean - c + 0.5))
        if t / toxic >= ratio * (c / clean) and weight - 1.5 * math.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)) >= least_odds:
            odds[stem] = weight
    chosen: dict[str, float] = {}
    for stem in sorted(odds, key=lambda s: (len(s.rstrip()), s)):
        held = [stem[:k] for k in range(2, len(stem)) if stem[:k] in chosen]
        if not held or odds[stem] > max(chosen[h] for h in held) + 2:
            chosen[stem] = odds[stem]
    lexicon = Lexicon(chosen, [fold(e) for e in exceptions or []])
    lexicon.exceptions += _exceptions(seen, lexicon, toxic, clean)
    measured = seen.select("doc_id", "__label", measure(lexicon)("text").alias("m")).select("__label", "m.*").toPandas()
    _calibrate(lexicon, measured)
    return lexicon


def _exceptions(seen: DataFrame, lexicon: Lexicon, toxic: int, clean: int, least: int = 5) -> list[str]:
    """Pairs of words with an entry that at least ``least`` clean documents hold, relatively ``least`` times as many as toxic ones."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = lexicon.automaton()
        for batch in batches:
            counts: Counter = Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = fold(text).split()
                held = {i for i, w in enumerate(words) if next(found.iter(f" {w} "), None)} if len(found) else ()
                near = {f" {words[j]} {words[j + 1]} " for i in held for j in (i - 1, i) if 0 <= j < len(words) - 1}
                counts.update((p, int(label > 0)) for p in near)
            rows = [*counts.items()]
            yield pa.RecordBatch.from_arrays([pa.array([p for (p, _), _ in rows], pa.string()),
                                              pa.array([n * k for (_, k), n in rows], pa.int64()),
                                              pa.array([n * (1 - k) for (_, k), n in rows], pa.int64())], names=["pair", "toxic", "clean"])

    got = (seen.select("text", "__label").mapInArrow(pairs, "pair string, toxic long, clean long").groupBy("pair")
           .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
           .where((F.col("clean") >= least) & (F.col("clean") * toxic > least * F.col("toxic") * clean)))
    return [r["pair"] for r in got.collect()]  # at most the sample's hits / least


def measure(lexicon: Lexicon):
    """A column function: text to ``total``, ``density`` and ``score``."""
    kept: list = []

    @F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in ("total", "density", "score")]))
    def measured(texts: pd.Series) -> pd.DataFrame:
        if not kept:
            kept.append(lexicon.automaton())
        pairs = np.array([lexicon.measures(t, kept[0]) for t in texts], dtype=float).reshape(-1, 2)
        return pd.DataFrame({"total": pairs[:, 0], "density": pairs[:, 1], "score": lexicon.score(pairs[:, 0], pairs[:, 1])})

    return measured


def _calibrate(lexicon: Lexicon, seen: pd.DataFrame, steps: int = 60, penalty: float = 1e-2) -> None:
    """Newton steps of a logistic fit of the label to density and total weight, neither with a negative coefficient."""
    y = (seen["__label"].to_numpy() > 0).astype(float)
    x = np.stack([np.ones(len(seen)), seen["density"].to_numpy(), np.log1p(seen["total"].to_numpy())], axis=1)
    b = np.array([-1.0, 0.5, 0.5])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (p - y) + penalty * b
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(3) * penalty * 10
        step = np.linalg.solve(hessian, gradient)
        b = b - step / max(1.0, np.abs(step).max())
        b[1:] = np.maximum(b[1:], 0)
    lexicon.bias, lexicon.by_density, lexicon.by_weight = map(float, b)


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs (doc_id, text)``; null texts are empty and score the least."""
    common.text_batches(docs.sparkSession)
    score = measure(lexicon)("text").getField("score")
    return docs.select("doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def clean_only(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows of ``docs`` that score under 0.5, all columns as they are."""
    common.text_batches(docs.sparkSession)
    return docs.where(measure(lexicon)(F.col("text")).getField("score") < 0.5)
