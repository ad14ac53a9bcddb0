"""License scans: MinHash bands over text windows retrieve templates, exact shingle containment verifies them.

Texts become lower-case words and shingles of five words. Templates are sorted into classes by their length; each class slides
windows a quarter longer than its longest template, a quarter apart, so that every occurrence lies whole in one of them. A window
retrieves a template if they agree in any of ``BANDS`` one-row bands. A template that a window holds to 80 % has a Jaccard similarity
of at least 0.29 with it, so all bands miss it with a probability under 0.0001 %. Templates are few; their bands travel with the tasks.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rungline.llm import common

#: Short forms and opening passages of well-known licenses.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied."),
    "mit-line": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:"),
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:"),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."),
}
WORDS, CONTAINMENT, BANDS = 5, 0.8, 40
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_TURNS = np.array([xxhash.xxh64_intdigest(b"turn%d" % i) | 1 for i in range(BANDS)], dtype=np.uint64)
_STEPS = np.array([xxhash.xxh64_intdigest(b"step%d" % i) | 1 for i in range(WORDS)], dtype=np.uint64)
_MOST = np.iinfo(np.uint64).max
#: Shingles whose bands are computed at once (about 5 MB), and words a worker remembers the hash of.
_CHUNK, _WORDS_HELD = 1 << 14, 400_000


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > _WORDS_HELD:
            self.clear()
        self[word] = code = xxhash.xxh64_intdigest(word.encode(), 11)
        return code


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _codes(words: list[str], hashes: _Hashes) -> np.ndarray:
    """Shingle hashes; fewer words than a shingle are one shingle, none have none."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(len(each) - WORDS + 1, 1)
    code = np.zeros(n, dtype=np.uint64)
    for k in range(min(WORDS, len(each))):
        code += each[k:n + k] * _STEPS[k]
    code ^= code >> np.uint64(32)
    code *= np.uint64(0xD6E8FEB86659FD93)
    return code ^ (code >> np.uint64(29))


def _shingles(words: list[str]) -> list[tuple[str, ...]]:
    return [tuple(words[i:i + WORDS]) for i in range(max(len(words) - WORDS + 1, 1))] if words else []


@dataclass
class _Class:
    """Templates of about one length, their bands, and the windows that look for them."""
    names: list[str]
    bands: np.ndarray  # a row per template
    step: int
    steps: int  # of a window


class Scanner:
    def __init__(self, templates: dict[str, str]):
        hashes = _Hashes()
        self.shingles = {k: _shingles(words_of(t)) for k, t in templates.items()}
        by_size: dict[int, list[str]] = {}
        for name, own in self.shingles.items():
            if own:
                by_size.setdefault(max(0, (len(own) - 1).bit_length()), []).append(name)
        self.classes = []
        for power, names in sorted(by_size.items()):
            step = max(1, (1 << power) // 4)
            codes = [_codes(words_of(templates[n]), hashes) for n in names]
            self.classes.append(_Class(names, np.stack([(c[:, None] * _TURNS).min(axis=0) for c in codes]), step, (1 << power) // step + 1))
        self.parts = {k: set(s) for k, s in self.shingles.items()}
        self.hashes = hashes

    def candidates(self, codes: np.ndarray) -> list[tuple[str, int, int]]:
        """``template, first shingle, end shingle`` of every window that shares a band with a template."""
        out = []
        for c in self.classes:
            length = c.step * c.steps
            for at in range(0, len(codes), _CHUNK):
                part = codes[at:at + _CHUNK + length]
                rows = -(-len(part) // c.step)
                turned = np.full((BANDS, rows * c.step), _MOST, dtype=np.uint64)
                np.multiply(_TURNS[:, None], part, out=turned[:, :len(part)])
                low = turned.reshape(BANDS, rows, c.step).min(axis=2)
                least = low.copy()
                for k in range(1, min(c.steps, rows)):
                    least[:, :-k] = np.minimum(least[:, :-k], low[:, k:])
                for name, bands in zip(c.names, c.bands):
                    for w in np.flatnonzero((least == bands[:, None]).any(axis=0)).tolist():
                        out.append((name, at + w * c.step, min(at + w * c.step + length, len(codes))))
        return out

    def verify(self, name: str, words: list[str], first: int, end: int) -> tuple[int, int, float] | None:
        """The stretch of shingles in ``first:end`` that holds the template best: its words and the share of the template's shingles."""
        part, own = self.parts[name], []
        for i in range(first, end):
            shingle = tuple(words[i:i + WORDS])
            if shingle in part:
                own.append((i, shingle))
        if len({s for _, s in own}) < CONTAINMENT * len(part):
            return None
        room = int(1.25 * len(self.shingles[name])) + 1
        best: tuple[int, int, float] | None = None
        for a in range(len(own)):
            seen: set = set()
            for i, shingle in own[a:]:
                if i - own[a][0] >= room:
                    break
                if shingle not in seen:
                    seen.add(shingle)
                    share = len(seen) / len(part)
                    if share >= CONTAINMENT and (best is None or share > best[2]):
                        best = (own[a][0], min(i + WORDS, len(words)), share)
        return best

    def scan(self, texts: list[str | None]) -> list[list[tuple[str, int, int, float]]]:
        """For each text its matches: template, first word, end word, share; of overlapping ones of a template the fullest, then the first."""
        listed = [words_of(t) for t in texts]
        codes = [_codes(w, self.hashes) for w in listed]
        starts = np.cumsum([0, *map(len, codes)])
        found: list[set] = [set() for _ in texts]
        if starts[-1]:
            for name, first, end in self.candidates(np.concatenate(codes)):
                d = int(np.searchsorted(starts, first, side="right")) - 1
                while d < len(texts) and starts[d] < end:  # a window may reach over several short texts
                    a, b = max(first - int(starts[d]), 0), min(end, int(starts[d + 1])) - int(starts[d])
                    if a < b and (hit := self.verify(name, listed[d], a, b)):
                        found[d].add((name, *hit))
                    d += 1
        return [_apart(f) for f in found]


def _apart(matches: set) -> list[tuple[str, int, int, float]]:
    kept: list = []
    for m in sorted(matches, key=lambda m: (m[0], -m[3], m[1], m[2])):
        if not any(k[0] == m[0] and k[1] < m[2] and m[1] < k[2] for k in kept):
            kept.append(m)
    return sorted(kept)


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, template, first_word, end_word, containment``: a row per match in ``docs (doc_id, text)``.

    Words are counted from 0, the end is exclusive. Null, blank and clean texts give no row; null ids keep theirs; repeated rows
    give their matches each. Empty templates match nothing.
    """
    common.text_batches(docs.sparkSession)
    own = TEMPLATES if templates is None else templates
    names = ["doc_id", "template", "first_word", "end_word", "containment"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(own)
        for batch in batches:
            rows = [(d, *m) for d, ms in zip(batch.column(0).to_pylist(), scanner.scan(batch.column(1).to_pylist())) for m in ms]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find, "doc_id long, template string, first_word long, end_word long, containment double")
