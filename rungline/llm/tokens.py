"""Token ids by the tokenizers library, each distinct piece of text encoded once per worker."""
from __future__ import annotations

import os
import re
from array import array

import regex

#: Fixed values of the byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}
#: The splitting patterns of the two vocabularies, as their files state them.
_BYTE_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_LOWER_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Texts with other characters, or with what may be a special token, go through the library as a whole: there
#: its Unicode tables, not Python's, decide on letters, spaces, lower case and normal form. NUL marks keys of the look-up.
_OTHER = re.compile("[^\\x01-\\x1b\\x20-\\x84\\x86-įı-ɏ‐-‧]|<\\|")


def _is_other(text: str) -> bool:
    if text.isascii():  # the same rule, without a pattern
        return "<|" in text or "\0" in text or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text
    return _OTHER.search(text) is not None


#: Entries after which the memory of a worker starts anew (about 200 MB).
CACHE = 1_000_000


class Encoder:
    """``encode`` gives each text's ids as little-endian unsigned 32-bit integers.

    A byte-level BPE splits a text by its pattern and encodes each part alone, so the ids of a text
    are those of its parts in order; what a blank parts is looked up where it was met before.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.lower = self.whole.normalizer is not None
        #: By text between blanks. With a vocabulary that keeps blanks the key "x" stands for " x", and "\0x" for "x".
        self.known = _Known(self)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > CACHE:
            self.known.clear()
        texts = [t or "" for t in texts]
        out: list[bytes | None] = [None] * len(texts)
        parts: list[list[str]] = []
        for i, text in enumerate(texts):
            if _is_other(text) or not self.lower and "  " in text:
                out[i] = array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
                parts.append([])
            elif self.lower:
                parts.append(text.lower().split())
            else:
                first, *rest = text.split(" ")
                parts.append(["\0" + first, *rest] if first else rest)
        get = self.known.__getitem__
        return [b"".join(map(get, p)) if done is None else done for p, done in zip(parts, out)]

    def learn(self, chunk: str) -> bytes:
        if chunk.isalpha():
            ids = self._part(chunk if self.lower else " " + chunk)
        else:
            ids = b""
            if self.lower:
                keys = words = _LOWER_WORDS.findall(chunk)
            else:
                words = _BYTE_WORDS.findall(chunk[1:] if chunk[:1] == "\0" else " " + chunk)
                keys = [w[1:] if w[0] == " " and len(w) > 1 else "\0" + w for w in words]
            for word, key in zip(words, keys):
                found = self.known.get(key)
                if found is None:
                    found = self._part(word)
                    self.known[key] = found
                ids += found
        self.known[chunk] = ids
        return ids

    def _part(self, word: str) -> bytes:
        letters = word if word.isalpha() and word.isascii() else word.encode().decode("latin-1").translate(_ALPHABET)
        return array("I", [t.id for t in self.whole.model.tokenize(letters)]).tobytes()


class _Known(dict):
    """Encodes what it does not hold yet."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        return self.encoder.learn(chunk)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
