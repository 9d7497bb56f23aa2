"""Token ids of whole texts, exactly as the tokenizers library gives them, each distinct piece of text encoded once.

A text is cut at places where the tokenizer's own pre-tokenization always cuts, so that the ids of the pieces, one after
another, are the ids of the text. Two ways to cut:

* ``words``, for tokenizers that drop white space and case: around white space, which is dropped;
* ``bytes``, for byte-level ones that join a space to the word behind it: before a run of white space, before its last
  character if a word follows, and behind it unless that last character is a space.

Both also cut between ASCII letters, digits and signs, but not beside an apostrophe or a character beyond ASCII. They only
look at ASCII white space. A text with other white space, or with the string of a special token, is encoded whole.

A piece of Latin letters, digits and signs needs none of the library's alignment of ids with characters: the pre-tokenizer's
pattern cuts it and the library's model gives the ids of each part. Other pieces go through the library's whole pipeline.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from tidemark.llm.text import WHITE, buffers

# Text encoded at once, and distinct pieces remembered by a Python worker before it forgets all but the last text's.
BATCH_BYTES = 4 << 20
REMEMBERED = 300_000

_OTHER_SPACE = "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Characters whose normal form, small letter and class are simple: printable, below U+0250, without U+0130.
_PLAIN = re.compile("[\t-\r\x20-\x7e\xa1-\u012f\u0131-\u024f]*")
# The patterns of the two pre-tokenizers.
_PATTERNS = {
    "words": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "bytes": r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
}


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself if printable, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}



@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file's content and the way to cut texts for it."""

    content: str
    cut: str

    @staticmethod
    def read(path: str, cut: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            return Vocabulary(file.read(), cut)


# Classes of bytes: 0 white space, 1 letters, 2 digits, 3 signs, 4 what no cut may touch.
_CLASS = np.full(256, 3, dtype=np.uint8)
_CLASS[WHITE] = 0
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_CLASS[0x30:0x3A] = 2
_CLASS[[0x27, *range(0x80, 0x100)]] = 4
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[0x41:0x5B] += 32


# Bytes that other white space and special tokens begin with.
_ODD = np.zeros(256, dtype=bool)
_ODD[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0x3C]] = True


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """The value before (1) or behind (-1) each place; zero beyond the ends."""
    out = np.zeros_like(x)
    if by > 0:
        out[1:] = x[:-1]
    else:
        out[:-1] = x[1:]
    return out


def tiles(raw: np.ndarray, offsets: np.ndarray, cut: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text that pieces tile, the pieces' bounds in it, and each row's first piece."""
    kind = _CLASS[raw]
    first = np.zeros(len(raw), dtype=bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    white, before = kind == 0, _shifted(kind, 1)
    turn = ((kind != before) | ((kind == 2) if cut == "words" else False)) & (kind < 4) & (before < 4) & ~white & (before > 0)
    after_white = ~white & (before == 0)
    if cut == "words":
        start = (first | after_white | turn) & ~white
        kept = ~white
        start, raw = start[kept], _SMALL[raw[kept]]
        offsets = np.concatenate(([0], np.cumsum(kept)))[offsets]
    else:
        last = white & _shifted(~white & ~first, -1)
        start = first | (white & (before != 0)) | last | turn | (after_white & (_shifted(raw, 1) != 0x20))
    bounds = np.append(np.flatnonzero(start), len(raw)).astype(np.int64)
    return raw, bounds, np.searchsorted(bounds[:-1], offsets)


def _suspects(raw: np.ndarray, offsets: np.ndarray) -> list[int]:
    """The rows that may have other white space or a special token's string, by their bytes."""
    odd = np.flatnonzero(_ODD[raw])
    if not len(odd):
        return []
    after = raw[np.minimum(odd + 1, len(raw) - 1)]
    # U+0085 and U+00A0 are the only white space behind 0xC2, and special tokens begin with "<|".
    odd = odd[((raw[odd] != 0xC2) | (after == 0x85) | (after == 0xA0)) & ((raw[odd] != 0x3C) | (after == 0x7C))]
    return np.unique(np.searchsorted(offsets, odd, side="right") - 1).tolist()


class Encoder:
    """One tokenizer in a Python worker, with the pieces that it has seen."""

    def __init__(self, content: str, cut: str):
        from tokenizers import Tokenizer

        self.cut = cut
        self.tokenizer = Tokenizer.from_str(content)
        special = [t["content"] for t in json.loads(content).get("added_tokens", [])]
        if not all(t.startswith("<|") for t in special):
            raise ValueError("a special token that doesn't begin with <|")
        whole = "|".join(re.escape(s) for s in special if s)
        self.whole = re.compile(f"{_OTHER_SPACE}|{whole}" if whole else _OTHER_SPACE)
        self.pattern = regex.compile(_PATTERNS[self.cut])
        self.letters = _byte_letters()
        self.model = self.tokenizer.model
        self.known: dict[bytes, int] = {}
        self.parts: dict[str, list[int]] = {}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(1, dtype=np.int64)

    def forget(self, but: list[bytes] = ()) -> None:
        """Forgets all pieces but those, which are likely to come again; at the end of a task, all."""
        kept = [p for p in but if p in self.known]
        number = np.array([self.known[p] for p in kept], dtype=np.int64)
        sizes = np.diff(self.starts)[number]
        heads = np.cumsum(sizes) - sizes
        self.ids = self.ids[np.arange(sizes.sum()) + np.repeat(self.starts[number] - heads, sizes)]
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.known, self.parts = {p: i for i, p in enumerate(kept)}, {}

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        sizes = np.fromiter((len(x) for x in found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(sizes.sum()))
        return flat, sizes

    def _ids(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece."""
        tokenize, space = self.model.tokenize, self.letters[0x20]
        out: list[list[int] | None] = [
            # One run of ASCII letters, with or without a space before it: the model's input as it stands.
            [t.id for t in tokenize(p.decode())]
            if p.isascii() and p.isalpha()
            else [t.id for t in tokenize(space + p[1:].decode())]
            if p[:1] == b" " and p.isascii() and p[1:].isalpha()
            else self._parts(p.decode())
            for p in pieces
        ]
        rest = [p.decode() for p, ids in zip(pieces, out) if ids is None]
        if not rest:
            return out
        encoded = iter(self.tokenizer.encode_batch(rest, add_special_tokens=False))
        return [next(encoded).ids if ids is None else ids for ids in out]

    def _parts(self, text: str) -> list[int] | None:
        """The ids of a plain piece, part by part; None if it needs the whole pipeline."""
        if not _PLAIN.fullmatch(text):
            return None
        out: list[int] = []
        for part in self.pattern.findall(text.lower() if self.cut == "words" else text):
            ids = self.parts.get(part)
            if ids is None:
                shown = part.encode().decode("latin-1").translate(self.letters)
                ids = self.parts[part] = [t.id for t in self.model.tokenize(shown)]
            out += ids
        return out

    def _look_up(self, pieces: list[bytes]) -> np.ndarray:
        """The number of each piece in the store."""
        if len(self.known) > REMEMBERED:
            self.forget(pieces)
        known = self.known
        new = [p for p in pieces if p not in known]
        if new:
            found = self._ids(new)
            sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            flat = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(sizes.sum()))
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.ids = np.concatenate((self.ids, flat))
            self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(sizes)))
        return np.fromiter(map(known.__getitem__, pieces), dtype=np.int64, count=len(pieces))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows in one array, and the rows' offsets in it. A null has no ids."""
        bytes_ = buffers(texts)
        rows = len(texts)
        raw, bounds, first = tiles(*bytes_, self.cut)
        kind, width = (pa.binary(), np.int32) if len(raw) < 2**31 else (pa.large_binary(), np.int64)
        parts = [None, pa.py_buffer(bounds.astype(width)), pa.py_buffer(np.ascontiguousarray(raw))]
        found = pa.Array.from_buffers(kind, len(bounds) - 1, parts)
        found = found.dictionary_encode()
        number = self._look_up(found.dictionary.to_pylist())[found.indices.to_numpy(zero_copy_only=False)]
        sizes = np.diff(self.starts)[number]
        heads = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum(), dtype=np.int32)
        at += np.repeat((self.starts[number] - heads).astype(np.int32), sizes)
        ids = self.ids[at]
        ends = np.concatenate(([0], np.cumsum(sizes)))[first]
        odd = [i for i in _suspects(*bytes_) if (t := texts[i].as_py()) and self.whole.search(t)]
        if not odd:
            return ids, ends
        flat, lengths = self._encode([texts[i].as_py() for i in odd])
        parts, place = [ids[ends[i] : ends[i + 1]] for i in range(rows)], np.concatenate(([0], np.cumsum(lengths)))
        for k, i in enumerate(odd):
            parts[i] = flat[place[k] : place[k + 1]]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def encoder(content: str, cut: str) -> Encoder:
    """The worker's encoder for this vocabulary; it stays with the library's module, as functions are sent anew with each task."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_kept_encoders", {})
    key = (hash(content), cut)
    if key not in kept:
        kept.clear()
        kept[key] = Encoder(content, cut)
    return kept[key]


def with_end(ids: np.ndarray, ends: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same rows with one more id behind each."""
    rows = len(ends) - 1
    out = np.full(len(ids) + rows, end, dtype=np.uint32)
    place = np.arange(len(ids)) + np.repeat(np.arange(rows), np.diff(ends))
    out[place] = ids
    return out, ends + np.arange(rows + 1)
