"""Texts as numpy arrays: words, their places and 64-bit hashes, many documents at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLAB = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Slab:
    """doc, start, end: of each word; last: documents whose text ends in this slab. Words lie in buf in document order."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: int
    last: int
    whole: bool

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.start, self.end)


def slabs(texts: list[bytes], lower: bool = True, size: int = SLAB) -> Iterator[Slab]:
    """About size bytes each. Only a text longer than that is in several slabs, cut between words where it can be;
    whole is false for all of its slabs but the last."""
    held: list[bytes] = []
    first = total = 0
    for k, text in enumerate(texts):
        at = 0
        if len(text) > size and held:
            yield _slab(held, first, True, lower)
            held, total = [], 0
        while len(text) - at > size and (end := _break(text, at + size)) < len(text):
            yield _slab([text[at:end]], k, False, lower)
            at = end
        if not held:
            first = k
        held.append(text[at:] if at else text)
        total += len(held[-1]) + 1
        if total >= size:
            yield _slab(held, first, True, lower)
            held, total = [], 0
    if held:
        yield _slab(held, first, True, lower)


def _break(text: bytes, at: int) -> int:
    while at < len(text) and not _SPACES[text[at]]:
        at += 1
    return min(at + 1, len(text))


def _slab(texts: list[bytes], first: int, whole: bool, lower: bool) -> Slab:
    joined = b"\n".join(texts)
    buf = np.frombuffer(joined.lower() if lower else joined, np.uint8)
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~_SPACES[buf]
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    doc = np.searchsorted(begins, start, side="right") - 1 + first
    return Slab(buf, start, end, doc, first, first + len(texts) - 1, whole)


def cuts(text: bytes, size: int = SLAB) -> Iterator[tuple[int, Slab]]:
    """A text's slabs of about size bytes, cut between words, and where each begins."""
    at = 0
    while at < len(text):
        end = _break(text, at + size) if len(text) - at > size else len(text)
        yield at, _slab([text[at:end]], 0, True, False)
        at = end


def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """texts: large binary, no nulls. Their words one after another, equal numbers for equal ones, counted from 0 as they come up; how many words
    each text has; the words by number. No word is a Python object."""
    lists = pc.ascii_split_whitespace(texts.view(pa.large_string()))
    ends = lists.offsets.to_numpy()
    words = lists.flatten().dictionary_encode()
    which, kinds, ends = words.indices.to_numpy(), words.dictionary.view(pa.large_binary()), ends - ends[0]
    full = pc.greater(pc.binary_length(kinds), 0).to_numpy(zero_copy_only=False)
    if not full.all():  # space at an end of a text makes an empty word
        keep = full[which]
        ends = np.append(0, np.cumsum(keep))[ends]
        which, kinds = (np.cumsum(full) - 1)[which[keep]], kinds.filter(pa.array(full))
    return which, np.diff(ends), kinds


def words_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte behind the last, and hash of each word."""
    out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))]
    out += [(s.start + at, s.end + at, s.hashes()) for at, s in cuts(text)]
    return tuple(map(np.concatenate, zip(*out)))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    out = []
    for b in (base, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, out=p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(18, int(n).bit_length()))


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """p with p[k] = the sum of (buf[j] + 1) * base ** j for j < k, modulo 2 ** 64."""
    p = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(len(buf) + 1)[0][: len(buf)], out=p[1:])
    return p


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """A hash of buf[start:end], equal wherever the bytes are."""
    p = prefix_sums(buf) if sums is None else sums
    return scramble((p[end] - p[start]) * powers(len(buf) + 1)[1][start] + (end - start).astype(np.uint64))


def gram_hashes(buf: np.ndarray, gram: int, sums: np.ndarray) -> np.ndarray:
    """span_hashes of all spans of so many bytes or numbers."""
    return scramble((sums[gram:] - sums[: len(sums) - gram]) * powers(len(buf) + 1)[1][: len(buf) - gram + 1] + np.uint64(gram))


def scramble(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
