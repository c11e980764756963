"""Whole texts as numpy arrays: words, word hashes, n-gram hashes.

Tasks read Arrow batches, cut them into chunks of bounded bytes (a longer text
is a chunk of its own, never a prefix) and work on the chunk's bytes at once,
without a Python loop over words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 3_000_000
SMALL_CHUNK = 1_000_000  # for work that keeps nothing between chunks: a third of the arrays at a time
U64 = np.uint64
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_P = U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_P_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of the splitmix64 generator: spreads every bit of a 64-bit value over all bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= _M1
    x ^= x >> U64(27)
    x *= _M2
    x ^= x >> U64(31)
    return x


BYTE_CODE = mix((np.arange(256, dtype=U64) + U64(1)) * _P)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, SMALL_CHUNK + 65536)
        for name, base in (("p", _P), ("i", _P_INV)):
            a = np.full(size, base, U64)
            a[0] = 1
            _powers[name] = np.cumprod(a, dtype=U64)
    return _powers["p"][:n], _powers["i"]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut batches into runs of rows with at most ``limit`` text bytes (one row at least); NULL text -> b''."""
    try:
        for b in batches:
            column = b.column(text).cast(pa.binary())
            at, size, texts = 0, 0, []
            for i in range(len(column)):
                t = column[i].as_py() or b""
                if texts and size + len(t) > limit:
                    yield b.slice(at, i - at), texts
                    at, size, texts = i, 0, []
                texts.append(t)
                size += len(t)
            if texts:
                yield b.slice(at), texts
            del b, column, texts
    finally:
        release()


def release() -> None:
    """Give back what a task has used: workers live on, and their memory counts beside the executor's heap."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no glibc
        pass


class Chunk:
    """The words of some texts. ``starts``/``ends``: byte places of words; ``first``: index of each text's first word."""

    def __init__(self, texts: list[bytes], lower: bool = False, separators: np.ndarray = SPACE):
        self.n = len(texts)
        sizes = np.fromiter(map(len, texts), np.int64, self.n)
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            self.data = LOWER[self.data]
        self.at = np.zeros(self.n + 1, np.int64)  # byte place of each text
        np.cumsum(sizes + 1, out=self.at[1:])
        inside = ~separators[self.data]
        inside[self.at[1:] - 1] = False
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate([[0], edge])
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.at)
        self.counts = np.diff(self.first)

    def hashes(self, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of each byte span (all words when none are given); equal bytes give equal hashes."""
        starts = self.starts if starts is None else starts
        ends = self.ends if ends is None else ends
        if not hasattr(self, "_sum"):
            p, _ = _powers_up_to(len(self.data))
            self._sum = np.zeros(len(self.data) + 1, U64)
            np.cumsum(BYTE_CODE[self.data] * p, out=self._sum[1:])
        _, inv = _powers_up_to(len(self.data))
        h = (self._sum[ends] - self._sum[starts]) * inv[starts]
        return mix(h + (ends - starts).astype(U64))

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts)

    def left(self) -> np.ndarray:
        """For each word, the number of words from it to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k values from each position on; the last k-1 positions are cut off."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out, q = np.zeros(n, U64), U64(1)
    for j in range(k):
        out += h[j:j + n] * q
        q = U64((int(q) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF)
    return mix(out + U64(k))


def shingles(c: Chunk, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text index) of all k-word shingles; a text with 1 to k-1 words gives its whole sequence as one."""
    g = grams(h, k)
    whole = np.flatnonzero(c.left()[:len(g)] >= k)
    keys, docs = g[whole], c.doc_of_word()[whole]
    extra, of = [], []
    for i in np.flatnonzero((c.counts > 0) & (c.counts < k)):
        seq = h[c.first[i]:c.first[i + 1]]
        extra.append(grams(seq, len(seq))[0])
        of.append(i)
    if extra:
        keys, docs = np.concatenate([keys, np.array(extra, U64)]), np.concatenate([docs, of])
        order = np.argsort(docs, kind="stable")
        keys, docs = keys[order], docs[order]
    return keys, docs


def distinct_per_doc(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (doc, key) pairs."""
    order = np.lexsort((keys, docs))
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    return keys[new], docs[new]


def covered(n: int, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Mask of the n positions that lie in some [start, start + length)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + length, n), -1)
    return np.cumsum(d)[:n] > 0


def runs_of(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Neighbours [i, j) that have at most ``limit`` together (one at least)."""
    end, i = np.cumsum(sizes), 0
    while i < len(end):
        j = max(i + 1, int(np.searchsorted(end, limit + (end[i - 1] if i else 0), side="right")))
        yield i, j
        i = j


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    e = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return e[0::2], e[1::2]
