"""Repeated 13-word passages by recompression.

A text's words are symbols. The first round names runs of equal symbols, the
next ones name pairs: a hash bit puts each symbol on the left or right side,
and a left symbol before a right one becomes their pair's symbol. Names are
hashes of what they stand for, so every task names alike and equal passages get
equal symbols but at their borders. Each symbol carries the span of words that
decided it: within any equal span the same symbol arises.

A window of 13 words takes as its anchor the longest symbol decided within it
(ties: by name); a window without one is its own anchor. Windows around one
anchor are a zone (see ``zones``): shared symbols reveal zones that occur in
several documents, equal fragments verify them, and where fragments differ the
windows themselves, named by their 13 words, are compared in one more round.

Defined cases: a NULL or empty text has no words; texts of fewer than 13 words
lose nothing; a NULL doc_id neither removes nor loses words; rows with one
doc_id are one document to others and lose nothing to each other; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import zones as Z
from tessera.llm.exchange import buckets_for
from tessera.llm.frames import documents, staged
from tessera.llm.textnum import U64, Chunk, chunks, covered, grams, mix, runs

WINDOW = 13
PAIR_ROUNDS = 3
LONGEST = 8  # words of a symbol: longer ones would leave few windows that hold their span
_FAR = np.int64(1 << 40)


class Symbols:
    """Symbols of some texts: name, words [beg, end), deciding span [lo, hi) and text."""

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        at = np.arange(len(words), dtype=np.int64)
        self.name, self.doc = words, doc
        self.beg, self.end, self.lo, self.hi = at, at + 1, at, at + 1

    def _keep(self, first: np.ndarray, last: np.ndarray, name: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        self.name, self.doc, self.beg, self.end = name, self.doc[first], self.beg[first], self.end[last]
        self.lo, self.hi = lo, hi

    def _beside(self) -> tuple[np.ndarray, ...]:
        """Deciding spans of the symbols before and after each one; beyond a text's border nothing is certain."""
        edge = self.doc[1:] != self.doc[:-1]
        n = len(self.name)
        lo0, hi0, lo1, hi1 = np.full(n, -_FAR), np.full(n, _FAR), np.full(n, -_FAR), np.full(n, _FAR)
        lo0[1:], hi0[1:] = np.where(edge, -_FAR, self.lo[:-1]), np.where(edge, _FAR, self.hi[:-1])
        lo1[:-1], hi1[:-1] = np.where(edge, -_FAR, self.lo[1:]), np.where(edge, _FAR, self.hi[1:])
        return lo0, hi0, lo1, hi1

    def name_runs(self, longest: int) -> None:
        lo0, hi0, lo1, hi1 = self._beside()
        new = np.ones(len(self.name), bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])
        head = np.flatnonzero(new)
        tail = np.concatenate([head[1:] - 1, [len(new) - 1]])
        long = np.repeat(self.end[tail] - self.beg[head] > longest, tail - head + 1)  # stays as it is, and decides nothing
        first = np.flatnonzero(new | long)
        last = np.concatenate([first[1:] - 1, [len(new) - 1]])
        times = (last - first + 1).astype(U64)
        name = np.where(times > U64(1), mix(self.name[first] * U64(3) + times), self.name[first])
        lo = np.minimum.reduce([self.lo[first], self.lo[last], lo0[first], lo1[last]])
        hi = np.maximum.reduce([self.hi[first], self.hi[last], hi0[first], hi1[last]])
        self._keep(first, last, name, np.where(long[first], -_FAR, lo), np.where(long[first], _FAR, hi))

    def name_pairs(self, number: int, longest: int) -> None:
        lo0, hi0, lo1, hi1 = self._beside()
        right = (mix(self.name + U64(0x51ED2701 * (number + 1))) >> U64(63)) == U64(1)
        pair = np.zeros(len(self.name), bool)  # at the left symbol
        pair[:-1] = ~right[:-1] & right[1:] & (self.doc[1:] == self.doc[:-1]) & (self.end[1:] - self.beg[:-1] <= longest)
        second = np.zeros(len(pair), bool)
        second[1:] = pair[:-1]
        first = np.flatnonzero(~second)
        last = first + pair[first]
        name = np.where(pair[first], mix(self.name[first] * U64(5) + self.name[last] * U64(7) + U64(number)),
                        self.name[first])
        # a pair is decided by its two symbols; alone, a left one by the next symbol, a right one by the one before
        other_lo = np.where(pair[first], self.lo[last], np.where(right[first], lo0[first], lo1[first]))
        other_hi = np.where(pair[first], self.hi[last], np.where(right[first], hi0[first], hi1[first]))
        self._keep(first, last, name, np.minimum(self.lo[first], other_lo), np.maximum(self.hi[first], other_hi))


def recompress(words: np.ndarray, doc: np.ndarray, rounds: int = PAIR_ROUNDS, longest: int = LONGEST) -> Symbols:
    s = Symbols(words, doc)
    if len(words):
        s.name_runs(longest)
        for i in range(rounds):
            s.name_pairs(i, longest)
    return s


def window_zones(texts: list[bytes], width: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Zones (keys, fragments, text, start word, windows) of the windows of some texts."""
    c = Chunk(texts)
    h, doc = c.hashes(), c.doc_of_word()
    n = len(h)
    none = np.zeros(0, np.int64)
    if n < width:
        return none.astype(U64), none.astype(U64), none, none, none
    s = recompress(h, doc)
    span = s.hi - s.lo
    sure = np.flatnonzero((span <= width) & (s.lo >= 0))
    # an anchor's rank: its length, then its name; its place breaks ties between equal names
    rank = ((s.end - s.beg).astype(U64)[sure] << U64(56)) | (s.name[sure] >> U64(8))
    lo, hi = s.lo[sure], s.hi[sure]
    best, anchor = np.zeros(n, U64), np.full(n, -1)
    for t in range(width):
        w = lo - t
        fits = (w >= 0) & (w + width >= hi)
        w, r, a = w[fits], rank[fits], sure[fits]
        order = np.argsort(r, kind="stable")
        w, r, a = w[order], r[order], a[order]
        np.maximum.at(best, w, r)
        top = best[w] == r
        changed = top & ((anchor[w] < 0) | (s_rank(s, anchor[w]) != r) | (a < anchor[w]))
        anchor[w[changed]] = a[changed]
    windows = np.flatnonzero(c.left() >= width)
    anchor = anchor[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (anchor[1:] < 0) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(new)
    start, length = windows[first], np.diff(np.concatenate([first, [len(windows)]]))
    a = anchor[first]
    place = _prefix(h)
    own = a < 0
    lo, hi = np.where(own, start, s.lo[a]), np.where(own, start + width, s.hi[a])
    keys = mix(_span(place, lo, hi) * U64(3) + np.where(own, U64(1), s.name[a]))
    fragments = mix(_span(place, start, start + length - 1 + width) + (lo - start + 1).astype(U64) * U64(0x9E3779B97F4A7C15))
    return keys, fragments, doc[start], start - c.first[doc[start]], length


def s_rank(s: Symbols, i: np.ndarray) -> np.ndarray:
    return ((s.end[i] - s.beg[i]).astype(U64) << U64(56)) | (s.name[i] >> U64(8))


def _prefix(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    q, inv = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
    power = np.cumprod(np.concatenate([[U64(1)], np.full(len(h), U64(q))]), dtype=U64)
    back = np.cumprod(np.concatenate([[U64(1)], np.full(len(h), U64(inv))]), dtype=U64)
    return np.concatenate([np.zeros(1, U64), np.cumsum(h * power[:len(h)], dtype=U64)]), back


def _span(place: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Hash of the words [i, j)."""
    total, back = place
    return mix((total[j] - total[i]) * back[i] + (j - i).astype(U64))


def compared_windows(docs: DataFrame, zones: DataFrame, width: int = WINDOW) -> DataFrame:
    """The windows of the zones asked for, named by their words: those with a smaller document's name repeat."""
    n = buckets_for(docs)

    def windows(batches):
        for b, texts in chunks(batches):
            c = Chunk(texts)
            g = grams(c.hashes(), width)
            of, at = [], []
            for i in range(len(texts)):
                s, m, _ = Z.asked_zones(b, i)
                w = np.repeat(s - np.cumsum(m) + m, m) + np.arange(m.sum())
                of.append(np.full(len(w), i))
                at.append(w)
            of, at = np.concatenate(of), np.concatenate(at)
            ids, tags = b.column("doc_id").to_numpy(), b.column("tag").to_numpy().astype(np.uint16)
            z = {"keys": g[c.first[of] + at], "fragments": np.zeros(len(of), U64), "docs": ids[of], "tags": tags[of],
                 "starts": at.astype(np.uint32), "lengths": np.ones(len(of), np.uint32)}
            repeats, firsts = Z.settle(z, places=False)
            yield from Z.pack(repeats, 0, Z.doc_key(repeats), n)
            yield from Z.pack(firsts, 1, firsts["keys"], n)

    def meet(table):
        repeats, _ = Z.settle(Z.unpack(table, 1), places=False)
        repeats = Z.join([repeats, Z.unpack(table, 0)])
        return pa.Table.from_batches(list(Z.pack(repeats, 0, Z.doc_key(repeats), n)),
                                     schema=pa.schema([("bucket", pa.int32()), ("state", pa.int32())]
                                                      + [(c, pa.binary()) for c in Z.COLUMNS]))

    return Z.with_zones(docs, Z.by_document(zones, 2), "inner").mapInArrow(windows, Z.PACKED) \
        .groupBy("bucket").applyInArrow(meet, Z.PACKED)


def cut_repeats(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, _row, n_words, n_removed, the removed word ranges and the kept words as one text."""
    zones = Z.repeats_and_asked(docs, lambda texts: window_zones(texts, width), places=False)
    repeats = zones.where("state = 0").unionByName(staged(compared_windows(docs, zones, width), "windows"))

    def cut(batches):
        for b, texts in chunks(batches):
            c = Chunk(texts)
            n_removed, removed, kept = [], [], []
            for i, t in enumerate(texts):
                s, m, _ = Z.asked_zones(b, i)
                n = int(c.counts[i])
                gone = covered(n, s, m + width - 1)
                r0, r1 = runs(gone)
                word = np.flatnonzero(~gone) + c.first[i]
                a, z, at = c.starts[word], c.ends[word], c.at[i]
                n_removed.append(int(gone.sum()))
                removed.append([{"start": int(x), "end": int(y)} for x, y in zip(r0, r1)])
                kept.append(b" ".join([t[x - at:y - at] for x, y in zip(a.tolist(), z.tolist())]).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("_row"), pa.array(c.counts.astype(np.int64)),
                 pa.array(n_removed, pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.string())], ["doc_id", "_row", "n_words", "n_removed", "removed", "text"])

    return Z.with_zones(docs, Z.by_document(repeats, 0), "left").mapInArrow(
        cut, "doc_id long, _row long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, text string")


def op4_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, removed words and the SHA-256 of the kept words of every document."""
    return cut_repeats(documents(spark, sf_dir)) \
        .select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
