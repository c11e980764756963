"""Benchmark decontamination: SimHash over windows as long as the benchmark items.

Words are runs of letters, digits and non-ASCII bytes in lower case, so added
punctuation hides nothing. An item of m words is compared with every window of
m words that shares a five-word shingle with it; a document of fewer words is
one window, as it is. Windows get a SimHash of ``BITS`` bits of their weighted
shingles from running bit sums. ``BLOCKS`` blocks of 32 bits index the items of
that length so that every fingerprint within ``RADIUS`` bits is found: by the
pigeonhole principle some block then differs in at most ``RADIUS // BLOCKS``
bits, which 0.1 % of unrelated blocks do (0.8 % of fingerprints in one of
eight; 1.3 % where an even number of shingles leaves sums of 0). Candidates are verified by the exact weighted Jaccard similarity of
their shingles (counts as weights), 0.8 or more by default.

The radius follows from the similarity: of two windows with Jaccard similarity
0.8 and no shingle twice, each shares 8/9 of its shingles, the angle between
their counts is arccos(8/9) or 27.3 degrees, and a fingerprint bit differs with
probability 0.152, that is 39 of 256 bits with a standard deviation of 5.7. 63
bits are 4.3 deviations more; in 220,000 trials at the threshold with 5 to 120
shingles the greatest distance was 61. Where a shingle occurs twice the angle
can be wider, so windows and items with a repeated shingle skip the filter and
are verified. For another similarity the radius is computed alike.

The benchmark is a stated query set: it is taken in blocks of ``ITEM_BLOCK``
items, each shipped to the tasks; all documents are read against each block,
``BLOCKS_A_PASS`` of them in one pass of ``decontaminate``.

Defined cases: items or texts without words match nothing; an item of fewer
than five words is one shingle and matches its exact word sequence; a document
shorter than a shingle of the item matches nothing; repeated items match alike;
a NULL doc_id is reported as NULL; long texts are read whole; an empty
benchmark or table gives no matches. ``decontaminate`` keeps all columns,
whatever they are named.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.frames import ROW, documents, id_and_text, ship, staged
from tessera.llm.textnum import SMALL_CHUNK, U64, Chunk, chunks, grams, mix
from tessera.sources.tables import read_table

SHINGLE = 5
SIMILARITY = 0.8
BITS, BLOCKS = 256, 8
DEVIATIONS = 4.3  # beyond the mean distance at the similarity
ITEM_BLOCK, BLOCKS_A_PASS = 2000, 16
WINDOWS = 8000  # whose bit sums are held at a time
_MATCH = f"doc_id long, {ROW} long, item_id long, start_word long, n_words long, distance int, similarity double"

_SEPARATORS = np.ones(256, bool)
_SEPARATORS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_BITS = np.arange(64, dtype=U64)
_SALTS = mix(np.arange(1, BITS // 64 + 1, dtype=U64))


def radius(similarity: float = SIMILARITY) -> int:
    """Distance that fingerprints at the similarity exceed with a probability of about one in 100,000."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.floor(BITS * p + DEVIATIONS * math.sqrt(BITS * p * (1 - p)))


def words(texts: list[bytes]) -> Chunk:
    return Chunk(texts, lower=True, separators=_SEPARATORS)


def bit_signs(g: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the bits of each hash."""
    x = mix(g[:, None] ^ _SALTS)
    return (((x[:, :, None] >> _BITS) & U64(1)).astype(np.int16) * 2 - 1).reshape(len(g), BITS)


def fingerprint(sums: np.ndarray) -> np.ndarray:
    """SimHash of summed bit signs, one row per window, as blocks of 32 bits."""
    return np.packbits(sums > 0, axis=1).view(np.uint32)


class Items:
    """Benchmark items of one word count: shingles, fingerprints and the Hamming index."""

    def __init__(self, size: int, ids: list, hashes: list[np.ndarray], similarity: float = SIMILARITY):
        self.size, self.k = size, min(size, SHINGLE)
        self.ids, self.radius = ids, radius(similarity)
        self.shingles = [np.sort(grams(h, self.k)) for h in hashes]
        self.known, of = np.unique(np.concatenate(self.shingles), return_inverse=True)
        self.member = np.zeros((len(ids), len(self.known)), bool)
        self.member[np.repeat(np.arange(len(ids)), [len(s) for s in self.shingles]), of] = True
        self.prints = np.concatenate([fingerprint(bit_signs(s).sum(axis=0, dtype=np.int32, keepdims=True)) for s in self.shingles])
        self.repeats = np.array([bool((s[1:] == s[:-1]).any()) for s in self.shingles])

    def candidates(self, prints: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within the radius, and of those with a repeated shingle."""
        found = repeats[:, None] | self.repeats[None, :]
        for b in range(BLOCKS):
            found |= np.bitwise_count(prints[:, b, None] ^ self.prints[None, :, b]) <= self.radius // BLOCKS
        w, i = np.nonzero(found)
        d = np.bitwise_count(prints[w] ^ self.prints[i]).sum(axis=1, dtype=np.int64)
        near = (d <= self.radius) | repeats[w] | self.repeats[i]
        return w[near], i[near], d[near]


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the lesser over sum of the greater shingle counts."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    low = int(np.minimum(n[i], m[j]).sum())
    return low / (len(a) + len(b) - low)


def index_items(rows: list[tuple], similarity: float = SIMILARITY) -> list[Items]:
    """Items by word count, from (item_id, text) rows."""
    c = words([(t or "").encode() for _, t in rows])
    h = c.hashes()
    by_size: dict[int, list[int]] = {}
    for i, n in enumerate(c.counts):
        if n:
            by_size.setdefault(int(n), []).append(i)
    return [Items(n, [rows[i][0] for i in at], [h[c.first[i]:c.first[i + 1]] for i in at], similarity)
            for n, at in sorted(by_size.items())]


def closely_repeated(values: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Whether each value stands less than ``n`` places before, too."""
    order = np.lexsort((places, values))
    out = np.zeros(len(values), bool)
    out[order[1:]] = (values[order][1:] == values[order][:-1]) & (np.diff(places[order]) < n)
    return out


def find(texts: list[bytes], index: list[Items], similarity: float = SIMILARITY) -> list[tuple]:
    """(text, item_id, start word, words, distance, similarity) of the best window of each text and item."""
    c = words(texts)
    h, left, doc = c.hashes(), c.left(), c.doc_of_word()
    gram = {k: grams(h, k) for k in {x.k for x in index}}
    place = {}
    for k, g in gram.items():  # places of all shingles of items with this shingle length
        known = np.unique(np.concatenate([x.known for x in index if x.k == k]))
        at = np.searchsorted(known, g)
        at[at == len(known)] = 0
        place[k] = np.flatnonzero((known[at] == g) & (left[:len(g)] >= k))
    best: dict[tuple, tuple] = {}
    for x in index:
        g, hits = gram[x.k], place[x.k]
        at = np.searchsorted(x.known, g[hits])
        at[at == len(x.known)] = 0
        own = x.known[at] == g[hits]
        hits, at = hits[own], at[own]
        if not len(hits):
            continue
        n = x.size - x.k + 1  # shingles of a window
        starts = np.unique(hits[:, None] - np.arange(n)[None, :])
        starts = starts[starts >= 0]
        starts = starts[left[starts] >= x.size]
        short = np.unique(doc[hits])  # documents of fewer words than the item are one window
        short = short[(c.counts[short] < x.size) & (c.counts[short] - x.k + 1 >= similarity * n - 1e-9)]
        starts = np.concatenate([starts, c.first[short]])
        sizes = np.concatenate([np.full(len(starts) - len(short), n), c.counts[short] - x.k + 1])
        order = np.argsort(starts, kind="stable")
        starts, sizes = starts[order], sizes[order]
        if not len(starts):
            continue
        # running bit sums over the shingles that the windows use
        np.add.at(edge := np.zeros(len(g) + 2, np.int32), starts, 1)
        np.add.at(edge, starts + sizes, -1)
        need = np.cumsum(edge)[:len(g)] > 0
        where = np.append(np.cumsum(need) - need, need.sum())  # place among the needed shingles
        needed = np.flatnonzero(need)
        again = np.concatenate([[0], np.cumsum(closely_repeated(g[needed], needed, n))])
        for lo in range(0, len(starts), WINDOWS):
            some, size = starts[lo:lo + WINDOWS], sizes[lo:lo + WINDOWS]
            i, j = where[some[0]], where[(some + size).max() - 1] + 1
            sums = np.zeros((j - i + 1, BITS), np.int32)
            np.cumsum(bit_signs(g[needed[i:j]]), axis=0, out=sums[1:])
            first = where[some]
            w, item, dist = x.candidates(fingerprint(sums[first - i + size] - sums[first - i]),
                                         again[first + size] > again[first])
            for t in np.unique(item):
                mine = item == t
                s, m, d = some[w[mine]], size[w[mine]], dist[mine]
                of_item = np.sort(hits[x.member[t][at]])
                shared = np.searchsorted(of_item, s + m) - np.searchsorted(of_item, s)
                able = shared >= similarity * n - 1e-9  # places shared bound the sum of lesser counts from above
                for p, k, q in zip(s[able], m[able], d[able]):
                    sim = weighted_similarity(g[p:p + k], x.shingles[t])
                    if sim >= similarity:
                        key = (int(doc[p]), t, x.size)
                        value = (-sim, int(p - c.first[doc[p]]), int(k + x.k - 1), int(q))
                        if key not in best or value < best[key][0]:
                            best[key] = (value, x.ids[t])
    return [(d, item, v[1], v[2], v[3], -v[0]) for (d, _, _), (v, item) in sorted(best.items(), key=lambda e: e[0])]


def item_blocks(benchmark: DataFrame, similarity: float = SIMILARITY, block: int = ITEM_BLOCK):
    """The benchmark in blocks of about ``block`` items, each collected by itself."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    n = math.ceil(items.count() / block)
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).distinct().orderBy("item_id", "text")
        if index := index_items([tuple(r) for r in rows.collect()], similarity):
            yield benchmark.sparkSession.sparkContext.broadcast(index)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The best window of every document row and benchmark item that match."""
    rows = id_and_text(docs)

    def matcher(index):
        def run(batches):
            for b, texts in chunks(batches, limit=SMALL_CHUNK):
                found = find(texts, index.value, similarity)
                ids, keys = b.column("doc_id").to_pylist(), b.column(ROW).to_pylist()
                cols = list(zip(*[(ids[f[0]], keys[f[0]], *f[1:]) for f in found])) or [[]] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(cols, [pa.int64()] * 5 + [pa.int32(), pa.float64()])],
                    ["doc_id", ROW, "item_id", "start_word", "n_words", "distance", "similarity"])
        return run

    out = None
    for index in item_blocks(benchmark, similarity):
        part = rows.mapInArrow(matcher(index), _MATCH)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], _MATCH) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, that match no benchmark item."""
    ship(docs.sparkSession)

    def keeper(blocks):
        def run(batches):
            for b, texts in chunks(batches, limit=SMALL_CHUNK):
                hit = np.zeros(len(texts), bool)
                for index in blocks:
                    left = np.flatnonzero(~hit)
                    hit[[left[f[0]] for f in find([texts[i] for i in left], index.value, similarity)]] = True
                yield b.filter(pa.array(~hit))
        return run

    blocks = list(item_blocks(benchmark, similarity))
    for at in range(0, len(blocks), BLOCKS_A_PASS):
        docs = docs.mapInArrow(keeper(blocks[at:at + BLOCKS_A_PASS]), docs.schema)
        if at + BLOCKS_A_PASS < len(blocks):
            docs = staged(docs, "decontaminated")
    return docs


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages found in documents."""
    return contaminated(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark")).drop(ROW)
