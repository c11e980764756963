"""Ranked lexical search by exact inner products over sparse ball trees.

A document is the sparse vector of its terms' integer weights
``w * ((1000000000 * tf) div (1000 * tf + 8 * m))``, an item is the 0/1 vector
of its distinct terms, and the score is their inner product. Only terms of the
items in hand are kept. A task cuts its documents into blocks and grows a ball
tree over each: a set is split at the median of the projection on the line
between two far documents, down to leaves of ``LEAF`` documents.

A node keeps its centroid c, the Euclidean radius r of its documents around it
and, per term, the radius upwards: the largest excess e of a coordinate over
the centroid's. So for an item of k terms the score of every document below is
at most ``sum(c) + sqrt(k) * r`` and at most ``sum(c + e)`` over the item's
terms; the lesser counts. (Items have few of all terms, so r, taken over all
terms, is the lesser bound only among near copies; the excesses leave out the
rest.) The centroid is rounded to integers and the excesses are taken over the
rounded one, so the second bound is exact; r and the square root are computed
in doubles and rounded up by more than their error. The tree is searched best
bound first; a subtree is left out when its bound is below the tenth best score
so far (or equals it and no doc_id in it is smaller). Leaves are scored in
64-bit integers.

Counts over all documents (N, L, df) are summed in Spark; weights and item
terms are broadcast, for ``ITEM_BLOCK`` items (or ``BLOCK_BYTES`` of item text)
at a time. The tenth best scores of at most ``SAMPLE`` documents are a floor
for all tasks: it leaves out work, never a result. A task returns at most ten
documents an item, and a window over the items keeps the best.

Defined cases: a NULL or empty text has no terms and is not counted; rows are
documents, so a repeated row is ranked beside its copy; a NULL doc_id follows
the others among equal scores; benchmark rows with one item_id are one item of
all their terms; an item without terms, or with none in any document, has no
rows; long texts are read whole; empty tables give an empty result; other
columns are ignored. Terms are known by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.frames import documents, id_and_text, ship, staged
from tessera.llm.textnum import SMALL_CHUNK, U64, Chunk, chunks, release
from tessera.sources.tables import read_table

TOP = 10
LEAF, BLOCK, BLOCK_ENTRIES = 32, 4096, 1_000_000  # documents a leaf; documents and their terms a tree
ITEM_BLOCK, BLOCK_BYTES = 500, 8 << 20
SAMPLE = 4096
NO_ID = (1 << 63) - 1  # stands for NULL in the order of ids
_VECTOR = "doc_id long, n long, terms binary, tfs binary"
_FOUND = "item int, doc_id long, score long"

_SEPARATORS = np.ones(256, bool)
_SEPARATORS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def terms_of(texts: list[bytes]) -> Chunk:
    """Maximal runs of digits, letters and non-ASCII bytes, ASCII letters in lower case."""
    return Chunk(texts, lower=True, separators=_SEPARATORS)


class Vocabulary:
    """Sorted hashes of the items' terms, with a first look that most other words fail."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.hashes & U64(0xFFFF)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``h`` that hold a term, and the terms' numbers."""
        at = np.flatnonzero(self.seen[(h & U64(0xFFFF)).astype(np.int64)])
        term = np.searchsorted(self.hashes, h[at])
        term[term == len(self.hashes)] = 0
        known = self.hashes[term] == h[at] if len(self.hashes) else np.zeros(len(at), bool)
        return at[known], term[known]


def vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, number of terms, and the vocabulary's terms in it with their occurrences, of every row with a term."""
    def run(batches):
        v = vocabulary.value
        for b, texts in chunks(batches, limit=SMALL_CHUNK):
            c = terms_of(texts)
            at, term = v.find(c.hashes())
            pair, tf = np.unique(c.doc_of_word()[at] * (len(v.hashes) + 1) + term, return_counts=True)
            doc, term = pair // (len(v.hashes) + 1), (pair % (len(v.hashes) + 1)).astype(np.int32)
            cut = np.searchsorted(doc, np.arange(1, c.n))
            rows = pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(c.counts.astype(np.int64)),
                 pa.array([x.tobytes() for x in np.split(term, cut)], pa.binary()),
                 pa.array([x.tobytes() for x in np.split(tf.astype(np.int32), cut)], pa.binary())],
                ["doc_id", "n", "terms", "tfs"])
            yield rows.filter(pa.array(c.counts > 0))

    return id_and_text(docs).select("doc_id", "text").mapInArrow(run, _VECTOR)


def statistics(rows: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and df of each term; a task sends its sums, one row a term."""
    def run(batches):
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column("terms").to_pylist()), np.int32), minlength=size)
        have = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(df[have])], ["term", "df"])

    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, np.int64)
    for term, count in rows.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        df[term] = count  # at most one row for each term of the items in hand
    return n, total, df


class Scale:
    """Weights of terms and the length norm, as the ranking rule defines them."""

    def __init__(self, n: int, total: int, df: np.ndarray):
        self.n, self.total = n, total
        self.w = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()], np.int64)

    def norms(self, counts: np.ndarray) -> np.ndarray:
        if int(counts.max(initial=0)) * 90 * self.n >= 1 << 63:  # in Python's integers
            return np.array([10 + 90 * c * self.n // self.total for c in counts.tolist()], np.int64)
        return 10 + 90 * counts * self.n // self.total

    def values(self, counts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, doc: np.ndarray) -> np.ndarray:
        tf = tfs.astype(np.int64)
        return self.w[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * self.norms(counts)[doc]))


class BallTree:
    """Ball tree over sparse rows (``ptr``, ``terms``, ``values``) with ids; every row has an entry."""

    def __init__(self, ids: np.ndarray, ptr: np.ndarray, terms: np.ndarray, values: np.ndarray, leaf: int = LEAF):
        self.vocabulary, compact = np.unique(terms, return_inverse=True)
        self.size = len(self.vocabulary)
        order, spans = self._split(ptr, compact, values.astype(float), leaf)
        lengths = np.diff(ptr)[order]
        self.ptr = np.concatenate([[0], np.cumsum(lengths)])
        take = np.repeat(ptr[:-1][order] - self.ptr[:-1], lengths) + np.arange(self.ptr[-1])
        self.ids, self.terms, self.values = ids[order], compact[take], values[take]
        self.scored = 0  # rows scored so far, for tests of the pruning
        self._bounds(spans)

    def _split(self, ptr, terms, values, leaf):
        """Order of the rows and nodes as (first, end, left child or 0); children stand side by side."""
        n = len(ptr) - 1
        order, spans, at = np.arange(n), [[0, n, 0]], 0
        norm = np.add.reduceat(values * values, ptr[:-1])

        def products(row):  # with every row
            dense = np.zeros(self.size)
            dense[terms[ptr[row]:ptr[row + 1]]] = values[ptr[row]:ptr[row + 1]]
            return dense

        def dots(dense, rows):
            k = np.diff(ptr)[rows]
            start = np.cumsum(k) - k
            take = np.repeat(ptr[:-1][rows] - start, k) + np.arange(k.sum())
            return np.add.reduceat(values[take] * dense[terms[take]], start)

        while at < len(spans):
            i, j, _ = spans[at]
            if j - i > leaf:
                rows = order[i:j]
                one = products(rows[np.argmax(norm[rows])])
                near = dots(one, rows)
                two = products(rows[np.argmax(norm[rows] - 2 * near)])  # farthest from the first
                order[i:j] = rows[np.argsort(near - dots(two, rows), kind="stable")]
                middle = (i + j) // 2
                spans[at][2] = len(spans)
                spans += [[i, middle, 0], [middle, j, 0]]
            at += 1
        return order, spans

    def _bounds(self, spans):
        self.first, self.end, self.child = np.array(spans, np.int64).reshape(-1, 3).T
        n = len(spans)
        self.centre, self.upper = np.zeros((n, self.size), np.int64), np.zeros((n, self.size), np.int64)
        self.radius, self.least = np.zeros(n), np.zeros(n, np.int64)
        rows = np.repeat(np.arange(len(self.ids)), np.diff(self.ptr))
        square = self.values.astype(float) ** 2
        for x, (i, j, _) in enumerate(spans):
            a, b = self.ptr[i], self.ptr[j]
            t, v = self.terms[a:b], self.values[a:b]
            total, most = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
            np.add.at(total, t, v)
            np.maximum.at(most, t, v)
            c = total // (j - i)
            self.centre[x], self.upper[x] = c, most  # the centroid plus the largest excess over it
            # |d - c|^2 = |d|^2 - 2 d.c + |c|^2, each term rounded up by more than its error
            d2 = np.bincount(rows[a:b] - i, square[a:b], j - i)
            dc = np.bincount(rows[a:b] - i, v.astype(float) * c[t], j - i)
            c2 = float((c.astype(float) ** 2).sum())
            self.radius[x] = math.sqrt(max(0.0, float((d2 - 2 * dc + c2 + 1e-9 * (d2 + 2 * dc + c2)).max()))) * (1 + 1e-9) + 1
            self.least[x] = self.ids[i:j].min()

    def bound(self, nodes: slice, query: np.ndarray) -> list[int]:
        by_term = self.upper[nodes][:, query].sum(axis=1)
        by_ball = self.centre[nodes][:, query].sum(axis=1).astype(float) + math.sqrt(len(query)) * self.radius[nodes]
        by_ball = np.ceil(by_ball * (1 + 1e-9)) + 1
        return [min(a, int(b)) for a, b in zip(by_term.tolist(), by_ball.tolist())]

    def search(self, terms: np.ndarray, best: list, floor: int, top: int) -> None:
        """Best-first: adds to ``best``, a heap of (score, -id) of at most ``top`` rows, what scores at least ``floor``."""
        query = np.searchsorted(self.vocabulary, terms)
        query[query == self.size] = 0
        query = query[self.vocabulary[query] == terms]
        if not len(query):
            return
        wanted = np.zeros(self.size, bool)
        wanted[query] = True
        ahead = [(-self.bound(slice(0, 1), query)[0], 0)]
        while ahead:
            bound, x = heapq.heappop(ahead)
            bound, full = -bound, len(best) == top
            if bound < max(floor, 1) or full and bound < best[0][0]:
                return  # no other bound is higher
            if full and bound == best[0][0] and self.least[x] > -best[0][1]:
                continue
            if self.child[x]:
                k = int(self.child[x])
                for y, b in zip((k, k + 1), self.bound(slice(k, k + 2), query)):
                    heapq.heappush(ahead, (-b, y))
                continue
            i, j = self.first[x], self.end[x]
            a, b = self.ptr[i], self.ptr[j]
            score = np.add.reduceat(np.where(wanted[self.terms[a:b]], self.values[a:b], 0), self.ptr[i:j] - a)
            self.scored += j - i
            least = max(floor, 1, best[0][0] if full else 1)
            for r in np.flatnonzero(score >= least).tolist():
                entry = (int(score[r]), -int(self.ids[i + r]))
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)


def best_of_task(items, scale, floors, top: int):
    """Searches the trees over a task's documents for every item."""
    def run(batches):
        queries, rule = items.value, scale.value
        best: list[list] = [[] for _ in queries]
        held: list[tuple] = []

        def search():
            ids, counts, terms, tfs = zip(*held)
            held.clear()
            counts, lengths = np.array(counts, np.int64), np.array([len(t) for t in terms])
            terms, tfs, doc = np.concatenate(terms), np.concatenate(tfs), np.repeat(np.arange(len(ids)), lengths)
            values = rule.values(counts, terms, tfs, doc)
            terms, doc, values = terms[values > 0], doc[values > 0], values[values > 0]
            rows, start = np.unique(doc, return_index=True)
            if len(rows):
                ids = np.array([NO_ID if d is None else d for d in ids], np.int64)[rows]
                tree = BallTree(ids, np.append(start, len(doc)), terms, values)
                for q, heap, floor in zip(queries, best, floors):
                    tree.search(q, heap, floor, top)

        entries = 0
        for b in batches:
            for d, n, t, f in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "terms", "tfs"))):
                if t:
                    held.append((d, n, np.frombuffer(t, np.int32), np.frombuffer(f, np.int32)))
                    entries += len(t) // 4
                    if len(held) == BLOCK or entries > BLOCK_ENTRIES:
                        search()
                        entries = 0
        if held:
            search()
        found = [(i, None if d == -NO_ID else -d, s) for i, heap in enumerate(best) for s, d in heap]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 3,
                                                                        (pa.int32(), pa.int64(), pa.int64()))],
                                         ["item", "doc_id", "score"])
        release()

    return run


def item_blocks(benchmark: DataFrame, block: int):
    """Items with the hashes of their distinct terms, in blocks of about ``block`` items, each collected by itself."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = max(math.ceil(count / block), math.ceil(size / BLOCK_BYTES))
    for b in range(n):
        terms: dict[int | None, list] = {}
        for i, text in rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b).toLocalIterator():
            terms.setdefault(i, []).append(terms_of([(text or "").encode()]).hashes())
        terms = {i: np.unique(np.concatenate(h)) for i, h in terms.items()}
        if any(len(h) for h in terms.values()):
            yield terms


def rank(docs: DataFrame, benchmark: DataFrame, top: int = TOP, block: int = ITEM_BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of highest score above 0 for each item."""
    spark = docs.sparkSession
    ship(spark)
    out = None
    for terms in item_blocks(benchmark, block):
        ids, vocabulary = list(terms), Vocabulary(np.concatenate(list(terms.values())))
        queries = [np.searchsorted(vocabulary.hashes, h).astype(np.int32) for h in terms.values()]
        rows = staged(vectors(docs, spark.sparkContext.broadcast(vocabulary)), "vectors")
        n, total, df = statistics(rows, len(vocabulary.hashes))
        if not n:
            continue
        items, scale = spark.sparkContext.broadcast(queries), spark.sparkContext.broadcast(Scale(n, total, df))
        share = min(1.0, 1.5 * SAMPLE / n)
        some = rows.where(F.xxhash64(F.lit(13), "doc_id", "n") <= int(-(1 << 63) + share * ((1 << 64) - 2048))).limit(SAMPLE)
        scores: list[list[int]] = [[] for _ in ids]
        for i, _, s in some.coalesce(1).mapInArrow(best_of_task(items, scale, [1] * len(ids), top), _FOUND).collect():
            scores[i].append(s)
        floors = [min(s) if len(s) == top else 1 for s in scores]
        found = staged(rows.mapInArrow(best_of_task(items, scale, floors, top), _FOUND), "found")
        first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")
        best = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top) \
            .join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return rank(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
