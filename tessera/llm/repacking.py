"""Best-fit packing with certified bin counts.

Documents longer than a sequence are cut into full pieces; what is shorter is
packed into sequences (bins) without cutting. The pieces are dealt out to
partitions of about ``PART`` pieces. Each partition packs its pieces by
best-fit decreasing and computes a lower bound of its bin count from dual
feasible functions: a function f with f(x1) + ... + f(xk) <= 1 for all pieces
that fit one bin gives bins >= sum of f over all pieces. Equal counts certify
the partition: no packing of its pieces has fewer bins.

Partitions then exchange documents: a partition with a gap between count and
bound opens its emptiest bins, ``WIDEN`` for each bin of the gap; a certified
one opens only its emptiest bin, as its bound is rounded up. The pieces of
opened bins of ``FAN`` partitions meet in one and are packed anew by best-fit
decreasing; if that needs no fewer bins, their old bins stay. This is repeated
until one partition is left, so the number of rounds is the logarithm of the
number of partitions.

Only counts reach the driver. A partition is a task's work of bounded size;
pieces are dealt by a running number, so copies of a document do not crowd.

Defined cases: a NULL or empty text is its end id; NULL doc_ids, repeated rows
and repeated ids are packed like any other; a text of any length is encoded
whole; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.frames import documents, id_and_text, staged
from tessera.llm.textnum import SMALL_CHUNK, chunks
from tessera.llm.tokens import crc, encoder, vocabulary

VOCABULARY, KIND, END = "word_bpe_49k.json", "word", 0
CAPACITY = 2048
PART, FAN, WIDEN = 8192, 16, 8
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = "task long, place long, length long, bin long, offset long"
_ROUND = _PACKED + ", round int, part long, part_bins long, lower_bound long, open boolean"


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit decreasing of ``counts[x]`` pieces of each length x: bins as ([(length, pieces), ...], number of such bins).

    Equal pieces are placed together: the fullest bins that still take a piece
    get as many as fit, one bin after the other, as piece by piece placing would.
    """
    at: dict[int, list] = {}  # room left: bins
    mask = 0  # bit r: there are bins with room r
    for x in np.flatnonzero(counts)[::-1].tolist():
        m = int(counts[x])
        while m:
            ahead = mask >> x
            if ahead:
                room = x + (ahead & -ahead).bit_length() - 1
                content, n = at[room].pop()
                if not at[room]:
                    mask ^= 1 << room
            else:
                room, content, n = capacity, [], m
            k = room // x
            filled = min(n, m // k)
            rest = m - filled * k if filled < n else 0
            rest = min(rest, k - 1) if rest else 0
            for number, each in ((filled, k), (1 if rest else 0, rest)):
                if number:
                    at.setdefault(left := room - each * x, []).append((content + [(x, each)], number))
                    mask |= 1 << left
            unused = n - filled - (1 if rest else 0)
            if content and unused:
                at.setdefault(room, []).append((content, unused))
                mask |= 1 << room
            m -= filled * k + rest
    return [b for bins in at.values() for b in bins]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Largest bin count that a family of dual feasible functions proves necessary.

    With t from 1 to half of the capacity: u_t rounds the share of a bin to
    multiples of 1/t; v_t takes pieces longer than capacity - t for whole bins
    and drops those shorter than t; w_t counts for each piece how many pieces
    of length t it takes from a bin.
    """
    x = np.flatnonzero(counts).astype(np.int64)
    n = counts[x].astype(np.int64)
    if not len(x):
        return 0
    best = -(-int((x * n).sum()) // capacity)
    for t in range(1, capacity // 2 + 1):
        whole, small = x > capacity - t, x < t
        best = max(best, -(-int(n[whole].sum() * capacity + (x * n)[~whole & ~small].sum()) // capacity))
        if t <= 64:
            scaled = x * (t + 1)
            u = np.where(scaled % capacity == 0, x * t, scaled // capacity * capacity)  # in units of 1 / (t * capacity)
            best = max(best, -(-int((u * n).sum()) // (t * capacity)))
        slots = capacity // t
        w = np.where(2 * x > capacity, 2 * (slots - (capacity - x) // t), np.where(2 * x == capacity, slots, 2 * (x // t)))
        best = max(best, -(-int((w * n).sum()) // (2 * slots)))
    return best


def place_all(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset, bins) of each piece."""
    bins = best_fit(np.bincount(lengths, minlength=capacity + 1), capacity)
    size, number, offset, used = [], [], [], 0
    for content, n in bins:
        x = np.repeat([a for a, _ in content], [k for _, k in content])
        start = np.cumsum(x) - x
        size.append(np.tile(x, n))
        offset.append(np.tile(start, n))
        number.append(np.repeat(np.arange(used, used + n), len(x)))
        used += n
    slot = np.argsort(np.concatenate(size), kind="stable") if size else np.zeros(0, np.int64)
    mine = np.argsort(lengths, kind="stable")
    of, where = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    of[mine], where[mine] = np.concatenate(number or [slot])[slot], np.concatenate(offset or [slot])[slot]
    return of, where, used


def pieces_of(docs: DataFrame, capacity: int, vocabulary_path: str | None, kind: str, end: int, with_ids: bool) -> DataFrame:
    """Every document's pieces with their checksums, numbered within the task that made them."""
    def run(batches):
        enc = encoder(vocabulary_path or vocabulary(VOCABULARY), kind)
        task, made = TaskContext.get().partitionId(), 0
        for b, texts in chunks(batches, limit=SMALL_CHUNK):
            rows, ids = [], []
            for d, x in zip(b.column("doc_id").to_pylist(), enc.encode([t.decode() for t in texts], end)):
                whole = np.frombuffer(x, enc.dtype)
                for i, start in enumerate(range(0, len(whole), capacity)):
                    part = whole[start:start + capacity]
                    rows.append((d, i, start, len(part), crc(part), task, made))
                    if with_ids:
                        ids.append(part.astype("<u4").tobytes())
                    made += 1
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)] + ([pa.array(ids, pa.binary())] if with_ids else [])
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place", "ids"]
            yield pa.RecordBatch.from_arrays(cols, names[:len(cols)])

    return id_and_text(docs).select("doc_id", "text") \
        .mapInArrow(run, _PIECE + ", task long, place long" + ", ids binary" * with_ids)


def packed_round(number: int, capacity: int, last: bool):
    """What one partition does in a round: pack, certify, keep the better packing, open the emptiest bins."""
    def run(key, table):
        length, old = table.column("length").to_numpy(), table.column("bin").to_numpy()
        of, where, used = place_all(length, capacity)
        before = len(np.unique(old)) if number else used + 1
        if before <= used:  # the bins that came are as few
            _, of = np.unique(old, return_inverse=True)
            where, used = table.column("offset").to_numpy(), before
        bound = lower_bound(np.bincount(length, minlength=capacity + 1), capacity)
        opened = np.zeros(used, bool)
        if not last:
            fill = np.bincount(of, length, used)
            opened[np.argsort(fill, kind="stable")[:max(1, WIDEN * (used - bound))]] = True
        part, n = key[0].as_py(), len(length)
        return pa.table({
            "task": table.column("task"), "place": table.column("place"), "length": table.column("length"),
            "bin": pa.array((number + 1 << 59) + (part << 24) + of), "offset": pa.array(where),
            "round": pa.array(np.full(n, number, np.int32)), "part": pa.array(np.full(n, part)),
            "part_bins": pa.array(np.full(n, used)), "lower_bound": pa.array(np.full(n, bound)),
            "open": pa.array(opened[of])})

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary_path: str | None = None, kind: str = KIND, end: int = END,
         part: int = PART, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their sequence and offset (and ids).

    ``round``, ``part``, ``part_bins`` and ``lower_bound`` tell which partition
    placed a piece, with how many bins and its certified least number; they are
    NULL for full pieces, each of which is a sequence of its own.
    """
    pieces = staged(pieces_of(docs, capacity, vocabulary_path, kind, end, with_ids), "pieces")
    short = pieces.where(F.col("length") < capacity)
    parts = max(1, -(-short.count() // part))
    rows = short.select("task", "place", "length", F.lit(-1).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset"),
                        F.pmod(F.xxhash64("task", "place"), F.lit(parts)).cast("long").alias("part"))
    settled, rounds = None, 1 + math.ceil(math.log(parts, FAN) - 1e-9)
    for r in range(rounds):
        done = staged(rows.groupBy("part").applyInArrow(packed_round(r, capacity, r == rounds - 1), _ROUND), "bins")
        kept = done.where("NOT open").drop("open", "length")
        settled = kept if settled is None else settled.unionByName(kept)
        rows = done.where("open").select("task", "place", "length", "bin", "offset",
                                         F.floor(F.col("part") / FAN).cast("long").alias("part"))
    ids = ["ids"] * with_ids
    shown = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *ids, "round", "part", "part_bins",
             "lower_bound"]
    whole = pieces.where(F.col("length") == capacity).select(
        "*", (F.shiftleft("task", 33) + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(None).cast("int").alias("round"), *[F.lit(None).cast("long").alias(c) for c in ("part", "part_bins", "lower_bound")])
    return short.join(settled.withColumnRenamed("bin", "sequence_id"), ["task", "place"]).select(*shown) \
        .unionByName(whole.select(*shown))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return pack(documents(spark, sf_dir), with_ids=False).drop("part_bins")
