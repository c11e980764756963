"""Token-id files with Elias-Fano document boundaries.

A file is a Parquet table of segments. A segment holds whole documents: their
ids as one array of 2-byte (or 4-byte) little-endian integers, and two
Elias-Fano sequences, the documents' end places in that array and their
doc_ids. A sequence of n values up to u stores the low ``log2(u / n)`` bits of
each value as they are and the high bits in unary: about ``2 + log2(u / n)``
bits a value. A sample of every 64th one of the unary part lets ``select`` jump
near any value, so offsets need no table of 64-bit numbers.

Texts are encoded where they are read; their ids are dealt out by doc_id range
and sorted by doc_id, and a range is a shard.
The only figures that meet on the driver are one id count for each shard.

Defined cases: a NULL or empty text has the end id only; NULL doc_ids come
first; rows with one doc_id are ordered by the hash of their text; a text longer than a segment is a segment of its own; an empty table
gives no segments; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.frames import ROW, documents, id_and_text, parts_for, shuffle_partitions
from tessera.llm.textnum import SMALL_CHUNK, chunks
from tessera.llm.tokens import crc, encoder, vocabulary
from tessera.session import ensure_checkpoint_dir

VOCABULARY, KIND, END = "word_bpe_49k.json", "word", 2
SHARD_BYTES = 64 << 20  # of the input's files, for each shard at most
SEGMENT_IDS = 1 << 18
SAMPLE = 64
MAGIC = b"EFS1"


class EliasFano:
    """A non-decreasing sequence of integers from 0 up, in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.samples = n, low_bits, np.frombuffer(low, np.uint8), samples
        self.high = np.frombuffer(high, np.uint8)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        bits = max(0, int(values[-1] // n).bit_length() - 1) if n else 0
        low = np.zeros(0, np.uint8)
        if bits:
            low = np.packbits(((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8))
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        return cls(n, bits, low.tobytes(), np.packbits(unary).tobytes(), ones[::SAMPLE].astype("<u4"))

    def _low(self, i: int, j: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(j - i, np.uint64)
        a, b = i * self.low_bits, j * self.low_bits
        bits = np.unpackbits(self.low[a // 8:(b + 7) // 8])[a % 8:a % 8 + b - a].reshape(j - i, self.low_bits)
        return (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """Value number i: the place of one number i in the unary part, less i, above the low bits."""
        start = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, start // 8
        bits = np.unpackbits(self.high[byte:byte + 1])
        bits[:start % 8] = 0
        while (ones := int(bits.sum())) <= left:
            left, byte = left - ones, byte + 1
            bits = np.unpackbits(self.high[byte:byte + 1])
        place = byte * 8 + int(np.flatnonzero(bits)[left])
        return ((place - i) << self.low_bits) | int(self._low(i, i + 1)[0])

    def values(self) -> np.ndarray:
        """All values at once."""
        high = np.flatnonzero(np.unpackbits(self.high)) - np.arange(self.n)
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self._low(0, self.n)

    def to_bytes(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]
        return struct.pack("<IBIII", self.n, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        n, bits, a, b, c = struct.unpack_from("<IBIII", data, at)
        at += struct.calcsize("<IBIII")
        return cls(n, bits, data[at:at + a], data[at + a:at + a + b],
                   np.frombuffer(data[at + a + b:at + a + b + c], "<u4")), at + a + b + c


def encode_segment(doc_ids: list[int | None], ids: list[bytes], dtype: np.dtype) -> bytes:
    """Magic, id width, number of NULL doc_ids, least doc_id, ends, doc_ids, ids."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(x) // dtype.itemsize for x in ids])
    return MAGIC + struct.pack("<BIq", dtype.itemsize, len(doc_ids) - len(known), least) + \
        EliasFano.of(ends).to_bytes() + EliasFano.of(known - least).to_bytes() + b"".join(ids)


def decode_segment(data: bytes) -> tuple[list[int | None], EliasFano, np.ndarray]:
    """doc_ids, end places and ids of a segment."""
    if data[:4] != MAGIC:
        raise ValueError("not a token segment")
    width, nulls, least = struct.unpack_from("<BIq", data, 4)
    ends, at = EliasFano.from_bytes(data, 4 + struct.calcsize("<BIq"))
    docs, at = EliasFano.from_bytes(data, at)
    known = (docs.values().astype(np.int64) + least).tolist() if docs.n else []
    return [None] * nulls + known, ends, np.frombuffer(data, f"<u{width}", offset=at)


def write_ids(docs: DataFrame, path: str, vocabulary_path: str | None = None, kind: str = KIND, end: int = END,
              shards: int | None = None, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every text and write the segments to ``path`` (any store that Spark writes)."""
    spark = docs.sparkSession
    n = shards or parts_for(docs, SHARD_BYTES, shuffle_partitions(spark))
    rows = id_and_text(docs)
    ranks = [i / n for i in range(1, n)]
    cuts = rows.select(F.percentile_approx("doc_id", ranks, max(10_000, 10 * n))).first()[0] if n > 1 else None
    cuts = spark.sparkContext.broadcast(np.array(sorted(set(cuts or [])), np.int64))  # one a shard

    def encode(batches):
        enc = encoder(vocabulary_path or vocabulary(VOCABULARY), kind)
        for b, _ in chunks(batches, limit=SMALL_CHUNK):
            ids = enc.encode([t or "" for t in b.column("text").to_pylist()], end)
            known = b.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column(ROW), pa.array(np.searchsorted(cuts.value, known).astype(np.int32)),
                 pa.array(ids, pa.binary())], ["doc_id", ROW, "shard", "ids"])

    def segments(batches):
        dtype = encoder(vocabulary_path or vocabulary(VOCABULARY), kind).dtype
        shard, base, number = TaskContext.get().partitionId(), 0, 0
        ids, docs_, size = [], [], 0

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([base], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([encode_segment(docs_, ids, dtype)], pa.binary())],
                ["shard", "number", "base", "n_ids", "segment"])

        for b in batches:
            for d, x in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                if ids and size + len(x) // dtype.itemsize > segment_ids:
                    yield row()
                    base, number, ids, docs_, size = base + size, number + 1, [], [], 0
                ids.append(x)
                docs_.append(d)
                size += len(x) // dtype.itemsize
        if ids:
            yield row()

    rows.mapInArrow(encode, f"doc_id long, {ROW} long, shard int, ids binary") \
        .repartitionById(n, F.col("shard")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), ROW) \
        .mapInArrow(segments, "shard int, number int, base long, n_ids long, segment binary") \
        .write.option("compression", "zstd").parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids as little-endian 4-byte integers) of every document in a file."""
    files = spark.read.parquet(path)
    sizes = {r["shard"]: r["n"] for r in files.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}  # one a shard
    bases = np.zeros(max(sizes, default=0) + 2, np.int64)
    for s, n in sizes.items():
        bases[s + 1] = n
    bases = spark.sparkContext.broadcast(np.cumsum(bases))

    def documents_of(batches):
        for b in batches:
            for shard, base, data in zip(*(b.column(c).to_pylist() for c in ("shard", "base", "segment"))):
                docs, ends, ids = decode_segment(data)
                cut = np.concatenate([[0], ends.values().astype(np.int64)])
                each = [ids[i:j] for i, j in zip(cut[:-1], cut[1:])]
                cols = [pa.array(docs, pa.int64()), pa.array(cut[:-1] + base + bases.value[shard]),
                        pa.array(np.diff(cut)), pa.array([crc(x) for x in each], pa.int64())]
                if with_ids:
                    cols.append(pa.array([x.astype("<u4").tobytes() for x in each], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(cols)])

    return files.select("shard", "base", "segment").mapInArrow(
        documents_of, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token file of all documents and read it back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    write_ids(documents(spark, sf_dir), path)
    return read_ids(spark, path, with_ids=False)
