"""Near-duplicate documents by min-max hashing.

Every permutation of a document's shingle set gives two signature values, its
minimum and its maximum, so half as many hash evaluations fill the bands; a
band mixes minima and maxima of different permutations. Documents that share a
band fall into one candidate cluster (connected components in Spark). Inside a
cluster every pair is judged on the full shingle sets: an exact link needs
``100 * |A & B| >= percent * |A | B|``. Band counts are set so that a pair at
the threshold is missed with a probability of one in a million.

Equal shingle sets are one node, whatever their number of copies. A task sends
each band key once to its bucket. Clusters above ``BLOCK`` nodes are judged in
pairs of blocks, and a task returns only links that join its components.

Defined cases: a text without words has no shingles and links with nothing; a
text with fewer words than a shingle is one shingle; a NULL doc_id links with
nothing, has a NULL component and is kept; rows with one doc_id are told apart
by their text; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.exchange import buckets_for, group_edges, pack, packed_schema, reduce_buckets, unpack
from tessera.llm.frames import ROW, documents, id_and_text, sent_to_all, staged
from tessera.llm.textnum import SMALL_CHUNK, U64, Chunk, chunks, distinct_per_doc, mix, shingles

MISS = 1e-6
BLOCK = 500
NODES_PER_TASK = 2000
_LINKS = "a long, b long"


def banding(percent: int, rows: int | None = None, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): enough bands that a pair at the threshold shares one but for a probability of ``miss``."""
    rows = rows or (8 if percent >= 85 else 6)
    j = percent / 100
    bands = 1 if j == 1 else math.ceil(math.log(miss) / math.log1p(-j ** rows))
    return bands, rows


class MinMax:
    """Band keys of a shingle set from the minima and maxima of bands * rows / 2 permutations."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        self.n = bands * rows // 2
        rng = np.random.default_rng(seed)
        self.mul = rng.integers(1 << 31, size=(self.n, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.add = rng.integers(1 << 32, size=(self.n, 1), dtype=np.uint32)
        half = np.arange(bands)[:, None] * (rows // 2) + np.arange(rows // 2)
        # the maxima of a band come from permutations half the list away from those of its minima
        self.order = np.concatenate([half % self.n, self.n + (half + self.n // 2) % self.n], axis=1)
        self.weight = mix(np.arange(1, rows + 1, dtype=U64)) | U64(1)
        self.salt = mix(np.arange(bands, dtype=U64) + U64(1 << 40))

    def values(self, keys: np.ndarray) -> np.ndarray:
        low, high = None, None
        x = (keys >> U64(32)).astype(np.uint32)
        for i in range(0, len(x), 2048):
            v = x[None, i:i + 2048] * self.mul + self.add
            a, b = v.min(axis=1), v.max(axis=1)
            low, high = (a, b) if low is None else (np.minimum(low, a), np.maximum(high, b))
        return np.concatenate([low, high])

    def keys(self, keys: np.ndarray) -> np.ndarray:
        v = self.values(keys)[self.order].astype(U64)
        return mix((v * self.weight).sum(axis=1, dtype=U64) ^ self.salt)


def _sets(texts: list[bytes], k: int):
    """Sorted distinct shingle hashes of each text."""
    c = Chunk(texts, lower=True)
    keys, docs = distinct_per_doc(*shingles(c, c.hashes(), k))
    return np.split(keys, np.searchsorted(docs, np.arange(1, c.n)))


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, _row, n_shingles, node (hash of the shingle set; 0 for none) and the band keys."""
    def run(batches):
        scheme = MinMax(bands, rows)
        for b, texts in chunks(batches, limit=SMALL_CHUNK):
            sets = _sets(texts, k)
            node = [int(mix(mix(s).sum(dtype=U64, keepdims=True) + U64(len(s)))[0]) if len(s) else 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column(ROW), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(np.array(node, U64).view(np.int64)),
                 pa.array([scheme.keys(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                ["doc_id", ROW, "n_shingles", "node", "bands"])

    return id_and_text(docs).mapInArrow(run, f"doc_id long, {ROW} long, n_shingles long, node long, bands binary")


def candidate_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) that hold together all nodes sharing a band key: a star for each key, within tasks and across."""
    n = buckets_for(nodes)

    def send(batches):
        for b in batches:
            node, band = b.column("node").to_numpy(), b.column("bands").to_pylist()
            if not len(node):
                continue
            keys = np.concatenate([np.frombuffer(x, U64) for x in band])
            owner = np.repeat(node, len(keys) // len(node))
            order = np.lexsort((owner, keys))
            keys, owner = keys[order], owner[order]
            start, size = group_edges(keys)
            center = np.repeat(owner[start], size)
            rest = np.ones(len(keys), bool)
            rest[start] = False
            if rest.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([-1], pa.int32()), pa.array([center[rest].tobytes()], pa.binary()),
                     pa.array([owner[rest].tobytes()], pa.binary())], ["bucket", "keys", "nodes"])
            yield from pack(keys[start], {"nodes": owner[start]}, n)

    def local(batches):
        for b in batches:
            for x, y in zip(b.column("keys").to_pylist(), b.column("nodes").to_pylist()):
                pairs = np.unique(np.column_stack([np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def meet(table):
        got = unpack(table, keys=U64, nodes=np.int64)
        order = np.lexsort((got["nodes"], got["keys"]))
        keys, node = got["keys"][order], got["nodes"][order]
        start, size = group_edges(keys)
        center = np.repeat(node[start], size)
        rest = center != node
        pairs = np.unique(np.column_stack([center[rest], node[rest]]), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    sent = staged(nodes.select("node", "bands").mapInArrow(send, packed_schema("nodes")), "bands")
    return reduce_buckets(sent.where("bucket >= 0"), meet, _LINKS) \
        .unionByName(sent.where("bucket < 0").mapInArrow(local, _LINKS)).distinct()


def _joined(adjacent: np.ndarray) -> np.ndarray:
    """Least index reachable from each row of a symmetric adjacency matrix."""
    label = np.arange(len(adjacent))
    while True:
        new = np.minimum(label, np.where(adjacent, label[None, :], len(label)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def exact_links(sets: list[np.ndarray], side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the components of the pairs at or above the threshold.

    ``side`` is the block of each set; with two blocks only pairs across them count (the others have their own task).
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    word, use = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(use, minlength=len(word)) > 1
    column = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(n), size)[shared[use]]
    use = column[use[shared[use]]]
    order = np.argsort(use, kind="stable")
    use, owner = use[order], owner[order]
    both = np.zeros((n, n), np.float32)
    width = max(1, 4_000_000 // max(n, 1))
    for at in range(0, int(shared.sum()), width):
        i, j = np.searchsorted(use, [at, at + width])
        part = np.zeros((n, width), np.float32)
        part[owner[i:j], use[i:j] - at] = 1
        both += part @ part.T
    inter = np.rint(both).astype(np.int64)
    adjacent = 100 * inter >= percent * (size[:, None] + size[None, :] - inter)
    if (side != side[0]).any():
        adjacent &= side[:, None] != side[None, :]
    label = _joined(adjacent)
    other = np.flatnonzero(label != np.arange(n))
    return label[other], other


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, rows: int | None = None,
                    block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: doc_id, _row, n_shingles, component_id and kept."""
    bands, rows = banding(percent, rows)
    signed = staged(signatures(docs, k, bands, rows), "signatures")
    nodes = staged(signed.where("n_shingles > 0 and doc_id is not null").groupBy("node")
                   .agg(F.min(F.struct("doc_id", ROW)).alias("first"), F.any_value("bands").alias("bands"))
                   .select("node", F.col("first.doc_id").alias("doc_id"), F.col(f"first.{ROW}").alias(ROW), "bands"),
                   "nodes")
    clusters = components(candidate_links(nodes), "a", "b").withColumnRenamed("vertex", "node") \
        .withColumnRenamed("component", "cluster")
    links = staged(_verified(docs, nodes.drop("bands"), clusters, k, percent, block), "near-links")
    joined = components(links, "a", "b").withColumnRenamed("vertex", "node")
    named = nodes.select("node", "doc_id").join(joined, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = named.join(least, "component").select("node", "component_id")
    out = signed.drop("bands").join(of_node, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", ROW, "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _verified(docs: DataFrame, nodes: DataFrame, clusters: DataFrame, k: int, percent: int, block: int) -> DataFrame:
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    members = staged(nodes.join(clusters, "node").join(sizes, "cluster"), "members")
    tasks = max(1, math.ceil(members.count() / NODES_PER_TASK))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    place = members.withColumn("side", own) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other")) \
        .withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(tasks)))
                    .otherwise(F.xxhash64("cluster", "low", "high"))) \
        .groupBy("doc_id", ROW, "node", "cluster", "side") \
        .agg(F.collect_list(F.struct("low", "high", "task")).alias("places"))

    def as_sets(batches):
        for b, texts in chunks(batches, limit=SMALL_CHUNK):
            yield pa.RecordBatch.from_arrays(
                [b.column(x) for x in ("node", "cluster", "side", "places")]
                + [pa.array([s.tobytes() for s in _sets(texts, k)], pa.binary())],
                ["node", "cluster", "side", "places", "set"])

    kept = "node long, cluster long, side int, places array<struct<low:int,high:int,task:long>>"
    place = staged(place, "places")
    sets = id_and_text(docs).join(sent_to_all(place, row_bytes=200), ["doc_id", ROW]).select("text", "node", "cluster", "side", "places") \
        .mapInArrow(as_sets, f"{kept}, set binary") \
        .select("node", "cluster", "side", "set", F.explode("places").alias("p")) \
        .select("node", "cluster", "side", "set", "p.low", "p.high", "p.task")

    def judge(table):
        a, b = [], []
        rows: dict[tuple, dict] = {}
        for c, low, high, node, side, s in zip(*(table.column(x).to_pylist() for x in (
                "cluster", "low", "high", "node", "side", "set"))):
            rows.setdefault((c, low, high), {})[node] = (side, s)
        for group in rows.values():
            if len(group) < 2:
                continue
            node = np.array(list(group), np.int64)
            side = np.array([x[0] for x in group.values()])
            i, j = exact_links([np.frombuffer(x[1], U64) for x in group.values()], side, percent)
            a.append(node[i])
            b.append(node[j])
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})

    return sets.groupBy("task").applyInArrow(judge, _LINKS)


def op3_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at a 3-word shingle similarity of 0.85 or more."""
    return near_duplicates(documents(spark, sf_dir), k=3, percent=85) \
        .select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, but for near duplicates of a smaller doc_id."""
    gone = staged(near_duplicates(docs, k, percent).where("not kept").select("doc_id", ROW).distinct(), "near-copies")
    rows = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(F.col("text").cast("string")).alias(ROW))
    return rows.join(sent_to_all(gone, row_bytes=50), ["doc_id", ROW], "left_anti").select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
