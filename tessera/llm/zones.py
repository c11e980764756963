"""Repeated windows of fixed length, found through zones.

A text's windows of ``width`` units (words or bytes) fall into zones: runs of
neighbouring windows that share an anchor, where the anchor is determined by
each window's own content. So equal windows have equal anchor keys, at equal
distance. A zone is (key, fragment, start, length): the fragment is the hash of
everything its windows cover. Three steps find every window that also starts
earlier ("earlier" is a smaller document, or an earlier place as well):

1. Zones meet by key. Of equal fragments all but the first are repeats; a task
   settles its own and sends each fragment once. A key with one fragment is
   done.
2. The first zone of each fragment of a key with several is asked for again
   (``asked``); an operator compares the windows of those by its own method.
3. Repeats go back to their documents as runs of window starts.

Rows are known by doc_id and 16 bits of the text's hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.exchange import bucket_of, buckets_for, group_edges
from tessera.llm.frames import ROW, id_and_text, staged
from tessera.llm.textnum import U64, chunks, mix

#: Columns of a zone: name and type. ``state`` is 0 for a repeat, 1 for a zone to be compared, 2 for one to be asked for.
COLUMNS = {"keys": U64, "fragments": U64, "docs": np.int64, "tags": np.uint16, "starts": np.uint32,
           "lengths": np.uint32}
PACKED = "bucket int, state int, " + ", ".join(f"{c} binary" for c in COLUMNS)
Zones = dict[str, np.ndarray]
GATHERED = 400_000  # zones that a task gathers before it settles and sends them


def take(z: Zones, which: np.ndarray) -> Zones:
    return {c: v[which] for c, v in z.items()}


def join(parts: list[Zones]) -> Zones:
    return {c: np.concatenate([np.zeros(0, t), *[p[c] for p in parts]]) for c, t in COLUMNS.items()}


def pack(z: Zones, state: int, by: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket of ``by``; columns that a later step does not use are left out."""
    if not len(by):
        return
    unused = {0: ("keys", "fragments"), 1: (), 2: ("fragments",)}[state]
    b = bucket_of(by, n)
    order = np.lexsort((z["starts"], z["docs"], b) if state != 1 else (z["keys"], b))
    b, z = b[order], take(z, order)
    cut = np.concatenate([[0], np.flatnonzero(b[1:] != b[:-1]) + 1, [len(b)]])
    spans = list(zip(cut[:-1], cut[1:]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(b[cut[:-1]]), pa.array([state] * len(spans), pa.int32())]
        + [pa.array([b"" if c in unused else np.ascontiguousarray(v[i:j]).tobytes() for i, j in spans], pa.binary())
           for c, v in z.items()], ["bucket", "state", *COLUMNS])


def unpack(table: pa.Table, state: int) -> Zones:
    rows = table.filter(pc.equal(table.column("state"), state))
    out = {c: np.concatenate([np.zeros(0, t), *[np.frombuffer(v, t) for v in rows.column(c).to_pylist()]])
           for c, t in COLUMNS.items()}
    n = len(out["docs"])
    return {c: v if len(v) else np.zeros(n, t) for (c, v), t in zip(out.items(), COLUMNS.values())}


def doc_key(z: Zones) -> np.ndarray:
    return mix(z["docs"].view(U64))


def differs(*columns: np.ndarray) -> np.ndarray:
    """Which rows differ in some column from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def settle(z: Zones, places: bool) -> tuple[Zones, Zones]:
    """(repeats, firsts) among zones: a repeat has the key and fragment of an earlier one.

    With ``places`` the first is one zone; without, all zones of the least document are firsts. Zones of one place
    (rows given twice) count as one.
    """
    z = take(z, np.lexsort((z["tags"], z["starts"], z["docs"], z["fragments"], z["keys"])))
    z = take(z, differs(z["keys"], z["fragments"], z["docs"], z["starts"], z["tags"]))
    new = differs(z["keys"], z["fragments"])
    first = new if places else z["docs"] == z["docs"][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    return take(z, ~first), take(z, first)


def contested(z: Zones) -> np.ndarray:
    """Which of the firsts (sorted by key) have a key with several fragments."""
    start, size = group_edges(z["keys"])
    if not len(start):
        return np.zeros(0, bool)
    low, high = np.minimum.reduceat(z["fragments"], start), np.maximum.reduceat(z["fragments"], start)
    return np.repeat(low != high, size)


def zone_rows(batches, zones_of: Callable[[list[bytes]], tuple], places: bool, n: int) -> Iterator[pa.RecordBatch]:
    """Zones of the texts: repeats among those gathered are settled, each fragment's firsts are sent to their key's bucket."""
    gathered, size = [], 0

    def sent():
        repeats, firsts = settle(join(gathered), places)
        yield from pack(repeats, 0, doc_key(repeats), n)
        yield from pack(firsts, 1, firsts["keys"], n)

    for b, texts in chunks(batches):
        keys, fragments, of, starts, lengths = zones_of(texts)
        ids = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
        tags = b.column(ROW).to_numpy(zero_copy_only=False).astype(np.uint16)
        known = ~b.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        gathered.append(take({"keys": keys, "fragments": fragments, "docs": ids[of], "tags": tags[of],
                              "starts": starts.astype(np.uint32), "lengths": lengths.astype(np.uint32)}, known[of]))
        size += len(keys)
        if size >= GATHERED:
            yield from sent()
            gathered, size = [], 0
    if gathered:
        yield from sent()


def repeats_and_asked(docs: DataFrame, zones_of: Callable[[list[bytes]], tuple], places: bool,
                      hot: int = 5000) -> DataFrame:
    """Step 1, packed by document: zones that repeat (state 0) and zones asked for (state 2).

    A key with more than ``hot`` zones asked for gives them the key 0: their windows are compared one by one.
    """
    n = buckets_for(docs)

    def meet(table):
        repeats, firsts = settle(unpack(table, 1), places)
        asked = take(firsts, contested(firsts))
        _, size = group_edges(asked["keys"])
        asked["keys"] = np.where(np.repeat(size, size) > hot, U64(0), asked["keys"])
        repeats = join([repeats, unpack(table, 0)])
        return pa.Table.from_batches([*pack(repeats, 0, doc_key(repeats), n), *pack(asked, 2, doc_key(asked), n)],
                                     schema=pa.schema([("bucket", pa.int32()), ("state", pa.int32())]
                                                      + [(c, pa.binary()) for c in COLUMNS]))

    rows = id_and_text(docs).mapInArrow(lambda batches: zone_rows(batches, zones_of, places, n), PACKED)
    return staged(rows.groupBy("bucket").applyInArrow(meet, PACKED), "zones")


def by_document(packed: DataFrame, state: int) -> DataFrame:
    """doc_id, tag and the zones of one state; repeats come as runs of window starts without overlap."""
    def regroup(table):
        z = unpack(table, state)
        order = np.lexsort((z["starts"], z["tags"], z["docs"]))
        z = take(z, order)
        new = np.ones(len(order), bool)
        new[1:] = (z["docs"][1:] != z["docs"][:-1]) | (z["tags"][1:] != z["tags"][:-1])
        cut = np.concatenate([np.flatnonzero(new), [len(new)]])
        rows = []
        for i, j in zip(cut[:-1], cut[1:]):
            a, m, k = z["starts"][i:j].astype(np.int64), z["lengths"][i:j].astype(np.int64), z["keys"][i:j]
            if state == 0:
                end = np.maximum.accumulate(a + m)
                head = np.concatenate([[True], a[1:] > end[:-1]])
                last = np.concatenate([np.flatnonzero(head)[1:] - 1, [len(a) - 1]])
                a, m, k = a[head], end[last] - a[head], k[:0]
            rows.append((int(z["docs"][i]), int(z["tags"][i]), a.astype(np.uint32).tobytes(),
                         m.astype(np.uint32).tobytes(), k.tobytes()))
        cols = list(zip(*rows)) or [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int32()] + [pa.binary()] * 3)],
                        names=["doc_id", "tag", "starts", "lengths", "keys"])

    return packed.where(F.col("state") == state).groupBy("bucket") \
        .applyInArrow(regroup, "doc_id long, tag int, starts binary, lengths binary, keys binary")


def with_zones(docs: DataFrame, zones: DataFrame, how: str) -> DataFrame:
    """doc_id, text, _row of each document row with its zones (from ``by_document``)."""
    zones = staged(zones, "document-zones")
    size = zones.agg(F.sum(F.octet_length("starts") * 4 + 100)).first()[0] or 0
    rows = id_and_text(docs).withColumn("tag", F.col(ROW).bitwiseAND(F.lit(0xFFFF)).cast("int"))
    return rows.join(F.broadcast(zones) if size <= 64 << 20 else zones, ["doc_id", "tag"], how)


def asked_zones(b: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, keys) of row i of ``with_zones``."""
    return (np.frombuffer(b.column("starts")[i].as_py() or b"", np.uint32).astype(np.int64),
            np.frombuffer(b.column("lengths")[i].as_py() or b"", np.uint32).astype(np.int64),
            np.frombuffer(b.column("keys")[i].as_py() or b"", U64))


__all__ = ["PACKED", "asked_zones", "by_document", "differs", "repeats_and_asked", "with_zones"]
