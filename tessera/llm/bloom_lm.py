"""Language-model scores from a log-frequency Bloom filter.

The model is the pair probability with Witten-Bell smoothing,
``(c(vw) + T(v) P(w)) / (c(v) + T(v))``, where T(v) is the number of different
words that follow v and P the add-one word probability. Pair counts come from a
Bloom filter by repeated membership probes: counts are quantised to the levels
of ``EDGES`` (1, 2, 3, 4, 6, 8, 12, ...) and a pair of level j is entered j
times; a query probes level 1, 2, ... up to the first miss and takes the level's
lower edge, bounded by the exact counts of both words and by what T(v) leaves
(every other follower takes at least one of v's occurrences). Words have a table
of exact c and T beside the filter (``base_score`` is the sum of the logs of P).

So that the result is a probability, the sum of p over all words after one word
must not pass 1 by much. Lower edges never sum to more than c(v), T is the same
above and below the line, and a false hit at level 1 adds 1 / (c(v) + T(v)). A
pair's level 1 is therefore entered with as many probes as it takes for the V
words after v to add ``SLACK`` to the sum by false hits (less for v below
``RARE``, where a single one weighs much): many for rare v, few for frequent
ones, 18 bits of test on average where one size for all would take over 30. V
is estimated by a sketch that travels with the counts. Higher levels are
probed for true pairs only and have ``BITS`` bits an entry.

Spark counts words and pairs in buckets of the first word's hash; a bucket's
reducer makes that bucket's own filter and table, so the model grows with the
corpus and is never built in one place. Scoring broadcasts a model of at most
``GROUP_BYTES``, which the driver fills bucket by bucket in a mapped file. Beyond
that the questions go to the model: texts are bundled, a bundle sends each bucket
its words and pairs once, the bucket's own filter and table answer, and the answers
meet the bundle again. So the texts are read once, whatever the size of the model.

Defined cases: a NULL or empty text is the end token alone; a NULL doc_id
belongs to the training texts; repeated rows are counted each time; a long text
is read whole, as a chunk of its own; with no training text every word is
unknown; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import os
import pickle
import tempfile

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.exchange import bucket_of, buckets_for, group_edges
from tessera.llm.frames import documents, id_and_text, shuffles_removed, staged, unstaged
from tessera.llm.textnum import SMALL_CHUNK, U64, Chunk, chunks, mix, release, runs_of

GROUP_BYTES = 32 << 20  # of a model that is broadcast; the exchange takes about as many CPU seconds
STRONG = 4  # bits tested in each 64-bit word of the first level
SLACK = 0.02  # of the sum of p after a word that may come from false hits
RARE = 100  # occurrences and followers below which false hits must be rarer still, as each weighs more
BITS = 12  # of the other levels' filters for each entry: about 0.5 % false positives
PROBES = 7  # of 9 bits of a hash each
SKETCH = 10  # log2 of the registers of the sketch of distinct words: 3 % error
#: Least counts of the levels.
EDGES = np.array(sorted([1 << i for i in range(60)] + [3 << i for i in range(58)]), np.int64)
FLUSH = 3_000_000  # tokens that a task counts before it sends
BUNDLE_BYTES = 12_000_000  # of texts that ask the model together
PIECE = 1 << 18  # pairs that a bucket answers at a time
_END, _BEGIN = mix(np.array([1, 2], U64))
_CONTEXT, _PAIR = U64(0x1D8E4E27C47D124F), U64(0x2545F4914F6CDD1D)
_COUNTS = "bucket int, kind int, keys binary, counts binary, sketch binary"


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def token_stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, the token before each, first token of each text); every text ends with the end token."""
    c = Chunk(texts, lower=True)
    first = c.first + np.arange(c.n + 1)
    tokens = np.full(first[-1], _END, U64)
    tokens[np.arange(len(c.starts)) + c.doc_of_word()] = c.hashes()
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = _BEGIN
    return tokens, before, first


def pair_key(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """32 bits of either word's hash."""
    return (before & U64(0xFFFFFFFF00000000)) | (tokens >> U64(32))


def context_key(keys: np.ndarray) -> np.ndarray:
    """Of a word, or of the first word of a pair: what both are dealt out by."""
    return mix((keys & U64(0xFFFFFFFF00000000)) ^ _CONTEXT)


def sketch_of(words: np.ndarray) -> np.ndarray:
    """Registers that tell the number of distinct words (the most leading zeros in each of 2**SKETCH parts)."""
    h = mix(words ^ _PAIR)
    rest = (h << U64(SKETCH)) | U64((1 << SKETCH) - 1)
    out = np.zeros(1 << SKETCH, np.uint8)
    np.maximum.at(out, (h >> U64(64 - SKETCH)).astype(np.int64), (64 - np.frexp(rest.astype(float))[1] + 1).astype(np.uint8))
    return out


def distinct(sketch: np.ndarray) -> float:
    m = len(sketch)
    raw = 0.7213 / (1 + 1.079 / m) * m * m / (2.0 ** -sketch.astype(float)).sum()
    empty = int((sketch == 0).sum())
    return m * math.log(m / empty) if empty and raw < 2.5 * m else raw


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(EDGES, counts, side="right").astype(np.uint8)


def expected(level: np.ndarray) -> np.ndarray:
    """Least count that a level stands for; 0 for level 0."""
    return np.where(level > 0, EDGES[np.maximum(level.astype(np.int64), 1) - 1], 0).astype(float)


def _masks() -> np.ndarray:
    """4096 words of 64 bits with ``STRONG`` bits set."""
    rng = np.random.default_rng(17)
    bits = np.argsort(rng.random((4096, 64)), axis=1)[:, :STRONG].astype(U64)
    return np.bitwise_or.reduce(U64(1) << bits, axis=1)


MASKS = _masks()


def strong_words(words: float, context: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """64-bit words to probe for a pair whose first word has these counts, with ``words`` words in all."""
    mass = (context + follow).astype(float)  # what one false hit is a part of
    bits = np.log2(np.maximum(words, 2) * 1.1 / (SLACK * mass * np.minimum(1, mass / RARE)))
    return np.clip(np.ceil(bits / STRONG), 1, 64 // STRONG).astype(np.uint8)


def _strong(items: np.ndarray, i: int, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the word and the bits to set or test there, in the ``i``-th probe."""
    h = mix(items + U64(((i + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
    return (((h >> U64(32)) * size.astype(U64)) >> U64(32)).astype(np.int64), MASKS[(h & U64(4095)).astype(np.int64)]


def build_strong(items: np.ndarray, words: np.ndarray) -> bytes:
    """Filter of the pairs themselves, each with its number of probes: half of its bits are set."""
    size = max(1, math.ceil(int(words.sum()) * STRONG / math.log(2) / 64))
    data = np.zeros(size, U64)
    for i in range(int(words.max(initial=0))):
        place, mask = _strong(items[words > i], i, np.array(size))
        np.bitwise_or.at(data, place, mask)
    return data.tobytes()


def _probes(items: np.ndarray, level: int, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte place of each item's 64-byte block and the bit numbers to probe in it."""
    h = mix(items + U64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
    block = ((h >> U64(32)) * blocks.astype(U64)) >> U64(32)
    bits = (mix(h)[:, None] >> (np.arange(PROBES, dtype=U64) * U64(9))) & U64(511)
    return block.astype(np.int64) * 64, bits


def build(items: np.ndarray, levels: np.ndarray, first: int = 1) -> bytes:
    """Filter of some items with their levels from ``first`` on."""
    entries = int(np.maximum(levels.astype(np.int64) - (first - 1), 0).sum())
    n = max(1, -(-entries * BITS // 512))
    data = np.zeros(n * 64, np.uint8)
    for level in range(first, int(levels.max(initial=0)) + 1):
        block, bits = _probes(items[levels >= level], level, np.array(n))
        np.bitwise_or.at(data, (block[:, None] + (bits >> U64(3)).astype(np.int64)).ravel(),
                         (np.uint8(1) << (bits & U64(7)).astype(np.uint8)).ravel())
    return data.tobytes()


_PARTS = {"pairs": U64, "levels": np.uint8, "words": U64, "counts": np.uint32, "follow": np.uint32, "probes": np.uint8}
_MARK = b"tessera language model: filters and table."  # where a group's bytes begin
_TABLE = ("words", "counts", "follow", "probes")


def _lead() -> int:
    """Bytes that stand before the content of a large pickled bytes object."""
    content = os.urandom(1 << 17)
    return pickle.dumps(content, pickle.HIGHEST_PROTOCOL).index(content[:64])


class Group:
    """Some neighbouring buckets of the model: the filters, and the words' table sorted by word.

    The driver fills a mapped file bucket by bucket, so that it never holds a
    group, and broadcasts its bytes. Spark keeps a broadcast in a local file of
    each executor; the executor's workers map that file and share its pages.
    """

    def __init__(self, low: int, high: int, n: int, sizes: dict[str, np.ndarray], path: str | None):
        """``sizes``: bytes by bucket (all n) of each part; ``path``: of the mapped file, or None for memory."""
        self.low, self.high, self.n, self.at, self.length, self.start, end = low, high, n, {}, {}, {}, 128 - _lead() % 64
        for part, kind in _PARTS.items():  # in the file of the broadcast, parts begin at multiples of 64
            size = sizes[part][low:high] // np.dtype(kind).itemsize
            self.at[part], self.length[part] = np.cumsum(size) - size, size
            self.start[part], end = end, end + -(-int(size.sum()) * np.dtype(kind).itemsize // 64) * 64
        self.whole, self.shared = np.memmap(path, np.uint8, "w+", shape=end) if path else np.zeros(end, np.uint8), None
        self.whole[:len(_MARK)] = np.frombuffer(_MARK, np.uint8)
        self.parts = self._cut(self.whole)

    @classmethod
    def of(cls, bucket: int, n: int, values: dict[str, bytes | None]) -> Group:
        """One bucket alone, in memory."""
        sizes = {k: np.zeros(bucket + 1, np.int64) for k in _PARTS}
        for k, v in values.items():
            sizes[k][bucket] = len(v or b"")
        out = cls(bucket, bucket + 1, n, sizes, None)
        out.put(bucket, **values)
        return out

    def _cut(self, whole: np.ndarray) -> dict[str, np.ndarray]:
        return {part: whole[self.start[part]:self.start[part] + int(self.length[part].sum()) * np.dtype(kind).itemsize].view(kind)
                for part, kind in _PARTS.items()}

    def __getstate__(self):
        return self.__dict__ | {"whole": None, "parts": None}

    def open(self) -> Group:
        """The parts, in a worker."""
        if self.parts is None:
            path = getattr(self.shared, "_path", None)  # not there if Spark encrypts its files
            if path and os.path.exists(path):
                with open(path, "rb") as f:
                    lead = f.read(4096).find(_MARK)
                if lead >= 0:
                    self.whole = np.memmap(path, np.uint8, "r")[lead:]
            if self.whole is None:
                self.whole = np.frombuffer(self.shared.value, np.uint8)
            self.parts = self._cut(self.whole)
        return self

    def put(self, bucket: int, **values: bytes | None) -> None:
        for name, value in values.items():
            if value:
                at = int(self.at[name][bucket - self.low])
                value = np.frombuffer(value, _PARTS[name])
                self.parts[name][at:at + len(value)] = value

    def send(self, sc) -> Group:
        """Sort the table and broadcast the whole."""
        order = np.argsort(self.parts["words"])
        for name in _TABLE:
            self.parts[name][:] = self.parts[name][order]
        self.shared = sc.broadcast(self.whole.tobytes())
        return self

    def _own(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bucket = bucket_of(context_key(keys), self.n)
        own = np.flatnonzero((bucket >= self.low) & (bucket < self.high))
        return own, bucket[own] - self.low

    def table(self, words: np.ndarray) -> dict[str, np.ndarray]:
        """Exact counts, followers and probes of words; 0 for those that are not in this group."""
        known = self.parts["words"]
        at = np.searchsorted(known, words)
        at[at == len(known)] = 0
        found = known[at] == words if len(known) else np.zeros(len(words), bool)
        return {name: np.where(found, self.parts[name][at] if len(known) else 0, 0).astype(_PARTS[name]) for name in _TABLE[1:]}

    def level(self, pairs: np.ndarray, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indexes of the pairs in this group's buckets, their levels) by repeated probes; ``probes`` of their first words."""
        own, bucket = self._own(pairs)
        items, probes = mix(pairs[own] ^ _PAIR), probes[own]
        out = np.zeros(len(own), np.uint8)
        size, at, data = self.length["pairs"], self.at["pairs"], self.parts["pairs"]
        live = np.flatnonzero((size[bucket] > 0) & (probes > 0))
        passed, i = [], 0
        while len(live):
            place, mask = _strong(items[live], i, size[bucket[live]])
            live = live[(data[place + at[bucket[live]]] & mask) == mask]
            i += 1
            passed.append(live[probes[live] == i])
            live = live[probes[live] > i]
        live, level = np.concatenate([live, *passed]), 2
        out[live] = 1
        blocks, at, data = self.length["levels"] // 64, self.at["levels"], self.parts["levels"]
        live = live[blocks[bucket[live]] > 0]
        while len(live):
            block, bits = _probes(items[live], level, blocks[bucket[live]])
            place = (block + at[bucket[live]])[:, None] + (bits >> U64(3)).astype(np.int64)
            live = live[((data[place] >> (bits & U64(7)).astype(np.uint8)) & 1).all(axis=1)]
            out[live] = level
            level += 1
        return own, out


def _send(kind: int, keys: np.ndarray, counts: np.ndarray, n: int, sketch: bytes | None = None):
    bucket = bucket_of(context_key(keys), n)
    order = np.lexsort((keys, bucket))
    bucket, keys, counts = bucket[order], keys[order], counts[order].astype(np.uint32)
    start, size = group_edges(bucket)
    if len(start):
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[start]), pa.array([kind] * len(start), pa.int32()),
             pa.array([keys[i:i + m].tobytes() for i, m in zip(start, size)], pa.binary()),
             pa.array([counts[i:i + m].tobytes() for i, m in zip(start, size)], pa.binary()),
             pa.array([sketch] * len(start), pa.binary())],
            ["bucket", "kind", "keys", "counts", "sketch"])


def _sums(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    rows = [(k, c) for x, k, c in zip(*(table.column(c).to_pylist() for c in ("kind", "keys", "counts"))) if x == kind]
    keys = np.concatenate([np.zeros(0, U64), *[np.frombuffer(k, U64) for k, _ in rows]])
    counts = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(c, np.uint32).astype(np.int64) for _, c in rows]])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    start, _ = group_edges(keys)
    return keys[start], np.add.reduceat(counts, start) if len(start) else counts


_MODEL = ", ".join(["bucket int", *[f"{c} binary" for c in _PARTS], "tokens long, n_words long"])


def train(docs: DataFrame) -> tuple[DataFrame, int]:
    """(model, buckets): a row for each bucket, with its filters and its words' table."""
    n = buckets_for(docs)

    def count(batches):
        words, pairs = [], []

        def flush():
            w, c = np.unique(np.concatenate(words), return_counts=True)
            yield from _send(1, w, c, n, sketch_of(w).tobytes())
            p, c = np.unique(np.concatenate(pairs), return_counts=True)
            yield from _send(2, p, c, n)
            words.clear()
            pairs.clear()

        for _, texts in chunks(batches):
            tokens, before, first = token_stream(texts)
            words += [tokens, np.full(len(first) - 1, _BEGIN)]
            pairs.append(pair_key(before, tokens))
            if sum(map(len, pairs)) >= FLUSH:
                yield from flush()
        if words:
            yield from flush()

    def enter(table):
        w, c = _sums(table, 1)
        p, d = _sums(table, 2)
        sketches = [np.frombuffer(x, np.uint8) for x in table.column("sketch").to_pylist() if x]
        total = distinct(np.maximum.reduce(sketches)) if sketches else 1.0
        items, level = mix(p ^ _PAIR), levels_of(d)
        # contexts are told apart by the same bits of their hash in words and in pairs
        context, of, follow = np.unique(p >> U64(32), return_inverse=True, return_counts=True)
        probes = strong_words(total, np.bincount(of, d, len(context)), follow)
        at = np.searchsorted(context, w >> U64(32))
        at[at == len(context)] = 0
        leads = context[at] == w >> U64(32) if len(context) else np.zeros(len(w), bool)
        own = {"words": w, "counts": c, "follow": np.where(leads, follow[at] if len(context) else 0, 0),
               "probes": np.where(leads, probes[at] if len(context) else 0, 0)}
        real = w != _BEGIN
        parts = {"pairs": build_strong(items, probes[of]), "levels": build(items[level > 1], level[level > 1], 2)} \
            | {k: v.astype(_PARTS[k]).tobytes() for k, v in own.items()}
        return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()),
                         **{k: pa.array([parts[k]], pa.binary()) for k in _PARTS},
                         "tokens": pa.array([int(c[real].sum())], pa.int64()), "n_words": pa.array([int(real.sum())], pa.int64())})

    texts = id_and_text(docs.where(~held_out(F.col("doc_id")))).select("text")
    with shuffles_removed(docs.sparkSession):
        return staged(texts.mapInArrow(count, _COUNTS).groupBy("bucket").applyInArrow(enter, _MODEL), "lm"), n


def groups(model: DataFrame, n: int, limit: int = GROUP_BYTES):
    """The model's buckets in broadcast groups of at most ``limit`` bytes (one bucket at least)."""
    sc = model.sparkSession.sparkContext
    sizes = {k: np.zeros(n, np.int64) for k in _PARTS}
    for b, *each in model.select("bucket", *[F.coalesce(F.octet_length(c), F.lit(0)) for c in _PARTS]).collect():  # a row a bucket
        for part, size in zip(_PARTS, each):
            sizes[part][b] = size
    size = sum(sizes.values())
    folder, low = tempfile.mkdtemp(prefix="tessera-lm-"), 0  # the driver's own, for its maps
    while low < n:
        high = low + 1
        while high < n and size[low:high + 1].sum() <= limit:
            high += 1
        group = Group(low, high, n, sizes, os.path.join(folder, str(low)))
        for b, *values in model.where((F.col("bucket") >= low) & (F.col("bucket") < high)) \
                .select("bucket", *_PARTS).toLocalIterator():  # a few buckets at a time
            group.put(b, **dict(zip(_PARTS, values)))
        yield group.send(sc), high == n
        low = high


_STATE = {"pair": np.uint8, "count": np.uint32, "context": np.uint32, "follow": np.uint32}


def _look(group: Group, tokens: np.ndarray, before: np.ndarray, state: dict[str, np.ndarray]) -> None:
    """Fill in what this group knows of each token: its count, those of the word before it, and the level of their pair."""
    each, back = np.unique(np.concatenate([tokens, before]), return_inverse=True)
    table = group.table(each)
    mine, ahead = back[:len(tokens)], back[len(tokens):]
    pairs, at, of = np.unique(pair_key(before, tokens), return_index=True, return_inverse=True)
    own, found = group.level(pairs, table["probes"][ahead[at]])
    level = np.zeros(len(pairs), np.uint8)
    level[own] = found
    for name, new in (("pair", level[of]), ("count", table["counts"][mine]), ("context", table["counts"][ahead]),
                      ("follow", table["follow"][ahead])):
        state[name] = np.maximum(state[name], new)


def probability(word: np.ndarray, context: np.ndarray, pair: np.ndarray, follow: np.ndarray, n_train: int,
                n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(P of the words, p of the words after their contexts) from exact counts and the pairs' levels."""
    word, context, follow = (x.astype(np.int64) for x in (word, context, follow))
    single = (word + 1.0) / (n_train + n_words + 1)
    follow = np.clip(follow, 1, np.maximum(context, 1))  # words that share the bits of a context have its followers together
    seen = np.minimum(expected(pair), np.minimum(word, context - follow + 1))
    return single, np.where(context > 0, (seen + follow * single) / np.maximum(context + follow, 1), single)


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(ids: pa.Array, held: pa.Array, first: np.ndarray, state: dict[str, np.ndarray], n_train: int,
           n_words: int) -> pa.RecordBatch:
    """The result's rows of some texts from what is known of their tokens."""
    base, p = probability(state["count"], state["context"], state["pair"], state["follow"], n_train, n_words)
    sums = [np.add.reduceat(x, first[:-1]) for x in (np.log10(base), np.log10(p))] if len(first) > 1 else [[], []]
    known = np.add.reduceat((state["count"] > 0).astype(np.int64), first[:-1]) if len(first) > 1 else []
    return pa.RecordBatch.from_arrays(
        [ids, held, pa.array(np.diff(first)), pa.array(known, pa.int64()),
         pa.array(np.full(len(first) - 1, n_train, np.int64)), pa.array(sums[0], pa.float64()), pa.array(sums[1], pa.float64())],
        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


_BUNDLE = "bundle long, ids array<long>, held array<boolean>, sizes binary, texts binary"


def bundled(batches):
    """Texts in bundles of about ``BUNDLE_BYTES``, each a row with its number."""
    part, k, ids, held, texts, size = TaskContext.get().partitionId(), 0, [], [], [], 0

    def row():
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + k], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
             pa.array([sizes.tobytes()], pa.binary()), pa.array([pa.compress(b"".join(texts), "zstd", asbytes=True)], pa.binary())],
            ["bundle", "ids", "held", "sizes", "texts"])

    for b, some in chunks(batches, limit=SMALL_CHUNK):
        ids += b.column("doc_id").to_pylist()
        held += b.column("held_out").to_pylist()
        texts += some
        size += sum(map(len, some)) + len(some)
        if size >= BUNDLE_BYTES:
            yield row()
            k, ids, held, texts, size = k + 1, [], [], [], 0
    if texts:
        yield row()


def bundle_tokens(sizes: bytes, texts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, first token of each text) of a bundle."""
    size = np.frombuffer(sizes, np.int64)
    whole, at = pa.decompress(texts, int(size.sum()), "zstd", asbytes=True), np.concatenate([[0], np.cumsum(size)])
    tokens, first = [], [np.zeros(1, np.int64)]
    for i, j in runs_of(size, SMALL_CHUNK):
        some, _, begin = token_stream([whole[a:b] for a, b in zip(at[i:j], at[i + 1:j + 1])])
        tokens.append(some)
        first.append(begin[1:] + first[-1][-1])
    return np.concatenate([np.zeros(0, U64), *tokens]), np.concatenate(first)


class Questions:
    """The distinct words of some tokens, ordered by bucket, and the distinct pairs, ordered by their first words.

    ``word`` and ``ahead`` place each token and the token before it among the
    words, ``pair`` both among the pairs; ``lead`` places a pair's first word
    among the words, ``low`` is the second word's half of the pair's key.
    """

    def __init__(self, tokens: np.ndarray, first: np.ndarray, n: int):
        words, at = np.unique(np.concatenate([[_BEGIN], tokens]), return_inverse=True)
        bucket = bucket_of(context_key(words), n)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        at = rank[at]
        self.words, self.bucket, self.word, self.ahead = words[order], bucket[order], at[1:], at[:-1].copy()
        self.ahead[first[:-1]] = at[0]
        pairs, self.pair = np.unique((self.ahead.astype(U64) << U64(32)) | (tokens >> U64(32)), return_inverse=True)
        self.lead, self.low = (pairs >> U64(32)).astype(np.int64), pairs.astype(np.uint32)

    def rows(self, bundle: int) -> pa.RecordBatch:
        """A row for each bucket: its words, how many pairs each of them leads, and the pairs' second halves."""
        start, size = group_edges(self.bucket)
        follow = np.bincount(self.lead, minlength=len(self.words)).astype(np.uint32)
        end = np.concatenate([[0], np.cumsum(follow, dtype=np.int64)])
        spans = list(zip(start, start + size))
        return pa.RecordBatch.from_arrays(
            [pa.array(self.bucket[start]), pa.array([bundle] * len(start), pa.int64()),
             pa.array([self.words[i:j].tobytes() for i, j in spans], pa.binary()),
             pa.array([follow[i:j].tobytes() for i, j in spans], pa.binary()),
             pa.array([self.low[end[i]:end[j]].tobytes() for i, j in spans], pa.binary())],
            ["bucket", "bundle", "words", "follow", "low"])


_QUESTIONS = "bucket int, bundle long, words binary, follow binary, low binary"
_ANSWERS = {"counts": np.uint32, "follow": np.uint32, "pairs": np.uint8}


def _answered(group: Group, table: pa.Table):
    """Counts and followers of the words asked for, levels of the pairs, for each row."""
    asked = {c: table.column(c).to_pylist() for c in ("words", "follow", "low")}
    out = {c: [] for c in _ANSWERS}
    for i, j in runs_of(np.array([len(x) // 4 for x in asked["low"]], np.int64), PIECE):
        words, follow, low = (np.frombuffer(b"".join(asked[c][i:j]), t) for c, t in (("words", U64), ("follow", np.uint32), ("low", np.uint32)))
        known = group.table(words)
        pairs = pair_key(np.repeat(words, follow), low.astype(U64) << U64(32))
        _, level = group.level(pairs, np.repeat(known["probes"], follow))  # all are this bucket's
        for c, column, values in (("counts", "words", known["counts"]), ("follow", "words", known["follow"]), ("pairs", "low", level)):
            width = 8 if column == "words" else 4
            end = np.cumsum([len(x) // width for x in asked[column][i:j]])
            out[c] += [x.tobytes() for x in np.split(values, end[:-1])]
    return pa.table([table.column("bucket"), table.column("bundle"), *[pa.array(out[c], pa.binary()) for c in _ANSWERS]],
                    names=["bucket", "bundle", *_ANSWERS])


def _score_by_exchange(rows: DataFrame, model: DataFrame, n: int, n_train: int, n_words: int) -> DataFrame:
    """Scores of ``rows`` (doc_id, text, held_out) where words and pairs are sent to the model's buckets and answered there."""
    def ask(batches):
        for b in batches:
            for k, sizes, texts in zip(*(b.column(c).to_pylist() for c in ("bundle", "sizes", "texts"))):
                yield Questions(*bundle_tokens(sizes, texts), n).rows(k)
        release()

    def answer(key, asked, own):
        row = own.to_pylist()[0] if len(own) else {}
        return _answered(Group.of(key[0].as_py(), n, {k: row.get(k) for k in _PARTS}), asked)

    def meet(key, bundle, answers):
        (row,) = bundle.to_pylist()
        tokens, first = bundle_tokens(row["sizes"], row["texts"])
        q = Questions(tokens, first, n)
        order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
        found = {}
        for c, t in _ANSWERS.items():
            values = answers.column(c).to_pylist()
            found[c] = np.frombuffer(b"".join([values[i] for i in order]), t)
        out = []
        for i, j in runs_of(np.diff(first), PIECE):
            a, b = first[i], first[j]
            word, ahead, pair = q.word[a:b], q.ahead[a:b], q.pair[a:b]
            state = {"pair": found["pairs"][pair], "count": found["counts"][word], "context": found["counts"][ahead],
                     "follow": found["follow"][ahead]}
            out.append(scored(pa.array(row["ids"][i:j], pa.int64()), pa.array(row["held"][i:j], pa.bool_()),
                              first[i:j + 1] - a, state, n_train, n_words))
        release()
        return pa.Table.from_batches(out)

    with shuffles_removed(rows.sparkSession):  # what a step has sent goes when its result is written
        bundles = staged(rows.select("doc_id", "text", "held_out").mapInArrow(bundled, _BUNDLE), "lm-bundles")
        asked = bundles.select("bundle", "sizes", "texts").mapInArrow(ask, _QUESTIONS)
        answers = staged(asked.groupBy("bucket").cogroup(model.select("bucket", *_PARTS).groupBy("bucket")).applyInArrow(
            answer, "bucket int, bundle long, " + ", ".join(f"{c} binary" for c in _ANSWERS)), "lm-answers")
        out = staged(bundles.groupBy("bundle").cogroup(answers.groupBy("bundle")).applyInArrow(meet, _RESULT), "lm-scores")
    for done in (bundles, answers):
        unstaged(done)
    return out


def score(docs: DataFrame, model: DataFrame, n: int, limit: int = GROUP_BYTES) -> DataFrame:
    """Per document row: held_out, n_tokens, n_known, train_tokens, base_score and score.

    A model of at most ``limit`` bytes is broadcast, a larger one stays in its buckets.
    """
    n_train, n_words, size = map(int, model.agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "n_words")],
        F.coalesce(F.sum(sum(F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in _PARTS)), F.lit(0))).first())
    rows = id_and_text(docs).withColumn("held_out", held_out(F.col("doc_id"))).select("doc_id", "text", "held_out")
    if size > limit:
        return _score_by_exchange(rows, model, n, n_train, n_words)
    (group, _), = groups(model, n, limit)

    def run(batches):
        for b, texts in chunks(batches, limit=SMALL_CHUNK):
            tokens, before, first = token_stream(texts)
            state = {s: np.zeros(len(tokens), t) for s, t in _STATE.items()}
            _look(group.open(), tokens, before, state)
            yield scored(b.column("doc_id"), b.column("held_out"), first, state, n_train, n_words)

    out = staged(rows.mapInArrow(run, _RESULT), "lm-scores")
    group.shared.destroy()  # the workers live on
    return out


def op5_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every document, learned from those not held out."""
    docs = documents(spark, sf_dir)
    return score(docs, *train(docs))
