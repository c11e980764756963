"""Quality rules by an isolation forest over rule statistics.

``rule_statistics`` reads every text once and gives one row of statistics per
document. ``fit_forest`` grows isolation trees on a bounded sample of those
rows; a row's anomaly score is ``2 ** (-mean path length / c(sample size))``.
``calibrate`` picks the score threshold from labelled rows of both kinds. Only
score histograms of fixed size reach the driver.

Defined cases: a NULL or empty text has zero words and fails the base rule; a
NULL doc_id is scored like any row and never joins a label; repeated rows get
equal results; without labelled rows of both kinds nothing but the base rule
rejects; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.frames import documents, id_and_text, staged
from tessera.llm.textnum import SMALL_CHUNK, Chunk, chunks, covered, distinct_per_doc, grams
from tessera.sources.tables import read_table

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
FEATURES = ("word_length", "symbol_rate", "symbols_per_word", "repeat_rate", "adjacent_rate")
TREES, SAMPLE = 100, 256  # rows that the forest is fitted on: at most TREES * SAMPLE
GOOD_LOSS, WEIGHT = 0.01, 20.0
BINS = 4000
MIN_WORDS, MAX_REPEAT_PCT = 10, 20

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_STATS = ", ".join(["doc_id long"] + [f"{c} long" for c in _COUNTS] + [f"{c} double" for c in FEATURES])


def _class_table(chars: str) -> np.ndarray:
    t = np.zeros(256, np.int64)
    t[[ord(x) for x in chars]] = 1
    return t


_SYMBOL = _class_table(SYMBOLS)


def text_statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Rule counts and forest features of some whole texts."""
    c = Chunk(texts)
    zero = np.zeros(1, np.int64)

    def per_doc(flags):  # sum over each text's bytes
        s = np.concatenate([zero, np.cumsum(flags)])
        return s[c.at[1:]] - s[c.at[:-1]]

    chars = np.concatenate([zero, np.cumsum((c.data & 0xC0) != 0x80)])
    in_words = np.concatenate([zero, np.cumsum(chars[c.ends] - chars[c.starts])])
    word_chars = in_words[c.first[1:]] - in_words[c.first[:-1]]
    n_symbols = per_doc(_SYMBOL[c.data])

    ends = np.flatnonzero(c.data == 10)
    starts = np.concatenate([zero, ends[:-1] + 1])
    worded = np.searchsorted(c.starts, starts) < np.searchsorted(c.starts, ends)
    starts, ends = starts[worded], ends[worded]
    line_doc = np.searchsorted(c.at, starts, side="right") - 1
    _, once = distinct_per_doc(c.hashes(starts, ends), line_doc)
    n_lines = np.bincount(line_doc, minlength=c.n)
    n_dup_lines = n_lines - np.bincount(once, minlength=c.n)

    h, doc = c.hashes(), c.doc_of_word()
    g = grams(h, 5)
    at = np.flatnonzero(c.left()[:len(g)] >= 5)
    order = at[np.lexsort((g[at], doc[at]))]
    same = (g[order][1:] == g[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    repeated = np.concatenate([zero, np.cumsum(covered(len(h), order[twice], 5))])
    n_repeat = repeated[c.first[1:]] - repeated[c.first[:-1]]
    adjacent = np.bincount(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], minlength=c.n)

    words = np.maximum(c.counts, 1)
    n_chars = np.maximum(per_doc((c.data & 0xC0) != 0x80) - 1, 1)
    return {"n_words": c.counts, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
            "n_repeat_words": n_repeat, "word_length": word_chars / words, "symbol_rate": n_symbols / n_chars,
            "symbols_per_word": n_symbols / words, "repeat_rate": n_repeat / words, "adjacent_rate": adjacent / words}


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the rule counts and the forest features of every document."""
    def run(batches):
        for b, texts in chunks(batches, limit=SMALL_CHUNK):
            s = text_statistics(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")] + [pa.array(s[x].astype(np.int64)) for x in _COUNTS]
                + [pa.array(s[x].astype(np.float64)) for x in FEATURES], ["doc_id", *_COUNTS, *FEATURES])

    return id_and_text(docs).select("doc_id", "text").mapInArrow(run, _STATS)


def average_path(n) -> np.ndarray:
    """Mean length of an unsuccessful search in a binary search tree over n rows."""
    n = np.asarray(n, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        c = 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n
    return np.where(n > 2, c, np.where(n == 2, 1.0, 0.0))


class Forest:
    """Isolation trees as arrays of a complete binary tree: node i has children 2i+1 and 2i+2."""

    def __init__(self, rows: np.ndarray, trees: int, sample: int, seed: int):
        rng = np.random.default_rng(seed)
        self.size = min(sample, len(rows))
        self.depth = max(1, math.ceil(math.log2(max(self.size, 2))))
        nodes = 2 ** (self.depth + 1) - 1
        self.feature = np.zeros((trees, nodes), np.int32)
        self.split = np.full((trees, nodes), np.inf)  # a leaf above the last level sends rows on to the left
        self.path = np.zeros((trees, nodes))
        for t in range(trees):
            self._grow(t, 0, 0, rows[rng.choice(len(rows), self.size, replace=False)], rng)

    def _grow(self, t: int, node: int, depth: int, rows: np.ndarray, rng) -> None:
        spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
        if depth == self.depth or not len(spread):
            self.path[t, node] = depth + average_path(len(rows))
            while 2 * node + 1 < self.path.shape[1]:
                node = 2 * node + 1
                self.path[t, node] = depth + average_path(len(rows))
            return
        f = rng.choice(spread)
        low, high = rows[:, f].min(), rows[:, f].max()
        s = rng.uniform(low, high)
        left = rows[:, f] <= s
        self.feature[t, node], self.split[t, node] = f, s
        self._grow(t, 2 * node + 1, depth + 1, rows[left], rng)
        self._grow(t, 2 * node + 2, depth + 1, rows[~left], rng)

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for f, s, p in zip(self.feature, self.split, self.path):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > s[node])
            total += p[node]
        return 2.0 ** (-total / len(self.path) / max(float(average_path(self.size)), 1e-9))


def fit_forest(stats: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = 7) -> Forest | None:
    """Forest over at most ``trees * sample`` rows: those with the least hash of their statistics and id."""
    hashed = stats.select(F.xxhash64(F.lit(seed), "doc_id", "n_words", "word_chars").alias("_h"), *FEATURES)
    share = min(1.0, 1.5 * trees * sample / max(1, stats.count()))  # tasks send about as many rows as are wanted
    rows = hashed.where(F.col("_h") <= int(-(1 << 63) + share * ((1 << 64) - 2048))).orderBy("_h", *FEATURES) \
        .limit(trees * sample).select(*FEATURES).toPandas().to_numpy(float)
    return Forest(rows, trees, sample, seed) if len(rows) else None


def score_rows(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """Adds ``anomaly`` to the statistics."""
    if forest is None:
        return stats.withColumn("anomaly", F.lit(0.0))
    shared = stats.sparkSession.sparkContext.broadcast(forest)  # trees * (4 * sample - 1) nodes: fixed size

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.score(x))],
                                             [*b.schema.names, "anomaly"])

    return stats.mapInArrow(run, f"{_STATS}, anomaly double")


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def calibrate(scored: DataFrame, labels: DataFrame, good_loss: float = GOOD_LOSS, weight: float = WEIGHT) -> float:
    """Score from which rows are rejected, chosen on the labelled rows that pass the base rule.

    It minimises the share of bad rows kept plus ``weight`` times the share of
    good rows rejected, among thresholds that reject at most ``good_loss`` of
    the good ones; without labelled rows of both kinds nothing is rejected.
    """
    known = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), "quality").distinct()
    bins = scored.where(~base_failed()).join(known, "doc_id") \
        .groupBy("quality", F.floor(F.col("anomaly") * BINS).cast("int").alias("bin")).count().collect()  # 2 * BINS rows
    counts = np.zeros((2, BINS + 2))
    for q, b, n in bins:
        counts[q, b] = n
    if not counts.sum(axis=1).all():
        return math.inf
    bad, good = counts[:, ::-1].cumsum(axis=1)[:, ::-1] / counts.sum(axis=1, keepdims=True)  # share in this bin or above
    cost = np.where(good <= good_loss, 1 - bad + weight * good, np.inf)
    least = np.flatnonzero(cost == cost.min())
    return float(least[len(least) // 2]) / BINS  # amid thresholds that do equally well


def judge(docs: DataFrame, labels: DataFrame, good_loss: float = GOOD_LOSS) -> DataFrame:
    """Rule counts, features, ``anomaly``, ``threshold``, ``base_failed`` and ``kept`` of every document."""
    stats = staged(rule_statistics(docs), "quality")
    scored = score_rows(stats, fit_forest(stats))
    threshold = calibrate(scored, labels, good_loss)
    return scored.withColumn("threshold", F.lit(threshold)).withColumn("base_failed", base_failed()) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < F.col("threshold")))


def op9_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document."""
    return judge(documents(spark, sf_dir), read_table(spark, sf_dir, "labels")) \
        .select("doc_id", *_COUNTS, "base_failed", "kept", "anomaly")


def keep_good(docs: DataFrame, labels: DataFrame, good_loss: float = GOOD_LOSS) -> DataFrame:
    """The rows of ``docs``, all columns, that pass the base rule and the forest.

    Verdicts are made where the rows are, from the same statistics, so no text is shuffled.
    """
    stats = staged(rule_statistics(docs), "quality")
    forest = fit_forest(stats)
    threshold = calibrate(score_rows(stats, forest), labels, good_loss)
    shared = docs.sparkSession.sparkContext.broadcast((forest, threshold))

    def run(batches):
        grown, limit = shared.value
        for b, texts in chunks(batches, limit=SMALL_CHUNK):
            s = text_statistics(texts)
            bad = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PCT * s["n_words"])
            if grown is not None:
                bad |= grown.score(np.column_stack([s[f] for f in FEATURES])) >= limit
            yield b.filter(pa.array(~bad))

    return docs.mapInArrow(run, docs.schema)
