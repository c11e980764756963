"""Line deduplication with levelled sorted runs of line hashes (DataFrame functions only).

Documents come in batches by ascending doc_id. A run is a Parquet table, sorted
by hash, of line hashes never seen before with the doc_id that owns them. Each
batch merge-joins the runs: hashes found there, or owned by a smaller doc_id of
the batch, mark its lines as dropped; the batch's own new hashes (a merge
anti-join) become a run of level 0. When a level holds ``fanout`` runs they are
compacted into one run of the next level, so a batch meets few runs.

Defined cases: a NULL or empty text is one empty line and stays; a NULL doc_id
neither drops lines nor loses any; rows with one doc_id own lines together and
drop nothing from each other; an empty table gives an empty result; all other
columns are kept as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.frames import documents
from tessera.session import ensure_checkpoint_dir

BATCHES = 4
FANOUT = 2
MIN_CHARS = 10
_BLANK = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["_h1", "_h2"]


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case (other letters unchanged)."""
    bare = F.btrim(line, F.lit(_BLANK))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


class LevelledRuns:
    """Sorted runs of (hash, owner) by level, in a folder of their own under the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/line-runs-{uuid.uuid4().hex}"
        self.levels: list[list[str]] = [[]]
        self.written = 0

    def _write(self, rows: DataFrame) -> str:
        path = f"{self.folder}/run-{self.written:05d}"
        self.written += 1
        rows.sortWithinPartitions(*_HASH).write.parquet(path)
        return path

    def known(self) -> DataFrame | None:
        paths = [p for level in self.levels for p in level]
        return self.spark.read.parquet(*paths) if paths else None

    def add(self, rows: DataFrame) -> None:
        self.levels[0].append(self._write(rows))
        for i, level in enumerate(self.levels):
            if len(level) >= self.fanout:  # runs of one level share no hash: compaction is a plain merge
                merged = self._write(self.spark.read.parquet(*level).repartition(*_HASH))
                self.levels[i] = []
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(merged)


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with repeated lines cut from ``text``, plus ``_n_lines`` and ``_n_dropped``."""
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").cast("long").alias("_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")) \
        .withColumn("_row", F.xxhash64("_text")).withColumn("_lines", F.split("_text", "\n", -1))
    cuts = rows.select(F.percentile_approx("_id", [i / batches for i in range(1, batches)])).first()[0] or []
    batch = sum([F.coalesce((F.col("_id") > c).cast("int"), F.lit(0)) for c in sorted(set(cuts))], F.lit(0))

    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/line-keys-{uuid.uuid4().hex}"
    rows.select("_id", "_row", batch.alias("_batch"), F.posexplode("_lines").alias("_pos", "_line")) \
        .withColumn("_key", line_key(F.col("_line"))).where((F.char_length("_key") >= min_chars) & F.col("_id").isNotNull()) \
        .select("_id", "_row", "_batch", "_pos", F.xxhash64("_key").alias("_h1"),
                F.xxhash64(F.lit("second"), "_key").alias("_h2")) \
        .write.partitionBy("_batch").parquet(folder)
    keyed = spark.read.schema("_id long, _row long, _pos int, _h1 long, _h2 long, _batch int").parquet(folder)

    runs, dropped = LevelledRuns(spark, fanout), None
    for b in range(len(set(cuts)) + 1):
        lines = keyed.where(F.col("_batch") == b)
        firsts = lines.groupBy(*_HASH).agg(F.min("_id").alias("_owner"))
        known = runs.known()
        runs.add(firsts if known is None else firsts.join(known.hint("merge"), _HASH, "left_anti"))
        gone = lines.join(runs.known().hint("merge"), _HASH).where(F.col("_id") > F.col("_owner")) \
            .select("_id", "_row", "_pos")
        dropped = gone if dropped is None else dropped.unionByName(gone)

    gone = dropped.groupBy("_id", "_row").agg(F.collect_set("_pos").alias("_gone"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    text = F.array_join(F.transform(kept, lambda i: F.element_at("_lines", i + 1)), "\n")
    out = rows.join(gone, ["_id", "_row"], "left") \
        .withColumn("_new", F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(text))
    return out.select(*[(F.col("_new") if c.lower() == "text" else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns],
                      F.size("_lines").cast("long").alias("_n_lines"),
                      F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("_n_dropped"))


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, dropped lines and the SHA-256 of what is kept."""
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                      F.sha2("text", 256).alias("kept_sha256"))
