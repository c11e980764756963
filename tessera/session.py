"""SparkSession construction and cluster-aware settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package relies on. AQE re-plans joins and
# coalesces small shuffle partitions at runtime; skew-join splits hot
# partitions of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target size of a post-shuffle partition after AQE coalescing; the initial
    # spark.sql.shuffle.partitions is set per deployment (high on a cluster).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    # streaming dedupe state (keys x watermark delay) lives off-heap in RocksDB, not in the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only set when given, so a cluster submit keeps its own.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def size_shuffle_partitions(spark: SparkSession, input_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                            minimum: int = 200) -> int:
    """Set ``spark.sql.shuffle.partitions`` so one partition of the biggest input is ~``target_bytes``.

    E.g. 100 TB at 256 MB -> ~400k initial partitions; AQE then coalesces
    small post-shuffle partitions to ``advisoryPartitionSizeInBytes`` and
    splits skewed ones, so the initial number only has to be large enough
    that no partition spills heavily.
    """
    n = max(minimum, -(-int(input_bytes) // int(target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, by Spark's statistics; data without any, as rows made by a program, count 0."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)  # Spark gives unknown sizes as 2**63 - 1


def partitions_for(df: DataFrame, part_bytes: int) -> int:
    """The session's shuffle partitions, or as many as keep one at ``part_bytes`` of the input."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // part_bytes))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the deployment and must be on
    shared storage; we only read it, and refuse to run without it (a
    machine-local folder would not survive a lost executor). Only in local
    mode (tests, the bench) is a scratch folder created when it is unset.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client, the server's setting applies
        if configured:
            return configured
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:  # core setting may be read-only at runtime
        pass
    return local
