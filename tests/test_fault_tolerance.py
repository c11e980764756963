"""Lost tasks: a write whose tasks fail on their first attempt still commits exactly once.

Runs in a child process with ``local[4,3]`` (up to 3 attempts per task); a test-only Python
UDF raises on attempt 0 of every task, as a lost executor would.
"""

import os
import subprocess
import sys
import tempfile
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F, types as T
    from tessera.plans import standins as S
    from tessera.operators import activity as ac
    from tessera.sources import writers as wr

    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {ckpt!r}).getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    @F.udf(T.LongType())
    def flaky(x):
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("simulated executor loss")
        return x

    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    daily = (ac.daily_counts(e, "user_id", "ts").withColumn("num_site_hits", flaky("num_site_hits")))
    wr.overwrite_partitions(daily, {out!r}, ["day"])
    got = spark.read.parquet({out!r})
    want = ac.daily_counts(e, "user_id", "ts")
    diff = got.select("user_id", "day", "num_site_hits").exceptAll(want.select("user_id", "day", "num_site_hits"))
    print("ROWS", got.count(), want.count(), diff.count())
    spark.stop()
""")


def test_partition_overwrite_survives_failed_attempts():
    base = tempfile.mkdtemp(prefix="ft-", dir="/tmp")
    script = SCRIPT.format(root=ROOT, ckpt=os.path.join(base, "ckpt"), out=os.path.join(base, "out"))
    r = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600)
    line = [x for x in r.stdout.splitlines() if x.startswith("ROWS")]
    assert line, r.stderr[-2000:]
    _, got, want, diff = line[0].split()
    assert got == want and diff == "0"
