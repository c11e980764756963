"""Samples of exact size (F6): the k rows of least hash in each stratum, with weights and error bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.expr import key_list as _keys


def bottom_k(df: DataFrame, strata, ids: Sequence[str], k: int, weight: str = "weight") -> DataFrame:
    """The ``k`` rows of each stratum with the least md5 of ``ids`` (all, if it has fewer), whatever the partitioning.

    ``weight`` is the stratum's rows per sampled row. The order is cut to k
    rows in every task before the shuffle (WindowGroupLimit), so a stratum
    that holds most rows sends k rows a task. A sample of fewer rows is a part
    of a larger one, and a table's sample changes only by rows that come or go.
    """
    keys, names = _keys(strata), _keys(ids)
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]))
    w = Window.partitionBy(*keys).orderBy("_h", *[F.col(c).asc_nulls_last() for c in names])
    kept = df.withColumn("_h", digest).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn", "_h")
    sizes = df.groupBy(*[F.col(c).alias("_s_" + c) for c in keys]).agg(F.count(F.lit(1)).alias("_n"))
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col("_s_" + c))
    return kept.join(sizes, same).select(*df.columns, (F.col("_n") / F.least("_n", F.lit(k))).alias(weight))


def estimate_total(sample: DataFrame, strata, value: str, weight: str = "weight") -> DataFrame:
    """Per stratum: rows, sampled rows, the estimated total of ``value`` and its 95 % error bound.

    The bound is 1.96 standard errors of a sample without replacement; it is 0
    where the whole stratum was sampled.
    """
    v = F.col(value).cast("double")
    g = sample.groupBy(*_keys(strata)).agg(
        F.count(F.lit(1)).alias("n_sampled"), F.round(F.sum(weight)).cast("long").alias("n_rows"),
        F.sum(v).alias("_x"), F.coalesce(F.var_samp(v), F.lit(0.0)).alias("_s2"))
    n, total = F.col("n_sampled"), F.col("n_rows")
    return g.select(*_keys(strata), "n_rows", "n_sampled", (total / n * F.col("_x")).alias("estimate"),
                    (1.96 * F.sqrt(total * (total - n) * F.col("_s2") / n)).alias("bound"))
