"""Multi-column clustering on write (A12): rows near in several columns share files, so scans prune on each of them.

Sorting by one column makes the ranges of every other column as wide as the
table in each file. ``z_value`` interleaves the bits of the columns' ranks, so
each column's range in a file is narrow. Ranks come from approximate quantiles
(one pass, 2**bits - 1 values a column on the driver).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rank(c: Column, bounds: Sequence, low: int = 0) -> Column:
    """How many of the sorted bounds are at most ``c``: a balanced tree of comparisons, compiled with the row's code."""
    if not bounds:
        return F.lit(low)
    middle = len(bounds) // 2
    return F.when(c >= F.lit(bounds[middle]), _rank(c, bounds[middle + 1:], low + middle + 1)) \
        .otherwise(_rank(c, bounds[:middle], low))


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Interleaved bits of the columns' quantile ranks (NULLs rank first)."""
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    bounds = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in columns]).first()
    out = F.lit(0).cast("long")
    for j, c in enumerate(columns):
        rank = _rank(F.col(c), sorted(bounds[c] or []))
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(bit, b * len(columns) + j))
    return out


def clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = 6, within: Sequence[str] = ()) -> DataFrame:
    """``df`` in ``files`` range partitions of the z-value of ``columns``, each sorted by ``within`` (the columns by default).

    Sorting inside a file costs no pruning and gives the encoder long runs.
    """
    spread = df.withColumn("_z", z_value(df, columns, bits)).repartitionByRange(files, "_z", *columns)
    return spread.sortWithinPartitions(*(within or columns)).drop("_z")


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per file of a table read from Parquet: rows, and the least and greatest value of each column."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.min(c).alias("min_" + c) for c in columns],
        *[F.max(c).alias("max_" + c) for c in columns])
