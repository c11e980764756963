"""Data-quality checks (Q1-Q6): the keys and enums Spark does not enforce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cardinality_profile(df: DataFrame, cols: Sequence[str], low_max: int = 50, exact: bool = True) -> DataFrame:
    """Q1: distinct count per column with a unique / high / low label.

    unique: every non-null value distinct; low: at most ``low_max`` values (an
    enum candidate); high otherwise. One aggregate pass over the table.
    """
    cd = F.count_distinct if exact else F.approx_count_distinct
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        aggs += [cd(c).alias(f"_d_{c}"), F.count(c).alias(f"_n_{c}")]
    a = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_d_{c}").alias("n_distinct"),
                              F.col(f"_n_{c}").alias("n_non_null")) for c in cols])
    r = a.select(F.col("_rows").alias("n_rows"), F.inline(rows))
    label = (F.when(F.col("n_distinct") == F.col("n_non_null"), F.lit("unique"))
             .when(F.col("n_distinct") <= F.lit(low_max), F.lit("low"))
             .otherwise(F.lit("high")))
    return r.withColumn("cardinality", label)


def key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q2: NOT NULL + uniqueness of a declared key, one row of counts.

    Two aggregates: per key (partial + final, skew-tolerant) and a global sum.
    """
    null_any = None
    for k in keys:
        e = F.col(k).isNull()
        null_any = e if null_any is None else (null_any | e)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if(null_any).alias("_nulls"))
    return per_key.agg(
        F.sum("_n").cast("bigint").alias("n_rows"),
        F.sum("_nulls").cast("bigint").alias("n_null_key_rows"),
        F.count_if(F.col("_n") > 1).alias("n_duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).cast("bigint").alias("n_extra_rows"),
    ).withColumn("is_valid", (F.col("n_null_key_rows") == 0) & (F.col("n_duplicate_keys") == 0))


def additivity_check(df: DataFrame, slice_col: str, who: str) -> DataFrame:
    """Q3: sum of per-slice distinct counts vs the overall distinct count.

    Both come from one pass over the distinct (slice, who) pairs: their count
    is the sum of per-slice distincts.
    """
    pairs = df.select(slice_col, who).where(F.col(who).isNotNull()).distinct()
    return pairs.agg(F.count(F.lit(1)).alias("sum_of_slices"), F.count_distinct(who).alias("overall")) \
        .withColumn("is_additive", F.col("sum_of_slices") == F.col("overall"))


def domain_check(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Q4: per distinct value, row count and whether it belongs to the enum."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "in_domain", F.coalesce(F.col(column).isin(list(allowed)), F.lit(False)))


def domain_quarantine(df: DataFrame, column: str, allowed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Q4: split rows into (valid, quarantined) by enum membership (NULL is quarantined)."""
    ok = F.coalesce(F.col(column).isin(list(allowed)), F.lit(False))
    return df.where(ok), df.where(~ok)


def domain_bounds(df: DataFrame, column: str) -> DataFrame:
    """Q5: min and max of a column."""
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def array_length_profile(df: DataFrame, array_col: str | Column) -> DataFrame:
    """Q6: histogram of array lengths (completeness of a reduced fact)."""
    a = F.col(array_col) if isinstance(array_col, str) else array_col
    return df.groupBy(F.size(a).alias("array_length")).agg(F.count(F.lit(1)).alias("n_rows"))
