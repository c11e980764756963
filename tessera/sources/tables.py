"""Table loaders and type normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Columnar Parquet read; column pruning and filters reach the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def with_session_timestamps(df: DataFrame) -> DataFrame:
    """Cast ``timestamp_ntz`` columns to session-zone ``timestamp``.

    Test Parquet files carry wall-clock timestamps; batch date arithmetic works
    on them directly, but an event-time watermark needs ``TimestampType``.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            cols.append(F.col(f.name).cast(T.TimestampType()).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def stream_glob(sf_dir: str, name: str) -> str:
    """Glob matching exactly one table file, for the file stream source (which needs a pattern or a folder)."""
    return f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet"
