"""Connected components of a link table, all in Spark.

Alternates the large-star and small-star steps: every vertex hangs its larger
(then its smaller) neighbours onto its least neighbour, until the links are
stars around each component's least vertex. Each step is written to the shared
folder, so the lineage stays short and lost executors only redo one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.frames import staged


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = _least(links)  # links point from the larger to the smaller vertex
    pulled = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return pulled.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, component) of every vertex that has a link; the component is its least vertex."""
    links = staged(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .distinct(), "links")
    before = None
    while (state := _state(links)) != before:
        before = state
        links = staged(_small_star(_large_star(links)), "links")
    stars = links.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("vertex"), "component").distinct())
