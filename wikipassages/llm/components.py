"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikipassages.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _with_least(edges: DataFrame) -> DataFrame:
    """Each edge with the least of its u and u's neighbours; counts are combined before the shuffle."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(id, component) for every id in ``links``; the component is its smallest id.

    Self links, nulls and repeated links are allowed (a null end is no link).
    Each round rewrites the links as written Parquet; the number of rounds
    grows with the logarithm of the longest chain. Nothing but one count and
    one checksum comes to the driver.
    """
    edges = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null")
    ids = _both_ways(edges).select("u").distinct()
    edges = written(edges.where("u != v").distinct(), "links")
    state = None
    while True:
        # repeated links change no minimum, so only what is written is made distinct
        large = _with_least(_both_ways(edges)).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        marked = _with_least(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        small = marked.select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(marked.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        edges = written(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    return ids.join(edges, "u", "left").groupBy(F.col("u").alias("id")) \
        .agg(F.least(F.coalesce(F.min("v"), F.first("u")), F.first("u")).alias("component"))
