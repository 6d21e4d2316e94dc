"""Connected components over a table of edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noria.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges(a, b) -> (node, comp): comp is the smallest node reachable.

    Nodes without an edge, or only with one to themselves, are not returned;
    edges with a null end are no edges.  Every step is a hash aggregate and an
    equi-join written to the shared folder; nothing but two checksums reaches the
    driver.
    """
    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    now = edges.where("a is not null and b is not null and a <> b").select(u, v).distinct()
    now = scratch.cut(now, "edges")
    seen = _digest(now)
    while seen[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = scratch.cut(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        scratch.drop(now)
        now, was, seen = after, seen, _digest(after)
        if was == seen:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionAll(now.select("v", "v").distinct())


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
