"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.tables import written


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _minima(edges: DataFrame) -> DataFrame:
    """The least neighbour per node, written out, so that the join after it has plain exchanges on
    both sides and the links of a hub are split over tasks."""
    return written(edges.groupBy("u").agg(F.min("v").alias("m")), "minima")


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with a link; the root is the least node of its component.

    ``links`` has columns ``u`` and ``v`` of one orderable type.  Large-star and small-star rounds
    (Kiveris et al., 2014) in turn, until nothing changes: the number of links never grows, the
    number of rounds is logarithmic in practice, and only counts reach the driver.  Self links and
    repeated links do no harm; links with a null are dropped; no links give no rows.
    """
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = written(ordered.filter((F.col("u") != F.col("v")) & links["u"].isNotNull()
                                   & links["v"].isNotNull()).distinct(), "links")
    before = _signature(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _minima(both).select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
        large = written(
            both.filter(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("at"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter(F.col("u") != F.col("v")).distinct(), "large-star")
        least = _minima(large).select(F.col("u").alias("at"), "m")
        small = (large.join(least, F.col("u") == F.col("at"))
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("e")).select("e.u", "e.v"))
        edges = written(small.filter(F.col("u") != F.col("v")).distinct(), "small-star")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
