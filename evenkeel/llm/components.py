"""Connected components of links by alternating star steps, in a few joins and aggregations a round."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.plans.staging import stage
from evenkeel.session import small_broadcasts


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``u, component`` for every ``u`` or ``v`` of the links (BIGINT): the smallest vertex it reaches.

    Every round hangs a vertex's larger neighbours, then its smaller ones, on the smallest it knows, until
    nothing changes; a hub is a partial minimum and a join that Spark may split.
    """
    with small_broadcasts(links.sparkSession):
        return _components(links)


def _components(links: DataFrame) -> DataFrame:
    edges = stage(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .filter("u <> v").distinct(), "edges")
    before = None
    while (mark := _mark(edges)) != before:
        before = mark
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = stage(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .filter("u <> v").distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
        edges = stage(small.filter("u <> v").distinct(), "edges")
    return edges.groupBy("u").agg(F.min("v").alias("component")).union(
        edges.select(F.col("v").alias("u"), F.col("v").alias("component")).distinct())
