"""Connected components of a graph that no machine could hold.

Large-star and small-star rounds turn any forest or graph into stars around the smallest vertex
of each component. A round is joins and aggregates over the edges only; its result is a written
table, so lost executors cost no earlier round.
"""

from pyspark.sql import functions as F

from tarmac.sources import stage


def _large_star(edges):
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges):
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select("a", F.col("m").alias("b"))
    )


def component_roots(edges):
    """(a, b): every vertex that is not a root, with the smallest vertex of its component.

    ``edges`` has long columns a and b, in any direction, repeated or not; loops say nothing.
    """
    edges = stage.keep(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == before or not now[0]:
            return edges
        before = now
        large = _large_star(edges).where("a <> b").distinct()
        edges = stage.keep(_small_star(large).where("a <> b").distinct(), "edges")
