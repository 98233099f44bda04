"""Connected components by alternating stars, with DataFrame joins.

Every round hangs the neighbours of a vertex on its smallest neighbour, so the depth of
the trees shrinks by half. Each round is written to the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillmill.durable import durable


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Neighbours of each vertex ``a`` on the smallest of them and itself."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = edges.join(least, "a")
    if larger:
        hung = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return hung.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, root`` of every id in the links ``a, b``; the root is the smallest id reached."""
    edges = durable(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, larger=True)
        edges = durable(_star(large.where("a > b"), larger=False), "stars")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("root"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(roots)
