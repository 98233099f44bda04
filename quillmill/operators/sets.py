"""Bag union of labelled frames and distinct links per index page."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def concat_labelled(frames: dict[str, DataFrame], label: str = "label") -> DataFrame:
    """All frames one after the other, each tagged with its name and its rank.

    Columns missing in one frame are null there. ``label_ord`` keeps the frame order.
    """
    tagged = [df.withColumn(label, F.lit(name)).withColumn("label_ord", F.lit(i)) for i, (name, df) in enumerate(frames.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_files(*frames: DataFrame) -> DataFrame:
    """Bag union of several scans; ``dir_ord`` keeps the order of the directories."""
    ranked = [df.withColumn("dir_ord", F.lit(i)) for i, df in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b), ranked)


def dedup_links(links: DataFrame) -> DataFrame:
    """Each URL once per source and index page, at its first position there."""
    first = links.groupBy("source", "page_num", "url").agg(F.min("pos").alias("pos"))
    return first.select("source", "page_num", "pos", "url")
