"""Exact deduplication by skew-safe combining, with DataFrame functions only.

Three stages: tasks combine their own rows (the map side of the first aggregate), salted
digest groups are merged, and the winners of all salts are combined. Every stage groups
by the digest *and* the full text, so texts are only equal when they are identical.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillmill.durable import durable
from quillmill.operators.limits import tie_break

SALTS = 64
#: A group of at least this share of all rows is hot; there can be no more than its inverse.
HOT_GROUPS = 10_000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def text_winners(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """``digest, text, keep_id, group_size`` of every distinct text of ``id, digest, text``.

    A text that fills a third of the table is first combined inside each task, so at most
    one row per task and salt is shuffled, to ``salts`` places.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    merged = salted.groupBy("digest", "salt", "text").agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("n"))
    return merged.groupBy("digest", "text").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per row of ``docs``: ``id, digest, keep_id, group_size, kept``.

    The largest id of equal texts stays. A null text counts as empty. Null ids come after
    all others; a group with null ids only has a null ``keep_id``. Of repeated rows with
    the winning id exactly one is kept. No rows give no rows. Further columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("id"), digest(body).alias("digest"), body.alias("text"))
    winners = text_winners(rows, salts)
    groups = durable(winners.drop("text"), "dedup-groups")
    if groups.groupBy("digest").count().where("count > 1").isEmpty():
        narrow = _with_winner(rows.drop("text"), groups)
    else:  # two texts share a digest: only the texts can tell them apart
        narrow = rows.join(winners, ["digest", "text"]).drop("text")
    first = F.row_number().over(Window.partitionBy("digest", "id").orderBy("keep_id")) == 1
    return narrow.select("id", "digest", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & first).alias("kept"))


def _with_winner(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Winner of each row by its digest; hot digests are looked up without a shuffle."""
    total = groups.agg(F.sum("group_size").alias("rows")).scalar()
    hot = groups.where(F.col("group_size") * HOT_GROUPS >= total)  # so at most HOT_GROUPS rows
    renamed = F.broadcast(hot.select(F.col("digest").alias("hot_digest"), F.col("keep_id").alias("hot_id"), F.col("group_size").alias("hot_size")))
    looked = rows.join(renamed, F.col("digest") == F.col("hot_digest"), "left")
    of_hot = looked.where("hot_size is not null").select("id", "digest", F.col("hot_id").alias("keep_id"), F.col("hot_size").alias("group_size"))
    rest = looked.where("hot_size is null").select("id", "digest").join(groups, "digest")
    return of_hot.unionByName(rest)


def drop_exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """The kept rows of ``docs`` with all their columns.

    Null texts, null ids and repeated rows as in ``exact_duplicates``. Of rows that agree
    in id and text a hash of all columns, maps included, decides.
    """
    winners = exact_duplicates(docs, id, text, salts).where("kept").select(F.col("id").alias("_keep"), F.col("digest").alias("_digest"))
    whole = docs.select(F.struct("*").alias("row"), F.col(id).alias("id"), sha256(F.coalesce(F.col(text), F.lit(""))).alias("digest"))
    kept = whole.join(winners, F.col("id").eqNullSafe(F.col("_keep")) & (F.col("digest") == F.col("_digest")), "left_semi")
    nth = F.row_number().over(Window.partitionBy("id", "digest").orderBy(*tie_break(docs, "row")))
    return kept.withColumn("nth", nth).where("nth = 1").select("row.*")
