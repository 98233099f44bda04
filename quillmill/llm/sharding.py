"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

The permutation works on the smallest square m * m that holds all row numbers; numbers
that land outside are permuted again (cycle walking), so it is a bijection of the rows.
Shard and slot of a row follow from its number by arithmetic, without another shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from quillmill.operators.positions import number_rows, unused

ROUNDS = 6
#: A cycle leaves the rows for at most 2m - 2 steps, which is less than this up to 1,024
#: rows; above, under a sixteenth of the square is outside and no cycle comes near it.
WALKS = 64


def permuted(number: Column, rows: int, seed: int = 0) -> Column:
    """Place of a row number in ``[0, rows)`` under the permutation of ``seed``."""
    m = math.isqrt(max(rows - 1, 0)) + 1
    halves = lambda v: F.struct(F.floor(v / m).alias("l"), F.pmod(v, F.lit(m)).cast("bigint").alias("r"))

    def feistel(v: Column) -> Column:
        turn = lambda a, i: F.struct(a.r.alias("l"), F.pmod(a.l + F.pmod(F.xxhash64(a.r, i), F.lit(m)), F.lit(m)).cast("bigint").alias("r"))
        keys = F.array(*[F.lit(seed * ROUNDS + i).cast("bigint") for i in range(ROUNDS)])
        return F.aggregate(keys, halves(v), turn, lambda a: a.l * m + a.r)

    steps = F.sequence(F.lit(1), F.lit(WALKS))
    place = F.aggregate(steps, feistel(number.cast("bigint")), lambda v, _: F.when(v < rows, v).otherwise(feistel(v)))
    outside = F.raise_error(F.lit("a cycle of the permutation is longer than its walk")).cast("bigint")
    return F.element_at(F.transform(F.array(place), lambda v: F.when(v < rows, v).otherwise(outside)), 1)


def with_shards(df: DataFrame, order: list, shards: int = 8, seed: int = 0) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` and ``slot``.

    Rows are numbered along ``order``; rows that are equal in it must be equal
    altogether, as their numbers may be exchanged. Shards differ by one row at most and
    slots run from 0 without gaps. Nulls come first; no rows give no rows. Columns that
    have the names of the three are replaced; the order may use them.
    """
    numbered = number_rows(df, order, name="row_number")
    (place,) = unused(numbered.columns, "_place")
    placed = numbered.withColumn(place, permuted(F.col("row_number"), numbered.count(), seed))
    return placed.select(
        *[F.col(f"`{c}`") for c in numbered.columns if c.lower() not in ("shard", "slot")],
        F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col(place) / shards).cast("bigint").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Folders ``shard=k`` whose files hold the rows by slot.

    Shards are cut into ranges of slots, so none has to fit into one task.
    """
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
