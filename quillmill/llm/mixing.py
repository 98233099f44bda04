"""Mixing sources to target weights, with DataFrame functions only.

Each source's documents are put into a random order. A source that should give more than
it has is passed over several times, and the last pass ends where its target is reached.
The stream of a source is cut into blocks, a splitting tree deals the blocks out to the
output shards, and every shard is shuffled for itself.

The tree halves a range of shards again and again. Of the n blocks of a node a random
half goes left, so the number of each source's blocks there is drawn from the
multivariate hypergeometric distribution, and the quotas always add up exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillmill.durable import durable

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
BLOCKS_PER_SHARD = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, size``; one row per source.

    A source takes ``min(repeats * size, level * weight)``. The level, at which all
    targets together equal all sizes, is found on the sources in the order in which they
    reach their limit. Weights repeat along the sources by code point, null last.
    """
    sums = durable(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    whole = Window.partitionBy(F.lit(0))
    by_name = whole.orderBy(F.col("source").asc_nulls_last())
    by_limit = whole.orderBy("ratio", "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = (
        sums.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * float(repeats))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
    )
    before = F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = ranked.withColumn("level", (F.sum("source_size").over(whole) - before) / after)
    # rises while sources reach their limit and falls afterwards
    target = F.least(F.col("limit"), F.max("level").over(whole) * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"))


def plan_mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS, repeats: int = MAX_REPEATS, seed: int = 0) -> DataFrame:
    """``source, id, size, n, source_size, target, before, copies`` per document.

    ``copies`` says how often the mix takes the document, 0 to ``repeats`` times. A
    source's taken words differ from its target by at most half of its largest document.
    ``n`` rows that agree in source, id and size share one row and one decision. A null
    text has size 0; null sources are a source of their own; no rows give no rows.
    """
    rows = docs.select(F.col(source).alias("source"), F.col(id).alias("id"), word_count(F.col(text)).alias("size"))
    units = durable(rows.groupBy("source", "id", "size").agg(F.count(F.lit(1)).alias("n")), "mix-units")
    targets = durable(source_targets(units.select("source", (F.col("size") * F.col("n")).alias("size")), weights, repeats), "mix-targets")
    # range-sorted, so that a large source is spread over many tasks, then summed up by chunk
    ordered = units.withColumn("key", F.xxhash64(F.lit(seed), F.col("id"), F.col("size"))).orderBy("source", "key", "id", "size")
    stored = durable(ordered.withColumn("mid", F.monotonically_increasing_id()).withColumn("chunk", F.shiftright("mid", 33)), "mix-order")
    sums = stored.groupBy("source", "chunk").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shifts = durable(sums.select("source", "chunk", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("shift")), "mix-shifts")
    inside = Window.partitionBy("source", "chunk").orderBy("mid").rowsBetween(Window.unboundedPreceding, -1)
    local = stored.withColumn("local", F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0)))
    placed = _same(local, shifts, ["source", "chunk"]).withColumn("before", F.col("local") + F.col("shift"))
    known = _same(placed, targets, ["source"])
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(repeats))).otherwise(0).cast("int")
    rest = F.col("target") - passes * F.col("source_size")
    more = (passes < repeats) & (F.col("before") + F.col("size") * F.col("n") / 2 <= rest)
    return known.select("source", "id", "size", "n", "source_size", "target", "before", (passes + more.cast("int")).alias("copies"))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys are equal."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, same).drop(*[f"_r_{k}" for k in keys])


def split_blocks(targets: DataFrame, shards: int, blocks_per_shard: int = BLOCKS_PER_SHARD, seed: int = 0) -> DataFrame:
    """``source, blocks, block, shard``: the splitting tree over all blocks.

    A source gets blocks in proportion to its target, at least one if the target is not 0.
    """
    share = F.col("target") / F.sum("target").over(Window.partitionBy(F.lit(0)))
    blocks = F.greatest(F.lit(1), F.round(share * (shards * blocks_per_shard)).cast("int"))
    nodes = (
        targets.where("target > 0")
        .withColumn("blocks", blocks)
        .select("source", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        .select("*", F.lit(0).alias("lo"), F.lit(shards).alias("hi"))
    )
    for depth in range(max(shards - 1, 0).bit_length()):
        node = Window.partitionBy("lo", "hi")
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        left = F.round(F.count(F.lit(1)).over(node) * (middle - F.col("lo")) / (F.col("hi") - F.col("lo")))
        draw = F.row_number().over(node.orderBy(F.xxhash64(F.lit(seed), F.lit(depth), F.col("source"), F.col("block")), "source", "block"))
        dealt = nodes.withColumns({"middle": middle, "goes_left": draw <= left})
        single = F.col("hi") - F.col("lo") <= 1
        nodes = dealt.select(
            "source",
            "blocks",
            "block",
            F.when(single | F.col("goes_left"), F.col("lo")).otherwise(F.col("middle")).alias("lo"),
            F.when(single | ~F.col("goes_left"), F.col("hi")).otherwise(F.col("middle")).alias("hi"),
        )
    return nodes.select("source", "blocks", "block", F.col("lo").alias("shard"))


def draw_mix(plan: DataFrame, shards: int = 8, blocks_per_shard: int = BLOCKS_PER_SHARD, seed: int = 0) -> DataFrame:
    """One row per taken copy: ``source, id, size, n, turn, shard, place``.

    Blocks of a source are disjoint ranges of its stream. Order by ``place`` inside a
    shard for the local shuffle.
    """
    targets = plan.groupBy("source").agg(F.max("target").alias("target"))
    blocks = durable(split_blocks(targets, shards, blocks_per_shard, seed), "mix-blocks")
    counts = blocks.groupBy("source").agg(F.max("blocks").alias("blocks"))
    taken = plan.where("copies > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    counted = _same(taken, counts, ["source"])
    position = F.col("turn") * F.col("source_size") + F.col("before")
    block = F.least(F.col("blocks") - 1, F.floor(position * F.col("blocks") / F.col("target")).cast("int"))
    drawn = _same(counted.withColumn("block", block), blocks.drop("blocks"), ["source", "block"])
    place = F.xxhash64(F.lit(seed), F.col("shard"), F.col("turn"), F.col("id"))
    return drawn.select("source", "id", "size", "n", "turn", "shard", place.alias("place"))


def mix(docs: DataFrame, shards: int = 8, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0, **options) -> DataFrame:
    """The mixed rows with all columns of ``docs``, by shard and shuffled inside each.

    Rows are repeated as often as the mix takes them. Nulls and repeated rows as in
    ``plan_mix``; the frame is sorted by range, so a shard may span several tasks.
    """
    plan = durable(plan_mix(docs, id, text, source, seed=seed, **options), "mix-plan")
    drawn = draw_mix(plan, shards, seed=seed).drop("n")
    rows = docs.select(F.struct("*").alias("row"), F.col(source).alias("source"), F.col(id).alias("id"), word_count(F.col(text)).alias("size"))
    taken = _same(rows, drawn, ["id", "source", "size"])
    return taken.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place").select("row.*")
