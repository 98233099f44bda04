"""Row numbers without a single-task sort, also when one group holds most rows.

A window over a whole file or table would put it into one task. Instead rows are
range-sorted by (group, order), so a hot group is spread over many tasks; each task
numbers its own rows, and small per-task counts give every task its starting number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillmill.durable import durable


def unused(columns: list[str], *names: str) -> list[str]:
    """The names with as many ``_`` behind them as it takes to clash with no column."""
    taken, found = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def _columns(names) -> list[Column]:
    return [F.col(f"`{n}`") if isinstance(n, str) else n for n in names]


def number_chunks(stored: DataFrame, groups: list[str], mid: str, chunk: str, name: str = "pos", start: int = 0) -> DataFrame:
    """Number rows of a *stored* frame whose chunks each hold consecutive values of ``mid``.

    The shifts, what to add to ``mid`` in each (group, chunk), are stored as well: their
    size is then known when the join is planned, so Spark broadcasts them when they are
    small and sorts and merges when they are not. A group has at most one row per chunk
    there, so the window sees as many rows as there were tasks, not the group's rows.
    """
    *own, c, first, n, shift = unused(stored.columns, *[f"_g{i}" for i in range(len(groups))], "_c", "_first", "_n", "_shift")
    keys = [F.col(f"`{g}`").alias(o) for g, o in zip(groups, own)]
    counts = stored.groupBy(*keys, F.col(chunk).alias(c)).agg(F.min(mid).alias(first), F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(*(own or [F.lit(0)])).orderBy(c).rowsBetween(Window.unboundedPreceding, -1)
    shifts = durable(counts.select(*own, c, (F.coalesce(F.sum(n).over(before), F.lit(0)) - F.col(first)).alias(shift)), "shifts")
    same = F.col(chunk) == F.col(c)
    for g, o in zip(groups, own):
        same = same & F.col(f"`{g}`").eqNullSafe(F.col(o))
    keep = [k for k in stored.columns if k not in (mid, chunk) and k.lower() != name.lower()]
    number = (F.col(mid) + F.col(shift) + start).cast("bigint").alias(name)
    return stored.join(shifts, same).select(*[f"`{k}`" for k in keep], number)


def number_rows(df: DataFrame, order: list, groups: list[str] | tuple[str, ...] = (), name: str = "pos", start: int = 0) -> DataFrame:
    """Consecutive numbers per group (or overall) along a total order.

    ``order`` must be unique within a group for a reproducible result. The sorted frame
    is written once to the checkpoint folder: range bounds come from a sample, so two
    passes over an unwritten sort could disagree. A column that is already called
    ``name`` is replaced; it may be part of the order or the groups.
    """
    groups = list(groups)
    mid, chunk = unused(df.columns, "_mid", "_chunk")
    ordered = df.orderBy(*_columns(groups), *_columns(order)).withColumn(mid, F.monotonically_increasing_id())
    stored = durable(ordered.withColumn(chunk, F.shiftright(mid, 33)), "numbered")
    return number_chunks(stored, groups, mid, chunk, name, start)


def with_position(df: DataFrame, order: list, file: str = "file_name", name: str = "pos") -> DataFrame:
    """0-based row position inside each input file."""
    return number_rows(df, order, [file], name)


def with_scan_position(
    df: DataFrame,
    files: tuple[str, ...] = ("file_name",),
    block: tuple[str, ...] = ("file_path", "block_start"),
    name: str = "pos",
    scan_id: str = "scan_id",
) -> DataFrame:
    """0-based row position inside each scanned file.

    ``df`` comes straight from a file scan, or has its row ids in ``scan_id``. A block
    is read by one task in file order, so its scan ids are consecutive unless rows were
    dropped; then the rows of each block are ranked, which a block's size bounds. Else
    only the per-block counts are combined. ``files`` may name a logical file of parts.
    """
    mid, chunk, rank, gaps = unused(df.columns, "_mid", "_chunk", "_rank", "gaps")
    at = F.col(scan_id) if scan_id in df.columns else F.monotonically_increasing_id()
    scanned = df.withColumn(mid, at).withColumn(chunk, F.struct(*block))
    stored = durable(scanned.drop("block_start", scan_id), "scanned")
    spans = stored.groupBy(*files, chunk).agg((F.max(mid) - F.min(mid) + 1 - F.count(F.lit(1))).alias(gaps))
    if not spans.where(F.col(gaps) != 0).isEmpty():
        ranked = F.row_number().over(Window.partitionBy(*files, chunk).orderBy(mid)).cast("bigint")
        stored = durable(stored.withColumn(rank, ranked).withColumn(mid, F.col(rank)).drop(rank), "ranked")
    return number_chunks(stored, list(files), mid, chunk, name)


def with_sequence(df: DataFrame, order: list, fmt: str = "%06d", name: str = "id", limit: int | None = None) -> DataFrame:
    """Formatted ids 1..N along ``order``, e.g. ``reddit_000001``; the first ``limit`` only.

    A column that is already called ``name`` is replaced.
    """
    (number,) = unused(df.columns, "_number")
    numbered = number_rows(df, order, name=number, start=1)
    if limit:
        numbered = numbered.where(F.col(number) <= limit)
    return numbered.select(F.format_string(fmt, F.col(number)).alias(name), *[f"`{c}`" for c in df.columns if c.lower() != name.lower()])


def with_batch_id(df: DataFrame, batch: int = 45_000, pos: str = "pos") -> DataFrame:
    """Batch number of a position: batch ``b`` holds positions ``[b·n, (b+1)·n)``."""
    return df.withColumn("batch_id", F.floor(F.col(pos) / F.lit(batch)).cast("int"))


def with_article_index(links: DataFrame, order: list, groups=("source",), name: str = "id_custom") -> DataFrame:
    """1-based index in each source's link list; later skipped pages leave gaps."""
    return number_rows(links, order, groups, name, start=1)


def processing_order(plan: DataFrame, max_batches: int | None = None, files: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """Batch-major order: batch 0 of every file, then batch 1, …"""
    if max_batches is not None:
        plan = plan.where(F.col("batch_id") < max_batches)
    return plan.orderBy("batch_id", *files)
