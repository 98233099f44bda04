"""First-n, samples and per-file heads, all exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillmill.operators.positions import number_rows, unused

# A sort with limit ends in one task. This decides where the rows are cut, never which.
ONE_TASK_ROWS = 1_000


def tie_break(df: DataFrame, row: str | None = None) -> list[Column]:
    """A hash of all columns, so that rows with equal order keys have an order, too.

    Maps, which have no hash, are hashed as JSON. ``row`` names a struct that holds the
    columns of ``df`` in another frame.
    """

    def part(field) -> Column:
        value = F.col(f"`{field.name}`") if row is None else F.col(row).getField(field.name)
        kind = field.dataType.simpleString()
        return F.to_json(F.struct(value.alias("v"))) if "map<" in kind or "variant" in kind else value

    parts = [part(f) for f in df.schema.fields]
    return [F.xxhash64(*parts)] if parts else []


def take_first(df: DataFrame, n: int | None, order: list) -> DataFrame:
    """First ``min(n, total)`` rows along ``order``; all rows when ``n`` is None or 0.

    Order columns may have ties and any direction; ties are broken by a hash of the row.
    Few rows are sorted into one task, more are numbered where they lie. Both give the
    same rows, in no particular order.
    """
    if not n:
        return df
    keys = [*order, *tie_break(df)]
    if n <= ONE_TASK_ROWS:
        return df.orderBy(*keys).limit(n)
    (row,) = unused(df.columns, "_row")
    return number_rows(df, keys, name=row).where(F.col(row) < n).drop(row)


def sample_key(id: Column, seed: int | str) -> Column:
    """Reproducible random order of ids."""
    return F.md5(F.concat(F.lit(str(seed)), id.cast("string")).cast("binary"))


def sample_exact(df: DataFrame, id: str, n: int = 200, seed: int | str = 0) -> DataFrame:
    """Exactly ``min(n, total)`` rows without replacement, the same ones for a seed."""
    return take_first(df, n, [sample_key(F.col(id), seed), F.col(id)])


def head_per_file(df: DataFrame, k: int, order: list, file: str = "file_name", name: str = "pos") -> DataFrame:
    """First ``k`` rows of each file with their 0-based position.

    The rank filter is applied before the shuffle too, so a task sends at most ``k``
    rows per file however large the file is. A column that is already called ``name``
    is replaced.
    """
    (rank,) = unused(df.columns, "_rank")
    w = Window.partitionBy(file).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k).withColumn(name, F.col(rank) - 1).drop(rank)


def limit_frontier(urls: DataFrame, n: int | None) -> DataFrame:
    """First ``n`` links along (page number, position on the page)."""
    return take_first(urls, n, ["page_num", "pos"])


def sort_files(files: DataFrame) -> DataFrame:
    """File list in path order."""
    return files.orderBy("file_path")
