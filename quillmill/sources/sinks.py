"""Writers. Each output is a folder of part files written by the tasks that hold the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, functions as F

from quillmill.functions.text import corpus_line, replace_linebreaks
from quillmill.operators.aggregates import in_date_range


def _replace(df: DataFrame, by: tuple[str, ...]) -> DataFrameWriter:
    """Writer that replaces the whole output, or with ``by`` just the written partitions."""
    writer = df.write.mode("overwrite")
    return writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by) if by else writer


def write_corpus(
    df: DataFrame, path: str, id: str = "id", text: str = "text", normalise: bool = True, by: tuple[str, ...] = ()
) -> None:
    """One line ``id<TAB>text`` per document, replacing an earlier export.

    ``normalise`` gives raw texts their one-line form; pass False for texts that have it.
    """
    body = replace_linebreaks(F.col(text)) if normalise else F.col(text)
    _replace(df.select(*by, corpus_line(F.col(id), body).alias("line")), by).text(path)


def write_metadata(
    df: DataFrame, path: str, sort_keys: bool = True, keep_nulls: bool = True, by: tuple[str, ...] = ()
) -> None:
    """One JSON record per line, keys sorted unless the column order is the contract."""
    columns = [c for c in df.columns if c not in by]
    columns = sorted(columns) if sort_keys else columns
    records = df.select(*by, *[f"`{c}`" for c in columns])
    _replace(records, by).option("ignoreNullFields", not keep_nulls).json(path)


def write_lengths(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """Headered CSV ``tweet_id,tweet_length``."""
    _replace(df.select(*by, "tweet_id", "tweet_length"), by).option("header", True).csv(path)


def write_skipped_ids(df: DataFrame, path: str, by: tuple[str, ...] = (), id: str = "id_str") -> None:
    """One skipped id per line.

    With ``by`` the batch's own partition is replaced, so a repeated run adds nothing
    twice; without it lines are appended.
    """
    lines = df.select(*by, F.col(id).cast("string").alias("line"))
    (_replace(lines, by) if by else lines.write.mode("append")).text(path)


def write_daily_partitions(df: DataFrame, path: str, date_range: tuple[str, str] | None = None, table: str = "table", order: tuple[str, ...] = ()) -> None:
    """Headered CSV files per day and, below a day, per input table.

    A day's file is what lies below its folder: tables that share a day add up, and a
    table that is written again replaces its own rows alone, also on days of the range
    that it has no longer. So a repeated run changes nothing. Rows are gathered per day so
    that a day has few files, and a day that holds very many rows is split again into
    files of bounded size. ``order`` names columns that are not written but give a day's
    rows their places in its files, the same in every run; without it rows have no order.
    """
    if "input" in df.columns:
        raise ValueError("the column input is the name of the folders of a table")
    days = in_date_range(df, date_range)
    before = _table_days(df, path, table, date_range)
    rows = days.withColumn("input", F.lit(table))
    rows = rows.orderBy("date", "input", *order).drop(*order) if order else rows.hint("rebalance", F.col("date"))
    _replace(rows, ("date", "input")).option("header", True).csv(path)
    if before:  # of an earlier run
        gone = before.keys() - {str(r["date"]) for r in days.select("date").distinct().collect()}
        for day in gone:
            folder = before[day]
            folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _table_days(df: DataFrame, path: str, table: str, date_range: tuple[str, str] | None) -> dict:
    """Folders that a table has, by day, within the range."""
    context = df.sparkSession.sparkContext
    pattern = context._jvm.org.apache.hadoop.fs.Path(f"{path}/date=*/input={table}")
    found = pattern.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(pattern)
    folders = {f.getPath().getParent().getName().removeprefix("date="): f.getPath() for f in found or []}
    first, last = date_range or ("0000", "9999")
    return {day: folder for day, folder in folders.items() if day[:1].isdigit() and str(first) <= day <= str(last)}


def write_sample_texts(df: DataFrame, path: str, id: str = "id", text: str = "text") -> None:
    """One text file per sampled document, below a folder named after its id."""
    df.select(F.col(id).alias("id"), F.col(text).alias("value")).write.mode("overwrite").partitionBy("id").text(path)
