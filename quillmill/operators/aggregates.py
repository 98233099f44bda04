"""Counts and plans; every aggregate combines on the map side first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def in_date_range(df: DataFrame, date_range: tuple[str, str] | None, col: str = "date") -> DataFrame:
    """Rows of the inclusive date range; all rows without a range."""
    if date_range is None:
        return df
    return df.where(F.col(col).between(F.lit(date_range[0]).cast("date"), F.lit(date_range[1]).cast("date")))


def daily_counts(df: DataFrame, date_range: tuple[str, str] | None = None, col: str = "date") -> DataFrame:
    """Rows per calendar date."""
    return in_date_range(df, date_range, col).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def batch_totals(ids: DataFrame, batch: int = 45_000, files: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """Row count and number of batches per file."""
    counts = ids.groupBy(*files).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("total_batches", F.ceil(F.col("n_rows") / F.lit(batch)).cast("int"))


def batch_plan(
    totals: DataFrame, max_batches: int | None = None, files: tuple[str, ...] = ("file_name",)
) -> DataFrame:
    """One row per planned batch of a file; files without rows plan nothing."""
    last = F.col("total_batches")
    if max_batches is not None:
        last = F.least(last, F.lit(max_batches))
    batches = F.when(last > 0, F.sequence(F.lit(0), last - 1))
    return totals.select(*files, F.explode(batches).alias("batch_id"))


def batch_log(plan: DataFrame, kept: DataFrame, files: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """Rows saved per planned batch; batches that saved nothing count 0."""
    key = [*files, "batch_id"]
    saved = kept.groupBy(*key).agg(F.count(F.lit(1)).alias("num_tweets_saved"))
    return plan.join(saved, key, "left").select(
        *key, F.coalesce("num_tweets_saved", F.lit(0)).cast("bigint").alias("num_tweets_saved")
    )


def export_summary(df: DataFrame, by: str = "source") -> DataFrame:
    """Documents per source."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
