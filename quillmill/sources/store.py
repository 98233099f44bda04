"""The post store (Parquet by source), the pages it rejected, and the ledger of finished batches."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.operators.filters import by_source
from quillmill.operators.joins import first_per_key, new_only
from quillmill.schemas import LEDGER, POSTS, REJECTS, REQUIRED_POST_FIELDS, SOURCES


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_posts(spark: SparkSession, path: str, source: str | None = None, known: tuple[str, ...] | None = SOURCES) -> DataFrame:
    """Stored posts; with ``source`` only that partition is read. An absent store is empty."""
    posts = _read_or_empty(spark, path, POSTS)
    return by_source(posts, source, known) if source else posts


def as_posts(df: DataFrame) -> DataFrame:
    """Rows in the store's schema; optional fields may be missing, required ones not.

    A null in a required field fails the job, as the store must not hold such a post.
    """

    def column(field):
        if field.name not in df.columns:
            c = F.current_timestamp() if field.name == "scrape_datetime" else F.lit(None)
        elif field.name in REQUIRED_POST_FIELDS:
            missing = F.raise_error(F.lit(f"post without {field.name}"))
            c = F.when(F.col(field.name).isNull(), missing).otherwise(F.col(field.name))
        else:
            c = F.col(field.name)
        return c.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in POSTS.fields])


def unseen(df: DataFrame, path: str, key: str = "url") -> DataFrame:
    """Rows whose URL is not stored yet. Cheap on raw pages, so it runs before extraction."""
    return df.join(read_posts(df.sparkSession, path).select(key), key, "left_anti")


def append_posts(df: DataFrame, path: str, order: tuple[str, ...] = ("id_custom",), all_unseen: bool = False) -> None:
    """Save posts whose URL is new; of repeats in the input the first along ``order``.

    ``all_unseen`` says that stored URLs were dropped before. A source with a large share
    of the rows is split over several files.
    """
    spark = df.sparkSession
    new = first_per_key(df, "url", list(order)) if all_unseen else new_only(df, read_posts(spark, path), list(order))
    as_posts(new).hint("rebalance", F.col("source")).write.mode("append").partitionBy("source").parquet(path)


def replace_rejects(rejected: DataFrame, path: str, stream: str, batch_id: int) -> None:
    """Write the rejects of one micro-batch in place of what it wrote before."""
    rows = rejected.select("source", "url", F.col("id_custom").cast("bigint").alias("id_custom"), "reason")
    rows.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch_id={batch_id}")


def read_rejects(spark: SparkSession, path: str, store: str | None = None) -> DataFrame:
    """``source, url, id_custom, reason`` of rejected pages, each once; an absent table is empty.

    A page that several streams rejected, as after the loss of a checkpoint, counts once.
    With ``store`` only pages whose URL has no post by now.
    """
    rows = _read_or_empty(spark, path, REJECTS).select("source", "url", "id_custom", "reason").distinct()
    return rows if store is None else unseen(rows, store).select(rows.columns)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Finished batches; an absent ledger is empty."""
    return _read_or_empty(spark, path, LEDGER)


def append_ledger(log: DataFrame, path: str) -> None:
    """Record finished batches."""
    log.select("dataset", "file_name", "batch_id", "num_tweets_saved", "num_ids", "ids_hash").write.mode("append").parquet(path)
