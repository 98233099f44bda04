"""Resumable ingest: pages that arrive in a folder become posts with unique URLs, or rejects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.plans.articles import article_record
from quillmill.schemas import PAGES
from quillmill.sources.store import append_posts, replace_rejects, unseen


def source_posts(source: str) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """Page rows to posts and rejects by a source's rules; ``page_id`` is the article index."""
    return lambda pages: article_record(pages.withColumn("id_custom", F.col("page_id").cast("int")), source, stored=True)


def ingest_stream(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    extract: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    files_per_batch: int | None = None,
    rejects: str | None = None,
) -> None:
    """Append the pages that arrived since the last run, then stop.

    Each micro-batch is the batch ingest job. Repeats are found by joining with the
    store, not by stream state, so the state stays bounded; a micro-batch that is
    replayed after a failure finds its own posts in the store and adds nothing.

    ``rejects`` is a table of the pages that gave no post, with the reason. It is
    partitioned by stream and micro-batch, and a replayed micro-batch replaces its own
    part. A page whose URL has a post, stored before or from the same micro-batch, is no
    reject, so that a replay finds the same ones. See ``read_rejects``.
    """

    def ingest(pages: DataFrame, batch_id: int) -> None:
        posts, rejected = extract(unseen(pages, store))
        if rejects:
            lost = rejected.join(posts.select("url").distinct(), "url", "left_anti")
            stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
            replace_rejects(lost, rejects, stream, batch_id)
        append_posts(posts, store, all_unseen=True)

    reader = spark.readStream.schema(PAGES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(landing)
        .writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
