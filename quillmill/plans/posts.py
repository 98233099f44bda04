"""Labelled post tables to a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.functions.dates import iso_date, week_end_date
from quillmill.operators.filters import drop_containing_any
from quillmill.operators.positions import with_sequence
from quillmill.operators.records import labelled_post_record
from quillmill.sources.readers import read_posts_csv
from quillmill.sources.sinks import write_corpus, write_metadata

ORDER = ["label_ord", "file_path", "row_ord"]
ID_FORMAT = "reddit_%06d"


def labelled_posts(posts: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """Valid posts with ids and week-end dates.

    Ids are given after the filter and before the limit. ``id`` comes first; the order
    columns are dropped.
    """
    valid = drop_containing_any(posts, "post").withColumn("week", iso_date(week_end_date(F.col("week"))))
    return labelled_post_record(with_sequence(valid, order, ID_FORMAT, limit=limit).drop(*order))


def process_posts(spark: SparkSession, paths: dict[str, str], out: str, limit: int | None = None, normalise: bool = True, multi_line: bool = True) -> None:
    """Write corpus and metadata of labelled post tables, e.g. ``{"female": …, "male": …}``.

    Metadata keeps the input's column order. Posts are numbered in a stored frame, so
    both outputs carry the same ids.
    """
    posts = labelled_posts(read_posts_csv(spark, paths, multi_line=multi_line), ORDER, limit)
    write_corpus(posts, f"{out}/reddit_processed/corpus", text="content", normalise=normalise)
    write_metadata(posts.drop("content"), f"{out}/reddit_processed/metadata", sort_keys=False)
