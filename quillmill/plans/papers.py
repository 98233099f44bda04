"""Paper files and their metadata table to a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmill.operators.joins import join_paper_metadata
from quillmill.operators.limits import sample_exact, take_first
from quillmill.operators.records import paper_corpus, paper_record
from quillmill.sources.readers import read_paper_metadata, read_papers
from quillmill.sources.sinks import write_corpus, write_metadata, write_sample_texts

META_FIELDS = ["journal", "doi", "url", "publish_time"]


def papers(spark: SparkSession, root: str, limit: int | None = None, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(corpus, metadata)`` of the paper folders below ``root``.

    ``multi_line=False`` lets Spark split a large metadata.csv whose fields hold no line breaks.
    """
    found = take_first(read_papers(spark, root), limit, ["dir_ord", "file_path"])
    joined = join_paper_metadata(found, read_paper_metadata(spark, root, multi_line), ["file_path", "row_ord"], META_FIELDS)
    return paper_corpus(found), paper_record(joined)


def process_papers(spark: SparkSession, root: str, out: str, limit: int | None = None, multi_line: bool = True) -> None:
    """Write corpus and metadata.

    The two outputs need different fields of a paper, so each is its own pruned scan;
    nothing is cached.
    """
    corpus, metadata = papers(spark, root, limit, multi_line)
    write_corpus(corpus, f"{out}/cord19_processed/corpus", normalise=False)
    write_metadata(metadata, f"{out}/cord19_processed/metadata")


def sample_papers(spark: SparkSession, root: str, out: str, limit: int = 200, seed: int = 0) -> None:
    """Write an exact random sample of paper texts, one file each."""
    picked = sample_exact(read_papers(spark, root), "file_path", limit, seed)
    write_sample_texts(paper_corpus(picked), f"{out}/cord19_sample")
