"""Tweet ids to a corpus: look ids up in a tweet archive, batch by batch, resumably."""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.durable import durable
from quillmill.functions.dates import tweet_date
from quillmill.functions.location import US_STATES, tweet_location
from quillmill.functions.text import token_count
from quillmill.functions.tweets import tweet_metadata
from quillmill.operators.aggregates import batch_log, batch_plan, batch_totals, daily_counts
from quillmill.operators.filters import split_retweets
from quillmill.operators.joins import date_id_files, first_per_key, hydrate
from quillmill.operators.positions import with_scan_position
from quillmill.schemas import LEDGER
from quillmill.sources.readers import parse_tweets, read_id_files, read_id_tsv, read_tweets, tweet_ids
from quillmill.sources.sinks import (
    write_corpus,
    write_daily_partitions,
    write_lengths,
    write_metadata,
    write_skipped_ids,
)
from quillmill.sources.store import append_ledger, read_ledger

BATCH_SIZE = 45_000
FILES = ("dataset", "file_name")
BATCH = (*FILES, "batch_id")


def split_id_table_by_day(spark: SparkSession, tsv: str, out: str, date_range: tuple[str, str] | None = None, table: str | None = None) -> DataFrame:
    """Add the 12-column id table to the folders of its days; returns its rows per day.

    Several tables may go to one ``out``. A table is known by its path, or by the name
    ``table``, and replaces what it wrote before. Rows of a day keep the table's order, so
    that ids of a table that is split again have the places that the ledger has seen.
    """
    rows = read_id_tsv(spark, tsv).withColumn("date", tweet_date(F.col("timestamp")))
    block = [F.col(f"_metadata.{c}").alias(f"_{c}") for c in ("file_path", "file_block_start")]
    placed = rows.select("*", *block, F.monotonically_increasing_id().alias("_line"))
    name = table or f"{re.sub('[^A-Za-z0-9.-]', '-', tsv.rstrip('/').rsplit('/', 1)[-1])}-{zlib.crc32(tsv.rstrip('/').encode()):08x}"
    write_daily_partitions(placed, out, date_range, name, ("_file_path", "_file_block_start", "_line"))
    return daily_counts(rows, date_range)


def id_file_dates(spark: SparkSession, dirs: list[str], archive: str, probe_rows: int = 100) -> DataFrame:
    """``(file_name, date, new_name)`` per id file; files are not renamed in place."""
    ids = read_id_files(spark, dirs)
    return date_id_files(ids, read_tweets(spark, archive), probe_rows, ["file_path", "block_start", "scan_id"])


def id_file_positions(spark: SparkSession, dirs: list[str]) -> DataFrame:
    return with_scan_position(read_id_files(spark, dirs), FILES)


def planned_batches(ids: DataFrame, batch: int = BATCH_SIZE, max_batches: int | None = None) -> DataFrame:
    """Every ``(dataset, file, batch)`` of unprocessed files; files without ids have none."""
    return batch_plan(batch_totals(ids, batch, FILES), max_batches, FILES)


def remaining_batches(ids: DataFrame, ledger: DataFrame, batch: int = BATCH_SIZE, max_batches: int | None = None) -> DataFrame:
    """``id, pos, dataset, file_name, batch_id`` of all ids that no finished batch held.

    The ledger says how many ids of a file its batches covered, from the file's start, and
    a checksum of them. The rest is cut into batches that follow the finished ones, so a
    file that grew or another batch size loses nothing. A file whose covered ids have
    changed is an error.
    """
    done = ledger.groupBy(*FILES).agg(F.sum("num_ids").alias("_covered"), F.sum(F.col("ids_hash").cast("decimal(38,0)")).alias("_hash"), (F.max("batch_id") + 1).alias("_next"))
    done = durable(done, "covered")
    placed = ids.join(done, list(FILES), "left")
    held = placed.where(F.col("pos") < F.col("_covered")).groupBy(*FILES).agg(F.count(F.lit(1)).alias("_n"), _checksum().alias("_now"))
    changed = done.join(held, list(FILES)).where((F.col("_n") != F.col("_covered")) | (F.col("_now") != F.col("_hash")))
    names = [r.file_name for r in changed.select("file_name").limit(5).collect()]
    if names:
        raise ValueError(f"ids that were already processed have changed in {names}; use a new ledger")
    left = placed.where(F.col("pos") >= F.coalesce("_covered", F.lit(0)))
    rest = F.col("pos") - F.coalesce("_covered", F.lit(0))
    numbered = left.withColumn("batch_id", F.coalesce("_next", F.lit(0)) + F.floor(rest / batch).cast("bigint"))
    if max_batches is not None:
        numbered = numbered.where(F.col("batch_id") < max_batches)
    return numbered.select("id", "pos", *BATCH)


def _checksum():
    # a remainder has at most 13 digits, so only the sum needs more than a long
    return F.sum((F.xxhash64("id", "pos") % F.lit(1 << 40)).cast("decimal(13,0)"))


def hydrate_batches(
    spark: SparkSession,
    dirs: list[str],
    archive: str,
    countries: DataFrame,
    out: str,
    ledger: str,
    batch: int = BATCH_SIZE,
    max_batches: int | None = None,
    states=tuple(US_STATES),
) -> DataFrame:
    """Process all batches the ledger does not hold; returns their log.

    All pending batches of all files run as one job. Outputs are partitioned by batch and
    replace their own partitions, and the ledger is written last: a run that broke off is
    simply run again.
    """
    ids = id_file_positions(spark, dirs)
    todo = durable(remaining_batches(ids, read_ledger(spark, ledger), batch, max_batches), "todo")
    pending = durable(todo.groupBy(*BATCH).agg(F.count(F.lit(1)).alias("num_ids"), _checksum().cast("bigint").alias("ids_hash")), "pending")
    if pending.isEmpty():
        return spark.createDataFrame([], LEDGER)

    # only the ids of the archive are parsed before the join; a repeated object counts once
    wanted = tweet_ids(spark, archive).join(todo.select("id").distinct(), "id", "left_semi")
    latest = first_per_key(wanted, "id", [F.desc("file_path"), F.desc("line_ord")]).select("id", "raw")
    # each found object is parsed once where it was looked up, and each kept one located once
    found = hydrate(todo, latest).drop("pos").withColumnRenamed("id", "_id")
    kept, skipped = split_retweets(parse_tweets(found).drop("_id"), stored=True)
    located = tweet_location(kept, countries, states)
    records = tweet_metadata(located, *BATCH, "id_str", token_count(F.col("full_text")).alias("tweet_length"))
    # gathered by batch, each output partition is written by one task as one file
    by_batch = [F.col(c) for c in BATCH]
    records = durable(records.hint("rebalance", *by_batch), "records")
    write_corpus(records, f"{out}/corpus", text="content", normalise=False, by=BATCH)
    write_metadata(records.drop("content", "id_str", "tweet_length"), f"{out}/metadata", by=BATCH)
    write_lengths(records.withColumnRenamed("id_str", "tweet_id"), f"{out}/lengths", by=BATCH)
    write_skipped_ids(skipped.select(*BATCH, "id_str").hint("rebalance", *by_batch), f"{out}/skipped_ids", by=BATCH)
    log = durable(batch_log(pending, records, FILES).join(pending, list(BATCH)), "log")
    append_ledger(log, ledger)
    return log.select(*BATCH, "num_tweets_saved")
