"""Joins: first containing match, id lookup, new rows only, pending batches, file dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quillmill.durable import durable
from quillmill.functions.dates import iso_date, tweet_date
from quillmill.operators.limits import head_per_file

_SEPARATOR = r"[;\s]"


def join_paper_metadata(
    papers: DataFrame,
    meta: DataFrame,
    order: list[str],
    fields: list[str],
    id: str = "paper_id",
    sha: str = "sha",
) -> DataFrame:
    """Left join to the first metadata row whose ``sha`` text contains the paper id.

    "Contains" is turned into equality without comparing pairs: a text contains an id
    exactly when one of its substrings of that length is the id. So each listed item,
    once, gives its substrings of the lengths that occur among the ids, those that are
    an id stay, the first row of each is picked, and papers join on equality. What is
    sorted is thus the listed items and the hits, never the substrings.
    With ids of one length in a separated list this is one substring per listed id.
    Null ``sha`` never matches; papers without a match get nulls.
    """
    profile = papers.agg(
        F.struct(
            F.array_sort(F.collect_set(F.length(id))).alias("lengths"),
            # ids without a separator lie inside one listed item
            F.coalesce(F.bool_or(F.col(id).rlike(_SEPARATOR)), F.lit(False)).alias("whole"),
        ).alias("p")
    ).scalar()

    lengths, item = F.col("_p")["lengths"], F.col("_item")

    def substrings(n):
        starts = F.sequence(F.lit(1), F.length(item) - n + 1)
        return F.transform(starts, lambda i: F.substring(item, i, n))

    fitting = F.filter(lengths, lambda n: n <= F.length(item))
    # the usual case: all ids have the length of the listed item
    grams = F.when(lengths == F.array(F.length(item)), F.array(item)).otherwise(
        F.array_distinct(F.flatten(F.transform(fitting, substrings)))
    )
    items = F.when(F.col("_p")["whole"], F.array(sha)).otherwise(F.split(sha, _SEPARATOR + "+"))
    ranked = meta.where(F.col(sha).isNotNull()).withColumn("_p", profile)
    listed = ranked.select(F.explode(items).alias("_item"), F.struct(*order).alias("_order"), F.struct(*fields).alias("_fields"))
    # equal items have the same substrings, and the first of their rows stands for them all
    once = listed.groupBy("_item").agg(F.min_by(F.struct("_order", "_fields"), "_order").alias("_row"))
    candidates = once.withColumn("_p", profile).select(F.explode(grams).alias("_id"), "_row.*")
    hits = candidates.join(papers.select(F.col(id).alias("_id")).distinct(), "_id", "left_semi")
    first = hits.groupBy("_id").agg(F.min_by("_fields", "_order").alias("_fields"))
    joined = papers.join(first, papers[id] == first["_id"], "left")
    return joined.select(*[papers[c] for c in papers.columns], *[F.col("_fields")[f].alias(f) for f in fields])


# An id listed more often than this is looked up by several tasks.
ROWS_PER_TASK = 500_000


def hydrate(
    ids: DataFrame, tweets: DataFrame, distinct: bool = False, id: str = "id", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Ids with their tweet objects; ids without an object vanish.

    Repeated ids give repeated rows unless ``distinct``. Id rows are narrow, so a hot id
    looks small to the size-based skew split although each of its rows gets a whole
    tweet. Hot ids are therefore counted first, and only theirs are salted: the id rows
    over as many parts as needed, the one tweet copied to each part. The partition number
    is then given, as merging partitions by their small size would undo the salting.
    """
    if distinct:
        return ids.dropDuplicates([id]).join(tweets, id)
    counts = ids.groupBy(id).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_task)
    hot = durable(counts.select(id, F.ceil(F.col("_n") / F.lit(rows_per_task)).alias("_parts")), "hot")
    parts = hot.agg(F.sum("_parts")).first()[0]
    if not parts:
        return ids.join(tweets, id)
    others = [c for c in ids.columns if c != id]
    if not others:  # rows without any other column are counted instead, so that they can be told apart
        ids = ids.groupBy(id).agg(F.count(F.lit(1)).alias("_times")).withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")
        others = ["_nth"]
    spread = F.xxhash64(*others)
    salt = F.when(F.col("_parts").isNotNull(), F.pmod(spread, F.col("_parts"))).otherwise(0).cast("int")
    salts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)).cast("int") - 1)
    left = ids.join(hot, id, "left").withColumn("_salt", salt).drop("_parts")
    partitions = max(parts, int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    left = left.repartition(partitions, id, "_salt")
    right = tweets.join(hot, id, "left").withColumn("_salt", F.explode(salts)).drop("_parts")
    return left.join(right, [id, "_salt"]).drop("_salt", "_nth")


def first_per_key(df: DataFrame, key: str, order: list) -> DataFrame:
    """First row per key. The rank filter also runs before the shuffle, so a key with
    very many copies reaches its task as one row per map task."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def new_only(df: DataFrame, store: DataFrame, order: list, key: str = "url") -> DataFrame:
    """First row of each key that the store does not hold yet."""
    return first_per_key(df, key, order).join(store.select(key), key, "left_anti")


def pending_batches(plan: DataFrame, ledger: DataFrame, files: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """Planned batches without a ledger row."""
    key = [*files, "batch_id"]
    return plan.join(ledger.select(*key), key, "left_anti")


def date_id_files(
    ids: DataFrame,
    tweets: DataFrame,
    probe_rows: int = 100,
    order: list | None = None,
    prefix: str = "corona_tweets_",
    file: str = "file_name",
) -> DataFrame:
    """Date and new name per id file: the day of its first probed id with a tweet.

    Only the first ``probe_rows`` ids of a file are looked up. ``ids`` carries ``pos``,
    or ``order`` to find it. A file without any hit is reported with nulls.
    """
    probes = head_per_file(ids, probe_rows, order, file) if order else ids.where(F.col("pos") < probe_rows)
    day = tweet_date(F.col("created_at"))
    hits = probes.join(tweets.select("id", "created_at"), "id").groupBy(file).agg(F.min_by(day, F.col("pos")).alias("date"))
    files = ids.select(file).distinct()
    dated = files.join(hits, file, "left").withColumn("date", iso_date(F.col("date")))
    renamed = F.replace(F.col(file), F.lit(prefix), F.concat(F.col("date"), F.lit("_" + prefix)))
    return dated.select(file, "date", renamed.alias("new_name"))
