"""Every operator run over the test tables.

Each query takes ``(spark, sf_dir)``, reads whole tables and returns a frame. Inputs in
the shapes the pipelines read (JSON objects, tag lists, id files) are derived from the
tables by Spark, so the work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillmill.durable import scratch_path
from quillmill.functions import dates, html as H, text as X
from quillmill.functions.location import tweet_location
from quillmill.functions.tweets import tweet_metadata
from quillmill.operators import aggregates as A, filters as FL, joins as J, limits as L, positions as W, records as R
from quillmill.operators.sets import concat_labelled, dedup_links, union_files
from quillmill.plans import articles, posts as post_plan, tweets as tweet_plan
from quillmill.plans.papers import META_FIELDS, process_papers
from quillmill.schemas import AUTHORS, JSON_LD
from quillmill.sources import readers, sinks, store
from quillmill.streaming.ingest import ingest_stream, source_posts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STAMP = "EEE MMM dd HH:mm:ss"
NOTICES = ("License", "license", "#DEBUG (start_removal)")
PHRASE = "MIT License"
ROOT = "https://www.example.org"
BATCH = 300


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark, sf):
    return table(spark, sf, "documents")


def _pages(spark, sf):
    return table(spark, sf, "pages")


# --- text ----------------------------------------------------------------------------


@query
def linebreaks(spark, sf):
    return _documents(spark, sf).select("doc_id", X.replace_linebreaks(F.col("text")).alias("line"))


@query
def transliterate(spark, sf):
    return _documents(spark, sf).select("doc_id", X.decode_unicode(F.col("text")).alias("ascii"))


@query
def transliterate_scripts(spark, sf):
    """Texts with Korean, Japanese, Greek and Cyrillic words put behind each word break."""
    mixed = F.replace("text", F.lit("\n"), F.lit("\n한국어 かな ガッコウ Москва λόγος "))
    return _documents(spark, sf).select("doc_id", X.decode_unicode(mixed).alias("ascii"))


@query
def transliterate_all_scripts(spark, sf):
    """Texts with words of ten more scripts, a table of Chinese readings, and what is lost."""
    words = "שלום سلام नमस्ते বাংলা ไทย თბილისი Հայ 汉字 ₹५ ᚠᛇ "
    mixed = F.concat(F.lit(words), F.replace("text", F.lit("\n"), F.lit("\n" + words)))
    readings = {"汉": "Han ", "字": "Zi "}
    return _documents(spark, sf).select("doc_id", X.decode_unicode(mixed, readings).alias("ascii"), X.lost_characters(mixed, readings).alias("lost"))


@query
def transliterate_record(spark, sf):
    return X.decode_unicode_record(table(spark, sf, "conversations"))


@query
def token_lengths(spark, sf):
    count = X.token_count(F.col("text")).alias("tweet_length")
    return _documents(spark, sf).select(F.col("doc_id").alias("tweet_id"), count)


@query
def words_no_punct(spark, sf):
    words = F.array_join(X.tokens_no_punct(F.col("text")), " ")
    return table(spark, sf, "conversations").select("conv_id", "turn", words.alias("words"))


@query
def drop_lines(spark, sf):
    return _documents(spark, sf).select("doc_id", X.drop_lines(F.col("text"), PHRASE).alias("body"))


@query
def doc_ids(spark, sf):
    number, source, lang = F.col("doc_id"), F.col("source"), F.col("lang")
    return _documents(spark, sf).select(
        "doc_id",
        X.doc_id(number, source).alias("id"),
        X.doc_id(number, source, lang).alias("user_id"),
        X.record_file_name(number, source).alias("file_name"),
    )


@query
def batch_names(spark, sf):
    name = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("_"), F.col("event_type"), F.lit(".csv"))
    batch = F.floor(F.col("event_id") / 1000).cast("int")
    return table(spark, sf, "events").select(
        "event_id",
        X.batch_file_name(name, batch, "txt").alias("corpus_file"),
        X.batch_file_name(name, batch, "json").alias("metadata_file"),
        X.batch_file_name(name, batch, "csv").alias("lengths_file"),
    )


@query
def split_tags(spark, sf):
    parts = X.split_tags(F.col("text"), ", ")
    return _documents(spark, sf).select("doc_id", F.size(parts).alias("n"), F.array_join(parts, "|").alias("tags"))


@query
def distinct_words(spark, sf):
    return _documents(spark, sf).select("doc_id", X.distinct_join(F.split("text", " ")).alias("words"))


# --- dates ---------------------------------------------------------------------------


@query
def week_end(spark, sf):
    week = (F.col("user_id") % 60 - 8).cast("int")
    day = dates.iso_date(dates.week_end_date(F.col("week")))
    return table(spark, sf, "events").select("event_id", week.alias("week")).select("*", day.alias("publication_date"))


@query
def tweet_dates(spark, sf):
    # an offset of +0500 must not move the day
    stamp = F.concat(F.date_format("ts", STAMP), F.lit(" +0500 "), F.date_format("ts", "yyyy"))
    return table(spark, sf, "events").select("event_id", dates.iso_date(dates.tweet_date(stamp)).alias("date"))


@query
def article_dates(spark, sf):
    ts = F.col("ts")
    spelled = (
        F.when(F.col("event_type") == "view", F.date_format(ts, "EEEE, MMMM d, yyyy"))
        .when(F.col("event_type") == "click", F.date_format(ts, "d MMM yyyy"))
        .when(F.col("event_type") == "error", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_type") == "signup", F.date_format(ts, "d MMMM yyyy 'at' h:mm a"))
        .otherwise(F.lit("no date"))
    )
    return table(spark, sf, "events").select("event_id", dates.iso_date(dates.article_date(spelled)).alias("date"))


# --- papers --------------------------------------------------------------------------


def _paragraphs(lines: Column) -> Column:
    """Text lines as paragraphs; a line's first word stands for its section name."""
    return F.transform(
        lines, lambda s: F.struct(F.substring_index(s, " ", 1).alias("section"), s.alias("text"))
    )


def _paper_rows(spark, sf) -> DataFrame:
    """Documents in the shape of papers: first line title, second abstract, rest body."""
    lines = F.split("text", "\n")
    words = F.filter(F.split(lines[0], " "), lambda w: w != "")
    authors = F.transform(
        words,
        lambda w: F.struct(
            F.substring(w, 1, 1).alias("first"),
            F.substring(w, 2, 1).alias("last"),
            F.when(
                F.length(w) > 2,
                F.struct(F.struct(F.concat(F.lit(" "), F.substring(w, 1, 2)).alias("country")).alias("location")),
            ).alias("affiliation"),
        ),
    )
    abstract = F.when(F.size(lines) > 1, _paragraphs(F.slice(lines, 2, 1)))
    body = _paragraphs(F.slice(lines, F.lit(3), F.size(lines)))
    return _documents(spark, sf).select(
        F.format_string("%06d", "doc_id").alias("paper_id"),
        F.struct(lines[0].alias("title"), authors.alias("authors")).alias("metadata"),
        abstract.alias("abstract"),
        body.alias("body_text"),
    )


@query
def paper_corpus(spark, sf):
    return R.paper_corpus(_paper_rows(spark, sf))


@query
def processed_papers(spark, sf):
    """Paper files and metadata.csv written from the tables, processed, and both outputs read back."""
    root, out = scratch_path(spark, "papers"), scratch_path(spark, "papers-out")
    id = F.format_string("%06d", "doc_id")
    paragraph = F.array(F.struct(F.col("lang").alias("section"), F.col("text").alias("text")))
    paper = F.struct(id.alias("paper_id"), F.struct(F.col("source").alias("title"), F.array().cast(AUTHORS).alias("authors")).alias("metadata"), paragraph.alias("body_text"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    for k, name in enumerate(readers.PAPER_DIRS):
        files = _documents(spark, sf).where(half == k).select(F.pmod(F.xxhash64("doc_id"), F.lit(64)).alias("file"), paper.alias("p"))
        listed = files.groupBy("file").agg(F.to_json(F.collect_list("p")).alias("value")).select("value")
        listed.write.option("maxRecordsPerFile", 1).text(f"{root}/{name}")
    sha = F.format_string("%06d", "doc_id")
    table(spark, sf, "labels").select(
        F.concat(F.lit("x; "), sha).alias("sha"),
        F.concat(F.lit("journal "), F.col("quality").cast("string")).alias("journal"),
        F.lit(None).cast("string").alias("doi"),
        F.concat(F.lit("https://doi.example.org/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit("2020-03-01").alias("publish_time"),
    ).write.option("header", True).csv(f"{root}/metadata.csv")
    process_papers(spark, root, out, multi_line=False)
    lines = spark.read.text(f"{out}/cord19_processed/corpus").select(F.substring_index("value", "\t", 1).alias("id"), F.col("value").alias("line"))
    records = spark.read.schema("id string, title string, journal string, url string").json(f"{out}/cord19_processed/metadata")
    return lines.join(records, "id").drop("id")


@query
def paper_records(spark, sf):
    # half of the labels name two papers in one list, as the metadata table does
    sha = F.concat(F.format_string("%06d", "doc_id"), F.lit("; "), F.format_string("%06d", F.col("doc_id") + 1))
    meta = table(spark, sf, "labels").select(
        "doc_id",
        sha.alias("sha"),
        F.concat(F.lit("journal "), F.col("quality").cast("string")).alias("journal"),
        F.concat(F.lit("10.1/"), F.col("doc_id").cast("string")).alias("doi"),
        F.concat(F.lit("https://doi.example.org/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit("2020-03-01").alias("publish_time"),
    )
    return R.paper_record(J.join_paper_metadata(_paper_rows(spark, sf), meta, ["doc_id"], META_FIELDS))


@query
def paper_metadata_join(spark, sf):
    papers = table(spark, sf, "supplier").select(F.col("s_name").alias("paper_id"))
    sha = F.format_string("Supplier#%09d; Supplier#%09d", "l_suppkey", "l_partkey")
    fields = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    meta = table(spark, sf, "lineitem").select(sha.alias("sha"), *fields)
    return J.join_paper_metadata(papers, meta, fields, fields)


@query
def contained_names(spark, sf):
    # ids of several lengths, each contained in longer ones: NATION_1 in NATION_10
    papers = table(spark, sf, "nation").select(F.col("n_name").alias("paper_id"))
    customer = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    meta = customer.join(table(spark, sf, "nation"), "n_nationkey").select(F.concat("n_name", F.lit("/"), "c_name").alias("sha"), "c_custkey")
    return J.join_paper_metadata(papers, meta, ["c_custkey"], ["c_custkey"])


@query
def headings_once(spark, sf):
    return R.headings_once_rows(table(spark, sf, "conversations"), ["conv_id"], "turn", "role", "text")


# --- posts ---------------------------------------------------------------------------


@query
def removed_posts(spark, sf):
    return FL.drop_containing_any(_documents(spark, sf), "text", NOTICES).select("doc_id", "source")


@query
def sequence_ids(spark, sf):
    docs = _documents(spark, sf).select(F.col("doc_id").alias("row_id"), "text")
    bench = table(spark, sf, "benchmark").select(F.col("item_id").alias("row_id"), "text")
    frames = concat_labelled({"document": docs, "benchmark": bench}, "kind")
    valid = FL.drop_containing_any(frames, "text", NOTICES)
    return W.with_sequence(valid, ["label_ord", "row_id"], "reddit_%06d").select("id", "kind", "row_id")


@query
def labelled_posts(spark, sf):
    """The post pipeline over CSV files written from the documents."""
    label_paths = {}
    for label, kind in (("female", F.col("lang") == "en"), ("male", F.col("lang") != "en")):
        rows = _documents(spark, sf).where(kind).select(
            (F.col("n_chars") % 50).cast("int").alias("week"),
            F.concat("text", F.when(F.col("source") == "src3", F.lit(" (#start_removal)")).otherwise(F.lit(""))).alias("post"),
            (F.col("n_chars") / 8).alias("V"),
            (F.col("n_chars") / 16).alias("std(V)"),
            "doc_id",
        )
        label_paths[label] = scratch_path(spark, "posts")
        rows.orderBy("doc_id").write.options(header=True, escape='"').csv(label_paths[label])
    found = post_plan.labelled_posts(readers.read_posts_csv(spark, label_paths), post_plan.ORDER)
    line = X.replace_linebreaks(F.col("content"))
    return found.select(
        "id", "publication_date", line.alias("line"), "valance", F.col("`std(valance)`").alias("std_valance"), "doc_id", "gender"
    )


# --- tweets --------------------------------------------------------------------------


def _location_text() -> Column:
    """Free-text locations of several kinds, chosen by market segment."""
    code = F.char(F.lit(65) + F.col("c_nationkey"))
    return (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("near "), F.col("n_name"), F.lit(" town")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit("Austin, TX."))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("London, UK "), F.concat(F.lit("Q"), code)))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("xx ("), F.lit("QZ"), code, F.lit(") uk")))
        .otherwise(F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.concat(F.lit("the Q"), code, F.lit("."))))
    )


def _countries(spark, sf) -> DataFrame:
    code = F.char(F.lit(65) + F.col("n_nationkey"))
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("ord"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("Q"), code).alias("alpha2"),
        F.concat(F.lit("QZ"), code).alias("alpha3"),
    )


def _customers(spark, sf) -> DataFrame:
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return table(spark, sf, "customer").join(nation, "c_nationkey")


def _raw_tweets(spark, sf) -> DataFrame:
    """Events as tweet objects: errors and sign-ups are retweets, views have a place."""
    events = table(spark, sf, "events")
    author = _customers(spark, sf).withColumn("loc", _location_text())
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    body = F.struct(
        F.col("event_id").alias("id"),
        F.col("event_id").cast("string").alias("id_str"),
        F.concat(kind, F.lit("\n"), F.col("props"), F.lit("  end")).alias("full_text"),
        F.concat(F.date_format("ts", STAMP), F.lit(" +0000 "), F.date_format("ts", "yyyy")).alias("created_at"),
        F.lit("en").alias("lang"),
        F.col("user_id").alias("favorite_count"),
        k.cast("bigint").alias("retweet_count"),
        F.when(kind == "click", F.col("event_id") - 1).alias("in_reply_to_status_id"),
        F.when(kind == "click", F.col("user_id")).alias("in_reply_to_user_id"),
        F.when(kind == "view", F.struct(F.col("n_name").alias("country"))).alias("place"),
        F.struct(
            F.array(F.struct(kind.alias("text")), F.struct(k.alias("text"))).alias("hashtags"),
            F.array(F.struct(F.concat(F.lit(ROOT + "/"), k).alias("expanded_url"))).alias("urls"),
            F.array(F.struct(F.col("user_id").alias("id"))).alias("user_mentions"),
        ).alias("entities"),
        F.struct(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("loc").alias("location"),
            (F.col("user_id") * 3).alias("followers_count"),
            F.col("user_id").alias("statuses_count"),
            (F.col("user_id") > 75).alias("verified"),
        ).alias("user"),
    )
    extra = F.when(kind == "error", F.lit(',"retweeted_status":null}')).when(kind == "signup", F.lit(',"retweeted_status":{"id":1}}'))
    raw = F.to_json(body)
    raw = F.coalesce(F.concat(F.expr("substring(raw, 1, length(raw) - 1)"), F.col("extra")), F.col("raw"))
    joined = events.join(author, events["user_id"] == author["c_custkey"])
    made = FL.extracted(joined, {"raw": F.to_json(body), "extra": extra})
    return FL.extracted(made, {"raw": raw})


@query
def retweet_split(spark, sf):
    kept, skipped = FL.split_retweets(readers.parse_tweets(_raw_tweets(spark, sf)))
    tagged = [df.select("id_str", F.lit(name).alias("part")) for name, df in (("kept", kept), ("skipped", skipped))]
    return tagged[0].unionByName(tagged[1])


@query
def tweet_records(spark, sf):
    tweets = readers.parse_tweets(_raw_tweets(spark, sf))
    out = tweet_metadata(tweet_location(tweets, _countries(spark, sf)))
    lists = {c: F.array_join(F.col(c).cast("array<string>"), "|") for c in ("hashtags", "urls", "user_mentions")}
    return out.withColumns(lists)


@query
def tweet_locations(spark, sf):
    user = _customers(spark, sf).select("c_custkey", F.struct(_location_text().alias("location")).alias("user"))
    rows = user.withColumn("place", F.lit(None).cast("struct<country:string>"))
    return tweet_location(rows, _countries(spark, sf)).select("c_custkey", "location")


@query
def hydrate(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey")
    archive = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), "s_name")
    return J.hydrate(ids, archive)


@query
def hydrate_distinct(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    archive = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), "s_name")
    return J.hydrate(ids, archive, distinct=True)


@query
def daily_counts(spark, sf):
    return A.daily_counts(table(spark, sf, "events").select(F.to_date("ts").alias("date"))).select(
        dates.iso_date(F.col("date")).alias("date"), "n"
    )


def _id_rows(spark, sf) -> DataFrame:
    """Events as id files: one file per event type, rows in event order."""
    return table(spark, sf, "events").select(F.col("event_type").alias("file_name"), F.col("event_id").alias("id"), "value")


def _batched(spark, sf) -> DataFrame:
    return W.with_batch_id(W.with_position(_id_rows(spark, sf), ["id"]), BATCH)


def _ledger(spark, sf) -> DataFrame:
    """Finished batches as far as labels name them: batches 0 and 1 of some files."""
    done = table(spark, sf, "labels").groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"))
    name = F.when(F.col("toxic") == 1, F.lit("view")).otherwise(F.lit("click"))
    return done.select(name.alias("file_name"), F.col("quality").cast("int").alias("batch_id"))


@query
def positions(spark, sf):
    return _batched(spark, sf).select("file_name", "id", "pos", "batch_id")


@query
def batch_plan(spark, sf):
    return A.batch_totals(_id_rows(spark, sf), BATCH)


@query
def pending_batches(spark, sf):
    return J.pending_batches(A.batch_plan(A.batch_totals(_id_rows(spark, sf), BATCH)), _ledger(spark, sf))


@query
def batch_log(spark, sf):
    plan = A.batch_plan(A.batch_totals(_id_rows(spark, sf), BATCH))
    kept = _batched(spark, sf).where(F.col("value") < 2)
    return A.batch_log(plan, kept)


@query
def id_column(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))


@query
def file_order(spark, sf):
    path = F.concat(F.lit("ids/"), "lang", F.lit("/"), "source", F.lit(".csv")).alias("file_path")
    files = L.sort_files(_documents(spark, sf).select(path).distinct())
    return W.number_rows(files, ["file_path"], name="rank", start=1)


@query
def file_union(spark, sf):
    docs = _documents(spark, sf).select(F.col("doc_id").alias("row_id"), "text")
    return union_files(docs, table(spark, sf, "benchmark").select(F.col("item_id").alias("row_id"), "text"))


@query
def processing_order(spark, sf):
    plan = A.batch_plan(A.batch_totals(_id_rows(spark, sf), BATCH))
    ordered = W.processing_order(plan)
    return W.number_rows(ordered, ["batch_id", "file_name"], name="step", start=1)


@query
def head_per_file(spark, sf):
    return L.head_per_file(_id_rows(spark, sf), 100, ["id"]).select("file_name", "id", "pos")


@query
def file_dates(spark, sf):
    ids = _id_rows(spark, sf).withColumn("file_name", F.concat(F.lit("corona_tweets_"), "file_name", F.lit(".csv")))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("doc_id").cast("int"))
    stamp = F.concat(F.date_format(day, "EEE MMM dd"), F.lit(" 00:00:00 +0000 "), F.date_format(day, "yyyy"))
    archive = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), stamp.alias("created_at"))
    return J.date_id_files(ids, archive, 100, ["id"])


@query
def hydrate_batches(spark, sf):
    """The whole tweet job: id table by day, batches, look-up, four outputs, ledger.

    Run twice; the second run finds nothing pending.
    """
    tsv, ids, archive, out, ledger = (scratch_path(spark, n) for n in ("tsv", "ids", "archive", "tweets", "ledger"))
    stamp = F.concat(F.date_format("ts", STAMP), F.lit(" +0000 "), F.date_format("ts", "yyyy"))
    blank = [F.lit(None).cast("string").alias(c) for c in "followers friends retweets favorites entities sentiment mentions hashtags urls".split()]
    events = table(spark, sf, "events")
    events.select("event_id", F.col("user_id").alias("username"), stamp.alias("timestamp"), *blank).write.option("sep", "\t").csv(tsv)
    _raw_tweets(spark, sf).write.text(archive)
    tweet_plan.split_id_table_by_day(spark, tsv, ids)
    for _ in range(2):
        tweet_plan.hydrate_batches(spark, [ids], archive, _countries(spark, sf), out, ledger, batch=2_000)
    lines = spark.read.text(f"{out}/corpus").select("file_name", F.col("value").alias("line"), F.lit("corpus").alias("output"))
    lengths = spark.read.schema("tweet_id string, tweet_length string").option("header", True).csv(f"{out}/lengths")
    lengths = lengths.select("file_name", F.concat("tweet_id", F.lit("\t"), "tweet_length").alias("line"), F.lit("lengths").alias("output"))
    skipped = spark.read.text(f"{out}/skipped_ids").select("file_name", F.col("value").alias("line"), F.lit("skipped").alias("output"))
    log = store.read_ledger(spark, ledger).groupBy("file_name").agg(F.sum("num_tweets_saved").cast("string").alias("line"))
    return lines.unionByName(lengths).unionByName(skipped).unionByName(log.withColumn("output", F.lit("ledger")))


def _event_files(spark, sf, path: str) -> None:
    """Events as id files of four layouts: id first, id third, quoted, and no header."""
    events = table(spark, sf, "events").where("event_type <> 'error'").orderBy("event_id")
    id, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    layouts = {
        "view": (["id", "user"], [id, user]),
        "click": (["user", "text", "id"], [user, F.lit("a, b"), id]),
        "purchase": (["user", "id"], [user, id]),
        "signup": (None, [id, F.lit("0.5")]),
    }
    for kind, (names, columns) in layouts.items():
        rows = events.where(F.col("event_type") == kind).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)])
        named = rows.toDF(*names) if names else rows
        named.write.options(header=bool(names), quoteAll=kind == "purchase").csv(f"{path}/{kind}")


@query
def id_files(spark, sf):
    """Ids found by name or place in files of all layouts, and lines without one."""
    path = scratch_path(spark, "id-files")
    _event_files(spark, sf, path)
    table(spark, sf, "labels").select(F.concat(F.lit("no id "), "doc_id")).write.text(f"{path}/broken")
    found = readers.read_id_files(spark, [path]).select("dataset", "id", F.lit(True).alias("valid"))
    broken = readers.rejected_id_lines(spark, [path]).select("dataset", F.replace("line", F.lit("no id "), F.lit("")).cast("bigint").alias("id"), F.lit(False).alias("valid"))
    return found.unionByName(broken)


@query
def resumed_batches(spark, sf):
    """Batches of one size for a start, then other files, other sizes and repeated splits."""
    tsv, ids, archive, out, ledger = (scratch_path(spark, n) for n in ("tsv", "ids", "archive", "tweets", "ledger"))
    stamp = F.concat(F.date_format("ts", STAMP), F.lit(" +0000 "), F.date_format("ts", "yyyy"))
    blank = [F.lit(None).cast("string").alias(c) for c in "followers friends retweets favorites entities sentiment mentions hashtags urls".split()]
    events = table(spark, sf, "events")
    events.select("event_id", F.col("user_id").alias("username"), stamp.alias("timestamp"), *blank).orderBy("event_id").write.option("sep", "\t").csv(tsv)
    _raw_tweets(spark, sf).union(_raw_tweets(spark, sf)).write.text(archive)  # every object twice
    countries = _countries(spark, sf)
    for days, batch, most in ((("2024-01-01", "2024-01-10"), 50, 2), (None, 1_000, None), (None, 70, None)):
        tweet_plan.split_id_table_by_day(spark, tsv, ids, days) if most or batch == 1_000 else None
        tweet_plan.hydrate_batches(spark, [ids], archive, countries, out, ledger, batch=batch, max_batches=most)
    saved = store.read_ledger(spark, ledger).groupBy("file_name").agg(F.sum("num_ids").alias("ids"), F.sum("num_tweets_saved").alias("saved"))
    lines = spark.read.text(f"{out}/corpus").groupBy("file_name").agg(F.count(F.lit(1)).alias("lines"), F.countDistinct("value").alias("texts"))
    return saved.join(lines, "file_name")


# --- limits and counts ---------------------------------------------------------------


@query
def first_n(spark, sf):
    return L.take_first(_documents(spark, sf), 50, ["n_chars", "doc_id"]).select("doc_id", "n_chars")


_LINES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query
def first_n_many(spark, sf):
    """Long prefix along a key with ties; the further columns decide among them."""
    return L.take_first(table(spark, sf, "lineitem"), 20_000, _LINES).select(*_LINES)


@query
def first_n_descending(spark, sf):
    order = [F.desc("l_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return L.take_first(table(spark, sf, "lineitem"), 15_000, order).select(*_LINES)


@query
def sample_n(spark, sf):
    return L.sample_exact(_documents(spark, sf), "doc_id", 200, seed=7).select("doc_id", "source")


@query
def summary(spark, sf):
    return A.export_summary(_documents(spark, sf))


@query
def by_source(spark, sf):
    return FL.by_source(_documents(spark, sf), "SRC7", known=None).select("doc_id", "source", "lang")


@query
def survey_pages(spark, sf):
    return FL.drop_survey_pages(_documents(spark, sf), "text", PHRASE).select("doc_id")


@query
def url_prefix(spark, sf):
    return FL.exclude_url_prefix(_pages(spark, sf), "https://blog.").select("page_id", "url")


@query
def new_only(spark, sf):
    docs = _documents(spark, sf)
    stored = docs.where(F.col("source") == "src0")
    return J.new_only(docs.where(F.col("source") != "src0"), stored, ["doc_id"], key="text").select("doc_id", "source")


@query
def drop_empty_fields(spark, sf):
    joined = _documents(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    german = F.col("lang") == "de"
    record = joined.select(
        F.col("doc_id").alias("id"),
        F.when(german, F.lit("")).otherwise(F.col("source")).alias("author"),
        F.when(german, F.lit("")).otherwise(F.col("lang")).alias("description"),
        F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(F.array().cast("array<string>")).alias("tags"),
        F.col("quality"),
    )
    return R.drop_empty_fields(record).withColumn("tags", F.array_join("tags", "|"))


# --- pages ---------------------------------------------------------------------------


def _links(spark, sf) -> DataFrame:
    pages = _pages(spark, sf).select(F.lit("site").alias("source"), F.col("page_id").alias("page_num"), "html")
    return articles.link_rows(pages, H.link_list(F.col("html"), ROOT), "source", "page_num")


@query
def page_links(spark, sf):
    return _links(spark, sf)


@query
def class_links(spark, sf):
    marked = F.replace(F.col("html"), F.lit("<li><a href"), F.lit('<li><a class="x teaser-anchor" href'))
    pages = _pages(spark, sf).select(F.col("page_id").alias("page_num"), marked.alias("html"))
    return articles.page_links(pages, "sun")


@query
def child_links(spark, sf):
    marked = F.replace(F.col("html"), F.lit("<li><a href"), F.lit('<article class="tout"><a class="tout__link" href'))
    hidden = F.replace(marked, F.lit('class="tout"'), F.lit('class="tout tout--transformation-map"'))
    rows = _pages(spark, sf).select(F.col("page_id").alias("page_num"), F.when(F.length("url") % 2 == 0, marked).otherwise(hidden).alias("html"))
    return articles.page_links(rows, "weforum")


@query
def link_dedup(spark, sf):
    twice = _links(spark, sf).withColumn("pos", F.explode(F.array(F.col("pos"), F.col("pos") + 100)))
    return dedup_links(twice)


@query
def frontier_limit(spark, sf):
    return L.limit_frontier(_links(spark, sf), 120).select("page_num", "pos", "url")


@query
def article_index(spark, sf):
    return W.with_article_index(_links(spark, sf), ["page_num", "pos"])


@query
def index_frontier(spark, sf):
    total = F.format_string("1-20 of %,d", "n_links")
    html = F.concat(F.lit('<html><span class="pagination__legend">'), F.lit("x "), F.substring_index(total, " ", -1), F.lit("</span>"))
    counts = _links(spark, sf).groupBy("page_num").agg((F.count(F.lit(1)) * 37).alias("n_links")).select("page_num", html.alias("html"))
    pages = counts.select(F.col("page_num").alias("page_id"), articles.page_count(F.col("html"), "guardian").alias("num_pages"))
    return articles.index_frontier(pages, articles.RULES["guardian"].index_url)


@query
def page_counts(spark, sf):
    """Number of index pages as each source writes it; telegraph's from the links of each group of pages."""
    n = (F.col("page_id") % 900 + 2).cast("int").cast("string")
    spelled = {
        "gov_uk_news": F.concat(F.lit('<span class="gem-c-pagination__link-label">2 of '), n, F.lit("</span>")),
        "guardian": F.concat(F.lit('<span class="pagination__legend">x '), F.format_string("%,d", (F.col("page_id") % 900 + 2) * 20), F.lit("</span>")),
        "sun": F.concat(F.lit('<li class="rectangle-4-copy-10">1</li><li class="rectangle-4-copy-10">'), n, F.lit("</li>")),
        "weforum": F.concat(F.lit('<div class="pagination__page-info">1/'), F.repeat(F.lit(" "), F.lit(30)), n, F.lit("</div>")),
    }
    counts = [_pages(spark, sf).select("page_id", F.lit(name).alias("source"), articles.page_count(html, name).alias("num_pages")) for name, html in spelled.items()]
    index = _telegraph_index(spark, sf).withColumn("page_id", F.floor(F.col("page_num") / 10) * 10)
    counts.append(articles.linked_page_count(index, "telegraph", "page_id").select("page_id", F.lit("telegraph").alias("source"), "num_pages"))
    return reduce(DataFrame.unionByName, counts)


def _telegraph_index(spark, sf) -> DataFrame:
    """Index pages whose links are of the wanted class, but for every third page."""
    marked = F.replace(F.col("html"), F.lit("<li><a href"), F.lit('<li><a class="list-headline__link" href'))
    return _pages(spark, sf).select(F.col("page_id").alias("page_num"), F.when(F.col("page_id") % 3 == 0, F.col("html")).otherwise(marked).alias("html"))


@query
def pages_to_fetch(spark, sf):
    """Telegraph's index pages that are not stored yet; every fifth one is missing."""
    return articles.pages_to_fetch(_telegraph_index(spark, sf).where(F.col("page_num") % 5 != 2), "telegraph", ahead=25)


@query
def scraped_articles(spark, sf):
    """Index pages to links to pages to the store, twice: the second run finds only what is missing."""
    place = F.floor(F.col("page_id") / 10).alias("page_num")
    anchor = lambda url: F.concat(F.lit('<a class="fc-item__link" href="'), F.replace(url, F.lit("&"), F.lit("&amp;")), F.lit('">x</a>'))
    listed = _pages(spark, sf).select(place, "page_id", anchor(F.col("url")).alias("a"))
    anchors = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_id", "a"))), lambda s: s["a"]), "")
    gone = anchor(F.concat(F.lit("https://gone.example.org/"), F.col("page_num").cast("string")))
    index = listed.groupBy("page_num").agg(anchors.alias("html")).withColumn("html", F.concat("html", gone))
    path = scratch_path(spark, "store")
    for _ in range(2):
        rejected = articles.scrape_articles(spark, "guardian", index, _pages(spark, sf), path)
    saved = store.read_posts(spark, path, "guardian").select("url", "id_custom", F.lit("saved").alias("state"))
    return saved.unionByName(rejected.select("url", "id_custom", F.col("reason").alias("state")))


def _source_records(spark, sf, source: str, head: Column, kind: Column, html: Column | None = None) -> DataFrame:
    """Pages with a source's head tags; every third one lacks a title and is rejected."""
    title = F.when(F.col("page_id") % 3 != 0, F.concat(F.lit('<meta property="og:title" content="T'), F.col("page_id").cast("string"), F.lit('">'))).otherwise(F.lit(""))
    page = _with_head(F.col("html") if html is None else html, title, F.lit('<meta property="og:description" content="D">'), head)
    pages = _pages(spark, sf).select((F.col("page_id") + 1).alias("id_custom"), "url", page.alias("html"))
    kept, _ = articles.article_record(pages, source)
    return kept.select("id_custom", "title", "content", "date", kind.cast("string").alias("kind"))


def _rewrapped(before: str, after: str) -> Column:
    """The pages with other tags around their articles."""
    return F.replace(F.replace(F.col("html"), F.lit("<article>"), F.lit(before)), F.lit("</article>"), F.lit(after))


@query
def gov_uk_news_records(spark, sf):
    head = F.lit('<meta name="govuk:taxon-slug" content="x"><meta name="govuk:format" content="news"><meta name="date" content="6th of May 2020">')
    return _source_records(spark, sf, "gov_uk_news", head, F.col("format"))


@query
def telegraph_records(spark, sf):
    head = F.lit('<meta property="article:published_time" content="20200506">')
    return _source_records(spark, sf, "telegraph", head, F.lit(None), _rewrapped("<form><article>", "</article></form>"))


@query
def weforum_records(spark, sf):
    item = '\n{"@context": "x", "dateCreated": "10:30 6 May 2020", "creator": ["A"], "articleSection": "health", "keywords": ["k"]}\n'
    html = _rewrapped('<div class="article-body">', "\nWe use cookies to improve your experience</div>")
    return _source_records(spark, sf, "weforum", F.lit(f"<script>{item}</script>"), F.col("category"), html)


@query
def page_title(spark, sf):
    return _pages(spark, sf).select("page_id", H.page_title(F.col("html")).alias("title"))


@query
def main_text(spark, sf):
    return _pages(spark, sf).select("page_id", H.main_text(F.col("html")).alias("text"))


@query
def container_text(spark, sf):
    found = H.container_text(F.col("html"), [("section", "none"), ("div", "ad")])
    return _pages(spark, sf).select("page_id", found.alias("text"))


def _with_head(html: Column, *tags: Column) -> Column:
    return F.concat(F.substring_index(html, "</title>", 1), F.lit("</title>"), *tags, F.substring_index(html, "</title>", -1))


@query
def page_meta(spark, sf):
    html = _with_head(
        F.col("html"),
        F.concat(F.lit('<meta property="og:title" content="T '), F.col("url"), F.lit('">')),
        F.concat(F.lit("<meta content='D "), F.col("page_id").cast("string"), F.lit(" &amp; more' property='og:description' />")),
        F.lit('<meta name="govuk:format" content="news">'),
        F.concat(F.lit('<META NAME="author" CONTENT="A'), F.col("page_id").cast("string"), F.lit('">')),
        F.lit('<meta property="article:tag" content="a"><meta property="article:tag" content="b &#99;">'),
        F.lit('<meta property="article:published_time" content="2020-05-06T07:08:09Z">'),
    )
    page, metas = F.col("page"), F.col("metas")
    rows = _pages(spark, sf).select("page_id", html.alias("page")).withColumn("metas", H.meta_list(page))
    return rows.select(
        "page_id",
        H.meta_value(metas, "og:title").alias("title"),
        H.meta_value(metas, "og:description").alias("description"),
        H.meta_value(metas, "govuk:format").alias("format"),
        H.meta_value(metas, "govuk:taxon-slug").alias("taxon_slug"),
        H.page_author(metas).alias("author"),
        H.page_tags(metas).alias("tags"),
        dates.iso_date(dates.article_date(H.page_date(page, metas))).alias("date"),
    )


@query
def json_ld(spark, sf):
    record = F.to_json(
        F.struct(
            F.lit("https://schema.org").alias("@context"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("dateCreated"),
            F.when(F.col("event_type") == "view", F.array().cast("array<string>")).otherwise(F.array("event_type", F.lit("x"))).alias("creator"),
            F.col("event_type").alias("articleSection"),
            F.array(F.lit("k"), F.get_json_object("props", "$.k")).alias("keywords"),
        )
    )
    html = F.concat(F.lit("<html><script>\n"), record, F.lit("\n</script></html>"))
    item = F.from_json(H.json_ld(F.col("html")), JSON_LD)
    rows = table(spark, sf, "events").select("event_id", html.alias("html")).select("event_id", item.alias("item"))
    return rows.select(
        "event_id",
        dates.iso_date(dates.article_date(F.col("item.dateCreated"))).alias("date"),
        F.try_element_at(F.col("item.creator"), F.lit(1)).alias("author"),
        F.col("item.articleSection").alias("category"),
        F.array_join("item.keywords", "|").alias("keywords"),
    )


def _page_posts(spark, sf) -> DataFrame:
    pages = _pages(spark, sf).withColumn("id_custom", (F.col("page_id") + 1).cast("int"))
    return articles.article_record(pages, "guardian")[0]


@query
def article_records(spark, sf):
    return _page_posts(spark, sf).select("source", "url", "id_custom", "title", "content", "description", "date", "author")


@query
def export_posts(spark, sf):
    """Pages to the store, saved twice, then exported: no post is stored twice."""
    path = scratch_path(spark, "store")
    for _ in range(2):
        store.append_posts(_page_posts(spark, sf), path)
    posts = store.read_posts(spark, path, "guardian")
    corpus, metadata = articles.export_corpus(posts), articles.export_metadata(posts)
    ids = metadata.select(X.doc_id(F.col("id"), F.col("source")).alias("id"), "title", "url")
    return corpus.join(ids, "id")


@query
def ingest_pages_stream(spark, sf):
    """The same ingest as a stream over the page files, triggered twice."""
    path, checkpoint = scratch_path(spark, "store"), scratch_path(spark, "stream")
    for _ in range(2):
        ingest_stream(spark, f"{sf}/pages*.parquet", path, checkpoint, source_posts("sun"))
    return store.read_posts(spark, path, "sun").select("source", "url", "id_custom", "title", "content")


@query
def ingest_rejects_stream(spark, sf):
    """Two arrivals that repeat all URLs, then all input again as another stream.

    Every third page is blank at first; half of these are mended in the second arrival.
    """
    landing, path, rejects = (scratch_path(spark, n) for n in ("landing", "store", "rejects"))
    page = _pages(spark, sf).select("page_id", "url", "html")
    blank = lambda every: F.when(F.col("page_id") % every == 0, F.lit("<html></html>")).otherwise(F.col("html")).alias("html")
    arrivals = page.select("page_id", "url", blank(3)), page.select((-1 - F.col("page_id")).alias("page_id"), "url", blank(6))
    first = scratch_path(spark, "stream")
    for arrival in arrivals:
        arrival.write.mode("append").parquet(landing)
        ingest_stream(spark, landing, path, first, source_posts("sun"), rejects=rejects)
    ingest_stream(spark, landing, path, scratch_path(spark, "stream"), source_posts("sun"), rejects=rejects)
    saved = store.read_posts(spark, path, "sun").select("url", "id_custom", F.lit("saved").alias("state"))
    return saved.unionByName(store.read_rejects(spark, rejects, path).select("url", "id_custom", F.col("reason").alias("state")))


@query
def written_corpus(spark, sf):
    """Corpus files written and read back as lines."""
    path = scratch_path(spark, "corpus")
    sinks.write_corpus(_documents(spark, sf), path, "doc_id", "text")
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def written_metadata(spark, sf):
    """Metadata records written as JSON and read back."""
    path = scratch_path(spark, "metadata")
    joined = _documents(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left").drop("text")
    sinks.write_metadata(joined, path)
    return spark.read.schema("doc_id bigint, lang string, n_chars bigint, quality int, source string, toxic int").json(path)


@query
def written_samples(spark, sf):
    """A sample written as one text file per document and read back."""
    path = scratch_path(spark, "samples")
    sinks.write_sample_texts(L.sample_exact(_documents(spark, sf), "doc_id", 60, seed=3), path, "doc_id")
    back = spark.read.text(path, wholetext=True)
    return back.select(F.col("id").cast("bigint").alias("doc_id"), F.regexp_replace("value", r"\n\z", "").alias("text"))


@query
def written_days(spark, sf):
    """Daily partitions written and counted from the files."""
    path = scratch_path(spark, "days")
    rows = table(spark, sf, "events").select(F.to_date("ts").alias("date"), "event_id", "event_type")
    sinks.write_daily_partitions(rows, path, ("2024-01-03", "2024-01-20"))
    return _days(spark, path)


@query
def written_all_days(spark, sf):
    """All days, written twice: the second run replaces the first."""
    path = scratch_path(spark, "days")
    rows = table(spark, sf, "events").select(F.to_date("ts").alias("date"), "event_id", "event_type")
    for _ in range(2):
        sinks.write_daily_partitions(rows, path)
    return _days(spark, path)


@query
def shared_days(spark, sf):
    """Two tables with common days, each written twice, and one of them a third time with fewer days."""
    path = scratch_path(spark, "days")
    rows = table(spark, sf, "events").select(F.to_date("ts").alias("date"), F.col("event_id").alias("id"), "event_type")
    odd, even = rows.where("event_id % 2 = 1"), rows.where("event_id % 2 = 0")
    for part, name in ((odd, "odd"), (even, "even")) * 2:
        sinks.write_daily_partitions(part, path, table=name)
    sinks.write_daily_partitions(odd.where("date < DATE'2024-01-20'"), path, table="odd")
    return readers.read_id_files(spark, [path]).groupBy("file_name").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


def _days(spark, path: str) -> DataFrame:
    back = spark.read.option("header", True).csv(path)
    return back.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("event_id").cast("bigint")).alias("first_id")
    )
