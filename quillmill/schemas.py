"""Declared schemas of all inputs and of the post store."""

from __future__ import annotations

from pyspark.sql import types as T

SOURCES = ("gov_uk_news", "telegraph", "guardian", "sun", "weforum")

POSTS = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("url", T.StringType(), False),
        T.StructField("content", T.StringType(), False),
        T.StructField("id_custom", T.LongType(), False),
        T.StructField("scrape_datetime", T.TimestampType()),
        T.StructField("author", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("taxon_slug", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("category", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
    ]
)
REQUIRED_POST_FIELDS = ("source", "url", "content", "id_custom")

PARAGRAPHS = "array<struct<section:string,text:string>>"
AUTHORS = (
    "array<struct<first:string,last:string,"
    "affiliation:struct<location:struct<country:string>>>>"
)
PAPER = (
    f"paper_id string, metadata struct<title:string,authors:{AUTHORS}>, "
    f"abstract {PARAGRAPHS}, body_text {PARAGRAPHS}"
)
PAPER_METADATA_FIELDS = ("sha", "journal", "doi", "url", "publish_time")

LABELLED_POST_FIELDS = {"week": "int", "post": "string", "V": "double", "std(V)": "double"}

ID_TSV = (
    "id bigint, username string, timestamp string, followers bigint, friends bigint, "
    "retweets bigint, favorites bigint, entities string, sentiment string, mentions string, "
    "hashtags string, urls string"
)

TWEET = (
    "id bigint, id_str string, full_text string, created_at string, lang string, "
    "favorite_count bigint, retweet_count bigint, "
    "in_reply_to_status_id bigint, in_reply_to_user_id bigint, "
    "place struct<country:string>, "
    "entities struct<hashtags:array<struct<text:string>>,"
    "urls:array<struct<expanded_url:string>>,user_mentions:array<struct<id:bigint>>>, "
    "user struct<id:bigint,name:string,location:string,followers_count:bigint,"
    "statuses_count:bigint,verified:boolean>"
)

JSON_LD = (
    "dateCreated string, creator array<string>, articleSection string, keywords array<string>"
)

LEDGER = (
    "dataset string, file_name string, batch_id bigint, num_tweets_saved bigint, "
    "num_ids bigint, ids_hash bigint"
)

PAGES = "page_id bigint, url string, html string"

REJECTS = "source string, url string, id_custom bigint, reason string, stream string, batch_id bigint"
