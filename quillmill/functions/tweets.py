"""Columns over one tweet object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillmill.functions.dates import iso_date, tweet_date
from quillmill.functions.text import replace_linebreaks


RETWEET_KEY = "retweeted_status"


def entity_list(arr: Column, field: str) -> Column:
    """One field of every entity: hashtag texts, expanded URLs, mentioned user ids."""
    return F.transform(arr, lambda e: e[field])


def is_retweet(raw: Column) -> Column:
    """True when the key ``retweeted_status`` is present, even with a null value.

    Only objects that hold the word at all are parsed for their keys.
    """
    mentioned = F.contains(raw, F.lit(RETWEET_KEY))
    return F.coalesce(mentioned & F.array_contains(F.json_object_keys(raw), RETWEET_KEY), F.lit(False))


def tweet_metadata(df: DataFrame, *keep: str | Column) -> DataFrame:
    """The 16 output fields and the one-line ``content`` of parsed, located tweets.

    ``keep`` names further columns to carry along.
    """
    user, entities = F.col("user"), F.col("entities")
    fields = {
        "date": iso_date(tweet_date(F.col("created_at"))),
        "location": F.col("location"),
        "hashtags": entity_list(entities["hashtags"], "text"),
        "urls": entity_list(entities["urls"], "expanded_url"),
        "user_mentions": entity_list(entities["user_mentions"], "id"),
        "id": F.col("id"),
        "language": F.col("lang"),
        "favourite_count": F.col("favorite_count"),
        "retweet_count": F.col("retweet_count"),
        "in_reply_to_status_id": F.col("in_reply_to_status_id"),
        "in_reply_to_user_id": F.col("in_reply_to_user_id"),
        "author": user["id"],
        "author_name": user["name"],
        "author_followers_count": user["followers_count"],
        "author_statuses_count": user["statuses_count"],
        "author_verified": user["verified"],
        "content": replace_linebreaks(F.col("full_text")),
    }
    return df.select(*keep, *[c.alias(n) for n, c in fields.items()])
