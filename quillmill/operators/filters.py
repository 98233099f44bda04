"""Row filters. Each one is a single built-in predicate Catalyst can push down."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quillmill.durable import durable
from quillmill.functions.tweets import is_retweet
from quillmill.schemas import SOURCES

# Notices of removed posts, matched literally and case-sensitively.
REMOVAL_NOTICES = (
    "Thank you for your submission! Unfortunately, your submission has been removed",
    "Thanks for your submission, but it has been removed for the following reason",
    "Thanks for contributing! Unfortunately your submission has been removed",
    "Unfortunately, your post has been removed for the following reason(s)",
    "post has been removed. Attempts to circumvent this filter will result in a ban.",
    "but it has been removed because it doesn't quite abide by our rules, which are located in the sidebar.",
    "(#start_removal)",
)
# Fixed value: prompt on survey pages, which are not articles.
SURVEY_PROMPT = "To help us improve GOV.UK, we’d like to know more about your visit today."


def contains_any(c: Column, literals: tuple[str, ...] | list[str]) -> Column:
    """True when the text holds one of the literals."""
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(s)) for s in literals])


def drop_containing_any(df: DataFrame, col: str, literals=REMOVAL_NOTICES) -> DataFrame:
    """Drop rows whose text holds one of the literals; null texts stay."""
    return df.where(~F.coalesce(contains_any(F.col(col), literals), F.lit(False)))


def split_retweets(df: DataFrame, raw: str = "raw", stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(kept, skipped)``: rows without and with the key ``retweeted_status``.

    With ``stored`` the rows, without ``raw``, are computed and written once for both.
    """
    if stored:
        row = F.struct(*[c for c in df.columns if c != raw])
        rows = durable(df.select(row.alias("row"), is_retweet(F.col(raw)).alias("retweet")), "tweets")
        return rows.where("NOT retweet").select("row.*"), rows.where("retweet").select("row.*")
    return df.where(~is_retweet(F.col(raw))), df.where(is_retweet(F.col(raw)))


def drop_survey_pages(df: DataFrame, col: str = "content", prompt: str = SURVEY_PROMPT) -> DataFrame:
    """Drop pages whose text is the survey prompt's page."""
    return drop_containing_any(df, col, (prompt,))


def extracted(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Projection whose values are computed once per row.

    A filter on a projected column is otherwise moved below the projection together
    with a second copy of its expression; a generator keeps it above.
    """
    return df.select(F.inline(F.array(F.struct(*[c.alias(n) for n, c in fields.items()]))))


def require_extracted(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)``: a row is rejected for the first required column that is null.

    Rejected rows carry the name of that column in ``reason``.
    """
    reason = F.coalesce(*[F.when(F.col(name).isNull(), F.lit(f"no {name}")) for name in required])
    return df.where(reason.isNull()), df.where(reason.isNotNull()).withColumn("reason", reason)


def exclude_url_prefix(df: DataFrame, prefix: str, col: str = "url") -> DataFrame:
    """Drop links that start with ``prefix``."""
    return df.where(~F.startswith(F.col(col), F.lit(prefix)))


def check_source(source: str, known: tuple[str, ...] | None = SOURCES) -> str:
    """Lower-case source name; ``ValueError`` when it is not a known source."""
    name = source.lower()
    if known is not None and name not in known:
        raise ValueError(f"unknown source {source!r}: use one of {', '.join(known)}")
    return name


def by_source(df: DataFrame, source: str, known: tuple[str, ...] | None = SOURCES) -> DataFrame:
    """Rows of one source, after checking the name."""
    return df.where(F.col("source") == check_source(source, known))
