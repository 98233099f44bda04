"""Projections to the output records of each pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillmill.functions.papers import author_countries, author_names, paper_text
from quillmill.functions.text import corpus_line

KEPT_FIELDS = ("author", "id", "date")


def drop_empty_fields(df: DataFrame, keep: tuple[str, ...] = KEPT_FIELDS) -> DataFrame:
    """Null instead of ``''`` and ``[]``, except in the kept fields.

    Null fields are left out when the records are written as JSON.
    """

    def emptied(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if field.name in keep:
            return c
        if isinstance(field.dataType, T.StringType):
            return F.nullif(c, F.lit("")).alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.when(F.size(c) > 0, c).alias(field.name)
        return c

    return df.select(*[emptied(f) for f in df.schema.fields])


def record_json(df: DataFrame, keep_nulls: bool = False) -> Column:
    """All columns as one JSON record with sorted keys."""
    return F.to_json(F.struct(*[f"`{c}`" for c in sorted(df.columns)]), {"ignoreNullFields": str(not keep_nulls).lower()})


def headings_once_rows(df: DataFrame, document: list[str], order: str, section: str = "section", text: str = "text") -> DataFrame:
    """Row form of ``headings_once``: paragraphs are rows, the lines stay rows.

    The first paragraph of a section follows from a combined minimum per (document,
    section), so a document of any length never has to fit into one task. The line
    order inside a document is (``order``, ``part``).
    """
    names = df.select(*document, order, F.coalesce(section, F.lit("")).alias(section), F.coalesce(text, F.lit("")).alias(text))
    firsts = names.groupBy(*document, section).agg(F.min(order).alias("_first"))
    marked = names.join(firsts, [*document, section])
    lines = F.when(F.col(order) == F.col("_first"), F.array(section, text)).otherwise(F.array(text))
    return marked.select(*document, order, F.posexplode(lines).alias("part", "line"))


def paper_record(joined: DataFrame) -> DataFrame:
    """Metadata record of papers joined with their metadata rows."""
    authors = F.col("metadata.authors")
    return joined.select(
        F.col("paper_id").alias("id"),
        F.col("metadata.title").alias("title"),
        author_names(authors).alias("author"),
        author_countries(authors).alias("location"),
        "journal",
        "doi",
        "url",
        F.col("publish_time").alias("publication_date"),
    )


def paper_corpus(papers: DataFrame) -> DataFrame:
    """``(id, text)`` of papers."""
    text = paper_text(F.col("metadata.title"), F.col("abstract"), F.col("body_text"))
    return papers.select(F.col("paper_id").alias("id"), text.alias("text"))


def post_record(df: DataFrame) -> DataFrame:
    """Stored posts without store-only fields; ``id_custom`` becomes ``id``."""
    return df.drop("_id", "scrape_datetime").withColumnRenamed("id_custom", "id")


def labelled_post_record(df: DataFrame) -> DataFrame:
    """Output names of labelled posts; ``valance`` is the agreed spelling."""
    names = {"V": "valance", "std(V)": "std(valance)", "week": "publication_date", "post": "content"}
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def corpus_lines(df: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """One column ``line``: ``id<TAB>text``."""
    return df.select(corpus_line(F.col(id), F.col(text)).alias("line"))
