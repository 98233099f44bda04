"""Columns over one paper record: text with headings, author and country lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillmill.functions.text import distinct_join, replace_linebreaks, strip


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def headings_once(paragraphs: Column) -> Column:
    """Paragraph texts, each section name put before its first paragraph only.

    ``paragraphs`` is array<struct<section,text>>. The list of names is bound once per
    record; a paragraph opens its section when its own index is the name's first one.
    """
    names = F.transform(paragraphs, lambda p: _or_empty(p["section"]))
    record = F.array(F.struct(names.alias("names"), paragraphs.alias("items")))

    def lines(r: Column) -> Column:
        def line(p: Column, i: Column) -> Column:
            section, text = _or_empty(p["section"]), _or_empty(p["text"])
            first = F.array_position(r["names"], section) == i + 1
            return F.when(first, F.array(section, text)).otherwise(F.array(text))

        return F.flatten(F.transform(r["items"], line))

    return F.flatten(F.transform(record, lines))


def paper_text(title: Column, abstract: Column, body: Column) -> Column:
    """Title, abstract and body as one corpus line; the abstract may be missing.

    Abstract and body keep separate lists of seen section names.
    """
    none = F.array().cast("array<string>")
    parts = F.concat(
        F.array(_or_empty(title)),
        F.coalesce(headings_once(abstract), none),
        F.coalesce(headings_once(body), none),
    )
    return replace_linebreaks(F.array_join(parts, "\n"))


def author_names(authors: Column) -> Column:
    """Distinct ``first last`` names in first-seen order, comma separated."""
    full = F.transform(authors, lambda a: strip(F.concat(_or_empty(a["first"]), F.lit(" "), _or_empty(a["last"]))))
    return _or_empty(distinct_join(full))


def author_countries(authors: Column) -> Column:
    """Distinct affiliation countries in first-seen order; missing ones are skipped."""
    found = F.transform(authors, lambda a: strip(_or_empty(a["affiliation"]["location"]["country"])))
    return _or_empty(distinct_join(found))
