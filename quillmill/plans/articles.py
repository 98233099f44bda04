"""Article pages of the five sources: links, extraction, store, export."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillmill.durable import durable
from quillmill.functions import html as H
from quillmill.functions.dates import article_date, iso_date
from quillmill.functions.text import decode_unicode, doc_id, replace_linebreaks, split_tags
from quillmill.operators.filters import check_source, drop_survey_pages, exclude_url_prefix, extracted, require_extracted
from quillmill.operators.limits import limit_frontier, sample_exact, take_first
from quillmill.operators.positions import with_article_index
from quillmill.operators.records import drop_empty_fields, post_record
from quillmill.operators.sets import dedup_links
from quillmill.schemas import JSON_LD, SOURCES
from quillmill.sources.sinks import write_corpus, write_metadata, write_sample_texts
from quillmill.sources.store import append_posts, read_posts, unseen


@dataclass(frozen=True)
class SourceRule:
    """Where a source's articles are listed and how its links are marked."""

    root: str
    index_url: str  # template of one index page
    link_class: str
    tag_separator: str | None = None


# Sites, index pages and link classes of the five sources.
RULES = {
    "gov_uk_news": SourceRule(
        "https://www.gov.uk/",
        "https://www.gov.uk/search/news-and-communications?level_one_taxon=5b7b9532-a775-4bd2-a3aa-6ce380184b6c&order=updated-newest&page={page_num}",
        "gem-c-document-list__item-link",
    ),
    "guardian": SourceRule(
        "https://www.theguardian.com",
        "https://www.theguardian.com/world/coronavirus-outbreak?page={page_num}",
        "fc-item__link",
        tag_separator=",",
    ),
    "sun": SourceRule(
        "https://www.thesun.co.uk",
        "https://www.thesun.co.uk/topic/coronavirus/page/{page_num}",
        "teaser-anchor",
        tag_separator=", ",
    ),
    "telegraph": SourceRule(
        "https://www.telegraph.co.uk/",
        "https://www.telegraph.co.uk/coronavirus/page-{page_num}/",
        "list-headline__link",
        tag_separator=",",
    ),
    "weforum": SourceRule(
        "https://www.weforum.org",
        "https://www.weforum.org/agenda/archive/covid-19?page={page_num}",
        "tout__link",
    ),
}
# Other selectors and phrases of the sources.
GUARDIAN_ARTICLES_PER_PAGE = 20
WEFORUM_CONTAINERS = [("div", "article-body"), ("section", "article-story__body")]
WEFORUM_COOKIE_LINE = "We use cookies to improve your"
WEFORUM_VIDEOS = "https://www.weforum.org/videos/"


# --- index pages ---------------------------------------------------------------------


def page_count(html: Column, source: str) -> Column:
    """Number of index pages, read from the first one.

    Null where the page does not say it, as all of telegraph's; see ``linked_page_count``.
    """
    source = check_source(source)
    if source == "gov_uk_news":
        n = F.replace(H.element_text(html, "span", "gem-c-pagination__link-label"), F.lit("2 of "), F.lit(""))
    elif source == "guardian":
        words = F.split(H.element_text(html, "span", "pagination__legend"), r"\s+")
        articles = F.replace(F.try_element_at(words, F.lit(2)), F.lit(","), F.lit("")).try_cast("int")
        return F.ceil(articles / F.lit(GUARDIAN_ARTICLES_PER_PAGE)).cast("int")
    elif source == "sun":
        n = H.element_text(html, "li", "rectangle-4-copy-10", last=True)
    elif source == "weforum":
        n = F.regexp_extract(H.element_text(html, "div", "pagination__page-info"), r"(\d+)\D*$", 1)
    else:
        return F.lit(None).cast("int")
    return F.trim(n).try_cast("int")


def index_frontier(counts: DataFrame, template: str) -> DataFrame:
    """One URL per index page of each row's ``num_pages``."""
    pages = counts.where(F.col("num_pages") > 0).withColumn("page_num", F.explode(F.sequence(F.lit(1), F.col("num_pages"))))
    url = F.replace(F.lit(template), F.lit("{page_num}"), F.col("page_num").cast("string"))
    return pages.drop("num_pages").withColumn("index_url", url)


def link_rows(pages: DataFrame, links: Column, *keep: str) -> DataFrame:
    """One row per link with its position on the page."""
    return pages.select(*keep, F.posexplode(links).alias("pos", "url"))


def page_links(index_pages: DataFrame, source: str) -> DataFrame:
    """``(source, page_num, pos, url)`` of the article links on index pages."""
    source = check_source(source)
    rule, html = RULES[source], F.col("html")
    if source == "weforum":
        found = H.child_links(html, rule.root, "article", "tout--transformation-map", rule.link_class)
    else:
        found = H.link_list(html, rule.root, rule.link_class)
    links = link_rows(index_pages.withColumn("source", F.lit(source)), found, "source", "page_num")
    if source == "weforum":
        links = exclude_url_prefix(links, WEFORUM_VIDEOS)
    if source == "telegraph":
        links = dedup_links(links)
    return links


def linked_page_count(index_pages: DataFrame, source: str, *by: str) -> DataFrame:
    """``(*by, num_pages)``: the last stored index page that has article links.

    For sources whose pages do not name their number; without any link there is no row.
    """
    rule = RULES[check_source(source)]
    linked = F.size(H.link_list(F.col("html"), rule.root, rule.link_class)) > 0
    last = index_pages.where(linked).groupBy(*by).agg(F.max("page_num").cast("int").alias("num_pages"))
    return last.where(F.col("num_pages").isNotNull())


def pages_to_fetch(index_pages: DataFrame, source: str, ahead: int = 100) -> DataFrame:
    """``(page_num, index_url)`` of index pages that are not stored, up to ``ahead`` behind the last one with links.

    Without stored pages these are the first ones. Fetching until nothing with links is
    added finds every page unless more than ``ahead`` in a row lack links.
    """
    stored = index_pages.where(F.col("page_num").isNotNull())
    last = linked_page_count(stored, source).agg(F.coalesce(F.max("num_pages"), F.lit(0)).alias("num_pages"))
    wanted = index_frontier(last.withColumn("num_pages", F.col("num_pages") + ahead), RULES[source].index_url)
    return wanted.join(stored.select(F.col("page_num").cast("int").alias("page_num")), "page_num", "left_anti")


def article_frontier(index_pages: DataFrame, source: str, limit: int | None = None) -> DataFrame:
    """First ``limit`` article links with their ``id_custom`` index."""
    links = limit_frontier(page_links(index_pages, source), limit)
    return with_article_index(links, ["page_num", "pos"])


# --- article pages -------------------------------------------------------------------


def article_record(pages: DataFrame, source: str, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(posts, rejected)`` of pages ``(id_custom, url, html)`` by the source's rules.

    With ``stored`` the extracted rows are written once for both.

    Rejected pages carry a ``reason``: no text, or none of a field the source must have.
    """
    source = check_source(source)
    html, metas, rule = F.col("html"), F.col("_metas"), RULES[source]
    fields = {
        "source": F.lit(source),
        "url": F.col("url"),
        "id_custom": F.col("id_custom"),
        "description": H.meta_value(metas, "og:description"),
    }
    og_title, required = H.meta_value(metas, "og:title"), ["url", "content"]
    if source == "weforum":
        pages = pages.withColumn("_item", F.from_json(H.json_ld(html), JSON_LD))
        item = F.col("_item")
        fields |= {
            "content": H.container_text(html, WEFORUM_CONTAINERS, WEFORUM_COOKIE_LINE),
            "title": og_title,
            "author": F.try_element_at(item["creator"], F.lit(1)),
            "date": iso_date(article_date(item["dateCreated"])),
            "category": item["articleSection"],
            "keywords": item["keywords"],
        }
        required += ["date", "title", "description"]
    else:
        stamp = H.page_date(html, metas)
        date = iso_date(article_date(stamp))
        fields |= {
            "content": H.main_text(html),
            "author": H.page_author(metas),
            "title": og_title if source in ("gov_uk_news", "telegraph") else F.coalesce(og_title, H.page_title(html)),
            "date": F.coalesce(date, stamp) if source in ("guardian", "sun") else date,
        }
    if source == "gov_uk_news":
        fields |= {"taxon_slug": H.meta_value(metas, "govuk:taxon-slug"), "format": H.meta_value(metas, "govuk:format")}
        required += ["date", "title", "description", "taxon_slug", "format"]
    elif source == "telegraph":
        required += ["date", "title"]
    if rule.tag_separator:
        fields["tags"] = split_tags(H.page_tags(metas, rule.tag_separator), rule.tag_separator)
    rows = extracted(pages.withColumn("_metas", H.meta_list(html)), fields)
    if source == "gov_uk_news":
        rows = drop_survey_pages(rows)
    kept, rejected = require_extracted(durable(rows, "extracted") if stored else rows, required)
    return kept, rejected.select("source", "url", "id_custom", "reason")


def scrape_articles(
    spark: SparkSession,
    source: str,
    index_pages: DataFrame,
    article_pages: DataFrame,
    store: str,
    limit: int | None = None,
) -> DataFrame:
    """Index pages and article pages to new posts in the store; returns the rejects.

    A URL listed several times is looked up once, under its first index; a stored one is
    not looked up again. Listed links without a page are rejects, too.
    """
    links = article_frontier(index_pages, source, limit)
    once = links.groupBy("url").agg(F.min("id_custom").alias("id_custom"))
    wanted = durable(unseen(once, store), "wanted")
    pages = article_pages.select("url", "html")
    posts, rejected = article_record(wanted.join(pages, "url"), source, stored=True)
    missing = wanted.join(pages.select("url"), "url", "left_anti").select(F.lit(check_source(source)).alias("source"), "url", "id_custom", F.lit("no page").alias("reason"))
    rejects = durable(rejected.unionByName(missing), "rejects")
    append_posts(posts, store, all_unseen=True)
    return rejects


# --- export --------------------------------------------------------------------------


def export_corpus(posts: DataFrame) -> DataFrame:
    """``(id, text)`` of stored posts: ASCII, one line."""
    text = replace_linebreaks(decode_unicode(F.col("content")))
    return posts.select(doc_id(F.col("id_custom"), F.col("source")).alias("id"), text.alias("text"))


def export_metadata(posts: DataFrame) -> DataFrame:
    """Metadata records of stored posts; empty fields are null and left out on writing."""
    return drop_empty_fields(post_record(posts)).drop("content")


def export_articles(
    spark: SparkSession,
    source: str,
    store: str,
    out: str,
    limit: int | None = None,
    known: tuple[str, ...] | None = SOURCES,
) -> None:
    """Write corpus and metadata of one source, the first ``limit`` posts by index."""
    posts = take_first(read_posts(spark, store, source, known), limit, ["id_custom", "url"])
    write_corpus(export_corpus(posts), f"{out}/{source.lower()}/corpus", normalise=False)
    write_metadata(export_metadata(posts), f"{out}/{source.lower()}/metadata", keep_nulls=False)


def export_sample(spark: SparkSession, source: str, store: str, out: str, limit: int = 200, seed: int = 0) -> None:
    """Write an exact random sample of one source's texts, one file each."""
    picked = sample_exact(read_posts(spark, store, source), "url", limit, seed)
    write_sample_texts(export_corpus(picked), f"{out}/{source.lower()}_sample")
