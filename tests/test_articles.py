import time

import pytest
from pyspark.sql import functions as F

from quillmill.functions import html as H
from quillmill.operators import filters as FL, joins as J, records as R
from quillmill.plans import articles as plan
from quillmill.sources import store
from quillmill.sources.sinks import write_metadata


def page(body, head=""):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def meta(prop, content, name="property"):
    return f'<meta {name}="{prop}" content="{content}">'


def articles(spark, source, *pages):
    rows = [(i + 1, f"https://x/{i + 1}", h) for i, h in enumerate(pages)]
    kept, rejected = plan.article_record(spark.createDataFrame(rows, "id_custom int, url string, html string"), source)
    return [r.asDict() for r in kept.orderBy("id_custom").collect()], {r.id_custom: r.reason for r in rejected.collect()}


# --- functions -----------------------------------------------------------------------


def test_attributes(values):
    tags = ['<a href="x" class=\'a b\' id=n>', "<a data-href='no'>", '<a HREF = "y">', "<a href>", '<a href="">']
    assert values(lambda c: H.attribute(c, "href"), tags) == ["x", None, "y", None, ""]
    assert values(lambda c: H.attribute(c, "id"), tags[:1]) == ["n"]
    assert values(lambda c: H.has_class(c, "b"), tags[:2]) == [True, False]


def test_unescape(values):
    got = values(H.unescape, ["a &amp;lt; b", "&#8217;&#x41;&#65", "&unknown; &", "&quot;&copy;&nbsp;x", "&#xD800; &#0;", None, "&#128512;", "&#;x", "&#38;lt; &amp;amp;&amp;&quot", "a;b &;c"])
    assert got == ["a &lt; b", "’A&#65", "&unknown; &", '"©\xa0x', "&#xD800; &#0;", None, "😀", "&#;x", "&lt; &amp;&&quot", "a;b &;c"]


def test_absolute_urls_join_like_urljoin(values):
    from urllib.parse import urljoin

    links = ["/a/b", "https://other/x", "//cdn/x", "c/d", "./e", "../f", "../../g", "?q=1", "#top", "mailto:a@b", " /sp ", "http:x"]
    for root in ("https://www.gov.uk/", "https://www.theguardian.com"):
        got = values(lambda c: H.absolute_url(c, root), links[:-1])
        assert got == [urljoin(root, link.strip()) for link in links[:-1]]


def test_links_of_a_class(values):
    html = page('<a class="x teaser-anchor" href="/1">a</a><A HREF="/2?a=1&amp;b=2" CLASS="teaser-anchor">b</A><a class="teaser-anchor-x" href="/3">c</a><a class="teaser-anchor">d</a>')
    assert values(lambda c: H.link_list(c, "https://r", "teaser-anchor"), [html]) == [["https://r/1", "https://r/2?a=1&b=2"]]
    assert values(lambda c: H.link_list(c, "https://r"), [html]) == [["https://r/1", "https://r/2?a=1&b=2", "https://r/3"]]


def test_child_selector(spark):
    html = page(
        '<article class="tout"><a class="tout__link" href="/1">x</a><div><a class="tout__link" href="/nested">x</a></div></article>'
        '<article class="tout tout--transformation-map"><a class="tout__link" href="/2">x</a></article>'
        '<article><img src=a><br><a class="tout__link" href="https://www.weforum.org/videos/3">x</a><a class="big tout__link" href="/4">x</a></article>'
    )
    df = spark.createDataFrame([(1, html), (2, None)], "page_num int, html string")
    got = [(r.pos, r.url) for r in plan.page_links(df, "weforum").orderBy("pos").collect()]
    assert [u for _, u in got] == ["https://www.weforum.org/1", "https://www.weforum.org/4"]


def test_container_text_takes_nested_parts(values):
    nested = '<div class="x"><div class="wide article-body">one<div>two<div>three</div></div><script>no</script> &amp; four</div>five</div>'
    section = '<section class="article-story__body">\n  s1 \n\n <p>We use cookies to improve your visit</p>\n<p>s2</p></section>'
    both = section + '<div class="article-body">d</div>'
    got = values(lambda c: H.container_text(c, plan.WEFORUM_CONTAINERS, plan.WEFORUM_COOKIE_LINE), [nested, section, both, "<p>none</p>", None, '<div class="article-body"></div>'])
    assert got == ["onetwothree & four", "s1\ns2", "d", None, None, None]


def test_main_text(values):
    html = page(
        "<nav><p>menu</p></nav><!-- <article>no</article> --><article class=a><h1>T &amp; U</h1><p>one <b>bold</b><br>two"
        "<script>var x='<p>';</script><style>p{}</style></p><footer>f</footer></article><p>outside</p>"
    )
    got = values(H.main_text, [html, "<body><p>only</p><p>body</p>", "<html><nav>x</nav></html>", page("<article> </article>"), None])
    assert got == ["T & U\none bold\ntwo", "only\nbody", None, None, None]


def test_meta_list_reads_both_attribute_orders(values):
    html = page("", "<meta content='late' property='og:title'><META NAME=author CONTENT=\"A &amp; B\">" + meta("og:title", "second") + '<meta property="empty" content="">')
    pick = lambda *names: values(lambda c: H.meta_value(H.meta_list(c), *names), [html])[0]
    assert (pick("og:title"), pick("author"), pick("x", "author"), pick("none"), pick("empty")) == ("late", "A & B", "A & B", None, "")


def test_title_author_date_tags(values):
    html = page('<time datetime="2020-03-04T00:00">x</time>', "<title> A &amp; B </title>" + meta("keywords", "k1, k2", "name"))
    m = H.meta_list
    assert values(H.page_title, [html, "<p>"]) == ["A & B", None]
    assert values(lambda c: H.page_date(c, m(c)), [html]) == ["2020-03-04T00:00"]
    assert values(lambda c: H.page_tags(m(c)), [html, "<p>", meta("article:tag", "a") + meta("article:tag", "b")]) == ["k1, k2", None, "a,b"]


def test_json_ld_is_the_first_matching_line(values):
    html = 'x\n {"@context":"indented"}\n{"@context":"a"}\n{"@context":"b"}'
    assert values(H.json_ld, [html, "none"]) == ['{"@context":"a"}', None]


# --- sources -------------------------------------------------------------------------


@pytest.mark.parametrize(
    "source,html,want",
    [
        ("gov_uk_news", '<span class="gem-c-pagination__link-label">2 of 53</span>', 53),
        ("guardian", '<span class="pagination__legend">About 3,001 results</span>', 151),
        ("sun", '<li class="rectangle-4-copy-10">1</li><li class="rectangle-4-copy-10"> 77 </li><li>9</li>', 77),
        ("weforum", '<div class="pagination__page-info">1/12</div>', 12),
        ("telegraph", "", None),
        ("sun", "<p>no list</p>", None),
    ],
)
def test_page_counts(values, source, html, want):
    assert values(lambda c: plan.page_count(c, source), [html]) == [want]


def test_telegraph_pages_follow_from_the_stored_ones(spark):
    link = '<a class="list-headline__link" href="/x">x</a>'
    stored = spark.createDataFrame([(1, link), (1500, link), (1501, "<p>no links</p>"), (None, link)], "page_num bigint, html string")
    assert [r.num_pages for r in plan.linked_page_count(stored, "telegraph").collect()] == [1500]
    got = sorted(r.page_num for r in plan.pages_to_fetch(stored, "telegraph", ahead=3).collect())
    assert got == [*range(2, 1500), 1502, 1503]
    none = stored.limit(0)
    assert plan.linked_page_count(none, "telegraph").count() == 0
    urls = {r.page_num: r.index_url for r in plan.pages_to_fetch(none, "telegraph", ahead=2).collect()}
    assert urls == {n: f"https://www.telegraph.co.uk/coronavirus/page-{n}/" for n in (1, 2)}


def test_index_frontier(spark):
    counts = spark.createDataFrame([("sun", 2), ("x", None)], "source string, num_pages int")
    got = [r.index_url for r in plan.index_frontier(counts, plan.RULES["sun"].index_url).orderBy("page_num").collect()]
    assert got == ["https://www.thesun.co.uk/topic/coronavirus/page/1", "https://www.thesun.co.uk/topic/coronavirus/page/2"]


def test_gov_articles(spark):
    head = "".join([
        meta("og:title", "T"), meta("og:description", "D"), meta("govuk:taxon-slug", "slug", "name"), meta("govuk:format", "news", "name"),
        meta("article:published_time", "5 April 2020"), meta("author", "Dept", "name"),
    ])
    survey = "<article>To help us improve GOV.UK, we’d like to know more about your visit today.</article>"
    kept, rejected = articles(spark, "gov_uk_news", page("<article>text</article>", head), page(survey, head), page("", head), page("<article>t</article>"))
    assert kept == [{
        "source": "gov_uk_news", "url": "https://x/1", "id_custom": 1, "description": "D", "content": "text", "author": "Dept",
        "title": "T", "date": "2020-04-05", "taxon_slug": "slug", "format": "news",
    }]
    assert rejected == {3: "no content", 4: "no date"}


def test_guardian_and_sun_articles(spark):
    head = "<title>Page</title>" + meta("article:tag", "a") + meta("article:tag", "b c") + meta("article:published_time", "sometime")
    for source, tags in (("guardian", ["a", "b c"]), ("sun", ["a", "b c"])):
        (row,), rejected = articles(spark, source, page("<article>x</article>", head))
        assert row["tags"] == tags and row["title"] == "Page" and row["date"] == "sometime" and row["description"] is None
        assert rejected == {}


def test_telegraph_articles(spark):
    head = meta("og:title", "T") + meta("date", "2020-04-05T10:00Z", "name") + meta("keywords", "k, l", "name")
    (row,), rejected = articles(spark, "telegraph", page("<article>x</article>", head), page("<article>x</article>", "<title>no og</title>" + meta("date", "2020-01-01", "name")))
    assert row["tags"] == ["k", " l"] and row["date"] == "2020-04-05" and rejected == {2: "no title"}


def test_weforum_articles(spark):
    head = meta("og:title", "T") + meta("og:description", "D")
    ld = '\n{"@context":"s","dateCreated":"2020-04-05T01:02:03Z","creator":%s,"articleSection":"Health","keywords":["k","l"]}\n'
    body = '<div class="article-body">x\nWe use cookies to improve your\n y</div>'
    kept, rejected = articles(
        spark, "weforum", page(body + ld % '["A","B"]', head), page(body + ld % "[]", head), page(body, head), page(ld % "[]", head), page(body + '\n{"@context" broken', head)
    )
    assert [(r["author"], r["content"], r["category"], r["keywords"], r["date"]) for r in kept] == [
        ("A", "x\ny", "Health", ["k", "l"], "2020-04-05"), (None, "x\ny", "Health", ["k", "l"], "2020-04-05"),
    ]
    assert rejected == {3: "no date", 4: "no content", 5: "no date"}


def test_values_are_extracted_once(spark):
    df = spark.createDataFrame([(1, "u", page("<article>x</article>"))], "id_custom int, url string, html string")
    physical = plan.article_record(df, "guardian")[0]._jdf.queryExecution().executedPlan().toString()
    assert physical.count("<article") <= 4  # one expression with its patterns


def test_filters(spark):
    df = spark.createDataFrame([("https://www.weforum.org/videos/x", "sun"), ("https://x", "guardian")], "url string, source string")
    assert FL.exclude_url_prefix(df, plan.WEFORUM_VIDEOS).count() == 1
    assert FL.by_source(df, "SUN").count() == 1
    with pytest.raises(ValueError, match="unknown source"):
        FL.by_source(df, "mirror")
    with pytest.raises(ValueError):
        plan.page_count(F.col("html"), "mirror")


# --- store, ingest, export -----------------------------------------------------------


def post(url, content="c", number=1, source="sun", **more):
    return {"source": source, "url": url, "content": content, "id_custom": number} | more


POST = "source string, url string, content string, id_custom int, author string, title string, description string, tags array<string>"


def test_new_only_keeps_first_and_unknown(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), ("c", 4)], "url string, n int").repartition(3)
    stored = spark.createDataFrame([("c",)], "url string")
    fresh = J.new_only(df, stored, ["n"])
    assert {(r.url, r.n) for r in fresh.collect()} == {("a", 1), ("b", 3)}
    assert fresh._jdf.queryExecution().toString().count("WindowGroupLimit") >= 2


def test_store_has_unique_urls_and_required_fields(spark, tmp_path):
    path = str(tmp_path / "store")
    assert store.read_posts(spark, path).count() == 0
    rows = [post("a", number=2), post("a", "first", 1), post("b", source="guardian")]
    for _ in range(2):
        store.append_posts(spark.createDataFrame(rows, POST), path)
    assert sorted((r.url, r.content) for r in store.read_posts(spark, path).collect()) == [("a", "first"), ("b", "c")]
    sun = store.read_posts(spark, path, "sun")
    assert sun.count() == 1 and sun.first().scrape_datetime is not None
    assert "PartitionFilters: [isnotnull(source" in sun._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="post without content"):
        store.append_posts(spark.createDataFrame([post("z", None)], POST), path)


def test_drop_empty_fields(spark, tmp_path):
    rows = [post("a", author="", title="", description="", tags=[]), post("b", author=None, title="t", description=None, tags=["x"])]
    records = plan.export_metadata(spark.createDataFrame(rows, POST))
    write_metadata(records, str(tmp_path / "m"), keep_nulls=False)
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "m")).collect())
    assert lines == ['{"author":"","id":1,"source":"sun","url":"a"}', '{"id":1,"source":"sun","tags":["x"],"title":"t","url":"b"}']
    assert sorted(r[0] for r in records.select(R.record_json(records)).collect()) == lines


def test_scrape_and_export(spark, tmp_path):
    link = lambda *hrefs: page("".join(f'<a class="teaser-anchor" href="{h}">x</a>' for h in hrefs))
    index = spark.createDataFrame([(2, link("/b", "/d")), (1, link("/a", "/b", "/missing", "/empty"))], "page_num int, html string")
    root = "https://www.thesun.co.uk"
    texts = [(f"{root}/{n}", page(f"<article>Text “{n}”\nmore</article>")) for n in "abd"] + [(f"{root}/empty", page(""))]
    pages = spark.createDataFrame(texts, "url string, html string")
    path, out = str(tmp_path / "store"), tmp_path / "out"
    for limit in (2, None, None):
        rejected = plan.scrape_articles(spark, "sun", index, pages, path, limit)
    assert sorted((r.url, r.reason) for r in rejected.collect()) == [(f"{root}/empty", "no content"), (f"{root}/missing", "no page")]
    stored = {r.url[-1]: r.id_custom for r in store.read_posts(spark, path, "sun").collect()}
    assert stored == {"a": 1, "b": 2, "d": 6}  # skipped pages leave gaps

    plan.export_articles(spark, "SUN", path, str(out), limit=2)
    lines = sorted(r.value for r in spark.read.text(str(out / "sun/corpus")).collect())
    assert lines == ['00001_sun\tText "a" <p> more', '00002_sun\tText "b" <p> more']
    assert spark.read.json(str(out / "sun/metadata")).count() == 2
    plan.export_articles(spark, "sun", path, str(out))
    assert spark.read.text(str(out / "sun/corpus")).count() == 3
    plan.export_sample(spark, "sun", path, str(out), limit=2, seed=1)
    assert len(list((out / "sun_sample").glob("id=*_sun/part-*.txt"))) == 2


def test_telegraph_links_are_distinct_per_page(spark):
    html = page('<a class="list-headline__link" href="/a">x</a>' * 2 + '<a class="list-headline__link" href="/b">x</a>')
    index = spark.createDataFrame([(1, html), (2, html)], "page_num int, html string")
    links = plan.page_links(index, "telegraph").orderBy("page_num", "pos").collect()
    assert [(r.page_num, r.pos, r.url[-1]) for r in links] == [(1, 0, "a"), (1, 2, "b"), (2, 0, "a"), (2, 2, "b")]


BROKEN = [
    "<nav>" * 20_000 + "<article>" + "word &amp; <b>bold</b> " * 20_000 + "<form>" * 2_000,
    "<article" * 50_000,
    "<article>x" + "<a <meta <span <title " * 50_000,
    "<!--" * 50_000 + "<script>" * 50_000,
    "<article>" + "<" * 300_000,
    "<article>" + "<div><span class=x><li>" * 30_000,
]


def test_broken_pages_take_linear_time(spark):
    pages = spark.createDataFrame([(i, h) for i, h in enumerate(BROKEN)], "i int, html string").repartition(4)
    html = F.col("html")
    rows = pages.select(
        "i",
        H.main_text(html).alias("text"),
        H.link_list(html, "https://r").alias("links"),
        H.page_title(html).alias("title"),
        H.meta_value(H.meta_list(html), "x").alias("meta"),
        H.element_text(html, "span", "y").alias("span"),
        H.container_text(html, [("div", "none"), ("span", "x")]).alias("container"),
    )
    start = time.monotonic()
    got = {r.i: r for r in rows.collect()}
    assert time.monotonic() - start < 60
    assert got[0].text.startswith("word & bold word") and got[1].text is None and got[4].text == "<" * 300_000


def test_nested_furniture_and_text_behind_the_last_tag(values):
    nested = "<body><header><nav><form>a</form>b</nav>c</header><p>text</p><aside><nav>d</nav>e</aside>1 < 2 and"
    assert values(H.main_text, [nested, "<body>a > b <nav>open <p>c"]) == ["text\n1 < 2 and", "a > b open\nc"]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<body><article>a<article>teaser</article>b</article></body>", "a\nteaser\nb"),
        ("<body><article>one</article><p>x</p><article>two</article></body>", "one\ntwo"),
        ("<body><form><p>all of it</p></form></body>", "all of it"),
        ("<body><form><article>a<form>search</form></article></form></body>", "a"),
        ("<body>keep<form>search</form></body>", "keep"),
        ("<article>&uuml;&Ccedil;&auml; &#00000000233; &notin; &nothing; &acE;</article>", "üÇä é ∉ &nothing; ∾̳"),
        ("<article>open to the end", "open to the end"),
    ],
)
def test_main_text_of_ordinary_pages(values, html, text):
    assert values(H.main_text, [html]) == [text]


@pytest.mark.parametrize(
    "text",
    ["Sale 5 < 6 and 7 > 3", "a<3 b> c", "x <- y -> z", "if 1 <2 then", "<> empty", "tail <"],
)
def test_a_bare_angle_bracket_is_text(values, text):
    assert values(H.main_text, [page(f"<p>{text}</p>")]) == [text]
    assert values(lambda c: H.element_text(c, "p", "k"), [page(f'<p class="k">{text} <b>bold</b></p>')]) == [f"{text} bold"]
