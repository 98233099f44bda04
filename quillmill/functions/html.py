"""Columns over raw HTML: tags, links, meta data and main text.

Real pages are not well-formed, so XML functions cannot be used. Everything that needs
no nesting is a built-in regular expression; the two selectors that do need nesting
(`container_text`, `child_links`) are small Arrow functions over the standard parser.
"""

from __future__ import annotations

import json
from collections import Counter
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from quillmill.functions.text import drop_lines, let, strip

# The commonest named entities; the others come from the standard library.
ENTITIES = {
    "amp": "&", "quot": '"', "lt": "<", "gt": ">", "apos": "'", "nbsp": "\u00a0", "middot": "·",
    "copy": "©", "reg": "®", "trade": "™", "hellip": "…", "ndash": "–", "mdash": "—",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»",
    "bull": "•", "pound": "£", "euro": "€", "deg": "°", "eacute": "é", "egrave": "è",
}

ALL_ENTITIES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}

# Parts of a page that never hold its main text, those inside others first, and tags that
# end a line of text.
SKIPPED_ELEMENTS = ("nav", "header|footer|aside")
BLOCK_ELEMENTS = "p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|blockquote|pre|main|figure|figcaption"


def _or_null(c: Column) -> Column:
    """Null instead of the empty string."""
    return let(c, lambda v: F.when(v != "", v))


def _first_group(c: Column, pattern: str) -> Column:
    """Group 1 of the first match; null when nothing matched. For short inputs."""
    return F.try_element_at(F.regexp_extract_all(c, F.lit(pattern), 1), F.lit(1))


#: A tag, an end tag, a declaration or an instruction; any other ``<`` is text.
ANY_TAG = r"</?[A-Za-z!?][^>]*>"


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of one tag, quoted either way or bare; null when absent."""
    start = rf"(?is)\s{name}\s*=\s*"
    return F.coalesce(
        _first_group(tag, start + r'"([^"]*)"'),
        _first_group(tag, start + r"'([^']*)'"),
        _first_group(tag, start + r"""([^\s"'>]+)"""),
    )


def has_class(tag: Column, css_class: str) -> Column:
    """True when the class list of the tag holds ``css_class``."""
    return F.coalesce(F.array_contains(F.split(attribute(tag, "class"), r"\s+"), css_class), F.lit(False))


def _numeric_character(entity: Column) -> Column:
    """Character of ``#8217`` or ``#x2019``; null when it is none."""
    code = F.coalesce(
        _first_group(entity, r"^#0*(\d{1,7})$").try_cast("int"),
        F.conv(_first_group(entity, r"^#[xX]0*([0-9A-Fa-f]{1,6})$"), 16, 10).try_cast("int"),
    )

    def character(n: Column) -> Column:
        valid = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))

    return let(code, character)


def unescape(c: Column) -> Column:
    """Decode numeric and all standard named entities once; others stay as they are."""
    common = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])
    every = F.from_json(F.lit(json.dumps(ALL_ENTITIES)), "map<string,string>")  # one constant

    def decoded(piece: Column, i: Column) -> Column:
        entity = F.substring_index(piece, ";", 1)
        char = F.when(F.startswith(piece, F.lit("#")), _numeric_character(entity)).otherwise(
            F.coalesce(F.try_element_at(common, entity), F.when(F.length(entity) < 40, F.try_element_at(every, entity)))
        )
        rest = F.substring(piece, F.length(entity) + 2, F.length(piece))
        whole = F.when(F.contains(piece, F.lit(";")), F.concat(char, rest))
        return F.when(i == 0, piece).otherwise(F.coalesce(whole, F.concat(F.lit("&"), piece)))

    def pieces(text: Column) -> Column:
        joined = F.array_join(F.transform(F.split(text, "&"), decoded), "")
        return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)

    return let(c, pieces)


def _complete(html: Column) -> Column:
    """The page up to its last ``>``.

    Behind it no tag is complete. Looking for one there would scan to the end of the page
    from every ``<``, which takes quadratic time on broken pages.
    """
    return F.substring(html, F.lit(1), F.length(html) - F.length(F.substring_index(html, ">", -1)))


def _complete_or_text(fragment: Column) -> Column:
    """A fragment in which every ``<`` has a later ``>``."""
    rest = F.substring_index(fragment, ">", -1)
    return F.concat(_complete(fragment), F.replace(rest, F.lit("<"), F.lit("&lt;")))


def tags(html: Column, name: str) -> Column:
    """All opening tags of one element, in page order."""
    return F.regexp_extract_all(_complete(html), F.lit(rf"(?is)<{name}\s[^>]*>"), 0)


def _starts(html: Column, elements: str) -> Column:
    """The page cut before each opening tag of the elements."""
    return F.split(html, rf"(?i)(?=<(?:{elements})\b)")


def _without(html: Column, elements: str) -> Column:
    """The page without these elements; an end tag is looked for up to the next start only."""
    closed = rf"(?is)^<({elements})\b[^>]*>.*?</\1\s*>"
    return F.array_join(F.transform(_starts(html, elements), lambda part: F.regexp_replace(part, closed, "")), "")


def absolute_url(href: Column, root: str) -> Column:
    """``href`` joined with a site root, as a browser on the root page would."""
    scheme, host = root.split("://", 1)
    origin = f"{scheme}://{host.split('/', 1)[0]}"

    def joined(link: Column) -> Column:
        relative = F.regexp_replace(link, r"^(?:\.{1,2}/)+", "")
        return (
            F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
            .when(F.startswith(link, F.lit("//")), F.concat(F.lit(scheme + ":"), link))
            .when(F.startswith(link, F.lit("/")), F.concat(F.lit(origin), link))
            .when(link.rlike("^[#?]"), F.concat(F.lit(root), link))
            .otherwise(F.concat(F.lit(origin + "/"), relative))
        )

    return let(strip(href), joined)


def link_list(html: Column, root: str, css_class: str | None = None) -> Column:
    """Absolute URLs of the page's anchors in page order, by class when one is given."""
    anchors = tags(html, "a")
    if css_class:
        anchors = F.filter(anchors, lambda a: has_class(a, css_class))
    hrefs = F.filter(F.transform(anchors, lambda a: attribute(a, "href")), lambda h: h.isNotNull())
    return F.transform(hrefs, lambda h: absolute_url(unescape(h), root))


def meta_list(html: Column) -> Column:
    """All meta tags as array<struct<name,content>>, in page order.

    ``name`` is the ``property`` or else the ``name`` attribute. Reading a page's meta
    tags once and looking values up in the list saves one scan of the page per value.
    """

    def entry(tag: Column) -> Column:
        name = F.coalesce(attribute(tag, "property"), attribute(tag, "name"))
        return F.struct(name.alias("name"), attribute(tag, "content").alias("content"))

    return F.transform(tags(html, "meta"), entry)


def meta_values(metas: Column, name: str) -> Column:
    """Contents of all entries of that name, in page order."""
    named = F.filter(metas, lambda m: (m["name"] == name) & m["content"].isNotNull())
    return F.transform(named, lambda m: unescape(m["content"]))


def meta_value(metas: Column, *names: str) -> Column:
    """Content of the first entry of the first name that has one; null if none."""
    return F.coalesce(*[F.try_element_at(meta_values(metas, n), F.lit(1)) for n in names])


def page_title(html: Column) -> Column:
    """Text of the ``title`` element, stripped; null when absent or blank."""
    return _or_null(strip(unescape(F.regexp_extract(_complete(html), r"(?i)<title\b[^>]*>([^<]*)", 1))))


def page_author(metas: Column) -> Column:
    """Author named by the page's meta tags."""
    return meta_value(metas, "author", "article:author")


def page_date(html: Column, metas: Column) -> Column:
    """Publication stamp: meta tags first, then the first ``time`` element with one."""
    times = F.filter(F.transform(tags(html, "time"), lambda t: attribute(t, "datetime")), lambda v: v.isNotNull())
    return F.coalesce(meta_value(metas, "article:published_time", "date"), F.try_element_at(times, F.lit(1)))


def page_tags(metas: Column, sep: str = ",") -> Column:
    """All ``article:tag`` values joined by ``sep``, else the keyword list; null if none."""
    listed = _or_null(F.array_join(meta_values(metas, "article:tag"), sep))
    return F.coalesce(listed, meta_value(metas, "keywords"))


def text_of(fragment: Column) -> Column:
    """Text of an HTML fragment: block tags end lines, other tags vanish."""
    lines = F.regexp_replace(fragment, rf"(?i)</?(?:{BLOCK_ELEMENTS})\b[^>]*>", "\n")
    plain = unescape(F.regexp_replace(lines, ANY_TAG, ""))
    return _or_null(drop_lines(plain))


def _without_furniture(html: Column) -> Column:
    """The page without comments, scripts and page furniture.

    A comment or script without an end reaches to the end of the page, as in a browser.
    Text behind the last tag stays, but none of its ``<`` starts a tag.
    """
    clean = F.regexp_replace(_complete_or_text(html), r"(?s)<!--.*?(?:-->|\z)", "")
    clean = F.regexp_replace(clean, r"(?is)<(script|style|noscript)\b[^>]*>.*?(?:</\1\s*>|\z)", "")
    for elements in SKIPPED_ELEMENTS:
        clean = _without(clean, elements)
    return clean


def _articles(page: Column) -> Column:
    """Content of all outermost ``article`` elements, nested ones included; blank if none.

    The page is cut at the elements' tags, and what lies at a depth of one or more stays.
    An element without an end reaches to the end of the page.
    """
    parts = F.split(page, r"(?i)(?=<article\b)|(?=</article\s*>)")
    opens, closes = r"(?i)^<article\b", r"(?i)^</article"

    def step(acc: Column, part: Column) -> Column:
        depth = F.when(part.rlike(opens), acc["depth"] + 1).when(part.rlike(closes), F.greatest(acc["depth"] - 1, F.lit(0))).otherwise(acc["depth"])
        return F.struct(depth.alias("depth"), F.when(depth > 0, F.concat(acc["kept"], F.array(part))).otherwise(acc["kept"]).alias("kept"))

    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))
    return F.when(page.rlike(r"(?i)<article\b"), F.aggregate(parts, start, step, lambda acc: F.array_join(acc["kept"], "\n")))


def main_text(html: Column) -> Column:
    """Main text of a generic page: its ``article`` elements, else its ``body``; null when empty.

    These are our own rules, not those of an extraction library: comments, scripts and
    page furniture go first, then tags, then blank lines. Forms go, too, unless nothing
    else is left.
    """

    def region(page: Column) -> Column:
        body = F.regexp_extract(page, r"(?is)<body\b[^>]*>(.*?)(?:</body\s*>|\z)", 1)
        return F.coalesce(_or_null(_articles(page)), body)

    def text(found: Column) -> Column:
        return F.coalesce(text_of(_without(found, "form")), F.when(found.rlike(r"(?i)<form\b"), text_of(found)))

    return let(let(_without_furniture(html), region), text)


def element_text(html: Column, element: str, css_class: str, last: bool = False) -> Column:
    """Tag-free text of the first (or last) element of a class; no nesting of its own kind."""
    found = F.filter(_starts(html, element), lambda e: has_class(F.regexp_extract(e, r"(?s)^<[^>]*>", 0), css_class))
    picked = F.try_element_at(found, F.lit(-1 if last else 1))
    inner = F.regexp_extract(picked, rf"(?is)^<[^>]*>(.*?)(?:</{element}\s*>|\z)", 1)
    return strip(unescape(F.regexp_replace(_complete_or_text(inner), ANY_TAG, "")))


def json_ld(html: Column) -> Column:
    """First line of the page that starts with ``{"@context"``; null when there is none."""
    lines = F.filter(F.split(html, "\n"), lambda line: F.startswith(line, F.lit('{"@context"')))
    return F.try_element_at(lines, F.lit(1))


# --- selectors that need nesting -----------------------------------------------------

# Elements without an end tag.
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Elements(HTMLParser):
    """Keeps the stack of open elements, each as (tag, class list)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str]]] = []
        self.names: Counter[str] = Counter()

    def handle_starttag(self, tag, attrs):
        classes = (dict(attrs).get("class") or "").split()
        self.opened(tag, classes, dict(attrs))
        if tag not in VOID_ELEMENTS:
            self.open.append((tag, classes))
            self.names[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.opened(tag, (dict(attrs).get("class") or "").split(), dict(attrs))

    def handle_endtag(self, tag):
        if self.names[tag]:
            name = None
            while name != tag:
                name = self.open.pop()[0]
                self.names[name] -= 1
            self.closed()

    def opened(self, tag, classes, attrs): ...

    def closed(self): ...


class _Container(_Elements):
    def __init__(self, tag: str, css_class: str) -> None:
        super().__init__()
        self.wanted, self.depth, self.done = (tag, css_class), None, False
        self.parts: list[str] = []

    def opened(self, tag, classes, attrs):
        if self.depth is None and tag == self.wanted[0] and self.wanted[1] in classes:
            self.depth = len(self.open)

    def closed(self):
        if self.depth is not None and len(self.open) <= self.depth:
            self.done = True

    def handle_data(self, data):
        hidden = self.open and self.open[-1][0] in ("script", "style")
        if self.depth is not None and not self.done and not hidden:
            self.parts.append(data)


def _container(html: str | None, tag: str, css_class: str) -> str | None:
    if html is None or css_class not in html:
        return None
    parser = _Container(tag, css_class)
    parser.feed(html)
    parser.close()
    return None if parser.depth is None else "".join(parser.parts)


def container_text(html: Column, selectors: list[tuple[str, str]], phrase: str | None = None) -> Column:
    """Text of the first ``(element, class)`` selector found, nested parts included."""

    @F.pandas_udf(T.StringType())
    def found(pages: pd.Series) -> pd.Series:
        def pick(page):
            texts = (_container(page, tag, css_class) for tag, css_class in selectors)
            return next((t for t in texts if t is not None), None)

        return pages.map(pick)

    return _or_null(drop_lines(found(_complete_or_text(html)), phrase))


class _ChildLinks(_Elements):
    def __init__(self, parent: str, parent_not: str, css_class: str) -> None:
        super().__init__()
        self.rule, self.hrefs = (parent, parent_not, css_class), []

    def opened(self, tag, classes, attrs):
        parent, parent_not, css_class = self.rule
        if tag == "a" and css_class in classes and self.open and attrs.get("href") is not None:
            name, parent_classes = self.open[-1]
            if name == parent and parent_not not in parent_classes:
                self.hrefs.append(attrs["href"])


def child_links(html: Column, root: str, parent: str, parent_not: str, css_class: str) -> Column:
    """Absolute URLs of ``parent:not(.parent_not) > a.css_class``, in page order."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def found(pages: pd.Series) -> pd.Series:
        def hrefs(page):
            if page is None:
                return None
            parser = _ChildLinks(parent, parent_not, css_class)
            parser.feed(page)
            parser.close()
            return parser.hrefs

        return pages.map(hrefs)

    return F.transform(found(_complete(html)), lambda h: absolute_url(h, root))
