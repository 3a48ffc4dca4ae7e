"""What is read from an HTML page: title, main text, description, dates, image, links, cards.

Pages are parsed by the standard library's parser inside one Arrow batch function; only scalars
leave it, and only those that are asked for. A page is walked once, and once more after page
furniture is gone; what an element lies in is noted when it is made. A page that can't be parsed
is a null and ends nothing. Elements are found by tag, id, class and attribute tests. The main text is taken after
elements of page furniture are removed; ``strip_before_metadata`` says whether images and dates
are then looked for in what is left (as the pipeline does) or in the whole page.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.functions import dates
from quillsieve.functions.text import first_description, first_of, strip_html
from quillsieve.functions.urls import absolute, favicon, publisher
from quillsieve.functions.wordlists import REJECTED_IMAGES

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "noscript"}
CLOSES = {"a": {"a"}, "p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
#: Tags and parts of class names and ids that are removed before the main text is taken.
FURNITURE_TAGS = {"script", "style", "noscript", "nav", "header", "footer", "aside", "form", "button", "iframe"}
FURNITURE_CLASSES = ("related", "recommend", "trending", "popular", "sidebar", "share", "social", "comment")
FURNITURE_IDS = ("related", "recommend", "trending", "popular", "sidebar")
LEAST_TEXT, MOST_TEXT = 120, 5000
DATE_KEYS = ("datePublished", "dateCreated", "uploadDate", "dateModified")
SOURCES_OF_IMAGE = ("data-src", "data-original", "data-lazy-src", "data-lazy", "data-url", "content", "srcset", "data-srcset", "src")
_REJECTED = re.compile(REJECTED_IMAGES, re.I)
_SPACE = re.compile(r"[\s﻿]+")
_ENTITIES = [("nbsp", " "), ("amp", "&"), ("quot", '"'), ("apos", "'"), ("rsquo", "'"), ("lsquo", "'"), ("rdquo", '"'), ("ldquo", '"'), ("ndash", "-"), ("mdash", "-"), ("#39", "'")]


#: What an element can lie in, as bits.
IN_ARTICLE, IN_MAIN, IN_FIGURE, IN_ARTICLE_CLASS, IN_STORY_CLASS, IN_CONTENT_CLASS = (1 << k for k in range(6))
_TAG_BITS = {"article": IN_ARTICLE, "main": IN_MAIN, "figure": IN_FIGURE}
_CLASS_BITS = {"article": IN_ARTICLE_CLASS, "story": IN_STORY_CLASS, "content": IN_CONTENT_CLASS}
#: Characters, blanks apart, that the text of a link or of the box around it is made from.
NEAR_CHARS, NEAR = 24_000, 3000


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "inside")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.inside = parent.inside | parent.bits() if parent else 0

    def bits(self) -> int:
        """What an element in this one lies in because of it."""
        cls = self.get("class")
        return _TAG_BITS.get(self.tag, 0) | (sum(b for w, b in _CLASS_BITS.items() if w in cls) if cls else 0)

    def walk(self) -> list[Node]:
        """Elements below, in document order; no recursion, so depth has no limit."""
        out: list[Node] = []
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            out.append(n)
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))
        return out

    def text(self, most: int | None = None) -> str:
        """The text within; with ``most`` only until so many characters, blanks apart, are there."""
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack and (most is None or most > 0):
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
                if most is not None:
                    most -= len(x) - x.count(" ")
            else:
                stack.extend(reversed(x.children))
        return "".join(out)

    def get(self, name: str) -> str:
        return self.attrs.get(name, "")


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        up = self.at
        if tag in CLOSES and up.tag in CLOSES[tag]:
            up = up.parent
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, up)
        up.children.append(node)
        self.at = up if tag in VOID else node

    def handle_endtag(self, tag):
        up = self.at
        while up is not None and up.tag != tag:
            up = up.parent
        if up is not None and up.parent is not None:
            self.at = up.parent

    def handle_data(self, data):
        self.at.children.append(data)


#: What holds no references (comments, scripts, styles), or an ampersand and the reference it begins.
_AMPERSAND = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1|\Z)|&(#\d+;|#x[0-9a-f]+;|[a-z][a-z0-9]*;)?", re.I | re.S)


def closed_references(html: str) -> str:
    """html in which only references that end with a semicolon are ones; browsers read some without."""

    def one(m: re.Match) -> str:
        if m[0][0] == "<" or m[2] and (m[2][0] == "#" or m[2] in html5):
            return m[0]
        return "&amp;" + m[0][1:]

    return _AMPERSAND.sub(one, html)


def parse(html: str | None, closed_only: bool = False) -> Node:
    b = _Builder()
    b.feed(closed_references(html or "") if closed_only else html or "")
    b.close()
    return b.root


def squeeze(value: str) -> str:
    """Text without tags and with common entities decoded; like ``text.strip_html``."""
    value = re.sub(r"<[^>]*>", " ", value)
    for name, to in _ENTITIES:
        value = re.sub(f"&{name};", to, value, flags=re.I)
    fit = lambda code, text: chr(code) if code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else text
    value = re.sub(r"&#x([0-9a-f]{1,8});", lambda m: fit(int(m[1], 16), m[0]), value, flags=re.I)
    value = re.sub(r"&#(\d{1,9});", lambda m: fit(int(m[1]), m[0]), value)
    return _SPACE.sub(" ", value).strip()


def first_text(*values: str | None) -> str:
    return next((v.strip() for v in values if v and v.strip()), "")


class Page:
    """A parsed page with its elements in order and by tag."""

    def __init__(self, root: Node):
        self.root, self.nodes = root, root.walk()
        self.by_tag: dict[str, list[Node]] = {}
        self.metas: dict[tuple[str, str], str] = {}
        for n in self.nodes:
            self.by_tag.setdefault(n.tag, []).append(n)
            if n.tag == "meta":
                for key in ("property", "name", "itemprop"):
                    if key in n.attrs:
                        self.metas.setdefault((key, n.attrs[key]), n.get("content"))

    def meta(self, key: str, value: str) -> str:
        return self.metas.get((key, value), "")

    def of(self, tag: str) -> list[Node]:
        return self.by_tag.get(tag, [])


def title(page: Page) -> str:
    h1 = next((n.text() for n in page.of("h1")), "")
    found = first_text(page.meta("property", "og:title"), page.meta("name", "twitter:title"), h1, "".join(n.text() for n in page.of("title")))
    return re.sub(r"\s+[|-]\s+.*$", "", squeeze(found))


def strip_furniture(root: Node) -> None:
    def bad(n: Node) -> bool:
        cls, name = n.get("class"), n.get("id")
        return n.tag in FURNITURE_TAGS or n.get("role") == "navigation" or any(x in cls for x in FURNITURE_CLASSES) or any(x in name for x in FURNITURE_IDS)

    stack = [root]
    while stack:
        n = stack.pop()
        n.children = [c for c in n.children if isinstance(c, str) or not bad(c)]
        stack.extend(c for c in n.children if isinstance(c, Node))


def main_text(page: Page) -> str:
    """The longest text of the article-like containers; else all paragraphs."""
    part = lambda bit, word: lambda n: n.inside & bit and word in n.get("class")
    tests = [part(IN_ARTICLE, w) for w in ("story", "article", "content")]
    tests += [lambda n: n.tag == "article", lambda n: n.tag == "article" and n.inside & IN_MAIN]
    tests += [part(IN_MAIN, w) for w in ("story", "article", "content")]
    best = ""
    for test in tests:
        found = squeeze("".join(n.text() for n in page.nodes if test(n)))
        if len(found) >= LEAST_TEXT and len(found) > len(best):
            best = found
    return (best or squeeze(" ".join(n.text() for n in page.of("p"))))[:MOST_TEXT]


def structured(page: Page) -> list:
    out = []
    for n in page.of("script"):
        if n.get("type") == "application/ld+json":
            try:
                out.append(json.loads(n.text()))
            except (ValueError, RecursionError):
                continue
    return out


def structured_dates(value) -> Iterator[str]:
    """Candidate dates of a JSON value: an object's own by priority, then its children's."""
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, list):
            stack.extend(reversed(v))
        elif isinstance(v, dict):
            yield from (str(v[k]) for k in DATE_KEYS if v.get(k) and isinstance(v[k], str | int | float))
            stack.extend(reversed(list(v.values())))


def structured_image(value) -> str:
    """The image that a JSON value names: itself, a URL of its own, or one of its image parts."""
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, str) and v:
            return v
        if isinstance(v, list):
            stack.extend(reversed(v))
        elif isinstance(v, dict):
            for k in ("url", "contentUrl"):
                if isinstance(v.get(k), str) and v[k].strip():
                    return v[k].strip()
            stack.extend(v.get(k) for k in ("primaryImageOfPage", "thumbnailUrl", "thumbnail", "image"))
    return ""


def image_of(n: Node) -> str:
    first = lambda v: next((p for e in v.split(",") if (p := (e.split() or [""])[0])), "")
    return first_text(*[first(n.get(k)) if "srcset" in k else n.get(k) for k in SOURCES_OF_IMAGE])


def rejected(value: str) -> bool:
    return not value or value.lower().startswith("data:") or bool(_REJECTED.search(value))


def page_image(page: Page) -> str:
    images = page.of("img")
    within = lambda bit: [n for n in images if n.inside & bit]
    groups = [
        [n for n in page.nodes if n.get("id") == "zoom_class"],
        [n for n in images if "story image" in n.get("alt").lower()],
        [n for n in images if "zoom" in n.get("class").lower()],
        *[within(bit) for bit in (IN_ARTICLE, IN_MAIN, IN_ARTICLE_CLASS, IN_STORY_CLASS, IN_CONTENT_CLASS, IN_FIGURE)],
        images,
    ]
    return next((found for group in groups for n in group if not rejected(found := image_of(n))), "")


def image(page: Page, fallback: str = "") -> str:
    """A page's image: in the page, in structured data, in its metadata, the fallback."""
    data = next((i for v in structured(page) if (i := structured_image(v))), "")
    named = [page.meta("property", "og:image:secure_url"), page.meta("property", "og:image"), page.meta("name", "twitter:image"), page.meta("name", "twitter:image:src"), page.meta("itemprop", "image")]
    return first_text(page_image(page), *[x for x in [data, *named, fallback] if x and not rejected(x)])


def date_texts(page: Page) -> list[str]:
    """Texts to look for the publication date in, best first; the first that holds one counts."""
    attr = lambda test, name: next((n.get(name) for n in page.nodes if test(n)), "")
    found = [page.meta("property", "article:published_time"), *[page.meta("name", k) for k in ("publish-date", "pubdate", "date")]]
    found.append(attr(lambda n: n.get("itemprop") == "datePublished", "content"))
    found.append(attr(lambda n: n.tag == "time" and "datetime" in n.attrs, "datetime"))
    found += [d for v in structured(page) for d in structured_dates(v)]
    found.append(next((n.text() for n in page.nodes if n.tag in ("article", "main")), "")[:1500])
    found.append(next((n.text() for n in page.of("body")), "")[:3000])
    return [x for x in found if x.strip()]


def links(page: Page) -> list[dict]:
    """Links with their text, the text of the box around them and a picture. Each box is read once."""
    boxes: dict[int, str] = {}
    out = []
    for n in page.of("a"):
        if "href" not in n.attrs:
            continue
        box: Node | None = n
        while box is not None and box.tag not in ("article", "li", "div"):
            box = box.parent
        if box is not None and id(box) not in boxes:
            boxes[id(box)] = squeeze(box.text(NEAR_CHARS))[:NEAR]
        picture = next((image_of(i) for i in n.walk() if i.tag == "img"), "")
        out.append({"href": n.get("href"), "title": squeeze(n.text(NEAR_CHARS)), "near": boxes[id(box)] if box else "", "image": "" if rejected(picture) else picture})
    return out


PAGE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("title", "page_title", "text", "og_description", "description", "image", "icon", "shortcut_icon", "next_data")]
    + [T.StructField("dates", T.ArrayType(T.StringType()))]
    + [T.StructField("links", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("href", "title", "near", "image")])))]
)


def read_page(html: str | None, strip_before_metadata: bool = True, fields: list[str] | None = None, closed_only: bool = False) -> dict | None:
    """The fields of PAGE, all or those named; None for a page that can't be parsed. closed_only:
    references without a semicolon stay as they are written."""
    try:
        page = Page(parse(html, closed_only))
    except Exception:  # html.parser raises on some malformed declarations
        return None
    rel = lambda x: next((n.get("href") for n in page.of("link") if n.get("rel") == x), "")
    makers = {
        "title": lambda: title(page),
        "page_title": lambda: "".join(n.text() for n in page.of("title")),
        "og_description": lambda: page.meta("property", "og:description"),
        "description": lambda: page.meta("name", "description"),
        "icon": lambda: rel("icon"),
        "shortcut_icon": lambda: rel("shortcut icon"),
        "next_data": lambda: next((n.text() for n in page.nodes if n.get("id") == "__NEXT_DATA__"), ""),
        "links": lambda: links(page),
    }
    late = {"image": lambda: image(page), "dates": lambda: date_texts(page)}
    wanted = fields or PAGE.names
    out = {k: make() for k, make in (makers if strip_before_metadata else makers | late).items() if k in wanted}
    rest = [k for k in wanted if k not in out]
    if rest:
        strip_furniture(page.root)
        page = Page(page.root)
        out |= {k: make() for k, make in {"text": lambda: main_text(page), **late}.items() if k in rest}
    return out


def read_pages(df: DataFrame, html: str = "html", out: str = "page", strip_before_metadata: bool = True, fields: list[str] | None = None, closed_only: bool = False) -> DataFrame:
    """df with a struct of fields of each page: those of PAGE that are named, or all. A null page has
    empty fields; one that can't be parsed is a null, whatever else is in its batch."""
    kind = T.StructType([f for f in PAGE if fields is None or f.name in fields])

    @F.pandas_udf(T.ArrayType(kind))
    def read(pages):
        import pandas as pd

        return pd.Series([[] if (page := read_page(p, strip_before_metadata, fields, closed_only)) is None else [page] for p in pages])

    return df.withColumn(out, F.get(read(F.col(html).cast("string")), F.lit(0)))


def cards(df: DataFrame, html: str, box: str, date_tag: str, image_from_link: bool) -> DataFrame:
    """A row for each card (an element whose classes include those of ``box``): title, about,
    body, link, image, date."""
    wanted = set(box.split("."))
    kind = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("title", "about", "body", "link", "image", "date")]))

    def read(page: str | None) -> list[dict]:
        out = []
        try:
            nodes = parse(page).walk()
        except Exception:  # as in read_page
            return out
        for n in nodes:
            if wanted <= set(n.get("class").split()):
                below = n.walk()
                text = lambda tag, below=below: next((x.text() for x in below if x.tag == tag), "")
                attr = lambda tag, name, below=below: next((x.get(name) for x in below if x.tag == tag and name in x.attrs), "")
                link, picture = attr("a", "href"), attr("img", "src")
                out.append({"title": text("h4"), "about": text("p"), "body": n.text(), "link": link or ("" if image_from_link else picture), "image": link if image_from_link else picture, "date": text(date_tag)})
        return out

    @F.pandas_udf(kind)
    def all_cards(pages):
        return pages.map(read)

    return df.select("*", F.posexplode(all_cards(F.col(html).cast("string"))).alias("card_no", "card"))


def published(candidates: Column, fallback: Column | None = None) -> Column:
    """The first of the texts that holds a date, as ISO text."""
    found = F.filter(F.transform(candidates, lambda x: dates.iso_text(dates.parse(x))), lambda x: x != "")
    own = F.coalesce(F.get(found, F.lit(0)), F.lit(""))
    return own if fallback is None else first_of(own, dates.iso_text(dates.parse(fallback)), fallback)


def direct_articles(df: DataFrame, url: str, html: str, now: Column, closed_only: bool = False) -> DataFrame:
    """Article rows of pages that are articles themselves."""
    p = read_pages(df, html, fields=["title", "page_title", "og_description", "description", "text", "image", "icon", "shortcut_icon", "dates"], closed_only=closed_only)
    link = F.col(url)
    head = first_of(F.col("page.title"))
    when = published(F.col("page.dates"))
    return p.select(
        *[c for c in df.columns if c not in (html, url)],
        head.alias("title"),
        first_of(first_description(F.col("page.og_description"), F.col("page.description")), head).alias("description"),
        F.col("page.text").alias("articleText"),
        link.alias("newsLink"),
        absolute(F.col("page.image"), link).alias("thumbnailImage"),
        publisher(link, F.col("page.page_title")).alias("postedBy"),
        first_of(absolute(F.col("page.icon"), link), absolute(F.col("page.shortcut_icon"), link), favicon(link)).alias("postedByLogo"),
        when.alias("createdAt"),
        when.alias("publishedAt"),
        dates.iso_text(now).alias("fetchedAt"),
    )


def enrich(candidates: DataFrame, pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Candidates with what their pages say; without a page, or with one that can't be parsed, a
    candidate stays as it is."""
    p = read_pages(pages.select(F.col(url).alias("__url"), F.col(html).alias("__html")), "__html", fields=["og_description", "description", "text", "image", "dates"])
    j = candidates.join(p.select("__url", "page"), F.col("newsLink") == F.col("__url"), "left")
    have = F.col("page").isNotNull()
    about = first_of(first_description(F.col("page.og_description"), F.col("page.description"), F.col("description")), F.col("title"))
    when = published(F.col("page.dates"), F.col("publishedAt"))
    return j.withColumns(
        {
            "description": F.when(have, strip_html(about)).otherwise(F.col("description")),
            "articleText": F.when(have, F.col("page.text")).otherwise(F.col("articleText")),
            "thumbnailImage": F.when(have, absolute(first_of(F.col("page.image"), F.col("thumbnailImage")), F.col("newsLink"))).otherwise(F.col("thumbnailImage")),
            "publishedAt": F.when(have, when).otherwise(F.col("publishedAt")),
        }
    ).withColumn("createdAt", F.coalesce("publishedAt", F.lit(""))).drop("page", "__url")
