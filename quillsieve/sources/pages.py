"""Sources of article candidates: fetched feeds, listing pages, notices, embedded JSON and cards.

Fetching is a job of its own (``fetch``): one request per row in bounded batches, with retries.
All else works on tables of what was fetched, so it runs the same on stored pages.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.functions import articles, dates
from quillsieve.functions.html import cards, read_pages
from quillsieve.functions.text import first_of, normalize_title, strip_html, text
from quillsieve.functions.urls import absolute, bare_host, favicon, is_http, logo, publisher, source_kind
from quillsieve.functions.wordlists import BLOCKED_LINKS, BLOCKED_TEXT, BLOCKED_TITLES, DEVELOPER_PUBLISHERS
from quillsieve.operators.select import first_wins, greedy_unique, per_group_limit

CANDIDATE = ["title", "description", "articleText", "newsLink", "thumbnailImage", "postedBy", "postedByLogo", "createdAt", "publishedAt", "fetchedAt"]
LEAST_TITLE = 18


def fetch(df: DataFrame, url: str = "url", timeout: float = 15.0, attempts: int = 2, pause: float = 0.75, growing: bool = False, form: str | None = None, opener=None) -> DataFrame:
    """df with ``answer``: status, body (bytes) and error of a request for each URL; 404 and 410
    aren't retried, any other failure is an error of its own row.

    url: a column of URLs, or of arrays of URLs that are tried in order until one succeeds; growing:
    the pause grows with each attempt; form: a column of form data, which makes the request a POST.
    opener(url, timeout) -> (status, bytes) replaces the network, as in tests.
    """
    shape = T.StructType([T.StructField("status", T.IntegerType()), T.StructField("body", T.BinaryType()), T.StructField("error", T.StringType())])

    def get(u: str, data: str | None) -> tuple[int, bytes]:
        request = urllib.request.Request(u, data.encode() if data else None, headers={"User-Agent": "Mozilla/5.0 (compatible; quillsieve)"})
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.status, answer.read()

    def one(u: str, data: str | None) -> dict:
        last = ""
        for k in range(attempts):
            try:
                status, body = opener(u, timeout) if opener else get(u, data)
                return {"status": status, "body": body, "error": None}
            except urllib.error.HTTPError as e:
                last = f"HTTP {e.code}"
                if e.code in (404, 410):
                    return {"status": e.code, "body": None, "error": last}
            except Exception as e:  # a source that fails must not end the others
                last = str(e) or type(e).__name__
            if k + 1 < attempts:
                time.sleep(pause * (k + 1 if growing else 1))
        return {"status": None, "body": None, "error": last}

    def first(urls, data: str | None) -> dict:
        found = {"status": None, "body": None, "error": "no URL"}
        for u in [] if urls is None else urls:
            found = one(u, data)
            if found["error"] is None:
                break
        return found

    @F.pandas_udf(shape)
    def run(urls, data):
        import pandas as pd

        return pd.DataFrame([first(u, d) for u, d in zip(urls, data)], columns=shape.names)

    tried = F.col(url) if dict(df.dtypes)[url].startswith("array") else F.array_compact(F.array(url))
    return df.withColumn("answer", run(tried, F.col(form) if form else F.lit(None).cast("string")))


def dispatch(sources: DataFrame, url: str = "url") -> DataFrame:
    """Sources with the kind of scan that each takes."""
    return sources.withColumn("kind", source_kind(F.col(url)))


def read_feeds(feeds: DataFrame) -> DataFrame:
    """feeds (source, xml) with ``feed``: ok (whether it is XML), title, logo and items in order."""
    text_fields = ("title", "link", "guid", "content", "summary", "image", "published")
    item = T.StructType([T.StructField("pos", T.IntegerType()), *[T.StructField(n, T.StringType()) for n in text_fields]])
    shape = T.StructType([T.StructField("ok", T.BooleanType()), T.StructField("title", T.StringType()), T.StructField("logo", T.StringType()), T.StructField("items", T.ArrayType(item))])

    def read(xml: str | None) -> dict:
        import xml.etree.ElementTree as ET

        try:
            root = ET.fromstring(xml or "")
        except (ET.ParseError, ValueError):
            return {"ok": False, "title": "", "logo": "", "items": []}
        bare = lambda tag: tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""
        items: list[dict] = []
        head = {"title": "", "logo": ""}
        top = next((c for c in root if bare(c.tag) == "channel"), root)
        for c in top:
            if bare(c.tag) == "title":
                head["title"] = c.text or ""
            elif bare(c.tag) == "image":
                head["logo"] = next((x.text or "" for x in c if bare(x.tag) == "url"), c.get("href", ""))
            elif bare(c.tag) == "logo":
                head["logo"] = head["logo"] or c.text or ""
        for i in (x for x in root.iter() if bare(x.tag) in ("item", "entry")):
            v: dict[str, str] = {}
            for c in i:
                name = bare(c.tag)
                if name == "link":
                    v.setdefault("link", (c.text or "").strip() or c.get("href", ""))
                elif name in ("enclosure", "content", "thumbnail") and c.get("url"):
                    v.setdefault("image", c.get("url"))
                elif c.text:
                    v.setdefault(name, c.text)
            first = lambda *names, v=v: next((v[n] for n in names if n in v), "")
            items.append({"pos": len(items), "title": first("title"), "link": first("link"), "guid": first("guid", "id"), "content": first("encoded", "content"), "summary": first("description", "summary"), "image": first("image"), "published": first("pubDate", "published", "updated", "date")})
        return {"ok": True, **head, "items": items}

    @F.pandas_udf(shape)
    def parse(xml):
        import pandas as pd

        return pd.DataFrame([read(x) for x in xml], columns=shape.names)

    return feeds.withColumn("feed", parse("xml"))


def feed_items(feeds: DataFrame, limit: int = 300, now: Column | None = None) -> DataFrame:
    """Candidates of RSS and Atom feeds.

    feeds: source (its URL), xml (text), or what ``read_feeds`` makes of them. Fields fall back as
    feeds differ; the first ``limit`` items of a feed count, and an unreadable feed has none.
    """
    read = feeds if "feed" in feeds.columns else read_feeds(feeds)
    rows = read.select("source", "feed.title", "feed.logo", F.explode("feed.items").alias("i")).where(F.col("i.pos") < limit)
    link = F.when(F.col("i.link") != "", F.col("i.link")).otherwise(F.col("i.guid"))
    head = strip_html(F.col("i.title"))
    about = strip_html(first_of(F.col("i.summary"), F.col("i.content")))
    return rows.select(
        "source",
        F.col("i.pos").alias("pos"),
        head.alias("title"),
        F.when(about != "", about).otherwise(head).alias("description"),
        F.lit("").alias("articleText"),
        link.alias("newsLink"),
        absolute(F.col("i.image"), F.when(link != "", link).otherwise(F.col("source"))).alias("thumbnailImage"),
        first_of(F.col("title"), bare_host(F.col("source"))).alias("postedBy"),
        first_of(F.col("logo"), favicon(F.col("source"))).alias("postedByLogo"),
        F.col("i.published").alias("createdAt"),
        F.col("i.published").alias("publishedAt"),
        dates.iso_text(now if now is not None else F.current_timestamp()).alias("fetchedAt"),
    )


def blocked_link(title: Column, link: Column) -> Column:
    """Whether a link on a listing page is spam or a menu entry."""
    from quillsieve.functions.text import any_of
    from quillsieve.operators.rules import DEVANAGARI

    return F.lower(F.trim(title)).isin(BLOCKED_TITLES) | title.rlike(DEVANAGARI) | any_of(F.lower(title), BLOCKED_TEXT) | any_of(F.lower(link), BLOCKED_LINKS)


def listing_links(pages: DataFrame, limit: int = 300, now: Column | None = None) -> DataFrame:
    """Candidates from the links of listing pages.

    pages: source (its URL), page_no, html. A link stays if it is http(s), of the source's host,
    named by at least LEAST_TITLE characters, not blocked, and the source's first with its URL.
    """
    p = read_pages(pages, "html", fields=["page_title", "icon", "shortcut_icon", "links"])
    rows = p.select("source", "page_no", F.col("page.page_title").alias("page_title"), F.col("page.icon").alias("icon"), F.col("page.shortcut_icon").alias("shortcut"), F.posexplode("page.links").alias("pos", "a"))
    rows = rows.withColumns({"link": absolute(F.col("a.href"), F.col("source")), "name": F.col("a.title")})
    able = rows.where((F.col("link") != "") & (F.length("name") >= LEAST_TITLE) & (bare_host(F.col("link")) == bare_host(F.col("source"))) & ~blocked_link(F.col("name"), F.col("link")))
    first = per_group_limit(first_wins(able, ["source", "link"], ["page_no", "pos"]), ["source"], ["page_no", "pos"], limit)
    when = dates.iso_text(dates.parse(F.concat_ws(" ", "name", "a.near")))
    return first.select(
        "source",
        "page_no",
        "pos",
        F.col("name").alias("title"),
        F.col("name").alias("description"),
        F.lit("").alias("articleText"),
        F.col("link").alias("newsLink"),
        absolute(F.col("a.image"), F.col("source")).alias("thumbnailImage"),
        publisher(F.col("source"), F.col("page_title")).alias("postedBy"),
        logo([F.col("icon"), F.col("shortcut")], F.col("source")).alias("postedByLogo"),
        F.lit("").alias("createdAt"),
        when.alias("publishedAt"),
        dates.iso_text(now if now is not None else F.current_timestamp()).alias("fetchedAt"),
    )


def official(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Candidates of official media cards.

    rows: source, title, about, body, link, image, date (texts).
    """
    source = F.col("source")
    names = F.create_map(*[F.lit(x) for pair in DEVELOPER_PUBLISHERS.items() for x in pair])
    by = F.coalesce(F.try_element_at(names, bare_host(source)), bare_host(source))
    head = strip_html(F.col("title"))
    about = F.when(text(F.col("about")) != "", strip_html(F.col("about"))).otherwise(head)
    body = F.when(text(F.col("body")) != "", F.col("body")).otherwise(about)
    when = dates.iso_text(dates.parse(F.col("date")))
    picture = absolute(F.col("image"), source)
    return rows.select(
        *[c for c in rows.columns if c not in ("title", "about", "body", "link", "image", "date")],
        head.alias("title"),
        about.alias("description"),
        strip_html(F.concat(body, F.lit(" "), by, F.lit(" official real estate media update."))).alias("articleText"),
        absolute(F.when(text(F.col("link")) != "", F.col("link")).otherwise(source), source).alias("newsLink"),
        F.when(picture != "", picture).otherwise(favicon(source)).alias("thumbnailImage"),
        by.alias("postedBy"),
        favicon(source).alias("postedByLogo"),
        when.alias("createdAt"),
        when.alias("publishedAt"),
        dates.iso_text(now if now is not None else F.current_timestamp()).alias("fetchedAt"),
    )


#: host, classes of a card, tag of its date, whether the link is the image (fixed values).
CARD_PAGES = [("dlf.in", "news_box.media_news", "span", True), ("smartworlddevelopers.com", "mediabox", "h5", False), ("centralpark.in", "board-thumb", "h5", False)]
#: Host whose cards have their title as the first line of a paragraph (fixed value).
LINED = "centralpark.in"


def card_rows(pages: DataFrame) -> DataFrame:
    """source, title, about, body, link, image, date of the cards on official pages (source, html)."""
    out = None
    for host, box, date_tag, image_from_link in CARD_PAGES:
        one = cards(pages.where(bare_host(F.col("source")) == host), "html", box, date_tag, image_from_link).select("source", F.col("card_no").alias("pos"), "card.*")
        if host == LINED:
            one = _lined(one)
        out = one if out is None else out.union(one)
    return out


def _lined(rows: DataFrame) -> DataFrame:
    """Cards whose first paragraph has the title as its first line and the description after it; an
    award that is named first goes behind what it was given for."""
    lines = F.filter(F.transform(F.split("about", r"\r?\n"), lambda x: strip_html(x)), lambda x: x != "")
    r = rows.withColumn("lines", lines).withColumn("head", F.coalesce(F.get("lines", F.lit(0)), F.lit("")))
    r = r.withColumn("rest", F.array_join(F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(1))), " "))
    about = F.when(F.col("rest") != "", F.col("rest")).otherwise(F.col("head"))
    told = F.regexp_replace(about, r"(?is),\s+including(?![A-Za-z0-9_]).*$", "")
    title = F.when((F.col("rest") != "") & F.col("head").rlike("(?i)awards?"), F.concat(told, F.lit(" at "), F.col("head"))).otherwise(F.col("head"))
    return r.withColumns({"title": title, "body": F.array_join("lines", " "), "about": about}).select(*rows.columns)


def official_unique(rows: DataFrame, limit: int = 300) -> DataFrame:
    """Of official candidates (source, pos and an article's columns) those that repeat no link and no
    title of their source, in order, at most ``limit`` of a source."""
    full = rows.withColumns({"cityCode": F.lit(""), "url": F.lit("")})
    own = lambda x: F.concat(F.col("source"), F.lit(" "), x)
    ids = F.transform(F.array_distinct(F.filter(F.array(articles.stable_id(), articles.link_id(), articles.title_id()), lambda x: x != "")), own)
    ranked = full.withColumns({"ids": ids, "rank": F.struct("source", "pos")}).drop("cityCode", "url")
    return per_group_limit(greedy_unique(ranked, "rank", "ids"), ["source"], ["pos"], limit).drop("ids", "rank")


#: Tabs of the paged API, in order (fixed values).
TABS = ["news", "press_release", "event"]


def api_rows(answers: DataFrame) -> DataFrame:
    """The same from stored answers of a paged JSON API: source, tab, page_no, json. A tab ends at
    its first page without rows, or after the page that its answers call the last."""
    shape = "struct<data:array<struct<title:string,description:string,link:string,image:string,date_time:string>>,last_page:int>"
    j = answers.withColumn("j", F.from_json("json", shape)).withColumns({"n": F.coalesce(F.size("j.data"), F.lit(0)), "last": F.coalesce("j.last_page", F.lit(0))})
    ends = j.groupBy("source", "tab").agg(F.min(F.when((F.col("n") <= 0) | (F.col("last") == 0) | (F.col("page_no") >= F.col("last")), F.struct("page_no", "n"))).alias("e"))
    open_ = j.join(ends, ["source", "tab"]).where(F.col("e").isNull() | (F.col("page_no") < F.col("e.page_no")) | ((F.col("page_no") == F.col("e.page_no")) & (F.col("n") > 0)))
    r = open_.select("source", "tab", "page_no", F.posexplode("j.data").alias("n_in_page", "d"))
    about = F.when(text(F.col("d.description")) != "", F.col("d.description")).otherwise(F.col("d.title"))
    link = F.coalesce(F.nullif(text(F.col("d.link")), F.lit("")), F.nullif(text(F.col("d.image")), F.lit("")), F.col("source"))
    place = F.coalesce(F.try_element_at(F.create_map(*[x for i, t in enumerate(TABS) for x in (F.lit(t), F.lit(i))]), F.col("tab")), F.lit(len(TABS)))
    pos = (place * 1_000_000 + F.col("page_no") * 1000 + F.col("n_in_page")).cast("int")
    return r.select("source", pos.alias("pos"), F.col("d.title").alias("title"), about.alias("about"), about.alias("body"), link.alias("link"), F.col("d.image").alias("image"), F.col("d.date_time").alias("date"))


def embedded_blog_rows(pages: DataFrame) -> DataFrame:
    """The same from the JSON that a page embeds (source, json): its first news block's blogs."""
    v = F.try_parse_json("json")
    item = "array<struct<title:string,source_link:string,date:string,desktop_image:struct<url:string>,mobile_image:struct<url:string>>>"
    at = lambda root: F.try_variant_get(v, f"{root}.pageProps.newsData[0].media_blog", item)
    d = pages.select("source", F.posexplode(F.coalesce(at("$.props"), at("$"))).alias("pos", "d"))
    return d.select("source", "pos", F.col("d.title").alias("title"), F.col("d.title").alias("about"), F.col("d.title").alias("body"), F.col("d.source_link").alias("link"), F.coalesce("d.desktop_image.url", "d.mobile_image.url").alias("image"), F.col("d.date").alias("date"))


def embedded_media(pages: DataFrame, limit: int = 300, now: Column | None = None) -> DataFrame:
    """Candidates from media lists in embedded JSON (source, json): news, then press releases; the
    first of each normalised title counts."""
    v = F.try_parse_json("json")
    get = lambda x, path: F.try_variant_get(x, path, "string")
    out = None
    for rank, (key, label) in enumerate((("newsData", "media"), ("pressReleasesData", "press release"))):
        items = F.try_variant_get(v, f"$.props.pageProps.{key}", "array<variant>")
        one = pages.select("source", F.lit(rank).alias("rank"), F.lit(label).alias("label"), F.posexplode(items).alias("pos", "i"))
        out = one if out is None else out.unionByName(one)
    i = F.col("i")
    plain = lambda path: F.when(~F.coalesce(get(i, path), F.lit("")).startswith("{"), get(i, path))
    head = first_of(get(i, "$.acf.title"), get(i, "$.title.rendered"), plain("$.title"))
    rows = out.withColumns({"head": strip_html(head), "key": normalize_title(strip_html(head))}).where("key <> ''")
    rows = per_group_limit(first_wins(rows, ["source", "key"], ["rank", "pos"]), ["source"], ["rank", "pos"], limit)
    pictures = [p for base in ("$.acf.image", "$.acf.banner", "$.featured_image", '$._embedded["wp:featuredmedia"][0]') for p in (base, f"{base}.source_url", f"{base}.url", f"{base}.guid.rendered", f"{base}.sizes.large")]
    picture = F.coalesce(*[F.nullif(F.when(~text(get(i, p)).rlike(r"^[\[{]"), text(get(i, p))), F.lit("")) for p in pictures], F.lit(""))
    about = strip_html(first_of(get(i, "$.acf.desc"), get(i, "$.acf.meta_description"), get(i, "$.excerpt.rendered"), get(i, "$.content.rendered"), F.col("head")))
    when = dates.iso_text(dates.parse(first_of(get(i, "$.date_gmt"), get(i, "$.date"))))
    link = first_of(F.when(~text(get(i, "$.acf.external_link")).startswith("{"), get(i, "$.acf.external_link")), get(i, "$.acf.external_link.url"), get(i, "$.acf.external_link.href"), get(i, "$.acf.external_link.link"), get(i, "$.link"))
    shown = absolute(picture, F.col("source"))
    return rows.select(
        "source",
        "rank",
        "pos",
        F.col("head").alias("title"),
        about.alias("description"),
        strip_html(F.concat(about, F.lit(" BPTP "), F.col("label"), F.lit(" real estate update."))).alias("articleText"),
        link.alias("newsLink"),
        F.when(shown != "", shown).otherwise(favicon(F.col("source"))).alias("thumbnailImage"),
        F.lit("BPTP Media").alias("postedBy"),
        F.lit("https://cms.bptp.com/wp-content/uploads/2025/01/logo.svg").alias("postedByLogo"),
        when.alias("createdAt"),
        when.alias("publishedAt"),
        dates.iso_text(now if now is not None else F.current_timestamp()).alias("fetchedAt"),
    )


# FIXED VALUES: the pattern of a notice's path, its places and sites, and the sentences about it.
NOTICE = r"(?i)/documents/notices/NEWS_\d+.*\.pdf"
PLACES = ["Budena", "Tikawali", "Kheri Kalan", "Bhupani"]
SITES = [(r"(?i)(?:^|\d)PS|Primary", "primary school"), (r"(?i)(?:^|\d)NS|nursery", "nursery school"), (r"(?i)(?:^|\d)HS|High", "high school"), (r"(?i)Dispensary|HF|Health", "health facility"), (r"(?i)Creche", "creche")]


def notice_links(pages: DataFrame, limit: int = 300) -> DataFrame:
    """source, notice (URL), card title of the notices that pages (source, html) link to."""
    rows = read_pages(pages, "html", fields=["links"]).select("source", F.posexplode("page.links").alias("pos", "a"))
    rows = rows.withColumn("notice", absolute(F.col("a.href"), F.col("source"))).where(F.col("notice").rlike(NOTICE))
    first = per_group_limit(first_wins(rows, ["source", "notice"], ["pos"]), ["source"], ["pos"], limit)
    return first.select("source", "pos", "notice", F.when(F.col("a.title").rlike("(?i)^view(?![A-Za-z0-9_])") | (F.col("a.title") == ""), F.col("a.near")).otherwise(F.col("a.title")).alias("card"))


def notice_articles(notices: DataFrame, now: Column | None = None) -> DataFrame:
    """Candidates from notices: source, notice, card, content (the file's bytes).

    URLs are read from the bytes as Latin-1. A notice without a link to the city makes none.
    """
    found = F.filter(F.regexp_extract_all(F.decode("content", "ISO-8859-1"), F.lit(r"https?://[^\s)<>]+"), F.lit(0)), lambda x: is_http(x) & F.lower(x).contains("faridabad"))
    r = notices.withColumn("links", found).where(F.size("links") > 0)
    number = F.flatten(F.transform("links", lambda x: F.regexp_extract_all(x, F.lit(r"(?i)sector\s*-?\s*(\d{1,3})"), F.lit(1))))
    sectors = F.transform(F.array_sort(F.array_distinct(F.transform(number, lambda x: x.cast("int")))), lambda x: F.concat(F.lit("Sector "), x.cast("string")))
    joined = F.lower(F.regexp_replace(F.array_join("links", " "), r"\s+", ""))
    places = F.array_compact(F.array(*[F.when(F.contains(joined, F.lit(p.lower().replace(" ", ""))), F.lit(p)) for p in PLACES]))
    labels = F.array_join(F.transform("links", lambda x: F.element_at(F.split(F.regexp_replace(x, "[?#].*$", ""), "/"), -1)), " ")
    sites = F.array_compact(F.array(*[F.when(labels.rlike(p), F.lit(name)) for p, name in SITES]))
    r = r.withColumns({"sectors": sectors, "places": places, "sites": sites})
    where = F.when(F.size("sectors") > 0, F.array_join("sectors", ", ")).otherwise(F.lit("Faridabad sectors"))
    across = F.when(F.size("places") > 0, F.concat(F.lit(" across "), F.array_join("places", ", "))).otherwise(F.lit(""))
    kind = F.when(F.size("sites") > 0, F.lit("institutional and social infrastructure")).otherwise(F.lit("social infrastructure"))
    head = F.when(F.col("card").rlike("(?i)commercial|community"), F.lit("HSVP e-auction pipeline includes Faridabad commercial and community sites")).otherwise(F.concat(F.lit("HSVP July e-auction demarcation plan lists Faridabad sites in "), where))
    about = F.concat(F.lit("HSVP's July 2026 e-auction material lists Faridabad "), kind, F.lit(" sites in "), where, across, F.lit(", adding a positive authority-backed development pipeline signal."))
    when = dates.iso_text(dates.notice_date(F.col("notice")))
    return r.select(
        "source",
        "sectors",
        "places",
        "sites",
        head.alias("title"),
        about.alias("description"),
        F.concat(about, F.lit(" Source notice: "), F.col("card"), F.lit(". Faridabad-linked plan references: "), F.size("links").cast("string"), F.lit(".")).alias("articleText"),
        F.col("notice").alias("newsLink"),
        favicon(F.col("source")).alias("thumbnailImage"),
        F.lit("Haryana Shehri Vikas Pradhikaran (HSVP)").alias("postedBy"),
        favicon(F.col("source")).alias("postedByLogo"),
        when.alias("createdAt"),
        when.alias("publishedAt"),
        dates.iso_text(now if now is not None else F.current_timestamp()).alias("fetchedAt"),
    )
