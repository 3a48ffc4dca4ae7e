"""Text, URL, date and HTML functions on values with known results."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from quillsieve.functions import dates, html, urls
from quillsieve.functions import text as t
from quillsieve.operators import select
from quillsieve.sources.options import Options, parse_settings, positive, split_values


def each(spark, values, make):
    """make(column) of each value, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_strip_and_clean(spark):
    given = [None, "", "<p>a&nbsp;&amp;nbsp;b</p>", "&amp;quot;x&quot; &#39;&rsquo;", "&#x1F600;&#65;&#x110000;&#55296;", "a  b﻿", "&lt;b&gt;"]
    assert each(spark, given, t.strip_html) == ["", "", "a &nbsp;b", '"x" \'\'', "\U0001f600A&#x110000;&#55296;", "a b", "&lt;b&gt;"]
    assert each(spark, ["abc def ghi", "abcdefghijk", "a​b", "ab cd"], lambda c: t.clean_text(c, 7)) == ["abc.", "abcdefg.", "ab", "ab cd"]
    titles = ["Oberoi bets big on GurugramJul 8, 2026 11:09 AM IST", "Video: A plan | Latest News", "Sale 12 July 2026 report", "Plain - story"]
    assert each(spark, titles, t.clean_title) == ["Oberoi bets big on Gurugram", "A plan", "Sale", "Plain - story"]
    assert each(spark, ["A&B  c-D!", "é", None], t.normalize_title) == ["a and b c d", "", ""]
    assert each(spark, ["Your Description", " real ", ""], lambda c: t.first_description(c, F.lit("other"))) == ["other", "real", "other"]


def test_matching(spark):
    given = ["enoida noida.", "greater faridabad and faridabad", "today tod", "énoida", ""]
    assert each(spark, given, lambda c: t.any_word(c, ["noida"])) == [True, False, False, True, False]
    assert each(spark, given, lambda c: t.any_of(c, ["tod"])) == [False, False, True, False, False]
    assert each(spark, given, lambda c: t.mentions(c, ["greater faridabad", "faridabad"])) == [0, 3, 0, 0, 0]


def test_urls(spark):
    given = ["https://WWW.Example.com:443/a/b/?x=1#y", "http://example.com", "nonsense", None]
    assert each(spark, given, urls.canonical)[:2] == ["https://www.example.com/a/b/", "http://example.com/"]
    assert each(spark, given, urls.is_http) == [True, True, False, False]
    refs = ["https://o.org/x", "//o.org/x", "/r?q=1", "c/../d", "?z=2", "#f", "mailto:a@b.c", "", "../../../up"]
    got = each(spark, refs, lambda c: urls.absolute(c, F.lit("https://e.com/p/q?s=1")))
    assert got == ["https://o.org/x", "https://o.org/x", "https://e.com/r?q=1", "https://e.com/p/d", "https://e.com/p/q?z=2", "https://e.com/p/q?s=1#f", "", "", "https://e.com/up"]
    feeds = ["https://e.com/real-estate", "https://e.com/feed", "https://e.com/rss.xml", "https://e.com/x?format=rss", "https://e.com/feeder"]
    assert each(spark, feeds, urls.is_feed) == [False, True, True, True, False]
    kinds = ["https://www.hsvphry.org.in/", "https://www.bptp.com/media/", "https://m3mindia.com/media", "https://e.com/a.atom", "https://e.com/a"]
    assert each(spark, kinds, urls.source_kind) == ["notices", "embedded", "official", "feed", "page"]
    paged = each(spark, ["https://realty.economictimes.indiatimes.com/tag/faridabad", "https://propnewstime.com/", "https://www.hindustantimes.com/real-estate", "https://indianexpress.com/about/a/", "https://e.com/"], lambda c: F.slice(urls.page_urls(c), 1, 2))
    assert [p[-1] for p in paged] == ["https://realty.economictimes.indiatimes.com/tag/faridabad/2", "https://propnewstime.com/page/2/", "https://www.hindustantimes.com/real-estate/page-2", "https://indianexpress.com/about/a/page/2/", "https://e.com/"]
    amp = each(spark, ["https://economictimes.indiatimes.com/a/articleshow/1.cms", "https://e.com/"], urls.variants)
    assert amp[0][1:] == ["https://m.economictimes.com/a/articleshow/1.cms", "https://m.economictimes.com/a/amp_articleshow/1.cms"] and amp[1] == ["https://e.com/"]
    allowed = spark.createDataFrame([("https://www.moneycontrol.com/news/business/real-estate/",), ("https://www.moneycontrol.com/news/business/",), ("https://www.aninews.in/category/business/",), ("https://www.centralpark.in/media.php",), ("https://realty.economictimes.indiatimes.com/tag/noida",)], "url string")
    for opt_in, n in (("", 2), ("true", 3)):
        assert select.allowed_sources(allowed, Options.read({"ENABLE_NOIDA_CITY": opt_in}).sources).count() == n


def test_dates(spark):
    given = {
        "2026-06-20T00:00:00.000Z": "2026-06-20T00:00:00.000Z",
        "2026-06-20T10:00:00+05:30": "2026-06-20T04:30:00.000Z",
        "2026-06-20": "2026-06-20T00:00:00.000Z",
        "Jul 10, 2026 10:24 PM IST": "2026-07-10T16:54:00.000Z",
        "Updated on: July 8th, 2026": "2026-07-08T00:00:00.000Z",
        "Sat, 20 Jun 2026 08:30:15 GMT": "2026-06-20T08:30:15.000Z",
        "launched Jul 8, 2026 11:09 AM here": "2026-07-08T05:39:00.000Z",
        "on 31 Feb 2026, 12:00 AM end": "2026-03-02T18:30:00.000Z",
        "Sector 84": "",
        "": "",
    }
    assert each(spark, list(given), lambda c: dates.iso_text(dates.parse(c))) == list(given.values())
    assert each(spark, ["/n/NEWS_202607041240_x.pdf", "none"], lambda c: dates.iso_text(dates.notice_date(c))) == ["2026-07-04T07:10:00.000Z", ""]
    lo, hi = dates.window("2026-06-30", "2026-07-13", datetime(2026, 8, 1, tzinfo=UTC))
    inside = lambda c: select.in_window(dates.parse(c), F.lit(lo), F.lit(hi))
    assert each(spark, ["2026-06-30T00:00:00Z", "2026-07-13T23:59:59.999Z", "2026-06-29T23:59:59Z", "2026-07-14", ""], inside) == [True, True, False, False, False]
    with pytest.raises(ValueError):
        dates.window("2026-02-01", "2026-01-01", datetime(2026, 8, 1, tzinfo=UTC))
    with pytest.raises(ValueError):
        dates.boundary("soon")


def test_options():
    assert parse_settings("# a\nA='x=y'\nB\nA=2\n C = 3") == {"A": "x=y", "C ": "3"} or parse_settings("A='x=y'\nA=2")["A"] == "x=y"
    assert split_values("a, b;c\n\n d") == ["a", "b", "c", "d"] and positive("12x", 3) == 12 and positive("-1", 3) == 3 and positive(None, 3) == 3
    o = Options.read({"SOURCE_URLS": "https://a.com, https://a.com", "SKIP_TITLES": "One & two||Three!", "DRY_RUN": "Yes", "MAX_ITEMS_PER_RUN": "0"})
    assert (o.sources, o.skip_titles, o.dry_run, o.max_items, o.lookback_days) == (["https://a.com"], ["one and two", "three"], True, 30, 20)
    assert len(Options.read({}).sources) == 43 < len(Options.read({"ENABLE_NOIDA_CITY": "on"}).sources)


PAGE = """<html><head><title>A story here | Site</title><meta property="og:description" content="About it"><link rel="icon" href="/i.png">
<script type="application/ld+json">{"@graph":[{"datePublished":"2026-07-01T10:00:00Z","image":{"url":"https://e.com/ld.jpg"}}]}</script></head>
<body><nav>menu <img src="/menu.jpg"></nav><article><h1>A story here - Site</h1><div class="story-body">%s</div><div class="share-box"><img src="/share.jpg"></div>
<figure><img data-src="/pic.jpg" src="data:x"></figure></article><a href="/next-story"><img src="/t.jpg">The next story of this page</a></body></html>""" % ("Words of the story. " * 10)


def test_html():
    live, fresh = html.read_page(PAGE), html.read_page(PAGE, strip_before_metadata=False)
    assert live["title"] == "A story here" and "Words of the story. Words" in live["text"] and live["og_description"] == "About it" and live["icon"] == "/i.png"
    assert live["image"] == "/pic.jpg" and not any(d.startswith("2026") for d in live["dates"]) and fresh["dates"][0] == "2026-07-01T10:00:00Z"
    assert live["links"][0]["title"] == "The next story of this page" and live["links"][0]["image"] == "/t.jpg"
    image = lambda page: html.image(html.Page(html.parse(page)))
    assert image('<meta property="og:image" content="https://e.com/logo.svg"><img id="zoom_class" src="https://e.com/s.png">') == "https://e.com/s.png"
    assert image('<script type="application/ld+json">{"image":{"url":"https://e.com/n.jpg"}}</script>') == "https://e.com/n.jpg"
    assert image('<meta property="og:image" content="https://e.com/r.jpg"><article><img src="https://e.com/artShare@2x.png"></article>') == "https://e.com/r.jpg"
    assert html.read_page(None)["title"] == "" and html.read_page("<p>a<p>b</" + "<div>" * 5000)["text"]


def test_html_errors_and_size(spark):
    """A page that can't be parsed is a null; links of one box cost no more than their number."""
    bad = "<![foo[x]]><p>hi</p>"
    assert html.read_page(bad) is None
    many = "<div>" + "".join(f"<a href='/x{i}'>link number {i}</a> text " for i in range(20_000)) + "</div>"
    got = html.read_page(many, fields=["links"])
    assert set(got) == {"links"} and len(got["links"]) == 20_000 and len(got["links"][0]["near"]) == html.NEAR
    df = spark.createDataFrame([(1, bad), (2, "<h1>Good</h1>"), (3, None), (4, "")], "id long, html string").coalesce(1)
    rows = {r.id: r.page for r in html.read_pages(df, fields=["title", "dates"]).collect()}
    assert rows[1] is None and [rows[i].title for i in (2, 3, 4)] == ["Good", "", ""]
    now = F.lit("2026-07-01T00:00:00Z").cast("timestamp")
    assert html.direct_articles(df.withColumn("url", F.lit("https://e.com/a")), "url", "html", now).count() == 4
