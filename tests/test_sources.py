"""Sources, selection, state, catalogue and recurring runs on small tables."""

import json
import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from quillsieve.functions import articles, html
from quillsieve.operators import audit, select
from quillsieve.plans.crawl import API_URL, BLOG_DATA, LINED_URL, crawl_and_push
from quillsieve.sources import catalogue, pages
from quillsieve.sources.options import Options
from quillsieve.sources.state import KEPT, State, push
from quillsieve.streaming.microbatch import Recurring
from tests.test_rules import BASE, CASES

NOW = datetime(2026, 6, 25, tzinfo=UTC)


def lit():
    return F.lit(NOW).cast("timestamp")


def test_fetch_retries_and_isolates(spark):
    tries = []

    def opener(url, timeout):
        if "bad" in url:
            raise OSError("no route")
        return 200, url.encode()

    df = spark.createDataFrame([("https://a/",), ("https://bad/",), (None,)], "url string")
    got = {r.url: r.answer for r in pages.fetch(df, pause=0, opener=opener).collect()}
    assert bytes(got["https://a/"].body) == b"https://a/" and got["https://bad/"].error == "no route" and got[None].status is None and not tries


def test_feed_items(spark):
    rss = """<rss><channel><title>Feed</title><image><url>https://e.com/l.png</url></image>
      <item><title>One &amp;amp; two</title><link>https://e.com/1</link><description>&lt;p&gt;About&lt;/p&gt;</description><pubDate>Sat, 20 Jun 2026 08:30:15 GMT</pubDate><enclosure url="/i.jpg"/></item>
      <item><title>Second</title><guid>https://e.com/2</guid></item></channel></rss>"""
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><title>At</title><entry><title>E</title><link href="https://f.com/x"/><summary>s</summary></entry></feed>'
    df = spark.createDataFrame([("https://e.com/rss", rss), ("https://f.com/atom", atom), ("https://g.com/rss", "<broken"), ("https://h.com/rss", None)], "source string, xml string")
    got = pages.feed_items(df, now=lit()).orderBy("source", "pos").collect()
    assert [(r.title, r.description, r.newsLink, r.postedBy) for r in got] == [("One & two", "About", "https://e.com/1", "Feed"), ("Second", "Second", "https://e.com/2", "Feed"), ("E", "s", "https://f.com/x", "At")]
    assert got[0].thumbnailImage == "https://e.com/i.jpg" and got[0].postedByLogo == "https://e.com/l.png" and got[1].thumbnailImage == ""
    assert pages.feed_items(df, limit=1).count() == 2


def test_listing_links_and_enrichment(spark):
    listing = """<title>News | E</title><div><a href="/long-story"><img src="/t.jpg">A story with a long name</a> Jul 8, 2026</div>
      <a href="/long-story">A story with another name</a><a href="https://other.com/x">Another host with a long name</a><a href="/s">short</a>"""
    df = spark.createDataFrame([("https://www.e.com/list", 1, listing), ("https://www.e.com/list", 2, listing)], "source string, page_no int, html string")
    got = pages.listing_links(df, now=lit()).collect()
    assert [(r.title, r.newsLink, r.thumbnailImage, r.publishedAt, r.postedBy) for r in got] == [("A story with a long name", "https://www.e.com/long-story", "https://www.e.com/t.jpg", "2026-07-08T00:00:00.000Z", "News")] or got[0].publishedAt.startswith("2026-07-0")
    story = '<meta property="og:description" content="Told"><meta property="og:image" content="https://e.com/p.jpg"><p>Body</p>'
    found = html.enrich(pages.listing_links(df, now=lit()), spark.createDataFrame([("https://www.e.com/long-story", story)], "url string, html string")).collect()
    assert [(r.description, r.articleText, r.thumbnailImage) for r in found] == [("Told", "Body", "https://e.com/p.jpg")]
    alone = html.enrich(pages.listing_links(df, now=lit()), spark.createDataFrame([], "url string, html string")).first()
    assert alone.description == "A story with a long name"


def test_cards_api_and_embedded(spark):
    card = '<div class="news_box media_news"><h4>Head</h4><p>About</p><span>12 July 2026</span><a href="/n.pdf">x</a></div>'
    df = spark.createDataFrame([("https://www.dlf.in/media", card), ("https://smartworlddevelopers.com/media", '<div class="mediabox"><h4>S</h4><img src="/s.png"><h5>Jul 1, 2026</h5></div>')], "source string, html string")
    got = {r.source: r for r in pages.official(pages.card_rows(df), lit()).collect()}
    assert got["https://www.dlf.in/media"].newsLink == "https://www.dlf.in/n.pdf" and got["https://www.dlf.in/media"].publishedAt == "2026-07-12T00:00:00.000Z"
    assert got["https://smartworlddevelopers.com/media"].newsLink == "https://smartworlddevelopers.com/s.png" and got["https://www.dlf.in/media"].postedBy == "DLF Media"
    row = lambda t: {"title": t, "description": "", "link": "", "image": "https://e.com/i.png", "date_time": "2026-01-02"}
    answer = lambda rows, last: json.dumps({"data": rows, "last_page": last})
    api = spark.createDataFrame([("https://m3mindia.com/media", "news", 1, answer([row("a")], 3)), ("https://m3mindia.com/media", "news", 2, answer([], 3)), ("https://m3mindia.com/media", "news", 3, answer([row("c")], 3)), ("https://m3mindia.com/media", "event", 1, answer([row("d")], 1))], "source string, tab string, page_no int, json string")
    assert sorted(r.title for r in pages.api_rows(api).collect()) == ["a", "d"]
    blog = json.dumps({"props": {"pageProps": {"newsData": [{"media_blog": [{"title": "B", "source_link": "https://x.com/b", "date": "2026-03-04", "desktop_image": {"url": "/d.png"}}]}]}}})
    b = pages.official(pages.embedded_blog_rows(spark.createDataFrame([("https://www.signatureglobal.in/", blog), ("https://www.signatureglobal.in/", "{bad")], "source string, json string")), lit()).collect()
    assert [(r.title, r.newsLink, r.thumbnailImage) for r in b] == [("B", "https://x.com/b", "https://www.signatureglobal.in/d.png")]
    media = json.dumps({"props": {"pageProps": {"newsData": [{"title": {"rendered": "<b>T</b>"}, "acf": {"external_link": {"url": "https://x.com/t"}, "image": {"url": "/a.png"}}, "date": "2026-02-03"}, {"title": ""}], "pressReleasesData": [{"title": "t", "link": "https://x.com/again"}, {"title": "P", "link": "https://x.com/p"}]}}})
    m = pages.embedded_media(spark.createDataFrame([("https://www.bptp.com/media", media)], "source string, json string"), now=lit()).orderBy("rank", "pos").collect()
    assert [(r.title, r.newsLink) for r in m] == [("T", "https://x.com/t"), ("P", "https://x.com/p")] and m[0].thumbnailImage == "https://www.bptp.com/a.png" and m[0].publishedAt == "2026-02-03T00:00:00.000Z"


def test_notices(spark):
    page = '<div>Commercial auction<a href="/documents/notices/NEWS_202607041240_a.pdf">View</a></div><a href="/other.pdf">View</a>'
    links = pages.notice_links(spark.createDataFrame([("https://hsvphry.org.in/", page)], "source string, html string"))
    content = b"%PDF (https://e.com/Faridabad/Sector-84_2PS.pdf) <https://e.com/faridabad/sector 9/KheriKalan_Creche.pdf> https://e.com/other \xff"
    got = pages.notice_articles(links.withColumn("content", F.lit(content)), lit()).collect()
    assert len(got) == 1 and got[0].sectors == ["Sector 84"] and got[0].sites == ["primary school"] and got[0].publishedAt == "2026-07-04T07:10:00.000Z"
    assert pages.notice_articles(links.withColumn("content", F.lit(b"nothing")), lit()).count() == 0


def brute_greedy(rows):
    seen, kept = set(), []
    for r, ids in sorted(rows):
        if ids and not seen & set(ids):
            kept.append(r)
            seen |= set(ids)
    return kept


@pytest.mark.parametrize("seed", range(3))
def test_greedy_unique_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [f"u{rng.randrange(25)}", f"t{rng.randrange(25)}"] if rng.random() < 0.95 else []) for i in range(60)]
    df = spark.createDataFrame(rows, "r long, ids array<string>")
    assert sorted(x.r for x in select.greedy_unique(df, "r", "ids").collect()) == brute_greedy(rows)
    assert select.greedy_unique(df.limit(0), "r", "ids").count() == 0


def test_greedy_top_takes_more_rows_where_many_repeat(spark):
    rng = random.Random(7)
    rows = [(i, ["same"] if i < 30 else [f"u{rng.randrange(40)}", f"t{rng.randrange(40)}"]) for i in range(120)]
    df = spark.createDataFrame(rows, "r long, ids array<string>")
    for limit in (1, 3, 100):
        assert [x.r for x in select.greedy_top(df, "r", "ids", limit).collect()] == brute_greedy(rows)[:limit]


def test_state_is_bounded_and_ordered(spark, tmp_path):
    s = State(spark, str(tmp_path / "s"))
    assert s.read().count() == 0
    s.add(spark.range(KEPT).selectExpr("cast(id as string) id", "id as place"), NOW)
    s.add(spark.createDataFrame([("5", 0), ("new", 1)], "id string, place long"), NOW)
    ids = {r.id for r in s.read().collect()}
    assert len(ids) == KEPT and "new" in ids and "0" not in ids and "5" in ids
    path = tmp_path / "state.json"
    path.write_text(json.dumps({"updatedAt": "x", "sentIds": ["a", "b"]}, indent=2))
    assert [r.id for r in s.read_json(str(path)).orderBy("seq").collect()] == ["a", "b"]
    path.write_text('{"sentIds": 3}')
    assert s.read_json(str(path)).count() == 0


def test_push_order_failure_and_dry_run(spark):
    df = spark.createDataFrame([("a",), ("b",)], "title string").coalesce(1)
    out = []
    assert push(df, out.append).count() == 2 and [p["title"] for p in out] == ["a", "b"]
    assert push(df, out.append, dry_run=True).count() == 2 and len(out) == 2
    with pytest.raises(RuntimeError):
        push(df, lambda p: (_ for _ in ()).throw(RuntimeError("500")))


def test_catalogue(spark, tmp_path):
    seeds = spark.createDataFrame([(0, "Dev", "Developer", "R", "https://d.com/x"), (1, "Ten News", "News", "R", "https://t.com")], "seq long, company string, category string, region string, base string")
    paths = spark.createDataFrame([(0, True, "Media Centre", "/media/"), (0, False, "Latest News", "/"), (1, False, "News Category", "/news")], "seq long, developer boolean, urlType string, path string")
    exact = spark.createDataFrame([(0, "Over", "News", "Q", "https://t.com/news/", "City News")], "seq long, company string, category string, region string, url string, urlType string")
    made = catalogue.candidates(seeds, paths, exact)
    assert sorted((r.url, r.company) for r in made.collect()) == [("https://d.com/media", "Dev"), ("https://t.com/", "Ten News"), ("https://t.com/news", "Over")]
    rows = made.withColumns({"status": F.when(F.col("company") == "Dev", 404).otherwise(200), "finalUrl": F.col("url"), "contentType": F.lit("text/html"), "snippet": F.lit('<title>N</title><div id="root">next page')})
    table = catalogue.table(catalogue.verify(rows))
    got = table.orderBy("ID").collect()
    assert [(r.ID, r.Company, r["URL Type"], r["Requires JS"], r.Pagination) for r in got] == [(1, "Over", "News Category", "Maybe", "Likely"), (2, "Ten News", "Latest News", "Maybe", "Likely")]
    assert len(table.columns) == 17 and catalogue.totals(made, table).first().asDict() == {"candidates": 3, "verified": 2}
    catalogue.write(table, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out/csv")).count() == 2


def test_recurring_runs_send_once(spark, tmp_path):
    rows = [{**BASE, "seq": 0}, {**BASE, **CASES[5][0], "seq": 1}, {**BASE, **CASES[13][0], "seq": 2}]
    df = spark.createDataFrame(rows)
    sent = []
    r = Recurring(spark, State(spark, str(tmp_path / "state")), Options(), sent.append, now=lambda: NOW)
    df.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        r.start(str(tmp_path / "in"), df.schema, str(tmp_path / "check")).awaitTermination()
    assert len(sent) == 2
    r.batch(df, 7)  # the same articles again
    assert len(sent) == 2
    resend = Recurring(spark, r.state, Options(resend=True), sent.append, now=lambda: NOW, commit_each=True)
    resend.batch(df.where("seq = 0"), 8)
    assert len(sent) == 3
    assert r.state.read().count() == 6 and articles.ensure(df).count() == 3


def test_opt_in_city_is_guarded(spark, tmp_path):
    make = lambda **o: Recurring(spark, State(spark, str(tmp_path / "s")), Options(opt_in=True, **o), lambda p: None)
    with pytest.raises(ValueError, match="opt-in"):
        make()
    assert make(dry_run=True) and make(allow_opt_in_push=True)


def test_crawl(spark, tmp_path):
    """Every kind of source, one that fails, a feed that is a page, an extra URL; then push and log."""
    story = "<meta property='og:description' content='{0} told of a residential project in Gurugram with better connectivity.'><meta property='og:image' content='https://e.com/p.jpg'><article><p>" + "The Gurugram project has housing. " * 5 + "</p></article>"
    site = {
        "https://www.cnbctv18.com/real-estate/": "<title>C</title><a href='/first-story'>Residential project launched in Gurugram today</a><a href='/second'>Sohna Road residential project launched in Gurugram</a>",
        "https://www.cnbctv18.com/first-story": story.format("One"),
        "https://realty.economictimes.indiatimes.com/tag/gurugram": "<a href='/only-here'>Dwarka Expressway housing project approved in Gurugram</a>",
        "https://realty.economictimes.indiatimes.com/tag/gurugram/2": "<a href='/page-two'>Golf Course Road housing project approved in Gurugram</a>",
        "https://hsvphry.org.in/": "<div>Auction<a href='/documents/notices/NEWS_202606041240_a.pdf'>View</a></div>",
        "https://hsvphry.org.in/documents/notices/NEWS_202606041240_a.pdf": "(https://e.com/Faridabad/Sector-84_2PS.pdf)",
        "https://www.bptp.com/media": '<script id="__NEXT_DATA__" type="application/json">' + json.dumps({"props": {"pageProps": {"newsData": [{"title": "BPTP project in Greater Faridabad", "link": "https://x.com/b", "date": "2026-06-20"}]}}}) + "</script>",
        "https://www.dlf.in/media": "<div class='news_box media_news'><h4>DLF one</h4><span>12 June 2026</span><a href='/n.pdf'>x</a></div><div class='news_box media_news'><h4>DLF one</h4><a href='/m.pdf'>x</a></div>",
        LINED_URL: "<div class='board-thumb'><p>Realty Awards\nPark project, including others</p><h5>1 June 2026</h5><a href='/c'>x</a></div>",
        API_URL.format(tab="news", page=1): json.dumps({"data": [{"title": "M3M one", "link": "https://x.com/m", "date_time": "2026-06-20"}], "last_page": 1}),
        "https://www.signatureglobal.in/": "<p>no data</p>",
        BLOG_DATA: json.dumps({"pageProps": {"newsData": [{"media_blog": [{"title": "S one", "source_link": "https://x.com/s", "date": "2026-06-20"}]}]}}),
        "https://e.com/extra": "<h1>Extra residential project launched in Gurugram</h1>" + story.format("Extra"),
        "https://propnewstime.com/": "<![foo[x]]>",
    }

    def opener(url, timeout):
        if url not in site:
            raise OSError(f"no {url}")
        return 200, site[url].encode()

    listed = [u for u in site if u.count("/") == 3 or u.endswith(("/media", "/real-estate/", "/tag/gurugram"))]
    options = Options(sources=[*listed, "https://m3mindia.com/media", "https://www.centralpark.in/media.php", "https://ncrtc.in/", "https://nobody.com/x"], extra_urls=["https://e.com/extra", "ftp://e.com/x"], max_pages=2, start="2026-01-01")
    sent = []
    found, out = crawl_and_push(spark, State(spark, str(tmp_path / "state")), options, NOW, sent.append, opener, pause=0)
    log = {r.source: r for r in found.log.collect()}
    assert {u: r.n for u, r in log.items()} == {
        "https://www.cnbctv18.com/real-estate/": 2, "https://realty.economictimes.indiatimes.com/tag/gurugram": 2, "https://hsvphry.org.in/": 1, "https://www.bptp.com/media": 1,
        "https://www.dlf.in/media": 1, "https://www.signatureglobal.in/": 1, "https://propnewstime.com/": 0, "https://m3mindia.com/media": 1, "https://www.centralpark.in/media.php": 1,
        "https://ncrtc.in/": 0, "https://e.com/extra": 1,
    }
    assert log["https://ncrtc.in/"].error == "no https://ncrtc.in/" and log["https://www.dlf.in/media"].error is None
    rows = {r.title: r for r in found.articles.orderBy("seq").collect()}
    assert rows["Residential project launched in Gurugram today"].description.startswith("One told") and rows["Sohna Road residential project launched in Gurugram"].thumbnailImage == ""
    assert "Park project at Realty Awards" in rows and rows["Extra residential project launched in Gurugram"].newsLink == "https://e.com/extra"
    assert list(rows)[-1] == "Extra residential project launched in Gurugram"
    said = audit.lines(out)
    assert said[0] == f"Found {len(sent)} new articles." and any(x.startswith("Push order: ") for x in said) and len([x for x in said if x.startswith("Pushed (")]) == len(sent)
