"""From options to articles: every source by its kind of scan, extra URLs, enrichment; then a run.

A source that fails, at whatever point, is a line of the log and ends no other. Each fetched table
is written once, so no URL is asked for twice. Sources and items are bounded by the options.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillsieve.functions.html import direct_articles, enrich, read_pages
from quillsieve.functions.urls import bare_host, page_urls, variants
from quillsieve.functions.wordlists import OPT_IN_SOURCES, SOURCES
from quillsieve.operators import select
from quillsieve.plans.run import Run
from quillsieve.sources import pages
from quillsieve.sources.options import Options
from quillsieve.sources.scratch import Scratch
from quillsieve.sources.state import State, post
from quillsieve.streaming.microbatch import Recurring

# FIXED VALUES: addresses of official media.
API_URL = "https://m3mindia.com/media-section-tab-data/{tab}?page={page}"
BLOG_DATA = "https://www.signatureglobal.in/_next/data/1MPKgSgQ9QFViTWLX484R/index.json"
LINED_URL, LINED_FORM = "https://www.centralpark.in/pressreleases.php", "pag=1&page=1"


@dataclass
class Scan:
    """articles: source, seq and an article's columns; log: source, kind, n, error."""

    articles: DataFrame
    log: DataFrame


def scan(spark: SparkSession, options: Options, now: datetime, opener=None, pause: float = 0.75) -> Scan:
    """Articles of all allowed sources and extra URLs, in order of the options."""
    scratch, when = Scratch(spark, "scan"), F.lit(now).cast("timestamp")
    listed = spark.createDataFrame(list(enumerate(dict.fromkeys(options.sources))), "rank long, source string")
    allowed = select.allowed_sources(listed, SOURCES + (OPT_IN_SOURCES if options.opt_in else []), "source")
    kinds = scratch.cut(pages.dispatch(allowed, "source"), "sources")

    def got(df: DataFrame, url: str, **how) -> DataFrame:
        """df with text (null where the request failed) and error."""
        out = pages.fetch(df, url, opener=opener, **({"pause": pause} | how))
        return scratch.cut(out.withColumns({"error": F.col("answer.error"), "body": F.col("answer.body"), "text": F.make_valid_utf8(F.col("answer.body").cast("string"))}).drop("answer"), "answers")

    of = lambda kind: kinds.where(F.col("kind") == kind).select("source")
    limit = options.max_per_source

    feeds = scratch.cut(pages.read_feeds(got(of("feed"), "source").select("source", "error", F.col("text").alias("xml"))), "feeds")
    readable = F.col("error").isNull() & F.col("feed.ok")
    items = pages.feed_items(feeds.where(readable), limit, when)

    # What is no readable feed is read as a page.
    sources = of("page").union(feeds.where(~readable).select("source"))
    listing = got(sources.select("source", F.posexplode(page_urls(F.col("source"), options.max_pages)).alias("page_no", "url")), "url")
    links = pages.listing_links(listing.where("text is not null").select("source", "page_no", F.col("text").alias("html")), limit, when)
    links = links.withColumn("pos", (F.col("page_no") * 100_000 + F.col("pos")).cast("int")).drop("page_no")

    candidates = scratch.cut(items.unionByName(links), "candidates")
    stories = got(candidates.select("newsLink").where("newsLink <> ''").distinct().withColumn("tried", variants(F.col("newsLink"))), "tried")
    enriched = enrich(candidates, stories.where("text is not null").select(F.col("newsLink").alias("url"), F.col("text").alias("html")))

    notice_pages = got(of("notices"), "source")
    notices = got(pages.notice_links(notice_pages.where("text is not null").select("source", F.col("text").alias("html")), limit), "notice")
    told = pages.notice_articles(notices.where("body is not null").withColumn("content", F.col("body")), when)
    told = told.join(notices.select(F.col("notice").alias("newsLink"), "source", "pos"), ["newsLink", "source"]).drop("sectors", "places", "sites")

    media_pages = got(of("embedded"), "source")
    data = lambda df: read_pages(df.where("text is not null"), "text", fields=["next_data"]).withColumn("json", F.col("page.next_data")).drop("page")
    media = pages.embedded_media(data(media_pages).select("source", "json"), limit, when)
    media = media.withColumn("pos", F.col("rank") * 100_000 + F.col("pos")).drop("rank")

    official = of("official").withColumn("host", bare_host(F.col("source")))
    cards = official.where(F.col("host").isin([h for h, *_ in pages.CARD_PAGES]))
    lined = F.col("host") == pages.LINED
    cards = got(cards.withColumns({"asked": F.when(lined, F.lit(LINED_URL)).otherwise(F.col("source")), "form": F.when(lined, F.lit(LINED_FORM))}), "asked", form="form")
    api = official.where("host = 'm3mindia.com'").select("source", F.explode(F.array(*[F.lit(t) for t in pages.TABS])).alias("tab"))
    api = api.withColumn("page_no", F.explode(F.sequence(F.lit(1), F.lit(options.max_pages))))
    asked = F.replace(F.replace(F.lit(API_URL), F.lit("{tab}"), F.col("tab")), F.lit("{page}"), F.col("page_no").cast("string"))
    api = got(api.withColumn("asked", asked), "asked")
    blogs = got(official.where("host = 'signatureglobal.in'"), "source", attempts=3, pause=pause * 2, growing=True, timeout=30.0)
    blogs = data(blogs)
    empty = blogs.where("coalesce(json, '') = ''").select("source", F.lit(BLOG_DATA).alias("asked"))
    blog_json = blogs.where("json <> ''").select("source", "json").union(got(empty, "asked", attempts=1, timeout=30.0).where("text is not null").select("source", "text"))
    rows = pages.card_rows(cards.where("text is not null").select("source", F.col("text").alias("html")))
    rows = rows.unionByName(pages.api_rows(api.select("source", "tab", "page_no", F.col("text").alias("json")))).unionByName(pages.embedded_blog_rows(blog_json))
    media_rows = pages.official_unique(scratch.cut(pages.official(rows, when), "official"), limit)

    extra = spark.createDataFrame([(10**6 + i, u) for i, u in enumerate(dict.fromkeys(options.extra_urls))], "rank long, source string")
    extra = extra.where(select.allowed_extra(F.col("source")))
    direct = got(extra.withColumn("tried", variants(F.col("source"))), "tried")
    alone = direct_articles(direct.where("text is not null").select("source", F.col("source").alias("url"), F.col("text").alias("html")), "url", "html", when)

    parts = [enriched, told, media, media_rows, alone.withColumn("pos", F.lit(0))]
    columns = ["source", "pos", *pages.CANDIDATE]
    every = parts[0].select(*columns)
    for part in parts[1:]:
        every = every.unionByName(part.select(*columns))
    ranks = kinds.select("rank", "source", "kind").union(extra.select("rank", "source", F.lit("extra")))
    # Sources times items of a source: a bounded number of rows, in one order.
    w = Window.orderBy("rank", "pos", "newsLink")
    out = scratch.cut(every.join(ranks, "source").withColumn("seq", F.row_number().over(w).cast("long")).drop("pos"), "articles")
    failed = None
    for df in (feeds, listing, notice_pages, media_pages, cards, api, blogs, direct):
        one = df.where("error is not null").select("source", "error")
        failed = one if failed is None else failed.union(one)
    counts = out.groupBy("source").agg(F.count("*").alias("n"))
    errors = failed.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("error")), "; ").alias("error"))
    log = ranks.join(counts, "source", "left").join(errors, "source", "left").select("rank", "source", "kind", F.coalesce("n", F.lit(0)).alias("n"), "error")
    return Scan(out.drop("rank", "kind"), scratch.cut(log, "log").orderBy("rank").drop("rank"))


def crawl_and_push(spark: SparkSession, state: State, options: Options, now: datetime, send=None, opener=None, pause: float = 0.75) -> tuple[Scan, Run | None]:
    """One whole run: scan, judge, choose, push, remember."""
    recurring = Recurring(spark, state, options, send or post(options.api_url, options.api_key), now=lambda: now)
    found = scan(spark, options, now, opener, pause)
    return found, recurring.batch(found.articles, 0)
