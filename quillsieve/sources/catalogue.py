"""The catalogue of verified sources: candidates from seeds and paths, verification, output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.functions.text import collapse
from quillsieve.functions.urls import host, is_dynamic, is_root_source, normalized, page_kind, part, path
from quillsieve.functions.wordlists import BLOCKED_PATHS
from quillsieve.operators.select import first_wins, last_wins


def candidates(seeds: DataFrame, paths: DataFrame, exact: DataFrame) -> DataFrame:
    """company, category, region, sourceName, url, urlType, seq: seeds with the paths of their
    kind, then exact URLs; the last entry of a URL counts, at the place of the first.

    seeds: seq, company, category, region, base. paths: seq, developer (boolean), urlType, path.
    exact: seq, company, category, region, url, urlType.
    """
    root = F.concat(F.lower(part(F.col("base"), 1)), F.lit("://"), host(F.col("base")), part(F.col("base"), 3))
    made = seeds.withColumn("developer", F.col("category") == "Developer").alias("s").join(paths.alias("p"), "developer")
    # A path of at most a million entries a seed keeps seeds apart.
    one = made.select("company", "category", "region", normalized(F.concat(root, F.col("path"))).alias("url"), "urlType", (F.col("s.seq") * 1_000_000 + F.col("p.seq")).alias("seq"))
    two = exact.select("company", "category", "region", normalized(F.col("url")).alias("url"), "urlType", (F.lit(1 << 50) + F.col("seq")).alias("seq"))
    return last_wins(one.unionByName(two).withColumn("sourceName", F.col("company")), ["url"], "seq")


def verify(rows: DataFrame) -> DataFrame:
    """Verified sources of fetched candidates, with what is known about each.

    rows: a candidate, status, finalUrl, contentType, snippet. Of candidates with one final URL
    the smallest seq counts, so the result doesn't depend on which answer came first.
    """
    final = normalized(F.col("finalUrl"))
    kind, snippet = F.coalesce("contentType", F.lit("")), F.coalesce("snippet", F.lit(""))
    origin = lambda c: F.concat(F.lower(part(c, 1)), host(c), part(c, 3))
    title = collapse(F.regexp_extract(snippet, r"(?is)<title[^>]*>(.*?)</title>", 1))
    lower = F.lower(F.concat(path(final), F.lit(" "), title))
    blocked = F.lit(False)
    for x in BLOCKED_PATHS:
        blocked = blocked | F.contains(lower, F.lit(x.replace("/", "")))
    xml = kind.rlike("(?i)xml|rss|atom") | path(final).rlike(r"(?i)[.](?:xml|rss|atom)$")
    able = rows.where(
        (F.col("status") == 200)
        & (origin(final) == origin(F.col("url")))
        & ((path(final) != "/") | is_root_source(F.col("category"), F.col("sourceName"), F.col("urlType")))
        & is_dynamic(final, F.lower(path(F.col("url"))))
        & ~kind.rlike("(?i)application/pdf|image/")
        & ~blocked
    )
    yes = lambda c, a, b: F.when(c, F.lit(a)).otherwise(F.lit(b))
    got = able.withColumns(
        {
            "rssAvailable": yes(path(final).rlike("(?i)rss|feed") | kind.rlike("(?i)rss"), "Yes", "Unknown"),
            "xmlAvailable": yes(xml, "Yes", "Unknown"),
            "language": yes(host(final).rlike("amarujala|jagran|livehindustan|navbharat|abplive|tv9hindi|zeenews|punjabkesari"), "Hindi", "English"),
            "official": yes(F.col("category").isin("Government", "Developer", "Research"), "Yes", "Publisher"),
            "requiresJs": yes(snippet.rlike(r'(?i)__NEXT_DATA__|window\.__NUXT__|id="root"|id="__next"'), "Maybe", "No"),
            "pagination": yes(snippet.rlike("(?i)page/2|page-2|load more|pagination|next page"), "Likely", "Unknown"),
            "notes": yes(xml, "Verified XML/RSS/sitemap source", "Verified dynamic source page"),
            "urlType": page_kind(final, F.col("urlType")),
            "url": final,
        }
    ).withColumn("updateFrequency", yes(F.col("urlType").isin("RSS Feed", "XML Feed", "Latest News", "News Category", "City News"), "Daily/As Published", "As Published"))
    return first_wins(got, ["url"], ["seq"])


def table(verified: DataFrame) -> DataFrame:
    """The catalogue's 17 columns, sorted by category, company and URL and numbered from 1."""
    # A catalogue is a few thousand rows (seeds times paths), so one ordered window numbers it.
    w = Window.orderBy(*[F.collate(F.col(c), "UNICODE") for c in ("category", "company", "url")])
    r = verified.withColumn("ID", F.row_number().over(w))
    pick: list[tuple[str, Column | str]] = [
        ("ID", "ID"), ("Company", "company"), ("Category", "category"), ("Sub Category", "urlType"), ("Region", "region"), ("Source Name", "sourceName"), ("URL", "url"), ("URL Type", "urlType"),
        ("RSS Available", "rssAvailable"), ("XML Available", "xmlAvailable"), ("Update Frequency", "updateFrequency"), ("Language", "language"), ("Official", "official"), ("Requires JS", "requiresJs"),
        ("Pagination", "pagination"), ("Status Code", "status"), ("Notes", "notes"),
    ]
    return r.select(*[F.col(c).alias(name) for name, c in pick])


def write(catalogue: DataFrame, path_: str) -> None:
    """The catalogue as CSV (quoted where needed) and as JSON."""
    catalogue.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path_}/csv")
    catalogue.write.mode("overwrite").json(f"{path_}/json")


def totals(made: DataFrame, verified: DataFrame) -> DataFrame:
    """Number of candidates and of verified sources."""
    return made.agg(F.count("*").alias("candidates")).join(F.broadcast(verified.agg(F.count("*").alias("verified"))))
