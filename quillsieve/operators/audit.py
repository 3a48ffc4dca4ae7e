"""Audit aggregates and reports over judged articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions import dates
from quillsieve.functions.text import normalize_title
from quillsieve.operators import rules, select

SKIPPED = "manual skip: title already reposted"


def reason_counts(df: DataFrame, reasons: str = "reasons") -> DataFrame:
    """Articles per reason, sorted by reason; an article counts once for each of its reasons."""
    return df.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).orderBy("reason")


def category_counts(df: DataFrame, category: str) -> DataFrame:
    return df.groupBy(category).agg(F.count("*").alias("n"))


def push_counts(df: DataFrame) -> DataFrame:
    shared = F.col("sharedCityArticle")
    return df.agg(F.count_if(shared).alias("n_shared"), F.count_if(~shared).alias("n_specific"))


def missed(df: DataFrame, pack: rules.Pack, limit: int = 20) -> DataFrame:
    """Rejected articles that look like targets, the first of each title; "already sent" is no reason."""
    why = F.filter("reasons", lambda x: x != rules.REASONS[13])
    able = df.where((F.col("title") != "") & ~F.col("skipped")).withColumn("reasons", why).where((F.size("reasons") > 0) & rules.near_miss(pack, F.col("reasons")))
    first = select.first_wins(able.withColumn("__t", normalize_title(F.col("title"))), ["__t"], ["seq", "cityCode"])
    return first.orderBy("seq", "cityCode").limit(limit).select("seq", "cityCode", "title", F.col("rules.label").alias("label"), F.array_join("reasons", "; ").alias("reasons"), "newsLink")


def date_excluded(df: DataFrame, inside: Column, limit: int = 25) -> DataFrame:
    """Publishable articles outside the date window, newest first, without duplicates."""
    out = df.where(~inside & ~F.col("skipped") & (F.size("reasons") == 0))
    when = F.coalesce(dates.article_date(F.col("publishedAt"), F.col("createdAt")), F.to_timestamp(F.lit(select.EPOCH)))
    ranked = out.withColumn("__when", when).withColumn("__rank", F.struct(-F.unix_micros("__when"), F.col("seq"), F.col("cityCode")))
    kept = select.greedy_top(ranked, "__rank", "ids", limit)
    return kept.orderBy("__rank").select("seq", "cityCode", F.date_format("__when", "yyyy-MM-dd").alias("day"), "title", "newsLink")


def rejections(df: DataFrame, limit: int = 100) -> DataFrame:
    """The reasons of the first rejected rows."""
    return df.orderBy("seq", "cityCode").limit(limit).where((F.size("reasons") > 0) & (F.col("title") != "")).select("seq", "cityCode", "title", F.array_join("reasons", "; ").alias("reasons"))


def lines(run) -> list[str]:
    """What a run reports, line by line: bounded by its limits and the number of reasons."""
    chosen = run.chosen.select("cityCode", "title", "newsLink").collect()
    out = [f"Found {len(chosen)} new articles."]
    out += [f"Skipped {r['n']} articles by {r['reason']}." for r in run.reason_counts.collect()]
    out += [f"Missed? ({r['label']}): {r['title']}: {r['reasons']}" for r in run.missed.collect()]
    out += [f"Outside the dates ({r['day']}): {r['title']} | {r['newsLink']}" for r in run.date_excluded.collect()]
    out += [f"Skipped {r['title']}: {r['reasons']}" for r in run.rejections.collect()]
    n = run.push_counts.first()
    out.append(f"Push order: {n['n_shared']} shared-city articles first, then {n['n_specific']} city-specific articles.")
    verb = "Dry run candidate" if run.options.dry_run else "Pushed"
    return out + [f"{verb} ({r['cityCode']}): {r['title']} | {r['newsLink']}" for r in chosen]
