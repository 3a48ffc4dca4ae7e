"""Row selection: filters, semi and anti joins, dedupe by one or several keys, order and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.functions import dates
from quillsieve.functions.text import normalize_title
from quillsieve.functions.urls import bare_host, bare_path, is_http
from quillsieve.functions.wordlists import BLOCKED_SOURCES
from quillsieve.sources.scratch import Scratch

EPOCH = "1970-01-01 00:00:00Z"


def blocked_source(url: Column) -> Column:
    return F.exists(F.array(*[F.lit(x) for x in BLOCKED_SOURCES]), lambda x: F.contains(F.lower(url), x))


def source_key(url: Column) -> Column:
    return F.lower(F.concat(bare_host(url), bare_path(url)))


def allowed_sources(df: DataFrame, allowed: list[str], url: str = "url") -> DataFrame:
    """Rows whose URL has host and path of an allowed source and no blocked part."""
    keys = df.sparkSession.createDataFrame([(u,) for u in allowed], "u string").select(source_key(F.col("u")).alias("__key")).distinct()
    return df.where(~blocked_source(F.col(url))).withColumn("__key", source_key(F.col(url))).join(keys, "__key", "left_semi").drop("__key")


def allowed_extra(url: Column) -> Column:
    return ~blocked_source(url) & is_http(url)


def in_window(when: Column, lo: Column | None, hi: Column | None) -> Column:
    """Inclusive at both ends; without a date only if there is no bound."""
    if lo is None and hi is None:
        return F.lit(True)
    after = F.lit(True) if lo is None else when >= lo
    before = F.lit(True) if hi is None else when <= hi
    return F.coalesce(after & before, F.lit(False))


def city_filter(codes: list[str], known: list[str]) -> Column:
    """Rows of the given cities; unknown ones are dropped, and none left means no filter."""
    kept = [c.lower() for c in codes if c.lower() in known]
    return F.col("cityCode").isin(kept) if kept else F.lit(True)


def without_titles(df: DataFrame, titles: DataFrame, title: str = "title", skip: str = "title") -> DataFrame:
    """Rows whose normalised title isn't one of those to skip."""
    bad = titles.select(normalize_title(F.col(skip)).alias("__t")).where("__t <> ''").distinct()
    return df.withColumn("__t", normalize_title(F.col(title))).join(bad, "__t", "left_anti").drop("__t")


def seen_rows(df: DataFrame, sent: DataFrame, row: str, ids: str) -> DataFrame:
    """The distinct ``row`` keys of df with any of ``ids`` in sent.id: k-way any-match as one join."""
    return df.select(row, F.explode(ids).alias("id")).join(sent.select("id").distinct(), "id", "left_semi").select(row).distinct()


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; the extra columns of ``order`` make ties impossible."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def last_wins(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """An upsert: each key's last values, at the place where the key came first."""
    rest = [c for c in df.columns if c not in (*keys, seq)]
    got = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("v"), F.min(seq).alias(seq))
    return got.select(*keys, *[F.col(f"v.{c}").alias(c) for c in rest], seq)


def per_group_limit(df: DataFrame, keys: list[str], order: list[Column | str], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def select_order(published: str = "publishedAt") -> list[Column]:
    """Articles of one city first, then the newest; undated ones count as of 1970."""
    when = F.coalesce(dates.parse(F.col(published)), F.to_timestamp(F.lit(EPOCH)))
    return [F.col("sharedCityArticle").cast("int").asc(), when.desc(), F.col("seq").asc(), F.col("cityCode").asc()]


def push_order(published: str = "publishedAt") -> list[Column]:
    """Articles of several cities first, then the oldest."""
    when = F.coalesce(dates.parse(F.col(published)), F.to_timestamp(F.lit(EPOCH)))
    return [F.col("sharedCityArticle").cast("int").desc(), when.asc(), F.col("seq").asc(), F.col("cityCode").asc()]


def greedy_unique(df: DataFrame, rank: str, ids: str) -> DataFrame:
    """Rows in order of ``rank`` of which no id is an id of a row kept before.

    Not the components of shared ids: a dropped row's ids stay free. Each round keeps the rows
    that are the first on all of their ids and drops those that share an id with a kept one; what
    is left goes on. A row without ids is dropped. Rounds are written to the shared folder; the
    first row left is kept in each, so the loop ends.
    """
    cut = Scratch(df.sparkSession, "greedy").cut
    left = cut(df.select(F.col(rank).alias("r"), F.explode(ids).alias("i")).distinct(), "links")
    kept, n = None, 0
    while not left.isEmpty():
        n += 1
        low = left.groupBy("i").agg(F.min("r").alias("low"))
        first = left.join(low, "i").groupBy("r").agg(F.bool_and(F.col("r") == F.col("low")).alias("first"))
        now = cut(first.where("first").select("r"), f"kept-{n}")
        kept = now if kept is None else kept.union(now)
        gone = left.join(left.join(now, "r", "left_semi").select("i").distinct(), "i", "left_semi").select("r").distinct()
        left = cut(left.join(gone, "r", "left_anti"), f"left-{n}")
    if kept is None:
        return df.limit(0)
    return df.join(kept.select(F.col("r").alias("__kept")), F.col(rank) == F.col("__kept"), "left_semi")


def greedy_top(df: DataFrame, rank: str, ids: str, limit: int) -> DataFrame:
    """The first ``limit`` rows that ``greedy_unique`` keeps, in order of rank.

    Whether a row stays depends on earlier rows only, so the first rows by rank are enough if that
    many of them stay; else more of them are taken, and in the end all.
    """
    size = 8 * limit
    while True:
        first = Scratch(df.sparkSession, "greedy-top").cut(df.orderBy(rank).limit(size))
        kept = greedy_unique(first, rank, ids)
        if first.count() < size or kept.count() >= limit:
            return kept.orderBy(rank).limit(limit)
        size *= 8
