"""Projections of article rows: cleaning, text views, identifiers and payloads.

An article has title, description, articleText, isActive, newsLink, thumbnailImage, postedBy,
postedByLogo, createdAt, publishedAt, fetchedAt, cityCode, sharedCityArticle, id and seq (its place
of arrival). ``ensure`` adds what a DataFrame lacks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions import dates
from quillsieve.functions.text import clean_text, clean_title, normalize_title, text, trim
from quillsieve.functions.urls import is_http, sha, url_id
from quillsieve.functions.wordlists import REQUIRED_FIELDS, URL_FIELDS

STRINGS = ["title", "description", "articleText", "newsLink", "thumbnailImage", "postedBy", "postedByLogo", "createdAt", "publishedAt", "fetchedAt", "cityCode", "id", "url", "source"]
LIMITS = {"articleText": 5000, "newsLink": 1000, "thumbnailImage": 1000, "postedBy": 120, "postedByLogo": 1000}


def ensure(df: DataFrame) -> DataFrame:
    """df with every column of an article; a missing text is empty."""
    have = set(df.columns)
    add = {c: text(F.col(c)) if c in have else F.lit("") for c in STRINGS}
    add["isActive"] = F.coalesce(F.col("isActive"), F.lit(True)) if "isActive" in have else F.lit(True)
    add["sharedCityArticle"] = F.coalesce(F.col("sharedCityArticle"), F.lit(False)) if "sharedCityArticle" in have else F.lit(False)
    add["seq"] = F.col("seq").cast("long") if "seq" in have else F.lit(0).cast("long")
    return df.withColumns(add)


def clean(df: DataFrame) -> DataFrame:
    """df with its text fields cleaned and cut; a missing description is the title."""
    title = clean_title(F.col("title"))
    about = clean_text(F.col("description"), 700)
    fields = {c: clean_text(F.col(c), n) for c, n in LIMITS.items()}
    out = df.withColumns({"title": title, "description": about, **fields})
    return out.withColumn("description", F.when(F.col("description") != "", F.col("description")).otherwise(F.col("title")))


def views() -> dict[str, Column]:
    """The lower-case texts that rules look at. A separator stands even where a field is empty."""
    title, about, body, link = (F.lower(text(F.col(c))) for c in ("title", "description", "articleText", "newsLink"))
    join = lambda *c: F.concat(*[x for i, y in enumerate(c) for x in ((F.lit(" "), y) if i else (y,))])
    primary = join(title, about)
    return {"title": title, "primary": primary, "search": join(title, about, body, link), "body": body, "url": link, "pu": join(primary, link), "title_url": join(title, link)}


def stable_id(city: Column | None = None) -> Column:
    parts = [F.nullif(text(F.col(c)), F.lit("")) for c in ("newsLink", "url", "title", "postedBy", "source")]
    return sha(F.lower(F.concat_ws("|", *parts, F.nullif(F.col("cityCode") if city is None else city, F.lit("")))))


def title_id() -> Column:
    t = normalize_title(F.col("title"))
    return F.when(t == "", F.lit("")).otherwise(sha(t))


def title_city_id() -> Column:
    return sha(F.concat_ws("|", F.nullif(normalize_title(F.col("title")), F.lit("")), F.nullif(text(F.col("cityCode")), F.lit(""))))


def link_id() -> Column:
    return url_id(F.when(text(F.col("newsLink")) != "", F.col("newsLink")).otherwise(F.col("url")))


def dedupe_ids() -> Column:
    """The identifiers by which an article counts as seen."""
    found = F.when(F.col("sharedCityArticle"), F.array(F.col("id"), title_city_id())).otherwise(F.array(F.col("id"), link_id(), title_id()))
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull() & (x != "")))


def created(now: Column) -> Column:
    return dates.created_at(F.col("createdAt"), F.col("publishedAt"), F.col("fetchedAt"), now, F.col("sharedCityArticle"))


def payload(df: DataFrame, now: Column) -> DataFrame:
    """The nine fields of an API payload."""
    return df.select("title", "description", "cityCode", "isActive", "newsLink", "thumbnailImage", "postedBy", dates.iso_text(created(now)).alias("createdAt"), "postedByLogo")


def missing_fields() -> Column:
    """Required payload fields that are blank. createdAt never is: it falls back to now."""
    return F.array_compact(F.array(*[F.when(trim(text(F.col(c))) == "", F.lit(c)) for c in REQUIRED_FIELDS if c != "createdAt"]))


def invalid_urls() -> Column:
    return F.array_compact(F.array(*[F.when(~is_http(F.col(c)), F.lit(c)) for c in URL_FIELDS]))


def priority() -> Column:
    return F.col("sharedCityArticle").cast("int")
