"""Queries of the rule engine over sample news, each with the rules in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions import articles
from quillsieve.operators import audit, route, rules, select
from quillsieve.plans import news as n
from quillsieve.plans.catalogue import query
from quillsieve.sources.scratch import Scratch

PLAIN, OPT_IN = rules.Pack.default(), rules.Pack.default(True)
SQL_SENT = "coalesce(seq % 10 = 0, false)"


def routed(spark: SparkSession, sf_dir: str, pack: rules.Pack = PLAIN) -> DataFrame:
    return route.assign(n.news(spark, sf_dir), pack)


#: The engine's names of the rules, and those of the SQL, by level.
SIGNALS = {"clean_pu": "r1", "clean": "r2", "target_tu": "r3_title", "target_p": "r3_primary", "jewar": "r4", "notice": "r5", "home_corridor": "r6_home", "promo": "r6_promo", "region": "region", "office": "r7", "compare": "r8", "fng": "r9", "corridor": "r10", "connected": "r11", "luxury": "r12_luxury", "authority": "r12_authority", "civic": "r12_civic"}
PLACES = {"branch": "branch", "out_pu": "r13_pu", "market": "r16", "confident": "r17_leader", "award": "r17_award"}
LISTS = {"explicit": "explicit", "company_cities": "r15"}
LATE = {"blocked": "r18", "corporate": "r19_corporate", "rera": "r19_rera", "business": "r20", "evidence": "r21_evidence", "specific": "r21_specific", "sector": "r22_evidence", "national": "r22_national", "progress": "r22_progress", "related": "r23_related", "court": "r23_court", "broad": "r23_broad", "outside_primary": "r23_outside", "conflict": "r23_conflict", "negative": "r24"}


def _flags(spark: SparkSession, sf_dir: str, names: dict[str, str], lists: dict[str, str] | None = None) -> DataFrame:
    texts = [F.array_join(f"rules.{k}", ",").alias(k) for k in lists or {}]
    return routed(spark, sf_dir).select("seq", *[F.col(f"rules.{k}").alias(k) for k in names], *texts)


def _sql_flags(names: dict[str, str], lists: dict[str, str] | None = None) -> str:
    shown = [f"{sql} AS {name}" for name, sql in names.items()] + [f"array_to_string({sql}, ',') AS {name}" for name, sql in (lists or {}).items()]
    return f"{n.sql_routed(PLAIN)} SELECT seq, {', '.join(shown)} FROM n"


@query(_sql_flags(SIGNALS))
def r1_r12_signals(spark, sf_dir):
    """R1 to R12 and P5: what an article's own texts say."""
    return _flags(spark, sf_dir, SIGNALS)


@query(_sql_flags(PLACES, LISTS))
def r13_r17_places(spark, sf_dir):
    """R13 to R17: outside places by branch, a company's cities, markets, leaders and awards."""
    return _flags(spark, sf_dir, PLACES, LISTS)


@query(_sql_flags(LATE))
def r18_r24_judgement(spark, sf_dir):
    """R18 to R24: what is blocked, related, specific, broad, outside or negative."""
    return _flags(spark, sf_dir, LATE)


@query(f"{n.sql_routed(PLAIN)} SELECT seq, r25 AS label FROM n")
def r25_label(spark, sf_dir):
    return routed(spark, sf_dir).select("seq", F.col("rules.label").alias("label"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and reasons, written once as a run does: a filter on what they say would otherwise be
    pushed below them, with a copy of every rule in it."""
    return Scratch(spark, "news").cut(routed(spark, sf_dir).withColumn("reasons", rules.reasons(F.expr(SQL_SENT))))


SQL_JUDGED = f"{n.sql_routed(PLAIN)}, j AS (SELECT *, {n.sql_reasons(SQL_SENT)} AS reasons FROM n)"


@query(f"{SQL_JUDGED} SELECT seq, array_to_string(reasons, '; ') AS reasons FROM j")
def r26_reasons(spark, sf_dir):
    return _judged(spark, sf_dir).select("seq", F.array_join("reasons", "; ").alias("reasons"))


@query(f"{SQL_JUDGED} SELECT seq FROM j WHERE len(reasons) = 0")
def w7_publishable(spark, sf_dir):
    """R27 and W7: the articles without a reason against them."""
    return _judged(spark, sf_dir).where(F.size("reasons") == 0).select("seq")


@query(f"{SQL_JUDGED} SELECT seq, {n.sql_near_miss('reasons')} AS near FROM j WHERE len(reasons) > 0")
def r28_near_miss(spark, sf_dir):
    rejected = _judged(spark, sf_dir).where(F.size("reasons") > 0)
    return rejected.select("seq", rules.near_miss(PLAIN, F.col("reasons")).alias("near"))


@query(f"{n.sql_routed(PLAIN)} SELECT seq, array_to_string(t2, ',') AS codes, city FROM n")
def t2_city_routing(spark, sf_dir):
    return routed(spark, sf_dir).select("seq", F.array_join("rules.codes", ",").alias("codes"), F.col("cityCode").alias("city"))


def _sql_id(city: str) -> str:
    return f"sha256(lower(concat_ws('|', nullif(newsLink, ''), nullif(title, ''), nullif(postedBy, ''), nullif({city}, ''))))"


@query(f"{n.sql_routed(PLAIN)} SELECT seq, c AS cityCode, len(t2) > 1 AS shared, {_sql_id('c')} AS id FROM (SELECT *, unnest(CASE WHEN len(t2) = 0 THEN [''] ELSE t2 END) AS c FROM n)")
def t1_fan_out(spark, sf_dir):
    """A row for each city of an article, with an id of its own; the row itself without one."""
    return route.fan_out(routed(spark, sf_dir), PLAIN).select("seq", "cityCode", F.col("sharedCityArticle").alias("shared"), "id")


@query(f"{n.sql_routed(OPT_IN)} SELECT seq, array_to_string(t2, ',') AS codes, city, r25 AS label, array_to_string({n.sql_reasons('false')}, '; ') AS reasons FROM n")
def r_opt_in_city(spark, sf_dir):
    """All rules with the city that takes part only if asked for; the rules then depend on the code."""
    out = routed(spark, sf_dir, OPT_IN)
    return out.select("seq", F.array_join("rules.codes", ",").alias("codes"), F.col("cityCode").alias("city"), F.col("rules.label").alias("label"), F.array_join(rules.reasons(F.lit(False)), "; ").alias("reasons"))


@query(f"WITH src AS ({n.sql_news()}) SELECT seq, {n.SQL_FOREIGN} AS foreign_language FROM src")
def p6_language(spark, sf_dir):
    d = n.news(spark, sf_dir)
    return d.select("seq", rules.foreign(d).alias("foreign_language"))


@query(f"{SQL_JUDGED} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM j) GROUP BY 1")
def a1_reason_counts(spark, sf_dir):
    return audit.reason_counts(_judged(spark, sf_dir))


@query(
    f"""{SQL_JUDGED}, w AS (SELECT *, list_filter(reasons, lambda x: x <> {n.text(rules.REASONS[13])}) AS why, trim(regexp_replace(replace(t, '&', ' and '), '[^a-z0-9]+', ' ', 'g')) AS k FROM j WHERE title <> ''),
    m AS (SELECT * FROM w WHERE len(why) > 0 AND {n.sql_near_miss('why')}),
    f AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1)
    SELECT seq, title, r25 AS label, array_to_string(why, '; ') AS reasons FROM f ORDER BY seq LIMIT 20"""
)
def a5_near_misses(spark, sf_dir):
    """The first twenty rejected articles that look like targets."""
    out = audit.missed(_judged(spark, sf_dir).withColumn("skipped", F.lit(False)), PLAIN)
    return out.select("seq", "title", "label", "reasons")


@query(f"{SQL_JUDGED}, f AS (SELECT * FROM j ORDER BY seq LIMIT 100) SELECT seq, title, array_to_string(reasons, '; ') AS reasons FROM f WHERE len(reasons) > 0 AND title <> ''")
def a7_rejections(spark, sf_dir):
    """The reasons of the first hundred rows."""
    return audit.rejections(_judged(spark, sf_dir)).select("seq", "title", "reasons")


@query(f"WITH src AS ({n.sql_news()}) SELECT seq, newsLink FROM src WHERE regexp_matches(newsLink, '^(?i)https?://[^/?#\\s]+') AND NOT ({' OR '.join(f'contains(lower(newsLink), {n.text(x)})' for x in n.w.BLOCKED_SOURCES)})")
def w2_extra_urls(spark, sf_dir):
    """Links that may be read as articles."""
    return n.news(spark, sf_dir).where(select.allowed_extra(F.col("newsLink"))).select("seq", "newsLink")


@query(f"WITH src AS ({n.sql_news()}) SELECT seq, lower(title) || ' ' || lower(description) AS primary_text, lower(title) || ' ' || lower(description) || ' ' || lower(articleText) || ' ' || lower(newsLink) AS search_text, lower(articleText) AS body, lower(newsLink) AS url FROM src")
def f15_views(spark, sf_dir):
    v = articles.views()
    return n.news(spark, sf_dir).select("seq", v["primary"].alias("primary_text"), v["search"].alias("search_text"), v["body"].alias("body"), v["url"].alias("url"))


@query(f"WITH src AS ({n.sql_news()}) SELECT title, description, '' AS cityCode, true AS isActive, newsLink, thumbnailImage, postedBy, '2026-07-01T00:00:00.000Z' AS createdAt, postedByLogo FROM src")
def f13_payload(spark, sf_dir):
    """The fields of an API payload; the time of creation is that of publication."""
    return articles.payload(n.news(spark, sf_dir), F.lit(None).cast("timestamp"))
