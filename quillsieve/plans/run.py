"""One run over extracted articles: clean, route, fan out, judge, select, order, audit."""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions import articles, dates
from quillsieve.functions.text import normalize_title
from quillsieve.operators import audit, route, rules, select
from quillsieve.sources.options import Options
from quillsieve.sources.scratch import Scratch


class Run:
    """The tables of a run, each made when it is first asked for.

    judged: the rows inside the window; chosen: those that go out, at most max_items.
    """

    def __init__(self, rows: DataFrame, inside: Column, options: Options, now: datetime):
        self.rows, self.inside, self.options, self.now = rows, inside, options, now
        self.pack = rules.Pack.default(options.opt_in)
        self.judged = rows.where(inside)
        self.reported = self.judged.withColumn("reasons", F.when(F.col("skipped"), F.array(F.lit(audit.SKIPPED))).otherwise(F.col("reasons")))

    @cached_property
    def chosen(self) -> DataFrame:
        able = self.judged.where(~F.col("skipped") & (F.size("reasons") == 0))
        ranked = able.withColumn("rank", F.struct(*[x.alias(f"r{i}") for i, x in enumerate(_ranks())]))
        top = select.greedy_top(ranked, "rank", "ids", self.options.max_items)
        return Scratch(self.rows.sparkSession, "chosen").cut(top).orderBy("rank").drop("rank")

    @cached_property
    def payloads(self) -> DataFrame:
        return articles.payload(self.chosen.orderBy(*select.push_order()), F.lit(self.now).cast("timestamp"))

    @cached_property
    def reason_counts(self) -> DataFrame:
        return audit.reason_counts(self.reported)

    @cached_property
    def missed(self) -> DataFrame:
        return audit.missed(self.judged, self.pack) if self.options.audit else audit.missed(self.judged.limit(0), self.pack)

    @cached_property
    def date_excluded(self) -> DataFrame:
        return audit.date_excluded(self.rows, self.inside)

    @cached_property
    def rejections(self) -> DataFrame:
        return audit.rejections(self.reported)

    @cached_property
    def push_counts(self) -> DataFrame:
        return audit.push_counts(self.chosen)


def judge(df: DataFrame, sent: DataFrame, options: Options) -> DataFrame:
    """Cleaned, routed rows with ids, reasons (of one kind if skipped by title) and ``skipped``.

    df: articles with a unique seq.
    """
    pack = rules.Pack.default(options.opt_in)
    routed = route.fan_out(route.assign(articles.clean(articles.ensure(df)), pack), pack)
    routed = routed.where(select.city_filter(options.cities, [c for c, _ in pack.cities]))
    routed = Scratch(df.sparkSession, "judge").cut(routed)
    rows = routed.withColumn("ids", articles.dedupe_ids()).withColumn("row", F.concat_ws("|", "seq", "cityCode"))
    seen = select.seen_rows(rows, sent, "row", "ids").withColumn("sent", F.lit(True))
    rows = rows.join(seen, "row", "left").withColumn("sent", F.coalesce("sent", F.lit(False)))
    skip = normalize_title(F.col("title")).isin(options.skip_titles) if options.skip_titles else F.lit(False)
    rows = rows.withColumn("skipped", skip).withColumn("reasons", rules.reasons(F.col("sent")))
    return rows


def run(df: DataFrame, sent: DataFrame, options: Options, now: datetime) -> Run:
    """A run over articles; ``now`` is a parameter, so that runs can be repeated."""
    lo, hi = dates.window(options.start, options.end, now, options.lookback_days)
    # All tables of a run come from these rows: they are written once.
    rows = Scratch(df.sparkSession, "run").cut(judge(df, sent.limit(0) if options.resend else sent, options))
    bound = lambda x: None if x is None else F.lit(x).cast("timestamp")
    inside = select.in_window(dates.article_date(F.col("publishedAt"), F.col("createdAt")), bound(lo), bound(hi))
    return Run(rows, inside, options, now)


def _ranks():
    """The select order as a struct that sorts upwards."""
    when = F.coalesce(dates.parse(F.col("publishedAt")), F.to_timestamp(F.lit(select.EPOCH)))
    return [F.col("sharedCityArticle").cast("int"), -F.unix_micros(when), F.col("seq"), F.col("cityCode")]
