"""City routing: the cities of an article, and a row for each of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.functions import articles
from quillsieve.operators import rules


def assign(df: DataFrame, pack: rules.Pack) -> DataFrame:
    """Articles with rules, the code of their first city (empty: none) and an id."""
    judged = rules.evaluate(articles.ensure(df), pack)
    coded = judged.withColumn("cityCode", F.coalesce(F.get("rules.codes", F.lit(0)), F.lit("")))
    if pack.opt_in:  # only then do rules depend on the code
        coded = rules.evaluate(coded.drop("rules"), pack)
    return coded.withColumn("id", articles.stable_id())


def fan_out(df: DataFrame, pack: rules.Pack) -> DataFrame:
    """A row for each city of an article; without a city the row stays as it is."""
    codes = F.col("rules.codes")
    rows = df.withColumn("__code", F.explode_outer(codes)).withColumn("__n", F.size(codes))
    some = F.col("__code").isNotNull()
    rows = rows.withColumns({"sharedCityArticle": F.when(some, F.col("__n") > 1).otherwise(F.col("sharedCityArticle")), "cityCode": F.when(some, F.col("__code")).otherwise(F.col("cityCode"))})
    rows = rows.withColumn("id", F.when(some, articles.stable_id()).otherwise(F.col("id"))).drop("__code", "__n")
    return rules.evaluate(rows.drop("rules"), pack) if pack.opt_in else rows
