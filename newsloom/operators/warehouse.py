"""Views and refreshed tables over the stored articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import rules
from newsloom.functions.numbers import exact_mean
from newsloom.operators.skew import most_frequent



def conform(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The stored layout: 30 typed columns, absent ones NULL, unreadable times NULL; and the
    `extra` columns as they are."""
    out = []
    types = dict(df.dtypes)
    for name, kind in rules.GOLD_COLUMNS.items():
        if name not in types:
            c = F.lit(None).cast(kind)
        elif kind == "timestamp" and types[name] == "string":
            c = F.try_to_timestamp(F.col(name))
        elif kind == "string" and types[name].startswith("array"):
            c = F.to_json(F.col(name))
        else:
            c = F.col(name).cast(kind)
        out.append(c.alias(name))
    return df.select(*out, *extra)


def sound(df: DataFrame) -> DataFrame:
    return df.where("quality_status = 'OK'")


def on_topic(df: DataFrame) -> DataFrame:
    return sound(df).where("topic_id >= 0")


def published_day() -> Column:
    return F.to_date("date_publication")


def topic_daily_coverage(gold: DataFrame) -> DataFrame:
    return (
        on_topic(gold)
        .groupBy(published_day().alias("pub_date"), "topic_label")
        .agg(
            F.count(F.lit(1)).alias("article_count"),
            exact_mean(F.col("polymarket_prob")).alias("avg_market_prob"),
            F.sum(F.col("topic_coverage_score").cast("decimal(28,6)")).cast("double").alias("total_coverage_score"),
        )
        .orderBy(F.desc("pub_date"), F.desc("article_count"), "topic_label")
    )


def top_topics_with_signal(gold: DataFrame, n: int = 20) -> DataFrame:
    return (
        on_topic(gold)
        .where("polymarket_prob IS NOT NULL")
        .groupBy("topic_label")
        .agg(
            F.count(F.lit(1)).alias("article_count"),
            F.round(exact_mean(F.col("polymarket_prob")), 4).alias("avg_prob"),
            F.max("polymarket_question").alias("market_question"),
            F.round(exact_mean(F.col("combined_signal")), 4).alias("avg_combined_signal"),
        )
        .orderBy(F.desc("article_count"), F.desc("avg_prob"), "topic_label")
        .limit(n)
    )


def source_breakdown(gold: DataFrame) -> DataFrame:
    return (
        sound(gold)
        .groupBy("source", "langue", "pays")
        .agg(
            F.count(F.lit(1)).alias("article_count"),
            F.min("date_publication").alias("earliest"),
            F.max("date_publication").alias("latest"),
            F.avg("content_length").alias("avg_content_length"),
        )
        .orderBy(F.desc("article_count"), "source", "langue", "pays")
    )


def daily_stats(gold: DataFrame) -> DataFrame:
    return (
        sound(gold)
        .groupBy(published_day().alias("pub_date"), "source")
        .agg(
            F.count(F.lit(1)).alias("article_count"),
            F.avg("content_length").alias("avg_length"),
            F.countDistinct("topic_label").alias("topic_count"),
        )
        .orderBy(F.desc("pub_date"), F.desc("article_count"), "source")
    )


def _with_top_source(summary: DataFrame, gold: DataFrame, key: Column, name: str) -> DataFrame:
    """Most frequent source per key over *all* stored rows, sound or not. Both sides
    hold one small row per key by now; a NULL key has no top source."""
    top = most_frequent(gold.where(key.isNotNull()), key, "source", "top_source")
    return summary.join(top.withColumnRenamed("key", name), name, "left")


def articles_by_day(gold: DataFrame) -> DataFrame:
    summary = sound(gold).groupBy(published_day().alias("pub_date")).agg(
        F.count(F.lit(1)).alias("article_count"), F.avg("content_length").alias("avg_content_length")
    )
    return _with_top_source(summary, gold, published_day(), "pub_date")


def articles_by_theme(gold: DataFrame) -> DataFrame:
    summary = on_topic(gold).groupBy("topic_label").agg(
        F.count(F.lit(1)).alias("article_count"),
        exact_mean(F.col("polymarket_prob")).alias("avg_polymarket_prob"),
    )
    return _with_top_source(summary, gold, F.col("topic_label"), "topic_label")


def articles_by_country(gold: DataFrame) -> DataFrame:
    summary = sound(gold).groupBy("pays").agg(F.count(F.lit(1)).alias("article_count"))
    return _with_top_source(summary, gold, F.col("pays"), "pays")


def articles_by_source(gold: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("quality_status") == "OK")
    return gold.groupBy("source").agg(
        F.count(F.lit(1)).alias("article_count"),
        F.round(ok / F.count(F.lit(1)), 4).alias("quality_ok_rate"),
        F.avg("content_length").alias("avg_content_length"),
    )


VIEWS = {
    "v_topic_daily_coverage": topic_daily_coverage,
    "v_top_topics_with_signal": top_topics_with_signal,
    "v_source_breakdown": source_breakdown,
    "v_daily_stats": daily_stats,
}
ANALYTICS = {
    "analytics_articles_by_day": articles_by_day,
    "analytics_articles_by_theme": articles_by_theme,
    "analytics_articles_by_country": articles_by_country,
    "analytics_articles_by_source": articles_by_source,
}


def register(spark: SparkSession, gold: DataFrame) -> None:
    """Make the stored articles and everything derived from them askable in SQL."""
    gold.createOrReplaceTempView("gold_articles")
    for name, build in {**VIEWS, **ANALYTICS}.items():
        build(gold).createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)


def upsert(stored: DataFrame, batch: DataFrame, key: str = "article_id") -> DataFrame:
    """Stored rows whose key the batch does not bring, plus the batch."""
    ids = batch.select(key)
    return stored.join(ids, key, "left_anti").unionByName(batch)
