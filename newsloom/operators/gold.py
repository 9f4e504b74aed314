"""Cleaned articles with topics to the scored layer and its summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import numbers
from newsloom.operators import markets as market_ops
from newsloom.operators.skew import join_bounded


def quality_ok(df: DataFrame) -> DataFrame:
    return df.where("quality_status = 'OK'") if "quality_status" in df.columns else df


def topic_counts(df: DataFrame) -> DataFrame:
    """Rows per topic; NULL topics count for nothing."""
    return (
        df.where("topic_label IS NOT NULL")
        .groupBy("topic_label")
        .agg(F.count(F.lit(1)).alias("topic_article_count"))
    )


def with_coverage(df: DataFrame) -> DataFrame:
    """Topic size on every row, and its share of the largest topic. The largest size
    is a scalar over the counts, not a window over the rows. Topics are what the topic model
    yields, `topics.MAX_TOPICS` and the defaults at most, so the texts stay where they are."""
    counts = topic_counts(df)
    biggest = counts.agg(F.max("topic_article_count")).scalar()
    scored = counts.withColumn(
        "topic_coverage_score", numbers.round4(F.col("topic_article_count") / biggest)
    )
    return join_bounded(df, scored, "topic_label")


def to_gold(
    silver: DataFrame,
    run_ts: Column,
    events: DataFrame | None = None,
    markets: DataFrame | None = None,
) -> DataFrame:
    """Keep sound articles, attach the market match, coverage and signal."""
    df = quality_ok(silver)
    if events is not None:
        df = market_ops.enrich(df, events, markets)
    if "topic_label" in df.columns:
        df = with_coverage(df)
    if {"polymarket_prob", "topic_prob"} <= set(df.columns):
        df = df.withColumn(
            "combined_signal", numbers.combined_signal(F.col("polymarket_prob"), F.col("topic_prob"))
        )
    return df.withColumn("gold_built_at", run_ts)


def topic_summary(gold: DataFrame, order: str = "arrival") -> DataFrame:
    """One row per topic. Counted per (topic, source) first, so a large topic is
    spread over its sources and only small rows meet per topic."""
    asked = F.coalesce("polymarket_question", F.lit("")) != ""
    per_source = (
        gold.where("topic_label IS NOT NULL")
        .groupBy("topic_label", "source")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("polymarket_prob").cast("decimal(28,6)")).alias("prob_sum"),
            F.count("polymarket_prob").alias("prob_n"),
            F.min(F.when(asked, F.struct(order, "polymarket_question"))).alias("first_q"),
            F.min("date_publication").alias("date_min"),
            F.max("date_publication").alias("date_max"),
        )
    )
    entry = F.when(F.col("source").isNotNull(), F.struct(-F.col("n"), F.col("source")))
    sources = F.transform(
        F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["source"].alias("key"), (-e["col1"]).alias("value"))
    )
    mean = F.sum("prob_sum").cast("double") / F.nullif(F.sum("prob_n"), F.lit(0))
    return (
        per_source.groupBy("topic_label")
        .agg(
            F.sum("n").alias("article_count"),
            F.map_from_entries(sources).alias("sources"),
            numbers.round4(mean).alias("avg_polymarket_prob"),
            F.min("first_q")["polymarket_question"].alias("polymarket_question"),
            F.struct(F.min("date_min").alias("min"), F.max("date_max").alias("max")).alias("date_range"),
        )
        .orderBy(F.desc("article_count"), "topic_label")
    )


def value_histogram(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
