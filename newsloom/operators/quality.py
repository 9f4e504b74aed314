"""Counts, gates and checks on the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import rules
from newsloom.operators.skew import join_per_key


def flag_histogram(silver: DataFrame) -> DataFrame:
    return (
        silver.select(F.explode("quality_flags").alias("flag"))
        .groupBy("flag")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def run_counts(silver: DataFrame) -> DataFrame:
    """Rows per source of a run, sound and failed."""
    ok = F.col("quality_status") == "OK"
    return silver.groupBy("source").agg(
        F.count(F.lit(1)).alias("articles_scraped"),
        F.count_if(ok).alias("quality_ok"),
        F.count_if(~ok).alias("quality_fail"),
    )


def by_source(gold: DataFrame) -> DataFrame:
    ok = F.col("quality_status") == "OK"
    return gold.where("source IS NOT NULL").groupBy("source").agg(
        F.count_if(ok).alias("ok"), F.count_if(~ok).alias("fail")
    )


def gate(
    silver: DataFrame,
    expected: DataFrame,
    min_articles: int = rules.MIN_ARTICLES_PER_SOURCE,
    min_rate: float = rules.MIN_QUALITY_OK_RATE,
    run_date: str = "",
) -> DataFrame:
    """Daily verdict per expected source, with the alerts it raises for `run_date`."""
    counts = run_counts(silver)
    n = F.coalesce("articles_scraped", F.lit(0))
    rate = F.col("quality_ok") / F.col("articles_scraped")
    few, poor = n < min_articles, rate < min_rate
    name = F.concat(F.lit("'"), "source", F.lit("'"))
    missing_alert = F.concat(F.lit("[ALERTE] Aucune donnée Silver pour "), name, F.lit(f" le {run_date}"))
    few_alert = F.concat(
        F.lit("[ALERTE] "), name, F.lit(" : seulement "), n.cast("string"), F.lit(f" articles (min={min_articles})")
    )
    poor_alert = F.concat(
        F.lit("[ALERTE] "), name, F.format_string(" : taux qualité %.1f%%", rate * 100), F.lit(f" < {min_rate:.0%}")
    )
    alerts = F.when(n == 0, F.array(missing_alert)).otherwise(
        F.array_compact(F.array(F.when(few, few_alert), F.when(poor, poor_alert)))
    )
    return expected.join(counts, "source", "left").select(
        "source",
        F.when(n == 0, "MISSING").when(poor, "LOW_QUALITY").when(few, "LOW_VOLUME").otherwise("OK").alias("status"),
        n.alias("articles"),
        F.round(rate, 4).alias("quality_ok_rate"),
        alerts.alias("alerts"),
    )


def funnel(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows per layer; an empty first layer shows the second one's count."""
    def size(df: DataFrame, layer: str, step: int) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(step).alias("step"), F.lit(layer).alias("layer"), "n"
        )

    counts = size(bronze, "bronze", 1).union(size(silver, "silver", 2)).union(size(gold, "gold", 3))
    by_layer = counts.agg(*[
        F.max(F.when(F.col("layer") == x, F.col("n"))).alias(x) for x in ("bronze", "silver", "gold")
    ])
    first = F.when(F.col("bronze") > 0, F.col("bronze")).otherwise(F.col("silver"))
    return by_layer.select(
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("step"), F.lit("bronze").alias("layer"), first.alias("n")),
                F.struct(F.lit(2).alias("step"), F.lit("silver").alias("layer"), F.col("silver").alias("n")),
                F.struct(F.lit(3).alias("step"), F.lit("gold").alias("layer"), F.col("gold").alias("n")),
            )
        )
    )


def percent_of(part: Column, whole: Column) -> Column:
    """One decimal; NULL when there is nothing to compare with."""
    return F.round(F.try_divide(part * 100.0, whole), 1)


def kpis(bronze: DataFrame, gold: DataFrame) -> DataFrame:
    total = bronze.agg(F.count(F.lit(1)).alias("bronze_rows"))
    sums = gold.agg(
        F.count(F.lit(1)).alias("gold_rows"), F.count_if(F.col("quality_status") == "OK").alias("ok_rows")
    )
    both = sums.withColumn("bronze_rows", total.scalar())
    ok_pct = F.coalesce(percent_of(F.col("ok_rows"), F.col("gold_rows")), F.lit(0.0))
    return both.select(
        "gold_rows",
        "ok_rows",
        ok_pct.alias("ok_pct"),
        F.when(F.col("gold_rows") > 0, F.round(100.0 - ok_pct, 1)).otherwise(0.0).alias("rejected_pct"),
        percent_of(F.col("gold_rows"), F.col("bronze_rows")).alias("retention_pct"),
    )


def country_consistency(silver: DataFrame, expected: DataFrame) -> DataFrame:
    """Articles whose country differs from the one their source is known for."""
    return silver.join(expected, "source").where(
        F.col("expected_country").isNotNull() & ~F.col("pays").eqNullSafe(F.col("expected_country"))
    )


def duplicate_content(silver: DataFrame, row_id: str = "article_id") -> DataFrame:
    """Rows that share their content with another row, with the group size. The
    counts carry hot groups: their rows are spread, see `join_per_key`."""
    filled = silver.where("content_hash <> ''")
    sizes = filled.groupBy("content_hash").agg(F.count(F.lit(1)).alias("copies"))
    return join_per_key(filled, sizes, "content_hash", "copies", row_id).where("copies > 1")


def retention_candidates(partitions: DataFrame, today: Column) -> DataFrame:
    """Partitions (layer, source, date) past their keeping time."""
    keep = F
    for layer, days in rules.RETENTION_DAYS.items():
        keep = keep.when(F.col("layer") == layer, F.lit(days))
    return (
        partitions.withColumn("keep_days", keep.otherwise(F.lit(None)))
        .withColumn("age_days", F.datediff(today, F.col("date")))
        .where("age_days > keep_days")
    )
