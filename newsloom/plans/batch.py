"""The daily job: landed articles through all layers into the warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import gold as gold_ops
from newsloom.operators import quality, topics
from newsloom.operators import silver as silver_ops
from newsloom.session import release
from newsloom.sinks import layers as sink
from newsloom.sinks import table
from newsloom.sources import layers as source


@dataclass(frozen=True)
class Roots:
    """Where the layers lie; any URI Spark can write to."""

    base: str

    def __getattr__(self, layer: str) -> str:
        return f"{self.base}/{layer}"


def ingest(spark: SparkSession, raw: DataFrame, roots: Roots, run_ts: Column, run_date: str, key: str = "source") -> None:
    """Land articles, clean them, announce them and record the run. Each layer is read
    back from where it was written, so a step that fails can be repeated alone."""
    sink.write_bronze(raw, roots.bronze, run_ts, key)
    release(spark)
    sink.write_envelopes(raw, roots.bronze, run_ts, key)
    landed = source.bronze(spark, roots.bronze, date=run_date, latest=True)
    sink.write_silver(silver_ops.to_silver(landed, run_ts), roots.silver, run_ts, roots.silver_json)
    release(spark)
    silver = source.silver_latest(spark, roots.silver, run_date)
    counts = quality.run_counts(silver)
    sink.emit_events(sink.ingestion_events(counts, roots.bronze, run_date, run_ts), roots.events)
    sink.append_ingestion_stats(counts, roots.ingestion_stats, run_ts)


def check(spark: SparkSession, roots: Roots, expected: DataFrame, run_date: str, fail_on_alert: bool = False) -> DataFrame:
    """The daily gate over the newest cleaned files; optionally stops the job."""
    report = quality.gate(source.silver_latest(spark, roots.silver, run_date), expected, run_date=run_date)
    sink.write_quality_report(report, roots.quality, run_date)
    if fail_on_alert and not report.where(F.size("alerts") > 0).isEmpty():
        raise RuntimeError(f"quality gate raised alerts for {run_date}")
    return report


def build(
    spark: SparkSession,
    roots: Roots,
    events: DataFrame | None,
    markets: DataFrame | None,
    run_ts: Column,
    run_date: str,
    model: str = "density",
) -> DataFrame:
    """Topics, market match, scores, summaries and warehouse from the day's Silver. An
    article that several runs brought is stored as the last of them has it. The staged topics go once the scores are staged. `model`: `density`, `centres` (k-means), `skip` (one
    counted topic) or `missing` (none)."""
    silver = source.silver_latest(spark, roots.silver, run_date)
    fill = {"density": topics.model_topics, "centres": lambda df: topics.model_topics(df, method="centres"), "skip": topics.model_skipped, "missing": topics.model_missing}
    landed = silver.withColumn("landed", F.concat_ws("/", "date", "run", "source"))
    topical = fill[model](landed.drop("date", "run"))
    stage = f"{roots.topics_stage}/date={run_date}"
    topical.write.mode("overwrite").options(**sink.PARQUET).parquet(stage)
    release(spark)
    staged = spark.read.parquet(stage)
    scored = gold_ops.to_gold(staged, run_ts, events, markets)
    scored = silver_ops.fill_missing(
        scored, {"polymarket_question": F.lit(""), "polymarket_prob": F.lit(None).cast("double")}
    )
    scored.write.mode("overwrite").options(**sink.PARQUET).parquet(f"{roots.gold_stage}/date={run_date}")
    sink.remove(spark, stage)
    release(spark)
    gold = spark.read.parquet(f"{roots.gold_stage}/date={run_date}")
    summary = gold_ops.topic_summary(gold, order="article_id")
    sink.write_gold(gold.drop("landed"), summary, roots.gold, roots.topics, run_ts)
    release(spark)
    sink.upsert_gold(spark, roots.gold_table, gold, "landed")
    sink.append_topic_summaries(summary, roots.topic_summaries, run_date, run_ts)
    table.refresh(spark, roots.gold_table, roots.analytics, run_ts)
    return gold
