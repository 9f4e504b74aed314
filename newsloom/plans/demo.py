"""Frames the registered queries start from, derived from the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import gold as gold_ops
from newsloom.operators import markets as market_ops
from newsloom.operators import silver as silver_ops
from newsloom.session import scratch
from newsloom.sources import tables
from newsloom.sources.layers import union_by_name

RUN_TS = "2024-02-01 12:30:15"
_stored: dict[tuple[str, str, str], str] = {}


def run_ts():
    return F.lit(RUN_TS).cast("timestamp")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.to_silver(tables.raw_articles(spark, sf_dir), run_ts(), keep=("arrival",))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.market_events(spark, sf_dir)


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_ops.nested_markets(events(spark, sf_dir))


def _keep(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Write a layer once per session to the shared folder, as a warehouse would hold it."""
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _stored:
        path = scratch(spark, name)
        build().write.parquet(path)
        _stored[slot] = path
    return spark.read.parquet(_stored[slot])


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keep(spark, sf_dir, "silver", lambda: silver(spark, sf_dir))


def build_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    topical = tables.demo_topics(silver_table(spark, sf_dir))
    return gold_ops.to_gold(topical, run_ts(), events(spark, sf_dir), markets(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored layer: sound articles only."""
    return _keep(spark, sf_dir, "gold", lambda: build_gold(spark, sf_dir))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse table: scored articles, and the failed ones the stream also
    stores, without topic or market columns."""
    failed = silver_table(spark, sf_dir).where("quality_status = 'FAIL'")
    return union_by_name([gold(spark, sf_dir), failed])


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored articles with the API's names and the market page's entity."""
    from newsloom.functions import text
    from newsloom.operators.serving import api_names

    named = api_names(gold(spark, sf_dir))
    return named.withColumn("entity", text.market_entity(F.col("titre"), F.col("topic")))


def day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


def second(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
