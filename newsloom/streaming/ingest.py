"""Ingestion events as a stream: each announces landed articles, which are cleaned
and put into the stored table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from newsloom.operators import silver as silver_ops
from newsloom.sinks import layers as sink
from newsloom.sinks import table
from newsloom.sources import layers as source

EVENT = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("bronze_path", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)


def kafka_events(spark: SparkSession, servers: str, topic: str, offsets: str = "earliest") -> DataFrame:
    """The topic; where a restart goes on is kept by the query's checkpoint."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", offsets)
        .load()
    )
    return parse(raw.select(F.col("value").cast("string").alias("value")))


def file_events(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same messages from a folder of JSON lines."""
    reader = spark.readStream.schema("value string").format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse(reader.load(path))


def parse(lines: DataFrame) -> DataFrame:
    return lines.select(F.from_json("value", EVENT).alias("e")).select("e.*")


def ingested(events: DataFrame) -> DataFrame:
    return events.where("event = 'articles_ingested'")


def path_parts(path: Column) -> dict[str, Column]:
    """Source and date of a Bronze path: `.../source=<s>/date=<d>`, or `.../<s>/<d>/...`."""
    plain = F.regexp_replace(F.regexp_replace(path, "(source|date)=", ""), "^[a-z0-9]+://[^/]+/", "")
    pattern = "(?:^|/)([^/]+)/([0-9]{4}-[0-9]{2}-[0-9]{2})(?:/|$)"
    return {
        "source": F.regexp_extract(plain, pattern, 1),
        "date": F.regexp_extract(plain, pattern, 2),
    }


def announced_partitions(events: DataFrame) -> DataFrame:
    """The (source, date) partitions a batch of events names, each once."""
    parts = path_parts(F.col("bronze_path"))
    return ingested(events).select(*[c.alias(n) for n, c in parts.items()]).distinct()


#: Dates a source's state remembers. A run announced again after that is cleaned again, which changes nothing.
KEPT_DATES = 60


def first_announcements(events: DataFrame) -> DataFrame:
    """(source, date, run) of a stream of events, each run once however often and in whichever batch it is announced. The state is kept by source: the
    runs of its last dates. A message's time names its run; where it has none the run is null, and passes every time."""
    parts = path_parts(F.col("bronze_path"))
    run = sink.run_name(F.try_to_timestamp("timestamp"))
    named = ingested(events).select(*[c.alias(n) for n, c in parts.items()], run.alias("run"))

    def fresh(key, frames, state):
        import json

        import pandas as pd

        seen = json.loads(state.get[0]) if state.exists else {}
        out = []
        for frame in frames:
            for date, run in zip(frame["date"], frame["run"]):
                if run is None:
                    out.append((key[0], date, None))
                elif run not in seen.setdefault(date, []):
                    seen[date].append(run)
                    out.append((key[0], date, run))
        state.update((json.dumps({d: seen[d] for d in sorted(seen)[-KEPT_DATES:]}),))
        yield pd.DataFrame(out, columns=["source", "date", "run"])

    return named.groupBy("source").applyInPandasWithState(fresh, "source string, date string, run string", "seen string", "append", "NoTimeout")


def runs_of(spark: SparkSession, bronze_root: str, named: DataFrame) -> list[tuple[str, str, str]]:
    """Landed runs that a batch names: one row per message, so few. A run that is not there by that name stands for all of its partition."""
    there: dict[tuple, set] = {}
    for r in source.folders(spark, bronze_root, "source", "date", "run"):
        there.setdefault((r["source"], r["date"]), set()).add(r["run"])
    out = set()
    for r in named.distinct().collect():
        found = there.get((r.source, r.date), set())
        out |= {(r.source, r.date, run) for run in (found & {r.run} or found)}
    return sorted(out)


def upsert_batch(
    spark: SparkSession,
    bronze_root: str,
    gold_root: str,
    run_ts: Column,
    silver_root: str | None = None,
    analytics_root: str | None = None,
    analytics_every: int = 1,
) -> Callable:
    """What one micro-batch of events, or of `first_announcements`, does: clean the announced articles (of the whole day, or of the runs
    alone), store them and, every `analytics_every` batches, refresh the analytic tables. Inside a run the first copy of an
    article counts, across runs the last run's: the stored table is the same wherever batches are cut, in whatever
    order messages come, and however often. Give it a Silver root to keep the cleaned files as well."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if "run" in batch.columns:
            runs = runs_of(session, bronze_root, batch)
            if not runs:
                return
            articles = source.bronze(session, bronze_root, runs=runs)
        else:
            runs, named = [], announced_partitions(batch)
            if named.isEmpty():
                return
            articles = source.bronze(session, bronze_root, only=named)
        cleaned = silver_ops.to_silver(articles, run_ts, keep=("landed",), within="landed")
        if silver_root:
            sink.write_silver(cleaned.drop("landed"), silver_root, run_ts)
        sink.upsert_gold(session, gold_root, cleaned, "landed", tuple("/".join(r) for r in runs))
        if analytics_root and batch_id % analytics_every == 0:
            table.refresh(session, gold_root, analytics_root, run_ts)

    return apply


def run(events: DataFrame, apply: Callable, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start the query; `available_now` works off what there is and stops."""
    writer = events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()
