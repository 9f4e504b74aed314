"""Writing the layers, the warehouse tables, events and reports. A path may name any
file system Spark knows (`s3a://...`, `hdfs://...`): a failed write fails the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import rules
from newsloom.functions import dates
from newsloom.operators import warehouse
from newsloom.sinks import table
from newsloom.sources.layers import folders

#: Layers hold whole texts several times over, so they are compressed; files are of bounded size, so JSON need not be split.
PARQUET, JSON = {"compression": "zstd"}, {"compression": "gzip"}


def run_name(run_ts: Column) -> Column:
    """Names sort in time order; the letter keeps them from being read as numbers."""
    return F.date_format(run_ts, "'r'HHmmss")


def write_bronze(articles: DataFrame, root: str, run_ts: Column, key: str = "source") -> None:
    """One article per line under `source=/date=/run=`, with its place in the run; no
    articles, no file. Rows are rebalanced by source: a large one is split over many files. The
    facts of the run lie beside the layer, see `write_envelopes`."""
    placed = articles.withColumn("pos", F.monotonically_increasing_id())
    own = [F.col(c).alias("article_source") if c == "source" else F.col(c) for c in rules.RAW_COLUMNS]
    out = _stamped(placed.select(*own, "pos", F.col(key).alias("source")), run_ts)
    out.hint("rebalance", "source").write.mode("append").options(**JSON).partitionBy("source", "date", "run").json(root)


def write_envelopes(articles: DataFrame, root: str, run_ts: Column, key: str = "source") -> None:
    """One line per source and run: source, writing time, number of articles, schema version."""
    counts = articles.groupBy(F.col(key).alias("source")).agg(F.count(F.lit(1)).alias("article_count"))
    facts = counts.select("source", dates.iso(run_ts).alias("written_at"), "article_count", F.lit("1.0").alias("schema_version"))
    _stamped(facts, run_ts).write.mode("append").partitionBy("date", "run").json(f"{root.rstrip('/')}-envelopes")


def _stamped(df: DataFrame, run_ts: Column) -> DataFrame:
    return df.withColumns({"date": F.date_format(run_ts, "yyyy-MM-dd"), "run": run_name(run_ts)})


def write_silver(df: DataFrame, root: str, run_ts: Column, json_root: str | None = None) -> None:
    """Parquet by source, run date and run; a JSON copy where asked for. Rows
    are rebalanced by source first: small sources share a task and get one file, a
    large one is split over many tasks by its size. The copy is made of the files just written, so rows are worked out and shuffled once."""
    spark = df.sparkSession
    day, run = spark.range(1).select(F.date_format(run_ts, "yyyy-MM-dd"), run_name(run_ts)).first()
    before = set(_files(spark, root, day, run)) if json_root else set()
    out = df.withColumns({"date": F.lit(day), "run": F.lit(run)})
    out.hint("rebalance", "source").write.mode("append").options(**PARQUET).partitionBy("source", "date", "run").parquet(root)
    if json_root:
        paths = [p for p in _files(spark, root, day, run) if p not in before]
        rows = spark.read.schema(out.schema).option("basePath", root).parquet(*paths) if paths else spark.createDataFrame([], out.schema)
        readable = rows.withColumn("date_publication", F.col("date_publication").cast("string"))
        readable.write.mode("append").options(**JSON).partitionBy("source", "date", "run").json(json_root)


def _files(spark: SparkSession, root: str, day: str, run: str) -> list[str]:
    """Files of a run."""
    out = []
    for r in folders(spark, root, "source", "date", "run", date=day, run=run):
        folder = spark._jvm.org.apache.hadoop.fs.Path(r["path"])
        found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
        out += [f.getPath().toString() for f in found if f.isFile() and not f.getPath().getName().startswith((".", "_"))]
    return out


def write_gold(df: DataFrame, summary: DataFrame, root: str, topics_root: str, run_ts: Column) -> None:
    """Gold by run date with times as text, and the topic summary as JSON."""
    as_text = {c: F.col(c).cast("string") for c, t in df.dtypes if t.startswith("timestamp")}
    _stamped(df.withColumns(as_text), run_ts).write.mode("append").options(**PARQUET).partitionBy("date", "run").parquet(root)
    _stamped(summary, run_ts).write.mode("append").partitionBy("date", "run").json(topics_root)


def upsert_gold(spark: SparkSession, root: str, batch: DataFrame, order: str, runs: tuple[str, ...] = ()) -> int:
    """Insert or replace by article id, see `table.upsert`."""
    return table.upsert(spark, root, batch, order, runs)


def read_gold_table(spark: SparkSession, root: str) -> DataFrame:
    """Each article once, as its newest version has it."""
    return table.read(spark, root)


def compact_gold(spark: SparkSession, root: str) -> None:
    """Fold all versions into one; a reader finds every article at any time."""
    table.compact(spark, root)


def topic_summary_rows(summary: DataFrame, run_date: str, now: Column) -> DataFrame:
    return summary.select(
        F.expr("uuid()").alias("id"),
        F.lit(run_date).cast("date").alias("run_date"),
        "topic_label",
        "article_count",
        F.to_json("sources").alias("sources_json"),
        "avg_polymarket_prob",
        F.coalesce("polymarket_question", F.lit("")).alias("polymarket_question"),
        F.col("date_range.min").alias("date_min"),
        F.col("date_range.max").alias("date_max"),
        now.alias("created_at"),
    )


def append_topic_summaries(summary: DataFrame, root: str, run_date: str, now: Column) -> None:
    topic_summary_rows(summary, run_date, now).write.mode("append").parquet(root)


def ingestion_stats_rows(counts: DataFrame, run_ts: Column) -> DataFrame:
    """One row per source and run; what a run did not report is zero or empty."""
    have = counts.columns

    def col(name: str, default) -> Column:
        return F.coalesce(F.col(name), F.lit(default)).alias(name) if name in have else F.lit(default).alias(name)

    return counts.select(
        F.to_date(run_ts).alias("run_date"),
        run_ts.alias("run_timestamp"),
        "source",
        col("articles_scraped", 0),
        col("quality_ok", 0),
        col("quality_fail", 0),
        col("elapsed_seconds", 0.0),
        col("bronze_path", ""),
        col("silver_path", ""),
    )


def append_ingestion_stats(counts: DataFrame, root: str, run_ts: Column) -> None:
    ingestion_stats_rows(counts, run_ts).write.mode("append").parquet(root)


def refresh_analytics(gold: DataFrame, root: str, now: Column) -> dict[str, str]:
    """Rewrite the four analytic tables; returns where each one lies."""
    paths = {}
    for name, build in warehouse.ANALYTICS.items():
        paths[name] = f"{root}/{name}"
        build(gold).withColumn("updated_at", now).write.mode("overwrite").parquet(paths[name])
    return paths


def ingestion_events(counts: DataFrame, bronze_root: str, run_date: str, run_ts: Column) -> DataFrame:
    """One JSON message per source that landed articles, ready for a `value` sink."""
    path = F.concat(F.lit(f"{bronze_root}/source="), "source", F.lit(f"/date={run_date}"))
    message = F.struct(
        F.lit("articles_ingested").alias("event"),
        F.col("source"),
        F.col("articles_scraped").alias("count"),
        path.alias("bronze_path"),
        dates.iso(run_ts).alias("timestamp"),
    )
    return counts.where("articles_scraped > 0").select(F.to_json(message).alias("value"))


def emit_events(events: DataFrame, path: str | None = None, kafka: dict[str, str] | None = None) -> None:
    """To a topic when broker options are given, else to a folder of JSON lines."""
    if kafka:
        events.write.format("kafka").options(**kafka).save()
    else:
        events.write.mode("append").text(path)


def write_quality_report(report: DataFrame, path: str, run_date: str) -> None:
    """One small row per expected source, by run date."""
    report.withColumn("date", F.lit(run_date)).write.mode("overwrite").partitionBy("date").json(path)


def purge(spark: SparkSession, candidates: DataFrame, roots: dict[str, str], delete: bool = False) -> DataFrame:
    """Folders of partitions (layer, source, date) past their keeping time. They are only
    listed unless `delete` is set; the list is read in pieces, one row per folder."""
    base = F
    for layer, root in roots.items():
        base = base.when(F.col("layer") == layer, F.lit(root))
    source = F.when(F.col("source").isNotNull(), F.concat(F.lit("/source="), "source")).otherwise(F.lit(""))
    path = F.concat(base.otherwise(F.lit(None)), source, F.lit("/date="), F.col("date").cast("string"))
    listed = candidates.withColumn("path", path)
    if delete:
        for row in listed.where("path IS NOT NULL").select("path").distinct().toLocalIterator():
            remove(spark, row["path"])
    return listed


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
