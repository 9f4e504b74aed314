from pyspark.sql import functions as F

from conftest import article, raw_frame, run_ts
from newsloom.operators import silver as silver_ops
from newsloom.operators import warehouse
from newsloom.sinks import layers as sink
from newsloom.sinks import table
from newsloom.streaming import ingest


def test_paths(spark):
    df = spark.createDataFrame(
        [("s3://bronze/bbc/2025-04-26/bbc_1.json",), ("data/bronze/bbc/2025-04-26/f.json",), ("/x/source=bbc/date=2025-04-26",), ("nowhere",)], "p string"
    )
    out = df.select(*[c.alias(n) for n, c in ingest.path_parts(F.col("p")).items()]).collect()
    assert [tuple(r) for r in out] == [("bbc", "2025-04-26")] * 3 + [("", "")]


def test_stream_equals_batch_and_survives_replay(spark, tmp_path):
    bronze, topic, table = (str(tmp_path / n) for n in ("bronze", "topic", "table"))
    rows = [article(article_id=str(i), source=f"s{i % 3}", arrival=f"{i:03d}", titre="ab" if i % 5 == 0 else "A fine title") for i in range(30)]
    raw = raw_frame(spark, rows)
    sink.write_bronze(raw, bronze, run_ts())
    counts = raw.groupBy("source").agg(F.count(F.lit(1)).alias("articles_scraped"))
    events = sink.ingestion_events(counts, bronze, "2025-04-26", run_ts())
    sink.emit_events(events.repartition(3), topic)
    sink.emit_events(events.limit(1).select(F.regexp_replace("value", "articles_ingested", "other").alias("value")), topic)
    apply = ingest.upsert_batch(spark, bronze, table, run_ts())
    for state in ("first", "replay"):  # a lost checkpoint reads every message again
        ingest.run(ingest.file_events(spark, topic, 1), apply, str(tmp_path / state)).awaitTermination()
        got = sink.read_gold_table(spark, table).drop("processed_at")
        want = warehouse.conform(silver_ops.to_silver(raw, run_ts())).drop("processed_at")
        assert got.count() == 30 and got.exceptAll(want).isEmpty()


def test_stored_table_does_not_depend_on_batch_borders(spark, tmp_path):
    bronze, topic = str(tmp_path / "bronze"), str(tmp_path / "topic")
    runs = [("2025-04-26 08:00:00", "first text"), ("2025-04-26 20:00:00", "second text"), ("2025-04-27 06:00:00", "third text")]
    for n, (when, title) in enumerate(runs):
        rows = [article(article_id="x", titre=title, source=f"s{n % 2}"), article(article_id="x", titre="copy in the same run", source=f"s{n % 2}"),
                article(article_id=f"only{n}", source=f"s{n % 2}")]
        run = F.lit(when).cast("timestamp")
        sink.write_bronze(raw_frame(spark, rows), bronze, run)
        counts = raw_frame(spark, rows).groupBy("source").agg(F.count(F.lit(1)).alias("articles_scraped"))
        sink.emit_events(sink.ingestion_events(counts, bronze, when[:10], run), topic)
    tables = []
    for per_batch in (1, 100):
        table = str(tmp_path / f"table{per_batch}")
        apply = ingest.upsert_batch(spark, bronze, table, run_ts())
        ingest.run(ingest.file_events(spark, topic, per_batch), apply, str(tmp_path / f"state{per_batch}")).awaitTermination()
        tables.append({r["article_id"]: r["titre_clean"] for r in sink.read_gold_table(spark, table).collect()})
    assert tables[0] == tables[1] and tables[0]["x"] == "third text" and len(tables[0]) == 4


def test_empty_batches_do_nothing(spark, tmp_path):
    apply = ingest.upsert_batch(spark, str(tmp_path / "none"), str(tmp_path / "table"), run_ts())
    apply(spark.createDataFrame([], ingest.EVENT), 0)
    assert not (tmp_path / "table").exists()


def test_each_run_is_cleaned_once(spark, tmp_path):
    """Messages of two sources and three runs, each several times and in several batches, over a restart of the stream."""
    bronze, topic, stored = (str(tmp_path / n) for n in ("bronze", "topic", "table"))
    whole = str(tmp_path / "whole")
    runs = ["2025-04-26 08:00:00", "2025-04-26 20:00:00", "2025-04-27 06:00:00"]
    apply = ingest.upsert_batch(spark, bronze, stored, run_ts())
    for n, when in enumerate(runs):
        rows = [article(article_id="x", titre=f"title of run {n}", source=f"s{k}") for k in range(2)] + [article(article_id=f"only{n}", source="s0")]
        run = F.lit(when).cast("timestamp")
        sink.write_bronze(raw_frame(spark, rows), bronze, run)
        counts = raw_frame(spark, rows).groupBy("source").agg(F.count(F.lit(1)).alias("articles_scraped"))
        for _ in range(3):
            sink.emit_events(sink.ingestion_events(counts, bronze, when[:10], run), topic)
        events = ingest.first_announcements(ingest.file_events(spark, topic, 2))
        ingest.run(events, apply, str(tmp_path / "state")).awaitTermination()  # goes on where it stopped
    cleaned = [x for r in table.commits(spark, stored).values() for x in r["runs"]]
    assert len(cleaned) == 6 and len(set(cleaned)) == 6
    ingest.run(ingest.file_events(spark, topic), ingest.upsert_batch(spark, bronze, whole, run_ts()), str(tmp_path / "other")).awaitTermination()
    a, b = (sink.read_gold_table(spark, t).drop("processed_at") for t in (stored, whole))
    assert a.count() == b.count() == 4 and a.exceptAll(b).isEmpty()


def test_messages_whose_time_names_no_run_stand_for_the_day(spark, tmp_path):
    bronze, stored = str(tmp_path / "bronze"), str(tmp_path / "table")
    rows = raw_frame(spark, [article(article_id="x", source="s0")])
    sink.write_bronze(rows, bronze, run_ts())
    named = spark.createDataFrame([("s0", "2025-04-26", None), ("s0", "2025-04-26", "r000001"), ("gone", "2025-04-26", "r1")], "source string, date string, run string")
    assert ingest.runs_of(spark, bronze, named) == [("s0", "2025-04-26", "r120000")]
    ingest.upsert_batch(spark, bronze, stored, run_ts())(named, 0)
    assert sink.read_gold_table(spark, stored).count() == 1
