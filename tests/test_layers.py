import json

from pyspark.sql import functions as F

from conftest import LONG_EN, article, raw_frame, run_ts
from newsloom import rules
from newsloom.functions import text
from newsloom.operators import gold as gold_ops
from newsloom.operators import quality, serving, warehouse
from newsloom.operators import silver as silver_ops
from newsloom.sinks import layers as sink
from newsloom.sinks import table
from newsloom.sources import layers as source
from newsloom.sources import pages


def silver(spark, rows, **kw):
    return silver_ops.to_silver(raw_frame(spark, rows), run_ts(), **kw)


def flags(spark, **over):
    row = silver(spark, [article(**over)]).first()
    assert row["quality_status"] == ("FAIL" if row["quality_flags"] else "OK")
    return row["quality_flags"]


def test_good_article_passes(spark):
    assert flags(spark) == []


def test_every_flag(spark):
    assert "TITRE_VIDE_OU_TROP_COURT" in flags(spark, titre="ab")
    assert "TITRE_VIDE_OU_TROP_COURT" in flags(spark, titre=None)
    assert "CONTENU_TROP_COURT" in flags(spark, contenu="short")
    assert flags(spark, url="") == ["URL_MANQUANTE"]
    assert flags(spark, url=None) == ["URL_MANQUANTE"]
    assert flags(spark, url="not-a-url") == ["URL_INVALIDE"]
    assert flags(spark, date_publication=None) == ["DATE_MANQUANTE"]
    assert flags(spark, date_publication="someday") == ["DATE_MANQUANTE"]
    assert "LANGUE_ARABE_NON_SUPPORTEE" in flags(spark, titre="المغرب يعلن")
    assert flags(spark, contenu=LONG_EN + " " + LONG_EN) == ["LANGUE_INCOHERENTE"]
    assert flags(spark, contenu=LONG_EN[:150]) == []  # too short to judge


def test_flags_keep_their_order(spark):
    assert flags(spark, titre="", contenu="x", url="", date_publication=None) == list(rules.QUALITY_FLAGS[:4])


def test_first_duplicate_wins(spark):
    rows = [article(arrival="2", titre="Second title here"), article(arrival="1", titre="First title here")]
    out = silver(spark, rows).collect()
    assert [r["titre_clean"] for r in out] == ["First title here"]


def test_fields_are_normalised(spark):
    row = silver(spark, [article(source="  HESPRESS.COM  ", langue="  FR  ", pays="  ma  ")]).first()
    assert (row["source"], row["langue"], row["pays"]) == ("hespress.com", "fr", "MA")
    assert len(row["content_hash"]) == 32 and row["content_length"] == len(row["contenu_clean"])


def test_silver_columns_in_order(spark):
    assert silver(spark, [article()]).columns == rules.SILVER_COLUMNS


def test_article_defaults(spark):
    df = spark.createDataFrame([("t", "https://e.org/x", "e.org", "en")], "titre string, url string, source string, langue string")
    row = silver_ops.article_defaults(df, run_ts()).first()
    assert row["article_id"] == df.select(F.md5("url")).first()[0]
    assert (row["contenu"], row["auteur"], row["categorie"], row["pays"], row["raw_source"]) == ("", "", "", "unknown", "e.org")
    assert row["date_publication"] == "2025-04-26T12:00:00"


def gold_input(spark):
    rows = [
        ("a", "One title", "bbc.com", "OK", "politics_election", 0, 0.8),
        ("b", "Two title", "bbc.com", "OK", "politics_election", 0, 0.7),
        ("c", "Three title", "hespress.com", "FAIL", "economy_maroc", 1, 0.9),
        ("d", "Four title", "hespress.com", "OK", "economy_maroc", 1, None),
        ("e", "Five title", "hespress.com", "OK", None, -1, 0.5),
    ]
    df = spark.createDataFrame(
        rows, "article_id string, titre_clean string, source string, quality_status string, topic_label string, topic_id int, topic_prob double"
    )
    return df.withColumns(
        {"date_publication": run_ts(), "polymarket_prob": F.lit(0.5), "polymarket_question": F.lit("Q"), "arrival": F.col("article_id")}
    )


def test_gold_scores(spark):
    out = {r["article_id"]: r for r in gold_ops.to_gold(gold_input(spark), run_ts()).collect()}
    assert set(out) == {"a", "b", "d", "e"}
    assert out["a"]["topic_article_count"] == 2 and out["a"]["topic_coverage_score"] == 1.0
    assert out["d"]["topic_coverage_score"] == 0.5
    assert out["e"]["topic_article_count"] is None
    assert out["a"]["combined_signal"] == 0.4 and out["d"]["combined_signal"] == 0.25
    assert all(0 <= r["combined_signal"] <= 1 for r in out.values())


def test_topic_summary_order_and_shape(spark):
    df = gold_input(spark).withColumn("polymarket_question", F.when(F.col("article_id") > "a", F.col("article_id")).otherwise(""))
    out = gold_ops.topic_summary(df).collect()
    assert [(r["topic_label"], r["article_count"]) for r in out] == [("economy_maroc", 2), ("politics_election", 2)]
    assert out[1]["sources"] == {"bbc.com": 2} and out[1]["polymarket_question"] == "b"


def warehouse_rows(spark):
    rows = [
        ("1", "bbc.com", "en", "GB", "OK", 0, "t0", 0.65, 0.52),
        ("2", "bbc.com", "en", "GB", "OK", 0, "t0", 0.65, 0.455),
        ("3", "hespress.com", "fr", "MA", "OK", 1, "t1", 0.40, 0.36),
    ]
    df = spark.createDataFrame(
        rows,
        "article_id string, source string, langue string, pays string, quality_status string, topic_id int, topic_label string, polymarket_prob double, combined_signal double",
    )
    return df.withColumns({"date_publication": F.lit("2025-04-26T09:00:00"), "content_length": F.lit(100), "arrival": F.col("article_id")})


def test_upsert_twice_is_upsert_once(spark, tmp_path):
    root = str(tmp_path / "gold")
    for _ in range(2):
        sink.upsert_gold(spark, root, warehouse_rows(spark), "arrival")
    changed = warehouse_rows(spark).where("article_id = '2'").withColumn("source", F.lit("new.org"))
    sink.upsert_gold(spark, root, changed, "arrival")
    out = {r["article_id"]: r for r in sink.read_gold_table(spark, root).collect()}
    assert set(out) == {"1", "2", "3"} and out["2"]["source"] == "new.org"
    assert list(rules.GOLD_COLUMNS) == sink.read_gold_table(spark, root).columns
    assert out["1"]["url"] is None and str(out["1"]["date_publication"]) == "2025-04-26 09:00:00"


def test_last_row_of_a_batch_wins(spark, tmp_path):
    root = str(tmp_path / "gold")
    twice = warehouse_rows(spark).unionByName(
        warehouse_rows(spark).withColumns({"source": F.lit("late.org"), "arrival": F.concat(F.lit("z"), "arrival")})
    )
    sink.upsert_gold(spark, root, twice, "arrival")
    assert {r["source"] for r in sink.read_gold_table(spark, root).collect()} == {"late.org"}


def test_analytics(spark):
    gold = warehouse.conform(warehouse_rows(spark))
    day = warehouse.articles_by_day(gold).collect()
    assert [(r["article_count"], r["top_source"]) for r in day] == [(3, "bbc.com")]
    assert {r["pays"]: r["article_count"] for r in warehouse.articles_by_country(gold).collect()} == {"GB": 2, "MA": 1}
    assert {r["quality_ok_rate"] for r in warehouse.articles_by_source(gold).collect()} == {1.0}
    warehouse.register(spark, gold)
    assert spark.sql("SELECT sum(article_count) FROM v_daily_stats").first()[0] == 3


def test_top_source_counts_failed_rows_too(spark):
    rows = warehouse_rows(spark)
    failed = rows.where("article_id = '3'").withColumn("quality_status", F.lit("FAIL"))
    more = [failed.withColumn("article_id", F.lit(f"x{i}")) for i in range(3)]
    gold = warehouse.conform(source.union_by_name([rows, *more]))
    out = warehouse.articles_by_day(gold).first()
    assert out["article_count"] == 3 and out["top_source"] == "hespress.com"


def test_bronze_reads_single_document_files(spark, tmp_path):
    root = tmp_path / "bronze"
    folder = root / "source=bbc" / "date=2025-04-26"
    folder.mkdir(parents=True)
    for name, ids in [("bbc_2025-04-26_080000", ["1", "2"]), ("bbc_2025-04-26_200000", ["3"])]:
        payload = {"metadata": {"source": "bbc"}, "articles": [article(article_id=i) for i in ids]}
        (folder / f"{name}.json").write_text(json.dumps(payload, indent=2))
    everything = source.bronze(spark, str(root), "bbc", "2025-04-26", multi_line=True)
    assert [r["article_id"] for r in everything.orderBy("arrival").collect()] == ["1", "2", "3"]
    newest = source.bronze(spark, str(root), "bbc", "2025-04-26", latest=True, multi_line=True)
    assert [r["article_id"] for r in newest.collect()] == ["3"]
    assert source.bronze(spark, str(root), "nobody", multi_line=True).isEmpty()
    assert source.bronze(spark, str(tmp_path / "absent")).isEmpty()


def test_bronze_holds_one_article_per_line(spark, tmp_path):
    root = str(tmp_path / "bronze")
    rows = [article(article_id=str(i), source=f"s{i % 2}") for i in range(50)]
    sink.write_bronze(raw_frame(spark, rows), root, run_ts())
    sink.write_envelopes(raw_frame(spark, rows), root, run_ts())
    assert spark.read.text(root).count() == 50
    back = source.bronze(spark, root)
    assert back.select(*rules.RAW_COLUMNS).exceptAll(raw_frame(spark, rows).select(*rules.RAW_COLUMNS)).isEmpty() and back.count() == 50
    facts = {r["source"]: r["article_count"] for r in spark.read.json(f"{root}-envelopes").collect()}
    assert facts == {"s0": 25, "s1": 25}
    sink.write_bronze(raw_frame(spark, rows).limit(0), str(tmp_path / "none"), run_ts())
    assert source.bronze(spark, str(tmp_path / "none")).isEmpty()


def test_newest_run_is_found_without_reading(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for hour, ids in (("08", "ab"), ("20", "c")):
        sink.write_bronze(raw_frame(spark, [article(article_id=i) for i in ids]), root, F.lit(f"2025-04-26 {hour}:00:00").cast("timestamp"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        runs = source.folders(spark, root, "source", "date", "run")
        paths = source.newest(runs, "source", "date")
        assert not tracker.getJobIdsForGroup("listing")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(runs) == 2 and [p[-7:] for p in paths] == ["r200000"]
    assert [r["article_id"] for r in source.bronze(spark, root, latest=True).collect()] == ["c"]


def test_later_dates_arrive_later(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for when, ids in (("2025-04-26 20:00:00", "a"), ("2025-04-27 08:00:00", "b")):
        sink.write_bronze(raw_frame(spark, [article(article_id=i) for i in ids]), root, F.lit(when).cast("timestamp"))
    assert [r["article_id"] for r in source.bronze(spark, root).orderBy("arrival").collect()] == ["a", "b"]


def test_no_article_is_stored_twice(spark, tmp_path):
    root = str(tmp_path / "gold")
    rows = warehouse_rows(spark)
    same_order = rows.unionByName(rows.withColumn("source", F.lit("x"))).withColumn("arrival", F.lit(None).cast("string"))
    sink.upsert_gold(spark, root, same_order, "arrival")
    sink.upsert_gold(spark, root, rows.withColumn("arrival", F.lit("b")), "arrival")
    sink.upsert_gold(spark, root, rows.withColumns({"arrival": F.lit("a"), "source": F.lit("older.org")}), "arrival")
    for _ in range(2):
        out = sink.read_gold_table(spark, root).collect()
        assert sorted(r["article_id"] for r in out) == ["1", "2", "3"] and {r["source"] for r in out} == {"bbc.com", "hespress.com"}
        sink.compact_gold(spark, root)
        assert len(table.live(table.commits(spark, root))) == 1


def test_gate_levels(spark):
    rows = [("good", "OK")] * 6 + [("few", "OK")] * 2 + [("poor", "OK")] * 3 + [("poor", "FAIL")] * 3 + [("both", "FAIL")]
    df = spark.createDataFrame(rows, "source string, quality_status string")
    expected = spark.createDataFrame([(x,) for x in ("good", "few", "poor", "both", "gone")], "source string")
    out = {r["source"]: r for r in quality.gate(df, expected).collect()}
    assert {k: v["status"] for k, v in out.items()} == {
        "good": "OK", "few": "LOW_VOLUME", "poor": "LOW_QUALITY", "both": "LOW_QUALITY", "gone": "MISSING",
    }
    assert len(out["both"]["alerts"]) == 2 and out["good"]["alerts"] == []
    assert out["poor"]["alerts"] == ["[ALERTE] 'poor' : taux qualité 50.0% < 75%"]


def test_funnel_and_kpis_survive_empty_layers(spark):
    one = spark.createDataFrame([("OK",)], "quality_status string")
    none = one.limit(0)
    assert [r["n"] for r in quality.funnel(none, one, one).orderBy("step").collect()] == [1, 1, 1]
    row = quality.kpis(none, none).first()
    assert (row["ok_pct"], row["rejected_pct"], row["retention_pct"]) == (0.0, 0.0, None)


def test_api_rows(spark):
    df = gold_input(spark).withColumns({"polymarket_question": F.lit("Will title reform pass?"), "polymarket_prob": F.lit(0.999)})
    row = serving.api_articles(df, sources=["bbc.com"]).orderBy("id").first()
    assert row["poly_prob"] == 0.999 and row["display_prob"] < 0.9 and row["date"] == "2025-04-26T12:00:00"
    blank = serving.api_articles(df.withColumn("polymarket_question", F.lit("zzz"))).first()
    assert blank["poly_q"] is None and blank["poly_prob"] is None


def test_evaluate_once_keeps_rows_and_order(spark):
    df = spark.range(10).withColumn("x", F.md5(F.col("id").cast("string")))
    out = text.evaluate_once(df, ["x"])
    assert out.columns == df.columns and out.exceptAll(df).isEmpty() and out.count() == 10


BODY = "word " * 40


def page(spark, html, key):
    return pages.main_text(spark.createDataFrame([(html,)], "html string"), key).first()["full_text"]


def test_page_text_follows_nested_divs(spark):
    inner = f"<div class='entry-content wide'><div>first</div><script>x()</script><p>{BODY}</p></div><div>after</div>"
    out = page(spark, f"<html><body><nav>menu</nav>{inner}</body></html>", "lakom")
    assert out.startswith("first") and "word" in out and "after" not in out and "x()" not in out


def test_page_text_selector_order_and_fallback(spark):
    short = "<div class='entry-content'>tiny</div>"
    out = page(spark, f"<body>{short}<article><figure>pic</figure>{BODY}</article></body>", "lakom")
    assert out == BODY.strip()
    assert page(spark, f"<body>{short} plain</body>", "lakom") == "tiny\n plain"
    assert page(spark, f"<body>{short} plain</body>", "cnn") is None


def test_page_text_blocks(spark):
    html = '<div data-component="text-block"><p>One <b>bold</b></p></div><div data-component="text-block"><p>Two</p></div>'
    assert page(spark, html, "bbc") == "One bold\nTwo"


def test_old_partitions_are_listed_and_only_then_deleted(spark, tmp_path):
    root = str(tmp_path / "silver")
    df = spark.createDataFrame([("1", "bbc", "old"), ("2", "cnn", "old")], "article_id string, source string, titre string")
    sink.write_silver(df, root, F.lit("2024-01-01 08:00:00").cast("timestamp"))
    sink.write_silver(df, root, run_ts())
    today = F.lit("2025-04-27").cast("date")
    old = quality.retention_candidates(source.partitions(spark, root, "silver"), today)
    assert sorted(r["source"] for r in sink.purge(spark, old, {"silver": root}).collect()) == ["bbc", "cnn"]
    assert source.parquet_layer(spark, root).count() == 4
    sink.purge(spark, old, {"silver": root}, delete=True)
    spark.catalog.clearCache()
    assert {r["date"] for r in source.available_dates(spark, root).collect()} == {"2025-04-26"}


def test_a_large_source_is_split_when_written(spark, tmp_path):
    root = str(tmp_path / "silver")
    df = spark.range(20_000).select(
        F.col("id").cast("string").alias("article_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 10).cast("string"))).alias("source"),
        F.concat(*[F.md5((F.col("id") * 20 + i).cast("string")) for i in range(20)]).alias("titre"),  # does not compress
    ).repartition(16)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        sink.write_silver(df, root, run_ts())
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {r["source"]: r["n"] for r in spark.read.parquet(root).groupBy("source").agg(F.countDistinct("_metadata.file_name").alias("n")).collect()}
    assert files["hot"] > 1 and max(n for s, n in files.items() if s != "hot") < 16
    assert spark.read.parquet(root).count() == 20_000


def test_executors_need_not_have_the_package(tmp_path):
    """The page cutter runs in workers that cannot import newsloom."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from newsloom.session import build_session
from newsloom.sources import pages
spark = build_session(cores=1)
html = "<div class='entry-content'><div>a</div>" + "word " * 40 + "</div>"
df = pages.main_text(spark.createDataFrame([(html,)], "html string"), "lakom")
print("GOT", df.first()["full_text"][:6].split())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "GOT ['a', 'word']" in done.stdout, done.stderr[-2000:]


def test_silver_is_worked_out_once_for_both_copies(spark, tmp_path):
    """The JSON copy is made of the files just written: a value that is another one each time is the same in both."""
    root, copy = str(tmp_path / "silver"), str(tmp_path / "copy")
    df = spark.createDataFrame([("1", "a b{c}", None), ("2", None, "2025-04-26 10:00:00"), ("3", "x", None)], "article_id string, source string, d string")
    df = df.select("article_id", "source", F.expr("uuid()").alias("titre"), F.col("d").cast("timestamp").alias("date_publication"))
    keys = ["article_id", "titre", "source", "date", "run"]
    for n in (3, 6):  # a run that is written again is appended to both
        sink.write_silver(df, root, run_ts(), copy)
        stored = spark.read.parquet(root).select(*keys, F.col("date_publication").cast("string").alias("d"))
        json_rows = spark.read.schema("article_id string, titre string, source string, date date, run string, date_publication string").json(copy).select(*keys, F.col("date_publication").alias("d"))
        assert stored.count() == n and sorted(map(str, stored.collect())) == sorted(map(str, json_rows.collect()))
    sink.write_silver(df.limit(0), str(tmp_path / "none"), run_ts(), str(tmp_path / "none-copy"))
    assert spark.read.schema("article_id string").json(str(tmp_path / "none-copy")).count() == 0


def test_daily_job_keeps_no_stage_and_stores_texts_compressed(spark, tmp_path):
    from newsloom.plans import batch

    rows = [article(article_id=str(i), url=f"https://news.example.org/{i}", langue="en", contenu=f"{i} {LONG_EN} " * 30) for i in range(60)]
    roots = batch.Roots(str(tmp_path / "lake"))
    batch.ingest(spark, raw_frame(spark, rows), roots, run_ts(), "2025-04-26")
    gold = batch.build(spark, roots, None, None, run_ts(), "2025-04-26", model="skip")
    texts = sum(len(r["contenu"]) for r in rows)
    size = lambda layer: sum(f.stat().st_size for f in (tmp_path / "lake" / layer).rglob("*") if f.is_file())
    assert gold.count() == 60 and source.bronze(spark, roots.bronze).count() == 60
    assert size("bronze") < texts / 3 and size("silver_json") < texts / 3 and size("topics_stage") == 0
    assert {f.name.split(".", 1)[1] for layer in ("silver", "gold") for f in (tmp_path / "lake" / layer).rglob("part-*")} == {"c000.zstd.parquet"}
