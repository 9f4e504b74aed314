"""The stored table: writers side by side, reads that open what they need, analytics by deltas."""

import random

from pyspark.sql import functions as F

from newsloom import rules
from newsloom.operators import warehouse
from newsloom.sinks import table

SCHEMA = "article_id string, source string, pays string, topic_id int, topic_label string, quality_status string, date_publication string, content_length int, polymarket_prob double, contenu_clean string, arrival string"


def rows(spark, seed, n=60, ids=40, arrival="a"):
    rng = random.Random(seed)
    out = [
        (f"id{rng.randrange(ids)}", f"s{rng.randrange(4)}", rng.choice(["MA", "GB", None]), rng.choice([-1, 0, 1]), rng.choice(["0_a", "1_b", None]), rng.choice(["OK", "OK", "FAIL", None]),
         rng.choice(["2025-04-26T09:00:00", "2025-04-27T09:00:00", None]), rng.choice([None, 100, 250]), rng.choice([None, 0.25, 0.123456]), "text " * 5, f"{arrival}{i:03d}")
        for i in range(n)
    ]
    return spark.createDataFrame(out, SCHEMA)


def full(spark, root):
    gold = table.read(spark, root)
    return {name: build(gold) for name, build in warehouse.ANALYTICS.items()}


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    tidy = lambda df: sorted(map(repr, df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.select(columns).dtypes]).collect()))
    assert tidy(a) == tidy(b)


def test_deltas_equal_a_full_rebuild(spark, tmp_path):
    root = str(tmp_path / "t")
    for k, arrival in enumerate(["b", "c", "a", "c"]):  # the third loses to what is stored, the fourth is the second again
        table.upsert(spark, root, rows(spark, 1 if k == 3 else k, arrival=arrival), "arrival")
        for name, df in table.analytics(spark, root).items():
            same(df, full(spark, root)[name])
    table.compact(spark, root)
    table.upsert(spark, root, rows(spark, 9, ids=60, arrival="d"), "arrival")
    for name, df in table.analytics(spark, root).items():
        same(df, full(spark, root)[name])


def test_two_writers_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    table.upsert(spark, root, rows(spark, 0), "arrival")
    done = []

    def other():
        """Another writer commits after the first one has looked at the table."""
        if not done:
            done.append(True)
            done.append(table.upsert(spark, root, rows(spark, 1, ids=80, arrival="b"), "arrival"))

    number = table.upsert(spark, root, rows(spark, 2, ids=80, arrival="c"), "arrival", before_commit=other)
    assert (done[1], number) == (2, 3)
    stored = {r.article_id: r.landed[0] for r in table.newest(table._read(spark, root, "rows", table._schema(table.ROWS), table.live(table.commits(spark, root)))).collect()}
    expected = {r.article_id: letter for seed, letter, ids in ((0, "a", 40), (1, "b", 80), (2, "c", 80)) for r in rows(spark, seed, ids=ids).collect()}
    assert stored == expected
    for name, df in table.analytics(spark, root).items():
        same(df, full(spark, root)[name])


def test_uncommitted_rows_are_not_seen(spark, tmp_path):
    root = str(tmp_path / "t")

    class Stop(Exception):
        pass

    def stop():
        raise Stop

    table.upsert(spark, root, rows(spark, 0), "arrival")
    before = table.read(spark, root).count()
    try:
        table.upsert(spark, root, rows(spark, 1, ids=90, arrival="z"), "arrival", before_commit=stop)
    except Stop:
        pass
    assert table.read(spark, root).count() == before
    (tmp_path / "t" / "commits" / "000000002.json").write_text('{"version": "v')  # a record that is still being written
    assert table.read(spark, root).count() == before


def test_compaction_keeps_readers_and_newer_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    for k in range(3):
        table.upsert(spark, root, rows(spark, k, arrival="abc"[k]), "arrival")
    planned = table.read(spark, root)
    before = sorted(map(tuple, table.read(spark, root).drop("processed_at").collect()), key=repr)
    assert table.compact(spark, root) == 4 and table.compact(spark, root) is None
    assert sorted(map(tuple, planned.drop("processed_at").collect()), key=repr) == before  # the old folders are still there
    assert table.vacuum(spark, root) == []
    assert len(table.vacuum(spark, root, older_than_seconds=0)) == 3 and list(table.commits(spark, root)) == [4]
    assert sorted(map(tuple, table.read(spark, root).drop("processed_at").collect()), key=repr) == before
    for name, df in table.analytics(spark, root).items():
        same(df, full(spark, root)[name])


def test_reads_take_no_text_they_do_not_need(spark, tmp_path):
    root = str(tmp_path / "t")
    table.upsert(spark, root, rows(spark, 0), "arrival")
    table.upsert(spark, root, rows(spark, 1), "arrival")
    plan = warehouse.articles_by_day(table.read(spark, root))._jdf.queryExecution().executedPlan().toString()
    schemas = [line for line in plan.split("ReadSchema: ")[1:]]
    assert schemas and all("contenu_clean" not in s.split("\n")[0] and "titre_clean" not in s.split("\n")[0] for s in schemas)


def test_lookup_opens_only_files_that_may_hold_an_id(spark, tmp_path):
    root = str(tmp_path / "t")
    for k in range(4):  # four versions of other ids
        df = spark.createDataFrame([(f"id{k}-{i}", "s", "a") for i in range(5)], "article_id string, source string, arrival string")
        table.upsert(spark, root, df, "arrival")
    ids = spark.createDataFrame([("id2-3",), ("id2-4",), ("absent",), (None,)], "article_id string")
    versions = table.live(table.commits(spark, root))
    opened = table.files_for(spark, root, versions, ids)
    assert versions[2] in opened and len(opened) < 4
    assert sorted(r.article_id for r in table.lookup(spark, root, ids).collect()) == ["id2-3", "id2-4"]
    assert table.lookup(spark, str(tmp_path / "none"), ids).count() == 0


def test_empty_table(spark, tmp_path):
    root = str(tmp_path / "t")
    assert table.read(spark, root).columns == list(rules.GOLD_COLUMNS) and table.read(spark, root).count() == 0
    table.upsert(spark, root, rows(spark, 0, n=0), "arrival")
    assert table.read(spark, root).count() == 0 and all(df.count() == 0 for df in table.analytics(spark, root).values())


def test_small_tables_are_worked_out_by_many_tasks(spark, tmp_path, monkeypatch):
    """Deltas become one file, but the tasks that add them up stay as many as the shuffle has parts."""
    from pyspark.sql import DataFrame

    def by_task(spark, root, rows, version, records) -> DataFrame:
        @F.udf("string")
        def task(_):
            from pyspark import TaskContext

            return str(TaskContext.get().partitionId())

        zero = [F.lit(0).cast(t).alias(m) for m, t in table.MEASURES.items()]
        return spark.range(0, 8, 1, 8).select(F.lit("day").alias("tbl"), task("id").alias("key"), F.lit("s").alias("source"), *zero)

    monkeypatch.setattr(table, "delta_of", by_task)
    root = str(tmp_path / "t")
    table.upsert(spark, root, rows(spark, 1), "arrival")
    deltas = spark.read.parquet(f"{root}/deltas")
    assert deltas.select("key").distinct().count() == 8
    assert len(deltas.inputFiles()) == 1
