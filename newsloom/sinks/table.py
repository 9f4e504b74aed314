"""The stored article table: versions of rows, commit records, and what the analytic tables add up.

    <root>/rows/version=<v>/     an upsert's rows, one per article id, by slot (a hash of the id)
    <root>/files/version=<v>/    which file of the version holds which slots
    <root>/deltas/version=<v>/   what the upsert changes in the analytic tables, as signed sums
    <root>/commits/<number>.json a record makes a version visible; those it replaces are no longer read

A version's folder has a name of its own, so writers never touch each other's files. A record is created only if its number
is free: of two writers that saw the same table one gets the number, and the other works out its deltas anew on the newer table. Readers take committed
versions only, each id's row of the largest `landed` (of equal ones the later version's). The store must refuse to create an existing file (HDFS and local
folders do, object stores with conditional writes)."""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from newsloom import rules
from newsloom.operators import warehouse
from newsloom.operators.skew import keep_one
from newsloom.sources.layers import exists

SLOTS = 4096
ROWS = {**rules.GOLD_COLUMNS, "landed": "string", "slot": "int", "version": "string"}


def slot_of(article_id: Column) -> Column:
    return F.pmod(F.xxhash64(article_id), F.lit(SLOTS)).cast("int")


# ------------------------------------------------------------------- commits
def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def commits(spark: SparkSession, root: str) -> dict[int, dict]:
    """All records by number. One that is still being written does not count."""
    if not exists(spark, f"{root}/commits"):
        return {}
    folder, fs = _path(spark, f"{root}/commits")
    found = {}
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.endswith(".json") and not name.startswith((".", "_")):
            stream = fs.open(status.getPath())
            try:
                found[int(name[:-5])] = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            except json.JSONDecodeError:
                pass
            finally:
                stream.close()
    return dict(sorted(found.items()))


def commit(spark: SparkSession, root: str, number: int, record: dict) -> bool:
    """Create a record; False if its number is taken."""
    path, fs = _path(spark, f"{root}/commits/{number:09d}.json")
    try:
        out = fs.create(path, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(json.dumps(record).encode()))
    finally:
        out.close()
    return True


def live(records: dict[int, dict]) -> list[str]:
    """Versions that readers take."""
    replaced = {v for r in records.values() for v in r["replaces"]}
    return [r["version"] for r in records.values() if r["version"] not in replaced]


def _taken(records: dict[int, dict]) -> int:
    return max(records, default=0)


# ------------------------------------------------------------------- reading
def _read(spark: SparkSession, root: str, what: str, schema: str, versions: list[str], names: dict[str, list[str]] | None = None) -> DataFrame:
    base = f"{root}/{what}"
    paths = [f"{base}/version={v}{'/' + n if n else ''}" for v in versions for n in (names[v] if names else [""])]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def _schema(types: dict[str, str]) -> str:
    return ", ".join(f"{c} {t}" for c, t in types.items())


def newest(versions: DataFrame) -> DataFrame:
    """Each id's newest row. A version holds an id once, so the order is total and no other column is read for it."""
    order = F.struct(F.coalesce("landed", F.lit("")), "version")
    ranked = versions.withColumn("_rn", F.row_number().over(W.partitionBy("article_id").orderBy(order.desc())))
    return ranked.where("_rn = 1").drop("_rn")


def read(spark: SparkSession, root: str) -> DataFrame:
    """Each article once, as its newest version has it."""
    return newest(_read(spark, root, "rows", _schema(ROWS), live(commits(spark, root)))).drop("landed", "version", "slot")


def files_for(spark: SparkSession, root: str, versions: list[str], ids: DataFrame) -> dict[str, list[str]]:
    """Files that may hold one of the ids, by version: those with a slot that the ids fall into, of SLOTS at most."""
    slots = ids.select(slot_of(F.col("article_id")).alias("slot")).distinct()
    listed = _read(spark, root, "files", "file string, slot int, version string", versions)
    out: dict[str, list[str]] = {}
    for r in listed.join(F.broadcast(slots), "slot", "left_semi").select("version", "file").distinct().collect():
        out.setdefault(r.version, []).append(r.file)
    return out


def lookup(spark: SparkSession, root: str, ids: DataFrame, records: dict[int, dict] | None = None) -> DataFrame:
    """The newest rows of the given ids (column article_id); only files that may hold one are opened. Has `landed` and `version`."""
    named = ids.select("article_id").where("article_id IS NOT NULL").distinct()
    files = files_for(spark, root, live(commits(spark, root) if records is None else records), named)
    return newest(_read(spark, root, "rows", _schema(ROWS), list(files), files).join(named, "article_id", "left_semi"))


# -------------------------------------------------------------------- deltas
MEASURES = {
    "n": "long", "ok": "long", "ok_length": "long", "ok_lengths": "long", "length": "long", "lengths": "long", "topical": "long",
    "prob": "decimal(38,6)", "probs": "long",
}
DELTA = {"tbl": "string", "key": "string", "source": "string", **MEASURES}


def partial_sums(rows: DataFrame, sign: int) -> DataFrame:
    """What rows add to each analytic table, per key and source."""
    ok = F.coalesce(F.col("quality_status") == "OK", F.lit(False))
    topical = ok & F.coalesce(F.col("topic_id") >= 0, F.lit(False))
    known, length = F.col("content_length").isNotNull(), F.coalesce("content_length", F.lit(0))
    prob = F.col("polymarket_prob")
    measured = {
        "n": F.lit(1), "ok": ok.cast("long"), "ok_length": F.when(ok, length).otherwise(0), "ok_lengths": (ok & known).cast("long"),
        "length": length, "lengths": known.cast("long"), "topical": topical.cast("long"),
        "prob": F.when(topical & prob.isNotNull(), prob.cast("decimal(28,6)")).otherwise(0), "probs": (topical & prob.isNotNull()).cast("long"),
    }
    keys = {"day": warehouse.published_day().cast("string"), "theme": F.col("topic_label"), "country": F.col("pays"), "source": F.col("source")}
    tables = F.array(*[F.struct(F.lit(t).alias("tbl"), k.alias("key")) for t, k in keys.items()])
    each = rows.select("source", F.explode(tables).alias("t"), *[c.cast(MEASURES[m]).alias(m) for m, c in measured.items()])
    sums = [(F.sum(m) if sign > 0 else -F.sum(m)).cast(t).alias(m) for m, t in MEASURES.items()]
    return each.groupBy("t.tbl", "t.key", "source").agg(*sums)


def added_up(deltas: DataFrame) -> DataFrame:
    sums = deltas.groupBy("tbl", "key", "source").agg(*[F.sum(m).cast(t).alias(m) for m, t in MEASURES.items()])
    return sums.where(" OR ".join(f"{m} <> 0" for m in MEASURES))  # n alone stays when a row changes within its keys


def delta_of(spark: SparkSession, root: str, rows: DataFrame, version: str, records: dict[int, dict]) -> DataFrame:
    """Signed sums of what a version changes: rows that lose to it count negative, its own that win positive."""
    needed = ["article_id", "source", "pays", "topic_id", "topic_label", "quality_status", "date_publication", "content_length", "polymarket_prob", "landed", "version"]
    mine = rows.withColumn("version", F.lit(version)).select(needed)
    before = lookup(spark, root, mine, records).select(needed)
    after = newest(before.union(mine))
    return added_up(partial_sums(before, -1).unionByName(partial_sums(after, 1)))


def analytics(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four analytic tables, from the deltas alone."""
    state = added_up(_read(spark, root, "deltas", _schema({**DELTA, "version": "string"}), live(commits(spark, root))))
    total = lambda m: F.sum(m)
    mean = lambda top, n: F.try_divide(total(top).cast("double"), total(n).cast("double"))
    top = F.min_by("source", F.when(F.col("n") > 0, F.struct(-F.col("n"), F.col("source"))))

    def keyed(table: str, name: str, *columns: Column, kind: str = "string") -> DataFrame:
        own = state.where(F.col("tbl") == table).groupBy(F.col("key").cast(kind).alias(name)).agg(*columns, top.alias("top_source"))
        return own.where("article_count > 0").withColumn("top_source", F.when(F.col(name).isNotNull(), F.col("top_source")))

    by_source = state.where("tbl = 'source'").groupBy("source").agg(
        total("n").alias("article_count"), F.round(total("ok") / total("n"), 4).alias("quality_ok_rate"), mean("length", "lengths").alias("avg_content_length"))
    return {
        "analytics_articles_by_day": keyed("day", "pub_date", total("ok").alias("article_count"), mean("ok_length", "ok_lengths").alias("avg_content_length"), kind="date"),
        "analytics_articles_by_theme": keyed("theme", "topic_label", total("topical").alias("article_count"), mean("prob", "probs").alias("avg_polymarket_prob")),
        "analytics_articles_by_country": keyed("country", "pays", total("ok").alias("article_count")),
        "analytics_articles_by_source": by_source.where("article_count > 0"),
    }


def refresh(spark: SparkSession, root: str, analytics_root: str, now: Column) -> dict[str, str]:
    """Rewrite the analytic tables from the deltas; returns where each one lies."""
    paths = {}
    for name, df in analytics(spark, root).items():
        paths[name] = f"{analytics_root}/{name}"
        df.withColumn("updated_at", now).repartition(1).write.mode("overwrite").parquet(paths[name])
    return paths


# ------------------------------------------------------------------- writing
def _new_version() -> str:
    return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _write_rows(spark: SparkSession, root: str, rows: DataFrame, version: str) -> DataFrame:
    """Rows by slot, and which file holds which slots. Returns them as stored."""
    folder = f"{root}/rows/version={version}"
    rows.hint("rebalance", "slot").sortWithinPartitions("slot", "article_id").write.mode("errorifexists").option("compression", "zstd").parquet(folder)
    stored = spark.read.schema(_schema({c: t for c, t in ROWS.items() if c != "version"})).parquet(folder)
    listed = stored.select(F.col("_metadata.file_name").alias("file"), "slot").distinct()
    # small tables are one file; a shuffle to it leaves what they are worked out from in tasks of its own
    listed.repartition(1).write.mode("errorifexists").parquet(f"{root}/files/version={version}")
    return stored


def _commit_with_deltas(spark: SparkSession, root: str, rows: DataFrame, version: str, record: dict, before_commit=None) -> int:
    while True:
        records = commits(spark, root)
        folder = f"{root}/deltas/version={version}"
        delta_of(spark, root, rows, version, records).repartition(1).write.mode("overwrite").parquet(folder)
        if before_commit:
            before_commit()
        if commit(spark, root, _taken(records) + 1, record):
            return _taken(records) + 1


def upsert(spark: SparkSession, root: str, batch: DataFrame, order: str, runs: tuple[str, ...] = (), before_commit=None) -> int:
    """Insert or replace by article id; returns the commit's number. A batch costs what it holds: its rows are appended, and only files that may
    hold its ids are read, for the deltas. The row of the largest `order` (as text) of each id counts, wherever batches were cut, and
    a batch that is applied again changes nothing. `runs` are noted in the record. `before_commit` is called before each try (for tests)."""
    one = keep_one(batch.withColumn("landed", F.col(order).cast("string")), "article_id", "landed", last=True)
    version = _new_version()
    rows = _write_rows(spark, root, warehouse.conform(one, ("landed",)).withColumn("slot", slot_of(F.col("article_id"))), version)
    return _commit_with_deltas(spark, root, rows, version, {"version": version, "replaces": [], "runs": list(runs)}, before_commit)


def compact(spark: SparkSession, root: str) -> int | None:
    """Fold all versions into one. The old folders stay for readers that have planned on them, see `vacuum`. Versions
    committed meanwhile are not folded."""
    records = commits(spark, root)
    old = live(records)
    if len(old) < 2:
        return None
    version = _new_version()
    _write_rows(spark, root, newest(_read(spark, root, "rows", _schema(ROWS), old)).drop("version"), version)
    sums = added_up(_read(spark, root, "deltas", _schema({**DELTA, "version": "string"}), old))
    sums.repartition(1).write.mode("errorifexists").parquet(f"{root}/deltas/version={version}")
    gone = {v for r in records.values() for v in r["replaces"]}
    number, record = _taken(records), {"version": version, "replaces": sorted({*old, *gone}), "runs": sorted({x for r in records.values() for x in r["runs"]})}
    while True:
        # another compaction of the same versions that came first makes this one void
        newer = {n: r for n, r in commits(spark, root).items() if n > number}
        if any(set(r["replaces"]) & set(old) for r in newer.values()):
            return None
        taken = max(newer, default=number)
        if commit(spark, root, taken + 1, record):
            return taken + 1


def vacuum(spark: SparkSession, root: str, older_than_seconds: float = 86_400) -> list[str]:
    """Delete the folders and records of versions that were replaced longer ago; returns the versions. A compaction's record carries what
    the deleted ones told."""
    records = commits(spark, root)
    gone = []
    for number, record in records.items():
        path, fs = _path(spark, f"{root}/commits/{number:09d}.json")
        if record["replaces"] and time.time() * 1000 - fs.getFileStatus(path).getModificationTime() >= older_than_seconds * 1000:
            gone += [(n, r["version"]) for n, r in records.items() if r["version"] in record["replaces"]]
    for number, version in sorted(set(gone)):
        for what in ("rows", "files", "deltas"):
            path, fs = _path(spark, f"{root}/{what}/version={version}")
            fs.delete(path, True)
        path, fs = _path(spark, f"{root}/commits/{number:09d}.json")
        fs.delete(path, False)
    return [v for _, v in sorted(set(gone))]
