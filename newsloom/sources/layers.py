"""Reading the Bronze, Silver and Gold layers. Layers are laid out as
`root/source=<s>/date=<d>/run=<r>/` (Gold without the source), so a source or date
filter reads only its folders."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom import rules

ARTICLE = T.StructType([T.StructField(c, T.StringType()) for c in rules.RAW_COLUMNS])
ENVELOPE = T.StructType(
    [
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("source", T.StringType()),
                    T.StructField("written_at", T.StringType()),
                    T.StructField("article_count", T.LongType()),
                    T.StructField("schema_version", T.StringType()),
                    T.StructField("part", T.LongType()),
                ]
            ),
        ),
        T.StructField("articles", T.ArrayType(ARTICLE)),
    ]
)
#: A Bronze line: an article, whose own source may differ from the folder's, and its place in the run.
LINE = T.StructType(
    [T.StructField("article_source" if c == "source" else c, T.StringType()) for c in rules.RAW_COLUMNS]
    + [T.StructField("pos", T.LongType())]
)
PARTITIONS = T.StructType([T.StructField(c, T.StringType()) for c in ("source", "date", "run")])


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def folders(spark: SparkSession, root: str, *levels: str, **wanted: str | None) -> list[dict]:
    """Partition folders of a layer, their names and writing times: from the listing
    alone, no file is opened. Names given in `wanted` must match."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path("/".join([root.rstrip("/"), *[f"{level}=*" for level in levels]]))
    if not exists(spark, root):
        return []
    found = []
    for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []:
        path = status.getPath().toString()
        parts = {k: unquote(v) for k, v in (p.split("=", 1) for p in path.split("/")[-len(levels):])}
        if all(v is None or parts[k] == v for k, v in wanted.items()):
            found.append({**parts, "path": path, "at": status.getModificationTime()})
    return found


def newest(runs: list[dict], *keys: str, by_time: bool = False) -> list[str]:
    """Paths of the newest run per key, by name or by writing time."""
    best: dict[tuple, dict] = {}
    for r in runs:
        key = tuple(r[k] for k in keys)
        rank = (r["at"], r["run"]) if by_time else (r["run"],)
        if key not in best or rank > best[key]["rank"]:
            best[key] = {**r, "rank": rank}
    return [r["path"] for r in best.values()]


def envelopes(spark: SparkSession, root: str) -> DataFrame:
    """One row per file that holds a single indented document, `{metadata, articles}`, as
    landed by other writers: partition, file name as run, and the article list."""
    schema = T.StructType([*ENVELOPE.fields, *PARTITIONS.fields])
    if not exists(spark, root):
        return spark.createDataFrame([], schema)
    files = spark.read.schema(schema).option("multiLine", "true").json(root).withColumn("file", F.col("_metadata.file_name"))
    return files.withColumn("run", F.coalesce("run", "file"))


def bronze_documents(spark: SparkSession, root: str, source: str | None, date: str | None, latest: bool) -> DataFrame:
    files = envelopes(spark, root)
    if source:
        files = files.where(F.col("source") == source)
    if date:
        files = files.where(F.col("date") == date)
    if latest:
        last = files.groupBy("source", "date").agg(F.max("run").alias("run"))
        files = files.join(last, ["source", "date", "run"], "left_semi")
    return files.select(
        F.col("source").alias("source_key"), "date", "run", F.posexplode("articles").alias("pos", "a")
    ).select("source_key", "date", "run", "a.*", "pos")


def bronze(
    spark: SparkSession,
    root: str,
    source: str | None = None,
    date: str | None = None,
    latest: bool = False,
    multi_line: bool = False,
    only: DataFrame | None = None,
    runs: list[tuple[str, str, str]] | None = None,
) -> DataFrame:
    """Articles of all runs, or of the newest run per source and date, which the folder
    names tell. `arrival` numbers the articles by date, run and place in the run, `landed` names
    the run. `only` (source, date) names the partitions to read; the others' folders are skipped, before any
    line is read; `runs` (source, date, run) names the runs. `multi_line` reads files that hold a single indented document each."""
    if multi_line:
        rows = bronze_documents(spark, root, source, date, latest)
    else:
        found = folders(spark, root, "source", "date", "run", source=source, date=date)
        if runs is not None:
            found = [r for r in found if (r["source"], r["date"], r["run"]) in set(runs)]
        # a whole layer is one path; a choice of runs is a list of them
        chosen = source or date or runs is not None
        paths = newest(found, "source", "date") if latest else [r["path"] for r in found] if chosen else [root]
        reader = spark.read.schema(T.StructType([*LINE.fields, *PARTITIONS.fields])).option("basePath", root)
        lines = reader.json(paths) if found else spark.createDataFrame([], T.StructType([*LINE.fields, *PARTITIONS.fields]))
        rows = lines.withColumnsRenamed({"source": "source_key", "article_source": "source"})
    if only is not None:
        named = only.select(F.col("source").alias("source_key"), "date")
        rows = rows.join(named, ["source_key", "date"], "left_semi")
    landed = F.concat_ws("/", "date", "run", "source_key")
    place = F.concat_ws("/", "date", "run", F.format_string("%020d", F.col("pos").cast("bigint")))
    return rows.select("source_key", "date", "run", *rules.RAW_COLUMNS, place.alias("arrival"), landed.alias("landed"))


def parquet_layer(spark: SparkSession, root: str, date: str | None = None, source: str | None = None) -> DataFrame:
    """A whole layer, or a date or source of it; only the footers of those are opened."""
    wanted = {k: v for k, v in (("source", source), ("date", date)) if v}
    levels = ["source", "date"] if exists_level(spark, root, "source") else ["date"]
    paths = [r["path"] for r in folders(spark, root, *levels, **wanted)] if wanted else [root]
    return read_parquet(spark, root, paths)


def exists_level(spark: SparkSession, root: str, level: str) -> bool:
    return bool(folders(spark, root, level))


def read_parquet(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    df = spark.read.option("mergeSchema", "true").option("basePath", root).parquet(*paths)
    return df.withColumn("date", F.col("date").cast("string"))


def silver_latest(spark: SparkSession, root: str, date: str | None = None, source: str | None = None) -> DataFrame:
    """Newest run of every source and date, sources unioned by column name; Silver columns
    that none of them has are NULL."""
    runs = newest(folders(spark, root, "source", "date", "run", source=source, date=date), "source", "date")
    df = read_parquet(spark, root, runs)
    return df.withColumns({c: F.lit(None).cast("string") for c in rules.SILVER_COLUMNS if c not in df.columns})


def gold_latest(spark: SparkSession, root: str, date: str | None = None, by_time: bool = False) -> DataFrame:
    """Newest run of a date; the latest date when none is given."""
    date = date or max(r["date"] for r in folders(spark, root, "date"))
    return read_parquet(spark, root, newest(folders(spark, root, "date", "run", date=date), "date", by_time=by_time))


def available_dates(spark: SparkSession, root: str) -> DataFrame:
    levels = ["source", "date"] if exists_level(spark, root, "source") else ["date"]
    dates = sorted({r["date"] for r in folders(spark, root, *levels)}, reverse=True)
    return spark.createDataFrame([(d,) for d in dates], "date string").orderBy(F.desc("date"))


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def partitions(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """(layer, source, date) of a stored layer, from its folders alone."""
    levels = ["date"] if layer == "gold" else ["source", "date"]
    rows = {(layer, r.get("source"), r["date"]) for r in folders(spark, root, *levels)}
    listed = spark.createDataFrame(sorted(rows, key=str), "layer string, source string, date string")
    return listed.withColumn("date", F.col("date").cast("date"))
