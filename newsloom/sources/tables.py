"""The supplied parquet tables seen as news data: articles, pages, market events,
ingestion events and log lines. Pure projections: every row and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import SCAN_PARTITIONS

# Topic labels the demonstration topics carry, by topic number.
TOPIC_LABELS = [
    "0_biden_trump_election", "1_gaza_israel_guerre", "2_maroc_sahara_hespress",
    "3_inflation_fed_bank", "4_climat_energy_weather", "5_the_nation_reser", "6_football_world_cup",
]
COUNTRY_BY_LANG = {"en": "GB", "fr": "MA", "de": "DE", "es": "ES"}
EVENT_SUBJECTS = ["Iran", "Gaza and Israel", "Trump", "China", "Climate", "World news"]
FIRST_SENTENCE = "^[^.!?\\n]*"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal texts out where the session asks for it (see `SCAN_PARTITIONS`), whatever their size."""
    parts = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(parts)) if parts else df


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(table(spark, sf_dir, name))


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` as landed articles; `arrival` is their unique landing order."""
    doc = F.col("doc_id")
    country = F.lit(None).cast("string")
    for lang, code in COUNTRY_BY_LANG.items():
        country = F.when(F.col("lang") == lang, F.lit(code.lower())).otherwise(country)
    url = F.concat(F.lit("https://news.example.org/"), "source", F.lit("/"), doc.cast("string"))
    day = F.lpad((doc % 30 + 1).cast("string"), 2, "0")
    hour = F.lpad((doc % 24).cast("string"), 2, "0")
    return texts(spark, sf_dir, "documents").select(
        F.md5(url).alias("article_id"),
        F.regexp_extract("text", FIRST_SENTENCE, 0).alias("titre"),
        url.alias("url"),
        F.concat(F.lit(" "), F.upper("source")).alias("source"),
        F.upper("lang").alias("langue"),
        F.concat(F.lit("2024-01-"), day, F.lit("T"), hour, F.lit(":00:00")).alias("date_publication"),
        F.col("text").alias("contenu"),
        F.concat(country, F.lit(" ")).alias("pays"),
        F.concat("source", F.lit("_rss")).alias("raw_source"),
        F.when(doc % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(" author "), (doc % 7).cast("string"))).alias("auteur"),
        F.when(doc % 3 == 0, F.lit("")).otherwise(F.lit("news")).alias("categorie"),
        F.lit("2024-02-01T00:00:00").alias("ingested_at"),
        doc.alias("arrival"),
    )


def demo_topics(silver: DataFrame, order: str = "arrival") -> DataFrame:
    """Topic columns by arithmetic on the arrival number: one topic holds about a
    third of the rows, and one row in nine has no topic."""
    spot = F.col(order) % 9
    topic = F.when(spot < 3, F.lit(0)).when(spot == 8, F.lit(-1)).otherwise(spot - 2).cast("int")
    label = F.get(F.array(*[F.lit(x) for x in TOPIC_LABELS]), topic)
    return (
        silver.withColumn("topic_id", topic)
        .withColumn("topic_label", F.when(topic < 0, F.lit("hors-sujet")).otherwise(label))
        .withColumn("topic_prob", ((F.col(order) % 80 + 20) / 100.0))
    )


def market_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`benchmark` as prediction-market events with nested markets."""
    i = F.col("item_id")
    cents = (i * 37) % 101

    def prices(c):
        return F.format_string("['%.2f', '%.2f']", c / 100.0, (100 - c) / 100.0)

    subject = F.get(F.array(*[F.lit(x) for x in EVENT_SUBJECTS]), (i % 6).cast("int"))
    market = F.transform(
        F.sequence(F.lit(1).cast("bigint"), F.lit(3).cast("bigint")),
        lambda n: F.struct(
            n.alias("market_no"),
            F.concat(F.lit("Market "), i.cast("string"), F.lit("/"), n.cast("string")).alias("question"),
            F.when(n == 2, F.lit(None).cast("double")).otherwise(((i * 13 + n * 7) % 50) * 10.0).alias("volume"),
            prices((cents + n * 11) % 101).alias("outcomePrices"),
            F.concat(F.lit("/market/"), i.cast("string"), F.lit("-"), n.cast("string")).alias("url"),
            ((i + n) % 4 != 0).alias("active"),
            ((i + n) % 7 == 0).alias("closed"),
        ),
    )
    return table(spark, sf_dir, "benchmark").select(
        i.alias("event_pos"),
        F.concat(subject, F.lit(": "), F.col("text")).alias("title"),
        F.when(i % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("event-"), i.cast("string"))).alias("slug"),
        F.concat(F.lit("tag-"), i.cast("string")).alias("ticker"),
        ((i * 29) % 997).cast("double").alias("volume"),
        F.concat(F.lit("/event/"), i.cast("string")).alias("url"),
        F.when(i % 10 == 3, F.lit("not a list")).otherwise(prices(cents)).alias("outcomePrices"),
        (i % 11 != 10).alias("active"),
        (i % 13 == 12).alias("closed"),
        F.when(i % 4 == 0, F.slice(market, 1, 0)).otherwise(market).alias("markets"),
    )


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "pages")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`conversations` as numbered log lines; turns open with a logger prefix."""
    turn = F.col("turn")
    prefix = (
        F.when(turn == 0, F.lit(">>> PHASE 1+2 Scraping: "))
        .when(turn == 1, F.lit("[INFO] Silver: "))
        .when(turn == 2, F.lit("[WARN] topic model: "))
        .when(turn == 3, F.lit("[OK] Gold written: "))
        .when(turn == 4, F.lit("ERROR Warehouse: "))
        .otherwise(F.lit(""))
    )
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("run_id"), turn.alias("idx"), F.concat(prefix, F.col("text")).alias("line")
    )
