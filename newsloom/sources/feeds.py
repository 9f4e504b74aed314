"""Landed feeds to raw articles: RSS items (XML) and news-API responses (JSON)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom import rules
from newsloom.functions import dates, text
from newsloom.operators.silver import article_defaults
from newsloom.operators.skew import keep_one, top_n_per_key

_s = T.StringType()
ITEM = T.StructType(
    [
        T.StructField("title", _s),
        T.StructField("link", _s),
        T.StructField("pubDate", _s),
        T.StructField("updated", _s),
        T.StructField("description", _s),
        T.StructField("author", _s),
        T.StructField("category", T.ArrayType(_s)),
    ]
)
API_ARTICLE = T.StructType(
    [T.StructField(c, _s) for c in ("title", "url", "seendate", "domain", "language", "sourcecountry")]
)


def rss_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of landed feed files, one row each. The schema is given: inference would
    read titles as dates."""
    return spark.read.schema(ITEM).format("xml").option("rowTag", "item").load(path)


def feed_entries(items: DataFrame, source_key: Column, feed: Column, feed_pos: Column) -> DataFrame:
    """Landed items as `feed_articles` wants them: place in the feed as they were read, the
    update time where no publication time is given, the description as summary."""
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    return items.withColumn("pos", F.monotonically_increasing_id()).select(
        source_key.alias("source_key"),
        feed.alias("feed"),
        feed_pos.alias("feed_pos"),
        "pos",
        "title",
        "link",
        F.coalesce(given("pubDate"), given("updated")).alias("published"),
        F.col("description").alias("summary"),
        F.lit(None).cast("string").alias("full_text"),
        "author",
        F.coalesce("category", F.array().cast("array<string>")).alias("tags"),
    )


def api_table(spark: SparkSession, path: str) -> DataFrame:
    """All API fields of landed responses, unmapped."""
    response = T.StructType([T.StructField("articles", T.ArrayType(API_ARTICLE))])
    return spark.read.schema(response).json(path).select(F.inline("articles"))


def api_articles(table: DataFrame, now: Column) -> DataFrame:
    """API rows to raw articles: the title is the only content they carry."""
    raw = table.select(
        F.coalesce("title", F.lit("")).alias("titre"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("domain", F.lit("unknown")).alias("source"),
        F.coalesce("language", F.lit("unknown")).alias("langue"),
        dates.compact_to_iso(F.col("seendate"), now).alias("date_publication"),
        F.coalesce("title", F.lit("")).alias("contenu"),
        F.coalesce("sourcecountry", F.lit("unknown")).alias("pays"),
        F.lit("gdelt").alias("raw_source"),
        F.lit("").alias("auteur"),
        F.lit("").alias("categorie"),
    )
    return article_defaults(raw, now).select(*rules.RAW_COLUMNS)


def first_entries(items: DataFrame, max_per_feed: int | None) -> DataFrame:
    """The first entries of every feed; cut before links are compared. None keeps all."""
    if max_per_feed is None:
        return items
    return top_n_per_key(items, ["source_key", "feed"], [F.col("pos")], max_per_feed, "entry_no").drop("entry_no")


def first_feed_wins(items: DataFrame) -> DataFrame:
    """Items without a link go; a link seen in several feeds of a source stays with
    the first feed (and place) that listed it."""
    linked = items.where(F.coalesce("link", F.lit("")) != "")
    place = F.concat(F.format_string("%06d", "feed_pos"), F.lit("/"), F.format_string("%012d", "pos"))
    once = linked.withColumns({"_place": place, "_once": F.concat_ws("\n", "source_key", "link")})
    return keep_one(once, "_once", "_place").drop("_place", "_once")


def is_arabic_title(title: Column, source_key: Column) -> Column:
    """Moroccan feeds mix languages; only French titles are kept."""
    return source_key.isin(list(rules.MOROCCAN_SOURCES)) & text.has_arabic(title)


def feed_articles(items: DataFrame, catalogue: DataFrame, now: Column, max_per_feed: int | None = None) -> DataFrame:
    """Feed items (`source_key, feed, feed_pos, pos, title, link, published, summary,
    full_text, author, tags`) to raw articles. The source decides language, country
    and origin; the catalogue is a fixed list and may be broadcast."""
    kept = first_feed_wins(first_entries(items, max_per_feed))
    kept = kept.where(~is_arabic_title(F.coalesce("title", F.lit("")), F.col("source_key")))
    known = kept.join(
        F.broadcast(catalogue.select(F.col("key").alias("source_key"), "domain", "language", "country", "raw_prefix", "category_in_raw")),
        "source_key",
    )
    by_category = F.col("category_in_raw")
    summary = text.html_to_text(F.col("summary"))
    raw = known.select(
        text.strip(F.coalesce("title", F.lit(""))).alias("titre"),
        F.col("link").alias("url"),
        F.col("domain").alias("source"),
        F.col("language").alias("langue"),
        dates.iso(dates.rfc822_timestamp(F.col("published"))).alias("date_publication"),
        F.coalesce(F.nullif("full_text", F.lit("")), summary).alias("contenu"),
        F.col("country").alias("pays"),
        F.when(by_category, F.concat_ws("_", "raw_prefix", "feed")).otherwise(F.col("raw_prefix")).alias("raw_source"),
        text.strip(F.coalesce("author", F.lit(""))).alias("auteur"),
        F.coalesce(F.get("tags", F.lit(0)), F.when(by_category, F.col("feed")), F.lit("")).alias("categorie"),
    )
    # an unreadable date stays NULL, so that the quality check can flag it
    undated = raw.withColumn("_no_date", F.col("date_publication").isNull())
    full = article_defaults(undated, now)
    return full.withColumn(
        "date_publication", F.when(~F.col("_no_date"), F.col("date_publication"))
    ).select(*rules.RAW_COLUMNS)
