"""Views, analytic tables, summaries and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.operators import gold as gold_ops
from newsloom.operators import sketches, skew, warehouse
from newsloom.plans import demo, sql
from newsloom.plans.sql import mean, with_
from newsloom.sources import tables

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def top_source(key: str) -> str:
    """Most frequent source per key over all stored rows; lowest name on ties."""
    return f"""SELECT {key} AS k, source AS top_source FROM stored WHERE {key} IS NOT NULL GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, source) = 1"""


@query(
    "topic_daily_coverage",
    with_(
        f"""SELECT {sql.day('date_publication')} AS pub_date, topic_label, count(*) AS article_count,
            {mean('polymarket_prob')} AS avg_market_prob,
            sum(CAST(topic_coverage_score AS DECIMAL(28, 6)))::DOUBLE AS total_coverage_score
            FROM stored WHERE quality_status = 'OK' AND topic_id >= 0 GROUP BY 1, 2""",
        "stored",
    ),
)
def topic_daily_coverage(spark, sf):
    return warehouse.topic_daily_coverage(demo.stored(spark, sf)).withColumn("pub_date", F.col("pub_date").cast("string"))


TOP_TOPICS = f"""SELECT topic_label, count(*) AS article_count, round({mean('polymarket_prob')}, 4) AS avg_prob,
    max(polymarket_question) AS market_question, round({mean('combined_signal')}, 4) AS avg_combined_signal
    FROM stored WHERE quality_status = 'OK' AND topic_id >= 0 AND polymarket_prob IS NOT NULL
    GROUP BY 1 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 20"""


@query("top_topics_with_signal", with_(TOP_TOPICS, "stored"))
def top_topics_with_signal(spark, sf):
    return warehouse.top_topics_with_signal(demo.stored(spark, sf))


BREAKDOWN = f"""SELECT source, langue, pays, count(*) AS article_count, {sql.second('min(date_publication)')} AS earliest,
    {sql.second('max(date_publication)')} AS latest, avg(content_length) AS avg_content_length
    FROM stored WHERE quality_status = 'OK' GROUP BY 1, 2, 3"""


@query("source_breakdown", with_(BREAKDOWN, "stored"))
def source_breakdown(spark, sf):
    out = warehouse.source_breakdown(demo.silver(spark, sf))
    return out.withColumns({"earliest": demo.second("earliest"), "latest": demo.second("latest")})


@query(
    "daily_stats",
    with_(
        f"""SELECT {sql.day('date_publication')} AS pub_date, source, count(*) AS article_count,
            avg(content_length) AS avg_length, count(DISTINCT topic_label) AS topic_count
            FROM stored WHERE quality_status = 'OK' GROUP BY 1, 2""",
        "stored",
    ),
)
def daily_stats(spark, sf):
    return warehouse.daily_stats(demo.stored(spark, sf)).withColumn("pub_date", F.col("pub_date").cast("string"))


BY_DAY = f"""SELECT {sql.day('k2')} AS pub_date, article_count, avg_content_length, top_source FROM
    (SELECT date_publication::DATE AS k2, count(*) AS article_count, avg(content_length) AS avg_content_length
     FROM stored WHERE quality_status = 'OK' GROUP BY 1) LEFT JOIN top ON k = k2"""
BY_THEME = f"""SELECT topic_label, article_count, avg_polymarket_prob, top_source FROM
    (SELECT topic_label, count(*) AS article_count, {mean('polymarket_prob')} AS avg_polymarket_prob
     FROM stored WHERE quality_status = 'OK' AND topic_id >= 0 GROUP BY 1) LEFT JOIN top ON k = topic_label"""
BY_COUNTRY = """SELECT pays, article_count, top_source FROM
    (SELECT pays, count(*) AS article_count FROM stored WHERE quality_status = 'OK' GROUP BY 1) LEFT JOIN top ON k = pays"""
BY_SOURCE = """SELECT source, count(*) AS article_count,
    round(sum(CASE WHEN quality_status = 'OK' THEN 1 ELSE 0 END) * 1.0::DOUBLE / count(*), 4) AS quality_ok_rate,
    avg(content_length) AS avg_content_length FROM stored GROUP BY 1"""


@query("articles_by_day", with_(BY_DAY, "stored", top=top_source("date_publication::DATE")))
def articles_by_day(spark, sf):
    return warehouse.articles_by_day(demo.stored(spark, sf)).withColumn("pub_date", F.col("pub_date").cast("string"))


@query("articles_by_theme", with_(BY_THEME, "stored", top=top_source("topic_label")))
def articles_by_theme(spark, sf):
    return warehouse.articles_by_theme(demo.stored(spark, sf))


@query("articles_by_country", with_(BY_COUNTRY, "stored", top=top_source("pays")))
def articles_by_country(spark, sf):
    return warehouse.articles_by_country(demo.stored(spark, sf))


@query("articles_by_source", with_(BY_SOURCE, "stored"))
def articles_by_source(spark, sf):
    return warehouse.articles_by_source(demo.stored(spark, sf))


@query(
    "top_source_per_nation_orders",
    """SELECT n_name, o_orderpriority AS top_priority FROM (
         SELECT n_name, o_orderpriority, row_number() OVER (PARTITION BY n_name ORDER BY count(*) DESC, o_orderpriority) AS rn
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) WHERE rn = 1""",
)
def top_source_per_nation_orders(spark, sf):
    """The per-key mode on large tables: orders are counted per customer first, so the
    join moves one row per customer and priority instead of one per order."""
    counts = tables.table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    nations = tables.table(spark, sf, "nation").select("n_nationkey", "n_name")
    customers = tables.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        counts.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "o_orderpriority")
        .agg(F.sum("n").alias("n"))
    )
    best = per_nation.groupBy("c_nationkey").agg(
        F.min_by("o_orderpriority", F.struct(-F.col("n"), F.col("o_orderpriority"))).alias("top_priority")
    )
    return best.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "top_priority")


@query(
    "topic_summary",
    with_(
        f"""SELECT t.topic_label, article_count, sources_json, avg_polymarket_prob, polymarket_question, date_min, date_max
            FROM (SELECT topic_label, count(*) AS article_count, round_even({mean('polymarket_prob')}, 4) AS avg_polymarket_prob,
                    arg_min(polymarket_question, arrival) FILTER (polymarket_question <> '') AS polymarket_question,
                    {sql.second('min(date_publication)')} AS date_min, {sql.second('max(date_publication)')} AS date_max
                  FROM gold GROUP BY 1) t
            JOIN (SELECT topic_label, '{{' || string_agg('"' || source || '":' || n, ',' ORDER BY n DESC, source) || '}}' AS sources_json
                  FROM (SELECT topic_label, source, count(*) AS n FROM gold GROUP BY 1, 2) GROUP BY 1) USING (topic_label)""",
        "gold",
    ),
)
def topic_summary(spark, sf):
    return gold_ops.topic_summary(demo.gold(spark, sf)).select(
        "topic_label",
        "article_count",
        F.to_json("sources").alias("sources_json"),
        "avg_polymarket_prob",
        "polymarket_question",
        demo.second("date_range.min").alias("date_min"),
        demo.second("date_range.max").alias("date_max"),
    )


@query(
    "topic_coverage",
    with_("SELECT article_id, topic_label, topic_article_count, topic_coverage_score FROM gold", "gold"),
)
def topic_coverage(spark, sf):
    sound = gold_ops.quality_ok(tables.demo_topics(demo.silver_table(spark, sf)))
    return gold_ops.with_coverage(sound).select("article_id", "topic_label", "topic_article_count", "topic_coverage_score")


@query("combined_signal", with_("SELECT article_id, topic_prob, polymarket_prob, combined_signal FROM gold", "gold"))
def combined_signal(spark, sf):
    return demo.build_gold(spark, sf).select("article_id", "topic_prob", "polymarket_prob", "combined_signal")


@query(
    "gold_articles",
    with_(
        """SELECT article_id, url, titre_clean, source, langue, pays, quality_status, topic_id, topic_label, topic_prob,
           topic_article_count, topic_coverage_score, polymarket_question, polymarket_prob, polymarket_prob_pct,
           polymarket_volume_usd, polymarket_url, combined_signal, content_hash FROM stored""",
        "stored",
    ),
)
def gold_articles(spark, sf):
    return demo.stored(spark, sf).select(
        "article_id", "url", "titre_clean", "source", "langue", "pays", "quality_status", "topic_id", "topic_label",
        "topic_prob", "topic_article_count", "topic_coverage_score", "polymarket_question", "polymarket_prob",
        "polymarket_prob_pct", "polymarket_volume_usd", "polymarket_url", "combined_signal", "content_hash",
    )


@query(
    "sql_surface",
    with_(
        """SELECT source, sum(article_count)::BIGINT AS articles, max(latest) AS latest FROM breakdown
           GROUP BY source HAVING sum(article_count) > 5 ORDER BY articles DESC, source""",
        "stored",
        breakdown=BREAKDOWN,
    ),
)
def sql_surface(spark, sf):
    warehouse.register(spark, demo.stored(spark, sf))
    return warehouse.query(
        spark,
        """SELECT source, sum(article_count) AS articles, date_format(max(latest), 'yyyy-MM-dd HH:mm:ss') AS latest
           FROM v_source_breakdown GROUP BY source HAVING sum(article_count) > 5 ORDER BY articles DESC, source""",
    )


@query(
    "gold_filters",
    with_(
        """SELECT 'on_topic' AS filter, count(*) AS n FROM stored WHERE quality_status = 'OK' AND topic_id >= 0
           UNION ALL SELECT 'signal', count(*) FROM stored WHERE polymarket_prob IS NOT NULL
           UNION ALL SELECT 'sources', count(*) FROM stored WHERE source IN ('src1', 'src2')
           UNION ALL SELECT 'topic_groups', count(DISTINCT topic_label) FROM stored
           UNION ALL SELECT 'labelled', count(*) FROM stored WHERE coalesce(topic_label, '') NOT IN ('', 'hors-sujet')""",
        "stored",
    ),
)
def gold_filters(spark, sf):
    label = F.col("topic_label")
    sums = demo.stored(spark, sf).agg(
        F.count_if((F.col("quality_status") == "OK") & (F.col("topic_id") >= 0)).alias("on_topic"),
        F.count("polymarket_prob").alias("signal"),
        F.count_if(F.col("source").isin("src1", "src2")).alias("sources"),
        F.countDistinct("topic_label").alias("topic_groups"),
        F.count_if(text.is_topic_label(label)).alias("labelled"),
    )
    names = ["on_topic", "signal", "sources", "topic_groups", "labelled"]
    return sums.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("filter"), F.col(n).alias("n")) for n in names]))
    )


@query("value_histogram", "SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1")
def value_histogram(spark, sf):
    return gold_ops.value_histogram(tables.table(spark, sf, "documents"), "source")


@query(
    "sources_json",
    """SELECT lang, '{' || string_agg('"' || source || '":' || n, ',' ORDER BY n DESC, source) || '}' AS sources_json
       FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY 1""",
)
def sources_json(spark, sf):
    docs = tables.table(spark, sf, "documents").select(
        F.col("lang").alias("topic_label"),
        "source",
        F.lit(None).cast("double").alias("polymarket_prob"),
        F.lit("").alias("polymarket_question"),
        F.lit(None).cast("timestamp").alias("date_publication"),
        F.col("doc_id").alias("arrival"),
    )
    return gold_ops.topic_summary(docs).select(F.col("topic_label").alias("lang"), F.to_json("sources").alias("sources_json"))


@query(
    "upsert_articles",
    """SELECT md5(text) AS article_id, arg_max(doc_id, (doc_id % 2, doc_id)) AS doc_id,
       arg_max(source, (doc_id % 2, doc_id)) AS source FROM documents GROUP BY 1""",
)
def upsert_articles(spark, sf):
    """Even rows are stored, odd rows arrive as a batch with some of the same keys."""
    docs = tables.table(spark, sf, "documents").select(F.md5("text").alias("article_id"), "doc_id", "source")
    stored = skew.keep_one(docs.where("doc_id % 2 = 0"), "article_id", "doc_id", last=True)
    batch = skew.keep_one(docs.where("doc_id % 2 = 1"), "article_id", "doc_id", last=True)
    return warehouse.upsert(stored, batch)


@query(
    "run_summary",
    with_(
        """SELECT (SELECT count(*) FROM documents) AS articles_scraped, count(*) FILTER (quality_status = 'OK') AS gold_ok,
           count(DISTINCT topic_label) AS topics, count(polymarket_prob) AS signals FROM gold""",
        "gold",
    ),
)
def run_summary(spark, sf):
    scraped = tables.table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n")).scalar()
    return demo.gold(spark, sf).agg(
        F.count_if(F.col("quality_status") == "OK").alias("gold_ok"),
        F.countDistinct("topic_label").alias("topics"),
        F.count("polymarket_prob").alias("signals"),
    ).withColumn("articles_scraped", scraped)


@query(
    "distinct_by_sketch",
    """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, true AS about_right FROM events
       WHERE ts::DATE > (SELECT min(ts::DATE) FROM events) GROUP BY 1""",
)
def distinct_by_sketch(spark, sf):
    """Users per kind of event after the first day, from daily sketches; `about_right` tells whether the estimate lies within its tolerance of the exact count."""
    events = tables.table(spark, sf, "events")
    day = F.to_date("ts")
    daily = sketches.daily_sketches(events, F.col("user_id"), day, "event_type")
    first = events.agg(F.date_add(F.min(day), 1).cast("string")).first()[0]
    about = sketches.merged(daily, "event_type", first=first)
    exact = events.where(day >= F.lit(first).cast("date")).groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    near = F.abs(F.col("about") - F.col("users")) <= F.greatest(F.lit(1.0), F.lit(sketches.TOLERANCE) * F.col("users"))
    return about.join(exact, "event_type").select("event_type", "n", "users", near.alias("about_right"))
