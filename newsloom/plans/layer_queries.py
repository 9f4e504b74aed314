"""Queries that write and read the layers: landing, feeds, pages, sinks and streams.
Files go to a fresh folder below the shared one."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom import rules
from newsloom.functions import dates
from newsloom.operators import gold as gold_ops
from newsloom.operators import quality
from newsloom.plans import batch, demo, sql
from newsloom.plans.sql import with_
from newsloom.session import scratch
from newsloom.sinks import layers as sink
from newsloom.sinks import table
from newsloom.sources import catalogue, feeds, pages, tables
from newsloom.sources import layers as source
from newsloom.streaming import ingest

QUERIES, ORACLES = {}, {}
RUN_DATE = "2024-02-01"


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def _top_source(key: str) -> str:
    """Most frequent source per key over all stored rows, the first of equally frequent ones."""
    return f"""SELECT key, source AS top_source FROM (SELECT {key} AS key, source, count(*) AS n FROM stored WHERE {key} IS NOT NULL GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, source) = 1"""


def ts(text: str):
    return F.lit(text).cast("timestamp")


MORNING, EVENING = f"{RUN_DATE} 08:00:00", f"{RUN_DATE} 20:00:00"


def _raw(spark, sf):
    """Landed articles with plain source names, as scrapers write them."""
    return tables.raw_articles(spark, sf).withColumn("source", F.trim(F.lower("source")))


def _two_runs(spark, sf) -> str:
    """Bronze of one day: odd documents land in the morning, even ones in the evening."""
    root = scratch(spark, "bronze")
    raw = _raw(spark, sf)
    sink.write_bronze(raw.where("arrival % 2 = 1"), root, ts(MORNING))
    sink.write_bronze(raw.where("arrival % 2 = 0"), root, ts(EVENING))
    return root


PER_SOURCE = "SELECT source AS source_key, '2024-02-01' AS date, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents"


def _per_source(df):
    return df.groupBy("source_key", "date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("contenu")).alias("chars")
    )


@query("bronze_scan", f"{PER_SOURCE} GROUP BY 1")
def bronze_scan(spark, sf):
    return _per_source(source.bronze(spark, _two_runs(spark, sf)))


@query("bronze_latest", f"{PER_SOURCE} WHERE (doc_id % 2 = 0) = (source IN (SELECT source FROM documents WHERE doc_id % 2 = 0)) GROUP BY 1")
def bronze_latest(spark, sf):
    """Newest run per source: the evening one, or the morning one where it is the only one."""
    return _per_source(source.bronze(spark, _two_runs(spark, sf), date=RUN_DATE, latest=True))


@query(
    "bronze_roundtrip",
    with_(
        """SELECT article_id, titre, url, md5(contenu) AS contenu_md5, source, raw_source, auteur_raw AS auteur, categorie
           FROM (SELECT *, CASE WHEN auteur = '' THEN '' ELSE ' ' || auteur END AS auteur_raw FROM raw)""",
        "raw",
    ),
)
def bronze_roundtrip(spark, sf):
    root = scratch(spark, "bronze")
    sink.write_bronze(_raw(spark, sf), root, ts(MORNING))
    return source.bronze(spark, root).select(
        "article_id", "titre", "url", F.md5("contenu").alias("contenu_md5"), "source", "raw_source", "auteur", "categorie"
    )


def _silver_root(spark, sf) -> str:
    root = scratch(spark, "silver")
    df = demo.silver_table(spark, sf).drop("arrival")
    sink.write_silver(df, root, ts(MORNING))
    late = df.where("langue = 'en'").drop("categorie").withColumn("extra", F.lit("x"))
    sink.write_silver(late, root, ts(EVENING))
    return root


@query(
    "silver_latest_union",
    with_(
        """SELECT source, run, count(*) AS n, count(categorie) AS with_category, count(extra) AS with_extra FROM
           (SELECT *, CASE WHEN source IN (SELECT source FROM silver WHERE langue = 'en') THEN 'r200000' ELSE 'r080000' END AS run FROM
             (SELECT source, langue, NULL AS categorie, 'x' AS extra FROM silver WHERE langue = 'en'
              UNION ALL SELECT source, langue, categorie, NULL FROM silver s
              WHERE NOT EXISTS (SELECT 1 FROM silver e WHERE e.source = s.source AND e.langue = 'en'))) GROUP BY 1, 2""",
        "silver",
    ),
)
def silver_latest_union(spark, sf):
    return (
        source.silver_latest(spark, _silver_root(spark, sf), RUN_DATE)
        .groupBy("source", "run")
        .agg(F.count(F.lit(1)).alias("n"), F.count("categorie").alias("with_category"), F.count("extra").alias("with_extra"))
    )


@query(
    "silver_roundtrip",
    with_(
        f"""SELECT article_id, titre_clean, {sql.second('date_publication')} AS date_publication, content_hash, flags AS quality_flags,
            '2024-02-01' AS date FROM silver""",
        "silver",
    ),
)
def silver_roundtrip(spark, sf):
    root, json_root = scratch(spark, "silver"), scratch(spark, "silver-json")
    sink.write_silver(demo.silver_table(spark, sf).drop("arrival"), root, ts(MORNING), json_root)
    readable = spark.read.schema("article_id string, date_publication string").json(json_root).select(
        "article_id", "date_publication"
    )
    both = source.silver_latest(spark, root).drop("date_publication").join(readable, "article_id")
    return both.select(
        "article_id", "titre_clean", "date_publication", "content_hash", F.array_join("quality_flags", ",").alias("quality_flags"), "date"
    )


def _gold_root(spark, sf) -> tuple[str, str]:
    root, topics_root = scratch(spark, "gold"), scratch(spark, "gold-topics")
    gold = demo.gold(spark, sf).drop("arrival")
    summary = gold_ops.topic_summary(gold, order="article_id")
    sink.write_gold(gold.where("langue = 'fr'"), summary.limit(0), root, topics_root, ts("2024-01-31 20:00:00"))
    sink.write_gold(gold.where("langue = 'en'"), summary.limit(0), root, topics_root, ts(MORNING))
    sink.write_gold(gold, summary, root, topics_root, ts(EVENING))
    return root, topics_root


@query("available_dates", "SELECT DISTINCT '2024-01-' || lpad((doc_id % 30 + 1)::VARCHAR, 2, '0') AS date FROM documents ORDER BY 1 DESC")
def available_dates(spark, sf):
    """One Silver run per day on which a document was published."""
    root = scratch(spark, "silver-days")
    days = _raw(spark, sf).select("article_id", "source", F.substring("date_publication", 1, 10).alias("date"), F.lit("r080000").alias("run"))
    days.write.partitionBy("source", "date", "run").parquet(root)
    return source.available_dates(spark, root)


@query(
    "gold_roundtrip",
    with_(
        f"""SELECT article_id, topic_label, topic_article_count, topic_coverage_score, polymarket_prob, combined_signal,
            {sql.second('date_publication')} AS date_publication, s.n AS summary_count, '2024-02-01' AS date
            FROM gold JOIN (SELECT topic_label, count(*) AS n FROM gold GROUP BY 1) s USING (topic_label)""",
        "gold",
    ),
)
def gold_roundtrip(spark, sf):
    root, topics_root = _gold_root(spark, sf)
    summary = spark.read.schema("topic_label string, article_count bigint").json(topics_root).select(
        "topic_label", "article_count"
    )
    by_name, by_time = source.gold_latest(spark, root), source.gold_latest(spark, root, RUN_DATE, by_time=True)
    rows = by_name.join(by_time.select("article_id"), "article_id", "left_semi").join(summary, "topic_label")
    return rows.select(
        "article_id", "topic_label", "topic_article_count", "topic_coverage_score", "polymarket_prob", "combined_signal",
        "date_publication", F.col("article_count").alias("summary_count"), "date",
    )


@query(
    "warehouse_upsert",
    with_(
        """SELECT article_id, coalesce(topic_label, '') AS topic_label, source, content_length, flags AS quality_flags
           FROM stored""",
        "stored",
    ),
)
def warehouse_upsert(spark, sf):
    """Cleaned rows are stored first, as the stream does; the scored rows replace theirs;
    the second batch is applied twice, as after a restart."""
    root = scratch(spark, "gold-table")
    sink.upsert_gold(spark, root, demo.silver_table(spark, sf), "arrival")
    for _ in range(2):
        sink.upsert_gold(spark, root, demo.gold(spark, sf), "arrival")
    return sink.read_gold_table(spark, root).select(
        "article_id",
        F.coalesce("topic_label", F.lit("")).alias("topic_label"),
        "source",
        F.col("content_length").cast("bigint").alias("content_length"),
        F.regexp_replace("quality_flags", '[\\[\\]"]', "").alias("quality_flags"),
    )


@query(
    "refresh_analytics",
    with_(
        """SELECT 'country' AS tbl, pays AS key, count(*) FILTER (quality_status = 'OK') AS n FROM stored GROUP BY 2
           HAVING count(*) FILTER (quality_status = 'OK') > 0
           UNION ALL SELECT 'source', source, count(*) FROM stored GROUP BY 2
           UNION ALL SELECT 'theme', topic_label, count(*) FROM stored WHERE quality_status = 'OK' AND topic_id >= 0 GROUP BY 2
           UNION ALL SELECT 'day', strftime(date_publication, '%Y-%m-%d'), count(*) FROM stored WHERE quality_status = 'OK' GROUP BY 2""",
        "stored",
    ),
)
def refresh_analytics(spark, sf):
    root = scratch(spark, "analytics")
    paths = sink.refresh_analytics(demo.stored(spark, sf), root, demo.run_ts())
    sink.refresh_analytics(demo.stored(spark, sf), root, demo.run_ts())
    keys = {"day": "pub_date", "theme": "topic_label", "country": "pays", "source": "source"}
    parts = [
        spark.read.parquet(paths[f"analytics_articles_by_{t}"]).select(
            F.lit(t).alias("tbl"), F.col(k).cast("string").alias("key"), F.col("article_count").alias("n")
        )
        for t, k in keys.items()
    ]
    return source.union_by_name(parts)


def _batches(spark, sf) -> str:
    """The stored table in four upserts: cleaned rows in two, then the scored ones, of which the last batch comes twice."""
    root = scratch(spark, "gold-table")
    cleaned, scored = demo.silver_table(spark, sf), demo.gold(spark, sf)
    for batch_, order in ((cleaned.where("arrival % 2 = 0"), "arrival"), (cleaned.where("arrival % 2 = 1"), "arrival"), (scored, "arrival"),
                          (scored.where("arrival % 3 = 0"), "arrival")):
        sink.upsert_gold(spark, root, batch_, order)
    return root


@query(
    "analytics_by_deltas",
    with_(
        f"""SELECT 'country' AS tbl, pays AS key, count(*) AS n, NULL::DOUBLE AS mean, any_value(top_source) AS top_source
              FROM stored LEFT JOIN ({_top_source('pays')}) t ON t.key = pays WHERE quality_status = 'OK' GROUP BY 2
            UNION ALL SELECT 'source', source, count(*), round(avg(content_length), 8), NULL FROM stored GROUP BY 2
            UNION ALL SELECT 'theme', topic_label, count(*), round(sum(polymarket_prob::DECIMAL(28,6))::DOUBLE / count(polymarket_prob), 8), any_value(top_source)
              FROM stored LEFT JOIN ({_top_source('topic_label')}) t ON t.key = topic_label WHERE quality_status = 'OK' AND topic_id >= 0 GROUP BY 2
            UNION ALL SELECT 'day', strftime(date_publication, '%Y-%m-%d'), count(*), round(avg(content_length), 8), any_value(top_source)
              FROM stored LEFT JOIN ({_top_source("strftime(date_publication, '%Y-%m-%d')")}) t ON t.key = strftime(date_publication, '%Y-%m-%d')
              WHERE quality_status = 'OK' GROUP BY 2""",
        "stored",
    ),
)
def analytics_by_deltas(spark, sf):
    """The analytic tables as four upserts leave them: no article is read for them again."""
    tables_ = table.analytics(spark, _batches(spark, sf))
    facts = {"day": ("pub_date", "avg_content_length"), "theme": ("topic_label", "avg_polymarket_prob"), "country": ("pays", None), "source": ("source", "avg_content_length")}
    parts = []
    for t, (key, mean) in facts.items():
        df = tables_[f"analytics_articles_by_{t}"]
        top = F.col("top_source") if "top_source" in df.columns else F.lit(None).cast("string")
        value = F.round(F.col(mean), 8) if mean else F.lit(None).cast("double")
        parts.append(df.select(F.lit(t).alias("tbl"), F.col(key).cast("string").alias("key"), F.col("article_count").alias("n"), value.alias("mean"), top.alias("top_source")))
    return source.union_by_name(parts)


@query(
    "warehouse_lookup",
    with_(
        """SELECT article_id, source, content_length::BIGINT AS content_length, coalesce(topic_label, '') AS topic_label FROM stored
           WHERE article_id IN (SELECT article_id FROM silver WHERE langue = 'fr')""",
        "stored",
    ),
)
def warehouse_lookup(spark, sf):
    """Stored rows of given ids: those of the French articles, of which some were never scored."""
    ids = demo.silver_table(spark, sf).where("langue = 'fr'").select("article_id")
    found = table.lookup(spark, _batches(spark, sf), ids)
    return found.select("article_id", "source", F.col("content_length").cast("bigint").alias("content_length"), F.coalesce("topic_label", F.lit("")).alias("topic_label"))


@query(
    "ingestion_stats",
    with_(
        """SELECT '2024-02-01' AS run_date, source, count(*) AS articles_scraped, count(*) FILTER (quality_status = 'OK') AS quality_ok,
           count(*) FILTER (quality_status <> 'OK') AS quality_fail, 0.0::DOUBLE AS elapsed_seconds, '' AS bronze_path FROM silver GROUP BY source""",
        "silver",
    ),
)
def ingestion_stats(spark, sf):
    root = scratch(spark, "stats")
    sink.append_ingestion_stats(quality.run_counts(demo.silver_table(spark, sf)), root, demo.run_ts())
    return spark.read.parquet(root).select(
        F.col("run_date").cast("string").alias("run_date"), "source", "articles_scraped", "quality_ok", "quality_fail",
        "elapsed_seconds", "bronze_path",
    )


@query(
    "topic_summary_append",
    with_("SELECT '2024-02-01' AS run_date, topic_label, 2 * count(*) AS articles, 2 AS runs FROM gold GROUP BY topic_label", "gold"),
)
def topic_summary_append(spark, sf):
    root = scratch(spark, "topic-summaries")
    summary = gold_ops.topic_summary(demo.gold(spark, sf))
    for _ in range(2):
        sink.append_topic_summaries(summary, root, RUN_DATE, demo.run_ts())
    return spark.read.parquet(root).groupBy(F.col("run_date").cast("string").alias("run_date"), "topic_label").agg(
        F.sum("article_count").alias("articles"), F.count(F.lit(1)).alias("runs")
    )


@query(
    "retention_candidates",
    """SELECT layer, source, strftime(d, '%Y-%m-%d') AS date, keep_days, date_diff('day', d, DATE '2025-01-15') AS age_days FROM
       (SELECT DISTINCT source, DATE '2024-01-01' + (doc_id % 400)::INT AS d FROM documents),
       (VALUES ('bronze', 90), ('silver', 90), ('gold', 365)) t(layer, keep_days)
       WHERE date_diff('day', d, DATE '2025-01-15') > keep_days""",
)
def retention_candidates(spark, sf):
    days = tables.table(spark, sf, "documents").select(
        "source", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 400).cast("int")).alias("date")
    ).distinct()
    partitions = days.withColumn("layer", F.explode(F.array(*[F.lit(x) for x in rules.RETENTION_DAYS])))
    old = quality.retention_candidates(partitions, F.lit("2025-01-15").cast("date"))
    return old.select("layer", "source", F.col("date").cast("string").alias("date"), "keep_days", "age_days")


# ------------------------------------------------------------ pages and feeds
def page_text(html: str) -> str:
    for tag in rules.PAGE_DROP_TAGS:
        html = f"regexp_replace({html}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', '', 'g')"
    html = f"regexp_replace({html}, '(?s)<!--.*?-->', '<!>', 'g')"
    html = f"regexp_replace({html}, '(<[^>]+>)+', chr(10), 'g')"
    for name, char in pages.ENTITIES:
        html = f"replace({html}, {sql.q(name)}, {sql.q(char)})"
    return sql.strip(html)


ARTICLE = "regexp_extract(html, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1)"
MAIN_TEXT = f"CASE WHEN length({page_text(ARTICLE)}) > 100 THEN {page_text(ARTICLE)} END"


@query("html_main_text", f"SELECT page_id, {MAIN_TEXT} AS full_text FROM pages")
def html_main_text(spark, sf):
    return pages.main_text(tables.landed_pages(spark, sf), "cnn").select("page_id", "full_text")


LONG_LINES = "repeat('A line of the container. ', 5)"


@query(
    "html_nested_containers",
    f"""SELECT page_id, 'div' AS kind, 'Lead ' || page_id || chr(10) || {LONG_LINES} || chr(10) || 'Tail' AS full_text FROM pages
        UNION ALL SELECT page_id, 'tag', 'Outer ' || page_id || chr(10) || {LONG_LINES} || chr(10) || 'Rest' FROM pages
        UNION ALL SELECT page_id, 'blocks', 'One ' || page_id || chr(10) || 'Two' || chr(10) || 'Three' FROM pages
        UNION ALL SELECT page_id, 'body', 'Only ' || page_id FROM pages""",
)
def html_nested_containers(spark, sf):
    """A page per kind of selector: containers that hold their own kind, and the whole body."""
    number, lines = F.col("page_id").cast("string"), "A line of the container. " * 5
    def page(before: str, after: str):
        return F.concat(F.lit("<html><body>" + before), number, F.lit(after + "</body></html>"))

    kinds = [
        ("div", "lakom", page("<div class='entry-content'><div>Lead ", f"</div><div><div>{lines}</div></div>Tail</div><div>after</div>")),
        ("tag", "cnn", page("<article>Outer ", f"<article>{lines}</article>Rest</article><p>after</p>")),
        ("blocks", "bbc", page('<div data-component="text-block"><div><p>One ', '</p></div><p>Two</p></div><div data-component="text-block"><p>Three</p></div>')),
        ("body", "hespress", page("Only ", "<nav>menu</nav>")),
    ]
    rows = tables.table(spark, sf, "pages").select("page_id")
    return source.union_by_name(
        [pages.main_text(rows.withColumn("html", html), key).select("page_id", F.lit(kind).alias("kind"), "full_text") for kind, key, html in kinds]
    )


PAGE_TITLE = page_text("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")


@query(
    "feed_items",
    f"""SELECT md5(url) AS article_id, {PAGE_TITLE} AS titre, url, 'cnn.com' AS source, 'en' AS langue,
        strftime(TIMESTAMP '2024-01-01' + to_hours(page_id::INT), '%Y-%m-%dT%H:%M:%S') AS date_publication,
        'Été –  ' || page_id || '  & more' AS contenu, 'US' AS pays, 'author ' || page_id % 5 AS auteur, 'lang' AS categorie FROM pages""",
)
def feed_items(spark, sf):
    """Pages written as feed items (XML), read back as a feed and mapped to articles; every second one has an update time only."""
    path = scratch(spark, "rss")
    when = F.timestamp_add("HOUR", F.col("page_id"), F.lit("2024-01-01").cast("timestamp"))
    stamp = F.concat(F.date_format(when, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    tables.landed_pages(spark, sf).select(
        pages.page_title(F.col("html")).alias("title"),
        F.col("url").alias("link"),
        F.when(F.col("page_id") % 2 == 0, stamp).alias("pubDate"),
        F.when(F.col("page_id") % 2 == 1, stamp).alias("updated"),
        F.concat(F.lit("<p>&Eacute;t&#233; &#x2013; <b>"), F.col("page_id").cast("string"), F.lit("</b> &amp; more</p>")).alias("description"),
        F.concat(F.lit("author "), (F.col("page_id") % 5).cast("string")).alias("author"),
        F.array(F.lit("lang"), F.lit("all")).alias("category"),
    ).write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    entries = feeds.feed_entries(feeds.rss_items(spark, path), F.lit("cnn"), F.lit("top"), F.lit(1))
    return feeds.feed_articles(entries, catalogue.source_catalogue(spark), demo.run_ts()).drop("ingested_at", "raw_source")


KEYS = [r[0] for r in rules.SOURCE_CATALOGUE]
FEED_LANGS = ["en", "fr", "de", "es"]


def _items(spark, sf):
    """Pages as feed items of nine sources, the url's language as feed; every third page is
    listed a second time in the French feed."""
    page = pages.main_text(tables.landed_pages(spark, sf), "cnn")
    again = F.array(F.lit(False), F.lit(True))
    page = page.withColumn("again", F.explode(F.when(F.col("page_id") % 3 == 0, again).otherwise(F.array(F.lit(False)))))
    feed = F.when(F.col("again"), F.lit("fr")).otherwise(F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1))
    when = F.timestamp_add("HOUR", F.col("page_id"), F.lit("2024-01-01").cast("timestamp"))
    return page.select(
        F.get(F.array(*[F.lit(k) for k in KEYS]), (F.col("page_id") % 9).cast("int")).alias("source_key"),
        feed.alias("feed"),
        F.array_position(F.array(*[F.lit(x) for x in FEED_LANGS]), feed).alias("feed_pos"),
        (F.col("page_id") + F.when(F.col("again"), 1_000_000).otherwise(0)).alias("pos"),
        F.when(F.col("page_id") % 11 == 0, F.lit("")).otherwise(F.col("url")).alias("link"),
        F.concat(F.when(F.col("page_id") % 13 == 0, F.lit("غزة ")).otherwise(F.lit("")), pages.page_title(F.col("html"))).alias("title"),
        F.when(F.col("page_id") % 7 == 0, F.lit("soon")).otherwise(F.concat(F.date_format(when, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0000"))).alias("published"),
        F.col("html").alias("summary"),
        "full_text",
        F.concat(F.lit(" author "), (F.col("page_id") % 5).cast("string")).alias("author"),
        F.when(F.col("page_id") % 2 == 0, F.array(F.lit("tagged"))).otherwise(F.array().cast("array<string>")).alias("tags"),
    )


SUMMARY = "regexp_replace(html, '(<[^>]+>)+', ' ', 'g')"
for _name, _char in pages.ENTITIES:
    SUMMARY = f"replace({SUMMARY}, {sql.q(_name)}, {sql.q(_char)})"
ITEM_CTES = {
    "listed": "SELECT *, false AS again FROM pages UNION ALL SELECT *, true FROM pages WHERE page_id % 3 = 0",
    "items": f"""SELECT page_id + CASE WHEN again THEN 1000000 ELSE 0 END AS pos, page_id, [{', '.join(sql.q(k) for k in KEYS)}][(page_id % 9)::INT + 1] AS source_key,
        CASE WHEN again THEN 'fr' ELSE regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) END AS feed,
        list_position([{', '.join(sql.q(x) for x in FEED_LANGS)}], CASE WHEN again THEN 'fr' ELSE regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) END) AS feed_pos,
        CASE WHEN page_id % 11 = 0 THEN '' ELSE url END AS link,
        CASE WHEN page_id % 13 = 0 THEN 'غزة ' ELSE '' END || {PAGE_TITLE} AS title,
        CASE WHEN page_id % 7 <> 0 THEN TIMESTAMP '2024-01-01' + to_hours(page_id::INT) END AS published,
        {sql.strip(SUMMARY)} AS summary, {MAIN_TEXT} AS full_text FROM listed""",
    "first": """SELECT * FROM items WHERE link <> '' QUALIFY row_number() OVER (PARTITION BY source_key, link ORDER BY feed_pos, pos) = 1""",
    "kept": f"""SELECT * FROM first WHERE NOT (source_key IN {sql.in_list(rules.MOROCCAN_SOURCES)} AND regexp_matches(title, '[\\x{{600}}-\\x{{6ff}}]'))""",
    "cat": "SELECT * FROM (VALUES " + ", ".join(
        "(" + ", ".join("NULL" if v is None else sql.q(str(v)) for v in (r[0], r[1], r[2], r[3], r[4])) + f", {str(r[5]).lower()})"
        for r in rules.SOURCE_CATALOGUE
    ) + ") t(source_key, domain, language, country, raw_prefix, by_feed)",
}


@query(
    "feed_first_wins",
    with_("SELECT source_key, link, feed, pos FROM first", **ITEM_CTES),
)
def feed_first_wins(spark, sf):
    return feeds.first_feed_wins(_items(spark, sf)).select("source_key", "link", "feed", "pos")


@query(
    "feed_first_entries",
    with_(
        "SELECT source_key, feed, pos FROM items QUALIFY row_number() OVER (PARTITION BY source_key, feed ORDER BY pos) <= 20",
        **ITEM_CTES,
    ),
)
def feed_first_entries(spark, sf):
    return feeds.first_entries(_items(spark, sf).select("source_key", "feed", "pos"), 20)


@query(
    "landed_items_canonical",
    with_(
        f"""SELECT md5(link) AS article_id, {sql.strip('title')} AS titre, link AS url, domain AS source, language AS langue,
            strftime(published, '%Y-%m-%dT%H:%M:%S') AS date_publication, coalesce(full_text, summary) AS contenu,
            coalesce(country, 'unknown') AS pays, raw_prefix || CASE WHEN by_feed THEN '_' || feed ELSE '' END AS raw_source,
            'author ' || page_id % 5 AS auteur,
            CASE WHEN page_id % 2 = 0 THEN 'tagged' WHEN by_feed THEN feed ELSE '' END AS categorie
            FROM kept JOIN cat USING (source_key)""",
        **ITEM_CTES,
    ),
)
def landed_items_canonical(spark, sf):
    return feeds.feed_articles(_items(spark, sf), catalogue.source_catalogue(spark), demo.run_ts()).drop("ingested_at")


@query(
    "news_api_items",
    f"""SELECT md5(url) AS article_id, {PAGE_TITLE} AS titre, {PAGE_TITLE} AS contenu, url, regexp_extract(url, '^https?://([^/]+)/', 1) AS source,
        CASE WHEN page_id % 3 = 0 THEN 'unknown' ELSE regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) END AS langue,
        CASE WHEN page_id % 5 = 0 THEN '2024-02-01T12:30:15' WHEN page_id % 5 = 1 THEN 'yesterday'
          ELSE strftime(TIMESTAMP '2024-01-01' + to_hours(page_id::INT), '%Y-%m-%dT%H:%M:%S') END AS date_publication,
        'unknown' AS pays, 'gdelt' AS raw_source FROM pages""",
)
def news_api_items(spark, sf):
    """Pages written as API responses of one host each, read back and mapped."""
    path = scratch(spark, "api")
    p = tables.landed_pages(spark, sf)
    when = F.timestamp_add("HOUR", F.col("page_id"), F.lit("2024-01-01").cast("timestamp"))
    seen = (
        F.when(F.col("page_id") % 5 == 0, F.lit(""))
        .when(F.col("page_id") % 5 == 1, F.lit("yesterday"))
        .otherwise(F.date_format(when, "yyyyMMdd'T'HHmmss'Z'"))
    )
    lang = F.when(F.col("page_id") % 3 != 0, F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1))
    row = F.struct(
        pages.page_title(F.col("html")).alias("title"),
        F.col("url"),
        seen.alias("seendate"),
        F.regexp_extract("url", "^https?://([^/]+)/", 1).alias("domain"),
        lang.alias("language"),
    )
    p.select(F.array(row).alias("articles")).write.json(path)
    return feeds.api_articles(feeds.api_table(spark, path), demo.run_ts()).drop("ingested_at", "auteur", "categorie")


# --------------------------------------------------------- events and reports
MESSAGES = """SELECT CASE WHEN event_type = 'view' THEN 'articles_ingested' ELSE event_type END AS event,
    'src' || user_id % 20 AS source, event_id % 50 AS n, event_id, ts FROM events"""


def _messages(spark, sf):
    """The events table as ingestion messages: views announce articles."""
    e = tables.table(spark, sf, "events")
    name = F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string"))
    path = F.concat(F.lit("s3://bronze/"), name, F.lit("/"), F.date_format("ts", "yyyy-MM-dd"), F.lit("/"), name, F.lit(".json"))
    message = F.struct(
        F.when(F.col("event_type") == "view", "articles_ingested").otherwise(F.col("event_type")).alias("event"),
        name.alias("source"),
        (F.col("event_id") % 50).alias("count"),
        path.alias("bronze_path"),
        dates.iso(F.col("ts")).alias("timestamp"),
    )
    return e.select(F.to_json(message).alias("value"))


@query(
    "event_emit",
    with_(
        """SELECT 'articles_ingested' AS event, source, count(*) AS count, 'lake/bronze/source=' || source || '/date=2024-02-01' AS bronze_path,
           '2024-02-01T12:30:15' AS timestamp FROM silver GROUP BY source""",
        "silver",
    ),
)
def event_emit(spark, sf):
    path = scratch(spark, "events")
    counts = quality.run_counts(demo.silver_table(spark, sf))
    sink.emit_events(sink.ingestion_events(counts, "lake/bronze", RUN_DATE, demo.run_ts()), path)
    return ingest.parse(spark.read.text(path))


@query(
    "event_bronze_lookup",
    """SELECT source_key, count(*) AS n FROM (SELECT source AS source_key, '2024-01-' || lpad((doc_id % 30 + 1)::VARCHAR, 2, '0') AS date FROM documents)
       WHERE (source_key, date) IN (SELECT ('src' || user_id % 20, strftime(ts, '%Y-%m-%d')) FROM events WHERE event_type = 'view') GROUP BY 1""",
)
def event_bronze_lookup(spark, sf):
    """Messages name a source and a day; its articles are looked up by both."""
    named = ingest.announced_partitions(ingest.parse(_messages(spark, sf)))
    landed = _raw(spark, sf).select("source", F.substring("date_publication", 1, 10).alias("date"), "article_id")
    found = landed.join(named, ["source", "date"], "left_semi")
    return found.groupBy(F.col("source").alias("source_key")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "quality_report",
    with_(
        """SELECT source, '2024-02-01' AS date, CASE WHEN ok * 1.0::DOUBLE / n < 0.75 THEN 'LOW_QUALITY' WHEN n < 5 THEN 'LOW_VOLUME' ELSE 'OK' END AS status,
           n AS articles FROM (SELECT source, count(*) AS n, count(*) FILTER (quality_status = 'OK') AS ok FROM silver GROUP BY 1)""",
        "silver",
    ),
)
def quality_report(spark, sf):
    path = scratch(spark, "report")
    silver = demo.silver_table(spark, sf)
    report = quality.gate(silver, silver.select("source").distinct())
    sink.write_quality_report(report, path, RUN_DATE)
    return spark.read.schema("source string, status string, articles bigint, date string").json(path)


# ------------------------------------------------------------------- streams
@query(
    "stream_ingest_counts",
    f"SELECT source, count(*) AS messages, sum(n)::BIGINT AS announced FROM ({MESSAGES}) WHERE event = 'articles_ingested' GROUP BY 1",
)
def stream_ingest_counts(spark, sf):
    """Each micro-batch writes its own counts under its number, so a repeated batch
    replaces what it wrote before; the answer adds them up."""
    landing, out, state = scratch(spark, "topic"), scratch(spark, "counts"), scratch(spark, "state")
    _messages(spark, sf).repartition(4).write.text(landing)

    def add(batch, batch_id):
        counts = ingest.ingested(batch).groupBy("source").agg(
            F.count(F.lit(1)).alias("messages"), F.sum("count").alias("announced")
        )
        counts.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    ingest.run(ingest.file_events(spark, landing, 2), add, state).awaitTermination()
    return spark.read.parquet(out).groupBy("source").agg(
        F.sum("messages").alias("messages"), F.sum("announced").alias("announced")
    )


@query(
    "stream_upsert",
    with_(
        """SELECT article_id, titre_clean, source, content_hash, flags AS quality_flags, quality_status FROM silver""",
        "silver",
    ),
)
def stream_upsert(spark, sf):
    """Landed articles, announced by messages, cleaned and stored by the stream."""
    bronze, topic, stored = _announced(spark, sf)
    apply = ingest.upsert_batch(spark, bronze, stored, demo.run_ts(), analytics_root=scratch(spark, "analytics"), analytics_every=2)
    ingest.run(ingest.file_events(spark, topic, 1), apply, scratch(spark, "state")).awaitTermination()
    return _streamed(spark, stored)


@query(
    "stream_runs_once",
    with_(
        """SELECT article_id, titre_clean, source, content_hash, flags AS quality_flags, quality_status, 1::BIGINT AS times_cleaned FROM silver""",
        "silver",
    ),
)
def stream_runs_once(spark, sf):
    """The same by a stream that remembers the runs of each source: messages come three times, and each run is cleaned once."""
    bronze, topic, stored = _announced(spark, sf, times=3)
    apply = ingest.upsert_batch(spark, bronze, stored, demo.run_ts())
    events = ingest.first_announcements(ingest.file_events(spark, topic, 2))
    ingest.run(events, apply, scratch(spark, "state")).awaitTermination()
    cleaned = [(x.split("/")[0],) for r in table.commits(spark, stored).values() for x in r["runs"] if f"/{RUN_DATE}/" in x]
    times = spark.createDataFrame(cleaned, "source string").groupBy("source").agg(F.count(F.lit(1)).alias("times_cleaned"))
    # rows in a batch keep the source they were landed under
    return _streamed(spark, stored).join(times, "source", "left")


def _announced(spark, sf, times: int = 1) -> tuple[str, str, str]:
    """Bronze with two days' runs, the folder of messages, and where the table will lie."""
    bronze, topic, stored = (scratch(spark, n) for n in ("bronze", "topic", "gold-table"))
    raw = _raw(spark, sf)
    counts = raw.groupBy("source").agg(F.count(F.lit(1)).alias("articles_scraped"))
    stale = raw.where("arrival % 3 = 0").withColumn("titre", F.lit("A title that the next day corrects"))
    for rows, when in ((stale, ts("2024-01-31 22:00:00")), (raw, ts(MORNING))):  # the later run is the one that counts
        sink.write_bronze(rows, bronze, when)
        run_date = "2024-01-31" if rows is stale else RUN_DATE
        for _ in range(times):
            sink.emit_events(sink.ingestion_events(counts, bronze, run_date, when).repartition(2), topic)
    return bronze, topic, stored


def _streamed(spark, stored: str):
    return sink.read_gold_table(spark, stored).select(
        "article_id", "titre_clean", "source", "content_hash",
        F.regexp_replace("quality_flags", '[\\[\\]"]', "").alias("quality_flags"), "quality_status",
    )


@query(
    "daily_job",
    with_(
        f"""SELECT article_id, polymarket_prob, round_even(coalesce(polymarket_prob, 0.5), 4) AS combined_signal,
            (SELECT count(*) FROM gold)::INT AS topic_article_count FROM gold""",
        "gold",
    ),
)
def daily_job(spark, sf):
    """Landing to warehouse in one go, without the topic model, so that every value is known."""
    roots = batch.Roots(scratch(spark, "lake"))
    batch.ingest(spark, _raw(spark, sf), roots, demo.run_ts(), RUN_DATE)
    expected = tables.table(spark, sf, "documents").select("source").distinct()
    batch.check(spark, roots, expected, RUN_DATE)
    batch.build(spark, roots, demo.events(spark, sf), demo.markets(spark, sf), demo.run_ts(), RUN_DATE, model="skip")
    return sink.read_gold_table(spark, roots.gold_table).select(
        "article_id", "polymarket_prob", "combined_signal", "topic_article_count"
    )
