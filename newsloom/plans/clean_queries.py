"""Cleaning, checking and date-reading queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom import rules
from newsloom.functions import dates, numbers, text
from newsloom.operators import quality, skew
from newsloom.operators import silver as silver_ops
from newsloom.plans import demo, sql
from newsloom.plans.sql import with_
from newsloom.sources import catalogue, tables

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


TEXTS = "SELECT 'd' || doc_id AS id, text AS body FROM documents UNION ALL SELECT 'p' || page_id, html FROM pages"


def texts(spark, sf):
    docs = tables.texts(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), F.col("text").alias("body"))
    pages = tables.texts(spark, sf, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), F.col("html").alias("body"))
    return docs.union(pages)


@query("clean_text", f"SELECT id, {sql.clean('body')} AS clean FROM ({TEXTS})")
def clean_text(spark, sf):
    return texts(spark, sf).select("id", text.clean_text("body").alias("clean"))


@query(
    "content_hash",
    f"""SELECT id, length(clean) AS content_length, CASE WHEN clean <> '' THEN md5(clean) ELSE '' END AS content_hash
        FROM (SELECT id, {sql.clean('body')} AS clean FROM ({TEXTS}))""",
)
def content_hash(spark, sf):
    c = F.col("clean")
    return clean_text(spark, sf).select(
        "id", F.length(c).cast("bigint").alias("content_length"), text.content_hash(c).alias("content_hash")
    )


@query("article_id", "SELECT page_id, md5(url) AS article_id FROM pages")
def article_id(spark, sf):
    return tables.table(spark, sf, "pages").select("page_id", text.article_id(F.col("url")).alias("article_id"))


URL_FORMS = """SELECT page_id, 0 AS form, url FROM pages
  UNION ALL SELECT page_id, 1, regexp_replace(url, '^https?://', '') FROM pages
  UNION ALL SELECT page_id, 2, upper(url) FROM pages
  UNION ALL SELECT page_id, 3, url || ' ' || page_id FROM pages
  UNION ALL SELECT page_id, 4, regexp_replace(url, '//.*', '//') FROM pages
  UNION ALL SELECT page_id, 5, NULL FROM pages"""


@query("url_validity", f"SELECT page_id, form, url, {sql.valid_url('url')} AS valid FROM ({URL_FORMS})")
def url_validity(spark, sf):
    url = F.col("url")
    forms = F.array(
        url,
        F.regexp_replace(url, "^https?://", ""),
        F.upper(url),
        F.concat_ws(" ", url, F.col("page_id").cast("string")),
        F.regexp_replace(url, "//.*", "//"),
        F.lit(None).cast("string"),
    )
    return (
        tables.table(spark, sf, "pages")
        .select("page_id", F.posexplode(forms).alias("form", "url"))
        .withColumn("valid", text.is_url_valid(url))
    )


@query("quality_flags", with_("SELECT article_id, flags AS quality_flags FROM silver", "silver"))
def quality_flags(spark, sf):
    return demo.silver(spark, sf).select("article_id", F.array_join("quality_flags", ",").alias("quality_flags"))


@query("quality_status", with_("SELECT quality_status, count(*) AS n FROM silver GROUP BY 1", "silver"))
def quality_status(spark, sf):
    return demo.silver(spark, sf).groupBy("quality_status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "quality_flag_histogram",
    with_("SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(flags, ',')) AS flag FROM silver WHERE flags <> '') GROUP BY 1", "silver"),
)
def quality_flag_histogram(spark, sf):
    return quality.flag_histogram(demo.silver(spark, sf))


def _copies(spark, sf):
    return tables.table(spark, sf, "documents").select(F.md5("text").alias("article_id"), "doc_id", "source", "lang", "text")


@query(
    "dedupe_first",
    """SELECT md5(text) AS article_id, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source,
       arg_min(md5(text || lang), doc_id) AS check FROM documents GROUP BY 1""",
)
def dedupe_first(spark, sf):
    return skew.keep_one(_copies(spark, sf), "article_id", "doc_id").select(
        "article_id", "doc_id", "source", F.md5(F.concat("text", "lang")).alias("check")
    )


@query(
    "dedupe_last",
    """SELECT md5(text) AS article_id, max(doc_id) AS doc_id, arg_max(source, doc_id) AS source,
       arg_max(md5(text || lang), doc_id) AS check FROM documents GROUP BY 1""",
)
def dedupe_last(spark, sf):
    return skew.keep_one(_copies(spark, sf), "article_id", "doc_id", last=True).select(
        "article_id", "doc_id", "source", F.md5(F.concat("text", "lang")).alias("check")
    )


@query(
    "mixed_timestamps",
    """SELECT event_id, strftime(CASE WHEN event_id % 6 = 2 THEN date_trunc('minute', ts)
         WHEN event_id % 6 = 3 THEN date_trunc('day', ts) WHEN event_id % 6 IN (4, 5) THEN NULL ELSE date_trunc('second', ts) END,
         '%Y-%m-%d %H:%M:%S') AS ts FROM events""",
)
def mixed_timestamps(spark, sf):
    ts, kind = F.col("ts"), F.col("event_id") % 6
    written = (
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 2, F.date_format(ts, " yyyy-MM-dd'T'HH:mm"))
        .when(kind == 3, F.date_format(ts, "yyyy/MM/dd"))
        .when(kind == 4, F.lit("  "))
        .otherwise(F.concat(F.lit("on "), F.date_format(ts, "dd.MM.yyyy")))
    )
    return tables.table(spark, sf, "events").withColumn("ts", dates.mixed_timestamp(written)).select(
        "event_id", demo.second("ts").alias("ts")
    )


@query(
    "compact_timestamps",
    """SELECT event_id, CASE WHEN event_id % 4 = 2 THEN '2024-02-01T12:30:15' WHEN event_id % 4 = 3 THEN strftime(ts, '%d.%m.%Y')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS ts FROM events""",
)
def compact_timestamps(spark, sf):
    kind = F.col("event_id") % 4
    written = (
        F.when(kind == 2, F.lit(""))
        .when(kind == 3, F.date_format("ts", "dd.MM.yyyy"))
        .otherwise(F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"))
    )
    return tables.table(spark, sf, "events").select(
        "event_id", dates.compact_to_iso(written, demo.run_ts()).alias("ts")
    )


@query(
    "rfc822_timestamps",
    """SELECT event_id, strftime(CASE WHEN event_id % 4 = 1 THEN ts - INTERVAL 2 HOUR WHEN event_id % 4 = 3 THEN NULL ELSE ts END,
       '%Y-%m-%d %H:%M:%S') AS ts FROM events""",
)
def rfc822_timestamps(spark, sf):
    kind = F.col("event_id") % 4
    plain = F.date_format("ts", "EEE, d MMM yyyy HH:mm:ss")
    written = (
        F.when(kind == 0, F.concat(plain, F.lit(" +0000")))
        .when(kind == 1, F.concat(plain, F.lit(" +0200")))
        .when(kind == 2, F.concat(F.date_format("ts", "dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .otherwise(F.lit("soon"))
    )
    return tables.table(spark, sf, "events").select(
        "event_id", F.date_format(dates.rfc822_timestamp(written), "yyyy-MM-dd HH:mm:ss").alias("ts")
    )


@query(
    "language_profile",
    with_("SELECT langue, langue_detectee, count(*) AS n FROM detected GROUP BY 1, 2", "detected"),
)
def language_profile(spark, sf):
    raw = silver_ops.clean_fields(tables.raw_articles(spark, sf))
    detected = raw.select("langue", text.detect_language("contenu_clean").alias("langue_detectee"))
    return detected.groupBy("langue", "langue_detectee").agg(F.count(F.lit(1)).alias("n"))


@query(
    "silver_articles",
    with_(
        f"""SELECT article_id, titre_clean, url, source, langue, langue_detectee, pays,
            {sql.second('date_publication')} AS date_publication, contenu_clean, content_length, content_hash,
            raw_source, auteur, categorie, flags AS quality_flags, quality_status FROM silver""",
        "silver",
    ),
)
def silver_articles(spark, sf):
    return (
        demo.silver(spark, sf)
        .drop("processed_at", "arrival")
        .withColumns(
            {
                "date_publication": demo.second("date_publication"),
                "quality_flags": F.array_join("quality_flags", ","),
                "content_length": F.col("content_length").cast("bigint"),
            }
        )
    )


@query(
    "normalised_fields",
    with_("SELECT article_id, source, langue, pays, auteur, categorie FROM raw", "raw"),
)
def normalised_fields(spark, sf):
    return silver_ops.clean_fields(tables.raw_articles(spark, sf)).select(
        "article_id", "source", "langue", "pays", "auteur", "categorie"
    )


@query("day_of_ts", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def day_of_ts(spark, sf):
    return (
        tables.table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("d"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("d").cast("string").alias("day"), "n")
    )


@query(
    "rounded_scores",
    """SELECT event_id, round_even(value / 7, 4) AS score, round_even(coalesce(NULLIF(value, 0.0), 0.5) / 3, 4) AS filled,
       printf('%.1f%%', event_id % 100 / 100.0 * 100) AS pct FROM events""",
)
def rounded_scores(spark, sf):
    v = F.col("value")
    return tables.table(spark, sf, "events").select(
        "event_id",
        numbers.round4(v / 7).alias("score"),
        numbers.round4(F.coalesce(F.nullif(v, F.lit(0.0)), F.lit(0.5)) / 3).alias("filled"),
        numbers.percent(F.col("event_id") % 100 / 100.0).alias("pct"),
    )


def _expected(spark, sf):
    """Country a source is expected to write from: that of most of its articles' feed."""
    by_number = F.col("source_no") % 4
    codes = F.array(*[F.lit(c) for c in tables.COUNTRY_BY_LANG.values()])
    return (
        tables.table(spark, sf, "documents")
        .select("source")
        .distinct()
        .withColumn("source_no", F.regexp_extract("source", "[0-9]+", 0).cast("int"))
        .select("source", F.get(codes, by_number).alias("expected_country"))
    )


EXPECTED = """SELECT DISTINCT source, ['GB', 'MA', 'DE', 'ES'][(regexp_extract(source, '[0-9]+')::INT % 4) + 1]
  AS expected_country FROM documents"""


@query(
    "country_consistency",
    with_(
        "SELECT article_id, source, pays, expected_country FROM silver JOIN expected USING (source) WHERE pays IS DISTINCT FROM expected_country",
        "silver",
        expected=EXPECTED,
    ),
)
def country_consistency(spark, sf):
    return quality.country_consistency(demo.silver(spark, sf), _expected(spark, sf)).select(
        "article_id", "source", "pays", "expected_country"
    )


@query(
    "duplicate_content",
    with_(
        """SELECT article_id, content_hash, copies FROM (SELECT *, count(*) OVER (PARTITION BY content_hash) AS copies
           FROM silver WHERE content_hash <> '') WHERE copies > 1""",
        "silver",
    ),
)
def duplicate_content(spark, sf):
    return quality.duplicate_content(demo.silver_table(spark, sf)).select("article_id", "content_hash", "copies")


@query(
    "quality_warnings",
    """SELECT doc_id AS arrival, array_to_string(list_filter([CASE WHEN doc_id % 5 = 0 THEN 'AUTEUR_MANQUANT' END,
       CASE WHEN doc_id % 3 = 0 THEN 'CATEGORIE_MANQUANTE' END], lambda x: x IS NOT NULL), ',') AS warnings FROM documents""",
)
def quality_warnings(spark, sf):
    return silver_ops.clean_fields(tables.raw_articles(spark, sf)).select(
        "arrival", F.array_join(silver_ops.quality_warnings(), ",").alias("warnings")
    )


CATALOGUE = (
    "SELECT * FROM (VALUES "
    + ", ".join(
        "(" + ", ".join([str(i)] + ["NULL" if v is None else sql.q(str(v)) for v in (r[0], r[1], r[2], r[3], r[4], r[6])]) + ")"
        for i, r in enumerate(rules.SOURCE_CATALOGUE)
    )
    + ") t(no, key, domain, language, country, raw_prefix, name)"
)
SELECTORS = (
    "SELECT * FROM (VALUES "
    + ", ".join(f"({sql.q(k)}, {len(v)}, {sql.q(v[0])})" for k, v in rules.PAGE_SELECTORS.items())
    + ") t(key, selectors, first_selector)"
)


@query(
    "source_catalogue",
    f"""SELECT c.key, c.domain, c.language, c.country, c.raw_prefix, s.selectors::BIGINT AS selectors, s.first_selector,
        count(d.doc_id) AS articles FROM ({CATALOGUE}) c LEFT JOIN ({SELECTORS}) s USING (key)
        LEFT JOIN documents d ON regexp_extract(d.source, '[0-9]+')::INT % 9 = c.no GROUP BY ALL""",
)
def source_catalogue(spark, sf):
    keys = F.array(*[F.lit(r[0]) for r in rules.SOURCE_CATALOGUE])
    counts = (
        tables.table(spark, sf, "documents")
        .groupBy(F.get(keys, F.regexp_extract("source", "[0-9]+", 0).cast("int") % 9).alias("key"))
        .agg(F.count(F.lit(1)).alias("articles"))
    )
    per_key = catalogue.selectors(spark).groupBy("key").agg(
        F.count(F.lit(1)).alias("selectors"), F.min_by("selector", "priority").alias("first_selector")
    )
    return (
        catalogue.source_catalogue(spark)
        .join(per_key, "key", "left")
        .join(counts, "key", "left")
        .select("key", "domain", "language", "country", "raw_prefix", "selectors", "first_selector",
                F.coalesce("articles", F.lit(0)).alias("articles"))
    )
