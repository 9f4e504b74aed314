"""Dashboard, gate and log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom import rules
from newsloom.functions import numbers
from newsloom.operators import quality, serving
from newsloom.operators import silver as silver_ops
from newsloom.plans import demo, sql
from newsloom.plans.sql import with_
from newsloom.sources import tables

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


# ------------------------------------------------------------------ keywords
KEYWORDS = f"""SELECT mot, count(*) AS frequence FROM
    (SELECT trim(word, {sql.q(rules.KEYWORD_PUNCT)}) AS mot FROM
      (SELECT unnest({sql.words('lower(titre_clean)')}) AS word FROM silver WHERE quality_status = 'OK'))
    WHERE length(mot) > 3 AND mot NOT IN {sql.in_list(rules.KEYWORD_STOP_WORDS)} GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 20"""


@query("top_keywords", with_(KEYWORDS, "silver"))
def top_keywords(spark, sf):
    return serving.top_keywords(demo.silver_table(spark, sf), 20)


# ----------------------------------------------------------------- dashboard
@query("dashboard_sources", with_("SELECT source AS name, count(*) AS n FROM stored GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8", "stored"))
def dashboard_sources(spark, sf):
    return serving.dashboard_sources(demo.stored(spark, sf))


@query(
    "dashboard_topics",
    with_(
        """SELECT coalesce(nullif(topic_label, ''), 'Non classé') AS topic, count(*) AS n FROM stored
           GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 6""",
        "stored",
    ),
)
def dashboard_topics(spark, sf):
    return serving.dashboard_topics(serving.api_names(demo.stored(spark, sf)))


@query(
    "dashboard_kpis",
    with_(
        """SELECT count(*) AS articles, count(DISTINCT source) AS sources, count(DISTINCT nullif(topic_label, '')) AS topics
           FROM stored""",
        "stored",
    ),
)
def dashboard_kpis(spark, sf):
    return serving.dashboard_kpis(serving.api_names(demo.stored(spark, sf)))


@query(
    "filter_values",
    with_("SELECT 'source' AS field, source AS value FROM stored UNION SELECT 'langue', langue FROM stored", "stored"),
)
def filter_values(spark, sf):
    df = demo.stored(spark, sf)
    return df.select(F.lit("source").alias("field"), F.col("source").alias("value")).distinct().union(
        df.select(F.lit("langue"), "langue").distinct()
    )


@query(
    "article_explorer",
    with_(
        """SELECT article_id AS id, source, langue, topic_label AS topic, CASE WHEN quality_status = 'OK' THEN 'Gold' ELSE 'Silver' END AS layer
           FROM stored WHERE langue = 'en' AND contains(coalesce(topic_label, ''), 'trump')""",
        "stored",
    ),
)
def article_explorer(spark, sf):
    found = serving.explore(serving.api_names(demo.stored(spark, sf)), lang="en", topic="trump")
    return found.select("id", "source", "langue", "topic", serving.layer_label(F.col("quality")).alias("layer"))


@query(
    "catalogue_search",
    """SELECT source AS key, 'Feed ' || upper(source) AS name, min(lang) AS category, max(lang) AS country,
       count(*) || ' documents' AS description FROM documents GROUP BY source
       HAVING min(lang) = 'de' AND (contains(lower('Feed ' || upper(source)), 'src1') OR contains(lower(source), 'src1')
         OR contains(max(lang), 'src1') OR contains(count(*) || ' documents', 'src1'))""",
)
def catalogue_search(spark, sf):
    listed = (
        tables.table(spark, sf, "documents")
        .groupBy(F.col("source").alias("key"))
        .agg(F.min("lang").alias("category"), F.max("lang").alias("country"), F.count(F.lit(1)).alias("n"))
        .select(
            "key",
            F.concat(F.lit("Feed "), F.upper("key")).alias("name"),
            "category",
            "country",
            F.concat(F.col("n").cast("string"), F.lit(" documents")).alias("description"),
        )
    )
    return serving.search_catalogue(listed, needle="SRC1", category="de")


@query(
    "top_k_panels",
    with_(
        """SELECT 'source' AS panel, value, n FROM (SELECT source AS value, count(*) AS n FROM stored GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8)
           UNION ALL SELECT 'topic', value, n FROM (SELECT topic_label AS value, count(*) AS n FROM stored WHERE topic_label IS NOT NULL
             GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 6)
           UNION ALL SELECT 'date', value, n FROM (SELECT strftime(date_publication, '%Y-%m-%d') AS value, count(*) AS n FROM stored
             GROUP BY 1 ORDER BY 1 DESC LIMIT 4)""",
        "stored",
    ),
)
def top_k_panels(spark, sf):
    df = demo.stored(spark, sf)
    sources = serving.top_counts(df, F.col("source"), "value", 8)
    topics = serving.top_counts(df.where("topic_label IS NOT NULL"), F.col("topic_label"), "value", 6)
    dates = (
        df.groupBy(F.to_date("date_publication").alias("d")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("d")).limit(4).select(F.col("d").cast("string").alias("value"), "n")
    )
    return (
        sources.select(F.lit("source").alias("panel"), "value", "n")
        .union(topics.select(F.lit("topic"), "value", "n"))
        .union(dates.select(F.lit("date"), "value", "n"))
    )


@query(
    "first_failures",
    with_("SELECT article_id, flags AS quality_flags FROM silver WHERE quality_status = 'FAIL' ORDER BY arrival LIMIT 3", "silver"),
)
def first_failures(spark, sf):
    return (
        demo.silver_table(spark, sf)
        .where("quality_status = 'FAIL'")
        .orderBy("arrival")
        .limit(3)
        .select("article_id", F.array_join("quality_flags", ",").alias("quality_flags"))
    )


# ------------------------------------------------------------------- quality
def _labelled(spark, sf):
    """Documents with a verdict: label 1 passes, anything else fails."""
    verdicts = tables.table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "OK").otherwise("FAIL").alias("quality_status")
    )
    return tables.table(spark, sf, "documents").select("doc_id", "source").join(verdicts, "doc_id")


LABELLED = """SELECT source, CASE WHEN quality = 1 THEN 'OK' ELSE 'FAIL' END AS quality_status FROM documents JOIN labels USING (doc_id)"""
RUN_COUNTS = """SELECT source, count(*) AS articles_scraped, count(*) FILTER (quality_status = 'OK') AS quality_ok,
    count(*) FILTER (quality_status <> 'OK') AS quality_fail FROM labelled GROUP BY 1"""


@query("run_quality_counts", f"WITH labelled AS ({LABELLED}) {RUN_COUNTS}")
def run_quality_counts(spark, sf):
    return quality.run_counts(_labelled(spark, sf))


@query(
    "run_totals",
    f"""WITH labelled AS ({LABELLED}), runs AS ({RUN_COUNTS}) SELECT sum(articles_scraped)::BIGINT AS articles,
        sum(quality_ok)::BIGINT AS ok, sum(quality_fail)::BIGINT AS fail, count(*) AS sources FROM runs""",
)
def run_totals(spark, sf):
    return run_quality_counts(spark, sf).agg(
        F.sum("articles_scraped").alias("articles"),
        F.sum("quality_ok").alias("ok"),
        F.sum("quality_fail").alias("fail"),
        F.count(F.lit(1)).alias("sources"),
    )


@query(
    "quality_by_source",
    f"""WITH labelled AS ({LABELLED}) SELECT source, count(*) FILTER (quality_status = 'OK') AS ok,
        count(*) FILTER (quality_status <> 'OK') AS fail FROM labelled GROUP BY 1""",
)
def quality_by_source(spark, sf):
    return quality.by_source(_labelled(spark, sf))


@query(
    "quality_gate",
    f"""WITH labelled AS ({LABELLED}), runs AS ({RUN_COUNTS}),
        expected AS (SELECT DISTINCT source FROM documents UNION SELECT DISTINCT source || '-mirror' FROM documents WHERE lang = 'de'),
        judged AS (SELECT e.source, coalesce(articles_scraped, 0) AS n, quality_ok / articles_scraped::DOUBLE AS rate
                   FROM expected e LEFT JOIN runs USING (source))
        SELECT source, CASE WHEN n = 0 THEN 'MISSING' WHEN rate < 0.75 THEN 'LOW_QUALITY' WHEN n < 5 THEN 'LOW_VOLUME' ELSE 'OK' END AS status,
          n AS articles, round(rate, 4) AS quality_ok_rate,
          concat_ws(' | ', CASE WHEN n = 0 THEN '[ALERTE] Aucune donnée Silver pour ''' || source || ''' le 2024-02-01' END,
            CASE WHEN n BETWEEN 1 AND 4 THEN '[ALERTE] ''' || source || ''' : seulement ' || n || ' articles (min=5)' END,
            CASE WHEN rate < 0.75 THEN '[ALERTE] ''' || source || ''' : taux qualité ' || printf('%.1f%%', rate * 100) || ' < 75%' END) AS alerts FROM judged""",
)
def quality_gate(spark, sf):
    docs = tables.table(spark, sf, "documents")
    mirrors = docs.where("lang = 'de'").select(F.concat("source", F.lit("-mirror")).alias("source"))
    expected = docs.select("source").union(mirrors).distinct()
    report = quality.gate(_labelled(spark, sf), expected, run_date="2024-02-01")
    return report.withColumn("alerts", F.array_join("alerts", " | "))


@query(
    "layer_funnel",
    with_(
        """SELECT 1 AS step, 'bronze' AS layer, (SELECT count(*) FROM documents) AS n
           UNION ALL SELECT 2, 'silver', (SELECT count(*) FROM silver)
           UNION ALL SELECT 3, 'gold', (SELECT count(*) FROM silver WHERE quality_status = 'OK')""",
        "silver",
    ),
)
def layer_funnel(spark, sf):
    return quality.funnel(tables.raw_articles(spark, sf), demo.silver_table(spark, sf), demo.gold(spark, sf))


@query(
    "quality_kpis",
    with_(
        """SELECT gold_rows, ok_rows, round(ok_rows * 100.0::DOUBLE / gold_rows, 1) AS ok_pct,
           round(100.0 - round(ok_rows * 100.0::DOUBLE / gold_rows, 1), 1) AS rejected_pct,
           round(gold_rows * 100.0::DOUBLE / (SELECT count(*) FROM documents), 1) AS retention_pct
           FROM (SELECT count(*) AS gold_rows, count(*) FILTER (quality_status = 'OK') AS ok_rows FROM stored)""",
        "stored",
    ),
)
def quality_kpis(spark, sf):
    return quality.kpis(tables.raw_articles(spark, sf), demo.stored(spark, sf))


# ----------------------------------------------------------------------- api
@query(
    "api_projection",
    with_(
        f"""SELECT article_id AS id, titre_clean AS titre, strftime(date_publication, '%Y-%m-%dT%H:%M:%S') AS date,
            quality_status AS quality, {sql.article_entity('titre_clean', 'topic_label')} AS topic, polymarket_prob AS poly_prob,
            polymarket_question AS poly_q, combined_signal, coalesce(polymarket_prob >= 0.99 OR polymarket_prob <= 0.01, false) AS prob_is_extreme,
            NULL::VARCHAR AS source_key FROM gold WHERE source IN ('src1', 'src3', 'src5')""",
        "gold",
    ),
)
def api_projection(spark, sf):
    return serving.api_articles(demo.gold(spark, sf), sources=["src1", "src3", "src5"]).select(
        "id", "titre", "date", "quality", "topic", "poly_prob", "poly_q", "combined_signal", "prob_is_extreme", "source_key"
    )


@query(
    "json_rows",
    with_(
        """SELECT '{"article_id":"' || article_id || '","date_publication":"' || strftime(date_publication, '%Y-%m-%dT%H:%M:%S')
           || '","topic_label":' || coalesce('"' || topic_label || '"', 'null') || ',"ratio":'
           || CASE WHEN arrival % 4 = 0 THEN 'null' ELSE '0.5' END || '}' AS json FROM stored""",
        "stored",
    ),
)
def json_rows(spark, sf):
    ratio = F.when(F.col("arrival") % 4 == 0, F.lit(float("nan"))).otherwise(F.lit(0.5))
    return serving.json_rows(
        demo.stored(spark, sf).select("article_id", "date_publication", "topic_label", ratio.alias("ratio"))
    )


@query(
    "fill_missing_columns",
    """SELECT doc_id, source, 'unknown' AS pays, '' AS auteur, NULL::DOUBLE AS poly_prob, lang AS langue FROM documents""",
)
def fill_missing_columns(spark, sf):
    docs = tables.table(spark, sf, "documents").select("doc_id", "source", F.col("lang").alias("langue"))
    return silver_ops.fill_missing(
        docs,
        {"source": F.lit("x"), "pays": F.lit("unknown"), "auteur": F.lit(""), "poly_prob": F.lit(None).cast("double")},
    )


@query(
    "display_probability",
    with_(
        """SELECT article_id, polymarket_prob, CASE WHEN coalesce(polymarket_prob >= 0.99 OR polymarket_prob <= 0.01, false)
           THEN round_even(0.58 + (('0x' || substr(md5(coalesce(titre_clean, '')), 1, 8))::BIGINT % 31) / 100.0::DOUBLE, 4)
           ELSE polymarket_prob END AS display_prob FROM gold""",
        "gold",
    ),
)
def display_probability(spark, sf):
    shown = numbers.display_prob(F.col("polymarket_prob"), F.col("titre_clean"))
    return demo.gold(spark, sf).select("article_id", "polymarket_prob", shown.alias("display_prob"))


# ---------------------------------------------------------------------- logs
LOGS = """SELECT conv_id AS run_id, turn AS idx, CASE turn WHEN 0 THEN '>>> PHASE 1+2 Scraping: ' WHEN 1 THEN '[INFO] Silver: '
    WHEN 2 THEN '[WARN] topic model: ' WHEN 3 THEN '[OK] Gold written: ' WHEN 4 THEN 'ERROR Warehouse: ' ELSE '' END || text AS line
    FROM conversations"""
STEP = "greatest(" + ", ".join(
    "CASE WHEN " + " OR ".join(f"contains(lower(line), {sql.q(n)})" for n in needles) + f" THEN {step} ELSE -1 END"
    for step, needles in rules.LOG_STEPS
) + ")"
SEVERITY = "CASE " + " ".join(
    f"WHEN regexp_matches(line, '(?i){pattern}') THEN {sql.q(name)}" for name, pattern in rules.LOG_SEVERITY
) + " ELSE 'other' END"


@query("log_steps", f"SELECT run_id, max({STEP}) AS step, count(*) FILTER (idx >= 2) AS since_2, count(*) AS total FROM ({LOGS}) GROUP BY 1")
def log_steps(spark, sf):
    return (
        tables.log_lines(spark, sf)
        .groupBy("run_id")
        .agg(
            F.max(serving.log_step(F.col("line"))).alias("step"),
            F.count_if(F.col("idx") >= 2).alias("since_2"),
            F.count(F.lit(1)).alias("total"),
        )
    )


@query("log_slice", f"SELECT run_id, idx, md5(line) AS line_md5 FROM ({LOGS}) WHERE idx >= 2")
def log_slice(spark, sf):
    return serving.log_since(tables.log_lines(spark, sf), 2).select("run_id", "idx", F.md5("line").alias("line_md5"))


@query("log_severity", f"SELECT {SEVERITY} AS severity, count(*) AS n FROM ({LOGS}) GROUP BY 1")
def log_severity(spark, sf):
    return (
        tables.log_lines(spark, sf)
        .groupBy(serving.log_severity(F.col("line")).alias("severity"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "layer_label",
    with_("SELECT CASE WHEN quality_status = 'OK' THEN 'Gold' ELSE 'Silver' END AS layer, count(*) AS n FROM silver GROUP BY 1", "silver"),
)
def layer_label(spark, sf):
    return (
        demo.silver_table(spark, sf)
        .groupBy(serving.layer_label(F.col("quality_status")).alias("layer"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "run_state",
    f"""SELECT run_id, CASE WHEN last = 0 THEN 'Inconnu' WHEN last % 2 = 0 THEN 'RUNNING' WHEN errors > 0 THEN 'ERROR' ELSE 'IDLE' END AS state
        FROM (SELECT run_id, max(idx) AS last, count(*) FILTER (starts_with(line, 'ERROR')) AS errors FROM ({LOGS}) GROUP BY 1)""",
)
def run_state(spark, sf):
    """A run of one line has not reported yet; one that ends on an even line still runs."""
    runs = tables.log_lines(spark, sf).groupBy("run_id").agg(
        F.max("idx").alias("last"),
        F.max(F.when(F.startswith("line", F.lit("ERROR")), F.lit("failed"))).alias("error"),
    )
    running = F.when(F.col("last") > 0, F.col("last") % 2 == 0)
    return runs.select("run_id", serving.run_state(running, F.col("error")).alias("state"))
