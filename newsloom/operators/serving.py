"""What the dashboard and the API ask for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import rules
from newsloom.functions import dates, numbers, text
from newsloom.operators.markets import drop_irrelevant
from newsloom.operators.silver import fill_missing


def api_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in rules.API_NAMES.items() if k in df.columns})


def api_articles(df: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Served rows: renamed, irrelevant market matches blanked, defaults filled, times
    as text, topic replaced by its entity. Stored probabilities stay; what to show
    for one stuck at 0 or 1 is a column of its own."""
    out = api_names(df)
    if {"poly_q", "poly_prob"} <= set(out.columns):
        out = drop_irrelevant(out)
    out = fill_missing(
        out, {c: F.lit(d).cast("double" if c == "poly_prob" else "string") for c, d in rules.API_DEFAULTS.items()}
    )
    if dict(out.dtypes)["date"] == "timestamp":
        out = out.withColumn("date", dates.iso(F.col("date")))
    out = out.withColumn("topic", text.article_entity(F.col("titre"), F.col("topic")))
    if sources:
        out = out.where(F.col("source").isin(sources))
    prob = F.col("poly_prob")
    return out.withColumns(
        {
            "prob_is_extreme": numbers.is_extreme(prob),
            "display_prob": numbers.display_prob(prob, F.col("titre")),
        }
    )


def json_rows(df: DataFrame) -> DataFrame:
    """Rows as JSON text: NaN becomes null, times ISO, nulls are kept."""
    safe = {
        c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")
    }
    clean = df.withColumns(safe) if safe else df
    return clean.select(
        F.to_json(
            F.struct(*clean.columns),
            {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"},
        ).alias("json")
    )


def top_keywords(gold: DataFrame, n: int = 20, title: str = "titre_clean") -> DataFrame:
    """Most frequent title words of sound articles; ties by word."""
    word = F.btrim("_w", F.lit(rules.KEYWORD_PUNCT))
    return (
        gold.where("quality_status = 'OK'")
        .select(F.explode(text.words(F.lower(title))).alias("_w"))
        .select(word.alias("mot"))
        .where((F.length("mot") > 3) & ~F.col("mot").isin(rules.KEYWORD_STOP_WORDS))
        .groupBy("mot")
        .agg(F.count(F.lit(1)).alias("frequence"))
        .orderBy(F.desc("frequence"), "mot")
        .limit(n)
    )


def top_counts(df: DataFrame, key: Column, name: str, n: int) -> DataFrame:
    return (
        df.groupBy(key.alias(name))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), name)
        .limit(n)
    )


def dashboard_sources(articles: DataFrame, n: int = 8) -> DataFrame:
    return top_counts(articles, F.col("source"), "name", n)


def dashboard_topics(articles: DataFrame, n: int = 6) -> DataFrame:
    return top_counts(articles, text.blank_to(F.col("topic"), "Non classé"), "topic", n)


def dashboard_kpis(articles: DataFrame) -> DataFrame:
    return articles.agg(
        F.count(F.lit(1)).alias("articles"),
        F.countDistinct("source").alias("sources"),
        F.countDistinct(F.nullif("topic", F.lit(""))).alias("topics"),
    )


def explore(articles: DataFrame, source: str = "", lang: str = "", topic: str = "") -> DataFrame:
    """Article list filter; an empty argument filters nothing."""
    out = articles
    if source:
        out = out.where(F.col("source") == source)
    if lang:
        out = out.where(F.col("langue") == lang)
    if topic:
        out = out.where(F.contains(F.coalesce("topic", F.lit("")), F.lit(topic)))
    return out


def search_catalogue(catalogue: DataFrame, needle: str = "", category: str = "Tous") -> DataFrame:
    out = catalogue if category == "Tous" else catalogue.where(F.col("category") == category)
    if not needle:
        return out
    low = needle.lower()
    fields = ["name", "key", "country", "description"]
    found = F.lit(False)
    for f in fields:
        found = found | F.contains(F.lower(F.coalesce(f, F.lit(""))), F.lit(low))
    return out.where(found)


def layer_label(quality: Column) -> Column:
    return F.when(quality == "OK", "Gold").otherwise("Silver")


def run_state(running: Column, error: Column) -> Column:
    return (
        F.when(running.isNull(), "Inconnu")
        .when(running, "RUNNING")
        .when(F.coalesce(error, F.lit("")) != "", "ERROR")
        .otherwise("IDLE")
    )


def log_step(line: Column) -> Column:
    """Furthest step a line speaks of, -1 for none."""
    low = F.lower(line)
    steps = [F.when(text.contains_any(low, needles), F.lit(step)).otherwise(F.lit(-1)) for step, needles in rules.LOG_STEPS]
    return F.greatest(*steps)


def log_severity(line: Column) -> Column:
    chain = F
    for name, pattern in rules.LOG_SEVERITY:
        chain = chain.when(line.rlike(f"(?iu){pattern}"), F.lit(name))
    return chain.otherwise(F.lit("other"))


def log_since(lines: DataFrame, since: int, idx: str = "idx") -> DataFrame:
    return lines.where(F.col(idx) >= since)
