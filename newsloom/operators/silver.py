"""Landed articles to the cleaned, checked layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import rules
from newsloom.functions import dates, text
from newsloom.operators.skew import keep_one


COSTLY = [
    "contenu_clean", "titre_clean", "langue_detectee", "content_length", "content_hash",
    "quality_flags", "quality_status",
]


def fill_missing(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add the columns that are absent; present ones stay as they are."""
    absent = {c: v for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def article_defaults(df: DataFrame, run_ts: Column) -> DataFrame:
    """What a landed article holds when a feed leaves a field out."""
    string = F.lit(None).cast("string")
    df = fill_missing(df, {c: string for c in rules.RAW_COLUMNS if c != "article_id"})
    return df.withColumns(
        {
            "date_publication": text.blank_to(F.col("date_publication"), dates.iso(run_ts)),
            "contenu": F.coalesce("contenu", F.lit("")),
            "pays": text.blank_to(F.col("pays"), "unknown"),
            "raw_source": text.blank_to(F.col("raw_source"), F.col("source")),
            "auteur": F.coalesce("auteur", F.lit("")),
            "categorie": F.coalesce("categorie", F.lit("")),
            "article_id": text.article_id(F.col("url")),
            "ingested_at": F.coalesce("ingested_at", dates.iso(run_ts)),
        }
    )


def clean_fields(df: DataFrame) -> DataFrame:
    """Cleaned texts and normalised fields."""
    df = fill_missing(df, {"auteur": F.lit(""), "categorie": F.lit("")})
    published = F.col("date_publication")
    if dict(df.dtypes)["date_publication"] == "string":
        published = dates.mixed_timestamp(published)
    return df.withColumns(
        {
            "contenu_clean": text.clean_text("contenu"),
            "titre_clean": text.clean_text("titre"),
            "date_publication": published,
            "source": text.strip(F.lower("source")),
            "langue": text.strip(F.lower("langue")),
            "pays": text.strip(F.upper("pays")),
            "auteur": text.strip(F.col("auteur")),
            "categorie": text.strip(F.col("categorie")),
        }
    )


def derive(df: DataFrame) -> DataFrame:
    clean = F.col("contenu_clean")
    return df.withColumns(
        {
            "langue_detectee": text.detect_language("contenu_clean"),
            "content_length": F.length(clean),
            "content_hash": text.content_hash(clean),
        }
    )


def quality_flags() -> Column:
    """Ordered list of the rules a cleaned article breaks."""
    title, body, url = F.col("titre_clean"), F.col("contenu_clean"), F.col("url")
    declared, detected = F.col("langue"), F.col("langue_detectee")
    no_url = F.coalesce(url, F.lit("")) == ""
    tests = [
        F.length(F.coalesce(title, F.lit(""))) < rules.MIN_TITLE_LENGTH,
        F.length(F.coalesce(body, F.lit(""))) < rules.MIN_CONTENT_LENGTH,
        no_url,
        F.col("date_publication").isNull(),
        ~no_url & ~text.is_url_valid(url),
        text.has_arabic(title) | text.has_arabic(body),
        (F.length(body) >= rules.MIN_LANGUAGE_CHECK_LENGTH)
        & (detected != "") & (declared != "") & (detected != declared) & (detected != "unknown"),
    ]
    return F.array_compact(
        F.array(*[F.when(t, F.lit(flag)) for flag, t in zip(rules.QUALITY_FLAGS, tests)])
    )


def quality_warnings() -> Column:
    """Documented rules that do not fail an article."""
    return F.array_compact(
        F.array(
            F.when(F.coalesce("auteur", F.lit("")) == "", F.lit(rules.WARNING_FLAGS[0])),
            F.when(F.coalesce("categorie", F.lit("")) == "", F.lit(rules.WARNING_FLAGS[1])),
        )
    )


def status(flags: Column) -> Column:
    return F.when(F.size(flags) > 0, F.lit("FAIL")).otherwise(F.lit("OK"))


def project(df: DataFrame, columns: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """Fixed column order; absent columns are skipped."""
    return df.select(*[c for c in [*columns, *extra] if c in df.columns])


def to_silver(
    raw: DataFrame, run_ts: Column, arrival: str = "arrival", keep: tuple[str, ...] = (), within: str | None = None
) -> DataFrame:
    """First copy of every article, cleaned, measured and checked; with `within`, a column
    that names the run, the first copy in each run."""
    if within:
        unit = F.concat_ws("\n", within, "article_id")
        first = keep_one(raw.withColumn("_unit", unit), "_unit", arrival).drop("_unit")
    else:
        first = keep_one(raw, "article_id", arrival)
    df = derive(clean_fields(first))
    df = df.withColumn("quality_flags", quality_flags())
    df = df.withColumn("quality_status", status(F.col("quality_flags")))
    df = text.evaluate_once(df, COSTLY).withColumn("processed_at", run_ts)
    return project(df, rules.SILVER_COLUMNS, keep)
