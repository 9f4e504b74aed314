"""A corpus pipeline over `documents`: each stage reads what the one before it kept, written as Parquet.

Language identification drops texts without a recognisable language, near-duplicate search keeps one document
of each group, decontamination drops documents that hold a passage of `benchmark`, the secret scan replaces
secrets in the texts that remain, and packing turns them into token sequences. An empty table passes through
every stage; rows with nulls are judged as the operators state it."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.llm import decontaminate, jaccard_join, packing, ppm_language, secret_scan
from newsloom.llm.common import fresh, stored, table


def language(spark, docs, sf_dir):
    """Drops texts that are null, have no letter, or of which no language could be learned."""
    names = fresh("lang_pred", docs.columns), fresh("score", docs.columns)
    found = ppm_language.identify(docs, ppm_language.learn(docs, held_out=None), names=names)
    return found.where(F.col(names[0]) != "und").select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """Keeps the document of the smallest id of each group of near copies."""
    return jaccard_join.keep_one(docs)


def contamination(spark, docs, sf_dir):
    """Drops documents that hold ten consecutive words (or all words) of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark, docs, sf_dir):
    """Replaces secrets by a marker; n_chars follows the text."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packed(spark, docs, sf_dir):
    """Sequences of at most 2048 tokens: one row per piece of a document, with its ids."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("contamination", contamination),
    ("secrets", secrets),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
