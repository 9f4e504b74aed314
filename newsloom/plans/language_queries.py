"""Languages learned from labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.operators import languages
from newsloom.sources import tables

QUERIES, ORACLES = {}, {}

#: Every third document is held out: its label teaches nothing, so that accuracy can be read off the result.
FOLDS = 3

SPELLED = f"""SELECT doc_id, lang, coalesce(doc_id % {FOLDS} = 0, false) AS held_out, t, length(t) - 2 AS n FROM (
  SELECT doc_id, lang, ' ' || trim(regexp_replace(translate(coalesce(text, ''), '{languages.UPPER}', '{languages.UPPER.lower()}'), '[^a-z\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g')) || ' ' AS t
  FROM documents)"""
MODEL = f"""spelled AS ({SPELLED}),
grams AS (SELECT doc_id, lang, held_out, substring(t, k::BIGINT, 3) AS gram FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM spelled WHERE n > 0)),
counts AS (SELECT lang, gram, count(*) AS c, sum(count(*)) OVER (PARTITION BY lang) AS total FROM grams WHERE lang IS NOT NULL AND NOT held_out GROUP BY lang, gram),
shares AS (SELECT lang, gram, round(ln(c / total::DOUBLE) * {languages.SCALE})::BIGINT AS share, round(ln(0.5 / total::DOUBLE) * {languages.SCALE})::BIGINT AS base
           FROM counts WHERE c * {languages.RAREST} >= total)"""
DETECTED = f"""WITH {MODEL},
scores AS (SELECT doc_id, s.lang, sum(share - base) + any_value(n) * any_value(base) AS score FROM (SELECT doc_id, gram FROM grams) JOIN shares s USING (gram)
           JOIN (SELECT doc_id, n FROM spelled) USING (doc_id) GROUP BY doc_id, s.lang),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS place, score - lead(score) OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS ahead FROM scores)
SELECT doc_id, p.lang AS labelled, p.held_out, coalesce(r.lang, '{languages.UNKNOWN}') AS detected, round(ahead / (p.n * {languages.SCALE}.0), 6) AS margin
FROM spelled p LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r USING (doc_id)"""


def taught(documents):
    return documents.where(F.coalesce(F.col("doc_id") % FOLDS != 0, F.lit(True)))


def language_trigrams(spark, sf):
    return languages.learn(taught(tables.table(spark, sf, "documents")))


def language_detected(spark, sf):
    documents = tables.table(spark, sf, "documents")
    found = languages.identify(documents, languages.learn(taught(documents)), "doc_id")
    labels = documents.select("doc_id", F.col("lang").alias("labelled"), F.coalesce(F.col("doc_id") % FOLDS == 0, F.lit(False)).alias("held_out"))
    return labels.join(found, "doc_id").select("doc_id", "labelled", "held_out", "detected", "margin")


QUERIES = {"language_trigrams": language_trigrams, "language_detected": language_detected}
ORACLES = {"language_trigrams": f"WITH {MODEL} SELECT lang, gram, share - base AS gain, base FROM shares", "language_detected": DETECTED}
