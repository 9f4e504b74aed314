"""Language by character trigrams: naive Bayes over a table of log shares that is learned from labelled rows, for as many languages as the
labels name. Texts are scored by a join on the trigram and a sum; nothing is collected.

Letters: A-Z lower-cased, everything in ASCII that is no letter becomes one blank, a blank before and after. Log shares are whole
numbers (millionths), so sums are the same on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_LETTERS = r"[\x00-\x60\x7B-\x7F]+"
#: A trigram is kept for a language if it makes up one of so many of its trigrams; so a language has at most that many.
RAREST = 10_000
SCALE = 1_000_000
UNKNOWN = "und"


def letters(text: Column) -> Column:
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), NO_LETTERS, " ")), F.lit(" "))


def trigrams(text: Column) -> Column:
    """All runs of three characters, by three passes that each take every third one: time in proportion to the text, however long."""
    spelled = letters(text)
    passes = [F.regexp_extract_all(F.substring(spelled, k, 2**31 - 1), F.lit("(?s)..."), F.lit(0)) for k in (1, 2, 3)]
    return F.concat(*passes)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, gain, base): `base` is the log share of a trigram that the language does not know, `gain` how much more
    a known one has. Rows without a label or a letter teach nothing."""
    seen = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.explode(trigrams(F.col(text))).alias("gram"))
    counts = seen.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    known = counts.join(totals, "lang").where(F.col("n") * RAREST >= F.col("total"))
    share = lambda n: F.round(F.log(n / F.col("total")) * SCALE).cast("long")
    base = share(F.lit(0.5))
    return known.select("lang", "gram", (share(F.col("n").cast("double")) - base).alias("gain"), base.alias("base"))


def identify(rows: DataFrame, model: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, detected, margin): the language of the highest sum, ties to the first by name, and by how much a trigram it is ahead of the
    second (null if there is none). `und` without a letter or where no trigram is known. The key names a text: rows of equal
    keys count as one text."""
    spelled = rows.select(F.col(key).alias("_key"), F.explode(trigrams(F.col(text))).alias("gram"))
    lengths = rows.select(F.col(key).alias("_key"), F.greatest(F.length(letters(F.col(text))) - 2, F.lit(0)).cast("long").alias("n"))
    gains = spelled.join(model.select("lang", "gram", "gain"), "gram").groupBy("_key", "lang").agg(F.sum("gain").alias("gain"))
    sizes = lengths.groupBy("_key").agg(F.sum("n").alias("n"))
    bases = model.select("lang", "base").distinct()
    met = gains.join(sizes, gains["_key"].eqNullSafe(sizes["_key"])).select(gains["_key"], "lang", "gain", "n")
    summed = met.join(bases, "lang").select("_key", "lang", (F.col("gain") + F.col("n") * F.col("base")).alias("score"))
    # a language none of whose trigrams occurs is behind every other one, but for its base: it is not asked
    ranked = summed.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("loss"), "lang"))).alias("best"))
    out = sizes.join(ranked, sizes["_key"].eqNullSafe(ranked["_key"]), "left").select(sizes["_key"], "n", "best")
    ahead = (F.get("best", F.lit(1))["loss"] - F.get("best", F.lit(0))["loss"]) / (F.col("n") * SCALE)
    return out.select(F.col("_key").alias(key), F.coalesce(F.get("best", F.lit(0))["lang"], F.lit(UNKNOWN)).alias("detected"), F.round(ahead, 6).alias("margin"))
