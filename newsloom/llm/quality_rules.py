"""Quality rules whose cutoffs limit the share of good documents they reject.

Each text has a few statistics, which fixed base rules and further rules judge. A further rule rejects a text whose
statistic lies beyond a cutoff of the text's stratum (its language). Cutoffs come from labelled documents that pass the base rules, the holdout: in a stratum
with n good ones, a cutoff that rejects k of them is certified when P(Binomial(n, share) <= k) <= `delta` / (rules x strata),
the exact test that its true rate of false rejections lies above `share` = `alpha` / rules. By Bonferroni's correction all certified cutoffs hold together with confidence
1 - `delta`: in no stratum do the rules reject more than `alpha` of the good documents. A laxer cutoff than a certified one is certified as well, so
the same holdout may choose among them. It does so in rounds: each adds, per stratum, the rule and certified cutoff that rejects the largest share of the bad documents
still kept beyond the share of the good ones. A rule that adds nothing, or has no certified cutoff, rejects nothing there.

Strata that hold less than a thousandth of the good holdout, and documents without a stratum, share one: so strata are 1,001 at most, which bounds
what is broadcast. Statistics are cut on a grid of whole numbers (permille, clamped at LAST), so cutoffs come from counts per grid value.

A null text has no words and fails the base rules. Rows are judged alone, repeated ones each; a row without id is judged, but never
labelled. Ids whose labels disagree, and labels that are null or neither 0 nor 1, take no part; repeated rows of a
labelled id count each. Empty tables give no rows, and without labels only the base rules reject. Ties between cutoffs go to
the laxer one. Other columns are not read. Windows of words are told apart by 64-bit hashes. Only built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from newsloom.llm.common import let, ship, stored

ship(__name__)

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
ALPHA = 0.05  # of the good documents of a stratum, all rules together
DELTA = 0.05
SMALL_STRATUM = 0.001
LAST = 20_000  # of the grid
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: name, numerator, denominator (share in permille), and +1 where high values are bad, -1 where low ones are
RULES = (
    ("long_words", "word_chars", "n_words", 1),
    ("short_words", "word_chars", "n_words", -1),
    ("symbols", "n_symbols", "n_words", 1),
    ("duplicate_lines", "n_dup_lines", "n_lines", 1),
    ("repeated_words", "n_repeat_words", "n_words", 1),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a window found twice or more. Hashes that all differ need no more; else they are
    sorted with their places, equal neighbours are the repeated windows, and sorted again by
    place each adds the words that the one before it does not cover: no step takes more than the sort."""

    def at(hashes):
        return F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(pairs):
        same = lambda a, b: F.coalesce(F.get(pairs, a)["h"] == F.get(pairs, b)["h"], F.lit(False))
        again = F.filter(pairs, lambda p, j: same(j, j + 1) | F.when(j > 0, same(j, j - 1)).otherwise(False))
        return F.array_sort(F.transform(again, lambda p: p["i"]))

    def covered(starts):
        step = F.transform(starts, lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - s, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda total, x: total + x)

    def count(hashes):
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(at(hashes), lambda pairs: let(places(pairs), covered))
        )

    def windows(w):
        last = F.size(w) - WINDOW
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(let(windows(words), count))


def counts(text: Column) -> Column:
    """All counts of a text as one struct."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    long = lambda c, name: c.cast("long").alias(name)
    return let(
        F.struct(words_of(text).alias("w"), lines.alias("l")),
        lambda x: F.struct(
            long(F.size(x["w"]), "n_words"),
            long(F.length(F.array_join(x["w"], "")), "word_chars"),
            long(F.length(text) - F.length(F.translate(text, SYMBOLS, "")), "n_symbols"),
            long(F.size(x["l"]) - F.size(F.array_distinct(x["l"])), "n_dup_lines"),
            long(repeated_words(x["w"]), "n_repeat_words"),
            long(F.size(x["l"]), "n_lines"),
        ),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def measure(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", stratum_column: str | None = "lang") -> DataFrame:
    """Per row: doc_id, stratum, the counts and base_failed."""
    stratum = F.col(stratum_column).cast("string") if stratum_column else F.lit("all")
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), stratum.alias("stratum"), counts(text).alias("c"))
    return rows.select("doc_id", "stratum", *[F.col("c")[c].alias(c) for c in COUNTS]).withColumn("base_failed", base_failed())


def grid_value(rule: tuple) -> Column:
    """The statistic of a rule as a whole number, larger for worse."""
    _, top, bottom, sign = rule
    share = F.least(F.lit(LAST), F.floor(F.lit(1000) * F.col(top) / F.greatest(F.col(bottom), F.lit(1))))
    return (share * sign).cast("long")


def holdout(measured: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality") -> DataFrame:
    """The measured rows that pass the base rules and have a label, with `good` (1 or 0)."""
    label = F.col(label_column).cast("int")
    agreed = (
        labels.where(F.col(id_column).isNotNull() & label.isin(0, 1))
        .groupBy(F.col(id_column).alias("doc_id"))
        .agg(F.min(label).alias("good"), F.max(label).alias("most"))
        .where("good = most")
        .drop("most")
    )
    return measured.where("NOT base_failed AND doc_id IS NOT NULL").join(agreed, "doc_id")


def pooled(held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The holdout with null as the stratum of all that do not stand alone, and the strata that do: those of
    a thousandth of the good documents or more."""
    good = held.where("good = 1")
    sizes = good.where("stratum IS NOT NULL").groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    total = good.agg(F.count(F.lit(1)).alias("total"))
    alone = stored(sizes.join(F.broadcast(total)).where(F.col("n") >= SMALL_STRATUM * F.col("total")).select("stratum"), "quality-strata")
    own = alone.withColumn("own", F.col("stratum"))
    return held.join(F.broadcast(own), "stratum", "left").withColumn("stratum", F.col("own")).drop("own"), alone


def allowed_rejections(n: Column, share: float, level: Column) -> Column:
    """The largest k with P(Binomial(n, share) <= k) <= level, or -1. Terms are added from twelve standard deviations
    below the mean on (from 0 for small n), where less than 1e-30 lies; the first one is exact for 0 and else by Loader's form of the binomial."""
    spread = F.sqrt(n * share * (1 - share))
    first = F.greatest(F.lit(0), F.floor(n * share - 12 * spread)).cast("long")
    last = F.floor(n * share).cast("long")

    def stirling_rest(x):  # of log x!, for x >= 16; all three arguments are larger wherever it is used
        return 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3))) + 1 / (1260 * F.pow(x, F.lit(5)))

    def deviance(x, mean):
        return x * F.log(x / mean) + mean - x

    def start(k):
        rest = n - k
        loader = stirling_rest(n) - stirling_rest(k) - stirling_rest(rest) - deviance(k, n * share) - deviance(rest, n * (1 - share))
        return F.when(k == 0, F.exp(n * F.log(F.lit(1 - share)))).otherwise(F.exp(loader) * F.sqrt(n / (2 * F.lit(3.141592653589793) * k * rest)))

    def step(s, k):
        total = s["total"] + s["term"]
        following = s["term"] * (n - k) / (k + 1) * (share / (1 - share))
        return F.struct(following.alias("term"), total.alias("total"), F.when(total <= level, k).otherwise(s["best"]).alias("best"))

    begin = F.struct(start(first).alias("term"), F.lit(0.0).alias("total"), F.lit(-1).cast("long").alias("best"))
    return F.aggregate(F.sequence(first, last), begin, step)["best"]


def next_cutoffs(held: DataFrame, chosen: DataFrame, alpha: float, delta: float) -> DataFrame:
    """Per stratum the certified cutoff that adds most to those chosen: the largest share of the bad documents still kept beyond
    the share of the good ones."""
    kept = judge(held, chosen).select("stratum", "good", F.col("kept").cast("long").alias("left"), F.explode(
        F.array(*[F.struct(F.lit(i).alias("rule"), grid_value(r).alias("value")) for i, r in enumerate(RULES)])).alias("x"))
    counted = kept.groupBy("stratum", "x.rule", "x.value").agg(
        F.sum("good").alias("good"), F.count(F.lit(1)).alias("n"), F.sum(F.col("good") * F.col("left")).alias("left_good"),
        F.sum((1 - F.col("good")) * F.col("left")).alias("left_bad"))
    sizes = counted.where("rule = 0").groupBy("stratum").agg(F.sum("good").alias("n_good"), (F.sum("n") - F.sum("good")).alias("n_bad"))
    tests = sizes.select((F.count(F.lit(1)) * len(RULES)).alias("tests"))
    bounds = sizes.join(F.broadcast(tests)).where("n_good > 0").select(
        F.col("stratum").alias("of"), "n_good", "n_bad", allowed_rejections(F.col("n_good"), alpha / len(RULES), F.lit(delta) / F.col("tests")).alias("allowed"))
    beyond = W.partitionBy("stratum", "rule").orderBy(F.col("value").desc()).rowsBetween(W.unboundedPreceding, -1)
    cuts = counted.withColumns({c: F.coalesce(F.sum(c).over(beyond), F.lit(0)) for c in ("good", "left_good", "left_bad")})
    gain = F.col("left_bad") * F.col("n_good") - F.col("left_good") * F.col("n_bad")
    fit = cuts.join(F.broadcast(bounds), F.col("stratum").eqNullSafe(F.col("of"))).where((F.col("good") <= F.col("allowed")) & (gain > 0))
    facts = F.struct("rule", F.col("value").alias("cutoff"), "n_good", F.col("good").alias("n_rejected_good"), "allowed",
                     (F.col("left_bad") / F.col("n_bad")).alias("share_bad"))
    return fit.groupBy("stratum").agg(F.max_by(facts, F.struct(gain, "value", -F.col("rule"))).alias("x")).select("stratum", "x.*")


def learn(measured: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality",
          alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff, n_good, n_rejected_good, allowed, share_bad): a text with a larger grid value is rejected.
    The rows of stratum null hold for all strata that do not stand alone; one that stands alone without a cutoff is listed
    with a null rule. At most 1,001 strata times the rules, found in as many rounds as there are rules, one for each stratum at a time."""
    held, alone = pooled(stored(holdout(measured, labels, id_column, label_column), "quality-holdout"))
    held = stored(held, "quality-holdout")
    chosen = alone.selectExpr("stratum", "int(null) AS rule", "bigint(null) AS cutoff", "bigint(null) AS n_good", "bigint(null) AS n_rejected_good",
                              "bigint(null) AS allowed", "double(null) AS share_bad")
    for _ in RULES:
        added = stored(next_cutoffs(held, chosen, alpha, delta), "quality-cutoffs")
        if added.isEmpty():
            break
        chosen = chosen.unionByName(added)
    return chosen


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The measured rows with `rejected_by` (names of the rules, in order) and `kept`."""
    listed = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.when(F.col("rule").isNotNull(), F.struct("rule", "cutoff")))).alias("own"))
    alone, rest = listed.where("stratum IS NOT NULL"), listed.where("stratum IS NULL").select(F.col("own").alias("others"))
    limits = F.coalesce(F.col("own"), F.col("others"))
    rows = measured.join(F.broadcast(alone), "stratum", "left").join(F.broadcast(rest), how="left")
    broken = F.array_compact(F.array(*[F.when(grid_value(r) > F.try_element_at("_limits", F.lit(i)), F.lit(r[0])) for i, r in enumerate(RULES)]))
    judged = rows.withColumn("_limits", limits).withColumn("rejected_by", F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(broken))
    return judged.select(*measured.columns, "rejected_by", (F.size("rejected_by") == 0).alias("kept"))


def apply(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, id_column: str = "doc_id", text_column: str = "text",
          stratum_column: str | None = "lang") -> DataFrame:
    """Per row its counts, base_failed, rejected_by and kept. Texts are read once."""
    measured = stored(measure(docs, id_column, text_column, stratum_column), "quality-counts")
    return judge(measured, learn(measured, labels, alpha=alpha, delta=delta))


def oracle(alpha: float = ALPHA, delta: float = DELTA) -> str:
    """The query's rows in DuckDB: each round of `next_cutoffs` is a table of its own."""
    share, blank = alpha / len(RULES), r"[ \t\n\x0B\f\r]"
    value = lambda r: f"least({LAST}, 1000 * {r[1]} // greatest({r[2]}, 1)) * {r[3]}"
    values = " UNION ALL ".join(f"SELECT hid, own, good, {i} AS rule, {value(r)} AS value FROM held" for i, r in enumerate(RULES))
    pmf = f"exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({share}) + (n_good - i) * ln({1 - share}))"
    rounds, chosen = [], "SELECT NULL::VARCHAR AS stratum, -1 AS rule, 0 AS cutoff WHERE false"
    for k in range(len(RULES)):
        rounds.append(f"""
chosen{k} AS MATERIALIZED ({chosen}),
gone{k} AS MATERIALIZED (SELECT DISTINCT hid FROM v JOIN chosen{k} c ON v.own IS NOT DISTINCT FROM c.stratum AND v.rule = c.rule AND v.value > c.cutoff),
cut{k} AS (SELECT own, v.rule, value, sum(sum(good)) OVER w AS g, sum(sum(good) FILTER (hid NOT IN (FROM gone{k}))) OVER w AS lg,
    sum(sum(1 - good) FILTER (hid NOT IN (FROM gone{k}))) OVER w AS lb FROM v GROUP BY own, rule, value
    WINDOW w AS (PARTITION BY own, rule ORDER BY value DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
gain{k} AS (SELECT c.*, coalesce(lb, 0) * n_good - coalesce(lg, 0) * n_bad AS gain FROM cut{k} c JOIN bound b ON c.own IS NOT DISTINCT FROM b.own WHERE coalesce(g, 0) <= allowed),
best{k} AS MATERIALIZED (SELECT own AS stratum, rule, value AS cutoff FROM gain{k} WHERE gain > 0
    QUALIFY row_number() OVER (PARTITION BY own ORDER BY gain DESC, value DESC, rule) = 1)""")
        chosen = f"FROM chosen{k} UNION ALL FROM best{k}"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
parts AS MATERIALIZED (SELECT *, list_filter(regexp_split_to_array(t, '{blank}+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS l FROM d),
windows AS (SELECT rid, unnest(range(1, len(w) - {WINDOW - 2})) AS i, unnest(list_transform(range(1, len(w) - {WINDOW - 2}),
  lambda i: array_to_string(w[i:i + {WINDOW - 1}], ' '))) AS g FROM parts),
again AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
repeated AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, range({WINDOW}) AS o(k) GROUP BY rid),
counted AS (SELECT rid, doc_id, lang, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
  coalesce(n, 0) AS n_repeat_words FROM parts LEFT JOIN repeated USING (rid)),
m AS MATERIALIZED (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM counted),
agreed AS (SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY doc_id HAVING min(quality) = max(quality)),
labelled AS MATERIALIZED (SELECT * FROM m JOIN agreed USING (doc_id) WHERE NOT base_failed),
alone AS MATERIALIZED (SELECT lang AS own FROM labelled WHERE lang IS NOT NULL GROUP BY lang
  HAVING sum(good) > 0 AND sum(good) >= {SMALL_STRATUM} * (SELECT sum(good) FROM labelled)),
held AS MATERIALIZED (SELECT rid AS hid, l.*, a.own FROM labelled l LEFT JOIN alone a ON l.lang = a.own),
v AS MATERIALIZED ({values}),
sizes AS (SELECT own, sum(good) AS n_good, sum(1 - good) AS n_bad, {len(RULES)} * count(*) OVER () AS tests FROM held GROUP BY own),
bound AS MATERIALIZED (SELECT *, coalesce(list_max(list_filter(range(CAST(floor(n_good * {share}) AS BIGINT) + 1),
  lambda k: list_sum(list_transform(range(k + 1), lambda i: {pmf})) <= {delta} / tests)), -1) AS allowed FROM sizes WHERE n_good > 0),
{",".join(rounds)},
cutoffs AS MATERIALIZED ({chosen}),
rows AS (SELECT rid, doc_id, m.* EXCLUDE (rid, doc_id), a.own FROM m LEFT JOIN alone a ON m.lang = a.own),
judged AS (SELECT hid, own, rule, value FROM ({values.replace("good, ", "").replace("hid,", "rid AS hid,").replace("FROM held", "FROM rows")})),
rejected AS (SELECT DISTINCT hid FROM judged j JOIN cutoffs c ON j.own IS NOT DISTINCT FROM c.stratum AND j.rule = c.rule AND j.value > c.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rid NOT IN (FROM rejected) AS kept FROM rows
"""
