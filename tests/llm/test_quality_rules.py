"""Quality rules against plain counts, exact binomial sums and a plain choice of cutoffs."""

import collections
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

import check
from newsloom.llm import quality_rules as Q

WORD = r"[^\x20\x09-\x0D]+"


def plain_counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = collections.Counter(grams)
    again = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), len(lines))


def measured(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, n string, good int")
    return Q.measure(frame)


TEXTS = [
    None, "", " \n\t", "a", "a b c d e", "a b c d e a b c d e", "x " * 40, "a b c d e f a b c d e g b c d e f",
    "line\nline\n line\n\n\nline", "\n\r\n \x0b\x0c\n", "é 日本 𝔘nicode #*$%&|<>", "a\x0bb\x0cc\rd", "no break space",
    "one two three four five six one two three four five", "#" * 50, "<p>|</p> & % $",
]


def test_counts(spark):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("ab \n#\x0b") for _ in range(rng.randrange(200))) for _ in range(300)]
    got = measured(spark, [(i, t, "en", None, 1) for i, t in enumerate(texts)]).collect()
    assert len(got) == len(texts)
    for r in got:
        expected = plain_counts(texts[r.doc_id])
        assert tuple(r[c] for c in Q.COUNTS) == expected, texts[r.doc_id]
        assert r.base_failed == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])


@pytest.mark.parametrize("text", ["word " * 200_000, "\n" * 1_000_000, "".join(f"w{i % 40_000} " for i in range(120_000)), "#" * 1_000_000])
def test_long_texts_take_time_in_proportion(spark, text):
    start = time.time()
    r = measured(spark, [(1, text, "en", None, 1)]).collect()[0]
    assert time.time() - start < 20 and tuple(r[c] for c in Q.COUNTS) == plain_counts(text)


def exact_allowed(n, share, level):
    """By sums of exact whole numbers."""
    from fractions import Fraction

    p = Fraction(share)
    total, best = Fraction(0), -1
    for k in range(int(n * share) + 1):
        total += math.comb(n, k) * p**k * (1 - p) ** (n - k)
        if total > Fraction(level):
            break
        best = k
    return best


@pytest.mark.parametrize("n", [1, 50, 296, 297, 298, 299, 300, 1000, 2500])
@pytest.mark.parametrize("share, level", [(0.01, 0.002), (0.01, 0.05), (0.2, 0.01)])
def test_binomial_bound(spark, n, share, level):
    k = spark.range(1).select(Q.allowed_rejections(F.lit(n).cast("long"), share, F.lit(level))).first()[0]
    assert k == exact_allowed(n, share, level)


def test_binomial_bound_of_many(spark):
    """Far beyond what can be summed from 0: the normal quantile tells the place."""
    n, share, level = 200_000_000, 0.01, 0.002
    k = spark.range(1).select(Q.allowed_rejections(F.lit(n).cast("long"), share, F.lit(level))).first()[0]
    assert k == pytest.approx(n * share - 2.8782 * math.sqrt(n * share * (1 - share)), abs=10)


def plain_cutoffs(rows, alpha, delta):
    """rows: (stratum, good, values). {stratum: {rule: cutoff}}, chosen round by round."""
    out = {}
    groups = {s: [(g, v) for t, g, v in rows if t == s] for s in {t for t, _, _ in rows}}
    tests = len(groups) * len(Q.RULES)
    for s, members in groups.items():
        n_good, n_bad = sum(g for g, _ in members), sum(1 - g for g, _ in members)
        allowed, chosen = exact_allowed(n_good, alpha / len(Q.RULES), delta / tests), {}
        for _ in Q.RULES:
            left = [(g, v) for g, v in members if not any(v[r] > c for r, c in chosen.items())]
            best = None
            for rule in range(len(Q.RULES)):
                for cutoff in {v[rule] for _, v in members}:
                    if sum(g for g, v in members if v[rule] > cutoff) > allowed:
                        continue
                    gain = sum(1 - g for g, v in left if v[rule] > cutoff) * n_good - sum(g for g, v in left if v[rule] > cutoff) * n_bad
                    if gain > 0 and (best is None or (gain, cutoff, -rule) > best):
                        best = (gain, cutoff, -rule)
            if best is None:
                break
            chosen[-best[2]] = best[1]
        out[s] = chosen
    return out


def made_up(seed, n):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "fr", None])
        good = int(rng.random() < 0.7)
        kind = 0 if good else rng.randrange(3)  # the bad have long words, or symbols, or nothing to tell them by
        words = [rng.choice("abcdefgh") * rng.choice([2, 9, 14] if kind == 1 else [2, 3, 5, 8]) for _ in range(rng.randrange(8, 60))]
        if kind == 2 or rng.random() < 0.01:
            words = [w[1:] + rng.choice("#$") for w in words]
        rows.append((i, " ".join(words) + rng.choice(["", "\nend\nend"]), lang, "x", 3))
        if rng.random() < 0.9:
            labels.append((i, good))
    return rows, labels


def test_cutoffs_against_plain(spark):
    rows, labels = made_up(5, 900)
    m = measured(spark, rows)
    found = Q.learn(m, spark.createDataFrame(labels, "doc_id long, quality int"), alpha=0.3, delta=0.1).collect()
    by_id = {r.doc_id: r for r in m.select("*", F.array(*[Q.grid_value(x) for x in Q.RULES]).alias("v")).collect()}
    held = [(by_id[i].stratum, g, by_id[i].v) for i, g in labels if not by_id[i].base_failed]
    expected = plain_cutoffs(held, 0.3, 0.1)
    got = {s: {r.rule: r.cutoff for r in found if r.stratum == s and r.rule is not None} for s in expected}
    assert got == expected and any(len(c) > 1 for c in got.values())
    judged = Q.judge(m, spark.createDataFrame(found, "stratum string, rule int, cutoff long, a long, b long, c long, d double")).collect()
    for r in judged:
        broken = [Q.RULES[k][0] for k, c in sorted(expected[r.stratum].items()) if by_id[r.doc_id].v[k] > c]
        assert r.rejected_by == (["base"] if r.base_failed else broken) and r.kept == (not r.rejected_by)


def test_false_rejections_stay_within_the_bound(spark):
    """On fresh rows of the same kind no stratum loses more good documents than alpha."""
    rows, labels = made_up(11, 1500)
    fresh, truth = made_up(12, 1500)
    cutoffs = Q.learn(measured(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"), alpha=0.2)
    good = {i for i, g in truth if g}
    judged = [r for r in Q.judge(measured(spark, fresh), cutoffs).collect() if r.doc_id in good and not r.base_failed]
    for stratum in ("en", "fr", None):
        own = [r.kept for r in judged if r.stratum == stratum]
        assert own.count(False) <= 0.2 * len(own)
    caught = [r.kept for r in Q.judge(measured(spark, fresh), cutoffs).collect() if r.doc_id in {i for i, g in truth if not g}]
    assert caught.count(False) > 0.4 * len(caught)


def test_small_strata_share_cutoffs(spark):
    rows, labels = made_up(7, 1200)
    rows = [(i, t, f"l{i}" if lang == "fr" else lang, n, g) for i, t, lang, n, g in rows]
    m = measured(spark, rows)
    found = Q.learn(m, spark.createDataFrame(labels, "doc_id long, quality int"), alpha=0.3).collect()
    alone = {r.stratum for r in found}
    assert len(alone) <= 1001


def test_odd_labels(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(1, text, "en", "x", 1), (1, text, "en", "x", 1), (2, text, None, "x", 1), (None, text, "en", "x", 1), (3, None, "en", "x", 1)]
    m = measured(spark, rows)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (2, 1), (None, 1), (3, None), (3, 7), (9, 1)], "doc_id long, quality int")
    held = Q.holdout(m, labels)
    assert [(r.doc_id, r.good) for r in held.collect()] == [(1, 1), (1, 1)]
    judged = Q.judge(m, Q.learn(m, labels)).collect()
    assert sorted((r.doc_id or 0, r.kept) for r in judged) == [(0, True), (1, True), (1, True), (2, True), (3, False)]


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_empty_tables(spark, rows):
    m = measured(spark, rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [(r.kept, r.rejected_by) for r in Q.judge(m, Q.learn(m, none)).collect()] == [(False, ["base"])] * len(rows)


def test_query_against_sql(spark, sf):
    from newsloom.llm.queries import ORACLES, QUERIES

    assert check.compare(QUERIES["op11_risk_quality"](spark, sf), check.connect(sf), ORACLES["op11_risk_quality"]) is None


def test_only_built_in_functions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    m = Q.measure(docs)
    plan = Q.judge(m, Q.learn(m, spark.read.parquet(f"{sf}/labels.parquet")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
