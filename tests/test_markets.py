"""The index-based match against scoring every event for every article."""

import random

from pyspark.sql import functions as F

from newsloom.operators import markets
from newsloom.sources import tables

EVENT = "event_pos long, title string"


def brute_score(title, terms):
    low = title.lower()
    return sum((t in low) * 1.0 + (f" {t} " in f" {low} ") * 0.5 for t in terms)


def brute_best(searches, events, floor):
    best = {}
    for key, terms in searches:
        top = max(((brute_score(t, set(terms)), -pos) for pos, t in events), default=None)
        if top and top[0] >= floor:
            best[key] = (top[0], -top[1])
    return best


def words(rng, n):
    pool = ["war", "warming", "oil", "oil-price", "internationalisation", "internationalisations", "us", "a", "gaza,", "trump's"]
    return [rng.choice(pool) + ("" if rng.random() < 0.7 else rng.choice(["s", "x", ".", "internationalisation"])) for _ in range(n)]


def test_match_equals_brute_force(spark):
    rng = random.Random(11)
    events = [(i, " ".join(words(rng, 6)) + ("\n" if i % 5 == 0 else " ") + words(rng, 1)[0]) for i in range(30)]
    searches = [(f"s{i}", list(dict.fromkeys(words(rng, rng.randint(0, 5))))) for i in range(300)]
    ev = spark.createDataFrame(events, EVENT).withColumns({"active": F.lit(True), "closed": F.lit(False)})
    se = spark.createDataFrame(searches, "id string, terms array<string>")
    for floor in (0.5, 2.0):
        got = {r["id"]: (r["score"], r["event_pos"]) for r in markets.best_events(se, "id", "terms", ev, floor).collect()}
        assert got == brute_best(searches, events, floor)


def test_no_pairwise_plan(spark, sf):
    events = tables.market_events(spark, sf)
    se = spark.createDataFrame([("a", ["the"])], "id string, terms array<string>")
    plan = markets.best_events(se, "id", "terms", events, 2.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def event(pos, title, slug="", ticker="", volume=1.0, prices="['0.3','0.7']", nested=()):
    m = [(n + 1, f"q{n}", v, p, f"/m/{n}", a, c) for n, (v, p, a, c) in enumerate(nested)]
    return (pos, title, slug, ticker, volume, f"/e/{pos}", prices, True, False, m)


SCHEMA = (
    "event_pos long, title string, slug string, ticker string, volume double, url string, outcomePrices string, active boolean, "
    "closed boolean, markets array<struct<market_no: long, question: string, volume: double, outcomePrices: string, url: string, "
    "active: boolean, closed: boolean>>"
)


def test_best_market_per_event(spark):
    rows = [
        event(0, "A", slug="a", nested=[(5.0, "['0.1','0.9']", True, False), (9.0, "['0.2','0.8']", True, False)]),
        event(1, "B", ticker="b", nested=[(5.0, "['0.4']", True, False), (9.0, "['0.9']", True, True), (5.0, "['0.8']", True, False)]),
        event(2, "C", slug="c", nested=[(None, "['0.6']", True, False)]),
        event(3, "D", slug="d"),
        event(4, "E", nested=[(5.0, "['0.4']", True, False)]),  # neither slug nor ticker: nothing can be looked up
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r["event_pos"]: r for r in markets.best_markets(df, markets.nested_markets(df)).collect()}
    assert [out[i]["prob"] for i in range(5)] == [0.2, 0.4, 0.6, 0.3, 0.3]
    assert out[2]["volume_usd"] == 1.0 and out[3]["market_url"] == "/e/3" and out[0]["market_url"] == "/m/1"
    nested = {r["event_pos"]: r["prob"] for r in markets.best_nested_market(df).collect()}
    assert nested == {0: 0.2, 1: 0.9, 2: 0.6, 3: 0.3, 4: 0.4}


def test_at_most_ten_markets_are_listed(spark):
    df = spark.createDataFrame([event(0, "A", slug="a", nested=[(float(i), "['0.5']", True, False) for i in range(14)])], SCHEMA)
    listed = markets.markets_for_events(df, markets.nested_markets(df))
    assert listed.count() == 10 and listed.agg(F.max("market_no")).first()[0] == 10


def test_article_threshold_and_defaults(spark):
    events = spark.createDataFrame([event(0, "Trump and the war", slug="x"), event(1, "Gaza war talks", slug="y")], SCHEMA)
    articles = spark.createDataFrame(
        [("1", "Guerre: Trump parle"), ("2", "Only war here"), ("3", ""), ("4", None), ("5", "Gaza war talks resume")],
        "article_id string, titre_clean string",
    )
    out = {r["article_id"]: r for r in markets.enrich(articles, events, markets.nested_markets(events)).collect()}
    assert out["1"]["polymarket_question"] == "Trump and the war" and out["1"]["polymarket_prob_pct"] == "30.0%"
    assert out["5"]["polymarket_question"] == "Gaza war talks"
    for i in "234":
        assert out[i]["polymarket_question"] == "" and out[i]["polymarket_prob"] is None


def test_topics_need_any_hit(spark):
    events = spark.createDataFrame([event(0, "Morocco cup", slug="x")], SCHEMA)
    labels = spark.createDataFrame([("2_maroc_football",), ("hors-sujet",), ("-1_noise",), ("",), (None,), ("4_xyz",)], "topic_label string")
    out = markets.match_topics(labels, events, markets.nested_markets(events)).collect()
    assert [(r["topic_label"], r["search_term"], r["probability"]) for r in out] == [("2_maroc_football", "football, maroc, morocco", 0.3)]


def test_entity_bets_and_fallback(spark):
    rows = [event(i, t) for i, t in enumerate(["Iran deal", "IRAN deal", "Tehran summit", "Iranian vote", "x iran 1", "x iran 2", "x iran 3"])]
    events = spark.createDataFrame(rows, SCHEMA)
    bets = markets.entity_bets(events).orderBy("bet_no").collect()
    assert [b["question"] for b in bets] == ["Iran deal", "Iranian vote", "x iran 1", "x iran 2", "x iran 3"]
    articles = spark.createDataFrame(
        [("Iran", "s1", 0.9, "q?", 1), ("Maroc", "s1", 0.7, "q1", 2), ("Maroc", "s2", None, "q1", 3), ("Maroc", "s2", 0.1, "q2", 4), ("France", "s1", None, "", 5)],
        "entity string, source string, poly_prob double, poly_q string, arrival long",
    )
    groups = {r["entity"]: r for r in markets.entity_groups(articles, events).collect()}
    assert groups["Iran"]["bet_count"] == 5 and groups["Iran"]["signal"] == 0.3
    assert groups["Maroc"]["bet_count"] == 2 and groups["Maroc"]["signal"] == 0.7 and groups["Maroc"]["sources"] == "s1,s2"
    assert groups["France"]["bet_count"] == 0 and groups["France"]["signal"] == 0.0


def test_closed_events_are_never_matched(spark):
    live, closed, idle = event(1, "oil war"), event(0, "oil war now"), event(2, "war oil gaza")
    rows = [live, closed[:8] + (True,) + closed[9:], idle[:7] + (False,) + idle[8:]]
    events = spark.createDataFrame(rows, SCHEMA)
    searches = spark.createDataFrame([("s", ["oil", "war", "gaza", "now"])], "id string, terms array<string>")
    assert [tuple(r) for r in markets.best_events(searches, "id", "terms", events, 1.0).collect()] == [("s", 3.0, 1)]
    iran = [event(1, "Iran deal"), event(0, "Iran war")[:8] + (True, [])]
    assert [b["question"] for b in markets.entity_bets(spark.createDataFrame(iran, SCHEMA)).collect()] == ["Iran deal"]


def test_bets_of_events_without_own_markets_ask_the_landed_ones(spark):
    events = spark.createDataFrame([event(1, "Iran deal", slug="deal"), event(2, "Iran vote", slug="vote")], SCHEMA)
    landed = spark.createDataFrame(
        [("deal", None, 1, "q", 5.0, "['0.8','0.2']", "/m", True, False), ("deal", None, 2, "q", 9.0, "['0.9','0.1']", "/m", True, True)],
        "slug string, tag string, market_no long, question string, volume double, outcomePrices string, url string, active boolean, closed boolean",
    )
    assert {b["question"]: b["probability"] for b in markets.entity_bets(events, landed).collect()} == {"Iran deal": 0.8, "Iran vote": 0.3}


def test_index_grows_in_line_with_titles(spark):
    sizes = []
    for n in (50, 500):
        title = " ".join(f"word{i:04d}" for i in range(n))
        places, grams = markets.title_index(spark.createDataFrame([(1, title)], "event_pos long, title string"))
        sizes.append(places.count() + grams.count())
    assert sizes[1] <= 11 * sizes[0]  # squared growth would be 100 times


def test_frequent_terms_are_dealt_to_many_tasks(spark):
    """Each of 400 searches meets each of 40 events: no task holds more than its share of the pairs, however the events reach it."""
    rng = random.Random(5)
    events = [(i, "the " + " ".join(words(rng, 4))) for i in range(40)]
    searches = [(f"s{i}", list(dict.fromkeys(["the", *words(rng, 3)]))) for i in range(400)]
    ev = spark.createDataFrame(events, EVENT).withColumns({"active": F.lit(True), "closed": F.lit(False)})
    se = spark.createDataFrame(searches, "id string, terms array<string>")
    one_term = se.select("id", F.explode("terms").alias("term"))
    known = markets.term_events(one_term.select("term").distinct(), ev)
    for sent in (0, 10_000):
        met = markets.met_events(one_term, "id", known, 1_000, sent)
        pairs = met.count()
        per_task = [r.n for r in met.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert pairs >= 16_000 and len(per_task) >= pairs // 1_500 and max(per_task) < 4_000
        got = {r["id"]: (r["score"], r["event_pos"]) for r in markets.best_events(se, "id", "terms", ev, 2.0, per_task=1_000, sent=sent).collect()}
        assert got == brute_best(searches, events, 2.0)
