"""Matching articles and topics with prediction-market events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import rules
from newsloom.functions import numbers, text
from newsloom.operators.skew import top_n_per_key
from newsloom.session import written

MIN_ARTICLE_SCORE = 2.0
MAX_EVENTS = 200
MARKETS_PER_EVENT = 10
BETS_PER_ENTITY = 5
GRAM = 12
PAIRS_PER_TASK = 1 << 20  # (search, event) pairs that a task adds up
BROADCAST_PLACES = 1 << 19  # (term, event) rows that are sent to every task; more are met by shuffle


# ------------------------------------------------------------------- events
def live(df: DataFrame) -> DataFrame:
    """Active and open events or markets."""
    return df.where("active AND NOT closed")


def event_page(events: DataFrame, limit: int = MAX_EVENTS) -> DataFrame:
    """One page of live events, in listing order."""
    return live(events).orderBy("event_pos").limit(limit)


def nested_markets(events: DataFrame) -> DataFrame:
    """One row per nested market, with the keys it can be looked up by."""
    return events.select(
        F.nullif("slug", F.lit("")).alias("slug"),
        F.nullif("ticker", F.lit("")).alias("tag"),
        F.inline("markets"),
    )


def lookup_key(slug: Column, tag: Column) -> Column:
    """Markets are found by slug and, for events without one, by tag."""
    return F.coalesce(
        F.concat(F.lit("slug:"), F.nullif(slug, F.lit(""))),
        F.concat(F.lit("tag:"), F.nullif(tag, F.lit(""))),
    )


def listed_markets(events: DataFrame, markets: DataFrame) -> DataFrame:
    """All live markets of the events."""
    wanted = events.select("event_pos", lookup_key(F.col("slug"), F.col("ticker")).alias("market_key"))
    keyed = live(markets).withColumn("market_key", lookup_key(F.col("slug"), F.col("tag")))
    return wanted.join(keyed.drop("slug", "tag"), "market_key")


def markets_for_events(events: DataFrame, markets: DataFrame, limit: int = MARKETS_PER_EVENT) -> DataFrame:
    """Up to one page of live markets per event, as the source lists them."""
    found = listed_markets(events, markets)
    return top_n_per_key(found, ["event_pos"], [F.col("market_no")], limit, "listing_no")


def best_markets(events: DataFrame, markets: DataFrame) -> DataFrame:
    """Per event its market with most volume of all that were landed (first listed on
    ties); the event itself where there is none."""
    listed = listed_markets(events, markets)
    best = listed.groupBy("event_pos").agg(
        F.max_by(
            F.struct("market_no", "question", "volume", "outcomePrices", F.col("url").alias("url")),
            F.struct(F.coalesce("volume", F.lit(0.0)), -F.col("market_no")),
        ).alias("m")
    )
    m = F.col("m")
    own = m.isNull()
    return events.join(best, "event_pos", "left").select(
        "event_pos",
        "title",
        m["market_no"].alias("market_no"),
        numbers.outcome_price(F.when(own, F.col("outcomePrices")).otherwise(m["outcomePrices"])).alias("prob"),
        F.when(own, F.col("volume")).otherwise(F.coalesce(m["volume"], F.col("volume"), F.lit(0.0))).alias("volume_usd"),
        F.coalesce(F.when(own, F.col("url")).otherwise(m["url"]), F.lit("")).alias("market_url"),
    )


def best_nested_market(events: DataFrame) -> DataFrame:
    """The same choice made inside the event's own list, without a join."""
    ranked = F.transform(
        "markets",
        lambda m, i: F.struct(
            F.coalesce(m["volume"], F.lit(0.0)).alias("v"), (-i).alias("pos"), m["outcomePrices"].alias("prices")
        ),
    )
    best = F.array_max(ranked)
    prices = F.when(F.size("markets") > 0, best["prices"]).otherwise(F.col("outcomePrices"))
    return events.withColumn("prob", numbers.outcome_price(prices))


# ---------------------------------------------------------------- fuzzy join
def title_index(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where words stand and what they are made of: (word, event_pos, apart) for every
    word of an event title, `apart` if it stands between blanks; and (gram, word) for every part of up to GRAM
    characters of a word.

    A search term has no blanks, so it can only lie inside one word of the title.
    Listing the parts of each distinct word turns "title contains term" into an
    equality: no nested loop, no cross join. Both tables grow in line with the titles. A term meets the
    words on its first GRAM characters and is then checked against the word.
    """
    padded = F.concat(F.lit(" "), F.lower("title"), F.lit(" "))
    places = events.select("event_pos", padded.alias("_title"), F.explode(F.array_distinct(text.words(F.lower("title")))).alias("word")).where(
        "word <> ''"
    )
    apart = F.contains("_title", F.concat(F.lit(" "), "word", F.lit(" ")))
    at = places.select("word").distinct().withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("word"))))
    room = F.least(F.length("word") - F.col("_at") + 1, F.lit(GRAM))
    parts = at.withColumn("_n", F.explode(F.sequence(F.lit(1), room)))
    grams = parts.select("word", F.substring(F.col("word"), F.col("_at"), F.col("_n")).alias("gram")).distinct()
    return places.select("word", "event_pos", apart.alias("apart")), grams


def term_events(terms: DataFrame, events: DataFrame) -> DataFrame:
    """(term, event_pos, half) for every event whose title holds the term: 2 half points,
    3 if it also stands in the title as a word between blanks."""
    places, grams = title_index(events)
    words = terms.join(grams, F.substring("term", 1, GRAM) == F.col("gram")).where(F.contains("word", F.col("term")))
    half = F.when((F.col("word") == F.col("term")) & F.col("apart"), 3).otherwise(2)
    return words.select("term", "word").join(places, "word").groupBy("term", "event_pos").agg(F.max(half).cast("bigint").alias("half"))


def best_events(
    searches: DataFrame, key: str, terms: str, events: DataFrame, min_score: float, per_task: int = PAIRS_PER_TASK, sent: int = BROADCAST_PLACES
) -> DataFrame:
    """Per search (`key`, array column `terms`) the live event with the highest score;
    the earliest event wins ties.

    Terms are looked up once each, however many searches share them, and the searches meet
    (term, event, points) by term (see `met_events`). A frequent term meets many events, so the pairs are counted first and
    dealt by search to as many tasks as keep `per_task` pairs each. Score and position are packed in one long
    (half points above, position below): choosing is then a plain max.
    """
    # explode_outer, as plain explode has Spark work out the terms a second time, in a filter
    one_term = written(searches.select(key, F.explode_outer(terms).alias("term")).where("term IS NOT NULL"), "search-terms")
    known = written(term_events(one_term.select("term").distinct(), live(events)), "search-events")
    shift = F.lit(1 << 40)
    scored = (
        met_events(one_term, key, known, per_task, sent)
        .groupBy(key, "event_pos")
        .agg(F.sum("half").alias("_half"))
        .where(F.col("_half") >= int(min_score * 2))
    )
    packed = scored.groupBy(key).agg(F.max(F.col("_half") * shift - F.col("event_pos")).alias("_best"))
    half = F.shiftright(F.col("_best") + (shift - 1), 40)
    return packed.select(
        key,
        (half / 2.0).alias("score"),
        (half * shift - F.col("_best")).alias("event_pos"),
    )


def met_events(one_term: DataFrame, key: str, known: DataFrame, per_task: int, sent: int) -> DataFrame:
    """(key, event_pos, half) of each search's terms (key, term), dealt by key to tasks of about `per_task` rows. Up to `sent` rows of
    `known` (term, event_pos, half) are sent to the tasks. More meet the searches by shuffle, a term of more than `per_task` pairs in slices of
    its searches. Run-time re-planning would size these tasks by the rows they read, which are few, so their number is fixed."""
    spark = one_term.sparkSession
    listed = known.groupBy("term").agg(F.count(F.lit(1)).alias("_events"))
    meeting = one_term.groupBy("term").agg(F.count(F.lit(1)).alias("_n")).join(listed, "term").withColumn("_pairs", F.col("_n") * F.col("_events"))
    facts = meeting.agg(F.sum("_pairs").alias("pairs"), F.sum("_events").alias("places")).first()
    tasks = max(-(-(facts.pairs or 0) // per_task), spark.sparkContext.defaultParallelism)
    if (facts.places or 0) <= sent:
        return one_term.repartition(tasks, key).join(F.broadcast(known), "term").select(key, "event_pos", "half")
    # such terms are fewer than the tasks
    hot = F.broadcast(meeting.where(F.col("_pairs") > per_task).select("term", F.ceil(F.col("_pairs") / per_task).alias("_slices")))
    slices = F.coalesce("_slices", F.lit(1))
    dealt = one_term.join(hot, "term", "left").select(key, "term", F.pmod(F.xxhash64(key), slices).alias("_slice"))
    copied = known.join(hot, "term", "left").select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)).alias("_slice"))
    by = ["term", "_slice"]
    met = dealt.repartition(tasks, *by).join(copied.repartition(tasks, *by).hint("merge"), by)
    return met.select(key, "event_pos", "half").repartition(tasks, key)


def match_articles(articles: DataFrame, events: DataFrame, markets: DataFrame, title: str = "titre_clean") -> DataFrame:
    """article_id with score and the five market columns, for articles that match."""
    searches = articles.select("article_id", text.translated_title_terms(title).alias("terms"))
    found = best_events(searches, "article_id", "terms", events, MIN_ARTICLE_SCORE)
    chosen = best_markets(events, markets)
    return found.join(chosen, "event_pos").select(
        "article_id",
        "event_pos",
        "score",
        F.col("title").alias("polymarket_question"),
        F.col("prob").alias("polymarket_prob"),
        numbers.percent(F.col("prob")).alias("polymarket_prob_pct"),
        F.col("volume_usd").alias("polymarket_volume_usd"),
        F.col("market_url").alias("polymarket_url"),
    )


def enrich(articles: DataFrame, events: DataFrame, markets: DataFrame) -> DataFrame:
    """Left join of the match; unmatched articles keep the defaults."""
    match = match_articles(articles, events, markets).drop("event_pos", "score")
    return articles.join(match, "article_id", "left").withColumns(
        {c: F.coalesce(c, F.lit("")) for c in ("polymarket_question", "polymarket_prob_pct", "polymarket_url")}
    )


def match_topics(labels: DataFrame, events: DataFrame, markets: DataFrame, label: str = "topic_label") -> DataFrame:
    """Best event (any score above 0) per distinct topic label."""
    named = labels.select(label).distinct().withColumn("terms", text.label_search_terms(label))
    searches = text.evaluate_once(named, ["terms"]).where("terms IS NOT NULL")
    found = best_events(searches, label, "terms", events, 0.5)
    chosen = best_markets(events, markets)
    return (
        found.join(searches, label)
        .join(chosen, "event_pos")
        .select(
            label,
            "score",
            F.array_join("terms", ", ").alias("search_term"),
            F.col("title").alias("market_question"),
            numbers.round4(F.col("prob")).alias("probability"),
            numbers.percent(F.col("prob")).alias("probability_pct"),
            "volume_usd",
            F.col("market_url").alias("url"),
        )
    )


def drop_irrelevant(df: DataFrame) -> DataFrame:
    """Blank market columns whose question shares no word with the article."""
    ok = text.question_is_relevant("poly_q", "titre", "topic")
    blanked = [c for c in ("poly_prob", "poly_q", "polymarket_prob_pct") if c in df.columns]
    return df.withColumn("_ok", ok).withColumns({c: F.when(F.col("_ok"), F.col(c)) for c in blanked}).drop("_ok")


# ------------------------------------------------------------------ entities
def bet_prices(events: DataFrame, markets: DataFrame | None) -> DataFrame:
    """Events with the price of their best market: of their own list or, where that is
    empty, of the landed markets; without either the event's own price."""
    own = best_nested_market(events)
    if markets is None:
        return own
    looked_up = best_markets(events.where("coalesce(size(markets), 0) <= 0"), markets).select("event_pos", F.col("prob").alias("_prob"))
    return own.join(looked_up, "event_pos", "left").withColumn("prob", F.coalesce("_prob", "prob")).drop("_prob")


def entity_bets(events: DataFrame, markets: DataFrame | None = None, limit: int = BETS_PER_ENTITY) -> DataFrame:
    """First five live events per entity, by keyword then event order, titles once each.

    Each event is tested against the fixed keyword list inside its own row, so the
    events are read once and nothing is paired up.
    """
    low = F.lower("title")
    hits = []
    for entity, kws in rules.ENTITY_BET_KEYWORDS.items():
        first = F
        for pos, kw in enumerate(kws):
            first = first.when(F.contains(low, F.lit(kw)), F.lit(pos))
        hits.append(F.struct(F.lit(entity).alias("entity"), first.otherwise(F.lit(None)).alias("kw_pos")))
    found = (
        bet_prices(live(events).where("title <> ''"), markets)
        .select("event_pos", "title", "prob", F.col("volume"), "url", low.alias("_low"), F.inline(F.array(*hits)))
        .where("kw_pos IS NOT NULL")
    )
    once = found.groupBy("entity", "_low").agg(
        F.min_by(
            F.struct("kw_pos", "event_pos", "title", "prob", "volume", "url"), F.struct("kw_pos", "event_pos")
        ).alias("b")
    ).select("entity", "b.*")
    ranked = top_n_per_key(once, ["entity"], [F.col("kw_pos"), F.col("event_pos")], limit, "bet_no")
    return ranked.select(
        "entity",
        "bet_no",
        F.col("title").alias("question"),
        numbers.round4(F.col("prob")).alias("probability"),
        numbers.percent(F.col("prob")).alias("probability_pct"),
        F.coalesce("volume", F.lit(0.0)).alias("volume_usd"),
        F.coalesce("url", F.lit("")).alias("url"),
    )


def stored_bets(articles: DataFrame) -> DataFrame:
    """Distinct stored questions per entity, with the first article's probability."""
    first = (
        articles.where("coalesce(poly_q, '') <> ''")
        .groupBy("entity", "poly_q")
        .agg(F.min_by(F.struct("poly_prob"), "arrival").alias("p"), F.min("arrival").alias("first_seen"))
    )
    prob = F.col("p.poly_prob")
    return first.select(
        "entity",
        "first_seen",
        F.col("poly_q").alias("question"),
        F.coalesce(prob, F.lit(0.5)).alias("probability"),
        numbers.percent(F.coalesce(prob, F.lit(0.5))).alias("probability_pct"),
        F.lit(0.0).alias("volume_usd"),
        F.lit("").alias("url"),
    )


def all_bets(articles: DataFrame, events: DataFrame, markets: DataFrame | None = None) -> DataFrame:
    """Direct bets; entities without any fall back to the questions of their articles."""
    direct = entity_bets(events, markets)
    has_direct = F.broadcast(direct.select("entity").distinct())  # at most the rule list
    spare = stored_bets(articles).join(has_direct, "entity", "left_anti")
    return direct.unionByName(spare, allowMissingColumns=True).drop("first_seen", "bet_no")


def entity_groups(articles: DataFrame, events: DataFrame, markets: DataFrame | None = None) -> DataFrame:
    """Per entity: articles, sources, bets and the strongest signal. Entities come from a
    fixed rule table; articles are counted per (entity, source) first. The sources are one text per entity, as
    the page shows them; `entity_sources` has them as rows."""
    per_source = entity_sources(articles)
    base = per_source.groupBy("entity").agg(
        F.sum("n").alias("article_count"),
        F.max("max_prob").alias("max_prob"),
        F.array_join(F.sort_array(F.collect_list("source")), ",").alias("sources"),
    )
    bets = all_bets(articles, events, markets).groupBy("entity").agg(
        F.count(F.lit(1)).alias("bet_count"), F.max("probability").alias("best_bet")
    )
    strongest = F.coalesce("best_bet", "max_prob", F.lit(0.0))
    signal = numbers.round4(strongest)
    return (
        base.join(bets, "entity", "left")
        .select(
            "entity",
            "article_count",
            "sources",
            F.coalesce("bet_count", F.lit(0)).alias("bet_count"),
            signal.alias("signal"),
            numbers.percent(strongest).alias("signal_pct"),
            numbers.signal_band(signal).alias("band"),
        )
        .orderBy(F.desc("article_count"), "entity")
    )


def entity_sources(articles: DataFrame) -> DataFrame:
    """Articles per entity and source, with the highest probability."""
    return articles.groupBy("entity", "source").agg(F.count(F.lit(1)).alias("n"), F.max("poly_prob").alias("max_prob"))
