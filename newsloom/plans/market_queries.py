"""Matching with market events, and entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom import rules
from newsloom.functions import numbers, text
from newsloom.operators import gold as gold_ops
from newsloom.operators import markets as market_ops
from newsloom.operators.skew import top_n_per_key
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


# ------------------------------------------------------------------ articles
@query(
    "market_match_articles",
    with_(
        """SELECT article_id, event_pos, score, title AS polymarket_question, prob AS polymarket_prob,
           volume_usd AS polymarket_volume_usd, market_url AS polymarket_url
           FROM matched JOIN best_market USING (event_pos)""",
        "matched",
        "best_market",
    ),
)
def market_match_articles(spark, sf):
    sound = gold_ops.quality_ok(demo.silver_table(spark, sf))
    return market_ops.match_articles(sound, demo.events(spark, sf), demo.markets(spark, sf)).drop("polymarket_prob_pct")


@query("argmax_market", with_("SELECT article_id, event_pos, score FROM matched", "matched"))
def argmax_market(spark, sf):
    sound = gold_ops.quality_ok(demo.silver_table(spark, sf))
    searches = sound.select("article_id", text.translated_title_terms("titre_clean").alias("terms"))
    found = market_ops.best_events(
        searches, "article_id", "terms", demo.events(spark, sf), market_ops.MIN_ARTICLE_SCORE
    )
    return found.select("article_id", "event_pos", "score")


@query(
    "best_market_per_event",
    with_("SELECT event_pos, market_no, prob, volume_usd, market_url FROM best_market", "best_market"),
)
def best_market_per_event(spark, sf):
    return market_ops.best_markets(demo.events(spark, sf), demo.markets(spark, sf)).select(
        "event_pos", "market_no", "prob", "volume_usd", "market_url"
    )


NESTED = """SELECT e.event_pos, coalesce(m.price, e.price) AS prob FROM events_src e LEFT JOIN
    (SELECT * FROM markets_src QUALIFY row_number() OVER (PARTITION BY event_pos ORDER BY coalesce(volume, 0) DESC, market_no) = 1) m
    USING (event_pos)"""


@query(
    "outcome_price",
    with_(f"SELECT n.event_pos, e.price AS own_price, n.prob AS best_price FROM ({NESTED}) n JOIN events_src e USING (event_pos)", "events_src", "markets_src"),
)
def outcome_price(spark, sf):
    return market_ops.best_nested_market(demo.events(spark, sf)).select(
        "event_pos",
        numbers.outcome_price(F.col("outcomePrices")).alias("own_price"),
        F.col("prob").alias("best_price"),
    )


@query(
    "market_events_scan",
    with_(
        """SELECT e.event_pos, e.title, count(m.market_no) AS live_markets FROM
           (SELECT * FROM events_src WHERE active AND NOT closed ORDER BY event_pos LIMIT 200) e
           LEFT JOIN (SELECT * FROM markets_src WHERE active AND NOT closed
             QUALIFY row_number() OVER (PARTITION BY event_pos ORDER BY market_no) <= 10) m USING (event_pos) GROUP BY 1, 2""",
        "events_src",
        "markets_src",
    ),
)
def market_events_scan(spark, sf):
    page = market_ops.event_page(demo.events(spark, sf))
    listed = market_ops.markets_for_events(page, demo.markets(spark, sf))
    sizes = listed.groupBy("event_pos").agg(F.count(F.lit(1)).alias("n"))
    return page.join(sizes, "event_pos", "left").select(
        "event_pos", "title", F.coalesce("n", F.lit(0)).alias("live_markets")
    )


@query(
    "keyword_translation",
    with_(
        """SELECT coalesce(target, w.word) AS canon, count(*) AS n FROM
           (SELECT unnest(string_split_regex(lower(text), '[^\\p{L}]+')) AS word FROM documents) w
           LEFT JOIN kw_map k ON k.word = w.word WHERE w.word <> '' GROUP BY 1""",
        "kw_map",
    ),
)
def keyword_translation(spark, sf):
    return (
        tables.texts(spark, sf, "documents")
        .select(F.explode(F.split(F.lower("text"), "[^\\p{L}]+")).alias("word"))
        .where("word <> ''")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(text.translate("word").alias("canon"))
        .agg(F.sum("n").alias("n"))
    )


@query(
    "title_terms",
    with_(
        f"""SELECT article_id, array_to_string(list_sort(list_distinct({sql.title_terms('titre_clean')})), ' ') AS terms
            FROM silver""",
        "silver",
    ),
)
def title_terms(spark, sf):
    return demo.silver_table(spark, sf).select(
        "article_id", F.array_join(F.array_sort(text.title_terms("titre_clean")), " ").alias("terms")
    )


# -------------------------------------------------------------------- topics
def _labels(spark, sf):
    """A topic-style label per article: number and title words joined by underscores."""
    number = (F.col("arrival") % 40 - 1).cast("string")
    slug = F.regexp_replace("titre_clean", " ", "_")
    return demo.silver_table(spark, sf).select("article_id", "titre_clean", F.concat_ws("_", number, slug).alias("label"))


LABELS = "SELECT article_id, titre_clean, (arrival % 40 - 1) || '_' || replace(titre_clean, ' ', '_') AS label FROM silver"
TRANSLATE = "CASE w " + " ".join(
    f"WHEN {sql.q(k)} THEN {sql.q(v)}" for k, v in rules.KEYWORD_MAP.items() if k != v
) + " ELSE w END"
LABEL_TERMS = f"""SELECT label, list_sort(list_distinct(list_concat({sql.each('kept', TRANSLATE)}, kept))) AS terms FROM
    (SELECT label, {sql.each("CASE WHEN len(strong) > 0 THEN strong ELSE raw[1:2] END", "lower(w)")} AS kept FROM
      (SELECT label, raw, {sql.keep('raw', f"lower(w) NOT IN {sql.in_list(rules.MARKET_STOP_WORDS)}")} AS strong FROM
        (SELECT label, {sql.keep(f"CASE WHEN {sql.numbered('parts')} THEN parts[2:] ELSE parts END", f"length(w) >= 2 AND NOT {sql.NUMBER}")} AS raw FROM
          (SELECT DISTINCT label, {sql.keep(sql.words("replace(label, '_', ' ')"), "w <> ''")} AS parts FROM labels
           WHERE label <> '' AND label <> 'hors-sujet' AND NOT starts_with(label, '-1')))))
    WHERE len(kept) > 0"""


@query(
    "topic_terms",
    with_("SELECT label, array_to_string(terms, ', ') AS search_term FROM label_terms", "silver", labels=LABELS, label_terms=LABEL_TERMS),
)
def topic_terms(spark, sf):
    labels = _labels(spark, sf).select("label").distinct()
    terms = F.array_join(text.label_search_terms("label"), ", ")
    return text.evaluate_once(labels.withColumn("search_term", terms), ["search_term"]).where("search_term IS NOT NULL")


@query(
    "market_match_topics",
    with_(
        """SELECT topic_label, score, search_term, title AS market_question, round_even(prob, 4) AS probability, volume_usd, market_url AS url
           FROM best JOIN best_market USING (event_pos)""",
        "silver",
        "best_market",
        labels=LABELS,
        label_terms=LABEL_TERMS,
        flat="SELECT label, array_to_string(terms, ', ') AS search_term, unnest(terms) AS term FROM label_terms",
        hit="""SELECT term, event_pos, 1.0 + CASE WHEN contains(' ' || lower(title) || ' ', ' ' || term || ' ') THEN 0.5 ELSE 0 END AS w
               FROM (SELECT DISTINCT term FROM flat), events_src WHERE active AND NOT closed AND contains(lower(title), term)""",
        best="""SELECT label AS topic_label, search_term, event_pos, sum(w)::DOUBLE AS score FROM flat JOIN hit USING (term)
                GROUP BY label, search_term, event_pos
                QUALIFY row_number() OVER (PARTITION BY label ORDER BY sum(w) DESC, event_pos) = 1""",
    ),
)
def market_match_topics(spark, sf):
    labels = _labels(spark, sf).select(F.col("label").alias("topic_label"))
    return market_ops.match_topics(labels, demo.events(spark, sf), demo.markets(spark, sf)).drop("probability_pct")


# ----------------------------------------------------------------- relevance
MAPPED = "CASE w " + " ".join(f"WHEN {sql.q(k)} THEN {sql.q(v)}" for k, v in rules.RELEVANCE_MAP.items()) + " ELSE w END"
T_WORDS = sql.keep(sql.words("translate(lower(topic), '_-', '  ')"), f"length(w) >= 2 AND NOT {sql.NUMBER}")


@query(
    "market_relevance_check",
    with_(
        f"""SELECT article_id, CASE WHEN ok THEN poly_q END AS poly_q, CASE WHEN ok THEN poly_prob END AS poly_prob FROM
            (SELECT *, poly_q = '' OR len(ws) = 0 OR
               len({sql.keep('list_concat(ws, ' + sql.each('ws', MAPPED) + ')', 'length(w) >= 3 AND contains(lower(poly_q), w)')}) > 0 AS ok
             FROM asked)""",
        "silver",
        "events_src",
        labels=LABELS.replace("SELECT article_id", "SELECT arrival, article_id"),
        asked=f"""SELECT article_id, title AS poly_q, price AS poly_prob,
                  list_concat({T_WORDS.replace('topic', 'label')}, {sql.title_terms('lower(titre_clean)')}) AS ws
                  FROM labels JOIN events_src ON event_pos = arrival % (SELECT max(item_id) + 1 FROM benchmark)""",
    ),
)
def market_relevance_check(spark, sf):
    """Every article is offered one event, related or not."""
    events = demo.events(spark, sf)
    asked = events.select(
        "event_pos", F.col("title").alias("poly_q"), numbers.outcome_price(F.col("outcomePrices")).alias("poly_prob")
    )
    size = events.agg(F.max("event_pos") + 1).scalar()
    articles = (
        demo.silver_table(spark, sf)
        .select("article_id", "arrival", F.col("titre_clean").alias("titre"))
        .withColumn("topic", F.concat_ws("_", (F.col("arrival") % 40 - 1).cast("string"), F.regexp_replace("titre", " ", "_")))
        .withColumn("event_pos", F.col("arrival") % size)
    )
    return market_ops.drop_irrelevant(articles.join(asked, "event_pos")).select("article_id", "poly_q", "poly_prob")


# ------------------------------------------------------------------ entities
@query(
    "entity_label",
    with_(
        f"""SELECT article_id, {sql.clean_label('label')} AS label_name, {sql.article_entity('titre_clean', 'label')} AS entity,
            {sql.market_entity('titre_clean', 'label')} AS market_entity FROM labels""",
        "silver",
        labels=LABELS,
    ),
)
def entity_label(spark, sf):
    title, label = F.col("titre_clean"), F.col("label")
    return _labels(spark, sf).select(
        "article_id",
        text.clean_topic_label(label).alias("label_name"),
        text.article_entity(title, label).alias("entity"),
        text.market_entity(title, label).alias("market_entity"),
    )


KEYWORDS = "SELECT * FROM (VALUES " + ", ".join(
    f"({sql.q(e)}, {sql.q(k)}, {i})" for e, ks in rules.ENTITY_BET_KEYWORDS.items() for i, k in enumerate(ks)
) + ") t(entity, keyword, kw_pos)"
ENTITY_CTES = {
    "nested": NESTED,
    "kws": KEYWORDS,
    "hit": """SELECT entity, kw_pos, event_pos, title, volume, url FROM events_src JOIN kws ON active AND NOT closed AND contains(lower(title), keyword)
              QUALIFY row_number() OVER (PARTITION BY entity, lower(title) ORDER BY kw_pos, event_pos) = 1""",
    "bets": """SELECT entity, row_number() OVER (PARTITION BY entity ORDER BY kw_pos, event_pos) AS bet_no, title AS question,
               round_even(prob, 4) AS probability, volume AS volume_usd, url FROM hit JOIN nested USING (event_pos)
               QUALIFY bet_no <= 5""",
    "named": f"""SELECT *, {sql.market_entity('titre_clean', 'topic_label')} AS entity FROM gold""",
    "spare": """SELECT entity, polymarket_question AS question, coalesce(arg_min(polymarket_prob, arrival), 0.5) AS probability
                FROM named WHERE polymarket_question <> '' AND entity NOT IN (SELECT entity FROM bets) GROUP BY 1, 2""",
    "every_bet": "SELECT entity, question, probability FROM bets UNION ALL SELECT entity, question, probability FROM spare",
    "grp": """SELECT entity, count(*) AS article_count, max(polymarket_prob) AS max_prob,
              array_to_string(list_sort(list_distinct(list(source))), ',') AS sources FROM named GROUP BY 1""",
    "grp_bets": "SELECT entity, count(*) AS bet_count, max(probability) AS best_bet FROM every_bet GROUP BY 1",
    "groups": """SELECT entity, article_count, sources, coalesce(bet_count, 0) AS bet_count,
                 round_even(coalesce(best_bet, max_prob, 0.0), 4) AS signal, printf('%.1f%%', coalesce(best_bet, max_prob, 0.0) * 100) AS signal_pct FROM grp LEFT JOIN grp_bets USING (entity)""",
}


def entity_sql(final: str) -> str:
    return with_(final, "gold", "events_src", "markets_src", **ENTITY_CTES)


@query("entity_first_bets", entity_sql("SELECT entity, bet_no, question, probability, volume_usd, url FROM bets"))
def entity_first_bets(spark, sf):
    return market_ops.entity_bets(demo.events(spark, sf), demo.markets(spark, sf)).drop("probability_pct")


@query("entity_bets", entity_sql("SELECT entity, question, probability FROM every_bet"))
def entity_bets(spark, sf):
    return market_ops.all_bets(demo.entities(spark, sf), demo.events(spark, sf), demo.markets(spark, sf)).select("entity", "question", "probability")


BAND = "CASE WHEN {0} * 100 >= 70 THEN 'high' WHEN {0} * 100 >= 40 THEN 'medium' ELSE 'low' END"


@query("entity_groups", entity_sql(f"SELECT *, {BAND.format('signal')} AS band FROM groups"))
def entity_groups(spark, sf):
    return market_ops.entity_groups(demo.entities(spark, sf), demo.events(spark, sf), demo.markets(spark, sf))


@query(
    "market_page_totals",
    entity_sql("SELECT sum(article_count)::BIGINT AS articles, sum(bet_count)::BIGINT AS bets FROM groups"),
)
def market_page_totals(spark, sf):
    return entity_groups(spark, sf).agg(F.sum("article_count").alias("articles"), F.sum("bet_count").alias("bets"))


@query(
    "entity_first_articles",
    entity_sql(
        """SELECT entity, row_number() OVER (PARTITION BY entity ORDER BY arrival) AS rn, article_id FROM named QUALIFY rn <= 20"""
    ),
)
def entity_first_articles(spark, sf):
    return top_n_per_key(
        demo.entities(spark, sf).select("entity", "arrival", F.col("id").alias("article_id")), ["entity"], [F.col("arrival")], 20
    ).select("entity", "rn", "article_id")


@query(
    "signal_band",
    with_(
        f"""SELECT article_id, {BAND.format('combined_signal')} AS band,
            coalesce(polymarket_prob >= 0.99 OR polymarket_prob <= 0.01, false) AS prob_is_extreme FROM gold""",
        "gold",
    ),
)
def signal_band(spark, sf):
    return demo.gold(spark, sf).select(
        "article_id",
        numbers.signal_band(F.col("combined_signal")).alias("band"),
        numbers.is_extreme(F.col("polymarket_prob")).alias("prob_is_extreme"),
    )
