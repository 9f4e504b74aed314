"""The checking side: the same frames written in plain SQL over the same tables."""

from __future__ import annotations

from newsloom import rules
from newsloom.sources import tables

WS = rules.WS


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in dict.fromkeys(values)) + ")"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def clean(expr: str) -> str:
    for pattern, new in [
        ("<[^>]+>", "' '"),
        ("&[a-zA-Z]{2,6};", "' '"),
        ("&#[0-9]+;", "' '"),
        (f"https?://[^{WS}]+", "''"),
        (f"www\\.[^{WS}]+", "''"),
        ("[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]", "''"),
        ("\\n{3,}", "chr(10) || chr(10)"),
        (" {2,}", "' '"),
    ]:
        expr = f"regexp_replace({expr}, '{pattern}', {new}, 'g')"
    return f"coalesce({strip(expr)}, '')"


def valid_url(expr: str) -> str:
    return f"coalesce(regexp_matches({expr}, '(?i)^https?://[^{WS}/$.?#][^\\n][^{WS}]*\\n?$'), false)"


def words(expr: str) -> str:
    return f"regexp_split_to_array({expr}, '[{WS}]+')"


def keep(list_expr: str, condition: str) -> str:
    return f"list_filter({list_expr}, lambda w: {condition})"


def each(list_expr: str, expr: str) -> str:
    return f"list_transform({list_expr}, lambda w: {expr})"


NUMBER = "regexp_matches(w, '^\\p{Nd}+$')"


def title_terms(expr: str) -> str:
    longer = keep(words(expr), f"length(w) >= 3 AND NOT {NUMBER}")
    return keep(each(longer, f"trim(lower(w), {q(rules.TITLE_PUNCT)})"), "w <> ''")


def case_rules(text: str, rule_table, otherwise: str) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({text}, {q(n)})" for n in needles) + f" THEN {q(name)}"
        for name, needles in rule_table
    )
    return f"CASE {whens} ELSE {otherwise} END"


def numbered(parts: str) -> str:
    return f"(len({parts}) > 1 AND regexp_matches({parts}[1], '^-*\\p{{Nd}}+$'))"


def clean_label(label: str) -> str:
    parts = f"string_split(lower({label}), '_')"
    body = f"CASE WHEN {numbered(parts)} THEN {parts}[2:] ELSE {parts} END"
    kept = keep(body, f"length(w) > 2 AND w NOT IN {in_list(rules.LABEL_STOP_WORDS)}")
    cap = each(kept, "CASE w[1] WHEN 'ß' THEN 'Ss' ELSE upper(w[1]) END || w[2:]")  # title case of one letter
    fallback = f"CASE WHEN len({kept}) > 0 THEN array_to_string(({cap})[1:2], ' ') ELSE {q(rules.DEFAULT_ENTITY)} END"
    asis = f"{label} IS NULL OR {label} = '' OR {label} IN {in_list(rules.SENTINEL_LABELS)}"
    return f"CASE WHEN {asis} THEN {label} ELSE {case_rules(f'lower({label})', rules.ENTITY_RULES, fallback)} END"


def entity_text(title: str, topic: str) -> str:
    return f"lower(coalesce({title}, '') || ' ' || coalesce({topic}, ''))"


def article_entity(title: str, topic: str) -> str:
    fallback = f"CASE WHEN coalesce({topic}, '') = '' THEN {q(rules.DEFAULT_ENTITY)} ELSE {clean_label(topic)} END"
    return case_rules(entity_text(title, topic), rules.ENTITY_RULES, fallback)


def market_entity(title: str, topic: str) -> str:
    return case_rules(entity_text(title, topic), rules.MARKET_ENTITY_RULES, q(rules.DEFAULT_ENTITY))


def hits(lang: str) -> str:
    return f"len(list_filter(toks, lambda w: w IN {in_list(rules.LANGUAGE_WORDS[lang])}))"


def map_values(mapping: dict[str, str]) -> str:
    return "VALUES " + ", ".join(f"({q(k)}, {q(v)})" for k, v in mapping.items())


def _country() -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in tables.COUNTRY_BY_LANG.items())
    return f"CASE lang {whens} END"


FLAG_TESTS = [
    "length(titre_clean) < 5",
    "length(contenu_clean) < 50",
    "coalesce(url, '') = ''",
    "date_publication IS NULL",
    f"coalesce(url, '') <> '' AND NOT {valid_url('url')}",
    "regexp_matches(titre_clean, '[\\x{600}-\\x{6ff}]') OR regexp_matches(contenu_clean, '[\\x{600}-\\x{6ff}]')",
    "length(contenu_clean) >= 200 AND langue_detectee <> langue AND langue_detectee <> 'unknown'",
]
FLAGS = (
    "list_filter(["
    + ", ".join(f"CASE WHEN {t} THEN {q(f)} END" for t, f in zip(FLAG_TESTS, rules.QUALITY_FLAGS))
    + "], lambda f: f IS NOT NULL)"
)
TOPIC = "CASE WHEN arrival % 9 < 3 THEN 0 WHEN arrival % 9 = 8 THEN -1 ELSE arrival % 9 - 2 END"
LABELS = "[" + ", ".join(q(x) for x in tables.TOPIC_LABELS) + "]"
SUBJECTS = "[" + ", ".join(q(x) for x in tables.EVENT_SUBJECTS) + "]"

# Building blocks, each naming the ones it reads.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw": (
        (),
        f"""SELECT md5('https://news.example.org/' || source || '/' || doc_id) AS article_id,
            regexp_extract(text, '^[^.!?\\n]*') AS titre, text AS contenu,
            'https://news.example.org/' || source || '/' || doc_id AS url,
            source, source || '_rss' AS raw_source, lower(lang) AS langue, {_country()} AS pays,
            TIMESTAMP '2024-01-01' + to_days((doc_id % 30)::INT) + to_hours((doc_id % 24)::INT) AS date_publication,
            CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'author ' || (doc_id % 7) END AS auteur,
            CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'news' END AS categorie,
            doc_id AS arrival FROM documents""",
    ),
    "cleaned": (
        ("raw",),
        f"SELECT * EXCLUDE (titre, contenu), {clean('titre')} AS titre_clean, {clean('contenu')} AS contenu_clean FROM raw",
    ),
    "toks": (
        ("cleaned",),
        "SELECT article_id, string_split(regexp_replace(lower(contenu_clean), '[^\\p{L}]+', ' ', 'g'), ' ') AS toks FROM cleaned",
    ),
    "lang_hits": (
        ("toks",),
        f"SELECT article_id, {hits('en')} AS n_en, {hits('fr')} AS n_fr, {hits('es')} AS n_es, {hits('de')} AS n_de FROM toks",
    ),
    "detected": (
        ("lang_hits", "cleaned"),
        f"""SELECT c.*, CASE WHEN length({strip('contenu_clean')}) < 20 THEN 'unknown'
            WHEN greatest(n_en, n_fr, n_es, n_de) = 0 THEN
              CASE WHEN regexp_matches(contenu_clean, '[\\x{{600}}-\\x{{6ff}}]') THEN 'ar' ELSE 'unknown' END
            WHEN n_en = greatest(n_en, n_fr, n_es, n_de) THEN 'en'
            WHEN n_fr = greatest(n_en, n_fr, n_es, n_de) THEN 'fr'
            WHEN n_es = greatest(n_en, n_fr, n_es, n_de) THEN 'es' ELSE 'de' END AS langue_detectee
            FROM cleaned c JOIN lang_hits USING (article_id)""",
    ),
    "flagged": (("detected",), f"SELECT *, {FLAGS} AS flags FROM detected"),
    "silver": (
        ("flagged",),
        """SELECT * EXCLUDE (flags), array_to_string(flags, ',') AS flags,
           CASE WHEN len(flags) > 0 THEN 'FAIL' ELSE 'OK' END AS quality_status,
           length(contenu_clean) AS content_length,
           CASE WHEN contenu_clean <> '' THEN md5(contenu_clean) ELSE '' END AS content_hash FROM flagged""",
    ),
    "events_src": (
        (),
        f"""SELECT item_id AS event_pos, {SUBJECTS}[(item_id % 6)::INT + 1] || ': ' || text AS title,
            CASE WHEN item_id % 5 = 0 THEN '' ELSE 'event-' || item_id END AS slug,
            'tag-' || item_id AS ticker, ((item_id * 29) % 997)::DOUBLE AS volume, '/event/' || item_id AS url,
            CASE WHEN item_id % 10 = 3 THEN 0.5 ELSE ((item_id * 37) % 101) / 100.0::DOUBLE END AS price,
            item_id % 11 <> 10 AS active, item_id % 13 = 12 AS closed FROM benchmark""",
    ),
    "markets_src": (
        (),
        """SELECT item_id AS event_pos, n AS market_no, 'Market ' || item_id || '/' || n AS question,
           CASE WHEN n = 2 THEN NULL ELSE ((item_id * 13 + n * 7) % 50) * 10.0::DOUBLE END AS volume,
           ((((item_id * 37) % 101) + n * 11) % 101) / 100.0::DOUBLE AS price,
           '/market/' || item_id || '-' || n AS url,
           (item_id + n) % 4 <> 0 AS active, (item_id + n) % 7 = 0 AS closed
           FROM benchmark, range(1, 4) t(n) WHERE item_id % 4 <> 0""",
    ),
    "best_market": (
        ("events_src", "markets_src"),
        """SELECT e.event_pos, e.title, m.market_no, coalesce(m.price, e.price) AS prob,
           CASE WHEN m.event_pos IS NULL THEN e.volume ELSE coalesce(m.volume, e.volume, 0.0) END AS volume_usd,
           coalesce(m.url, e.url) AS market_url
           FROM events_src e LEFT JOIN (SELECT * FROM markets_src WHERE active AND NOT closed
             QUALIFY row_number() OVER (PARTITION BY event_pos ORDER BY coalesce(volume, 0) DESC, market_no) = 1) m
           USING (event_pos)""",
    ),
    "kw_map": ((), f"SELECT * FROM ({map_values(rules.KEYWORD_MAP)}) t(word, target)"),
    "title_words": (
        ("silver",),
        f"SELECT article_id, quality_status, unnest({title_terms('titre_clean')}) AS word FROM silver",
    ),
    "article_terms": (
        ("title_words", "kw_map"),
        """SELECT DISTINCT article_id, coalesce(target, w.word) AS term FROM title_words w
           LEFT JOIN kw_map k ON k.word = w.word WHERE quality_status = 'OK'""",
    ),
    "term_hits": (
        ("article_terms", "events_src"),
        """SELECT term, event_pos, 1.0 + CASE WHEN contains(' ' || lower(title) || ' ', ' ' || term || ' ')
           THEN 0.5 ELSE 0 END AS w FROM (SELECT DISTINCT term FROM article_terms), events_src
           WHERE active AND NOT closed AND contains(lower(title), term)""",
    ),
    "matched": (
        ("article_terms", "term_hits"),
        """SELECT article_id, event_pos, sum(w)::DOUBLE AS score FROM article_terms JOIN term_hits USING (term)
           GROUP BY article_id, event_pos HAVING sum(w) >= 2.0
           QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY sum(w) DESC, event_pos) = 1""",
    ),
    "topical": (
        ("silver", "matched", "best_market"),
        f"""SELECT s.*, ({TOPIC})::INT AS topic_id,
            CASE WHEN {TOPIC} < 0 THEN 'hors-sujet' ELSE {LABELS}[({TOPIC})::INT + 1] END AS topic_label,
            (arrival % 80 + 20) / 100.0::DOUBLE AS topic_prob,
            coalesce(b.title, '') AS polymarket_question, b.prob AS polymarket_prob,
            coalesce(printf('%.1f%%', b.prob * 100), '') AS polymarket_prob_pct,
            b.volume_usd AS polymarket_volume_usd, coalesce(b.market_url, '') AS polymarket_url
            FROM silver s LEFT JOIN matched m USING (article_id) LEFT JOIN best_market b USING (event_pos)
            WHERE quality_status = 'OK'""",
    ),
    "topic_n": (("topical",), "SELECT topic_label, count(*) AS n FROM topical GROUP BY 1"),
    "gold": (
        ("topical", "topic_n"),
        """SELECT t.*, n AS topic_article_count,
           round_even(n / (SELECT max(n) FROM topic_n)::DOUBLE, 4) AS topic_coverage_score,
           round_even(coalesce(polymarket_prob, 0.5) * topic_prob, 4) AS combined_signal
           FROM topical t JOIN topic_n USING (topic_label)""",
    ),
    "stored": (
        ("gold", "silver"),
        "SELECT * FROM gold UNION ALL BY NAME SELECT * FROM silver WHERE quality_status = 'FAIL'",
    ),
}


def with_(final: str, *names: str, **extra: str) -> str:
    """`WITH` clause holding `names` and all they read, then `extra`, then `final`."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for needed in CTES[name][0]:
                visit(needed)
            order.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in order] + [f"{n} AS ({s})" for n, s in extra.items()]
    return f"WITH {', '.join(parts)} {final}" if parts else final


def mean(expr: str) -> str:
    """Mean over an exact decimal sum, as on the Spark side."""
    return f"sum(CAST({expr} AS DECIMAL(28, 6)))::DOUBLE / nullif(count({expr}), 0)"


def day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def second(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
