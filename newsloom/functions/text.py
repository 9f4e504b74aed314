"""Column expressions over text. All run inside generated JVM code or built-in
array functions; none calls Python per row."""

from __future__ import annotations

from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import rules

ARABIC = "[\\x{600}-\\x{6ff}]"
DIGITS = "^\\p{Nd}+$"
TOPIC_NUMBER = "^-*\\p{Nd}+$"
NUMBERED = "size(p) > 1 AND p[0] RLIKE '^-*\\\\p{Nd}+$'"
URL = f"(?i)^https?://[^{rules.WS}/$.?#][^\\n][^{rules.WS}]*\\n?\\z"

# The patterns, in order, by which the cleaner removes tags, named and numeric entities, links,
# control characters, then runs of line feeds and blanks. Control characters are found by their
# class, less the three that stay: measured quicker than the list of their codes. A step whose pattern cannot
# match without some fixed text is skipped for texts that lack it: looking for that
# text is far cheaper than running the pattern.
CLEAN_STEPS = [
    ("<", "<[^>]+>", " "),
    ("&", "&[a-zA-Z]{2,6};", " "),
    ("&#", "&#[0-9]+;", " "),
    ("://", f"https?://[^{rules.WS}]+", ""),
    ("www.", f"www\\.[^{rules.WS}]+", ""),
    (None, "\\p{Cntrl}(?<![\\t\\n\\r])", ""),
    ("\n\n\n", "\\n{3,}", "\n\n"),
    ("  ", " {2,}", " "),
]


def let(value: Column, use) -> Column:
    """`use(value)` with the value worked out once, however often it is referred to."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(rules.WS_CHARS))


def quoted(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def in_list(values) -> str:
    return f"({', '.join(quoted(v) for v in dict.fromkeys(values))})"


def clean_text(column: str) -> Column:
    """The named column without markup, links and control characters. One SQL text: a
    transform over a one-element array names the value that a step tests and edits."""
    body = f"`{column}`"
    for needed, pattern, new in CLEAN_STEPS:
        edited = f"regexp_replace(t, {quoted(pattern)}, {quoted(new)})"
        step = edited if needed is None else f"if(contains(t, {quoted(needed)}), {edited}, t)"
        body = f"transform(array({body}), t -> {step})[0]"
    return F.coalesce(strip(F.expr(body)), F.lit(""))


ENTITY = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,9});"


def decode_entities(c: Column) -> Column:
    """Character references, named and numeric, become their characters; unknown ones stay.
    Each distinct one is replaced once, those that stand for an ampersand last, so that nothing is decoded twice."""
    named = F.create_map(*[x for n, code in sorted(name2codepoint.items()) for x in (F.lit(n), F.lit(code))])

    def code(name: Column) -> Column:
        hexadecimal = F.conv(F.substring(name, 3, 6), 16, 10).cast("int")
        decimal = F.substring(name, 2, 7).cast("int")
        return F.when(name.rlike("^#[xX]"), hexadecimal).when(name.startswith("#"), decimal).otherwise(F.try_element_at(named, name))

    def character(n: Column) -> Column:
        valid = (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))

    found = F.array_distinct(F.regexp_extract_all(c, F.lit(ENTITY), F.lit(1)))
    coded = F.transform(found, lambda n: F.struct(n.alias("n"), character(code(n)).alias("c")))
    ordered = F.concat(F.filter(coded, lambda x: x["c"] != "&"), F.filter(coded, lambda x: x["c"] == "&"))
    out = F.aggregate(ordered, c, lambda s, x: F.replace(s, F.concat(F.lit("&"), x["n"], F.lit(";")), x["c"]))
    return F.when(F.contains(c, F.lit("&")), out).otherwise(c)


def html_to_text(c: Column) -> Column:
    """Feed summaries: tags become blanks, character references characters."""
    return strip(decode_entities(F.regexp_replace(F.coalesce(c, F.lit("")), "(<[^>]+>)+", " ")))


def is_url_valid(c: Column) -> Column:
    return F.coalesce(c.rlike(URL), F.lit(False))


def has_arabic(c: Column) -> Column:
    return F.coalesce(c.rlike(ARABIC), F.lit(False))


def article_id(url: Column) -> Column:
    return F.md5(url)


def content_hash(clean: Column) -> Column:
    return F.when(clean != "", F.md5(clean)).otherwise(F.lit(""))


def blank_to(c: Column, default) -> Column:
    """Default for NULL and empty strings."""
    other = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(c, F.lit("")), other)


def words(c: Column) -> Column:
    return F.split(c, f"[{rules.WS}]+")


def _title_terms(column: str) -> str:
    long_words = (
        f"filter(split({column}, {quoted(f'[{rules.WS}]+')}), w -> length(w) >= 3 AND NOT w RLIKE {quoted(DIGITS)})"
    )
    bare = f"transform({long_words}, w -> btrim(lower(w), {quoted(rules.TITLE_PUNCT)}))"
    return f"array_distinct(filter({bare}, w -> w <> ''))"


def title_terms(column: str) -> Column:
    """Distinct lower-case words of the named title column: 3+ characters before
    punctuation goes."""
    return F.expr(_title_terms(f"`{column}`"))


def translation(word: str, mapping: dict[str, str] = rules.KEYWORD_MAP) -> str:
    """SQL for: known word -> its canonical English form; other words pass through."""
    by_target: dict[str, list[str]] = {}
    for known, target in mapping.items():
        if known != target:
            by_target.setdefault(target, []).append(known)
    whens = " ".join(f"WHEN {word} IN {in_list(ws)} THEN {quoted(t)}" for t, ws in by_target.items())
    return f"CASE {whens} ELSE {word} END"


def translate(column: str) -> Column:
    return F.expr(translation(f"`{column}`"))


def translated_title_terms(column: str) -> Column:
    terms = _title_terms(f"`{column}`")
    return F.expr(f"array_distinct(transform({terms}, w -> {translation('w')}))")


def _without_number(parts: Column) -> Column:
    """Label parts without the leading topic number, where there is one."""
    return let(
        parts,
        lambda p: F.when(
            (F.size(p) > 1) & F.element_at(p, 1).rlike(TOPIC_NUMBER),
            F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(1))),
        ).otherwise(p),
    )


def label_search_terms(label: str) -> Column:
    """What to search the named topic label by: significant words, translated and
    original. NULL for labels that stand for no topic."""
    parts = f"filter(split(replace(`{label}`, '_', ' '), {quoted(f'[{rules.WS}]+')}), w -> w <> '')"
    body = f"transform(array({parts}), p -> if({NUMBERED}, slice(p, 2, greatest(size(p) - 1, 1)), p))[0]"
    raw = f"filter({body}, w -> length(w) >= 2 AND NOT w RLIKE {quoted(DIGITS)})"
    strong = f"filter(r, w -> lower(w) NOT IN {in_list(rules.MARKET_STOP_WORDS)})"
    kept = f"transform(array({raw}), r -> transform(array({strong}), s -> if(size(s) > 0, s, slice(r, 1, 2)))[0])[0]"
    lowered = f"transform({kept}, w -> lower(w))"
    both = f"transform(array({lowered}), k -> array_union(transform(k, w -> {translation('w')}), k))[0]"
    terms = F.expr(f"transform(array({both}), b -> if(size(b) > 0, array_sort(b), NULL))[0]")
    return F.when(is_topic_label(F.col(label)), terms)


def is_topic_label(label: Column) -> Column:
    return F.coalesce(
        (label != "") & (label != "hors-sujet") & ~label.startswith("-1"), F.lit(False)
    )


def contains_any(text: Column, needles: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(n)) for n in needles])


def first_rule(text: Column, rule_table: list[tuple[str, list[str]]], otherwise: Column) -> Column:
    """Ordered substring rules: the first rule with a hit names the row."""
    chain = F
    for name, needles in rule_table:
        chain = chain.when(contains_any(text, needles), F.lit(name))
    return chain.otherwise(otherwise)


def clean_topic_label(label: Column) -> Column:
    """Display name of a topic label: an entity, else its first two real words."""
    body = _without_number(F.split(F.lower(label), "_"))
    kept = F.filter(body, lambda w: (F.length(w) > 2) & ~w.isin(rules.LABEL_STOP_WORDS))
    fallback = let(
        F.slice(kept, 1, 2),
        lambda ws: F.when(F.size(ws) > 0, F.array_join(F.transform(ws, F.initcap), " ")).otherwise(
            F.lit(rules.DEFAULT_ENTITY)
        ),
    )
    named = let(F.lower(label), lambda low: first_rule(low, rules.ENTITY_RULES, F.lit(None)))
    asis = label.isNull() | (label == "") | label.isin(list(rules.SENTINEL_LABELS))
    return F.when(asis, label).otherwise(F.coalesce(named, fallback))


def _entity_text(title: Column, topic: Column) -> Column:
    return F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(topic, F.lit(""))))


def article_entity(title: Column, topic: Column) -> Column:
    named = let(_entity_text(title, topic), lambda t: first_rule(t, rules.ENTITY_RULES, F.lit(None)))
    fallback = F.when(F.coalesce(topic, F.lit("")) == "", F.lit(rules.DEFAULT_ENTITY)).otherwise(
        clean_topic_label(topic)
    )
    return F.coalesce(named, fallback)


def market_entity(title: Column, topic: Column) -> Column:
    return let(
        _entity_text(title, topic),
        lambda t: first_rule(t, rules.MARKET_ENTITY_RULES, F.lit(rules.DEFAULT_ENTITY)),
    )


def question_is_relevant(question: str, title: str, topic: str) -> Column:
    """True unless the article (named columns) has words and none is in the question."""
    topic_words = (
        f"filter(split(translate(lower(coalesce(`{topic}`, '')), '_-', '  '), {quoted(f'[{rules.WS}]+')}), "
        f"w -> length(w) >= 2 AND NOT w RLIKE {quoted(DIGITS)})"
    )
    own = f"array_union({topic_words}, {_title_terms(f"lower(coalesce(`{title}`, ''))")})"
    mapped = f"transform(o, w -> {translation('w', rules.RELEVANCE_MAP)})"
    known = f"transform(array({own}), o -> array_union(o, {mapped}))[0]"
    hit = f"exists(ws, w -> length(w) >= 3 AND contains(lower(`{question}`), w))"
    related = f"transform(array({known}), ws -> size(ws) = 0 OR {hit})[0]"
    return F.expr(f"coalesce(`{question}`, '') = '' OR {related}")


def evaluate_once(df: DataFrame, names: list[str]) -> DataFrame:
    """Fix the values of costly columns at this point of the plan.

    Spark copies the expression behind a column into every filter it pushes down, so
    `where quality_status = 'OK'` would clean each text a dozen times. A generator
    that emits exactly one row stops that: filters above it use the value.
    """
    rest = [F.col(c) for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names)))).select(*df.columns)


def detect_language(column: str, profiles: dict[str, list[str]] = rules.LANGUAGE_WORDS) -> Column:
    """Language whose function words are most frequent in the named column; ties go to
    the earlier profile. The text is split once and reduced to the words of any
    profile before counting."""
    known = sorted({w for ws in profiles.values() for w in ws})
    found = f"filter(split(lower(`{column}`), {quoted('[^\\p{L}]+')}), w -> w IN {in_list(known)})"
    counts = ", ".join(
        f"struct(size(filter(f, w -> w IN {in_list(ws)})) AS n, {-i} AS rank, {quoted(lang)} AS lang)"
        for i, (lang, ws) in enumerate(profiles.items())
    )
    best = f"transform(array({found}), f -> array_max(array({counts})))[0]"
    otherwise = f"CASE WHEN `{column}` RLIKE {quoted(ARABIC)} THEN 'ar' ELSE 'unknown' END"
    by_words = F.expr(f"transform(array({best}), b -> if(b.n > 0, b.lang, {otherwise}))[0]")
    long_enough = F.length(strip(F.col(column))) >= rules.MIN_DETECT_LENGTH
    return F.when(long_enough, by_words).otherwise(F.lit("unknown"))
