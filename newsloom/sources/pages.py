"""Main text of downloaded article pages, as a bulk job over a page table."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import rules
from newsloom.functions.text import decode_entities, strip

DROPPED = "(?is)<(" + "|".join(rules.PAGE_DROP_TAGS) + ")\\b[^>]*>.*?</\\1\\s*>"
# Named entities the supplied pages use, for the SQL check; `&amp;` comes last so nothing is decoded twice.
ENTITIES = [
    ("&nbsp;", "\xa0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&copy;", "©"), ("&middot;", "·"), ("&laquo;", "«"), ("&raquo;", "»"), ("&rsquo;", "’"), ("&lsquo;", "‘"),
    ("&ldquo;", "“"), ("&rdquo;", "”"), ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"),
    ("&eacute;", "é"), ("&egrave;", "è"), ("&agrave;", "à"), ("&ccedil;", "ç"), ("&amp;", "&"),
]


def markup_to_text(html: Column) -> Column:
    """Unwanted blocks go, tags become line feeds, entities become characters."""
    out = F.regexp_replace(html, DROPPED, "")
    out = F.regexp_replace(out, "(?s)<!--.*?-->", "<!>")
    out = F.regexp_replace(out, "(<[^>]+>)+", "\n")
    return strip(decode_entities(out))


def _tag_inner(html: Column, tag: str) -> Column:
    found = F.regexp_extract(html, f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>", 1)
    return F.nullif(found, F.lit(""))


def opening(selector: str) -> str:
    """Pattern of the opening tag of `tag`, `div.class`, `div#id` or `div[attribute=value]`."""
    tag, kind, name = re.fullmatch(r"(\w+)(?:([.#\[])(.+?)\]?)?", selector).groups()
    if kind is None:
        return rf"<{tag}\b[^>]*>"
    if kind == "[":
        attribute, value = name.split("=")
        return rf"""<{tag}\b[^>]*\b{attribute}\s*=\s*["']{re.escape(value)}["'][^>]*>"""
    attribute = "class" if kind == "." else "id"
    return rf"""<{tag}\b[^>]*\b{attribute}\s*=\s*["'](?:[^"']*\s)?{re.escape(name)}(?:\s[^"']*)?["'][^>]*>"""


TEXT_BLOCK = "div[data-component=text-block]"


def containers(html: Column, selectors: list[str]) -> Column:
    """What is inside the first container of each selector (all containers of TEXT_BLOCK, a
    line each), up to its own end tag. Containers nest, which no regular expression can follow, so the
    pages where that matters (and only those; others travel as NULL) are cut in Arrow batches, once for
    all selectors. The function carries all it needs: executors need not have this package installed."""
    patterns = [(opening(s), re.match(r"\w+", s)[0], s == TEXT_BLOCK) for s in selectors]

    def inside(page: str) -> list[str | None]:
        import re

        out: list[str | None] = []
        for pattern, tag, every in patterns:
            parts, at = [], 0
            while start := re.compile(pattern, re.I | re.S).search(page, at):
                depth, end, at = 1, len(page), len(page)
                for found in re.compile(rf"<(/?){tag}\b[^>]*>", re.I).finditer(page, start.end()):
                    depth += -1 if found.group(1) else 1
                    if depth == 0:
                        end, at = found.start(), found.end()
                        break
                parts.append(page[start.end():end])
                if not every:
                    break
            out.append("\n".join(parts) if parts else None)
        return out

    @F.pandas_udf("array<string>")
    def cut(pages: pd.Series) -> pd.Series:
        return pages.map(inside, na_action="ignore")

    plain = [s for s in selectors if s.isalnum()]
    nested = [F.regexp_count(html, F.lit(f"(?i)<{s}\\b")) > 1 for s in plain]
    wanted = [html.rlike(f"(?is){opening(s)}") for s in selectors if not s.isalnum()]
    needed = F.lit(False)
    for n in [*nested, *wanted]:
        needed = needed | n
    return cut(F.when(needed, html))


def paragraphs(html: Column) -> Column:
    """The paragraphs inside, one per line."""
    found = F.regexp_extract_all(html, F.lit("(?is)<p\\b[^>]*>(.*?)</p\\s*>"), F.lit(1))
    plain = F.transform(found, lambda p: strip(F.regexp_replace(p, "<[^>]+>", "")))
    return F.when(F.size(plain) > 0, decode_entities(F.array_join(plain, "\n")))


def main_text(pages: DataFrame, source_key: str, html: str = "html", out: str = "full_text") -> DataFrame:
    """Text of the first container, in the source's order, that holds more than 100
    characters; Moroccan sources fall back to the whole body (less the blocks that are dropped everywhere), others to NULL."""
    page, selectors = F.col(html), list(rules.PAGE_SELECTORS[source_key])
    if source_key == "bbc":
        selectors.insert(0, TEXT_BLOCK)
    cut = pages.withColumn("_cut", containers(page, selectors))
    tries = []
    for i, s in enumerate(selectors):
        inner = F.get("_cut", F.lit(i))
        if s == TEXT_BLOCK:
            tries.append(paragraphs(inner))
            continue
        if s.isalnum():  # where it can't nest, no page needs to leave the JVM
            inner = F.when(F.col("_cut").isNull(), _tag_inner(page, s)).otherwise(inner)
        body = markup_to_text(inner)
        tries.append(F.when(F.length(body) > rules.MIN_PAGE_TEXT, body))
    if source_key in rules.MOROCCAN_SOURCES:
        tries.append(markup_to_text(_tag_inner(page, "body")))
    return cut.withColumn(out, F.coalesce(*tries)).drop("_cut")


def page_title(html: Column) -> Column:
    return markup_to_text(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1))
