"""Main text of pages by removal of site templates.

Every block element's subtree (tag, class, text, subtrees below) is hashed; Spark counts per host on how
many different pages a hash occurs, pages with the same text counting once. A subtree that recurs on at least
`LEAST_PAGES` of them, however many pages the host has, is template and deleted, but paragraphs and headings
inside an article are its own text however often they recur. Elements that can't be
article text on any site (scripts, forms, navigation, adverts, reader comments, ...) go by tag and class. Of what is left the article
elements are the text unless the rest of the main elements, or what lies outside both, holds more than twice as much; then the main elements, unless what lies outside
holds more than twice as much; then all of it. So a teaser in an article element does not take the place of a story beside it.

A page gets only those templates that occur on it: its subtrees, as rows, meet the host's templates, and what
is found goes back to the page by a key of host and content. No list grows with a host. Subtrees of very many
pages meet their template by broadcast (`skew.join_per_key`), so a host with a third of the pages is no task's work alone.

Character references are decoded, white space inside a block becomes one blank, blocks are joined by two line ends.
A line break (`br`) is white space. Null and empty pages give an empty text; tags cut off at the end of a page
are dropped, open ones closed. An element that only its class or id marks as noise stays if it holds an article or main
element that is not noise itself. A class name marks noise if it is a noise word or ends in one, or begins with one and goes on with a word for a box; has-, no-,
with- and without- words, and names like category-x or tag-x, describe the page and mark nothing. Time grows with the length of a page: where unbalanced quotes would have the rest of a page read for every tag, tags end at their first `>`. Pages without a host share one group. Rows are kept one by one, so repeated rows and null
ids stay; other columns are not read."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from hashlib import blake2b
from html import unescape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import ship, stored
from newsloom.llm.url_filter import host_and_path
from newsloom.operators.skew import join_per_key

ship(__name__)

LEAST_PAGES = 4
MANY_COPIES = 100  # equal pages from which the join knows them even without templates, to spread them
PIECE = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)|<[a-zA-Z/][^<]*\Z|[^<]+|<""", re.S)
ROUGH_PIECE = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*(?:>|\Z)|<[a-zA-Z/][^<]*\Z|[^<]+|<""", re.S)
NO_TAG = re.compile(r"<([^\s\S])?([^\s\S])?([^\s\S])?(?:[a-zA-Z/][^<]*\Z)?")
TAG_START = re.compile(r"</?[a-zA-Z]")
PATIENCE = 32  # times the length of a page that may be read for tags that do not end
NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
RAW = {"script", "style", "noscript", "template", "title", "textarea", "iframe", "svg", "math", "object", "canvas", "select", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
DROPPED = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "search", "fieldset"}
TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "th", "dt", "dd", "figcaption", "article", "main", "body", "html"}
CLOSES = {  # an open element that a start tag of these ends
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
NOISE = re.compile(
    r"ads?|adverts?|advertisements?|advertising|banners?|sponsor(?:ed|s)?|promos?|promotions?|cookies?|consent|gdpr|notices?|"
    r"alerts?|popups?|modals?|overlay|sidebars?|menus?|nav|navbar|navigation|breadcrumbs?|footer|masthead|topbar|toolbar|"
    r"comments?|commentlist|replies|respond|disqus|share|sharing|social|related|recommended|newsletter|subscribe|subscription|signup|"
    r"login|search|pagination|pager|skip|complementary|contentinfo|dialog",
    re.I,
)
BOXES = re.compile(
    r"lists?|links?|box|bar|wrap(?:per)?|container|blocks?|slot|buttons?|widgets?|section|area|items?|panel|unit|inner|outer|row|icons?|form|message|"
    r"holder|group|module|frame|placeholder|layout|top|bottom|left|right|posts?|stories|articles?|to|content|[0-9]+",
    re.I,
)
DESCRIBES = re.compile(r"(?:category|cat|tag|post|type|format|status|term|author|page)[_-]", re.I)
WORDS = re.compile(r"[\s_-]+")
MODIFIED = re.compile(r"(?:^|(?<=[\s_-]))(?:has|no|with|without)[_-]\S*", re.I)
HEADER = re.compile(r"(?:^|[\s_-])(header|site-header|page-header)(?:$|[\s_-])", re.I)


def names_noise(value: str) -> bool:
    """Whether a class, id or role names noise."""
    for name in MODIFIED.sub("", value).split():
        words = [w for w in WORDS.split(name) if w]
        if not words or DESCRIBES.match(name):
            continue
        if NOISE.fullmatch(words[-1]) or NOISE.fullmatch(words[0]) and all(BOXES.fullmatch(w) or NOISE.fullmatch(w) for w in words[1:]):
            return True
    return False


SURE, LIKELY = 2, 1  # noise by tag, role or hidden; by class or id


def noise(tag: str, rest: str, inside: int) -> tuple[int, str]:
    """Whether an element is none of the article's text (0 if it may be), and its class."""
    if tag in DROPPED or (tag == "header" and not inside):
        return SURE, ""
    if not rest or rest.isspace():
        return 0, ""
    kind, noisy = "", 0
    for name, value in NAMES.findall(rest):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return SURE, ""
        if name == "class":
            kind = value
        if tag not in ("body", "html", "article", "main") or name == "class" and tag == "article":
            if names_noise(value) or (not inside and HEADER.search(MODIFIED.sub("", value))):
                if name == "role":
                    return SURE, ""
                noisy = LIKELY
    return noisy, kind


class Page:
    """A page and what is worked out of it once: its pieces, where inline elements end, and where articles start."""

    def __init__(self, html: str):
        self.html = html
        self.left = PATIENCE * len(html)
        self.last = html.rfind(">")
        self.ends: dict[int, int] | None = None
        self.starts: list[int] = []

    def piece(self, at: int):
        """The piece at a place: a tag, a comment, or text."""
        html = self.html
        if html[at] == "<" and at > self.last and TAG_START.match(html, at):
            return NO_TAG.match(html, at)  # no tag ends any more
        if self.left < 0:
            return ROUGH_PIECE.match(html, at)
        m = PIECE.match(html, at)
        if m[2] is None and html[at] == "<" and TAG_START.match(html, at):
            self.left -= len(html) - at
        return m

    def after_raw(self, tag: str, at: int) -> int:
        end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(self.html, at)
        return end.end() if end else len(self.html)

    def look(self) -> None:
        """One pass for the ends of inline elements and the starts of articles that are not noise themselves."""
        self.ends, open_, at = {}, {}, 0
        while at < len(self.html):
            m = self.piece(at)
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if open_.get(tag):
                    self.ends[open_[tag].pop()] = at
            elif tag in RAW:
                at = self.after_raw(tag, at)
            elif tag not in BLOCK and tag not in VOID:
                open_.setdefault(tag, []).append(at)
            elif tag in ("article", "main") and not noise(tag, m[3], 0)[0]:
                self.starts.append(m.start())

    def inline_end(self, at: int) -> int:
        """Past the end of the inline element whose start tag ends at a place; the place itself if it is never closed."""
        if self.ends is None:
            self.look()
        return self.ends.get(at, at)

    def holds_article(self, at: int, end: int) -> bool:
        """Whether an article or main element that is not noise itself starts in a part of the page."""
        if self.ends is None:
            self.look()
        i = bisect_left(self.starts, at)
        return i < len(self.starts) and self.starts[i] < end


def walk(html: str, templates: frozenset[int] | None = None) -> tuple[list[str], list[int]]:
    """The blocks of the page's text in order, and the hashes of its subtrees."""
    wrappers: set[int] = set()
    page = Page(html)
    while True:
        known = len(wrappers)
        found = walk_once(page, templates, wrappers)
        if len(wrappers) == known:
            return found


IN_MAIN, IN_ARTICLE = 1, 2
OUTWEIGHS = 2


def chosen(blocks: list[tuple[int, str]]) -> list[str]:
    """The blocks of the container that holds the text; a block's number tells which containers it lies in."""
    article, main, outside = (sum(len(t) for z, t in blocks if fits(z)) for fits in (lambda z: z & IN_ARTICLE, lambda z: z == IN_MAIN, lambda z: not z))
    if article and OUTWEIGHS * article >= max(main, outside):
        return [t for z, t in blocks if z & IN_ARTICLE]
    in_main = sum(len(t) for z, t in blocks if z & IN_MAIN)
    if in_main and OUTWEIGHS * in_main >= outside:
        return [t for z, t in blocks if z & IN_MAIN]
    return [t for _, t in blocks]


def walk_once(page: Page, templates: frozenset[int] | None, wrappers: set[int]) -> tuple[list[str], list[int]]:
    """As `walk`; elements that start at one of `wrappers` are no noise, and noise by class or id that turns out to hold an article is added to them."""
    html, blocks = page.html, []
    stack: list[list] = []  # tag, zone, first block, parts of the hash, dropped, start
    line: list[str] = []
    hashes: list[int] = []
    names: Counter = Counter()  # open elements by tag
    zone = dropped = at = sure = likely = 0

    def flush() -> None:
        if line:
            text = " ".join("".join(line).split())
            line.clear()
            if text and not dropped:
                blocks.append((zone, text))
                if stack:
                    stack[-1][3].append(text)

    def close() -> None:
        nonlocal zone, dropped, sure, likely
        flush()
        tag, own_zone, first, parts, noisy, _ = stack.pop()
        names[tag] -= 1
        if noisy:
            dropped -= 1
            sure -= noisy == SURE
            likely -= noisy == LIKELY
        elif not dropped and parts[1:]:
            h = int.from_bytes(blake2b("\x1f".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
            hashes.append(h)
            if templates and h in templates and not (tag in TEXT and zone & IN_ARTICLE):
                del blocks[first:]
            if stack:
                stack[-1][3].append(str(h))
        zone = own_zone

    while at < len(html):
        m = page.piece(at)
        begin, at = at, m.end()
        tag = m[2]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                line.append(unescape(piece) if "&" in piece else piece)
            continue
        tag = tag.lower()
        if m[1]:
            if tag in BLOCK and names[tag]:
                while stack[-1][0] != tag:
                    close()
                close()
            elif tag in BLOCK:
                flush()
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                line.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in RAW:
            at = page.after_raw(tag, at)
            continue
        noisy, kind = noise(tag, m[3], zone)
        if noisy == LIKELY and begin in wrappers:
            noisy = 0
        if tag not in BLOCK:
            if noisy and not m[3].rstrip().endswith("/"):
                end = page.inline_end(at)
                if noisy == SURE or not page.holds_article(at, end):
                    line.append(" ")
                    at = end
            continue
        flush()
        ended = CLOSES.get(tag)
        if ended:
            while stack and stack[-1][0] in ended | {"p"}:
                close()
        while stack and stack[-1][0] == "p":
            close()
        if tag == "body" and stack and stack[-1][0] == "head":
            close()
        if likely and not sure and not noisy and tag in ("article", "main"):
            wrappers.update(s[5] for s in stack if s[4])
        stack.append([tag, zone, len(blocks), [f"{tag}.{kind}"], noisy, begin])
        names[tag] += 1
        if noisy:
            dropped += 1
            sure += noisy == SURE
            likely += noisy == LIKELY
        elif tag == "article":
            zone |= IN_ARTICLE
        elif tag == "main" or kind == "main":
            zone |= IN_MAIN
    while stack:
        close()
    flush()
    return chosen(blocks), hashes


def text_of(html: str | None, templates: frozenset[int] | None = None) -> str:
    return "\n\n".join(walk(html or "", templates)[0])


def content_key(url: Column, html: Column) -> Column:
    """16 bytes by which pages of equal host and html share one list of templates."""
    host, _ = host_and_path(url)
    return F.unhex(F.md5(F.concat(F.coalesce(host, F.lit("")).cast("binary"), F.lit("\n").cast("binary"), html.cast("binary"))))


def subtrees(pages: DataFrame, url_column: str, html_column: str) -> DataFrame:
    """Per page its key, its host, a hash of its text and the hashes of its subtrees."""

    def task(batches):
        import pyarrow as pa

        schema = pa.schema([("key", pa.binary()), ("host", pa.string()), ("page", pa.int64()), ("hashes", pa.list_(pa.int64()))])
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some, rows = batch.slice(k, 512), []
                for key, host, html in zip(*(c.to_pylist() for c in some.columns)):
                    blocks, hashes = walk(html or "")
                    own = int.from_bytes(blake2b("\n".join(blocks).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
                    rows.append((key, host, own, sorted(set(hashes))))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    html = F.col(html_column)
    rows = pages.where(html.isNotNull()).select(content_key(F.col(url_column), html), host_and_path(F.col(url_column))[0], html)
    return rows.mapInArrow(task, "key binary, host string, page long, hashes array<long>")


def templates(pages: DataFrame, url_column: str = "url", html_column: str = "html", least: int = LEAST_PAGES) -> DataFrame:
    """(key, templates, n): the templates that occur on the pages of a key, and the number of such pages. Keys
    of few pages without a template are left out."""
    found = stored(subtrees(pages, url_column, html_column), "subtrees")
    subtree = F.when(F.col("hash").isNotNull(), F.struct("host", "hash"))
    rows = found.select("key", "page", "host", F.posexplode_outer("hashes").alias("nth", "hash")).withColumn("subtree", subtree)
    counted = rows.where("hash IS NOT NULL").groupBy("subtree").agg(F.count_distinct("page").alias("n"), F.count(F.lit(1)).alias("n_rows"))
    # subtrees of many rows that are no templates stay listed: the join must know a key to spread its rows
    per_subtree = stored(counted.where(F.col("n_rows") >= least), "templates")
    met = join_per_key(rows.select("key", "nth", "hash", "subtree"), per_subtree, "subtree", "n_rows", "key")
    first = F.coalesce("nth", F.lit(0)) == 0
    lists = met.groupBy("key").agg(F.array_sort(F.collect_set(F.when(F.col("n") >= least, F.col("hash")))).alias("templates"), F.count_if(first).alias("n"))
    return lists.where((F.size("templates") > 0) | (F.col("n") >= MANY_COPIES))


def packed(keyed: DataFrame) -> DataFrame:
    """The rows with deflated pages, as the join may have to move them."""

    def task(batches):
        import zlib

        import pyarrow as pa

        for batch in batches:
            at = batch.schema.names.index("__html")
            small = [None if h is None else zlib.compress(h.encode(), 1) for h in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(small, pa.binary()), *batch.columns[at + 1 :]], names=batch.schema.names)

    schema = T.StructType([T.StructField("__html", T.BinaryType()) if f.name == "__html" else f for f in keyed.schema])
    return keyed.mapInArrow(task, schema)


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", least: int = LEAST_PAGES) -> DataFrame:
    """page_id, url and the main text of every row."""
    known = stored(templates(pages, url_column, html_column, least), "page-templates").withColumnRenamed("key", "__key")
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("__html"))
    keyed = rows.withColumn("__key", content_key(F.col("url"), F.col("__html"))).withColumn("__row", F.monotonically_increasing_id())
    joined = join_per_key(packed(keyed), known, "__key", "n", "__row").select("page_id", "url", "__html", "templates")
    schema = T.StructType([joined.schema["page_id"], joined.schema["url"]]).add("text", "string")

    def task(batches):
        import zlib

        import pyarrow as pa

        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some, sets = batch.slice(k, 256), {}
                texts = []
                for html, listed in zip(some.column(2).to_pylist(), some.column(3)):
                    key = listed.values.to_numpy().tobytes() if listed.is_valid else b""
                    if key not in sets:
                        sets[key] = frozenset(listed.as_py() or ())
                    texts.append(text_of(zlib.decompress(html).decode() if html else None, sets[key]))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return joined.mapInArrow(task, schema).withColumn("n_chars", F.length("text").cast("long"))
