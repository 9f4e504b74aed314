"""URL rules by a Bloom filter cascade.

A rule (verdict, host, path) fits a url if the url's host is the rule's host or a subdomain of it,
and the url's path starts with the rule's path. So the keys a url could be listed under are the
suffixes of its host at dots, each with the prefixes of its path of those lengths that rules have. All these keys over the
whole corpus are the key universe. For each verdict a cascade holds its rules' keys: level 1 encodes the
listed keys, level 2 the universe's keys that level 1 passes wrongly, level 3 the listed
keys that level 2 passes wrongly, and so on until a level passes none wrongly. Every key of the universe is then
judged exactly by the first level that does not hold it, without a join. The longest listed
key of a url gives its rule; of equally long ones a block goes first, then the longer host. A url that is listed nowhere is allowed.

The filters travel inside the plan: `MOST_BITS` bounds them, and a list that needs more is refused.

Host: after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; path: then up to "?", "#"
or the end. Null urls and urls without "://" have neither and match only a rule of an
empty host. Rows are judged alone: repeated rows, null ids and extra columns pass through. Empty
lists and empty tables give empty cascades. Only built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import fresh, lower_ascii, ship, stored

ship(__name__)

RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)
BITS_PER_KEY = 10
PROBES = 4
LEAST_BITS = 64
MOST_BITS = 1 << 26


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = "://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return lower_ascii(part(1)), part(2)


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys under which a rule for this url could be listed, the longest first."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    hosts = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    fits = [F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in sorted(lengths, reverse=True)]
    paths = F.array_compact(F.array(*fits)) if fits else F.expr("CAST(array() AS array<string>)")
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))
    return F.array_sort(keys, lambda a, b: F.length(b) - F.length(a))


def spots(key: Column, level: int, bits: int) -> list[Column]:
    """The key's places in a level; each level hashes in its own way."""
    out = []
    for p in range(0, PROBES, 2):
        h = F.xxhash64(key, F.lit(level), F.lit(p))
        out += [F.shiftrightunsigned(h, s).bitwiseAND(F.lit(bits - 1)) for s in (5, 37)]
    return out


@dataclass
class Level:
    bits: int
    words: str  # the filter's 64-bit words, comma-joined

    def holds(self, key: Column, level: int) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")  # folded to one constant
        out = F.lit(True)
        for b in spots(key, level, self.bits):
            word = F.get(words, F.shiftright(b, 6).cast("int"))
            out = out & (F.call_function("shiftrightunsigned", word, b.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return out


@dataclass
class Cascade:
    levels: list[Level]

    def lists(self, key: Column) -> Column:
        """Exact for every key of the universe it was built over."""
        out = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[k].holds(key, k), out).otherwise(F.lit(k % 2 == 1))
        return out


def encode(keys: DataFrame, n: int, level: int) -> Level:
    """One level's filter; both the work and the one row it ends in are bounded by its size."""
    bits = LEAST_BITS
    while bits < BITS_PER_KEY * n:
        bits *= 2
    if bits > MOST_BITS:
        raise ValueError(f"{n} keys need {bits} bits; a level holds {MOST_BITS}")
    b = F.col("b")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), b.bitwiseAND(F.lit(63)).cast("int"))
    marked = keys.select(F.explode(F.array(*spots(F.col("key"), level, bits))).alias("b")).select(F.shiftright(b, 6).alias("i"), one.alias("v"))
    blank = keys.sparkSession.range(bits // 64).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("v"))
    words = marked.union(blank).groupBy("i").agg(F.bit_or("v").alias("v"))
    row = words.agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("w"))
    text = row.select(F.array_join(F.transform("w", lambda s: s["v"].cast("string")), ",").alias("w")).first()
    return Level(bits, text.w)


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade for `listed` keys over `universe`; both have distinct keys in a column `key`."""
    inside, outside = listed, universe.join(listed, "key", "left_anti")
    levels: list[Level] = []
    n = inside.count()
    while n:
        level = encode(inside, n, len(levels))
        wrong = stored(outside.where(level.holds(F.col("key"), len(levels))), "cascade-level")
        levels.append(level)
        inside, outside = wrong, inside
        n = wrong.count()
    return Cascade(levels)


def judge(pages: DataFrame, rules: DataFrame, url_column: str = "url") -> DataFrame:
    """The rows with host, path, rule and verdict, as columns in front of no other: existing
    columns of these names are replaced. `rules` has verdict, host and path."""
    host, path = host_and_path(F.col(url_column))
    rules = stored(rules.select("verdict", F.concat("host", "path").alias("key"), F.length("path").alias("n")).distinct(), "url-rules")
    lengths = [r.n for r in rules.select("n").distinct().orderBy("n").collect()]  # lengths of rule paths
    spread = pages.select(host.alias("host"), path.alias("path"))
    universe = stored(spread.select(F.explode(candidate_keys(F.col("host"), F.col("path"), lengths)).alias("key")).distinct(), "url-keys")
    cascades = {v: build(rules.where(F.col("verdict") == v).select("key"), universe) for v in ("block", "allow")}
    keys = candidate_keys(host, path, lengths)
    first = {v: F.get(F.filter(keys, c.lists), F.lit(0)) if c.levels else F.lit(None).cast("string") for v, c in cascades.items()}
    block, allow = (fresh(c, pages.columns) for c in ("block_rule", "allow_rule"))
    out = pages.withColumns({block: first["block"], allow: first["allow"], "host": host, "path": path})
    blocked = F.coalesce(F.length(block), F.lit(-1)) >= F.coalesce(F.length(allow), F.lit(-1))
    rule = F.when(blocked, F.col(block)).otherwise(F.col(allow))
    verdict = F.when(rule.isNotNull() & blocked, F.lit("block")).otherwise(F.lit("allow"))
    return out.withColumns({"rule": rule, "verdict": verdict}).drop(block, allow)


ORACLE = """
WITH u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1) AS h, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
x AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (SELECT *, (SELECT max_by(struct_pack(k := rhost || rpath, v := r.verdict), length(rhost || rpath)) FROM r
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best FROM x)
SELECT page_id, host, path, best.k AS rule, coalesce(best.v, 'allow') AS verdict FROM m
"""
