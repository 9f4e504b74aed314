"""Benchmark decontamination by a prefix-filtered set join.

A window of `window` consecutive item words (a shorter item is one window) is a set of word
shingles with their places; a document contains it when it contains them all in place. Because all are
required, a prefix of one shingle is enough, and the rarest in the corpus makes the fewest candidates:

1. count the benchmark's shingles over all documents; order each window's shingles by rarity;
2. join the prefix shingle of every window with the documents' shingles;
3. keep pairs where the whole window fits into the document (positional and length bound);
4. verify the window's words exactly against the words around the shingle.

Documents' shingles pass a Bloom filter of the benchmark's shingles before they become rows. Its
size follows the benchmark up to `MOST_BITS`; a fuller filter only lets more rows through to the exact
join. The joins carry no hint, so Spark broadcasts the benchmark's side only where its measured size is small.

Words: A-Z lower-cased, then runs outside `SEPARATORS`. Null and empty texts have no words;
items without words have no windows. Items without an id count like any other for n_hit; together they are one item
of n_items, a null in the list of items, that adds nothing to the text behind items_sha256 (as in `ORACLE`). Rows with equal or null doc_id are judged each by its own text
(rows are told apart by id and text; equal rows have equal results). An empty benchmark hits
nothing. Other columns are not read. Only built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from newsloom.llm.common import fresh, lower_ascii, ship, stored

ship(__name__)

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
MOST_BITS = 1 << 26
BITS_PER_KEY = 16
PROBES = 3


def words(text: Column) -> Column:
    split = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.filter(split, lambda w: w != "")


def shingle_hashes(tokens: Column, size: int) -> Column:
    """Hashes of all runs of `size` words, by place."""
    last = F.size(tokens) - size
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(F.lit(size), *[F.get(tokens, i + k) for k in range(size)]),
        ),
    ).otherwise(F.expr("CAST(array() AS array<bigint>)"))


def windows(benchmark: DataFrame, window: int, id_column: str, text_column: str) -> DataFrame:
    """(item, words, size, k): distinct windows per item and the size of their shingles."""
    items = benchmark.select(F.col(id_column).cast("string").alias("item"), words(F.col(text_column)).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    cut = items.where(F.size("w") > 0).select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, window))).alias("words"))
    size = F.size("words")
    return cut.distinct().select("item", "words", size.alias("size"), F.least(size, F.lit(SHINGLE)).alias("k"))


def bit(h: Column, probe: int, bits: int) -> Column:
    return F.shiftrightunsigned(h, 20 * probe).bitwiseAND(F.lit(bits - 1))


def bloom_words(keys: DataFrame, bits: int) -> DataFrame:
    """One row with the filter's 64-bit words in order; `bits` bounds it."""
    spots = keys.select(F.explode(F.array(*[bit(F.col("h"), p, bits) for p in range(PROBES)])).alias("b"))
    set_ = spots.select(F.shiftright("b", 6).alias("i"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b").bitwiseAND(F.lit(63)).cast("int")).alias("v"))
    blank = keys.sparkSession.range(bits // 64).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("v"))
    full = set_.union(blank).groupBy("i").agg(F.bit_or("v").alias("v"))
    return full.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("f"))


def may_hold(filter_: Column, h: Column, bits: int) -> Column:
    tests = None
    for p in range(PROBES):
        b = bit(h, p, bits)
        one = F.call_function("shiftrightunsigned", F.get(filter_, F.shiftright(b, 6).cast("int")), b.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
        tests = one if tests is None else tests & one
    return tests


def occurrences(docs: DataFrame, keys: DataFrame, sizes: list[int], window: int, context: bool) -> DataFrame:
    """Places of documents' shingles that may be among `keys` (column h). With context, each
    brings the words that any window around it could need."""
    n = keys.count()
    bits = 1 << 10
    while bits < min(MOST_BITS, BITS_PER_KEY * n):
        bits *= 2
    filter_ = stored(bloom_words(keys, bits), "benchmark-filter").scalar()
    out = None
    for size in sizes:
        places = docs.where(F.size("w") >= size).select("key", "w", F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("pos"))
        h = F.xxhash64(F.lit(size), *[F.get("w", F.col("pos") + k) for k in range(size)])
        kept = places.withColumn("h", h).where(may_hold(filter_, F.col("h"), bits))
        if context:
            first = F.greatest(F.col("pos") - (window - 1), F.lit(0))
            around = F.slice("w", first + 1, F.col("pos") + window - first)
            kept = kept.select("key", "h", "pos", first.alias("first"), around.alias("around"), F.size("w").alias("n"))
        else:
            kept = kept.select("h")
        out = kept if out is None else out.union(kept)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_column: str = "doc_id",
                  text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of `docs`: the id, n_words, n_hit, n_items and the sorted items."""
    raw = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    tokens = raw.select(F.struct("doc_id", F.xxhash64("text").alias("t")).alias("key"), words(F.col("text")).alias("w"))
    found = hits(tokens, stored(windows(benchmark, window, item_column, item_text), "benchmark-windows"), window)
    sized = raw.select("doc_id", F.xxhash64("text").alias("t"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    per_doc = found.select(F.col("key.doc_id").alias("d"), F.col("key.t").alias("u"), "n_hit", "items")
    joined = sized.join(per_doc, sized["doc_id"].eqNullSafe(per_doc["d"]) & (sized["t"] == per_doc["u"]), "left")
    items = F.coalesce("items", F.expr("CAST(array() AS array<string>)"))
    return joined.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"))


def hits(tokens: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """Per document with occurrences: the number of words inside them and the items."""
    sizes = [r.k for r in items.select("k").distinct().orderBy("k").collect()]  # at most SHINGLE values
    if not sizes:
        return tokens.sparkSession.createDataFrame([], f"key {tokens.schema['key'].dataType.simpleString()}, n_hit long, items array<string>")
    shingles = None
    for k in sizes:
        hashed = F.transform(shingle_hashes(F.col("words"), k), lambda h, i: F.struct(h.alias("h"), i.alias("off")))
        own = items.where(F.col("k") == k).select("words", "size", F.explode(hashed).alias("s"))
        shingles = own if shingles is None else shingles.union(own)
    distinct = stored(shingles.select("words", "size", F.col("s.h").alias("h"), F.col("s.off").alias("off")).distinct(), "benchmark-shingles")
    frequency = occurrences(tokens, distinct.select("h").distinct(), sizes, window, False).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    by_rarity = W.partitionBy("words").orderBy(F.coalesce("n", F.lit(0)), "h", "off")
    prefix = stored(
        distinct.join(frequency, "h", "left")
        .withColumn("nth", F.row_number().over(by_rarity))
        .where("nth = 1 AND n IS NOT NULL")  # a shingle that no document has rules its window out
        .select("h", "off", "words", "size"),
        "benchmark-prefixes",
    )
    places = occurrences(tokens, prefix.select("h").distinct(), sizes, window, True)
    start = F.col("pos") - F.col("off")
    candidates = places.join(prefix, "h").where((start >= 0) & (start + F.col("size") <= F.col("n")))
    same = F.slice("around", start - F.col("first") + 1, F.col("size")) == F.col("words")
    occurring = stored(candidates.where(same).select("key", start.alias("start"), "size", "words").distinct(), "occurrences")
    covered = (
        occurring.groupBy("key", "start").agg(F.max("size").alias("size"))
        .withColumn("reached", F.max(F.col("start") + F.col("size")).over(
            W.partitionBy("key").orderBy("start").rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("new", F.greatest(F.lit(0), F.col("start") + F.col("size") - F.greatest("start", F.coalesce("reached", F.lit(0)))))
        .groupBy("key").agg(F.sum("new").alias("n_hit"))
    )
    owners = items.groupBy("words").agg(F.collect_set(F.struct("item")).alias("owners"))  # a bare null would not be collected
    per_doc = (
        occurring.select("key", "words").distinct().join(owners, "words")
        .select("key", F.explode("owners").alias("owner")).distinct()
        .groupBy("key").agg(F.array_sort(F.collect_list("owner"))["item"].alias("items"))
    )
    return covered.join(per_doc.withColumnRenamed("key", "key2"), F.col("key").eqNullSafe(F.col("key2"))).drop("key2")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows whose texts hold no window of the benchmark, all columns as they were."""
    key = fresh("key", docs.columns)
    d, t = fresh("bad_id", docs.columns, [key]), fresh("bad_text", docs.columns, [key])
    keyed = docs.withColumn(key, F.struct(F.col(id_column).alias("doc_id"), F.xxhash64(text_column).alias("t")))
    tokens = keyed.select(F.col(key).alias("key"), words(F.col(text_column)).alias("w"))
    found = hits(tokens, stored(windows(benchmark, window, "item_id", "text"), "benchmark-windows"), window)
    bad = found.select(F.col("key.doc_id").alias(d), F.col("key.t").alias(t))
    return keyed.join(bad, F.col(key)["doc_id"].eqNullSafe(F.col(d)) & (F.col(key)["t"] == F.col(t)), "left_anti").drop(key)


ORACLE = """
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
bw AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, len(w) AS n, unnest(list_transform(range(0, greatest(len(w) - 9, 1)), lambda i: array_to_string(w[i + 1:i + 10], ' '))) AS win, least(len(w), 10) AS size FROM bw WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM wins),
dwin AS (SELECT doc_id, size, unnest(range(0, len(w) - size + 1)) AS p, unnest(list_transform(range(0, len(w) - size + 1), lambda i: array_to_string(w[i + 1:i + size], ' '))) AS win FROM dw, sizes WHERE len(w) >= size),
hit AS (SELECT doc_id, p, d.size, item_id FROM dwin d JOIN wins USING (win, size)),
cover AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + size)) AS q FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""
