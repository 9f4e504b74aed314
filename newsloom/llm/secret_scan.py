"""Secrets in texts: three patterns, and high-entropy runs found by a sliding window.

Runs of the characters of a class (hexadecimal, base64) that are at least a window long are
candidates. A window slides over a candidate; counts per character of the class and the sum of
c * log2(c) are updated by the character that enters and the one that leaves, which gives the
window's Shannon entropy log2(w) - sum / w. Windows that reach the class's threshold join into spans.
Candidates that an allow-list pattern matches (words, numbers, dates, UUIDs, file names) give none, nor do spans that a
pattern's span already covers. Sums are whole numbers (SCALE-ths), so they never drift.

Spans are (kind, start, end) in code points, end exclusive. The pattern spans are leftmost and
non-overlapping per kind; matches that are too short are dropped after they were consumed.

Null counts as empty: no spans. Rows are judged alone, so repeated rows, equal or null ids and
empty tables need no care; other columns than id and text are not read. Only built-in functions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import FOLD_BLOCK, fresh, let, running, ship

ship(__name__)

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run that begins with AKIA: 20 characters or more
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "hex_entropy", "base64_entropy")
WINDOW = 20
SCALE = 1 << 20
SPANS = "array<struct<start:int,end:int>>"
MATCHES = "array<struct<start:int,end:int,match:string>>"
CUTS = "array<struct<start:int,end:int,marked:boolean>>"
SLICE = 512  # windows of a candidate that are looked at together
#: kind, characters of a candidate, the class's characters in order, least entropy in bits
CLASSES = (
    ("hex_entropy", "[0-9A-Fa-f]", "0123456789abcdef", 3.0),
    ("base64_entropy", "[A-Za-z0-9+/_=-]", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9),
)
#: a candidate of words and short numbers only
SEGMENTS = r"[-_/]*(?:(?:[A-Za-z]+|[0-9]{1,4})(?:[-_/]+|$))+$"
ALLOWED = (
    r"[A-Za-z]+([-_/=+]+[A-Za-z]+)*[-_/=+]*",  # words
    r"[-+=_/]*[0-9]+([-_/+=][0-9]+)*",  # numbers and dates
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",  # UUIDs
    rf"(?={SEGMENTS})[-A-Za-z0-9_]*([/_-][A-Za-z]{{2,}}){{3,}}[-A-Za-z0-9_]*",  # paths and names of several words
)


def found(text: Column, pattern: str) -> Column:
    """Matches with their spans: the text between matches and the matches add up to the text."""

    def spans(text):
        between, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        pairs = let(matches, lambda m: F.arrays_zip(F.slice(between, 1, F.size(m)).alias("b"), m.alias("m")))

        def step(at, x):
            start = at + F.length(x["b"])
            end = start + F.length(x["m"])
            return F.struct(end.alias("at"), F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("match"))).alias("out"))

        return running(pairs, F.lit(0), step, MATCHES)

    return F.when(text.rlike(pattern), let(text, spans)).otherwise(F.expr(f"CAST(array() AS {MATCHES})"))


def bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def assign_spans(text: Column) -> Column:
    values = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v))
    sized = F.filter(F.arrays_zip(found(text, ASSIGN).alias("s"), values.alias("n")), lambda x: x["n"] >= ASSIGN_LEAST)
    return F.when(text.rlike(ASSIGN), bare(F.transform(sized, lambda x: x["s"]))).otherwise(F.expr(f"CAST(array() AS {SPANS})"))


def joined_spans(spans: Column) -> Column:
    """Sorted spans of one kind, with those put together that touch."""

    def groups(s):
        first = F.filter(s, lambda x, i: F.when(i == 0, True).otherwise(x["start"] > F.get(s, i - 1)["end"]))
        last = F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["start"] > x["end"], F.lit(True)))
        pairs = F.arrays_zip(first.alias("a"), last.alias("b"))
        return F.transform(pairs, lambda x: F.struct(x["a"]["start"].alias("start"), x["b"]["end"].alias("end")))

    return let(spans, groups)


def high_entropy(run: Column, alphabet: str, least: float, window: int = WINDOW) -> Column:
    """Spans inside a candidate whose windows reach `least` bits: slice by slice, each with the window's length of the next,
    so that time grows with the length."""

    def sliced(r):
        slices = F.sequence(F.lit(0), F.floor((F.length(r) - window) / SLICE).cast("int"))

        def one(k):
            found_ = entropy_of(F.substring(r, k * SLICE + 1, F.lit(SLICE + window - 1)), alphabet, least, window)
            return F.transform(found_, lambda s: F.struct((s["start"] + k * SLICE).alias("start"), (s["end"] + k * SLICE).alias("end")))

        return joined_spans(F.flatten(F.transform(slices, one)))

    return let(run, sliced)


def entropy_of(run: Column, alphabet: str, least: float, window: int) -> Column:
    """The same for a run of bounded length."""
    weight = F.array(*[F.lit(round(SCALE * c * math.log2(c)) if c else 0) for c in range(window + 1)])
    most = math.floor(SCALE * window * (math.log2(window) - least))  # of the sum of c * log2(c)
    places = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)

    def step(state, i):
        come, gone = F.get(state["at"], i), F.when(i >= window, F.get(state["at"], i - window))
        before = state["counts"]
        plus, minus = F.get(before, come), F.get(before, gone)
        same = come.eqNullSafe(gone)
        change = F.get(weight, plus + 1) - F.get(weight, plus)
        change = change + F.when(gone.isNull(), F.lit(0)).otherwise(F.get(weight, minus - 1) - F.get(weight, minus))
        total = state["sum"] + F.when(same, F.lit(0)).otherwise(change)
        counts = F.when(same, before).otherwise(
            F.transform(before, lambda c, k: c + (k == come).cast("int") - F.coalesce((k == gone).cast("int"), F.lit(0)))
        )
        start = (i - window + 1).cast("int")
        last = F.element_at(state["out"], -1)
        joined = F.when(
            (F.size(state["out"]) > 0) & (last["end"] >= start), F.slice(state["out"], 1, F.size(state["out"]) - 1)
        ).otherwise(state["out"])
        begin = F.when((F.size(state["out"]) > 0) & (last["end"] >= start), last["start"]).otherwise(start)
        span = F.struct(begin.alias("start"), (i + 1).cast("int").alias("end"))
        out = F.when((i >= window - 1) & (total <= most), F.concat(joined, F.array(span))).otherwise(state["out"])
        return F.struct(state["at"].alias("at"), counts.alias("counts"), total.alias("sum"), out.alias("out"))

    start = F.struct(
        places.alias("at"),
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
        F.lit(0).cast("int").alias("sum"),
        F.expr(f"CAST(array() AS {SPANS})").alias("out"),
    )
    steps = F.sequence(F.lit(0), F.length(run) - 1)
    return F.aggregate(steps, start, step)["out"]


def entropy_spans(text: Column, characters: str, alphabet: str, least: float, allowed: tuple[str, ...], window: int) -> Column:
    permitted = "^(" + "|".join(allowed) + ")$"
    candidates = F.filter(found(text, characters + "{%d,}" % window), lambda s: ~s["match"].rlike(permitted))
    run = (lambda m: F.lower(m)) if len(alphabet) == 16 else (lambda m: m)
    return F.flatten(
        F.transform(
            candidates,
            lambda s: F.transform(
                high_entropy(run(s["match"]), alphabet, least, window),
                lambda e: F.struct((s["start"] + e["start"]).alias("start"), (s["start"] + e["end"]).alias("end")),
            ),
        )
    )


def listed(spans: Column, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")),
    )


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def covered(span: Column, sorted_spans: Column) -> Column:
    """Whether one of the spans (sorted, disjoint) holds the span: bisection for the last one that starts before it ends there."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(sorted_spans) + F.lit(1.0))).cast("int"))

    def step(s, _):
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        before = F.get(sorted_spans, middle)["start"] <= span["start"]
        narrowed = F.struct(F.when(before, middle).otherwise(s["low"]).alias("low"), F.when(before, s["high"]).otherwise(middle).alias("high"))
        return F.when(s["high"] - s["low"] > 1, narrowed).otherwise(s)

    last = F.aggregate(steps, F.struct(F.lit(-1).alias("low"), F.size(sorted_spans).alias("high")), step)["low"]
    return F.coalesce(let(last, lambda i: F.when(i >= 0, F.get(sorted_spans, i)["end"] >= span["end"])), F.lit(False))


def all_spans(text: Column, allowed: tuple[str, ...], window: int) -> dict[str, Column]:
    return {
        "assign": assign_spans(text), "access": bare(found(text, ACCESS)), "hex": bare(found(text, HEX)),
        **{kind: entropy_spans(text, characters, alphabet, least, allowed, window) for kind, characters, alphabet, least in CLASSES},
    }


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", allowed: tuple[str, ...] = ALLOWED,
         window: int = WINDOW) -> DataFrame:
    """Per row: the id, base and added spans as arrays of (start, rank, kind, end)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    spans = rows.select("doc_id", *[c.alias(kind) for kind, c in all_spans(text, allowed, window).items()])

    def own(kind):
        out = F.col(kind)
        for k in KINDS[:3]:  # each pattern's spans are sorted and disjoint
            out = let(F.struct(out.alias("e"), F.col(k).alias("b")), lambda x: F.when((F.size(x["e"]) == 0) | (F.size(x["b"]) == 0), x["e"]).otherwise(
                F.filter(x["e"], lambda e: ~covered(e, x["b"]))))
        return out

    base = F.concat(*[listed(F.col(k), k) for k in KINDS[:3]])
    extra = F.concat(*[listed(own(k), k) for k in KINDS[3:]])
    sizes = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return spans.select("doc_id", *sizes, base.alias("base"), extra.alias("extra"))


def digest(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "extra")).alias("spans"),
    )


def redact(docs: DataFrame, marker: str = "[secret]", id_column: str = "doc_id", text_column: str = "text",
           allowed: tuple[str, ...] = ALLOWED, window: int = WINDOW) -> DataFrame:
    """The same rows and columns, with every span of the text replaced by a marker.
    Overlapping spans are replaced together; null texts stay null."""
    text = F.col(text_column)
    spans = fresh("spans", docs.columns)
    whole = docs.withColumn(spans, F.concat(*all_spans(F.coalesce(text, F.lit("")), allowed, window).values()))

    def cut(at, x):  # what of a span no earlier one has covered; its marker stands unless it goes on with the one before
        start = F.greatest(at, x["start"])
        return F.struct(F.greatest(at, x["end"]).alias("at"), F.when(x["end"] > at, F.array(F.struct(
            start.alias("start"), x["end"].alias("end"), (x["start"] >= at).alias("marked")))).otherwise(F.expr(f"CAST(array() AS {CUTS})")).alias("out"))

    def replaced(x):
        """Blocks of spans: each takes its part out of the text once, and its spans' pieces out of that."""
        cuts, text = x["cuts"], x["text"]
        start_of = lambda i: F.coalesce(F.get(cuts, i)["start"], F.length(text))

        def block(b):
            first = start_of(b * FOLD_BLOCK)
            part = F.substring(text, first + 1, start_of((b + 1) * FOLD_BLOCK) - first)
            own = F.slice(cuts, (b * FOLD_BLOCK + 1).cast("int"), FOLD_BLOCK)

            def pieces(p):
                def piece(s, i):
                    following = start_of(b * FOLD_BLOCK + i + 1)
                    kept = F.substring(p["part"], s["end"] - p["first"] + 1, following - s["end"])
                    return F.concat(F.when(s["marked"], F.lit(marker)).otherwise(""), kept)

                return F.array_join(F.transform(own, piece), "")

            return let(F.struct(part.alias("part"), first.alias("first")), pieces)

        blocks = F.sequence(F.lit(0), F.floor((F.size(cuts) - 1) / FOLD_BLOCK).cast("int"))
        return F.concat(F.substring(text, F.lit(1), start_of(F.lit(0))), F.array_join(F.transform(blocks, block), ""))

    cuts = running(F.array_sort(F.col(spans)), F.lit(0), cut, CUTS)
    clean = F.when(F.size(spans) > 0, let(F.struct(cuts.alias("cuts"), text.alias("text")), replaced)).otherwise(text)
    return whole.select(*[clean.alias(c) if c == text_column else F.col(c) for c in docs.columns])
