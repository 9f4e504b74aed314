"""The secret scan against a plain version."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import pytest

from newsloom.llm import secret_scan as op

ALLOWED = re.compile("(?:" + "|".join(op.ALLOWED) + ")")


def plain(text):
    text = text or ""
    base = []
    for m in re.finditer(op.ASSIGN, text, re.ASCII):
        if len(m[2]) >= 6:
            base.append((m.start(), 0, "assign", m.end()))
    base += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    extra = []
    for rank, (kind, chars, _, least) in enumerate(op.CLASSES, 3):
        for m in re.finditer(chars + "+", text):
            run = m[0].lower() if rank == 3 else m[0]
            if len(run) < op.WINDOW or ALLOWED.fullmatch(m[0]):
                continue
            hits = []
            for i in range(len(run) - op.WINDOW + 1):
                counts = Counter(run[i : i + op.WINDOW]).values()
                h = math.log2(op.WINDOW) - sum(c * math.log2(c) for c in counts) / op.WINDOW
                if h >= least - 1e-5:
                    if hits and hits[-1][1] >= i:
                        hits[-1][1] = i + op.WINDOW
                    else:
                        hits.append([i, i + op.WINDOW])
            extra += [(m.start() + a, rank, kind, m.start() + b) for a, b in hits]
    extra = [e for e in extra if not any(b[0] <= e[0] and b[3] >= e[3] for b in base)]
    show = lambda spans: ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans))
    n = Counter(b[2] for b in base)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(show(base).encode()).hexdigest(), show(base + extra)


def texts():
    rnd = random.Random(3)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    some = lambda chars, n: "".join(rnd.choice(chars) for _ in range(n))
    out = [
        None, "", " ", "no secret here", "token=abc token = \"abcdef\"", "secret=token:abcdef", "PASSWORD : 'hunter22'",
        "api_key=x APIkey=\"zzzzzz\" api-key=zzzzzzz", "ſecret=abcdef toKen=abcdefg", "AKIA" + "A" * 15, "AKIA" + "B" * 16 + "c",
        "é😀 password=b7db7aa4a5fcc78305 x", "a" * 23, "a" * 24 + "g" + "f" * 30, "123e4567-e89b-12d3-a456-426614174000",
        "2024-01-01-2024-01-02-2024-01-03", "the-quick-brown-fox-jumps-over", "Donaudampfschifffahrtsgesellschaft",
        "token=secret=abcdef;token=" + some(b64, 40), "password=abcdef" * 30, "x\n" * 50 + some("0123456789abcdef", 40),
    ]
    for _ in range(60):
        words = [some("abcdeg hij", 8), some(b64, rnd.randint(15, 60)), some("0123456789abcdefABCDEF", rnd.randint(15, 50)), "token=" + some(b64, 7), "é ü"]
        rnd.shuffle(words)
        out.append(" ".join(words))
    return out + out[:3]


def test_spans_equal_a_plain_scan(spark):
    given = texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(given)], "doc_id long, text string, kind string")
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in op.digest(op.scan(docs)).collect()}
    assert len(got) == len(given)
    for i, t in enumerate(given):
        assert got[i] == plain(t), t
    assert sum("entropy" in g[4] for g in got.values()) > 30


def test_random_tails_of_paths_and_names_are_measured(spark):
    bad = ["/api/auth/reset/kXq9f2LmZ7Tr84vWc1Bn", "my_service_api_prod_9fJ2kQ7xLm4ZtR8vWc1B", "9fJ2kQ7xLm4ZtR8vWc1B-my-service-api-prod"]
    good = ["/dictionary/complexity/johnson/flowchart", "2024_my_service_api_prod_backup_12", "the-quick-brown-fox-jumps-over-4-lazy-dogs-"]
    docs = spark.createDataFrame([(i, f"see {t} ok") for i, t in enumerate(bad + good)], "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in op.digest(op.scan(docs)).collect()}
    clean = {r.doc_id: r.text for r in op.redact(docs).collect()}
    for i, t in enumerate(bad + good):
        assert ("base64_entropy" in rows[i]) == (i < len(bad)) and rows[i] == plain(f"see {t} ok")[4], t
        assert ("[secret]" in clean[i]) == (i < len(bad)), t
    assert "kXq9f2LmZ7Tr84vWc1Bn" not in clean[0] and "9fJ2kQ7xLm4ZtR8vWc1B" not in clean[1] and "9fJ2kQ7xLm4ZtR8vWc1B" not in clean[2]


def test_redaction_replaces_spans_and_keeps_the_rest(spark):
    rows = [(1, "é password=abcdefgh ok", "en"), (2, None, "en"), (3, "clean", None), (3, "clean", None), (None, "AKIA" + "Q" * 16 + "!", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = op.redact(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(
        map(str, [(1, "é [secret] ok", "en"), (2, None, "en"), (3, "clean", None), (3, "clean", None), (None, "[secret]!", "x")])
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, assign int")
    assert op.digest(op.scan(docs)).count() == 0 and op.redact(docs).count() == 0


def long_texts():
    rnd = random.Random(8)
    some = lambda chars, n: "".join(rnd.choice(chars) for _ in range(n))
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    return {
        "base64 run": "data: " + some(b64, 300_000),
        "many secrets": "".join(f"password={some(b64, 8)} é " for _ in range(50_000)),
        "many runs": " ".join(some(b64, 30) for _ in range(20_000)),
        "patchy run": "".join(some(b64, 30) + "a" * 40 for _ in range(6_000)),
        "hex": some("0123456789abcdef", 200_000),
    }


@pytest.mark.parametrize("name", list(long_texts()))
def test_long_texts_take_time_in_proportion(spark, name):
    text = long_texts()[name]
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    r = op.digest(op.scan(docs)).collect()[0]
    clean = op.redact(docs).collect()[0].text
    assert time.time() - start < 120  # some 30 s at most; by the square of the length it would be hours
    spans = [(int(a), int(b)) for a, b in (x.split(":")[1:] for x in r.spans.split(","))]
    if name in ("many secrets", "hex"):
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == plain_base(text)
    assert clean == plain_redaction(text, spans)


def plain_base(text):
    base = [(m.start(), 0, "assign", m.end()) for m in re.finditer(op.ASSIGN, text, re.ASCII) if len(m[2]) >= 6]
    base += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    shown = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(base))
    return sum(b[2] == "assign" for b in base), 0, sum(b[2] == "hex" for b in base), hashlib.sha256(shown.encode()).hexdigest()


def plain_redaction(text, spans):
    """Spans by start; what goes on with the one before gets no marker of its own. Spans that a base span covers change nothing."""
    out, at = [], 0
    for start, end in sorted(spans):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = end
    return "".join(out) + text[at:]


def test_redaction_of_overlapping_spans(spark):
    given = [t for t in texts() if t]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "doc_id long, text string")
    spans = {r.doc_id: [(int(a), int(b)) for a, b in (x.split(":")[1:] for x in r.spans.split(",") if x)] for r in op.digest(op.scan(docs)).collect()}
    for r in op.redact(docs).collect():
        assert r.text == plain_redaction(given[r.doc_id], spans[r.doc_id])


def test_own_columns_stay(spark):
    docs = spark.createDataFrame([(1, "password=abcdefgh", "a", "b", 5)], "doc_id long, text string, spans string, __spans string, assign int")
    assert [tuple(r) for r in op.redact(docs).collect()] == [(1, "[secret]", "a", "b", 5)]
