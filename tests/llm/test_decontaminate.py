"""Benchmark windows in documents against a plain search."""

import hashlib
import random
import re

from newsloom.llm import decontaminate as op

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for win, owners in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found |= owners
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def case():
    rnd = random.Random(2)
    vocabulary = ["the", "of", "é", "x1", "ünder", "cat", "dog", "sat", "É", "on"]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(1, text(14)), (2, "Hello, WORLD!"), (3, "single"), (10, text(10)), (4, None), (5, ""), (6, "--- !"), (7, text(25)), (2, "hello world")]
    items += [(8, items[0][1]), (9, "the the the the the the the the the the the")]
    docs = [(None, text(5)), (1, None), (2, ""), (3, "hello world"), (3, "Hello-World hello world single"), (4, "x" * 5000), (5, " . ")]
    for i in range(60):
        parts = [text(rnd.randint(0, 20))]
        for _ in range(rnd.randint(0, 3)):
            w = words(rnd.choice(items)[1])
            a = rnd.randint(0, 3)
            parts += [" ".join(w[a : a + rnd.randint(5, 20)]), text(rnd.randint(0, 6))]
        docs.append((100 + i, " ".join(parts)))
    docs += [(200, "the " * 500), (201, text(3000)), *docs[7:12]]
    return docs, items


def test_hits_equal_a_plain_search(spark):
    docs, items = case()
    d = spark.createDataFrame([(i, t, "a") for i, t in docs], "doc_id long, text string, key string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in op.digest(op.decontaminate(d, b)).collect()), key=repr)
    assert got == sorted(plain(docs, items), key=repr)
    clean = op.clean(d, b)
    assert clean.columns == d.columns
    assert sorted(clean.select("doc_id", "text").collect(), key=repr) == sorted([r for r, p in zip(docs, plain(docs, items)) if not p[5]], key=repr)


def test_items_without_an_id_count(spark):
    d = spark.createDataFrame([(1, "one two"), (2, "x three four y"), (3, "three four one two five"), (4, "none")], "doc_id long, text string")
    b = spark.createDataFrame([(None, "one two"), (None, "five"), (7, "three four"), (8, "three four")], "item_id long, text string")
    got = {r.doc_id: tuple(r)[2:] for r in op.digest(op.decontaminate(d, b)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {1: (2, 1, sha(""), True), 2: (2, 2, sha("7,8"), True), 3: (5, 3, sha("7,8"), True), 4: (0, 0, sha(""), False)}
    assert [r.doc_id for r in op.clean(d, b).collect()] == [4]
    import duckdb

    documents, benchmark = d.toPandas(), b.toPandas().astype({"item_id": "Int64"})  # noqa: F841
    assert {r[0]: tuple(r[2:]) for r in duckdb.sql(op.ORACLE).fetchall()} == got


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    none = op.digest(op.decontaminate(d, b.limit(0))).collect()
    assert [tuple(r)[:4] for r in none] == [(1, 2, 0, 0)] and op.clean(d, b.limit(0)).count() == 1
    assert op.decontaminate(d.limit(0), b).count() == 0 and op.clean(d.limit(0), b).count() == 0
