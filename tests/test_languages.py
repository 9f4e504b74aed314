import math
from collections import Counter

from newsloom.operators import languages as L
from newsloom.plans import language_queries
from newsloom.sources import tables


def spelled(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(c if "a" <= c <= "z" or c > "\x7f" else " " for c in low).split(" ")
    t = " " + " ".join(w for w in words if w) + " "
    return [t[i : i + 3] for i in range(len(t) - 2)]


ROWS = [(1, "The cat and the dog", "en"), (2, "the DOG, and: the end", "en"), (3, "der Hund und die Katze", "de"), (4, "und der Ärger über 7 Öfen", "de"),
        (5, "le chien et le chat, là", "fr"), (6, None, "fr"), (7, "", None), (8, "12 -- !", "de"), (9, "the katze", None), (10, "😀😀😀 naïve 😀", "xx"), (11, "zzzzqqq", None)]


def test_equals_a_plain_version(spark):
    counts: dict = {}
    for _, text, lang in ROWS:
        if lang:
            counts.setdefault(lang, Counter()).update(spelled(text))
    counts = {k: c for k, c in counts.items() if c}
    base = {k: round(math.log(0.5 / c.total()) * L.SCALE) for k, c in counts.items()}
    gain = {(k, g): round(math.log(n / c.total()) * L.SCALE) - base[k] for k, c in counts.items() for g, n in c.items()}
    docs = spark.createDataFrame(ROWS, "id int, text string, lang string").repartition(3)
    model = L.learn(docs)
    assert {(r.lang, r.gram): r.gain for r in model.collect()} == gain
    for r in L.identify(docs, model, "id").collect():
        own = spelled(next(t for i, t, _ in ROWS if i == r.id))
        scores = sorted((-(sum(gain.get((k, g), 0) for g in own) + len(own) * base[k]), k) for k in base if any((k, g) in gain for g in own))
        assert r.detected == (scores[0][1] if scores else "und"), r
        assert (r.margin is None) == (len(scores) < 2)
        if len(scores) > 1:
            assert abs(r.margin - (scores[1][0] - scores[0][0]) / len(own) / L.SCALE) < 1e-5


def test_long_texts_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "the end " * 150_000, "en"), (2, "ä" * 1_000_000, "de")], "id int, text string, lang string")
    model = L.learn(docs)
    assert {r.id: r.detected for r in L.identify(docs, model, "id").collect()} == {1: "en", 2: "de"}
    assert L.learn(docs.limit(0)).count() == 0
    assert {r.detected for r in L.identify(docs, model.limit(0), "id").collect()} == {"und"}
    assert L.identify(docs.limit(0), model, "id").count() == 0


def test_held_out_accuracy(spark, sf):
    found = language_queries.language_detected(spark, sf).where("held_out").collect()
    assert sum(r.labelled == r.detected for r in found) >= 0.95 * len(found) > 0
    assert len(found) == tables.table(spark, sf, "documents").where("doc_id % 3 = 0").count()
