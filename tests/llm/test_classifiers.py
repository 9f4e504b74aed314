"""Language identification and toxicity: plain code lengths, held-out accuracy, odd rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from newsloom.llm import ppm_language, toxicity

SYLLABLES = {"aa": "the ing er on ti ha wh sh ou", "bb": "le ment eau oi ré ch pa du ê", "cc": "ein sch keit über lich tz au ß"}


def sentence(rnd, lang, n):
    some = SYLLABLES[lang].split()
    return " ".join("".join(rnd.choice(some) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def plain_bits(texts, text):
    """Code length of `text` by the textbook: longest context first, escapes below."""
    follow = [defaultdict(Counter) for _ in range(ppm_language.ORDER + 1)]
    lead = b" " * ppm_language.ORDER
    for t in texts:
        data = lead + ppm_language.folded(t)
        for i in range(len(lead), len(data)):
            for k in range(ppm_language.ORDER + 1):
                follow[k][data[i - k : i]][data[i]] += 1
    data, bits = lead + ppm_language.folded(text), 0.0
    for i in range(len(lead), len(data)):
        for k in range(ppm_language.ORDER, -1, -1):
            seen = follow[k].get(data[i - k : i])
            if not seen:
                continue
            total, d = sum(seen.values()), len(seen)
            if data[i] in seen:
                bits -= math.log2(seen[data[i]] / (total + d))
                break
            bits -= math.log2(d / (total + d))
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(monkeypatch):
    rnd = random.Random(3)
    samples = {l: [sentence(rnd, l, 30) for _ in range(5)] for l in SYLLABLES}
    model = ppm_language.train(samples)
    texts = [sentence(rnd, "aa", 20) + " Zürich 中文 \x00!", "A", "q" * 50, sentence(rnd, "bb", 200)]
    for size in (1 << 20, 37):
        monkeypatch.setattr(ppm_language, "SLICE", size)
        found = ppm_language.totals(model, [ppm_language.folded(t) for t in texts])
        for t, row in zip(texts, found):
            for l, bits in zip(model.languages, row):
                assert abs(bits - plain_bits(samples[l], t)) < 1e-3 * max(1, bits)


def test_memory_of_judging_follows_the_slice():
    """A text of two megabytes, and many short ones: a few MB besides the texts themselves."""
    import tracemalloc

    rnd = random.Random(5)
    model = ppm_language.train({l: [sentence(rnd, l, 30)] for l in SYLLABLES})
    texts = [ppm_language.folded("the ing " * 250_000), *[ppm_language.folded("le ment " * 250)] * 1000]
    tracemalloc.start()
    try:
        found = ppm_language.totals(model, texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 20e6
    assert [model.languages[int(row.argmin())] for row in found] == ["aa"] + ["bb"] * 1000


def test_a_text_is_sent_to_the_judge_once(spark):
    rnd = random.Random(6)
    model = ppm_language.train({l: [sentence(rnd, l, 30)] for l in SYLLABLES})
    docs = spark.createDataFrame([(1, "the ing on", "x"), (2, None, None)], "doc_id long, text string, judged_text string")
    for keep, sent in ((None, 3), (["doc_id"], 2), (["text"], 1)):
        found = ppm_language.identify(docs, model, keep=keep)
        assert found._jdf.queryExecution().analyzed().child().output().size() == sent
        assert [r.lang_pred for r in found.collect()] == ["aa", "und"]
        assert found.columns == [*(keep or docs.columns), "lang_pred", "score"]


def documents(rnd, n):
    rows = []
    for i in range(n):
        lang = rnd.choice(sorted(SYLLABLES))
        text = sentence(rnd, lang, rnd.randint(8, 60))
        toxic = i % 4 == 0
        if toxic:
            words = text.split()
            words[rnd.randrange(len(words))] = {"aa": "scum", "bb": "lourd", "cc": "mistig"}[lang] + rnd.choice(SYLLABLES[lang].split()) + rnd.choice([",", ".", ""])
            text = " ".join(words)
        rows.append((i, text, lang, int(toxic)))
    return rows


ODD = [(9000, None), (9001, ""), (9002, "123 ... !"), (None, "the ing on"), (9003, "ein " * 20000), (9004, " \n"), (9005, "\x00")]


def test_languages_of_held_out_rows(spark):
    rows = documents(random.Random(1), 400)
    docs = spark.createDataFrame([(i, t, l, "s", 0.5) for i, t, l, _ in rows] + [(i, t, None, "s", 0.5) for i, t in ODD] + [(0, rows[0][1], "aa", "s", 0.5)],
                                 "doc_id long, text string, lang string, lang_pred string, score double")
    model = ppm_language.learn(docs)
    assert model.languages == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in ppm_language.identify(docs, model, keep=["doc_id", "lang"]).collect()}
    held = [(i, l) for i, _, l, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i].lang_pred == l for i, l in held) >= 0.97 * len(held)
    assert [got[i].lang_pred for i in (9000, 9001, 9002, 9004, 9005)] == ["und"] * 5 and got[9003].lang_pred == "cc"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert ppm_language.identify(docs, ppm_language.learn(docs.limit(0)), keep=["doc_id"]).where("lang_pred <> 'und'").count() == 0
    assert ppm_language.identify(docs.limit(0), model).count() == 0


def test_toxicity_of_held_out_rows(spark):
    rows = documents(random.Random(2), 1200)
    docs = spark.createDataFrame([(i, t, l, 7) for i, t, l, _ in rows] + [(i, t, None, 7) for i, t in ODD] + [(rows[0][0], rows[0][1], "aa", 7)],
                                 "doc_id long, text string, lang string, score int")
    labels = spark.createDataFrame([(i, y, 1) for i, _, _, y in rows] + [(None, 1, 1), (9003, None, 1), (0, 1, 1)], "doc_id long, toxic int, text int")
    model = toxicity.learn(docs, labels)
    got = {r.doc_id: r for r in toxicity.judge(docs, model, keep=["doc_id"]).collect()}
    held = [(i, y) for i, _, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum(got[i].predicted == y for i, y in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert got[9000].score == got[9001].score == got[9004].score
    assert toxicity.judge(docs, toxicity.learn(docs, labels.limit(0)), keep=["doc_id"]).where("score <> 0").count() == 0
    assert toxicity.judge(docs.limit(0), model, keep=["doc_id"]).count() == 0


def test_slices_of_a_long_text_agree(monkeypatch):
    rng = np.random.default_rng(1)
    known = [[toxicity.NONE] * toxicity.FEATURES] + [toxicity.features(f"w{i}") for i in range(50)]
    docs = [rng.integers(1, 51, n).astype("i4") for n in (0, 1, 2, 5, 300, 1000)]
    model = toxicity.fit(docs, known, np.array([0, 1, 0, 1, 0, 1], "f4"), epochs=1)
    vectors = model.vectors(known)
    whole = model.logits(docs, vectors)
    monkeypatch.setattr(toxicity, "SLICE", 7)
    assert np.allclose(whole, model.logits(docs, vectors), atol=1e-4)


def test_toxicity_is_learned_from_all_labelled_rows(spark):
    """The toxic words of most rows are not among those the driver starts on, some only stand in texts longer than it takes."""
    rnd, rows = random.Random(8), []
    for i in range(1600):
        words = sentence(rnd, "aa", rnd.randint(8, 40)).split()
        if i % 4 == 0:
            words[rnd.randrange(len(words))] = ("zorgum", "quexil", "vubnak", "jiptol")[i // 4 % 4]
        if i % 16 == 12:
            words = words * 12
        rows.append((i, " ".join(words), "aa", int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, y int").repartition(3)
    labels = docs.select("doc_id", docs.y.alias("toxic"))
    model = toxicity.learn(docs, labels, rows=4, most_bytes=700)
    got = {r.doc_id: r for r in toxicity.judge(docs, model, keep=["doc_id"]).collect()}
    held = [(i, y) for i, _, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].predicted == y for i, y in held) >= 0.95 * len(held)


def test_texts_that_reach_over_slices_are_learned_alike(monkeypatch):
    rng = np.random.default_rng(2)
    known = [[toxicity.NONE] * toxicity.FEATURES] + [toxicity.features(f"w{i}") for i in range(50)]
    docs = [rng.integers(1, 51, n).astype("i4") for n in (0, 1, 7, 40, 90)]
    labels = np.array([0, 1, 0, 1, 0], "f4")
    whole = toxicity.fit(docs, known, labels, epochs=3)
    monkeypatch.setattr(toxicity, "SLICE", 5)
    pieces = toxicity.fit(docs, known, labels, epochs=3)
    assert np.allclose(whole.embedding, pieces.embedding, atol=1e-3) and np.allclose(whole.kernel, pieces.kernel, atol=1e-3)
