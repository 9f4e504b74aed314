import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsloom.operators import topics


def test_small_corpus_is_not_modelled(spark):
    df = spark.createDataFrame([("a", "x" * 60)], "article_id string, contenu_clean string")
    row = topics.model_topics(df).first()
    assert (row["topic_id"], row["topic_label"], row["topic_prob"]) == (-1, "hors-sujet", 0.0)


@pytest.mark.parametrize("method", ["density", "centres"])
def test_model_finds_two_subjects(spark, method):
    a = "ocean fish water wave boat sail harbour storm"
    b = "bank money loan credit stock price market rate"
    rows = [(f"a{i}", f"{a} {a} tide{i}") for i in range(12)] + [(f"b{i}", f"{b} {b} coin{i}") for i in range(12)] + [("s", "short")]
    df = spark.createDataFrame(rows, "article_id string, contenu_clean string")
    out = {r["article_id"]: r for r in topics.model_topics(df, grid=(2, 4), method=method).collect()}
    assert len(out) == 25 and out["s"]["topic_id"] == -1 and out["s"]["topic_label"] == "hors-sujet"
    seas = {out[f"a{i}"]["topic_id"] for i in range(12)} - {-1}
    banks = {out[f"b{i}"]["topic_id"] for i in range(12)} - {-1}
    assert seas and banks and not seas & banks
    assert all(0 <= r["topic_prob"] <= 1 for r in out.values())
    label = out["a0"]["topic_label"]
    assert label.startswith(f"{out['a0']['topic_id']}_") and len(label.split("_")) == 4


def test_weights_follow_the_formula(spark):
    docs = [(0, "alpha alpha beta"), (0, "beta gamma the"), (1, "alpha delta 42")]
    df = spark.createDataFrame(docs, "topic_id int, contenu_clean string")
    got = {(r["topic_id"], r["term"]): r["weight"] for r in topics.term_weights(df).collect()}
    counts = {0: Counter("alpha alpha beta beta gamma".split()), 1: Counter("alpha delta 42".split())}
    mean = (5 + 3) / 2
    total = counts[0] + counts[1]
    for t, c in counts.items():
        for term, n in c.items():
            assert math.isclose(got.pop((t, term)), n / sum(c.values()) * math.log(1 + mean / total[term]))
    assert not got


def test_labels(spark):
    rows = [(0, 1, "42"), (0, 2, "the"), (0, 3, "sea"), (0, 4, "boat"), (0, 5, "wave"), (0, 6, "sail"), (1, 1, "42"), (1, 2, "x"), (2, 1, "1234"), (-1, 1, "y")]
    df = spark.createDataFrame(rows, "topic_id int, term_no int, term string")
    out = {r["topic_id"]: r["topic_label"] for r in topics.topic_labels(df).collect()}
    assert out == {0: "0_sea_boat_wave", 1: "1_sujet_1", 2: "2_1234", -1: "hors-sujet"}


def test_small_clusters_become_outliers(spark):
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") < 4, 9).otherwise(F.col("id") % 2).cast("int").alias("cluster"))
    out = topics.drop_small(df).groupBy("topic_id").count().collect()
    assert {r["topic_id"]: r["count"] for r in out} == {-1: 4, 0: 48, 1: 48}


def plain_merge(counts, documents, least):
    """Steps by plain dictionaries."""
    counts, documents, steps = {t: Counter(c) for t, c in counts.items()}, dict(documents), []
    while len(counts) > 1:
        total = sum(counts.values(), Counter())
        mean = sum(sum(c.values()) for c in counts.values()) / len(counts)
        w = {t: {x: n / sum(c.values()) * math.log(1 + mean / total[x]) for x, n in c.items()} for t, c in counts.items()}
        norm = {t: math.sqrt(sum(v * v for v in c.values())) for t, c in w.items()}
        cosine = {(a, b): round(sum(v * w[b].get(x, 0) for x, v in w[a].items()) / norm[a] / norm[b], 10) for a in w for b in w if a < b}
        (a, b), best = min(cosine.items(), key=lambda e: (-e[1], e[0]))
        if best < least:
            break
        kept, absorbed = sorted((a, b), key=lambda t: (-documents[t], t))
        steps.append((len(steps) + 1, kept, absorbed, best))
        counts[kept] += counts.pop(absorbed)
        documents[kept] += documents.pop(absorbed)
    return steps


def test_merging_follows_the_plain_rule(spark):
    rng = random.Random(4)
    words = {t: [f"w{k}" for k in range(t // 3 * 8, t // 3 * 8 + 10)] for t in range(9)}
    counts = {t: Counter(rng.choice(words[t]) for _ in range(40 + 5 * t)) for t in range(9)}
    documents = {t: [4, 9, 9][t % 3] for t in range(9)}
    rows = [(t, x, n) for t, c in counts.items() for x, n in c.items()] + [(-1, "w0", 50)]
    frame = spark.createDataFrame(rows, "topic_id int, term string, n long")
    sizes = spark.createDataFrame([*documents.items(), (-1, 99)], "topic_id int, n long")
    steps = topics.merge_topics(frame, sizes, 0.5)
    expected = plain_merge(counts, documents, 0.5)
    assert [s[:3] for s in steps] == [s[:3] for s in expected] and 4 <= len(steps) < 8
    assert all(math.isclose(a[3], b[3], abs_tol=1e-9) for a, b in zip(steps, expected))
    ids = {r.t: r.to for r in spark.range(-1, 9).select(F.col("id").alias("t"), topics.merged_ids(steps, F.col("id")).alias("to")).collect()}
    assert ids[-1] == -1 and len(set(ids.values())) == 10 - len(steps) and all(ids[a] == ids[k] for _, k, a, _ in steps)
    assert topics.merge_topics(frame, sizes, 1.1) == []


def test_wide_vectors_are_assigned_once(spark):
    """Zero entries add nothing, and the clusters are worked out once, however often they are asked for."""
    from pyspark.ml.linalg import Vectors

    rng = random.Random(8)
    given = [{i: rng.uniform(0.1, 1) for i in rng.sample(range(300), rng.randint(0, 9))} for _ in range(40)]
    vectors = spark.createDataFrame([(k, Vectors.sparse(300, v)) for k, v in enumerate(given)], ["n", "features"])
    centres = [[rng.choice([0.0, rng.random()]) for _ in range(300)] for _ in range(4)]
    for r in topics.assign(vectors, centres).collect():
        own = given[r.n]
        size = sum(x * x for x in own.values()) ** 0.5
        cosines = [sum(x * c[i] for i, x in own.items()) / (size * sum(y * y for y in c) ** 0.5) if own else 0.0 for c in centres]
        assert r.cluster == cosines.index(max(cosines)) and abs(r.membership - max(cosines)) < 6e-5
    found = topics.cluster(vectors, (2, 3))  # some vectors have no entries
    assert {r.n for r in found.where("cluster = -1").collect()} == {k for k, v in enumerate(given) if not v}
    same = spark.createDataFrame([(k, Vectors.sparse(300, {3: 1.0})) for k in range(9)], ["n", "features"])
    assert {r.cluster for r in topics.cluster(same, (2, 3)).collect()} == {0}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "UDF" not in plan
