"""Density clusters against a plain version that compares all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import density as D


def groups(n, edges, level):
    """Components of the edges up to a level, as sorted lists."""
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b, at in edges:
        if at <= level:
            a, b = sorted((top(a), top(b)))
            up[b] = a
    out = {}
    for i in range(n):
        out.setdefault(top(i), []).append(i)
    return list(out.values())


def plain_clusters(vectors, least, k=D.NEIGHBOURS, levels=D.LEVELS):
    """Topic of each row, from the top of the tree down."""
    x = np.array(vectors, float)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x = x / np.where(norm > 0, norm, 1)
    n = len(x)
    d = np.sqrt(np.maximum(((x[:, None] - x[None]) ** 2).sum(axis=2), 0))
    d[d < 1e-7] = 0  # the product form is not exact for equal rows
    core = [sorted(np.delete(d[i], i))[min(k, n - 1) - 1] for i in range(n)]
    pairs = sorted((max(d[i, j], core[i], core[j]), i, j) for i in range(n) for j in range(i + 1, n))
    up, forest = {i: i for i in range(n)}, []
    for w, i, j in pairs:
        a, b = i, j
        while up[a] != a:
            a = up[a]
        while up[b] != b:
            b = up[b]
        if a != b:
            up[a] = b
            forest.append((w, i, j))
    weights = [w for w, _, _ in forest]
    high = max(weights)
    low = max(min(w for w in weights if w > 0), D.NO_WEIGHT * high)
    step = (high / low) ** (1 / (levels - 1))
    level = lambda w: 0 if w <= low else min(levels - 1, math.ceil(math.log(w / low) / math.log(step) - 1e-9))
    value = lambda i: low * step**i
    edges = [(i, j, level(w)) for w, i, j in forest]

    def node(rows, at, born):
        """A cluster that exists from level `at` down: ({row: level it leaves at}, children)."""
        left, children, current = {}, [], set(rows)
        for lower in range(at - 1, -2, -1):
            parts = [set(g) & current for g in groups(n, edges, lower)] if lower >= 0 else [{r} for r in current]
            large = [p for p in parts if len(p) >= least]
            if len(large) == 1:
                left.update({r: lower + 1 for r in current - large[0]})
                current = large[0]
            else:
                kept = set().union(*large) if large else set()
                left.update({r: lower + 1 for r in current - kept})
                children = [node(p, lower + 1, lower + 1) for p in large]
                break
        return left, children, born, sorted(rows)

    def chosen(c, root):
        left, children, born, rows = c
        begin = 0 if born is None else 1 / value(born)
        own = sum(1 / value(at) - begin for at in left.values()) + sum(len(k[3]) * (1 / value(k[2]) - begin) for k in children)
        below = [chosen(k, False) for k in children]
        total = sum(b[0] for b in below)
        if not root and own >= total - 1e-12:
            return own, [rows]
        return total, [r for b in below for r in b[1]]

    return chosen(node(range(n), levels, None), True)[1]


def made_up(seed, n=240):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, 6)) * 3
    rows = [centres[i % 4] + rng.normal(size=6) * (0.2 + 0.3 * (i % 4)) for i in range(n - 40)]
    rows += [rng.normal(size=6) * 4 for _ in range(38)] + [rows[0], rows[0]]
    return [[float(v) for v in r] for r in rows]


def found(spark, vectors, **options):
    df = spark.createDataFrame([(f"a{i}", v, "x") for i, v in enumerate(vectors)], "name string, e array<double>, p string").repartition(4)
    rows = D.density_clusters(df, "name", F.col("e"), **options).collect()
    assert len(rows) == len(vectors)
    return {int(r["name"][1:]): (r.topic_id, r.topic_prob) for r in rows}


def as_sets(result):
    topics = {t for t, _ in result.values()} - {-1}
    return sorted(sorted(i for i, (t, _) in result.items() if t == k) for k in topics)


@pytest.mark.parametrize("seed, least", [(1, 12), (2, 8), (3, 25)])
def test_against_all_pairs(spark, seed, least):
    vectors = made_up(seed)
    got = found(spark, vectors, least=least, block=1000, levels=60)
    assert as_sets(got) == sorted(plain_clusters(vectors, least, levels=60))
    outside = [i for i, (t, _) in got.items() if t == -1]
    assert outside and all(got[i][1] == 0 for i in outside)
    sizes = {t: sum(x == t for x, _ in got.values()) for t in {t for t, _ in got.values()} - {-1}}
    assert sorted(sizes, key=lambda t: -sizes[t]) == sorted(sizes) and all(0 < p <= 1 for t, p in got.values() if t >= 0)
    assert all(max(p for x, p in got.values() if x == t) == 1 for t in sizes)


def test_contraction_in_spark_is_that_of_one_place(spark):
    vectors = made_up(5, 160)
    assert found(spark, vectors, least=10, levels=12, finish=0) == found(spark, vectors, least=10, levels=12)


def test_small_blocks_find_the_same_regions(spark):
    vectors = made_up(4, 400)
    whole, cut = (found(spark, vectors, least=20, block=b) for b in (1000, 64))
    agree = sum((whole[i][0] == -1) == (cut[i][0] == -1) for i in whole) / len(whole)
    assert len(as_sets(whole)) == len(as_sets(cut)) and agree > 0.9


def test_equal_rows_do_not_grow_a_block(spark):
    vectors = [[1.0, 0.0, 0.0]] * 300 + [[0.0, 1.0, 0.01 * i] for i in range(60)] + [[0.0, 0.02 * i, 1.0] for i in range(60)]
    got = found(spark, vectors, least=20, block=64)
    assert {got[i][0] for i in range(300)} == {0} and 0 not in {got[i][0] for i in range(300, 420)}


def test_spanning_forest_is_least(spark):
    rng = np.random.default_rng(0)
    edges = sorted({(int(a), int(b)) for a, b in rng.integers(0, 80, size=(300, 2)) if a < b})
    weights = [float(w) for w in rng.integers(0, 9, size=len(edges))]
    got = D.spanning_forest(spark.createDataFrame([(a, b, w) for (a, b), w in zip(edges, weights)], "a long, b long, w double")).collect()
    up, total, n = {i: i for i in range(80)}, 0.0, 0
    for w, a, b in sorted((w, a, b) for (a, b), w in zip(edges, weights)):
        while up[a] != a:
            a = up[a]
        while up[b] != b:
            b = up[b]
        if a != b:
            up[a], total, n = b, total + w, n + 1
    assert len(got) == n and sum(r.w for r in got) == total


def test_odd_tables(spark):
    schema = "name string, e array<double>"
    run = lambda rows: [tuple(r) for r in D.density_clusters(spark.createDataFrame(rows, schema), "name", F.col("e")).collect()]
    assert run([]) == []
    assert run([("a", None)]) == [("a", -1, 0.0)]
    assert run([("a", [1.0, 0.0])]) == [("a", -1, 0.0)]
    assert sorted(run([("a", [1.0, 0.0]), ("b", None), ("c", [0.0, 0.0])])) == [("a", -1, 0.0), ("b", -1, 0.0), ("c", -1, 0.0)]


def test_rounds_do_not_grow_with_the_levels(spark, monkeypatch):
    """The levels of the grid are contracted side by side, so their number adds halvings, not rounds of their own."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, s, (60, 2)) for c, s in ((0, 0.5), (4, 0.1), (9, 1.0))])
    points = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "p long, v array<double>")
    forest = D.written(D.spanning_forest(D.mutual_reachability(points)), "test-forest")
    here, tree_, _ = D.condensed(points.select("p"), forest, 20)
    expected = sorted(map(tuple, here.collect()), key=str), len(tree_.clusters)
    calls, real = [], D.written
    monkeypatch.setattr(D, "written", lambda df, label: calls.append(label) or real(df, label))
    apart, other, _ = D.condensed(points.select("p"), forest, 20, finish=0)
    assert (sorted(map(tuple, apart.collect()), key=str), len(other.clusters)) == expected
    assert forest.select("w").distinct().count() > 100 and len(calls) < 120, len(calls)


def test_few_edges_take_few_jobs(spark, monkeypatch):
    """Rounds end in one place once few edges are left: before, each round of the forest was half a dozen jobs of its own."""
    calls, real = [], D.written
    monkeypatch.setattr(D, "written", lambda df, label: calls.append(label) or real(df, label))
    got = found(spark, made_up(6), least=12)
    assert {t for t, _ in got.values()} > {-1} and len(calls) < 12, calls


def test_forest_of_one_place_is_that_of_the_rounds(spark):
    rng = np.random.default_rng(1)
    edges = sorted({(int(a), int(b)) for a, b in rng.integers(0, 120, size=(500, 2)) if a < b})
    rows = [(a * 2**33 + 5, b * 2**33 + 5, float(w)) for (a, b), w in zip(edges, rng.integers(0, 4, size=len(edges)))]
    df = spark.createDataFrame([*rows, (7, 7, 0.0)], "a long, b long, w double")
    apart, mixed, one = (sorted(map(tuple, D.spanning_forest(df, n).collect())) for n in (0, 200, 10_000))
    assert apart == mixed == one and len(one) > 100
    assert D.spanning_forest(df.where("a = b")).collect() == []


def test_blocks_are_cut_row_by_row(spark):
    """Neighbouring blocks share OVERLAP rows, whatever the Arrow batches; the last may be shorter."""
    points = spark.createDataFrame([(i, [float(i), 1.0], 0.0) for i in range(1000)], "p long, v array<double>, core double").coalesce(1)
    sizes = lambda ids, x, core, k: (ids[:1], ids[-1:], np.array([float(len(set(ids)))]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        got = D.in_blocks(points, [500.0, 0.0], sizes, 5, 2, 300, 7, D.ranges(points, 1000, [500.0, 0.0], 2, 300, 7)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.w for r in got) == sorted([300, 300, 300, 1000 - 3 * (300 - D.OVERLAP)] * 2), got


def test_length_is_worked_out_once_per_row(spark):
    """Wide vectors cost in proportion to their width: the norm does not stand inside the lambda over the entries."""
    wide = spark.range(4).select("id", F.array(*[F.rand(i) for i in range(3)]).alias("v"))
    seen, real = [], D.written
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(D, "written", lambda df, label: (label == "density-rows" and seen.append(df._jdf.queryExecution().optimizedPlan().toString())) or real(df, label))
        D.density_clusters(wide, "id", F.col("v"))
    over_entries = next(x for x in seen[0].split("transform(")[1:])
    assert "aggregate(" not in over_entries.split("END AS v")[0]


def test_ranges_hold_each_row_once_in_order(spark, monkeypatch):
    """Tasks' rows are dealt out by bounds from a sample, in the order of signs and numbers, equal signs included; the rows are worked out once."""
    monkeypatch.setattr(D, "RANGE", 1)
    rows = [(i * 7 % 1009, [1.0, 0.0] if i % 3 else [float(i % 50), float(i % 17)]) for i in range(1009)]
    points = spark.createDataFrame(rows, "p long, v array<double>").withColumn("core", F.lit(0.0))
    cuts = D.ranges(points, 1009, [1.0, 0.5], 3, 100, 7)
    p = np.array([r[0] for r in rows])
    for signs, bounds in zip(D.signs_of(np.array([r[1] for r in rows]) - np.array([1.0, 0.5]), 3, 7), cuts):
        order = np.lexsort((p, signs))
        at = D.range_of(signs, p, bounds)
        assert np.all(np.diff(at[order]) >= 0) and at.min() == 0 and at.max() == 9 and np.bincount(at).max() < 300
    every = D.in_blocks(points, [1.0, 0.5], lambda ids, x, core, k: (ids, ids, core), 5, 3, 100, 7, cuts)
    assert {(r.a, r["count"] >= 3) for r in every.groupBy("a").count().collect()} == {(i, True) for i in range(1009)}
    assert "RangePartitioning" not in every._jdf.queryExecution().executedPlan().toString()
