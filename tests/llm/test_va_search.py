"""Top-k search against all exact scores."""

import math
import random

from pyspark.sql import functions as F

from newsloom.llm import va_search as op


def plain(rows, k):
    usable = [(i, [max(-(1 << 53), min(1 << 53, math.floor(64 * x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(usable):
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(usable) if m != n and len(b) == len(a))
            out += [(q, rank, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def case(n, seed, spread):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(0, spread) for _ in range(6)]) for i in range(n)]
    rows += [(n + i, rows[i % 7][1]) for i in range(40)]  # ties
    rows += [(None, rows[0][1]), (1000, None), (1001, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (1002, [float("nan")] * 6), (1003, [float("inf")] * 6)]
    rows += [(1004, [1.0, 2.0]), (1020, [1.0, 3.0]), (1040, []), rows[3], (20, [0.1] * 6), (-20, [-0.2] * 6)]
    return rows


def test_equals_all_exact_scores(spark):
    for seed, spread, bits in [(1, 0.2, 6), (2, 40.0, 2), (3, 1e7, 1)]:
        rows = case(300, seed, spread)
        table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, d int")
        got = op.search(table, F.col("vec_id") % 20 == 0, k=5, bits=bits, query_block=7, candidate_block=60)
        assert sorted(tuple(r) for r in got.collect()) == plain(rows, 5)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in op.search(table, F.col("vec_id") % 20 == 0).collect()) == plain(rows, 20)
    assert op.search(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_rows_of_equal_id_are_candidates_and_queries_of_their_own(spark):
    rows = [(20, [1.0, 2.0]), (21, [1.0, 1.0]), (21, [5.0, 5.0]), (20, [0.0, 3.0]), (40, [1.0, 2.0]), (40, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in op.search(table, F.col("vec_id") % 20 == 0, k=3).collect())
    assert got == plain(rows, 3) and (20, 1, 21, 61_440) in got


def test_components_of_any_size(spark):
    rnd = random.Random(6)
    for size in (1e9, 1e14, 1e30, 1e300):
        rows = [(i, [rnd.gauss(0, 1) * size ** rnd.random() for _ in range(4)]) for i in range(120)]
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = op.search(table, F.col("vec_id") % 20 == 0, k=5, query_block=3, candidate_block=50)
        assert sorted(tuple(r) for r in got.collect()) == plain(rows, 5)
