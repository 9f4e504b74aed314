"""Exact top-k by inner product with vector-approximation files.

Vectors become whole numbers, floor(scale * x). Each dimension is cut into 2 ** bits cells of equal width between its
least and largest value; a vector's approximation is its cell numbers, one byte each. The search reads
approximations first: a cell bounds what a dimension can add to the inner product, so each approximation gives a lower and
an upper bound. Candidates whose upper bound is below the kth largest lower bound are out. The
others' exact vectors are read in the order of their bounds: first the best `AHEAD` * k of a query, whose kth
exact score then rules out all but those whose bound still reaches it; these are read as well, and the result is certain.

Queries meet candidates block by block: a pair of blocks is a group of bounded size, and every
query meets every block. This is a search for a stated set of queries, which costs queries times rows; a row is copied once for
so many rows as a block of the other side holds.

Rows without an id, and vectors that are null, empty or hold a null or a non-finite number, take no part. Every other row is a
candidate of its own and, if its id is asked for, a query of its own, so rows of equal id meet too. Vectors of different lengths have no
score together. Ties go to the smaller id. A query with fewer than k partners gets all. Scaled components saturate at 2^53; scores are
exact, and those beyond 64 bits are given as the last number of 64 bits. Other columns are not read."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from newsloom.llm.common import Shared, ship, stored

ship(__name__)

K = 20
SCALE = 64
BITS = 6
AHEAD = 2
QUERY_BLOCK = 8_192
CANDIDATE_BLOCK = 16_384
AT_ONCE = 256  # queries of a block that are multiplied together
LARGEST = 1 << 53
WIDE = 1 << 62  # bounds are cut off here; what lies beyond is read exactly
EXACT_SINGLE = 1 << 24  # up to here whole numbers are exact in 32-bit floats
BOUNDS = "query_row long, row long, low long, high long"


def whole_numbers(rows: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    vector = F.col(vector_column)
    good = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = rows.where(F.col(id_column).isNotNull() & (F.size(vector) > 0)).where(good)
    scaled = lambda x: F.greatest(F.least(F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(1e17)), F.lit(-1e17))), F.lit(LARGEST)), F.lit(-LARGEST))
    whole = F.transform(vector, lambda x: scaled(x).cast("long"))
    return usable.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("vec_id"), whole.alias("v"))


def grid(vectors: DataFrame, bits: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length of vector: each dimension's least value and width of cells. As many numbers as dimensions."""
    ends = vectors.select(F.size("v").alias("d"), F.posexplode("v").alias("i", "x")).groupBy("d", "i").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    found: dict[int, list] = {}
    for r in ends.orderBy("d", "i").collect():
        found.setdefault(r.d, []).append((r.a, -(-(r.b - r.a + 1) // (1 << bits))))
    return {d: (np.array([a for a, _ in x], "i8"), np.array([w for _, w in x], "i8")) for d, x in found.items()}


def approximate(vectors: DataFrame, cells: dict) -> DataFrame:
    """row, vec_id, d, cell numbers as bytes, and the vector as 64-bit numbers."""
    shared = Shared(vectors.sparkSession, cells)

    def task(batches):
        import pyarrow as pa

        cells = shared.get()
        names = ["row", "vec_id", "d", "cells", "exact"]
        for batch in batches:
            codes, exact, sizes = [], [], []
            for v in batch.column(2):
                x = v.values.to_numpy(zero_copy_only=False).astype("i8")
                least, width = cells.get(len(x), (np.zeros(0, "i8"), np.ones(0, "i8")))
                codes.append(((x - least) // width).astype("u1").tobytes())
                exact.append(x.tobytes())
                sizes.append(len(x))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(sizes, pa.int32()), pa.array(codes, pa.binary()), pa.array(exact, pa.binary())], names=names)

    return vectors.select("row", "vec_id", "v").mapInArrow(task, "row long, vec_id long, d int, cells binary, exact binary")


def matrix(column, kind: str, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, d)


def scan(queries: DataFrame, candidates: DataFrame, cells: dict, k: int) -> DataFrame:
    """Bounds of the pairs that a pair of blocks can't rule out."""
    shared = Shared(queries.sparkSession, cells)

    def some(q, own, ids, double_mid, width, kind):
        import pyarrow as pa

        middle = q.astype(kind) @ double_mid.astype(kind).T
        reach = np.abs(q).astype(kind) @ (width - 1).astype(kind)
        low, high = (middle - reach[:, None]).astype("f8" if kind != "O" else "O"), middle + reach[:, None]
        low[own[:, None] == ids[None, :]] = -np.inf
        nth = len(ids) - k
        floor = np.sort(low, axis=1)[:, nth] if kind == "O" and nth >= 0 else np.partition(low, nth, axis=1)[:, nth] if nth >= 0 else np.full(len(q), -np.inf)
        i, j = np.nonzero((high >= floor[:, None]) & (own[:, None] != ids[None, :]))
        half = lambda x: pa.array(np.array(np.clip(x // 2, -WIDE, WIDE), "i8"))
        return [pa.array(own[i]), pa.array(ids[j]), half(low[i, j]), half(-(-high[i, j] // 2) * 2)]

    def task(left, right):
        import pyarrow as pa

        schema = pa.schema([(n, pa.int64()) for n in ("query_row", "row", "low", "high")])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        d = left.column("d")[0].as_py()
        least, width = shared.get().get(d, (np.zeros(0, "i8"), np.ones(0, "i8")))
        q, codes = matrix(left.column("exact"), "<i8", d), matrix(right.column("cells"), "u1", d)
        double_mid = 2 * least + 2 * codes.astype("i8") * width + (width - 1)  # twice the middle of a cell
        most = 2 * int(np.abs(q).max(initial=0)) * int(np.abs(double_mid).max(initial=0) + width.max(initial=0)) * max(d, 1)
        kind = "f4" if most < EXACT_SINGLE else "f8" if most < 1 << 53 else "O"
        ids, own = right.column("row").to_numpy(), left.column("row").to_numpy()
        parts = [some(q[n : n + AT_ONCE], own[n : n + AT_ONCE], ids, double_mid, width, kind) for n in range(0, len(q), AT_ONCE)]
        return pa.concat_tables([pa.table(p, schema=schema) for p in parts])

    pairs = ["d", "qb", "cb"]
    return queries.groupBy(*pairs).cogroup(candidates.groupBy(*pairs)).applyInArrow(task, BOUNDS)


def scores(pairs: DataFrame, queries: DataFrame, vectors: DataFrame, wide: bool) -> DataFrame:
    """Exact inner products of the listed pairs: as decimals where they may not fit 64 bits."""
    left = queries.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    kind, factor = ("decimal(38,0)", "decimal(18,0)") if wide else ("long", "long")
    product = F.aggregate(F.zip_with("q", "v", lambda a, b: (a.cast(factor) * b.cast(factor)).cast(kind)), F.lit(0).cast(kind), lambda s, x: (s + x).cast(kind))
    found = pairs.join(left, "query_row").join(vectors.select("row", "vec_id", "v"), "row")
    return found.select("query_row", "query_id", "row", "vec_id", product.alias("score"))


def best(scored: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(rows: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding",
           scale: int = SCALE, bits: int = BITS, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best. `is_query` is a condition on the column vec_id."""
    vectors = stored(whole_numbers(rows, id_column, vector_column, scale), "whole-vectors")
    cells = grid(vectors, bits)
    files = stored(approximate(vectors, cells), "vector-approximations")
    asked = vectors.where(is_query)
    wide = any(sum(max(abs(int(a)), abs(int(a) + (int(w) << bits))) ** 2 for a, w in zip(*c)) >= 1 << 62 for c in cells.values())
    n, n_queries = vectors.count(), asked.count()
    q_blocks, c_blocks = max(1, -(-n_queries // query_block)), max(1, -(-n // candidate_block))
    block = lambda m: F.pmod(F.xxhash64("row"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    queries = files.where(is_query).select("row", "d", "exact", block(q_blocks).alias("qb"), every(c_blocks).alias("cb"))
    candidates = files.select("row", "d", "cells", block(c_blocks).alias("cb"), every(q_blocks).alias("qb"))
    near = stored(scan(queries, candidates, cells, k), "bounded-pairs")
    by_low = W.partitionBy("query_row").orderBy(F.col("low").desc())
    by_high = W.partitionBy("query_row").orderBy(F.col("high").desc(), F.col("row"))
    floor = near.select("query_row", "low").withColumn("n", F.row_number().over(by_low)).where(F.col("n") <= k).groupBy("query_row").agg(
        F.when(F.count(F.lit(1)) == k, F.min("low")).alias("floor"))
    left = near.join(floor, "query_row").where(F.col("floor").isNull() | (F.col("high") >= F.col("floor")))
    ordered = stored(left.select("query_row", "row", "high", F.row_number().over(by_high).alias("n")), "ordered-pairs")
    first = stored(scores(ordered.where(F.col("n") <= AHEAD * k), asked, vectors, wide), "first-scores")
    certain = best(first, k).groupBy("query_row").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("kth"))
    unsure = F.col("kth").isNull() | (F.col("high") >= F.col("kth")) | (F.col("high") >= WIDE)
    open_ = ordered.where(F.col("n") > AHEAD * k).join(certain, "query_row").where(unsure)
    rest = scores(open_.select("query_row", "row"), asked, vectors, wide)
    found = best(first.union(rest), k)
    score = F.greatest(F.least(F.col("score"), F.lit((1 << 63) - 1)), F.lit(-(1 << 63))).cast("long") if wide else F.col("score")
    return found.select("query_id", "rank", "vec_id", score.alias("score"))


ORACLE = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON c.r <> q.r WHERE q.vec_id % 20 = 0),
t AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM t WHERE rank <= 20
"""
