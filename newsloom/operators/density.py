"""Clusters by density: dense regions of any shape become topics, what lies between them stays -1.

Vectors are compared in blocks: per table of random hyperplanes, rows sorted by the signs of their projections are cut into blocks
of bounded size that overlap, so near rows meet in some block, and a third of all rows may be equal without any block growing. From the blocks
come each row's core distance (to its k-th nearest) and a graph of mutual reachability (the larger of both core distances and
the distance): the spanning trees of the blocks. Boruvka rounds as Spark jobs reduce it to a spanning forest; its edges,
their weights on a grid, are contracted, all levels of the grid side by side, into the condensed tree: a component that reaches the least
size is a cluster, smaller ones fall off the cluster they join, and two clusters that meet make a parent. Of the tree the
clusters of the greatest stability (how long their rows stay) are taken. Clusters are as many as the least size
allows, so only they are known to the driver; rows stay in Spark.

Rounds over few edges cost more than what they work on. So once a stated number of edges is left (`HERE`, `FINISH`), the driver ends the rounds
over plain arrays, with the same result.

On a single block the graph is complete, and the result is that of comparing all pairs."""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import release, written

NEIGHBOURS = 5
TABLES = 6
BITS = 24
BLOCK = 512
OVERLAP = 64
RANGE = 32  # blocks that a task goes through, about
SAMPLED = 40  # rows a range, to tell where it begins
LEVELS = 200  # of the grid of weights
HERE = 1_000_000  # edges (of 40 bytes) among which one place ends the spanning forest
FINISH = 4_000_000  # edges (of 20 bytes) of the forest that one place contracts by itself
NO_WEIGHT = 1e-3  # the grid begins at this share of the largest weight

# tasks carry this module with them
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ------------------------------------------------------------- inside a block
def distances(x: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)
    return np.sqrt(np.maximum(squares[:, None] + squares[None, :] - 2 * (x @ x.T), 0.0))


def nearest(ids: np.ndarray, x: np.ndarray, core: np.ndarray, k: int) -> tuple:
    """(row, other, distance) of each row's k nearest others."""
    d = distances(x)
    np.fill_diagonal(d, np.inf)
    k = min(k, len(ids) - 1)
    at = np.argpartition(d, k - 1, axis=1)[:, :k] if k else np.zeros((len(ids), 0), int)
    rows = np.repeat(np.arange(len(ids)), k)
    return ids[rows], ids[at.ravel()], d[rows, at.ravel()]


def tree(ids: np.ndarray, x: np.ndarray, core: np.ndarray, k: int) -> tuple:
    """(row, other, weight) of the block's least spanning tree by mutual reachability."""
    n = len(ids)
    w = np.maximum(distances(x), np.maximum(core[:, None], core[None, :]))
    w[:, 0] = np.inf  # what is in the tree is never nearer to it
    near, via = w[0].copy(), np.zeros(n, int)
    to, weight = np.zeros(n - 1, int), np.zeros(n - 1)
    for i in range(n - 1):
        j = int(near.argmin())
        to[i], weight[i] = j, near[j]
        near[j] = w[:, j] = np.inf
        closer = w[j] < near
        np.copyto(near, w[j], where=closer)
        via[closer] = j
    a, b = ids[via[to]], ids[to]
    return np.minimum(a, b), np.maximum(a, b), weight


def signs_of(x: np.ndarray, tables: int, seed: int):
    """Of each table the signs of the rows' projections, as a number."""
    planes = np.random.default_rng(seed).normal(size=(tables, x.shape[1], BITS))
    for t in range(tables):
        yield (x @ planes[t] > 0) @ (1 << np.arange(BITS)[::-1])


def range_of(signs: np.ndarray, p: np.ndarray, bounds: tuple) -> np.ndarray:
    """The range that a row falls into: how many of the bounds (sign, p), in order, are not above it."""
    of_sign, of_p = bounds
    first, after = np.searchsorted(of_sign, signs, "left"), np.searchsorted(of_sign, signs, "right")
    out = first.copy()
    for at in np.unique(first[after > first]):  # bounds that share a sign
        rows = np.flatnonzero((first == at) & (after > first))
        out[rows] += np.searchsorted(of_p[at : after[rows[0]]], p[rows], "right")
    return out


def ranges(points: DataFrame, n: int, centre: list[float], tables: int, block: int, seed: int) -> list[tuple]:
    """Bounds (signs, ps) that cut each table's rows into ranges of about RANGE blocks, from a sample of SAMPLED rows a range. Ranges only say which
    task has which rows; all rows are in one of them."""
    count = max(1, n // (RANGE * block))
    if count == 1:
        return [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * tables
    step = max(1, n // (count * SAMPLED))
    p, v = points.where(F.pmod(F.xxhash64("p"), F.lit(step)) == 0).select("p", "v").toArrow().columns
    p, x = p.to_numpy(), v.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(centre)) - np.array(centre)
    out = []
    for signs in signs_of(x, tables, seed):
        order = np.lexsort((p, signs))
        at = order[np.arange(1, count) * len(p) // count] if len(p) else order
        out.append((signs[at], p[at]))
    return out


def in_blocks(points: DataFrame, centre: list[float], use, k: int, tables: int, block: int, seed: int, cuts: list[tuple]) -> DataFrame:
    """(a, b, w) that `use` finds in blocks of neighbouring rows (p, v, core), for each table of hyperplanes. `cuts`: the tables' `ranges`."""
    dimensions, most = len(centre), max(len(c[0]) + 1 for c in cuts)

    def keyed(batches):
        import pyarrow as pa

        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions) - np.array(centre)
            for t, signs in enumerate(signs_of(x, tables, seed)):
                part = pa.array(t * most + range_of(signs, batch.column(0).to_numpy(), cuts[t]), pa.int32())
                number = pa.array(np.full(len(x), t), pa.int32())
                yield pa.RecordBatch.from_arrays([part, number, pa.array(signs, pa.int64()), *batch.columns], names=["part", "t", "sign", "p", "v", "core"])

    def task(batches):
        import pyarrow as pa

        rows, held, on = None, None, block - min(OVERLAP, block // 2)

        def found(rows):
            a, b, w = use(*rows, k)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(w, pa.float64())], names=["a", "b", "w"])

        for batch in batches:
            tables_ = batch.column(0).to_numpy()
            own = [batch.column(2).to_numpy(), batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions), batch.column(4).to_numpy()]
            cuts = [0, *(np.flatnonzero(np.diff(tables_)) + 1).tolist(), len(tables_)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                part = [c[begin:end] for c in own]
                if rows is not None and tables_[begin] != held:
                    yield found(rows)
                    rows = None
                held = tables_[begin]
                rows = part if rows is None else [np.concatenate(c) for c in zip(rows, part)]
                while len(rows[0]) > block:
                    yield found([c[:block] for c in rows])
                    rows = [c[on:] for c in rows]
        if rows is not None:
            yield found(rows)

    # not by repartitionByRange, which would work out all of it a second time to find its bounds
    spread = points.mapInArrow(keyed, "part int, t int, sign long, p long, v array<double>, core double")
    ordered = spread.repartitionById(tables * most, "part").drop("part").sortWithinPartitions("t", "sign", "p")
    return ordered.mapInArrow(task, "a long, b long, w double")


def mutual_reachability(points: DataFrame, k: int = NEIGHBOURS, tables: int = TABLES, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """Edges (a, b, w), a < b, of the points (p, v)."""
    first = points.select("v").limit(1).collect()
    if not first:
        return points.sparkSession.createDataFrame([], "a long, b long, w double")
    d = len(first[0].v)
    mean, n = points.agg(F.array(*[F.avg(F.get("v", F.lit(i))) for i in range(d)]), F.count(F.lit(1))).first()
    cuts = ranges(points, n, mean, tables, block, seed)
    plain = points.withColumn("core", F.lit(0.0))
    # dealt out by one end, which serves both groupings
    near = in_blocks(plain, mean, nearest, k, tables, block, seed, cuts).repartition("a").groupBy("a", "b").agg(F.min("w").alias("w"))
    cores = near.groupBy(F.col("a").alias("p")).agg(F.sort_array(F.collect_list("w")).alias("w")).select("p", F.get("w", F.least(F.lit(k), F.size("w")) - 1).alias("core"))
    cored = written(points.join(cores, "p", "left").select("p", "v", F.coalesce("core", F.lit(0.0)).alias("core")), "density-cores")
    release(points.sparkSession)  # the rows of all tables
    return written(in_blocks(cored, mean, tree, k, tables, block, seed, cuts).groupBy("a", "b").agg(F.min("w").alias("w")), "density-edges")


# ----------------------------------------------------------- spanning forest
def frame(spark: SparkSession, **columns: np.ndarray) -> DataFrame:
    import pyarrow as pa

    return spark.createDataFrame(pa.table(columns))


def arrays(df: DataFrame) -> list[np.ndarray]:
    return [c.to_numpy() for c in df.toArrow().columns]


def ends_of(parents: np.ndarray) -> np.ndarray:
    """The root that each pointer leads to."""
    while True:
        further = parents[parents]
        if np.array_equal(further, parents):
            return parents
        parents = further


def pointers_resolved(pointers: DataFrame, here: int = HERE) -> DataFrame:
    """(c, parent) with each parent a root, by doubling."""
    pointers = written(pointers, "density-pointers")
    if pointers.count() <= here:
        c, parent = arrays(pointers)
        order = np.argsort(c)
        c, parent = c[order], parent[order]
        return frame(pointers.sparkSession, c=c, parent=c[ends_of(np.searchsorted(c, parent))])
    while True:
        further = pointers.select(F.col("c").alias("parent"), F.col("parent").alias("next"))
        moved = written(pointers.join(further, "parent").select("c", F.col("next").alias("parent"), (F.col("next") != F.col("parent")).alias("m")), "density-pointers")
        pointers = moved.select("c", "parent")
        if moved.where("m").isEmpty():
            return pointers


def relabelled(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges (ca, cb, ...) with the ends' labels (c, parent) in place; ends without one keep theirs."""
    out = edges
    for end in ("ca", "cb"):
        out = out.join(labels.select(F.col("c").alias(end), F.col("parent").alias("_to")), end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
    return out.where("ca <> cb")


def forest_here(a: np.ndarray, b: np.ndarray, w: np.ndarray, ca: np.ndarray, cb: np.ndarray) -> np.ndarray:
    """Which of the edges are in the least spanning forest of the components ca, cb; edges are in order of (w, a, b)."""
    order = np.lexsort((b, a, w))
    named, at = np.unique(np.concatenate([ca, cb]), return_inverse=True)
    x, y = at[: len(ca)][order].astype(np.int32), at[len(ca) :][order].astype(np.int32)
    number, nodes, chosen = np.arange(len(x), dtype=np.int32), np.arange(len(named), dtype=np.int32), []
    while len(number):
        best = np.full(len(named), -1, np.int32)  # the first edge of each component, as a place in `number`
        for end in (x, y):
            first = np.full(len(named), len(number), np.int32)
            first[end[::-1]] = np.arange(len(end) - 1, -1, -1, dtype=np.int32)  # of several values the last one stays
            best = np.where(best < 0, first, np.minimum(best, first))
        own = np.flatnonzero(best < len(number)).astype(np.int32)
        taken = best[own]
        chosen.append(np.unique(number[taken]))
        other = np.where(x[taken] == own, y[taken], x[taken])
        parents = nodes.copy()
        parents[own] = other
        mutual = (parents[parents] == nodes) & (nodes < parents)
        parents[mutual] = nodes[mutual]
        parents = ends_of(parents)
        x, y = parents[x], parents[y]
        apart = x != y
        x, y, number = x[apart], y[apart], number[apart]
    return order[np.concatenate(chosen)] if chosen else order


def spanning_forest(edges: DataFrame, here: int = HERE) -> DataFrame:
    """Edges (a, b, w) of the least spanning forest: in each round every component takes its lightest edge."""
    spark, chosen = edges.sparkSession, []
    open_ = written(edges.where("a <> b").select("a", "b", "w", F.col("a").alias("ca"), F.col("b").alias("cb")), "density-open")
    while left := open_.count():
        if left <= here:
            a, b, w, *components = arrays(open_.select("a", "b", "w", "ca", "cb"))
            at = forest_here(a, b, w, *components)
            chosen.append(frame(spark, a=a[at], b=b[at], w=w[at]))
            break
        sides = open_.select("ca", "cb", "a", "b", "w").union(open_.select("cb", "ca", "a", "b", "w"))
        best = sides.groupBy("ca").agg(F.min(F.struct("w", "a", "b", "cb")).alias("e"))
        best = written(best.select(F.col("ca").alias("c"), F.col("e.cb").alias("other"), "e.a", "e.b", "e.w"), "density-lightest")
        chosen.append(best.select("a", "b", "w"))
        back = best.select(F.col("c").alias("other"), F.col("other").alias("c"), F.lit(True).alias("mutual"))
        root = F.coalesce(F.col("mutual"), F.lit(False)) & (F.col("c") < F.col("other"))
        parents = best.join(back, ["c", "other"], "left").select("c", F.when(root, F.col("c")).otherwise(F.col("other")).alias("parent"))
        named = relabelled(open_, pointers_resolved(parents, here))
        low, high = F.least("ca", "cb"), F.greatest("ca", "cb")
        lightest = named.groupBy(low.alias("ca"), high.alias("cb")).agg(F.min(F.struct("w", "a", "b")).alias("e"))
        open_ = written(lightest.select("e.a", "e.b", "e.w", "ca", "cb"), "density-open")
    out = spark.createDataFrame([], "a long, b long, w double")
    for part in chosen:
        out = out.union(part)
    return written(out.distinct(), "density-forest")


# ------------------------------------------------------------ condensed tree
@dataclass
class Cluster:
    """A node of the condensed tree. `died`: the level at which it falls apart or appears, seen from the top; `born`: at
    which it leaves its parent. `left`: rows that fell off, by level."""

    children: list[int] = field(default_factory=list)
    parent: int | None = None
    born: int | None = None
    left: dict[int, int] = field(default_factory=dict)
    size: int = 0


@dataclass
class Tree:
    least: int
    clusters: list[Cluster] = field(default_factory=list)

    def met(self, level: int, small: int, clusters: list[int]) -> int | None:
        """Components meet at a level: `small` rows in all small ones, and the clusters listed. The cluster they now
        belong to, if any."""
        if not clusters and small < self.least:
            return None
        if len(clusters) == 1:
            own = clusters[0]
        else:
            own = len(self.clusters)
            self.clusters.append(Cluster(children=sorted(clusters), size=sum(self.clusters[c].size for c in clusters)))
            for c in clusters:
                self.clusters[c].parent, self.clusters[c].born = own, level
        mine = self.clusters[own]
        mine.size += small
        if small:
            mine.left[level] = mine.left.get(level, 0) + small
        return own

    def selected(self, value) -> list[int]:
        """Clusters of greatest stability, no two of one branch; a root only where nothing else is left to choose from it,
        that is never: without a split there is no contrast and no cluster. `value`: weight of a level."""
        best, taken = {}, {}
        for i, c in enumerate(self.clusters):  # children come before parents
            if c.born is None:
                born = 0.0
            else:
                born = 1 / value(c.born)
            own = sum(n * (1 / value(level) - born) for level, n in sorted(c.left.items()))
            own += sum(self.clusters[k].size * (1 / value(self.clusters[k].born) - born) for k in c.children)
            below = sum(best[k] for k in c.children)
            if c.parent is not None and own >= below:
                best[i], taken[i] = own, [i]
            else:
                best[i], taken[i] = below, [x for k in c.children for x in taken[k]]
        return sorted(x for i, c in enumerate(self.clusters) if c.parent is None for x in taken[i])


def contracted_here(tree_: Tree, c: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, level: np.ndarray) -> tuple:
    """Contracts edges (a, b, level) among the components c, in ascending order, with sizes. Of each component the cluster it joins, or becomes part of, and
    at which level; -1 for none."""
    order = np.argsort(level, kind="stable")
    x, y, level = np.searchsorted(c, a[order]).astype(np.int32), np.searchsorted(c, b[order]).astype(np.int32), level[order]
    size = size.astype(np.int64)
    up = np.arange(len(c), dtype=np.int32)  # towards the component that holds it, the smallest of its own
    into = up.copy()  # the small component it became part of while small itself
    state, cluster, joined = (np.full(len(c), -1, np.int32) for _ in range(3))

    def top(i: np.ndarray) -> np.ndarray:
        t = up[i]
        while True:
            further = up[t]
            if np.array_equal(further, t):
                up[i] = t
                return t
            t = further

    cuts = [0, *(np.flatnonzero(np.diff(level)) + 1).tolist(), len(level)]
    for begin, end in zip(cuts, cuts[1:]):
        if begin == end:
            continue
        at = int(level[begin])
        i, j = top(x[begin:end]), top(y[begin:end])
        met = np.unique(np.concatenate([i, j]))
        while len(i):
            np.minimum.at(up, np.maximum(i, j), np.minimum(i, j))
            i, j = top(i), top(j)
            apart = i != j
            i, j = i[apart], j[apart]
        whole, group = np.unique(top(met), return_inverse=True)
        small = state[met] < 0
        rows = np.bincount(group, weights=np.where(small, size[met], 0), minlength=len(whole)).astype(np.int64)
        held: dict[int, list[int]] = {}
        for g, k in zip(group[~small].tolist(), state[met[~small]].tolist()):
            held.setdefault(g, []).append(k)
        own = np.full(len(whole), -1, np.int32)
        for g in sorted({*held, *np.flatnonzero(rows >= tree_.least).tolist()}):
            own[g] = tree_.met(at, int(rows[g]), held.get(g, []))
        size[whole] = np.bincount(group, weights=size[met], minlength=len(whole)).astype(np.int64)
        state[whole] = own
        joins = own[group] >= 0
        named = met[small & joins]
        cluster[named], joined[named] = own[group[small & joins]], at
        into[met[~joins]] = whole[group[~joins]]
    last = ends_of(into)
    return cluster[last], joined[last]


def grid(forest: DataFrame, levels: int) -> tuple[DataFrame, object]:
    """The forest with `level`s in place of weights (the next larger value of a geometric grid), and a level's weight."""
    ends = forest.agg(F.max("w").alias("high"), F.min(F.when(F.col("w") > 0, F.col("w"))).alias("low")).first()
    high = ends.high or 1.0
    low = max(ends.low or high, NO_WEIGHT * high)
    step = (high / low) ** (1 / max(1, levels - 1))
    rounded = F.ceil(F.log(F.col("w") / low) / float(np.log(step)) - 1e-9) if step > 1 else F.lit(0)
    level = F.when(F.col("w") <= low, 0).otherwise(F.least(rounded, F.lit(levels - 1))).cast("int")
    return forest.select(F.col("a").alias("ca"), F.col("b").alias("cb"), level.alias("level")), lambda i: low * step**i


def meetings(edges: DataFrame, sizes: DataFrame, levels: int) -> DataFrame:
    """(level, c, parent, size): the components that meet at each level of the edges (ca, cb, level), and the smallest of those they meet. All
    levels are worked out side by side: a range of levels is halved, the upper half goes on with the components that the lower one
    leaves, until each range is one level. The rounds are as many as the halvings, and a round holds each edge once."""
    def ends(e: DataFrame) -> DataFrame:
        return e.select(F.col("ca").alias("c")).union(e.select(F.col("cb").alias("c"))).distinct()

    def at(c: str, first: Column) -> Column:
        return F.struct(first.cast("int").alias("first"), F.col(c).alias("c"))

    def moved(c: str, by: int) -> Column:
        return F.struct((F.col(f"{c}.first") + by).cast("int").alias("first"), F.col(f"{c}.c").alias("c"))

    # an end of an edge is named by its range's first level and its component
    edges = edges.select(at("ca", F.lit(0)).alias("ca"), at("cb", F.lit(0)).alias("cb"), "level")
    sizes = sizes.select(at("c", F.lit(0)).alias("c"), "size").join(ends(edges), "c", "left_semi")
    half = 1 << max(0, (levels - 1).bit_length() - 1)
    while half and levels > 1:
        middle = F.col("ca.first") + half
        lower, upper = edges.where(F.col("level") < middle), edges.where(F.col("level") >= middle)
        labels = joined_labels(lower)
        upper = relabelled(upper, labels).select(moved("ca", half).alias("ca"), moved("cb", half).alias("cb"), "level")
        joined = sizes.join(labels, "c", "left").groupBy(F.coalesce("parent", "c").alias("c")).agg(F.sum("size").alias("size"))
        joined = joined.select(moved("c", half).alias("c"), "size").join(ends(upper), "c", "left_semi")
        sizes = written(sizes.join(ends(lower), "c", "left_semi").union(joined), "density-sizes")
        edges = written(lower.unionByName(upper), "density-levels")
        half //= 2
    told = joined_labels(edges).join(sizes, "c")
    return written(told.select(F.col("c.first").alias("level"), F.col("c.c").alias("c"), F.col("parent.c").alias("parent"), "size"), "density-meeting")


def contracted(tree_: Tree, told: DataFrame) -> DataFrame:
    """(c, parent, cluster, level): the component each small one becomes part of, or the cluster it joins and when. Components that reach the least size are known
    to the driver: no more than rows / least at a level."""
    spark = told.sparkSession
    large = told.groupBy("level", "parent").agg(F.sum("size").alias("size")).where(F.col("size") >= tree_.least).collect()
    parts: dict[tuple, list] = {}
    for r in told.where(F.col("size") >= tree_.least).collect():
        parts.setdefault((r.level, r.parent), []).append(r)
    holder: dict[int, int] = {}  # component: its cluster
    own, inside = [], []
    for g in sorted(large, key=lambda g: (g.level, g.parent)):
        known = [r for r in parts.get((g.level, g.parent), []) if r.c in holder]
        inside += [(g.level, r.c) for r in known]
        clusters = sorted({holder.pop(r.c) for r in known})
        holder[g.parent] = tree_.met(g.level, g.size - sum(r.size for r in known), clusters)
        own.append((g.level, g.parent, holder[g.parent]))
    named = told.join(F.broadcast(spark.createDataFrame(own, "level int, parent long, cluster int")), ["level", "parent"], "left")
    small = named.join(F.broadcast(spark.createDataFrame(inside, "level int, c long")), ["level", "c"], "left_anti")
    return small.where("cluster IS NOT NULL OR c <> parent").select("c", "parent", "cluster", F.when(F.col("cluster").isNotNull(), F.col("level")).alias("level"))


def condensed(points: DataFrame, forest: DataFrame, least: int, levels: int = LEVELS, finish: int = FINISH) -> tuple[DataFrame, Tree, object]:
    """(p, cluster, level) at which each row falls off which cluster, the tree, and the weight of a level."""
    spark, tree_ = points.sparkSession, Tree(least)
    edges, value = grid(forest, levels)
    edges = written(edges, "density-levels")
    sizes = points.select(F.col("p").alias("c"), F.lit(1).cast("long").alias("size"))
    here = edges.count() <= finish
    if here:
        a, b, level = arrays(edges)
        c = np.unique(np.concatenate([a, b]))  # the rows that edges join, each of size 1
        cluster, joined = contracted_here(tree_, c, np.ones(len(c), np.int64), a, b, level)
        known = cluster >= 0
        said = frame(spark, p=c[known], cluster=cluster[known], level=joined[known])
    else:
        said = contracted(tree_, meetings(edges, sizes, levels))
    apart = [i for i, c in enumerate(tree_.clusters) if c.parent is None]
    if len(apart) > 1:  # what no edge joins meets one step above the grid
        tree_.met(levels, 0, apart)
    if here:
        return points.select("p").join(said, "p", "left"), tree_, value
    facts = written(said, "density-facts")  # a component's next one, or the cluster it joined
    # a row's component moves on until one joined a cluster
    stops = points.select(F.col("p").alias("c")).join(facts.select("c", "parent", "cluster"), "c", "left")
    pointers = stops.select("c", F.when(F.col("cluster").isNull(), F.coalesce("parent", "c")).otherwise(F.col("c")).alias("parent"))
    final = pointers_resolved(pointers)
    joined = final.join(facts.where("cluster IS NOT NULL").select(F.col("c").alias("parent"), "cluster", "level"), "parent", "left")
    return joined.select(F.col("c").alias("p"), "cluster", "level"), tree_, value


def joined_labels(edges: DataFrame) -> DataFrame:
    """(c, parent): the smallest end reached over the edges (ca, cb)."""
    both = written(edges.select("ca", "cb").union(edges.select("cb", "ca")).distinct(), "density-pairs")
    labels = written(both.groupBy(F.col("ca").alias("c")).agg(F.least(F.min("ca"), F.min("cb")).alias("parent")), "density-labels")
    while True:
        near = both.join(labels.select(F.col("c").alias("cb"), "parent"), "cb").groupBy(F.col("ca").alias("c")).agg(F.min("parent").alias("near"))
        closer = labels.join(near, "c").select("c", F.col("parent").alias("old"), F.least("parent", "near").alias("parent"))
        target = labels.select(F.col("c").alias("parent"), F.col("parent").alias("further"))
        moved = written(closer.join(target, "parent").select("c", F.least("parent", "further").alias("parent"), (F.least("parent", "further") != F.col("old")).alias("m")), "density-labels")
        labels = moved.select("c", "parent")
        if moved.where("m").isEmpty():
            return labels


def density_clusters(vectors: DataFrame, id_column: str, vector: Column, least: int | None = None, k: int = NEIGHBOURS, tables: int = TABLES, block: int = BLOCK,
                     levels: int = LEVELS, finish: int = FINISH, seed: int = 7) -> DataFrame:
    """id, topic_id and topic_prob of each row; -1 and 0 for rows in no cluster. `vector` gives arrays of one length;
    they are scaled to unit length (zero vectors stay). Rows without a vector are in no cluster. `least` rows make a cluster, a twentieth (at least 3) unless
    given. Topics are numbered by size, the largest 0; a row's probability is how long it stays, compared with the longest of its topic."""
    told = vectors.select(F.monotonically_increasing_id().alias("p"), F.col(id_column).alias("id"), vector.cast("array<double>").alias("v"))
    # a table may be one file of few splits: its rows are dealt out
    told = told.repartition(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), "p")
    # a column of its own: inside the lambda it would be worked out for each entry
    told = told.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
    scaled = F.when(F.col("norm") > 0, F.transform("v", lambda x: x / F.col("norm"))).otherwise(F.col("v"))
    told = written(told.select("p", "id", scaled.alias("v")), "density-rows")
    points = told.where("v IS NOT NULL").select("p", "v")
    n = points.count()
    least = least or max(3, n // 20)
    release(told.sparkSession)
    edges = mutual_reachability(points, k, tables, block, seed)
    release(told.sparkSession)
    forest = spanning_forest(edges, min(HERE, finish))
    if forest.isEmpty():
        return told.select(F.col("id").alias(id_column), F.lit(-1).alias("topic_id"), F.lit(0.0).alias("topic_prob"))
    fell, tree_, value = condensed(points.select("p"), forest, least, levels, finish)
    return topics_of(told, written(fell, "density-fell"), tree_, value, id_column)


def topics_of(told: DataFrame, fell: DataFrame, tree_: Tree, value, id_column: str) -> DataFrame:
    """Rows' topics and probabilities from where they fell off the tree."""
    spark, chosen = told.sparkSession, set(tree_.selected(value))
    above = {}
    for i in reversed(range(len(tree_.clusters))):
        parent = tree_.clusters[i].parent
        above[i] = i if i in chosen else above.get(parent) if parent is not None else None
    pairs = [(i, a) for i, a in above.items() if a is not None]
    named = fell.join(F.broadcast(spark.createDataFrame(pairs, "cluster int, chosen int")), "cluster")
    # of rows in a chosen cluster those of the smallest level stay longest
    facts = named.groupBy("chosen").agg(F.count(F.lit(1)).alias("n"), F.min("level").alias("longest")).orderBy(F.desc("n"), "chosen").collect()
    rows = [(r.chosen, i, r.longest) for i, r in enumerate(facts)]
    numbered = named.join(F.broadcast(spark.createDataFrame(rows, "chosen int, topic_id int, longest int")), "chosen")
    step = value(1) / value(0)
    share = F.round(F.pow(F.lit(float(step)), F.col("longest") - F.col("level")), 4)
    placed = numbered.select("p", "topic_id", share.alias("topic_prob"))
    out = told.select("p", "id").join(placed, "p", "left")
    return out.select(F.col("id").alias(id_column), F.coalesce("topic_id", F.lit(-1)).alias("topic_id"), F.coalesce("topic_prob", F.lit(0.0)).alias("topic_prob"))
