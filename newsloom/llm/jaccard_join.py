"""Near-duplicate documents by an exact set join on word shingles.

A document is the set of its hashed five-word shingles; two link when their Jaccard similarity reaches
`PERCENT`. With sizes a and b that is an overlap of at least T = ceil(p (a + b) / (100 + p)) shingles: a
T-occurrence search over inverted lists, by DivideSkip.

1. Equal sets become one node. Shingles are ordered by how often they occur over all documents (counted in a
   table of fixed size by hash; equal counts by hash), so that long inverted lists come last.
2. Short lists: each node enters the lists of its first n - L shingles, L = ceil(p n / 100) - 1. Two nodes that reach T meet in
   one of them; a list is merged in the order of sizes, and a meeting at places that leave less than T shingles is skipped.
   Occurrences of pairs that meet are counted by merging the short lists of both: of T common shingles all but the L of the
   node whose short lists end first lie in lists of both, so a pair needs T - max(L) occurrences to be a candidate. (They
   are counted on 32 bits of a hash, which may count some too many, never too few.)
3. Long lists are never merged: for candidates only, the shingles of the smaller set are probed in the larger one by
   binary search, until T is reached or out of reach. Before whole sets travel to be probed, pairs whose sketches (a bit or so
   in eight per shingle) show too many shingles of one set that the other lacks are left out; a sketch never shows too many.

Links are sought in two rounds, so that a group of near copies does not become all its pairs. First every
member of a list meets only the list's smallest member of a fitting size, its neighbour in size and the member that has least
of its own, and what is linked becomes components. Then all pairs of a list that are still in different components meet. After that
no pair that can link is left, so the components are those of all links.

Words: A-Z lower-cased, split at ASCII white space. With fewer words than a shingle, the
whole sequence is the one shingle; null, empty and blank texts have none and link with nothing. Rows without an id
take part and get the smallest id of their component, null if it has none. Rows with equal ids stay apart.
Other columns are not read. Shingles and sets are told apart by 64-bit hashes (sets also by their size)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from newsloom.llm.common import fresh, given_back, Shared, ship, stored, UPPER
from newsloom.llm.components import components

ship(__name__)

SHINGLE = 5
PERCENT = 75
COUNTERS = 1 << 18
REMEMBERED = 100_000
AT_ONCE = 512  # texts that a task holds as strings
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
MULTIPLIER = 0x9E3779B97F4A7C15
ROWS_OUT = 200_000
CANDIDATE_BITS = 1 << 25
SKETCH = 8  # bits of a sketch for each shingle, at least
BLOCK = 256  # members of a list that meet in one task: longer lists are dealt out by pairs of blocks


class Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def strings(column):
    """The texts of an Arrow column, a bounded number at a time."""
    for k in range(0, len(column), AT_ONCE):
        yield from column.slice(k, AT_ONCE).to_pylist()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


def shingles(words: Words, text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    raw = text.encode("utf-8", "replace").translate(LOWER).split() if text else []
    if not raw:
        return np.zeros(0, "u8")
    ids = np.fromiter(map(words.__getitem__, raw), "u8", len(raw))
    own = min(size, len(raw))
    h = np.full(len(raw) - own + 1, own, "u8")
    for j in range(own):
        h = h * np.uint64(MULTIPLIER) + mixed(ids[j : len(raw) - own + 1 + j] + np.uint64(j))
    return np.unique(mixed(h))


def node_of(own: np.ndarray) -> int:
    from hashlib import blake2b

    return int.from_bytes(blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def required(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The overlap that sets of a and b shingles need."""
    return -(-(percent * (a + b)) // (100 + percent))


def long_lists(n, percent: int):
    """L: how many of a node's n inverted lists count as long, the last in the order of rarity."""
    return -(-percent * n // 100) - 1


def occurrences_needed(a, b, percent: int):
    """In how many short lists sets of a and b shingles must meet to be able to link."""
    return np.maximum(required(a, b, percent) - np.maximum(long_lists(a, percent), long_lists(b, percent)), 1)


def rarest(own: np.ndarray, order: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of a set's short lists, rarest first."""
    return own[np.lexsort((own, order[(own & np.uint64(COUNTERS - 1)).astype("i8")]))[: len(own) - long_lists(len(own), percent)]]


def occurrences(x: np.ndarray, y: np.ndarray) -> int:
    """How many of x are in y; both are sorted."""
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def sketch(own: np.ndarray) -> bytes:
    """A set's shingles as bits of a table whose size is a power of two."""
    bits = np.zeros(1 << max(3, (SKETCH * len(own) - 1).bit_length()), bool)
    bits[((own >> np.uint64(32)) & np.uint64(len(bits) - 1)).astype("i8")] = True
    return np.packbits(bits).tobytes()


def most_in_common(na: int, nb: int, x: np.ndarray, y: np.ndarray) -> int:
    """How large the overlap of two sets can be by their sketches: a bit that only one has stands for a shingle of its own, at least."""
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return min(na - int(np.bitwise_count(x & ~y).sum()), nb - int(np.bitwise_count(y & ~x).sum()))


def profile(docs: DataFrame, id_column: str, text_column: str, size: int) -> DataFrame:
    """Rows of kind 0: (doc_id, n, node, text_hash); rows of kind 1: (counter, number of documents in it)."""

    def task(batches):
        import pyarrow as pa

        names, words, counts = ["kind", "id", "n", "node", "text_hash"], Words(), np.zeros(COUNTERS, "i8")
        for batch in batches:
            for k in range(0, batch.num_rows, AT_ONCE):
                some = batch.slice(k, AT_ONCE)
                sets = [shingles(words, t, size) for t in some.column(1).to_pylist()]
                counts += np.bincount((np.concatenate(sets) & np.uint64(COUNTERS - 1)).astype("i8"), minlength=COUNTERS)
                columns = [np.zeros(len(sets), "i4"), some.column(0), np.array([len(s) for s in sets], "i8"), np.array([node_of(s) for s in sets], "i8"), some.column(2)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.ones(len(used), "i4"), used.astype("i8"), counts[used], np.zeros(len(used), "i8"), np.zeros(len(used), "i8"))], names=names)
        batch = some = sets = None
        given_back()

    rows = docs.select(F.col(id_column).cast("long"), F.col(text_column), F.xxhash64(text_column))
    return rows.mapInArrow(task, "kind int, id long, n long, node long, text_hash long")


def rarity(counted: DataFrame) -> np.ndarray:
    """A byte per counter: how often its shingles occur, in steps of a fifth."""
    out = np.zeros(COUNTERS, "u1")
    for r in counted.groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most COUNTERS rows
        out[r.id] = min(255, int(4 * np.log2(r.n)))
    return out


def postings(docs: DataFrame, order: np.ndarray, text_column: str, size: int, percent: int) -> DataFrame:
    """(token, node, n, pos): each node's short lists, the first in the order of rarity. A task enters a set once."""
    shared = Shared(docs.sparkSession, order)

    def task(batches):
        import pyarrow as pa

        order, words, seen, held, rows = shared.get(), Words(), set(), [], 0
        names = ["token", "node", "n", "pos"]

        def out():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)

        for batch in batches:
            for text in strings(batch.column(0)):
                own = shingles(words, text, size)
                n = len(own)
                node = node_of(own)
                if not n or node in seen:
                    continue
                seen.add(node)
                short = rarest(own, order, percent)
                first = len(short)
                held.append((short.view("i8"), np.full(first, node, "i8"), np.full(first, n, "i4"), np.arange(first, dtype="i4")))
                rows += first
                if rows >= ROWS_OUT:
                    yield out()
                    held, rows = [], 0
        if held:
            yield out()
        given_back()

    return docs.select(text_column).mapInArrow(task, "token long, node long, n int, pos int")


MEETINGS = "kind int, token long, node long, n int, pos int, node2 long, n2 int"


def by_list(batches, work, keys: int = 1):
    """Calls `work` with the columns of whole lists, in bounded portions; rows come sorted by the first `keys` columns, which name a list."""
    held = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns)]
        if not len(columns[0]):
            continue
        differs = np.zeros(len(columns[0]), bool)
        for c in columns[:keys]:
            differs |= c != c[-1]
        cut = len(differs) - int(np.argmin(differs[::-1] == differs[-1])) if differs.any() else 0
        held = [c[cut:] for c in columns]
        if cut:
            yield from work([c[:cut] for c in columns])
    if held is not None and len(held[0]):
        yield from work(held)


def merge_lists(rows: DataFrame, percent: int) -> DataFrame:
    """Lists of several nodes. Kind 1: meetings of a member with the first member of fitting size, with the
    member before it, and with the one where the shingle comes first (of near copies the one least changed), each pair of a list once;
    kind 0: the members of lists of three or more, for the second round."""

    def work(columns):
        import pyarrow as pa

        token, node, n, pos = columns
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1]) | (n[1:] != n[:-1])
        token, node, n, pos = token[new], node[new], n[new], pos[new]
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        sizes = np.diff(np.append(starts, len(token)))
        size = np.repeat(sizes, sizes)
        many = size >= 2
        token, node, n, pos, size = token[many], node[many], n[many], pos[many], size[many]
        if not len(token):
            return
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        pivot = np.repeat(starts, np.diff(np.append(starts, len(token))))
        while True:  # a member too large for its pivot starts anew: the first such of a run becomes one
            far = percent * n > 100 * n[pivot]
            if not far.any():
                break
            at = np.flatnonzero(far)
            lead = np.append(True, (pivot[at][1:] != pivot[at][:-1]))
            heads = at[lead]
            pivot[at] = heads[np.cumsum(lead) - 1]
        own = np.arange(len(token))
        before = np.where(np.isin(own, starts), own, own - 1)
        ends = np.append(starts[1:], len(token))
        by_place = np.lexsort((pos, np.repeat(np.arange(len(starts)), ends - starts)))
        hub = np.repeat(by_place[starts], ends - starts)
        listed = np.flatnonzero(size >= 3)
        pick, two, known = [listed], [listed], []
        for other in (pivot, before, hub):
            a, b = n[other].astype("i8"), n.astype("i8")
            fits = percent * np.maximum(a, b) <= 100 * np.minimum(a, b)
            need = required(a, b, percent)
            meets = (other != own) & fits & (a - pos[other] >= need) & (b - pos >= need)
            for earlier in known:  # the pair is known from this member or from the other one
                meets &= (earlier != other) & (earlier[other] != own)
            known.append(np.where(meets, other, own))
            pick.append(np.flatnonzero(meets))
            two.append(other[meets])
        pick, two = np.concatenate(pick), np.concatenate(two)
        kind = (np.arange(len(pick)) >= len(listed)).astype("i4")
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (kind, token[pick], node[pick], n[pick], pos[pick], node[two], n[two])],
            names=["kind", "token", "node", "n", "pos", "node2", "n2"],
        )

    dealt = rows.repartition("token").sortWithinPartitions("token", "n", "node")
    return dealt.mapInArrow(lambda batches: by_list(batches, work), MEETINGS)


def rest_of_lists(listed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, na, b, nb) of lists whose members are still in different components. Lists with the same
    first member and number of blocks go to the same tasks, which remember pairs (a bounded number of them) so as not to send them again. A list of more
    than BLOCK members is cut by hash into blocks, and each pair of blocks is work of its own."""
    seen: set[tuple[int, int]] = set()

    def work(columns):
        import pyarrow as pa

        key, token, node, n, pos, label, block, other = columns

        def out(held):
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["a", "na", "b", "nb"])

        new = (key[1:] != key[:-1]) | (token[1:] != token[:-1])
        starts = np.append(np.flatnonzero(np.append(True, new)), len(token))
        held: list[tuple] = []
        rows = 0
        for s, e in zip(starts.tolist(), starts[1:].tolist()):
            size, place = n[s:e].astype("i8"), pos[s:e].astype("i8")
            across = other[s] != block[s]  # two different blocks: pairs inside one are another task's
            for i in range(e - s - 1):
                j = np.arange(i + 1, int(np.searchsorted(size, 100 * size[i] // percent, "right")))
                j = j[label[s + j] != label[s + i]]
                if across:
                    j = j[block[s + j] != block[s + i]]
                need = required(size[i], size[j], percent)
                j = j[(size[i] - place[i] >= need) & (size[j] - place[j] >= need)]
                first = int(node[s + i])
                j = np.array([k for k in j.tolist() if (first, int(node[s + k])) not in seen], "i8")
                if len(seen) > REMEMBERED:
                    seen.clear()
                seen.update((first, int(x)) for x in node[s + j])
                if len(j):
                    held.append((np.full(len(j), node[s + i]), np.full(len(j), n[s + i]), node[s + j], n[s + j]))
                    rows += len(j)
                if rows >= ROWS_OUT:
                    yield out(held)
                    held, rows = [], 0
        if held:
            yield out(held)

    heads = listed.groupBy("token").agg(F.min(F.struct("n", "node"))["node"].alias("head"), F.count(F.lit(1)).alias("members"))
    routed = listed.join(heads, "token").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    routed = routed.withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    spread = routed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = F.xxhash64("head", "blocks", F.least("block", "other"), F.greatest("block", "other")).alias("key")
    dealt = spread.select(key, "token", "node", "n", "pos", "label", "block", "other").repartition("key").sortWithinPartitions("key", "token", "n", "node")
    return dealt.mapInArrow(lambda batches: by_list(batches, work, keys=2), "a long, na int, b long, nb int")


def bitmap(hashes: DataFrame, column: str) -> bytes:
    """A bit for each of CANDIDATE_BITS remainders of a non-negative hash."""
    spot = F.col(column).bitwiseAND(F.lit(CANDIDATE_BITS - 1))
    chunks = hashes.select(spot.alias("s")).groupBy(F.shiftright("s", 15).alias("chunk")).agg(
        F.bitmap_construct_agg(F.col("s").bitwiseAND(F.lit(32767))).alias("bits")
    )
    out = bytearray(CANDIDATE_BITS // 8)
    for r in chunks.collect():  # at most CANDIDATE_BITS bits together
        out[r.chunk * 4096 : r.chunk * 4096 + len(r.bits)] = r.bits
    return bytes(out)


def candidate_sets(docs: DataFrame, nodes: DataFrame, profiled: DataFrame, order: np.ndarray, id_column: str, text_column: str, size: int, percent: int) -> DataFrame:
    """(node, n, short, sketch, hashes) for all of the listed nodes, and a few more; `short` are 32 bits for each short list. Texts are read again: a bit per hash of
    an id lets only rows through that may be the document a node is taken from, a bit per node only sets that may
    be wanted. Both tables are of fixed size; where they fill up, more sets pass, which does no harm."""
    ids = nodes.join(profiled, ["node", "n"]).groupBy("node", "n").agg(F.min("id").alias("id"))
    spot = F.xxhash64(F.coalesce("id", F.lit(-1)))
    marks = stored(ids.select(spot.alias("id"), "node"), "candidates")
    shared = Shared(docs.sparkSession, (bitmap(marks, "id"), bitmap(marks, "node"), order))

    def task(batches):
        import pyarrow as pa

        *maps, order = shared.get()
        by_id, by_node = (np.frombuffer(b, "u1") for b in maps)
        words, seen, held, names = Words(), set(), [], ["node", "n", "short", "sketch", "hashes"]

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=names)

        for batch in batches:
            spots = batch.column(1).to_numpy() & (CANDIDATE_BITS - 1)
            may = np.flatnonzero((by_id[spots >> 3] >> (spots & 7).astype("u1")) & 1)
            for text in strings(batch.column(0).take(pa.array(may))):
                own = shingles(words, text, size)
                node = node_of(own)
                bit = node & (CANDIDATE_BITS - 1)
                if len(own) and node not in seen and by_node[bit >> 3] >> (bit & 7) & 1:
                    seen.add(node)
                    short = np.sort((rarest(own, order, percent) >> np.uint64(32)).astype("u4"))
                    held.append((node, len(own), short.tobytes(), sketch(own), own.tobytes()))
                if len(held) >= 500:
                    yield out()
                    held = []
        if held:
            yield out()
        given_back()

    rows = docs.select(F.col(text_column), F.xxhash64(F.coalesce(F.col(id_column).cast("long"), F.lit(-1))))
    return stored(rows.mapInArrow(task, "node long, n int, short binary, sketch binary, hashes binary"), "candidate-sets")


def only_of(sets: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """The sets (node, n and one column) of nodes in the pairs, and a few more. They are many times larger than the pairs, so they are
    not shuffled to be chosen: a bit per node, in a table of fixed size, tells which are left out where they are read."""
    wanted = stored(both_sides(pairs).select("node"), "wanted-nodes")
    shared = Shared(sets.sparkSession, bitmap(wanted, "node"))

    def task(batches):
        import pyarrow as pa

        bits = np.frombuffer(shared.get(), "u1")
        for batch in batches:
            spots = batch.column(0).to_numpy() & (CANDIDATE_BITS - 1)
            yield batch.filter(pa.array(((bits[spots >> 3] >> (spots & 7).astype("u1")) & 1).astype(bool)))

    return sets.select("node", "n", column).mapInArrow(task, f"node long, n int, {column} binary")


def overlap_reaches(small: np.ndarray, large: np.ndarray, need: int) -> bool:
    """Binary probes of the smaller set's shingles in the larger, until `need` is reached or out of reach."""
    found, step = 0, max(64, len(small) // 4)
    for k in range(0, len(small), step):
        part = small[k : k + step]
        at = np.searchsorted(large, part)
        found += int((large[np.minimum(at, len(large) - 1)] == part).sum())
        if found >= need:
            return True
        if found + len(small) - k - len(part) < need:
            return False
    return found >= need


def tested(pairs: DataFrame, sets: DataFrame, column: str, kind: str, test) -> DataFrame:
    """The pairs (a, na, b, nb) for which test(na, nb, x, y) holds, x and y being a column of their sets. Each comes once: a set that
    several tasks made is there as often."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col(column).alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col(column).alias("y"))

    def task(batches):
        import pyarrow as pa

        for batch in batches:
            _, na, _, nb, x, y = batch.columns
            good = [test(i, j, np.frombuffer(p.as_buffer(), kind), np.frombuffer(q.as_buffer(), kind)) for i, j, p, q in zip(na.to_pylist(), nb.to_pylist(), x, y)]
            yield batch.filter(pa.array(good, pa.bool_())).select([0, 1, 2, 3])

    joined = pairs.join(left, ["a", "na"]).join(right, ["b", "nb"]).select("a", "na", "b", "nb", "x", "y")
    return joined.mapInArrow(task, "a long, na int, b long, nb int").distinct()


def candidates(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that occur together in enough short lists."""
    return tested(pairs, sets, "short", "u4", lambda na, nb, x, y: occurrences(*sorted((x, y), key=len)) >= occurrences_needed(na, nb, percent))


def within_reach(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that can reach their overlap by their sketches."""
    return tested(pairs, sets, "sketch", "u1", lambda na, nb, x, y: most_in_common(na, nb, x, y) >= required(na, nb, percent))


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that reach their overlap."""
    return tested(pairs, sets, "hashes", "u8", lambda na, nb, x, y: overlap_reaches(*sorted((x, y), key=len), int(required(na, nb, percent))))


def both_sides(pairs: DataFrame) -> DataFrame:
    """(node, n) of the nodes of pairs."""
    return pairs.select(F.col("a").alias("node"), F.col("na").alias("n")).union(pairs.select("b", "nb")).distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id per row, with the hash of its text."""
    found = stored(profile(docs, id_column, text_column, size), "shingle-profile")
    rows = found.where("kind = 0").select("id", "n", "node", "text_hash")
    order = rarity(found.where("kind = 1"))
    met = stored(merge_lists(postings(docs, order, text_column, size, percent), percent), "list-meetings")
    pair = ["a", "na", "b", "nb"]

    def sides(x: str, nx: str, y: str, ny: str):
        return [F.least(x, y).alias("a"), F.when(F.col(x) <= F.col(y), F.col(nx)).otherwise(F.col(ny)).alias("na"),
                F.greatest(x, y).alias("b"), F.when(F.col(x) <= F.col(y), F.col(ny)).otherwise(F.col(nx)).alias("nb")]

    first = stored(met.where("kind = 1").select(*sides("node", "n", "node2", "n2")).distinct(), "first-pairs")

    def checked(pairs: DataFrame, label: str) -> DataFrame:
        """The pairs that link; only sets of nodes in pairs are made."""
        sets = candidate_sets(docs, both_sides(pairs), rows.where("n > 0"), order, id_column, text_column, size, percent)
        counted = stored(candidates(pairs, sets, percent), f"{label}-counted")
        near = stored(within_reach(counted, only_of(sets, counted, "sketch"), percent), f"{label}-near")
        return stored(linked(near, only_of(sets, near, "hashes"), percent), label)

    links = checked(first, "first-links")
    labels = components(links)
    labelled = met.where("kind = 0").select("token", "node", "n", "pos").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ = labelled.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("token")
    rest = rest_of_lists(labelled.join(open_, "token", "left_semi").select("token", "node", "n", "pos", "label"), percent)
    second = stored(rest.select(*sides("a", "na", "b", "nb")).distinct().join(first, pair, "left_anti"), "second-pairs")
    if not second.isEmpty():
        labels = components(links.union(checked(second, "second-links")))
    smallest = rows.where("n > 0").groupBy("node", "n").agg(F.min("id").alias("least"))
    joined = smallest.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = stored(joined, "node-labels")
    merged = groups.groupBy("label").agg(F.min("least").alias("component_id"))
    named = groups.select(F.col("node"), F.col("n").alias("m"), "label").join(merged, "label").select("node", "m", "component_id")
    out = rows.join(named.withColumnRenamed("node", "node_"), (F.col("node") == F.col("node_")) & (F.col("n") == F.col("m")), "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), "text_hash")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows and columns of `docs` with one document of each component: the one of the smallest id. Rows
    equal in id and text count as one document; texts without words and rows of components without an id all stay."""
    found = near_duplicates(docs, id_column, text_column, size, percent)
    alone = (F.col("n_shingles") == 0) | F.col("component_id").isNull()
    stays = found.where(alone | F.col("doc_id").eqNullSafe(F.col("component_id")))
    ties = stays.groupBy("component_id", F.when(alone, F.col("text_hash")).alias("t"), "doc_id").agg(F.min("text_hash").alias("h"))
    own, n = fresh("text_hash", docs.columns), fresh("n", docs.columns)
    id_, h = fresh("kept_id", docs.columns, [own]), fresh("kept_text", docs.columns, [own])
    marked = docs.withColumn(own, F.xxhash64(text_column))
    kept = marked.join(ties.select(F.col("doc_id").alias(id_), F.col("h").alias(h)).distinct(), F.col(id_column).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(h)), "left_semi")
    # Of rows equal in id and text the one whose other columns hash least, so that every run keeps the same. Only these rows are sorted.
    again = marked.groupBy(F.col(id_column).alias(id_), F.col(own).alias(h)).agg(F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    same = F.col(id_column).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(h))
    hashable = [c for c, t in docs.dtypes if "map<" not in t and "variant" not in t]
    order = W.partitionBy(id_column, own).orderBy(F.xxhash64(*hashable))
    repeated = kept.join(again, same, "left_semi").withColumn(n, F.row_number().over(order)).where(F.col(n) == 1)
    return kept.join(again, same, "left_anti").select(*docs.columns).unionByName(repeated.select(*docs.columns))
