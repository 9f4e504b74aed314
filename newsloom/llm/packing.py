"""Packing of tokenised documents into sequences of a fixed size, best-two-fit.

A bin is filled greedily: the longest unpacked piece that fits, again and again. Then its
smallest piece gives way to two unpacked ones, if a pair fits the gap that this opens more
tightly; the loop goes on while that helps. What the method decides depends only on which lengths are
left, and there are at most `size` lengths. So the table of lengths (at most `size` rows) is
packed in the driver, whole runs of equal bins at a time, and Spark deals the pieces out:
the r-th piece of a length goes where the r-th place for that length is. The number of bins is what the
method gives piece by piece.

Only documents longer than a sequence are cut: all pieces are full but the first, which takes
what is over.

Null texts count as empty: only the end id. Rows with equal or null doc_id are packed
each for themselves, with equal digests where texts are equal. An empty table gives no rows. Other columns
are not read."""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from newsloom.llm.common import given_back, let_go, ship, stored
from newsloom.llm.tokens import default_vocabulary, seldom_collected, worker_encoder

ship(__name__)

SIZE = 2048
AT_ONCE = 512  # texts that a task holds as strings
BATCH_BYTES = 8 << 20
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary, part int, nth long"


def tokenised_pieces(docs: DataFrame, size: int = SIZE, vocabulary: str | None = None,
                     id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece with its ids; (part, length, nth) numbers pieces of a length within a task."""
    vocabulary = vocabulary or default_vocabulary()

    def task(batches):
        from collections import Counter

        import pyarrow as pa
        from pyspark import TaskContext

        part, encoder, nth = TaskContext.get().partitionId(), worker_encoder(vocabulary), Counter()
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
                            ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("part", pa.int32()), ("nth", pa.int64())])
        rows, held = [], 0
        for batch in seldom_collected(batches):
            for k in range(0, batch.num_rows, AT_ONCE):
                few = batch.slice(k, AT_ONCE)
                for doc, text in zip(few.column(0).to_pylist(), few.column(1).to_pylist()):
                    ids = encoder.encode(text)
                    n, at, piece = len(ids) // 4, 0, 0
                    end = n % size or min(n, size)
                    while at < n:
                        some = ids[4 * at : 4 * end]
                        length = end - at
                        rows.append((doc, piece, at, length, zlib.crc32(some), some, part, nth[length]))
                        nth[length] += 1
                        held += len(some)
                        at, end, piece = end, end + size, piece + 1
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        rows = few = batch = None
        given_back()

    return docs.select(F.col(id_column).cast("long"), F.col(text_column)).mapInArrow(task, PIECES)


def fill_bin(counts: list[int], left: list[int], size: int) -> tuple[dict[int, int], list[dict[int, int]]]:
    """One bin from the unpacked lengths: `left` ascending, counts[l] of each. Returns the
    bin's lengths with their numbers, and what it held in between (before exchanges)."""
    bin_: dict[int, int] = {}
    gap, end = size, len(left)
    while end:
        end = bisect_right(left, gap, 0, end)
        if not end:
            break
        l = left[end - 1]
        n = min(gap // l, counts[l])
        bin_[l] = n
        gap -= n * l
        end -= 1
    steps = [dict(bin_)]
    while gap and bin_:
        small = min(bin_)
        pair = closest_pair(counts, left, bin_, gap + small, small)
        if not pair:
            break
        bin_[small] -= 1
        if not bin_[small]:
            del bin_[small]
        for l in pair:
            bin_[l] = bin_.get(l, 0) + 1
        gap += small - sum(pair)
        steps.append({l: max(bin_.get(l, 0), steps[-1].get(l, 0)) for l in bin_ | steps[-1]})
    return bin_, steps


def closest_pair(counts, left, bin_, room: int, above: int) -> tuple[int, int] | None:
    """The two unpacked lengths of the largest sum in (above, room], found from both ends."""
    free = [l for l in left[: bisect_right(left, room)] if counts[l] > bin_.get(l, 0)]
    i, j, best, pair = 0, len(free) - 1, above, None
    while i <= j:
        a, b = free[i], free[j]
        total = a + b
        if total > room:
            j -= 1
            continue
        if total > best and (i < j or counts[a] - bin_.get(a, 0) > 1):
            best, pair = total, (a, b)
            if total == room:
                break
        i += 1
    return pair


def plan_bins(lengths: dict[int, int], size: int = SIZE) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Places for all pieces: (length, first rank, per bin, bins, first bin, offset), where the
    ranks from `first rank` on fill `per bin` places at `offset` in each of `bins` bins. Also the number of bins."""
    counts = [0] * (size + 1)
    for l, n in lengths.items():
        counts[l] = n
    taken = [0] * (size + 1)
    left = [l for l in range(1, size + 1) if counts[l]]
    places, first = [], 0
    while left:
        bin_, steps = fill_bin(counts, left, size)
        times = min(counts[l] // n for l, n in bin_.items())
        for held in steps:  # as long as each step of the choice could be made again
            for l, n in held.items():
                if used := bin_.get(l, 0):
                    times = min(times, (counts[l] - n) // used + 1)
        offset = 0
        for l in sorted(bin_, reverse=True):
            n = bin_[l]
            places.append((l, taken[l], n, times, first, offset))
            taken[l] += n * times
            counts[l] -= n * times
            offset += n * l
        first += times
        left = [l for l in left if counts[l]]
    return places, first


def pack(docs: DataFrame, size: int = SIZE, vocabulary: str | None = None,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every piece with its sequence, its place there and its ids (little-endian, 32 bits)."""
    pieces = stored(tokenised_pieces(docs, size, vocabulary, id_column, text_column), "pieces")
    per_part = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    lengths = {r["length"]: r.n for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    places, _ = plan_bins(lengths, size)
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank0"))
    ranked = pieces.join(offsets, ["part", "length"]).withColumn("rank", F.col("rank0") + F.col("nth"))
    place = placer(docs.sparkSession.sparkContext, places)
    found = ranked.withColumn("place", place("length", "rank"))
    return found.select("doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32",
                        F.col("place.sequence_id"), F.col("place.offset"), "ids")


def placer(context, places: list[tuple[int, int, int, int, int, int]]):
    """Column function: (length, rank) to the place. The list is bounded by the lengths, not by the data."""
    rows = np.array(sorted(places), "i8").reshape(-1, 6)
    shared = context.broadcast(rows)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        let_go()  # all texts are encoded by now
        rows = shared.value
        l, r = length.to_numpy("i8"), rank.to_numpy("i8")
        out_seq, out_off = np.empty(len(l), "i8"), np.empty(len(l), "i8")
        for value in np.unique(l):
            own = np.flatnonzero(l == value)
            a, b = np.searchsorted(rows[:, 0], [value, value + 1])
            at = a + np.searchsorted(rows[a:b, 1], r[own], "right") - 1
            p = rows[at]
            q = r[own] - p[:, 1]
            out_seq[own], out_off[own] = p[:, 4] + q // p[:, 2], p[:, 5] + q % p[:, 2] * value
        return pd.DataFrame({"sequence_id": out_seq, "offset": out_off})

    return place
