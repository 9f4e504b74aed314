"""Joins and per-key picks that stay even when one key holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# A key is hot when it holds more than this share of the rows, so there are
# never more than 1/HOT_SHARE hot keys: that bound makes them broadcastable.
HOT_SHARE = 0.001


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str, size: str, row_id: str) -> DataFrame:
    """Left join `rows` with `per_key` (one row per key; `size` = its row count).

    Rows of hot keys find their values in a broadcast of the hot keys, which the
    share above bounds. Rows of all other keys join by shuffle, where no key can
    be large. The shuffle goes by a route and the key: a cold key's route is its
    hash, on both sides; a row that is already served, or has no key, takes the hash of
    its own id, so such rows spread over all partitions.
    """
    extra = [c for c in per_key.columns if c != key]
    total = per_key.agg(F.sum(size).alias("t")).select(F.col("t") * HOT_SHARE).scalar()
    sized = per_key.withColumn("_hot", F.col(size) > total)
    packed = sized.select(key, F.struct(*extra).alias("_v"), "_hot")
    hot = packed.where("_hot").select(key, F.col("_v").alias("_h"))
    cold = packed.where("NOT _hot").select(key, F.xxhash64(key).alias("_route"), F.col("_v").alias("_c"))
    served = F.col("_h").isNotNull() | F.col(key).isNull()
    tagged = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_route", F.when(served, F.xxhash64(row_id, F.lit("own"))).otherwise(F.xxhash64(key))
    )
    joined = tagged.join(cold, [key, "_route"], "left")
    value = F.coalesce(F.col("_h"), F.col("_c"))
    return joined.select(
        *[F.col(c) for c in rows.columns], *[value[c].alias(c) for c in extra]
    )


def join_bounded(rows: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """Left join with a table whose number of keys is bounded by what they are (topics,
    clusters), not by the data: the rows stay where they are."""
    return rows.join(F.broadcast(per_key), key, "left").select(
        *rows.columns, *[c for c in per_key.columns if c != key]
    )


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rn") -> DataFrame:
    """First `n` rows per key. Each group is first cut per slice of input
    partitions, as many slices as a shuffle has partitions, so that no task holds all of a large group."""
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slice_ = F.pmod(F.spark_partition_id(), F.lit(slices))
    first = W.partitionBy(*keys, "_slice").orderBy(*order)
    last = W.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_slice", slice_)
        .withColumn("_rn", F.row_number().over(first))
        .where(F.col("_rn") <= n)
        .drop("_rn", "_slice")
        .withColumn(rank, F.row_number().over(last))
        .where(F.col(rank) <= n)
    )


def keep_one(df: DataFrame, key: str, order: str, last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by `order`. Rows without an order come
    after all others; of rows with equal order one is chosen by a hash of the whole row, so there is always exactly one.

    Every task keeps one row per key before it sends any (`WindowGroupLimit`), so a
    hot key costs the shuffle at most a row per task.
    """
    hashable = [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    by = F.col(order).desc_nulls_last() if last else F.col(order).asc_nulls_last()
    window = W.partitionBy(key).orderBy(by, F.xxhash64(*hashable))
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def most_frequent(df: DataFrame, key: Column, value: str, alias: str) -> DataFrame:
    """Most frequent value per key (column `key`), lowest value on ties: counted per
    (key, value) first, so that the pick works on counts and not on rows."""
    counts = (
        df.select(key.alias("key"), F.col(value).alias("_v"))
        .groupBy("key", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counts.groupBy("key").agg(
        F.min_by("_v", F.struct(-F.col("_n"), F.col("_v"))).alias(alias)
    )
