"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.skew import top_n_per_key
from newsloom.session import scratch

HASHES = 1 << 62
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship(module_name: str) -> None:
    """Let tasks carry this module's functions, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_sample(rows: DataFrame, key: str, hash_column: str, n: int) -> DataFrame:
    """At most `n` rows per key, those of the smallest hash. Keys are few (labels, languages): their
    sizes tell up to which hash to look, so that little more than the sample is sorted."""
    cut = F.lit(0)
    for r in rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).collect():
        share = min(1.0, (n + 5 * n**0.5 + 10) / r.n)
        cut = F.when(F.col(key) == r[key], F.lit(int(share * HASHES))).otherwise(cut)
    near = rows.where(F.pmod(F.col(hash_column), F.lit(HASHES)) < cut)
    return top_n_per_key(near, [key], [F.pmod(F.col(hash_column), F.lit(HASHES)), F.col(hash_column)], n)


def fresh(name: str, *taken: list[str]) -> str:
    """A column name that none of the lists holds, in any case."""
    known = {c.lower() for columns in taken for c in columns}
    while name.lower() in known:
        name = f"_{name}"
    return name


def let(value: Column, use) -> Column:
    """use(value), with the value worked out once however often `use` names it, inside lambdas too."""
    return F.element_at(F.transform(F.array(value), use), 1)


FOLD_BLOCK = 256


def running(items: Column, start: Column, step, kind: str) -> Column:
    """A fold over an array that gives an element for each item. step(state, item) is a struct of `at`, the next state, and `out`, an array
    (type `kind`) of what the item gives. Blocks are folded one after another, so that lists are not copied once for each item."""
    empty = F.expr(f"CAST(array() AS {kind})")

    def inner(state, x):
        return let(step(state["at"], x), lambda r: F.struct(r["at"].alias("at"), F.concat(state["out"], r["out"]).alias("out")))

    def over(all_items):
        def outer(state, b):
            block = F.aggregate(F.slice(all_items, (b * FOLD_BLOCK + 1).cast("int"), FOLD_BLOCK), F.struct(state["at"].alias("at"), empty.alias("out")), inner)
            return let(block, lambda r: F.struct(r["at"].alias("at"), F.concat(state["out"], r["out"]).alias("out")))

        blocks = F.sequence(F.lit(0), F.floor((F.size(all_items) - 1) / FOLD_BLOCK).cast("int"))
        return F.when(F.size(all_items) == 0, empty).otherwise(F.aggregate(blocks, F.struct(start.alias("at"), empty.alias("out")), outer)["out"])

    return let(items, over)


def given_back() -> None:
    """At the end of a task: what Arrow and the allocator keep for later goes back to the system, as Python workers stay."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def kept(name, make):
    """What this worker process keeps for the tasks to come, made where it has none yet. It lies in Spark's module, as this one travels with each task."""
    import pyspark

    held = vars(pyspark).setdefault("_newsloom_kept", {})
    if name not in held:
        held[name] = make()
    return held[name]


def let_go() -> None:
    """At the start of a step that has no use for what other steps keep: this worker process keeps it no longer."""
    import gc

    import pyspark

    if vars(pyspark).pop("_newsloom_kept", None):
        gc.collect()
        given_back()


class Shared:
    """A broadcast of an object of this package's classes, unpickled once in each task."""

    def __init__(self, spark: SparkSession, value):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self):
        return cloudpickle.loads(self.sent.value)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def crc_of_id(c: Column) -> Column:
    """crc32 of an id's decimal text (an unsigned 32-bit number)."""
    return F.crc32(c.cast("string"))
