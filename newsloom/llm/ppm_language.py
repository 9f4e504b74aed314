"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of 0 to `ORDER` bytes with the bytes that followed them.
A byte is coded in the longest context that the tree has: with probability c / (n + d) if it
followed there c times among n, d different bytes having followed, else after an escape of probability
d / (n + d) in the next shorter context; below them all, with 1/256. The statistics are frozen after
training, so a text's exact code length is a sum over its bytes, and the language with the
shortest code wins. A-Z are lower-cased and ASCII white space is a blank; nothing else is changed.

For speed the code lengths are laid out as tables over the contexts of all languages together.
What the tables hold is bounded by the training sample: at most `TRAIN_ROWS` rows per language with
texts of at most `TRAIN_BYTES` bytes, those of the smallest hash. Whole texts are scored, in slices.

Texts that are null or have no letter are `und` with score 0, and so is everything if nothing can be
learned. Ties go to the language first in order. Rows are judged alone by their text; repeated
rows, null ids and extra columns are kept as they are, columns named as the results are replaced."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import bounded_sample, crc_of_id, fresh, given_back, let_go, Shared, ship

ship(__name__)

ORDER = 3
TRAIN_ROWS = 250
TRAIN_BYTES = 20_000
SLICE = 1 << 16  # bytes that are judged at a time: their code lengths take many times as much memory
EVIDENCE = 64  # bytes that the score takes into account
LETTER = re.compile(r"[^\W\d_]")
FOLD = bytes(32 if b in b"\t\n\v\f\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def folded(text: str) -> bytes:
    return text.encode("utf-8", "replace").translate(FOLD)


class Table:
    """Sorted distinct keys with a hash table over them."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype("u4")
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.slots = np.full(1 << self.bits, -1, "i4")
        todo, at = np.arange(len(keys)), self._home(self.keys)
        while len(todo):
            empty = self.slots[at] < 0
            self.slots[at[empty]] = todo[empty]  # of those that want a slot one gets it
            lost = self.slots[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435761)) >> np.uint32(32 - self.bits)).astype("i8")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys, -1 where absent."""
        at = self._home(keys)
        out = self.slots[at]
        if not len(self.keys):
            return out
        wrong = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (len(self.slots) - 1)
            out[wrong] = self.slots[at[wrong]]
            wrong = wrong[(out[wrong] >= 0) & (self.keys[out[wrong]] != keys[wrong])]
        return out


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """Keys of the `size` bytes that end at each place from ORDER on."""
    n = len(data) - ORDER
    key = np.zeros(n, "u4")
    for k in range(size):
        first = ORDER - size + 1 + k
        key = (key << np.uint32(8)) | data[first : first + n]
    return key


@dataclass
class Model:
    languages: list[str]
    bytes_: np.ndarray  # code lengths without a context: [256, languages]
    tables: list[Table]  # grams of 2 .. ORDER + 1 bytes
    costs: list[np.ndarray]  # their code lengths: [grams, languages]
    contexts: list[Table]  # contexts of 1 .. ORDER bytes
    escapes: list[np.ndarray]  # code lengths of their escapes

    def code_lengths(self, data: np.ndarray) -> np.ndarray:
        """[places, languages] for the places from ORDER on."""
        out = np.zeros((len(data) - ORDER, len(self.languages)), "f4")
        rows, keys = None, [grams(data, k) for k in range(1, ORDER + 2)]
        for k in range(ORDER, 0, -1):
            own = keys[k] if rows is None else keys[k][rows]
            at = self.tables[k - 1].find(own)
            seen = at >= 0
            if rows is None:
                out[seen] = self.costs[k - 1][at[seen]]
                rows = np.flatnonzero(~seen)
            else:
                out[rows[seen]] += self.costs[k - 1][at[seen]]
                rows = rows[~seen]
            if not len(rows):
                return out
            context = self.contexts[k - 1].find(keys[k][rows] >> np.uint32(8))
            known = context >= 0
            out[rows[known]] += self.escapes[k - 1][context[known]]
        out[rows] += self.bytes_[keys[0][rows]]
        return out


def train(samples: dict[str, list[str]]) -> Model:
    """Trees from texts per language, laid out over the grams of all languages."""
    languages = sorted(samples)
    lead = b" " * ORDER
    data = {l: [np.frombuffer(lead + folded(t), "u1") for t in samples[l]] for l in languages}
    found = {}
    for l in languages:
        for k in range(1, ORDER + 2):
            some = [grams(d, k) for d in data[l]]
            found[l, k] = np.unique(np.concatenate(some) if some else np.zeros(0, "u4"), return_counts=True)
    bytes_ = np.zeros((256, len(languages)))
    for j, l in enumerate(languages):
        keys, n = found[l, 1]
        total, d = n.sum(), len(n)
        bytes_[:, j] = 8 - (np.log2(d / (total + d)) if d else 0)
        bytes_[keys, j] = -np.log2(n / (total + d))
    tables, costs, contexts, escapes = [], [], [], []
    below, below_costs = None, bytes_
    for k in range(1, ORDER + 1):
        union = np.unique(np.concatenate([np.zeros(0, "u4"), *[found[l, k + 1][0] for l in languages]]))
        table, context = Table(union), Table(np.unique(union >> np.uint32(8)))
        cost, escape = np.zeros((len(union), len(languages))), np.zeros((len(context.keys), len(languages)))
        suffix = union & np.uint32((1 << 8 * k) - 1)
        lower = below_costs[suffix if below is None else below.find(suffix)]
        for j, l in enumerate(languages):
            keys, n = found[l, k + 1]
            at = context.find(keys >> np.uint32(8))
            total, d = np.bincount(at, n, len(context.keys)), np.bincount(at, minlength=len(context.keys))
            escape[:, j] = np.where(d > 0, -np.log2(np.maximum(d, 1) / np.maximum(total + d, 1)), 0)
            cost[:, j] = escape[context.find(union >> np.uint32(8)), j] + lower[:, j]
            cost[table.find(keys), j] = -np.log2(n / (total + d)[at])
        below, below_costs = table, cost
        tables.append(table)
        costs.append(cost.astype("f4"))
        contexts.append(context)
        escapes.append(escape.astype("f4"))
    return Model(languages, bytes_.astype("f4"), tables, costs, contexts, escapes)


def totals(model: Model, texts: list[bytes]) -> np.ndarray:
    """Code lengths in bits per text and language; memory is bounded by SLICE and one text."""
    out = np.zeros((len(texts), len(model.languages)))
    lead, held, owners, size = b" " * ORDER, [], [], 0

    def flush():
        data = np.frombuffer(b"".join(held), "u1")
        cost = model.code_lengths(data)
        ends = np.cumsum([len(h) for h in held])
        begins = ends - [len(h) for h in held]
        for i, a, b in zip(owners, begins.tolist(), ends.tolist()):  # a slice's first ORDER bytes are context
            out[i] += cost[a:b - ORDER].sum(axis=0, dtype="f8")

    for i, text in enumerate(texts):
        for k in range(0, len(text), SLICE):
            before = text[max(0, k - ORDER) : k]
            held.append(lead[len(before) :] + before + text[k : k + SLICE])
            owners.append(i)
            size += len(held[-1])
            if size >= SLICE:
                flush()
                held, owners, size = [], [], 0
    if held:
        flush()
    return out


def judge(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    own = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if model.languages else []
    out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
    data = [folded(texts[i]) for i in own]
    for i, bits, d in zip(own, totals(model, data), data):
        best = int(bits.argmin())
        excess = (bits - bits[best]) * (min(EVIDENCE, len(d)) / len(d))
        out[i] = model.languages[best], float(1 / np.exp2(-excess).sum())
    return out


def learn(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
          held_out: int | None = 1, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> Model:
    """Fit on a bounded sample of the labelled rows whose id is not held out."""
    fold = F.coalesce(F.pmod(crc_of_id(F.col(id_column)), F.lit(3)), F.lit(-1))
    usable = docs.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"), fold.alias("fold")).where(
        F.col("lang").isNotNull() & (F.length("text") > 0) & (F.octet_length("text") <= most_bytes)
    )
    if held_out is not None:
        usable = usable.where(F.col("fold") != held_out)
    order = usable.withColumn("h", F.xxhash64("text"))
    chosen = bounded_sample(order.select("lang", "h").distinct(), "lang", "h", rows)  # `rows` hashes per language at most
    sample = order.join(F.broadcast(chosen.select("lang", "h")), ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text"))
    texts: dict[str, list[str]] = {}
    for r in sample.collect():  # at most `rows` texts of `most_bytes` per language
        texts.setdefault(r.lang, []).append(r.text)
    return train({l: sorted(t) for l, t in texts.items()})


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None, text_column: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns of `keep` (all, if not given), and the language and score, under `names`: own columns of these names are replaced."""
    from pyspark.sql.pandas.types import to_arrow_schema

    keep = [c for c in (keep or docs.columns) if c not in names]
    schema = T.StructType([docs.schema[c] for c in keep]).add(names[0], "string").add(names[1], "double")
    shared, n = Shared(docs.sparkSession, model), len(keep)
    at = keep.index(text_column) if text_column in keep else n  # a text that is kept is sent to the task once
    arrow = to_arrow_schema(schema)

    def task(batches):
        import pyarrow as pa

        let_go()
        model = shared.get()
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                found = judge(model, some.column(at).to_pylist())
                lang, score = pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())
                yield pa.RecordBatch.from_arrays([*some.columns[:n], lang, score], names=arrow.names)
        batch = some = model = None
        given_back()

    judged = [] if at < n else [F.col(text_column).alias(fresh("judged_text", keep))]
    return docs.select(*keep, *judged).mapInArrow(task, schema)
