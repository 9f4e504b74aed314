"""Toxicity by a convolutional text classifier.

A word's embedding is the sum of hashed embeddings of the word and of its beginnings (words that
share a stem share most of it). Filters of 1, 2 and 3 words slide over the whole text, and each
filter's largest response feeds a logistic output. Trained in numpy on every labelled row: the driver starts (Adam, and
Adagrad for the embeddings) on at most `TRAIN_ROWS` rows per label with texts of at most `TRAIN_BYTES` bytes; from there every task goes on over its
share of all labelled rows, whole texts of any length, and what the tasks changed is averaged (an embedding over the tasks that
met it, by how often they did). A fifth of the rows, by hash of the id, is set aside: all of its logits, counted in steps of 1 / `STEPS`, place
the decision at `DECISION` (the best F1) and a threshold for each language that has enough rows.

The score uses nothing but the text: every word of it. Null and empty texts are scored like a
text without words. Rows are judged alone; repeated rows and null ids are kept, other
columns are not read. Without labels of both kinds every score is 0."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import Shared, bounded_sample, crc_of_id, ship

ship(__name__)

BUCKETS = 1 << 15
WIDTHS = (1, 2, 3)
FILTERS = 16
EMBEDDING = 16
NONE = BUCKETS  # an embedding of zeros
PAD = 0  # the row of a word without letters, which also stands before and after a text
STEMS = (2, 3, 4, 5, 6, 7)
FEATURES = 1 + len(STEMS)
TRAIN_ROWS = 3_000
TRAIN_BYTES = 30_000
EPOCHS = 8
BATCH = 32
DECISION = 0.3
LEAST_FOR_LANGUAGE = 30  # toxic rows set aside that a language needs for a threshold of its own
SLICE = 4_000  # words scored at a time
REMEMBERED = 300_000
BLOCK = 128  # rows of the embedding that are averaged as one value
STEPS = 64
LARGEST = 60  # logits are counted up to here
INNER = re.compile(r"[\W_]+")


def columns() -> list[tuple[int, int, int]]:
    """(width, place in the filter, first column) of the projections."""
    out, at = [], 0
    for w in WIDTHS:
        for j in range(w):
            out.append((w, j, at))
            at += FILTERS
    return out


LAYOUT = columns()
PROJECTIONS = FILTERS * len(LAYOUT)


def features(plain: str) -> list[int]:
    """Hash buckets of a word and of its beginnings."""
    if plain.isascii():
        b, n, crc = plain.encode(), len(plain), zlib.crc32
        return [crc(b) % BUCKETS if n else NONE, *[crc(b[:k] + b"-") % BUCKETS if n > k else NONE for k in STEMS]]
    raw = [plain, *(f"{plain[:k]}-" if len(plain) > k else "" for k in STEMS)]
    return [zlib.crc32(r.encode("utf-8", "replace")) % BUCKETS if r else NONE for r in raw]


class Words(dict):
    """Words as written to rows of `known`; rows are numbered as words come up."""

    def __init__(self):
        super().__init__()
        self.plain: dict[str, int] = {"": PAD}
        self.known: list[list[int]] = [[NONE] * FEATURES]

    def __missing__(self, word: str) -> int:
        plain = word.lower()
        if not plain.isalnum():
            plain = INNER.sub("", plain)
        if plain not in self.plain:
            self.plain[plain] = len(self.known)
            self.known.append(features(plain))
        self[word] = self.plain[plain]
        return self[word]

    def rows(self, text: str | None) -> np.ndarray:
        raw = (text or "").split()
        found = np.fromiter(map(self.__getitem__, raw), "i4", len(raw))
        return found[found != PAD]


class Rows:
    """Rows of an array that are worked out as words come up."""

    def __init__(self, width: int, kind: str, of):
        self.array, self.used, self.of = np.empty((0, width), kind), 0, of

    def upto(self, known: list[list[int]]) -> np.ndarray:
        if len(known) > len(self.array):
            grown = np.empty((2 * len(known), self.array.shape[1]), self.array.dtype)
            grown[: self.used] = self.array[: self.used]
            self.array = grown
        if len(known) > self.used:
            self.array[self.used : len(known)] = self.of(known[self.used :])
            self.used = len(known)
        return self.array


def table_of(known: list[list[int]]) -> np.ndarray:
    return np.array(known, "i4").reshape(-1, FEATURES)


def stacked(kernel: np.ndarray) -> np.ndarray:
    """One column per filter over the words of the widest window."""
    out = np.zeros((EMBEDDING * max(WIDTHS), FILTERS * len(WIDTHS)), "f4")
    for w, j, at in LAYOUT:
        k = WIDTHS.index(w) * FILTERS
        out[j * EMBEDDING : (j + 1) * EMBEDDING, k : k + FILTERS] = kernel[:, at : at + FILTERS]
    return out


def responses(vectors: np.ndarray, filters: np.ndarray) -> np.ndarray:
    """Responses (filter, place) at all places that have a whole window."""
    reach = max(WIDTHS)
    n = len(vectors) - reach + 1
    return filters.T @ np.concatenate([vectors[j : n + j] for j in range(reach)], axis=1).T


FRONT, BACK = np.full(max(WIDTHS) - 1, PAD, "i4"), np.full(max(WIDTHS), PAD, "i4")


def padded(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The texts end to end, so that no window with a word reaches from one into the next, and where each begins, with the end."""
    ids = np.concatenate([x for d in docs for x in (FRONT, d, BACK)])
    return ids, np.cumsum([0, *[len(d) + len(FRONT) + len(BACK) for d in docs]])


def strongest(ids: np.ndarray, begins: np.ndarray, vectors: np.ndarray, filters: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(text, filter): the largest response and, if asked for, its place in `ids`. About SLICE words at a time; longer texts in pieces."""
    n, more = len(begins) - 1, max(WIDTHS) - 1
    best, at = np.full((n, filters.shape[1]), -np.inf, "f4"), np.zeros((n, filters.shape[1]), "i8")
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(begins, begins[first] + SLICE, "right")) - 1)
        s, e = int(begins[first]), int(begins[last])
        if e - s > SLICE:
            for k in range(s, e - more, SLICE):
                found = responses(vectors[ids[k : min(k + SLICE + more, e)]], filters)
                where = found.argmax(axis=1)
                top = found[np.arange(len(found)), where]
                better = top > best[first]
                best[first][better], at[first][better] = top[better], where[better] + k
        else:
            found = responses(vectors[ids[s:e]], filters)
            if places:
                for i in range(first, last):
                    b = int(begins[i]) - s
                    where = found[:, b : int(begins[i + 1]) - s].argmax(axis=1) + b
                    best[i], at[i] = found[np.arange(len(found)), where], where + s
            else:
                best[first:last] = np.maximum.reduceat(found, begins[first:last] - s, axis=1).T
        first = last
    return best, at


@dataclass
class Model:
    embedding: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    output: np.ndarray
    offset: float
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def vectors(self, known: list[list[int]]) -> np.ndarray:
        return self.embedding[table_of(known)].sum(axis=1)

    def pooled(self, docs: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
        """The largest response of each filter per text."""
        return strongest(*padded(docs), vectors, stacked(self.kernel))[0]

    def logits(self, docs: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
        active = np.maximum(self.pooled(docs, vectors) + self.bias, 0)
        return (active * self.output).sum(axis=1) + self.offset + self.shift  # row by row: a text's logit does not depend on its neighbours


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Training:
    """Parameters with what their optimizers remember: Adam, and Adagrad for the rows of the embedding."""

    def __init__(self, rng: np.random.Generator):
        self.embedding = rng.normal(0, 0.3, (BUCKETS + 1, EMBEDDING)).astype("f4")
        self.embedding[NONE] = 0
        self.params = {
            "kernel": rng.normal(0, 0.2, (EMBEDDING, PROJECTIONS)).astype("f4"),
            "bias": np.zeros(FILTERS * len(WIDTHS), "f4"),
            "output": rng.normal(0, 0.2, FILTERS * len(WIDTHS)).astype("f4"),
            "offset": np.zeros(1, "f4"),
        }
        self.moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.params.items()}
        self.squares = np.full((BUCKETS + 1, 1), 1e-3, "f4")
        self.met = np.zeros(BUCKETS + 1, "f4")  # in how many steps a row of the embedding was changed
        self.steps = 0

    def step(self, docs: list[np.ndarray], table: np.ndarray, labels: np.ndarray) -> None:
        """One step on a batch of texts, whose words are rows of `table`."""
        params = self.params
        ids, begins = padded(docs)
        own_words, inverse = np.unique(ids, return_inverse=True)
        vectors = self.embedding[table[own_words]].sum(axis=1)
        top, at = strongest(inverse, begins, vectors, stacked(params["kernel"]), places=True)
        top = top + params["bias"]
        active = np.maximum(top, 0)
        error = (sigmoid(active @ params["output"] + params["offset"]) - labels).astype("f4") / len(docs)
        back = error[:, None] * params["output"] * (top > 0)
        grads = {"output": active.T @ error, "offset": error.sum(keepdims=True), "bias": back.sum(axis=0)}
        kernel, change = np.zeros_like(params["kernel"]), np.zeros((len(own_words), EMBEDDING), "f4")
        touched_words = np.zeros(len(own_words), bool)
        rows, deltas = [], []
        for w, j, col in LAYOUT:
            k = WIDTHS.index(w) * FILTERS
            place = inverse[at[:, k : k + FILTERS] + j]
            g = back[:, k : k + FILTERS]
            kernel[:, col : col + FILTERS] += np.einsum("dfe,df->ef", vectors[place], g)
            rows.append(place.ravel())
            deltas.append((g[:, :, None] * params["kernel"][:, col : col + FILTERS].T[None]).reshape(-1, EMBEDDING))
        rows = np.concatenate(rows)
        touched_words[rows] = True
        added(change, rows, np.concatenate(deltas))
        grads["kernel"] = kernel
        self.steps += 1
        for name, g in grads.items():
            m, v = self.moments[name]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            params[name] -= 0.004 * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)
        spread = table[own_words[touched_words]]
        touched, inverse = np.unique(spread, return_inverse=True)
        sums = np.zeros((len(touched), EMBEDDING), "f4")
        added(sums, inverse.ravel(), np.repeat(change[touched_words], FEATURES, axis=0))
        self.squares[touched] += (sums**2).mean(axis=1, keepdims=True)
        self.embedding[touched] -= 0.05 * sums / np.sqrt(self.squares[touched])
        self.embedding[NONE] = 0
        self.met[touched] += 1

    def model(self) -> Model:
        p = self.params
        return Model(self.embedding, p["kernel"], p["bias"], p["output"], float(p["offset"][0]))


def added(to: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Adds values to rows of an array, rows of equal number too."""
    order = np.argsort(rows, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(rows[order]) != 0))
    to[rows[order][starts]] += np.add.reduceat(values[order], starts, axis=0)


def started(docs: list[np.ndarray], known: list[list[int]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Training:
    rng = np.random.default_rng(seed)
    training, table = Training(rng), table_of(known)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for b in range(0, len(order), BATCH):
            own = order[b : b + BATCH]
            training.step([docs[i] for i in own], table, labels[own])
    return training


def fit(docs: list[np.ndarray], known: list[list[int]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    return started(docs, known, labels, epochs, seed).model()


def continued(labelled: DataFrame, training: Training) -> Training:
    """The training carried on over all rows (t, y) by every task on its own, and averaged. Tasks send their changes in
    blocks of the embedding's rows, which are added up by block."""
    shared = Shared(labelled.sparkSession, training)
    names = sorted(training.params)

    def task(batches):
        import pyarrow as pa

        own, rng, words, table, n = shared.get(), np.random.default_rng(7), Words(), Rows(FEATURES, "i4", table_of), 0
        before, params = own.embedding.copy(), {k: v.copy() for k, v in own.params.items()}
        own.met[:] = 0
        for batch in batches:
            order = rng.permutation(batch.num_rows)
            for b in range(0, len(order), BATCH):
                some = batch.take(pa.array(order[b : b + BATCH]))
                if len(words) > REMEMBERED:
                    words, table = Words(), Rows(FEATURES, "i4", table_of)
                docs = [words.rows(t) for t in some.column(0).to_pylist()]
                own.step(docs, table.upto(words.known), some.column(1).to_numpy().astype("f4"))
                n += len(docs)
        if not n:
            return
        changes = {-1: np.concatenate([[n], *[(n * (own.params[k].astype("f8") - params[k])).ravel() for k in names]])}
        for b in np.unique(np.flatnonzero(own.met) // BLOCK).tolist():
            s = slice(b * BLOCK, (b + 1) * BLOCK)
            met = own.met[s, None]
            changes[b] = np.concatenate([met, met * (own.embedding[s] - before[s])], axis=1).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(list(changes), pa.int32()), pa.array([c.astype("f4").tobytes() for c in changes.values()], pa.binary())], names=["block", "change"])

    def total(key, rows):
        import pyarrow as pa

        sums = 0.0
        for c in rows.column("change"):
            sums = sums + np.frombuffer(c.as_buffer(), "f4").astype("f8")
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "change": pa.array([sums.tobytes()], pa.binary())})

    schema = "block int, change binary"
    changes = labelled.select("t", "y").mapInArrow(task, schema).groupBy("block").applyInArrow(total, schema)
    for r in changes.collect():  # the parameters once
        change = np.frombuffer(r.change, "f8")
        if r.block < 0:
            at = 1
            for k in names:
                p = training.params[k]
                training.params[k] = (p + change[at : at + p.size].reshape(p.shape) / change[0]).astype("f4")
                at += p.size
        else:
            rows = change.reshape(-1, 1 + EMBEDDING)
            training.embedding[r.block * BLOCK : r.block * BLOCK + len(rows)] += (rows[:, 1:] / np.maximum(rows[:, :1], 1)).astype("f4")
    training.embedding[NONE] = 0
    return training


def best_threshold(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The logit at which F1 is best; between two texts, halfway."""
    order = np.argsort(-logits, kind="stable")
    hit, all_ = np.cumsum((labels * weights)[order]), np.cumsum(weights[order])
    f1 = 2 * hit / (all_ + (labels * weights).sum())
    last = np.append(np.diff(logits[order]) < 0, True)  # a threshold cannot part equal logits
    k = int(np.where(last, f1, -1).argmax())
    following = logits[order][k + 1] if k + 1 < len(order) else logits[order][k] - 1
    return float((logits[order][k] + following) / 2)


def learn(docs: DataFrame, labels: DataFrame, held_out: int | None = 2, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES,
          id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", lang_column: str = "lang") -> Model | None:
    fold = F.coalesce(F.pmod(crc_of_id(F.col(id_column)), F.lit(4)), F.lit(-1))
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    if held_out is not None:
        known = known.where(F.pmod(crc_of_id(F.col("id")), F.lit(4)) != held_out)
    texts = docs.where(fold != (held_out if held_out is not None else -2)).select(
        F.col(id_column).alias("id"), F.col(text_column).alias("t"), F.col(lang_column).alias("lang")
    ).where(F.length("t") > 0)
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    usable = known.join(texts.select("id").distinct(), "id", "left_semi")
    shares = {r.y: r.n for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(shares) < 2:
        return None
    aside = F.pmod(F.shiftright(crc_of_id(F.col("id")), 2), F.lit(5)) == 0
    short = texts.where(F.octet_length("t") <= most_bytes)
    startable = known.where(~aside).join(short.select("id").distinct(), "id", "left_semi")
    chosen = bounded_sample(startable.withColumn("h", F.xxhash64("id")), "y", "h", rows).select("id", "y")  # 2 x `rows` at most
    sample = short.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min("t").alias("t")).orderBy("id").collect()
    memory = Words()
    given, y = [memory.rows(r.t) for r in sample], np.array([r.y for r in sample], "f4")
    labelled = texts.join(known.hint("merge"), "id")  # labels grow with the texts: no plan sends them to every task
    training, n = started(given, memory.known, y), sum(shares.values())
    # few rows that are mostly new to the driver's start are gone over as often as that went over its own
    for _ in range(1 if 2 * len(given) > n else min(EPOCHS, -(-EPOCHS * TRAIN_ROWS // n))):
        training = continued(labelled.where(~aside), training)
    model = training.model()
    step = F.floor(F.greatest(F.least("score", F.lit(float(LARGEST))), F.lit(-float(LARGEST))) * STEPS)
    counted = scored(labelled.where(aside), model, ["y", "lang"], "t", raw=True).groupBy("lang", "y", step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    langs = np.array([r.lang for r in counted], object)
    found, y, n = (np.array(c, "f8") for c in ([(r.step + 0.5) / STEPS for r in counted], [r.y for r in counted], [r.n for r in counted]))
    if len(set(y.tolist())) == 2:
        level = np.log(DECISION / (1 - DECISION))
        model.shift = float(level - best_threshold(found, y, n))
        for lang in sorted({x for x in langs if x is not None}):
            own = langs == lang
            if (y * n)[own].sum() >= LEAST_FOR_LANGUAGE:
                model.thresholds[lang] = float(sigmoid(np.array(best_threshold(found[own] + model.shift, y[own], n[own]))))
    return model


def score(docs: DataFrame, model: Model | None, keep: list[str], text_column: str = "text") -> DataFrame:
    """The columns of `keep` and the score of the whole text."""
    keep = [c for c in keep if c != "score"]
    if model is None:
        return docs.select(*keep, F.lit(0.0).alias("score"))
    return scored(docs, model, keep, text_column)


def scored(docs: DataFrame, model: Model, keep: list[str], text_column: str, raw: bool = False) -> DataFrame:
    """The columns of `keep` and the score of the whole text or, if `raw`, its logit."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([docs.schema[c] for c in keep]).add("score", "double")
    shared, n, names = Shared(docs.sparkSession, model), len(keep), to_arrow_schema(schema).names

    def task(batches):
        import pyarrow as pa

        model, words = shared.get(), Words()
        vectors = Rows(EMBEDDING, "f4", model.vectors)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                if len(words) > REMEMBERED:
                    words, vectors = Words(), Rows(EMBEDDING, "f4", model.vectors)
                some = batch.slice(k, 256)
                given = [words.rows(t) for t in some.column(n).to_pylist()]
                found = model.logits(given, vectors.upto(words.known)).astype("f8")
                yield pa.RecordBatch.from_arrays([*some.columns[:n], pa.array(found if raw else sigmoid(found), pa.float64())], names=names)

    return docs.select(*keep, F.col(text_column).alias("__text")).mapInArrow(task, schema)


def judge(docs: DataFrame, model: Model | None, keep: list[str], lang_column: str | None = "lang", text_column: str = "text") -> DataFrame:
    """score, predicted (at the common decision) and, where a language column is
    given, flagged (at the language's own threshold, the common one where it has none)."""
    wanted = [c for c in docs.columns if c in keep or c == lang_column]
    found = score(docs, model, wanted, text_column).withColumn("predicted", (F.col("score") >= DECISION).cast("int"))
    if lang_column is not None:
        level = F.lit(DECISION)
        for lang, value in sorted((model.thresholds if model else {}).items()):
            level = F.when(F.col(lang_column) == lang, F.lit(value)).otherwise(level)
        found = found.withColumn("flagged", F.col("score") >= level)
    return found.select(*keep, "score", "predicted", *(["flagged"] if lang_column is not None else []))
