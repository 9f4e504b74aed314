"""Token ids in binary files of patched frame-of-reference blocks.

A file holds a run of documents in ascending order of doc_id, so files follow each other:

    magic "NLPF" | blocks | document table | block index | trailer

A block holds BLOCK ids: minimum (u4), width (u1), number of exceptions (u2), number of ids
(u2), the ids less the minimum packed at `width` bits, and the exceptions: positions (u2 each)
and differences (u4 each). The width is the number of bits that `percentile` of the block's
differences need; larger ones are exceptions. The document table lists doc_ids (i8), a null
mark for each (u1) and numbers of ids (i8); the block index lists where blocks start (u8); the
trailer counts documents, ids and blocks (3 x u8) and repeats the magic.

Each task writes one file under a name of its own and reports it; only reports of finished
tasks are read, so a task that ran twice leaves an unread file behind and nothing doubled.

Null and empty texts hold only the end id. Null doc_ids come first. Rows with equal doc_id
stay apart, in the order of a hash of their texts; equal rows are alike, so their order does
not matter. Empty tables write no file. Columns other than id and text are not read."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import let_go, ship, stored
from newsloom.llm.tokens import default_vocabulary, seldom_collected, worker_encoder
from newsloom.session import scratch

ship(__name__)

MAGIC = b"NLPF"
BLOCK = 1024
LANES = BLOCK // 64
PERCENTILE = 0.95
BUFFER_BLOCKS = 512
REPORT = "path string, part int, n_docs long, n_tokens long, n_bytes long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def bits_needed(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype("f8"))[1]


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values, each below 2 ** width, to rows of LANES * width words."""
    v = values.reshape(-1, 64).astype("<u8")
    out = np.zeros((len(v), width), "<u8")
    for j in range(64 if width else 0):
        word, shift = divmod(j * width, 64)
        out[:, word] |= v[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= v[:, j] >> np.uint64(64 - shift)
    return out.reshape(len(values), LANES * width)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    w = words.reshape(-1, width) if width else np.zeros((len(words) * LANES, 0), "<u8")
    out, mask = np.zeros((len(w), 64), "<u8"), np.uint64((1 << width) - 1)
    for j in range(64 if width else 0):
        word, shift = divmod(j * width, 64)
        v = w[:, word] >> np.uint64(shift)
        if shift + width > 64:
            v = v | (w[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = v & mask
    return out.reshape(-1, BLOCK)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """Blocks of the ids; the last may be short and is filled up with its minimum."""
    n, short = -(-len(ids) // BLOCK), len(ids) % BLOCK
    full = np.empty(n * BLOCK, "<u4")
    full[: len(ids)] = ids
    if short:
        full[len(ids) :] = ids[-short:].min()
    rows = full.reshape(n, BLOCK)
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    nth = min(BLOCK - 1, int(percentile * BLOCK))
    widths = bits_needed(np.partition(rest, nth, axis=1)[:, nth])
    out: list[bytes] = [b""] * n
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        some = rest[own]
        large = some >= np.uint64(1 << width)
        packed = pack(np.where(large, 0, some), width)
        for k, i in enumerate(own.tolist()):
            at = np.flatnonzero(large[k])
            size = short if short and i == n - 1 else BLOCK
            head = int(low[i]).to_bytes(4, "little") + bytes([width]) + len(at).to_bytes(2, "little") + size.to_bytes(2, "little")
            out[i] = head + packed[k].tobytes() + at.astype("<u2").tobytes() + some[k][at].astype("<u4").tobytes()
    return out


def decode_blocks(blocks: list[bytes]) -> np.ndarray:
    widths = np.array([b[4] for b in blocks])
    out, sizes = np.empty((len(blocks), BLOCK), "<u4"), np.array([int.from_bytes(b[7:9], "little") for b in blocks])
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        nbytes = LANES * width * 8
        words = np.frombuffer(b"".join([blocks[i][9 : 9 + nbytes] for i in own]), "<u8").reshape(len(own), -1)
        rest = unpack(words, width).astype("<u4")
        for k, i in enumerate(own.tolist()):
            b = blocks[i]
            m = int.from_bytes(b[5:7], "little")
            if m:
                at = np.frombuffer(b, "<u2", m, 9 + nbytes)
                rest[k][at] = np.frombuffer(b, "<u4", m, 9 + nbytes + 2 * m)
            rest[k] += np.uint32(int.from_bytes(b[:4], "little"))
        out[own] = rest
    return out.reshape(-1)[: int(sizes.sum())]  # only the last block is short


class Writer:
    """Writes one file; holds a bounded buffer of ids, and two numbers per document."""

    def __init__(self, sink, percentile: float = PERCENTILE):
        self.sink, self.percentile = sink, percentile
        self.at, self.n = len(MAGIC), 0
        self.ids: list[bytes] = []
        self.held = 0
        self.starts: list[int] = []
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.sizes.append(len(ids) // 4)
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= 4 * BLOCK * BUFFER_BLOCKS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        raw = b"".join(self.ids)
        cut = len(raw) if last else len(raw) - len(raw) % (4 * BLOCK)
        for k in range(0, cut, 4 * BLOCK * BUFFER_BLOCKS):
            some = raw[k : min(cut, k + 4 * BLOCK * BUFFER_BLOCKS)]
            for b in encode_blocks(np.frombuffer(some, "<u4"), self.percentile):
                self.starts.append(self.at)
                self.at += len(b)
                self.sink.write(b)
        self.ids, self.held = [raw[cut:]], len(raw) - cut
        self.n += cut // 4

    def close(self) -> int:
        self._flush(True)
        tail = b"".join(
            [
                np.array([d or 0 for d in self.docs], "<i8").tobytes(),
                bytes(d is None for d in self.docs),
                np.array(self.sizes, "<i8").tobytes(),
                np.array(self.starts, "<u8").tobytes(),
                np.array([len(self.docs), self.n, len(self.starts)], "<u8").tobytes(),
                MAGIC,
            ]
        )
        self.sink.write(tail)
        return self.at + len(tail)


class Reader:
    """Reads a file of `Writer`: documents in order, and any run of ids by the block index."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - 24 - len(MAGIC))
        tail = source.read(24 + len(MAGIC))
        if tail[24:] != MAGIC:
            raise ValueError("not a token file, or one cut short")
        n_docs, self.n, n_blocks = np.frombuffer(tail, "<u8", 3).tolist()
        table = size - 24 - len(MAGIC) - 8 * n_blocks - 17 * n_docs
        source.seek(table)
        raw = source.read(17 * n_docs + 8 * n_blocks)
        ids, null = np.frombuffer(raw, "<i8", n_docs), np.frombuffer(raw, "u1", n_docs, 8 * n_docs)
        self.docs = [None if z else d for d, z in zip(ids.tolist(), null.tolist())]
        self.sizes = np.frombuffer(raw, "<i8", n_docs, 9 * n_docs)
        self.starts = [*np.frombuffer(raw, "<u8", n_blocks, 17 * n_docs).tolist(), table]

    def read(self, first: int, count: int) -> np.ndarray:
        """Ids [first, first + count) of the file; reads only the blocks that hold them."""
        if count == 0:
            return np.empty(0, "<u4")
        a, b = first // BLOCK, (first + count - 1) // BLOCK + 1
        self.source.seek(self.starts[a])
        raw = self.source.read(self.starts[b] - self.starts[a])
        cuts = [x - self.starts[a] for x in self.starts[a : b + 1]]
        return decode_blocks([raw[i:j] for i, j in zip(cuts, cuts[1:])])[first - a * BLOCK :][:count]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, start in the file, number of ids, crc32 of the ids) in order; whole
        documents pass in pieces of at most the buffer's size."""
        step, base, held, start = BLOCK * BUFFER_BLOCKS, 0, b"", 0
        for doc, size in zip(self.docs, self.sizes.tolist()):
            left, crc = 4 * size, 0
            while left:
                if not held:
                    held = memoryview(self.read(base, min(step, self.n - base)).tobytes())
                    base += len(held) // 4
                some = held[:left]
                crc, left, held = zlib.crc32(some, crc), left - len(some), held[len(some) :]
            yield doc, start, size, crc
            start += size


def write_files(docs: DataFrame, folder: str, vocabulary: str | None = None, id_column: str = "doc_id",
                text_column: str = "text", percentile: float = PERCENTILE) -> DataFrame:
    """Write files below `folder` (any address that pyarrow opens); one row per file."""
    vocabulary = vocabulary or default_vocabulary()

    def task(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        part, encoder, writer, sink = TaskContext.get().partitionId(), worker_encoder(vocabulary), None, None
        store, base = fs.FileSystem.from_uri(folder)
        for batch in seldom_collected(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if writer is None:
                    store.create_dir(base)
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.pfor"
                    sink = store.open_output_stream(f"{base}/{name}")
                    writer = Writer(sink, percentile)
                writer.add(doc, encoder.encode(text))
        if writer is not None:
            size = writer.close()
            sink.close()
            row = {"path": name, "part": part, "n_docs": len(writer.docs), "n_tokens": writer.n, "n_bytes": size}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema(
                [("path", pa.string()), ("part", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]
            ))

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(task, REPORT)


def read_files(report: DataFrame, folder: str) -> DataFrame:
    """Read the files that `report` lists: per document its place in the whole sequence of
    ids, their number and checksum."""
    spark = report.sparkSession
    files = sorted(report.select("path", "part", "n_tokens", "n_bytes").collect(), key=lambda r: r.part)  # a row per file
    begins = np.cumsum([0, *[f.n_tokens for f in files]]).tolist()
    listed = [(f.path, b, f.n_bytes) for f, b in zip(files, begins)]

    def task(batches):
        import pyarrow as pa
        from pyarrow import fs

        let_go()  # all texts are encoded by now
        store, base = fs.FileSystem.from_uri(folder)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for path, begin, size in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                with store.open_input_file(f"{base}/{path}") as source:
                    rows = [(d, begin + s, n, crc) for d, s, n, crc in Reader(source, size).documents()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    frame = spark.createDataFrame(listed, "path string, begin long, size long")
    return frame.repartition(max(1, len(listed))).mapInArrow(task, ROWS)


def token_files(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """Write the ids of all documents, read them back and return the table of documents."""
    folder = folder or scratch(docs.sparkSession, "token-files")
    report = stored(write_files(docs, folder, vocabulary), "token-file-list")
    return read_files(report, folder)
