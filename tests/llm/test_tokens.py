"""Token files and packing: exact round trips, the library's own ids, and a plain packing."""

import io
import random
import zlib
from collections import Counter

import numpy as np

from newsloom.llm import packing, token_files
from newsloom.llm.tokens import Encoder, default_vocabulary

ODD = [
    None, "", " ", "  a  b ", "a  b", "don't  x 's 12 ab\n\n c\t d", "a \n b", "<|endoftext|> x", "x <|endoftext|>", "　 a 　 b", "a \x1c b",
    "a\u0085 b 'll", "x a.\nb", "q é.\nÈ, ªº ſ", "a\nb c\nd.", "汉 字. 汉字", "x ", " x", "!!! !", "word's it''s", "a.b\nc,d e", "x" * 20000, "퟿ z",
]


def test_encoders_are_kept_until_another_step_lets_them_go():
    import gc
    import weakref

    from newsloom.llm.common import let_go
    from newsloom.llm.tokens import worker_encoder

    encoder = worker_encoder(default_vocabulary())
    encoder.encode("some words to remember")
    assert worker_encoder(default_vocabulary()) is encoder
    still = weakref.ref(encoder)
    del encoder
    gc.collect()
    assert still() is not None
    let_go()
    assert still() is None


def test_steps_without_encoding_hold_no_encoder(spark):
    """Each of these steps' tasks leaves a worker that keeps nothing: what is put there by an earlier step of the same worker is gone."""
    from newsloom.llm import ppm_language
    from newsloom.llm.common import kept

    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string").coalesce(1)
    model = ppm_language.train({"en": ["some words"]})
    sent = {}

    class Frame:  # takes the function that a step would send to its tasks
        sparkSession, columns, schema = spark, docs.columns, docs.schema

        def select(self, *_):
            return self

        def mapInArrow(self, task, _):
            sent["task"] = task

    ppm_language.identify(Frame(), model)
    judge = sent["task"]

    def task(batches):
        import pyarrow as pa
        import pyspark

        kept("encoder", dict)["a"] = 1
        found = list(judge(batches))
        yield pa.RecordBatch.from_arrays([pa.array([sum(b.num_rows for b in found)]), pa.array(["_newsloom_kept" in vars(pyspark)])], names=["rows", "kept"])

    assert [tuple(r) for r in docs.mapInArrow(task, "rows long, kept boolean").where("rows > 0").collect()] == [(1, False)]


def expected(encoder, text):
    return [] if not text else encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_the_librarys(sf):
    import duckdb

    encoder = Encoder(default_vocabulary())
    texts = ODD + [r[0] for r in duckdb.sql(f"SELECT text FROM '{sf}/documents.parquet'").fetchall()]
    rnd = random.Random(4)
    texts += ["".join(rnd.choice("ab é'.,\n\t  sS1!") for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    for t in texts:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == expected(encoder, t) + [0], repr(t)


def test_added_tokens_are_the_librarys_by_default():
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(default_vocabulary()), Encoder(default_vocabulary())
    assert np.frombuffer(encoder.encode("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275, 0]
    texts = ["<|endoftext|>", "<|endoftext|><|endoftext|>", "a<|endoftext|>b", "a  <|endoftext|>\n b c", "w " * 9000 + "<|endoftext|>", "<|endoftext|", "<| endoftext |> x"]
    for t in texts + [t for t in ODD if t]:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids + [0], repr(t)


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1023, 1024, 1025, 5000):
        for high in (1, 2, 3, 50257, 2**32):
            ids = rng.integers(0, high, n, dtype="u8").astype("<u4")
            ids[rng.integers(0, n, n // 50)] = 2**32 - 1  # outliers become exceptions
            assert (token_files.decode_blocks(token_files.encode_blocks(ids)) == ids).all()
    assert len(b"".join(token_files.encode_blocks(np.arange(1024, dtype="<u4") % 16))) < 1024 * 0.6


def test_file_gives_any_run_of_ids():
    rng, sink = np.random.default_rng(2), io.BytesIO()
    writer, all_ids = token_files.Writer(sink), []
    for doc in [None, 3, 3, 7, 9, -1]:
        ids = rng.integers(0, 50257, int(rng.integers(1, 700_000))).astype("<u4")
        writer.add(doc, ids.tobytes())
        all_ids.append(ids)
    size = writer.close()
    assert size == len(sink.getvalue())
    reader, whole = token_files.Reader(sink, size), np.concatenate(all_ids)
    assert reader.docs == [None, 3, 3, 7, 9, -1] and reader.n == len(whole)
    for first, count in [(0, 1), (5, 0), (1000, 3000), (len(whole) - 3, 3), (0, len(whole))]:
        assert (reader.read(first, count) == whole[first : first + count]).all()
    assert [(d, n, c) for d, _, n, c in reader.documents()] == [(d, len(i), zlib.crc32(i.tobytes())) for d, i in zip(reader.docs, all_ids)]


def rows_of(spark):
    rows = [(i if i % 4 else None, t, "x") for i, t in enumerate(ODD)] + [(5, "again"), (5, "again"), (6, "w " * 9000)]
    rows = [(r[0], r[1], "x") for r in rows]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(3)


def test_documents_come_back_in_order(spark):
    rows, docs = rows_of(spark)
    encoder, at = Encoder(default_vocabulary()), 0
    got = sorted((tuple(r) for r in token_files.token_files(docs).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    own = Counter()
    for doc, text, _ in rows:
        ids = np.array(expected(encoder, text) + [0], "<u4")
        own[doc, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((d, n, c) for d, _, n, c in got) == own
    for _, start, n, _ in got:
        assert start == at
        at += n


def test_pieces_are_packed_without_gaps(spark):
    rows, docs = rows_of(spark)
    encoder, size = Encoder(default_vocabulary()), 64
    got = packing.pack(docs, size).collect()
    expected_pieces = Counter()
    for doc, text, _ in rows:
        ids = np.array(expected(encoder, text) + [0], "<u4")
        at, end, piece = 0, len(ids) % size or min(len(ids), size), 0
        while at < len(ids):
            expected_pieces[doc, piece, at, end - at, zlib.crc32(ids[at:end].tobytes())] += 1
            at, end, piece = end, end + size, piece + 1
    assert Counter((r.doc_id, r.piece, r.start, r["length"], r.ids_crc32) for r in got) == expected_pieces
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size


def test_runs_of_bins_equal_packing_one_by_one():
    rnd = random.Random(1)
    for _ in range(200):
        size = rnd.choice([8, 16, 30])
        lengths = [rnd.randint(1, size) for _ in range(rnd.randint(1, 120))]
        counts, plain = [0] * (size + 1), []
        for l in lengths:
            counts[l] += 1
        while any(counts):
            bin_, _ = packing.fill_bin(counts, [l for l in range(1, size + 1) if counts[l]], size)
            plain.append(tuple(sorted(bin_.items())))
            for l, n in bin_.items():
                counts[l] -= n
        places, n = packing.plan_bins(Counter(lengths), size)
        bins = {}
        for l, _, per, times, first, _ in places:
            for k in range(times):
                bins.setdefault(first + k, []).append((l, per))
        assert n == len(plain) and sorted(tuple(sorted(b)) for b in bins.values()) == sorted(plain)


def test_exchange_fills_a_gap():
    # 7 leaves a gap of 3 that 2 fills to 9; giving the 2 up for 1 + 2 fills it whole
    places, n = packing.plan_bins({7: 1, 2: 2, 1: 1}, 10)
    assert n == 2 and {(l, first) for l, _, _, _, first, _ in places} >= {(7, 0), (1, 0)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.token_files(docs).count() == 0 and packing.pack(docs).count() == 0
