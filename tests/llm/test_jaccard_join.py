"""Near-duplicate components against all pairs."""

import random
import re

from newsloom.llm import jaccard_join as op

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(LOW)) if x]
    return frozenset() if not w else frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def plain(rows):
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if ids and sets[i] else doc if not sets[i] else None))
    return out


def case(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghij") + rnd.choice("klmnopqrst") + rnd.choice("uvwxyz")
    text = lambda n: [word() for _ in range(n)]
    passage, rows = text(40), []
    for _ in range(12):
        base = text(rnd.randint(1, 120)) + (passage if rnd.random() < 0.4 else [])
        for _ in range(rnd.randint(1, 9)):  # chains of edits: only neighbours may be linked
            rows.append(" ".join(base))
            base = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 25))):
                base[rnd.randrange(len(base))] = word()
            if rnd.random() < 0.2:
                base = base[: max(1, len(base) * 9 // 10)]
    rows += [None, "", " \n", "one", "ONE", "one two", "a b c d", "a b c d e", "a  b\tc\nd e", "é É", "x " * 3000, "x " * 3000 + "y"]
    rows += [" ".join(passage + [f"own{i}" for i in range(k)]) for k in range(8)]
    ids = rnd.sample(range(1000), len(rows))
    rows = list(zip(ids, rows))
    return rows + rows[:3] + [(None, rows[0][1]), (None, "nobody else has this text at all"), (rows[1][0], "same id but another text of more words")]


def test_components_equal_all_pairs(spark):
    for seed in range(2):
        rows = case(seed)
        docs = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id long, text string, n int, node string").repartition(3)
        got = [tuple(r) for r in op.near_duplicates(docs).drop("text_hash").collect()]
        assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


def test_lists_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 2)
    rows = case(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert sorted((tuple(r) for r in op.near_duplicates(docs).drop("text_hash").collect()), key=repr) == sorted(plain(rows), key=repr)


def test_linked_sets_meet_often_enough_in_their_short_lists():
    """Every pair of sets that reaches its overlap has the occurrences that candidates need; some that do not reach it are refused."""
    import numpy as np

    rnd, order, refused = random.Random(4), np.array([1, 1, 2, 3] * (op.COUNTERS // 4), "u1"), 0
    for _ in range(2000):
        both, one, two = rnd.randint(1, 60), rnd.randint(0, 25), rnd.randint(0, 25)
        drawn = np.array([rnd.getrandbits(64) for _ in range(both + one + two)], "u8")
        a, b = np.sort(drawn[: both + one]), np.sort(np.concatenate([drawn[:both], drawn[both + one :]]))
        short = [np.sort(op.rarest(x, order, 75)) for x in (a, b)]
        enough = op.occurrences(*short) >= op.occurrences_needed(len(a), len(b), 75)
        if 100 * both >= 75 * (both + one + two):
            assert enough
        refused += not enough
    assert refused


def test_sketches_never_show_too_small_an_overlap():
    import numpy as np

    rnd, refused = random.Random(8), 0
    for _ in range(2000):
        both, one, two = rnd.randint(0, 90), rnd.randint(1, 40), rnd.randint(1, 40)
        drawn = np.array([rnd.getrandbits(64) for _ in range(both + one + two)], "u8")
        a, b = np.sort(drawn[: both + one]), np.sort(np.concatenate([drawn[:both], drawn[both + one :]]))
        x, y = (np.frombuffer(op.sketch(s), "u1") for s in (a, b))
        assert both <= op.most_in_common(len(a), len(b), x, y)
        refused += op.most_in_common(len(a), len(b), x, y) < op.required(len(a), len(b), 75)
    assert refused > 500


def test_whole_sets_are_chosen_without_a_shuffle(spark):
    sets = spark.range(500).selectExpr("id * 7919 as node", "10 as n", "cast(cast(id as string) as binary) as hashes", "cast('' as binary) as short")
    pairs = spark.createDataFrame([(0, 10, 7919, 10), (7919 * 3, 10, 7919 * 400, 10)], "a long, na int, b long, nb int")
    chosen = op.only_of(sets, pairs, "hashes")
    assert "Exchange" not in chosen._jdf.queryExecution().executedPlan().toString()
    assert chosen.columns == ["node", "n", "hashes"]
    assert sorted(r.node for r in chosen.collect()) == [0, 7919, 7919 * 3, 7919 * 400]


def test_a_pair_comes_once_however_often_its_sets_do(spark):
    import numpy as np

    own = np.arange(10, dtype="u8").tobytes()
    sets = spark.createDataFrame([(1, 10, own), (1, 10, own), (2, 10, own), (2, 10, own), (2, 10, own)], "node long, n int, hashes binary")
    pairs = spark.createDataFrame([(1, 10, 2, 10)], "a long, na int, b long, nb int")
    assert [tuple(r) for r in op.linked(pairs, sets, 75).collect()] == [(1, 10, 2, 10)]


def test_portions_hold_whole_lists():
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(6)
    rows = sorted((rnd.randrange(3), rnd.randrange(4), i) for i in range(60))
    cuts = sorted(rnd.sample(range(61), 9))
    batches = [pa.RecordBatch.from_arrays([pa.array(np.array([r[c] for r in rows[i:j]], "i8")) for c in range(3)], names=list("abc")) for i, j in zip([0, *cuts], [*cuts, 60])]
    for keys in (1, 2):
        parts = list(op.by_list(batches, lambda columns: [list(zip(*(c.tolist() for c in columns)))], keys))
        assert [r for p in parts for r in p] == rows
        names = [{r[:keys] for r in p} for p in parts]
        assert sum(map(len, names)) == len(set().union(*names))


def test_one_of_each_component_stays(spark):
    rows = case(3)
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, label string")
    kept = op.keep_one(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(set(got)) == len(got) and set(got) <= set(rows)
    expected = {c for _, n, c in plain(rows) if n and c is not None}
    assert {i for i, t in got if shingles(t) and i is not None} == expected
    assert {t for _, t in got if not shingles(t)} == {t for _, t in rows if not shingles(t)}


def test_a_large_group_of_near_copies(spark):
    rnd = random.Random(1)
    base = [f"w{rnd.randrange(5000)}" for _ in range(150)]
    rows = []
    for i in range(400):
        w = list(base)
        w[rnd.randrange(150)] = f"e{i}"
        w[rnd.randrange(150)] = f"f{i}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in op.near_duplicates(docs).collect()} == {0}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op.near_duplicates(docs).count() == 0 and op.keep_one(docs).count() == 0
