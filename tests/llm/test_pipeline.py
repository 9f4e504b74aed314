"""The stages in their order, on the supplied tables and on odd rows."""

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from newsloom.llm import decontaminate, jaccard_join, secret_scan
from newsloom.llm.common import stored, table
from newsloom.llm.queries import ORACLES, QUERIES


def test_registered_queries():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)] and set(ORACLES) <= set(QUERIES)


def test_each_stage_takes_effect(spark, sf):
    docs, columns = table(spark, sf, "documents"), table(spark, sf, "documents").columns
    sizes = [docs.count()]
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, sf), name)
        if name != "packing":
            assert docs.columns == columns
        if name == "near_duplicates":
            found = jaccard_join.near_duplicates(docs)
            assert found.select("component_id").distinct().count() == found.count() == docs.count()
        if name == "contamination":
            assert decontaminate.decontaminate(docs, table(spark, sf, "benchmark")).where("n_hit > 0").count() == 0
        if name == "secrets":
            assert secret_scan.scan(docs).where("size(base) + size(extra) > 0").count() == 0
            assert docs.where("n_chars <> length(text)").count() == 0
        sizes.append(docs.select("doc_id").distinct().count())
    assert sizes[1] >= sizes[2] > sizes[3] == sizes[4] == sizes[5] > 0
    assert pipeline.run(spark, sf).count() == docs.count()


def test_odd_rows(spark, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long, __n int"
    rows = [(1, None, "en", "s", 0, 1), (2, "", "en", "s", 0, 1), (3, "12 !", None, None, None, 1), (4, "the ing of " * 9000, "en", None, None, 1),
            (5, "a short text", "en", "s", 12, 1), (5, "a short text", "en", "s", 12, 1), (None, "another short text here", None, "s", 3, 1)]
    for given in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = given
        for name, stage in pipeline.STAGES:
            docs = stored(stage(spark, docs, sf), name)
            if name != "packing":
                assert docs.columns == given.columns
        if given.isEmpty():
            assert docs.isEmpty()
        else:
            assert {r.doc_id for r in docs.collect()} == {4, 5, None}
            assert docs.where("doc_id = 5").count() == 1


def test_own_columns_keep_their_values(spark, sf):
    """Columns of any name come through every filtering stage with the values of their row."""
    names = ["score", "lang_pred", "__n", "__id", "__h", "__text", "__key", "__d", "__t", "__spans", "__c", "key", "n", "text_hash", "spans", "bad_id", "kept_id", "judged_text", "at"]
    docs = table(spark, sf, "documents")
    given = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in names])
    for name, stage in pipeline.STAGES[:-1]:
        given = stored(stage(spark, given, sf), name)
        assert given.columns == docs.columns + names
        wrong = " OR ".join(f"NOT (`{c}` <=> concat('{c}-', doc_id))" for c in names)
        assert given.count() > 0 and given.where(wrong).isEmpty(), name
    assert pipeline.STAGES[-1][1](spark, given, sf).count() >= given.count()


def test_rows_equal_in_id_and_text_keep_the_same_one(spark):
    rows = [(1, "the same words as ever here", f"s{i}") for i in range(20)]
    kept = {tuple(jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(n)).first()) for n in (1, 4, 7)}
    assert len(kept) == 1
