from pyspark.sql import functions as F

from newsloom.operators import sketches as S


def test_ranges_of_days_merge(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 20_000).alias("v"), F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("d"), (F.col("id") % 2).alias("s"))
    daily = S.daily_sketches(rows, F.col("v"), F.col("d"), "s")
    assert daily.count() == 10  # days and sources go together here: a sketch each
    for first, last in ((None, None), ("2025-01-03", "2025-01-06"), ("2025-01-09", None)):
        chosen = rows.where(F.col("d").between(first or "2025-01-01", last or "2025-12-31"))
        exact = {r.s: (r.u, r.n) for r in chosen.groupBy("s").agg(F.count_distinct("v").alias("u"), F.count(F.lit(1)).alias("n")).collect()}
        for r in S.merged(daily, "s", first=first, last=last).collect():
            assert r.n == exact[r.s][1] and abs(r.about - exact[r.s][0]) <= S.TOLERANCE * exact[r.s][0]


def test_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, "2025-01-01", "a"), ("x", "2025-01-01", "a"), ("x", None, "a"), (None, "2025-01-02", "b")], "v string, d string, s string")
    daily = S.daily_sketches(rows, F.col("v"), F.col("d").cast("date"), "s")
    assert {r.s: (r.about, r.n) for r in S.merged(daily, "s").collect()} == {"a": (1, 3), "b": (0, 1)}
    assert S.merged(daily, "s", first="2025-01-02").collect()[0].s == "b"
    assert S.merged(daily.limit(0), "s").count() == 0
