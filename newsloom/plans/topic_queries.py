"""Topic modelling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom import rules
from newsloom.operators import density, topics
from newsloom.plans import demo, sql
from newsloom.plans.sql import with_
from newsloom.sources import tables

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


TERM_CTES = {
    "docs": f"SELECT ({sql.TOPIC})::INT AS topic_id, contenu_clean FROM silver WHERE length(contenu_clean) >= 50",
    "counts": f"""SELECT topic_id, term, count(*) AS n FROM (SELECT topic_id,
        unnest(string_split_regex(lower(contenu_clean), '[^\\p{{L}}\\p{{N}}_]+')) AS term FROM docs)
        WHERE length(term) >= 2 AND term NOT IN {sql.in_list(rules.TOPIC_STOP_WORDS)} GROUP BY 1, 2""",
    "weights": """SELECT topic_id, term, n, round(n / t.words * ln(1 + (SELECT avg(words) FROM
        (SELECT sum(n) AS words FROM counts GROUP BY topic_id)) / f.f), 10) AS weight
        FROM counts JOIN (SELECT term, sum(n) AS f FROM counts GROUP BY 1) f USING (term)
        JOIN (SELECT topic_id, sum(n) AS words FROM counts GROUP BY 1) t USING (topic_id)""",
    "top": """SELECT topic_id, row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, term) AS term_no, term, n, weight
        FROM weights QUALIFY term_no <= 10""",
}


def _terms(spark, sf):
    docs = topics.long_enough(tables.demo_topics(demo.silver_table(spark, sf))).select("topic_id", "contenu_clean")
    return topics.top_terms(topics.term_weights(docs))


@query("topic_ctfidf", with_("SELECT topic_id, term_no, term, n, round(weight, 8) AS weight FROM top", "silver", **TERM_CTES))
def topic_ctfidf(spark, sf):
    return _terms(spark, sf).select("topic_id", "term_no", "term", "n", F.round("weight", 8).alias("weight"))


@query(
    "topic_labels",
    with_(
        """SELECT topic_id, CASE WHEN topic_id = -1 THEN 'hors-sujet' ELSE
             topic_id || '_' || string_agg(term, '_' ORDER BY term_no) END AS topic_label
           FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY term_no) AS k FROM top
                 WHERE NOT regexp_matches(term, '^\\p{Nd}+$')) WHERE k <= 3 GROUP BY topic_id""",
        "silver",
        **TERM_CTES,
    ),
)
def topic_labels(spark, sf):
    return topics.topic_labels(_terms(spark, sf))


@query(
    "topic_reattach",
    with_(
        f"""SELECT article_id, CASE WHEN long THEN {sql.TOPIC} ELSE -1 END AS topic_id,
            CASE WHEN long AND {sql.TOPIC} >= 0 THEN {sql.LABELS}[({sql.TOPIC})::INT + 1] ELSE 'hors-sujet' END AS topic_label,
            CASE WHEN long THEN (arrival % 80 + 20) / 100.0::DOUBLE ELSE 0.0 END AS topic_prob
            FROM (SELECT *, length(contenu_clean) >= 50 AS long FROM silver)""",
        "silver",
    ),
)
def topic_reattach(spark, sf):
    silver = demo.silver_table(spark, sf)
    modelled = tables.demo_topics(topics.long_enough(silver)).select("article_id", "topic_id", "topic_label", "topic_prob")
    labels = modelled.where("topic_id >= 0").select("topic_id", "topic_label").distinct()
    out = topics.attach(silver.select("article_id"), modelled.drop("topic_label"), labels)
    return out.select("article_id", "topic_id", "topic_label", "topic_prob")


@query(
    "topic_defaults",
    """SELECT t.model, t.topic_id, t.topic_label, t.topic_prob, count(*) AS n FROM documents, (VALUES
       ('missing', -1, 'non-modélisé', 0.0::DOUBLE), ('skipped', 0, 'non-modelise', 1.0::DOUBLE),
       ('too_small', -1, 'hors-sujet', 0.0::DOUBLE)) t(model, topic_id, topic_label, topic_prob) GROUP BY ALL""",
)
def topic_defaults(spark, sf):
    docs = demo.silver_table(spark, sf).select("article_id")
    out = None
    for name, fill in [("missing", topics.model_missing), ("skipped", topics.model_skipped), ("too_small", topics.corpus_too_small)]:
        part = fill(docs).groupBy(F.lit(name).alias("model"), "topic_id", "topic_label", "topic_prob").agg(F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.union(part)
    return out


@query(
    "topic_min_size",
    """SELECT vec_id, cluster, cluster_size, CASE WHEN cluster_size < greatest(3, floor(total / 20)) THEN -1 ELSE cluster END AS topic_id
       FROM (SELECT *, count(*) OVER (PARTITION BY cluster) AS cluster_size, count(*) OVER () AS total FROM
             (SELECT vec_id, label + CASE WHEN vec_id % 7 = 0 THEN 10 ELSE 0 END AS cluster FROM embeddings))""",
)
def topic_min_size(spark, sf):
    """Clusters given by the label; one row in seven forms a small side cluster."""
    vectors = tables.table(spark, sf, "embeddings").select(
        "vec_id", (F.col("label") + F.when(F.col("vec_id") % 7 == 0, 10).otherwise(0)).alias("cluster")
    )
    return topics.drop_small(vectors).select("vec_id", "cluster", "cluster_size", "topic_id")


@query(
    "topic_assignment",
    """WITH c AS (SELECT vec_id AS k, embedding::DOUBLE[] AS c FROM embeddings WHERE vec_id < 8),
       s AS (SELECT e.vec_id, k, list_inner_product(embedding::DOUBLE[], c) / (sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_inner_product(c, c))) AS cosine
             FROM embeddings e, c)
       SELECT vec_id, k::INT AS cluster, round_even(greatest(cosine, 0.0), 4) AS membership FROM s
       QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, k) = 1""",
)
def topic_assignment(spark, sf):
    """Assignment and membership against given centres: the first eight vectors."""
    table = tables.table(spark, sf, "embeddings")
    centres = [list(r.embedding) for r in table.where("vec_id < 8").orderBy("vec_id").select(F.col("embedding").cast("array<double>").alias("embedding")).collect()]
    found = topics.assign(topics.embedding_vectors(table).select("vec_id", "features"), centres)
    return found.select("vec_id", "cluster", "membership")


@query("topic_clusters")
def topic_clusters(spark, sf):
    vectors = topics.embedding_vectors(tables.table(spark, sf, "embeddings")).select("vec_id", "features")
    clusters = topics.cluster(vectors)
    return topics.drop_small(clusters).select("vec_id", "topic_id", F.col("membership").alias("topic_prob"))


@query("topic_model")
def topic_model(spark, sf):
    out = topics.model_topics(demo.silver_table(spark, sf), grid=(4, 8), method="centres")
    return out.select("article_id", "topic_id", "topic_label", "topic_prob")


@query("topic_density")
def topic_density(spark, sf):
    """Dense regions of the vectors as topics, the rest as outliers."""
    return density.density_clusters(tables.table(spark, sf, "embeddings"), "vec_id", F.col("embedding"))


@query("topic_model_density")
def topic_model_density(spark, sf):
    out = topics.model_topics(demo.silver_table(spark, sf))
    return out.select("article_id", "topic_id", "topic_label", "topic_prob")


MERGE_FROM = 0.5  # the demo topics are dealt by number, not by subject: their terms are less alike than SAME_TOPIC asks for


def _merge_sql(rounds: int) -> str:
    """Each step as a table of its own: weights of the topics as merged so far, cosines, the best pair."""
    parts = dict(TERM_CTES)
    parts = {k: parts[k] for k in ("docs", "counts")}
    parts["m0"] = "SELECT topic_id, topic_id AS g, count(*) AS size FROM docs WHERE topic_id >= 0 GROUP BY 1"
    for r in range(rounds):
        parts[f"c{r}"] = f"SELECT g, term, sum(n) AS n FROM counts JOIN m{r} USING (topic_id) GROUP BY 1, 2"
        parts[f"w{r}"] = f"""SELECT g, term, n / t.words * ln(1 + (SELECT avg(words) FROM (SELECT sum(n) AS words FROM c{r} GROUP BY g)) / f.f) AS weight
            FROM c{r} JOIN (SELECT term, sum(n) AS f FROM c{r} GROUP BY 1) f USING (term) JOIN (SELECT g, sum(n) AS words FROM c{r} GROUP BY 1) t USING (g)"""
        parts[f"u{r}"] = f"SELECT g, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY g)) AS w FROM w{r}"
        parts[f"p{r}"] = f"""SELECT a.g AS a, b.g AS b, round(sum(a.w * b.w), 10) AS cosine FROM u{r} a JOIN u{r} b USING (term) WHERE a.g < b.g
            GROUP BY 1, 2 HAVING round(sum(a.w * b.w), 10) >= {MERGE_FROM} ORDER BY cosine DESC, a, b LIMIT 1"""
        parts[f"s{r}"] = f"SELECT g, sum(size) AS size FROM m{r} GROUP BY g"
        parts[f"b{r}"] = f"""SELECT {r + 1} AS step, CASE WHEN y.size > x.size THEN b ELSE a END AS kept, CASE WHEN y.size > x.size THEN a ELSE b END AS absorbed, cosine
            FROM p{r} JOIN s{r} x ON x.g = a JOIN s{r} y ON y.g = b"""
        parts[f"m{r + 1}"] = f"SELECT topic_id, CASE WHEN g = (SELECT absorbed FROM b{r}) THEN (SELECT kept FROM b{r}) ELSE g END AS g, size FROM m{r}"
    steps = " UNION ALL ".join(f"SELECT step, kept, absorbed, round(cosine, 8) AS cosine FROM b{r}" for r in range(rounds))
    return with_(steps, "silver", **parts)


@query("topic_merge", _merge_sql(len(tables.TOPIC_LABELS) - 1))
def topic_merge(spark, sf):
    """The steps in which the demo topics become fewer."""
    docs = topics.long_enough(tables.demo_topics(demo.silver_table(spark, sf))).select("topic_id", "contenu_clean")
    steps = topics.merge_topics(topics.term_counts(docs), docs.groupBy("topic_id").agg(F.count(F.lit(1)).alias("n")), MERGE_FROM)
    return spark.createDataFrame(steps, "step int, kept int, absorbed int, cosine double").withColumn("cosine", F.round("cosine", 8))
