"""Topic model: cluster, weigh terms per topic, label, attach to the articles."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from newsloom import rules
from newsloom.functions import numbers, text
from newsloom.operators import density
from newsloom.operators.skew import join_bounded, top_n_per_key
from newsloom.session import written

NO_TOPIC = "hors-sujet"
MIN_DOCUMENTS = 5
TERMS_PER_TOPIC = 10


def long_enough(df: DataFrame, clean: str = "contenu_clean") -> DataFrame:
    return df.where(F.length(clean) >= rules.MIN_CONTENT_LENGTH)


def tokens(clean: Column) -> Column:
    """Lower-case words of two or more letters or digits, without stop words."""
    parts = F.split(F.lower(clean), "[^\\p{L}\\p{N}_]+")
    return F.filter(parts, lambda w: (F.length(w) >= 2) & ~w.isin(rules.TOPIC_STOP_WORDS))


# ----------------------------------------------------------------- defaults
def with_topic(df: DataFrame, topic_id: int, label: str, prob: float) -> DataFrame:
    return df.withColumns(
        {
            "topic_id": F.lit(topic_id).cast("int"),
            "topic_label": F.lit(label),
            "topic_prob": F.lit(prob).cast("double"),
        }
    )


def model_missing(df: DataFrame) -> DataFrame:
    return with_topic(df, -1, "non-modélisé", 0.0)


def model_skipped(df: DataFrame) -> DataFrame:
    return with_topic(df, 0, "non-modelise", 1.0)


def corpus_too_small(df: DataFrame) -> DataFrame:
    return with_topic(df, -1, NO_TOPIC, 0.0)


# --------------------------------------------------------------- clustering
#: A topic holds a twentieth of the documents at least (`minimum_size`), so there are 20 at most.
MAX_TOPICS = 20
GRID = (5, 10, 15, MAX_TOPICS)
DENSE_FEATURES = 128  # width of the hashed text vectors that are compared by density


def minimum_size(n_documents: Column) -> Column:
    """At least 3 documents, or one in twenty."""
    return F.greatest(F.lit(3), F.floor(n_documents / 20))


def drop_small(clusters: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Clusters below the minimum size become topic -1. Sizes are aggregated first; clusters
    are as many as the model has centres, so their sizes are broadcast."""
    sizes = clusters.groupBy(cluster).agg(F.count(F.lit(1)).alias("cluster_size"))
    floor = sizes.agg(minimum_size(F.sum("cluster_size"))).scalar()
    judged = sizes.withColumn("topic_id", F.when(F.col("cluster_size") < floor, -1).otherwise(F.col(cluster)))
    return join_bounded(clusters, judged, cluster)


def text_vectors(df: DataFrame, clean: str = "contenu_clean", features: int = 1 << 12) -> DataFrame:
    """Unit-length TF-IDF vectors of fixed width: the width does not grow with the corpus."""
    counted = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features).transform(
        df.withColumn("_tokens", tokens(F.col(clean)))
    )
    weighted = IDF(inputCol="_tf", outputCol="_tfidf").fit(counted).transform(counted)
    return Normalizer(inputCol="_tfidf", outputCol="features").transform(weighted).drop("_tokens", "_tf", "_tfidf")


def embedding_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    wide = df.withColumn("_raw", array_to_vector(F.col(column).cast("array<double>")))
    return Normalizer(inputCol="_raw", outputCol="features").transform(wide).drop("_raw")


def cluster(vectors: DataFrame, grid: tuple[int, ...] = GRID, seed: int = 7) -> DataFrame:
    """k-means over a small grid of sizes; the best silhouette decides. Adds `cluster`
    and `membership`, the cosine to the own centre. A vector of zeros (a text without words) has no direction: it takes no part and is in cluster -1."""
    directed = F.exists(vector_to_array("features"), lambda x: x != 0)
    given, best, best_score = vectors.where(directed), None, None
    if given.isEmpty():
        return vectors.withColumns({"cluster": F.lit(-1), "membership": F.lit(0.0)}).drop("features")
    for k in grid:
        model = KMeans(k=k, seed=seed, distanceMeasure="cosine", maxIter=20, predictionCol="cluster").fit(given)
        found = model.transform(given)
        if len(grid) > 1 and found.select("cluster").distinct().limit(2).count() == 2:
            score = ClusteringEvaluator(predictionCol="cluster", distanceMeasure="cosine").evaluate(found)
        else:  # there is nothing to compare
            score = 0.0 if len(grid) == 1 else -1.0
        if best_score is None or score > best_score:
            best, best_score = model, score
    centres = [[float(x) for x in c] for c in best.clusterCenters()]
    placed = assign(vectors.withColumn("_directed", F.coalesce(directed, F.lit(False))), centres)
    placed = placed.withColumn("cluster", F.when(F.col("_directed"), F.col("cluster")).otherwise(-1)).drop("_directed")
    # written, as sizes, their floor and the rows themselves are all asked for
    return written(placed, "topic-clusters")


def assign(vectors: DataFrame, centres: list[list[float]]) -> DataFrame:
    """`cluster`, the nearest centre by cosine (the first of equally near ones), and `membership`, that cosine. Centres
    are MAX_TOPICS at most and of fixed width, so they travel inside the plan."""
    width = len(centres[0])
    sound = all(x is not None and math.isfinite(x) for c in centres for x in c)
    given = F.transform("_features", lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    # entries of zero add nothing: of a text's wide vector only the others are gone through
    kept = F.filter(given, lambda e: F.coalesce(e["x"] != 0, F.lit(True))) if sound else given
    length = lambda e: F.sqrt(F.aggregate(e, F.lit(0.0), lambda s, x: s + x["x"] * x["x"]))
    own = text.let(kept, lambda e: F.when(F.size("_features") == width, F.struct(e.alias("e"), length(e).alias("n"))))

    def centre(c: list[float]) -> Column:
        values = F.array(*[F.lit(x) for x in c])
        if sound:
            norm = F.lit(math.sqrt(reduce(lambda s, x: s + x * x, c, 0.0)))
        else:
            norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda s, x: s + x * x))
        return F.struct(values.alias("c"), norm.alias("n"))

    def cosine(o: Column, c: Column) -> Column:
        dot = F.aggregate(o["e"], F.lit(0.0), lambda s, e: s + e["x"] * F.get(c["c"], e["i"]))
        return F.coalesce(F.try_divide(dot, o["n"] * c["n"]), F.lit(0.0))

    listed = F.array(*[centre(c) for c in centres])
    cosines = text.let(own, lambda o: F.transform(listed, lambda c: cosine(o, c)))
    near = F.array_max(F.transform(cosines, lambda c, i: F.struct(c.alias("cosine"), (-i).alias("at"))))
    found = vectors.withColumn("_features", vector_to_array("features")).withColumn("_near", near)
    return (
        found.withColumn("cluster", (-F.col("_near.at")).cast("int"))
        .withColumn("membership", numbers.round4(F.greatest(F.col("_near.cosine"), F.lit(0.0))))
        .drop("_features", "_near", "features")
    )


# ----------------------------------------------------------- representation
def term_weights(docs: DataFrame, topic: str = "topic_id", clean: str = "contenu_clean") -> DataFrame:
    """Class-based TF-IDF: share of the term in its topic times log(1 + A / f), with
    f the term's total count and A the mean word count per topic.

    Words are counted per (topic, term) with map-side combine; everything else is
    worked out from those counts, so the texts are read once. A term's total adds up
    its counts side by side, of which there is one per topic at most.
    """
    return weighted(term_counts(docs, topic, clean), topic)


def term_counts(docs: DataFrame, topic: str = "topic_id", clean: str = "contenu_clean") -> DataFrame:
    return (
        docs.select(topic, F.explode(tokens(F.col(clean))).alias("term"))
        .groupBy(topic, "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def weighted(counts: DataFrame, topic: str = "topic_id") -> DataFrame:
    per_topic = counts.groupBy(topic).agg(F.sum("n").alias("topic_words"))
    mean_words = per_topic.agg(F.avg("topic_words")).scalar()
    total = F.sum("n").over(W.partitionBy("term"))
    weight = F.col("n") / F.col("topic_words") * F.ln(1 + mean_words / F.col("f"))
    sized = join_bounded(counts.withColumn("f", total), per_topic, topic)
    return sized.select(topic, "term", "n", weight.alias("weight"))


# ------------------------------------------------------------------- merging
#: Topics whose term weights have at least this cosine are one topic.
SAME_TOPIC = 0.9


def similar_topics(weights: DataFrame, topic: str = "topic_id") -> DataFrame:
    """(a, b, cosine) of each two topics that share a term, from their term weights. A term has one
    row per topic at most, so its pairs are as few as those of the topics."""
    length = weights.groupBy(topic).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    one = join_bounded(weights.where("weight > 0"), length, topic).select(topic, "term", (F.col("weight") / F.col("length")).alias("w"))
    a, b = one.toDF("a", "term", "wa"), one.toDF("b", "term", "wb")
    pairs = a.join(b, "term").where("a < b").groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("cosine"))
    return pairs.withColumn("cosine", F.round("cosine", 10))


def merge_topics(counts: DataFrame, sizes: DataFrame, least: float = SAME_TOPIC, topic: str = "topic_id") -> list[tuple[int, int, int, float]]:
    """Steps (number, kept, absorbed, cosine): the two most similar topics (the first two of equally similar ones) become one, under the id of the larger (of equally
    large ones the first), and all weights are worked out anew, until no two reach `least`. `counts`: a term's count per topic, `sizes`: a
    topic's documents. Topics are MAX_TOPICS at most, so are the rounds; topic -1 takes no part."""
    counts = written(counts.where(F.col(topic) >= 0), "topic-counts")
    documents = {r[topic]: r.n for r in sizes.where(F.col(topic) >= 0).collect()}
    steps: list[tuple[int, int, int, float]] = []
    while len(documents) > 1:
        pair = similar_topics(weighted(counts, topic), topic).where(F.col("cosine") >= least).orderBy(F.desc("cosine"), "a", "b").first()
        if pair is None:
            break
        kept, absorbed = sorted((pair.a, pair.b), key=lambda t: (-documents[t], t))
        steps.append((len(steps) + 1, kept, absorbed, pair.cosine))
        documents[kept] += documents.pop(absorbed)
        named = F.when(F.col(topic) == absorbed, F.lit(kept)).otherwise(F.col(topic)).cast(counts.schema[topic].dataType)
        counts = written(counts.withColumn(topic, named).groupBy(topic, "term").agg(F.sum("n").alias("n")), "topic-counts")
    return steps


def merged_ids(steps: list[tuple[int, int, int, float]], topic: Column) -> Column:
    """A topic's id after all steps."""
    out = topic
    for _, kept, absorbed, _ in steps:
        out = F.when(out == absorbed, F.lit(kept)).otherwise(out)
    return out.cast("int")


def top_terms(weights: DataFrame, topic: str = "topic_id", n: int = TERMS_PER_TOPIC) -> DataFrame:
    rounded = weights.withColumn("weight", F.round("weight", 10))
    return top_n_per_key(rounded, [topic], [F.desc("weight"), F.asc("term")], n, "term_no")


def topic_labels(terms: DataFrame, topic: str = "topic_id") -> DataFrame:
    """`<id>_w1_w2_w3` from the first three usable terms; two plain ones when none is
    usable; else `<id>_sujet_<id>`. Topic -1 has a fixed label."""
    listed = terms.groupBy(topic).agg(F.sort_array(F.collect_list(F.struct("term_no", "term"))).alias("_t"))
    words = F.transform("_t", lambda t: t["term"])
    usable = F.filter(
        words,
        lambda w: ~w.isin(rules.TOPIC_STOP_WORDS)
        & ~w.rlike(text.DIGITS)
        & ((F.length(w) > 1) | w.rlike("[^\\x00-\\x7f]")),
    )
    plain = F.filter(words, lambda w: F.length(w) > 2)
    number = F.col(topic).cast("string")
    chosen = (
        F.when(F.size(usable) > 0, F.slice(usable, 1, 3))
        .when(F.size(plain) > 0, F.slice(plain, 1, 2))
        .otherwise(F.array(F.lit("sujet"), number))
    )
    label = F.concat_ws("_", number, F.array_join(chosen, "_"))
    return listed.select(topic, F.when(F.col(topic) == -1, NO_TOPIC).otherwise(label).alias("topic_label"))


def attach(articles: DataFrame, modelled: DataFrame, labels: DataFrame) -> DataFrame:
    """Model output back on all articles; those not modelled get the -1 defaults.
    Labels number at most one per cluster, which bounds their broadcast."""
    named = modelled.join(F.broadcast(labels), "topic_id", "left")
    out = articles.join(named.select("article_id", "topic_id", "topic_label", "topic_prob"), "article_id", "left")
    outside = F.col("topic_id").isNull() | (F.col("topic_id") == -1)
    return out.withColumns(
        {
            "topic_label": F.when(outside, F.lit(NO_TOPIC)).otherwise(F.coalesce("topic_label", F.lit(NO_TOPIC))),
            "topic_id": F.coalesce("topic_id", F.lit(-1)).cast("int"),
            "topic_prob": F.round(F.coalesce("topic_prob", F.lit(0.0)), 4),
        }
    )


def model_topics(silver: DataFrame, grid: tuple[int, ...] = GRID, seed: int = 7, method: str = "density", least_cosine: float = SAME_TOPIC) -> DataFrame:
    """The whole model. A corpus with too few long documents is left unmodelled. `method`: `density` (regions of any shape, outliers between
    them, their number found from the data) or `centres` (k-means over `grid`). Topics alike in their terms are merged."""
    docs = long_enough(silver)
    if docs.limit(MIN_DOCUMENTS).count() < MIN_DOCUMENTS:
        return corpus_too_small(silver)
    texts = docs.select("article_id", "contenu_clean")
    if method == "density":
        vectors = text_vectors(texts, features=DENSE_FEATURES).select("article_id", vector_to_array("features").alias("features"))
        found = density.density_clusters(vectors, "article_id", F.col("features"), seed=seed)
    else:
        vectors = written(text_vectors(texts).drop("contenu_clean"), "topic-vectors")
        found = drop_small(cluster(vectors, grid, seed)).select("article_id", F.col("topic_id").cast("int"), F.col("membership").alias("topic_prob"))
    modelled = written(found, "topic-model")
    worded = texts.join(modelled.where("topic_id >= 0"), "article_id")
    steps = merge_topics(term_counts(worded), modelled.groupBy("topic_id").agg(F.count(F.lit(1)).alias("n")), least_cosine)
    modelled = modelled.withColumn("topic_id", merged_ids(steps, F.col("topic_id")))
    worded = worded.withColumn("topic_id", merged_ids(steps, F.col("topic_id")))
    return attach(silver, modelled, topic_labels(top_terms(term_weights(worded))))
