"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.llm import decontaminate, dialog_repair, jaccard_join, packing, ppm_language, quality_rules, secret_scan, template_html
from newsloom.llm import token_files, toxicity, url_filter, va_search, whitening
from newsloom.llm.common import crc_of_id, table


def op1_url_cascade(spark, sf_dir):
    rules = spark.createDataFrame(url_filter.RULES, "verdict string, host string, path string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).drop("url")


def op2_cnn_toxicity(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.judge(documents, toxicity.learn(documents, labels), keep=["doc_id"])
    held_out = F.coalesce(F.pmod(crc_of_id(F.col("doc_id")), F.lit(4)) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "flagged")


def op3_template_html(spark, sf_dir):
    return template_html.extract(table(spark, sf_dir, "pages"))


def op4_ppm_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    found = ppm_language.identify(documents, ppm_language.learn(documents), keep=["doc_id"])
    held_out = F.coalesce(F.pmod(crc_of_id(F.col("doc_id")), F.lit(3)) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_prefix_decontaminate(spark, sf_dir):
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.decontaminate(documents, benchmark))


def op6_entropy_secrets(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op7_divideskip_jaccard(spark, sf_dir):
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op8_best_two_fit(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


def op9_va_topk(spark, sf_dir):
    return va_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_token_files(spark, sf_dir):
    return token_files.token_files(table(spark, sf_dir, "documents"))


def op11_risk_quality(spark, sf_dir):
    judged = quality_rules.apply(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_dialog_repair(spark, sf_dir):
    damaged = dialog_repair.damage(table(spark, sf_dir, "conversations"))
    return dialog_repair.digest(dialog_repair.repair(damaged, gone=F.col("gone")))


def op13_whitening(spark, sf_dir):
    return whitening.by_component(whitening.whiten(table(spark, sf_dir, "embeddings")))


QUERIES = {
    "op1_url_cascade": op1_url_cascade,
    "op2_cnn_toxicity": op2_cnn_toxicity,
    "op3_template_html": op3_template_html,
    "op4_ppm_language": op4_ppm_language,
    "op5_prefix_decontaminate": op5_prefix_decontaminate,
    "op6_entropy_secrets": op6_entropy_secrets,
    "op7_divideskip_jaccard": op7_divideskip_jaccard,
    "op8_best_two_fit": op8_best_two_fit,
    "op9_va_topk": op9_va_topk,
    "op10_token_files": op10_token_files,
    "op11_risk_quality": op11_risk_quality,
    "op12_dialog_repair": op12_dialog_repair,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    "op1_url_cascade": url_filter.ORACLE,
    "op5_prefix_decontaminate": decontaminate.ORACLE,
    "op9_va_topk": va_search.ORACLE,
    "op11_risk_quality": quality_rules.oracle(),
    "op12_dialog_repair": dialog_repair.ORACLE,
}
