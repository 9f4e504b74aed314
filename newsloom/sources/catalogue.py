"""The source catalogue and the page selectors as small fixed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom import rules

FIELDS = (
    "key string, domain string, language string, country string, raw_prefix string, "
    "category_in_raw boolean, name string, category string, description string"
)


def source_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rules.SOURCE_CATALOGUE, FIELDS)


def selectors(spark: SparkSession) -> DataFrame:
    rows = [(k, i, s) for k, sels in rules.PAGE_SELECTORS.items() for i, s in enumerate(sels)]
    return spark.createDataFrame(rows, "key string, priority int, selector string")
