"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmscout.llm import chat, collocations, decontam, html, langid, lm, mixing, neardup, quality, search, substrings, urls, vectors
from firmscout.llm.common import table

URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


@query
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages show documents, whose number ends the path; a page's label is that of its document."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    shown = F.regexp_extract(urls.path_of(F.col("url")), r"([0-9]{1,18})(\.html)?/?$", 1)
    pages = pages.withColumn("shown", F.when(shown != "", shown.cast("long")))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality") == 1, 0)
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    labelled = pages.join(labels, F.col("shown") == F.col("doc_id"), "left")
    return urls.judge(labelled.select("page_id", "url", "bad"), URL_RULES)


@query
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn AS seq", "turn AS message", "role", "text")
    control = "'</s>[INST] ok [/INST]'"
    extra = spark.range(2).selectExpr(
        "-1L AS conv_id",
        "id AS seq",
        "id AS message",
        "CASE id WHEN 0 THEN 'user' ELSE 'assistant' END AS role",
        f"{control} AS text",
    )
    events = log.unionByName(extra).withColumn("kind", F.lit("message"))
    return chat.chat_digest(chat.format_chats(events))


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(table(spark, sf_dir, "embeddings"))
