"""One query for each operator, with SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    centroids,
    decontaminate,
    html_text,
    licenses,
    neighbours,
    oracles,
    periodic,
    personal,
    quality,
    reputation,
    secrets,
    simhash,
    toxicity,
)
from millrace.llm.common import table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"

#: Host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
NEAREST, QUERY_STEP = 20, 20


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scanner, findings = secrets.fit(docs)
    return secrets.scan(docs, scanner, findings=findings)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    return bpe.digests(table(spark, sf_dir, "documents"), ranks)


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, lambda vec_id: vec_id % QUERY_STEP == 0, NEAREST)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    texts = html_text.extract(pages, html_text.fit(pages), ["page_id"])
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return reputation.judge(pages, texts, docs, labels, URL_RULES)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(table(spark, sf_dir, "embeddings"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"))


def op13_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.report(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_html, op2_secrets, op3_quality, op4_toxicity, op5_simhash, op6_bpe, op7_neighbours,
        op8_decontamination, op9_urls, op10_licenses, op11_centroids,
        op12_periodic, op13_personal,
    )
}
#: The other operators train models, search approximately, or hash and cut in ways SQL lacks.
ORACLES = {
    "op8_decontamination": oracles.DECONTAMINATION,
    "op10_licenses": oracles.LICENSES,
    "op11_centroids": oracles.CENTROIDS,
}
