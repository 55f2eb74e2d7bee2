"""The registered queries of the training-data operators, and their SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from helixframe.llm import collocations, filter_audit, language, licenses, media, mixing, near_dup, packing, private, repetition, secrets, tokens, warc
from helixframe.plans.registry import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.repetition(table(spark, sf_dir, "documents"))
    return found.drop("spans")


@query
def op2_transport_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(media.stored_media(table(spark, sf_dir, "documents")))


@query
def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.pareto_mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies", "expected_copies", "source")


@query
def op4_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


@query
def op5_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@query
def op6_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query
def op10_token_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.digests(tokens.tokenized(table(spark, sf_dir, "documents")))


@query
def op9_fast_sketch_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


SQL["op11_phrase_collocations"] = collocations.ORACLE_SQL


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op12_filter_audit"] = filter_audit.ORACLE_SQL


@query
def op13_private_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.find_private(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
