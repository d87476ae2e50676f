"""Queries of the operators in this subpackage, and their SQL where SQL can state them on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import canonical, leakage, names, packing, representatives, sentences
from recordloom.session import cut, load

TERM_FIELDS = ["pretraining_architecture", "license", "optimizer"]


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    kept = representatives.survivors(load(spark, sf, "extracted"), load(spark, sf, "extractors"))
    return kept.where("group_size > 1").select("group_id", "field_name", "record_id")


def p1_records(spark: SparkSession, sf: str) -> DataFrame:
    """One record for each model, built field by field from the surviving rows."""
    kept = representatives.survivors(load(spark, sf, "extracted"), load(spark, sf, "extractors"))
    pick = lambda field, c: F.max(F.when(F.col("field_name") == field, F.col(c)))
    return kept.groupBy("group_id", "group_size").agg(
        pick("model_name", "value").alias("model_name"), pick("model_name", "record_id").alias("model_name_from"),
        pick("parameters", "value").alias("parameters"), pick("parameters", "record_id").alias("parameters_from"),
    )


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    mapped = canonical.map_fields(load(spark, sf, "llm_properties"), load(spark, sf, "canonical_terms"), "prop_id", TERM_FIELDS)
    return mapped.select("prop_id", "field_name", "term_id")


def p2_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """The values that no entry of the reference list takes, with the rows that hold them and the best score they reached."""
    mapped = canonical.map_fields(load(spark, sf, "llm_properties"), load(spark, sf, "canonical_terms"), "prop_id", TERM_FIELDS)
    return mapped.where("term_id = 0").groupBy("field_name", "value").agg(F.count("*").alias("n_rows"), F.max(F.round("score", 6)).alias("best_score"))


def _linked(spark: SparkSession, sf: str) -> DataFrame:
    return names.entities(names.single_names(load(spark, sf, "llm_properties"), "prop_id"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return names.variant_pairs(cut(_linked(spark, sf)))


def p4_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Every spelling with the entity that it names and how rare the form is that links it."""
    return _linked(spark, sf).select("field_name", "name", "entity", "rarity")


def _packed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    sizes = cut(packing.token_counts(load(spark, sf, "documents")))
    return packing.pack(sizes, load(spark, sf, "context_windows"))


def p7_windows(spark: SparkSession, sf: str) -> DataFrame:
    return _packed(spark, sf)[0]


def p7_certificates(spark: SparkSession, sf: str) -> DataFrame:
    return _packed(spark, sf)[1]


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaks(load(spark, sf, "documents"), load(spark, sf, "eval_items")).select("doc_id", "item_id")


def p8_items(spark: SparkSession, sf: str) -> DataFrame:
    """For each leaked item the number of documents that hold it and the largest share that one holds."""
    found = leakage.leaks(load(spark, sf, "documents"), load(spark, sf, "eval_items"))
    return found.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max("share").alias("most"))


def p8_reparameterised(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold half of an item or more with other names and numbers in its places."""
    return leakage.leaks(load(spark, sf, "documents"), load(spark, sf, "eval_items"), renamed=True)


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return sentences.sentences(load(spark, sf, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_records, p2_found, p2_unmatched, p4_found, p4_entities, p7_windows, p7_certificates, p8_found, p8_items, p8_reparameterised, p9_found)}


def oracle_sql() -> dict[str, str]:
    """None of these can be stated in SQL on whole tables; tests hold them against brute force instead."""
    return {}
