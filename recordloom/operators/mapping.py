"""Records as property lists and as statements of a knowledge graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.missing import trim_all

# Properties by field, in the order of a contribution.
PROPERTIES = {
    "model_name": "HAS_MODEL", "model_family": "P7121", "date_created": "P49020", "organization": "P18097", "innovation": "P15156", "pretraining_architecture": "P103000", "pretraining_task": "P103001", "pretraining_corpus": "P41655",
    "finetuning_task": "P116000", "optimizer": "P105017", "tokenizer": "P43065", "parameters": "P103002", "parameters_millions": "P110076", "hardware_used": "P119138", "hardware_description": "P119137", "carbon_emitted": "P119142",
    "application": "P37544", "source_code": "HAS_SOURCE_CODE", "blog_post": "P103003", "research_problem": "P32",
}


def property_array() -> Column:
    """Array of (ord, property, label, value) for the mapped fields that are not NULL."""
    each = [F.when(F.col(f).isNotNull(), F.struct(F.lit(i).alias("ord"), F.lit(p).alias("property"), F.lit(f).alias("label"), F.col(f).cast("string").alias("value"))) for i, (f, p) in enumerate(PROPERTIES.items())]
    return F.array_compact(F.array(*each))


def typed_value(c: Column, kind: str) -> tuple[Column, Column]:
    """Text and data type of a property's value: maps as "k: v; ...", lists with commas, everything else as it is."""
    if kind.startswith("map"):
        pairs = F.array_sort(F.map_entries(c))
        return F.array_join(F.transform(pairs, lambda e: F.concat_ws(": ", e["key"], e["value"])), "; "), F.lit("object")
    if kind.startswith("array"):
        return F.array_join(c, ", "), F.lit("list")
    return c.cast("string"), F.lit("string")


def usable(value: Column) -> Column:
    """Values that are uploaded: not blank and not the word none."""
    return value.isNotNull() & (trim_all(value) != "") & (F.lower(trim_all(value)) != "none")


def statements(records: DataFrame, key: str = "prop_id") -> DataFrame:
    """(paper_id, key, ord, property, value, reference, data_type): the statements of each record.

    URLs refer to themselves; all other values are literals numbered through the paper in the order of its records. The number
    is put together from the literals of earlier chunks, of earlier records of the chunk and of earlier properties, so that no
    task holds more than one chunk of a paper.
    """
    r = records.select("paper_id", "chunk_no", "pos", key, F.filter(property_array(), lambda p: usable(p["value"])).alias("props"))
    r = r.withColumn("literals", F.size(F.filter("props", lambda p: ~p["value"].startswith("http"))))
    chunk = r.groupBy("paper_id", "chunk_no").agg(F.sum("literals").alias("n"))
    before = Window.partitionBy("paper_id").orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    chunk = chunk.select("paper_id", "chunk_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from_chunks"))
    inside = Window.partitionBy("paper_id", "chunk_no").orderBy("pos", key).rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("from_records", F.coalesce(F.sum("literals").over(inside), F.lit(0))).join(chunk, (r.paper_id.eqNullSafe(chunk.paper_id)) & (r.chunk_no.eqNullSafe(chunk.chunk_no))).drop(chunk.paper_id).drop(chunk.chunk_no)
    x = r.select("paper_id", key, "props", (F.col("from_chunks") + F.col("from_records")).alias("base"), F.posexplode("props").alias("at", "p"))
    url = F.col("p.value").startswith("http")
    own = F.size(F.filter(F.slice("props", F.lit(1), F.col("at")), lambda p: ~p["value"].startswith("http")))
    literal = F.concat(F.lit("#literal_"), (F.col("base") + own).cast("string"))
    return x.select("paper_id", key, "p.ord", "p.property", "p.value", F.when(url, F.col("p.value")).otherwise(literal).alias("reference"), F.when(~url, F.lit("xsd:string")).alias("data_type"))


def label() -> Column:
    """Name, version and size of a record in one label."""
    return F.concat_ws(" ", "model_name", F.nullif("model_version", F.lit("")), F.nullif("parameters", F.lit("")))
