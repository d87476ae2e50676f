"""Queries of the general data problems: units, schema drift, packed values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators import drift, packed, quantities
from recordloom.session import load

PACKED_FIELDS = ["pretraining_corpus", "hardware_used", "supported_language", "organization"]


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return quantities.convert(load(spark, sf, "llm_properties"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return drift.changes(load(spark, sf, "extraction_files"))


def p5_table(spark: SparkSession, sf: str) -> DataFrame:
    """The one consistent table of all record objects."""
    return drift.consistent(load(spark, sf, "extraction_files"))


def p5_alternatives(spark: SparkSession, sf: str) -> DataFrame:
    """Every path of the fused schema with the types met under it."""
    return drift.alternatives(load(spark, sf, "extraction_files"))


def p5_unread(spark: SparkSession, sf: str) -> DataFrame:
    """Files that add nothing to the table, and why."""
    return drift.unread(load(spark, sf, "extraction_files"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    got = packed.unpack(load(spark, sf, "llm_properties"), "prop_id", PACKED_FIELDS)
    return got.where("n_items > 1").select("prop_id", "field_name", "pos", "item")


def p6_values(spark: SparkSession, sf: str) -> DataFrame:
    """How often each single value occurs once all fields are unpacked."""
    got = packed.unpack(load(spark, sf, "llm_properties"), "prop_id", PACKED_FIELDS)
    return got.groupBy("field_name", "item").agg(F.count("*").alias("n_rows"))


_KIND = """CASE WHEN lower(regexp_replace(k, '[^A-Za-z]', '', 'g')) IN ('modelversion', 'version', 'ver', 'modelver') THEN 'model_version'
  WHEN lower(regexp_replace(k, '[^A-Za-z]', '', 'g')) IN ('papertitle', 'title', 'papername', 'sourcetitle') THEN 'paper_title'
  WHEN lower(regexp_replace(k, '[^A-Za-z]', '', 'g')) IN ('extension', 'extensions', 'ext', 'extendswith', 'modelextension') THEN 'extension' END"""

P5_SQL = f"""
WITH files AS (SELECT DISTINCT ON (file_id) file_id, folder, written_at, payload::JSON AS j FROM extraction_files WHERE payload IS NOT NULL),
picked AS (SELECT file_id, folder, written_at, CASE WHEN json_array_length(j->'extraction_data') > 0 THEN j->'extraction_data' ELSE j->'raw_extraction' END AS recs FROM files),
records AS (SELECT file_id, folder, written_at, unnest(recs::JSON[]) AS r FROM picked WHERE json_array_length(recs) > 0),
keys AS (SELECT file_id, folder, written_at, r, unnest(json_keys(r)) AS k FROM records),
members AS (SELECT file_id, folder, written_at, k, {_KIND} AS field_name, json_type(json_extract(r, '$."' || k || '"')) AS t FROM keys),
typed AS (SELECT file_id, folder, written_at, k, field_name, CASE WHEN t = 'VARCHAR' THEN 'string' WHEN t IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'number' WHEN t = 'BOOLEAN' THEN 'boolean'
  WHEN t = 'ARRAY' THEN 'array' WHEN t = 'OBJECT' THEN 'object' END AS t FROM members),
fields AS (SELECT * FROM (VALUES ('model_version'), ('paper_title'), ('extension')) AS f(field_name)),
present AS (SELECT DISTINCT file_id, folder, written_at FROM records),
states AS (SELECT p.file_id, p.folder, p.written_at, f.field_name, min(t.k) AS key, min(t.t) AS jt
  FROM present p CROSS JOIN fields f LEFT JOIN typed t ON t.file_id = p.file_id AND t.field_name = f.field_name GROUP BY ALL),
seq AS (SELECT *, row_number() OVER w AS rn, lag(key) OVER w AS was, last_value(jt IGNORE NULLS) OVER (PARTITION BY folder, field_name ORDER BY written_at, file_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known
  FROM states WINDOW w AS (PARTITION BY folder, field_name ORDER BY written_at, file_id))
SELECT file_id, field_name, 'added' AS change_kind FROM seq WHERE rn > 1 AND was IS NULL AND key IS NOT NULL
UNION ALL SELECT file_id, field_name, 'removed' FROM seq WHERE rn > 1 AND was IS NOT NULL AND key IS NULL
UNION ALL SELECT file_id, field_name, 'renamed' FROM seq WHERE rn > 1 AND was <> key
UNION ALL SELECT file_id, field_name, 'retyped' FROM seq WHERE rn > 1 AND was IS NOT NULL AND key IS NOT NULL AND jt <> known
"""


_WORDS = r"replace(trim(lower(regexp_replace(regexp_replace(k, '([a-z0-9])([A-Z])', '\1 \2', 'g'), '[^A-Za-z0-9]+', ' ', 'g'))), ' ', '_')"

ALTERNATIVES_SQL = f"""
WITH files AS (SELECT DISTINCT ON (file_id) file_id, written_at, payload::JSON AS j FROM extraction_files WHERE payload IS NOT NULL),
picked AS (SELECT file_id, written_at, CASE WHEN json_array_length(j->'extraction_data') > 0 THEN j->'extraction_data' ELSE j->'raw_extraction' END AS recs FROM files),
records AS (SELECT written_at, unnest(recs::JSON[]) AS r FROM picked WHERE json_array_length(recs) > 0),
keys AS (SELECT written_at, r, unnest(json_keys(r)) AS k FROM records),
typed AS (SELECT written_at, coalesce({_KIND}, {_WORDS}) AS path, json_type(json_extract(r, '$."' || k || '"')) AS t FROM keys)
SELECT path, CASE WHEN t = 'VARCHAR' THEN 'string' WHEN t IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'number' WHEN t = 'BOOLEAN' THEN 'boolean' WHEN t = 'ARRAY' THEN 'array' WHEN t = 'OBJECT' THEN 'object' END AS json_type,
  count(*) AS n_values, min(written_at) AS first_at FROM typed WHERE t <> 'NULL' GROUP BY 1, 2
"""

UNREAD_SQL = """
WITH files AS (SELECT DISTINCT ON (file_id) file_id, folder, payload FROM extraction_files), parsed AS (SELECT file_id, folder, payload, CASE WHEN json_valid(payload) THEN payload::JSON END AS j FROM files)
SELECT file_id, folder, CASE WHEN payload IS NULL THEN 'no payload' WHEN j IS NULL THEN 'no JSON' ELSE 'no records' END AS reason FROM parsed
WHERE j IS NULL OR coalesce(json_array_length(j->'extraction_data'), 0) + coalesce(json_array_length(j->'raw_extraction'), 0) = 0
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p3_found, p5_found, p5_table, p5_alternatives, p5_unread, p6_found, p6_values)}


def oracle_sql() -> dict[str, str]:
    return {"p5_found": P5_SQL, "p5_alternatives": ALTERNATIVES_SQL, "p5_unread": UNREAD_SQL}
