"""Baselines and merges see every field of a record."""

import pytest

from recordloom.operators import records as R
from recordloom.plans import records as P

KEYS = {"paper_id": "p", "chunk_no": 1, "pos": 1, "extractor": "x"}
NAME = {"model_name": "Foo 2 7B", "model_family": "Foo", "organization": "Org"}
LATE = {"hardware_used": "64 chips", "extension": "a longer text", "research_problem": "translation", "date_created": "2024-01", "pretraining_corpus": "web"}


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    rows = [KEYS | NAME | {"record_id": 1}, KEYS | NAME | LATE | {"record_id": 2, "pos": 2}, KEYS | {"paper_id": "q", "record_id": 3, "model_name": "Bar", "organization": " "}]
    fields = ", ".join(f"{f} {'long' if f == 'parameters_millions' else 'string'}" for f in R.RECORD_FIELDS)
    spark.createDataFrame(rows, f"record_id long, paper_id string, chunk_no int, pos int, extractor string, {fields}, ingested_at timestamp").write.parquet(f"{d}/extracted.parquet")
    return str(d)


def test_fields_are_those_of_the_table(spark, small):
    kept = {"record_id", "paper_id", "chunk_no", "pos", "extractor", "extracted_at", "ingested_at"}
    assert set(R.RECORD_FIELDS) == set(spark.read.parquet(f"{small}/extracted.parquet").columns) - kept
    assert len(R.RECORD_FIELDS) == 20


def test_baseline_counts_the_whole_record(spark, sf):
    assert {r.record_id: r.is_baseline for r in P.f7_baseline_record(spark, sf).collect()} == {1: True, 2: False, 3: True}


@pytest.mark.parametrize("query", [P.a1_dedup_records, P.a3_dedup_records, P.a5_merge_records, P.a11_merge_records])
def test_merges_keep_every_field(spark, sf, query):
    got = [r.asDict() for r in query(spark, sf).collect()]
    (r,) = [r for r in got if r["organization"] == "Org"]
    assert {f: r[f] for f in LATE} == LATE
