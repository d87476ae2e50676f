import datetime as dt
import json
import re

from recordloom.operators import drift

SCHEMA = "file_id long, folder string, file_name string, written_at timestamp_ntz, ingested_at timestamp_ntz, payload string, key string, value string"
T0 = dt.datetime(2024, 1, 1)


def frame(spark, payloads, folder="a", hours=1):
    return spark.createDataFrame([(i, folder, f"{i}.json", T0 + dt.timedelta(hours=hours * i), T0, p, "clash", "clash") for i, p in enumerate(payloads, 1)], SCHEMA)


def doc(*records, layout="extraction_data"):
    return json.dumps({"arxiv_id": "x", layout: list(records)})


def listed(df):
    return {tuple(r) for r in drift.changes(df).collect()}


def test_each_kind_of_change(spark):
    files = [
        doc({"model_version": "1"}, {"model_version": None}), doc(layout="raw_extraction"), doc({"model_version": 1.5}, layout="raw_extraction"), doc({"Model_Version": 2}), doc({"tokenizer_version": "3", "file_extension": "json", "short_title": "x"}),
        doc({"ver": ["3"], "ext": None}), doc({"ver": None, "ext": True}), doc({"ver": {"a": 1}, "extensions": "s"}), "no json", None, doc({"ver": ["x"], "extensions": "s"}),
    ]
    assert listed(frame(spark, files)) == {
        (3, "model_version", "retyped"), (4, "model_version", "renamed"), (5, "model_version", "removed"), (6, "model_version", "added"), (6, "extension", "added"),
        (8, "model_version", "retyped"), (8, "extension", "renamed"), (8, "extension", "retyped"), (11, "model_version", "retyped"),
    }


def test_types_known_before_a_gap_count_after_it(spark):
    assert listed(frame(spark, [doc({"ver": "1"}), doc({"x": 1}), doc({"ver": None}), doc({"ver": 3})])) == {(2, "model_version", "removed"), (3, "model_version", "added"), (4, "model_version", "retyped")}


def test_buckets_do_not_matter(spark):
    df = frame(spark, [doc({"ver": v}) if v else doc({"title": "t"}) for v in ["1", 2, None, ["x"], "1", 3.5, None, None, {"a": 1}]], hours=7)
    per = [{tuple(r) for r in drift.changes(df, seconds).collect()} for seconds in (60, 3_600 * 20, 10**9)]
    assert per[0] == per[1] == per[2]


def test_nulls_repeats_and_empty(spark):
    df = frame(spark, [doc({"ver": "1"}), doc({"ver": 2})])
    assert listed(df.union(df)) == listed(df) == {(2, "model_version", "retyped")}
    none = df.withColumn("folder", df.folder.substr(2, 0)).selectExpr("file_id", "nullif(folder, '') AS folder", "file_name", "CAST(NULL AS timestamp_ntz) AS written_at", "ingested_at", "payload", "key", "value")
    assert listed(none) == {(2, "model_version", "retyped")}
    assert listed(df.limit(0)) == set() and drift.consistent(df.limit(0)).count() == 0


def test_consistent_table(spark):
    df = frame(spark, [doc({"model_name": "A", "ver": 1.5, "paper_name": {"main": "T", "lang": "en"}, "ext": ["a", "b"]}, {"model_name": "B", "Extension": True, "title": "S"})])
    a, b = drift.consistent(df).orderBy("pos").collect()
    assert (a.model_name, a.model_version_tag, a.model_version_number, a.model_version, a.paper_title, a.paper_title_tag, a.extension, a.extension_array) == ("A", "number", 1.5, "1.5", "T", "object", "a; b", ["a", "b"])
    assert (b.model_version, b.paper_title_string, b.extension_boolean, b.extension) == (None, "S", True, "true")


def test_all_paths_and_unread_files(spark):
    df = frame(spark, [doc({"model_name": "A", "Learning-Rate": 0.1, "learning_rate": None, "tags": ["a", 1], "opt": {"value": "x"}, "none": None}, 5, {}), "no json", None, doc(), '[1]'])
    (r,) = drift.consistent(df.union(df)).collect()
    assert {k: tuple(v) for k, v in r.others.items()} == {"learning_rate": ("number", "0.1"), "tags": ("array", "a; 1"), "opt": ("object", "x"), "none": (None, None)}
    assert {(u.file_id, u.reason) for u in drift.unread(df.union(df)).collect()} == {(2, "no JSON"), (3, "no payload"), (4, "no records"), (5, "no records")}
    got = {(a.path, a.json_type, a.n_values) for a in drift.alternatives(df.union(df)).collect()}
    assert got == {("model_name", "string", 1), ("learning_rate", "number", 1), ("tags", "array", 1), ("opt", "object", 1)}
    assert drift.unread(df.limit(0)).count() == drift.alternatives(df.limit(0)).count() == 0


def test_against_brute_force(spark, small):
    import pandas as pd

    names = {"model_version": {"modelversion", "version", "ver", "modelver"}, "paper_title": {"papertitle", "title", "papername", "sourcetitle"}, "extension": {"extension", "extensions", "ext", "extendswith", "modelextension"}}
    kind = lambda v: None if v is None else "boolean" if isinstance(v, bool) else "number" if isinstance(v, (int, float)) else {str: "string", list: "array", dict: "object"}[type(v)]
    files = pd.read_parquet(f"{small}/extraction_files.parquet").drop_duplicates("file_id").sort_values(["written_at", "file_id"])
    expected = set()
    for _, group in files.groupby("folder"):
        prev, known = None, {}
        for x in group.itertuples():
            j = json.loads(x.payload)
            records = j.get("extraction_data") or j.get("raw_extraction")
            if not records:
                continue
            now = {}
            for f, spellings in names.items():
                hits = [(k, kind(r[k])) for r in records for k in r if re.sub("[^a-z]", "", k.lower()) in spellings]
                now[f] = (min((k for k, _ in hits), default=None), min((t for _, t in hits if t), default=None))
                if prev is not None:
                    was, k, t = prev[f][0], *now[f]
                    if (was is None) != (k is None):
                        expected.add((x.file_id, f, "added" if k else "removed"))
                    elif k:
                        if was != k:
                            expected.add((x.file_id, f, "renamed"))
                        if t and known.get(f, t) != t:
                            expected.add((x.file_id, f, "retyped"))
                known[f] = now[f][1] or known.get(f)
                known = {a: b for a, b in known.items() if b}
            prev = now
    assert {tuple(r) for r in drift.changes(spark.read.parquet(f"{small}/extraction_files.parquet")).collect()} == expected
