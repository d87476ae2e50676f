"""Evaluation over one-to-one paired records, on tables made by hand with numbers worked out by hand."""

import random

import pytest

from recordloom.operators import evaluate as E
from recordloom.plans import metrics as P

REF = P.TRUSTED
ROWS = [
    (1, REF, {"model_name": "Foo-1", "license": "MIT", "innovation": "a new way to train models well", "parameters": "1B, 7B", "parameters_millions": 7, "date_created": "2020-05"}),
    (2, REF, {"model_name": "Bar", "license": "MIT", "research_problem": "translation", "organization": "Meta AI"}),
    (3, REF, {"model_name": "Baz"}),
    (11, "x", {"model_name": "foo 1", "license": "MIT", "innovation": "a new way to train models wel", "parameters": "7b, 1b, 2b", "parameters_millions": 7, "date_created": "2020"}),
    (12, "x", {"model_name": "Bar", "license": "GPL", "research_problem": "vision", "organization": "Facebook"}),
    (13, "x", {"model_name": "Bar", "license": "MIT"}),  # Bar is taken
    (14, "y", {"model_name": "bar", "license": "MIT"}),  # of another run, so Bar is free
    (15, "z", {"model_name": "Other", "license": "MIT"}),
]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    fields = ", ".join(f"{f} {'long' if f == 'parameters_millions' else 'string'}" for f in E.FIELDS)
    rows = [{"record_id": i, "paper_id": "p", "extractor": e, "chunk_no": 0, "pos": i, **v} for i, e, v in ROWS]
    spark.createDataFrame(rows + rows[:1], f"record_id long, paper_id string, extractor string, chunk_no int, pos int, ingested_at timestamp, {fields}").write.parquet(f"{d}/extracted.parquet")
    return str(d)


def test_two_and_two_give_two_pairs(spark, sf):
    assert {(r.extractor, r.gold_id, r.pred_id) for r in P.run_pairs(spark, sf).collect()} == {("x", 1, 11), ("x", 2, 12), ("y", 2, 14)}
    assert {(r.extractor, r.gold_id) for r in P.jn11_missing(spark, sf).collect()} == {("x", 3), ("y", 1), ("y", 3), ("z", 1), ("z", 2), ("z", 3)}
    assert {(r.extractor, r.pred_id) for r in P.jn12_unmatched(spark, sf).collect()} == {("x", 13), ("z", 15)}
    assert {r.extractor: (r.n_gold, r.n_pred, r.n_matched, r.n_unmatched, r.n_missing) for r in P.a26_summary(spark, sf).collect()} == {"x": (3, 3, 2, 1, 1), "y": (3, 1, 1, 0, 2), "z": (3, 1, 0, 1, 3)}


def test_similarities(spark, sf):
    got = {(r.gold_id, r.pred_id, r.field): (r.match, r.similarity) for r in P.c7_strict_match(spark, sf).collect()}
    assert got[1, 11, "parameters"] == (True, 0.8)  # two of three named, both found
    assert got[1, 11, "date_created"] == (True, 0.9) and got[1, 11, "model_name"] == (True, 1.0) and got[1, 11, "innovation"] == (None, None)
    assert got[2, 12, "organization"] == (False, None) and got[2, 12, "license"] == (False, 0.0) and got[2, 14, "organization"] == (False, 0.0)
    whole = {(r.gold_id, r.pred_id, r.field): (r.match, r.similarity) for r in P.c8_similar_texts(spark, sf).collect()}
    assert whole[1, 11, "innovation"][0] and whole[1, 11, "innovation"][1] > 0.9 and not whole[2, 12, "organization"][0] and whole[2, 12, "organization"][1] > 0.1


def test_scores_override(spark):
    rows = [("license", "MIT", "MIT", True, 1.0), ("license", "MIT", "Expat", False, 0.0), ("optimizer", "Adam", "Expat", False, 0.0), ("innovation", "a", None, False, 0.0), ("extension", "a", "b", False, 0.0)]
    df = spark.createDataFrame(rows, "field string, gold string, pred string, match boolean, similarity double")
    got = {(r.field, r.pred): (r.match, r.similarity, r.score) for r in E.scored(df, lambda g, p: [0.85 if b == "Expat" else 0.5 for b in p]).collect()}
    assert got == {("license", "MIT"): (False, 0.5, 0.5), ("license", "Expat"): (True, 0.85, 0.85), ("optimizer", "Expat"): (False, 0.0, None), ("innovation", None): (False, 0.0, None), ("extension", "b"): (False, 0.0, 0.5)}


def test_mean_of_means(spark):
    rows = [("a", "innovation", 1.0), ("a", "innovation", 0.5), ("a", "application", 0.25), ("b", "extension", None), ("a", "license", 0.0)]
    got = E.text_aggregate(spark.createDataFrame(rows, "k string, field string, score double"), ["k"]).collect()
    assert [(r.k, r.text_score) for r in got] == [("a", 0.5)]


def test_fields_and_runs(spark, sf):
    got = {r.field: (r.tp, r.fp, r.fn, r.tn) for r in P.a13_paired_metrics(spark, sf).collect()}
    assert set(got) == {*E.FIELDS, "overall"}
    assert got["model_name"] == (3, 0, 0, 0) and got["license"] == (2, 1, 0, 0) and got["organization"] == (0, 1, 1, 1)
    assert got["innovation"] == (1, 0, 0, 2) and got["research_problem"] == (0, 1, 1, 1)
    assert got["overall"] == tuple(sum(got[f][k] for f in E.STRUCTURED) for k in range(4))
    ruled = {r.field: (r.tp, r.fp, r.fn, r.tn, r.n_open) for r in P.a13_field_metrics(spark, sf).collect()}
    assert ruled["innovation"] == (0, 0, 0, 2, 1) and ruled["overall"][:4] == got["overall"]
    runs = {r.extractor: (r.n_papers, r.tp, r.fp, r.fn, r.f1) for r in P.a14_paired_extractors(spark, sf).collect()}
    assert runs == {"x": (1, 7, 3, 0, 0.823529), "y": (1, 2, 0, 2, 0.666667), "z": (1, 0, 0, 0, 0.0)}
    table = {r.extractor: (r.f1, r.grade, r.model_name_f1, r.place) for r in P.g9_paired_results(spark, sf).collect()}
    assert table == {"x": (0.823529, "EXCELLENT", 1.0, 1), "y": (0.666667, "GOOD", 1.0, 2), "z": (0.0, "POOR", 0.0, 3)}
    assert [tuple(r) for r in P.r4_paired_top_extractors(spark, sf).collect()] == [("x", 0.823529), ("y", 0.666667), ("z", 0.0)]
    e = {r.extractor: (r.tp, r.grade, r.exit_code) for r in P.a26_evaluation(spark, sf).collect()}
    assert e["x"][0] == 6 and e["z"] == (0, "POOR", 1)


def test_categories(spark):
    df = spark.createDataFrame([("llama-3.3-70b-instruct",), ("qwen3-235b-a22b",), ("llama-3.3-70b-instruct-x",), ("harrow-72b-instruct",)], "n string")
    assert [r[0] for r in df.select(P.category(df.n)).collect()] == ["Instruction Tuned", "Think / Reasoning", "Unknown", "Unknown"]


@pytest.mark.parametrize("seed", range(3))
def test_rounds_give_the_pairs_of_the_walk(spark, seed):
    """Predictions settled in parallel rounds, whatever of them is left to the walk, against the walk in plain Python."""
    rng, edges = random.Random(seed), []
    for paper in ("a", "b"):
        for pred in range(40):
            for g in rng.sample(range(25), rng.randrange(1, 6)):
                edges.append((paper, pred, pred // 2 * 10 + pred % 2, f"g{g}", g, 100 + g, rng.randrange(1, 4)))
    expected = set()
    for paper in ("a", "b"):
        used: set = set()
        for pred in range(40):
            for *_, name, _, gold, tier in sorted((e for e in edges if e[:2] == (paper, pred)), key=lambda e: (e[6], e[4])):
                if name not in used:
                    used.add(name)
                    expected.add((paper, pred, gold, tier))
                    break
    df = spark.createDataFrame(edges, "paper_id string, pred_id long, p_ord long, gold_name string, g_ord long, gold_id long, tier int")
    for walked in (10_000, 20, 0):
        assert {(r.paper_id, r.pred_id, r.gold_id, r.tier) for r in E.pair_greedily(df, walked).collect()} == expected
