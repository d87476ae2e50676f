import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators import evaluate as E
from recordloom.operators import mapping as M
from recordloom.operators import records as R

TEXT = sorted({*R.GATE_FIELDS, *R.MERGED_FIELDS, "model_version"})
SCHEMA = T.StructType([T.StructField("record_id", T.LongType()), T.StructField("paper_id", T.StringType()), T.StructField("chunk_no", T.IntegerType()), T.StructField("pos", T.IntegerType()), T.StructField("parameters_millions", T.LongType()), *[T.StructField(f, T.StringType()) for f in TEXT]])


def frame(spark, *rows):
    full = [{"record_id": i, "paper_id": "p", "chunk_no": 0, "pos": i, "parameters_millions": None} | dict.fromkeys(TEXT) | r for i, r in enumerate(rows, 1)]
    return spark.createDataFrame([tuple(r[f.name] for f in SCHEMA) for r in full], SCHEMA)


def test_two_half_filled_records_become_one(spark):
    base = {"model_name": "Test", "model_version": "1.0", "parameters": "7B"}
    got = R.dedup_chunks(frame(spark, base | {"pretraining_architecture": "T"}, base | {"organization": "O"}), ["pretraining_architecture", "organization"]).collect()
    assert [(r.n, r.pretraining_architecture, r.organization) for r in got] == [(2, "T", "O")]


def test_sizes_without_millions_do_not_part_a_family(spark):
    a = {"model_family": "GPT", "model_name": "GPT 117M", "parameters": "117M"}
    assert [r.k3 for r in R.chunk_keys(frame(spark, a, a | {"parameters_millions": 117})).orderBy("record_id").collect()] == ["", "117M"]


def test_merge(spark):
    fill = {"organization": "O", "model_family": "Llama", "license": "L"}
    rows = [fill | {"model_name": "Llama 3 8B", "parameters": "8B", "innovation": "ab", "blog_post": "b, a"}, fill | {"model_name": "Llama3 70B", "parameters": "70b", "innovation": "abc", "blog_post": "c,a"}, fill | {"model_name": "Llama"}, {"model_name": "Zz"}]
    got = R.merge_variants(frame(spark, *rows)).collect()
    assert [(r.model_name, r.n_variants, r.parameters, r.innovation, r.blog_post, r.organization) for r in got] == [("Llama 3", 3, "8B, 70B", "abc", "a, b, c", "O")]


def test_selection_never_empties_a_paper(spark):
    df = frame(spark, {"model_name": "LlamaGuard"}, {"model_name": "Tokenizer X"})
    assert R.select_primary(df).count() == 2
    df = frame(spark, {"model_name": "Llama 3 8B", "model_family": "Llama"}, {"model_name": "LlamaGuard", "model_family": "Llama"})
    assert [r.model_name for r in R.select_primary(df).collect()] == ["Llama 3 8B"]


def test_empty_and_all_null(spark):
    for df in (frame(spark).limit(0), frame(spark, {}, {"paper_id": None})):
        assert R.merge_variants(df).count() == 0 and R.dedup_chunks(df, ["license"]).count() == 0
    assert R.select_primary(frame(spark, {}, {})).count() == 2


@pytest.mark.parametrize(
    ("field", "gold", "pred", "match"),
    [
        ("date_created", "2018", "2018-10", True), ("date_created", "2018-09", "2018-10", False), ("date_created", None, None, True), ("date_created", "2018", None, False), ("optimizer", "Adam optimizer", "Adam", True), ("optimizer", "AdamW", "Adam", False),
        ("parameters", "151M", "128M, 151M", True), ("parameters", "110M, 340M", "340M", False), ("organization", "Google AI Language", "google", True), ("parameters_millions", "340.0", "340", True), ("license", "MIT", "mit ", True), ("license", "null", None, False),
        ("innovation", "abc", "abd", None), ("model_name", "GPT-2", "gpt 2 large", True),
    ],
)
def test_strict(spark, field, gold, pred, match):
    df = spark.createDataFrame([(field, gold, pred)], "field string, gold string, pred string")
    assert df.select(E.strict_match().alias("m")).first().m is match


def test_ratio_and_decision(spark):
    df = spark.createDataFrame([("innovation", "bert base", "bert"), ("innovation", "same", "same"), ("innovation", "abcdefghij", "abcdefghix")], "field string, gold string, pred string")
    got = {r.gold: (r.match, None if r.similarity is None else round(r.similarity, 3)) for r in E.decide(df, E.strict_match()).collect()}
    assert got == {"bert base": (False, 0.615), "same": (True, None), "abcdefghij": (True, 0.9)}


def test_counts_of_the_two_rules(spark):
    df = spark.createDataFrame([("x", "y", False), ("x", "x", True), ("x", None, False), (None, "y", False), (None, None, True)], "gold string, pred string, match boolean")
    assert tuple(E.counts(df, []).first()) == (1, 2, 1, 1)
    assert tuple(E.counts(df, [], both_wrong=True).first()) == (1, 2, 2, 1)
    assert E.scores(E.counts(df.limit(0), [])).first().f1 == 0.0


def test_pairing_in_order(spark):
    golds = spark.createDataFrame([("p", 1, "GPT-2", 1), ("p", 2, "GPT", 2), ("p", 3, "gpt", 3)], "paper_id string, gold_id long, name string, g_ord int")
    preds = spark.createDataFrame([("p", 10, "gpt 2 large", 1), ("p", 11, "GPT-2", 2), ("p", 12, "gpt", 3), ("p", 13, "gpt", 4), ("p", 14, None, 5)], "paper_id string, pred_id long, name string, p_ord int")
    assert sorted((r.pred_id, r.gold_id, r.tier) for r in E.pair_greedily(E.pair_edges(golds, preds)).collect()) == [(10, 1, 3), (11, 3, 3)]


def test_statements_number_literals_through_a_paper(spark):
    cols = list(M.PROPERTIES)
    rows = [("p", 0, 0, 1, "A", "https://x"), ("p", 0, 1, 2, "B", None), ("p", 1, 0, 3, "C", " None ")]
    df = spark.createDataFrame(rows, "paper_id string, chunk_no int, pos int, prop_id long, model_name string, blog_post string")
    df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in cols if c not in ("model_name", "blog_post")])
    assert sorted((r.prop_id, r.value, r.reference) for r in M.statements(df).collect()) == [(1, "A", "#literal_0"), (1, "https://x", "https://x"), (2, "B", "#literal_1"), (3, "C", "#literal_2")]
