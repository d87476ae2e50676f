"""Edge rows of the column functions, expectations derived by hand."""

import random

import pytest
from pyspark.sql import functions as F

from recordloom.functions import names as N
from recordloom.functions import text as X
from recordloom.operators import answers as J


def one(spark, f, *values, kind="string"):
    df = spark.createDataFrame([values], ", ".join(f"c{i} {kind}" for i in range(len(values))))
    return df.select(f(*[F.col(c) for c in df.columns]).alias("x")).first().x


@pytest.mark.parametrize(("a", "b"), [("2018", "2018-01"), ("2018-10", "2018-10"), ("2018-10-01", "2018-10"), ("Oct 2018", "Oct 2018"), (None, None)])
def test_dates(spark, a, b):
    assert one(spark, N.normalize_date, a) == b


@pytest.mark.parametrize(("a", "b"), [("Google AI Language", "Google"), ("DeepMind", "Google"), ("meta", "Meta"), ("University of Washington", "University Of Washington"), ("nlp-lab x", "Nlp-Lab X"), ("X", "X"), ("", ""), (None, None)])
def test_organisations(spark, a, b):
    assert one(spark, N.normalize_organisation, a) == b


@pytest.mark.parametrize(("a", "b"), [("Gemini Nano1", "Gemini Nano 1"), ("GPT-4", "GPT-4"), ("T5-Large", "T 5-Large")])
def test_spacing(spark, a, b):
    assert one(spark, N.spaced, a) == b


@pytest.mark.parametrize(("a", "b"), [("Llama 3.1 70B", "3.1"), ("GPT-2 1.5B", "2"), ("BERT Base", None)])
def test_versions(spark, a, b):
    assert one(spark, N.version_token, a) == b


@pytest.mark.parametrize(("a", "b"), [("Llama 3 8B", "Llama 3"), ("BERT Base", "BERT"), ("Transformer-XL", "Transformer"), ("Transformer-XL 12L", "Transformer-XL"), ("T5-Large (11B)", "T 5"), (None, ""), ("", "")])
def test_canonical_names(spark, a, b):
    assert one(spark, N.canonical_name, a) == b


@pytest.mark.parametrize(("a", "b"), [(" 1.5b ", "1.5B"), ("340", "340M"), ("n/a", None), ("110M, 340M", "110M, 340M"), (None, None)])
def test_sizes(spark, a, b):
    assert one(spark, N.normalize_size, a) == b


@pytest.mark.parametrize(("a", "b"), [("Base=117M, Large=360M", "117M, 360M"), ("1.5B, 124M", "124M, 1.5B"), ("Same as BART", None), (None, None)])
def test_gold_parameters(spark, a, b):
    assert one(spark, N.gold_parameters, a) == b


@pytest.mark.parametrize(("a", "b"), [("110-340", 340), ("125M, 1.5B", 1), ("7B", 7), ("", None), (None, None)])
def test_sheet_millions(spark, a, b):
    assert one(spark, N.sheet_millions, a) == b


@pytest.mark.parametrize(("a", "b"), [("7B", 7000), ("1.5 billion", 1500), ("117M", 117), ("1T", 1)])
def test_derived_millions(spark, a, b):
    assert one(spark, N.derived_millions, a) == b


def test_cleaning(spark):
    assert one(spark, X.clean_text, "This  is   a    test.\n\n\n\nWith   multiple   spaces. https://a.b/c x@y.z") == "This is a test. With multiple spaces."
    assert one(spark, X.clean_text, None) == ""


def test_chunks(spark):
    spans = lambda text, n, o: [(s.start, s.stop) for s in one(spark, lambda c: X.chunk_spans(c, n, o), text)]
    assert spans("A" * 10_000, 3_000, 100) == [(0, 3000), (2900, 5900), (5800, 8800), (8700, 10000)]
    assert spans("Short text", 1_000, 100) == [(0, 10)]
    assert spans("", 1_000, 100) == [(0, 0)]
    with pytest.raises(ValueError):
        X.chunk_spans(F.lit("x"), 300, 200)

    def by_hand(t, size, overlap):
        if len(t) <= size:
            return [(0, len(t))]
        out, start = [], 0
        while start < len(t):
            end = start + size
            if end < len(t) and (at := t[max(start, end - 200) : end].rfind(". ")) != -1:
                end = max(start, end - 200) + at + 1
            out.append((start, min(end, len(t))))
            start = end - overlap
        return out

    text = " ".join(f"Sentence {i} about chunks. And more words" for i in range(400))
    for size, overlap in ((500, 50), (1_500, 100), (700, 300)):
        assert spans(text, size, overlap) == by_hand(text, size, overlap)


def test_table(spark):
    t = spark.createDataFrame([([["Model", "Size", "F1"], ["A|x", None], ["B", "2\n3", " 4 "]],)], "t array<array<string>>")
    assert t.select(X.table_markdown(F.col("t")).alias("x")).first().x == "| Model | Size | F1 |\n|---|---|---|\n| A\\|x |  |  |\n| B | 2 3 | 4 |"
    for empty in ([], [[]]):
        assert spark.createDataFrame([(empty,)], "t array<array<string>>").select(X.table_markdown(F.col("t")).alias("x")).first().x == ""


def test_repetition(spark):
    assert one(spark, X.stop_repetition, "a" * 120 + "{" + "b" * 2_000) == "a" * 120 + "{" + "b" * 999
    assert one(spark, X.stop_repetition, "normal text {x}" * 10) == "normal text {x}" * 10


@pytest.mark.parametrize(
    ("a", "b"),
    [('x<|assistant|>```json\n{"a": 1}\n``` z', '{"a": 1}'), ('<think>{no}</think>{"a": {"b": 2}} tail }', '{"a": {"b": 2}}'), ('{"a": 1}<think>open {', '{"a": 1}'), ("none", None), ('{"a": {"b": 1}', '{"a": {"b": 1}'), (None, None)],
)
def test_isolate(spark, a, b):
    assert one(spark, J.isolate, a) == b


@pytest.mark.parametrize("text", ['{"a": 1,}', '{a: "x", "b": [1, 2,]}', '{"a": {"b": [1, 2', '{"a": "x"} {"b": 1}', '{"url": "https://x.y/z", "a": "cut in a str', '{"a": 1 /* note */}'])
def test_repair(text):
    import json

    assert isinstance(json.loads(J.repair(text)), dict)


def test_repair_leaves_valid_json_and_gives_up():
    assert J.repair('{"a": "x // y"}') == '{"a": "x // y"}'
    assert J.repair("no json") is None and J.repair(None) is None


def test_balance():
    assert J.balance('{"a": ["}"') == '{"a": ["}"]}'


def test_chunks_are_the_pieces_of_the_spans(spark):
    rng = random.Random(4)
    texts = ["", "short. text", *["".join(rng.choice("ab. é語") for _ in range(n)) for n in (299, 300, 301, 900, 5_000)]]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts, None])], "doc_id int, text string, chunk_ string")
    got = {(r.doc_id, r.chunk_no): (r.start_pos, r.chunk, r.chunk_) for r in X.chunked(df, "text", 300, 50).collect()}
    want = {}
    for r in df.where("text is not null").select("doc_id", "text", X.chunk_spans(F.col("text"), 300, 50).alias("s")).collect():
        want |= {(r.doc_id, k): (s.start, r.text[s.start : s.stop], "x") for k, s in enumerate(r.s)}
    assert got == want and len(got) > 20
