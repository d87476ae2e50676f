import random

import pytest

from recordloom.operators import packed

NAMES = ["StackHive", "BookLoft", "LexVault", "PaperNest", "Maps, Logs and Letters", "Q&A Harvest", "Books & Letters", "CodeBarn (C/C++, Rust)", "Forum 24/7 Dump", "2,048 Cores"]
SHAPES = [", ".join, "; ".join, " | ".join, ",".join, "\n".join, lambda v: "- " + "\n- ".join(v), lambda v: str(list(v)), lambda v: " ".join(f"({i}) {x}" for i, x in enumerate(v, 1)), lambda v: "; ".join(v) + " ;", lambda v: ", ".join(f'"{x}"' for x in v)]


@pytest.fixture(scope="module")
def models(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1_500):
        v = [rng.choice(NAMES) if rng.random() < 0.8 else f"{rng.choice('BCDFG')}{''.join(rng.choice('aeioulnr') for _ in range(6))} dump" for _ in range(rng.choice([1, 1, 2, 3]))]
        shape = rng.choice(SHAPES) if len(v) > 1 else SHAPES[0]
        if shape in (SHAPES[0], SHAPES[3]) and len(v) > 1:
            v = [x for x in v if "," not in x and " and " not in x] or ["StackHive", "BookLoft"]
        rows.append((i, shape(v)))
    df = spark.createDataFrame(rows, "prop_id long, pretraining_corpus string")
    return packed.learn(packed.column_texts(df, "prop_id", ["pretraining_corpus"]))


@pytest.mark.parametrize(
    ("text", "items"),
    [
        ("StackHive, BookLoft", ["StackHive", "BookLoft"]), ("Maps, Logs and Letters", ["Maps, Logs and Letters"]), ("StackHive, Maps, Logs and Letters, LexVault", ["StackHive", "Maps, Logs and Letters", "LexVault"]), ("StackHive and LexVault", ["StackHive", "LexVault"]),
        ("Q&A Harvest & StackHive", ["Q&A Harvest", "StackHive"]), ("CodeBarn (C/C++, Rust); 2,048 Cores", ["CodeBarn (C/C++, Rust)", "2,048 Cores"]), ("Forum 24/7 Dump / LexVault", ["Forum 24/7 Dump", "LexVault"]), ("Bulaner dump, Coluner dump", ["Bulaner dump", "Coluner dump"]),
        ("StackHive, , LexVault", ["StackHive", "LexVault"]), ("StackHive,, LexVault;", ["StackHive", "LexVault"]), ('["A, B", "C"]', ["A, B", "C"]), ("['A', 'B, C']", ["A", "B, C"]), ('"A, B"; C', ["A, B", "C"]), ('"say ""x""", C', ['say "x"', "C"]),
        ("- A\n- Maps, Logs and Letters\n", ["A", "Maps, Logs and Letters"]), ("(1) A (2) B", ["A", "B"]), ("A||B||C", ["A", "B", "C"]), ("A、B", ["A", "B"]), ("A\tB", ["A", "B"]), ("", []), (" ; ", []), ("StackHive", ["StackHive"]), ("StackHive, BookLoft, and LexVault", ["StackHive", "BookLoft", "LexVault"]),
    ],
)
def test_segment(models, text, items):
    assert packed.segment(text, models["pretraining_corpus"]) == items


def test_long_text_is_split_whole(models):
    assert len(packed.segment(", ".join(["StackHive", "LexVault"] * 2_000), models["pretraining_corpus"])) == 4_000


def test_split_handles_nulls_repeats_clashes_and_empty(spark, models):
    rows = [(1, "StackHive; LexVault", "x", 1)] * 2 + [(2, None, "x", 1), (3, "n/a", "x", 1), (None, "A;B", "x", 1)]
    df = spark.createDataFrame(rows, "prop_id long, pretraining_corpus string, item string, pos int")
    got = sorted((r.prop_id or 0, r.pos, r.item) for r in packed.split(df, "prop_id", ["pretraining_corpus"], models).collect())
    assert got == [(0, 1, "A"), (0, 2, "B"), (1, 1, "StackHive"), (1, 2, "LexVault")]
    assert packed.unpack(df.limit(0), "prop_id", ["pretraining_corpus"]).count() == 0
