from fractions import Fraction

import pytest
from pyspark.sql import types as T

from recordloom.operators import quantities as Q

P, C = "parameters", "training_corpus_size"


@pytest.mark.parametrize(
    ("text", "field", "amount", "kind"),
    [
        ("8B", P, 8 * 10**9, None), ("0,35 Mrd. Parameter", P, 350_000_000, "parameters"), ("34,000,000K", P, 34 * 10**9, None), ("1.25亿", P, 125_000_000, None), ("1.24 x 10^11", P, 124 * 10**9, None),
        ("2.7E+10", P, 27 * 10**9, None), ("≈1B (non-embedding)", P, 10**9, None), ("twenty billion", P, 20 * 10**9, None), ("671-billion", P, 671 * 10**9, None), ("1_300_000_000", P, None, None), ("120 Mio.", P, 120 * 10**6, None),
        ("20,000 MB", C, 20 * 10**9, "bytes"), ("4.5 GiB", C, 4831838208, "bytes"), ("20.5 gibibytes", C, 22011707392, "bytes"), ("9B-token corpus", C, 9 * 10**9, "tokens"), ("over 1.2b tokens after dedup", C, 12 * 10**8, "tokens"),
        ("100 bn. subword tokens", C, 10**11, "tokens"), ("0.22 TB (compressed)", C, 22 * 10**10, "bytes"), ("2,350,000 million tokens", C, 235 * 10**10, "tokens"), ("400B toks", C, 4 * 10**11, "tokens"), ("9GB", C, 9 * 10**9, "bytes"),
    ],
)
def test_texts(text, field, amount, kind):
    value, scale, dim = Q.parse(text, field)
    assert (None if scale is None else int(value * scale)) == amount
    assert dim == kind


@pytest.mark.parametrize("text", ["", " ", "N/A", "..", "same as v1", "see Table 2", "large", "not specified", " ", "x" * 50_000])
def test_no_quantity(text):
    assert Q.parse(text, P) is None


def test_statement_of_units():
    assert Q.unit_statement("X rose by 3. The size column is in GB.") == (Fraction(10**9), "bytes")
    assert Q.unit_statement("Mixture weights and totals are in billions of tokens.") == (Fraction(10**9), "tokens")
    assert Q.unit_statement("Why does the batch size change the token accuracy?") is None
    assert Q.unit_statement(None) is None


@pytest.mark.parametrize(
    ("row", "expected"),
    [
        (("17.5", None, None, None, "X 17.5B"), [(P, 175 * 10**8)]),
        (("175", 175000, None, None, "X"), [(P, 175 * 10**9), ("parameters_millions", 175 * 10**9)]),
        (("0.405", None, None, None, "X 405M"), [(P, 405 * 10**6)]),
        ((None, 70, None, None, "X 70B"), [("parameters_millions", 70 * 10**9)]),
        ((None, 70, None, None, None), [("parameters_millions", 70 * 10**6)]),
        (("32B", 32_000_000, None, None, None), [(P, 32 * 10**9), ("parameters_millions", 32 * 10**9)]),
        ((None, None, "53", "Raw volume is given in gigabytes.", None), [(C, 53 * 10**9)]),
        ((None, None, None, None, None), []),
    ],
)
def test_rows(row, expected):
    assert [(f, a) for f, _, a in Q.read_row(*row)] == expected


SCHEMA = "prop_id long, parameters string, parameters_millions long, training_corpus_size string, training_data string, model_name string, amount string, found string"


def test_convert_handles_nulls_repeats_clashes_and_empty(spark):
    rows = [(1, "8B", None, "5 GB", None, "X", "clash", "clash")] * 2 + [(2, None, None, None, None, None, None, None), (None, "7B", 7000, "n/a", None, None, None, None)]
    got = {tuple(r) for r in Q.convert(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, P, "parameters", 8 * 10**9), (1, C, "bytes", 5 * 10**9), (None, P, "parameters", 7 * 10**9), (None, "parameters_millions", "parameters", 7 * 10**9)}
    assert Q.convert(spark.createDataFrame([], SCHEMA)).count() == 0
    assert Q.convert(spark.createDataFrame([], SCHEMA)).schema["amount"].dataType == T.LongType()


def test_sizes_agree_with_names(spark, small):
    """All sizes of the test rows agree with the size that the model's name states."""
    import pandas as pd

    p = pd.read_parquet(f"{small}/llm_properties.parquet").drop_duplicates("prop_id")
    for a, m, name in zip(p.parameters, p.parameters_millions, p.model_name):
        s = Q.size_in_name(name)
        for f, _, x in Q.read_row(a, None if m != m else int(m), None, None, name):
            assert s is None or abs(x - s) * 100 <= s, (a, m, name, f, x)
