import random

import pytest

from recordloom.llm import canonical as C


@pytest.fixture(scope="module")
def terms(spark, small):
    return spark.read.parquet(f"{small}/canonical_terms.parquet")


@pytest.fixture(scope="module")
def ids(terms):
    return {r.term: r.term_id for r in terms.collect()}


CASES = {
    "license": {
        "apache2.0 (weights and code)": "Apache License 2.0", "Apache v2 per model card": "Apache License 2.0", "Apache 1.1": None, "M.I.T. license": "MIT License", "modified BSD license": "BSD 3-Clause License", "lesser GPL 3": "GNU Lesser General Public License v3", "GPLv3": "GNU General Public License v3", "GPL v1": None, "LGPLv3": "GNU Lesser General Public License v3",
        "cc-by-nc-sa-4.0": "Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "CC BY 3.0": None, "Attribution, non commercial, 4.0": "Creative Commons Attribution-NonCommercial 4.0", "three-clause BSD": "BSD 3-Clause License", "BSD3": "BSD 3-Clause License", "Harbour Community Licence 2": "Harbor Community License 2",
        "Harbor Community License 5": None, "proprietary weights": "Proprietary", "public domain dedication": None, "Zugeke research agreement": None, "Apache Licesne 2.0": "Apache License 2.0",
    },
    "optimizer": {"ADAM optimizer": "Adam", "Adam-W": "AdamW", "Adam (beta1=0.9, beta2=0.98)": "Adam", "AdamW (b1=.9 b2=.95 eps=1e-8)": "AdamW", "SGD + momentum 0.9": "SGD with Momentum", "S.G.D.": "Stochastic Gradient Descent", "Adadelta": None, "L-BFGS": None, "layer-wise adaptive rate scaling": "LARS", "adaptive moment estimation": "Adam", "root mean square propagation": "RMSProp", "our own scheduler": None, "lars [as reported]": "LARS"},
    "pretraining_architecture": {"causal decoder": "Decoder-only Transformer", "enc-dec": "Encoder-Decoder Transformer", "MoE (8 experts, top-2)": "Mixture-of-Experts Transformer", "rnn (GRU cells)": "Recurrent Neural Network", "spiking network": None, "prefixlm decoder": "Prefix Language Model", "uni-directional decoder stack": "Decoder-only Transformer", "attention + state space hybrid": "Hybrid Attention-SSM", "  decoder only ": "Decoder-only Transformer", "non-causal (prefix) decoder": "Prefix Language Model"},
}


def test_cases(spark, terms, ids):
    values = spark.createDataFrame([(f, v) for f, c in CASES.items() for v in c], "field_name string, value string")
    got = {(r.field_name, r.value): r.term_id for r in C.match(values, terms).collect()}
    wrong = {(f, v): got[f, v] for f, c in CASES.items() for v, t in c.items() if got[f, v] != (ids[t] if t else 0)}
    assert not wrong


def test_one_typo_in_a_long_name_changes_nothing(spark, terms):
    rng = random.Random(3)
    rows = []
    for r in terms.collect():
        if len(r.term) >= 12 and not any(ch.isdigit() for ch in r.term):
            i = rng.randrange(1, len(r.term) - 2)
            rows += [(r.field_name, r.term[:i] + r.term[i + 1] + r.term[i] + r.term[i + 2 :], r.term_id), (r.field_name, r.term[:i] + r.term[i] * 2 + r.term[i + 1 :], r.term_id)]
    df = spark.createDataFrame(rows, "field_name string, value string, expected long")
    got = C.match(df.select("field_name", "value").distinct(), terms).join(df, ["field_name", "value"])
    assert got.where("term_id <> expected").count() == 0


def test_names_in_brackets_next_to_sure_matches_are_learned(spark, terms, ids):
    texts = ["Lion (evolved sign momentum)", "lion optimizer (evolved sign momentum)", "LION (Evolved Sign Momentum)*", "evolved sign momentum", "Adam (x y)", "Lamb (x y)", "x y"]
    values = spark.createDataFrame([("optimizer", v) for v in texts], "field_name string, value string")
    got = {r.value: r.term_id for r in C.match(values, terms).collect()}
    assert got["evolved sign momentum"] == ids["Lion"] and got["x y"] == 0


def test_names_of_the_caller_are_added(spark, terms, ids):
    values = spark.createDataFrame([("license", "Expat licence"), ("license", "closed source")], "field_name string, value string")
    assert {r.term_id for r in C.match(values, terms).collect()} == {0}
    more = spark.createDataFrame([("license", ids["MIT License"], "Expat License")], "field_name string, term_id long, alias string")
    assert {r.value: r.term_id for r in C.match(values, terms, more=more).collect()} == {"Expat licence": ids["MIT License"], "closed source": 0}


def test_no_alias_in_the_code(small):
    import inspect

    import duckdb

    code = inspect.getsource(C).lower()
    stated = [r[0] for f in CASES for r in duckdb.sql(f"SELECT DISTINCT lower(trim({f})) FROM '{small}/llm_properties.parquet' WHERE length(trim({f})) > 9").fetchall()]
    assert not [v for v in stated if f'"{v}"' in code]


def test_nulls_repeats_clashes_and_empty(spark, terms, ids):
    rows = [(1, "MIT", "x", 1.0)] * 2 + [(2, None, "x", 1.0), (3, "n/a", "x", 1.0), (4, "MIT License", "x", 1.0), (5, "y" * 20_000, "x", 1.0), (None, "mit", "x", 1.0), (6, "***", "x", 1.0)]
    df = spark.createDataFrame(rows, "prop_id long, license string, gram string, score double")
    got = {(r.prop_id, r.value[:5], r.term_id) for r in C.map_fields(df, terms, "prop_id", ["license"]).collect()}
    assert got == {(1, "MIT", ids["MIT License"]), (5, "yyyyy", 0), (None, "mit", ids["MIT License"])}
    assert C.map_fields(df.limit(0), terms, "prop_id", ["license"]).count() == 0
    assert {r.term_id for r in C.map_fields(df, terms.limit(0), "prop_id", ["license"]).collect()} == {0}
