import itertools
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import packing as P


def optimum(sizes, capacity):
    best = len(sizes)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity and bins[k] not in bins[:k]:
                go(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_bound_is_below_and_packing_above_the_optimum(sizes):
    a = np.array(sorted(sizes, reverse=True))
    bins = P.best_fit(a, 20)
    assert np.bincount(bins, weights=a).max() <= 20
    assert P.lower_bound(a, 20) <= optimum(a.tolist(), 20) <= bins.max() + 1


def test_bound_sees_more_than_the_sum():
    assert P.lower_bound(np.array([6, 6, 6]), 10) == 3 and P.lower_bound(np.array([], np.int64), 10) == 0


@pytest.mark.parametrize("group_items", [50, 10_000])
def test_round_trip(spark, group_items):
    rng = random.Random(1)
    sizes = [(i, rng.choice([0, 1, rng.randrange(1, 400), rng.randrange(300, 3_000), 1_000, 2_000])) for i in range(800)]
    windows = spark.createDataFrame([("a", 1_000), ("b", 4_000), ("none", None), ("zero", 0)], "window_name string, capacity_tokens long")
    out, certificates = P.pack(spark.createDataFrame(sizes, "doc_id long, n_tokens long"), windows, group_items)
    got = out.toPandas()
    for name, capacity in (("a", 1_000), ("b", 4_000)):
        w = got[got.window_name == name]
        assert w.groupby("bin_id").n_tokens.sum().max() <= capacity
        for i, n in sizes:
            pieces = w[w.doc_id == i].sort_values("piece_no")
            assert pieces.n_tokens.sum() == n and len(pieces) == -(-n // capacity)
            assert pieces.start_token.tolist() == list(itertools.accumulate([0, *pieces.n_tokens.tolist()[:-1]]))[: len(pieces)]
        if group_items == 10_000:
            assert w.bin_id.nunique() <= 1.02 * sum(n for _, n in sizes) / capacity + 1
    assert set(got.window_name) == {"a", "b"}
    assert (certificates.toPandas().gap >= 0).all()


def test_empty_and_nulls(spark):
    w = spark.createDataFrame([("a", 10)], "window_name string, capacity_tokens long")
    none = spark.createDataFrame([], "doc_id long, n_tokens long")
    assert P.pack(none, w)[0].count() == 0 and P.pack(none, w.limit(0))[0].count() == 0
    d = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "word " * 50_000, "x"), (4, "日本語 नमस्ते <|endoftext|>", "x"), (4, "日本語 नमस्ते <|endoftext|>", "x")], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r.n_tokens for r in P.token_counts(d).collect()}
    assert set(got) == {2, 3, 4} and got[2] == 0 and got[3] >= 50_000 and got[4] > 4


def test_worse_repacking_is_not_taken():
    pdf = pd.DataFrame({"window_name": "a", "capacity": 10, "doc_id": range(6), "piece": 0, "n_tokens": [4, 4, 3, 3, 3, 3], "grp": 0, "bin": [0, 1, 0, 0, 1, 1], "target": 0})
    assert P._pack(pdf, 1).bins.iloc[0] == 2
