import random

import pytest

from recordloom.llm import leakage as L

SENTENCES = [
    "A lab called {n} owns 32 schedulers and lends 7 of them to {m} for slot filling.", "Every scheduler sold before 2018 must be returned to {n}, unless the data steward signs for it.", "Readers of the 2014 log know that {n} traded token merging for knowledge distillation.",
    "The contract between {n} and {m} forbids code completion but allows sparse attention.", "Suppose early exiting costs 2 hours per sampling loop and {n} has only 74 hours left.", "We trained {n} on 294.2 billion tokens, and gradient clipping replaces the trend.",
]


def name(rng):
    return "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(5)).capitalize()


@pytest.fixture(scope="module")
def items():
    rng = random.Random(5)
    return [(i, " ".join(s.format(n=name(rng), m=name(rng)) for s in rng.sample(SENTENCES, 5))) for i in range(1, 31)]


def other(rng, k):
    return " ".join(rng.choice(SENTENCES).format(n=name(rng), m=name(rng)) for _ in range(k))


def parts(text):
    return text.split(". ")


def test_found_and_not_found(spark, items):
    rng, docs, expected = random.Random(6), [], set()

    def add(text, *ids):
        docs.append((len(docs) + 1, text, "clash"))
        expected.update((len(docs), i) for i in ids)

    text = dict(items)
    add(other(rng, 10))
    add(f"{other(rng, 3)} {text[1]} {other(rng, 3)}", 1)
    add(text[2].upper(), 2)
    add("\n".join(f"• {s}" for s in parts(text[3])), 3)
    add(text[4].replace(",", "").replace("fi", "ﬁ").replace(" the ", "  the "), 4)
    add(f"{other(rng, 2)} {'. '.join(parts(text[5])[:3])}. {other(rng, 2)}", 5)
    add(f"{parts(text[6])[0]}. {parts(text[6])[1]}. {other(rng, 6)} {'. '.join(parts(text[6])[2:])}", 6)
    add(f"{other(rng, 4)} {parts(text[7])[2]}. {other(rng, 4)}")
    add(text[8].replace("hours", "weeks").replace("owns", "has").replace("allows", "permits"), 8)
    add(text[9].replace(" t", "-\nt", 3).replace("-\nt", " t-\n", 1), 9)
    add(" ".join(s.format(n=name(rng), m=name(rng)) for s in SENTENCES))
    add(f"{text[10]} {text[11]}", 10, 11)
    docs += [(100, None, "c"), (101, "", "c"), (102, "x " * 200_000, "c"), docs[1]]
    d = spark.createDataFrame(docs, "doc_id long, text string, share string")
    i = spark.createDataFrame([(k, t) for k, t in items] + [(90, None), (91, ""), (92, "short"), items[0]], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in L.leaks(d, i).collect()} == expected


def test_filter_does_not_matter(spark, items, monkeypatch):
    d = spark.createDataFrame([(k, t) for k, t in items], "doc_id long, text string")
    i = d.withColumnRenamed("doc_id", "item_id")
    whole = {tuple(r) for r in L.leaks(d, i).collect()}
    monkeypatch.setattr(L, "MAX_KEYS", 0)
    assert {tuple(r) for r in L.leaks(d, i).collect()} == whole and len(whole) == 30


def test_reparameterised_questions(spark, items):
    """The same sentences with each name and number replaced throughout are found, those with mixed replacements are not."""
    text, rng = dict(items), random.Random(9)
    names = {w.strip(".,") for w in text[1].split() if w[0].isupper() and len(w.strip(".,")) == 10}
    new = {n: name(rng) for n in names}
    swapped = " ".join(new.get(w.strip(".,"), w.strip(".,")) + w[len(w.strip(".,")) :] for w in text[1].split())
    numbers = swapped.replace("32", "61").replace("74", "55").replace("2018", "2011").replace("2014", "2009").replace("294.2", "310.7")
    repeated = f"{text[2]} Again, {' '.join(w for w in text[2].split())}"
    once = next(w.strip(".,") for w in text[2].split() if w[0].isupper() and len(w.strip(".,")) == 10)
    half = repeated.replace(once, "Zudofemika", 1).replace(once, "Balirotuve")
    docs = [(1, f"{other(rng, 2)} {numbers} {other(rng, 2)}"), (2, text[1]), (3, half), (4, other(rng, 6)), (5, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.share for r in L.leaks(d, i, renamed=True).collect()}  # the items share sentences, so others are met too
    assert got[1, 1] > 0.99 and (2, 1) not in got and (3, 2) not in got
    assert {(r.doc_id, r.item_id) for r in L.leaks(d, i).collect()} == {(2, 1), (3, 2)}
    assert L.leaks(d.limit(0), i, renamed=True).count() == 0 and L.leaks(d, i.limit(0), renamed=True).count() == 0


def test_window_hashes_and_shares_against_brute_force():
    """Hashes are equal exactly where windows are, and the best pair of passages is the best of all pairs."""
    import numpy as np

    rng = random.Random(2)
    typed = L.Typed(frozenset("abcdefgh"))
    v = L.template(typed(" ".join(rng.choice("abcxy123") for _ in range(400))))
    h = L.window_hashes(v, 4)
    for i in range(0, len(h), 7):
        for j in range(len(h)):
            assert (h[i] == h[j]) == bool((v[i : i + 4] == v[j : j + 4]).all())
    assert len(L.window_hashes(v[:3], 4)) == 0 and not np.isin(v, [0]).any()


def test_empty(spark, items):
    i = spark.createDataFrame(items, "item_id long, text string")
    d = i.withColumnRenamed("item_id", "doc_id")
    assert L.leaks(d.limit(0), i).count() == 0 and L.leaks(d, i.limit(0)).count() == 0


def test_candidates_against_brute_force(spark, small):
    """Every document with half of the distinctive names of an item, found by plain search, is found by the operator as well."""
    import re

    import pandas as pd

    d, e = pd.read_parquet(f"{small}/documents.parquet"), pd.read_parquet(f"{small}/eval_items.parquet")
    pattern = re.compile(r"\b(?:[bcdfghjklmnprstvz][aeiou]){5}\b")
    holders = {r.item_id: set(pattern.findall(r.text.lower())) for r in e.itertuples()}
    got = {(r.doc_id, r.item_id) for r in L.leaks(spark.createDataFrame(d[["doc_id", "text"]]), spark.createDataFrame(e[["item_id", "text"]])).collect()}
    for r in d.itertuples():
        seen = set(pattern.findall(r.text.lower()))
        for i, n in holders.items():
            if len(n) >= 4 and len(n & seen) >= 0.7 * len(n):
                assert (r.doc_id, i) in got
