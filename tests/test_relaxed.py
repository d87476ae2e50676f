"""The relaxed comparison of every field: nothing stays undecided."""

from difflib import SequenceMatcher

from recordloom.operators import evaluate as E
from recordloom.plans import metrics as P


def test_relaxed_decides_every_field(spark, small):
    df = P.c13_relaxed_all(spark, small)
    assert {r.field for r in df.select("field").distinct().collect()} <= set(E.FIELDS)
    assert df.where("match is null").count() == 0


def test_relaxed_thresholds(spark):
    a, b = "abcdefghij", "abcdefgxyz"  # 0.7: enough for a long text, too little for a short one
    assert SequenceMatcher(None, a, b).ratio() == 0.7
    rows = [(f, a, b) for f in E.FIELDS] + [("innovation", "abcdefxxxx", "abcdefyyyy"), ("optimizer", "abcdefghij", "abcdefghix"), ("optimizer", "Adam", "Adam optimizer"), ("application", "None", "n/a"), ("application", None, "x")]
    got = E.decide(spark.createDataFrame(rows, "field string, gold string, pred string"), E.relaxed_match(), E.relaxed_threshold()).collect()
    match = {(r.field, r.gold, r.pred): r.match for r in got}
    assert len(match) == len(rows)
    assert {f for f in E.FIELDS if match[f, a, b]} == set(E.FUZZY)
    assert [match[r] for r in rows[len(E.FIELDS) :]] == [False, True, True, True, False]
