import datetime as dt

from recordloom.llm import representatives as R

SCHEMA = "record_id long, paper_id string, extractor string, model_name string, parameters string, parameters_millions long, model_family string, model_version string, extracted_at timestamp, ingested_at timestamp, rank int, stem string, says int"
T0 = dt.datetime(2024, 1, 1)


def frame(spark, *rows):
    return spark.createDataFrame([(i, p, e, n, s, m, f, v, T0 + dt.timedelta(hours=h) if h is not None else None, T0, 1, "clash", 1) for i, (p, e, n, s, m, f, v, h) in enumerate(rows, 1)], SCHEMA)


def extractors(spark):
    return spark.createDataFrame([("best", 1), ("good", 2)], "extractor string, trust_rank int")


def found(spark, df):
    return {(r.group_id, r.group_size, r.field_name, r.record_id) for r in R.survivors(df, extractors(spark)).collect()}


def test_spellings_of_one_model_meet_and_siblings_stay_apart(spark):
    df = frame(
        spark,
        ("p", "good", "Vobuvarofu 2.1 7B Chat", "N/A", None, "Vobuvarofu", "2.1", 1), ("p", "best", "VOBUVARFU-2.1 (7B) Chat", "7B", 7000, None, None, 2), ("p", "good", "Chat vobuvarofu_v2.1", "7 Mrd. Parameter", None, "Vobuvarofu", None, 3),
        ("p", "good", "Vobuvarofu 2 7B Chat", "7B", None, "Vobuvarofu", None, 4), ("p", "good", "Vobuvarofu 2.1 7B", "7B", None, "Vobuvarofu", None, 5), ("p", "good", "Vobuvarofu 2.1 13B Chat", "13B", None, "Vobuvarofu", None, 6), ("q", "good", "Vobuvarofu 2.1 7B Chat", "7B", None, "Vobuvarofu", "2.1", 7),
    )
    got = found(spark, df)
    assert {x for x in got if x[1] > 1} == {(1, 3, "model_name", 2), (1, 3, "parameters", 2)}
    assert {x[0] for x in got} == {1, 4, 5, 6, 7}


def test_ranking_by_what_is_said_then_trust_then_time_then_id(spark):
    same = ("p", "good", "Abcdefgh 7B", "7B", None, "Abcdefgh", None)
    assert found(spark, frame(spark, (*same, 1), (*same, 3), (*same, 3))) == {(1, 3, "model_name", 2), (1, 3, "parameters", 2)}
    assert (1, 2, "model_name", 1) in found(spark, frame(spark, ("p", "best", *same[2:], 1), (*same, 3)))
    assert (1, 2, "model_name", 1) in found(spark, frame(spark, (*same, 1), ("p", "best", "Abcdefgh", "7B", None, "Abcdefgh", None, 3)))


def test_nulls_repeats_and_empty(spark):
    rows = [(None, None, None, None, None, None, None, None), ("p", None, "Abcdefgh 7B", None, None, None, None, None), ("p", "odd", None, "7B", None, "Abcdefgh", None, None), ("p", "good", "", "large", None, "", "", 1)]
    df = frame(spark, *rows)
    assert found(spark, df.union(df)) == found(spark, df) == {(2, 2, "model_name", 2), (2, 2, "parameters", 3)}
    assert found(spark, df.limit(0)) == set()


def test_every_record_is_in_one_group(spark, small):
    x = spark.read.parquet(f"{small}/extracted.parquet")
    k = R.model_keys(x)
    assert k.count() == x.select("record_id").distinct().count()
    assert k.where("family = '' or size is null").count() == 0
