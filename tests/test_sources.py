import json

from pyspark.sql import functions as F

from recordloom.operators import dataset, infer
from recordloom.plans.documents import props
from recordloom.sources import config, files, sinks, store
from recordloom.streaming import files as streaming


def test_result_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"arxiv_id": "1", "extraction_data": [], "raw_extraction": [{"model_name": "A", "parameters_millions": "340.0"}, {"model_name": "B", "parameters_millions": ""}]}, indent=1))
    (tmp_path / "b_summary.json").write_text("{}")
    (tmp_path / "c.json").write_text("not json")
    got = files.read_result_files(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r.file_name, r.model_name, r.parameters_millions) for r in got] == [("a.json", "A", 340), ("a.json", "B", None)]


def test_sheet(spark, tmp_path):
    (tmp_path / "g.csv").write_text('﻿"Title","model name","number of parameters","maximum number of parameters (in million)"\n"A Long Paper Title - Contribution 1","M1","""7B""","110-340"\n"obtained by x","","",""\n"short","M2","",""\n"Another Fine\nPaper Title Here","M3","1B","7B"\n', encoding="utf-8")
    got = files.read_sheet(spark, str(tmp_path / "g.csv")).orderBy("model_name").collect()
    assert [(r.paper_title.replace("\n", " "), r.model_name, r.parameters, r.parameters_millions) for r in got] == [("A Long Paper Title", "M1", "7B", 340), ("Another Fine Paper Title Here", "M3", "1B", 7)]


def test_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"model_name": "A"}\n\n  \n{"model_name": "B"}\n')
    assert sorted(r.model_name for r in files.read_lines(spark, str(tmp_path / "x.jsonl"), files.RECORD).collect()) == ["A", "B"]


def test_fetch_list_and_parse(spark, tmp_path):
    def fetch(url):
        if "bad" in url:
            raise OSError("gone")
        return b"%PDF " + url.encode()

    p = spark.createDataFrame([("1", "https://x/a b.pdf"), ("2", "https://x/bad.pdf"), ("3", "ftp://x"), ("4", None)], "paper_id string, pdf_url string")
    status = lambda **k: {r.paper_id: r.status for r in files.fetch_papers(p, str(tmp_path), fetch, **k).collect()}
    assert status() == {"1": "fetched", "2": "failed", "3": "failed", "4": "failed"}
    assert status()["1"] == "skipped" and status(force=True)["1"] == "fetched"
    assert [r.file_name for r in files.list_papers(spark, str(tmp_path)).collect()] == ["a_b.pdf"]
    raw = spark.read.format("binaryFile").load(str(tmp_path / "*.pdf"))
    short, long = (lambda d: ("short", [[[None, ""]], [["a", None]]])), (lambda d: ("x" * 200, [[["b"]]]))
    assert files.parse_papers(raw, short).first().tables == [[["a", None]]]
    assert len(files.parse_papers(raw, short, long).first().text) == 200


def test_settings(tmp_path):
    (tmp_path / "s.json").write_text('{"chunk_size": 9000, "store_url": "file", "unknown": 1}')
    s = config.load_settings(str(tmp_path / "s.json"), env={"RECORDLOOM_STORE_URL": "env"}, call_attempts=3, chunk_overlap=None)
    assert (s.chunk_size, s.store_url, s.call_attempts, s.chunk_overlap) == (9_000, "env", 3, 500)
    assert config.load_settings("/nowhere", env={}) == config.Settings()


def test_store_and_upload(spark, small):
    from recordloom.operators import mapping

    r = props(spark, small).limit(40)
    s = mapping.statements(r)
    p = store.payloads(s, r.select("prop_id", mapping.label().alias("label")))
    titles = r.select("paper_id", F.col("paper_id").alias("title")).distinct()
    assert {x.status for x in store.upload(p, titles, store.MemoryStore).collect()} == {"created"}
    m = store.MemoryStore()
    key = m.create_paper("T", [{"label": "A", "statements": {"P1": [1]}}])
    assert m.append(key, {"label": "A", "statements": {"P2": [2]}}) == f"{key}-C1" and m.create_paper(" t ", []) == key
    m.update(f"{key}-C1", {"P2": [3]})
    assert m.papers[key]["contributions"][f"{key}-C1"]["statements"] == {"P1": [1], "P2": [3]}
    assert [(x.paper, x.label) for x in store.read_contributions(spark, m, "R").collect()] == [("T", "A")]


def test_store_reads_changes_and_versions(spark):
    def connect():
        m = store.MemoryStore([{"id": "P1", "label": "name"}, {"id": "P2"}])
        a = m.create_paper("A First Paper", [{"label": "x", "statements": {}}, {"label": "y", "statements": {}}])
        m.papers[a]["facts"] = {"url": "u", "doi": "d", "identifiers": {"arxiv": "2401.1"}}
        b = m.create_paper("Other work", [{"label": "z", "statements": {}}])
        m.papers[b]["title"] = "A First Paper"  # two papers of one title: the last counts
        m.create_paper("Third", [])
        return m

    m = connect()
    assert [tuple(r) for r in store.read_template(spark, m, "T").collect()] == [(0, "P1", "name"), (1, "P2", None)]
    c = store.read_contributions(spark, m, "R")
    assert [r.paper_id for r in c.orderBy("pos").collect()] == ["R1", "R1", "R2"]
    assert [tuple(r) for r in store.fetch_papers(c, connect).collect()] == [("A First Paper", None, None, None)]
    assert m.publish("R", ["R1-C1", "R1-C1"], "t") == 1 and m.publish("R", ["R2-C1"], "t") == 2 and [x["id"] for x in m.contributions("R")] == ["R2-C1"]
    asked = spark.createDataFrame([("third ",), ("paper of mine",), ("nothing",), (None,)], "title string")
    assert {(r.title, r.paper_id, r.match) for r in store.search_titles(asked, connect).collect()} == {("third ", "R3", "exact"), ("paper of mine", "R1", "fuzzy"), ("nothing", None, None)}
    rows = spark.createDataFrame([("R1", "x", '{"a": 1}'), ("R9", "x", "{}"), ("R1", "x", "no")], "key string, label string, statements string")
    assert sorted(r.status for r in store.change(rows, connect).collect()) == ["done", "failed", "failed"]
    rows = spark.createDataFrame([("R1-C1", None, '{"a": 1}'), ("R1-C9", None, "{}")], "key string, label string, statements string")
    assert {r.key: r.status for r in store.change(rows, connect, "update").collect()} == {"R1-C1": "done", "R1-C9": "failed"}
    assert store.status(m) == {"reachable": True} and store.status(None)["reachable"] is False


def test_payloads_of_a_hot_paper_come_in_parts(spark):
    st = spark.createDataFrame([("p", i, "q", 0, None, f"v{i}", None) for i in range(1_000)] + [("r", 2_000, "q", 0, None, "v", None)], "paper_id string, prop_id long, property string, ord int, reference string, value string, data_type string")
    got = store.payloads(st, st.select("prop_id", F.concat(F.lit("L"), "prop_id").alias("label")), part=100).collect()
    sizes = {(r.paper_id, r.part): len(json.loads(r.payload)) for r in got}
    assert sum(sizes.values()) == 1_001 and sizes["r", 0] == 1 and len(sizes) == 11 and max(sizes.values()) < 160


def test_local_client_cuts_and_falls_back():
    from recordloom.operators import infer

    seen = []

    def model(prompt, temperature):
        seen.append(len(prompt))
        if len(prompt) > 30:
            raise MemoryError
        return f"{len(prompt)} {temperature}"

    assert infer.local_client(model, limit=100)("x" * 300) == "25 0.1" and seen == [100, 50, 25]
    assert infer.local_client(lambda p, t: model(p * 99, t), limit=100, fallback=lambda p, t: "fb")("x" * 300) == "fb"
    assert infer.with_retries(infer.local_client(lambda p, t: model(p * 99, t)), attempts=2, delay=0, sleep=lambda s: None)("x" * 300) is None


def test_sinks_round_trip(spark, small, tmp_path):
    r = props(spark, small).select("prop_id", "paper_id", "model_name")
    sinks.write_results(r, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == r.count()
    t = spark.createDataFrame([("a", 1.5), ("b", None)], "name string, f1 double")
    for form in ("csv", "json", "markdown"):
        sinks.write_table(t, str(tmp_path / form), form, ["name"])
    assert [x.value for x in spark.read.text(str(tmp_path / "markdown")).collect()] == ["| name | f1 |", "|---|---|", "| a | 1.5 |", "| b |  |"]
    titles = spark.createDataFrame([(f"t{i}",) for i in range(40)], "paper_title string")
    splits = dataset.split_titles(titles)
    assert {x.split: x["count"] for x in splits.groupBy("split").count().collect()} == {"test": 6, "val": 4, "train": 30}
    sinks.write_splits(titles.select(F.col("paper_title").alias("_paper_title"), F.lit("i").alias("input")), splits, str(tmp_path / "s"))
    back = spark.read.json(str(tmp_path / "s"))
    assert back.count() == 40 and sorted(back.columns) == ["input", "split"]


def test_retries():
    waits, calls = [], []

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise OSError("rate limit" if len(calls) == 1 else "down")
        return "ok"

    assert infer.with_retries(flaky, delay=2, sleep=waits.append)("x") == "ok" and len(waits) == 2 and waits[0] >= 10 and 4 <= waits[1] <= 6
    assert infer.with_retries(lambda p: 1 / 0, attempts=2, sleep=waits.append)("x") is None


def test_pipeline_merges_what_chunks_say(spark):
    d = spark.createDataFrame([("p", 1, "We train Bertone-2B and Bertone-7B. " * 3), ("p", 2, None), ("q", 3, "")], "paper_id string, doc_id long, text string")
    (r,) = infer.pipeline(d).collect()
    assert (r.paper_id, r.model_name, r.parameters) == ("p", "Bertone", "2B, 7B")
    long = "We train Bertone-2B here. " + "It is a plain sentence. " * 60 + "Again Bertone-2B and Zolidan-9B."
    got = infer.pipeline(spark.createDataFrame([("p", 1, long)], "paper_id string, doc_id long, text string"), size=600, overlap=100).collect()
    assert {(r.model_name, r.parameters, r.n_variants) for r in got} == {("Bertone", "2B", 1), ("Zolidan", "9B", 1)}  # said by two chunks, one record


def test_stream_drops_repeats(spark, small, tmp_path):
    src = tmp_path / "in"
    spark.read.parquet(f"{small}/extraction_files.parquet").write.parquet(str(src))
    s = streaming.stream_records(streaming.stream_files(spark, str(src)))
    q = s.writeStream.format("memory").queryName("streamed").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    from recordloom.operators.answers import records
    from recordloom.plans.documents import files as batch

    assert spark.table("streamed").count() == records(batch(spark, small)).count()


def test_command_line(spark, small, tmp_path, capsys):
    from recordloom.__main__ import main

    assert main(["list"]) == 0 and "p3_found" in capsys.readouterr().out
    assert main(["run", "nothing", small]) == 2
    assert main(["run", "s16_models", small, "--out", str(tmp_path / "o"), "--format", "json"]) == 0
    assert spark.read.json(str(tmp_path / "o")).count() == 8


def test_commands_end_with_codes(spark, small, tmp_path, capsys):
    from recordloom.__main__ import main

    assert main(["list"]) == 0 and "a26_evaluation" in capsys.readouterr().out
    assert main(["status", small]) == 0 and main(["status", str(tmp_path)]) == 1
    assert main(["run", "no_query", small]) == 2
    assert main(["evaluate", small, "nobody"]) == 2
    assert main(["evaluate", small, "linnet-3b", "--out", str(tmp_path / "reports")]) in (0, 1)
    assert main(["run", "k1_result_names", small, "--out", str(tmp_path / "names"), "--format", "json"]) == 0
    assert spark.read.json(str(tmp_path / "reports")).where("extractor = 'linnet-3b'").count() == spark.read.json(str(tmp_path / "reports")).count() > 0
