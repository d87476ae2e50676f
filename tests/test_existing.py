"""A model exists only if its name, and version and size where given, stand in a label."""

from pyspark.sql import functions as F

from recordloom.plans import evaluation as P


def test_other_versions_and_sizes_do_not_exist(spark):
    rows = [(1, "Foo 2 7B", "foo", "2", "7B"), (2, "Foo 2 7B", "Foo", "3", "7B"), (3, "Foo 2 7B", "Foo", "2", "70B"), (4, "Foo 2 7B", "foo", None, ""), (5, "Foo 2 7B", "Foobar", None, None)]
    df = spark.createDataFrame(rows, "id int, label string, name string, version string, size string")
    assert {r.id for r in df.where(P.in_label(*map(F.col, ("label", "name", "version", "size")))).collect()} == {1, 4}


def test_query_needs_name_version_and_size(spark, tmp_path):
    rows = [(1, P.TRUSTED, "Foo", "2", "7B"), (2, "x", "foo", "2", "7B"), (3, "x", "Foo", "2", "70B"), (4, "x", "Foo", "3", None), (5, "x", "foo", None, ""), (6, "x", None, None, None)]
    df = spark.createDataFrame([(i, "p", *r) for i, *r in rows], "record_id long, paper_id string, extractor string, model_name string, model_version string, parameters string")
    df.withColumn("ingested_at", F.current_timestamp()).write.parquet(f"{tmp_path}/extracted.parquet")
    assert {r.record_id for r in P.jn13_existing_names(spark, str(tmp_path)).collect()} == {2, 5}


def test_papers_without_an_id_are_found_by_their_title(spark):
    p = spark.createDataFrame([("a", "2401.1", "the_first_title"), ("b", None, "another_quite_long_title_of_a_"), ("c", "9999.9", ""), ("d", None, "no_such")], "paper_id string, pre string, head string")
    f = spark.createDataFrame([("2401.1_x.json", "2401.1"), ("Another quite long-title of a paper!.pdf", None), ("the first title.pdf", None)], "file_name string, pre string")
    by_id = p.join(f, "pre").select("paper_id", "file_name", F.lit("id").alias("found_by"))
    assert {tuple(r) for r in P.found_files(p, f, by_id).collect()} == {("a", "2401.1_x.json", "id"), ("b", "Another quite long-title of a paper!.pdf", "title")}
