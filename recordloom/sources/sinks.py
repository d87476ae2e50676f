"""Sinks: results partitioned by paper or model, tables in three forms, training splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.text import slug


def write_results(records: DataFrame, path: str) -> None:
    """Records as JSON, one folder for each paper; slashes in ids become underscores."""
    safe = records.withColumn("paper", F.regexp_replace(F.coalesce("paper_id", F.lit("none")), "/", "_"))
    safe.repartition("paper", F.pmod(F.xxhash64(*[F.col(c) for c in records.columns if dict(records.dtypes)[c] in ("bigint", "string", "int")]), F.lit(8))).write.mode("overwrite").partitionBy("paper").json(path)


def newest_by_model(files: DataFrame, path: str) -> None:
    """Files into one folder for each model, of several of one name the newest."""
    w = Window.partitionBy("model", "file_name").orderBy(F.col("written_at").desc(), F.col("file_id"))
    files.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn").withColumn("model_slug", slug(F.col("model"))).write.mode("overwrite").partitionBy("model_slug").json(path)


def write_table(table: DataFrame, path: str, form: str = "csv", order: list[str] | None = None) -> None:
    """A small result table as csv, json or markdown in one file; markdown lines are put together by columns, not collected."""
    t = table.orderBy(*order) if order else table
    if form == "csv":
        t.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    elif form == "json":
        t.coalesce(1).write.mode("overwrite").json(path)
    elif form == "markdown":
        cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in t.columns]
        head = t.sparkSession.createDataFrame([("| " + " | ".join(t.columns) + " |",), ("|" + "---|" * len(t.columns),)], "line string").coalesce(1)
        body = t.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
        head.unionByName(body.coalesce(1)).coalesce(1).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown form {form}")


def write_splits(instances: DataFrame, splits: DataFrame, path: str, title: str = "_paper_title") -> None:
    """Training instances as JSON lines, one folder for each split; columns that begin with an underscore are left out."""
    kept = [c for c in instances.columns if not c.startswith("_")]
    joined = instances.join(splits.withColumnRenamed(splits.columns[0], title), title)
    joined.select("split", *kept).write.mode("overwrite").partitionBy("split").json(path)


def write_reports(evaluations: DataFrame, path: str) -> None:
    """Evaluation reports as JSON, one object a run, in a folder for each extractor; reports of extractors written anew replace the old."""
    whole = evaluations.withColumn("by", F.col("extractor"))
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("by").json(path)
