"""Training instances from reference records and text, and splits that never part a paper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.text import chunked, squash
from recordloom.missing import trim_all
from recordloom.operators.evaluate import FIELDS

# Fields whose value must stand in the text; words that carry no weight in the others.
NAMED = ("parameters_millions", "parameters", "date_created", "model_name", "model_family", "organization", "optimizer", "hardware_used", "license", "pretraining_architecture", "blog_post")
STOP = ("the", "a", "an", "of", "and", "in", "for", "to", "is", "are", "was", "were", "with", "on", "by", "that", "this", "it", "as")


def stands_in(field: str, value: Column, text: Column) -> Column:
    """Whether a value is plausibly mentioned in squashed text: any part of a name, or two fifths of the weighty words of a text."""
    v = F.lower(trim_all(value.cast("string")))
    if field in NAMED:
        parts = F.split(F.replace(v, F.lit(","), F.lit(" ")), r"(?U)\s+")
        found = F.exists(parts, lambda w: (F.length(w) >= 2) & F.contains(text, w)) | text.contains(v)
    else:
        words = F.filter(F.split(v, r"(?U)\s+"), lambda w: (F.length(w) > 2) & ~w.isin(*STOP))
        found = (F.size(words) > 0) & (F.size(F.filter(words, lambda w: F.contains(text, w))) * 10 >= F.size(words) * 4)
    return F.coalesce((v != "") & found, F.lit(False))


def instances(golds: DataFrame, documents: DataFrame, size: int = 8_000, overlap: int = 500, least: int = 2) -> DataFrame:
    """(gold_id, doc_id, chunk_no, n_filled, target): each chunk of a paper with each of its reference records that it mentions.

    target is JSON of all fields, those that the chunk does not mention empty. Pairs with fewer than `least` fields are left out.
    """
    d = documents.where(F.col("text").isNotNull() & F.col("paper_id").isNotNull()).select("paper_id", "doc_id", "text")
    chunks = chunked(d, "text", size, overlap).select("paper_id", "doc_id", "chunk_no", squash(F.col("chunk")).alias("chunk"))
    x = golds.select("gold_id", "paper_id", *FIELDS).join(chunks, "paper_id")
    hits = {f: stands_in(f, F.col(f), F.col("chunk")) for f in FIELDS}
    x = x.withColumn("hits", F.array(*[F.when(h, F.lit(f)) for f, h in hits.items()]))
    target = F.to_json(F.struct(*[F.coalesce(F.when(F.array_contains("hits", f), F.col(f).cast("string")), F.lit("")).alias(f) for f in FIELDS]))
    n = F.size(F.array_compact("hits"))
    return x.select("gold_id", "doc_id", "chunk_no", n.alias("n_filled"), target.alias("target")).where(F.col("n_filled") >= least)


def rank_by_hash(titles: DataFrame, column: str, digits: int = 3) -> DataFrame:
    """(column, n, rk): distinct values ranked from 1 by their hash, without sorting all of them in one task.

    Values fall into 16 ** digits buckets by the head of their hash; the ranks within a bucket are shifted by the sizes of the
    buckets before, of which there are few.
    """
    t = titles.select(column).where(F.col(column).isNotNull()).distinct().withColumn("h", F.md5(column)).withColumn("bucket", F.substring("h", 1, digits))
    sizes = t.groupBy("bucket").agg(F.count("*").alias("c"))
    before = sizes.select("bucket", F.coalesce(F.sum("c").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.sum("c").over(Window.partitionBy()).alias("n"))
    inside = t.withColumn("r", F.row_number().over(Window.partitionBy("bucket").orderBy("h", column)))
    return inside.join(before, "bucket").select(column, "n", (F.col("base") + F.col("r")).alias("rk"))


def split_titles(titles: DataFrame, column: str = "paper_title", test: float = 0.15, val: float = 0.1) -> DataFrame:
    """(column, split): test, val or train for each title; each of the first two gets one title at least."""
    r = rank_by_hash(titles, column)
    n_test, n_val = (F.greatest(F.lit(1), F.floor(F.col("n") * s)) for s in (test, val))
    return r.select(column, F.when(F.col("rk") <= n_test, "test").when(F.col("rk") <= n_test + n_val, "val").otherwise("train").alias("split"))
