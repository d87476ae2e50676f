"""Records of models: selection of primary ones, merging of variants, duplicates of chunks.

All group operators take records with paper_id and an order (chunk_no, pos, record_id); "first" is first in that order. They
aggregate with map-side partial results and join small group states back, so a paper that holds a tenth of all rows never has to
fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions import names as N
from recordloom.missing import is_missing_m2, is_missing_m3, trim_all

# Fields that a record must fill to pass the quality gate, and how many.
GATE_FIELDS = ["model_name", "model_family", "organization", "innovation", "parameters", "pretraining_architecture", "pretraining_task", "pretraining_corpus", "license", "research_problem", "application"]
RICH_FIELDS = ["model_name", "model_family", "organization", "innovation", "pretraining_task", "pretraining_architecture", "parameters", "license"]
MERGED_FIELDS = ["model_family", "date_created", "organization", "innovation", "pretraining_architecture", "pretraining_task", "pretraining_corpus", "finetuning_task", "optimizer", "hardware_used", "extension", "blog_post", "license", "research_problem", "application", "paper_title"]
#: All fields of a record as extracted: the merged ones, its name, version and size.
RECORD_FIELDS = ["model_name", "model_version", "parameters", "parameters_millions", *MERGED_FIELDS]
LONGEST_FIELDS = ["innovation", "extension", "pretraining_corpus", "application", "research_problem"]
# Words of parts and by-products in names; those with a space or hyphen count as whole words only.
AUXILIARY = ("adapter", "chat", "classifier", "component", "context", "detector", "embedding", "encoder", "expert", "evaluator", "filter", "framework", "guard", "instruct", "module", "parser", "pipeline", "prompt guard", "resampler", "reward model", "safety", "system-level", "tokenizer", "tool")
# Words of baselines in names; the first six weigh in the score.
BASELINE = ("baseline", "ablation", "lstm", "rnn", "gru", "auxiliary", "aux", "comparison", "baseline model")
TITLE_WORDS = ("gpt", "bert", "llama", "t5", "bart", "transformer", "roberta", "albert")

ORDER = ("chunk_no", "pos", "record_id")


def order() -> Column:
    return F.struct(*ORDER)


def n_filled(fields: list[str]) -> Column:
    out = F.lit(0)
    for f in fields:
        out = out + (~is_missing_m2(F.col(f))).cast("int")
    return out


def passes_gate() -> Column:
    """A name of three characters or more and three filled fields or more."""
    return (F.length(trim_all(F.coalesce("model_name", F.lit("")))) >= 3) & (n_filled(GATE_FIELDS) >= 3)


def low(c: str) -> Column:
    return F.lower(trim_all(F.coalesce(F.col(c), F.lit(""))))


def is_auxiliary() -> Column:
    text = F.concat(low("model_name"), F.lit(" "), low("model_family"))
    single = "|".join(w for w in AUXILIARY if " " not in w and "-" not in w)
    whole = "|".join(w for w in AUXILIARY if " " in w or "-" in w)
    return text.rlike(single) | text.rlike(rf"\b({whole})\b")


def release_signal() -> Column:
    """A version or size in the name, a size in the parameters, or a stated version."""
    both = F.concat(low("model_name"), F.lit(" "), low("parameters"))
    return low("model_name").rlike(r"\b(v?\d+(?:\.\d+)?)\b") | both.rlike(r"\b\d+(?:\.\d+)?\s*[mbt]\b") | (low("model_version") != "")


def dominant_families(records: DataFrame) -> DataFrame:
    """(paper_id, dominant): the most frequent family of each paper if it occurs twice or more; the first seen wins a tie."""
    by = records.withColumn("family", low("model_family")).where("family != ''").groupBy("paper_id", "family").agg(F.count("*").alias("n"), F.min(order()).alias("first"))
    top = by.groupBy("paper_id").agg(F.min(F.struct((-F.col("n")).alias("neg"), "first", "family")).alias("top"))
    return top.select("paper_id", F.when(F.col("top.neg") <= -2, F.col("top.family")).alias("dominant"))


def with_primary(records: DataFrame) -> DataFrame:
    """Adds is_primary: no part or by-product, of the paper's dominant family, and released or well described."""
    r = records.join(dominant_families(records), "paper_id", "left")
    mismatch = F.col("dominant").isNotNull() & (low("model_family") != "") & (low("model_family") != F.col("dominant"))
    primary = (low("model_name") != "") & ~is_auxiliary() & ~mismatch & (release_signal() | (n_filled(RICH_FIELDS) >= 4))
    return r.withColumn("is_primary", F.coalesce(primary, F.lit(False))).drop("dominant")


def select_primary(records: DataFrame) -> DataFrame:
    """Primary records of each paper; all of its records where it has one only or no primary one."""
    r = with_primary(records)
    per = r.groupBy("paper_id").agg(F.count("*").alias("n"), F.max("is_primary").alias("any_primary"))
    return r.join(per, "paper_id").where(F.col("is_primary") | (F.col("n") <= 1) | ~F.col("any_primary")).drop("n", "any_primary")


def merge_keys(records: DataFrame) -> DataFrame:
    """Records that pass the gate with canonical (the release they belong to) and merged_into (after bare families are absorbed).

    A group named like its family alone joins the largest group of that family which has a version, of equal ones the first seen.
    """
    r = records.where(passes_gate()).withColumn("model_name", N.spaced(F.col("model_name")))
    r = r.withColumn("canonical", N.canonical_name(F.col("model_name"))).withColumn("paper_id", F.coalesce("paper_id", F.lit("")))
    groups = r.groupBy("paper_id", "canonical").agg(F.count("*").alias("n"), F.min(order()).alias("first"))
    family = F.lower(F.regexp_extract("canonical", r"^([A-Za-z][\w-]*)", 1))
    groups = groups.withColumn("family", family).withColumn("version", N.version_token(F.col("canonical")))
    targets = groups.where(F.col("version").isNotNull()).groupBy("paper_id", "family").agg(F.min(F.struct((-F.col("n")).alias("neg"), "first", "canonical"))["canonical"].alias("target"))
    bare = groups.where(F.col("version").isNull() & (F.col("family") != "") & (F.lower(F.trim("canonical")) == F.col("family")))
    absorbed = bare.join(targets, ["paper_id", "family"]).select("paper_id", "canonical", "target")
    return r.join(absorbed, ["paper_id", "canonical"], "left").withColumn("merged_into", F.coalesce("target", "canonical")).drop("target")


def merge_field(f: str) -> Column:
    """Value of a field over a group: the longest (first of equal ones), all links, or the first, of those not missing."""
    ok = ~is_missing_m3(F.col(f))
    if f in LONGEST_FIELDS:
        return F.min_by(f, F.when(ok, F.struct((-F.length(f)).alias("neg"), order().alias("o")))).alias(f)
    if f == "blog_post":
        links = F.flatten(F.collect_set(F.when(ok, F.transform(F.split(f, ","), trim_all))))
        return F.nullif(F.array_join(F.array_sort(F.array_distinct(F.filter(links, lambda x: x != ""))), ", "), F.lit("")).alias(f)
    return F.min_by(f, F.when(ok, order())).alias(f)


def merge_variants(records: DataFrame, fields: list[str] = MERGED_FIELDS) -> DataFrame:
    """One record for each release of a paper: sizes listed in ascending order, the largest in millions, other fields merged."""
    size = N.normalize_size(F.col("parameters"))
    sizes = F.collect_set(size)
    ordered = F.array_join(F.transform(F.array_sort(F.transform(sizes, lambda s: F.struct(N.size_key(s).alias("k"), s.alias("s")))), lambda x: x["s"]), ", ")
    return merge_keys(records).groupBy("paper_id", F.col("merged_into").alias("model_name")).agg(
        F.count("*").alias("n_variants"), F.nullif(ordered, F.lit("")).alias("parameters"), F.max("parameters_millions").alias("parameters_millions"), *map(merge_field, fields)
    )


def specificity() -> Column:
    """How well a name tells its release apart: 0 to 8."""
    n, fam = low("model_name"), low("model_family")
    has = (fam != "") & n.contains(fam)
    dashed = (fam != "") & n.contains(F.concat(fam, F.lit("-")))
    after = F.substring(F.call_function("substring_index", n, F.concat(fam, F.lit("-")), F.lit(-1)), 1, 4)
    digit = n.rlike(r"\d")
    return has.cast("int") * 2 + (dashed & after.rlike(r"\d")).cast("int") * 3 + n.rlike(r"\d+(?:\.\d+)?(?:\s|$)").cast("int") * 2 + (digit & n.rlike("[mbk]")).cast("int")


def chunk_keys(records: DataFrame) -> DataFrame:
    """Records that pass the gate with the key under which those of a paper's chunks are one: family, version and size, or the name.

    The size counts only where the record also states it in millions, as the rule that this follows has it.
    """
    fam, params = (trim_all(F.coalesce(c, F.lit(""))) for c in ("model_family", "parameters"))
    name = N.spaced(trim_all(F.col("model_name")))
    version = F.coalesce(N.version_token(name), F.lit(""))
    m = F.col("parameters_millions")
    size = F.when(m.isNotNull(), F.when(params != "", params).otherwise(m.cast("string"))).otherwise("")
    by_version, by_family = (fam != "") & (version != ""), (fam != "") & ((params != "") | m.isNotNull())
    k1 = F.when(by_version | by_family, fam).otherwise(name)
    k2 = F.when(by_version, version).when(by_family, "").otherwise(F.coalesce("model_version", F.lit("")))
    k3 = F.when(by_version | by_family, size).otherwise(F.coalesce("parameters", F.lit("")))
    return records.where(passes_gate()).withColumns({"k1": k1, "k2": k2, "k3": k3})


def dedup_chunks(records: DataFrame, fields: list[str]) -> DataFrame:
    """One record for each key of a paper: the most specific name, the first of equal ones; its missing fields filled from the others in that order."""
    rank = F.struct((-specificity()).alias("neg"), order().alias("o"))
    keyed = chunk_keys(records).withColumn("rank", rank)
    gap = lambda f: F.col(f).isNull() | F.lower(trim_all(F.col(f).cast("string"))).isin("", "null", "none")
    pick = [F.coalesce(F.min_by(f, F.when(~gap(f), F.col("rank"))), F.max_by(f, F.when(F.col(f).isNotNull(), F.col("rank")))).alias(f) for f in fields]
    return keyed.groupBy("paper_id", "k1", "k2", "k3").agg(F.count("*").alias("n"), F.min_by("record_id", "rank").alias("record_id"), F.min_by("model_name", "rank").alias("model_name"), *pick).drop("k1", "k2", "k3")


def baseline_score(title: Column) -> Column:
    """How likely a record is the main contribution of the paper with this title."""
    name, fam = low("model_name"), low("model_family")
    some = lambda c: F.coalesce(F.col(c) != "", F.lit(False)).cast("int")
    m = F.col("parameters_millions")
    sized = F.coalesce(F.col("parameters") != "", F.lit(False)) | F.coalesce(m != 0, F.lit(False))
    tier = F.when(m >= 1_000, 3).when(m >= 100, 2).when(m >= 10, 1).otherwise(0)
    in_title = F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit(rf"\b({'|'.join(TITLE_WORDS)})\b"), F.lit(1))
    meets = lambda c: F.exists(in_title, lambda w: F.contains(c, w)).cast("int")
    return (
        F.when(name.rlike("|".join(BASELINE[:6])), -10.0).otherwise(0.0) + F.when(sized, 2 + tier).otherwise(0) + (fam != "").cast("int") * meets(fam) * 3 + meets(name) * 2
        + some("innovation") + 0.5 * (some("pretraining_architecture") + some("pretraining_task") + some("optimizer")) + some("organization")
        + ((F.coalesce(F.col("model_family"), F.lit("")) != "") & (name != "") & (name != F.lower(F.coalesce("model_family", F.lit(""))))).cast("int")
    )


def is_baseline(fields: list[str]) -> Column:
    """A baseline by its name, or a record with fewer than five filled fields."""
    n = F.lit(0)
    for f in fields:
        n = n + F.coalesce(trim_all(F.col(f).cast("string")) != "", F.lit(False)).cast("int")
    return low("model_name").rlike("|".join(BASELINE)) | (n < 5)
