"""Best representative of each duplicate group, chosen field by field.

Rows of a paper that describe the same model make a group: same family, version, named variant and size. For each field the
rows are ranked by whether their value is usable, how much it says, how far its source is trusted and how late it was read,
with the smaller id last, by a window over the group; the first one survives. Spark keeps only the first row of each group on
the map side before it shuffles for such a window (WindowGroupLimit), so a group that holds a third of all rows stays cheap.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.edits import canonical_stems
from recordloom.missing import is_missing
from recordloom.operators.quantities import LEAST, MOST, SCALES, parse, whole
from recordloom.session import cut

# Words of a model's name that name a variant of it.
VARIANTS = (
    "base", "chat", "instruct", "instruction", "coder", "code", "preview", "math", "vision", "vl", "audio", "it", "sft", "dpo", "rlhf", "thinking", "reasoning", "distill", "distilled",
    "mini", "small", "medium", "large", "xl", "xxl", "turbo", "lite", "pro", "ultra", "nano", "tiny", "plus", "beta", "alpha", "embed", "reward", "guard", "tool", "tools", "multilingual", "finetuned", "pretrained",
)
_SIZE = r"^\d+(\.\d+)?[kmbt]$"
_VERSION = r"^\d+(\.\d+)*$"


@F.pandas_udf(T.LongType())
def stated_size(text: pd.Series) -> pd.Series:
    """The number of parameters that a text states; NULL if it states none."""
    out = []
    for x in text:
        got = parse(x, "parameters") if isinstance(x, str) else None
        if got is None:
            out.append(None)
            continue
        value, scale, _ = got
        if scale is None:  # a bare number: the first scale that gives the size of a model
            inside = [value * s for s in SCALES if LEAST <= value * s <= MOST]
            out.append(whole(inside[0] if inside else value))
        else:
            out.append(whole(value * scale))
    return pd.Series(out, dtype="Int64")


def name_tokens(name: Column) -> Column:
    """Lower-case tokens of a model's name: separators, brackets and a change from letter to digit part them."""
    s = F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}.]+", " ")
    s = F.regexp_replace(s, r"(\p{L})(\d)", "$1 $2")
    s = F.regexp_replace(s, r"(?<!\d)\.|\.(?!\d)", " ")
    return F.filter(F.split(F.trim(s), r"\s+"), lambda t: (t != "") & ~t.isin("v", "ver", "version", "model", "the"))


def parsed(df: DataFrame) -> DataFrame:
    """Adds stem, version, variant and name_size to rows with model_name, model_family and model_version."""
    t = F.col("_tokens")
    names = F.array(*map(F.lit, VARIANTS))
    number = F.expr("cast(left(_size, length(_size) - 1) as decimal(20,6))")
    version = F.regexp_replace(F.get(F.filter(t, lambda x: x.rlike(_VERSION)), F.lit(0)), r"(\.0+)+$", "")
    told = F.when(~is_missing(F.col("model_version")), F.regexp_replace(F.regexp_replace(F.lower(F.trim("model_version")), r"^v(er(sion)?)?\.?\s*", ""), r"(\.0+)+$", ""))
    rest = F.filter(t, lambda x: ~x.rlike(_SIZE) & ~x.rlike(_VERSION) & ~F.array_contains(names, x))
    return (
        df.withColumn("_tokens", F.when(is_missing(F.col("model_name")), F.array().cast("array<string>")).otherwise(name_tokens(F.col("model_name"))))
        .withColumn("_size", F.coalesce(F.try_element_at(F.filter(t, lambda x: x.rlike(_SIZE)), F.lit(-1)), F.lit(None).cast("string")))
        .withColumn("name_size", (number * F.when(F.right("_size", F.lit(1)) == "k", 10**3).when(F.right("_size", F.lit(1)) == "m", 10**6).when(F.right("_size", F.lit(1)) == "b", 10**9).otherwise(10**12)).cast("bigint"))
        .withColumn("version", F.coalesce(version, told, F.lit("")))
        .withColumn("variant", F.array_join(F.array_sort(F.array_distinct(F.filter(t, lambda x: F.array_contains(names, x)))), " "))
        .withColumn("stem", F.array_join(rest, ""))
        .withColumn("family_stem", F.when(~is_missing(F.col("model_family")), F.array_join(F.filter(name_tokens(F.col("model_family")), lambda x: ~x.rlike(_VERSION)), "")))
        .withColumn("says", (F.col("name_size").isNotNull().cast("int") + (version.isNotNull()).cast("int") + (F.col("stem") != "").cast("int") + (F.col("variant") != "").cast("int")))
        .drop("_tokens", "_size")
    )


def model_keys(extracted: DataFrame) -> DataFrame:
    """One row for each record: record_id, its model key (paper_id, family, version, variant, size), the two values and what ranks them.

    Rows delivered twice count once. A typo in a name is mended against the best supported family within one edit in the same
    paper, families stated in model_family first. A row with neither a name nor a family, or without any size, describes a
    model of its own.
    """
    cols = ["record_id", "paper_id", "extractor", "model_name", "parameters", "parameters_millions", "model_family", "model_version", "extracted_at"]
    rows = parsed(extracted.select(*cols).distinct())
    rows = rows.withColumn("text_size", stated_size("parameters"))
    millions = F.when((F.col("parameters_millions") > 0) & (F.col("parameters_millions") <= MOST // 10**6), F.col("parameters_millions") * 10**6)
    rows = rows.withColumn("size", F.coalesce("name_size", "text_size", millions)).withColumn("paper_id", F.coalesce("paper_id", F.lit("")))
    rows = cut(rows.drop("parameters_millions", "model_family", "model_version"))  # the parsing is dear, and both uses below would repeat it
    seen = rows.select("paper_id", F.explode(F.array(F.struct(F.col("stem").alias("stem"), F.lit(False).alias("known")), F.struct(F.col("family_stem").alias("stem"), F.lit(True).alias("known")))).alias("x"))
    stems = seen.select("paper_id", "x.stem", "x.known").where(F.col("stem").isNotNull() & (F.col("stem") != "")).groupBy("paper_id", "stem").agg(F.max("known").alias("known"), F.count("*").alias("n"))
    canon = canonical_stems(stems, ["paper_id"], sure="known")
    mended = rows.withColumn("stem", F.when(F.col("stem") == "", F.col("family_stem")).otherwise(F.coalesce("family_stem", "stem"))).join(canon, ["paper_id", "stem"], "left")
    alone = F.col("canonical").isNull() | F.col("size").isNull()
    return mended.withColumn("family", F.coalesce("canonical", F.lit(""))).withColumn("alone", F.when(alone, F.col("record_id")).otherwise(F.lit(-1)))


KEY = ["paper_id", "family", "version", "variant", "size", "alone"]


def best_rows(rows: DataFrame, key: list[str], id_col: str, rank: list[Column]) -> DataFrame:
    """The first row of each group by rank, then by the smaller id: deterministic for ties and repeated rows."""
    w = Window.partitionBy(*key).orderBy(*rank, F.col(id_col).asc_nulls_last())
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def survivors(extracted: DataFrame, extractors: DataFrame) -> DataFrame:
    """(group_id, group_size, field_name, record_id, value): the surviving value of each field of each model.

    A value is usable if it is not missing and, for parameters, states a size. Of the usable rows wins the one whose value says
    most (for a name: states more of family, version, variant and size), then the better trusted source, then the latest, then
    the smaller id; a source without a trust rank comes last. A field without any usable value has no row.
    Empty input gives no row. A record of a single-row group survives as it is.
    """
    trust = extractors.groupBy("extractor").agg(F.min("trust_rank").alias("trust_rank"))
    keyed = model_keys(extracted).select(*KEY, "record_id", "extractor", "model_name", "parameters", "text_size", "says", "extracted_at")
    rows = cut(keyed.join(trust, "extractor", "left").withColumn("trust_rank", F.coalesce("trust_rank", F.lit(10**6))))  # read three times
    groups = rows.groupBy(*KEY).agg(F.min("record_id").alias("group_id"), F.count("*").alias("group_size"))
    picked = []
    for field, usable, says in (("model_name", ~is_missing(F.col("model_name")), F.col("says")), ("parameters", F.col("text_size").isNotNull(), F.lit(1))):
        values = rows.where(usable).select(*KEY, "record_id", "trust_rank", "extracted_at", F.col(field).alias("value"), says.alias("says"))
        best = best_rows(values, KEY, "record_id", [F.col("says").desc(), F.col("trust_rank").asc(), F.col("extracted_at").desc_nulls_last()])
        picked.append(best.select(*KEY, F.lit(field).alias("field_name"), "record_id", "value"))
    same = None
    for k in KEY:
        c = F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        same = c if same is None else same & c
    return groups.alias("a").join(picked[0].unionByName(picked[1]).alias("b"), same).select("group_id", "group_size", "field_name", "record_id", "value")
