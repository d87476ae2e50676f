"""Evaluation of extracted records against reference records: field comparators of three profiles, pairing, metrics."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import names as N
from recordloom.missing import is_missing_m3, trim_all
from recordloom.session import cut

# Fields that are evaluated, and groups of them.
FIELDS = ["model_name", "model_family", "date_created", "organization", "innovation", "pretraining_architecture", "pretraining_task", "pretraining_corpus", "finetuning_task", "optimizer", "parameters", "parameters_millions", "hardware_used", "extension", "blog_post", "license", "research_problem", "application"]
STRUCTURED = ["model_name", "model_family", "date_created", "organization", "pretraining_architecture", "pretraining_task", "finetuning_task", "optimizer", "parameters", "parameters_millions", "hardware_used", "blog_post", "license"]
FUZZY = ["innovation", "pretraining_corpus", "application", "research_problem"]
OVERLAP = ["innovation", "extension", "application", "research_problem", "pretraining_corpus"]
SHORT = ["pretraining_architecture", "pretraining_task", "finetuning_task", "optimizer"]
#: Fields whose strict match needs no similarity of texts.
EXACT = ["date_created", "organization", "pretraining_architecture", "pretraining_task", "finetuning_task", "optimizer", "parameters", "parameters_millions", "hardware_used", "extension", "blog_post", "license"]
ORGANISATION_PAIRS = (("google ai language", "google"), ("google research", "google"), ("meta ai", "meta"), ("facebook ai", "meta"), ("openai", "openai"), ("microsoft research", "microsoft"))


def long_pairs(pairs: DataFrame, keys: list[str], fields: list[str] = FIELDS) -> DataFrame:
    """(keys, field, gold, pred): one row for each field of each pair; pairs has structs g and p."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"g.{f}").cast("string").alias("gold"), F.col(f"p.{f}").cast("string").alias("pred")) for f in fields])
    return pairs.select(*keys, F.explode(each).alias("x")).select(*keys, "x.field", "x.gold", "x.pred")


def norm4(c: Column) -> Column:
    return F.lower(trim_all(F.coalesce(c, F.lit(""))))


def _year_month(c: Column) -> tuple[Column, Column]:
    s = trim_all(c)
    full, lone = s.rlike(r"^\d{4}-\d{2}(-\d{2})?$"), s.rlike(r"^\d{4}$")
    return F.when(full | lone, F.substring(s, 1, 4).cast("int")), F.when(full, F.substring(s, 6, 2).cast("int"))


def strict_match() -> Column:
    """Whether gold and pred of a field match strictly; NULL where the similarity of their texts decides (see ratio)."""
    g, p, f = norm4(F.col("gold")), norm4(F.col("pred")), F.col("field")
    none, one = (g == "") & (p == ""), (g == "") | (p == "")
    (gy, gm), (py, pm) = _year_month(F.col("gold")), _year_month(F.col("pred"))
    date = F.when(gy.isNull() & py.isNull(), True).when(gy.isNull() | py.isNull() | (gy != py), False).when(gm.isNotNull() & pm.isNotNull(), gm == pm).otherwise(True)
    held = g.contains(p) | p.contains(g)
    alias = F.lit(False)
    for a, b in ORGANISATION_PAIRS:
        alias = alias | (g.isin(a, b) & p.isin(a, b))
    org = F.when(none, True).when(one, False).otherwise(held | alias)
    words = lambda c: F.filter(F.split(c, r"(?U)[\s,]+"), lambda w: w != "")
    # words(g) of a text of commas only is empty
    optimizer = F.when(none, True).when(one, False).when((F.size(words(g)) == 0) & (F.size(words(p)) == 0), True).otherwise(F.arrays_overlap(words(g), words(p)))
    whole = lambda c: trim_all(c).try_cast("double").cast("bigint")
    gi, pi = whole(F.col("gold")), whole(F.col("pred"))
    millions = F.when(gi.isNull() & pi.isNull(), True).when(gi.isNull() | pi.isNull(), False).otherwise(gi == pi)
    raw_none = (F.coalesce(F.col("gold"), F.lit("")) == "") & (F.coalesce(F.col("pred"), F.lit("")) == "")
    raw_one = (F.coalesce(F.col("gold"), F.lit("")) == "") | (F.coalesce(F.col("pred"), F.lit("")) == "")
    sizes = lambda c: F.array_distinct(F.filter(F.transform(F.split(c, ","), lambda x: F.upper(trim_all(x))), lambda x: x != ""))
    gs, ps = sizes(F.col("gold")), sizes(F.col("pred"))
    parameters = F.when(raw_none, True).when(raw_one, False).when((F.size(gs) == 0) & (F.size(ps) == 0), True).when((F.size(gs) == 0) | (F.size(ps) == 0), False).otherwise(F.size(F.array_intersect(gs, ps)) == F.size(gs))
    gn, pn = N.soft(F.coalesce(F.col("gold"), F.lit(""))), N.soft(F.coalesce(F.col("pred"), F.lit("")))
    identifier = F.when((gn == "") & (pn == ""), True).when((gn == "") | (pn == ""), False).when(gn.contains(pn) | pn.contains(gn), True)
    generic = F.when(g == p, True).when(f.isin(*FUZZY) & (g != "") & (p != ""), F.lit(None)).otherwise(False)
    return (
        F.when(f == "parameters", parameters).when(f == "parameters_millions", millions).when(f == "date_created", date).when(f == "organization", org)
        .when(f == "optimizer", optimizer).when(f.isin("model_name", "model_family"), identifier).otherwise(generic)
    )


def strict_similarity() -> Column:
    """The similarity that goes with strict_match; NULL where that of the texts counts (see ratio)."""
    g, p, f = norm4(F.col("gold")), norm4(F.col("pred")), F.col("field")
    none, one = (g == "") & (p == ""), (g == "") | (p == "")
    said = F.when(none, 1.0).when(one, 0.0)
    (gy, gm), (py, pm) = _year_month(F.col("gold")), _year_month(F.col("pred"))
    date = F.when(gy.isNull() & py.isNull(), 1.0).when(gy.isNull() | py.isNull() | (gy != py), 0.0).when(gm.isNotNull() & pm.isNotNull(), F.when(gm == pm, 1.0).otherwise(0.5)).otherwise(0.9)
    org = said.when(g == p, 1.0).when(strict_match(), 0.95)
    gn, pn = N.soft(F.coalesce(F.col("gold"), F.lit(""))), N.soft(F.coalesce(F.col("pred"), F.lit("")))
    identifier = F.when((gn == "") & (pn == ""), 1.0).when((gn == "") | (pn == ""), 0.0).when(gn == pn, 1.0).when(gn.contains(pn) | pn.contains(gn), 0.95)
    sizes = lambda c: F.array_distinct(F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), ","), lambda x: F.upper(trim_all(x))), lambda x: x != ""))
    both = F.size(F.array_intersect(sizes("gold"), sizes("pred"))).cast("double")
    n_g, n_p = F.size(sizes("gold")), F.size(sizes("pred"))
    rate = F.try_divide(both, n_p), F.try_divide(both, n_g)
    f1 = F.coalesce(F.try_divide(2 * rate[0] * rate[1], rate[0] + rate[1]), F.lit(0.0))
    blank = [F.coalesce(F.col(c), F.lit("")) == "" for c in ("gold", "pred")]
    parameters = F.when(blank[0] & blank[1], 1.0).when(blank[0] | blank[1], 0.0).when((n_g == 0) & (n_p == 0), 1.0).when((n_g == 0) | (n_p == 0), 0.0).otherwise(f1)
    generic = F.when(g == p, 1.0).when(f.isin(*FUZZY) & (g != "") & (p != ""), F.lit(None)).otherwise(0.0)
    return (
        F.when(f == "parameters", parameters).when(f.isin("parameters_millions", "optimizer"), F.when(strict_match(), 1.0).otherwise(0.0)).when(f == "date_created", date)
        .when(f == "organization", org).when(f.isin("model_name", "model_family"), identifier).otherwise(generic)
    )


def finetune_match() -> Column:
    """The lenient match: equal, one within the other, sizes within a tenth, or half of the reference's words."""
    g, p, f = (F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))) if i < 2 else c for i, c in enumerate((F.col("gold"), F.col("pred"), F.col("field"))))
    gd, pd_ = g.try_cast("double"), p.try_cast("double")
    near = F.coalesce(F.abs(gd - pd_) / F.greatest(gd, F.lit(1.0)) < 0.1, F.lit(False))
    gw, pw = F.array_distinct(F.split(g, " ")), F.array_distinct(F.split(p, " "))
    half = F.size(F.array_intersect(gw, pw)) / F.size(gw) >= 0.5
    return F.when((g == "") & (p == ""), True).when((g == "") | (p == ""), False).when(g.contains(p) | p.contains(g), True).when(f == "parameters_millions", near).when(f.isin(*OVERLAP), half).otherwise(False)


def relaxed_match() -> Column:
    """The relaxed match; NULL where the similarity of the texts decides (see decide with relaxed_threshold)."""
    m5 = lambda c: F.when(c.isNull() | (F.lower(trim_all(c)).isin("null", "none", "n/a")), "").otherwise(F.lower(trim_all(c)))
    g, p, f = m5(F.col("gold")), m5(F.col("pred")), F.col("field")
    (gy, gm), (py, pm) = _year_month(F.col("gold")), _year_month(F.col("pred"))
    ok = lambda m: F.when(m.between(1, 12), m)
    gm, pm = ok(gm), ok(pm)
    both = (g != "") & (p != "")
    date = F.when(both & gy.isNotNull() & py.isNotNull() & (gy == py), F.when(gm.isNull() | pm.isNull() | (gm == pm), True).otherwise(False))
    gn, pn = N.without_size(F.col("gold")), N.without_size(F.col("pred"))
    name = F.when(both & (gn != "") & (pn != "") & (gn.contains(pn) | pn.contains(gn)), True)
    short = F.when(both & (g.contains(p) | p.contains(g)), True)
    first = F.when(f == "date_created", date).when(f == "model_name", name)
    then = F.when(g == p, True).when(f.isin(*SHORT), F.coalesce(short, F.when(both, F.lit(None)).otherwise(False))).when(f.isin(*FUZZY) & both, F.lit(None)).otherwise(False)
    return F.coalesce(first, then)


def relaxed_threshold() -> Column:
    """The least similarity of a relaxed match: lower for long texts."""
    return F.when(F.col("field").isin(*FUZZY), 0.65).otherwise(0.8)


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two texts by their longest matching blocks, 0 to 1; 1 for two empty ones, 0 for one."""
    seen: dict = {}

    def one(x: str, y: str) -> float:
        if (x, y) not in seen:
            seen[x, y] = 1.0 if not x and not y else 0.0 if not x or not y else SequenceMatcher(None, x, y).ratio()
        return seen[x, y]

    return pd.Series([one(x or "", y or "") for x, y in zip(a, b)])


def decide(results: DataFrame, match: Column, threshold: float | Column = 0.8, similarity: Column | None = None) -> DataFrame:
    """Adds match and similarity; only rows that the rules leave open reach Python.

    similarity: what the rules say of it, NULL where that of the texts counts; without it only undecided matches get one.
    """
    # written once: the rules are long, and both sides below ask for them
    r = cut(results.withColumns({"match": match, "similarity": F.lit(None).cast("double") if similarity is None else similarity}))
    settled = r.where(F.col("match").isNotNull()) if similarity is None else r.where(F.col("similarity").isNotNull())
    open_ = r.where(F.col("match").isNull()) if similarity is None else r.where(F.col("similarity").isNull())
    soft = F.col("field").isin("model_name", "model_family")
    text = lambda c: F.when(soft, N.soft(F.col(c))).otherwise(norm4(F.col(c)))
    open_ = open_.withColumn("similarity", ratio(text("gold"), text("pred")))
    return settled.unionByName(open_.withColumn("match", F.coalesce("match", F.col("similarity") >= threshold)))


#: Fields whose match the score of their texts decides, and fields whose texts are scored for the report.
SCORED = ["innovation", "license", "pretraining_task", "research_problem", "pretraining_architecture"]
REPORTED = ["innovation", "pretraining_corpus", "application", "research_problem", "extension"]


def scored(results: DataFrame, scorer=None, threshold: float = 0.8) -> DataFrame:
    """Adds score to the SCORED and REPORTED fields where both texts are there, and lets it decide match and similarity of the former.

    Texts are scored once each, however many pairs hold them.
    """
    there = lambda c: F.coalesce(trim_all(F.col(c)), F.lit("")) != ""
    asked = F.col("field").isin(*SCORED, *REPORTED) & there("gold") & there("pred")
    texts = results.where(asked).select("gold", "pred").distinct()
    s = score_texts(texts, scorer).select(F.col("gold").alias("_g"), F.col("pred").alias("_p"), "score")
    r = results.withColumn("_asked", asked)
    with_score = r.join(s, F.col("_asked") & (F.col("gold") == F.col("_g")) & (F.col("pred") == F.col("_p")), "left").drop("_g", "_p", "_asked")
    decides = F.col("field").isin(*SCORED) & F.col("score").isNotNull()
    return with_score.withColumns({"match": F.when(decides, F.col("score") >= threshold).otherwise(F.col("match")), "similarity": F.when(decides, F.col("score")).otherwise(F.col("similarity"))})


def text_aggregate(results: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text_score): the mean over the REPORTED fields of each field's mean score; keys without a score are left out."""
    per = results.where(F.col("field").isin(*REPORTED) & F.col("score").isNotNull()).groupBy(*keys, "field").agg(F.avg("score").alias("mean"))
    return per.groupBy(*keys).agg(F.avg("mean").alias("text_score"))


def counts(results: DataFrame, keys: list[str], both_wrong: bool = False) -> DataFrame:
    """tp, fp, fn, tn over rows with gold, pred and match; with both_wrong a mismatch also counts as a miss. Of two texts whose match
    is NULL nothing is counted."""
    g, p, m = ~is_missing_m3(F.col("gold")), ~is_missing_m3(F.col("pred")), F.col("match")
    fn = (g & ~p) | (g & p & ~m) if both_wrong else g & ~p
    return results.groupBy(*keys).agg(F.count_if(g & p & m).alias("tp"), F.count_if((g & p & ~m) | (~g & p)).alias("fp"), F.count_if(fn).alias("fn"), F.count_if(~g & ~p).alias("tn"))


def scores(c: DataFrame, digits: int = 6) -> DataFrame:
    """accuracy, precision, recall and f1 of counts; 0 where nothing counts."""
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    over = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    p, r = over(tp, tp + fp), over(tp, tp + fn)
    return c.withColumns({"accuracy": F.round(over(tp + tn, tp + tn + fp + fn), digits), "precision": F.round(p, digits), "recall": F.round(r, digits), "f1": F.round(over(2 * p * r, p + r), digits)})


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, cut to 0 to 1; NULL if one is NULL or all zeros."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda i, j: i.cast("double") * j.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))))


# pairing ------------------------------------------------------------------------------------------------------------------


def held_in(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """(paper_id, outer, inner): texts of a paper that hold others, by joining all substrings of the lengths that the others have."""
    lengths = inner.select("paper_id", F.length("inner").alias("n")).where("n > 0").distinct()
    spots = outer.join(lengths, "paper_id").where(F.length("outer") >= F.col("n"))
    last = F.length("outer") - F.col("n") + 1
    parts = spots.select("paper_id", "outer", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(F.col("outer"), i, F.col("n"))))).alias("inner"))
    return parts.join(inner, ["paper_id", "inner"])


def pair_edges(golds: DataFrame, preds: DataFrame, profile: str = "strict") -> DataFrame:
    """(paper_id, pred_id, p_ord, gold_name, g_ord, gold_id, tier): who may be paired, by equality, soft equality or containment.

    golds: (paper_id, gold_id, name, g_ord), preds: (paper_id, pred_id, name, p_ord). Of golds of one name the last counts, in the
    place of the first. strict: equal, equal but for hyphens and spaces, or the reference name within the predicted one, alike
    soft; relaxed: equal or within; finetune: equal or either within the other, and of predictions of one name too the last
    counts in the place of the first. Containment is found by joining substrings with names, so nothing is paired all with all.
    Predictions of one name have the same candidates, so of each name only as many are kept as it has candidates.
    """
    name = (lambda c: F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " ")))) if profile == "finetune" else (lambda c: F.lower(trim_all(F.coalesce(c, F.lit("")))))
    form = N.soft if profile == "strict" else (lambda c: c)
    g = golds.withColumn("gold_name", name(F.col("name"))).groupBy("paper_id", "gold_name").agg(F.max_by("gold_id", "g_ord").alias("gold_id"), F.min("g_ord").alias("g_ord")).withColumn("inner", form(F.col("gold_name"))).where("gold_name != ''")
    p = preds.withColumn("pred_name", name(F.col("name")))
    if profile == "finetune":
        p = p.groupBy("paper_id", "pred_name").agg(F.max_by("pred_id", "p_ord").alias("pred_id"), F.min("p_ord").alias("p_ord"))
    kinds = p.select("paper_id", "pred_name").distinct().withColumn("outer", form(F.col("pred_name")))
    spelled = held_in(kinds.select("paper_id", "outer").distinct(), g.select("paper_id", "inner").distinct())
    if profile == "finetune":
        back = held_in(g.select("paper_id", F.col("inner").alias("outer")).distinct(), kinds.select("paper_id", F.col("outer").alias("inner")).where("inner != ''").distinct())
        spelled = spelled.unionByName(back.select("paper_id", F.col("inner").alias("outer"), F.col("outer").alias("inner"))).distinct()
    held = spelled.join(kinds, ["paper_id", "outer"]).join(g, ["paper_id", "inner"])
    tier = F.when(F.col("pred_name") == F.col("gold_name"), 1).when((F.col("outer") == F.col("inner")) & F.lit(profile == "strict"), 2).otherwise(3)
    kind_edges = held.select("paper_id", "pred_name", "gold_name", "g_ord", "gold_id", tier.alias("tier"))
    many = kind_edges.groupBy("paper_id", "pred_name").agg(F.count("*").alias("candidates"))
    w = Window.partitionBy("paper_id", "pred_name").orderBy("p_ord")
    few = p.join(many, ["paper_id", "pred_name"]).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= F.col("candidates"))
    return few.select("paper_id", "pred_name", "pred_id", "p_ord").join(kind_edges, ["paper_id", "pred_name"]).drop("pred_name")


#: Candidate edges of one paper that are walked in one task; papers with more are first settled in parallel rounds.
WALKED = 10_000


def _settled(edges: DataFrame) -> DataFrame:
    """Pairs that no walk could change: the prediction's best candidate, for which it is the first of all that have it."""
    best = edges.groupBy("paper_id", "pred_id").agg(F.min(F.struct("tier", "g_ord", "gold_name", "gold_id", "p_ord")).alias("b"))
    first = edges.groupBy("paper_id", "gold_name").agg(F.min(F.struct("p_ord", "pred_id")).alias("f"))
    return best.select("paper_id", "pred_id", "b.gold_name", "b.gold_id", "b.tier").join(first, ["paper_id", "gold_name"]).where("pred_id = f.pred_id").drop("f")


def pair_greedily(edges: DataFrame, walked: int | None = None) -> DataFrame:
    """(paper_id, pred_id, gold_id, tier): predictions in order take their best reference record that is still free.

    The walk in order is sequential, so it is kept for papers with few open edges. Of the others, rounds of two groupings settle
    every prediction that is the first to want its best candidate, and take both away; keys are predictions and names, so a paper
    with a tenth of the rows is spread over all tasks. The result is that of the walk, whatever the number of rounds.
    """
    walked = WALKED if walked is None else walked
    edges, done = cut(edges), None
    while True:
        most = edges.groupBy("paper_id").count().agg(F.max("count")).head()[0] or 0
        if most <= walked:
            break
        pairs = cut(_settled(edges))
        done = pairs if done is None else done.unionByName(pairs)
        edges = cut(edges.join(pairs.select("paper_id", "pred_id"), ["paper_id", "pred_id"], "left_anti").join(pairs.select("paper_id", "gold_name"), ["paper_id", "gold_name"], "left_anti"))
    rest = _walk(edges)
    return rest if done is None else rest.unionByName(done.select("paper_id", "pred_id", "gold_id", "tier"))


def _walk(edges: DataFrame) -> DataFrame:
    e = F.struct("p_ord", "tier", "g_ord", "pred_id", "gold_id", "gold_name")
    kind = {n: t for n, t in edges.dtypes}
    zero = F.struct(
        F.array().cast("array<string>").alias("used"), F.lit(None).cast(kind["pred_id"]).alias("last"), F.array().cast(f"array<struct<pred_id:{kind['pred_id']},gold_id:{kind['gold_id']},tier:int>>").alias("out")
    )

    def step(a: Column, x: Column) -> Column:
        free = ~F.array_contains(a["used"], x["gold_name"]) & ~a["last"].eqNullSafe(x["pred_id"])
        taken = F.struct(F.concat(a["used"], F.array(x["gold_name"])).alias("used"), x["pred_id"].alias("last"), F.concat(a["out"], F.array(F.struct(x["pred_id"].alias("pred_id"), x["gold_id"].alias("gold_id"), x["tier"].alias("tier")))).alias("out"))
        return F.when(free, taken).otherwise(a)

    per = edges.groupBy("paper_id").agg(F.array_sort(F.collect_list(e)).alias("es"))
    return per.select("paper_id", F.inline(F.aggregate("es", zero, step, lambda a: a["out"])))


def score_texts(pairs: DataFrame, scorer=None) -> DataFrame:
    """Adds score to (gold, pred) by a pluggable scorer of two lists of texts; without one by ratio."""
    if scorer is None:
        return pairs.withColumn("score", ratio(norm4(F.col("gold")), norm4(F.col("pred"))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(score=scorer(pdf.gold.tolist(), pdf.pred.tolist()))

    return pairs.mapInPandas(run, ", ".join(f"`{n}` {t}" for n, t in pairs.dtypes) + ", score double")
