"""Queries on the evaluation of extracted records: survey groups C, JN1 to JN3, JN11, JN12, A12 to A15, A19, A22, A24 to A26, R3 to R6, R8, G9.

The records of the most trusted extractor are the reference; every other extractor's records of a paper are one run, paired one to
one with the reference records of that paper. SQL states the pairing and all rules; what the similarity of texts decides is NULL
there and counted as open. The queries without SQL are the whole rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.operators import evaluate as E
from recordloom.plans import sqlx as S
from recordloom.plans.records import recs
from recordloom.plans.registry import Registry
from recordloom.session import cut, load

query = Registry()

# pairing ------------------------------------------------------------------------------------------------------------------

TRUSTED = "harrow-72b-instruct"


def _sides(spark, sf):
    """Records of the most trusted extractor as reference, all others as predictions, with their order in the paper."""
    r = recs(spark, sf).where(F.col("paper_id").isNotNull())
    o = F.struct("chunk_no", "pos", "record_id")
    ref = F.col("extractor") == TRUSTED
    golds = r.where(ref).select("paper_id", F.col("record_id").alias("gold_id"), F.col("model_name").alias("name"), o.alias("g_ord"))
    return golds, r.where(~ref).select("paper_id", F.col("record_id").alias("pred_id"), F.col("model_name").alias("name"), o.alias("p_ord"))


_ROW = "{'a': chunk_no, 'b': pos, 'c': record_id}"


def _pairs_sql(name: str, form: str, tier: str, within: str, preds: str) -> str:
    """The greedy pairing as a walk over the candidate edges of each paper, in the order of the predictions."""
    free = "NOT list_contains(w.used, e.gold_name) AND w.last IS DISTINCT FROM e.pred_id"
    return f"""WITH RECURSIVE {S.RECS}, base AS (SELECT *, {name} AS nm, {_ROW} AS o FROM recs WHERE paper_id IS NOT NULL AND extractor IS NOT NULL),
g AS (SELECT paper_id, nm, arg_max(record_id, o) AS gold_id, min(o) AS g_ord, {form} AS soft FROM base WHERE extractor = '{TRUSTED}' AND nm <> '' GROUP BY paper_id, nm), p AS ({preds}),
e0 AS (SELECT p.paper_id, p.pred_id, p.p_ord, g.gold_id, g.g_ord, g.nm AS gold_name, {tier} AS tier FROM p JOIN g ON p.paper_id = g.paper_id AND ({within})), e AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY p_ord, tier, g_ord) AS rn FROM e0),
w AS (SELECT paper_id, 0::BIGINT AS rn, []::VARCHAR[] AS used, NULL::BIGINT AS last, NULL::BIGINT AS pred_id, NULL::BIGINT AS gold_id, 0 AS tier FROM (SELECT DISTINCT paper_id FROM e)
  UNION ALL SELECT e.paper_id, e.rn, CASE WHEN {free} THEN list_append(w.used, e.gold_name) ELSE w.used END, CASE WHEN {free} THEN e.pred_id ELSE w.last END, CASE WHEN {free} THEN e.pred_id END, e.gold_id, e.tier FROM w JOIN e ON e.paper_id = w.paper_id AND e.rn = w.rn + 1)
SELECT paper_id, pred_id, gold_id, tier FROM w WHERE pred_id IS NOT NULL"""


_NM = f"lower({S.strip("coalesce(model_name, '')")})"
_EACH = f"SELECT paper_id, record_id AS pred_id, nm, o AS p_ord, {{form}} AS soft FROM base WHERE extractor <> '{TRUSTED}'"


@query(_pairs_sql(_NM, S.soft("nm"), "CASE WHEN p.nm = g.nm THEN 1 WHEN p.soft = g.soft THEN 2 ELSE 3 END", "contains(p.soft, g.soft)", _EACH.format(form=S.soft("nm"))))
def jn1_pairs(spark, sf):
    """Records of the other extractors paired one to one with those of the most trusted one, strictly (JN1, C4)."""
    return E.pair_greedily(E.pair_edges(*_sides(spark, sf)))


@query(_pairs_sql(_NM, "nm", "CASE WHEN p.nm = g.nm THEN 1 ELSE 3 END", "contains(p.nm, g.nm)", _EACH.format(form="nm")))
def jn2_relaxed_pairs(spark, sf):
    return E.pair_greedily(E.pair_edges(*_sides(spark, sf), profile="relaxed"))


_SQ = f"lower(trim(regexp_replace(coalesce(model_name, ''), '{S.WS}+', ' ', 'g')))"


@query(_pairs_sql(_SQ, "nm", "CASE WHEN p.nm = g.nm THEN 1 ELSE 3 END", "contains(p.nm, g.nm) OR (p.nm <> '' AND contains(g.nm, p.nm))", f"SELECT paper_id, arg_max(record_id, o) AS pred_id, nm, min(o) AS p_ord FROM base WHERE extractor <> '{TRUSTED}' GROUP BY paper_id, nm"))
def jn3_finetune_pairs(spark, sf):
    return E.pair_greedily(E.pair_edges(*_sides(spark, sf), profile="finetune"))


# pairs of each run --------------------------------------------------------------------------------------------------------

_SQ_EACH = "SELECT paper_id, extractor, arg_max(record_id, o) AS pred_id, nm, min(o) AS p_ord FROM base WHERE extractor <> '{t}' GROUP BY paper_id, extractor, nm"


def _runs_sql(profile: str = "strict") -> str:
    """CTEs up to pr: the pairs of every run, found by walking the candidate edges of the run in the order of its predictions."""
    nm, form, within, tier = {
        "strict": (_NM, S.soft("nm"), "contains(p.soft, g.soft)", "CASE WHEN p.nm = g.nm THEN 1 WHEN p.soft = g.soft THEN 2 ELSE 3 END"),
        "relaxed": (_NM, "nm", "contains(p.nm, g.nm)", "CASE WHEN p.nm = g.nm THEN 1 ELSE 3 END"),
        "finetune": (_SQ, "nm", "contains(p.nm, g.nm) OR (p.nm <> '' AND contains(g.nm, p.nm))", "CASE WHEN p.nm = g.nm THEN 1 ELSE 3 END"),
    }[profile]
    preds = _SQ_EACH.format(t=TRUSTED) if profile == "finetune" else f"SELECT paper_id, extractor, record_id AS pred_id, nm, o AS p_ord, {form} AS soft FROM base WHERE extractor <> '{TRUSTED}'"
    free = "NOT list_contains(w.used, e.gold_name) AND w.last IS DISTINCT FROM e.pred_id"
    return f"""RECURSIVE {S.RECS}, base AS (SELECT *, {nm} AS nm, {_ROW} AS o FROM recs WHERE paper_id IS NOT NULL AND extractor IS NOT NULL),
g AS (SELECT paper_id, nm, arg_max(record_id, o) AS gold_id, min(o) AS g_ord, {form} AS soft FROM base WHERE extractor = '{TRUSTED}' AND nm <> '' GROUP BY paper_id, nm), p AS ({preds}),
e0 AS (SELECT p.paper_id, p.extractor, p.pred_id, p.p_ord, g.gold_id, g.g_ord, g.nm AS gold_name, {tier} AS tier FROM p JOIN g ON p.paper_id = g.paper_id AND ({within})),
e AS (SELECT *, row_number() OVER (PARTITION BY paper_id, extractor ORDER BY p_ord, tier, g_ord) AS rn FROM e0),
w AS (SELECT paper_id, extractor, 0::BIGINT AS rn, []::VARCHAR[] AS used, NULL::BIGINT AS last, NULL::BIGINT AS pred_id, NULL::BIGINT AS gold_id FROM (SELECT DISTINCT paper_id, extractor FROM e)
  UNION ALL SELECT e.paper_id, e.extractor, e.rn, CASE WHEN {free} THEN list_append(w.used, e.gold_name) ELSE w.used END, CASE WHEN {free} THEN e.pred_id ELSE w.last END, CASE WHEN {free} THEN e.pred_id END, e.gold_id FROM w JOIN e ON e.paper_id = w.paper_id AND e.extractor = w.extractor AND e.rn = w.rn + 1),
pr AS (SELECT paper_id, extractor, pred_id, gold_id FROM w WHERE pred_id IS NOT NULL)"""


def _long_sql(profile: str = "strict") -> str:
    g = ", ".join(f"{{'field': '{f}', 'gold': CAST(g.{f} AS VARCHAR), 'pred': CAST(p.{f} AS VARCHAR)}}" for f in E.FIELDS)
    return f"""{_runs_sql(profile)}, long AS (SELECT paper_id, extractor, gold_id, pred_id, x.field AS field, x.gold AS gold, x.pred AS pred
  FROM (SELECT pr.*, unnest([{g}]) AS x FROM pr JOIN recs g ON g.record_id = pr.gold_id JOIN recs p ON p.record_id = pr.pred_id))"""


def run_pairs(spark: SparkSession, sf: str, profile: str = "strict", records: DataFrame | None = None) -> DataFrame:
    """(paper_id, extractor, gold_id, pred_id): the reference records of a paper paired one to one with the records of each run on it."""
    r = (recs(spark, sf) if records is None else records).where("paper_id is not null and extractor is not null")
    run, o = F.to_json(F.struct("paper_id", "extractor")), F.struct("chunk_no", "pos", "record_id")
    others = r.where(F.col("extractor") != TRUSTED)
    runs = others.select("paper_id", "extractor", run.alias("run")).distinct()
    golds = r.where(F.col("extractor") == TRUSTED).select("paper_id", "record_id", "model_name", o.alias("g_ord")).join(runs.select("paper_id", "run"), "paper_id")
    golds = golds.select(F.col("run").alias("paper_id"), F.col("record_id").alias("gold_id"), F.col("model_name").alias("name"), "g_ord")
    preds = others.select(run.alias("paper_id"), F.col("record_id").alias("pred_id"), F.col("model_name").alias("name"), o.alias("p_ord"))
    found = E.pair_greedily(E.pair_edges(cut(golds), cut(preds), profile)).withColumnRenamed("paper_id", "run")
    return found.join(runs, "run").select("paper_id", "extractor", "gold_id", "pred_id")


def run_results(spark: SparkSession, sf: str, profile: str = "strict") -> DataFrame:
    """(paper_id, extractor, gold_id, pred_id, field, gold, pred): one row for each field of each pair, worked out once."""
    # rows delivered twice are dropped once, not again for each of the five uses of the records
    r, keys = cut(recs(spark, sf).select("record_id", "paper_id", "extractor", "chunk_no", "pos", *E.FIELDS)), ["paper_id", "extractor", "gold_id", "pred_id"]
    side = lambda i, s: r.select(F.col("record_id").alias(i), F.struct(*E.FIELDS).alias(s))
    both = run_pairs(spark, sf, profile, r).join(side("gold_id", "g"), "gold_id").join(side("pred_id", "p"), "pred_id")
    return cut(E.long_pairs(both, keys))


def whole_results(spark: SparkSession, sf: str) -> DataFrame:
    """run_results with match, similarity and score by the whole strict rule: the rules, the similarity of texts, then the scores that override."""
    return E.scored(E.decide(run_results(spark, sf), E.strict_match(), similarity=E.strict_similarity()))


# comparators --------------------------------------------------------------------------------------------------------------

_G, _P = (f"lower({S.strip(f'''coalesce({c}, '')''')})" for c in ("gold", "pred"))
_YM = r"^\d{4}-\d{2}(-\d{2})?$"


def _y(c: str) -> str:
    return rf"CASE WHEN regexp_matches(trim({c}), '^\d{{4}}(-\d{{2}}){{0,2}}$') THEN CAST(substr(trim({c}), 1, 4) AS INT) END"


def _mo(c: str) -> str:
    return f"CASE WHEN regexp_matches(trim({c}), '{_YM}') THEN CAST(substr(trim({c}), 6, 2) AS INT) END"


_WORDS = lambda c: f"list_filter(string_split_regex({c}, '(?:{S.WS}|,)+'), lambda w: w <> '')"
_SZS = lambda c: f"list_distinct(list_filter(list_transform(string_split(coalesce({c}, ''), ','), lambda x: upper({S.strip('x')})), lambda x: x <> ''))"
_ORG = " OR ".join(f"({_G} IN ('{a}', '{b}') AND {_P} IN ('{a}', '{b}'))" for a, b in E.ORGANISATION_PAIRS)
_INT = lambda c: f"CAST(trunc(try_cast(trim({c}) AS DOUBLE)) AS BIGINT)"
_FUZZY = ", ".join(f"'{f}'" for f in E.FUZZY)
_SG, _SP = (S.soft(f"coalesce({c}, '')") for c in ("gold", "pred"))
_IN_ORG = f"(contains({_G}, {_P}) OR contains({_P}, {_G}) OR {_ORG})"
_STRICT = f"""CASE WHEN field = 'parameters' THEN CASE WHEN coalesce(gold, '') = '' AND coalesce(pred, '') = '' THEN true WHEN coalesce(gold, '') = '' OR coalesce(pred, '') = '' THEN false WHEN len({_SZS('gold')}) = 0 AND len({_SZS('pred')}) = 0 THEN true
    WHEN len({_SZS('gold')}) = 0 OR len({_SZS('pred')}) = 0 THEN false ELSE len(list_intersect({_SZS('gold')}, {_SZS('pred')})) = len({_SZS('gold')}) END
  WHEN field = 'parameters_millions' THEN CASE WHEN {_INT('gold')} IS NULL AND {_INT('pred')} IS NULL THEN true ELSE coalesce({_INT('gold')} = {_INT('pred')}, false) END
  WHEN field = 'date_created' THEN CASE WHEN {_y('gold')} IS NULL AND {_y('pred')} IS NULL THEN true WHEN coalesce({_y('gold')} <> {_y('pred')}, true) THEN false WHEN {_mo('gold')} IS NOT NULL AND {_mo('pred')} IS NOT NULL THEN {_mo('gold')} = {_mo('pred')} ELSE true END
  WHEN field = 'organization' THEN CASE WHEN {_G} = '' AND {_P} = '' THEN true WHEN {_G} = '' OR {_P} = '' THEN false ELSE {_IN_ORG} END
  WHEN field = 'optimizer' THEN CASE WHEN {_G} = '' AND {_P} = '' THEN true WHEN {_G} = '' OR {_P} = '' THEN false WHEN len({_WORDS(_G)}) = 0 AND len({_WORDS(_P)}) = 0 THEN true ELSE list_has_any({_WORDS(_G)}, {_WORDS(_P)}) END
  WHEN field IN ('model_name', 'model_family') THEN CASE WHEN {_SG} = '' AND {_SP} = '' THEN true WHEN {_SG} = '' OR {_SP} = '' THEN false WHEN contains({_SG}, {_SP}) OR contains({_SP}, {_SG}) THEN true END
  WHEN {_G} = {_P} THEN true WHEN field IN ({_FUZZY}) AND {_G} <> '' AND {_P} <> '' THEN NULL ELSE false END"""
_OVER = f"CAST(len(list_intersect({_SZS('gold')}, {_SZS('pred')})) AS DOUBLE)"
_SIMILAR = f"""CASE WHEN field = 'parameters' THEN CASE WHEN coalesce(gold, '') = '' AND coalesce(pred, '') = '' THEN 1.0 WHEN coalesce(gold, '') = '' OR coalesce(pred, '') = '' THEN 0.0 WHEN len({_SZS('gold')}) = 0 AND len({_SZS('pred')}) = 0 THEN 1.0
    WHEN len({_SZS('gold')}) = 0 OR len({_SZS('pred')}) = 0 OR {_OVER} = 0 THEN 0.0 ELSE 2 * {_OVER} / (len({_SZS('gold')}) + len({_SZS('pred')})) END
  WHEN field IN ('parameters_millions', 'optimizer') THEN CAST(match AS INT)
  WHEN field = 'date_created' THEN CASE WHEN {_y('gold')} IS NULL AND {_y('pred')} IS NULL THEN 1.0 WHEN coalesce({_y('gold')} <> {_y('pred')}, true) THEN 0.0 WHEN {_mo('gold')} IS NULL OR {_mo('pred')} IS NULL THEN 0.9 WHEN {_mo('gold')} = {_mo('pred')} THEN 1.0 ELSE 0.5 END
  WHEN field = 'organization' THEN CASE WHEN {_G} = '' AND {_P} = '' THEN 1.0 WHEN {_G} = '' OR {_P} = '' THEN 0.0 WHEN {_G} = {_P} THEN 1.0 WHEN match THEN 0.95 END
  WHEN field IN ('model_name', 'model_family') THEN CASE WHEN {_SG} = {_SP} THEN 1.0 WHEN {_SG} = '' OR {_SP} = '' THEN 0.0 WHEN match THEN 0.95 END
  WHEN {_G} = {_P} THEN 1.0 WHEN field IN ({_FUZZY}) AND {_G} <> '' AND {_P} <> '' THEN NULL ELSE 0.0 END"""
_GE, _PE = f"NOT {S.missing3('gold')}", f"NOT {S.missing3('pred')}"


def _counts(both_wrong: bool) -> str:
    fn = f"({_GE}) AND NOT ({_PE})" + (f" OR (({_GE}) AND ({_PE}) AND NOT match)" if both_wrong else "")
    return f"count(*) FILTER (WHERE ({_GE}) AND ({_PE}) AND match) AS tp, count(*) FILTER (WHERE (({_GE}) AND ({_PE}) AND NOT match) OR (NOT ({_GE}) AND ({_PE}))) AS fp, count(*) FILTER (WHERE {fn}) AS fn, count(*) FILTER (WHERE NOT ({_GE}) AND NOT ({_PE})) AS tn"


_RATES = """round(coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * coalesce(tp / nullif(tp + fp, 0), 0) * coalesce(tp / nullif(tp + fn, 0), 0) / nullif(coalesce(tp / nullif(tp + fp, 0), 0) + coalesce(tp / nullif(tp + fn, 0), 0), 0), 0), 6) AS f1"""


@query(f"WITH {_long_sql()}, m AS (SELECT *, {_STRICT} AS match FROM long) SELECT extractor, gold_id, pred_id, field, gold, pred, {_GE} AS gold_there, {_PE} AS pred_there, match, round({_SIMILAR}, 6) AS similarity FROM m")
def c7_strict_match(spark, sf):
    """Every field of every pair with match and similarity by the strict rules, NULL where that of the texts counts."""
    there = lambda c: ~E.is_missing_m3(F.col(c))
    return run_results(spark, sf).select("extractor", "gold_id", "pred_id", "field", "gold", "pred", there("gold").alias("gold_there"), there("pred").alias("pred_there"), E.strict_match().alias("match"), F.round(E.strict_similarity(), 6).alias("similarity"))


@query()
def c8_similar_texts(spark, sf):
    """The same with the similarity of texts where it counts."""
    r = E.decide(run_results(spark, sf), E.strict_match(), similarity=E.strict_similarity())
    return r.select("extractor", "gold_id", "pred_id", "field", "match", F.round("similarity", 6).alias("similarity"))


@query()
def c11_scored_match(spark, sf):
    """The same with scores of texts in place of match and similarity of five fields."""
    return whole_results(spark, sf).select("extractor", "gold_id", "pred_id", "field", "match", F.round("similarity", 6).alias("similarity"), F.round("score", 6).alias("score"))


@query()
def c12_text_scores(spark, sf):
    """Mean score of the texts of each reported field."""
    s = whole_results(spark, sf).where(F.col("field").isin(*E.REPORTED) & F.col("score").isNotNull())
    return s.groupBy("field").agg(F.count("*").alias("n_pairs"), F.round(F.avg("score"), 4).alias("mean_score"), F.count_if(F.col("score") >= 0.8).alias("n_match"))


_FG, _FP = (f"lower(trim(regexp_replace(coalesce({c}, ''), '{S.WS}+', ' ', 'g')))" for c in ("gold", "pred"))
_FD = lambda c: f"try_cast({c} AS DOUBLE)"
_FINE = f"""CASE WHEN {_FG} = '' AND {_FP} = '' THEN true WHEN {_FG} = '' OR {_FP} = '' THEN false WHEN contains({_FG}, {_FP}) OR contains({_FP}, {_FG}) THEN true
  WHEN field = 'parameters_millions' THEN coalesce(abs({_FD(_FG)} - {_FD(_FP)}) / greatest({_FD(_FG)}, 1.0) < 0.1, false)
  WHEN field IN ({", ".join(f"'{f}'" for f in E.OVERLAP)}) THEN len(list_intersect(list_distinct(string_split({_FG}, ' ')), list_distinct(string_split({_FP}, ' ')))) / len(list_distinct(string_split({_FG}, ' '))) >= 0.5 ELSE false END"""



@query(f"WITH {_long_sql('finetune')} SELECT extractor, gold_id, pred_id, field, {_FINE} AS match FROM long")
def c14_finetune_match(spark, sf):
    return run_results(spark, sf, "finetune").select("extractor", "gold_id", "pred_id", "field", E.finetune_match().alias("match"))


_R = lambda c: f"CASE WHEN {c} IS NULL OR lower({S.strip(c)}) IN ('null', 'none', 'n/a') THEN '' ELSE lower({S.strip(c)}) END"
_BARE = lambda c: rf"""{S.strip(rf"regexp_replace(regexp_replace(lower({S.strip(c)}), '\s*\(\s*\d+(?:\.\d+)?\s*[kmb]\s*\)\s*$', ''), '\s+\d+(?:\.\d+)?\s*[kmb]\s*$', '')")}"""
_MV = lambda c: f"CASE WHEN {_mo(c)} BETWEEN 1 AND 12 THEN {_mo(c)} END"
_SHORT = ", ".join(f"'{f}'" for f in E.SHORT)


@query(f"""WITH {_long_sql('relaxed')}, n AS (SELECT *, {_R('gold')} AS g, {_R('pred')} AS p FROM long)
SELECT extractor, gold_id, pred_id, field, CASE WHEN field = 'date_created' AND g <> '' AND p <> '' AND {_y('gold')} = {_y('pred')} THEN {_MV('gold')} IS NULL OR {_MV('pred')} IS NULL OR {_MV('gold')} = {_MV('pred')}
  WHEN field = 'model_name' AND g <> '' AND p <> '' AND {_BARE('gold')} <> '' AND {_BARE('pred')} <> '' AND (contains({_BARE('gold')}, {_BARE('pred')}) OR contains({_BARE('pred')}, {_BARE('gold')})) THEN true
  WHEN g = p THEN true WHEN field IN ({_SHORT}) AND g <> '' AND p <> '' THEN CASE WHEN contains(g, p) OR contains(p, g) THEN true END WHEN field IN ({_FUZZY}) AND g <> '' AND p <> '' THEN NULL ELSE false END AS match FROM n""")
def c13_relaxed_match(spark, sf):
    """The relaxed match of all 18 fields, NULL where the similarity of texts decides."""
    return run_results(spark, sf, "relaxed").select("extractor", "gold_id", "pred_id", "field", E.relaxed_match().alias("match"))


@query()
def c13_relaxed_all(spark, sf):
    """The same with the similarity of texts where it decides: 0.65 for long texts, 0.8 for the others."""
    r = E.decide(run_results(spark, sf, "relaxed"), E.relaxed_match(), E.relaxed_threshold())
    return r.select("extractor", "gold_id", "pred_id", "field", "match", F.round("similarity", 6).alias("similarity"))


# metrics ------------------------------------------------------------------------------------------------------------------

_RES = f"{_long_sql()}, res AS (SELECT *, {_STRICT} AS match FROM long)"
_OPEN = f"count(*) FILTER (WHERE ({_GE}) AND ({_PE}) AND match IS NULL) AS n_open"
_STRUCT = ", ".join(f"'{f}'" for f in E.STRUCTURED)


def _counted(results, keys, both_wrong=False):
    """Counts and rates by rules alone, with the number of fields that the similarity of texts would decide."""
    open_ = F.count_if(~E.is_missing_m3(F.col("gold")) & ~E.is_missing_m3(F.col("pred")) & F.col("match").isNull())
    n = results.groupBy(*keys).agg(open_.alias("n_open"))
    c = E.counts(results, keys, both_wrong)
    return E.scores(c.join(n, keys) if keys else c.withColumn("k", F.lit(1)).join(n.withColumn("k", F.lit(1)), "k").drop("k"))


def _ruled(spark, sf):
    return run_results(spark, sf).withColumn("match", E.strict_match())


def _with_overall(results):
    """Rows once for their field and, of structured fields, once more for all of them together."""
    f = F.col("field")
    of = F.when(f.isin(*E.STRUCTURED), F.array(f, F.lit("overall"))).otherwise(F.array(f))
    return results.select(F.explode(of).alias("field"), "gold", "pred", "match")


@query(f"""WITH {_RES}, c AS (SELECT field, {_counts(False)}, {_OPEN} FROM res GROUP BY 1 UNION ALL SELECT 'overall', {_counts(False)}, {_OPEN} FROM res WHERE field IN ({_STRUCT}) HAVING count(*) > 0) SELECT *, {_RATES} FROM c""")
def a13_field_metrics(spark, sf):
    """Counts and rates by rules of each of the 18 fields and of the 13 structured ones together, over paired records."""
    return _counted(_with_overall(_ruled(spark, sf)), ["field"])


@query()
def a13_paired_metrics(spark, sf):
    """The same by the whole rule."""
    return E.scores(E.counts(_with_overall(whole_results(spark, sf)), ["field"]))


def _all_runs(spark, sf):
    """(extractor, n_papers): every extractor but the reference with the papers that it has records of."""
    r = recs(spark, sf).where("paper_id is not null and extractor is not null").where(F.col("extractor") != TRUSTED)
    return r.select("extractor", "paper_id").distinct().groupBy("extractor").agg(F.count("*").alias("n_papers"))


def _by_extractor(spark, sf, counted):
    """The counts of each extractor, zeros for one without a pair."""
    return E.scores(_all_runs(spark, sf).join(counted, "extractor", "left").na.fill(0))


_RUNS_SQL = f"runs AS (SELECT extractor, count(DISTINCT paper_id) AS n_papers FROM recs WHERE paper_id IS NOT NULL AND extractor <> '{TRUSTED}' GROUP BY 1)"
_OF_RUNS = f"{_RUNS_SQL}, c0 AS (SELECT extractor, {_counts(False)}, {_OPEN} FROM res GROUP BY 1), c AS (SELECT extractor, n_papers, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn, coalesce(tn, 0) AS tn, coalesce(n_open, 0) AS n_open FROM runs LEFT JOIN c0 USING (extractor))"


def _ruled_counts(spark, sf, keys):
    r = _ruled(spark, sf)
    return _counted(r, keys).drop("accuracy", "precision", "recall", "f1")


@query(f"WITH {_RES}, {_OF_RUNS} SELECT *, {_RATES} FROM c")
def a14_extractor_metrics(spark, sf):
    """Micro-averaged counts and rates by rules of each extractor over all 18 fields and all papers."""
    return _by_extractor(spark, sf, _ruled_counts(spark, sf, ["extractor"]))


@query()
def a14_paired_extractors(spark, sf):
    """The same by the whole rule, with the mean over the papers of their text scores."""
    r = cut(whole_results(spark, sf))
    text = E.text_aggregate(r, ["extractor", "paper_id"]).groupBy("extractor").agg(F.round(F.avg("text_score"), 6).alias("text_score"))
    return _by_extractor(spark, sf, E.counts(r, ["extractor"])).join(text, "extractor", "left")


@query()
def a22_text_aggregate(spark, sf):
    """Mean over the reported fields of their mean text scores, for each run."""
    return E.text_aggregate(whole_results(spark, sf), ["paper_id", "extractor"]).withColumn("text_score", F.round("text_score", 6))


_FINE_RES = f"{_long_sql('finetune')}, res AS (SELECT *, {_FINE} AS match FROM long)"


@query(f"WITH {_FINE_RES}, c AS (SELECT field, {_counts(True)} FROM res GROUP BY 1) SELECT *, {_RATES} FROM c")
def a15_finetune_metrics(spark, sf):
    """The fine-tune profile: a mismatch is both a wrong and a missed value."""
    return E.scores(E.counts(run_results(spark, sf, "finetune").withColumn("match", E.finetune_match()), ["field"], both_wrong=True))


_FINE_TUNED, _BASE_MODEL = "linnet-3b", "linnet-8b-instruct"


@query(f"""WITH {_FINE_RES}, s AS (SELECT 1), f AS (SELECT {_counts(True)} FROM res WHERE extractor = '{_FINE_TUNED}'), b AS (SELECT {_counts(True)} FROM res WHERE extractor = '{_BASE_MODEL}'),
ff AS (SELECT {_RATES} FROM f), bb AS (SELECT {_RATES} FROM b) SELECT ff.f1 AS tuned_f1, bb.f1 AS base_f1, round(ff.f1 - bb.f1, 4) AS difference FROM ff, bb""")
def a24_side_by_side(spark, sf):
    """A fine-tuned extractor beside its baseline by the fine-tune profile: one row each, so the cross join is of one row with one."""
    r = run_results(spark, sf, "finetune").withColumn("match", E.finetune_match())
    of = lambda e, name: E.scores(E.counts(r.where(F.col("extractor") == e), [], both_wrong=True)).select(F.lit(1).alias("k"), F.col("f1").alias(name))
    return of(_FINE_TUNED, "tuned_f1").join(of(_BASE_MODEL, "base_f1"), "k").select("tuned_f1", "base_f1", F.round(F.col("tuned_f1") - F.col("base_f1"), 4).alias("difference"))


# evaluation of whole runs -------------------------------------------------------------------------------------------------

_SIDES_SQL = f"""gs AS (SELECT paper_id, record_id, nm FROM base WHERE extractor = '{TRUSTED}'), ps AS (SELECT paper_id, extractor, record_id FROM base WHERE extractor <> '{TRUSTED}'), rs AS (SELECT DISTINCT paper_id, extractor FROM ps),
taken AS (SELECT pr.paper_id, pr.extractor, b.nm FROM pr JOIN base b ON b.record_id = pr.gold_id), miss AS (SELECT rs.paper_id, rs.extractor, gs.record_id AS gold_id, gs.nm FROM rs JOIN gs USING (paper_id) LEFT JOIN taken t ON t.paper_id = rs.paper_id AND t.extractor = rs.extractor AND t.nm = gs.nm WHERE t.nm IS NULL),
left_ AS (SELECT ps.* FROM ps LEFT JOIN pr ON pr.pred_id = ps.record_id WHERE pr.pred_id IS NULL)"""


def _missing(spark, sf, pairs):
    """(paper_id, extractor, gold_id, name): reference records of a run whose name no pair of the run has."""
    r = recs(spark, sf).where("paper_id is not null and extractor is not null").withColumn("nm", F.lower(E.trim_all(F.coalesce("model_name", F.lit("")))))
    runs = r.where(F.col("extractor") != TRUSTED).select("paper_id", "extractor").distinct()
    golds = r.where(F.col("extractor") == TRUSTED).select("paper_id", F.col("record_id").alias("gold_id"), "nm")
    taken = pairs.select("paper_id", "extractor", "gold_id").join(golds.select("gold_id", "nm"), "gold_id").select("paper_id", "extractor", "nm").distinct()
    return runs.join(golds, "paper_id").join(taken, ["paper_id", "extractor", "nm"], "left_anti").select("paper_id", "extractor", "gold_id", F.col("nm").alias("name"))


def _unmatched(spark, sf, pairs):
    r = recs(spark, sf).where("paper_id is not null and extractor is not null").where(F.col("extractor") != TRUSTED)
    return r.select("paper_id", "extractor", F.col("record_id").alias("pred_id"), "model_name").join(pairs.select("pred_id"), "pred_id", "left_anti")


@query(f"WITH {_runs_sql()}, {_SIDES_SQL} SELECT paper_id, extractor, gold_id, nm AS name FROM miss")
def jn11_missing(spark, sf):
    """Reference records that no prediction of a run was paired with, by name (JN11)."""
    return _missing(spark, sf, cut(run_pairs(spark, sf)))


@query(f"WITH {_runs_sql()}, {_SIDES_SQL} SELECT paper_id, extractor, l.record_id AS pred_id, r.model_name FROM left_ l JOIN recs r USING (record_id, paper_id, extractor)")
def jn12_unmatched(spark, sf):
    """Predictions of a run that no reference record was paired with (JN12)."""
    return _unmatched(spark, sf, run_pairs(spark, sf))


@query(f"""WITH {_runs_sql()}, {_SIDES_SQL}, m AS (SELECT DISTINCT paper_id, extractor, nm FROM miss) SELECT paper_id, extractor, array_to_string(list_sort(list(nm))[1:10], ', ') AS first_ten, greatest(count(*) - 10, 0) AS n_more FROM m GROUP BY 1, 2""")
def r6_missing(spark, sf):
    """Names that a run missed, ten of each and how many more: the ten are the feature."""
    m = _missing(spark, sf, cut(run_pairs(spark, sf))).select("paper_id", "extractor", "name").distinct()
    w = Window.partitionBy("paper_id", "extractor").orderBy("name")
    ten = m.withColumn("rn", F.row_number().over(w)).where("rn <= 10").groupBy("paper_id", "extractor").agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("first_ten"))
    n = m.groupBy("paper_id", "extractor").agg(F.greatest(F.count("*") - 10, F.lit(0)).cast("bigint").alias("n_more"))
    return ten.join(n, ["paper_id", "extractor"])


_N = lambda t, name: f"{name} AS (SELECT paper_id, extractor, count(*) AS {name} FROM {t} GROUP BY 1, 2)"


@query(f"""WITH {_runs_sql()}, {_SIDES_SQL}, {_N('ps', 'n_pred')}, {_N('pr', 'n_matched')}, {_N('left_', 'n_unmatched')}, {_N('miss', 'n_missing')}, n_gold AS (SELECT paper_id, count(*) AS n_gold FROM gs GROUP BY 1)
SELECT paper_id, extractor, coalesce(n_gold.n_gold, 0) AS n_gold, n_pred.n_pred, coalesce(n_matched.n_matched, 0) AS n_matched, coalesce(n_unmatched.n_unmatched, 0) AS n_unmatched, coalesce(n_missing.n_missing, 0) AS n_missing
FROM n_pred LEFT JOIN n_gold USING (paper_id) LEFT JOIN n_matched USING (paper_id, extractor) LEFT JOIN n_unmatched USING (paper_id, extractor) LEFT JOIN n_missing USING (paper_id, extractor)""")
def a26_summary(spark, sf):
    """What the evaluation of each run counts: records of both sides, pairs, and what is left over on both sides."""
    pairs = cut(run_pairs(spark, sf))
    return _summary(spark, sf, pairs)


def _summary(spark, sf, pairs):
    keys = ["paper_id", "extractor"]
    r = recs(spark, sf).where("paper_id is not null and extractor is not null")
    n = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    out = n(r.where(F.col("extractor") != TRUSTED), "n_pred")
    golds = r.where(F.col("extractor") == TRUSTED).groupBy("paper_id").agg(F.count("*").alias("n_gold"))
    out = out.join(golds, "paper_id", "left")
    for df, name in ((pairs, "n_matched"), (_unmatched(spark, sf, pairs), "n_unmatched"), (_missing(spark, sf, pairs), "n_missing")):
        out = out.join(n(df, name), keys, "left")
    return out.na.fill(0).select(*keys, "n_gold", "n_pred", "n_matched", "n_unmatched", "n_missing")


@query()
def a26_evaluation(spark, sf):
    """The whole evaluation of each run: what it counts, rates over the structured fields, aggregate of the text scores, grade."""
    r = cut(whole_results(spark, sf))
    pairs = r.select("paper_id", "extractor", "gold_id", "pred_id").distinct()
    keys = ["paper_id", "extractor"]
    c = E.counts(r.where(F.col("field").isin(*E.STRUCTURED)), keys)
    text = E.text_aggregate(r, keys).withColumn("text_score", F.round("text_score", 6))
    out = E.scores(_summary(spark, sf, pairs).join(c, keys, "left").na.fill(0)).join(text, keys, "left")
    return out.withColumns({"grade": grade(F.col("f1")), "exit_code": exit_code(F.col("f1"))})


# tables of results --------------------------------------------------------------------------------------------------------

# Categories of models and the order in which a table lists them.
CATEGORIES = {
    "Vision": ("qwen3-vl-30b-a3b-instruct",),
    "Think / Reasoning": ("qwen3-30b-a3b-thinking-2507", "qwen3-235b-a22b", "deepseek-r1-distill-llama-70b"),
    "Instruction Tuned": ("qwen3-30b-a3b-instruct-2507", "mistral-large-3-675b-instruct-2512", "meta-llama-3.1-8b-instruct", "llama-3.3-70b-instruct", "gemma-3-27b-it", "apertus-70b-instruct-2509"),
}
#: The extractors of these tables, in the same categories.
THESE = {"Think / Reasoning": ("tarn-30b-thinking", "osprey-70b-distill"), "Instruction Tuned": ("harrow-72b-instruct", "linnet-8b-instruct")}


def category(name, categories: dict | None = None):
    """The category of a model by its whole name; Unknown if none lists it."""
    out = F.lit("Unknown")
    for kind, models in (categories or CATEGORIES).items():
        out = F.when(name.isin(*models), kind).otherwise(out)
    return out


def place(kind):
    """Where a category stands in a table."""
    out = F.lit(99)
    for i, k in enumerate(CATEGORIES):
        out = F.when(kind == k, i).otherwise(out)
    return out


def grade(f1):
    return F.when(f1 >= 0.8, "EXCELLENT").when(f1 >= 0.6, "GOOD").when(f1 >= 0.4, "FAIR").otherwise("POOR")


def exit_code(f1):
    """What a program that evaluates one run ends with: 0 from the second band on."""
    return F.when(f1 >= EXIT_OK, 0).otherwise(1)


EXIT_OK = 0.6
_BAND = "CASE WHEN f1 >= 0.8 THEN 'EXCELLENT' WHEN f1 >= 0.6 THEN 'GOOD' WHEN f1 >= 0.4 THEN 'FAIR' ELSE 'POOR' END"
_KIND = "CASE " + " ".join(f"WHEN extractor IN ({', '.join(repr(m) for m in ms)}) THEN '{k}'" for k, ms in THESE.items()) + " ELSE 'Unknown' END"
_KEY_FIELDS = ["model_name", "parameters", "innovation", "extension"]
_PLACE = "row_number() OVER (ORDER BY CASE category WHEN 'Vision' THEN 0 WHEN 'Think / Reasoning' THEN 1 WHEN 'Instruction Tuned' THEN 2 ELSE 99 END, extractor)"


def _table(per, by_field):
    """Rows of a results table in order: categories first, then names. One row an extractor, so the window over all rows is small."""
    wide = by_field.groupBy("extractor").pivot("field", _KEY_FIELDS).agg(F.max("f1"))
    t = per.join(wide, "extractor", "left").withColumn("category", category(F.col("extractor"), THESE))
    w = Window.orderBy(place(F.col("category")), "extractor")
    keep = ["category", "extractor", "n_papers", "f1", "precision", "recall", "accuracy", *(["text_score"] if "text_score" in t.columns else [])]
    return t.select(*keep, grade(F.col("f1")).alias("grade"), *[F.coalesce(F.col(c), F.lit(0.0)).alias(f"{c}_f1") for c in _KEY_FIELDS], F.row_number().over(w).cast("bigint").alias("place"))


@query(f"""WITH {_RES}, {_OF_RUNS}, m AS (SELECT *, {_RATES} FROM c), fc AS (SELECT extractor, field, {_counts(False)} FROM res GROUP BY 1, 2), fm AS (SELECT extractor, field, {_RATES} FROM fc),
wide AS (SELECT extractor, {", ".join(f"max(f1) FILTER (WHERE field = '{f}') AS {f}_f1" for f in _KEY_FIELDS)} FROM fm GROUP BY 1), t AS (SELECT {_KIND} AS category, * FROM m LEFT JOIN wide USING (extractor))
SELECT category, extractor, n_papers, f1, precision, recall, accuracy, {_BAND} AS grade, {", ".join(f"coalesce({f}_f1, 0) AS {f}_f1" for f in _KEY_FIELDS)}, {_PLACE} AS place FROM t""")
def g9_results_table(spark, sf):
    """One row for each extractor, by rules: category, papers, rates, grade, four fields, and its place in the table (G9, JN15, R3, R8)."""
    r = cut(_ruled(spark, sf))
    counted = _counted(r, ["extractor"]).drop("accuracy", "precision", "recall", "f1", "n_open")
    return _table(_by_extractor(spark, sf, counted), E.scores(E.counts(r, ["extractor", "field"])))


@query()
def g9_paired_results(spark, sf):
    """The same by the whole rule, with the text score (G9, JN15, R3, R8, K5)."""
    r = cut(whole_results(spark, sf))
    text = E.text_aggregate(r, ["extractor", "paper_id"]).groupBy("extractor").agg(F.round(F.avg("text_score"), 6).alias("text_score"))
    return _table(_by_extractor(spark, sf, E.counts(r, ["extractor"])).join(text, "extractor", "left"), E.scores(E.counts(r, ["extractor", "field"])))


@query(f"WITH {_RES}, {_OF_RUNS}, m AS (SELECT *, {_RATES} FROM c) SELECT extractor, f1 FROM m ORDER BY f1 DESC, extractor LIMIT 3")
def r4_top_extractors(spark, sf):
    """The three best extractors by rules: the limit is the feature."""
    return _by_extractor(spark, sf, _ruled_counts(spark, sf, ["extractor"])).orderBy(F.col("f1").desc(), "extractor").limit(3).select("extractor", "f1")


@query()
def r4_paired_top_extractors(spark, sf):
    """The three best extractors by the whole rule: the limit is the feature."""
    return _by_extractor(spark, sf, E.counts(whole_results(spark, sf), ["extractor"])).orderBy(F.col("f1").desc(), "extractor").limit(3).select("extractor", "f1")


def _ends(m):
    return m.orderBy(F.col("f1").desc(), "field").limit(5).withColumn("side", F.lit("top")).unionByName(m.orderBy("f1", "field").limit(5).withColumn("side", F.lit("bottom")))


@query(f"WITH {_RES}, c AS (SELECT field, {_counts(False)} FROM res GROUP BY 1), m AS (SELECT field, {_RATES} FROM c) (SELECT field, f1, 'top' AS side FROM m ORDER BY f1 DESC, field LIMIT 5) UNION ALL (SELECT field, f1, 'bottom' FROM m ORDER BY f1, field LIMIT 5)")
def r5_best_and_worst_fields(spark, sf):
    """Five best and five worst of the 18 fields by rules: the limit is the feature."""
    return _ends(cut(E.scores(E.counts(_ruled(spark, sf), ["field"])).select("field", "f1")))


@query()
def r5_paired_fields(spark, sf):
    """Five best and five worst of the 18 fields by the whole rule: the limit is the feature."""
    return _ends(cut(E.scores(E.counts(whole_results(spark, sf), ["field"])).select("field", "f1")))


@query(f"SELECT {_KIND} AS category, count(*) AS n FROM extractors GROUP BY 1")
def a19_categories(spark, sf):
    return load(spark, sf, "extractors").groupBy(category(F.col("extractor"), THESE).alias("category")).agg(F.count("*").alias("n"))
