"""Queries on extracted records: survey groups N, F, A, R and the set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.functions import names as N
from recordloom.missing import is_missing_m3, trim_all
from recordloom.operators import records as R
from recordloom.plans import sqlx as S
from recordloom.plans.documents import papers, props
from recordloom.plans.registry import Registry
from recordloom.session import load

query = Registry()


def recs(spark: SparkSession, sf: str) -> DataFrame:
    """Extracted records, those delivered twice once."""
    return load(spark, sf, "extracted").drop("ingested_at").dropDuplicates(["record_id"])


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "gold_models")


# normalisers --------------------------------------------------------------------------------------------------------------

_DATE = lambda x: rf"CASE WHEN regexp_matches({S.strip(x)}, '^\d{{4}}-\d{{2}}(-\d{{2}})?$') THEN substr({S.strip(x)}, 1, 7) WHEN regexp_matches({S.strip(x)}, '^\d{{4}}$') THEN {S.strip(x)} || '-01' ELSE {x} END"


def _title(x: str) -> str:
    return rf"array_to_string(list_transform(regexp_extract_all({x}, '([^\p{{L}}]*\p{{L}}*)', 1), lambda p: regexp_extract(p, '^([^\p{{L}}]*)', 1) || upper(substr(regexp_extract(p, '(\p{{L}}*)$', 1), 1, 1)) || lower(substr(regexp_extract(p, '(\p{{L}}*)$', 1), 2))), '')"


_ORG = "CASE WHEN organization IS NULL OR s = '' THEN organization " + " ".join(f"WHEN contains(s, '{a}') OR contains('{a}', s) THEN '{b}'" for a, b in N.ORGANISATIONS) + f" WHEN contains(s, ' ') THEN {_title(S.strip('organization'))} ELSE organization END"


@query(f"WITH {S.PROPS}, x AS (SELECT *, lower({S.strip('organization')}) AS s FROM props) SELECT prop_id, {_DATE('date_created')} AS date_created, {_ORG} AS organization FROM x")
def n3_normalize(spark, sf):
    """Dates to year and month, organisations to known names."""
    return props(spark, sf).select("prop_id", N.normalize_date(F.col("date_created")).alias("date_created"), N.normalize_organisation(F.col("organization")).alias("organization"))


@query(f"""WITH {S.PROPS}, {S.PAPERS}, m AS (SELECT paper_id, CASE WHEN try_cast(substr(published, 1, 4) AS INT) IS NULL THEN NULL WHEN try_cast(substr(published, 6, 2) AS INT) BETWEEN 1 AND 12 THEN CAST(try_cast(substr(published, 1, 4) AS INT) AS VARCHAR) || '-' || lpad(CAST(try_cast(substr(published, 6, 2) AS INT) AS VARCHAR), 2, '0')
  ELSE CAST(try_cast(substr(published, 1, 4) AS INT) AS VARCHAR) || '-01' END AS ym FROM pap) SELECT prop_id, coalesce(ym, date_created) AS date_created FROM props LEFT JOIN m USING (paper_id)""")
def n4_paper_date(spark, sf):
    """The date of the paper instead of the extracted one, where it has one."""
    y, m = F.substring("published", 1, 4).try_cast("int"), F.substring("published", 6, 2).try_cast("int")
    ym = F.when(y.isNull(), F.lit(None)).when(m.between(1, 12), F.concat(y.cast("string"), F.lit("-"), F.lpad(m.cast("string"), 2, "0"))).otherwise(F.concat(y.cast("string"), F.lit("-01")))
    p = papers(spark, sf).select("paper_id", ym.alias("ym"))
    return props(spark, sf).select("prop_id", "paper_id", "date_created").join(p, "paper_id", "left").select("prop_id", F.coalesce("ym", "date_created").alias("date_created"))


@query(f"WITH {S.RECS}, {S.canonical_cte('recs')} SELECT record_id, {S.spaced('model_name')} AS spaced, version, canonical FROM canon")
def n7_canonical_name(spark, sf):
    """Spacing, version and release of a name."""
    c = F.col("model_name")
    return recs(spark, sf).select("record_id", N.spaced(c).alias("spaced"), N.version_token(N.spaced(trim_all(c))).alias("version"), N.canonical_name(c).alias("canonical"))


@query(f"WITH {S.RECS}, x AS (SELECT record_id, {S.size_norm('parameters')} AS size FROM recs) SELECT record_id, size, round({S.size_key('size')}, 6) AS millions FROM x")
def n8_size(spark, sf):
    """Size texts in one form and their millions."""
    s = recs(spark, sf).select("record_id", N.normalize_size(F.col("parameters")).alias("size"))
    return s.select("record_id", "size", F.round(N.size_key(F.col("size")), 6).alias("millions"))


_SIZES = rf"list_sort(list_distinct(list_transform(regexp_extract_all(parameters, '(?i)(\d+(?:\.\d+)?\s*[MBT])\b', 1), lambda x: {S.size_key('x')})))"
_SHOW = "CASE WHEN m >= 1000 AND m / 1000 = floor(m / 1000) THEN CAST(CAST(m / 1000 AS BIGINT) AS VARCHAR) || 'B' WHEN m >= 1000 THEN CAST(m / 1000 AS VARCHAR) || 'B' ELSE CAST(CAST(round_even(m, 0) AS BIGINT) AS VARCHAR) || 'M' END"


@query(f"""WITH {S.PROPS}, x AS (SELECT prop_id, {_SIZES} AS sizes FROM props) SELECT prop_id, CASE WHEN len(sizes) > 0 THEN array_to_string(list_transform(sizes, lambda m: {_SHOW}), ', ') END AS parameters, CAST(round_even(list_max(sizes), 0) AS BIGINT) AS millions FROM x""")
def n10_gold_parameters(spark, sf):
    """All sizes of a text in one form, ascending, and the largest in millions."""
    c = F.col("parameters")
    return props(spark, sf).select("prop_id", N.gold_parameters(c).alias("parameters"), N.gold_millions(c).alias("millions"))


@query(rf"""WITH {S.PROPS}, x AS (SELECT prop_id, parameters AS p, try_cast({S.strip("regexp_replace(upper(list_last(string_split(list_last(string_split(parameters, '-')), ','))), '[MB]', '', 'g')")} AS DOUBLE) AS num FROM props)
SELECT prop_id, CASE WHEN p IS NULL OR lower(p) IN ('', 'n/a', 'null', 'none') OR abs(num) > 9e18 THEN NULL ELSE CAST(trunc(num) AS BIGINT) END AS millions FROM x""")
def n12_sheet_millions(spark, sf):
    return props(spark, sf).select("prop_id", N.sheet_millions(F.col("parameters")).cast("bigint").alias("millions"))


@query(rf"""WITH {S.PROPS} SELECT prop_id, {S.soft('model_name')} AS soft, regexp_replace(lower({S.strip('model_name')}), '\s+\d+(?:\.\d+)?\s*[kmb]\s*$', '') AS bare, CASE WHEN regexp_matches(date_created, '^\d{{4}}(-\d{{2}}){{0,2}}$') THEN CAST(substr(date_created, 1, 4) AS INT) END AS year,
  CASE WHEN regexp_matches(date_created, '^\d{{4}}-\d{{2}}(-\d{{2}})?$') THEN CAST(substr(date_created, 6, 2) AS INT) END AS month FROM props""")
def n13_compare_forms(spark, sf):
    """The forms of names and dates that the evaluators compare."""
    d = F.col("date_created")
    return props(spark, sf).select(
        "prop_id", N.soft(F.col("model_name")).alias("soft"), N.without_size(F.col("model_name")).alias("bare"),
        F.when(d.rlike(r"^\d{4}(-\d{2}){0,2}$"), F.substring(d, 1, 4).cast("int")).alias("year"), F.when(d.rlike(r"^\d{4}-\d{2}(-\d{2})?$"), F.substring(d, 6, 2).cast("int")).alias("month"),
    )


# filters ------------------------------------------------------------------------------------------------------------------

_GATE = f"length({S.strip('''coalesce(model_name, '')''')}) >= 3 AND {S.filled(R.GATE_FIELDS)} >= 3"
_LN, _LF, _LP, _LV = (f"lower({S.strip(f'''coalesce({c}, '')''')})" for c in ("model_name", "model_family", "parameters", "model_version"))
_SINGLE = "|".join(w for w in R.AUXILIARY if " " not in w and "-" not in w)
_AUX = rf"(regexp_matches({_LN} || ' ' || {_LF}, '{_SINGLE}') OR regexp_matches({_LN} || ' ' || {_LF}, '\b(prompt guard|reward model|system-level)\b'))"
_SIGNAL = rf"(regexp_matches({_LN}, '\b(v?\d+(?:\.\d+)?)\b') OR regexp_matches({_LN} || ' ' || {_LP}, '\b\d+(?:\.\d+)?\s*[mbt]\b') OR {_LV} <> '')"
_FAMILIES = f"""fam AS (SELECT paper_id, {_LF} AS family, count(*) AS n, min({{'a': chunk_no, 'b': pos, 'c': record_id}}) AS o FROM recs WHERE {_LF} <> '' GROUP BY 1, 2),
dom AS (SELECT paper_id, CASE WHEN n >= 2 THEN family END AS dominant FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY n DESC, o) AS rn FROM fam) WHERE rn = 1)"""
_PRIMARY = f"""prim AS (SELECT r.*, coalesce({_LN} <> '' AND NOT {_AUX} AND NOT (d.dominant IS NOT NULL AND {_LF} <> '' AND {_LF} <> d.dominant) AND ({_SIGNAL} OR {S.filled(R.RICH_FIELDS)} >= 4), false) AS is_primary FROM recs r LEFT JOIN dom d ON d.paper_id = r.paper_id)"""


@query(f"WITH {S.RECS} SELECT record_id, {S.filled(R.GATE_FIELDS)} AS n_filled FROM recs WHERE {_GATE}")
def f1_gate(spark, sf):
    return recs(spark, sf).where(R.passes_gate()).select("record_id", R.n_filled(R.GATE_FIELDS).alias("n_filled"))


@query(f"WITH {S.RECS}, {_FAMILIES}, {_PRIMARY} SELECT record_id, {_AUX} AS auxiliary, {_SIGNAL} AS released, {S.filled(R.RICH_FIELDS)} AS richness, is_primary FROM prim")
def f5_primary(spark, sf):
    """Parts and by-products, release signal, richness, and what makes a record primary."""
    r = R.with_primary(recs(spark, sf))
    return r.select("record_id", R.is_auxiliary().alias("auxiliary"), R.release_signal().alias("released"), R.n_filled(R.RICH_FIELDS).alias("richness"), "is_primary")


@query(f"""WITH {S.RECS}, {_FAMILIES}, {_PRIMARY}, per AS (SELECT paper_id, count(*) AS n, bool_or(is_primary) AS anyp FROM prim GROUP BY 1) SELECT record_id, p.paper_id, is_primary FROM prim p JOIN per USING (paper_id) WHERE is_primary OR n <= 1 OR NOT anyp""")
def f6_select_primary(spark, sf):
    return R.select_primary(recs(spark, sf)).select("record_id", "paper_id", "is_primary")


@query(f"""WITH {S.RECS} SELECT record_id, regexp_matches({_LN}, '{"|".join(R.BASELINE)}') OR ({" + ".join(f"CAST(coalesce({S.strip(f'CAST({c} AS VARCHAR)')}, '') <> '' AS INT)" for c in R.RECORD_FIELDS)}) < 5 AS is_baseline FROM recs""")
def f7_baseline_record(spark, sf):
    """A baseline by its name or by fewer than five filled fields of the whole record."""
    return recs(spark, sf).select("record_id", R.is_baseline(R.RECORD_FIELDS).alias("is_baseline"))


@query(f"""WITH t AS (SELECT gold_id, CASE WHEN gold_id % 3 = 0 THEN paper_title || ' - Contribution ' || gold_id WHEN gold_id % 3 = 1 THEN paper_title ELSE lower(paper_title) END AS title FROM gold_models),
u AS (SELECT gold_id, {S.strip('title')} AS t FROM t WHERE {S.strip('title')} <> '')
SELECT gold_id, {S.strip("string_split(t, ' - Contribution')[1]")} AS paper_title FROM u WHERE NOT regexp_matches(lower(substr(t, 1, 50)), '^(compared with|t0pp is|a variety|the t5 model|t0 stands for|obtained by|fine-tuned with)')
  AND (contains(t, ' - Contribution') OR (length(t) >= 20 AND regexp_matches(t, '^\\p{{Lu}}'))) AND length({S.strip("string_split(t, ' - Contribution')[1]")}) >= 10""")
def f8_sheet_rows(spark, sf):
    """Rows of a sheet whose title is one, not the rest of a cell above."""
    i, t = F.col("gold_id") % 3, F.col("paper_title")
    title = F.when(i == 0, F.concat(t, F.lit(" - Contribution "), F.col("gold_id").cast("string"))).when(i == 1, t).otherwise(F.lower(t))
    rows = gold(spark, sf).select("gold_id", trim_all(title).alias("t")).where("t != ''")
    cut = trim_all(F.element_at(F.split("t", " - Contribution"), 1))
    rest = F.lower(F.substring("t", 1, 50)).rlike("^(compared with|t0pp is|a variety|the t5 model|t0 stands for|obtained by|fine-tuned with)")
    looks = F.col("t").contains(" - Contribution") | ((F.length("t") >= 20) & F.col("t").rlike(r"^\p{Lu}"))
    return rows.where(~rest & looks & (F.length(cut) >= 10)).select("gold_id", cut.alias("paper_title"))


@query("""SELECT count(*) AS n_gold, count(DISTINCT paper_title) AS n_titles, count(*) FILTER (WHERE paper_title IS NULL OR length(trim(paper_title)) < 10) AS n_invalid FROM gold_models""")
def f16_verify_gold(spark, sf):
    t = F.col("paper_title")
    return gold(spark, sf).agg(F.count("*").alias("n_gold"), F.count_distinct(t).alias("n_titles"), F.count_if(t.isNull() | (F.length(F.trim(t)) < 10)).alias("n_invalid"))


@query(f"""WITH {S.PAPERS}, done AS (SELECT DISTINCT split_part(split_part(file_name, '_', 1), 'v', 1) AS pre FROM extraction_files WHERE coalesce(json_array_length(payload::JSON->'extraction_data'), 0) + coalesce(json_array_length(payload::JSON->'raw_extraction'), 0) > 0)
SELECT paper_id FROM (SELECT DISTINCT paper_id FROM pap WHERE arxiv_id IS NOT NULL AND split_part(arxiv_id, 'v', 1) NOT IN (SELECT pre FROM done)) ORDER BY paper_id LIMIT 100 OFFSET 5""")
def f13_batch(spark, sf):
    """The next batch of papers that no file has records of yet: offset and limit are the feature."""
    from recordloom.plans.documents import files

    base = lambda c: F.split_part(c, F.lit("v"), F.lit(1))
    v = F.try_parse_json("payload")
    n = sum((F.greatest(F.coalesce(F.size(F.try_variant_get(v, f"$.{k}", "array<variant>")), F.lit(0)), F.lit(0)) for k in ("extraction_data", "raw_extraction")), F.lit(0))
    done = files(spark, sf).where(n > 0).select(base(F.split_part("file_name", F.lit("_"), F.lit(1))).alias("pre"))
    todo = papers(spark, sf).where("arxiv_id is not null").select("paper_id", base(F.col("arxiv_id")).alias("pre")).join(done, "pre", "left_anti").select("paper_id").distinct()
    return todo.orderBy("paper_id").offset(5).limit(100)


# grouping -----------------------------------------------------------------------------------------------------------------

_O = "{'a': chunk_no, 'b': pos, 'c': record_id}"
_SPEC = rf"""(2 * CAST({_LF} <> '' AND contains({_LN}, {_LF}) AS INT) + 3 * CAST({_LF} <> '' AND contains({_LN}, {_LF} || '-') AND regexp_matches(substr(list_last(string_split({_LN}, {_LF} || '-')), 1, 4), '\d') AS INT)
  + 2 * CAST(regexp_matches({_LN}, '\d+(?:\.\d+)?(?:\s|$)') AS INT) + CAST(regexp_matches({_LN}, '\d') AND regexp_matches({_LN}, '[mbk]') AS INT))"""
_FAM, _PAR, _NAM = S.strip("coalesce(model_family, '')"), S.strip("coalesce(parameters, '')"), S.spaced(S.strip("model_name"))
_SZ = f"CASE WHEN parameters_millions IS NULL THEN '' WHEN {_PAR} <> '' THEN {_PAR} ELSE CAST(parameters_millions AS VARCHAR) END"


def _gap(f: str) -> str:
    return f"({f} IS NULL OR lower({S.strip(f)}) IN ('', 'null', 'none'))"


@query(f"""WITH {S.PROPS} SELECT paper_id, {", ".join(f"coalesce(arg_min({f}, {{'a': chunk_no, 'b': pos, 'c': prop_id}}) FILTER (WHERE {f} <> ''), '') AS {f}" for f in ["model_name", "model_family", "organization", "license", "optimizer", "application"])} FROM props GROUP BY 1""")
def a4_first_of_chunks(spark, sf):
    """For each field of a paper the first value over its chunks that is not empty (A4)."""
    o = F.struct("chunk_no", "pos", "prop_id")
    first = [F.coalesce(F.min_by(f, F.when(F.col(f) != "", o)), F.lit("")).alias(f) for f in ("model_name", "model_family", "organization", "license", "optimizer", "application")]
    return props(spark, sf).groupBy("paper_id").agg(*first)


def _merge_sql(f: str) -> str:
    ok = f"NOT {S.missing3(f)}"
    if f in R.LONGEST_FIELDS:
        return f"arg_min({f}, {{'n': -length({f}), 'a': chunk_no, 'b': pos, 'c': record_id}}) FILTER (WHERE {ok}) AS {f}"
    if f == "blog_post":
        return f"nullif(array_to_string(list_sort(list_distinct(list_filter(flatten(list(list_transform(string_split({f}, ','), lambda x: {S.strip('x')})) FILTER (WHERE {ok})), lambda x: x <> ''))), ', '), '') AS {f}"
    return f"arg_min({f}, {_O}) FILTER (WHERE {ok}) AS {f}"


_MERGED = f"""{S.RECS}, gated AS (SELECT * REPLACE ({S.spaced('model_name')} AS model_name) FROM recs WHERE {_GATE}), {S.canonical_cte('gated')},
grp AS (SELECT paper_id, canonical, count(*) AS n, min({_O}) AS o FROM canon GROUP BY 1, 2), gv AS (SELECT *, lower(regexp_extract(canonical, '^([A-Za-z][\\w-]*)', 1)) AS family, {S.version('canonical')} AS ver FROM grp),
tgt AS (SELECT paper_id, family, canonical AS target FROM (SELECT *, row_number() OVER (PARTITION BY paper_id, family ORDER BY n DESC, o) AS rn FROM gv WHERE ver IS NOT NULL) WHERE rn = 1),
absorbed AS (SELECT g.paper_id, g.canonical, t.target FROM gv g JOIN tgt t USING (paper_id, family) WHERE g.ver IS NULL AND g.family <> '' AND lower(trim(g.canonical)) = g.family),
keyed AS (SELECT c.*, coalesce(a.target, c.canonical) AS merged_into FROM canon c LEFT JOIN absorbed a USING (paper_id, canonical))"""


@query(f"""WITH {_MERGED} SELECT DISTINCT paper_id, canonical, merged_into FROM keyed""")
def a6_absorbed(spark, sf):
    return R.merge_keys(recs(spark, sf)).select("paper_id", "canonical", "merged_into").distinct()


@query(f"""WITH {_MERGED}, before AS (SELECT DISTINCT {_LF} AS family, {S.version('model_name')} AS ver FROM gated WHERE {_LF} <> ''), after AS (SELECT DISTINCT lower(regexp_extract(merged_into, '^([A-Za-z][\\w-]*)', 1)) AS family, {S.version('merged_into')} AS ver FROM keyed)
SELECT family, count(*) AS n_before, count(after.ver) AS n_after, array_to_string(list_sort(coalesce(list(before.ver) FILTER (WHERE after.ver IS NULL), [])), ', ') AS lost FROM before LEFT JOIN after USING (family, ver) WHERE before.ver IS NOT NULL GROUP BY 1""")
def a10_lost_versions(spark, sf):
    """Versions of each family before merging, how many of them a merged name still states, and which are lost."""
    r = recs(spark, sf).where(R.passes_gate()).withColumn("model_name", N.spaced(F.col("model_name")))
    before = r.select(R.low("model_family").alias("family"), N.version_token(F.col("model_name")).alias("version")).where("family != '' and version is not null").distinct()
    after = R.merge_keys(recs(spark, sf)).select(F.lower(F.regexp_extract("merged_into", r"^([A-Za-z][\w-]*)", 1)).alias("family"), N.version_token(F.col("merged_into")).alias("version")).where("version is not null").distinct()
    both = before.join(after.withColumn("kept", F.lit(True)), ["family", "version"], "left")
    lost = F.array_join(F.array_sort(F.collect_list(F.when(F.col("kept").isNull(), F.col("version")))), ", ")
    return both.groupBy("family").agg(F.count("*").alias("n_before"), F.count("kept").alias("n_after"), lost.alias("lost"))


_WHOLE = [f for f in R.RECORD_FIELDS if f != "model_name"]


def _firsts(fields: list[str], order: str) -> str:
    return ", ".join(f"arg_min({f}, {order}) FILTER (WHERE {f} IS NOT NULL) AS {f}" for f in fields)


def _gap_text(f: str) -> str:
    return _gap(f"CAST({f} AS VARCHAR)")


@query(f"""WITH {S.RECS}, g AS (SELECT *, {_NAM} AS nm FROM recs WHERE {_GATE}), v AS (SELECT *, coalesce({S.version('nm')}, '') AS ver, {_FAM} AS fam, {_PAR} AS par, {{'n': -{_SPEC}, 'a': chunk_no, 'b': pos, 'c': record_id}} AS rk FROM g),
k AS (SELECT *, CASE WHEN fam <> '' AND (ver <> '' OR par <> '' OR parameters_millions IS NOT NULL) THEN fam ELSE nm END AS k1, CASE WHEN fam <> '' AND ver <> '' THEN ver WHEN fam <> '' AND (par <> '' OR parameters_millions IS NOT NULL) THEN '' ELSE coalesce(model_version, '') END AS k2,
  CASE WHEN fam <> '' AND (ver <> '' OR par <> '' OR parameters_millions IS NOT NULL) THEN {_SZ} ELSE coalesce(parameters, '') END AS k3 FROM v)
SELECT paper_id, count(*) AS n, arg_min(record_id, rk) AS record_id, arg_min(model_name, rk) AS model_name, {", ".join(f"coalesce(arg_min({f}, rk) FILTER (WHERE NOT {_gap_text(f)}), arg_max({f}, rk) FILTER (WHERE {f} IS NOT NULL)) AS {f}" for f in _WHOLE)} FROM k GROUP BY paper_id, k1, k2, k3""")
def a1_dedup_records(spark, sf):
    """Records of a paper's chunks that are one, the most specific kept and every field filled from the others (A1, A2)."""
    return R.dedup_chunks(recs(spark, sf), _WHOLE)


@query(f"""WITH {S.RECS} SELECT paper_id, model_name, model_version, parameters, count(*) AS n, arg_min(record_id, {_O}) AS record_id, {_firsts(R.RECORD_FIELDS[3:], _O)} FROM recs GROUP BY 1, 2, 3, 4""")
def a3_dedup_records(spark, sf):
    """Records equal in name, version and size: the first, the NULLs of every field filled from later ones (A3)."""
    pick = [F.min_by(f, F.when(F.col(f).isNotNull(), R.order())).alias(f) for f in R.RECORD_FIELDS[3:]]
    return recs(spark, sf).groupBy("paper_id", "model_name", "model_version", "parameters").agg(F.count("*").alias("n"), F.min_by("record_id", R.order()).alias("record_id"), *pick)


@query(f"""WITH {_MERGED} SELECT paper_id, merged_into AS model_name, count(*) AS n_variants,
  nullif(array_to_string(list_transform(list_sort(list_transform(list(DISTINCT {S.size_norm('parameters')}) FILTER (WHERE {S.size_norm('parameters')} IS NOT NULL), lambda s: {{'k': {S.size_key('s')}, 's': s}})), lambda x: x.s), ', '), '') AS parameters, max(parameters_millions) AS parameters_millions, {", ".join(map(_merge_sql, R.MERGED_FIELDS))} FROM keyed GROUP BY 1, 2""")
def a5_merge_records(spark, sf):
    """Sizes and variants of one release merged to one record, bare families absorbed."""
    return R.merge_variants(recs(spark, sf))


@query(f"""WITH {S.RECS} SELECT concat_ws(' ', model_name, nullif(model_version, ''), nullif(parameters, '')) AS label, count(*) AS n, {_firsts(R.RECORD_FIELDS, "{'p': paper_id, 'a': chunk_no, 'b': pos, 'c': record_id}")} FROM recs GROUP BY 1""")
def a11_merge_records(spark, sf):
    """Comparison entries of one label merged, the NULLs of every field filled from later ones."""
    label = F.concat_ws(" ", "model_name", F.nullif("model_version", F.lit("")), F.nullif("parameters", F.lit("")))
    o = F.struct("paper_id", *R.ORDER)
    return recs(spark, sf).groupBy(label.alias("label")).agg(F.count("*").alias("n"), *[F.min_by(f, F.when(F.col(f).isNotNull(), o)).alias(f) for f in R.RECORD_FIELDS])


@query("""SELECT CASE WHEN j IS NULL THEN 'failed' WHEN n > 0 THEN 'completed' ELSE 'skipped' END AS status, count(*) AS n_files FROM (SELECT DISTINCT ON (file_id) file_id, payload AS j, coalesce(json_array_length(payload::JSON->'extraction_data'), 0) + coalesce(json_array_length(payload::JSON->'raw_extraction'), 0) AS n FROM extraction_files) GROUP BY 1""")
def a17_batch_counts(spark, sf):
    from recordloom.plans.documents import files

    v = F.try_parse_json("payload")
    n = sum((F.greatest(F.coalesce(F.size(F.try_variant_get(v, f"$.{k}", "array<variant>")), F.lit(0)), F.lit(0)) for k in ("extraction_data", "raw_extraction")), F.lit(0))
    status = F.when(F.col("payload").isNull(), "failed").when(n > 0, "completed").otherwise("skipped")
    return files(spark, sf).groupBy(status.alias("status")).agg(F.count("*").alias("n_files"))


@query("SELECT source, count(*) AS n_docs, count(lang) AS n_with_lang, count(*) - count(lang) AS n_without FROM documents GROUP BY 1")
def a18_sources(spark, sf):
    return load(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n_docs"), F.count("lang").alias("n_with_lang"), (F.count("*") - F.count("lang")).alias("n_without"))


@query("SELECT paper_title, count(*) AS n_models, array_to_string(list_sort(list(model_name)), ', ') AS models FROM gold_models GROUP BY 1")
def a20_gold_by_title(spark, sf):
    return gold(spark, sf).groupBy("paper_title").agg(F.count("*").alias("n_models"), F.array_join(F.array_sort(F.collect_list("model_name")), ", ").alias("models"))


@query("SELECT DISTINCT paper_title FROM gold_models WHERE paper_title IS NOT NULL")
def a21_titles(spark, sf):
    return gold(spark, sf).select("paper_title").where(F.col("paper_title").isNotNull()).distinct()


@query("SELECT paper_id, count(*) AS n_models, list(model_name ORDER BY gold_id) FILTER (WHERE model_name IS NOT NULL) AS labels FROM gold_models GROUP BY 1")
def a23_summary(spark, sf):
    """How many contributions the comparison of a paper has, and their labels in order."""
    labels = F.transform(F.array_sort(F.collect_list(F.struct("gold_id", "model_name"))), lambda x: x["model_name"])
    return gold(spark, sf).groupBy("paper_id").agg(F.count("*").alias("n_models"), F.array_compact(labels).alias("labels"))


@query(f"""WITH {S.RECS} SELECT paper_id, record_id, row_number() OVER (PARTITION BY paper_id ORDER BY chunk_no, pos, record_id) AS place FROM recs WHERE paper_id IS NOT NULL AND chunk_no IS NOT NULL""")
def u1_chunk_union(spark, sf):
    """The records of all chunks of a paper as one list, in the order of the chunks.

    Chunks are counted first, so that a paper with a tenth of the records is numbered chunk by chunk.
    """
    r = recs(spark, sf).where("paper_id is not null and chunk_no is not null").select("paper_id", "chunk_no", "pos", "record_id")
    n = r.groupBy("paper_id", "chunk_no").agg(F.count("*").alias("n"))
    w = Window.partitionBy("paper_id").orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    before = n.select("paper_id", "chunk_no", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    inside = r.withColumn("rn", F.row_number().over(Window.partitionBy("paper_id", "chunk_no").orderBy("pos", "record_id")))
    return inside.join(before, ["paper_id", "chunk_no"]).select("paper_id", "record_id", (F.col("before") + F.col("rn")).alias("place"))


# scores -------------------------------------------------------------------------------------------------------------------

_WORDS = rf"regexp_extract_all(lower(coalesce(p.title, '')), '\b({'|'.join(R.TITLE_WORDS)})\b', 1)"


def _some(c: str) -> str:
    return f"CAST(coalesce({c} <> '', false) AS INT)"


_SCORE = f"""(CASE WHEN regexp_matches({_LN}, '{"|".join(R.BASELINE[:6])}') THEN -10.0 ELSE 0.0 END + CASE WHEN coalesce(parameters <> '', false) OR coalesce(parameters_millions <> 0, false) THEN 2 + CASE WHEN parameters_millions >= 1000 THEN 3 WHEN parameters_millions >= 100 THEN 2 WHEN parameters_millions >= 10 THEN 1 ELSE 0 END ELSE 0 END
  + CASE WHEN {_LF} <> '' AND len(list_filter({_WORDS}, lambda w: contains({_LF}, w))) > 0 THEN 3 ELSE 0 END + CASE WHEN len(list_filter({_WORDS}, lambda w: contains({_LN}, w))) > 0 THEN 2 ELSE 0 END
  + {_some('innovation')} + 0.5 * ({_some('pretraining_architecture')} + {_some('pretraining_task')} + {_some('optimizer')}) + {_some('organization')} + CAST(coalesce(model_family, '') <> '' AND {_LN} <> '' AND {_LN} <> lower(coalesce(model_family, '')) AS INT))"""


@query(f"""WITH {S.RECS}, {S.PAPERS}, s AS (SELECT r.*, CAST({_SCORE} AS DOUBLE) AS score FROM recs r LEFT JOIN pap p USING (paper_id)) SELECT paper_id, record_id, score FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY score DESC, chunk_no, pos, record_id) AS rn FROM s) WHERE rn <= 3""")
def r2_top_models(spark, sf):
    """The three records of each paper that most likely are its contribution (R1, R2): top n is the feature."""
    p = papers(spark, sf).select("paper_id", "title")
    s = recs(spark, sf).join(p, "paper_id", "left").withColumn("score", R.baseline_score(F.col("title")).cast("double"))
    w = Window.partitionBy("paper_id").orderBy(F.col("score").desc(), *R.ORDER)
    return s.select("paper_id", "record_id", "score", *R.ORDER[:2]).withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("paper_id", "record_id", "score")


@query("""SELECT paper_id, list_sort(list(model_name))[1:15] AS kept, greatest(count(*) - 15, 0) AS dropped FROM gold_models GROUP BY 1""")
def r7_cap(spark, sf):
    """Fifteen contributions of a paper at most: the cap is the feature."""
    w = Window.partitionBy("paper_id").orderBy("model_name")
    kept = gold(spark, sf).where("model_name is not null").withColumn("rn", F.row_number().over(w)).where("rn <= 15").groupBy("paper_id").agg(F.array_sort(F.collect_list("model_name")).alias("kept"))
    n = gold(spark, sf).groupBy("paper_id").agg(F.greatest(F.count("*") - 15, F.lit(0)).cast("bigint").alias("dropped"))
    return n.join(kept, "paper_id", "left")
