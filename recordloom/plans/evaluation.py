"""Queries on joins, mapping and datasets: survey groups JN, G and P; the metrics are in their own module."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.functions.text import slug, squash
from recordloom.operators import dataset as D
from recordloom.operators import evaluate as E
from recordloom.operators import mapping as M
from recordloom.plans import sqlx as S
from recordloom.plans.documents import files, papers, props
from recordloom.plans.metrics import TRUSTED
from recordloom.plans.records import gold, recs
from recordloom.plans.registry import Registry
from recordloom.session import load

query = Registry()

# similarity of vectors and validity of answers ----------------------------------------------------------------------------


@query("""WITH a AS (SELECT vec_id, embedding, label FROM embeddings), c AS (SELECT label, arg_min(embedding, vec_id) AS head FROM a GROUP BY 1)
SELECT vec_id, round(greatest(0, least(1, list_dot_product(CAST(embedding AS DOUBLE[]), CAST(head AS DOUBLE[])) / nullif(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * sqrt(list_dot_product(CAST(head AS DOUBLE[]), CAST(head AS DOUBLE[]))), 0))), 5) AS similarity FROM a JOIN c USING (label)""")
def c9_semantic(spark, sf):
    """Cosine of each vector with the first vector of its label."""
    e = load(spark, sf, "embeddings")
    head = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("head"))
    return e.join(head, "label").select("vec_id", F.round(E.cosine(F.col("embedding"), F.col("head")), 5).alias("similarity"))


@query("""SELECT count(*) AS n_files, count(*) FILTER (WHERE n > 0) AS n_valid, round(avg(CAST(n > 0 AS INT)), 6) AS rate FROM (SELECT DISTINCT ON (file_id) file_id, coalesce(json_array_length(payload::JSON->'extraction_data'), 0) + coalesce(json_array_length(payload::JSON->'raw_extraction'), 0) AS n FROM extraction_files)""")
def a16_validity(spark, sf):
    v = F.try_parse_json("payload")
    n = sum((F.greatest(F.coalesce(F.size(F.try_variant_get(v, f"$.{k}", "array<variant>")), F.lit(0)), F.lit(0)) for k in ("extraction_data", "raw_extraction")), F.lit(0))
    return files(spark, sf).select((n > 0).alias("ok")).agg(F.count("*").alias("n_files"), F.count_if("ok").alias("n_valid"), F.round(F.avg(F.col("ok").cast("int")), 6).alias("rate"))


@query("SELECT extractor FROM extractors ORDER BY extractor")
def s16_models(spark, sf):
    return load(spark, sf, "extractors").select("extractor").orderBy("extractor")


@query(rf"""WITH {S.PAPERS}, t AS (SELECT trim(regexp_replace(lower(title), '{S.WS}+', ' ', 'g')) AS nt, paper_id FROM pap WHERE title IS NOT NULL), g AS (SELECT gold_id, trim(regexp_replace(lower(paper_title), '{S.WS}+', ' ', 'g')) AS nt FROM gold_models WHERE paper_title IS NOT NULL),
x AS (SELECT gold_id, paper_id, CASE WHEN g.nt = t.nt THEN 0 ELSE 1 END AS tier FROM g JOIN t ON substr(g.nt, 1, 40) = substr(t.nt, 1, 40)) SELECT gold_id, arg_min(paper_id, {{'t': tier, 'p': paper_id}}) AS paper_id, min(tier) AS tier FROM x GROUP BY 1""")
def jn4_title_to_paper(spark, sf):
    """Reference records to papers by title, exact first, else by the first forty characters (JN4, JN5)."""
    t = papers(spark, sf).where(F.col("title").isNotNull()).select("paper_id", squash(F.col("title")).alias("t_title"))
    g = gold(spark, sf).where(F.col("paper_title").isNotNull()).select("gold_id", squash(F.col("paper_title")).alias("g_title"))
    x = g.join(t, F.substring("g_title", 1, 40) == F.substring("t_title", 1, 40)).withColumn("tier", F.when(F.col("g_title") == F.col("t_title"), 0).otherwise(1))
    return x.groupBy("gold_id").agg(F.min_by("paper_id", F.struct("tier", "paper_id")).alias("paper_id"), F.min("tier").alias("tier"))


_SLUG = lambda c: rf"regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"


@query(rf"""WITH {S.PAPERS}, f AS (SELECT DISTINCT ON (file_id) file_id, file_name, split_part(split_part(file_name, '_', 1), 'v', 1) AS pre, {_SLUG('file_name')} AS slug FROM extraction_files),
p AS (SELECT paper_id, split_part(arxiv_id, 'v', 1) AS pre, substr({_SLUG('title')}, 1, 30) AS head FROM pap), a AS (SELECT p.paper_id, f.file_name FROM p JOIN f USING (pre)),
b AS (SELECT p.paper_id, f.file_name FROM p JOIN f ON contains(f.slug, p.head) WHERE p.head <> '' AND p.paper_id NOT IN (SELECT paper_id FROM a))
SELECT paper_id, min(file_name) AS first_file, count(*) AS n_files, found_by FROM (SELECT *, 'id' AS found_by FROM a UNION ALL SELECT *, 'title' FROM b) GROUP BY paper_id, found_by""")
def jn7_paper_files(spark, sf):
    """Papers to their files by the id that the file names begin with, else by the first 30 characters of their title's slug in it (JN7)."""
    base = lambda c: F.split_part(c, F.lit("v"), F.lit(1))
    f = files(spark, sf).select("file_name", base(F.split_part("file_name", F.lit("_"), F.lit(1))).alias("pre"))
    p = papers(spark, sf).select("paper_id", base(F.col("arxiv_id")).alias("pre"), F.substring(slug(F.col("title")), 1, 30).alias("head"))
    by_id = p.join(f, "pre").select("paper_id", "file_name", F.lit("id").alias("found_by"))
    return found_files(p, f, by_id).groupBy("paper_id", "found_by").agg(F.min("file_name").alias("first_file"), F.count("*").alias("n_files"))


def found_files(p: DataFrame, f: DataFrame, by_id: DataFrame) -> DataFrame:
    """by_id, and for papers without a file the files whose slug holds the head of the title, found by joining all pieces of the
    file's slug of the lengths that the heads have (at most 30)."""
    rest = p.where("head != ''").join(by_id.select("paper_id"), "paper_id", "left_anti")
    lengths = rest.agg(F.collect_set(F.length("head")).alias("ls"))
    named = f.select("file_name", slug(F.col("file_name")).alias("slug")).join(F.broadcast(lengths)).select("file_name", "slug", F.explode("ls").alias("k")).where(F.length("slug") >= F.col("k"))
    pieces = named.select("file_name", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("slug") - F.col("k") + 1), lambda i: F.substring(F.col("slug"), i, F.col("k"))))).alias("head"))
    return by_id.unionByName(rest.join(pieces, "head").select("paper_id", "file_name", F.lit("title").alias("found_by")))


@query(f"""WITH {S.PAPERS}, g AS (SELECT DISTINCT paper_title FROM gold_models WHERE paper_title IS NOT NULL), l AS (SELECT title, min(arxiv_id) AS arxiv_id, min(pdf_url) AS pdf_url, max(doi) AS doi FROM pap GROUP BY 1)
SELECT paper_title, arxiv_id, doi, CASE WHEN title IS NULL THEN 'manual_needed' WHEN doi IS NOT NULL THEN 'store' ELSE 'archive' END AS source FROM g LEFT JOIN l ON title = paper_title""")
def jn10_papers_list(spark, sf):
    """Titles of reference records with what is known of their papers, by the first source that has them (JN8, JN10, A18)."""
    g = gold(spark, sf).select("paper_title").where(F.col("paper_title").isNotNull()).distinct()
    known = papers(spark, sf).groupBy("title").agg(F.min("arxiv_id").alias("arxiv_id"), F.max("doi").alias("doi"))
    source = F.when(F.col("title").isNull(), "manual_needed").when(F.col("doi").isNotNull(), "store").otherwise("archive")
    return g.join(known, g.paper_title == known.title, "left").select("paper_title", "arxiv_id", "doi", source.alias("source"))


@query(f"WITH {S.PAPERS} SELECT DISTINCT title FROM pap WHERE title IS NOT NULL AND title NOT IN (SELECT paper_title FROM gold_models WHERE paper_title IS NOT NULL)")
def jn9_removed_titles(spark, sf):
    """Titles of papers that no reference record names (JN9)."""
    t = papers(spark, sf).select("title").where(F.col("title").isNotNull()).distinct()
    return t.join(gold(spark, sf).select(F.col("paper_title").alias("title")), "title", "left_anti")


def in_label(label, name, version=None, parameters=None):
    """Whether a label holds the name in any case and, where they are given, version and parameters as they are."""
    ok = F.contains(F.lower(label), F.lower(name))
    for c in (version, parameters):
        if c is not None:
            ok = ok & (c.isNull() | (c == "") | F.contains(label, c))
    return ok


@query(f"""WITH {S.RECS}, l AS (SELECT DISTINCT paper_id, concat_ws(' ', model_name, nullif(model_version, ''), nullif(parameters, '')) AS label FROM recs WHERE extractor = '{TRUSTED}' AND paper_id IS NOT NULL),
r AS (SELECT * FROM recs WHERE extractor <> '{TRUSTED}' AND coalesce(model_name, '') <> '') SELECT record_id FROM r WHERE EXISTS (SELECT 1 FROM l WHERE l.paper_id = r.paper_id AND contains(lower(l.label), lower(r.model_name))
  AND (coalesce(r.model_version, '') = '' OR contains(l.label, r.model_version)) AND (coalesce(r.parameters, '') = '' OR contains(l.label, r.parameters)))""")
def jn13_existing_names(spark, sf):
    """Records whose name and, where they are given, version and size a label of the trusted extractor on their paper holds (JN13).

    Names are led to the labels that hold them by joining the labels' pieces of the lengths that names have, so nothing is paired
    all with all.
    """
    r = recs(spark, sf).where(F.col("paper_id").isNotNull())
    l = r.where(F.col("extractor") == TRUSTED).select("paper_id", M.label().alias("label")).distinct().withColumn("outer", F.lower("label"))
    asked = r.where((F.col("extractor") != TRUSTED) & (F.coalesce("model_name", F.lit("")) != "")).select("record_id", "paper_id", "model_name", "model_version", "parameters", F.lower("model_name").alias("inner"))
    held = E.held_in(l.select("paper_id", "outer").distinct(), asked.select("paper_id", "inner").distinct())
    both = asked.join(held, ["paper_id", "inner"]).join(l, ["paper_id", "outer"])
    return both.where(in_label(F.col("label"), F.col("model_name"), F.col("model_version"), F.col("parameters"))).select("record_id").distinct()


@query(f"""WITH {S.PROPS}, l AS (SELECT paper_id, concat_ws(' ', model_name, nullif(model_version, ''), nullif(parameters, '')) AS label, prop_id, chunk_no, pos FROM props) SELECT paper_id, label, arg_min(prop_id, {{'a': chunk_no, 'b': pos, 'c': prop_id}}) AS prop_id FROM l GROUP BY 1, 2""")
def jn17_id_by_label(spark, sf):
    return props(spark, sf).groupBy("paper_id", M.label().alias("label")).agg(F.min_by("prop_id", F.struct("chunk_no", "pos", "prop_id")).alias("prop_id"))


_ASKED = """t AS (SELECT DISTINCT paper_title AS asked FROM gold_models WHERE paper_title IS NOT NULL UNION SELECT DISTINCT substr(paper_title, 1, 25) FROM gold_models WHERE length(paper_title) > 25 UNION SELECT DISTINCT title FROM papers WHERE title IS NOT NULL),
a AS (SELECT asked, lower(trim(asked)) AS q FROM t), g AS (SELECT gold_id, lower(trim(paper_title)) AS pt FROM gold_models WHERE paper_title IS NOT NULL)"""


@query(f"""WITH {_ASKED}, h AS (SELECT asked, gold_id, CASE WHEN pt = q THEN 0 ELSE 1 END AS tier FROM a JOIN g ON starts_with(pt, q)),
b AS (SELECT asked, min(tier) AS best FROM h GROUP BY 1), n AS (SELECT asked, tier, count(*) AS n_gold FROM h JOIN b USING (asked) WHERE tier = best GROUP BY 1, 2),
x AS (SELECT asked, count(*) FILTER (WHERE pt = q) AS n_exact FROM a LEFT JOIN g ON pt = q GROUP BY 1), e AS (SELECT count(*) AS every FROM gold_models)
SELECT asked, coalesce(tier, 2) AS tier, coalesce(n_gold, every) AS n_gold, CASE WHEN n_exact > 0 THEN 0 ELSE 2 END AS relaxed_tier, CASE WHEN n_exact > 0 THEN n_exact ELSE every END AS relaxed_n_gold FROM x CROSS JOIN e LEFT JOIN n USING (asked)""")
def f9_gold_of_title(spark, sf):
    """Reference records of a title: those that equal it, else those that begin with it, else all; relaxed: equal, else all."""
    g0 = gold(spark, sf)
    titles = g0.select("paper_title").where(F.col("paper_title").isNotNull())
    known = titles.select(F.col("paper_title").alias("asked")).union(titles.where(F.length("paper_title") > 25).select(F.substring("paper_title", 1, 25))).union(load(spark, sf, "papers").where("title is not null").select("title"))
    asked = known.distinct().withColumn("q", F.lower(F.trim("asked")))
    g = titles.select(F.lower(F.trim("paper_title")).alias("pt")).groupBy("pt").agg(F.count("*").alias("n"))
    # a title begins with the question: join on its heads of the lengths that are asked, none longer than the longest title
    lengths = F.array_sort(F.collect_set(F.length("q")))
    heads = g.join(F.broadcast(asked.agg(lengths.alias("ls")))).select("pt", "n", F.explode(F.filter("ls", lambda k: k <= F.length("pt"))).alias("k")).withColumn("q", F.substring(F.col("pt"), F.lit(1), F.col("k")))
    h = asked.join(heads, "q").withColumn("tier", F.when(F.col("pt") == F.col("q"), 0).otherwise(1))
    per = h.groupBy("asked").agg(F.sum(F.when(F.col("tier") == 0, F.col("n"))).alias("exact"), F.sum(F.when(F.col("tier") == 1, F.col("n"))).alias("begins"))
    every = F.broadcast(g0.agg(F.count("*").alias("every")))  # one row
    x = asked.join(per, "asked", "left").join(every)
    tier = F.when(F.col("exact").isNotNull(), 0).when(F.col("begins").isNotNull(), 1).otherwise(2)
    none = F.col("exact").isNull()
    return x.select("asked", tier.alias("tier"), F.coalesce("exact", "begins", "every").alias("n_gold"), F.when(none, 2).otherwise(0).alias("relaxed_tier"), F.when(none, F.col("every")).otherwise(F.col("exact")).alias("relaxed_n_gold"))


@query(f"""WITH {S.PAPERS} SELECT DISTINCT paper_id FROM pap WHERE lower(trim(title)) IN (SELECT lower(trim(paper_title)) FROM gold_models WHERE paper_title IS NOT NULL)""")
def jn14_existing_papers(spark, sf):
    """Papers that the catalog has already, by their title in any case (JN14)."""
    low = lambda c: F.lower(F.trim(c)).alias("t")
    return papers(spark, sf).select("paper_id", low("title")).join(gold(spark, sf).select(low("paper_title")), "t", "left_semi").select("paper_id").distinct()


# mapping ------------------------------------------------------------------------------------------------------------------

_PROPS = ", ".join(f"CASE WHEN {f} IS NOT NULL THEN {{'ord': {i}, 'property': '{p}', 'label': '{f}', 'value': CAST({f} AS VARCHAR)}} END" for i, (f, p) in enumerate(M.PROPERTIES.items()))
_LIST = f"list_filter([{_PROPS}], lambda x: x IS NOT NULL)"


@query(f"WITH {S.PROPS} SELECT prop_id, CAST(x.ord AS INT) AS ord, x.property AS property, x.label AS label, x.value AS value FROM (SELECT prop_id, unnest({_LIST}) AS x FROM props)")
def g1_properties(spark, sf):
    """Mapped fields of each record as properties in a fixed order (G1, JN16)."""
    return props(spark, sf).select("prop_id", F.inline(M.property_array()))


@query("""WITH m AS (SELECT DISTINCT ON (prop_id) prop_id, performance_metrics AS m FROM llm_properties WHERE performance_metrics IS NOT NULL) SELECT prop_id, array_to_string(list_transform(list_sort(map_entries(m)), lambda e: concat_ws(': ', e.key, e.value)), '; ') AS value, 'object' AS datatype FROM m""")
def g2_typed_values(spark, sf):
    r = load(spark, sf, "llm_properties").where(F.col("performance_metrics").isNotNull()).select("prop_id", "performance_metrics").dropDuplicates(["prop_id"])
    value, kind = M.typed_value(F.col("performance_metrics"), "map<string,string>")
    return r.select("prop_id", value.alias("value"), kind.alias("datatype"))


@query(f"WITH {S.PROPS} SELECT paper_id, chunk_no, count(*) AS n, count(*) > 1 AS multiple_models, CAST(sum(len({_LIST})) AS BIGINT) AS n_properties FROM props GROUP BY 1, 2")
def g3_envelopes(spark, sf):
    """Contributions of each answer with their number and whether there are several."""
    return props(spark, sf).groupBy("paper_id", "chunk_no").agg(F.count("*").alias("n"), (F.count("*") > 1).alias("multiple_models"), F.sum(F.size(M.property_array())).cast("bigint").alias("n_properties"))


@query(f"WITH {S.PROPS} SELECT prop_id, concat_ws(' ', model_name, nullif(model_version, ''), nullif(parameters, '')) AS label FROM props")
def g4_labels(spark, sf):
    return props(spark, sf).select("prop_id", M.label().alias("label"))


@query(f"""WITH {S.PROPS}, x AS (SELECT paper_id, chunk_no, pos, prop_id, unnest({_LIST}) AS x FROM props), u AS (SELECT paper_id, chunk_no, pos, prop_id, x.ord AS ord, x.property AS property, x.value AS value FROM x WHERE {S.strip('x.value')} <> '' AND lower({S.strip('x.value')}) <> 'none')
SELECT paper_id, prop_id, CAST(ord AS INT) AS ord, property, value, CASE WHEN starts_with(value, 'http') THEN value ELSE '#literal_' || CAST(coalesce(sum(CASE WHEN starts_with(value, 'http') THEN 0 ELSE 1 END) OVER (PARTITION BY paper_id ORDER BY chunk_no, pos, prop_id, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) END AS reference,
  CASE WHEN NOT starts_with(value, 'http') THEN 'xsd:string' END AS data_type FROM u""")
def g5_statements(spark, sf):
    """Statements of each record with literals numbered through its paper."""
    return M.statements(props(spark, sf))


@query(f"""WITH {S.PROPS}, n AS (SELECT prop_id, paper_id, lower(trim(model_name)) AS nm, lower(trim(model_family)) AS fam FROM props), g AS (SELECT DISTINCT paper_id, lower(trim(model_name)) AS nm FROM gold_models), f AS (SELECT DISTINCT paper_id, lower(trim(model_family)) AS fam FROM gold_models)
SELECT prop_id, CASE WHEN g.nm IS NOT NULL THEN 'skip' WHEN f.fam IS NOT NULL THEN 'update' ELSE 'add' END AS action FROM n LEFT JOIN g ON g.paper_id = n.paper_id AND g.nm = n.nm LEFT JOIN f ON f.paper_id = n.paper_id AND f.fam = n.fam""")
def g13_merge_plan(spark, sf):
    """What an update of the catalog does with each record: skip one that is there, update one whose family is, add the rest."""
    low = lambda c: F.lower(F.trim(c))
    n = props(spark, sf).select("prop_id", "paper_id", low("model_name").alias("nm"), low("model_family").alias("fam"))
    have = lambda c, name: gold(spark, sf).select("paper_id", low(c).alias(name)).distinct().withColumn(f"has_{name}", F.lit(True))
    x = n.join(have("model_name", "nm"), ["paper_id", "nm"], "left").join(have("model_family", "fam"), ["paper_id", "fam"], "left")
    return x.select("prop_id", F.when(F.col("has_nm"), "skip").when(F.col("has_fam"), "update").otherwise("add").alias("action"))


@query(f"""WITH {S.PROPS} SELECT prop_id, model_name IS NOT NULL AS has_label, len({_LIST}) = 0 AS no_properties FROM props""")
def f15_check_mapping(spark, sf):
    return props(spark, sf).select("prop_id", F.col("model_name").isNotNull().alias("has_label"), (F.size(M.property_array()) == 0).alias("no_properties"))


@query(f"WITH {S.PROPS}, {S.PAPERS} SELECT prop_id, coalesce(nullif(paper_title, ''), title, 'LLM Extraction: ' || model_name, pdf_url) AS title FROM props LEFT JOIN pap USING (paper_id)")
def g11_titles(spark, sf):
    p = papers(spark, sf).select("paper_id", "title", "pdf_url")
    t = F.coalesce(F.nullif("paper_title", F.lit("")), "title", F.concat(F.lit("LLM Extraction: "), F.col("model_name")), "pdf_url")
    return props(spark, sf).select("prop_id", "paper_id", "paper_title", "model_name").join(p, "paper_id", "left").select("prop_id", t.alias("title"))


# datasets -----------------------------------------------------------------------------------------------------------------


def _in(f: str) -> str:
    v = f"lower({S.strip(f'CAST({f} AS VARCHAR)')})"
    if f in D.NAMED:
        hit = f"(len(list_filter(string_split_regex(replace({v}, ',', ' '), '{S.WS}+'), lambda w: length(w) >= 2 AND contains(chunk, w))) > 0 OR contains(chunk, {v}))"
    else:
        words = f"list_filter(string_split_regex({v}, '{S.WS}+'), lambda w: length(w) > 2 AND w NOT IN ({', '.join(repr(w) for w in D.STOP)}))"
        hit = f"(len({words}) > 0 AND len(list_filter({words}, lambda w: contains(chunk, w))) * 10 >= len({words}) * 4)"
    return f"coalesce({v} <> '' AND {hit}, false)"


_CHUNKS = """RECURSIVE c AS (SELECT doc_id, paper_id, text, length(text) AS n, 0 AS start, 0 AS stop, -1 AS k FROM documents WHERE text IS NOT NULL AND paper_id IN (SELECT paper_id FROM gold_models)
  UNION ALL SELECT doc_id, paper_id, text, n, nxt, CASE WHEN n <= 8000 THEN n WHEN nxt + 8000 < n AND hit > 0 THEN greatest(nxt, nxt + 7800) + length(tail) - hit ELSE nxt + 8000 END, k + 1
  FROM (SELECT *, substr(text, greatest(nxt, nxt + 7800) + 1, 200) AS tail, instr(reverse(substr(text, greatest(nxt, nxt + 7800) + 1, 200)), ' .') AS hit FROM (SELECT doc_id, paper_id, text, n, k, CASE WHEN k < 0 THEN 0 ELSE stop - 500 END AS nxt, k >= 0 AND n <= 8000 AS over FROM c) WHERE nxt < n AND NOT over))"""
_HITS = ", ".join(f"CASE WHEN {_in(f)} THEN '{f}' END" for f in E.FIELDS)


@query(f"""WITH {_CHUNKS}, ch AS (SELECT doc_id, paper_id AS pid, k AS chunk_no, trim(regexp_replace(lower(substr(text, start + 1, least(stop, n) - start)), '{S.WS}+', ' ', 'g')) AS chunk FROM c WHERE k >= 0),
x AS (SELECT gold_id, doc_id, chunk_no, len(list_filter([{_HITS}], lambda h: h IS NOT NULL)) AS n_filled FROM gold_models g JOIN ch ON ch.pid = g.paper_id) SELECT gold_id, doc_id, CAST(chunk_no AS INT) AS chunk_no, CAST(n_filled AS INT) AS n_filled FROM x WHERE n_filled >= 1""")
def f11_instances(spark, sf):
    """Chunks of a paper with the reference records that they mention (JN6, F11, F12, G8)."""
    return D.instances(gold(spark, sf), load(spark, sf, "documents"), least=1).select("gold_id", "doc_id", "chunk_no", "n_filled")


@query("""WITH t AS (SELECT DISTINCT paper_title FROM gold_models WHERE paper_title IS NOT NULL), r AS (SELECT paper_title, row_number() OVER (ORDER BY md5(paper_title), paper_title) AS rk, count(*) OVER () AS n FROM t)
SELECT paper_title, CASE WHEN rk <= greatest(1, floor(n * 0.15)) THEN 'test' WHEN rk <= greatest(1, floor(n * 0.15)) + greatest(1, floor(n * 0.1)) THEN 'val' ELSE 'train' END AS split FROM r""")
def p_split_by_paper(spark, sf):
    """Titles dealt to test, validation and training, no paper in two of them."""
    return D.split_titles(gold(spark, sf))


@query("""SELECT gold_id, 'system: Extract the model.' || chr(10) || 'user: ' || coalesce(innovation, '') || chr(10) || 'assistant: ' || coalesce(model_name, '') AS chat, row_number() OVER (ORDER BY md5(CAST(gold_id AS VARCHAR))) AS place FROM gold_models""")
def g10_shuffled_chats(spark, sf):
    """Training instances as chats in a shuffled order that any run repeats."""
    chat = F.concat_ws("\n", F.lit("system: Extract the model."), F.concat(F.lit("user: "), F.coalesce("innovation", F.lit(""))), F.concat(F.lit("assistant: "), F.coalesce("model_name", F.lit(""))))
    g = gold(spark, sf).select("gold_id", F.col("gold_id").cast("string").alias("k"), chat.alias("chat"))
    return g.join(D.rank_by_hash(g, "k"), "k").select("gold_id", "chat", F.col("rk").alias("place"))


@query(f"""SELECT paper_id, CASE WHEN min(arxiv_id) IS NOT NULL THEN replace(min(arxiv_id), '/', '_') ELSE substr({_SLUG('min(title)')}, 1, 80) END || '_' || strftime(min(ingested_at), '%Y%m%d_%H%M%S') || '.json' AS name FROM papers GROUP BY 1""")
def k1_result_names(spark, sf):
    """Names of result files: id or, of a paper known by its title only, the title's slug, and the time (K1, K2)."""
    p = load(spark, sf, "papers").groupBy("paper_id").agg(F.min("arxiv_id").alias("a"), F.min("title").alias("t"), F.min("ingested_at").alias("at"))
    head = F.when(F.col("a").isNotNull(), F.replace("a", F.lit("/"), F.lit("_"))).otherwise(F.substring(slug(F.col("t")), 1, 80))
    return p.select("paper_id", F.concat(head, F.lit("_"), F.date_format("at", "yyyyMMdd_HHmmss"), F.lit(".json")).alias("name"))


@query(f"WITH {S.PAPERS}, f AS (SELECT DISTINCT * EXCLUDE (ingested_at, payload) FROM extraction_files), m AS (SELECT *, split_part(folder, '__', 1) AS model FROM f) SELECT file_id, regexp_replace(lower(model), '[^a-z0-9]+', '_', 'g') || '/' || replace(file_name, '/', '_') AS path FROM (SELECT *, row_number() OVER (PARTITION BY model, file_name ORDER BY written_at DESC, file_id) AS rn FROM m) WHERE rn = 1")
def k3_newest_by_model(spark, sf):
    """Where result files go: one folder for each model, of several files of one name the newest (K3)."""
    f = files(spark, sf).select("file_id", "file_name", "written_at", F.element_at(F.split("folder", "__"), 1).alias("model"))
    w = Window.partitionBy("model", "file_name").orderBy(F.col("written_at").desc(), "file_id")
    return f.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("file_id", F.concat_ws("/", slug(F.col("model")), F.replace("file_name", F.lit("/"), F.lit("_"))).alias("path"))


@query()
def i8_pipeline(spark, sf):
    """The whole chain with a deterministic extractor in place of a model: text, chunks, records, selection, merging."""
    from recordloom.operators import infer

    return infer.pipeline(load(spark, sf, "documents"))


_RAW_CHUNKS = """RECURSIVE c AS (SELECT doc_id, paper_id, text, length(text) AS n, 0 AS start, 0 AS stop, -1 AS k FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, paper_id, text, n, nxt, CASE WHEN n <= 20000 THEN n WHEN nxt + 20000 < n AND hit > 0 THEN nxt + 19800 + length(tail) - hit ELSE nxt + 20000 END, k + 1
  FROM (SELECT *, substr(text, nxt + 19801, 200) AS tail, instr(reverse(substr(text, nxt + 19801, 200)), ' .') AS hit FROM (SELECT doc_id, paper_id, text, n, k, CASE WHEN k < 0 THEN 0 ELSE stop - 500 END AS nxt, k >= 0 AND n <= 20000 AS over FROM c) WHERE nxt < n AND NOT over)),
s AS (SELECT doc_id, paper_id, CAST(k AS INT) AS chunk_no, list_distinct(regexp_extract_all(substr(text, start + 1, least(stop, n) - start), '([A-Z][a-z]{5,}-\\d+(?:\\.\\d+)?B)')) AS found FROM c WHERE k >= 0)"""


@query(f"""WITH {_RAW_CHUNKS} SELECT paper_id, doc_id, chunk_no, unnest(found) AS model_name, split_part(unnest(found), '-', 1) AS model_family, split_part(unnest(found), '-', 2) AS parameters FROM s""")
def i13_raw_pipeline(spark, sf):
    """The chain of a batch job with a deterministic extractor in place of a model: parse, chunk, extract, nothing merged."""
    from recordloom.operators import infer

    return infer.raw_pipeline(load(spark, sf, "documents")).drop("pos")


@query(r"""SELECT doc_id, len(list_distinct(regexp_extract_all(text, '([A-Z][a-z]{5,}-\d+(?:\.\d+)?B)'))) AS n_models FROM documents WHERE text IS NOT NULL""")
def i1_stub_extract(spark, sf):
    """How many models the deterministic extractor finds in each document."""
    from recordloom.operators import infer

    return load(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", F.size(F.array_distinct(infer.mentions(F.col("text")))).cast("bigint").alias("n_models"))
