"""Queries on sources, document text and answers of a model: survey groups S, T and J."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import names as N
from recordloom.functions import text as X
from recordloom.missing import is_missing_m1, trim_all
from recordloom.operators import answers as J
from recordloom.plans import sqlx as S
from recordloom.plans.registry import Registry
from recordloom.session import load

query = Registry()


def papers(spark: SparkSession, sf: str) -> DataFrame:
    """Papers, those delivered twice once."""
    return load(spark, sf, "papers").drop("ingested_at").dropDuplicates(["paper_id"])


def props(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "llm_properties").drop("ingested_at").dropDuplicates(["prop_id"])


def files(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "extraction_files").drop("ingested_at").dropDuplicates(["file_id"])


# sources ------------------------------------------------------------------------------------------------------------------


@query(f"WITH {S.PAPERS} SELECT paper_id, split_part(arxiv_id, 'v', 1) AS clean_id, 'https://papers.invalid/pdf/' || split_part(arxiv_id, 'v', 1) AS wanted_url FROM pap")
def s1_clean_id(spark, sf):
    clean = F.split_part("arxiv_id", F.lit("v"), F.lit(1))
    return papers(spark, sf).select("paper_id", clean.alias("clean_id"), F.concat(F.lit("https://papers.invalid/pdf/"), clean).alias("wanted_url"))


@query(f"""WITH {S.PAPERS} SELECT paper_id, title, published, primary_category FROM pap WHERE list_has_any(categories, ['zz.CL', 'zz.LG']) ORDER BY published DESC NULLS LAST, paper_id LIMIT 50""")
def s2_search(spark, sf):
    """Search by category, latest first: the limit is the feature."""
    hit = papers(spark, sf).where(F.arrays_overlap("categories", F.array(F.lit("zz.CL"), F.lit("zz.LG"))))
    return hit.orderBy(F.col("published").desc_nulls_last(), "paper_id").limit(50).select("paper_id", "title", "published", "primary_category")


@query(rf"""WITH {S.PAPERS}, u AS (SELECT paper_id, rtrim(pdf_url, '/') || '.pdf' AS url FROM pap) SELECT paper_id, regexp_replace(list_last(string_split(url, '/')), '[^\w\-_.]', '_', 'g') AS file_name FROM u WHERE url IS NOT NULL""")
def s4_file_name(spark, sf):
    url = F.concat(F.regexp_replace("pdf_url", "/+$", ""), F.lit(".pdf"))
    return papers(spark, sf).where(F.col("pdf_url").isNotNull()).select("paper_id", F.regexp_replace(F.element_at(F.split(url, "/"), -1), r"[^\w\-_.]", "_").alias("file_name"))


@query(f"""WITH {S.PAPERS} SELECT primary_category, count(*) AS wanted, count(doi) AS fetched, count(*) - count(doi) AS missing FROM pap GROUP BY 1""")
def s5_fetch_counts(spark, sf):
    return papers(spark, sf).groupBy("primary_category").agg(F.count("*").alias("wanted"), F.count("doi").alias("fetched"), (F.count("*") - F.count("doi")).alias("missing"))


@query(f"""WITH {S.PAPERS} SELECT paper_id, CASE WHEN length(trim(coalesce(abstract, ''))) < 100 THEN title ELSE abstract END AS text, length(trim(coalesce(abstract, ''))) < 100 AS fell_back FROM pap""")
def s7_fallback_text(spark, sf):
    short = F.length(F.trim(F.coalesce("abstract", F.lit("")))) < 100
    return papers(spark, sf).select("paper_id", F.when(short, F.col("title")).otherwise(F.col("abstract")).alias("text"), short.alias("fell_back"))


@query("""WITH f AS (SELECT DISTINCT * EXCLUDE (ingested_at) FROM extraction_files)
SELECT file_id, file_name FROM f WHERE ends_with(file_name, '.json') AND NOT contains(lower(file_name), 'summary') AND NOT contains(lower(file_name), 'evaluation')""")
def s9_result_files(spark, sf):
    n = F.lower("file_name")
    return files(spark, sf).where(F.col("file_name").endswith(".json") & ~n.contains("summary") & ~n.contains("evaluation")).select("file_id", "file_name")


@query("""WITH f AS (SELECT DISTINCT ON (file_id) file_id, payload::JSON AS j FROM extraction_files)
SELECT file_id, CASE WHEN json_array_length(j->'extraction_data') > 0 THEN 'A' WHEN json_array_length(j->'raw_extraction') > 0 THEN 'B' ELSE 'none' END AS layout,
  CAST(coalesce(nullif(json_array_length(j->'extraction_data'), 0), json_array_length(j->'raw_extraction'), 0) AS BIGINT) AS n_records, j->>'arxiv_id' AS arxiv_id FROM f""")
def s10_layouts(spark, sf):
    """Both layouts of a result file read as one: the first array that is there and not empty."""
    v = F.try_parse_json("payload")
    a, b = (F.size(F.try_variant_get(v, f"$.{k}", "array<variant>")) for k in ("extraction_data", "raw_extraction"))
    layout = F.when(a > 0, "A").when(b > 0, "B").otherwise("none")
    n = F.when(a > 0, a).when(b > 0, b).otherwise(0).cast("bigint")
    return files(spark, sf).select("file_id", layout.alias("layout"), n.alias("n_records"), F.try_variant_get(v, "$.arxiv_id", "string").alias("arxiv_id"))


@query(f"WITH {S.PAPERS} SELECT n, arxiv_id FROM (SELECT arxiv_id, row_number() OVER (ORDER BY paper_id) AS n FROM pap) WHERE n = 7")
def s17_nth_paper(spark, sf):
    """The n-th line of the list of papers: ids in order, all but the n-th dropped."""
    return papers(spark, sf).select("paper_id", "arxiv_id").orderBy("paper_id").offset(6).limit(1).select(F.lit(7).cast("bigint").alias("n"), "arxiv_id")


@query("SELECT DISTINCT arxiv_id FROM papers WHERE arxiv_id IS NOT NULL")
def s18_distinct_ids(spark, sf):
    return load(spark, sf, "papers").select("arxiv_id").where(F.col("arxiv_id").isNotNull()).distinct()


@query(rf"""WITH {S.PAPERS}, h AS (SELECT paper_id, lower(regexp_extract(CASE WHEN contains(pdf_url, '://') THEN pdf_url ELSE 'https://' || pdf_url END, '://([^/:]+)', 1)) AS host FROM pap)
SELECT paper_id, CASE host WHEN 'papers.invalid' THEN 'production' WHEN 'sandbox.papers.invalid' THEN 'sandbox' WHEN 'incubating.papers.invalid' THEN 'incubating' ELSE 'sandbox' END AS host_key FROM h""")
def s15_host_key(spark, sf):
    """Name or URL of a store to its key; unknown ones go to the sandbox."""
    return papers(spark, sf).select("paper_id", J.host_key(F.col("pdf_url"), "papers.invalid").alias("host_key"))


# text ---------------------------------------------------------------------------------------------------------------------

_URL = r"https?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
_CLEAN = f"cleaned AS (SELECT doc_id, {S.strip(f'''regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '{S.WS}+', ' ', 'g'), '{_URL}', '', 'g'), '[^ ]+@[^ ]+', '', 'g')''')} AS cleaned FROM documents)"


@query(f"WITH {_CLEAN} SELECT doc_id, cleaned FROM cleaned")
def t1_clean_text(spark, sf):
    return load(spark, sf, "documents").select("doc_id", X.clean_text(F.col("text")).alias("cleaned"))


def _sec(word: str) -> str:
    inner = f"substr({S.strip(f'''regexp_extract(cleaned, '(?is){word}{S.WS}*(.*)$', 1)''')}, 1, 5000)"
    return f"CASE WHEN regexp_matches(cleaned, '(?is){word}') THEN {inner} END"


@query(f"""WITH {_CLEAN} SELECT doc_id, {_sec('introduction')} AS introduction, {_sec('(?:methods?|methodology)')} AS methods, {_sec('results?')} AS results, {_sec('conclusions?')} AS conclusion FROM cleaned""")
def t2_sections(spark, sf):
    c = load(spark, sf, "documents").select("doc_id", X.clean_text(F.col("text")).alias("cleaned"))
    return c.select("doc_id", *[X.section(F.col("cleaned"), s).alias(s) for s in X.SECTIONS])


_ROWS = "[['field', 'value'], ['title', title], ['ids', arxiv_id, doi], [primary_category, array_to_string(categories, '|')]]"
_CELL = lambda x: f"replace(replace({S.strip(f'''coalesce({x}, '')''')}, '|', '\\|'), chr(10), ' ')"


@query(f"""WITH {S.PAPERS}, t AS (SELECT paper_id, {_ROWS} AS t FROM pap), w AS (SELECT paper_id, t, list_max(list_transform(t, lambda r: len(r))) AS n FROM t),
l AS (SELECT paper_id, n, list_transform(t, lambda r: '| ' || array_to_string(list_transform(list_resize(r, n), lambda x: {_CELL('x')}), ' | ') || ' |') AS l FROM w)
SELECT paper_id, l[1] || chr(10) || '|' || repeat('---|', n) || chr(10) || array_to_string(l[2:], chr(10)) AS markdown FROM l""")
def t3_table_markdown(spark, sf):
    a = lambda *c: F.array(*c)
    t = a(a(F.lit("field"), F.lit("value")), a(F.lit("title"), F.col("title")), a(F.lit("ids"), F.col("arxiv_id"), F.col("doi")), a(F.col("primary_category"), F.array_join("categories", "|")))
    return papers(spark, sf).select("paper_id", X.table_markdown(t).alias("markdown"))


@query(f"""WITH {_CLEAN}, b AS (SELECT c.doc_id, CASE WHEN d.section IS NULL THEN cleaned ELSE cleaned || chr(10) || chr(10) || '[TABLES FROM DOCUMENT]' || chr(10) || chr(10) || '| ' || d.section || ' |' || chr(10) || chr(10) || '[END TABLES]' || chr(10) || chr(10) END AS body FROM cleaned c JOIN documents d USING (doc_id))
SELECT doc_id, CAST(length(body) AS INT) AS text_length, CAST(CASE WHEN {S.strip('body')} = '' THEN 0 ELSE len(string_split_regex({S.strip('body')}, '{S.WS}+')) END AS INT) AS word_count FROM b""")
def t5_counts(spark, sf):
    """Length and words of a text with its tables appended between delimiters."""
    d = load(spark, sf, "documents")
    table = F.concat(F.lit(X.TABLES_START), F.lit("| "), F.col("section"), F.lit(" |"), F.lit(X.TABLES_END))
    body = F.concat(X.clean_text(F.col("text")), F.coalesce(table, F.lit("")))
    return d.select("doc_id", body.alias("body")).select("doc_id", F.length("body").alias("text_length"), X.word_count(F.col("body")).cast("int").alias("word_count"))


@query("""WITH RECURSIVE c AS (
  SELECT doc_id, text, length(text) AS n, 0 AS start, 0 AS stop, -1 AS k FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, text, n, nxt, CASE WHEN n <= 1500 THEN n WHEN nxt + 1500 < n AND hit > 0 THEN greatest(nxt, nxt + 1300) + length(tail) - hit ELSE nxt + 1500 END, k + 1
  FROM (SELECT *, substr(text, greatest(nxt, nxt + 1300) + 1, 200) AS tail, instr(reverse(substr(text, greatest(nxt, nxt + 1300) + 1, 200)), ' .') AS hit
        FROM (SELECT doc_id, text, n, k, CASE WHEN k < 0 THEN 0 ELSE stop - 100 END AS nxt, CASE WHEN k >= 0 AND n <= 1500 THEN true ELSE false END AS over FROM c) WHERE nxt < n AND NOT over)
) SELECT doc_id, CAST(k AS INT) AS chunk_no, CAST(start AS INT) AS start_pos, md5(substr(text, start + 1, least(stop, n) - start)) AS chunk_md5 FROM c WHERE k >= 0
UNION ALL SELECT doc_id, 0, 0, md5('') FROM documents WHERE text = ''""")
def t6_chunks(spark, sf):
    """Overlapping chunks that end after a sentence where one ends near."""
    d = load(spark, sf, "documents").where(F.col("text").isNotNull())
    return X.chunked(d.select("doc_id", "text"), "text", 1_500, 100).select("doc_id", "chunk_no", "start_pos", F.md5("chunk").alias("chunk_md5"))


@query(rf"""SELECT doc_id, {S.strip(r"nullif(regexp_extract(text, '^([^\n]+)\n', 1), '')")} AS title, nullif(regexp_extract(substr(text, 1, 1000), '(?:^|[^\p{{L}}\p{{N}}_])(20\d{{2}})(?:$|[^\p{{L}}\p{{N}}_])', 1), '') AS year,
  nullif(regexp_extract(substr(text, 1, 2000), 'arXiv:(\d+\.\d+)', 1), '') AS arxiv_id FROM documents""")
def t7_metadata(spark, sf):
    t = F.col("text")
    n = lambda c: F.nullif(c, F.lit(""))
    return load(spark, sf, "documents").select(
        "doc_id", trim_all(n(F.regexp_extract(t, r"\A([^\n]+)\n", 1))).alias("title"), n(F.regexp_extract(F.substring(t, 1, 1_000), r"(?<![\p{L}\p{N}_])(20\d{2})(?![\p{L}\p{N}_])", 1)).alias("year"),
        n(F.regexp_extract(F.substring(t, 1, 2_000), r"arXiv:(\d+\.\d+)", 1)).alias("arxiv_id"),
    )


@query(f"""WITH {S.PAPERS} SELECT d.doc_id, md5(CASE WHEN p.paper_id IS NULL THEN '' ELSE 'PAPER METADATA:' || chr(10) || 'Title: ' || coalesce(p.title, 'Unknown') || chr(10) || 'Authored: ' || coalesce(substr(p.published, 1, 4), '') || '-' || coalesce(substr(p.published, 6, 2), '') || chr(10)
  || 'Authors: ' || array_to_string(p.authors, ', ') || chr(10) || chr(10) || chr(10) || 'PAPER CONTENT:' || chr(10) END || substr(d.text, 1, 65000)) AS prompt_md5 FROM documents d LEFT JOIN pap p USING (paper_id) WHERE d.text IS NOT NULL""")
def t9_prompts(spark, sf):
    """Document snippets with the metadata of their paper in front."""
    d = load(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", "paper_id", "text")
    p = papers(spark, sf).select("paper_id", "title", "published", "authors", F.lit(True).alias("found"))
    empty = F.lit("")
    head = F.concat(
        F.lit("PAPER METADATA:\nTitle: "), F.coalesce("title", F.lit("Unknown")), F.lit("\nAuthored: "), F.coalesce(F.substring("published", 1, 4), empty), F.lit("-"), F.coalesce(F.substring("published", 6, 2), empty),
        F.lit("\nAuthors: "), F.array_join("authors", ", "), F.lit("\n\n\nPAPER CONTENT:\n"),
    )
    return d.join(p, "paper_id", "left").select("doc_id", F.md5(F.concat(F.when(F.col("found"), head).otherwise(empty), F.substring("text", 1, X.SNIPPET))).alias("prompt_md5"))


@query("SELECT doc_id, md5(substr(text, 1, 65000)) AS long_md5, md5(substr(text, 1, 8000)) AS short_md5, length(text) > 8000 AS is_cut FROM documents WHERE text IS NOT NULL")
def t8_snippets(spark, sf):
    """What a prompt shows of a text: 65,000 characters, or 8,000 for a small model: the limits are the feature."""
    t = F.col("text")
    return load(spark, sf, "documents").where(t.isNotNull()).select("doc_id", F.md5(F.substring(t, 1, X.SNIPPET)).alias("long_md5"), F.md5(F.substring(t, 1, X.SHORT_SNIPPET)).alias("short_md5"), (F.length(t) > X.SHORT_SNIPPET).alias("is_cut"))


_EXAMPLES = [("We present Foo, a 7B decoder.", '{"models": [{"model_name": "Foo", "parameters": "7B"}]}'), ("Foo comes in 7B and 70B.", '{"models": [{"model_name": "Foo", "parameters": "7B, 70B"}]}'), ("We compare with Bar.", '{"models": []}'), ("Foo-2 extends Foo.", '{"models": [{"model_name": "Foo-2", "extension": "Foo"}]}')]
_SHOWN = " || ".join(f"chr(10) || 'user: {u}' || chr(10) || 'assistant: {a}'" for u, a in _EXAMPLES)


@query(f"""SELECT doc_id, 'system: Extract model records as JSON.' || {_SHOWN} || chr(10) || 'user: ' || substr(text, 1, 65000) AS chat FROM documents WHERE text IS NOT NULL""")
def t10_messages(spark, sf):
    """A chat for each document: instruction, four worked examples, the text."""
    return load(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", J.messages(F.substring("text", 1, X.SNIPPET), "Extract model records as JSON.", _EXAMPLES).alias("m")).select(
        "doc_id", F.array_join(F.transform("m", lambda x: F.concat_ws(": ", x["role"], x["content"])), "\n").alias("chat")
    )


@query("""SELECT extractor, CASE WHEN contains(lower(extractor), 'instruct') OR contains(lower(extractor), 'chat') THEN 'chat' ELSE 'plain' END AS prompt_kind FROM extractors""")
def t11_prompt_kind(spark, sf):
    return load(spark, sf, "extractors").select("extractor", J.prompt_kind(F.col("extractor")).alias("prompt_kind"))


@query(rf"""WITH {S.PAPERS} SELECT paper_id, CASE WHEN title IS NULL OR {S.strip('title')} = '' OR {(sl := rf"regexp_replace(regexp_replace(regexp_replace(lower({S.strip('title')}), '[^\p{{L}}\p{{N}}_\s-]', '', 'g'), '[-\s]+', '_', 'g'), '^_+|_+$', '', 'g')")} = '' THEN 'untitled' ELSE substr({sl}, 1, 80) END AS slug_a,
  substr(regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 100) AS slug_b FROM pap""")
def t12_slugs(spark, sf):
    return papers(spark, sf).select("paper_id", X.slug_title(F.col("title")).alias("slug_a"), X.slug(F.col("title")).alias("slug_b"))


@query(rf"""WITH {S.PAPERS} SELECT paper_id, try_cast(substr(published, 1, 4) AS INT) AS year, CASE WHEN try_cast(substr(published, 6, 2) AS INT) BETWEEN 1 AND 12 THEN try_cast(substr(published, 6, 2) AS INT) END AS month,
  nullif('20' || regexp_extract(pdf_url, '(\d{{2}})(\d{{2}})\.\d+', 1), '20') AS url_year, nullif(regexp_extract(pdf_url, '(\d{{2}})(\d{{2}})\.\d+', 2), '') AS url_month FROM pap""")
def t14_year_month(spark, sf):
    p, n = r"(\d{2})(\d{2})\.\d+", F.nullif
    return papers(spark, sf).select(
        "paper_id", X.iso_year(F.col("published")).alias("year"), X.iso_month(F.col("published")).alias("month"),
        n(F.concat(F.lit("20"), F.regexp_extract("pdf_url", p, 1)), F.lit("20")).alias("url_year"), n(F.regexp_extract("pdf_url", p, 2), F.lit("")).alias("url_month"),
    )


@query(rf"""WITH {S.PAPERS}, u AS (SELECT paper_id, CASE WHEN doi IS NULL THEN '  ' || pdf_url || ' sbatch run.sh' ELSE pdf_url || chr(10) || 'second line' END AS raw FROM pap),
v AS (SELECT paper_id, trim(string_split_regex(trim(string_split_regex(regexp_replace(trim(raw), '[\x00-\x09\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '[\n\r]')[1]), 'sbatch|srun')[1]) AS url FROM u)
SELECT paper_id, CASE WHEN starts_with(url, 'http://') OR starts_with(url, 'https://') THEN url END AS url FROM v""")
def t16_clean_url(spark, sf):
    raw = F.when(F.col("doi").isNull(), F.concat(F.lit("  "), F.col("pdf_url"), F.lit(" sbatch run.sh"))).otherwise(F.concat(F.col("pdf_url"), F.lit("\nsecond line")))
    return papers(spark, sf).select("paper_id", X.clean_url(raw).alias("url"))


@query("""WITH r AS (SELECT doc_id, CASE WHEN lang = 'en' THEN text ELSE repeat('a', 120) || '{' || text END AS answer FROM documents WHERE text IS NOT NULL)
SELECT doc_id, md5(CASE WHEN length(answer) > 50 AND len(list_distinct(regexp_extract_all(substr(answer, 1, 100), '(?s).'))) < 3 AND instr(answer, '{') > 0 THEN substr(answer, 1, instr(answer, '{') + 999) ELSE answer END) AS answer_md5 FROM r""")
def t17_repetition(spark, sf):
    answer = F.when(F.col("lang").eqNullSafe("en"), F.col("text")).otherwise(F.concat(F.repeat(F.lit("a"), 120), F.lit("{"), F.col("text")))
    return load(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", F.md5(X.stop_repetition(answer)).alias("answer_md5"))


@query(f"WITH {S.PAPERS} SELECT paper_id, trim(regexp_replace(lower(title), '{S.WS}+', ' ', 'g')) AS squashed FROM pap")
def t18_squash(spark, sf):
    return papers(spark, sf).select("paper_id", X.squash(F.col("title")).alias("squashed"))


# answers ------------------------------------------------------------------------------------------------------------------

_FILES = "f AS (SELECT DISTINCT ON (file_id) file_id, payload FROM extraction_files WHERE payload IS NOT NULL)"
_ANSWER = """a AS (SELECT file_id, payload, CASE length(payload) % 4 WHEN 0 THEN '<think>plan {x} a</think>' || payload || ' Note: done' WHEN 1 THEN 'echo {1}<|assistant|>```json' || chr(10) || payload || chr(10) || '```' WHEN 2 THEN 'text ```' || chr(10) || payload || '```' ELSE payload || '<think>open {' END AS answer FROM f)"""


def _answers(spark, sf):
    kind, p = F.length("payload") % 4, F.col("payload")
    answer = (
        F.when(kind == 0, F.concat(F.lit("<think>plan {x} a</think>"), p, F.lit(" Note: done"))).when(kind == 1, F.concat(F.lit("echo {1}<|assistant|>```json\n"), p, F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit("text ```\n"), p, F.lit("```"))).otherwise(F.concat(p, F.lit("<think>open {")))
    )
    return files(spark, sf).where(p.isNotNull()).select("file_id", "payload", answer.alias("answer"))


_ISOLATED = f"""{_FILES}, {_ANSWER},
b AS (SELECT file_id, CASE WHEN contains(answer, '<|assistant|>') THEN list_last(string_split(answer, '<|assistant|>')) ELSE answer END AS s FROM a),
c AS (SELECT file_id, regexp_replace(regexp_replace(s, '(?s)<think>.*?</think>', '', 'g'), '(?s)<think>.*$', '') AS s FROM b),
d AS (SELECT file_id, CASE WHEN contains(s, '```json') THEN {S.strip("string_split(string_split(s, '```json')[2], '```')[1]")} WHEN contains(s, '```') THEN {S.strip("string_split(s, '```')[2]")} ELSE s END AS s FROM c),
e AS (SELECT file_id, substr(s, instr(s, '{{')) AS s FROM d WHERE instr(s, '{{') > 0),
g AS (SELECT file_id, s, regexp_extract_all(s, '[{{}}]') AS br, string_split_regex(s, '[{{}}]') AS pc FROM e),
h AS (SELECT file_id, s, pc, list_transform(br, lambda x: CASE x WHEN '{{' THEN 1 ELSE -1 END) AS sg FROM g),
k AS (SELECT file_id, s, pc, list_filter(range(1, len(sg) + 1), lambda i: list_sum(sg[1:i]) = 0)[1] AS hit FROM h),
iso AS (SELECT file_id, CASE WHEN hit IS NOT NULL THEN substr(s, 1, CAST(list_sum(list_transform(pc[1:hit], lambda x: length(x))) + hit AS BIGINT)) ELSE substr(s, 1, length(s) - instr(reverse(s), '}}') + 1) END AS s FROM k)"""


@query(f"WITH {_ISOLATED} SELECT file_id, md5(s) AS json_md5 FROM iso")
def j1_isolate(spark, sf):
    """The JSON object in an answer that thinks, echoes, fences or talks around it."""
    return _answers(spark, sf).select("file_id", J.isolate(F.col("answer")).alias("j")).where(F.col("j").isNotNull()).select("file_id", F.md5("j").alias("json_md5"))


@query(f"""WITH {_FILES} SELECT file_id, length(payload) % 3 <> 0 AS parsed FROM f""")
def j2_strict_parse(spark, sf):
    """Whether a text parses as it stands; cut ones do not."""
    p = F.when(F.length("payload") % 3 == 0, F.expr("left(payload, length(payload) - 3)")).otherwise(F.col("payload"))
    return files(spark, sf).where(F.col("payload").isNotNull()).select("file_id", F.try_parse_json(p).isNotNull().alias("parsed"))


@query()
def j3_repair(spark, sf):
    """Broken answers (cut, keys without quotes, quotes inside values) repaired: only those that do not parse as they stand go through Python."""
    p = F.when(F.length("payload") % 3 == 0, F.expr("left(payload, length(payload) - 3)")).when(F.length("payload") % 3 == 1, F.regexp_replace("payload", '"(license|parameters)":', "$1:")).when(F.length("payload") % 6 == 5, F.regexp_replace("payload", '("(?:research_problem|extension|title)": ?"[^" ]+) ', '$1" ')).otherwise(F.col("payload"))
    broken = files(spark, sf).where(F.col("payload").isNotNull()).select("file_id", p.alias("answer"))
    return J.parse_or_repair(broken, "answer").select("file_id", "repaired", F.col("json").isNotNull().alias("parsed"), "json")


@query(rf"""WITH {_FILES}, b AS (SELECT file_id, regexp_replace(payload, '"(license|parameters|tokenizer)":', '\1:', 'g') AS s FROM f)
SELECT file_id, md5(regexp_replace(regexp_replace(s, '([{{,]\s*)([A-Za-z_][A-Za-z0-9_\- ]*?)\s*:', '\1"\2":', 'g'), '"([A-Za-z_][A-Za-z0-9_\-]*) +":', '"\1":', 'g')) AS s_md5 FROM b""")
def j4_quote_keys(spark, sf):
    s = F.regexp_replace("payload", '"(license|parameters|tokenizer)":', "$1:")
    return files(spark, sf).where(F.col("payload").isNotNull()).select("file_id", F.md5(J.quote_keys(s)).alias("s_md5"))


@query(rf"""WITH {_ISOLATED} SELECT file_id, json_valid(answer) OR coalesce(json_valid(regexp_replace(regexp_replace(iso.s, ',\s*\}}', '}}', 'g'), ',\s*\]', ']', 'g')), false) AS parsed FROM a LEFT JOIN iso USING (file_id)""")
def j7_light_parse(spark, sf):
    """The light parser: as it stands, else fenced or between braces with trailing commas removed."""
    return _answers(spark, sf).select("file_id", J.light_parse(F.col("answer")).isNotNull().alias("parsed"))


_FOLD = ", ".join(f"('{a}', '{b}')" for a, b in J.SYNONYMS.items())


@query(f"""WITH {_FILES}, r AS (SELECT file_id, unnest((CASE WHEN json_array_length(payload::JSON->'extraction_data') > 0 THEN payload::JSON->'extraction_data' ELSE payload::JSON->'raw_extraction' END)::JSON[]) AS r FROM f),
k AS (SELECT file_id, unnest(json_keys(r)) AS key FROM r), s(a, b) AS (VALUES {_FOLD})
SELECT key, coalesce(s.b, key) AS folded, count(*) AS n FROM k LEFT JOIN s ON s.a = replace(lower(trim(key)), ' ', '_') GROUP BY 1, 2""")
def j8_fold_keys(spark, sf):
    """Keys of records led back to field names through the synonym table; unknown ones stay as they are."""
    r = J.records(files(spark, sf)).select(F.explode(F.map_keys("record")).alias("key"))
    return r.select("key", J.fold_key(F.col("key")).alias("folded")).groupBy("key", "folded").agg(F.count("*").alias("n"))


_RECORDS = f"""{_FILES}, r AS (SELECT file_id, unnest((CASE WHEN json_array_length(payload::JSON->'extraction_data') > 0 THEN payload::JSON->'extraction_data' ELSE payload::JSON->'raw_extraction' END)::JSON[]) AS r,
  CASE WHEN json_array_length(payload::JSON->'extraction_data') > 0 THEN json_array_length(payload::JSON->'extraction_data') ELSE json_array_length(payload::JSON->'raw_extraction') END AS n FROM f)"""


@query(f"""WITH {_RECORDS} SELECT file_id, r->>'model_name' AS model_name, coalesce({"CASE WHEN lower(trim(r->>'model_family')) NOT IN ('null', 'none', 'n/a') THEN r->>'model_family' END"}, split_part(r->>'model_name', '-', 1)) AS model_family, n > 1 AS multiple FROM r""")
def j11_envelopes(spark, sf):
    """Answers brought to their standard form, those of one record bare, the others as a list under another key: families and flags."""
    doc = files(spark, sf).where(F.col("payload").isNotNull()).select("file_id", F.try_parse_json("payload").alias("doc"))
    a, b = (F.try_variant_get("doc", f"$.{k}", "array<variant>") for k in ("extraction_data", "raw_extraction"))
    rs = F.when(F.size(a) > 0, a).when(F.size(b) > 0, b)
    answer = F.when(F.size(rs) == 1, F.to_json(rs[0])).otherwise(F.concat(F.lit('{"Models": '), F.to_json(rs), F.lit("}")))
    form = doc.where(rs.isNotNull()).select("file_id", F.try_parse_json(J.standard_form(answer)).alias("form"))
    each = form.select("file_id", F.explode(F.try_variant_get("form", "$.models", "array<variant>")).alias("m"), F.try_variant_get("form", "$.paper_describes_multiple_models", "boolean").alias("multiple"))
    return each.select("file_id", F.try_variant_get("m", "$.model_name", "string").alias("model_name"), F.try_variant_get("m", "$.model_family", "string").alias("model_family"), "multiple")


def _m1(x: str) -> str:
    return f"CASE WHEN lower({S.strip(x)}) IN ('null', 'none', 'n/a') THEN NULL ELSE {x} END"


@query(f"""WITH {S.PROPS} SELECT prop_id, {_m1('license')} AS license, {_m1('optimizer')} AS optimizer, {_m1('organization')} AS organization, {_m1('tokenizer')} AS tokenizer FROM props""")
def j9_null_texts(spark, sf):
    one = lambda c: F.when(~is_missing_m1(F.col(c)), F.col(c)).alias(c)
    return props(spark, sf).select("prop_id", *map(one, ("license", "optimizer", "organization", "tokenizer")))


@query(f"""WITH {S.PROPS} SELECT prop_id, nullif(organization, '') AS organization, nullif(parameters, '') AS parameters, nullif(license, '') AS license, coalesce(model_family, string_split(model_name, '-')[1]) AS model_family FROM props""")
def j10_defaults(spark, sf):
    n = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    return props(spark, sf).select("prop_id", n("organization"), n("parameters"), n("license"), F.coalesce("model_family", F.element_at(F.split("model_name", "-"), 1)).alias("model_family"))


@query(rf"""WITH {S.PROPS}, x AS (SELECT prop_id, parameters_millions AS m, parameters AS p, try_cast(nullif(regexp_extract(replace(parameters, ',', ''), '(\d+\.?\d*)', 1), '') AS DOUBLE) AS num FROM props)
SELECT prop_id, CASE WHEN m IS NOT NULL AND m <> 0 THEN m WHEN p IS NULL OR p = '' THEN m ELSE CAST(floor(CASE WHEN contains(upper(p), 'B') THEN num * 1000 ELSE num END) AS BIGINT) END AS millions FROM x""")
def j12_derive_millions(spark, sf):
    m, p = F.col("parameters_millions"), F.col("parameters")
    return props(spark, sf).select("prop_id", F.when(m.isNotNull() & (m != 0), m).when(p.isNull() | (p == ""), m).otherwise(N.derived_millions(p).cast("bigint")).alias("millions"))


@query(f"""WITH {S.PROPS} SELECT paper_id, chunk_no, bool_and(model_name IS NOT NULL AND (parameters_millions IS NULL OR parameters_millions < 1000000000)) AS valid, count(*) AS n_records FROM props GROUP BY 1, 2""")
def j13_validate_answers(spark, sf):
    """One bad record makes the whole answer of a chunk invalid."""
    ok = F.col("model_name").isNotNull() & (F.col("parameters_millions").isNull() | (F.col("parameters_millions") < 1_000_000_000))
    return props(spark, sf).groupBy("paper_id", "chunk_no").agg(F.bool_and(ok).alias("valid"), F.count("*").alias("n_records"))


_ORGS = ", ".join(f"'{k}'" for k in J.AFFILIATIONS)


@query(f"""WITH {S.PROPS}, {S.PAPERS}, kw AS (SELECT paper_id, list_filter(list_transform(authors, lambda a: list_filter([{_ORGS}], lambda k: contains(lower(a), lower(k)))[1]), lambda x: x IS NOT NULL)[1] AS org, title FROM pap)
SELECT prop_id, coalesce(nullif(paper_title, ''), title) AS paper_title, coalesce(nullif(organization, ''), org) AS organization FROM props LEFT JOIN kw USING (paper_id)""")
def j14_enrich(spark, sf):
    """Missing titles from the paper, missing organisations from keywords in the names of its authors."""
    p = papers(spark, sf).select("paper_id", "title", J.affiliation(F.col("authors")).alias("org"))
    n = lambda c: F.nullif(F.col(c), F.lit(""))
    return props(spark, sf).select("prop_id", "paper_id", "paper_title", "organization").join(p, "paper_id", "left").select("prop_id", F.coalesce(n("paper_title"), "title").alias("paper_title"), F.coalesce(n("organization"), "org").alias("organization"))


@query(rf"""WITH {S.PROPS} SELECT prop_id, coalesce(model_name, '') <> '' AS valid, array_to_string(list_filter([CASE WHEN coalesce(model_name, '') = '' THEN 'missing model_name' END,
  CASE WHEN parameters <> '' AND NOT regexp_matches(parameters, 'B|M|K|billion|million') THEN 'unusual parameters' END, CASE WHEN context_length <> '' AND NOT regexp_matches(context_length, '[0-9]') THEN 'unusual context_length' END,
  CASE WHEN parameters_millions <= 0 THEN 'invalid parameters_millions' END], lambda x: x IS NOT NULL), '; ') AS notes FROM props""")
def j15_validate(spark, sf):
    return props(spark, sf).select("prop_id", *J.validate())
