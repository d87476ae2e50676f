"""Answers of a language model: finding the JSON in them, reading or repairing it, folding its keys, checking its records."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.names import let
from recordloom.missing import trim_all

# Other names of fields; keys are compared lower case with underscores for spaces.
SYNONYMS = {
    "name": "model_name", "modelname": "model_name", "model": "model_name", "the_model": "model_name", "family": "model_family", "modelfamily": "model_family",
    "organisation": "organization", "org": "organization", "company": "organization", "org_full_name": "organization", "organizational_affiliation_of_authored_model": "organization", "author_organization": "organization",
    "created_date": "date_created", "creation_date": "date_created", "date": "date_created", "publish_date": "date_created",
    "params": "parameters", "param_count": "parameters", "params_count": "parameters", "parameter_count": "parameters",
    "parameters_size_in_million_params": "parameters_millions", "params_millions": "parameters_millions", "param_millions": "parameters_millions",
    "arch": "architecture", "model_architecture": "architecture", "pretraining_arch": "pretraining_architecture", "optimizer_algorithm": "optimizer", "optim": "optimizer",
    "licence": "license", "licence_type": "license", "license_type": "license", "hw_used": "hardware_used", "hardware": "hardware_used",
}
# Words in an author's name that give an affiliation away, in order of search.
AFFILIATIONS = ("Meta", "Google", "OpenAI", "Anthropic", "Microsoft", "DeepMind", "AI", "Research", "University", "Institute", "Facebook", "Amazon", "IBM", "NVIDIA", "Hugging Face", "Alibaba", "DeepSeek", "Mistral", "Stability")


def host_key(c: Column, domain: str) -> Column:
    """Key of the store that a URL or name points to: the bare domain is production, known subdomains go by their name."""
    url = F.when(c.contains("://"), c).otherwise(F.concat(F.lit("https://"), c))
    host = F.lower(F.regexp_extract(url, "://([^/:]+)", 1))
    return F.when(host == domain, "production").when(host == f"incubating.{domain}", "incubating").when(host.isin("production", "incubating"), host).otherwise("sandbox")


def messages(text: Column, instruction: str, examples: list[tuple[str, str]]) -> Column:
    """A chat: instruction, worked examples as turns, then the text."""
    one = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    turns = [one(role, F.lit(t)) for pair in examples for role, t in zip(("user", "assistant"), pair)]
    return F.array(one("system", F.lit(instruction)), *turns, one("user", text))


def prompt_kind(model: Column) -> Column:
    """Models made for conversation get the chat form."""
    return F.when(F.lower(model).contains("instruct") | F.lower(model).contains("chat"), "chat").otherwise("plain")


def isolate(c: Column) -> Column:
    """The JSON object in an answer, or NULL: what follows the last echo, without thinking and fences, from the first brace to the
    one that closes it (braces in strings count too), else to the last one."""
    s = F.when(c.contains("<|assistant|>"), F.element_at(F.split(c, r"<\|assistant\|>"), -1)).otherwise(c)
    s = F.regexp_replace(F.regexp_replace(s, r"(?s)<think>.*?</think>", ""), r"(?s)<think>.*\z", "")
    fenced = F.element_at(F.split(F.element_at(F.split(s, "```json"), 2), "```"), 1)
    s = F.when(s.contains("```json"), trim_all(fenced)).when(s.contains("```"), trim_all(F.element_at(F.split(s, "```"), 2))).otherwise(s)
    s = F.when(F.instr(s, "{") > 0, F.substring(s, F.instr(s, "{"), F.length(s)))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("pos"), F.lit(0).alias("stop"))

    def step(a: Column, piece: Column) -> Column:
        pos = a["pos"] + F.length(piece)
        depth = a["depth"] + F.when(F.right(piece, F.lit(1)) == "{", 1).when(F.right(piece, F.lit(1)) == "}", -1).otherwise(0)
        stop = F.when((a["stop"] == 0) & (depth == 0), pos).otherwise(a["stop"])
        return F.struct(depth.alias("depth"), pos.alias("pos"), stop.alias("stop"))

    def object_of(s: Column) -> Column:
        # pieces of the text that end with a brace each
        pieces = F.split(s, r"(?<=[{}])")
        stop = F.aggregate(pieces, start, step, lambda a: a["stop"])
        last = F.length(s) - F.instr(F.reverse(s), "}") + 1
        return let(stop, lambda n: F.when(n > 0, F.substring(s, F.lit(1), n)).when(F.instr(s, "}") > 0, F.substring(s, F.lit(1), last)))

    return let(s, object_of)


def quote_keys(c: Column) -> Column:
    """Quotes around keys that have none."""
    s = F.regexp_replace(c, r"([{,]\s*)([A-Za-z_][A-Za-z0-9_\- ]*?)\s*:", '$1"$2":')
    return F.regexp_replace(s, r'"([A-Za-z_][A-Za-z0-9_\-]*) +":', '"$1":')


def light_parse(c: Column) -> Column:
    """VARIANT of an answer as it stands, else of the object in it with trailing commas removed; NULL if neither parses."""
    inner = F.regexp_replace(F.regexp_replace(isolate(c), r",\s*\}", "}"), r",\s*\]", "]")
    return F.coalesce(F.try_parse_json(c), F.try_parse_json(inner))


def balance(text: str) -> str:
    """Closing brackets that are missing at the end, strings left alone."""
    open_, quoted, skip = [], False, False
    for ch in text:
        if skip:
            skip = False
        elif quoted:
            skip, quoted = ch == "\\", ch != '"'
        elif ch == '"':
            quoted = True
        elif ch in "{[":
            open_.append("}" if ch == "{" else "]")
        elif open_ and ch == open_[-1]:
            open_.pop()
    return text + ('"' if quoted else "") + "".join(reversed(open_))


# Rewrites that turn almost-JSON into JSON; their order matters.
_REWRITES = [
    (r'\.\s*"', '"'),
    (r"([{,]\s*)([A-Za-z_][A-Za-z0-9_\- ]*?)\s*:", r'\1"\2":'),
    (r':\s*([^",}\[\{\s\d\-tfn][^",}\]]*?)(\s*[,}\]])', r': "\1"\2'),
    (r':\s*"",', ': "",'),
    (r'""([^"]+)""', r'"\1"'),
    (r",\s*,", ","),
    (r'"(\w+)\s+":', r'"\1":'),
    (r"}\s*{", "},{"),
    (r'(?<=[0-9"\]}])\s+(?="[^"]+"\s*:)', ","),
    (r"[\x00-\x1f\x7f-\x9f]", ""),
    (r"(?m)(?<![:\"])//.*?$", ""),
    (r"(?s)/\*.*?\*/", ""),
    (r",\s*}", "}"),
    (r",\s*]", "]"),
    (r"{\s*,", "{"),
    (r"\[\s*,", "["),
]
_REWRITES = [(re.compile(a), b) for a, b in _REWRITES]


def _fault(text: str) -> json.JSONDecodeError | None:
    try:
        json.loads(text)
    except json.JSONDecodeError as e:
        return e
    return None


def escape_stray(text: str) -> str:
    """Quotes inside values escaped: of those before the place where parsing stops the nearest with which it gets further, again and again."""
    fault = _fault(text)
    while fault and fault.pos < len(text) and not fault.msg.startswith("Unterminated"):
        cut = None  # the text may also end in a later string
        for m in reversed(list(re.finditer(r'(?<!\\)(?:\\\\)*"', text[: fault.pos]))):
            trial = text[: m.end() - 1] + "\\" + text[m.end() - 1 :]
            then = _fault(trial)
            if then is None or (then.pos > fault.pos + 1 and not then.msg.startswith("Unterminated")):
                text, fault = trial, then
                break
            if cut is None and then.pos > fault.pos + 1:
                cut = trial
        else:
            return cut or text
    return text


def _close_strings(text: str) -> str:
    """Values that lack their closing quote closed before the next comma or bracket."""
    text = re.sub(r':\s*"([^"]*?)([,}\]])', lambda m: f': "{m[1]}"{m[2]}', text)
    return re.sub(r':\s*"([^"]*?)(\s*[}\]])', r': "\1"\2', text)


def repair(text: str | None) -> str | None:
    """A text as JSON if rewriting and closing brackets make it parse, else None. Valid JSON comes back as it is.

    Quotes inside values are escaped first, values without their closing quote closed next; only then is the text cut.
    Comments after // are dropped, but not inside what looks like a URL. A text cut in a string is closed after the last whole
    member.
    """
    if not text or "{" not in text:
        return None
    s = text[text.index("{") :]
    for attempt in range(2):
        try:
            json.loads(s)
            return s
        except ValueError:
            if attempt == 0:
                for pattern, to in _REWRITES:
                    s = pattern.sub(to, s)
    s = escape_stray(s)
    for whole in (s, _close_strings(s)):
        if _fault(whole) is None:
            return whole
    for end in [len(s), *[m.start() for m in reversed(list(re.finditer(r",", s)))]]:
        closed = re.sub(r",\s*([}\]])", r"\1", balance(s[:end]))
        try:
            json.loads(closed)
            return closed
        except ValueError:
            continue
    return None


def parse_or_repair(df: DataFrame, column: str) -> DataFrame:
    """df with json (text that parses, or NULL) and repaired: only rows that do not parse as they stand go through Python."""
    ok = df.where(F.try_parse_json(column).isNotNull()).withColumns({"json": F.col(column), "repaired": F.lit(False)})
    broken = df.where(F.try_parse_json(column).isNull())
    schema = ", ".join(f"`{n}` {t}" for n, t in broken.dtypes) + ", json string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(json=[repair(t) if isinstance(t, str) else None for t in pdf[column]])

    return ok.unionByName(broken.mapInPandas(run, schema).withColumn("repaired", F.col("json").isNotNull()))


def records(files: DataFrame) -> DataFrame:
    """(file_id, pos, record MAP<STRING, VARIANT>): the record objects of result files in either layout."""
    doc = files.where(F.col("payload").isNotNull()).select("file_id", F.try_parse_json("payload").alias("doc"))
    a, b = (F.try_variant_get("doc", f"$.{k}", "array<variant>") for k in ("extraction_data", "raw_extraction"))
    each = doc.select("file_id", F.posexplode(F.when(F.size(a) > 0, a).when(F.size(b) > 0, b)).alias("pos", "v"))
    return each.where(F.schema_of_variant("v").startswith("OBJECT")).select("file_id", "pos", F.try_variant_get("v", "$", "map<string,variant>").alias("record"))


def fold_key(key: Column) -> Column:
    """The field that a key means, or the key itself."""
    table = F.create_map(*[F.lit(x) for pair in SYNONYMS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.replace(F.lower(F.trim(key)), F.lit(" "), F.lit("_"))), key)


_NULLS = ("null", "none", "n/a")
#: Fields that every model of an answer has, if only as null.
_EXPECTED = ("organization", "parameters", "license", "date_created", "pretraining_architecture", "pretraining_task", "finetuning_task", "optimizer", "research_problem", "architecture", "innovation", "hardware_used")


def _walked(v):
    """A value with its keys led back to field names and null words as nulls, at every depth."""
    if isinstance(v, dict):
        return {SYNONYMS.get(k.strip().lower().replace(" ", "_"), k): _walked(x) for k, x in v.items()}
    if isinstance(v, list):
        return [_walked(x) for x in v]
    return None if isinstance(v, str) and v.strip().lower() in _NULLS else v


def _completed(model: dict) -> dict:
    full = dict.fromkeys(_EXPECTED) | model
    size = full.get("parameters")
    if size and not full.get("parameters_millions"):
        number = re.search(r"\d+\.?\d*", str(size).replace(",", ""))
        full["parameters_millions"] = int(float(number[0]) * (1000 if "B" in str(size).upper() else 1)) if number else None
    if full.get("model_family") is None:
        name = full.get("model_name")
        full["model_family"] = name.split("-")[0] if isinstance(name, str) and name else None
    return full


def standard(text: str | None) -> str | None:
    """An answer in its standard form: {"models": [...], "paper_describes_multiple_models": ...}, or NULL if it is no JSON object.

    Keys and null words are settled at every depth; a bare model is wrapped; models get what can be derived (family, millions) and
    nulls for what is missing; without a flag there are multiple models if there is more than one.
    """
    try:
        d = _walked(json.loads(text or ""))
    except (ValueError, RecursionError):
        return None
    if not isinstance(d, dict):
        return None
    if "models" not in d and "Models" in d:
        d["models"] = d.pop("Models")
    if "models" not in d and "model_name" in d:
        d = {"models": [d]}
    models = d.get("models") if isinstance(d.get("models"), list) else []
    d["models"] = [_completed(m) for m in models if isinstance(m, dict)]
    d.setdefault("paper_describes_multiple_models", len(d["models"]) > 1)
    return json.dumps(d, ensure_ascii=False)


@F.pandas_udf(T.StringType())
def standard_form(texts: pd.Series) -> pd.Series:
    """standard, in Arrow batches: nested objects of any depth are beyond built-in functions."""
    return texts.map(standard)


def affiliation(authors: Column) -> Column:
    """The first affiliation word in the first author's name that has one."""
    words = F.array(*map(F.lit, AFFILIATIONS))
    each = F.transform(authors, lambda a: F.get(F.filter(words, lambda w: F.contains(F.lower(a), F.lower(w))), F.lit(0)))
    return F.get(F.array_compact(each), F.lit(0))


def validate() -> tuple[Column, Column]:
    """valid, and notes on fields in an unusual form, of a record."""
    name, size, context, millions = (F.col(c) for c in ("model_name", "parameters", "context_length", "parameters_millions"))
    named = F.coalesce(name, F.lit("")) != ""
    notes = F.array_compact(
        F.array(
            F.when(~named, F.lit("missing model_name")),
            F.when((size != "") & ~size.rlike("B|M|K|billion|million"), F.lit("unusual parameters")),
            F.when((context != "") & ~context.rlike("[0-9]"), F.lit("unusual context_length")),
            F.when(millions <= 0, F.lit("invalid parameters_millions")),
        )
    )
    return named.alias("valid"), F.array_join(notes, "; ").alias("notes")
