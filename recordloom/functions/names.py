"""Column functions on model names, dates, organisations and sizes of extracted records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordloom.missing import trim_all

# Names of organisations by a part that gives them away, in order of search.
ORGANISATIONS = (
    ("google ai language", "Google"), ("google research", "Google"), ("google deepmind", "Google"), ("meta ai", "Meta"), ("facebook ai", "Meta"), ("openai", "OpenAI"), ("anthropic", "Anthropic"),
    ("mistral ai", "Mistral AI"), ("hugging face", "Hugging Face"), ("microsoft research", "Microsoft"), ("nvidia", "NVIDIA"), ("deepmind", "DeepMind"), ("cohere", "Cohere"),
)
# What is stripped from the end of a name, in order, to leave the release it belongs to.
SUFFIXES = (
    r"\s*\((ablation|baseline|checkpoint|variant|experiment|configuration|config|finetuned|fine-tuned|quantized|distilled|pruned|instruct|chat)\)$",
    r"\s*\(\d+\.?\d*[MBT]\)$",
    r"\s*\(\d+[Kk](?:\s+context(?:\s+window)?)?\)$",
    r"[-_\s]+(wikibooks?|wikipedia|bookcorpus|books?corpus|openwebtext|commoncrawl|cc-?news|c4|pile|ptb|wt103|enwik8|text8)$",
    r"[-_\s]+(Base|Large|XL|XXL|Small|Medium|Tiny|Mini)$",
    r"(?<=[a-z0-9])(Base|Large|XL|XXL|Small|Medium|Tiny|Mini)$",
    r"[-_\s]+(Turbo|Pro|Ultra|Lite|Plus|Premium|Standard|Advanced|Basic)$",
    r"[-_\s]+\d+\.?\d*[MBT]$",
    r"[-_\s]+\d+[-_\s]?[Ll](?:ayer(?:s)?)?$",
    r"[-_\s]+\d+[Kk](?:[-_\s]?context(?:\s+window)?)?$",
    r"\s*\((?:pre|post)[-\s]?trained\)$",
    r"[-_\s]+$",
)
# Where a version stands in a name, in order of search.
VERSIONS = (r"(?:^|\s)([A-Za-z][\w-]*?)\s+([vV]?\d+(?:\.\d+)?)(?:\s|[-_]|$)", r"(?:^|\s)([A-Za-z][\w-]*?)[-_]([vV]?\d+(?:\.\d+)?)(?:\s|[-_]|$)")


def normalize_date(c: Column) -> Column:
    """Year and month; a lone year gets January; anything else stays."""
    s = trim_all(c)
    ym = F.regexp_extract(s, r"^(\d{4}-\d{2})(?:-\d{2})?$", 1)
    y = F.regexp_extract(s, r"^(\d{4})$", 1)
    return F.when(ym != "", ym).when(y != "", F.concat(y, F.lit("-01"))).otherwise(c)


def title_case(c: Column) -> Column:
    """A capital after everything that is no letter, small letters elsewhere."""
    # the split keeps each run of letters with the marks before it
    parts = F.regexp_extract_all(c, F.lit(r"([^\p{L}]*\p{L}*)"), F.lit(1))
    marks = lambda p: F.regexp_extract(p, r"^([^\p{L}]*)", 1)
    word = lambda p: F.regexp_extract(p, r"(\p{L}*)$", 1)
    return F.array_join(F.transform(parts, lambda p: F.concat(marks(p), F.upper(F.substring(word(p), 1, 1)), F.lower(F.substring(word(p), 2, 1_000_000)))), "")


def normalize_organisation(c: Column) -> Column:
    """The known name that a value holds or is held by, else the value itself, in title case if it has a space."""
    s = F.lower(trim_all(c))
    out = F.when(s.contains(" "), title_case(trim_all(c))).otherwise(c)
    for part, name in reversed(ORGANISATIONS):
        out = F.when(s.contains(part) | F.lit(part).contains(s), name).otherwise(out)
    return F.when(c.isNull() | (s == ""), c).otherwise(out)


def spaced(c: Column) -> Column:
    """A space between a letter and a digit."""
    return trim_all(F.regexp_replace(c, r"([A-Za-z])(\d)", "$1 $2"))


def let(value: Column, then) -> Column:
    """then(value) with value worked out once however often then uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def version_token(c: Column) -> Column:
    """The version that a name states, without its v; NULL if it states none."""
    first, second = (F.nullif(F.regexp_extract(c, p, 2), F.lit("")) for p in VERSIONS)
    return F.regexp_replace(F.coalesce(first, second), "^[vV]", "")


def canonical_name(c: Column) -> Column:
    """The release that a name belongs to: spaced, suffixes stripped, the version put back if that took it away."""

    def without_suffixes(name: Column) -> Column:
        for p in SUFFIXES:
            name = F.regexp_replace(name, "(?i)" + p, "")
        return name

    def back(name: Column, version: Column) -> Column:
        lost = version.isNotNull() & ~F.lower(name).contains(F.lower(version))
        return trim_all(F.when(lost, F.concat(name, F.lit(" "), version)).otherwise(name))

    kept = let(spaced(trim_all(c)), lambda sp: let(F.struct(without_suffixes(sp).alias("name"), version_token(sp).alias("version")), lambda x: back(x["name"], x["version"])))
    return F.when(c.isNull() | (c == ""), "").otherwise(kept)


def normalize_size(c: Column) -> Column:
    """A size text in capitals; a bare number counts millions; NULL if it says that nothing is known."""
    s = F.upper(trim_all(c))
    num, unit = (F.regexp_extract(s, r"^(\d+\.?\d*)\s*([MBT])$", i) for i in (1, 2))
    digits = F.regexp_replace(s, r"\.", "")
    return F.when(s.isNull() | s.isin("", "NULL", "NONE", "N/A"), F.lit(None)).when(unit != "", F.concat(num, unit)).when(digits.rlike(r"^\d+$"), F.concat(s, F.lit("M"))).otherwise(s)


def size_key(c: Column) -> Column:
    """Millions that a size text begins with, 0 if it begins with none."""
    num, unit = (F.regexp_extract(F.upper(c), r"^(\d+\.?\d*)\s*([MBT])", i) for i in (1, 2))
    scale = F.when(unit == "B", 1_000.0).when(unit == "T", 1_000_000.0).otherwise(1.0)
    return F.when(unit == "", 0.0).otherwise(num.try_cast("double") * scale)


def gold_sizes(c: Column) -> Column:
    """Ascending distinct millions of all sizes in a text."""
    all_ = F.regexp_extract_all(c, F.lit(r"(?i)(\d+(?:\.\d+)?\s*[MBT])\b"), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(all_, size_key)))


def gold_parameters(c: Column) -> Column:
    """All sizes of a text in one form (124M, 1.5B), ascending; NULL if there is none."""

    def shown(m: Column) -> Column:
        b = m / 1_000
        return F.when(m >= 1_000, F.when(b == F.floor(b), F.concat(F.floor(b).cast("string"), F.lit("B"))).otherwise(F.concat(b.cast("string"), F.lit("B")))).otherwise(F.concat(F.bround(m, 0).cast("bigint").cast("string"), F.lit("M")))

    sizes = gold_sizes(c)
    return F.when(F.size(sizes) > 0, F.array_join(F.transform(sizes, shown), ", "))


def gold_millions(c: Column) -> Column:
    """The largest size of a text in millions."""
    return F.bround(F.array_max(gold_sizes(c)), 0).cast("bigint")


def sheet_millions(c: Column) -> Column:
    """A millions cell of a sheet: the last part of a range, of that the last of a list, letters dropped and not scaled."""
    s = F.element_at(F.split(F.element_at(F.split(c, "-"), -1), ","), -1)
    number = F.regexp_replace(trim_all(F.regexp_replace(F.upper(s), "[MB]", "")), r"(?<=\d)_(?=\d)", "").try_cast("double")
    return F.when(c.isNull() | F.lower(c).isin("", "n/a", "null", "none"), F.lit(None)).otherwise(F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)))


def derived_millions(text: Column) -> Column:
    """Millions from the first number of a text; a thousand times that if a B stands anywhere."""
    num = F.regexp_extract(F.regexp_replace(text, ",", ""), r"(\d+\.?\d*)", 1).try_cast("double")
    return F.floor(F.when(F.upper(text).contains("B"), num * 1_000).otherwise(num))


def soft(c: Column) -> Column:
    """Lower case with hyphens and white space as one space."""
    return F.regexp_replace(F.lower(trim_all(c)), r"(?U)[-\s]+", " ")


def without_size(c: Column) -> Column:
    """A name without a size at its end."""
    s = F.regexp_replace(F.lower(trim_all(c)), r"\s*\(\s*\d+(?:\.\d+)?\s*[kmb]\s*\)\s*$", "")
    return trim_all(F.regexp_replace(s, r"\s+\d+(?:\.\d+)?\s*[kmb]\s*$", ""))
