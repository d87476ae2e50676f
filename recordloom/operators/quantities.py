"""Quantities in mixed units and scales, converted to single parameters, tokens or bytes.

A text is read as a number followed (or preceded) by a unit string. The unit string is segmented by dynamic programming over
tries of scale prefixes, roots, exponents and filler words; every full decomposition has a score, to which the prior of the
field for the dimension found (parameters, tokens, bytes, none) is added; the best one wins. A number without any unit is
settled by the other statements of its row and by the range in which sizes of models lie.
"""

from __future__ import annotations

import math
import re
import unicodedata
from fractions import Fraction
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.missing import says_nothing

# Scale prefixes (text, power of ten or of 1024, score).
_K, _M, _G, _T = Fraction(10**3), Fraction(10**6), Fraction(10**9), Fraction(10**12)
PREFIXES = {
    "k": (_K, -1.0), "kilo": (_K, 0.0), "thousand": (_K, 0.0), "tsd": (_K, 0.0), "thsd": (_K, 0.0), "tausend": (_K, 0.0), "mille": (_K, 0.0), "千": (_K, 0.0), "тыс": (_K, 0.0),
    "m": (_M, -1.0), "mm": (_M, -2.5), "mega": (_M, 0.0), "million": (_M, 0.0), "millions": (_M, 0.0), "millionen": (_M, 0.0), "mio": (_M, 0.0), "mln": (_M, 0.0), "mn": (_M, -0.2), "mill": (_M, -0.5), "百万": (_M, 0.0), "млн": (_M, 0.0),
    "万": (Fraction(10**4), 0.0), "億": (Fraction(10**8), 0.0), "亿": (Fraction(10**8), 0.0), "万亿": (_T, 0.0), "兆": (_T, 0.0),
    "g": (_G, -1.2), "giga": (_G, 0.0), "b": (_G, -1.0), "bn": (_G, -0.2), "bln": (_G, 0.0), "bil": (_G, -0.5), "billion": (_G, 0.0), "billions": (_G, 0.0), "mrd": (_G, 0.0), "milliard": (_G, 0.0), "milliards": (_G, 0.0), "milliarde": (_G, 0.0), "milliarden": (_G, 0.0), "млрд": (_G, 0.0),
    "t": (_T, -1.0), "tn": (_T, -0.2), "trn": (_T, -0.2), "tera": (_T, 0.0), "trillion": (_T, 0.0), "trillions": (_T, 0.0), "tln": (_T, 0.0), "трлн": (_T, 0.0),
    "p": (Fraction(10**15), -1.5), "peta": (Fraction(10**15), 0.0), "quadrillion": (Fraction(10**15), 0.0),
    "ki": (Fraction(2**10), -0.2), "kibi": (Fraction(2**10), 0.0), "mi": (Fraction(2**20), -0.2), "mebi": (Fraction(2**20), 0.0), "gi": (Fraction(2**30), -0.2), "gibi": (Fraction(2**30), 0.0),
    "ti": (Fraction(2**40), -0.2), "tebi": (Fraction(2**40), 0.0), "pi": (Fraction(2**50), -0.2), "pebi": (Fraction(2**50), 0.0),
}
# Roots (text, dimension, score).
ROOTS = {
    "parameter": ("parameters", 0.0), "parameters": ("parameters", 0.0), "param": ("parameters", 0.0), "params": ("parameters", 0.0), "weights": ("parameters", -0.5), "参数": ("parameters", 0.0), "参": ("parameters", -0.5), "parametern": ("parameters", 0.0), "paramètres": ("parameters", 0.0), "parámetros": ("parameters", 0.0), "параметров": ("parameters", 0.0),
    "token": ("tokens", 0.0), "tokens": ("tokens", 0.0), "tok": ("tokens", 0.0), "toks": ("tokens", 0.0), "词元": ("tokens", 0.0), "subwords": ("tokens", -0.5), "wordpieces": ("tokens", -0.5),
    "byte": ("bytes", 0.0), "bytes": ("bytes", 0.0), "b": ("bytes", -1.0), "o": ("bytes", -3.0), "octets": ("bytes", 0.0),
}
# Words that carry no scale and no dimension.
FILLERS = (
    "of", "text", "total", "in", "the", "a", "over", "about", "approx", "approximately", "around", "circa", "ca", "roughly", "nearly", "almost", "some", "up", "to", "more", "less", "than", "at", "least", "most", "only", "non", "embedding", "compressed",
    "uncompressed", "corpus", "subword", "bpe", "after", "before", "dedup", "deduplication", "deduplicated", "filtering", "filtered", "cleaned", "raw", "plain", "data", "dataset", "training", "trainable", "model", "size", "active", "dense", "and", "with", "on", "disk", "unique", "web", "count", "counts", "are", "is", "it", "weights",
)
# Natural log of how likely a field holds a dimension: the priors for ambiguous decompositions.
PRIORS = {
    "parameters": {"parameters": -0.1, None: -0.4, "tokens": -8.0, "bytes": -8.0},
    "training_corpus_size": {"tokens": -0.6, "bytes": -0.8, None: -1.5, "parameters": -8.0},
}
UNKNOWN_COST, CASE_COST, FILLER_COST = -6.0, -0.8, -0.3
# The range of model sizes in single parameters.
LEAST, MOST = 20 * 10**6, 2 * 10**12

_WORDS = {w: i for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())} | {w: 10 * (i + 2) for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split())}
_NUMBER = re.compile(r"(?<![\w.,])[~≈<>]?\s*(\d[\d.,_'   ]*\d|\d|\.\d+)(?:\s*[x×*·]\s*10\s*(?:\^|\*\*)?\s*([+-]?\d+)|[eE]([+-]?\d+))?")
_SUPERS = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺", "0123456789-+")
_GERMAN = re.compile(r"(?i)^\s*(mrd|mio|milliarde|millionen|tsd)")


def _trie(words: dict) -> dict:
    root: dict = {}
    for word, value in words.items():
        node = root
        for ch in word:
            node = node.setdefault(ch, {})
        node[""] = value
    return root


_TRIES = {"prefix": _trie(PREFIXES), "root": _trie(ROOTS), "filler": _trie({w: FILLER_COST for w in FILLERS})}
_EXPONENT = re.compile(r"(?:x|×|\*|·)?\s*10\s*(?:\^|\*\*)\s*([+-]?\d+)")


def _matches(kind: str, s: str, i: int):
    node = _TRIES[kind]
    for j in range(i, len(s)):
        node = node.get(s[j])
        if node is None:
            return
        if "" in node:
            yield j + 1, node[""]


@lru_cache(maxsize=50_000)
def segment(unit: str) -> tuple:
    """All best decompositions of a unit string: (score, scale or None, dimension or None), one for each scale and dimension.

    States of the dynamic program are positions with the scale and dimension collected so far; a prefix may only stand before
    a root of the same word or alone, a second prefix multiplies (as in "thousand million"), a second root is a filler.
    """
    s = unit.lower()
    n = len(s)
    states: list[dict] = [{} for _ in range(n + 1)]
    states[0][(None, None)] = 0.0

    def push(j: int, key: tuple, score: float) -> None:
        if score > states[j].get(key, -math.inf):
            states[j][key] = score

    for i in range(n):
        if not states[i]:
            continue
        at_word = i == 0 or not s[i - 1].isalpha() or ord(s[i]) > 0x2E80
        for (scale, dim), score in states[i].items():
            if not s[i].isalnum():
                push(i + 1, (scale, dim), score)
                if m := _EXPONENT.match(s, i):
                    push(m.end(), ((scale or 1) * Fraction(10) ** int(m[1]), dim), score)
                continue
            if m := _EXPONENT.match(s, i):
                push(m.end(), ((scale or 1) * Fraction(10) ** int(m[1]), dim), score)
            if at_word:
                for j, (value, cost) in _matches("prefix", s, i):
                    case = CASE_COST if j - i == 1 and s[i] in "b" and unit[i] == "b" and dim == "bytes" else 0.0
                    push(j, ((scale or 1) * value, dim), score + cost + case - (3.0 if scale else 0.0))
                for j, cost in _matches("filler", s, i):
                    if j == n or not s[j].isalpha():
                        push(j, (scale, dim), score + cost)
            glued = not at_word
            for j, (value, cost) in _matches("root", s, i):
                if j == n or not s[j].isalpha() or ord(s[i]) > 0x2E80:
                    bare = -4.0 if value == "bytes" and scale is None else 0.0  # a size in single bytes is rare
                    # decimal scales that are words of counting (bn, mln) do not take the byte sign
                    split = -3.0 if value == "bytes" and not glued and j - i == 1 else 0.0
                    if dim is None:
                        push(j, (scale, value), score + cost + bare + split)
                    elif dim == value:
                        push(j, (scale, dim), score + cost + FILLER_COST)
            if at_word:  # an unknown word
                j = i
                while j < n and s[j].isalnum():
                    j += 1
                push(j, (scale, dim), score + UNKNOWN_COST)
    return tuple(sorted(((score, scale, dim) for (scale, dim), score in states[n].items()), key=lambda x: (-x[0], str(x[2]), x[1] or 0)))


def best_unit(unit: str, field: str) -> tuple:
    """Scale and dimension of the best decomposition under the field's priors."""
    prior = PRIORS[field]
    found = segment(unit)
    if not found:
        return None, None
    score, scale, dim = max(found, key=lambda x: x[0] + prior.get(x[2], -8.0))
    return scale, dim


def read_number(text: str, german: bool = False) -> Fraction | None:
    """A plain number with any usual grouping and decimal sign; None if it is none."""
    s = re.sub(r"[_'   ]", "", text).strip(".,")
    if "," in s and "." in s:
        dec = max(s.rfind(","), s.rfind("."))
        s = re.sub(r"[.,]", "", s[:dec]) + "." + s[dec + 1 :]
    elif "," in s:
        grouped = re.fullmatch(r"[1-9]\d{0,2}(,\d{3})+", s)
        s = s.replace(",", "") if grouped and not (german and s.count(",") == 1) else s.replace(",", ".", 1) if s.count(",") == 1 else s.replace(",", "")
    elif s.count(".") > 1:
        s = s.replace(".", "")
    return Fraction(s) if re.fullmatch(r"\d+(\.\d+)?|\.\d+", s) else None


def _spelled(text: str) -> tuple[Fraction, str] | None:
    """A number in English words at the start of a text, and the rest."""
    total, used, rest = 0, 0, text.lower()
    while m := re.match(r"\s*-?\s*([a-z]+)", rest):
        w = m[1]
        if w in _WORDS:
            total += _WORDS[w]
        elif w == "hundred" and used:
            total = total * 100
        elif w == "and" and used:
            pass
        else:
            break
        used, rest = used + 1, rest[m.end() :]
    return (Fraction(total), rest) if used and total else None


@lru_cache(maxsize=200_000)
def parse(text: str, field: str) -> tuple | None:
    """(value, scale or None, dimension or None) of a text; None if it states no quantity."""
    if says_nothing(text):
        return None
    s = unicodedata.normalize("NFKC", text.translate(_SUPERS)).strip()
    m = _NUMBER.search(s)
    if m:
        rest = s[m.end() :]
        if _REFERENCE.search(s[: m.start()]):
            return None
        value = read_number(m[1], bool(_GERMAN.match(rest)))
        if value is None:
            return None
        if power := m[2] or m[3]:
            if abs(int(power)) > 30:
                return None
            value *= Fraction(10) ** int(power)
        scale, dim = best_unit(s[: m.start()] + " " + rest, field)
        if scale is None and power:
            scale = Fraction(1)
    else:
        if not (found := _spelled(re.sub(r"(?i)^(about|approx\.?|around|over|nearly|roughly|some)\s+", "", s))):
            return None
        value, rest = found
        scale, dim = best_unit(rest, field)
    return value, scale, dim


def whole(x: Fraction) -> int | None:
    n = math.floor(x + Fraction(1, 2))
    return n if 0 <= n < 2**63 else None


SCALES = [Fraction(1), _K, _M, _G, _T]
_NAME_SIZE = re.compile(r"(?<![\w.])(\d+(?:\.\d+)?)[\s-]?([KkMmBbTt])(?![A-Za-z0-9])|(?<![\w.])(\d+(?:\.\d+)?)\s*(thousand|million|billion|trillion)", re.I)


@lru_cache(maxsize=200_000)
def size_in_name(name: str | None) -> Fraction | None:
    """The size that a model's name states, e.g. 70B; the last one if there are several."""
    found = None
    for m in _NAME_SIZE.finditer((name or "").replace("_", " ").replace("(", " ").replace("[", " ")):
        found = Fraction(m[1] or m[3]) * PREFIXES[(m[2] or m[4]).lower()][0]
    return found


def _near(a: Fraction, b: Fraction) -> bool:
    return abs(a - b) * 100 <= b


def _in_range(a: Fraction) -> bool:
    return LEAST <= a <= MOST


def _settle(value: Fraction, evidence: list, prefer: list) -> Fraction | None:
    """The scale of a bare number: one that agrees with a statement of the row, else the preferred one inside the range."""
    for e in evidence:
        for scale in prefer:
            if _near(value * scale, e):
                return value * scale
    inside = [value * scale for scale in prefer if _in_range(value * scale)]
    return inside[0] if inside else None


_TEXT_PREFER, _MILLIONS_PREFER = [Fraction(1), _G, _M, _K, _T], [_M, Fraction(1), _K, _G, _T]
_UNIT_WORDS = re.compile(r"(?i)\b(?:(thousand|million|billion|trillion)s?\s+of\s+)?((?:kilo|mega|giga|tera|kibi|mebi|gibi|tebi)?bytes?|[kmgt]i?b|(?:sub-?word\s+)?(?:token|tok)s?)\b(?=\s*(?:[.,;:)]|$|(?:counts?|after|before|only|of|per|unless|throughout|here|each)\b))")
_REFERENCE = re.compile(r"(?i)\b(tables?|tab|fig|figures?|sec|sect|sections?|eq|appendix|chapter|page|pp?|note|ref|version|no)\.?\s*$")
_SIZE_WORDS = re.compile(r"(?i)\b(volume|size|sizes|total|totals|weights|mixture|corpus|column|amount|figures|numbers|quantit\w+|all counts)\b")
_STATES = re.compile(r"(?i)\b(in|are|is|as|count(?:s|ed)?|measured|given|listed|stated|reported|expressed)\b")


@lru_cache(maxsize=50_000)
def unit_statement(text: str | None) -> tuple | None:
    """(scale, dimension) from a sentence that says in what unit sizes are given; None if no sentence does."""
    for sentence in re.split(r"[.!?;][)”\"’]?\s+|\n", text or ""):
        if not (_SIZE_WORDS.search(sentence) and _STATES.search(sentence)) or re.search(r"\d", sentence):
            continue
        for m in _UNIT_WORDS.finditer(sentence):
            scale, dim = best_unit(f"{m[1] or ''} {m[2]}", "training_corpus_size")
            if dim:
                return scale or Fraction(1), dim
    return None


def read_row(parameters: str | None, millions: int | None, corpus: str | None, context: str | None, name: str | None) -> list[tuple]:
    """The amounts of one record: (field_name, unit_kind, amount)."""
    out = []
    told, named = parse(parameters, "parameters") if parameters is not None else None, size_in_name(name)
    sure = [told[0] * told[1]] if told and told[1] is not None else []
    evidence = ([named] if named else []) + sure
    if told:
        if sure:
            amount = sure[0]
        else:
            guess = [Fraction(millions) * _M] if millions and _in_range(Fraction(millions) * _M) else [Fraction(millions) * s for s in _MILLIONS_PREFER] if millions else []
            amount = _settle(told[0], evidence + guess, _TEXT_PREFER)
            if amount is None:
                amount = told[0]
        out.append(("parameters", "parameters", whole(amount)))
        evidence.append(amount)
    if millions is not None:
        amount = _settle(Fraction(millions), evidence, _MILLIONS_PREFER)
        out.append(("parameters_millions", "parameters", whole(Fraction(millions) * _M if amount is None else amount)))
    if corpus is not None and (size := parse(corpus, "training_corpus_size")):
        value, scale, dim = size
        if dim is None:
            said = unit_statement(context) or (_G, "tokens")  # no unit anywhere: such columns count billions of tokens
            scale, dim = scale or said[0], said[1]
        out.append(("training_corpus_size", dim, whole(value * (scale or 1))))
    return [x for x in out if x[2] is not None]


_ROWS = T.ArrayType(T.StructType([T.StructField("field_name", T.StringType()), T.StructField("unit_kind", T.StringType()), T.StructField("amount", T.LongType())]))


@F.pandas_udf(_ROWS)
def _amounts(parameters: pd.Series, millions: pd.Series, corpus: pd.Series, context: pd.Series, name: pd.Series) -> pd.Series:
    none = lambda x: None if x is None or x != x else x
    return pd.Series([[dict(zip(("field_name", "unit_kind", "amount"), r)) for r in read_row(none(p), int(m) if none(m) is not None else None, none(c), none(t), none(n))] for p, m, c, t, n in zip(parameters, millions, corpus, context, name)], dtype=object)


def amounts(parameters: Column, millions: Column, corpus: Column, context: Column, name: Column) -> Column:
    """Array of (field_name, unit_kind, amount) for the sizes that one record states."""
    return _amounts(parameters, millions.cast("string").cast("decimal(20,0)").cast("string"), corpus, context, name)


def convert(df: DataFrame, key: str = "prop_id") -> DataFrame:
    """(key, field_name, unit_kind, amount), one row for each size that a record states; rows delivered twice count once.

    Missing values, texts without a number and amounts beyond BIGINT yield no row. A record with a NULL key is kept under NULL.
    Every record is read on its own: no shuffle but the one that drops rows delivered twice, on the narrow result.
    """
    bare = F.col("training_corpus_size").rlike(r"^[\s\d.,_]+[A-Za-z]*\s*$")
    rows = df.select(F.col(key), amounts(F.col("parameters"), F.col("parameters_millions"), F.col("training_corpus_size"), F.when(bare, F.col("training_data")), F.col("model_name")).alias("found"))
    return rows.select(key, F.inline("found")).distinct()
