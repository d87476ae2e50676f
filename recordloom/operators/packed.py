"""Fields that hold several values in one text, split into one value per row with its position.

Expectation-maximisation segmentation. A text is cut into atoms at every place where a delimiter stands outside quotes and
parentheses; the lattice over the atoms has one edge for each run of atoms that could be one value. An edge is scored by how
often the whole column holds that value and by a word-bigram model of the column's values (words rarer than a stated share
count by their shape), each delimiter by how likely its kind separates values. Texts cut by unmistakable delimiters only give
the first counts; Viterbi paths over all texts then re-estimate values and bigrams a few times. Quoted spans stay atomic.

Everything that is collected or broadcast is bounded by construction: only values, words and bigrams that make up at least a
given share of all those of their field are kept, so at most 1 / share of them.
"""

from __future__ import annotations

import ast
import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.missing import is_missing, says_nothing
from recordloom.session import cut

# Least share of a field's values (words, bigrams) that an entry of the model needs: at most 1 / share entries each.
VALUE_SHARE, WORD_SHARE, BIGRAM_SHARE = 1 / 100_000, 1 / 5_000, 1 / 100_000
ROUNDS = 2

# The lattice has no edge for a value that would hold more delimiters than score this much together (ten commas, twenty "and").
MOST_JOINED = 30.0
# Log scores of separating and of joining at a delimiter, by kind.
DELIMITERS = {"hard": (0.0, -14.0), ",": (-0.1, -3.0), "and": (-0.5, -1.5), "&": (-0.5, -1.5), "+": (-0.2, -2.5), " / ": (-0.2, -2.5), "/": (-1.5, -0.5)}
_QUOTED = r'"(?:[^"]|"")*"|“[^”]*”|«[^»]*»|„[^“”]*[“”]'
_SCAN = re.compile(
    rf"""(?P<quote>{_QUOTED}|(?<!\w)'(?:[^']|(?<=\w)'(?=\w))*'(?!\w))
    |(?P<mark>(?:(?<=\s)|^)\(\d{{1,2}}\)(?=\s)|(?:(?<=\n)|^)[ \t]*(?:[-*•‣▪–]|\d{{1,2}}[.)])[ \t]+)
    |(?P<keep>\((?:[^()]|\([^()]*\))*\)|\d{{1,3}}(?:,\d{{3}})+(?!\d)|\w\+\+)
    |(?P<hard>[\n\r\t|;•·、；，‖¦]+)
    |(?P<comma>,)
    |(?P<and>(?<=\s)(?:and|&|\+|/)(?=\s))
    |(?P<slash>/)
    |(?P<text>\w+|.)""",
    re.X | re.S,
)
_INNER = frozenset((",", ";", "/", "&", "+", "and"))
_WORD = re.compile(r"\w[\w.'’-]*|[^\w\s]")


def _unquote(s: str) -> str:
    s = s.strip()
    while len(s) > 1 and (s[0], s[-1]) in {('"', '"'), ("'", "'"), ("“", "”"), ("«", "»"), ("„", "“"), ("„", "”")}:
        s = s[1:-1].replace(s[0] * 2, s[0]) if s[0] in "\"'" else s[1:-1]
        s = s.strip()
    return s


def _literal(s: str) -> list[str] | None:
    if not (s.startswith("[") and s.endswith("]")):
        return None
    for read in (json.loads, ast.literal_eval):
        try:
            got = read(s)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            continue
        if isinstance(got, list) and all(isinstance(x, (str, int, float)) for x in got):
            return [str(x) for x in got]
    return None


def atoms(text: str) -> tuple[list[tuple[int, int]], list[str], str]:
    """Spans of the atoms, the kinds of the delimiters between them, and the text that the spans refer to."""
    s = text.strip()
    if len(s) > 1 and s[0] == "[" and s[-1] == "]":
        s = s[1:-1].strip()
    spans: list[tuple[int, int]] = []
    kinds: list[str] = []
    start, quoted, pending, last_quoted = None, False, [], False
    end = 0

    def close() -> None:
        nonlocal start, quoted, pending, last_quoted
        if start is None:
            return
        if spans:
            kind = pending[0] if len(pending) == 1 else "," if sorted(pending) == [",", "and"] or sorted(pending) == ["&", ","] else "hard"
            kinds.append("hard" if quoted or last_quoted else kind)
        spans.append((start, end))
        last_quoted, start, quoted, pending = quoted, None, False, []

    for m in _SCAN.finditer(s):
        g = m.lastgroup
        if g == "quote" and start is None:
            start, end, quoted = m.start(), m.end(), True
            continue
        if g in ("text", "keep", "quote"):
            if not m[0].isspace():
                if start is None:
                    start = m.start()
                elif quoted:
                    quoted = False  # text follows a quote: the quote was part of a longer value
                end = m.end()
            continue
        if g == "slash" and (start is None or m.end() >= len(s) or s[m.end()].isspace()):
            g, kind = "and", " / "
        elif g == "and":
            kind = " / " if m[0] == "/" else m[0]
        else:
            kind = {"mark": "hard", "hard": "hard", "comma": ",", "slash": "/"}[g]
        close()
        if spans:
            pending.append(kind)
    close()
    return spans, kinds, s


def _clean(item: str) -> str:
    return _unquote(re.sub(r"^\s*(?:\(\d{1,2}\)|[-*•‣▪]|\d{1,2}[.)])\s+", "", item))


def _certain(text: str) -> tuple[list[str] | None, tuple]:
    """The values of a text that only unmistakable delimiters cut, else None and its atoms."""
    if (got := _literal(text.strip())) is not None:
        return [x for x in map(_clean, got) if x], ()
    spans, kinds, s = atoms(text)
    if all(k == "hard" for k in kinds):
        return [x for x in (_clean(s[a:b]) for a, b in spans) if x], ()
    return None, (spans, kinds, s)


class Model:
    """Value, word and bigram counts of one field, all bounded by their shares."""

    def __init__(self, n: float, values: dict, words: set, bigrams: dict):
        self.n, self.words = max(n, 1.0), words
        self.values = {v: math.log(0.5 * c / self.n) for v, c in values.items()}
        self.bigrams = bigrams
        self.out: Counter = Counter()
        self.into: Counter = Counter()
        for (a, b), c in bigrams.items():
            self.out[a] += c
            self.into[b] += c
        self.total = sum(self.into.values()) + 1.0
        self.steps: dict = {}  # log scores of bigrams and of values met before
        self.scores: dict = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"steps": {}, "scores": {}}

    def shape(self, w: str) -> str:
        return w if w in self.words else "<9>" if w[0].isdigit() else "<A>" if w[0].isupper() else "<a>" if w.isalpha() else w if len(w) == 1 else "<x>"

    def chain(self, item: str) -> list[str]:
        out, after = ["<s>"], False
        for w in _WORD.findall(item):  # what follows a delimiter inside a value is another word than at its start
            out.append("," + self.shape(w) if after else self.shape(w))
            after = w in _INNER
        return [*out, "</s>"]

    def step(self, a: str, b: str) -> float:
        got = self.steps.get((a, b))
        if got is None:
            got = self.steps[a, b] = math.log((self.bigrams.get((a, b), 0.0) + 2e-3 * (self.into.get(b, 0.0) + 0.01) / self.total) / (self.out.get(a, 0.0) + 2e-3))
        return got

    def score(self, item: str) -> float:
        got = self.scores.get(item)
        if got is None:
            known, c = self.values.get(item, -60.0), self.chain(item)
            s = sum(map(self.step, c, c[1:])) - 0.7
            if len(self.scores) > 200_000:
                self.scores.clear()
                self.steps.clear()
            got = self.scores[item] = max(known, s) + math.log1p(math.exp(-abs(known - s)))
        return got


def segment(text: str, model: Model) -> list[str]:
    """The most likely values of a text, in order; empty pieces are skipped."""
    sure, rest = _certain(text)
    if sure is not None:
        return sure
    spans, kinds, s = rest
    n = len(spans)
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    for j in range(1, n + 1):
        joined = 0.0
        for i in range(j - 1, -1, -1):
            if i < j - 1:
                if kinds[i] == "hard":
                    break
                joined += DELIMITERS[kinds[i]][1]
                if joined < -MOST_JOINED:
                    break
            score = best[i] + joined + model.score(_clean(s[spans[i][0] : spans[j - 1][1]])) + (DELIMITERS[kinds[i - 1]][0] if i else 0.0)
            if score > best[j]:
                best[j], back[j] = score, i
    cuts, j = [], n
    while j:
        cuts.append((back[j], j))
        j = back[j]
    return [x for x in (_clean(s[spans[i][0] : spans[j - 1][1]]) for i, j in reversed(cuts)) if x]


_STATS = "field_name string, kind string, a string, b string, n double"


def _tally(counts: Counter) -> pd.DataFrame:
    return pd.DataFrame([(f, k, a, b, float(n)) for (f, k, a, b), n in counts.items()], columns=["field_name", "kind", "a", "b", "n"])


def _flag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.assign(sure=[_certain(text)[0] for text in pdf.text])


def _first_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        c: Counter = Counter()
        for f, text, n, sure in zip(pdf.field_name, pdf.text, pdf.n, pdf.sure):
            if sure is None:  # the whole text may be one value: it counts, but less
                c[f, "v", text.strip(), ""] += 0.5 * n
                c[f, "n", "", ""] += n
                continue
            for x in sure:
                c[f, "v", x, ""] += n
                c[f, "n", "", ""] += n
            for w in {w for x in sure for w in _WORD.findall(x)}:
                c[f, "w", w, ""] += n
        yield _tally(c)


def _path_counts(models):
    """Values, words next to each other and the number of values on the best paths; sure texts have one path only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_field = models.value
        for pdf in batches:
            c: Counter = Counter()
            for f, text, n, sure in zip(pdf.field_name, pdf.text, pdf.n, pdf.sure):
                m = by_field[f]
                for x in segment(text, m) if sure is None else sure:
                    c[f, "n", "", ""] += n
                    c[f, "v", x, ""] += n
                    chain = m.chain(x)
                    for a, b in zip(chain, chain[1:]):
                        c[f, "b", a, b] += n
            yield _tally(c)

    return run


def _collect(stats: DataFrame) -> dict:
    """Field -> kind -> {entry: count}: entries below their share are dropped before they leave the executors."""
    # partial sums first, then the totals that the shares refer to
    sums = stats.groupBy("field_name", "kind", "a", "b").agg(F.sum("n").alias("n"))
    kept = cut(sums)
    totals = {(r["field_name"], r["kind"]): r["n"] for r in kept.groupBy("field_name", "kind").agg(F.sum("n").alias("n")).collect()}
    share = {"v": VALUE_SHARE, "w": WORD_SHARE, "b": BIGRAM_SHARE, "n": 0.0}
    least = F.lit(0.0)
    for (f, k), n in totals.items():
        floor = max(1.5 if k == "v" else 0.0, share[k] * n)
        least = F.when((F.col("field_name") == f) & (F.col("kind") == k), F.lit(floor)).otherwise(least)
    out: dict = {}
    for r in kept.where(F.col("n") >= least).collect():
        key = (r["a"], r["b"]) if r["kind"] == "b" else r["a"]
        out.setdefault(r["field_name"], {}).setdefault(r["kind"], {})[key] = r["n"]
    return out


def column_texts(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(field_name, text, n): the distinct texts of the fields, each with its number of records; missing ones are left out."""
    long = df.select(key, F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields])).alias("x"))
    texts = long.select(key, "x.field_name", "x.text").where(~is_missing(F.col("text")))
    # a record delivered twice repeats its texts: count it once
    return texts.distinct().groupBy("field_name", "text").agg(F.count("*").cast("double").alias("n"))


def learn(texts: DataFrame, rounds: int = ROUNDS) -> dict[str, Model]:
    """Models by field from (field_name, text, n). An empty input gives no model."""
    sc = texts.sparkSession.sparkContext
    # few bytes but much Python: a fixed number of partitions, which adaptive execution does not merge
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flagged = cut(texts.select("field_name", "text", "n").repartition(parts).mapInPandas(_flag, "field_name string, text string, n double, sure array<string>"))
    first = _collect(flagged.mapInPandas(_first_counts, _STATS))
    models = {f: Model(sum(x.get("n", {}).values()), x.get("v", {}), set(x.get("w", {})), {}) for f, x in first.items()}
    # the paths of sure texts are the same in every round: they are counted once
    sure = cut(flagged.where(F.col("sure").isNotNull()).mapInPandas(_path_counts(sc.broadcast(models)), _STATS).groupBy("field_name", "kind", "a", "b").agg(F.sum("n").alias("n")))
    unsure = flagged.where(F.col("sure").isNull())
    for step in range(rounds + 1):
        got = _collect(sure if step == 0 else sure.unionByName(unsure.mapInPandas(_path_counts(sc.broadcast(models)), _STATS)))
        for f, m in models.items():
            x = got.get(f, {})
            values = x.get("v") if step else first[f].get("v", {})
            n = sum(x.get("n", {}).values()) if step else m.n
            models[f] = Model(n, values or {}, m.words, x.get("b", {}))
    return models


_OUT = "field_name string, pos int, item string, n_items int"


def split(df: DataFrame, key: str, fields: list[str], models: dict[str, Model]) -> DataFrame:
    """(key, field_name, pos, item, n_items): one row for each value of each field.

    A missing field yields nothing, a field with one value one row with pos 1. Rows delivered twice count once.
    """
    at = df.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_field = at.value
        cache: dict = {}
        for pdf in batches:
            keys, names, pos, items, sizes = [], [], [], [], []
            for f in fields:
                for k, text in zip(pdf[key], pdf[f]):
                    if says_nothing(text) or f not in by_field:
                        continue
                    got = cache.get((f, text))
                    if got is None:
                        if len(cache) > 50_000:
                            cache.clear()
                        got = cache[f, text] = segment(text, by_field[f])
                    keys += [k] * len(got)
                    names += [f] * len(got)
                    pos += range(1, len(got) + 1)
                    items += got
                    sizes += [len(got)] * len(got)
            yield pd.DataFrame({key: keys, "field_name": names, "pos": pos, "item": items, "n_items": sizes})

    narrow = df.select(key, *fields).dropDuplicates([key])
    kind = dict(df.dtypes)[key]
    return narrow.mapInPandas(run, f"{key} {kind}, {_OUT}")


def unpack(df: DataFrame, key: str, fields: list[str], rounds: int = ROUNDS) -> DataFrame:
    """Learn from the whole columns, then split them; see split."""
    return split(df, key, fields, learn(column_texts(df, key, fields), rounds))
