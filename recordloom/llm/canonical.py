"""Mapping of freely typed values to the entries of a reference list, with the rest reported as unmatched.

Nothing is known but the reference list and the column. Every entry is looked up under its name, its aliases, and what can be
computed from them: runs of words as initials, and initials that the list itself explains written out. Distinct values are
normalised and looked up in an inverted index of the character n-grams of these texts; each candidate is scored by the weighted
cosine of the n-grams. Two things letters alone cannot see are added by exact rules: a value whose initials or word beginnings
spell an entry, and names that the column itself gives in brackets next to a sure match. A value goes to its best entry if the
score passes a threshold and leads the best other entry by a margin.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.missing import is_missing
from recordloom.session import cut

#: Least score, and least lead over the best other entry.
THRESHOLD, MARGIN = 0.6, 0.03
#: What a form that leaves out a part of the value counts; what a spelled-out name of n words lacks, times n.
PART, SPELLED = 0.97, 0.8
#: What a form of known words only counts: where it agrees with a name it just passes, so that whatever else is known goes first.
KNOWN = 0.65
#: Weight of an n-gram that no entry holds, against one that a single entry holds.
UNSEEN = 0.2
#: Texts in which a name stands in brackets next to a sure match, and the share of them that must agree, before it is learned.
LEARN_TEXTS, LEARN_SHARE = 3, 0.9

# Words that say how, not what.
STOP = ("a", "an", "the", "of", "for", "to", "with", "without", "and", "or", "in", "on", "only", "style", "like", "based", "type", "under")
_STOP_RE = r"(?<![\p{L}\p{N}])(?:" + "|".join(STOP) + r")(?![\p{L}\p{N}])"


def normal(c: Column) -> Column:
    """Lower case, one space between words, spellings and versions unified (v3, version 3, 3.0 and gplv3 alike), no stop words."""
    s = F.regexp_replace(F.lower(c), r"\bw(?:/o|/|\.)(?=\s)", " ")  # w. momentum, w/o momentum
    s = F.regexp_replace(s, r"\b(?:(\p{L})\.)(?=\p{L}\.)", "$1")  # m.i.t. -> mi + t.
    s = F.regexp_replace(s, r"licen[cs]e", "license")
    s = F.regexp_replace(s, r"(\p{L})our\b", "$1or")
    s = F.regexp_replace(s, r"(\p{L})is(?=(?:e|er|ed|ing|ation)\b)", "$1iz")
    for i, word in enumerate(("one", "two", "three", "four", "five"), 1):
        s = F.regexp_replace(s, rf"\b{word}\b", str(i))
    s = F.regexp_replace(s, r"(?<=\p{L})2(?=\p{L})", " to ")
    s = F.regexp_replace(s, r"(\p{L}{3})(\d)", "$1 $2")
    s = F.regexp_replace(s, r"(\p{L})v\s?(\d)", "$1 $2")
    s = F.regexp_replace(s, r"\b(?:version|ver|v)\.?\s*(\d)", "$1")
    s = F.regexp_replace(s, r"(\d)\.0\b", "$1")
    s = F.regexp_replace(s, r"[^\p{L}\p{N}.]+|\.(?!\d)|(?<!\d)\.(?!\d)", " ")
    bare = F.trim(F.regexp_replace(F.regexp_replace(s, _STOP_RE, " "), r"\s+", " "))
    return F.when(bare == "", F.trim(F.regexp_replace(s, r"\s+", " "))).otherwise(bare)


def forms(c: Column, field: Column) -> Column:
    """The forms of a value that are looked up: the whole, then without notes in brackets, without a note of origin, without numbers, its head, and what stands in brackets."""
    no_brackets = F.regexp_replace(c, r"\s*[(\[][^)\]]*[)\]]", " ")
    no_origin = F.regexp_replace(no_brackets, r"(?i)\s*[,;:-]?\s*\b(?:per|see|cf|according to|as reported|as stated|default settings|from)\b.*$", "")
    head = F.regexp_replace(no_origin, r"[,;:].*$", "")
    no_numbers = F.regexp_replace(no_origin, r"(?<![\w.])[\d.]+(?![\w.])", " ")
    inside = F.regexp_extract(c, r"[(\[]([^)\]]*)[)\]]", 1)
    one = lambda text, weight: F.struct(without(normal(text), field).alias("form"), F.lit(weight).alias("weight"))
    return F.filter(F.array(one(c, 1.0), one(no_brackets, PART), one(no_origin, PART), one(no_numbers, PART * PART), one(head, PART * PART), one(inside, PART * PART)), lambda x: x["form"] != "")


def without(form: Column, field: Column) -> Column:
    """A normalised text without the words of the field's own name, unless nothing else is in it."""
    words = F.filter(F.split(form, " "), lambda w: ~F.array_contains(F.split(field, "_"), w))
    return F.when(F.size(words) > 0, F.array_join(words, " ")).otherwise(form)


def grams(form: Column) -> Column:
    """Distinct character 2- and 3-grams of a text with its ends marked."""
    s = F.concat(F.lit(" "), form, F.lit(" "))
    n = F.length(s)
    two = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(s, i, F.lit(2)))
    three = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.substring(s, i, F.lit(3)))
    return F.array_distinct(F.concat(two, three))


def _runs(words: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of two words or more, none of them a number or shorter than three letters."""
    good = [len(w) > 2 and w.isalpha() for w in words]
    for i in range(len(words)):
        j = i
        while j < len(words) and good[j]:
            j += 1
            if j - i > 1:
                yield i, j


def shortened(alias: str) -> set[tuple[str, bool]]:
    """A normalised name and its short forms: the run of words at its end, before a number if any, as initials (of three letters
    or more where nothing else is left), its first word with the initials of the rest, and every word cut to three letters."""
    words = alias.split()
    last = len(words) - bool(words and words[-1][0].isdigit())
    out = {(alias, False)}
    for i, j in _runs(words):
        if j == last and (i or j - i > 2):
            out.add((" ".join([*words[:i], "".join(w[0] for w in words[i:j]), *words[j:]]), False))
    if len(words) > 1 and all(w.isalpha() for w in words):
        out.add((words[0] + "".join(w[0] for w in words[1:]), True))
        out.add((" ".join(w[:3] for w in words), True))
    return out


def spelled(form: str) -> set[tuple[str, int]]:
    """What the initials of a run of words spell, one inner word left out or the last one begun if need be, and what the
    beginnings of two words next to each other spell; each with the number of words that take part."""
    words = form.split()
    out: set = set()
    for i, j in _runs(words):
        initials = "".join(w[0] for w in words[i:j])
        if j - i > 2:
            out.add((initials, j - i))
            out.update((initials[:-1] + words[j - 1][:k], j - i) for k in range(2, min(6, len(words[j - 1]))))
        if j - i > 3:
            out.update((initials[:k] + initials[k + 1 :], j - i - 1) for k in range(1, j - i - 1))
        if j - i == 2:
            a, b = words[i:j]
            out.update((a[:m] + b[:k], 2) for m in range(2, min(5, len(a))) for k in range(1, min(3, len(b))))
    return out


def _each(function, column: str, names: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [sorted(function(x)) for x in pdf[column]]
            rows = [(*row, *x) for row, g in zip(pdf.itertuples(index=False), got) for x in g]
            yield pd.DataFrame(rows, columns=[*pdf.columns, *names])

    return run


def entries(terms: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """(field_name, term_id, alias): every text under which an entry is looked up, each once.

    Names, aliases and their short forms; names without the words that a third of the field's entries hold; words in capitals that
    one entry alone holds; names in which initials of another entry are written out. more: names the caller adds, (field_name,
    term_id, alias).
    """
    raw = terms.select("field_name", "term_id", F.explode(F.concat(F.array("term"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("alias"))
    if more is not None:
        raw = raw.unionByName(more.select("field_name", "term_id", "alias"))
    own = raw.select("field_name", "term_id", without(normal(F.col("alias")), F.col("field_name")).alias("alias")).where("alias != ''").distinct()
    # words that many entries hold say little about which is meant
    words = own.select("field_name", "term_id", F.explode(F.split("alias", " ")).alias("word")).distinct()
    n = terms.groupBy("field_name").agg(F.countDistinct("term_id").alias("n_terms"))
    spread = words.groupBy("field_name", "word").agg(F.count("*").alias("df")).join(n, "field_name")
    generic = spread.where("3 * df >= n_terms and word rlike '[a-z]'").groupBy("field_name").agg(F.collect_set("word").alias("generic"))
    told = own.join(generic, "field_name").withColumn("alias", F.array_join(F.filter(F.split("alias", " "), lambda w: ~F.array_contains(F.col("generic"), w)), " "))
    own = own.unionByName(told.where("alias rlike '[a-z]'").select("field_name", "term_id", "alias")).distinct()
    short = own.mapInPandas(_each(shortened, "alias", ["form", "exact"]), "field_name string, term_id bigint, alias string, form string, exact boolean")
    capitals = raw.where(~F.col("alias").rlike(r"\d(?:\.\d+)*$")).select("field_name", "term_id", F.explode(F.regexp_extract_all("alias", F.lit(r"(?<![\p{L}\p{N}])(\p{Lu}{3,})(?![\p{L}\p{N}])"), F.lit(1))).alias("alias")).select("field_name", "term_id", F.lower("alias").alias("alias")).distinct()
    alone = capitals.join(spread.where("df = 1").select("field_name", F.col("word").alias("alias")), ["field_name", "alias"]).select("field_name", "term_id", "alias")
    # initials that are a whole name of one entry stand for its words in the names of others
    meant = short.where("form != alias and form not like '% %'").select("field_name", F.col("form").alias("word"), F.col("alias").alias("words")).distinct()
    held = own.select("field_name", "term_id", "alias", F.explode(F.split("alias", " ")).alias("word")).join(meant, ["field_name", "word"]).where("alias != word")
    out = lambda c: F.regexp_replace(F.concat(F.lit(" "), F.col("alias"), F.lit(" ")), F.concat(F.lit(" "), F.col("word"), F.lit(" ")), F.concat(F.lit(" "), F.col(c), F.lit(" ")))
    explained = held.select("field_name", "term_id", F.trim(out("words")).alias("alias"))
    every = short.select("field_name", "term_id", F.col("form").alias("alias"), "exact").unionByName(explained.unionByName(alone).withColumn("exact", F.lit(False)))
    every = every.groupBy("field_name", "term_id", "alias").agg(F.min("exact").alias("exact"))
    # a computed form that two entries share names neither, unless it is one's own
    w = Window.partitionBy("field_name", "alias")
    marked = every.join(own.withColumn("own", F.lit(1)), ["field_name", "term_id", "alias"], "left")
    return marked.withColumn("n", F.count("*").over(w)).where("n = 1 or own = 1").select("field_name", "term_id", "alias", "exact")


def _numbers(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1)))


def _scores(looked: DataFrame, index: DataFrame) -> DataFrame:
    """(field_name, value, term_id, score) from (field_name, value, form, weight): the best score of each entry for each value."""
    alias_grams = index.withColumn("gram", F.explode(grams(F.col("alias"))))
    size = index.groupBy("field_name").agg(F.countDistinct("term_id").alias("n_terms"))
    df = alias_grams.groupBy("field_name", "gram").agg(F.countDistinct("term_id").alias("df")).join(size, "field_name")
    weights = df.select("field_name", "gram", F.log((F.col("n_terms") + 1) / F.col("df")).alias("idf"))
    weighted = alias_grams.join(weights, ["field_name", "gram"])
    norms = weighted.groupBy("field_name", "alias", "term_id", "exact").agg(F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("alias_norm"))
    # one row a gram with the entries that hold it: the index is made once and read by every use below
    postings = cut(weighted.join(norms, ["field_name", "alias", "term_id", "exact"]).groupBy("field_name", "gram").agg(
        F.max("idf").alias("idf"), F.collect_list(F.struct("term_id", "alias", "exact", "alias_norm")).alias("holders")))
    unseen = size.select("field_name", (F.log(F.col("n_terms") + 1) * UNSEEN).alias("unseen"))

    # as above: adaptive execution would merge the forms into one partition
    parts = int(looked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = looked.select("field_name", "form").distinct().repartition(parts)
    q = distinct.withColumn("gram", F.explode(grams(F.col("form")))).join(postings, ["field_name", "gram"], "left").join(unseen, "field_name")
    q = q.withColumn("w", F.coalesce("idf", "unseen"))
    form_norms = q.groupBy("field_name", "form").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("form_norm"))
    dots = q.select("field_name", "form", "w", F.explode("holders").alias("h")).groupBy("field_name", "form", "h").agg(F.sum(F.col("w") * F.col("w")).alias("dot"))
    scored = dots.join(form_norms, ["field_name", "form"]).select("field_name", "form", "h.term_id", "h.alias", "h.exact", (F.col("dot") / F.col("h.alias_norm") / F.col("form_norm")).alias("cosine"))
    other = (F.size(_numbers(F.col("alias"))) > 0) & (F.size(_numbers(F.col("form"))) > 0) & ~F.arrays_overlap(_numbers(F.col("alias")), _numbers(F.col("form")))
    unsaid = F.col("alias").rlike(r"\d$") & (F.size(_numbers(F.col("form"))) == 0)  # a version, not the number of a clause
    glued = lambda c: F.regexp_replace(c, " ", "")
    same = glued("form") == glued("alias")
    score = F.when(same, 1.0).otherwise(F.least("cosine", F.lit(0.999)))
    by_term = scored.where(~other & ~unsaid & (~F.col("exact") | same)).groupBy("field_name", "form", "term_id").agg(F.max(score).alias("score"))
    names = index.where("alias not like '% %'").select("field_name", "term_id", F.col("alias").alias("spelled"))
    by_letters = distinct.mapInPandas(_each(spelled, "form", ["spelled", "n"]), "field_name string, form string, spelled string, n int").join(names, ["field_name", "spelled"])
    by_letters = by_letters.where("form != spelled").select("field_name", "form", "term_id", (1 - SPELLED / F.col("n")).alias("score"))
    by_term = by_term.unionByName(by_letters)
    return looked.join(by_term, ["field_name", "form"]).groupBy("field_name", "value", "term_id").agg(F.max(F.col("score") * F.col("weight")).alias("score"))


def _looked(values: DataFrame, index: DataFrame) -> DataFrame:
    """(field_name, value, form, weight): the forms of each value, and those forms again with none but words of the index."""
    # few bytes but many expressions: a fixed number of partitions, and written once for the three uses below
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = values.repartition(parts)
    each = spread.select("field_name", "value", F.explode(forms(F.col("value"), F.col("field_name"))).alias("f")).select("field_name", "value", "f.form", "f.weight")
    each = cut(each.groupBy("field_name", "value", "form").agg(F.max("weight").alias("weight")))
    words = index.where("not exact").select("field_name", F.explode(F.split("alias", " ")).alias("word")).distinct()
    at = each.select("field_name", "form").distinct().select("field_name", "form", F.posexplode(F.split("form", " ")).alias("pos", "word"))
    known = at.join(words, ["field_name", "word"]).groupBy("field_name", "form").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("known"))
    part = each.join(known, ["field_name", "form"]).where("known != form").select("field_name", "value", F.col("known").alias("form"), (F.col("weight") * KNOWN).alias("weight"))
    return each.unionByName(part).groupBy("field_name", "value", "form").agg(F.max("weight").alias("weight"))


def learned(chosen: DataFrame) -> DataFrame:
    """(field_name, form, term_id): what stands in brackets in several texts that are sure of one entry names that entry too."""
    inside = without(normal(F.regexp_extract("value", r"\w\s*\(([^)]*)\)", 1)), F.col("field_name"))
    seen = chosen.where("term_id > 0").select("field_name", "term_id", inside.alias("form")).where("form != ''")
    counts = seen.groupBy("field_name", "form", "term_id").agg(F.count("*").alias("n"))
    w = Window.partitionBy("field_name", "form")
    agreed = counts.withColumn("total", F.sum("n").over(w)).where((F.col("n") >= LEARN_TEXTS) & (F.col("n") >= LEARN_SHARE * F.col("total")))
    return agreed.select("field_name", "form", "term_id")


def _choose(by_value: DataFrame, threshold: float, margin: float) -> DataFrame:
    w = Window.partitionBy("field_name", "value").orderBy(F.col("score").desc(), F.col("term_id"))
    first = by_value.withColumn("rn", F.row_number().over(w)).withColumn("second", F.lead("score", 1, 0.0).over(w)).where("rn = 1")
    sure = (F.col("score") >= threshold) & ((F.col("score") - F.col("second") >= margin) | ((F.col("score") >= 1.0) & (F.col("second") < F.col("score"))))
    return first.select("field_name", "value", F.when(sure, F.col("term_id")).otherwise(F.lit(0)).cast("bigint").alias("term_id"), "score")


def match(values: DataFrame, terms: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN, more: DataFrame | None = None) -> DataFrame:
    """(field_name, value, term_id, score) for distinct (field_name, value); term_id 0 and score 0 or the best score if unmatched.

    An entry that states a version (a number) is no candidate of a value that states other numbers only: another version of a
    listed thing is not listed. Exact agreement with a name needs no margin; a tie of two entries is unmatched otherwise.
    """
    index = cut(entries(terms, more))
    looked = cut(_looked(values, index))
    by_value = cut(_scores(looked, index))
    first = _choose(by_value, threshold, margin)
    told = looked.join(learned(first), ["field_name", "form"]).select("field_name", "value", "term_id", F.col("weight").alias("score"))
    both = by_value.unionByName(told).groupBy("field_name", "value", "term_id").agg(F.max("score").alias("score"))
    chosen = _choose(both, threshold, margin)
    return values.join(chosen, ["field_name", "value"], "left").withColumns({"term_id": F.coalesce("term_id", F.lit(0).cast("bigint")), "score": F.coalesce("score", F.lit(0.0))})


def map_fields(df: DataFrame, terms: DataFrame, key: str, fields: list[str], more: DataFrame | None = None) -> DataFrame:
    """(key, field_name, value, term_id, score) for each value that is not missing and not literally a term of its field.

    Rows delivered twice count once. Values are matched once each, however many rows hold them. An empty reference list leaves
    every value unmatched; empty input gives no row. more: names the caller adds to the list, (field_name, term_id, alias).
    """
    long = df.select(key, F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields])).alias("x"))
    long = long.select(key, "x.field_name", "x.value").where(~is_missing(F.col("value"))).distinct()
    literal = terms.select("field_name", F.col("term").alias("value")).distinct()
    asked = long.join(literal, ["field_name", "value"], "left_anti")
    values = asked.select("field_name", "value").distinct()
    return asked.join(match(values, terms, more=more), ["field_name", "value"]).select(key, "field_name", "value", "term_id", "score")
