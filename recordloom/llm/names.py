"""Variant spellings of names of organizations and model families, linked to the entity that they name.

Each distinct text is rewritten to all its canonical forms by rules: legal forms and notes are dropped, words for the kind of body
and their abbreviations and initials become one kind, the parts stand in every order, glued or parted, a nickname stands for each
given name it is short for, a given name is stated, cut to its initial or left out. The forms of all texts are exploded and
equi-joined. A form is scored by its rarity, the log of all entities over those that can be rewritten to it: the rarest form of a
text decides, and one that several entities share (an initial or a surname that fits two given names) links nothing. Typos are met
by deletion forms of the distinctive part of a name.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.edits import canonical_stems
from recordloom.operators import packed
from recordloom.session import cut

# Nicknames by given name. Several of them are short for more than one.
NICKNAMES = {
    "albert": ("al", "bert", "bertie"), "alexander": ("alex", "al", "sasha", "xander", "sandy"), "alexandra": ("alex", "sandra", "sasha"), "andrew": ("andy", "drew"), "anthony": ("tony",), "barbara": ("barb", "babs"), "benjamin": ("ben", "benny"), "catherine": ("cathy", "cate", "kate", "kathy", "cat"),
    "charles": ("charlie", "chuck"), "christine": ("chris", "chrissy", "tina"), "christopher": ("chris", "kit"), "daniel": ("dan", "danny"), "david": ("dave",), "deborah": ("deb", "debbie"), "dorothy": ("dot", "dolly"), "edward": ("ed", "eddie", "ted", "ned"), "elizabeth": ("liz", "beth", "lizzie", "eliza", "betty", "bess"),
    "frederick": ("fred", "freddy", "freddie", "rick"), "george": ("georgie",), "gregory": ("greg",), "henry": ("harry", "hank", "hal"), "james": ("jim", "jimmy", "jamie"), "jennifer": ("jen", "jenny"), "john": ("jack", "johnny", "jon"), "jonathan": ("jon", "nathan"), "joseph": ("joe",), "katherine": ("kate", "kathy", "katie", "kat", "kathrin"),
    "lawrence": ("larry",), "leonard": ("leo", "len"), "margaret": ("maggie", "peggy", "meg", "greta"), "matthew": ("matt",), "michael": ("mike", "mick", "mickey"), "nicholas": ("nick",), "patricia": ("pat", "patty", "trish"), "patrick": ("pat", "paddy"), "peter": ("pete",), "philip": ("phil",), "rebecca": ("becky",),
    "richard": ("rich", "dick", "rick", "ricky"), "robert": ("bob", "rob", "bobby", "robbie", "bert"), "ronald": ("ron",), "samuel": ("sam",), "stephen": ("steve",), "susanne": ("sue", "susi", "susie", "sanne", "suzy", "susan"), "theodore": ("theo", "ted", "teddy"), "thomas": ("tom", "tommy"), "timothy": ("tim",),
    "victoria": ("vicky", "tori"), "vincent": ("vince",), "walter": ("walt",), "william": ("will", "bill", "billy"),
}
_SHORT_FOR: dict = {}
for _full, _nicks in NICKNAMES.items():
    for _nick in (_full, *_nicks):
        _SHORT_FOR.setdefault(_nick, []).append(_full)

# Legal forms, words for kinds of bodies and for what they do, and words that say nothing about the name.
LEGAL = ("inc", "ltd", "limited", "gmbh", "llc", "corp", "corporation", "co", "company", "plc", "ag", "sa", "bv", "ev", "eV", "foundation")
KINDS = {
    "trust": ("trust",),
    "university": ("university", "universität", "université", "universidad"),
    "labs": ("labs", "laboratory", "laboratories"),
    "institute": ("institute", "institut", "instituto"),
}
SUBJECTS = ("artificial", "intelligence", "machine", "research")
_KIND_OF = {w: k for k, words in KINDS.items() for w in words}
_KNOWN = tuple(_KIND_OF) + SUBJECTS
#: Initials of a kind of body with two subjects (IMI, LAI and so on).
_INITIALS = {k[0] + a[0] + b[0]: k for k in KINDS for a in SUBJECTS for b in SUBJECTS if a != b}
_SMALL = ("the", "of", "for", "at", "and", "in")
OFFSHOOTS = {"open": "open", "coder": "coder", "code": "coder", "vision": "vision", "vl": "vision", "math": "math", "maths": "math"}
_FAMILY_WORDS = ("the", "model", "models", "family", "series", "lm", "llm", "lms", "llms", "language", "suite")
_CAMEL = re.compile(r"(?<=[a-zà-ÿ])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")
_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:\.\d+)*")


def _near(word: str, known: dict | tuple) -> str | None:
    """A known word of five letters or more that differs by one letter left out, added, replaced or two swapped."""
    if word in known:
        return word
    if len(word) < 5:
        return None
    for k in known:
        if len(k) < 5 or abs(len(k) - len(word)) > 1:
            continue
        i = 0
        while i < min(len(k), len(word)) and k[i] == word[i]:
            i += 1
        a, b = k[i:], word[i:]
        if a[1:] == b or a == b[1:] or a[1:] == b[1:] or (a[:2] == b[1::-1] and len(b) > 1 and a[2:] == b[2:]):
            return k
    return None


def _words(text: str, keep: dict | tuple) -> list[str]:
    """Lower-case words; camel case is parted only where it sets off a known word."""
    out = []
    for token in _TOKEN.findall(text):
        parts = _CAMEL.split(token) if not token.isupper() else [token]
        out.extend([p.lower() for p in parts] if any(p.lower() in keep for p in parts) else [token.lower()])
    return out


def _body_word(w: str, token: str, alone: bool) -> str | None:
    """The word for a kind or a subject that a token is, abbreviates or misspells; ai and the initials of a kind as they are."""
    if w in ("ai",) or (w in _INITIALS and token.isupper()):
        return w
    if w == "u" and not alone:
        return "university"
    if len(w) >= 3 and (full := next((k for k in _KNOWN if k.startswith(w)), None)):
        return full
    return _near(w, _KNOWN)


def _orders(parts: list[str]) -> list[str]:
    """The parts glued in every order (of more than three: as they stand, reversed and sorted), as they stand first."""
    every = itertools.permutations(parts) if len(parts) <= 3 else (parts, parts[::-1], sorted(parts))
    return list(dict.fromkeys("".join(p) for p in every))


def organization_form(text: str) -> tuple[str, list[str], list[str], list[tuple[str, str]]]:
    """(kind, given names, distinctive parts in every order, further (initial, part)) of an organization's name.

    given names: each that a given name or nickname in the text is short for, or the initial that stands for one, or none.
    further: forms of a name of two parts neither of which is a known given name, with each of them as the initial.
    """
    s = re.sub(r"\([^)]*\)", " ", text)
    s = re.sub(r"\b((?:[A-Za-z]\.){2,})", lambda m: m[1].replace(".", ""), s)  # A.I. -> AI
    words = [w for w in _words(s, _KIND_OF | dict.fromkeys((*LEGAL, "ai", "lab"))) if w not in LEGAL and w not in _SMALL]
    caps = {t.lower() for t in _TOKEN.findall(s) if t.isupper()}
    kinds, rest = set(), []
    for i, w in enumerate(words):
        k = _body_word(w, w.upper() if w in caps else w, len(words) == 1 or 0 < i < len(words) - 1)
        kinds.add(k) if k else rest.append(w)
    found = {_KIND_OF.get(k) or _INITIALS.get(k) for k in kinds}
    # a body without a word for its kind is a company, as one that calls itself labs
    kind = next((k for k in KINDS if k in found), "ai" if "ai" in kinds or {"artificial", "intelligence"} <= kinds or "research" in kinds else "labs")
    givens: list[str] = []
    if len(rest) > 1:
        at = next((i for i, w in enumerate(rest) if w in _SHORT_FOR), next((i for i, w in enumerate(rest) if len(w) == 1), next((i for i, w in enumerate(rest) if _near(w, NICKNAMES)), None)))
        if at is not None:
            w = rest.pop(at)
            givens = _SHORT_FOR.get(w) or [_near(w, NICKNAMES) or w]
    further = [(a[0], b) for a, b in (rest, rest[::-1])] if len(rest) == 2 and not givens else []
    return kind, givens, _orders(rest), further


def family_form(text: str) -> tuple[str, list[str], list[str], list[tuple[str, str]]]:
    """(offshoots, [], distinctive parts in every order, []) of a model family's name."""
    words = _words(text, OFFSHOOTS | dict.fromkeys(_FAMILY_WORDS))
    off, rest = [], []
    for w in words:
        k = _near(w, OFFSHOOTS)
        if k:
            off.append(OFFSHOOTS[k])
        elif _near(w, _FAMILY_WORDS) is None:
            rest.append(w)
    return "+".join(sorted(set(off))), [], _orders(rest), []


_RULES = {"organization": organization_form, "model_family": family_form}


_FORMS = "field_name string, name string, n double, kind string, givens array<string>, stems array<string>, further array<struct<initial: string, part: string>>"


def rewritten(texts: DataFrame) -> DataFrame:
    """(field_name, name, n, kind, givens, stems, further) from (field_name, name, n); texts without a distinctive part are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for f, t, n in zip(pdf.field_name, pdf.name, pdf.n):
                kind, givens, stems, further = _RULES[f](t)
                if stems and stems[0]:
                    out.append((f, t, n, kind, givens, stems, [{"initial": i, "part": p} for i, p in further]))
            yield pd.DataFrame(out, columns=["field_name", "name", "n", "kind", "givens", "stems", "further"])

    # few bytes but much Python: a fixed number of partitions, which adaptive execution does not merge into one
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.select("field_name", "name", "n").repartition(parts).mapInPandas(run, _FORMS)


def single_names(df: DataFrame, key: str) -> DataFrame:
    """(field_name, name, n): distinct texts that name one thing; of organizations those that the column's own segmentation does not split."""
    families = packed.column_texts(df, key, ["model_family"]).withColumnRenamed("text", "name")
    orgs = packed.column_texts(df, key, ["organization"])
    models = packed.learn(orgs)
    at = df.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            m = at.value.get("organization")
            got = [packed.segment(t, m) if m else [t] for t in pdf.text]
            one = [len(g) == 1 for g in got]
            yield pdf.rename(columns={"text": "name"})[one]

    return orgs.mapInPandas(run, "field_name string, name string, n double").unionByName(families)


def entities(names: DataFrame) -> DataFrame:
    """(field_name, name, n, entity, rarity): the entity of each distinct text.

    A text that states a given name, or whose parts are no given names, is of the entity that it spells out. One with a nickname of
    several given names, an initial or no given name asks for the entities that can be rewritten to its forms: it is of the one
    that its rarest form leads to, if that is one, and of an entity of its own otherwise. rarity is the log of all entities over
    those that share the form used. Texts without a distinctive part have no entity.
    """
    parsed = cut(rewritten(names))  # read by each of the groupings below
    base = ["field_name", "kind", "stem"]
    # of the orders of the parts, the one that most records state; ties go to the smaller text
    stated = parsed.groupBy("field_name", "kind", F.col("stems")[0].alias("stem")).agg(F.sum("n").alias("support"))
    orders = parsed.where(F.size("stems") > 1).select("field_name", "name", "kind", F.explode("stems").alias("stem"))
    best = orders.join(stated, base).groupBy("field_name", "name").agg(F.min(F.struct((-F.col("support")).alias("s"), "stem")).alias("best"))
    ordered = parsed.join(best, ["field_name", "name"], "left").withColumn("stem", F.coalesce("best.stem", F.col("stems")[0])).drop("best")
    canon = canonical_stems(ordered.groupBy(*base).agg(F.sum("n").alias("n")), ["field_name", "kind"])
    t = cut(ordered.join(canon, base).withColumn("stem", F.col("canonical")).drop("canonical"))

    own = F.when(F.size("givens") == 1, F.col("givens")[0]).otherwise(F.lit(""))  # of several given names none is stated
    t = t.withColumn("given", own)
    spelled = (F.length("given") > 1) | (F.size("further") > 0)
    owner = F.concat_ws("|", "kind", "given", "stem")
    owners = t.where(spelled).select(*base, "given", "further", owner.alias("entity")).dropDuplicates([*base, "given"])
    known = owners.where("given != ''").select(*base, "entity", F.explode(F.array(F.col("given"), F.substring("given", 1, 1), F.lit(""))).alias("form"))
    unknown = owners.where(F.size("further") > 0).select("field_name", "kind", F.explode("further").alias("f"), "entity").select("field_name", "kind", F.col("f.part").alias("stem"), "entity", F.col("f.initial").alias("form"))
    forms = known.unionByName(unknown).distinct()
    by_form = forms.groupBy(*base, "form").agg(F.count("*").alias("shared"), F.min("entity").alias("meant"))
    asked = t.where(~spelled).select("field_name", "name", *base[1:], F.explode(F.when(F.size("givens") > 0, F.col("givens")).otherwise(F.array(F.lit("")))).alias("form"))
    led = asked.join(by_form, [*base, "form"]).groupBy("field_name", "name").agg(F.min("shared").alias("shared"), F.collect_set(F.struct("shared", "meant")).alias("to"))
    rarest = F.filter("to", lambda x: x["shared"] == F.col("shared"))
    led = led.select("field_name", "name", "shared", F.when((F.col("shared") == 1) & (F.size(rarest) == 1), rarest[0]["meant"]).alias("meant"))
    total = t.select("field_name", owner.alias("entity")).distinct().groupBy("field_name").agg(F.count("*").alias("total"))
    linked = t.join(led, ["field_name", "name"], "left").join(F.broadcast(total), "field_name")  # one row a field
    nick = F.when((F.size("givens") > 1), F.concat_ws("/", "givens")).otherwise(F.col("given"))
    rarity = F.log(F.col("total") / F.coalesce("shared", F.lit(1)))
    return linked.select("field_name", "name", "n", F.coalesce("meant", F.concat_ws("|", "kind", nick, "stem")).alias("entity"), F.round(rarity, 6).alias("rarity"))


def variant_pairs(linked: DataFrame) -> DataFrame:
    """(field_name, name_1, name_2): every pair of different texts of one entity, the smaller in byte order first.

    The pairs are the result asked for; the join is on the entity, and a hot entity is split by Spark's skew handling.
    """
    a = linked.select("field_name", "entity", F.col("name").alias("name_1"))
    b = linked.select("field_name", "entity", F.col("name").alias("name_2"))
    return a.join(b, ["field_name", "entity"]).where("name_1 < name_2").select("field_name", "name_1", "name_2")
