"""Held-out items that stand in documents, wholly or partly, as they are or with other numbers and names.

Both sides are brought to one form (compatibility letters, no case, marks, punctuation, line breaks or hyphenation) and then to
templates: numbers, units and names (words that few items share) become typed placeholders that keep their value as a slot.
Template windows of both sides are hashed and hash-joined in Spark. Documents that share a window with an item are then compared
with it template window by template window: windows chain in the order of the item to passages, and the slots of a passage are
checked. Where most of them hold the item's own values, the passage is the item's text; where each name of the item has become
one other name throughout, it is a re-parameterised question. A document holds an item if its one or two best passages cover at
least half of the item.

Items are the stated query set. They stay in Spark; all that documents are checked with beforehand are the hashes of the items'
windows, broadcast while there are at most MAX_KEYS of them. With more, all windows of the documents take part in the join.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.session import cut

#: Words of a window that is joined with its names kept, of one joined as template only, and of a window of the comparison.
WINDOW, WIDE, SEED = 5, 24, 4
#: Share of an item that makes a leak.
SHARE = 0.5
#: A word is a name if at most this share of the distinct item texts holds it (or no more than two of them).
NAME_SHARE, NAME_TEXTS = 0.01, 2
#: Words that may be missing or strange between two windows of a passage, in the item and in the document.
ITEM_GAP, DOC_GAP = 14, 40
#: Tokens of documents whose windows are hashed side by side.
TOGETHER = 200_000
#: Hashes of items' windows that are broadcast as a filter: 32 MB.
MAX_KEYS = 4_000_000

# Units that a number may carry.
UNITS = frozenset("b kb mb gb tb m k bn percent pts points hours hour days day years year minutes gpus billion million mrd mio prozent punkte stunden uhr tokens".split())
_PLAIN = re.compile(r"[a-z]+|[0-9]+")
#: Marks that letters carry, and letters of scripts that put no space between words (Thai to Tibetan, Myanmar, Khmer, kana, Han):
#: of these each letter is a word.
_MARKS = "".join(re.escape(chr(x)) for x in range(0x300, 0x1F000) if unicodedata.category(chr(x))[0] == "M")
_LONE = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u9fff\U00020000-\U0003ffff"
_LETTER = rf"[^\W\d_{_LONE}]"
_TOKEN = re.compile(rf"{_LETTER}+(?:[{_MARKS}]+{_LETTER}*)*|\d+|(?=[^\W\d_])[{_LONE}][{_MARKS}]*")
_IS_LONE = re.compile(f"[{_LONE}]")
_BROKEN = re.compile(r"(?<=[^\W\d_])-[ \t]*\r?\n[ \t]*(?=[^\W\d_])")
_INVISIBLE = re.compile("[\u00ad\u200b-\u200d\u2060\ufeff]")
_ACCENTS = re.compile("[\u0300-\u036f]+")
_DROP = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])


def words(text: str) -> list[str]:
    """Words and numbers of a text in one canonical form; of scripts without spaces between words each letter."""
    if not text.isascii():
        if _INVISIBLE.search(text):
            text = text.translate(_DROP)
        text = unicodedata.normalize("NFKD", text)
        text = _ACCENTS.sub("", text)
    if "-\n" in text or "- \n" in text or "-\r" in text:
        text = _BROKEN.sub("", text)
    text = text.casefold()
    return (_PLAIN if text.isascii() else _TOKEN).findall(text)

#: Types of tokens, the two lowest bits of a token: an ordinary word, a name, a number, a unit.
WORD, NAME, NUM, UNIT = 0, 1, 2, 3
_SLOT = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class Typed:
    """Words to tokens: 62 bits of a hash and the type of the word, given the words that many items share."""

    def __init__(self, common: frozenset):
        self.common, self.seen = common, {}

    def token(self, w: str) -> int:
        kind = NUM if w[0].isdigit() else WORD if w in self.common else UNIT if w in UNITS else WORD if _IS_LONE.match(w) else NAME
        return (xxhash.xxh3_64_intdigest(w) >> 3 << 2) | kind

    def list(self, text: str) -> list[int]:
        if len(self.seen) > 500_000:
            self.seen.clear()
        seen, found = self.seen, words(text)
        for w in set(found).difference(seen):
            seen[w] = self.token(w)
        return [seen[w] for w in found]

    def __call__(self, text: str) -> np.ndarray:
        return np.array(self.list(text), np.int64)


def template(tokens: np.ndarray, keep_names: bool = False) -> np.ndarray:
    """Tokens with slots as placeholders; names stay if they are kept."""
    kind = tokens & 3
    slot = kind >= (NUM if keep_names else NAME)
    return np.where(slot, _SLOT[kind], tokens.astype(np.uint64))


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of every window of so many values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, size, np.uint64)
    for j in range(size):
        h = (h ^ values[j : j + n]) * np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(32)
    return h.astype(np.int64)


def compared(tokens: np.ndarray, size: int) -> np.ndarray:
    """A hash of every window of the comparison: its template, or its own words where the template holds nothing but slots."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    words = np.convolve((tokens & 3) == WORD, np.ones(size, int))[size - 1 : len(tokens)]
    return np.where(words > 0, window_hashes(template(tokens), size), ~window_hashes(tokens.astype(np.uint64), size))


def item_keys(tokens: np.ndarray, renamed: bool) -> dict[int, int]:
    """Position -> key of the windows that lead to an item.

    As it is: the windows that hold a name, the names kept; of an item without any such window, all of them. Re-parameterised: the
    wide windows that hold a slot but at least as many words, as templates. Items shorter than a window are one window.
    """
    if not len(tokens):
        return {}
    size = min(WIDE if renamed else WINDOW, len(tokens))
    keys = window_hashes(template(tokens, not renamed), size)
    wanted = (tokens & 3) != WORD if renamed else (tokens & 3) == NAME
    count = lambda x: np.convolve(x, np.ones(size, int))[size - 1 : len(tokens)]
    held = count(wanted) > 0
    if renamed:
        held &= 2 * count(wanted) <= size
    elif not held.any():
        held = np.full(len(keys), True)
    return {int(i): int(keys[i]) for i in np.flatnonzero(held)}


def _extended(own: np.ndarray, doc: np.ndarray, k: int, d: int, step: int) -> Iterator[int]:
    """Positions of the item that go on to agree from (k, d) in one direction, over single words changed, left out or added."""
    n, m = len(own), len(doc)
    inside = lambda i, j: 0 <= i < n and 0 <= j < m
    while True:
        if inside(k, d) and own[k] == doc[d]:
            yield k
            k, d = k + step, d + step
            continue
        for a, b in ((1, 1), (1, 0), (0, 1), (2, 2)):
            i, j = k + a * step, d + b * step
            if inside(i, j) and own[i] == doc[j] and inside(i + step, j + step) and own[i + step] == doc[j + step]:
                if a:
                    yield k
                k, d = i, j
                break
        else:
            return


def passages(own: np.ndarray, doc: np.ndarray, places: list[int]) -> list[list[tuple[int, int]]]:
    """Chains of template windows that item and document share, (item position, document position), around the places."""
    long = min(SEED, len(own))
    at: dict = {}
    for k, h in enumerate(compared(own, long).tolist()):
        at.setdefault(h, []).append(k)
    reach = len(own) * 2 + DOC_GAP
    spans: list = []
    for p in sorted(places):
        a, b = max(0, p - reach), min(len(doc), p + reach)
        if spans and a <= spans[-1][1]:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    open_: list = []  # [last item position, last document position, pairs]
    done: list = []
    for a, b in spans:
        hashes = compared(doc[a:b], long)
        for d in np.flatnonzero(np.isin(hashes, np.fromiter(at, np.int64, len(at)))).tolist():
            ks, d = at[int(hashes[d])], d + a
            still = []
            for x in open_:
                (still if d - x[1] <= DOC_GAP else done).append(x)
            open_ = still
            for k in ks:
                # a window goes on with the chain that it fits best; of equal fits, with the one whose last slots agree
                best = None
                for x in open_:
                    step_i, step_d = k - x[0], d - x[1]
                    if 0 < step_i <= ITEM_GAP and 0 < step_d:
                        cost = (abs(step_i - step_d) + (step_i != step_d), -int(own[x[0]] == doc[x[1]]))
                        if best is None or cost < best[0]:
                            best = (cost, x)
                if best is None:
                    open_.append([k, d, [(k, d)]])
                else:
                    x = best[1]
                    x[0], x[1] = k, d
                    x[2].append((k, d))
    return [x[2] for x in done + open_]


def covered(own: np.ndarray, doc: np.ndarray, pairs: list[tuple[int, int]], renamed: bool) -> frozenset:
    """Positions of the item that a passage covers if its slots agree, else none.

    As it is: at least half of the names and half of all slots within the passage hold the item's own values. Re-parameterised:
    more than half hold other values, and every name of the item stands for one name of the document and the other way round
    (numbers are the same by chance too often to tell).
    """
    long = min(SEED, len(own))
    slot = (own & 3) != WORD
    out: set = set()
    aligned: dict = {}
    last = None
    for k, d in pairs:
        if last is not None and k - last <= SEED + 4:  # a few words changed in between
            out.update(range(last, k))
        out.update(range(k, k + long))
        aligned.update((k + j, d + j) for j in range(long))
        last = k
    same = own if not renamed else template(own)
    other = doc if not renamed else template(doc)
    first, end = pairs[0], pairs[-1]
    out.update(_extended(same, other, first[0] - 1, first[1] - 1, -1))
    out.update(_extended(same, other, end[0] + long, end[1] + long, 1))
    inside = [k for k in range(min(out), max(out) + 1) if slot[k]]
    if not renamed:
        equal = lambda ks: 2 * sum(k in out and (k not in aligned or own[k] == doc[aligned[k]]) for k in ks) >= len(ks)
        names = [k for k in inside if own[k] & 3 == NAME]
        return frozenset(out) if equal(names) and equal(inside) else frozenset()
    pairs_ = {(int(own[k]), int(doc[aligned[k]])) for k in inside if k in aligned and own[k] & 3 == NAME}
    changed = sum(own[k] != doc[aligned[k]] for k in inside if k in aligned)
    if 2 * changed <= len(inside) or len({a for a, _ in pairs_}) != len(pairs_) or len({b for _, b in pairs_}) != len(pairs_):
        return frozenset()
    return frozenset(out)


def share_held(own: np.ndarray, sizes: np.ndarray, doc: np.ndarray, places: list[int], renamed: bool) -> float:
    """Share of the item's characters that its two best passages in the document cover. The best pair is exact."""
    found = {c for p in passages(own, doc, places) if (c := covered(own, doc, p, renamed))}
    total = int(sizes.sum()) or 1
    each = sorted(((int(sizes[list(c)].sum()), c) for c in found), key=lambda x: -x[0])
    best = each[0][0] if each else 0
    for n, (alone, c) in enumerate(each):
        if 2 * alone <= best or best == total:
            break  # even without overlap no pair from here on is better
        for more, o in each[n + 1 :]:
            if alone + more <= best:
                break
            best = max(best, alone + int(sizes[list(o - c)].sum()))
    return best / total


def common_words(items: DataFrame) -> frozenset:
    """Words that too many distinct item texts hold to be names. At most the words of an item / NAME_SHARE of them can be."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(w,) for t in pdf.text for w in {" ", *words(t)}], columns=["w"])

    texts = items.select("text").where(F.length("text") > 0).distinct()
    counts = cut(texts.mapInPandas(run, "w string").groupBy("w").agg(F.count("*").alias("n")))
    n = counts.where("w = ' '").agg(F.max("n")).head()[0] or 0
    return frozenset(r["w"] for r in counts.where((F.col("n") > max(NAME_TEXTS, NAME_SHARE * n)) & (F.col("w") != " ")).toLocalIterator())


def _item_rows(common, renamed: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        typed = Typed(common.value)
        for pdf in batches:
            out = []
            for i, t in zip(pdf.item_id, pdf.text):
                tokens = typed(t)
                keys = item_keys(tokens, renamed)
                out.append((i, tokens.tolist(), [len(w) for w in words(t)], [[p, k] for p, k in keys.items()], min(WIDE if renamed else WINDOW, len(tokens))))
            yield pd.DataFrame(out, columns=["item_id", "own", "sizes", "keys", "size"])

    return run


def _document_rows(common, filter_, sizes: list[int], renamed: bool):
    def hits(held: list) -> list:
        """Documents of a stretch that hold a key: their windows are hashed side by side, and those across two documents left out."""
        ends = np.cumsum([len(t) for _, t in held])
        tokens = np.array([x for _, t in held for x in t], np.int64)
        wanted = None if filter_ is None else filter_.value
        values, found = template(tokens, not renamed), []
        for size in sizes:
            h = window_hashes(values, size)
            if not len(h):
                continue
            at = np.arange(len(h))
            if wanted is not None:
                near = np.searchsorted(wanted, h)
                near[near == len(wanted)] = 0
                at = np.flatnonzero(wanted[near] == h)
            doc = np.searchsorted(ends, at, side="right")
            inside = at + size <= ends[doc]
            found.append((doc[inside], at[inside], h[at[inside]]))
        out = []
        for d in np.unique(np.concatenate([x[0] for x in found])).tolist() if found else ():
            begin = int(ends[d]) - len(held[d][1])
            mine = [(x[1][x[0] == d] - begin, x[2][x[0] == d]) for x in found]
            out.append((held[d][0], held[d][1], np.concatenate([m[1] for m in mine]).tolist(), np.concatenate([m[0] for m in mine]).tolist()))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        typed = Typed(common.value)
        for pdf in batches:
            out, held, n = [], [], 0
            for doc, text in zip(pdf.doc_id, pdf.text):
                held.append((doc, typed.list(text)))
                n += len(held[-1][1])
                if n > TOGETHER:
                    out += hits(held)
                    held, n = [], 0
            out += hits(held)
            yield pd.DataFrame(out, columns=["doc_id", "doc", "keys", "places"])

    return run


def _compare(renamed: bool, least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, doc, asked in zip(pdf.doc_id, pdf.doc, pdf.asked):
                doc = np.asarray(doc, np.int64)
                for x in asked:
                    own, sizes = np.asarray(x["own"], np.int64), np.asarray(x["sizes"], np.int64)
                    got = share_held(own, sizes, doc, list(x["places"]), renamed)
                    if got >= least:
                        out.append((doc_id, x["item_id"], round(got, 4)))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "share"])

    return run


def leaks(documents: DataFrame, items: DataFrame, share: float = SHARE, renamed: bool = False) -> DataFrame:
    """(doc_id, item_id, share): documents that hold at least this share of an item as one or two passages.

    renamed: documents that hold it with other numbers and names instead, each replaced throughout; at least WIDE words (or the
    whole item) of it must stand in one piece. NULL and empty texts of either side hold nothing. Items with fewer words than a
    window are found where they stand whole. An item without any name is found by its windows without one; of one with names, a
    part is found only if a window with a name stands in it. Repeated documents or items give repeated ids once. No items or no
    documents: no rows.
    """
    spark = documents.sparkSession
    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") > 0))
    asked = items.select("item_id", "text").where(F.length("text") > 0).distinct()
    common = spark.sparkContext.broadcast(common_words(asked))
    rows = cut(asked.mapInPandas(_item_rows(common, renamed), "item_id bigint, own array<bigint>, sizes array<int>, keys array<array<bigint>>, size int"))
    index = rows.select("item_id", F.explode("keys").alias("k")).select("item_id", F.col("k")[1].alias("key"))
    index = index.distinct()
    sizes = sorted(r["size"] for r in rows.select("size").where("size > 0").distinct().collect())  # at most one for each size of a window
    distinct = index.select("key").distinct()
    filter_ = None
    if distinct.limit(MAX_KEYS + 1).count() <= MAX_KEYS:
        filter_ = spark.sparkContext.broadcast(np.sort(distinct.toPandas()["key"].to_numpy(np.int64)))
        if not len(filter_.value):
            return spark.createDataFrame([], "doc_id bigint, item_id bigint, share double")
    hits = cut(texts.mapInPandas(_document_rows(common, filter_, sizes, renamed), "doc_id bigint, doc array<bigint>, keys array<bigint>, places array<int>"))
    at = hits.select("doc_id", F.explode(F.arrays_zip("keys", "places")).alias("x")).select("doc_id", F.col("x.keys").alias("key"), F.col("x.places").alias("place"))
    joined = at.join(index, "key").groupBy("doc_id", "item_id").agg(F.sort_array(F.collect_set("place")).alias("places"))
    with_item = joined.join(rows.select("item_id", "own", "sizes"), "item_id")
    by_doc = with_item.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "own", "sizes", "places")).alias("asked"))
    found = hits.select("doc_id", "doc").join(by_doc, "doc_id").mapInPandas(_compare(renamed, share), "doc_id bigint, item_id bigint, share double")
    return found.groupBy("doc_id", "item_id").agg(F.max("share").alias("share"))
