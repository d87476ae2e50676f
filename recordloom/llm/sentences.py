"""Sentence boundaries across languages and scripts.

The boundary rules are compiled into a finite transducer. Its input symbols are the marks of a text that can matter (end marks,
quotes, brackets, blank lines, list lines, spaces between Thai words), each classified by its neighbourhood alone: the word
before it (abbreviation, initial, ordinal, number) and what comes after. Its states say what is open: which kind of quote, a
bracket, a list or heading line. A stretch of symbols is a function from states to states; functions are composed by a
block-wise parallel prefix scan, so no symbol waits for the whole text before it. Texts longer than a chunk are cut into chunks
that run as separate rows: each gives its function and, for every state it could start in, its boundaries; the functions are
composed for each document and the boundaries that fit the state reached are kept. What a symbol needs to know from further away
(whether a quote closes before the next blank line, which numbers the list lines since the last one had) is gathered for each
chunk first and composed from right to left and from left to right in the same way.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.session import cut

#: Characters of a chunk, and of the neighbourhood that chunks share on each side.
CHUNK, CONTEXT = 65_536, 1_024
#: Documents that may come more than once and still be told apart by a broadcast of their ids (8 MB).
REPEATED = 1_000_000
#: Symbols handled by one prefix scan, and symbols of one of its blocks.
SCAN, BLOCK = 100_000, 64

# Abbreviations that never end a sentence, lower case, without their last period.
NEVER = frozenset(
    "dr mr mrs ms mx prof prov rev hon gen col lt sgt capt st mt messrs fig figs tab tabs sec secs sect eq eqs ref refs no nos nr vol vols ch chap ed eds pp p pg vs cf viz incl excl approx resp e.g i.e eg ie al. "
    "abb kap vgl bzw ca mio mrd z d.h z.b s h u.a.m str hr hrn fr frl dipl geb evtl ggf sog inkl zzgl mind max min bspw "
    "mme mlle mm env ex art chap éd av apr n sr sra srta dra d núm num pág págs aprox ej ud uds vid "
    "рис табл см ср проф акад млрд млн тыс т ч е им гр г-н г-жа ул д-р руб стр гл "
    "أ د م ص ج डॉ प्रो श्री पं कु सं".split()
)
# Abbreviations that end a sentence if a new one visibly begins.
MAYBE = frozenset("etc al inc ltd corp co llc plc bros jr sr. p.m a.m pm am pts hrs ph.d b.sc m.sc u.s u.k usw u.a a u. u.ä uvm dgl o.ä и.о г гг д п др в вв н.э км мин сек с ff etc. et.al est dept univ dist jan feb mar aug sept sep oct nov dec mon tue wed thu fri sat sun".split())
# Words before which, in front of a capital, a number of one or two digits with a period is an ordinal.
ORDINAL = frozenset("der die das den dem des am im zum zur vom beim bis seit ab ein eine einen einem einer jede jeder jedes dieser diese dieses ihre seine unsere und oder".split())

_MARKS, _CLOSERS = ".!?。！？।॥…؟．｡", "”»」』›’)）]】\"“"
_OPENERS = "“«„「『‹‚(（[【¿¡\"‘"
_PLAIN = r"'\n.…!?؟！？。．｡।॥«「『‹“„‚”»」』›\"(（\[【)）\]】"
# Every mark that can matter; a period right before a digit, a small letter or a mark in a word never does.
_EVENT = re.compile(rf"[{_PLAIN}](?:(?<!\.)|(?![\d,;:/@_a-zß-öø-ÿа-я]))")
_EVENT_THAI = re.compile(rf"[{_PLAIN} ](?:(?<![. ])|(?<=\.)(?![\d,;:/@_a-zß-öø-ÿа-я])|(?<=[ก-๎] )(?=[ก-๎A-Z ]))")
_THAI = re.compile(r"[ก-๎] ")
_SPACE, _RUN = re.compile(r"\s*"), re.compile(r"[.!?؟！？…。．｡।॥]*")
_CLASS = dict.fromkeys("!?؟！？", "bang") | dict.fromkeys("。．｡", "full") | dict.fromkeys("।॥", "danda") | dict.fromkeys("«「『‹", "open") | dict.fromkeys("„‚", "gopen") | dict.fromkeys("”»」』›'", "close") | dict.fromkeys("(（[【", "po") | dict.fromkeys(")）]】", "pc") | {"“": "amb", '"': "asc", "\n": "nl", ".": "dot", "…": "ell", " ": "thai"}
_NEXT = re.compile(r"\s*(\S?)")
_TAIL = re.compile(r"[^\s()\[\]“”«»„\"「」,;:!?/。！？；，、：（）]+$")
_MARKER = re.compile(r"[ \t]*(?:[-*•‣▪◦·–][ \t]+|#{1,6}[ \t]+|(\d{1,3})[.)][ \t]+|\(\d{1,3}\)[ \t]+|[a-z]\)[ \t]+)")
# A name in small letters that begins a sentence shows by the verb after it.
_LOWER_START = re.compile(r"[a-z][\w.-]*\s+(?:is|was|has)\s+(?:an?|the)\s")
_BLANK_BEFORE = re.compile(r"\n[^\S\n]*\n\s*$")
_GLUED = re.compile(r"(?<=[a-zß-öø-ÿа-яё\d%)\]»”])\.(?=[A-ZÀ-ÖØ-ÞА-ЯЁ])")
_LATIN_RUN = re.compile(r"[A-Z][\w'’-]*\s+[a-zA-Z]")

# Symbols: 0 nothing, 1 end, 2 blank line, 3 list line, 4-7 open/German open at start or mid, 8-10 close (plain, ends, ends if opened
# mid), 11-16 “ (start, mid) x (plain, ends, mid), 17-22 the same for ", 23-24 bracket opens at start or mid, 25-27 bracket closes
# (plain, ends, ends if opened at start), 28 new text, 29 an apostrophe that can close a German quote.
N_SYMBOLS, END, PARA, LIST, OPEN, GOPEN, CLOSE, AMB, ASC, PO, PC, NEW, APOS = 30, 1, 2, 3, 4, 6, 8, 11, 17, 23, 25, 28, 29
# States: quote (0 none, 1 opened at the start of a sentence, 2 mid, 3-4 the same for the German form) + 5 * bracket (0 none, 1 opened
# at the start of a sentence, 2 mid) + 15 * list line.
N_STATES = 30


def _compile() -> tuple[np.ndarray, np.ndarray]:
    to, out = np.zeros((N_SYMBOLS, N_STATES), np.uint8), np.zeros((N_SYMBOLS, N_STATES), bool)
    for state in range(N_STATES):
        q, p, line = state % 5, state // 5 % 3, state // 15

        def set_(symbol: int, q2: int = q, p2: int = p, line2: int = line, boundary: bool = False, state: int = state) -> None:
            to[symbol, state], out[symbol, state] = q2 + 5 * p2 + 15 * line2, boundary

        free = p == 0 and line == 0
        set_(0)
        set_(END, boundary=q == 0 and free)
        set_(PARA, 0, 0, 0, True)
        set_(LIST, 0, 0, 1, True)
        set_(NEW, 0, 0, 0, False)
        for mid in (0, 1):
            set_(OPEN + mid, q or 1 + mid)
            set_(GOPEN + mid, q or 3 + mid)
            for ctx in (0, 1, 2):
                closes = free and (ctx == 1 or (ctx == 2 and q in (2, 4)))
                set_(AMB + 3 * mid + ctx, 0 if q > 2 else q or 1 + mid, boundary=q > 2 and closes)
                set_(ASC + 3 * mid + ctx, 0 if q else 1 + mid, boundary=q > 0 and closes)
                set_(CLOSE + ctx, 0, boundary=closes)
        set_(APOS, 0 if q > 2 else q)
        set_(PO, p2=p or 1)
        set_(PO + 1, p2=p or 2)
        set_(PC, p2=0)
        set_(PC + 1, p2=0, boundary=q == 0 and line == 0)
        set_(PC + 2, p2=0, boundary=q == 0 and line == 0 and p == 1)
    return to, out


TO, OUT = _compile()


def _kind(text: str, j: int) -> tuple[str, str, int]:
    """Kind of the next visible character from j on, the character, and where it stands."""
    m = _NEXT.match(text, j)
    c, at = m[1], m.start(1)
    if not c:
        return "", "", at
    if c.isalpha():
        return ("U" if c.isupper() or c.istitle() else "l" if c.islower() else "x"), c, at
    if c.isdigit():
        return "d", c, at
    if c in _OPENERS or c == "…":
        return "o", c, at
    return ("c" if c in _CLOSERS else "p"), c, at


def _after_bracket(text: str, at: int) -> bool:
    """Whether what an opener at this place leads in looks like the beginning of a sentence."""
    if text[at] in "(（[【":
        k = _kind(text, at + 1)[0]
        return k in ("U", "x", "o")
    return True


def _dot(text: str, i: int, j: int) -> bool:
    k, c, at = _kind(text, j)
    if k == "c":
        return False
    if at == j and k:  # nothing between the period and what follows
        before = text[i - 1] if i else ""
        if k == "x":
            return not before.isspace() and not before.isdigit()
        return k == "U" and (before.islower() or before.isdigit() or before in ")]”%»") and (text[j + 1 : j + 2].islower() or text[j + 1 : j + 2].isspace() or text[j + 1 : j + 2] in "'’")
    if k == "p":
        return c in "•-*"
    word, low = _word_before(text, i)
    if low in NEVER or (len(word) == 1 and word.isupper() and k != "o") or (len(word) == 3 and word[1] == "." and word[0].isupper() and word[2].isupper()):
        return False
    if low in MAYBE or (len(word) == 1 and word.islower()):
        if k == "U" and len(word) > 1 and word.isupper() and low != "etc" and text[at + 1 : at + 2].isupper():
            return False  # in capitals, a capital does not tell
        if k == "l":
            return len(word) > 1 and bool(_LOWER_START.match(text, at))
        return k in ("U", "x", "") or (k == "o" and _after_bracket(text, at)) or (k == "d" and low in ("etc", "usw"))
    if k in ("U", "l") and len(word) < 3 and word.isdigit() and _word_before(text, i - len(word) - 1, True)[1] in ORDINAL:
        return False
    return True


def _word_before(text: str, i: int, over_space: bool = False) -> tuple[str, str]:
    """The word right before i, as it stands and in lower case; a period glued to a capital does not belong to a word."""
    while over_space and i > 0 and text[i - 1].isspace():
        i -= 1
    m = _TAIL.search(text, max(0, i - 24), i)
    word = m[0].lstrip("'‘’-–—.…") if m else ""
    low = word.lower()
    if "." in word and low not in MAYBE and low not in NEVER:
        word = _GLUED.split(word)[-1]
        low = word.lower()
    return word, low


def _bang(text: str, j: int) -> bool:
    k, c, at = _kind(text, j)
    if k in ("c", "p"):
        return k == "p" and c in "•-*" and at > j
    if k == "l" and at == j:
        return False
    if k == "U" and at == j:
        return text[j + 1 : j + 2].islower() or (text[j + 1 : j + 2].isupper() and text[j - 2 : j - 1].isupper()) or text[j + 1 : j + 2].isspace() or text[j + 1 : j + 2] in "'’" or ord(text[j - 1]) > 0x2E80
    return True


def _visible_before(text: str, i: int) -> str:
    while i > 0:
        i -= 1
        if not text[i].isspace():
            return text[i]
    return ""


def _opened(text: str, i: int) -> int:
    """0 if an opening quote at i stands at the start of a sentence, else 1."""
    c = _visible_before(text, i)
    if c == "" or c in _MARKS or c in "”»」』)）•":
        return 0
    line = text.rfind("\n", 0, i) + 1
    m = _MARKER.match(text, line)
    return 0 if m and m.end() == i or _BLANK_BEFORE.search(text, max(0, i - 40), i) else 1


_PARTNERS = {"“": "”“", "«": "»", "「": "」", "『": "』", "‹": "›", "„": "“”'", "‚": "‘’'", "(": ")", "（": "）)", "[": "]", "【": "】"}


_CLOSING = sorted({x for p in _PARTNERS.values() for x in p})
_NUMBERED = re.compile(r"(?:^|(?<=\n))(\d{1,3}[.)]) ")


class Ahead:
    """Whether what opens closes again before the next blank line. Asked from left to right; every mark is looked for once."""

    def __init__(self, text: str, beyond: str = ""):
        self.text, self.beyond, self.at, self.stop = text, beyond, {}, -1

    def __call__(self, c: str, j: int) -> bool:
        if self.stop < j:
            self.stop = self.text.find("\n\n", j)
            self.stop = len(self.text) + 1 if self.stop < 0 else self.stop
        for x in _PARTNERS[c]:
            if self.at.get(x, -1) < j:
                at = self.text.find(x, j)
                self.at[x] = len(self.text) + 2 if at < 0 else at
            if self.at[x] < self.stop or (self.stop > len(self.text) and x in self.beyond):
                return True
        return False


class Numbered:
    """Which numbers the list lines since the last blank line had, from the start of a stretch on."""

    def __init__(self, text: str, first: int = 0, before: frozenset = frozenset()):
        self.text, self.first, self.before = text, first, before
        self.lines: dict = {}
        for m in _NUMBERED.finditer(text, first):
            self.lines.setdefault(m[1], []).append(m.start())

    def __call__(self, number: str, i: int) -> bool:
        """Whether a line with this number begins between the last blank line before i and i."""
        blank = self.text.rfind("\n\n", max(self.first - 1, 0), i)
        if blank < 0 and number in self.before:
            return True
        at = self.lines.get(number, ())
        k = bisect_left(at, i) - 1
        return k >= 0 and at[k] >= blank


def _closed(text: str, i: int, j: int) -> int:
    """0 if a closing quote ends nothing, 1 if it ends a sentence, 2 if it does where the quote was opened in mid sentence."""
    mark = _visible_before(text, i)
    if mark not in _MARKS or not mark:
        return 0
    k, c, at = _kind(text, j)
    if k in ("", "o", "U", "d"):
        if k == "o" and mark not in ".。" and not _after_bracket(text, at):
            return 0
        if k == "U" and mark in "?!" and text[at + 1 : at + 2].isupper() and text[max(0, i - 2) : i - 1].isupper():
            return 0  # in capitals: an attribution more likely than a new sentence
        return 2 if mark in "。！？．｡" and k in ("U", "d") else 1
    if k == "x":
        return 0 if "぀" <= c <= "ゟ" else 2
    if k == "l":
        return int(mark == "." and bool(_LOWER_START.match(text, at)))
    return 1 if k == "p" and c in "•-*" and at > j else 0


def symbols(text: str, first: int = 0, last: int | None = None, beyond: str = "", before: frozenset = frozenset()) -> tuple[list[int], list[int]]:
    """Symbols and cut offsets of the marks that begin in [first, last); text outside is only looked at as neighbourhood.

    beyond: closing marks that stand after the text and before the next blank line; before: numbers of the list lines between the
    last blank line and first.
    """
    last = len(text) if last is None else last
    partner, numbered = Ahead(text, beyond), None
    syms: list[int] = []
    cuts: list[int] = []
    if first == 0 and (m := _MARKER.match(text, len(text) - len(text.lstrip()))) and m.end() < len(text):
        syms.append(LIST)
        cuts.append(0)
    skip = first
    if first and text[first - 1] in _MARKS:  # runs that began before this stretch belong to the stretch before
        skip = _RUN.match(text, first).end()
    elif first and text[first - 1].isspace() and "\n" in text[len(text[:first].rstrip()) : first]:
        skip = _SPACE.match(text, first).end()
    for m in (_EVENT_THAI if _THAI.search(text) else _EVENT).finditer(text, first):
        i = m.start()
        if i < skip:
            continue
        if i >= last:
            break
        c0 = text[i]
        g, j = _CLASS[c0], i + 1
        if g == "nl":
            j = _SPACE.match(text, i).end()
            skip = j
            if text.find("\n", i + 1, j) >= 0:
                g = "para"
        elif g in ("dot", "ell", "bang", "full", "danda"):
            if text[j : j + 1] in _MARKS and j < len(text):
                j = _RUN.match(text, j).end()
                skip = j
                if g == "dot":
                    g = "ell"
        if g == "dot":
            if not _dot(text, i, j):
                continue
            s, at = END, j
        elif g == "nl":
            mark = _MARKER.match(text, text.rfind("\n", i, j) + 1)
            if not mark:
                if "ก" <= text[i - 1 : i] <= "๎" and "ก" <= text[j : j + 1] <= "๎":
                    s, at = END, i
                else:
                    continue
            elif mark[1]:  # a number begins a list line after a list line with the number before only
                numbered = numbered or Numbered(text, first, before)
                if not numbered(f"{int(mark[1]) - 1}{mark[0].strip()[-1]}", i):
                    continue
                s, at = LIST, i
            else:
                s, at = LIST, i
        elif g == "para":
            s, at = (LIST if j < len(text) and _MARKER.match(text, j) else PARA), i
        elif g == "ell":
            k, c, a = _kind(text, j)
            if i == 0 or text[i - 1].isspace():
                continue  # what was left out stands at the start of a sentence
            if (k == "l" and not _LOWER_START.match(text, a)) or k == "c" or (k == "d" and not text[i - 1 : i].isalpha()) or (k == "p" and c not in "•-*") or (a == j and k and not (k == "U" and text[i - 1 : i].islower())):
                continue
            s, at = END, j
        elif g == "bang":
            if not _bang(text, j):
                continue
            s, at = END, j
        elif g in ("full", "danda"):
            if _kind(text, j)[0] == "c":
                continue
            s, at = END, j
        elif g == "thai":
            j = _SPACE.match(text, i).end()
            if j >= len(text) or not ("ก" <= text[j] <= "๎" or _LATIN_RUN.match(text, j)):
                continue
            s, at = END, i
        elif g in ("open", "gopen"):
            if not partner(c0, j):
                continue
            s, at = (OPEN if g == "open" else GOPEN) + _opened(text, i), j
        elif g == "close":
            if c0 == "'" and (i == 0 or text[i - 1] not in ".!?"):
                if i == 0 or not text[i - 1].isalnum() or text[j : j + 1].isalnum():
                    continue
                s, at = APOS, j
            else:
                s, at = CLOSE + _closed(text, i, j), j
        elif g in ("amb", "asc"):
            shut = i > 0 and not text[i - 1].isspace() and not text[j : j + 1].isalnum() and text[j : j + 1] not in "¿¡"
            if shut and g == "amb":
                s, at = CLOSE + _closed(text, i, j), j
            elif g == "amb" and not partner(c0, j) and i and text[i - 1].isspace():
                continue
            else:
                s, at = (AMB if g == "amb" else ASC) + 3 * _opened(text, i) + _closed(text, i, j), j
        elif g == "po":
            if not partner(c0, j):
                continue
            s, at = PO + _opened(text, i), j
        else:
            mark = _visible_before(text, i)
            k, c, a = _kind(text, j)
            if not mark or mark not in _MARKS:
                ends = 0
            elif k in ("U", "d", "", "o") or (k == "x" and ord(text[i]) < 0x2E80) or (k == "p" and c in "•-*" and a > j):
                ends = 1
            else:
                ends = 2 if k in ("l", "x") else 0
            s, at = PC + ends, j
        syms.append(s)
        cuts.append(at)
    return syms, cuts


def scan(sym: np.ndarray, start: np.ndarray) -> np.ndarray:
    """State before each symbol, for each of the start states: shape (len(sym), len(start)).

    Blocks of symbols are composed to functions side by side, the functions of the blocks by a prefix scan of doubling steps, and
    then the blocks run side by side again, each from the state that it starts in.
    """
    n = len(sym)
    if n == 0:
        return np.zeros((0, len(start)), np.uint8)
    rows = -(-n // BLOCK)
    padded = np.zeros(rows * BLOCK, np.intp)
    padded[:n] = sym
    by_block = padded.reshape(rows, BLOCK)
    f = np.tile(np.arange(N_STATES, dtype=np.uint8), (rows, 1))
    for t in range(BLOCK):
        f = TO[by_block[:, t][:, None], f]
    step = 1
    while step < rows:  # f[i] becomes the composition of all blocks up to i
        f[step:] = np.take_along_axis(f[step:], f[:-step].astype(np.intp), axis=1)
        step *= 2
    state = np.empty((rows, len(start)), np.uint8)
    state[0], state[1:] = start, f[:-1][:, start]
    before = np.empty((rows, BLOCK, len(start)), np.uint8)
    for t in range(BLOCK):
        before[:, t] = state
        state = TO[by_block[:, t][:, None], state]
    return before.reshape(rows * BLOCK, len(start))[:n]


def spans(text: str, cuts: list[int]) -> Iterator[tuple[int, int]]:
    """First and last positions, from 1, of the visible stretches between cuts."""
    at = 0
    for c in [*cuts, len(text)]:
        if c > at:
            piece = text[at:c]
            left = len(piece) - len(piece.lstrip())
            right = len(piece.rstrip())
            if right > left:
                yield at + left + 1, at + right
            at = c


def split(text: str) -> list[tuple[int, int]]:
    """Sentence positions of one text: the plain sequential run of the transducer."""
    state, found = 0, []
    for s, c in zip(*symbols(text)):
        if OUT[s, state]:
            found.append(c)
        state = TO[s, state]
    return list(spans(text, found))


_SPANS = "doc_id bigint, start_pos bigint, end_pos bigint"


def _whole_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    zero = np.zeros(1, np.intp)

    def run(held: list, sym: list) -> pd.DataFrame:
        arr = np.array(sym, np.intp)
        fires = OUT[arr, scan(arr, zero)[:, 0]] if len(arr) else np.zeros(0, bool)
        ids, starts, ends, at = [], [], [], 0
        for doc, text, cuts in held:
            k = len(cuts)
            mine = [c for c, hit in zip(cuts, fires[at + 1 : at + 1 + k].tolist()) if hit]
            at += k + 1
            for a, b in spans(text, mine):
                ids.append(doc)
                starts.append(a)
                ends.append(b)
        return pd.DataFrame({"doc_id": ids, "start_pos": starts, "end_pos": ends}, dtype="int64")

    for pdf in batches:
        held, sym = [], []
        for doc, text in zip(pdf.doc_id, pdf.text):
            s, c = symbols(text)
            sym.append(NEW)
            sym += s
            held.append((doc, text, c))
            if len(sym) > SCAN:
                yield run(held, sym)
                held, sym = [], []
        yield run(held, sym)


_PIECES = "doc_id bigint, chunk int, base bigint, first int, last int, n bigint, text string, closing string, numbers array<string>, blank boolean"


def _pieces(chunk: int, context: int):
    """Chunks with a neighbourhood that is wide enough for what is looked at: white space and runs of marks are never cut off."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for doc, text in zip(pdf.doc_id, pdf.text):
                n = len(text)
                for k in range(-(-n // chunk)):
                    a, b = k * chunk, min(n, (k + 1) * chunk)
                    base, stop = max(0, a - context), min(n, b + context)
                    while base and (text[base].isspace() or text[base] in _MARKS):
                        base = max(0, base - context)
                    while stop < n and (text[stop - 1].isspace() or text[stop - 1] in _MARKS):
                        stop = min(n, stop + context)
                    own = text[a : min(n, b + 1)]  # a blank line may begin with the last character
                    blank = own.find("\n\n")
                    closing = "".join(x for x in _CLOSING if own.find(x, 0, b - a if blank < 0 else blank) >= 0)
                    last_blank = own.rfind("\n\n")
                    numbers = sorted({m[1] for m in _NUMBERED.finditer(text[: b + 8], max(a, a + last_blank)) if m.start() < b})
                    yield pd.DataFrame([(doc, k, base, a - base, b - base, n, text[base:stop], closing, numbers, blank >= 0)], columns=["doc_id", "chunk", "base", "first", "last", "n", "text", "closing", "numbers", "blank"])

    return run


_PARTS = "doc_id bigint, chunk int, cut bigint, end_pos bigint, next_pos bigint, fires int, f array<int>"


def _chunk_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    every = np.arange(N_STATES)
    for pdf in batches:
        out = []
        for doc, k, base, first, last, n, text, beyond, before in zip(pdf.doc_id, pdf.chunk, pdf.base, pdf["first"], pdf["last"], pdf.n, pdf.text, pdf.beyond, pdf.before):
            s, c = symbols(text, first, last, beyond if base + len(text) < n else "", frozenset(before))
            arr = np.array(s, np.intp)
            before_ = scan(arr, every)
            f = TO[arr[-1], before_[-1]] if len(arr) else every
            out.append((doc, k, None, None, None, 0, [int(x) for x in f]))
            fires = OUT[arr[:, None], before_] if len(arr) else np.zeros((0, N_STATES), bool)
            masks = (fires * (1 << every)).sum(axis=1)
            for at, mask in zip(c, masks.tolist()):
                if mask:
                    left = at
                    while left and text[left - 1].isspace():
                        left -= 1
                    out.append((doc, k, base + at, base + left, base + _SPACE.match(text, at).end() + 1, mask, None))
            if k == 0:
                out.append((doc, 0, 0, 0, len(text) - len(text.lstrip()) + 1, -1, None))
            if base + last >= n:
                out.append((doc, k, n, base + len(text.rstrip()), n + 1, -1, None))
        yield pd.DataFrame(out, columns=["doc_id", "chunk", "cut", "end_pos", "next_pos", "fires", "f"]).astype({"cut": "Int64", "end_pos": "Int64", "next_pos": "Int64"})


def _once(texts: DataFrame) -> DataFrame:
    """One row for each doc_id: rows delivered twice are told by their ids alone, so that no text is moved but theirs."""
    repeated = cut(texts.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    n = repeated.count()
    if n == 0:
        return texts
    ids = F.broadcast(repeated) if n <= REPEATED else repeated
    return texts.join(ids, "doc_id", "left_anti").unionByName(texts.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")))


def sentences(documents: DataFrame, chunk: int = CHUNK, context: int = CONTEXT) -> DataFrame:
    """(doc_id, start_pos, end_pos): the sentences of every document, positions in characters from 1, both inclusive.

    NULL, empty and blank texts have no sentence, nor have rows without doc_id. Repeated documents count once (of different texts under one doc_id the smallest).
    A text that has no boundary is one sentence. Quotes and brackets that do not close before the next blank line open nothing.
    Texts longer than a chunk give the same sentences as in one piece.
    """
    texts = _once(documents.select("doc_id", "text").where("doc_id is not null and text is not null"))
    n = F.length("text")
    short = texts.where(n <= chunk).mapInPandas(_whole_texts, _SPANS)
    parts_ = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = cut(texts.where(n > chunk).mapInPandas(_pieces(chunk, context), _PIECES).repartition(parts_))
    # what lies ahead of and behind each chunk up to a blank line: the same composition, a few marks and numbers a chunk
    known = pieces.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "closing", "numbers", "blank"))).alias("all"))
    ahead = F.aggregate(F.reverse("all"), F.array(F.lit("")), lambda acc, x: F.concat(acc, F.array(F.when(x["blank"], x["closing"]).otherwise(F.concat(x["closing"], F.element_at(acc, -1))))))
    behind = F.aggregate("all", F.array(F.array().cast("array<string>")), lambda acc, x: F.concat(acc, F.array(F.when(x["blank"], x["numbers"]).otherwise(F.array_union(F.element_at(acc, -1), x["numbers"])))))
    around = known.select("doc_id", F.size("all").alias("k"), ahead.alias("ahead"), behind.alias("behind"))
    around = around.select("doc_id", F.posexplode(F.arrays_zip(F.reverse(F.slice("ahead", F.lit(1), F.col("k"))).alias("beyond"), F.slice("behind", F.lit(1), F.col("k")).alias("before"))).alias("chunk", "x")).select("doc_id", "chunk", "x.beyond", "x.before")
    parts = cut(pieces.join(around, ["doc_id", "chunk"]).mapInPandas(_chunk_parts, _PARTS))
    functions = parts.where(F.col("f").isNotNull()).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "f"))).alias("fs"))
    # states in which the chunks start: a running composition over the functions of one document, twenty numbers a chunk
    zero = F.array(F.lit(0))
    running = F.aggregate("fs", zero, lambda acc, x: F.concat(acc, F.array(F.element_at(x["f"], F.element_at(acc, -1) + 1))))
    starts = functions.select("doc_id", F.posexplode(running).alias("chunk", "state"))
    kept = parts.where(F.col("f").isNull()).join(starts, ["doc_id", "chunk"]).where((F.col("fires") == -1) | (F.expr("shiftright(fires, state)").bitwiseAND(1) == 1))
    w = Window.partitionBy("doc_id").orderBy("cut", "next_pos")
    long = kept.withColumn("start_pos", F.lag("next_pos").over(w)).where("start_pos <= end_pos").select("doc_id", "start_pos", "end_pos")
    return short.unionByName(long)
