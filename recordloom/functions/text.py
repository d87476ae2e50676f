"""Column functions on document text: cleaning, sections, chunks, slugs, prompts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.missing import trim_all

# Patterns of what cleaning removes, in order, and of the headings that open a section.
URL = r"https?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
MAIL = r"(?U)\S+@\S+"
SECTIONS = {"introduction": "introduction", "methods": "(?:methods?|methodology)", "results": "results?", "conclusion": "conclusions?"}
TABLES_START, TABLES_END = "\n\n[TABLES FROM DOCUMENT]\n\n", "\n\n[END TABLES]\n\n"
SNIPPET = 65_000
SHORT_SNIPPET = 8_000


def clean_text(c: Column) -> Column:
    """White space collapsed, then URLs and mail addresses taken out, then stripped; NULL gives an empty text."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " ")
    return trim_all(F.regexp_replace(F.regexp_replace(s, URL, ""), MAIL, ""))


def section(cleaned: Column, name: str, cap: int = 5_000) -> Column:
    """What follows a section's heading in cleaned text, stripped and capped; NULL if there is no such heading."""
    pattern = rf"(?is){SECTIONS[name]}(?U)\s*(.*)\z"
    found = F.substring(trim_all(F.regexp_extract(cleaned, pattern, 1)), 1, cap)
    return F.when(cleaned.rlike(rf"(?is){SECTIONS[name]}"), found)


def word_count(c: Column) -> Column:
    """Words between white space."""
    s = trim_all(c)
    return F.when(s == "", 0).otherwise(F.size(F.split(s, r"(?U)\s+")))


def chunk_spans(c: Column, size: int, overlap: int, look: int = 200) -> Column:
    """Array of (start, stop) offsets of overlapping chunks that end after a sentence where one ends in the last `look` characters.

    A text no longer than size is one chunk. The next chunk starts overlap characters before the end of the last one; the last
    chunk may lie within the one before. The earliest cut must leave a step forward: size - look + 1 > overlap.
    """
    if size - look + 1 <= overlap:
        raise ValueError("overlap too large: a chunk could start where the last one did")
    n = F.length(c)
    most = (n / F.lit(size - look + 1 - overlap)).cast("int") + 2

    def step(acc: Column, _: Column) -> Column:
        start = acc["start"]
        stop = start + size
        near = F.greatest(start, stop - look)
        tail = F.substring(c, near + 1, F.lit(look))
        # the last ". " of the tail, found from behind
        from_behind = F.instr(F.reverse(tail), " .")
        cut_at = F.when((stop < n) & (from_behind > 0), near + F.length(tail) - from_behind).otherwise(stop)
        span = F.struct(start.alias("start"), F.least(cut_at, n).alias("stop"))
        return F.when(start < n, F.struct((cut_at - overlap).alias("start"), F.concat(acc["out"], F.array(span)).alias("out"))).otherwise(acc)

    zero = F.struct(F.lit(0).alias("start"), F.array().cast("array<struct<start:int,stop:int>>").alias("out"))
    many = F.aggregate(F.sequence(F.lit(1), most), zero, step, lambda acc: acc["out"])
    return F.when(n <= size, F.array(F.struct(F.lit(0).alias("start"), n.alias("stop")))).otherwise(many)


def chunked(df: DataFrame, column: str, size: int, overlap: int, look: int = 200) -> DataFrame:
    """df without the column, once for each chunk of it, with chunk_no, start_pos and chunk: the pieces of chunk_spans.

    A text is cut in one pass where it lies; nothing but its pieces leaves the task, however many there are. NULL gives no row.
    """
    if size - look + 1 <= overlap:
        raise ValueError("overlap too large: a chunk could start where the last one did")
    kept = [c for c in df.columns if c != column]

    def cuts(text: str) -> Iterator[tuple[int, int]]:
        n, start = len(text), 0
        if n <= size:
            yield 0, n
            return
        while start < n:
            stop, near = start + size, start + size - look
            end = text.rfind(". ", near, near + look) + 1 if stop < n else 0
            stop = end or stop
            yield start, min(stop, n)
            start = stop - overlap

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [*kept, "chunk_no", "start_pos", "chunk"]
        for pdf in batches:
            rows, held = [], 0
            for text, *row in pdf[[column, *kept]].itertuples(index=False, name=None):
                if text is not None:
                    rows += [(*row, k, a, text[a:b]) for k, (a, b) in enumerate(cuts(text))]
                    held += len(text)
                    if held > 8_000_000:  # what goes out at once is bounded
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
            yield pd.DataFrame(rows, columns=names)

    types = dict(df.dtypes)
    return df.mapInPandas(run, ", ".join([*(f"`{c}` {types[c]}" for c in kept), "chunk_no int", "start_pos int", "chunk string"]))


def table_markdown(t: Column) -> Column:
    """Markdown of an array of rows: short rows padded, NULL cells empty, pipes escaped; a lone header has no separator line."""
    columns = F.array_max(F.transform(t, lambda r: F.size(r)))
    cell = lambda x: F.regexp_replace(F.replace(trim_all(F.coalesce(x, F.lit(""))), F.lit("|"), F.lit("\\|")), "\n", " ")
    padded = F.transform(t, lambda r: F.concat(F.transform(r, cell), F.array_repeat(F.lit(""), columns - F.size(r))))
    lines = F.transform(padded, lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |")))
    head, body = F.element_at(lines, 1), F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    full = F.concat(head, F.lit("\n|"), F.repeat(F.lit("---|"), columns), F.lit("\n"), F.array_join(body, "\n"))
    return F.when(F.coalesce(F.size(t), F.lit(0)) <= 0, "").when(columns <= 0, "").when(F.size(t) == 1, head).otherwise(full)


def slug_title(c: Column, most: int = 80) -> Column:
    """File-safe slug that keeps word characters and joins by underscores; "untitled" if nothing is left."""
    s = F.regexp_replace(F.lower(trim_all(c)), r"(?U)[^\w\s-]", "")
    s = F.regexp_replace(F.regexp_replace(s, r"(?U)[-\s]+", "_"), "^_+|_+$", "")
    return F.when(c.isNull() | (trim_all(c) == "") | (s == ""), "untitled").otherwise(F.substring(s, 1, most))


def slug(c: Column, most: int = 100) -> Column:
    """The other slug: only a-z and 0-9, everything else one underscore."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "_"), "^_+|_+$", ""), 1, most)


def iso_year(c: Column) -> Column:
    return F.substring(c, 1, 4).try_cast("int")


def iso_month(c: Column) -> Column:
    m = F.substring(c, 6, 2).try_cast("int")
    return F.when(m.between(1, 12), m)


def clean_url(c: Column) -> Column:
    """First line without control characters, cut before trailing command text; NULL if it is no http address."""
    s = trim_all(F.element_at(F.split(F.regexp_replace(trim_all(c), r"[\p{Cc}&&[^\n\r]]", ""), r"[\n\r]"), 1))
    s = trim_all(F.element_at(F.split(s, "sbatch|srun"), 1))
    return F.when(s.startswith("http://") | s.startswith("https://"), s)


def stop_repetition(c: Column) -> Column:
    """An answer that begins with one or two characters only is cut a thousand characters from its first brace on."""
    distinct = F.size(F.array_distinct(F.split(F.substring(c, 1, 100), "(?s)(?<=.)(?=.)")))
    at = F.instr(c, "{")
    return F.when((F.length(c) > 50) & (distinct < 3) & (at > 0), F.substring(c, F.lit(1), at + 999)).otherwise(c)


def squash(c: Column) -> Column:
    """Lower case with single spaces."""
    return F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))
