"""Pieces of SQL that the oracles share; each states one rule on its own, for DuckDB."""

from __future__ import annotations

WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
RECS = "recs AS (SELECT DISTINCT * EXCLUDE (ingested_at) FROM extracted)"
PROPS = "props AS (SELECT DISTINCT * EXCLUDE (ingested_at, performance_metrics) FROM llm_properties)"
PAPERS = "pap AS (SELECT DISTINCT * EXCLUDE (ingested_at) FROM papers)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def missing2(x: str) -> str:
    return f"({x} IS NULL OR {x} IN ('', 'null', 'None'))"


def missing3(x: str) -> str:
    return f"({x} IS NULL OR {strip(x)} IN ('', 'null', 'None'))"


def spaced(x: str) -> str:
    return strip(rf"regexp_replace({x}, '([A-Za-z])(\d)', '\1 \2', 'g')")


def version(x: str) -> str:
    one = rf"regexp_extract({x}, '(?:^|\s)([A-Za-z][\w-]*?)\s+([vV]?\d+(?:\.\d+)?)(?:\s|[-_]|$)', 2)"
    two = rf"regexp_extract({x}, '(?:^|\s)([A-Za-z][\w-]*?)[-_]([vV]?\d+(?:\.\d+)?)(?:\s|[-_]|$)', 2)"
    return f"regexp_replace(coalesce(nullif({one}, ''), nullif({two}, '')), '^[vV]', '')"


def stripped_name(x: str) -> str:
    steps = [
        r"\s*\((ablation|baseline|checkpoint|variant|experiment|configuration|config|finetuned|fine-tuned|quantized|distilled|pruned|instruct|chat)\)$",
        r"\s*\(\d+\.?\d*[MBT]\)$", r"\s*\(\d+[Kk](?:\s+context(?:\s+window)?)?\)$",
        r"[-_\s]+(wikibooks?|wikipedia|bookcorpus|books?corpus|openwebtext|commoncrawl|cc-?news|c4|pile|ptb|wt103|enwik8|text8)$",
        r"[-_\s]+(Base|Large|XL|XXL|Small|Medium|Tiny|Mini)$", None, r"[-_\s]+(Turbo|Pro|Ultra|Lite|Plus|Premium|Standard|Advanced|Basic)$",
        r"[-_\s]+\d+\.?\d*[MBT]$", r"[-_\s]+\d+[-_\s]?[Ll](?:ayer(?:s)?)?$", r"[-_\s]+\d+[Kk](?:[-_\s]?context(?:\s+window)?)?$", r"\s*\((?:pre|post)[-\s]?trained\)$", r"[-_\s]+$",
    ]
    for p in steps:
        x = rf"regexp_replace({x}, '(?i)([a-z0-9])(?:Base|Large|XL|XXL|Small|Medium|Tiny|Mini)$', '\1')" if p is None else f"regexp_replace({x}, '(?i){p}', '')"
    return x


def canonical_cte(source: str, name: str = "model_name") -> str:
    """CTEs canon0 and canon: the rows of source with the column canonical."""
    return f"""canon0 AS (SELECT *, {spaced(strip(name))} AS _sp FROM {source}),
canon1 AS (SELECT *, {version('_sp')} AS _v, {stripped_name('_sp')} AS _st FROM canon0),
canon AS (SELECT * EXCLUDE (_sp, _v, _st), _v AS version, CASE WHEN {name} IS NULL OR {name} = '' THEN '' WHEN _v IS NOT NULL AND NOT contains(lower(_st), lower(_v)) THEN {strip("_st || ' ' || _v")} ELSE {strip('_st')} END AS canonical FROM canon1)"""


def size_norm(x: str) -> str:
    u = f"upper({strip(x)})"
    return rf"""CASE WHEN {u} IS NULL OR {u} IN ('', 'NULL', 'NONE', 'N/A') THEN NULL WHEN regexp_matches({u}, '^\d+\.?\d*\s*[MBT]$') THEN regexp_replace({u}, '\s+', '', 'g')
      WHEN regexp_matches(replace({u}, '.', ''), '^\d+$') THEN {u} || 'M' ELSE {u} END"""


def size_key(x: str) -> str:
    n, u = (rf"regexp_extract(upper({x}), '^(\d+\.?\d*)\s*([MBT])', {i})" for i in (1, 2))
    return f"CASE WHEN {u} = '' THEN 0.0::DOUBLE ELSE try_cast({n} AS DOUBLE) * CASE {u} WHEN 'B' THEN 1000.0 WHEN 'T' THEN 1000000.0 ELSE 1.0 END END"


def soft(x: str) -> str:
    return rf"regexp_replace(lower({strip(x)}), '(?:-|{WS})+', ' ', 'g')"


def filled(cols: list[str]) -> str:
    return "(" + " + ".join(f"CAST(NOT {missing2(c)} AS INT)" for c in cols) + ")"
