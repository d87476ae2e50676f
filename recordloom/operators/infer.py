"""Extraction by a model behind a small interface, and the chain around it."""

from __future__ import annotations

import json
import random
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.names import derived_millions, normalize_organisation
from recordloom.functions.text import chunked, clean_text
from recordloom.operators import answers, records
from recordloom.session import cut

MENTION = r"([A-Z][a-z]{5,}-\d+(?:\.\d+)?B)"


def mentions(c: Column) -> Column:
    """Names with a size as they stand in text: what the deterministic extractor takes for models."""
    return F.regexp_extract_all(c, F.lit(MENTION), F.lit(1))


def stub_client(prompt: str) -> str:
    """A deterministic stand-in for a language model: the named models of a text as the JSON that a model would answer."""
    found = dict.fromkeys(re.findall(MENTION, prompt))
    models = [{"model_name": n, "model_family": n.split("-")[0], "parameters": n.split("-")[1], "organization": None, "license": "n/a"} for n in found]
    return "```json\n" + json.dumps({"models": models, "paper_describes_multiple_models": len(models) > 1}) + "\n```"


def with_retries(client: Callable[[str], str], attempts: int = 5, delay: float = 2.0, spacing: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], str | None]:
    """A client that waits between calls and tries again after failures, longer each time; None when all attempts failed."""
    last = [0.0]

    def call(prompt: str) -> str | None:
        for n in range(1, attempts + 1):
            if (wait := last[0] + spacing - time.monotonic()) > 0:
                sleep(wait)
            last[0] = time.monotonic()
            try:
                return client(prompt)
            except Exception as e:  # noqa: BLE001
                if n == attempts:
                    return None
                limited = "rate" in str(e).lower()
                sleep(max(delay * 2**n, 10) + random.uniform(0, 5) if limited else delay * 2 ** (n - 1) + random.uniform(0, 2))
        return None

    return call


#: Characters of a prompt that a local model of 32,768 tokens takes, at three characters a token at least.
LOCAL_PROMPT = 98_304


def local_client(model: Callable[[str, float], str], limit: int = LOCAL_PROMPT, temperature: float = 0.1, fallback: Callable[[str, float], str] | None = None) -> Callable[[str], str]:
    """A client of a model on the machine: prompts cut to what it takes, halved again while it runs out of memory, then the fallback.

    A prompt keeps its head; what is cut is its end. The limits are those of the model.
    """

    def call(prompt: str) -> str:
        size = limit
        for _ in range(3):
            try:
                return model(prompt[:size], temperature)
            except MemoryError:
                size = min(size, len(prompt)) // 2
        if fallback is None:
            raise MemoryError("the model has no room for any part of the prompt")
        return fallback(prompt[:limit], temperature)

    return call


def extract(chunks: DataFrame, column: str, client: Callable[[str], str] = stub_client) -> DataFrame:
    """Adds answer: what the client says to each chunk, one client for each Python worker."""
    schema = ", ".join(f"`{n}` {t}" for n, t in chunks.dtypes) + ", answer string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = with_retries(client)
        for pdf in batches:
            yield pdf.assign(answer=[call(t) if isinstance(t, str) else None for t in pdf[column]])

    return chunks.mapInPandas(run, schema)


def raw_pipeline(documents: DataFrame, client: Callable[[str], str] = stub_client, size: int = 20_000, overlap: int = 500) -> DataFrame:
    """(paper_id, doc_id, chunk_no, pos, model_name, model_family, parameters): what each text of a batch job says, as it was said.

    The chain of a batch job: parse, cut only what is longer than a chunk, extract, save; nothing is normalised, selected or merged.
    """
    text = documents.where(F.col("text").isNotNull()).select("paper_id", "doc_id", "text")
    said = extract(chunked(text, "text", size, overlap), "chunk", client).select("paper_id", "doc_id", "chunk_no", F.try_parse_json(answers.isolate(F.col("answer"))).alias("v"))
    each = said.select("paper_id", "doc_id", "chunk_no", F.posexplode(F.try_variant_get("v", "$.models", "array<variant>")).alias("pos", "m"))
    return each.select("paper_id", "doc_id", "chunk_no", "pos", *[F.try_variant_get("m", f"$.{f}", "string").alias(f) for f in ("model_name", "model_family", "parameters")])


def pipeline(documents: DataFrame, client: Callable[[str], str] = stub_client, size: int = 6_000, overlap: int = 500) -> DataFrame:
    """(paper_id, model_name, parameters, n_variants): the releases that the texts of each paper describe."""
    text = documents.where(F.col("text").isNotNull()).select("paper_id", "doc_id", clean_text(F.col("text")).alias("text"))
    chunks = chunked(text, "text", size, overlap)
    said = extract(chunks, "chunk", client).select("paper_id", "doc_id", "chunk_no", F.try_parse_json(answers.isolate(F.col("answer"))).alias("v"))
    each = said.select("paper_id", "doc_id", "chunk_no", F.posexplode(F.try_variant_get("v", "$.models", "array<variant>")).alias("pos", "m"))
    fields = ["model_name", "model_family", "parameters", "organization", "license"]
    values = [F.try_variant_get("m", f"$.{f}", "string").alias(f) for f in fields]
    r = each.select("paper_id", "chunk_no", "pos", F.xxhash64("doc_id", "chunk_no", "pos").alias("record_id"), *values)
    for f in sorted(set(records.GATE_FIELDS + records.RICH_FIELDS + ["model_version"]) - set(fields)):
        r = r.withColumn(f, F.lit(None).cast("string"))
    r = r.withColumn("parameters_millions", derived_millions(F.col("parameters")).cast("bigint"))
    r = cut(r)  # the answers are dear: selection and merging read them several times
    # what several chunks say of one record, then known organisations, then the records that are the paper's own, then its releases
    filled = [c for c in r.columns if c not in ("paper_id", "record_id", "chunk_no", "pos", "model_name")]
    one = records.dedup_chunks(r, filled).drop("n").join(r.select("record_id", "chunk_no", "pos"), "record_id")
    one = cut(one.withColumn("organization", normalize_organisation(F.col("organization"))))
    merged = records.merge_variants(records.select_primary(one), ["model_family"])
    return merged.select("paper_id", "model_name", "parameters", "n_variants")
