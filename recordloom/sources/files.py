"""Sources that are files: result files in two layouts, sheets, JSON lines, papers and their texts and tables."""

from __future__ import annotations

import os
import re
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import names as N
from recordloom.missing import trim_all
from recordloom.operators.evaluate import FIELDS

#: Every record field, all text but one number: schemas are stated, never inferred.
RECORD_FIELDS = [*FIELDS, "model_version", "training_corpus_size", "knowledge_cutoff_date", "finetuning_data", "tokenizer", "context_length", "supported_language", "hardware_description", "carbon_emitted", "source_code", "training_data", "training_compute", "performance_metrics", "release_date", "model_type", "paper_title"]
RECORD = T.StructType([T.StructField(f, T.StringType()) for f in RECORD_FIELDS])
RESULT_FILE = T.StructType([T.StructField("arxiv_id", T.StringType()), T.StructField("extraction_data", T.ArrayType(RECORD)), T.StructField("raw_extraction", T.ArrayType(RECORD))])
# Columns of a sheet of reference records and the fields that they fill.
SHEET = {
    "model name": "model_name", "model family": "model_family", "date created": "date_created", "organization": "organization", "innovation": "innovation", "pretraining architecture": "pretraining_architecture", "pretraining task": "pretraining_task", "fine-tuning task": "finetuning_task",
    "optimizer": "optimizer", "number of parameters": "parameters", "hardware used": "hardware_used", "extension": "extension", "blog post": "blog_post", "license": "license", "research problem": "research_problem",
}


def read_result_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, arxiv_id, pos, record fields): records of result files, one JSON object a file, in either layout.

    Files whose names say summary or evaluation are left out. Of the two arrays the first that is not empty counts; a file
    without records, or one that is no JSON, yields nothing.
    """
    raw = spark.read.schema(RESULT_FILE).option("multiLine", True).json(path).select("*", F.col("_metadata.file_name").alias("file_name"))
    named = raw.where(F.col("file_name").endswith(".json") & ~F.lower("file_name").contains("summary") & ~F.lower("file_name").contains("evaluation"))
    records = F.when(F.size("extraction_data") > 0, F.col("extraction_data")).otherwise(F.col("raw_extraction"))
    each = named.select("file_name", "arxiv_id", F.posexplode(records).alias("pos", "r"))
    return each.select("file_name", "arxiv_id", "pos", "r.*").withColumn("parameters_millions", F.col("parameters_millions").try_cast("double").cast("bigint"))


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Reference records from a CSV with a byte-order mark, quoted headers and cells over several lines; rows that are none left out."""
    raw = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    raw = raw.toDF(*[c.lstrip("﻿").strip('"').strip() for c in raw.columns])
    have = {c.lower(): c for c in raw.columns}
    cell = lambda c: F.nullif(trim_all(F.regexp_replace(F.col(f"`{have[c]}`"), '^"+|"+$', "")), F.lit("")) if c in have else F.lit(None).cast("string")
    title = F.coalesce(cell("title"), F.lit(""))
    rest = F.lower(F.substring(title, 1, 50)).rlike("^(compared with|t0pp is|a variety|the t5 model|t0 stands for|obtained by|fine-tuned with)")
    looks = title.contains(" - Contribution") | ((F.length(title) >= 20) & title.rlike(r"^\p{Lu}"))
    paper = trim_all(F.element_at(F.split(title, " - Contribution"), 1))
    rows = raw.where((title != "") & ~rest & looks & (F.length(paper) >= 10))
    most = N.sheet_millions(cell("maximum number of parameters (in million)")).cast("bigint")
    return rows.select(paper.alias("paper_title"), *[cell(c).alias(f) for c, f in SHEET.items()], most.alias("parameters_millions"), F.lit(None).cast("string").alias("pretraining_corpus"), F.lit(None).cast("string").alias("application"))


def read_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a stated schema; blank lines are skipped, lines that are no JSON give NULLs."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", schema).alias("r")).select("r.*")


def fetch_url(url: str) -> bytes:
    with urllib.request.urlopen(url, timeout=60) as answer:  # noqa: S310
        return answer.read()


def file_name(url: str) -> str:
    """File name that a URL's last part gives; other characters than word characters, dots and hyphens become underscores."""
    return re.sub(r"[^\w\-_.]", "_", url.rstrip("/").split("/")[-1])


def fetch_papers(papers: DataFrame, folder: str, fetch: Callable[[str], bytes] = fetch_url, force: bool = False) -> DataFrame:
    """(paper_id, path, status): papers stored in a shared folder, one file each; those already there are skipped unless forced.

    papers has paper_id and pdf_url. status is fetched, skipped or failed; a failure never stops the others.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for pdf in batches:
            out = []
            for key, url in zip(pdf.paper_id, pdf.pdf_url):
                if not isinstance(url, str) or not url.startswith(("http://", "https://")):
                    out.append((key, None, "failed"))
                    continue
                path = os.path.join(folder, file_name(url))
                if os.path.exists(path) and not force:
                    out.append((key, path, "skipped"))
                    continue
                try:
                    data = fetch(url)
                    with open(path + f".{os.getpid()}", "wb") as f:
                        f.write(data)
                    os.replace(f.name, path)
                    out.append((key, path, "fetched"))
                except Exception:  # noqa: BLE001
                    out.append((key, None, "failed"))
            yield pd.DataFrame(out, columns=["paper_id", "path", "status"])

    return papers.select("paper_id", "pdf_url").mapInPandas(run, "paper_id string, path string, status string")


def list_papers(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, length) of the stored papers, in order."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length").orderBy("file_name")


def plumb(data: bytes) -> tuple[str, list]:
    """Text and tables of a PDF, if the library for it is there."""
    import io

    import pdfplumber  # gated: not part of the image

    with pdfplumber.open(io.BytesIO(data)) as pdf:
        return "\n".join(p.extract_text() or "" for p in pdf.pages), [t for p in pdf.pages for t in p.extract_tables() or []]


def parse_papers(files: DataFrame, parse: Callable[[bytes], tuple[str, list]] = plumb, fallback: Callable[[bytes], tuple[str, list]] | None = None, least: int = 100) -> DataFrame:
    """(path, text, tables): texts and tables of binary files; a text under `least` characters is read again by the fallback.

    Tables without any filled cell are left out. A file that no parser reads has a NULL text.
    """

    def one(data: bytes) -> tuple:
        got = (None, [])
        for p in filter(None, (parse, fallback)):
            try:
                got = p(data)
            except Exception:  # noqa: BLE001
                continue
            if len((got[0] or "").strip()) >= least:
                break
        tables = [[[None if c is None else str(c) for c in row] for row in t] for t in got[1] if any(any(row) for row in t)]
        return got[0], tables

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [one(d) for d in pdf.content]
            yield pd.DataFrame({"path": pdf.path, "text": [g[0] for g in got], "tables": [g[1] for g in got]})

    return files.select("path", "content").mapInPandas(run, "path string, text string, tables array<array<array<string>>>")
