"""A knowledge graph behind a small interface, with a deterministic store in memory for tests."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Store(Protocol):
    """What the engine asks of a knowledge graph. Ids are texts; contributions come in the order of the comparison."""

    def ping(self) -> bool: ...

    def template(self, template_id: str) -> list[dict]: ...

    def paper(self, paper_id: str) -> dict | None: ...

    def search(self, title: str) -> list[dict]: ...

    def create_paper(self, title: str, contributions: list[dict]) -> str: ...

    def append(self, paper_id: str, contribution: dict) -> str: ...

    def update(self, contribution_id: str, statements: dict) -> None: ...

    def contributions(self, comparison_id: str) -> list[dict]: ...

    def publish(self, comparison_id: str, contribution_ids: list[str], title: str) -> int: ...


class MemoryStore:
    """Papers, contributions and comparisons in dictionaries; ids count up. A title is there once, a label once in a paper."""

    def __init__(self, properties: list[dict] | None = None) -> None:
        self.papers: dict[str, dict] = {}
        self.properties = properties or []
        self.versions: dict[str, list[dict]] = {}

    def ping(self) -> bool:
        return True

    def template(self, template_id: str) -> list[dict]:
        """Properties of a template, each with id and label; one template is all there is."""
        return self.properties

    def paper(self, paper_id: str) -> dict | None:
        p = self.papers.get(paper_id)
        return p and {"id": paper_id, "title": p["title"], **p.get("facts", {})}

    def search(self, title: str) -> list[dict]:
        """Papers whose title holds a word of the one asked for, those with the most words in common first."""
        words = set(title.lower().split())
        near = [(len(words & set(p["title"].lower().split())), k) for k, p in self.papers.items()]
        return [self.paper(k) for n, k in sorted(near, key=lambda x: (-x[0], x[1])) if n]

    def create_paper(self, title: str, contributions: list[dict]) -> str:
        found = next((k for k, p in self.papers.items() if p["title"].strip().lower() == title.strip().lower()), None)
        key = found or f"R{len(self.papers) + 1}"
        self.papers.setdefault(key, {"title": title, "contributions": {}})
        for c in contributions:
            self.append(key, c)
        return key

    def append(self, paper_id: str, contribution: dict) -> str:
        own = self.papers[paper_id]["contributions"]
        for key, c in own.items():
            if c["label"] == contribution["label"]:
                for p, v in contribution.get("statements", {}).items():
                    c["statements"].setdefault(p, v)
                return key
        key = f"{paper_id}-C{len(own) + 1}"
        own[key] = {"label": contribution["label"], "statements": dict(contribution.get("statements", {}))}
        return key

    def update(self, contribution_id: str, statements: dict) -> None:
        """Statements of a contribution that is there, set anew; KeyError if it is not."""
        self.papers[contribution_id.split("-")[0]]["contributions"][contribution_id]["statements"].update(statements)

    def contributions(self, comparison_id: str) -> list[dict]:
        listed = self.versions.get(comparison_id)
        every = [{"id": k, "label": c["label"], "paper": p["title"], "paper_id": key} for key, p in self.papers.items() for k, c in p["contributions"].items()]
        return every if not listed else [c for c in every if c["id"] in listed[-1]["contributions"]]

    def publish(self, comparison_id: str, contribution_ids: list[str], title: str) -> int:
        """A new version of a comparison: the number of the version."""
        self.versions.setdefault(comparison_id, []).append({"title": title, "contributions": list(dict.fromkeys(contribution_ids))})
        return len(self.versions[comparison_id])


def read_contributions(spark: SparkSession, store: Store, comparison_id: str) -> DataFrame:
    """(pos, paper_id, paper, id, label): the contributions of a comparison in its order; the paper's id stands under one of three keys."""
    rows = [(i, next((c[k] for k in ("paper_id", "paper", "paperId") if c.get(k)), None), c.get("paper"), c["id"], c["label"]) for i, c in enumerate(store.contributions(comparison_id))]
    return spark.createDataFrame(rows, "pos int, paper_id string, paper string, id string, label string")


def read_template(spark: SparkSession, store: Store, template_id: str) -> DataFrame:
    """(ord, property, label): the properties of a template."""
    rows = [(i, p["id"], p.get("label")) for i, p in enumerate(store.template(template_id))]
    return spark.createDataFrame(rows, "ord int, property string, label string")


def fetch_papers(contributions: DataFrame, connect: Callable[[], Store]) -> DataFrame:
    """(title, pdf_url, doi, arxiv_id): the papers of contributions by title, of papers of one title the last in the comparison.

    Each paper is asked for once, in parallel; one that is not there, or has no title, is left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = connect()
        for pdf in batches:
            out = []
            for paper_id, pos in zip(pdf.paper_id, pdf.pos):
                try:
                    p = store.paper(paper_id) or {}
                except Exception:  # noqa: BLE001
                    p = {}
                if title := p.get("title") or p.get("label"):
                    out.append((title, pos, p.get("url") or p.get("pdf_url"), p.get("doi"), (p.get("identifiers") or {}).get("arxiv")))
            yield pd.DataFrame(out, columns=["title", "pos", "pdf_url", "doi", "arxiv_id"])

    ids = contributions.where(F.col("paper_id").isNotNull()).groupBy("paper_id").agg(F.max("pos").alias("pos"))
    found = ids.mapInPandas(run, "title string, pos int, pdf_url string, doi string, arxiv_id string")
    return found.groupBy("title").agg(F.max_by(F.struct("pdf_url", "doi", "arxiv_id"), "pos").alias("x")).select("title", "x.*")


def search_titles(titles: DataFrame, connect: Callable[[], Store]) -> DataFrame:
    """(title, found_title, paper_id, match): the first paper that a search for each title gives, exact or fuzzy; NULL if none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = connect()
        for pdf in batches:
            out = []
            for title in pdf.title:
                try:
                    best = next(iter(store.search(title.strip())), None)
                except Exception:  # noqa: BLE001
                    best = None
                exact = best and best["title"].lower() == title.strip().lower()
                out.append((title, best and best["title"], best and best["id"], best and ("exact" if exact else "fuzzy")))
            yield pd.DataFrame(out, columns=["title", "found_title", "paper_id", "match"])

    schema = "title string, found_title string, paper_id string, match string"
    return titles.select("title").where(F.col("title").isNotNull()).distinct().mapInPandas(run, schema)


def change(rows: DataFrame, connect: Callable[[], Store], how: str = "append") -> DataFrame:
    """(key, status): contributions added to papers (append: key is a paper) or set anew (update: key is a contribution).

    rows: key, label, statements as JSON. One connection a partition; a failure marks its row only.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = connect()
        for pdf in batches:
            out = []
            for key, label, text in zip(pdf.key, pdf.label, pdf.statements):
                try:
                    told = json.loads(text)
                    store.append(key, {"label": label, "statements": told}) if how == "append" else store.update(key, told)
                    out.append((key, "done"))
                except Exception:  # noqa: BLE001
                    out.append((key, "failed"))
            yield pd.DataFrame(out, columns=["key", "status"])

    return rows.select("key", "label", "statements").mapInPandas(run, "key string, status string")


def status(store: Store) -> dict:
    """Whether a store answers."""
    try:
        return {"reachable": bool(store.ping())}
    except Exception as e:  # noqa: BLE001
        return {"reachable": False, "error": str(e)}


#: Contributions of one upload.
PART = 500


def payloads(statements: DataFrame, labels: DataFrame, key: str = "prop_id", part: int = PART) -> DataFrame:
    """(paper_id, part, payload): the JSON of a paper's contributions, from the statements and labels of its records.

    Contributions are built per record and gathered in the order of the keys, in uploads of bounded size: a paper with a tenth of
    the records makes many. Which upload a record goes to is a hash of its key, so that no paper is numbered in one task.
    """
    by_property = statements.groupBy("paper_id", key, "property").agg(F.array_sort(F.collect_list(F.struct("ord", "reference", "value", "data_type"))).alias("vs"))
    one = by_property.groupBy("paper_id", key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("property", "vs")))).alias("statements"))
    each = one.join(labels, key).select("paper_id", key, F.to_json(F.struct("label", "statements")).alias("c"))
    parts = each.groupBy("paper_id").agg(F.ceil(F.count("*") / part).alias("n_parts"))
    placed = each.join(parts, "paper_id").withColumn("part", F.pmod(F.xxhash64(key), F.col("n_parts")).cast("int"))
    per = placed.groupBy("paper_id", "part").agg(F.array_sort(F.collect_list(F.struct(key, "c"))).alias("cs"))
    return per.select("paper_id", "part", F.concat(F.lit("["), F.array_join(F.transform("cs", lambda x: x["c"]), ","), F.lit("]")).alias("payload"))


def upload(payloads: DataFrame, titles: DataFrame, connect: Callable[[], Store]) -> DataFrame:
    """(paper_id, store_id, status): payloads sent to a store, one connection a partition; a failure marks its paper only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = connect()
        for pdf in batches:
            out = []
            for paper, title, text in zip(pdf.paper_id, pdf.title, pdf.payload):
                try:
                    out.append((paper, store.create_paper(title or paper, json.loads(text)), "created"))
                except Exception:  # noqa: BLE001
                    out.append((paper, None, "failed"))
            yield pd.DataFrame(out, columns=["paper_id", "store_id", "status"])

    return payloads.join(titles.select("paper_id", "title"), "paper_id", "left").mapInPandas(run, "paper_id string, store_id string, status string")
