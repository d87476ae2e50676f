"""Texts put into windows of fixed capacity with little space left, none cut unless it is longer than the window.

Bound-certified repacking. Sizes are tokens of a public tokenizer. The items of each window are spread over partitions of bounded
size and packed there by best-fit decreasing; dual-feasible functions give a lower bound of the number of bins, which certifies a
partition whose packing meets it. Partitions with a gap release their emptier bins, whose items are exchanged between partitions
and packed again; a repacking that needs no more bins than it got replaces them. Only sizes move, never texts.
"""

from __future__ import annotations

import base64
import bisect
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.session import cut

#: Vocabulary of the tokenizer (a .tiktoken file) and the pattern that splits a text before it.
VOCABULARY = os.path.join(os.environ.get("RECORDLOOM_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_multi_50k.tiktoken")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Items of a partition on average; rounds of exchange; share of its bins that a partition with a gap releases at least.
GROUP_ITEMS, ROUNDS, RELEASED = 20_000, 2, 0.1
#: A reference list of capacities is small; more windows than this are refused.
MOST_WINDOWS = 1_000


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) of every text that is not NULL; the vocabulary file goes along with the job (under 1 MB)."""
    with open(vocabulary, "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "n_tokens": [len(enc.encode_ordinary(t)) for t in pdf.text]})

    return documents.select("doc_id", "text").where(F.col("text").isNotNull()).mapInPandas(run, "doc_id bigint, n_tokens bigint").groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens"))


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item by best-fit decreasing; ties go to the bin opened first."""
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), np.int64)
    left: list[tuple[int, int]] = []  # (space left, bin), ascending
    opened = 0
    for i in order.tolist():
        size = int(sizes[i])
        at = bisect.bisect_left(left, (size, -1))
        if at < len(left):
            space, b = left.pop(at)
        else:
            space, b, opened = capacity, opened, opened + 1
        bins[i] = b
        if space > size:
            bisect.insort(left, (space - size, b))
    return bins


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Least number of bins that any packing needs, by dual-feasible functions.

    f(x, e) counts items over capacity - e whole, drops items under e and keeps the rest; u(x, k) rounds (k + 1) x down to k-ths
    unless it is whole. Both keep the sum of any bin at most 1, so their sums over all items bound the bins from below.
    """
    if not len(sizes):
        return 0
    s = np.sort(sizes.astype(np.int64))
    total = np.concatenate([[0], np.cumsum(s)])
    best = -(-int(total[-1]) // capacity)
    for e in np.unique(s[s <= capacity // 2]):
        whole = np.searchsorted(s, capacity - e, side="right")  # items over capacity - e
        small = np.searchsorted(s, e, side="left")
        best = max(best, int(len(s) - whole) + -(-int(total[whole] - total[small]) // capacity))
    best = max(best, int((2 * s > capacity).sum()))
    for k in range(1, 21):
        scaled = (k + 1) * s
        exact = scaled % capacity == 0
        value = int(np.where(exact, s * k, (scaled // capacity) * capacity).sum())  # in units of 1 / (k capacity)
        best = max(best, -(-value // (k * capacity)))
    return best


_PACKED = "window_name string, capacity bigint, doc_id bigint, piece bigint, n_tokens bigint, grp bigint, bin bigint, released boolean"
_STATS = ", items bigint, bins bigint, bound bigint"


def _pack(pdf: pd.DataFrame, round_no: int) -> pd.DataFrame:
    """Pack one partition; in a later round keep the bins it came with if repacking needs more."""
    pdf = pdf.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    capacity, sizes = int(pdf.capacity[0]), pdf.n_tokens.to_numpy(np.int64)
    bins, bound = best_fit(sizes, capacity), lower_bound(sizes, capacity)
    used = int(bins.max()) + 1
    if round_no:
        old = pd.factorize(pd.Series(list(zip(pdf.grp, pdf.bin))))[0]
        if old.max() + 1 < used:
            bins, used = old.astype(np.int64), int(old.max()) + 1
    fill = np.bincount(bins, weights=sizes, minlength=used)
    released = np.zeros(used, bool)
    if used > bound:
        n = min(used, max(2, 2 * (used - bound), int(used * RELEASED)))
        released[np.argsort(fill, kind="stable")[:n]] = True
    out = pdf[["window_name", "capacity", "doc_id", "piece", "n_tokens"]].copy()
    out["grp"], out["bin"], out["released"] = int(pdf.target[0]), bins, released[bins]
    out["items"], out["bins"], out["bound"] = len(pdf), used, bound
    return out


def _packer(round_no: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return _pack(pdf, round_no)

    return run


def _spread(df: DataFrame, by: list, group_items: int, seed: int) -> DataFrame:
    """Adds target: the partition of each row, by hash of `by`; about group_items rows each."""
    n = df.groupBy("window_name").agg(F.count("*").alias("_n"))
    groups = {r["window_name"]: max(1, -(-r["_n"] // group_items)) for r in n.collect()}  # one row a window
    count = F.lit(1)
    for name, g in groups.items():
        count = F.when(F.col("window_name") == name, F.lit(g)).otherwise(count)
    return df.withColumn("target", F.pmod(F.xxhash64(F.lit(seed), *by), count))


def pack(sizes: DataFrame, windows: DataFrame, group_items: int = GROUP_ITEMS, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Assignments and certificates from (doc_id, n_tokens) and (window_name, capacity_tokens).

    Assignments: (window_name, doc_id, piece_no, start_token, n_tokens, bin_id), one row for each piece of each text in each
    window; a text longer than the window is cut into full windows and a rest. Texts without tokens are in no window.
    Certificates: (window_name, round_no, group_id, n_items, n_bins, lower_bound, gap) of each partition as it was packed.
    Windows with a NULL or non-positive capacity take nothing.
    """
    rows = windows.select("window_name", "capacity_tokens").where("capacity_tokens > 0").distinct().limit(MOST_WINDOWS + 1).collect()
    if len(rows) > MOST_WINDOWS:
        raise ValueError(f"more than {MOST_WINDOWS} windows")
    spark = sizes.sparkSession
    if not rows:
        return (
            spark.createDataFrame([], "window_name string, doc_id bigint, piece_no bigint, start_token bigint, n_tokens bigint, bin_id string"),
            spark.createDataFrame([], "window_name string, round_no int, group_id bigint, n_items bigint, n_bins bigint, lower_bound bigint, gap bigint"),
        )
    each = F.array(*[F.struct(F.lit(r["window_name"]).alias("window_name"), F.lit(r["capacity_tokens"]).cast("bigint").alias("capacity")) for r in rows])
    pieces = sizes.where("n_tokens > 0").select("doc_id", F.col("n_tokens").alias("n"), F.explode(each).alias("w")).select("w.window_name", "w.capacity", "doc_id", "n")
    pieces = pieces.select("*", F.explode(F.expr("sequence(0L, (n - 1) div capacity)")).alias("piece"))
    pieces = pieces.withColumn("n_tokens", F.expr("least(capacity, n - piece * capacity)")).drop("n")
    full = pieces.where("n_tokens = capacity")
    items = pieces.where("n_tokens < capacity").withColumns({"grp": F.lit(0).cast("bigint"), "bin": F.lit(0).cast("bigint")})
    done, stats = [], []
    for round_no in range(rounds + 1):
        by = [F.col("doc_id"), F.col("piece")] if round_no == 0 else [F.col("grp"), F.col("bin")]
        spread = _spread(items, by, group_items, round_no)
        packed = cut(spread.groupBy("window_name", "target").applyInPandas(_packer(round_no), _PACKED + _STATS))
        stats.append(packed.select("window_name", F.lit(round_no).alias("round_no"), F.col("grp").alias("group_id"), F.col("items").alias("n_items"), F.col("bins").alias("n_bins"), F.col("bound").alias("lower_bound"), (F.col("bins") - F.col("bound")).alias("gap")).distinct())
        last = round_no == rounds
        kept = packed if last else packed.where("not released")
        done.append(kept.select("window_name", "doc_id", "piece", "capacity", "n_tokens", F.concat_ws("-", F.lit(round_no), "grp", "bin").alias("bin_id")))
        items = packed.where("released").drop("released", "items", "bins", "bound")
    whole = full.select("window_name", "doc_id", "piece", "capacity", "n_tokens", F.concat_ws("-", F.lit("full"), "doc_id", "piece").alias("bin_id"))
    out, certificates = whole, stats[0]
    for d in done:
        out = out.unionByName(d)
    for s in stats[1:]:
        certificates = certificates.unionByName(s)
    return out.select("window_name", "doc_id", F.col("piece").alias("piece_no"), (F.col("piece") * F.col("capacity")).alias("start_token"), "n_tokens", "bin_id"), certificates
