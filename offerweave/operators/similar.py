"""Similarity join of texts: an exact signature index of q-grams, filtered by length, position and edit distance.

A ratio of matching blocks of r or more means that one text becomes the other by at most (1 - r)(|a| + |b|) insertions
and deletions. Each of them spoils at most q of a text's q-grams. So of the first K q + 1 q-grams of a text in
any fixed order, K being the most edits that any partner allows, one at least is unspoilt, stands in the partner within
K places, and is among the partner's first ones as well. The order puts rare q-grams first.

Texts of several columns that all must be similar are indexed by a q-gram of each: rows meet only if they share all,
so neither a common title nor a common employer brings together what differs in the other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerweave.operators.tables import Workspace

BUCKETS = 1 << 17  # of q-gram frequencies: a broadcast of fixed size
HOT_KEY = 2000  # rows of a key beyond which it is salted


@dataclass(frozen=True)
class Near:
    """Texts of ``column`` must reach ``ratio``; they are cut into q-grams of ``q`` characters."""

    column: str
    ratio: float
    q: int = 3


def ratio(a: str, b: str) -> float:
    """Matching blocks' share of both texts, leader first; every character counts, however frequent."""
    if not a or not b:
        return 0.0
    return 1.0 if a == b else SequenceMatcher(None, a, b, autojunk=False).ratio()


def most_edits(n: int, low: float) -> int:
    """Insertions and deletions between a text of n characters and any partner that reaches the ratio."""
    return int((1 - low) * 2 * n / low + 1e-9)


def _unsure(near: Near) -> int:
    """Texts of up to so many characters may have a partner with which they share no q-gram."""
    n = max([n for n in range(1, 64 * near.q) if n - near.q + 1 <= near.q * most_edits(n, near.ratio)], default=0)
    return int(n * (2 - near.ratio) / near.ratio + 1e-9)


def signature(text: str, near: Near, rank: np.ndarray) -> list[tuple[str, int]]:
    """(q-gram, place) pairs of which similar texts share one, at places that are near; '' stands for a short text."""
    n, q = len(text), near.q
    edits = most_edits(n, near.ratio)
    short = [("", 0)] if n <= _unsure(near) else []
    if not edits:  # only equal texts are near enough, but for those of short ones
        return [("=" + text, 0), *short]
    grams = sorted((int(rank[zlib.crc32(text[k : k + q].encode()) % BUCKETS]), text[k : k + q], k) for k in range(n - q + 1))
    first = q * edits + 1
    if first < len(grams):  # with all places of the last one
        grams = [g for g in grams if g[:2] <= grams[first - 1][:2]]
    out = [(g, k) for _, g, k in grams] + short
    # a partner that itself allows no edit is found by the whole text only, but then it is equal
    return out


def _gram_ranks(rows: DataFrame, nears: tuple[Near, ...]) -> np.ndarray:
    """How many texts' q-grams fall into each bucket."""
    rank = np.zeros(BUCKETS, np.int64)
    for near in nears:
        c = F.col(near.column)
        grams = F.transform(F.sequence(F.lit(1), F.length(c) - near.q + 1), lambda k: F.substring(c, k, F.lit(near.q)))
        found = rows.where(F.length(c) >= near.q).select(F.explode(grams).alias("g")).groupBy((F.crc32(F.col("g").cast("binary")) % BUCKETS).alias("b")).count()
        for r in found.collect():  # one row per bucket at most
            rank[r["b"]] += r["count"]
    return rank


def _entries(nears: tuple[Near, ...], rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, places = [], [], []
            columns = [batch.column(k + 1).to_pylist() for k in range(len(nears))]
            for i, texts in zip(batch.column(0).to_pylist(), zip(*columns, strict=True), strict=True):
                signatures = [signature(t, near, rank) for t, near in zip(texts, nears, strict=True)]
                by: dict[str, set[tuple]] = {}
                for combined in product(*signatures):
                    by.setdefault("\x1f".join(g for g, _ in combined), set()).add(tuple(p for _, p in combined))
                for key, at in by.items():
                    ids.append(i)
                    keys.append(key)
                    places.append([list(p) for p in sorted(at)])
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(keys, pa.string()), pa.array(places, pa.list_(pa.list_(pa.int32())))], ["id", "key", "places"])

    return run


def edits_allowed(near: Near, a: Column, b: Column) -> Column:
    return F.floor(F.lit(1 - near.ratio) * (F.length(a) + F.length(b)) + F.lit(1e-9))


def candidates(rows: DataFrame, nears: tuple[Near, ...], work: Workspace, also: Column | None = None) -> DataFrame:
    """(a, b) with a < b: pairs of ``id`` of which each column may reach its ratio, with both sides' texts.

    Lossless: every pair whose ratios are reached is among them. ``also`` is a further condition, on columns named
    as in ``rows`` with ``_a`` and ``_b`` appended. Keys that many rows share are dealt to several tasks.
    """
    others = [c for c in rows.columns if c != "id"]
    rank = _gram_ranks(rows, nears)
    made = rows.select("id", *[n.column for n in nears]).mapInArrow(_entries(nears, rank), "id long, key string, places array<array<int>>")
    sizes = [F.length(n.column).alias(f"n{k}") for k, n in enumerate(nears)]
    made = work.written(made)
    counts = work.written(made.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").withColumn("salts", F.ceil(F.col("rows") / HOT_KEY).cast("int")).drop("rows"))
    entries = work.written(made.join(counts, "key").join(rows.select("id", *sizes), "id"))
    side = lambda s: entries.select("key", "salts", F.col("id").alias(s), F.col("places").alias(f"places_{s}"), *[F.col(f"n{k}").alias(f"n{k}_{s}") for k in range(len(nears))])
    left = side("a").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int")).drop("salts")
    right = side("b").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    met = left.join(right, ["key", "salt"]).where("a < b")
    for k, near in enumerate(nears):
        least, most = F.least(f"n{k}_a", f"n{k}_b"), F.greatest(f"n{k}_a", f"n{k}_b")
        met = met.where(2 * least >= F.lit(near.ratio) * (least + most) - F.lit(1e-9))
    allowed = [F.floor(F.lit(1 - near.ratio) * (F.col(f"n{k}_a") + F.col(f"n{k}_b")) + F.lit(1e-9)) for k, near in enumerate(nears)]
    # some place of each column's q-gram is near a place of the partner's
    close = lambda p, q: F.forall(F.zip_with(F.zip_with(p, q, lambda x, y: F.abs(x - y)), F.array(*allowed), lambda d, m: d <= m), lambda ok: ok)
    met = met.where(F.exists("places_a", lambda p: F.exists("places_b", lambda q: close(p, q)))).select("a", "b").distinct()
    text = lambda s: rows.select(F.col("id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in others])
    met = met.join(text("a"), "a").join(text("b"), "b")
    if also is not None:
        met = met.where(also)
    for near in nears:
        a, b = F.col(f"{near.column}_a"), F.col(f"{near.column}_b")
        met = met.where(F.levenshtein(a, b) <= edits_allowed(near, a, b))
    return met


def with_ratios(pairs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Adds ``<column>_ratio`` of the two texts of each pair; ``pairs`` has a, b and both sides' texts."""
    fixed = [c for c in pairs.columns if c not in {f"{n}_{s}" for n in columns for s in "ab"}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: k for k, n in enumerate(batch.schema.names)}
            out = [batch.column(at[c]) for c in fixed]
            for c in columns:
                known: dict[tuple[str, str], float] = {}
                values = []
                for x in zip(batch.column(at[f"{c}_a"]).to_pylist(), batch.column(at[f"{c}_b"]).to_pylist(), strict=True):
                    if x not in known:
                        known[x] = ratio(*x)
                    values.append(known[x])
                out.append(pa.array(values, pa.float64()))
            yield pa.record_batch(out, [*fixed, *[f"{c}_ratio" for c in columns]])

    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in fixed], *[f"{c}_ratio double" for c in columns]])
    return pairs.mapInArrow(run, schema)
