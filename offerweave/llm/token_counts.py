"""Token counts: a broadcast table of frequent pre-tokens, worker caches for the rest, no pre-token shuffle.

First tier: every task sums up the pre-tokens (white-space separated chunks) of all its texts in a bounded summary
(Misra-Gries: any chunk with more than its n-th part of the occurrences stays); summaries are merged in two
rounds, and the lengths of the ``FREQUENT`` most common chunks are broadcast. Their number is fixed, so the table
doesn't grow with the data. Second tier: a chunk that is not in the table is encoded by the library once per
worker and kept in that worker's cache. Only summaries are ever shuffled.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.llm.shared import Scratch
from offerweave.llm.word_encoder import encoder
from offerweave.llm.words import buffers, slices

FREQUENT = 30_000
SUMMARY = 120_000  # chunks in a task's summary
MERGED = 16  # summaries that one task merges
LONGEST = 64  # bytes of a chunk that the table may hold
LIMIT = 2048


def _shrink(counts: Counter, most: int) -> Counter:
    """The most common entries, all lowered by the largest count that goes."""
    if len(counts) <= most:
        return counts
    ranked = counts.most_common(most + 1)
    floor = ranked[-1][1]
    return Counter({k: n - floor for k, n in ranked[:-1] if n > floor})


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in slices(batches, "text"):
        data, at = buffers(batch.column(0))
        for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            counts.update(data[x:y].tobytes().split())
        if len(counts) > 2 * SUMMARY:
            counts = _shrink(counts, SUMMARY)
    yield _row(_shrink(counts, FREQUENT))


def _row(counts: Counter) -> pa.RecordBatch:
    return pa.record_batch([pa.array([pickle.dumps({k: n for k, n in counts.items() if len(k) <= LONGEST})], pa.binary())], ["summary"])


def _merge(table: pa.Table) -> pa.Table:
    total: Counter = Counter()
    for x in table.column("summary").to_pylist():
        total.update(pickle.loads(x))
    return pa.Table.from_batches([_row(_shrink(total, FREQUENT))])


def frequent_chunks(texts: DataFrame) -> dict[bytes, int]:
    """The most common chunks of column ``text`` with counts that are too low by a bounded part at most."""
    with Scratch(texts.sparkSession) as scratch:
        summaries = scratch.stored(texts.mapInArrow(_summarise, "summary binary").withColumn("task", F.spark_partition_id().cast("long")), "summaries")
        tasks = (summaries.agg(F.max("task")).first()[0] or 0) + 1
        while tasks > 1:
            groups = summaries.select(F.floor(F.col("task") / MERGED).alias("task"), "summary").groupBy("task")
            summaries = scratch.stored(groups.applyInArrow(_merge_keyed, "summary binary, task long"), "summaries")
            tasks = -(-tasks // MERGED)
        rows = summaries.limit(1).collect()
    return pickle.loads(rows[0]["summary"]) if rows else {}


def _merge_keyed(key: tuple, table: pa.Table) -> pa.Table:
    return _merge(table).append_column("task", pa.array([key[0].as_py()], pa.int64()))


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) for each row of ``docs`` (doc_id, text).

    Null counts as the empty text: no bytes, no tokens. Rows are independent, so repeated rows or ids don't
    matter; other columns are not read.
    """
    texts = docs.select(F.col("text").cast("string").alias("text"))
    own = encoder(path)
    table = {k: len(own.ids(k)) for k in frequent_chunks(texts)}
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = shared.value.get, encoder(path)
        per_token = 2 if second.width == "H" else 4
        for batch in slices(batches, "text"):
            data, at = buffers(batch.column(1))
            n_tokens = []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                chunks = data[a:b].tobytes().split()
                found = list(map(first, chunks))
                if None in found:
                    for k, x in enumerate(found):
                        if x is None:
                            known = second.young.get(chunks[k]) or second.missed(chunks[k])
                            found[k] = len(known) // per_token
                n_tokens.append(sum(found))
            n = pa.array(n_tokens, pa.int64())
            over = pa.array([x > limit for x in n_tokens], pa.bool_())
            yield pa.record_batch([batch.column(0), pa.array(at[1:] - at[:-1]), n, over], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
