"""Importance resampling towards a target distribution: array-scored weights, and a cutoff found by bracketing.

1. Every run of 1 to ``longest`` words of a text is a feature; its bucket is the CRC-32 of its bytes modulo
   ``buckets``. Each task adds up one array of bucket counts for the corpus and one for the target texts; the sums, as
   many numbers as there are buckets, are all that the driver sees. They give a gain per bucket.
2. A second pass looks each feature's gain up in that array: weight, and a score with seeded Gumbel noise, so that
   the highest scores are a draw without replacement. Scores are written once.
3. The cutoff is where the best part ends. A quantile sketch of the scores gives a bracket around it; rows above and
   inside the bracket are counted exactly, and the bracket is widened until the cutoff lies in it. Only the bracket
   is sorted to find it; rows above are drawn whatever their order, rows below are not.
4. Ranks of the drawn rows come from range partitions: each knows how many rows lie before it.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerweave.llm.shared import Scratch, stored
from offerweave.llm.words import buffers, slices

SEGMENT = 1 << 21  # bytes that are looked at together
ACCURACY = 10_000  # of the quantile sketch: one over its relative error
LOCKSTEP = 64  # longer words are summed one by one
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_SPACE = 32
_ONE_BYTE = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
#: What one byte does to a register of zeros; CRC-32 being linear, the start value cancels out.
_CRC = _ONE_BYTE ^ _ONE_BYTE[0]


@dataclass(frozen=True)
class Draw:
    """Settings of a draw: ``share`` of the eligible texts, those with ``least_words`` words at least."""

    buckets: int = 10_000
    longest: int = 1
    seed: int = 2024
    least_words: int = 20
    share: tuple[int, int] = (10, 100)
    margin: float = 0.002  # half of the first bracket's width, as a part of the eligible texts


def _after(crc: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _CRC[(crc ^ byte) & np.uint32(255)] ^ (crc >> np.uint32(8))


def crc_of_runs(data: np.ndarray, start: np.ndarray, stop: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of every range of bytes, all ranges one byte further at a time; ``before`` continues other sums."""
    crc = np.zeros(len(start), np.uint32) if before is None else before.copy()
    size = stop - start
    long = np.flatnonzero(size > LOCKSTEP)
    register = ~crc
    at = np.flatnonzero((size > 0) & (size <= LOCKSTEP))
    for k in range(int(size[at].max()) if len(at) else 0):
        at = at[size[at] > k]
        register[at] = _after(register[at], data[start[at] + k].astype(np.uint32))
    out = ~register
    for k in long.tolist():
        out[k] = zlib.crc32(data[start[k] : stop[k]], int(crc[k]))
    return out


def _cuts(data: np.ndarray, a: int, b: int) -> Iterator[tuple[int, int]]:
    """Segments of one text, cut between words; a longer word comes whole."""
    while a < b:
        stop = min(a + SEGMENT, b)
        while stop < b and _IS_WORD[data[stop]]:
            more = data[stop : min(stop + 4096, b)]
            out = np.flatnonzero(~_IS_WORD[more])
            stop += int(out[0]) if len(out) else len(more)
        yield a, stop
        a = stop


def _features(data: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the word that ends it, CRC-32) of each feature of one stretch of lower-case bytes."""
    edge = np.diff(_IS_WORD[data].astype(np.int8), prepend=0, append=0)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    crc = crc_of_runs(data, start, stop)
    at, found = [np.arange(len(start))], [crc]
    for n in range(2, longest + 1):
        if len(start) < n:
            break
        crc = ~_after(~crc[: len(start) - n + 1], np.uint32(_SPACE))
        crc = crc_of_runs(data, start[n - 1 :], stop[n - 1 :], crc)
        at.append(np.arange(n - 1, len(start)))
        found.append(crc)
    return np.concatenate(at), np.concatenate(found)


def _stretches(data: np.ndarray, at: np.ndarray, longest: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(text a, text b, first text of each feature, CRC of each): short texts together, long ones in segments.

    In a long text a segment begins with the last words of the one before, whose own features are left out.
    """
    n, a = len(at) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(at, at[a] + SEGMENT, "right")) - 1)
        if at[b] - at[a] <= SEGMENT:
            if longest == 1:  # one space between texts is enough to part their words
                lo = at[a : b + 1]
                own = np.insert(_LOW[data[lo[0] : lo[-1]]], (lo[1:-1] - lo[0]).astype(np.int64), _SPACE)
                edge = np.diff(_IS_WORD[own].astype(np.int8), prepend=0, append=0)
                start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                text = np.searchsorted(lo[1:] - lo[0] + np.arange(1, len(lo)), start, "right")
                yield a, b, text, crc_of_runs(own, start, stop)
            else:
                for k in range(a, b):
                    _, crc = _features(_LOW[data[at[k] : at[k + 1]]], longest)
                    yield k, k + 1, np.zeros(len(crc), np.int64), crc
        else:
            kept = np.zeros(0, np.uint8)
            for lo, hi in _cuts(data, int(at[a]), int(at[b])):
                own = np.concatenate([kept, _LOW[data[lo:hi]]])
                edge = np.diff(_IS_WORD[own].astype(np.int8), prepend=0, append=0)
                start = np.flatnonzero(edge == 1)
                carried = int(np.searchsorted(start, len(kept)))
                last, crc = _features(own, longest)
                crc = crc[last >= carried]
                yield a, b, np.zeros(len(crc), np.int64), crc
                if longest > 1:
                    back = start[-min(longest - 1, len(start)) :] if len(start) else np.zeros(0, np.int64)
                    kept = np.append(own[int(back[0]) :], np.uint8(_SPACE)) if len(back) else kept
        a = b


def bucket_counts(texts: DataFrame, draw: Draw) -> np.ndarray:
    """How many features of the column ``text`` fall into each bucket: one array per task, added up by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(draw.buckets, np.int64)
        for batch in slices(batches, "text"):
            data, at = buffers(batch.column(0))
            for _, _, _, crc in _stretches(data, at, draw.longest):
                total += np.bincount(crc % np.uint32(draw.buckets), minlength=draw.buckets)
        there = np.flatnonzero(total)
        yield pa.record_batch([pa.array(there, pa.int32()), pa.array(total[there])], ["bucket", "n"])

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(draw.buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # as many rows as buckets at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln(ratio of the target's smoothed share to the corpus's)), in doubles."""
    b, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(y + 1) * float(s + b) / (float(x + 1) * float(t + b)))) for x, y in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def scored(docs: DataFrame, gain: np.ndarray, draw: Draw) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, at = buffers(batch.column(1))
            total, n = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for a, b, text, crc in _stretches(data, at, draw.longest):
                own = gain[crc % np.uint32(draw.buckets)]
                n[a:b] += np.bincount(text, minlength=b - a)
                before = np.concatenate([[0], np.cumsum(own)])
                if b - a == 1:
                    total[a] += before[-1]
                else:  # features come in the order of their texts
                    edge = np.searchsorted(text, np.arange(b - a + 1))
                    total[a:b] += before[edge[1:]] - before[edge[:-1]]
            ids = batch.column(0).to_pylist()
            # runs of up to L words: w words give w + (w - 1) + ... of them
            top = draw.longest
            words = np.where(n >= top * (top + 1) // 2, (n + top * (top - 1) // 2) // top, (np.sqrt(8 * n + 1).astype(np.int64) - 1) // 2)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            made = weight + np.array([noise(draw.seed, x) for x in ids], np.int64)
            yield pa.record_batch([pa.array(ids, pa.int64()), *[pa.array(x.astype(np.int64)) for x in (words, n, weight, made)]], ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(score, _SCORED)


def bracket(rows: DataFrame, take: int, total: int, margin: float) -> tuple[int, int, int]:
    """(low, high, n above high): scores between which the ``take``-th highest of ``rows`` lies.

    The sketch only proposes: counts of all rows say whether the bracket holds, else it is widened.
    """
    part = 1 - take / total
    while margin < 1:
        ends = [max(0.0, part - margin), min(1.0, part + margin)]
        low, high = rows.agg(F.percentile_approx("score", ends, ACCURACY).alias("q")).first()["q"]
        above, below = rows.agg(F.count_if(F.col("score") > high).alias("a"), F.count_if(F.col("score") < low).alias("b")).first()
        if above <= take <= total - below:
            return low, high, above
        margin *= 8
    low, high = rows.agg(F.min("score").alias("a"), F.max("score").alias("b")).first()
    return low, high, 0


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]


def ranked(rows: DataFrame, scratch: Scratch, first: int = 0) -> DataFrame:
    """``rows`` with ``rank``, from ``first`` + 1 on: range partitions, and how many rows lie before each.

    ``row`` makes every row different, so equal scores and ids are dealt to several partitions as well.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = scratch.stored(rows.repartitionByRange(n, *_order()).withColumn("part", F.spark_partition_id()), "ranges")
    before, at = [], first
    for r in parts.groupBy("part").count().orderBy("part").collect():  # one row per partition
        before.append((r["part"], at))
        at += r["count"]
    offsets = F.broadcast(rows.sparkSession.createDataFrame(before, "part int, before long"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*_order()))
    return parts.withColumn("within", within).join(offsets, "part").withColumn("rank", F.col("before") + F.col("within")).drop("part", "before", "within")


def importance_sample(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:  # noqa: B008
    """doc_id, n_features, weight, score, rank of each row of ``docs``; rank is null for rows that aren't drawn.

    ``docs`` has doc_id and text, ``target`` has text; other columns are ignored. Null and empty texts have no words:
    weight 0, never drawn. A null doc_id draws its noise from an empty id and comes last among ties. Rows that repeat a
    doc_id are rows of their own. An empty target makes all buckets' target counts 0; an empty corpus gives no
    rows. Very long texts are read in segments of 2 MB. Ties of score and doc_id are between equal ids; each gets a rank.
    """
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, draw), bucket_counts(target, draw))
    rows = stored(scored(docs, gain, draw).withColumn("row", F.monotonically_increasing_id()), "scores")
    eligible = rows.where(F.col("n_words") >= draw.least_words)
    total = eligible.count()
    take = draw.share[0] * total // draw.share[1]
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    undrawn = F.lit(None).cast("long").alias("rank")
    if not take:
        return rows.select(*columns[:4], undrawn)
    low, high, above = bracket(eligible, take, total, draw.margin)
    with Scratch(spark) as scratch:
        inside = ranked(eligible.where(F.col("score").between(low, high)), scratch, above)
        inside = inside.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
        best = ranked(eligible.where(F.col("score") > high), scratch)
        drawn = stored(best.unionByName(inside).select(*columns), "drawn")
    rest = rows.where((F.col("n_words") < draw.least_words) | (F.col("score") < low)).select(*columns[:4], undrawn)
    return drawn.unionByName(rest)


def oracle(draw: Draw = Draw()) -> str:  # noqa: B008
    """DuckDB SQL for single words; CRC-32 from its polynomial."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    n = draw.buckets
    return f"""
WITH c AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc),
d AS (SELECT row_number() OVER () AS k, doc_id, {words} AS w FROM documents),
f AS (SELECT k, unnest(w) AS word FROM d),
g AS (SELECT word, count(*) AS times FROM (SELECT unnest({words}) AS word FROM benchmark) b GROUP BY word),
v AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM f UNION SELECT word FROM g) u),
b AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))), lambda x, y: xor(x >> 8, crc[1 + (xor(x, y) & 255)]))) % {n} AS bucket FROM v, c),
s AS (SELECT bucket, count(*) AS s FROM f JOIN b USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(times) AS t FROM g JOIN b USING (word) GROUP BY bucket),
a AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + {n})::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + {n})::DOUBLE))) AS BIGINT) AS gain FROM s FULL JOIN t USING (bucket)),
w AS (SELECT k, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM f JOIN b USING (word) JOIN a USING (bucket) GROUP BY k),
r AS (SELECT k, doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{draw.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN w USING (k)),
e AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS total FROM r WHERE n_features >= {draw.least_words})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {draw.share[0]} * total // {draw.share[1]} THEN rank END AS rank FROM r LEFT JOIN e USING (k)"""
