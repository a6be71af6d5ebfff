"""Quality classifier: hashed word and character n-gram vectors, averaged per document, softmax output.

Features of a text, as 64-bit hashes taken modulo ``BUCKETS``: its words, its pairs of neighbouring words, and its
words' runs of ``GRAMS`` code points, where a word has a mark before and behind it (so that beginnings and ends of
words tell themselves apart) and no run goes beyond its own word. The model is a table of vectors, one per bucket,
whose mean over the text's features goes through a linear layer and a softmax. It is trained by stochastic gradient
descent in numpy.

Training looks at ``SAMPLE`` labelled documents at most, drawn by a seeded hash of their doc_id, and of these, in that
order, at as many as hold ``SAMPLE_BYTES`` of counts; features are made on the executors. Only the text is looked at.
For scoring, the linear layer is applied to the table once, so a feature costs one look-up; the table is broadcast
and its size is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerweave.llm.shared import Scratch
from offerweave.llm.words import buffers, mix, slices, windows, word_table

BUCKETS = 1 << 17
DIMENSIONS = 16
SAMPLE = 4000
SAMPLE_BYTES = 192 << 20
EPOCHS = 6
RATE = 1.0
SEED = 11
GRAMS = (3, 4, 5)
PART = 1 << 20  # code points whose runs are made at once

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _marked(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, white space as 32 and one more before, between and behind texts; the text of each."""
    raw = data[at[0] : at[-1]]
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32).copy()
    points[(points >= 9) & (points <= 13)] = 32
    begins = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[at - at[0]]
    of_text = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(begins))
    return np.insert(points, begins, 32), np.insert(of_text, begins, -1)


def _runs(points: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the runs of ``size`` code points with white space at most at their ends, and where they begin."""
    n = len(points) - size + 1
    if n < 1:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    blank = points == 32
    inside = ~blank[1 : n + 1]
    for j in range(2, size - 1):
        inside &= ~blank[j : n + j]
    where = np.flatnonzero(inside)
    run = np.full(len(where), size, np.uint64)
    for j in range(size):
        run = run * _STEP + points[where + j]
    return (mix(run) % np.uint64(BUCKETS)).astype(np.int32), where


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For all texts together, in parts: buckets, and the text that each belongs to, ascending in a part."""
    data, at = buffers(column)
    _, _, h, first = word_table(data, at)
    n = len(at) - 1
    of_word = np.repeat(np.arange(n), np.diff(first))
    yield (h % np.uint64(BUCKETS)).astype(np.int32), of_word
    if len(h) > 1:
        inner = of_word[1:] == of_word[:-1]
        yield (windows(h, 2)[inner] % np.uint64(BUCKETS)).astype(np.int32), of_word[1:][inner]
    points, of_text = _marked(data, at)
    for size in GRAMS:
        for a in range(0, len(points), PART):
            bucket, where = _runs(points[a : a + PART + size - 1], size)
            yield bucket, of_text[a + where + 1]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (place, quality, text) to (place, quality, buckets, counts)."""
    for batch in slices(batches, "text"):
        parts = list(features(batch.column(2)))
        bucket, text = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(text, kind="stable")
        bounds = np.searchsorted(text[order], np.arange(batch.num_rows + 1))
        own = [np.unique(bucket[order[a:b]], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.record_batch(
            [
                batch.column(0),
                batch.column(1),
                pa.array([x.astype(np.int32).tobytes() for x, _ in own], pa.binary()),
                pa.array([c.astype(np.int32).tobytes() for _, c in own], pa.binary()),
            ],
            ["place", "quality", "buckets", "counts"],
        )


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias) of the log odds, from (label, buckets, counts) in a fixed order."""
    draw = np.random.default_rng(SEED)
    table = draw.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    steps = EPOCHS * max(1, len(rows))
    done = 0
    for _ in range(EPOCHS):
        for k in draw.permutation(len(rows)):
            label, buckets, counts = rows[k]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            share = (counts / max(1, counts.sum())).astype(np.float32)
            mean = share @ table[buckets] if len(buckets) else np.zeros(DIMENSIONS, np.float32)
            out = layer @ mean + bias
            out = np.exp(out - out.max())
            wrong = out / out.sum()
            wrong[label] -= 1
            back = wrong @ layer
            layer -= rate * np.outer(wrong, mean)
            bias -= np.float32(0.1) * rate * wrong
            # every feature's vector moves as far as if it stood alone, as its share is in the mean already
            table[buckets] -= rate * np.minimum(1, 50 * share)[:, None] * back
    weight = table @ (layer[1] - layer[0])
    return weight.astype(np.float64), float(bias[1] - bias[0])


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> tuple[np.ndarray, float]:
    """Fit on labelled rows that aren't held out; a row without a label or doc_id is never drawn.

    Of several labels of one id the largest counts, and of several texts of one id the one with the smallest hash (ties: the
    smallest text), so the driver gets one row for each drawn id. That row holds 8 bytes for each bucket met, 1 MB at
    most, however long the text; rows beyond ``most_bytes`` in all, in the order drawn, aren't learnt from.
    """
    usable = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    drawn = usable.withColumn("place", F.xxhash64("doc_id", F.lit(SEED))).orderBy("place", "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(drawn), "doc_id")
    one = met.groupBy("doc_id", "place", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    made = one.select(F.struct("place", "doc_id").alias("place"), "quality", F.col("least.text").alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        place = "place struct<place: bigint, doc_id: bigint>"
        counted = scratch.stored(made.mapInArrow(_counted, f"{place}, quality int, buckets binary, counts binary"), "counted")
        # a window over all, of at most ``sample`` rows of a few bytes
        size = F.octet_length("buckets") + F.octet_length("counts")
        total = F.sum(size).over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
        within = counted.select("place", total.alias("total")).where(F.col("total") <= most_bytes).select("place")
        learnt = counted.join(F.broadcast(within), "place").orderBy("place").select("quality", "buckets", "counts").toArrow()
    rows = [
        (q, np.frombuffer(b, np.int32), np.frombuffer(c, np.int32))
        for q, b, c in zip(learnt.column(0).to_pylist(), learnt.column(1).to_pylist(), learnt.column(2).to_pylist(), strict=True)
    ]
    return fit(rows)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: better quality likelier), predicted for each row of ``docs``.

    A null or empty text has no features: its score is that of the bias. A very long text comes alone into a batch, its
    runs made part by part. Without any usable label all scores are that of an untrained model. A null doc_id isn't held
    out. Rows with equal texts or ids are separate rows, equal texts with equal scores; an empty table gives no rows. Other
    columns, whatever their names, aren't read.
    """
    weight, bias = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in slices(batches, "text", 1 << 20):
            total, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for bucket, text in features(batch.column(2)):
                total += np.bincount(text, table[bucket], batch.num_rows)
                count += np.bincount(text, minlength=batch.num_rows)
            score = 1 / (1 + np.exp(-np.clip(total / np.maximum(1, count) + bias, -30, 30)))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
