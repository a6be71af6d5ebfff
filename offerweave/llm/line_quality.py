"""Quality rules: base counts of each text, then lines that too many documents of a host share.

Every line is normalised (A-Z to a-z, runs of white space to one space, ends trimmed) and hashed. A line is *above
the limit* in a host if at least ``LEAST_DOCUMENTS`` distinct documents of the host have it and these are more than
``SHARE`` of the host's distinct documents. Documents are distinct by a digest of their whole text, so that a text
copied many times does not turn its own lines into boilerplate; texts that differ anywhere, near copies too, are
documents of their own, since pages that are little but a common line are near copies of each other. Lines above the
limit are removed; a document that keeps less than ``LEAST_LEFT`` of its words is depleted and rejected, as are those
that fail the base rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.llm.shared import apart, stored
from offerweave.llm.words import SPACE, buffers, slices, windows, word_table

LEAST_DOCUMENTS = 20
SHARE = (1, 50)  # numerator and denominator
LEAST_LEFT = (3, 10)
LEAST_WORDS = 50
MOST_REPEATED = (50, 100)
SALTS = 16  # a line that a third of all rows share is joined in so many parts

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CHARACTER = np.array([not SPACE[b] and b & 0xC0 != 0x80 for b in range(256)])


def line_hash(line: bytes) -> int:
    """Of the normalised line, as a signed 64-bit integer."""
    return xxhash.xxh64_intdigest(b" ".join(line.lower().split())) - (1 << 63)


def repeated_words(h: np.ndarray) -> int:
    """How many of a text's words (by hash) lie in 3-word windows that are found twice or more."""
    if len(h) < 4:
        return 0
    rolled = windows(h, 3)
    order = np.argsort(rolled, kind="stable")
    same = rolled[order][1:] == rolled[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(rolled), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(h), bool)
    for j in range(3):
        covered[j : j + len(twice)] |= twice
    return int(covered.sum())


def _sums(flags: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many bytes of each text are flagged."""
    if at[-1] == at[0]:
        return np.zeros(len(at) - 1, np.int64)
    total = np.concatenate([[0], np.cumsum(flags[data[at[0] : at[-1]]], dtype=np.int64)])
    return total[at[1:] - at[0]] - total[at[:-1] - at[0]]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that end in a text column ``__text``, which the counts replace."""
    for batch in slices(batches, "__text"):
        column = batch.column(batch.num_columns - 1)
        data, at = buffers(column)
        _, _, h, first = word_table(data, at)
        n_words = np.diff(first)
        repeated = np.fromiter((repeated_words(h[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)), np.int64, len(n_words))
        dup, size, hashes, words = [], [], [], []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            lines = [x for x in data[a:b].tobytes().split(b"\n") if x.strip()]
            dup.append(len(lines) - len(set(lines)))
            own: dict[int, int] = {}
            for x in lines:
                own[k] = own.get(k := line_hash(x), 0) + len(x.split())
            size.append(len(own))
            hashes += own.keys()
            words += own.values()
        ends = pa.array(np.cumsum([0, *size]), pa.int32())
        failed = (n_words < LEAST_WORDS) | (MOST_REPEATED[1] * repeated > MOST_REPEATED[0] * n_words)
        made = {
            "n_words": pa.array(n_words),
            "word_chars": pa.array(_sums(_CHARACTER, data, at)),
            "n_symbols": pa.array(_sums(_SYMBOL, data, at)),
            "n_dup_lines": pa.array(dup, pa.int64()),
            "n_repeat_words": pa.array(repeated),
            "base_failed": pa.array(failed),
            "__lines": pa.ListArray.from_arrays(ends, pa.array(hashes, pa.int64())),
            "__words": pa.ListArray.from_arrays(ends, pa.array(words, pa.int64())),
        }
        kept = batch.schema.names[:-1]
        yield pa.record_batch([*batch.columns[:-1], *made.values()], [*kept, *made])


_MADE = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, __lines array<long>, __words array<long>"
)


KEY = ("__id", "__hash", "__host")


def _keys() -> list:
    """What rows are told apart by; rows that agree in all of it get one verdict. Null hosts count as ''."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("__id"),
        F.xxhash64(F.col("text").cast("string")).alias("__hash"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("__host"),
    ]


def _marked(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: its keys and counts, the words in lines above the limit, their hashes, and the verdict."""
    rows = docs.select(*_keys(), F.col("doc_id"), F.col("text").cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    made = rows.mapInArrow(_measure, f"{schema}, {_MADE}").withColumn("__row", F.monotonically_increasing_id())
    made = stored(made, "measured")  # row numbers stay as they are written
    lines = made.select("__row", "__host", "__hash", F.explode(F.arrays_zip("__lines", "__words")).alias("l"))
    lines = lines.select("__row", "__host", "__hash", F.col("l.__lines").alias("line"), F.col("l.__words").alias("words"))
    counts = lines.groupBy("__host", "line").agg(F.count_distinct("__hash").alias("documents")).where(F.col("documents") >= LEAST_DOCUMENTS)
    hosts = made.groupBy("__host").agg(F.count_distinct("__hash").alias("texts"))
    above = counts.join(hosts, "__host").where(SHARE[1] * F.col("documents") > SHARE[0] * F.col("texts")).select("__host", "line")
    above = above.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = lines.withColumn("salt", F.pmod("__row", F.lit(SALTS)).cast("int"))
    removed = salted.join(above, ["__host", "line", "salt"]).groupBy("__row").agg(F.sum("words").alias("n_removed_words"), F.collect_list("line").alias("__gone"))
    met = made.drop("__lines", "__words").join(removed, "__row", "left")
    met = met.withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = LEAST_LEFT[1] * left < LEAST_LEFT[0] * F.col("n_words")
    return met.withColumn("depleted", depleted).withColumn("kept", ~F.col("base_failed") & ~depleted)


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, n_removed_words, depleted and kept for each row of ``docs``.

    ``docs`` has doc_id, text and source (the host; null counts as ''). A null or empty text has no words and fails
    the base rules. Rows with equal texts or ids are separate rows. Lines without a word are never counted. Other
    columns aren't read.
    """
    return _marked(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words", "depleted"
    )


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose last column is their lines that go: the same without it, and without these lines in ``text``."""
    for batch in slices(batches, "text"):
        names = batch.schema.names[:-1]
        columns = dict(zip(names, batch.columns, strict=False))
        gone = batch.column(len(names)).to_pylist()
        if any(gone):
            texts = columns["text"].to_pylist()
            sizes = columns["n_chars"].to_pylist() if "n_chars" in columns else None
            for k, own in enumerate(gone):
                if own:
                    own = set(own)
                    lines = texts[k].encode().split(b"\n")
                    texts[k] = b"\n".join(x for x in lines if not x.strip() or line_hash(x) not in own).decode()
                    if sizes is not None:
                        sizes[k] = len(texts[k])
            columns["text"] = pa.array(texts, columns["text"].type)
            if sizes is not None:
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
        yield pa.record_batch([columns[n] for n in names], names)


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, lines above the limit removed from ``text``.

    All columns are returned, whatever their names. Where ``docs`` has a whole-number n_chars it is set anew for shortened
    texts. Null and blank texts fail the base rules and go; rows that repeat id, text and host share their verdict.
    An empty table gives one. Very long texts come alone into a batch.
    """
    kept = _marked(docs).where("kept").groupBy(*KEY).agg(F.first("__gone").alias("gone"))
    met = docs.select(F.struct("*").alias("row"), *_keys()).join(kept, list(KEY))
    return met.select("row.*", F.col("gone").alias(apart(docs, "gone"))).mapInArrow(_without_lines, docs.schema)
