"""Substring dedup: windows of 35 words that start more than once, found by super-k-mer partitioning.

A window's *minimiser* is the smallest hash among its runs of ``MINIMISER`` words. Consecutive windows with one
minimiser are a super-k-mer: they travel as one packed string (their words, joined by one space) to the bucket that
the minimiser names, so equal windows always meet there. In a bucket the windows are sorted by a rolling hash, and
equal neighbours are compared byte by byte before they count.

Hot passages: a packed string that occurs twice or more within one slice of the input is settled there. Its places
are reported at once, and a single string, marked as repeated, goes to the bucket. What a bucket gets of a passage
thus grows with the number of slices and not with the number of its copies. The number of buckets follows the
bytes of the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.llm.shared import apart, packed
from offerweave.llm.words import buffers, mix, slices, windows, word_table

WINDOW = 35
MINIMISER = 6
BUCKET_BYTES = 3 << 20  # of input text; packed strings are about three times that
LEAST_BUCKETS = 16
NO_ID = -(1 << 63)

_PLACE = np.dtype([("id", "<i8"), ("hash", "<i8"), ("lo", "<i4"), ("n", "<i4"), ("size", "<i4"), ("twice", "u1")])
_RANGE = np.dtype([("id", "<i8"), ("hash", "<i8"), ("lo", "<i4"), ("hi", "<i4")])


def window_hashes(h: np.ndarray) -> np.ndarray:
    """A hash for each ``WINDOW`` consecutive words, by doubling."""
    if len(h) < WINDOW:
        return h[:0]
    p, q = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xCA5A826395121157)
    powers = {1: h}
    n = 1
    while 2 * n <= WINDOW:
        r = powers[n]
        powers[2 * n] = mix(r[: len(r) - n] * p + r[n:] * q)
        n *= 2
    total, done, count = None, 0, len(h) - WINDOW + 1
    for n in sorted(powers, reverse=True):
        if done + n <= WINDOW:
            part = powers[n][done : done + count]
            total = part if total is None else mix(total * p + part * q)
            done += n
    return total


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Smallest of each n consecutive values."""
    r, width = x, 1
    while 2 * width <= n:
        r = np.minimum(r[:-width], r[width:])
        width *= 2
    return np.minimum(r[: len(x) - n + 1], r[n - width :])


def _pack(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=5)
        for batch in slices(batches, "text"):
            ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, at = buffers(batch.column(2))
            start, stop, h, first = word_table(data, at)
            if len(h) < WINDOW:
                continue
            doc = np.repeat(np.arange(len(ids)), np.diff(first))
            least = _sliding_min(windows(h, MINIMISER), WINDOW - MINIMISER + 1)
            inside = doc[: len(least)] == doc[WINDOW - 1 :]
            # a super-k-mer begins where the minimiser or the text changes
            new = inside.copy()
            new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1] | (doc[1 : len(least)] != doc[: len(least) - 1])
            begin = np.flatnonzero(new)
            if not len(begin):
                continue
            n_inside = np.concatenate([[0], np.cumsum(inside)])
            edge = np.append(begin[1:], len(least))
            count = n_inside[edge] - n_inside[begin]  # windows outside any text lie after the last one
            last = begin + count + WINDOW - 2
            # all words, each followed by one space
            size = stop - start
            place = np.cumsum(size + 1) - size - 1
            joined = np.full(int(place[-1] + size[-1] + 1), 32, np.uint8)
            total = int(size.sum())
            step = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
            joined[np.repeat(place, size) + step] = data[np.repeat(start, size) + step]
            joined = joined.tobytes()
            lo, hi = place[begin], place[last] + size[last]
            bucket = (mix(least[begin]) % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows = np.zeros(len(begin), _PLACE)
            rows["id"], rows["hash"] = ids[doc[begin]], hashes[doc[begin]]
            rows["lo"], rows["n"], rows["size"] = begin - first[doc[begin]], count, hi - lo
            out_bucket, out_blob = [], []
            bounds = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) > 0, [True]]))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                seen: dict[bytes, int] = {}
                again: list[int] = []
                for k, x, y in zip(order[a:b].tolist(), lo[order[a:b]].tolist(), hi[order[a:b]].tolist(), strict=True):
                    if (k0 := seen.setdefault(joined[x:y], k)) != k:
                        again.append(k)
                        rows["twice"][k0] = 1
                kept = np.fromiter(seen.values(), np.int64, len(seen))
                direct = np.concatenate([np.array(again, np.int64), kept[rows["twice"][kept] == 1]])
                known = np.zeros(len(direct), _RANGE)
                for c in ("id", "hash", "lo"):
                    known[c] = rows[c][direct]
                known["hi"] = rows["lo"][direct] + rows["n"][direct] + WINDOW - 1
                head = np.array([len(kept), len(known)], "<i8").tobytes()
                out_bucket.append(int(bucket[order[a]]))
                out_blob.append(squeeze.compress(head + rows[kept].tobytes() + known.tobytes() + b" ".join(seen)))
            yield pa.record_batch([pa.array(out_bucket, pa.int64()), pa.array(out_blob, pa.binary())], ["bucket", "blob"])

    return run


def repeated(h: np.ndarray, known: np.ndarray, content) -> np.ndarray:
    """Which windows (by hash) occur twice or more, or as often as one that is known to; content(i) is the window."""
    order = np.argsort(h, kind="stable")
    same = np.concatenate([[False], h[order][1:] == h[order][:-1], [False]])
    out = known.copy()
    begins = np.flatnonzero(~same[:-1] & same[1:])
    ends = np.flatnonzero(same[:-1] & ~same[1:]) + 1
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        group = order[a:b].tolist()
        one = content(group[0])
        if all(content(k) == one for k in group[1:]):
            out[group] = True
        else:  # different windows with one hash
            by: dict[bytes, list[int]] = {}
            for k in group:
                by.setdefault(content(k), []).append(k)
            for own in by.values():
                if len(own) > 1 or known[own].any():
                    out[own] = True
    return out


def _count(table: pa.Table) -> pa.Table:
    """One bucket: the ranges of words (id, hash, lo, hi) that repeated windows cover."""
    expand = zstandard.ZstdDecompressor()
    rows, known, texts = [], [], []
    for blob in table.column("blob"):
        raw = expand.decompress(blob.as_buffer())
        n_rows, n_known = np.frombuffer(raw, "<i8", 2)
        rows.append(np.frombuffer(raw, _PLACE, n_rows, 16))
        known.append(np.frombuffer(raw, _RANGE, n_known, at := 16 + n_rows * _PLACE.itemsize))
        texts.append(raw[at + n_known * _RANGE.itemsize :])
    place, found = np.concatenate(rows), [np.concatenate(known)]
    text = b" ".join(texts)
    del rows, texts
    at = np.concatenate([[0], np.cumsum(place["size"].astype(np.int64) + 1)])
    at[-1] = len(text)
    start, stop, h, first = word_table(np.frombuffer(text, np.uint8), at)
    n = place["n"].astype(np.int64)
    offset = np.cumsum(n) - n
    own = np.repeat(np.arange(len(place)), n)
    at_word = np.arange(int(n.sum())) - offset[own] + first[own]
    begin, end = start[at_word], stop[at_word + WINDOW - 1]
    twice = repeated(window_hashes(h)[at_word], place["twice"][own] == 1, lambda i: text[begin[i] : end[i]])
    edge = np.concatenate([[True], (own[1:] != own[:-1]) | ~twice[:-1]])
    lo = np.flatnonzero(twice & edge)
    after = np.concatenate([(own[1:] != own[:-1]) | ~twice[1:], [True]])
    hi = np.flatnonzero(twice & after)
    made = np.zeros(len(lo), _RANGE)
    made["id"], made["hash"] = place["id"][own[lo]], place["hash"][own[lo]]
    made["lo"] = place["lo"][own[lo]] + lo - offset[own[lo]]
    made["hi"] = place["lo"][own[hi]] + hi - offset[own[hi]] + WINDOW
    made = np.concatenate([*found, made])
    return pa.table({c: pa.array(np.ascontiguousarray(made[c])) for c in ("id", "hash", "lo", "hi")})


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("hash"),
        F.col("text").cast("string").alias("text"),
    )


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(id, hash, ranges): per text with repeated windows, the word ranges [lo, hi) that they cover."""
    rows = _rows(docs)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))
    packed = rows.mapInArrow(_pack(n_buckets), "bucket long, blob binary")
    ranges = packed.groupBy("bucket").applyInArrow(_count, "id long, hash long, lo int, hi int")
    return ranges.groupBy("id", "hash").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))


def _keep_mask(n: int, ranges: list | None) -> np.ndarray:
    keep = np.ones(n, bool)
    for r in ranges or ():
        keep[r["lo"] : r["hi"]] = False
    return keep


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        data, at = buffers(batch.column(1))
        n_words, n_removed, sha = [], [], []
        for k, ranges in enumerate(batch.column(2).to_pylist()):
            own = data[at[k] : at[k + 1]].tobytes().split()
            n_words.append(len(own))
            keep = _keep_mask(len(own), ranges)
            n_removed.append(len(own) - int(keep.sum()))
            kept = own if keep.all() else [own[j] for j in np.flatnonzero(keep).tolist()]
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.record_batch(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def substring_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) per row of ``docs``.

    Null and empty texts have no words; texts of fewer than 35 words lose none. Rows that repeat a text of 35 words
    or more lose all words that windows cover, as each copy's windows start in the other too. Columns other than
    doc_id and text are not used.
    """
    ranges = repeated_ranges(docs)
    own = _rows(docs).withColumn("doc_id", F.when(F.col("id") != NO_ID, F.col("id")))
    met = own.join(ranges, ["id", "hash"], "left").select("doc_id", "text", "ranges")
    return met.mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose last column is their ranges: the same without it, ``text`` (and n_chars) made anew where it is set."""
    for batch in slices(batches, "text"):
        names = batch.schema.names[:-1]
        columns = dict(zip(names, batch.columns, strict=False))
        ranges = batch.column(len(names)).to_pylist()
        if any(ranges):
            data, at = buffers(columns["text"])
            start, _, _, first = word_table(data, at)
            texts = columns["text"].to_pylist()
            sizes = columns["n_chars"].to_pylist() if "n_chars" in columns else None
            for k, own in enumerate(ranges):
                if not own:
                    continue
                a, b = int(first[k]), int(first[k + 1])
                # a kept word goes with the white space after it
                bounds = np.concatenate([start[a:b], [at[k + 1]]])
                keep = np.ones(int(at[k + 1] - at[k]), bool)
                keep[int(bounds[0] - at[k]) :] = np.repeat(_keep_mask(b - a, own), np.diff(bounds))
                texts[k] = data[at[k] : at[k + 1]][keep].tobytes().decode()
                if sizes is not None:
                    sizes[k] = len(texts[k])
            columns["text"] = pa.array(texts, columns["text"].type)
            if sizes is not None:
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
        yield pa.record_batch([columns[n] for n in names], names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with all words cut from ``text`` that repeated windows cover; rows and columns stay as they are.

    A removed word goes with the white space after it. Where ``docs`` has a whole-number n_chars it is set anew for
    cut texts. Null, blank and short texts stay as they are; rows that repeat a long text lose all words that its
    windows cover. An empty table gives one. Other columns may have any names; very long texts come alone into a batch.
    """
    keyed = packed(docs, id=F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), hash=F.xxhash64(F.col("text").cast("string")))
    met = keyed.join(repeated_ranges(docs), ["id", "hash"], "left")
    return met.select("row.*", F.col("ranges").alias(apart(docs, "ranges"))).mapInArrow(_cut, docs.schema)
