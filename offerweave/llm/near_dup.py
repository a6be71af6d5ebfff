"""MinHash near-duplicates: bottom-k sketches, inverted lists, union-sketch estimates, exact Jaccard.

1. Each text becomes the set of its distinct 5-word shingles (64-bit hashes), its size, a digest of the set and
   its *bottom-k sketch*: the k smallest hashes of one hash function.
2. Texts of equal sets form a class; from here on only classes count, so exact copies cost nothing more.
3. The ``KEYS`` smallest retained values are inverted: each value lists the classes that retain it. Two sets of
   similarity s share none of them with probability (1 - s) ** KEYS, 2e-10 at 0.75.
4. First pass: in each list every class is paired with the list's smallest class only, however long the list.
   Pairs pass if their union sketch (the k smallest of both sketches) has enough values that both retain, and
   are links if the exact Jaccard of their full sets says so. Linked classes are merged.
5. Second pass: only lists that still hold classes of different components, and only pairs across components,
   since a pair within one adds nothing. Short lists give pairs; long ones are cut into blocks, and a task for
   each two blocks compares their sketches and verifies on full sets, joining components as it goes.
   Every pair that shares a value is thus either compared or already connected: no list is cut short.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerweave.llm.components import components
from offerweave.llm.shared import Scratch, packed, stored
from offerweave.llm.words import buffers, mix, slices, windows, word_table

SHINGLE = 5
SIMILAR = (75, 100)  # numerator and denominator
RETAINED = 64  # k of the sketch
KEYS = 16  # retained values that are inverted
LEAST_SHARED = 0.5  # part of the union sketch: 4.6 standard deviations below 0.75 at k = 64
SHORT_LIST = 64
BLOCK = 4096
SIDE = 1024  # rows of a block that are compared with as many at once


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; with fewer than 5 words the whole sequence is one."""
    data, at = buffers(column)
    _, _, h, first = word_table(data, at, lower=True)
    rolled = windows(h, SHINGLE)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            yield np.unique(rolled[a : b - SHINGLE + 1])
        elif b > a:
            yield mix(windows(h[a:b], b - a) + np.uint64(b - a))
        else:
            yield h[:0]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        size, digest, keys, sketch = [], [], [], []
        for s in shingle_sets(batch.column(2)):
            size.append(len(s))
            digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            keys.append(s[:KEYS].view(np.int64))
            sketch.append((s[:RETAINED] >> np.uint64(32)).astype(np.uint32).tobytes())
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate(keys)))
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), lists, pa.array(sketch, pa.binary())],
            ["doc_id", "text_hash", "n_shingles", "node", "keys", "sketch"],
        )


_SKETCH_SCHEMA = "doc_id long, text_hash long, n_shingles long, node binary, keys array<long>, sketch binary"


def likely(a: np.ndarray, b: np.ndarray) -> bool:
    """Do enough of the k smallest of both sketches belong to both?"""
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    k = min(RETAINED, max(len(a), len(b)))
    # the k-th smallest distinct value ends the union sketch
    distinct = np.cumsum(np.concatenate([[1], ~twice]))
    k = min(k, int(distinct[-1]))
    return int((twice & (distinct[1:] <= k)).sum()) >= LEAST_SHARED * k


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, sketch_a, sketch_b) to the pairs that are likely links."""
    for batch in batches:
        met = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        keep = [likely(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) for x, y in met]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact Jaccard of two sorted sets against the threshold."""
    both = np.concatenate([a, b])
    both.sort()
    inner = int((both[1:] == both[:-1]).sum())
    return SIMILAR[1] * inner >= SIMILAR[0] * (len(both) - inner)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, text_a, text_b) to the links among them."""
    for batch in slices(slices(batches, "text_a"), "text_b"):
        keep = [similar(x, y) for x, y in zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3)), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _compare_blocks(key: tuple, table: pa.Table) -> pa.Table:
    """All pairs across components within one list: block i against itself, or against block j."""
    table = table.sort_by("node")
    nodes, side = table.column("node").to_pylist(), np.array(table.column("block").to_pylist())
    sets = list(shingle_sets(table.column("text").combine_chunks()))
    parent: dict = {}

    def find(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    comp = table.column("root").to_pylist()
    low, high = int(side.min()), int(side.max())
    left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
    # incidence of the retained values that occur twice or more here, for counts of shared values by one product
    sketch = [s[:RETAINED] for s in sets]
    values, counts = np.unique(np.concatenate(sketch), return_counts=True)
    values = values[counts > 1]
    size = np.array([len(s) for s in sets])
    a_out, b_out = [], []

    def incidence(rows):
        m = np.zeros((len(rows), len(values)), np.float32)
        for k, r in enumerate(rows):
            m[k, np.searchsorted(values, sketch[r][np.isin(sketch[r], values, assume_unique=True)])] = 1
        return m

    step = max(1, min(SIDE, (8 << 20) // max(1, len(values))))
    for r0 in range(0, len(right), step):
        rows = right[r0 : r0 + step]
        there = incidence(rows)
        for l0 in range(0, len(left), step):
            cols = left[l0 : l0 + step]
            shared = (there if low == high and r0 == l0 else incidence(cols)) @ there.T
            # min of both sketch sizes bounds the union sketch from below; sizes must be near enough as well
            need = LEAST_SHARED * np.minimum(RETAINED, np.minimum(size[cols][:, None], size[rows][None, :]))
            near = SIMILAR[1] * np.minimum(size[cols][:, None], size[rows][None, :]) >= SIMILAR[0] * np.maximum(size[cols][:, None], size[rows][None, :])
            for i, j in zip(*np.nonzero((shared >= need) & near), strict=True):
                x, y = int(cols[i]), int(rows[j])
                if (low != high or x < y) and (cx := find(comp[x])) != (cy := find(comp[y])) and similar(sets[x], sets[y]):
                    parent[cx] = cy
                    a_out.append(nodes[x])
                    b_out.append(nodes[y])
    return pa.table({"a": pa.array(a_out, pa.binary()), "b": pa.array(b_out, pa.binary())})


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (class; null: empty set), root (component) and its least_id, per row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"))
    made = stored(rows.mapInArrow(_sketches, _SKETCH_SCHEMA), "sketches")
    with Scratch(docs.sparkSession) as scratch:
        label = stored(_labels(rows, made, scratch), "components")
    return made.select("doc_id", "text_hash", "n_shingles", "node").join(label, "node", "left")


def _labels(rows: DataFrame, made: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root, least_id) of every class."""
    classes = scratch.stored(
        made.where("node is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("doc_id", "text_hash")).alias("of"),
            F.first("keys").alias("keys"),
            F.first("sketch").alias("sketch"),
            F.first("n_shingles").alias("n"),
        ),
        "classes",
    )
    lists = classes.select("node", F.explode("keys").alias("value"))
    tops = lists.groupBy("value").agg(F.min("node").alias("top"), F.count("*").alias("members")).where("members > 1")
    lists = scratch.stored(lists.join(tops, "value"), "lists")  # values that several classes retain
    met = scratch.stored(classes.join(lists.select("node").distinct(), "node").select("node", "sketch", "n", "of"), "met")
    texts = _texts_of(rows, met, scratch)
    pairs = lists.where("node <> top").select(F.col("top").alias("a"), F.col("node").alias("b")).distinct()
    first = scratch.stored(_links(pairs, met, texts), "links1")
    found = _second_pass(first, lists, met, texts, scratch)
    roots = components(found, scratch)
    named = classes.select("node", "least_id").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least_id")
    ids = named.groupBy("root").agg(F.min("least_id").alias("least_id"))
    return named.select("node", "root").join(ids, "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text; other columns are ignored).

    Null and blank texts have empty sets and are linked with nothing: their component is their own doc_id. Rows
    of equal texts are linked (equal sets). A null doc_id counts only where a component has no other id; then
    the component is null, and ``kept`` is true for such rows. Repeated doc_ids are rows of their own.
    """
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("least_id"))
    return _grouped(docs).select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, one of each component: that of the smallest doc_id (null last), then of a text hash.

    Rows without words (null or blank texts) stay, all of them. Of rows that repeat both id and text one stays. An empty
    table gives one. Columns may have any names; very long texts come alone into a batch.
    """
    group = stored(_grouped(docs).select("doc_id", "text_hash", "node", "root"), "groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    chosen = group.where("node is not null").groupBy("root").agg(F.min(order).alias("c")).select("c.doc_id", "c.text_hash")
    chosen = chosen.withColumn("one", F.lit(True))
    empty = group.where("node is null").select("doc_id", "text_hash", F.lit(False).alias("one")).distinct()
    kept = chosen.unionByName(empty).withColumnsRenamed({"doc_id": "kept_id", "text_hash": "kept_hash"})
    keyed = packed(docs, id=F.col("doc_id").cast("long"), hash=F.xxhash64(F.col("text").cast("string")))
    met = keyed.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")))
    repeat = F.row_number().over(Window.partitionBy("id", "hash").orderBy(F.lit(0)))
    return met.withColumn("k", repeat).where("not one or k = 1").select("row.*")


def _texts_of(rows: DataFrame, met: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, text) of the classes that share a list with another: one text stands for its class."""
    of = met.select("node", F.col("of.doc_id").alias("of_id"), F.col("of.text_hash").alias("of_hash"))
    found = rows.join(of, (rows["text_hash"] == of["of_hash"]) & rows["doc_id"].eqNullSafe(of["of_id"])).select("node", "text")
    # rows that repeat id and text give the same text again; any one does
    return scratch.stored(found.groupBy("node").agg(F.first("text").alias("text")), "texts")


def _links(pairs: DataFrame, met: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) that pass the estimate and whose full sets are similar."""
    side = met.select("node", "sketch", "n")
    a = side.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"), F.col("n").alias("n_a"))
    b = side.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"), F.col("n").alias("n_b"))
    near_size = SIMILAR[1] * F.least("n_a", "n_b") >= SIMILAR[0] * F.greatest("n_a", "n_b")
    near = pairs.join(a, "a").join(b, "b").where(near_size).select("a", "b", "sketch_a", "sketch_b")
    near = near.mapInArrow(_estimate, "a binary, b binary")
    ta = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return near.join(ta, "a").join(tb, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a binary, b binary")


def _second_pass(first: DataFrame, lists: DataFrame, met: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """All links: those of the first pass, and those between its components within any one list."""
    roots = components(first, scratch)
    labelled = scratch.stored(lists.join(roots, "node", "left").select("value", "node", "members", F.coalesce("root", "node").alias("root")), "labelled")
    mixed = labelled.groupBy("value").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("value")
    members = scratch.stored(labelled.join(mixed, "value"), "members")
    short = members.where(F.col("members") <= SHORT_LIST)
    other = short.select("value", F.col("node").alias("b"), F.col("root").alias("root_b"))
    across = short.join(other, "value").where("node < b and root <> root_b").select(F.col("node").alias("a"), "b").distinct()
    more = _links(across, met, texts)
    long = members.where(F.col("members") > SHORT_LIST).withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    long = long.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = long.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("value", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "root")
    blocks = dealt.join(texts, "node").groupBy("value", "i", "j").applyInArrow(_compare_blocks, "a binary, b binary")
    return first.unionByName(scratch.stored(more, "links2")).unionByName(scratch.stored(blocks, "links3"))
