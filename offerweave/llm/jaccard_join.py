"""Exact Jaccard join of shingle sets, with block-skipping index lists and answers derived from similar sets' answers.

1. Each text becomes the set of its distinct 5-word shingles; texts of equal sets are one class from here on.
2. One order of all shingles, those of heavily loaded hash slots last. Two sets that reach the threshold share a
   shingle of their *prefixes*, the first n - ceil(t n) + 1 in that order, so only prefixes are inverted: a shingle's
   index list holds (class, size, position in its prefix), but for those that sizes and positions let meet no other.
3. Every list is read once in a sorted stream. Per size band its first class is *computed* against all others of
   the band: exact symmetric differences, and links where the threshold is met. Linked classes are one component.
   Lists that still hold several components are done once more with another first class.
4. What is left are pairs across components within a list. Lists are sorted by size and position and read in blocks:
   a block is skipped when its sizes or its best position rule out the overlap that is needed. Long lists are cut into
   blocks of bounded size, and each two that may meet are a task. Parity bitmaps, whose differing bits never
   exceed the symmetric difference, take out most of the rest.
5. One link joins two components, so of each two only a few pairs are told at first. Components for which more were left
   and that no link has joined are looked at again with sixteen times as many, until nothing is left out: no pair
   across the components of the result goes untested, and no list, partner or candidate is capped for good.
6. Answers are derived: classes x and y with leaders p and q, to which their differences are known, differ by at least
   |p^q| - |x^p| - |y^q| and by at most the sum. So |p^q| is computed once per pair of leaders, and only pairs between
   the two bounds are verified on their own sets.
7. Texts are not kept: each time pairs are verified, the input is read again, and a bitmap of the texts that are asked for
   lets hardly any other into the exchange.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerweave.llm.components import components
from offerweave.llm.near_dup import shingle_sets
from offerweave.llm.shared import Scratch, stored
from offerweave.llm.words import slices

NUM, DEN = 80, 100
SLOTS = 1 << 17  # whatever the input: a count of each slot goes out of every task
HOT = 2  # times the mean load
TASK = 1 << 18  # shingles of the input for each task that writes a table, where Spark would deal it to more
LEVEL_BITS = 58  # a token is the level of its slot above so many bits of its hash
LIST = 1 << 14  # entries of a list, or of a salted part of a hot one, that are read in one stream
BLOCK = 1 << 10  # entries of a long list's block
SHORT_LIST = 1 << 9
GROUP = 1 << 16  # entries of short lists in one task
NO_ID = -(2**63)  # stands for null where texts are looked up
SKIP = 64  # entries that are skipped or read together
TOLD = 16  # pairs of two components that are verified in the first round
WIDE = 256  # pairs that a component has at least before any of its pairs with another such one are put off
MORE = 16  # times as many in each further round
MAP_BITS = 1 << 15  # of one row of a bitmap, as bitmap_construct_agg makes them
SPARE_BITS = 16  # of a bitmap for each text that is asked for: about a sixteenth of the others pass
MOST_BITS = 1 << 27  # of a whole bitmap, 16 MB; with more than 8 million texts asked for, more of the others pass


def needed(nx, ny):
    """Least overlap of two sets of these sizes that reach the threshold."""
    return -(-NUM * (nx + ny) // (NUM + DEN))


def prefix_length(n: int) -> int:
    return n + 1 + -(NUM * n // DEN) - (NUM * n % DEN > 0)


def parity(s: np.ndarray) -> bytes:
    """One bit or more per element; bit i is the parity of the elements that fall on it."""
    bits = 1 << max(6, (len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(bool), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference; the longer bitmap is folded onto the shorter."""
    if len(a) < len(b):
        a, b = b, a
    x = int.from_bytes(a, "little")
    size = 8 * len(a)
    while size > 8 * len(b):
        size //= 2
        x = (x >> size) ^ (x & ((1 << size) - 1))
    return (x ^ int.from_bytes(b, "little")).bit_count()


# --- sets and prefixes -----------------------------------------------------------------------------------------------
def _loads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, np.int64)
    for batch in slices(batches, "text"):
        every = np.concatenate(list(shingle_sets(batch.column(0))))
        total += np.bincount((every % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
    there = np.flatnonzero(total)
    yield pa.record_batch([pa.array(there, pa.int32()), pa.array(total[there])], ["slot", "n"])


def slot_levels(rows: DataFrame) -> tuple[np.ndarray, float]:
    """How many times over the mean load each slot is, as a power of two (0: not hot), and the mean."""
    loads = rows.select("text").mapInArrow(_loads, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    level = np.zeros(SLOTS, np.uint8)
    with Scratch(rows.sparkSession, _parallel(rows.sparkSession)) as scratch:  # never more than SLOTS rows
        loads = scratch.stored(loads, "loads")
        mean = max(1.0, (loads.agg(F.sum("n")).first()[0] or 0) / SLOTS)
        for r in loads.where(F.col("n") > HOT * mean).collect():  # fewer than half of the slots
            level[r["slot"]] = min(31, int(math.log2(r["n"] / mean)))
    return level, mean


def _parallel(spark: SparkSession) -> int:
    return 2 * spark.sparkContext.defaultParallelism


def tasks_for(spark: SparkSession, shingles: float) -> int:
    """Tasks that write a table made from so many shingles: the rest of them would have next to nothing to do."""
    return max(_parallel(spark), math.ceil(shingles / TASK))


def tokens(s: np.ndarray, level: np.ndarray) -> np.ndarray:
    """A set's prefix, in order, as numbers that sort in that order."""
    slot = (s % np.uint64(len(level))).astype(np.int64)
    token = level[slot].astype(np.uint64) << np.uint64(LEVEL_BITS) | s >> np.uint64(64 - LEVEL_BITS)
    token.sort()
    return token[: prefix_length(len(s))].view(np.int64)


_SETS = "doc_id long, text_hash long, n_shingles long, node binary, prefix array<long>, bits binary"


def _sets(level: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            size, digest, prefix, bits = [], [], [], []
            for s in shingle_sets(batch.column(2)):
                size.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                prefix.append(tokens(s, level) if len(s) else s.view(np.int64))
                bits.append(parity(s) if len(s) else None)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, prefix)]), pa.int32()), pa.array(np.concatenate(prefix)))
            columns = [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), lists, pa.array(bits, pa.binary())]
            yield pa.record_batch(columns, ["doc_id", "text_hash", "n_shingles", "node", "prefix", "bits"])

    return run


# --- lists -----------------------------------------------------------------------------------------------------------
def may_meet(n_a, left_a, n_b, left_b):
    """Can sets of these sizes, with so many shingles from the shared one on, reach the threshold?"""
    least = np.minimum(n_a, n_b)
    return (DEN * least >= NUM * np.maximum(n_a, n_b)) & (np.minimum(left_a, left_b) >= needed(n_a, n_b))


def _streamed(salts: list[int]):
    """Sorted entries to those of lists with two or more, each with the first of its size band if the two may meet."""
    of = np.array(salts)
    several = of > 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, told = None, True  # the first entry of the band that is open, and whether it went out
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([batch.column(k).to_numpy() for k in range(3)])
            if carried is not None:
                x = np.concatenate([carried[:, None], x], 1)
            token, c, n, pos = x[0], x[1], x[2] >> 32, x[2] & 0xFFFFFFFF
            salt, band = c % of[token >> LEVEL_BITS], bands(n)
            new = np.concatenate([[True], (np.diff(token) != 0) | (np.diff(salt) != 0)])
            group = np.cumsum(new) - 1
            size = np.bincount(group)
            first = np.maximum.accumulate(np.where(new | np.concatenate([[True], np.diff(band) != 0]), np.arange(len(token)), 0))
            out = (size[group] > 1) | several[token >> LEVEL_BITS]
            if carried is not None:
                out[0] &= not told
                told = told and first[-1] == 0
            else:
                told = False
            told = bool(told or out[first[-1]])
            carried = x[:, first[-1]].copy()
            lead = (first != np.arange(len(token))) & may_meet(n, n - pos, n[first], (n - pos)[first])
            columns = [pa.array(token[out]), pa.array(band[out], pa.int32()), pa.array(c[out]), pa.array(n[out]), pa.array(pos[out]), pa.array(c[first][out], mask=~lead[out])]
            yield pa.record_batch(columns, ["token", "band", "c", "n", "pos", "lead"])

    return run


def partnered(token: np.ndarray, n: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Which entries, in order of token and size, may meet another of their list; lists over SHORT_LIST stay whole."""
    new = np.concatenate([[True], np.diff(token) != 0])
    size = np.bincount(np.cumsum(new) - 1)
    end = np.repeat(np.cumsum(size), size)
    keep = np.repeat(size > SHORT_LIST, size)
    i, ahead = np.flatnonzero(~keep), 1
    while len(i := i[i + ahead < end[i]]):
        i = i[DEN * n[i] >= NUM * n[i + ahead]]  # sizes only grow further on
        met = i[may_meet(n[i], left[i], n[i + ahead], left[i + ahead])]
        keep[met] = keep[met + ahead] = True
        ahead += 1
    return keep


def _meeting(salts: list[int]):
    """Entries as _streamed gives them to those that may meet another of their list; salted lists stay whole."""
    several = np.array(salts) > 1

    def met(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if table.num_rows:
            token, n, pos = (table.column(k).to_numpy() for k in ("token", "n", "pos"))
            yield from table.filter(pa.array(partnered(token, n, n - pos) | several[token >> LEVEL_BITS])).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the list that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            token = batch.column(0).to_numpy()
            if held and token[0] != held[0].column(0)[0].as_py():
                yield from met(pa.Table.from_batches(held))
                held = []
            last = len(token) if several[token[-1] >> LEVEL_BITS] else int(np.searchsorted(token, token[-1]))
            if last:
                yield from met(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            if last < len(token):
                held.append(batch.slice(last))
        if held:
            yield from met(pa.Table.from_batches(held))

    return run


#: Sets of sizes near enough to be linked are in one band or in neighbouring ones.
BANDS = [math.ceil((DEN / NUM) ** k) for k in range(1, 100)]


def bands(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(BANDS, n, "right")


def index_lists(classes: DataFrame, mean: float) -> DataFrame:
    """(token, band, c, n, pos, lead) of every list with two classes or more, without classes that may meet no other there."""
    salts = [max(1, int(mean * 2**k / LIST)) if k else 1 for k in range(32)]
    entries = classes.select("c", "n", F.posexplode("prefix").alias("pos", "token"))
    # size and position in one number, and sorted by it: of each band the smallest class comes first
    entries = entries.select("token", "c", (F.shiftleft(F.col("n"), 32) + F.col("pos")).alias("at"))
    dealt = F.element_at(F.array(*[F.lit(s) for s in salts]), F.shiftright("token", LEVEL_BITS).cast("int") + 1)
    salt = F.col("c") % dealt
    n_parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = entries.repartition(n_parts, F.col("token"), salt).sortWithinPartitions(F.col("token"), salt, F.shiftright("at", 32), F.col("c"))
    streamed, meeting = _streamed(salts), _meeting(salts)
    return entries.mapInArrow(lambda batches: meeting(streamed(batches)), "token long, band int, c long, n long, pos long, lead long")


# --- pairs -----------------------------------------------------------------------------------------------------------
def _reach(n_a: int, n_b: int) -> int:
    """The largest symmetric difference of linked sets of these sizes."""
    return n_a + n_b - 2 * needed(n_a, n_b)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, n_a, bits_a, n_b, bits_b) to the pairs that bitmaps don't rule out."""
    for batch in batches:
        met = zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True)
        keep = [differing(x, y) <= _reach(m, n) for m, x, n, y in met]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def likely(pairs: DataFrame, slim: DataFrame) -> DataFrame:
    side = lambda s: slim.select(F.col("c").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "bits_a", "n_b", "bits_b")
    return met.mapInArrow(_likely, "a long, b long")


def _text_key(doc_id: Column, text_hash: Column) -> list[Column]:
    return [F.coalesce(doc_id, F.lit(NO_ID)).alias("id"), text_hash.alias("text_hash")]


def asked_rows(rows: DataFrame, of: DataFrame) -> DataFrame:
    """Rows (id, text_hash, text): those whose id and text_hash are in ``of``, and a few others, without an exchange of rows."""
    bits = min(MOST_BITS, max(MAP_BITS, 1 << (SPARE_BITS * of.count()).bit_length()))
    at = F.pmod(F.xxhash64("id", "text_hash"), F.lit(bits))
    set_ = of.select(at.alias("at")).groupBy(F.floor(F.col("at") / MAP_BITS).alias("part")).agg(F.bitmap_construct_agg(F.pmod("at", F.lit(MAP_BITS))).alias("map"))
    place = F.pmod("at", F.lit(MAP_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring("map", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    told = (F.col("part") == F.floor(F.col("at") / MAP_BITS)) & (F.getbit(byte, place.bitwiseAND(7)) == 1)
    return rows.withColumn("at", at).join(F.broadcast(set_), told, "left_semi").drop("at")


def texts_of(asked: DataFrame, rows: DataFrame, slim: DataFrame, scratch: Scratch) -> DataFrame:
    """(c, text) of the classes in ``asked`` (c, repeated or not)."""
    of = slim.join(asked.distinct(), "c", "left_semi").select("c", *_text_key(F.col("of.doc_id"), F.col("of.text_hash")))
    of = scratch.stored(of, "asked")
    # rows that repeat id and text give the same text again; any one does, and no further exchange is needed
    texts = asked_rows(rows.select(*_text_key(F.col("doc_id"), F.col("text_hash")), "text"), of).join(of, ["id", "text_hash"])
    return scratch.stored(texts.groupBy("id", "text_hash").agg(F.first("c").alias("c"), F.first("text").alias("text")).select("c", "text"), "texts")


def _ends(pairs: DataFrame, *names: str) -> DataFrame:
    return pairs.select(F.explode(F.array(*names)).alias("c"))


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, text_a, text_b) to (a, b, n_a, n_b, delta): sizes, and the exact symmetric difference."""
    for batch in slices(slices(batches, "text_a"), "text_b"):
        sides = []
        for name in "ab":
            ids = batch.column(name).to_numpy()
            _, first, own = np.unique(ids, return_index=True, return_inverse=True)  # a text in many pairs is read once
            sets = list(shingle_sets(batch.column(f"text_{name}").take(pa.array(first))))
            sides.append([sets[k] for k in own.tolist()])
        n_a, n_b, delta = [], [], []
        for x, y in zip(*sides, strict=True):
            both = np.concatenate([x, y])
            both.sort()
            n_a.append(len(x))
            n_b.append(len(y))
            delta.append(len(both) - 2 * int((both[1:] == both[:-1]).sum()))
        yield pa.record_batch([batch.column("a"), batch.column("b"), *[pa.array(v, pa.int64()) for v in (n_a, n_b, delta)]], ["a", "b", "n_a", "n_b", "delta"])


def differences(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    side = lambda s: texts.select(F.col("c").alias(s), F.col("text").alias(f"text_{s}"))
    met = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return met.mapInArrow(_differences, "a long, b long, n_a long, n_b long, delta long")


def _allowed() -> Column:
    """The largest symmetric difference of a link, from n_a and n_b."""
    total = F.col("n_a") + F.col("n_b")
    return total - 2 * F.ceil(NUM * total / F.lit(NUM + DEN)).cast("long")


def _linked(found: DataFrame) -> DataFrame:
    return found.where(F.col("delta") <= _allowed()).select("a", "b", "delta")


def verified(pairs: DataFrame, rows: DataFrame, slim: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The links among ``pairs``; what is needed only to find them goes at once."""
    with Scratch(rows.sparkSession, scratch.tasks) as own:
        pairs = own.stored(likely(pairs, slim), "likely")
        return scratch.stored(_linked(differences(pairs, texts_of(_ends(pairs, "a", "b"), rows, slim, own))), name)


# --- block skipping --------------------------------------------------------------------------------------------------
def skip_join(n: np.ndarray, pos: np.ndarray, root: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one list's entries, sorted by size, that size and position leave: across roots and, if told, sides."""
    left = n - pos
    starts = np.arange(0, len(n), SKIP)
    low, best = n[starts], np.maximum.reduceat(left, starts) if len(n) else n
    high = n[np.append(starts[1:], len(n)) - 1] if len(n) else n
    one = np.array([(root[a : a + SKIP] == root[a]).all() for a in starts.tolist()], bool)
    for i, a in enumerate(starts.tolist()):
        p = slice(a, min(a + SKIP, len(n)))
        # blocks from this one on whose sizes, positions and roots leave anything
        j = np.arange(i, len(starts))
        open_ = (DEN * high[i] >= NUM * low[j]) & (np.minimum(best[i], best[j]) >= needed(low[i], low[j]))
        open_ &= ~(one[i] & one[j] & (root[a] == root[starts[j]]))
        for b in starts[j[open_]].tolist():
            q = slice(b, min(b + SKIP, len(n)))
            meet = may_meet(n[p][:, None], left[p][:, None], n[q][None, :], left[q][None, :])
            meet &= (root[p][:, None] != root[q][None, :]) & ((side[p][:, None] != side[q][None, :]) | (side[p][:, None] == 2))
            x, y = np.nonzero(np.triu(meet, 1) if a == b else meet)
            if len(x):
                yield x + a, y + b


_TOLD = "a long, b long, r long, s long, margin long, more boolean, wide_r boolean, wide_s boolean"


def _skipping(table: pa.Table, told: int, wide: int) -> pa.Table:
    """Entries (token, c, n, pos, root, side, bits) of whole short lists, or of two blocks of a long one, to pairs.

    Of components r and s at most ``told`` pairs come out; ``more`` says that others were left out. Pairs of two
    components that both have ``wide`` pairs here are left out as well, and ``wide_r`` and ``wide_s`` say of which.
    """
    table = table.sort_by([("token", "ascending"), ("n", "ascending"), ("pos", "ascending")])
    token, c, n, pos, root, side = (table.column(k).to_numpy() for k in ("token", "c", "n", "pos", "root", "side"))
    bits = table.column("bits")
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    failed: set[tuple[int, int]] = set()
    between: Counter[tuple[int, int]] = Counter()
    of: Counter[int] = Counter()
    more: set[tuple[int, int]] = set()
    full: set[int] = set()
    edge = np.flatnonzero(np.concatenate([[True], np.diff(token) != 0, [True]]))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        for x, y in skip_join(n[a:b], pos[a:b], root[a:b], side[a:b]):
            for i, j in zip((x + a).tolist(), (y + a).tolist(), strict=True):
                pair = (int(min(c[i], c[j])), int(max(c[i], c[j])))
                if pair in found or pair in failed:
                    continue
                r, s = ends = (int(min(root[i], root[j])), int(max(root[i], root[j])))
                if between[ends] >= told:
                    more.add(ends)
                elif of[r] >= wide and of[s] >= wide:
                    full.update(ends)
                elif (margin := differing(bits[i].as_py(), bits[j].as_py()) - _reach(int(n[i]), int(n[j]))) <= 0:
                    found[pair] = (r, s, margin)
                    between[ends] += 1
                    of.update(ends)
                else:
                    failed.add(pair)
                    if len(failed) > 1 << 20:
                        failed.clear()
    rows = [(*pair, r, s, margin, (r, s) in more, r in full, s in full) for pair, (r, s, margin) in found.items()]
    names = [c.split()[0] for c in _TOLD.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 3
    return pa.table([pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)], names)


def _mixed(lists: DataFrame, roots: DataFrame, scratch: Scratch, open_: DataFrame | None = None) -> DataFrame:
    """Entries, with root, of the lists that hold several components (of those in ``open_``), and how many each list has."""
    labelled = scratch.stored(lists.join(roots.select(F.col("node").alias("c"), "root"), "c", "left").select("token", "band", "c", "n", "pos", F.coalesce("root", "c").alias("root")), "labelled")
    if open_ is not None:
        labelled = scratch.stored(labelled.join(open_, "root", "left_semi"), "open")
    several = labelled.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("members"))
    several = scratch.stored(several.where("r0 <> r1").select("token", "members"), "mixed")
    return scratch.stored(labelled.join(several, "token"), "members")


def _across(members: DataFrame, slim: DataFrame, told: int, wide: int, scratch: Scratch) -> DataFrame:
    """Pairs across components in one list that sizes, positions and bitmaps leave, with their rank among those of the same two components.

    Where pairs were left out, ``more`` says so of the two components, and ``wide_r`` and ``wide_s`` of one.
    """
    members = members.join(slim.select("c", "bits"), "c")
    columns = ["token", "c", "n", "pos", "root", "side", "bits"]
    short = members.where(F.col("members") <= SHORT_LIST).withColumn("side", F.lit(2))
    groups = max(1, -(-members.where(F.col("members") <= SHORT_LIST).count() // GROUP))
    pairs = short.groupBy(F.pmod(F.xxhash64("token"), F.lit(groups)).alias("g")).applyInArrow(lambda t: _skipping(t.select(columns), told, wide), _TOLD)
    # a long list's blocks: size band, then components together, so that a block of one component is never compared with its like
    long = members.where(F.col("members") > SHORT_LIST).withColumn("sub", F.pmod(F.xxhash64("root"), F.ceil(F.col("members") / BLOCK)).cast("int"))
    sizes = scratch.stored(long.groupBy("token", "band", "sub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks")), "sizes")
    long = long.join(sizes, ["token", "band", "sub"]).withColumn("block", F.struct("band", "sub", F.pmod(F.xxhash64("c"), F.col("chunks")).cast("int").alias("chunk")))
    long = scratch.stored(long.select("token", "block", "c", "n", "pos", "root", "bits"), "blocks")
    seen = long.groupBy("token", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("pos")).alias("best"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    seen = scratch.stored(seen, "skips")
    side = lambda s: seen.select("token", *[F.col(x).alias(f"{x}_{s}") for x in ("block", "low", "high", "best", "r0", "r1")])
    least = F.ceil(NUM * (F.col("low_i") + F.col("low_j")) / F.lit(NUM + DEN))
    met = side("i").join(side("j"), "token").where("block_i <= block_j and not (r0_i = r1_i and r0_j = r1_j and r0_i = r0_j)")
    met = met.where((DEN * F.col("high_i") >= NUM * F.col("low_j")) & (DEN * F.col("high_j") >= NUM * F.col("low_i")) & (F.least("best_i", "best_j") >= least))
    met = met.select("token", "block_i", "block_j")
    same = F.col("block_i") == F.col("block_j")
    dealt = met.select("token", "block_i", "block_j", F.explode(F.when(same, F.array(F.struct(F.col("block_i").alias("block"), F.lit(2).alias("side")))).otherwise(F.array(F.struct(F.col("block_i").alias("block"), F.lit(0).alias("side")), F.struct(F.col("block_j").alias("block"), F.lit(1).alias("side"))))).alias("e"))
    dealt = dealt.select("token", "block_i", "block_j", F.col("e.block").alias("block"), F.col("e.side").alias("side"))
    rows = dealt.join(long, ["token", "block"])
    more = rows.groupBy("token", "block_i", "block_j").applyInArrow(lambda t: _skipping(t.select(columns), told, wide), _TOLD)
    found = scratch.stored(pairs, "short").unionByName(scratch.stored(more, "long"))
    once = found.groupBy("r", "s", "a", "b").agg(F.min("margin").alias("margin"), *[F.max(x).alias(x) for x in ("more", "wide_r", "wide_s")])
    two = Window.partitionBy("r", "s")
    rank = F.row_number().over(two.orderBy("margin", "a", "b"))
    out = once.select("r", "s", "a", "b", "wide_r", "wide_s", rank.alias("rank"), (F.max("more").over(two) | (F.count("*").over(two) > told)).alias("more"))
    return scratch.stored(out, "told")


def leaders(links: DataFrame, slim: DataFrame) -> DataFrame:
    """(c, n, lead, d): each class with its leader, itself if it has none, and their difference."""
    # the leader of a class: the one it was linked with that differs least
    nearest = links.groupBy("b").agg(F.min(F.struct("delta", "a")).alias("x")).select(F.col("b").alias("c"), F.col("x.a").alias("lead"), F.col("x.delta").alias("d"))
    return slim.select("c", "n").join(nearest, "c", "left").select("c", "n", F.coalesce("lead", "c").alias("lead"), F.coalesce("d", F.lit(0)).alias("d"))


def derived_links(pairs: DataFrame, known: DataFrame, rows: DataFrame, slim: DataFrame, scratch: Scratch) -> DataFrame:
    """The links (a, b) among ``pairs``: by their leaders' difference where it decides, else by their own."""
    side = lambda s: known.select(F.col("c").alias(s), *[F.col(x).alias(f"{x}_{s}") for x in ("n", "lead", "d")])
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    with Scratch(rows.sparkSession, scratch.tasks) as own:
        met = own.stored(met.withColumns({"p": F.least("lead_a", "lead_b"), "q": F.greatest("lead_a", "lead_b")}), "led")
        texts = texts_of(_ends(met, "a", "b", "p", "q"), rows, slim, own)
        leads = own.stored(differences(met.select(F.col("p").alias("a"), F.col("q").alias("b")).distinct(), texts), "answers")
        both = met.join(leads.select(F.col("a").alias("p"), F.col("b").alias("q"), "delta"), ["p", "q"])
        spread = F.col("d_a") + F.col("d_b")
        verdict = F.when(F.col("delta") + spread <= _allowed(), "link").when(F.col("delta") - spread > _allowed(), "none").otherwise("open")
        both = own.stored(both.select("a", "b", verdict.alias("verdict")).where("verdict <> 'none'"), "verdicts")
        own_links = own.stored(_linked(differences(both.where("verdict = 'open'"), texts)), "verified")
        return scratch.stored(both.where("verdict = 'link'").select("a", "b").unionByName(own_links.select("a", "b")), "links3")


# --- the join --------------------------------------------------------------------------------------------------------
def _all_roots(rows: DataFrame, classes: DataFrame, lists: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every class that is linked with another; links that are found later only join what is known by then."""
    slim = scratch.stored(classes.select("c", "n", "bits", "of").join(lists.select("c").distinct(), "c"), "slim")
    pairs = lists.where("lead is not null").select(F.least("lead", "c").alias("a"), F.greatest("lead", "c").alias("b")).distinct()
    links = verified(pairs, rows, slim, scratch, "links1")
    roots = components(links, scratch)
    members = _mixed(lists, roots, scratch)
    # once more with another class of each list and band, for those that the first one missed
    first = members.groupBy("token", "band").agg(F.min_by(F.struct("c", "n", "pos", "root"), F.xxhash64("c", "token")).alias("p"))
    again = members.join(scratch.stored(first, "firsts"), ["token", "band"]).where("root <> p.root")
    big, small = F.greatest(F.col("n"), F.col("p.n")), F.least(F.col("n"), F.col("p.n"))
    left = F.least(F.col("n") - F.col("pos"), F.col("p.n") - F.col("p.pos"))
    again = again.where((DEN * small >= NUM * big) & (left >= F.ceil(NUM * (big + small) / F.lit(NUM + DEN))))
    again = again.select(F.least("c", "p.c").alias("a"), F.greatest("c", "p.c").alias("b")).distinct()
    more = verified(again, rows, slim, scratch, "links2")
    roots = components(more, scratch, roots)
    members = _mixed(lists, roots, scratch)
    known = scratch.stored(leaders(links.unionByName(more), slim), "leads")
    told, wide = TOLD, WIDE
    while True:
        met = _across(members, slim, told, wide, scratch)
        first = met.where(F.col("rank") <= told)
        new = derived_links(first.select("a", "b"), known, rows, slim, scratch)
        roots = components(new, scratch, roots)
        left = _undecided(met, first.join(new, ["a", "b"]), scratch)
        if not left.limit(1).count():
            return roots
        # a component that is open stays open as what it has become
        open_ = left.join(roots.select(F.col("node").alias("r"), "root"), "r", "left").select(F.coalesce("root", "r").alias("root")).distinct()
        members = _mixed(members.drop("root", "members"), roots, scratch, open_)
        told, wide = told * MORE, wide * MORE


def _undecided(met: DataFrame, linked: DataFrame, scratch: Scratch) -> DataFrame:
    """Components (r) some of whose pairs were left out, but for those left out between two that are linked now."""
    pairs = met.where("more").select("r", "s").distinct().join(linked.select("r", "s").distinct(), ["r", "s"], "left_anti")
    wide = met.where("wide_r").select("r").unionByName(met.where("wide_s").select(F.col("s").alias("r")))
    return scratch.stored(pairs.select("r").unionByName(pairs.select(F.col("s").alias("r"))).unionByName(wide).distinct(), "undecided")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id, text; other columns are ignored).

    Two rows are linked when 100 * intersection >= 80 * union of their sets of distinct 5-word shingles of lower-cased
    (A-Z) words; a text of fewer words is one shingle. Null and blank texts have empty sets and are linked with nothing:
    their component is their own doc_id. Equal texts are linked. A null doc_id counts only where a component has no
    other; repeated doc_ids are rows of their own. Very long texts come alone into a batch. An empty table gives none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"))
    level, mean = slot_levels(rows)
    tasks = tasks_for(docs.sparkSession, mean * SLOTS)
    with Scratch(docs.sparkSession, tasks) as scratch:
        with Scratch(docs.sparkSession, tasks) as early:  # tables with prefixes go as soon as the lists are made
            sets = early.stored(rows.mapInArrow(_sets(level), _SETS), "sets")
            made = scratch.stored(sets.select("doc_id", "n_shingles", "node"), "rows")
            classes = sets.where("node is not null").groupBy("node").agg(
                F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_hash")).alias("of"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"), F.first("n_shingles").alias("n")
            )
            classes = early.stored(classes.withColumn("c", F.monotonically_increasing_id()), "prefixes")
            lists = scratch.stored(index_lists(classes, mean), "lists")
            classes = scratch.stored(classes.drop("prefix"), "classes")
        roots = _all_roots(rows, classes, lists, scratch)
        named = classes.select("c", "node", "least_id").join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
        ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
        label = scratch.stored(named.join(ids, "root").select("node", "component_id"), "labels")
        own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
        out = made.select("doc_id", "n_shingles", "node").join(label, "node", "left").select("doc_id", "n_shingles", own)
        return stored(out.coalesce(tasks), "jaccard")
