"""Phrase collocations: multikey three-way quicksort of suffix pointers, routed by leading words.

1. A first pass counts words (partial sums per slice of texts) and, in arrays of fixed size, how many suffixes begin
   with the words of each hash slot, for two and for three leading words. Slots above a limit are hot.
2. A second pass cuts every suffix at ``LONGEST`` words, folds equal ones of a slice, and routes them to buckets by the
   hash of their two leading words; by three where those are hot, by all four where the three are. So no leading words,
   however frequent, gather in one bucket more than the limit and one row per slice and distinct window.
3. A bucket's task sorts pointers to its suffixes by multikey three-way quicksort: every partition that is still open
   is split around a pivot word at its depth, all of them in one round of array operations. The equal part has one
   more leading word in common and its size is that phrase's count; it goes on one word deeper until ``LONGEST``. A
   part smaller than the least frequency is abandoned at once, since no phrase in it can be frequent.
   Counts of hot leading words are parts of a count; Spark adds them up.
4. Cuts, scores and containment are joins of the frequent phrases with themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerweave.llm.shared import Scratch, stored
from offerweave.llm.words import SPACE, buffers, mix, slices, word_table

LONGEST = 4
SLICE = 8 << 20
BUCKET_BYTES = 16 << 20  # of text
LEAST_BUCKETS = 8
SLOTS = 1 << 16  # whatever the input: counts of each slot go out of every task
_LANE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: A-Z to a-z; what ends a piece to a line feed.
_MAP = np.arange(256, dtype=np.uint8)
_MAP[65:91] += 32
_MAP[[ord(c) for c in ".,;:!?\x0a\x0b\x0c\x0d"]] = 10


@dataclass(frozen=True)
class Mining:
    """Phrases of 2 to 4 words count as candidates from ``least`` occurrences on."""

    least: int = 30
    scale: int = 2_000_000
    absorbed: tuple[int, int] = (80, 100)  # a longer phrase with so large a part of the occurrences replaces a phrase
    top: int = 2000


def _segments(data: np.ndarray, a: int, b: int) -> Iterator[tuple[int, int, int]]:
    """(from, to, end of the words that follow) of a long text, cut between words."""
    while a < b:
        stop = min(a + SLICE, b)
        while stop < b and not SPACE[data[stop]]:
            out = np.flatnonzero(SPACE[data[stop : min(stop + 4096, b)]])
            stop += int(out[0]) if len(out) else min(4096, b - stop)
        more, end = 256, stop
        while stop < b:
            end = min(stop + more, b)
            inside = ~SPACE[data[stop:end]]
            begins = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
            if end == b or len(begins) >= LONGEST:
                end = b if len(begins) < LONGEST else stop + int(begins[LONGEST - 1])
                break
            more *= 4
        yield a, stop, end
        a = stop


@dataclass
class Words:
    """Words of some texts of one language: ids by first occurrence of their hash, hashes, and suffixes' lengths."""

    ids: np.ndarray  # of each word
    hashes: np.ndarray
    reach: np.ndarray  # words from here to the end of the piece, LONGEST at most; 0: belongs to the next segment
    names: list[bytes]  # of each id


def _exact_ids(h: np.ndarray, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """A number for each word; equal numbers mean equal words, whatever their hashes."""
    values, first, ids = np.unique(h, return_index=True, return_inverse=True)
    size = stop - start
    rep = first[ids]
    same = bool((size == size[rep]).all())
    if same:
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        same = bool((data[np.repeat(start, size) + step] == data[np.repeat(start[rep], size) + step]).all())
    if same:
        return ids, [data[a:b].tobytes() for a, b in zip(start[first].tolist(), stop[first].tolist(), strict=True)]
    known: dict[bytes, int] = {}
    made = [known.setdefault(data[a:b].tobytes(), len(known)) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
    return np.array(made), list(known)


def _table(data: np.ndarray, at: np.ndarray, own: int | None = None) -> Words | None:
    """Words of mapped bytes; of those that begin at ``own`` or later only what precedes them makes use."""
    start, stop, h, first = word_table(data, at)
    if not len(start):
        return None
    ends = np.cumsum(data == 10, dtype=np.int32)[start]
    piece = ends + np.repeat(np.arange(len(at) - 1), np.diff(first))  # a text ends a piece as well
    last = np.append(np.flatnonzero(np.diff(piece)), len(start) - 1)
    reach = np.minimum(last[np.searchsorted(last, np.arange(len(start)))] - np.arange(len(start)) + 1, LONGEST)
    if own is not None:
        reach[np.searchsorted(start, own) :] = 0
    ids, names = _exact_ids(h, data, start, stop)
    return Words(ids, h, reach, names)


def words_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """The words of rows (lang, text), a slice of texts at a time."""
    for batch in slices(batches, "text", SLICE):
        langs = np.array(batch.column(0).to_pylist(), object)
        for lang in dict.fromkeys(langs.tolist()):
            data, at = buffers(batch.column(1).filter(pa.array(langs == lang)))
            if not at[-1] - at[0]:
                continue
            if at[-1] - at[0] <= 2 * SLICE:
                found = [_table(_MAP[data[at[0] : at[-1]]], at - at[0])]
            else:  # one long text
                whole = _MAP[data[at[0] : at[-1]]]
                found = (_table(whole[a:end], np.array([0, end - a]), b - a) for a, b, end in _segments(whole, 0, len(whole)))
            for w in found:
                if w is not None:
                    yield lang, w


def _at(x: np.ndarray, n: int) -> np.ndarray:
    """x of the n-th word after each; the last ones repeat, which ``reach`` rules out."""
    return x[np.minimum(np.arange(len(x)) + n, len(x) - 1)]


def _routes(w: Words) -> list[np.ndarray]:
    """Hashes of the two, three and four leading words of each suffix."""
    out = [mix(w.hashes * _LANE[0] + _at(w.hashes, 1))]
    for n in range(2, LONGEST):
        out.append(mix(out[-1] * _LANE[1] + _at(w.hashes, n)))
    return out


def _slot(route: np.ndarray) -> np.ndarray:
    return (route % np.uint64(SLOTS)).astype(np.int64)


def _counts(depth: int, slot, lang: str | None, word, n: np.ndarray) -> pa.RecordBatch:
    k = len(n)
    columns = [pa.array(np.full(k, depth), pa.int32()), pa.array(slot, pa.int32()), pa.array([lang] * k, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())]
    return pa.record_batch(columns, ["depth", "slot", "lang", "word", "n"])


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, slot, lang, word, n): suffixes in each slot by 2 and 3 leading words; words (depth 1), and all (0)."""
    loads = {d: np.zeros(SLOTS, np.int64) for d in range(2, LONGEST)}
    for lang, w in words_by_language(batches):
        for d, route in zip(range(2, LONGEST), _routes(w), strict=False):
            loads[d] += np.bincount(_slot(route[w.reach >= d]), minlength=SLOTS)
        n = np.bincount(w.ids[w.reach > 0], minlength=len(w.names))
        there = np.flatnonzero(n)
        yield _counts(1, [None] * len(there), lang, [w.names[k].decode() for k in there.tolist()], n[there])
        yield _counts(0, [None], lang, [None], np.array([n.sum()]))
    for d, load in loads.items():
        there = np.flatnonzero(load)
        yield _counts(d, there, None, [None] * len(there), load[there])


def _pack(n_buckets: int, hot: dict[int, np.ndarray]):
    """Rows (bucket, lang, blob): folded windows, their counts, the depth of their route, and the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for lang, w in words_by_language(batches):
            begin = np.flatnonzero(w.reach >= 2)
            if not len(begin):
                continue
            window = np.zeros((LONGEST, len(begin)), np.uint32)
            for k in range(LONGEST):
                window[k] = np.where(w.reach[begin] > k, _at(w.ids, k)[begin] + 1, 0)
            wide = window.astype(np.uint64)
            high, low = wide[0] << np.uint64(32) | wide[1], wide[2] << np.uint64(32) | wide[3]
            order = np.lexsort((low, high))
            new = np.concatenate([[True], (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)])
            count = np.diff(np.append(np.flatnonzero(new), len(order)))
            one = order[new]
            routes = [r[begin[one]] for r in _routes(w)]
            depth = np.full(len(one), 2, np.uint8)
            for d in range(2, LONGEST):
                depth += ((depth == d) & hot[d][_slot(routes[d - 2])]).astype(np.uint8)
            # a suffix too short for its route is routed by what it has
            by = np.minimum(depth, w.reach[begin[one]]) - 2
            bucket = (np.choose(by, routes) >> np.uint64(20)) % np.uint64(n_buckets)
            deal = np.argsort(bucket.astype(np.int64), kind="stable")
            bounds = np.flatnonzero(np.concatenate([[True], np.diff(bucket[deal]) > 0, [True]]))
            buckets, blobs = [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                rows = deal[a:b]
                used, own = np.unique(window[:, one[rows]], return_inverse=True)
                own = own.reshape(LONGEST, -1)
                if used[0]:  # keep 0 for words that aren't there
                    used, own = np.concatenate([[0], used]), own + 1
                names = b"\n".join([w.names[k - 1] for k in used[1:].tolist()])
                head = np.array([b - a, len(names)], "<i8").tobytes()
                parts = [head, names, own.astype("<u4").tobytes(), count[rows].astype("<u4").tobytes(), depth[rows].tobytes()]
                buckets.append(int(bucket[rows[0]]))
                blobs.append(squeeze.compress(b"".join(parts)))
            yield pa.record_batch([pa.array(buckets, pa.int64()), pa.array([lang] * len(blobs), pa.string()), pa.array(blobs, pa.binary())], ["bucket", "lang", "blob"])

    return run


def three_way(window: np.ndarray, weight: np.ndarray, depth: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Multikey three-way quicksort of suffixes: (a suffix of each part, words in common, its weight), frequent ones.

    ``window[d]`` is each suffix's word at depth d, 0 beyond its end. A part whose leading words were routed deeper
    (``depth`` over the number of words) holds some of their occurrences only: it is told however small.
    """
    longest, n = window.shape
    flat = window.reshape(-1)
    order = np.arange(n)
    begin, at = np.zeros(min(n, 1), np.int64), np.zeros(min(n, 1), np.int64)
    while len(order):
        size = np.diff(np.append(begin, len(order)))
        part = np.repeat(np.arange(len(begin)), size)
        key = flat[order + at[part] * n]
        a, b, c = key[begin], key[begin + size // 2], key[begin + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[part]
        # 0, 1, 2: before, equal to, after the pivot; a stable deal within each part
        side = (key > pivot).astype(np.int8) + (key >= pivot)
        place = np.empty(len(order), np.int64)
        sizes = []
        room = begin.copy()
        for s in range(3):
            mine = side == s
            before = np.cumsum(mine)
            taken = np.diff(np.concatenate([[0], before[np.append(begin[1:], len(order)) - 1]]))
            start = np.concatenate([[0], before])[begin]
            place[mine] = (room - start)[part[mine]] + before[mine] - 1
            sizes.append(taken)
            room = room + taken
        dealt = np.empty_like(order)
        dealt[place] = order
        order = dealt
        # the parts in their new order, the empty ones left out
        n_parts = np.stack(sizes, 1).reshape(-1)
        starts = np.cumsum(n_parts) - n_parts
        equal = np.tile([False, True, False], len(begin))
        level = np.repeat(at, 3) + equal
        there = n_parts > 0
        starts, n_parts, equal, level = starts[there], n_parts[there], equal[there], level[there]
        total = np.add.reduceat(weight[order], starts)
        route = np.maximum.reduceat(depth[order], starts)
        ended = equal & (flat[order[starts] + (level - 1) * n] == 0)
        told = equal & ~ended & ((total >= least) | (route > level))
        for d in range(1, longest + 1):
            if (pick := told & (level == d)).any():
                yield order[starts[pick]], d, total[pick]
        # what can still hold a phrase of one more word
        open_ = ~ended & (level < longest) & ((total >= least) | (route > level + 1))
        keep = np.repeat(open_, n_parts)
        order = order[keep]
        begin, at = np.cumsum(n_parts[open_]) - n_parts[open_], level[open_]


def _sorted_bucket(least: int):
    def run(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor()
        langs = np.array(table.column("lang").to_pylist(), object)
        out: tuple[list, list, list, list] = ([], [], [], [])
        for lang in dict.fromkeys(langs.tolist()):
            known: dict[bytes, int] = {}
            windows, weights, depths = [], [], []
            for blob in table.column("blob").filter(pa.array(langs == lang)):
                raw = expand.decompress(blob.as_buffer())
                n, size = (int(x) for x in np.frombuffer(raw, "<i8", 2))
                ids = np.array([0, *[known.setdefault(x, len(known) + 1) for x in raw[16 : 16 + size].split(b"\n")]], np.uint32)
                at = 16 + size
                windows.append(ids[np.frombuffer(raw, "<u4", LONGEST * n, at)].reshape(LONGEST, n))
                weights.append(np.frombuffer(raw, "<u4", n, at := at + 4 * LONGEST * n))
                depths.append(np.frombuffer(raw, np.uint8, n, at + 4 * n))
            window = np.concatenate(windows, 1)
            weight, depth = np.concatenate(weights).astype(np.int64), np.concatenate(depths)
            del windows, weights, depths
            names = [x.decode() for x in known]
            for one, d, total in three_way(window, weight, depth, least):
                if d > 1:
                    out[0].extend([lang] * len(one))
                    out[1].extend(" ".join([names[k - 1] for k in ids]) for ids in window[:d, one].T.tolist())
                    out[2].extend([d] * len(one))
                    out[3].extend(total.tolist())
        return pa.table({"lang": pa.array(out[0], pa.string()), "phrase": pa.array(out[1], pa.string()), "words": pa.array(out[2], pa.int32()), "f": pa.array(out[3], pa.int64())})

    return run


def frequent_phrases(docs: DataFrame, least: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of 1 to 4 words with f >= least; (lang, n) of all languages."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).where("text <> ''")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    counted = scratch.stored(rows.mapInArrow(_first_pass, "depth int, slot int, lang string, word string, n long"), "words")
    loads = counted.where("depth > 1").groupBy("depth", "slot").agg(F.sum("n").alias("n"))
    limit = BUCKET_BYTES // 48  # an eighth of the words of a bucket
    hot = {d: np.zeros(SLOTS, bool) for d in range(2, LONGEST)}
    for r in loads.where(F.col("n") > limit).collect():  # at most twice as many rows as slots
        hot[r["depth"]][r["slot"]] = True
    packed = rows.mapInArrow(_pack(n_buckets, hot), "bucket long, lang string, blob binary")
    long = packed.groupBy("bucket").applyInArrow(_sorted_bucket(least), "lang string, phrase string, words int, f long")
    short = counted.where("depth = 1").select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), F.col("n").alias("f"))
    found = long.unionByName(short).groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    totals = counted.where("depth = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return scratch.stored(found, "phrases"), scratch.stored(totals, "totals")


def _part(first, last):
    return F.array_join(F.slice("list", first, last), " ")


def collocations(docs: DataFrame, mining: Mining = Mining()) -> DataFrame:  # noqa: B008
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of ``docs`` (text, lang; others are ignored).

    Null and empty texts have no words; a null lang is ``und``. Rows that repeat count as often as they come. A
    language without candidates has no row, nor has an empty table. Ties of score and a go by the phrase's bytes.
    Very long texts are read in segments; phrases across their borders count. Any names of further columns will do.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        phrases, totals = frequent_phrases(docs, mining.least, scratch)
        listed = phrases.where("words > 1").withColumn("list", F.split("phrase", " "))
        cuts = listed.select("lang", "phrase", F.col("f").alias("a"), "words", "list", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
        cuts = cuts.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
        side = lambda name, f: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
        cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
        wide = lambda c: c.cast("decimal(27,0)")
        cuts = cuts.withColumns({"over": wide(F.col("a")) * F.lit(mining.scale).cast("decimal(10,0)"), "under": wide(F.col("l")) + wide(F.col("r"))})
        cuts = cuts.withColumn("score", F.expr("cast(over as decimal(38,0)) div cast(under as decimal(38,0))"))
        lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        # a phrase two words longer has one between that is at least as frequent
        inner = listed.where("words > 2").select("lang", "f", F.explode(F.array(_part(F.lit(1), F.col("words") - 1), _part(F.lit(2), F.col("words") - 1))).alias("phrase"))
        longer = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
        num, den = mining.absorbed
        whole = F.coalesce(wide(F.col("longer")), F.lit(0)) * den >= wide(F.col("a")) * num
        kept = lowest.join(longer, ["lang", "phrase"], "left").where(~whole).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
        # first each part's best, then the best of those: no language is sorted in one task
        salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        kept = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= mining.top)
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= mining.top)
        best = kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        return stored(best, "collocations")


def oracle(mining: Mining = Mining()) -> str:  # noqa: B008
    """DuckDB SQL, by windows over words."""
    m = mining
    sizes = " UNION ALL ".join(f"SELECT lang, {" || ' ' || ".join(f'w{k}' for k in range(1, n + 1))} AS phrase, {n} AS words, count(*) AS f FROM v WHERE w{n} IS NOT NULL GROUP BY ALL" for n in range(1, LONGEST + 1))
    return rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, unnest(pieces) AS piece FROM t),
q AS (SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
u AS (SELECT id, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM q),
v AS (SELECT lang, w AS w1, {', '.join(f'lead(w, {k}) OVER o AS w{k + 1}' for k in range(1, LONGEST))} FROM u WINDOW o AS (PARTITION BY id ORDER BY i)),
g AS ({sizes}),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS ws FROM g WHERE words > 1 AND f >= {m.least}),
k AS (SELECT *, unnest(range(1, words)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r, CAST((CAST({m.scale} AS HUGEINT) * k.a) // (l.f + r.f) AS BIGINT) AS score FROM k
  JOIN g l ON l.lang = k.lang AND l.phrase = array_to_string(k.ws[1:k.k], ' ') JOIN g r ON r.lang = k.lang AND r.phrase = array_to_string(k.ws[k.k + 1:], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM s),
x AS (SELECT lang, words, a, ws, unnest(range(2, words)) AS m FROM c),
y AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, a FROM (SELECT *, unnest(range(1, words - m + 2)) AS i FROM x) z),
d AS (SELECT lang, phrase, max(a) AS longer FROM y GROUP BY ALL),
e AS (SELECT b.lang, b.phrase, a, l, r, score, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank FROM b LEFT JOIN d ON d.lang = b.lang AND d.phrase = b.phrase
  WHERE cut = 1 AND (longer IS NULL OR {m.absorbed[1]} * longer < {m.absorbed[0]} * a))
SELECT lang, rank, phrase, a, l, r, n, score FROM e JOIN n USING (lang) WHERE rank <= {m.top}"""
