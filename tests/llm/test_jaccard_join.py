"""The Jaccard join against brute force: random sets, hot shingles, long lists in blocks, chains, awkward tables."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from offerweave.llm import jaccard_join, queries, shared
from offerweave.llm.components import components
from offerweave.llm.jaccard_join import differing, may_meet, needed, parity, prefix_length
from offerweave.llm.shared import Scratch
from tests.llm.test_llm import SCHEMA, awkward, found

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset([tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else []))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    lists = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            lists[x].append(k)
    for k, s in enumerate(sets):
        for j, inner in Counter(j for x in s for j in lists[x] if j < k).items():
            if 100 * inner >= 80 * (len(s) + len(sets[j]) - inner):
                parent[find(k)] = find(j)
    least: dict = {}
    for k, (doc_id, _) in enumerate(rows):
        r = find(k)
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    return sorted(((d, len(sets[k]), least.get(find(k)) if sets[k] else d) for k, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(found(df), key=str)


def family(draw, base, n, part):
    """Copies of a word list with some words changed."""
    return [" ".join(w if draw.random() > part else f"x{draw.randrange(10**6)}" for w in base) for _ in range(n)]


def random_rows(seed, n=60):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(draw.choices(words, k=draw.randrange(0, 90))) for _ in range(n)]
    for part in (0.005, 0.01, 0.02, 0.03, 0.05):
        texts += family(draw, draw.choices(words, k=draw.randrange(20, 200)), 14, part)
    passage = " ".join(draw.choices(words, k=50))  # in a third of all texts
    texts = [t + " " + passage if k % 3 == 0 else t for k, t in enumerate(texts)]
    chain = draw.choices(words, k=100)
    texts += [" ".join(chain[k : k + 70]) for k in range(0, 30, 3)]  # each links with its neighbours only
    texts += texts[:10] + ["a b", "A B", "a", "A b c d", ""]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "small"), [(1, False), (2, True)])
def test_components_equal_brute_force(spark, monkeypatch, seed, small):
    """Also with lists so short and blocks so small that hot shingles are salted and long lists are cut."""
    if small:
        for name, value in (("LIST", 8), ("SHORT_LIST", 4), ("BLOCK", 8), ("SKIP", 2), ("GROUP", 64)):
            monkeypatch.setattr(jaccard_join, name, value)
    rows = random_rows(seed)
    assert got(jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute(rows)


def test_two_families_that_share_half(spark, monkeypatch):
    """Large components that meet in many lists and aren't linked: leaders' answers settle nearly all their pairs."""
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", 16)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    draw = random.Random(8)
    words = [f"w{k}" for k in range(10_000)]
    one = draw.sample(words, 120)
    texts = family(draw, one, 60, 0.004) + family(draw, one[:104] + draw.sample(words, 16), 60, 0.004) + family(draw, one[:108] + draw.sample(words, 12), 40, 0.004)
    rows = list(enumerate(texts))
    assert got(jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


@pytest.mark.parametrize(("told", "wide"), [(1, 1)])
def test_pairs_in_rounds_lose_no_link(spark, monkeypatch, told, wide):
    """Components get so few pairs at first that several rounds are needed."""
    for name, value in (("TOLD", told), ("WIDE", wide), ("MORE", 3), ("SHORT_LIST", 16), ("BLOCK", 16)):
        monkeypatch.setattr(jaccard_join, name, value)
    draw = random.Random(5)
    words = [f"w{k}" for k in range(10_000)]
    one = draw.sample(words, 120)
    texts = family(draw, one, 40, 0.02) + family(draw, one[:108] + draw.sample(words, 12), 30, 0.02) + family(draw, draw.sample(words, 60), 20, 0.03)
    rows = list(enumerate(texts))
    assert got(jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_pairs_follow_the_size_of_a_family(spark, monkeypatch):
    """Twice as many near copies are no four times as many pairs to look up and verify."""
    draw = random.Random(6)
    base = draw.sample([f"w{k}" for k in range(10_000)], 100)
    texts, asked = family(draw, base, 360, 0.025), []
    differences = jaccard_join.differences

    def counted(pairs, texts):
        asked[-1] += pairs.count()
        return differences(pairs, texts)

    monkeypatch.setattr(jaccard_join, "differences", counted)
    for n in (180, 360):
        asked.append(0)
        rows = list(enumerate(texts[:n]))
        assert got(jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert asked[1] < 3 * asked[0] and asked[1] < 12 * 360


def test_pairs_that_are_left_out_are_told():
    """Of two components a few pairs come out, and each that is left out leaves a mark."""
    import pyarrow as pa

    n, bits = 40, parity(np.arange(40, dtype=np.uint64))
    table = pa.table({"token": [1] * n, "c": list(range(n)), "n": [40] * n, "pos": [0] * n, "root": [k % 4 for k in range(n)], "side": [2] * n, "bits": [bits] * n})
    rows = jaccard_join._skipping(table, 3, 1000).to_pylist()
    assert Counter((r["r"], r["s"]) for r in rows) == {(i, j): 3 for i in range(4) for j in range(i + 1, 4)}
    assert all(r["more"] and not r["wide_r"] and not r["wide_s"] for r in rows)
    rows = jaccard_join._skipping(table, 1000, 5).to_pylist()
    assert not any(r["more"] for r in rows) and all(r["wide_r"] and r["wide_s"] for r in rows)
    rows = jaccard_join._skipping(table, 1000, 1000).to_pylist()
    assert len(rows) == 600 and not any(r["more"] or r["wide_r"] or r["wide_s"] for r in rows)


def test_lists_across_batches():
    """The stream gives the same whatever the batches' borders."""
    import pyarrow as pa

    draw = random.Random(2)
    rows = sorted((draw.randrange(12), c % 2, draw.randrange(20, 60), c, draw.randrange(3)) for c in range(80))
    token, _, n, c, pos = (pa.array([r[k] for r in rows], pa.int64()) for k in range(5))
    table = pa.table({"token": token, "c": c, "at": pa.array([r[2] << 32 | r[4] for r in rows], pa.int64())})

    def run(size):
        batches = table.to_batches(max_chunksize=size)
        return [tuple(r.values()) for b in jaccard_join._streamed([2] + [1] * 31)(iter(batches)) for r in b.to_pylist()]

    whole = run(1000)
    assert sorted(whole, key=str) == sorted(run(1), key=str) == sorted(run(7), key=str)
    assert sorted((r[0], r[2], r[3], r[4]) for r in whole) == sorted((t, x, m, p) for t, _, m, x, p in rows)  # salted: all of them
    first: dict = {}
    for t, s, m, x, _ in rows:
        first.setdefault((t, s, int(jaccard_join.bands(m))), x)
    assert {(r[2], r[5]) for r in whole if r[5] is not None} <= {(x, first[t, s, int(jaccard_join.bands(m))]) for t, s, m, x, _ in rows}
    table = table.set_column(0, "token", pa.array([r[0] | 1 << jaccard_join.LEVEL_BITS for r in rows], pa.int64())).sort_by([("token", "ascending"), ("at", "ascending"), ("c", "ascending")])
    several = Counter(r[0] for r in rows)
    assert Counter(r[0] & 15 for r in run(5)) == Counter({t: k for t, k in several.items() if k > 1})


def test_entries_without_partner_go():
    """Of lists that aren't salted only entries that may meet another are left, whatever the batches' borders."""
    import pyarrow as pa

    draw = random.Random(3)
    rows = sorted((draw.randrange(40), draw.randrange(20, 90), c, draw.randrange(12)) for c in range(160))
    rows += sorted((41 | 1 << jaccard_join.LEVEL_BITS, 10 * 2**k, 200 + k, 0) for k in range(5))  # salted
    table = pa.table({name: pa.array([r[k] for r in rows], pa.int64()) for name, k in (("token", 0), ("n", 1), ("c", 2), ("pos", 3))})
    want = [r for r in rows if r[0] > 40 or any(r[0] == q[0] and r[2] != q[2] and may_meet(r[1], r[1] - r[3], q[1], q[1] - q[3]) for q in rows)]
    assert 5 < len(want) < len(rows) - 5
    for size in (1, 2, 7, 1000):
        for part in (table, table.slice(0, 160)):
            kept = [tuple(r.values()) for b in jaccard_join._meeting([1, 2] + [1] * 30)(iter(part.to_batches(max_chunksize=size))) for r in b.to_pylist()]
            assert kept == [r for r in want if r in rows[: part.num_rows]]
    one = table.slice(160).set_column(0, "token", pa.array([7] * 5, pa.int64()))  # a single list, none of which may meet
    assert list(jaccard_join._meeting([1] * 32)(iter(one.to_batches(max_chunksize=2)))) == []


def test_lists_hold_what_may_meet(spark):
    """A passage that texts of all sizes share brings no entry of them into the lists."""
    rows = [(0, k, 30 * 2**k, [5] + [100 + 10 * k + j for j in range(2)]) for k in range(6)] + [(1, k, 50, [9, 200 + k, 300]) for k in range(10, 13)]
    classes = spark.createDataFrame([r[1:] for r in rows], "c long, n long, prefix array<long>")
    assert {r["c"] for r in jaccard_join.index_lists(classes, 1000.0).collect()} == {10, 11, 12}


def test_only_texts_of_pairs_are_exchanged(spark, monkeypatch):
    """Texts of which each two share a passage, and that bitmaps tell apart, are not looked up; the answer is that of brute force."""
    draw = random.Random(7)
    words = [f"w{k}" for k in range(10_000)]
    passages = [" ".join(draw.sample(words, 15)) for _ in range(200)]
    texts = [" ".join(draw.sample(words, draw.randrange(60, 70))) + " " + p for p in passages for _ in range(2)] + family(draw, draw.sample(words, 80), 6, 0.01)
    rows, asked = list(enumerate(texts)), []
    differences = jaccard_join.differences

    def counted(pairs, texts):
        asked.append(texts.count())
        return differences(pairs, texts)

    monkeypatch.setattr(jaccard_join, "differences", counted)
    assert got(jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert asked and max(asked) < 60


def test_components_of_further_edges(spark):
    """Edges in turns give the components of all at once; edges within what is known need no round."""
    draw = random.Random(1)
    ends = [*range(60), None]
    turns = [[(draw.choice(ends), draw.choice(ends)) for _ in range(n)] for n in (25, 20)] + [[(70, 71), (72, 71)], []]
    least = {}
    table = lambda edges: spark.createDataFrame(edges, "a long, b long")
    with Scratch(spark) as scratch:
        known = None
        for edges in turns:
            known = components(table(edges), scratch, known)
            for a, b in edges:
                if a is not None and b is not None and a != b:
                    x, y = sorted((least.setdefault(a, a), least.setdefault(b, b)))
                    least = {node: x if root == y else root for node, root in least.items()}
            assert sorted(map(tuple, known.collect())) == sorted(least.items())
        tables = len(scratch.paths)
        inside = known.where("node <> root").select(known["node"].alias("a"), known["root"].alias("b"))
        assert components(inside, scratch, known).count() == known.count() and len(scratch.paths) == tables + 1


def test_small_tables_take_few_tasks(spark, monkeypatch):
    """Many shuffle partitions don't make as many files of every small table; the answer is that of brute force."""
    draw, files, stored = random.Random(9), {}, shared.stored
    words = [f"w{k}" for k in range(10_000)]
    texts = [t for _ in range(8) for t in family(draw, draw.sample(words, 60), 12, 0.02)]

    def counted(df, name, path=None):
        out = stored(df, name, path)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(shared, "stored", counted)
    monkeypatch.setattr(jaccard_join, "stored", counted)
    changed = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        rows = list(enumerate(texts))
        mine = got(jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert mine == brute(rows)
    assert files["labels"] > 1 and max(files.values()) <= 2 * spark.sparkContext.defaultParallelism


def test_asked_rows(spark):
    """All rows that are asked for, also with null ids, and few others."""
    rows = spark.range(4000).selectExpr("if(id < 3, null, id) AS doc_id", "id * 7 AS text_hash", "string(id) AS text")
    rows = rows.select(*jaccard_join._text_key(rows["doc_id"], rows["text_hash"]), "text")
    of = rows.where("text_hash < 700 or text_hash = 21000").select("id", "text_hash")
    kept = {int(r["text"]) for r in jaccard_join.asked_rows(rows, of).collect()}
    assert {*range(100), 3000} <= kept and len(kept) < 101 + 4000 / 8
    assert jaccard_join.asked_rows(rows, of.limit(0)).count() == 0


def test_bands_hold_what_may_meet():
    n = np.arange(1, 3000)
    band = jaccard_join.bands(n)
    assert (np.diff(band) >= 0).all()
    assert all(band[k - 1] <= band[(100 * k // 80) - 1] <= band[k - 1] + 1 for k in range(1, 2300))


@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300), st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=40), st.floats(0, 1))
@settings(max_examples=200, deadline=None)
def test_bitmaps_never_exceed_the_difference(x, more, part):
    y = set(sorted(x)[: max(1, int(part * len(x)))]) | more
    assert differing(*(parity(np.array(sorted(s), np.uint64)) for s in (x, y))) <= len(x ^ y)


@given(st.integers(1, 60), st.integers(1, 60), st.integers(0, 60))
@settings(max_examples=300, deadline=None)
def test_bounds(n_a, n_b, inner):
    inner = min(inner, n_a, n_b)
    links = 100 * inner >= 80 * (n_a + n_b - inner)
    assert links == (inner >= needed(n_a, n_b))
    if links:
        # sets that link and share their last elements only still meet in both prefixes
        assert n_a - inner < prefix_length(n_a) and n_b - inner < prefix_length(n_b)
        assert may_meet(np.array([n_a]), np.array([inner]), np.array([n_b]), np.array([inner])).all()


@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 8), st.integers(0, 3), st.integers(0, 1)), max_size=40), st.booleans())
@settings(max_examples=200, deadline=None)
def test_skipped_blocks_lose_nothing(entries, both):
    entries = sorted((n, min(pos, n - 1), root, 2 if both else side) for n, pos, root, side in entries)
    n, pos, root, side = (np.array([e[k] for e in entries], np.int64) for k in range(4))
    before, jaccard_join.SKIP = jaccard_join.SKIP, 3
    try:
        mine = sorted((int(x), int(y)) for xs, ys in jaccard_join.skip_join(n, pos, root, side) for x, y in zip(xs, ys, strict=True))
    finally:
        jaccard_join.SKIP = before
    want = [
        (i, j) for i in range(len(n)) for j in range(i + 1, len(n))
        if 100 * n[i] >= 80 * n[j] and min(n[i] - pos[i], n[j] - pos[j]) >= needed(n[i], n[j]) and root[i] != root[j] and (both or side[i] != side[j])
    ]
    assert mine == want


def test_awkward_tables(spark):
    rows = awkward()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS c", "'x' AS bits", "2 AS token", "3 AS text_hash", "4 AS n_shingles", "5 AS component_id")
    assert got(jaccard_join.jaccard_components(docs)) == brute([r[:2] for r in rows])
    assert got(jaccard_join.jaccard_components(spark.createDataFrame([], SCHEMA))) == []


def test_query_over_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    mine = got(queries.op13_jaccard_join(spark, sf_dir))
    assert mine == brute(rows)
    assert sum(d != c for d, _, c in mine) > 3
