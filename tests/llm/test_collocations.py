"""Collocations against brute force: random phrases, hot leading words, long texts, awkward tables."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from offerweave.llm import collocations, queries
from offerweave.llm.collocations import Mining
from tests.llm.test_llm import SCHEMA, awkward, found
from tests.test_queries import as_text, duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def counts(rows):
    f: Counter = Counter()
    for text, lang in rows:
        for w in pieces(text):
            f.update((lang or "und", tuple(w[i : i + n])) for n in range(1, 5) for i in range(len(w) - n + 1))
    return f


def brute(rows, m):
    f = counts(rows)
    n: Counter = Counter()
    for (lang, p), c in f.items():
        n[lang] += c * (len(p) == 1)
    kept: dict = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < m.least:
            continue
        if any(100 * c >= 80 * a for (other, q), c in f.items() if other == lang and c >= m.least and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
            continue
        score, _, l, r = min((m.scale * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        kept.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for lang, own in kept.items() for k, (s, a, p, l, r) in enumerate(sorted(own)[: m.top]))


def prose(draw, n, words="the of cat Dog été a naïve x"):
    return "".join(draw.choice(words.split()) + draw.choice([" "] * 6 + [", ", "\t", "\n", ".", " ! "]) for _ in range(n))


@pytest.mark.parametrize("hot", [False, True])
def test_rows_equal_brute_force(spark, hot, monkeypatch):
    """Also with every leading pair and triple hot, so that all windows are routed by four words."""
    if hot:
        monkeypatch.setattr(collocations, "BUCKET_BYTES", 48)
    draw = random.Random(5)
    rows = [(prose(draw, draw.randrange(0, 120)), draw.choice(["en", "fr", None])) for _ in range(120)] + [(prose(draw, 40), "en")] * 9
    m = Mining(least=4, top=40)
    got = found(collocations.collocations(spark.createDataFrame(rows, "text string, lang string").repartition(3), m))
    assert sorted(got) == brute(rows, m)


@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=4), min_size=1, max_size=60), st.integers(1, 6), st.integers(2, 4))
@settings(max_examples=200, deadline=None)
def test_three_way_quicksort_counts_prefixes(suffixes, least, route):
    window = np.zeros((4, len(suffixes)), np.uint32)
    for k, s in enumerate(suffixes):
        window[: len(s), k] = s
    weight = np.array([1 + k % 3 for k in range(len(suffixes))])
    want: Counter = Counter()
    for s, w in zip(suffixes, weight.tolist(), strict=True):
        for d in range(1, len(s) + 1):
            want[tuple(s[:d])] += w
    got = {tuple(window[:d, o].tolist()): t for one, d, total in collocations.three_way(window, weight, np.full(len(suffixes), route, np.uint8), least) for o, t in zip(one.tolist(), total.tolist(), strict=True)}
    # what was routed by more words than it has is told whatever its weight
    assert got == {p: c for p, c in want.items() if c >= least or len(p) < route}


@given(st.text(alphabet="ab é.\n\t", max_size=200), st.integers(4, 30))
@settings(max_examples=150, deadline=None)
def test_segments_change_nothing(text, size):
    def windows():
        out: Counter = Counter()
        batch = pa.record_batch([pa.array(["en"]), pa.array([text])], ["lang", "text"])
        for _, w in collocations.words_by_language(iter([batch])):
            for i in np.flatnonzero(w.reach).tolist():
                out.update(tuple(w.names[k].decode() for k in w.ids[i : i + n]) for n in range(1, int(w.reach[i]) + 1))
        return out

    want = Counter({p: c for (_, p), c in counts([(text, "en")]).items()})
    assert windows() == want
    before, collocations.SLICE = collocations.SLICE, size
    try:
        assert windows() == want
    finally:
        collocations.SLICE = before


def test_words_of_one_hash_stay_apart():
    data = np.frombuffer(b"ab cd ab ef", np.uint8)
    start, stop = np.array([0, 3, 6, 9]), np.array([2, 5, 8, 11])
    ids, names = collocations._exact_ids(np.zeros(4, np.uint64), data, start, stop)
    assert [names[k] for k in ids] == [b"ab", b"cd", b"ab", b"ef"]


def test_exact_arithmetic(spark):
    """Products beyond 64 bits: a scale of 10 ** 9 on counts is divided exactly."""
    rows = [("x y " * 5 + ". x . x", "en")] * 10
    m = Mining(least=5, scale=10**9)
    got = found(collocations.collocations(spark.createDataFrame(rows, "text string, lang string"), m))
    assert sorted(got) == brute(rows, m)


def test_awkward_tables(spark):
    m = Mining(least=2, top=50)
    small = [r for r in awkward() if len(r[1] or "") < 2000]  # test_segments has the long ones
    docs = spark.createDataFrame(small, SCHEMA).selectExpr("*", "1 AS phrase", "2 AS f", "3 AS score", "'x' AS bucket", "5 AS depth")
    assert sorted(found(collocations.collocations(docs, m))) == brute([(r[1], r[2]) for r in small], m)
    assert found(collocations.collocations(spark.createDataFrame([], SCHEMA), m)) == []


def test_query_equals_its_sql(spark, sf_dir):
    mine, theirs = queries.op12_collocations(spark, sf_dir).toPandas(), duck(sf_dir, queries.ORACLES["op12_collocations"])
    columns = sorted(mine.columns)
    assert as_text(mine, columns).equals(as_text(theirs, columns))
