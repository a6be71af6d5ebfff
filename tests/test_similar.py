"""The similarity join of texts: lossless against all pairs, and small candidates in large blocks."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from offerweave.operators import similar
from offerweave.operators.similar import Near, ratio
from offerweave.operators.tables import Workspace


@given(st.text(alphabet="ab ", max_size=24), st.lists(st.tuples(st.integers(0, 30), st.sampled_from(["", "a", "b", "xy"])), max_size=3), st.sampled_from([(0.94, 3), (0.85, 2), (0.9, 3)]))
@settings(max_examples=500, deadline=None)
def test_similar_texts_share_a_key_at_near_places(a, edits, rule):
    b = a
    for at, put in edits:
        b = b[: at % (len(b) + 1)] + put + b[at % (len(b) + 1) + (not put) :]
    near = Near("t", *rule)
    if not a or not b or ratio(a, b) < near.ratio:
        return
    rank = np.random.default_rng(1).integers(0, 5, similar.BUCKETS)
    allowed = int((1 - near.ratio) * (len(a) + len(b)) + 1e-9)
    mine, theirs = similar.signature(a, near, rank), similar.signature(b, near, rank)
    assert any(g == h and abs(p - q) <= allowed for g, p in mine for h, q in theirs)


def found(spark, rows, nears, **settings):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "id long, title string, company string")
    with Workspace(spark) as work:
        return {(r["a"], r["b"]) for r in similar.candidates(df, nears, work, **settings).select("a", "b").collect()}


BOTH = (Near("title", 0.94), Near("company", 0.94))


@pytest.mark.parametrize("hot", [2000, 3])
def test_no_pair_is_lost(spark, monkeypatch, hot):
    """Also with keys dealt to many tasks."""
    monkeypatch.setattr(similar, "HOT_KEY", hot)
    draw = random.Random(4)
    base = ["data engineer spark team lead paris", "ingenieur donnees plateforme nuage", "data", "h/f", "analyste bi"]
    firms = ["acme group france services", "societe 12 & cie", "ab", "x"]

    def near(t):
        k = draw.randrange(len(t) + 1)
        return draw.choice([t, t[:k] + draw.choice("aes ") + t[k:], t[:k] + t[k + 1 :] or t])

    rows = sorted({(near(near(draw.choice(base))), near(draw.choice(firms))) for _ in range(150)})
    got = found(spark, rows, BOTH)
    pairs = {(i, j) for i, j in combinations(range(len(rows)), 2) if all(max(ratio(rows[i][k], rows[j][k]), ratio(rows[j][k], rows[i][k])) >= 0.94 for k in (0, 1))}
    assert len(pairs) > 50
    assert pairs <= got


def test_large_block_has_few_candidates(spark):
    """20,000 offers of one title: only those of similar employers meet, not 200 million pairs."""
    draw = random.Random(9)
    firms = sorted({"".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(18)) for _ in range(19_900)})
    firms += [f[:9] + "q" + f[9:] for f in firms[:100]]
    got = found(spark, [("data engineer spark paris", f) for f in firms], BOTH)
    n = len(firms) - 100
    assert {(k, n + k) for k in range(100)} <= got
    assert len(got) < 1000


def test_short_texts_and_empty_tables(spark):
    rows = [("a", "b"), ("a", "bc"), ("ab", "b"), ("abcd", "b"), ("abce", "b")]
    loose = (Near("title", 0.5, 1), Near("company", 0.5, 1))
    got = found(spark, rows, loose)
    assert {(0, 1), (0, 2), (2, 3), (3, 4)} <= got
    assert found(spark, [], BOTH) == set()
