"""Importance resampling against brute force, in long texts, ties and awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from offerweave.llm import importance, queries
from offerweave.llm.words import buffers

from tests.llm.test_llm import SCHEMA, awkward, found, same
from tests.test_queries import as_text, duck

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest):
    w = WORD.findall((text or "").translate(LOWER))
    return [" ".join(w[k : k + n]) for n in range(1, longest + 1) for k in range(len(w) - n + 1)], len(w)


def brute(rows, target, draw):
    bucket = lambda f: zlib.crc32(f.encode()) % draw.buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, draw.longest)[0])
    t = Counter(bucket(f) for x in target for f in features(x, draw.longest)[0])
    n_s, n_t, b = sum(s.values()), sum(t.values()), draw.buckets
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * (n_s + b) / ((s[k] + 1) * (n_t + b))))
    out = []
    for doc_id, text in rows:
        own, n = features(text, draw.longest)
        weight = sum(gain(bucket(f)) for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{draw.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n])
    order = sorted((r for r in out if r[4] >= draw.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(order[: draw.share[0] * len(order) // draw.share[1]])}
    return [(*r[:4], rank.get(id(r))) for r in out]


def prose(draw, n):
    return " ".join(draw.choice(["The", "cat", "été", "of", "42", "zinc"]) + draw.choice(["", ",", "s", "-x", "_"]) for _ in range(n))


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_rows_equal_brute_force(spark, longest):
    draw = random.Random(longest)
    rows = [(k, prose(draw, draw.randrange(0, 60))) for k in range(300)] + [(7, prose(draw, 50))] * 3
    target = [prose(draw, 30) for _ in range(5)] + [None, ""]
    setting = importance.Draw(buckets=50, longest=longest, share=(40, 100), margin=0.0001)
    got = importance.importance_sample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(t,) for t in target], "text string"), setting)
    assert Counter(found(got)) == Counter(brute(rows, target, setting))


@given(st.lists(st.text(alphabet="aB9é,  \n_", max_size=40), min_size=1, max_size=5), st.integers(1, 3))
@settings(max_examples=80, deadline=None)
def test_segments_change_nothing(texts, longest):
    data, at = buffers(pa.array(texts))

    def counts():
        total: Counter = Counter()
        for a, _, text, crc in importance._stretches(data, at, longest):
            total.update(zip((a + text).tolist(), crc.tolist(), strict=True))
        return total

    want = Counter((k, zlib.crc32(f.encode())) for k, t in enumerate(texts) for f in features(t, longest)[0])
    assert counts() == want
    before, importance.SEGMENT = importance.SEGMENT, 4
    try:
        assert counts() == want
    finally:
        importance.SEGMENT = before


def test_long_words_and_texts():
    text = "é" * 100_000 + " " + "ab " * 1_500_000 + "x" * 70
    data, at = buffers(pa.array([text]))
    crc = np.concatenate([c for *_, c in importance._stretches(data, at, 1)])
    assert Counter(crc.tolist()) == {zlib.crc32(("é" * 100_000).encode()): 1, zlib.crc32(b"ab"): 1_500_000, zlib.crc32(b"x" * 70): 1}


def test_equal_scores_and_wide_brackets(spark):
    """Every row with one id and one text: all ties; the bracket is widened until it holds, and each rank is given once."""
    docs = spark.createDataFrame([(5, "a " * 30)] * 1000, "doc_id long, text string")
    got = found(importance.importance_sample(docs, spark.createDataFrame([("a",)], "text string")))
    assert sorted(r[4] for r in got if r[4] is not None) == list(range(1, 101))
    rows = spark.createDataFrame([(k, k) for k in range(1000)], "doc_id long, score long")
    for take in (1, 100, 500, 999, 1000):
        low, high, above = importance.bracket(rows, take, 1000, 1e-9)
        assert above == max(0, 999 - high) and above <= take <= 1000 - low


def test_awkward_tables(spark):
    rows = awkward()
    setting = importance.Draw(share=(1, 2))
    target = spark.createDataFrame([("one two base", 1.0)], "text string, score double")
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rank", "'x' AS weight", "2 AS score", "3 AS part", "4 AS row")
    got = importance.importance_sample(docs, target, setting)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    same(found(got), brute([r[:2] for r in rows], ["one two base"], setting))
    nothing, none = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "text string")
    assert found(importance.importance_sample(nothing, target, setting)) == []
    same(found(importance.importance_sample(docs, none, setting)), brute([r[:2] for r in rows], [], setting))


def test_query_equals_its_sql(spark, sf_dir):
    mine, theirs = queries.op11_importance(spark, sf_dir).toPandas(), duck(sf_dir, queries.ORACLES["op11_importance"])
    columns = sorted(mine.columns)
    assert as_text(mine, columns).equals(as_text(theirs, columns))
    assert mine["rank"].notna().sum() > 5
