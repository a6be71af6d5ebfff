"""Stages return the caller's rows whatever names their columns have: every name that the operators use themselves."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import corpus_pipeline
from offerweave import llm

SOURCES = "".join(p.read_text() for p in Path(llm.__file__).parent.glob("*.py"))
#: Names of columns in the operators' code, and those with underscores that earlier versions used.
NAMES = sorted({*re.findall(r"[\"'](_*[a-z][a-z0-9_]{0,14})[\"']", SOURCES), "__id", "__hash", "__k", "__one", "__gone", "__ranges", "__host", "row_", "ranges_", "gone_"} - {"doc_id", "text", "lang", "source", "n_chars"})
CLEAN = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(4)]


@pytest.mark.parametrize("stage", ["quality_rules", "near_duplicates", "substring_duplicates", "source_mixture"])
def test_extra_columns_come_back_as_they_were(spark, stage):
    extra = [n for n in NAMES if n.islower()]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in extra)
    docs = spark.createDataFrame([(k, t, "en", "s", len(t), *["ORIG"] * len(extra)) for k, t in enumerate(CLEAN)], schema)
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, "")
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) >= 3
    for r in rows:
        assert [n for n in extra if r[n] != "ORIG"] == []


@pytest.mark.parametrize("stage", ["quality_rules", "near_duplicates", "substring_duplicates", "source_mixture"])
def test_empty_table_gives_one(spark, stage):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, row string")
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, "")
    assert out.columns == docs.columns and out.count() == 0
