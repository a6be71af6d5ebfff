"""Entities against the standard library: every name, every kind of number, random texts."""

from __future__ import annotations

import html
import random
from html.entities import html5

from pyspark.sql import functions as F

from offerweave.functions import text


def test_entities_equal_the_standard_library(spark):
    draw = random.Random(6)
    rows = [f"x&{name}y" for name in html5] + [f"&{name.rstrip(';')}" for name in html5] + [f"&{name[:-1]}Z;" for name in html5]
    rows += [f"&#{n};a&#x{n:X}b" for n in [*range(300), 8364, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x10FFFF, 0x110000, 10**7, 10**30]]
    rows += ["", "&", "&&", "a & b", "&#", "&#;", "&#x;", "&#xg;", "&;", "&amp", "&ampamp;", "&amp;amp;", "&notit;", "&noti", "&lt;b&gt;", "&#0065;", "&#x00041", "&thisisaverylongnamethatnobodyhaseverheardof;", "&é;", "&a b;"]
    rows += ["".join(draw.choice(["&", "#", "x", "amp", "lt", ";", "not", "in", "6", "5", "é", " ", "copy", "acute", "\n"]) for _ in range(draw.randrange(14))) for _ in range(3000)]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, t string")
    got = {r["k"]: r["u"] for r in df.select("k", text.unescape(F.col("t")).alias("u")).collect()}
    assert [(r, got[k]) for k, r in enumerate(rows) if got[k] != html.unescape(r)] == []


def test_no_python_in_canonical_offers(spark, sf_dir):
    from offerweave.plans import catalogue

    for name in ("scope_filter", "normalized_text", "normalized_skills"):
        plan = catalogue.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "InArrow" not in plan and "pythonUDF" not in plan
