"""Text functions: the same results for every character, and look-ups whose cost doesn't follow the tables' size."""

from __future__ import annotations

import json
import re
import unicodedata

from pyspark.sql import functions as F

from offerweave.functions import text


def plain_fold(s):
    base = "".join(c for c in unicodedata.normalize("NFKD", s.casefold()) if not unicodedata.combining(c))
    return re.sub("[^a-z0-9+/&-]+", " ", base).strip(" ")


def test_every_character_is_squashed_and_folded_as_before(spark):
    chars = [chr(n) for n in range(1, 0x30000) if not 0xD800 <= n <= 0xDFFF]
    texts = [f"a{c}{c}b {c} c  d{c}e {c}" for c in chars] + ["", " ", "a b", " a  b ", "\t a\t\tb \x1c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", text.squash(F.col("t")).alias("s"), text.fold(F.col("t")).alias("f")).collect()
    spaces = "".join(c for c in text.SPACES)
    for r in got:
        assert r["s"] == re.sub(f"[{re.escape(spaces)}]+", " ", r["t"]).strip(" "), ascii(r["t"])
        assert r["f"] == plain_fold(r["t"]), ascii(r["t"])


def test_entities_are_looked_up_by_hash():
    for table in text._entity_tables()[:2]:
        parts = json.loads(table)
        assert isinstance(parts, list) and max(map(len, parts)) < 20
