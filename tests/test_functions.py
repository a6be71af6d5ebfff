"""Column functions against goldens and against Python's own text rules."""

from __future__ import annotations

import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from offerweave.functions import fields, text, vocab

AS_OF = datetime(2024, 6, 15, 12)


def values(spark, items, make):
    """One result per item, in order."""
    df = spark.createDataFrame(list(enumerate(items)), "n int, v string").withColumn("out", make(F.col("v")))
    return [r["out"] for r in df.orderBy("n").collect()]


def model_fold(s: str) -> str:
    s = "".join(c for c in unicodedata.normalize("NFKD", s.casefold()) if not unicodedata.combining(c))
    return " ".join("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789+/&-" else " " for c in s).split())


def test_fold(spark):
    items = ["Data™ Ingénieur (H/F)", "Cœur de métier", "½ temps & C++", "①②", "İstanbul", "straße", "", "ﬁn № Ⅳ", "Ǆ", "élève" * 50, "中文 abc"]
    assert values(spark, items, text.fold) == [model_fold(x) for x in items]


def test_fold_over_every_letter(spark):
    items = ["".join(chr(c) + " " for c in range(a, a + 256) if not 0xD800 <= c <= 0xDFFF) for a in range(0x80, 0x3000, 256)]
    assert values(spark, items, text.fold) == [model_fold(x) for x in items]


def test_slugify(spark):
    def model(s: str) -> str:
        s = unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode().lower()
        return "-".join("".join(c if c.isalnum() else " " for c in s).split())

    items = ["Développeur  Big Data!", "ﬁn № Ⅳ ⑩", "a--b", "", "ß ü", "Æsir"]
    assert values(spark, items, text.slugify) == [model(x) for x in items]


def test_signature(spark):
    got = values(spark, ["Senior Data Engineer (H/F) pour la plateforme", "Data Engineer F/H"], lambda c: text.signature(text.fold(c), 6))
    assert got == ["data engineer plateforme", "data engineer f/h"]


def test_canonical_url(spark):
    items = ["HTTPS://X.com/a/;p=1?q#f", "https://x.com", "HTTP://u:P@X.com:80/a//", "mailto:a@b", "//x.com/a", "", "rtsps://h/a;b"]
    assert values(spark, items, text.canonical_url) == ["https://x.com/a", "https://x.com/", "http://u:p@x.com:80/a", "mailto:a@b", "//x.com/a", "", "rtsps://h/a"]


def test_skills_are_cleaned_after_splitting(spark):
    df = spark.createDataFrame([(0, "Python; SQL | python, Spark/Kafka"), (1, "&amp;eacute;"), (2, "C&amp;amp;lt; x; R&amp;D"), (3, None)], "n int, v string")
    out = text.clean_stage(df, {"c": F.col("v")})
    out = text.clean_stage(out.withColumn("p", text.split_parts(F.col("c"))), {"q": F.col("p")})
    got = [r["s"] for r in out.select("n", text.distinct_by_key(text.parts_of(F.col("q")), text.fold).alias("s")).orderBy("n").collect()]
    assert got[0] == ["Python", "SQL", "Spark", "Kafka"]
    assert got[1] == ["é"]
    assert got[2][0] == "C&"
    assert got[3] == []


def test_distinct_ignore_case(spark):
    df = spark.createDataFrame([(["straße", "STRASSE", " a", "A", "", "b"],)], "v array<string>")
    assert df.select(text.distinct_ignore_case(F.col("v"))).first()[0] == ["straße", "a", "b"]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("03/04/2024", "2024-04-03T00:00:00+00:00"),
        ("2024-03-04T10:00:00.000Z", "2024-03-04T10:00:00+00:00"),
        ("12/25/2024", "2024-12-25T00:00:00+00:00"),
        ("20240304", "2024-03-04T00:00:00+00:00"),
        ("2024", "2024-01-01T00:00:00+00:00"),
        ("2024/03/04", "2024-03-04T00:00:00+00:00"),
        ("2024.03.04", "2024-03-04T00:00:00+00:00"),
        ("04/03/24", "2024-03-04T00:00:00+00:00"),
        ("2024-03-04T10:00:00+02", "2024-03-04T08:00:00+00:00"),
        ("4 March 2024 10:00", "2024-03-04T10:00:00+00:00"),
        ("Mon, 04 Mar 2024 10:00:00 GMT", "2024-03-04T10:00:00+00:00"),
        ("20240304T101500Z", "2024-03-04T10:15:00+00:00"),
        ("aujourd'hui", ""),
        ("il y a 3 jours", ""),
        ("4 mars 2024", ""),
        ("hier", "2024-06-14T12:00:00+00:00"),
    ],
)
def test_dates(spark, given, expected):
    assert values(spark, [given], lambda c: fields.iso_text(fields.published_timestamp(c, text.fold(c), AS_OF))) == [expected]


def test_storage_dates_are_month_first(spark):
    got = values(spark, ["03/04/2024", "25/12/2024", "x"], lambda c: fields.iso_date(fields.parse_timestamp(c, day_first=False)))
    assert got == ["2024-03-04", "2024-12-25", ""]


def test_amounts(spark):
    assert values(spark, ["1.234,56", "45K", "abc", ""], fields.amount) == [1.234, 45000.0, None, None]


def test_number_labels(spark):
    df = spark.createDataFrame([(0.0, 0.0), (12000000.0, 0.0), (30000.0, 45000.5)], "a double, b double")
    assert [r[0] for r in df.select(fields.bounds_label(F.col("a"), F.col("b"), numeric=True)).collect()] == ["", "12000000.0", "30000.0 - 45000.5"]


def test_keyword_hits(spark):
    assert values(spark, ["j ai data-driven", "big data engineer", ""], lambda c: text.keyword_hits(c, vocab.FOCUS_KEYWORDS)) == [2, 2, 0]


def test_lists_take_linear_time(spark):
    """Keys are computed once per list: four times the items may not take sixteen times as long by far."""
    import time

    def took(n: int) -> float:
        df = spark.range(100).withColumn("v", F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: F.concat(F.lit("É"), x.cast("string"))))
        df.select(F.sum(F.size(text.distinct_by_key(F.col("v"), text.fold)))).collect()
        start = time.time()
        df.select(F.sum(F.size(text.distinct_by_key(F.col("v"), text.fold)))).collect()
        return time.time() - start

    small = took(50)
    assert took(200) < 12 * max(small, 0.1)
