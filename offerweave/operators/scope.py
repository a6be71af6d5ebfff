"""Domain scope of offers: keyword signals, points, reasons and the decision; one pass, no shuffle but for counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.functions import text, vocab
from offerweave.operators.normalize import cleaned

LONG_DESCRIPTION = 250


def evaluated(df: DataFrame) -> DataFrame:
    """Adds hits, scope_score, scope_reasons, in_scope and filter_status to raw or cleaned offers."""
    out = df if "f_title" in df.columns else cleaned(df)
    out = out.withColumn("scope_title", F.col("f_scope"))
    out = out.withColumn("scope_long", F.trim(F.concat_ws(" ", "scope_title", F.nullif(F.col("f_description"), F.lit("")), F.nullif(F.col("f_skills_text"), F.lit("")))))
    out = out.withColumns({
        "role_title": text.keyword_hits(F.col("scope_title"), vocab.ROLE_KEYWORDS),
        "focus_title": text.keyword_hits(F.col("scope_title"), vocab.FOCUS_KEYWORDS),
        "tech_title": text.keyword_hits(F.col("scope_title"), vocab.TECH_KEYWORDS),
        "focus_body": text.keyword_hits(F.col("scope_long"), vocab.FOCUS_KEYWORDS),
        "tech_body": text.keyword_hits(F.col("scope_long"), vocab.TECH_KEYWORDS),
    })
    long = F.length("c_description") >= LONG_DESCRIPTION
    signals = (
        ("role_keyword_title", F.col("role_title") >= 1, F.lit(6)),
        ("focus_keyword_title", F.col("focus_title") >= 1, F.least(F.lit(3), "focus_title")),
        ("tech_keyword_title", F.col("tech_title") >= 1, F.lit(1)),
        ("focus_keyword_body", F.col("focus_body") >= 2, F.lit(2)),
        ("tech_keyword_body", F.col("tech_body") >= 2, F.lit(2)),
        ("descriptive_offer", long & (F.col("focus_body") >= 1), F.lit(1)),
    )
    score = sum((F.when(met, points).otherwise(0) for _, met, points in signals), F.lit(0))
    reasons = F.array_compact(F.array(*[F.when(met, name) for name, met, _ in signals]))
    nothing = (F.col("c_title") == "") & (F.col("c_description") == "")
    keep = (
        (F.col("role_title") >= 1)
        | ((F.col("focus_title") >= 1) & ((F.col("focus_body") >= 2) | (F.col("tech_body") >= 1)))
        | ((F.col("tech_title") >= 1) & (F.col("focus_body") >= 2))
    )
    known = F.col("source").isin(*vocab.OFFER_SOURCES)
    return out.withColumns({
        "scope_score": F.when(nothing, 0).otherwise(score),
        "scope_reasons": F.when(nothing, F.array(F.lit("missing_title_and_description"))).otherwise(reasons),
        "in_scope": ~nothing & keep,
        "filter_status": F.when(nothing | ~F.coalesce(known, F.lit(False)), "invalid").when(keep, "kept_offer").otherwise("out_of_scope"),
        "record_kind": F.lit("offer"),
    })


def kept(df: DataFrame) -> DataFrame:
    """Offers in scope. The decision is made once: moved below the cleaning, it would make a plan of some 30 MB."""
    return evaluated(df).withColumn("filter_status", text.held(F.col("filter_status"))).where("filter_status = 'kept_offer'")


def report(df: DataFrame) -> DataFrame:
    """Rows per source and filter status."""
    return evaluated(df).groupBy("source", "filter_status").agg(F.count("*").alias("offers"))


def selected(only: tuple[str, ...] = (), skip: tuple[str, ...] = ()) -> tuple[str, ...]:
    """Source names to collect, in their fixed order; ValueError if none is left or a name is unknown."""
    unknown = {*only, *skip} - {*vocab.COLLECT_SOURCES}
    left = tuple(s for s in vocab.COLLECT_SOURCES if (not only or s in only) and s not in skip)
    if unknown or not left:
        raise ValueError(f"unknown sources {sorted(unknown)}" if unknown else "no source is selected")
    return left


def volumes(df: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    """Rows per selected source, those without rows as 0, and the total as source 'total'."""
    spark = df.sparkSession
    listed = spark.createDataFrame([(s,) for s in sources], "source string")
    counts = df.where(F.col("source").isin(*sources)).groupBy("source").agg(F.count("*").alias("n"))
    met = listed.join(counts, "source", "left").select("source", F.coalesce("n", F.lit(0)).alias("offers"))
    return met.rollup("source").agg(F.sum("offers").alias("offers")).select(F.coalesce("source", F.lit("total")).alias("source"), "offers")
