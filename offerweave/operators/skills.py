"""Skills by region over job rows: filters, generators and counts, all in whole-stage code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.functions import vocab

FRANCE_WORDS = ("france", "paris")


def in_france(jobs: DataFrame) -> DataFrame:
    """Jobs whose countries hold FR, or whose location names France or Paris."""
    place = F.lower("location")
    named = F.lit(False)
    for word in FRANCE_WORDS:
        named = named | place.contains(word)
    return jobs.where(F.coalesce(F.array_contains("countries", "FR"), F.lit(False)) | F.coalesce(named, F.lit(False)))


def exploded_skills(jobs: DataFrame) -> DataFrame:
    """One row per skill, a job without skills kept with a null one; the location is the region."""
    kept = [c for c in jobs.columns if c not in ("company_slug", "url", "location", "countries", "stack")]
    return jobs.select(*kept, F.col("location").alias("region"), F.explode_outer("stack").alias("competence"))


def counts_by_region(exploded: DataFrame, named_only: bool = True) -> DataFrame:
    """Rows per (competence, region); ``named_only`` leaves out null and empty ones."""
    if named_only:
        exploded = exploded.where("competence is not null and competence <> '' and region is not null and region <> ''")
    return exploded.groupBy("competence", "region").agg(F.count("*").alias("nb"))


def aggregate_records(rows: DataFrame) -> DataFrame:
    """Canonical aggregate rows from (competence, region, nb, count as text): incomplete rows out, counts as whole numbers.

    A number 0 falls through to the other count, a text '0' doesn't; a count that is no whole number becomes 0.
    """
    number = F.coalesce(F.nullif(F.col("count"), F.lit("")), F.nullif(F.col("nb"), F.lit("")))
    complete = rows.where((F.trim("competence") != "") & (F.trim("region") != "") & number.isNotNull())
    return complete.select(
        F.lit(vocab.AGGREGATE_SOURCE).alias("source"),
        F.trim("competence").alias("competence"),
        F.trim("region").alias("region"),
        F.coalesce(F.when(number.rlike(r"\A\s*[+-]?\d+\s*\z"), number.try_cast("int")), F.lit(0)).alias("count"),
        F.lit("aggregate").alias("record_kind"),
        F.lit("kept_aggregate").alias("filter_status"),
    )
