"""Canonical offers: every derived column of an offer, in one pass without a shuffle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerweave.functions import fields, text, vocab

# the cleaned column of an offer, and the raw columns it is taken from: the first that isn't empty
TEXTS = {
    "external_id": ("external_id",),
    "title": ("title",),
    "company_name": ("company_name", "company"),
    "location_label": ("location_label", "location"),
    "salary": ("salary",),
    "contract_type": ("contract_type",),
    "telework": ("telework", "remote_policy", "weekly_work_duration"),
    "url": ("application_url", "url"),
    "description": ("description",),
    "published_at": ("published_at",),
    "skills_text": ("skills",),
    "salary_currency_raw": ("salary_currency",),
    "salary_period_raw": ("salary_period",),
    "job_words": (),
}
JOB_WORDS = ("job_family", "job_label", "category", "domaine", "filiere", "speciality")
AGAIN = ("title", "company_name", "location_label", "contract_type", "telework", "description", "published_at", "salary", "job_words")


def _raw(df: DataFrame, names: tuple[str, ...]) -> Column:
    there = [F.col(n) for n in names if n in df.columns]
    return text.or_chain(*there) if there else F.lit(None).cast("string")


def cleaned(df: DataFrame) -> DataFrame:
    """Adds c_<name> (cleaned) for each of TEXTS, c_<name>__re (cleaned twice) and f_<name> (folded) where needed."""
    cols = {f"c_{n}": _raw(df, raw) for n, raw in TEXTS.items() if n != "job_words"}
    words = [F.col(n) for n in JOB_WORDS if n in df.columns]
    cols["c_job_words"] = F.concat_ws(" ", *words) if words else F.lit("")
    out = text.clean_stage(df, cols, [f"c_{n}" for n in AGAIN])
    folded = {f"f_{n}": text.fold(F.col(f"c_{n}__re")) for n in AGAIN}
    folded["f_scope"] = text.fold(F.concat_ws(" ", "c_title__re", "c_job_words__re"))
    folded["f_skills_text"] = text.fold(F.col("c_skills_text"))
    out = out.withColumns({**folded, "__parts": text.split_parts(F.col("c_skills_text"))})
    # the second stage comes after folding: nothing is pushed or folded into one expression across it
    return text.clean_stage(out, {"__parts_clean": F.col("__parts")})


def normalized(df: DataFrame, as_of: datetime) -> DataFrame:
    """All canonical columns of raw offers ``df`` (cleaned already or not); ``as_of`` is what relative dates count from."""
    c = lambda n: F.col(f"c_{n}")
    f = lambda n: F.col(f"f_{n}")
    out = df if "f_title" in df.columns else cleaned(df)
    number = lambda n: fields.amount(text.squash(text.text(F.col(n)))) if n in df.columns else F.lit(None).cast("double")
    predicted = F.coalesce(F.col("salary_is_predicted").cast("int") != 0, F.lit(False)) if "salary_is_predicted" in df.columns else F.lit(False)
    out = out.withColumns({
        "skills_normalized": text.distinct_by_key(text.parts_of(F.col("__parts_clean")), text.fold),
        "contract_type_normalized": fields.contract_type(f("contract_type"), c("contract_type")),
        "telework_normalized": fields.telework(f("telework"), c("telework")),
        "url_canonical": text.canonical_url(c("url")),
        "__published": fields.published_timestamp(c("published_at"), f("published_at"), as_of),
        "__pay": fields.salary_struct(
            c("salary"), F.col("c_salary__re"), number("salary_min"), number("salary_max"), c("salary_currency_raw"), c("salary_period_raw"), f("salary")
        ),
        "title_normalized": f("title"),
        "company_normalized": f("company_name"),
        "location_normalized": f("location_label"),
        "title_signature": text.signature(f("title"), 6),
        "company_signature": text.signature(f("company_name"), 4),
        "location_signature": text.signature(f("location_label"), 4),
        "source_priority": fields.source_priority(F.col("source")),
    })
    out = out.withColumns({
        "published_date": fields.iso_date(F.col("__published")),
        "published_iso": fields.iso_text(F.col("__published")),
        "date_unparsed": fields.unparsed(c("published_at"), F.col("__published")),
        "salary_min_normalized": F.col("__pay.low"),
        "salary_max_normalized": F.col("__pay.high"),
        "salary_currency": F.col("__pay.currency"),
        "salary_period": F.col("__pay.period"),
        "salary_predicted": predicted,
    })
    weighed = {n: c(n) for n, _ in vocab.COMPLETENESS_WEIGHTS}
    has_bound = F.col("salary_min_normalized").isNotNull() | F.col("salary_max_normalized").isNotNull()
    out = out.withColumn("completeness_score", fields.completeness(weighed, F.size("skills_normalized"), has_bound, F.col("salary_predicted")))
    out = out.withColumn("record_preference_score", F.col("source_priority") + F.col("completeness_score"))
    return out.withColumn("normalization_status", F.lit("normalized")).drop("__published", "__pay", "__parts", "__parts_clean")
