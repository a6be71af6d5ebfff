"""Field-level normalisation: contracts, telework, dates, amounts, scores."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerweave.functions import vocab
from offerweave.functions.text import strip, text


def contract_type(folded: Column, cleaned: Column) -> Column:
    """First alias contained in the folded text, else the cleaned text."""
    chain = F.when(folded == "", "")
    for alias, value in vocab.CONTRACT_ALIASES:
        chain = chain.when(folded.contains(alias), value)
    return chain.otherwise(cleaned)


def _any_marker(folded: Column, markers) -> Column:
    found = folded.contains(markers[0])
    for m in markers[1:]:
        found = found | folded.contains(m)
    return found


def telework(folded: Column, cleaned: Column) -> Column:
    return (
        F.when(folded == "", "")
        .when(_any_marker(folded, vocab.REMOTE_MARKERS), "remote")
        .when(_any_marker(folded, vocab.HYBRID_MARKERS), "hybrid")
        .when(_any_marker(folded, vocab.ONSITE_MARKERS), "onsite")
        .otherwise(cleaned)
    )


_CLOCK = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
_ZONE = r"(?: ?(?:Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?))?"
_TIME = rf"(?:[T ]{_CLOCK}{_ZONE})?"
_MONTH = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
_DAY_NAME = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +)?"


def _to_ts(iso: Column) -> Column:
    """ISO-like text to timestamp; zones as Z, UTC, GMT, +02, +0200 or +02:00, blanks before them accepted."""
    tidy = F.regexp_replace(iso, r"(?<=:\d{2}(?:\.\d{1,9})?) ?(?:Z|UTC|GMT)\z", "Z")
    tidy = F.regexp_replace(tidy, r"(:\d{2}(?:\.\d{1,9})?) ?([+-]\d{2})\z", "$1$2:00")
    tidy = F.regexp_replace(tidy, r"(:\d{2}(?:\.\d{1,9})?) ?([+-]\d{2}):?(\d{2})\z", "$1$2:$3")
    return tidy.try_cast("timestamp")


def parse_timestamp(cleaned: Column, day_first: bool) -> Column:
    """Date layouts of offers, read as UTC; null for anything else (``unparsed`` counts those).

    Numeric dates prefer day or month first as told and swap when that is no valid date.
    """
    year_first = rf"\A(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}})({_TIME})\z"
    numeric = rf"\A(\d{{1,2}})[/.-](\d{{1,2}})[/.-](\d{{4}})({_TIME})\z"
    short = rf"\A(\d{{1,2}})[/.-](\d{{1,2}})[/.-](\d{{2}})({_TIME})\z"
    compact = r"\A(\d{4})(\d{2})(\d{2})(?:T(\d{2})(\d{2})(\d{2})?(Z|[+-]\d{2}:?\d{2})?)?\z"
    century = F.when(F.regexp_extract(cleaned, short, 3).try_cast("int") < 69, "20").otherwise("19")

    def both(pattern: str, year: Column) -> Column:
        part = lambda n: F.lpad(F.regexp_extract(cleaned, pattern, n), 2, "0")
        time = F.regexp_extract(cleaned, pattern, 4)
        dmy = _to_ts(F.concat(year, F.lit("-"), part(2), F.lit("-"), part(1), time))
        mdy = _to_ts(F.concat(year, F.lit("-"), part(1), F.lit("-"), part(2), time))
        return F.coalesce(dmy, mdy) if day_first else F.coalesce(mdy, dmy)

    def english(pattern: str, day: int, month: int) -> Column:
        name = F.initcap(F.substring(F.regexp_extract(cleaned, pattern, month), 1, 3))
        date = F.try_to_timestamp(
            F.concat_ws(" ", F.lpad(F.regexp_extract(cleaned, pattern, day), 2, "0"), name, F.regexp_extract(cleaned, pattern, 3)),
            F.lit("dd MMM yyyy"),
        )
        time = F.trim(F.regexp_extract(cleaned, pattern, 4))
        return F.when(time == "", date).otherwise(_to_ts(F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" "), time)))

    end = rf"(?:,?[T ]+({_CLOCK}{_ZONE}))?\z"
    english_dm = rf"(?i)\A{_DAY_NAME}(\d{{1,2}})[ -]({_MONTH})[ -,]+(\d{{4}}){end}"
    english_md = rf"(?i)\A{_DAY_NAME}({_MONTH})[ -](\d{{1,2}})[ ,]+(\d{{4}}){end}"
    ymd = F.concat(
        F.regexp_extract(cleaned, year_first, 1), F.lit("-"), F.lpad(F.regexp_extract(cleaned, year_first, 3), 2, "0"), F.lit("-"),
        F.lpad(F.regexp_extract(cleaned, year_first, 4), 2, "0"), F.regexp_extract(cleaned, year_first, 5),
    )
    clock = F.when(
        F.regexp_extract(cleaned, compact, 4) != "",
        F.concat(
            F.lit("T"), F.regexp_extract(cleaned, compact, 4), F.lit(":"), F.regexp_extract(cleaned, compact, 5), F.lit(":"),
            F.coalesce(F.nullif(F.regexp_extract(cleaned, compact, 6), F.lit("")), F.lit("00")), F.regexp_extract(cleaned, compact, 7),
        ),
    ).otherwise("")
    packed = F.concat(F.concat_ws("-", *[F.regexp_extract(cleaned, compact, n) for n in (1, 2, 3)]), clock)
    return (
        F.when(cleaned.rlike(year_first), _to_ts(ymd))
        .when(cleaned.rlike(numeric), both(numeric, F.regexp_extract(cleaned, numeric, 3)))
        .when(cleaned.rlike(short), both(short, F.concat(century, F.regexp_extract(cleaned, short, 3))))
        .when(cleaned.rlike(compact), _to_ts(packed))
        .when(cleaned.rlike(r"\A\d{4}(?:-\d{2})?\z"), _to_ts(cleaned))
        .when(cleaned.rlike(english_dm), english(english_dm, 1, 2))
        .when(cleaned.rlike(english_md), english(english_md, 2, 1))
    )


def unparsed(cleaned: Column, parsed: Column) -> Column:
    """True for a date text that is there and wasn't read."""
    return (cleaned != "") & parsed.isNull()


def iso_text(ts: Column) -> Column:
    """Timestamp as ISO text with UTC offset, microseconds only when present; null as ''."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, ".SSSSSS")
    return F.coalesce(
        F.concat(whole, F.when(micros == ".000000", "").otherwise(micros), F.lit("+00:00")),
        F.lit(""),
    )


def iso_date(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(""))


def published_timestamp(cleaned: Column, folded: Column, as_of: datetime) -> Column:
    """Relative French words count back from ``as_of``; everything else is parsed day first."""
    chain = F.when(cleaned == "", F.lit(None).cast("timestamp"))
    for word, days in vocab.RELATIVE_DAYS:
        chain = chain.when(
            folded == word, as_of_column(as_of) - F.make_dt_interval(F.lit(days))
        )
    return chain.otherwise(parse_timestamp(cleaned, day_first=True))


def as_of_column(as_of: datetime) -> Column:
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def amount(cleaned: Column) -> Column:
    """First number of a text, with optional k for thousands; null when there is none."""
    return _scaled(
        F.regexp_extract(cleaned, vocab.AMOUNT_PATTERN, 1),
        F.regexp_extract(cleaned, vocab.AMOUNT_PATTERN, 2),
    )


def _scaled(number: Column, k: Column) -> Column:
    value = F.replace(number, F.lit(","), F.lit(".")).try_cast("double")
    return F.when(k != "", value * 1000).otherwise(value)


def salary_struct(
    cleaned: Column,
    again: Column,
    low: Column,
    high: Column,
    currency: Column,
    period: Column,
    folded: Column,
) -> Column:
    """Bounds, currency and period from explicit values first, then from the label."""
    rng = vocab.AMOUNT_RANGE_PATTERN
    has_range = cleaned.rlike(rng)
    first = _scaled(F.regexp_extract(cleaned, rng, 1), F.regexp_extract(cleaned, rng, 2))
    second = _scaled(F.regexp_extract(cleaned, rng, 3), F.regexp_extract(cleaned, rng, 4))
    neither = low.isNull() & high.isNull()
    single = F.when(neither & (cleaned != ""), amount(again))
    lo = F.coalesce(low, F.when(has_range, first).otherwise(single))
    hi = F.coalesce(high, F.when(has_range, second).otherwise(single))
    swap = F.coalesce(lo > hi, F.lit(False))
    lo, hi = F.when(swap, hi).otherwise(lo), F.when(swap, lo).otherwise(hi)
    money = (
        F.when(currency != "", currency)
        .when(cleaned.contains("€") | folded.contains("euro"), "EUR")
        .otherwise("")
    )
    every = (
        F.when(period != "", period)
        .when(_any_marker(folded, vocab.MONTHLY_MARKERS), "monthly")
        .when(_any_marker(folded, vocab.YEARLY_MARKERS), "yearly")
        .when(cleaned.contains("k") & (lo >= 1000), "yearly")
        .otherwise("")
    )
    return F.struct(
        lo.alias("low"), hi.alias("high"), money.alias("currency"), every.alias("period")
    )


def completeness(fields: Mapping[str, Column], skill_count: Column, has_bound: Column, predicted: Column) -> Column:
    """Weighted count of filled fields; ``fields`` gives the cleaned column of each weighted name."""
    score = F.least(F.lit(3), skill_count)
    for name, weight in vocab.COMPLETENESS_WEIGHTS:
        score = score + F.when(fields[name] != "", weight).otherwise(0)
    return score + F.when(has_bound, 2).otherwise(0) - F.when(predicted, 1).otherwise(0)


def source_priority(source: Column) -> Column:
    chain = F.when(F.lit(False), 0)
    for name, value in vocab.SOURCE_PRIORITY.items():
        chain = chain.when(source == name, value)
    return chain.otherwise(0)


def plain_number(c: Column) -> Column:
    """A double as text with decimals and no exponent: 12000000.0."""
    whole = F.format_string("%d.0", c.cast("long"))
    return F.when(c == F.floor(c), whole).otherwise(F.regexp_replace(c.cast("decimal(28,6)").cast("string"), "0+$", ""))


def bounds_label(low: Column, high: Column, numeric: bool = False) -> Column:
    """'min - max', the one present, or ''; as numbers, 0 counts as missing."""
    if numeric:
        low, high = (F.when(c != 0, plain_number(c)) for c in (low, high))
    low, high = text(low), text(high)
    return (
        F.when((low != "") & (high != ""), F.concat(low, F.lit(" - "), high))
        .when(low != "", low)
        .otherwise(high)
    )


def storage_skills(skills: Column) -> Column:
    """Stripped exact-distinct non-blank list."""
    cleaned = F.transform(F.coalesce(skills, F.array().cast("array<string>")), lambda s: strip(text(s)))
    return F.array_distinct(F.filter(cleaned, lambda s: s != ""))


def storage_skills_of_text(skills: Column) -> Column:
    """A text is one skill, not a list of them."""
    return storage_skills(F.array(skills))


def amount_of_number(c: Column, kind: str) -> Column:
    """Typed amounts: booleans are none, NaN is missing."""
    if kind == "boolean":
        return F.lit(None).cast("double")
    return F.when(~F.isnan(c.cast("double")), c.cast("double"))
