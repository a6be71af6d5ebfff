"""Duplicate offers: block keys, equality classes, similar texts, leaders in preference order, and the merge.

Offers are taken in order of preference; each joins the first earlier leader that it matches, else becomes a leader.
Matching looks at addresses, normalised texts, signatures, place and date only, so offers that agree in all of
these (a *profile*) share their fate, and work is done once per profile. All but the address is the profile's *core*:
what matches by texts, place and date is told once per core, however many addresses it has. Ratios are found once per
pair of distinct texts, by a similarity join; places and dates then say which cores of two similar texts match. None
of this is written out as pairs: what matches as a whole shares a *hub* (see ``leaders``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerweave.functions import text, vocab
from offerweave.operators import similar
from offerweave.operators.leaders import assigned_by_core
from offerweave.operators.similar import Near, ratio  # noqa: F401
from offerweave.operators.tables import Workspace, written

CORE = ("title_normalized", "company_normalized", "title_signature", "company_signature", "location_signature", "published_date")
PROFILE = ("url_canonical", *CORE)


def preference(df: DataFrame) -> Column:
    """Orderable: the smallest comes first; ``ord`` tells input order."""
    return F.struct((-F.col("record_preference_score")).alias("p"), (-F.col("scope_score")).alias("s"), (-F.col("completeness_score")).alias("c"), F.col("ord").alias("ord"))


def _key(name: str, *parts: str) -> Column:
    filled = F.lit(True)
    for p in parts:
        filled = filled & (F.col(p) != "")
    return F.when(filled, F.concat(F.lit(f"{name}:"), F.concat_ws("|", *parts)))


def block_keys() -> Column:
    """Up to five keys; two offers are compared only if they share one."""
    return F.array_compact(
        F.array(
            _key("url", "url_canonical"),
            _key("title_company", "title_signature", "company_signature"),
            _key("title_date", "title_signature", "published_date"),
            _key("company_date", "company_signature", "published_date"),
            _key("title_location", "title_signature", "location_signature"),
        )
    )


def _signed() -> tuple[Column, Column]:
    """What texts are compared by: the signature, or the text where it has none."""
    return tuple(F.coalesce(F.nullif(F.col(f"{c}_signature"), F.lit("")), F.col(f"{c}_normalized")) for c in ("title", "company"))


def _class(name: str, last: str, meet: Column) -> Column:
    title, company = _signed()
    filled = (title != "") & (company != "") & (F.col(last) != "") & meet
    return F.when(filled, F.concat(F.lit(f"{name}:"), F.concat_ws("|", title, company, last)))


def core_keys() -> Column:
    """Keys whose equality alone makes duplicates, but for the address: both signatures with date or place.

    Offers are compared only within blocks, which ask for a signature: of the title for a place, of either for a date.
    """
    dated, placed = (F.col("title_signature") != "") | (F.col("company_signature") != ""), F.col("title_signature") != ""
    return F.array_compact(F.array(_class("date", "published_date", dated), _class("place", "location_signature", placed)))


def class_keys() -> Column:
    """The address and the keys of the core."""
    return F.concat(F.array_compact(F.array(_key("url", "url_canonical"))), core_keys())


def first_matches(df: DataFrame) -> DataFrame:
    """ord, first_ord: the most preferred offer before each that an equality rule links it with (null: none).

    The first offer of a key is looked up once per core; of each offer only its address and core are dealt.
    """
    rows = df.select("ord", preference(df).alias("at"), _key("url", "url_canonical").alias("own"), F.struct(*CORE).alias("core"))
    cores = rows.groupBy("core").agg(F.min("at").alias("first"))
    keys = cores.select("core", "first", *[F.col(f"core.{c}").alias(c) for c in CORE]).select("core", "first", F.explode(core_keys()).alias("key"))
    firsts = keys.groupBy("key").agg(F.min("first").alias("near"))
    by_core = keys.select("core", "key").join(firsts, "key").groupBy("core").agg(F.min("near").alias("near"))
    by_own = rows.where("own is not null").groupBy("own").agg(F.min("at").alias("near_own"))
    near = F.least("near", "near_own")
    met = rows.join(by_core, "core", "left").join(by_own, "own", "left").groupBy("ord").agg(F.min(F.when(near < F.col("at"), near)).alias("first"))
    return df.select("ord").join(met, "ord", "left").select("ord", F.col("first.ord").alias("first_ord"))


TEXTS = (Near("title_normalized", vocab.TITLE_RATIO_LOOSE), Near("company_normalized", vocab.COMPANY_RATIO))


def _both_ways(pairs: DataFrame) -> DataFrame:
    """Each pair (a, b) also as (b, a): blocks are matched leader first, and the ratio may differ."""
    swapped = [F.col(f"{c[:-1]}{'b' if c[-1] == 'a' else 'a'}").alias(c) if c[-2:] in ("_a", "_b") else F.col({"a": "b", "b": "a"}.get(c, c)).alias(c) for c in pairs.columns]
    return pairs.unionByName(pairs.select(*swapped))


def similar_texts(profiles: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(id, its columns) of each distinct title and employer; (a, b, title_ratio, company_ratio, ...) with a as leader.

    Pairs share the signature of one of the two, as every block but that of addresses asks, and both ratios reach
    what the looser rule needs.
    """
    columns = ["title_normalized", "company_normalized", "title_signature", "company_signature"]
    texts = profiles.where("title_normalized <> '' and company_normalized <> ''").select(*columns).distinct()
    texts = work.written(texts.withColumn("id", F.monotonically_increasing_id()))
    same = lambda c: (F.col(f"{c}_a") == F.col(f"{c}_b")) & (F.col(f"{c}_a") != "")
    met = similar.candidates(texts, TEXTS, work, same("title_signature") | same("company_signature"))
    met = met.withColumns({"by_title": same("title_signature"), "by_company": same("company_signature"), "one_company": F.col("company_normalized_a") == F.col("company_normalized_b")})
    met = met.drop(*[f"{c}_signature_{s}" for c in ("title", "company") for s in "ab"])
    met = similar.with_ratios(_both_ways(met), ("title_normalized", "company_normalized"))
    met = met.withColumnsRenamed({"title_normalized_ratio": "title_ratio", "company_normalized_ratio": "company_ratio"})
    return texts, met.where((F.col("title_ratio") >= vocab.TITLE_RATIO_LOOSE) & (F.col("company_ratio") >= vocab.COMPANY_RATIO))


def similar_places(profiles: DataFrame, work: Workspace) -> DataFrame:
    """(place, other, near): places of a leader and of another that reach the looser ratio; near: the stricter one."""
    places = profiles.where("location_signature <> ''").select(F.col("location_signature").alias("place")).distinct()
    places = work.written(places.withColumn("id", F.monotonically_increasing_id()))
    met = _both_ways(similar.candidates(places, (Near("place", vocab.LOCATION_RATIO, 2),), work))
    met = similar.with_ratios(met.withColumns({"place": F.col("place_a"), "other": F.col("place_b")}), ("place",)).where(F.col("place_ratio") >= vocab.LOCATION_RATIO)
    met = met.select("place", "other", (F.col("place_ratio") >= vocab.LOCATION_RATIO_STRICT).alias("near"))
    return work.written(met.unionByName(places.select("place", F.col("place").alias("other"), F.lit(True).alias("near"))))


def text_hubs(cores: DataFrame, work: Workspace) -> DataFrame:
    """Hubs (key, core, gives, takes) of what matches by ratios: cores of one text, or of two similar ones.

    In a hub the cores of side a are leaders to those of side b. Offers of similar texts match when dates are equal,
    or the block they share doesn't ask for that: a blank date, or a similar place, will do. Hubs are as many as
    cores have links of their text; rows of a hub are its cores, never their pairs.
    """
    texts, pairs = similar_texts(cores, work)
    strict = F.col("title_ratio") >= vocab.TITLE_RATIO_STRICT
    own = texts.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(True).alias("strict"), (F.col("title_signature") != "").alias("by_title"), (F.col("company_signature") != "").alias("by_company"))
    links = pairs.where(strict | F.col("one_company")).select("a", "b", strict.alias("strict"), "by_title", "by_company").unionByName(own.where("by_title or by_company"))
    links = work.written(links.withColumn("both", F.col("by_title") & F.col("by_company")))
    named = cores.select("core", "title_normalized", "company_normalized", F.col("published_date").alias("day"), F.col("location_signature").alias("place"))
    named = named.join(texts.select("id", "title_normalized", "company_normalized"), ["title_normalized", "company_normalized"]).select("id", "core", "day", "place")
    sides = [links.join(named, links[s] == named["id"]).select(F.concat_ws(">", "a", "b").alias("link"), F.lit(s).alias("side"), "strict", "by_title", "both", "core", "day", "place") for s in "ab"]
    rows = work.written(sides[0].unionByName(sides[1]))
    hub = lambda name, *parts: F.concat_ws("|", F.lit(name), *parts)
    on_a, blank = F.col("side") == "a", F.col("day") == ""
    blanks = lambda when, name, *parts: (F.when(when & (~on_a | blank), hub(f"{name} a", *parts)), F.when(when & (on_a | blank), hub(f"{name} b", *parts)))
    plain = (
        F.when(F.col("strict") & ~blank, hub("day", "day")),
        *blanks(F.col("strict") & F.col("both"), "blank"),
        F.when(F.col("strict") & F.col("by_title") & (F.col("place") != ""), hub("place", "place")),
    )
    # where a rule compares places: a's place with the similar ones, b's place as one of those of a
    near = similar_places(cores, work)
    ways = [near.select(F.lit(s).alias("side"), F.col(c).alias("place"), F.concat_ws("~", "place", "other").alias("met"), "near", (F.col("place") == F.col("other")).alias("equal")) for s, c in (("a", "place"), ("b", "other"))]
    placed = rows.where("both or not strict").join(ways[0].unionByName(ways[1]), ["side", "place"])
    by_place = (
        F.when(F.col("strict") & F.col("both") & ~F.col("equal"), hub("places", "met")),
        F.when(~F.col("strict") & F.col("near") & ~blank, hub("day place", "day", "met")),
        *blanks(~F.col("strict") & F.col("near") & F.col("both"), "place blank", "met"),
    )
    told = lambda df, hubs: df.select(F.explode(F.array_compact(F.array(*hubs))).alias("hub"), "link", "side", "core")
    hubs = told(rows, plain).unionByName(told(placed, by_place))
    return hubs.select(F.concat_ws(" ", "link", "hub").alias("key"), "core", on_a.alias("gives"), (~on_a).alias("takes"))


def leaders(df: DataFrame) -> DataFrame:
    """ord, leader_ord for each canonical offer with scope_score and ord. Addresses and dates that a leader gains
    by merging aren't matched again."""
    own = df.select("ord", preference(df).alias("at"), *PROFILE)
    with Workspace(df.sparkSession) as work:
        # a profile's number is the ord of its first offer
        profiles = work.written(own.groupBy(*PROFILE).agg(F.min("at").alias("at")).withColumn("profile", F.col("at.ord")))
        cores = work.written(profiles.select(*CORE).distinct().withColumn("core", F.monotonically_increasing_id()))
        classes = cores.select(F.explode(core_keys()).alias("key"), "core", F.lit(True).alias("gives"), F.lit(True).alias("takes"))
        links = work.written(classes.unionByName(text_hubs(cores, work)))
        nodes = work.written(profiles.join(cores, list(CORE)).select("profile", "at", "core", _key("url", "url_canonical").alias("own")))
        decided = assigned_by_core(nodes, links, work)
        matched = own.join(profiles.select(*PROFILE, "profile"), list(PROFILE)).select("ord", "profile", *PROFILE)
        # without an address, offers that share no block or lack title or company match nothing, not even their like
        textless = (F.col("title_normalized") == "") | (F.col("company_normalized") == "") | (F.size(block_keys()) == 0)
        alone = (F.col("url_canonical") == "") & textless
        return written(matched.join(decided, "profile").select("ord", F.when(alone, F.col("ord")).otherwise(F.col("leader")).alias("leader_ord")))


#: Columns that take the first value in order that isn't blank; those of the second line only where offers have them.
FILLED = ("c_title", "c_company_name", "c_location_label", "c_contract_type", "contract_type_normalized", "telework_normalized", "published_iso", "published_date", "c_url", "url_canonical", "salary_currency", "salary_period")
ALSO_FILLED = ("application_deadline", "application_url", "job_family", "job_label", "job_code", "category")
BEST = ("c_description", "c_salary")
LISTS = ("duplicate_sources", "duplicate_origin_sources", "duplicate_external_ids", "skills_normalized")


def _origin(df: DataFrame) -> Column:
    own = text.squash(text.text(F.col("origin_source"))) if "origin_source" in df.columns else F.lit("")
    return F.coalesce(F.nullif(own, F.lit("")), F.col("source"))


def merged_lists(rows: DataFrame) -> DataFrame:
    """leader_ord and LISTS: each value once, where it comes first in order of preference; skills by their folded text.

    Values are made distinct before they are put together, so a group that repeats its values stays small.
    """
    one = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("key"), F.lit(0).alias("n"), value.alias("value"))
    skills = F.transform("skills_normalized", lambda s, n: F.struct(F.lit(3).alias("kind"), text.fold(s).alias("key"), n.alias("n"), s.alias("value")))
    told = F.concat(F.array(one(0, F.col("source")), one(1, _origin(rows)), one(2, F.col("c_external_id"))), skills)
    values = rows.select("leader_ord", "at", F.explode(told).alias("v")).select("leader_ord", "at", "v.*").where("key <> ''")
    first = values.groupBy("leader_ord", "kind", "key").agg(F.min(F.struct("at", "n", "value")).alias("first"))
    lists = [F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("first")))), lambda x: x["value"]).alias(c) for k, c in enumerate(LISTS)]
    return first.groupBy("leader_ord").agg(*lists)


def merged_pay(rows: DataFrame) -> DataFrame:
    """leader_ord and the salary that is left when offers are merged one by one.

    Going through a group in order, a salary is replaced when its lower bound is missing and the next one has one, or
    when it is predicted and the next one isn't. So the first real salary with a lower bound stays for good; without
    one, predicted salaries with a bound and real ones without replace each other, and the first of the last run stays.
    Both are found by aggregates, whatever the size of a group.
    """
    bound, predicted = F.col("salary_min_normalized").isNotNull(), F.col("salary_predicted")
    kind = F.when(bound & ~predicted, "real").when(bound, "predicted").when(~predicted, "none").otherwise("neither")
    slim = rows.select("leader_ord", "at", kind.alias("kind"), F.struct("salary_min_normalized", "salary_max_normalized", "salary_predicted").alias("pay"))
    of = lambda kind: F.when(F.col("kind") == kind, F.col("at"))
    ends = slim.groupBy("leader_ord").agg(F.min("at").alias("first"), F.min(of("real")).alias("real"), F.max(of("predicted")).alias("p"), F.max(of("none")).alias("n"))
    last = F.when(F.col("p").isNull() & F.col("n").isNull(), None).when(F.col("n").isNull() | (F.col("p") > F.col("n")), "predicted").otherwise("none")
    # the run begins after the last one of the other kind
    ends = ends.select("leader_ord", "first", "real", last.alias("last"), F.when(F.col("p") > F.col("n"), F.col("n")).when(F.col("n") > F.col("p"), F.col("p")).alias("after"))
    here = (
        F.when(F.col("real").isNotNull(), F.col("at") == F.col("real"))
        .when(F.col("last").isNull(), F.col("at") == F.col("first"))
        .otherwise((F.col("kind") == F.col("last")) & (F.col("after").isNull() | (F.col("at") > F.col("after"))))
    )
    return slim.join(ends, "leader_ord").where(here).groupBy("leader_ord").agg(F.min_by("pay", "at").alias("pay")).select("leader_ord", "pay.*")


def merged(df: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per leader: first non-blank fields in order of preference, longest texts, merged lists and salary.

    Everything is an aggregate of its own column, so no group is ever gathered into one row.
    """
    rows = df.join(groups, "ord").withColumn("at", preference(df))
    first = lambda c: F.coalesce(F.min_by(F.when(text.strip(F.col(c)) != "", F.col(c)), F.when(text.strip(F.col(c)) != "", F.col("at"))), F.lit("")).alias(c)
    ahead = F.struct((-F.col("at.p")).alias("p"), (-F.col("at.s")).alias("s"), (-F.col("at.c")).alias("c"), (-F.col("at.ord")).alias("o"))
    aggregates = [
        F.count("*").alias("duplicate_count"),
        *[first(c) for c in FILLED],
        *[first(c) for c in ALSO_FILLED if c in df.columns],
        *[F.coalesce(F.max_by(c, F.struct(F.length(c).alias("size"), ahead.alias("ahead"))), F.lit("")).alias(c) for c in BEST],
        F.max("completeness_score").alias("completeness_score"),
        F.max("record_preference_score").alias("record_preference_score"),
        F.max("scope_score").alias("best_scope_score"),
        F.when(F.count("*") > 1, "merged_duplicate").otherwise("unique").alias("deduplication_status"),
    ]
    return rows.groupBy("leader_ord").agg(*aggregates).join(merged_lists(rows), "leader_ord").join(merged_pay(rows), "leader_ord")
