"""Leaders and merge against a sequential model."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from offerweave.operators import dedup
from offerweave.operators.leaders import assigned, assigned_by_core
from offerweave.operators.tables import Workspace

COLUMNS = "ord long, record_preference_score int, scope_score int, completeness_score int, " + ", ".join(f"{c} string" for c in dedup.PROFILE)


def row(n, url="", title="", company="", place="", date="", pref=0):
    sig = lambda s, k: " ".join([w for w in s.split() if len(w) > 1][:k])
    return (n, pref, 0, 0, url, title, company, sig(title, 6), sig(company, 4), place, date)


def model(rows):
    order = sorted(rows, key=lambda r: (-r[1], -r[2], -r[3], r[0]))
    leaders, out = [], {}

    def blocks(r):
        _, _, _, _, url, _, _, ts, cs, ls, d = r
        return {
            k
            for k, parts in {("u", url): [url], ("tc", ts, cs): [ts, cs], ("td", ts, d): [ts, d], ("cd", cs, d): [cs, d], ("tl", ts, ls): [ts, ls]}.items()
            if all(parts)
        }

    def match(a, b):
        if a[4] and a[4] == b[4]:
            return True
        signed = lambda x: (x[7] or x[5], x[8] or x[6])
        if all(signed(a)) and signed(a) == signed(b) and ((a[10] and a[10] == b[10]) or (a[9] and a[9] == b[9])):
            return True
        t, c, p = dedup.ratio(a[5], b[5]), dedup.ratio(a[6], b[6]), dedup.ratio(a[9], b[9])
        dates = not a[10] or not b[10] or a[10] == b[10]
        return (t >= 0.97 and c >= 0.94 and (p >= 0.85 or dates)) or (t >= 0.94 and c == 1 and p >= 0.90 and dates)

    for r in order:
        found = next((x for x in leaders if blocks(x) & blocks(r) and match(x, r)), None)
        if found is None:
            leaders.append(r)
        out[r[0]] = (found or r)[0]
    return out


def got(spark, rows, partitions=4):
    df = spark.createDataFrame(rows, COLUMNS).repartition(partitions)
    return {r["ord"]: r["leader_ord"] for r in dedup.leaders(df).collect()}


SCENES = {
    "same address": [row(0, url="u", title="a b"), row(1, url="u", title="c d")],
    "same date": [row(0, title="data eng", company="acme", date="2024-01-01", place="paris"), row(1, title="data eng", company="acme", date="2024-01-01", place="lyon")],
    "same place": [row(0, title="data eng", company="acme", date="2024-01-01", place="paris"), row(1, title="data eng", company="acme", date="2024-01-02", place="paris")],
    "nothing in common": [row(0, title="data eng", company="acme", date="2024-01-01"), row(1, title="data eng", company="acme", date="2024-01-02")],
    "one date blank": [row(0, title="data eng", company="acme", date="2024-01-01"), row(1, title="data eng", company="acme")],
    "chain": [row(0, url="u", title="x", pref=3), row(1, url="u", title="senior lead data engineer paris", company="acme", date="d", pref=2), row(2, title="senior lead data engineer paris", company="acme", date="d", pref=1)],
    "no text": [row(0), row(1), row(2, title="a")],
    "ties": [row(k, title="data eng", company="acme", date="d") for k in range(5)],
    "near titles": [row(0, title="senior data engineer platform team one", company="acme", date="d"), row(1, title="senior data engineer platform team ones", company="acme", date="d")],
}


@pytest.mark.parametrize("name", SCENES)
def test_scenes(spark, name):
    assert got(spark, SCENES[name]) == model(SCENES[name])


NEAR = ["data engineer spark team lead paris", "data engineer spark team leads paris", "data engineer spark teams lead paris", "data engineer", "", "x y", "h/f"]


def random_rows(seed, n):
    draw = random.Random(seed)
    return [
        row(
            k,
            url=draw.choice(["", "", "", "", "u1", "u2"]),
            title=draw.choice(NEAR),
            company=draw.choice(["", "acme group france services", "acme groupe france services", "acme group france service", "other", "a"]),
            place=draw.choice(["", "paris nord", "paris nords", "lyon"]),
            date=draw.choice(["", "d1", "d2"]),
            pref=draw.randrange(4),
        )
        for k in range(n)
    ]


@pytest.mark.parametrize("partitions", [1, 7])
def test_random_rows_on_several_partitions(spark, partitions):
    rows = random_rows(7, 160)
    assert got(spark, rows, partitions) == model(rows)


def test_rounds_and_connected_parts_alone(spark, monkeypatch):
    """Without the one task that ends it: rounds, and parts of bounded size in tasks of their own."""
    rows = random_rows(8, 120)
    links, order = [], sorted(rows, key=lambda r: (-r[1], r[0]))
    draw = random.Random(1)
    for k in range(0, 120, 12):  # ten chains, and stars that two sides share
        own = order[k : k + 12]
        links += [(f"{a[0]}>{b[0]}", x[0], (-x[1], x[0]), x is a, x is b) for a, b in zip(own, own[1:], strict=False) for x in (a, b)]
        links += [(f"s{k}", x[0], (-x[1], x[0]), draw.random() < 0.5, draw.random() < 0.5) for x in own]
    df = spark.createDataFrame(links, "key string, profile long, at struct<p:int,ord:long>, gives boolean, takes boolean")
    want = greedy(links)
    for one_task, rounds in ((0, 1000), (30, 1), (10**6, 4)):
        with Workspace(spark) as work:
            assert {r["profile"]: r["leader"] for r in assigned(df, work, one_task, rounds).collect()} == want


def greedy(links):
    order = {p: at for _, p, at, _, _ in links}
    done: dict = {}
    for p in sorted(order, key=order.get):
        mine = {k for k, q, _, _, takes in links if q == p and takes}
        before = [q for k, q, at, gives, _ in links if gives and k in mine and at < order[p] and done.get(q) == q]
        done[p] = min(before, key=order.get) if before else p
    return done


def test_long_chain_takes_bounded_time(spark):
    """2,000 profiles of which each matches the one before: every second one leads, in a handful of jobs."""
    links = [(f"k{k}", p, (p,), p == k, p == k + 1) for k in range(1999) for p in (k, k + 1)]
    df = spark.createDataFrame(links, "key string, profile long, at struct<ord:long>, gives boolean, takes boolean")
    with Workspace(spark) as work:
        start = time.time()
        got = {r["profile"]: r["leader"] for r in assigned(df, work).collect()}
        assert time.time() - start < 120
    assert got == {p: p - p % 2 for p in range(2000)}


# --- merge -------------------------------------------------------------------------------------------------------------
def merge_in_order(rows):
    """One offer after another into the first."""
    out = dict(rows[0], sources=[rows[0]["source"]], ids=[], skills=[], keys=set())
    for k, r in enumerate(rows):
        if r["source"] not in out["sources"]:
            out["sources"].append(r["source"])
        if r["c_external_id"] and r["c_external_id"] not in out["ids"]:
            out["ids"].append(r["c_external_id"])
        for s in r["skills_normalized"]:
            if s.lower().replace("é", "e") not in out["keys"]:
                out["keys"].add(s.lower().replace("é", "e"))
                out["skills"].append(s)
        if not k:
            continue
        for c in (*dedup.FILLED, "job_code"):
            if not out[c].strip():
                out[c] = r[c]
        for c in dedup.BEST:
            if len(r[c]) > len(out[c]):
                out[c] = r[c]
        if (out["salary_min_normalized"] is None and r["salary_min_normalized"] is not None) or (out["salary_predicted"] and not r["salary_predicted"]):
            for c in ("salary_min_normalized", "salary_max_normalized", "salary_predicted"):
                out[c] = r[c]
    return out


def test_merge_equals_one_after_another(spark):
    draw = random.Random(3)
    rows, leaders = [], []
    for k in range(400):
        texts = {c: draw.choice(["", " ", f"{c}{draw.randrange(9)}"]) for c in (*dedup.FILLED, *dedup.BEST, "job_code")}
        texts["c_description"] = "d" * draw.randrange(4) + str(draw.randrange(3))
        low = draw.choice([None, None, float(draw.randrange(5))])
        rows.append({"ord": k, "source": draw.choice("abc"), "c_external_id": draw.choice(["", f"e{draw.randrange(4)}"]), **texts,
                     "salary_min_normalized": low, "salary_max_normalized": draw.choice([None, 9.0, 8.0]), "salary_predicted": draw.random() < 0.5,
                     "skills_normalized": draw.sample(["Réseaux", "reseaux", "SQL", "sql", "Go"], draw.randrange(4)),
                     "record_preference_score": draw.randrange(3), "scope_score": draw.randrange(2), "completeness_score": draw.randrange(2)})
        leaders.append((k, draw.randrange(60)))
    schema = ", ".join(["ord long", "source string", "c_external_id string", *[f"{c} string" for c in (*dedup.FILLED, *dedup.BEST, "job_code")], "salary_min_normalized double", "salary_max_normalized double", "salary_predicted boolean", "skills_normalized array<string>", "record_preference_score int", "scope_score int", "completeness_score int"])
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    got = {r["leader_ord"]: r.asDict() for r in dedup.merged(df, spark.createDataFrame(leaders, "ord long, leader_ord long")).collect()}
    groups: dict = {}
    for r in sorted(rows, key=lambda r: (-r["record_preference_score"], -r["scope_score"], -r["completeness_score"], r["ord"])):
        groups.setdefault(leaders[r["ord"]][1], []).append(r)
    assert set(got) == set(groups)
    for leader, own in groups.items():
        want, mine = merge_in_order(own), got[leader]
        assert (mine["duplicate_sources"], mine["duplicate_external_ids"], mine["skills_normalized"]) == (want["sources"], want["ids"], want["skills"])
        assert mine["duplicate_origin_sources"] == want["sources"]
        assert [mine[c].strip() for c in (*dedup.FILLED, "job_code", *dedup.BEST)] == [want[c].strip() for c in (*dedup.FILLED, "job_code", *dedup.BEST)]
        assert [mine[c] for c in ("salary_min_normalized", "salary_max_normalized", "salary_predicted")] == [want[c] for c in ("salary_min_normalized", "salary_max_normalized", "salary_predicted")]
        assert mine["duplicate_count"] == len(own) and mine["record_preference_score"] == max(r["record_preference_score"] for r in own)


def test_final_dataset_merges_whole_groups(spark, sf_dir):
    from offerweave.operators import scope
    from offerweave.plans import catalogue

    out = catalogue.final_dataset(spark, sf_dir)
    total = out.agg(F.sum("duplicate_count").alias("n"), F.count("*").alias("k"), F.count_distinct("leader_ord").alias("d")).first()
    kept = scope.kept(catalogue.offers(spark, sf_dir)).count()
    assert total["n"] == kept
    assert total["k"] == total["d"] < kept


@pytest.mark.parametrize(("one_task", "rounds"), [(0, 1000), (30, 2), (10**6, 12)])
def test_leaders_by_core_equal_one_after_another(spark, one_task, rounds):
    """Cores of several profiles with addresses of their own: rounds, the rest profile by profile, and both."""
    draw = random.Random(5)
    links = [(f"h{draw.randrange(14)}", c, *draw.choice([(True, True), (True, False), (False, True)])) for c in range(12) for _ in range(2)]
    nodes = [(p, (draw.randrange(9), p), draw.randrange(13), draw.choice([None, None, f"u{draw.randrange(12)}"])) for p in range(150)]
    flat = [(key, p, at, gives, takes) for p, at, core, _ in nodes for key, c, gives, takes in links if c == core]
    flat += [(own or f"none {p}", p, at, True, True) for p, at, _, own in nodes]
    with Workspace(spark) as work:
        of = spark.createDataFrame(nodes, "profile long, at struct<p:int,ord:long>, core long, own string")
        got = assigned_by_core(of, spark.createDataFrame(links, "key string, core long, gives boolean, takes boolean"), work, one_task, rounds)
        assert {r["profile"]: r["leader"] for r in got.collect()} == greedy(flat)


def test_hubs_do_not_grow_with_addresses(spark):
    """Offers of one core at many addresses: the rows that tell what texts match are those of one core."""
    cores = spark.createDataFrame([row(k, url=f"u{k}", title="data eng", company="acme", date="d") for k in range(200)], COLUMNS)
    with Workspace(spark) as work:
        told = dedup.text_hubs(cores.select(*dedup.CORE).distinct().withColumn("core", F.lit(0).cast("long")), work)
        assert "profile" not in told.columns and told.count() < 10
