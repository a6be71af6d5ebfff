"""The offers table by buckets, history by month, and landed snapshots."""

from __future__ import annotations

import hashlib
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from offerweave.functions import fields
from offerweave.operators import ingest, store

AS_OF = datetime(2024, 6, 15)
SCHEMA = "ord long, source string, external_id string, title string"


def digests(path):
    return {p.relative_to(path).as_posix(): hashlib.md5(p.read_bytes()).hexdigest() for p in Path(path).rglob("*.parquet")}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "offers")
    table = store.OffersTable(spark, path, buckets=16)
    first = spark.range(200).selectExpr("'bpce' AS source", "concat('e', id) AS external_id", "'old' AS title", "timestamp'2024-06-01' AS imported_at", "timestamp'2024-06-01' AS updated_at")
    table.create(first)
    before = digests(path)
    batch = spark.createDataFrame([(1, "bpce", "e7", "lost"), (2, "bpce", "e7", "new"), (3, "bpce", "fresh", "new")], SCHEMA).withColumn("category", F.lit("C"))
    assert table.upsert(batch, AS_OF) == 3
    after = digests(path)
    own = table.read().selectExpr("external_id", f"pmod(xxhash64('bpce', external_id), 16) AS b").where("external_id in ('e7', 'fresh')").collect()
    touched = {f"bucket={r['b']}" for r in own}
    kept = {k: v for k, v in before.items() if k.split("/")[0] not in touched}
    assert kept and all(after[k] == v for k, v in kept.items())
    assert all(k.split("/")[0] in touched for k in set(after) - set(before))
    rows = {r["external_id"]: r for r in table.read().collect()}
    assert len(rows) == 201
    assert (rows["e7"]["title"], rows["e7"]["category"], rows["e7"]["imported_at"], rows["e7"]["updated_at"]) == ("new", "C", datetime(2024, 6, 1), AS_OF)
    assert (rows["fresh"]["title"], rows["fresh"]["imported_at"]) == ("new", AS_OF)
    assert (rows["e8"]["title"], rows["e8"]["category"], rows["e8"]["updated_at"]) == ("old", None, datetime(2024, 6, 1))
    assert table.upsert(batch.where("ord > 9"), AS_OF) == 0 and digests(path) == after


def test_history_reads_the_months_it_needs(spark, tmp_path):
    days = [None, *[AS_OF - timedelta(days=k, hours=k) for k in range(0, 400, 3)]]
    rows = spark.createDataFrame([(k, "bpce", f"e{k:03}", d, AS_OF - timedelta(days=k % 2)) for k, d in enumerate(days)], "ord long, source string, external_id string, published_at timestamp, imported_at timestamp")
    table = store.HistoryTable(spark, str(tmp_path / "history"))
    table.create(rows)
    plan = table.recent(AS_OF, 30)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    got = table.in_order(AS_OF, 30).orderBy("rank").collect()
    want = sorted((r for r in rows.collect() if r["published_at"] is None or r["published_at"] >= AS_OF - timedelta(days=30)), key=lambda r: (r["published_at"] is None, -(r["published_at"] or AS_OF).timestamp()))
    assert [(r["rank"], r["external_id"]) for r in got] == [(k + 1, r["external_id"]) for k, r in enumerate(want)]
    assert table.recent(AS_OF, -5).count() == 2  # no days: what has no date, and what is of that very moment


@pytest.mark.parametrize(
    ("payload", "want"),
    [
        ('{"bpce": [{"title": "a"}, {"title": "b", "extra": [1]}]}', {"kept": 2}),
        ('{"bpce": [{"title": "a"}, 5, null, "x"], "other": [{}], "notes": {"a": 1}, "adzuna": []}', {"kept": 1, "not_a_row": 3, "unknown_source": 1, "not_a_list": 1, "empty_list": 1}),
        ("[1]", {"bad_payload": 1}),
        ("{cut", {"bad_payload": 1}),
        (None, {"bad_payload": 1}),
        ("null", {"bad_payload": 1}),
        ("{}", {}),
    ],
)
def test_every_row_of_a_payload_has_a_status(spark, payload, want):
    rows = ingest.snapshot_rows(spark.createDataFrame([(1, payload)], "g int, payload string"))
    assert {r["status"]: r["n"] for r in ingest.statuses(rows).collect()} == want


def test_objects_in_place_of_lists(spark):
    """Whatever it holds, a source without a list is told once; blanks may stand before a payload."""
    payload = ' \n\t{"bpce": {"a": 1, "b": {"c": [2]}}, "adzuna": {}, "x": "text", "y": null, "z": []}'
    rows = ingest.snapshot_rows(spark.createDataFrame([(1, payload)], "g int, payload string"))
    got = {r["source"]: (r["status"], r["place"], r["row"]) for r in rows.collect()}
    assert rows.count() == 5 and got == {n: ("empty_list" if n == "z" else "not_a_list", None, None) for n in ("bpce", "adzuna", "x", "y", "z")}


def test_no_schema_of_a_whole_payload(spark):
    """Telling the kind of a payload by its schema reads all rows of all its lists."""
    rows = ingest.snapshot_rows(spark.createDataFrame([(1, "{}")], "g int, payload string"))
    assert "schema_of_variant(__v" not in rows._jdf.queryExecution().analyzed().toString()


def test_unlike_schemas_become_one(spark):
    payload = '{"bpce": [{"external_id": 7, "title": "A", "skills": ["x", "y"], "salary_is_predicted": true}], "adzuna": [{"title": "B", "company": "C", "skills": "one", "source": "adzuna", "published_at": "2024-06-02"}]}'
    rows = ingest.offers_of(ingest.snapshot_rows(spark.createDataFrame([(payload,)], "payload string")), F.lit(1))
    got = {r["source"]: r for r in store.storage_rows(rows).collect()}
    assert (got["bpce"]["external_id"], got["bpce"]["skills"], got["bpce"]["salary_is_predicted"]) == ("7", ["x", "y"], 1)
    assert (got["adzuna"]["company_name"], got["adzuna"]["skills"], got["adzuna"]["published_at"]) == ("C", ["one"], datetime(2024, 6, 2))
    assert got["adzuna"]["external_id"].startswith("fallback_")
    assert set(store.TEXTS) <= set(got["bpce"].asDict())


def test_sources_that_are_not_chosen_are_not_read(spark):
    called = []

    def reader(name):
        def read():
            called.append(name)
            return spark.createDataFrame([(name, 1)], f"source string, {name}_only int")

        return read

    out = ingest.collected({n: reader(n) for n in ("bpce", "adzuna", "france_travail")}, only=("bpce", "france_travail"))
    assert called == [n for n in ("france_travail", "bpce") if n in called] and len(called) == 2
    assert sorted(out.columns) == ["bpce_only", "france_travail_only", "source"] and out.count() == 2
    with pytest.raises(ValueError):
        ingest.collected({}, only=("bpce",))
