"""What the store moves and leaves behind on disk, and which rows an upsert gives for repeated and null keys."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from offerweave.operators import store, tables
from offerweave.plans import catalogue

AS_OF, JUNE = datetime(2024, 6, 15), datetime(2024, 6, 1)
KEYED = "source string, external_id string, title string"


def test_whole_rows_are_dealt_once(spark, tmp_path):
    """Choice of the last row, meeting of old rows and deal to buckets share one exchange."""
    path = str(tmp_path / "offers")
    table = store.OffersTable(spark, path, buckets=4)
    rows = spark.createDataFrame([(k, "bpce", f"e{k % 7}", f"t{k}") for k in range(20)], f"ord long, {KEYED}").withColumns({"imported_at": F.lit(JUNE), "updated_at": F.lit(JUNE)})
    table.create(rows, "ord")
    assert sorted((r["external_id"], r["title"]) for r in table.read().collect()) == sorted((f"e{k % 7}", f"t{k}") for k in range(13, 20))
    assert "ord" not in table.read().columns
    old, batch = spark.read.parquet(path), rows.drop("imported_at", "updated_at").withColumn("bucket", F.lit(0))
    plan = store.upsert(old, batch, AS_OF, lambda x: x.repartition(4, "bucket"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan and "Aggregate" not in plan


def test_keys_that_repeat_or_are_null(spark):
    """An old row that comes twice stays twice and is replaced twice; null keys meet nothing, but one of their new rows stays."""
    old = spark.createDataFrame([("s", "a", "old", "x"), ("s", "a", "old", "y"), ("s", "b", "old", "z"), ("s", None, "old", "n")], f"{KEYED}, mine string").withColumns({"bucket": F.lit(0), "imported_at": F.lit(JUNE), "updated_at": F.lit(JUNE)})
    new = spark.createDataFrame([(1, "s", "a", "lost", 1), (2, "s", "a", None, 2), (3, "s", None, "m1", 3), (4, "s", None, "m2", 4), (5, "s", "c", "new", 5)], f"ord long, {KEYED}, added int").withColumn("bucket", F.lit(0))
    got = store.upsert(old, new, AS_OF, lambda x: x.repartition(2, "bucket")).collect()
    told = sorted((str(r["external_id"]), str(r["title"]), str(r["mine"]), str(r["added"]), r["imported_at"], r["updated_at"]) for r in got)
    assert told == [
        ("None", "m2", "None", "4", AS_OF, AS_OF),
        ("None", "old", "n", "None", JUNE, JUNE),
        ("a", "None", "x", "2", JUNE, AS_OF),
        ("a", "None", "y", "2", JUNE, AS_OF),
        ("b", "old", "z", "None", JUNE, JUNE),
        ("c", "new", "None", "5", AS_OF, AS_OF),
    ]


def test_a_bucket_that_cannot_be_replaced_stays(spark, tmp_path):
    table = store.OffersTable(spark, str(tmp_path / "offers"), buckets=1)
    rows = spark.createDataFrame([("s", "a", "old")], KEYED).withColumns({"imported_at": F.lit(JUNE), "updated_at": F.lit(JUNE)})
    table.create(rows)
    with pytest.raises(Exception):  # noqa: B017  there is no new folder
        table._put_in_place(str(tmp_path / "offers/_upsert-x"), [0])
    assert [r["title"] for r in table.read().collect()] == ["old"]
    assert table.upsert(rows.select(F.lit(1).alias("ord"), "source", "external_id", F.lit("new").alias("title")), AS_OF) == 1
    assert [r["title"] for r in table.read().collect()] == ["new"]


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.length()))


def test_written_tables_leave_no_shuffle_files(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(tables._CLEANUP)
    out = tables.written(spark.range(1000).repartition(3, "id"))
    assert _shuffle_files(spark) <= before and out.count() == 1000
    assert spark.conf.get(tables._CLEANUP) == setting


def test_the_bridge_is_read_once(spark, sf_dir, monkeypatch):
    """The portal's rows are made of the landed offers, so the bridge's joins aren't run a second time."""
    made, calls = catalogue.bridge.offers, []
    monkeypatch.setattr(catalogue.bridge, "offers", lambda *of: calls.append(of) or made(*of))
    assert catalogue.adzuna_store_loop(spark, sf_dir).count() and len(calls) == 1
