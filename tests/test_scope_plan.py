"""What a filter on the scope decision does to the plan, and to the rows."""

from __future__ import annotations

from datetime import datetime

from offerweave.operators import normalize, scope

ROWS = [(1, "bpce", "Data Engineer", "Spark &amp; SQL"), (2, "bpce", "Chef de cuisine", ""), (3, "nowhere", "Data Engineer", "x"), (4, "bpce", None, None), (5, None, "Data Engineer", "x"), (6, "adzuna", "Développeur Python", "python")]


def test_a_filtered_plan_holds_the_cleaning_once(spark):
    """Where the filter moves below the cleaning, its tables are written out thousands of times and the driver's memory ends."""
    raw = spark.createDataFrame(ROWS, "ord long, source string, title string, description string")
    out = normalize.normalized(scope.kept(raw), datetime(2024, 6, 15))
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 400_000
    rows = lambda df: sorted((r["ord"], r["title_normalized"], r["scope_score"], r["filter_status"]) for r in df.collect())
    want = [r for r in rows(normalize.normalized(scope.evaluated(raw), datetime(2024, 6, 15))) if r[-1] == "kept_offer"]
    assert rows(out) == want and 0 < len(want) < len(ROWS)
