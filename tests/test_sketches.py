"""Stored sketches against exact distinct counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from supportlens.operators import sketches
from tests.conftest import as_set


def test_any_span_of_days_is_a_union(spark):
    rows = [(f"2024-01-{1 + i % 9:02d}", "a" if i % 3 else "b", i % 700) for i in range(6000)] + [("2024-01-05", "b", None), (None, "c", 1)]
    df = spark.createDataFrame(rows, "at string, name string, who long")
    stored = sketches.daily_sketches(df, F.col("at"), ["name"], "who")
    assert stored.count() == len({r[:2] for r in rows})
    for first, last in ((None, None), ("2024-01-03", "2024-01-05"), ("2024-01-09", None)):
        chosen = [r for r in rows if (first is None and last is None) or (r[0] and (first or "") <= r[0] <= (last or "9"))]
        exact = {n: len({w for _, m, w in chosen if m == n and w is not None}) for n in {r[1] for r in chosen}}
        got = dict(as_set(sketches.distinct_estimates(stored, ["name"], first, last)))
        assert got.keys() == exact.keys() and all(abs(got[n] - exact[n]) <= max(1, exact[n] * sketches.BOUND) for n in exact)


def test_no_rows(spark):
    none = spark.createDataFrame([], "at string, name string, who long")
    assert sketches.distinct_estimates(sketches.daily_sketches(none, F.col("at"), ["name"], "who"), ["name"]).count() == 0
