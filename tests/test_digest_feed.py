"""The feed by digests against the feed that compares everything."""

from __future__ import annotations

from pyspark.sql import functions as F

from supportlens.operators.change_feed import change_feed
from supportlens.operators.digest_feed import change_feed_by_digest, differing_rows
from tests.conftest import as_set

SCHEMA = "id long, a string, b string"


def snapshots(spark):
    old = [(i, f"a{i}", None if i % 4 else f"b{i}") for i in range(3000)]
    new = [r for r in old if r[0] not in (5, 6)] + [(9000, None, None), (9001, "", "x")]
    # A value that moves between a null column and its neighbour, and two rows that swap their values.
    new = [(10, "x", None) if r[0] == 10 else (17, "a18", r[2]) if r[0] == 17 else (18, "a17", r[2]) if r[0] == 18 else r for r in new]
    old = [(10, None, "x") if r[0] == 10 else r for r in old]
    return spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)


def test_same_as_the_whole_comparison(spark):
    old, new = snapshots(spark)
    for buckets in (1, 16, 1 << 16):
        for before, after in ((old, new), (new, old), (old.limit(0), new), (old, new.limit(0)), (old, old)):
            assert as_set(change_feed_by_digest(before, after, "id", buckets)) == as_set(change_feed(before, after, "id"))


def test_few_rows_meet(spark):
    old, new = snapshots(spark)
    before, after = differing_rows(old, new, "id")
    changed = as_set(change_feed(old, new, "id").select("id").distinct())
    met = before.select("id").union(after.select("id")).distinct()
    assert set(changed) <= set(as_set(met)) and met.count() <= len(changed) + 3


def test_columns_in_another_order(spark):
    old, new = snapshots(spark)
    turned = old.select("b", "id", F.col("a"))
    assert as_set(change_feed_by_digest(turned, new, "id")) == as_set(change_feed(old, new, "id"))
