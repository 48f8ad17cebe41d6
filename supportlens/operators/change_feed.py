"""Row-level changes between two snapshots of a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of the change types.
INSERT, DELETE, BEFORE, AFTER = "insert", "delete", "update_preimage", "update_postimage"


def change_feed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``_change_type`` plus the row, for every row that was added, removed or altered.

    Whole rows are compared null-safely as structs; a row hash would miss a value
    that moved between a NULL column and its neighbour.
    """
    columns = new.columns
    before = old.select(F.col(key), F.struct(*columns).alias("_old"))
    after = new.select(F.col(key), F.struct(*columns).alias("_new"))
    changed = before.join(after, key, "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
    added, removed = F.col("_old").isNull(), F.col("_new").isNull()
    entries = F.array(
        F.when(~removed, F.struct(F.when(added, INSERT).otherwise(AFTER).alias("kind"), F.col("_new").alias("row"))),
        F.when(~added, F.struct(F.when(removed, DELETE).otherwise(BEFORE).alias("kind"), F.col("_old").alias("row"))),
    )
    return (
        changed.select(F.explode(entries).alias("entry"))
        .where(F.col("entry").isNotNull())
        .select(F.col("entry.kind").alias("_change_type"), "entry.row.*")
    )


def apply_changes(old: DataFrame, feed: DataFrame, key: str) -> DataFrame:
    """The new snapshot: unchanged rows of the old one, and the new state of the changed ones."""
    kept = old.join(feed.select(key).distinct(), key, "left_anti").select(*old.columns)
    return kept.unionByName(feed.where(F.col("_change_type").isin(INSERT, AFTER)).drop("_change_type"))
