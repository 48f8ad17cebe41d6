"""Ticket snapshots at a point in time, for change feeds and incremental indexes."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = ["ticket_id", "customer_id", "subject", "priority", "status", "resolution_hours", "created_at"]


def last_created(tables) -> datetime:
    """Time of the newest ticket: "now" for reports that say last month or this quarter."""
    return tables.support_tickets("created_at").agg(F.max("created_at").alias("t")).first()["t"]


def tickets_as_of(tables, moment: datetime, *more: str) -> DataFrame:
    """Tickets as they stood at a moment, with further columns on demand.

    Later tickets are absent, and those finished later are still in progress without a
    resolution time.
    """
    at = F.lit(moment).cast("timestamp_ntz")
    seconds = F.round(F.col("resolution_hours") * 3600).cast("bigint")
    unfinished = F.col("resolution_hours").isNotNull() & (F.col("created_at") + F.make_dt_interval(secs=seconds) > at)
    return (
        tables.support_tickets(*COLUMNS, *more)
        .where(F.col("created_at") <= at)
        .withColumn("status", F.when(unfinished, "In Progress").otherwise(F.col("status")))
        .withColumn("resolution_hours", F.when(~unfinished, F.col("resolution_hours")))
    )


def week_apart(tables, *more: str) -> tuple[DataFrame, DataFrame]:
    """Ticket snapshots of a week before the newest ticket, and of its time."""
    now = last_created(tables)
    return tickets_as_of(tables, now - timedelta(days=7), *more), tickets_as_of(tables, now, *more)
