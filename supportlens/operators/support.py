"""Support tools: categories, escalations, agents, response and resolution targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.functions.expressions import FINISHED, STILL_OPEN, attention_order, mean, percent, rows
from supportlens.functions.params import ListParam, keep_listed

ESCALATION_COLUMNS = [
    "ticket_id", "customer_id", "subject", "category", "priority", "status",
    "created_at", "assigned_agent", "first_response_minutes", "num_replies",
]
TOP_ESCALATED = 50
TOP_AGENTS = 25


def category_metrics(tables) -> DataFrame:
    """One row of ticket metrics per category; a ticket waiting for the customer is not open."""
    source = tables.support_tickets(
        "category", "status", "priority", "resolution_hours", "first_response_minutes", "satisfaction_rating"
    )
    return source.groupBy("category").agg(
        rows().alias("total_tickets"),
        F.count_if(F.col("status").isin(STILL_OPEN)).alias("open_tickets"),
        mean("resolution_hours", 1).alias("avg_resolution_hours"),
        mean("first_response_minutes", 1).alias("avg_first_response_min"),
        mean("satisfaction_rating", 2).alias("avg_satisfaction"),
        percent(F.col("priority") == "Critical").alias("pct_critical"),
    )


def ticket_stats_by_category(tables, categories: ListParam) -> DataFrame:
    return keep_listed(category_metrics(tables), "category", categories)


def needs_attention(tables, *columns: str) -> DataFrame:
    """Escalated tickets, and Critical ones nobody has finished or handed back."""
    working = F.col("status").isin("Open", "In Progress")
    return tables.support_tickets(*(columns or ESCALATION_COLUMNS)).where(
        (F.col("status") == "Escalated") | ((F.col("priority") == "Critical") & working)
    )


def escalated_tickets(tables, limit: int | None = TOP_ESCALATED) -> DataFrame:
    """Tickets needing attention, most urgent and then oldest first."""
    chosen = needs_attention(tables)
    if limit is None:
        return chosen
    return chosen.orderBy(attention_order(F.col("priority")), "created_at", "ticket_id").limit(limit)


def agent_performance(tables, limit: int | None = TOP_AGENTS) -> DataFrame:
    """Agents by mean resolution time; agents without a resolved ticket come first."""
    source = tables.support_tickets(
        "assigned_agent", "status", "resolution_hours", "satisfaction_rating", "first_response_minutes"
    )
    metrics = source.groupBy("assigned_agent").agg(
        rows().alias("total_tickets"),
        F.count_if(F.col("status").isin(FINISHED)).alias("resolved_tickets"),
        mean("resolution_hours", 1).alias("avg_resolution_hours"),
        mean("satisfaction_rating", 2).alias("avg_satisfaction"),
        mean("first_response_minutes", 1).alias("avg_first_response_min"),
    )
    if limit is None:
        return metrics
    return metrics.orderBy(F.col("avg_resolution_hours").asc_nulls_first(), "assigned_agent").limit(limit)


# Breach counts over the flags ``late`` and ``slow`` of each ticket, as SQL text for both surfaces.
SLA_MEASURES = {
    "breached_response_sla": "count_if(late)",
    "breached_resolution_sla": "count_if(slow)",
    "total_tickets": "count(*)",
    "breach_rate_pct": "cast(round(cast(count_if(late or slow) * 100.0d / count(*) as decimal(28,10)), 1) as double)",
}


def sla_flags(max_first_response: str, max_resolution: str) -> dict[str, str]:
    """Whether a ticket breaches each limit; the limits are SQL operands.

    An unresolved ticket has no resolution time: it breaches nothing but counts in the total.
    """
    return {
        "late": f"coalesce(first_response_minutes > {max_first_response}, false)",
        "slow": f"coalesce(resolution_hours > {max_resolution}, false)",
    }


def number(value: float | None) -> str:
    """SQL text of a double; a missing, infinite or undefined one is what it is in SQL."""
    return "CAST(NULL AS DOUBLE)" if value is None else f"double('{float(value)!r}')"


def sla_breach_summary(tables, max_first_response_min: float | None, max_resolution_hours: float | None) -> DataFrame:
    """Tickets beyond the response or resolution limit, per category and priority."""
    source = tables.support_tickets("category", "priority", "first_response_minutes", "resolution_hours")
    flags = sla_flags(number(max_first_response_min), number(max_resolution_hours))
    return (
        source.select("category", "priority", *[F.expr(text).alias(name) for name, text in flags.items()])
        .groupBy("category", "priority")
        .agg(*[F.expr(text).alias(name) for name, text in SLA_MEASURES.items()])
        .orderBy(F.desc("breach_rate_pct"), "category", "priority")
    )
