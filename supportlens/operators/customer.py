"""Customer tools: health, churn risk, industries, engagement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.functions.expressions import mean, rounded, rows, total
from supportlens.functions.params import ListParam, keep_listed

HEALTH_COLUMNS = [
    "customer_id", "company_name", "plan_tier", "health_score", "churn_risk_score",
    "nps_score", "lifetime_value", "support_tier", "csm_assigned",
]
RISK_COLUMNS = [
    "customer_id", "company_name", "plan_tier", "churn_risk_score", "health_score",
    "monthly_recurring_revenue", "last_login_date", "csm_assigned",
]
TOP_AT_RISK = 25


def health_profiles(tables) -> DataFrame:
    return tables.customers(*HEALTH_COLUMNS)


def customer_health_summary(tables, customer_ids: ListParam) -> DataFrame:
    """Health metrics and account details of the listed customers."""
    return keep_listed(health_profiles(tables), "customer_id", customer_ids)


def risk_profiles(tables) -> DataFrame:
    return tables.customers(*RISK_COLUMNS)


def at_risk_customers(
    tables, min_churn_risk: float, predicate: Column | None = None, limit: int | None = TOP_AT_RISK
) -> DataFrame:
    """Customers at or above a churn risk, riskiest first.

    ``predicate`` narrows the candidates before the cut; ``limit=None`` returns all.
    The keys that make the list are found first, from the few columns that decide,
    so the remaining columns are looked up for those customers only.
    """
    profiles = risk_profiles(tables)
    chosen = profiles.where(F.col("churn_risk_score") >= min_churn_risk)
    if predicate is not None:
        chosen = chosen.where(predicate)
    if limit is None:
        return chosen
    order = [F.desc("churn_risk_score"), "customer_id"]
    # At most ``limit`` keys.
    keys = [r["customer_id"] for r in chosen.orderBy(*order).limit(limit).select("customer_id").collect()]
    return keep_listed(profiles, "customer_id", keys).orderBy(*order)


def industry_metrics(tables) -> DataFrame:
    """One row of customer metrics per industry."""
    source = tables.customers("industry", "health_score", "churn_risk_score", "monthly_recurring_revenue", "nps_score")
    return source.groupBy("industry").agg(
        rows().alias("total_customers"),
        mean("health_score", 1).alias("avg_health_score"),
        mean("churn_risk_score", 2).alias("avg_churn_risk"),
        total("monthly_recurring_revenue").alias("total_mrr"),
        mean("nps_score", 1).alias("avg_nps"),
    )


def customers_by_industry(tables, industries: ListParam) -> DataFrame:
    return keep_listed(industry_metrics(tables), "industry", industries)


def interaction_metrics(tables) -> DataFrame:
    """Per customer: contacts, mean sentiment, mean satisfaction, most frequent channel.

    Rows are first reduced to one per customer and channel, so that even a customer
    with a third of all contacts reaches the second step as a handful of rows. The
    alphabetically smallest of equally frequent channels wins.
    """
    per_channel = (
        tables.customer_interactions("customer_id", "channel", "sentiment_score", "csat_score")
        .groupBy("customer_id", "channel")
        .agg(
            rows().alias("n"),
            F.sum("sentiment_score").alias("sentiment_sum"), F.count("sentiment_score").alias("sentiment_n"),
            F.sum("csat_score").alias("csat_sum"), F.count("csat_score").alias("csat_n"),
        )
    )
    named = F.when(F.col("channel").isNotNull(), F.struct(-F.col("n"), F.col("channel")))
    return per_channel.groupBy("customer_id").agg(
        F.sum("n").alias("total_interactions"),
        (F.sum("sentiment_sum") / F.nullif(F.sum("sentiment_n"), F.lit(0))).alias("avg_sentiment"),
        (F.sum("csat_sum") / F.nullif(F.sum("csat_n"), F.lit(0))).alias("avg_csat"),
        F.min_by("channel", named).alias("most_common_channel"),
    )


def ticket_load(tables) -> DataFrame:
    """Per customer: number of tickets and mean resolution time."""
    return (
        tables.support_tickets("customer_id", "resolution_hours")
        .groupBy("customer_id")
        .agg(rows().alias("total_tickets"), F.avg("resolution_hours").alias("avg_resolution_hours"))
    )


def engagement(tables, customers: DataFrame | None = None) -> DataFrame:
    customers = tables.customers("customer_id") if customers is None else customers
    return (
        customers.join(interaction_metrics(tables), "customer_id", "left")
        .join(ticket_load(tables), "customer_id", "left")
        .select(
            "customer_id",
            F.coalesce("total_interactions", F.lit(0)).alias("total_interactions"),
            rounded(F.col("avg_sentiment"), 2).alias("avg_sentiment"),
            rounded(F.col("avg_csat"), 1).alias("avg_csat"),
            "most_common_channel",
            F.coalesce("total_tickets", F.lit(0)).alias("total_support_tickets"),
            rounded(F.col("avg_resolution_hours"), 1).alias("avg_resolution_hours"),
        )
    )


def customer_engagement(tables, customer_ids: ListParam) -> DataFrame:
    """Contacts and tickets of the listed customers; those without any keep a row."""
    return engagement(tables, keep_listed(tables.customers("customer_id"), "customer_id", customer_ids))
