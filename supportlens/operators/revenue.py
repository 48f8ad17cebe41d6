"""Revenue tools: plan tiers, unpaid orders, order types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.functions.expressions import UNPAID, mean, rows, total
from supportlens.functions.params import ListParam, keep_listed

TOP_UNPAID = 50
# Orders that may be broadcast.
FEW = 10_000
UNPAID_COLUMNS = [
    "order_id", "customer_id", "company_name", "product_name", "amount", "order_date", "payment_status", "plan_tier",
]


def revenue_by_plan_tier(tables) -> DataFrame:
    source = tables.customers("plan_tier", "monthly_recurring_revenue", "health_score", "churn_risk_score")
    return (
        source.groupBy("plan_tier")
        .agg(
            rows().alias("total_customers"),
            total("monthly_recurring_revenue").alias("total_mrr"),
            mean("monthly_recurring_revenue", 2).alias("avg_mrr"),
            mean("health_score", 1).alias("avg_health_score"),
            mean("churn_risk_score", 2).alias("avg_churn_risk"),
        )
        .orderBy(F.desc("total_mrr"), "plan_tier")
    )


def unpaid_orders(tables, only: Column | None = None, few: bool = False) -> DataFrame:
    """Orders whose payment is overdue or pending, with the customer's name and plan."""
    unpaid = F.col("payment_status").isin(UNPAID)
    orders = tables.purchases(
        "order_id", "customer_id", "product_name", "amount", "order_date", "payment_status",
        only=unpaid if only is None else unpaid & only, few=few,
    )
    return orders.join(tables.customers("customer_id", "company_name", "plan_tier"), "customer_id").select(*UNPAID_COLUMNS)


def overdue_payments(tables, limit: int | None = TOP_UNPAID) -> DataFrame:
    """The largest unpaid orders. Order ids may repeat, so ties are cut by all columns.

    The smallest amount that can make the list is read from the orders alone, so the
    joins see only the few orders at or above it, and broadcast those if counting
    shows that they are few. Should some of them have no customer, the list would
    come out short, and all unpaid orders are joined instead.
    """
    if limit is None:
        return unpaid_orders(tables)
    chosen = None
    amounts = tables.purchases("amount", only=F.col("payment_status").isin(UNPAID))
    largest = amounts.orderBy(F.desc("amount")).limit(limit).agg(F.min("amount").alias("least"), rows().alias("n")).first()
    if largest["n"] == limit:
        high = F.col("amount") >= largest["least"]
        enough = unpaid_orders(tables, only=high, few=amounts.where(high).count() <= FEW)
        if enough.count() >= limit:
            chosen = enough
    chosen = unpaid_orders(tables) if chosen is None else chosen
    ties = [c for c in UNPAID_COLUMNS if c != "amount"]
    return chosen.orderBy(F.desc("amount"), *ties).limit(limit)


def order_type_metrics(tables) -> DataFrame:
    """One row of order metrics per order type."""
    source = tables.purchases("order_type", "amount", "discount_percent")
    return source.groupBy("order_type").agg(
        rows().alias("total_orders"),
        total("amount").alias("total_revenue"),
        mean("amount", 2).alias("avg_order_value"),
        mean("discount_percent", 1).alias("avg_discount_pct"),
    )


def order_trends_by_type(tables, order_types: ListParam) -> DataFrame:
    return keep_listed(order_type_metrics(tables), "order_type", order_types)
