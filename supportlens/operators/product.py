"""Product tools: defects, revenue, reviews, ticket load of the buyers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.functions.expressions import mean, percent, priority_score, rounded, rows
from supportlens.functions.params import ListParam, keep_listed

TOP_CORRELATED = 20


def defect_profiles(tables) -> DataFrame:
    source = tables.products("product_id", "name", "category", "defect_rate", "avg_rating", "status")
    return source.withColumnRenamed("name", "product_name")


def product_defect_rates(tables, categories: ListParam) -> DataFrame:
    """Products of the categories, most defective first."""
    chosen = keep_listed(defect_profiles(tables), "category", categories)
    return chosen.orderBy(F.desc("defect_rate"), "product_id")


def product_revenue(tables) -> DataFrame:
    """Orders, revenue and discount per product, best seller first.

    Order rows are reduced to one per product and name before the product table is
    joined, so the join never sees a hot product. The name is the order's own: an order
    keeps the name its product had then.
    """
    sold = (
        tables.purchases("product_id", "product_name", "amount", "discount_percent")
        .groupBy("product_id", "product_name")
        .agg(
            rows().alias("total_orders"),
            F.sum("amount").alias("revenue"),
            F.avg("amount").alias("order_value"),
            F.avg("discount_percent").alias("discount"),
        )
    )
    return (
        sold.join(tables.products("product_id", "category"), "product_id")
        .select(
            "product_id",
            "product_name",
            "category",
            "total_orders",
            rounded(F.col("revenue"), 2).alias("total_revenue"),
            rounded(F.col("order_value"), 2).alias("avg_order_value"),
            rounded(F.col("discount"), 1).alias("avg_discount_pct"),
        )
        .orderBy(F.desc("total_revenue"), "product_id", "product_name")
    )


def review_metrics(tables) -> DataFrame:
    """One row of review metrics per product."""
    source = tables.product_reviews("product_id", "product_name", "rating", "verified_purchase")
    return source.groupBy("product_id", "product_name").agg(
        rows().alias("total_reviews"),
        mean("rating", 2).alias("avg_rating"),
        percent(F.col("rating") == 5).alias("five_star_pct"),
        percent(F.col("rating") == 1).alias("one_star_pct"),
        percent(F.col("verified_purchase")).alias("verified_pct"),
    )


def product_review_summary(tables, product_ids: ListParam) -> DataFrame:
    return keep_listed(review_metrics(tables), "product_id", product_ids)


def ticket_weight(tables) -> DataFrame:
    """Per customer: tickets, and count and sum of their priority scores."""
    scored = tables.support_tickets("customer_id", "priority").withColumn("score", priority_score(F.col("priority")))
    return scored.groupBy("customer_id").agg(
        rows().alias("tickets"), F.sum("score").alias("score_sum"), F.count("score").alias("score_n")
    )


def bought(tables) -> DataFrame:
    """Number of orders per customer and product name and category.

    Order lines are reduced to one per customer and product before they meet the product
    table, where a product may be hot; only those keys are shuffled.
    """
    lines = tables.purchases("customer_id", "product_id", "product_name")
    per_product = lines.groupBy("customer_id", "product_id", "product_name").agg(rows().alias("orders"))
    return (
        per_product.join(tables.products("product_id", "category"), "product_id")
        .groupBy("customer_id", "product_name", "category")
        .agg(F.sum("orders").alias("orders"))
    )


def buyers(tables, only: DataFrame) -> DataFrame:
    """``bought`` for the customers of ``only``, one row each, whose other columns are carried along."""
    carried = [c for c in only.columns if c != "customer_id"]
    return bought(tables).join(only, "customer_id").select("customer_id", "product_name", "category", *carried, "orders")


def correlation_metrics(tables, repeat_orders: bool = True) -> DataFrame:
    """Tickets of a product's buyers, per product name and category.

    Orders and tickets meet many-to-many on the customer. Tickets are reduced to one
    row per customer first, and that row is multiplied by the number of orders
    instead of being listed once per order.
    ``repeat_orders=False`` counts each ticket once however often its customer bought.
    """
    times = F.col("orders") if repeat_orders else F.lit(1)
    return buyers(tables, ticket_weight(tables)).groupBy("product_name", "category").agg(
        rows().alias("customers_with_tickets"),
        F.sum(F.col("tickets") * times).alias("total_tickets_from_buyers"),
        rounded(
            F.sum(F.col("score_sum") * times) / F.nullif(F.sum(F.col("score_n") * times), F.lit(0)), 2
        ).alias("avg_ticket_priority_score"),
    )


def product_ticket_correlation(tables, repeat_orders: bool = True, limit: int | None = TOP_CORRELATED) -> DataFrame:
    """Products whose buyers file the most tickets."""
    metrics = correlation_metrics(tables, repeat_orders)
    if limit is None:
        return metrics
    return metrics.orderBy(F.desc("total_tickets_from_buyers"), "product_name", "category").limit(limit)
