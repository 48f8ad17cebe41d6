"""Questions that combine customers, tickets, products, orders and reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supportlens.functions.expressions import priority_score, rounded, rows
from supportlens.operators import customer, product, revenue, support
from supportlens.operators.checks import union_all
from supportlens.operators.text_index import TextIndex, matching
from supportlens.plans.patterns import MIN_SCORE

NEGATIVE_RATING = 2
AT_RISK = 0.5
PROFILE = ["customer_id", "company_name", "plan_tier", "churn_risk_score", "health_score"]


def critical_tickets(tables, category: str | None = None, *columns: str) -> DataFrame:
    tickets = tables.support_tickets("customer_id", "category", "priority", *columns).where(F.col("priority") == "Critical")
    return tickets.where(F.col("category") == category) if category else tickets


def at_risk_critical_negative(tables, category: str | None = "Performance", min_churn: float = AT_RISK) -> DataFrame:
    """At-risk customers with Critical tickets of a category and negative reviews.

    Tickets and reviews are counted per customer before they meet the customers.
    """
    filed = critical_tickets(tables, category).groupBy("customer_id").agg(rows().alias("critical_tickets"))
    reviewed = (
        tables.product_reviews("customer_id", "rating")
        .where(F.col("rating") <= NEGATIVE_RATING)
        .groupBy("customer_id")
        .agg(rows().alias("negative_reviews"), rounded(F.avg("rating"), 2).alias("avg_negative_rating"))
    )
    at_risk = tables.customers(*PROFILE).where(F.col("churn_risk_score") >= min_churn)
    return at_risk.join(filed, "customer_id").join(reviewed, "customer_id")


def critical_recent_customers(tables, category: str = "Performance", min_churn: float = AT_RISK) -> DataFrame:
    """Customers with Critical tickets of a category in the month up to the newest ticket."""
    newest = tables.support_tickets("created_at").agg(F.max("created_at").alias("t"))
    since = F.add_months(F.to_date(newest.select("t").scalar()), -1)
    filed = (
        critical_tickets(tables, category, "created_at")
        .where(F.to_date("created_at") >= since)
        .groupBy("customer_id")
        .agg(rows().alias("critical_tickets"), F.max("created_at").alias("last_ticket_at"))
    )
    return tables.customers(*PROFILE).join(filed, "customer_id").withColumn("at_risk", F.col("churn_risk_score") >= min_churn)


def ticket_load(tables) -> DataFrame:
    """Tickets of the buyers of each product name and category: number, mean priority score and most frequent category.

    Tickets are reduced to one row per customer and category, so that buyers and tickets are joined once for all three.
    """
    scored = tables.support_tickets("customer_id", "category", "priority").withColumn("score", priority_score(F.col("priority")))
    filed = scored.groupBy("customer_id", F.col("category").alias("theme")).agg(
        rows().alias("tickets"), F.sum("score").alias("score_sum"), F.count("score").alias("score_n")
    )
    per_theme = (
        product.bought(tables).join(filed, "customer_id")
        .groupBy("product_name", "category", "theme")
        .agg(*[F.sum(F.col(c) * F.col("orders")).alias(c) for c in ("tickets", "score_sum", "score_n")])
    )
    return per_theme.groupBy("product_name", "category").agg(
        F.sum("tickets").alias("total_tickets_from_buyers"),
        rounded(F.sum("score_sum") / F.nullif(F.sum("score_n"), F.lit(0)), 2).alias("avg_ticket_priority_score"),
        F.min(F.struct((-F.col("tickets")).alias("negative"), "theme"))["theme"].alias("top_theme"),
    )


def product_action_plan(tables, limit: int | None = None) -> DataFrame:
    """Products by a combined score of bad reviews, defects and ticket priority, worst first."""
    reviews = product.review_metrics(tables).select("product_id", "total_reviews", "avg_rating", "one_star_pct")
    defects = product.defect_profiles(tables).select("product_id", "product_name", "category", "defect_rate")
    load = ticket_load(tables)
    urgency: Column = (
        20 * (5 - F.col("avg_rating")) + 500 * F.col("defect_rate") + 10 * F.coalesce("avg_ticket_priority_score", F.lit(0.0))
    )
    plan = (
        reviews.join(defects, "product_id")
        .join(load, ["product_name", "category"], "left")
        .select(
            "product_id", "product_name", "category", "total_reviews", "avg_rating", "one_star_pct", "defect_rate",
            F.coalesce("total_tickets_from_buyers", F.lit(0)).alias("buyer_tickets"), "top_theme",
            rounded(urgency, 3).alias("urgency"),
        )
        .orderBy(F.desc("urgency"), "product_id")
    )
    return plan if limit is None else plan.limit(limit)


def qbr_pack(tables, top: int = 5, min_churn: float = 0.4) -> DataFrame:
    """Quarterly review in long form: section, rank, name, metric and value.

    The review asks for the ``top`` at-risk customers, and the payments are the list of the payments tool; the other
    sections are whole. Their rows are as many as there are plan tiers, categories or products.
    """

    def section(title: str, source: DataFrame, name: str, metric: str, order: list, limit: int | None = None) -> DataFrame:
        best = source if limit is None else source.orderBy(*order).limit(limit)
        ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(title)).orderBy(*order)))
        return ranked.select(
            F.lit(title).alias("section"), "rank", F.col(name).cast("string").alias("name"),
            F.lit(metric).alias("metric"), F.col(metric).cast("double").alias("value"),
        )

    newest = tables.support_tickets("created_at").agg(F.max("created_at").alias("t"))
    quarter = F.date_trunc("quarter", newest.select("t").scalar())
    this_quarter = (
        tables.support_tickets("category", "created_at").where(F.col("created_at") >= quarter)
        .groupBy("category").agg(rows().alias("tickets"))
    )
    at_risk = tables.customers("customer_id", "company_name", "churn_risk_score", "monthly_recurring_revenue")
    at_risk = at_risk.where(F.col("churn_risk_score") >= min_churn)
    load = product.correlation_metrics(tables).withColumn("name", F.concat_ws(" / ", "product_name", "category"))
    payment = F.concat_ws(" / ", "company_name", F.col("order_id").cast("string"), "payment_status", "product_name")
    unpaid = revenue.overdue_payments(tables).withColumn("name", payment)
    return union_all(
        [
            section("revenue by plan tier", revenue.revenue_by_plan_tier(tables), "plan_tier", "total_mrr", [F.desc("total_mrr"), "plan_tier"]),
            section("at-risk customers by revenue", at_risk, "company_name", "monthly_recurring_revenue", [F.desc("monthly_recurring_revenue"), "customer_id"], top),
            section("support issues this quarter", this_quarter, "category", "tickets", [F.desc("tickets"), "category"]),
            section("products with most tickets", load, "name", "total_tickets_from_buyers", [F.desc("total_tickets_from_buyers"), "name"]),
            section("payments to follow up", unpaid, "name", "amount", [F.desc("amount"), "name"]),
        ]
    )


def enterprise_at_risk(tables, above: float = 0.6) -> DataFrame:
    """All Enterprise customers above a churn risk."""
    chosen = (F.col("plan_tier") == "Enterprise") & (F.col("churn_risk_score") > above)
    return customer.at_risk_customers(tables, above, predicate=chosen, limit=None)


def at_risk_products_used(tables, min_churn: float = AT_RISK) -> DataFrame:
    """Products that at-risk customers with Critical tickets have bought, one row each."""
    filed = critical_tickets(tables).groupBy("customer_id").agg(rows().alias("critical_tickets"))
    at_risk = tables.customers("customer_id", "company_name", "churn_risk_score", "health_score")
    at_risk = at_risk.where(F.col("churn_risk_score") >= min_churn).join(filed, "customer_id")
    used = product.buyers(tables, at_risk)
    carried = [c for c in used.columns if c not in ("category", "orders")]
    return used.groupBy(*carried).agg(F.sum("orders").alias("orders"))


def frustrated_customers(tables, index: TextIndex, text: str, category: str = "Integration", min_score: float = MIN_SCORE) -> DataFrame:
    """Customers behind the tickets of a category that match a text, with churn risk and reviews."""
    tickets = tables.support_tickets("ticket_id", "customer_id", "category")
    wanted = tickets.where(F.col("category") == category).select("ticket_id", "customer_id")
    hits = matching(index, text, min_score, source=wanted, candidates=wanted)
    found = hits.groupBy("customer_id").agg(rows().alias("matching_tickets"), F.max("search_score").alias("best_score"))
    reviews = (
        tables.product_reviews("customer_id", "rating").groupBy("customer_id")
        .agg(rows().alias("n_reviews"), rounded(F.avg("rating"), 2).alias("avg_rating"))
    )
    profiles = tables.customers("customer_id", "company_name", "churn_risk_score")
    return (
        profiles.join(found, "customer_id")
        .join(reviews, "customer_id", "left")
        .withColumn("n_reviews", F.coalesce("n_reviews", F.lit(0)))
    )


def escalations_with_health(tables) -> DataFrame:
    """Every ticket that needs attention next to its customer's health: a chained lookup."""
    tickets = support.needs_attention(tables, "ticket_id", "customer_id", "priority", "status")
    return tickets.join(tables.customers("customer_id", "health_score", "churn_risk_score"), "customer_id")
