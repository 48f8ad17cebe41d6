"""The twenty table functions, callable from Python and from SQL.

Both surfaces read the same relation. The Python call narrows it with a DataFrame
filter; the SQL function selects from a temporary view of it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supportlens.functions.params import listed
from supportlens.operators import customer, lookups, product, revenue, support
from supportlens.operators.checks import table_counts
from supportlens.sources.domain import register_views


@dataclass(frozen=True)
class Tool:
    name: str
    area: str
    comment: str
    call: Callable[..., DataFrame]
    # The lazy relation behind the SQL function, and the text that follows it in the function's body.
    relation: Callable[..., DataFrame]
    tail: str = ""
    params: dict[str, str] = field(default_factory=dict)
    sources: tuple[str, ...] = ()
    # A whole body over {view}, where selecting from the relation is not enough, and whether it has other columns.
    body: str = ""
    reshaped: bool = False

    @property
    def view(self) -> str:
        return f"tool_{self.name}"


def _lookup(name: str, lookup: str, comment: str) -> Tool:
    def relation(tables) -> DataFrame:
        return lookups.valid_values(tables, lookup)

    return Tool(name, "lookup", comment, relation, relation, sources=(lookups.LOOKUPS[lookup][0],))


def _aliased(columns: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in columns.items())


TOOLS = [
    Tool(
        "get_customer_health_summary", "customer",
        "Health, churn risk, NPS and account details of chosen customers. Takes a JSON array of customer ids.",
        customer.customer_health_summary, customer.health_profiles,
        f"WHERE {listed('customer_ids', 'customer_id')}", {"customer_ids": "STRING"}, ("customers",),
    ),
    Tool(
        "get_at_risk_customers", "customer",
        "The 25 customers with the highest churn risk at or above a threshold between 0 and 1.",
        customer.at_risk_customers, customer.risk_profiles,
        "", {"min_churn_risk": "DOUBLE"}, ("customers",),
        # The keys that make the list come first; the rest is looked up for them.
        "SELECT v.* FROM (SELECT customer_id AS chosen FROM customers WHERE churn_risk_score >= min_churn_risk "
        f"ORDER BY churn_risk_score DESC, customer_id LIMIT {customer.TOP_AT_RISK}) JOIN {{view}} v ON v.customer_id = chosen "
        "ORDER BY churn_risk_score DESC, customer_id",
    ),
    Tool(
        "get_customers_by_industry", "customer",
        "Customer count, health, churn, revenue and NPS of chosen industries. Takes a JSON array of industry names.",
        customer.customers_by_industry, customer.industry_metrics,
        f"WHERE {listed('industries', 'industry')}", {"industries": "STRING"}, ("customers",),
    ),
    Tool(
        "get_customer_engagement_summary", "customer",
        "Contacts, sentiment, favourite channel and ticket load of chosen customers. Takes a JSON array of customer ids.",
        customer.customer_engagement, customer.engagement,
        f"WHERE {listed('customer_ids', 'customer_id')}", {"customer_ids": "STRING"},
        ("customers", "customer_interactions", "support_tickets"),
    ),
    Tool(
        "get_ticket_stats_by_category", "support",
        "Ticket volume, open tickets, response and resolution times of chosen categories. Takes a JSON array of category names.",
        support.ticket_stats_by_category, support.category_metrics,
        f"WHERE {listed('categories', 'category')}", {"categories": "STRING"}, ("support_tickets",),
    ),
    Tool(
        "get_escalated_tickets", "support",
        "The 50 most urgent tickets that are escalated, or critical and still being worked on.",
        support.escalated_tickets, support.escalated_tickets, sources=("support_tickets",),
    ),
    Tool(
        "get_agent_performance", "support",
        "The 25 support agents with the shortest resolution time, with volume and satisfaction.",
        support.agent_performance, support.agent_performance, sources=("support_tickets",),
    ),
    Tool(
        "get_sla_breach_summary", "support",
        "Tickets beyond a first response limit in minutes or a resolution limit in hours, by category and priority.",
        support.sla_breach_summary,
        lambda tables: tables.support_tickets("category", "priority", "first_response_minutes", "resolution_hours"),
        "",
        {"max_first_response_min": "DOUBLE", "max_resolution_hours": "DOUBLE"}, ("support_tickets",),
        f"SELECT category, priority, {_aliased(support.SLA_MEASURES)} "
        f"FROM (SELECT category, priority, {_aliased(support.sla_flags('max_first_response_min', 'max_resolution_hours'))} FROM {{view}}) "
        "GROUP BY category, priority ORDER BY breach_rate_pct DESC, category, priority", True,
    ),
    Tool(
        "get_product_defect_rates", "product",
        "Defect rate, rating and release status of the products of chosen categories. Takes a JSON array of category names.",
        product.product_defect_rates, product.defect_profiles,
        f"WHERE {listed('categories', 'category')} ORDER BY defect_rate DESC, product_id",
        {"categories": "STRING"}, ("products",),
    ),
    Tool(
        "get_product_revenue", "product", "Orders, revenue, order value and discount per product, best seller first.",
        product.product_revenue, product.product_revenue, sources=("purchases", "products"),
    ),
    Tool(
        "get_product_review_summary", "product",
        "Review count, rating, five and one star share and verified share of chosen products. Takes a JSON array of product ids.",
        product.product_review_summary, product.review_metrics,
        f"WHERE {listed('product_ids', 'product_id')}", {"product_ids": "STRING"}, ("product_reviews",),
    ),
    Tool(
        "get_product_ticket_correlation", "product",
        "The 20 products whose buyers file the most support tickets, with the average ticket priority.",
        product.product_ticket_correlation, product.product_ticket_correlation,
        sources=("purchases", "products", "support_tickets"),
    ),
    Tool(
        "get_revenue_by_plan_tier", "revenue", "Customers, recurring revenue, health and churn risk per plan tier.",
        revenue.revenue_by_plan_tier, revenue.revenue_by_plan_tier, sources=("customers",),
    ),
    Tool(
        "get_overdue_payments", "revenue", "The 50 largest orders with an overdue or pending payment, with customer and plan.",
        revenue.overdue_payments, revenue.unpaid_orders,
        f"ORDER BY amount DESC, {', '.join(c for c in revenue.UNPAID_COLUMNS if c != 'amount')} LIMIT {revenue.TOP_UNPAID}",
        sources=("purchases", "customers"),
    ),
    Tool(
        "get_order_trends_by_type", "revenue",
        "Order count, revenue, order value and discount of chosen order types. Takes a JSON array of order types.",
        revenue.order_trends_by_type, revenue.order_type_metrics,
        f"WHERE {listed('order_types', 'order_type')}", {"order_types": "STRING"}, ("purchases",),
    ),
    _lookup("list_valid_ticket_categories", "ticket_categories", "All ticket categories in use."),
    _lookup("list_valid_priorities", "priorities", "All ticket priorities in use."),
    _lookup("list_valid_industries", "industries", "All customer industries in use."),
    _lookup("list_valid_plan_tiers", "plan_tiers", "All plan tiers in use."),
    _lookup("list_valid_product_categories", "product_categories", "All product categories in use."),
]
BY_NAME = {tool.name: tool for tool in TOOLS}


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def call(tables, name: str, **params) -> DataFrame:
    """Call a table function from Python."""
    return BY_NAME[name].call(tables, **params)


def register_sql(tables, names: list[str] | None = None) -> None:
    """Create the table functions, or the named ones, as temporary SQL functions of the session."""
    spark = tables.spark
    register_views(tables)
    for tool in [BY_NAME[n] for n in names] if names else TOOLS:
        relation = tool.relation(tables)
        relation.createOrReplaceTempView(tool.view)
        body = tool.body.format(view=tool.view) or f"SELECT * FROM {tool.view} {tool.tail}".strip()
        schema = relation.schema
        if tool.reshaped:
            # Called with neutral values only to learn the output columns; nothing runs.
            schema = tool.call(tables, **{name: 0.0 if kind == "DOUBLE" else "[]" for name, kind in tool.params.items()}).schema
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        params = ", ".join(f"{name} {kind}" for name, kind in tool.params.items())
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {tool.name}({params}) "
            f"RETURNS TABLE({columns}) COMMENT {quoted(tool.comment)} RETURN {body}"
        )


def tool_comments(spark: SparkSession) -> DataFrame:
    """``(tool, area, comment)`` of the table functions."""
    return spark.createDataFrame([(t.name, t.area, t.comment) for t in TOOLS], "tool string, area string, comment string")


def registered(spark: SparkSession) -> list[str]:
    """Names of the table functions the session's catalog knows."""
    return sorted(f.name for f in spark.catalog.listFunctions(pattern="*") if f.name in BY_NAME)


def tool_registry(tables) -> DataFrame:
    """Every table function that the session's catalog holds once they are registered, with its area, its parameters
    and the number of rows it reads."""
    spark = tables.spark
    register_sql(tables)
    links = [(t.name, t.area, len(t.params), table) for t in map(BY_NAME.get, registered(spark)) for table in t.sources]
    listing = spark.createDataFrame(links, "tool string, area string, n_params int, table_name string")
    counts = table_counts(tables).where(F.col("table_name").isNotNull())
    return (
        listing.join(counts, "table_name")
        .groupBy("tool", "area", "n_params")
        .agg(F.count(F.lit(1)).alias("n_tables"), F.sum("n_rows").alias("rows_read"))
    )
