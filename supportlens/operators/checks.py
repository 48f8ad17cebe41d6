"""Row counts and data rules of the six tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.functions.expressions import FINISHED, rows
from supportlens.sources import domain

KEYS = {
    "products": "product_id", "customers": "customer_id", "support_tickets": "ticket_id",
    "purchases": "order_id", "customer_interactions": "interaction_id", "product_reviews": "review_id",
}
FOREIGN_KEYS = [
    ("support_tickets", "customer_id", "customers"),
    ("purchases", "customer_id", "customers"),
    ("purchases", "product_id", "products"),
    ("customer_interactions", "customer_id", "customers"),
    ("product_reviews", "customer_id", "customers"),
    ("product_reviews", "product_id", "products"),
]
ENUMERATED = [
    ("customers", "plan_tier", domain.PLAN_TIERS),
    ("customers", "support_tier", domain.SUPPORT_TIERS),
    ("support_tickets", "category", domain.CATEGORIES),
    ("support_tickets", "priority", domain.PRIORITIES),
    ("support_tickets", "status", domain.STATUSES),
    ("support_tickets", "channel", domain.TICKET_CHANNELS),
    ("purchases", "order_type", domain.ORDER_TYPES),
    ("purchases", "payment_status", domain.PAYMENT_STATUSES),
    ("customer_interactions", "channel", domain.INTERACTION_CHANNELS),
]


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def table_counts(tables) -> DataFrame:
    """Rows per table and in total (the row without a table name)."""
    counts = [
        getattr(tables, name)(key).agg(rows().alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, key in KEYS.items()
    ]
    return union_all(counts).rollup("table_name").agg(F.sum("n").alias("n_rows"))


def referential_check(tables) -> DataFrame:
    """Rows and distinct keys without a parent, per foreign key.

    Child rows are counted per key before the anti-join, so a hot key is one row.
    """
    parts = []
    for child, column, parent in FOREIGN_KEYS:
        used = getattr(tables, child)(column).groupBy(column).agg(rows().alias("n"))
        orphans = used.join(getattr(tables, parent)(column), column, "left_anti")
        parts.append(
            orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"), rows().alias("orphan_keys")).select(
                F.lit(f"{child}.{column}").alias("foreign_key"), "orphan_rows", "orphan_keys"
            )
        )
    return union_all(parts)


def null_rule_check(tables) -> DataFrame:
    """Violations of the rules on missing and out-of-range values."""
    finished = F.col("status").isin(FINISHED)
    hours = F.col("resolution_hours")

    def outside(column: str, low: float, high: float):
        return F.coalesce(~F.col(column).between(low, high), F.lit(False))

    rules = [
        ("finished ticket without resolution time", "support_tickets", finished & hours.isNull()),
        ("open ticket with resolution time", "support_tickets", ~finished & hours.isNotNull()),
        ("satisfaction outside 1 to 5", "support_tickets", outside("satisfaction_rating", 1, 5)),
        ("sentiment outside -1 to 1", "customer_interactions", outside("sentiment_score", -1, 1)),
        ("churn risk outside 0 to 1", "customers", outside("churn_risk_score", 0, 1)),
        ("health outside 0 to 100", "customers", outside("health_score", 0, 100)),
        ("rating outside 1 to 5", "product_reviews", outside("rating", 1, 5)),
    ]
    columns = {
        "support_tickets": ["status", "resolution_hours", "satisfaction_rating"],
        "customer_interactions": ["sentiment_score"],
        "customers": ["churn_risk_score", "health_score"],
        "product_reviews": ["rating"],
    }
    parts = []
    for table, names in columns.items():
        mine = [(rule, condition) for rule, t, condition in rules if t == table]
        # One pass per table; each rule is a conditional count turned into a row.
        counted = getattr(tables, table)(*names).agg(
            rows().alias("n"), *[F.count_if(c).alias(f"v{i}") for i, (_, c) in enumerate(mine)]
        )
        entries = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"v{i}").alias("violations")) for i, (rule, _) in enumerate(mine)])
        parts.append(counted.select(F.explode(entries).alias("e"), F.col("n").alias("checked")).select("e.rule", "checked", "e.violations"))
    return union_all(parts)


def accepted_values(tables) -> DataFrame:
    """Every value of the enumerated columns with its count and whether it is a known one."""
    parts = []
    for table in dict.fromkeys(t for t, *_ in ENUMERATED):
        mine = {column: known for t, column, known in ENUMERATED if t == table}
        # One pass per table: a row becomes one entry per column, counted before the shuffle.
        entries = F.array(*[F.struct(F.lit(column).alias("column"), F.col(column).alias("value")) for column in mine])
        listed = getattr(tables, table)(*mine).select(F.explode(entries).alias("e")).groupBy("e.column", "e.value").agg(rows().alias("n_rows"))
        accepted = F.lit(None).cast("boolean")
        for column, known in mine.items():
            accepted = F.when(F.col("column") == column, F.col("value").isin(known)).otherwise(accepted)
        parts.append(listed.select(F.concat(F.lit(f"{table}."), "column").alias("column_name"), "value", "n_rows", accepted.alias("accepted")))
    return union_all(parts)
