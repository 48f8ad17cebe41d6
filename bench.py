"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names, or "all"
BENCH_REPEAT  runs per query, of which the fastest counts (default 2)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from supportlens.functions.expressions import priority_score, rounded
from supportlens.plans.queries import QUERIES
from supportlens.session import build_session
from supportlens.sources.domain import StarTables

HEADLINE = [
    "customer_health_summary", "at_risk_customers", "customers_by_industry", "customer_engagement",
    "ticket_stats_by_category", "escalated_tickets", "agent_performance", "sla_breach_summary",
    "product_defect_rates", "product_revenue", "product_review_summary", "product_ticket_correlation",
    "revenue_by_plan_tier", "overdue_payments", "order_trends_by_type", "list_ticket_categories",
    "index_build_tickets", "index_build_reviews", "search_tickets_data_failures", "search_reviews_integration",
    "search_filtered", "search_text_topk", "similar_tickets", "search_vector_topk", "knn_join", "search_ivf",
    "route_questions", "change_feed", "index_sync_triggered", "index_upsert",
    "at_risk_critical_negative", "critical_perf_customers", "product_action_plan", "qbr_pack", "at_risk_products_used",
    "error_patterns", "review_themes", "key_quotes", "template_clusters",
]


def naive_correlation(t: StarTables):
    """The many-to-many join written out, as the yardstick for product_ticket_correlation."""
    orders = t.purchases("customer_id", "product_id", "product_name")
    joined = orders.join(t.products("product_id", "category"), "product_id").join(
        t.support_tickets("ticket_id", "customer_id", "priority"), "customer_id"
    )
    return (
        joined.groupBy("product_name", "category")
        .agg(
            F.countDistinct("customer_id").alias("customers_with_tickets"),
            F.count("ticket_id").alias("total_tickets_from_buyers"),
            rounded(F.avg(priority_score(F.col("priority"))), 2).alias("avg_ticket_priority_score"),
        )
        .orderBy(F.desc("total_tickets_from_buyers"), "product_name", "category")
        .limit(20)
    )


def timed(build) -> float:
    """Fastest of a few runs, from building the DataFrame to its last row."""
    runs = []
    for _ in range(int(os.environ.get("BENCH_REPEAT", "2"))):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - start)
    return round(min(runs), 3)


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="bench-") as shared:
        run(shared)


def run(shared: str) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session(**{
        "spark.master": f"local[{cpus}]", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.checkpoint.dir": shared, "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in names:
        times[name] = timed(lambda: QUERIES[name](spark, folder))
        print(f"{name:36s} {times[name]:8.2f}", file=sys.stderr, flush=True)
    yardstick = {"product_ticket_correlation": timed(lambda: naive_correlation(StarTables(spark, folder)))}
    line = {
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "naive": yardstick, "sf": folder.rstrip("/").rsplit("/sf", 1)[-1], "cpus": int(cpus),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
