"""Shapes of the physical plans, and a hot customer."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from supportlens.functions.expressions import priority_score, rounded
from supportlens.operators import customer, product, revenue, support
from supportlens.plans import cross_domain, history, patterns
from supportlens.sources.domain import StarTables
from tests.conftest import as_set, plan_of


@pytest.fixture(scope="module")
def star(spark, small_dir):
    return StarTables(spark, small_dir)


def schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_list_parameters_reach_the_scan(star):
    plan = plan_of(customer.customers_by_industry(star, ["BUILDING", "MACHINERY"]))
    assert "In(c_mktsegment, [BUILDING,MACHINERY])" in plan
    plan = plan_of(customer.customer_health_summary(star, "[1, 2]"))
    assert "In(c_custkey, [1,2])" in plan


def test_only_needed_files_and_columns_are_read(star):
    plan = plan_of(revenue.order_trends_by_type(star, ["New"]))
    assert "orders.parquet" not in plan and "part.parquet" not in plan
    assert schemas(plan) == ["l_linenumber:int,l_extendedprice:double,l_discount:double"]
    plan = plan_of(support.ticket_stats_by_category(star, ["Bug"]))
    assert "documents.parquet" not in plan


def test_all_enterprise_customers_at_risk(star):
    found = cross_domain.enterprise_at_risk(star).collect()
    everyone = star.customers("customer_id", "plan_tier", "churn_risk_score").where("plan_tier = 'Enterprise' AND churn_risk_score > 0.6")
    assert sorted(r.customer_id for r in found) == sorted(r.customer_id for r in everyone.collect())


def test_details_are_looked_up_for_the_chosen_customers_only(star):
    plan = plan_of(customer.at_risk_customers(star, 0.5))
    orders = [part for part in plan.split("\n\n") if "orders.parquet" in part]
    assert orders and all("In(o_custkey" in part for part in orders)


def test_unpaid_list_joins_a_handful_of_orders_without_a_shuffle(spark, star):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = plan_of(revenue.overdue_payments(star)).split("\n\n")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in tree and "BroadcastHashJoin" in tree


def test_ids_reach_both_sides_of_the_engagement_join(star):
    plan = plan_of(customer.customer_engagement(star, "[3]"))
    assert plan.count("EqualTo(user_id,3)") + plan.count("In(user_id, [3])") >= 2


def test_no_cross_or_nested_loop_joins(star):
    plans = [
        cross_domain.at_risk_critical_negative(star),
        cross_domain.critical_recent_customers(star),
        cross_domain.product_action_plan(star),
        cross_domain.qbr_pack(star),
        cross_domain.at_risk_products_used(star),
        product.product_ticket_correlation(star),
        history.week_apart(star)[0],
    ]
    for df in plans:
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_orders_are_reduced_before_the_product_join(star):
    tree = plan_of(product.product_revenue(star)).split("\n\n")[0]
    join = tree.index("Join")
    assert "HashAggregate" in tree[join:]


def test_hot_customer_equals_the_written_out_join(spark, tables):
    """One customer with a third of all orders and tickets: 600 x 300 pairs stay unwritten."""
    who = lambda i: "HOT" if i % 3 == 0 else f"C{i % 97}"
    t = tables(
        products=[{"product_id": f"P{i}", "name": f"N{i % 5}", "category": f"K{i % 2}"} for i in range(10)],
        purchases=[
            {"order_id": str(i), "customer_id": who(i), "product_id": f"P{i % 10}", "product_name": f"N{i % 5}"} for i in range(1800)
        ],
        support_tickets=[
            {"ticket_id": str(i), "customer_id": who(i), "priority": ["Critical", "High", "Medium", "Low"][i % 4]} for i in range(900)
        ],
    )
    joined = (
        t.purchases("customer_id", "product_id", "product_name")
        .join(t.products("product_id", "category"), "product_id")
        .join(t.support_tickets("ticket_id", "customer_id", "priority"), "customer_id")
    )
    naive = joined.groupBy("product_name", "category").agg(
        F.countDistinct("customer_id").alias("customers_with_tickets"),
        F.count("ticket_id").alias("total_tickets_from_buyers"),
        rounded(F.avg(priority_score(F.col("priority"))), 2).alias("avg_ticket_priority_score"),
    )
    assert as_set(product.correlation_metrics(t)) == as_set(naive)


def test_word_pairs_are_added_up_after_one_shuffle(tables, monkeypatch):
    # Several batches of words and shares of pairs; customers and texts may be missing, and a review repeats a pair.
    monkeypatch.setattr(patterns, "REVIEWS", 2)
    monkeypatch.setattr(patterns, "WORDS", 5)
    draw = random.Random(3)
    reviews = [{"customer_id": draw.choice(["a", "b", "c", None]), "review_text": " ".join(draw.choices(["Top", "top", "é", "slow,", "1"], k=draw.randint(0, 9)))} for _ in range(60)]
    reviews += [{"customer_id": "a", "review_text": None}, {"customer_id": "d", "review_text": "only here"}, {"customer_id": "d", "review_text": "only here"}]
    seen = {}
    for r in reviews:
        words = re.findall(r"[^\W\d_]+", (r["review_text"] or "").lower())
        for theme in {f"{a} {b}" for a, b in zip(words, words[1:])}:
            seen.setdefault(theme, []).append(r["customer_id"])
    found = patterns.review_themes(tables(product_reviews=reviews))
    assert {tuple(r) for r in found.collect()} == {(t, len(set(c)), len(c)) for t, c in seen.items() if len(set(c)) > 1}
    assert ("only here", 1, 2) in {tuple(r) for r in patterns.review_themes(tables(product_reviews=reviews), min_customers=1).collect()}
    # One exchange serves the sums by pair and customer, and those by pair.
    assert plan_of(patterns.review_themes(tables(product_reviews=reviews))).count("hashpartitioning") == 1
    assert patterns.review_themes(tables()).count() == 0
