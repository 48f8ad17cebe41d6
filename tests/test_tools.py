"""Edge cases of the table functions on tiny tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from supportlens.functions.params import parse_list
from supportlens.operators import customer, lookups, product, revenue, support
from tests.conftest import as_set

CUSTOMERS = [
    {"customer_id": "C1", "plan_tier": "Enterprise", "churn_risk_score": 0.5, "monthly_recurring_revenue": 10.0, "industry": "Retail"},
    {"customer_id": "C2", "plan_tier": "Starter", "churn_risk_score": 0.49, "monthly_recurring_revenue": 5.0, "industry": "Media"},
    {"customer_id": "C3", "plan_tier": "Starter", "churn_risk_score": 0.9, "monthly_recurring_revenue": 1.0, "industry": "Retail"},
]


@pytest.mark.parametrize("param", ["[]", "oops", None, '"a"', "{}", '{"a": 1}', '["nobody"]', [], "[null]"])
def test_lists_that_match_nothing(tables, param):
    t = tables(customers=CUSTOMERS)
    assert customer.customer_health_summary(t, param).count() == 0


def test_list_elements_as_text(spark):
    assert parse_list(spark, '[1, null, "b", {"a":1}, true]') == ["1", "b", '{"a":1}', "true"]
    assert parse_list(spark, [1, None, "b", True]) == ["1", "b", "true"]


@pytest.mark.parametrize("param", ['["C1", "zzz"]', ["C1"], ("C1", "C1")])
def test_list_forms(tables, param):
    t = tables(customers=CUSTOMERS)
    assert [r.customer_id for r in customer.customer_health_summary(t, param).collect()] == ["C1"]


def test_ids_from_another_table(spark, tables):
    t = tables(customers=CUSTOMERS)
    ids = spark.createDataFrame([("C1",), ("C1",), ("C3",), ("x",)], "who string")
    assert sorted(r.customer_id for r in customer.customer_health_summary(t, ids).collect()) == ["C1", "C3"]


def test_long_lists_use_a_semi_join(tables):
    t = tables(customers=CUSTOMERS)
    many = [f"N{i}" for i in range(600)] + ["C2"]
    assert [r.customer_id for r in customer.customer_health_summary(t, many).collect()] == ["C2"]


def test_threshold_is_included_and_predicate_precedes_the_cut(tables):
    t = tables(customers=CUSTOMERS)
    assert [r.customer_id for r in customer.at_risk_customers(t, 0.5).collect()] == ["C3", "C1"]
    starters = customer.at_risk_customers(t, 0.0, predicate=F.col("plan_tier") == "Starter", limit=1)
    assert [r.customer_id for r in starters.collect()] == ["C3"]


def test_ties_at_the_cut_are_broken_by_key(tables):
    many = [{"customer_id": f"C{i:03d}", "churn_risk_score": 0.7} for i in range(60)]
    found = [r.customer_id for r in customer.at_risk_customers(tables(customers=many), 0.5).collect()]
    assert found == [f"C{i:03d}" for i in range(25)]


def test_customer_without_contacts_or_tickets(tables):
    t = tables(customers=CUSTOMERS[:1])
    row = customer.customer_engagement(t, ["C1"]).first()
    assert (row.total_interactions, row.total_support_tickets) == (0, 0)
    assert row.avg_sentiment is None and row.avg_csat is None and row.most_common_channel is None and row.avg_resolution_hours is None


def test_tied_channels_and_missing_scores(tables):
    contacts = [
        {"interaction_id": "1", "customer_id": "C1", "channel": "Phone", "sentiment_score": 0.5},
        {"interaction_id": "2", "customer_id": "C1", "channel": "Chat", "sentiment_score": 0.25, "csat_score": 4},
        {"interaction_id": "3", "customer_id": "C1", "channel": None, "sentiment_score": 0.0},
        {"interaction_id": "4", "customer_id": "C1", "channel": None, "sentiment_score": 0.0},
    ]
    row = customer.customer_engagement(tables(customers=CUSTOMERS[:1], customer_interactions=contacts), ["C1"]).first()
    assert row.most_common_channel == "Chat"
    assert (row.total_interactions, row.avg_sentiment, row.avg_csat) == (4, 0.19, 4.0)


def ticket(i, **more):
    return {"ticket_id": f"T{i}", "customer_id": "C1", "category": "Bug", "priority": "Low", "status": "Open", **more}


def test_sla_limits_are_strict_and_unresolved_never_breaches(tables):
    t = tables(
        support_tickets=[
            ticket(1, first_response_minutes=60.0, resolution_hours=24.0),
            ticket(2, first_response_minutes=60.5, resolution_hours=None),
            ticket(3, first_response_minutes=1.0, resolution_hours=24.5),
            ticket(4, first_response_minutes=None, resolution_hours=None),
        ]
    )
    row = support.sla_breach_summary(t, 60, 24).first()
    assert (row.breached_response_sla, row.breached_resolution_sla, row.total_tickets, row.breach_rate_pct) == (1, 1, 4, 50.0)


def test_agents_without_resolutions_come_first(tables):
    t = tables(
        support_tickets=[
            ticket(1, assigned_agent="fast", status="Closed", resolution_hours=1.0),
            ticket(2, assigned_agent="none"),
            ticket(3, assigned_agent="slow", status="Resolved", resolution_hours=9.0),
        ]
    )
    assert [r.assigned_agent for r in support.agent_performance(t).collect()] == ["none", "fast", "slow"]


def test_pending_customer_is_not_open(tables):
    t = tables(support_tickets=[ticket(1, status="Pending Customer"), ticket(2, status="Escalated"), ticket(3, status="Closed")])
    row = support.ticket_stats_by_category(t, '["Bug"]').first()
    assert (row.total_tickets, row.open_tickets, row.avg_resolution_hours) == (3, 1, None)


def test_escalations_by_urgency_then_age(tables):
    t = tables(
        support_tickets=[
            ticket(1, status="Escalated", priority="High", created_at="2024-01-01"),
            ticket(2, status="Open", priority="Critical", created_at="2024-01-03"),
            ticket(3, status="Escalated", priority="Critical", created_at="2024-01-02"),
            ticket(4, status="Closed", priority="Critical", created_at="2024-01-01"),
            ticket(5, status="Escalated", priority="Low", created_at="2023-01-01"),
            ticket(6, status="Escalated", priority="Medium", created_at="2024-01-01"),
        ]
    )
    assert [r.ticket_id for r in support.escalated_tickets(t).collect()] == ["T3", "T2", "T1", "T5", "T6"]


def test_repeat_orders_count_tickets_again(tables):
    t = tables(
        products=[{"product_id": "P1", "name": "Desk", "category": "Tools"}],
        purchases=[{"order_id": str(i), "customer_id": "C1", "product_id": "P1", "product_name": "Desk"} for i in range(2)],
        support_tickets=[ticket(1, priority="Critical")],
    )
    assert [tuple(r) for r in product.product_ticket_correlation(t).collect()] == [("Desk", "Tools", 1, 2, 4.0)]
    once = product.product_ticket_correlation(t, repeat_orders=False)
    assert [tuple(r) for r in once.collect()] == [("Desk", "Tools", 1, 1, 4.0)]


def test_same_name_in_two_products_counts_a_customer_once(tables):
    t = tables(
        products=[{"product_id": p, "name": "Desk", "category": "Tools"} for p in ("P1", "P2")],
        purchases=[{"order_id": p, "customer_id": "C1", "product_id": p, "product_name": "Desk"} for p in ("P1", "P2")],
        support_tickets=[ticket(1, priority="unheard of"), ticket(2)],
    )
    assert [tuple(r) for r in product.product_ticket_correlation(t).collect()] == [("Desk", "Tools", 1, 4, 1.0)]


def orders_of(n, customer_id="C1", amount=None):
    return [
        {
            "order_id": f"O{i:04d}", "customer_id": customer_id, "product_name": "Desk", "payment_status": "Overdue",
            "amount": float(i) if amount is None else amount, "order_date": "2024-01-01",
        }
        for i in range(n)
    ]


def test_unpaid_orders_without_customer_do_not_shorten_the_list(tables):
    # The 60 largest amounts belong to nobody, so the short way would find too few.
    t = tables(customers=CUSTOMERS, purchases=orders_of(60, "gone", 1e6) + orders_of(55))
    found = revenue.overdue_payments(t).collect()
    assert [r.amount for r in found] == [float(i) for i in range(54, 4, -1)]


def test_tied_amounts_are_cut_by_key(tables):
    t = tables(customers=CUSTOMERS, purchases=orders_of(80, amount=7.0))
    assert [r.order_id for r in revenue.overdue_payments(t).collect()] == [f"O{i:04d}" for i in range(50)]


def test_orders_keep_the_name_their_product_had(tables):
    t = tables(
        products=[{"product_id": "P1", "name": "Desk 2", "category": "Tools"}],
        purchases=[
            {"order_id": str(i), "customer_id": "C1", "product_id": "P1", "product_name": name, "amount": 10.0, "discount_percent": 0}
            for i, name in enumerate(["Desk", "Desk 2", "Desk 2"])
        ],
        support_tickets=[ticket(1, priority="Critical")],
    )
    assert [(r.product_name, r.total_orders) for r in product.product_revenue(t).collect()] == [("Desk 2", 2), ("Desk", 1)]
    assert [tuple(r)[:4] for r in product.product_ticket_correlation(t).collect()] == [("Desk 2", "Tools", 1, 2), ("Desk", "Tools", 1, 1)]


@pytest.mark.parametrize("limit, breached", [(None, 0), (float("inf"), 0), (float("nan"), 0), (float("-inf"), 1), (1, 1)])
def test_sla_limits_of_any_kind(tables, limit, breached):
    t = tables(support_tickets=[ticket(1, first_response_minutes=60.0)])
    assert support.sla_breach_summary(t, limit, None).first().breached_response_sla == breached


def test_paid_orders_are_left_out(tables):
    rows = orders_of(2) + [{**orders_of(1)[0], "order_id": "paid", "payment_status": "Paid"}]
    t = tables(customers=CUSTOMERS, purchases=rows)
    assert [r.order_id for r in revenue.overdue_payments(t).collect()] == ["O0001", "O0000"]


def test_parameters_are_checked_against_values_in_use(spark, tables):
    t = tables(customers=CUSTOMERS, support_tickets=[ticket(1)])
    asked = spark.createDataFrame(
        [("industry", "Retail"), ("industry", "Space"), ("priority", "Low"), ("colour", "red"), ("industry", "Space")],
        "parameter string, value string",
    )
    assert as_set(lookups.validate_params(t, asked)) == [("colour", "red"), ("industry", "Space")]
