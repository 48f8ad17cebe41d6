"""The SQL functions give what the Python calls give."""

from __future__ import annotations

import pytest

from supportlens.plans import tools
from supportlens.sources.domain import StarTables
from tests.conftest import as_set

CALLS = {
    "get_customer_health_summary": ({"customer_ids": '["1", "42", "nobody"]'}, "customer_ids => '[\"1\", \"42\", \"nobody\"]'"),
    "get_at_risk_customers": ({"min_churn_risk": 0.6}, "0.6"),
    "get_customers_by_industry": ({"industries": '["BUILDING", "x"]'}, "'[\"BUILDING\", \"x\"]'"),
    "get_customer_engagement_summary": ({"customer_ids": "[1, 2, 149]"}, "'[1, 2, 149]'"),
    "get_ticket_stats_by_category": ({"categories": '["Bug", "Data"]'}, "'[\"Bug\", \"Data\"]'"),
    "get_escalated_tickets": ({}, ""),
    "get_agent_performance": ({}, ""),
    "get_sla_breach_summary": (
        {"max_first_response_min": 60, "max_resolution_hours": 24},
        "max_resolution_hours => 24, max_first_response_min => 60",
    ),
    "get_product_defect_rates": ({"categories": '["SMALL"]'}, "'[\"SMALL\"]'"),
    "get_product_revenue": ({}, ""),
    "get_product_review_summary": ({"product_ids": '["3", "7"]'}, "'[\"3\", \"7\"]'"),
    "get_product_ticket_correlation": ({}, ""),
    "get_revenue_by_plan_tier": ({}, ""),
    "get_overdue_payments": ({}, ""),
    "get_order_trends_by_type": ({"order_types": '["New"]'}, "'[\"New\"]'"),
    "list_valid_ticket_categories": ({}, ""),
    "list_valid_priorities": ({}, ""),
    "list_valid_industries": ({}, ""),
    "list_valid_plan_tiers": ({}, ""),
    "list_valid_product_categories": ({}, ""),
}


@pytest.fixture(scope="module")
def star(spark, small_dir):
    tables = StarTables(spark, small_dir)
    tools.register_sql(tables)
    return tables


def test_twenty_functions_are_registered(spark, star):
    assert len(tools.TOOLS) == 20 and set(CALLS) == set(tools.BY_NAME)
    assert tools.registered(spark) == sorted(CALLS)


@pytest.mark.parametrize("name", sorted(CALLS))
def test_same_result(spark, star, name):
    params, arguments = CALLS[name]
    python = tools.call(star, name, **params)
    sql = spark.sql(f"SELECT * FROM {name}({arguments})")
    assert sql.columns == python.columns
    assert [f.dataType for f in sql.schema] == [f.dataType for f in python.schema]
    assert as_set(sql) == as_set(python)
    assert sql.count() > 0


@pytest.mark.parametrize("bad", ["NULL", "'oops'", "'[]'", "'{}'", "'\"a\"'"])
def test_odd_lists_give_no_rows(spark, star, bad):
    assert spark.sql(f"SELECT * FROM get_customers_by_industry({bad})").count() == 0


@pytest.mark.parametrize("param", ['["007"]', '["-0"]', '["99999999999999999999"]', "[1.0]", "[7, 8]", '["7", null]', '[" 7"]', '["+7"]', '["\u0667"]'])
def test_numbers_as_text_mean_the_same(spark, star, param):
    python = tools.call(star, "get_customer_health_summary", customer_ids=param)
    assert as_set(python) == as_set(spark.sql(f"SELECT * FROM get_customer_health_summary({tools.quoted(param)})"))


@pytest.mark.parametrize("param", ['["BUILDING"] x', "['BUILDING']", '["BUILDING"', '"BUILDING"', '{"a": "BUILDING"}', '[["BUILDING"]]', ' ["BUILDING"] ', ""])
def test_odd_texts_mean_the_same(spark, star, param):
    python = tools.call(star, "get_customers_by_industry", industries=param)
    assert as_set(python) == as_set(spark.sql(f"SELECT * FROM get_customers_by_industry({tools.quoted(param)})"))


def test_comments_are_escaped():
    assert tools.quoted("it's a \\ test") == "'it\\'s a \\\\ test'"
