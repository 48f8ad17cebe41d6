"""Every registered query equals its SQL on the smallest data."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from supportlens.oracle.sql import ORACLES
from supportlens.plans.queries import QUERIES
from tests.check import compare, connect



@pytest.fixture(scope="session")
def duck(small_dir):
    return connect(small_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, small_dir, name):
    same, note, _ = compare(spark, duck, small_dir, QUERIES[name], ORACLES[name])
    assert same, note


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


# Queries that are cut by what they are: published list lengths of the tools, numbers of search results, and the five
# customers that the quarterly review asks for.
CUT = {
    "at_risk_customers": [25], "escalated_tickets": [50], "agent_performance": [25], "overdue_payments": [50],
    "product_ticket_correlation": [20], "product_ticket_correlation_distinct": [20], "qbr_pack": [5, 50],
    "search_tickets_data_failures": [5], "search_tickets_slow": [5], "search_reviews_positive": [5],
    "search_reviews_integration": [5], "search_filtered": [5], "search_after_sync": [5], "search_vector_topk": [5], "search_lsh": [5],
}


def test_only_these_queries_are_cut():
    found = {name: sorted(map(int, re.findall(r"\bLIMIT (\d+)", sql))) for name, sql in ORACLES.items()}
    assert {name: limits for name, limits in found.items() if limits} == CUT


def test_registry_holds_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "product_name", "category", "customers_with_tickets", "total_tickets_from_buyers", "avg_ticket_priority_score",
    ]
    assert df.count() == 20
