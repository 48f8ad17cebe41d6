from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from supportlens.session import build_session
from supportlens.sources.domain import FrameTables

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

SCHEMAS = {
    "customers": "customer_id string, company_name string, industry string, region string, plan_tier string, "
    "monthly_recurring_revenue double, lifetime_value double, health_score double, churn_risk_score double, "
    "nps_score bigint, support_tier string, csm_assigned string, last_login_date string",
    "products": "product_id string, name string, category string, tier string, price double, avg_rating double, "
    "defect_rate double, status string",
    "support_tickets": "ticket_id string, customer_id string, subject string, description string, category string, "
    "priority string, status string, channel string, assigned_agent string, created_at string, resolution_hours double, "
    "satisfaction_rating bigint, first_response_minutes double, num_replies bigint, tags string",
    "purchases": "order_id string, customer_id string, product_id string, product_name string, order_date string, "
    "amount double, discount_percent bigint, order_type string, payment_status string",
    "customer_interactions": "interaction_id string, customer_id string, channel string, sentiment_score double, csat_score bigint",
    "product_reviews": "review_id string, customer_id string, product_id string, product_name string, review_text string, "
    "rating bigint, verified_purchase boolean, helpful_votes bigint",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]", "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture
def tables(spark):
    """Builds the six tables from short rows: tables(customers=[{...}], ...)."""

    def build(**rows) -> FrameTables:
        frames = {}
        for name, schema in SCHEMAS.items():
            columns = [c.split()[0] for c in schema.split(", ")]
            data = [tuple(row.get(c) for c in columns) for row in rows.get(name, [])]
            frames[name] = spark.createDataFrame(data, schema)
        return FrameTables(spark, frames)

    return build


def as_set(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
