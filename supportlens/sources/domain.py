"""The six support tables, either as they are or derived from the star schema.

Every reader takes the column names it needs and returns exactly those. A view
that is derived from several files joins only the files those columns come from,
so a report over order types never pays for the customer or product join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ticket categories with the subject prefixes in use for each.
SUBJECT_PREFIXES = {
    "Integration": ["Connector failure:", "Sync issue:", "Integration error:"],
    "Performance": ["Slow dashboard:", "Query timeout:", "Performance degradation:"],
    "Bug": ["Data mismatch:", "Incorrect calculation:", "Display error:"],
    "Feature Request": ["Feature request:", "Enhancement needed:", "Requesting:"],
    "Account": ["Billing inquiry:", "Account question:", "Seat adjustment:"],
    "Access": ["Login issue:", "SSO problem:", "Access denied:"],
    "Data": ["Pipeline failure:", "Data sync issue:", "Missing data:"],
    "Onboarding": ["Training request:", "Onboarding help:", "Need guidance:"],
}
DEFAULT_PREFIX = "Issue:"

# Vocabularies of the enumerated columns.
PLAN_TIERS = ["Starter", "Professional", "Enterprise", "Enterprise Plus"]
SUPPORT_TIERS = ["Standard", "Priority", "Premier"]
PRIORITIES = ["Critical", "High", "Medium", "Low"]
STATUSES = ["Open", "In Progress", "Pending Customer", "Escalated", "Resolved", "Closed"]
ORDER_TYPES = ["New", "Renewal", "Upgrade", "Add-on"]
PAYMENT_STATUSES = ["Paid", "Pending", "Overdue", "Refunded"]
INTERACTION_CHANNELS = ["Email", "Phone", "Video Call", "Chat", "In-Person", "Slack"]
TICKET_CHANNELS = ["Email", "Chat", "Phone", "Portal", "Slack"]
TICKET_TAGS = ["urgent", "escalated", "enterprise", "regression", "sla-breach", "vip", "renewal-risk", "product-feedback"]
ERROR_CODES = ["E-4001", "E-5002", "E-3090", "E-2045", "E-7801", "E-6033", "TIMEOUT-001", "AUTH-403", "SYNC-500", "RATE-429"]

CATEGORIES = list(SUBJECT_PREFIXES)

# What the mapped tickets and reviews say before their free text.
ERROR_TEXTS = ["connection lost", "login refused", "too many requests", "schema changed", "partition missing"]
REVIEW_OPENINGS = [
    "The connector is broken and data is not flowing",
    "Integration sync keeps failing and is unreliable",
    "It does the job but the dashboard is slow",
    "Good analytics features and a helpful support team",
    "Predictive analytics and AI features transformed our business",
]

TABLE_NAMES = ["products", "customers", "support_tickets", "purchases", "customer_interactions", "product_reviews"]


def pick(values: list[str], index: Column) -> Column:
    """The value at a zero-based position of a short constant list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def steps(number: Column, bounds: list[int], values: list[str]) -> Column:
    """The first value whose upper bound exceeds ``number``, else the last value."""
    result = None
    for bound, value in zip(bounds, values):
        result = F.when(number < bound, value) if result is None else result.when(number < bound, value)
    return result.otherwise(values[-1])


class FrameTables:
    """The six tables as given DataFrames."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame]):
        self.spark = spark
        self._frames = frames

    def _table(self, name: str, columns: tuple[str, ...]) -> DataFrame:
        df = self._frames[name]
        return df.select(*columns) if columns else df

    def products(self, *columns: str) -> DataFrame:
        return self._table("products", columns)

    def customers(self, *columns: str) -> DataFrame:
        return self._table("customers", columns)

    def support_tickets(self, *columns: str) -> DataFrame:
        return self._table("support_tickets", columns)

    def purchases(self, *columns: str, only: Column | None = None, few: bool = False) -> DataFrame:
        """Orders, or those where ``only`` holds; ``few`` says that they are known to fit a broadcast."""
        df = self._frames["purchases"]
        df = df if only is None else df.where(only)
        df = df.select(*columns) if columns else df
        return F.broadcast(df) if few else df

    def customer_interactions(self, *columns: str) -> DataFrame:
        return self._table("customer_interactions", columns)

    def product_reviews(self, *columns: str) -> DataFrame:
        return self._table("product_reviews", columns)


class CatalogTables(FrameTables):
    """Reads the six tables from a catalog database; orders go by their own name there."""

    def __init__(self, spark: SparkSession, database: str = "", purchases: str = "orders"):
        prefix = f"{database}." if database else ""
        names = {name: name for name in TABLE_NAMES} | {"purchases": purchases}
        super().__init__(spark, {name: spark.table(prefix + found) for name, found in names.items()})


class StarTables:
    """Derives the six tables from the star-schema parquet files of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    @staticmethod
    def _project(df: DataFrame, derived: dict[str, Column], columns: tuple[str, ...]) -> DataFrame:
        return df.select(*[derived[name].alias(name) for name in (columns or derived)])

    def customers(self, *columns: str) -> DataFrame:
        k = F.col("c_custkey")
        derived = {
            "customer_id": k,
            "company_name": F.col("c_name"),
            "industry": F.col("c_mktsegment"),
            "region": F.col("r_name"),
            "csm_assigned": F.col("n_name"),
            "plan_tier": steps(k % 20, [6, 13, 18], PLAN_TIERS),
            "monthly_recurring_revenue": F.col("c_acctbal"),
            "lifetime_value": F.col("c_acctbal") * 12,
            "churn_risk_score": (k * 37 % 101).cast("double") / 100,
            "health_score": F.greatest(F.lit(0), F.least(F.lit(100), 100 - k * 37 % 101 + k * 13 % 21 - 10)).cast("double"),
            "nps_score": (k * 53 % 201 - 100).cast("int"),
            "support_tier": pick(SUPPORT_TIERS, k % 3),
            "last_login_date": F.col("last_order"),
        }
        wanted = set(columns or derived)
        df = self.raw("customer")
        # nation and region are fixed at 25 and 5 rows.
        if wanted & {"csm_assigned", "region"}:
            df = df.join(F.broadcast(self.raw("nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        if "region" in wanted:
            df = df.join(F.broadcast(self.raw("region")), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        if "last_login_date" in wanted:
            last = self.raw("orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
            df = df.join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
        return self._project(df, derived, columns)

    def products(self, *columns: str) -> DataFrame:
        k = F.col("p_partkey")
        derived = {
            "product_id": k,
            "name": F.col("p_name"),
            "category": F.col("p_type"),
            "tier": F.col("p_brand"),
            "price": F.col("p_retailprice"),
            "avg_rating": (32 + k * 11 % 18).cast("double") / 10,
            "defect_rate": (1 + k * 7 % 80).cast("double") / 1000,
            "status": steps(k % 6, [4, 5], ["GA", "Beta", "Deprecated"]),
        }
        return self._project(self.raw("part"), derived, columns)

    def purchases(self, *columns: str, only: Column | None = None, few: bool = False) -> DataFrame:
        """Order lines with customer and product.

        ``only`` is a condition on columns of the line itself and holds before any
        join; ``few`` says that the remaining lines are known to fit a broadcast.
        """
        line = {
            "order_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
            "product_id": F.col("l_partkey"),
            "amount": F.col("l_extendedprice"),
            "discount_percent": F.round(F.col("l_discount") * 100).cast("int"),
            "discount_rate": F.col("l_discount"),
            "order_type": pick(ORDER_TYPES, F.col("l_linenumber") % 4),
            "payment_status": steps(F.col("l_orderkey") % 100, [80, 90, 97], PAYMENT_STATUSES),
        }
        looked_up = {"customer_id": F.col("o_custkey"), "order_date": F.col("o_orderdate"), "product_name": F.col("p_name")}
        columns = columns or (*line, *looked_up)
        df = self.raw("lineitem").select("l_orderkey", "l_partkey", *[c.alias(name) for name, c in line.items()])
        df = df if only is None else df.where(only)

        def side(lines: DataFrame) -> DataFrame:
            return F.broadcast(lines) if few else lines

        if {"customer_id", "order_date"} & set(columns):
            df = side(df).join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        if "product_name" in columns:
            df = side(df).join(self.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
        return side(df.select(*[looked_up[name].alias(name) if name in looked_up else name for name in columns]))

    def support_tickets(self, *columns: str) -> DataFrame:
        e = F.col("event_id")
        k = F.get_json_object("props", "$.k").cast("int")
        status_code = e % 20
        category = pick(CATEGORIES, F.col("user_id") % 8)
        prefix = pick([p for prefixes in SUBJECT_PREFIXES.values() for p in prefixes], F.col("user_id") % 8 * 3 + e % 3)
        report = F.concat(
            prefix, F.lit(" "), F.col("event_type"), F.lit(" reported as "), pick(ERROR_CODES, k % 10),
            F.lit(' "'), pick(ERROR_TEXTS, e % 5), F.lit('" after '), (k % 25 + 1).cast("string"), F.lit(" replies"),
        )
        derived = {
            "ticket_id": e,
            "customer_id": F.col("user_id"),
            "subject": report,
            "description": F.concat(report, F.lit(". "), F.coalesce(F.col("text"), F.lit(""))),
            "category": category,
            "priority": steps(k, [5, 25, 75], PRIORITIES),
            "status": steps(status_code, [3, 8, 10, 11, 17], STATUSES),
            "channel": pick(TICKET_CHANNELS, e % 5),
            "assigned_agent": F.concat(F.lit("agent-"), (e % 97).cast("string")),
            "created_at": F.col("ts"),
            "resolution_hours": F.when(status_code >= 11, F.col("value")),
            "first_response_minutes": (50 + e * 31 % 4751).cast("double") / 10,
            "satisfaction_rating": F.when(e * 3 % 7 < 5, e * 3 % 7 + 1),
            "num_replies": k % 25 + 1,
            "tags": F.concat_ws(
                ",",
                pick(TICKET_TAGS, e % 8),
                F.when(k % 3 > 0, pick(TICKET_TAGS, (e + 1) % 8)),
                F.when(k % 3 > 1, pick(TICKET_TAGS, (e + 2) % 8)),
            ),
        }
        df = self.raw("events").where(F.col("event_type").isin("error", "purchase"))
        if "description" in (columns or derived):
            df = df.join(self.raw("documents"), e == F.col("doc_id"), "left")
        return self._project(df, derived, columns)

    def customer_interactions(self, *columns: str) -> DataFrame:
        e = F.col("event_id")
        k = F.get_json_object("props", "$.k").cast("int")
        derived = {
            "interaction_id": e,
            "customer_id": F.col("user_id"),
            "interaction_type": F.col("event_type"),
            "event_ts": F.col("ts"),
            "channel": pick(INTERACTION_CHANNELS, e % 6),
            "sentiment_score": (k - 50).cast("double") / 50,
            "csat_score": F.when(e * 5 % 6 < 5, e * 5 % 6 + 1),
        }
        df = self.raw("events").where(F.col("event_type").isin("click", "view", "signup"))
        return self._project(df, derived, columns)

    def product_reviews(self, *columns: str) -> DataFrame:
        d, n = F.col("doc_id"), F.col("n_chars")
        rating = n % 5 + 1
        derived = {
            "review_id": d,
            "customer_id": d * 7 % 150,
            "product_id": d % 50,
            "product_name": F.col("p_name"),
            "review_text": F.concat(
                F.coalesce("p_name", F.lit("")), F.lit(". "), pick(REVIEW_OPENINGS, n % 5), F.lit(". "), F.coalesce("text", F.lit("")),
                F.when(n % 2 == 0, F.concat(F.lit(" Rating: "), rating.cast("string"), F.lit("/5"))).otherwise(""),
            ),
            "given_rating": n * 3 % 5 + 1,
            "rating": rating,
            "helpful_votes": n % 51,
            "verified_purchase": F.coalesce(F.col("quality"), F.lit(0)) == 1,
        }
        wanted = set(columns or derived)
        df = self.raw("documents")
        if wanted & {"product_name", "review_text"}:
            # product_id is 0..49, so at most 50 product rows can match.
            reviewed = self.raw("part").where(F.col("p_partkey") < 50).select("p_partkey", "p_name")
            df = df.join(F.broadcast(reviewed), d % 50 == F.col("p_partkey"), "left")
        if "verified_purchase" in wanted:
            labels = self.raw("labels").withColumnRenamed("doc_id", "label_doc_id")
            df = df.join(labels, d == F.col("label_doc_id"), "left")
        return self._project(df, derived, columns)


def register_views(tables: StarTables | FrameTables) -> None:
    """Publish the six tables as temporary views of the session."""
    for name in TABLE_NAMES:
        getattr(tables, name)().createOrReplaceTempView(name)
