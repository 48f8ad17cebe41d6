"""The registered queries: name -> (session, data folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supportlens.functions import derive
from supportlens.functions.expressions import FINISHED, rounded, rows
from supportlens.operators import change_feed as feeds
from supportlens.operators import block_index, checks, customer, lookups, product, quantised, revenue, sketches, support
from supportlens.operators import text_index, vector_search
from supportlens.plans import cross_domain, history, patterns, routing, tools
from supportlens.session import new_dir, spread, state_of, stored, written
from supportlens.sources import storage
from supportlens.sources.domain import CATEGORIES, ORDER_TYPES, StarTables
from supportlens.streaming import index_sync

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The search texts of the support team.
TEXT_DATA_FAILURES = "data pipeline failing causing missing data in executive dashboards and board reports"
TEXT_SLOW = "frustrated customer dashboard extremely slow timeout performance degradation"
TEXT_POSITIVE = "amazing predictive analytics machine learning AI features transformed our business"
TEXT_INTEGRATION = "integration connector broken sync failing data not flowing unreliable"

SLA_MINUTES, SLA_HOURS = 60.0, 24.0
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def query(name: str):
    """Register a function of the six tables."""

    def register(build: Callable[[StarTables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(StarTables(spark, sf_dir))
        return build

    return register


def tickets_index(t: StarTables) -> text_index.TextIndex:
    """Index of the ticket texts, built once per application and state of the source files."""

    def build(path: str) -> None:
        text_index.write_index(t.support_tickets("ticket_id", "description"), "ticket_id", "description", path)

    return text_index.TextIndex(t.spark, stored(t.spark, (t.sf_dir, *map(state_of, (t.raw("events"), t.raw("documents"))), "tickets-index"), build), "ticket_id")


def reviews_index(t: StarTables) -> text_index.TextIndex:
    def build(path: str) -> None:
        text_index.write_index(t.product_reviews("review_id", "review_text"), "review_id", "review_text", path)

    return text_index.TextIndex(t.spark, stored(t.spark, (t.sf_dir, *map(state_of, (t.raw("part"), t.raw("documents"))), "reviews-index"), build), "review_id")


# --- table functions -------------------------------------------------------------


@query("customer_health_summary")
def _(t):
    # A chained lookup: the ids are those of every customer who filed a ticket.
    return customer.customer_health_summary(t, t.support_tickets("customer_id"))


@query("at_risk_customers")
def _(t):
    return customer.at_risk_customers(t, 0.5)


@query("customers_by_industry")
def _(t):
    return customer.customers_by_industry(t, SEGMENTS)


@query("customer_engagement")
def _(t):
    return customer.customer_engagement(t, t.customers("customer_id"))


@query("ticket_stats_by_category")
def _(t):
    return support.ticket_stats_by_category(t, CATEGORIES)


@query("escalated_tickets")
def _(t):
    return support.escalated_tickets(t)


@query("agent_performance")
def _(t):
    return support.agent_performance(t)


@query("sla_breach_summary")
def _(t):
    return support.sla_breach_summary(t, SLA_MINUTES, SLA_HOURS)


@query("product_defect_rates")
def _(t):
    return product.product_defect_rates(t, PART_TYPES)


@query("product_revenue")
def _(t):
    return product.product_revenue(t)


@query("product_review_summary")
def _(t):
    return product.product_review_summary(t, t.products("product_id"))


@query("product_ticket_correlation")
def _(t):
    return product.product_ticket_correlation(t)


@query("product_ticket_correlation_distinct")
def _(t):
    return product.product_ticket_correlation(t, repeat_orders=False)


@query("revenue_by_plan_tier")
def _(t):
    return revenue.revenue_by_plan_tier(t)


@query("overdue_payments")
def _(t):
    return revenue.overdue_payments(t)


@query("order_trends_by_type")
def _(t):
    return revenue.order_trends_by_type(t, ORDER_TYPES)


def _register_lookups() -> None:
    names = {
        "list_ticket_categories": "ticket_categories",
        "list_priorities": "priorities",
        "list_industries": "industries",
        "list_plan_tiers": "plan_tiers",
        "list_product_categories": "product_categories",
    }
    for name, lookup in names.items():
        query(name)(lambda t, lookup=lookup: lookups.valid_values(t, lookup))


_register_lookups()


@query("tool_registry")
def _(t):
    return tools.tool_registry(t)


@query("tool_calls_lateral")
def _(t):
    # One table-function call per industry in use.
    tools.register_sql(t, ["list_valid_industries", "get_customers_by_industry"])
    return t.spark.sql(
        "SELECT asked.industry AS asked_industry, answer.total_customers, answer.avg_health_score, answer.avg_churn_risk, answer.total_mrr "
        "FROM list_valid_industries() AS asked, "
        "LATERAL get_customers_by_industry(to_json(array(asked.industry))) AS answer"
    )


# --- sources, sinks, snapshots ---------------------------------------------------


@query("sink_roundtrip")
def _(t):
    table = storage.overwrite(t.products(), new_dir(t.spark, "products"))
    return table.groupBy("category", "status").agg(rows().alias("n_products"), F.min("price").alias("min_price"), F.max("price").alias("max_price"))


@query("snapshot_clone")
def _(t):
    copy = storage.snapshot(t.product_reviews("review_id", "product_id", "rating", "review_text"), "reviews")
    return copy.select("review_id", "product_id", "rating", F.length("review_text").alias("text_length"))


@query("change_feed")
def _(t):
    old, new = history.week_apart(t)
    return feeds.change_feed(old, new, "ticket_id")


@query("change_feed_undone")
def _(t):
    # The other way round: what would take the newer snapshot back, deletions included.
    old, new = history.week_apart(t)
    return feeds.change_feed(new, old, "ticket_id")


@query("index_manifest")
def _(t):
    parts = [
        storage.manifest_row(t.support_tickets("ticket_id"), "tickets_index", "ticket_id", "description"),
        storage.manifest_row(t.product_reviews("review_id"), "reviews_index", "review_id", "review_text"),
    ]
    manifest = storage.overwrite(checks.union_all(parts), new_dir(t.spark, "manifest"))
    return manifest.select(
        "index_name", "key_column", "text_column", "documents", "last_key", F.col("created_at").isNotNull().alias("stamped")
    )


@query("managed_table")
def _(t):
    # A database is made, a table is saved in it twice and read by name, and the database is dropped again.
    database = f"support_{uuid.uuid4().hex[:12]}"
    storage.save_table(t.products().limit(1), database, "products")
    saved = storage.save_table(t.products(), database, "products")
    per_category = saved.groupBy("category").agg(rows().alias("products"), F.max("price").alias("highest_price"))
    result = written(per_category, "managed-read")
    storage.drop_database(t.spark, database)
    left = any(d.name == database for d in t.spark.catalog.listDatabases())
    return result.withColumn("database_left", F.lit(left))


@query("latest_manifest")
def _(t):
    # One manifest entry per index and day on which its source grew.
    def entries(name: str, source: DataFrame, moment: str) -> DataFrame:
        day = F.date_trunc("day", moment).cast("timestamp_ntz")
        daily = source.groupBy(day.alias("created_at")).agg(rows().alias("documents"))
        return daily.withColumn("index_name", F.lit(name))

    history_rows = checks.union_all(
        [
            entries("tickets_index", t.support_tickets("created_at"), "created_at"),
            entries("interactions_index", t.customer_interactions("event_ts"), "event_ts"),
        ]
    )
    return storage.latest(history_rows, "index_name", "created_at")


@query("table_counts")
def _(t):
    return checks.table_counts(t)


@query("referential_check")
def _(t):
    return checks.referential_check(t)


@query("null_rule_check")
def _(t):
    return checks.null_rule_check(t)


@query("accepted_values")
def _(t):
    return checks.accepted_values(t)


# --- search ----------------------------------------------------------------------


def _index_rows(vectors: DataFrame, key: str) -> DataFrame:
    return vectors.select(key, "n_tokens", "n_terms", F.round("norm", 6).alias("norm"))


@query("index_build_tickets")
def _(t):
    index = text_index.write_index(
        t.support_tickets("ticket_id", "description"), "ticket_id", "description", new_dir(t.spark, "tickets-index")
    )
    return _index_rows(index.vectors, "ticket_id")


@query("index_build_reviews")
def _(t):
    index = text_index.write_index(
        t.product_reviews("review_id", "review_text"), "review_id", "review_text", new_dir(t.spark, "reviews-index")
    )
    postings = index.postings.groupBy("review_id").agg(F.count("term").alias("n_postings"), F.round(F.sum(F.col("weight") * F.col("weight")), 6).alias("length"))
    return _index_rows(index.vectors, "review_id").join(postings, "review_id", "left")


@query("search_tickets_data_failures")
def _(t):
    source = t.support_tickets("ticket_id", "customer_id", "subject", "description", "category", "priority", "status")
    return text_index.search(tickets_index(t), TEXT_DATA_FAILURES, 5, source)


@query("search_tickets_slow")
def _(t):
    source = t.support_tickets("ticket_id", "customer_id", "subject", "description", "priority", "satisfaction_rating")
    return text_index.search(tickets_index(t), TEXT_SLOW, 5, source)


@query("search_reviews_positive")
def _(t):
    source = t.product_reviews("review_id", "product_name", "review_text", "rating")
    return text_index.search(reviews_index(t), TEXT_POSITIVE, 5, source)


@query("search_reviews_integration")
def _(t):
    source = t.product_reviews("review_id", "product_name", "review_text", "rating")
    return text_index.search(reviews_index(t), TEXT_INTEGRATION, 5, source)


@query("search_filtered")
def _(t):
    source = t.support_tickets("ticket_id", "customer_id", "subject", "category", "priority", "status")
    wanted = source.where((F.col("priority") == "Critical") & ~F.col("status").isin(FINISHED))
    return text_index.search(tickets_index(t), TEXT_SLOW, 5, wanted, candidates=wanted)


@query("search_text_topk")
def _(t):
    # Every benchmark text as a query over every document.
    index = block_index.write_block_index(t.raw("documents"), "doc_id", "text", new_dir(t.spark, "documents-blocks"))
    return block_index.text_top_k(index, t.raw("benchmark"), "item_id", "text", k=5)


@query("similar_tickets")
def _(t):
    # Tickets that need attention, each with the finished tickets most like it.
    attention = (F.col("status") == "Escalated") | ((F.col("priority") == "Critical") & F.col("status").isin("Open", "In Progress"))
    texts = t.support_tickets("ticket_id", "priority", "status", "description")
    past = texts.where(F.col("status").isin(FINISHED))
    index = block_index.write_block_index(past, "ticket_id", "description", new_dir(t.spark, "finished-tickets-blocks"))
    return block_index.text_top_k(index, texts.where(attention), "ticket_id", "description", k=3)


@query("search_vector_topk")
def _(t):
    vectors = t.raw("embeddings")
    return vector_search.vector_top_k(vectors, "vec_id", "embedding", vector_search.mean_vector(vectors, "embedding"), 5)


@query("knn_join")
def _(t):
    vectors = t.raw("embeddings")
    return vector_search.knn_exact(vectors, vectors, "vec_id", "embedding", "label", k=5, exclude_self=True)


@query("search_ivf")
def _(t):
    vectors = t.raw("embeddings")
    return vector_search.knn_approximate(vectors, vectors, "vec_id", "embedding", "label", k=5, probes=3, exclude_self=True)


@query("search_lsh")
def _(t):
    vectors = t.raw("embeddings")
    return vector_search.lsh_top_k(vectors, "vec_id", "embedding", vector_search.mean_vector(vectors, "embedding"), 5)


@query("search_recall")
def _(t):
    vectors = t.raw("embeddings")
    found = vector_search.knn_approximate(vectors, vectors, "vec_id", "embedding", "label", exclude_self=True)
    truth = vector_search.knn_exact(vectors, vectors, "vec_id", "embedding", "label", exclude_self=True)
    return patterns.recall_by_list(vector_search.recall(found, truth), vectors, "vec_id", "label")


@query("search_pq_recall")
def _(t):
    # The nearest neighbours by product quantisation, calibrated with some margin: do they hold nine of ten true ones?
    vectors = t.raw("embeddings")
    index = quantised.write_index(vectors, "vec_id", "embedding", new_dir(t.spark, "quantised-vectors"))
    probes, candidates = quantised.calibrate(index, 5, 0.95)
    found = quantised.search(index, vectors, "vec_id", "embedding", 5, probes, candidates, exclude_self=True)
    truth = vector_search.knn_exact(vectors, vectors, "vec_id", "embedding", "label", exclude_self=True)
    total = vector_search.recall(found, truth).agg(F.sum("expected").alias("expected"), F.sum("found").alias("found"))
    return total.select("expected", (F.col("found") >= 0.9 * F.col("expected")).alias("reached"))


@query("route_questions")
def _(t):
    asked = t.raw("conversations").where(F.col("role") == "user")
    return routing.route_questions(asked, ["conv_id", "turn"], "text", tools.tool_comments(t.spark))


@query("buyers_by_sketch")
def _(t):
    # Customers per product from stored daily sketches, next to the exact number.
    orders = t.purchases("product_name", "customer_id", "order_date")
    daily = written(sketches.daily_sketches(orders, F.col("order_date"), ["product_name"], "customer_id"), "daily-buyers")
    exact = orders.groupBy("product_name").agg(F.count_distinct("customer_id").alias("customers"))
    both = exact.join(sketches.distinct_estimates(daily, ["product_name"]), "product_name")
    return both.select("product_name", "customers", sketches.within_bound(F.col("estimate"), F.col("customers")).alias("within_bound"))


# --- incremental index -----------------------------------------------------------


@query("index_sync_triggered")
def _(t):
    path, checkpoint = new_dir(t.spark, "synced-index"), new_dir(t.spark, "sync-checkpoint")
    schema = t.raw("documents").schema
    # The table may be a file or a folder of files. As a glob, its path is listed either way.
    index_sync.sync_now(t.spark, f"{t.sf_dir}/{{documents.parquet}}", "*.parquet", schema, "doc_id", "text", path, checkpoint)
    return _index_rows(index_sync.current(t.spark, path, "doc_id"), "doc_id")


@query("index_sync_out_of_order")
def _(t):
    # Three states of the documents, of which the oldest arrives last, synced one after the other; long ones were revised.
    docs = t.raw("documents")
    states = [
        docs.select("doc_id", "text", F.lit(1).alias("revision")),
        docs.where("n_chars >= 1000").select("doc_id", F.concat("text", F.lit(" final")).alias("text"), F.lit(2).alias("revision")),
        docs.select("doc_id", F.concat(F.lit("draft "), F.coalesce("text", F.lit(""))).alias("text"), F.lit(0).alias("revision")),
    ]
    folder, path, checkpoint = (new_dir(t.spark, n) for n in ("arriving", "ordered-index", "ordered-checkpoint"))
    for number, state in enumerate(states):
        state.write.parquet(f"{folder}/{number}")
        index_sync.sync_now(t.spark, f"{folder}/*", "*.parquet", states[0].schema, "doc_id", "text", path, checkpoint, sequence="revision")
    return _index_rows(index_sync.current(t.spark, path, "doc_id"), "doc_id")


@query("index_upsert")
def _(t):
    # The older ticket snapshot as version 0, then a week of changes as version 1.
    path = new_dir(t.spark, "upserted-index")
    old, new = [s.select("ticket_id", "status", "description") for s in history.week_apart(t, "description")]
    index_sync.write_version(old, "ticket_id", "description", path, 0)
    index_sync.write_changes(feeds.change_feed(old, new, "ticket_id"), "ticket_id", "description", path, 1)
    rows_now = index_sync.current(t.spark, path, "ticket_id")
    return rows_now.select("ticket_id", "status", "n_tokens", "n_terms", F.round("norm", 6).alias("norm"))


@query("search_after_sync")
def _(t):
    # Three increments: the tickets of two weeks ago, and the changes of either week; then a search over all of them.
    path, now = new_dir(t.spark, "live-index"), history.last_created(t)
    states = [history.tickets_as_of(t, now - timedelta(days=d), "description").select("ticket_id", "status", "description") for d in (14, 7, 0)]
    index_sync.write_version(states[0], "ticket_id", "description", path, 0)
    for version in (1, 2):
        changes = feeds.change_feed(states[version - 1], states[version], "ticket_id")
        index_sync.write_changes(changes, "ticket_id", "description", path, version)
    source = t.support_tickets("ticket_id", "customer_id", "description", "priority")
    return text_index.search(index_sync.LiveIndex(t.spark, path, "ticket_id"), TEXT_SLOW, 5, source)


# --- cross-domain questions ------------------------------------------------------


@query("at_risk_critical_negative")
def _(t):
    return cross_domain.at_risk_critical_negative(t)


@query("at_risk_critical_negative_any")
def _(t):
    return cross_domain.at_risk_critical_negative(t, category=None)


@query("critical_perf_customers")
def _(t):
    return cross_domain.critical_recent_customers(t)


@query("product_action_plan")
def _(t):
    return cross_domain.product_action_plan(t)


@query("qbr_pack")
def _(t):
    return cross_domain.qbr_pack(t)


@query("enterprise_at_risk")
def _(t):
    return cross_domain.enterprise_at_risk(t)


@query("at_risk_products_used")
def _(t):
    return cross_domain.at_risk_products_used(t)


@query("frustrated_integration")
def _(t):
    return cross_domain.frustrated_customers(t, tickets_index(t), TEXT_INTEGRATION)


@query("escalations_with_health")
def _(t):
    return cross_domain.escalations_with_health(t)


@query("validate_params")
def _(t):
    # A caller that mixes up the vocabularies of customers, tickets and products.
    requested = lookups.distinct_values(
        t,
        [
            ("customers", "industry", "industry"), ("products", "category", "ticket_category"),
            ("customers", "support_tier", "plan_tier"), ("support_tickets", "status", "priority"),
        ],
    )
    return lookups.validate_params(t, requested)


# --- patterns --------------------------------------------------------------------


@query("hits_by_category")
def _(t):
    return patterns.hits_by_category(patterns.ticket_hits(t, tickets_index(t), TEXT_DATA_FAILURES))


@query("systemic_customers")
def _(t):
    return patterns.systemic_customers(patterns.ticket_hits(t, tickets_index(t), TEXT_DATA_FAILURES))


@query("error_patterns")
def _(t):
    return patterns.error_patterns(t)


@query("review_themes")
def _(t):
    return patterns.review_themes(t)


@query("sentiment_by_product")
def _(t):
    return patterns.sentiment_by_product(t)


@query("verified_vs_all")
def _(t):
    return patterns.verified_vs_all(t)


@query("key_quotes")
def _(t):
    return patterns.key_quotes(t, TEXT_INTEGRATION)


@query("weighted_quotes")
def _(t):
    return patterns.key_quotes(t, TEXT_INTEGRATION, text_index.query_weights(reviews_index(t), TEXT_INTEGRATION))


@query("template_clusters")
def _(t):
    return patterns.template_clusters(t)


@query("template_sentences")
def _(t):
    return patterns.template_sentences(t)


@query("tag_counts")
def _(t):
    return patterns.tag_counts(t)


@query("label_summary")
def _(t):
    return patterns.label_summary(t.raw("labels"), t.raw("documents"))


# --- derivation rules ------------------------------------------------------------


@query("derive_rating")
def _(t):
    reviews = t.product_reviews("review_id", "review_text", "given_rating")
    return reviews.select("review_id", "given_rating", derive.stated_rating(F.col("review_text"), F.col("given_rating")).alias("rating"))


@query("derive_discount")
def _(t):
    sold = t.purchases("order_id", "product_id", "discount_rate").join(t.products("product_id", "price"), "product_id")
    rate = F.col("discount_rate")
    return sold.select(
        "order_id", "product_id", derive.whole_percent(rate).alias("discount_percent"), derive.discounted(F.col("price"), rate).alias("discounted_price")
    )


@query("derive_ltv")
def _(t):
    # Tenure runs from a customer's first order to the last order of all.
    orders = t.purchases("customer_id", "order_date")
    first = orders.groupBy("customer_id").agg(F.min("order_date").alias("signup"))
    today = orders.agg(F.max("order_date").alias("d")).select("d").scalar()
    months = derive.tenure_months(F.col("signup"), today)
    factor = 0.6 + 0.8 * F.col("health_score") / 100
    return (
        t.customers("customer_id", "plan_tier", "health_score").join(first, "customer_id")
        .select("customer_id", "plan_tier", months.alias("tenure_months"), "health_score")
        .select("customer_id", "tenure_months", rounded(derive.lifetime_value(F.col("plan_tier"), F.col("tenure_months"), factor), 2).alias("lifetime_value"))
    )


@query("derive_health")
def _(t):
    source = t.customers("customer_id", "plan_tier", "nps_score")
    risk = derive.churn_risk(F.col("plan_tier"), F.col("nps_score") / -250.0)
    health = derive.health_score(F.col("risk"), F.col("nps_score") / 10.0)
    return source.select("customer_id", "nps_score", risk.alias("risk")).select(
        "customer_id", rounded(F.col("risk"), 2).alias("churn_risk_score"), rounded(health, 1).alias("health_score")
    )


@query("derive_sentiment")
def _(t):
    contact = F.element_at(
        F.array(*[F.lit(c) for c in derive.CONTACT_BASE_SENTIMENT]), (F.col("interaction_id") % 10 + 1).cast("int")
    )
    source = t.customer_interactions("interaction_id", "sentiment_score").withColumn("contact", contact)
    return source.groupBy("contact").agg(
        rows().alias("interactions"),
        rounded(F.avg(derive.sentiment(F.col("contact"), F.col("sentiment_score") * 0.3)), 4).alias("avg_sentiment"),
    )


@query("derive_resolution")
def _(t):
    source = t.support_tickets("ticket_id", "status", "created_at", "resolution_hours")
    return source.select(
        "ticket_id", "status", derive.resolved_at(F.col("status"), F.col("created_at"), F.col("resolution_hours")).alias("resolved_at")
    )


@query("derive_subject")
def _(t):
    # Product types are no ticket categories, so they show the default prefix.
    tickets = t.support_tickets("ticket_id", "category", "status").select("ticket_id", "category", F.col("status").alias("sentence"))
    parts = t.products("product_id", "category", "name").select(F.col("product_id").alias("ticket_id"), "category", F.col("name").alias("sentence"))
    both = tickets.unionByName(parts)
    return both.select("ticket_id", "category", derive.subject(F.col("category"), F.col("ticket_id") % 3, F.col("sentence")).alias("subject"))


@query("derive_ids")
def _(t):
    return t.support_tickets("ticket_id", "customer_id").select(
        derive.padded_key("TKT", F.col("ticket_id"), 5).alias("ticket_key"),
        derive.padded_key("CUST", F.col("customer_id"), 4).alias("customer_key"),
    )
