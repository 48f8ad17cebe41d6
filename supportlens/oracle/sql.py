"""Equivalent SQL of the registered queries, written independently of the Spark plans."""

from __future__ import annotations

from supportlens.functions import derive
from supportlens.operators.checks import ENUMERATED, FOREIGN_KEYS, KEYS
from supportlens.oracle.views import over_views, picked, text_list
from supportlens.plans import queries as q
from supportlens.plans.tools import TOOLS
from supportlens.sources import domain

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = over_views(sql)


def rnd(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def pct(condition: str, digits: int = 1) -> str:
    return rnd(f"count(*) FILTER (WHERE {condition}) * 100.0 / count(*)", digits)


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def one_of(values: list[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


# --- table functions -------------------------------------------------------------

oracle("customer_health_summary", """
SELECT customer_id, company_name, plan_tier, health_score, churn_risk_score, nps_score, lifetime_value, support_tier, csm_assigned
FROM customers WHERE customer_id IN (SELECT customer_id FROM support_tickets)""")

oracle("at_risk_customers", """
SELECT customer_id, company_name, plan_tier, churn_risk_score, health_score, monthly_recurring_revenue, last_login_date, csm_assigned
FROM customers WHERE churn_risk_score >= 0.5 ORDER BY churn_risk_score DESC, customer_id LIMIT 25""")

oracle("customers_by_industry", f"""
SELECT industry, count(*) AS total_customers, {rnd('avg(health_score)', 1)} AS avg_health_score,
       {rnd('avg(churn_risk_score)', 2)} AS avg_churn_risk, {rnd('sum(monthly_recurring_revenue)', 2)} AS total_mrr,
       {rnd('avg(nps_score)', 1)} AS avg_nps
FROM customers WHERE industry IN {one_of(q.SEGMENTS)} GROUP BY industry""")

oracle("customer_engagement", f"""
WITH i AS (
    SELECT customer_id, count(*) AS n, avg(sentiment_score) AS s, avg(csat_score) AS c
    FROM customer_interactions GROUP BY customer_id),
m AS (
    SELECT customer_id, channel FROM (
        SELECT customer_id, channel, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, channel) AS r
        FROM customer_interactions GROUP BY customer_id, channel) WHERE r = 1),
k AS (SELECT customer_id, count(*) AS n, avg(resolution_hours) AS h FROM support_tickets GROUP BY customer_id)
SELECT c.customer_id, coalesce(i.n, 0) AS total_interactions, {rnd('i.s', 2)} AS avg_sentiment, {rnd('i.c', 1)} AS avg_csat,
       m.channel AS most_common_channel, coalesce(k.n, 0) AS total_support_tickets, {rnd('k.h', 1)} AS avg_resolution_hours
FROM customers c LEFT JOIN i USING (customer_id) LEFT JOIN m USING (customer_id) LEFT JOIN k USING (customer_id)""")

oracle("ticket_stats_by_category", f"""
SELECT category, count(*) AS total_tickets,
       count(*) FILTER (WHERE status IN ('Open', 'In Progress', 'Escalated')) AS open_tickets,
       {rnd('avg(resolution_hours)', 1)} AS avg_resolution_hours, {rnd('avg(first_response_minutes)', 1)} AS avg_first_response_min,
       {rnd('avg(satisfaction_rating)', 2)} AS avg_satisfaction, {pct("priority = 'Critical'")} AS pct_critical
FROM support_tickets WHERE category IN {one_of(domain.CATEGORIES)} GROUP BY category""")

oracle("escalated_tickets", """
SELECT ticket_id, customer_id, subject, category, priority, status, created_at, assigned_agent, first_response_minutes, num_replies
FROM support_tickets
WHERE status = 'Escalated' OR (priority = 'Critical' AND status IN ('Open', 'In Progress'))
ORDER BY CASE priority WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 ELSE 3 END, created_at, ticket_id LIMIT 50""")

oracle("agent_performance", f"""
SELECT assigned_agent, count(*) AS total_tickets, count(*) FILTER (WHERE status IN ('Resolved', 'Closed')) AS resolved_tickets,
       {rnd('avg(resolution_hours)', 1)} AS avg_resolution_hours, {rnd('avg(satisfaction_rating)', 2)} AS avg_satisfaction,
       {rnd('avg(first_response_minutes)', 1)} AS avg_first_response_min
FROM support_tickets GROUP BY assigned_agent ORDER BY avg_resolution_hours NULLS FIRST, assigned_agent LIMIT 25""")

oracle("sla_breach_summary", f"""
SELECT category, priority, count(*) FILTER (WHERE first_response_minutes > 60) AS breached_response_sla,
       count(*) FILTER (WHERE resolution_hours > 24) AS breached_resolution_sla, count(*) AS total_tickets,
       {pct('first_response_minutes > 60 OR resolution_hours > 24')} AS breach_rate_pct
FROM support_tickets GROUP BY category, priority""")

oracle("product_defect_rates", f"""
SELECT product_id, name AS product_name, category, defect_rate, avg_rating, status
FROM products WHERE category IN {one_of(q.PART_TYPES)}""")

oracle("product_revenue", f"""
SELECT o.product_id, o.product_name, p.category, count(*) AS total_orders, {rnd('sum(o.amount)', 2)} AS total_revenue,
       {rnd('avg(o.amount)', 2)} AS avg_order_value, {rnd('avg(o.discount_percent)', 1)} AS avg_discount_pct
FROM purchases o JOIN products p ON o.product_id = p.product_id GROUP BY o.product_id, o.product_name, p.category""")

oracle("product_review_summary", f"""
SELECT product_id, product_name, count(*) AS total_reviews, {rnd('avg(rating)', 2)} AS avg_rating,
       {pct('rating = 5')} AS five_star_pct, {pct('rating = 1')} AS one_star_pct, {pct('verified_purchase')} AS verified_pct
FROM product_reviews WHERE product_id IN (SELECT product_id FROM products) GROUP BY product_id, product_name""")

SCORE = "CASE t.priority WHEN 'Critical' THEN 4 WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 1 END"
CORRELATION = f"""
SELECT o.product_name, p.category, count(DISTINCT t.customer_id) AS customers_with_tickets,
       count(t.ticket_id) AS total_tickets_from_buyers, {rnd(f'avg({SCORE})', 2)} AS avg_ticket_priority_score
FROM purchases o JOIN products p ON o.product_id = p.product_id JOIN support_tickets t ON o.customer_id = t.customer_id
GROUP BY o.product_name, p.category"""

oracle("product_ticket_correlation", CORRELATION + " ORDER BY total_tickets_from_buyers DESC, product_name, category LIMIT 20")

oracle("product_ticket_correlation_distinct", f"""
WITH bought AS (
    SELECT DISTINCT o.product_name, p.category, o.customer_id FROM purchases o JOIN products p ON o.product_id = p.product_id)
SELECT o.product_name, o.category, count(DISTINCT t.customer_id) AS customers_with_tickets,
       count(t.ticket_id) AS total_tickets_from_buyers, {rnd(f'avg({SCORE})', 2)} AS avg_ticket_priority_score
FROM bought o JOIN support_tickets t ON o.customer_id = t.customer_id GROUP BY o.product_name, o.category
ORDER BY total_tickets_from_buyers DESC, product_name, category LIMIT 20""")

TIERS = f"""
SELECT plan_tier, count(*) AS total_customers, {rnd('sum(monthly_recurring_revenue)', 2)} AS total_mrr,
       {rnd('avg(monthly_recurring_revenue)', 2)} AS avg_mrr, {rnd('avg(health_score)', 1)} AS avg_health_score,
       {rnd('avg(churn_risk_score)', 2)} AS avg_churn_risk
FROM customers GROUP BY plan_tier"""
oracle("revenue_by_plan_tier", TIERS)

OVERDUE = """
SELECT o.order_id, o.customer_id, c.company_name, o.product_name, o.amount, o.order_date, o.payment_status, c.plan_tier
FROM purchases o JOIN customers c ON o.customer_id = c.customer_id WHERE o.payment_status IN ('Overdue', 'Pending')
ORDER BY o.amount DESC, o.order_id, o.customer_id, c.company_name, o.product_name, o.order_date, o.payment_status, c.plan_tier LIMIT 50"""
oracle("overdue_payments", OVERDUE)

oracle("order_trends_by_type", f"""
SELECT order_type, count(*) AS total_orders, {rnd('sum(amount)', 2)} AS total_revenue, {rnd('avg(amount)', 2)} AS avg_order_value,
       {rnd('avg(discount_percent)', 1)} AS avg_discount_pct
FROM purchases WHERE order_type IN {one_of(domain.ORDER_TYPES)} GROUP BY order_type""")

oracle("list_ticket_categories", "SELECT DISTINCT category FROM support_tickets")
oracle("list_priorities", "SELECT DISTINCT priority FROM support_tickets")
oracle("list_industries", "SELECT DISTINCT industry FROM customers")
oracle("list_plan_tiers", "SELECT DISTINCT plan_tier FROM customers")
oracle("list_product_categories", "SELECT DISTINCT category FROM products")

COUNTS = " UNION ALL ".join(f"SELECT '{name}' AS table_name, count({key}) AS n FROM {name}" for name, key in KEYS.items())
LINKS = ", ".join(f"('{t.name}', '{t.area}', {len(t.params)}, '{source}')" for t in TOOLS for source in t.sources)

oracle("tool_registry", f"""
WITH counts AS ({COUNTS}), links(tool, area, n_params, table_name) AS (VALUES {LINKS})
SELECT tool, area, n_params, count(*) AS n_tables, {big('sum(n)')} AS rows_read
FROM links JOIN counts USING (table_name) GROUP BY tool, area, n_params""")

oracle("tool_calls_lateral", f"""
SELECT industry AS asked_industry, count(*) AS total_customers, {rnd('avg(health_score)', 1)} AS avg_health_score,
       {rnd('avg(churn_risk_score)', 2)} AS avg_churn_risk, {rnd('sum(monthly_recurring_revenue)', 2)} AS total_mrr
FROM customers GROUP BY industry""")

# --- sources, sinks, snapshots ---------------------------------------------------

oracle("sink_roundtrip", """
SELECT category, status, count(*) AS n_products, min(price) AS min_price, max(price) AS max_price
FROM products GROUP BY category, status""")

oracle("snapshot_clone", "SELECT review_id, product_id, rating, length(review_text) AS text_length FROM product_reviews")


def as_of(days: int, more: str = "") -> str:
    done = f"resolution_hours IS NOT NULL AND created_at + to_seconds({big('round(resolution_hours * 3600)')}) > now_at - INTERVAL {days} DAY"
    return f"""
    SELECT ticket_id, customer_id, subject, priority, {more}CASE WHEN {done} THEN 'In Progress' ELSE status END AS status,
           CASE WHEN NOT coalesce({done}, false) THEN resolution_hours END AS resolution_hours, created_at
    FROM support_tickets, (SELECT max(created_at) AS now_at FROM support_tickets)
    WHERE created_at <= now_at - INTERVAL {days} DAY"""


FIELDS = ["customer_id", "subject", "priority", "status", "resolution_hours", "created_at"]
CHANGED = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in FIELDS)


def feed(before: str, after: str) -> str:
    return f"""
WITH old AS ({before}), new AS ({after})
SELECT 'delete' AS _change_type, o.* FROM old o WHERE ticket_id NOT IN (SELECT ticket_id FROM new)
UNION ALL SELECT 'insert', n.* FROM new n WHERE ticket_id NOT IN (SELECT ticket_id FROM old)
UNION ALL SELECT 'update_preimage', o.* FROM old o JOIN new n ON o.ticket_id = n.ticket_id WHERE {CHANGED}
UNION ALL SELECT 'update_postimage', n.* FROM old o JOIN new n ON o.ticket_id = n.ticket_id WHERE {CHANGED}"""


oracle("change_feed", feed(as_of(7), as_of(0)))
oracle("change_feed_undone", feed(as_of(0), as_of(7)))

oracle("index_manifest", """
SELECT 'tickets_index' AS index_name, 'ticket_id' AS key_column, 'description' AS text_column, count(*) AS documents,
       max(ticket_id) AS last_key, true AS stamped FROM support_tickets
UNION ALL SELECT 'reviews_index', 'review_id', 'review_text', count(*), max(review_id), true FROM product_reviews""")

oracle("managed_table", "SELECT category, count(*) AS products, max(price) AS highest_price, false AS database_left FROM products GROUP BY category")
oracle("latest_manifest", """
WITH daily AS (
    SELECT 'tickets_index' AS index_name, CAST(date_trunc('day', created_at) AS TIMESTAMP) AS created_at, count(*) AS documents
    FROM support_tickets GROUP BY ALL
    UNION ALL SELECT 'interactions_index', CAST(date_trunc('day', event_ts) AS TIMESTAMP), count(*)
    FROM customer_interactions GROUP BY ALL)
SELECT index_name, created_at, documents FROM daily
QUALIFY row_number() OVER (PARTITION BY index_name ORDER BY created_at DESC) = 1""")

oracle("table_counts", f"""
WITH counts AS ({COUNTS})
SELECT table_name, n AS n_rows FROM counts UNION ALL SELECT NULL, {big('sum(n)')} FROM counts""")

oracle("referential_check", " UNION ALL ".join(
    f"SELECT '{child}.{column}' AS foreign_key, count(*) AS orphan_rows, count(DISTINCT {column}) AS orphan_keys "
    f"FROM {child} WHERE {column} NOT IN (SELECT {column} FROM {parent})" for child, column, parent in FOREIGN_KEYS))

RULES = [
    ("finished ticket without resolution time", "support_tickets", "status IN ('Resolved', 'Closed') AND resolution_hours IS NULL"),
    ("open ticket with resolution time", "support_tickets", "status NOT IN ('Resolved', 'Closed') AND resolution_hours IS NOT NULL"),
    ("satisfaction outside 1 to 5", "support_tickets", "satisfaction_rating NOT BETWEEN 1 AND 5"),
    ("sentiment outside -1 to 1", "customer_interactions", "sentiment_score NOT BETWEEN -1 AND 1"),
    ("churn risk outside 0 to 1", "customers", "churn_risk_score NOT BETWEEN 0 AND 1"),
    ("health outside 0 to 100", "customers", "health_score NOT BETWEEN 0 AND 100"),
    ("rating outside 1 to 5", "product_reviews", "rating NOT BETWEEN 1 AND 5"),
]
oracle("null_rule_check", " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, count(*) AS checked, count(*) FILTER (WHERE {bad}) AS violations FROM {table}" for rule, table, bad in RULES))

oracle("accepted_values", " UNION ALL ".join(
    f"SELECT '{table}.{column}' AS column_name, {column} AS value, count(*) AS n_rows, {column} IN {one_of(known)} AS accepted "
    f"FROM {table} GROUP BY {column}" for table, column, known in ENUMERATED))

# --- search ----------------------------------------------------------------------

SPLIT = r"string_split_regex(lower({}), '[^\p{{L}}]+')"


def term_tables(source: str, key: str, text: str, prefix: str = "") -> str:
    """CTEs: ``{prefix}tf`` (key, w, tf) and ``{prefix}doc`` (key, tokens, terms, norm)."""
    return f"""
{prefix}tok AS (SELECT {key}, unnest({SPLIT.format(text)}) AS w FROM {source}),
{prefix}tf AS (SELECT {key}, w, count(*) AS tf FROM {prefix}tok WHERE w <> '' GROUP BY {key}, w),
{prefix}doc AS (SELECT {key}, sum(tf) AS n_tokens, count(*) AS n_terms, sqrt(sum((1 + ln(tf)) * (1 + ln(tf)))) AS norm
                FROM {prefix}tf GROUP BY {key})"""


def index_rows(source: str, key: str, text: str, extra: str = "") -> str:
    return f"""
WITH {term_tables(source, key, text)}
SELECT s.{key}, {extra} {big('coalesce(n_tokens, 0)')} AS n_tokens, coalesce(n_terms, 0) AS n_terms,
       round(coalesce(norm, 0.0), 6) AS norm
FROM {source} s LEFT JOIN doc USING ({key})"""


oracle("index_build_tickets", index_rows("support_tickets", "ticket_id", "description"))
REVIEW_ROWS = index_rows("product_reviews", "review_id", "review_text", "n_terms AS n_postings, round(sum_w, 6) AS length,")
oracle("index_build_reviews", REVIEW_ROWS.replace(
    "LEFT JOIN doc USING (review_id)",
    "LEFT JOIN doc USING (review_id) LEFT JOIN (SELECT review_id, sum(((1 + ln(tf)) / norm) * ((1 + ln(tf)) / norm)) AS sum_w "
    "FROM tf JOIN doc USING (review_id) GROUP BY review_id) USING (review_id)"))


def scored(source: str, key: str, text: str, wanted: str) -> str:
    """CTE ``hit`` (key, search_score): cosine of every document with the wanted text."""
    return f"""
{term_tables(source, key, text)},
ask AS (SELECT w, count(*) AS tf FROM (SELECT unnest({SPLIT.format("'" + wanted + "'")}) AS w) WHERE w <> '' GROUP BY w),
askw AS (SELECT w, (1 + ln(ask.tf)) * ln((SELECT count(*) FROM {source}) / df.n) AS qw
         FROM ask JOIN (SELECT w, count(*) AS n FROM tf GROUP BY w) df USING (w)),
hit AS (SELECT {key}, round(sum((1 + ln(tf.tf)) / norm * qw) / (SELECT sqrt(sum(qw * qw)) FROM askw), 6) AS search_score
        FROM tf JOIN askw USING (w) JOIN doc USING ({key}) WHERE qw > 0 GROUP BY {key})"""


def search_sql(source: str, key: str, text: str, wanted: str, columns: str, k: int = 5, condition: str = "true") -> str:
    return f"""
WITH {scored(source, key, text, wanted)}
SELECT search_score, {columns} FROM hit JOIN {source} USING ({key}) WHERE {condition}
ORDER BY search_score DESC, {key} LIMIT {k}"""


TICKETS = ("support_tickets", "ticket_id", "description")
REVIEWS = ("product_reviews", "review_id", "review_text")
oracle("search_tickets_data_failures", search_sql(*TICKETS, q.TEXT_DATA_FAILURES, "ticket_id, customer_id, subject, description, category, priority, status"))
oracle("search_tickets_slow", search_sql(*TICKETS, q.TEXT_SLOW, "ticket_id, customer_id, subject, description, priority, satisfaction_rating"))
oracle("search_reviews_positive", search_sql(*REVIEWS, q.TEXT_POSITIVE, "review_id, product_name, review_text, rating"))
oracle("search_reviews_integration", search_sql(*REVIEWS, q.TEXT_INTEGRATION, "review_id, product_name, review_text, rating"))
oracle("search_filtered", search_sql(
    *TICKETS, q.TEXT_SLOW, "ticket_id, customer_id, subject, category, priority, status",
    condition="priority = 'Critical' AND status NOT IN ('Resolved', 'Closed')"))


def nearest(k: int) -> str:
    return f"""
SELECT query_id, neighbour_id, search_score, row_number() OVER (PARTITION BY query_id ORDER BY search_score DESC, neighbour_id) AS rank
FROM pair QUALIFY rank <= {k}"""


def similar_texts(asked: str, ask_key: str, ask_text: str, source: str, key: str, text: str, k: int) -> str:
    """The documents most like each text: cosines of log term frequencies, on the asking side times ln(N / frequency)."""
    return f"""{term_tables(asked, ask_key, ask_text, 'a')}, {term_tables(source, key, text, 'd')},
idf AS (SELECT w, ln((SELECT count(*) FROM {source}) / count(*)) AS idf FROM dtf GROUP BY w),
qw AS (SELECT {ask_key} AS query_id, w, (1 + ln(tf)) * idf AS qw FROM atf JOIN idf USING (w) WHERE idf > 0),
total AS (SELECT query_id, sqrt(sum(qw * qw)) AS len FROM qw GROUP BY query_id),
pair AS (SELECT query_id, dtf.{key} AS neighbour_id, round(sum(qw * (1 + ln(dtf.tf)) / ddoc.norm) / any_value(len), 6) AS search_score
         FROM qw JOIN dtf USING (w) JOIN ddoc ON ddoc.{key} = dtf.{key} JOIN total USING (query_id) GROUP BY query_id, dtf.{key})
{nearest(k)}"""


oracle("search_text_topk", f"WITH {similar_texts('benchmark', 'item_id', 'text', 'documents', 'doc_id', 'text', 5)}")
oracle("similar_tickets", f"""
WITH asked AS (SELECT ticket_id AS asked_id, description FROM support_tickets
               WHERE status = 'Escalated' OR (priority = 'Critical' AND status IN ('Open', 'In Progress'))),
past AS (SELECT ticket_id, description FROM support_tickets WHERE status IN ('Resolved', 'Closed')),
{similar_texts('asked', 'asked_id', 'description', 'past', 'ticket_id', 'description', 3)}""")

DOT = "list_dot_product(CAST({} AS DOUBLE[]), CAST({} AS DOUBLE[]))"
CENTRES = """
flat AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
centre AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(CAST(x AS DOUBLE)) AS x FROM flat GROUP BY label, i) GROUP BY label)"""
ALL_PAIRS = f"""
SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, round({DOT.format('a.embedding', 'b.embedding')}, 6) AS search_score
FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id"""
NEAR_PAIRS = f"""
SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, round({DOT.format('a.embedding', 'b.embedding')}, 6) AS search_score
FROM embeddings a JOIN probe USING (vec_id) JOIN embeddings b ON b.label = probe.label WHERE a.vec_id <> b.vec_id"""
PROBES = f"""
probe AS (SELECT vec_id, centre.label FROM embeddings, centre
          QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), c) DESC, centre.label) <= 3)"""

MIDDLE = """
WITH flat AS (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
middle AS (SELECT list(x ORDER BY i) AS c FROM (SELECT i, avg(CAST(x AS DOUBLE)) AS x FROM flat GROUP BY i))"""
oracle("search_vector_topk", f"""{MIDDLE}
SELECT vec_id, label, round({DOT.format('embedding', 'c')}, 6) AS search_score FROM embeddings, middle
ORDER BY search_score DESC, vec_id LIMIT 5""")
# The approximate search finds the true neighbours here; tests hold its recall on other data.
oracle("search_lsh", f"""{MIDDLE}
SELECT vec_id, round({DOT.format('embedding', 'c')}, 6) AS search_score FROM embeddings, middle
ORDER BY search_score DESC, vec_id LIMIT 5""")
oracle("knn_join", f"WITH pair AS ({ALL_PAIRS}) {nearest(5)}")
oracle("search_ivf", f"WITH {CENTRES}, {PROBES}, pair AS ({NEAR_PAIRS}) {nearest(5)}")
oracle("search_recall", f"""
WITH {CENTRES}, {PROBES},
truth AS (SELECT * FROM ({ALL_PAIRS}) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY search_score DESC, neighbour_id) <= 5),
near AS (SELECT * FROM ({NEAR_PAIRS}) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY search_score DESC, neighbour_id) <= 5)
SELECT label, count(*) AS expected, count(near.query_id) AS found, {rnd('count(near.query_id) / count(*)', 4)} AS recall
FROM truth JOIN embeddings e ON e.vec_id = truth.query_id
LEFT JOIN near ON near.query_id = truth.query_id AND near.neighbour_id = truth.neighbour_id GROUP BY label""")

# The vectors found follow from trained codebooks; what must hold is their share of the true neighbours.
oracle("search_pq_recall", "SELECT sum(least(n - 1, 5)) AS expected, true AS reached FROM (SELECT count(*) OVER () AS n FROM embeddings)")

COMMENTS = ", ".join("('{}', '{}')".format(t.name, t.comment.replace("'", "''")) for t in TOOLS)
oracle("route_questions", f"""
WITH tool(tool, comment) AS (VALUES {COMMENTS}),
asked AS (SELECT conv_id * 100000 + turn AS question, conv_id, turn, text FROM conversations WHERE role = 'user'),
{term_tables('tool', 'tool', 'comment', 't')}, {term_tables('asked', 'question', 'text', 'a')},
idf AS (SELECT w, ln({len(TOOLS)} / count(*)) AS idf FROM ttf GROUP BY w),
askw AS (SELECT question, w, (1 + ln(tf)) * idf AS qw FROM atf JOIN idf USING (w) WHERE idf > 0),
total AS (SELECT question, sqrt(sum(qw * qw)) AS len FROM askw GROUP BY question),
best AS (SELECT question, ttf.tool, round(sum(qw * (1 + ln(ttf.tf)) / tdoc.norm) / any_value(len), 6) AS score
         FROM askw JOIN ttf USING (w) JOIN tdoc ON tdoc.tool = ttf.tool JOIN total USING (question) GROUP BY question, ttf.tool
         QUALIFY row_number() OVER (PARTITION BY question ORDER BY score DESC, ttf.tool) = 1)
SELECT conv_id, turn, best.tool, coalesce(score, 0.0) AS score FROM asked LEFT JOIN best USING (question)""")

oracle("buyers_by_sketch", "SELECT product_name, count(DISTINCT customer_id) AS customers, true AS within_bound FROM purchases GROUP BY product_name")

# --- incremental index -----------------------------------------------------------

oracle("index_sync_triggered", index_rows("documents", "doc_id", "text"))
oracle("index_sync_out_of_order", index_rows("revised", "doc_id", "text").replace(
    "WITH", "WITH revised AS (SELECT doc_id, CASE WHEN n_chars >= 1000 THEN text || ' final' ELSE text END AS text FROM documents),", 1))
oracle("search_after_sync", search_sql(*TICKETS, q.TEXT_SLOW, "ticket_id, customer_id, description, priority"))
oracle("index_upsert", f"""
WITH new AS ({as_of(0, 'description, ')}), {term_tables('new', 'ticket_id', 'description')}
SELECT n.ticket_id, n.status, {big('n_tokens')} AS n_tokens, n_terms, round(norm, 6) AS norm FROM new n JOIN doc USING (ticket_id)""")

# --- cross-domain questions ------------------------------------------------------


def critical_negative(condition: str) -> str:
    return f"""
SELECT c.customer_id, company_name, plan_tier, churn_risk_score, health_score, critical_tickets, negative_reviews, avg_negative_rating
FROM customers c
JOIN (SELECT customer_id, count(*) AS critical_tickets FROM support_tickets WHERE priority = 'Critical' AND {condition} GROUP BY 1) t USING (customer_id)
JOIN (SELECT customer_id, count(*) AS negative_reviews, {rnd('avg(rating)', 2)} AS avg_negative_rating
      FROM product_reviews WHERE rating <= 2 GROUP BY 1) r USING (customer_id)
WHERE churn_risk_score >= 0.5"""


oracle("at_risk_critical_negative", critical_negative("category = 'Performance'"))
oracle("at_risk_critical_negative_any", critical_negative("true"))

oracle("critical_perf_customers", """
SELECT customer_id, company_name, plan_tier, churn_risk_score, health_score, critical_tickets, last_ticket_at, churn_risk_score >= 0.5 AS at_risk
FROM customers JOIN (
    SELECT customer_id, count(*) AS critical_tickets, max(created_at) AS last_ticket_at FROM support_tickets
    WHERE priority = 'Critical' AND category = 'Performance'
      AND CAST(created_at AS DATE) >= CAST((SELECT max(created_at) FROM support_tickets) AS DATE) - INTERVAL 1 MONTH
    GROUP BY customer_id) USING (customer_id)""")

oracle("product_action_plan", f"""
WITH load AS ({CORRELATION}),
theme AS (
    SELECT o.product_name, p.category, t.category AS top_theme, count(*) AS n
    FROM purchases o JOIN products p ON o.product_id = p.product_id JOIN support_tickets t ON o.customer_id = t.customer_id
    GROUP BY o.product_name, p.category, t.category
    QUALIFY row_number() OVER (PARTITION BY o.product_name, p.category ORDER BY count(*) DESC, t.category) = 1),
review AS (SELECT product_id, count(*) AS total_reviews, {rnd('avg(rating)', 2)} AS avg_rating, {pct('rating = 1')} AS one_star_pct
           FROM product_reviews GROUP BY product_id)
SELECT p.product_id, p.name AS product_name, p.category, total_reviews, r.avg_rating, one_star_pct, defect_rate,
       coalesce(total_tickets_from_buyers, 0) AS buyer_tickets, top_theme,
       {rnd('20 * (5 - r.avg_rating) + 500 * defect_rate + 10 * coalesce(avg_ticket_priority_score, 0)', 3)} AS urgency
FROM review r JOIN products p USING (product_id)
LEFT JOIN load ON load.product_name = p.name AND load.category = p.category
LEFT JOIN theme ON theme.product_name = p.name AND theme.category = p.category
ORDER BY urgency DESC, product_id""")


def section(title: str, source: str, name: str, metric: str, order: str, limit: int | None = None) -> str:
    cut = f" ORDER BY {order} LIMIT {limit}" if limit else ""
    return (
        f"(SELECT '{title}' AS section, row_number() OVER (ORDER BY {order}) AS rank, CAST({name} AS VARCHAR) AS name, "
        f"'{metric}' AS metric, CAST({metric} AS DOUBLE) AS value FROM ({source}){cut})"
    )


oracle("qbr_pack", " UNION ALL ".join([
    section("revenue by plan tier", TIERS, "plan_tier", "total_mrr", "total_mrr DESC, plan_tier"),
    section("at-risk customers by revenue", "SELECT customer_id, company_name, monthly_recurring_revenue FROM customers WHERE churn_risk_score >= 0.4",
            "company_name", "monthly_recurring_revenue", "monthly_recurring_revenue DESC, customer_id", 5),
    section("support issues this quarter",
            "SELECT category, count(*) AS tickets FROM support_tickets "
            "WHERE created_at >= date_trunc('quarter', (SELECT max(created_at) FROM support_tickets)) GROUP BY category",
            "category", "tickets", "tickets DESC, category"),
    section("products with most tickets", f"SELECT concat_ws(' / ', product_name, category) AS pname, total_tickets_from_buyers FROM ({CORRELATION})",
            "pname", "total_tickets_from_buyers", "total_tickets_from_buyers DESC, pname"),
    section("payments to follow up",
            f"SELECT concat_ws(' / ', company_name, CAST(order_id AS VARCHAR), payment_status, product_name) AS pname, amount FROM ({OVERDUE})",
            "pname", "amount", "amount DESC, pname"),
]))

oracle("enterprise_at_risk", """
SELECT customer_id, company_name, plan_tier, churn_risk_score, health_score, monthly_recurring_revenue, last_login_date, csm_assigned
FROM customers WHERE churn_risk_score > 0.6 AND plan_tier = 'Enterprise'""")

oracle("at_risk_products_used", """
SELECT c.customer_id, company_name, churn_risk_score, health_score, critical_tickets, product_name, orders
FROM customers c
JOIN (SELECT customer_id, count(*) AS critical_tickets FROM support_tickets WHERE priority = 'Critical' GROUP BY customer_id) t USING (customer_id)
JOIN (SELECT customer_id, product_name, count(*) AS orders FROM purchases GROUP BY customer_id, product_name) o USING (customer_id)
WHERE churn_risk_score >= 0.5""")

oracle("frustrated_integration", f"""
WITH {scored(*TICKETS, q.TEXT_INTEGRATION)},
top AS (SELECT customer_id, search_score FROM hit JOIN support_tickets USING (ticket_id)
        WHERE category = 'Integration' AND search_score >= 0.1),
found AS (SELECT customer_id, count(*) AS matching_tickets, max(search_score) AS best_score FROM top GROUP BY customer_id),
review AS (SELECT customer_id, count(*) AS n_reviews, {rnd('avg(rating)', 2)} AS avg_rating FROM product_reviews GROUP BY customer_id)
SELECT customer_id, company_name, churn_risk_score, matching_tickets, best_score, coalesce(n_reviews, 0) AS n_reviews, avg_rating
FROM customers JOIN found USING (customer_id) LEFT JOIN review USING (customer_id)""")

oracle("escalations_with_health", """
SELECT ticket_id, customer_id, priority, status, health_score, churn_risk_score FROM support_tickets JOIN customers USING (customer_id)
WHERE status = 'Escalated' OR (priority = 'Critical' AND status IN ('Open', 'In Progress'))""")

oracle("validate_params", """
WITH valid AS (
    SELECT 'ticket_category' AS parameter, category AS value FROM support_tickets UNION SELECT 'priority', priority FROM support_tickets
    UNION SELECT 'industry', industry FROM customers UNION SELECT 'plan_tier', plan_tier FROM customers
    UNION SELECT 'product_category', category FROM products),
asked AS (
    SELECT 'industry' AS parameter, industry AS value FROM customers UNION SELECT 'ticket_category', category FROM products
    UNION SELECT 'plan_tier', support_tier FROM customers UNION SELECT 'priority', status FROM support_tickets)
SELECT parameter, value FROM asked EXCEPT SELECT parameter, value FROM valid""")

# --- patterns --------------------------------------------------------------------

TOP_HITS = f"""
{scored(*TICKETS, q.TEXT_DATA_FAILURES)},
top AS (SELECT search_score, ticket_id, customer_id, category, priority, status FROM hit JOIN support_tickets USING (ticket_id)
        WHERE search_score >= 0.1)"""
oracle("hits_by_category", f"""
WITH {TOP_HITS}
SELECT category, priority, count(*) AS hits, count(*) FILTER (WHERE priority = 'Critical' OR status = 'Escalated') AS flagged,
       max(search_score) AS best_score FROM top GROUP BY category, priority""")
oracle("systemic_customers", f"""
WITH {TOP_HITS}
SELECT customer_id, count(*) AS hits, min(ticket_id) AS first_ticket FROM top GROUP BY customer_id HAVING count(*) > 1""")

oracle("error_patterns", """
WITH found AS (
    SELECT ticket_id, customer_id,
           unnest(list_concat(regexp_extract_all(description, '[A-Z]+-[0-9]+'), regexp_extract_all(description, '"[^"]+"'))) AS pattern
    FROM support_tickets)
SELECT pattern, count(DISTINCT ticket_id) AS tickets, count(DISTINCT customer_id) AS customers FROM found GROUP BY pattern""")

oracle("review_themes", f"""
WITH words AS (
    SELECT review_id, customer_id, list_filter({SPLIT.format('review_text')}, lambda w: w <> '') AS ws FROM product_reviews),
pairs AS (
    SELECT review_id, customer_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS theme FROM words)
SELECT theme, count(DISTINCT customer_id) AS customers, count(DISTINCT review_id) AS reviews FROM pairs
GROUP BY theme HAVING count(DISTINCT customer_id) >= 2""")

oracle("sentiment_by_product", f"""
SELECT product_id, product_name, count(*) AS reviews, {rnd('avg(rating)', 2)} AS avg_rating,
       {pct('rating >= 4')} AS positive_pct, {pct('rating <= 2')} AS negative_pct
FROM product_reviews GROUP BY product_id, product_name""")

oracle("verified_vs_all", f"""
SELECT product_id, product_name, count(*) AS reviews, count(*) FILTER (WHERE verified_purchase) AS verified_reviews,
       {rnd('avg(rating)', 2)} AS avg_rating, {rnd('avg(rating) FILTER (WHERE verified_purchase)', 2)} AS verified_avg_rating,
       {big('sum(helpful_votes)')} AS helpful_votes
FROM product_reviews GROUP BY product_id, product_name""")

QUOTE_WORDS = text_list(sorted(set(q.TEXT_INTEGRATION.split())))
oracle("key_quotes", f"""
WITH parts AS (
    SELECT review_id, product_name, rating, unnest(p) AS s, generate_subscripts(p, 1) AS i
    FROM (SELECT *, string_split_regex(review_text, '[.!?\\n]+') AS p FROM product_reviews)),
ranked AS (
    SELECT review_id, product_name, rating, i, trim(s, ' ') AS quote,
           len(list_distinct(list_intersect({SPLIT.format('s')}, {QUOTE_WORDS}))) AS matches FROM parts)
SELECT review_id, product_name, rating, matches, quote FROM ranked WHERE matches > 0
QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY matches DESC, i) = 1""")

oracle("weighted_quotes", f"""
WITH {term_tables('product_reviews', 'review_id', 'review_text')},
raw AS (SELECT w, ln((SELECT count(*) FROM product_reviews) / count(*)) AS raw FROM tf WHERE list_contains({QUOTE_WORDS}, w) GROUP BY w),
weight AS (SELECT w, raw / sqrt((SELECT sum(raw * raw) FROM raw)) AS qw FROM raw WHERE raw > 0),
parts AS (
    SELECT review_id, product_name, rating, unnest(p) AS s, generate_subscripts(p, 1) AS i
    FROM (SELECT *, string_split_regex(review_text, '[.!?\\n]+') AS p FROM product_reviews)),
met AS (SELECT review_id, i, w FROM (SELECT review_id, i, unnest(list_distinct({SPLIT.format('s')})) AS w FROM parts)),
summed AS (SELECT review_id, i, round(sum(qw), 6) AS matches FROM met JOIN weight USING (w) GROUP BY review_id, i)
SELECT review_id, product_name, rating, matches, trim(s, ' ') AS quote FROM summed JOIN parts USING (review_id, i) WHERE matches > 0
QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY matches DESC, i) = 1""")

oracle("template_clusters", """
SELECT regexp_replace(regexp_replace(regexp_replace(subject, '"[^"]*"', '<quoted>', 'g'), '[A-Z]+-[0-9]+', '<code>', 'g'), '[0-9]+', '<number>', 'g') AS template,
       count(*) AS tickets, count(DISTINCT customer_id) AS customers FROM support_tickets GROUP BY template""")

oracle("template_sentences", f"""
WITH texts AS (
    SELECT 'ticket' AS source, ticket_id AS id, customer_id, description AS t FROM support_tickets
    UNION ALL SELECT 'review', review_id, customer_id, review_text FROM product_reviews),
parts AS (SELECT source, id, customer_id, unnest(string_split_regex(t, '[.!?\\n]+')) AS s FROM texts),
made AS (SELECT source, id, customer_id, trim(regexp_replace(regexp_replace(regexp_replace(s, '"[^"]*"', '<quoted>', 'g'), '[A-Z]+-[0-9]+', '<code>', 'g'), '[0-9]+', '<number>', 'g'), ' ') AS template
         FROM parts)
SELECT source, template, count(DISTINCT id) AS texts, count(DISTINCT customer_id) AS customers FROM made WHERE template <> ''
GROUP BY source, template HAVING count(DISTINCT customer_id) >= 2""")

oracle("tag_counts", """
SELECT tag, count(*) AS tickets, count(*) FILTER (WHERE priority = 'Critical') AS critical_tickets
FROM (SELECT priority, unnest(string_split(tags, ',')) AS tag FROM support_tickets) GROUP BY tag""")

oracle("label_summary", f"""
SELECT lang, count(*) AS judged, {pct('quality = 1', 2)} AS good_pct, {pct('toxic = 1', 2)} AS toxic_pct
FROM labels JOIN documents USING (doc_id) GROUP BY lang""")

# --- derivation rules ------------------------------------------------------------

STATED = " ".join(f"WHEN contains(review_text, '{n}/5') THEN {n}" for n in range(5, 0, -1))
oracle("derive_rating", f"SELECT review_id, given_rating, CASE {STATED} ELSE given_rating END AS rating FROM product_reviews")

oracle("derive_discount", f"""
SELECT order_id, product_id, CAST(trunc(discount_rate * 100) AS INT) AS discount_percent, {rnd('price * (1 - discount_rate)', 2)} AS discounted_price
FROM purchases JOIN products USING (product_id)""")


def cases(column: str, values: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"


oracle("derive_ltv", f"""
WITH span AS (
    SELECT customer_id, date_diff('day', min(order_date), (SELECT max(order_date) FROM purchases)) // 30 AS tenure_months
    FROM purchases GROUP BY customer_id)
SELECT customer_id, tenure_months,
       {rnd(f"{cases('plan_tier', derive.PLAN_BASE_VALUE)} * (tenure_months / 12.0::DOUBLE) * (0.6 + 0.8 * health_score / 100)", 2)} AS lifetime_value
FROM customers JOIN span USING (customer_id)""")

oracle("derive_health", f"""
WITH risky AS (
    SELECT customer_id, nps_score,
           greatest(0.0::DOUBLE, least(1.0::DOUBLE, {cases('plan_tier', derive.PLAN_BASE_RISK)}::DOUBLE + nps_score / -250.0::DOUBLE)) AS risk
    FROM customers)
SELECT customer_id, {rnd('risk', 2)} AS churn_risk_score,
       {rnd('greatest(0.0::DOUBLE, least(100.0::DOUBLE, (1 - risk) * 100 + nps_score / 10.0::DOUBLE))', 1)} AS health_score
FROM risky""")

CONTACTS = list(derive.CONTACT_BASE_SENTIMENT)
oracle("derive_sentiment", f"""
WITH source AS (SELECT {picked(CONTACTS, 'interaction_id % 10')} AS contact, sentiment_score FROM customer_interactions)
SELECT contact, count(*) AS interactions,
       {rnd(f"avg(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, {cases('contact', derive.CONTACT_BASE_SENTIMENT)}::DOUBLE + sentiment_score * 0.3::DOUBLE)))", 4)} AS avg_sentiment
FROM source GROUP BY contact""")

oracle("derive_resolution", f"""
SELECT ticket_id, status, CASE WHEN status IN ('Resolved', 'Closed')
       THEN created_at + to_seconds({big('round(resolution_hours * 3600)')}) END AS resolved_at FROM support_tickets""")

PREFIX = " ".join(f"WHEN '{c}' THEN {text_list(p)}[CAST(ticket_id % 3 AS INT) + 1]" for c, p in domain.SUBJECT_PREFIXES.items())
oracle("derive_subject", f"""
WITH both_kinds AS (
    SELECT ticket_id, category, status AS sentence FROM support_tickets
    UNION ALL SELECT product_id, category, name FROM products)
SELECT ticket_id, category, concat(CASE category {PREFIX} ELSE '{domain.DEFAULT_PREFIX}' END, ' ', sentence) AS subject FROM both_kinds""")

oracle("derive_ids", """
SELECT format('TKT-{:05d}', ticket_id) AS ticket_key, format('CUST-{:04d}', customer_id) AS customer_key FROM support_tickets""")
