"""The six support tables as common table expressions over the star-schema views."""

from __future__ import annotations

import re

from supportlens.sources import domain


def text_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def picked(values: list[str], index: str) -> str:
    return f"{text_list(values)}[CAST({index} AS INT) + 1]"


def stepped(number: str, bounds: list[int], values: list[str]) -> str:
    cases = " ".join(f"WHEN {number} < {b} THEN '{v}'" for b, v in zip(bounds, values))
    return f"CASE {cases} ELSE '{values[-1]}' END"


K = "CAST(json_extract_string(props, '$.k') AS INT)"
PREFIXES = [p for prefixes in domain.SUBJECT_PREFIXES.values() for p in prefixes]
SUBJECT = (
    f"concat({picked(PREFIXES, 'user_id % 8 * 3 + event_id % 3')}, ' ', event_type, ' reported as ', "
    f"{picked(domain.ERROR_CODES, K + ' % 10')}, ' \"', {picked(domain.ERROR_TEXTS, 'event_id % 5')}, "
    f"'\" after ', CAST({K} % 25 + 1 AS VARCHAR), ' replies')"
)
TAG = [picked(domain.TICKET_TAGS, f"(event_id + {i}) % 8") for i in range(3)]

VIEWS = {
    "customers": f"""
        SELECT c_custkey AS customer_id, c_name AS company_name, c_mktsegment AS industry, r_name AS region,
               n_name AS csm_assigned, {stepped('c_custkey % 20', [6, 13, 18], domain.PLAN_TIERS)} AS plan_tier,
               c_acctbal AS monthly_recurring_revenue, c_acctbal * 12 AS lifetime_value,
               CAST(c_custkey * 37 % 101 AS DOUBLE) / 100 AS churn_risk_score,
               CAST(greatest(0, least(100, 100 - c_custkey * 37 % 101 + c_custkey * 13 % 21 - 10)) AS DOUBLE) AS health_score,
               CAST(c_custkey * 53 % 201 - 100 AS INT) AS nps_score,
               {picked(domain.SUPPORT_TIERS, 'c_custkey % 3')} AS support_tier,
               (SELECT max(o_orderdate) FROM orders WHERE o_custkey = c_custkey) AS last_login_date
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "products": f"""
        SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS tier, p_retailprice AS price,
               CAST(32 + p_partkey * 11 % 18 AS DOUBLE) / 10 AS avg_rating,
               CAST(1 + p_partkey * 7 % 80 AS DOUBLE) / 1000 AS defect_rate,
               {stepped('p_partkey % 6', [4, 5], ['GA', 'Beta', 'Deprecated'])} AS status
        FROM part""",
    "purchases": f"""
        SELECT l_orderkey * 10 + l_linenumber AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
               p_name AS product_name, o_orderdate AS order_date, l_extendedprice AS amount,
               CAST(round(l_discount * 100) AS INT) AS discount_percent, l_discount AS discount_rate,
               {picked(domain.ORDER_TYPES, 'l_linenumber % 4')} AS order_type,
               {stepped('l_orderkey % 100', [80, 90, 97], domain.PAYMENT_STATUSES)} AS payment_status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "support_tickets": f"""
        SELECT event_id AS ticket_id, user_id AS customer_id, {SUBJECT} AS subject,
               concat({SUBJECT}, '. ', coalesce(text, '')) AS description,
               {picked(domain.CATEGORIES, 'user_id % 8')} AS category,
               {stepped(K, [5, 25, 75], domain.PRIORITIES)} AS priority,
               {stepped('event_id % 20', [3, 8, 10, 11, 17], domain.STATUSES)} AS status,
               {picked(domain.TICKET_CHANNELS, 'event_id % 5')} AS channel,
               concat('agent-', CAST(event_id % 97 AS VARCHAR)) AS assigned_agent, ts AS created_at,
               CASE WHEN event_id % 20 >= 11 THEN value END AS resolution_hours,
               CAST(50 + event_id * 31 % 4751 AS DOUBLE) / 10 AS first_response_minutes,
               CASE WHEN event_id * 3 % 7 < 5 THEN event_id * 3 % 7 + 1 END AS satisfaction_rating,
               {K} % 25 + 1 AS num_replies,
               concat_ws(',', {TAG[0]}, CASE WHEN {K} % 3 > 0 THEN {TAG[1]} END, CASE WHEN {K} % 3 > 1 THEN {TAG[2]} END) AS tags
        FROM events LEFT JOIN documents ON event_id = doc_id WHERE event_type IN ('error', 'purchase')""",
    "customer_interactions": f"""
        SELECT event_id AS interaction_id, user_id AS customer_id, event_type AS interaction_type, ts AS event_ts,
               {picked(domain.INTERACTION_CHANNELS, 'event_id % 6')} AS channel,
               CAST({K} - 50 AS DOUBLE) / 50 AS sentiment_score,
               CASE WHEN event_id * 5 % 6 < 5 THEN event_id * 5 % 6 + 1 END AS csat_score
        FROM events WHERE event_type IN ('click', 'view', 'signup')""",
    "product_reviews": f"""
        SELECT d.doc_id AS review_id, d.doc_id * 7 % 150 AS customer_id, d.doc_id % 50 AS product_id, p_name AS product_name,
               concat(coalesce(p_name, ''), '. ', {picked(domain.REVIEW_OPENINGS, 'n_chars % 5')}, '. ', coalesce(text, ''),
                      CASE WHEN n_chars % 2 = 0 THEN concat(' Rating: ', CAST(n_chars % 5 + 1 AS VARCHAR), '/5') ELSE '' END) AS review_text,
               n_chars * 3 % 5 + 1 AS given_rating, n_chars % 5 + 1 AS rating, n_chars % 51 AS helpful_votes,
               coalesce(quality, 0) = 1 AS verified_purchase
        FROM documents d LEFT JOIN part ON p_partkey = d.doc_id % 50 LEFT JOIN labels l ON l.doc_id = d.doc_id""",
}


def over_views(sql: str) -> str:
    """``sql`` preceded by the definitions of the support tables it mentions."""
    used = [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]
    head = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in used)
    body = sql.strip()
    if not head:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
