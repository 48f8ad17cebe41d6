"""Rules that fill derived columns of the support tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from supportlens.functions.expressions import FINISHED, rounded
from supportlens.sources.domain import DEFAULT_PREFIX, SUBJECT_PREFIXES

# Base churn risk and base lifetime value of a plan, base sentiment of a contact.
PLAN_BASE_RISK = {"Starter": 0.4, "Professional": 0.25, "Enterprise": 0.12, "Enterprise Plus": 0.08}
PLAN_BASE_VALUE = {"Starter": 5000, "Professional": 25000, "Enterprise": 80000, "Enterprise Plus": 200000}
CONTACT_BASE_SENTIMENT = {
    "Support Call": 0.3, "Onboarding Session": 0.6, "QBR Meeting": 0.5,
    "Training Webinar": 0.7, "Feature Demo": 0.8, "Escalation Call": 0.1,
    "Check-in": 0.6, "Renewal Discussion": 0.4, "Upsell Conversation": 0.5,
    "Bug Report Follow-up": 0.3,
}


def lookup(values: dict, key: Column) -> Column:
    """Value of a short constant dictionary, NULL for unknown keys."""
    return F.element_at(F.create_map(*[F.lit(x) for item in values.items() for x in item]), key)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value))


def stated_rating(text: Column, given: Column) -> Column:
    """The rating a review states as ``n/5``, highest first, else the given one."""
    return F.coalesce(*[F.when(text.contains(f"{n}/5"), F.lit(n)) for n in range(5, 0, -1)], given)


def discounted(price: Column, rate: Column) -> Column:
    return rounded(price * (1 - rate), 2)


def whole_percent(rate: Column) -> Column:
    """The discount of an order in whole percent, cut off, not rounded."""
    return (rate * 100).cast("int")


def tenure_months(start: Column, today: Column) -> Column:
    return F.floor(F.datediff(today, start) / 30)


def lifetime_value(plan: Column, months: Column, factor: Column) -> Column:
    return lookup(PLAN_BASE_VALUE, plan) * (months / 12.0) * factor


def churn_risk(plan: Column, deviation: Column) -> Column:
    return clamp(lookup(PLAN_BASE_RISK, plan) + deviation, 0, 1)


def health_score(risk: Column, deviation: Column) -> Column:
    return clamp((1 - risk) * 100 + deviation, 0, 100)


def sentiment(contact: Column, deviation: Column) -> Column:
    return clamp(lookup(CONTACT_BASE_SENTIMENT, contact) + deviation, -1, 1)


def resolved_at(status: Column, created: Column, hours: Column) -> Column:
    """Creation time plus the hours worked, for finished tickets only, to the second."""
    seconds = F.round(hours * 3600).cast("bigint")
    return F.when(status.isin(FINISHED), created + F.make_dt_interval(secs=seconds))


def subject(category: Column, choice: Column, sentence: Column) -> Column:
    """A category's prefix, picked by a zero-based number, before the sentence."""
    prefixes = F.create_map(*[x for c, p in SUBJECT_PREFIXES.items() for x in (F.lit(c), F.array(*map(F.lit, p)))])
    prefix = F.get(F.element_at(prefixes, category), choice.cast("int"))
    return F.concat(F.coalesce(prefix, F.lit(DEFAULT_PREFIX)), F.lit(" "), sentence)


def padded_key(prefix: str, number: Column, width: int) -> Column:
    """``TKT-00001`` style key; numbers wider than ``width`` are kept whole."""
    return F.format_string(f"{prefix}-%0{width}d", number)
