"""Valid values of the enumerated columns, and checks of parameters against them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.functions.params import unknown_values

# Lookup name -> table, column and the parameter it validates.
LOOKUPS = {
    "ticket_categories": ("support_tickets", "category", "ticket_category"),
    "priorities": ("support_tickets", "priority", "priority"),
    "industries": ("customers", "industry", "industry"),
    "plan_tiers": ("customers", "plan_tier", "plan_tier"),
    "product_categories": ("products", "category", "product_category"),
}


def valid_values(tables, lookup: str) -> DataFrame:
    """Distinct values in use, sorted."""
    table, column, _ = LOOKUPS[lookup]
    return getattr(tables, table)(column).distinct().orderBy(column)


def all_valid_values(tables) -> DataFrame:
    """``(parameter, value)`` of every lookup."""
    return distinct_values(tables, list(LOOKUPS.values()))


def distinct_values(tables, wanted: list[tuple[str, str, str]]) -> DataFrame:
    """Distinct ``(parameter, value)`` of ``(table, column, parameter)`` entries, in one pass per table."""
    parts = []
    for table in dict.fromkeys(t for t, *_ in wanted):
        mine = [(column, parameter) for t, column, parameter in wanted if t == table]
        entries = F.array(*[F.struct(F.lit(parameter).alias("parameter"), F.col(column).alias("value")) for column, parameter in mine])
        source = getattr(tables, table)(*dict.fromkeys(column for column, _ in mine))
        parts.append(source.select(F.explode(entries).alias("e")).select("e.parameter", "e.value").distinct())
    return reduce(DataFrame.unionByName, parts)


def validate_params(tables, requested: DataFrame) -> DataFrame:
    """Requested ``(parameter, value)`` rows that would match nothing."""
    return unknown_values(requested, all_valid_values(tables))
