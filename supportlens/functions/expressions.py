"""Column expressions shared by the table functions and the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight of a ticket priority in averages.
PRIORITY_SCORES = {"Critical": 4, "High": 3, "Medium": 2, "Low": 1}

STILL_OPEN = ["Open", "In Progress", "Escalated"]
FINISHED = ["Resolved", "Closed"]
UNPAID = ["Overdue", "Pending"]


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding that does not depend on the order doubles were added in.

    Ten decimals are kept before rounding, so 12.4999999999999 from one partition
    order and 12.5 from another give the same result.
    """
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def percent(condition: Column, digits: int = 1) -> Column:
    """Share of the group's rows that satisfy ``condition``; NULL counts as no."""
    return rounded(F.count_if(condition) * F.lit(100.0) / F.count(F.lit(1)), digits)


def mean(column: str, digits: int) -> Column:
    return rounded(F.avg(column), digits)


def total(column: str, digits: int = 2) -> Column:
    return rounded(F.sum(column), digits)


def rows() -> Column:
    return F.count(F.lit(1))


def priority_score(priority: Column) -> Column:
    """4 to 1 for Critical to Low; NULL for any other text."""
    pairs = [F.lit(x) for item in PRIORITY_SCORES.items() for x in item]
    return F.element_at(F.create_map(*pairs), priority)


def attention_order(priority: Column) -> Column:
    """Critical first, High second, everything else last."""
    return F.when(priority == "Critical", 1).when(priority == "High", 2).otherwise(3)
