"""What a concept's name says of its values, and families of units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings of names, case-insensitive.
TEXT_NAME = r"(?i)(Date|Description|Policy|Name)$"
NUMERIC_NAME = r"(?i)(Amount|Value|Number|Count|Percentage|Percent|Rate|Ratio|Balance|Assets|Liabilities|Equity|Revenue|Profit|Loss|Costs?|Expenses?|Income|Turnover|Capital|Cash|Creditors|Debtors|Employees)(DuringPeriod|AtPeriodEnd)?$"
IDENTIFIER_NAME = r"(?i)(Registered|Registration|Company|Reference|Identifier)Number$"
# Fixed value: the form of a currency's code.
CURRENCY = "^[A-Z]{3}$"


def name_kind(name: Column) -> Column:
    """identifier, numeric, text or other, in this order of precedence; null stays null."""
    return F.when(name.rlike(IDENTIFIER_NAME), "identifier").when(name.rlike(NUMERIC_NAME), "numeric").when(name.rlike(TEXT_NAME), "text").when(name.isNotNull(), "other")


def unit_family(unit: Column) -> Column:
    """A unit in lower case, each of its parts between slashes that looks like a currency's code as `currency`; null stays null."""
    part = lambda p: F.when(F.upper(p).rlike(CURRENCY), "currency").otherwise(F.lower(p))
    return F.when(unit.isNotNull(), F.array_join(F.transform(F.split(unit, "/"), part), "/"))
