"""Bands of counts, display of small counts, log transforms and column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Published counts from 1 to one less are hidden.
SUPPRESSED_BELOW = 10


def employees(n: Column) -> Column:
    return F.when(n.isNull(), F.lit(None).cast("string")).when(n <= 0, "0").when(n <= 10, "1-10").when(n <= 50, "11-50").when(n <= 250, "51-250").otherwise("251+")


def persons(n: Column) -> Column:
    return F.when(n.isNull() | (n < 1), F.lit(None).cast("string")).when(n == 1, "1").when(n <= 10, "2-10").otherwise("11+")


def concentration(n: Column) -> Column:
    return F.when(n <= 0, "0").when(n == 1, "1").when(n <= 10, "2-10").when(n <= 100, "11-100").when(n <= 1000, "101-1000").otherwise("1001+")


def lag_days(days: Column) -> Column:
    return F.when(days < 0, "negative").when(days <= 14, "0-14").when(days <= 28, "15-28").when(days <= 90, "29-90").when(days <= 365, "91-365").when(days > 365, "366+")


def shown(n: Column) -> Column:
    """A count as text: <10 for 1 to 9, else with thousands separators."""
    return F.when((n > 0) & (n < SUPPRESSED_BELOW), f"<{SUPPRESSED_BELOW}").otherwise(F.format_number(n, 0))


def log_count(x: Column) -> Column:
    return F.log1p(F.greatest(x, F.lit(0)))


def log_signed(x: Column) -> Column:
    return F.signum(x) * F.log1p(F.abs(x))


def prefixed(columns: list[str], prefix: str) -> list[str]:
    """Names with a prefix, unless they have it; a name that would then occur twice is an error."""
    out = [c if c.startswith(prefix) else prefix + c for c in columns]
    if len(set(out)) < len(out):
        raise ValueError(f"duplicate columns with prefix {prefix}: {sorted(c for c in set(out) if out.count(c) > 1)}")
    return out


def obscured_member(path: Column, company: Column) -> Column:
    """A member path with its company number as X of the same length."""
    return F.replace(path, company, F.repeat(F.lit("X"), F.length(company)))
