"""Address, postcode, country, SIC and value-shape expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# SIC 2007 sections as (letter, lowest division, highest division).
SIC_SECTIONS = (
    ("A", 1, 3), ("B", 5, 9), ("C", 10, 33), ("D", 35, 35), ("E", 36, 39), ("F", 41, 43), ("G", 45, 47), ("H", 49, 53), ("I", 55, 56), ("J", 58, 63), ("K", 64, 66),
    ("L", 68, 68), ("M", 69, 75), ("N", 77, 82), ("O", 84, 84), ("P", 85, 85), ("Q", 86, 88), ("R", 90, 93), ("S", 94, 96), ("T", 97, 98), ("U", 99, 99),
)
# Fixed value: the form of a UK postcode without spaces.
UK_POSTCODE = "^(GIR0AA|[A-Z]{1,2}[0-9][A-Z0-9]?[0-9][A-Z]{2})$"
# Names that count as the United Kingdom, in normal form.
UK_NAMES = (
    "england", "scotland", "wales", "cymru", "northern ireland", "n ireland", "n. ireland", "northern-ireland", "united kingdom", "uk", "u.k", "u.k.", "gb", "great britain", "britain",
    "england and wales", "england & wales", "united kingdom of great britain and northern ireland",
)


def address(raw: Column) -> Column:
    """Upper case, punctuation as space, runs of space collapsed; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(F.upper(raw), r"[^A-Z0-9\s]", " "), r"\s+", " ")), F.lit(""))


def address_loose(raw: Column) -> Column:
    """As address(), without any spaces."""
    return F.nullif(F.regexp_replace(F.upper(raw), r"[^A-Z0-9]", ""), F.lit(""))


def postcode(raw: Column) -> Column:
    return F.nullif(F.replace(F.upper(F.trim(raw)), F.lit(" "), F.lit("")), F.lit(""))


def postcode_valid(normal: Column) -> Column:
    return normal.rlike(UK_POSTCODE)


def postcode_district(normal: Column) -> Column:
    """The outward code of a valid postcode."""
    return F.when(postcode_valid(normal), F.substring(normal, F.lit(1), F.length(normal) - 3))


def country(raw: Column) -> Column:
    """Lower case without trailing dots, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(F.lower(raw)), r"\.+$", ""), r"\s+", " "))


def is_uk(raw: Column) -> Column:
    return country(raw).isin(*UK_NAMES)


def sic_section(code: Column) -> Column:
    """Section letter of the division that the first two digits of a code name; unknown without one."""
    division = F.substring(F.regexp_replace(F.coalesce(code, F.lit("")), r"[^0-9]", ""), 1, 2)
    number = F.when(division != "", division.cast("int"))
    picked = reduce(lambda acc, s: acc.when(number.between(s[1], s[2]), s[0]), SIC_SECTIONS[1:], F.when(number.between(*SIC_SECTIONS[0][1:]), SIC_SECTIONS[0][0]))
    return picked.otherwise("unknown")


def sic_leading_digits(text: Column) -> Column:
    """The code of a SIC text by its leading digits (control sampling)."""
    return F.nullif(F.regexp_extract(text, r"^\s*(\d+)", 1), F.lit(""))


def sic_before_dash(text: Column) -> Column:
    """The code of a SIC text by what stands before ' - ' (register features)."""
    return F.nullif(F.trim(F.split_part(text, F.lit(" - "), F.lit(1))), F.lit(""))


def case_type(raw: Column) -> Column:
    """Reporting group of a published case type; the first group that fits wins."""
    low = F.lower(F.trim(raw))
    liquidation = low.contains("liquidat")
    return (
        F.when(low.contains("compulsory") & liquidation, "compulsory_liquidation")
        .when((low.contains("creditor") | low.contains("cvl")) & liquidation, "creditors_voluntary_liquidation")
        .when(low.contains("administration"), "administration")
        .when(low.contains("voluntary arrangement") | (low == "cva"), "corporate_voluntary_arrangement")
        .otherwise("other")
    )


def value_shape(raw: Column) -> Column:
    """empty, name, code, free-text or other, by the form of a value."""
    s = F.trim(F.coalesce(raw, F.lit("")))
    return (
        F.when(s == "", "empty")
        .when(s.rlike(r"^[A-Z0-9][A-Z0-9_./-]*$") & s.rlike(r"[0-9]"), "code")
        .when(s.rlike(r"^[A-Z][a-z'-]+( [A-Z][a-z'-]+){1,3}$"), "name")
        .when(F.size(F.split(s, r"\s+")) >= 5, "free-text")
        .otherwise("other")
    )


def equality_tier(a: Column, b: Column) -> Column:
    """How two texts agree: exact, decimal, collapsed, stripped, or mismatch with a reason; null if one is null."""
    collapse = lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))
    strip = lambda x: F.regexp_replace(x, r"\s+", "")
    number = lambda x: F.when(x.rlike(r"^-?\d{1,20}(\.\d{1,10})?$"), x.try_cast("decimal(38,10)"))
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("string"))
        .when(a == b, "exact")
        .when(number(a) == number(b), "decimal")
        .when(collapse(a) == collapse(b), "collapsed")
        .when(strip(a) == strip(b), "stripped")
        .when(strip(a).startswith(strip(b)) | strip(b).startswith(strip(a)), "mismatch: prefix")
        .when(strip(a).endswith(strip(b)) | strip(b).endswith(strip(a)), "mismatch: suffix")
        .when(number(a).isNotNull() & number(b).isNotNull(), "mismatch: number")
        .otherwise("mismatch: other")
    )
