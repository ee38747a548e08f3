"""Nature-of-control codes and kinds of controlling persons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes that name the kind of entity, longest first.
SUFFIXES = (
    "-as-control-over-trust-registered-overseas-entity",
    "-as-control-over-firm-registered-overseas-entity",
    "-as-trust-limited-liability-partnership",
    "-as-firm-limited-liability-partnership",
    "-as-trust-registered-overseas-entity",
    "-as-firm-registered-overseas-entity",
    "-limited-liability-partnership",
    "-registered-overseas-entity",
    "-as-trust",
    "-as-firm",
)
# Bands that can be ranked, least control first, and the form of any band.
BANDS = ("25-to-50-percent", "50-to-75-percent", "75-to-100-percent")
BAND_FORM = r"(\d+-to-\d+-percent|more-than-\d+-percent)"
# Rights that stand before a band or more, and the one that stands alone.
CORES = ("ownership-of-shares", "voting-rights", "right-to-appoint-and-remove", "part-right-to-share-surplus-assets", "right-to-share-surplus-assets", "registered-owner-as-nominee")
ALONE = "significant-influence-or-control"
# Kinds and their categories.
KINDS = {
    "individual-person-with-significant-control": "individual",
    "individual-beneficial-owner": "individual",
    "corporate-entity-person-with-significant-control": "corporate",
    "corporate-entity-beneficial-owner": "corporate",
    "legal-person-person-with-significant-control": "legal-person",
    "legal-person-beneficial-owner": "legal-person",
    "super-secure-person-with-significant-control": "super-secure",
    "super-secure-beneficial-owner": "super-secure",
}
# Kinds of lines in whole-register files and their categories.
LINE_KINDS = {
    "individual-person-with-significant-control": "individual",
    "corporate-entity-person-with-significant-control": "corporate",
    "legal-person-person-with-significant-control": "legal_person",
    "persons-with-significant-control-statement": "statement",
    "super-secure-person-with-significant-control": "super_secure",
    "super-secure-beneficial-owner": "super_secure",
    "exemptions": "exemption",
    "individual-beneficial-owner": "bo_individual",
    "corporate-entity-beneficial-owner": "bo_corporate",
    "legal-person-beneficial-owner": "bo_legal",
    "totals#persons-of-significant-control-snapshot": "totals",
}


def decompose(code: Column) -> Column:
    """Struct of suffix_family (plain without one), base, band and core; band and core are null if there are none."""
    family = reduce(lambda acc, s: acc.when(code.endswith(s), s[1:]), SUFFIXES[1:], F.when(code.endswith(SUFFIXES[0]), SUFFIXES[0][1:])).otherwise("plain")
    base = F.when(family == "plain", code).otherwise(F.substring(code, F.lit(1), F.length(code) - F.length(family) - 1))
    core = reduce(lambda acc, c: acc.when(base.startswith(f"{c}-"), c), CORES, F.when(base == ALONE, ALONE))
    return F.struct(family.alias("suffix_family"), base.alias("base"), F.nullif(F.regexp_extract(base, BAND_FORM, 1), F.lit("")).alias("band"), core.alias("core"))


def band_rank(band: Column) -> Column:
    """1 to 3 for a band that can be ranked, else null."""
    return reduce(lambda acc, i: acc.when(band == BANDS[i], i + 1), (1, 2), F.when(band == BANDS[0], 1))


def band_of_rank(rank: Column) -> Column:
    return F.get(F.array(*map(F.lit, BANDS)), rank - 1)  # element_at gives the last for a null rank


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))


def kind_category(kind: Column) -> Column:
    """Category of a person's kind for features; other if it isn't known."""
    return F.coalesce(F.try_element_at(_lookup(KINDS), kind), F.lit("other"))


def line_category(kind: Column) -> Column:
    """Category of a line's kind in a whole-register file; unknown if it isn't known."""
    return F.coalesce(F.try_element_at(_lookup(LINE_KINDS), kind), F.lit("unknown"))
