"""Declarative rules over attribute records: flags with evidence, partitions and a summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses of formal insolvency, the months of a young company, and unresolved-ownership statements.
INSOLVENT_STATUSES = ("liquidation", "administration", "receivership", "voluntary-arrangement", "insolvency-proceedings")
YOUNG_MONTHS = 24
UNRESOLVED = tuple(f"{s}{t}" for t in ("", "-partnership") for s in ("steps-to-find-psc-not-yet-completed", "psc-exists-but-not-identified", "psc-details-not-confirmed"))


@dataclass(frozen=True)
class Rule:
    """evidence: text where the rule fires, else null."""

    rule_id: str
    severity: str
    evidence: Column
    tier: int = 1


def _some(name: str) -> Column:
    return F.nullif(F.col(name), F.lit("")).isNotNull()


def _true(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def registry() -> list[Rule]:
    """All rules over the columns of operators.derive."""
    solvent = _some("insolvency_case_types") & ~_some("insolvency_adverse_case_types")
    hinted = _true("has_insolvency_link") | _true("has_insolvency_history") | _true("has_been_liquidated")
    codes = F.split("active_psc_statement_codes", ",")
    present = F.filter(F.array(*map(F.lit, UNRESOLVED)), lambda c: F.array_contains(codes, c))
    dispute = [F.when(_true(c), c) for c in ("registered_office_is_in_dispute", "undeliverable_registered_office_address")]
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    due = lambda c: F.coalesce(F.col(c), F.lit("None"))
    return [
        Rule("STATUS_INSOLVENT", "high", F.when(F.col("company_status").isin(*INSOLVENT_STATUSES) & ~((F.col("company_status") == "liquidation") & solvent), text("company_status=", F.col("company_status")))),
        Rule("STATUS_STRIKEOFF", "high", F.when(F.col("company_status_detail") == "active-proposal-to-strike-off", text("company_status_detail=", F.col("company_status_detail")))),
        Rule(
            "INSOLVENCY_ADVERSE",
            "high",
            F.when(_some("insolvency_adverse_case_types"), text(F.col("insolvency_n_cases"), " case(s), adverse types: ", F.col("insolvency_adverse_case_types"))).when(
                hinted & ~_some("insolvency_case_types"), "insolvency indicated on profile; cases unclassified (resource not cached)"
            ),
        ),
        Rule("SOLVENT_WINDING_UP", "info", F.when(solvent, text("all cases solvent types: ", F.col("insolvency_solvent_case_types")))),
        Rule("ACCOUNTS_OVERDUE", "medium", F.when(_true("accounts_overdue"), text("accounts overdue (next_due=", due("accounts_next_due"), ")"))),
        Rule("CS_OVERDUE", "medium", F.when(_true("confirmation_statement_overdue"), text("confirmation statement overdue (next_due=", due("confirmation_statement_next_due"), ")"))),
        Rule("ADDR_DISPUTE", "medium", F.nullif(F.concat_ws(", ", *dispute), F.lit(""))),
        Rule("CHARGES_OUTSTANDING", "info", F.when(_true("has_charges_link"), "charges resource linked from profile").when(_true("has_charges"), "has_charges=true (deprecated field; older cached response)")),
        Rule("YOUNG_COMPANY", "info", F.when(F.col("age_months") < YOUNG_MONTHS, text("age_months=", F.col("age_months")))),
        Rule("PSC_UNRESOLVED", "low", F.when(F.size(present) > 0, text("active PSC statement(s): ", F.array_join(present, ", ")))),
    ]


def flags(records: DataFrame, rules: list[Rule], key: str, observed: str) -> DataFrame:
    """key, rule_id, severity, tier, evidence, observed_at: one row per rule that fires, in one pass over the records."""
    each = F.array(*(F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.lit(r.tier).alias("tier"), r.evidence.alias("evidence")) for r in rules))
    fired = F.filter(each, lambda x: x["evidence"].isNotNull())
    return records.select(key, F.col(observed).alias("observed_at"), F.explode(fired).alias("f")).select(key, "f.*", "observed_at")


def partition(records: DataFrame) -> dict[str, DataFrame]:
    """Records not found, of excluded status, and to be screened; each record is in one part."""
    found, excluded = _true("found"), _true("excluded_status")
    return {"not_found": records.where(~found), "excluded": records.where(found & excluded), "screened": records.where(found & ~excluded)}


def summary(records: DataFrame, flagged: DataFrame, key: str) -> DataFrame:
    """One row: companies by part, flags by severity, and companies with a flag that isn't mere information."""
    found, excluded = _true("found"), _true("excluded_status")
    parts = records.agg(F.count(F.lit(1)).alias("n_companies"), F.count_if(~found).alias("n_not_found"), F.count_if(found & excluded).alias("n_excluded"), F.count_if(found & ~excluded).alias("n_screened"))
    counts = flagged.agg(*(F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in ("high", "medium", "low", "info")), F.count_distinct(F.when(F.col("severity") != "info", F.col(key))).alias("n_flagged"))
    return parts.crossJoin(counts)  # one row each
