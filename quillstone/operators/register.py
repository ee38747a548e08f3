"""Per-company features of a register snapshot, all in one pass but for the concentration counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import dates, text
from quillstone.functions.identifiers import join_key

# SIC codes of dormant and of non-trading companies.
DORMANT, NON_TRADING = "99999", "74990"
SICS = [f"`SICCode.SicText_{i}`" for i in range(1, 5)]
PREVIOUS = [f"`PreviousName_{i}.CompanyName`" for i in range(1, 11)]
CHARGES = {"n_charges": "NumMortCharges", "n_outstanding": "NumMortOutstanding", "n_part_satisfied": "NumMortPartSatisfied", "n_satisfied": "NumMortSatisfied"}


def concentration(rows: DataFrame, key: str, name: str) -> DataFrame:
    """rows with the number of rows that share `key`; 0 for a null key. Counts are made before the join, so a hot key is one row."""
    n = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return rows.join(n, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def sic_codes(columns: list[str] = SICS) -> Column:
    """Distinct codes of SIC texts, in order."""
    each = F.transform(F.array(*map(F.col, columns)), text.sic_before_dash)
    return F.array_distinct(F.filter(each, lambda c: c.isNotNull()))


def features(register: DataFrame, snapshot_date: str, governed: bool = True, nec_codes: tuple[str, ...] = ()) -> DataFrame:
    """One row per company: age, category, charges, overdue flags, SIC flags, shared postcode and (ungoverned only) address.

    Overdue flags are never null; accounts_never_filed is null where the category is null and the company is old enough.
    """
    day = F.lit(snapshot_date).cast("date")
    c = lambda name: F.nullif(F.trim(F.col(f"`{name}`")), F.lit(""))
    born = dates.uk_date(c("IncorporationDate"))
    due, statement = dates.uk_date(c("Accounts.NextDueDate")), dates.uk_date(c("ConfStmtNextDueDate"))
    category = c("Accounts.AccountCategory")
    rows = register.where(F.coalesce(F.trim("CompanyNumber"), F.lit("")) != "").withColumns({"__sics": sic_codes(), "postcode": text.postcode(F.col("`RegAddress.PostCode`"))})
    rows = rows.withColumn("address", F.concat_ws("|", text.address(F.col("`RegAddress.AddressLine1`")), F.col("postcode")))
    sections = F.array_distinct(F.transform("__sics", text.sic_section))
    named = F.filter(F.array(*map(F.col, PREVIOUS)), lambda n: F.nullif(F.trim(n), F.lit("")).isNotNull())
    has = lambda *codes: F.arrays_overlap("__sics", F.array(*map(F.lit, codes))) if codes else F.lit(False)
    out = rows.select(
        join_key(F.col("CompanyNumber")).alias("company_number"),
        c("CompanyCategory").alias("company_category"),
        c("CompanyStatus").alias("company_status"),
        born.alias("incorporation_date"),
        dates.whole_months(day, born).alias("age_months"),
        category.alias("accounts_category"),
        dates.uk_date(c("Accounts.LastMadeUpDate")).alias("accounts_last_made_up"),
        F.coalesce(due < day, F.lit(False)).alias("accounts_overdue"),
        F.coalesce(statement < day, F.lit(False)).alias("confirmation_overdue"),
        (F.coalesce(due < day, F.lit(False)) & (category == "NO ACCOUNTS FILED")).alias("accounts_never_filed"),
        *(F.coalesce(c(f"Mortgages.{v}").try_cast("int"), F.lit(0)).alias(k) for k, v in CHARGES.items()),
        F.size(named).alias("n_previous_names"),
        F.size("__sics").alias("n_sic_codes"),
        F.size(sections).alias("n_sic_sections"),
        text.sic_section(F.get("__sics", F.lit(0))).alias("sic_section"),
        has(DORMANT).alias("sic_dormant"),
        has(NON_TRADING).alias("sic_non_trading"),
        has(*nec_codes).alias("sic_nec"),
        "postcode",
        "address",
    )
    out = concentration(out, "postcode", "n_companies_same_postcode")
    if governed:
        return out.drop("postcode", "address")
    return concentration(out, "address", "n_companies_same_address").drop("postcode", "address")
