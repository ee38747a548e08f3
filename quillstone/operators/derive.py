"""Cached API responses to one attribute record per company.

A response row: company_number, endpoint, status_code, fetched_at, data (JSON text). Ages are measured at the response's own
fetch date. A resource never fetched leaves nulls; one fetched and absent (404) leaves zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import dates, natures

# Statuses that aren't screened, and case types of solvent windings-up.
EXCLUDED_STATUSES = ("dissolved", "converted-closed", "closed", "removed")
SOLVENT_CASES = ("members-voluntary-liquidation",)

_IDENTITY = "identity_verification_details struct<appointment_verification_statement_due_on:string,identity_verified_on:string,appointment_verification_statement_date:string>".replace(" struct", ":struct", 1)
_PROFILE = (
    "struct<company_name:string,company_status:string,company_status_detail:string,type:string,subtype:string,jurisdiction:string,date_of_creation:string,sic_codes:array<string>,"
    "previous_company_names:array<struct<name:string>>,accounts:struct<overdue:boolean,next_due:string,accounting_reference_date:struct<day:string,month:string>,"
    "last_accounts:struct<type:string,period_end_on:string,made_up_to:string>,next_accounts:struct<overdue:boolean,due_on:string,period_end_on:string>>,"
    "confirmation_statement:struct<overdue:boolean,next_due:string>,links:struct<charges:string,insolvency:string>,has_charges:boolean,has_insolvency_history:boolean,has_been_liquidated:boolean,"
    "has_super_secure_pscs:boolean,registered_office_is_in_dispute:boolean,undeliverable_registered_office_address:boolean,registered_office_address:struct<postal_code:string,locality:string>,"
    "corporate_annotation:array<struct<type:string>>,partial_data_available:string,date_of_cessation:string>"
)
_CASES = "struct<cases:array<struct<type:string>>>"
_OFFICERS = f"struct<items:array<struct<appointed_on:string,resigned_on:string,{_IDENTITY}>>>"
_PSC = f"struct<active_count:long,ceased_count:long,items:array<struct<kind:string,ceased:boolean,ceased_on:string,natures_of_control:array<string>,identification:struct<registration_number:string>,{_IDENTITY}>>>"
_STATEMENTS = "struct<items:array<struct<statement:string,ceased_on:string>>>"


def latest_responses(responses: DataFrame) -> DataFrame:
    """The last response per (company_number, endpoint)."""
    w = Window.partitionBy("company_number", "endpoint").orderBy(F.col("fetched_at").desc(), F.col("data").desc())
    return responses.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _joined(items: Column) -> Column:
    return _filled(F.array_join(items, ","))


def profile(rows: DataFrame) -> DataFrame:
    """Attributes of profile responses; current fields first, their deprecated forms where those are missing."""
    d = F.from_json("data", _PROFILE)
    found = F.col("status_code") != 404
    p = rows.withColumn("d", F.when(found, d))
    created = dates.iso_date(F.col("d.date_of_creation"))
    notes = F.array_sort(F.array_distinct(F.transform("d.corporate_annotation", lambda a: F.coalesce(a["type"], F.lit("unknown")))))
    return p.select(
        "company_number",
        F.col("fetched_at").alias("observed_at"),
        found.alias("found"),
        *(F.col(f"d.{c}") for c in ("company_name", "company_status", "company_status_detail")),
        F.col("d.type").alias("company_type"),
        *(F.col(f"d.{c}") for c in ("subtype", "jurisdiction", "date_of_creation")),
        dates.whole_months(F.to_date("fetched_at"), created).alias("age_months"),
        F.when(F.col("d").isNotNull(), F.array_join(F.coalesce("d.sic_codes", F.array().cast("array<string>")), ",")).alias("sic_codes"),
        F.when(F.col("d").isNotNull(), F.coalesce(F.array_size("d.previous_company_names"), F.lit(0))).alias("n_previous_names"),
        F.coalesce("d.accounts.next_accounts.overdue", "d.accounts.overdue").alias("accounts_overdue"),
        F.coalesce(_filled(F.col("d.accounts.next_accounts.due_on")), F.col("d.accounts.next_due")).alias("accounts_next_due"),
        F.col("d.accounts.last_accounts.type").alias("last_accounts_type"),
        F.coalesce(_filled(F.col("d.accounts.last_accounts.period_end_on")), F.col("d.accounts.last_accounts.made_up_to")).alias("last_accounts_period_end"),
        F.col("d.confirmation_statement.overdue").alias("confirmation_statement_overdue"),
        F.col("d.confirmation_statement.next_due").alias("confirmation_statement_next_due"),
        F.when(F.col("d").isNotNull(), _filled(F.col("d.links.charges")).isNotNull()).alias("has_charges_link"),
        F.col("d.has_charges"),
        F.when(F.col("d").isNotNull(), _filled(F.col("d.links.insolvency")).isNotNull()).alias("has_insolvency_link"),
        *(F.col(f"d.{c}") for c in ("has_insolvency_history", "has_been_liquidated", "has_super_secure_pscs", "registered_office_is_in_dispute", "undeliverable_registered_office_address")),
        F.col("d.registered_office_address.postal_code").alias("office_postcode"),
        F.col("d.registered_office_address.locality").alias("office_locality"),
        F.when(F.col("d").isNotNull(), F.coalesce(F.col("d.company_status").isin(*EXCLUDED_STATUSES), F.lit(False))).alias("excluded_status"),
        F.when(F.col("d").isNotNull(), F.coalesce(F.array_size("d.corporate_annotation"), F.lit(0))).alias("n_corporate_annotations"),
        _joined(notes).alias("corporate_annotation_types"),
        *(F.col(f"d.{c}") for c in ("partial_data_available", "date_of_cessation")),
        F.col("d.accounts.accounting_reference_date.day").alias("ard_day"),
        F.col("d.accounts.accounting_reference_date.month").alias("ard_month"),
        F.col("d.accounts.next_accounts.period_end_on").alias("next_accounts_period_end"),
    )


def insolvency(rows: DataFrame) -> DataFrame:
    """Case counts and sorted distinct case types, adverse and solvent ones apart."""
    d = rows.where("status_code <> 404").withColumn("d", F.from_json("data", _CASES)).where("d is not null")
    types = F.array_sort(F.array_distinct(F.transform(F.coalesce("d.cases", F.array().cast("array<struct<type:string>>")), lambda c: F.coalesce(c["type"], F.lit("unknown")))))
    return d.withColumn("types", types).select(
        "company_number",
        F.coalesce(F.array_size("d.cases"), F.lit(0)).alias("insolvency_n_cases"),
        _joined(F.col("types")).alias("insolvency_case_types"),
        _joined(F.filter("types", lambda t: ~t.isin(*SOLVENT_CASES))).alias("insolvency_adverse_case_types"),
        _joined(F.filter("types", lambda t: t.isin(*SOLVENT_CASES))).alias("insolvency_solvent_case_types"),
    )


def _identity_counts(items: str, prefix: str) -> list[Column]:
    of = lambda test: F.size(F.filter(items, lambda x: F.coalesce(test(x["identity_verification_details"]), F.lit(False))))
    there = lambda v, f: _filled(v[f]).isNotNull()
    return [
        of(lambda v: v.isNotNull()).alias(f"n_{prefix}_id_verified"),
        of(lambda v: there(v, "appointment_verification_statement_due_on") & ~there(v, "identity_verified_on")).alias(f"n_{prefix}_id_verification_due"),
        of(lambda v: there(v, "appointment_verification_statement_date")).alias(f"n_{prefix}_id_statement_filed"),
    ]


def officers(rows: DataFrame) -> DataFrame:
    """Officers in all, active, resigned, and appointments and resignations within 24 months of the fetch date."""
    items = F.coalesce(F.from_json("data", _OFFICERS)["items"], F.from_json(F.lit("[]"), _OFFICERS.removeprefix("struct<items:").removesuffix(">")))
    d = rows.where("status_code <> 404 and data is not null").withColumn("items", items)
    recent = lambda field: F.size(F.filter("items", lambda o: F.coalesce(dates.whole_months(F.to_date("fetched_at"), dates.iso_date(o[field])).between(0, 23), F.lit(False))))
    resigned = F.size(F.filter("items", lambda o: dates.iso_date(o["resigned_on"]).isNotNull()))
    return d.select(
        "company_number",
        F.size("items").alias("n_officers_total"),
        (F.size("items") - resigned).alias("n_officers_active"),
        resigned.alias("n_officers_resigned"),
        recent("appointed_on").alias("n_appointments_last_24m"),
        recent("resigned_on").alias("n_resignations_last_24m"),
        (recent("appointed_on") + recent("resigned_on")).alias("officer_churn_24m"),
        *_identity_counts("items", "officers"),
    )


def ownership(companies: DataFrame, psc: DataFrame, statements: DataFrame) -> DataFrame:
    """Persons with significant control and their statements, for every company of `companies` (company_number)."""
    p = psc.select("company_number", F.col("status_code").alias("pcode"), F.when(F.col("status_code") != 404, F.from_json("data", _PSC)).alias("p"))
    s = statements.select("company_number", F.col("status_code").alias("scode"), F.when(F.col("status_code") != 404, F.from_json("data", _STATEMENTS)).alias("s"))
    rows = companies.select("company_number").join(p, "company_number", "left").join(s, "company_number", "left")
    empty = F.from_json(F.lit("[]"), _PSC[_PSC.index("items:") + 6 : -1])
    ceased = lambda r: F.coalesce(r["ceased"], r["ceased_on"].isNotNull())
    rows = rows.withColumn("items", F.when(F.col("p").isNotNull(), F.coalesce("p.items", empty))).withColumn("active", F.filter("items", lambda r: ~ceased(r)))
    zero = F.when(F.col("pcode") == 404, 0)
    none = F.when(F.col("pcode") == 404, F.lit(False))
    n_ceased = F.coalesce("p.ceased_count", F.size("items") - F.size("active"))
    n_active = F.when(F.col("p.ceased_count").isNotNull(), F.coalesce("p.active_count", F.greatest(F.size("items") - F.col("p.ceased_count"), F.lit(0)))).otherwise(F.size("active"))
    codes = F.array_sort(F.array_distinct(F.flatten(F.transform("active", lambda r: F.coalesce(r["natures_of_control"], F.array().cast("array<string>"))))))
    rows = rows.withColumn("codes", codes).withColumn("parts", F.transform("codes", natures.decompose))
    highest = lambda core: natures.band_of_rank(F.array_max(F.transform(F.filter("parts", lambda n: n["core"] == core), lambda n: natures.band_rank(n["band"]))))
    has = lambda core: F.exists("parts", lambda n: F.coalesce(n["core"] == core, F.lit(False)))
    unmapped = F.transform(F.filter(F.arrays_zip("codes", "parts"), lambda z: z["parts"]["core"].isNull()), lambda z: z["codes"])
    kind = lambda k: F.size(F.filter("active", lambda r: natures.kind_category(r["kind"]) == k))
    numbers = F.transform(F.filter("active", lambda r: (natures.kind_category(r["kind"]) == "corporate") & _filled(r["identification"]["registration_number"]).isNotNull()), lambda r: r["identification"]["registration_number"])
    uk = F.size(F.filter(numbers, lambda x: F.replace(F.upper(F.trim(x)), F.lit(" "), F.lit("")).rlike(r"^(\d{8}|[A-Z]{2}\d{6})$")))
    live = F.transform(F.filter("s.items", lambda x: _filled(x["ceased_on"]).isNull() & x["statement"].isNotNull()), lambda x: x["statement"])
    there = F.col("p").isNotNull()
    or_zero = lambda c: F.when(there, c).otherwise(zero)
    state = (
        F.when(F.col("pcode").isNull() | F.col("scode").isNull(), "unknown")
        .when(F.coalesce(or_zero(n_active), F.lit(0)) > 0, "identified")
        .when(F.coalesce(F.size(live), F.lit(0)) > 0, "statement_only")
        .otherwise("none_reported")
    )
    return rows.select(
        "company_number",
        F.when(F.col("pcode").isNull(), "not_fetched").when(F.col("pcode") == 404, "not_found").otherwise("ok").alias("psc_fetch_status"),
        or_zero(n_active + n_ceased).alias("psc_n_records"),
        or_zero(n_ceased).alias("psc_n_ceased"),
        _joined(live).alias("active_psc_statement_codes"),
        state.alias("psc_information_state"),
        _joined(F.col("codes")).alias("psc_natures_of_control"),
        highest("ownership-of-shares").alias("psc_max_ownership_band"),
        highest("voting-rights").alias("psc_max_voting_band"),
        F.when(there, has("right-to-appoint-and-remove")).otherwise(none).alias("psc_has_appointment_rights"),
        F.when(there, has(natures.ALONE)).otherwise(none).alias("psc_has_significant_influence"),
        or_zero(F.size("codes")).alias("psc_n_distinct_natures"),
        *(or_zero(kind(k)).alias(f"psc_n_{k.replace('-', '_')}") for k in ("individual", "corporate", "legal-person", "super-secure")),
        _joined(numbers).alias("psc_corporate_reg_numbers"),
        or_zero(uk).alias("psc_n_corporate_uk_format_regno"),
        _joined(unmapped).alias("psc_unmapped_natures"),
        *(or_zero(c).alias(n) for c, n in zip(_identity_counts("items", "psc"), ("n_psc_id_verified", "n_psc_id_verification_due", "n_psc_id_statement_filed"), strict=True)),
    )


def derive(responses: DataFrame) -> DataFrame:
    """One record per company with a profile response, from the last response of each endpoint."""
    last = latest_responses(responses)
    of = lambda endpoint: last.where(F.col("endpoint") == endpoint)
    base = profile(of("profile"))
    return (
        base.join(insolvency(of("insolvency")), "company_number", "left")
        .join(officers(of("officers")), "company_number", "left")
        .join(ownership(base, of("psc"), of("psc_statements")), "company_number", "left")
    )
