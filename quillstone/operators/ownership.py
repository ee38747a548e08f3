"""Ownership records: parsing of register lines, per-company summaries and load reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import dates, hashing, natures, text

#: Ownership has been recorded since this day.
REGIME_START = "2016-04-06"
#: Person-derived columns that governed output never has.
GOVERNED_DROPPED = ("name", "forename", "middle_name", "surname", "title", "birth_year", "birth_month", "address_line_1", "address_line_2", "premises", "postcode", "raw", "person_key", "person_key_strict", "nationality", "locality", "region", "po_box", "care_of", "etag")

_DATA = {
    "kind": "$.data.kind", "psc_link": "$.data.links.self", "name": "$.data.name", "forename": "$.data.name_elements.forename", "middle_name": "$.data.name_elements.middle_name",
    "surname": "$.data.name_elements.surname", "title": "$.data.name_elements.title", "nationality": "$.data.nationality", "country_of_residence": "$.data.country_of_residence",
    "address_line_1": "$.data.address.address_line_1", "address_line_2": "$.data.address.address_line_2", "premises": "$.data.address.premises", "locality": "$.data.address.locality",
    "region": "$.data.address.region", "country": "$.data.address.country", "postcode_raw": "$.data.address.postal_code", "registration_number": "$.data.identification.registration_number",
    "country_registered": "$.data.identification.country_registered", "notified_on_raw": "$.data.notified_on", "ceased_on_raw": "$.data.ceased_on", "statement": "$.data.statement",
    "identity_verified_on": "$.data.identity_verification_details.identity_verified_on", "verification_due_on": "$.data.identity_verification_details.appointment_verification_statement_due_on",
    "verification_statement_on": "$.data.identity_verification_details.appointment_verification_statement_date",
}


def parse_lines(lines: DataFrame, secret: bytes | None = None) -> DataFrame:
    """Typed columns of raw JSON lines (value, file). Bad JSON gives a row of nulls of category unknown; blank lines are gone already.

    Fields are read by explicit path, so rare keys aren't lost to inference. With a secret, persons get keyed hashes.
    """
    v = lines.withColumn("v", F.try_parse_json("value"))
    get = lambda path, kind="string": F.try_variant_get("v", path, kind)
    rows = v.select(
        "value",
        "file",
        F.col("v").isNull().alias("bad_json"),
        get("$.company_number").alias("company_number"),
        *(get(p).alias(n) for n, p in _DATA.items()),
        get("$.data.date_of_birth.year", "int").alias("birth_year"),
        get("$.data.date_of_birth.month", "int").alias("birth_month"),
        get("$.data.ceased", "boolean").alias("ceased_flag"),
        get("$.data.is_sanctioned", "boolean").alias("is_sanctioned"),
        get("$.data.natures_of_control", "array<string>").alias("natures_of_control"),
    )
    psc_id = F.nullif(F.regexp_extract("psc_link", "([^/]+)/?$", 1), F.lit(""))
    postcode = text.postcode(F.col("postcode_raw"))
    rows = rows.withColumns(
        {
            "psc_id": psc_id,
            "record_id": F.concat("company_number", F.lit("|"), psc_id),
            "category": natures.line_category(F.col("kind")),
            "notified_on": dates.iso_date(F.col("notified_on_raw")),
            "ceased_on": dates.iso_date(F.col("ceased_on_raw")),
            "postcode": postcode,
            "postcode_valid": text.postcode_valid(postcode),
            "postcode_district": text.postcode_district(postcode),
            "birth_band_5y": (F.floor(F.col("birth_year") / 5) * 5).cast("int"),
        }
    ).withColumn("is_active", ~F.coalesce("ceased_flag", F.col("ceased_on").isNotNull()))
    keys = {"person_key": ("forename", "surname", "birth_year", "birth_month"), "person_key_strict": ("forename", "surname", "birth_year", "birth_month", "postcode")}
    return rows.withColumns({k: hashing.person_key(secret, *map(F.col, parts)) if secret else F.lit(None).cast("string") for k, parts in keys.items()})


def governed(records: DataFrame) -> DataFrame:
    """Records without person-derived columns."""
    return records.drop(*GOVERNED_DROPPED, "value", "postcode_raw")


def nature_rows(records: DataFrame) -> DataFrame:
    """record_id, company_number, right_raw, suffix_family, band, core of every distinct nature of every record."""
    each = records.select("record_id", "company_number", "is_active", F.explode(F.array_distinct("natures_of_control")).alias("right_raw"))
    return each.withColumn("n", natures.decompose(F.col("right_raw"))).select("record_id", "company_number", "is_active", "right_raw", "n.suffix_family", "n.band", "n.core")


def date_flags(notified: Column, ceased: Column, birth_year: Column, first_year: int, last_year: int) -> list[Column]:
    """Four checks of a record's dates."""
    return [
        F.coalesce(ceased < notified, F.lit(False)).alias("ceased_before_notified"),
        F.coalesce(notified < F.lit(REGIME_START).cast("date"), F.lit(False)).alias("before_regime"),
        F.coalesce(~F.year(ceased).between(first_year, last_year), F.lit(False)).alias("ceased_year_odd"),
        F.coalesce(F.year(notified) - birth_year < 16, F.lit(False)).alias("under_16"),
    ]


def company_features(records: DataFrame, nature: DataFrame) -> DataFrame:
    """Per company: counts by category and identity checks, sets of codes, strongest bands and information state.

    One aggregation of the records and one of the natures, joined on the company.
    """
    person = F.col("category").isin("individual", "corporate", "legal_person", "super_secure", "bo_individual", "bo_corporate", "bo_legal")
    active = F.col("is_active")
    of = lambda *kinds: F.count_if(F.col("category").isin(*kinds) & active)
    statements = F.array_join(F.array_sort(F.collect_set(F.when((F.col("category") == "statement") & active, F.col("statement")))), ",")
    base = records.where("company_number is not null").groupBy("company_number").agg(
        F.count_if(person).alias("psc_n_records"),
        F.count_if(person & ~active).alias("psc_n_ceased"),
        of("individual", "bo_individual").alias("psc_n_individual"),
        of("corporate", "bo_corporate").alias("psc_n_corporate"),
        of("legal_person", "bo_legal").alias("psc_n_legal_person"),
        of("super_secure").alias("psc_n_super_secure"),
        F.count_if(person & F.col("identity_verified_on").isNotNull()).alias("n_psc_id_verified"),
        F.count_if(person & F.col("verification_due_on").isNotNull() & F.col("identity_verified_on").isNull()).alias("n_psc_id_verification_due"),
        F.count_if(person & F.col("verification_statement_on").isNotNull()).alias("n_psc_id_statement_filed"),
        F.count_if(person & active).alias("__active"),
        F.nullif(statements, F.lit("")).alias("active_psc_statement_codes"),
        F.nullif(F.array_join(F.array_sort(F.collect_list(F.when(F.col("category").isin("corporate", "bo_corporate") & active, F.col("registration_number")))), ","), F.lit("")).alias("psc_corporate_reg_numbers"),
    )
    state = F.when(F.col("__active") > 0, "identified").when(F.col("active_psc_statement_codes").isNotNull(), "statement_only").otherwise("none_reported")
    rank = lambda core: F.max(F.when(F.col("core") == core, natures.band_rank(F.col("band"))))
    held = nature.where("is_active").groupBy("company_number").agg(
        natures.band_of_rank(rank("ownership-of-shares")).alias("psc_max_ownership_band"),
        natures.band_of_rank(rank("voting-rights")).alias("psc_max_voting_band"),
        F.bool_or(F.coalesce(F.col("core") == "right-to-appoint-and-remove", F.lit(False))).alias("psc_has_appointment_rights"),
        F.bool_or(F.coalesce(F.col("core") == natures.ALONE, F.lit(False))).alias("psc_has_significant_influence"),
        F.count_distinct("right_raw").alias("psc_n_distinct_natures"),
        F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(F.col("core").isNull(), F.col("right_raw")))), ","), F.lit("")).alias("psc_unmapped_natures"),
    )
    out = base.withColumn("psc_information_state", state).drop("__active").join(held, "company_number", "left")
    return out.withColumns({"psc_n_distinct_natures": F.coalesce("psc_n_distinct_natures", F.lit(0)), **{c: F.coalesce(c, F.lit(False)) for c in ("psc_has_appointment_rights", "psc_has_significant_influence")}})


def companies_per_person(records: DataFrame, key: str = "person_key", company: str = "company_number") -> DataFrame:
    """Per company the band of its person with the most companies; for private output only."""
    from quillstone.functions.bands import persons

    known = records.where(F.col(key).isNotNull())
    n = known.groupBy(key).agg(F.count_distinct(company).alias("n"))
    most = known.select(key, company).distinct().join(n, key).groupBy(company).agg(F.max("n").alias("n"))
    return most.select(company, persons(F.col("n")).alias("companies_per_person_band"))


def load_report(records: DataFrame) -> DataFrame:
    """category, n, with bad lines, missing kinds, ids and postcodes counted; categories add up to the lines."""
    return records.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("bad_json").alias("n_bad_json"),
        F.count_if(~F.col("bad_json") & F.col("kind").isNull()).alias("n_no_kind"),
        F.count("postcode").alias("n_postcode"),
        F.count_if("postcode_valid").alias("n_postcode_valid"),
        F.count_if("is_active").alias("n_active"),
        (F.count("record_id") - F.count_distinct("record_id")).alias("n_duplicate_ids"),
    )


def kind_year_crosstab(records: DataFrame) -> DataFrame:
    """Records by category and year of notification, active and ceased."""
    return records.groupBy("category", F.year("notified_on").alias("start_year")).agg(F.count_if("is_active").alias("n_active"), F.count_if(~F.col("is_active")).alias("n_ceased"))
