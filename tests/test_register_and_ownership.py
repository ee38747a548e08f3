import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillstone.functions import hashing, identifiers, natures, text
from quillstone.operators import cohort, derive, housekeeping, ownership, register, rules
from quillstone.sources import files

FIELDS = ["CompanyName", "CompanyNumber", "RegAddress.AddressLine1", "RegAddress.PostCode", "CompanyCategory", "CompanyStatus", "IncorporationDate", "Accounts.NextDueDate", "Accounts.LastMadeUpDate", "Accounts.AccountCategory", "ConfStmtNextDueDate", "Mortgages.NumMortCharges", "Mortgages.NumMortOutstanding", "Mortgages.NumMortPartSatisfied", "Mortgages.NumMortSatisfied", *(f"SICCode.SicText_{i}" for i in range(1, 5)), *(f"PreviousName_{i}.CompanyName" for i in range(1, 11))]


def company(number, born, postcode, line, category, due, statement, sic, **more):
    return {"CompanyName": "X", "CompanyNumber": number, "RegAddress.AddressLine1": line, "RegAddress.PostCode": postcode, "CompanyStatus": "Active", "IncorporationDate": born, "Accounts.NextDueDate": due, "Accounts.AccountCategory": category, "ConfStmtNextDueDate": statement, "SICCode.SicText_1": sic, **more}


COMPANIES = [
    company("06110007", "20/09/2015", "QQ3 4RS", "Unit 12, Mill Yard", "SMALL", "30/06/2027", "15/03/2027", "47110 - Retail", **{"Mortgages.NumMortCharges": "6", "Mortgages.NumMortOutstanding": "3", "Mortgages.NumMortPartSatisfied": "2", "Mortgages.NumMortSatisfied": "1", "PreviousName_1.CompanyName": "FIRST", "PreviousName_2.CompanyName": "SECOND"}),
    company("06110018", "03/03/2012", "QQ3 4RS", "Unit 14, Mill Yard", "DORMANT", "31/12/2024", "14/02/2025", "99999 - Dormant"),
    company("06110029", "11/11/2022", "QQ3 4RS", "The Barn", "TOTAL EXEMPTION FULL", "28/02/2027", "", "74990 - Non-trading"),
    company("06110030", "08/08/1998", "WW5 6TT", "77 Canal Side", "NO ACCOUNTS FILED", "08/05/2000", "", "96090 - Other"),
    company("06110041", "30/05/2026", "WW7 8UU", "2 Hill Top", "NO ACCOUNTS FILED", "28/02/2028", "", "01110 - Growing"),
]


def write_register(path: Path, extra: str = "") -> str:
    rows = [",".join(f" {f}" for f in FIELDS)] + [",".join(f'"{c.get(f, "")}"' for f in FIELDS) for c in COMPANIES]
    path.write_text("\n".join(rows) + "\n" + extra)
    return str(path)


def test_register_features(spark, tmp_path):
    got = {r.company_number: r for r in register.features(files.register(spark, write_register(tmp_path / "r.csv")), "2026-08-01", nec_codes=("96090",)).collect()}
    assert set(got) == {c["CompanyNumber"] for c in COMPANIES}
    shop, dormant, idle, old, young = (got[c["CompanyNumber"]] for c in COMPANIES)
    assert [shop.n_charges, shop.n_outstanding, shop.n_part_satisfied, shop.n_satisfied] == [6, 3, 2, 1]
    assert (shop.n_previous_names, shop.sic_section, shop.accounts_overdue) == (2, "G", False)
    assert dormant.accounts_overdue and dormant.confirmation_overdue and dormant.sic_dormant
    assert {r.n_companies_same_postcode for r in (shop, dormant, idle)} == {3}
    assert idle.sic_non_trading and old.sic_nec and not idle.sic_nec
    assert old.accounts_never_filed and not young.accounts_never_filed
    assert "postcode" not in shop.asDict()


def test_malformed_rows_are_set_apart_and_limited(spark, tmp_path):
    good, bad = files.register_with_rejects(spark, write_register(tmp_path / "r.csv", "a,b,c\n\n"))
    assert good.count() == len(COMPANIES) and [r.line for r in bad.collect()] == ["a,b,c"]
    with pytest.raises(ValueError):
        files.register_with_rejects(spark, write_register(tmp_path / "s.csv", "a,b\n" * 6))


NUMBERS = {"1234567.0": ("01234567", "fixed"), "12345678.0": ("12345678", "ok"), " sc 123 ": ("SC000123", "fixed"), "ZZ123456": ("ZZ123456", "ok"), "nan": (None, "invalid"), "": (None, "invalid"), "123456789": (None, "invalid"), None: (None, "invalid")}


def test_company_numbers(spark):
    df = spark.createDataFrame([(k,) for k in NUMBERS], "raw string").select("raw", identifiers.normalise(F.col("raw")).alias("n"), identifiers.lax(F.col("raw")).alias("lax"))
    got = {r.raw: r for r in df.collect()}
    assert {k: (r.n.number, r.n.status) for k, r in got.items()} == NUMBERS
    assert got["12345678.0"].n.note == "stripped trailing .0 (spreadsheet float)"
    assert "unrecognised prefix 'ZZ'" in got["ZZ123456"].n.note
    assert got[" sc 123 "].lax == "SC123" and got[""].lax == "0"
    societies = spark.createDataFrame([("IP00120C",), ("R0000173",), ("SP3COLLS",), ("12345678",), ("XX00120C",)], "s string").select(identifiers.is_society(F.col("s")).alias("y"))
    assert [r.y for r in societies.collect()] == [True, True, True, False, False]


def test_natures_decompose(spark):
    cases = {
        "ownership-of-shares-25-to-50-percent-as-trust": ("as-trust", "25-to-50-percent", "ownership-of-shares"),
        "voting-rights-75-to-100-percent-as-firm-limited-liability-partnership": ("as-firm-limited-liability-partnership", "75-to-100-percent", "voting-rights"),
        "ownership-of-shares-more-than-25-percent-registered-overseas-entity": ("registered-overseas-entity", "more-than-25-percent", "ownership-of-shares"),
        "significant-influence-or-control-as-firm": ("as-firm", None, "significant-influence-or-control"),
        "part-right-to-share-surplus-assets-25-to-50-percent": ("plain", "25-to-50-percent", "part-right-to-share-surplus-assets"),
        "something-new": ("plain", None, None),
    }
    df = spark.createDataFrame([(k,) for k in cases], "c string").select("c", natures.decompose(F.col("c")).alias("n"))
    assert {r.c: (r.n.suffix_family, r.n.band, r.n.core) for r in df.collect()} == cases


def test_keyed_hash_equals_hmac(spark):
    import hashlib
    import hmac

    got = spark.range(1).select(hashing.hmac_sha256(b"key", F.lit("message")).alias("h"), hashing.sha_bucket(F.lit("x")).alias("b")).first()
    assert got.h == hmac.new(b"key", b"message", "sha256").hexdigest()
    assert got.b == int(hashlib.sha256(b"x").hexdigest(), 16) % 100


def test_text_forms(spark):
    one = spark.range(1).select(text.country(F.lit(" England  &  Wales. ")).alias("c"), text.is_uk(F.lit("U.K.")).alias("u"), text.sic_section(F.lit("4")).alias("s"), text.case_type(F.lit("Creditors Voluntary Liquidation")).alias("k"), text.equality_tier(F.lit("1.0"), F.lit("1")).alias("d"), text.equality_tier(F.lit("a  b"), F.lit("a b")).alias("w"), text.value_shape(F.lit("Ann Lee")).alias("n")).first()
    assert tuple(one) == ("england & wales", True, "unknown", "creditors_voluntary_liquidation", "decimal", "collapsed", "name")


def line(number, kind, psc, **data):
    return json.dumps({"company_number": number, "data": {"kind": kind, "links": {"self": f"/company/{number}/psc/{psc}"}, **data}})


def test_ownership_lines_to_features(spark, tmp_path):
    person = {"name_elements": {"forename": "Ann", "surname": "Lee"}, "date_of_birth": {"year": 1981, "month": 2}, "address": {"postal_code": "ab1 2cd"}}
    lines = [
        line("00000001", "individual-person-with-significant-control", "p1", natures_of_control=["ownership-of-shares-25-to-50-percent", "ownership-of-shares-75-to-100-percent-as-trust"], notified_on="2016-04-06", **person),
        line("00000001", "corporate-entity-person-with-significant-control", "p2", natures_of_control=["odd-code"], identification={"registration_number": "SC123456"}, ceased=True, ceased_on="2020-01-01"),
        line("00000002", "individual-person-with-significant-control", "p3", **person),
        line("00000003", "persons-with-significant-control-statement", "s1", statement="psc-exists-but-not-identified"),
        "{broken",
        "",
        json.dumps({"data": {}}),
    ]
    (tmp_path / "psc-snapshot-2026-09-18_1of1.txt").write_text("\n".join(lines) + "\n")
    records = ownership.parse_lines(files.json_lines(spark, str(tmp_path)), b"secret").cache()
    assert records.count() == 6
    report = {r.category: r for r in ownership.load_report(records).collect()}
    assert (report["unknown"].n, report["unknown"].n_bad_json, report["unknown"].n_no_kind) == (2, 1, 1)
    nature = ownership.nature_rows(records)
    got = {r.company_number: r for r in ownership.company_features(records, nature).collect()}
    one = got["00000001"]
    assert (one.psc_n_records, one.psc_n_ceased, one.psc_n_individual, one.psc_n_corporate, one.psc_information_state) == (2, 1, 1, 0, "identified")
    assert (one.psc_max_ownership_band, one.psc_max_voting_band, one.psc_n_distinct_natures, one.psc_unmapped_natures) == ("75-to-100-percent", None, 2, None)
    assert (got["00000003"].psc_information_state, got["00000003"].active_psc_statement_codes) == ("statement_only", "psc-exists-but-not-identified")
    bands = {r.company_number: r.companies_per_person_band for r in ownership.companies_per_person(records).collect()}
    assert bands == {"00000001": "2-10", "00000002": "2-10"}
    assert not set(ownership.governed(records).columns) & {"surname", "postcode", "person_key", "value"}
    row = records.where("psc_id = 'p1'").first()
    assert (row.postcode_district, row.birth_band_5y) == ("AB1", 1980)


def response(number, endpoint, data, status=200):
    return (number, endpoint, status, "2026-08-01T12:00:00Z", json.dumps(data) if data is not None else None)


def test_derive_rules_and_summary(spark):
    rows = [
        response("1", "profile", {"company_name": "A", "company_status": "liquidation", "date_of_creation": "2025-01-15", "links": {"insolvency": "/x", "charges": "/c"}, "accounts": {"next_accounts": {"overdue": True, "due_on": "2026-01-01"}, "overdue": False}, "sic_codes": ["62012", "62020"]}),
        response("1", "insolvency", {"cases": [{"type": "members-voluntary-liquidation"}]}),
        response("1", "psc", None, 404),
        response("1", "psc_statements", {"items": [{"statement": "psc-exists-but-not-identified"}, {"statement": "old", "ceased_on": "2020-01-01"}]}),
        response("2", "profile", {"company_status": "liquidation", "has_insolvency_history": True, "date_of_creation": "2000-01-01"}),
        response("2", "officers", {"items": [{"appointed_on": "2025-01-01"}, {"appointed_on": "2010-01-01", "resigned_on": "2026-01-01"}]}),
        response("2", "psc", {"items": [{"kind": "corporate-entity-beneficial-owner", "natures_of_control": ["voting-rights-50-to-75-percent"], "identification": {"registration_number": "01234567"}}, {"kind": "individual-beneficial-owner", "ceased": True}]}),
        response("2", "psc_statements", {"items": []}),
        response("3", "profile", None, 404),
        response("4", "profile", {"company_status": "dissolved"}),
    ]
    df = spark.createDataFrame(rows, "company_number string, endpoint string, status_code int, fetched_at string, data string").withColumn("fetched_at", F.to_timestamp("fetched_at"))
    records = derive.derive(df).cache()
    got = {r.company_number: r for r in records.collect()}
    assert (got["1"].age_months, got["1"].accounts_overdue, got["1"].sic_codes, got["1"].insolvency_solvent_case_types) == (19, True, "62012,62020", "members-voluntary-liquidation")
    assert (got["1"].psc_fetch_status, got["1"].psc_n_records, got["1"].psc_information_state, got["1"].active_psc_statement_codes) == ("not_found", 0, "statement_only", "psc-exists-but-not-identified")
    assert (got["2"].n_officers_total, got["2"].n_officers_active, got["2"].officer_churn_24m) == (2, 1, 2)
    assert (got["2"].psc_n_records, got["2"].psc_n_ceased, got["2"].psc_n_corporate, got["2"].psc_max_voting_band, got["2"].psc_n_corporate_uk_format_regno, got["2"].psc_information_state) == (2, 1, 1, "50-to-75-percent", 1, "identified")
    assert (got["4"].psc_fetch_status, got["4"].psc_n_records, got["4"].psc_information_state) == ("not_fetched", None, "unknown")
    flagged = rules.flags(rules.partition(records)["screened"], rules.registry(), "company_number", "observed_at")
    assert {(r.company_number, r.rule_id) for r in flagged.collect()} == {("1", "SOLVENT_WINDING_UP"), ("1", "ACCOUNTS_OVERDUE"), ("1", "CHARGES_OUTSTANDING"), ("1", "YOUNG_COMPANY"), ("1", "PSC_UNRESOLVED"), ("2", "STATUS_INSOLVENT"), ("2", "INSOLVENCY_ADVERSE")}
    s = rules.summary(records, flagged, "company_number").first()
    assert (s.n_companies, s.n_not_found, s.n_excluded, s.n_screened, s.n_high, s.n_flagged) == (4, 1, 1, 2, 2, 2)


def test_labels_and_dispositions(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes("Company_Number,company_name,case_type,month_registered,sic07_2_digit,is_bulk\n1,Caf\xe9,Compulsory Liquidation,2015-02,62,N\n00000001,dup,CVA,2015-03,62,N\n2,b,Administration to CVL,2015-02,1,N\n3,c,CVA,2015-02,1,Y\nbad!,d,CVA,2015-02,1,N\n4,e,CVA,62,1,N\n".encode("latin-1"))
    rows = files.labels(spark, str(tmp_path / "l.csv"))
    assert {r.line_no: r.disposition for r in cohort.dispositions(rows).collect()} == dict(enumerate(["kept", "duplicate", "administration_to_cvl", "bulk", "bad_number", "shifted"]))
    kept = cohort.kept_labels(rows).collect()
    assert [(r.company_number, r.case_type, r.sic_section) for r in kept] == [("00000001", "compulsory_liquidation", "J")]


def test_part_sets_and_written_schema(spark, tmp_path):
    names = ["psc-snapshot-2026-09-18_1of2.txt", "psc-snapshot-2026-09-18_2of2.txt", "psc-snapshot-2026-09-17_2of3.txt", "other.txt"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.date: r.complete for r in housekeeping.part_set(df, "name", r"psc-snapshot-(\d{4}-\d{2}-\d{2})_(\d+)of(\d+)").collect()}
    assert got == {"2026-09-18": True, "2026-09-17": False}
    files.write_governed(df.withColumn("surname", F.lit("x")), str(tmp_path / "g"), ("surname",))
    assert spark.read.parquet(str(tmp_path / "g")).columns == ["name"]
    with pytest.raises(ValueError):
        housekeeping.require_columns_absent(df, ("name",))
