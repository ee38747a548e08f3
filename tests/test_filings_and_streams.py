import zipfile

import pytest
from pyspark.sql import functions as F

from quillstone.sources import filings
from quillstone.streaming.restated import restated_stream, windowed_counts

DOC = b"""<html xmlns:ix="http://www.xbrl.org/2013/inlineXBRL"><xbrli:context id="now"><xbrli:period><xbrli:instant>2023-12-31</xbrli:instant></xbrli:period></xbrli:context>
<context id='past'><period><startDate>2022-01-01</startDate><endDate>2022-12-31</endDate></period></context>
<xbrli:context id="m"><xbrli:segment><xbrldi:explicitMember dimension="uk:CreditorsDimension">uk:WithinOneYear</xbrldi:explicitMember></xbrli:segment><xbrli:instant>2023-12-31</xbrli:instant></xbrli:context>
<xbrli:context id="mm"><xbrldi:explicitMember dimension="a">b</xbrldi:explicitMember><xbrldi:explicitMember dimension="c">d</xbrldi:explicitMember><xbrli:instant>2023-12-31</xbrli:instant></xbrli:context>
<xbrli:context id="t"><xbrldi:typedMember dimension="a">b</xbrldi:typedMember><xbrli:instant>2023-12-31</xbrli:instant></xbrli:context>
<xbrli:unit id="gbp"><xbrli:measure>iso4217:GBP</xbrli:measure></xbrli:unit><xbrli:unit id="eur"><xbrli:measure>iso4217:EUR</xbrli:measure></xbrli:unit>
<ix:nonNumeric name="bus:UKCompaniesHouseRegisteredNumber" contextRef="now">00123456</ix:nonNumeric>
<ix:nonFraction name="core:Equity" contextRef="now" unitRef="gbp" scale="3" format="ixt:num-dot-decimal">1,234</ix:nonFraction>
<ix:nonFraction name="core:Equity" contextRef="now" unitRef="gbp" scale="3">1 234</ix:nonFraction>
<ix:nonFraction name="core:Cash" contextRef="past" unitRef="eur" format="ixt:numdotcomma">1.234,5</ix:nonFraction>
<nonFraction name="core:Loss" contextRef="now" unitRef="gbp" sign="-">(7)</nonFraction>
<ix:nonFraction name="core:Debt" contextRef="now" unitRef="gbp">1</ix:nonFraction><ix:nonFraction name="core:Debt" contextRef="now" unitRef="gbp">2</ix:nonFraction>
<ix:nonFraction name="core:Creditors" contextRef="m" unitRef="gbp">30</ix:nonFraction><ix:nonFraction name="core:X" contextRef="mm" unitRef="gbp">1</ix:nonFraction>
<ix:nonFraction name="core:Y" contextRef="t" unitRef="gbp">1</ix:nonFraction><ix:nonFraction name="core:Z" contextRef="gone" unitRef="gbp">1</ix:nonFraction>
<ix:nonFraction name="core:Odd" contextRef="now" unitRef="none" format="ixt:numweird">5</ix:nonFraction><ix:nonFraction name="core:Nil" contextRef="now" unitRef="gbp"/>
<ix:nonFraction name="core:Dash" contextRef="now" unitRef="gbp">-</ix:nonFraction></html>"""


def test_extraction_and_its_accounting():
    f = filings.extract(DOC)
    by = {}
    for x in f.facts:
        by.setdefault(x["concept"], []).append(x)
    assert (by["Equity"][0]["numeric_value"], by["Equity"][0]["status"], by["Equity"][0]["is_current"]) == ("1234000", "selected", 1)
    assert (by["Cash"][0]["numeric_value"], by["Cash"][0]["currency"], by["Cash"][0]["is_current"], by["Cash"][0]["context_kind"]) == ("1234.5", "EUR", 0, "duration")
    assert by["Loss"][0]["numeric_value"] == "-7"
    assert [x["status"] for x in by["Debt"]] == ["conflict_nondimensional"] * 2
    assert (by["Creditors"][0]["dimension"], by["Creditors"][0]["member"]) == ("CreditorsDimension", "WithinOneYear")
    assert by["Odd"][0]["numeric_value"] is None and by["Dash"][0]["raw_value"] == "-"
    c = f.counts
    assert (c["facts_seen"], c["collapsed_duplicate"], c["skipped_multimember"], c["skipped_typed"], c["bad_period_refs"], c["unrecognised_numeric_format"], c["non_gbp_facts"]) == (14, 1, 1, 1, 1, 1, 1)
    assert f.closes() and f.companies == {"00123456"}
    assert filings.extract(b'<html xmlns:q="http://www.xbrl.org/2013/inlineXBRL"></html>').counts["zero_fact_filings"] == 1


@pytest.mark.parametrize(("raw", "scale", "sign", "form", "want"), [("(1,234)", 0, None, None, "-1234"), ("1 234,56", 0, None, "numspacecomma", "1234.56"), ("5", -2, None, None, "0.05"), ("—", 0, None, None, None), ("5", 0, None, "zerodash", None), ("x", 0, None, None, None), ("2", 6, None, None, "2000000")])
def test_numbers(raw, scale, sign, form, want):
    assert filings.number(raw, scale, sign, form) == (want, True)


def test_plain_xbrl():
    doc = b"<xbrl><context id='c'><period><instant>2020-12-31</instant></period></context><unit id='u'><measure>iso4217:GBP</measure></unit><pt:Equity contextRef='c' unitRef='u' decimals='0'>12</pt:Equity><pt:Name contextRef='c'>A</pt:Name></xbrl>"
    assert [(x["concept"], x["numeric_value"], x["fact_kind"]) for x in filings.extract(doc, "xml").facts] == [("Equity", "12", "numeric"), ("Name", None, "non-numeric")]


def test_archives_are_read_in_ranges_of_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "Accounts_Monthly_Data-January2024.zip", "w") as z:
        for i in range(5):
            z.writestr(f"Prod1_2301_0012345{i}_20231231.html", DOC)
        z.writestr("readme.txt", "no")
    members = filings.read_archives(spark, f"{tmp_path}/*.zip", 2)
    assert members.rdd.getNumPartitions() == 3
    rows = members.select("source_year", "source_month", "company", "made_up_to_date").distinct().collect()
    assert len(rows) == 5 and {tuple(r)[:2] for r in rows} == {(2024, 1)} and {r.made_up_to_date for r in rows} == {"2023-12-31"}
    facts = filings.facts(members, ["Equity", "Cash"])
    assert facts.count() == 10
    assert filings.integrity(members).selectExpr("sum(facts_seen) AS s", "sum(company_mismatch) AS m").first() == (70, 5)


def test_restatement_stream(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([("a", "1"), ("b", "1")], "k string, v string").coalesce(1).write.parquet(str(src))
    spark.createDataFrame([("a", "2"), ("b", "1")], "k string, v string").coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema("k string, v string").option("maxFilesPerTrigger", 1).parquet(str(src))
    q = restated_stream(stream, ["k"], "v").writeStream.outputMode("update").format("memory").queryName("restated").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r.k, r.differs) for r in spark.sql("SELECT * FROM restated WHERE n = 2").collect()} == {("a", True), ("b", False)}


def test_windowed_counts_stream(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet("/root/testdata/sf0.001/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    q = windowed_counts(stream, "ts", "event_type", "value").writeStream.outputMode("complete").format("memory").queryName("windowed").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT sum(n) FROM windowed").first()[0] == events.count()
