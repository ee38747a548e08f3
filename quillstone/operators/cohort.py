"""Labels, cohorts and lead time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import dates, identifiers, text


def dispositions(labels: DataFrame, line: str = "line_no") -> DataFrame:
    """labels with number and disposition, one each: bulk, administration_to_cvl, bad_number, shifted, duplicate or kept.

    Of a company's usable rows the first by line is kept; the order of tests is that of the names.
    """
    rows = labels.withColumn("__n", identifiers.normalise(F.col("company_number"))).withColumn("number", F.col("__n.number")).drop("__n")
    first = (
        F.when(F.upper(F.trim("is_bulk")) == "Y", "bulk")
        .when(F.lower(F.trim("case_type")) == "administration to cvl", "administration_to_cvl")
        .when(F.col("number").isNull(), "bad_number")
        .when(~F.coalesce(F.trim("month_registered").rlike(r"^\d{4}-\d{2}$"), F.lit(False)), "shifted")
    )
    rows = rows.withColumn("__d", first)
    keep = rows.where("__d is null").groupBy("number").agg(F.min(line).alias("__first"))
    out = rows.join(keep, "number", "left")
    return out.withColumn("disposition", F.coalesce("__d", F.when(F.col(line) == F.col("__first"), "kept").otherwise("duplicate"))).drop("__d", "__first")


def kept_labels(labels: DataFrame, line: str = "line_no") -> DataFrame:
    """company_number, case_type, raw_case_type, sic_section, month_registered of the kept rows."""
    rows = dispositions(labels, line).where("disposition = 'kept'")
    return rows.select(F.col("number").alias("company_number"), text.case_type(F.col("case_type")).alias("case_type"), F.col("case_type").alias("raw_case_type"), text.sic_section(F.col("sic07_2_digit")).alias("sic_section"), "month_registered")


def lead_time(cases: DataFrame, facts: DataFrame, key: str, event: str, at: str, leads: list[int], cutoff: Column) -> DataFrame:
    """The last fact of each case known at its cut-off, for every lead: key, lead, at, and the facts' columns.

    cutoff makes a case's cut-off from its columns event and lead. A case without such a fact
    is in the result with nulls.
    """
    from functools import reduce

    rows = cases.select(key, event, F.explode(F.array(*map(F.lit, leads))).alias("lead")).withColumn("cutoff", cutoff)
    met = rows.join(facts, key).where(F.col(at) <= F.col("cutoff"))
    extra = [c for c in facts.columns if c != key]
    last = met.groupBy(key, event, "lead", "cutoff").agg(F.max_by(F.struct(*extra), F.struct(at, *[c for c in extra if c != at])).alias("f"))
    return rows.join(reduce(lambda d, c: d.withColumn(c, F.col(f"f.{c}")), extra, last).drop("f"), [key, event, "lead", "cutoff"], "left")


def lead_summary(joined: DataFrame, by: list[str], seen: str, columns: list[str]) -> DataFrame:
    """Cases, those observed, and quartiles of columns per group."""
    q = [F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(c) for c in columns]
    out = joined.groupBy(*by).agg(F.count(F.lit(1)).alias("n_cases"), F.count(seen).alias("n_observed"), *q)
    return out.select(*by, "n_cases", "n_observed", *(F.get(c, F.lit(i)).alias(f"{c}_{n}") for c in columns for i, n in enumerate(("q25", "median", "q75"))))


def label_cohort(companies: DataFrame, status: str, cases: tuple[str, ...], comparisons: tuple[str, ...]) -> DataFrame:
    """companies with cohort: case, comparison or other, by lower-case trimmed status."""
    s = F.lower(F.trim(status))
    return companies.withColumn("cohort", F.when(s.isin(*cases), "case").when(s.isin(*comparisons), "comparison").otherwise("other"))


def excluding(companies: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """companies whose key isn't among those excluded; rows without a key stay, and null or repeated exclusions change nothing."""
    return companies.join(excluded.select(key), key, "left_anti").select(*companies.columns)


def control_strata(register: DataFrame, reference: str) -> DataFrame:
    """Active companies with stratum section|age band."""
    day = F.lit(reference).cast("date")
    age = dates.age_band_days(F.datediff(day, dates.uk_date(F.col("IncorporationDate"))))
    rows = register.where(F.lower(F.trim("CompanyStatus")).isin("active"))
    return rows.withColumn("stratum", F.concat_ws("|", text.sic_section(text.sic_leading_digits(F.col("`SICCode.SicText_1`"))), age))


def evaluation(rows: DataFrame, case: Column, flagged: Column, by: list[str]) -> DataFrame:
    """Cases and controls flagged and not, recall among cases and rate among controls, per group."""
    out = rows.groupBy(*by).agg(F.count_if(case).alias("n_cases"), F.count_if(case & flagged).alias("n_cases_flagged"), F.count_if(~case).alias("n_controls"), F.count_if(~case & flagged).alias("n_controls_flagged"))
    return out.withColumns({"recall": F.try_divide(F.col("n_cases_flagged").cast("double"), F.nullif(F.col("n_cases"), F.lit(0))), "control_rate": F.try_divide(F.col("n_controls_flagged").cast("double"), F.nullif(F.col("n_controls"), F.lit(0)))})


def first_per(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row per key by an order; a rank alone, so that Spark can cut each task's rows before the shuffle."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__r = 1").drop("__r")
