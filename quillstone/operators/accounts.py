"""Accounts: facts to wide cells with provenance, restatement, reconciliation, and features known at a reference month.

Wide rows are one per (company, period_end). A month is YYYYMM; a row is known at month T if row_available_yyyymm <= T.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import bands, dates
from quillstone.functions.identifiers import join_key

#: A prior period further back than this many months gives no differences.
MAX_GAP_MONTHS = 18
#: Periods before this date aren't plausible.
FIRST_PERIOD = "2010-01-01"
#: Raw values that declare a nil.
DASHES = ("-", "–", "—")
#: The employee count, which has no currency.
EMPLOYEES = "AverageNumberEmployeesDuringPeriod"


@dataclass(frozen=True)
class Cell:
    """A wide column: a concept's total, or one member of a dimension."""

    name: str
    concept: str
    dimension: str | None = None
    member: str | None = None

    def holds(self) -> Column:
        side = lambda c, v: F.col(c).isNull() if v is None else F.col(c) == v
        return (F.col("concept") == self.concept) & side("dimension", self.dimension) & side("member", self.member)


def check_cells(cells: list[Cell], concepts: set[str]) -> None:
    """Names must be unique and concepts known."""
    names = [c.name for c in cells]
    if len(set(names)) < len(names):
        raise ValueError("duplicate wide columns")
    if unknown := {c.concept for c in cells} - concepts:
        raise ValueError(f"unknown concepts: {sorted(unknown)}")


def usable(facts: DataFrame) -> DataFrame:
    """Selected facts in pounds, or employee counts, with a value; a dash is 0. Adds value_text."""
    value = F.when(F.trim("raw_value").isin(*DASHES), "0").otherwise(F.col("numeric_value"))
    currency = (F.col("currency") == "GBP") | (F.col("concept") == EMPLOYEES)
    return facts.withColumn("value_text", value).where((F.col("status") == "selected") & currency & F.col("value_text").isNotNull())


def selected_cells(facts: DataFrame, cells: list[Cell], policy: str) -> DataFrame:
    """The fact that fills each (company, period_end, wide_column) under a policy, with its filing.

    latest: the last filing by (year, month, member); as_first_reported: the first, among facts of their own filing's period.
    One aggregation with map-side combining picks the filing; no window.
    """
    rows = usable(facts)
    if policy == "as_first_reported":
        rows = rows.where("is_current = 1")
    elif policy != "latest":
        raise ValueError(policy)
    name = reduce(lambda acc, c: acc.when(c.holds(), c.name), cells[1:], F.when(cells[0].holds(), cells[0].name))
    rows = rows.withColumn("wide_column", name).where("wide_column is not null")
    order = F.struct("source_year", "source_month", "source_member", "source_archive", "value_text")
    held = F.struct(F.col("value_text").try_cast("double").alias("value"), "unit", "source_year", "source_month", "source_archive", "source_member", "made_up_to_date")
    pick = (F.max_by if policy == "latest" else F.min_by)(held, order)
    return rows.groupBy("company", "period_end", "wide_column").agg(pick.alias("cell")).select("company", "period_end", "wide_column", "cell.*")


def widen(selected: DataFrame, cells: list[Cell]) -> DataFrame:
    """One row per (company, period_end): a column per cell, counts, the month from which the row is known, and the unit flag.

    employees_unit_anomaly is 1 where the employee count was filed in pounds.
    """
    columns = [F.max(F.when(F.col("wide_column") == c.name, F.col("value"))).alias(c.name) for c in cells]
    employees = next((c.name for c in cells if c.concept == EMPLOYEES), None)
    anomaly = F.max(F.when((F.col("wide_column") == F.lit(employees)) & F.col("unit").contains("GBP"), 1).otherwise(0)).alias("employees_unit_anomaly")
    return selected.groupBy("company", "period_end").agg(
        *columns,
        anomaly,
        F.count(F.lit(1)).alias("n_concepts_present"),
        F.count_distinct(F.struct("source_archive", "source_member")).alias("n_source_filings"),
        F.max(F.col("source_year") * 100 + F.col("source_month")).alias("row_available_yyyymm"),
    )


def provenance(selected: DataFrame) -> DataFrame:
    """The filing behind each cell."""
    return selected.select("company", "period_end", "wide_column", "source_year", "source_month", "source_member", "made_up_to_date")


def restatement(rows: DataFrame, key: list[str], value: str, by: list[str], first_seen: Column | None = None) -> DataFrame:
    """n_keys, n_repeated, n_disagree and share by `by`: keys seen twice or more, and those whose values aren't all the same text.

    Values differ from the first exactly when least and greatest differ, so no order and no window is needed. With first_seen,
    keys are also grouped by its least value, first_seen_year.
    """
    extra = [] if first_seen is None else [F.min(first_seen).alias("first_seen_year")]
    per_key = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), *extra)
    groups = [*by, *(["first_seen_year"] if extra else [])]
    repeated, differs = F.col("n") >= 2, (F.col("n") >= 2) & (F.col("low") != F.col("high"))
    out = per_key.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(repeated).alias("n_repeated"), F.count_if(differs).alias("n_disagree"))
    return out.withColumn("share", F.try_divide(F.col("n_disagree").cast("double"), F.nullif(F.col("n_repeated"), F.lit(0))))


def reconcile(totals: DataFrame, parts: DataFrame, key: list[str], by: list[str], relative: float = 1e-6, least: float = 1.0) -> DataFrame:
    """Totals (key, total) against summed parts (key, part): pairs, agreements within max(least, relative * |total|), share, median difference."""
    sums = parts.groupBy(*key).agg(F.sum("part").alias("parts"))
    off = F.abs(F.col("total") - F.col("parts"))
    both = totals.join(sums, key).withColumn("off", off)
    ok = F.count_if(F.col("off") <= F.greatest(F.lit(least), F.abs("total") * relative))
    out = both.groupBy(*by).agg(F.count(F.lit(1)).alias("n_pairs"), ok.alias("n_agree"), F.median("off").alias("median_difference"))
    return out.withColumn("share_agree", F.col("n_agree").cast("double") / F.col("n_pairs"))


def maturity_buckets(rows: DataFrame, total: Column, within: Column, after: Column, relative: float = 1e-6, least: float = 1.0) -> DataFrame:
    """Counts and shares of incomplete, match, sign_flip and other for totals against two maturities."""
    room = F.greatest(F.lit(least), F.abs(total) * relative)
    bucket = (
        F.when(total.isNull() | within.isNull() | after.isNull(), "incomplete")
        .when(F.abs(total - (within + after)) <= room, "match")
        .when(F.abs(total + (within + after)) <= room, "sign_flip")
        .otherwise("other")
    )
    counted = rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.col("n").cast("double") / F.sum("n").over(Window.partitionBy()))


def _known(month: Column, period: Column, first_period: str) -> Column:
    """Whether a row is known at a month and of a plausible period: from first_period to the end of the year after the month's."""
    last = F.make_date(F.floor(month / 100).cast("int") + 1, F.lit(12), F.lit(31))
    return (F.col("row_available_yyyymm") <= month) & (period >= F.lit(first_period).cast("date")) & (period <= last)


MEASURES = {"Equity": "equity", "CurrentAssets": "current_assets", "creditors_within_one_year": "creditors_within_one_year", "NetCurrentAssetsLiabilities": "net_current_assets", "CashBankOnHand": "cash", EMPLOYEES: "employees"}


def _latest_and_prior(ranked: DataFrame, key: list[str]) -> DataFrame:
    """Rows ranked 1 and 2 side by side, by one aggregation; n_periods counts all of the key's rows."""
    at = lambda n, c: F.max(F.when(F.col("rn") == n, F.col(c)))
    names = [*MEASURES.values(), "employees_unit_anomaly"]
    return ranked.groupBy(*key).agg(
        at(1, "pe").alias("pe"), at(2, "pe").alias("prior_pe"), F.count(F.lit(1)).alias("n_periods_available"), *(at(1, c).alias(c) for c in names), *(at(2, c).alias(f"p_{c}") for c in ("equity", "net_current_assets", "cash"))
    )


def _project(pair: DataFrame, month: Column, category: Column, lead: list[str]) -> DataFrame:
    gap = dates.whole_months(F.col("pe"), F.col("prior_pe"))
    change = lambda c: F.when(gap <= MAX_GAP_MONTHS, F.col(c) - F.col(f"p_{c}"))
    return pair.select(
        *lead,
        F.col("pe").alias("latest_period_end"),
        F.col("prior_pe").alias("prior_period_end"),
        "n_periods_available",
        dates.months_since(month, F.col("pe")).alias("months_since_latest_period_end"),
        gap.alias("prior_gap_months"),
        "equity",
        "current_assets",
        "creditors_within_one_year",
        "net_current_assets",
        "cash",
        (F.col("equity") < 0).alias("negative_equity"),
        (F.col("net_current_assets") < 0).alias("net_current_liabilities"),
        F.try_divide("current_assets", F.nullif(F.col("creditors_within_one_year"), F.lit(0.0))).alias("current_ratio"),
        bands.employees(F.col("employees")).alias("employee_band"),
        "employees_unit_anomaly",
        change("equity").alias("d_equity"),
        change("net_current_assets").alias("d_net_current_assets"),
        change("cash").alias("d_cash"),
        category.alias("accounts_category"),
    )


def _measured(wide: DataFrame) -> list[Column]:
    return [F.col(f"`{k}`").alias(v) for k, v in MEASURES.items()] + [F.col("employees_unit_anomaly")]


def features(wide: DataFrame, register: DataFrame, month: int, first_period: str = FIRST_PERIOD) -> DataFrame:
    """Per company the latest and prior period known at a month, with ratios, bands and changes; the category from the register."""
    t = F.lit(month)
    known = wide.where(_known(t, dates.iso_date(F.col("period_end").cast("string")), first_period)).select(join_key(F.col("company")).alias("company"), F.col("period_end").cast("date").alias("pe"), *_measured(wide))
    ranked = known.withColumn("rn", F.row_number().over(Window.partitionBy("company").orderBy(F.col("pe").desc())))
    pair = _latest_and_prior(ranked, ["company"])
    listed = register.select(join_key(F.col("CompanyNumber")).alias("company"), F.col("`Accounts.AccountCategory`").alias("category")).where("company <> ''")
    return _project(pair.join(listed, "company", "left"), t, F.col("category"), [F.col("company").alias("company_number")])


def assign(observations: DataFrame, wide: DataFrame, company: str, date: str, policy: str = "previous_month", registers: list[tuple[str, DataFrame]] = (), first_period: str = FIRST_PERIOD) -> DataFrame:
    """observations with the accounts features known at each row's own reference month, never later.

    policy: previous_month (what the month before the row's date closed with) or same_month. registers: dated snapshots of
    (company_number, accounts_category); the last on or before the row's date counts, and none further back. Existing columns
    of the same names are an error. Features are made once per company and month and joined back, so rows need no id.
    """
    if policy not in ("previous_month", "same_month"):
        raise ValueError(policy)
    added = {"reference_month", "has_accounts", *(f.name for f in _project(_empty(observations), F.lit(200001), F.lit(""), []).schema)}
    if clash := added & set(observations.columns):
        raise ValueError(f"columns exist: {sorted(clash)}")
    day = F.col(date).cast("date")
    month = dates.yyyymm(day)
    rows = observations.withColumn("__company", join_key(F.col(company))).withColumn("reference_month", month if policy == "same_month" else dates.previous_month(month))
    facts = wide.select(join_key(F.col("company")).alias("__company"), dates.iso_date(F.col("period_end").cast("string")).alias("pe"), "row_available_yyyymm", *_measured(wide))
    key = ["__company", "reference_month"]
    met = rows.select(*key).distinct().join(facts, "__company").where(_known(F.col("reference_month"), F.col("pe"), first_period))
    ranked = met.withColumn("rn", F.row_number().over(Window.partitionBy(*key).orderBy(F.col("pe").desc())))
    pair = _latest_and_prior(ranked, key)
    out = rows.join(_project(pair, F.col("reference_month"), F.lit(None).cast("string"), key).drop("accounts_category"), key, "left").withColumn("has_accounts", F.col("latest_period_end").isNotNull())
    if not registers:
        return out.withColumn("accounts_category", F.lit(None).cast("string")).drop("__company")
    from quillstone.operators.asof import snapshot_date

    dated = reduce(DataFrame.unionByName, [df.select(F.lit(d).cast("date").alias("__snapshot"), join_key(F.col("company_number")).alias("__company"), "accounts_category") for d, df in registers])
    out = out.withColumn("__snapshot", snapshot_date([d for d, _ in registers], day))
    return out.join(dated, ["__snapshot", "__company"], "left").drop("__company", "__snapshot")


def _empty(observations: DataFrame) -> DataFrame:
    kinds = {"pe": "date", "prior_pe": "date", "n_periods_available": "long", "employees_unit_anomaly": "int", **{v: "double" for v in MEASURES.values()}, "p_equity": "double", "p_net_current_assets": "double", "p_cash": "double"}
    return observations.sparkSession.createDataFrame([], ", ".join(f"{k} {v}" for k, v in kinds.items()))


def date_reconciliation(register: DataFrame, latest: DataFrame) -> DataFrame:
    """Register dates (company, register_date) against accounts dates (company, accounts_date): six buckets that add up to all rows."""
    both = register.join(latest.withColumn("__there", F.lit(True)), "company", "left")
    a, b = F.col("register_date"), F.col("accounts_date")
    missing = F.col("__there").isNull()
    n = lambda c, name: F.count_if(c).alias(name)
    out = both.agg(
        F.count(F.lit(1)).alias("n_register"),
        n(missing & a.isNull(), "neither"),
        n(missing & a.isNotNull(), "register_only"),
        n(~missing & a.isNull(), "accounts_only"),
        n(~missing & (a == b), "equal"),
        n(~missing & (a > b), "register_later"),
        n(~missing & a.isNotNull() & (b.isNull() | (a < b)), "accounts_later"),
    )
    return out.withColumn("rate_equal", F.try_divide(F.col("equal").cast("double"), F.nullif(F.col("equal") + F.col("register_later") + F.col("accounts_later"), F.lit(0))))
