"""Queries of the library's operators over the driver's tables, with their DuckDB SQL.

The tables hold no companies, so each operator runs on an analogue: a company is a customer, supplier or user; a period an
order date; the month from which a row is known its year and month; the register is the customer table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.functions import bands, dates, hashing, identifiers, natures, text
from quillstone.operators import accounts, asof, cohort, evaluate, housekeeping, inventory, ownership, population, register, rules, sampling

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- accounts -------------------------------------------------------------------------------------------------------

T = 199806


def _wide(spark: SparkSession, d: str) -> DataFrame:
    """orders as wide accounts: one row per customer and order date, the largest order of the day."""
    o = table(spark, d, "orders")
    day = F.to_date("o_orderdate")
    one = o.groupBy(F.col("o_custkey").cast("string").alias("company"), day.alias("period_end")).agg(F.max_by("o_totalprice", F.struct("o_totalprice", "o_orderkey")).alias("v"), F.max("o_orderkey").alias("k"))
    v = F.col("v")
    return one.select(
        "company",
        F.date_format("period_end", "yyyy-MM-dd").alias("period_end"),
        dates.add_months(dates.yyyymm(F.col("period_end")), 2).alias("row_available_yyyymm"),
        (v - 250000).alias("Equity"),
        v.alias("CurrentAssets"),
        F.when(F.col("k") % 5 != 0, F.col("k").cast("double")).alias("creditors_within_one_year"),
        (v - 200000).alias("NetCurrentAssetsLiabilities"),
        (v / 2).alias("CashBankOnHand"),
        (F.col("k") % 300).cast("double").alias("AverageNumberEmployeesDuringPeriod"),
        (F.col("k") % 2).cast("int").alias("employees_unit_anomaly"),
    )


_WIDE_SQL = """one AS (
  SELECT CAST(o_custkey AS VARCHAR) AS company, CAST(o_orderdate AS DATE) AS pe, max(o_totalprice) AS v, max(o_orderkey) AS k FROM orders GROUP BY 1, 2
), wide AS (
  SELECT company, pe, v, k, year(pe + INTERVAL 2 MONTH) * 100 + month(date_trunc('month', pe) + INTERVAL 2 MONTH) AS m0,
    (year(date_trunc('month', pe) + INTERVAL 2 MONTH) * 100 + month(date_trunc('month', pe) + INTERVAL 2 MONTH)) AS avail,
    v - 250000 AS equity, CASE WHEN k % 5 <> 0 THEN CAST(k AS DOUBLE) END AS creditors, v - 200000 AS nca, v / 2 AS cash, CAST(k % 300 AS DOUBLE) AS employees, CAST(k % 2 AS INTEGER) AS anomaly FROM one
)"""


#: The driver's dates begin before the production bound of plausible periods.
_FIRST = "1992-01-01"

_FEATURES_SQL = """l.pe AS latest_period_end, p.pe AS prior_period_end, l.n AS n_periods_available,
  ({ref_y} - year(l.pe)) * 12 + {ref_m} - month(l.pe) AS months_since_latest_period_end,
  (year(l.pe) - year(p.pe)) * 12 + month(l.pe) - month(p.pe) AS prior_gap_months,
  l.equity, l.v AS current_assets, l.creditors AS creditors_within_one_year, l.nca AS net_current_assets, l.cash, l.equity < 0 AS negative_equity, l.nca < 0 AS net_current_liabilities,
  CASE WHEN l.creditors IS NOT NULL AND l.creditors <> 0 THEN l.v / l.creditors END AS current_ratio,
  CASE WHEN l.employees IS NULL THEN NULL WHEN l.employees <= 0 THEN '0' WHEN l.employees <= 10 THEN '1-10' WHEN l.employees <= 50 THEN '11-50' WHEN l.employees <= 250 THEN '51-250' WHEN l.employees > 250 THEN '251+' END AS employee_band,
  l.anomaly AS employees_unit_anomaly,
  CASE WHEN (year(l.pe) - year(p.pe)) * 12 + month(l.pe) - month(p.pe) <= 18 THEN l.equity - p.equity END AS d_equity,
  CASE WHEN (year(l.pe) - year(p.pe)) * 12 + month(l.pe) - month(p.pe) <= 18 THEN l.nca - p.nca END AS d_net_current_assets,
  CASE WHEN (year(l.pe) - year(p.pe)) * 12 + month(l.pe) - month(p.pe) <= 18 THEN l.cash - p.cash END AS d_cash"""


@query(
    "ac01_accounts_features",
    f"""WITH {_WIDE_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY company ORDER BY pe DESC) AS rn, count(*) OVER (PARTITION BY company) AS n FROM wide
  WHERE avail <= {T} AND pe BETWEEN DATE '1992-01-01' AND DATE '1999-12-31')
SELECT l.company AS company_number, {_FEATURES_SQL.format(ref_y=T // 100, ref_m=T % 100)}, c.c_mktsegment AS accounts_category
FROM (SELECT * FROM ranked WHERE rn = 1) l LEFT JOIN (SELECT * FROM ranked WHERE rn = 2) p USING (company) LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = l.company""",
)
def ac01(spark: SparkSession, d: str) -> DataFrame:
    reg = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("CompanyNumber"), F.col("c_mktsegment").alias("Accounts.AccountCategory"))
    return accounts.features(_wide(spark, d), reg, T, _FIRST)


@query(
    "jn04_row_assignment",
    f"""WITH {_WIDE_SQL}, obs AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS company, CAST(ts AS DATE) - INTERVAL 25 YEAR AS day FROM events
), obs2 AS (
  SELECT *, year(date_trunc('month', day) - INTERVAL 1 MONTH) * 100 + month(date_trunc('month', day) - INTERVAL 1 MONTH) AS ref FROM obs
), ranked AS (
  SELECT o.event_id, o.ref, w.*, row_number() OVER (PARTITION BY event_id ORDER BY pe DESC) AS rn, count(*) OVER (PARTITION BY event_id) AS n
  FROM obs2 o JOIN wide w USING (company) WHERE w.avail <= o.ref AND w.pe >= DATE '1992-01-01' AND w.pe <= make_date(CAST(o.ref // 100 + 1 AS INTEGER), 12, 31)
)
SELECT o.event_id, o.company, o.ref AS reference_month, l.company IS NOT NULL AS has_accounts, {_FEATURES_SQL.format(ref_y="(o.ref // 100)", ref_m="(o.ref % 100)")}, CAST(NULL AS VARCHAR) AS accounts_category
FROM obs2 o LEFT JOIN (SELECT * FROM ranked WHERE rn = 1) l USING (event_id) LEFT JOIN (SELECT * FROM ranked WHERE rn = 2) p USING (event_id)""",
)
def jn04(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    obs = e.select("event_id", F.col("user_id").cast("string").alias("company"), F.add_months(F.to_date("ts"), -300).alias("day"))
    return accounts.assign(obs, _wide(spark, d), "company", "day", first_period=_FIRST).drop("day")


def _facts(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as long facts: supplier, ship month end, return flag as concept, line status as member."""
    li = table(spark, d, "lineitem")
    day = F.to_date("l_shipdate")
    return li.select(
        F.col("l_suppkey").cast("string").alias("company"),
        F.date_format(F.last_day(day), "yyyy-MM-dd").alias("period_end"),
        F.concat(F.lit("Concept"), "l_returnflag").alias("concept"),
        F.when(F.col("l_linenumber") > 3, "Status").alias("dimension"),
        F.when(F.col("l_linenumber") > 3, F.col("l_linestatus")).alias("member"),
        F.when(F.col("l_tax") > 0.07, "EUR").otherwise("GBP").alias("currency"),
        F.lit("GBP").alias("unit"),
        F.when(F.col("l_discount") > 0.08, "conflict").otherwise("selected").alias("status"),
        F.when(F.col("l_quantity") == 1, "-").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("raw_value"),
        F.when(F.col("l_quantity") != 1, F.col("l_quantity").cast("int").cast("string")).alias("numeric_value"),
        F.year("l_shipdate").alias("source_year"),
        F.month("l_shipdate").alias("source_month"),
        F.concat(F.lit("a"), F.col("l_orderkey") % 7).alias("source_archive"),
        F.concat(F.lit("m"), F.col("l_orderkey")).alias("source_member"),
        F.lit(None).cast("string").alias("made_up_to_date"),
        (F.col("l_linenumber") % 2).alias("is_current"),
    )


_FACTS_SQL = """facts AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS company, strftime(last_day(CAST(l_shipdate AS DATE)), '%Y-%m-%d') AS period_end, 'Concept' || l_returnflag AS concept,
    CASE WHEN l_linenumber > 3 THEN 'Status' END AS dimension, CASE WHEN l_linenumber > 3 THEN l_linestatus END AS member, CASE WHEN l_tax > 0.07 THEN 'EUR' ELSE 'GBP' END AS currency,
    CASE WHEN l_discount > 0.08 THEN 'conflict' ELSE 'selected' END AS status, CASE WHEN l_quantity = 1 THEN '0' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS vtext,
    year(l_shipdate) AS sy, month(l_shipdate) AS sm, 'a' || (l_orderkey % 7) AS archive, 'm' || l_orderkey AS filing, l_linenumber % 2 AS is_current
  FROM lineitem
), named AS (
  SELECT *, CASE WHEN concept = 'ConceptA' AND dimension IS NULL THEN 'a' WHEN concept = 'ConceptN' AND dimension IS NULL THEN 'n' WHEN concept = 'ConceptR' AND dimension = 'Status' AND member = 'O' THEN 'r_open' END AS wide_column
  FROM facts WHERE status = 'selected' AND currency = 'GBP'
)"""
_CELLS = [accounts.Cell("a", "ConceptA"), accounts.Cell("n", "ConceptN"), accounts.Cell("r_open", "ConceptR", "Status", "O")]


def _pivot_sql(policy: str) -> str:
    way, only = ("DESC", "") if policy == "latest" else ("ASC", "AND is_current = 1")
    return f"""WITH {_FACTS_SQL}, picked AS (
  SELECT * FROM named WHERE wide_column IS NOT NULL {only}
  QUALIFY row_number() OVER (PARTITION BY company, period_end, wide_column ORDER BY sy {way}, sm {way}, filing {way}, archive {way}, vtext {way}) = 1
) SELECT company, period_end, max(CASE WHEN wide_column = 'a' THEN CAST(vtext AS DOUBLE) END) AS a, max(CASE WHEN wide_column = 'n' THEN CAST(vtext AS DOUBLE) END) AS n,
  max(CASE WHEN wide_column = 'r_open' THEN CAST(vtext AS DOUBLE) END) AS r_open, 0 AS employees_unit_anomaly, count(*) AS n_concepts_present, count(DISTINCT (archive, filing)) AS n_source_filings,
  max(sy * 100 + sm) AS row_available_yyyymm FROM picked GROUP BY 1, 2"""


@query("agg01_pivot_latest", _pivot_sql("latest"))
def agg01(spark: SparkSession, d: str) -> DataFrame:
    return accounts.widen(accounts.selected_cells(_facts(spark, d), _CELLS, "latest"), _CELLS)


@query("agg01_pivot_first_reported", _pivot_sql("as_first_reported"))
def agg01_first(spark: SparkSession, d: str) -> DataFrame:
    return accounts.widen(accounts.selected_cells(_facts(spark, d), _CELLS, "as_first_reported"), _CELLS)


@query(
    "agg02_provenance",
    f"""WITH {_FACTS_SQL} SELECT company, period_end, wide_column, sy AS source_year, sm AS source_month, filing AS source_member, CAST(NULL AS VARCHAR) AS made_up_to_date FROM named WHERE wide_column IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY company, period_end, wide_column ORDER BY sy DESC, sm DESC, filing DESC, archive DESC, vtext DESC) = 1""",
)
def agg02(spark: SparkSession, d: str) -> DataFrame:
    return accounts.provenance(accounts.selected_cells(_facts(spark, d), _CELLS, "latest"))


@query(
    "agg03_restatement",
    """WITH v AS (SELECT l_partkey, l_suppkey, l_returnflag, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q FROM lineitem),
k AS (SELECT l_partkey, l_suppkey, l_returnflag, count(*) AS n, count(DISTINCT q) AS d FROM v GROUP BY ALL)
SELECT l_returnflag, count(*) AS n_keys, count(*) FILTER (n >= 2) AS n_repeated, count(*) FILTER (n >= 2 AND d > 1) AS n_disagree,
  CASE WHEN count(*) FILTER (n >= 2) > 0 THEN count(*) FILTER (n >= 2 AND d > 1) * 1.0::DOUBLE / count(*) FILTER (n >= 2) END AS share FROM k GROUP BY 1""",
)
def agg03(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("q", F.col("l_quantity").cast("int").cast("string"))
    return accounts.restatement(rows, ["l_partkey", "l_suppkey", "l_returnflag"], "q", ["l_returnflag"])


@query(
    "agg04_restatement_by_year",
    """WITH k AS (SELECT l_partkey, l_returnflag, count(*) AS n, count(DISTINCT CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)) AS d, min(year(l_shipdate)) AS first_seen_year FROM lineitem GROUP BY 1, 2)
SELECT first_seen_year, count(*) AS n_keys, count(*) FILTER (n >= 2) AS n_repeated, count(*) FILTER (n >= 2 AND d > 1) AS n_disagree,
  CASE WHEN count(*) FILTER (n >= 2) > 0 THEN count(*) FILTER (n >= 2 AND d > 1) * 1.0::DOUBLE / count(*) FILTER (n >= 2) END AS share FROM k GROUP BY 1""",
)
def agg04(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("q", F.col("l_quantity").cast("int").cast("string"))
    return accounts.restatement(rows, ["l_partkey", "l_returnflag"], "q", [], F.year("l_shipdate"))


@query(
    "agg06_reconciliation",
    """WITH s AS (SELECT l_orderkey, sum(l_extendedprice) AS parts FROM lineitem GROUP BY 1), b AS (
  SELECT o_orderpriority, o_totalprice AS total, parts, abs(o_totalprice - parts) AS off FROM orders JOIN s ON l_orderkey = o_orderkey)
SELECT o_orderpriority, count(*) AS n_pairs, count(*) FILTER (off <= greatest(1.0, abs(total) * 0.2)) AS n_agree, median(off) AS median_difference,
  count(*) FILTER (off <= greatest(1.0, abs(total) * 0.2))::DOUBLE / count(*) AS share_agree FROM b GROUP BY 1""",
)
def agg06(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority", F.col("o_totalprice").alias("total"))
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("part"))
    return accounts.reconcile(o, li, ["k"], ["o_orderpriority"], relative=0.2)


@query(
    "agg07_maturity_buckets",
    """WITH s AS (SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS w, sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS a FROM lineitem GROUP BY 1),
b AS (SELECT CASE WHEN w IS NULL OR a IS NULL THEN 'incomplete' WHEN abs(o_totalprice - (w + a)) <= greatest(1.0, abs(o_totalprice) * 0.2) THEN 'match'
  WHEN abs(o_totalprice + (w + a)) <= greatest(1.0, abs(o_totalprice) * 0.2) THEN 'sign_flip' ELSE 'other' END AS bucket FROM orders LEFT JOIN s ON l_orderkey = o_orderkey)
SELECT bucket, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM b GROUP BY 1""",
)
def agg07(spark: SparkSession, d: str) -> DataFrame:
    part = lambda f: F.sum(F.when(F.col("l_returnflag") == f, F.col("l_extendedprice")))
    s = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(part("A").alias("w"), part("R").alias("a"))
    return accounts.maturity_buckets(table(spark, d, "orders").join(s, "o_orderkey", "left"), F.col("o_totalprice"), F.col("w"), F.col("a"), relative=0.2)


@query(
    "agg18_date_reconciliation",
    """WITH r AS (SELECT o_custkey AS c, max(CAST(o_orderdate AS DATE)) AS rd FROM orders GROUP BY 1), a AS (SELECT o_custkey AS c, max(CAST(o_orderdate AS DATE)) AS ad FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
reg AS (SELECT c_custkey AS c, rd FROM customer LEFT JOIN r ON c = c_custkey), b AS (SELECT reg.c, rd, ad, a.c IS NULL AS missing FROM reg LEFT JOIN a USING (c)),
n AS (SELECT count(*) AS n_register, count(*) FILTER (missing AND rd IS NULL) AS neither, count(*) FILTER (missing AND rd IS NOT NULL) AS register_only, count(*) FILTER (NOT missing AND rd IS NULL) AS accounts_only,
  count(*) FILTER (NOT missing AND rd = ad) AS equal, count(*) FILTER (NOT missing AND rd > ad) AS register_later, count(*) FILTER (NOT missing AND rd IS NOT NULL AND (ad IS NULL OR rd < ad)) AS accounts_later FROM b)
SELECT *, CASE WHEN equal + register_later + accounts_later > 0 THEN equal::DOUBLE / (equal + register_later + accounts_later) END AS rate_equal FROM n""",
)
def agg18(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    r = table(spark, d, "customer").select(F.col("c_custkey").alias("company")).join(o.groupBy(F.col("o_custkey").alias("company")).agg(F.max("day").alias("register_date")), "company", "left")
    return accounts.date_reconciliation(r, o.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("company")).agg(F.max("day").alias("accounts_date")))


# ---- as-of and population -------------------------------------------------------------------------------------------

_SNAPSHOTS = ("2024-01-05", "2024-01-12", "2024-01-20")


@query(
    "jn03_snapshot_assignment",
    """WITH cat AS (SELECT unnest([DATE '2024-01-05', DATE '2024-01-12', DATE '2024-01-20']) AS sd), snap AS (
  SELECT sd, user_id, count(*) AS n_events, max(value) AS max_value FROM events JOIN cat ON CAST(ts AS DATE) <= sd AND CAST(ts AS DATE) > sd - 3 GROUP BY 1, 2
), obs AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events), chosen AS (SELECT o.*, (SELECT max(sd) FROM cat WHERE sd <= o.day) AS psc_snapshot_date FROM obs o)
SELECT c.event_id, c.user_id, c.day, c.psc_snapshot_date, s.n_events, s.max_value, s.user_id IS NOT NULL AS has_psc, c.psc_snapshot_date IS NOT NULL AS has_psc_snapshot, c.day - c.psc_snapshot_date AS psc_snapshot_age_days
FROM chosen c LEFT JOIN snap s ON s.sd = c.psc_snapshot_date AND s.user_id = c.user_id""",
)
def jn03(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    one = lambda at: e.where((F.col("day") <= F.lit(at).cast("date")) & (F.col("day") > F.date_sub(F.lit(at).cast("date"), 3))).groupBy(F.col("user_id").cast("string").alias("company_number")).agg(F.count(F.lit(1)).alias("n_events"), F.max("value").alias("max_value"))
    obs = e.select("event_id", F.col("user_id").cast("string").alias("user_id"), "day")
    return asof.assign_snapshots(obs, [(s, one(s)) for s in _SNAPSHOTS], "user_id", "day").withColumn("user_id", F.col("user_id").cast("long"))


_JOINED_SQL = """psc AS (SELECT o_custkey AS k, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), acc AS (SELECT o_custkey AS k, max(o_totalprice) AS top FROM orders WHERE o_totalprice > 400000 GROUP BY 1),
j AS (SELECT CAST(c_custkey AS VARCHAR) AS company_number, c_mktsegment AS reg_segment, n_orders AS psc_n_orders, psc.k IS NOT NULL AS has_psc, top AS acc_top, acc.k IS NOT NULL AS has_accounts
  FROM customer LEFT JOIN psc ON psc.k = c_custkey LEFT JOIN acc ON acc.k = c_custkey)"""


def _joined(spark: SparkSession, d: str) -> DataFrame:
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    key = lambda x: F.col(x).cast("string").alias("company_number")
    return population.population_join(
        c.select(key("c_custkey"), F.col("c_mktsegment").alias("segment")),
        o.where("o_orderstatus = 'F'").groupBy(key("o_custkey")).agg(F.count(F.lit(1)).alias("n_orders")),
        o.where("o_totalprice > 400000").groupBy(key("o_custkey")).agg(F.max("o_totalprice").alias("top")),
    )


@query("jn01_population_join", f"WITH {_JOINED_SQL} SELECT * FROM j")
def jn01(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d)


_COVER = """count(*) AS n_register, count(*) FILTER (has_psc AND has_accounts) AS all_three, count(*) FILTER (has_psc AND NOT has_accounts) AS register_psc_only,
  count(*) FILTER (NOT has_psc AND has_accounts) AS register_accounts_only, count(*) FILTER (NOT has_psc AND NOT has_accounts) AS register_only,
  count(*) FILTER (has_psc AND has_accounts)::DOUBLE / count(*) AS share_all_three, count(*) FILTER (has_psc AND NOT has_accounts)::DOUBLE / count(*) AS share_register_psc_only,
  count(*) FILTER (NOT has_psc AND has_accounts)::DOUBLE / count(*) AS share_register_accounts_only, count(*) FILTER (NOT has_psc AND NOT has_accounts)::DOUBLE / count(*) AS share_register_only"""


@query("agg19_coverage", f"WITH {_JOINED_SQL} SELECT coalesce(reg_segment, '<null>') AS category, {_COVER} FROM j GROUP BY 1")
def agg19(spark: SparkSession, d: str) -> DataFrame:
    return population.coverage(_joined(spark, d), F.col("reg_segment"))


@query("jn02_key_check", "SELECT count(*) AS n_rows, count(*) FILTER (coalesce(upper(trim(CAST(nullif(o_custkey, 7) AS VARCHAR))), '') = '') AS n_blank, count(DISTINCT nullif(o_custkey, 7)) AS n_distinct FROM orders")
def jn02(spark: SparkSession, d: str) -> DataFrame:
    return population.key_check(table(spark, d, "orders").select(F.nullif("o_custkey", F.lit(7)).alias("k")), "k")


@query("jn11_outside_register", "SELECT CAST(o_orderkey AS VARCHAR) AS company_number, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_orderkey)")
def jn11(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("company_number"), "o_orderstatus")
    return population.outside(o, table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("company_number")))


@query("jn10_semi_join", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def jn10(spark: SparkSession, d: str) -> DataFrame:
    some = table(spark, d, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(some, "o_custkey", "left_semi").select("o_orderkey", "o_totalprice")


def _audit_sql() -> str:
    base = "WITH a AS (SELECT o_orderkey AS k, o_totalprice AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 10 <> 3), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p, nullif(o_orderstatus, 'P') AS s FROM orders WHERE o_orderkey % 10 <> 5), f AS (SELECT a.k AS ak, b.k AS bk, a.p AS ap, b.p AS bp, a.s AS \"as_\", b.s AS bs FROM a FULL OUTER JOIN b USING (k))"
    one = lambda n, x, y: f"SELECT '{n}' AS \"column\", count(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL) AS n_both, count(*) FILTER (bk IS NULL) AS n_baseline_only, count(*) FILTER (ak IS NULL) AS n_candidate_only, count(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL AND {x} IS NOT DISTINCT FROM {y}) AS n_same, count(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL AND {x} <> {y}) AS n_changed, count(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL AND {x} IS NULL AND {y} IS NOT NULL) AS n_filled, count(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL AND {x} IS NOT NULL AND {y} IS NULL) AS n_emptied FROM f"
    return f"{base} {one('p', 'ap', 'bp')} UNION ALL {one('s', 'as_', 'bs')}"


@query("jn12_full_outer_audit", _audit_sql())
def jn12(spark: SparkSession, d: str) -> DataFrame:
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    a = o.where(k % 10 != 3).select(k.alias("k"), F.col("o_totalprice").alias("p"), F.col("o_orderstatus").alias("s"))
    price = F.when(k % 7 == 0, F.lit(None).cast("double")).when(k % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    b = o.where(k % 10 != 5).select(k.alias("k"), price.alias("p"), F.nullif("o_orderstatus", F.lit("P")).alias("s"))
    return population.full_outer_audit(a, b, ["k"], ["p", "s"])


@query(
    "jn22_value_diff",
    "SELECT a.o_orderkey AS k, nullif(a.o_orderstatus, 'P') AS m, a.o_totalprice AS value_a, CASE WHEN b.o_orderkey % 11 = 0 THEN b.o_totalprice + 1 ELSE b.o_totalprice END AS value_b FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderstatus <> 'P' AND a.o_orderkey % 11 = 0",
)
def jn22(spark: SparkSession, d: str) -> DataFrame:
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    base = o.select(k.alias("k"), F.nullif("o_orderstatus", F.lit("P")).alias("m"), "o_totalprice")
    return population.value_diff(base.withColumnRenamed("o_totalprice", "v"), base.select("k", "m", F.when(F.col("k") % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("v")), ["k", "m"], "v")


@query(
    "jn21_parity",
    """WITH a AS (SELECT c_custkey AS k, 'b,a,b' AS s, c_acctbal AS v FROM customer), b AS (SELECT c_custkey AS k, 'a,b' AS s, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE c_acctbal END AS v FROM customer)
SELECT 's' AS "column", count(*) AS n, count(*) AS n_same, 1.0::DOUBLE AS rate FROM a JOIN b USING (k)
UNION ALL SELECT 'v', count(*), count(*) FILTER (a.v = b.v), count(*) FILTER (a.v = b.v)::DOUBLE / count(*) FROM a JOIN b USING (k)""",
)
def jn21(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    a = c.select(F.col("c_custkey").alias("k"), F.lit("b,a,b").alias("s"), F.col("c_acctbal").alias("v"))
    b = c.select(F.col("c_custkey").alias("k"), F.lit("a,b").alias("s"), F.when(F.col("c_custkey") % 4 == 0, 0.0).otherwise(F.col("c_acctbal")).alias("v"))
    return population.parity(a, b, "k", ["s", "v"], ("s",))


# ---- inventories ----------------------------------------------------------------------------------------------------


@query("agg05_member_histogram", "SELECT l_returnflag, l_linestatus, count(*) AS n_facts, count(DISTINCT l_suppkey) AS n_companies, count(DISTINCT (l_suppkey, l_shipdate)) AS n_company_periods FROM lineitem GROUP BY 1, 2")
def agg05(spark: SparkSession, d: str) -> DataFrame:
    return inventory.member_histogram(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_suppkey", "l_shipdate")


@query(
    "agg08_unit_distribution",
    """WITH c AS (SELECT quantile_cont(l_extendedprice, 0.999) AS cutoff FROM lineitem) SELECT l_returnflag, count(l_extendedprice) AS n, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.99) AS p99,
  quantile_cont(l_extendedprice, 0.999) AS p999, quantile_cont(l_extendedprice, 0.9999) AS p9999, max(l_extendedprice) AS max_value, count(*) FILTER (l_extendedprice > cutoff) AS n_above, count(*) FILTER (l_extendedprice <= cutoff) AS n_kept FROM lineitem, c GROUP BY 1""",
)
def agg08(spark: SparkSession, d: str) -> DataFrame:
    return inventory.unit_distribution(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice")


@query(
    "agg09_concept_inventory",
    """SELECT event_type, count(*) AS n_facts, count(DISTINCT user_id) AS n_companies, count(*) FILTER (nullif(props, '{"k": 1}') IS NULL)::DOUBLE / count(*) AS null_share,
  array_to_string(list_sort(list(DISTINCT nullif(props, '{"k": 1}')) FILTER (nullif(props, '{"k": 1}') IS NOT NULL))[1:3], '|') AS examples FROM events GROUP BY 1""",
)
def agg09(spark: SparkSession, d: str) -> DataFrame:
    return inventory.concept_inventory(table(spark, d, "events").withColumn("p", F.nullif("props", F.lit('{"k": 1}'))), "event_type", "user_id", "p")


@query("agg09_approximate_companies")
def agg09_approx(spark: SparkSession, d: str) -> DataFrame:
    return inventory.concept_inventory(table(spark, d, "lineitem"), "l_returnflag", "l_partkey", "l_tax", exact=False).drop("examples")


@query(
    "agg28_distribution",
    "SELECT 'o_totalprice' AS \"column\", count(o_totalprice) AS n, quantile_cont(o_totalprice, 0.5) AS p50, quantile_cont(o_totalprice, 0.9) AS p90, quantile_cont(o_totalprice, 0.99) AS p99, max(o_totalprice) AS max_value FROM orders "
    "UNION ALL SELECT 'o_custkey', count(o_custkey), quantile_cont(CAST(o_custkey AS DOUBLE), 0.5), quantile_cont(CAST(o_custkey AS DOUBLE), 0.9), quantile_cont(CAST(o_custkey AS DOUBLE), 0.99), CAST(max(o_custkey) AS DOUBLE) FROM orders",
)
def agg28(spark: SparkSession, d: str) -> DataFrame:
    return inventory.distribution(table(spark, d, "orders"), ["o_totalprice", "o_custkey"])


@query("agg29_panel", "WITH p AS (SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS n FROM orders GROUP BY 1) SELECT CASE WHEN n >= 4 THEN '4+' ELSE CAST(n AS VARCHAR) END AS n_periods, count(*) AS n_companies FROM p GROUP BY 1")
def agg29(spark: SparkSession, d: str) -> DataFrame:
    return inventory.panel(table(spark, d, "orders"), "o_custkey", F.year("o_orderdate"))


@query("agg30_top_values", "SELECT props, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, props LIMIT 10")
def agg30(spark: SparkSession, d: str) -> DataFrame:
    return inventory.top_values(table(spark, d, "events"), "props", 10)


@query("agg31_crosstab", "SELECT year(o_orderdate) AS y, count(*) FILTER (o_orderstatus = 'F') AS \"n_F\", count(*) FILTER (o_orderstatus = 'O') AS \"n_O\", count(*) FILTER (o_orderstatus = 'P') AS \"n_P\" FROM orders GROUP BY 1")
def agg31(spark: SparkSession, d: str) -> DataFrame:
    return inventory.crosstab(table(spark, d, "orders"), F.year("o_orderdate"), "y", "o_orderstatus", ["F", "O", "P"])


@query("agg30_monotone_parts", "WITH l AS (SELECT event_type, value, lag(value) OVER (PARTITION BY event_type ORDER BY event_id) AS b FROM events) SELECT event_type, count(*) AS n, count(*) FILTER (value < b) AS n_falls FROM l GROUP BY 1")
def agg30_monotone(spark: SparkSession, d: str) -> DataFrame:
    return inventory.monotone_parts(table(spark, d, "events"), "event_type", "event_id", "value")


@query(
    "agg35_wilson",
    """WITH g AS (SELECT year(o_orderdate) AS y, count(*)::DOUBLE AS n, count(*) FILTER (o_orderstatus = 'F')::DOUBLE AS k FROM orders GROUP BY 1), p AS (SELECT *, k / n AS p, 1.96::DOUBLE AS z FROM g)
SELECT y, n::BIGINT AS n, k::BIGINT AS n_agree, p AS rate, (p + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n) AS low,
  (p + z * z / (2 * n)) / (1 + z * z / n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n) AS high FROM p""",
)
def agg35(spark: SparkSession, d: str) -> DataFrame:
    return inventory.wilson(table(spark, d, "orders").withColumn("y", F.year("o_orderdate")), ["y"], F.col("o_orderstatus") == "F")


@query(
    "agg33_collapse_duplicates",
    """WITH f AS (SELECT user_id, event_type, event_id, value < 2 AS v FROM events), g AS (SELECT user_id, event_type, count(DISTINCT v) AS d, count(*) AS n_same, min(event_id) AS first FROM f GROUP BY 1, 2)
SELECT f.user_id, f.event_type, f.event_id, f.v, n_same, CASE WHEN d = 1 THEN 'selected' ELSE 'conflict' END AS status FROM f JOIN g USING (user_id, event_type) WHERE d > 1 OR event_id = first""",
)
def agg33(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", "event_type", "event_id", (F.col("value") < 2).alias("v"))
    return inventory.collapse_duplicates(rows, ["user_id", "event_type"], "v", F.col("event_id"))


@query("agg17_concentration", "SELECT s_suppkey, k, CASE WHEN k IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY k) END AS n FROM (SELECT s_suppkey, nullif(s_nationkey, 3) AS k FROM supplier)")
def agg17(spark: SparkSession, d: str) -> DataFrame:
    return register.concentration(table(spark, d, "supplier").select("s_suppkey", F.nullif("s_nationkey", F.lit(3)).alias("k")), "k", "n")


@query(
    "agg12_sorted_sets",
    "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types, array_to_string(list_sort(list(event_type) FILTER (value > 40)), ',') AS large FROM events GROUP BY 1 HAVING count(*) FILTER (value > 40) > 0",
)
def agg12(spark: SparkSession, d: str) -> DataFrame:
    large = F.when(F.col("value") > 40, F.col("event_type"))
    out = table(spark, d, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"), F.array_join(F.array_sort(F.collect_list(large)), ",").alias("large"), F.count(large).alias("n"))
    return out.where("n > 0").drop("n")


@query(
    "agg15_companies_per_person",
    "WITH n AS (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1), m AS (SELECT l_suppkey, max(n) AS n FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN n USING (l_partkey) GROUP BY 1) SELECT l_suppkey, CASE WHEN n = 1 THEN '1' WHEN n <= 10 THEN '2-10' ELSE '11+' END AS companies_per_person_band FROM m",
)
def agg15(spark: SparkSession, d: str) -> DataFrame:
    return ownership.companies_per_person(table(spark, d, "lineitem"), "l_partkey", "l_suppkey")


# ---- normal forms ---------------------------------------------------------------------------------------------------


def _damaged(spark: SparkSession, d: str) -> DataFrame:
    k, s = F.col("c_custkey"), F.col("c_custkey").cast("string")
    raw = F.when(k % 7 == 0, F.concat(s, F.lit(".0"))).when(k % 7 == 1, F.concat(F.lit(" sc "), s)).when(k % 7 == 2, F.lpad(s, 8, "0")).when(k % 7 == 3, F.concat(F.lit("XX"), s, F.lit("9"))).when(k % 7 == 4, F.lit("nan")).when(k % 7 == 5, F.concat(s, F.lit("-A"))).otherwise(s)
    return table(spark, d, "customer").select(k.alias("k"), raw.alias("raw"))


_DAMAGED_SQL = "damaged AS (SELECT c_custkey AS k, CASE c_custkey % 7 WHEN 0 THEN c_custkey || '.0' WHEN 1 THEN ' sc ' || c_custkey WHEN 2 THEN right('00000000' || c_custkey, 8) WHEN 3 THEN 'XX' || c_custkey || '9' WHEN 4 THEN 'nan' WHEN 5 THEN c_custkey || '-A' ELSE CAST(c_custkey AS VARCHAR) END AS raw FROM customer)"
_NORMAL_SQL = f"""{_DAMAGED_SQL}, tidy AS (SELECT *, replace(upper(trim(raw)), ' ', '') AS t FROM damaged), cutoff AS (SELECT *, CASE WHEN regexp_full_match(t, '\\d{{1,8}}\\.0') THEN left(t, length(t) - 2) ELSE t END AS s FROM tidy),
normal AS (SELECT k, raw, CASE WHEN regexp_full_match(s, '\\d{{1,8}}') THEN lpad(s, 8, '0') WHEN regexp_full_match(s, '[A-Z]{{2}}\\d{{1,6}}') THEN left(s, 2) || lpad(s[3:], 6, '0') END AS number,
  CASE WHEN regexp_full_match(s, '\\d{{8}}') OR regexp_full_match(s, '[A-Z]{{2}}\\d{{6}}') THEN 'ok' WHEN regexp_full_match(s, '\\d{{1,8}}') OR regexp_full_match(s, '[A-Z]{{2}}\\d{{1,6}}') THEN 'fixed' ELSE 'invalid' END AS status FROM cutoff)"""


@query("nrm01_company_number", f"WITH {_NORMAL_SQL} SELECT k, number, status FROM normal")
def nrm01(spark: SparkSession, d: str) -> DataFrame:
    return _damaged(spark, d).select("k", identifiers.normalise(F.col("raw")).alias("n")).select("k", "n.number", "n.status")


@query("nrm02_validation_counts", f"WITH {_NORMAL_SQL} SELECT count(*) AS input_rows, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'fixed') AS fixed, count(*) FILTER (status = 'invalid') AS invalid, count(number) - count(DISTINCT number) AS duplicates FROM normal")
def nrm02(spark: SparkSession, d: str) -> DataFrame:
    return identifiers.validation_counts(_damaged(spark, d), "raw")


@query("nrm02_validation_report", f"WITH {_NORMAL_SQL} SELECT number, CASE WHEN bool_or(status = 'ok') THEN 'ok' ELSE 'fixed' END AS status, coalesce(min(k) FILTER (status = 'ok'), min(k)) AS first, count(*) AS copies FROM normal WHERE number IS NOT NULL GROUP BY 1")
def nrm02_report(spark: SparkSession, d: str) -> DataFrame:
    return identifiers.validation_report(_damaged(spark, d), "raw", "k")


@query("nrm04_lax", f"WITH {_DAMAGED_SQL} SELECT k, CASE WHEN ltrim(upper(regexp_replace(raw, '\\s+', '', 'g')), '0') = '' THEN '0' ELSE ltrim(upper(regexp_replace(raw, '\\s+', '', 'g')), '0') END AS lax FROM damaged")
def nrm04(spark: SparkSession, d: str) -> DataFrame:
    return _damaged(spark, d).select("k", identifiers.lax(F.col("raw")).alias("lax"))


@query("nrm05_address", "SELECT s_suppkey, nullif(trim(regexp_replace(regexp_replace(upper(s_name || ', ' || s_suppkey), '[^A-Z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')), '') AS strict, nullif(regexp_replace(upper(s_name || ', ' || s_suppkey), '[^A-Z0-9]', '', 'g'), '') AS loose FROM supplier")
def nrm05(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat("s_name", F.lit(", "), "s_suppkey")
    return table(spark, d, "supplier").select("s_suppkey", text.address(raw).alias("strict"), text.address_loose(raw).alias("loose"))


@query(
    "nrm06_postcode",
    "WITH p AS (SELECT c_custkey, replace(upper(trim(CASE WHEN c_custkey % 3 = 0 THEN 'ab' || (c_custkey % 90) || ' 1cd' WHEN c_custkey % 3 = 1 THEN 'W1A' || (c_custkey % 10) || 'BX' ELSE 'no ' || c_custkey END)), ' ', '') AS postcode FROM customer) SELECT c_custkey, postcode, regexp_matches(postcode, '^(GIR0AA|[A-Z]{1,2}[0-9][A-Z0-9]?[0-9][A-Z]{2})$') AS valid, CASE WHEN regexp_matches(postcode, '^(GIR0AA|[A-Z]{1,2}[0-9][A-Z0-9]?[0-9][A-Z]{2})$') THEN left(postcode, length(postcode) - 3) END AS district FROM p",
)
def nrm06(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = F.when(k % 3 == 0, F.concat(F.lit("ab"), k % 90, F.lit(" 1cd"))).when(k % 3 == 1, F.concat(F.lit("W1A"), k % 10, F.lit("BX"))).otherwise(F.concat(F.lit("no "), k))
    rows = table(spark, d, "customer").select("c_custkey", text.postcode(raw).alias("postcode"))
    return rows.select("c_custkey", "postcode", text.postcode_valid(F.col("postcode")).alias("valid"), text.postcode_district(F.col("postcode")).alias("district"))


@query(
    "nrm08_sic_section",
    "SELECT p_partkey, CASE " + " ".join(f"WHEN p_partkey % 100 BETWEEN {a} AND {b} THEN '{s}'" for s, a, b in text.SIC_SECTIONS) + " ELSE 'unknown' END AS section FROM part",
)
def nrm08(spark: SparkSession, d: str) -> DataFrame:
    code = F.concat(F.lpad((F.col("p_partkey") % 100).cast("string"), 2, "0"), F.lit("012 - trade"))
    return table(spark, d, "part").select("p_partkey", text.sic_section(text.sic_leading_digits(code)).alias("section"))


@query("nrm10_months", "SELECT o_orderkey, (year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS months, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2")
def nrm10(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("o_orderkey", dates.whole_months(F.col("l_shipdate"), F.col("o_orderdate")).alias("months")).agg(F.count(F.lit(1)).alias("n"))


@query("nrm11_month_arithmetic", "WITH m AS (SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS d FROM orders) SELECT o_orderkey, year(d - INTERVAL 1 MONTH) * 100 + month(d - INTERVAL 1 MONTH) AS previous, year(d - INTERVAL 24 MONTH) * 100 + month(d - INTERVAL 24 MONTH) AS cutoff FROM m")
def nrm11(spark: SparkSession, d: str) -> DataFrame:
    m = dates.yyyymm(F.col("o_orderdate"))
    return table(spark, d, "orders").select("o_orderkey", dates.previous_month(m).alias("previous"), dates.add_months(m, -24).alias("cutoff"))


def _natures_sql() -> str:
    pick = lambda values, i: f"[{', '.join(repr(v) for v in values)}][CAST(p_partkey % {i} AS INTEGER) + 1]"
    cores = (*natures.CORES, natures.ALONE, "new-right")
    return f"""WITH p AS (SELECT p_partkey, {pick(cores, 8)} AS c, CASE WHEN p_partkey % 8 < 6 THEN {pick((*natures.BANDS, "more-than-25-percent"), 4)} END AS band, {pick(("", *natures.SUFFIXES), 11)} AS e FROM part)
SELECT p_partkey, c || coalesce('-' || band, '') || e AS code, CASE WHEN e = '' THEN 'plain' ELSE e[2:] END AS suffix_family, band, nullif(c, 'new-right') AS core,
  CASE band WHEN '25-to-50-percent' THEN 1 WHEN '50-to-75-percent' THEN 2 WHEN '75-to-100-percent' THEN 3 END AS rank FROM p"""


@query("nrm12_natures", _natures_sql())
def nrm12(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    cores, ends = F.array(*map(F.lit, (*natures.CORES, natures.ALONE, "new-right"))), F.array(F.lit(""), *map(F.lit, natures.SUFFIXES))
    code = F.concat(F.get(cores, (k % 8).cast("int")), F.when(k % 8 < 6, F.concat(F.lit("-"), F.get(F.array(*map(F.lit, (*natures.BANDS, "more-than-25-percent"))), (k % 4).cast("int")))).otherwise(""), F.get(ends, (k % 11).cast("int")))
    n = table(spark, d, "part").select("p_partkey", code.alias("code")).withColumn("n", natures.decompose(F.col("code")))
    return n.select("p_partkey", "code", "n.suffix_family", "n.band", "n.core", natures.band_rank(F.col("n.band")).alias("rank"))


@query("nrm17_age_band", "WITH d AS (SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-01-01') AS n FROM orders) SELECT o_orderkey, CASE WHEN n < 730 THEN '<2y' WHEN n < 1826 THEN '2-5y' WHEN n < 3653 THEN '5-10y' ELSE '10y+' END AS band FROM d")
def nrm17(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", dates.age_band_days(F.datediff(F.lit("2001-01-01").cast("date"), F.to_date("o_orderdate"))).alias("band"))


@query("nrm18_bands", "SELECT p_partkey, CASE WHEN p_size <= 0 THEN '0' WHEN p_size <= 10 THEN '1-10' WHEN p_size <= 50 THEN '11-50' ELSE '51-250' END AS employees, CASE WHEN p_size < 10 AND p_size > 0 THEN '<10' ELSE CAST(p_size AS VARCHAR) END AS shown FROM part")
def nrm18(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", bands.employees(F.col("p_size")).alias("employees"), bands.shown(F.col("p_size")).alias("shown"))


@query("nrm22_keyed_hash")
def nrm22(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", hashing.person_key(b"not a secret", F.col("c_name"), F.nullif("c_nationkey", F.lit(3))).alias("key"))


@query("nrm23_hash_bucket", "SELECT c_custkey, CAST(md5_number_lower(CAST(c_custkey AS VARCHAR)) % 10 AS INTEGER) AS bucket FROM customer")
def nrm23(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", hashing.md5_bucket(F.col("c_custkey").cast("string"), 10).alias("bucket"))


@query("nrm24_log_transforms", "SELECT s_suppkey, ln(1 + greatest(s_acctbal, 0)) AS log_count, sign(s_acctbal) * ln(1 + abs(s_acctbal)) AS log_signed FROM supplier")
def nrm24(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("s_acctbal")
    return table(spark, d, "supplier").select("s_suppkey", bands.log_count(b).alias("log_count"), bands.log_signed(b).alias("log_signed"))


@query("flt04_deny_allow", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error', 'signup') AND user_id IN (1, 2, 3, 5, 8, 13)")
def flt04(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where(~F.col("event_type").isin("error", "signup") & F.col("user_id").isin(1, 2, 3, 5, 8, 13)).select("event_id", "event_type")


@query("set02_unpivot", "SELECT o_orderkey, field, v FROM (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders) UNPIVOT (v FOR field IN (o_orderstatus, o_orderpriority))")
def set02(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").unpivot(["o_orderkey"], ["o_orderstatus", "o_orderpriority"], "field", "v")


@query("win04_first_per_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def win04(spark: SparkSession, d: str) -> DataFrame:
    return cohort.first_per(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


# ---- sampling -------------------------------------------------------------------------------------------------------


@query("smp02_hash_sample", "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5_number_lower(o_orderkey || ':7'), o_orderkey LIMIT 100")
def smp02(spark: SparkSession, d: str) -> DataFrame:
    return sampling.hash_sample(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 7, 100)


@query(
    "smp03_stratified",
    """WITH r AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5_number_lower(o_orderkey || ':7'), o_orderkey) AS r, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders), q AS (SELECT *, CAST(round_even(n * 0.02::DOUBLE, 0) AS BIGINT) AS quota FROM r)
SELECT o_orderkey, o_orderpriority, n::DOUBLE / quota AS weight FROM q WHERE r <= quota""",
)
def smp03(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 7, 0.02)


@query(
    "smp05_cells",
    """WITH c AS (SELECT o_orderkey, CASE WHEN o_totalprice > 450000 THEN 'large' WHEN o_orderstatus = 'P' THEN 'pending' END AS cell FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY md5_number_lower(o_orderkey || ':9'), o_orderkey) AS r, count(*) OVER (PARTITION BY cell) AS n FROM c WHERE cell IS NOT NULL)
SELECT o_orderkey, cell, n::DOUBLE / least(n, 50) AS weight FROM r WHERE r <= 50""",
)
def smp05(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return sampling.cells(o, [("large", F.col("o_totalprice") > 450000), ("pending", F.col("o_orderstatus") == "P")], 50, "o_orderkey", 9).select("o_orderkey", "cell", "weight")


@query(
    "smp06_evenly_spaced",
    """WITH r AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders), want AS (SELECT o_orderpriority, (k * n) // 20 AS i FROM (SELECT DISTINCT o_orderpriority, n FROM r), range(20) t(k))
SELECT o_orderkey, o_orderpriority FROM r JOIN want USING (o_orderpriority, i)""",
)
def smp06(spark: SparkSession, d: str) -> DataFrame:
    return sampling.evenly_spaced(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["o_orderkey"], 20)


@query("smp07_split", "WITH b AS (SELECT c_custkey, CAST(md5_number_lower(c_custkey || ':11') % 10 AS INTEGER) AS bucket FROM customer) SELECT c_custkey, bucket, CASE WHEN bucket < 2 THEN 'test' ELSE 'train' END AS part FROM b")
def smp07(spark: SparkSession, d: str) -> DataFrame:
    return sampling.split(table(spark, d, "customer").select("c_custkey"), "c_custkey", 11)


# ---- cohorts, effects, metrics --------------------------------------------------------------------------------------

_LABELS_SQL = f"""{_DAMAGED_SQL}, rows AS (SELECT k AS line_no, CASE WHEN k % 5 = 0 THEN '00000042' ELSE raw END AS company_number, CASE WHEN k % 11 = 0 THEN 'Y' ELSE 'N' END AS is_bulk,
  CASE k % 4 WHEN 0 THEN 'Compulsory liquidation' WHEN 1 THEN 'Creditors voluntary liquidation' WHEN 2 THEN 'Administration to CVL' ELSE 'CVA' END AS case_type, CASE WHEN k % 13 = 0 THEN 'x' ELSE '2015-0' || (k % 9 + 1) END AS month_registered FROM damaged)"""


def _labels(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    kind = F.get(F.array(*map(F.lit, ("Compulsory liquidation", "Creditors voluntary liquidation", "Administration to CVL", "CVA"))), (k % 4).cast("int"))
    return _damaged(spark, d).select(
        k.alias("line_no"),
        F.when(k % 5 == 0, "00000042").otherwise(F.col("raw")).alias("company_number"),
        F.when(k % 11 == 0, "Y").otherwise("N").alias("is_bulk"),
        kind.alias("case_type"),
        F.when(k % 13 == 0, "x").otherwise(F.concat(F.lit("2015-0"), k % 9 + 1)).alias("month_registered"),
        (k % 99).cast("string").alias("sic07_2_digit"),
    )


@query(
    "agg21_label_dispositions",
    f"""WITH {_LABELS_SQL}, tidy AS (SELECT *, replace(upper(trim(company_number)), ' ', '') AS t FROM rows), s AS (SELECT *, CASE WHEN regexp_full_match(t, '\\d{{1,8}}\\.0') THEN left(t, length(t) - 2) ELSE t END AS s FROM tidy),
n AS (SELECT *, CASE WHEN regexp_full_match(s, '\\d{{1,8}}') THEN lpad(s, 8, '0') WHEN regexp_full_match(s, '[A-Z]{{2}}\\d{{1,6}}') THEN left(s, 2) || lpad(s[3:], 6, '0') END AS number FROM s),
d AS (SELECT *, CASE WHEN is_bulk = 'Y' THEN 'bulk' WHEN lower(case_type) = 'administration to cvl' THEN 'administration_to_cvl' WHEN number IS NULL THEN 'bad_number' WHEN month_registered = 'x' THEN 'shifted' END AS d FROM n),
f AS (SELECT *, min(line_no) FILTER (d IS NULL) OVER (PARTITION BY number) AS first FROM d) SELECT coalesce(d, CASE WHEN line_no = first THEN 'kept' ELSE 'duplicate' END) AS disposition, count(*) AS n FROM f GROUP BY 1""",
)
def agg21(spark: SparkSession, d: str) -> DataFrame:
    return cohort.dispositions(_labels(spark, d)).groupBy("disposition").agg(F.count(F.lit(1)).alias("n"))


@query(
    "lt01_lead_time",
    """WITH c AS (SELECT user_id, min(ts) AS event FROM events WHERE event_type = 'error' GROUP BY 1), l AS (SELECT unnest([1, 3, 7]) AS lead), x AS (SELECT user_id, event, lead, event - to_days(CAST(lead AS INTEGER)) AS cutoff FROM c, l),
m AS (SELECT x.*, e.value, e.event_id, row_number() OVER (PARTITION BY x.user_id, x.lead ORDER BY e.ts DESC, e.event_id DESC) AS rn FROM x LEFT JOIN events e ON e.user_id = x.user_id AND e.ts <= x.cutoff AND e.event_type <> 'error')
SELECT lead, count(*) AS n_cases, count(event_id) AS n_observed, quantile_cont(value, 0.25) AS value_q25, quantile_cont(value, 0.5) AS value_median, quantile_cont(value, 0.75) AS value_q75 FROM m WHERE rn = 1 GROUP BY 1""",
)
def lt01(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    cases = e.where("event_type = 'error'").groupBy("user_id").agg(F.min("ts").alias("event"))
    facts = e.where("event_type <> 'error'").select("user_id", "ts", "event_id", "value")
    joined = cohort.lead_time(cases, facts, "user_id", "event", "ts", [1, 3, 7], F.col("event") - F.make_dt_interval("lead"))
    return cohort.lead_summary(joined, ["lead"], "event_id", ["value"])


@query(
    "agg27_evaluation",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS n_cases, count(*) FILTER (o_orderstatus = 'F' AND o_totalprice > 300000) AS n_cases_flagged, count(*) FILTER (o_orderstatus <> 'F') AS n_controls, count(*) FILTER (o_orderstatus <> 'F' AND o_totalprice > 300000) AS n_controls_flagged,
  count(*) FILTER (o_orderstatus = 'F' AND o_totalprice > 300000)::DOUBLE / count(*) FILTER (o_orderstatus = 'F') AS recall, count(*) FILTER (o_orderstatus <> 'F' AND o_totalprice > 300000)::DOUBLE / count(*) FILTER (o_orderstatus <> 'F') AS control_rate FROM orders GROUP BY 1""",
)
def agg27(spark: SparkSession, d: str) -> DataFrame:
    return cohort.evaluation(table(spark, d, "orders"), F.col("o_orderstatus") == "F", F.col("o_totalprice") > 300000, ["o_orderpriority"])


@query("agg24_describe", "SELECT o_orderstatus, count(o_totalprice) AS n, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS sd, quantile_cont(o_totalprice, 0.25) AS q25, quantile_cont(o_totalprice, 0.5) AS median, quantile_cont(o_totalprice, 0.75) AS q75 FROM orders GROUP BY 1")
def agg24(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.describe(table(spark, d, "orders"), "o_orderstatus", "o_totalprice")


def _case() -> Column:
    return F.col("o_orderstatus") == "F"


@query(
    "agg24_binary_effects",
    """WITH n AS (SELECT count(*) FILTER (o_orderstatus = 'F' AND o_totalprice > 300000) AS a, count(*) FILTER (o_orderstatus = 'F' AND o_totalprice <= 300000) AS b, count(*) FILTER (o_orderstatus <> 'F' AND o_totalprice > 300000) AS c, count(*) FILTER (o_orderstatus <> 'F' AND o_totalprice <= 300000) AS d FROM orders),
l AS (SELECT *, ln((a / (a + b)) / (c / (c + d))) AS lrr, ln(a * d / (b * c)) AS lor, sqrt(1 / a - 1 / (a + b) + 1 / c - 1 / (c + d)) AS sr, sqrt(1 / a + 1 / b + 1 / c + 1 / d) AS so FROM (SELECT a::DOUBLE AS a, b::DOUBLE AS b, c::DOUBLE AS c, d::DOUBLE AS d FROM n))
SELECT a::BIGINT AS a, b::BIGINT AS b, c::BIGINT AS c, d::BIGINT AS d, exp(lrr) AS rr, exp(lrr - 1.96 * sr) AS rr_low, exp(lrr + 1.96 * sr) AS rr_high, exp(lor) AS odds, exp(lor - 1.96 * so) AS or_low, exp(lor + 1.96 * so) AS or_high FROM l""",
)
def agg24_binary(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.binary_effects(table(spark, d, "orders"), _case(), F.col("o_totalprice") > 300000)


@query(
    "agg24_mean_difference",
    """WITH m AS (SELECT count(*) FILTER (o_orderstatus = 'F') AS n1, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS m1, var_samp(o_totalprice) FILTER (o_orderstatus = 'F') AS v1, count(*) FILTER (o_orderstatus <> 'F') AS n0, avg(o_totalprice) FILTER (o_orderstatus <> 'F') AS m0, var_samp(o_totalprice) FILTER (o_orderstatus <> 'F') AS v0 FROM orders)
SELECT *, (m1 - m0) / sqrt((v1 + v0) / 2) AS smd, (m1 - m0) / sqrt(v1 / n1 + v0 / n0) AS welch_t FROM m""",
)
def agg24_mean(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.mean_difference(table(spark, d, "orders"), _case(), "o_totalprice")


@query(
    "agg24_cramers_v",
    """WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*)::DOUBLE AS o FROM lineitem GROUP BY 1, 2), r AS (SELECT a, sum(o) AS r FROM c GROUP BY 1), k AS (SELECT b, sum(o) AS k FROM c GROUP BY 1), n AS (SELECT sum(o) AS n FROM c),
s AS (SELECT sum((coalesce(o, 0) - r * k / n) * (coalesce(o, 0) - r * k / n) / (r * k / n)) AS chi2, any_value(n) AS n, (count(DISTINCT r.a) - 1) * (count(DISTINCT k.b) - 1) AS df, least(count(DISTINCT r.a), count(DISTINCT k.b)) - 1 AS m FROM r CROSS JOIN k CROSS JOIN n LEFT JOIN c ON c.a = r.a AND c.b = k.b)
SELECT n::BIGINT AS n, chi2, df, sqrt(chi2 / (n * m)) AS cramers_v FROM s""",
)
def agg24_cramer(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.cramers_v(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


@query(
    "agg25_rank_effect",
    """WITH g AS (SELECT p_size AS v, sum(CASE WHEN p_type = 'ECONOMY' THEN p_retailprice ELSE 0 END) AS wc, sum(CASE WHEN p_type = 'ECONOMY' THEN 0 ELSE p_retailprice END) AS wo FROM part GROUP BY 1), b AS (SELECT *, sum(wo) OVER (ORDER BY v) - wo AS below FROM g)
SELECT 2 * sum(wc * (below + wo / 2)) / (sum(wc) * sum(wo)) - 1 AS effect, sum(wc) AS weight_cases, sum(wo) AS weight_others FROM b""",
)
def agg25(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.rank_effect(table(spark, d, "part"), F.col("p_type") == "ECONOMY", "p_size", F.col("p_retailprice"))


@query(
    "ml06_weighted_auc",
    """WITH g AS (SELECT p_size AS s, sum(CASE WHEN p_type = 'ECONOMY' THEN p_retailprice ELSE 0 END) AS p, sum(CASE WHEN p_type = 'ECONOMY' THEN 0 ELSE p_retailprice END) AS n FROM part GROUP BY 1), c AS (SELECT *, sum(p) OVER (ORDER BY s DESC) AS cp, sum(n) OVER (ORDER BY s DESC) AS cn FROM g)
SELECT sum(n * (cp - p / 2)) / (sum(p) * sum(n)) AS roc_auc, sum(p * cp / (cp + cn)) / sum(p) AS average_precision FROM c""",
)
def ml06(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").withColumn("y", (F.col("p_type") == "ECONOMY").cast("int"))
    return evaluate.weighted_auc(rows, "y", "p_size", F.col("p_retailprice"))


@query(
    "ml06_log_loss",
    "WITH r AS (SELECT (p_type = 'ECONOMY')::INTEGER::DOUBLE AS y, (p_size + 1) / 60.0::DOUBLE AS p, p_retailprice AS w FROM part) SELECT sum(-(y * ln(p) + (1 - y) * ln(1 - p)) * w) / sum(w) AS log_loss, sum((p - y) * (p - y) * w) / sum(w) AS brier FROM r",
)
def ml06_loss(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").withColumn("y", (F.col("p_type") == "ECONOMY").cast("int")).withColumn("p", (F.col("p_size") + 1) / F.lit(60.0))
    return evaluate.log_loss(rows, "y", "p", F.col("p_retailprice"))


@query(
    "agg26_benjamini_hochberg",
    "WITH t AS (SELECT s_suppkey, (s_suppkey * 37 % 100 + 1) / 101.0::DOUBLE AS p FROM supplier), r AS (SELECT *, row_number() OVER (ORDER BY p, s_suppkey) AS r, count(*) OVER () AS n FROM t) SELECT s_suppkey, p, least(1.0, min(p * n / r) OVER (ORDER BY p DESC, s_suppkey DESC ROWS UNBOUNDED PRECEDING)) AS q FROM r",
)
def agg26(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").select("s_suppkey", ((F.col("s_suppkey") * 37 % 100 + 1) / F.lit(101.0)).alias("p"))
    return evaluate.benjamini_hochberg(rows, "p", "s_suppkey")


@query("ml07_bootstrap")
def ml07(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.bootstrap_deltas(table(spark, d, "customer"), "c_custkey", "c_acctbal", "c_mktsegment", 20, 3)


# ---- rules ----------------------------------------------------------------------------------------------------------


@query(
    "rul_flags",
    """WITH r AS (SELECT o_orderkey AS k, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS observed_at FROM orders)
SELECT k, 'LARGE' AS rule_id, 'high' AS severity, 1 AS tier, 'status=' || o_orderstatus AS evidence, observed_at FROM r WHERE o_totalprice > 450000
UNION ALL SELECT k, 'PENDING', 'info', 1, 'pending', observed_at FROM r WHERE o_orderstatus = 'P' UNION ALL SELECT k, 'SMALL', 'low', 2, 'key=' || k, observed_at FROM r WHERE o_totalprice < 5000""",
)
def rul(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("observed_at"))
    own = [
        rules.Rule("LARGE", "high", F.when(F.col("o_totalprice") > 450000, F.concat(F.lit("status="), "o_orderstatus"))),
        rules.Rule("PENDING", "info", F.when(F.col("o_orderstatus") == "P", "pending")),
        rules.Rule("SMALL", "low", F.when(F.col("o_totalprice") < 5000, F.concat(F.lit("key="), "k")), 2),
    ]
    return rules.flags(rows, own, "k", "observed_at")


# ---- housekeeping ---------------------------------------------------------------------------------------------------


@query(
    "hk04_leak_scan",
    r"""WITH c AS (SELECT lang, len(regexp_extract_all(text, '\b([0-9]{8}|[A-Z]{2}[0-9]{6})\b')) AS a, len(regexp_extract_all(text, '\b[0-9a-f]{64}\b')) AS b, len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS e FROM documents)
SELECT lang, count(*) AS n_rows, count(*) FILTER (a > 0) AS rows_company_numbers, count(*) FILTER (b > 0) AS rows_hashes, count(*) FILTER (e > 0) AS rows_emails, coalesce(sum(a), 0)::BIGINT AS n_company_numbers, coalesce(sum(b), 0)::BIGINT AS n_hashes, coalesce(sum(e), 0)::BIGINT AS n_emails FROM c GROUP BY 1""",
)
def hk04(spark: SparkSession, d: str) -> DataFrame:
    return housekeeping.leak_scan(table(spark, d, "documents"), "text", ["lang"])


@query("hk02_retention", "WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), k AS (SELECT min(d) AS keep_date, 'first_of_month' AS r FROM d GROUP BY date_trunc('month', d) UNION ALL SELECT max(d), 'latest' FROM d) SELECT keep_date, string_agg(r, ',' ORDER BY r) AS reason FROM k GROUP BY 1")
def hk02(spark: SparkSession, d: str) -> DataFrame:
    return housekeeping.retention(table(spark, d, "orders"), "o_orderdate")


@query("hk03_month_gaps", "WITH h AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS m FROM orders WHERE o_totalprice > 497000), r AS (SELECT unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH))::DATE AS month FROM h) SELECT month FROM r WHERE month NOT IN (SELECT m FROM h)")
def hk03(spark: SparkSession, d: str) -> DataFrame:
    return housekeeping.month_gaps(table(spark, d, "orders").where("o_totalprice > 497000"), "o_orderdate")


@query(
    "hk07_manifest",
    """WITH f AS (SELECT l_suppkey, count(*) AS found FROM lineitem WHERE l_suppkey % 9 <> 0 GROUP BY 1), m AS (SELECT s_suppkey AS l_suppkey, 600::BIGINT AS expected FROM supplier WHERE s_suppkey % 8 <> 0)
SELECT l_suppkey, found, expected, CASE WHEN found IS NULL THEN 'missing' WHEN expected IS NULL THEN 'unexpected' WHEN found = expected THEN 'ok' ELSE 'different' END AS verdict FROM f FULL OUTER JOIN m USING (l_suppkey)""",
)
def hk07(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "supplier").where("s_suppkey % 8 <> 0").select(F.col("s_suppkey").alias("l_suppkey"), F.lit(600).cast("long").alias("e"))
    return housekeeping.against_manifest(table(spark, d, "lineitem").where("l_suppkey % 9 <> 0"), m, "l_suppkey", "e")


@query("hk09_parser_agreement", "WITH a AS (SELECT DISTINCT user_id, event_type FROM events WHERE value < 5), b AS (SELECT DISTINCT user_id, event_type FROM events WHERE value > 5) SELECT (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS n_both, (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS n_first_only, (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS n_second_only")
def hk09(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return housekeeping.parser_agreement(e.where("value < 5"), e.where("value > 5"), ["user_id", "event_type"])


@query("src10_markup_extraction", r"""SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title, len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS n_links FROM pages""")
def src10(spark: SparkSession, d: str) -> DataFrame:
    links = F.size(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).cast("long")
    return table(spark, d, "pages").select("page_id", F.nullif(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("")).alias("title"), links.alias("n_links"))


@query("win06_hash_examples", "SELECT o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5_number_lower(o_orderkey || ':1'), o_orderkey) <= 5")
def win06(spark: SparkSession, d: str) -> DataFrame:
    o = hashing.md5_lower(F.concat(F.col("o_orderkey").cast("string"), F.lit(":1")))
    w = Window.partitionBy("o_orderpriority").orderBy("o", "o_orderkey")
    return table(spark, d, "orders").select("o_orderpriority", "o_orderkey", o.alias("o")).withColumn("r", F.row_number().over(w)).where("r <= 5").select("o_orderpriority", "o_orderkey")
