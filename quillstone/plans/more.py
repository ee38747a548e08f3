"""Further queries of the catalog: normal forms, filters, set operations, summaries, checks and models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import bands, dates, names, natures, text
from quillstone.operators import cohort, evaluate, housekeeping, inventory, models, ownership, population, register, sampling
from quillstone.plans.catalog import QUERIES, query, table


def pick(values: tuple[str, ...], index) -> Column:
    return F.get(F.array(*map(F.lit, values)), index.cast("int"))


def pick_sql(values: tuple[str, ...], index: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][CAST({index} AS INTEGER) + 1]"


_COUNTRIES = ("England", " united  kingdom.", "U.K.", "France", "GB", "Wales & co")


@query("nrm07_country", f"WITH c AS (SELECT c_custkey, trim(regexp_replace(regexp_replace(trim(lower({pick_sql(_COUNTRIES, 'c_custkey % 6')})), '\\.+$', ''), '\\s+', ' ', 'g')) AS country FROM customer) SELECT *, country IN ('england', 'united kingdom', 'u.k', 'gb') AS uk FROM c")
def nrm07(spark: SparkSession, d: str) -> DataFrame:
    raw = pick(_COUNTRIES, F.col("c_custkey") % 6)
    return table(spark, d, "customer").select("c_custkey", text.country(raw).alias("country"), text.is_uk(raw).alias("uk"))


@query("nrm09_sic_parsers", "SELECT p_partkey, nullif(regexp_extract(s, '^\\s*(\\d+)', 1), '') AS digits, nullif(trim(split_part(s, ' - ', 1)), '') AS dash FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN ' ' || p_partkey || ' - x' WHEN 1 THEN p_partkey || 'a - y' ELSE 'none' END AS s FROM part)")
def nrm09(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    s = F.when(k % 3 == 0, F.concat(F.lit(" "), k, F.lit(" - x"))).when(k % 3 == 1, F.concat(k, F.lit("a - y"))).otherwise("none")
    return table(spark, d, "part").select("p_partkey", text.sic_leading_digits(s).alias("digits"), text.sic_before_dash(s).alias("dash"))


_KINDS = (*natures.LINE_KINDS, "new-kind")


@query("nrm13_kinds", "SELECT p_partkey, CASE k " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in natures.KINDS.items()) + " ELSE 'other' END AS category, CASE k " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in natures.LINE_KINDS.items()) + f" ELSE 'unknown' END AS line_category FROM (SELECT p_partkey, {pick_sql(_KINDS, 'p_partkey % 12')} AS k FROM part)")
def nrm13(spark: SparkSession, d: str) -> DataFrame:
    kind = pick(_KINDS, F.col("p_partkey") % 12)
    return table(spark, d, "part").select("p_partkey", natures.kind_category(kind).alias("category"), natures.line_category(kind).alias("line_category"))


_CASES = ("Compulsory Liquidation", "Creditors' Voluntary Liquidation", "Administration to CVL", "Company Voluntary Arrangement", "cva", "Receivership")


@query("nrm14_case_type", f"SELECT o_orderkey, {pick_sql(('compulsory_liquidation', 'creditors_voluntary_liquidation', 'administration', 'corporate_voluntary_arrangement', 'corporate_voluntary_arrangement', 'other'), 'o_orderkey % 6')} AS case_type FROM orders")
def nrm14(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", text.case_type(pick(_CASES, F.col("o_orderkey") % 6)).alias("case_type"))


@query("nrm20_value_shape", f"SELECT p_partkey, {pick_sql(('empty', 'name', 'code', 'free-text', 'other'), 'p_partkey % 5')} AS shape FROM part")
def nrm20(spark: SparkSession, d: str) -> DataFrame:
    raw = pick(("", "Ann Lee", "AB-12", "a b c d e f", "x"), F.col("p_partkey") % 5)
    return table(spark, d, "part").select("p_partkey", text.value_shape(raw).alias("shape"))


@query("nrm21_equality_tiers", f"SELECT p_partkey, {pick_sql(('exact', 'decimal', 'collapsed', 'stripped', 'mismatch: prefix', 'mismatch: other'), 'p_partkey % 6')} AS tier FROM part")
def nrm21(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 6
    return table(spark, d, "part").select("p_partkey", text.equality_tier(pick(("a", "1.0", "a  b", "a b", "ab", "ab"), k), pick(("a", "1", "a b", "ab", "abc", "xy"), k)).alias("tier"))


@query("nrm25_obscured", "SELECT c_custkey, replace('Prod1_' || c_name || '.html', c_name, repeat('X', length(c_name))) AS member FROM customer")
def nrm25(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", bands.obscured_member(F.concat(F.lit("Prod1_"), "c_name", F.lit(".html")), F.col("c_name")).alias("member"))


@query("flt05_active", "SELECT o_orderkey FROM orders WHERE lower(trim(o_orderstatus)) IN ('f')")
def flt05(spark: SparkSession, d: str) -> DataFrame:
    return cohort.label_cohort(table(spark, d, "orders"), "o_orderstatus", ("f",), ("o",)).where("cohort = 'case'").select("o_orderkey")


@query("flt08_month_window", "SELECT l_orderkey, count(*) FILTER ((1998 - year(l_shipdate)) * 12 + 6 - month(l_shipdate) BETWEEN 0 AND 23) AS n_last_24m FROM lineitem GROUP BY 1")
def flt08(spark: SparkSession, d: str) -> DataFrame:
    months = dates.months_since(F.lit(199806), F.col("l_shipdate"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_if(months.between(0, 23)).alias("n_last_24m"))


@query("flt09_date_flags", "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate < o_orderdate AS ceased_before_notified, o_orderdate < DATE '2016-04-06' AS before_regime, NOT year(l_shipdate) BETWEEN 1993 AND 1999 AS ceased_year_odd, year(o_orderdate) - 1980 < 16 AS under_16 FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def flt09(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", *ownership.date_flags(F.to_date("o_orderdate"), F.to_date("l_shipdate"), F.lit(1980), 1993, 1999))


@query("jn18_quota_draw", "WITH r AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5_number_lower(o_orderkey || ':5'), o_orderkey) AS r FROM orders) SELECT o_orderkey, o_orderpriority FROM r WHERE r <= CASE o_orderpriority WHEN '1-URGENT' THEN 30 WHEN '5-LOW' THEN 1000000 ELSE 0 END")
def jn18(spark: SparkSession, d: str) -> DataFrame:
    quotas = spark.createDataFrame([("1-URGENT", 30), ("5-LOW", 1_000_000)], "o_orderpriority string, quota int")
    return sampling.quota_draw(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), quotas, "o_orderpriority", "o_orderkey", 5)


@query("smp04_shortfall", "SELECT q.o_orderpriority, quota, coalesce(n, 0) AS available, greatest(quota - coalesce(n, 0), 0) AS short FROM (VALUES ('1-URGENT', 30), ('none', 5), ('5-LOW', 1000000)) q(o_orderpriority, quota) LEFT JOIN (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) USING (o_orderpriority)")
def smp04(spark: SparkSession, d: str) -> DataFrame:
    quotas = spark.createDataFrame([("1-URGENT", 30), ("none", 5), ("5-LOW", 1_000_000)], "o_orderpriority string, quota int")
    return sampling.shortfall(table(spark, d, "orders"), quotas, "o_orderpriority")


@query("smp08_weights", "SELECT o_orderpriority, count(*) AS n, sum(n_all::DOUBLE / quota) AS total FROM (SELECT o_orderpriority, row_number() OVER w AS r, count(*) OVER (PARTITION BY o_orderpriority) AS n_all, round_even(count(*) OVER (PARTITION BY o_orderpriority) * 0.05::DOUBLE, 0) AS quota FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey)) WHERE r <= quota GROUP BY 1")
def smp08(spark: SparkSession, d: str) -> DataFrame:
    drawn = sampling.stratified(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 3, 0.05)
    return drawn.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("total"))


@query("set01_union_branches", "SELECT o_orderkey AS k, 'total' AS side, o_totalprice AS v FROM orders UNION ALL SELECT l_orderkey, 'part', l_extendedprice FROM lineitem")
def set01(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.lit("total").alias("side"), F.col("o_totalprice").alias("v"))
    b = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.lit("part").alias("side"), F.col("l_extendedprice").alias("v"))
    return a.unionByName(b)


@query("set04_diagonal_concat", "SELECT c_custkey AS k, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS name FROM customer UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier")
def set04(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance")), table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


@query("set05_distinct_keys", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def set05(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("agg10_anomaly_stats", "SELECT count(*) AS n, min(l_quantity) AS least, median(l_quantity) AS median, max(l_quantity) AS most, count(*) FILTER (l_quantity <= 10) AS n_small, count(*) FILTER (l_quantity > 10) AS n_large FROM lineitem WHERE l_returnflag = 'R'")
def agg10(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").where("l_returnflag = 'R'").agg(F.count(F.lit(1)).alias("n"), F.min(q).alias("least"), F.median(q).alias("median"), F.max(q).alias("most"), F.count_if(q <= 10).alias("n_small"), F.count_if(q > 10).alias("n_large"))


_TYPES = ("view", "click", "purchase", "signup", "error")


@query("agg11_counts_per_company", "SELECT user_id, count(*) AS n_all, " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS n_{t}" for t in _TYPES) + ", CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'identified' WHEN count(*) FILTER (event_type = 'view') > 0 THEN 'statement_only' ELSE 'none_reported' END AS state FROM events GROUP BY 1")
def agg11(spark: SparkSession, d: str) -> DataFrame:
    n = {t: F.count_if(F.col("event_type") == t) for t in _TYPES}
    state = F.when(n["purchase"] > 0, "identified").when(n["view"] > 0, "statement_only").otherwise("none_reported")
    return table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_all"), *(c.alias(f"n_{t}") for t, c in n.items()), state.alias("state"))


_CODES = ("ownership-of-shares-25-to-50-percent", "ownership-of-shares-75-to-100-percent-as-firm", "voting-rights-50-to-75-percent", "right-to-appoint-and-remove-directors", "significant-influence-or-control-as-trust", "odd-right")


@query(
    "agg13_nature_summary",
    "WITH n AS (SELECT l_suppkey, (l_suppkey % 5 + l_partkey % 3) % 6 AS c FROM lineitem) SELECT l_suppkey, CASE max(CASE c WHEN 0 THEN 1 WHEN 1 THEN 3 END) WHEN 1 THEN '25-to-50-percent' WHEN 3 THEN '75-to-100-percent' END AS ownership, CASE WHEN bool_or(c = 2) THEN '50-to-75-percent' END AS voting, bool_or(c = 3) AS appoints, bool_or(c = 4) AS influence, count(DISTINCT c) AS n_distinct, CASE WHEN bool_or(c = 5) THEN 'odd-right' END AS unmapped FROM n GROUP BY 1",
)
def agg13(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "lineitem").select("l_suppkey", pick(_CODES, (F.col("l_suppkey") % 5 + F.col("l_partkey") % 3) % 6).alias("code")).withColumn("n", natures.decompose(F.col("code")))
    rank = lambda core: natures.band_of_rank(F.max(F.when(F.col("n.core") == core, natures.band_rank(F.col("n.band")))))
    has = lambda core: F.bool_or(F.coalesce(F.col("n.core") == core, F.lit(False)))
    return n.groupBy("l_suppkey").agg(
        rank("ownership-of-shares").alias("ownership"),
        rank("voting-rights").alias("voting"),
        has("right-to-appoint-and-remove").alias("appoints"),
        has(natures.ALONE).alias("influence"),
        F.count_distinct("code").alias("n_distinct"),
        F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(F.col("n.core").isNull(), F.col("code")))), ","), F.lit("")).alias("unmapped"),
    )


@query("agg16_sic_summary", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 2 END AS n_codes, p_partkey % 5 = 0 AS dormant FROM part")
def agg16(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    first = F.when(k % 5 == 0, "99999 - Dormant").otherwise("62012 - Software")
    rows = table(spark, d, "part").select("p_partkey", first.alias("a"), F.when(k % 4 == 0, first).otherwise("01110 - Growing").alias("b"), F.lit(None).cast("string").alias("c"))
    codes = register.sic_codes(["a", "b", "c"])
    return rows.select("p_partkey", F.size(codes).alias("n_codes"), F.array_contains(codes, register.DORMANT).alias("dormant"))


@query("agg22_cohort_flow", "SELECT CASE WHEN o_orderstatus = 'F' THEN 'case' WHEN o_orderstatus = 'O' THEN 'comparison' ELSE 'other' END AS cohort, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM orders GROUP BY 1")
def agg22(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    rows = cohort.label_cohort(table(spark, d, "orders"), "o_orderstatus", ("f",), ("o",)).groupBy("cohort").agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("share", F.col("n").cast("double") / F.sum("n").over(Window.partitionBy()))


@query("agg32_integrity_sums", "SELECT l_returnflag, count(*) AS facts_seen, count(*) FILTER (l_discount <= 0.05) AS kept, count(*) FILTER (l_discount > 0.05) AS skipped, TRUE AS closes FROM lineitem GROUP BY 1")
def agg32(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("facts_seen"), F.count_if(F.col("l_discount") <= 0.05).alias("kept"), F.count_if(F.col("l_discount") > 0.05).alias("skipped"))
    return n.withColumn("closes", F.col("kept") + F.col("skipped") == F.col("facts_seen"))


@query(
    "agg34_dimensional_fallback",
    "WITH g AS (SELECT user_id, event_type, count(*) FILTER (value < 1) AS totals, count(DISTINCT value >= 3) AS d, bool_or(value >= 3) AS v FROM events GROUP BY 1, 2) SELECT user_id, event_type, v FROM g WHERE totals = 0 AND d = 1",
)
def agg34(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count_if(F.col("value") < 1).alias("totals"), F.min(F.col("value") >= 3).alias("a"), F.max(F.col("value") >= 3).alias("v"))
    return g.where("totals = 0 AND a = v").select("user_id", "event_type", "v")


@query("jn20_covered_by_category", "SELECT c_mktsegment AS category, count(*) AS n, count(*) FILTER (k IS NOT NULL) AS n_covered FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P') ON k = c_custkey GROUP BY 1")
def jn20(spark: SparkSession, d: str) -> DataFrame:
    some = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("there")).distinct()
    return table(spark, d, "customer").join(some, "c_custkey", "left").groupBy(F.col("c_mktsegment").alias("category")).agg(F.count(F.lit(1)).alias("n"), F.count("there").alias("n_covered"))


@query("jn19_notification_lag", "WITH l AS (SELECT date_diff('day', o_orderdate, l_shipdate) AS lag FROM lineitem JOIN orders ON o_orderkey = l_orderkey) SELECT CASE WHEN lag < 0 THEN 'negative' WHEN lag <= 14 THEN '0-14' WHEN lag <= 28 THEN '15-28' WHEN lag <= 90 THEN '29-90' WHEN lag <= 365 THEN '91-365' ELSE '366+' END AS lag, count(*) AS n FROM l GROUP BY 1")
def jn19(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy(bands.lag_days(F.datediff("l_shipdate", "o_orderdate")).alias("lag")).agg(F.count(F.lit(1)).alias("n"))


@query("jn13_range_join", "SELECT c.c_custkey, max(o_totalprice) AS best, count(o_orderkey) AS n FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderdate <= DATE '1996-01-01' + to_days(CAST(c.c_custkey % 300 AS INTEGER)) GROUP BY 1")
def jn13(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", F.date_add(F.lit("1996-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int")).alias("cutoff"))
    j = c.join(table(spark, d, "orders"), (F.col("o_custkey") == F.col("c_custkey")) & (F.to_date("o_orderdate") <= F.col("cutoff")), "left")
    return j.groupBy("c_custkey").agg(F.max("o_totalprice").alias("best"), F.count("o_orderkey").alias("n"))


@query("agg09_label_agreement", "SELECT lang, count(*) AS n, count(*) FILTER (quality = 1) AS n_agree FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def labels_by_language(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    return inventory.wilson(j, ["lang"], F.col("quality") == 1).select("lang", "n", "n_agree")


@query("jn12_audit_by_segment", "WITH o AS (SELECT o_orderkey % 3 <> 0 AS b, year(o_orderdate) AS y FROM orders) SELECT y, 'p' AS \"column\", count(*) FILTER (b) AS n_both, count(*) FILTER (NOT b) AS n_baseline_only, 0 AS n_candidate_only, 0 AS n_same, count(*) FILTER (b) AS n_changed, 0 AS n_filled, 0 AS n_emptied FROM o GROUP BY 1")
def audit_by_year(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.year("o_orderdate").alias("y"), F.col("o_totalprice").alias("p"))
    return population.full_outer_audit(o, o.where("k % 3 <> 0").withColumn("p", F.col("p") + 1), ["k", "y"], ["p"], ["y"])


@query("ml10_sample_identity")
def ml10(spark: SparkSession, d: str) -> DataFrame:
    return models.sample_identity(table(spark, d, "customer"), "c_custkey")


@query("ml05_logistic_regression")
def ml05(spark: SparkSession, d: str) -> DataFrame:
    rows = models.prepare(table(spark, d, "part").withColumn("y", (F.col("p_retailprice") > 1000).cast("double")).withColumn("w", F.lit(1.0)), ["p_size"], ["p_type"])
    model = models.fit(rows, ["p_size"], ["p_type"], "y", "w", 1.0)
    return models.metrics(models.scored(model, rows), "y", "w")


@query("agg26_tests")
def agg26_tests(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("k"))
    rows = n.collect()  # five priorities
    total, hits = sum(r.n for r in rows), sum(r.k for r in rows)
    tests = [(r.o_orderpriority, evaluate.two_proportions_p(r.k, r.n, hits - r.k, total - r.n)) for r in rows]
    return evaluate.benjamini_hochberg(spark.createDataFrame(tests, "test string, p double"), "p", "test")


@query("flt06_exclusion_list", "SELECT c_custkey, c_mktsegment FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')")
def flt06(spark: SparkSession, d: str) -> DataFrame:
    urgent = table(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return cohort.excluding(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), urgent, "c_custkey")


@query("hk06_scope_coverage", """WITH asked AS (SELECT DISTINCT l_suppkey AS scope, l_partkey AS item FROM lineitem), have AS (SELECT DISTINCT l_suppkey AS scope, l_partkey AS item FROM lineitem WHERE l_returnflag <> 'R')
SELECT scope, count(*) AS n_requested, count(h.item) AS n_stored, count(*) - count(h.item) AS n_missing, count(*) = count(h.item) AS covered FROM asked LEFT JOIN have h USING (scope, item) GROUP BY scope""")
def hk06(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("scope"), F.col("l_partkey").alias("item"), "l_returnflag")
    return housekeeping.scope_coverage(asked.where("l_returnflag <> 'R'"), asked, "scope", "item")


ENDINGS = ("EndDate", "companynumber", "AccountingPolicy", "Number", "Costs", "EmployeesDuringPeriod", "CashAtPeriodEnd", "Dates", "Ratio")


@query("nrm27_names_and_units", f"""WITH n AS (SELECT p_partkey, replace(p_name, ' ', '') || {pick_sql(ENDINGS, "p_size % 9")} AS name, p_type || '/' || substr(p_brand, 1, 3) AS unit FROM part)
SELECT p_partkey, CASE WHEN lower(name) LIKE '%companynumber' THEN 'identifier' WHEN name LIKE '%Number' OR name LIKE '%Costs' OR name LIKE '%DuringPeriod' OR name LIKE '%AtPeriodEnd' OR name LIKE '%Ratio' THEN 'numeric' WHEN name LIKE '%Date' OR name LIKE '%Policy' THEN 'text' ELSE 'other' END AS kind,
array_to_string(list_transform(string_split(unit, '/'), lambda x: CASE WHEN regexp_full_match(upper(x), '[A-Z]{{3}}') THEN 'currency' ELSE lower(x) END), '/') AS family FROM n""")
def nrm27(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("")), pick(ENDINGS, F.col("p_size") % 9))
    unit = F.concat("p_type", F.lit("/"), F.substring("p_brand", 1, 3))
    return table(spark, d, "part").select("p_partkey", names.name_kind(name).alias("kind"), names.unit_family(unit).alias("family"))


def catalog_queries() -> dict:
    """All queries, those of this module included."""
    return QUERIES
