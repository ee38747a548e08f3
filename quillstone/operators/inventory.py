"""Inventories, histograms, distributions and panel checks of long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def member_histogram(facts: DataFrame, by: list[str], company: str, period: str) -> DataFrame:
    """Facts, companies and company-periods per group. Pairs are counted as structs, so null periods count."""
    return facts.groupBy(*by).agg(F.count(F.lit(1)).alias("n_facts"), F.count_distinct(company).alias("n_companies"), F.count_distinct(F.struct(company, period)).alias("n_company_periods"))


def unit_distribution(values: DataFrame, by: list[str], value: str, cutoff_quantile: float = 0.999) -> DataFrame:
    """Count, median, high percentiles and maximum per group, and how many values lie above the quantile of all values."""
    cutoff = values.agg(F.percentile(value, F.lit(cutoff_quantile)).alias("cutoff"))  # one row
    q = F.percentile(value, F.array(*map(F.lit, (0.5, 0.99, 0.999, 0.9999))))
    out = values.crossJoin(F.broadcast(cutoff)).groupBy(*by).agg(F.count(value).alias("n"), q.alias("q"), F.max(value).alias("max_value"), F.count_if(F.col(value) > F.col("cutoff")).alias("n_above"), F.count_if(F.col(value) <= F.col("cutoff")).alias("n_kept"))
    return out.select(*by, "n", *(F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("median", "p99", "p999", "p9999"))), "max_value", "n_above", "n_kept")


def concept_inventory(facts: DataFrame, concept: str, company: str, value: str, exact: bool = True, examples: int = 3) -> DataFrame:
    """Per concept: facts, companies (exact or approximate), share of null values and the first few distinct values in order."""
    companies = F.count_distinct(company) if exact else F.approx_count_distinct(company, 0.02)
    return facts.groupBy(concept).agg(
        F.count(F.lit(1)).alias("n_facts"),
        companies.alias("n_companies"),
        (F.count_if(F.col(value).isNull()).cast("double") / F.count(F.lit(1))).alias("null_share"),
        F.array_join(_least(value, examples), "|").alias("examples"),
    )


def _least(value: str, n: int) -> Column:
    """The n least distinct values as text. The set is of distinct values: for columns of bounded vocabulary."""
    return F.slice(F.array_sort(F.collect_set(F.col(value).cast("string"))), 1, n)


def distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, n, p50, p90, p99, max of numeric columns, from one pass."""
    each = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns))
    long = df.select(F.explode(each).alias("x")).select("x.*").where("v is not null")
    q = long.groupBy("column").agg(F.count("v").alias("n"), F.percentile("v", F.array(*map(F.lit, (0.5, 0.9, 0.99)))).alias("q"), F.max("v").alias("max_value"))
    return q.select("column", "n", *(F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("p50", "p90", "p99"))), "max_value")


def panel(rows: DataFrame, company: str, period: Column) -> DataFrame:
    """Companies by their number of distinct periods: 1, 2, 3 and 4+."""
    per = rows.groupBy(company).agg(F.count_distinct(period).alias("n"))
    return per.groupBy(F.when(F.col("n") >= 4, "4+").otherwise(F.col("n").cast("string")).alias("n_periods")).agg(F.count(F.lit(1)).alias("n_companies"))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values, ties by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), column).limit(n)


def crosstab(df: DataFrame, row: Column, row_name: str, column: str, values: list[str]) -> DataFrame:
    """Counts of `values` of a column per row value."""
    return df.groupBy(row.alias(row_name)).agg(*(F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values))


def monotone_parts(rows: DataFrame, part: str, order: str, value: str) -> DataFrame:
    """Per part: rows and how often the value falls from one row to the next. Parts are files or other bounded pieces."""
    before = F.lag(value).over(Window.partitionBy(part).orderBy(order))
    return rows.withColumn("__b", before).groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(value) < F.col("__b")).alias("n_falls"))


def wilson(rows: DataFrame, by: list[str], agree: Column, z: float = 1.96) -> DataFrame:
    """Agreement rate with its Wilson interval per group."""
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(agree).alias("n_agree"))
    p, n = F.col("n_agree").cast("double") / F.col("n"), F.col("n").cast("double")
    centre, half = (p + z * z / (2 * n)) / (1 + z * z / n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return out.withColumns({"rate": p, "low": centre - half, "high": centre + half})


def collapse_duplicates(facts: DataFrame, key: list[str], agreement: str, order: Column) -> DataFrame:
    """Facts of one key: where all agree, the first with the number collapsed and status selected; else all, as conflict."""
    value = F.coalesce(F.col(agreement).cast("string"), F.lit("\0"))
    n = facts.groupBy(*key).agg(F.count_distinct(value).alias("__v"), F.count(F.lit(1)).alias("n_same"), F.min(order).alias("__first"))
    n = n.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(key)})
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)]  # totals have a null dimension
    one = F.col("__v") == 1
    marked = facts.withColumn("__o", order).join(n, same).where(~one | (F.col("__o") == F.col("__first")))
    return marked.withColumn("status", F.when(one, "selected").otherwise("conflict")).drop("__o", "__v", "__first", *(f"__k{i}" for i in range(len(key))))
