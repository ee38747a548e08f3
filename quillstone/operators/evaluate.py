"""Effect sizes, tests and weighted metrics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def describe(df: DataFrame, group: str, value: str) -> DataFrame:
    """Count, mean, sample deviation and quartiles of a value per group."""
    out = df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    return out.select(group, "n", "mean", "sd", *(F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("q25", "median", "q75"))))


def binary_effects(df: DataFrame, case: Column, exposed: Column, z: float = 1.96) -> DataFrame:
    """One row: the 2x2 table, risk ratio and odds ratio with intervals; a half is added to all cells if one is 0."""
    n = df.agg(F.count_if(case & exposed).alias("a"), F.count_if(case & ~exposed).alias("b"), F.count_if(~case & exposed).alias("c"), F.count_if(~case & ~exposed).alias("d"))
    add = F.when(F.least("a", "b", "c", "d") == 0, 0.5).otherwise(0.0)
    a, b, c, d = (F.col(x) + add for x in "abcd")
    lrr, lor = F.log((a / (a + b)) / (c / (c + d))), F.log(a * d / (b * c))
    se_rr, se_or = F.sqrt(1 / a - 1 / (a + b) + 1 / c - 1 / (c + d)), F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    return n.withColumns({"rr": F.exp(lrr), "rr_low": F.exp(lrr - z * se_rr), "rr_high": F.exp(lrr + z * se_rr), "odds": F.exp(lor), "or_low": F.exp(lor - z * se_or), "or_high": F.exp(lor + z * se_or)})


def mean_difference(df: DataFrame, case: Column, value: str) -> DataFrame:
    """One row: standardised mean difference and Welch's t of cases against the rest."""
    m = df.agg(*(f(F.when(side, F.col(value))).alias(f"{n}{k}") for k, side in (("1", case), ("0", ~case)) for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))))
    pooled = F.sqrt((F.col("v1") + F.col("v0")) / 2)
    return m.withColumns({"smd": F.try_divide(F.col("m1") - F.col("m0"), pooled), "welch_t": F.try_divide(F.col("m1") - F.col("m0"), F.sqrt(F.col("v1") / F.col("n1") + F.col("v0") / F.col("n0")))})


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: chi-square, degrees of freedom and Cramer's V of two columns."""
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    rows, cols = cells.groupBy(a).agg(F.sum("o").alias("r")), cells.groupBy(b).agg(F.sum("o").alias("c"))
    # Chi-square = n * (sum of o^2 / (r c) - 1): cells without rows need not be made.
    s = cells.join(rows, a).join(cols, b).agg(F.sum(F.col("o") * F.col("o") / (F.col("r").cast("double") * F.col("c"))).alias("s"), F.sum("o").alias("n"))
    shape = rows.agg(F.count(F.lit(1)).alias("k")).crossJoin(cols.agg(F.count(F.lit(1)).alias("l")))  # one row each
    out = s.crossJoin(shape).withColumn("chi2", F.col("n") * (F.col("s") - 1)).withColumn("df", (F.col("k") - 1) * (F.col("l") - 1))
    return out.select("n", "chi2", "df", F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * (F.least("k", "l") - 1))).alias("cramers_v"))


def rank_effect(df: DataFrame, case: Column, value: str, weight: Column) -> DataFrame:
    """One row: weighted rank-biserial effect, P(case above) - P(case below), ties half; values are grouped before they are ranked."""
    per = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.sum(F.when(case, weight).otherwise(0.0)).alias("wc"), F.sum(F.when(case, 0.0).otherwise(weight)).alias("wo"))
    below = F.coalesce(F.sum("wo").over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    s = per.withColumn("below", below).agg(F.sum(F.col("wc") * (F.col("below") + F.col("wo") / 2)).alias("s"), F.sum("wc").alias("c"), F.sum("wo").alias("o"))
    return s.select((F.try_divide(2 * F.col("s"), F.col("c") * F.col("o")) - 1).alias("effect"), F.col("c").alias("weight_cases"), F.col("o").alias("weight_others"))


def weighted_auc(df: DataFrame, label: str, score: str, weight: Column) -> DataFrame:
    """One row: weighted ROC-AUC and average precision from cumulative sums over the distinct scores, highest first."""
    per = df.groupBy(score).agg(F.sum(F.when(F.col(label) == 1, weight).otherwise(0.0)).alias("p"), F.sum(F.when(F.col(label) == 1, 0.0).otherwise(weight)).alias("n"))
    w = Window.orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, 0)
    c = per.withColumn("cp", F.sum("p").over(w)).withColumn("cn", F.sum("n").over(w))
    s = c.agg(F.sum(F.col("n") * (F.col("cp") - F.col("p") / 2)).alias("a"), F.sum(F.col("p") * F.col("cp") / (F.col("cp") + F.col("cn"))).alias("ap"), F.sum("p").alias("sp"), F.sum("n").alias("sn"))
    return s.select(F.try_divide("a", F.col("sp") * F.col("sn")).alias("roc_auc"), F.try_divide("ap", "sp").alias("average_precision"))


def log_loss(df: DataFrame, label: str, score: str, weight: Column, least: float = 1e-15) -> DataFrame:
    """One row: weighted log loss and Brier score."""
    p = F.least(F.greatest(F.col(score), F.lit(least)), F.lit(1 - least))
    y = F.col(label).cast("double")
    loss = -(y * F.log(p) + (1 - y) * F.log(1 - p))
    return df.agg((F.sum(loss * weight) / F.sum(weight)).alias("log_loss"), (F.sum((p - y) * (p - y) * weight) / F.sum(weight)).alias("brier"))


def benjamini_hochberg(df: DataFrame, p: str, key: str) -> DataFrame:
    """df with q: the least p * n / rank of this or a larger p. For tables of tests, which are small."""
    up = Window.orderBy(p, key)
    ranked = df.withColumn("__r", F.row_number().over(up)).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy()))
    down = Window.orderBy(F.col(p).desc(), F.col(key).desc()).rowsBetween(Window.unboundedPreceding, 0)
    return ranked.withColumn("q", F.least(F.lit(1.0), F.min(F.col(p) * F.col("__n") / F.col("__r")).over(down))).drop("__r", "__n")


def two_proportions_p(a: int, n: int, b: int, m: int) -> float:
    """Two-sided p of the difference of a/n and b/m by the pooled z test."""
    pooled = (a + b) / (n + m)
    se = math.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    return 1.0 if not se else math.erfc(abs(a / n - b / m) / se / math.sqrt(2))


def bootstrap_deltas(df: DataFrame, key: str, metric: str, group: str, replicates: int, seed: int) -> DataFrame:
    """replicate, group, weighted mean of a metric under Poisson(1) weights drawn from a hash of key and replicate.

    Rows are sent out once per replicate and summed before the shuffle; equal keys get equal weights in all groups (pairs).
    """
    u = F.pmod(F.xxhash64(F.col(key), F.col("replicate"), F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    weight, cumulative, term = F.lit(0), 0.0, math.exp(-1)
    for k in range(9):
        cumulative += term
        weight = weight + F.when(u >= cumulative, 1).otherwise(0)
        term /= k + 1
    rows = df.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("__w", weight)
    return rows.groupBy("replicate", group).agg(F.try_divide(F.sum(F.col(metric) * F.col("__w")), F.sum("__w")).alias("value"))
