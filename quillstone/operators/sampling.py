"""Deterministic hash sampling, strata, quotas, splits and weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions.hashing import md5_bucket, md5_lower


def _order(key: str, seed: int | str) -> Column:
    return md5_lower(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def hash_sample(df: DataFrame, key: str, seed: int | str, n: int) -> DataFrame:
    """The n rows of least hash; ties by key. One distributed top-n, no sort of all rows."""
    return df.withColumn("__o", _order(key, seed)).orderBy("__o", key).limit(n).drop("__o")


def split(df: DataFrame, key: str, seed: int | str, n: int = 10, test: int = 2) -> DataFrame:
    """df with bucket and part: test for the first `test` of n hash buckets, else train."""
    bucket = md5_bucket(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")), n)
    return df.withColumn("bucket", bucket).withColumn("part", F.when(F.col("bucket") < test, "test").otherwise("train"))


def stratified(df: DataFrame, stratum: str, key: str, seed: int | str, rate: float) -> DataFrame:
    """Of each stratum the rows of least hash, as many as its size times the rate, rounded half to even; weight: size / drawn."""
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("__n")).withColumn("__quota", F.bround(F.col("__n") * rate).cast("long"))
    ranked = df.withColumn("__o", _order(key, seed)).withColumn("__r", F.row_number().over(Window.partitionBy(stratum).orderBy("__o", key)))
    return ranked.join(sizes, stratum).where("__r <= __quota").withColumn("weight", F.col("__n").cast("double") / F.col("__quota")).drop("__o", "__r", "__n", "__quota")


def quota_draw(df: DataFrame, quotas: DataFrame, stratum: str, key: str, seed: int | str) -> DataFrame:
    """Of each stratum as many rows as `quotas` (stratum, quota) says, or all it has, by hash."""
    ranked = df.join(quotas, stratum).withColumn("__o", _order(key, seed)).withColumn("__r", F.row_number().over(Window.partitionBy(stratum).orderBy("__o", key)))
    return ranked.where("__r <= quota").drop("__o", "__r", "quota")


def shortfall(df: DataFrame, quotas: DataFrame, stratum: str) -> DataFrame:
    """stratum, available, quota, short: what a quota draw can't fill."""
    have = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("available"))
    out = quotas.join(have, stratum, "left").withColumn("available", F.coalesce("available", F.lit(0)))
    return out.withColumn("short", F.greatest(F.col("quota") - F.col("available"), F.lit(0)))


def cells(df: DataFrame, precedence: list[tuple[str, Column]], per_cell: int, key: str, seed: int | str) -> DataFrame:
    """Disjoint cells, a row in the first whose condition holds; of each the rows of least hash, with weight cell size / drawn."""
    name = F.lit(None).cast("string")
    for label, condition in reversed(precedence):
        name = F.when(condition, label).otherwise(name)
    rows = df.withColumn("cell", name).where("cell is not null")
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("__n"))
    ranked = rows.withColumn("__o", _order(key, seed)).withColumn("__r", F.row_number().over(Window.partitionBy("cell").orderBy("__o", key)))
    drawn = ranked.where(F.col("__r") <= per_cell).join(F.broadcast(sizes), "cell")  # a row per cell
    return drawn.withColumn("weight", F.col("__n").cast("double") / F.least(F.col("__n"), F.lit(per_cell))).drop("__o", "__r", "__n")


def evenly_spaced(df: DataFrame, group: str, order: list[str], k: int) -> DataFrame:
    """Of each group the rows at places floor(i * n / k) of its order, i from 0 to k - 1; all if it has no more than k."""
    n = df.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    rows = df.withColumn("__i", F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1).join(n, group)
    # A place p is chosen if some i has floor(i n / k) = p: i = ceil(p k / n).
    i = F.ceil(F.col("__i") * k / F.col("__n"))
    return rows.where((F.col("__n") <= k) | ((i < k) & (F.floor(i * F.col("__n") / k) == F.col("__i")))).drop("__i", "__n")
