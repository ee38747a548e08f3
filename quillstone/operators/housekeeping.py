"""Manifests, retention, leak scans and published counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Forms that published text must not hold.
COMPANY_NUMBER = r"\b([0-9]{8}|[A-Z]{2}[0-9]{6})\b"
LONG_HEX = r"\b[0-9a-f]{64}\b"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def leak_scan(texts: DataFrame, text: str, by: list[str]) -> DataFrame:
    """Rows and those with company numbers, 64-digit hashes and e-mail addresses, and how many of each, per group."""
    n = {"company_numbers": F.regexp_count(text, F.lit(COMPANY_NUMBER)), "hashes": F.regexp_count(text, F.lit(LONG_HEX)), "emails": F.regexp_count(text, F.lit(EMAIL))}
    rows = texts.select(*by, *(v.alias(k) for k, v in n.items()))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(F.col(k) > 0).alias(f"rows_{k}") for k in n), *(F.coalesce(F.sum(k), F.lit(0)).alias(f"n_{k}") for k in n))


def retention(snapshots: DataFrame, date: str) -> DataFrame:
    """Dates to keep: the first of each month and the last of all, with the reason."""
    days = snapshots.select(F.to_date(date).alias("d")).where("d is not null").distinct()
    first = days.groupBy(F.trunc("d", "MM").alias("m")).agg(F.min("d").alias("keep_date")).select("keep_date", F.lit("first_of_month").alias("reason"))
    last = days.agg(F.max("d").alias("keep_date")).where("keep_date is not null").select("keep_date", F.lit("latest").alias("reason"))
    return first.unionByName(last).groupBy("keep_date").agg(F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reason"))


def month_gaps(snapshots: DataFrame, date: str) -> DataFrame:
    """Months between the first and the last that have no snapshot."""
    have = snapshots.select(F.trunc(F.to_date(date), "MM").alias("month")).where("month is not null").distinct()
    all_ = have.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    return all_.join(have, "month", "left_anti")


def against_manifest(rows: DataFrame, manifest: DataFrame, archive: str, expected: str) -> DataFrame:
    """archive, found, expected, verdict (ok, missing, unexpected or different) of rows per archive against a manifest."""
    found = rows.groupBy(archive).agg(F.count(F.lit(1)).alias("found"))
    both = found.join(manifest.select(archive, F.col(expected).alias("expected")), archive, "full_outer")
    verdict = F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "unexpected").when(F.col("found") == F.col("expected"), "ok").otherwise("different")
    return both.withColumn("verdict", verdict)


def part_set(files: DataFrame, name: str, pattern: str) -> DataFrame:
    """date, parts, expected, complete of snapshot files named by a pattern of date, k and n: complete if each k of n occurs once."""
    g = lambda i: F.regexp_extract(name, pattern, i)
    rows = files.where(F.col(name).rlike(pattern)).select(g(1).alias("date"), g(2).cast("int").alias("k"), g(3).cast("int").alias("n"))
    out = rows.groupBy("date").agg(F.count(F.lit(1)).alias("parts"), F.count_distinct("k").alias("__d"), F.max("n").alias("expected"), F.min("n").alias("__least"), F.max("k").alias("__k"))
    return out.withColumn("complete", (F.col("parts") == F.col("expected")) & (F.col("__d") == F.col("expected")) & (F.col("__least") == F.col("expected")) & (F.col("__k") == F.col("expected"))).drop("__d", "__least", "__k")


def scope_coverage(stored: DataFrame, requested: DataFrame, scope: str, item: str) -> DataFrame:
    """scope, n_requested, n_stored, n_missing, covered: whether what a run asks for per scope is all there already, so it can be resumed.

    Distinct items count; null items and items that nobody asked for don't.
    """
    have = stored.select(scope, item).distinct().withColumn("__have", F.lit(1))
    both = requested.select(scope, item).where(F.col(item).isNotNull()).distinct().join(have, [scope, item], "left")
    out = both.groupBy(scope).agg(F.count(F.lit(1)).alias("n_requested"), F.count("__have").alias("n_stored"))
    return out.withColumn("n_missing", F.col("n_requested") - F.col("n_stored")).withColumn("covered", F.col("n_missing") == 0)


def file_hashes(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """name, size, sha256 of the files of a folder whose names match; read on executors, one file in memory at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def verify_files(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """name, verdict of every file of a manifest (name, size, sha256) or of the folder: ok, missing, unexpected, size or sha256."""
    f = found.select("name", F.col("size").alias("f_size"), F.col("sha256").alias("f_sha"))
    both = manifest.select("name", "size", "sha256").join(f, "name", "full_outer")
    verdict = F.when(F.col("f_sha").isNull(), "missing").when(F.col("sha256").isNull(), "unexpected").when(F.col("size") != F.col("f_size"), "size").when(F.lower("sha256") != F.col("f_sha"), "sha256").otherwise("ok")
    return both.select("name", verdict.alias("verdict"))


def parser_agreement(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Distinct facts in both, only in the first, only in the second."""
    x, y = a.select(*key).distinct().withColumn("__x", F.lit(1)), b.select(*key).distinct().withColumn("__y", F.lit(1))
    both = x.unionByName(y, allowMissingColumns=True).groupBy(*key).agg(F.max("__x").alias("x"), F.max("__y").alias("y"))
    return both.agg(F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull()).alias("n_both"), F.count_if(F.col("y").isNull()).alias("n_first_only"), F.count_if(F.col("x").isNull()).alias("n_second_only"))


def require_columns_absent(df: DataFrame, banned: tuple[str, ...]) -> None:
    """Raises if a frame, best one read back after writing, has a banned column."""
    if leaked := sorted(set(df.columns) & set(banned)):
        raise ValueError(f"columns that must not be published: {leaked}")


def suppressed(n: Column) -> Column:
    """A count, null if it is 1 to 9."""
    return F.when(~((n > 0) & (n < 10)), n)
