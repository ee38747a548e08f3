"""Register CSV, ownership lines, cached responses, label files, company lists and observation frames."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.operators.housekeeping import file_hashes

#: More malformed rows than this stop a build.
MAX_MALFORMED = 5


def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def csv_header(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[str]:
    """Column names of a CSV, trimmed; the first line of one file is read."""
    first = spark.read.option("encoding", encoding).option("header", False).csv(path).limit(1).first()
    return [str(v).strip().removeprefix("﻿") for v in first] if first else []


def register(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a register snapshot as text; names are trimmed, rows of a wrong length dropped."""
    reader = spark.read.schema(_texts(csv_header(spark, path))).option("header", True).option("enforceSchema", True)
    return reader.option("escape", '"').option("ignoreLeadingWhiteSpace", True).option("mode", "DROPMALFORMED").csv(path)


def register_with_rejects(spark: SparkSession, path: str, most: int = MAX_MALFORMED) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines); raises if more than `most` are rejected. Blank lines are neither."""
    schema = _texts(csv_header(spark, path)).add("_corrupt", T.StringType())
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").csv(path).persist()
    bad = rows.where("_corrupt is not null").select(F.col("_corrupt").alias("line"))
    n = bad.count()
    if n > most:
        rows.unpersist()
        raise ValueError(f"{n} malformed rows, more than {most}")
    return rows.where("_corrupt is null").drop("_corrupt"), bad


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, part of every line that isn't blank; nothing is inferred and no line is lost."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    part = F.regexp_extract("file", r"_(\d+)of(\d+)", 1).try_cast("int")
    return lines.where(F.trim("value") != "").withColumn("part", part)


def responses(spark: SparkSession, path: str) -> DataFrame:
    """Cached API responses, one JSON file each, as company_number, endpoint, status_code, fetched_at, url, etag, content_hash, data."""
    raw = spark.read.option("wholetext", True).text(path).withColumn("v", F.try_parse_json("value")).where("v is not null")
    get = lambda n, kind="string": F.try_variant_get("v", f"$.{n}", kind).alias(n)
    data = F.to_json(F.try_variant_get("v", "$.data", "variant")).alias("data")
    return raw.select(get("company_number"), get("endpoint"), get("status_code", "int"), F.try_variant_get("v", "$.fetched_at", "string").try_cast("timestamp").alias("fetched_at"), get("url"), get("etag"), get("content_hash"), data)


def labels(spark: SparkSession, path: str) -> DataFrame:
    """Label rows of a Latin-1 CSV with line_no in file order; names are case-insensitive, and the needed ones must exist."""
    names = [n.lower() for n in csv_header(spark, path, "ISO-8859-1")]
    needed = {"company_number", "case_type", "month_registered", "sic07_2_digit", "is_bulk"}
    if missing := needed - set(names):
        raise ValueError(f"missing label columns: {sorted(missing)}")
    rows = spark.read.schema(_texts(names)).option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return rows.withColumn("line_no", F.monotonically_increasing_id())


def company_list(spark: SparkSession, path: str) -> DataFrame:
    """raw, position of an input list: the column company_number, or the only column of a file without that header."""
    names = [n.lower() for n in csv_header(spark, path)]
    known = "company_number" in names
    rows = spark.read.schema(_texts(names if known else [f"c{i}" for i in range(len(names) or 1)])).option("header", known).csv(path)
    first = "company_number" if known else "c0"
    return rows.select(F.regexp_replace(F.col(first), "^﻿", "").alias("raw"), F.monotonically_increasing_id().alias("position"))


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Parquet partitions by columns, replacing only those that df has: writing a month again changes nothing else."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def write_sorted(df: DataFrame, path: str, keys: list[str]) -> None:
    """Parquet in total order of keys over its files: ranges of the first shuffle, sorted within, so that scans skip by statistics."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_union_csv(frames: list[DataFrame], path: str) -> None:
    """CSV with a header of rows of several shapes: all columns in order of appearance, empty where a row has none."""
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_manifest(spark: SparkSession, folder: str, path: str, facts: dict) -> dict:
    """JSON with facts, and name, size and sha256 of each Parquet file of a folder; readers see the old manifest or the new one.

    Files are hashed on executors. It is written beside its place and renamed, which replaces it in one step where the file
    system can. One entry a file: their number has to fit the driver.
    """
    rows = file_hashes(spark, folder, "*.parquet").orderBy("name").collect()
    manifest = {**facts, "files": [r.asDict() for r in rows]}
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(jvm.java.net.URI(path) if "://" in path else jvm.java.io.File(path).toURI(), spark.sparkContext._jsc.hadoopConfiguration())
    at, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    file = beside.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(beside)
    file.write(bytearray(json.dumps(manifest, indent=1, sort_keys=True).encode()))
    file.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(beside, at, overwrite)
    return manifest


def write_governed(df: DataFrame, path: str, banned: tuple[str, ...]) -> None:
    """Parquet without banned columns; what was written is read back and checked."""
    from quillstone.operators.housekeeping import require_columns_absent

    df.drop(*banned).write.mode("overwrite").option("compression", "zstd").parquet(path)
    require_columns_absent(df.sparkSession.read.parquet(path), banned)
