"""As-of assignment of dated snapshots to dated rows, without look-ahead."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.identifiers import join_key


def snapshot_date(catalogue: list[str], day: Column) -> Column:
    """The last date of a catalogue on or before a day, as an expression: no join, and nothing further back is reached."""
    known = F.array(*(F.lit(d).cast("date") for d in sorted(catalogue)))
    return F.array_max(F.filter(known, lambda d: d <= day))


def assign_snapshots(observations: DataFrame, snapshots: list[tuple[str, DataFrame]], company: str, date: str, key: str = "company_number", present: str = "has_psc", prefix: str = "psc") -> DataFrame:
    """observations with the columns of the snapshot in force on each row's date.

    The snapshot is chosen by date alone, before the company is looked up, so a company missing from it isn't filled from an
    older one. All snapshots must have the same columns in the same order.
    """
    schemas = {tuple((f.name, f.dataType.simpleString()) for f in df.schema) for _, df in snapshots}
    if len(schemas) != 1:
        raise ValueError("snapshots differ in their columns")
    columns = [c for c in snapshots[0][1].columns if c != key]
    added = [*columns, present, f"has_{prefix}_snapshot", f"{prefix}_snapshot_date", f"{prefix}_snapshot_age_days"]
    if clash := set(added) & set(observations.columns):
        raise ValueError(f"columns exist: {sorted(clash)}")
    at = f"{prefix}_snapshot_date"
    dated = reduce(DataFrame.unionByName, [df.select(F.lit(d).cast("date").alias(at), join_key(F.col(key)).alias("__company"), F.lit(True).alias("__there"), *columns) for d, df in snapshots])
    day = F.col(date).cast("date")
    rows = observations.withColumn(at, snapshot_date([d for d, _ in snapshots], day)).withColumn("__company", join_key(F.col(company)))
    out = rows.join(dated, [at, "__company"], "left")
    return out.withColumns({present: F.coalesce("__there", F.lit(False)), f"has_{prefix}_snapshot": F.col(at).isNotNull(), f"{prefix}_snapshot_age_days": F.datediff(day, F.col(at))}).drop("__company", "__there")


def checked_observations(observations: DataFrame, company: str, date: str, reserved: tuple[str, ...] = ("__",)) -> dict[str, int]:
    """Checks rows before assignment: raises on missing or reserved columns, blank companies and dates that don't parse."""
    if missing := {company, date} - set(observations.columns):
        raise ValueError(f"missing columns: {sorted(missing)}")
    if bad := [c for c in observations.columns if c.startswith(reserved)]:
        raise ValueError(f"reserved column names: {bad}")
    n = observations.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.trim(F.col(company)), F.lit("")) == "").alias("blank"), F.count_if(F.col(date).try_cast("date").isNull()).alias("undated")).first().asDict()
    if n["blank"] or n["undated"]:
        raise ValueError(f"{n['blank']} rows without a company, {n['undated']} without a date")
    return n
