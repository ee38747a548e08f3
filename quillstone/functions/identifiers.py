"""Company-number expressions. Three normal forms exist on purpose: validated, join key, and lax comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known two-letter prefixes of company numbers.
KNOWN_PREFIXES = ("SC", "NI", "OC", "SO", "NC", "FC", "SF", "NF", "CE", "CS", "IP", "SP", "RS", "SL", "LP", "NL", "RC", "SR", "GE")
# Prefixes of registered societies and royal charter bodies.
SOCIETY_PREFIXES = ("IP", "SP", "NP", "RS", "SL", "R", "RC", "SR", "NR")
# Spellings of an empty cell.
EMPTY_WORDS = ("", "NAN", "NONE", "NULL")


def join_key(raw: Column) -> Column:
    """The key that feature tables are joined on."""
    return F.upper(F.trim(raw))


def lax(raw: Column) -> Column:
    """A form for comparing numbers of different padding: no white space, upper case, no leading zeros; empty gives 0."""
    bare = F.regexp_replace(F.upper(F.regexp_replace(raw, r"\s+", "")), "^0+", "")
    return F.when(bare == "", "0").otherwise(bare)


def normalise(raw: Column) -> Column:
    """Struct of number, status (ok, fixed, invalid) and note.

    A spreadsheet's trailing .0 goes; digits are padded to 8, or to 6 after two letters. A number that is 8 digits once the .0
    has gone is ok, with the note.
    """
    tidy = F.replace(F.upper(F.trim(F.coalesce(raw, F.lit("")))), F.lit(" "), F.lit(""))
    float_ = tidy.rlike(r"^\d{1,8}\.0$")
    s = F.when(float_, F.regexp_replace(tidy, r"\.0$", "")).otherwise(tidy)
    note_float = F.when(float_, F.lit("stripped trailing .0 (spreadsheet float)"))
    digits = s.rlike(r"^\d{1,8}$")
    lettered = s.rlike(r"^[A-Z]{2}\d{1,6}$")
    tail = F.substring(s, 3, 6)
    padded = F.when(digits, F.lpad(s, 8, "0")).when(lettered, F.concat(F.substring(s, 1, 2), F.lpad(tail, 6, "0")))
    changed = (digits & (F.length(s) < 8)) | (lettered & (F.length(tail) < 6))
    status = F.when(padded.isNull(), "invalid").when(changed, "fixed").otherwise("ok")
    note = (
        F.when(s.isin(*EMPTY_WORDS), "empty value")
        .when(padded.isNull(), "does not match 8-digit or 2-letter+6-digit format")
        .when(digits, F.concat_ws("; ", note_float, F.when(changed, F.concat(F.lit("zero-padded "), F.length(s), F.lit("->8 digits (likely spreadsheet damage)")))))
        .otherwise(
            F.concat_ws(
                "; ",
                F.when(changed, F.concat(F.lit("zero-padded digit part "), F.length(tail), F.lit("->6"))),
                F.when(~F.substring(s, 1, 2).isin(*KNOWN_PREFIXES), F.concat(F.lit("unrecognised prefix '"), F.substring(s, 1, 2), F.lit("' - accepted, verify manually"))),
            )
        )
    )
    return F.struct(padded.alias("number"), status.alias("status"), note.alias("note"))


def is_society(raw: Column) -> Column:
    """Whether a number is an 8-character society or charter number by its leading letters, which are read greedily."""
    s = F.replace(F.upper(F.trim(raw)), F.lit(" "), F.lit(""))
    return F.coalesce((F.length(s) == 8) & F.regexp_extract(s, "^([A-Z]{1,2})[0-9A-Z]+$", 1).isin(*SOCIETY_PREFIXES), F.lit(False))


def validation_report(df: DataFrame, raw: str, position: str) -> DataFrame:
    """number, status, first (position), copies: the distinct valid numbers with where each came first, ok before fixed."""
    rows = df.select(normalise(F.col(raw)).alias("n"), F.col(position).alias("position")).select("n.number", "n.status", "position").where("number is not null")
    turn = F.struct(F.when(F.col("status") == "ok", 0).otherwise(1).alias("later"), F.col("position"))
    return rows.groupBy("number").agg(F.min(turn).alias("t"), F.count(F.lit(1)).alias("copies")).select("number", F.when(F.col("t.later") == 0, "ok").otherwise("fixed").alias("status"), F.col("t.position").alias("first"), "copies")


def validation_counts(df: DataFrame, raw: str) -> DataFrame:
    """One row: input, ok, fixed, invalid and duplicates."""
    n = df.select(normalise(F.col(raw)).alias("n")).select("n.number", "n.status")
    return n.agg(
        F.count(F.lit(1)).alias("input_rows"),
        *(F.count_if(F.col("status") == s).alias(s) for s in ("ok", "fixed", "invalid")),
        (F.count("number") - F.count_distinct("number")).alias("duplicates"),
    )
