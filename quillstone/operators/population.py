"""Population join of three sources, its coverage, key checks and audits of two versions of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.bands import prefixed
from quillstone.functions.identifiers import join_key


def key_check(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, blank keys, distinct keys."""
    k = join_key(F.col(key).cast("string"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce(k, F.lit("")) == "").alias("n_blank"), F.count_distinct(F.when(k != "", k)).alias("n_distinct"))


def require_unique(df: DataFrame, key: str, name: str) -> None:
    n = key_check(df, key).first()
    if n["n_blank"] or n["n_distinct"] != n["n_rows"]:
        raise ValueError(f"{name}: {n['n_rows']} rows, {n['n_blank']} blank and {n['n_distinct']} distinct keys")


def population_join(register: DataFrame, psc: DataFrame, accounts: DataFrame, key: str = "company_number") -> DataFrame:
    """Every company of the register with the columns of both other sources, prefixed, and has_psc, has_accounts.

    Presence comes from the other side's key, so a row of nulls still counts as present. Companies outside the register go.
    """
    def side(df: DataFrame, prefix: str, flag: str | None) -> DataFrame:
        names = [c for c in df.columns if c != key]
        columns = [F.col(f"`{c}`").alias(p) for c, p in zip(names, prefixed(names, prefix), strict=True)]
        return df.select(join_key(F.col(key)).alias(key), *columns, *([F.lit(True).alias(flag)] if flag else []))

    out = side(register, "reg_", None).join(side(psc, "psc_", "has_psc"), key, "left").join(side(accounts, "acc_", "has_accounts"), key, "left")
    return out.withColumns({f: F.coalesce(f, F.lit(False)) for f in ("has_psc", "has_accounts")})


def coverage(joined: DataFrame, by: Column | None = None, name: str = "category") -> DataFrame:
    """Companies and the four combinations of sources with their shares, in all or by a column (null: <null>)."""
    p, a = F.col("has_psc"), F.col("has_accounts")
    parts = {"all_three": p & a, "register_psc_only": p & ~a, "register_accounts_only": ~p & a, "register_only": ~p & ~a}
    n = [F.count(F.lit(1)).alias("n_register"), *(F.count_if(c).alias(k) for k, c in parts.items())]
    out = joined.agg(*n) if by is None else joined.groupBy(F.coalesce(by.cast("string"), F.lit("<null>")).alias(name)).agg(*n)
    return out.withColumns({f"share_{k}": F.try_divide(F.col(k).cast("double"), F.nullif(F.col("n_register"), F.lit(0))) for k in parts})


def outside(source: DataFrame, register: DataFrame, key: str = "company_number") -> DataFrame:
    """Rows of a source whose company isn't in the register."""
    there = register.select(join_key(F.col(key)).alias("__k")).distinct()
    return source.join(there, join_key(source[key]) == F.col("__k"), "left_anti")


def full_outer_audit(baseline: DataFrame, candidate: DataFrame, key: list[str], columns: list[str], by: list[str] = ()) -> DataFrame:
    """Per column: rows in both, only in one, equal, changed, filled and emptied; one full outer join for all columns."""
    a = baseline.select(*key, *(F.col(f"`{c}`").alias(f"__a{i}") for i, c in enumerate(columns)), F.lit(True).alias("__a"))
    b = candidate.select(*key, *(F.col(f"`{c}`").alias(f"__b{i}") for i, c in enumerate(columns)), F.lit(True).alias("__b"))
    both = a.join(b, key, "full_outer")
    ina, inb = F.col("__a").isNotNull(), F.col("__b").isNotNull()
    rows = []
    for i, c in enumerate(columns):
        x, y = F.col(f"__a{i}"), F.col(f"__b{i}")
        rows.append(F.struct(F.lit(c).alias("column"), (ina & inb).alias("both"), (ina & ~inb).alias("base"), (inb & ~ina).alias("cand"), x.eqNullSafe(y).alias("same"), (x.isNotNull() & y.isNotNull() & (x != y)).alias("changed"), (x.isNull() & y.isNotNull()).alias("filled"), (x.isNotNull() & y.isNull()).alias("emptied")))
    long = both.select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*")
    return long.groupBy(*by, "column").agg(
        F.count_if("both").alias("n_both"),
        F.count_if("base").alias("n_baseline_only"),
        F.count_if("cand").alias("n_candidate_only"),
        *(F.count_if(F.col("both") & F.coalesce(F.col(c), F.lit(False))).alias(f"n_{c}") for c in ("same", "changed", "filled", "emptied")),
    )


def value_diff(a: DataFrame, b: DataFrame, key: list[str], value: str, null_safe: bool = False) -> DataFrame:
    """Rows of two versions with the same key and different values. A null in a key matches nothing unless null_safe."""
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) if null_safe else F.col(f"a.{k}") == F.col(f"b.{k}") for k in key]
    return a.alias("a").join(b.alias("b"), on).where(~F.col(f"a.{value}").eqNullSafe(F.col(f"b.{value}"))).select(*(F.col(f"a.{k}").alias(k) for k in key), F.col(f"a.{value}").alias("value_a"), F.col(f"b.{value}").alias("value_b"))


def parity(a: DataFrame, b: DataFrame, key: str, columns: list[str], sets: tuple[str, ...] = ()) -> DataFrame:
    """Per column: shared keys and how many agree; columns named in `sets` hold comma-separated sets."""
    form = lambda side, c: F.array_join(F.array_sort(F.array_distinct(F.split(F.col(f"{side}.{c}"), ","))), ",") if c in sets else F.col(f"{side}.{c}").cast("string")
    both = a.alias("a").join(b.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), form("a", c).eqNullSafe(form("b", c)).alias("same")) for c in columns))
    long = both.select(F.explode(rows).alias("r")).select("r.*")
    return long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.count_if("same").alias("n_same")).withColumn("rate", F.col("n_same").cast("double") / F.col("n"))
