"""Reports and gates. ``*_report`` is lazy; ``assert_*`` runs one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def pk_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, rows with a NULL key part, surplus rows of repeated keys.

    Counting per key first merges repeats inside each task, so a key that fills
    the table reaches the shuffle as one row per task.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("_n"), zero).alias("row_count"),
        F.coalesce(F.sum(F.when(any_null, F.col("_n"))), zero).alias("null_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), zero).alias("duplicate_rows"),
    )


def assert_pk(df: DataFrame, keys: list[str], table: str) -> None:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"{table}: no key column {missing}")
    r = pk_report(df, keys).first()
    if r.null_keys or r.duplicate_rows:
        raise ValueError(
            f"{table}: key {keys} has {r.null_keys} null and {r.duplicate_rows} duplicate row(s)"
        )


def grain_report(df: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows taking part in repeated keys, overall or per ``by``; rows are kept."""
    by = by or []
    per_key = df.groupBy(*dict.fromkeys([*by, *keys])).agg(F.count("*").alias("_n"))
    repeated = F.col("_n") > 1
    zero = F.lit(0).cast("bigint")
    return per_key.groupBy(*by).agg(
        F.sum("_n").alias("row_count"),
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("_n"))), zero).alias("rows_in_repeated_keys"),
    )


def invalid_count(df: DataFrame, valid: Column) -> DataFrame:
    return df.agg(F.count_if(~F.coalesce(valid, F.lit(False))).alias("invalid_rows"))


def assert_all(df: DataFrame, valid: Column, message: str) -> None:
    n = invalid_count(df, valid).first().invalid_rows
    if n:
        raise ValueError(f"{message}: {n} row(s)")


def require(value: Column, valid: Column, message: str) -> Column:
    """The value, or an error raised by the job when the row breaks the rule.

    The check rides on the pass that computes the value: no extra job.
    """
    return F.when(F.coalesce(valid, F.lit(False)), value).otherwise(
        F.raise_error(F.lit(message))
    )


def id_range(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(
        F.count("*").alias("row_count"),
        F.min(column).alias("min_id"),
        F.max(column).alias("max_id"),
    )


def outlier_report(df: DataFrame, flags: dict[str, Column], weight: str | None = None) -> DataFrame:
    """(column, outliers): how many values each flag marks, one scan for all.

    ``weight`` names the column that says for how many rows a line stands.
    """
    names = list(flags)

    def marked(flag: Column) -> Column:
        if weight is None:
            return F.count_if(flag)
        return F.coalesce(F.sum(F.when(flag, F.col(weight))), F.lit(0).cast("bigint"))

    counts = df.agg(*[marked(flags[n]).alias(n) for n in names])
    return counts.unpivot([], names, "column", "outliers")


def reconcile(
    expected: DataFrame, found: DataFrame, key: str, at_least: bool = False
) -> DataFrame:
    """(key, expected, found, ok) for two (key, row_count) frames.

    A replacing load must match exactly, an upsert may leave older rows behind.
    """
    joined = expected.select(key, F.col("row_count").alias("expected")).join(
        found.select(key, F.col("row_count").alias("found")), key, "left"
    )
    got = F.coalesce(F.col("found"), F.lit(0).cast("bigint"))
    ok = got >= F.col("expected") if at_least else got == F.col("expected")
    return joined.select(key, "expected", got.alias("found"), ok.alias("ok"))


def assert_reconciled(report: DataFrame, key: str, table: str) -> None:
    bad = report.where(~F.col("ok")).orderBy(key).limit(5).collect()
    if bad:
        detail = ", ".join(f"{r[key]}: expected {r.expected}, found {r.found}" for r in bad)
        raise ValueError(f"{table}: row counts differ ({detail})")
