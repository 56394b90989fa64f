"""Aggregates, rankings and distributions.

Rankings always carry the group keys as further sort keys, so ties come out the
same way on every run, and NULL measures never win.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapmart.functions.codes import as_col


# ---- measures ---------------------------------------------------------------

def rounded(c: Column, digits: int = 2) -> Column:
    """Round half away from zero on the decimal value, not on its binary form."""
    return F.round(c.cast("decimal(28,8)"), digits).cast("double")


def exact(c: Column | str) -> Column:
    """The number as a decimal, whose sums do not depend on the order of the rows."""
    return as_col(c).cast("decimal(28,8)")


def mean(c: Column | str, digits: int = 2) -> Column:
    """Rounded mean over an exact sum, so a value on a rounding edge stays on its side."""
    value = as_col(c)
    return rounded(F.sum(exact(value)).cast("double") / F.nullif(F.count(value), F.lit(0)), digits)


def total(c: Column | str) -> Column:
    """Sum that is 0 when there is nothing to add."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0.0))


def total_if(condition: Column, c: Column | str) -> Column:
    return total(F.when(condition, as_col(c)).otherwise(F.lit(0.0)))


def distinct_if(condition: Column, key: Column | str) -> Column:
    return F.count_distinct(F.when(condition, as_col(key)))


def distinct_count(key: Column | str, approximate: bool = False) -> Column:
    """Exact by default; the sketch answers in one pass over huge key sets."""
    return F.approx_count_distinct(as_col(key)) if approximate else F.count_distinct(as_col(key))


def banded(c: Column | str, bands: list[tuple[float, float | None, str]]) -> Column:
    """Label of the inclusive band ``(lo, hi, label)`` holding the value; values
    between two bands have no label. An open top band has ``hi=None``."""
    value = as_col(c)
    picked = None
    for lo, hi, label in bands:
        inside = value >= F.lit(lo) if hi is None else value.between(F.lit(lo), F.lit(hi))
        picked = F.when(inside, label) if picked is None else picked.when(inside, label)
    return picked


# Age bands of the demographic distribution.
AGE_BANDS = [
    (0, 17, "0-17"), (18, 29, "18-29"), (30, 44, "30-44"),
    (45, 59, "45-59"), (60, 74, "60-74"), (75, None, "75+"),
]


# ---- rankings ---------------------------------------------------------------

def top_k(df: DataFrame, by: str, keys: list[str], k: int = 10) -> DataFrame:
    """The ``k`` rows with the largest ``by`` (each task keeps only ``k`` rows)."""
    return df.orderBy(F.col(by).desc_nulls_last(), *_ascending(keys)).limit(k)


def top_k_per_group(
    df: DataFrame, group: list[str], by: list[Column], k: int, position: str | None = None
) -> DataFrame:
    """The first ``k`` rows of each group in the given order.

    Filtering on ``row_number`` lets Spark cut every group to ``k`` rows inside
    each task before the shuffle, so a hot group costs no more than a small one.
    """
    name = position or "_position"
    numbered = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*by)))
    kept = numbered.where(F.col(name) <= k)
    return kept if position else kept.drop(name)


def rank_list(df: DataFrame, by: str, label: str, k: int = 10, missing: str = "Não informado") -> DataFrame:
    """(position, label, value) of the best ``k`` rows. The numbering window sees
    at most ``k`` rows."""
    best = top_k(df.select(label, by), by, [label], k)
    order = Window.orderBy(F.col(by).desc_nulls_last(), F.col(label).asc_nulls_last())
    return best.select(
        F.row_number().over(order).cast("bigint").alias("position"),
        F.coalesce(F.col(label).cast("string"), F.lit(missing)).alias("label"),
        F.col(by).alias("value"),
    )


def top_n_others(
    df: DataFrame,
    group: list[str],
    label: str,
    value: str,
    n: int = 10,
    others: str = "Outros",
    missing: str = "Não informado",
    scale: int = 6,
) -> DataFrame:
    """Per group, the ``n`` largest labels and one row for the rest when its sum
    is above 0. ``df`` holds one row per (group, label).

    Group totals come out of the same pass as the rows and are sorted ahead of
    them; the cut to ``n + 1`` rows per group then happens inside each task, and
    the rest is the total less the head. No group is sorted or gathered whole.
    Values are added exactly, to ``scale`` decimals; smaller parts of them are
    rounded away.
    """
    amount = F.coalesce(F.col(value), F.lit(0)).cast(f"decimal(28,{scale})")
    rows = df.select(*group, F.col(label).alias("_label"), amount.alias("_amount"))
    every = [F.col(g) for g in group]
    sums = rows.groupingSets([[*every, F.col("_label")], every], *every, F.col("_label")).agg(
        F.grouping("_label").alias("_total"), F.sum("_amount").cast(f"decimal(28,{scale})").alias("_amount")
    )
    order = [F.col("_total").desc(), F.col("_amount").desc(), F.col("_label").asc_nulls_last()]
    head = top_k_per_group(sums, group, order, n + 1)
    is_total = F.col("_total") == 1
    shown = F.sum(F.when(~is_total, F.col("_amount"))).over(Window.partitionBy(*group))
    rest = F.col("_amount") - F.coalesce(shown, F.lit(0))
    named = F.coalesce(F.col("_label").cast("string"), F.lit(missing))
    return (
        head.withColumn("_value", F.when(is_total, rest).otherwise(F.col("_amount")))
        .where(~is_total | (F.col("_value") > 0))
        .select(
            *group,
            F.when(is_total, F.lit(others)).otherwise(named).alias(label),
            F.col("_value").cast("double").alias(value),
        )
    )


def latest_per_key(df: DataFrame, keys: list[str], by: list[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return top_k_per_group(df, keys, by, 1)


# ---- combinations -----------------------------------------------------------

def two_level(
    df: DataFrame,
    inner_keys: list,
    inner_aggs: list[Column],
    outer_keys: list[str],
    outer_aggs: list[Column],
) -> DataFrame:
    """Aggregate per inner key, then aggregate those results per outer key."""
    return df.groupBy(*inner_keys).agg(*inner_aggs).groupBy(*outer_keys).agg(*outer_aggs)


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """Columns of several one-row results in one row, without a cross join."""
    names = [c for df in one_row for c in df.columns]
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row
    )
    return stacked.agg(*[F.max(c).alias(c) for c in names])


def distributions(
    df: DataFrame,
    columns: dict[str, str],
    top: dict[str, int] | None = None,
) -> DataFrame:
    """Counts per value of several columns, as (group, category, quantity).

    ``columns`` maps a column to its group label; ``top`` caps chosen groups to
    their most frequent categories. Rows are first counted per combination, so
    the grouping sets expand combinations instead of rows. NULL is no category.
    """
    names = list(columns)
    combos = df.groupBy(*names).agg(F.count("*").alias("_n"))
    sets = combos.groupingSets([[F.col(c)] for c in names], *[F.col(c) for c in names]).agg(
        F.sum("_n").cast("bigint").alias("quantity"),
        *[F.grouping(c).alias(f"_{i}") for i, c in enumerate(names)],
    )
    group = F.coalesce(*[F.when(F.col(f"_{i}") == 0, columns[c]) for i, c in enumerate(names)])
    category = F.coalesce(*[F.when(F.col(f"_{i}") == 0, F.col(c).cast("string")) for i, c in enumerate(names)])
    result = sets.select(group.alias("group"), category.alias("category"), "quantity").where(
        F.col("category").isNotNull()
    )
    if not top:
        return result
    # Each capped group is cut on its own, where Spark can limit before shuffling.
    parts = [result.where(~F.col("group").isin(list(top)))] + [
        top_k_per_group(
            result.where(F.col("group") == g),
            ["group"],
            [F.col("quantity").desc(), F.col("category")],
            k,
        )
        for g, k in top.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def detail_and_total_distinct(
    df: DataFrame, key: list[str], detail: str, item: str, quantity: str = "quantity"
) -> DataFrame:
    """Distinct items per ``detail`` and over all details, with ``is_total``.

    The total is not the sum of the parts, as an item may have several details.
    Duplicates leave before the grouping sets double the rows.
    """
    pairs = df.select(*key, detail, item).distinct()
    every = [F.col(k) for k in key]
    return pairs.groupingSets(
        [every + [F.col(detail)], every], *every, F.col(detail)
    ).agg(
        F.count_distinct(item).alias(quantity),
        F.grouping(detail).alias("is_total"),
    )


def distinct_values(df: DataFrame, columns: list[str], keys: list[str] = (), wide: list[str] = ()) -> DataFrame:
    """Distinct non-null values of several columns as (keys, column, value).

    Rows are first reduced to the combinations of the columns inside each task, and
    only those are listed value by value. A column with many values (``wide``) is
    reduced on its own, in the same scan, as it would multiply the combinations.
    """
    narrow, every = [c for c in columns if c not in wide], [F.col(k) for k in keys]
    sets = [[*every, *(F.col(c) for c in names)] for names in ([narrow] if narrow else []) + [[c] for c in wide]]
    # A column outside its set is NULL there, and NULL is not listed.
    combinations = df.groupingSets(sets, *every, *(F.col(c) for c in columns)).agg(F.grouping_id().alias("_set"))
    values = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return combinations.select(*keys, F.inline(F.array(*values))).where(F.col("value").isNotNull()).distinct()


def _ascending(keys: list[str]) -> list[Column]:
    return [F.col(k).asc_nulls_last() for k in keys]
