"""Questions over facts and facility versions stored in buckets of the snapshot key.

The same answers as the functions of these names in ``plans.queries``; below the
aggregate by facility nothing is shuffled but the rows of hot keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from snapmart.functions.dates import check_month_range, day_range, parse_month
from snapmart.operators.aggregate import top_k
from snapmart.operators.filters import snapshot_at, snapshots, versions_in
from snapmart.sources.buckets import Bucketed, join_bucketed, open_bucketed, write_bucketed

KEY = "unit_version"


def store_colocated(tables: dict[str, DataFrame], root: str, buckets: int) -> dict[str, Bucketed]:
    """Store star tables in the same buckets of their snapshot key and open them."""
    for name, rows in tables.items():
        write_bucketed(rows, f"{root}/{name}", KEY, buckets)
    return {name: open_bucketed(rows.sparkSession, f"{root}/{name}") for name, rows in tables.items()}


def top_units_by_admissions(
    admissions: Bucketed, units: Bucketed, names: DataFrame, start: dt.date, end: dt.date, k: int = 10
) -> DataFrame:
    """Busiest facilities with the best name known for each."""
    days = day_range("entry_date", start, end)
    per_version = admissions.each(lambda rows: rows.where(days).groupBy(KEY).agg(F.count("*").alias("_n")))
    known = units.each(lambda rows: rows.select(KEY, "unit_id"))
    per_unit = join_bucketed(per_version, known).groupBy("unit_id").agg(F.sum("_n").alias("admissions"))
    named = per_unit.join(names.select("unit_id", "trade_name", "legal_name"), "unit_id", "left").select(
        "unit_id", F.coalesce("trade_name", "legal_name", "unit_id").alias("unit_name"), "admissions"
    )
    return top_k(named, "admissions", ["unit_id", "unit_name"], k)


def beds_by_unit(beds: Bucketed, units: Bucketed, places: DataFrame, month: str) -> DataFrame:
    """Every facility with beds at the month, largest first."""
    at = parse_month(month)
    sums = beds.each(lambda rows: snapshot_at(rows, at).groupBy(KEY, "place_id").agg(F.sum("existing").alias("_q")))
    known = units.each(lambda rows: versions_in(rows, at, at).select(KEY, "unit_id"))
    placed = join_bucketed(sums, known).join(places.select("place_id", "place_name", "state"), "place_id")
    per_unit = placed.groupBy("unit_id", "place_name", "state").agg(F.sum("_q").alias("existing"))
    return per_unit.where(F.col("existing") > 0).orderBy(F.col("existing").desc(), "unit_id", "place_name", "state")


def licence_coverage(units: Bucketed, licences: Bucketed, places: DataFrame, first: str, last: str) -> DataFrame:
    """Facilities with and without a licence in the months."""
    start, end = check_month_range(first, last)
    known = places.select("place_id").distinct()
    rows = units.each(
        lambda r: snapshots(r, start, end).where(F.col("unit_id").isNotNull()).join(known, "place_id", "left_semi").select(KEY, "unit_id")
    )
    licensed = licences.each(
        lambda r: versions_in(r, start, end).where(F.col("licence").isNotNull())
        .groupBy(KEY).agg(F.first(F.lit(1)).alias("_licensed"))
    )
    per_unit = join_bucketed(rows, licensed, "left").groupBy("unit_id").agg(F.max("_licensed").alias("_licensed"))
    return per_unit.agg(
        F.count("*").alias("units"),
        F.count("_licensed").alias("with_licence"),
        (F.count("*") - F.count("_licensed")).alias("without_licence"),
    )
