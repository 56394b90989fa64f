"""Optional predicates and the joins they need.

A dimension is joined only when a filter asks for it, so unfiltered totals keep
facts whose dimension row is missing and filtered ones do not. Catalyst cannot
drop an unneeded inner join, as it may remove rows; the choice is made here.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.functions.dates import month_range, shift_months


def all_of(predicates: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, predicates) if predicates else None


def where_all(df: DataFrame, predicates: list[Column]) -> DataFrame:
    condition = all_of(predicates)
    return df if condition is None else df.where(condition)


def equals_if_given(pairs: dict[str, object | None]) -> list[Column]:
    """One equality per column whose wanted value is not empty."""
    return [F.col(c) == F.lit(v) for c, v in pairs.items() if v]


@dataclass(frozen=True)
class Scope:
    """Where: region, state, municipality, and one facility."""

    region: str | None = None
    state: str | None = None
    place: str | None = None
    unit: str | None = None

    @property
    def geographic(self) -> bool:
        return bool(self.region or self.state or self.place)

    def place_predicates(self) -> list[Column]:
        return equals_if_given(
            {"region": self.region, "state": self.state, "place_id": self.place}
        )

    def unit_predicates(self) -> list[Column]:
        return equals_if_given({"unit_id": self.unit})


@dataclass(frozen=True)
class Person:
    """Who: demographic filters. Age bounds are inclusive and 0 is a bound."""

    sex: str | None = None
    race: str | None = None
    ethnicity: str | None = None
    admission_type: str | None = None
    age_min: float | None = None
    age_max: float | None = None

    def predicates(self) -> list[Column]:
        wanted = equals_if_given(
            {
                "sex": self.sex,
                "race": self.race,
                "ethnicity": self.ethnicity,
                "admission_type": self.admission_type,
            }
        )
        if self.age_min is not None:
            wanted.append(F.col("age") >= F.lit(self.age_min))
        if self.age_max is not None:
            wanted.append(F.col("age") <= F.lit(self.age_max))
        return wanted


def keep_places(
    fact: DataFrame, places: DataFrame, fact_key: str, scope: Scope, always: bool = False
) -> DataFrame:
    """Facts whose place passes the geographic filter.

    ``place_id`` is unique in ``places``, so the inner join that decides which
    facts stay is a semi join: nothing is duplicated and no column travels.
    ``always`` keeps only facts with a known place even without a filter.
    """
    if not (scope.geographic or always):
        return fact
    chosen = where_all(places, scope.place_predicates()).select(
        F.col("place_id").alias(fact_key)
    )
    return fact.join(chosen, fact_key, "left_semi")


def _versions(units: DataFrame, scope: Scope, fact_key: str) -> DataFrame:
    """(fact_key, unit_id) of the facility versions in scope.

    Whether they are broadcast is left to Spark's size check.
    """
    return where_all(units, scope.unit_predicates()).select(F.col("unit_version").alias(fact_key), "unit_id")


def keep_units(fact: DataFrame, units: DataFrame, fact_key: str, scope: Scope) -> DataFrame:
    """Facts of the chosen facility, matched on its monthly versions."""
    if not scope.unit:
        return fact
    return fact.join(_versions(units, scope, fact_key), fact_key, "left_semi")


def with_unit_id(
    fact: DataFrame, units: DataFrame, fact_key: str, scope: Scope = Scope()
) -> DataFrame:
    """Add ``unit_id`` through the snapshot key (inner join, optional filter)."""
    return fact.join(_versions(units, scope, fact_key), fact_key)


def versions_in(units: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Facility versions of whole months, read off the head of their key.

    A stock row refers to the version of its own month, so the other months
    cannot match; the bounds reach the Parquet scan.
    """
    key = F.col("unit_version")
    rows = units.where(
        (key >= start.strftime("%Y%m")) & (key < shift_months(end, 1).strftime("%Y%m"))
    )
    return _prune_periods(rows, start, end)


def snapshots(fact: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Snapshot rows of whole months, pruning ``period`` folders when the table
    is stored by period."""
    return _prune_periods(fact.where(month_range("period_date", start, end)), start, end)


def snapshot_at(fact: DataFrame, month: dt.date) -> DataFrame:
    """Snapshot rows of one month: the only way a stock may be summed."""
    return snapshots(fact, month, month)


def _prune_periods(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    if "period" not in df.columns:
        return df
    return df.where(F.col("period").between(start.strftime("%Y%m"), end.strftime("%Y%m")))
