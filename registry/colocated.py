"""Star tables stored in buckets of the snapshot key; the SQL is that of the plain queries."""

from __future__ import annotations

from registry.core import ORACLE, query
from registry.flow import END, START
from registry.standin import star
from registry.stock import MONTH
from snapmart.plans import colocated
from snapmart.sources.staging import new_path

BUCKETS = 16


def stored(spark, d, *tables, lean=None):
    rows = star(spark, d, *tables, lean=lean)
    return colocated.store_colocated({n: getattr(rows, n) for n in tables}, new_path(spark, "colocated"), BUCKETS)


@query("colocated_top_units", ORACLE["top_units"])
def colocated_top_units(spark, d):
    t = stored(spark, d, "admissions", "units", lean=("orders",))
    return colocated.top_units_by_admissions(t["admissions"], t["units"], star(spark, d, "names").names, START, END)


@query("colocated_stock_by_unit", ORACLE["stock_by_unit"])
def colocated_stock_by_unit(spark, d):
    t = stored(spark, d, "beds", "units")
    return colocated.beds_by_unit(t["beds"], t["units"], star(spark, d, "places").places, MONTH)


@query("colocated_coverage", ORACLE["coverage_with_without"])
def colocated_coverage(spark, d):
    t = stored(spark, d, "units", "licences")
    return colocated.licence_coverage(t["units"], t["licences"], star(spark, d, "places").places, "1998-01", "1998-02")
