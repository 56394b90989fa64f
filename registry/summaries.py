"""Summaries kept by month and the queries answered from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from registry.core import query, r2, with_ctes
from registry.flow import ASIA, FILTERS, IN_ASIA
from registry.standin import ADMISSIONS, PLACES, STAFF, UNITS, star
from snapmart.functions.dates import key_period, period_key
from snapmart.plans import summaries as s, sync
from snapmart.sources.files import write_periods
from snapmart.sources.staging import new_path, stage
from snapmart.sources.versions import read_stored

# Neither end is the end of a month, so that days at both edges come from the fact.
START, END = dt.date(1996, 1, 10), dt.date(2000, 12, 20)
DAYS = "entry_date >= DATE '1996-01-10' AND entry_date < DATE '2000-12-21'"
#: Admissions that leave the fact after the counts were kept, in the files of three months.
EDITED = "sex = 'N' AND period_date IN (DATE '1997-02-01', DATE '1998-07-01', DATE '2000-12-01')"
NOW = f"now_admissions AS (SELECT * FROM admissions WHERE NOT ({EDITED}))"


def _stored(spark, d):
    """The star, its admissions as first stored and after the edit, with the hashes of its months at first."""
    full = star(spark, d, "admissions", "places", "units")
    path = new_path(spark, "fact")
    write_periods(full.admissions.withColumn("period", period_key("period_date")), path)
    fact = read_stored(spark, path)
    return full, fact, fact.where(~F.expr(EDITED)), stage(sync.fingerprint(fact), "states")


def _kept(spark, d, *names):
    """Counts kept before the edit: the edited months are out of step and come from the fact."""
    full, fact, now, states = _stored(spark, d)
    root = new_path(spark, "counts")
    chosen = [c for c in s.ADMISSION_COUNTS if c.name in names]
    for c in chosen:
        s.refresh(fact, states, f"{root}/{c.name}", c)
    return full, s.open_counts(now, sync.fingerprint(now), root, chosen)


@query("rollup_flow", with_ctes([ADMISSIONS, PLACES, NOW], f"""
SELECT strftime(entry_date, '%Y-%m') AS month, count(*) AS admissions
FROM now_admissions WHERE {DAYS} AND {IN_ASIA.format('care_place')} GROUP BY 1"""))
def rollup_flow(spark, d):
    full, counts = _kept(spark, d, "by_unit", "by_diagnosis")
    return s.admissions_by_month(counts, full, START, END, ASIA)


@query("rollup_total", with_ctes([ADMISSIONS, NOW], f"""
SELECT count(*) AS admissions, {r2('avg(exit_date - entry_date)')} AS mean_stay FROM now_admissions WHERE {DAYS}"""))
def rollup_total(spark, d):
    full, counts = _kept(spark, d, "by_unit")
    return s.admissions_total(counts, full, START, END)


@query("rollup_top_units", with_ctes([ADMISSIONS, UNITS, NOW], f"""
SELECT unit_id, count(*) AS admissions FROM now_admissions JOIN units USING (unit_version)
WHERE {DAYS} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def rollup_top_units(spark, d):
    full, counts = _kept(spark, d, "by_unit")
    return s.top_units(counts, full, START, END)


@query("rollup_top_reasons", with_ctes([ADMISSIONS, PLACES, NOW], f"""
SELECT diagnosis, count(*) AS admissions FROM now_admissions
WHERE {DAYS} AND diagnosis IS NOT NULL AND {IN_ASIA.format('care_place')}
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def rollup_top_reasons(spark, d):
    full, counts = _kept(spark, d, "by_diagnosis")
    return s.top_diagnoses(counts, full, START, END, ASIA)


@query("rollup_filter_values", with_ctes([ADMISSIONS, PLACES, UNITS, NOW, f"""f AS (
SELECT a.* FROM now_admissions a JOIN places p ON p.place_id = a.care_place JOIN units u USING (unit_version) WHERE {DAYS})"""],
FILTERS))
def rollup_filter_values(spark, d):
    full, counts = _kept(spark, d, "by_person", "by_ethnicity")
    return s.filter_values(counts, full, START, END)


@query("rollup_refresh", with_ctes([ADMISSIONS], f"""
SELECT strftime(period_date, '%Y%m') AS period, count(*) FILTER (NOT ({EDITED})) AS admissions, bool_or({EDITED}) AS made_again
FROM admissions GROUP BY 1 HAVING count(*) FILTER (NOT ({EDITED})) > 0"""))
def rollup_refresh(spark, d):
    """Kept counts after an edit of three months: only these are made again."""
    _, fact, now, states = _stored(spark, d)
    path, counts = new_path(spark, "counts"), s.ADMISSION_COUNTS[0]
    s.refresh(fact, states, path, counts)
    again = s.refresh(now, sync.fingerprint(now), path, counts)
    return read_stored(spark, path).groupBy("period").agg(
        F.sum("admissions").alias("admissions"), F.max(F.col("period").isin(again)).alias("made_again")
    )


def year():
    return F.substring("period", 1, 4).alias("year")


@query("distinct_bitmaps", with_ctes([PLACES, UNITS], """
SELECT region, strftime(period_date, '%Y') AS year, count(DISTINCT unit_id) AS units
FROM units JOIN places USING (place_id) GROUP BY 1, 2"""))
def distinct_bitmaps(spark, d):
    """Facilities per region and year from monthly bitmaps; ids are numbered in two steps, as they turn up."""
    full = star(spark, d, "units", "places")
    rows = full.units.withColumn("period", key_period("unit_version"))
    numbers, path = new_path(spark, "numbers"), new_path(spark, "bitmaps")
    s.extend_numbers(rows.where(F.col("period") < "199601"), numbers, "unit_id")
    s.extend_numbers(rows, numbers, "unit_id")
    kept = s.bitmap_summary("units", read_stored(spark, numbers), "unit_id", "place_id")
    s.refresh(rows, sync.fingerprint(rows), path, kept)
    placed = read_stored(spark, path).join(full.places.select("place_id", "region"), "place_id")
    return s.distinct_from_bitmaps(placed.withColumn("year", year()), ["region", "year"], "units")


@query("distinct_sketches", with_ctes([STAFF], """
SELECT strftime(period_date, '%Y') AS year, count(DISTINCT person_id) AS persons, TRUE AS within
FROM staff GROUP BY 1"""))
def distinct_sketches(spark, d):
    """Persons per year, exact, and whether the estimate of the monthly sketches is within its error."""
    rows = star(spark, d, "staff").staff.withColumn("period", period_key("period_date"))
    path = new_path(spark, "sketches")
    s.refresh(rows, sync.fingerprint(rows), path, s.theta_summary("persons", "person_id"))
    about = s.distinct_from_sketches(read_stored(spark, path).withColumn("year", year()), ["year"], "_about")
    exact = rows.groupBy(year()).agg(F.count_distinct("person_id").alias("persons"))
    error = F.abs(F.col("_about") - F.col("persons"))
    return exact.join(about, "year").select("year", "persons", (error <= F.col("persons") * s.THETA_ERROR).alias("within"))


@query("quantile_sketches", with_ctes([ADMISSIONS], """
SELECT strftime(period_date, '%Y') AS year, count(cost) AS n_values, TRUE AS q25, TRUE AS q50, TRUE AS q95
FROM admissions GROUP BY 1"""))
def quantile_sketches(spark, d):
    """Costs per year: whether the quartile, median and 95th percentile of the merged monthly sketches have their ranks."""
    costs = star(spark, d, "admissions", lean=("orders", "part", "supplier")).admissions.select("cost", period_key("period_date").alias("period"))
    rows = stage(costs, "costs")  # read for the hashes, the sketches and the check: joined once
    ranks, path = {"q25": 0.25, "q50": 0.5, "q95": 0.95}, new_path(spark, "quantiles")
    s.refresh(rows, sync.fingerprint(rows), path, s.quantile_summary("cost", "cost"))
    found = s.quantiles_from_sketches(read_stored(spark, path).withColumn("year", year()), ["year"], ranks)
    checks = []
    for name, rank in ranks.items():
        below, upto = (F.avg(c.cast("int")) for c in (F.col("cost") < F.col(name), F.col("cost") <= F.col(name)))
        checks.append(((below <= rank + s.KLL_ERROR) & (upto >= rank - s.KLL_ERROR)).alias(name))
    # A row a year: the sketches' answers are read beside each cost.
    return rows.withColumn("year", year()).join(found, "year").groupBy("year", "n_values").agg(*checks)
