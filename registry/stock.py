"""Beds, equipment and staff: monthly stocks."""

from __future__ import annotations

from registry.core import query, r2, with_ctes
from registry.standin import BEDS, EQUIPMENT, PLACES, STAFF, UNITS, YES, star
from snapmart.operators.filters import Scope
from snapmart.plans import queries as q

MONTH = "1998-06"
AT = "f.period_date = DATE '1998-06-01'"
JOINS = "f JOIN places p ON p.place_id = f.place_id JOIN units u USING (unit_version)"
EUROPE = Scope(region="EUROPE")
PUBLIC = "sum(CASE WHEN " + YES.format("public_flag") + " THEN quantity ELSE 0 END)"


@query("stock_summary", with_ctes([BEDS, PLACES, UNITS], f"""
SELECT coalesce(sum(existing), 0.0) AS existing, coalesce(sum(public_beds), 0.0) AS public_beds,
  coalesce(sum(contracted), 0.0) AS contracted,
  count(DISTINCT CASE WHEN coalesce(existing, 0) > 0 THEN u.unit_id END) AS units_with_beds
FROM beds {JOINS} WHERE {AT} AND p.region = 'EUROPE'"""))
def stock_summary(spark, d):
    return q.beds_summary(star(spark, d, "beds", "places", "units"), "1998-01", MONTH, EUROPE)


@query("stock_by_unit", with_ctes([BEDS, PLACES, UNITS], f"""
SELECT u.unit_id, p.place_name, p.state, sum(existing) AS existing FROM beds {JOINS} WHERE {AT}
GROUP BY ALL HAVING sum(existing) > 0"""))
def stock_by_unit(spark, d):
    return q.beds_by_unit(star(spark, d, "beds", "places", "units"), MONTH)


@query("top_stock_units", with_ctes([BEDS, PLACES, UNITS], f"""
SELECT u.unit_id, sum(existing) AS existing FROM beds {JOINS} WHERE {AT} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_stock_units(spark, d):
    return q.top_units_by_beds(star(spark, d, "beds", "places", "units"), MONTH)


@query("top_stock_kinds", with_ctes([BEDS, PLACES, UNITS], f"""
SELECT bed_kind, sum(existing) AS existing FROM beds {JOINS} WHERE {AT} AND bed_kind IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_stock_kinds(spark, d):
    return q.top_bed_kinds(star(spark, d, "beds", "places", "units"), MONTH)


@query("equip_summary", with_ctes([EQUIPMENT, PLACES, UNITS], f"""
SELECT coalesce(sum(quantity), 0.0) AS registered, coalesce(sum(in_use), 0.0) AS in_use,
  coalesce({PUBLIC}, 0.0) AS public FROM equipment {JOINS} WHERE {AT} AND equipment_kind = 'PROMO'"""))
def equip_summary(spark, d):
    s = star(spark, d, "equipment", "places", "units")
    return q.equipment_summary(s, "1998-01", MONTH, kind="PROMO")


@query("equip_kinds", with_ctes([EQUIPMENT, PLACES, UNITS], f"""
SELECT DISTINCT equipment_kind FROM equipment {JOINS} WHERE {AT} AND equipment_kind IS NOT NULL"""))
def equip_kinds(spark, d):
    return q.equipment_kinds(star(spark, d, "equipment", "places", "units"), MONTH)


@query("equip_codes", with_ctes([EQUIPMENT, PLACES, UNITS], f"""
SELECT DISTINCT equipment_code FROM equipment {JOINS}
WHERE {AT} AND equipment_kind = 'ECONOMY' AND equipment_code IS NOT NULL"""))
def equip_codes(spark, d):
    return q.equipment_codes(star(spark, d, "equipment", "places", "units"), MONTH, "ECONOMY")


@query("top_equip", with_ctes([EQUIPMENT, PLACES, UNITS], f"""
SELECT equipment_kind AS name, sum(quantity) AS quantity FROM equipment {JOINS}
WHERE {AT} AND equipment_kind IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_equip(spark, d):
    return q.top_equipment(star(spark, d, "equipment", "places", "units"), MONTH)


@query("top_equip_within_kind", with_ctes([EQUIPMENT, PLACES, UNITS], f"""
SELECT equipment_code AS name, sum(quantity) AS quantity FROM equipment {JOINS}
WHERE {AT} AND equipment_kind = 'ECONOMY' AND equipment_code IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_equip_within_kind(spark, d):
    return q.top_equipment(star(spark, d, "equipment", "places", "units"), MONTH, kind="ECONOMY")


@query("equip_trend", with_ctes([EQUIPMENT, PLACES, UNITS, f"""c AS (
SELECT strftime(f.period_date, '%Y-%m') AS month, u.unit_id, sum(quantity) AS a, sum(in_use) AS b, {PUBLIC} AS c
FROM equipment {JOINS} WHERE f.period_date >= DATE '1996-01-01' AND f.period_date < DATE '2001-01-01' GROUP BY 1, 2)"""],
f"""SELECT month, {r2('avg(a)')} AS mean_registered, {r2('avg(b)')} AS mean_in_use, {r2('avg(c)')} AS mean_public
FROM c GROUP BY 1"""))
def equip_trend(spark, d):
    return q.equipment_by_month(star(spark, d, "equipment", "places", "units"), "1996-01", "2000-12")


@query("staff_summary", with_ctes([STAFF, PLACES, UNITS, f"""b AS (
SELECT u.unit_id, person_id, public_link, hours FROM staff {JOINS} WHERE {AT} AND person_id IS NOT NULL)"""], f"""
SELECT count(DISTINCT person_id) AS people,
  count(DISTINCT CASE WHEN {YES.format('public_link')} THEN person_id END) AS public_people,
  {r2('avg(hours)')} AS mean_hours,
  (SELECT {r2('avg(n)')} FROM (SELECT count(DISTINCT person_id) AS n FROM b GROUP BY unit_id)) AS mean_people_per_unit,
  avg(hours) IS NOT NULL AS has_hours
FROM b"""))
def staff_summary(spark, d):
    return q.staff_summary(star(spark, d, "staff", "places", "units"), "1998-01", MONTH)


@query("top_occupations", with_ctes([STAFF, PLACES, UNITS], f"""
SELECT occupation, count(DISTINCT person_id) AS people FROM staff {JOINS}
WHERE {AT} AND person_id IS NOT NULL AND occupation IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_occupations(spark, d):
    return q.top_occupations(star(spark, d, "staff", "places", "units"), MONTH)
