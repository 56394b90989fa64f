"""Admissions, filter lists and facilities."""

from __future__ import annotations

import datetime as dt

from registry.core import query, r2, with_ctes
from registry.standin import ADMISSIONS, BEDS, EQUIPMENT, LICENCES, NAMES, PLACES, STAFF, UNITS, star
from snapmart.operators.aggregate import rank_list
from snapmart.operators.filters import Person, Scope
from snapmart.plans import queries as q

START, END = dt.date(1996, 1, 1), dt.date(2000, 12, 31)
DAYS = "entry_date >= DATE '1996-01-01' AND entry_date < DATE '2001-01-01'"
ASIA = Scope(region="ASIA")
IN_ASIA = "EXISTS (SELECT 1 FROM places p WHERE p.place_id = {} AND p.region = 'ASIA')"
KNOWN_PLACE = "JOIN places p ON p.place_id = {}"


@query("dim_regions", "SELECT DISTINCT r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def dim_regions(spark, d):
    return q.regions(star(spark, d, "places"))


@query("dim_states", with_ctes([PLACES], "SELECT DISTINCT state FROM places WHERE region = 'EUROPE'"))
def dim_states(spark, d):
    return q.states(star(spark, d, "places"), "EUROPE")


@query("dim_places", with_ctes([PLACES], "SELECT place_id, place_name, state, region FROM places WHERE region = 'AMERICA'"))
def dim_places(spark, d):
    return q.places(star(spark, d, "places"), Scope(region="AMERICA"))


@query("unit_list", with_ctes([PLACES, UNITS, NAMES], """
SELECT DISTINCT u.unit_id, n.trade_name, n.legal_name, p.place_id, p.place_name, p.state, p.region
FROM units u JOIN places p USING (place_id) LEFT JOIN names n USING (unit_id)"""))
def unit_list(spark, d):
    return q.unit_list(star(spark, d, "places", "units", "names"))


@query("flow_by_month", with_ctes([ADMISSIONS], f"""
SELECT strftime(entry_date, '%Y-%m') AS month, count(*) AS admissions
FROM admissions WHERE {DAYS} GROUP BY 1"""))
def flow_by_month(spark, d):
    return q.admissions_by_month(star(spark, d, "admissions", lean=("orders",)), START, END)


@query("flow_by_month_region", with_ctes([ADMISSIONS, PLACES], f"""
SELECT strftime(entry_date, '%Y-%m') AS month, count(*) AS admissions
FROM admissions WHERE {DAYS} AND {IN_ASIA.format('care_place')} GROUP BY 1"""))
def flow_by_month_region(spark, d):
    return q.admissions_by_month(star(spark, d, "admissions", "places", lean=("orders", "supplier")), START, END, ASIA)


ONE_UNIT = Scope(unit="0000003")
OF_UNIT = "unit_version IN (SELECT unit_version FROM units WHERE unit_id = '0000003')"


@query("flow_by_month_unit", with_ctes([ADMISSIONS, UNITS], f"""
SELECT strftime(entry_date, '%Y-%m') AS month, count(*) AS admissions
FROM admissions WHERE {DAYS} AND {OF_UNIT} GROUP BY 1"""))
def flow_by_month_unit(spark, d):
    return q.admissions_by_month(star(spark, d, "admissions", "units"), START, END, ONE_UNIT)


@query("top_reasons_unit", with_ctes([ADMISSIONS, UNITS], f"""
SELECT diagnosis, count(*) AS admissions FROM admissions WHERE {DAYS} AND diagnosis IS NOT NULL AND {OF_UNIT}
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_reasons_unit(spark, d):
    return q.top_diagnoses(star(spark, d, "admissions", "units"), START, END, ONE_UNIT)


OVERVIEW = """
SELECT (SELECT count(*) FROM a) AS admissions,
  (SELECT {mean} FROM a) AS mean_stay,
  (SELECT count(DISTINCT unit_id) FROM units u {place_u}
   WHERE u.period_date >= DATE '1996-01-01' AND u.period_date < DATE '2001-01-01' {and_u}) AS units,
  (SELECT coalesce(sum(existing), 0.0) FROM beds b {place_b}
   WHERE b.period_date = DATE '2000-12-01' {and_u}) AS beds"""


def _overview(extra_a: str, extra_u: str) -> str:
    return with_ctes(
        [ADMISSIONS, PLACES, UNITS, BEDS, f"a AS (SELECT * FROM admissions WHERE {DAYS} {extra_a})"],
        OVERVIEW.format(
            mean=r2("avg(exit_date - entry_date)"),
            place_u=KNOWN_PLACE.format("u.place_id"),
            place_b=KNOWN_PLACE.format("b.place_id"),
            and_u=extra_u,
        ),
    )


@query("overview_card", _overview("", ""))
def overview_card(spark, d):
    return q.overview(star(spark, d, "admissions", "places", "units", "beds", lean=("orders",)), START, END)


@query("overview_card_region", _overview("AND " + IN_ASIA.format("care_place"), "AND p.region = 'ASIA'"))
def overview_card_region(spark, d):
    s = star(spark, d, "admissions", "places", "units", "beds", lean=("orders", "supplier"))
    return q.overview(s, START, END, ASIA)


@query("top_units", with_ctes([ADMISSIONS, UNITS, NAMES], f"""
SELECT u.unit_id, coalesce(n.trade_name, n.legal_name, u.unit_id) AS unit_name, count(*) AS admissions
FROM admissions a JOIN units u USING (unit_version) LEFT JOIN names n USING (unit_id)
WHERE {DAYS} GROUP BY u.unit_id, n.trade_name, n.legal_name
ORDER BY admissions DESC, unit_id, unit_name LIMIT 10"""))
def top_units(spark, d):
    return q.top_units_by_admissions(star(spark, d, "admissions", "units", "names", lean=("orders",)), START, END)


@query("top_reasons", with_ctes([ADMISSIONS], f"""
SELECT diagnosis, count(*) AS admissions FROM admissions WHERE {DAYS} AND diagnosis IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_reasons(spark, d):
    return q.top_diagnoses(star(spark, d, "admissions", lean=("orders", "part")), START, END)


@query("top_reasons_demographic", with_ctes([ADMISSIONS, PLACES], f"""
SELECT diagnosis, count(*) AS admissions FROM admissions
WHERE {DAYS} AND diagnosis IS NOT NULL AND {IN_ASIA.format('care_place')}
  AND sex = 'N' AND race = '1-URGENT' AND admission_type = 'O' AND age >= 0 AND age <= 60
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_reasons_demographic(spark, d):
    who = Person(sex="N", race="1-URGENT", admission_type="O", age_min=0, age_max=60)
    return q.top_diagnoses(star(spark, d, "admissions", "places"), START, END, ASIA, who)


@query("rank_list", with_ctes([ADMISSIONS, f"""c AS (
SELECT diagnosis, count(*) AS admissions FROM admissions WHERE {DAYS} GROUP BY 1)"""], """
SELECT row_number() OVER (ORDER BY admissions DESC, diagnosis) AS position,
  coalesce(diagnosis, 'Não informado') AS label, admissions AS value
FROM c ORDER BY 1 LIMIT 10"""))
def ranked(spark, d):
    counts = q.top_diagnoses(star(spark, d, "admissions", lean=("orders", "part")), START, END)
    return rank_list(counts, "admissions", "diagnosis")


@query("coverage_with_without", with_ctes([UNITS, PLACES, LICENCES], """
SELECT count(DISTINCT u.unit_id) AS units,
  count(DISTINCT CASE WHEN l.licence IS NOT NULL THEN u.unit_id END) AS with_licence,
  count(DISTINCT u.unit_id) - count(DISTINCT CASE WHEN l.licence IS NOT NULL THEN u.unit_id END) AS without_licence
FROM units u JOIN places p USING (place_id) LEFT JOIN licences l USING (unit_version)
WHERE u.period_date >= DATE '1998-01-01' AND u.period_date < DATE '1998-03-01'"""))
def coverage_with_without(spark, d):
    return q.licence_coverage(star(spark, d, "units", "places", "licences"), "1998-01", "1998-02")


@query("top_kinds", with_ctes([UNITS, PLACES], """
SELECT unit_kind, count(DISTINCT unit_id) AS units FROM units u JOIN places p USING (place_id)
WHERE u.period_date = DATE '1998-06-01' AND unit_kind IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_kinds(spark, d):
    return q.top_unit_kinds(star(spark, d, "units", "places"), "1998-06")


@query("unit_month_mean_median", with_ctes([ADMISSIONS, UNITS, PLACES, f"""c AS (
SELECT strftime(entry_date, '%Y-%m') AS month, u.unit_id, count(*) AS n
FROM admissions a JOIN places p ON p.place_id = a.care_place JOIN units u USING (unit_version)
WHERE {DAYS} GROUP BY 1, 2)"""], f"""
SELECT month, CAST(sum(n) AS BIGINT) AS admissions, {r2('avg(n)')} AS mean_per_unit,
  {r2('median(n)')} AS median_per_unit FROM c GROUP BY 1"""))
def unit_month_mean_median(spark, d):
    s = star(spark, d, "admissions", "units", "places", lean=("orders", "supplier"))
    return q.admissions_per_unit_by_month(s, START, END)


@query("top_units_mean", with_ctes([ADMISSIONS, UNITS, PLACES], f"""
SELECT u.unit_id, {r2('avg(a.icu_days)')} AS mean_icu_days, count(*) AS admissions
FROM admissions a JOIN places p ON p.place_id = a.care_place JOIN units u USING (unit_version)
WHERE {DAYS} AND a.icu_days IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_units_mean(spark, d):
    s = star(spark, d, "admissions", "units", "places", lean=("orders", "supplier"))
    return q.top_units_by_icu_days(s, START, END)


@query("latest_per_key", with_ctes([UNITS, LICENCES, """r AS (
SELECT u.unit_id, l.licence, l.issued_on,
  row_number() OVER (PARTITION BY u.unit_id ORDER BY l.issued_on DESC NULLS LAST, l.licence) AS n
FROM licences l JOIN units u USING (unit_version) WHERE l.licence IS NOT NULL)"""],
"SELECT unit_id, licence, issued_on FROM r WHERE n = 1"))
def latest_per_key(spark, d):
    return q.latest_licence(star(spark, d, "units", "licences"))


INFRA = """i AS (
SELECT u.unit_id, 'beds' AS "group", f.bed_kind AS category, coalesce(sum(existing), 0.0) AS quantity
FROM beds f JOIN units u USING (unit_version) WHERE f.period_date = DATE '1998-06-01' AND bed_kind IS NOT NULL GROUP BY 1, 3
UNION ALL
SELECT u.unit_id, 'equipment', f.equipment_kind, coalesce(sum(quantity), 0.0)
FROM equipment f JOIN units u USING (unit_version) WHERE f.period_date = DATE '1998-06-01' AND equipment_kind IS NOT NULL GROUP BY 1, 3
UNION ALL
SELECT unit_id, CASE WHEN t = 1 THEN 'staff_total' ELSE 'staff' END, occupation, CAST(n AS DOUBLE) FROM (
  SELECT u.unit_id, f.occupation, count(DISTINCT person_id) AS n, grouping(f.occupation) AS t
  FROM staff f JOIN units u USING (unit_version)
  WHERE f.period_date = DATE '1998-06-01' AND person_id IS NOT NULL
  GROUP BY GROUPING SETS ((u.unit_id, f.occupation), (u.unit_id))) WHERE t = 1 OR occupation IS NOT NULL)"""


@query("unit_profile_grouping", with_ctes([UNITS, BEDS, EQUIPMENT, STAFF, INFRA], "SELECT * FROM i"))
def unit_profile_grouping(spark, d):
    return q.unit_infrastructure(star(spark, d, "units", "beds", "equipment", "staff"), "1998-06")


@query("topn_others", with_ctes([UNITS, BEDS, EQUIPMENT, STAFF, INFRA, """n AS (
SELECT *, row_number() OVER (PARTITION BY unit_id, "group" ORDER BY quantity DESC, category) AS k
FROM i WHERE "group" <> 'staff_total')"""], """
SELECT unit_id, "group", category, quantity FROM n WHERE k <= 3
UNION ALL
SELECT unit_id, "group", 'Outros', sum(quantity) FROM n WHERE k > 3 GROUP BY 1, 2 HAVING sum(quantity) > 0"""))
def topn_others(spark, d):
    s = star(spark, d, "units", "beds", "equipment", "staff")
    return q.infrastructure_shares(s, "1998-06", n=3)


@query("flow_summary", with_ctes([ADMISSIONS, PLACES], f"""
SELECT count(*) AS admissions, {r2('avg(exit_date - entry_date)')} AS mean_stay,
  {r2('avg(icu_days)')} AS mean_icu_days, {r2('avg(cost)')} AS mean_cost
FROM admissions WHERE {DAYS} AND {IN_ASIA.format('care_place')} AND sex = 'R' AND age >= 20 AND age <= 80"""))
def flow_summary(spark, d):
    return q.admissions_summary(
        star(spark, d, "admissions", "places"), START, END, ASIA, Person(sex="R", age_min=20, age_max=80)
    )


FILTERS = " UNION ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value FROM f WHERE {c} IS NOT NULL"
    for c in ("sex", "race", "ethnicity", "admission_type")
)


@query("filter_values", with_ctes([ADMISSIONS, PLACES, UNITS, f"""f AS (
SELECT a.* FROM admissions a JOIN places p ON p.place_id = a.care_place JOIN units u USING (unit_version) WHERE {DAYS})"""],
FILTERS))
def filter_values(spark, d):
    return q.filter_values(star(spark, d, "admissions", "places", "units"), START, END)


DEMOGRAPHICS = """
SELECT * FROM (
  SELECT CASE WHEN grouping(sex) = 0 THEN 'sex' WHEN grouping(band) = 0 THEN 'age'
              WHEN grouping(race) = 0 THEN 'race' ELSE 'ethnicity' END AS "group",
    CASE WHEN grouping(sex) = 0 THEN sex WHEN grouping(band) = 0 THEN band
         WHEN grouping(race) = 0 THEN race ELSE ethnicity END AS category,
    count(*) AS quantity
  FROM b GROUP BY GROUPING SETS ((sex), (band), (race), (ethnicity)))
WHERE category IS NOT NULL
QUALIFY "group" <> 'ethnicity' OR row_number() OVER (PARTITION BY "group" ORDER BY quantity DESC, category) <= 10"""


@query("demographics", with_ctes([ADMISSIONS, PLACES, f"""b AS (
SELECT sex, race, ethnicity, CASE WHEN age BETWEEN 0 AND 17 THEN '0-17' WHEN age BETWEEN 18 AND 29 THEN '18-29'
  WHEN age BETWEEN 30 AND 44 THEN '30-44' WHEN age BETWEEN 45 AND 59 THEN '45-59'
  WHEN age BETWEEN 60 AND 74 THEN '60-74' WHEN age >= 75 THEN '75+' END AS band
FROM admissions WHERE {DAYS} AND {IN_ASIA.format('care_place')})"""], DEMOGRAPHICS))
def demographics(spark, d):
    return q.demographics(star(spark, d, "admissions", "places"), START, END, ASIA)
