"""The analytical queries, each ``(star, parameters) -> DataFrame``.

Two habits run through them:

* a fact is aggregated to (facility version, place, category) before it meets a
  dimension, so what is shuffled and joined is the partial aggregate: a facility
  holding a third of the rows arrives as one row per task;
* a stock (beds, equipment, staff) is only read at one month or averaged per
  month, never summed over months.

``months`` are ``YYYY-MM`` texts, days are ``datetime.date``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.functions.codes import is_yes
from snapmart.functions.dates import (
    check_month_range, day_range, month_label, month_of, parse_month, stay_days,
)
from snapmart.operators.aggregate import (
    exact,
    AGE_BANDS, banded, detail_and_total_distinct, distinct_count, distinct_if, distinct_values,
    distributions, latest_per_key, mean, rounded, side_by_side, top_k, top_n_others, total,
    two_level,
)
from snapmart.operators.filters import (
    Person, Scope, equals_if_given, keep_places, keep_units, snapshot_at, snapshots,
    versions_in, where_all, with_unit_id,
)
from snapmart.plans.star import Star

EVERYWHERE = Scope()
ANYONE = Person()


# ---- filter lists -------------------------------------------------------------

def regions(star: Star) -> DataFrame:
    return star.places.select("region").where(F.col("region").isNotNull()).distinct().orderBy("region")


def states(star: Star, region: str | None = None) -> DataFrame:
    rows = where_all(star.places, Scope(region=region).place_predicates())
    return rows.select("state").where(F.col("state").isNotNull()).distinct().orderBy("state")


def places(star: Star, scope: Scope = EVERYWHERE) -> DataFrame:
    rows = where_all(star.places, scope.place_predicates())
    return rows.select("place_id", "place_name", "state", "region").orderBy("place_name", "place_id")


def unit_list(star: Star, scope: Scope = EVERYWHERE) -> DataFrame:
    """Facilities with names and places; several rows when a facility moved."""
    homes = star.units.select("unit_id", "place_id").distinct()
    placed = homes.join(where_all(star.places, scope.place_predicates()), "place_id")
    return (
        _with_names(placed, star)
        .select("unit_id", "trade_name", "legal_name", "place_id", "place_name", "state", "region")
        .distinct()
        .orderBy(F.col("trade_name").asc_nulls_last(), "unit_id", "place_id")
    )


# ---- overview -----------------------------------------------------------------

def overview(star: Star, start: dt.date, end: dt.date, scope: Scope = EVERYWHERE) -> DataFrame:
    """Admissions and mean stay in the days, facilities in the months, beds at the
    last month: one row."""
    admissions = _admissions(star, start, end, scope).agg(
        F.count("*").alias("admissions"),
        mean(stay_days("entry_date", "exit_date")).alias("mean_stay"),
    )
    units = keep_places(
        snapshots(star.units, start, end), star.places, "place_id", scope, always=True
    ).agg(F.count_distinct("unit_id").alias("units"))
    beds = keep_places(
        snapshot_at(star.beds, end), star.places, "place_id", scope, always=True
    ).agg(total("existing").alias("beds"))
    return side_by_side(admissions, units, beds)


def admissions_by_month(star: Star, start: dt.date, end: dt.date, scope: Scope = EVERYWHERE) -> DataFrame:
    rows = _admissions(star, start, end, scope)
    counts = rows.groupBy(month_of("entry_date").alias("month")).agg(F.count("*").alias("admissions"))
    return _labelled(counts).orderBy("month")


def top_units_by_admissions(
    star: Star, start: dt.date, end: dt.date, scope: Scope = EVERYWHERE, k: int = 10
) -> DataFrame:
    """Busiest facilities with the best name known for each."""
    per_version = _admissions(star, start, end, scope).groupBy("unit_version").agg(F.count("*").alias("_n"))
    per_unit = (
        with_unit_id(per_version, star.units, "unit_version")
        .groupBy("unit_id")
        .agg(F.sum("_n").alias("admissions"))
    )
    named = _with_names(per_unit, star).select(
        "unit_id",
        F.coalesce("trade_name", "legal_name", "unit_id").alias("unit_name"),
        "admissions",
    )
    return top_k(named, "admissions", ["unit_id", "unit_name"], k)


def top_diagnoses(
    star: Star,
    start: dt.date,
    end: dt.date,
    scope: Scope = EVERYWHERE,
    person: Person = ANYONE,
    k: int = 10,
) -> DataFrame:
    """Most frequent diagnoses, optionally of one facility or group of people."""
    rows = _admissions(star, start, end, scope, person).where(F.col("diagnosis").isNotNull())
    counts = rows.groupBy("diagnosis").agg(F.count("*").alias("admissions"))
    return top_k(counts, "admissions", ["diagnosis"], k)


# ---- facilities ---------------------------------------------------------------

def licence_coverage(star: Star, first: str, last: str, scope: Scope = EVERYWHERE) -> DataFrame:
    """Facilities with and without a licence in the months.

    The licence side is reduced to one row per facility version, so the left join
    cannot multiply rows.
    """
    start, end = check_month_range(first, last)
    rows = keep_places(
        snapshots(star.units, start, end), star.places, "place_id", scope, always=True
    ).select("unit_version", "unit_id")
    # A licence row names a version of its own month: the other months cannot match.
    licensed = (
        versions_in(star.licences, start, end).where(F.col("licence").isNotNull())
        .select("unit_version", F.lit(1).alias("_licensed"))
        .distinct()
    )
    per_unit = (
        rows.join(licensed, "unit_version", "left")
        .where(F.col("unit_id").isNotNull())
        .groupBy("unit_id")
        .agg(F.max("_licensed").alias("_licensed"))
    )
    return per_unit.agg(
        F.count("*").alias("units"),
        F.count("_licensed").alias("with_licence"),
        (F.count("*") - F.count("_licensed")).alias("without_licence"),
    )


def top_unit_kinds(star: Star, month: str, scope: Scope = EVERYWHERE, k: int = 10) -> DataFrame:
    rows = snapshot_at(star.units, parse_month(month)).where(F.col("unit_kind").isNotNull())
    kept = keep_places(rows, star.places, "place_id", scope, always=True)
    counts = kept.groupBy("unit_kind").agg(F.count_distinct("unit_id").alias("units"))
    return top_k(counts, "units", ["unit_kind"], k)


def admissions_per_unit_by_month(
    star: Star, start: dt.date, end: dt.date, scope: Scope = EVERYWHERE
) -> DataFrame:
    """Per month: total, mean and median admissions per facility that had any.

    A median holds one counter per distinct count. Counts of one month add up to
    its rows, so n rows give at most sqrt(2n) distinct counts.
    """
    rows = keep_units(
        star.admissions.where(day_range("entry_date", start, end)), star.units, "unit_version", scope
    )
    per_version = rows.groupBy(
        month_of("entry_date").alias("month"), "care_place", "unit_version"
    ).agg(F.count("*").alias("_n"))
    placed = keep_places(per_version, star.places, "care_place", scope, always=True)
    months = two_level(
        with_unit_id(placed, star.units, "unit_version", scope),
        ["month", "unit_id"],
        [F.sum("_n").alias("_n")],
        ["month"],
        [
            F.sum("_n").alias("admissions"),
            mean("_n").alias("mean_per_unit"),
            rounded(F.median("_n")).alias("median_per_unit"),
        ],
    )
    return _labelled(months).orderBy("month")


def top_units_by_icu_days(
    star: Star, start: dt.date, end: dt.date, scope: Scope = EVERYWHERE, k: int = 10
) -> DataFrame:
    """Facilities with the longest mean ICU stay."""
    rows = star.admissions.where(day_range("entry_date", start, end) & F.col("icu_days").isNotNull())
    per_version = rows.groupBy("care_place", "unit_version").agg(
        F.sum(exact("icu_days")).alias("_days"), F.count("*").alias("_n")
    )
    placed = keep_places(per_version, star.places, "care_place", scope, always=True)
    per_unit = with_unit_id(placed, star.units, "unit_version").groupBy("unit_id").agg(
        rounded(F.sum("_days").cast("double") / F.sum("_n")).alias("mean_icu_days"),
        F.sum("_n").alias("admissions"),
    )
    return top_k(per_unit, "mean_icu_days", ["unit_id"], k)


def latest_licence(star: Star, unit: str | None = None) -> DataFrame:
    """The most recent licence of a facility, or of each facility."""
    held = star.licences.where(F.col("licence").isNotNull()).select("unit_version", "licence", "issued_on")
    order = [F.col("issued_on").desc_nulls_last(), F.col("licence")]
    # One licence per version first: the join on the version reuses that shuffle.
    newest = latest_per_key(held, ["unit_version"], order)
    rows = with_unit_id(newest, star.units, "unit_version", Scope(unit=unit))
    return latest_per_key(rows.select("unit_id", "licence", "issued_on"), ["unit_id"], order)


def unit_infrastructure(star: Star, month: str, unit: str | None = None) -> DataFrame:
    """Beds by kind, equipment by kind, staff by occupation and staff in total, as
    (unit_id, group, category, quantity), for one facility or for each."""
    day = parse_month(month)
    scope = Scope(unit=unit)
    versions = versions_in(star.units, day, day)

    def stock(fact: DataFrame, kind: str, amount: str, label: str) -> DataFrame:
        rows = keep_units(snapshot_at(fact, day), star.units, "unit_version", scope)
        partial = rows.where(F.col(kind).isNotNull()).groupBy("unit_version", kind).agg(F.sum(amount).alias("_q"))
        return (
            with_unit_id(partial, versions, "unit_version", scope)
            .groupBy("unit_id", kind)
            .agg(total("_q").alias("quantity"))
            .select("unit_id", F.lit(label).alias("group"), F.col(kind).alias("category"), "quantity")
        )

    people = (
        keep_units(snapshot_at(star.staff, day), star.units, "unit_version", scope)
        .where(F.col("person_id").isNotNull())
        .select("unit_version", "occupation", "person_id")
        .distinct()
    )
    counted = detail_and_total_distinct(
        with_unit_id(people, versions, "unit_version", scope), ["unit_id"], "occupation", "person_id"
    )
    staff = counted.where((F.col("is_total") == 1) | F.col("occupation").isNotNull()).select(
        "unit_id",
        F.when(F.col("is_total") == 1, "staff_total").otherwise("staff").alias("group"),
        F.col("occupation").alias("category"),
        F.col("quantity").cast("double").alias("quantity"),
    )
    return (
        stock(star.beds, "bed_kind", "existing", "beds")
        .unionByName(stock(star.equipment, "equipment_kind", "quantity", "equipment"))
        .unionByName(staff)
    )


def infrastructure_shares(star: Star, month: str, unit: str | None = None, n: int = 10) -> DataFrame:
    """The infrastructure groups cut to their ``n`` largest parts and the rest."""
    parts = unit_infrastructure(star, month, unit).where(F.col("group") != "staff_total")
    return top_n_others(parts, ["unit_id", "group"], "category", "quantity", n)


# ---- beds ---------------------------------------------------------------------

def beds_summary(star: Star, first: str, last: str, scope: Scope = EVERYWHERE) -> DataFrame:
    """Beds at the last month; the first one is only checked."""
    _, end = check_month_range(first, last)
    rows = _stock_at(
        star, star.beds, end, scope, [],
        [
            F.sum("existing").alias("_existing"),
            F.sum("public_beds").alias("_public"),
            F.sum("contracted").alias("_contracted"),
            F.max(F.coalesce("existing", F.lit(0.0))).alias("_largest"),
        ],
    )
    return rows.agg(
        total("_existing").alias("existing"),
        total("_public").alias("public_beds"),
        total("_contracted").alias("contracted"),
        distinct_if(F.col("_largest") > 0, "unit_id").alias("units_with_beds"),
    )


def beds_by_unit(star: Star, month: str, scope: Scope = EVERYWHERE) -> DataFrame:
    """Every facility with beds, largest first."""
    rows = _stock_at(star, star.beds, parse_month(month), scope, ["place_id"], [F.sum("existing").alias("_q")])
    named = rows.join(star.places.select("place_id", "place_name", "state"), "place_id")
    per_unit = named.groupBy("unit_id", "place_name", "state").agg(F.sum("_q").alias("existing"))
    return per_unit.where(F.col("existing") > 0).orderBy(F.col("existing").desc(), "unit_id", "place_name", "state")


def top_units_by_beds(star: Star, month: str, scope: Scope = EVERYWHERE, k: int = 10) -> DataFrame:
    rows = _stock_at(star, star.beds, parse_month(month), scope, [], [F.sum("existing").alias("_q")])
    return top_k(rows.groupBy("unit_id").agg(F.sum("_q").alias("existing")), "existing", ["unit_id"], k)


def top_bed_kinds(star: Star, month: str, scope: Scope = EVERYWHERE, k: int = 10) -> DataFrame:
    rows = star.beds.where(F.col("bed_kind").isNotNull())
    parts = _stock_at(star, rows, parse_month(month), scope, ["bed_kind"], [F.sum("existing").alias("_q")])
    return top_k(parts.groupBy("bed_kind").agg(F.sum("_q").alias("existing")), "existing", ["bed_kind"], k)


# ---- equipment ------------------------------------------------------------------

def equipment_summary(
    star: Star,
    first: str,
    last: str,
    scope: Scope = EVERYWHERE,
    kind: str | None = None,
    code: str | None = None,
) -> DataFrame:
    """Equipment registered, in use and open to the public system at the last month."""
    _, end = check_month_range(first, last)
    rows = _stock_at(star, _equipment(star, kind, code), end, scope, [], _equipment_sums())
    return rows.agg(
        total("_quantity").alias("registered"),
        total("_in_use").alias("in_use"),
        total("_public").alias("public"),
    )


def equipment_kinds(star: Star, month: str, scope: Scope = EVERYWHERE) -> DataFrame:
    rows = star.equipment.where(F.col("equipment_kind").isNotNull())
    return (
        _stock_at(star, rows, parse_month(month), scope, ["equipment_kind"], [])
        .select("equipment_kind").distinct().orderBy("equipment_kind")
    )


def equipment_codes(star: Star, month: str, kind: str, scope: Scope = EVERYWHERE) -> DataFrame:
    rows = _equipment(star, kind).where(F.col("equipment_code").isNotNull())
    return (
        _stock_at(star, rows, parse_month(month), scope, ["equipment_code"], [])
        .select("equipment_code").distinct().orderBy("equipment_code")
    )


def top_equipment(
    star: Star, month: str, scope: Scope = EVERYWHERE, kind: str | None = None, k: int = 10
) -> DataFrame:
    """Largest equipment kinds or, within a kind, its largest codes."""
    grain = "equipment_code" if kind else "equipment_kind"
    rows = _equipment(star, kind).where(F.col(grain).isNotNull())
    parts = _stock_at(star, rows, parse_month(month), scope, [grain], [F.sum("quantity").alias("_q")])
    sums = parts.groupBy(F.col(grain).alias("name")).agg(F.sum("_q").alias("quantity"))
    return top_k(sums, "quantity", ["name"], k)


def equipment_by_month(
    star: Star,
    first: str,
    last: str,
    scope: Scope = EVERYWHERE,
    kind: str | None = None,
    code: str | None = None,
) -> DataFrame:
    """Per month, the mean per facility of registered, used and public equipment."""
    start, end = check_month_range(first, last)
    rows = snapshots(_equipment(star, kind, code), start, end)
    rows = keep_units(rows, star.units, "unit_version", scope)
    partial = rows.groupBy(
        month_of("period_date").alias("month"), "place_id", "unit_version"
    ).agg(*_equipment_sums())
    placed = keep_places(partial, star.places, "place_id", scope, always=True)
    months = two_level(
        with_unit_id(placed, versions_in(star.units, start, end), "unit_version", scope),
        ["month", "unit_id"],
        [F.sum(c).alias(c) for c in ("_quantity", "_in_use", "_public")],
        ["month"],
        [
            mean("_quantity").alias("mean_registered"),
            mean("_in_use").alias("mean_in_use"),
            mean("_public").alias("mean_public"),
        ],
    )
    return _labelled(months).orderBy("month")


# ---- staff ----------------------------------------------------------------------

def staff_summary(star: Star, first: str, last: str, scope: Scope = EVERYWHERE) -> DataFrame:
    """People, people with a public link, mean hours per registry line and mean
    people per facility at the last month.

    One pass reduces the registry to a row per (facility, person); all four
    numbers follow from it. Hours keep their row weights as sum and count.
    """
    _, end = check_month_range(first, last)
    rows = star.staff.where(F.col("person_id").isNotNull())
    pairs = (
        _stock_at(
            star, rows, end, scope, ["person_id"],
            [
                F.max(is_yes("public_link")).alias("_public"),
                F.sum("hours").alias("_hours"),
                F.count("hours").alias("_lines"),
            ],
        )
        .groupBy("unit_id", "person_id")
        .agg(F.max("_public").alias("_public"), F.sum("_hours").alias("_hours"), F.sum("_lines").alias("_lines"))
    )
    # Both roll-ups of the pairs in one pass: a row per person, a row per facility.
    rolled = pairs.groupingSets([["person_id"], ["unit_id"]], "person_id", "unit_id").agg(
        F.grouping("unit_id").alias("_is_person"),
        F.max("_public").alias("_public"),
        F.sum("_hours").alias("_hours"),
        F.sum("_lines").alias("_lines"),
        F.count("*").alias("_n"),
    )
    is_person = F.col("_is_person") == 1
    lines = F.nullif(F.sum(F.when(is_person, F.col("_lines"))), F.lit(0))
    return rolled.agg(
        F.count_if(is_person).alias("people"),
        F.count_if(is_person & F.col("_public")).alias("public_people"),
        rounded(F.sum(F.when(is_person, F.col("_hours"))) / lines).alias("mean_hours"),
        mean(F.when(~is_person, F.col("_n"))).alias("mean_people_per_unit"),
    ).withColumn("has_hours", F.col("mean_hours").isNotNull())


def top_occupations(
    star: Star, month: str, scope: Scope = EVERYWHERE, k: int = 10, approximate: bool = False
) -> DataFrame:
    """Occupations with the most distinct people."""
    rows = star.staff.where(F.col("person_id").isNotNull() & F.col("occupation").isNotNull())
    people = _stock_at(star, rows, parse_month(month), scope, ["occupation", "person_id"], [])
    counts = people.groupBy("occupation").agg(distinct_count("person_id", approximate).alias("people"))
    return top_k(counts, "people", ["occupation"], k)


# ---- admissions -------------------------------------------------------------------

def admissions_summary(
    star: Star, start: dt.date, end: dt.date, scope: Scope = EVERYWHERE, person: Person = ANYONE
) -> DataFrame:
    return _admissions(star, start, end, scope, person).agg(
        F.count("*").alias("admissions"),
        mean(stay_days("entry_date", "exit_date")).alias("mean_stay"),
        mean("icu_days").alias("mean_icu_days"),
        mean("cost").alias("mean_cost"),
    )


def filter_values(star: Star, start: dt.date, end: dt.date, scope: Scope = EVERYWHERE) -> DataFrame:
    """Values on offer for the demographic filters, as (column, value)."""
    columns = ["sex", "race", "ethnicity", "admission_type"]
    rows = keep_units(
        star.admissions.where(day_range("entry_date", start, end)), star.units, "unit_version", scope
    )
    # Few admissions share a facility version: reducing them to its values first would shuffle as many rows three times.
    placed = keep_places(rows.select("care_place", "unit_version", *columns), star.places, "care_place", scope, always=True)
    kept = placed.join(star.units.select("unit_version"), "unit_version", "left_semi")
    return distinct_values(kept, columns, wide=["ethnicity"]).orderBy("column", "value")


def demographics(
    star: Star,
    start: dt.date,
    end: dt.date,
    scope: Scope = EVERYWHERE,
    person: Person = ANYONE,
    top_ethnicities: int = 10,
) -> DataFrame:
    """Admissions by sex, age band, race and ethnicity as (group, category, quantity)."""
    rows = _admissions(star, start, end, scope, person).withColumn("age_band", banded("age", AGE_BANDS))
    return distributions(
        rows,
        {"sex": "sex", "age_band": "age", "race": "race", "ethnicity": "ethnicity"},
        top={"ethnicity": top_ethnicities},
    )


# ---- shared parts -------------------------------------------------------------------

def _admissions(
    star: Star, start: dt.date, end: dt.date, scope: Scope, person: Person = ANYONE
) -> DataFrame:
    """Admissions entering on the days, joined to a dimension only if filtered by it."""
    rows = where_all(star.admissions.where(day_range("entry_date", start, end)), person.predicates())
    placed = keep_places(rows, star.places, "care_place", scope)
    return keep_units(placed, star.units, "unit_version", scope)


def _stock_at(
    star: Star, fact: DataFrame, month: dt.date, scope: Scope, keys: list[str], aggs: list[Column]
) -> DataFrame:
    """A stock at one month, reduced per (facility version, place, keys), with
    known place and facility, as rows carrying ``unit_id``."""
    grain = list(dict.fromkeys(["unit_version", "place_id", *keys]))
    rows = keep_units(snapshot_at(fact, month), star.units, "unit_version", scope)
    grouped = rows.groupBy(*grain)
    partial = grouped.agg(*aggs) if aggs else grouped.agg(F.count("*").alias("_rows"))
    placed = keep_places(partial, star.places, "place_id", scope, always=True)
    return with_unit_id(placed, versions_in(star.units, month, month), "unit_version", scope)


def _equipment(star: Star, kind: str | None = None, code: str | None = None) -> DataFrame:
    return where_all(star.equipment, equals_if_given({"equipment_kind": kind, "equipment_code": code}))


def _equipment_sums() -> list[Column]:
    return [
        F.sum("quantity").alias("_quantity"),
        F.sum("in_use").alias("_in_use"),
        F.sum(F.when(is_yes("public_flag"), F.col("quantity")).otherwise(0.0)).alias("_public"),
    ]


def _labelled(months: DataFrame) -> DataFrame:
    """Month dates as ``YYYY-MM``, once per group instead of once per row."""
    return months.withColumn("month", month_label("month"))


def _with_names(df: DataFrame, star: Star) -> DataFrame:
    return df.join(star.names.select("unit_id", "trade_name", "legal_name"), "unit_id", "left")
