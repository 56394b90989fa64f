"""Query semantics on a hand-made star, and every cheap registered query against
its SQL on the smallest test data."""

import datetime as dt
import os
import subprocess
import sys

import pytest

from registry import load_all
from tools.check import TABLES, compare

from snapmart.operators.filters import Person, Scope
from snapmart.plans import queries as q
from snapmart.plans.schemas import schema
from snapmart.plans.star import Star, open_star, serving_table

JAN, DEC = dt.date(2025, 1, 1), dt.date(2025, 12, 31)


def frame(spark, name, *rows):
    fields = schema(name).names
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], schema(name))


def stay(unit, place, day, **more):
    return {"unit_version": unit, "care_place": place, "entry_date": day, "exit_date": day + dt.timedelta(2), **more}


@pytest.fixture(scope="module")
def star(spark):
    month = dt.date(2025, 1, 1)
    return Star(
        places=frame(spark, "places", {"place_id": "p1", "place_name": "One", "region": "N", "state": "AA"},
                     {"place_id": "p2", "place_name": "Two", "region": "S", "state": "BB"}),
        units=frame(spark, "units", {"unit_version": "2025010000001", "unit_id": "0000001", "period_date": month, "unit_kind": "H", "place_id": "p1"},
                    {"unit_version": "2025010000002", "unit_id": "0000002", "period_date": month, "unit_kind": None, "place_id": "p2"}),
        names=frame(spark, "names", {"unit_id": "0000002", "trade_name": None, "legal_name": "Legal Two"}),
        admissions=frame(
            spark, "admissions",
            stay("2025010000001", "p1", JAN, sex="m", age=0.0, diagnosis="d1", ethnicity="e1"),
            stay("2025010000002", "p2", dt.date(2025, 1, 31), sex="f", age=17.5, diagnosis="d1"),
            stay("2025010000009", "p9", dt.date(2025, 2, 1), sex=None, age=80.0, diagnosis=None),
        ),
        beds=frame(spark, "beds", {"period_date": month, "existing": 3.0, "unit_version": "2025010000001", "place_id": "p1", "bed_kind": "k"},
                   {"period_date": month, "existing": None, "unit_version": "2025010000002", "place_id": "p2", "bed_kind": "k2"},
                   {"period_date": dt.date(2025, 2, 1), "existing": 100.0, "unit_version": "2025010000001", "place_id": "p1", "bed_kind": "k"}),
        licences=frame(spark, "licences", {"unit_version": "2025010000001", "licence": "L2", "issued_on": None},
                       {"unit_version": "2025010000001", "licence": "L1", "issued_on": JAN}),
    )


def test_unfiltered_totals_keep_facts_without_a_place(star):
    assert q.admissions_summary(star, JAN, DEC).first().admissions == 3
    assert q.admissions_summary(star, JAN, DEC, Scope(region="N")).first().admissions == 1
    assert q.admissions_summary(star, JAN, DEC, Scope(unit="0000002")).first().admissions == 1
    assert q.admissions_summary(star, JAN, dt.date(2025, 1, 31)).first().admissions == 2


def test_age_zero_is_a_bound(star):
    assert q.admissions_summary(star, JAN, DEC, person=Person(age_max=0)).first().admissions == 1
    assert q.admissions_summary(star, JAN, DEC, person=Person(age_min=0)).first().admissions == 3


def test_names_fall_back(star):
    got = [(r.unit_id, r.unit_name, r.admissions) for r in q.top_units_by_admissions(star, JAN, DEC).collect()]
    assert got == [("0000001", "0000001", 1), ("0000002", "Legal Two", 1)]


def test_stock_is_read_at_one_month(star):
    r = q.beds_summary(star, "2025-01", "2025-01").first()
    assert (r.existing, r.units_with_beds) == (3.0, 1)
    assert [r.unit_id for r in q.beds_by_unit(star, "2025-01").collect()] == ["0000001"]
    assert [r.existing for r in q.top_bed_kinds(star, "2025-01").collect()] == [3.0, None]
    o = q.overview(star, JAN, dt.date(2025, 1, 31)).first()
    assert (o.admissions, o.mean_stay, o.units, o.beds) == (2, 2.0, 2, 3.0)
    empty = q.overview(star, dt.date(2030, 1, 1), dt.date(2030, 1, 2)).first()
    assert (empty.admissions, empty.mean_stay, empty.units, empty.beds) == (0, None, 0, 0.0)


def test_licences(star):
    r = q.licence_coverage(star, "2025-01", "2025-03").first()
    assert (r.units, r.with_licence, r.without_licence) == (2, 1, 1)
    assert [r.licence for r in q.latest_licence(star, "0000001").collect()] == ["L1"]


def test_demographics(star):
    got = {(r.group, r.category): r.quantity for r in q.demographics(star, JAN, DEC).collect()}
    assert got == {("sex", "m"): 1, ("sex", "f"): 1, ("age", "0-17"): 1, ("age", "75+"): 1, ("ethnicity", "e1"): 1}


def test_parameters_are_checked(star):
    with pytest.raises(ValueError):
        q.admissions_by_month(star, DEC, JAN)
    with pytest.raises(ValueError):
        q.beds_summary(star, "2025-02", "2025-01")


def test_stored_names_open_as_a_star(spark, tmp_path):
    spark.createDataFrame([("p1", " ", "N", "AA")], "id_municipio string, nome_municipio string, regiao string, uf string").write.parquet(str(tmp_path / "m"))
    opened = open_star(spark, {"places": str(tmp_path / "m")}, clean=True)
    assert [tuple(r) for r in q.places(opened).collect()] == [("p1", None, "AA", "N")]
    assert serving_table(opened.places, "places").columns == schema("places").names


def test_month_filter_reaches_the_scan(spark, star, tmp_path):
    path = str(tmp_path / "beds")
    from pyspark.sql import functions as F

    star.beds.withColumn("period", F.date_format("period_date", "yyyyMM")).write.partitionBy("period").parquet(path)
    stored = Star(beds=open_star(spark, {"beds": path}).beds, places=star.places, units=star.units)
    df = q.top_units_by_beds(stored, "2025-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(period_date,2025-01-01)" in plan
    assert "PartitionFilters: [isnotnull(period" in plan
    assert df.first().existing == 3.0


# ---- registry ---------------------------------------------------------------------

SF = "/root/testdata/sf0.001"
# Run by hand with tools/check.py: they build both layers over all months.
LONG = ("layer_demo", "layer_quality")


def test_every_query_has_its_sql():
    assert set(load_all().QUERIES) == set(load_all().ORACLE)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(set(load_all().QUERIES) - set(LONG)))
def test_registered_query_matches_its_sql(spark, duck, name):
    result = compare(load_all().QUERIES[name](spark, SF), duck, load_all().ORACLE[name])
    assert result.startswith("ok ("), result


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_registry_needs_no_session():
    """The queries can be listed before a Spark session exists."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
