import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from snapmart.plans import colocated, queries
from snapmart.plans.star import Star
from snapmart.sources.buckets import join_bucketed, open_bucketed, write_bucketed

FACT = "k string, day date, n int, `odd ``name` string"


@pytest.fixture
def stored(spark, tmp_path):
    def store(rows, schema, name, buckets=4):
        frame = rows if hasattr(rows, "schema") else spark.createDataFrame(rows, schema)
        write_bucketed(frame, str(tmp_path / name), "k", buckets)
        return frame, open_bucketed(spark, str(tmp_path / name))

    return store


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    """The plan as it will run, without the final form adaptive execution adds later."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_round_trip_and_hot_keys(stored):
    rows = [("hot", dt.date(2025, 1, 1), i, None) for i in range(60)] + [(f"k{i}", None, i, "x") for i in range(40)]
    rows += [(None, None, i, "n") for i in range(7)]
    frame, table = stored(rows, FACT, "t")
    assert found(table.rows()) == found(frame)
    assert table.rows().columns == frame.columns
    assert [r[0] for r in table.hot_keys.collect()] == ["hot"] and table.n_hot == 1
    assert {r.k for r in table.hot.select("k").distinct().collect()} == {"hot", None}
    assert table.spread.count() == 40


@pytest.mark.parametrize("hot_left, hot_right", [(0, 0), (90, 0), (0, 90), (90, 90)])
def test_joins_equal_plain_joins(stored, hot_left, hot_right):
    """Hot keys on neither, either and both sides, nulls, repeats, keys of one side only."""
    left = [(f"k{i % 23}", i) for i in range(46)] + [("hot", i) for i in range(hot_left)] + [("other", i) for i in range(hot_left)]
    right = [(f"k{i % 31}", i) for i in range(5, 45)] + [("hot", i) for i in range(hot_right)]
    left += [(None, 1), ("hot", 2), ("k3", 7)]
    right += [(None, 1), ("hot", 3)]
    a, bucketed_a = stored(left, "k string, a int", "a")
    b, bucketed_b = stored(right, "k string, b int", "b")
    assert (bucketed_a.n_hot > 0, bucketed_b.n_hot > 0) == (hot_left > 0, hot_right > 0)
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert found(join_bucketed(bucketed_a, bucketed_b, how)) == found(a.join(b, "k", how))


@pytest.mark.parametrize("empty", ["a", "b", "both"])
def test_empty_tables(stored, empty):
    a, bucketed_a = stored([] if empty in ("a", "both") else [("x", 1)], "k string, a int", "a")
    b, bucketed_b = stored([] if empty in ("b", "both") else [("x", 2)], "k string, b int", "b")
    for how in ("inner", "left", "left_anti"):
        assert found(join_bucketed(bucketed_a, bucketed_b, how)) == found(a.join(b, "k", how))


def test_unlike_buckets_and_second_writes_are_refused(spark, stored, tmp_path):
    _, four = stored([("x", 1)], "k string, a int", "a")
    frame, eight = stored([("x", 1)], "k string, b int", "b", 8)
    with pytest.raises(ValueError, match="does not meet"):
        join_bucketed(four, eight)
    with pytest.raises(ValueError, match="full"):
        join_bucketed(four, four, "full")
    with pytest.raises(FileExistsError):
        write_bucketed(frame, str(tmp_path / "a"), "k", 4)
    with pytest.raises(ValueError, match="rename"):
        write_bucketed(frame.withColumnRenamed("b", "_hot"), str(tmp_path / "c"), "k", 4)
    (tmp_path / "half").mkdir()
    with pytest.raises(Exception, match="_buckets.json"):  # its writer died
        open_bucketed(spark, str(tmp_path / "half"))


def test_buckets_meet_without_a_shuffle(spark, stored):
    """With broadcasts off, the only exchanges are those of the hot parts."""
    many = spark.range(2000).select(F.concat(F.lit("k"), F.col("id") % 500).alias("k"), "id")
    _, left = stored(many, None, "a")
    _, right = stored(many.withColumnRenamed("id", "b"), None, "b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = left.each(lambda rows: rows.groupBy("k").agg(F.count("*").alias("n")))
        joined = counts.spread.join(right.spread, "k").groupBy("k").agg(F.sum("n").alias("n"))
        assert not re.search(r"\bExchange\b", plan(joined))
        assert "Bucketed: true" in plan(joined)
        whole = join_bucketed(counts, right)
        assert whole.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_colocated_answers_equal_the_plain_ones(spark, tmp_path):
    """A facility version with a third of all rows, one without a version row, one without a key."""
    day = dt.date(2025, 1, 15)
    versions = [(f"2025{m:02d}{u}", u, dt.date(2025, m, 1), "p1" if u < "u5" else "p2") for m in (1, 2) for u in (f"u{i}" for i in range(8))]
    units = spark.createDataFrame([*versions, ("202501u9", "u9", dt.date(2025, 1, 1), "nowhere")], "unit_version string, unit_id string, period_date date, place_id string")
    keys = [v[0] for v in versions] * 5 + ["202501u3"] * 60 + ["202501gone", None]
    admissions = spark.createDataFrame([(k, day) for k in keys], "unit_version string, entry_date date")
    beds = spark.createDataFrame([(k, dt.date(2025, 1, 1), "p1" if i % 2 else "p2", float(i % 3)) for i, k in enumerate(keys)], "unit_version string, period_date date, place_id string, existing double")
    licences = spark.createDataFrame([(k, "L" if i % 4 else None) for i, k in enumerate(keys[5:60:2] * 2)], "unit_version string, licence string")
    names = spark.createDataFrame([("u1", "Trade", None), ("u2", None, "Legal")], "unit_id string, trade_name string, legal_name string")
    places = spark.createDataFrame([("p1", "One", "S", "R"), ("p2", "Two", "S", "R")], "place_id string, place_name string, state string, region string")
    star = Star(places, units, names, admissions, beds, licences=licences)
    t = colocated.store_colocated({"admissions": admissions, "units": units, "beds": beds, "licences": licences}, str(tmp_path), 4)
    assert t["admissions"].n_hot == 1
    top = colocated.top_units_by_admissions(t["admissions"], t["units"], names, day, day)
    assert top.collect() == queries.top_units_by_admissions(star, day, day).collect()
    stock = colocated.beds_by_unit(t["beds"], t["units"], places, "2025-01")
    assert stock.collect() == queries.beds_by_unit(star, "2025-01").collect()
    covered = colocated.licence_coverage(t["units"], t["licences"], places, "2025-01", "2025-02")
    assert covered.collect() == queries.licence_coverage(star, "2025-01", "2025-02").collect()
