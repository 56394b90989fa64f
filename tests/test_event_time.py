import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from snapmart.sources.versions import read_stored
from snapmart.streaming import event_time, landing

SCHEMA = "ts timestamp, kind string, n string"


@pytest.fixture
def run(spark, tmp_path):
    """Deliver rows as one file and count what is new."""
    src, out, late, check = (str(tmp_path / n) for n in ("in", "out", "late", "check"))

    def deliver(*rows):
        if rows:
            frame = spark.createDataFrame([(t, k, "extra") for t, k in rows], SCHEMA)
            frame.coalesce(1).write.mode("append").parquet(src)
        schema = spark.createDataFrame([], SCHEMA).schema
        event_time.event_time_counts(landing.file_stream(spark, src, schema, 1), "ts", ["kind"], "2 days", out, late, check)
        counts = event_time.current_counts(read_stored(spark, out), ["kind"])
        return counts, read_stored(spark, late)

    return deliver


def day(d, hour=0):
    return dt.datetime(2025, 1, d, hour)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_late_rows_go_to_the_side_table(run):
    run((day(1, 5), "a"), (day(1, 6), "a"), (day(2), "b"))
    run((day(20), "a"))
    counts, late = run((day(1, 7), "a"), (day(1, 8), "a"), (day(2, 1), "c"), (day(19), "a"))
    assert {(r.day.day, r.kind): (r.n, r.closed) for r in counts.collect()} == {
        (1, "a"): (2, True), (2, "b"): (1, True), (20, "a"): (1, False), (19, "a"): (1, False),
    }
    assert {(r.day.day, r.kind): r.n for r in late.collect()} == {(1, "a"): 2, (2, "c"): 1}
    both = event_time.with_late(counts, late, ["kind"])
    assert both.agg(F.sum("on_time"), F.sum("late")).first() == (5, 3)
    assert both.where("kind = 'a' and day(day) = 1").select("on_time", "late").first() == (2, 2)


def test_the_end_of_a_day_is_the_border(run):
    """Two days of delay: on the 4th at midnight day 1 closes, a microsecond earlier it is open."""
    run((day(1), "a"), (dt.datetime(2025, 1, 3, 23, 59, 59, 999999), "a"))
    counts, late = run((day(1, 1), "a"), (day(4), "a"))
    assert late.count() == 0
    assert {r.day.day: r.n for r in counts.collect()} == {1: 2, 3: 1, 4: 1}
    counts, late = run((day(1, 2), "a"))
    assert [r.n for r in late.collect()] == [1]
    assert counts.where("day(day) = 1").select("n", "closed").first() == (2, True)


def test_null_times_null_keys_and_repeats(run):
    run((None, "a"), (None, "a"), (day(1), None), (day(1), None))
    counts, late = run((day(28), "a"))
    counts, late = run((None, "a"), (None, None), (day(1), None))
    assert found(counts.where("day is null").select("kind", "n", "closed")) == [("a", 3, False), (None, 1, False)]
    assert found(late.select("kind", "n")) == [(None, 1)]
    assert counts.where("kind is null and day is not null").first().n == 2


def test_nothing_new_changes_nothing(run):
    before, late = run((day(1), "a"))
    held = found(before)
    again, late = run()
    assert found(again) == held and late.count() == 0


def test_a_batch_whose_end_was_not_noted_counts_once(run, tmp_path):
    run((day(1), "a"))
    run((day(20), "a"))
    counts, late = run((day(1), "a"), (day(21), "a"))
    held = found(counts), found(late)
    last = max(int(p.name) for p in (tmp_path / "check/commits").iterdir() if p.name.isdigit())
    spare = tmp_path / "spare"
    spare.mkdir()
    shutil.move(tmp_path / f"check/commits/{last}", spare / "commit")
    shutil.move(tmp_path / f"check/commits/.{last}.crc", spare / "crc")
    counts, late = run()
    assert (found(counts), found(late)) == held


def test_hot_group_is_counted_inside_its_tasks(spark, run, tmp_path):
    """100,000 rows of one group arrive at the state as a few partial counts."""
    src = str(tmp_path / "in")
    spark.range(100_000).select(F.lit(day(1)).alias("ts"), F.lit("a").alias("kind"), F.lit("x").alias("n")).repartition(3).write.parquet(src)
    counts, _ = run()
    assert [r.n for r in counts.collect()] == [100_000]
    count = event_time._partial_counts(["day", "kind"])
    frame = spark.range(50_000).select(F.lit(day(1)).alias("_last"), F.to_date(F.lit("2025-01-01")).alias("day"), F.lit("a").alias("kind")).toPandas()
    assert [(len(f), f["_n"].sum(), f["_last"].notna().sum()) for f in count(iter([frame, frame[:0]]))] == [(1, 50_000, 0), (1, 0, 1)]


def test_clashing_keys_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="'n'"):
        event_time.event_time_counts(rows, "ts", ["kind", "n"], "1 day", "out", "late", str(tmp_path))
