import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from snapmart.operators.filters import Scope
from snapmart.plans import queries as q, summaries as s, sync
from snapmart.plans.star import Star
from snapmart.sources.files import write_periods
from snapmart.sources.versions import load_version, read_stored

SCHEMA = "unit_version string, care_place string, diagnosis string, sex string, race string, ethnicity string, admission_type string, entry_date date, exit_date date, period string"


def admissions(spark, n=900, seed=1):
    r, rows = random.Random(seed), []
    for _ in range(n):
        month = r.randint(1, 6)
        entry = dt.date(2020, month, r.randint(1, 28))
        filed = min(6, month + r.choice([0, 0, 1]))  # files also hold entries of the month before
        unit = "u1" if r.random() < 0.4 else r.choice(["u2", "u3"])
        pick = lambda *v: r.choice([None, *v])
        rows.append((
            f"2020{filed:02d}{unit}", pick("a", "b", "x"), pick("d1", "d2", "d3"), pick("M", "F"), pick("p", "q"), pick("e", "f"), pick("1", "2"),
            None if r.random() < 0.05 else entry, pick(entry + dt.timedelta(days=r.randint(0, 9))), f"2020{filed:02d}",
        ))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("summaries"))
    write_periods(admissions(spark), f"{root}/fact")
    fact = read_stored(spark, f"{root}/fact")
    places = spark.createDataFrame([("a", "R1"), ("b", "R2")], "place_id string, region string").withColumns({"state": F.lit("s"), "place_name": F.lit("n")})
    units = spark.createDataFrame([(f"20200{m}{u}", u) for m in range(1, 7) for u in ("u1", "u2")], "unit_version string, unit_id string")
    star = Star(places=places, units=units, admissions=fact)
    for c in s.ADMISSION_COUNTS:
        s.refresh(fact, sync.fingerprint(fact), f"{root}/{c.name}", c)
    return root, fact, star


def same(got, want):
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


RANGES = [
    (dt.date(2020, 1, 1), dt.date(2020, 6, 30)), (dt.date(2020, 1, 9), dt.date(2020, 5, 20)), (dt.date(2020, 2, 1), dt.date(2020, 2, 29)),
    (dt.date(2020, 2, 5), dt.date(2020, 3, 6)), (dt.date(2020, 3, 31), dt.date(2020, 5, 1)), (dt.date(2020, 4, 4), dt.date(2020, 4, 4)), (dt.date(2022, 1, 1), dt.date(2022, 2, 2)),
]


@pytest.mark.parametrize("days", RANGES)
def test_same_rows_as_the_fact(kept, days):
    root, fact, star = kept
    counts = s.open_counts(fact, sync.fingerprint(fact), root)
    for scope in (Scope(), Scope(region="R1"), Scope(unit="u1")):
        same(s.admissions_by_month(counts, star, *days, scope), q.admissions_by_month(star, *days, scope))
        same(s.top_diagnoses(counts, star, *days, scope), q.top_diagnoses(star, *days, scope))
        same(s.filter_values(counts, star, *days, scope), q.filter_values(star, *days, scope))
    total = s.admissions_total(counts, star, *days).first()
    rows = [r for r in fact.collect() if r.entry_date and days[0] <= r.entry_date <= days[1]]
    stays = [(r.exit_date - r.entry_date).days for r in rows if r.exit_date]
    assert total.admissions == len(rows)
    assert (total.mean_stay is None) if not stays else abs(total.mean_stay - sum(stays) / len(stays)) < 0.006


def test_whole_months_do_not_read_the_fact(kept):
    root, fact, star = kept
    counts = s.open_counts(fact, sync.fingerprint(fact), root)
    files = s.admissions_by_month(counts, star, dt.date(2020, 2, 1), dt.date(2020, 5, 31), Scope(region="R1")).inputFiles()
    assert files and not any("/fact/" in f for f in files)
    assert any("/fact/" in f for f in s.admissions_by_month(counts, star, dt.date(2020, 2, 2), dt.date(2020, 5, 31)).inputFiles())


def test_the_smallest_able_summary_is_chosen(kept):
    root, fact, _ = kept
    counts = s.open_counts(fact, sync.fingerprint(fact), root)
    assert counts.choose(["diagnosis"]).keys == ("care_place", "diagnosis")
    assert counts.choose(["diagnosis", "unit_version"]) is None
    able = [k for k in counts.kept if "unit_version" in k.keys]
    assert counts.choose(["unit_version"]).size == min(k.size for k in able)


def test_stale_months_come_from_the_fact(kept, spark):
    root, fact, star = kept
    more = fact.where("period <> '202004'").unionByName(fact.where("period = '202004' AND diagnosis = 'd1'"))
    counts = s.open_counts(more, sync.fingerprint(more), root)
    assert all(k.fresh == {"202001", "202002", "202003", "202005", "202006"} for k in counts.kept)
    now = Star(places=star.places, units=star.units, admissions=more)
    for days in RANGES[:3]:
        same(s.admissions_by_month(counts, now, *days), q.admissions_by_month(now, *days))


def test_refresh_makes_only_changed_months(spark, kept, tmp_path):
    _, fact, _ = kept
    path, by_unit = str(tmp_path / "by_unit"), s.ADMISSION_COUNTS[0]
    assert len(s.refresh(fact, sync.fingerprint(fact), path, by_unit)) == 6
    before = {p.period: p.folder for p in load_version(spark, path).rows()}
    assert s.refresh(fact, sync.fingerprint(fact), path, by_unit) == []
    edited = fact.where("period <> '202002'").where("NOT (period = '202005' AND sex = 'M')")
    assert s.refresh(edited, sync.fingerprint(edited), path, by_unit) == ["202005"]
    after = {p.period: p.folder for p in load_version(spark, path).rows()}
    assert set(after) == set(before) - {"202002"}
    assert [p for p in after if after[p] != before[p]] == ["202005"]
    assert read_stored(spark, path).agg(F.sum("admissions")).first()[0] == edited.count()


def test_states_from_the_ledger(spark, kept, tmp_path):
    _, fact, _ = kept
    ticks = iter(range(10_000))
    store = sync.Store(spark, str(tmp_path / "store"), lambda: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=next(ticks)))
    spec = sync.TableSpec("facts", sync.REPLACE_PERIODS, period_date="entry_date", retained=True)
    rows = fact.where("entry_date IS NOT NULL").withColumn("period", F.date_format("entry_date", "yyyyMM"))
    path, by_unit = str(tmp_path / "by_unit"), s.ADMISSION_COUNTS[0]
    store.load(spec, rows, "f", "1")
    assert len(s.refresh(store.table("facts"), store.states("facts"), path, by_unit)) == 6
    store.load(spec, rows.where("NOT (period = '202003' AND sex = 'F')"), "f", "2")
    sync.retain(spark, store.path("facts"), dt.date(2020, 8, 1), 6)
    assert s.refresh(store.table("facts"), store.states("facts"), path, by_unit) == ["202003"]
    held = read_stored(spark, path)
    assert held.agg(F.sum("admissions")).first()[0] == store.table("facts").count()
    assert load_version(spark, path).periods() == ["202002", "202003", "202004", "202005", "202006"]


def test_nothing_kept_and_empty_fact(spark, kept, tmp_path):
    _, fact, star = kept
    counts = s.open_counts(fact, sync.fingerprint(fact), str(tmp_path))
    same(s.admissions_by_month(counts, star, *RANGES[1]), q.admissions_by_month(star, *RANGES[1]))
    none = fact.limit(0)
    assert s.refresh(none, sync.fingerprint(none), str(tmp_path / "e"), s.ADMISSION_COUNTS[0]) == []
    empty = s.open_counts(none, sync.fingerprint(none), str(tmp_path))
    assert s.admissions_by_month(empty, star, *RANGES[0]).count() == 0
    assert tuple(s.admissions_total(empty, star, *RANGES[0]).first()) == (0, None)


def test_bitmaps_are_exact_over_many_chunks(spark, tmp_path):
    ids = spark.range(70_000).select(F.concat(F.lit("id"), F.col("id").cast("string")).alias("who"), F.when(F.col("id") % 3 == 0, "202001").otherwise("202002").alias("period"))
    rows = ids.unionByName(ids.where("who < 'id5'").withColumn("period", F.lit("202003"))).unionByName(spark.createDataFrame([(None, "202001")], "who string, period string"))
    numbers, path = str(tmp_path / "numbers"), str(tmp_path / "bits")
    s.extend_numbers(rows.where("period = '202002'"), numbers, "who")
    first = {r.who: r.number for r in read_stored(spark, numbers).collect()}
    s.extend_numbers(rows, numbers, "who")
    s.extend_numbers(rows, numbers, "who")  # nothing new: nothing changes
    then = {r.who: r.number for r in read_stored(spark, numbers).collect()}
    assert sorted(then.values()) == list(range(70_000)) and all(then[k] == v for k, v in first.items())
    s.refresh(rows, sync.fingerprint(rows), path, s.bitmap_summary("who", read_stored(spark, numbers), "who"))
    kept = read_stored(spark, path)
    assert s.distinct_from_bitmaps(kept, [], "n").first().n == 70_000
    got = {r.period: r.n for r in s.distinct_from_bitmaps(kept, ["period"], "n").collect()}
    assert got == {r.period: r.n for r in rows.groupBy("period").agg(F.count_distinct("who").alias("n")).collect()}
    assert s.distinct_from_bitmaps(kept.limit(0), [], "n").first().n == 0


def test_sketches_stay_within_their_errors(spark, tmp_path):
    rows = spark.range(200_000).select((F.col("id") % 90_000).alias("who"), F.pow(F.col("id") / 1000, 3).alias("value"), F.concat(F.lit("20200"), (F.col("id") % 4 + 1).cast("string")).alias("period"))
    rows = rows.unionByName(spark.createDataFrame([(None, None, "202001"), (None, float("nan"), "202002")], "who long, value double, period string"))
    theta, kll = str(tmp_path / "theta"), str(tmp_path / "kll")
    s.refresh(rows, sync.fingerprint(rows), theta, s.theta_summary("who", "who"))
    about = s.distinct_from_sketches(read_stored(spark, theta), [], "n").first().n
    assert about == pytest.approx(90_000, rel=s.THETA_ERROR)
    s.refresh(rows, sync.fingerprint(rows), kll, s.quantile_summary("value", "value"))
    got = s.quantiles_from_sketches(read_stored(spark, kll), [], {"low": 0.1, "mid": 0.5, "high": 0.99}).first()
    assert got.n_values == 200_000
    for name, rank in (("low", 0.1), ("mid", 0.5), ("high", 0.99)):
        assert abs(rows.where(F.col("value") <= got[name]).where(~F.isnan("value")).count() / 200_000 - rank) <= s.KLL_ERROR


def test_filter_values_meet_the_units_once(kept):
    root, fact, star = kept
    counts = s.open_counts(fact, sync.fingerprint(fact), root)
    plan = s.filter_values(counts, star, dt.date(2020, 1, 9), dt.date(2020, 5, 20))._jdf.queryExecution().optimizedPlan().toString()
    assert [r for r in plan.splitlines() if "Join" in r and "(unit_version" in r and "Inner" not in r] == []
    assert plan.count("Join Inner, (unit_version") == 1


def test_month_hashes_are_taken_once(spark, kept):
    """Opening several counts does not read the fact for its hashes more than once."""
    root, fact, _ = kept
    taken = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(h):
        taken.add(1)
        return h

    states = sync.fingerprint(fact).withColumn("content_hash", seen("content_hash"))
    assert all(k.fresh for k in s.open_counts(fact, states, root).kept)
    assert taken.value == 6  # months
