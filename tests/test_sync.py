import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from snapmart.plans import sync
from snapmart.sources.versions import KEYS, load_version
from snapmart.plans.sync import MERGE_PERIODS, MERGE_TABLE, REPLACE_PERIODS, Store, TableSpec

FACT = TableSpec("fact", REPLACE_PERIODS, period_date="day", retained=True)
UNITS = TableSpec("units", MERGE_PERIODS, ["key"], period_key="key")
DIM = TableSpec("dim", MERGE_TABLE, ["id"])


def days(spark, *rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), v) for d, v in rows], "day date, v int")


@pytest.fixture
def store(spark, tmp_path):
    ticks = itertools.count()
    return Store(spark, str(tmp_path / "store"), lambda: dt.datetime(2025, 1, 1) + dt.timedelta(seconds=next(ticks)))


def content(store, table):
    return sorted(tuple(r) for r in store.table(table).drop("period").collect())


def test_fingerprint(spark):
    df = spark.createDataFrame([("p", "a", None), ("p", None, "a"), ("p", "b", "b")], "period string, x string, y string")
    base = sync.fingerprint(df).first()
    assert base.row_count == 3
    assert sync.fingerprint(df.repartition(3).select("y", "period", "x")).first() == base
    for changed in (
        df.withColumn("y", F.coalesce("y", F.lit(""))),
        df.select("period", F.col("y").alias("x"), F.col("x").alias("y")).where("x is null or x <> 'b'").union(df.where("x = 'b'")).where("x is not null or y <> 'a'"),
        df.unionByName(df.limit(1)),
    ):
        assert sync.fingerprint(changed).first().content_hash != base.content_hash
    # A NULL in the other column is another row.
    left, right = df.where("x = 'a'"), df.where("y = 'a'")
    assert sync.fingerprint(left).first().content_hash != sync.fingerprint(right).first().content_hash


def test_plan_reasons(spark):
    schema = "period string, row_count bigint, content_hash string"
    src = spark.createDataFrame([(p, 2, "h") for p in "abcde"], schema)
    led = spark.createDataFrame([("a", 2, "h"), ("b", 2, "x"), ("c", 2, "h"), ("d", 9, "h")], schema)
    tgt = spark.createDataFrame([(p, 1 if p == "c" else 2) for p in "abcd"], "period string, row_count bigint")
    got = {r.period: (r.action, r.reason) for r in sync.sync_plan(src, led, tgt).collect()}
    assert got == {
        "a": ("SKIP", None), "b": ("UPDATE", "content changed"), "c": ("UPDATE", "target count differs"),
        "d": ("UPDATE", "ledger differs"), "e": ("UPDATE", "new"),
    }


def test_replace_touches_changed_months_only(spark, store):
    v1 = days(spark, ("2025-01-05", 1), ("2025-02-05", 2))
    assert store.load(FACT, v1, "f", "v1") == [("202501", "new"), ("202502", "new")]
    assert store.load(FACT, v1, "f", "v1") == []  # same file version
    assert store.load(FACT, v1.repartition(3), "f", "v2") == []  # same content
    v3 = days(spark, ("2025-02-06", 3), ("2025-03-05", 4))
    assert store.load(FACT, v3, "f", "v3") == [("202502", "content changed"), ("202503", "new")]
    assert [r[1] for r in content(store, "fact")] == [1, 3, 4]  # January, absent from v3, stays
    ledger = store.file_ledger()
    assert [r.tag for r in ledger.orderBy("loaded_at").collect()] == ["v1", "v2", "v3"]
    assert sync.period_in_sync(store.period_ledger("fact"), "fact", "202503", sync.fingerprint(sync.with_period(v3, FACT)).where("period = '202503'").first().content_hash)


def test_lost_rows_are_repaired(spark, store):
    v1 = days(spark, ("2025-01-05", 1), ("2025-01-06", 2))
    store.load(FACT, v1, "f", "v1")
    sync.replace_periods(sync.with_period(days(spark, ("2025-01-05", 1)), FACT), store.path("fact"), ["202501"])
    assert store.load(FACT, v1, "f", "v2") == [("202501", "target count differs")]
    assert len(content(store, "fact")) == 2


def test_failure_is_noted_and_raised(spark, store):
    with pytest.raises(Exception, match="without a valid period"):
        store.load(FACT, spark.createDataFrame([(None, 1)], "day date, v int"), "f", "v1")
    assert [r.status for r in store.file_ledger().collect()] == ["FAILURE"]
    store.load(FACT, days(spark, ("2025-01-05", 1)), "f", "v2")
    with pytest.raises(ValueError, match="unexpected columns"):
        store.load(FACT, days(spark, ("2025-01-05", 1)).withColumn("extra", F.lit(1)), "f", "v3")
    assert content(store, "fact") == [(dt.date(2025, 1, 5), 1)]


def test_upsert_keeps_and_refuses(spark, store):
    unit = lambda *r: spark.createDataFrame(list(r), "key string, v int")
    store.load(UNITS, unit(("2025010000001", 1), ("2025010000002", 1)), "u", "v1")
    v2 = unit(("2025010000001", 5), ("2025010000003", 5))
    store.load(UNITS, v2, "u", "v2")
    want = [("2025010000001", 5), ("2025010000002", 1), ("2025010000003", 5)]
    assert content(store, "units") == want
    sync.upsert_periods(sync.with_period(v2, UNITS), store.path("units"), ["key"], ["202501"])
    assert content(store, "units") == want  # twice is once
    with pytest.raises(ValueError, match="duplicate"):
        store.load(UNITS, unit(("2025010000001", 1), ("2025010000001", 2)), "u", "v3")
    assert content(store, "units") == want
    failed = store.period_ledger("units").where("status = 'FAILURE'")
    assert [r.tag for r in failed.collect()] == ["v3"]


def test_dimension(spark, store):
    dim = lambda *r: spark.createDataFrame(list(r), "id int, v string")
    store.load(DIM, dim((1, "a"), (2, "b")), "d", "v1")
    store.load(DIM, dim((2, "c"), (3, "d")), "d", "v2")
    assert content(store, "dim") == [(1, "a"), (2, "c"), (3, "d")]


def test_guard_and_bootstrap(spark, store):
    rows = days(spark, ("2025-01-05", 1), ("2025-02-05", 2))
    sync.replace_periods(sync.with_period(rows, FACT), store.path("fact"), ["202501", "202502"])
    with pytest.raises(ValueError, match="bootstrap"):
        store.load(FACT, rows, "f", "v1")
    with pytest.raises(ValueError, match="file ledger"):
        store.bootstrap_periods(FACT, rows, "f", "v1")
    assert store.bootstrap_file(FACT, "f", "v1") and not store.bootstrap_file(FACT, "f", "v1")
    with pytest.raises(ValueError, match="row counts differ"):
        store.bootstrap_periods(FACT, rows.unionByName(rows), "f", "v1")
    assert store.bootstrap_periods(FACT, rows, "f", "v1") == ["202501", "202502"]
    assert store.bootstrap_periods(FACT, rows, "f", "v1") == []
    assert store.load(FACT, rows, "f", "v2") == []


def test_retention(spark, store):
    store.load(FACT, days(spark, ("2024-08-31", 1), ("2024-09-01", 2), ("2025-08-01", 3)), "f", "v1")
    assert sync.retain(spark, store.path("fact"), dt.date(2025, 9, 15), 12) == ["202408"]
    assert [r[1] for r in content(store, "fact")] == [2, 3]
    assert sync.retain(spark, store.path("never"), dt.date(2025, 9, 15), 12) == []


def test_ledger_current(spark):
    rows = [("1", "t", "p", "h1", 1, "g", "SUCCESS", 1), ("2", "t", "p", "h2", 1, "g", "SUCCESS", 1), ("3", "t", "p", "h3", 1, "g", "FAILURE", 9)]
    df = spark.createDataFrame(rows, "load_id string, table_name string, period string, content_hash string, row_count int, tag string, status string, loaded_at int")
    assert [r.content_hash for r in sync.ledger_current(df).collect()] == ["h2"]


def test_failed_write_leaves_the_old_rows(spark, store):
    dim = lambda *r: spark.createDataFrame(list(r), "id int, v string")
    store.load(DIM, dim(*((i, "old") for i in range(100))), "d", "v1")
    bad = dim((1, "new")).withColumn("v", F.when(F.col("id") == 1, F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    for write in (lambda: store.load(DIM, bad, "d", "v2"), lambda: sync.upsert_table(bad, store.path("dim"), ["id"])):
        with pytest.raises(Exception, match="no"):
            write()
        assert content(store, "dim") == [(i, "old") for i in range(100)]
    assert [r.status for r in store.file_ledger().orderBy("loaded_at").collect()] == ["SUCCESS", "FAILURE"]
    store.load(DIM, dim((1, "new")), "d", "v2")
    assert content(store, "dim")[1] == (1, "new") and len(content(store, "dim")) == 100


def test_counts_are_checked_before_the_switch(spark, store):
    store.load(FACT, days(spark, ("2025-01-05", 1)), "f", "v1")

    def refuse(written):
        raise ValueError(f"saw {written.count()}")

    with pytest.raises(ValueError, match="saw 2"):
        sync.replace_periods(sync.with_period(days(spark, ("2025-01-05", 8), ("2025-01-06", 9)), FACT), store.path("fact"), ["202501"], refuse)
    assert [r[1] for r in content(store, "fact")] == [1]


def test_moved_key_is_kept_once(spark, store):
    spec = TableSpec("moved", MERGE_PERIODS, ["id"], period_date="day")
    rows = lambda *r: spark.createDataFrame([(i, dt.date.fromisoformat(d)) for i, d in r], "id int, day date")
    store.load(spec, rows((1, "2025-01-05"), (2, "2025-01-06"), (3, "2025-03-01")), "m", "v1")
    assert store.load(spec, rows((1, "2025-02-05"), (3, "2025-02-06")), "m", "v2") == [("202502", "new")]
    assert [r[:2] for r in content(store, "moved")] == [(1, dt.date(2025, 2, 5)), (2, dt.date(2025, 1, 6)), (3, dt.date(2025, 2, 6))]
    assert load_version(spark, store.path("moved")).periods() == ["202501", "202502"]


def test_months_are_checked(spark, store):
    for wrong in ("202399", "202502"):
        with pytest.raises(ValueError, match="without a valid period, or of another month"):
            store.load(FACT, days(spark, ("2025-01-05", 1)).withColumn("period", F.lit(wrong)), "f", "v1")


def test_expired_months_are_not_loaded_again(spark, store):
    rows = days(spark, ("2024-08-31", 1), ("2024-09-01", 2))
    load = lambda tag: store.load_all({"fact": (rows, "f", tag)}, dt.date(2025, 9, 15), 12, [FACT])["fact"]
    assert load("v1") == [("202409", "new")] and load("v2") == []
    assert [r[1] for r in content(store, "fact")] == [2]


def test_upserted_month_settles(spark, store):
    unit = lambda *r: spark.createDataFrame(list(r), "key string, v int")
    store.load(UNITS, unit(("2025010000001", 1), ("2025010000002", 1)), "u", "v1")
    store.load(UNITS, unit(("2025010000001", 5)), "u", "v2")
    assert store.load(UNITS, unit(("2025010000001", 5)), "u", "v3") == []


def test_only_the_months_asked_for_are_opened(spark, store, tmp_path):
    from snapmart.sources.files import scan_periods

    days(spark, ("2025-01-05", 1)).withColumn("period", F.lit("202501")).write.partitionBy("period").parquet(str(tmp_path / "t"))
    (tmp_path / "t/period=202502").mkdir()
    (tmp_path / "t/period=202502/part-0.parquet").write_text("junk")
    assert scan_periods(spark, str(tmp_path / "t"), ["202501"]).first().v == 1
    assert scan_periods(spark, str(tmp_path / "t"), ["202501"], days(spark, ("2025-01-05", 1)).schema).first().v == 1


def test_staged_tables_are_removed(spark, store):
    from snapmart.sources import staging

    before = set(staging.child_names(spark, staging.staging_root(spark)))
    store.load(FACT, days(spark, ("2025-01-05", 1)), "f", "v1")
    store.load(DIM, spark.createDataFrame([(1, "a")], "id int, v string"), "d", "v1")
    assert set(staging.child_names(spark, staging.staging_root(spark))) == before


# ---- key directory ------------------------------------------------------------------

MOVED = TableSpec("moved", MERGE_PERIODS, ["id"], period_date="day")


def moved(spark, *rows):
    return spark.createDataFrame([(i, dt.date.fromisoformat(d), v) for i, d, v in rows], "id int, day date, v int")


def test_upsert_opens_the_buckets_of_its_keys(spark, store, monkeypatch):
    store.load(MOVED, moved(spark, *((i, f"2025-{1 + i % 6:02d}-05", 0) for i in range(400))), "m", "v1")
    assert len({p.bucket for p in load_version(spark, store.path("moved")).parts if p.kind == KEYS}) == sync.KEY_BUCKETS
    opened, real = [], sync.read_parts
    monkeypatch.setattr(sync, "read_parts", lambda sp, path, parts, schema: opened.extend(parts) or real(sp, path, parts, schema))
    store.load(MOVED, moved(spark, (7, "2025-06-05", 1)), "m", "v2")
    assert len({p.bucket for p in opened if p.kind == KEYS}) == 1
    assert {p.period for p in opened if p.kind != KEYS} == {"202502", "202506"}  # the month it goes to and the one it leaves
    got = {r.id: (r.day.month, r.v) for r in store.table("moved").collect()}
    assert got == {i: (1 + i % 6, 0) for i in range(400)} | {7: (6, 1)}


def test_directory_follows_many_moves(spark, store):
    import random

    rng, want = random.Random(2), {}
    for n in range(12):
        batch = {rng.randrange(30): (rng.randint(1, 12), n) for _ in range(6)}
        store.load(MOVED, moved(spark, *((i, f"2025-{m:02d}-05", v) for i, (m, v) in batch.items())), "m", f"v{n}")
        want |= batch
        assert {r.id: (r.day.month, r.v) for r in store.table("moved").collect()} == want
    parts = [p for p in load_version(spark, store.path("moved")).parts if p.kind == KEYS]
    assert max(sum(q.bucket == p.bucket for q in parts) for p in parts) <= 8


def test_rows_from_elsewhere_end_the_directory(spark, store):
    store.load(MOVED, moved(spark, (1, "2025-01-05", 0), (2, "2025-01-06", 0)), "m", "v1")
    sync.replace_periods(sync.with_period(moved(spark, (5, "2025-03-05", 0)), MOVED), store.path("moved"), ["202503"])
    assert not [p for p in load_version(spark, store.path("moved")).parts if p.kind == KEYS]
    store.load(MOVED, moved(spark, (5, "2025-04-05", 1)), "m", "v2")
    assert {r.id: r.day.month for r in store.table("moved").collect()} == {1: 1, 2: 1, 5: 4}


# ---- buckets ------------------------------------------------------------------------

BUCKETED = TableSpec("b", REPLACE_PERIODS, ["id"], period_date="day", buckets=8)


def test_one_edited_row_rewrites_one_bucket(spark, store):
    rows = moved(spark, *((i, f"2025-0{1 + i % 3}-05", i) for i in range(300)))
    assert [r[1] for r in store.load(BUCKETED, rows, "b", "v1")] == ["new"] * 3
    before = load_version(spark, store.path("b"))
    assert len(before.parts) == 24
    edited = rows.withColumn("v", F.when(F.col("id") == 7, -1).otherwise(F.col("v")))
    assert store.load(BUCKETED, edited, "b", "v2") == [("202502", "content changed")]
    after = load_version(spark, store.path("b"))
    assert len(set(after.parts) - set(before.parts)) == 1 and len(set(before.parts) - set(after.parts)) == 1
    assert {r.id: r.v for r in store.table("b").collect()} == {i: -1 if i == 7 else i for i in range(300)}
    assert store.load(BUCKETED, edited.repartition(5), "b", "v3") == []
    # A bucket whose only change is that rows went, and one that came to be empty.
    few = edited.where((F.col("id") % 3 != 0) | (F.col("id") < 6))
    store.load(BUCKETED, few, "b", "v4")
    assert sorted(r.id for r in store.table("b").collect()) == [i for i in range(300) if i % 3 or i < 6]


def test_lost_bucket_is_repaired_and_plain_months_are_taken_over(spark, store):
    rows = moved(spark, *((i, "2025-01-05", i) for i in range(100)))
    plain = TableSpec("b", REPLACE_PERIODS, period_date="day")
    store.load(plain, rows, "b", "v1")
    store.load(BUCKETED, rows.withColumn("v", F.col("v") + 1), "b", "v2")
    assert {p.bucket for p in load_version(spark, store.path("b")).parts} == set(range(8))
    sync.drop_parts(spark, store.path("b"), lambda p: p.bucket == 3)
    assert store.load(BUCKETED, rows.withColumn("v", F.col("v") + 1), "b", "v3") == [("202501", "target count differs")]
    assert sorted(r.v for r in store.table("b").collect()) == list(range(1, 101))


def test_source_is_read_once_and_once_more_for_the_changed_months(spark, store):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    rows = days(spark, *((f"2025-0{m}-05", m) for m in range(1, 5) for _ in range(10))).mapInPandas(count, "day date, v int")
    store.load(FACT, rows, "f", "v1")
    assert seen.value <= 80
    seen.value = 0
    assert store.load(FACT, rows, "f", "v2") == [] and seen.value == 40
