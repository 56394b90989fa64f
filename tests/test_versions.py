"""Versioned tables: what readers see when a writer dies, merging of small parts, files of several schemas."""

import datetime as dt
import itertools
import shutil

import pytest
from pyspark.sql import functions as F

from snapmart.plans import sync
from snapmart.plans.sync import REPLACE_PERIODS, Store, TableSpec
from snapmart.sources import files, schema_classes, staging, versions
from snapmart.sources.versions import load_version, read_stored
from snapmart.streaming import landing


class Died(Exception):
    pass


class Mortal:
    """Ends the driver at the n-th step that changes files; from then on nothing changes any more."""

    STEPS = ("move", "delete_path", "write_text")

    def __init__(self, monkeypatch, n):
        self.left, self.dead = n, False
        for name in self.STEPS:
            monkeypatch.setattr(staging, name, self.around(getattr(staging, name)))

    def around(self, real):
        def step(*args):
            self.left -= 1
            if self.left < 0:
                self.dead = True
            if self.dead:
                raise Died
            return real(*args)

        return step


def dies_at_every_step(tmp_path, monkeypatch, make, act, read, before, after):
    """Run ``act`` on a copy of a table with a driver that dies at its first, second, ... step, until it lives to the end."""
    make(str(tmp_path / "made"))
    for n in itertools.count():
        path = str(tmp_path / f"copy{n}")
        shutil.copytree(tmp_path / "made", path)
        with monkeypatch.context() as m:
            mortal = Mortal(m, n)
            try:
                act(path)
            except Died:
                pass
        assert read(path) in (before, after), f"step {n}"
        if not mortal.dead:
            assert read(path) == after
            return n
        act(path)
        assert read(path) == after, f"repeated after step {n}"


def store_at(spark, path):
    ticks = itertools.count()
    return Store(spark, path, lambda: dt.datetime(2025, 1, 1) + dt.timedelta(seconds=next(ticks)))


FACT = TableSpec("fact", REPLACE_PERIODS, period_date="day", retained=True)


def rows_of(spark, *rows):
    return spark.createDataFrame([(i, dt.date.fromisoformat(d)) for i, d in rows], "id int, day date").coalesce(1)


OLD = [(1, "2025-01-05"), (2, "2025-02-05"), (3, "2025-03-05")]
NEW = [(1, "2025-02-06"), (2, "2025-03-06"), (3, "2025-01-06")]
MONTHS = ["202501", "202502", "202503"]


def by_month(spark, rows):
    return sync.with_period(rows_of(spark, *rows), FACT)


WRITES = {
    "replace": lambda df, path: sync.replace_periods(df, path, MONTHS),
    "upsert": lambda df, path: sync.upsert_periods(df, path, ["id"], MONTHS),
    "table": lambda df, path: sync.upsert_table(df, path, ["id"]),
    "buckets": lambda df, path: sync.replace_buckets(df, path, ["id"], 2, {(m, b) for m in MONTHS for b in (0, 1)}),
}


@pytest.mark.parametrize("name", list(WRITES))
def test_a_write_is_old_or_new_wherever_the_driver_dies(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(sync, "KEY_BUCKETS", 2)
    write = WRITES[name]
    read = lambda path: sorted((r.id, r.day.isoformat()) for r in read_stored(spark, path).collect())
    old, new = by_month(spark, OLD), by_month(spark, NEW)
    steps = dies_at_every_step(tmp_path, monkeypatch, lambda p: write(old, p), lambda p: write(new, p), read, OLD, NEW)
    assert steps >= 4


@pytest.mark.parametrize("n", [3, 9, 14, 20])
def test_a_load_that_died_is_repeated(spark, tmp_path, monkeypatch, n):
    store = store_at(spark, str(tmp_path))
    store.load(FACT, rows_of(spark, *OLD), "f", "v1")
    read = lambda: sorted((r.id, r.day.isoformat()) for r in store.table("fact").collect())
    with monkeypatch.context() as m:
        Mortal(m, n)
        try:
            store.load(FACT, rows_of(spark, *NEW), "f", "v2")
        except Died:
            pass
    assert read() in (OLD, NEW)
    store.load(FACT, rows_of(spark, *NEW), "f", "v2")
    assert read() == NEW


def test_merging_landed_batches_is_safe(spark, tmp_path, monkeypatch):
    """Forty rows in batches; the driver dies at each step of the merge."""
    def make(path):
        for batch in range(4):
            df = spark.range(batch * 10, batch * 10 + 10, 1, 1).withColumn("period", F.lit("202501"))
            versions.replace_parts(df, path, ["period"], lambda *_: False, batch=batch)

    read = lambda path: sorted(r.id for r in read_stored(spark, path).collect())
    dies_at_every_step(tmp_path, monkeypatch, make, lambda p: versions.compact(spark, p, factor=4), read, list(range(40)), list(range(40)))


def test_a_stream_that_dies_lands_every_row_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions.compact, "__defaults__", (2, versions.SMALL, versions.LARGE, None))
    src = str(tmp_path / "in")
    for i in range(3):
        spark.range(i * 10, i * 10 + 10, 1, 1).selectExpr("id", "if(id % 2 = 0, '202501', '202502') AS period").write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    for n in (1, 5, 8, 13, 19):
        landed, target, check = (str(tmp_path / f"{name}{n}") for name in ("landed", "target", "check"))
        build = lambda df: df.groupBy("period").agg(F.count("*").alias("n"))
        run = lambda: landing.refresh_changed_periods(landing.file_stream(spark, src, schema, 1), landed, target, build, check)
        with monkeypatch.context() as m:
            mortal = Mortal(m, n)
            try:
                run()
            except Exception:  # the stream wraps what its batch raises
                if not mortal.dead:
                    raise
        run()
        assert sorted(r.id for r in read_stored(spark, landed).collect()) == list(range(30)), n
        assert {r.period: r.n for r in read_stored(spark, target).collect()} == {"202501": 15, "202502": 15}, n


def test_versions_stay_readable_and_are_swept(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in range(6):
        files.write_periods(spark.createDataFrame([(v, "202501"), (v, f"20250{1 + v}")], "v int, period string"), path)
    assert versions.numbers(spark, path) == [4, 5, 6]
    assert sorted(r.v for r in read_stored(spark, path, number=4).collect()) == [1, 2, 3, 3]
    assert sorted(r.v for r in read_stored(spark, path).collect()) == [1, 2, 3, 4, 5, 5]
    live = {p.folder for n in (4, 5, 6) for p in load_version(spark, path, n).parts}
    found = {str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t/_data").glob("write=*/period=*")}
    assert found == live
    assert not [p for p in (tmp_path / "t/_data").iterdir() if not list(p.glob("period=*"))]
    with pytest.raises(ValueError, match="no version 1"):
        read_stored(spark, path, number=1)


def test_what_a_dead_driver_wrote_is_removed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "202501")], "v int, period string")
    files.write_periods(df, path)
    with monkeypatch.context() as m:
        Mortal(m, 2)  # the note is written, the rows, and the new version under its temporary name
        with pytest.raises(Died):
            files.write_periods(df.withColumn("v", F.lit(2)), path)
    assert len(list((tmp_path / "t/_data").iterdir())) == 2
    files.write_periods(df.withColumn("v", F.lit(3)), path)
    assert [r.v for r in read_stored(spark, path).collect()] == [3]
    assert len(list((tmp_path / "t/_data").iterdir())) == 2  # of the two versions
    assert not [p for p in (tmp_path / "t/_versions").iterdir() if p.name.startswith((".open", ".new"))]


def test_a_second_writer_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "202501")], "v int, period string")
    with pytest.raises(RuntimeError, match="another writer"):
        with versions.Write(spark, path, df.schema) as slow:
            slow.add(df, ["period"])
            files.write_periods(df, path)
            slow.publish(slow.new)
    assert read_stored(spark, path).count() == 1


def test_folders_of_others_are_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "202501"), (2, "202502")], "v int, period string").write.partitionBy("period").parquet(path)
    files.write_periods(spark.createDataFrame([(9, "202502")], "v int, period string"), path)
    assert sorted(map(tuple, read_stored(spark, path).collect())) == [(1, "202501"), (9, "202502")]
    assert files.discover_periods(spark, path) == ["202501", "202502"]


def test_other_types_are_refused_while_rows_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_periods(spark.createDataFrame([(1, "202501")], "v int, period string"), path)
    with pytest.raises(ValueError, match="other types of"):
        files.write_periods(spark.createDataFrame([("x", "202502")], "v string, period string"), path)
    files.write_periods(spark.createDataFrame([("x", "202501")], "v string, period string"), path)
    assert read_stored(spark, path).first().v == "x"


def test_parts_stay_few_after_a_hundred_landings(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(100):
        versions.append(spark.range(i, i + 1, 1, 1).withColumn("period", F.lit(f"20250{1 + i % 2}")), path, ["period"], batch=i)
    version = load_version(spark, path)
    assert max(len(version.rows([p])) for p in version.periods()) <= versions.FACTOR
    assert sorted(r.id for r in read_stored(spark, path).collect()) == list(range(100))


def test_parts_are_merged_by_size(spark, tmp_path):
    path = str(tmp_path / "t")
    wide = lambda i, n: spark.range(i, i + n, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 512).alias("s"))
    sizes = [2000] * 3 + [10] * 4
    for b, n in enumerate(sizes):
        versions.replace_parts(wide(b * 10_000, n), path, [], lambda *_: False, batch=b)
    small = 20_000
    assert versions.compact(spark, path, factor=4, small=small) == 3
    left = sorted(p.size for p in load_version(spark, path).rows())
    assert len(left) == 4 and left[0] < small < left[1]  # the large ones were not rewritten
    assert read_stored(spark, path).count() == sum(sizes)
    assert versions.compact(spark, path, factor=2, small=small, large=1) == 0  # none is small enough to be merged


def test_a_repeated_batch_takes_the_place_of_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, at in ((0, 0), (1, 10), (1, 20)):
        versions.append(spark.range(at, at + 3, 1, 1), path, batch=batch)
    assert sorted(r.id for r in read_stored(spark, path).collect()) == [0, 1, 2, 20, 21, 22]


# ---- files of several schemas -----------------------------------------------------------

def test_files_of_several_types_are_one_scan(spark, tmp_path):
    root = str(tmp_path)
    make = lambda kind, name, value: spark.sql(f"SELECT CAST({value} AS {kind}) AS CNES, '{name}' AS who").coalesce(1).write.mode("overwrite").parquet(f"{root}/raw_{name}_202501.parquet")
    make("double", "aa", 2077485.0)
    make("string", "bb", "'0002'")
    make("int", "cc", 7)
    spark.sql("SELECT 1.5D AS cnes, DATE'2025-01-01' AS seen, 'dd' AS who").write.parquet(f"{root}/raw_dd_202501.parquet")
    got = files.scan_named_files(spark, root, "raw")
    assert {(r.who, r.CNES, r.state, r.period) for r in got.collect()} == {("aa", "2077485", "AA", "202501"), ("bb", "0002", "BB", "202501"), ("cc", "7", "CC", "202501"), ("dd", "1.5", "DD", "202501")}
    assert {r.who: r.seen for r in got.collect()}["dd"] == dt.date(2025, 1, 1)
    paths = schema_classes.files_below(spark, [f"{root}/raw_{n}_202501.parquet" for n in ("aa", "bb", "cc", "dd")])
    assert len(schema_classes.schema_classes(spark, paths)) == 4
    by_reader = schema_classes._footers_by_reader(spark, paths)
    assert len({k for _, k in by_reader}) == 4


def test_months_of_several_types_are_one_scan(spark, tmp_path):
    root = str(tmp_path / "t")
    for month, kind in (("202501", "double"), ("202502", "string"), ("202503", "double")):
        spark.sql(f"SELECT CAST(5 AS {kind}) AS code, {month[-1]} AS n, '{month}' AS period").write.mode("append").partitionBy("period").parquet(root)
    got = files.scan_periods(spark, root)
    assert sorted((r.code, r.n, r.period) for r in got.collect()) == [("5", 1, "202501"), ("5", 2, "202502"), ("5", 3, "202503")]
    assert [r.code for r in files.scan_periods(spark, root, ["202501", "202503"]).collect()] == [5.0, 5.0]  # these two agree
    assert len(schema_classes.schema_classes(spark, schema_classes.files_below(spark, [root], root))) == 2


@pytest.mark.parametrize(
    ("types", "common"),
    [
        (["int", "bigint"], "bigint"), (["int", "double"], "double"), (["decimal(10,2)", "bigint"], "decimal(21,2)"), (["decimal(10,2)", "float"], "double"),
        (["date", "timestamp"], "timestamp"), (["date", "timestamp_ntz"], "timestamp_ntz"), (["int", "string"], "string"), (["boolean", "int"], "string"), (["date", "date"], "date"),
    ],
)
def test_common_types(spark, types, common):
    from pyspark.sql import types as T

    assert schema_classes.common_type([T.StructType.fromDDL(f"c {t}")[0].dataType for t in types]).simpleString() == common
    frames = [spark.sql(f"SELECT CAST(NULL AS {t}) AS c") for t in types]
    assert schema_classes.put_together(frames).schema["c"].dataType.simpleString() == common
