"""Raw files to star tables, streaming and landing, on small fixtures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from snapmart.operators.ids import SMALL_BLOCK
from snapmart.operators.lookup import lookup_from
from snapmart.plans import gold, pipeline, silver
from snapmart.plans.layer_quality import source_quality
from snapmart.plans.schemas import schema
from snapmart.plans.star import open_star
from snapmart.plans import queries as q
from snapmart.sources import versions
from snapmart.sources.files import write_periods
from snapmart.sources.versions import read_stored
from snapmart.streaming import landing


def raw(spark, source, *rows):
    names = [*silver.RAW_COLUMNS[source], "period"]
    used = [n for n in names if any(n in r for r in rows)]
    return spark.createDataFrame([tuple(r.get(n) for n in used) for r in rows], ", ".join(f"{n} string" for n in used))


def test_staff_rules(spark):
    rows = raw(
        spark, "staff",
        {"COMPETEN": "202501", "CBO": "5151-05", "CNES": "1", "period": "202501"},  # excluded family
        {"COMPETEN": "012025", "CBO": "2251-25", "CNES": "1", "CNS_PROF": "7", "PROF_SUS": "1", "HORAHOSP": "8", "period": "202501"},
        {"COMPETEN": "202501", "CBO": None, "CNES": "2", "CNS_PROF": "7", "PROF_SUS": "9", "HORAHOSP": "x", "period": "202501"},
        {"COMPETEN": "202502", "CBO": "225125", "CNES": "1", "period": "202501"},  # other month
    )
    lookups = silver.Lookups(yes_no=lookup_from(spark, {"01": "Sim"}), occupation=lookup_from(spark, {"225125": "Médico"}))
    got = gold.staff(silver.staff(rows, lookups, block=SMALL_BLOCK)).orderBy("staff_id").collect()
    assert [r.staff_id for r in got] == [3_010_000_001, 3_010_000_002]
    assert [(r.person_id, r.occupation, r.public_link, r.hours, r.unit_version) for r in got] == [
        ("000000000000007", "225125 - Médico", "Sim", 8.0, "2025010000001"),
        ("000000000000007", None, "09", None, "2025010000002"),
    ]


def test_equipment_ids(spark):
    line = {"COMPETEN": "202501", "CNES": "1", "period": "202501", "QT_EXIST": "2"}
    rows = raw(
        spark, "equipment",
        {**line, "TIPEQUIP": "07", "CODEQUIP": "1"}, {**line, "TIPEQUIP": "07", "CODEQUIP": "1"},
        {**line, "TIPEQUIP": "07", "CODEQUIP": "2"}, {**line, "CODEQUIP": "2"},
    )
    lookups = silver.Lookups(equipment_kind=lookup_from(spark, {"7": "Odontologia"}), equipment_code=lookup_from(spark, {("7", "01"): "Cadeira"}))
    got = gold.equipment(silver.equipment(rows, lookups)).collect()
    assert sorted(r.equipment_id for r in got) == ["20250100000010701~0001", "20250100000010701~0002", "20250100000010702", "2025010000001~00000004"]
    assert {(r.equipment_kind, r.equipment_code) for r in got} == {("07- Odontologia", "01 - Cadeira"), ("07- Odontologia", "02"), (None, "02")}


def test_pipeline_over_folders(spark, tmp_path):
    rnd, n = random.Random(1), 60
    months = ["202501", "202502"]
    lines = [{"CNES": str(rnd.randint(1, 5)), "COMPETEN": m, "period": m, "CODUFMUN": "110001"} for m in months for _ in range(n)]
    units = {(r["CNES"], r["period"]): r for r in lines}.values()
    for source, rows in {
        "units": [{**r, "ALVARA": r["CNES"], "DT_EXPED": "20240101"} for r in units],
        "beds": [{**r, "CODLEITO": "2", "QT_EXIST": "1"} for r in lines],
        "equipment": [{**r, "TIPEQUIP": "7", "CODEQUIP": "1", "QT_EXIST": "1"} for r in lines],
        "staff": [{**r, "CNS_PROF": r["CNES"], "CBO": "225125"} for r in lines],
        "admissions": [{**r, "N_AIH": str(i), "DT_INTER": "20250105", "ANO_CMPT": "2025", "MES_CMPT": r["period"][4:], "MUNIC_MOV": "110001"} for i, r in enumerate(lines)],
    }.items():
        base = silver.SOURCE_FILES[source][1]
        for m in months:
            raw(spark, source, *[r for r in rows if r["period"] == m]).drop("period").write.parquet(str(tmp_path / f"raw/{base}_ro_{m}.parquet"))
    names = lookup_from(spark, {"110001": "Alta"})
    prefixes = spark.createDataFrame([("11", "RO", "Norte")], "code string, state string, region string")
    mid, out = str(tmp_path / "silver"), str(tmp_path / "gold")
    pipeline.build_silver(spark, str(tmp_path / "raw"), mid, silver.Lookups(), names, prefixes)
    assert len(pipeline.build_gold(spark, mid, out)) == 8
    star = open_star(spark, {t: f"{out}/{t}" for t in ("places", "units", "beds", "admissions", "licences", "staff", "equipment")})
    assert star.beds.count() == 2 * n
    assert q.beds_summary(star, "2025-01", "2025-02").first().existing == n
    assert q.licence_coverage(star, "2025-01", "2025-02").first().without_licence == 0
    assert read_stored(spark, f"{out}/dates").columns == schema("dates").names
    assert star.beds.select("bed_id").distinct().count() == 2 * n
    # One month again changes only that month.
    pipeline.build_silver(spark, str(tmp_path / "raw"), mid, silver.Lookups(), names, prefixes, ["202502"])
    assert read_stored(spark, f"{mid}/beds").count() == 2 * n


def test_failures_are_isolated():
    done = []
    steps = {"a": lambda: done.append("a"), "b": lambda: 1 / 0, "c": lambda: done.append("c")}
    with pytest.raises(pipeline.LayerError, match="b: division"):
        pipeline.run_isolated(steps)
    assert sorted(done) == ["a", "c"]


def test_steps_wait_for_their_parents():
    done = []
    steps = {"late": lambda: done.append("late"), "lost": lambda: done.append("lost"), "a": lambda: done.append("a"), "b": lambda: 1 / 0}
    with pytest.raises(pipeline.LayerError, match="lost: not run: b failed"):
        pipeline.run_isolated(steps, {"late": ["a"], "lost": ["a", "b"]})
    assert done == ["a", "late"]


def test_dimensions_stay_when_a_source_fails(spark, tmp_path):
    line = {"CNES": "1", "COMPETEN": "202501", "period": "202501", "CODUFMUN": "110001"}
    made = {
        "units": {**line, "ALVARA": "9", "DT_EXPED": "20240101"}, "beds": {**line, "CODLEITO": "2"}, "equipment": {**line, "TIPEQUIP": "7", "CODEQUIP": "1"},
        "staff": {**line, "CBO": "225125"}, "admissions": {**line, "N_AIH": "1", "ANO_CMPT": "2025", "MES_CMPT": "01", "MUNIC_MOV": "110001"},
    }
    for source, row in made.items():
        raw(spark, source, row).write.partitionBy("period").parquet(str(tmp_path / "raw" / silver.SOURCE_FILES[source][1]))
    prefixes = spark.createDataFrame([("11", "RO", "Norte"), ("11", "RO", "Norte")], "code string, state string, region string")
    build = lambda **more: pipeline.build_silver(spark, str(tmp_path / "raw"), str(tmp_path / "silver"), silver.Lookups(), lookup_from(spark, {"110001": "Alta"}), prefixes, **more)
    build()
    assert read_stored(spark, str(tmp_path / "silver/places")).count() == 1
    (tmp_path / "raw/raw_cnes_lt/period=202502").mkdir()
    (tmp_path / "raw/raw_cnes_lt/period=202502/part-0.parquet").write_text("junk")
    build(periods=["202501"])  # the broken month is not opened
    with pytest.raises(pipeline.LayerError, match="(?s)beds: .*places: not run: beds failed") as e:
        build(periods=["202501", "202502"])
    assert {"beds", "dates", "places", "quality"} == set(e.value.errors)
    assert read_stored(spark, str(tmp_path / "silver/places")).count() == 1
    build(periods=["202501"], dates=(dt.date(1910, 1, 1), dt.date(2024, 12, 31)))
    report = {(r.source, r.check, r.column): r.row_count for r in read_stored(spark, str(tmp_path / "silver/quality")).collect()}
    assert report["beds", "implausible date", "period_date"] == 1


def test_flat_files_beside_folders_are_read(spark, tmp_path):
    root = str(tmp_path)
    bed = lambda m: raw(spark, "beds", {"CNES": "1", "COMPETEN": m, "period": m})
    bed("202501").write.partitionBy("period").parquet(f"{root}/raw_cnes_lt")
    bed("202502").drop("period").write.parquet(f"{root}/raw_cnes_lt_ro_202502.parquet")
    assert sorted(r.period for r in pipeline.read_raw(spark, root, "beds").collect()) == ["202501", "202502"]
    bed("202501").drop("period").write.parquet(f"{root}/raw_cnes_lt_ro_202501.parquet")
    with pytest.raises(ValueError, match="202501 comes as a folder and as a file"):
        pipeline.read_raw(spark, root, "beds")


def test_repeated_lookup_keys_do_not_multiply(spark):
    rows = raw(spark, "beds", {"COMPETEN": "202501", "CNES": "1", "CODLEITO": "2", "period": "202501"})
    twice = spark.createDataFrame([("02", "b"), ("02", "a")], "code string, text string")
    assert [r.bed_kind for r in silver.beds(rows, silver.Lookups(bed_kind=twice)).collect()] == ["02 - a"]


def test_landing_run(spark, tmp_path):
    delivered, root = tmp_path / "delivered", str(tmp_path / "root")
    bed = raw(spark, "beds", {"CNES": "1", "COMPETEN": "202508", "period": "202508"}).drop("period")
    for name in ("LTRO_202508.parquet", "LTROb_202508.parquet", "LTSP_202507.parquet", "LTRO_202401.parquet"):
        bed.write.parquet(str(delivered / name))
    (delivered / "LTAC_202508.parquet").mkdir()
    (delivered / "LTAC_202508.parquet/part-0.parquet").write_text("junk")
    with pytest.raises(pipeline.LayerError, match="LT AC"):
        pipeline.land_delivered(spark, str(delivered), root, dt.date(2025, 9, 15), 2, ["AC", "RO", "SP"])
    landed = pipeline.read_raw(spark, root, "beds")
    assert sorted((r.period, r.state) for r in landed.collect()) == [("202507", "SP"), ("202508", "RO")]
    assert pipeline.land_delivered(spark, str(delivered), root, dt.date(2025, 9, 15), 2, ["RO", "SP"]) == ([], ["LTAC_202508.parquet"])


def test_landing_run_delivers_all_months(spark, monkeypatch):
    from registry import layers

    d, seen, land = "/root/testdata/sf0.001", set(), pipeline.land_delivered

    def watched(spark, delivered, *rest):
        seen.update(n[-14:-8] for n in layers.child_names(spark, delivered))
        return land(spark, delivered, *rest)

    monkeypatch.setattr(pipeline, "land_delivered", watched)
    landed = {r.period for r in layers.landing_run(spark, d).collect()}
    lines = layers._joined(spark, d).select(layers.period_key("l_shipdate").alias("period"))
    assert seen == {r.period for r in lines.distinct().collect()} and len(seen) > 12
    assert landed <= {"199810", "199811", "199812"}


def test_landing_list(spark):
    df = pipeline.landing_list(spark, dt.date(2026, 9, 15), 12, ["AC", "SP"])
    assert df.count() == 12 * 2 * 5
    assert df.where("target = 'raw_cnes_pf_sp_202608.parquet'").count() == 1


def arrivals(spark, path, *rows):
    spark.createDataFrame(list(rows), "ts timestamp_ntz, kind string").coalesce(1).write.mode("append").parquet(path)


def test_files_land_once(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    arrivals(spark, src, (dt.datetime(2025, 1, 5), "a"))
    schema_ = spark.read.parquet(src).schema
    period = F.date_format("ts", "yyyyMM")
    for expected in (1, 1):
        landing.ingest_available(spark, src, schema_, out, check, period)
        assert read_stored(spark, out).count() == expected
    arrivals(spark, src, (dt.datetime(2025, 2, 5), "b"))
    landing.ingest_available(spark, src, schema_, out, check, period)
    assert read_stored(spark, out).count() == 2


def test_late_file_refreshes_its_month(spark, tmp_path):
    src, landed, out, check, days, check2 = (str(tmp_path / n) for n in ("in", "landed", "out", "check", "days", "check2"))
    noted = []

    def run():
        stream = landing.file_stream(spark, src, schema_).withColumn("period", F.date_format("ts", "yyyyMM"))
        build = lambda rows: rows.groupBy("period", "kind").agg(F.count("*").alias("n"))
        note = lambda prints, _: noted.append(sorted(r.period for r in prints.collect()))
        landing.refresh_changed_periods(stream, landed, out, build, check, note)
        timed = landing.file_stream(spark, src, schema_).withColumn("ts", F.col("ts").cast("timestamp"))
        landing.day_counts(timed, "ts", ["kind"], days, check2)

    arrivals(spark, src, (dt.datetime(2025, 1, 5), "a"), (dt.datetime(2025, 2, 5), "a"))
    schema_ = spark.read.parquet(src).schema
    run()
    arrivals(spark, src, (dt.datetime(2025, 1, 6), "a"))
    run()
    assert noted == [["202501", "202502"], ["202501"]]
    assert sorted(tuple(r) for r in read_stored(spark, out).select("period", "kind", "n").collect()) == [("202501", "a", 2), ("202502", "a", 1)]
    months = landing.month_counts(read_stored(spark, days), ["kind"])
    assert sorted(tuple(r) for r in months.collect()) == [("2025-01", "a", 2), ("2025-02", "a", 1)]


def test_backfill_loses_no_row(spark, tmp_path):
    """Twelve months, newest first, one file a batch; then the last batch once more."""
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for m in range(12, 0, -1):
        arrivals(spark, src, *[(dt.datetime(2025, m, 1 + d), "a") for d in range(10)], (None, "a"))
    schema_ = spark.read.parquet(src).schema
    landing.day_counts(landing.file_stream(spark, src, schema_, 1), "ts", ["kind"], out, check)
    days = landing.day_table(read_stored(spark, out), ["kind"])
    assert days.where("day is not null").agg(F.sum("n"), F.count("*")).first() == (120, 120)
    assert days.where("day is null").first().n == 12
    (tmp_path / "check/commits/.11.crc").unlink()
    (tmp_path / "check/commits/11").unlink()  # as if the driver died before it noted the last batch
    landing.day_counts(landing.file_stream(spark, src, schema_, 1), "ts", ["kind"], out, check)
    assert landing.day_table(read_stored(spark, out), ["kind"]).agg(F.sum("n")).first()[0] == 132


def test_batches_of_a_month_are_merged(spark, tmp_path, monkeypatch):
    src, landed, out, check = (str(tmp_path / n) for n in ("in", "landed", "out", "check"))
    for d in range(1, 13):
        arrivals(spark, src, (dt.datetime(2025, 1, d), "a"))
    schema_ = spark.read.parquet(src).schema
    stream = landing.file_stream(spark, src, schema_, 1).withColumn("period", F.date_format("ts", "yyyyMM"))
    landing.refresh_changed_periods(stream, landed, out, lambda r: r.groupBy("period").agg(F.count("*").alias("n")), check)
    assert read_stored(spark, out).first().n == 12
    assert len(versions.load_version(spark, landed).rows()) <= versions.FACTOR


def test_quality_reads_the_raw_rows_twice(spark, tmp_path):
    line = {"COMPETEN": "202501", "CNES": "1", "period": "202501", "CNS_PROF": "7", "CBO": "225125", "PROF_SUS": "1"}
    rows = raw(
        spark, "staff", line, line, {**line, "CBO": "2231-01", "PROF_SUS": "9"}, {**line, "CBO": None, "PROF_SUS": None},
        {**line, "CBO": "515105", "PROF_SUS": "8"}, {**line, "COMPETEN": "022025"}, {**line, "COMPETEN": None}, {**line, "CBO": "1", "CNES": "2"},
    )
    rows.write.parquet(str(tmp_path / "raw"))
    lookups = silver.Lookups(yes_no=lookup_from(spark, {"01": "Sim"}), occupation=lookup_from(spark, {"225125": "Médico"}))
    report = source_quality(spark.read.parquet(str(tmp_path / "raw")), "staff", lookups)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    # Besides the grain, the report reads the counts that one pass over the raw rows has made.
    assert len([n for n in plan.splitlines() if "Relation [" in n and "CNS_PROF" in n]) == 1
    assert len([n for n in plan.splitlines() if "Relation [" in n and "COMPETEN" in n]) == 1
    assert sorted((r.check, r.column, r.row_count, r.value_count, r.examples) for r in report.collect()) == [
        ("other month", "period", 2, None, None),
        ("repeated line", "CNS_PROF,CNES,CBO", 2, 1, None),
        ("unknown code", "occupation", 2, 2, "000001,223101"),
        ("unknown code", "public_link", 1, 1, "09"),
    ]


def test_gathered_rows_are_written_without_a_shuffle(spark, tmp_path):
    rows = spark.range(0, 90, numPartitions=3).select("id", F.concat(F.lit("20250"), F.floor(F.col("id") / 30) + 1).alias("period"))
    write_periods(rows, str(tmp_path / "t"), gathered=True)
    version = versions.load_version(spark, str(tmp_path / "t"))
    assert [(p.period, p.files) for p in version.rows()] == [("202501", 1), ("202502", 1), ("202503", 1)]
    assert sorted((r.id, r.period) for r in read_stored(spark, str(tmp_path / "t")).collect()) == sorted((r.id, r.period) for r in rows.collect())


def test_lookups_that_may_not_be_broadcast_are_not_small(spark):
    lookups = silver.Lookups(sex=lookup_from(spark, {"1": "m"}))
    assert lookups.small() and silver.Lookups().small()
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not lookups.small()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)


def test_raw_folders_join_the_lines_once(spark, tmp_path, monkeypatch):
    from registry import layers

    tables = {
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz", [
            (1, 1, 1, 1, 1.0, 2.5, 0.0, "A", "O", dt.datetime(1995, 3, 9)), (1, 1, 1, 1, 1.0, 2.5, 0.0, "A", "O", dt.datetime(1995, 3, 9)),
            (1, 2, 1, 7, 30.0, 9.0, 0.0, "R", "F", dt.datetime(1996, 12, 31)), (2, 1, 1, 2, 4.0, 9.0, 0.0, None, None, None), (None, 1, 1, 3, 4.0, 9.0, 0.0, "N", "F", dt.datetime(1995, 3, 9)),
        ]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string", [(1, 5, "O", dt.datetime(1995, 1, 2), "1-URGENT"), (2, None, None, None, None)]),
        "part": ("p_partkey long, p_type string, p_size int", [(1, "PROMO", 3), (2, "SMALL", None)]),
        "supplier": ("s_suppkey long, s_nationkey int, s_acctbal double", [(1, 4, 6000.0)]),
    }
    for name, (schema_, rows) in tables.items():
        spark.createDataFrame(rows, schema_).write.parquet(str(tmp_path / f"{name}.parquet"))
    made, joined = [], layers._joined
    monkeypatch.setattr(layers, "_joined", lambda *a: made.append(1) or joined(*a))
    folder = layers.raw_folders(spark, str(tmp_path))
    assert len(made) == 1
    for name, make in layers.RAW.items():
        want = make(spark, str(tmp_path))
        got = read_stored(spark, f"{folder}/{silver.SOURCE_FILES[name][1]}").select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 4
