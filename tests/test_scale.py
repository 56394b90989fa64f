"""Plans and data movement that must hold at any size."""

import os

import pytest
from pyspark.sql import functions as F

from snapmart.operators import ids
from snapmart.sources import files
from snapmart.sources.versions import load_version, read_stored
from snapmart.streaming import landing

SF = "/root/testdata/sf0.001"
WRITES = ("layer_", "sync_", "stream_", "bootstrap", "retention", "named_file", "landing_stream", "month_scan")


@pytest.fixture
def conf(spark):
    saved = {}

    def put(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            saved[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield put
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_no_query_pairs_everything_or_leaves_the_jvm(spark):
    from registry import load_all

    bad = {}
    for name, fn in load_all().QUERIES.items():
        if name.startswith(WRITES):
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        found = [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups") if w in plan]
        if found:
            bad[name] = found
    assert not bad


def test_hot_join_key_is_split(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="2k",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="4k",
        adaptive__coalescePartitions__enabled="false",
    )
    n = F.col("id")
    rows = spark.range(0, 60000, 1, 8).select(F.when(n % 3 == 0, -1).otherwise(n).alias("k"), (n * 7).alias("v"))
    flagged = ids.flag_duplicates(rows, ["k"])
    counts = {r.is_duplicated: r.n for r in flagged.groupBy("is_duplicated").agg(F.count("*").alias("n")).collect()}
    assert counts == {True: 20000, False: 40000}
    flagged.collect()
    assert "skew=true" in flagged._jdf.queryExecution().executedPlan().toString()


def test_hot_month_is_written_by_several_tasks(spark, conf, tmp_path):
    conf(adaptive__advisoryPartitionSizeInBytes="64k", adaptive__coalescePartitions__initialPartitionNum="8")
    n = F.col("id")
    rows = spark.range(0, 200000, 1, 8).select(
        F.xxhash64("id").alias("v"), F.when(n % 3 > 0, "202501").otherwise("202502").alias("period")
    )
    files.write_periods(rows, str(tmp_path / "t"))
    (hot,) = load_version(spark, str(tmp_path / "t")).rows(["202501"])
    assert hot.files > 1
    assert read_stored(spark, str(tmp_path / "t")).count() == 200000


def test_source_stored_by_month_is_pruned_on_reload(spark, tmp_path):
    from snapmart.plans.sync import REPLACE_PERIODS, TableSpec, with_period

    files.write_periods(spark.createDataFrame([(1, "202501"), (2, "202502")], "v int, period string"), str(tmp_path / "s"))
    spec = TableSpec("t", REPLACE_PERIODS, period_date="day")
    rows = with_period(read_stored(spark, str(tmp_path / "s")), spec).where(F.col("period").isin(["202502"]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "202502" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_staged_tables_go_to_the_shared_folder(spark):
    from snapmart.sources import staging

    root = spark.conf.get("spark.checkpoint.dir")
    assert staging.staging_root(spark).startswith(root)
    staged = staging.stage(spark.range(10), "numbers")
    assert staged.count() == 10
    assert all(root in f for f in staged.inputFiles())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", ["fingerprint_by_period", "fingerprint_changes"])
def test_another_layout_has_no_fixed_number_of_tasks(spark, name):
    from registry import load_all

    plan = load_all().QUERIES[name](spark, SF)._jdf.queryExecution()
    assert "Repartition" not in plan.optimizedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_NONE" in plan.executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_quantiles_join_the_tables_once(spark):
    from registry import load_all

    found = load_all().QUERIES["quantile_sketches"](spark, SF).inputFiles()
    assert found and not any("lineitem" in f for f in found)


def test_distinct_values_scan_once(spark, tmp_path):
    from snapmart.operators import aggregate

    path = str(tmp_path / "t")
    spark.createDataFrame([("a", "1", "k"), ("a", None, "k"), (None, "1", "l")], "x string, w string, k string").write.parquet(path)
    values = aggregate.distinct_values(spark.read.parquet(path), ["x", "w"], ["k"], wide=["w"])
    assert values._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert sorted(map(tuple, values.collect())) == [("k", "w", "1"), ("k", "x", "a"), ("l", "w", "1")]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_filter_values_shuffle_admissions_once(spark):
    """The joins of an admission are made in one pass for all its columns."""
    from registry import load_all

    plan = load_all().QUERIES["filter_values"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("p_type#") and plan.count("l_returnflag") and plan.count("o_orderpriority") and sum("Relation" in r and "o_orderkey" in r for r in plan.splitlines()) == 1
