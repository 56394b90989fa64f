import random

import pytest
from pyspark.sql import Window, functions as F

from snapmart.operators import ids


@pytest.fixture(scope="module", autouse=True)
def many_partitions(spark):
    """Keep small shuffle partitions apart, so numbering crosses borders."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows share one key; many rows are equal in all columns."""
    rnd = random.Random(7)
    data = [
        (
            rnd.choice(["202501", "202502", "202503"]),
            "hot" if rnd.random() < 0.35 else rnd.choice(["a", "b", "c", None]) if rnd.random() < 0.2 else f"k{i % 900}",
            rnd.randint(0, 3),
        )
        for i in range(4000)
    ]
    return spark.createDataFrame(data, "period string, key string, v int").repartition(5)


def everything(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, x) for x in r))


def test_block_ids_equal_plain_window(spark, rows):
    got = ids.block_ids(rows, "period", ["key", "v"], "id")
    w = Window.partitionBy("period").orderBy(
        F.col("key").asc_nulls_last(), F.col("v").asc_nulls_last()
    )
    start = ids.block_start(F.col("period"))
    want = rows.select((start + F.row_number().over(w)).alias("id"), *rows.columns)
    assert everything(got) == everything(want)
    assert got.select("id").distinct().count() == 4000


def test_block_start_vector(spark):
    df = spark.createDataFrame([("202508",)], "period string")
    assert df.select(ids.block_start(F.col("period"), block=ids.SMALL_BLOCK)).first()[0] == 3_080_000_000
    assert ids.block_ids(df, "period", [], "id", block=ids.SMALL_BLOCK).first().id == 3_080_000_001
    assert ids.block_ids(df, "period", [], "id").first().id == 308 * 10**12 + 1


def test_block_overflow_fails(rows):
    with pytest.raises(Exception, match="more than 9 rows"):
        ids.block_ids(rows, "period", ["key"], "id", block=10).collect()


def test_period_before_base_year_fails(spark):
    df = spark.createDataFrame([("199912",)], "period string")
    with pytest.raises(Exception, match="base year"):
        ids.block_ids(df, "period", [], "id").collect()


def test_occurrence_equals_plain_window(rows):
    staged = ids.stage_in_order(rows, ["key", "period", "v"])
    got = ids.drop_place(ids.add_occurrence(staged, ["key"], "n", "total"))
    w = Window.partitionBy("key")
    want = rows.withColumn(
        "n", F.row_number().over(w.orderBy(F.col("period"), F.col("v")))
    ).withColumn("total", F.count("*").over(w))
    assert everything(got) == everything(want)


def test_hot_key_is_spread_over_partitions(rows):
    staged = ids.stage_in_order(rows, ["key", "period", "v"])
    parts = staged.where("key = 'hot'").select("_pid").distinct().count()
    biggest = staged.groupBy("_pid").count().agg(F.max("count")).first()[0]
    assert parts > 1 and biggest < 4000 / 3


def test_all_equal_rows_can_be_split(spark):
    same = spark.range(0, 3000, 1, 4).select(F.lit("202501").alias("period"), F.lit("x").alias("key"))
    staged = ids.stage_in_order(same, ["period", "key"])
    assert staged.select("_pid").distinct().count() > 1
    got = ids.block_ids(same, "period", ["key"], "id")
    r = got.agg(F.count_distinct("id"), F.min("id"), F.max("id")).first()
    assert (r[0], r[2] - r[1]) == (3000, 2999)


def test_occurrence_suffix_vector(spark):
    df = spark.createDataFrame([("a", 2), ("b", 1), ("a", 1)], "key string, v int")
    got = ids.occurrence_suffix(df, "key", ["v"])
    assert everything(got) == [("a~0001", 1), ("a~0002", 2), ("b", 1)]
    # A key that ends like a numbered one stays apart; one with the separator is refused.
    odd = spark.createDataFrame([("P-1", 1), ("P-1", 2), ("P-10001", 3), ("P-10002", 4)], "key string, v int")
    assert ids.occurrence_suffix(odd, "key", ["v"]).select("key").distinct().count() == 4
    with pytest.raises(Exception, match="key contains"):
        ids.occurrence_suffix(odd.withColumn("key", F.concat("key", F.lit("~1"))), "key", ["v"]).collect()


def test_row_sequence(spark):
    df = spark.createDataFrame([("202501", 5), ("202501", 3), ("202502", 9)], "period string, v int")
    got = ids.row_sequence(df, "period", ["v"], "seq")
    assert everything(got) == [("202501", 3, "00000001"), ("202501", 5, "00000002"), ("202502", 9, "00000001")]


def test_natural_or_artificial(spark):
    df = spark.createDataFrame(
        [("7", "80"), (None, "80"), ("", "80")], "kind string, code string"
    )
    c = ids.natural_or_artificial([F.lit("P")], [F.col("kind"), F.col("code")], F.lit("00000001"))
    assert [r[0] for r in df.select(c).collect()] == ["P780", "P~00000001", "P~00000001"]


def test_keep_first_and_flags(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 9), (None, 1), (None, 2)], "k string, v int")
    assert everything(ids.keep_first(df, ["k"], [F.col("v")])) == [("a", 1), ("b", 9), (None, 1)]
    flags = {(r.k, r.v): r.is_duplicated for r in ids.flag_duplicates(df, ["k"]).collect()}
    assert flags == {("a", 2): True, ("a", 1): True, ("b", 9): False, (None, 1): True, (None, 2): True}


def test_scan_reads_the_staged_rows_twice_and_does_not_shuffle_them(spark, rows):
    staged = ids.stage_in_order(rows, ["key", "period", "v"])
    scanned = ids.scan_groups(staged, ["key"], "n", "total", {"so_far": F.col("v")})
    scanned.collect()
    plan = scanned._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 2
    # The one exchange is that of the borders, below the broadcast.
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("BroadcastExchange") < plan.index("Exchange hashpartitioning")


def test_running_sums_equal_plain_window(rows):
    staged = ids.stage_in_order(rows, ["key", "period", "v"])
    got = ids.drop_place(ids.scan_groups(staged, ["key"], "n", "total", {"so_far": F.col("v"), "ones": F.lit(1)}))
    w = Window.partitionBy("key").orderBy("period", "v")
    assert everything(got.groupBy("key").agg(F.max("so_far"))) == everything(rows.groupBy("key").agg(F.sum("v")))
    assert got.where("ones != n").count() == 0
    # Rows that tie get their sums in some order; the last of them has the sum of all.
    ends = got.groupBy("key", "period", "v").agg(F.max("so_far"))
    assert everything(ends) == everything(rows.select("key", "period", "v", F.sum("v").over(w)).distinct())


def test_staged_columns_can_be_fewer(rows):
    staged = ids.stage_in_order(rows, ["key", "period", "v"], keep=["key"])
    assert staged.columns == ["key", "_pos", "_pid"]
    assert ids.add_occurrence(staged, ["key"], "n", "total").agg(F.sum("n")).first()[0] > 0


def test_scan_of_an_empty_table(rows):
    staged = ids.stage_in_order(rows.limit(0), ["key"])
    assert ids.add_occurrence(staged, ["key"], "n", "total").count() == 0


def test_rows_are_made_once_before_the_range_shuffle(spark):
    """The range shuffle samples its input; what made the rows does not run for that again."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def key(i):
        made.add(1)
        return f"k{i % 7}"

    df = spark.range(200, numPartitions=4).select(key("id").alias("key"), "id")
    ordered = ids.stage_in_order(df, ["key"], once=True)
    assert made.value == 200
    assert not any("unordered" in f for f in ordered.inputFiles())
    assert ordered.count() == 200


def test_places_in_months_do_not_shuffle_the_staged_rows(spark, rows):
    """However large the rows are guessed to be, the few borders go to them."""
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ordered = ids.stage_in_order(rows, ["period", "key", "v"])
        placed = ids.add_position(ordered, ["period"], "_n")
        numbered = ids.add_occurrence(placed, ["period", "key"], "_k", "_total")
        plan = placed._jdf.queryExecution().executedPlan().toString()
        both = numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert "SortMergeJoin" not in plan + both
    assert plan.count("Exchange hashpartitioning") == 1  # of the borders, by month
    per_month = {}
    for r in placed.collect():
        per_month.setdefault(r.period, []).append(r._n)
    assert all(sorted(n) == list(range(1, len(n) + 1)) for n in per_month.values())
