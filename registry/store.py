"""Synchronisation, landing and streaming.

The written tables live in the staging folder; a query returns what they hold.
"""

from __future__ import annotations

import datetime as dt
import itertools
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from registry.core import query, table
from snapmart.functions.dates import day_range, period_key, snapshot_key
from snapmart.operators import ids
from snapmart.plans import sync
from snapmart.plans.pipeline import run_isolated
from snapmart.plans.sync import MERGE_PERIODS, MERGE_TABLE, REPLACE_PERIODS, Store, TableSpec
from snapmart.sources.files import (
    discover_periods, read_table, scan_named_files, scan_periods, source_inventory, write_periods,
)
from snapmart.sources.manifest import choose_files, landing_manifest, not_landed, source_list, text_list
from snapmart.sources.staging import child_names, move, new_path
from snapmart.sources.versions import FACTOR, append, load_version, read_stored
from snapmart.streaming import event_time, landing

COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
LIST = ", ".join(COLUMNS)
LINES = TableSpec("lines", REPLACE_PERIODS, period_date="l_shipdate", retained=True)


def lines(spark, d):
    return table(spark, d, "lineitem").select(*COLUMNS)


def clock():
    """Load times one second apart from a fixed start."""
    ticks = itertools.count()
    return lambda: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=next(ticks))


def fresh_store(spark) -> Store:
    return Store(spark, new_path(spark, "store"), clock())


def month(c="l_shipdate"):
    return period_key(c)


# ---- content and plans ------------------------------------------------------------

@query("period_counts", "SELECT strftime(l_shipdate, '%Y%m') AS period, count(*) AS row_count FROM lineitem GROUP BY 1")
def period_counts(spark, d):
    return sync.period_counts(sync.with_period(lines(spark, d), LINES))


@query("fingerprint_by_period", """
SELECT strftime(l_shipdate, '%Y%m') AS period, count(*) AS row_count, 64::BIGINT AS hash_length, true AS same_reshuffled, count(CASE WHEN l_quantity = 50 THEN 1 END) = 0 AS same_edited
FROM lineitem GROUP BY 1""")
def fingerprint_by_period(spark, d):
    """Per month: rows, and whether the hash survives another order and layout, and an edit."""
    rows = sync.with_period(table(spark, d, "lineitem"), LINES)
    edited = rows.withColumn("l_quantity", F.when(F.col("l_quantity") == 50, -1.0).otherwise(F.col("l_quantity")))
    named = lambda df, name: sync.fingerprint(df).select("period", F.col("content_hash").alias(name))
    joined = sync.fingerprint(rows).join(named(rows.hint("rebalance"), "_a"), "period").join(named(edited, "_b"), "period")
    return joined.select(
        "period", "row_count", F.length("content_hash").cast("bigint").alias("hash_length"),
        (F.col("content_hash") == F.col("_a")).alias("same_reshuffled"), (F.col("content_hash") == F.col("_b")).alias("same_edited"),
    )


@query("fingerprint_changes", """
SELECT strftime(l_shipdate, '%Y%m') AS period, max(CASE WHEN l_quantity = 50 AND l_discount = 0 AND l_tax = 0 THEN 1 ELSE 0 END) = 0 AS unchanged
FROM lineitem GROUP BY 1""")
def fingerprint_changes(spark, d):
    """Months whose content survives a reshuffle and an edit of a few cells."""
    rows = sync.with_period(table(spark, d, "lineitem"), LINES)
    edited = (F.col("l_quantity") == 50) & (F.col("l_discount") == 0) & (F.col("l_tax") == 0)
    other = rows.withColumn("l_quantity", F.when(edited, F.lit(None)).otherwise(F.col("l_quantity"))).hint("rebalance")
    a, b = sync.fingerprint(rows), sync.fingerprint(other)
    joined = a.join(b.select("period", F.col("content_hash").alias("_b")), "period")
    return joined.select("period", (F.col("content_hash") == F.col("_b")).alias("unchanged"))


@query("sync_plan", """
WITH s AS (SELECT strftime(l_shipdate, '%Y%m') AS period, count(*) AS row_count,
  count(CASE WHEN l_quantity = 50 AND l_discount = 0 THEN 1 END) AS edited,
  count(CASE WHEN l_quantity = 49 AND l_discount = 0.02 THEN 1 END) AS lost FROM lineitem GROUP BY 1),
r AS (SELECT *, CASE WHEN period < '199507' THEN 'new' WHEN edited > 0 THEN 'content changed'
  WHEN lost > 0 THEN 'target count differs' WHEN period >= '200101' THEN 'ledger differs' END AS reason FROM s)
SELECT period, CASE WHEN reason IS NULL THEN 'SKIP' ELSE 'UPDATE' END AS action, reason, row_count FROM r""")
def sync_plan(spark, d):
    """Plan against a copy with edited cells, lost rows and a wrong ledger."""
    rows = sync.with_period(table(spark, d, "lineitem"), LINES)
    edited = (F.col("l_quantity") == 50) & (F.col("l_discount") == 0)
    old = rows.withColumn("l_quantity", F.when(edited, 0.0).otherwise(F.col("l_quantity")))
    ledger = sync.fingerprint(old).where(F.col("period") >= "199507")
    ledger = ledger.withColumn(
        "row_count", F.col("row_count") + F.when(F.col("period") >= "200101", 1).otherwise(0)
    )
    target = sync.period_counts(rows.where(~((F.col("l_quantity") == 49) & (F.col("l_discount") == 0.02))))
    return sync.sync_plan(sync.fingerprint(rows), ledger, target).drop("content_hash")


@query("ledger_current", """
SELECT load_id, table_name, period, content_hash, row_count FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS load_id, o_orderpriority AS table_name, strftime(o_orderdate, '%Y%m') AS period,
    o_orderstatus AS content_hash, o_custkey AS row_count,
    row_number() OVER (PARTITION BY o_orderpriority, strftime(o_orderdate, '%Y%m') ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS n
  FROM orders WHERE o_orderstatus <> 'P') WHERE n = 1""")
def ledger_current(spark, d):
    ledger = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("load_id"),
        F.col("o_orderpriority").alias("table_name"),
        month("o_orderdate").alias("period"),
        F.col("o_orderstatus").alias("content_hash"),
        F.col("o_custkey").alias("row_count"),
        F.when(F.col("o_orderstatus") == "P", sync.FAILURE).otherwise(sync.SUCCESS).alias("status"),
        F.col("o_orderdate").alias("loaded_at"),
    )
    return sync.ledger_current(ledger).drop("status", "loaded_at")


# ---- loads ------------------------------------------------------------------------

@query("sync_replace", f"SELECT {LIST}, strftime(l_shipdate, '%Y%m') AS period FROM lineitem")
def sync_replace(spark, d):
    """An old version is loaded, then the true one over it: changed months only."""
    store, rows = fresh_store(spark), lines(spark, d)
    edited = (F.col("l_shipdate") >= F.lit("1999-01-01")) & (F.col("l_quantity") > 40)
    store.load(LINES, rows.where(~edited), "lines.parquet", "v1")
    store.load(LINES, rows, "lines.parquet", "v2")
    return store.table("lines")


@query("sync_history", """
WITH m AS (SELECT strftime(l_shipdate, '%Y%m') AS period, count(*) AS n,
  count(CASE WHEN l_shipdate >= '1999-01-01' AND l_quantity > 40 THEN 1 END) AS edited FROM lineitem GROUP BY 1)
SELECT period, 'v1' AS tag, n - edited AS row_count FROM m UNION ALL SELECT period, 'v2', n FROM m WHERE edited > 0""")
def sync_history(spark, d):
    """Ledger after an old version, the true one, and the true one once more."""
    store, rows = fresh_store(spark), lines(spark, d)
    edited = (F.col("l_shipdate") >= F.lit("1999-01-01")) & (F.col("l_quantity") > 40)
    store.load(LINES, rows.where(~edited), "lines.parquet", "v1")
    store.load(LINES, rows, "lines.parquet", "v2")
    store.load(LINES, rows.repartition(5), "lines.parquet", "v3")
    return store.period_ledger("lines").select("period", "tag", "row_count")


VERSIONS = TableSpec("versions", MERGE_PERIODS, ["unit_version"], period_date="seen_on", retained=True)


@query("sync_upsert", """
WITH g AS (SELECT strftime(l_shipdate, '%Y%m') AS period, l_suppkey, count(*) AS lines,
  max(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS old_top, max(CASE WHEN l_returnflag <> 'A' THEN l_quantity END) AS new_top,
  count(CASE WHEN l_returnflag <> 'R' THEN 1 END) AS olds, count(CASE WHEN l_returnflag <> 'A' THEN 1 END) AS news
  FROM lineitem GROUP BY 1, 2)
SELECT period || lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS unit_version, strptime(period || '01', '%Y%m%d')::DATE AS seen_on,
  CASE WHEN news > 0 THEN new_top ELSE old_top END AS top, period FROM g WHERE olds + news > 0""")
def sync_upsert(spark, d):
    """Facility versions updated by key; versions the new source lacks are kept."""
    store, rows = fresh_store(spark), table(spark, d, "lineitem")

    def versions(without: str):
        kept = rows.where(F.col("l_returnflag") != without)
        day = F.trunc("l_shipdate", "MM")
        return kept.groupBy(
            snapshot_key("l_shipdate", "l_suppkey").alias("unit_version"), day.alias("seen_on")
        ).agg(F.max("l_quantity").alias("top"))

    store.load(VERSIONS, versions("R"), "versions.parquet", "v1")
    store.load(VERSIONS, versions("A"), "versions.parquet", "v2")
    return store.table("versions")


@query("sync_dimension", """
SELECT s_suppkey AS id, s_name || CASE WHEN s_acctbal >= 0 THEN ' new' ELSE ' old' END AS name FROM supplier WHERE s_acctbal >= 0 OR s_acctbal < 5000""")
def sync_dimension(spark, d):
    store, supplier = fresh_store(spark), table(spark, d, "supplier")
    spec = TableSpec("names", MERGE_TABLE, ["id"])
    name = lambda suffix: F.concat("s_name", F.lit(suffix)).alias("name")
    old = supplier.where(F.col("s_acctbal") < 5000).select(F.col("s_suppkey").alias("id"), name(" old"))
    new = supplier.where(F.col("s_acctbal") >= 0).select(F.col("s_suppkey").alias("id"), name(" new"))
    store.load(spec, old, "names.parquet", "v1")
    store.load(spec, new, "names.parquet", "v2")
    return store.table("names")


@query("sync_upsert_moved", """
SELECT o_orderkey AS id, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 40 DAY ELSE o_orderdate END AS DATE) AS seen_on,
  strftime(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 40 DAY ELSE o_orderdate END, '%Y%m') AS period FROM orders""")
def sync_upsert_moved(spark, d):
    """A third of the keys turn up under another month: one row a key remains."""
    store, orders = fresh_store(spark), table(spark, d, "orders")
    spec = TableSpec("moved", MERGE_PERIODS, ["id"], period_date="seen_on")
    day = F.col("o_orderdate").cast("date")
    old = orders.select(F.col("o_orderkey").alias("id"), day.alias("seen_on"))
    new = orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"), F.date_add(day, 40).alias("seen_on"))
    store.load(spec, old, "moved.parquet", "v1")
    store.load(spec, new, "moved.parquet", "v2")
    return store.table("moved")


@query("sync_failed_load", """
SELECT 'names' AS table_name, count(*) AS row_count, count(CASE WHEN s_acctbal >= 0 THEN 1 END) AS renamed, 1::BIGINT AS failures, 2::BIGINT AS successes FROM supplier""")
def sync_failed_load(spark, d):
    """A load that fails while it writes leaves the old rows and a FAILURE; the repeated one goes through."""
    store, supplier = fresh_store(spark), table(spark, d, "supplier")
    spec = TableSpec("names", MERGE_TABLE, ["id"])
    old = supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    new = supplier.where("s_acctbal >= 0").select(F.col("s_suppkey").alias("id"), F.concat("s_name", F.lit(" new")).alias("name"))
    store.load(spec, old, "names.parquet", "v1")
    broken = new.withColumn("name", F.when(F.col("id") > 0, F.raise_error(F.lit("broken cell"))).otherwise(F.col("name")))
    try:
        store.load(spec, broken, "names.parquet", "v2")
    except Exception as e:
        if "broken cell" not in str(e):
            raise
    if store.table("names").where("name LIKE '% new'").count():
        raise ValueError("a failed load left rows")
    store.load(spec, new, "names.parquet", "v2")
    ledger = store.file_ledger().agg(
        F.count_if(F.col("status") == sync.FAILURE).alias("failures"), F.count_if(F.col("status") == sync.SUCCESS).alias("successes")
    ).first()
    rows = store.table("names")
    return rows.agg(F.count("*").alias("row_count"), F.count_if(F.col("name").endswith(" new")).alias("renamed")).select(
        F.lit("names").alias("table_name"), "row_count", "renamed", F.lit(ledger.failures).cast("bigint").alias("failures"), F.lit(ledger.successes).cast("bigint").alias("successes")
    )


@query("sync_all", """
WITH m AS (SELECT strftime(l_shipdate, '%Y%m') AS period, count(*) AS n FROM lineitem WHERE l_shipdate >= '1999-09-01' GROUP BY 1)
SELECT 'lines' AS table_name, period, n AS row_count FROM m
UNION ALL SELECT 'names', NULL, count(*) FROM supplier""")
def sync_all(spark, d):
    """Several tables, parents first, then retention; expired months are not loaded, and a second run changes nothing."""
    store = fresh_store(spark)
    names = TableSpec("names", MERGE_TABLE, ["s_suppkey"])
    sources = lambda tag: {
        "names": (table(spark, d, "supplier").select("s_suppkey", "s_name"), "names.parquet", tag),
        "lines": (lines(spark, d), "lines.parquet", tag),
    }
    store.load_all(sources("v1"), dt.date(2000, 9, 15), 12, [names, LINES])
    if store.load_all(sources("v2"), dt.date(2000, 9, 15), 12, [names, LINES])["lines"]:
        raise ValueError("months were loaded again")
    counts = sync.period_counts(store.table("lines")).select(F.lit("lines").alias("table_name"), "period", "row_count")
    dims = store.table("names").agg(F.count("*").alias("row_count"))
    return counts.unionByName(dims.select(F.lit("names").alias("table_name"), F.lit(None).cast("string").alias("period"), "row_count"))


@query("file_last_success", """
SELECT table_name, file_name, tag, row_count FROM (
  SELECT o_orderpriority AS table_name, o_orderstatus AS file_name, CAST(o_orderkey AS VARCHAR) AS tag, o_custkey AS row_count,
    row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS n
  FROM orders WHERE o_custkey % 5 <> 0) WHERE n = 1""")
def file_last_success(spark, d):
    """The last successful load of each file of a table."""
    ledger = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("table_name"), F.col("o_orderstatus").alias("file_name"), F.col("o_orderkey").cast("string").alias("tag"),
        F.col("o_custkey").alias("row_count"), F.when(F.col("o_custkey") % 5 == 0, sync.FAILURE).otherwise(sync.SUCCESS).alias("status"),
        F.col("o_orderdate").alias("loaded_at"),
    )
    return sync.ledger_current(ledger, ["table_name", "file_name"]).select("table_name", "file_name", "tag", "row_count")


@query("retention", f"SELECT {LIST}, strftime(l_shipdate, '%Y%m') AS period FROM lineitem WHERE l_shipdate >= '1999-09-01'")
def retention(spark, d):
    store = fresh_store(spark)
    store.load(LINES, lines(spark, d), "lines.parquet", "v1")
    sync.retain(spark, store.path("lines"), dt.date(2000, 9, 15), 12)
    return store.table("lines")


@query("bootstrap_ledger", "SELECT strftime(l_shipdate, '%Y%m') AS period, count(*) AS row_count, 'SUCCESS' AS status FROM lineitem GROUP BY 1")
def bootstrap_ledger(spark, d):
    """Month ledger for a table that was filled by other means."""
    store, rows = fresh_store(spark), lines(spark, d)
    write_periods(sync.with_period(rows, LINES), store.path("lines"))
    store.bootstrap_file(LINES, "lines.parquet", "v1")
    store.bootstrap_periods(LINES, rows, "lines.parquet", "v1")
    return store.period_ledger("lines").select("period", "row_count", "status")


@query("table_versions", """
WITH m AS (SELECT strftime(l_shipdate, '%Y%m') AS period, count(*) AS n, sum(l_quantity) AS q,
  count(CASE WHEN l_quantity <= 40 THEN 1 END) AS old_n, sum(CASE WHEN l_quantity <= 40 THEN l_quantity END) AS old_q FROM lineitem GROUP BY 1)
SELECT 'before' AS seen, period, old_n AS row_count, CAST(old_q AS DOUBLE) AS quantity FROM m WHERE old_n > 0
UNION ALL SELECT 'after', period, n, CAST(q AS DOUBLE) FROM m""")
def table_versions(spark, d):
    """Two versions of one table: the one before a load, read after it, and the newest."""
    store, rows = fresh_store(spark), lines(spark, d)
    store.load(LINES, rows.where("l_quantity <= 40"), "lines.parquet", "v1")
    first = load_version(spark, store.path("lines")).number
    store.load(LINES, rows, "lines.parquet", "v2")
    seen = {"before": store.table("lines", first), "after": store.table("lines")}
    parts = [df.groupBy(F.lit(n).alias("seen"), "period").agg(F.count("*").alias("row_count"), F.sum("l_quantity").cast("double").alias("quantity")) for n, df in seen.items()]
    return parts[0].unionByName(parts[1])


KEYED = TableSpec("lines", REPLACE_PERIODS, ["l_orderkey", "l_linenumber"], period_date="l_shipdate", buckets=4)


@query("sync_buckets", f"""
SELECT {LIST}, strftime(l_shipdate, '%Y%m') AS period, 1::BIGINT AS rewritten
FROM (SELECT * REPLACE (CASE WHEN l_orderkey = (SELECT min(l_orderkey) FROM lineitem) AND l_linenumber = 1 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity) FROM lineitem)""")
def sync_buckets(spark, d):
    """One line is edited: the table holds the edit, and one bucket of one month was written."""
    store, rows = fresh_store(spark), lines(spark, d)
    store.load(KEYED, rows, "lines.parquet", "v1")
    before = set(load_version(spark, store.path("lines")).parts)
    least = rows.agg(F.min("l_orderkey")).first()[0]
    edited = (F.col("l_orderkey") == least) & (F.col("l_linenumber") == 1)
    store.load(KEYED, rows.withColumn("l_quantity", F.when(edited, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))), "lines.parquet", "v2")
    fresh = set(load_version(spark, store.path("lines")).parts) - before
    return store.table("lines").withColumn("rewritten", F.lit(len(fresh)).cast("long"))


@query("landed_parts", """
SELECT strftime(o_orderdate, '%Y%m') AS period, count(*) AS row_count, CAST(sum(o_custkey) AS BIGINT) AS customers, true AS few FROM orders GROUP BY 1""")
def landed_parts(spark, d):
    """Orders landed in ten batches: small parts were merged, and every row is there."""
    orders, out = table(spark, d, "orders").select("o_orderkey", "o_custkey", period_key("o_orderdate").alias("period")), new_path(spark, "landed")
    for i in range(10):
        append(orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(10)) == i), out, ["period"], i)
    version = load_version(spark, out)
    most = max((len(version.rows([p])) for p in version.periods()), default=0)
    counts = read_stored(spark, out).groupBy("period").agg(F.count("*").alias("row_count"), F.sum("o_custkey").cast("long").alias("customers"))
    return counts.withColumn("few", F.lit(most <= FACTOR))


# ---- files ------------------------------------------------------------------------

@query("drifting_files", """
SELECT CASE WHEN o_orderkey % 4 = 3 THEN lpad(CAST(o_orderkey AS VARCHAR), 12, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS order_key,
  o_custkey, CASE WHEN o_orderkey % 4 = 1 THEN o_orderpriority END AS priority, CAST(o_orderkey % 4 AS VARCHAR) AS state, strftime(o_orderdate, '%Y%m') AS period
FROM orders""")
def drifting_files(spark, d):
    """Files of states that write the same key as a number, a decimal fraction, an integer and a text; one has a column more."""
    path, orders = new_path(spark, "drift"), table(spark, d, "orders")
    key = F.col("o_orderkey")
    forms = {0: key.cast("double"), 1: key.cast("long"), 2: key.cast("int"), 3: F.lpad(key.cast("string"), 12, "0")}
    for state, form in forms.items():
        more = [F.col("o_orderpriority").alias("priority")] if state == 1 else []
        rows = orders.where(key % 4 == state).select(form.alias("order_key"), "o_custkey", *more, period_key("o_orderdate").alias("period"))
        parts = new_path(spark, "parts")
        rows.hint("rebalance", "period").write.partitionBy("period").parquet(parts)
        for n in child_names(spark, parts):
            if "=" in n:
                move(spark, f"{parts}/{n}", f"{path}/raw_or_{state}_{n.split('=')[1]}.parquet")
    return scan_named_files(spark, path, "raw_or").select("order_key", "o_custkey", "priority", "state", "period")

@query("month_scan", f"SELECT {LIST}, strftime(l_shipdate, '%Y%m') AS period FROM lineitem WHERE year(l_shipdate) = 1998")
def month_scan(spark, d):
    """A period dataset is written; the months of one year are read back."""
    path = new_path(spark, "months")
    write_periods(sync.with_period(lines(spark, d), LINES), path)
    wanted = [p for p in discover_periods(spark, path) if p.startswith("1998")]
    return scan_periods(spark, path, wanted)


@query("named_file_scan", """
SELECT event_id, user_id, value, upper(event_type) AS state, strftime(ts, '%Y%m') AS period FROM events""")
def named_file_scan(spark, d):
    """Files named by state and month, written in one job and then moved to their names."""
    path, parts = new_path(spark, "files"), new_path(spark, "parts")
    events = table(spark, d, "events").withColumn("period", period_key("ts"))
    events.select("event_id", "user_id", "value", "event_type", "period").write.partitionBy("event_type", "period").parquet(parts)
    names = lambda p: [n.split("=", 1)[1] for n in child_names(spark, p) if "=" in n]
    found = [(t, p) for t in names(parts) for p in names(f"{parts}/event_type={t}")]
    for t, p in found:
        move(spark, f"{parts}/event_type={t}/period={p}", f"{path}/raw_ev_{t}_{p}.parquet")
    rows = scan_named_files(spark, path, "raw_ev", sorted({p for _, p in found}))
    return rows.select("event_id", "user_id", "value", "state", "period")


@query("projected_read", "SELECT doc_id, lang FROM documents")
def projected_read(spark, d):
    """Of the wanted columns, those the file has."""
    return read_table(spark, f"{d}/documents.parquet", ["doc_id", "lang", "not_there"])


@query("source_inventory", """
SELECT 'orders' AS name, count(*) AS row_count, true AS sized, true AS own_tags, true AS all_listed, count(DISTINCT coalesce(strftime(o_orderdate, '%Y%m'), '')) AS months FROM orders
UNION ALL SELECT 'supplier', count(*), true, true, true, CAST(count(*) > 0 AS BIGINT) FROM supplier
UNION ALL SELECT 'nation', count(*), true, true, true, CAST(count(*) > 0 AS BIGINT) FROM nation""")
def inventory(spark, d):
    """The tables are written whole, orders by month; one inventory of their folder finds every file, and the rows that each holds."""
    root, months = new_path(spark, "inventory"), {"orders": month("o_orderdate"), "supplier": F.lit("all"), "nation": F.lit("all")}
    held = []
    for n, value in months.items():
        rows = table(spark, d, n).withColumn("month", value)
        rows.hint("rebalance", "month").write.partitionBy("month").parquet(f"{root}/{n}")
        read = spark.read.schema(rows.schema).parquet(f"{root}/{n}").groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("row_count"))
        held.append(read.withColumn("stored", F.lit(n)))
    files = source_inventory(spark, root).withColumn("name", F.element_at(F.split("path", "/"), -3))
    found = files.join(reduce(DataFrame.unionByName, held), "path", "full").groupBy(F.coalesce("name", "stored").alias("name"))
    counted = found.agg(
        F.sum("row_count").alias("row_count"), F.min(F.col("size") > 0).alias("sized"), (F.count_distinct("tag") == F.count("*")).alias("own_tags"),
        F.min(F.col("tag").isNotNull()).alias("all_listed"), F.count_distinct(F.element_at(F.split("path", "/"), -2)).alias("months"),
    )
    names = spark.createDataFrame([(n,) for n in months], "name string")  # a table without rows has no file
    return names.join(counted, "name", "left").fillna(0, ["row_count", "months"]).fillna(True, ["sized", "own_tags", "all_listed"])


# ---- landing ----------------------------------------------------------------------

SOURCES = {"RD": "raw_sih_rd", "ST": "raw_cnes_st"}
MANIFEST = """m AS (
SELECT period, n_name AS state, prefix, base || '_' || lower(n_name) || '_' || period || '.parquet' AS target
FROM (SELECT DISTINCT strftime(l_shipdate, '%Y%m') AS period FROM lineitem) CROSS JOIN nation
CROSS JOIN (VALUES ('RD', 'raw_sih_rd'), ('ST', 'raw_cnes_st')) s(prefix, base))"""
OFFERS = """f AS (SELECT DISTINCT strftime(l_shipdate, '%Y%m') AS period, n_name AS state,
  CASE WHEN l_linestatus = 'O' THEN 'RD' ELSE 'ST' END || n_name || '-' || l_returnflag AS name
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_quantity > 45)"""


def manifest(spark, d):
    states = [r[0] for r in table(spark, d, "nation").select("n_name").orderBy("n_name").collect()]
    months = lines(spark, d).select(month().alias("period")).distinct()
    return landing_manifest(months, text_list(states), source_list(SOURCES))


def offers(spark, d):
    rows = (
        table(spark, d, "lineitem").where(F.col("l_quantity") > 45)
        .join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    prefix = F.when(F.col("l_linestatus") == "O", "RD").otherwise("ST")
    return rows.select(
        month().alias("period"), F.col("n_name").alias("state"),
        F.concat(prefix, "n_name", F.lit("-"), "l_returnflag").alias("name"),
    ).distinct()


@query("landing_manifest", f"WITH {MANIFEST} SELECT * FROM m")
def all_targets(spark, d):
    return manifest(spark, d)


@query("landing_todo", f"""WITH {MANIFEST}, {OFFERS}
SELECT * FROM m WHERE target NOT IN (SELECT 'raw_sih_rd_' || lower(state) || '_' || period || '.parquet' FROM f)""")
def landing_todo(spark, d):
    landed = offers(spark, d).select(
        F.format_string("raw_sih_rd_%s_%s.parquet", F.lower("state"), "period").alias("name")
    ).distinct()
    return not_landed(manifest(spark, d), landed)


@query("landing_choice", f"""WITH {MANIFEST}, {OFFERS}
SELECT m.period, m.state, m.prefix, m.target, min(f.name) AS file FROM m JOIN f USING (period, state)
WHERE starts_with(f.name, m.prefix) GROUP BY ALL""")
def landing_choice(spark, d):
    return choose_files(manifest(spark, d), offers(spark, d))


# ---- streaming --------------------------------------------------------------------

def event_files(spark, d):
    """The events as several files, and their schema."""
    path, events = new_path(spark, "arrivals"), table(spark, d, "events")
    events.repartition(6).write.parquet(path)
    return path, events


@query("landing_stream", "SELECT event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y%m') AS period FROM events")
def landing_stream(spark, d):
    """All files are landed; a second run finds nothing new."""
    path, events = event_files(spark, d)
    out, checkpoint = new_path(spark, "landed"), new_path(spark, "checkpoint")
    for _ in range(2):
        landing.ingest_available(spark, path, events.schema, out, checkpoint, month("ts"), files_per_batch=2)
    return read_stored(spark, out)


@query("stream_refresh", """
SELECT strftime(ts, '%Y%m') AS period, CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(CAST(value AS DECIMAL(18,2))), 2)::DOUBLE AS total
FROM events GROUP BY ALL""")
def stream_refresh(spark, d):
    """Daily totals rebuilt for the months each batch of files touches."""
    path, events = event_files(spark, d)
    landed, target, checkpoint = (new_path(spark, n) for n in ("landed", "target", "checkpoint"))
    stream = landing.file_stream(spark, path, events.schema, 2).withColumn("period", month("ts"))

    def build(rows):
        amount = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
        return rows.groupBy("period", F.col("ts").cast("date").alias("day"), "event_type").agg(
            F.count("*").alias("n"), amount.alias("total")
        )

    landing.refresh_changed_periods(stream, landed, target, build, checkpoint)
    return read_stored(spark, target)


@query("stream_month_counts", """
SELECT strftime(ts - to_months(CAST(user_id % 12 AS INTEGER)), '%Y-%m') AS month, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_month_counts(spark, d):
    """Events spread over a year, delivered newest month first."""
    path, events = new_path(spark, "arrivals"), table(spark, d, "events")
    shifted = events.withColumn("ts", F.col("ts").cast("timestamp") - F.make_ym_interval(F.lit(0), (F.col("user_id") % 12).cast("int")))
    for back in range(12):
        shifted.where(F.col("user_id") % 12 == back).write.mode("append").parquet(path)
    out, checkpoint = new_path(spark, "counts"), new_path(spark, "checkpoint")
    landing.day_counts(landing.file_stream(spark, path, shifted.schema, 2), "ts", ["event_type"], out, checkpoint)
    return landing.month_counts(read_stored(spark, out), ["event_type"])


@query("stream_event_time", """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_event_time(spark, d):
    """Files in no order of time: what comes behind the watermark is counted in the side table."""
    path, events = event_files(spark, d)
    out, late, checkpoint = (new_path(spark, n) for n in ("counts", "late", "checkpoint"))
    stream = landing.file_stream(spark, path, events.schema, 1)
    event_time.event_time_counts(stream, "ts", ["event_type"], "3 days", out, late, checkpoint)
    counts = event_time.current_counts(read_stored(spark, out), ["event_type"])
    both = event_time.with_late(counts, read_stored(spark, late), ["event_type"])
    return both.select("day", "event_type", (F.col("on_time") + F.col("late")).alias("n"))


# ---- guards -----------------------------------------------------------------------

def refused(step, message: str) -> bool:
    """True when the step fails for this reason."""
    try:
        step()
    except Exception as e:
        if message in str(e):
            return True
        raise
    return False


@query("guards", """
SELECT 'block overflow' AS guard, true AS held, count(*) AS row_count FROM lineitem
UNION ALL SELECT 'file loaded twice', true, count(*) FROM lineitem
UNION ALL SELECT 'no ledger', true, count(*) FROM lineitem
UNION ALL SELECT 'repeated upsert key', true, count(*) FROM orders
UNION ALL SELECT 'range backwards', true, count(*) FROM lineitem
UNION ALL SELECT 'failing step stops no other', true, count(*) FROM lineitem""")
def guards(spark, d):
    """What has to be refused is, on the rows of the test tables, and leaves the tables as they were."""
    rows, orders = lines(spark, d), table(spark, d, "orders")
    store, other = fresh_store(spark), fresh_store(spark)
    store.load(LINES, rows, "lines.parquet", "v1")
    write_periods(sync.with_period(rows, LINES), other.path("lines"))
    twice = orders.select(F.col("o_custkey").alias("id"), F.col("o_orderdate").cast("date").alias("seen_on"))
    spec = TableSpec("moved", MERGE_PERIODS, ["id"], period_date="seen_on")
    done = []

    def isolated() -> bool:
        steps = {"broken": lambda: rows.select(F.raise_error(F.lit("broken step"))).collect(), "good": lambda: done.append(rows.count())}
        return refused(lambda: run_isolated(steps), "broken step") and len(done) == 1

    numbered = sync.with_period(rows, LINES)
    held = {
        "block overflow": (refused(lambda: ids.block_ids(numbered, "period", ["l_orderkey"], "id", 1990, 2).write.format("noop").mode("overwrite").save(), "more than 1 rows"), rows),
        "file loaded twice": (store.load(LINES, rows, "lines.parquet", "v1") == [], store.table("lines")),
        "no ledger": (refused(lambda: other.load(LINES, rows, "lines.parquet", "v1"), "bootstrap"), other.table("lines")),
        "repeated upsert key": (refused(lambda: store.load(spec, twice, "moved.parquet", "v1"), "duplicate row"), orders),
        "range backwards": (refused(lambda: day_range("l_shipdate", dt.date(1998, 1, 2), dt.date(1998, 1, 1)), "before it starts"), rows),
        "failing step stops no other": (isolated(), rows),
    }
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(g).alias("guard"), F.lit(ok).alias("held"), "row_count") for g, (ok, df) in held.items()]
    return reduce(DataFrame.unionByName, parts)
