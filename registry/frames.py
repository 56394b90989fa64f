"""Lookups, schemas, ids, quality reports and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import query, table
from snapmart.functions import dates
from snapmart.operators import ids, lookup, quality, shape
from snapmart.operators.dims import date_dim, place_dim
from snapmart.plans import gold
from snapmart.sources.catalogs import json_members

# ---- lookups -------------------------------------------------------------------
# A catalog of large parts and of Asian nations: codes outside it stay unknown.

PART_TEXTS = "SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS text FROM part WHERE p_size > 10"


def part_texts(spark, d):
    part = table(spark, d, "part").where(F.col("p_size") > 10)
    return part.select(F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("text"))


@query("translate_code", f"""
SELECT coalesce(c.text, CAST(l_partkey AS VARCHAR)) AS part, count(*) AS n
FROM lineitem LEFT JOIN ({PART_TEXTS}) c ON c.code = CAST(l_partkey AS VARCHAR) GROUP BY 1""")
def translate_code(spark, d):
    rows = table(spark, d, "lineitem").select("l_partkey")
    rows = lookup.translate_code(rows, "part", F.col("l_partkey").cast("string"), part_texts(spark, d))
    return rows.groupBy("part").agg(F.count("*").alias("n"))


@query("describe_code", f"""
SELECT CAST(l_partkey AS VARCHAR) AS part, c.text AS description, count(*) AS n
FROM lineitem LEFT JOIN ({PART_TEXTS}) c ON c.code = CAST(l_partkey AS VARCHAR) GROUP BY 1, 2""")
def describe_code(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("part"))
    rows = lookup.add_description(rows, "part", part_texts(spark, d), "description")
    return rows.groupBy("part", "description").agg(F.count("*").alias("n"))


@query("translate_inline", f"""
SELECT concat_ws(' - ', CAST(l_partkey AS VARCHAR), c.text) AS part, count(*) AS n
FROM lineitem LEFT JOIN ({PART_TEXTS}) c ON c.code = CAST(l_partkey AS VARCHAR) GROUP BY 1""")
def translate_inline(spark, d):
    rows = table(spark, d, "lineitem").select("l_partkey")
    rows = lookup.translate_inline(rows, "part", F.col("l_partkey").cast("string"), part_texts(spark, d))
    return rows.groupBy("part").agg(F.count("*").alias("n"))


@query("translate_composite", """
WITH pairs AS (SELECT p_type, p_brand, min(p_name) AS text FROM part WHERE p_size > 40 GROUP BY 1, 2)
SELECT p.p_partkey, c.text AS description FROM part p LEFT JOIN pairs c USING (p_type, p_brand)""")
def translate_composite(spark, d):
    part = table(spark, d, "part")
    pairs = part.where(F.col("p_size") > 40).groupBy(
        F.col("p_type").alias("group"), F.col("p_brand").alias("code")
    ).agg(F.min("p_name").alias("text"))
    rows = lookup.add_description_by_pair(part, "p_type", "p_brand", pairs, "description")
    return rows.select("p_partkey", "description")


@query("load_catalog", """
SELECT upper(replace(p_brand, '.', '')) AS code, min(trim(p_name)) AS text
FROM part WHERE trim(p_name) <> '' AND p_size > 2 GROUP BY 1""")
def load_catalog(spark, d):
    """One text per code out of a catalog whose headers need resolving."""
    raw = table(spark, d, "part").select(
        F.when(F.col("p_size") > 2, F.col("p_brand")).otherwise(" ").alias("Código"),
        F.concat(F.lit(" "), "p_name").alias("Título da Ocupação"),
        F.lit(None).cast("string").alias("_c2"),
    )
    return lookup.load_catalog(raw, lookup.CODE_HEADERS, lookup.TITLE_HEADERS, text_hints=[["titul"]])


@query("json_catalog", """
SELECT substr(CAST(json_extract(props, '$.k') AS VARCHAR), 1, 6) AS code, min(event_type) AS text FROM events GROUP BY 1""")
def json_catalog(spark, d):
    rows = table(spark, d, "events").withColumn("k", F.from_json("props", "k long")["k"])
    return lookup.code_and_name(rows, "k", "event_type", 6)


@query("json_members", """
SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1""")
def json_rows(spark, d):
    return json_members(table(spark, d, "events"), "props", "k long").groupBy("k").agg(F.count("*").alias("n"))


PREFIXES = """SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS state, r_name AS region
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'"""


def prefixes(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    known = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).where(F.col("r_name") != "ASIA")
    return known.select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("region"),
    )


@query("place_from_prefix", f"""
SELECT c_custkey, coalesce(x.region, 'Exterior/Outros') AS region, coalesce(x.state, 'EX') AS state
FROM customer LEFT JOIN ({PREFIXES}) x ON x.code = lpad(CAST(c_nationkey AS VARCHAR), 2, '0')""")
def place_from_prefix(spark, d):
    code = F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("0001"))
    rows = table(spark, d, "customer").select("c_custkey", code.alias("code6"))
    rows = lookup.from_prefix(rows, "code6", prefixes(spark, d), {"region": "Exterior/Outros", "state": "EX"})
    return rows.select("c_custkey", "region", "state")


@query("unmatched_profile", f"""
WITH u AS (
  SELECT 'part' AS "column", CAST(l_partkey AS VARCHAR) AS code, count(*) AS n FROM lineitem
  WHERE CAST(l_partkey AS VARCHAR) NOT IN (SELECT code FROM ({PART_TEXTS})) GROUP BY ALL
  UNION ALL
  SELECT 'order', l_linestatus || '/' || l_returnflag, count(*) FROM lineitem
  WHERE NOT (l_linestatus = 'O' AND l_returnflag IN ('A', 'N', 'R')) GROUP BY ALL)
SELECT "column", CAST(sum(n) AS BIGINT) AS unmatched_rows, count(*) AS unmatched_codes,
  array_to_string(list_slice(list_sort(list(code)), 1, 10), ',') AS examples FROM u GROUP BY 1""")
def unmatched_profile(spark, d):
    lines = table(spark, d, "lineitem")
    pairs = lines.where(F.col("l_linestatus") == "O").select(
        F.col("l_linestatus").alias("group"), F.col("l_returnflag").alias("code")
    ).distinct()
    checks = {
        "part": ([F.col("l_partkey").cast("string")], part_texts(spark, d), ["code"]),
        "order": ([F.col("l_linestatus"), F.col("l_returnflag")], pairs, ["group", "code"]),
    }
    profile = lookup.unmatched_profile(lines, checks)
    return profile.withColumn("examples", F.array_join("examples", ","))


# ---- schemas -------------------------------------------------------------------

@query("ensure_columns", "SELECT event_id, event_type, CAST(NULL AS DOUBLE) AS score, CAST(NULL AS VARCHAR) AS note FROM events")
def ensure_columns(spark, d):
    rows = table(spark, d, "events")
    wanted = shape.T.StructType.fromDDL("event_id bigint, event_type string, score double, note string")
    return shape.pick(shape.ensure_columns(rows, wanted), wanted.names)


@query("enforce_schema", """
SELECT event_id, CAST(ts AS DATE) AS ts, CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS BIGINT) AS event_type,
  value, CAST(NULL AS DATE) AS missing FROM events""")
def enforce_schema(spark, d):
    wanted = shape.T.StructType.fromDDL(
        "event_id bigint, ts date, user_id string, event_type bigint, value double, missing date"
    )
    return shape.enforce_schema(table(spark, d, "events"), wanted)


@query("alias_fallback", """
SELECT doc_id AS id, coalesce(trim(CASE WHEN n_chars > 500 THEN source END), trim(lang)) AS label FROM documents""")
def alias_fallback(spark, d):
    rows = table(spark, d, "documents").select(
        "doc_id", F.when(F.col("n_chars") > 500, F.col("source")).alias("current"), F.col("lang").alias("legacy")
    )
    rows = shape.coalesce_columns(rows, "label", ["current", "legacy", "never"])
    return shape.rename_aliases(rows, {"doc_id": "id"})


@query("schema_diff", """
SELECT lang, count(*) AS n, 'lang,n_chars,source,text' AS extra, 'body,language' AS missing FROM documents GROUP BY 1""")
def schema_diff(spark, d):
    rows = table(spark, d, "documents")
    diff = shape.schema_diff(rows, shape.T.StructType.fromDDL("DOC_ID bigint, body string, language string"))
    return rows.groupBy("lang").agg(F.count("*").alias("n")).withColumns(
        {side: F.lit(",".join(names)) for side, names in diff.items()}
    )


@query("observed_periods", """
SELECT DISTINCT strftime(l_shipdate, '%Y%m') AS period FROM lineitem""")
def observed_periods(spark, d):
    from snapmart.sources.files import periods_in

    return periods_in(table(spark, d, "lineitem").select(dates.period_key("l_shipdate").alias("period")))


# ---- ids -----------------------------------------------------------------------

LINES = """SELECT strftime(l_shipdate, '%Y%m') AS period, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem"""
ORDERED = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"


def lines(spark, d):
    return table(spark, d, "lineitem").select(
        dates.period_key("l_shipdate").alias("period"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )


LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


@query("block_ids", f"""
SELECT ((CAST(period[1:4] AS BIGINT) - 1990) * 12 + CAST(period[5:6] AS BIGINT)) * 1000000000000
  + row_number() OVER (PARTITION BY period ORDER BY {ORDERED}) AS id, * FROM ({LINES})""")
def block_ids(spark, d):
    return ids.block_ids(lines(spark, d), "period", LINE_ORDER, "id", base_year=1990, block=10**12)


@query("row_sequence", f"""
SELECT *, lpad(CAST(row_number() OVER (PARTITION BY period ORDER BY {ORDERED}) AS VARCHAR), 8, '0') AS seq FROM ({LINES})""")
def row_sequence(spark, d):
    return ids.row_sequence(lines(spark, d), "period", LINE_ORDER, "seq")


@query("occurrence_suffix", f"""
SELECT CASE WHEN count(*) OVER (PARTITION BY key) > 1
  THEN key || '~' || lpad(CAST(row_number() OVER (PARTITION BY key ORDER BY {ORDERED}) AS VARCHAR), 4, '0') ELSE key END AS key, {ORDERED}
FROM (SELECT *, period || '-' || l_partkey AS key FROM ({LINES}))""")
def occurrence_suffix(spark, d):
    rows = lines(spark, d).withColumn("key", F.concat_ws("-", "period", "l_partkey")).drop("period")
    return ids.occurrence_suffix(rows, "key", LINE_ORDER)


@query("id_uniqueness", "SELECT 'suffixed' AS id, count(*) AS row_count, 0::BIGINT AS null_keys, 0::BIGINT AS duplicate_rows FROM lineitem")
def id_uniqueness(spark, d):
    """Keys that repeat, and keys that look like a numbered one, come out unique."""
    rows = lines(spark, d).withColumn("key", F.concat_ws("-", "period", "l_partkey")).drop("period")
    unique = ids.occurrence_suffix(rows, "key", LINE_ORDER)
    return quality.pk_report(unique, ["key"]).select(F.lit("suffixed").alias("id"), "*")


@query("natural_or_artificial_id", f"""
SELECT period || CASE WHEN kind IS NULL THEN '~' || seq ELSE kind || CAST(l_partkey AS VARCHAR) END AS id, count(*) AS n
FROM (SELECT *, lpad(CAST(row_number() OVER (PARTITION BY period ORDER BY {ORDERED}) AS VARCHAR), 8, '0') AS seq,
  CASE WHEN l_quantity > 25 THEN CAST(l_suppkey AS VARCHAR) END AS kind FROM ({LINES})) GROUP BY 1""")
def natural_or_artificial_id(spark, d):
    rows = ids.row_sequence(lines(spark, d), "period", LINE_ORDER, "seq")
    kind = F.when(F.col("l_quantity") > 25, F.col("l_suppkey"))
    key = ids.natural_or_artificial([F.col("period")], [kind, F.col("l_partkey")], F.col("seq"))
    return rows.groupBy(key.alias("id")).agg(F.count("*").alias("n"))


@query("keep_first", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1""")
def keep_first(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return ids.keep_first(rows, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


@query("dup_flags", """
SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_duplicated FROM lineitem""")
def dup_flags(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return ids.flag_duplicates(rows, ["l_orderkey", "l_linenumber"])


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS day FROM lineitem")
def distinct_rows(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", F.col("l_shipdate").cast("date").alias("day"))
    return rows.distinct().orderBy("l_suppkey", F.col("l_returnflag").asc_nulls_last(), F.col("day").asc_nulls_last())


# ---- quality -------------------------------------------------------------------

@query("pk_report", """
SELECT count(*) AS row_count, count(CASE WHEN k IS NULL THEN 1 END) AS null_keys, count(*) - count(DISTINCT coalesce(k, '?')) AS duplicate_rows
FROM (SELECT CASE WHEN l_tax > 0 THEN l_orderkey || '-' || l_linenumber END AS k FROM lineitem)""")
def pk_report(spark, d):
    key = F.when(F.col("l_tax") > 0, F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("k")
    return quality.pk_report(table(spark, d, "lineitem").select(key), ["k"])


@query("pk_report_orders", "SELECT count(*) AS row_count, count(*) - count(o_orderkey) AS null_keys, count(*) - count(DISTINCT o_orderkey) AS duplicate_rows FROM orders")
def pk_report_orders(spark, d):
    return quality.pk_report(table(spark, d, "orders"), ["o_orderkey"])


@query("grain_report", """
SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS row_count, count(CASE WHEN n > 1 THEN 1 END) AS repeated_keys,
  CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS rows_in_repeated_keys
FROM (SELECT l_returnflag, l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1""")
def grain_report(spark, d):
    return quality.grain_report(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_returnflag"])


@query("period_gate", """
SELECT strftime(l_shipdate, '%Y%m') AS period, count(*) AS n FROM lineitem GROUP BY 1""")
def period_gate(spark, d):
    """Months of keys; a row without a valid one fails the job."""
    rows = table(spark, d, "lineitem").select(dates.snapshot_key("l_shipdate", "l_suppkey").alias("key"))
    period = dates.key_period("key")
    gated = quality.require(period, dates.is_period(period), "row without a valid period")
    return rows.groupBy(gated.alias("period")).agg(F.count("*").alias("n"))


@query("invalid_periods", """
SELECT count(CASE WHEN l_quantity <= 2 THEN 1 END) AS invalid_rows FROM lineitem""")
def invalid_periods(spark, d):
    key = F.when(F.col("l_quantity") > 2, dates.period_key("l_shipdate")).otherwise("209913")
    return quality.invalid_count(table(spark, d, "lineitem"), dates.is_period(key))


@query("count_reconcile", """
WITH e AS (SELECT strftime(l_shipdate, '%Y%m') AS period, count(*) AS expected, count(CASE WHEN l_returnflag <> 'R' OR l_shipdate < '1998-01-01' THEN 1 END) AS found FROM lineitem GROUP BY 1)
SELECT period, expected, found, expected = found AS ok FROM e""")
def count_reconcile(spark, d):
    from snapmart.plans.sync import period_counts

    rows = table(spark, d, "lineitem")
    kept = rows.where((F.col("l_returnflag") != "R") | (F.col("l_shipdate") < F.lit("1998-01-01")))
    key = dates.period_key("l_shipdate")
    return quality.reconcile(period_counts(rows, key), period_counts(kept, key), "period")


@query("id_range", "SELECT o_orderstatus, count(*) AS row_count, min(o_orderkey) AS min_id, max(o_orderkey) AS max_id FROM orders GROUP BY 1")
def id_range(spark, d):
    return quality.id_range(table(spark, d, "orders"), "o_orderkey", ["o_orderstatus"])


@query("outlier_report", """
SELECT 'l_shipdate' AS "column", count(CASE WHEN l_shipdate < '1996-01-01' THEN 1 END) AS outliers FROM lineitem
UNION ALL SELECT 'l_discount', count(CASE WHEN l_discount > 0.05 THEN 1 END) FROM lineitem""")
def outlier_report(spark, d):
    lo, hi = dates.parse_month("1996-01"), dates.DATE_MAX
    flags = {
        "l_shipdate": dates.is_outlier(F.col("l_shipdate").cast("date"), lo, hi),
        "l_discount": F.col("l_discount") > 0.05,
    }
    return quality.outlier_report(table(spark, d, "lineitem"), flags)


# ---- dimensions ----------------------------------------------------------------

@query("date_dim", f"""
WITH d AS (SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem UNION SELECT CAST(o_orderdate AS DATE) FROM orders
  UNION SELECT CAST(ts AS DATE) FROM events)
SELECT date, strftime(date, '%m') AS month, strftime(date, '%Y') AS year, CAST(dayofyear(date) AS VARCHAR) AS day_of_year,
  CAST(day(date) AS VARCHAR) AS day_of_month, CAST((day(date) - 1) // 7 + 1 AS VARCHAR) AS week_of_month,
  CAST(weekofyear(date) AS VARCHAR) AS week_of_year,
  (['Segunda-feira', 'Terça-feira', 'Quarta-feira', 'Quinta-feira', 'Sexta-feira', 'Sábado', 'Domingo'])[isodow(date)] AS weekday_name, (['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho', 'Julho', 'Agosto', 'Setembro', 'Outubro', 'Novembro', 'Dezembro'])[month(date)] AS month_name,
  CAST((month(date) - 1) // 2 + 1 AS VARCHAR) AS two_month, CAST(quarter(date) AS VARCHAR) AS quarter,
  CAST((month(date) - 1) // 6 + 1 AS VARCHAR) AS half_year
FROM d WHERE date BETWEEN DATE '1910-01-01' AND DATE '2028-12-31'""")
def date_dimension(spark, d):
    frames = [
        (table(spark, d, "lineitem"), ["l_shipdate"]),
        (table(spark, d, "orders"), ["o_orderdate"]),
        (table(spark, d, "events"), ["ts"]),
    ]
    return gold.shaped(date_dim(frames), "dates")


@query("place_dim", f"""
WITH k AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS p FROM customer UNION SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') FROM supplier)
SELECT p || '0001' AS place_id, coalesce(n_name, 'Não Informado') AS place_name,
  coalesce(x.region, 'Exterior/Outros') AS region, coalesce(x.state, 'EX') AS state
FROM k LEFT JOIN nation ON lpad(CAST(n_nationkey AS VARCHAR), 2, '0') = p AND n_regionkey > 0 LEFT JOIN ({PREFIXES}) x ON x.code = p""")
def place_dimension(spark, d):
    code = lambda c: F.concat(F.lpad(F.col(c).cast("string"), 2, "0"), F.lit("0001"))
    names = table(spark, d, "nation").select(
        code("n_nationkey").alias("code"), F.when(F.col("n_regionkey") > 0, F.col("n_name")).otherwise("").alias("text")
    )
    frames = [
        (table(spark, d, "customer").select(code("c_nationkey").alias("a")), ["a"]),
        (table(spark, d, "supplier").select(code("s_nationkey").alias("a")), ["a"]),
    ]
    return place_dim(frames, names, prefixes(spark, d))
