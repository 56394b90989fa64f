"""Star tables over the test tables, as frames and as SQL.

A line item plays an admission, a bed line and an equipment line; a supplier in a
shipping month plays a facility version; nations and regions are the places. Date
columns stay bare, so that the queries' date bounds reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.core import table
from snapmart.functions.dates import period_key
from snapmart.plans.star import Star

NEEDS = {  # star table -> test tables joined to lineitem for it
    "admissions": ("orders", "part", "supplier"),
    "beds": ("part", "supplier"),
    "equipment": ("part", "supplier"),
    "staff": ("orders", "supplier"),
    "licences": (),
}
_KEYS = {
    "orders": ("l_orderkey", "o_orderkey"),
    "part": ("l_partkey", "p_partkey"),
    "supplier": ("l_suppkey", "s_suppkey"),
}


def star(spark: SparkSession, sf_dir: str, *tables: str, lean: tuple[str, ...] | None = None) -> Star:
    """The named star tables. ``lean`` limits what ``admissions`` is joined to."""
    t = lambda name: table(spark, sf_dir, name)
    makers = {
        "places": lambda: _places(t("nation"), t("region")),
        "units": lambda: _units(t("lineitem"), t("supplier")),
        "names": lambda: _names(t("supplier")),
        "admissions": lambda: _admissions(_lines(t, lean or NEEDS["admissions"])),
        "beds": lambda: _beds(_lines(t, NEEDS["beds"])),
        "equipment": lambda: _equipment(_lines(t, NEEDS["equipment"])),
        "staff": lambda: _staff(_lines(t, NEEDS["staff"])),
        "licences": lambda: _licences(_lines(t, ())),
    }
    return Star(**{name: makers[name]() for name in tables})


def _lines(t, others: tuple[str, ...]) -> DataFrame:
    lines = t("lineitem")
    for other in others:
        left, right = _KEYS[other]
        lines = lines.join(t(other), F.col(left) == F.col(right))
    return lines


_MONTH = lambda: F.trunc("l_shipdate", "MM")
_SUPPLIER = lambda: F.lpad(F.col("l_suppkey").cast("string"), 7, "0")
_VERSION = lambda: F.concat(period_key("l_shipdate"), _SUPPLIER()).alias("unit_version")
_PLACE = lambda: F.col("s_nationkey").cast("string")


def _places(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("place_id"),
        F.col("n_name").alias("place_name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("state"),
    )


def _units(lines: DataFrame, supplier: DataFrame) -> DataFrame:
    months = lines.select("l_suppkey", _MONTH().alias("period_date")).distinct()
    balance = F.col("s_acctbal")
    kind = F.when(balance < 0, "debt").when(balance < 3000, "small").when(balance < 6000, "medium")
    return months.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(period_key("period_date"), _SUPPLIER()).alias("unit_version"),
        _SUPPLIER().alias("unit_id"),
        "period_date",
        kind.otherwise("large").alias("unit_kind"),
        _PLACE().alias("place_id"),
    )


def _names(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.lpad(F.col("s_suppkey").cast("string"), 7, "0").alias("unit_id"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("trade_name"),
        F.when(F.col("s_acctbal") < -500, F.concat(F.lit("Legal "), F.col("s_name"))).alias("legal_name"),
    )


def _admissions(lines: DataFrame) -> DataFrame:
    wanted = {
        "admission_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "cost": F.col("l_extendedprice"),
        "sex": F.col("l_returnflag"),
        "icu_days": F.col("l_discount"),
        "admission_type": F.col("l_linestatus"),
        "period_date": _MONTH(),
        "exit_date": F.col("l_shipdate"),
        "unit_version": _VERSION(),
    }
    if "o_orderkey" in lines.columns:
        wanted |= {"race": F.col("o_orderpriority"), "entry_date": F.col("o_orderdate")}
    if "p_partkey" in lines.columns:
        wanted |= {
            "diagnosis": F.col("p_brand"),
            "ethnicity": F.concat_ws(" ", "p_type", "p_brand"),
            "age": F.col("p_size") * F.lit(2.0),
        }
    if "s_suppkey" in lines.columns:
        wanted |= {"care_place": _PLACE()}
    return lines.select(*[c.alias(n) for n, c in wanted.items()])


def _in_use():
    return F.floor(F.col("l_quantity") * (1 - F.col("l_discount"))).cast("double")


def _beds(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("l_shipdate").alias("period_date"),
        F.floor(F.col("l_quantity") / 2).cast("double").alias("contracted"),
        _in_use().alias("public_beds"),
        F.col("l_quantity").alias("existing"),
        F.col("p_type").alias("bed_kind"),
        _PLACE().alias("place_id"),
        _VERSION(),
    )


def _equipment(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("l_shipdate").alias("period_date"),
        F.col("l_quantity").alias("quantity"),
        _in_use().alias("in_use"),
        F.when(F.col("l_linestatus") == "O", " s ").otherwise("N").alias("public_flag"),
        _PLACE().alias("place_id"),
        _VERSION(),
        F.col("p_type").alias("equipment_kind"),
        F.col("p_brand").alias("equipment_code"),
    )


def _staff(lines: DataFrame) -> DataFrame:
    status = F.col("o_orderstatus")
    return lines.select(
        F.col("l_shipdate").alias("period_date"),
        F.col("l_quantity").alias("hours"),
        F.when(status == "O", "Sim").when(status == "F", "N").alias("public_link"),
        F.col("o_orderpriority").alias("occupation"),
        _PLACE().alias("place_id"),
        _VERSION(),
        F.col("o_custkey").cast("string").alias("person_id"),
    )


def _licences(lines: DataFrame) -> DataFrame:
    held = lines.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 45))
    return held.select(
        F.col("l_orderkey").cast("string").alias("licence"),
        F.col("l_shipdate").cast("date").alias("issued_on"),
        _VERSION(),
    )


# ---- the same tables as SQL ----------------------------------------------------------

_V = "strftime(l_shipdate, '%Y%m') || lpad(CAST(l_suppkey AS VARCHAR), 7, '0')"
_M = "CAST(date_trunc('month', l_shipdate) AS DATE)"
_P = "CAST(s_nationkey AS VARCHAR)"
_U = "CAST(floor(l_quantity * (1 - l_discount)) AS DOUBLE)"

PLACES = """places AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS place_id, n_name AS place_name, r_name AS region, n_name AS state
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
UNITS = f"""units AS (
  SELECT DISTINCT {_V} AS unit_version, lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS unit_id,
    {_M} AS period_date,
    CASE WHEN s_acctbal < 0 THEN 'debt' WHEN s_acctbal < 3000 THEN 'small'
         WHEN s_acctbal < 6000 THEN 'medium' ELSE 'large' END AS unit_kind,
    {_P} AS place_id
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
NAMES = """names AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS unit_id,
    CASE WHEN s_acctbal >= 0 THEN s_name END AS trade_name,
    CASE WHEN s_acctbal < -500 THEN 'Legal ' || s_name END AS legal_name
  FROM supplier)"""
ADMISSIONS = f"""admissions AS (
  SELECT p_brand AS diagnosis, l_extendedprice AS cost, p_size * 2.0 AS age, l_returnflag AS sex,
    l_discount AS icu_days, l_linestatus AS admission_type, o_orderpriority AS race,
    p_type || ' ' || p_brand AS ethnicity, {_M} AS period_date,
    CAST(o_orderdate AS DATE) AS entry_date, CAST(l_shipdate AS DATE) AS exit_date,
    {_P} AS care_place, {_V} AS unit_version
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey)"""
BEDS = f"""beds AS (
  SELECT {_M} AS period_date, CAST(floor(l_quantity / 2) AS DOUBLE) AS contracted, {_U} AS public_beds,
    l_quantity AS existing, p_type AS bed_kind, {_P} AS place_id, {_V} AS unit_version
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""
EQUIPMENT = f"""equipment AS (
  SELECT {_M} AS period_date, l_quantity AS quantity, {_U} AS in_use,
    CASE WHEN l_linestatus = 'O' THEN ' s ' ELSE 'N' END AS public_flag,
    {_P} AS place_id, {_V} AS unit_version, p_type AS equipment_kind, p_brand AS equipment_code
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""
STAFF = f"""staff AS (
  SELECT {_M} AS period_date, l_quantity AS hours,
    CASE o_orderstatus WHEN 'O' THEN 'Sim' WHEN 'F' THEN 'N' END AS public_link,
    o_orderpriority AS occupation, {_P} AS place_id, {_V} AS unit_version,
    CAST(o_custkey AS VARCHAR) AS person_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)"""
LICENCES = f"""licences AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS licence, CAST(l_shipdate AS DATE) AS issued_on, {_V} AS unit_version
  FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45)"""
YES = "coalesce(upper(trim({})) IN ('S','SIM','1','Y','YES','TRUE'), false)"
