"""Parquet in, Parquet out: period scans, inventories, period writes."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapmart.functions.dates import is_period
from snapmart.operators.shape import enforce_schema, pick_present
from snapmart.sources.schema_classes import scan_files
from snapmart.sources.staging import child_names
from snapmart.sources.versions import append, load_version, read_parts, read_stored, replace_parts, table_exists

PERIOD = "period"


# ---- reading ------------------------------------------------------------------

def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A stored table, or any Parquet files; of ``columns``, those that exist."""
    df = read_stored(spark, path)
    return df if columns is None else pick_present(df, columns)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table with a known schema, empty when nothing was written yet."""
    if not table_exists(spark, path):
        return empty(spark, schema)
    if load_version(spark, path):
        return read_stored(spark, path).select(*schema.names)
    return spark.read.schema(schema).parquet(path)


def scan_periods(
    spark: SparkSession,
    root: str,
    periods: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A table or dataset by ``period=YYYYMM``, of the given periods or whole.

    A stored table is read under its own schema. Of folders that others filled,
    the schema is that of the contract if one is given, and else that of the files: a
    column that only some states deliver is NULL for the others, and one whose type
    differs between files is brought to a common one (``schema_classes``). Either way
    only the folders of the periods asked for are listed and opened.
    """
    version = load_version(spark, root)
    if version:
        shape = _with_period(schema) if schema else version.schema
        return read_parts(spark, root, version.rows(periods), shape)
    if periods is None:
        return spark.read.schema(schema).parquet(root) if schema else scan_files(spark, [root], root)
    present = set(child_names(spark, root))
    folders = [f"{root}/{PERIOD}={p}" for p in sorted(set(periods)) if f"{PERIOD}={p}" in present]
    if folders:
        return spark.read.schema(schema).option("basePath", root).parquet(*folders) if schema else scan_files(spark, folders, root)
    return empty(spark, _with_period(schema)) if schema else scan_files(spark, [root], root).where(F.lit(False))


def _with_period(schema: T.StructType) -> T.StructType:
    return schema if PERIOD in schema.names else T.StructType([*schema.fields, T.StructField(PERIOD, T.StringType())])


def scan_named_files(
    spark: SparkSession,
    root: str,
    prefix: str,
    periods: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Flat files ``<prefix>_<state>_<YYYYMM>.parquet`` of the given periods, with
    ``period`` and ``state`` taken from the name. No such file: empty.

    The name list prunes, so months not asked for are never opened. Without a schema, columns
    may differ between the files, in their types too (``schema_classes``).
    """
    shape = rf"{re.escape(prefix)}_([^/]+)_([0-9]{{6}})\.parquet"
    names = [
        n
        for n in child_names(spark, root)
        if (m := re.fullmatch(shape, n)) and (periods is None or m.group(2) in periods)
    ]
    if not names:
        base = schema or T.StructType()
        return empty(spark, T.StructType(base.fields + _name_fields()))
    path = F.col("_metadata.file_path")
    named = {PERIOD: F.regexp_extract(path, shape, 2), "state": F.upper(F.regexp_extract(path, shape, 1))}
    files = [f"{root}/{n}" for n in names]
    return spark.read.schema(schema).parquet(*files).withColumns(named) if schema else scan_files(spark, files, more=named)


def discover_periods(spark: SparkSession, root: str) -> list[str]:
    """The valid periods of a table or dataset, sorted; error when none."""
    found = stored_periods(spark, root)
    valid = [p for p in found if _valid_period(p)]
    if not valid:
        raise ValueError(f"no {PERIOD}=YYYYMM folder below {root}")
    return sorted(valid)


def stored_periods(spark: SparkSession, root: str) -> list[str]:
    """The periods of a table or dataset, from its newest version or its folders."""
    version = load_version(spark, root)
    if version:
        return version.periods()
    return sorted(n.split("=", 1)[1] for n in child_names(spark, root) if n.startswith(f"{PERIOD}="))


def periods_in(df: DataFrame, period: str = PERIOD) -> DataFrame:
    """The valid periods that occur in a column."""
    return df.select(period).where(is_period(period)).distinct()


def source_inventory(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """(name, path, size, modified, tag) per live file of a table, or per file below a folder, contents unread.

    Files of several folders may share a name; the path is that of ``_metadata.file_path``.
    """
    version = load_version(spark, path)
    paths = [f"{path}/{p.folder}" for p in version.rows()] if version else [path]
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(paths)
        .select("path", "length", "modificationTime", F.col("_metadata.file_path").alias("_found"))
    )
    tag = F.sha2(
        F.concat_ws("|", "path", "length", F.unix_micros("modificationTime").cast("string")), 256
    )
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("_found").alias("path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
        tag.alias("tag"),
    )


# ---- writing -------------------------------------------------------------------

def write_periods(
    df: DataFrame,
    path: str,
    period: str = PERIOD,
    cleared: list[str] = (),
    check: Callable[[DataFrame], None] | None = None,
    gathered: bool = False,
) -> None:
    """Replace the periods present in the frame; an empty frame changes nothing.

    The months are written beside the live ones, shown to ``check``, and published as one
    version (``versions``): a write or check that fails, or a driver that dies, leaves the table
    as it was. Periods listed in ``cleared`` go even if the frame has no row for them.
    ``gathered`` says that the rows of a month lie together already, see ``Write.add``.
    """
    named = df.withColumnRenamed(period, PERIOD)
    data = named.select(*(c for c in named.columns if c != PERIOD), PERIOD)
    gone = set(cleared)
    replace_parts(data, path, [PERIOD], lambda old, new: old.period in gone or any(p.period == old.period for p in new), check, gathered=gathered)


def write_table(
    df: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Replace a whole table, under a fixed schema when one is given.

    Written beside the old one, shown to ``check``, then published: a failure on the
    way leaves the old table. The frame may read the table it replaces.
    """
    shaped = df if schema is None else enforce_schema(df, schema)
    replace_parts(shaped, path, [], lambda old, new: True, check)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a table; files of many small additions are merged as they gather."""
    append(df, path)


def verify_rows(written: DataFrame, expected_rows: int, schema: T.StructType, name: str) -> None:
    """Written rows and column order must match the contract."""
    names = [c for c in written.columns if c in schema.names or c != PERIOD]
    if names != schema.names:
        raise ValueError(f"{name}: columns {names}, expected {schema.names}")
    rows = written.count()
    if rows != expected_rows:
        raise ValueError(f"{name}: {rows} rows written, expected {expected_rows}")


def _valid_period(p: str) -> bool:
    return bool(re.fullmatch(r"[0-9]{6}", p)) and int(p[:4]) >= 1900 and 1 <= int(p[4:]) <= 12


def _name_fields() -> list[T.StructField]:
    return [T.StructField(PERIOD, T.StringType()), T.StructField("state", T.StringType())]
