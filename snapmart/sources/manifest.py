"""What should be landed, what is landed, and which file serves which target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def landing_manifest(
    months: DataFrame, states: Column, sources: Column, period: str = "period"
) -> DataFrame:
    """One row per month, state and source with the name of the file to land.

    ``states`` is an array of texts and ``sources`` an array of structs
    (prefix, base); both are short lists carried as values, not joined.
    """
    rows = months.select(period, F.explode(states).alias("state")).select(
        period, "state", F.explode(sources).alias("s")
    )
    return rows.select(
        F.col(period).alias("period"),
        "state",
        F.col("s.prefix").alias("prefix"),
        F.format_string("%s_%s_%s.parquet", F.col("s.base"), F.lower("state"), F.col(period)).alias("target"),
    )


def source_list(sources: dict[str, str]) -> Column:
    """``{prefix: base name}`` as the array ``landing_manifest`` takes."""
    return F.array(
        *[F.struct(F.lit(p).alias("prefix"), F.lit(b).alias("base")) for p, b in sources.items()]
    )


def text_list(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def not_landed(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Targets without a landed file (``landed`` has a ``name`` column)."""
    return manifest.join(landed.select(F.col("name").alias("target")), "target", "left_anti")


def choose_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """The file to read per target: the first by name that starts with the
    prefix, among the (period, state, name) files on offer."""
    offers = files.select(
        F.col("period").alias("_p"), F.col("state").alias("_s"), F.col("name").alias("_name")
    )
    matched = manifest.join(
        offers,
        (F.col("period") == F.col("_p"))
        & (F.col("state") == F.col("_s"))
        & F.col("_name").startswith(F.col("prefix")),
    )
    return matched.groupBy("period", "state", "prefix", "target").agg(F.min("_name").alias("file"))
