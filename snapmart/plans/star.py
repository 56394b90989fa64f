"""The star tables as one bundle of lazy frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from snapmart.operators.shape import enforce_schema, rename_aliases
from snapmart.plans.schemas import STORED_NAMES, schema
from snapmart.sources.files import PERIOD, read_table


@dataclass(frozen=True)
class Star:
    """Places, facility versions and names, and the facts that refer to them.

    A table that a query does not use may be left out.
    """

    places: DataFrame | None = None
    units: DataFrame | None = None
    names: DataFrame | None = None
    admissions: DataFrame | None = None
    beds: DataFrame | None = None
    equipment: DataFrame | None = None
    staff: DataFrame | None = None
    licences: DataFrame | None = None


def serving_table(df: DataFrame, table: str, clean: bool = False) -> DataFrame:
    """A stored table under the names and types used here.

    ``clean`` also turns blank text into NULL, for tables written elsewhere. The
    tables written by ``plans.gold`` are clean already; left uncleaned on read,
    their text filters reach the Parquet scan. A ``period`` folder column stays,
    so that snapshot queries can prune by it.
    """
    contract = schema(table)
    if PERIOD in df.columns:
        contract = contract.add(PERIOD, "string")
    return enforce_schema(rename_aliases(df, STORED_NAMES[table]), contract, blanks_to_null=clean)


def open_star(spark: SparkSession, paths: dict[str, str], clean: bool = False) -> Star:
    """Star over stored Parquet tables, ``{table: path}``."""
    return Star(**{t: serving_table(read_table(spark, p), t, clean) for t, p in paths.items()})
