"""Schemas and columns: add, select, rename, cast, compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from snapmart.functions.codes import blank_to_null, header_slug, number_text


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that are missing, as typed NULLs."""
    have = {c.lower() for c in df.columns}
    return df.withColumns(
        {
            f.name: F.lit(None).cast(f.dataType)
            for f in schema.fields
            if f.name.lower() not in have
        }
    )


def ensure_text_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Add missing columns as NULL text."""
    return ensure_columns(df, T.StructType([T.StructField(n, T.StringType()) for n in names]))


def raw_text(df: DataFrame, names: list[str], keep: list[str] = ()) -> DataFrame:
    """The wanted raw columns as text, NULL where a file lacks them.

    Codes read as floating point are written out in digits: 12345678.0 becomes
    ``12345678``, not ``1.2345678E7``.
    """
    df = ensure_text_columns(df, names)
    types = {f.name.lower(): f.dataType for f in df.schema.fields}

    def text(name: str) -> Column:
        c = F.col(name)
        if not isinstance(types[name.lower()], T.FractionalType) or isinstance(
            types[name.lower()], T.DecimalType
        ):
            return c.cast("string")
        return number_text(c)

    return df.select(*[text(n).alias(n) for n in names], *keep)


def pick(df: DataFrame, names: list[str]) -> DataFrame:
    """Select in contract order."""
    return df.select(*names)


def pick_present(df: DataFrame, names: list[str]) -> DataFrame:
    """Select those of the wanted columns that exist."""
    have = {c.lower() for c in df.columns}
    return df.select(*[n for n in names if n.lower() in have])


def enforce_schema(
    df: DataFrame, schema: T.StructType, blanks_to_null: bool = False
) -> DataFrame:
    """Cast every column to the contract; values that do not fit become NULL.

    Columns the frame lacks come out as NULL, columns the contract lacks are
    dropped. ``blanks_to_null`` also empties blank text, for the serving layer.
    """
    df = ensure_columns(df, schema)

    def fitted(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return blank_to_null(c) if blanks_to_null else c.cast("string")
        return c.try_cast(field.dataType)

    return df.select(*[fitted(f).alias(f.name) for f in schema.fields])


def rename_aliases(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Rename legacy columns; an alias whose target already exists is left alone."""
    have = {c.lower() for c in df.columns}
    return df.withColumnsRenamed(
        {old: new for old, new in aliases.items() if old.lower() in have and new.lower() not in have}
    )


def coalesce_columns(df: DataFrame, target: str, candidates: list[str]) -> DataFrame:
    """``target`` = first non-null of those candidate columns that exist."""
    exact = set(df.columns)
    present = [c for c in candidates if c in exact]
    value = (
        F.coalesce(*[F.trim(F.col(c).cast("string")) for c in present])
        if present
        else F.lit(None).cast("string")
    )
    rest = [c for c in df.columns if c not in present and c != target]
    return df.select(*rest, value.alias(target))


def slug_headers(df: DataFrame) -> DataFrame:
    """Rename all columns to identifiers (see ``header_slug``)."""
    return df.toDF(*[header_slug(c) for c in df.columns])


def schema_diff(df: DataFrame, schema: T.StructType) -> dict[str, list[str]]:
    """Columns only in the frame and only in the contract, ignoring case."""
    have = {c.lower() for c in df.columns}
    want = {n.lower() for n in schema.names}
    return {"extra": sorted(have - want), "missing": sorted(want - have)}


def assert_schema(df: DataFrame, schema: T.StructType, table: str) -> None:
    diff = schema_diff(df, schema)
    if diff["extra"] or diff["missing"]:
        raise ValueError(f"{table}: unexpected columns {diff['extra']}, missing {diff['missing']}")
