"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.sources.staging import stage

#: Rows of one Arrow batch. Texts of a few kilobytes make batches of some megabytes.
BATCH_ROWS = "2000"


def prepared(spark: SparkSession) -> SparkSession:
    """The settings the corpus operators rely on, set on the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like those wanted that no column of the frame has (without regard to case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def batches(column: str, rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of rows of a few megabytes of text, with their text column (null: empty)."""
    from snapmart.llm.textkernel import plain, slices

    for batch in rows:
        texts = plain(batch.column(batch.schema.get_field_index(column)))
        for i, j in slices(texts):
            yield batch.slice(i, j - i), texts.slice(i, j - i)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write and reread in the shared folder: lineage ends, a lost executor costs a reread."""
    return stage(df, label)


def utf8(c: Column | str) -> Column:
    """The UTF-8 bytes of a text, null as none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit("")).cast("binary")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
