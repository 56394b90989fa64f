"""Structured Streaming forms of landing and refreshing.

The checkpoint of a file stream remembers which files were taken, so each file is
landed exactly once without listing what is already there. A batch is published as one version
of its table, under its number; repeated, it takes the place of its own rows. Small
parts are merged by size as they gather (``versions.compact``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from snapmart.plans.sync import fingerprint
from snapmart.sources.files import PERIOD, scan_periods, write_periods
from snapmart.sources.staging import discard, stage
from snapmart.sources.versions import append, load_version, read_parts, table_exists


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files below a folder, with an explicit schema."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def ingest_available(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    period: Column | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Land every file not landed yet, then stop. Files land once, also after a
    restart. With ``period`` the landed table is stored by month. Read it with ``read_stored``."""
    rows = file_stream(spark, path, schema, files_per_batch)
    stored = rows if period is None else rows.withColumn(PERIOD, period)
    return each_batch(stored, lambda batch, number: append(batch, out, [] if period is None else [PERIOD], number), checkpoint)


def each_batch(
    stream: DataFrame, land: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Hand what is new to ``land``, batch by batch under its number, then stop."""
    writer = stream.writeStream.foreachBatch(land).outputMode(mode).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def refresh_changed_periods(
    stream: DataFrame,
    landed: str,
    target: str,
    build: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    note: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Land late rows and rebuild only the months they touch.

    A batch is one version of the landed table, and opens the months it touches only. These
    are then rebuilt from everything landed for them and replaced
    in the target, as one version of it. ``note`` receives their fingerprints and the batch number.
    """
    spark = stream.sparkSession

    def batch(rows: DataFrame, number: int) -> None:
        before = load_version(spark, landed)
        repeated = {p.period for p in before.rows() if p.batch == number} if before else set()
        append(rows, landed, [PERIOD], number)
        version = load_version(spark, landed)
        arrived = {p.period for p in version.rows() if p.batch == number} if version else set()
        touched = sorted(arrived | repeated)
        if not touched:
            return
        rebuilt = build(read_parts(spark, landed, version.rows(touched), version.schema))
        write_periods(rebuilt, target, cleared=touched)
        if note:
            note(fingerprint(scan_periods(spark, target, touched)), number)

    return each_batch(stream, batch, checkpoint)


def day_counts(stream: DataFrame, time: str, keys: list[str], out: str, checkpoint: str) -> StreamingQuery:
    """Counts per day and keys, kept in a table stored by month.

    A row counts however late it comes: there is no watermark and no state. The
    table holds, per day and keys, the sum of the batches before and the counts of
    the last batch, told apart by ``batch``; a repeated batch takes the place of its
    own counts. Only the months a batch touches are read and written. Rows without a
    time are kept under the day NULL. Read the table with ``read_stored`` and ``day_table``.
    """
    spark = stream.sparkSession

    def publish(rows: DataFrame, number: int) -> None:
        day = F.to_date(time)
        counts = rows.groupBy(day.alias("day"), *keys).agg(F.count("*").alias("n"))
        month = F.coalesce(F.date_format("day", "yyyyMM"), F.lit("000000"))
        counts = stage(counts.withColumns({"batch": F.lit(number).cast("long"), PERIOD: month}), "counts")
        touched = sorted(r[0] for r in counts.select(PERIOD).distinct().collect())
        if touched:
            merged = counts
            if table_exists(spark, out):
                before = scan_periods(spark, out, touched).where(F.col("batch") < number)
                before = before.groupBy("day", *keys, PERIOD).agg(F.sum("n").alias("n"), F.max("batch").alias("batch"))
                merged = counts.unionByName(before)
            write_periods(merged, out)
        discard(counts)

    return each_batch(stream, publish, checkpoint)


def day_table(table: DataFrame, keys: list[str]) -> DataFrame:
    """One row per day and keys of the table ``day_counts`` keeps."""
    return table.groupBy("day", *keys).agg(F.sum("n").alias("n"))


def month_counts(days: DataFrame, keys: list[str]) -> DataFrame:
    """Monthly report over the table ``day_counts`` keeps."""
    return days.groupBy(F.date_format("day", "yyyy-MM").alias("month"), *keys).agg(F.sum("n").alias("n"))
