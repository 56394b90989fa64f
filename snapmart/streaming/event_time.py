"""Counts per day of a stream in event time, with a state store and a watermark.

A day is open until the watermark (the latest time seen, less the allowed delay) has
passed its end; then its state is dropped. Rows of a day that is closed go to a side
table instead of being lost, so counts and side table together are the batch count.

Each Arrow batch is counted inside its task first, so a state group, however hot,
receives one row per day, keys and Arrow batch, not the rows themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from snapmart.sources.staging import discard, stage
from snapmart.sources.versions import append
from snapmart.streaming.landing import each_batch

OPEN, CLOSED, LATE = "open", "closed", "late"
DAY_MS = 24 * 3600 * 1000
RESERVED = {"day", "n", "status", "batch", "closed", "on_time", "late", "_last", "_n"}


def event_time_counts(
    stream: DataFrame, time: str, keys: list[str], delay: str, out: str, late: str, checkpoint: str
) -> StreamingQuery:
    """Count the new files of a stream per day and keys, then stop.

    ``out`` receives the running count of each group a batch touched, and its last one when
    the day closes; ``current_counts`` takes the newest. ``late`` receives, per batch, the
    counts of rows whose day was closed before the batch. Both tables are written under
    the batch number, so a repeated batch replaces its own rows. Rows without a time are
    counted under the day NULL, which never closes. A null key is a value of its own.
    State holds the open days only. ``delay`` is an interval such as ``2 days``. The checkpoint
    keeps state, watermark and the files taken; it belongs to one ``out`` and one ``late``.
    Keys named like a column of these tables (``RESERVED``) are refused.
    """
    if RESERVED & set(keys):
        raise ValueError(f"rename these keys first: {sorted(RESERVED & set(keys))}")
    counted = ["day", *keys]
    groups = F.to_date(time).alias("day"), *keys, F.col(time).cast("timestamp").alias("_last")
    rows = stream.select(*groups)
    partial = T.StructType([*rows.schema.fields, T.StructField("_n", T.LongType())])
    partials = rows.mapInPandas(_partial_counts(counted), partial).withWatermark("_last", delay)
    result = T.StructType([*rows.schema.fields[:-1], T.StructField("n", T.LongType()), T.StructField("status", T.StringType())])
    updates = partials.groupBy(*counted).applyInPandasWithState(
        _advance(counted), result, "n long, day_end long", "update", GroupStateTimeout.EventTimeTimeout
    )

    def publish(batch: DataFrame, number: int) -> None:
        staged = stage(batch, "event_time")
        append(staged.where(F.col("status") != LATE).withColumn("batch", F.lit(number).cast("long")), out, batch=number)
        append(staged.where(F.col("status") == LATE).drop("status"), late, batch=number)
        discard(staged)

    return each_batch(updates, publish, checkpoint, "update")


def current_counts(table: DataFrame, keys: list[str]) -> DataFrame:
    """Newest count per day and keys of the table ``out``, and whether the day is closed."""
    return table.groupBy("day", *keys).agg(
        F.max("n").alias("n"), F.max(F.col("status") == CLOSED).alias("closed")
    )


def with_late(counts: DataFrame, late: DataFrame, keys: list[str]) -> DataFrame:
    """Counts on time and behind the watermark, as one row per day and keys."""
    zero = F.lit(0).cast("long")
    on_time = counts.select("day", *keys, F.col("n").alias("on_time"), zero.alias("late"))
    behind = late.select("day", *keys, zero.alias("on_time"), F.col("n").alias("late"))
    return on_time.unionByName(behind).groupBy("day", *keys).agg(
        F.sum("on_time").alias("on_time"), F.sum("late").alias("late")
    )


def _partial_counts(counted: list[str]):
    """Counts of an Arrow batch, without a time, and its latest time as a row that counts nothing.

    Spark drops rows behind the watermark before it calls a state function, but keeps those
    without a time. So the counts arrive however late they are, and the times
    only move the watermark.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            if len(rows):
                found = rows.groupby(counted, dropna=False, sort=False).size().rename("_n").reset_index()
                yield found.assign(_last=pd.NaT)[[*counted, "_last", "_n"]]
                if rows["_last"].notna().any():
                    yield rows.loc[[rows["_last"].idxmax()], [*counted, "_last"]].assign(_n=0)

    return count


def _advance(counted: list[str]):
    """The state of a day and keys: rows so far, and the end of the day in milliseconds.

    The group times out once the watermark has passed the end of its day. A group that meets rows
    at or after this point hands out its last count, and the rows as late ones.
    """

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        arrived = 0 if state.hasTimedOut else sum(int(f["_n"].sum()) for f in frames)
        if state.exists:
            n, day_end = state.get
        else:
            n, day = 0, key[0]
            day_end = None if pd.isna(day) else (pd.Timestamp(day).value // 1_000_000) + DAY_MS
        if not arrived and not state.exists:
            return
        if day_end is None or day_end > watermark:
            state.update((n + arrived, day_end))
            if day_end is not None:
                state.setTimeoutTimestamp(day_end)
            if arrived:
                yield _row(key, n + arrived, OPEN)
            return
        if state.exists:
            state.remove()
            yield _row(key, n, CLOSED)
        if arrived:
            yield _row(key, arrived, LATE)

    def _row(key: tuple, n: int, status: str) -> pd.DataFrame:
        return pd.DataFrame([(*key, n, status)], columns=[*counted, "n", "status"])

    return advance
