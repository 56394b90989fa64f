"""Tables stored in buckets of a key, joined and grouped by it without a shuffle.

A bucket is read by one task. Rows of a key that holds more than the mean of a bucket, and rows
without a key, therefore stay outside the buckets, in ordinary files that any number of tasks
read. There are fewer such hot keys than buckets, so their list may be broadcast
however large the table is.

A table is written once, to a new folder; its description is written last, so a table
whose writer died cannot be opened.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapmart.sources.staging import discard, path_exists, read_text, stage, write_text

_DESCRIPTION = "_buckets.json"


@dataclass(frozen=True)
class Bucketed:
    """A table in two disjoint parts; no key has rows in both."""

    key: str
    buckets: int
    spread: DataFrame
    hot: DataFrame
    hot_keys: DataFrame
    n_hot: int

    def rows(self) -> DataFrame:
        return self.spread.unionByName(self.hot)

    def each(self, change: Callable[[DataFrame], DataFrame]) -> Bucketed:
        """Apply a filter, a projection or an aggregate by the key, alone or with other columns, to both parts.

        The key column must stay. An aggregate of the buckets needs no shuffle; the hot rows are reduced inside
        their tasks first.
        """
        return replace(self, spread=change(self.spread), hot=change(self.hot))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Store a frame in buckets of ``key``, one file a bucket, below a new folder.

    The frame is evaluated once. Give all tables that are to meet the same number of buckets,
    such that a bucket of the largest fits into the memory of a task.
    """
    spark = df.sparkSession
    if buckets < 1:
        raise ValueError("a table needs at least one bucket")
    if {"_key", "_hot"} & set(df.columns):
        raise ValueError("rename the columns _key and _hot first")
    if path_exists(spark, path):
        raise FileExistsError(path)
    staged = stage(df, "buckets")
    counts = stage(staged.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")), "key_counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot_keys = counts.where(F.col("_n") * buckets > total).select("_key", F.lit(True).alias("_hot"))
    hot_keys.coalesce(1).write.parquet(f"{path}/hot_keys")
    hot_keys = spark.read.schema(hot_keys.schema).parquet(f"{path}/hot_keys")
    n_hot = hot_keys.count()

    if n_hot:
        marked = staged.join(F.broadcast(hot_keys), F.col(key) == F.col("_key"), "left")
    else:
        marked = staged.withColumns({"_key": F.col(key), "_hot": F.lit(None).cast("boolean")})
    apart = F.col("_hot").isNotNull() | F.col(key).isNull()
    marked.where(apart).drop("_key", "_hot").write.parquet(f"{path}/hot")
    name = f"buckets_{uuid.uuid4().hex}"
    spread = marked.where(~apart).drop("_key", "_hot").repartition(buckets, key)
    spread.write.format("parquet").bucketBy(buckets, key).option("path", f"{path}/spread").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files stay
    about = {"key": key, "buckets": buckets, "hot_keys": n_hot, "schema": json.loads(df.schema.json())}
    write_text(spark, f"{path}/{_DESCRIPTION}", json.dumps(about))
    discard(counts)
    discard(staged)


def open_bucketed(spark: SparkSession, path: str) -> Bucketed:
    """A stored table with its buckets known to the optimiser; the session needs no catalog."""
    about = json.loads(read_text(spark, f"{path}/{_DESCRIPTION}"))
    schema, key = T.StructType.fromJson(about["schema"]), about["key"]
    name = f"buckets_{uuid.uuid4().hex}"
    quoted = key.replace("`", "``")
    place = f"{path}/spread".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet "
        f"CLUSTERED BY (`{quoted}`) INTO {about['buckets']} BUCKETS LOCATION '{place}'"
    )
    spread = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    hot = spark.read.schema(schema).parquet(f"{path}/hot")
    hot_keys = spark.read.schema(T.StructType([T.StructField("_key", schema[key].dataType), T.StructField("_hot", T.BooleanType())]))
    return Bucketed(key, about["buckets"], spread, hot, hot_keys.parquet(f"{path}/hot_keys").select("_key"), about["hot_keys"])


def join_bucketed(left: Bucketed, right: Bucketed, how: str = "inner") -> DataFrame:
    """Join two tables by their common key: inner, left, left_semi or left_anti.

    Buckets meet buckets without a shuffle. Hot rows of either side meet the rows of
    their keys by an ordinary join, whose smaller side is what the other has for these few
    keys. Every row of the left side takes part in exactly one of the joins.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"no join of buckets: {how}")
    if (left.key, left.buckets) != (right.key, right.buckets):
        raise ValueError(f"{left.key} in {left.buckets} buckets does not meet {right.key} in {right.buckets}")
    key = left.key
    spread = left.spread
    parts = []
    if right.n_hot:
        parts.append(_only(spread, key, right.hot_keys, "left_semi").join(right.hot, key, how))
        spread = _only(spread, key, right.hot_keys, "left_anti")
    of_hot = _only(right.rows(), key, left.hot_keys, "left_semi") if left.n_hot else right.rows().limit(0)
    parts.append(left.hot.join(of_hot, key, how))
    return reduce(DataFrame.unionByName, [spread.join(right.spread, key, how), *parts])


def _only(df: DataFrame, key: str, keys: DataFrame, how: str) -> DataFrame:
    """Rows with (or without) one of the hot keys, fewer than the buckets."""
    return df.join(F.broadcast(keys), F.col(key) == F.col("_key"), how)
