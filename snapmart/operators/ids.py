"""Identifiers: month-block ids, sequences, occurrence numbers, de-duplication.

Numbering rows inside a month with a plain window would put the month into one
task. Instead the rows are range-partitioned by the full order, staged once, and
numbered by *position in partition + rows in earlier partitions*:

* one range shuffle, whatever the size of a group: a month, or a key that repeats
  in a third of all rows, spans as many partitions as it needs. The staged table is kept in
  buckets of the partition number, so what is counted inside a partition is not shuffled again;
* rows equal in every column are told apart by the input partition they came from,
  so a repeated row is split too, in pieces no larger than an input partition; a
  re-run task gives its rows the same place;
* what is broadcast is one row per partition and group border, so its size is
  bounded by the partition count, not by the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapmart.functions.codes import normalise_code, zero_fill
from snapmart.functions.hashing import row_hash
from snapmart.operators.aggregate import latest_per_key
from snapmart.operators.quality import require
from snapmart.sources.staging import discard, stage, stage_grouped

# Fixed value: start year of the id blocks.
BASE_YEAR = 2000
# Ids of a month. They are 64-bit, so a block is larger than any month; the ids of
# existing tables may need a smaller one (``SMALL_BLOCK``, a fixed value).
BLOCK_SIZE = 10**12
SMALL_BLOCK = 10_000_000
# Stands between a key and a number made up for it. A key must not contain it.
SEPARATOR = "~"

_PARTITION_SHIFT = 33  # monotonically_increasing_id: partition number, then row
_LOCAL = ["_pos", "_pid"]


def stage_in_order(df: DataFrame, order_by: list[str], keep: list[str] | None = None, once: bool = False) -> DataFrame:
    """The rows in one global order, with their place in it (``_pid``, ``_pos``).

    Order: ``order_by`` ascending, NULLs last, then a hash of the whole row, so
    only rows equal throughout are interchangeable. ``keep`` names the columns that
    are staged, all by default. ``once`` stages the rows before the shuffle too, for
    rows that are dear to make and small to write.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by] + [F.col("_hash"), F.col("_tie")]
    hashed = df.withColumns({"_hash": row_hash(df.columns), "_tie": F.spark_partition_id()})
    # The range shuffle reads its input twice, for the borders and for the rows: what made it runs once.
    read = stage(hashed, "unordered") if once else hashed
    ranged = (
        read.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_pos"), _PARTITION_SHIFT))
    )
    ordered = stage_grouped(ranged.select(*(keep or df.columns), *_LOCAL), "ordered", "_pid")
    if once:
        discard(read)
    return ordered


def add_position(ordered: DataFrame, keys: list[str], name: str) -> DataFrame:
    """1-based position within each of a *few* groups (months), any group size.

    ``keys`` leads the staged order. The joined side has at most one row per
    partition plus one per group and is broadcast, or else Spark, which guesses its size
    from that of the rows, shuffles them all for the join and once more for what follows.
    """
    blocks = ordered.groupBy(*keys, "_pid").agg(
        F.min("_pos").alias("_first"), F.count("*").alias("_n")
    )
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    joined = _join_same(ordered, F.broadcast(offsets), [*keys, "_pid"])
    return joined.withColumn(
        name, F.col("_pos") - F.col("_first") + F.col("_before") + 1
    ).drop("_first", "_before")


def add_occurrence(ordered: DataFrame, keys: list[str], name: str, total: str) -> DataFrame:
    """1-based number and group size for *many* groups of any size."""
    return scan_groups(ordered, keys, name, total)


def scan_groups(ordered: DataFrame, keys: list[str], name: str, total: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """Number, group size and running sums for *many* groups of any size.

    ``keys`` leads the staged order, so a group lies in neighbouring partitions. Each
    partition numbers and adds up its own rows. Of its first and its last group it hands on
    the totals; these, at most two rows a partition, are carried over the borders and
    broadcast back. ``sums`` names the running sums, the row's own value included. The
    staged table is read twice and not shuffled.
    """
    sums = sums or {}
    here = Window.partitionBy("_pid", *keys)
    so_far = here.orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ordered.withColumns(
        {
            "_local": F.row_number().over(here.orderBy("_pos")),
            "_count": F.count("*").over(here),
            **{f"_sum_{n}": F.sum(c).over(so_far) for n, c in sums.items()},
        }
    )
    carried = ["_count", *(f"_sum_{n}" for n in sums)]
    whole = F.struct(*keys, *carried)
    ends = (
        local.where(F.col("_local") == F.col("_count"))  # the last row of a group has its totals
        .groupBy("_pid")
        .agg(F.min_by(whole, "_pos").alias("_first"), F.max_by(whole, "_pos").alias("_last"))
        .select("_pid", F.explode(F.array_distinct(F.array("_first", "_last"))).alias("_end"))
        .select("_pid", "_end.*")
    )
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    border = ends.select(
        "_pid",
        *keys,
        *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before{c}") for c in carried),
        F.sum("_count").over(group).alias("_all"),
    )
    joined = _join_same(local, F.broadcast(border), [*keys, "_pid"], "left")
    numbered = joined.withColumns(
        {
            name: F.col("_local") + F.coalesce("_before_count", F.lit(0)),
            total: F.coalesce("_all", "_count"),
            **{n: F.col(f"_sum_{n}") + F.coalesce(f"_before_sum_{n}", F.lit(0)) for n in sums},
        }
    )
    return numbered.drop("_local", "_all", *carried, *(f"_before{c}" for c in carried))


def drop_place(df: DataFrame) -> DataFrame:
    return df.drop(*_LOCAL)


def block_start(period: Column, base_year: int = BASE_YEAR, block: int = BLOCK_SIZE) -> Column:
    """First number of the id block of a ``YYYYMM`` period."""
    year = F.substring(period, 1, 4).cast("bigint")
    month = F.substring(period, 5, 2).cast("bigint")
    start = ((year - base_year) * 12 + month) * F.lit(block).cast("bigint")
    return require(start, year >= base_year, f"period before the base year {base_year}")


def block_ids(
    df: DataFrame,
    period: str,
    order_by: list[str],
    name: str,
    base_year: int = BASE_YEAR,
    block: int = BLOCK_SIZE,
) -> DataFrame:
    """A unique id per row: start of the month's block + position in the order.

    The job fails when a month outgrows its block. Equal rows get different ids.
    """
    numbered = add_position(stage_in_order(df, [period, *order_by], once=True), [period], "_n")
    fits = require(F.col("_n"), F.col("_n") < block, f"more than {block - 1} rows in a period")
    return drop_place(
        numbered.select(
            (block_start(F.col(period), base_year, block) + fits).alias(name),
            *df.columns,
        )
    )


def row_sequence(df: DataFrame, period: str, order_by: list[str], name: str, width: int = 8) -> DataFrame:
    """Zero-filled position of each row in its period."""
    numbered = add_position(stage_in_order(df, [period, *order_by], once=True), [period], "_n")
    return numbered.select(*df.columns, zero_fill(F.col("_n").cast("string"), width).alias(name))


def occurrence_text(key: Column, number: Column, total: Column, width: int = 4, separator: str = SEPARATOR) -> Column:
    """The key, followed by its occurrence number only when it repeats.

    The separator keeps a numbered key apart from a longer key that ends in digits;
    the job fails on a key that contains it. An empty separator leaves that to the
    caller.
    """
    plain = require(key, ~F.contains(key, F.lit(separator)), f"key contains {separator}") if separator else key
    return F.when(total > 1, F.concat(plain, F.lit(separator), zero_fill(number.cast("string"), width))).otherwise(plain)


def occurrence_suffix(df: DataFrame, key: str, order_by: list[str], width: int = 4, separator: str = SEPARATOR) -> DataFrame:
    """Make a key unique by numbering its repetitions."""
    numbered = add_occurrence(stage_in_order(df, [key, *order_by]), [key], "_n", "_total")
    unique = occurrence_text(F.col(key), F.col("_n"), F.col("_total"), width, separator)
    return drop_place(numbered.withColumn(key, unique)).select(*df.columns)


def natural_or_artificial(
    prefix: list[Column], parts: list[Column], sequence: Column, separator: str = SEPARATOR
) -> Column:
    """Prefix and natural parts when all parts are present, else prefix, separator
    and the sequence, which no natural parts can equal."""
    texts = [normalise_code(p) for p in parts]
    present = reduce(
        lambda a, b: a & b, [F.coalesce(t, F.lit("")) != F.lit("") for t in texts]
    )
    return F.when(present, F.concat(*prefix, *texts)).otherwise(F.concat(*prefix, F.lit(separator), sequence))


def keep_first(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """One row per key: the first in an explicit order."""
    return latest_per_key(df, keys, order_by)


def flag_duplicates(df: DataFrame, keys: list[str], name: str = "is_duplicated") -> DataFrame:
    """Mark every row whose key occurs more than once.

    Keys are counted with partial aggregation and only the repeated ones are
    joined back; a hot key on the row side is split by the skew join.
    """
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    joined = _join_same(df, repeated, keys, "left")
    return joined.withColumn(name, F.col("_n").isNotNull()).drop("_n")


def _join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL equals NULL, keeping the left key columns."""
    marked = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    )
    return left.join(marked, condition, how).drop(*[f"_r_{k}" for k in keys])
