"""Summaries kept by month beside a fact, and queries that are answered from them.

A summary is a stored table (``sources.versions``) with a few rows for each month of a fact: counts
by some keys, exact bitmaps or theta sketches of distinct ids, KLL sketches of a measure. All of
them can be merged over months. Each row bears the content hash of the fact's month that it was
made from, so ``refresh`` makes anew only months whose hash has changed, and a reader knows
which months are in step: months that are not are read from the fact.

A question about some days takes its whole months from the smallest summary that has the keys it
needs; the days at the edges come from the fact. A range of whole months in step does not
read the fact at all. Only month lists and hashes reach the driver.

Exact by default: counts, sums and bitmaps give the same rows as the fact. Sketches are for domains
too wide for bitmaps; their errors are those of ``THETA_ERROR`` and ``KLL_ERROR``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapmart.functions.dates import check_range, day_range, month_label, month_of, month_start, shift_months, stay_days
from snapmart.operators.aggregate import distinct_values, rounded, top_k
from snapmart.operators.filters import Scope, keep_places, keep_units, with_unit_id
from snapmart.operators.ids import row_sequence
from snapmart.plans.star import Star
from snapmart.sources.files import PERIOD
from snapmart.sources.staging import stage
from snapmart.sources.versions import append, load_version, read_stored, replace_parts, table_exists

SOURCE = "source_hash"
#: log2 of the nominal entries of a theta sketch, k of a KLL sketch; their relative and rank errors (three standard errors).
THETA_LG, KLL_K = 12, 200
THETA_ERROR, KLL_ERROR = 3 / 2 ** (THETA_LG / 2), 0.04
MEASURES = ["admissions", "stay_days", "stays"]
EVERYWHERE = Scope()


@dataclass(frozen=True)
class Summary:
    """``build`` makes the rows of some months of the fact; they keep its ``period``."""

    name: str
    build: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class Kept:
    """A summary as stored: its rows, the months in step with the fact, its bytes."""

    rows: DataFrame | None
    fresh: frozenset[str] = frozenset()
    size: int = 0
    keys: tuple[str, ...] = ()


# ---- keeping ------------------------------------------------------------------------

def refresh(fact: DataFrame, states: DataFrame, path: str, summary: Summary) -> list[str]:
    """Make anew the months that are out of step and drop those that are gone; the months made.

    ``fact`` has its ``period``; ``states`` has one (period, content_hash) a month, from the period ledger
    or ``plans.sync.fingerprint``. All months are published as one version.
    """
    spark = fact.sparkSession
    wanted, held = _hashes(states, "content_hash"), _noted(spark, path)
    touched = sorted(p for p in wanted if held.get(p) != wanted[p])
    gone = set(held) - set(wanted)
    if not touched and not gone:
        return []
    hashes = spark.createDataFrame([(p, wanted[p]) for p in touched], f"{PERIOD} string, {SOURCE} string")
    made = summary.build(fact.where(F.col(PERIOD).isin(touched))).join(F.broadcast(hashes), PERIOD)  # one row a month
    made = made.select(*(c for c in made.columns if c != PERIOD), PERIOD)
    replace_parts(made, path, [PERIOD], lambda part, _: part.period in gone or part.period in touched)
    return touched


def open_kept(spark: SparkSession, path: str, states: DataFrame, keys: tuple[str, ...] = ()) -> Kept:
    """A stored summary and the months of it that are in step with the fact; without a table, none."""
    held = _noted(spark, path)
    if not held:
        return Kept(None, keys=keys)
    wanted = _hashes(states, "content_hash")
    fresh = frozenset(p for p, h in held.items() if wanted.get(p) == h)
    size = sum(p.size for p in load_version(spark, path).rows())
    return Kept(read_stored(spark, path), fresh, size, keys)


def _hashes(states: DataFrame, name: str) -> dict[str, str]:
    return {r[0]: r[1] for r in states.select(PERIOD, name).distinct().collect()}


def _noted(spark: SparkSession, path: str) -> dict[str, str]:
    return _hashes(read_stored(spark, path), SOURCE) if table_exists(spark, path) else {}


# ---- counts of admissions -------------------------------------------------------------

def count_summary(name: str, *keys: str) -> Summary:
    """Admissions and days of stay by month of entry and keys.

    The folder month is that of the file, the counted one that of the entry; a file
    of one month may hold entries of others.
    """
    def build(rows: DataFrame) -> DataFrame:
        return rows.groupBy(PERIOD, month_of("entry_date").alias("month"), *keys).agg(*_measures())

    return Summary(name, build, keys)


#: Narrow sets of keys: their sizes add up, where one set of all keys would multiply them to the size of the fact.
ADMISSION_COUNTS = [
    count_summary("by_unit", "unit_version", "care_place"),
    count_summary("by_diagnosis", "care_place", "diagnosis"),
    count_summary("by_person", "unit_version", "care_place", "sex", "race", "admission_type"),
    count_summary("by_ethnicity", "unit_version", "care_place", "ethnicity"),
]


def _measures() -> list[Column]:
    stay = stay_days("entry_date", "exit_date")
    return [
        F.count("*").alias("admissions"),
        F.coalesce(F.sum(stay), F.lit(0)).alias("stay_days"),
        F.count(stay).alias("stays"),
    ]


@dataclass(frozen=True)
class Counts:
    """Admissions with their kept counts. ``periods`` are all months of the fact."""

    fact: DataFrame
    periods: frozenset[str]
    kept: list[Kept] = field(default_factory=list)

    def choose(self, keys: list[str]) -> Kept | None:
        """The smallest summary that has the keys."""
        able = [k for k in self.kept if k.rows is not None and k.fresh and set(keys) <= set(k.keys)]
        return min(able, key=lambda k: k.size) if able else None

    def parts(self, start: dt.date, end: dt.date, keys: list[str]) -> DataFrame:
        """Rows (month, keys, measures) to be summed: whole months from a summary, the rest from the fact."""
        check_range(start, end)
        lo = start if start.day == 1 else shift_months(start, 1)
        hi = month_start(end + dt.timedelta(days=1))
        chosen = self.choose(keys) if lo < hi else None
        columns = ["month", *keys, *MEASURES]

        def counted(*wanted: Column) -> DataFrame:
            rows = self.fact.where(day_range("entry_date", start, end))
            for w in wanted:
                rows = rows.where(w)
            return rows.groupBy(month_of("entry_date").alias("month"), *keys).agg(*_measures()).select(*columns)

        if chosen is None:
            return counted()
        entry, stale = F.col("entry_date"), sorted(self.periods - chosen.fresh)
        whole = (F.col("month") >= F.lit(lo)) & (F.col("month") < F.lit(hi)) & F.col(PERIOD).isin(sorted(chosen.fresh))
        found = chosen.rows.where(whole).select(*columns)
        if start < lo:
            found = found.unionByName(counted(entry < F.lit(lo)))
        if end >= hi:
            found = found.unionByName(counted(entry >= F.lit(hi)))
        if stale:
            found = found.unionByName(counted(entry >= F.lit(lo), entry < F.lit(hi), F.col(PERIOD).isin(stale)))
        return found


def open_counts(fact: DataFrame, states: DataFrame, root: str, summaries: list[Summary] = ADMISSION_COUNTS) -> Counts:
    spark = fact.sparkSession
    states = stage(states.select(PERIOD, "content_hash"), "states")  # one row a month, read for every summary
    kept = [open_kept(spark, f"{root}/{s.name}", states, s.keys) for s in summaries]
    return Counts(fact, frozenset(_hashes(states, "content_hash")), kept)


def _scoped(counts: Counts, star: Star, start: dt.date, end: dt.date, scope: Scope, keys: list[str], known_place: bool = False) -> DataFrame:
    """Parts of the days that pass the scope; the dimensions meet counts, not admissions."""
    needed = [*keys]
    if scope.geographic or known_place:
        needed.append("care_place")
    if scope.unit:
        needed.append("unit_version")
    rows = counts.parts(start, end, list(dict.fromkeys(needed)))
    placed = keep_places(rows, star.places, "care_place", scope, always=known_place)
    return keep_units(placed, star.units, "unit_version", scope)


def admissions_by_month(counts: Counts, star: Star, start: dt.date, end: dt.date, scope: Scope = EVERYWHERE) -> DataFrame:
    rows = _scoped(counts, star, start, end, scope, [])
    months = rows.groupBy("month").agg(F.sum("admissions").alias("admissions"))
    return months.withColumn("month", month_label("month")).orderBy("month")


def admissions_total(counts: Counts, star: Star, start: dt.date, end: dt.date, scope: Scope = EVERYWHERE) -> DataFrame:
    """Admissions and mean stay: one row."""
    rows = _scoped(counts, star, start, end, scope, [])
    return rows.agg(
        F.coalesce(F.sum("admissions"), F.lit(0)).alias("admissions"),
        rounded(F.sum("stay_days").cast("double") / F.nullif(F.sum("stays"), F.lit(0))).alias("mean_stay"),
    )


def top_diagnoses(counts: Counts, star: Star, start: dt.date, end: dt.date, scope: Scope = EVERYWHERE, k: int = 10) -> DataFrame:
    rows = _scoped(counts, star, start, end, scope, ["diagnosis"]).where(F.col("diagnosis").isNotNull())
    return top_k(rows.groupBy("diagnosis").agg(F.sum("admissions").alias("admissions")), "admissions", ["diagnosis"], k)


def top_units(counts: Counts, star: Star, start: dt.date, end: dt.date, scope: Scope = EVERYWHERE, k: int = 10) -> DataFrame:
    """Busiest facilities by id."""
    per_version = _scoped(counts, star, start, end, scope, ["unit_version"]).groupBy("unit_version").agg(F.sum("admissions").alias("_n"))
    per_unit = with_unit_id(per_version, star.units, "unit_version", scope).groupBy("unit_id").agg(F.sum("_n").alias("admissions"))
    return top_k(per_unit, "admissions", ["unit_id"], k)


def filter_values(counts: Counts, star: Star, start: dt.date, end: dt.date, scope: Scope = EVERYWHERE) -> DataFrame:
    """Values on offer for the demographic filters, as (column, value)."""
    narrow, wide = ["sex", "race", "admission_type"], ["ethnicity"]
    found = [_scoped(counts, star, start, end, scope, ["unit_version", *c], known_place=True).select("unit_version", *c) for c in (narrow, wide)]
    rows = found[0].unionByName(found[1], allowMissingColumns=True)
    # The versions are met once: Spark would repeat a semi join for every part of the union.
    kept = rows.join(star.units.select("unit_version").distinct(), "unit_version")
    return distinct_values(kept, [*narrow, *wide], wide=wide).orderBy("column", "value")


# ---- distinct ids ---------------------------------------------------------------------

def extend_numbers(ids: DataFrame, path: str, column: str) -> None:
    """Give each id that has none yet the next number from 0 on, in the directory at ``path``.

    Numbers never change, so bitmaps of earlier months stay right. NULL has no number.
    """
    spark = ids.sparkSession
    unseen, first = ids.select(column).where(F.col(column).isNotNull()).distinct(), 0
    if table_exists(spark, path):
        known = read_stored(spark, path)
        unseen = unseen.join(known, column, "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    placed = row_sequence(unseen.withColumn("_all", F.lit("")), "_all", [column], "_n")
    lowest = F.lit(first - 1)  # positions start at 1
    append(placed.select(column, (F.col("_n").cast("bigint") + lowest).alias("number")), path)


def bitmap_summary(name: str, numbers: DataFrame, column: str, *keys: str) -> Summary:
    """Exact sets of ids by keys: one bitmap of 4 KB for every 32,768 numbers in use.

    A month's numbers come close together where ids are as old as their neighbours; the bitmaps are made
    and merged as partial aggregates, so a hot key is no hot task.
    """
    def build(rows: DataFrame) -> DataFrame:
        numbered = rows.select(PERIOD, *keys, column).join(numbers, column)
        group = [PERIOD, *keys, F.bitmap_bucket_number("number").alias("chunk")]
        return numbered.groupBy(*group).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))

    return Summary(name, build, keys)


def distinct_from_bitmaps(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """Distinct ids per ``by`` over all rows given: the exact number."""
    merged = rows.groupBy(*by, "chunk").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("_n"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))


def theta_summary(name: str, column: str, *keys: str, lg: int = THETA_LG) -> Summary:
    """Sketches of the ids by keys, for more ids than bitmaps can hold; exact below 2^lg ids."""
    def build(rows: DataFrame) -> DataFrame:
        return rows.where(F.col(column).isNotNull()).groupBy(PERIOD, *keys).agg(F.theta_sketch_agg(column, lg).alias("sketch"))

    return Summary(name, build, keys)


def distinct_from_sketches(rows: DataFrame, by: list[str], name: str, lg: int = THETA_LG) -> DataFrame:
    """About how many distinct ids there are per ``by``, within ``THETA_ERROR`` of them."""
    return rows.groupBy(*by).agg(F.theta_sketch_estimate(F.theta_union_agg("sketch", lg)).alias(name))


# ---- quantiles ------------------------------------------------------------------------

def quantile_summary(name: str, value: str, *keys: str, k: int = KLL_K) -> Summary:
    """KLL sketches of a measure by keys: a few kilobytes, however many values there are."""
    def build(rows: DataFrame) -> DataFrame:
        measure = F.col(value).cast("double")
        return rows.where(measure.isNotNull() & ~F.isnan(measure)).groupBy(PERIOD, *keys).agg(F.kll_sketch_agg_double(measure, k).alias("sketch"))

    return Summary(name, build, keys)


def quantiles_from_sketches(rows: DataFrame, by: list[str], ranks: dict[str, float], k: int = KLL_K) -> DataFrame:
    """Values at the ranks per ``by``, each within ``KLL_ERROR`` of its rank, and how many values there are."""
    merged = rows.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("_s"))
    found = [F.kll_sketch_get_quantile_double("_s", F.lit(r)).alias(n) for n, r in ranks.items()]
    return merged.select(*by, F.kll_sketch_get_n_double("_s").alias("n_values"), *found)
