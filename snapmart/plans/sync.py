"""Keeping a serving copy in step with the star tables, month by month.

A month is skipped when its content fingerprint and row counts say nothing
changed; otherwise it is replaced or upserted, and the load is noted
in an append-only ledger. All months of a load are written beside the live ones and
counted there, and then published as one version of the table (``sources.versions``): readers see
the old version or the new one, also when the driver dies. The SUCCESS row comes
last. A crash between the two leaves the ledger behind the data, the next run sees the
difference and repeats the month; repeating is harmless.

A table of large months can be kept in buckets of its key. Their fingerprints are the leaves
of a tree with a month's fingerprint at its root, and only buckets that changed are written.

Only month and bucket lists and ledger rows reach the driver, never data.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapmart.functions.dates import is_period, key_period, period_key, retention_limit
from snapmart.functions.hashing import row_hash
from snapmart.operators.aggregate import latest_per_key
from snapmart.operators.quality import assert_pk, assert_reconciled, reconcile, require
from snapmart.operators.shape import assert_schema, rename_aliases
from snapmart.plans.schemas import schema
from snapmart.sources.files import PERIOD, append_rows, read_or_empty, stored_periods, write_periods, write_table
from snapmart.sources.staging import discard, stage
from snapmart.sources.versions import (
    FACTOR, KEYS, ROWS, Part, Write, drop_parts, load_version, read_parts, read_stored, table_exists,
)

#: Sees what was written before it takes the place of the old rows; raises to keep these.
Check = Callable[[DataFrame], None] | None
SUCCESS, FAILURE = "SUCCESS", "FAILURE"
SKIP, UPDATE = "SKIP", "UPDATE"
MERGE_TABLE, MERGE_PERIODS, REPLACE_PERIODS = "merge_table", "merge_periods", "replace_periods"
#: Buckets of the key directory of an upserted table.
KEY_BUCKETS = 32
BUCKET = "bucket"


@dataclass(frozen=True)
class TableSpec:
    """How one table is kept in step."""

    name: str
    strategy: str
    keys: list[str] = field(default_factory=list)
    period_date: str | None = None  # month from a date column ...
    period_key: str | None = None  # ... or from the head of a snapshot key
    retained: bool = False  # old months are dropped
    aliases: dict[str, str] = field(default_factory=dict)
    buckets: int = 0  # a replaced table is kept in so many buckets of its keys


# Parents before children; retention walks the list backwards.
TABLES = [
    TableSpec("dates", MERGE_TABLE, ["date"]),
    TableSpec("places", MERGE_TABLE, ["place_id"]),
    TableSpec("units", MERGE_PERIODS, ["unit_version"], period_date="period_date", retained=True),
    TableSpec("licences", REPLACE_PERIODS, period_key="unit_version", retained=True),
    TableSpec("staff", REPLACE_PERIODS, period_date="period_date", retained=True),
    TableSpec("beds", REPLACE_PERIODS, period_date="period_date", retained=True),
    TableSpec("equipment", REPLACE_PERIODS, period_date="period_date", retained=True),
    TableSpec("admissions", REPLACE_PERIODS, period_date="period_date", retained=True),
]


# ---- content ---------------------------------------------------------------------

def period_of(spec: TableSpec) -> Column:
    """Month of a row; the job fails on a row without a valid one."""
    value = period_key(spec.period_date) if spec.period_date else key_period(spec.period_key)
    return require(value, value.isNotNull(), f"{spec.name}: row without a valid period")


def with_period(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows with their month. A frame stored by month keeps its folder column,
    so that reading the changed months again opens only their folders."""
    named = rename_aliases(df, spec.aliases)
    return named if PERIOD in named.columns else named.withColumn(PERIOD, period_of(spec))


def misplaced(spec: TableSpec) -> Column:
    """True for a row whose month is none, or is not the month of its own date or key."""
    own = period_key(spec.period_date) if spec.period_date else key_period(spec.period_key)
    return ~F.coalesce(is_period(PERIOD) & own.eqNullSafe(F.col(PERIOD)), F.lit(False))


def fingerprint(df: DataFrame, period: str = PERIOD, exclude: list[str] = (), by: list[str] = (), more: list[Column] = ()) -> DataFrame:
    """(period, row_count, content_hash), independent of row order and layout.

    Two salted row hashes enter as sums and XORs. Each hash is summed in three
    slices of 22 bits or less, so the sums stay exact 64-bit integers up to 2^41
    rows per month and the whole fold runs as partial aggregation. ``by`` are further
    columns of a group, left out of the hash; ``more`` are aggregates taken in the same pass.
    """
    columns = [c for c in df.columns if c != period and c not in exclude and c not in by]
    hashed = df.withColumns({"_a": row_hash(columns, "first"), "_b": row_hash(columns, "second")})
    folds: list[Column] = []
    for c in ("_a", "_b"):
        for i in range(3):
            part = F.shiftrightunsigned(F.col(c), 22 * i).bitwiseAND(F.lit((1 << 22) - 1))
            folds.append(F.sum(part).alias(f"{c}{i}"))
        folds.append(F.bit_xor(c).alias(f"{c}x"))
    names = [f"{c}{i}" for c in ("_a", "_b") for i in ("0", "1", "2", "x")]
    folded = hashed.groupBy(F.col(period).alias(PERIOD), *by).agg(F.count("*").alias("row_count"), *folds, *more)
    signature = F.concat_ws("|", *[F.col(n).cast("string") for n in ["row_count", *names]])
    return folded.withColumn("content_hash", F.sha2(signature, 256)).drop(*names)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_prints(df: DataFrame, keys: list[str], buckets: int, more: list[Column] = ()) -> DataFrame:
    """(period, bucket, row_count, content_hash): the leaves of the fingerprint tree."""
    return fingerprint(df.withColumn(BUCKET, bucket_of(keys, buckets)), by=[BUCKET], more=more)


def month_prints(leaves: DataFrame, more: list[Column] = ()) -> DataFrame:
    """(period, row_count, content_hash) from the leaves: a hash of the hashes of a month's buckets."""
    listed = F.sort_array(F.collect_list(F.struct(BUCKET, "content_hash")))  # at most one a bucket
    text = F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x[BUCKET].cast("string"), x["content_hash"])), ",")
    grouped = leaves.groupBy(PERIOD).agg(F.sum("row_count").alias("row_count"), F.sha2(text, 256).alias("content_hash"), *more)
    return grouped


def period_counts(df: DataFrame, period: str | Column = PERIOD) -> DataFrame:
    key = F.col(period) if isinstance(period, str) else period
    return df.groupBy(key.alias(PERIOD)).agg(F.count("*").alias("row_count"))


# ---- ledgers ---------------------------------------------------------------------

def ledger_current(ledger: DataFrame, keys: list[str] = ("table_name", PERIOD)) -> DataFrame:
    """The latest successful row per key."""
    done = ledger.where(F.col("status") == SUCCESS)
    tie = "load_id" if "load_id" in ledger.columns else "tag"
    return latest_per_key(done, list(keys), [F.col("loaded_at").desc(), F.col(tie).desc()])


def already_loaded(ledger: DataFrame, table: str, file: str, tag: str) -> bool:
    """True when this very file version was loaded successfully before."""
    same = (F.col("table_name") == table) & (F.col("file_name") == file) & (F.col("tag") == tag)
    return not ledger.where(same & (F.col("status") == SUCCESS)).isEmpty()


def period_in_sync(ledger: DataFrame, table: str, period: str, content_hash: str) -> bool:
    """True when the month's latest successful load had this content."""
    rows = ledger.where((F.col("table_name") == table) & (F.col(PERIOD) == period))
    return not ledger_current(rows).where(F.col("content_hash") == content_hash).isEmpty()


def has_period_ledger(ledger: DataFrame, table: str) -> bool:
    return not ledger.where((F.col("table_name") == table) & (F.col("status") == SUCCESS)).isEmpty()


# ---- plan ------------------------------------------------------------------------

def sync_plan(source: DataFrame, ledger: DataFrame, target: DataFrame, at_least: bool = False) -> DataFrame:
    """(period, action, reason, row_count, content_hash) per source month.

    ``source`` is a fingerprint, ``ledger`` the current ledger rows of the table
    and ``target`` the row counts found in the serving copy. With ``at_least`` the
    target may hold more rows, as an upserted month keeps those the source lacks.
    """
    noted = ledger.select(
        PERIOD, F.col("content_hash").alias("_hash"), F.col("row_count").alias("_noted"), F.lit(True).alias("_known")
    )
    found = target.select(PERIOD, F.col("row_count").alias("_found"))
    rows = source.join(noted, PERIOD, "left").join(found, PERIOD, "left")
    enough = F.col("_found") >= F.col("row_count") if at_least else F.col("_found") == F.col("row_count")
    reason = (
        F.when(F.col("_known").isNull(), "new")
        .when(~F.col("_hash").eqNullSafe(F.col("content_hash")), "content changed")
        .when(~F.coalesce(enough, F.lit(False)), "target count differs")
        .when(~F.col("_noted").eqNullSafe(F.col("row_count")), "ledger differs")
    )
    action = F.when(reason.isNull(), SKIP).otherwise(UPDATE)
    return rows.select(PERIOD, action.alias("action"), reason.alias("reason"), "row_count", "content_hash")


# ---- applying --------------------------------------------------------------------

def merged_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """All source rows and those target rows whose key the source lacks."""
    kept = target.join(source.select(*keys).distinct(), keys, "left_anti")
    return source.unionByName(kept.select(*source.columns))


def replace_periods(source: DataFrame, path: str, periods: list[str], check: Check = None) -> None:
    """Overwrite the given months with the source's rows."""
    write_periods(source.where(F.col(PERIOD).isin(periods)), path, check=check)


def upsert_periods(source: DataFrame, path: str, keys: list[str], periods: list[str], table: str = "table", check: Check = None) -> None:
    """Update by key and insert the rows of the given months.

    The key alone decides: a stored row with a key of the source goes, whatever its
    month, so the months that lose a row are written anew too. Nothing else is
    deleted. A key repeated in the source has no defined winner and is refused. The
    source is read more than once; pass one that is stored.

    The table keeps a directory beside its rows: the month of each key, in ``KEY_BUCKETS``
    buckets of the key's hash. An upsert opens the buckets of its keys and adds their new
    months to them, in the same version as the rows; no other month is read. Rows that got
    into the table in other ways end the directory, and the next upsert sets it up again.
    """
    spark = source.sparkSession
    chosen = source.where(F.col(PERIOD).isin(periods))
    assert_pk(chosen, keys, table)
    data = chosen.select(*(c for c in chosen.columns if c != PERIOD), PERIOD)
    with Write(spark, path, data.schema) as write:
        base = write.base
        found, replaced, entries = _key_months(spark, path, base, data, keys, write.base.number + 1)
        losing = found.join(data.select(*keys, F.col(PERIOD).alias("_now")), keys).where(F.col(PERIOD) != F.col("_now"))
        losing = losing.select(PERIOD).distinct().where(~F.col(PERIOD).isin(periods)).collect()  # months, not rows
        touched = {*periods, *(r[0] for r in losing)}
        stored = read_parts(spark, path, base.rows(touched), data.schema)
        write.add(merged_rows(data, stored, keys), [PERIOD])
        if check:
            check(write.written())
        write.add(entries, [BUCKET], KEYS)
        gone = {p.folder for p in replaced}
        kept = [p for p in base.parts if p.folder not in gone and not (p.kind == ROWS and p.period in touched)]
        write.publish([*kept, *write.new])


def _key_months(spark: SparkSession, path: str, base, rows: DataFrame, keys: list[str], number: int) -> tuple[DataFrame, list[Part], DataFrame]:
    """What the directory says of the buckets of some rows' keys, the parts of it that the new
    entries replace, and these entries (keys, period, seq, bucket)."""
    bucket = bucket_of(keys, KEY_BUCKETS).alias(BUCKET)
    seq = F.lit(number).cast("long").alias("seq")
    fresh = rows.select(*keys, PERIOD, seq, bucket)
    parts = [p for p in base.parts if p.kind == KEYS]
    if not parts:  # set up from the key columns of the stored rows
        found = read_parts(spark, path, base.rows(), rows.schema).select(*keys, PERIOD)
        old = found.select(*keys, PERIOD, F.lit(0).cast("long").alias("seq"), bucket)
        return found, [], _newest(old.unionByName(fresh), keys)
    wanted = {r[0] for r in fresh.select(BUCKET).distinct().collect()}  # at most KEY_BUCKETS numbers
    parts = [p for p in parts if p.bucket in wanted]
    directory = read_parts(spark, path, parts, fresh.schema) if parts else fresh.limit(0)
    crowded = {b for b in wanted if sum(p.bucket == b for p in parts) >= FACTOR - 1}
    merged = _newest(directory.where(F.col(BUCKET).isin(crowded)).unionByName(fresh), keys) if crowded else fresh
    found = _newest(directory, keys).select(*keys, PERIOD)
    return found, [p for p in parts if p.bucket in crowded], merged


def _newest(entries: DataFrame, keys: list[str]) -> DataFrame:
    latest = F.max(F.struct("seq", PERIOD)).alias("_last")
    return entries.groupBy(*keys, BUCKET).agg(latest).select(*keys, f"_last.{PERIOD}", "_last.seq", BUCKET)


def replace_buckets(source: DataFrame, path: str, keys: list[str], buckets: int, changed: set[tuple[str, int]], check: Check = None) -> None:
    """Overwrite the given (period, bucket) pairs with the source's rows; a pair without rows goes.

    A stored month that is not in buckets must be given with all of its buckets.
    """
    spark = source.sparkSession
    data = source.select(*(c for c in source.columns if c != PERIOD), PERIOD)
    pairs = spark.createDataFrame(sorted(changed), f"_p string, {BUCKET} int")  # one small row a changed bucket
    rows = data.withColumn(BUCKET, bucket_of(keys, buckets)).where(F.col(PERIOD).isin(sorted({p for p, _ in changed})))
    rows = rows.join(F.broadcast(pairs.withColumnRenamed(BUCKET, "_b")), (F.col(PERIOD) == F.col("_p")) & (F.col(BUCKET) == F.col("_b")), "left_semi")
    months = {p for p, _ in changed}
    with Write(spark, path, data.schema) as write:
        write.add(rows, [PERIOD, BUCKET])
        if check:
            check(write.written())
        kept = [p for p in write.base.parts if not ((p.period, p.bucket) in changed or (p.bucket is None and p.period in months))]
        write.publish([*kept, *write.new])


def upsert_table(source: DataFrame, path: str, keys: list[str], table: str = "table", check: Check = None) -> None:
    """Update by key and insert into an unpartitioned table."""
    spark = source.sparkSession
    assert_pk(source, keys, table)
    if table_exists(spark, path):
        source = merged_rows(source, read_stored(spark, path), keys)
    write_table(source, path, check=check)


def expired_periods(periods: list[str], as_of: dt.date, months: int) -> list[str]:
    limit = retention_limit(as_of, months).strftime("%Y%m")
    return [p for p in periods if p < limit]


def retain(spark: SparkSession, path: str, as_of: dt.date, months: int) -> list[str]:
    """Drop the months before the retention limit, in one version; the dropped months."""
    dropped = set(expired_periods(stored_periods(spark, path), as_of, months))
    if dropped:
        drop_parts(spark, path, lambda p: p.kind == ROWS and p.period in dropped)
    return sorted(dropped)


# ---- the serving store -------------------------------------------------------------

class Store:
    """Serving tables, ledgers and the loads that keep them in step, below ``root``.

    ``now`` supplies load times, so tests and replays are reproducible.
    """

    def __init__(self, spark: SparkSession, root: str, now: Callable[[], dt.datetime]):
        self.spark, self.root, self.now = spark, root.rstrip("/"), now

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def file_ledger(self) -> DataFrame:
        return read_or_empty(self.spark, self.path("_file_ledger"), schema("file_ledger"))

    def period_ledger(self, table: str) -> DataFrame:
        rows = read_or_empty(self.spark, self.path("_period_ledger"), schema("period_ledger"))
        return rows.where(F.col("table_name") == table)

    def bucket_ledger(self, table: str) -> DataFrame:
        rows = read_or_empty(self.spark, self.path("_bucket_ledger"), schema("bucket_ledger"))
        return rows.where(F.col("table_name") == table)

    def table(self, name: str, version: int | None = None) -> DataFrame:
        """A serving table: its newest version, or an older one that is kept."""
        return read_stored(self.spark, self.path(name), number=version)

    def states(self, name: str) -> DataFrame:
        """(period, content_hash) of the live months, from the ledger: no data is read."""
        live = stored_periods(self.spark, self.path(name))
        return ledger_current(self.period_ledger(name)).where(F.col(PERIOD).isin(live)).select(PERIOD, "content_hash")

    def counts(self, spec: TableSpec) -> DataFrame:
        """Rows per month in the serving copy; no column is read, only file footers."""
        if not table_exists(self.spark, self.path(spec.name)):
            return self.spark.createDataFrame([], f"{PERIOD} string, row_count bigint")
        return period_counts(self.table(spec.name))

    def note_file(self, spec: TableSpec, file: str, tag: str, rows: int | None, status: str) -> None:
        row = [(spec.name, file, tag, rows, status, self.now())]
        append_rows(
            self.spark.createDataFrame(row, schema("file_ledger")).coalesce(1), self.path("_file_ledger")
        )

    def note_periods(self, spec: TableSpec, plan: list, tag: str, status: str) -> None:
        rows = [
            (uuid.uuid4().hex, spec.name, r[PERIOD], r["content_hash"], r["row_count"], tag, status, self.now())
            for r in plan
        ]
        append_rows(
            self.spark.createDataFrame(rows, schema("period_ledger")).coalesce(1),
            self.path("_period_ledger"),
        )

    def load(self, spec: TableSpec, source: DataFrame, file: str, tag: str, since: str | None = None) -> list[tuple[str, str]]:
        """Bring one table in step with a source version; (period, reason) updated.

        Months before ``since`` are left alone in a table with retention, which
        would drop them again.
        """
        if already_loaded(self.file_ledger(), spec.name, file, tag):
            return []
        if spec.strategy == MERGE_TABLE:
            return self._load_table(spec, source, file, tag)
        return self._load_periods(spec, source, file, tag, since if spec.retained else None)

    def load_all(self, sources: dict[str, tuple[DataFrame, str, str]], as_of: dt.date, months: int, tables: list[TableSpec] = TABLES) -> dict:
        """Load the given tables parents first, then apply retention."""
        since = retention_limit(as_of, months).strftime("%Y%m")
        done = {s.name: self.load(s, *sources[s.name], since) for s in tables if s.name in sources}
        self.retain_all(as_of, months, tables)
        return done

    def retain_all(self, as_of: dt.date, months: int, tables: list[TableSpec] = TABLES) -> dict[str, list[str]]:
        """Drop old months, children before the facility versions they refer to."""
        return {
            s.name: retain(self.spark, self.path(s.name), as_of, months)
            for s in reversed(tables)
            if s.retained
        }

    def _load_table(self, spec, source, file, tag) -> list[tuple[str, str]]:
        fresh = None
        try:
            self._check_columns(spec, source)
            fresh = stage(source, "load")
            rows = fresh.count()

            def check(written: DataFrame) -> None:
                if written.count() < rows:
                    raise ValueError(f"{spec.name}: fewer rows written than the source has")

            upsert_table(fresh, self.path(spec.name), spec.keys, spec.name, check)
        except Exception:
            self.note_file(spec, file, tag, None, FAILURE)
            raise
        finally:
            if fresh is not None:
                discard(fresh)
        self.note_file(spec, file, tag, rows, SUCCESS)
        return [("", "upserted")]

    def _load_periods(self, spec, source, file, tag, since) -> list[tuple[str, str]]:
        ledger = self.period_ledger(spec.name)
        if table_exists(self.spark, self.path(spec.name)) and not has_period_ledger(ledger, spec.name):
            raise ValueError(f"{spec.name} holds rows but has no month ledger; bootstrap it first")
        rows = with_period(source, spec)
        changed: list = []
        leaves = None
        try:
            self._check_columns(spec, rows)
            prints, leaves = self._prints(spec, rows)
            merging = spec.strategy == MERGE_PERIODS
            plan = sync_plan(prints, ledger_current(ledger), self.counts(spec), merging).collect()
            wanted = (r for r in plan if r["action"] == UPDATE and (since is None or r[PERIOD] >= since))
            changed = sorted(wanted, key=lambda r: r[PERIOD])
            if changed:
                self._apply(spec, rows, changed, leaves)
        except Exception:
            if changed:
                self.note_periods(spec, changed, tag, FAILURE)
            self.note_file(spec, file, tag, None, FAILURE)
            raise
        finally:
            if leaves is not None:
                discard(leaves)
        if changed:
            self.note_periods(spec, changed, tag, SUCCESS)
        # Unchanged content under a new tag leaves only this row.
        self.note_file(spec, file, tag, sum(r["row_count"] for r in plan), SUCCESS)
        return [(r[PERIOD], r["reason"]) for r in changed]

    def _prints(self, spec, rows) -> tuple[DataFrame, DataFrame | None]:
        """The fingerprints of the source's months, and those of their buckets. Months are checked in the same pass over the source."""
        bad = F.max(F.when(misplaced(spec), F.coalesce(F.col(PERIOD), F.lit("none")))).alias("_bad")
        if spec.buckets:
            found = leaves = stage(bucket_prints(rows, spec.keys, spec.buckets, [bad]), "leaves")
            months = month_prints(leaves)
        else:
            # Small: one row a month. Kept on the driver, so that the source is read once.
            got = fingerprint(rows, more=[bad])
            found = months = self.spark.createDataFrame(got.collect(), got.schema)
            leaves = None
        wrong = found.where(F.col("_bad").isNotNull()).first()
        if wrong:
            raise ValueError(f"{spec.name}: row without a valid period, or of another month than {wrong['_bad']}")
        return months.drop("_bad"), leaves

    def _apply(self, spec, rows, changed, leaves) -> None:
        """Write the changed months, all or none. They are staged, so the source is read a second time for them alone."""
        path = self.path(spec.name)
        periods = [r[PERIOD] for r in changed]
        if spec.buckets:
            return self._apply_buckets(spec, rows, changed, leaves)
        expected = self.spark.createDataFrame(
            [(r[PERIOD], r["row_count"]) for r in changed], f"{PERIOD} string, row_count bigint"
        )

        def check(written: DataFrame) -> None:
            found = period_counts(written.where(F.col(PERIOD).isin(periods)))
            report = reconcile(expected, found, PERIOD, at_least=spec.strategy == MERGE_PERIODS)
            assert_reconciled(report, PERIOD, spec.name)

        chosen = rows.where(F.col(PERIOD).isin(periods))
        if spec.strategy == REPLACE_PERIODS:
            return replace_periods(chosen, path, periods, check)
        if spec.strategy != MERGE_PERIODS:
            raise ValueError(f"unknown strategy {spec.strategy}")
        fresh = stage(chosen, "load")
        try:
            upsert_periods(fresh, path, spec.keys, periods, spec.name, check)
        finally:
            discard(fresh)

    def _apply_buckets(self, spec, rows, changed, leaves) -> None:
        """Of the changed months, write the buckets that differ from the ledger or were never noted."""
        path = self.path(spec.name)
        months = {r[PERIOD] for r in changed}
        known = latest_per_key(self.bucket_ledger(spec.name), [PERIOD, BUCKET], [F.col("loaded_at").desc(), F.col("load_id").desc()])
        known = {(r[PERIOD], r[BUCKET]): r["content_hash"] for r in known.where(F.col(PERIOD).isin(sorted(months))).collect()}
        now = {(r[PERIOD], r[BUCKET]): r for r in leaves.where(F.col(PERIOD).isin(sorted(months))).collect()}
        whole = {r[PERIOD] for r in changed if r["reason"] != "content changed"}
        version = load_version(self.spark, path)
        whole |= {p.period for p in (version.parts if version else []) if p.bucket is None}
        differ = {k for k, r in now.items() if known.get(k) != r["content_hash"]} | {k for k in known if k not in now and known[k]}
        differ |= {(p, b) for p in months & whole for b in range(spec.buckets)}
        expected = sum(r["row_count"] for k, r in now.items() if k in differ)

        def check(written: DataFrame) -> None:
            found = written.count()
            if found != expected:
                raise ValueError(f"{spec.name}: row counts differ: {found} rows written, {expected} expected")

        replace_buckets(rows, path, spec.keys, spec.buckets, differ, check)
        load, at = uuid.uuid4().hex, self.now()
        notes = [(load, spec.name, p, b, now[p, b]["content_hash"] if (p, b) in now else None, now[p, b]["row_count"] if (p, b) in now else 0, at) for p, b in sorted(differ)]
        append_rows(self.spark.createDataFrame(notes, schema("bucket_ledger")).coalesce(1), self.path("_bucket_ledger"))

    def _check_columns(self, spec, rows) -> None:
        path = self.path(spec.name)
        if table_exists(self.spark, path):
            version = load_version(self.spark, path)
            assert_schema(rows, version.schema if version else self.spark.read.parquet(path).schema, spec.name)

    # ---- ledgers for data that was loaded by other means --------------------------

    def bootstrap_file(self, spec: TableSpec, file: str, tag: str) -> bool:
        """Note an already filled table as loaded from this file version."""
        if already_loaded(self.file_ledger(), spec.name, file, tag) or not table_exists(self.spark, self.path(spec.name)):
            return False
        rows = self.table(spec.name).count()
        self.note_file(spec, file, tag, rows, SUCCESS)
        return True

    def bootstrap_periods(self, spec: TableSpec, source: DataFrame, file: str, tag: str) -> list[str]:
        """Note the months of an already filled table, if every count matches.

        The source's file version must be in the file ledger.
        """
        if spec.strategy == MERGE_TABLE or not table_exists(self.spark, self.path(spec.name)):
            return []
        if not already_loaded(self.file_ledger(), spec.name, file, tag):
            raise ValueError(f"{spec.name}: this file version is not in the file ledger")
        prints, leaves = self._prints(spec, with_period(source, spec))
        assert_reconciled(reconcile(prints, self.counts(spec), PERIOD), PERIOD, spec.name)
        known = ledger_current(self.period_ledger(spec.name)).select(PERIOD, "content_hash", "row_count")
        missing = prints.join(known, [PERIOD, "content_hash", "row_count"], "left_anti").collect()
        if missing:
            self.note_periods(spec, missing, tag, SUCCESS)
        if leaves is not None:
            discard(leaves)
        return sorted(r[PERIOD] for r in missing)
