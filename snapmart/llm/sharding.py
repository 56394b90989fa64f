"""Sharding over fixed virtual slots.

A record's id and text hash into one of ``SLOTS`` slots, for ever: texts that share an id are
spread, and equal rows lie together. Bytes and rows are summed
per slot, and a map from slots to shards, one version after the other, says where a
slot lives. Rebalancing edits the map: it moves slots from full shards to others and
leaves the rest alone, so a new version moves few records. The map and the sums have
``SLOTS`` rows whatever the data; they are the only things the driver sees.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.llm.common import fresh_names, staged, utf8
from snapmart.sources.staging import path_exists

SLOTS = 8192
#: Bytes a record counts besides its text.
OVERHEAD = 16
MAP = "version int, vslot int, shard int, bytes long, row_count long"


def record_size(text: Column | str) -> Column:
    return F.octet_length(utf8(text)).cast("long") + OVERHEAD


def slot_of(key: Column, text: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record, by its id (if it has one) and its text."""
    return F.pmod(F.xxhash64(key, utf8(text)), F.lit(slots)).cast("int")


def slot_sums(records: DataFrame) -> list[tuple[int, int, int]]:
    """(vslot, bytes, rows) of the slots in use. At most one row a slot."""
    rows = records.groupBy("vslot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    return sorted((r.vslot, r.b, r.n) for r in rows)


def first_map(shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Version 0: slots dealt in turn."""
    return {s: s % shards for s in range(slots)}


def rebalanced(current: dict[int, int], weight: dict[int, int], shards: int) -> dict[int, int]:
    """An edited map with bytes as equal as moves of whole slots make them.

    Shards above the mean give up their slots, largest first, as long as they do not
    fall below it by that; the slots given up go, largest first, to the emptiest
    shard. Then the fullest and the emptiest shard exchange slots while that brings
    them closer.
    """
    out = dict(current)
    load = [0] * shards
    held: dict[int, list[int]] = defaultdict(list)
    for slot, shard in out.items():
        if shard < shards:
            load[shard] += weight.get(slot, 0)
            held[shard].append(slot)
    mean = sum(weight.values()) / shards
    loose = [s for s, shard in out.items() if shard >= shards]
    for shard in range(shards):
        for slot in sorted(held[shard], key=lambda s: (-weight.get(s, 0), s)):
            w = weight.get(slot, 0)
            if w and load[shard] - w >= mean:
                load[shard] -= w
                held[shard].remove(slot)
                loose.append(slot)
    for slot in sorted(loose, key=lambda s: (-weight.get(s, 0), s)):
        to = min(range(shards), key=lambda i: (load[i], i))
        load[to] += weight.get(slot, 0)
        held[to].append(slot)
        out[slot] = to
    while True:  # each exchange brings two shards closer and none further apart, so it ends
        high, low = max(range(shards), key=lambda i: (load[i], -i)), min(range(shards), key=lambda i: (load[i], i))
        gap = load[high] - load[low]
        best = _exchange(sorted((weight.get(s, 0), s) for s in held[high]), sorted((weight.get(s, 0), s) for s in held[low]), gap)
        if best is None:
            break
        (up, a), (down, b) = best
        held[high].remove(a)
        held[low].append(a)
        out[a] = low
        if b is not None:
            held[low].remove(b)
            held[high].append(b)
            out[b] = high
        load[high] -= up - down
        load[low] += up - down
    return out


def _exchange(high: list, low: list, gap: int):
    """The slot of the fuller shard, and the one (or none) of the other, whose exchange moves nearest to half the gap."""
    best, near = None, gap / 2
    given = [(0, None), *low]
    j = 0
    for up, a in high:
        while j + 1 < len(given) and up - given[j + 1][0] >= gap / 2:
            j += 1
        for k in (j, j + 1):
            if k < len(given):
                moved = up - given[k][0]
                if 0 < moved < gap and abs(moved - gap / 2) < near:
                    best, near = ((up, a), given[k]), abs(moved - gap / 2)
    return best


def map_frame(spark: SparkSession, version: int, slots: dict[int, int], sums: list[tuple[int, int, int]]) -> DataFrame:
    by_slot = {s: (b, n) for s, b, n in sums}
    return spark.createDataFrame([(version, s, shard, *by_slot.get(s, (0, 0))) for s, shard in sorted(slots.items())], MAP)


def store_map(frame: DataFrame, path: str) -> None:
    """Append a version to the stored map; versions are folders and are never changed."""
    version = frame.select("version").first()[0]
    frame.coalesce(1).write.mode("error").parquet(f"{path}/v={version}")


def load_map(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    return {r.vslot: r.shard for r in spark.read.schema(MAP).parquet(f"{path}/v={version}").select("vslot", "shard").collect()}


def rebalance(spark: SparkSession, path: str, records: DataFrame, shards: int, slots: int = SLOTS) -> int:
    """Store the next version of the map at ``path`` for these records; returns its number."""
    sums = slot_sums(records)
    version = 0
    while path_exists(spark, f"{path}/v={version}"):
        version += 1
    current = load_map(spark, path, version - 1) if version else first_map(shards, slots)
    if not version:
        store_map(map_frame(spark, 0, current, sums), path)
        version = 1
    store_map(map_frame(spark, version, rebalanced(current, {s: b for s, b, _ in sums}, shards), sums), path)
    return version


def placed(docs: DataFrame, shards: int, path: str, slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, size, text_crc32, vslot, shard, slot.

    Bytes are near equal over the shards, as near as whole virtual slots allow; a
    single text larger than a shard's share stays whole, and so do rows equal in id and text. ``slot`` numbers a shard's
    rows from 0 without gaps, by virtual slot, then id, checksum and size. A null
    text has no bytes but the overhead; a row without an id is placed by its text alone.
    Repeated rows lie beside each other; an empty table gives no rows. The map is
    stored at ``path``, where a later call continues with its last version.
    """
    spark = docs.sparkSession
    key, body = F.col(doc_id), F.col(text)
    records = docs.select(
        key.alias("doc_id"), record_size(body).alias("size"), F.crc32(utf8(body)).alias("text_crc32"), slot_of(key, body, slots).alias("vslot")
    )
    records = staged(records, "records")
    version = rebalance(spark, path, records, shards, slots)
    where = spark.read.schema(MAP).parquet(f"{path}/v={version}")
    # Where each slot's rows begin in its shard: sums over at most SLOTS rows.
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    where = where.select("vslot", "shard", F.coalesce(F.sum("row_count").over(before), F.lit(0)).alias("begins"))
    order = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    numbered = records.withColumn("place", F.row_number().over(order) - 1)
    return numbered.join(F.broadcast(where), "vslot").select(
        "doc_id", "size", "text_crc32", "vslot", "shard", (F.col("begins") + F.col("place")).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, map_path: str, version: int, slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the documents in a folder a shard, by a stored version of the map. A shard is
    written by many tasks, as its virtual slots are. A column of theirs named ``shard`` gives way to the folder's."""
    spark = docs.sparkSession
    (vslot,) = fresh_names(docs, "vslot")
    where = spark.read.schema(MAP).parquet(f"{map_path}/v={version}").select(F.col("vslot").alias(vslot), "shard")
    rows = docs.drop("shard").withColumn(vslot, slot_of(F.col(doc_id), F.col(text), slots)).join(F.broadcast(where), vslot).drop(vslot)
    rows.hint("rebalance", "shard").write.mode("error").partitionBy("shard").parquet(path)
