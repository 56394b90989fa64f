"""Intermediate tables in the shared checkpoint folder.

A staged frame is written once and read back: its lineage ends there, a lost
executor costs a re-read only, and values that depend on the partitioning stay
what they were when written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Without that setting a temporary folder serves a local session; a cluster
    session must name a folder that all its machines share.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = _local_roots.setdefault(
            sc.applicationId, tempfile.mkdtemp(prefix="snapmart-")
        )
    return f"{root.rstrip('/')}/snapmart-{sc.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write the frame to the staging folder and continue from the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_grouped(df: DataFrame, label: str, by: str) -> DataFrame:
    """Stage the frame in buckets of ``by``: grouping and windows by this column, alone or
    with others, need no shuffle of what is read back."""
    spark = df.sparkSession
    name, buckets = f"{label}_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, by).option("path", new_path(spark, label)).saveAsTable(name)
    back = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files belong to the staging folder
    return back


def clear_staging(spark: SparkSession) -> None:
    """Delete everything this application staged."""
    delete_path(spark, staging_root(spark))


# ---- folder housekeeping through Spark's own filesystem layer ----------------

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a folder, sorted; empty when it is absent."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def has_data(spark: SparkSession, path: str) -> bool:
    """True when the folder holds at least one visible child; for tables see ``versions.table_exists``."""
    return any(not n.startswith(("_", ".")) for n in child_names(spark, path))


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files of a folder and their bytes, hidden ones left out."""
    fs, p = _fs(spark, path)
    found = [s for s in fs.listStatus(p) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    return len(found), sum(s.getLen() for s in found)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file; one that exists is refused."""
    fs, p = _fs(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the folder it goes to is made."""
    fs, p = _fs(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    if not fs.exists(to.getParent()):
        fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"{source} could not be moved to {target}")


def discard(df: DataFrame) -> None:
    """Remove the staged tables a frame reads, once its consumer has written."""
    spark = df.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(staging_root(spark)).toUri().getPath()
    for file in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(file).toUri().getPath()
        if path.startswith(f"{root}/"):
            delete_path(spark, f"{staging_root(spark)}/{path[len(root) + 1:].split('/')[0]}")
