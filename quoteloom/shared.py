"""Where a run lands intermediate tables.

Landed data must be readable by every executor and survive the loss of any of
them, so it goes to the folder the cluster names in ``spark.checkpoint.dir``.
Only a local session without that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from quoteloom.errors import LoadError

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not is_local(spark):
        raise LoadError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="quoteloom-")
    return _local_roots[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_root(spark)}/quoteloom/{label}-{uuid.uuid4().hex}"


def is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def land(df, label: str):
    """Write ``df`` once to the shared folder and return it read back.

    Used where a plan must not run twice (a fetch) or where its lineage must be
    cut so that a lost executor costs a re-read and not a re-run.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def discard(spark: SparkSession, path: str) -> None:
    """Remove a landed folder."""
    fs, target = _place(spark, path)
    fs.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _place(spark, path)
    return fs.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """What is directly below ``path``; nothing if that does not exist."""
    fs, target = _place(spark, path)
    return [f"{path}/{f.getPath().getName()}" for f in fs.listStatus(target)] if fs.exists(target) else []


def store_lines(spark: SparkSession, path: str, lines: list[str]) -> None:
    """Write a small text file of the driver's own."""
    fs, target = _place(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray("".join(f"{line}\n" for line in lines).encode()))
    finally:
        out.close()


class Landing:
    """Owner of the tables that one operation lands: ``clear`` removes them when it is done.

    A failed operation leaves them in place.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def land(self, df, label: str):
        path = fresh_path(self.spark, label)
        self.paths.append(path)
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self.paths:
            discard(self.spark, path)
        self.paths = []
