"""Appends that count once: data goes to a folder of its own, and a small file named after the batch makes it part of the table.

The commit file is renamed into place and never replaces another, so of several attempts at a batch
(a retry, a second driver) one counts; what the others wrote is not in the table and can be swept.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _files(spark: SparkSession, path: str):
    """Hadoop's file context for a path, and its Path class."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _exists(spark: SparkSession, path: str) -> bool:
    files, at = _files(spark, path)
    return files.util().exists(at(path))


def _commit(spark: SparkSession, path: str, batch: str, folder: str) -> bool:
    """Writes the commit file of a batch; False if there is one."""
    files, at = _files(spark, path)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    draft, final = at(f"{path}/_commits/.{uuid.uuid4().hex}"), at(f"{path}/_commits/{batch}")
    files.mkdir(final.getParent(), None, True)
    fs = draft.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft, False)
    out.write(bytearray(folder.encode()))
    out.close()
    kind = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    keep = gateway.new_array(kind, 1)
    keep[0] = kind.valueOf("NONE")
    try:
        files.rename(draft, final, keep)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in str(e.java_exception):
            raise
        files.delete(draft, False)
        return False


def append_once(df: DataFrame, path: str, batch: str, fmt: str = "parquet", partition_by: list[str] = [], **options: object) -> bool:  # noqa: B006
    """Adds df to the table at path as one batch, if no such batch counts yet; whether it was added now."""
    if not re.fullmatch(r"[A-Za-z0-9_-][A-Za-z0-9_.-]*", batch):
        raise ValueError(f"not a name for a batch: {batch}")
    spark = df.sparkSession
    if _exists(spark, f"{path}/_commits/{batch}"):
        return False
    folder = f"of_batch={batch}-{uuid.uuid4().hex}"  # as a partition, so that tables that are partitioned themselves have one base
    writer = df.write.format(fmt).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{path}/data/{folder}")
    return _commit(spark, path, batch, folder)


def batches(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of every batch that counts: one small file each."""
    if not _exists(spark, f"{path}/_commits"):
        return {}
    found = spark.read.text(f"{path}/_commits", wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("batch"), "value")
    return {r["batch"]: r["value"] for r in found.collect()}


def read(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", **options: object) -> DataFrame:
    """The table: rows of the batches that count, and of no others."""
    folders = [f"{path}/data/{f}" for f in batches(spark, path).values()]
    empty = spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).options(**options).option("basePath", f"{path}/data").load(folders).select(*empty.columns) if folders else empty


def sweep(spark: SparkSession, path: str) -> int:
    """Deletes what attempts that do not count have left; only while nothing is being written.  Returns how many."""
    if not _exists(spark, f"{path}/data"):
        return 0
    files, at = _files(spark, path)
    held, gone = set(batches(spark, path).values()), 0
    for f in files.util().listStatus(at(f"{path}/data")):
        if f.getPath().getName() not in held:
            gone += bool(files.delete(f.getPath(), True))
    return gone
