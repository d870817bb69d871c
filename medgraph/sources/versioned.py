"""K1, K2, K6, K12 on stored tables: rows in buckets of their key, versions that point to the folder of each bucket.

A new version writes the buckets that change and points to the old folders of the others.  Its
pointer file is named after the version and never replaces another, so of two writers that
started from the same version one counts and the other is told (Conflict); readers keep
the version that they began with.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import upsert
from . import commits

BUCKETS = 64
#: Rows of a change that are sent to all tasks at most; a larger change is joined by hash, within the buckets it touches.
SMALL = 100_000


class Conflict(Exception):
    """Another writer made the version first."""


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(v) for v in commits.batches(spark, path))


def _pointer(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """Number, bucket count, key, schema and folders of a version, the last one if not given."""
    held = commits.batches(spark, path)
    if version is None:
        version = max(map(int, held), default=None)
        if version is None:
            return {"version": 0, "folders": {}}
    return {"version": version} | json.loads(held[f"{version:09d}"])


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _load(spark: SparkSession, path: str, at: dict, only: list[int] | None = None) -> DataFrame:
    folders = [f"{path}/data/{f}/bucket_no={b}" for b, f in at["folders"].items() if only is None or int(b) in only]
    empty = spark.createDataFrame([], at["schema"])
    return spark.read.schema(at["schema"]).option("basePath", f"{path}/data").parquet(*folders).select(*empty.columns) if folders else empty


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version."""
    return _load(spark, path, _pointer(spark, path, version))


def _write(path: str, rows: DataFrame, changed: list[int] | None, key: str, at: dict, buckets: int) -> int:
    """The next version: rows, all of the changed buckets (None: of all), in place of theirs."""
    spark, number = rows.sparkSession, at["version"] + 1
    folder = f"in_version={number}-{uuid.uuid4().hex}"
    fields = rows.columns
    rows.withColumn("bucket_no", bucket_of(key, buckets)).repartition("bucket_no").write.partitionBy("bucket_no").parquet(f"{path}/data/{folder}")
    files, at_path = commits._files(spark, f"{path}/data/{folder}")
    made = [f.getPath().getName() for f in files.util().listStatus(at_path(f"{path}/data/{folder}"))]
    fresh = {name.split("=")[1]: folder for name in made if name.startswith("bucket_no=")}
    kept = {} if changed is None else {b: f for b, f in at["folders"].items() if int(b) not in changed}
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*fields).schema.fields)
    pointer = {"key": key, "buckets": buckets, "schema": schema, "folders": kept | fresh}
    if not commits._commit(spark, path, f"{number:09d}", json.dumps(pointer)):
        raise Conflict(f"version {number} of {path} was made by another writer")
    return number


def create(rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> int:
    """The first version.  Null keys are in one bucket like any key."""
    return _write(path, rows, None, key, {"version": 0, "folders": {}}, buckets)


def upserted(old: DataFrame, new: DataFrame, key: str, keep_old: bool = True, status: bool = False) -> DataFrame:
    """As graph.upsert, for a new side small enough to be sent to all tasks: the old side is not shuffled."""
    fields = [c for c in old.columns if c != key]
    sent = F.broadcast(new.select(F.col(key).alias("_key"), F.struct(*fields).alias("_n")))
    pick = (lambda c: F.coalesce(c, f"_n.{c}")) if keep_old else (lambda c: F.coalesce(f"_n.{c}", c))
    state = lambda c: [c.alias("status")] if status else []
    both = old.join(sent, F.col(key) == F.col("_key"), "left")
    both = both.select(key, *[pick(c).alias(c) for c in fields], *state(F.when(F.col("_key").isNull(), "unchanged").otherwise("updated")))
    met = old.select(key).join(sent.select("_key"), F.col(key) == F.col("_key")).select("_key")
    made = new.join(met, F.col(key) == F.col("_key"), "left_anti").select(key, *fields, *state(F.lit("created")))
    return both.unionByName(made)


def change(spark: SparkSession, path: str, new: DataFrame, keep_old: bool = True) -> int:
    """K1 (keep_old), K2: upserts rows (the table's columns, no key twice) and makes the next version; only buckets that new has keys of are read and written."""
    at = _pointer(spark, path)
    key, buckets = at["key"], at["buckets"]
    touched = [r["b"] for r in new.select(bucket_of(key, buckets).alias("b")).distinct().collect()]
    old = _load(spark, path, at, touched)
    small = new.limit(SMALL + 1).count() <= SMALL
    rows = (upserted if small else upsert)(old, new.select(*old.columns), key, keep_old)
    return _write(path, rows.select(*old.columns), touched, key, at, buckets)


def delete(spark: SparkSession, path: str, where: Column) -> int:
    """The next version without the rows that a condition holds for; buckets without such rows are kept as they are."""
    at = _pointer(spark, path)
    rows = _load(spark, path, at)
    goes = F.coalesce(where, F.lit(False))
    touched = [r["b"] for r in rows.where(goes).select(bucket_of(at["key"], at["buckets"]).alias("b")).distinct().collect()]
    return _write(path, _load(spark, path, at, touched).where(~goes), touched, at["key"], at, at["buckets"])
