"""Scans and catalogues (S operators).  Schemas are given, never inferred; bad rows are kept apart and countable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A parsed document, as DDL.
DOCUMENT = (
    "content STRING, html STRING, pages INT, model STRING, attachment_metadata STRUCT<board: STRING, post_number: STRING, post_title: STRING, attachment_index: INT, filename: STRING>, "
    "elements ARRAY<STRUCT<category: STRING, text: STRING, page: INT, confidence: DOUBLE>>"
)


def json_documents(spark: SparkSession, path: str, schema: str = DOCUMENT, glob: str = "*.json") -> DataFrame:
    """One document a file below a folder; board is the folder's name, files that do not parse have _corrupt_record."""
    df = spark.read.schema(f"{schema}, _corrupt_record STRING").option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("mode", "PERMISSIVE").json(path)
    file = F.col("_metadata.file_path")
    return df.withColumn("file", file).withColumn("board", F.element_at(F.split(file, "/"), -2))


def envelope(df: DataFrame, items: str, other: str | None = None) -> DataFrame:
    """S3: the rows of a payload array; other: a second name the array may have."""
    arr = F.coalesce(F.col(items), F.col(other)) if other else F.col(items)
    return df.select(F.inline(arr))


def keyed_dictionary(df: DataFrame, value: str, record: str) -> DataFrame:
    """A JSON object of key -> {records: [...], is_normalized} as (key, is_normalized, record fields)."""
    m = F.from_json(value, f"map<string, struct<records: array<struct<{record}>>, is_normalized: boolean>>")
    return df.select(F.explode(m).alias("key", "_v")).select("key", F.coalesce("_v.is_normalized", F.lit(False)).alias("is_normalized"), F.inline("_v.records"))


def csv_master(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header; a byte order mark is dropped by the reader, columns are pruned by what is selected later."""
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")


def code_master(df: DataFrame, names: list[str], flags: list[str]) -> DataFrame:
    """Columns renamed by place, 0/1 flags as booleans (null is false)."""
    out = df.toDF(*names)
    return out.withColumns({c: F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0)).cast("int").cast("boolean") for c in flags})


def column_like(df: DataFrame, part: str, fallback: int = 0) -> str:
    """The first column whose name holds part, else the one at a place."""
    return next((c for c in df.columns if part in c), df.columns[fallback])


def latest_snapshot(df: DataFrame, when: str, name: str) -> DataFrame:
    """Rows of the file with the largest (when, name).  For files, pass _metadata.file_modification_time and file_path."""
    top = df.agg(F.max(F.struct(when, name)).alias("t"))
    return df.join(F.broadcast(top), (F.col(when) == F.col("t")[when]) & (F.col(name) == F.col("t")[name])).drop("t")


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes by top folder and extension; contents are not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    rel = F.split(F.regexp_extract("path", rf"{path.rstrip('/')}/(.*)$", 1), "/")
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    return f.groupBy(F.when(F.size(rel) > 1, rel[0]).otherwise("").alias("root"), ext.alias("extension")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def profile(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, rows, columns) of every table, in one plan."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows", F.lit(",".join(df.columns)).alias("columns"))
        out = one if out is None else out.unionByName(one)
    return out


def null_census(df: DataFrame) -> DataFrame:
    """(column, nulls) in one pass."""
    one = df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])))


def lookup_map(df: DataFrame, a: str, b: str, order: list[Column]) -> DataFrame:
    """Both directions of a two-column mapping as (type, key, value), the last by order wins a key."""
    from ..operators.ordering import first_by

    last = [F.desc(F.col(c)) if isinstance(c, str) else c for c in order]
    one = lambda k, v, t: first_by(df.where(F.col(k).isNotNull()), [k], last).select(F.lit(t).alias("type"), F.col(k).cast("string").alias("key"), F.col(v).cast("string").alias("value"))
    return one(a, b, f"{a}_to_{b}").unionByName(one(b, a, f"{b}_to_{a}"))
