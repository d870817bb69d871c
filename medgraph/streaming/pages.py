"""Numbered pages, ingested from a mark on; every record key once.

The source gives page numbers above its mark, a few for each micro-batch; the mark is the stream's offset, so
Spark's checkpoint holds it and a restart goes on after the last page.  Tasks read the pages.
A batch is stored under the name of its last page by an append that counts once, so a batch
that is run again after a failure adds nothing twice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from ..operators.ordering import first_by
from ..sources import commits

NAME = re.compile(r"page-0*(\d+)\.jsonl$")


def _folder(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class PageMark(SimpleDataSourceStreamReader):
    """(page, file) of pages above the mark, at most `pages` at a time, in order."""

    def __init__(self, path: str, pages: int):
        self.path, self.pages = path, pages

    def numbered(self) -> list[tuple[int, str]]:
        from pyarrow import fs

        files, at = _folder(self.path)
        return sorted((int(m[1]), f.base_name) for f in files.get_file_info(fs.FileSelector(at)) if (m := NAME.search(f.base_name)))

    def initialOffset(self) -> dict:
        return {"page": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        fresh = [x for x in self.numbered() if x[0] > start["page"]][: self.pages]
        return iter(fresh), {"page": fresh[-1][0] if fresh else start["page"]}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([x for x in self.numbered() if start["page"] < x[0] <= end["page"]])


class Pages(DataSource):
    """Format numbered_pages; options path (a folder of page-<number>.jsonl) and pages (for a micro-batch)."""

    @classmethod
    def name(cls) -> str:
        return "numbered_pages"

    def schema(self) -> str:
        return "page long, file string"

    def simpleStreamReader(self, schema) -> PageMark:
        return PageMark(self.options["path"], int(self.options.get("pages", "10")))


def records(pages: DataFrame, path: str) -> DataFrame:
    """(page, line, value): the lines of pages (page, file), read where the rows are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = _folder(path)
        for b in batches:
            for page, file in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with files.open_input_stream(f"{at}/{file}") as f:
                    lines = f.read().decode("utf-8").splitlines()
                yield pa.RecordBatch.from_arrays([pa.array([page] * len(lines), pa.int64()), pa.array(range(len(lines)), pa.int64()), pa.array(lines, pa.string())], ["page", "line", "value"])

    return pages.repartition("page").mapInArrow(run, "page long, line long, value string")


def ingest_pages(spark: SparkSession, path: str, schema: str, target: str, checkpoint: str, key: str, pages: int = 10) -> StreamingQuery:
    """Starts the ingest of pages of JSON records (schema, as DDL) into the table at target (read it with commits.read).

    Of records with equal keys the first by page and line stays, also over batches; records without a
    key, and lines that are no JSON, are left out.
    """
    spark.dataSource.register(Pages)

    def store(batch: DataFrame, number: int) -> None:
        last = batch.agg(F.max("page").alias("p")).first()["p"]
        if last is None:
            return
        rows = records(batch, path).select(F.col("page").alias("_page"), F.col("line").alias("_line"), F.from_json("value", schema).alias("r")).select("_page", "_line", "r.*").where(F.col(key).isNotNull())
        fresh = first_by(rows, [key], [F.col("_page"), F.col("_line")]).drop("_page", "_line")
        held = commits.read(spark, target, schema)
        commits.append_once(fresh.join(held.select(key), key, "left_anti").select(*held.columns), target, f"page-{last}")

    stream = spark.readStream.format("numbered_pages").option("path", path).option("pages", str(pages)).load()
    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).start()
