"""Resumable keyed ingest, as a stream over landed files and as a batch step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.graph import upsert


def new_rows(landed: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Batch form: landed rows whose key the target lacks, one per key."""
    return landed.dropDuplicates([key]).join(target.select(key), key, "left_anti")


def ingest(spark: SparkSession, source: str, schema, target: str, checkpoint: str, key: str, fmt: str = "parquet") -> StreamingQuery:
    """Stream form: every landed key once and for ever (no watermark, so state grows with distinct keys); a restart goes on from the checkpoint."""
    rows = spark.readStream.schema(schema).format(fmt).load(source).dropDuplicates([key])
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_stream(spark: SparkSession, source: str, schema, read_target, write_target, checkpoint: str, key: str, fmt: str = "parquet") -> StreamingQuery:
    """Every micro-batch upserted into a node table; read_target() gives the table, write_target(df, batch) stores the next version."""

    def apply(batch: DataFrame, number: int) -> None:
        write_target(upsert(read_target(), batch.dropDuplicates([key]), key, keep_old=False), number)

    return spark.readStream.schema(schema).format(fmt).load(source).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
