"""One JSON object of very many keys, read in pieces.

The reader cuts the file at commas, which Spark can do from any place in it.  Whether a comma stands
between two keys depends on all before it: on quotes and brackets.  So every block of the file is
first summed up (what it does to a reader that comes to it inside, and outside a string),
the summaries, one row a block, are put in order, and then every block knows how it begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .readers import keyed_dictionary


def _state(data: np.ndarray, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(inside a string, depth of brackets) after every byte."""
    slash = data == ord("\\")
    # a quote is escaped if an odd number of backslashes stands before it
    last = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))
    run = np.arange(len(data)) - last
    before = np.concatenate([[0], run[:-1]])
    quote = (data == ord('"')) & (before % 2 == 0)
    within = (np.cumsum(quote) + inside) % 2
    step = np.where(np.isin(data, list(b"{[")), 1, np.where(np.isin(data, list(b"}]")), -1, 0))
    return within, depth + np.cumsum(np.where(within == 1, 0, step))


def _joined(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of consecutive parts, each with the comma after it, and the place of those commas."""
    raw = [p.encode("utf-8") for p in parts.to_pylist()]
    return np.frombuffer(b",".join([*raw, b""]), np.uint8), np.cumsum([len(r) + 1 for r in raw]) - 1


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """((file, block), consecutive parts) of batches of (file, block, part)."""
    for b in batches:
        files, blocks = b.column(0).to_pylist(), b.column(1).to_numpy()
        edges = [0, *(i for i in range(1, b.num_rows) if blocks[i] != blocks[i - 1] or files[i] != files[i - 1]), b.num_rows]
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            if e > s:
                yield (files[s], int(blocks[s])), b.column(2).slice(s, e - s)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, block, flip (1 if it ends a string begun before or leaves one open), and the change of depth from outside and from inside a string."""
    got: dict[tuple[str, int], tuple[int, int, int]] = {}
    for key, parts in _blocks(batches):
        data, _ = _joined(parts)
        flip, out, within = got.get(key, (0, 0, 0))
        (end, from_out), (_, from_within) = (_state(data, (i + flip) % 2, 0) for i in (0, 1))
        got[key] = int(end[-1]), out + int(from_out[-1]), within + int(from_within[-1])
    if got:
        yield pa.RecordBatch.from_pylist([{"file": f, "block": b, "flip": v[0], "out": v[1], "within": v[2]} for (f, b), v in got.items()])


def _parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", ",").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, n, seq, piece, whole): runs of an entry's text; n: its number in the block, 0 if it began before; whole: nothing of it is elsewhere."""
    begins: dict[tuple[str, int], tuple[int, int]] = {}
    inside = depth = 0
    held = None
    # one row for each split of Spark's own file list
    for r in _parts(spark, path).mapInArrow(_sums, "file string, block long, flip long, out long, within long").orderBy("file", "block").collect():
        if r["file"] != held:
            held, inside, depth = r["file"], 0, 0
        begins[r["file"], r["block"]] = inside, depth
        depth += r["within"] if inside else r["out"]
        inside = (inside + r["flip"]) % 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict[tuple[str, int], list[int]] = {}
        for key, parts in _blocks(batches):
            fresh = key not in now
            at = now.setdefault(key, [*begins[key], 0, 0])
            data, commas = _joined(parts)
            within, level = _state(data, at[0], at[1])
            before = np.concatenate([[at[1]], level[:-1]])
            outer = (within == 0) & (((data == ord("{")) & (before == 0)) | ((data == ord("}")) & (level == 0)))
            text = np.where(outer, ord(" "), data).astype(np.uint8).tobytes()
            new = np.concatenate([[at[0] == 0 and at[1] == 1 or (fresh and begins[key] == (0, 0))], (within[commas[:-1]] == 0) & (level[commas[:-1]] == 1)])
            edges = [0, *(np.flatnonzero(new[1:]) + 1).tolist(), len(commas)]
            out = []
            for k, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                at[2] += bool(new[s])
                at[3] += 1
                piece = text[(int(commas[s - 1]) + 1 if s else 0) : int(commas[e - 1])].decode("utf-8")
                out.append((*key, at[2], at[3], piece, bool(new[s]) and k < len(edges) - 2))
            at[0], at[1] = int(within[-1]), int(level[-1])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["file", "block", "n", "seq", "piece", "whole"])

    return _parts(spark, path).mapInArrow(run, "file string, block long, n long, seq long, piece string, whole boolean")


def entries(spark: SparkSession, path: str) -> DataFrame:
    """(file, entry): the text "key": value of every top-level key, for files that hold one JSON object each.

    Blocks are as large as spark.sql.files.maxPartitionBytes, whatever the object's size.  Only entries that
    reach beyond an Arrow batch or a block are put together by a shuffle.  A key that an object repeats is an entry each time.
    """
    made = pieces(spark, path)
    some = made.where("not whole")
    last = some.groupBy("file", "block").agg(F.max("n").alias("n"))  # a block's last entry is never whole
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    of = F.last(F.when(F.col("n") > 0, F.struct("block", "n")), ignorenulls=True).over(before)
    carried = last.select("file", "block", of.alias("of"))
    named = some.join(carried, ["file", "block"]).withColumn("e", F.when(F.col("n") > 0, F.struct("block", "n")).otherwise(F.col("of")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq", "piece"))), lambda x: x["piece"]), ",")
    both = made.where("whole").select("file", F.col("piece").alias("entry")).unionByName(named.groupBy("file", "e").agg(text.alias("entry")).select("file", "entry"))
    return both.where(F.col("entry").rlike(r"\S"))


def keyed_objects(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Files of key -> {records: [...], is_normalized} as (key, is_normalized, record fields), read in pieces."""
    one = entries(spark, path).select(F.concat(F.lit("{"), F.col("entry"), F.lit("}")).alias("v"))
    return keyed_dictionary(one, "v", record)
