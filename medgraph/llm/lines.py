"""Line dedup on content-defined chunks.

A text is its lines, parted by newlines.  A rolling hash over the hashes of the last `span`
lines ends a chunk where it is 0 modulo `divisor` (never before `least` lines, always after
`most`), so chunk boundaries move with the lines around them, not with their place in the text.
A chunk of at least two lines that occurs more than once, anywhere, is removed everywhere but
where it comes first (smallest id, then text hash, then line).  Chunks meet under a 128-bit hash
and are compared byte by byte before one is removed.

Null and empty texts have no lines.  Chunks without a visible character stay.  A null id comes
after every other; rows that repeat id and text are the same place, so neither loses a line to
the other.  Long texts are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_id_of, keyed, materialize, pack, pack_text_column, released, rewritten, table, unpack

SPAN, DIVISOR, LEAST, MOST = 2, 2, 2, 16
#: A chunk is hot if at least one document in so many holds it; its rows are dealt to so many keys.
HOT_SHARE, SALTS = 200, 64
_MASK = (1 << 64) - 1


def line_hash(line: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(line, digest_size=8).digest(), "little")


def chunks(lines: list[bytes], span: int = SPAN, divisor: int = DIVISOR, least: int = LEAST, most: int = MOST) -> list[tuple[int, int]]:
    """(first line, lines) of the content-defined chunks."""
    base = 0x9E3779B97F4A7C15
    drop = pow(base, span, 1 << 64)
    out, begin, roll = [], 0, 0
    hashes = [line_hash(x) for x in lines]
    for i, h in enumerate(hashes):
        roll = (roll * base + h) & _MASK
        if i >= span:
            roll = (roll - hashes[i - span] * drop) & _MASK
        size = i + 1 - begin
        if size >= least and ((roll >> 17) % divisor == 0 or size >= most):
            out.append((begin, size))
            begin = i + 1
    if begin < len(lines):
        out.append((begin, len(lines) - begin))
    return out


def lines_of(raw: bytes) -> list[bytes]:
    return raw.split(b"\n") if raw else []


def chunk_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_ord, _th, _at (first line), _n and _k (hash) of every chunk of two lines or more."""
    names = ["_ord", "_th", "_at", "_n", "_k"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for o, t, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                lines = lines_of(text.as_py().encode("utf-8"))
                for at, n in chunks(lines):
                    raw = b"\n".join(lines[at : at + n])
                    if n >= 2 and raw.strip():
                        out.append((o, t, at, n, hashlib.blake2b(raw, digest_size=16).digest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return keyed(docs, id_col, text_col).mapInArrow(run, "_ord long, _th long, _at int, _n int, _k binary")


def with_bytes(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """found (_ord, _th, _at, _n, _k, _is_first, _salts) with _z, the packed bytes of its chunks; equal rows count once."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, packed = [], []
            for o, t, z, many in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                lines = lines_of(unpack(z.as_py()))
                for r in many:
                    rows.append({"_ord": o, "_th": t, **r})
                    packed.append(pack(b"\n".join(lines[r["_at"] : r["_at"] + r["_n"]])))
            if rows:
                made = pa.RecordBatch.from_pylist(rows, kinds)
                yield pa.RecordBatch.from_arrays([*made.columns, pa.array(packed, pa.binary())], [*kinds.names, "_z"])

    kinds = pa.schema([("_ord", pa.int64()), ("_th", pa.int64()), ("_at", pa.int32()), ("_n", pa.int32()), ("_k", pa.binary()), ("_is_first", pa.bool_()), ("_salts", pa.int32())])
    per_doc = found.groupBy("_ord", "_th").agg(F.collect_set(F.struct("_at", "_n", "_k", "_is_first", "_salts")).alias("_many"))
    some = pack_text_column(keyed(docs, id_col, text_col)).join(per_doc, ["_ord", "_th"]).select("_ord", "_th", "_z", "_many")
    return some.mapInArrow(run, "_ord long, _th long, _at int, _n int, _k binary, _is_first boolean, _salts int, _z binary")


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_ord, _th, _at, _n of every chunk to remove.

    A chunk that one document in HOT_SHARE holds is hot.  There are at most HOT_SHARE times as many
    hot chunks as a document has chunks on average, at any size, so their first places are
    broadcast, and the rows of one hot chunk are dealt to SALTS keys where bytes are compared.
    Bytes are cut out of the texts only of chunks that are repeated.
    """
    place = F.struct("_ord", "_th", "_at")
    firsts = materialize(chunk_rows(docs, id_col, text_col).groupBy("_k").agg(F.min(place).alias("_first"), F.count("*").alias("_times")).where("_times > 1"))
    least = max(100, docs.count() // HOT_SHARE)
    hot = firsts.where(F.col("_times") >= least).select("_k", F.col("_first").alias("_hot"))
    # hot rows get a key of their own in the shuffled join, so that they do not meet in one task
    own = F.when(F.col("_hot").isNull(), F.col("_k")).otherwise(F.encode(F.concat_ws("/", "_ord", "_th", "_at"), "utf-8"))
    rows = chunk_rows(docs, id_col, text_col).join(F.broadcast(hot), "_k", "left").withColumn("_j", own)
    cold = firsts.where(F.col("_times") < least).select(F.col("_k").alias("_j"), F.col("_first").alias("_cold"))
    both = rows.join(cold, "_j", "left").withColumn("_first", F.coalesce("_hot", "_cold")).where("_first is not null")
    salts = F.when(F.col("_hot").isNull(), F.lit(1)).otherwise(F.lit(SALTS))
    which = both.select("_ord", "_th", "_at", "_n", "_k", (place == F.col("_first")).alias("_is_first"), salts.alias("_salts"))
    found = materialize(with_bytes(docs, which, id_col, text_col))
    salt = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt")
    kept = found.where("_is_first").dropDuplicates(["_k"]).select("_k", F.col("_z").alias("_b"), salt)
    again = found.where("not _is_first").withColumn("_salt", F.pmod(F.xxhash64("_ord", "_th", "_at"), F.col("_salts")).cast("int"))
    same = again.join(kept, ["_k", "_salt"]).where(F.col("_z") == F.col("_b"))  # equal bytes pack to equal bytes
    return same.select("_ord", "_th", "_at", "_n")


def gone_lines(n: int, runs: list) -> np.ndarray:
    gone = np.zeros(n, bool)
    for r in runs:
        gone[r["_at"] : r["_at"] + r["_n"]] = True
    return gone


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_ord, n_lines, n_removed, n_chunks_removed, kept_sha256 (of the lines left, joined by newlines)."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for o, z, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                lines = lines_of(unpack(z.as_py()))
                gone = gone_lines(len(lines), runs or [])
                kept = b"\n".join(x for x, g in zip(lines, gone.tolist(), strict=True) if not g)
                out.append((o, len(lines), int(gone.sum()), len({r["_at"] for r in runs or []}), hashlib.sha256(kept).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["_ord", "n_lines", "n_removed", "n_chunks_removed", "kept_sha256"])

    per_doc = repeated_chunks(docs, id_col, text_col).groupBy("_ord", "_th").agg(F.collect_list(F.struct("_at", "_n")).alias("_runs"))
    found = pack_text_column(keyed(docs, id_col, text_col)).join(per_doc, ["_ord", "_th"], "left")
    return found.select("_ord", "_z", "_runs").mapInArrow(run, "_ord long, n_lines long, n_removed long, n_chunks_removed long, kept_sha256 string")


def strip_repeats(docs: DataFrame) -> DataFrame:
    """docs without the removed lines; rows of which nothing visible is left go."""

    def cut(raw: bytes, runs: list) -> bytes:
        lines = lines_of(raw)
        return b"\n".join(x for x, g in zip(lines, gone_lines(len(lines), runs).tolist(), strict=True) if not g)

    return rewritten(docs, repeated_chunks(docs), cut)


def op8_line_chunk_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document: lines, lines and chunks removed, and the hash of what is left.  Null text has no lines."""
    return dedup(table(spark, sf_dir, "documents")).select(doc_id_of().alias("doc_id"), "n_lines", "n_removed", "n_chunks_removed", "kept_sha256")
