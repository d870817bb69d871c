"""Helpers that the corpus operators share: reading, row keys, shared-folder tables, packed text slices.

Row keys.  A document is addressed by ``(_ord, _th)``: ``_ord`` is the document id with null
mapped to the largest long (a null id is later than any other), ``_th`` the 64-bit hash of the
text.  Rows that repeat both are the same text under the same id, so whatever an operator decides
about one holds for the other.
"""

from __future__ import annotations

import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_LONG = (1 << 63) - 1
#: Bytes and rows of text that are packed together at most, unless a single document is longer.
SLICE_BYTES, SLICE_ROWS = 3 << 20, 4096
#: Bytes of text that one numpy pass takes at most; longer texts are read in parts.
PASS_BYTES = 1 << 18

#: The bytes that separate words in the contract pattern [^\x20\x09-\x0D]+.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_SEPARATOR = re.compile(b"[" + re.escape(bytes(SEPARATORS)) + b"]")
IS_SEP = np.zeros(256, bool)
IS_SEP[list(SEPARATORS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
#: Codes inside words: separators count nothing.
WORD_CODE = np.where(IS_SEP, np.uint64(0), BYTE_CODE)
LOWER_CODE = WORD_CODE[LOWER]
_BASE = 0x9E3779B97F4A7C15 | 1
#: Weights of the bytes of a word by place, beginning anew every 4096 bytes.
PLACE = np.array([pow(_BASE, k, 1 << 64) for k in range(4096)], np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, which every executor sees; a folder of its own only for a local session without one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _own.append(at := _own[0] if _own else tempfile.mkdtemp(prefix="spark-"))
    return at


#: Rows of documents that go to a Python worker at once.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lets the session send at most BATCH_ROWS rows to a Python worker at once, if it sends more.

    The usual 10,000 documents are some 20 MB in each of the buffers of the JVM and the worker.  The
    setting is read when a query runs, so it stays.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def materialize(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/medgraph-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key is hot if it holds more than one of so many rows; so there are fewer hot keys than this.
HOT_SHARE = 1000


def with_values(rows: DataFrame, values: DataFrame, key: str, count: str) -> DataFrame:
    """rows with the columns of values (one row a key; count: the key's rows) but key and count; null equals null.

    Hot keys, fewer than HOT_SHARE, are broadcast, so no task gets all rows of one; the rest are
    joined by hash.  Both tables are read more than once: hand over written ones, or cheap ones.
    """
    values = materialize(values)
    total = values.agg(F.sum(count).alias("n")).first()["n"] or 0
    fields = [c for c in values.columns if c not in (key, count)]
    held = values.select(F.col(key).alias("_key"), F.struct(*fields).alias("_values"), (F.col(count) * HOT_SHARE > total).alias("_hot"))
    same = F.col(key).eqNullSafe(F.col("_key"))
    hot = F.broadcast(held.where("_hot").drop("_hot"))
    cold = held.where("not _hot").drop("_hot")
    both = rows.join(hot, same).unionByName(rows.join(hot, same, "left_anti").join(cold, same))
    return both.select(*rows.columns, "_values.*")


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_ord, _th, _text): the row key and the text, null text as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(MAX_LONG)).alias("_ord"),
        F.xxhash64(text).alias("_th"),
        text.alias("_text"),
    )


def doc_id_of(col: str = "_ord"):
    """The document id that a row key stands for."""
    return F.when(F.col(col) == MAX_LONG, F.lit(None).cast("long")).otherwise(F.col(col))


def packed_rows(docs: DataFrame) -> DataFrame:
    """_ord, _th, _z (text, compressed before it is shuffled; null stays null) and _row, the other columns of docs."""

    @F.arrow_udf("binary")
    def packed(texts: pa.Array) -> pa.Array:
        return pa.array([None if t.as_py() is None else pack(t.as_py().encode("utf-8")) for t in texts], pa.binary())

    th = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    row = F.struct(*[c for c in docs.columns if c != "text"])
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(MAX_LONG)).alias("_ord"), th.alias("_th"), packed("text").alias("_z"), row.alias("_row"))


def rewritten(docs: DataFrame, runs: DataFrame, cut, rows: DataFrame | None = None) -> DataFrame:
    """docs with text cut by cut(bytes, runs) where runs (_ord, _th, ...) has rows for it, and n_chars renewed.

    A text of which nothing but white space is left goes; every other row stays as it was.  rows:
    packed_rows(docs), for runs that are made of them too.
    """
    fields = [c for c in runs.columns if c not in ("_ord", "_th")]
    per_doc = runs.groupBy("_ord", "_th").agg(F.collect_list(F.struct(*fields)).alias("_runs"))

    @F.arrow_udf("string")
    def cut_all(packed_texts: pa.Array, runs: pa.Array) -> pa.Array:
        out = []
        for z, r in zip(packed_texts, runs, strict=True):
            raw = None if z.as_py() is None else unpack(z.as_py())
            out.append(raw if raw is None or r.as_py() is None else cut(raw, r.as_py()))
        made = pa.array(out, pa.binary()).cast(pa.string())
        del out
        release()
        return made

    joined = (packed_rows(docs) if rows is None else rows).join(per_doc, ["_ord", "_th"], "left")
    new = joined.withColumn("_new", cut_all("_z", "_runs"))
    kept = new.where(F.col("_runs").isNull() | F.col("_new").rlike(r"\S"))
    chars = F.when(F.col("_runs").isNull(), F.col("_row.n_chars")).otherwise(F.length("_new")).cast("long") if "n_chars" in docs.columns else None
    made = {"text": F.col("_new"), "n_chars": chars}
    return kept.select(*[made[c].alias(c) if c in made else F.col("_row")[c].alias(c) for c in docs.columns])


def text_bytes(df: DataFrame, text_col: str = "text") -> int:
    """Total bytes of text, one small aggregate; sizes the number of buckets."""
    got = df.agg(F.sum(F.octet_length(F.col(text_col))).alias("n")).first()["n"]
    return int(got or 0)


def buckets_for(total_bytes: int, per_bucket: int, least: int = 16) -> int:
    """Buckets so that each holds about per_bucket bytes at any corpus size."""
    return max(least, -(-total_bytes // per_bucket))


class _Codecs:
    """zstd contexts, made once in each Python worker."""

    c: dict[int, zstandard.ZstdCompressor] = {}
    d = None


def pack(data: bytes, level: int = 1) -> bytes:
    if level not in _Codecs.c:
        _Codecs.c[level] = zstandard.ZstdCompressor(level=level, write_checksum=False)
    return _Codecs.c[level].compress(data)


def unpack(data: bytes) -> bytes:
    if _Codecs.d is None:
        _Codecs.d = zstandard.ZstdDecompressor()
    return _Codecs.d.decompress(data)


def pack_parts(*parts: bytes, level: int = 1) -> bytes:
    """Several byte strings as one compressed value."""
    head = np.array([len(parts), *(len(p) for p in parts)], "<i8").tobytes()
    return pack(head + b"".join(parts), level)


def unpack_parts(data: bytes) -> list[bytes]:
    raw = unpack(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes = np.frombuffer(raw, "<i8", n, 8)
    out, at = [], 8 * (n + 1)
    for s in sizes:
        out.append(raw[at : at + int(s)])
        at += int(s)
    return out


def pack_text_column(df: DataFrame) -> DataFrame:
    """(_ord, _th, _z): keyed texts, compressed before they are shuffled or spilled."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = [pack(t.as_py().encode("utf-8")) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(z, pa.binary())], ["_ord", "_th", "_z"])

    return df.select("_ord", "_th", "_text").mapInArrow(run, "_ord long, _th long, _z binary")


def slices(batch: pa.RecordBatch, col: int, most: int = SLICE_BYTES, rows: int = SLICE_ROWS, read=None) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive rows, at most `rows`, whose texts hold at most `most` bytes (or one longer text): first row and the UTF-8 texts, as `read` makes them of the column."""
    first, size, texts = 0, 0, []
    for i, t in enumerate(batch.column(col)):
        raw = t.as_py()
        raw = b"" if raw is None else raw.encode("utf-8") if isinstance(raw, str) else raw if read is None else read(raw)
        if texts and (size + len(raw) > most or len(texts) >= rows):
            yield first, texts
            first, size, texts = i, 0, []
        texts.append(raw)
        size += len(raw)
    if texts:
        yield first, texts


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # not glibc
    _trim = None


def release() -> None:
    """Gives freed memory back to the system: a reused worker would keep it for the stages after."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def released(run):
    """A function over batches, or over one group, that releases what it used when it ends."""

    @functools.wraps(run)
    def over_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    @functools.wraps(run)
    def over_group(group: pa.Table) -> pa.Table:
        try:
            return run(group)
        finally:
            release()

    return over_group if "group" in run.__code__.co_varnames[: run.__code__.co_argcount] else over_batches


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive codes, put together from runs of 1, 2, 4 ... codes."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    have, cur, done, out = 1, codes, 0, None
    while True:
        up = np.uint64(pow(_BASE, have, 1 << 64))
        if n & have:
            m = len(codes) - done - have + 1
            out = cur if out is None else out[:m] * up + cur[done : done + m]
            done += have
        if done == n:
            return mix(out + np.uint64(n))
        m = len(codes) - 2 * have + 1
        cur = cur[:m] * up + cur[have : have + m]
        have *= 2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    if len(x) < w:
        return x[:0]
    n, have, cur = len(x) - w + 1, 1, x
    while 2 * have <= w:
        cur = np.minimum(cur[:-have], cur[have:])
        have *= 2
    return cur if have == w else np.minimum(cur[:n], cur[w - have : w - have + n])


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of the (lower-cased) bytes of every word, in passes of about PASS_BYTES."""
    out = np.empty(len(start), np.uint64)
    code = LOWER_CODE if lower else WORD_CODE
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + PASS_BYTES)))
        first = start[i:j] - start[i]
        size = np.diff(np.append(first, end[j - 1] - start[i]))
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        out[i:j] = np.add.reduceat(code[buf[start[i] : end[j - 1]]] * PLACE[place & 4095], first)
        i = j
    return mix(out + (end - start).astype(np.uint64))


class Words:
    """The words of some texts, with 64-bit hashes.

    Words are maximal runs of bytes other than SEPARATORS; texts never share a word.
    doc: index of the word's text; start/end: byte span in buf; hash: of the (lower-cased) bytes.
    Takes some 8 bytes for a byte of text: hand long texts over in parts (text_parts).
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts)) + 1
        text_start = np.cumsum(sizes) - sizes
        sep = IS_SEP[self.buf]
        edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1  # the last byte is a separator
        if len(sep) and not sep[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.hash = word_hashes(self.buf, self.start, self.end, lower)
        self.first = np.searchsorted(self.start, text_start)
        self.count = np.diff(np.append(self.first, len(self.start)))
        self.doc = np.repeat(np.arange(len(texts)), self.count)

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on (spans over two texts included; mask with same_doc)."""
        return rolling(self.hash, n)

    def same_doc(self, n: int) -> np.ndarray:
        """Whether the n words from each word on are of one text."""
        return self.doc[: len(self.doc) - n + 1] == self.doc[n - 1 :] if len(self.doc) >= n else np.zeros(0, bool)


def text_parts(texts: list[bytes], window: int, most: int = PASS_BYTES) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Batches of (text index, word index of the first word, bytes) of about `most` bytes.

    A longer text comes in parts that overlap by window - 1 words, so that each run of `window`
    words is in exactly one part.
    """
    which, first, parts, size = [], [], [], 0
    for i, raw in enumerate(texts):
        at = word = 0
        while True:
            part, n, step, end = None, 0, 0, at + most
            while end < len(raw):
                found = _SEPARATOR.search(raw, end)
                if not found:
                    break
                end = found.start()
                sep = IS_SEP[np.frombuffer(raw, np.uint8, end - at, at)]
                starts = np.flatnonzero(~sep & np.concatenate([[True], sep[:-1]]))
                if len(starts) >= window:
                    part, n = raw[at:end], len(starts) - window + 1
                    step = int(starts[n]) if n < len(starts) else end - at
                    break
                end += most
            part = raw[at:] if part is None else part
            if parts and size + len(part) > most:
                yield which, first, parts
                which, first, parts, size = [], [], [], 0
            which.append(i)
            first.append(word)
            parts.append(part)
            size += len(part)
            if not n:
                break
            at, word = at + step, word + n
    if parts:
        yield which, first, parts
