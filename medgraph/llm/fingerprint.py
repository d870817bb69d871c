"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits.

The distinct word shingles of a text are hashed once.  The hash picks a bin and a value in it;
each bin keeps its smallest value.  An empty bin borrows the value of a bin that a universal
hash of (bin, attempt) names, trying attempts until it meets a bin that was filled.  The low
`bits` bits of every bin are packed, most significant bin first, into a hexadecimal string.

Two fingerprints agree by chance in a share 2**-bits of the bins, so likeness is
(agreement - 2**-bits) / (1 - 2**-bits), held to 0..1.

A text with fewer words than the shingle takes all its words as one shingle; a text without
words (null, empty, or only separators) has a fingerprint of its own, all bits zero, that is
like itself (1) and like no other (0).  Repeated rows follow each other in the order of
neighbours by the hash of their text; a null id comes after every other id, so it is the first
in descending order.  Columns other than the id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, doc_id_of, keyed, mix, pack, released, rolling, slices, table, text_bytes, text_parts, unpack

BINS = 512
BITS = 4
SHINGLE = 5
#: Text bytes that one range of neighbours is sized for; beyond RANGES ranges they grow instead, so that what the driver knows of them is bounded.
RANGE_BYTES, RANGES = 8 << 20, 10_000
#: Characters and rows that are signed together at most.
FLUSH_CHARS, FLUSH_ROWS = 2 << 20, 2048
_EMPTY = np.uint64((1 << 64) - 1)


def shingle_hashes(texts: list[bytes], n: int, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, hash) of every shingle, and which texts have words; texts of fewer than n words give their whole sequence."""
    docs, hashes, some = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], np.zeros(len(texts), bool)
    for which, first, parts in text_parts(texts, n):
        words = Words(parts, lower)
        at = np.asarray(which)
        some[at[words.count > 0]] = True
        ok = words.same_doc(n)
        docs.append(at[words.doc[: len(ok)][ok]])
        hashes.append(words.grams(n)[ok])
        # only a whole text can have so few words: parts of longer ones hold n at least
        for i in np.flatnonzero((words.count > 0) & (words.count < n) & (np.asarray(first) == 0)).tolist():
            own = words.hash[words.first[i] : words.first[i] + words.count[i]]
            docs.append(at[i : i + 1])
            hashes.append(mix(rolling(own, len(own)) + np.uint64(len(own))))
    return np.concatenate(docs), np.concatenate(hashes), some


def densify(mins: np.ndarray, bins: int) -> np.ndarray:
    """Fills the empty bins of each row from bins that a universal hash of (bin, attempt) names."""
    filled = mins != _EMPTY
    some = filled.any(1)
    out = mins.copy()
    row, col = np.nonzero(~filled & some[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        at = (mix(col.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1)) % np.uint64(bins)).astype(np.int64)
        hit = filled[row, at]
        out[row[hit], col[hit]] = mins[row[hit], at[hit]]
        row, col = row[~hit], col[~hit]
    out[~some] = 0
    return out


def signatures(texts: list[bytes], bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Low bits of every bin (texts x bins, uint8), and which texts have words."""
    doc, h, some = shingle_hashes(texts, shingle)
    mins = np.full(len(texts) * bins, _EMPTY, np.uint64)
    slot = doc * bins + (h % np.uint64(bins)).astype(np.int64)
    value = mix(h) >> np.uint64(1)
    order = np.lexsort((value, slot))
    slot, value = slot[order], value[order]
    first = np.concatenate([[True], slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, bool)
    mins[slot[first]] = value[first]
    full = densify(mins.reshape(len(texts), bins), bins)
    return (mix(full) & np.uint64((1 << bits) - 1)).astype(np.uint8) * some[:, None].astype(np.uint8), some


def to_hex(low: np.ndarray, bits: int) -> list[str]:
    """The packed bits of each row."""
    planes = (low[:, :, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint8)) & 1
    return [r.tobytes().hex() for r in np.packbits(planes.reshape(len(low), -1), axis=1)]


def likeness(a: np.ndarray, a_some: np.ndarray, b: np.ndarray, b_some: np.ndarray, bits: int) -> np.ndarray:
    chance = 2.0**-bits
    agree = (a == b).mean(1)
    out = np.clip((agree - chance) / (1 - chance), 0, 1)
    return np.where(a_some & b_some, out, (a_some == b_some).astype(float))


def fingerprints(df: DataFrame, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint: the general form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in slices(b, 1, rows=FLUSH_ROWS):
                low, _ = signatures(texts, bins, bits, shingle)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(texts)), pa.array(to_hex(low, bits))], ["_ord", "fingerprint"])

    return keyed(df, id_col, text_col).select("_ord", "_text").mapInArrow(run, "_ord long, fingerprint string").select(doc_id_of().alias("doc_id"), "fingerprint")


def with_next(df: DataFrame, run, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Applies run(batches of (_ord, _z, _own)) to the rows of each id range in descending order, the first row of the range after it last.

    Ranges are cut at quantiles of the ids, found from the ids alone, so the text is shuffled once and no task holds more than its range; the row that opens a range is also
    sent to the range before, with _own false.  After the last range comes the first row of all.
    """
    rows = keyed(df, id_col, text_col)
    n = min(RANGES, max(1, -(-text_bytes(rows, "_text") // RANGE_BYTES)))
    cuts = np.array(sorted(set(rows.approxQuantile("_ord", [k / n for k in range(1, n)], 0.2 / n) if n > 1 else [])), np.float64)

    def ranges(ords: np.ndarray) -> np.ndarray:
        """0 for the largest ids; equal ids stay together."""
        return len(cuts) - np.searchsorted(cuts, ords.astype(np.float64), side="right")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ranges(b.column(0).to_numpy()), pa.int64())], ["_o", "_t", "_r"])

    places = rows.select("_ord", "_th").mapInArrow(placed, "_o long, _t long, _r long")
    heads = {r["_r"]: (r["h"]["_o"], r["h"]["_t"]) for r in places.groupBy("_r").agg(F.max(F.struct("_o", "_t")).alias("h")).collect()}
    live = sorted(heads)
    if not live:
        return rows.sparkSession.createDataFrame([], schema)
    closes = {heads[k]: live[i - 1] for i, k in enumerate(live)}  # the first head of all closes the last range

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for o, t, text, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), ranges(b.column(0).to_numpy()).tolist(), strict=True):
                z = pack(text.encode("utf-8"))
                out.append((r, True, o, t, z))
                if (o, t) in closes:
                    out.append((closes[o, t], False, o, t, z))
            if out:
                r, own, o, t, z = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(own), pa.array(o, pa.int64()), pa.array(t, pa.int64()), pa.array(z, pa.binary())], ["_r", "_own", "_ord", "_th", "_z"])

    sent = rows.select("_ord", "_th", "_text").mapInArrow(send, "_r long, _own boolean, _ord long, _th long, _z binary").repartition(len(live), "_r")
    return sent.sortWithinPartitions(F.col("_r"), F.col("_own").desc(), F.col("_ord").desc(), F.col("_th").desc()).select("_ord", "_z", "_own", "_r").mapInArrow(run, schema)


def edited(text: str, after: str) -> str:
    """text with its last half replaced by as many first characters of the text after it."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def compare_with_next(df: DataFrame, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller id; after the last comes the first.  A
    document alone in the table is its own next.
    """
    names = ["_ord", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def flush(ords: list[int], texts: list[str], after: str) -> pa.RecordBatch:
        nexts = [*texts[1:], after]
        changed = [edited(t, x).encode("utf-8") for t, x in zip(texts, nexts, strict=True)]
        own, own_some = signatures([*(t.encode("utf-8") for t in texts), after.encode("utf-8")], bins, bits, shingle)
        new, new_some = signatures(changed, bins, bits, shingle)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ords, pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(c).hexdigest() for c in changed]),
                pa.array(to_hex(own[:-1], bits)),
                pa.array(to_hex(new, bits)),
                pa.array(likeness(own[:-1], own_some[:-1], new, new_some, bits)),
                pa.array(likeness(own[:-1], own_some[:-1], own[1:], own_some[1:], bits)),
            ],
            names,
        )

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ords: list[int] = []
        texts: list[str] = []
        size, held = 0, None
        for b in batches:
            for o, z, own, r in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                t = unpack(z.as_py()).decode("utf-8")
                if texts and (r != held or not own or size >= FLUSH_CHARS or len(texts) >= FLUSH_ROWS):
                    # the head of the range after comes last in a range, and closes it
                    yield flush(ords, texts, t)
                    ords, texts, size = [], [], 0
                held = r
                if own:
                    ords.append(o)
                    texts.append(t)
                    size += len(t)
        if texts:
            raise AssertionError("a range ended without the row after it")

    schema = "_ord long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(df, run, schema, id_col, text_col).select(doc_id_of().alias("doc_id"), *names[1:])


def op4_one_permutation_minhash(spark, sf_dir: str) -> DataFrame:
    """Every document, its edited text and the next one.  Null text is empty; a null id is the first in descending order."""
    return compare_with_next(table(spark, sf_dir, "documents"))
