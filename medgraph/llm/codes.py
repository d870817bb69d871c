"""Vector code compression: product codes, with the candidates of every coarse cell memoised.

Vectors become integers, floor(scale * x), and are cut into equal consecutive parts.  Every part
position has a codebook of integer entries; a part's code is the index of its nearest entry by
squared Euclidean distance, ties to the lower index.

Search.  A position's space is cut into cells, boxes of a power of two wide.  A part is hashed to
its cell; the first part in a cell has the entries found that can be nearest anywhere in the box:
an entry whose least distance to the box is above another's greatest is dominated.  What is left
is remembered, and only those entries are evaluated for the parts of the cell.  At most MEMO cells
a position are remembered; then they are forgotten and found anew.  A worker keeps the cells of
the codebooks that it used last.

Codebooks start as the parts of the first `entries` vectors by id (null ids last, equal ids by
their integers) and are replaced `rounds` times by their parts' componentwise floor(sum / count);
unused entries stay.  Every task sums its parts by entry before the shuffle, and what comes to the
driver is a codebook: parts x entries x width sums, whatever the table's size.

Rows whose vector is null or holds null or non-finite components take no part.  Null ids and
repeated rows are rows like others.  Shorter vectors are filled with zeros up to the longest,
and that to a multiple of the parts.  Integers are held to +-LIMIT (beyond 262,144 at a scale of
256), so that no sum of squares overflows.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, released, table, with_values

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LIMIT = 1 << 26
#: Cells of a position that a worker remembers at most, and vectors that are coded together.
MEMO, TOGETHER = 1 << 16, 8192


def usable(df: DataFrame, id_col: str, vec_col: str, label_col: str | None) -> DataFrame:
    """_id, _label, _v: the rows that take part."""
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = df.select(F.col(id_col).cast("long").alias("_id"), label.alias("_label"), F.col(vec_col).cast("array<double>").alias("_v"))
    bad = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("_v").isNotNull() & ~bad)


def integers(vectors: pa.Array, width: int, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of list values, one row a vector, filled with zeros up to width."""
    size = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    whole = np.clip(np.floor(flat * scale), -LIMIT, LIMIT).astype(np.int64)
    out = np.zeros((len(size), width), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = whole
    return out


class Cells:
    """One position's codebook with the cells met so far."""

    def __init__(self, book: np.ndarray):
        self.book = book
        away = ((book[:, None] - book[None]) ** 2).sum(2).astype(np.float64)
        away[away == 0] = np.inf  # itself, and equal entries
        near = np.sqrt(away.min(1))
        near = near[np.isfinite(near)]
        # a box about as long in each dimension as half the usual distance between neighbours
        self.shift = int(max(0, np.floor(np.log2(np.median(near) / 2 / np.sqrt(book.shape[1]))) + 1)) if len(near) else 0
        self.forget()

    def forget(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.first, self.count, self.entries = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def learn(self, cells: np.ndarray, names: list[bytes]) -> None:
        """Remembers the entries that can be nearest somewhere in each box."""
        low = cells << self.shift
        high = low + (1 << self.shift) - 1
        least = np.zeros((len(cells), len(self.book)), np.int64)
        most = least.copy()
        for j in range(self.book.shape[1]):
            c, a, b = self.book[:, j], low[:, j, None], high[:, j, None]
            least += np.maximum(np.maximum(a - c, c - b), 0) ** 2
            most += np.maximum(np.abs(a - c), np.abs(b - c)) ** 2
        row, entry = np.nonzero(least <= most.min(1)[:, None])
        n = np.bincount(row, minlength=len(cells))
        self.slot.update(zip(names, range(len(self.first), len(self.first) + len(cells)), strict=True))
        self.first = np.concatenate([self.first, len(self.entries) + np.cumsum(n) - n])
        self.count = np.concatenate([self.count, n])
        self.entries = np.concatenate([self.entries, entry.astype(np.int32)])

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of every part's nearest entry."""
        cells = parts >> self.shift
        packed = np.ascontiguousarray(cells.astype(np.int32))
        key = packed.view(np.dtype((np.void, packed.itemsize * packed.shape[1]))).ravel()
        _, at, which = np.unique(key, return_index=True, return_inverse=True)
        names = [packed[i].tobytes() for i in at.tolist()]
        fresh = [k for k, x in enumerate(names) if x not in self.slot]
        if fresh and len(self.slot) + len(fresh) > MEMO:
            self.forget()
            fresh = list(range(len(names)))
        if fresh:
            self.learn(cells[at[fresh]], [names[k] for k in fresh])
        slot = np.fromiter((self.slot[x] for x in names), np.int64, len(names))[which.ravel()]
        n = self.count[slot]
        ends = np.cumsum(n)
        row = np.repeat(np.arange(len(parts)), n)
        entry = self.entries[np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(self.first[slot], n)]
        away = ((parts[row] - self.book[entry]) ** 2).sum(1)
        best = np.minimum.reduceat(away, ends - n)
        hit = np.flatnonzero(away == best[row])  # entries of a cell are in order, so the first hit is the lower index
        one = hit[np.concatenate([[True], row[hit][1:] != row[hit][:-1]])]
        return entry[one], best


_last: dict[str, list[Cells]] = {}


def cells_of(books: np.ndarray) -> list[Cells]:
    """The cells of some codebooks, kept in this worker until others are used."""
    name = hashlib.sha256(books.tobytes() + str(books.shape).encode()).hexdigest()
    if name not in _last:
        _last.clear()
        _last[name] = [Cells(b) for b in books]
    return _last[name]


def assigned(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared distances) of integer vectors, rows x parts."""
    parts, wide = len(books), books.shape[2]
    code, away = np.empty((len(vectors), parts), np.int64), np.empty((len(vectors), parts), np.int64)
    for at in range(0, len(vectors), TOGETHER):
        for p, cells in enumerate(cells_of(books)):
            code[at : at + TOGETHER, p], away[at : at + TOGETHER, p] = cells.nearest(vectors[at : at + TOGETHER, p * wide : (p + 1) * wide])
    return code, away


def _replaced(rows: DataFrame, books: np.ndarray, scale: int) -> np.ndarray:
    """Codebooks of the floored means of the parts assigned to each entry."""
    parts, entries, wide = books.shape

    @released
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts * entries, wide), np.int64), np.zeros(parts * entries, np.int64)
        for b in batches:
            if b.num_rows:
                x = integers(b.column(0), parts * wide, scale)
                code = assigned(x, books)[0] + np.arange(parts) * entries
                np.add.at(total, code.ravel(), x.reshape(-1, wide))
                count += np.bincount(code.ravel(), minlength=len(count))
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(used, wide)), pa.array(np.tile(np.arange(wide), len(used))), pa.array(total[used].ravel()), pa.array(np.repeat(count[used], wide))], ["e", "k", "s", "n"])

    got = rows.select("_v").mapInArrow(sums, "e long, k long, s long, n long").groupBy("e", "k").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    new = books.copy()
    for r in got:
        new[r["e"] // entries, r["e"] % entries, r["k"]] = r["s"] // r["n"]
    return new


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray | None:
    """Codebooks (parts x entries x width) of usable rows; None for an empty table, fewer entries if there are fewer rows."""
    longest = rows.agg(F.max(F.size("_v")).alias("n")).first()["n"]
    if longest is None:
        return None
    wide = max(1, -(-longest // parts))
    whole = F.transform("_v", lambda x: F.greatest(F.least(F.floor(x * scale), F.lit(LIMIT)), F.lit(-LIMIT)))
    first = rows.select("_id", whole.alias("_w"), "_v").orderBy(F.asc_nulls_last("_id"), "_w").limit(entries).select("_v").toArrow()
    start = integers(first.column(0).combine_chunks(), parts * wide, scale)
    books = np.ascontiguousarray(start.reshape(len(start), parts, wide).transpose(1, 0, 2))
    for _ in range(rounds):
        books = _replaced(rows, books, scale)
    return books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """_id, _label, code (two hex digits a part, four beyond 256 entries), error (squared distances, summed) of usable rows."""
    parts, entries, wide = books.shape
    kind = ">u1" if entries <= 256 else ">u2"

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                code, away = assigned(integers(b.column(2), parts * wide, scale), books)
                text = [x.tobytes().hex() for x in np.ascontiguousarray(code.astype(kind))]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text), pa.array(away.sum(1))], ["_id", "_label", "code", "error"])

    label = rows.schema["_label"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id long, _label {label}, code string, error long")


def decode(codes: DataFrame, books: np.ndarray, scale: int = SCALE, code_col: str = "code") -> DataFrame:
    """codes with column decoded (array<double>): the entries that a code names, over the scale."""
    parts, entries, _ = books.shape
    digits = 2 if entries <= 256 else 4
    at = [F.conv(F.substring(code_col, 1 + digits * p, digits), 16, 10).cast("int") + 1 for p in range(parts)]
    held = [F.array(*[F.array(*map(F.lit, (e / scale).tolist())) for e in book]) for book in books]
    return codes.withColumn("decoded", F.flatten(F.array(*[F.element_at(h, i) for h, i in zip(held, at, strict=True)])))


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error (error summed over equal labels, nulls together), codebooks_sha256 (the last codebooks' integers by part, entry and place)."""
    rows = usable(df, id_col, vec_col, label_col)
    books = fit(rows, parts, entries, rounds, scale)
    if books is None:
        return df.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = materialize(encode(rows, books, scale))
    sums = coded.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n"))
    return with_values(coded, sums, "_label", "_n").select(F.col("_id").alias("vec_id"), "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def op11_vector_code_compression(spark, sf_dir: str) -> DataFrame:
    """embeddings: 16 parts, 64 entries, two rounds."""
    return compress(table(spark, sf_dir, "embeddings"))
