"""Approximate nearest neighbours by inner product: an adaptive dimension scan over inverted lists.

Index.  Centres are fitted by k-means on a bounded sample (SAMPLE vectors taken
by hash of the id); every vector goes to the list of its nearest centre and is stored rotated by
one random orthogonal matrix, dimension by dimension, in blocks of at most BLOCK vectors, so a
large list is many blocks.

Search.  A query probes the lists of its nearest centres, a share of all lists, and those of its
nearest vectors in the sample: in data without clear clusters neighbours lie in many lists, and what makes a scan cheap is that most candidates
are left early.  A block meets up to QUERIES queries at once.  The rotated dimensions are read
in columns of COLUMN; after each, the squared distance so far, scaled up, estimates the whole,
and the hypothesis that the candidate still beats the query's bound is tested with an error
factor that shrinks as more dimensions are seen.  Candidates that fail are abandoned.  The bound
is a product that enough vectors of the sample reach; norms turn it into one on the distance.
Survivors get their exact inner product on the original vectors in double precision, and a
block's best by it are merged over all blocks.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, as
candidates or queries; so do null ids.  Vectors of another length than the most common one take
no part either.  Rows that repeat an id are candidates of their own; a query's own id is never
among its results.  Ties go to the smaller id.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pack_parts, table, unpack_parts

K = 20
SAMPLE = 16_384
BLOCK = 2048
QUERIES = 256
COLUMN = 16
EPSILON = 2.1
#: Mean vectors in a list, the share of the lists that a query probes, and the most lists.
LIST_SIZE = 512
PROBE_SHARE = 0.7
#: The bound of a query is the product that SPARE times k vectors of the sample reach; their lists are probed, so k are found.
SPARE = 3
MAX_LISTS = 1024


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """_id, _v (array<double>): the vectors that take part."""
    v = F.col("_v")
    rows = df.select(F.col(id_col).cast("long").alias("_id"), F.col(vec_col).cast("array<double>").alias("_v"))
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(finite & F.exists(v, lambda x: x != 0))


def fit(rows: DataFrame, seed: int = 7) -> dict | None:
    """Centres and rotation from a bounded sample."""
    sizes = rows.groupBy(F.size("_v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return None
    dim, total = sizes[0]["d"], sizes[0]["count"]
    share = min(1.0, 2.0 * SAMPLE / total)
    drawn = rows.where((F.size("_v") == dim) & (F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1))
    x = np.array([r["_v"] for r in drawn.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE).collect()])
    rng = np.random.default_rng(seed)
    lists = int(np.clip(total // LIST_SIZE, 1, min(MAX_LISTS, max(1, len(x) // 8))))
    distinct = np.unique(x, axis=0)
    lists = min(lists, len(distinct))
    centres = distinct[rng.permutation(len(distinct))[:lists]]
    for _ in range(12):
        near = (2 * x @ centres.T - (centres**2).sum(1)).argmax(1)
        count = np.bincount(near, minlength=lists)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    return {"dim": dim, "centres": centres, "rotation": rotation, "sample": x.astype(np.float32), "sample_list": (2 * x @ centres.T - (centres**2).sum(1)).argmax(1)}


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _index(model: dict):
    """Blocks of lists: _list, packed (ids, original vectors, rotated columns, squared norms)."""
    dim, centres, rotation = model["dim"], model["centres"], model["rotation"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, x = b.column(0).to_numpy(), _vectors(b.column(1), dim)
            near = (2 * x @ centres.T - (centres**2).sum(1)).argmax(1)
            order = np.argsort(near, kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], np.diff(near[order]) != 0, [True]]))
            lists, out = [], []
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                for a in range(s, e, BLOCK):
                    i = order[a : min(a + BLOCK, e)]
                    lists.append(int(near[i[0]]))
                    out.append(pack_parts(ids[i].tobytes(), x[i].tobytes(), np.ascontiguousarray((x[i] @ rotation).T.astype("<f4")).tobytes(), (x[i] ** 2).sum(1).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int64()), pa.array(out, pa.binary())], ["_list", "_block"])

    return run


def _probe(model: dict, share: float, k: int):
    """Queries by list: _list, packed (ids, vectors, bounds), at most QUERIES in a row."""
    dim, centres, sample = model["dim"], model["centres"], model["sample"]
    probes = max(1, min(len(centres), int(np.ceil(share * len(centres)))))

    def bounds(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A product that SPARE * k vectors other than the query itself reach, and where in the sample they are; the sample may hold the query, so one more is asked."""
        at = len(sample) - SPARE * k - 1
        if at < 0:
            return np.full(len(x), -np.inf), np.zeros((len(x), 0), np.int64)
        near = x.astype(np.float32) @ sample.T
        top = np.argpartition(near, at, axis=1)[:, at:]
        return np.take_along_axis(near, top[:, :1], axis=1)[:, 0] - 1e-4 * np.abs(x).max(1), top

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                ids, x = part.column(0).to_numpy(), _vectors(part.column(1), dim)
                bound, top = bounds(x)
                probe = np.zeros((len(ids), len(centres)), bool)
                rows = np.arange(len(ids))[:, None]
                probe[rows, np.argpartition(-(2 * x @ centres.T - (centres**2).sum(1)), probes - 1, axis=1)[:, :probes]] = True
                probe[rows, model["sample_list"][top]] = True
                who, by = np.nonzero(probe)
                order = np.argsort(by, kind="stable")
                edges = np.flatnonzero(np.concatenate([[True], np.diff(by[order]) != 0, [True]]))
                lists, out = [], []
                for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    for a in range(s, e, QUERIES):
                        i = who[order[a : min(a + QUERIES, e)]]
                        lists.append(int(by[order[s]]))
                        out.append(pack_parts(ids[i].tobytes(), x[i].tobytes(), bound[i].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int64()), pa.array(out, pa.binary())], ["_list", "_queries"])

    return run


def scan_block(q: np.ndarray, q_rot: np.ndarray, own: np.ndarray, bound: np.ndarray, ids: np.ndarray, x: np.ndarray, columns: np.ndarray, norms: np.ndarray, k: int, epsilon: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, candidate index, exact product) of a block's best k for each query, by the adaptive scan."""
    dim = len(columns)
    most = ((q**2).sum(1) - 2 * np.maximum(bound, -1e30))[:, None] + norms[None, :]  # squared distance of a candidate that just reaches the bound
    most = np.maximum(most, 0).astype(np.float32)
    part = np.zeros((len(q), len(ids)), np.float32)
    qi = vi = None
    for at in range(0, dim, COLUMN):
        to = min(at + COLUMN, dim)
        c, r = columns[at:to], q_rot[:, at:to]
        factor = np.float32((to / dim) * (1 + epsilon / np.sqrt(to)) ** 2) if to < dim else np.float32(1.0)
        if qi is None:
            part += (r**2).sum(1)[:, None] + (c**2).sum(0)[None, :] - 2 * (r @ c)
            keep = part <= most * factor + np.float32(1e-3)
            if to == dim or keep.mean() < 0.2:
                qi, vi = np.nonzero(keep)
                left = part[qi, vi]
        else:
            left = left + ((r[qi] - c[:, vi].T) ** 2).sum(1)
            keep = left <= most[qi, vi] * factor + np.float32(1e-3)
            qi, vi, left = qi[keep], vi[keep], left[keep]
    other = ids[vi] != own[qi]
    qi, vi = qi[other], vi[other]
    score = np.einsum("ij,ij->i", q[qi], x[vi])
    order = np.lexsort((ids[vi], -score, qi))
    qi, vi, score = qi[order], vi[order], score[order]
    first = np.searchsorted(qi, qi, side="left")
    top = np.arange(len(qi)) - first < k
    return qi[top], vi[top], score[top]


def _scan(model: dict, k: int, epsilon: float):
    rotation, dim = model["rotation"].astype(np.float32), model["dim"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blk, qs in zip(b.column(0), b.column(1), strict=True):
                p, r = unpack_parts(blk.as_py()), unpack_parts(qs.as_py())
                ids, x = np.frombuffer(p[0], "<i8"), np.frombuffer(p[1], "<f8").reshape(-1, dim)
                columns, norms = np.frombuffer(p[2], "<f4").reshape(dim, -1), np.frombuffer(p[3], "<f8")
                q_ids, q = np.frombuffer(r[0], "<i8"), np.frombuffer(r[1], "<f8").reshape(-1, dim)
                qi, vi, score = scan_block(q, q.astype(np.float32) @ rotation, q_ids, np.frombuffer(r[2], "<f8"), ids, x, columns, norms, k, epsilon)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[qi], pa.int64()), pa.array(ids[vi], pa.int64()), pa.array(score, pa.float64())], ["query_id", "vec_id", "score"])

    return run


def search(df: DataFrame, is_query, k: int = K, probe_share: float = PROBE_SHARE, epsilon: float = EPSILON, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every row where is_query holds (a column over id_col)."""
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col)
    model = fit(rows)
    if model is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("_v") == model["dim"])
    blocks = rows.mapInArrow(_index(model), "_list long, _block binary")
    asked = rows.where(is_query(F.col("_id"))).dropDuplicates(["_id"]).mapInArrow(_probe(model, probe_share, k), "_list long, _queries binary")
    pairs = blocks.join(asked, "_list").select("_block", "_queries")
    found = pairs.mapInArrow(_scan(model, k, epsilon), "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_adaptive_dimension_scan(spark, sf_dir: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 20."""
    return search(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)
