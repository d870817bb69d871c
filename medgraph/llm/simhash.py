"""SimHash near-duplicates: majority fingerprints of word shingles, linked by BK-trees of bounded shards.

Fingerprints.  A text is lower-cased (A to Z), cut into words and shingles of SHINGLE words,
repeats included, joined by spaces; fewer words give their whole sequence.  A bit is 1 if more
than half of the shingles' XXH64 values (seed 42) have it.  A text without words (null, empty,
only separators) has fingerprint zero and is linked like any other.

Links.  Fingerprints link if at most RADIUS bits differ.  Equal ones are one class from the start.
Distinct ones are dealt to shards: if their open bits are cut into RADIUS + 1 bands, two that link
agree in one band at least, so a shard is a band with its value.  A shard of more than SHARD
fingerprints is dealt again by its remaining open bits, until there are so few of those that a
shard cannot be larger; sizes are counted before any shard is brought together.

Every shard has a BK-tree: a node's children are keyed by their Hamming distance to it, and a
search that is d away from a node follows only edges from d - RADIUS to d + RADIUS.  A tree goes
to the one task that holds all fingerprints that can meet it, instead of to all executors, as the
trees of all shards together grow with the table.  A shard gives its connected groups as stars, at
most one row a fingerprint, so no group's pairs are written.

Null ids count as larger than all others; a component of null ids alone has a null component_id.
Repeated rows get equal results.  Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_id_of, keyed, materialize, released, slices, table, text_parts, with_values
from .components import components

SHINGLE, RADIUS, BITS = 3, 3, 64
#: Fingerprints of a shard at most, and rows and frontier entries that are worked on together.
SHARD, TOGETHER, FRONTIER = 4096, 1 << 16, 1 << 21


#: The primes of XXH64.
P1, P2, P3, P4, P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
SEED = 42


def xxh64(text: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 of text[start : start + size], all spans at once; spans of 32 bytes and more, few among shingles, by the library."""
    u = np.uint64
    padded = text + bytes(32)
    eight, four = (np.ndarray(len(text) + 24, k, padded, 0, (1,)) for k in ("<u8", "<u4"))
    byte = np.frombuffer(padded, np.uint8)

    def turned(x: np.ndarray, n: int) -> np.ndarray:
        return (x << u(n)) | (x >> u(64 - n))

    h = size.astype(u) + u(SEED + P5 & (1 << 64) - 1)
    at = start.copy()
    for k in range(3):
        lane = turned(eight[at] * u(P2), 31) * u(P1)
        on = size >= 8 * (k + 1)
        h = np.where(on, turned(h ^ lane, 27) * u(P1) + u(P4), h)
        at += 8 * on
    on = (size & 4) > 0
    h = np.where(on, turned(h ^ four[at].astype(u) * u(P1), 23) * u(P2) + u(P3), h)
    at += 4 * on
    for k in range(3):
        h = np.where((size & 3) > k, turned(h ^ byte[at + k].astype(u) * u(P5), 11) * u(P1), h)
    for n, p in ((33, P2), (29, P3)):
        h = (h ^ (h >> u(n))) * u(p)
    h ^= h >> u(32)
    for i in np.flatnonzero(size >= 32).tolist():
        h[i] = xxhash.xxh64_intdigest(text[start[i] : start[i] + size[i]], SEED)
    return h


def shingle_hashes(part: bytes, shingle: int = SHINGLE, whole: bool = True) -> np.ndarray:
    """XXH64 of a text part's shingles; whole: fewer words than a shingle are one."""
    words = part.lower().split()  # of bytes: A to Z alone, and the six separators
    if len(words) < shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words and whole else [], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: len(words) - shingle + 1]
    return xxh64(b" ".join(words), start, end[shingle - 1 :] - start)


def fingerprints_of(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprints."""
    ones, count = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    for which, first, parts in text_parts(texts, shingle):
        hashes = [shingle_hashes(p, shingle, not f) for p, f in zip(parts, first, strict=True)]
        size = np.array([len(h) for h in hashes])
        some = np.flatnonzero(size)
        if len(some):
            bits = np.unpackbits(np.concatenate(hashes).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            at = np.asarray(which)[some]
            np.add.at(ones, at, np.add.reduceat(bits, (np.cumsum(size) - size)[some], axis=0, dtype=np.int64))
            np.add.at(count, at, size[some])
    return np.packbits(2 * ones > count[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(df: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_ord, fp (the 64 bits as a long) of every row."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in slices(b, 1):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(texts)), pa.array(fingerprints_of(texts, shingle).view(np.int64))], ["_ord", "fp"])

    return keyed(df, id_col, text_col).select("_ord", "_text").mapInArrow(run, "_ord long, fp long")


class Trees:
    """BK-trees of several groups of distinct fingerprints, each group's rows together."""

    def __init__(self, prints: np.ndarray, root: np.ndarray):
        """root: the first row of each row's group."""
        self.prints, self.root = prints, root
        rows = np.arange(len(prints))
        at, left = root.copy(), rows[rows != root]
        keys, children = [], []
        while len(left):  # all that reach a node do so in the same round
            key = at[left] * (BITS + 1) + np.bitwise_count(prints[left] ^ prints[at[left]]).astype(np.int64)
            order = np.argsort(key, kind="stable")
            left, key = left[order], key[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            child = left[new]
            keys.append(key[new])
            children.append(child)
            at[left] = child[np.cumsum(new) - 1]
            left = left[~new]
        key = np.concatenate([*keys, np.zeros(0, np.int64)])
        order = np.argsort(key)
        self.key, self.child = key[order], np.concatenate([*children, np.zeros(0, np.int64)])[order]

    def near(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query row, node row) within the radius, in blocks."""
        q, node = queries, self.root[queries]
        while len(q):
            away = np.bitwise_count(self.prints[q] ^ self.prints[node]).astype(np.int64)
            hit = (away <= radius) & (q != node)
            yield q[hit], node[hit]
            low = np.searchsorted(self.key, node * (BITS + 1) + np.maximum(away - radius, 0))
            n = np.searchsorted(self.key, node * (BITS + 1) + np.minimum(away + radius, BITS), side="right") - low
            q, node = np.repeat(q, n), self.child[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]


def joined(prints: np.ndarray, root: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """The first row that each row reaches by links within its group."""
    trees, label = Trees(prints, root), np.arange(len(prints))
    size = np.bincount(root, minlength=len(prints))[root]
    block = np.cumsum(size) // FRONTIER
    for at in np.split(label.copy(), np.flatnonzero(np.diff(block)) + 1):
        for a, b in trees.near(at, radius):
            while len(a):
                low = np.minimum(label[a], label[b])
                np.minimum.at(label, label[a], low)
                np.minimum.at(label, label[b], low)
                while (label[label] != label).any():
                    label = label[label]
                apart = label[a] != label[b]
                a, b = a[apart], b[apart]
    return label


def bands(mask: int, radius: int) -> list[int]:
    """mask with each band of its open bits added."""
    open_bits = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | sum(1 << int(b) for b in band) for band in np.array_split(open_bits, radius + 1) if len(band)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def near_links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """x, y: stars that connect all distinct fingerprints (column fp) that links within the radius connect."""
    spark = prints.sparkSession
    rows = prints.select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("held"), "fp")
    masks, out = [0], None

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches in order of mask and held; a group may go on in the next."""
        kept = np.zeros((3, 0), np.int64)
        for b in _with_end(batches):
            if b is not None:
                kept = np.concatenate([kept, np.array([c.to_numpy() for c in b.columns], np.int64).reshape(3, -1)], axis=1)
            if not kept.shape[1] or (b is not None and kept.shape[1] < TOGETHER):
                continue
            new = np.concatenate([[True], (kept[:2, 1:] != kept[:2, :-1]).any(0)])
            upto = kept.shape[1] if b is None else int(np.flatnonzero(new)[-1])
            starts = np.flatnonzero(new[:upto])
            if len(starts):
                root = np.repeat(starts, np.diff(np.append(starts, upto)))
                own = kept[2, :upto]
                label = joined(own.view(np.uint64), root, radius)
                moved = np.flatnonzero(label != np.arange(upto))
                yield pa.RecordBatch.from_arrays([pa.array(own[moved]), pa.array(own[label[moved]])], ["x", "y"])
            kept = kept[:, upto:]

    def dealt(rows: DataFrame, masks: list[int]) -> tuple[DataFrame, list[int]]:
        """Every row with each of the masks that follow its own."""
        nexts = {m: bands(m, radius) for m in masks}
        deal = spark.createDataFrame([(signed(m), [signed(x) for x in v]) for m, v in nexts.items()], "mask long, nexts array<long>")
        new = rows.join(F.broadcast(deal), "mask").select(F.explode("nexts").alias("mask"), "fp")
        new = new.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("held"), "fp")
        # the same mask may come from several
        return materialize(new.distinct() if len(masks) > 1 else new), sorted({x for v in nexts.values() for x in v})

    if prints.count() > shard:
        rows, masks = dealt(rows, masks)
    while True:
        sizes = rows.groupBy("mask", "held").agg(F.count("*").alias("n")).where(F.col("n") > shard)
        large = materialize(sizes.select("mask", "held")) if 1 << min(BITS - m.bit_count() for m in masks) > shard else None
        small = rows if large is None else rows.join(large, ["mask", "held"], "left_anti")
        found = materialize(small.repartition("mask", "held").sortWithinPartitions("mask", "held").mapInArrow(run, "x long, y long"))
        out = found if out is None else out.unionByName(found)
        if large is None or large.isEmpty():
            return out
        rows, masks = dealt(rows.join(large, ["mask", "held"], "left_semi"), masks)


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches, and None after the last."""
    yield from batches
    yield None


def near_duplicates(df: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_ord, fp, component (the smallest _ord that links reach) of every row."""
    prints = materialize(fingerprints(df, shingle, id_col, text_col))
    classes = materialize(prints.groupBy("fp").agg(F.min("_ord").alias("low"), F.count("*").alias("n")))
    labels = components(near_links(classes.select("fp"), radius, shard))
    linked = materialize(labels.select(F.col("v").alias("fp"), "c").join(classes.select("fp", "low"), "fp"))
    least = linked.groupBy("c").agg(F.min("low").alias("component"), F.count("*").alias("n"))
    of = with_values(linked.select("fp", "c"), least, "c", "n").select("fp", "component")
    values = classes.join(of, "fp", "left").select("fp", F.coalesce("component", "low").alias("component"), "n")
    return with_values(prints, values, "fp", "n")


def op13_simhash_bk_trees(spark, sf_dir: str) -> DataFrame:
    """documents: 3-word shingles, 64 bits, radius 3."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(doc_id_of().alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), doc_id_of("component").alias("component_id"))
