"""N-gram Jaccard join: candidates share prefix shingles under several global orders.

A document's set is its distinct five-word shingles (words lower-cased A-Z); with fewer words,
the whole sequence; without words it is empty and linked with nothing.  Documents with equal
sets are one class from the start.  Two classes of sizes a and b link when their sets' Jaccard
likeness is at least THRESHOLD.

Orders.  Every global order of the shingles gives each set a prefix of n - ceil(t n) + 1
shingles, and linked sets share a prefix shingle under every order.  All orders put the shingles
that many documents hold last (their counts are found in a first pass that reports a shingle only
where a slice of documents repeats it, and only shingles above a share of all documents are kept,
whose number that share bounds); within equal counts each order follows a hash of its own.

Candidates.  The prefixes under each order are dealt to buckets by shingle; a set that shares none
under one of the orders leaves.  Each list of a prefix shingle has a hub, its member with the
smallest identity; the sets of all lists of one order with one hub are a group,
so any two sets that share a prefix shingle under an order are in one of its groups.  The groups
of the first order are compared.  What is larger than BLOCK sets or BLOCK_SHINGLES shingles
(a passage that many documents share, a family of near copies) is split by size class (linked sets
are of one class or of neighbouring ones) and each class into blocks; a task compares two blocks.
Every set brings the names of its groups under the other orders along, and a pair is left only if
it shares a group under each of them: the intersection takes a row for a set and group of the first
order, never one for every pair of groups.  A set without such a partner leaves before any text is
fetched.  What is left must pass a bound from histograms of shingles over CELLS cells.

Verification.  The sets left in a comparison come with their texts, and shared shingles are
counted exactly.  Two sets may meet in several groups; their pair belongs to the smallest group
they share and is counted there only.  A comparison gives the number of links of each of its sets
(weighed by the copies of the other end) and links that join its sets into components, never all
pairs; similar_links gives all links as a table to whoever asks for them.

Shingles are compared by 64-bit hashes, sets are identified by 64-bit sums of them and their size:
at some 10**9 documents one pair of unlike sets is expected to share its identity.  Null text is
empty; a null id is the largest; repeated rows are in one component.  Tables without rows or links
give each document its own component.  A long text is read in parts; its shingles are held whole,
some 20 bytes for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets_for, doc_id_of, keyed, materialize, mix, pack, pack_parts, pack_text_column, released, slices, table, text_bytes, unpack, unpack_parts
from .components import components
from .fingerprint import shingle_hashes

SHINGLE = 5
#: The threshold as a fraction: 100 * shared >= 80 * united.
PERCENT = 80
#: A shingle is frequent if at least one document in so many holds it.
FREQUENT = 2000
ANCHOR_BYTES = 64 << 20
SALTS = 16
CELLS = 512
BLOCK = 1024
BLOCK_SHINGLES = 1 << 21
#: Rows that one group of comparisons holds, on average: with names of groups, with histograms, with texts.
TASK_ROWS = (20_000, 2000, 500)
#: The global orders whose prefixes are intersected.
ORDERS = (0, 1, 2)
#: Sets that a task remembers to have posted, in each of two generations.
POSTED = 100_000


def sets(texts: list[bytes], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text index, shingle hash), distinct, sorted by text."""
    doc, h, _ = shingle_hashes(texts, n, lower=True)
    order = np.argsort(h)
    order = order[np.argsort(doc[order].astype(np.uint16 if len(texts) <= 65536 else np.int64), kind="stable")]
    doc, h = doc[order], h[order]
    first = np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]) if len(doc) else np.zeros(0, bool)
    return doc[first], h[first]


def set_sums(doc: np.ndarray, h: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(identity, size) of each text's set."""
    size = np.bincount(doc, minlength=texts)
    sums = np.zeros(texts, np.uint64)
    np.add.at(sums, doc, mix(h + np.uint64(0x51ED270B)))
    return (mix(sums + size.astype(np.uint64)) >> np.uint64(1)).astype(np.int64), size


def prefix_size(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


def frequent_shingles(rows: DataFrame, documents: int) -> np.ndarray:
    """Sorted hashes and counts (two rows of one array) of the shingles that slices report often enough."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in slices(b, 2):
                _, h = sets(texts)
                h, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h[n > 1].view(np.int64)), pa.array(n[n > 1], pa.int64())], ["_h", "_n"])

    counted = rows.select("_ord", "_th", "_text").mapInArrow(run, "_h long, _n long").groupBy("_h").agg(F.sum("_n").alias("_n"))
    got = counted.where(F.col("_n") >= max(16, documents // FREQUENT)).toPandas()
    got = got.assign(_h=got["_h"].to_numpy(np.int64).view(np.uint64)).sort_values("_h")
    return np.array([got["_h"].to_numpy(np.uint64), got["_n"].to_numpy(np.uint64)])


def counts_of(h: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not frequent.shape[1]:
        return np.zeros(len(h), np.uint64)
    at = np.minimum(np.searchsorted(frequent[0], h), frequent.shape[1] - 1)
    return np.where(frequent[0][at] == h, frequent[1][at], np.uint64(0))


def prefixes(doc: np.ndarray, h: np.ndarray, size: np.ndarray, count: np.ndarray, order: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, 40-bit token) of the prefix shingles of every set under one global order: by powers of two of their counts, then by token."""
    token = mix(h + np.uint64((order + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & np.uint64((1 << 40) - 1)
    rare = np.frexp(count.astype(np.float64))[1].astype(np.uint64) << np.uint64(40)
    by = np.argsort(doc.astype(np.uint64) << np.uint64(48) | rare | token, kind="stable")
    first = np.cumsum(size) - size
    at = by[np.arange(len(by)) - first[doc[by]] < prefix_size(size, percent)[doc[by]]]
    return at, token[at]


def _postings(frequent, buckets: int, percent: int):
    """Prefix tokens by order and bucket: (token, set, frequent).  A task posts a set once as long as it remembers it; frequent shingles, known to be shared, are dealt evenly."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new: set[int] = set()
        old: set[int] = set()
        for b in batches:
            for _, texts in slices(b, 2):
                doc, h = sets(texts)
                if not len(doc):
                    continue
                ident, size = set_sums(doc, h, len(texts))
                distinct, one = np.unique(ident[size > 0], return_index=True)
                one = np.flatnonzero(size > 0)[one][[f not in new and f not in old for f in distinct.tolist()]]
                if len(new) > POSTED:
                    new, old = set(), new
                new.update(ident[one].tolist())
                count = counts_of(h, frequent.value)
                mine = np.zeros(len(texts), bool)
                mine[one] = True
                for order in ORDERS:
                    at, token = prefixes(doc, h, size, count, order, percent)
                    keep = mine[doc[at]]
                    at, token = at[keep], token[keep]
                    many = count[at] > 0
                    key = mix(np.where(many, token ^ mix(ident[doc[at]].view(np.uint64)), token))
                    bucket = (key % np.uint64(buckets)).astype(np.int64)
                    by = np.argsort(bucket, kind="stable")
                    edges = np.flatnonzero(np.concatenate([[True], np.diff(bucket[by]) != 0, [True]])) if len(by) else np.zeros(1, np.int64)
                    rows = []
                    for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                        i = by[x:y]
                        docs, which = np.unique(doc[at[i]], return_inverse=True)
                        rows.append(pack_parts(token[i].astype("<u4").tobytes(), (token[i] >> np.uint64(32)).astype("u1").tobytes(), which.astype("<u2").tobytes(), ident[docs].tobytes(), many[i].tobytes(), size[docs].astype("<u4").tobytes()))
                    yield pa.RecordBatch.from_arrays([pa.array(bucket[by[edges[:-1]]] * len(ORDERS) + order), pa.array(rows, pa.binary())], ["_bucket", "_z"])

    return run


def _lists(percent: int):
    return released(lambda group: _hubs_of(group, percent))


def _hubs_of(group: pa.Table, percent: int) -> pa.Table:
    """(_o order, _b, _f, _many): sets around the hubs of the lists of a bucket, or the lists of frequent tokens, whose other members are in other buckets.

    In order of size, a list is parted where neighbours are too unlike in size to link: no link crosses that place.
    """
    parts = [unpack_parts(z.as_py()) for z in group.column("_z")]
    token = np.concatenate([np.frombuffer(p[0], "<u4").astype(np.int64) | np.frombuffer(p[1], "u1").astype(np.int64) << 32 for p in parts])
    f = np.concatenate([np.frombuffer(p[3], "<i8")[np.frombuffer(p[2], "<u2")] for p in parts])
    many = np.concatenate([np.frombuffer(p[4], bool) for p in parts])
    order = int(group.column("_bucket")[0].as_py()) % len(ORDERS)
    own, own_f = token[~many], f[~many]
    sizes = np.concatenate([np.frombuffer(p[5], "<u4")[np.frombuffer(p[2], "<u2")] for p in parts]).astype(np.int64)[~many]
    by = np.lexsort((sizes, own))
    own, own_f, sizes = own[by], own_f[by], sizes[by]
    head = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (100 * sizes[:-1] < percent * sizes[1:])])) if len(own) else np.zeros(0, np.int64)
    n = np.diff(np.append(head, len(own)))
    low, high = (f_.reduceat(own_f, head) if len(head) else head for f_ in (np.minimum, np.maximum))
    hub = np.repeat(low, n)  # the smallest set
    keep = np.repeat(low != high, n)
    pairs = np.unique(np.stack([hub[keep], own_f[keep]], 1), axis=0) if keep.any() else np.zeros((0, 2), np.int64)
    rest = np.unique(np.stack([-1 - token[many], f[many]], 1), axis=0) if many.any() else np.zeros((0, 2), np.int64)
    both = np.concatenate([pairs, rest])
    return pa.table({"_o": pa.array(np.full(len(both), order, np.int32)), "_b": pa.array(both[:, 0]), "_f": pa.array(both[:, 1]), "_many": pa.array(np.arange(len(both)) >= len(pairs))})


def digests(rows: DataFrame) -> DataFrame:
    """_ord, _th, _f (set), _n (size) of every document."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in slices(b, 2):
                doc, h = sets(texts)
                ident, size = set_sums(doc, h, len(texts))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(texts)), b.column(1).slice(first, len(texts)), pa.array(ident), pa.array(size, pa.int64())], ["_ord", "_th", "_f", "_n"])

    return rows.select("_ord", "_th", "_text").mapInArrow(run, "_ord long, _th long, _f long, _n long")


@released
def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the packed histogram of every set to (_f, _n, _m, _z)."""
    for b in batches:
        raw = pa.RecordBatch.from_arrays([pa.array([unpack(z.as_py()) for z in b.column(3)], pa.binary())], ["_text"])
        for first, texts in slices(raw, 0, rows=1024):
            doc, h = sets(texts)
            cells = np.bincount(doc * CELLS + (mix(h + np.uint64(77)) % np.uint64(CELLS)).astype(np.int64), minlength=len(texts) * CELLS)
            packed = [pack(c.tobytes()) for c in np.minimum(cells, 65535).astype("<u2").reshape(-1, CELLS)]
            yield pa.RecordBatch.from_arrays([*b.slice(first, len(texts)).columns, pa.array(packed, pa.binary())], ["_f", "_n", "_m", "_z", "_s"])


def _cells(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(unpack(z.as_py()) for z in column), "<u2").reshape(-1, CELLS)


def _can_link(shared, a, b, percent: int) -> np.ndarray:
    """Whether sets of sizes a and b that share at most so many can link; a cell may have been cut at 65,535, so larger sets always can."""
    big = np.minimum(a, b) >= 65535
    return big | ((100 * shared >= percent * (a + b - shared)) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b)))


def _pieces(group: pa.Table) -> Iterator[pa.Table]:
    """The comparisons (_t) of a bucket."""
    t = group.column("_t").to_numpy()
    order = np.argsort(t, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(t[order]) != 0, [True]]))
    group = group.take(pa.array(order)).combine_chunks()
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield group.slice(a, b - a)


def shared_shingles(doc: np.ndarray, h: np.ndarray, left: np.ndarray, right: np.ndarray, texts: int) -> np.ndarray:
    """Shingles that every set of left shares with every set of right."""
    _, column, n = np.unique(h, return_inverse=True, return_counts=True)
    keep = n[column] > 1
    doc, column = doc[keep], np.unique(column[keep], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    shared = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        a, b = np.searchsorted(column, [at, at + 2048])
        held = np.zeros((texts, 2048), np.float32)
        held[doc[a:b], column[a:b] - at] = 1
        shared += (held[left] @ held[right].T).astype(np.int64)
    return shared


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, token) of an array column."""
    size = column.value_lengths().to_numpy()
    return np.repeat(np.arange(len(size)), size), column.flatten().to_numpy()


def _not_owned(g: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether a set of left and one of right share a group that comes before the one of this comparison."""
    row, of = _tokens(_flat(g.column("_gs")))
    own = int(g.column("_b")[0].as_py())
    before = of < own
    return shared_shingles(row[before], of[before], left, right, g.num_rows) > 0


def _side(g: pa.Table, name: str) -> np.ndarray:
    return np.flatnonzero(g.column(name).to_numpy(zero_copy_only=False) if isinstance(g.column(name), pa.Array) else g.column(name).to_numpy())


def _flat(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _partnered(t: np.ndarray, column: pa.Array) -> np.ndarray:
    """Whether each row shares a token of an array column with another row of its comparison."""
    row, token = _tokens(column)
    key = mix(t[row].view(np.uint64) ^ mix(token.astype(np.int64).view(np.uint64)))
    by = np.argsort(key, kind="stable")
    same = key[by[1:]] == key[by[:-1]]
    has = np.zeros(len(t), bool)
    has[row[by[1:][same]]] = True
    has[row[by[:-1][same]]] = True
    return has


def _intersected(percent: int):
    """(_t, _b, _gs, _f, _n, _left, _right) of the sets that share a group under every order with one of the other side whose size can link."""
    others = [f"_g{o}" for o in ORDERS[1:]]
    names = ["_t", "_b", "_gs", "_f", "_n", "_left", "_right"]

    @released
    def run(group: pa.Table) -> pa.Table:
        while True:  # all comparisons at once, until every row has a partner under every order
            rows = group.num_rows
            for o in others:
                group = group.filter(pa.array(_partnered(group.column("_t").to_numpy(), _flat(group.column(o)))))
            if group.num_rows == rows:
                break
        out = [group.select(names).slice(0, 0)]
        for g in _pieces(group):
            f, n = (_flat(g.column(k)).to_numpy() for k in ("_f", "_n"))
            l, r = _side(g, "_left"), _side(g, "_right")
            ok = f[l][:, None] != f[r][None, :]
            ok &= 100 * np.minimum(n[l][:, None], n[r][None, :]) >= percent * np.maximum(n[l][:, None], n[r][None, :])
            for o in others:
                if ok.any():
                    ok &= shared_shingles(*_tokens(_flat(g.column(o))), l, r, g.num_rows) > 0
            if ok.any():
                ok &= ~_not_owned(g, l, r)
            near_left, near_right = np.zeros(len(f), bool), np.zeros(len(f), bool)
            near_left[l[ok.any(1)]] = True
            near_right[r[ok.any(0)]] = True
            keep = pa.array(near_left | near_right)
            kept = [_flat(g.column(c)).filter(keep) for c in names[:-2]]
            out.append(pa.table([*kept, pa.array(near_left).filter(keep), pa.array(near_right).filter(keep)], names))
        return pa.concat_tables(out)

    return run


def _near(percent: int):
    """(_t, _b, _gs, _f, _left, _right) of the sets that sizes and histograms let link with one of the other side."""

    @released
    def run(group: pa.Table) -> pa.Table:
        out = []
        for g in _pieces(group):
            f, n = (_flat(g.column(k)).to_numpy() for k in ("_f", "_n"))
            l, r = _side(g, "_left"), _side(g, "_right")
            near_left, near_right = np.zeros(len(f), bool), np.zeros(len(f), bool)
            ok = f[l][:, None] != f[r][None, :]
            ok &= 100 * np.minimum(n[l][:, None], n[r][None, :]) >= percent * np.maximum(n[l][:, None], n[r][None, :])
            if ok.any():
                ok &= ~_not_owned(g, l, r)
                cells = _cells(_flat(g.column("_s")))
                for i in np.flatnonzero(ok.any(1)).tolist():
                    some = np.flatnonzero(ok[i])
                    shared = np.minimum(cells[r[some]], cells[l[i]]).sum(1, dtype=np.int64)
                    hit = r[some[_can_link(shared, n[r[some]], np.full(len(some), n[l[i]]), percent)]]
                    near_left[l[i]] = len(hit) > 0
                    near_right[hit] = True
            keep = pa.array(near_left | near_right)
            kept = [_flat(g.column(c)).filter(keep) for c in ("_t", "_b", "_gs", "_f")]
            out.append(pa.table([*kept, pa.array(near_left).filter(keep), pa.array(near_right).filter(keep)], ["_t", "_b", "_gs", "_f", "_left", "_right"]))
        return pa.concat_tables(out)

    return run


def joining(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of some of the links of a symmetric table that join what all of them join."""
    label = np.arange(len(linked))
    a, b = [], []
    for i in range(len(linked)):
        js = np.flatnonzero(linked[i])
        for c, at in zip(*np.unique(label[js], return_index=True), strict=True):
            if c != label[i]:
                a.append(i)
                b.append(int(js[at]))
                label[label == c] = label[i]
    return np.array(a, np.int64), np.array(b, np.int64)


def _exact(percent: int, every: bool):
    """From whole sets: every link (x, y, shared, united), or the links that join (x, y) and the weight of each set's links (x, null, weight)."""

    @released
    def run(group: pa.Table) -> pa.Table:
        out = []
        for g in _pieces(group):
            f, m = (_flat(g.column(k)).to_numpy() for k in ("_f", "_m"))
            l, r = _side(g, "_left"), _side(g, "_right")
            doc, h = sets([unpack(z.as_py()) for z in g.column("_z")])
            size = np.bincount(doc, minlength=len(f))
            shared = shared_shingles(doc, h, l, r, len(f))
            united = size[l][:, None] + size[r][None, :] - shared
            link = (100 * shared >= percent * united) & (shared > 0) & (f[l][:, None] != f[r][None, :]) & ~_not_owned(g, l, r)
            both = len(np.intersect1d(l, r)) > 0  # a block against itself: every pair stands there both ways
            if every:
                i, j = np.nonzero(link & (f[l][:, None] < f[r][None, :]) if both else link)
                x, y = f[l[i]], f[r[j]]
                out.append(pa.table({"x": np.minimum(x, y), "y": np.maximum(x, y), "shared": shared[i, j], "united": united[i, j]}))
                continue
            weight = np.zeros(len(f), np.int64)
            np.add.at(weight, l, link @ m[r])
            if not both:
                np.add.at(weight, r, m[l] @ link)
            table_ = np.zeros((len(f), len(f)), bool)
            table_[np.ix_(l, r)] = link
            a, b = joining(table_ | table_.T)
            some = np.flatnonzero(weight)
            x, y = np.concatenate([f[a], f[some]]), np.concatenate([f[b], np.zeros(len(some), np.int64)])
            is_link = np.arange(len(x)) < len(a)
            out.append(pa.table({"x": x, "y": pa.array(y, mask=~is_link), "weight": np.concatenate([np.zeros(len(a), np.int64), weight[some]])}))
        return pa.concat_tables(out)

    return run


def _salted(rows: DataFrame, few: DataFrame, keys: list[str], salt, how: str = "inner") -> DataFrame:
    """rows joined with a table of one row a key, whose rows are repeated for SALTS salts so that no key's rows meet in one task."""
    many = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int")).join(many, [*keys, "_salt"], how).drop("_salt")


def _sized(groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """_b, _f, _n, _small of the groups that have two sets or more."""
    sized = groups.join(sizes, "_f")
    whole = sized.groupBy("_b").agg(F.count("*").alias("m"), F.sum("_n").alias("s")).where("m > 1").select("_b", ((F.col("m") <= BLOCK) & (F.col("s") <= BLOCK_SHINGLES)).alias("_small"))
    return materialize(sized.join(materialize(whole), "_b").select("_b", "_f", "_n", "_small"))


def _around_hubs(lists: DataFrame) -> DataFrame:
    """(_b, _f): the sets of lists (_h, _f) of two sets or more around the hub of each, its smallest set."""
    hubs = lists.groupBy("_h").agg(F.min("_f").alias("_b"), F.max("_f").alias("_last")).where("_b < _last").select("_h", "_b")
    # written first: a join of two plain tables is one whose hot lists Spark can split
    return lists.join(materialize(hubs), "_h").select("_b", "_f").distinct()


def _comparisons(large: DataFrame, small: DataFrame, percent: int) -> DataFrame:
    """(_t, _b, _f, _n, _left, _right): which sets are on which side of which comparison, so that any two sets of a group that can link meet in one."""
    # a little wider than the ratio of linked sizes, so that rounding parts no neighbours
    ratio = 100 / percent * 1.001
    large = large.withColumn("_k", F.floor(F.log(F.col("_n").cast("double")) / float(np.log(ratio))))
    both = (F.lit(True).alias("_left"), F.lit(True).alias("_right"))
    per = materialize(large.groupBy("_b", "_k").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("_n") / BLOCK_SHINGLES)).cast("int").alias("p")))
    up = per.select("_b", (F.col("_k") - 1).alias("_k"), F.col("p").alias("p_up"))
    down = per.select("_b", (F.col("_k") + 1).alias("_k"), F.col("p").alias("p_down"))
    near = per.join(up, ["_b", "_k"], "left").join(down, ["_b", "_k"], "left")
    at = _salted(large, near, ["_b", "_k"], F.xxhash64("_f")).withColumn("_i", F.pmod(F.xxhash64("_f"), F.col("p")).cast("int"))
    task = lambda k, i, step, j: F.xxhash64("_b", k, i, F.lit(step), j).alias("_t")
    side = lambda left: (F.lit(left).alias("_left"), F.lit(not left).alias("_right"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1)).alias("_j")
    k, i, j = F.col("_k"), F.col("_i"), F.col("_j")
    within = at.select("_b", "_k", "_i", "_f", "_n", upto(F.col("p")))
    above = at.where("p_up is not null").select("_b", "_k", "_i", "_f", "_n", upto(F.col("p_up")))
    below = at.where("p_down is not null").select("_b", "_k", "_i", "_f", "_n", upto(F.col("p_down")))
    rows = [
        small.select(F.xxhash64("_b").alias("_t"), "_b", "_f", "_n", *both),
        within.where("_i = _j").select(task(k, i, 0, j), "_b", "_f", "_n", *both),
        within.where("_i < _j").select(task(k, i, 0, j), "_b", "_f", "_n", *side(True)),
        within.where("_i > _j").select(task(k, j, 0, i), "_b", "_f", "_n", *side(False)),
        above.select(task(k, i, 1, j), "_b", "_f", "_n", *side(True)),
        below.select(task(k - 1, j, 1, i), "_b", "_f", "_n", *side(False)),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    # in order of size, a set that can link with any of its comparison can by size with a neighbour
    by_size = Window.partitionBy("_t").orderBy("_n", "_f")
    near = lambda a, b: F.coalesce(100 * a >= percent * b, F.lit(False))
    mate = near(F.lag("_n").over(by_size), F.col("_n")) | near(F.col("_n"), F.lead("_n").over(by_size))
    return out.withColumn("_mate", mate).where("_mate").drop("_mate")


def _verified(docs: DataFrame, percent: int, id_col: str, text_col: str, every: bool) -> tuple[DataFrame, DataFrame]:
    """(digests of every document, what _exact gives of all comparisons)."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    total = text_bytes(rows, "_text")
    frequent = spark.sparkContext.broadcast(frequent_shingles(rows, rows.count()))
    digest = materialize(digests(rows))
    posted = rows.mapInArrow(_postings(frequent, buckets_for(total, ANCHOR_BYTES, 8), percent), "_bucket long, _z binary")
    lists = materialize(posted.groupBy("_bucket").applyInArrow(_lists(percent), "_o int, _b long, _f long, _many boolean"))

    # sets that share a prefix shingle under every order
    first = digest.where("_n > 0").groupBy("_f").agg(F.min(F.struct("_ord", "_th")).alias("_p"), F.first("_n").alias("_n"), F.count("*").alias("_m"))
    shared = lists.groupBy("_f").agg(F.countDistinct("_o").alias("_k")).where(F.col("_k") == len(ORDERS))
    alive = materialize(first.join(shared.select("_f"), "_f"))
    under = lambda o: lists.where(F.col("_o") == o).join(alive.select("_f"), "_f", "left_semi")
    by_order = [under(o).where("not _many").select("_b", "_f").unionByName(_around_hubs(under(o).where("_many").select(F.col("_b").alias("_h"), "_f"))).distinct() for o in ORDERS]
    sized = _sized(by_order[0], alive.select("_f", "_n"))
    small, large = sized.where("_small").select("_b", "_f", "_n"), sized.where("not _small").select("_b", "_f", "_n")
    of = sized.groupBy("_f").agg(F.sort_array(F.collect_set("_b")).alias("_gs"))
    for o in ORDERS[1:]:  # names of 32 bits: two groups of one name only leave a pair to the checks after
        of = of.join(by_order[o].groupBy("_f").agg(F.collect_set(F.hash("_b")).alias(f"_g{o}")), "_f")

    def dealt(rows: DataFrame, count: int, per: int) -> DataFrame:
        return rows.withColumn("_g", F.pmod("_t", F.lit(max(16, -(-count // per)))))

    sides = materialize(_comparisons(large, small, percent))
    met = dealt(sides.join(materialize(of), "_f"), sides.count(), TASK_ROWS[0])
    kept = "_t long, _b long, _gs array<long>, _f long, _n long, _left boolean, _right boolean"
    sides = materialize(met.groupBy("_g").applyInArrow(_intersected(percent), kept))

    # one text and histogram for each set that is still in
    still = alive.join(sides.select("_f").distinct(), "_f").select("_f", "_n", "_m", F.col("_p._ord").alias("_ord"), F.col("_p._th").alias("_th"))
    texts = pack_text_column(rows).join(still, ["_ord", "_th"]).dropDuplicates(["_f"]).select("_f", "_n", "_m", "_z")
    members = materialize(texts.mapInArrow(_histograms, "_f long, _n long, _m long, _z binary, _s binary"))

    first_pass = dealt(sides.join(members.select("_f", "_s"), "_f"), sides.count(), TASK_ROWS[1])
    near = materialize(first_pass.groupBy("_g").applyInArrow(_near(percent), "_t long, _b long, _gs array<long>, _f long, _left boolean, _right boolean"))
    second = dealt(near.join(members.select("_f", "_z", "_m"), "_f"), near.count(), TASK_ROWS[2])
    schema = "x long, y long, shared long, united long" if every else "x long, y long, weight long"
    return digest, materialize(second.groupBy("_g").applyInArrow(_exact(percent, every), schema))


def similar_links(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(digests of every document, all links between different sets: x < y, shared, united)."""
    return _verified(docs, percent, id_col, text_col, True)


def classes(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_ord, _th, n_shingles, component (smallest _ord of the component), _c (the component's own key) and n_links of every document.

    n_links counts the other rows whose set is equal or linked: every link weighs the copies of the
    set at its other end.  Null and repeated ids give unrelated components one `component`; only _c
    tells them apart.  Rows without words share a _c and are in no component.
    """
    digest, got = _verified(docs, percent, id_col, text_col, False)
    copies = digest.where("_n > 0").groupBy("_f").agg(F.count("*").alias("k"))
    others = got.where("y is null").groupBy(F.col("x").alias("_f")).agg(F.sum("weight").alias("n"))
    weight = copies.join(others, "_f", "left").select("_f", (F.col("k") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    found = components(got.where("y is not null")).withColumnRenamed("v", "_f")
    of_set = weight.join(found, "_f", "left").select("_f", F.coalesce("c", "_f").alias("_c"), "n_links")

    # both sides of these joins are plain tables, so that Spark can split a set that many documents share, or a component of many sets
    some = digest.where("_n > 0").join(materialize(of_set), "_f").select("_ord", "_th", F.col("_n").alias("n_shingles"), "_c", "n_links")
    some = materialize(some)
    least = materialize(some.groupBy("_c").agg(F.min("_ord").alias("component")))
    named = some.join(least, "_c").select("_ord", "_th", "n_shingles", "component", "_c", "n_links")
    none = digest.where("_n = 0").select("_ord", "_th", F.col("_n").alias("n_shingles"), F.col("_ord").alias("component"), F.col("_f").alias("_c"), F.lit(0).cast("long").alias("n_links"))
    return named.unionByName(none)


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each component: the smallest id, then text hash; of repeated rows one stays.  Rows without words all stay."""
    found = classes(docs, percent)
    best = found.where("n_shingles > 0").groupBy("_c").agg(F.min(F.struct("_ord", "_th")).alias("_p")).select(F.col("_p._ord").alias("_ord"), F.col("_p._th").alias("_th"), F.lit(True).alias("_best"))
    key = {"_ord": F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)), "_th": F.xxhash64(F.coalesce("text", F.lit("")))}
    empty = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(*[v.alias(k) for k, v in key.items()], empty.alias("_empty"), F.struct(*docs.columns).alias("_row"))
    kept = rows.join(best, ["_ord", "_th"], "left").where(F.col("_empty") | F.col("_best"))
    one = Window.partitionBy("_ord", "_th").orderBy(F.lit(0))
    repeated = kept.withColumn("_k", F.row_number().over(one)).where(F.col("_empty") | (F.col("_k") == 1))
    return repeated.select("_row.*")


def op2_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Every document: set size, smallest id reachable by links, and how many other documents are equal or linked."""
    found = classes(table(spark, sf_dir, "documents"))
    return found.select(doc_id_of().alias("doc_id"), "n_shingles", doc_id_of("component").alias("component_id"), "n_links")
