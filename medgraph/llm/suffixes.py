"""Suffix arrays by induced sorting, with permuted common prefixes, and the byte dedup built on them.

Sorting one shard (`suffix_array`).  Suffixes are classified as smaller or larger than their
right neighbour; the leftmost smaller ones mark substrings, which are sorted by one induced pass
and named; the string of names is sorted recursively; from the order of its suffixes a second
induced pass gives the whole array.  Both passes scan the buckets of the alphabet once; what a
bucket puts into another is moved as one numpy array, in scan order.  The recursion's string has
an alphabet about as large as itself, so that scan order brings nothing there: it is sorted by
doubling of ranks.  Common prefixes are computed in text order: only where the character before
a suffix differs from the one before its neighbour are characters compared, everywhere else the
value is its left neighbour's less one.

Dedup (`repeated_bytes`).  A window is `window` bytes.  Its anchor is the smallest hash among its
runs of `gram` bytes, so equal windows have equal anchors.  A first pass sends only the anchors;
those that occur once cannot hold a repeated window.  For the others the windows around the
anchor travel as one segment to the anchor's shard; equal segments are merged before sorting and
remembered as many.  In the shard's suffix array a window is repeated where the common prefix
with a neighbour covers it, or where its segment was merged.

Null text is empty.  Matches never cross documents; windows of one document do match each other.
Rows that repeat id and text are two documents (all their windows repeat).  Long texts are taken
whole.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODE, buckets_for, doc_id_of, keyed, materialize, mix, pack_parts, pack_text_column, released, rolling, sliding_min, slices, table, text_bytes, unpack, unpack_parts

WINDOW = 400
GRAM = 160
#: Corpus bytes whose anchors share a bucket, and corpus bytes whose segments share a shard.
ANCHOR_BYTES, SHARD_BYTES = 32 << 20, 2 << 20
#: Bytes of text whose anchors are found in one numpy pass.
PASS_BYTES = 1 << 19


def _doubling(s: np.ndarray) -> np.ndarray:
    """Suffix array of the names, by doubling of ranks."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + nxt
        sa = np.argsort(key, kind="stable")
        ordered = key[sa]
        step = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[sa] = step
        if step[-1] == n - 1 or k >= n:
            return sa
        k *= 2


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """Suffixes in the order that the given order of the leftmost smaller ones induces."""
    counts = np.bincount(t, minlength=sigma)
    ends = np.cumsum(counts)
    starts = ends - counts
    seeds: list[np.ndarray] = [lms[:0]] * sigma
    if len(lms):
        by = np.argsort(t[lms], kind="stable")
        cut = np.searchsorted(t[lms][by], np.arange(sigma + 1))
        ordered = lms[by]
        seeds = [ordered[cut[c] : cut[c + 1]] for c in range(sigma)]
    large: list[list[np.ndarray]] = [[] for _ in range(sigma)]

    def push(before: np.ndarray, into: list[list[np.ndarray]], c: int) -> np.ndarray:
        """Deals suffixes to their buckets in order; gives back those of bucket c."""
        ch = t[before]
        stay = before[ch == c]
        away = before[ch != c]
        if len(away):
            ch = ch[ch != c]
            by = np.argsort(ch, kind="stable")
            cs = ch[by]
            edge = np.flatnonzero(np.concatenate([[True], cs[1:] != cs[:-1], [True]]))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                into[int(cs[a])].append(away[by[a:b]])
        return stay

    for c in range(sigma):
        wave = np.concatenate(large[c]) if large[c] else lms[:0]
        done = [wave]
        while len(wave):
            before = wave[wave > 0] - 1
            wave = push(before[~small[before]], large, c)
            done.append(wave)
        large[c] = [np.concatenate(done)]
        before = seeds[c]
        before = before[before > 0] - 1
        push(before[~small[before]], large, c)
    smaller: list[list[np.ndarray]] = [[] for _ in range(sigma)]  # each kept from the right end
    sa = np.empty(len(t), np.int64)
    for c in range(sigma - 1, -1, -1):
        wave = np.concatenate(smaller[c]) if smaller[c] else lms[:0]
        done = [wave]
        while len(wave):
            before = wave[wave > 0] - 1
            wave = push(before[small[before]], smaller, c)
            done.append(wave)
        s_part = np.concatenate(done) if c else np.array([len(t) - 1])  # nothing stands after the end
        l_part = large[c][0]
        sa[starts[c] : starts[c] + len(l_part)] = l_part
        if len(s_part):
            sa[ends[c] - len(s_part) : ends[c]] = s_part[::-1]
        before = l_part[::-1]
        before = before[before > 0] - 1
        push(before[small[before]], smaller, c)
    return sa


def suffix_array(text: np.ndarray, sigma: int = 257) -> np.ndarray:
    """Suffix array of text (values below sigma, all above 0); an end smaller than all is implied."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    t = np.append(text.astype(np.int32), 0)  # the end
    differ = np.flatnonzero(t[1:] != t[:-1])
    to = np.searchsorted(differ, np.arange(n), side="left")
    small = np.append((t[:-1] < t[1:])[differ[np.minimum(to, len(differ) - 1)]], True)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order = _induce(t, small, lms, sigma)
    is_lms = np.zeros(n + 1, bool)
    is_lms[lms] = True
    ranked = order[is_lms[order]]
    # names: neighbours are equal if their substrings, to the next mark, are
    stop = np.append(lms[1:], n)
    length = np.zeros(n + 1, np.int64)
    length[lms] = stop - lms + 1
    a, b = ranked[:-1], ranked[1:]
    same = (length[a] == length[b]) & (b != n) & (a != n)
    live = np.flatnonzero(same)
    k = 0
    while len(live):
        x, y = a[live], b[live]
        equal = (t[np.minimum(x + k, n)] == t[np.minimum(y + k, n)]) & (small[np.minimum(x + k, n)] == small[np.minimum(y + k, n)])
        same[live[~equal]] = False
        k += 1
        live = live[equal & (length[x] > k)]
    names = np.empty(n + 1, np.int64)
    names[ranked] = np.concatenate([[0], np.cumsum(~same)])
    reduced = names[lms]
    if reduced.max() + 1 < len(lms):
        lms = lms[_doubling(reduced)]
    else:
        lms = lms[np.argsort(reduced, kind="stable")]
    return _induce(t, small, lms, sigma)[1:]


def permuted_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """plcp[i]: length of the common prefix of suffix i and the one before it in the array."""
    n = len(text)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    i = np.arange(n)
    follows = (i > 0) & (phi > 0) & (phi >= 0)
    follows[1:] &= text[:-1] == text[np.maximum(phi[1:] - 1, 0)]
    follows &= np.concatenate([[False], phi[:-1] >= 0])
    first = np.flatnonzero(~follows & (phi >= 0))
    got = np.zeros(n, np.int64)
    live, k = first, 0
    padded = np.append(text.astype(np.int16), np.full(16, -1, np.int16))
    mate = phi[first]
    step = np.arange(16)
    while len(live):
        x = padded[np.minimum(live[:, None] + k + step, n + 15)]
        y = padded[np.minimum(mate[:, None] + k + step, n + 15)]
        equal = (x == y) & (x >= 0)
        run = np.where(equal.all(1), 16, (~equal).argmax(1))
        got[live] += run
        go = run == 16
        live, mate, k = live[go], mate[go], k + 16
    base = np.where(~follows, i, 0)
    last = np.maximum.accumulate(base)
    return np.where(follows, np.maximum(got[last] - (i - last), 0), got)


def repeated_starts(segments: list[bytes], many: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, offset) of every window that starts somewhere else too; many: segments that occur more than once."""
    sizes = np.array([len(s) for s in segments])
    joined = b"\x00".join(segments) + b"\x00"
    text = np.frombuffer(joined, np.uint8).astype(np.int32) + 2  # ends are told apart from zero bytes below
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    text[begin + sizes] = 1
    sa = suffix_array(text, 258)
    plcp = permuted_prefixes(text, sa)
    hit = np.zeros(len(text), bool)
    long_ = np.flatnonzero(plcp >= window)
    hit[long_] = True
    phi = np.full(len(text), -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    hit[phi[long_]] = True
    seg = np.repeat(np.arange(len(segments)), sizes + 1)
    off = np.arange(len(text)) - begin[seg]
    whole = off + window <= sizes[seg]
    at = np.flatnonzero(whole & (hit | many[seg]))
    return seg[at], off[at]


def anchors(texts: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, text, first window, number of windows, repeats itself) of runs of windows with one anchor."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    begin = np.cumsum(sizes) - sizes
    if len(buf) < window:
        e = np.zeros(0, np.int64)
        return e.astype(np.uint64), e, e, e, e.astype(bool)
    grams = rolling(BYTE_CODE[buf], gram)
    low = sliding_min(grams, window - gram + 1)
    change = np.concatenate([[True], low[1:] != low[:-1]])
    some = sizes >= window
    first_w, last_w = begin[some], (begin + sizes - window)[some]
    inside = np.zeros(len(low) + 1, np.int64)
    np.add.at(inside, first_w, 1)
    np.add.at(inside, last_w + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    change[first_w] = True
    start = np.flatnonzero(change & inside)
    cut = np.flatnonzero(change | ~inside)
    stop = np.append(cut, len(low))[np.searchsorted(cut, start, side="right")]
    n = stop - start
    doc = np.repeat(np.arange(len(texts)), sizes)[start]
    # the leftmost place of the anchor in the first window: windows beyond it hold another one
    value = low[start]
    new = grams[start + window - gram] == value
    spot = np.where(new, start + window - gram, start)
    old = np.flatnonzero(new | (grams[start] != value))
    for a in range(0, len(old), 4096):
        o = old[a : a + 4096]
        rows = grams[start[o][:, None] + np.arange(window - gram + 1)] == value[o][:, None]
        spot[o] = start[o] + rows.argmax(1)
    return value, doc, start - begin[doc], n, n > spot - start + 1


def byte_parts(texts: list[bytes], window: int, most: int = PASS_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Batches of (text index, first byte, bytes) of about `most` bytes; the parts of a longer text overlap by window - 1 bytes, so each window is in exactly one."""
    which, first, parts, size = [], [], [], 0
    for i, raw in enumerate(texts):
        for at in range(0, max(1, len(raw) - window + 1), most):
            part = raw[at : at + most + window - 1]
            if parts and size + len(part) > most:
                yield np.array(which), np.array(first), parts
                which, first, parts, size = [], [], [], 0
            which.append(i)
            first.append(at)
            parts.append(part)
            size += len(part)
    if parts:
        yield np.array(which), np.array(first), parts


def _anchor_rows(window: int, gram: int, buckets: int):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_ord, all_th = b.column(0).to_numpy(), b.column(1).to_numpy()
            for at, texts in slices(b, 2):
                found = []
                for which, begin, parts in byte_parts(texts, window):
                    value, doc, first, n, own = anchors(parts, window, gram)
                    found.append((value, which[doc], first + begin[doc], n, own))
                value, doc, first, n, own = (np.concatenate(c) for c in zip(*found, strict=True))
                if not len(value):
                    continue
                bucket = (mix(value) % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((first, doc, bucket))
                edges = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0, [True]]))
                rows = []
                for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    i = order[x:y]
                    rows.append(pack_parts(value[i].tobytes(), all_ord[at + doc[i]].tobytes(), all_th[at + doc[i]].tobytes(), first[i].tobytes(), n[i].astype("<i4").tobytes(), own[i].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[order][edges[:-1]]), pa.array(rows, pa.binary())], ["_bucket", "_z"])

    return run


@released
def _repeated_anchors(group: pa.Table) -> pa.Table:
    """Runs of windows whose anchor occurs more than once, packed by document."""
    parts = [unpack_parts(z) for z in group.column("_z").to_pylist()]
    value, ords, ths, first, n, own = (np.concatenate([np.frombuffer(p[k], kind) for p in parts]) for k, kind in enumerate(("<u8", "<i8", "<i8", "<i8", "<i4", bool)))
    _, back, count = np.unique(value, return_inverse=True, return_counts=True)
    twice = np.zeros(len(count), bool)
    twice[back[own]] = True
    keep = (count > 1)[back] | twice[back]
    value, ords, ths, first, n = value[keep], ords[keep], ths[keep], first[keep], n[keep]
    order = np.lexsort((first, ths, ords))
    edges = np.flatnonzero(np.concatenate([[True], (np.diff(ords[order]) != 0) | (np.diff(ths[order]) != 0), [True]])) if len(order) else np.zeros(1, np.int64)
    at = order[edges[:-1]]
    z = [value[i].tobytes() + first[i].tobytes() + n[i].tobytes() for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True) for i in (order[x:y],)]
    return pa.table({"_ord": pa.array(ords[at], pa.int64()), "_th": pa.array(ths[at], pa.int64()), "_a": pa.array(z, pa.binary())})


def _segments(window: int, shards: int):
    """Cuts the segments around repeated anchors out of the texts; equal ones in a batch are merged."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[int, tuple[list, ...]] = {}
            for o, t, z, many in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                raw = unpack(z.as_py())
                for a in many:
                    k = len(a) // 20
                    value, first, n = np.frombuffer(a, "<u8", k), np.frombuffer(a, "<i8", k, 8 * k), np.frombuffer(a, "<i4", k, 16 * k)
                    shard = (mix(value) % np.uint64(shards)).astype(np.int64)
                    for s, v, f, m in zip(shard.tolist(), value.tolist(), first.tolist(), n.tolist(), strict=True):
                        got = found.setdefault(s, ([], [], [], [], []))
                        got[0].append(o)
                        got[1].append(t)
                        got[2].append(f)
                        got[3].append(raw[f : f + m + window - 1])
                        got[4].append(v)
            rows = []
            for ords, ths, first, segs, values in found.values():
                index: dict[bytes, int] = {}
                which = [index.setdefault(s, len(index)) for s in segs]
                sizes = np.array([len(s) for s in index], "<i4")
                rows.append(pack_parts(np.array(ords, "<i8").tobytes(), np.array(ths, "<i8").tobytes(), np.array(first, "<i8").tobytes(), np.array(which, "<i4").tobytes(), sizes.tobytes(), b"".join(index), np.array(values, "<u8").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(rows, pa.binary())], ["_shard", "_z"])

    return run


def _sort_shard(window: int):
    """Sorts a shard and yields, by document, the runs of window starts that are repeated."""

    @released
    def run(group: pa.Table) -> pa.Table:
        index: dict[bytes, int] = {}
        ords, ths, first, which, values = [], [], [], [], []
        for z in group.column("_z").to_pylist():
            p = unpack_parts(z)
            sizes = np.frombuffer(p[4], "<i4")
            ends = np.cumsum(sizes)
            to = np.array([index.setdefault(p[5][e - s : e], len(index)) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)], np.int64)
            ords.append(np.frombuffer(p[0], "<i8"))
            ths.append(np.frombuffer(p[1], "<i8"))
            first.append(np.frombuffer(p[2], "<i8"))
            which.append(to[np.frombuffer(p[3], "<i4")])
            values.append(np.frombuffer(p[6], "<u8"))
        ords, ths, first, which, values = map(np.concatenate, (ords, ths, first, which, values))
        segments = list(index)
        many = np.bincount(which, minlength=len(segments)) > 1
        # a merged segment that shares its anchor with no other is repeated as a whole; the rest are sorted
        anchor = np.empty(len(segments), np.uint64)
        anchor[which] = values
        _, back, members = np.unique(anchor, return_inverse=True, return_counts=True)
        alone = many & (members[back] == 1)
        sort = np.flatnonzero(~alone)
        seg, off = repeated_starts([segments[i] for i in sort.tolist()], many[sort], window) if len(sort) else (sort, sort)
        seg = sort[seg]
        whole = np.array([len(segments[i]) for i in np.flatnonzero(alone).tolist()], np.int64) - window + 1
        seg = np.concatenate([seg, np.repeat(np.flatnonzero(alone), whole)])
        off = np.concatenate([off, np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)])
        order = np.lexsort((off, seg))
        seg, off = seg[order], off[order]
        brk = np.flatnonzero(np.concatenate([[True], (np.diff(off) != 1) | (np.diff(seg) != 0)])) if len(seg) else np.zeros(0, np.int64)
        size = np.diff(np.append(brk, len(seg)))
        r_seg, r_off = seg[brk], off[brk]
        # every occurrence of a segment takes its runs
        lo, hi = np.searchsorted(r_seg, which, side="left"), np.searchsorted(r_seg, which, side="right")
        times = hi - lo
        occ = np.repeat(np.arange(len(which)), times)
        run_ = np.arange(len(occ)) - np.repeat(np.cumsum(times) - times, times) + lo[occ]
        return pa.table({"_ord": pa.array(ords[occ], pa.int64()), "_th": pa.array(ths[occ], pa.int64()), "_at": pa.array(first[occ] + r_off[run_], pa.int64()), "_n": pa.array(size[run_], pa.int64())})

    return run


def repeated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_ord, _th, _at, _n: runs of _n window starts from byte _at on that also start elsewhere."""
    rows = keyed(docs, id_col, text_col)
    total = text_bytes(rows, "_text")
    gram = min(gram, window)
    sent = rows.mapInArrow(_anchor_rows(window, gram, buckets_for(total, ANCHOR_BYTES)), "_bucket long, _z binary")
    twice = sent.groupBy("_bucket").applyInArrow(_repeated_anchors, "_ord long, _th long, _a binary")
    per_doc = twice.groupBy("_ord", "_th").agg(F.collect_list("_a").alias("_many"))
    cut = pack_text_column(rows).join(per_doc, ["_ord", "_th"]).select("_ord", "_th", "_z", "_many")
    segments = cut.mapInArrow(_segments(window, buckets_for(total, SHARD_BYTES)), "_shard long, _z binary")
    return segments.groupBy("_shard").applyInArrow(_sort_shard(window), "_ord long, _th long, _at long, _n long")


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """_ord, n_bytes, n_removed, n_spans, kept_sha256 and, with_text, kept: the bytes left."""
    names = ["_ord", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in names[1:]]
            for z, runs in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                raw = unpack(z.as_py())
                kept, removed, spans = raw, 0, 0
                if runs:
                    edge = np.zeros(len(raw) + 1, np.int64)
                    at = np.array([r["_at"] for r in runs], np.int64)
                    n = np.array([r["_n"] for r in runs], np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + n + window - 1, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    removed = len(raw) - len(kept)
                    spans = int((np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1).sum())
                for c, v in zip(out, (len(raw), removed, spans, kept if with_text else None, hashlib.sha256(kept).hexdigest()), strict=True):
                    c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names)

    runs = materialize(repeated_bytes(docs, window, gram, id_col, text_col))
    per_doc = runs.groupBy("_ord", "_th").agg(F.collect_list(F.struct("_at", "_n")).alias("_runs"))
    found = pack_text_column(keyed(docs, id_col, text_col)).join(per_doc, ["_ord", "_th"], "left")
    return found.select("_ord", "_z", "_runs").mapInArrow(run, "_ord long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def op7_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document: bytes, bytes removed, their spans and the hash of what is left.  Null text is empty; repeated rows are two documents."""
    return dedup(table(spark, sf_dir, "documents"), with_text=False).select(doc_id_of().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
