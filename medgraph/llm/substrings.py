"""Substring dedup on word windows, partitioned by super-k-mers.

A window is `window` consecutive words.  Its minimiser is the smallest hash among its runs of
`minimiser` words.  Consecutive windows of a document with the same minimiser travel as one
packed string, the super-k-mer, to the minimiser's bucket; equal windows have equal minimisers,
so each bucket sees every occurrence of its windows.  Inside a bucket the windows are sorted by
hash, and neighbours with equal hashes are compared word by word, so counts are exact.  A window
is struck where it also starts in a document with a smaller id.

Only windows that may be repeated travel.  A first pass deals the probes of all windows, the
smallest hashes among their runs of `probe` words, as a few bytes each; equal windows have equal
probes, so a window whose probe is in no document of another id is not struck and strikes none.
What is sent of a probe does not shrink or grow with the number of buckets as packed text does.
A probe that several documents of a slice hold is told to its bucket by two of them.

Before the shuffle, a task strikes super-k-mers whose string it has already met in a document
with a smaller id (in the same batch of strings, or among the strings that repeated in earlier
ones); what is known of them needs no bucket and is dealt evenly.  So a passage that a third of
the corpus shares reaches its bucket about once a task.  The number of buckets follows the size
of the corpus; a bucket is sorted in parts of about PART_BYTES, so memory does not.

Null text has no words; a null id counts as later than any other.  Rows that repeat id and text
get equal results; a window repeated inside one document is not struck by itself.  Long texts are
taken whole: only a document's own strings are held at once.  Extra columns are kept or ignored
as the caller asks.  A long text is read in parts of common.PASS_BYTES that overlap by a window less
one word; about ten bytes for each of its bytes are held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SEPARATORS, SLICE_BYTES, Words, buckets_for, doc_id_of, keyed, mix, pack_parts, pack_text_column, packed_rows, released, rewritten, sliding_min, slices, table, text_bytes, text_parts, unpack, unpack_parts

WINDOW = 13
MINIMISER = 3
#: Words of a probe: enough to be repeated hardly ever but by repeated text.
PROBE = 7
#: Corpus bytes whose probes share a bucket.
PROBE_BYTES = 32 << 20
#: Corpus bytes whose super-k-mers (about three times as long, if all travel) share a bucket.
BUCKET_BYTES = 3 << 20
#: Bytes of super-k-mers that a task packs at once: what a slice makes if all travel.
GATHER_BYTES = 3 * SLICE_BYTES
#: Bytes of super-k-mers that are sorted at once.
PART_BYTES = 1 << 20
#: zstd level of what travels to the buckets: about three times the text, so a tenth less of it is worth the time.
LEVEL = 6
#: Repeated strings that a task remembers, in each of two generations.
REMEMBERED = 30_000
_SPACES = bytes.maketrans(bytes(SEPARATORS), b" " * len(SEPARATORS))


def words_of(raw: bytes) -> list[bytes]:
    return [w for w in raw.translate(_SPACES).split(b" ") if w]


def super_kmers(words: Words, window: int, minimiser: int, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser value, first word, number of windows) of every super-k-mer; among: first words of the only windows to take, ascending."""
    low = sliding_min(words.grams(minimiser), window - minimiser + 1)
    ok = np.flatnonzero(words.same_doc(window)) if among is None else among
    if not len(ok):
        return np.zeros(0, np.uint64), ok, ok
    low, doc = low[ok], words.doc[ok]
    first = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | (np.diff(ok) != 1)]))
    return low[first], ok[first], np.diff(np.append(first, len(ok)))


def probe_keys(low: np.ndarray, buckets: int) -> np.ndarray:
    """What tells probes apart: the bucket (the remainder) and 32 more bits.  Different probes under one key only travel in vain."""
    return mix(low) % np.uint64(buckets << 32)


def _runs_of(*columns: np.ndarray) -> np.ndarray:
    """Where runs of rows with equal columns begin, and the number of rows at the end."""
    new = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    return np.flatnonzero(np.concatenate([[True], new, [True]])) if len(columns[0]) else np.zeros(1, np.int64)


def _pack_keys(ords: np.ndarray, ths: np.ndarray, keys: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Documents, how many keys each has, and the keys; rows of one document come together."""
    edges = _runs_of(ords, ths)
    return ords[edges[:-1]].tobytes(), ths[edges[:-1]].tobytes(), np.diff(edges).astype("<u4").tobytes(), keys.tobytes()


def _send_probes(window: int, probe: int, buckets: int):
    """Packs the keys of probes by bucket: one row per slice and bucket, and one of those already known to be repeated."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_ord, all_th = b.column(0).to_numpy(), b.column(1).to_numpy()
            for at, texts in slices(b, 2):
                found = []
                for which, _, parts in text_parts(texts, window):
                    words = Words(parts)
                    low, first, _ = super_kmers(words, window, probe)
                    found.append((probe_keys(low, buckets), np.asarray(which)[words.doc[first]]))
                key, doc = (np.concatenate(c) for c in zip(*found, strict=True))
                if not len(key):
                    continue
                order = np.lexsort((doc, all_ord[at + doc], key))
                order = order[_runs_of(key[order], doc[order])[:-1]]
                key, doc = key[order], doc[order]
                ords, ths = all_ord[at + doc], all_th[at + doc]
                edges = _runs_of(key)
                size = np.diff(edges)
                least, most = ords[edges[:-1]], ords[edges[1:] - 1]
                known = np.repeat(least < most, size)
                ask = ~known
                ask[edges[:-1]] = ask[edges[1:] - 1] = True
                bucket = (key % np.uint64(buckets)).astype(np.int64)
                i = np.flatnonzero(ask)
                i = i[np.lexsort((key[i], ths[i], ords[i], bucket[i]))]
                tag = (key // np.uint64(buckets)).astype("<u4")
                cut = _runs_of(bucket[i])
                rows = [pack_parts(*_pack_keys(ords[j], ths[j], tag[j])) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) for j in (i[x:y],)]
                to = bucket[i[cut[:-1]]].tolist()
                if known.any():
                    i = np.flatnonzero(known)
                    i = i[np.lexsort((ths[i], ords[i]))]
                    rows.append(pack_parts(*_pack_keys(ords[i], ths[i], key[i]), b""))
                    to.append(int(mix(all_th[at : at + 1].view(np.uint64))[0] % np.uint64(buckets)))
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array(rows, pa.binary())], ["_bucket", "_z"])

    return run


def _repeated_probes(buckets: int):
    """The keys that documents of several ids hold, packed by document."""

    @released
    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("_bucket")[0].as_py()
        out: list[tuple[np.ndarray, ...]] = []
        asked = []
        for z in group.column("_z"):
            p = unpack_parts(z.as_py())
            ords, ths, n = np.frombuffer(p[0], "<i8"), np.frombuffer(p[1], "<i8"), np.frombuffer(p[2], "<u4")
            if len(p) == 5:
                out.append((np.repeat(ords, n), np.repeat(ths, n), np.frombuffer(p[3], "<u8")))
            else:
                asked.append((ords, ths, n, np.frombuffer(p[3], "<u4")))
        if asked:
            ords, ths, n, tag = (np.concatenate(c) for c in zip(*asked, strict=True))
            doc = np.repeat(np.arange(len(ords), dtype=np.int32), n)
            order = np.argsort(tag, kind="stable")
            edges = _runs_of(tag[order])[:-1]
            o = ords[doc[order]]
            some = np.minimum.reduceat(o, edges) < np.maximum.reduceat(o, edges)
            i = np.sort(order[np.repeat(some, np.diff(np.append(edges, len(o))))])
            out.append((ords[doc[i]], ths[doc[i]], tag[i].astype(np.uint64) * np.uint64(buckets) + np.uint64(bucket)))
        ords, ths, key = (np.concatenate(c) for c in zip(*out, strict=True))
        order = np.lexsort((ths, ords))
        ords, ths, key = ords[order], ths[order], key[order]
        edges = _runs_of(ords, ths)
        keys = [key[x:y].tobytes() for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        return pa.table({"_ord": pa.array(ords[edges[:-1]], pa.int64()), "_th": pa.array(ths[edges[:-1]], pa.int64()), "_keys": pa.array(keys, pa.binary())})

    return run


class Repeats:
    """Strings that repeated in this task, with the smallest id they were met under; bounded, the older half goes first."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.new, self.old = most, {}, {}

    def get(self, s: bytes) -> int | None:
        got = self.new.get(s)
        return self.old.get(s) if got is None else got

    def put(self, s: bytes, o: int) -> None:
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        self.new[s] = o


def known_before(strings: list[bytes], ords: np.ndarray, repeats: Repeats) -> np.ndarray:
    """Which strings were met under a smaller id, here or among the repeats."""
    known = np.zeros(len(strings), bool)
    best: dict[bytes, int] = {}
    ids = ords.tolist()
    for i in np.argsort(ords, kind="stable").tolist():
        s, o = strings[i], ids[i]
        low = best.get(s)
        if low is None:
            low = repeats.get(s)
            best[s] = low = o if low is None or low > o else low
        if low < o:
            known[i] = True
            repeats.put(s, low)
    return known


def _send(window: int, minimiser: int, probe: int, probe_buckets: int, buckets: int):
    """Packs the super-k-mers of windows with repeated probes by bucket: one row per GATHER_BYTES of them and bucket, and one of those already struck."""

    def packed(found: list[tuple[np.ndarray, ...]], strings: list[bytes], repeats: Repeats) -> pa.RecordBatch:
        low, ords, ths, place, n = (np.concatenate(c) for c in zip(*found, strict=True))
        known = known_before(strings, ords, repeats)
        sub = (low // np.uint64(buckets)).astype(np.uint8)
        bucket = (low % np.uint64(buckets)).astype(np.int64)
        new = np.flatnonzero(~known)
        order = new[np.lexsort((ths[new], ords[new], bucket[new]))]
        edges = _runs_of(bucket[order])
        rows = [pack_parts(ords[i].tobytes(), ths[i].tobytes(), place[i].tobytes(), n[i].tobytes(), sub[i].tobytes(), b"\n".join([strings[k] for k in i.tolist()]), level=LEVEL) for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True) for i in (order[x:y],)]
        to = bucket[order[edges[:-1]]].tolist()
        if known.any():
            rows.append(pack_parts(ords[known].tobytes(), ths[known].tobytes(), place[known].tobytes(), n[known].tobytes()))
            to.append(int(mix(ths[:1].view(np.uint64))[0] % np.uint64(buckets)))
        return pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array(rows, pa.binary())], ["_bucket", "_z"])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeats = Repeats()
        found, strings, size = [], [], 0
        for b in batches:
            all_ord, all_th, all_keys = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(3)
            for at, texts in slices(b, 2, read=unpack):
                keys = np.unique(np.concatenate([np.frombuffer(k, "<u8") for many in all_keys.slice(at, len(texts)).to_pylist() for k in many]))
                for which, word, parts in text_parts(texts, window):
                    words = Words(parts)
                    low, first, n = super_kmers(words, window, probe)
                    some = np.isin(probe_keys(low, probe_buckets), keys)
                    first, n = first[some], n[some]
                    if not len(first):
                        continue
                    among = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    low, first, n = super_kmers(words, window, minimiser, among)
                    own = words.doc[first]
                    doc = at + np.asarray(which)[own]
                    found.append((low, all_ord[doc], all_th[doc], (np.asarray(word)[own] + first - words.first[own]).astype("<i4"), n.astype("<i4")))
                    norm = b" ".join(w for t in parts for w in words_of(t)) + b" "
                    begin = np.concatenate([[0], np.cumsum(words.end - words.start + 1)])
                    new = [norm[x:y] for x, y in zip(begin[first].tolist(), (begin[first + n + window - 1] - 1).tolist(), strict=True)]
                    strings += new
                    size += sum(map(len, new))
                    if size >= GATHER_BYTES:
                        yield packed(found, strings, repeats)
                        found, strings, size = [], [], 0
        if found:
            yield packed(found, strings, repeats)

    return run


def _runs(ords: np.ndarray, ths: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.Table:
    return pa.table({"_ord": pa.array(ords, pa.int64()), "_th": pa.array(ths, pa.int64()), "_at": pa.array(start, pa.int32()), "_n": pa.array(n, pa.int32())})


def same_windows(words: Words, start: np.ndarray, a: np.ndarray, b: np.ndarray, window: int) -> np.ndarray:
    """Whether windows a and b (indexes into start) hold the same words, byte by byte."""
    ok = np.ones(len(a), bool)
    sizes = words.end - words.start
    for k in range(window):
        x, y = start[a] + k, start[b] + k
        ok &= sizes[x] == sizes[y]
    for k in np.flatnonzero(ok).tolist():
        x, y = start[a[k]], start[b[k]]
        # words in a string are one space apart, so equal sizes make equal layouts
        ok[k] = words.buf[words.start[x] : words.end[x + window - 1]].tobytes() == words.buf[words.start[y] : words.end[y + window - 1]].tobytes()
    return ok


def struck_windows(texts: list[bytes], ords: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(super-k-mer, first window, windows) of the runs of windows that also start under a smaller id."""
    words = Words(texts)
    sk = np.repeat(np.arange(len(texts)), n)
    inside = np.arange(len(sk)) - np.repeat(np.cumsum(n) - n, n)
    start = words.first[sk] + inside
    h = words.grams(window)[start]
    o = ords[sk]
    order = np.lexsort((o, h))
    hs, os = h[order], o[order]
    head = np.concatenate([[True], hs[1:] != hs[:-1]])
    lead = np.maximum.accumulate(np.where(head, np.arange(len(hs)), 0))
    later = np.flatnonzero(os > os[lead])
    struck = np.zeros(len(sk), bool)
    ok = same_windows(words, start, order[later], order[lead[later]], window)
    struck[order[later[ok]]] = True
    for i in later[~ok].tolist():  # two windows under one hash: look through all of it
        x = i
        while not head[x]:
            x -= 1
            if os[x] < os[i] and same_windows(words, start, order[i : i + 1], order[x : x + 1], window)[0]:
                struck[order[i]] = True
                break
    at = np.flatnonzero(struck)
    brk = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(sk[at]) != 0)])) if len(at) else at
    return sk[at[brk]], inside[at[brk]], np.diff(np.append(brk, len(at)))


def _count(window: int):
    """Sorts the windows of a bucket, part by part, and yields the runs of windows that are struck."""

    @released
    def run(group: pa.Table) -> pa.Table:
        parts = [unpack_parts(z.as_py()) for z in group.column("_z")]
        kinds = ("<i8", "<i8", "<i4", "<i4", "u1")
        out = [tuple(np.frombuffer(p[k], kinds[k]) for k in range(4)) for p in parts if len(p) == 4]
        parts = [p for p in parts if len(p) > 4]
        if parts:
            ords, ths, place, n, sub = (np.concatenate([np.frombuffer(p[k], kind) for p in parts]) for k, kind in enumerate(kinds))
            texts = [t for p in parts for t in p[5].split(b"\n")]
            cuts = min(256, -(-sum(len(p[5]) for p in parts) // PART_BYTES))
            part = sub.astype(np.int64) * cuts >> 8
            for k in range(cuts):
                i = np.flatnonzero(part == k)
                if len(i):
                    sk, inside, size = struck_windows([texts[j] for j in i.tolist()], ords[i], n[i], window)
                    out.append((ords[i[sk]], ths[i[sk]], place[i[sk]] + inside, size))
        return _runs(*(np.concatenate(c) for c in zip(*out, strict=True)))

    return run


def repeated_windows(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id", text_col: str = "text", texts: DataFrame | None = None) -> DataFrame:
    """_ord, _th, _at, _n: runs of _n windows from word _at on that also start in a document with a smaller id.

    texts: the documents as _ord, _th, _z and what else a caller joins runs to; all of it is joined
    here too, so that both joins read one shuffle of the texts.
    """
    rows = keyed(docs, id_col, text_col)
    total = text_bytes(rows, "_text")
    probe, probe_buckets = min(PROBE, window), buckets_for(total, PROBE_BYTES)
    probes = rows.mapInArrow(_send_probes(window, probe, probe_buckets), "_bucket long, _z binary")
    repeated = probes.groupBy("_bucket").applyInArrow(_repeated_probes(probe_buckets), "_ord long, _th long, _keys binary")
    per_doc = repeated.groupBy("_ord", "_th").agg(F.collect_list("_keys").alias("_many"))
    texts = pack_text_column(rows) if texts is None else texts
    some = texts.join(per_doc, ["_ord", "_th"]).select("_ord", "_th", "_z", "_many", *[c for c in texts.columns if c not in ("_ord", "_th", "_z")])
    sent = some.mapInArrow(_send(window, minimiser, probe, probe_buckets, buckets_for(total, bucket_bytes)), "_bucket long, _z binary")
    return sent.groupBy("_bucket").applyInArrow(_count(window), "_ord long, _th long, _at int, _n int")


def covered(n_words: int, starts: list[int], sizes: list[int], window: int) -> np.ndarray:
    """Words covered by the runs of windows."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, np.asarray(starts, np.int64), 1)
    np.add.at(edge, np.asarray(starts, np.int64) + np.asarray(sizes, np.int64) + window - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def joinable(texts: DataFrame) -> DataFrame:
    """texts as an inner join would have them (no key is null anyway), so that an outer one shuffles the same."""
    return texts.where("_ord is not null and _th is not null")


def with_runs(texts: DataFrame, runs: DataFrame) -> DataFrame:
    """_ord, _th, _z, _runs: every row with its runs (null if none)."""
    per_doc = runs.groupBy("_ord", "_th").agg(F.collect_list(F.struct("_at", "_n")).alias("_runs"))
    return texts.join(per_doc, ["_ord", "_th"], "left")


def dedup(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """_ord, n_words, n_removed, kept_sha256 and, with_text, kept: the words left, joined by one space."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, kept, sha = [], [], [], []
            for z, runs in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                words = words_of(unpack(z.as_py()))
                n_words.append(len(words))
                if runs:
                    gone = covered(len(words), [r["_at"] for r in runs], [r["_n"] for r in runs], window)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                n_removed.append(n_words[-1] - len(words))
                left = b" ".join(words)
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode("utf-8") if with_text else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(sha, pa.string())], ["_ord", "n_words", "n_removed", "kept", "kept_sha256"])

    texts = joinable(pack_text_column(keyed(docs, id_col, text_col)))
    found = with_runs(texts, repeated_windows(docs, window, minimiser, id_col=id_col, text_col=text_col, texts=texts))
    return found.select("_ord", "_z", "_runs").mapInArrow(run, "_ord long, n_words long, n_removed long, kept string, kept_sha256 string")


def strip_repeats(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """docs with the struck words, and the space after them, cut out of text; rows of which no word is left go."""

    def cut(raw: bytes, runs: list) -> bytes:
        w = Words([raw])
        gone = covered(len(w.start), [r["_at"] for r in runs], [r["_n"] for r in runs], window)
        keep = np.ones(len(raw), bool)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        for a, z in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):
            keep[int(w.start[a]) : int(w.start[z]) if z < len(w.start) else len(raw)] = False
        return np.frombuffer(raw, np.uint8)[keep].tobytes()

    texts = joinable(packed_rows(docs))
    return rewritten(docs, repeated_windows(docs, window, minimiser, texts=texts), cut, texts)


def op9_super_kmer_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document: words, words removed and the hash of what is left.  Null text has no words; a null id is later than any other."""
    return dedup(table(spark, sf_dir, "documents"), with_text=False).select(doc_id_of().alias("doc_id"), "n_words", "n_removed", "kept_sha256")
