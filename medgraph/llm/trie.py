"""Conversation prefix trie: padded turn-id matrices, sorted by shard, with the nodes at shard ends put together.

A turn is a record: 16 bytes of the SHA-256 of (role, text) and the text's size.  A conversation
is the records of its turns in order of turn (null first, equal ones by record), cut into rows of
at most BLOCK turns; a row knows the digest of all turns before it, so rows with the same digest
begin at the same node, and a conversation of any length is many small rows.

Rows are dealt by range of (block, digest, records, end, conversation), so that conversations of
equal turns, however many, are split over shards by id.  A shard makes a padded matrix of turn ids
(ranks of the records), sorts it with lexsort, and ORs the changes from row to row along the
columns: where the mask of a column is set, a node of that depth starts, or a shorter row stands.
reduceat over the starts gives the members, children, leaves and savings of every node of a depth.
A shard is told the last row before it and the first row after it, so that it knows which nodes
start in it and which rows end a leaf; every count is then a sum over rows, and nodes that reach
beyond a shard (and nodes at the end of a block, whose children are in other rows) are partial:
their sums are added by the digest of their turns.

Savings below a node are its rows' text bytes from its depth on, less those of the nodes that
start there; what later blocks of a row add to it is summed by conversation first.

`rebuilt` gives a conversation the first turns of another.  Null role or text is empty.  Rows
without a conv_id take no part; repeated rows are repeated turns; other columns are ignored.  An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets_for, materialize, pack, released, table, unpack

#: Turns of a row at most, bytes of a turn's record, and rows and bytes of a shard.
BLOCK, RECORD = 256, 24
SHARD_ROWS, SHARD_BYTES = 16_384, 4 << 20
#: Conversations in a family, and how many first turns one may take of its family's first: 0 to HEADS - 1.
FAMILY, HEADS = 5, 9
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_records(df: DataFrame) -> DataFrame:
    """conv, turn, rec: a turn's record of RECORD bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    size = F.unhex(F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0"))
    return df.select(F.col("conv_id").cast("long").alias("conv"), "turn", F.concat(name, size).alias("rec")).where("conv is not null")


def turns_in(seq: str) -> Column:
    return (F.octet_length(seq) / RECORD).cast("long")


def pieces(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv, start, n, total, seq: runs of at most `block` records of a conversation, from its turn `start` on; a conversation with very many turns is in many tasks."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, k, p, most = None, b"", 0, 0, block * RECORD
        out: list[tuple[int, int, int, bytes]] = []
        for b in batches:
            if not b.num_rows:
                continue
            p = b.column(0)[0].as_py()
            convs, data = b.column(1).to_numpy(), b"".join(b.column(2).to_pylist())
            edge = np.concatenate([[0], np.flatnonzero(convs[1:] != convs[:-1]) + 1, [len(convs)]]).tolist()
            for s, e in zip(edge[:-1], edge[1:], strict=True):
                if convs[s] != conv:
                    if held:
                        out.append((p, conv, k, held))
                    conv, held, k = int(convs[s]), b"", 0
                held += data[s * RECORD : e * RECORD]
                while len(held) > most:
                    out.append((p, conv, k, held[:most]))
                    held, k = held[most:], k + 1
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("p", "conv", "k", "seq"), x, strict=True)) for x in out], schema)
                out = []
        if held:
            yield pa.RecordBatch.from_pylist([{"p": p, "conv": conv, "k": k, "seq": held}], schema)

    schema = pa.schema([("p", pa.int32()), ("conv", pa.int64()), ("k", pa.int64()), ("seq", pa.binary())])
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("rec")]
    ranged = turn_records(df).repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("p"), "conv", "rec")
    found = ranged.mapInArrow(run, "p int, conv long, k long, seq binary").withColumn("n", turns_in("seq"))
    own = Window.partitionBy("conv")
    before = own.orderBy("p", "k").rowsBetween(Window.unboundedPreceding, -1)
    return found.select("conv", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), "n", F.sum("n").over(own).alias("total"), "seq")


def in_order(at: str, seq: str) -> Column:
    """Aggregate: byte strings one after the other by their places."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(at).alias("a"), F.hex(seq).alias("s"))))
    return F.unhex(F.array_join(F.transform(parts, lambda x: x["s"]), ""))


def cut(seq: Column | str, first: Column, n: Column) -> Column:
    """n records of seq from `first` on."""
    return F.substring(seq, (1 + RECORD * first).cast("int"), (RECORD * n).cast("int"))


def rebuilt(df: DataFrame, block: int = BLOCK, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """conv, blk, seq, more: rows of at most `block` turns; more: the conversation goes on after the row.

    A conversation is the first h turns of its family's first (id - id mod family; none if there is none),
    then its own turns from h on; h is the CRC-32 of the decimal id modulo `heads`.
    """
    if block < heads - 1:
        raise ValueError("a block must hold the first turns of a family")
    own = materialize(pieces(df, block))
    first = own.where("start = 0").select("conv", "total", (F.crc32(F.col("conv").cast("string")) % heads).alias("h"), (F.col("conv") - F.pmod("conv", F.lit(family))).alias("base"))
    head = own.where((F.pmod("conv", F.lit(family)) == 0) & (F.col("start") < heads - 1)).groupBy(F.col("conv").alias("base")).agg(in_order("start", "seq").alias("head"))
    info = first.join(head, "base", "left").withColumn("head", F.coalesce(F.substring("head", F.lit(1), (RECORD * F.col("h")).cast("int")), F.unhex(F.lit(""))))
    info = info.withColumn("m", turns_in("head")).withColumn("all", F.col("m") + F.greatest(F.col("total") - F.col("h"), F.lit(0)))
    skip = F.greatest(F.least(F.col("h") - F.col("start"), F.col("n")), F.lit(0))
    rest = own.drop("total").join(info.select("conv", "h", "m", "all"), "conv").where(F.col("n") > skip)
    rest = rest.select("conv", "all", (F.col("m") + F.greatest(F.col("start") - F.col("h"), F.lit(0))).alias("start"), cut("seq", skip, F.col("n") - skip).alias("seq"))
    runs = info.select("conv", "all", F.lit(0).cast("long").alias("start"), F.col("head").alias("seq")).unionByName(rest).withColumn("n", turns_in("seq"))
    room = block - F.pmod("start", F.lit(block))
    blk = F.floor(F.col("start") / block)
    two = F.array(
        F.struct(blk.alias("blk"), F.col("start").alias("start"), cut("seq", F.lit(0), room).alias("seq")),
        F.struct((blk + 1).alias("blk"), (F.col("start") + room).alias("start"), cut("seq", room, F.col("n")).alias("seq")),
    )
    split = runs.select("conv", "all", F.inline(F.filter(two, lambda x: (x["start"] == 0) | (F.octet_length(x["seq"]) > 0))))
    return split.groupBy("conv", "blk").agg(in_order("start", "seq").alias("seq"), F.first("all").alias("all")).select("conv", "blk", "seq", ((F.col("blk") + 1) * block < F.col("all")).alias("more"))


def digest(before: bytes, seq: bytes) -> bytes:
    """Names the node at the end of seq, of at most a block, below the node `before`."""
    return hashlib.sha256(before + hashlib.sha256(seq).digest()).digest()[:16]


def with_digests(rows: DataFrame) -> DataFrame:
    """rows with pre, the digest of the turns before (empty in the first block)."""
    none = F.unhex(F.lit(""))
    if rows.where("blk > 0").isEmpty():
        return rows.withColumn("pre", none)
    long = rows.where("blk > 0 or more").groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("blk", F.unhex(F.sha2("seq", 256)).alias("s")))).alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for conv, blocks in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                pre = b""
                for x in blocks:
                    if x["blk"]:
                        out.append((conv, x["blk"], pre))
                    pre = hashlib.sha256(pre + x["s"]).digest()[:16]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["conv", "blk", "pre"])

    later = long.mapInArrow(run, "conv long, blk long, pre binary")
    return rows.join(later, ["conv", "blk"], "left").withColumn("pre", F.coalesce("pre", none))


class Shard:
    """The sorted matrix of a shard's rows and, at its ends, of the rows before and after (side -1 and 1)."""

    def __init__(self, t: pa.Table):
        get = {c: t.column(c) for c in t.column_names}
        side, self.blk, conv = (get[c].to_numpy() for c in ("side", "blk", "conv"))
        more = get["more"].to_numpy(zero_copy_only=False).astype(bool)
        seq, pre = get["seq"].to_pylist(), get["pre"].to_pylist()
        n = np.array([len(s) // RECORD for s in seq])
        rec = np.frombuffer(b"".join(seq), ">u8").reshape(-1, 3).astype(np.uint64)
        order = np.lexsort((rec[:, 1], rec[:, 0]))
        hi, lo = rec[order, 0], rec[order, 1]
        rank = np.empty(len(rec), np.int32)
        rank[order] = np.cumsum(np.concatenate([[1], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])])) if len(rec) else 0
        begins = {k: i for i, k in enumerate(sorted(set(zip(self.blk.tolist(), pre, strict=True))))}
        wide = int(n.max())
        ids, size = np.zeros((len(n), wide + 1), np.int32), np.zeros((len(n), wide + 1), np.int64)
        ids[:, 0] = [begins[k] for k in zip(self.blk.tolist(), pre, strict=True)]
        at = np.repeat(np.arange(len(n)), n), 1 + np.arange(len(rec)) - np.repeat(np.cumsum(n) - n, n)
        ids[at], size[at] = rank, rec[:, 2].astype(np.int64)
        by = np.lexsort((conv, more, *ids.T[::-1], side))
        ids, side = ids[by], side[by]
        changed = np.concatenate([np.ones((1, wide + 1), bool), np.logical_or.accumulate(ids[1:] != ids[:-1], axis=1)])
        own = np.flatnonzero(side == 0)
        a, z = int(own[0]), int(own[-1]) + 1
        by = by[a:z]
        self.wide, self.blk, self.conv, self.more, self.n = wide, self.blk[by], conv[by], more[by], n[by]
        self.seq, self.pre = [seq[i] for i in by], [pre[i] for i in by]
        #: where the next shard's first row differs from the last row here; all, if there is none
        self.after = changed[z] if z < len(ids) else np.ones(wide + 1, bool)
        self.changed = changed[a:z]
        self.starts = self.changed & (np.arange(wide + 1) <= self.n[:, None])
        following = np.concatenate([self.changed[1:], self.after[None]])
        self.leaf = (following[np.arange(z - a), self.n] & ~self.more).astype(np.int64)
        saved = np.where(self.starts, 0, size[by])
        #: what a row saves from each depth on
        self.saved = np.cumsum(saved[:, ::-1], axis=1)[:, ::-1]
        self.leaf_below, self.saved_below = (get[c].to_numpy()[by] for c in ("leaf_below", "saved_below"))


NODE = "shard int, key binary, depth long, conv long, parent_conv long, parent_key binary, n_convs long, n_children long, n_leaves long, saved long, ends_sha string, ends binary"
_TYPES = [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4, pa.string(), pa.binary()]


def shard_nodes(t: pa.Table, block: int) -> pa.Table:
    """Every node that has rows in the shard; partial ones have their digest as key."""
    s, number = Shard(t), t.column("shard")[0].as_py()
    rows = len(s.n)
    leaves = s.leaf + s.leaf_below
    out: list[list] = [[] for _ in _TYPES]
    above = None
    for j in range(s.wide + 1):
        at = np.flatnonzero(s.changed[:, j])
        at = at if len(at) and at[0] == 0 else np.concatenate([[0], at])
        real = s.n[at] >= j
        ends = np.add.reduceat(((s.n == j) & ~s.more).astype(np.int64), at)
        part = np.zeros(len(at), bool)
        part[0] |= not s.changed[0, j]
        part[-1] |= not s.after[j]
        if j == 0:
            part |= s.blk[at] > 0
        if j == block:
            part |= np.logical_or.reduceat(s.more, at)
        below = (s.blk[at] > 0) & (j == 0)  # seen from the rows of a later block: it only has children here
        values = [
            np.diff(np.append(at, rows)),
            np.add.reduceat(s.starts[:, j + 1].astype(np.int64), at) if j < s.wide else np.zeros(len(at), np.int64),
            np.add.reduceat(leaves, at),
            np.add.reduceat(s.saved[:, j] + s.saved_below, at),
        ]
        for k in (0, 2, 3):
            values[k] = np.where(below, 0, values[k])
        low = np.minimum.reduceat(s.conv, at)
        keys = [(s.pre[i] if b else digest(s.pre[i], s.seq[i][: j * RECORD])) if p and r else None for i, p, r, b in zip(at.tolist(), part.tolist(), real.tolist(), below.tolist(), strict=True)]
        if j:
            up = np.searchsorted(above[0], at, side="right") - 1
            up_key = [above[2][u] for u in up.tolist()]
            up_conv = [None if k is not None else c for k, c in zip(up_key, above[1][up].tolist(), strict=True)]
        else:
            up_key = up_conv = [None] * len(at)
        listed = [",".join(map(str, s.conv[i : i + e].tolist())).encode() if e and not b else b"" for i, e, b in zip(at.tolist(), ends.tolist(), below.tolist(), strict=True)]
        whole = [None if k is not None else hashlib.sha256(x).hexdigest() if x else NO_ENDS for k, x in zip(keys, listed, strict=True)]
        chunk = [pack(x) if k is not None and x else None for k, x in zip(keys, listed, strict=True)]
        columns = [[number] * len(at), keys, (s.blk[at] * block + j).tolist(), low.tolist(), up_conv, up_key, *(v.tolist() for v in values), whole, chunk]
        for o, c in zip(out, columns, strict=True):
            o += [x for x, r in zip(c, real.tolist(), strict=True) if r]
        above = (at, low, keys)
    return pa.Table.from_arrays([pa.array(o, k) for o, k in zip(out, _TYPES, strict=True)], [x.split()[0] for x in NODE.split(", ")])


def shard_values(t: pa.Table) -> pa.Table:
    """conv, blk, leaf, saved: what each row adds to the nodes above its block."""
    s = Shard(t)
    saved = s.saved[:, 1] if s.wide else np.zeros(len(s.n), np.int64)
    return pa.Table.from_arrays([pa.array(s.conv), pa.array(s.blk), pa.array(s.leaf), pa.array(saved)], ["conv", "blk", "leaf", "saved"])


def ends_hashes(part: DataFrame) -> DataFrame:
    """key, ends_sha: the ids that end at a node of several shards, hashed as they come, shard after shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for b in batches:
            done: list[tuple[bytes, str]] = []
            for k, z in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(unpack(z.as_py()))
                else:
                    sha.update(b"," + unpack(z.as_py()))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["key", "ends_sha"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([sha.hexdigest()])], ["key", "ends_sha"])

    some = part.where("ends is not null").repartition("key").sortWithinPartitions("key", "shard").select("key", "ends")
    return some.mapInArrow(run, "key binary, ends_sha string")


def trie(rows: DataFrame, block: int = BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of rows (conv, blk, seq, more)."""
    rows = materialize(with_digests(materialize(rows)))
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("seq")).alias("b")).first()
    shards = max(buckets_for(size["n"], shard_rows, 1), buckets_for(size["b"] or 0, SHARD_BYTES, 1))
    order = ["blk", "pre", "seq", "more", "conv"]
    ranged = materialize(rows.repartitionByRange(shards, *order).withColumn("shard", F.spark_partition_id()))

    # the rows next to each shard: one first and one last row a shard
    ends = ranged.groupBy("shard").agg(F.min(F.struct(*order)).alias("lo"), F.max(F.struct(*order)).alias("hi"))
    by_shard = Window.orderBy("shard")
    pair = ends.select("shard", F.lag("hi").over(by_shard).alias("before"), F.lead("lo").over(by_shard).alias("after"))
    two = F.array(F.struct(F.lit(-1).alias("side"), F.col("before").alias("r")), F.struct(F.lit(1).alias("side"), F.col("after").alias("r")))
    beside = materialize(pair.select("shard", F.inline(two)).where("r is not null").select("shard", "side", "r.*"))
    columns = ["shard", "side", *order]
    zero = F.lit(0).cast("long")
    own = ranged.withColumn("side", F.lit(0)).select(*columns)
    later = own.where("blk > 0")
    below = None
    if not later.isEmpty():
        both = later.withColumns({"leaf_below": zero, "saved_below": zero}).unionByName(beside.join(later.select("shard").distinct(), "shard", "left_semi").withColumns({"leaf_below": zero, "saved_below": zero}))
        values = both.groupBy("shard").applyInArrow(released_table(shard_values), "conv long, blk long, leaf long, saved long")
        from_end = Window.partitionBy("conv").orderBy(F.desc("blk")).rowsBetween(Window.unboundedPreceding, 0)
        below = values.select("conv", (F.col("blk") - 1).alias("blk"), F.sum("leaf").over(from_end).alias("leaf_below"), F.sum("saved").over(from_end).alias("saved_below"))
        own = own.join(below, ["conv", "blk"], "left").select(*columns, F.coalesce("leaf_below", zero).alias("leaf_below"), F.coalesce("saved_below", zero).alias("saved_below"))
    else:
        own = own.withColumns({"leaf_below": zero, "saved_below": zero})
    both = own.unionByName(beside.select(*columns).withColumns({"leaf_below": zero, "saved_below": zero}))
    nodes = materialize(both.groupBy("shard").applyInArrow(released_table(lambda t: shard_nodes(t, block)), NODE))

    part = nodes.where("key is not null")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    merged = part.groupBy("key").agg(F.min("depth").alias("depth"), F.min("conv").alias("conv"), F.min("parent_conv").alias("parent_conv"), F.max("parent_key").alias("parent_key"), *sums)
    merged = materialize(merged.join(ends_hashes(part), "key", "left").withColumn("ends_sha", F.coalesce("ends_sha", F.lit(NO_ENDS))))
    of = merged.select(F.col("key").alias("parent_key"), F.col("conv").alias("_up"))
    in_shard = part.select("shard", F.col("key").alias("parent_key")).distinct().join(of, "parent_key")  # a parent of very many children is in very many shards
    fields = ["conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends_sha"]
    up = F.coalesce("parent_conv", "_up").alias("parent_conv")
    pick = [up if c == "parent_conv" else F.col(c) for c in fields]
    whole = nodes.where("key is null")
    out = whole.where("parent_key is null").select(*fields)
    out = out.unionByName(whole.where("parent_key is not null").join(in_shard, ["shard", "parent_key"]).select(*pick))
    out = out.unionByName(merged.join(of, "parent_key", "left").select(*pick))
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends_sha").alias("ends_sha256"))


def released_table(run):
    """run over one group, after which freed memory goes back."""

    @released
    def of(group: pa.Table) -> pa.Table:
        return run(group)

    return of


def op12_conversation_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """conversations, each rebuilt with the first turns of its family's first."""
    return trie(rebuilt(table(spark, sf_dir, "conversations")))
