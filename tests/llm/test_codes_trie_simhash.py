"""Vector codes, conversation tries and SimHash links against plain-Python versions, on nulls, ties, repeats, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib

import pytest
import xxhash

from medgraph.llm import codes, common, simhash, trie

SF = "/root/testdata/sf0.001"


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# --- codes --------------------------------------------------------------------------------------


def coded(rows, parts, entries, rounds):
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not rows:
        return []
    wide = -(-max(len(v) for _, v, _ in rows) // parts) or 1
    ints = [[math.floor(256 * x) for x in v] + [0] * (parts * wide - len(v)) for _, v, _ in rows]
    part = lambda x, p: x[p * wide : (p + 1) * wide]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, ints[i]))[:entries]
    books = [[part(ints[i], p) for i in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            of = [nearest(part(x, p), book)[1] for x in ints]
            new.append([[sum(c) // of.count(k) for c in zip(*(part(x, p) for x, o in zip(ints, of) if o == k))] if k in of else e for k, e in enumerate(book)])
        books = new
    best = [[nearest(part(x, p), b) for p, b in enumerate(books)] for x in ints]
    error = [sum(d for d, _ in x) for x in best]
    name = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    by_label, digits = {}, 2 if len(first) <= 256 else 4
    for (_, _, label), e in zip(rows, error):
        by_label[label] = by_label.get(label, 0) + e
    return sorted(((r[0], "".join(f"{k:0{digits}x}" for _, k in x), e, by_label[r[2]], name) for r, x, e in zip(rows, best, error)), key=repr)


VECTORS = "vec_id long, embedding array<double>, label int, code string, _id string, error int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 0) for r in rows], VECTORS)


def test_codes(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)], rng.choice([1, 1, 1, 2, None])) for i in range(300)]
    rows += [(400, None, 1), (401, [0.1, None] * 4, 1), (402, [float("nan")] * 8, 2), (403, [float("inf")] + [0.0] * 7, 2), (404, [0.5] * 3, 7), (405, [], None), (None, [0.25] * 8, 1)]
    rows += [rows[0], rows[5], (5, [-0.001] * 8, 1)]
    df = vectors(spark, rows).repartition(4)
    for parts, entries, rounds in ((4, 16, 2), (2, 500, 1), (16, 3, 2)):
        assert plain(codes.compress(df, parts, entries, rounds).collect()) == coded(rows, parts, entries, rounds)
    assert codes.compress(vectors(spark, [])).collect() == []
    assert codes.compress(vectors(spark, [(1, None, 1)])).collect() == []
    # codes name what they stand for
    usable = codes.usable(df, "vec_id", "embedding", "label")
    books = codes.fit(usable, 4, 16, 2)
    back = codes.decode(codes.encode(usable, books), books).where("_id = 404").first()
    ints = [128] * 3 + [0] * 5
    assert sum((a - 256 * b) ** 2 for a, b in zip(ints, back.decoded)) == back.error


def test_codes_query(spark):
    got = plain(codes.op11_vector_code_compression(spark, SF).collect())
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got == coded(rows, 16, 64, 2)


def test_cells_forget(monkeypatch):
    """A small memory of cells changes nothing."""
    import numpy as np

    rng = np.random.default_rng(1)
    book, parts = rng.integers(-99, 99, (40, 3)), rng.integers(-150, 150, (900, 3))
    away = ((parts[:, None] - book[None]) ** 2).sum(2)
    monkeypatch.setattr(codes, "MEMO", 20)
    cells = codes.Cells(book)
    for at in range(0, 900, 100):
        code, d = cells.nearest(parts[at : at + 100])
        assert (code == away[at : at + 100].argmin(1)).all() and (d == away[at : at + 100].min(1)).all()
    assert cells.count.mean() < len(book) / 2
    same = codes.Cells(np.zeros((3, 2), np.int64))
    assert same.nearest(parts[:, :2])[0].max() == 0


def test_with_values_hot_and_null(spark):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else 1 if i % 3 == 1 else i) for i in range(3000)], "i long, k long")
    values = rows.groupBy("k").count().withColumnRenamed("count", "n").selectExpr("k", "n", "coalesce(k, -1) v")
    got = common.with_values(rows, values, "k", "n").collect()
    assert sorted((r.i, r.v) for r in got) == [(i, -1 if i % 3 == 0 else 1 if i % 3 == 1 else i) for i in range(3000)]


# --- tries --------------------------------------------------------------------------------------


def record(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def nodes(rows):
    own, again = {}, {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, record(r[2] or "", r[3] or ""))):
        own.setdefault(c, []).append((role or "", text or ""))
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        again[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members, children = {}, {}
    for c, t in again.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        below = children.get(k, [])
        leaves[k] = sum(leaves[x] for x in below) or 1
        saved[k] = sum(saved[x] for x in below) + ((len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0)
    sha = lambda m, k: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(again[c]) == len(k)).encode()).hexdigest()
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])), leaves[k], saved[k], sha(m, k)) for k, m in members.items()), key=repr)


def talks(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(90):
        usual = rng.choice("aab")
        for i in range(rng.choice([0, 1, 2, 3, 5, 9, 14])):
            odd = rng.random() < 0.3
            rows.append((c, None if rng.random() < 0.1 else rng.choice([i, i // 2]), rng.choice(["user", None]) if odd else "user", rng.choice(["a", "é", "", None]) if odd else usual))
    rows += [(c, i, "user", "same") for c in range(200, 280) for i in range(7)]  # a group of copies
    rows += [(c, i, "user", f"x{i // 3}") for c, n in ((300, 40), (305, 37), (306, 43)) for i in range(n)]  # several blocks
    return [*rows, (None, 1, "user", "lost"), rows[0], (401, 0, "u", "v"), (402, 0, "u" * 10, "v " * 3000)]


TALKS = "conv_id long, turn long, role string, text string, depth string, conv string, key string"


@pytest.mark.parametrize("block, shard", [(256, 16_384), (8, 7), (9, 30)])
def test_trie(spark, block, shard):
    rows = talks(block)
    df = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], TALKS).repartition(3)
    assert plain(trie.trie(trie.rebuilt(df, block), block, shard).collect()) == nodes(rows)


def test_trie_of_query_and_empty(spark):
    got = plain(trie.op12_conversation_prefix_trie(spark, SF).collect())
    assert got == nodes([tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])
    none = spark.createDataFrame([], TALKS)
    assert trie.trie(trie.rebuilt(none)).collect() == []
    # turnless after rebuilding: the root has it as a member
    c = next(c for c in range(1, 999) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    alone = spark.createDataFrame([(c, 0, "u", "t", "", "", "")], TALKS)
    assert [tuple(r) for r in trie.trie(trie.rebuilt(alone)).collect()] == nodes([(c, 0, "u", "t")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


# --- simhash ------------------------------------------------------------------------------------


def print_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(prints):
    up = {k: k for k in prints}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {k: top(k) for k in keys}


def test_simhash(spark):
    rng = random.Random(8)
    words = ["W%d" % i for i in range(300)] + ["é", "Ünder", "ÀB", "x" * 40]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 4, 60]))) for _ in range(60)]
    for t in list(texts):
        w = t.split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts += [t.replace(" ", rng.choice(["\n", " \t"])), t.upper(), " ".join(w)]
    texts += [None, "", " \r\n", "a " * 9000, "long " + " ".join(rng.choice(words) for _ in range(90_000))]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    prints = {i: print_of(t) for i, t in rows}
    root = linked(prints)
    want = sorted((i, f"{prints[i]:016x}", root[i]) for i, _ in rows)
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, fp string, component string").repartition(5)
    for shard in (8, 4096):
        got = simhash.near_duplicates(df, shard=shard).collect()
        assert sorted((r._ord, f"{r.fp % 2**64:016x}", r.component) for r in got) == want
    assert len(set(root.values())) < len(rows) / 2


@pytest.mark.parametrize("shard", [16, 4096])
def test_simhash_dense_fingerprints(spark, shard):
    """Clusters that share bands, with the highest bit set too: links of all shards together connect what brute force connects."""
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = {rng.getrandbits(64) for _ in range(150)}
    for _ in range(500):
        c = rng.choice(centres)
        for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 5, 8])):
            c ^= 1 << b
        prints.add(c)
    want = linked({p: p for p in prints})
    up = {p: p for p in prints}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for x, y in simhash.near_links(spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp long"), 3, shard).collect():
        assert want[x % 2**64] == want[y % 2**64]
        up[max(top(x % 2**64), top(y % 2**64))] = min(top(x % 2**64), top(y % 2**64))
    assert {p: top(p) for p in prints} == want


def test_simhash_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c d"), (3, "a b c d"), (3, "other words stand here"), (None, "quite another text"), (3, "a b c d")], "doc_id long, text string")
    got = simhash.near_duplicates(df).collect()
    assert sorted((r._ord, r.component) for r in got) == [(3, 3), (3, 3), (3, 3), (common.MAX_LONG, 3), (common.MAX_LONG, common.MAX_LONG)]
    assert simhash.near_duplicates(df.limit(0)).collect() == []
