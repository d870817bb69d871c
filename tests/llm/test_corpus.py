"""Corpus operators against plain-Python versions, on rows with nulls, empty and repeated texts, ties and extra columns."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from medgraph.llm import ann, bpe, components, fingerprint, jaccard, licenses, lines, packing, substrings, suffixes, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _k string, c string"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def rows_of(seed=5, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(40)]
    passage = " ".join(rng.choice(vocab) for _ in range(80))
    out = []
    for i in range(n):
        kind = rng.random()
        t = " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 90)))
        if kind < 0.3:
            w = t.split()
            k = rng.randint(0, len(w))
            t = " ".join(w[:k]) + "\n" + passage + "\n" + " ".join(w[k:])
        elif kind < 0.5 and out:
            t = rng.choice(out)[1] or ""
            if rng.random() < 0.6 and t:
                w = t.split(" ")
                w[rng.randrange(len(w))] = "CHANGED"
                t = " ".join(w)
        out.append((i * 3, t))
    out += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "one two"), (1004, "one two"), (1005, "x " * 5000), (1006, "\n".join(["same line"] * 60)), (1007, "q" * 3000), (None, passage)]
    out += [out[0], out[0]]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src", len(t or ""), "clash", "clash") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return rows_of()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


BIG = 1 << 62


def order(i):
    return BIG if i is None else i


def test_substrings(spark, docs, rows, empty):
    w = 13
    first = {}
    for i, t in sorted(rows, key=lambda r: order(r[0])):
        ws = words(t)
        for j in range(len(ws) - w + 1):
            first.setdefault(tuple(ws[j : j + w]), order(i))
    want = Counter()
    for i, t in rows:
        ws = words(t)
        gone = [False] * len(ws)
        for j in range(len(ws) - w + 1):
            if first[tuple(ws[j : j + w])] < order(i):
                gone[j : j + w] = [True] * w
        kept = " ".join(x for x, g in zip(ws, gone) if not g)
        want[i, len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = Counter((r._ord if r._ord < BIG else None, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.dedup(docs).collect())
    assert got == want
    assert substrings.dedup(empty).count() == 0
    kept = substrings.strip_repeats(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 1000").count() == 1


def test_suffix_dedup(docs, rows, empty):
    w = 100
    raw = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(d[j : j + w] for _, d in raw for j in range(len(d) - w + 1))
    want = Counter()
    for i, d in raw:
        gone = np.zeros(len(d), bool)
        for j in range(len(d) - w + 1):
            if count[d[j : j + w]] > 1:
                gone[j : j + w] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[i, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    got = Counter((r._ord if r._ord < BIG else None, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.dedup(docs, window=w, gram=20).collect())
    assert got == want
    assert suffixes.dedup(empty).count() == 0


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(300):
        n, sigma = rng.randint(1, 70), rng.choice([1, 2, 4, 26])
        t = [rng.randint(1, sigma) for _ in range(n)]
        sa = suffixes.suffix_array(np.array(t), sigma + 1)
        assert sa.tolist() == sorted(range(n), key=lambda i: t[i:])


def test_jaccard(docs, rows, empty):
    sets = []
    for _, t in rows:
        ws = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(ws[j : j + 5]) for j in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set())
    comp = list(range(len(rows)))

    def find(a):
        while comp[a] != a:
            a = comp[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                comp[find(a)] = find(b)
    low = defaultdict(lambda: BIG)
    for a in range(len(rows)):
        low[find(a)] = min(low[find(a)], order(rows[a][0]))
    want = Counter((order(rows[a][0]), len(sets[a]), low[find(a)]) for a in range(len(rows)))
    got = Counter((min(r._ord, BIG), r.n_shingles, min(r.component, BIG)) for r in jaccard.classes(docs).collect())
    assert got == want
    assert jaccard.classes(empty).count() == 0
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    nonempty = {low[find(a)] for a in range(len(rows)) if sets[a]}
    assert kept.count() == len(nonempty) + sum(not s for s in sets)


def test_keep_one_of_null_and_repeated_ids(spark):
    texts = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcdefg"]
    near = texts[0] + " more"
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (7, texts[5]), (8, texts[6]), (None, texts[6]), (None, near), (None, texts[1]), (None, None), (7, "")]
    kept = Counter((r.doc_id, r.text) for r in jaccard.keep_one(frame(spark, rows)).collect())
    near_one = [t for t in (texts[0], near) if kept.pop((None, t), 0)]
    assert len(near_one) == 1
    assert kept == Counter([(None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (7, texts[5]), (8, texts[6]), (None, None), (7, "")])


@pytest.mark.parametrize("block", [jaccard.BLOCK, 4])
def test_jaccard_links(spark, docs, rows, empty, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    family = []
    for i in range(25):
        w = base[: 150 - rng.randint(0, 25)]
        w[rng.randrange(len(w))] = f"other{i}"
        family.append((5000 + i, " ".join(w)))
    more = [*rows, *family, family[3], (5100, family[4][1])]
    sets = []
    for _, t in more:
        ws = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append(frozenset(tuple(ws[j : j + 5]) for j in range(len(ws) - 4)) if len(ws) >= 5 else frozenset([tuple(ws)] if ws else []))
    like = lambda a, b: bool(a) and 100 * len(a & b) >= 80 * len(a | b)
    distinct = sorted(set(sets), key=repr)
    pairs = Counter((len(a & b), len(a | b)) for k, a in enumerate(distinct) for b in distinct[:k] if like(a, b))
    want = Counter((order(i), len(s), sum(like(s, o) for o in sets) - bool(s)) for (i, _), s in zip(more, sets))
    every = docs.unionByName(frame(spark, more[len(rows) :]))
    found, (_, links) = jaccard.classes(every), jaccard.similar_links(every)
    assert Counter((r.shared, r.united) for r in links.collect()) == pairs
    assert links.where("x >= y").count() == 0 and sum(pairs.values()) > 100
    assert Counter((min(r._ord, BIG), r.n_shingles, r.n_links) for r in found.collect()) == want
    if block == 4:
        assert jaccard.classes(empty).count() == 0


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(50)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(None, 3)]
    got = {r.v: r.c for r in components.components(spark.createDataFrame(pairs, "x long, y long")).collect()}
    assert {got[i] for i in range(51)} == {0}
    for a, b in pairs[50:-1]:
        assert got[a] == got[b]


def test_lines(docs, rows, empty):
    first, want = {}, Counter()
    for i, t in sorted(rows, key=lambda r: order(r[0])):
        ls = lines.lines_of((t or "").encode())
        for at, n in lines.chunks(ls):
            first.setdefault(b"\n".join(ls[at : at + n]), (order(i), t, at))
    for i, t in rows:
        ls = lines.lines_of((t or "").encode())
        gone = sum(n for at, n in lines.chunks(ls) if n > 1 and b"\n".join(ls[at : at + n]).strip() and first[b"\n".join(ls[at : at + n])] != (order(i), t, at))
        want[i, len(ls), gone] += 1
    got = Counter((r._ord if r._ord < BIG else None, r.n_lines, r.n_removed) for r in lines.dedup(docs).collect())
    assert got == want
    assert lines.dedup(empty).count() == 0 and lines.strip_repeats(docs).columns == docs.columns


def test_bpe(docs, rows, empty):
    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    more = [(9, "It's <|endoftext|> ΣΑΣ\x1cb  İı 日本 ²½"), (10, "<|startoftext|><|endoftext|>")]
    extra = frame(docs.sparkSession, more)
    want = Counter()
    for i, t in [*rows, *more]:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe.digests(docs.unionByName(extra)).collect()) == want
    full = {r.doc_id: r for r in bpe.encode(extra).collect()}
    assert full[9].ids == lib.encode(more[0][1], add_special_tokens=False).ids
    assert bpe.digests(empty).count() == 0


def test_packing(docs, rows, empty):
    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    out = packing.pack_documents(docs).collect()
    want = Counter()
    for i, t in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 2048
    assert len(bins) <= sum(r.length for r in out) / 2048 * 1.1 + 2
    assert packing.pack_documents(empty).count() == 0


@pytest.mark.parametrize("score", ["residual", "dot"])
def test_packing_capacities(score):
    rng = np.random.default_rng(3)
    sizes = np.sort(rng.integers(1, 100, 200))[::-1]
    bins, offsets = packing.best_fit(sizes, 128, 3, 9000, (1.0, 0.5, 0.5), score)
    for b in np.unique(bins):
        s = sizes[bins == b]
        assert s.sum() <= 128 and len(s) <= 3 and (s**2).sum() <= 9000 or len(s) == 1


@pytest.mark.parametrize(("documents", "cost"), [(3, 2048**2), (2048, 9000), (3, 9000)])
def test_pack_with_binding_capacities(spark, documents, cost):
    rng = random.Random(9)
    parts = spark.createDataFrame([(i, 0, 0, 0, rng.randint(1, 90), 0) for i in range(300)], "_ord long, _row long, piece long, start long, length long, ids_crc32 long")
    out = packing.pack(parts, 512, documents, cost).collect()
    assert sorted((r._ord, r.length) for r in out) == sorted((r._ord, r.length) for r in parts.collect())
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append(r.length)
    assert all(sum(b) <= 512 and len(b) <= documents and sum(n * n for n in b) <= cost for b in bins.values())
    free = len({r.sequence_id for r in packing.pack(parts, 512).collect()})
    assert len(bins) > free


def test_fingerprint(docs, rows, empty):
    ordered = sorted(rows, key=lambda r: (order(r[0])), reverse=True)
    out = fingerprint.compare_with_next(docs).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    distinct = [(i, t or "") for k, (i, t) in enumerate(ordered) if k == 0 or ordered[k - 1][0] != i]
    for k, (i, t) in enumerate(distinct[:-1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + distinct[k + 1][1][:half]
        assert by[i].n_chars == len(t)
        assert by[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= by[i].near_edited <= 1 and 0 <= by[i].near_next <= 1
    assert by[1003].fingerprint == by[1004].fingerprint and by[1004].near_next == 1.0
    assert fingerprint.compare_with_next(empty).count() == 0


def test_fingerprint_estimates():
    rng = random.Random(4)
    err = []
    for _ in range(40):
        a = [str(rng.randint(0, 10**6)) for _ in range(400)]
        k = rng.randint(0, 400)
        b = a[:k] + [str(rng.randint(0, 10**6)) for _ in range(400 - k)]
        low, some = fingerprint.signatures([" ".join(a).encode(), " ".join(b).encode()])
        est = fingerprint.likeness(low[:1], some[:1], low[1:], some[1:], fingerprint.BITS)[0]
        s, t = ({tuple(x[j : j + 5]) for j in range(396)} for x in (a, b))
        err.append(est - len(s & t) / len(s | t))
    assert abs(np.mean(err)) < 0.03 and np.std(err) < 0.08


def test_toxicity(spark, empty):
    rng = random.Random(6)
    vocab = ["".join(rng.choice("aeioubcdlmn") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    rows, labels = [], []
    for i in range(600):
        w = [rng.choice(vocab) for _ in range(60)]
        bad = i % 3 == 0
        if bad:
            for _ in range(4):
                w[rng.randrange(60)] = rng.choice(["zqxidiot", "wkscumbag", "vzjmoron"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    rows += [(9000, None), (9001, "")]
    labels += [(9001, None, None), (None, 1, 1)]
    docs = frame(spark, rows)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(docs, table).collect()}
    held = [i for i in range(600) if got[i].held_out]
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == got[i].held_out for i in got)
    assert np.mean([got[i].predicted == (i % 3 == 0) for i in held]) > 0.95
    assert got[9000].score == got[9001].score and got[9000].predicted == 0
    kept = toxicity.keep_ordinary(docs, table)
    assert kept.columns == docs.columns and 380 <= kept.count() <= 430
    assert toxicity.classify(docs, table.limit(0)).agg({"score": "max"}).first()[0] == 0.0
    assert toxicity.classify(empty, table).count() == 0


def test_toxicity_counts_windows():
    """A stem that clean texts hold once and toxic ones several times."""
    rng = random.Random(8)
    vocab = ["".join(rng.choice("aeioubcdlmn") for _ in range(rng.randint(4, 9))) for _ in range(2000)]

    def text(stems: int) -> str:
        w = [rng.choice(vocab) for _ in range(80)]
        return " ".join([*w, *("zqxwkvj" + rng.choice("aeiou") + rng.choice("bcdlmn") for _ in range(stems))])

    toxic, clean = [text(5) for _ in range(150)], [text(i % 2) for i in range(600)]
    model = toxicity.fit_rows(toxic, clean, 0.2)
    got = lambda n, k: model.score([toxicity.windows(text(k)) for _ in range(n)])
    assert (got(50, 5) >= 0.5).mean() > 0.9
    assert (got(50, 1) < 0.5).mean() > 0.9 and (got(50, 0) < 0.5).all()


def test_licenses(spark, empty):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]
    files = [(1, "a/LICENSE", gpl), (2, "a/b/x.py", "nothing here"), (3, "a/b/c/y.py", f"code\nmore\n{mit}\nend"), (4, "d/z.py", "plain words"), (5, None, None), (6, "a/b/c/e.py", ""), (7, "d/q/LICENSE.md", "no notice at all"), (7, "d/q/LICENSE.md", "no notice at all")]
    df = spark.createDataFrame([(i, p, t, "x") for i, p, t in files], "doc_id long, path string, text string, license string").drop("license")
    got = {r._ord: r for r in licenses.scan(df, df.path).collect()}
    assert (got[1].license, got[1].origin) == ("GPL-3.0", "own")
    assert (got[2].license, got[2].origin, got[2].distance) == ("GPL-3.0", "inherited", 2)
    assert (got[3].license, got[3].origin) == ("MIT", "own")
    assert got[4].license is None and got[5].license is None and got[7].license is None
    assert (got[6].license, got[6].distance) == ("GPL-3.0", 3)
    assert licenses.scan(empty, empty.source).count() == 0


def test_license_texts_and_headers(spark):
    full = {k: v[-1] for k, v in licenses.all_templates().items()}
    mit = full["MIT"].replace("Copyright (c)", "Copyright (c) 2020 Some Person")
    bsd = full["BSD-3-Clause"].replace("Copyright (c)", "Copyright (c) 2019, Another Person")
    gpl = """#!/bin/sh
# tool - does things
# Copyright (C) 2011 Some Person
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
#
# You should have received a copy of the GNU General Public License
# along with this program.  If not, see <http://www.gnu.org/licenses/>.
""" + "".join(f"run{i} step{i} value{i}\n" for i in range(60))
    code = "".join(f"int name{i} = other{i};\n" for i in range(50))
    wrapped = code + "// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.\n" + code
    files = [(1, "m/LICENSE", mit), (2, "m/src/a.c", code), (3, "g/COPYING", full["GPL-3.0"]), (4, "g/b.c", code + "x"), (5, "h/tool.sh", gpl), (6, "w/c.go", wrapped), (7, "b/LICENSE", bsd), (8, "b/d.py", "unlike words"), (9, "a/LICENSE", full["Apache-2.0"])]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    got = {r._ord: (r.license, r.origin) for r in licenses.scan(df, df.path).collect()}
    assert got == {1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("GPL-3.0", "own"), 4: ("GPL-3.0", "inherited"), 5: ("GPL-3.0", "own"), 6: ("BSD-3-Clause", "own"), 7: ("BSD-3-Clause", "own"), 8: ("BSD-3-Clause", "inherited"), 9: ("Apache-2.0", "own")}


def test_ann(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((900, 16))
    x[300:600] = x[300]
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(5000, None, 0), (5020, [0.0] * 16, 0), (5040, [float("nan")] * 16, 0), (5060, [None] * 16, 0), (5080, [], 0), (5100, [1.0, 2.0], 0), (None, x[0].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = defaultdict(list)
    for r in ann.search(df, lambda i: i % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 900, 20))
    hits = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(900), -s))[:20]
        assert len(found) == 20 and all(abs(v - x[i] @ x[q]) < 1e-9 for i, v in found)
        hits += len({i for i, _ in found} & set(best.tolist()))
    assert hits >= 0.9 * 20 * len(got)
    assert ann.search(df.limit(0), lambda i: i % 20 == 0).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF))
        assert docs.columns == columns, name
        now = {r.doc_id for r in docs.collect()}
        assert now <= before
        before = now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == before
    assert len(before) > 100
