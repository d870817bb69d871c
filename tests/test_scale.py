"""Operators that replace loops, caps and blow-ups, against brute force on small inputs made for their hard cases."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from medgraph.operators import curate as C
from medgraph.operators import extract as X
from medgraph.operators import graph as G
from medgraph.operators import joins as J
from medgraph.operators import legal as L
from medgraph.operators import ordering as W


# --- containment ----------------------------------------------------------------------------------


def word(rng, letters="abcdé가나", most=6):
    return "".join(rng.choice(letters) for _ in range(rng.randint(1, most)))


@pytest.mark.parametrize("hot", [1000, 2])
def test_gram_index(spark, monkeypatch, hot):
    """More words than FEW_WORDS, of all lengths, over texts with one gram in all of them, repeats and nulls; hot: a low share salts the frequent grams."""
    monkeypatch.setattr(J, "HOT_GRAM", hot)
    rng = random.Random(5)
    words = {word(rng) for _ in range(600)} | {"the", "😀x", "b\nc"}
    texts = [(i % 50, None if i % 17 == 0 else "the " + "".join(rng.choice("abcdé가나 \n😀x") for _ in range(rng.randint(0, 80)))) for i in range(90)]
    texts += [texts[1], (None, "the abc"), (3, "")]
    assert len(words) > J.FEW_WORDS
    df = spark.createDataFrame(texts, "k int, t string")
    w = spark.createDataFrame([(x,) for x in [*words, "", None, "abc", "abc"]], "w string")
    want = {(k, x) for k, t in texts if t for x in words | {"abc"} if x in t}
    got = J.containments(df, ["k"], "t", w, "w").collect()
    assert {(r.k, r._word) for r in got} == want and len(got) == len(want)
    times = J.containments(df, ["k"], "t", w, "w", {"n": F.length("_text")}).collect()
    assert {(r.k, r._word, r.n) for r in times} == {(k, x, len(t)) for k, t in texts if t for x in words | {"abc"} if x in t}


def test_gram_rows_carry_no_text(spark):
    """Only keys and hashes are exploded to grams."""
    texts = spark.createDataFrame([(i, "some text %d" % i) for i in range(30)], "k int, t string")
    words = spark.createDataFrame([("w%d" % i,) for i in range(300)], "w string")
    plan = J.containments(texts, ["k"], "t", words, "w")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [plan[i + 1] for i, x in enumerate(plan) if "Generate explode(" in x and "[_g#" in x]
    assert below and not any("_text#" in x for x in below)


@pytest.mark.parametrize("few", [J.FEW_WORDS, 0])
def test_lexicon_of_any_terms(spark, monkeypatch, few):
    """Terms inside Korean words with particles, longer and overlapping ones, of several words, in other case."""
    monkeypatch.setattr(J, "FEW_WORDS", few)
    terms = ["폐암", "비소세포폐암", "소세포", "EGFR", "egfr", "gene fusion", "fusion of", "x", "없음", "", None]
    texts = [(1, "비소세포폐암은 EGFR 변이와 GENE fusion of x"), (2, "폐암과 폐암"), (3, None), (4, ""), (5, "none"), (2, "egfR")]
    got = X.lexicon_hits(spark.createDataFrame(texts, "doc_id int, text string"), spark.createDataFrame([(t,) for t in [*terms, "x"]], "term string")).collect()
    want = {(d, t, x.lower().index(t.lower()) + 1) for d, x in texts if x for t in terms if t and t.lower() in x.lower()}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_name_match_tiers(spark):
    small = ["egfr/alk", "alk", "cdk4/6", "ros1", "/x/", "", None, "abl"]
    big = ["x/alk", "alk", "cdk6 test", "bcr-abl", "ros", "", None, "zzz", "egfr/alk"]

    def tier(a, b):
        if not a or not b:
            return None
        if a == b:
            return 0.95
        if a in b or b in a:
            return 0.85
        return 0.80 if "/" in a and any(p and p in b for p in a.split("/")) else None

    want = sorted((a, b, tier(a, b)) for a in small for b in big if tier(a, b))
    for few in (200, 0):
        old, J.FEW_WORDS = J.FEW_WORDS, few
        try:
            got = J.name_match(spark.createDataFrame([(a,) for a in small], "a string"), spark.createDataFrame([(b,) for b in big], "b string"), "a", "b").collect()
        finally:
            J.FEW_WORDS = old
        assert sorted((r.a, r.b, r.confidence) for r in got) == want
    assert ("egfr/alk", "x/alk", 0.80) in want


def test_one_match_of_case_variants(spark):
    left = spark.createDataFrame([("foo",), ("ba",), ("nothing",), (None,), ("foo",)], "a string")
    right = spark.createDataFrame([("Foo",), ("FOO",), ("foo bar",), ("BAR",), ("Bar",), (None,)], "b string")
    got = J.mutual_contains(left, right, "a", "b").collect()
    assert sorted((r.a, r.b, r.exact, r.confidence) for r in got) == [("ba", "foo bar", False, 0.8), ("foo", "FOO", True, 0.95), ("foo", "FOO", True, 0.95)]


def test_classifier_counts_repeats_once(spark):
    rules = spark.createDataFrame([("x", "gene", "keyword", 1), ("x", "mab", "suffix", 2), ("y", "gene", "negative", 1)], "category string, keyword string, kind string, priority int")
    terms = spark.createDataFrame([(1, "a gene"), (1, "a gene"), (2, "gene gene mab"), (3, "none")], "id int, t string")
    got = {r.id: (r.category, r.score) for r in C.keyword_classifier(terms, rules, "t", "t", "id").collect()}
    assert got == {1: ("x", 2.0), 2: ("x", 4.0 / 1)}  # priorities apart: keyword 4 / 1 before suffix 5 / 2


def test_examples_of_a_large_pool(spark):
    rng = random.Random(4)
    vocab = [word(rng, "abcdef", 4) for _ in range(40)]
    pool = [(rng.choice(["core", "core", "boundary", "fixed"]), f"e{i}", rng.randint(1, 60), rng.sample(vocab, rng.randint(0, 3)), rng.sample(vocab, rng.randint(0, 2)) or None) for i in range(260)]
    terms = [(f"t{i}", " ".join(rng.sample(vocab, rng.randint(0, 2)))) for i in range(25)] + [("n", None)]
    schema = "kind string, example string, seq int, keywords array<string>, cues array<string>"
    got = C.choose_examples(spark.createDataFrame(terms, "term string, text string"), spark.createDataFrame([*pool, pool[0]], schema), "term", "text").collect()
    want = []
    for term, text in terms:
        for kind, most in (("core", 3), ("boundary", 3), ("fixed", 1)):
            score = lambda p: 0 if p[0] == "fixed" else 2 * len({w for w in p[3] if w in (text or "")}) + 3 * any(w in (text or "") for w in p[4] or [])  # noqa: E731, B023
            best = sorted(((-score(p), p[2], p[1]) for p in pool if p[0] == kind))[:most]
            want += [(term, kind, e, -s, k) for k, (s, _, e) in enumerate(best, 1)]
    assert sorted((r.term, r.kind, r.example, r.score, r["rank"]) for r in got) == sorted(want)


# --- ranges ---------------------------------------------------------------------------------------


def test_dyadic_blocks(spark):
    rng = random.Random(1)
    spans = [(0, 0), (5, 4), (-7, 12), (1, 10**9), (-(2**40), 2**40 + 3), (2**62, 2**62 + 10**9), (6, 7), (7, 8)] + [(a, a + rng.randint(-1, 300)) for a in (rng.randint(-500, 500) for _ in range(60))]
    df = spark.createDataFrame([*spans, (None, 3), (3, None)], "lo long, hi long")
    rows = df.select("lo", "hi", J.dyadic(F.col("lo"), F.col("hi")).alias("d")).collect()
    for r in rows:
        blocks = sorted((b.n << b.level, (b.n + 1 << b.level) - 1) for b in r.d)
        if r.lo is None or r.hi is None or r.hi < r.lo:
            assert not blocks
            continue
        assert blocks[0][0] == r.lo and blocks[-1][1] == r.hi and len(blocks) <= 124
        assert all(a[1] + 1 == b[0] for a, b in zip(blocks, blocks[1:]))
    assert next(len(r.d) for r in rows if (r.lo, r.hi) == (1, 10**9)) <= 60


def test_wide_ranges(spark):
    rng = random.Random(2)
    ranges = [(i, rng.choice("ab"), lo, lo + rng.choice([0, 3, 10**5, 10**9, -1])) for i, lo in enumerate(rng.randint(-(10**9), 10**9) for _ in range(80))]
    items = [(rng.choice(["a", "b", None]), rng.choice([r[2] for r in ranges]) + rng.randint(-2, 10**6)) for _ in range(200)] + [("a", None)]
    got = J.range_contains(spark.createDataFrame(items, "ch string, n long"), spark.createDataFrame(ranges, "id int, ch string, lo long, hi long"), "ch", "n", "lo", "hi", [F.col("hi") - F.col("lo"), F.col("id")]).collect()
    best = lambda ch, n: min(((hi - lo, i) for i, c, lo, hi in ranges if n is not None and c == ch and lo <= n <= hi), default=(0, None))[1]
    assert sorted((r.ch, r.n, r.id) for r in got) == sorted((ch, n, best(ch, n)) for ch, n in items if best(ch, n) is not None)


# --- descent --------------------------------------------------------------------------------------


def below(edges, roots):
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    rows = []
    for r in set(roots):
        depth, todo = {}, deque([(r, 0)])
        while todo:
            n, d = todo.popleft()
            for x in out.get(n, ()):
                if x not in depth:
                    depth[x] = d + 1
                    todo.append((x, d + 1))
        rows += [(r, x, d) for x, d in depth.items()]
    return sorted(rows)


def descended(spark, edges, roots):
    got = G.descend(spark.createDataFrame(edges, "src_id long, dst_id long"), spark.createDataFrame([(r,) for r in roots], "id long")).collect()
    return sorted((r.root, r.node, r.depth) for r in got)


def test_descend_graphs(spark):
    """Trees, merges, cycles with and without a way in, self loops, repeated and null edges."""
    for seed in range(3):
        rng = random.Random(seed)
        edges = [(rng.randint(0, 40), rng.randint(0, 60)) for _ in range(55)]
        edges += [(100, 101), (101, 102), (102, 100), (200, 201), (201, 202), (202, 201), (202, 203), (300, 300), (300, 301), edges[0]]
        roots = [0, 1, 2, 3, 200, 300, 999]
        assert descended(spark, edges, roots) == below(edges, roots)
    edges = [(1, 2), (2, 3), (None, 3), (3, None)]
    assert descended(spark, edges, [1, 1]) == [(1, 2, 1), (1, 3, 2)]
    assert descended(spark, [(1, 2)], []) == []


def test_descend_deep(spark):
    """10,000 edges in a chain, then a cycle of 3,000 with a tail: far fewer rounds than levels."""
    chain = [(i, i + 1) for i in range(10_000)]
    cycle = [(20_000 + i, 20_000 + (i + 1) % 3_000) for i in range(3_000)]
    edges = [*chain, *cycle, (10_000, 20_000), (21_000, 30_000), (-5, -6), (-6, -5), (-6, -7)]
    got = descended(spark, edges, [0])
    assert got == below(edges, [0]) and max(d for _, _, d in got) == 13_000


# --- scans ----------------------------------------------------------------------------------------


def test_scan_in_blocks(spark, monkeypatch):
    """Blocks of three lines: states and counts go on over empty blocks, gaps and null documents; no window sees more than a block."""
    monkeypatch.setattr(W, "SCAN", 3)
    rng = random.Random(3)
    rows = [(d, i, rng.choice([None, None, None, i])) for d in ("a", "b", None) for i in range(40) if rng.random() < 0.8 and not 12 <= i <= 20]
    df = spark.createDataFrame(rows, "doc string, line long, v long").repartition(4)
    want, state = [], {}
    for d, i, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        last, n = state.get(d, (None, 0))
        state[d] = (v if v is not None else last, n + (v is not None))
        want.append((d, i, *state[d]))
    got = W.scanned(df, ["doc"], "line", {"last": F.col("v")}, {"n": F.col("v").isNotNull().cast("int")}).collect()
    assert sorted(((r.doc, r.line, r["last"], r.n) for r in got), key=repr) == sorted(want, key=repr)
    kept = W.carry_forward(df, ["doc"], "line", "v")
    assert kept.columns == df.columns and sorted(((r.doc, r.line, r.v) for r in kept.collect()), key=repr) == sorted(((d, i, x) for d, i, x, _ in want), key=repr)


def test_parsers_of_long_texts(spark, monkeypatch):
    """Statutes, sections and outlines are the same in small blocks."""
    law = "서문\n" + "\n".join(f"제{i}조(t{i})\n본문 {i}\n① 하나\n1. 둘\n가. 셋\n② 넷" for i in range(1, 30))
    text = "\n".join(f"## h{i // 9}\n### s{i // 3}\n- b{i}\n* item {i}\nmore" for i in range(40))
    laws = spark.createDataFrame([("갑법", law), ("을법", law[:200])], "title string, content string")
    docs = spark.createDataFrame([(1, text), (2, text[:90])], "doc_id long, text string")
    every = lambda: [sorted(map(repr, f.collect())) for f in (L.articles(laws), X.bullet_sections(docs), X.outline(docs))]
    whole = every()
    monkeypatch.setattr(W, "SCAN", 4)
    assert every() == whole and all(whole)
