"""Operators whose work or memory grew faster than their input, and keys that collide, on small inputs made for it."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medgraph.functions import text as T
from medgraph.operators import curate as C
from medgraph.operators import extract as X
from medgraph.operators import graph as G
from medgraph.operators import joins as J
from medgraph.operators import legal as L
from medgraph.plans import catalog, more  # noqa: F401  (more adds to the catalogue)

from .test_queries import plain


def test_ranges_are_few_blocks(spark):
    """A range of any width meets its numbers by at most 16 blocks; blocks are dealt, so that the join goes by their measured size."""
    rng = random.Random(3)
    low, high = -(2**63), 2**63 - 1
    spans = [(low, high), (low, 5), (0, 10**9), (1, 10**9 + 1), (7, 7), (9, 3)] + [(a, a + rng.randint(0, 10**6)) for a in (rng.randint(-(10**6), 10**6) for _ in range(40))]
    ranges = spark.createDataFrame([(i, "x", *r) for i, r in enumerate(spans)], "id int, ch string, lo long, hi long")
    rows = ranges.select("lo", "hi", J.cover(F.col("lo"), F.col("hi")).alias("d")).collect()
    for r in rows:
        if r.lo > r.hi:
            assert not r.d
            continue
        assert len(r.d) <= 16 and len({b.level for b in r.d}) == 1
        assert r.d[0].n == r.lo >> r.d[0].level and r.d[-1].n == r.hi >> r.d[0].level
    numbers = sorted({n for lo, hi in spans for n in (lo, hi, max(low, lo - 1), min(high, hi + 1))})
    items = spark.createDataFrame([("x", n) for n in numbers], "ch string, n long")
    got = J.range_contains(items, ranges, "ch", "n", "lo", "hi", [F.col("id").desc()])
    want = {n: max(i for i, (lo, hi) in enumerate(spans) if lo <= n <= hi) for n in numbers}
    assert {r.n: r.id for r in got.collect()} == want
    assert "RepartitionByExpression" in got._jdf.queryExecution().optimizedPlan().toString()


def test_ranges_are_not_broadcast(spark, tmp_path):
    """A small file of ranges is many blocks, and one of items many numbers; neither goes to the driver, before or after they are measured."""
    spark.range(20_000).selectExpr("id", "'x' AS ch", "id * 40 AS lo", "id * 40 + 500 AS hi").write.parquet(f"{tmp_path}/ranges")
    spark.range(1000).selectExpr("'x' AS ch", "id * 777 AS n").write.parquet(f"{tmp_path}/items")
    got = J.range_contains(spark.read.parquet(f"{tmp_path}/items"), spark.read.parquet(f"{tmp_path}/ranges"), "ch", "n", "lo", "hi", [F.col("id")])
    planned = got._jdf.queryExecution().executedPlan().toString()
    assert {r.n: r.id for r in got.collect()} == {n: max(0, -((500 - n) // 40)) for n in range(0, 777_000, 777)}
    assert "Broadcast" not in planned + got._jdf.queryExecution().executedPlan().toString()


# --- pairs of classes -----------------------------------------------------------------------------


def widest_window_or_group(df, name):
    """Lines of the optimized plan that shuffle or sort both ids named."""
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return [x for x in plan if ("Aggregate [" in x or "Window [" in x) and all(f"{n}#" in x for n in name)]


def test_pairs_of_codes_by_class(spark):
    rng = random.Random(4)
    a = [(rng.choice([*range(12), None]), [rng.choice([0, 1, 2, 3, None]) for _ in range(rng.randint(0, 2))], None if rng.random() < 0.2 else [rng.randint(0, 3)]) for _ in range(30)]
    b = [(i % 70, rng.choice([0, 1, 2, 3, None]), rng.choice([0, 1, None])) for i in range(90)] + [(None, 1, 1)]
    tiers = [("one", "x", "u", 0.9), ("two", "y", "v", 0.9), ("low", "y", "u", 0.5)]
    got = J.tiered_codes(spark.createDataFrame(a, "i int, x array<int>, y array<int>"), spark.createDataFrame(b, "j int, u int, v int"), tiers, "i", "j", [3])
    want = {}
    for i, x, y in a:
        for j, u, v in b:
            for tier, ours, theirs, c in (("one", x, u, 0.9), ("two", y, v, 0.9), ("low", y, u, 0.5)):
                if theirs is not None and theirs != 3 and theirs in (ours or []):
                    want[i, j] = min(want.get((i, j), (0, "")), (-c, tier))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((*k, t, -c)) for k, (c, t) in want.items())
    assert not widest_window_or_group(got, ["i", "j"])


def test_pairs_of_cut_classes(spark, monkeypatch):
    """Every pair once, with classes of many lists and arrays, of one array and with a null id."""
    for name, n in (("FEW_IDS", 2), ("MANY_IDS", 4), ("DEAL", 8), ("SALTS", 3)):
        monkeypatch.setattr(J, name, n)
    a = [(i if i else None, i % 3 if i < 30 else 0) for i in range(60)]
    b = [(str(i) if i else None, i % 2 if i < 20 else 0) for i in range(90)]
    pairs = [(0, 0), (0, 1), (1, 1), (2, 9), (9, 0)]
    got = J.expanded(spark.createDataFrame(a, "i int, ca int"), spark.createDataFrame(b, "j string, cb int"), spark.createDataFrame(pairs, "ca int, cb int").withColumn("t", F.lit("x")), "ca", "cb")
    want = Counter((i, j, "x") for i, ca in a for j, cb in b if (ca, cb) in pairs)
    assert Counter((r.i, r.j, r.t) for r in got.collect()) == want


def test_pairs_are_written_small(spark, tmp_path, monkeypatch):
    """7 million pairs of one class, in one task, merged as large sides are: they come in an order that Parquet stores in under 0.4 bytes a pair."""
    monkeypatch.setattr(J, "SALTS", 1)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    a, b = spark.range(1000).selectExpr("id AS i", "1 AS ca"), spark.range(7001).selectExpr("id AS j", "1 AS cb")
    J.expanded(a, b, spark.range(1).selectExpr("1 AS ca", "1 AS cb"), "ca", "cb").write.parquet(f"{tmp_path}/pairs")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    rows = spark.read.parquet(f"{tmp_path}/pairs").agg(F.count("*").alias("n"), F.sum("i").alias("i"), F.sum("j").alias("j")).first()
    assert tuple(rows) == (7_001_000, 7001 * 999 * 500, 1000 * 7000 * 7001 // 2)
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 0.4 * rows.n


def test_codes_merged_once_for_equal_types(spark):
    df = [(i % 40, [i % 3, None] if i % 5 else [7]) for i in range(60)] + [(None, [1]), (99, None), (98, [])]
    codes = [(0, ["b", "a"]), (1, ["c", None]), (1, ["b"]), (None, ["z"])]
    got = J.merge_codes(spark.createDataFrame(df, "k int, t array<int>"), "t", spark.createDataFrame(codes, "u int, c array<string>"), "u", "c", "k")
    by = {}
    for k, t in df:
        by.setdefault(k, set()).update(c for x in t or [] if x is not None for u, cs in codes if u == x for c in cs if c)
    assert {r.k: list(r.codes) for r in got.collect()} == {k: sorted(v) for k, v in by.items()} and got.count() == len(by)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not any("collect_set(_c#" in x and "Aggregate [k#" in x for x in plan.splitlines())


def test_inferred_edges_by_class(spark):
    rng = random.Random(6)
    a = [(rng.choice([*range(9), None]), rng.choice([0, 1, 2, 3, None])) for _ in range(25)]
    b = [(rng.choice([0, 1, 2, 3, None]), i % 50, rng.choice(["ax", "by", None])) for i in range(120)] + [(1, None, "ab")]
    types = [(0, ["a"]), (1, ["a", "b"]), (1, ["x"]), (2, []), (3, ["y", None])]
    got = G.inferred_edges(spark.createDataFrame(a, "src_id int, mid int"), spark.createDataFrame(b, "mid int, dst_id int, name string"), spark.createDataFrame(types, "mid int, names array<string>"))
    want = {(s, d) for s, m in a for n, d, name in b for k, ws in types if m is not None and m == n == k and name and any(w and w in name for w in ws)}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)
    assert not widest_window_or_group(got, ["src_id", "dst_id"])


# --- laws that share an id ------------------------------------------------------------------------

#: Documents whose laws' 32-bit ids are equal.
TWINS = (13371, 32952)
LAW_QUERIES = ["x14_articles", "x15_references", "x15_meant_targets", "k09_tree_edges", "k11_reference_edges", "q08_reference_report", "q08_top_targets"]


@pytest.mark.parametrize("name", LAW_QUERIES)
def test_laws_that_share_an_id(spark, tmp_path, name):
    md5 = {i: hashlib.md5(f"법{i}".encode()).hexdigest()[:8] for i in TWINS}
    assert len(set(md5.values())) == 1
    docs = [(i + k, "\n".join(f"text {(i + k) % 7} {n}" for n in range(3 + 3 * k))) for i in TWINS for k in range(3)] + [(1, "one"), (2, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = con.execute(catalog.ORACLES[name])
    cols = [d[0] for d in found.description]
    want = sorted(map(repr, (tuple(map(plain, r)) for r in found.fetchall())))
    got = sorted(map(repr, (tuple(plain(r[c]) for c in cols) for r in catalog.QUERIES[name](spark, str(tmp_path)).collect())))
    assert got == want


def test_missing_targets_of_laws_that_share_an_id(spark):
    arts = spark.createDataFrame([("L", "a", "001", 0, None, "x"), ("L", "b", "002", 0, None, "y"), ("L", "b", "002", 1, 1, "z")], "law_id string, law_name string, article_number string, depth int, clause_number int, article_id string")
    refs = spark.createDataFrame([(1, "L", "a", "002", 1), (2, "L", "b", "002", 1), (3, "L", "b", "001", None)], "i int, target_law_id string, target_law_name string, target_article_number string, target_clause int")
    assert {r.i: (r.reason, r.target_law_name) for r in J.missing_targets(refs, arts).collect()} == {1: ("article", "a"), 3: ("article", "b")}
    assert {r.i: r.target_article_id for r in J.refine_target(refs, arts).collect()} == {1: None, 2: "z", 3: None}


# --- words in texts -------------------------------------------------------------------------------


def test_finder_of_many_words():
    """Words of all byte lengths, alike in their first 8 or 16 bytes, ends of texts, nulls, NUL bytes and slices, against `in`."""
    rng = random.Random(8)
    made = lambda n: "".join(rng.choice("abé가\0😀") for _ in range(n))
    texts = [rng.choice([None, "", made(rng.randint(1, 60)), made(3) + "abababababababab" * 3 + made(2)]) for _ in range(300)]
    words = sorted({made(rng.randint(1, 9)) for _ in range(400)} | {"ab" * n for n in range(1, 24)} | {"ab" * 8 + "x", "\0", "x" * 40})
    want = [[w for w in words if w in (t or "")] for t in texts]
    for some in (words, [w for w in words if len(w) >= J.FIRST], []):
        assert J.word_finder(some)(pa.array(texts, pa.string())).to_pylist() == [[w for w in ws if w in some] for ws in want]
    assert J.word_finder(words)(pa.array([None, ""], pa.string())).to_pylist() == [[], []]
    a = pa.array([*texts, "y" * (J.SLICE + 5), "z"], pa.string()).slice(7)
    parts = list(J.bounded_slices(a))
    assert pa.concat_arrays(parts).equals(pa.concat_arrays([a])) and len(parts) > 1


def test_many_long_words_need_no_index(spark):
    words = [f"word{i}" for i in range(600)]
    texts = [(i, f"a word{i} and xword{i * 7 % 900}y") for i in range(40)] + [(1, None), (0, "word599")]
    got = J.containments(spark.createDataFrame(texts, "k int, t string"), ["k"], "t", spark.createDataFrame([(w,) for w in words], "w string"), "w")
    assert sorted(map(tuple, got.collect())) == sorted({(k, w) for k, t in texts if t for w in words if w in t})
    assert "_g#" not in got._jdf.queryExecution().optimizedPlan().toString()


# --- memory of workers ----------------------------------------------------------------------------


def test_pages_leave_in_bounded_slices():
    """A batch of pages is not turned to Python objects as a whole."""
    pages = ["<p>" + "x" * 1000] * 600 + [None, "y" * (T.SLICE + 1), ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(pages)), pa.int64()), pa.array(pages, pa.string())], ["i", "h"])
    parts = list(X._by_size(iter([batch, batch])))
    assert [i for ids, _ in parts for i in ids.to_pylist()] == [*range(len(pages))] * 2
    assert [h for _, hs in parts for h in hs.to_pylist()] == pages * 2
    assert max(sum(len(h or "") for h in hs.to_pylist()) for _, hs in parts if len(hs) > 1) <= T.SLICE


def test_nfkc_of_slices(spark):
    texts = ["ﬁ①", None, "", "a" * (T.SLICE + 1), "Å" * 5]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1).select("i", T.nfkc("t").alias("n")).collect()
    assert [r.n for r in sorted(got)] == ["fi1", None, "", "a" * (T.SLICE + 1), "Å" * 5]


# --- rows of a task -------------------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_co_members_are_dealt_by_the_number_of_rows(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.randint(1, 30), rng.randint(1, 12)) for _ in range(300)] + [(None, 1), (None, 2), (1, None)]
    df = spark.createDataFrame(rows, "g int, m int")
    monkeypatch.setattr(J, "PAIRED_ROWS", 7)
    got = J.co_members(df, "g", "m")
    assert "REPARTITION_BY_NUM" in plan_of(got) and f", {-(-len(rows) // 7)})" in plan_of(got)
    of = {}
    for g, m in rows:
        of.setdefault(g, set()).add(m)
    want = Counter((a, b) for g, ms in of.items() if g is not None for a in ms for b in ms if None not in (a, b) and a != b)
    assert {(r.a, r.b): r.shared for r in got.collect()} == want and got.count() == len(want)


def test_examples_of_a_term_are_dealt_once_by_the_number_of_terms(spark, monkeypatch):
    rng = random.Random(5)
    words = ["aa", "bb", "cc", "dd"]
    terms = [(i % 45, " ".join(rng.choice(words) for _ in range(rng.randint(0, 3)))) for i in range(60)] + [(7, None)]
    pool = [(k, f"{k}{s}", s, rng.sample(words, rng.randint(0, 3)), rng.sample(words, rng.randint(0, 2))) for k in ("core", "boundary", "fixed") for s in range(1, 9)]
    monkeypatch.setattr(C, "TERMS", 2)
    got = C.choose_examples(spark.createDataFrame(terms, "term int, text string"), spark.createDataFrame(pool, "kind string, example string, seq int, keywords array<string>, cues array<string>"), "term", "text", 3, 2)
    plan = plan_of(got)
    assert ", 31), REPARTITION_BY_NUM" in plan
    assert "Exchange" not in plan.split("REPARTITION_BY_NUM")[0].rsplit("\n", 1)[0]  # nothing above deals the rows again
    want = set()
    for t in {t for t, _ in terms}:
        texts = [x or "" for y, x in terms if y == t]
        for kind, most in (("core", 3), ("boundary", 3), ("fixed", 2)):
            some = []
            for k, e, s, ws, cues in pool:
                if k == kind:
                    score = 0 if k == "fixed" else 2 * sum(any(w in x for x in texts) for w in ws) + 3 * any(c in x for c in cues for x in texts)
                    some.append((-score, s, e))
            want |= {(t, kind, e, -score, i + 1) for i, (score, s, e) in enumerate(sorted(some)[:most])}
    assert {(r.term, r.kind, r.example, r.score, r["rank"]) for r in got.collect()} == want


# --- laws in place --------------------------------------------------------------------------------


def own_articles(title, content):
    """(title, depth, article, clause, subclause, item, text, first line, last line) by a loop over the lines."""
    out, at, body = [], [None] * 4, []
    lines = [x.strip(" ") for x in content.split("\n")]
    for i, x in enumerate(lines):
        d = next((d for d, p in enumerate((L.ARTICLE, L.CLAUSE, L.SUBCLAUSE, L.ITEM)) if re.match(p, x)), None)
        if d is not None:
            m = re.match((L.ARTICLE, L.CLAUSE, L.SUBCLAUSE, L.ITEM)[d], x)
            at[d:] = [m[1] if d in (0, 3) else "①②③".index(m[1]) + 1 if d == 1 else int(m[1])] + [None] * (3 - d)
            if d == 0:
                body = [[], i]
            if at[0] is not None:
                body[1] = i
                out.append((title, d, at[0].zfill(3), *at[1:], body if d == 0 else x, i, None if d == 0 else i))
        elif at[0] is not None:
            body[0].append(x)
            body[1] = i
    return [(*r[:6], "\n".join(r[6][0]), r[7], r[6][1]) if r[1] == 0 else r for r in out]


def test_articles_are_cut_in_place(spark):
    rng = random.Random(6)
    kinds = ["제1조(목적)", "제12조 (가)  ", " 제3조(나)", "제4조(다) 뒤", "① 하나", "  ② 둘", "③없음", "1. 가", "12. 나", "가. 항목", "나. 항목", "1.x", "", " 평문", "제3조에 따라"]
    laws = [(f"법{i}", "\n".join(rng.choice(kinds) for _ in range(rng.randint(0, 30)))) for i in range(80)] + [("긴법", "제1조(긴)\n" + "\n".join(rng.choice(kinds[4:]) for _ in range(40_000)))]
    got = L.articles(spark.createDataFrame([*laws, ("널", None)], "title string, content string"))
    assert "Exchange" not in plan_of(got) and "Window" not in plan_of(got)
    rows = got.select("law_name", "depth", "article_number", "clause_number", "subclause_number", "item_number", "full_text", "line_start", "line_end").collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(repr(r) for title, content in laws for r in own_articles(title, content))


@pytest.mark.parametrize("name", ["x14_articles", "x15_references"])
def test_laws_are_read_without_a_shuffle(spark, name):
    assert "Exchange" not in plan_of(catalog.QUERIES[name](spark, "/root/testdata/sf0.001"))
