"""Golden rows of the scalar, extraction, matching and graph operators."""

import pytest
from pyspark.sql import functions as F

from medgraph.functions import text as T
from medgraph.operators import aggregates as A
from medgraph.operators import curate as C
from medgraph.operators import extract as X
from medgraph.operators import graph as G
from medgraph.operators import joins as J
from medgraph.operators import legal as L
from medgraph.operators import ordering as W
from medgraph.sources import readers as S
from medgraph.sources import sinks
from medgraph.streaming import ingest


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "c string").select(f(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "f,given,want",
    [
        (T.normalize_text, " a“b”  ﬁ–x ", 'a"b" fi-x'),
        (T.romanize, "파클리탁셀x", "pakeulritagselx"),
        (T.ingredient_in_parens, "옵디보주100mg(니볼루맙, x)", "니볼루맙"),
        (T.brand, "옵디보주100mg(니볼루맙)", "옵디보"),
        (T.squeeze, "a b\tc", "abc"),
        (T.normalize_key, "Ab-c (D)!", "abcd"),
        (lambda c: T.salt_split(c)["base"], "leuprorelin acetate", "leuprorelin"),
        (lambda c: T.salt_split(c)["salt"], "leuprorelin acetate", "acetate"),
        (lambda c: T.atc_levels(c)["level3"], "L01EB01", "L01EB"),
        (lambda c: T.atc_levels(c)["level3"], "L01", None),
        (T.greek_synonyms, "α-Tocopherol", ["alpha-Tocopherol", "alphaTocopherol"]),
        (T.greek_letters, "Test μg/mL", []),
        (lambda c: T.greek_synonyms(c, T.GREEK_KO), "β-Carotene", ["베타-Carotene", "베타Carotene"]),
        (lambda c: T.salt_split(c)["salt"], "모르핀이말레산염", "maleate"),
        (lambda c: T.salt_split(c)["base"], "모르핀이말레산염", "모르핀"),
        (lambda c: T.salt_split(c)["salt"], "vinorelbine tartrate", "tartrate"),
        (T.brand, "가나현탁액100mg(다라)", "가나"),
        (T.is_antibody, "Pegfilgrastim", True),
        (T.is_antibody, None, False),
        (lambda c: T.name_with_source(c, F.lit("나"), F.lit(None).cast("string"))["source"], "가", "extracted"),
        (lambda c: T.name_with_source(c, c, F.lit(None).cast("string"))["source"], "가", "atc"),
        (lambda c: T.name_with_source(c, c, F.lit("다"))["name"], "가", "다"),
        (T.greek_synonyms, "Dexamethasone", []),
        (T.plain_name, "Leucovorin (x)", "leucovorin"),
        (lambda c: T.disease_code(c)["kind"], "C50.1", "detailed"),
        (lambda c: T.disease_code(c)["kind"], "C50", "category"),
        (lambda c: T.disease_code(c)["end_number"], "C50-C52", 52),
        (T.article_number, "제3조의2", "003_02"),
        (T.law_id, "의료급여법", "LAW_A267443F"),
        (T.circled, "③", 3),
        (T.circled, "x", None),
        (T.number_cell, "1,234.5", 1234.5),
        (T.number_cell, "n/a", None),
        (T.strip_html, "<b>a</b>&nbsp;b", "a b"),
        (T.null_tokens, "nan", None),
        (T.null_tokens, "12.0", "12"),
        (T.array_literal, "['a', 'b']", ["a", "b"]),
        (lambda c: T.alias_fold(c, [("PD-L1", "PDL1"), ("HER-2", "HER2"), ("K-RAS", "KRAS")]), "K-RAS", "KRAS"),
        (lambda c: T.first_label(c, [("시행규칙", "시행규칙"), ("시행령", "시행령")], "법률"), "의료법 시행령", "시행령"),
        (lambda c: T.marker_of_title(c, ["EGFR"]), "검사 [KRAS]", "KRAS"),
        (lambda c: T.tab_field(c, 3), "a\tb", ""),
        (T.law_number, "의료법 [법률 제123호, 2020]", "123"),
        (lambda c: T.drop_phrases(c, ["(인쇄)"]), "a(인쇄)\n\n\nb", "a\nb"),
    ],
)
def test_scalars(spark, f, given, want):
    assert one(spark, given, f) == want


def test_search_keys(spark):
    keys = one(spark, "옵디보주100mg(니볼루맙)", T.search_keys)
    assert {"옵디보주100mg", "옵디보주", "옵디보", "니볼루맙"} <= set(keys)


def test_cancer_codes(spark):
    df = spark.createDataFrame([("C50",), ("D48.1",), ("D50",), ("C00-D48",), (None,)], "c string")
    assert [r[0] for r in df.select(T.is_cancer_strict(F.col("c"))).collect()] == [True, True, False, False, False]
    assert [r[0] for r in df.select(T.is_cancer_lenient(F.col("c"))).collect()] == [True, True, False, True, False]


def test_similarity(spark):
    from difflib import SequenceMatcher

    df = spark.createDataFrame([("paclitaxel", "pakeulritaksel"), ("a", None)], "a string, b string")
    got = [r[0] for r in df.select(T.similarity("a", "b")).collect()]
    assert got[0] == SequenceMatcher(None, "paclitaxel", "pakeulritaksel").ratio() and got[1] is None


def test_extraction(spark):
    d = spark.createDataFrame([(1, "파클리탁셀 (paclitaxel) 그리고 docetaxel (도세탁셀)"), (2, None)], "doc_id long, text string")
    assert {(r.english, r.korean) for r in X.bilingual_pairs(d).collect()} == {("paclitaxel", "파클리탁셀"), ("docetaxel", "도세탁셀")}
    s = X.spans(d, {"taxel": r"\w+taxel\b"}).collect()
    assert {r.surface for r in s} == {"docetaxel", "paclitaxel"} and all(r.span_end - r.span_start == len(r.surface) for r in s)
    t = spark.createDataFrame([(1, "x\n| 항암요법 | 비고 |\n|---|---|\n| FOLFOX1 | a |\n| CHOP2 |\ny")], "doc_id long, text string")
    rows = sorted((r.cells["항암요법"], r.cells["비고"]) for r in X.markdown_rows(t, "항암요법").collect())
    assert rows == [("CHOP", ""), ("FOLFOX", "a")]
    b = spark.createDataFrame([(1, "없음"), (2, "앞\n- 비소세포폐암에 ‘A + B’ 2차 추가\n계속\nㆍ 위암")], "doc_id long, text string")
    sec = X.bullet_sections(b)
    assert sec.count() == 2
    rel = X.section_relations(sec, ["폐암", "비소세포폐암", "위암"]).collect()
    assert [(r.cancer, r.drugs, r.therapy_line, r.action) for r in rel] == [("비소세포폐암", ["A", "B"], 2, "add")]
    o = spark.createDataFrame([(1, "## A\n### B\n* i\n## C\n* j")], "doc_id long, text string")
    assert [(r.item, r.path) for r in X.outline(o).orderBy("line").collect()] == [("i", ["A", "B"]), ("j", ["C"])]
    p = spark.createDataFrame([(["1", "2"], ["a"])], "codes array<string>, names array<string>")
    assert [(r.codes, r.names) for r in X.paired_arrays(p, "codes", "names").orderBy("pos").collect()] == [("1", "a"), ("2", None)]
    lex = spark.createDataFrame([("gene fusion",), ("EGFR",), ("a b c",)], "term string")
    txt = spark.createDataFrame([(1, "The EGFR and Gene fusion"), (2, "x a b c y"), (3, None)], "doc_id long, text string")
    assert {(r.doc_id, r.term, r.position) for r in X.lexicon_hits(txt, lex).collect()} == {(1, "EGFR", 5), (1, "gene fusion", 14), (2, "a b c", 3)}
    h = spark.createDataFrame([(1, "<nav><h2>no</h2></nav><h2>A</h2>t<table><tr><th>k</th><td>v</td></tr></table><img src='p.png' alt='z'><img src='icon.png'>")], "page_id long, html string")
    r = X.page_parts(h).first()
    assert [x.heading for x in r.sections] == ["A"] and r.tables == [[["k", "v"]]] and [x.src for x in r.images] == ["p.png"]
    assert X.record_map(X.page_parts(h)).first().fields == {"k": "v"}


RULES = {"hard": ["바이알", "앰플"], "conditional": ["mL"], "hints": ["성분"], "suffixes": [{"en": "taxel", "ko": ["탁셀"], "strict": True}, {"en": "sone", "ko": ["손", "솔론"], "strict": True}], "strict": 0.25, "loose": 0.35, "high_frequency": 20, "regimen": ["FOLFOX"], "biomarker": ["HER2"], "disease": ["NSCLC", "ALL"], "context_tokens": ["투여"]}
ENTRIES = [("paclitaxel", "파클리탁셀", 36), ("busulfan", "바이알", 10), ("prednisolone", "아비라테론", 15), ("FOLFOX", "폴폭스", 20), ("HER2", "허투", 30), ("NSCLC", "비소세포폐암", 25), ("palliative", "팔리아티브", 3), ("docetaxel", "파클리탁셀", 2), (None, None, 1)]


def entries(spark):
    return spark.createDataFrame([(e, k, n, None, i) for i, (e, k, n) in enumerate(ENTRIES)], "en string, ko string, count int, context_span string, seq long")


def test_gate_chain(spark):
    got = {r.seq: r for r in C.gate_chain(entries(spark), RULES).collect()}
    assert [got[i].decision for i in range(6)] == ["active", "drop", "pending", "route_regimen", "route_biomarker", "route_disease"]
    assert "PASS_ALL" in got[0].reason_codes and "FORM_TERM" in got[1].reason_codes and "ROUTE_DISEASE" in got[5].reason_codes
    assert got[2].reason_codes and got[2].reason_codes[0] in ("SUFFIX_MISMATCH", "PHONETIC_FAIL")
    assert not got[6].decision.startswith("route") and (got[7].decision, got[7].reason_codes[-1]) == ("pending", "ALIAS_CONFLICT")
    assert len(got) == len(ENTRIES)
    assert {r.seq: r.decision for r in C.gate_chain(entries(spark), RULES, legacy_unanchored=True).collect()}[6] == "route_disease"
    cur = spark.createDataFrame([("busulfan", "바이알")], "en string, ko string")
    assert {r.seq: r.reason_codes for r in C.gate_chain(entries(spark), RULES, curated=cur).collect()}[1] == ["PASS_ALL", "CURATED_WHITELIST"]
    shuffled = {r.seq: r.decision for r in C.gate_chain(entries(spark).repartition(5), RULES).collect()}
    assert shuffled == {k: v.decision for k, v in got.items()}


def test_legal(spark):
    text = "서문\n제1조(목적)\n본문이다\n① 첫째 「국민건강보험법」 제1조를 준용한다\n1. 하나\n가. 항목\n제3조의2(끝)"
    laws = spark.createDataFrame([("의료급여법", text)], "title string, content string")
    arts = L.articles(laws).orderBy("line_start").collect()
    assert [(a.depth, a.article_number) for a in arts] == [(0, "001"), (1, "001"), (2, "001"), (3, "001"), (0, "003_02")]
    for child, parent in zip(arts[1:4], arts[:3]):
        assert child.parent_article_id == parent.article_id
    assert arts[0].full_text == "본문이다" and arts[1].article_id == "ART_LAW_A267443F_001_C1"
    refs = L.references(spark.createDataFrame([(a.article_id, a.full_text) for a in arts], "article_id string, full_text string")).collect()
    assert [(r.kind, r.target_law_name, r.target_article_number, r.reference_type) for r in refs] == [("cross_law", "국민건강보험법", "001", "준용")]
    has, child = L.tree_edges(L.articles(laws))
    assert has.count() == 2 and child.count() == 3
    r = spark.createDataFrame([(1, "L", "001", 1), (2, "L", "001", 9), (3, "L", "007", None)], "i int, target_law_id string, target_article_number string, target_clause int")
    a = spark.createDataFrame([("L", "001", 0, None, "A"), ("L", "001", 1, 1, "A1")], "law_id string, article_number string, depth int, clause_number int, article_id string")
    assert {x.i: x.target_article_id for x in J.refine_target(r, a).collect()} == {1: "A1", 2: "A", 3: None}
    assert {x.i: x.reason for x in J.missing_targets(r, a).collect()} == {2: "clause", 3: "article"}


def test_joins(spark):
    bio = spark.createDataFrame([("B1", ["l1"], ["s1"]), ("B2", [], ["414464004"])], "biomarker string, loinc array<string>, snomed array<string>")
    tests = spark.createDataFrame([("T1", "l1", "s1"), ("T2", None, "414464004")], "test_id string, l string, s string")
    m = J.tiered_codes(bio, tests, [("loinc_code", "loinc", "l", 0.98), ("snomed_code", "snomed", "s", 0.95)], "biomarker", "test_id", ["414464004"]).collect()
    assert [(r.biomarker, r.test_id, r.match_type, r.confidence) for r in m] == [("B1", "T1", "loinc_code", 0.98)]
    nm = J.name_match(spark.createDataFrame([("ALK",)], "a string"), spark.createDataFrame([("ALK",), ("ALK test",), ("ROS1/ALK",), (None,)], "b string"), "a", "b")
    assert {r.b: r.confidence for r in nm.collect()} == {"ALK": 0.95, "ALK test": 0.85, "ROS1/ALK": 0.85}
    master = spark.createDataFrame([("C50",), ("C50.1",), ("C501",), ("C5",)], "code string")
    assert {r.code for r in J.prefix_expand(spark.createDataFrame([("C50",)], "e string"), master, "e", "code").collect()} == {"C50", "C50.1"}
    it = spark.createDataFrame([("C34", "C", 34)], "code string, ch string, n int")
    rg = spark.createDataFrame([("C30-C39", "C", 30, 39), ("C00-C75", "C", 0, 75)], "block string, ch string, lo int, hi int")
    assert J.range_contains(it, rg, "ch", "n", "lo", "hi", [F.col("hi") - F.col("lo")]).first().block == "C30-C39"
    men = spark.createDataFrame([("a",), ("b",), ("c",)], "mention string")
    two = J.two_stage(men, spark.createDataFrame([("a",), ("z",)], "key string"), spark.createDataFrame([("b", "z"), ("a", "z"), ("c", "q")], "alias string, key string"))
    assert {r.mention: (r.match_type, r.matched_key) for r in two.collect()} == {"a": ("direct", "a"), "b": ("alias", "z"), "c": ("unmatched", None)}
    reg = spark.createDataFrame([(1, ["5-fu", "x"])], "id int, drugs array<string>")
    res = J.resolve_list(reg, "drugs", spark.createDataFrame([("5-fu", "L01BC02")], "n string, c string"), "id", "n", "c").first()
    assert (res.codes, res.missing) == (["L01BC02"], ["x"])
    bm = J.base_name_match(spark.createDataFrame([("의료법 시행령",), ("의료법",), ("상법",)], "n string"), spark.createDataFrame([("의료법",)], "t string"), "n", "t", r"\s*시행(령|규칙)$")
    assert {r.n: r.match_type for r in bm.collect()} == {"의료법 시행령": "base", "의료법": "exact", "상법": None}
    rules = spark.createDataFrame([("x1", None, "A", 1), (None, "k1", "B", 2)], "loinc string, kw string, label string, priority int")
    cas = J.cascade(spark.createDataFrame([("x1", "k1"), ("n", "k1"), ("n", "n")], "c1 string, c2 string"), rules, [("t1", "c1", "loinc"), ("t2", "c2", "kw")])
    assert sorted((r.label or "", r.tier or "") for r in cas.collect()) == [("", ""), ("A", "t1"), ("B", "t2")]
    mc = J.mutual_contains(spark.createDataFrame([("폐암",), ("위암",)], "a string"), spark.createDataFrame([("비소세포폐암",), ("위암",)], "b string"), "a", "b")
    assert {r.a: (r.b, r.confidence) for r in mc.collect()} == {"폐암": ("비소세포폐암", 0.8), "위암": ("위암", 0.95)}


def test_ordering(spark):
    df = spark.createDataFrame([("k", "ab", 1), ("k", "abcd", 2)], "code string, name string, seq int")
    assert W.longest_by(df, ["code"], "name", "seq").first().name == "abcd"
    box = "struct<x0: double, top: double, x1: double, bottom: double>"
    seg = spark.createDataFrame([("d", p, 0, (10.0, 0.0, 110.0, 9.0), [["h1", "h2"], [str(p), "x"]], True) for p in (1, 2, 3, 5)], f"doc string, page_num int, table_idx int, bbox {box}, rows array<array<string>>, has_header boolean")
    st = W.stitch_tables(seg).orderBy("table_no").collect()
    assert [(r.first_page, r.last_page, len(r.rows)) for r in st] == [(1, 3, 4), (5, 5, 2)]
    nums = W.number(spark.createDataFrame([(c,) for c in "dbca"], "k string"), "BIO_", ["k"]).collect()
    assert {r.k: r.id for r in nums} == {"a": "BIO_001", "b": "BIO_002", "c": "BIO_003", "d": "BIO_004"}
    ch = W.page_chunks(spark.createDataFrame([("d", "s", 1, 120)], "doc string, section string, start int, end int")).orderBy("chunk").collect()
    assert [(r.chunk_start, r.chunk_end) for r in ch] == [(1, 40), (41, 80), (81, 120)]
    gr = W.greedy_chunks(spark.createDataFrame([("d", "a", 1, 20), ("d", "b", 21, 45), ("d", "c", 46, 70)], "doc string, section string, start int, end int")).collect()
    assert {r.section: r.chunk for r in gr} == {"a": 0, "b": 0, "c": 1}
    mc = W.merge_chunks(spark.createDataFrame([("d", 1, "B", ["y"]), ("d", 0, "A", ["x"]), ("d", 2, None, None)], "doc string, chunk int, content string, elements array<string>")).first()
    assert (mc.content, mc.elements, mc.failed) == ("A\n\nB", ["x", "y"], 1)
    tiers = A.tiers(spark.createDataFrame([(k,) for k, n in (("a", 20), ("b", 10), ("c", 5), ("d", 4)) for _ in range(n)], "k string"), "k").collect()
    assert {r.tier: r["rows"] for r in tiers} == {1: 20, 2: 10, 3: 5, 4: 4}


def test_classifiers(spark):
    df = spark.createDataFrame([(30, 1, 0.0), (150, 1, 0.0), (500, 1, 0.0), (5, 0, 0.0)], "c int, p int, l double")
    assert [r[0] for r in df.select(C.quality_grade("c", "p", F.col("l"))).collect()] == ["C", "B", "A", "C"]
    rules = spark.createDataFrame([("약물", "항암", "keyword", 1), ("검사", "검사", "suffix", 2)], "category string, keyword string, kind string, priority int")
    terms = spark.createDataFrame([("유전자검사", "검사 임상시험"), ("가", "항암 항암"), ("나", "없다")], "title string, content string")
    c2 = C.keyword_classifier(terms, rules, "title", "content")
    assert {r.title: r.category for r in c2.collect()} == {"유전자검사": "검사", "가": "약물"}
    c3 = {r.title: r for r in C.early_rules(terms, [("임상시험", "임상시험/연구", 0.95)], "content", c2, "title").collect()}
    assert (c3["유전자검사"].category, c3["유전자검사"].confidence) == ("임상시험/연구", 0.95) and c3["가"].confidence == 0.4 and c3["나"].category is None
    prod = spark.createDataFrame([("L01XK01", "olaparib", "린파자정", "AZ", 1), ("L01BC02", "fluorouracil sodium", "오에프유주", "X", 2)], "atc_code string, ingredient string, brand string, maker string, seq int")
    names = spark.createDataFrame([("L01XK", "PARP 억제제")], "code string, name string")
    cats = spark.createDataFrame([("L01XK", "표적치료제")], "code string, category string")
    d = {r.ingredient: r for r in C.build_dictionary(prod, names, cats, "세포독성 항암제").collect()}
    assert d["olaparib"].therapeutic_category == "표적치료제" and d["fluorouracil sodium"].therapeutic_category == "세포독성 항암제" and d["fluorouracil sodium"].salt == "sodium"


def test_graph(spark):
    old = spark.createDataFrame([("a", "x", None), ("b", "y", "1")], "id string, name string, v string")
    new = spark.createDataFrame([("a", "z", "2"), ("c", "w", "3")], "id string, name string, v string")
    keep = {r.id: (r.name, r.v) for r in G.upsert(old, new, "id").collect()}
    assert keep == {"a": ("x", "2"), "b": ("y", "1"), "c": ("w", "3")}
    again = {r.id: (r.name, r.v) for r in G.upsert(G.upsert(old, new, "id"), new, "id").collect()}
    assert again == keep
    over = {r.id: (r.name, r.status) for r in G.upsert(old, new, "id", keep_old=False, status=True).collect()}
    assert over == {"a": ("z", "updated"), "b": ("y", "unchanged"), "c": ("w", "created")}
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src_id string, dst_id string")
    down = {(r.node, r.depth) for r in G.descend(e, spark.createDataFrame([("a",)], "id string"), 5).collect()}
    assert {("b", 1), ("c", 2), ("d", 3), ("a", 3)} == down
    assert sorted(tuple(r.nodes) for r in G.chains(e, 3, 3).collect()) == [("a", "b", "c", "a"), ("a", "b", "c", "d"), ("b", "c", "a", "b"), ("c", "a", "b", "c")]
    near = {r.id: r.distance for r in G.neighbourhood(e, spark.createDataFrame([("a",)], "id string"), 2).collect()}
    assert near == {"a": 0, "b": 1, "c": 1, "d": 2}
    m = G.merge_edges(spark.createDataFrame([("a", "b", 1), ("a", "b", 2)], "src_id string, dst_id string, p int"), [F.col("p")]).collect()
    assert [(r.src_id, r.p) for r in m] == [("a", 1)]
    nodes = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C"), ("d", "D")], "id string, name string")
    assert {r.violations for r in G.integrity(nodes, "id", ["name"], e).collect()} == {0}
    codes = spark.createDataFrame([("C34",), ("C34.1",)], "code string")
    blocks = spark.createDataFrame([("C30-C39", "C", 30, 39)], "code string, chapter string, lo int, hi int")
    assert {(r.src_id, r.dst_id) for r in G.code_hierarchy(codes, blocks).collect()} == {("C34.1", "C34"), ("C34", "C30-C39")}
    lab = nodes.withColumn("label", F.lit("x"))
    assert [r.id for r in G.ask(spark, "neighbours", lab, e.withColumn("edge_type", F.lit("t")), id="c").collect()] == ["a", "d"]


def test_sources(spark, tmp_path):
    (tmp_path / "in/b1").mkdir(parents=True)
    (tmp_path / "in/b1/a.json").write_text('{"content": "x", "pages": 2}', encoding="utf-8-sig")
    (tmp_path / "in/b1/bad.json").write_text("{oops")
    got = S.json_documents(spark, str(tmp_path / "in")).cache()
    assert {(r.board, r.content) for r in got.collect()} == {("b1", "x"), ("b1", None)} and got.where("_corrupt_record is not null").count() == 1
    d = spark.createDataFrame([('{"k": {"records": [{"code": "1"}], "is_normalized": true}}',)], "v string")
    assert [(r.key, r.is_normalized, r.code) for r in S.keyed_dictionary(d, "v", "code: string").collect()] == [("k", True, "1")]
    m = S.code_master(spark.createDataFrame([("C50", "1.0"), ("C51", None)], "x string, y string"), ["code", "leaf"], ["leaf"])
    assert [r.leaf for r in m.collect()] == [True, False]
    assert {r.column: r.nulls for r in S.null_census(spark.createDataFrame([("a", None)], "a string, b string")).collect()} == {"a": 0, "b": 1}
    assert S.inventory(spark, str(tmp_path / "in")).first().files == 2
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id int, v string")
    sinks.dual(df, str(tmp_path / "out"), ["id", "v"])
    assert spark.read.schema("id int, v string").csv(str(tmp_path / "out/csv"), header=True).count() == 3
    sinks.by_decision(df, str(tmp_path / "dec"), "v")
    assert spark.read.parquet(str(tmp_path / "dec")).where("v = 'a'").count() == 1
    sinks.rewrite_distinct(df, str(tmp_path / "dist"), ["id"], [F.col("v")])
    assert spark.read.parquet(str(tmp_path / "dist")).count() == 2
    sinks.audit_log(df, str(tmp_path / "log"))
    sinks.append(df, str(tmp_path / "csv"))


def test_streaming(spark, tmp_path):
    src, dst, ck = (str(tmp_path / x) for x in ("s", "d", "c"))
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string").write.parquet(src)
    schema = spark.read.parquet(src).schema
    ingest.ingest(spark, src, schema, dst, ck, "id").awaitTermination()
    spark.createDataFrame([(2, "x"), (3, "y")], "id int, v string").write.mode("append").parquet(src)
    ingest.ingest(spark, src, schema, dst, ck, "id").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(dst).collect()) == [1, 2, 3]
    assert ingest.new_rows(spark.read.parquet(src), spark.read.parquet(dst), "id").count() == 0


def test_long_items_and_arrays(spark):
    long = "x" * 10_050 + " end"
    o = spark.createDataFrame([(1, f"## A\n* {long}\n* * j")], "doc_id long, text string")
    assert [r.item for r in X.outline(o).orderBy("line").collect()] == [long, "* j"]
    n = (1 << 20) + 5
    p = spark.range(1).select(F.sequence(F.lit(1), F.lit(n)).alias("codes"), F.sequence(F.lit(1), F.lit(n)).alias("names"))
    got = X.paired_arrays(p, "codes", "names").agg(F.count("*").alias("n"), F.count_if(F.col("codes") == F.col("names")).alias("same")).first()
    assert (got.n, got.same) == (n, n)


def test_gate_reasons_of_conditional_terms(spark):
    rows = [("mL", "mL", None, 0), ("x", "mL", "성분 이다", 1), ("mL", "가나", None, 2), ("바이알", "가나", None, 3)]
    e = spark.createDataFrame([(en, ko, 1, ctx, i) for en, ko, ctx, i in rows], "en string, ko string, count int, context_span string, seq long")
    got = {r.seq: (r.decision, r.reason_codes) for r in C.gate_chain(e, RULES).collect()}
    assert got[0] == ("drop", ["CONTEXT_PACKAGING"])
    assert got[1][0] != "drop" and got[2][0] != "drop" and got[3][0] != "drop"  # a hint in the context; only Korean names are tested


def test_gate_promotion(spark):
    e = spark.createDataFrame([("paclitaxal", "파클리", 1, "FOLFOX 와 함께", 0), ("paclitaxal", "파클리", 1, "혼자", 1)], "en string, ko string, count int, context_span string, seq long")
    p = spark.createDataFrame([("FOLFOX", "paclitaxal")], "anchor string, drug string")
    got = {r.seq: (r.decision, r.reason_codes) for r in C.gate_chain(e, {"strict": 0.1, "loose": 0.1}, promotion=p).collect()}
    assert got[0][0] == "active" and "CTX_PROMOTE" in got[0][1]
    assert got[1] == ("pending", ["PHONETIC_FAIL"])


def test_rows_that_repeat(spark):
    it = spark.createDataFrame([("C", 34), ("C", 34), (None, 34), ("C", 99)], "ch string, n int")
    rg = spark.createDataFrame([("C30-C39", "C", 30, 39), ("C00-C75", "C", 0, 75)], "block string, ch string, lo int, hi int")
    got = J.range_contains(it, rg, "ch", "n", "lo", "hi", [F.col("hi") - F.col("lo")])
    assert [(r.ch, r.n, r.block) for r in got.collect()] == [("C", 34, "C30-C39")] * 2
    names = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "name string")
    master = spark.createDataFrame([("a", 1), ("A2", 2)], "m string, k int")
    got = J.variant_match(names, F.array(F.concat("name", F.lit("?")), F.col("name")), master, "name", "m")
    assert [(r["name"], r.k) for r in got.collect()] == [("A", 1)] * 2


@pytest.mark.parametrize("few", [J.FEW_WORDS, 0])
def test_containments(spark, monkeypatch, few):
    monkeypatch.setattr(J, "FEW_WORDS", few)
    texts = spark.createDataFrame([(1, "abcd"), (2, "xa"), (3, None), (4, "bcbc")], "k int, t string")
    words = spark.createDataFrame([("bc",), ("a",), ("abcd",), ("abcde",), ("",), (None,), ("bc",)], "w string")
    got = sorted((r.k, r._word) for r in J.containments(texts, ["k"], "t", words, "w").collect())
    assert got == [(1, "a"), (1, "abcd"), (1, "bc"), (2, "a"), (4, "bc")]
    a = spark.createDataFrame([("폐암",), ("폐암",), ("위암",)], "a string")
    b = spark.createDataFrame([("비소세포폐암",), ("위암",)], "b string")
    got = sorted((r.a, r.b, r.confidence) for r in J.mutual_contains(a, b, "a", "b").collect())
    assert got == [("위암", "위암", 0.95), ("폐암", "비소세포폐암", 0.8), ("폐암", "비소세포폐암", 0.8)]
    files = spark.createDataFrame([("가나-1.pdf",), ("다.pdf",)], "file string")
    names = spark.createDataFrame([("가나", 1), ("가나-1", 2), ("없음", 3)], "name string, seq int")
    assert {r.file: r.seq for r in J.file_catalogue(files, "file", names, "name").collect()} == {"가나-1.pdf": 2, "다.pdf": None}
    assert [r.seq for r in J.missing_files(names, "name", files, "file").collect()] == [3]


def test_classifier_parts(spark):
    pool = spark.createDataFrame([("core", "a", 1, ["x"], []), ("core", "b", 2, ["y", "z"], []), ("core", "c", 3, [], ["q"]), ("core", "d", 4, [], []), ("boundary", "e", 1, ["x"], None), ("fixed", "f", 1, [], []), ("fixed", "g", 2, ["x"], [])], "kind string, example string, seq int, keywords array<string>, cues array<string>")
    t = spark.createDataFrame([("t", "x y z q")], "term string, text string")
    got = sorted((r.kind, r["rank"], r.example, r.score) for r in C.choose_examples(t, pool, "term", "text").collect())
    assert got == [("boundary", 1, "e", 2), ("core", 1, "b", 4), ("core", 2, "c", 3), ("core", 3, "a", 2), ("fixed", 1, "f", 0)]
    rules = spark.createDataFrame([("분자", "유전자", "keyword", 1), ("분자", "투여", "negative", 1)], "category string, keyword string, kind string, priority int")
    terms = spark.createDataFrame([("a", "유전자 유전자 투여 투여"), ("b", "유전자 투여")], "title string, content string")
    assert {r.title: r.score for r in C.keyword_classifier(terms, rules, "title", "content").collect()} == {"a": 1.0}
    c = spark.createDataFrame([(10, 1, True, 500), (0, 0, False, 0)], "t int, p int, n boolean, r int")
    assert [r[0] for r in c.select(C.complexity(F.col("t"), F.col("p"), F.col("n"), F.col("r"))).collect()] == [100.0, 0.0]
    v = spark.createDataFrame([("ab",), ("a",), ("12",), ("no",), (None,)], "c string")
    assert [r[0] for r in v.select(J.valid_name(F.col("c"), ["no"])).collect()] == [True, False, False, False, False]


def test_references_in_order(spark):
    """Same-law and relative references with their law, what 같은 refers back to, and same-law ids with all their parts."""
    laws = spark.createDataFrame([("갑법", "제1조(가)\n① 제3조제2항제1호나목에 따라\n「을법」 제5조의2제3항을 준용하고 같은 법 제7조, 같은 조 제4항 및 같은 항 제9호\n제3조(나)\n본문 같은 법 제1조\n② 둘\n제1005조(다)")], "title string, content string")
    arts = L.articles(laws)
    assert [r.article_number for r in arts.where("depth = 0").orderBy("line_start").collect()] == ["001", "003", "1005"]
    refs = L.references(arts)
    got = sorted((r.span_start, r.kind, r.target_law_name, r.target_article_number, r.target_clause, r.same_unit, r.target_number, r.antecedent_law_name, r.antecedent_article_number, r.antecedent_clause) for r in refs.where("source_id like '%_001'").collect())
    assert [g[1:] for g in got] == [
        ("cross_law", "을법", "005_02", 3, None, None, None, None, None),
        ("relative", "갑법", None, None, "법", 7, "을법", "005_02", 3),
        ("same_law", "갑법", "007", None, None, None, None, None, None),
        ("relative", "갑법", None, None, "조", 4, "을법", "007", None),
        ("relative", "갑법", None, None, "항", 9, "을법", "007", None),
    ]
    meant = [(r.target_law_name, r.target_article_number, r.target_clause) for r in L.meant_targets(refs.where("kind = 'relative'")).orderBy("span_start").collect()]
    assert ("을법", "007", None) in meant and ("을법", "007", 4) in meant and ("갑법", "001", None) in meant
    ids = L.same_law_targets(refs.where("kind = 'same_law'").withColumn("target_law_id", T.law_id(F.col("target_law_name"))), arts)
    law = arts.first().law_id
    assert sorted((r.reference_text, r.target_article_id) for r in ids.collect()) == [("제1조", f"ART_{law}_001"), ("제3조제2항제1호나목", f"ART_{law}_003_C2_S1_I나"), ("제7조", None)]
    assert [r.dst_id for r in L.reference_edges(ids, arts).collect()] == [f"ART_{law}_001"]


def test_law_edges(spark):
    laws = spark.createDataFrame([("의료급여법",), ("의료급여법 시행령",), ("의료급여법시행규칙",), ("상법 시행령",), (None,)], "title string")
    got = sorted((r.dst_id, r.relationship_type) for r in L.derived_from_edges(laws).collect())
    assert got == [("LAW_A267443F", "시행규칙"), ("LAW_A267443F", "시행령")]
    refs = spark.createDataFrame([("s", "t", "일반참조", "x", True, "L"), ("s", "t", "일반참조", "x", True, "L"), ("s", None, "준용", "y", True, "L"), ("s", "u", "준용", "z", False, None)], "source_id string, target_article_id string, reference_type string, reference_text string, is_cross_law boolean, target_law_name string")
    assert sorted((r.dst_id, r.edge_type) for r in L.reference_edges(refs).collect()) == [("t", "CROSS_LAW_REFERS_TO"), ("u", "REFERS_TO")]
    assert {r.is_cross_law: (r.parsed, r.linked, r.unlinked) for r in L.reference_report(refs).collect()} == {True: (3, 2, 1), False: (1, 1, 0)}
    assert [(r.target_law_name, r.n) for r in L.top_targets(refs, 5).collect()] == [("L", 3)]


def test_chunks_of_sections(spark):
    s = spark.createDataFrame([("d", "a", 1, 50), ("d", "b", 51, 170), ("d", "c", 171, 290)], "doc string, section string, start int, end int")
    sub = spark.createDataFrame([("d", "b", "b1", 51), ("d", "b", "b2", 100), ("d", "a", "a1", 1)], "doc string, section string, title string, start int")
    got = sorted((r.chunk_start, r.chunk_end, r.name, r.kind) for r in W.section_chunks(s, sub, "doc", "section").collect())
    assert got == [(1, 50, "a", "section"), (51, 99, "b - b1", "subsection"), (100, 170, "b - b2", "subsection"), (171, 210, "c Part 1", "split"), (211, 250, "c Part 2", "split"), (251, 290, "c Part 3", "split")]


def test_delete_labels(spark):
    n = spark.createDataFrame([("a", "X"), ("b", "Y"), ("c", None)], "id string, label string")
    e = spark.createDataFrame([("a", "b"), ("b", "c")], "src_id string, dst_id string")
    left, edges = G.delete_labels(n, e, ["X"])
    assert {r.id for r in left.collect()} == {"b", "c"} and [(r.src_id, r.dst_id) for r in edges.collect()] == [("b", "c")]
    assert [d.count() for d in G.delete_labels(n, e, None)] == [0, 0]
