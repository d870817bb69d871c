"""Every registered query with a SQL twin gives the twin's rows; the others run and keep their schema."""

import os
import re

import duckdb
import pytest

import __spark_entry__
from medgraph.plans import catalog, more  # noqa: F401  (more adds to the catalogue)

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if v is None or isinstance(v, (int, str)):
        return v
    return float(v) if type(v).__name__ == "Decimal" else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for n in TABLES:
        c.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{SF}/{n}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in catalog.ORACLES:
        assert got
        return
    found = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in found.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in found.fetchall()), key=repr)
    assert sorted(names) == cols
    assert got == want


def test_drop_phrases_of_all_documents(spark, tmp_path):
    more = [(-1, "Licensed a\n \n\t\nb\r\n\nc  "), (-2, " Licensed "), (-3, None), (-4, "\n\n\nLicensed\n\nx")]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = docs.collect()
    cut = lambda t: None if t is None else re.sub(r"\n\s*\n+", "\n", t.replace("Licensed", ""), flags=re.ASCII).strip(" ")
    want = sorted(((r.doc_id, cut(r.text)) for r in rows), key=repr)
    got = sorted(((r.doc_id, r.cut) for r in catalog.QUERIES["n28_drop_phrases"](spark, str(tmp_path)).collect()), key=repr)
    assert got == want and len(got) == len(rows)


def test_gate_chain_reasons(spark):
    """The registered chain meets its curated pairs, brands, suffix rules, promotion and every drop and route."""
    seen = {c for r in catalog.QUERIES["c01_gate_chain"](spark, SF).collect() for c in r.reasons.split(",")}
    assert {"PASS_ALL", "CURATED_WHITELIST", "BRAND_RESOLVED_EN", "FORM_TERM", "CONTEXT_PACKAGING", "ROUTE_REGIMEN", "ROUTE_BIOMARKER", "ROUTE_DISEASE", "SUFFIX_MISMATCH", "PHONETIC_FAIL", "CTX_PROMOTE"} <= seen


def test_normal_texts_and_similarity(spark):
    import unicodedata
    from difflib import SequenceMatcher

    from medgraph.functions import text as T

    d = spark.read.parquet(f"{SF}/documents.parquet").select("text").distinct()
    fold = str.maketrans(T.FOLD_FROM, T.FOLD_TO)
    want = {" ".join(unicodedata.normalize("NFKC", r.text).translate(fold).split()) for r in d.collect()}
    got = {" ".join(r.normal.split()) for r in catalog.QUERIES["n01_normalize_text"](spark, SF).collect()}
    assert got == want
    for r in catalog.QUERIES["n04_similarity"](spark, SF).collect():
        assert r.score == round(SequenceMatcher(None, r.a, r.b).ratio(), 9)


def test_spans_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, k, m[0], m.start(), m.end()) for r in docs for k, p in (("ing", r"\b\w+ing\b"), ("tion", r"\b\w+tion\b")) for m in re.finditer(p, r.text or ""))
    got = sorted((r.doc_id, r.name, r.surface, r.span_start, r.span_end) for r in catalog.QUERIES["x01_spans"](spark, SF).collect())
    assert got == want and got


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
