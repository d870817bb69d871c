"""Further registered queries: the operators whose input is derived from the driver's tables by a few columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregates as A
from ..operators import curate as C
from ..operators import extract as X
from ..operators import graph as G
from ..operators import joins as J
from ..operators import legal as L
from ..operators import ordering as W
from ..sources import commits, versioned
from ..sources import readers as S
from .catalog import query


def _text(t, *parts):
    """One line of text per part row."""
    return t.part.select(F.col("p_partkey").alias("doc_id"), F.concat(*parts).alias("text"))


@query("s03_envelope", "SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem")
def _(t):
    d = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"))).alias("items")).withColumn("other", F.lit(None).cast("array<struct<k:bigint,n:int>>"))
    return S.envelope(d, "other", "items")


@query("s07_column_like", "SELECT c_custkey, c_acctbal AS found FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.col(S.column_like(t.customer, "acct")).alias("found"))


@query("s08_array_literal", "SELECT p_partkey, array_to_string(string_split(p_name, ' '), '|') AS items, len(string_split(p_name, ' ')) AS n FROM part")
def _(t):
    a = T.array_literal(F.concat(F.lit("['"), F.regexp_replace("p_name", " ", "', '"), F.lit("']")))
    return t.part.select("p_partkey", F.array_join(a, "|").alias("items"), F.size(a).cast("long").alias("n"))


#: Dosage forms that the query puts behind names in turn.
_FORMS = ["주입액", "현탁액", "분말", "과립", "패치", "펜", "키트", "연질", "경질", "서방정", "정"]


@query("n05_brand_and_ingredient", "SELECT p_partkey, replace(p_name, ' ', '-') AS brand, p_type AS ingredient FROM part")
def _(t):
    form = F.element_at(F.array(*map(F.lit, _FORMS)), (F.col("p_partkey") % len(_FORMS) + 1).cast("int"))
    c = F.concat(F.translate("p_name", " ", "-"), form, F.lit("("), F.col("p_type"), F.lit(", x)"))
    return t.part.select("p_partkey", T.brand(c).alias("brand"), T.ingredient_in_parens(c).alias("ingredient"))


@query("n06_brand_spec", "SELECT p_partkey, p_name AS short_name, p_type AS ingredient, CAST(p_size AS VARCHAR) || 'mg' AS spec FROM part")
def _(t):
    c = F.concat("p_name", F.lit("("), F.col("p_type"), F.lit(")_("), F.col("p_size").cast("string"), F.lit("mg)"))
    return t.part.select("p_partkey", F.inline(F.array(T.brand_spec(c))))


@query("n08_brand_variants", "SELECT p_partkey, unnest(['약' || p_brand || '정(' || p_size || ')', '약' || p_brand || '정', '약' || p_brand]) AS variant FROM part")
def _(t):
    c = F.concat(F.lit("약 "), F.col("p_brand"), F.lit("정 ("), F.col("p_size").cast("string"), F.lit(")"))
    return t.part.select("p_partkey", F.explode(T.brand_variants(c)).alias("variant"))


@query("n09_search_keys", "SELECT p_partkey, unnest(['약' || p_partkey || 'mg', '약', p_type]) AS key FROM part")
def _(t):
    c = F.concat(F.lit("약"), F.col("p_partkey").cast("string"), F.lit("mg("), F.col("p_type"), F.lit(")"))
    return t.part.select("p_partkey", F.explode(T.search_keys(c)).alias("key"))


_SALTS_SQL = ["sodium", "tartrate", "potassium", "magnesium", None]


@query("n11_salt_split", "SELECT p_partkey, CASE WHEN p_partkey % 10 >= 5 THEN p_brand ELSE p_type END AS base, CASE p_partkey % 5 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_SALTS_SQL) if s) + " END AS salt FROM part")
def _(t):
    english = F.element_at(F.array(F.lit(" Sodium"), F.lit(" TARTRATE"), F.lit(" potassium"), F.lit(" magnesium"), F.lit("")), (F.col("p_partkey") % 5 + 1).cast("int"))
    korean = F.element_at(F.array(F.lit("나트륨"), F.lit("주석산염"), F.lit("칼륨"), F.lit("마그네슘"), F.lit("")), (F.col("p_partkey") % 5 + 1).cast("int"))
    s = T.salt_split(F.when(F.col("p_partkey") % 10 >= 5, F.concat("p_brand", korean)).otherwise(F.concat("p_type", english)))
    return t.part.select("p_partkey", s["base"].alias("base"), s["salt"].alias("salt"))


@query("n12_antibody", "SELECT p_partkey, p_partkey % 4 < 2 AS recombinant, CASE p_partkey % 3 WHEN 0 THEN 'manual' WHEN 1 THEN 'extracted' ELSE 'atc' END AS source, CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_type ELSE p_name END AS name FROM part")
def _(t):
    k = F.col("p_partkey")
    n = T.name_with_source(F.col("p_name"), F.when(k % 3 == 1, F.col("p_type")).when(k % 3 == 2, F.col("p_name")), F.when(k % 3 == 0, F.col("p_brand")))
    end = F.when(k % 4 == 0, "Mab").when(k % 4 == 1, " pegfilgrastim x").otherwise("x")
    return t.part.select("p_partkey", T.is_antibody(F.concat("p_name", end)).alias("recombinant"), n["source"].alias("source"), n["name"].alias("name"))


@query("n15_class_by_prefix", "SELECT p_partkey, CASE WHEN starts_with(p_type, 'STA') THEN 'standard' ELSE 'rest' END AS class FROM part")
def _(t):
    return t.part.select("p_partkey", F.when(J.any_prefix(F.col("p_type"), ["STA"]), "standard").otherwise("rest").alias("class"))


@query("n16_greek_synonyms", "SELECT p_partkey, unnest(CASE WHEN p_partkey % 3 = 2 THEN [] WHEN p_partkey % 3 = 0 THEN ['alpha-' || p_name, 'alpha' || p_name, '알파-' || p_name, '알파' || p_name] ELSE ['omega-' || p_name || ' 5 μg', 'omega' || p_name || ' 5 μg', '오메가-' || p_name || ' 5 μg', '오메가' || p_name || ' 5 μg'] END) AS name FROM part")
def _(t):
    c = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("α-"), "p_name")).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("ω-"), "p_name", F.lit(" 5 μg"))).otherwise(F.concat("p_name", F.lit(" 5 μg")))
    return t.part.select("p_partkey", F.explode(F.concat(T.greek_synonyms(c), T.greek_synonyms(c, T.GREEK_KO))).alias("name"))


@query("n17_greek_letters", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'β' WHEN 1 THEN 'α,κ' WHEN 2 THEN '' ELSE 'μ' END AS letters FROM part")
def _(t):
    k = F.col("p_partkey") % 4
    c = F.when(k == 0, "β 5 μg ").when(k == 1, "κ-α-κ ").when(k == 2, "5 μmol ").otherwise("μ-x ")
    return t.part.select("p_partkey", F.array_join(T.greek_letters(F.concat(c, "p_name")), ",").alias("letters"))


@query("n18_alias_fold", "SELECT p_partkey, replace(upper(p_name), 'RED', 'R') AS folded FROM part")
def _(t):
    return t.part.select("p_partkey", T.alias_fold(F.col("p_name"), [("RED", "R")]).alias("folded"))


@query("n25_circled", "SELECT p_partkey, CASE WHEN p_size <= 15 THEN p_size END AS n FROM part")
def _(t):
    c = F.when(F.col("p_size") <= 15, F.substring(F.lit(T.CIRCLED), F.col("p_size"), F.lit(1))).otherwise(F.col("p_name"))
    return t.part.select("p_partkey", T.circled(c).alias("n"))


@query("n28_drop_phrases", "SELECT doc_id, trim(regexp_replace(replace(text, 'Licensed', ''), '\\n[\\s\\x{0B}]*\\n+', chr(10), 'g'), ' ') AS cut FROM documents")
def _(t):
    return t.documents.select("doc_id", T.drop_phrases(F.col("text"), ["Licensed"]).alias("cut"))


@query("n31_marker_of_title", "SELECT p_partkey, p_brand AS marker FROM part")
def _(t):
    return t.part.select("p_partkey", T.marker_of_title(F.concat("p_name", F.lit(" ["), F.col("p_brand"), F.lit("]")), ["x"]).alias("marker"))


@query("n32_full_path", "SELECT o_orderkey, '제' || o_orderkey || '조(' || o_orderstatus || ')' || CASE WHEN o_custkey % 2 = 0 THEN ' 제' || (o_custkey % 9) || '항' ELSE '' END || CASE WHEN o_custkey % 3 = 0 THEN ' 제' || (o_custkey % 5) || '호' ELSE '' END AS path FROM orders")
def _(t):
    s = lambda c: c.cast("string")
    k = F.col("o_custkey")
    return t.orders.select("o_orderkey", T.full_path(s(F.col("o_orderkey")), F.col("o_orderstatus"), F.when(k % 2 == 0, s(k % 9)), F.when(k % 3 == 0, s(k % 5))).alias("path"))


@query("n35_scripts", "SELECT doc_id, regexp_matches(text, '[A-Za-z]') AS latin, regexp_matches(text, '[가-힣]') AS hangul FROM (SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN '글' ELSE '' END AS text FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '1 2' ELSE text END AS text FROM documents))")
def _(t):
    base = F.when(F.col("doc_id") % 4 == 0, F.lit("1 2")).otherwise(F.col("text"))
    d = t.documents.select("doc_id", F.concat(base, F.when(F.col("doc_id") % 3 == 0, "글").otherwise("")).alias("text"))
    return d.select("doc_id", T.has_latin(F.col("text")).alias("latin"), T.has_hangul(F.col("text")).alias("hangul"))


@query("x07_headings", "SELECT p_partkey AS doc_id, CAST(p_size AS VARCHAR) AS number, p_brand AS english FROM part")
def _(t):
    d = _text(t, F.lit("앞\n["), F.col("p_size").cast("string"), F.lit("] 위암("), F.col("p_brand"), F.lit(")"))
    return X.numbered_headings(d).select("doc_id", "number", "english")


@query("x08_markdown_rows", "SELECT p_partkey AS doc_id, unnest(['x' || translate(p_brand, '0123456789', ''), p_name]) AS drug, unnest(['', p_type]) AS note FROM part")
def _(t):
    d = _text(t, F.lit("| 항암요법 | 비고 |\n|---|---|\n| x"), F.translate("p_brand", "0123456789", ""), F.lit("1 |\n| "), F.col("p_name"), F.lit(" | "), F.col("p_type"), F.lit(" |\nend"))
    return X.markdown_rows(d, "항암요법").select("doc_id", F.col("cells")["항암요법"].alias("drug"), F.col("cells")["비고"].alias("note"))


@query("x09_restrictions", "SELECT p_partkey AS doc_id, 'bullet' AS kind, p_brand AS category, p_type AS description FROM part")
def _(t):
    return X.restrictions(_text(t, F.lit("▪ "), F.col("p_brand"), F.lit(": "), F.col("p_type"))).select("doc_id", "kind", "category", "description")


@query("x10_questions", "SELECT p_partkey AS doc_id, unnest([p_name, p_type]) AS question, unnest([p_type, p_brand]) AS answer FROM part")
def _(t):
    return X.questions(_text(t, F.lit("Q1. "), F.col("p_name"), F.lit("\nA1. "), F.col("p_type"), F.lit("\nQ2. "), F.col("p_type"), F.lit("\nA2. "), F.col("p_brand"))).select("doc_id", "question", "answer")


@query("x13_section_relations", "SELECT p_partkey AS doc_id, CASE p_size % 3 WHEN 0 THEN '비소세포폐암' WHEN 1 THEN '폐암' END AS cancer, p_brand AS drug, CASE WHEN p_size % 5 > 0 THEN p_size % 5 END AS therapy_line, CASE p_size % 4 WHEN 0 THEN 'add' WHEN 1 THEN 'remove' WHEN 2 THEN 'change' END AS action FROM part WHERE p_size % 3 < 2")
def _(t):
    size = F.col("p_size")
    cancer = F.when(size % 3 == 0, "비소세포폐암").when(size % 3 == 1, "폐암").otherwise("위암")
    line = F.when(size % 5 > 0, F.concat((size % 5).cast("string"), F.lit("차 "))).otherwise("")
    action = F.when(size % 4 == 0, "신설").when(size % 4 == 1, "삭제").when(size % 4 == 2, "변경").otherwise("유지")
    d = _text(t, F.lit("- "), cancer, F.lit("에 ‘"), F.col("p_brand"), F.lit("’ "), line, action)
    return X.section_relations(X.bullet_sections(d), ["폐암", "비소세포폐암"]).select("doc_id", "cancer", F.explode("drugs").alias("drug"), "therapy_line", "action")


def _laws(t):
    """A statute from every document: an article from each of its lines, with the line as its text and a clause that refers, by the line's place, to the next law, the article before, or back to the law after the next."""
    n = F.col("doc_id")
    say = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    s = lambda c: c.cast("string")

    def article(line, i):
        ref = (
            F.when(i % 3 == 0, say("「법", s(n + 1), "」 제", s(i + 1), "조제1항을 준용한다"))
            .when(i % 3 == 1, say("제", s(i), "조제1항에 따라 정한다"))
            .otherwise(say("「법", s(n + 2), "」에서 정하는 것과 같은 법 제", s(i), "조를 말한다"))
        )
        return say("제", s(i + 1), "조(글)\n- ", F.regexp_replace(line, "[제「]", ""), "\n① ", ref)

    content = say("서문\n", F.array_join(F.transform(F.split("text", "\n"), article), "\n"))
    return t.documents.select(say("법", s(n)).alias("title"), content.alias("content"))


_LINES = "SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS line FROM documents"


def _number(n: str) -> str:
    return f"lpad(CAST({n} AS VARCHAR), CAST(greatest(3, length(CAST({n} AS VARCHAR))) AS INT), '0')"


@query("x14_articles", f"WITH x AS ({_LINES}) SELECT '법' || doc_id AS law_name, 0 AS depth, {_number('i + 1')} AS article_number, 3 * i + 1 AS line_start, 3 * i + 3 AS line_end, md5(rtrim('- ' || regexp_replace(line, '[제「]', '', 'g'), ' ')) AS text_md5 FROM x UNION ALL SELECT '법' || doc_id, 1, {_number('i + 1')}, 3 * i + 3, 3 * i + 3, NULL FROM x")
def _(t):
    return L.articles(_laws(t)).select("law_name", "depth", "article_number", "line_start", "line_end", F.when(F.col("depth") == 0, F.md5("full_text")).alias("text_md5"))


def _references(t):
    return L.references(L.articles(_laws(t)))


_REFERENCES = f"WITH x AS ({_LINES}) SELECT doc_id, i, 'cross_law' AS kind, '법' || (doc_id + 1) AS target_law_name, {_number('i + 1')} AS target_article_number, 1 AS target_clause, '준용' AS reference_type, NULL AS same_unit, NULL AS target_number, NULL AS antecedent_law_name FROM x WHERE i % 3 = 0 UNION ALL SELECT doc_id, i, 'same_law', '법' || doc_id, {_number('i')}, CASE WHEN i % 3 = 1 THEN 1 END, CASE WHEN i % 3 = 1 THEN '위임' ELSE '정의' END, NULL, NULL, NULL FROM x WHERE i % 3 > 0 UNION ALL SELECT doc_id, i, 'relative', '법' || doc_id, NULL, NULL, '상대참조', '법', i, '법' || (doc_id + 2) FROM x WHERE i % 3 = 2"


@query("x15_references", f"SELECT kind, target_law_name, target_article_number, target_clause, reference_type, kind = 'cross_law' AS is_cross_law, same_unit, target_number, antecedent_law_name FROM ({_REFERENCES})")
def _(t):
    return _references(t).select("kind", "target_law_name", "target_article_number", "target_clause", "reference_type", "is_cross_law", "same_unit", "target_number", "antecedent_law_name")


@query("x15_meant_targets", f"SELECT '법' || (doc_id + 2) AS target_law_name, {_number('i')} AS target_article_number, count(*) AS n FROM ({_LINES}) WHERE i % 3 = 2 GROUP BY 1, 2")
def _(t):
    return L.meant_targets(_references(t).where("kind = 'relative'")).groupBy("target_law_name", "target_article_number").agg(F.count("*").alias("n"))


def _resolved(t):
    """Cross-law references with the clause or article that they name, same-law ones with theirs."""
    arts = L.articles(_laws(t))
    refs = L.references(arts).withColumn("target_law_id", T.law_id(F.col("target_law_name")))
    cross = J.refine_target(refs.where("is_cross_law"), arts)
    return cross.unionByName(L.same_law_targets(refs.where("kind = 'same_law'"), arts)), arts


_ART = "'ART_LAW_' || upper(substr(md5('법' || {}), 1, 8)) || '_' || {}"
_CROSS = f"SELECT x.doc_id, x.i FROM ({_LINES}) x JOIN ({_LINES}) y ON y.doc_id = x.doc_id + 1 AND y.i = x.i WHERE x.i % 3 = 0"


@query("k11_reference_edges", f"SELECT {_ART.format('doc_id', _number('i + 1'))} || '_C1' AS src_id, {_ART.format('(doc_id + 1)', _number('i + 1'))} || '_C1' AS dst_id, 'CROSS_LAW_REFERS_TO' AS edge_type FROM ({_CROSS}) UNION ALL SELECT {_ART.format('doc_id', _number('i + 1'))} || '_C1', {_ART.format('doc_id', _number('i'))} || CASE WHEN i % 3 = 1 THEN '_C1' ELSE '' END, 'REFERS_TO' FROM ({_LINES}) WHERE i % 3 > 0")
def _(t):
    refs, arts = _resolved(t)
    return L.reference_edges(refs, arts).select("src_id", "dst_id", "edge_type")


@query("q08_reference_report", f"SELECT true AS is_cross_law, count(*) AS parsed, (SELECT count(*) FROM ({_CROSS})) AS linked, count(*) - (SELECT count(*) FROM ({_CROSS})) AS unlinked FROM ({_LINES}) WHERE i % 3 = 0 UNION ALL SELECT false, count(*), count(*), 0 FROM ({_LINES}) WHERE i % 3 > 0")
def _(t):
    return L.reference_report(_resolved(t)[0])


@query("q08_top_targets", f"SELECT '법' || (doc_id + 1) AS target_law_name, count(*) AS n FROM ({_LINES}) WHERE i % 3 = 0 GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20")
def _(t):
    return L.top_targets(_references(t), 20)


@query("k10_derived_from", "SELECT 'LAW_' || upper(substr(md5(c_name || k), 1, 8)) AS src_id, 'LAW_' || upper(substr(md5(c_name), 1, 8)) AS dst_id, trim(k) AS relationship_type FROM (SELECT c_name, CASE c_custkey % 3 WHEN 0 THEN ' 시행령' WHEN 1 THEN '시행규칙' END AS k, c_custkey FROM customer) WHERE k IS NOT NULL AND c_custkey % 5 <> 0")
def _(t):
    k = F.col("c_custkey")
    child = t.customer.select(F.concat("c_name", F.when(k % 3 == 0, " 시행령").when(k % 3 == 1, "시행규칙")).alias("title"))
    parent = t.customer.where("c_custkey % 5 <> 0").select(F.col("c_name").alias("title"))
    return L.derived_from_edges(child.unionByName(parent)).select("src_id", "dst_id", "relationship_type")


@query("x19_code_pairs", "SELECT p_partkey AS page_id, 0 AS table_index, '가' || p_size AS korean_code, p_brand AS english_code FROM part WHERE p_partkey % 3 <> 0")
def _(t):
    td = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    first = F.concat(F.when(F.col("p_partkey") % 3 != 0, "가").otherwise(""), F.col("p_size").cast("string"))
    h = t.part.select(F.col("p_partkey").alias("page_id"), F.concat(F.lit("<table><tr>"), td(first), td(F.col("p_brand")), F.lit("</tr><tr><td>x</td></tr></table>")).alias("html"))
    return X.code_pairs(X.page_parts(h), "^[가-힣]", "^[A-Z]").select("page_id", "table_index", "korean_code", "english_code")


@query("x21_element_names", "SELECT text AS name, string_agg(DISTINCT CAST(conv_id AS VARCHAR), ',' ORDER BY CAST(conv_id AS VARCHAR)) AS sources FROM conversations WHERE role = 'user' GROUP BY 1")
def _(t):
    e = t.conversations.groupBy(F.col("conv_id").cast("string").alias("conv_id")).agg(F.collect_list(F.struct(F.col("role").alias("category"), "text")).alias("elements"))
    return X.element_names(e, "user", "conv_id").select("name", F.array_join("sources", ",").alias("sources"))


@query("x23_outline", "SELECT p_partkey AS doc_id, p_name AS item, p_brand || '/' || p_type AS path FROM part")
def _(t):
    return X.outline(_text(t, F.lit("## "), F.col("p_brand"), F.lit("\n### "), F.col("p_type"), F.lit("\n* "), F.col("p_name"))).select("doc_id", "item", F.array_join("path", "/").alias("path"))


@query("x24_contents", "SELECT p_partkey AS doc_id, unnest(['a', 'b']) AS title, unnest([p_size, p_size + 7]) AS page, unnest([p_size + 6, 999]) AS end_page FROM part")
def _(t):
    d = _text(t, F.lit("a ..... "), F.col("p_size").cast("string"), F.lit("\nb ..... "), (F.col("p_size") + 7).cast("string"))
    return X.contents(d, last_page=F.lit(999))


@query("x25_record_rows", "SELECT p_partkey, p_brand AS name, p_type AS kind FROM part")
def _(t):
    rows = F.array(F.array(F.lit("name"), F.lit("kind")), F.array("p_brand", "p_type"))
    return X.record_rows(t.part.select("p_partkey", rows.alias("rows"))).select("p_partkey", F.col("cells")["name"].alias("name"), F.col("cells")["kind"].alias("kind"))


@query("x28_record_map", "SELECT p_partkey AS page_id, p_name AS name, p_brand AS brand FROM part")
def _(t):
    row = lambda k, c: F.concat(F.lit(f"<tr><th>{k}</th><td>"), c, F.lit("</td></tr>"))
    h = t.part.select(F.col("p_partkey").alias("page_id"), F.concat(F.lit("<table>"), row("name", F.col("p_name")), row("brand", F.col("p_brand")), row("name", F.lit("again")), F.lit("</table>")).alias("html"))
    return X.record_map(X.page_parts(h)).select("page_id", F.col("fields")["name"].alias("name"), F.col("fields")["brand"].alias("brand"))


@query("p04_leaf_only", "SELECT p_partkey FROM part WHERE NOT p_size > 40 AND p_size % 2 = 0")
def _(t):
    return t.part.where(J.leaf_only(F.col("p_size") > 40, F.col("p_size") % 2 == 0)).select("p_partkey")


@query("p06_unlisted", "SELECT o_orderkey FROM orders WHERE length(o_orderpriority) >= 6 AND o_orderpriority <> '1-URGENT'")
def _(t):
    return J.unlisted(t.orders, "o_orderpriority", t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderpriority").alias("w")), "w", 6).select("o_orderkey")


@query("p11_all_keywords", "SELECT doc_id FROM documents WHERE contains(text, 'the') AND contains(text, 'was')")
def _(t):
    return t.documents.where(J.all_keywords(F.col("text"), ["the", "was"])).select("doc_id")


@query("j13_refine_target", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 2 THEN 'c' || l_linenumber WHEN l_orderkey % 2 = 0 THEN 'a' || l_orderkey END AS target FROM lineitem WHERE l_orderkey % 2 = 0 UNION ALL SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 2 THEN 'c' || l_linenumber END FROM lineitem WHERE l_orderkey % 2 = 1")
def _(t):
    s = lambda c: F.col(c).cast("string")
    top = t.orders.where("o_orderkey % 2 = 0").select(F.lit("L").alias("law_id"), s("o_orderkey").alias("article_number"), F.lit(0).alias("depth"), F.lit(None).cast("int").alias("clause_number"), F.concat(F.lit("a"), s("o_orderkey")).alias("article_id"))
    kid = t.lineitem.where("l_linenumber <= 2").select(F.lit("L").alias("law_id"), s("l_orderkey").alias("article_number"), F.lit(1).alias("depth"), F.col("l_linenumber").alias("clause_number"), F.concat(F.lit("c"), s("l_linenumber")).alias("article_id")).distinct()
    refs = t.lineitem.select("l_orderkey", "l_linenumber", F.lit("L").alias("target_law_id"), s("l_orderkey").alias("target_article_number"), F.col("l_linenumber").alias("target_clause"))
    return J.refine_target(refs, top.unionByName(kid)).select("l_orderkey", "l_linenumber", F.col("target_article_id").alias("target"))


@query("a02_products_by_key", "SELECT p_type, count(DISTINCT p_name) AS p_name_count, string_agg(DISTINCT p_name, '|' ORDER BY p_name) AS names FROM part GROUP BY 1")
def _(t):
    return A.group_lists(t.part, ["p_type"], "p_partkey", [], ["p_name"]).select("p_type", F.col("p_name_count").cast("long").alias("p_name_count"), F.array_join("p_name_list", "|").alias("names"))


@query("a10_bidirectional_aliases", "WITH b AS (SELECT p_type AS a, p_brand AS b, 0 AS p FROM part WHERE p_size > 45 UNION ALL SELECT p_type, p_brand, 1 FROM part), f AS (SELECT a, arg_min(b, (p, b)) AS b FROM b GROUP BY 1) SELECT f.a AS p_type, f.b AS p_brand, l.all_a AS all_types FROM f JOIN (SELECT b, string_agg(DISTINCT a, '|' ORDER BY a) AS all_a FROM b GROUP BY 1) l USING (b)")
def _(t):
    out = A.bidirectional_aliases(t.part.where("p_size > 45"), t.part, "p_type", "p_brand")
    return out.select("p_type", "p_brand", F.array_join("all_p_type", "|").alias("all_types"))


@query("a12_code_sets", "SELECT p_brand, count(*) AS total, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS types FROM part GROUP BY 1")
def _(t):
    return A.code_sets(t.part, "p_brand", ["p_type"]).select("p_brand", "total", F.array_join("p_types", "|").alias("types"))


@query("a18_by_path", "SELECT source || '/' || lang AS path, count(*) AS documents, string_agg(doc_id || ':' || n_chars, ',' ORDER BY doc_id, n_chars) AS listed FROM documents GROUP BY 1")
def _(t):
    d = A.by_path(t.documents.withColumn("path", F.array("source", "lang")), "path", "doc_id", "n_chars")
    one = lambda x: F.concat_ws(":", x["doc_id"].cast("string"), x["n_chars"].cast("string"))
    return d.select(F.array_join("path", "/").alias("path"), F.col("document_count").alias("documents"), F.array_join(F.transform("documents", one), ",").alias("listed"))


@query("a26_distribution", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n, min(p_retailprice) AS least, round(avg(p_retailprice), 6) AS mean, max(p_retailprice) AS most FROM part GROUP BY 2" for c in ("p_brand", "p_type", "p_size")))
def _(t):
    return A.value_distribution(t.part, ["p_brand", "p_type", "p_size"], "p_retailprice").withColumn("mean", F.round("mean", 6))


@query("a22_reason_counts", "SELECT reason, count(*) AS n FROM (SELECT unnest([o_orderstatus, o_orderpriority]) AS reason FROM orders) GROUP BY 1 ORDER BY n DESC, reason LIMIT 5")
def _(t):
    return A.reason_counts(t.orders.select(F.array("o_orderstatus", "o_orderpriority").alias("r")), "r", 5)


@query("a24_array_totals", "SELECT sum(len(embedding)) AS embedding FROM embeddings")
def _(t):
    return A.array_totals(t.embeddings, ["embedding"])


@query("w01_keep_first", "SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1")
def _(t):
    return W.first_by(t.lineitem, ["l_orderkey"], [F.col("l_linenumber")]).select("l_orderkey", "l_linenumber")


@query("w05_samples", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders) WHERE k <= 2")
def _(t):
    return W.samples(t.orders, ["o_custkey"], [F.col("o_orderkey")], 2, ["o_orderkey"]).select("o_custkey", F.inline("samples"))


_SEGMENTS = "SELECT l_orderkey AS doc, row_number() OVER o AS page, l_returnflag AS head, CASE WHEN l_quantity > 40 THEN 20 ELSE 0 END AS x0, l_linestatus = 'O' AS has FROM lineitem WINDOW o AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)"
_STITCHED = f"SELECT *, coalesce(abs(x0 - lag(x0) OVER w) <= 5 AND (NOT (has AND lag(has) OVER w) OR head = lag(head) OVER w), false) AS goes_on, has AND lag(has) OVER w AS both_have FROM ({_SEGMENTS}) WINDOW w AS (PARTITION BY doc ORDER BY page)"


@query("w09_stitch_tables", f"SELECT doc, min(page) AS first_page, max(page) AS last_page, CAST(sum(CASE WHEN goes_on AND both_have THEN 1 ELSE 2 END) AS BIGINT) AS rows FROM (SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY page) AS k FROM ({_STITCHED})) GROUP BY doc, k")
def _(t):
    page = F.row_number().over(W.Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    left = F.when(F.col("l_quantity") > 40, 20.0).otherwise(0.0)
    box = F.struct(left.alias("x0"), F.lit(0.0).alias("top"), (left + 100.0).alias("x1"), F.lit(9.0).alias("bottom"))
    seg = t.lineitem.select(F.col("l_orderkey").alias("doc"), page.alias("page_num"), F.lit(0).alias("table_idx"), box.alias("bbox"), F.array(F.array("l_returnflag"), F.array(F.col("l_partkey").cast("string"))).alias("rows"), (F.col("l_linestatus") == "O").alias("has_header"))
    return W.stitch_tables(seg).select("doc", F.col("first_page").cast("long").alias("first_page"), F.col("last_page").cast("long").alias("last_page"), F.size("rows").cast("long").alias("rows"))


@query("g01_global_order", "SELECT c_custkey, row_number() OVER (ORDER BY c_name DESC, c_custkey) AS place FROM customer")
def _(t):
    ordered = W.number(t.customer.select("c_custkey", "c_name").withColumn("_down", F.transform(F.split("c_name", ""), lambda ch: -F.ascii(ch))), "", ["_down", "c_custkey"], "place", 1)
    return ordered.select("c_custkey", F.col("place").cast("long").alias("place"))


@query("u04_concat_collections", "SELECT c_custkey AS k, c_name AS name, CAST(NULL AS VARCHAR) AS brand FROM customer UNION ALL SELECT p_partkey, p_name, p_brand FROM part")
def _(t):
    return W.concat_collections(t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), t.part.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand")))


@query("k12_delete_labels", "SELECT 'node' AS kind, o_orderkey AS a, NULL AS b FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT 'edge', a.o_orderkey, b.o_orderkey FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1 WHERE a.o_orderstatus <> 'F' AND b.o_orderstatus <> 'F'")
def _(t):
    nodes = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("label"))
    e = t.orders.select(F.col("o_orderkey").alias("src_id"), (F.col("o_orderkey") + 1).alias("dst_id"))
    n, left = G.delete_labels(nodes, e, ["F"])
    return n.select(F.lit("node").alias("kind"), F.col("id").alias("a"), F.lit(None).cast("long").alias("b")).unionByName(left.select(F.lit("edge").alias("kind"), F.col("src_id").alias("a"), F.col("dst_id").alias("b")))


@query("u06_extend_dictionary", "SELECT p_brand AS key, false AS is_normalized FROM part UNION ALL SELECT DISTINCT p_type, true FROM part")
def _(t):
    return W.extend_dictionary(t.part.select(F.col("p_brand").alias("key")), t.part.select(F.col("p_type").alias("key"), F.col("p_brand").alias("normalized_from"))).select("key", "is_normalized")


@query("c04_whitelist_tokens", "SELECT p_name AS token FROM part UNION SELECT w FROM (SELECT unnest(string_split(p_name, ' ')) AS w, p_name FROM part WHERE contains(p_name, ' ')) WHERE length(w) >= 3")
def _(t):
    return C.whitelist_tokens(t.part, "p_name")


@query("c08_has_header", "SELECT p_partkey, p_size % 4 > 0 AND (CAST(p_size > 20 AS INT) + CAST(p_partkey % 2 = 0 AS INT)) = 0 AS header FROM part")
def _(t):
    """Tables of one to four rows, whose first row has a number by size, one by key, and two words."""
    cell = lambda number, word: F.when(number, F.col("p_size").cast("string")).otherwise(F.col(word))
    first = F.array(cell(F.col("p_size") > 20, "p_name"), cell(F.col("p_partkey") % 2 == 0, "p_brand"), F.col("p_type"))
    rest = F.array_repeat(F.array("p_name", "p_brand", "p_type"), (F.col("p_size") % 4).cast("int"))
    return t.part.select("p_partkey", C.has_header(F.concat(F.array(first), rest)).alias("header"))


@query("c10_derive_keywords", "SELECT p_partkey, unnest(CASE WHEN contains(p_name, 'red') THEN ['r', 'rot'] ELSE string_split(p_name, ' ') END) AS word FROM part")
def _(t):
    return t.part.select("p_partkey", F.explode(C.derive_keywords(F.col("p_name"), {"red": ["r", "rot"]}, [])).alias("word"))


@query("c11_acceptance", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'missing' WHEN o_orderstatus = 'F' THEN 'pass' ELSE 'fail' END AS status FROM orders")
def _(t):
    e = t.orders.select("o_orderkey", F.lit("F").alias("decision"))
    return C.acceptance(e, t.orders.where("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_orderstatus").alias("decision")), ["o_orderkey"]).select("o_orderkey", "status")


@query("c13_canonical", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def _(t):
    return C.canonical(t.orders, t.spark.createDataFrame([("F", "finished")], "alias string, canonical string"), "o_orderstatus").select("o_orderkey", "o_orderstatus")


@query("k05_prefix_edges", "SELECT DISTINCT n_nationkey AS src_id, CAST(p_size AS VARCHAR) || '.' || p_brand AS dst_id FROM nation JOIN part ON p_size = n_nationkey")
def _(t):
    master = t.part.select(F.concat_ws(".", F.col("p_size").cast("string"), "p_brand").alias("code")).distinct()
    return G.prefix_edges(t.nation.withColumn("codes", F.array(F.col("n_nationkey").cast("string"))), "n_nationkey", "codes", master, "code")


@query("k08_code_hierarchy", "WITH c AS (SELECT DISTINCT 'C' || lpad(CAST(p_size AS VARCHAR), 2, '0') || CASE WHEN p_partkey % 3 = 0 THEN '.' || (p_partkey % 10) ELSE '' END AS code FROM part) SELECT code AS src_id, CASE WHEN CAST(substr(code, 2) AS INT) < 30 THEN 'C00-C29' ELSE 'C30-C99' END AS dst_id FROM c WHERE NOT contains(code, '.') UNION ALL SELECT code, split_part(code, '.', 1) FROM c WHERE contains(code, '.') AND split_part(code, '.', 1) IN (SELECT code FROM c)".replace("CAST(substr(code, 2) AS INT)", "TRY_CAST(substr(code, 2) AS INT)"))
def _(t):
    tail = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("."), (F.col("p_partkey") % 10).cast("string"))).otherwise("")
    codes = t.part.select(F.concat(F.lit("C"), F.lpad(F.col("p_size").cast("string"), 2, "0"), tail).alias("code")).distinct()
    blocks = t.spark.createDataFrame([("C00-C29", "C", 0, 29), ("C30-C99", "C", 30, 99)], "code string, chapter string, lo int, hi int")
    return G.code_hierarchy(codes, blocks)


@query("k09_tree_edges", f"SELECT '법' || doc_id AS law_name, count(*) AS children, count(*) AS articles FROM ({_LINES}) GROUP BY doc_id")
def _(t):
    a, c = L.tree_edges(L.articles(_laws(t)))
    kids = c.groupBy("law_name").agg(F.count("*").alias("children"))
    tops = a.groupBy("law_name").agg(F.count("*").alias("articles"))
    return kids.join(tops, "law_name").select("law_name", "children", "articles")


@query("k13_mapping_edges", "SELECT s_suppkey AS src_id, s_name AS dst_id, 'MAPS_TO_NAME' AS edge_type FROM supplier")
def _(t):
    return G.mapping_edges(t.supplier, "s_suppkey", {"MAPS_TO_NAME": "s_name"})


@query("q01_lookup", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal IS NOT NULL ORDER BY c_acctbal DESC, c_custkey LIMIT 15")
def _(t):
    return G.lookup(t.customer, {"c_mktsegment": "BUILDING"}, ["c_acctbal"], [F.desc("c_acctbal"), F.col("c_custkey")], 15).select("c_custkey", "c_name")


@query("q05_chains", "SELECT a.n_regionkey AS n0, a.n_nationkey AS n1, b.c_custkey AS n2 FROM nation a JOIN customer b ON a.n_nationkey = b.c_nationkey")
def _(t):
    tag = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    e = t.nation.select(tag("r", "n_regionkey").alias("src_id"), tag("n", "n_nationkey").alias("dst_id")).unionByName(t.customer.select(tag("n", "c_nationkey").alias("src_id"), tag("c", "c_custkey").alias("dst_id")))
    n = lambda i: F.substring(F.col("nodes")[i], 2, 20).cast("long")
    return G.chains(e, 2, 2).select(n(0).alias("n0"), n(1).alias("n1"), n(2).alias("n2"))


@query("q14_template", "SELECT 'placed' AS edge_type, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS name FROM orders WHERE o_custkey = 7")
def _(t):
    s = lambda c: F.col(c).cast("string")
    nodes = t.orders.select(s("o_orderkey").alias("id"), F.lit("order").alias("label"), F.col("o_orderstatus").alias("name"))
    return G.ask(t.spark, "neighbours", nodes, t.orders.select(F.concat(F.lit("c"), s("o_custkey")).alias("src_id"), s("o_orderkey").alias("dst_id"), F.lit("placed").alias("edge_type")), id="c7")


# --- stored tables ----------------------------------------------------------------------------------


@query("k01_versioned_upsert", "SELECT coalesce(a.k, b.k) AS k, coalesce(a.name, b.name) AS name, coalesce(a.bal, b.bal) AS bal FROM (SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS bal FROM customer) a FULL JOIN (SELECT s_suppkey * 40 AS k, s_name AS name, s_acctbal AS bal FROM supplier) b ON a.k = b.k")
def _(t):
    """Customers as the first version of a table, suppliers upserted into its touched buckets."""
    at = W.shared_folder(t.spark)
    versioned.create(t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_acctbal")).alias("bal")), at, "k")
    versioned.change(t.spark, at, t.supplier.select((F.col("s_suppkey") * 40).alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal")))
    return versioned.read(t.spark, at)


@query("k12_versioned_delete", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'")
def _(t):
    """Orders without one status, as the next version of their table."""
    at = W.shared_folder(t.spark)
    versioned.create(t.orders.select("o_orderkey", "o_orderstatus"), at, "o_orderkey")
    versioned.delete(t.spark, at, F.col("o_orderstatus") == "F")
    return versioned.read(t.spark, at)


@query("s13_append_once", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    """Events appended by kind, every batch tried twice."""
    at = W.shared_folder(t.spark)
    for kind in (True, False):
        for _ in range(2):
            commits.append_once(t.events.where((F.col("user_id") % 2 == 0) == kind).select("event_type", "value"), at, f"even-{kind}")
    return commits.read(t.spark, at, "event_type string, value double").groupBy("event_type").agg(F.count("*").alias("n"))
