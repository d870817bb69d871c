"""Registered queries: every operator on the driver's tables, with its SQL twin where SQL can say it.

QUERIES[name] takes (spark, sf_dir); ORACLES[name] is the same in plain SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregates as A
from ..operators import curate as C
from ..operators import extract as X
from ..operators import graph as G
from ..operators import joins as J
from ..operators import ordering as W
from ..sources import readers as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver's tables by name, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return add


# --- scans and catalogues -------------------------------------------------------------------------


@query("s06_code_master", "SELECT p_partkey AS code, p_name AS name, CAST(p_size % 2 AS BOOLEAN) AS is_leaf FROM part")
def _(t):
    return S.code_master(t.part.select("p_partkey", "p_name", F.col("p_size") % 2), ["code", "name", "is_leaf"], ["is_leaf"])


@query("s04_keyed_dictionary", "SELECT CAST(event_id AS VARCHAR) AS key, value AS amount, event_type AS kind FROM events")
def _(t):
    v = F.to_json(F.map_from_arrays(F.array(F.col("event_id").cast("string")), F.array(F.struct(F.array(F.struct(F.col("value").alias("amount"), F.col("event_type").alias("kind"))).alias("records")))))
    return S.keyed_dictionary(t.events.select(v.alias("v")), "v", "amount: double, kind: string").select("key", "amount", "kind")


_TOKEN = "CASE user_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN ' None ' WHEN 3 THEN user_id || '.0' WHEN 4 THEN ' NaN' ELSE event_type END"


@query("s12_null_tokens", f"SELECT event_id, CASE WHEN trim(x) IN ('', 'nan', 'None', 'NaN') THEN NULL WHEN regexp_full_match(trim(x), '[0-9]+\\.0') THEN replace(trim(x), '.0', '') ELSE trim(x) END AS token FROM (SELECT event_id, {_TOKEN} AS x FROM events)")
def _(t):
    return t.events.select("event_id", T.null_tokens(F.expr(_TOKEN)).alias("token"))


@query("s14_keep_first", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def _(t):
    return W.first_by(t.events, ["user_id"], [F.col("event_id")]).select("user_id", "event_id")


@query("s15_new_keys", "SELECT count(DISTINCT user_id) AS n FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'click')")
def _(t):
    from ..streaming.ingest import new_rows

    return new_rows(t.events, t.events.where("event_type = 'click'").select("user_id").distinct(), "user_id").agg(F.count("*").alias("n"))


@query("s16_latest_snapshot", "SELECT event_id, user_id FROM events WHERE event_id = (SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)")
def _(t):
    return S.latest_snapshot(t.events, "ts", "event_id").select("event_id", "user_id")


@query("s18_profile", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS rows FROM {n}" for n in ("documents", "part", "orders", "lineitem")))
def _(t):
    return S.profile({n: getattr(t, n) for n in ("documents", "part", "orders", "lineitem")}).drop("columns")


@query("s19_null_census", "SELECT 'doc_id' AS \"column\", count(*) - count(doc_id) AS nulls FROM documents UNION ALL SELECT 'text', count(*) - count(text) FROM documents UNION ALL SELECT 'lang', count(*) - count(lang) FROM documents")
def _(t):
    return S.null_census(t.documents.select("doc_id", "text", "lang"))


@query("s20_lookup_map", "SELECT 'n_name_to_n_nationkey' AS type, n_name AS key, CAST(n_nationkey AS VARCHAR) AS value FROM nation UNION ALL SELECT 'n_nationkey_to_n_name', CAST(n_nationkey AS VARCHAR), n_name FROM nation")
def _(t):
    return S.lookup_map(t.nation, "n_name", "n_nationkey", ["n_nationkey"])


# --- scalars ----------------------------------------------------------------------------------------


@query("n01_normalize_text")
def _(t):
    d = t.documents.select("text").distinct()
    return d.select(F.xxhash64("text").alias("h"), T.normalize_text(F.col("text")).alias("normal"))


@query("n02_case_by_language", "SELECT doc_id, CASE WHEN lang = 'en' THEN lower(text) ELSE text END AS folded FROM documents")
def _(t):
    return t.documents.select("doc_id", T.normalize_case(F.col("text"), F.col("lang")).alias("folded"))


#: A few syllables and their spelling, for texts made from names.
_SYLLABLES = [("목", "mog"), ("한", "han"), ("글", "geul"), ("값", "gabs"), ("의", "ui"), ("쪽", "jjog"), ("위", "wi"), ("닭", "dalg"), ("하", "ha"), ("앉", "anj")]


@query("n03_romanize", "SELECT c_custkey, CASE c_custkey % 10 " + " ".join(f"WHEN {i} THEN '{b}'" for i, (_, b) in enumerate(_SYLLABLES)) + " END || CASE (c_custkey // 10) % 10 " + " ".join(f"WHEN {i} THEN '{b}'" for i, (_, b) in enumerate(_SYLLABLES)) + " END || '-' || c_name AS spelt FROM customer")
def _(t):
    pick = lambda n: F.element_at(F.array(*[F.lit(a) for a, _ in _SYLLABLES]), (n % 10 + 1).cast("int"))
    k = F.col("c_custkey")
    return t.customer.select("c_custkey", T.romanize(F.concat(pick(k), pick(F.floor(k / 10)), F.lit("-"), "c_name")).alias("spelt"))


@query("n04_similarity")
def _(t):
    p = t.part.select(F.substring_index("p_name", " ", 1).alias("a"), F.substring_index("p_name", " ", -1).alias("b")).distinct()
    return p.withColumn("score", F.round(T.similarity("a", "b"), 9))


@query("n07_squeeze", "SELECT p_partkey, replace(p_name, ' ', '') AS squeezed FROM part")
def _(t):
    return t.part.select("p_partkey", T.squeeze(F.col("p_name")).alias("squeezed"))


@query("n10_normalize_key", "SELECT p_partkey, regexp_replace(regexp_replace(lower(p_type || ' ' || p_brand), '[\\s\\-_/,.()#]+', '', 'g'), '[^a-z0-9_]+', '', 'g') AS key FROM part")
def _(t):
    return t.part.select("p_partkey", T.normalize_key(F.concat_ws(" ", "p_type", "p_brand")).alias("key"))


@query("n13_code_levels", "SELECT p_partkey, substr(p_brand, 1, 3) AS level1, substr(p_brand, 1, 4) AS level2, substr(p_brand, 1, 5) AS level3 FROM part WHERE length(p_brand) >= 5")
def _(t):
    return t.part.where("length(p_brand) >= 5").select("p_partkey", F.inline(F.array(T.atc_levels(F.col("p_brand")))))


@query("n19_plain_name", "SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name), '\\([^)]*\\)', '', 'g'), '\\s+', ' ', 'g')) AS plain FROM part")
def _(t):
    return t.part.select("p_partkey", T.plain_name(F.col("p_name")).alias("plain"))


@query("n20_code_parse", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'category' WHEN 1 THEN 'detailed' WHEN 2 THEN 'range' ELSE 'chapter' END AS kind, chr(CAST(65 + p_size % 26 AS INT)) AS chapter, CASE WHEN p_partkey % 4 < 3 THEN p_size + 10 END AS number, CASE WHEN p_partkey % 4 = 2 THEN p_size + 15 END AS end_number FROM part")
def _(t):
    ch, n = F.char(65 + F.col("p_size") % 26), (F.col("p_size") + 10).cast("string")
    k = F.col("p_partkey") % 4
    code = F.when(k == 0, F.concat(ch, n)).when(k == 1, F.concat(ch, n, F.lit(".1"))).when(k == 2, F.concat(ch, n, F.lit("-"), ch, (F.col("p_size") + 15).cast("string"))).otherwise(ch)
    return t.part.select("p_partkey", F.inline(F.array(T.disease_code(code))))


_CODES = "CASE WHEN p_partkey % 5 = 4 THEN 'C' || (p_size + 10) || '-D20' ELSE CASE WHEN p_partkey % 5 < 3 THEN 'D' WHEN p_partkey % 5 = 3 THEN 'C' END || (p_size + 10) || CASE WHEN p_partkey % 2 = 0 THEN '.1' ELSE '' END END"


def _code(t):
    n, k = (F.col("p_size") + 10).cast("string"), F.col("p_partkey")
    single = F.concat(F.when(k % 5 < 3, "D").when(k % 5 == 3, "C"), n, F.when(k % 2 == 0, ".1").otherwise(""))
    return t.part.select("p_partkey", F.when(k % 5 == 4, F.concat(F.lit("C"), n, F.lit("-D20"))).otherwise(single).alias("code"))


@query("n21_cancer_codes", f"SELECT p_partkey, NOT contains(code, '-') AND (starts_with(code, 'C') OR CAST(substr(code, 2, 2) AS INT) <= 48) AS strict FROM (SELECT p_partkey, {_CODES} AS code FROM part)")
def _(t):
    return _code(t).select("p_partkey", T.is_cancer_strict(F.col("code")).alias("strict"))


@query("n22_cancer_codes_lenient", f"SELECT p_partkey, contains(code, '-') OR starts_with(code, 'C') OR CAST(substr(code, 2, 2) AS INT) <= 48 AS lenient FROM (SELECT p_partkey, {_CODES} AS code FROM part)")
def _(t):
    return _code(t).select("p_partkey", T.is_cancer_lenient(F.col("code")).alias("lenient"))


@query("n23_article_number", "SELECT o_orderkey, lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || CASE WHEN o_custkey % 3 > 0 THEN '_' || lpad(CAST(o_custkey % 3 AS VARCHAR), 2, '0') ELSE '' END AS number FROM orders")
def _(t):
    n, b = (F.col("o_orderkey") % 1000).cast("string"), (F.col("o_custkey") % 3).cast("string")
    return t.orders.select("o_orderkey", T.article_number(F.concat(F.lit("제"), n, F.lit("조"), F.when(b != "0", F.concat(F.lit("의"), b)).otherwise(""))).alias("number"))


@query("n24_law_id", "SELECT c_custkey, 'LAW_' || upper(substr(md5(c_name), 1, 8)) AS law_id FROM customer")
def _(t):
    return t.customer.select("c_custkey", T.law_id(F.col("c_name")).alias("law_id"))


@query("n26_number_cell", "SELECT event_id, value AS number FROM events")
def _(t):
    return t.events.select("event_id", T.number_cell(F.col("value").cast("string")).alias("number"))


@query("n27_strip_html", "SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&[A-Za-z#0-9]+;', ' ', 'g'), '[\\s\\x{00A0}\\x{0085}\\x{2028}]+', ' ', 'g')) AS plain FROM pages")
def _(t):
    return t.pages.select("page_id", T.strip_html(F.col("html")).alias("plain"))


@query("n29_context", "SELECT doc_id, replace(substr(text, greatest(pos - 20, 0) + 1, pos + 5 + 20 - greatest(pos - 20, 0)), chr(10), ' ') AS around FROM (SELECT doc_id, text, CASE WHEN instr(text, ' the ') > 0 THEN instr(text, ' the ') - 1 ELSE CAST(length(text) // 2 AS BIGINT) END AS pos FROM documents)")
def _(t):
    found = F.instr("text", " the ")
    at = F.when(found > 0, found - 1).otherwise(F.floor(F.length("text") / 2).cast("int"))
    return t.documents.select("doc_id", T.context(F.col("text"), at, at + 5, 20).alias("around"))


@query("n30_first_label", "SELECT doc_id, CASE WHEN text LIKE '%Licensed%' THEN 'license' WHEN text LIKE '%http%' THEN 'link' ELSE 'prose' END AS label FROM documents")
def _(t):
    return t.documents.select("doc_id", T.first_label(F.col("text"), [("Licensed", "license"), ("http", "link")], "prose").alias("label"))


@query("n33_pairs_text", "SELECT s_suppkey, 'key=' || s_suppkey || ', name=' || s_name AS line FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", T.pairs_text(F.create_map(F.lit("name"), F.col("s_name"), F.lit("key"), F.col("s_suppkey").cast("string"))).alias("line"))


@query("n34_preview", "SELECT doc_id, substr(text, 1, 40) || '...' AS preview FROM documents")
def _(t):
    return t.documents.select("doc_id", T.preview(F.col("text"), 40).alias("preview"))


@query("n36_tab_fields", "SELECT o_orderkey, o_orderstatus AS first, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS third FROM orders")
def _(t):
    row = F.concat_ws("\t", "o_orderstatus", "o_orderpriority", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey").cast("string")))
    return t.orders.select("o_orderkey", T.tab_field(row, 1).alias("first"), T.tab_field(row, 3).alias("third"))


# --- extraction -------------------------------------------------------------------------------------


@query("x01_spans")
def _(t):
    return X.spans(t.documents, {"ing": r"\b\w+ing\b", "tion": r"\b\w+tion\b"}, 20)


@query("x02_bilingual_pairs", "SELECT c_custkey, replace(c_name, '#', '-') AS english, CASE WHEN c_custkey % 3 = 0 THEN '나라' WHEN c_custkey % 3 = 1 THEN '도시' ELSE '마을사람' END AS korean FROM customer")
def _(t):
    ko = F.when(F.col("c_custkey") % 3 == 0, "나라").when(F.col("c_custkey") % 3 == 1, "도시").otherwise("마을사람")
    name = F.translate("c_name", "#", "-")
    text = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("앞 "), ko, F.lit(" ("), name, F.lit(") 뒤"))).otherwise(F.concat(F.lit("앞 "), name, F.lit(" ("), ko, F.lit(")")))
    return X.bilingual_pairs(t.customer.select("c_custkey", text.alias("text"))).select("c_custkey", "english", "korean")


@query("x03_mentions", "SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Z][a-z]{7,}'))) AS mention FROM documents")
def _(t):
    return X.mentions(t.documents, "[A-Z][a-z]{7,}").select("doc_id", "mention")


@query("x05_code_mentions", "SELECT doc_id, kind, mention FROM (SELECT doc_id, 'number' AS kind, unnest(regexp_extract_all(text, '[0-9]{3,}')) AS mention FROM documents UNION ALL SELECT doc_id, 'caps', unnest(regexp_extract_all(text, '[A-Z]{3,}')) FROM documents)")
def _(t):
    return X.typed_mentions(t.documents, {"number": "[0-9]{3,}", "caps": "[A-Z]{3,}"}).select("doc_id", "kind", "mention")


@query("x06_aligned_cells", "SELECT o_orderkey, unnest([0, 1]) AS line, unnest([o_orderstatus, o_orderpriority]) AS a_line, unnest([o_orderpriority, NULL]) AS b_line FROM orders")
def _(t):
    d = t.orders.select("o_orderkey", F.concat_ws("\n", "o_orderstatus", "o_orderpriority").alias("a"), F.col("o_orderpriority").alias("b"))
    return X.aligned_cells(d, ["a", "b"]).select("o_orderkey", "line", "a_line", "b_line")


@query("x11_co_mentions", "SELECT doc_id, a, b FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Z][a-z]{9,}'))) AS a FROM documents) JOIN (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Z]{4,}'))) AS b FROM documents) USING (doc_id)")
def _(t):
    a = X.mentions(t.documents, "[A-Z][a-z]{9,}").select("doc_id", F.col("mention").alias("a"))
    return X.co_mentions(a, X.mentions(t.documents, "[A-Z]{4,}").select("doc_id", F.col("mention").alias("b")))


@query("x12_sections", "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS content, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents), b AS (SELECT *, sum(CASE WHEN content LIKE 'Th%' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) AS section FROM l) SELECT doc_id, section, string_agg(content, chr(10) ORDER BY line) AS body FROM b WHERE section > 0 GROUP BY 1, 2")
def _(t):
    return X.bullet_sections(t.documents.select("doc_id", "text"), "^Th")


@query("x17_lexicon_hits", "SELECT d.doc_id, b.term, instr(lower(d.text), lower(b.term)) AS position FROM documents d JOIN (SELECT DISTINCT text AS term FROM benchmark) b ON contains(lower(d.text), lower(b.term))")
def _(t):
    return X.lexicon_hits(t.documents, t.benchmark.withColumnRenamed("text", "term"))


@query("x18_tags", "SELECT doc_id, tag FROM (SELECT doc_id, unnest([CASE WHEN contains(upper(text), 'IDIOT') OR contains(upper(text), 'SCUM') THEN 'insult' END, CASE WHEN contains(upper(text), 'LICENSE') THEN 'license' END]) AS tag FROM documents) WHERE tag IS NOT NULL")
def _(t):
    return X.keyword_tags(t.documents, {"insult": ["idiot", "scum"], "license": ["license"]}).select("doc_id", "tag")


@query("x20_page_parts")
def _(t):
    return X.page_parts(t.pages)


@query("x22_references", "SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[0-9]{4}'))), ',') AS found FROM documents")
def _(t):
    return t.documents.select("doc_id", F.array_join(F.array_sort(X.references(F.col("text"), "[0-9]{4}")), ",").alias("found"))


@query("x26_paired_arrays", "SELECT o_orderkey, unnest([0, 1]) AS pos, unnest([o_orderstatus, o_orderpriority]) AS codes, unnest([o_orderpriority, NULL]) AS names FROM orders")
def _(t):
    d = t.orders.select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("codes"), F.array("o_orderpriority").alias("names"))
    return X.paired_arrays(d, "codes", "names")


@query("x27_element_census", "SELECT role AS category, count(*) AS elements, sum(len(regexp_extract_all(text, '[0-9]+'))) AS hits FROM conversations GROUP BY role")
def _(t):
    e = t.conversations.groupBy("conv_id").agg(F.collect_list(F.struct(F.col("role").alias("category"), "text")).alias("elements"))
    return X.element_census(e, "[0-9]+")


@query("x29_nested_children", "SELECT o_custkey, o_orderkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'")
def _(t):
    items = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))).alias("items"))
    posts = t.orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "items")).alias("posts"))
    return X.nested_children(posts, "posts", "items", F.col("child.l_returnflag") == "R").select("o_custkey", F.col("_p.o_orderkey").alias("o_orderkey"), F.col("child.l_linenumber").alias("l_linenumber"))


# --- predicates -------------------------------------------------------------------------------------


@query("p01_prefix_filter", "SELECT p_partkey, p_type FROM part WHERE p_type LIKE 'STANDARD%' OR p_type LIKE 'SMALL%'")
def _(t):
    return t.part.where(J.any_prefix(F.col("p_type"), ["STANDARD", "SMALL"])).select("p_partkey", "p_type")


@query("p02_keyword_filter", "SELECT p_partkey FROM part WHERE contains(lower(p_name || ' ' || p_type), 'steel') OR contains(lower(p_name || ' ' || p_type), 'red')")
def _(t):
    return t.part.where(J.any_keyword(["p_name", "p_type"], ["Steel", "red"])).select("p_partkey")


@query("p03_include_exclude", "SELECT p_partkey FROM part WHERE NOT regexp_matches(p_type, 'SMALL|LARGE') AND regexp_matches(p_type, 'BRASS|STEEL|A')")
def _(t):
    return t.part.where(J.include_exclude(F.col("p_type"), ["BRASS", "STEEL", "A"], ["SMALL", "LARGE"])).select("p_partkey")


@query("p12_member_like", "SELECT p_partkey FROM part WHERE contains(p_name, 'a') OR contains(p_name, 'zz')")
def _(t):
    return t.part.where(J.member_like(F.array(F.lit("a"), F.lit("zz")), F.col("p_name"))).select("p_partkey")


@query("p13_thresholds", "SELECT p_partkey FROM part WHERE p_size >= 5 AND p_retailprice >= 950 AND p_retailprice <= 1500")
def _(t):
    return J.within(t.part, {"p_size": 5, "p_retailprice": 950}, {"p_retailprice": 1500}).select("p_partkey")


_LISTS = {"hard": ["STANDARD POLISHED STEEL", "SMALL PLATED TIN"], "conditional": ["ECONOMY BRUSHED TIN", "PROMO PLATED NICKEL", "MEDIUM BURNISHED COPPER"]}


@query("p05_forbidden", "SELECT p_partkey, CASE WHEN p_type IN ('" + "', '".join(_LISTS["hard"]) + "') THEN 'FORM_TERM' WHEN p_type IN ('" + "', '".join(_LISTS["conditional"]) + "') AND NOT contains(p_name, 'a') THEN 'CONTEXT_PACKAGING' END AS reason FROM part")
def _(t):
    return t.part.select("p_partkey", J.forbidden_reason(F.col("p_type"), _LISTS["hard"], _LISTS["conditional"], F.col("p_name"), ["a"]).alias("reason"))


@query("p09_valid_name", "SELECT doc_id, word, length(word) > 1 AND NOT regexp_full_match(word, '[0-9]+') AND word NOT IN ('the', 'und') AS valid FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Za-z0-9]+'))) AS word FROM documents)")
def _(t):
    w = X.mentions(t.documents, "[A-Za-z0-9]+", 1).select("doc_id", F.col("mention").alias("word"))
    return w.select("doc_id", "word", J.valid_name(F.col("word"), ["the", "und"]).alias("valid"))


# --- joins ------------------------------------------------------------------------------------------


@query("j01_enrich", "SELECT l_orderkey, l_linenumber, p_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def _(t):
    return J.enrich(t.lineitem.withColumnRenamed("l_partkey", "p_partkey"), t.part, "p_partkey")[0].select("l_orderkey", "l_linenumber", "p_name")


_WORDS = "SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]{5,}'))) AS mention FROM documents"


def _mentions(t):
    return X.mentions(t.documents.select("doc_id", F.lower("text").alias("text")), "[a-z]{5,}").select("doc_id", "mention")


def _dictionary(t):
    return t.benchmark.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), 0)).alias("key")).distinct()


_TWO = f"""WITH m AS ({_WORDS}), d AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{5,}}')) AS key FROM benchmark),
 a AS (SELECT DISTINCT substr(key, 1, length(key) - 1) AS alias, min(key) OVER (PARTITION BY substr(key, 1, length(key) - 1)) AS k FROM d)
 SELECT m.doc_id, m.mention, coalesce(d.key, a.k) AS matched_key, CASE WHEN d.key IS NOT NULL THEN 'direct' WHEN a.k IS NOT NULL THEN 'alias' ELSE 'unmatched' END AS match_type
 FROM m LEFT JOIN d ON m.mention = d.key LEFT JOIN a ON m.mention = a.alias"""


def _two_stage(t):
    d = _dictionary(t)
    return J.two_stage(_mentions(t), d, d.select(F.expr("substr(key, 1, length(key) - 1)").alias("alias"), "key"))


@query("j02_two_stage_match", _TWO)
def _(t):
    return _two_stage(t).select("doc_id", "mention", "matched_key", "match_type")


@query("a05_match_rates", f"SELECT match_type, CAST(count(*) AS BIGINT) AS occurrences, count(DISTINCT mention) AS distinct_values, round(count(*) / sum(count(*)) OVER (), 9) AS occurrence_share FROM ({_TWO}) GROUP BY match_type")
def _(t):
    # mentions are counted by word first, so that the dictionary is joined to distinct words
    d = _dictionary(t)
    words = A.frequencies(_mentions(t), ["mention"])
    matched = J.two_stage(words, d, d.select(F.expr("substr(key, 1, length(key) - 1)").alias("alias"), "key"))
    return A.match_rates(matched, "match_type", "mention", "n").select("match_type", "occurrences", "distinct_values", F.round("occurrence_share", 9).alias("occurrence_share"))


@query("j03_cascade", "SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'first' WHEN o_orderstatus = 'F' THEN 'second' END AS label, CASE WHEN o_orderpriority = '1-URGENT' THEN 'priority' WHEN o_orderstatus = 'F' THEN 'status' END AS tier FROM orders")
def _(t):
    rules = t.spark.createDataFrame([("1-URGENT", None, "first", 1), (None, "F", "second", 2)], "p string, s string, label string, priority int")
    return J.cascade(t.orders, rules, [("priority", "o_orderpriority", "p"), ("status", "o_orderstatus", "s")]).select("o_orderkey", "label", "tier")


@query("j04_tiered_codes", "SELECT s_suppkey, c_custkey, 'nation' AS match_type, 0.98 AS confidence FROM supplier JOIN customer ON s_nationkey = c_nationkey WHERE s_nationkey <> 3 UNION ALL SELECT s_suppkey, c_custkey, 'twice', 0.95 FROM supplier JOIN customer ON 2 * s_nationkey = c_nationkey WHERE s_nationkey <> c_nationkey AND 2 * s_nationkey <> 3")
def _(t):
    a = t.supplier.select("s_suppkey", F.array("s_nationkey").alias("n"), F.array(F.col("s_nationkey") * 2).alias("d"))
    return J.tiered_codes(a, t.customer.withColumn("c2", F.col("c_nationkey")), [("nation", "n", "c_nationkey", 0.98), ("twice", "d", "c2", 0.95)], "s_suppkey", "c_custkey", [3])


@query("j05_name_match", "WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM part UNION SELECT DISTINCT lower(p_brand) || '/' || string_split(p_name, ' ')[1] FROM part), b AS (SELECT p_partkey, lower(p_name || ' ' || p_type) AS b FROM part) SELECT w, p_partkey, CASE WHEN w = b THEN 0.95 WHEN contains(b, w) OR contains(w, b) THEN 0.85 ELSE 0.80 END AS confidence FROM w JOIN b ON contains(b, w) OR contains(w, b) OR (contains(w, '/') AND (contains(b, split_part(w, '/', 1)) OR contains(b, split_part(w, '/', 2))))")
def _(t):
    one = t.part.select(F.explode(F.split("p_name", " ")).alias("w"))
    two = t.part.select(F.concat_ws("/", F.lower("p_brand"), F.substring_index("p_name", " ", 1)).alias("w"))
    big = t.part.select("p_partkey", F.lower(F.concat_ws(" ", "p_name", "p_type")).alias("b"))
    return J.name_match(one.unionByName(two).distinct(), big, "w", "b").select("w", "p_partkey", "confidence")


@query("j06_keyword_scores", "WITH k AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(text, '[A-Za-z]{5,}')) AS w FROM benchmark), u AS (SELECT DISTINCT lower(w) AS l FROM k), f AS (SELECT doc_id, l FROM u JOIN documents ON contains(lower(text), l)), h AS (SELECT item_id, doc_id, count(DISTINCT w) AS score FROM k JOIN f ON lower(w) = l GROUP BY 1, 2), n AS (SELECT item_id, count(DISTINCT w) AS c FROM k GROUP BY 1) SELECT item_id, doc_id, score, score / c AS ratio, rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, score / c DESC, doc_id) AS rank FROM h JOIN n USING (item_id)) WHERE rank <= 4")
def _(t):
    k = t.benchmark.select("item_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{5,}"), 0)).alias("w")).distinct()
    return J.keyword_scores(k, t.documents, "item_id", "w", "text", "doc_id", 4)


@query("j07_prefix_expand", "SELECT n_nationkey, p_partkey FROM nation JOIN part ON CAST(p_size AS VARCHAR) = CAST(n_nationkey AS VARCHAR) OR CAST(p_size AS VARCHAR) || '.' || p_brand LIKE CAST(n_nationkey AS VARCHAR) || '.%'")
def _(t):
    master = t.part.select("p_partkey", F.concat_ws(".", F.col("p_size").cast("string"), "p_brand").alias("code"))
    return J.prefix_expand(t.nation.select("n_nationkey", F.col("n_nationkey").cast("string").alias("e")), master, "e", "code").select("n_nationkey", "p_partkey")


@query("j08_range_contains", "SELECT p_size, min(lo) AS lo, any_value(n) AS items FROM (SELECT p_size, count(*) AS n FROM part GROUP BY 1) JOIN (SELECT n_nationkey * 2 AS lo, n_nationkey * 2 + 5 AS hi FROM nation) r ON p_size BETWEEN lo AND hi GROUP BY 1")
def _(t):
    items = t.part.select("p_size", F.lit("x").alias("ch"))  # sizes repeat, and every row stays
    ranges = t.nation.select(F.lit("x").alias("ch"), (F.col("n_nationkey") * 2).alias("lo"), (F.col("n_nationkey") * 2 + 5).alias("hi"))
    return J.range_contains(items, ranges, "ch", "p_size", "lo", "hi", [F.col("lo")]).groupBy("p_size", "lo").agg(F.count("*").alias("items"))


@query("j08_wide_ranges", "SELECT o_orderkey, p_partkey FROM (SELECT o_orderkey, p_partkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY hi - lo, p_partkey) AS k FROM orders JOIN (SELECT p_partkey, CAST(p_partkey AS BIGINT) * 40000000 - 20000000 AS lo, CAST(p_partkey AS BIGINT) * 40000000 + CAST(p_size AS BIGINT) * 20000000 AS hi FROM part) ON CAST(o_custkey AS BIGINT) * 50000000 + o_orderkey BETWEEN lo AND hi) WHERE k = 1")
def _(t):
    """Orders in ranges up to 10^9 wide."""
    items = t.orders.select("o_orderkey", F.lit("x").alias("ch"), (F.col("o_custkey") * 50_000_000 + F.col("o_orderkey")).alias("at"))
    key = F.col("p_partkey").cast("long")
    ranges = t.part.select("p_partkey", F.lit("x").alias("ch"), (key * 40_000_000 - 20_000_000).alias("lo"), (key * 40_000_000 + F.col("p_size").cast("long") * 20_000_000).alias("hi"))
    return J.range_contains(items, ranges, "ch", "at", "lo", "hi", [F.col("hi") - F.col("lo"), F.col("p_partkey")]).select("o_orderkey", "p_partkey")


@query("j09_mutual_contains", "WITH a AS (SELECT DISTINCT lower(w) AS w FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]{4,}')) AS w FROM benchmark)), b AS (SELECT DISTINCT unnest([n, upper(n)]) AS n FROM (SELECT unnest(string_split(lower(p_name || ' ' || p_type), ' ')) AS n FROM part)), x AS (SELECT w, n, row_number() OVER (PARTITION BY w ORDER BY CASE WHEN w = lower(n) THEN 0 ELSE 1 END, length(n) DESC, n) AS k FROM a JOIN b ON contains(lower(n), w) OR contains(w, lower(n)) WHERE n <> '') SELECT w, n, CASE WHEN w = lower(n) THEN 0.95 ELSE 0.8 END AS confidence FROM x WHERE k = 1")
def _(t):
    a = t.benchmark.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{4,}"), 0)).alias("w")).select(F.lower("w").alias("w")).distinct()
    b = t.part.select(F.explode(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " ")).alias("n")).where("n <> ''")
    return J.mutual_contains(a, b.select(F.explode(F.array("n", F.upper("n"))).alias("n")), "w", "n").select("w", "n", "confidence")


@query("j10_resolve_list", "SELECT l_orderkey, coalesce(string_agg(p_name, '|' ORDER BY l_linenumber, l_partkey) FILTER (p_name IS NOT NULL), '') AS resolved, coalesce(string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY l_linenumber, l_partkey) FILTER (p_name IS NULL), '') AS missing FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 25) ON l_partkey = p_partkey GROUP BY 1")
def _(t):
    o = t.lineitem.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("parts"))
    out = J.resolve_list(o, "parts", t.part.where("p_size > 25"), "l_orderkey", "p_partkey", "p_name")
    return out.select("l_orderkey", F.array_join("codes", "|").alias("resolved"), F.array_join(F.col("missing").cast("array<string>"), "|").alias("missing"))


@query("j11_base_name", "SELECT p_partkey, p_brand AS matched, 'base' AS match_type FROM part WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size < 10)")
def _(t):
    left = t.part.select("p_partkey", F.concat("p_brand", F.lit(" decree")).alias("n"))
    return J.base_name_match(left, t.part.where("p_size < 10"), "n", "p_brand", r"\s*decree$").where("matched is not null").select("p_partkey", "matched", "match_type")


@query("j15_anti_join", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(t):
    return J.enrich(t.customer.select(F.col("c_custkey").alias("o_custkey")), t.orders, "o_custkey")[1].withColumnRenamed("o_custkey", "c_custkey")


@query("j17_changed", "SELECT doc_id, quality AS old, 1 - toxic AS new FROM labels WHERE quality IS DISTINCT FROM 1 - toxic")
def _(t):
    return J.changed(t.labels, t.labels.select("doc_id", (1 - F.col("toxic")).alias("quality")), "doc_id", "quality")


@query("j20_co_members", "SELECT x.l_suppkey AS a, y.l_suppkey AS b, count(*) AS shared FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) x JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey <> y.l_suppkey GROUP BY 1, 2")
def _(t):
    return J.co_members(t.lineitem, "l_orderkey", "l_suppkey")


@query("j21_mismatched", "SELECT count(*) AS n FROM lineitem WHERE l_returnflag <> l_linestatus OR l_returnflag IS NULL OR l_linestatus IS NULL")
def _(t):
    return t.lineitem.where(J.mismatched(F.col("l_returnflag"), F.col("l_linestatus"))).agg(F.count("*").alias("n"))


@query("j22_merge_codes", "SELECT c_custkey, coalesce(string_agg(DISTINCT CAST(s_suppkey AS VARCHAR), ',' ORDER BY CAST(s_suppkey AS VARCHAR)), '') AS codes FROM customer LEFT JOIN supplier ON c_nationkey = s_nationkey GROUP BY 1")
def _(t):
    codes = t.supplier.groupBy("s_nationkey").agg(F.collect_list(F.col("s_suppkey").cast("string")).alias("codes"))
    return J.merge_codes(t.customer.withColumn("types", F.array("c_nationkey")), "types", codes, "s_nationkey", "codes", "c_custkey").select("c_custkey", F.array_join("codes", ",").alias("codes"))


@query("j23_variant_match", "SELECT o_orderkey, n_nationkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = CASE WHEN o_orderkey % 2 = 0 THEN c_nationkey ELSE 24 - c_nationkey END")
def _(t):
    # orders repeat the names, every row stays
    pick = F.when(F.col("o_orderkey") % 2 == 0, F.col("c_nationkey")).otherwise(24 - F.col("c_nationkey"))
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", pick.alias("k")).join(t.nation.withColumnRenamed("n_nationkey", "k"), "k").select("o_orderkey", F.col("n_name").alias("name"))
    return J.variant_match(o, F.array(F.concat("name", F.lit("?")), F.lower("name")), t.nation.select("n_nationkey", F.col("n_name").alias("m")), "name", "m").select("o_orderkey", "n_nationkey")


@query("j14_missing_targets", "SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 'article' ELSE 'clause' END AS reason FROM lineitem WHERE l_orderkey % 3 = 0 OR l_linenumber > 2")
def _(t):
    s = lambda c: F.col(c).cast("string")
    top = t.orders.where("o_orderkey % 3 <> 0").select(F.lit("L").alias("law_id"), s("o_orderkey").alias("article_number"), F.lit(0).alias("depth"), F.lit(None).cast("int").alias("clause_number"))
    kid = t.lineitem.where("l_linenumber <= 2").select(F.lit("L").alias("law_id"), s("l_orderkey").alias("article_number"), F.lit(1).alias("depth"), F.col("l_linenumber").cast("int").alias("clause_number")).distinct()
    refs = t.lineitem.select("l_orderkey", "l_linenumber", F.lit("L").alias("target_law_id"), s("l_orderkey").alias("target_article_number"), F.col("l_linenumber").cast("int").alias("target_clause"))
    return J.missing_targets(refs, top.unionByName(kid)).select("l_orderkey", "l_linenumber", "reason")


_FILES = "SELECT doc_id, source || '-' || lang || '-' || (doc_id % 7) || '.pdf' AS file FROM documents"
_NAMES = "SELECT name, min(seq) AS seq FROM (SELECT source || '-' || lang AS name, doc_id AS seq FROM documents UNION ALL SELECT source || '-' || lang || '-3', doc_id FROM documents UNION ALL SELECT 'none-' || (doc_id % 300), doc_id FROM documents) GROUP BY 1"


def _files_and_names(t):
    d = t.documents
    file = F.concat_ws("-", "source", "lang", F.concat((F.col("doc_id") % 7).cast("string"), F.lit(".pdf")))
    n = F.concat_ws("-", "source", "lang")
    names = d.select(n.alias("name"), F.col("doc_id").alias("seq")).unionByName(d.select(F.concat(n, F.lit("-3")).alias("name"), F.col("doc_id").alias("seq"))).unionByName(d.select(F.concat(F.lit("none-"), (F.col("doc_id") % 300).cast("string")).alias("name"), F.col("doc_id").alias("seq")))
    return d.select("doc_id", file.alias("file")), names.groupBy("name").agg(F.min("seq").alias("seq"))


@query("j19_file_catalogue", f"WITH f AS ({_FILES}), n AS ({_NAMES}), g AS (SELECT file, arg_min(name, (-length(name), name)) AS name FROM (SELECT DISTINCT file FROM f) JOIN n ON contains(file, name) GROUP BY 1) SELECT doc_id, file, g.name, n.seq FROM f LEFT JOIN g USING (file) LEFT JOIN n ON n.name = g.name")
def _(t):
    return J.file_catalogue(_files_and_names(t)[0], "file", _files_and_names(t)[1], "name").select("doc_id", "file", "name", "seq")


@query("j19_missing_files", f"WITH f AS (SELECT DISTINCT file FROM ({_FILES})), n AS ({_NAMES}) SELECT name, seq FROM n WHERE NOT EXISTS (SELECT 1 FROM f WHERE contains(file, name))")
def _(t):
    f, n = _files_and_names(t)
    return J.missing_files(n, "name", f, "file").select("name", "seq")


# --- aggregates, windows, sets ------------------------------------------------------------------------


@query("a01_group_lists", "SELECT p_brand, arg_min(p_name, p_partkey) AS p_name, count(DISTINCT p_type) AS p_type_count, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS types FROM part GROUP BY 1")
def _(t):
    return A.group_lists(t.part, ["p_brand"], "p_partkey", ["p_name"], ["p_type"]).select("p_brand", "p_name", F.col("p_type_count").cast("long").alias("p_type_count"), F.array_join("p_type_list", "|").alias("types"))


@query("a03_positive_stats", "SELECT c_nationkey, count(*) AS products, count(DISTINCT c_mktsegment) AS makers, coalesce(min(CASE WHEN c_acctbal > 0 THEN c_acctbal END), 0.0) AS min_value, coalesce(max(CASE WHEN c_acctbal > 0 THEN c_acctbal END), 0.0) AS max_value FROM customer GROUP BY 1")
def _(t):
    return A.positive_stats(t.customer, ["c_nationkey"], "c_acctbal", "c_mktsegment")


@query("a04_top_words", "SELECT mention, count(*) AS n FROM (" + _WORDS + ") GROUP BY 1 ORDER BY n DESC, mention LIMIT 50")
def _(t):
    return A.frequencies(_mentions(t), ["mention"], 50)


@query("a06_text_stats", "SELECT source, count(*) AS documents, sum(length(text)) AS chars, round(avg(length(text)), 6) AS avg_chars, min(length(text)) AS min_chars, max(length(text)) AS max_chars FROM documents GROUP BY 1")
def _(t):
    return A.text_stats(t.documents, ["source"], "text").withColumn("avg_chars", F.round("avg_chars", 6))


@query("a07_pair_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, arg_min(o_custkey, o_orderkey) AS first_context FROM orders GROUP BY 1, 2")
def _(t):
    return A.pair_counts(t.orders, ["o_orderstatus", "o_orderpriority"], "o_orderkey", "o_custkey")


@query("a08_choose_alias", "SELECT p_brand, arg_min(p_name, (CASE WHEN p_size > 25 THEN 0 ELSE 1 END, length(p_name), p_name)) AS target FROM part GROUP BY 1")
def _(t):
    return A.choose_alias(t.part.withColumn("v", F.col("p_size") > 25), "p_brand", "p_name", "v").select("p_brand", "target")


@query("a09_inverted_index", "SELECT w AS word, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS owners, count(DISTINCT p_brand) > 1 AS ambiguous FROM (SELECT unnest(string_split(p_name, ' ')) AS w, p_brand FROM part) GROUP BY 1")
def _(t):
    return A.inverted_index(t.part, "word", F.split("p_name", " "), "p_brand").select("word", F.array_join("owners", ",").alias("owners"), "ambiguous")


@query("a11_many_owned", "SELECT l_partkey, count(DISTINCT l_suppkey) AS owners FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) >= 3")
def _(t):
    return A.many_owned(t.lineitem, "l_partkey", "l_suppkey", 3)


@query("a13_two_source_rollup", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'right' WHEN b.k IS NULL THEN 'left' ELSE 'both' END AS source, coalesce(a.n, '') AS left_list, coalesce(b.n, '') AS right_list FROM (SELECT c_nationkey AS k, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS n FROM customer WHERE c_nationkey < 15 GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS k, string_agg(DISTINCT s_name, ',' ORDER BY s_name) AS n FROM supplier GROUP BY 1) b ON a.k = b.k")
def _(t):
    a = t.customer.where("c_nationkey < 15").select(F.col("c_nationkey").alias("k"), "c_mktsegment")
    out = A.two_source_rollup(a, t.supplier.select(F.col("s_nationkey").alias("k"), "s_name"), "k", "c_mktsegment", "s_name")
    return out.select("k", "source", F.array_join("left_list", ",").alias("left_list"), F.array_join("right_list", ",").alias("right_list"))


@query("a15_prefix_stats", "SELECT substr(o_orderpriority, 1, 1) AS prefix, count(*) AS codes FROM orders GROUP BY 1")
def _(t):
    return A.prefix_stats(t.orders, "o_orderpriority")


@query("a17_tiers", "SELECT tier, count(*) AS keys, sum(n) AS rows, round(avg(n), 9) AS average FROM (SELECT n, CASE WHEN n >= 20 THEN 1 WHEN n >= 10 THEN 2 WHEN n >= 5 THEN 3 ELSE 4 END AS tier FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)) GROUP BY 1")
def _(t):
    return A.tiers(t.orders, "o_custkey").select("tier", "keys", "rows", F.round("average", 9).alias("average"))


@query("a19_transitions", "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2")
def _(t):
    return A.transitions(t.labels, "quality", "toxic")


@query("a20_completeness", "SELECT count(*) AS rows, count_if(o_orderstatus = 'F') AS with_code, count_if(o_custkey % 2 = 0) AS with_all, count_if(o_orderstatus = 'F' AND o_custkey % 2 = 0) AS complete FROM orders")
def _(t):
    return A.completeness(t.orders, F.col("o_orderstatus") == "F", F.col("o_custkey") % 2)


@query("a21_by_label", "SELECT coalesce(o_orderstatus, 'unknown') AS o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS units FROM orders GROUP BY 1")
def _(t):
    return A.by_label(t.orders, "o_orderstatus", "o_custkey")


@query("a27_nested_counts", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _(t):
    return A.nested_counts(t.lineitem, "l_returnflag", "l_linestatus").select("l_returnflag", F.inline("counts"))


@query("a28_ratio_of_counts", "SELECT c_nationkey AS k, round(coalesce(s.n, 0) / c.n, 2) AS ratio FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s ON c_nationkey = s_nationkey")
def _(t):
    return A.ratio_of_counts(t.supplier.withColumnRenamed("s_nationkey", "k"), t.customer.withColumnRenamed("c_nationkey", "k"), "k")


@query("a29_coverage", "SELECT avg(CASE WHEN length(trim(text)) > 0 THEN 1.0 ELSE 0.0 END) * 100 AS coverage FROM documents")
def _(t):
    return A.coverage(t.documents, "text")


@query("w02_sequential_ids", "SELECT c_custkey, 'CUST_' || lpad(CAST(row_number() OVER (ORDER BY c_name, c_custkey) AS VARCHAR), CAST(greatest(6, length(CAST(row_number() OVER (ORDER BY c_name, c_custkey) AS VARCHAR))) AS INT), '0') AS id FROM customer")
def _(t):
    return W.number(t.customer, "CUST_", ["c_name", "c_custkey"], digits=6).select("c_custkey", "id")


@query("w03_longest", "SELECT p_brand, arg_max(p_name, (length(p_name), -p_partkey)) AS p_name FROM part GROUP BY 1")
def _(t):
    return W.longest_by(t.part, ["p_brand"], "p_name", "p_partkey").select("p_brand", "p_name")


@query("w04_top_k", "SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def _(t):
    return W.top_k(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank")


@query("w06_range_ends", "SELECT o_custkey, o_orderkey, coalesce(lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1, 1000000000) AS ends FROM orders")
def _(t):
    d = t.orders.select("o_custkey", "o_orderkey", F.lit(1000000000).cast("long").alias("total"))
    return W.range_ends(d, ["o_custkey"], "o_orderkey", "total", "ends").drop("total")


@query("w07_running_share", "SELECT o_orderpriority, o_orderstatus, n, sum(n) OVER (PARTITION BY o_orderpriority ORDER BY n DESC, o_orderstatus ROWS UNBOUNDED PRECEDING) AS running FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)")
def _(t):
    d = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    return W.running_share(d, ["o_orderpriority"], [F.desc("n"), F.col("o_orderstatus")], "n").drop("share")


@query("w10_alias_conflicts", "SELECT p_partkey, p_name <> first_value(p_name) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS conflict FROM part")
def _(t):
    return W.alias_conflicts(t.part, "p_brand", "p_name", "p_partkey").select("p_partkey", "conflict")


@query("w11_carry_forward", "SELECT event_id, last_value(CASE WHEN value > 50 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS v FROM events")
def _(t):
    return W.carry_forward(t.events.withColumn("v", F.when(F.col("value") > 50, F.col("value"))), ["user_id"], "event_id", "v").select("event_id", "v")


@query("g02_global_top", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def _(t):
    return t.part.orderBy(F.desc("p_retailprice"), "p_partkey").limit(20).select("p_partkey", "p_retailprice")


@query("g03_seeded_sample")
def _(t):
    return W.seeded_sample(t.documents, "doc_id", 30).select("doc_id")


@query("g04_page_chunks", "SELECT o_orderkey, chunk, 1 + chunk * ceil(l / n) AS chunk_start FROM (SELECT o_orderkey, l, ceil(l / 50.0) AS n, unnest(range(0, CAST(ceil(l / 50.0) AS BIGINT))) AS chunk FROM (SELECT o_orderkey, CAST(floor(o_totalprice / 1000) AS INT) + 1 AS l FROM orders))")
def _(t):
    d = t.orders.select("o_orderkey", F.lit(1).alias("start"), (F.floor(F.col("o_totalprice") / 1000) + 1).cast("int").alias("end"))
    return W.page_chunks(d).select("o_orderkey", F.col("chunk").cast("long").alias("chunk"), F.col("chunk_start").cast("double").alias("chunk_start"))


_SECTIONS = "SELECT o_custkey AS doc, CAST(o_orderkey AS VARCHAR) AS section, 1 AS s, CAST(floor(o_totalprice) AS BIGINT) % 130 + 1 AS e FROM orders"


@query("g04_section_chunks", f"WITH x AS ({_SECTIONS}), p AS (SELECT section, 'L' || l_linenumber AS title, l_linenumber * 10 + 1 AS s, e, x.doc FROM x JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber <= 4 AND l_orderkey % 3 = 0) ON section = CAST(l_orderkey AS VARCHAR) WHERE e > 50) SELECT doc, section AS name, 'section' AS kind, s AS chunk_start, e AS chunk_end FROM x WHERE e <= 50 UNION ALL SELECT doc, section || ' - ' || title, 'subsection', s, coalesce(lead(s) OVER (PARTITION BY doc, section ORDER BY s) - 1, e) FROM p UNION ALL SELECT doc, section || ' Part ' || (k + 1), 'split', 1 + k * z, least(1 + k * z + z - 1, e) FROM (SELECT doc, section, e, CAST(ceil(e / ceil(e / 50.0)) AS BIGINT) AS z, unnest(range(0, CAST(ceil(e / 50.0) AS BIGINT))) AS k FROM x WHERE e > 50 AND section NOT IN (SELECT section FROM p))")
def _(t):
    pages = F.floor("o_totalprice") % 130 + 1
    s = t.orders.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").cast("string").alias("section"), F.lit(1).cast("long").alias("start"), pages.alias("end"))
    sub = t.lineitem.where("l_linenumber <= 4 AND l_orderkey % 3 = 0").select(F.col("l_orderkey").cast("string").alias("section"), F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("title"), (F.col("l_linenumber") * 10 + 1).cast("long").alias("start")).distinct()
    sub = sub.join(s.select("doc", "section"), "section").select("doc", "section", "title", "start")
    return W.section_chunks(s, sub, "doc", "section").select("doc", "name", "kind", F.col("chunk_start").cast("long").alias("chunk_start"), F.col("chunk_end").cast("long").alias("chunk_end"))


@query("u01_key_sets", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left' WHEN a.k IS NULL THEN 'right' ELSE 'both' END AS side FROM (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_nationkey < 15) a FULL JOIN (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_nationkey > 5) b ON a.k = b.k")
def _(t):
    return W.key_sets(t.customer.where("c_nationkey < 15").select(F.col("c_nationkey").alias("k")), t.supplier.where("s_nationkey > 5").select(F.col("s_nationkey").alias("k")), "k")


@query("u02_append_absent", "SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(t):
    return W.append_absent(t.labels.select("doc_id"), t.documents.select("doc_id"), ["doc_id"])


@query("u05_merge_chunks", "SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS content FROM conversations GROUP BY 1")
def _(t):
    d = t.conversations.select("conv_id", "turn", F.col("text").alias("content"), F.array("role").alias("elements"))
    return W.merge_chunks(d, "conv_id", "turn").select("conv_id", "content")


# --- classification -----------------------------------------------------------------------------------


_RULES = [("legal", "License", "keyword", 1), ("legal", "rights", "keyword", 1), ("web", "http", "keyword", 2), ("prose", ".", "suffix", 3)]


@query("c02_keyword_classifier", "WITH r(category, keyword, kind, priority) AS (VALUES " + ", ".join(f"('{a}', '{b}', '{c}', {d})" for a, b, c, d in _RULES) + "), s AS (SELECT doc_id, category, priority, sum(CASE WHEN kind = 'suffix' THEN CASE WHEN ends_with(text, keyword) THEN 5 ELSE 0 END ELSE 2 * CAST((length(text) - length(replace(text, keyword, ''))) / length(keyword) AS INT) END) / priority AS score FROM documents JOIN r ON contains(text, keyword) OR ends_with(text, keyword) GROUP BY 1, 2, 3) SELECT doc_id, category, round(score, 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, priority, category) AS k FROM s WHERE score > 0) WHERE k = 1")
def _(t):
    rules = t.spark.createDataFrame(_RULES, "category string, keyword string, kind string, priority int")
    return C.keyword_classifier(t.documents.select("doc_id", "text"), rules, "text", "text", "doc_id").select("doc_id", "category", F.round("score", 9).alias("score"))


_EARLY = [("Licensed|rights reserved", "legal", 0.95), ("https?://", "web", 0.9)]
_SCORED = [("tech", "system", "keyword", 1), ("tech", "data", "keyword", 1), ("tech", "the ", "negative", 1), ("talk", "you", "keyword", 2), ("talk", "?", "suffix", 2)]


@query("c03_early_rules", "WITH r(category, keyword, kind, priority) AS (VALUES " + ", ".join(f"('{a}', '{b}', '{c}', {d})" for a, b, c, d in _SCORED) + "), s AS (SELECT doc_id, category, priority, sum(CASE kind WHEN 'suffix' THEN CASE WHEN ends_with(text, keyword) THEN 5 ELSE 0 END WHEN 'negative' THEN -3 ELSE 2 * CAST((length(text) - length(replace(text, keyword, ''))) / length(keyword) AS INT) END) / priority AS score FROM documents JOIN r ON contains(text, keyword) GROUP BY 1, 2, 3), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, priority, category) AS k FROM s WHERE score > 0) WHERE k = 1) SELECT d.doc_id, CASE WHEN regexp_matches(text, 'Licensed|rights reserved') THEN 'legal' WHEN regexp_matches(text, 'https?://') THEN 'web' ELSE category END AS category, round(CASE WHEN regexp_matches(text, 'Licensed|rights reserved') THEN 0.95 WHEN regexp_matches(text, 'https?://') THEN 0.9 WHEN score IS NOT NULL THEN least(score / 10, 1.0) ELSE 1.0 END, 9) AS confidence FROM documents d LEFT JOIN b USING (doc_id)".replace("ELSE 1.0 END, 9)", "END, 9)"))
def _(t):
    rules = t.spark.createDataFrame(_SCORED, "category string, keyword string, kind string, priority int")
    d = t.documents.select("doc_id", "text")
    scored = C.keyword_classifier(d, rules, "text", "text", "doc_id")
    return C.early_rules(d, _EARLY, "text", scored, "doc_id").select("doc_id", "category", F.round("confidence", 9).alias("confidence"))


_POOL = [("core", "c1", 1, ["the", "and"], ["Licensed"]), ("core", "c2", 2, ["data"], ["http"]), ("core", "c3", 3, ["was", "were"], []), ("core", "c4", 4, ["you"], ["?"]), ("boundary", "b1", 1, ["of"], []), ("boundary", "b2", 2, ["in", "on", "at"], ["!"]), ("fixed", "f1", 1, [], []), ("fixed", "f2", 2, ["the"], [])]


def _pool_sql() -> str:
    held = lambda ws: " + ".join(f"CAST(contains(text, '{w}') AS INT)" for w in ws) or "0"
    rows = [f"SELECT doc_id, '{k}' AS kind, '{e}' AS example, {s} AS seq, " + ("0" if k == "fixed" else f"2 * ({held(ws)}) + 3 * CAST(({held(cues)}) > 0 AS INT)") + " AS score FROM documents" for k, e, s, ws, cues in _POOL]
    return " UNION ALL ".join(rows)


@query("c05_choose_examples", f"SELECT doc_id, kind, example, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, kind ORDER BY score DESC, seq) AS rank FROM ({_pool_sql()})) WHERE rank <= CASE WHEN kind = 'fixed' THEN 1 ELSE 3 END")
def _(t):
    pool = t.spark.createDataFrame(_POOL, "kind string, example string, seq int, keywords array<string>, cues array<string>")
    return C.choose_examples(t.documents, pool, "doc_id", "text").select("doc_id", "kind", "example", "score", "rank")


@query("c07_complexity", "SELECT o_custkey, round(least(coalesce(tables / nullif(pages, 0), 0) * 20, 40) + CASE WHEN nested THEN 30 ELSE 0 END + least(rows / 10, 30), 6) AS score FROM (SELECT o_custkey, count(*) AS tables, count(DISTINCT o_orderstatus) - 1 AS pages, count_if(o_orderpriority = '1-URGENT') > 1 AS nested, sum(o_orderkey % 50) AS rows FROM orders GROUP BY 1)")
def _(t):
    s = t.orders.groupBy("o_custkey").agg(F.count("*").alias("tables"), (F.countDistinct("o_orderstatus") - 1).alias("pages"), (F.count_if(F.col("o_orderpriority") == "1-URGENT") > 1).alias("nested"), F.sum(F.col("o_orderkey") % 50).alias("rows"))
    return s.select("o_custkey", F.round(C.complexity(F.col("tables"), F.col("pages"), F.col("nested"), F.col("rows")), 6).alias("score"))


@query("c06_quality_grade", "SELECT doc_id, CASE WHEN per < 50 OR low >= 0.5 THEN 'C' WHEN per >= 300 AND low < 0.1 THEN 'A' ELSE 'B' END AS grade FROM (SELECT doc_id, length(text) / (1 + len(string_split(text, chr(10)))) AS per, (doc_id % 7) / 10.0 AS low FROM documents)")
def _(t):
    return t.documents.select("doc_id", C.quality_grade(F.length("text"), F.size(F.split("text", "\n")) + 1, (F.col("doc_id") % 7) / 10.0).alias("grade"))


_GATES = {
    "hard": ["k0"], "conditional": ["k1"], "hints": ["ECONOMY"], "suffixes": [{"en": "e", "ko": ["2", "3"], "strict": True}, {"en": "d", "ko": ["4"]}],
    "regimen": ["r5"], "biomarker": ["b6"], "disease": ["d7"], "context_tokens": ["PROMO"], "strict": 0.25, "loose": 0.6, "high_frequency": 20,
}


@query("c01_gate_chain")
def _(t):
    # names are words of p_name with an end that the gates know, by the part's number
    kind = F.col("p_partkey") % 10
    end = F.when(kind == 5, "r5").when(kind == 6, "b6").when(kind == 7, "d7")
    first = F.concat_ws(" ", F.substring_index("p_name", " ", 1), end)
    last = F.when(kind < 2, F.concat(F.lit("k"), kind.cast("string"))).when(kind == 4, F.substring_index("p_name", " ", 1)).otherwise(F.concat(F.substring_index("p_name", " ", -1), kind.cast("string")))
    e = t.part.select(first.alias("en"), last.alias("ko"), F.col("p_size").alias("count"), F.col("p_type").alias("context_span"), F.col("p_partkey").alias("seq"))
    curated = t.part.where("p_size = 7").select(first.alias("en"), last.alias("ko"))
    brands = t.part.where("p_size = 9").select(first.alias("brand"), last.alias("ingredient"))
    promotion = t.part.where("p_size = 11").select(F.substring_index("p_type", " ", 1).alias("anchor"), first.alias("drug"))
    out = C.gate_chain(e, _GATES, curated, brands, promotion=promotion)
    return out.select("seq", "decision", F.array_join("reason_codes", ",").alias("reasons"))


@query("c09_dictionary", "SELECT p_brand AS ingredient, arg_min(p_type, p_partkey) AS atc_code, count(DISTINCT p_name) AS makers, CASE WHEN starts_with(arg_min(p_type, p_partkey), 'STA') THEN 'standard' ELSE 'other' END AS therapeutic_category FROM part GROUP BY 1")
def _(t):
    p = t.part.select(F.col("p_type").alias("atc_code"), F.col("p_brand").alias("ingredient"), F.col("p_name").alias("brand"), F.col("p_name").alias("maker"), F.col("p_partkey").alias("seq"))
    cats = t.spark.createDataFrame([("STA", "standard")], "code string, category string")
    names = t.spark.createDataFrame([("STA", "Standard")], "code string, name string")
    return C.build_dictionary(p, names, cats, "other").select("ingredient", "atc_code", F.col("maker_count").cast("long").alias("makers"), "therapeutic_category")


# --- graph ----------------------------------------------------------------------------------------------


def _orders_edges(t):
    return t.orders.select(F.col("o_custkey").alias("src_id"), F.col("o_orderkey").alias("dst_id"))


def _line_edges(t):
    return t.lineitem.select(F.col("l_orderkey").alias("src_id"), F.col("l_partkey").alias("dst_id"))


@query("k01_upsert", "SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 2 = 0 THEN s_name END, s_name || '!') AS s_name FROM supplier")
def _(t):
    old = t.supplier.select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("s_name")).where("s_suppkey % 3 <> 0 OR s_suppkey % 2 = 0")
    return G.upsert(old, t.supplier.select("s_suppkey", F.concat("s_name", F.lit("!")).alias("s_name")), "s_suppkey")


@query("k02_upsert_status", "SELECT s_suppkey, s_acctbal, CASE WHEN s_suppkey % 2 = 0 THEN 'updated' ELSE 'created' END AS status FROM supplier")
def _(t):
    return G.upsert(t.supplier.where("s_suppkey % 2 = 0").select("s_suppkey", F.lit(0.0).alias("s_acctbal")), t.supplier.select("s_suppkey", "s_acctbal"), "s_suppkey", keep_old=False, status=True)


@query("k04_edges", "SELECT DISTINCT l_orderkey AS src_id, l_partkey AS dst_id FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10)")
def _(t):
    rows = t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"))
    return G.edges(rows, "l_orderkey", "parts", t.orders, t.part.where("p_size > 10"), "o_orderkey", "p_partkey")


@query("k06_merge_edges", "SELECT l_partkey AS src_id, l_suppkey AS dst_id, arg_min(l_quantity, (l_orderkey, l_linenumber)) AS q FROM lineitem GROUP BY 1, 2")
def _(t):
    e = t.lineitem.select(F.col("l_partkey").alias("src_id"), F.col("l_suppkey").alias("dst_id"), F.col("l_quantity").alias("q"), "l_orderkey", "l_linenumber")
    return G.merge_edges(e, [F.col("l_orderkey"), F.col("l_linenumber")]).select("src_id", "dst_id", "q")


@query("k07_inferred_edges", "SELECT DISTINCT s_suppkey AS src_id, c_custkey AS dst_id FROM supplier JOIN customer ON s_nationkey = c_nationkey JOIN nation ON n_nationkey = s_nationkey WHERE contains(c_mktsegment, substr(n_name, 1, 1))")
def _(t):
    return G.inferred_edges(t.supplier.select(F.col("s_suppkey").alias("src_id"), F.col("s_nationkey").alias("mid")), t.customer.select(F.col("c_nationkey").alias("mid"), F.col("c_custkey").alias("dst_id"), F.col("c_mktsegment").alias("name")), t.nation.select(F.col("n_nationkey").alias("mid"), F.array(F.substring("n_name", 1, 1)).alias("names")))


@query("q02_one_hop", "SELECT c_name AS src_c_name, o_orderstatus AS dst_o_orderstatus, o_orderkey AS dst_id FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'")
def _(t):
    return G.one_hop(_orders_edges(t), t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name"), t.orders.select("o_orderkey", "o_orderstatus"), "c_custkey", "o_orderkey").select("src_c_name", "dst_o_orderstatus", "dst_id")


@query("q03_paths", "SELECT c_nationkey AS n0, c_custkey AS n1, o_orderkey AS n2, l_partkey AS n3 FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey")
def _(t):
    return G.path(t.customer.select(F.col("c_nationkey").alias("src_id"), F.col("c_custkey").alias("dst_id")), _orders_edges(t), _line_edges(t))


_TREE = "SELECT 'r' || n_regionkey AS src_id, 'n' || n_nationkey AS dst_id FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer"


def _tree(t):
    tag = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    return t.nation.select(tag("r", "n_regionkey").alias("src_id"), tag("n", "n_nationkey").alias("dst_id")).unionByName(t.customer.select(tag("n", "c_nationkey").alias("src_id"), tag("c", "c_custkey").alias("dst_id")))


@query("q04_descend", f"WITH RECURSIVE e AS ({_TREE}), b(root, node, depth) AS (SELECT 'r' || r_regionkey, 'r' || r_regionkey, 0 FROM region UNION ALL SELECT b.root, e.dst_id, b.depth + 1 FROM b JOIN e ON e.src_id = b.node) SELECT root, node, depth FROM b WHERE depth > 0")
def _(t):
    return G.descend(_tree(t), t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id")))


_RN = "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@query("q04_descend_cycles", f"WITH x AS (SELECT event_id, {_RN} AS k, first_value(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS root, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT root, event_id AS node, CASE WHEN k = 1 THEN n ELSE k - 1 END AS depth FROM x")
def _(t):
    """Every user's events one after the other, the last leading back to the first."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    own = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = t.events.select("event_id", F.lead("event_id").over(w).alias("next"), F.first("event_id").over(own).alias("root"))
    e = x.select(F.col("event_id").alias("src_id"), F.coalesce("next", "root").alias("dst_id"))
    return G.descend(e, x.select(F.col("root").alias("id")))


@query("q06_neighbourhood", f"WITH e AS ({_TREE}), u AS (SELECT src_id AS id, dst_id AS o FROM e UNION SELECT dst_id, src_id FROM e), one AS (SELECT DISTINCT o AS id FROM u WHERE id = 'n3'), two AS (SELECT DISTINCT u.o AS id FROM u JOIN one ON u.id = one.id WHERE u.o <> 'n3' AND u.o NOT IN (SELECT id FROM one)) SELECT 'n3' AS id, 0 AS distance UNION ALL SELECT id, 1 FROM one UNION ALL SELECT id, 2 FROM two")
def _(t):
    return G.neighbourhood(_tree(t), t.spark.createDataFrame([("n3",)], "id string"), 2)


@query("q07_integrity", "SELECT 'duplicate_ids' AS \"check\", 0 AS violations UNION ALL SELECT 'missing_c_name', count(*) - count(c_name) FROM customer UNION ALL SELECT 'broken_src_id', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'broken_dst_id', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'orphan_nodes', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) AND c_custkey NOT IN (SELECT o_orderkey FROM orders)")
def _(t):
    return G.integrity(t.customer, "c_custkey", ["c_name"], _orders_edges(t))


@query("q09_census", "SELECT 'node' AS kind, 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'node', 'part', count(*) FROM part UNION ALL SELECT 'edge', 'placed', count(*) FROM orders")
def _(t):
    return G.census({"customer": t.customer, "part": t.part}, {"placed": t.orders})


@query("q10_degrees", "SELECT l_partkey AS id, count(*) AS degree FROM lineitem GROUP BY 1 ORDER BY degree DESC, id LIMIT 25")
def _(t):
    return G.degrees(_line_edges(t), "dst_id", 25)


@query("q11_optional_counts", "SELECT n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS first, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS second FROM nation")
def _(t):
    return G.optional_counts(t.nation, "n_nationkey", t.customer.select(F.col("c_nationkey").alias("src_id"), F.col("c_custkey").alias("dst_id")), t.supplier.select(F.col("s_nationkey").alias("src_id"), F.col("s_suppkey").alias("dst_id")))


@query("q12_without_edge", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(t):
    return G.without_edge(t.customer.select("c_custkey"), "c_custkey", _orders_edges(t))


@query("q13_unwound", "SELECT word, count(DISTINCT p_partkey) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word, p_partkey FROM part) GROUP BY 1")
def _(t):
    return G.unwound(t.part.withColumn("w", F.split("p_name", " ")), "w", "word", "p_partkey")


@query("q15_fact_sentences", "SELECT 'HAS_BIOMARKER' AS kind, c_name || ' (' || c_custkey || ') can have the biomarker ' || c_mktsegment || ' (' || c_nationkey || ').' AS sentence FROM customer UNION ALL SELECT 'TESTED_BY', p_brand || ' is tested by ' || p_name || ' (code ' || p_partkey || ').' FROM part UNION ALL SELECT 'TARGETS', s_name || ' (' || s_suppkey || ') targets ' || s_nationkey || '; it works by -.' FROM supplier UNION ALL SELECT 'TREATED_BY', o_orderkey || ' is treated in line ' || o_custkey || ' with ' || o_orderstatus || ': ' || o_orderpriority || ', ' || o_orderstatus || ' (notice ' || o_orderpriority || ').' FROM orders")
def _(t):
    a = lambda df, **cols: df.select(*[F.col(v).alias(k) for k, v in cols.items()])
    return G.sentences({
        "HAS_BIOMARKER": a(t.customer, disease="c_name", disease_code="c_custkey", biomarker="c_mktsegment", biomarker_en="c_nationkey"),
        "TESTED_BY": a(t.part, biomarker="p_brand", test="p_name", test_code="p_partkey"),
        "TARGETS": a(t.supplier, drug="s_name", drug_code="s_suppkey", biomarker="s_nationkey").withColumn("mechanism", F.lit(None).cast("string")),
        "TREATED_BY": t.orders.select(F.col("o_orderkey").alias("disease"), F.col("o_custkey").alias("line"), F.col("o_orderstatus").alias("regimen_type"), F.array("o_orderstatus", "o_orderpriority").alias("drugs"), F.col("o_orderpriority").alias("notice")),
    })


@query("q16_nearest", "SELECT vec_id, round(score, 6) AS score FROM (SELECT vec_id, list_sum(CAST(embedding AS DOUBLE[])) AS score FROM embeddings) ORDER BY score DESC, vec_id LIMIT 10")
def _(t):
    return G.nearest(t.embeddings, "embedding", [1.0] * 64, 10, "vec_id").select("vec_id", F.round("score", 6).alias("score"))


@query("q17_distinct_members", "SELECT o_custkey, string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS members FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def _(t):
    j = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).withColumn("p", F.col("l_partkey").cast("string"))
    return G.distinct_members(j, ["o_custkey"], "p").select("o_custkey", F.array_join("members", ",").alias("members"))


@query("q18_search", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'red') ORDER BY p_name, p_partkey")
def _(t):
    return G.search_terms(t.part, "p_name", "red", 1 << 30).select("p_partkey", "p_name")
