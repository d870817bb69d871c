"""Statute texts to articles and references."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: How articles, clauses, subclauses and items begin.
ARTICLE = r"^제(\d+)조(?:의(\d+))?\s*\(([^)]+)\)\s*$"
CLAUSE = r"^([①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮])\s+"
SUBCLAUSE = r"^(\d+)\.\s+"
ITEM = r"^([가-힣])\.\s+"
#: How references to articles are written.
TARGET = r"제(\d+)조(?:의(\d+))?(?:제(\d+)항)?(?:제(\d+)호)?(?:([가-힣])목)?"
RELATIVE = r"같은\s+(법|조|항|호|목)\s*제(\d+)[조항호]?"
LAW_NAME = r"「([^」]+)」"


def _parts(df: DataFrame, lines: str, depth: int, head: str, text: str | None = None) -> DataFrame:
    """Rows in parts: their lines up to the first of this depth (head is null), then from each such line, the head, to before the next; text goes with the first part only."""
    a = F.col(lines)
    at = F.filter(F.transform(a, lambda x, i: F.when(x["depth"] == depth, i)), lambda i: i.isNotNull())
    spans = F.zip_with(F.concat(F.array(F.lit(-1)), at), F.concat(at, F.array(F.size(a))), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    fields = lambda x: [F.when(x["p"] >= 0, F.get(a, x["p"])).alias(head), F.slice(a, x["p"] + 2, x["q"] - x["p"] - 1).alias(lines)]
    first = lambda x: [F.when(x["p"] < 0, F.col(text)).alias(text)] if text else []
    return df.select(*[c for c in df.columns if c not in (lines, text)], F.inline(F.transform(spans, lambda x: F.struct(*fields(x), *first(x)))))


def articles(laws: DataFrame) -> DataFrame:
    """Laws (title, content) as rows of depth 0 to 3 with parent ids, cut in place into articles, clauses and subclauses: nothing is shuffled.

    The last article is kept even without a body.  Lines that begin nothing belong to the
    article's text.  Lines before the first article are dropped.  Laws are told apart by their title:
    an id is 32 bits of a digest, which laws may share.
    """
    depth = lambda c: F.when(c.rlike(ARTICLE), 0).when(c.rlike(CLAUSE), 1).when(c.rlike(SUBCLAUSE), 2).when(c.rlike(ITEM), 3)
    trimmed = laws.select(F.col("title").alias("law_name"), T.law_id(F.col("title")).alias("law_id"), F.transform(F.split("content", "\n"), lambda c: F.trim(c)).alias("_lines"))
    ls = trimmed.withColumn("_lines", F.transform("_lines", lambda c, i: F.struct(i.alias("line"), depth(c).alias("depth"), c.alias("content"))))
    ls = _parts(ls, "_lines", 0, "_s0").where("_s0 is not null")
    g = lambda c, p, i: F.nullif(F.regexp_extract(c, p, i), F.lit(""))
    number = F.concat_ws("_", T.zero_padded(g("_s0.content", ARTICLE, 1), 3), T.zero_padded(g("_s0.content", ARTICLE, 2), 2))
    # the text of an article meets its first line only
    plain = F.array_join(F.transform(F.filter("_lines", lambda x: x["depth"].isNull()), lambda x: x["content"]), "\n")
    ls = ls.select("law_name", "law_id", "_s0", number.alias("article_number"), g("_s0.content", ARTICLE, 3).alias("article_title"), (F.col("_s0.line") + F.size("_lines")).alias("_end"), plain.alias("_text"), F.filter("_lines", lambda x: x["depth"].isNotNull()).alias("_lines"))
    ls = _parts(_parts(ls, "_lines", 1, "_s1", "_text"), "_lines", 2, "_s2", "_text")
    # a part begins with its own line, an item is a part's other line
    own = lambda x, text: F.struct(x["line"].alias("line"), x["depth"].alias("depth"), x["content"].alias("content"), text.alias("text"))
    rows = F.concat(F.array(own(F.coalesce("_s2", "_s1", "_s0"), F.col("_text"))), F.transform("_lines", lambda x: own(x, F.lit(None).cast("string"))))
    ls = ls.withColumns({"_clause": T.circled(g("_s1.content", CLAUSE, 1)), "_sub": g("_s2.content", SUBCLAUSE, 1).cast("int")})
    ls = ls.select("law_name", "law_id", "article_number", "article_title", "_clause", "_sub", "_end", F.inline(rows))
    ls = ls.withColumn("_item", F.when(F.col("depth") == 3, g("content", ITEM, 1)))
    at = lambda d, c: F.when(F.col("depth") >= d, F.col(c))
    ident = lambda d: T.article_id(F.col("law_id"), F.col("article_number"), F.col("_clause") if d >= 1 else F.lit(None), F.col("_sub") if d >= 2 else F.lit(None), F.col("_item") if d >= 3 else F.lit(None))
    self_id = F.when(F.col("depth") == 0, ident(0)).when(F.col("depth") == 1, ident(1)).when(F.col("depth") == 2, ident(2)).otherwise(ident(3))
    up = F.when(F.col("depth") == 0, None).when((F.col("depth") == 1) | ((F.col("depth") == 2) & F.col("_clause").isNull()), ident(0)).when((F.col("depth") == 2) | F.col("_sub").isNull(), ident(1)).otherwise(ident(2))
    return ls.select("law_id", "law_name", self_id.alias("article_id"), "article_number", "article_title", "depth", up.alias("parent_article_id"), at(1, "_clause").alias("clause_number"), at(2, "_sub").alias("subclause_number"), at(3, "_item").alias("item_number"), F.when(F.col("depth") == 0, F.col("text")).otherwise(F.col("content")).alias("full_text"), F.col("line").alias("line_start"), F.when(F.col("depth") == 0, F.col("_end")).otherwise(F.col("line")).alias("line_end"))


#: Kinds of references and what marks them, in order; without a mark it is OTHER.
REFERENCE_TYPES = (("준용", r"[을를]\s*준용한다"), ("위임", r"에\s*따라|에서\s*정하는\s*바에\s*따라"), ("예외", r"에도\s*불구하고"), ("정의", r"정의|말한다"))
OTHER = "일반참조"
#: Fixed value: the kind of references to the same unit.
SAME_UNIT = "상대참조"
#: Kinds of laws that another law gives rise to.
DERIVED = ("시행령", "시행규칙")


def reference_type(context: Column) -> Column:
    """The first kind whose mark stands in the context."""
    out = None
    for kind, mark in REFERENCE_TYPES:
        out = F.when(context.rlike(mark), kind) if out is None else out.when(context.rlike(mark), kind)
    return out.otherwise(OTHER)


def references(arts: DataFrame, id_col: str = "article_id", text_col: str = "full_text", law_col: str = "law_name") -> DataFrame:
    """Cross-law 「law」 제n조, same-law 제n조 and relative 같은 법 제n references with spans and 50 characters around.

    A same-law match within ten characters after a closing 」 belongs to the cross-law one.  Same-law
    and relative rows have the article's own law as target law (null without law_col), which is every row's source_law_name; a relative one has
    its unit and number (same_unit, target_number) instead of an article, and always the type SAME_UNIT.

    What 같은 refers back to is carried along the text: antecedent_law_name is the law last named
    before a relative reference, or the own law, antecedent_article_number and antecedent_clause
    what was last referred to (a reference to an article ends the clause).
    """
    cross, same, relative, law = (re.compile(p) for p in (LAW_NAME + r"\s*" + TARGET, TARGET, RELATIVE, LAW_NAME))
    schema = "source_id string, source_law_name string, kind string, reference_text string, target_law_name string, number string, branch string, target_clause int, target_subclause int, target_item string, span_start int, span_end int, context string, same_unit string, target_number long, antecedent_law_name string, _number string, _branch string, antecedent_clause int"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [{"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[x.split()[1]] for x in schema.split(", ")]
    whole = lambda x: int(x) if x else None

    def found(text: str, own: str | None) -> Iterator[tuple]:
        """The fields after source_id of every reference."""
        marks = [(m.start(), 0, m) for m in law.finditer(text)] + [(m.start(), 1, m) for m in cross.finditer(text)]
        marks += [(m.start(), 2, m) for m in relative.finditer(text)] + [(m.start(), 3, m) for m in same.finditer(text)]
        last_law, article, clause = own, (None, None), None
        for start, what, m in sorted(marks, key=lambda x: x[:2]):
            around = text[max(0, start - 50) : m.end() + 50].replace("\n", " ")
            if what == 0:
                last_law = m[1]
            elif what == 2:
                yield ("relative", m[0], own, None, None, None, None, None, start, m.end(), around, m[1], int(m[2]), last_law, *article, clause)
            else:
                g = m.groups()[1:] if what == 1 else m.groups()
                if what == 1 or "」" not in text[max(0, start - 10) : start]:
                    yield ("cross_law" if what == 1 else "same_law", m[0], m[1] if what == 1 else own, g[0], g[1], whole(g[2]), whole(g[3]), g[4], start, m.end(), around, None, None, None, None, None, None)
                article, clause = (g[0], g[1]), whole(g[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(i, own, *x) for i, t, own in zip(*(c.to_pylist() for c in b.columns), strict=True) for x in found(t or "", own)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    own = F.col(law_col) if law_col in arts.columns else F.lit(None).cast("string")
    rows = arts.select(id_col, text_col, own.alias("_law")).mapInArrow(run, schema)
    padded = lambda n, b: F.nullif(F.concat_ws("_", T.zero_padded(F.col(n), 3), T.zero_padded(F.col(b), 2)), F.lit(""))
    kind = F.when(F.col("kind") == "relative", SAME_UNIT).otherwise(reference_type(F.col("context")))
    return rows.withColumns({"target_article_number": padded("number", "branch"), "antecedent_article_number": padded("_number", "_branch"), "reference_type": kind, "is_cross_law": F.col("kind") == "cross_law"}).drop("number", "branch", "_number", "_branch")


def meant_targets(refs: DataFrame) -> DataFrame:
    """Relative references with the law, article, clause and below that they mean by what they refer back to: 같은 법 제n (조), 같은 조 제n (항), 같은 항 제n (호); others as they are."""
    unit, n = F.col("same_unit"), F.col("target_number")
    at = lambda u, c: F.when(unit == u, c)
    return refs.withColumns({
        "target_law_name": F.when(unit.isNull(), F.col("target_law_name")).otherwise(F.col("antecedent_law_name")),
        "target_article_number": F.when(unit.isNull(), F.col("target_article_number")).otherwise(F.coalesce(at("법", T.zero_padded(n.cast("string"), 3)), F.when(unit != "법", F.col("antecedent_article_number")))),
        "target_clause": F.when(unit.isNull(), F.col("target_clause")).otherwise(F.coalesce(at("조", n.cast("int")), F.when(unit.isin("항", "호", "목"), F.col("antecedent_clause")))),
        "target_subclause": F.when(unit.isNull(), F.col("target_subclause")).otherwise(at("항", n.cast("int"))),
    })


def same_law_targets(refs: DataFrame, arts: DataFrame) -> DataFrame:
    """target_article_id of references by (target_law_id, target_article_number): the article, or below it the clause, subclause and item named, as an id that need not exist; null without such an article."""
    named = "law_name" in arts.columns and "target_law_name" in refs.columns  # laws may share an id
    law, name = F.col("law_id").alias("_law"), F.col("law_name" if named else "law_id").alias("_name")
    top = arts.where("depth = 0").groupBy(law, name, F.col("article_number").alias("_number")).agg(F.min("article_id").alias("_base"))
    same = (F.col("target_law_id") == F.col("_law")) & (F.col("target_law_name" if named else "target_law_id") == F.col("_name"))
    j = refs.join(top, same & (F.col("target_article_number") == F.col("_number")), "left")
    part = lambda p, c: F.when(F.col("target_clause").isNotNull(), F.concat(F.lit(p), F.col(c).cast("string")))
    named = F.concat_ws("_", "_base", part("C", "target_clause"), part("S", "target_subclause"), part("I", "target_item"))
    return j.withColumn("target_article_id", F.when(F.col("_base").isNotNull(), named)).drop("_law", "_name", "_number", "_base")


def tree_edges(arts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K9: HAS_ARTICLE (law, article) and HAS_CHILD (parent, child), with the law's name, as laws may share an id."""
    return (
        arts.where("depth = 0").select(F.col("law_id").alias("src_id"), F.col("article_id").alias("dst_id"), "law_name"),
        arts.where("parent_article_id is not null").select(F.col("parent_article_id").alias("src_id"), F.col("article_id").alias("dst_id"), "law_name"),
    )


def reference_edges(refs: DataFrame, arts: DataFrame | None = None) -> DataFrame:
    """Resolved references, one edge per (source, target, type, text); with arts, only to articles that exist.  Law names that refs have tell edges of laws apart that share an id."""
    laws = [c for c in ("source_law_name", "target_law_name") if c in refs.columns]
    e = refs.where("target_article_id is not null").select(F.col("source_id").alias("src_id"), F.col("target_article_id").alias("dst_id"), "reference_type", "reference_text", F.when(F.col("is_cross_law"), "CROSS_LAW_REFERS_TO").otherwise("REFERS_TO").alias("edge_type"), *laws).distinct()
    if arts is None:
        return e
    name = [F.col("law_name").alias("target_law_name")] if "target_law_name" in laws and "law_name" in arts.columns else []
    known = arts.select(F.col("article_id").alias("dst_id"), *name).distinct()
    return e.join(known, known.columns, "left_semi")


def derived_from_edges(laws: DataFrame, title: str = "title") -> DataFrame:
    """DERIVED_FROM edges (src_id, dst_id, relationship_type, edge_type) from decrees and rules to the law whose name is theirs without the last word; laws without such a parent have none."""
    kind = F.regexp_extract(title, f"({'|'.join(DERIVED)})$", 1)
    named = laws.select(F.col(title).alias("name"), T.law_id(F.col(title)).alias("id"), F.nullif(kind, F.lit("")).alias("kind")).where("name is not null").distinct()
    base = F.trim(F.regexp_replace("name", f"({'|'.join(DERIVED)})$", ""))
    child = named.where("kind is not null").select(F.col("id").alias("src_id"), F.col("kind").alias("relationship_type"), base.alias("_base"))
    parent = named.where("kind is null").select(F.col("name").alias("_base"), F.col("id").alias("dst_id"))
    return child.join(parent, "_base").select("src_id", "dst_id", "relationship_type", F.lit("DERIVED_FROM").alias("edge_type"))


def reference_report(refs: DataFrame) -> DataFrame:
    """Q8: (is_cross_law, parsed, linked, unlinked) of references with target_article_id."""
    linked = F.count("target_article_id")
    return refs.groupBy("is_cross_law").agg(F.count("*").alias("parsed"), linked.alias("linked"), (F.count("*") - linked).alias("unlinked"))


def top_targets(refs: DataFrame, k: int = 20) -> DataFrame:
    """Q8: the k laws that cross-law references name most often, ties by name."""
    return refs.where("is_cross_law").groupBy("target_law_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "target_law_name").limit(k)
