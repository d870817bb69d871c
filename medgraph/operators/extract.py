"""One document to many rows (X operators), and the line-state parsers they share.

Documents are (doc_id, text) rows; null texts give no rows.  Where spans are wanted the pattern
runs in an Arrow batch function, since Spark reports matches without their places.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .joins import containments
from .ordering import scanned


def all_groups(text: Column, pattern: str, groups: list[int]) -> Column:
    """Array of structs g1, g2 ...: the groups of every match."""
    return F.arrays_zip(*[F.regexp_extract_all(text, F.lit(pattern), g).alias(f"g{g}") for g in groups])


def spans(df: DataFrame, patterns: dict[str, str], width: int = 30, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, name, surface, span_start, span_end, context of every match of every pattern."""
    compiled = {k: re.compile(p) for k, p in patterns.items()}
    names = [id_col, "name", "surface", "span_start", "span_end", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for k, p in compiled.items() if t else ():
                    out += [(i, k, m[0], m.start(), m.end(), t[max(0, m.start() - width) : m.end() + width].replace("\n", " ")) for m in p.finditer(t)]
            if out:
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return df.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, f"{id_col} long, name string, surface string, span_start int, span_end int, context string")


def bilingual_pairs(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(english, korean) of 한글 (English) and English (한글)."""
    ko_en = all_groups(F.col(text_col), r"([가-힣]{2,})\s*\(([A-Za-z][A-Za-z0-9\-]*)\)", [1, 2])
    en_ko = all_groups(F.col(text_col), r"([A-Za-z][A-Za-z0-9\-]*)\s*\(([가-힣]{2,})\)", [1, 2])
    first = df.select("*", F.inline(ko_en)).withColumnsRenamed({"g1": "korean", "g2": "english"})
    second = df.select("*", F.inline(en_ko)).withColumnsRenamed({"g1": "english", "g2": "korean"})
    return first.unionByName(second)


def mentions(df: DataFrame, word: str, least: int = 2, text_col: str = "text") -> DataFrame:
    """Distinct mentions of a pattern in each document."""
    found = F.filter(F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(word), 0)), lambda x: F.length(x) >= least)
    return df.withColumn("mention", F.explode(found))


def typed_mentions(df: DataFrame, patterns: dict[str, str], text_col: str = "text") -> DataFrame:
    """(kind, mention) of every match of several patterns, with repeats."""

    def found(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(F.col(text_col), F.lit(pattern), 0), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("mention")))

    arrays = [found(k, p) for k, p in patterns.items()]
    return df.select("*", F.inline(F.concat(*arrays)))


def aligned_cells(df: DataFrame, cells: list[str]) -> DataFrame:
    """The k-th lines of several multi-line cells as one row; shorter cells give nulls."""
    return df.select("*", F.posexplode(F.arrays_zip(*[F.split(c, "\n").alias(c + "_line") for c in cells])).alias("line", "_z")).select(*df.columns, "line", "_z.*")


def numbered_headings(df: DataFrame, text_col: str = "text") -> DataFrame:
    """[n] 한글(English) headings."""
    return df.select("*", F.inline(all_groups(F.col(text_col), r"\[(\d+)\]\s*([^\(\[\n]+)\(([^)\n]+)\)", [1, 2, 3]))).withColumnsRenamed({"g1": "number", "g2": "korean", "g3": "english"})


def lines(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.select(*[c for c in df.columns if c != text_col], F.posexplode(F.split(text_col, "\n")).alias("line", "content"))


def blocks(df: DataFrame, starts: Column, doc: str = "doc_id", order: str = "line", name: str = "block") -> DataFrame:
    """Block number that grows at every row where starts holds; 0 before the first.  order: whole numbers from 0; long documents are many tasks (see ordering.scanned)."""
    return scanned(df, [doc], order, total={name: F.coalesce(starts, F.lit(False)).cast("int")})


def markdown_rows(df: DataFrame, title: str, doc: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of markdown tables whose header holds title, as header-to-cell maps; short rows are padded, trailing footnote digits of the first cell dropped."""
    ls = lines(df, text_col).withColumn("is_row", F.trim("content").startswith("|"))
    w = Window.partitionBy(doc).orderBy("line")
    ls = ls.withColumn("_new", F.col("is_row") & ~F.coalesce(F.lag("is_row").over(w), F.lit(False)))
    ls = blocks(ls, F.col("_new"), doc).where("is_row")
    cells = F.transform(F.split(F.regexp_replace(F.trim("content"), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    ls = ls.withColumn("cells", cells)
    head = F.first("cells").over(Window.partitionBy(doc, "block").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ls = ls.withColumn("header", head).withColumn("row", F.row_number().over(Window.partitionBy(doc, "block").orderBy("line")))
    ls = ls.where(F.array_contains("header", title) | F.exists("header", lambda h: h.contains(title))).where((F.col("row") > 1) & ~F.col("content").rlike(r"^[\s|:\-]+$"))
    n = F.size("header")
    padded = F.slice(F.concat("cells", F.array_repeat(F.lit(""), n)), F.lit(1), n)
    cleaned = F.transform(padded, lambda x, i: F.when(i == 0, F.regexp_replace(x, r"\d+$", "")).otherwise(x))
    return ls.select(doc, "block", "row", F.map_from_arrays("header", cleaned).alias("cells"))


def restrictions(df: DataFrame, text_col: str = "text") -> DataFrame:
    """▪ category: description bullets and 주n. notes."""
    bullet = df.select("*", F.inline(all_groups(F.col(text_col), r"▪\s*([^:\n]+):\s*([^\n]+)", [1, 2]))).withColumn("kind", F.lit("bullet"))
    note = df.select("*", F.inline(all_groups(F.col(text_col), r"(?s)주\s*(\d+)\.\s*(.+?)(?=\n\s*주\s*\d+\.|\n\n|\z)", [1, 2]))).withColumn("kind", F.lit("note"))
    return bullet.unionByName(note).withColumnsRenamed({"g1": "category", "g2": "description"})


def questions(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Q. ... A. ... pairs."""
    return df.select("*", F.inline(all_groups(F.col(text_col), r"(?s)Q\d*[.:]\s*(.+?)\s*A\d*[.:]\s*(.+?)(?=\s*Q\d*[.:]|\z)", [1, 2]))).withColumnsRenamed({"g1": "question", "g2": "answer"})


def co_mentions(left: DataFrame, right: DataFrame, key: str = "doc_id") -> DataFrame:
    """X11: every left row with every right row of the same document."""
    return left.join(right, key)


def bullet_sections(df: DataFrame, bullet: str = r"^\s*(- |ㆍ)", doc: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sections that start at a bullet; text before the first bullet is dropped."""
    ls = blocks(lines(df, text_col), F.col("content").rlike(bullet), doc, name="section").where("section > 0")
    body = F.array_sort(F.collect_list(F.struct("line", "content")))
    return ls.groupBy(doc, "section").agg(F.array_join(F.transform(body, lambda x: x["content"]), "\n").alias("body"))


def first_in_lexicon(text: Column, lexicon: list[str], longest: bool = True) -> Column:
    """The longest lexicon word that occurs (ties in list order), or the first in list order."""
    words = sorted(lexicon, key=lambda w: -len(w)) if longest else lexicon
    return F.try_element_at(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(text, w)), F.lit(1))


def section_relations(sections: DataFrame, cancers: list[str], longest: bool = True) -> DataFrame:
    """Sections that name a cancer and at least one quoted drug: cancer, drugs, line of therapy, action."""
    quoted = F.flatten(F.transform(F.regexp_extract_all("body", F.lit(r"[‘']([^’'\n]+)[’']"), 1), lambda q: F.split(q, r"\s*\+\s*")))
    out = sections.withColumn("cancer", first_in_lexicon(F.col("body"), cancers, longest)).withColumn("drugs", F.array_distinct(F.transform(quoted, lambda x: F.trim(x))))
    line = F.nullif(F.regexp_extract("body", r"(\d)차", 1), F.lit("")).cast("int")
    action = F.when(F.col("body").contains("추가") | F.col("body").contains("신설"), "add").when(F.col("body").contains("삭제"), "remove").when(F.col("body").contains("변경"), "change")
    return out.where(F.col("cancer").isNotNull() & (F.size("drugs") > 0)).withColumn("therapy_line", line).withColumn("action", action)


def lexicon_hits(docs: DataFrame, lexicon: DataFrame, key: str = "doc_id", text_col: str = "text", term: str = "term") -> DataFrame:
    """(doc, term, position) of lexicon terms that occur in a text, also inside words and over each other, case ignored; position counts from 1.

    Both sides may be large (see joins.containments): a term meets the texts that hold its rarest
    gram, and a text is searched once for all of them.  Terms that differ in case alone give a row each.
    """
    lex = lexicon.select(F.col(term), F.lower(term).alias("_low")).distinct()
    texts = docs.select(key, F.lower(text_col).alias("_low_text"))
    hits = containments(texts, [key], "_low_text", lex, "_low", {"position": F.instr(F.col("_text"), F.col("_word"))})
    return hits.join(lex, F.col("_word") == F.col("_low")).select(key, term, "position").distinct()


def keyword_tags(df: DataFrame, tags: dict[str, list[str]], text_col: str = "text") -> DataFrame:
    """Every tag one of whose keywords occurs, in upper case."""
    up = F.upper(text_col)
    hit = [F.when(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(up, F.upper(w))), F.lit(tag)) for tag, words in tags.items()]
    return df.withColumn("tag", F.explode(F.array_compact(F.array(*hit))))


class _Page(HTMLParser):
    """Sections, tables and images of a page, without navigation."""

    SKIP = {"script", "style", "nav", "footer", "noscript"}
    VOID = {"img", "br", "meta", "link", "input", "hr"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.skip, self.sections, self.tables, self.images = 0, [], [], []
        self.head, self.row, self.cell = None, None, None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in self.SKIP:
            self.skip += 1
        elif self.skip:
            return
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.head = int(tag[1])
            self.sections.append([self.head, "", ""])
        elif tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            self.cell = []
        elif tag == "img" and a.get("src") and "icon" not in a["src"]:
            self.images.append((a["src"], a.get("alt") or ""))

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.head = None
        elif tag in ("td", "th") and self.cell is not None:
            self.tables[-1][-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data):
        if self.skip:
            return
        if self.cell is not None:
            self.cell.append(data)
        elif self.head is not None:
            self.sections[-1][1] += data
        elif self.sections:
            self.sections[-1][2] += data


def _by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Batches of ids and texts in bounded slices (see text.bounded_slices), so that a worker holds the parts of one slice only."""
    for b in batches:
        at = 0
        for texts in T.bounded_slices(b.column(1)):
            yield b.column(0).slice(at, len(texts)), texts
            at += len(texts)


def page_parts(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, sections array<struct<level,heading,text>>, tables array<array<array<string>>>, images array<struct<src,alt>>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sec, img = pa.list_(pa.struct([("level", pa.int32()), ("heading", pa.string()), ("text", pa.string())])), pa.list_(pa.struct([("src", pa.string()), ("alt", pa.string())]))
        for ids, pages in _by_size(batches):
            s, t, g = [], [], []
            for h in pages.to_pylist():
                p = _Page()
                p.feed(h or "")
                s.append([{"level": x[0], "heading": " ".join(x[1].split()), "text": " ".join(x[2].split())} for x in p.sections])
                t.append([[r for r in x if r] for x in p.tables])
                g.append([{"src": x[0], "alt": x[1]} for x in p.images])
            yield pa.RecordBatch.from_arrays([ids, pa.array(s, sec), pa.array(t, pa.list_(pa.list_(pa.list_(pa.string())))), pa.array(g, img)], [id_col, "sections", "tables", "images"])

    return df.select(F.col(id_col).cast("long"), html_col).mapInArrow(run, f"{id_col} long, sections array<struct<level:int,heading:string,text:string>>, tables array<array<array<string>>>, images array<struct<src:string,alt:string>>")


def code_pairs(tables: DataFrame, first: str, second: str) -> DataFrame:
    """Table rows whose first two cells match two code patterns."""
    rows = tables.select("*", F.posexplode("tables").alias("table_index", "_t")).select("*", F.explode("_t").alias("cells")).where(F.size("cells") >= 2)
    return rows.where(F.col("cells")[0].rlike(first) & F.col("cells")[1].rlike(second)).select(*[c for c in tables.columns if c not in ("tables", "sections", "images")], "table_index", F.col("cells")[0].alias("korean_code"), F.col("cells")[1].alias("english_code"))


def record_map(tables: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Two-cell rows of every table as one key/value map per page, first value of a key kept."""
    rows = tables.select(id_col, F.posexplode("tables").alias("t", "_t")).select(id_col, "t", F.posexplode("_t").alias("r", "c")).where(F.size("c") == 2)
    kept = rows.groupBy(id_col, F.col("c")[0].alias("k")).agg(F.min_by(F.col("c")[1], F.struct("t", "r")).alias("v"))
    return kept.groupBy(id_col).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("fields"))


def element_names(df: DataFrame, category: str, source: str) -> DataFrame:
    """Names in elements of a category with the sources that hold them."""
    e = df.select(source, F.inline("elements")).where(F.col("category") == category)
    return e.groupBy(F.col("text").alias("name")).agg(F.array_sort(F.collect_set(source)).alias("sources"))


def references(text: Column, pattern: str) -> Column:
    """Distinct references in a row's text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 0))


def outline(df: DataFrame, doc: str = "doc_id", text_col: str = "text") -> DataFrame:
    """X23: '* ' items with the path of the headings above; a heading clears the deeper ones."""
    ls = lines(df, text_col)
    level = F.when(F.col("content").startswith("#### "), 3).when(F.col("content").startswith("### "), 2).when(F.col("content").startswith("## "), 1)
    ls = ls.withColumn("level", level)
    title = F.trim(F.regexp_replace("content", "^#+ ", ""))
    ls = scanned(ls, [doc], "line", {f"_l{k}": F.when(F.col("level") == k, F.struct("line", title.alias("t"))) for k in (1, 2, 3)})
    p1, p2, p3 = (F.col(f"_l{k}") for k in (1, 2, 3))
    ok2 = p2.isNotNull() & (F.coalesce(p1["line"], F.lit(-1)) < p2["line"])
    ok3 = p3.isNotNull() & (F.coalesce(F.greatest(p1["line"], p2["line"]), F.lit(-1)) < p3["line"])
    path = F.array_compact(F.array(p1["t"], F.when(ok2, p2["t"]), F.when(ok3, p3["t"])))
    return ls.where(F.col("content").startswith("* ")).select(doc, "line", F.trim(F.regexp_replace("content", r"^\* ", "")).alias("item"), path.alias("path"))


def contents(df: DataFrame, doc: str = "doc_id", text_col: str = "text", last_page: Column | None = None) -> DataFrame:
    """Title .... page lines, with the page each entry ends on."""
    found = df.select(doc, *([last_page.alias("_last")] if last_page is not None else [F.lit(None).cast("int").alias("_last")]), F.inline(all_groups(F.col(text_col), r"(?m)^\s*(.+?)\s*[.·…]{3,}\s*(\d+)\s*$", [1, 2])))
    out = found.select(doc, "_last", F.col("g1").alias("title"), F.col("g2").cast("int").alias("page"))
    return out.withColumn("end_page", F.coalesce(F.lead("page").over(Window.partitionBy(doc).orderBy("page", "title")) - 1, "_last")).drop("_last")


def record_rows(df: DataFrame, rows: str = "rows") -> DataFrame:
    """Data rows of a segment as header-to-cell maps with their number."""
    head = F.element_at(rows, 1)
    body = df.select(*[c for c in df.columns if c != rows], head.alias("_h"), F.posexplode(F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))).alias("row_index", "_r"))
    n = F.size("_h")
    return body.withColumn("cells", F.map_from_arrays("_h", F.slice(F.concat("_r", F.array_repeat(F.lit(""), n)), F.lit(1), n))).drop("_h", "_r")


def paired_arrays(df: DataFrame, lead: str, other: str) -> DataFrame:
    """One row per element of lead with the element of other at its place, or null."""
    z = F.arrays_zip(F.col(lead).alias("a"), F.col(other).alias("b"))
    return df.select(*[c for c in df.columns if c not in (lead, other)], F.posexplode(z).alias("pos", "_z"), F.size(lead).alias("_n")).where("pos < _n").select(*[c for c in df.columns if c not in (lead, other)], "pos", F.col("_z.a").alias(lead), F.col("_z.b").alias(other))


def element_census(df: DataFrame, pattern: str) -> DataFrame:
    """Elements and pattern hits by category."""
    return df.select(F.inline("elements")).groupBy("category").agg(F.count("*").alias("elements"), F.sum(F.regexp_count("text", F.lit(pattern))).alias("hits"))


def nested_children(df: DataFrame, outer: str, inner: str, keep: Column | None = None) -> DataFrame:
    """Children two levels down with parent fields and position; keep filters the children."""
    one = df.select(*[c for c in df.columns if c != outer], F.explode(outer).alias("_p"))
    two = one.select(*[c for c in df.columns if c != outer], "_p", F.posexplode(F.col(f"_p.{inner}")).alias("child_index", "child"))
    return two.where(keep) if keep is not None else two
