"""Per-key choices, numbering, samples, ends and chunk plans (W, G and U operators).

Every choice names its order; ties are settled by the caller's key list, which must be total for
a stable result.
"""

from __future__ import annotations

import tempfile
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path below the session's checkpoint folder, which every executor sees; only a local session without one gets its own."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(at)
    return f"{at}/medgraph-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the session's checkpoint folder, which ends its lineage."""
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def first_by(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def longest_by(df: DataFrame, key: list[str], name: str, seq: str) -> DataFrame:
    """The longest name of every key, the earliest of equals."""
    return first_by(df, key, [F.length(name).desc(), F.col(seq)])


def number(df: DataFrame, prefix: str, order: list[str], name: str = "id", digits: int = 3) -> DataFrame:
    """PREFIX_001 ... over a total order.

    Numbers by range: rows are dealt to ranges and written once, each range numbers its own, and the
    counts of the ranges before (one row a range) are added, so no task sees all rows.
    """
    ranged = checkpointed(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    before = ranged.groupBy("_p").count().withColumn("_base", F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))).select("_p", F.coalesce("_base", F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    n = (own + F.col("_base")).cast("string")
    return ranged.join(F.broadcast(before), "_p").withColumn(name, F.concat(F.lit(prefix), F.lpad(n, F.greatest(F.length(n), F.lit(digits)), F.lit("0")))).drop("_p", "_base")


def top_k(df: DataFrame, key: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of every key, numbered."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col(rank) <= k)


def samples(df: DataFrame, key: list[str], order: list[Column], k: int, fields: list[str]) -> DataFrame:
    """The first k rows of every key as an ordered array."""
    return top_k(df, key, order, k, "_r").groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", *fields))), lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("samples"))


def range_ends(df: DataFrame, doc: list[str], start: str, total: str, end: str = "end") -> DataFrame:
    """The place before the next start; the last ends at total."""
    return df.withColumn(end, F.coalesce(F.lead(start).over(Window.partitionBy(*doc).orderBy(start)) - 1, total))


def running_share(df: DataFrame, part: list[str], order: list[Column], value: str) -> DataFrame:
    """Running total and its share of the partition's total."""
    w = Window.partitionBy(*part)
    run = F.sum(value).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("running", run).withColumn("share", F.try_divide("running", F.sum(value).over(w)))


def stitch_tables(segments: DataFrame, doc: str = "doc") -> DataFrame:
    """Segments on consecutive pages with equal columns, left edges within 5 % of the width and, if both have one, equal headers, as one table; repeated headers dropped."""
    w = Window.partitionBy(doc).orderBy("page_num", "table_idx")
    prev = F.lag(F.struct("page_num", "bbox", "rows", "has_header")).over(w)
    s = segments.withColumn("_prev", prev)
    width = F.abs(F.col("_prev.bbox.x1") - F.col("_prev.bbox.x0"))
    cols = lambda rows: F.coalesce(F.size(F.try_element_at(rows, F.lit(1))), F.lit(0))
    both = F.col("_prev.has_header") & F.col("has_header")
    equal_head = F.try_element_at("_prev.rows", F.lit(1)) == F.try_element_at("rows", F.lit(1))
    goes_on = (F.col("page_num") == F.col("_prev.page_num") + 1) & (F.abs(F.col("bbox.x0") - F.col("_prev.bbox.x0")) <= 0.05 * width) & (cols(F.col("rows")) == cols(F.col("_prev.rows"))) & (~both | equal_head)
    s = s.withColumn("_on", F.coalesce(goes_on, F.lit(False)))
    s = s.withColumn("table_no", F.sum((~F.col("_on")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    s = s.withColumn("_body", F.when(F.col("_on") & both, F.slice("rows", F.lit(2), F.greatest(F.size("rows") - 1, F.lit(0)))).otherwise(F.col("rows")))
    parts = F.array_sort(F.collect_list(F.struct("page_num", "table_idx", "_body")))
    return s.groupBy(doc, "table_no").agg(F.min("page_num").alias("first_page"), F.max("page_num").alias("last_page"), F.flatten(F.transform(parts, lambda x: x["_body"])).alias("rows"))


def alias_conflicts(df: DataFrame, ko: str = "ko", en: str = "en", seq: str = "seq") -> DataFrame:
    """Rows that name another English name than the first one that passed for their Korean name."""
    first = df.groupBy(F.col(ko).alias("_ko")).agg(F.min_by(F.struct(F.col(en).alias("en")), seq).alias("_f"))
    return df.join(first, F.col(ko).eqNullSafe(F.col("_ko"))).withColumn("first_en", F.col("_f.en")).withColumn("conflict", F.col(en) != F.col("first_en")).drop("_ko", "_f")


#: Places that one window of a scan sees at most.
SCAN = 1 << 15


def scanned(df: DataFrame, doc: list[str], line: str, last: dict[str, Column] | None = None, total: dict[str, Column] | None = None) -> DataFrame:
    """df with running columns over the whole places (0, 1, ...) of each document: the last value that was not null, and the sum so far.

    Two levels: windows over blocks of SCAN places, and over what each block ends with, one row a
    block; so a document of any length is many tasks, each of one block.  Null documents are one document.
    """
    last, total = last or {}, total or {}
    rows = df.withColumn("_blk", F.floor(F.col(line) / SCAN))
    so_far = Window.partitionBy(*doc, "_blk").orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.groupBy(*doc, "_blk").agg(*[F.max_by(c, F.when(c.isNotNull(), F.col(line))).alias(n) for n, c in last.items()], *[F.sum(c).alias(n) for n, c in total.items()])
    before = Window.partitionBy(*doc).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*[F.col(d).alias(f"_d{i}") for i, d in enumerate(doc)], F.col("_blk").alias("_b"), *[F.last(n, ignorenulls=True).over(before).alias(f"_c_{n}") for n in last], *[F.sum(n).over(before).alias(f"_c_{n}") for n in total])
    carried = carried.where("_b > 0")
    own = rows.withColumns({n: F.last(c, ignorenulls=True).over(so_far) for n, c in last.items()} | {n: F.sum(c).over(so_far) for n, c in total.items()})
    same = [F.col(d).eqNullSafe(F.col(f"_d{i}")) for i, d in enumerate(doc)]
    both = own.join(carried, [F.col("_blk") == F.col("_b"), *same], "left")
    full = {n: F.coalesce(n, f"_c_{n}") for n in last} | {n: F.col(n) + F.coalesce(f"_c_{n}", F.lit(0)) for n in total}
    return both.withColumns(full).drop("_blk", "_b", *[f"_d{i}" for i in range(len(doc))], *[f"_c_{n}" for n in [*last, *total]])


def carry_forward(df: DataFrame, doc: list[str], order: str, col: str) -> DataFrame:
    """The last value that was not null, over whole numbers in order (see scanned)."""
    return scanned(df.withColumnRenamed(col, "_value"), doc, order, {col: F.col("_value")}).select(*df.columns)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """N rows that depend on keys and seed only."""
    return df.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def page_chunks(df: DataFrame, most: int = 50) -> DataFrame:
    """(doc, section, start, end) ranges cut evenly into chunks of at most `most` pages."""
    pages = F.col("end") - F.col("start") + 1
    n = F.ceil(pages / most)
    size = F.ceil(pages / n)
    cut = df.withColumn("chunk", F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))))
    lo = F.col("start") + F.col("chunk") * size
    return cut.withColumn("chunk_start", lo.cast("int")).withColumn("chunk_end", F.least(lo + size - 1, F.col("end")).cast("int"))


def section_chunks(sections: DataFrame, subsections: DataFrame, doc: str, section: str, most: int = 50) -> DataFrame:
    """Chunks (doc, section, name, kind, chunk_start, chunk_end) of sections (doc, section, start, end): whole up to `most` pages, else one a subsection (doc, section, title, start), else cut evenly.

    A subsection ends before the next one starts, the last where its section ends.
    """
    pages = F.col("end") - F.col("start") + 1
    key = [doc, section]
    whole = sections.where(pages <= most).select(*key, F.col(section).alias("name"), F.lit("section").alias("kind"), F.col("start").alias("chunk_start"), F.col("end").alias("chunk_end"))
    long_ = sections.where(pages > most)
    parts = subsections.join(long_.select(*key, F.col("end").alias("_end")), key)
    parts = range_ends(parts, key, "start", "_end", "chunk_end").select(*key, F.concat_ws(" - ", F.col(section), F.col("title")).alias("name"), F.lit("subsection").alias("kind"), F.col("start").alias("chunk_start"), "chunk_end")
    even = page_chunks(long_.join(subsections.select(*key).distinct(), key, "left_anti"), most)
    even = even.select(*key, F.concat_ws(" Part ", F.col(section), (F.col("chunk") + 1).cast("string")).alias("name"), F.lit("split").alias("kind"), "chunk_start", "chunk_end")
    return whole.unionByName(parts).unionByName(even)


def greedy_chunks(df: DataFrame, most: int = 50, doc: str = "doc") -> DataFrame:
    """Neighbouring sections merged while they hold at most `most` pages; the running choice makes it a per-document step."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start", "end"])
        chunk, begin, out = -1, None, []
        for s, e in zip(pdf["start"], pdf["end"], strict=True):
            if begin is None or e - begin + 1 > most:
                chunk, begin = chunk + 1, s
            out.append(chunk)
        return pdf.assign(chunk=out)[[doc, "section", "start", "end", "chunk"]]

    return df.select(doc, "section", "start", "end").groupBy(doc).applyInPandas(run, df.select(doc, "section", "start", "end").schema.add("chunk", IntegerType()))


def key_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Every key of either side once: both, left or right."""
    x, y = a.select(key).distinct().withColumn("_a", F.lit(1)), b.select(key).distinct().withColumn("_b", F.lit(1))
    return x.join(y, key, "full").select(key, F.when(F.col("_b").isNull(), "left").when(F.col("_a").isNull(), "right").otherwise("both").alias("side"))


def append_absent(df: DataFrame, more: DataFrame, key: list[str]) -> DataFrame:
    """more's rows whose key df lacks, appended."""
    return df.unionByName(more.join(df.select(*key).distinct(), key, "left_anti"))


def merge_chunks(df: DataFrame, doc: str = "doc", order: str = "chunk", sep: str = "\n\n") -> DataFrame:
    """Contents of valid chunks in order, their elements, and how many failed."""
    ok = F.col("content").isNotNull()
    texts = F.array_sort(F.collect_list(F.when(ok, F.struct(order, "content"))))
    parts = F.array_sort(F.collect_list(F.when(ok, F.struct(F.col(order), F.coalesce("elements", F.array().cast("array<string>")).alias("elements")))))
    return df.groupBy(doc).agg(F.array_join(F.transform(texts, lambda x: x["content"]), sep).alias("content"), F.flatten(F.transform(parts, lambda x: x["elements"])).alias("elements"), F.count_if(~ok).alias("failed"))


def extend_dictionary(dictionary: DataFrame, variants: DataFrame, key: str = "key") -> DataFrame:
    """Variants (key, normalized_from) that the dictionary lacks, added and marked."""
    new = variants.join(dictionary.select(key).distinct(), key, "left_anti").dropDuplicates([key])
    return dictionary.withColumn("normalized_from", F.lit(None).cast("string")).withColumn("is_normalized", F.lit(False)).unionByName(new.withColumn("is_normalized", F.lit(True)), allowMissingColumns=True)


def concat_collections(*parts: DataFrame) -> DataFrame:
    """U4: rows of several collections under one another; columns that one lacks are null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
