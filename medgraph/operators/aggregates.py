"""Aggregations (A operators): lists are sorted, "first" is the smallest by a stated order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_lists(df: DataFrame, key: list[str], seq: str, firsts: list[str], lists: list[str]) -> DataFrame:
    """A1, A2: first value by seq, sorted distinct lists and their sizes."""
    return df.groupBy(*key).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in firsts],
        *[F.array_sort(F.collect_set(c)).alias(c + "_list") for c in lists],
        *[F.size(F.collect_set(c)).alias(c + "_count") for c in lists],
    )


def positive_stats(df: DataFrame, key: list[str], value: str, maker: str) -> DataFrame:
    """A3: rows, distinct makers, least and largest positive value (0 if none)."""
    pos = F.when(F.col(value) > 0, F.col(value))
    return df.groupBy(*key).agg(F.count("*").alias("products"), F.countDistinct(maker).alias("makers"), F.coalesce(F.min(pos), F.lit(0.0)).alias("min_value"), F.coalesce(F.max(pos), F.lit(0.0)).alias("max_value"))


def frequencies(df: DataFrame, key: list[str], k: int | None = None) -> DataFrame:
    """Counts, most first, ties by key; the first k if asked."""
    out = df.groupBy(*key).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), *key).limit(k) if k else out


def match_rates(df: DataFrame, kind: str, value: str, weight: str | None = None) -> DataFrame:
    """Occurrences (or the sum of a weight: rows that stand for so many) and distinct values by kind with their shares."""
    times = F.count("*") if weight is None else F.sum(weight)
    g = df.groupBy(kind).agg(times.alias("occurrences"), F.countDistinct(value).alias("distinct_values"))
    w = Window.partitionBy()
    return g.withColumn("occurrence_share", F.try_divide("occurrences", F.sum("occurrences").over(w))).withColumn("distinct_share", F.try_divide("distinct_values", F.sum("distinct_values").over(w)))


def text_stats(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """Documents, characters, average, least and largest length."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    return df.groupBy(*key).agg(F.count("*").alias("documents"), F.sum(n).alias("chars"), F.avg(n).alias("avg_chars"), F.min(n).alias("min_chars"), F.max(n).alias("max_chars"))


def pair_counts(df: DataFrame, pair: list[str], seq: str, context: str) -> DataFrame:
    """How often a pair occurs, and its first context."""
    return df.groupBy(*pair).agg(F.count("*").alias("n"), F.min_by(context, seq).alias("first_context"))


def choose_alias(df: DataFrame, alias: str, target: str, verified: str) -> DataFrame:
    """All targets of an alias and the one to use: verified first, then the shortest, then the smallest."""
    best = F.min_by(target, F.struct((~F.col(verified)).cast("int"), F.length(target), F.col(target)))
    return df.groupBy(alias).agg(F.array_sort(F.collect_set(target)).alias("targets"), best.alias("target"))


def inverted_index(df: DataFrame, key: str, variants: Column, owner: str) -> DataFrame:
    """Variant, its owners sorted, and whether it is ambiguous."""
    v = df.select(F.explode(variants).alias(key), owner).distinct()
    return v.groupBy(key).agg(F.array_sort(F.collect_set(owner)).alias("owners")).withColumn("ambiguous", F.size("owners") > 1)


def bidirectional_aliases(manual: DataFrame, auto: DataFrame, a: str, b: str) -> DataFrame:
    """A10: a's b (manual before automatic, then smallest) and b's sorted list of a."""
    both = manual.select(a, b, F.lit(0).alias("_p")).unionByName(auto.select(a, b, F.lit(1).alias("_p")))
    forward = both.groupBy(a).agg(F.min_by(b, F.struct("_p", b)).alias(b))
    return forward.join(both.groupBy(b).agg(F.array_sort(F.collect_set(a)).alias("all_" + a)), b)


def many_owned(df: DataFrame, key: str, owner: str, least: int = 2) -> DataFrame:
    """Keys with at least that many distinct owners."""
    return df.groupBy(key).agg(F.countDistinct(owner).alias("owners")).where(F.col("owners") >= least)


def code_sets(df: DataFrame, key: str, codes: list[str]) -> DataFrame:
    """Sorted distinct codes and true counts."""
    return df.groupBy(key).agg(F.count("*").alias("total"), *[F.array_sort(F.collect_set(c)).alias(c + "s") for c in codes])


def two_source_rollup(a: DataFrame, b: DataFrame, key: str, va: str, vb: str) -> DataFrame:
    """Lists of both sides with counts and where the key comes from."""
    x = a.groupBy(key).agg(F.array_sort(F.collect_set(va)).alias("left_list"))
    y = b.groupBy(key).agg(F.array_sort(F.collect_set(vb)).alias("right_list"))
    none = lambda c, df: F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType)).alias(c)
    j = x.join(y, key, "full")
    source = F.when(F.col("left_list").isNull(), "right").when(F.col("right_list").isNull(), "left").otherwise("both")
    return j.select(key, none("left_list", x), none("right_list", y), source.alias("source")).withColumn("left_count", F.size("left_list")).withColumn("right_count", F.size("right_list"))


def prefix_stats(df: DataFrame, code: str, n: int = 1) -> DataFrame:
    """Rows by code prefix."""
    return df.groupBy(F.substring(code, 1, n).alias("prefix")).agg(F.count("*").alias("codes"))


def tiers(df: DataFrame, key: str, cuts: tuple[int, int, int] = (20, 10, 5)) -> DataFrame:
    """Keys tiered by rows: per tier keys, rows, average and share of all rows."""
    per = df.groupBy(key).agg(F.count("*").alias("n"))
    n = F.col("n")
    t = per.withColumn("tier", F.when(n >= cuts[0], 1).when(n >= cuts[1], 2).when(n >= cuts[2], 3).otherwise(4))
    g = t.groupBy("tier").agg(F.count("*").alias("keys"), F.sum("n").alias("rows"), F.avg("n").alias("average"))
    return g.withColumn("coverage", F.try_divide("rows", F.sum("rows").over(Window.partitionBy())))


def by_path(df: DataFrame, path: str, seq: str, name: str) -> DataFrame:
    """Documents grouped by their path array: path, document_count, documents (seq, name) by seq."""
    return df.groupBy(path).agg(F.count("*").alias("document_count"), F.array_sort(F.collect_list(F.struct(seq, name))).alias("documents"))


def value_distribution(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """For each of several columns, its values with rows, least, mean and largest of a number: (column, value, n, least, mean, most)."""
    out = None
    for c in by:
        d = df.groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n"), F.min(value).alias("least"), F.avg(value).alias("mean"), F.max(value).alias("most"))
        d = d.select(F.lit(c).alias("column"), "value", "n", "least", "mean", "most")
        out = d if out is None else out.unionByName(d)
    return out


def transitions(df: DataFrame, old: str, new: str) -> DataFrame:
    """Counts by (old, new)."""
    return df.groupBy(old, new).agg(F.count("*").alias("n"))


def completeness(df: DataFrame, code: Column, missing: Column) -> DataFrame:
    """Rows, rows with a code, rows with nothing missing, rows with both."""
    c, m = F.coalesce(code, F.lit(False)), F.coalesce(missing == 0, F.lit(True))
    return df.agg(F.count("*").alias("rows"), F.count_if(c).alias("with_code"), F.count_if(m).alias("with_all"), F.count_if(c & m).alias("complete"))


def by_label(df: DataFrame, label: str, unit: str) -> DataFrame:
    """Rows and distinct units by label, null as 'unknown'."""
    return df.groupBy(F.coalesce(label, F.lit("unknown")).alias(label)).agg(F.count("*").alias("n"), F.countDistinct(unit).alias("units"))


def reason_counts(df: DataFrame, reasons: str, k: int = 10) -> DataFrame:
    """The k most common reasons."""
    return frequencies(df.select(F.explode(reasons).alias("reason")), ["reason"], k)


def array_totals(df: DataFrame, arrays: list[str]) -> DataFrame:
    """Total elements of array columns."""
    return df.agg(*[F.sum(F.coalesce(F.size(a), F.lit(0))).alias(a) for a in arrays])


def nested_counts(df: DataFrame, key: str, sub: str) -> DataFrame:
    """Per key an array of (sub, count) in sub order."""
    per = df.groupBy(key, sub).agg(F.count("*").alias("n"))
    return per.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(sub, "n"))).alias("counts"))


def ratio_of_counts(a: DataFrame, b: DataFrame, key: str, digits: int = 2) -> DataFrame:
    """Rows of a over rows of b per key."""
    x, y = a.groupBy(key).agg(F.count("*").alias("_x")), b.groupBy(key).agg(F.count("*").alias("_y"))
    return y.join(x, key, "left").select(key, F.round(F.coalesce("_x", F.lit(0)) / F.col("_y"), digits).alias("ratio"))


def coverage(df: DataFrame, col: str) -> DataFrame:
    """Percentage of rows with a non-empty value."""
    return df.agg((F.avg(F.when(F.coalesce(F.length(F.trim(F.col(col).cast("string"))) > 0, F.lit(False)), 1.0).otherwise(0.0)) * 100).alias("coverage"))
