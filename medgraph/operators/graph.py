"""Graph tables and graph queries (K and Q operators): nodes keyed by id, edges (src_id, dst_id, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import classed, expanded, prefix_expand
from .ordering import checkpointed, first_by


def upsert(old: DataFrame, new: DataFrame, key: str, keep_old: bool = True, status: bool = False) -> DataFrame:
    """K1 (keep_old: non-null old values stay), K2 (new values win): nodes of both, optionally with status created, updated or unchanged.  Neither side may repeat a key."""
    fields = [c for c in old.columns if c != key]
    a, b = old.select(key, F.struct(*fields).alias("_o")), new.select(key, F.struct(*fields).alias("_n"))
    j = a.join(b, key, "full")
    pick = (lambda c: F.coalesce(f"_o.{c}", f"_n.{c}")) if keep_old else (lambda c: F.coalesce(f"_n.{c}", f"_o.{c}"))
    state = [F.when(F.col("_o").isNull(), "created").when(F.col("_n").isNull(), "unchanged").otherwise("updated").alias("status")] if status else []
    return j.select(key, *[pick(c).alias(c) for c in fields], *state)


def edges(df: DataFrame, src: str, targets: str, src_nodes: DataFrame, dst_nodes: DataFrame, src_key: str, dst_key: str, props: list[str] = []) -> DataFrame:  # noqa: B006
    """K4: edges to every element of an array; those with a missing end vanish."""
    e = df.select(F.col(src).alias("src_id"), F.explode(targets).alias("dst_id"), *props)
    e = e.join(src_nodes.select(F.col(src_key).alias("src_id")).distinct(), "src_id", "left_semi")
    return e.join(dst_nodes.select(F.col(dst_key).alias("dst_id")).distinct(), "dst_id", "left_semi").select("src_id", "dst_id", *props)


def prefix_edges(df: DataFrame, src: str, codes: str, master: DataFrame, code: str) -> DataFrame:
    """K5: edges to every master code equal to or below a row's codes."""
    e = df.select(F.col(src).alias("src_id"), F.explode(codes).alias("_e"))
    return prefix_expand(e, master.select(code), "_e", code).select("src_id", F.col(code).alias("dst_id")).distinct()


def merge_edges(e: DataFrame, order: list[Column], key: tuple[str, ...] = ("src_id", "dst_id")) -> DataFrame:
    """K6: one edge per key, the first properties kept."""
    return first_by(e, list(key), order)


def inferred_edges(a: DataFrame, b: DataFrame, types: DataFrame) -> DataFrame:
    """K7: a.src -> b.src through a shared end, where one of the middle node's type names occurs in b's name.  a: (src_id, mid); b: (mid, dst_id, name); types: (mid, names).

    Sources with equal middles and targets reached from equal middles share a class (see joins.classed), so
    edges are made distinct as pairs of classes.
    """
    reached = b.join(types, "mid").where(F.exists("names", lambda t: F.contains(F.col("name"), t)))
    mids = lambda df, id_col, name: df.where("mid is not null").groupBy(id_col).agg(F.array_sort(F.collect_set("mid")).alias(name))
    sources, of_a = classed(mids(a, "src_id", "_am"), "src_id", ["_am"], "_ca")
    targets, of_b = classed(mids(reached, "dst_id", "_bm"), "dst_id", ["_bm"], "_cb")
    pairs = of_a.select("_ca", F.explode("_am").alias("mid")).join(of_b.select("_cb", F.explode("_bm").alias("mid")), "mid").select("_ca", "_cb").distinct()
    return expanded(sources, targets, pairs, "_ca", "_cb").select("src_id", "dst_id")


def code_hierarchy(codes: DataFrame, ranges: DataFrame) -> DataFrame:
    """K8: IS_A edges from detailed codes to categories and from categories to the block that holds them.  ranges: code, chapter, lo, hi."""
    detail = codes.where(F.col("code").contains(".")).select(F.col("code").alias("src_id"), F.substring_index("code", ".", 1).alias("dst_id")).join(codes.select(F.col("code").alias("dst_id")), "dst_id", "left_semi").select("src_id", "dst_id")
    cat = codes.where(F.col("code").rlike(r"^[A-Z]\d{2}$")).select("code", F.substring("code", 1, 1).alias("chapter"), F.substring("code", 2, 2).cast("int").alias("n"))
    filled = ranges.select(F.col("code").alias("dst_id"), "chapter", F.explode(F.sequence("lo", "hi")).alias("n"))
    block = first_by(cat.join(filled, ["chapter", "n"]), ["code"], [F.col("dst_id")]).select(F.col("code").alias("src_id"), "dst_id")
    return detail.unionByName(block)


def delete_labels(nodes: DataFrame, e: DataFrame, labels: list[str] | None, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """What is left of nodes (with a label column) and edges when the nodes of some labels, or all of them, go before a reload; edges that lose an end go too."""
    if labels is None:
        return nodes.limit(0), e.limit(0)
    left = nodes.where(~F.coalesce(F.col("label").isin(labels), F.lit(False)))
    ids = left.select(F.col(key).alias("_id")).distinct()
    kept = e.join(ids, F.col("src_id") == F.col("_id"), "left_semi").join(ids, F.col("dst_id") == F.col("_id"), "left_semi")
    return left, kept


def mapping_edges(nodes: DataFrame, key: str, systems: dict[str, str]) -> DataFrame:
    """MAPS_TO_x edges from code columns."""
    out = None
    for edge, col in systems.items():
        e = nodes.where(F.col(col).isNotNull()).select(F.col(key).alias("src_id"), F.col(col).alias("dst_id"), F.lit(edge).alias("edge_type"))
        out = e if out is None else out.unionByName(e)
    return out


# --- queries ------------------------------------------------------------------------------------


def lookup(nodes: DataFrame, equal: dict, present: list[str], order: list[Column], k: int) -> DataFrame:
    """Q1: the first k nodes by order whose columns equal the given values and whose present columns are not null."""
    out = nodes
    for c, v in equal.items():
        out = out.where(F.col(c) == v)
    for c in present:
        out = out.where(F.col(c).isNotNull())
    return out.orderBy(*order).limit(k)


def one_hop(e: DataFrame, src: DataFrame, dst: DataFrame, src_key: str, dst_key: str) -> DataFrame:
    """Q2: edges with the properties of both ends (columns prefixed src_ and dst_)."""
    a = src.select(F.col(src_key).alias("src_id"), *[F.col(c).alias("src_" + c) for c in src.columns if c != src_key])
    b = dst.select(F.col(dst_key).alias("dst_id"), *[F.col(c).alias("dst_" + c) for c in dst.columns if c != dst_key])
    return e.join(a, "src_id").join(b, "dst_id")


def path(*steps: DataFrame) -> DataFrame:
    """Q3: fixed paths over edge tables; n0, n1, ... are the nodes."""
    out = steps[0].select(F.col("src_id").alias("n0"), F.col("dst_id").alias("n1"))
    for i, s in enumerate(steps[1:], 1):
        out = out.join(s.select(F.col("src_id").alias(f"n{i}"), F.col("dst_id").alias(f"n{i + 1}")), f"n{i}")
    return out.select(*[f"n{i}" for i in range(len(steps) + 1)])


def nearest_forks(one: DataFrame) -> DataFrame:
    """(node, top, away): for nodes with one parent, their nearest ancestor without an own row in `one`, and how far it is.

    one: (node, up).  Every round doubles how far each node sees, so their number is logarithmic in
    the depth; what is open when all rows could have been passed is on, or hangs from, a cycle that
    nothing leads into, and is left out.
    """
    inner = one.select(F.col("node").alias("up"), F.lit(True).alias("_inner"))
    ptr = checkpointed(one.join(inner, "up", "left").select("node", F.col("up").alias("top"), F.lit(1).cast("long").alias("away"), F.coalesce("_inner", F.lit(False)).alias("open")))
    seen, most = 1, ptr.count()
    while seen <= most and not ptr.where("open").isEmpty():
        of = ptr.select(F.col("node").alias("top"), F.col("top").alias("_top"), F.col("away").alias("_away"), F.col("open").alias("_open"))
        further = ptr.where("open").join(of, "top").select("node", F.col("_top").alias("top"), (F.col("away") + F.col("_away")).alias("away"), F.col("_open").alias("open"))
        ptr = checkpointed(ptr.where("not open").unionByName(further))
        seen *= 2
    return ptr.where("not open").select("node", "top", "away")


def descend(e: DataFrame, roots: DataFrame, most: int | None = None) -> DataFrame:
    """Q4: (root, node, depth) of every node below the roots (column id), at its least depth, however deep, or down to depth `most` if one is asked for; a root that a cycle leads back to is below itself.  Null ends lead nowhere.

    Nodes with one parent are found from their nearest fork, a root or a node with several parents, by
    pointer doubling (see nearest_forks).  Only forks are walked to, over edges as long as the
    way between them, from what the step before found or found nearer; so the steps are as
    many as there are forks on the way, not levels.  Every step is checkpointed.
    """
    step = checkpointed(e.select(F.col("src_id").alias("up"), F.col("dst_id").alias("node")).where("up is not null and node is not null").distinct())
    starts = checkpointed(roots.select(F.col("id").alias("node")).where("node is not null").distinct())
    several = step.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node").unionByName(starts).distinct()
    tops = checkpointed(nearest_forks(step.join(several, "node", "left_anti").select("node", "up")))
    above = tops.withColumnsRenamed({"node": "up", "top": "_top", "away": "_away"})
    to_forks = step.join(several, "node", "left_semi").join(above, "up", "left")
    ways = checkpointed(to_forks.select(F.coalesce("_top", "up").alias("top"), "node", (F.coalesce("_away", F.lit(0)) + 1).alias("away")).groupBy("top", "node").agg(F.min("away").alias("away")))
    front = starts.select(F.col("node").alias("root"), F.col("node").alias("top"), F.lit(0).cast("long").alias("depth"))
    found = None
    while True:
        near = front.join(ways, "top").groupBy("root", "node").agg(F.min(F.col("depth") + F.col("away")).alias("depth"))
        if found is not None:
            known = found.select("root", "node", F.col("depth").alias("_known"))
            near = near.join(known, ["root", "node"], "left").where("_known is null or depth < _known").drop("_known")
        near = checkpointed(near)
        if near.isEmpty():
            break
        found = near if found is None else checkpointed(found.unionByName(near).groupBy("root", "node").agg(F.min("depth").alias("depth")))
        front = near.withColumnRenamed("node", "top")
    begun = starts.select(F.col("node").alias("root"), F.col("node").alias("top"), F.lit(0).cast("long").alias("depth"))
    forks = begun if found is None else begun.unionByName(found.select("root", F.col("node").alias("top"), "depth").where("root <> top"))
    below = forks.join(tops, "top").select("root", "node", (F.col("depth") + F.col("away")).alias("depth"))
    below = below if found is None else below.unionByName(found)
    below = below if most is None else below.where(F.col("depth") <= most)
    return below.select("root", "node", F.col("depth").cast("int").alias("depth"))


def chains(e: DataFrame, least: int = 2, most: int = 3) -> DataFrame:
    """Q5: directed chains of least to most different edges, as node arrays."""
    out, cur = None, e.select(F.array("src_id", "dst_id").alias("nodes"), F.col("dst_id").alias("_end"))
    for k in range(2, most + 1):
        cur = cur.join(e.select(F.col("src_id").alias("_end"), F.col("dst_id").alias("_next")), "_end")
        fresh = F.lit(True)
        for i in range(1, k):
            fresh = fresh & ~((F.element_at("nodes", i) == F.col("_end")) & (F.element_at("nodes", i + 1) == F.col("_next")))
        cur = cur.where(fresh).select(F.array_append("nodes", F.col("_next")).alias("nodes"), F.col("_next").alias("_end"))
        if k >= least:
            out = cur.select("nodes") if out is None else out.unionByName(cur.select("nodes"))
    return out


def neighbourhood(e: DataFrame, seeds: DataFrame, depth: int = 2, types: list[str] | None = None) -> DataFrame:
    """Q6: (id, distance) of nodes within depth steps of the seeds, edges read both ways."""
    if types:
        e = e.where(F.col("edge_type").isin(types))
    both = e.select(F.col("src_id").alias("id"), F.col("dst_id").alias("other")).unionByName(e.select(F.col("dst_id").alias("id"), F.col("src_id").alias("other"))).distinct()
    seen = seeds.select("id").distinct().withColumn("distance", F.lit(0))
    front = seen.select("id")
    for d in range(1, depth + 1):
        front = front.join(both, "id").select(F.col("other").alias("id")).distinct().join(seen, "id", "left_anti")
        seen = seen.unionByName(front.withColumn("distance", F.lit(d)))
    return seen


def integrity(nodes: DataFrame, key: str, required: list[str], e: DataFrame, parents: str | None = None, depth: str | None = None) -> DataFrame:
    """Q7: (check, violations): duplicate ids, missing required values, broken ends, orphan nodes, and depth not one below the parent's."""
    ids = nodes.select(F.col(key).alias("id"))
    count = lambda df, name: df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
    out = count(ids.groupBy("id").count().where("count > 1"), "duplicate_ids")
    for c in required:
        out = out.unionByName(count(nodes.where(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")), f"missing_{c}"))
    for end in ("src_id", "dst_id"):
        out = out.unionByName(count(e.select(F.col(end).alias("id")).join(ids, "id", "left_anti"), f"broken_{end}"))
    touched = e.select(F.col("src_id").alias("id")).unionByName(e.select(F.col("dst_id").alias("id"))).distinct()
    out = out.unionByName(count(ids.join(touched, "id", "left_anti"), "orphan_nodes"))
    if parents and depth:
        up = nodes.select(F.col(key).alias("_p"), F.col(depth).alias("_d"))
        out = out.unionByName(count(nodes.where(F.col(parents).isNotNull()).join(up, F.col(parents) == F.col("_p"), "left").where(F.col("_d").isNull() | (F.col(depth) <= F.col("_d"))), "depth_inversion"))
    return out


def census(nodes: dict[str, DataFrame], edge_tables: dict[str, DataFrame]) -> DataFrame:
    """Q8, Q9: rows by label and edge type."""
    out = None
    for kind, tables in (("node", nodes), ("edge", edge_tables)):
        for name, df in tables.items():
            c = df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), F.lit(name).alias("name"), "n")
            out = c if out is None else out.unionByName(c)
    return out


def degrees(e: DataFrame, end: str, k: int | None = None) -> DataFrame:
    """Q10: nodes by number of edges, most first, ties by id."""
    out = e.groupBy(F.col(end).alias("id")).agg(F.count("*").alias("degree")).orderBy(F.desc("degree"), "id")
    return out.limit(k) if k else out


def optional_counts(nodes: DataFrame, key: str, e1: DataFrame, e2: DataFrame) -> DataFrame:
    """Q11: distinct targets of two edge types per node, 0 without any; each side is counted before it is joined."""
    c = lambda e, name: e.groupBy(F.col("src_id").alias(key)).agg(F.countDistinct("dst_id").alias(name))
    return nodes.select(key).join(c(e1, "first"), key, "left").join(c(e2, "second"), key, "left").na.fill(0, ["first", "second"])


def without_edge(nodes: DataFrame, key: str, e: DataFrame, end: str = "src_id") -> DataFrame:
    """Q12: nodes without an edge."""
    return nodes.join(e.select(F.col(end).alias(key)).distinct(), key, "left_anti")


def unwound(df: DataFrame, arr: str, name: str, unit: str) -> DataFrame:
    """Q13: distinct units by array element."""
    return df.select(F.explode(arr).alias(name), unit).groupBy(name).agg(F.countDistinct(unit).alias("n"))


#: Q14: parameterised queries over temporary views nodes(id, label, name) and edges(src_id, dst_id, edge_type).
QUERY_TEMPLATES = {
    "by_name": "SELECT id, label, name FROM nodes WHERE lower(name) LIKE '%' || lower(:name) || '%' ORDER BY name, id",
    "neighbours": "SELECT e.edge_type, n.id, n.name FROM edges e JOIN nodes n ON n.id = e.dst_id WHERE e.src_id = :id ORDER BY 1, 2",
    "incoming": "SELECT e.edge_type, n.id, n.name FROM edges e JOIN nodes n ON n.id = e.src_id WHERE e.dst_id = :id ORDER BY 1, 2",
    "between": "SELECT e1.dst_id AS via FROM edges e1 JOIN edges e2 ON e1.dst_id = e2.src_id WHERE e1.src_id = :src AND e2.dst_id = :dst ORDER BY 1",
    "label_counts": "SELECT label, count(*) AS n FROM nodes WHERE label = :label GROUP BY label",
}


def ask(spark: SparkSession, template: str, nodes: DataFrame, e: DataFrame, **args) -> DataFrame:
    """Q14: the rows of a named template; the tables are bound to the query, no view of the session is touched."""
    sql = QUERY_TEMPLATES[template].replace("FROM nodes", "FROM {nodes}").replace("JOIN nodes", "JOIN {nodes}").replace("FROM edges", "FROM {edges}").replace("JOIN edges", "JOIN {edges}")
    used = {k: v for k, v in (("nodes", nodes), ("edges", e)) if "{" + k + "}" in sql}
    return spark.sql(sql, args=args, **used)


def fact_sentences(e: DataFrame, pattern: str, cols: list[str]) -> DataFrame:
    """Q15: a sentence per edge by one pattern."""
    return e.withColumn("sentence", F.format_string(pattern, *cols))


#: Q15: sentence kinds and the columns they name.
SENTENCES = {
    "HAS_BIOMARKER": ("%s (%s) can have the biomarker %s (%s).", ["disease", "disease_code", "biomarker", "biomarker_en"]),
    "TESTED_BY": ("%s is tested by %s (code %s).", ["biomarker", "test", "test_code"]),
    "TARGETS": ("%s (%s) targets %s; it works by %s.", ["drug", "drug_code", "biomarker", "mechanism"]),
    "TREATED_BY": ("%s is treated in line %s with %s: %s (notice %s).", ["disease", "line", "regimen_type", "drugs", "notice"]),
}


def sentences(facts: dict[str, DataFrame]) -> DataFrame:
    """Q15: (kind, sentence) of the edges of each kind in SENTENCES; missing values read as a dash, an array is joined by commas in sorted order."""
    out = None
    for kind, df in facts.items():
        pattern, cols = SENTENCES[kind]
        value = lambda c: F.coalesce(F.array_join(F.array_sort(c), ", ") if df.schema[c].dataType.typeName() == "array" else F.col(c).cast("string"), F.lit("-"))  # noqa: B023, E731
        d = df.select(F.lit(kind).alias("kind"), F.format_string(pattern, *[value(c) for c in cols]).alias("sentence"))
        out = d if out is None else out.unionByName(d)
    return out


def nearest(df: DataFrame, vec: str, query: list[float], k: int, order: str) -> DataFrame:
    """Q16: rows by dot product with one query vector, best first, ties by order."""
    q = F.array(*[F.lit(float(x)) for x in query])
    dot = F.aggregate(F.zip_with(F.col(vec).cast("array<double>"), q, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return df.withColumn("score", dot).orderBy(F.desc("score"), order).limit(k)


def distinct_members(df: DataFrame, key: list[str], member: str) -> DataFrame:
    """Q17."""
    return df.groupBy(*key).agg(F.array_sort(F.collect_set(member)).alias("members"))


def search_terms(df: DataFrame, col: str, term: str, k: int) -> DataFrame:
    """Q18: exact hits first, then names that hold the term, in name order."""
    c = F.lower(F.col(col))
    return df.where(c.contains(term.lower())).withColumn("exact", c == term.lower()).orderBy(F.desc("exact"), col).limit(k)
