"""Matching joins (J operators) and the predicates they use (P operators).

Sides are joined by hash on exact keys; nothing is broadcast by hint but word lists whose size was
checked, so Spark broadcasts a side when its measured size allows.  Prefix, range and containment
predicates are rewritten to equi-joins on derived keys: ancestors of a code, blocks of a range, the
rarest gram of a contained word, which is then looked for in the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import SLICE, bounded_slices  # noqa: F401  (SLICE is the finder's too)
from .ordering import checkpointed, first_by


# --- predicates -------------------------------------------------------------------------------


def any_prefix(c: Column, prefixes: list[str]) -> Column:
    """Null is false."""
    out = F.lit(False)
    for p in prefixes:
        out = out | F.coalesce(c.startswith(p), F.lit(False))
    return out


def any_keyword(cols: list[str], words: list[str]) -> Column:
    """A word occurs in one of the columns, case ignored."""
    text = F.lower(F.concat_ws(" ", *cols))
    return F.exists(F.array(*[F.lit(w.lower()) for w in words]), lambda w: F.contains(text, w))


def include_exclude(c: Column, include: list[str], exclude: list[str]) -> Column:
    """None of the exclude patterns and one of the include patterns."""
    return F.coalesce(~c.rlike("|".join(exclude)) if exclude else F.lit(True), F.lit(True)) & F.coalesce(c.rlike("|".join(include)), F.lit(False))


def leaf_only(header: Column, leaf: Column) -> Column:
    """Leaf rows that are no headers; null flags are false."""
    return ~F.coalesce(header, F.lit(False)) & F.coalesce(leaf, F.lit(False))


def unlisted(df: DataFrame, col: str, stop: DataFrame, word: str, least: int = 4) -> DataFrame:
    """Rows whose value is long enough and not listed."""
    return df.where(F.length(col) >= least).join(stop.select(F.col(word).alias(col)).distinct(), col, "left_anti")


def all_keywords(c: Column, words: list[str]) -> Column:
    """Every word occurs."""
    out = F.lit(True)
    for w in words:
        out = out & F.coalesce(c.contains(w), F.lit(False))
    return out


def forbidden_reason(c: Column, hard: list[str], conditional: list[str], context: Column, hints: list[str]) -> Column:
    """P5: FORM_TERM for a hard term, CONTEXT_PACKAGING for a conditional one unless a hint stands in the context, else null."""
    saved = F.exists(F.array(*map(F.lit, hints)), lambda h: F.contains(F.coalesce(context, F.lit("")), h)) if hints else F.lit(False)
    return F.when(c.isin(hard), "FORM_TERM").when(c.isin(conditional) & ~saved, "CONTEXT_PACKAGING")


def valid_name(c: Column, excluded: list[str]) -> Column:
    """Longer than one character, not digits only, not excluded."""
    return F.coalesce((F.length(c) > 1) & ~c.rlike(r"^\d+$") & ~c.isin(excluded), F.lit(False))


def member_like(arr: Column, text: Column) -> Column:
    """An array element occurs in the text."""
    return F.coalesce(F.exists(arr, lambda x: F.contains(text, x)), F.lit(False))


def within(df: DataFrame, least: dict[str, float], most: dict[str, float]) -> DataFrame:
    """Rows whose columns reach their least and do not pass their most value; a null fails."""
    out = F.lit(True)
    for c, v in least.items():
        out = out & (F.col(c) >= v)
    for c, v in most.items():
        out = out & (F.col(c) <= v)
    return df.where(out)


# --- joins ------------------------------------------------------------------------------------


def enrich(left: DataFrame, master: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Left with master's columns, and left's keys that master lacks."""
    return left.join(master, key, "left"), left.select(key).distinct().join(master.select(key), key, "left_anti")


def two_stage(mentions: DataFrame, dictionary: DataFrame, aliases: DataFrame, mention: str = "mention", key: str = "key", alias: str = "alias") -> DataFrame:
    """matched_key and match_type direct, alias or unmatched; direct wins."""
    direct = dictionary.select(F.col(key).alias("_d")).distinct()
    known = first_by(aliases.join(direct, F.col(key) == F.col("_d"), "left_semi"), [alias], [F.col(key)]).select(F.col(alias).alias("_a"), F.col(key).alias("_k"))
    j = mentions.join(direct, F.col(mention) == F.col("_d"), "left").join(known, F.col(mention) == F.col("_a"), "left")
    kind = F.when(F.col("_d").isNotNull(), "direct").when(F.col("_k").isNotNull(), "alias").otherwise("unmatched")
    return j.withColumn("match_type", kind).withColumn("matched_key", F.coalesce("_d", "_k")).drop("_d", "_a", "_k")


def cascade(left: DataFrame, rules: DataFrame, tiers: list[tuple[str, str, str]], out: str = "label") -> DataFrame:
    """Tiers (tier name, left column, rule column) in order; within a tier the rule with the smallest priority wins.  rules: rule columns, label, priority."""
    j = left
    for name, col, rule_col in tiers:
        best = rules.where(F.col(rule_col).isNotNull()).groupBy(F.col(rule_col).alias(f"_{name}_k")).agg(F.min_by(out, "priority").alias(f"_{name}"))
        j = j.join(best, F.col(col) == F.col(f"_{name}_k"), "left").drop(f"_{name}_k")
    hit = F.coalesce(*[F.col(f"_{n}") for n, _, _ in tiers])
    tier = None
    for n, _, _ in tiers:
        tier = F.when(F.col(f"_{n}").isNotNull(), n) if tier is None else tier.when(F.col(f"_{n}").isNotNull(), n)
    return j.withColumn(out, hit).withColumn("tier", tier).drop(*[f"_{n}" for n, _, _ in tiers])


def classed(df: DataFrame, id_col: str, sets: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(id_col, name) and (name, sets): rows whose array columns are equal share a class, named by the SHA-256 of the arrays.

    What pairs of many rows have in common is settled once for their classes; only then are the
    classes expanded, without a shuffle of pairs.
    """
    digest = F.sha2(F.to_json(F.struct(*sets), {"ignoreNullFields": "false"}), 256)
    each = df.withColumn(name, digest)
    return each.select(id_col, name), each.groupBy(name).agg(*[F.first(c).alias(c) for c in sets])


def blocked(df: DataFrame, of: str, size: int) -> DataFrame:
    """(of, _s, _salts, _ids): a class's one other column as arrays of so many values; the arrays of a class are dealt to _salts keys, at most SALTS.

    Values are dealt by hash to lists of about DEAL, which are cut, so that nearly all arrays have the same size.
    """
    (own,) = [c for c in df.columns if c != of]
    many = df.groupBy(of).agg(F.count("*").alias("_n"))
    dealt = df.join(many, of).groupBy(of, "_n", F.pmod(F.xxhash64(own), F.ceil(F.col("_n") / DEAL)).alias("_g"))
    every = dealt.agg(F.collect_list(F.struct(own)).alias("_all"))  # a list of plain values would lack the null
    cut = F.transform(F.sequence(F.lit(0), F.size("_all") - 1, F.lit(size)), lambda i: F.transform(F.slice("_all", i + 1, size), lambda x: x[own]))
    arrays = every.select(of, "_g", F.least(F.ceil(F.col("_n") / size), F.lit(SALTS)).cast("int").alias("_salts"), F.posexplode(cut).alias("_j", "_ids"))
    return arrays.select(of, F.pmod(F.col("_g") * (DEAL // size) + F.col("_j"), F.col("_salts")).cast("int").alias("_s"), "_salts", "_ids")


def expanded(a: DataFrame, b: DataFrame, pairs: DataFrame, a_class: str, b_class: str) -> DataFrame:
    """Rows of a and of b whose classes are a pair; a and b have one column beside their class.

    Arrays of ids meet instead of ids (see blocked), so little is dealt, sorted and held.  The arrays of a
    large class of b have several keys, so that a few classes still are many tasks.  An id of a stays for a whole
    array of b, and that array comes again for the next: where pairs are written, most of them are repeats.
    Both sides are dealt to a stated number of partitions: small sides that become many pairs would else be put into one task.
    """
    n = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (a_id,), (b_id,) = [c for c in a.columns if c != a_class], [c for c in b.columns if c != b_class]
    ours, theirs = blocked(a, a_class, FEW_IDS).select(a_class, F.col("_ids").alias("_ia")), blocked(b, b_class, MANY_IDS).withColumnRenamed("_ids", "_ib")
    salts = theirs.select(b_class, "_salts").distinct()
    dealt = pairs.join(salts, b_class).join(ours, a_class).withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts", a_class)
    met = theirs.drop("_salts").repartition(n, b_class, "_s").join(dealt.repartition(n, b_class, "_s"), [b_class, "_s"]).drop(b_class, "_s")
    return met.withColumn(a_id, F.explode("_ia")).drop("_ia").withColumn(b_id, F.explode("_ib")).drop("_ib")


def tiered_codes(a: DataFrame, b: DataFrame, tiers: list[tuple[str, str, str, float]], a_id: str, b_id: str, veto: list[str]) -> DataFrame:
    """Pairs joined on any of several codes (tier, a column, b column, confidence), best confidence per pair, vetoed codes never match.

    Ids with equal codes share a class (see classed); the best tier is chosen for pairs of classes.
    """
    n = range(len(tiers))
    allowed = lambda c: F.array_sort(F.filter(F.array_distinct(c), lambda x: x.isNotNull() & ~x.isin(veto)))
    own_a = a.groupBy(a_id).agg(*[allowed(F.flatten(F.collect_list(ca))).alias(f"_a{i}") for i, (_, ca, _, _) in enumerate(tiers)])
    own_b = b.groupBy(b_id).agg(*[F.array_sort(F.collect_set(cb)).alias(f"_b{i}") for i, (_, _, cb, _) in enumerate(tiers)])
    ids_a, sets_a = classed(own_a, a_id, [f"_a{i}" for i in n], "_ca")
    ids_b, sets_b = classed(own_b, b_id, [f"_b{i}" for i in n], "_cb")
    out = None
    for i, (tier, _, _, conf) in enumerate(tiers):
        part = sets_a.select("_ca", F.explode(f"_a{i}").alias("_code")).join(sets_b.select("_cb", F.explode(f"_b{i}").alias("_code")), "_code")
        part = part.select("_ca", "_cb", F.lit(tier).alias("match_type"), F.lit(conf).alias("confidence"))
        out = part if out is None else out.unionByName(part)
    best = first_by(out, ["_ca", "_cb"], [F.desc("confidence"), F.col("match_type")])
    return expanded(ids_a, ids_b, best, "_ca", "_cb").select(a_id, b_id, "match_type", "confidence")


#: Ids of the two arrays that meet where classes are expanded.  Spark holds the pairs of two arrays at once, so one is short; the other,
#: a multiple of 8, repeats in whole bytes and often within a page of Parquet.  Both are cut from lists of DEAL ids.
FEW_IDS, MANY_IDS, DEAL = 16, 256, 8192
#: Words that are looked for in every text at most; more are found by an index of grams.
FEW_WORDS = 200
#: As many are, and so many characters of them, if none is shorter than FIRST: then few places begin like one.
MANY_WORDS, WORD_CHARS, FIRST = 20_000, 2_000_000, 4
#: Characters of a gram; a shorter word is its own gram.
GRAM = 3
#: A gram is hot if it has more than one of so many gram rows; its rows are dealt to SALTS keys.
HOT_GRAM, SALTS = 1000, 32


def gram_codes(text: str, lengths: list[int]) -> np.ndarray:
    """Distinct runs of so many characters (up to three), each as one number of its code points."""
    c = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    runs = [c, c[:-1] | c[1:] + 1 << 21, c[:-2] | c[1:-1] + 1 << 21 | c[2:] + 1 << 42]
    return np.unique(np.concatenate([runs[n - 1] for n in lengths]))


def grams(c: Column | str, lengths: list[int]) -> Column:
    """Array of gram_codes; in Arrow, as regular expressions in the JVM take four times as long."""

    @F.arrow_udf("array<bigint>")
    def of_each(texts: pa.Array) -> pa.Array:
        codes = [gram_codes(t or "", lengths) for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, codes)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*codes, np.zeros(0, np.int64)])))

    return of_each(c)


def word_finder(words: list[str]) -> Callable[[pa.Array], pa.Array]:
    """A function from texts to the given words (distinct, not empty) that each holds, in order.

    UTF-8 bytes of all texts are searched at once: places whose first bytes begin some word, then 8 bytes
    at a time, as numbers, until a word differs or ends.
    """
    raw = [w.encode() for w in words]
    order = sorted(range(len(raw)), key=lambda i: int.from_bytes(raw[i][:8], "little"))
    sizes = np.array([len(raw[i]) for i in order], np.int64)
    starts = np.cumsum(sizes) - sizes
    letters = np.frombuffer(b"".join(raw[i] for i in order) + bytes(8), np.uint8)
    masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    octet = np.arange(8)
    load = lambda b, at: b[at[:, None] + octet].view("<u8")[:, 0]
    first = min(8, int(sizes.min())) if raw else 8
    heads = load(letters, starts) & masks[np.minimum(sizes, 8)] if raw else np.zeros(0, np.uint64)
    mix = lambda codes: (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
    begins = np.zeros(1 << 20, bool)
    begins[mix(heads & masks[first])] = True
    # the words of one length, eight bytes or more being one, sorted by their heads
    kinds = [(n, np.flatnonzero(np.minimum(sizes, 8) == n)) for n in np.unique(np.minimum(sizes, 8)).tolist()]

    def find(texts: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        data = b"".join(t for t in texts.cast(pa.binary()).to_pylist() if t) + bytes(8)
        ends, b = np.cumsum(lengths), np.frombuffer(data, np.uint8)
        n = len(b) - 8
        codes = np.zeros(n, np.uint64)
        for i in range(first):
            codes |= b[i : n + i].astype(np.uint64) << np.uint64(8 * i)
        place = np.flatnonzero(begins[mix(codes)])
        here = load(b, place)
        at, word = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size, own in kinds:
            head, seen = heads[own], here & masks[size]
            lo, hi = np.searchsorted(head, seen, "left"), np.searchsorted(head, seen, "right")
            many = hi - lo
            at.append(np.repeat(place, many))
            word.append(own[np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())])
        at, word = np.concatenate(at), np.concatenate(word)
        text = np.searchsorted(ends, at, "right")
        fits = at + sizes[word] <= ends[text]
        at, word, text = at[fits], word[fits], text[fits]
        sure, done = [], 8
        while len(at):
            more = sizes[word] > done
            sure.append(text[~more] * len(raw) + word[~more])
            at, word, text = at[more], word[more], text[more]
            mask = masks[np.minimum(sizes[word] - done, 8)]
            same = (load(b, at + done) & mask) == (load(letters, starts[word] + done) & mask)
            at, word, text, done = at[same], word[same], text[same], done + 8
        pairs = np.unique(np.concatenate([*sure, np.zeros(0, np.int64)]))
        owner, ids = pairs // max(len(raw), 1), np.array(order, np.int64)[pairs % max(len(raw), 1)]
        back = np.lexsort((ids, owner))
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(words, pa.string()).take(pa.array(ids[back])))

    return find


def words_in(text: Column, words: Column | list[str]) -> Column:
    """Array: the words that occur in a text; in Arrow, as contains() reads a long text anew for every word.

    A list is looked for at once (see word_finder).  Of a column's words, those without a place for one of
    their grams leave before the text is searched for them.
    """

    def held(text: str, words: list[str], given: np.ndarray, word: np.ndarray) -> list[str]:
        """given: the grams of the words, word: whose they are."""
        if len(words) < 8 or len(text) < 200:
            return [w for w in words if w in text]
        own = gram_codes(text, [GRAM])
        at = np.minimum(np.searchsorted(own, given), len(own) - 1)
        out = np.zeros(len(words), bool)
        out[word[own[at] != given]] = True
        return [w for w, no in zip(words, out.tolist(), strict=True) if not no and w in text]

    def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        c = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        inside = word[:-2] == word[2:]
        return (c[:-2] | c[1:-1] + 1 << 21 | c[2:] + 1 << 42)[inside], word[:-2][inside]

    @F.arrow_udf("array<string>")
    def of_each(texts: pa.Array, words: pa.Array) -> pa.Array:
        return pa.array([held(t, ws, *grams_of(ws)) for t, ws in zip(texts.to_pylist(), words.to_pylist(), strict=True)], pa.list_(pa.string()))

    @F.arrow_udf("array<string>")
    def of_all(texts: pa.Array) -> pa.Array:
        find = word_finder(words)
        parts = [find(p) for p in bounded_slices(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    return of_all(text) if isinstance(words, list) else of_each(text, words)


def containments(texts: DataFrame, key: list[str], text: str, words: DataFrame, word: str, also: dict[str, Column] | None = None) -> DataFrame:
    """(key, _word, also): which distinct words occur in which texts; also: columns over _text and _word, taken where a word is found.

    Up to FEW_WORDS words, or MANY_WORDS if none is short, are looked for in every text.  More are found by an index: the texts that
    hold each gram are counted, a word is filed under its rarest gram, and only (key,
    hash of the text, gram) meets the words; grams of very many texts are salted.  A text is fetched once,
    with all its candidates, and searched.  Equal rows give one result; rows that share a key but not
    their text give one each.  Null and empty words never match.
    """
    w = words.select(F.col(word).alias("_word")).where(F.col("_word") != "").distinct()
    t = texts.select(*key, F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    found = [c.alias(n) for n, c in (also or {}).items()]
    size = w.agg(F.count("*").alias("n"), F.sum(F.length("_word")).alias("chars"), F.min(F.length("_word")).alias("least")).first()
    most = MANY_WORDS if (size["least"] or 0) >= FIRST else FEW_WORDS
    if size["n"] <= most and (size["chars"] or 0) <= WORD_CHARS:
        few = [r["_word"] for r in w.collect()]
        return t.select(*key, "_text", F.explode(words_in(F.col("_text"), sorted(few))).alias("_word")).select(*key, "_word", *found).distinct()
    t = t.withColumn("_t", F.xxhash64("_text"))
    lengths = sorted(r["n"] for r in w.select(F.least(F.length("_word"), F.lit(GRAM)).alias("n")).distinct().collect())
    in_texts = t.select(*key, "_t", F.explode(grams("_text", lengths)).alias("_g"))
    held = in_texts.groupBy("_g").agg(F.count("*").alias("_n"))
    of = w.select("_word", F.explode(grams("_word", lengths)).alias("_g")).join(held, "_g")
    filed = checkpointed(of.groupBy("_word").agg(F.min(F.struct("_n", "_g")).alias("_m")).select("_word", "_m.*"))
    asked = filed.groupBy("_g").agg(F.max("_n").alias("_n"))
    rows = asked.agg(F.sum("_n").alias("n")).first()["n"] or 0
    hot = asked.where(F.col("_n") * HOT_GRAM > rows).select("_g", F.lit(SALTS).alias("_salts"))  # fewer than HOT_GRAM
    salted = lambda df: df.join(F.broadcast(hot), "_g", "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))
    dealt = salted(filed.drop("_n")).select("_word", "_g", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_s"))
    met = salted(in_texts).select(*key, "_t", "_g", F.pmod("_t", F.col("_salts")).cast("int").alias("_s")).join(dealt, ["_g", "_s"])
    of_text = met.groupBy(*key, "_t").agg(F.collect_set("_word").alias("_words")).toDF(*[f"_k{i}" for i in range(len(key))], "_h", "_words")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)]
    both = t.join(of_text, [F.col("_t") == F.col("_h"), *same]).select(*key, "_text", words_in(F.col("_text"), F.col("_words")).alias("_words"))
    return both.select(*key, "_text", F.explode("_words").alias("_word")).select(*key, "_word", *found).distinct()


def _contained_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """(_a, _b): distinct names, one of which contains the other; a has _a, b has _b."""
    one = containments(b, ["_b"], "_b", a, "_a").select(F.col("_word").alias("_a"), "_b")
    return one.unionByName(containments(a, ["_a"], "_a", b, "_b").select("_a", F.col("_word").alias("_b"))).distinct()


def name_match(small: DataFrame, big: DataFrame, small_name: str, big_name: str) -> DataFrame:
    """Equal .95, contained either way .85, a part of a small name a/b contained in the big name .80; nulls, empty names and empty parts never match.

    Distinct names meet first (see containments), rows are joined to the pairs by hash.
    """
    a, b = small.select(F.col(small_name).alias("_a")).distinct(), big.select(F.col(big_name).alias("_b")).distinct()
    parts = a.where(F.contains("_a", F.lit("/"))).select("_a", F.explode(F.array_distinct(F.split("_a", "/"))).alias("_part"))
    by_part = containments(b, ["_b"], "_b", parts, "_part").join(parts, F.col("_word") == F.col("_part")).select("_a", "_b")
    pairs = _contained_pairs(a, b).unionByName(by_part).distinct()
    s, b = F.col("_a"), F.col("_b")
    pairs = pairs.withColumn("confidence", F.when(s == b, 0.95).when(b.contains(s) | s.contains(b), 0.85).otherwise(0.80))
    return small.join(pairs, F.col(small_name) == F.col("_a")).join(big, F.col("_b") == F.col(big_name)).drop("_a", "_b").select(*small.columns, *big.columns, "confidence")


def keyword_scores(keywords: DataFrame, master: DataFrame, owner: str, word: str, text: str, code: str, k: int) -> DataFrame:
    """Master rows by how many of an owner's keywords they hold, case ignored: score, ratio; the best k, ties by code."""
    total = keywords.groupBy(owner).agg(F.countDistinct(word).alias("_n"))
    low = keywords.select(owner, F.col(word).alias("_w"), F.lower(word).alias("_word")).where("_w is not null").distinct()
    held = containments(master.withColumn("_low", F.lower(text)), [code], "_low", low, "_word")
    hits = held.join(low, "_word").groupBy(owner, code).agg(F.count("*").alias("score"))
    scored = hits.join(total, owner).withColumn("ratio", F.col("score") / F.col("_n")).drop("_n")
    w = Window.partitionBy(owner).orderBy(F.desc("score"), F.desc("ratio"), code)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def ancestors(c: Column, sep: str = ".") -> Column:
    """A dotted code and all codes above it."""
    parts = F.split(c, rf"\{sep}")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), sep))


def prefix_expand(edges: DataFrame, master: DataFrame, edge_code: str, code: str) -> DataFrame:
    """Master codes equal to the edge's code or below it, as a hash join on exploded ancestors."""
    up = master.withColumn("_anc", F.explode(ancestors(F.col(code))))
    return edges.join(up, F.col(edge_code) == F.col("_anc")).drop("_anc")


#: Levels of halving: a block of level l holds 2^l numbers.
LEVELS = 63


def dyadic(lo: Column, hi: Column) -> Column:
    """The blocks (level, n), numbers n * 2^level to (n + 1) * 2^level - 1, that together are lo to hi: at most two a level; none if hi is below lo."""
    def step(s: Column, l: Column) -> Column:  # noqa: E741
        # what is left is a to z in blocks of this level; an odd first or an even last has no partner and goes
        a, z = s["a"], s["z"]
        first, last = (a <= z) & (F.pmod(a, F.lit(2)) == 1), (a <= z) & (F.pmod(z, F.lit(2)) == 0)
        alone = F.filter(F.array(F.when(first, F.struct(l.alias("level"), a.alias("n"))), F.when(last & ~(first & (a == z)), F.struct(l.alias("level"), z.alias("n")))), lambda x: x.isNotNull())
        up, down = F.when(first, a + 1).otherwise(a), F.when(last, z - 1).otherwise(z)
        some = F.coalesce((a <= z) & (up <= down), F.lit(False))
        half = lambda x, none: F.when(some, F.shiftright(x, 1)).otherwise(F.lit(none).cast("long"))
        return F.struct(half(up, 1).alias("a"), half(down, 0).alias("z"), F.concat(s["out"], alone).alias("out"))

    start = F.struct(lo.cast("long").alias("a"), hi.cast("long").alias("z"), F.array().cast("array<struct<level: int, n: bigint>>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS - 1)), start, step, lambda s: s["out"])


def cover_level(lo: Column, hi: Column) -> Column:
    """The level of the blocks that cover() takes."""
    wide = F.coalesce(F.try_subtract(hi.cast("long"), lo.cast("long")), F.lit(2**63 - 1))  # null: wider than a long
    return F.greatest(F.length(F.bin(wide)) - 3, F.lit(0)).cast("int")


def cover(lo: Column, hi: Column) -> Column:
    """The blocks (level, n) of one level, 4 to 9 of them, that meet lo to hi: blocks as wide as an eighth to a quarter of it (of one number, if it is short); none if hi is below lo."""
    a, z, level = lo.cast("long"), hi.cast("long"), cover_level(lo, hi)
    blocks = lambda x: F.call_function("shiftright", x, level)
    each = F.transform(F.sequence(blocks(a), blocks(z)), lambda n: F.struct(level.alias("level"), n.alias("n")))
    return F.when(a <= z, each)


def range_contains(items: DataFrame, ranges: DataFrame, chapter: str, number: str, lo: str, hi: str, order: list[Column]) -> DataFrame:
    """Every item with the first range, by order over the ranges' columns, of its chapter that holds its number.

    A range of any width is a few blocks of one level (see cover), and a number is in one block of
    each level that the ranges use, so it is an equi-join on the distinct (chapter, level, block), and only
    blocks at the ends of a range are met by numbers outside it; repeated items keep their rows, items outside
    every range leave.  Numbers are longs.  Ranges are dealt before they are cut into blocks: a small file of
    them is one task.  Both joins are merged by hint: by the size of the ranges' (or the items') files Spark
    would plan a broadcast, and a planned one stays, however many blocks are measured.
    """
    used = sorted(r["l"] for r in ranges.where(F.col(lo).cast("long") <= F.col(hi).cast("long")).select(cover_level(F.col(lo), F.col(hi)).alias("l")).distinct().collect())
    filed = ranges.repartition(lo, hi).withColumn("_d", F.explode(cover(F.col(lo), F.col(hi)))).select("*", F.col("_d.level").alias("_fl"), F.col("_d.n").alias("_fb")).drop("_d").withColumnRenamed(chapter, "_c")
    asked = items.select(F.col(chapter).alias("_ic"), F.col(number).cast("long").alias("_in")).where("_ic is not null and _in is not null").distinct()
    at = asked.withColumn("_l", F.explode(F.array(*map(F.lit, used)).cast("array<int>"))).withColumn("_b", F.expr("shiftright(_in, _l)"))
    same = (F.col("_ic") == F.col("_c")) & (F.col("_l") == F.col("_fl")) & (F.col("_b") == F.col("_fb"))
    hit = at.join(filed.hint("merge"), same).where(F.col("_in").between(F.col(lo).cast("long"), F.col(hi).cast("long"))).drop("_l", "_b", "_fl", "_fb", "_c")
    best = first_by(hit, ["_ic", "_in"], order)
    return items.join(best.hint("merge"), (F.col(chapter) == F.col("_ic")) & (F.col(number) == F.col("_in"))).drop("_ic", "_in")


def mutual_contains(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """For every left row the one right name that equals it, contains it or is contained, case ignored: an equal one before others, the longest, then the smallest; exact flag and confidence .95 or .8.

    Equal names are found by hash first; only distinct names without an equal one are looked for in
    the other side's distinct names, and they in them (see containments).
    """
    names = first_by(right.select(b).distinct().withColumn("_l", F.lower(b)), ["_l"], [F.length(b).desc(), F.col(b)])
    exact = left.join(names, F.lower(a) == F.col("_l")).drop("_l")
    rest = left.join(names, F.lower(a) == F.col("_l"), "left_anti")
    pairs = _contained_pairs(rest.select(F.lower(a).alias("_a")).distinct(), names.select(F.col("_l").alias("_b")))
    best = first_by(pairs.join(names, F.col("_l") == F.col("_b")), ["_a"], [F.length(b).desc(), F.col(b)]).select("_a", b)
    loose = rest.join(best, F.lower(a) == F.col("_a")).drop("_a")
    return exact.withColumn("exact", F.lit(True)).unionByName(loose.withColumn("exact", F.lit(False))).withColumn("confidence", F.when(F.col("exact"), 0.95).otherwise(0.8))


def file_catalogue(files: DataFrame, file: str, catalogue: DataFrame, name: str) -> DataFrame:
    """Every file with the catalogue row whose name its own name contains; the longest such name, then the smallest; null columns if none."""
    hit = containments(files, [file], file, catalogue, name)
    best = hit.groupBy(file).agg(F.min_by("_word", F.struct(-F.length("_word"), F.col("_word"))).alias("_word"))
    one = first_by(catalogue, [name], [F.col(c) for c in catalogue.columns if c != name])
    return files.join(best, file, "left").join(one, F.col("_word") == F.col(name), "left").drop("_word")


def missing_files(catalogue: DataFrame, name: str, files: DataFrame, file: str) -> DataFrame:
    """Catalogue rows whose name no file's name contains."""
    found = containments(files, [file], file, catalogue, name).select(F.col("_word").alias(name)).distinct()
    return catalogue.join(found, name, "left_anti")


def resolve_list(df: DataFrame, names: str, codes: DataFrame, key: str, name: str, code: str) -> DataFrame:
    """Per row, codes of the array's names in order and the names without one."""
    one = df.select(key, F.posexplode(names).alias("pos", "_n")).join(codes.select(F.col(name).alias("_n"), F.col(code).alias("_c")), "_n", "left")
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("pos", "_n", "_c")))), lambda x: x)
    agg = one.groupBy(key).agg(ordered(F.col("_c").isNotNull()).alias("_hit"), ordered(F.col("_c").isNull()).alias("_miss"))
    return agg.select(key, F.transform("_hit", lambda x: x["_c"]).alias("codes"), F.transform("_miss", lambda x: x["_n"]).alias("missing"))


def base_name_match(left: DataFrame, right: DataFrame, name: str, target: str, suffix: str) -> DataFrame:
    """Exact name, else the name less its suffix; match_type exact, base or null.  Both are hash joins."""
    t = right.select(F.col(target).alias("_t")).distinct()
    base = lambda c: F.trim(F.regexp_replace(c, suffix, ""))
    bases = t.groupBy(base(F.col("_t")).alias("_b")).agg(F.min_by("_t", F.struct(F.length("_t"), F.col("_t"))).alias("_bt"))
    j = left.join(t, F.col(name) == F.col("_t"), "left").join(bases, base(F.col(name)) == F.col("_b"), "left")
    return j.withColumn("match_type", F.when(F.col("_t").isNotNull(), "exact").when(F.col("_bt").isNotNull(), "base")).withColumn("matched", F.coalesce("_t", "_bt")).drop("_t", "_b", "_bt")


def _by_law(refs: DataFrame, articles: DataFrame) -> tuple[dict[str, str], list[str]]:
    """How refs' columns are called where they meet articles, and the columns that tell a law: its id, and its name if both have it, as laws may share an id."""
    named = "target_law_name" in refs.columns and "law_name" in articles.columns
    return {"target_law_id": "law_id"} | ({"target_law_name": "_ln"} if named else {}), ["law_id", "_ln"] if named else ["law_id"]


def refine_target(refs: DataFrame, articles: DataFrame) -> DataFrame:
    """The clause named by (law, article, clause) if it exists, else its article, else null."""
    names, law = _by_law(refs, articles)
    known = articles.withColumn("_ln", F.col("law_name")) if "_ln" in law else articles
    top = known.where("depth = 0").select(*law, F.col("article_number").alias("_a"), F.col("article_id").alias("_base"))
    kid = known.where("depth = 1").select(*law, F.col("article_number").alias("_a"), F.col("clause_number").alias("_c"), F.col("article_id").alias("_child"))
    names |= {"target_article_number": "_a", "target_clause": "_c"}
    j = refs.withColumnsRenamed(names).join(top, [*law, "_a"], "left").join(kid, [*law, "_a", "_c"], "left")
    return j.withColumn("target_article_id", F.coalesce("_child", "_base")).drop("_child", "_base").withColumnsRenamed({n: c for c, n in names.items()})


def missing_targets(refs: DataFrame, articles: DataFrame) -> DataFrame:
    """References whose article, or whose clause, does not exist: reason article or clause."""
    names, law = _by_law(refs, articles)
    known = articles.withColumn("_ln", F.col("law_name")) if "_ln" in law else articles
    on = refs.withColumnsRenamed(names | {"target_article_number": "article_number", "target_clause": "clause_number"})
    top = known.where("depth = 0").select(*law, "article_number")
    a = on.join(top, [*law, "article_number"], "left_anti").withColumn("reason", F.lit("article"))
    has = on.join(top, [*law, "article_number"], "left_semi").where("clause_number is not null")
    c = has.join(known.where("depth = 1").select(*law, "article_number", "clause_number"), [*law, "article_number", "clause_number"], "left_anti").withColumn("reason", F.lit("clause"))
    return a.unionByName(c).withColumnsRenamed({"_ln": "target_law_name"})


def changed(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Keys in both whose value differs; a null differs from a value."""
    j = old.select(key, F.col(value).alias("old")).join(new.select(key, F.col(value).alias("new")), key)
    return j.where(~F.col("old").eqNullSafe(F.col("new")))


#: Rows of a partition whose members are paired; what a task holds are the distinct pairs of so many.
PAIRED_ROWS = 250_000


def co_members(df: DataFrame, group: str, member: str) -> DataFrame:
    """Other members of a member's groups, each pair both ways, with the groups they share.

    Groups are dealt once, to partitions by the number of rows: partitions of a set size in bytes are
    few for narrow rows and hold very many pairs.  A pair is counted one way and then turned round.
    """
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // PAIRED_ROWS))
    rows = df.select(F.col(group).alias("_group"), F.col(member).alias("a")).repartition(n, "_group").distinct()
    pairs = rows.join(rows.withColumnRenamed("a", "b"), "_group").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.select(F.inline(both), "shared")


def mismatched(a: Column, b: Column) -> Column:
    """Unequal, or a null on either side."""
    return F.coalesce(a != b, F.lit(True))


def merge_codes(df: DataFrame, types: str, codes: DataFrame, type_col: str, code_col: str, key: str) -> DataFrame:
    """Distinct sorted codes of all a row's types; rows without any get an empty array.

    Keys with equal types share a class (see classed), whose codes are merged once.
    """
    own = df.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(types)))).alias("_types"))
    ids, sets = classed(own, key, ["_types"], "_class")
    hit = sets.select("_class", F.explode_outer("_types").alias("_t")).join(codes.select(F.col(type_col).alias("_t"), F.explode(code_col).alias("_c")), "_t", "left")
    merged = hit.groupBy("_class").agg(F.array_sort(F.collect_set("_c")).alias("codes"))
    return ids.join(merged, "_class").select(key, "codes")


def variant_match(names: DataFrame, variants: Column, master: DataFrame, name: str, master_name: str) -> DataFrame:
    """Every name with the master row that equals the earliest of its variants, case ignored.  The choice is made once for equal names and variants; repeated rows stay."""
    v = names.withColumn("_v", variants)
    x = v.select(F.col(name).alias("_k"), "_v").distinct().select("_k", "_v", F.posexplode("_v").alias("_p", "_x"))
    hit = first_by(x.join(master.withColumn("_m", F.lower(master_name)), F.lower("_x") == F.col("_m")), ["_k", "_v"], [F.col("_p"), F.col(master_name)])
    return v.join(hit.withColumnRenamed("_v", "_w").drop("_p", "_x", "_m"), (F.col(name) == F.col("_k")) & (F.col("_v") == F.col("_w"))).drop("_v", "_w", "_k")
