"""Gate chain, classifiers, grades and dictionary phases (C operators)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import aggregates, joins
from .ordering import alias_conflicts, checkpointed, top_k


def any_suffix(c: Column, suffixes: list[str]) -> Column:
    out = F.lit(False)
    for s in suffixes:
        out = out | c.endswith(s)
    return out


def route_match(c: Column, patterns: list[str], legacy_unanchored: bool = False) -> Column:
    """A whole token matches one of the patterns (anywhere in the name with legacy_unanchored)."""
    joined = "|".join(patterns)
    return c.rlike(rf"(?i)({joined})" if legacy_unanchored else rf"(?i)(^|[^A-Za-z0-9])({joined})($|[^A-Za-z0-9])") if patterns else F.lit(False)


def gate_chain(entries: DataFrame, rules: dict, curated: DataFrame | None = None, brands: DataFrame | None = None, legacy_unanchored: bool = False, promotion: DataFrame | None = None) -> DataFrame:
    """Entries (en, ko, count, context_span, seq) with decision and ordered reason_codes.

    Order: curated pairs pass; brand names resolve; forbidden terms drop; regimens, biomarkers
    and diseases are routed; name endings must agree; spelling must be near unless a strict
    ending agreed or the context promotes; the first English name to pass for a Korean name
    wins.  Each gate sets the decision once; only rows that need the spelling score, and only
    their distinct pairs whose letters allow a score that counts, reach the Arrow function.  promotion (anchor, drug): C12, a drug next
    to its anchor is promoted from a score of 0.30 on if its ending agrees.
    Null names count as empty.  seq settles conflicts and must be unique.
    """
    none = F.array().cast("array<string>")
    e = entries.withColumn("en", F.lower(F.coalesce("en", F.lit("")))).withColumn("ko", F.coalesce("ko", F.lit("")))
    if curated is not None:
        pairs = curated.select(F.lower("en").alias("_ce"), F.col("ko").alias("_ck")).distinct()
        e = e.join(pairs, (F.col("en") == F.col("_ce")) & (F.col("ko") == F.col("_ck")), "left").withColumn("_curated", F.col("_ce").isNotNull()).drop("_ce", "_ck")
    else:
        e = e.withColumn("_curated", F.lit(False))
    e = e.withColumn("decision", F.when(F.col("_curated"), "active")).withColumn("reason_codes", F.when(F.col("_curated"), F.array(F.lit("PASS_ALL"), F.lit("CURATED_WHITELIST"))).otherwise(none))
    if brands is not None:
        b = brands.groupBy(F.lower("brand").alias("_b")).agg(F.min("ingredient").alias("_i"))
        e = e.join(b, F.col("en") == F.col("_b"), "left").withColumn("_r", F.col("_i").isNotNull() & ~F.col("_curated"))
        e = e.withColumn("en", F.when(F.col("_r"), F.lower("_i")).otherwise(F.col("en"))).withColumn("reason_codes", F.concat("reason_codes", F.when(F.col("_r"), F.array(F.lit("BRAND_RESOLVED_EN"))).otherwise(none))).drop("_b", "_i", "_r")

    def gate(df: DataFrame, fails: Column, decision: Column, reason: Column) -> DataFrame:
        now = F.col("decision").isNull() & F.coalesce(fails, F.lit(False))
        return df.withColumn("_now", now).withColumn("reason_codes", F.when(F.col("_now"), F.array_append("reason_codes", reason)).otherwise(F.col("reason_codes"))).withColumn("decision", F.when(F.col("_now"), decision).otherwise(F.col("decision"))).drop("_now")

    def note(df: DataFrame, holds: Column, reason: str) -> DataFrame:
        return df.withColumn("reason_codes", F.when(F.col("decision").isNull() & F.coalesce(holds, F.lit(False)), F.array_append("reason_codes", F.lit(reason))).otherwise(F.col("reason_codes")))

    hard, cond, hints = (rules.get(k, []) for k in ("hard", "conditional", "hints"))
    form = joins.forbidden_reason(F.col("ko"), hard, cond, F.col("context_span"), hints)
    e = gate(e, form.isNotNull(), F.lit("drop"), form)
    for kind in ("regimen", "biomarker", "disease"):
        e = gate(e, route_match(F.col("en"), rules.get(kind, []), legacy_unanchored), F.lit(f"route_{kind}"), F.lit(f"ROUTE_{kind.upper()}"))
    for s in rules.get("suffixes", []):
        en_has, ko_has = F.col("en").endswith(s["en"]), any_suffix(F.col("ko"), s["ko"])
        if s.get("strict"):
            e = gate(e, en_has & ~ko_has, F.lit("pending"), F.lit("SUFFIX_MISMATCH"))
            e = note(e, en_has & ko_has, "SUFFIX_MATCH_STRICT")
        else:
            e = note(e, en_has & ~ko_has, "SUFFIX_MISMATCH_WARN")
    strict_hit = F.array_contains("reason_codes", "SUFFIX_MATCH_STRICT")
    e = e.withColumn("_score_it", F.col("decision").isNull() & ~strict_hit)
    # what is read more than once from here on is written once
    e = checkpointed(e)
    spelt = e.where("_score_it").select("en", "ko").distinct().withColumn("_latin", T.romanize(F.col("ko")))
    # a score below every threshold decides as 0 does; the bound on it needs no matching blocks
    least = min(1 - rules.get("strict", 0.25), 1 - rules.get("loose", 0.35), *([0.30] if promotion is not None else []))
    near = spelt.where(T.similarity_bound(F.col("en"), F.col("_latin")) >= least - 1e-9)
    e = e.join(near.select("en", "ko", T.similarity(F.col("en"), F.col("_latin")).alias("_s")), ["en", "ko"], "left")
    most = F.when(F.col("count") >= rules.get("high_frequency", 20), rules.get("strict", 0.25)).otherwise(rules.get("loose", 0.35))
    low = F.col("_score_it") & (1 - F.coalesce(F.col("_s"), F.lit(0.0)) > most)  # the thresholds are distances
    seen = F.exists(F.array(*[F.lit(t) for t in rules.get("context_tokens", [])]), lambda t: F.contains(F.coalesce("context_span", F.lit("")), t)) if rules.get("context_tokens") else F.lit(False)
    if promotion is not None:
        hit = e.where("_score_it").select("seq", "en", "context_span").join(promotion.select(F.lower("drug").alias("en"), "anchor"), "en").where(F.contains("context_span", F.col("anchor"))).select("seq").distinct().withColumn("_p", F.lit(True))
        agree = ~F.array_contains("reason_codes", "SUFFIX_MISMATCH_WARN")
        e = e.join(hit, "seq", "left")
        seen = seen | (F.coalesce("_p", F.lit(False)) & agree & (F.coalesce(F.col("_s"), F.lit(0.0)) >= 0.30))
    e = e.withColumn("_low", low).withColumn("_seen", seen)
    e = note(e, F.col("_low"), "PHONETIC_FAIL")
    e = note(e, F.col("_low") & F.col("_seen"), "CTX_PROMOTE")
    e = e.withColumn("decision", F.when(F.col("decision").isNull() & F.col("_low") & ~F.col("_seen"), "pending").otherwise(F.col("decision")))
    e = checkpointed(e)
    passed = alias_conflicts(e.where(F.col("decision").isNull() & (F.col("ko") != "")).select("seq", "ko", "en")).where("conflict").select("seq", F.lit(True).alias("_conflict"))
    e = e.join(passed, "seq", "left")
    e = gate(e, F.col("_conflict"), F.lit("pending"), F.lit("ALIAS_CONFLICT"))
    e = e.withColumn("reason_codes", F.when(F.col("decision").isNull(), F.concat(F.array(F.lit("PASS_ALL")), "reason_codes")).otherwise(F.col("reason_codes"))).withColumn("decision", F.coalesce("decision", F.lit("active")))
    return e.drop("_curated", "_score_it", "_s", "_low", "_seen", "_conflict", "_p")


def keyword_classifier(terms: DataFrame, rules: DataFrame, term: str, text: str, key: str | None = None) -> DataFrame:
    """Per term the category with the largest score: 2 for every keyword hit, 5 for a suffix of the term, -3 for a negative keyword, over the category's priority; ties to the smaller priority number, then name.

    rules: category, keyword, kind (keyword, suffix or negative), priority.  key: the terms' id, if
    terms repeat.  Keywords are looked for and counted in the text, suffixes at the end of the term (see
    joins.containments).  Equal rows of an id count once; different texts of an id count together.
    Terms that score 0 or less are left out.
    """
    key = key or term
    times = ((F.length("_text") - F.length(F.replace(F.col("_text"), F.col("_word"), F.lit("")))) / F.length("_word")).cast("int")
    inside = joins.containments(terms, [key], text, rules.where("kind <> 'suffix'"), "keyword", {"_times": times})
    at_end = joins.containments(terms, [key], term, rules.where("kind = 'suffix'"), "keyword", {"_times": F.col("_text").endswith(F.col("_word")).cast("int")})
    found = inside.withColumn("_in", F.lit(True)).unionByName(at_end.withColumn("_in", F.lit(False)))
    counted = found.join(rules, (F.col("_word") == F.col("keyword")) & (F.col("_in") == (F.col("kind") != "suffix")))
    n = F.when(F.col("kind") == "negative", -3).when(F.col("kind") == "suffix", 5 * F.col("_times")).otherwise(2 * F.col("_times"))
    by = counted.groupBy(key, "category", "priority").agg(F.sum(n).alias("_h")).withColumn("score", F.col("_h") / F.col("priority")).where("score > 0").drop("_h")
    return top_k(by, [key], [F.desc("score"), F.col("priority"), F.col("category")], 1).drop("rank", "priority")


def early_rules(terms: DataFrame, rules: list[tuple[str, str, float]], text: str, scored: DataFrame, term: str) -> DataFrame:
    """(pattern, category, confidence) in order; terms none matches take C2's category with confidence min(score / 10, 1)."""
    cat, conf = None, None
    for p, c, f in rules:
        m = F.col(text).rlike(p)
        cat = F.when(m, c) if cat is None else cat.when(m, c)
        conf = F.when(m, f) if conf is None else conf.when(m, f)
    j = terms.withColumn("_c", cat).withColumn("_f", conf).join(scored, term, "left")
    return j.withColumn("category", F.coalesce("_c", "category")).withColumn("confidence", F.coalesce("_f", F.when(F.col("score").isNotNull(), F.least(F.col("score") / 10, F.lit(1.0))))).drop("_c", "_f", "score")


def whitelist_tokens(names: DataFrame, name: str, least: int = 3) -> DataFrame:
    """C4: names and the longer words of names of several words."""
    words = F.filter(F.split(name, r"\s+"), lambda w: F.length(w) >= least)
    return names.select(F.col(name).alias("token")).unionByName(names.where(F.size(F.split(name, r"\s+")) > 1).select(F.explode(words).alias("token"))).distinct()


#: Terms of a partition; what its task holds are their examples.
TERMS = 25_000


def choose_examples(terms: DataFrame, pool: DataFrame, term: str, text: str, k: int = 3, fixed: int = 1) -> DataFrame:
    """For every term the k best core and the k best boundary examples and the first `fixed` ones: (term, kind, example, score, rank).

    An example scores 2 for each of its distinct keywords in the text and 3 if one of its category's
    cues occurs; ties and examples that score 0 follow the pool's order.  pool: kind (core, boundary
    or fixed), example, seq (its place), keywords and cues (arrays; empty words count nothing).
    Equal rows of the pool are one.

    Only examples with a word in the text meet a term (see joins.containments).  The others that can
    be chosen are the first 2k of each kind, as at most k with a score stand before them: so many
    rows, whatever the pool's size, are broadcast.  All that a term meets is dealt once, to partitions by
    the number of terms: ones of a set size in bytes hold very many of these short rows.
    """
    most = max(k, fixed)
    pool = pool.dropDuplicates(["kind", "example", "seq"])
    one = F.array(F.struct("keywords", F.lit(False).alias("cue")), F.struct(F.col("cues").alias("keywords"), F.lit(True).alias("cue")))
    words = pool.where("kind <> 'fixed'").select("kind", "example", "seq", F.inline(one)).select("kind", "example", "seq", F.explode(F.array_distinct("keywords")).alias("_w"), "cue")
    texts = terms.select(F.col(term).alias("_term"), F.coalesce(text, F.lit("")).alias("_text"))
    held = joins.containments(texts, ["_term"], "_text", words, "_w")
    hits = held.join(words, F.col("_word") == F.col("_w")).select("_term", "kind", "example", "seq", "cue", "_word")
    first = top_k(pool.select("kind", "example", "seq"), ["kind"], [F.col("seq"), F.col("example")], 2 * most).drop("rank")
    # one small row for each kind, so that every term has its kinds
    lists = first.where(F.col("kind").isin("core", "boundary", "fixed")).groupBy("kind").agg(F.collect_list(F.struct("example", "seq")).alias("_first"))
    rest = texts.select("_term").withColumn("kind", F.explode(F.array(F.lit("core"), F.lit("boundary"), F.lit("fixed")))).join(F.broadcast(lists), "kind").select("_term", "kind", F.inline("_first"))
    met = hits.unionByName(rest, allowMissingColumns=True)
    n = max(terms.sparkSession.sparkContext.defaultParallelism, -(-terms.count() // TERMS))
    score = 2 * F.count_distinct(F.when(~F.col("cue"), F.col("_word"))) + 3 * F.coalesce(F.max(F.col("cue").cast("int")), F.lit(0))
    both = met.repartition(n, "_term").groupBy("_term", "kind", "example", "seq").agg(score.cast("int").alias("score"))
    ranked = top_k(both, ["_term", "kind"], [F.desc("score"), F.col("seq"), F.col("example")], most)
    return ranked.where(F.col("rank") <= F.when(F.col("kind") == "fixed", fixed).otherwise(k)).select(F.col("_term").alias(term), "kind", "example", "score", "rank")


def quality_grade(chars: Column, pages: Column, low_ratio: Column) -> Column:
    """C under 50 characters a page or from half low pages on, A from 300 with under a tenth low, else B; no pages is C."""
    per = F.try_divide(chars, pages)
    return F.when(per.isNull() | (per < 50) | (low_ratio >= 0.5), "C").when((per >= 300) & (low_ratio < 0.1), "A").otherwise("B")


def complexity(tables: Column, pages: Column, nested: Column, rows: Column) -> Column:
    """Table density (40 at most), 30 for nesting, rows / 10 (30 at most)."""
    return F.least(F.coalesce(F.try_divide(tables, pages), F.lit(0.0)) * 20, F.lit(40.0)) + F.when(nested, 30.0).otherwise(0.0) + F.least(rows / 10, F.lit(30.0))


def has_header(rows: Column) -> Column:
    """At least two rows, and under 0.3 of the first row's cells are numbers."""
    head = F.try_element_at(rows, F.lit(1))
    share = F.try_divide(F.size(F.filter(head, lambda c: c.rlike(r"^\s*[\d,.]+\s*$"))), F.size(head))
    return F.coalesce((F.size(rows) >= 2) & (share < 0.3), F.lit(False))


def build_dictionary(products: DataFrame, level_names: DataFrame, categories: DataFrame, default_category: str) -> DataFrame:
    """Ingredient dictionary from product rows (atc_code, ingredient, brand, maker, seq) in one plan: grouped, cleaned, salt-split, classified."""
    g = aggregates.group_lists(products.withColumn("brand", T.brand(F.col("brand"))), ["ingredient"], "seq", ["atc_code"], ["brand", "maker"])
    s = T.salt_split(F.col("ingredient"))
    lv = T.atc_levels(F.col("atc_code"))
    g = g.withColumn("base", s["base"]).withColumn("salt", s["salt"]).withColumn("is_recombinant", T.is_antibody(s["base"]))
    g = g.withColumns({f"level{i}": lv[f"level{i}"] for i in (1, 2, 3)})
    for i in (1, 2, 3):
        g = g.join(level_names.select(F.col("code").alias(f"level{i}"), F.col("name").alias(f"level{i}_name")), f"level{i}", "left")
        g = g.join(categories.select(F.col("code").alias(f"level{i}"), F.col("category").alias(f"_c{i}")), f"level{i}", "left")
    return g.withColumn("therapeutic_category", F.coalesce("_c3", "_c2", "_c1", F.lit(default_category))).drop("_c1", "_c2", "_c3")


def derive_keywords(name: Column, special: dict[str, list[str]], suffixes: list[str]) -> Column:
    """The keywords of the first special name contained, else the words of the name less its suffix words."""
    out = None
    for k, words in special.items():
        a = F.array(*map(F.lit, words))
        out = F.when(name.contains(k), a) if out is None else out.when(name.contains(k), a)
    cut = F.regexp_replace(name, "(" + "|".join(map(re.escape, suffixes)) + ")$", "") if suffixes else name
    words = F.filter(F.split(cut, r"[\s,/()]+"), lambda w: F.length(w) > 0)
    return words if out is None else out.otherwise(words)


def acceptance(expected: DataFrame, results: DataFrame, key: list[str]) -> DataFrame:
    """C11: expected decisions against results: pass, fail or missing."""
    j = expected.withColumnRenamed("decision", "expected").join(results.select(*key, "decision"), key, "left")
    return j.withColumn("status", F.when(F.col("decision").isNull(), "missing").when(F.col("decision") == F.col("expected"), "pass").otherwise("fail"))


def canonical(df: DataFrame, synonyms: DataFrame, name: str) -> DataFrame:
    """Names by their canonical form."""
    return df.join(synonyms.select(F.col("alias").alias(name), "canonical"), name, "left").withColumn(name, F.coalesce("canonical", name)).drop("canonical")
