"""The gate chain (C1, C12) and the seeded sample (G3) against plain Python."""

import random
import re
import struct
from difflib import SequenceMatcher

import pytest
import xxhash

from medgraph.operators import curate as C
from medgraph.operators import ordering as W

RULES = {
    "hard": ["form"], "conditional": ["box"], "hints": ["HINT"], "suffixes": [{"en": "mab", "ko": ["mab", "map"], "strict": True}, {"en": "ib", "ko": ["ib"]}],
    "regimen": ["folfox"], "biomarker": ["egfr"], "disease": ["cancer"], "context_tokens": ["TOKEN"], "strict": 0.25, "loose": 0.6, "high_frequency": 20,
}


def chain(entries, curated, brands, promotion):
    """Decision and reasons by seq, one entry after the other; only conflicts look at the others."""
    sure = {(a.lower(), b) for a, b in curated}
    resolved = {}
    for brand, ingredient in brands:
        resolved[brand.lower()] = min(ingredient, resolved.get(brand.lower(), ingredient))
    out, passed = {}, {}
    for en, ko, count, context, seq in entries:
        en, ko, context = (en or "").lower(), ko or "", context or ""
        if (en, ko) in sure:
            out[seq] = ["active", ["PASS_ALL", "CURATED_WHITELIST"]]
            continue
        why, decision = [], None
        if en in resolved:
            en = resolved[en].lower()
            why.append("BRAND_RESOLVED_EN")
        if ko in RULES["hard"]:
            decision, why = "drop", [*why, "FORM_TERM"]
        elif ko in RULES["conditional"] and not any(h in context for h in RULES["hints"]):
            decision, why = "drop", [*why, "CONTEXT_PACKAGING"]
        for kind in ("regimen", "biomarker", "disease"):
            if not decision and re.search(rf"(?i)(^|[^A-Za-z0-9])({'|'.join(RULES[kind])})($|[^A-Za-z0-9])", en):
                decision, why = f"route_{kind}", [*why, f"ROUTE_{kind.upper()}"]
        for s in RULES["suffixes"]:
            if decision or not en.endswith(s["en"]):
                continue
            agrees = any(ko.endswith(k) for k in s["ko"])
            if not s.get("strict"):
                why += [] if agrees else ["SUFFIX_MISMATCH_WARN"]
            elif agrees:
                why.append("SUFFIX_MATCH_STRICT")
            else:
                decision, why = "pending", [*why, "SUFFIX_MISMATCH"]
        if not decision and "SUFFIX_MATCH_STRICT" not in why:
            score = SequenceMatcher(None, en, ko.replace("가", "ga")).ratio()
            if 1 - score > (RULES["strict"] if count >= RULES["high_frequency"] else RULES["loose"]):
                beside = any(d.lower() == en and a in context for a, d in promotion) and "SUFFIX_MISMATCH_WARN" not in why and score >= 0.30
                why.append("PHONETIC_FAIL")
                if beside or any(t in context for t in RULES["context_tokens"]):
                    why.append("CTX_PROMOTE")
                else:
                    decision = "pending"
        out[seq] = [decision, why]
        if not decision and ko:
            passed.setdefault(ko, []).append((seq, en))
    for same in passed.values():
        first = min(same)[1]
        for seq, en in same:
            if en != first:
                out[seq] = ["pending", [*out[seq][1], "ALIAS_CONFLICT"]]
    return {k: (d or "active", why if d else ["PASS_ALL", *why]) if d != "active" else (d, why) for k, (d, why) in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_gate_chain_against_plain_python(spark, seed):
    rng = random.Random(seed)
    names = ["nivolumab", "gefitinib", "folfox b", "egfr", "lung cancer", "alpha", "alpho", "betax", "Brand", "ib", "", None]
    local = ["nivolumab", "nivolumap", "gefitinib", "gefit", "form", "box", "alpha", "alphx", "beta", "가b", "zzz", "", None]
    spans = ["", None, "HINT here", "TOKEN", "ANCHOR near", "plain"]
    entries = [(rng.choice(names), rng.choice(local), rng.choice([1, 19, 20, 50]), rng.choice(spans), i) for i in range(400)]
    curated, brands, promotion = [("ALPHA", "zzz"), ("betax", "beta")], [("brand", "gefitinib"), ("BRAND", "Alpha")], [("ANCHOR", "Alpho"), ("ANCHOR", "gefitinib")]
    got = C.gate_chain(
        spark.createDataFrame(entries, "en string, ko string, count int, context_span string, seq long").repartition(3), RULES,
        spark.createDataFrame(curated, "en string, ko string"), spark.createDataFrame(brands, "brand string, ingredient string"), promotion=spark.createDataFrame(promotion, "anchor string, drug string"),
    ).collect()
    want = chain(entries, curated, brands, promotion)
    assert {r.seq: (r.decision, r.reason_codes) for r in got} == want and len(got) == len(want)
    seen = {c for _, why in want.values() for c in why}
    assert {"PASS_ALL", "CURATED_WHITELIST", "BRAND_RESOLVED_EN", "FORM_TERM", "CONTEXT_PACKAGING", "ROUTE_DISEASE", "SUFFIX_MISMATCH", "SUFFIX_MATCH_STRICT", "SUFFIX_MISMATCH_WARN", "PHONETIC_FAIL", "CTX_PROMOTE", "ALIAS_CONFLICT"} <= seen


def test_seeded_sample_against_plain_python(spark):
    def place(key, seed):
        h = xxhash.xxh64_intdigest(struct.pack("<i", seed), xxhash.xxh64_intdigest(struct.pack("<q", key), 42))
        return (h - (1 << 64) if h >> 63 else h, key)

    keys = [k * 7919 % 5003 for k in range(700)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    for seed in (42, 7):
        assert [r.k for r in W.seeded_sample(df, "k", 30, seed).collect()] == sorted(keys, key=lambda k: place(k, seed))[:30]
