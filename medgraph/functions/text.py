"""Scalar functions over names, codes and texts (columns in, columns out).

Everything is native except NFKC folding and the matching-block ratio, which Spark lacks; those
two are Arrow UDFs to be applied to distinct strings.  Patterns with word or space classes carry
(?U), so Hangul counts as letters.  Null in, null out, unless stated.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

#: Characters folded in names (quotes, hyphens, plus signs, middle dots).
FOLD_FROM = "“”„‟‘’‚‛‐‑‒–—―−＋﹢"
FOLD_TO = "\"\"\"\"''''-------++"
#: Latin spellings of the Hangul initials, vowels and finals, by position in a syllable block.
INITIALS = ("g", "kk", "n", "d", "tt", "r", "m", "b", "pp", "s", "ss", "", "j", "jj", "ch", "k", "t", "p", "h")
VOWELS = ("a", "ae", "ya", "yae", "eo", "e", "yeo", "ye", "o", "wa", "wae", "oe", "yo", "u", "weo", "we", "wi", "yu", "eu", "ui", "i")
FINALS = ("", "g", "kk", "gs", "n", "nj", "nh", "d", "l", "lg", "lm", "lb", "ls", "lt", "lp", "lh", "m", "b", "bs", "s", "ss", "ng", "j", "ch", "k", "t", "p", "h")
#: Greek letters and their names.
GREEK = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "ζ": "zeta", "η": "eta", "θ": "theta", "κ": "kappa", "λ": "lambda", "μ": "mu", "ω": "omega"}
#: Dosage forms that end a product name, longest first.
FORMS = ("서방캡슐", "서방정", "주사액", "주입액", "현탁액", "캡슐", "주사", "시럽", "분말", "과립", "패치", "키트", "연질", "경질", "정", "주", "펜", "액")
#: Salts that end an ingredient name.
SALTS = ("hydrochloride", "dihydrochloride", "mesylate", "acetate", "sulfate", "tosylate", "citrate", "maleate", "tartrate", "phosphate", "potassium", "sodium", "disodium", "calcium", "magnesium")
#: Korean salts that end an ingredient name, and their English names.
SALTS_KO = {"아세테이트": "acetate", "염산염": "hydrochloride", "황산염": "sulfate", "구연산염": "citrate", "이말레산염": "maleate", "말레산염": "maleate", "주석산염": "tartrate", "인산염": "phosphate", "칼륨": "potassium", "나트륨": "sodium", "칼슘": "calcium", "마그네슘": "magnesium"}
#: Greek letters and their Korean names.
GREEK_KO = {"α": "알파", "β": "베타", "γ": "감마", "δ": "델타", "ε": "엡실론", "ζ": "제타", "η": "에타", "θ": "세타", "κ": "카파", "λ": "람다", "μ": "뮤", "ω": "오메가"}
#: Parts of names of recombinant ingredients.
RECOMBINANT = ("-mab", "filgrastim", "interferon", "interleukin")
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮"


#: Bytes of text that a worker turns to Python objects or numbers at once.
SLICE = 1 << 18


def bounded_slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of whole texts of about SLICE bytes; a longer text is its own."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE, "right")))
        yield texts.slice(at, end - at)
        at = end


def collapse(c: Column) -> Column:
    """White space runs as one space, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def fold_punctuation(c: Column) -> Column:
    return F.translate(c, FOLD_FROM, FOLD_TO)


@F.arrow_udf(StringType())
def nfkc(s: pa.Array) -> pa.Array:
    fold = lambda x: None if x is None else unicodedata.normalize("NFKC", x)
    return pa.concat_arrays([pa.array([fold(x) for x in p.to_pylist()], pa.string()) for p in bounded_slices(s)] or [pa.array([], pa.string())])


def normalize_text(c: Column) -> Column:
    """NFKC, folded punctuation, collapsed space."""
    return collapse(fold_punctuation(nfkc(c)))


def normalize_case(c: Column, lang: Column) -> Column:
    """Latin names in lower case, others as they are."""
    return F.when(lang == "en", F.lower(c)).otherwise(c)


def romanize(c: Column) -> Column:
    """Hangul syllables spelt in Latin letters, everything else kept."""
    part = lambda names, i: F.element_at(F.array(*map(F.lit, names)), (i + 1).cast("int"))

    def spell(ch: Column) -> Column:
        at = F.ascii(ch) - 44032
        return F.when((at >= 0) & (at < 11172), F.concat(part(INITIALS, F.floor(at / 588)), part(VOWELS, F.floor(at % 588 / 28)), part(FINALS, at % 28))).otherwise(ch)

    return F.array_join(F.transform(F.split(c, ""), spell), "")


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """2M/T over matching blocks."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


def similarity_bound(a: Column, b: Column) -> Column:
    """At least similarity(a, b): matching blocks hold no letter more often than both sides do.  Two empty strings are alike."""
    letters = F.filter(F.array_distinct(F.split(a, "")), lambda x: x != "")
    times = lambda c, x: (F.length(c) - F.length(F.replace(c, x, F.lit("")))) / F.length(x)
    shared = F.aggregate(letters, F.lit(0.0), lambda n, x: n + F.least(times(a, x), times(b, x)))
    return F.coalesce(F.try_divide(2 * shared, F.length(a) + F.length(b)), F.lit(1.0))


def strip_form(c: Column, forms: tuple[str, ...] = FORMS) -> Column:
    return F.regexp_replace(c, f"({'|'.join(forms)})$", "")


def ingredient_in_parens(c: Column) -> Column:
    """The first ( ) group, up to its first comma."""
    return F.nullif(F.trim(F.split(F.regexp_extract(c, r"\(([^)]*)\)", 1), ",")[0]), F.lit(""))


def brand(c: Column, forms: tuple[str, ...] = FORMS) -> Column:
    """Text before a parenthesis, underscore or digit, less one dosage form."""
    return F.nullif(strip_form(F.trim(F.regexp_extract(c, r"^([^(_0-9]*)", 1)), forms), F.lit(""))


def brand_spec(c: Column) -> Column:
    """(short name, ingredient, spec) of name(ingredient)_(spec)."""
    return F.struct(
        F.trim(F.substring_index(F.substring_index(c, "_", 1), "(", 1)).alias("short_name"),
        ingredient_in_parens(F.substring_index(c, "_", 1)).alias("ingredient"),
        F.nullif(F.regexp_extract(c, r"_\(([^)]*)\)?$", 1), F.lit("")).alias("spec"),
    )


def squeeze(c: Column) -> Column:
    """All white space out."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def brand_variants(c: Column) -> Column:
    """Squeezed name, stem before a parenthesis, and stem less its form; sorted."""
    stem = squeeze(F.substring_index(c, "(", 1))
    return F.array_sort(F.filter(F.array_distinct(F.array(squeeze(c), stem, strip_form(stem))), lambda x: F.length(x) > 0))


def search_keys(c: Column) -> Column:
    """Head, dose-stripped head, form-stripped head, first ingredient."""
    head = F.trim(F.substring_index(c, "(", 1))
    undosed = F.trim(F.regexp_replace(head, r"[0-9]+(\.[0-9]+)?\s*(mg|g|ml|mcg|㎎|밀리그램|그램|밀리리터)?.*$", ""))
    return F.filter(F.array_distinct(F.array_compact(F.array(head, undosed, strip_form(undosed), ingredient_in_parens(c)))), lambda x: F.length(x) > 0)


def normalize_key(c: Column) -> Column:
    """Lower case without separators and other non-word characters."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[\s\-_/,.()]+", ""), r"(?U)[^\w]+", "")


def salt_split(c: Column, salts: tuple[str, ...] = SALTS, korean: dict[str, str] = SALTS_KO) -> Column:
    """(base, salt) of an ingredient name; an English salt is a last word of its own, a Korean one ends the name, the longest first."""
    end = rf"(?i)\s+({'|'.join(salts)})$"
    end_ko = f"({'|'.join(sorted(korean, key=lambda k: -len(k)))})$"
    found = F.nullif(F.lower(F.regexp_extract(c, end, 1)), F.lit(""))
    found_ko = F.nullif(F.regexp_extract(c, end_ko, 1), F.lit(""))
    names = F.create_map(*[F.lit(x) for kv in korean.items() for x in kv])
    base = F.when(found.isNotNull(), F.regexp_replace(c, end, "")).when(found_ko.isNotNull(), F.regexp_replace(c, end_ko, "")).otherwise(c)
    return F.struct(F.trim(base).alias("base"), F.coalesce(found, names[found_ko]).alias("salt"))


def name_with_source(original: Column, extracted: Column, manual: Column) -> Column:
    """(name, source): the manual name, else an extracted one that differs from the original, else the code system's."""
    own = extracted.isNotNull() & (extracted != "") & ~extracted.eqNullSafe(original)
    return F.struct(F.coalesce(manual, F.when(own, extracted), original).alias("name"), F.when(manual.isNotNull(), "manual").when(own, "extracted").otherwise("atc").alias("source"))


def is_antibody(c: Column) -> Column:
    """Recombinant by name; null is false."""
    return F.coalesce(F.lower(c).rlike("|".join(("mab$", *RECOMBINANT))), F.lit(False))


def atc_levels(c: Column) -> Column:
    """Level 1 to 3 prefixes, null where the code is shorter."""
    cut = lambda n: F.when(F.length(c) >= n, F.substring(c, 1, n))
    return F.struct(cut(3).alias("level1"), cut(4).alias("level2"), cut(5).alias("level3"))


_UNIT = r"[μµ](?=g|m|l|L|M|mol)"


def greek_letters(c: Column) -> Column:
    """Distinct Greek letters outside units, sorted."""
    bare = F.regexp_replace(c, _UNIT, "")
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(bare), F.lit(f"([{''.join(GREEK)}])"), 1)))


def greek_synonyms(c: Column, names: dict[str, str] = GREEK) -> Column:
    """Names with Greek letters spelt out (names: GREEK or GREEK_KO), with and without the hyphen after them; empty without such letters."""
    full = c
    for letter, name in names.items():
        full = F.regexp_replace(full, rf"(?iu){letter}(?!g|mol|[mlLM])" if letter == "μ" else rf"(?iu){letter}", name)
    plain = F.regexp_replace(full, f"({'|'.join(names.values())})-", "$1")
    return F.when(F.size(greek_letters(c)) > 0, F.array_sort(F.array_distinct(F.array(full, plain)))).otherwise(F.array().cast("array<string>"))


def alias_fold(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Ordered replacement of upper-cased aliases."""
    out = F.upper(c)
    for a, b in pairs:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def plain_name(c: Column) -> Column:
    """Lower case, parentheses dropped with their content, one space."""
    return collapse(F.regexp_replace(F.lower(c), r"\([^)]*\)", ""))


def disease_code(c: Column) -> Column:
    """Kind (range, detailed, category, chapter), chapter, number, end number."""
    grab = lambda p, i: F.nullif(F.regexp_extract(c, p, i), F.lit(""))
    rng = r"^([A-Z])(\d{2})-([A-Z])(\d{2})$"
    kind = F.when(c.rlike(rng), "range").when(c.rlike(r"^[A-Z]\d{2}\.\d+$"), "detailed").when(c.rlike(r"^[A-Z]\d{2}$"), "category").when(c.rlike(r"^[A-Z]$"), "chapter")
    return F.struct(kind.alias("kind"), grab(r"^([A-Z])", 1).alias("chapter"), grab(r"^[A-Z](\d{2})", 1).cast("int").alias("number"), grab(rng, 4).cast("int").alias("end_number"))


def is_cancer_strict(c: Column) -> Column:
    """C codes and D00 to D48, no ranges; null is false."""
    n = F.regexp_extract(c, r"^D(\d{2})", 1)
    return F.coalesce(~c.contains("-") & (c.startswith("C") | (c.rlike(r"^D\d{2}") & (n.try_cast("int") <= 48))), F.lit(False))


def is_cancer_lenient(c: Column) -> Column:
    """As N21, but ranges that touch C or D are true."""
    return F.coalesce(is_cancer_strict(c) | c.rlike(r"^[CD]\d{2}-"), F.lit(False))


def zero_padded(c: Column, digits: int) -> Column:
    """Digits with zeros before them; longer ones stay."""
    return F.lpad(c, F.greatest(F.length(c), F.lit(digits)), F.lit("0"))


def article_number(c: Column) -> Column:
    """제3조의2 as 003_02."""
    n, b = F.regexp_extract(c, r"제(\d+)조", 1), F.regexp_extract(c, r"조의(\d+)", 1)
    return F.when(n != "", F.concat_ws("_", zero_padded(n, 3), F.when(b != "", zero_padded(b, 2))))


def article_id(law: Column, number: Column, clause: Column, subclause: Column, item: Column) -> Column:
    """ART_law_number_Cn_Sn_Ix, null parts left out."""
    tag = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    return F.concat_ws("_", F.lit("ART"), law, number, tag("C", clause), tag("S", subclause), tag("I", item))


def law_id(name: Column) -> Column:
    """N24."""
    return F.concat(F.lit("LAW_"), F.upper(F.substring(F.md5(name), 1, 8)))


def circled(c: Column) -> Column:
    """③ as 3, null for anything else."""
    return F.nullif(F.position(c, F.lit(CIRCLED)), F.lit(0))


def number_cell(c: Column) -> Column:
    """Number without thousands commas, or null."""
    return F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("double")


def strip_html(c: Column) -> Column:
    """Tags and entities out, quotes and dashes folded, space collapsed."""
    return collapse(fold_punctuation(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", " "), r"&[A-Za-z#0-9]+;", " ")))


def drop_phrases(c: Column, phrases: list[str]) -> Column:
    """Boilerplate out, blank lines collapsed."""
    out = F.regexp_replace(c, "|".join(rf"\Q{p}\E" for p in phrases), "") if phrases else c
    return F.trim(F.regexp_replace(out, r"\n\s*\n+", "\n"))


def context(text: Column, start: Column, end: Column, width: int, ellipsis: bool = False) -> Column:
    """Text around the span start..end (0-based, end exclusive), newlines as spaces."""
    lo = F.greatest(start - width, F.lit(0))
    cut = F.substring(text, lo + 1, end + width - lo)
    out = F.replace(cut, F.lit("\n"), F.lit(" "))
    if ellipsis:
        out = F.concat(F.when(lo > 0, "...").otherwise(""), out, F.when(end + width < F.length(text), "...").otherwise(""))
    return out


def first_label(c: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first keyword that occurs."""
    out = None
    for word, label in rules:
        out = F.when(c.contains(word), label) if out is None else out.when(c.contains(word), label)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def marker_of_title(c: Column, lexicon: list[str]) -> Column:
    """[..], else text after the last underscore, else the first lexicon word in the title."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"\[([^\]]+)\]", 1), F.lit("")), F.nullif(F.regexp_extract(c, r"_([^_]+)$", 1), F.lit("")), first_label(c, [(w, w) for w in lexicon]))


def full_path(number: Column, title: Column, clause: Column, subclause: Column) -> Column:
    """제n조(title) 제n항 제n호."""
    return F.concat_ws(" ", F.concat(F.lit("제"), number, F.lit("조"), F.coalesce(F.concat(F.lit("("), title, F.lit(")")), F.lit(""))), F.concat(F.lit("제"), clause, F.lit("항")), F.concat(F.lit("제"), subclause, F.lit("호")))


def pairs_text(m: Column) -> Column:
    """Map as k=v, k=v in key order."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"].cast("string"), F.coalesce(e["value"].cast("string"), F.lit("")))), ", ")


def markdown(rows: Column, width: Column) -> Column:
    """Array of rows as a markdown table, short rows padded."""
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.slice(F.concat(r, F.array_repeat(F.lit(""), width)), F.lit(1), width), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    made = F.transform(rows, line)
    return F.array_join(F.concat(F.slice(made, 1, 1), F.array(rule), F.slice(made, F.lit(2), F.greatest(F.size(made) - 1, F.lit(0)))), "\n")


def preview(c: Column, n: int) -> Column:
    """N34."""
    return F.concat(F.substring(c, 1, n), F.lit("..."))


def has_latin(c: Column) -> Column:
    """N35."""
    return c.rlike("[A-Za-z]")


def has_hangul(c: Column) -> Column:
    """N35."""
    return c.rlike("[가-힣]")


def law_number(c: Column) -> Column:
    """The number in brackets of a law heading."""
    return F.nullif(F.regexp_extract(c, r"\[[^\]]*제(\d+)호[^\]]*\]", 1), F.lit(""))


def tab_field(c: Column, n: int, default: str = "") -> Column:
    """The n-th tab-parted field."""
    return F.coalesce(F.try_element_at(F.split(c, "\t"), F.lit(n)), F.lit(default))


def null_tokens(c: Column) -> Column:
    """S12: '', 'nan', 'None' as null; whole numbers stored as floats without their .0."""
    t = F.trim(c)
    return F.when(t.isin("", "nan", "None", "NaN"), None).otherwise(F.regexp_replace(t, r"^(\d+)\.0$", "$1"))


def array_literal(c: Column) -> Column:
    """['a', 'b'] as an array, null where it does not parse."""
    return F.from_json(F.replace(c, F.lit("'"), F.lit('"')), "array<string>")
