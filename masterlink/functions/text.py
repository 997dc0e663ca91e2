"""Text functions on columns. All run inside the JVM; the few that need Python are in `unicode` and `phonetic`."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

def folded_letters(until: int = 0x2000) -> tuple[str, str]:
    """Lower-case letters that decompose into a base letter and marks, and these base letters: Latin, Greek, Cyrillic."""
    found = {}
    for c in map(chr, range(0x80, until)):
        base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if c.isalpha() and c == c.lower() and len(base) == 1 and base != c and base.isalpha() and not "\u0600" <= c <= "\u06ff":
            found[c] = base
    return "".join(found), "".join(found.values())


ACCENTED, PLAIN = folded_letters()
# Letters with a stroke and the like, which do not decompose, and their base letters; Arabic letters and their
# normal forms; invisible characters; labels and care-of phrases that the cleaner removes; what it keeps; markers that
# stand for no name; letters that stand for a word each where the standard tokenizer cuts.
STROKES, UNSTRUCK = "øłđħŧıƀɨŀ", "oldhtibil"
ARABIC = "أإآىة"
ARABIC_PLAIN = "ااايه"
ZERO_WIDTH = "[\\u200b\\u200c\\u200d\\ufeff\\u00ad]"
LABEL = r"^(email|attn|tel|phone|web|site)\s*:"
CARE_OF = (r"\bc/o\b", r"\battn\b", r"\bcare of\b", r"\bto\s+(the\s+)?order\s+of\b")
KEEP = r"[^\p{L}\p{N}\p{M}_\s.\-]"
KEEP_ASCII = r"[^\w\s.\-]"
NA_MARKERS = ("n a", "na", "null", "nil", "none", "nan", "s n", "sn")
IDEOGRAPHS = r"\p{IsHan}\p{IsHiragana}"


def words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also where body uses it inside another lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def drop_repeats(tokens: Column) -> Column:
    """Without tokens that equal the one before."""
    return let(tokens, lambda w: F.filter(w, lambda t, i: (i == 0) | (t != F.get(w, i - 1))))


def light_clean(name: Column, unicode: bool = True) -> Column:
    """The cleaner for stored variations: lower case, labels and care-of marks out, punctuation out, no repeated word."""
    t = F.regexp_replace(F.lower(F.trim(F.regexp_replace(name, r"\s+", " "))), ZERO_WIDTH, "")
    t = F.regexp_replace(t, LABEL, "")
    for pattern in CARE_OF:
        t = F.regexp_replace(t, pattern, "")
    t = F.regexp_replace(t, r"\s*&\s*", " and ")
    t = F.trim(F.regexp_replace(F.regexp_replace(t, KEEP if unicode else KEEP_ASCII, " "), r"\s+", " "))
    return F.array_join(drop_repeats(words(t)), " ")


def clean_variations(names: Column, unicode: bool = True) -> Column:
    """light_clean of each name, without empty ones and repeats, in order."""
    return F.array_distinct(F.filter(F.transform(names, lambda n: light_clean(n, unicode)), lambda n: n != ""))


def glue_acronyms(text: Column) -> Column:
    """`K.W.M` becomes `KWM.` less its inner dots."""
    return F.regexp_replace(text, r"\b(\p{L})\.(?=\p{L})", "$1")


def fold(text: Column) -> Column:
    """Lower case without accents; Arabic letters in their normal forms."""
    t = F.translate(F.lower(text), ACCENTED + STROKES + ARABIC, PLAIN + UNSTRUCK + ARABIC_PLAIN)
    t = F.replace(F.replace(F.replace(t, F.lit("ß"), F.lit("ss")), F.lit("æ"), F.lit("ae")), F.lit("œ"), F.lit("oe"))
    return F.regexp_replace(t, r"[\p{M}ـ]", "")


def tokenize(name: Column) -> Column:
    """Folded words, with acronyms glued; ideographs and hiragana are words one by one."""
    word = rf"([{IDEOGRAPHS}]|[\p{{L}}\p{{N}}_&&[^{IDEOGRAPHS}]]+(?:'\p{{L}}+)?)"
    return F.regexp_extract_all(F.regexp_replace(fold(glue_acronyms(name)), "[.,]+", " "), F.lit(word), 1)


def canonicalise(tokens: Column, rewrites: Column, longest: int) -> Column:
    """Rewrite the longest run of tokens that a rule names, from left to right."""

    def step(acc: Column, i: Column) -> Column:
        hits = [F.when((i + n <= F.size(tokens)) & rewrites[F.array_join(F.slice(tokens, i + 1, n), " ")].isNotNull(), F.struct(F.lit(n - 1).alias("skip"), F.split(rewrites[F.array_join(F.slice(tokens, i + 1, n), " ")], " ").alias("out"))) for n in range(longest, 0, -1)]
        hit = F.coalesce(*hits, F.struct(F.lit(0).alias("skip"), F.array(F.get(tokens, i)).alias("out")))
        taken = F.transform(F.array(hit), lambda h: F.struct(h["skip"].alias("skip"), F.concat(acc["out"], h["out"]).alias("out")))[0]
        return F.when(acc["skip"] > 0, F.struct((acc["skip"] - 1).alias("skip"), acc["out"].alias("out"))).otherwise(taken)

    start = F.struct(F.lit(0).alias("skip"), F.array().cast("array<string>").alias("out"))
    every = F.when(F.size(tokens) > 0, F.sequence(F.lit(0), F.size(tokens) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(every, start, step, lambda acc: acc["out"])


def drop_words(tokens: Column, stop: Column) -> Column:
    return F.filter(tokens, lambda t: ~F.array_contains(stop, t))


def holes(tokens: Column, articles: Column) -> Column:
    """Tokens with `_` in place of articles between other tokens."""
    marked = F.array_join(F.transform(tokens, lambda t: F.when(F.array_contains(articles, t), F.lit("_")).otherwise(t)), " ")
    return F.regexp_replace(marked, r"^(_( |$))+|( _)+$", "")


def sorted_set(tokens: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(tokens)), " ")


def canonical_full(tokens: Column) -> Column:
    """The sorted distinct tokens; null beyond 255 characters."""
    return F.when(F.length(sorted_set(tokens)) <= 255, sorted_set(tokens))


def slop_distance(a: Column, b: Column) -> Column:
    """Spread of the position shifts between two hole texts; null if their tokens differ in any place."""
    places = lambda g: F.filter(F.transform(F.split(g, " "), lambda t, i: F.when(t != "_", i)), lambda i: i.isNotNull())
    tokens = lambda g: F.filter(F.split(g, " "), lambda t: t != "_")
    shift = F.zip_with(places(a), places(b), lambda x, y: x - y)
    return F.when(tokens(a) == tokens(b), F.array_max(shift) - F.array_min(shift))


def normalize_core(name: Column, country_fragments: Column, legal_words: Column, geo: Column | None = None) -> Column:
    """Words that tell firms apart: no digits, single letters, legal forms or, if given, geography; order kept."""
    drop = F.concat(country_fragments, legal_words) if geo is None else F.concat(country_fragments, legal_words, geo)
    parts = F.split(F.lower(name), "[^a-z0-9]+")
    return F.filter(parts, lambda t: (F.length(t) > 1) & ~t.rlike("^[0-9]+$") & ~F.array_contains(drop, t))


def input_norm(name: Column) -> Column:
    """Folded, with runs of anything but letters and digits as one space."""
    return F.trim(F.regexp_replace(fold(name), r"[^\p{L}\p{N}]+", " "))


def blank(name: Column) -> Column:
    """Null or white space of any kind."""
    return name.isNull() | name.rlike(r"(?U)^\s*$")


def classify_input(name: Column, placeholders: Column) -> Column:
    """Why a name names no firm: empty, no_alnum, placeholder, na_marker; null if it may."""
    n = input_norm(name)
    return (
        F.when(blank(name), "empty")
        .when(n == "", "no_alnum")
        .when(F.array_contains(placeholders, n), "placeholder")
        .when(n.isin(*NA_MARKERS), "na_marker")
    )


def variation_key(name: Column) -> Column:
    """Under which a variation counts as known: lower case, trimmed, without closing dots and commas."""
    return F.regexp_replace(F.lower(F.trim(name)), "[.,]+$", "")


def details(stage: Column, score: Column) -> Column:
    return F.format_string("[%s] score: %.2f", stage, score)


def token_overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two token lists; 0 if one is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def typo_pair(a: Column, b: Column) -> Column:
    """Lengths differ by one at most, over two letters, and at most one place differs."""
    shorter = F.least(F.length(a), F.length(b))
    left, right = F.split(F.substring(a, 1, 1 << 20), ""), F.split(F.substring(b, 1, 1 << 20), "")
    n = F.greatest(F.lit(1), shorter)
    differ = F.aggregate(F.zip_with(F.slice(left, 1, n), F.slice(right, 1, n), lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, x: s + x)
    return (F.abs(F.length(a) - F.length(b)) <= 1) & (shorter > 2) & (differ <= 1)


def spelling_key(name: Column) -> Column:
    """Names that differ only in `and`, `y`, `&`, blanks and punctuation share it."""
    t = F.regexp_replace(F.lower(name), r"\b(and|y)\b", "&")
    return F.regexp_replace(t, r"[\s&\-+.,;:/]", "")


def abbreviation_pair(a: Column, b: Column) -> Column:
    """One contains the other, or a word of one begins the word at the same place of the other."""
    x, y = F.lower(F.trim(a)), F.lower(F.trim(b))
    n = F.least(F.size(F.split(x, " ")), F.size(F.split(y, " ")))
    pairs = F.arrays_zip(F.slice(F.split(x, " "), 1, n).alias("x"), F.slice(F.split(y, " "), 1, n).alias("y"))
    begins = F.exists(pairs, lambda p: (p["x"] != p["y"]) & (F.length(p["x"]) > 1) & (F.length(p["y"]) > 1) & (p["x"].startswith(p["y"]) | p["y"].startswith(p["x"])))
    return x.contains(y) | y.contains(x) | begins


def tax_norm(tax: Column) -> Column:
    return F.upper(F.regexp_replace(tax, r"[^\w]", ""))


def join_spelled_letters(text: Column, suffixes: list[str]) -> Column:
    """`l t d` becomes `ltd` where the letters spell a known legal form."""
    for s in sorted(suffixes, key=len, reverse=True):
        text = F.regexp_replace(text, r"\b" + " ".join(s) + r"\b", s)
    return text


def split_fused(tokens: Column, fused: dict[str, str]) -> Column:
    """`pvtltd` becomes `pvt`, `ltd`, by a map."""
    if not fused:
        return tokens
    table = F.create_map(*(F.lit(x) for kv in fused.items() for x in kv))
    return F.flatten(F.transform(tokens, lambda t: F.split(F.coalesce(table[t], t), " ")))


def mend_suffixes(tokens: Column, typos: dict[str, str]) -> Column:
    """Misspelt legal forms by a map, then ones with a doubled letter (`lttd`) whose single form the map's targets name."""
    if not typos:
        return tokens
    table = F.create_map(*(F.lit(x) for kv in typos.items() for x in kv))
    known = F.array(*(F.lit(t) for t in sorted(set(typos.values()))))

    def mend(t: Column) -> Column:
        single = F.regexp_replace(t, r"(.)\1", "$1")
        return F.coalesce(table[t], F.when(~F.array_contains(known, t) & F.array_contains(known, single), single), t)

    return F.transform(tokens, mend)


def drop_brackets(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\([^)]*\)|\[[^\]]*\]", " "), r"\s+", " "))


def before_address(text: Column, legal_words: list[str]) -> Column:
    """What stands up to the last legal form, if there is one: addresses follow it."""
    if not legal_words:
        return text
    anchor = "|".join(sorted(legal_words, key=len, reverse=True))
    found = F.regexp_extract(text, rf"(?i)^(.*\b(?:{anchor})\b)", 1)
    return F.when(found != "", found).otherwise(text)
