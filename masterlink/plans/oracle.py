"""DuckDB SQL for the registered queries, written on its own: the resolver's rows come from a row-by-row simulation.

Lists, folding, rules and word sets are stated or built here anew; only the SQL that makes the input rows is shared.
"""

from __future__ import annotations

import json
import re
from importlib import resources
from types import SimpleNamespace

from masterlink.sources.firms import FIRMS_SQL, MENTIONS_SQL

# What the simulation needs to know of the queries.
SCORES = {"CANONICAL_EXACT": 100.0, "PHRASE_SLOP": 95.0, "TOKEN_COVERAGE": 90.0, "NEW_MASTER": 100.0, "DIRTY_DATA": 100.0, "EXCLUDED": 0.0}
NA_MARKERS = ("na", "n a", "nan", "nil", "none", "null", "s n", "sn")
ZERO_WIDTH = "[\u200b\u200c\u200d\ufeff\u00ad]"
CANONICAL = ("business_sectors", "legal_suffixes")
ALIASES = {"address_terms": "address_abbreviations", "company_types": "legal_suffixes"}
SHARED = ("common", "countries")


def packaged_rules() -> list[tuple[str, str, int, int, str, str | None]]:
    """The claimed rules of the packaged dictionaries, in plain Python."""
    files = {f.name[:-5]: json.loads(f.read_text(encoding="utf-8")) for f in (resources.files("masterlink") / "data" / "rules").iterdir() if f.name.endswith(".json")}
    out = []
    for name in sorted(set(files) - set(SHARED)):
        entries = []
        for priority, file in [(0, name), *((1, s) for s in SHARED)]:
            for key, rules in files[file].items():
                category = ALIASES.get(key, key)
                for number, rule in enumerate(rules):
                    left, arrow, right = rule.lower().strip().partition("=>")
                    sources = [s.strip() for s in left.split(",") if s.strip()]
                    target = right.strip() if arrow else sources[0] if len(sources) > 1 and category in CANONICAL else None
                    entries += [(priority, category, number, place, s, target) for place, s in enumerate(sources)]
        entries.sort(key=lambda e: (e[0], [-ord(c) for c in e[1]], e[2], e[3]))
        seen = set()
        for priority, category, number, _, source, target in entries:
            pool = "canonical" if category in CANONICAL else category
            if (pool, source) not in seen:
                seen.add((pool, source))
                out.append((name.upper(), category, priority, number, source, target))
    return out


RULES = packaged_rules()
COUNTRIES = sorted({r[0] for r in RULES})
VOCABULARY = SimpleNamespace(rows=sorted(((r[0], r[1], r[4], r[5]) for r in RULES), key=repr), countries=COUNTRIES)


def pieces(phrase: str) -> list[str]:
    return [w for w in re.split(r"[\s.,&]+", phrase) if w]


def word_sets() -> dict[str, dict[str, list[str]]]:
    """The sets of words by kind and country, and under `canon` the rewrites, from the claimed rules."""
    kinds = ("articles", "placeholders", "legal", "address", "sector", "legal_tokens", "fragments", "geo", "generic")
    sets: dict[str, dict[str, set[str]]] = {k: {c: set() for c in COUNTRIES} for k in kinds}
    canon: dict[str, dict[str, str]] = {c: {} for c in COUNTRIES}
    both = {"legal_suffixes": "legal_tokens", "business_sectors": "sector", "address_abbreviations": "address"}
    for c, category, _, _, source, target in sorted(RULES, key=lambda r: repr((r[0], r[1], r[4], r[5]))):
        ends = [source] + [target] * bool(target)
        if category in both:
            sets[both[category]][c] |= {w for w in ends if " " not in w}
        if category == "articles" and " " not in source:
            sets["articles"][c].add(source)
        if category == "non_firm_placeholders":
            sets["placeholders"][c].add(source)
        if category == "legal_suffixes":
            sets["legal"][c] |= {source} - {s for s in [source] if " " in s}
            sets["fragments"][c] |= {w for e in ends for w in pieces(e) if w.isalpha() and len(w) < 5}
        if category == "country_names" and (target or "").upper() == c and " " not in source and len(source) > 3:
            sets["geo"][c].add(source)
        if category in CANONICAL and target and (left := " ".join(pieces(source))) and left != (right := " ".join(pieces(target))):
            canon[c].setdefault(left, right)
    for c in COUNTRIES:
        sets["generic"][c] = sets["legal_tokens"][c] | sets["sector"][c] | sets["articles"][c] | sets["geo"][c] | {w for t in canon[c].values() for w in t.split()}
    return {k: {c: sorted(w) for c, w in v.items()} for k, v in sets.items()} | {"canon": canon}


SETS = word_sets()


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple], *names: str) -> str:
    cell = lambda v: str(v) if isinstance(v, int) else text(v)
    return "(SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + f") v({', '.join(names)}))"


def lists(table: dict[str, list[str]]) -> str:
    return "MAP {" + ", ".join(f"{text(k)}: [" + ", ".join(map(text, v)) + "]::VARCHAR[]" for k, v in table.items()) + "}"


def fold(x: str) -> str:
    inner = f"translate(strip_accents(lower({x})), 'øłđħŧıأإآىة', 'oldhtiااايه')"
    return rf"regexp_replace(replace(replace(replace({inner}, 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'), '[\p{{M}}ـ]', '', 'g')"


def glue(x: str) -> str:
    """RE2 has no look-ahead: dots before other than letters are hidden first."""
    hidden = rf"regexp_replace({x}, '\.([^\p{{L}}]|$)', chr(1) || '\1', 'g')"
    return rf"replace(regexp_replace({hidden}, '\b(\p{{L}})\.', '\1', 'g'), chr(1), '.')"


def light_clean(x: str, keep: str = r"[^\p{L}\p{N}\p{M}_\s.\-]") -> str:
    t = rf"regexp_replace(lower(trim(regexp_replace({x}, '\s+', ' ', 'g'))), '{ZERO_WIDTH.encode().decode('unicode_escape')}', '', 'g')"
    for pattern in (r"^(email|attn|tel|phone|web|site)\s*:", r"\bc/o\b", r"\battn\b", r"\bcare of\b", r"\bto\s+(the\s+)?order\s+of\b"):
        t = f"regexp_replace({t}, '{pattern}', '', 'g')"
    t = rf"regexp_replace({t}, '\s*&\s*', ' and ', 'g')"
    t = rf"trim(regexp_replace(regexp_replace({t}, '{keep}', ' ', 'g'), '\s+', ' ', 'g'))"
    return no_repeats(t)


def no_repeats(t: str) -> str:
    return f"(SELECT array_to_string(list_filter(w, lambda t, i: i = 1 OR t <> w[i - 1]), ' ') FROM (SELECT list_filter(string_split({t}, ' '), lambda t: t <> '') AS w))"


_CANON = SETS["canon"]
_LONGEST = max(len(s.split()) for m in _CANON.values() for s in m)
_CANON_MAP = "MAP {" + ", ".join(f"{text(c + '|' + s)}: {text(t)}" for c, m in _CANON.items() for s, t in m.items()) + "}"


def _rewrite() -> str:
    phrase = lambda n: f"canon[country_code || '|' || array_to_string(raw[x.skip:x.skip + {n - 1}], ' ')]"
    hits = " ".join(f"WHEN x.skip + {n - 1} <= len(raw) AND {phrase(n)} IS NOT NULL THEN {{'skip': {n - 1}, 'out': list_concat(acc.out, string_split({phrase(n)}, ' '))}}" for n in range(_LONGEST, 0, -1))
    start = "list_concat([{'skip': 0::BIGINT, 'out': []::VARCHAR[]}], list_transform(range(1, len(raw) + 1), lambda i: {'skip': i, 'out': []::VARCHAR[]}))"
    return f"list_reduce({start}, lambda acc, x: CASE WHEN acc.skip > 0 THEN {{'skip': acc.skip - 1, 'out': acc.out}} {hits} ELSE {{'skip': 0, 'out': list_append(acc.out, raw[x.skip])}} END).out"


_NORM = rf"trim(regexp_replace({fold('name')}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
_HELD = "NOT list_contains(generic, t)"
_CORE = "list_filter(regexp_split_to_array(lower({name}), '[^a-z0-9]+'), lambda t: length(t) > 1 AND NOT regexp_matches(t, '^[0-9]+$') AND NOT list_contains(list_concat({drop}), t))"
#: The analysis of distinct names: firms, voc, nm (names) and an (all analysis columns).
CHAIN = rf"""
firms AS ({FIRMS_SQL}),
voc AS (SELECT {_CANON_MAP} AS canon, {lists(SETS["articles"])} AS articles_, {lists(SETS["generic"])} AS generic_, {lists(SETS["address"])} AS address_,
  {lists(SETS["fragments"])} AS fragments_, {lists(SETS["placeholders"])} AS placeholders_, {lists(SETS["legal"])} AS legal_, {lists(SETS["geo"])} AS geo_, {lists(SETS["legal_tokens"])} AS legal_tokens_),
nm AS (SELECT name, country_code, min(id) AS first_id FROM firms GROUP BY ALL),
a0 AS (SELECT *, {", ".join(f"coalesce({x}_[country_code], []) AS {x}" for x in ("articles", "generic", "address", "fragments", "placeholders", "legal", "geo", "legal_tokens"))},
  regexp_extract_all(regexp_replace({fold(glue("name"))}, '[.,]+', ' ', 'g'), '[\p{{L}}\p{{N}}_]+(?:''\p{{L}}+)?') AS raw FROM nm, voc),
a1 AS (SELECT *, {_rewrite()} AS clean FROM a0),
a2 AS (SELECT *, list_filter(clean, lambda t: NOT list_contains(articles, t)) AS tokens, list_transform(clean, lambda t: CASE WHEN list_contains(articles, t) THEN '_' ELSE t END) AS marked FROM a1),
an AS (SELECT *, len(tokens) AS token_count, array_to_string(list_sort(tokens), ' ') AS class_key,
  regexp_replace(array_to_string(marked, ' '), '^(_( |$))+|( _)+$', '', 'g') AS gap_signature,
  array_to_string(list_sort(list_distinct(tokens)), ' ') AS canonical_full,
  array_to_string(list_sort(list_distinct(list_filter(raw, lambda t: NOT list_contains(fragments, t) AND NOT list_contains(articles, t)))), ' ') AS fingerprint,
  len(list_filter(tokens, lambda t: length(t) >= 2 AND {_HELD})) > 0 AS core,
  len(list_filter(tokens, lambda t: length(t) >= 2 AND regexp_matches(t, '\p{{L}}') AND {_HELD})) > 0 AS alpha_core,
  len(list_filter(tokens, lambda t: list_contains(address, t))) > 0 AND len(list_filter(tokens, lambda t: length(t) >= 2 AND regexp_matches(t, '\p{{L}}') AND NOT list_contains(address, t) AND {_HELD})) = 0 AS dirty,
  {_CORE.format(name="name", drop="fragments, legal")} AS core_words, {_CORE.format(name="name", drop="list_concat(fragments, legal), geo")} AS core_no_geo,
  CASE WHEN trim(name) = '' THEN 'empty' WHEN NOT list_contains({[*COUNTRIES]}, country_code) THEN 'invalid_country' WHEN {_NORM} = '' THEN 'no_alnum'
    WHEN list_contains(placeholders, {_NORM}) THEN 'placeholder' WHEN {_NORM} IN {NA_MARKERS} THEN 'na_marker' END AS reason FROM a2)"""
_SCORE = "CASE match_type " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in SCORES.items()) + " END"


def resolved(cover: bool = True, rows: str = "firms", slop: int = 1) -> str:
    """CHAIN and res: every row's outcome, by taking the rows of each class one after another."""
    near = "len(a.tk) = len(r.tk) AND a.tk = r.tk AND list_max(list_transform(range(1, len(r.pos) + 1), lambda i: a.pos[i] - r.pos[i])) - list_min(list_transform(range(1, len(r.pos) + 1), lambda i: a.pos[i] - r.pos[i])) <= {slop}".replace("{slop}", str(slop))
    return f"""WITH RECURSIVE {CHAIN},
ar AS (SELECT *, regexp_matches(fingerprint, '\\p{{L}}') AS lettered, list_filter(string_split(gap_signature, ' '), lambda t: t <> '_') AS tk,
  list_filter(list_transform(range(1, len(string_split(gap_signature, ' ')) + 1), lambda i: CASE WHEN string_split(gap_signature, ' ')[i] <> '_' THEN i END), lambda i: i IS NOT NULL) AS pos FROM an),
cr AS (SELECT f.id, ar.country_code, ar.class_key, ar.gap_signature AS gap, ar.core, ar.alpha_core, ar.lettered, ar.dirty, ar.tk, ar.pos, row_number() OVER (PARTITION BY ar.country_code, ar.class_key ORDER BY f.id) AS rn
  FROM {rows} f JOIN ar ON f.name = ar.name AND f.country_code = ar.country_code WHERE ar.reason IS NULL),
sim(country_code, class_key, rn, anchors, id, match_type, master_id) AS (
  SELECT country_code, class_key, rn, [{{'id': id, 'gap': gap, 'tk': tk, 'pos': pos}}], id, CASE WHEN dirty THEN 'DIRTY_DATA' ELSE 'NEW_MASTER' END, id FROM cr WHERE rn = 1
  UNION ALL
  SELECT country_code, class_key, rn, CASE WHEN coalesce(exact, near, cover) IS NULL THEN list_append(anchors, {{'id': id, 'gap': gap, 'tk': tk, 'pos': pos}}) ELSE anchors END, id,
    CASE WHEN exact IS NOT NULL THEN 'CANONICAL_EXACT' WHEN near IS NOT NULL THEN 'PHRASE_SLOP' WHEN cover IS NOT NULL THEN 'TOKEN_COVERAGE' WHEN dirty THEN 'DIRTY_DATA' ELSE 'NEW_MASTER' END, coalesce(exact, near, cover, id)
  FROM (SELECT r.*, s.anchors,
      CASE WHEN r.core THEN list_min(list_transform(list_filter(s.anchors, lambda a: a.gap = r.gap), lambda a: a.id)) END AS exact,
      CASE WHEN r.alpha_core THEN list_min(list_transform(list_filter(s.anchors, lambda a: {near}), lambda a: a.id)) END AS near,
      {"CASE WHEN r.lettered THEN list_min(list_transform(s.anchors, lambda a: a.id)) END" if cover else "NULL::BIGINT"} AS cover
    FROM sim s JOIN cr r ON r.country_code = s.country_code AND r.class_key = s.class_key AND r.rn = s.rn + 1)),
res AS (SELECT f.*, an.reason, an.core_words, an.fingerprint, CASE WHEN an.reason = 'empty' THEN NULL WHEN an.reason IS NOT NULL THEN 'EXCLUDED' ELSE sim.match_type END AS match_type,
  CASE WHEN an.reason = 'empty' THEN NULL WHEN an.reason IS NOT NULL THEN f.id ELSE sim.master_id END AS master_id
  FROM {rows} f JOIN an ON f.name = an.name AND f.country_code = an.country_code LEFT JOIN sim ON sim.id = f.id)"""


STAGES = ("CANONICAL_EXACT", "PHRASE_SLOP", "TOKEN_COVERAGE")
_WON = f"match_type IN {STAGES}"
#: The poor resolution by country and length, its matched rows (mr) and its distinct pairs of names (pr).
POOR = f"""{resolved()},
poor AS (SELECT id, name, country_code, core_words, match_type, min(id) OVER (PARTITION BY country_code, length(name)) AS master_id FROM res),
mr AS (SELECT id, master_id AS master_code, trim(name) AS name, country_code AS country, match_type, list_sort(list_distinct(core_words)) AS core FROM poor WHERE match_type <> 'EXCLUDED' AND match_type IS NOT NULL),
pk AS (SELECT id, name, country_code, core_words, master_id FROM poor WHERE match_type IS NOT NULL AND match_type <> 'EXCLUDED'),
pr AS (SELECT DISTINCT m.name AS master_name, v.name AS variant_name, m.country_code AS master_country, v.country_code AS variant_country, m.core_words AS x, v.core_words AS y
  FROM pk v JOIN pk m ON v.master_id = m.id WHERE v.id <> v.master_id AND m.id = m.master_id)"""
#: Fingerprints of master variations.
VARIATIONS = f"""{resolved()},
va AS (SELECT DISTINCT master_id, country_code, fingerprint, name FROM res WHERE match_type IN ('NEW_MASTER', 'DIRTY_DATA', 'CANONICAL_EXACT')),
fp AS (SELECT DISTINCT country_code, fingerprint, master_id FROM va WHERE fingerprint <> '' AND len(list_filter(string_split(fingerprint, ' '), lambda t: length(t) >= 2)) > 0),
gr AS (SELECT country_code, fingerprint, count(*) AS master_count, list(master_id ORDER BY master_id) AS ids FROM fp GROUP BY ALL HAVING count(*) > 1)"""
MERGED = f"""{VARIATIONS},
ed AS (SELECT DISTINCT a.master_id AS a, b.master_id AS b FROM fp a JOIN fp b ON a.country_code = b.country_code AND a.fingerprint = b.fingerprint),
rc(a, b) AS (SELECT a, b FROM ed UNION SELECT rc.a, ed.b FROM rc JOIN ed ON rc.b = ed.a),
mm AS (SELECT a AS master_id, min(b) AS primary_id FROM rc GROUP BY a)"""


def per_name(columns: str) -> str:
    return f"WITH {CHAIN} SELECT name, country_code, {columns} FROM an"


def overlap(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect(list_distinct({a}), list_distinct({b}))) / len(list_distinct(list_concat({a}, {b}))) END"


def keyed(key: str, where: str = "true", rows: str = "fz") -> str:
    return f"k AS (SELECT first_id AS id, country_code, {key} AS key FROM {rows} WHERE {where}), m AS (SELECT country_code, key, min(id) AS master_id FROM k WHERE key <> '' GROUP BY ALL) SELECT k.id AS probe_id, m.master_id FROM k JOIN m ON k.country_code = m.country_code AND k.key = m.key WHERE k.id > m.master_id"


_FUZZY = f"WITH {CHAIN}, fz AS (SELECT *, array_to_string(core_words, ' ') AS core_key, array_to_string(list_filter(raw, lambda t: list_contains(legal_tokens, t)), ' ') AS suffix FROM an WHERE reason IS NULL)"
_SET = lambda c: f"list_sort(list_distinct({c}))"
_BASIC = f"CASE WHEN master_country <> variant_country THEN 'WRONG' WHEN lower(trim(master_name)) = lower(trim(variant_name)) THEN 'CORRECT' WHEN len(x) > 0 AND {_SET('x')} = {_SET('y')} THEN 'CORRECT' WHEN len(x) > 0 AND x[1:4] = y[1:4] THEN 'CORRECT' ELSE 'WRONG' END"
_KEY = lambda n: rf"regexp_replace(regexp_replace(lower({n}), '\b(and|y)\b', '&', 'g'), '[\s&\-+.,;:/]', '', 'g')"
_MIN = "least(length(x[1]), length(y[1]))"
_TYPO = f"(len(list_distinct(x)) = 1 AND len(list_distinct(y)) = 1 AND abs(length(x[1]) - length(y[1])) <= 1 AND {_MIN} > 2 AND len(list_filter(range(1, {_MIN} + 1), lambda i: x[1][i] <> y[1][i])) <= 1)"
_A, _B = "lower(trim(master_name))", "lower(trim(variant_name))"
_ABBREVIATION = f"(contains({_A}, {_B}) OR contains({_B}, {_A}) OR len(list_filter(range(1, least(len(string_split({_A}, ' ')), len(string_split({_B}, ' '))) + 1), lambda i: string_split({_A}, ' ')[i] <> string_split({_B}, ' ')[i] AND length(string_split({_A}, ' ')[i]) > 1 AND length(string_split({_B}, ' ')[i]) > 1 AND (starts_with(string_split({_A}, ' ')[i], string_split({_B}, ' ')[i]) OR starts_with(string_split({_B}, ' ')[i], string_split({_A}, ' ')[i])))) > 0)"
_SUB = "(len(list_filter(x, lambda t: NOT list_contains(y, t))) = 0 OR len(list_filter(y, lambda t: NOT list_contains(x, t))) = 0)"
_BEGINS = "len(list_filter(x, lambda s: len(list_filter(y, lambda t: length(s) > 2 AND length(t) > 2 AND (starts_with(s, t) OR starts_with(t, s)))) > 0)) > 0"
_VARIANTS = f"""CASE WHEN master_country <> variant_country THEN 'WRONG' WHEN {_A} = {_B} THEN 'CORRECT' WHEN len(x) = 0 OR len(y) = 0 THEN 'UNCERTAIN' WHEN {_SET("x")} = {_SET("y")} THEN 'CORRECT'
  WHEN {_KEY("master_name")} = {_KEY("variant_name")} THEN 'CORRECT' WHEN {_ABBREVIATION} THEN 'CORRECT' WHEN {_TYPO} THEN 'CORRECT' WHEN {_SUB} THEN 'WRONG'
  WHEN len(list_intersect(x, y)) = 0 AND NOT {_BEGINS} THEN 'WRONG' ELSE 'UNCERTAIN' END"""
_SHARED, _DX, _DY = "len(list_intersect(list_distinct(x), list_distinct(y)))", "len(list_distinct(x))", "len(list_distinct(y))"
_TRACE = "(VALUES ('CANONICAL_EXACT', 1), ('PHRASE_SLOP', 2), ('TOKEN_COVERAGE', 3)) s(stage_name, stage_order)"

_TOKEN_SETS = {"generic": SETS["generic"], "legal": SETS["legal_tokens"], "sector": SETS["sector"], "address": SETS["address"], "article": SETS["articles"], "geo": SETS["geo"]}


def _collisions() -> list[tuple[str, str, str]]:
    found: dict[tuple[str, str], set[str]] = {}
    files = {f.name[:-5]: json.loads(f.read_text(encoding="utf-8")) for f in (resources.files("masterlink") / "data" / "rules").iterdir() if f.name.endswith(".json")}
    for name in set(files) - set(SHARED):
        for file in (name, *SHARED):
            for key, rules in files[file].items():
                if ALIASES.get(key, key) in CANONICAL:
                    for rule in rules:
                        left, arrow, right = rule.lower().partition("=>")
                        parts = [s.strip() for s in left.split(",") if s.strip()]
                        target = right.strip() if arrow else parts[0] if len(parts) > 1 else None
                        for s in parts:
                            found.setdefault((name.upper(), s), set()).update([target] if target else [])
    return [(c, s, "|".join(sorted(t))) for (c, s), t in sorted(found.items()) if len(t) > 1]


ORACLE_SQL: dict[str, str] = {
    "filter_classify_input": per_name("reason"),
    "filter_invalid_country": f"WITH {CHAIN} SELECT country_code, count(*) AS n, list_contains({[*COUNTRIES]}, country_code) AS indexable FROM firms GROUP BY country_code",
    "exclusion_report": f"WITH {CHAIN}, e AS (SELECT f.name, reason FROM firms f JOIN an USING (name, country_code) WHERE reason IS NOT NULL) SELECT reason, count(*) AS n, array_to_string(list_sort(list_distinct(list(name)))[1:8], '|') AS samples FROM e GROUP BY reason",
    "placeholder_semi_join": f"WITH {CHAIN} SELECT f.id, f.country_code, {_NORM.replace('name', 'f.name')} AS norm FROM firms f JOIN an ON f.name = an.name AND f.country_code = an.country_code WHERE list_contains(an.placeholders, {_NORM.replace('name', 'f.name')})",
    "generic_gate": per_name("core, alpha_core"),
    "fingerprint_gate": per_name(r"regexp_matches(fingerprint, '\p{L}') AS lettered"),
    "address_dirty": per_name("dirty"),
    "country_filter": f"WITH firms AS ({FIRMS_SQL}) SELECT id, name FROM firms WHERE country_code = 'MX'",
    "light_clean": f"WITH firms AS ({FIRMS_SQL}), n AS (SELECT DISTINCT name FROM firms) SELECT name, {light_clean('name')} AS cleaned FROM n",
    "light_clean_documents": f"SELECT doc_id, {light_clean('text', r'[^\w\s.\-]')} AS cleaned FROM documents",
    "consecutive_dedup": f"WITH firms AS ({FIRMS_SQL}), n AS (SELECT DISTINCT name FROM firms) SELECT name, {no_repeats('lower(name)')} AS deduped FROM n",
    "acronym_glue": f"WITH firms AS ({FIRMS_SQL}), n AS (SELECT DISTINCT name FROM firms) SELECT name, {glue('name')} AS glued FROM n",
    "tokenize_explode": f"WITH {CHAIN} SELECT name, country_code, CAST(i - 1 AS INT) AS pos, raw[i] AS token FROM an, range(1, len(raw) + 1) AS r(i)",
    "synonym_canonicalise": per_name("array_to_string(clean, ' ') AS clean"),
    "article_stop": per_name("array_to_string(tokens, ' ') AS tokens, gap_signature"),
    "token_count": per_name("token_count"),
    "canonical_full": per_name("canonical_full"),
    "fingerprint": per_name("fingerprint"),
    "normalize_core": per_name("array_to_string(core_words, ' ') AS core, array_to_string(core_no_geo, ' ') AS core_no_geo"),
    "variation_key": f"WITH firms AS ({FIRMS_SQL}), n AS (SELECT DISTINCT name FROM firms) SELECT name, regexp_replace(lower(trim(name)), '[.,]+$', '') AS key FROM n",
    "master_variations": f"{resolved()}, l AS (SELECT master_id, country_code, {light_clean('name')} AS name, phone FROM res WHERE match_type IN ('NEW_MASTER', 'DIRTY_DATA', 'CANONICAL_EXACT')) SELECT master_id, country_code, array_to_string(list_sort(list_distinct(coalesce(list(name) FILTER (name <> ''), []))), '|') AS variations, array_to_string(list_sort(list_distinct(list(phone))), '|') AS phones FROM l GROUP BY master_id, country_code",
    "rule_claim_precedence": f"SELECT country, category, count(*) AS sources, count(DISTINCT target) AS targets FROM {values(RULES, 'country', 'category', 'priority', 'rule_no', 'source', 'target')} GROUP BY ALL",
    "rule_sources": f"SELECT country, category, CAST(priority AS INT) AS priority, CAST(rule_no AS INT) AS rule_no, source, target FROM {values(RULES, 'country', 'category', 'priority', 'rule_no', 'source', 'target')}",
    "synonym_collisions": f"SELECT country, source, targets FROM {values(_collisions(), 'country', 'source', 'targets')}",
    "legal_fragments": rf"SELECT DISTINCT country, f AS fragment FROM (SELECT country, unnest(list_concat(regexp_split_to_array(source, '[ .,&]+'), regexp_split_to_array(coalesce(target, ''), '[ .,&]+'))) AS f FROM {values([r for r in RULES if r[1] == 'legal_suffixes'], 'country', 'category', 'priority', 'rule_no', 'source', 'target')}) WHERE regexp_matches(f, '^\p{{L}}{{1,4}}$')",
    "token_sets": f"SELECT country, kind, count(*) AS words FROM {values([(c, k, w) for k, v in _TOKEN_SETS.items() for c, ws in v.items() for w in ws], 'country', 'kind', 'word')} GROUP BY ALL",
    "stage_canonical_exact": f"{resolved()} SELECT id, master_id FROM res WHERE match_type = 'CANONICAL_EXACT'",
    "stage_phrase_slop": f"{resolved()} SELECT id, master_id FROM res WHERE match_type = 'PHRASE_SLOP'",
    "stage_token_coverage": f"{resolved()} SELECT id, master_id FROM res WHERE match_type = 'TOKEN_COVERAGE'",
    "resolve_master": f"{resolved()} SELECT id, match_type, master_id, {_SCORE} AS match_score, CASE WHEN {_WON} THEN '[' || match_type || '] score: ' || format('{{:.2f}}', {_SCORE}) WHEN match_type = 'EXCLUDED' THEN 'EXCLUDED: ' || reason WHEN match_type = 'DIRTY_DATA' THEN 'address words only' WHEN match_type = 'NEW_MASTER' THEN 'no relevant matches' END AS match_details FROM res",
    "resolve_as_written": f"{resolved(cover=False)} SELECT id, match_type, master_id FROM res",
    "unmatched_anti_join": f"{resolved()} SELECT id FROM res WHERE match_type IS NULL OR NOT {_WON}",
    "stage_tax_exact": rf"WITH firms AS ({FIRMS_SQL}), fz AS (SELECT id AS first_id, country_code, upper(regexp_replace(concat('tx-', phone, '.', substr(name, 1, 2)), '[^\w]', '', 'g')) AS tax FROM firms), {keyed('tax')}",
    "stage_stripped_exact": f"{_FUZZY}, {keyed('core_key')}",
    "stage_strict_ordered": f"{_FUZZY}, {keyed('core_key', 'len(core_words) >= 2')}",
    "stage_brand_anchor": f"{_FUZZY}, {keyed("coalesce(core_words[1], '')")}",
    "stage_token_subset": f"{_FUZZY} SELECT a.first_id AS probe_id, min(b.first_id) AS master_id FROM fz a JOIN fz b ON a.country_code = b.country_code AND b.first_id < a.first_id WHERE len(a.tokens) > 0 AND len(list_filter(a.tokens, lambda t: NOT list_contains(b.tokens, t))) = 0 GROUP BY ALL",
    "stage_ngram": f"{_FUZZY}, g AS (SELECT first_id, country_code, list_distinct(list_transform(range(1, length(array_to_string(tokens, ' ')) - 1), lambda i: substr(array_to_string(tokens, ' '), i, 3))) AS g FROM fz WHERE length(array_to_string(tokens, ' ')) >= 3), p AS (SELECT a.first_id AS probe_id, b.first_id AS master_id, round({overlap('a.g', 'b.g')}, 6) AS overlap FROM g a JOIN g b ON a.country_code = b.country_code AND b.first_id < a.first_id) SELECT * FROM p WHERE overlap >= 0.5",
    "stage_suffix_fuzzy": f"{_FUZZY} SELECT a.first_id AS probe_id, min(b.first_id) AS master_id FROM fz a JOIN fz b ON a.country_code = b.country_code AND a.core_key = b.core_key AND b.first_id < a.first_id WHERE a.core_key <> '' AND a.suffix <> '' AND b.suffix <> '' AND levenshtein(a.suffix, b.suffix) <= CASE WHEN length(a.suffix) <= 3 THEN 0 WHEN length(a.suffix) <= 6 THEN 1 ELSE 2 END GROUP BY ALL",
    "audit_rows": f"{resolved()} SELECT CAST(id AS VARCHAR) AS input_id, name AS input_name, country_code, CAST(master_id AS VARCHAR) AS final_master_id, match_type AS final_stage_name, {_SCORE} AS final_score, CAST({_WON} AS BIGINT) AS total_matched_stages FROM res WHERE match_type <> 'EXCLUDED'",
    "stage_log": f"{resolved()} SELECT CAST(id AS VARCHAR) AS input_id, name AS input_name, country_code, stage_name, CAST(stage_order AS INT) AS stage_order, stage_name = match_type AS matched, CASE WHEN stage_name = match_type THEN {_SCORE} ELSE 0.0 END AS es_score, CASE WHEN stage_name = match_type THEN master_id END AS master_id FROM res, {_TRACE} WHERE match_type <> 'EXCLUDED' AND stage_order <= CASE match_type WHEN 'CANONICAL_EXACT' THEN 1 WHEN 'PHRASE_SLOP' THEN 2 ELSE 3 END",
    "match_type_counts": f"{resolved()} SELECT coalesce(match_type, 'TOTAL') AS match_type, count(*) AS n FROM (SELECT coalesce(match_type, 'SKIPPED') AS match_type FROM res) GROUP BY ROLLUP (match_type)",
    "baseline_snapshot": f"{resolved()} SELECT count(*) AS total_rows, count(*) FILTER (master_id IS NULL) AS unmatched, count(DISTINCT master_id) AS unique_masters FROM res",
    "group_size_histogram": f"{resolved()} SELECT members, count(*) AS masters FROM (SELECT count(*) AS members FROM res WHERE match_type <> 'EXCLUDED' GROUP BY master_id) GROUP BY members",
    "score_distribution": f"{resolved()} SELECT match_type, min({_SCORE}) AS least, median({_SCORE}) AS middle, max({_SCORE}) AS most FROM res WHERE match_type IS NOT NULL GROUP BY match_type",
    "topk_masters": f"{resolved()} SELECT master_id, count(*) AS members FROM res WHERE match_type <> 'EXCLUDED' GROUP BY master_id ORDER BY members DESC, master_id LIMIT 20",
    "anchor_self_join": f"{resolved()} SELECT b.id, b.name, a.name AS anchor_name, b.match_type FROM res a JOIN res b ON a.master_id = b.master_id WHERE a.match_type = 'NEW_MASTER' AND b.match_type <> 'NEW_MASTER' AND a.name <> b.name ORDER BY b.id LIMIT 100",
    "dup_groups": f"{VARIATIONS} SELECT country_code, fingerprint, master_count, array_to_string(ids[1:200], ',') AS master_ids FROM gr",
    "merge_plan": f"{VARIATIONS} SELECT country_code, fingerprint, ids[1] AS primary_id, array_to_string(ids[2:], ',') AS secondaries FROM gr",
    "repoint": f"{MERGED} SELECT r.id, CASE WHEN r.match_type = 'NEW_MASTER' AND mm.primary_id <> r.master_id THEN 'AUTO_DEDUP' ELSE r.match_type END AS match_type, coalesce(mm.primary_id, r.master_id) AS master_id FROM res r LEFT JOIN mm USING (master_id)",
    "merge_variations": f"{MERGED}, l AS (SELECT coalesce(mm.primary_id, r.master_id) AS master_id, r.country_code, {light_clean('r.name')} AS name, phone FROM res r LEFT JOIN mm USING (master_id) WHERE match_type IN ('NEW_MASTER', 'DIRTY_DATA', 'CANONICAL_EXACT')) SELECT master_id, country_code, count(DISTINCT name) FILTER (name <> '') AS variations, count(DISTINCT phone) AS phones FROM l GROUP BY ALL",
    "potential_duplicates": f"{VARIATIONS}, f1 AS (SELECT DISTINCT country_code, fingerprint, master_id FROM va WHERE fingerprint <> ''), g1 AS (SELECT country_code, fingerprint, count(*) AS master_count, list(master_id ORDER BY master_id) AS ids FROM f1 GROUP BY ALL HAVING count(*) > 1), s1 AS (SELECT country_code, fingerprint, list_sort(list_distinct(list(name)))[1:5] AS names FROM va GROUP BY ALL) SELECT fingerprint, country_code, array_to_string(ids[1:50], ',') AS master_ids, master_count, array_to_string(names, '|') AS sample_names FROM g1 JOIN s1 USING (country_code, fingerprint)",
    "connected_components_query": f"WITH firms AS ({FIRMS_SQL}) SELECT id AS node, min(id) OVER (PARTITION BY name) AS component FROM firms QUALIFY count(*) OVER (PARTITION BY name) > 1",
    "over_merge": f"{POOR}, pp AS (SELECT a.master_code, avg({overlap('a.core', 'b.core')}) AS m FROM mr a JOIN mr b ON a.master_code = b.master_code AND a.id < b.id GROUP BY ALL), c AS (SELECT master_code, count(*) AS member_count, list(name ORDER BY id)[1:5] AS names FROM mr GROUP BY ALL), t AS (SELECT master_code, match_type AS dominant_match_type FROM (SELECT master_code, match_type, count(*) AS n FROM mr GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY master_code ORDER BY n DESC, match_type) = 1) SELECT master_code, member_count, round(m, 6) AS mean_overlap, dominant_match_type, array_to_string(names, '|') AS sample_names FROM pp JOIN c USING (master_code) JOIN t USING (master_code) WHERE round(m, 9) < 0.3",
    "splits": f"{resolved()}, s AS (SELECT country_code AS country, array_to_string(list_sort(core_words), ' ') AS core_signature, master_id, trim(name) AS name FROM res WHERE match_type <> 'EXCLUDED') SELECT country, core_signature, array_to_string(list_sort(list_distinct(list(master_id))), ',') AS master_codes, count(*) AS affected_rows, array_to_string(list_sort(list_distinct(list(name)))[1:5], '|') AS sample_names FROM s WHERE core_signature <> '' GROUP BY ALL HAVING count(DISTINCT master_id) > 1",
    "undermerge_clusters": f"{resolved()}, s AS (SELECT r.country_code, array_to_string(r.core_words, ' ') AS cluster_core, array_to_string(list_sort(list_distinct(list_filter(an.raw, lambda t: list_contains(an.legal_tokens, t)))), ' ') AS legal, r.name FROM res r JOIN an USING (name, country_code) WHERE match_type = 'NEW_MASTER') SELECT country_code, cluster_core, legal, count(*) AS masters, array_to_string(list_sort(list_distinct(list(name)))[1:5], '|') AS names FROM s WHERE cluster_core <> '' GROUP BY ALL HAVING count(*) > 1",
    "jaccard_pairs": f"{POOR} SELECT master_name, variant_name, master_country, round({overlap('x', 'y')}, 6) AS overlap FROM pr",
    "core_rel": f"{POOR} SELECT master_name, variant_name, master_country, CASE WHEN {_SHARED} = {_DX} AND {_SHARED} = {_DY} THEN 'identical' WHEN {_SHARED} > 0 AND {_SHARED} = least({_DX}, {_DY}) THEN 'subset' WHEN {_SHARED} > 0 THEN 'partial_overlap' ELSE 'disjoint' END AS core_rel FROM pr",
    "rubric_q1": f"{POOR} SELECT master_name, variant_name, master_country, {_BASIC} AS verdict FROM pr",
    "rubric_q3": f"{POOR} SELECT master_name, variant_name, master_country, {_VARIANTS} AS verdict FROM pr",
    "verdict_summary": f"{POOR}, v AS (SELECT master_country AS stage, {_BASIC} AS verdict FROM pr) SELECT stage, count(*) AS pairs, count(*) FILTER (verdict = 'CORRECT') AS correct, count(*) FILTER (verdict = 'WRONG') AS wrong, count(*) FILTER (verdict = 'UNCERTAIN') AS uncertain, round(count(*) FILTER (verdict = 'CORRECT') / count(*) FILTER (verdict IN ('CORRECT', 'WRONG')), 6) AS precision FROM v GROUP BY stage",
    "array_set_ops": per_name("array_to_string(list_sort(list_distinct(list_concat(raw, tokens))), ' ') AS either, array_to_string(list_sort(list_distinct(list_filter(raw, lambda t: list_contains(tokens, t)))), ' ') AS both, array_to_string(list_sort(list_distinct(list_filter(raw, lambda t: NOT list_contains(tokens, t)))), ' ') AS only_raw"),
    "golden_probe": f"{resolved()}, g AS (SELECT id, master_id, country_code || '/' || array_to_string(list_sort(core_words), ' ') AS gr FROM res WHERE match_type <> 'EXCLUDED'), v AS (SELECT coalesce(sum(n - 1) FILTER (k > 1), 0) AS violations FROM (SELECT count(*) AS n, count(DISTINCT gr) AS k FROM g GROUP BY master_id)), f AS (SELECT gr, max(n) AS best, sum(n) AS size FROM (SELECT gr, master_id, count(*) AS n FROM g GROUP BY ALL) GROUP BY gr), r AS (SELECT coalesce(sum(best) FILTER (size > 1 AND best > 1), 0) AS found, coalesce(sum(size) FILTER (size > 1), 0) AS wanted FROM f) SELECT CAST(violations AS BIGINT) AS violations, CAST(found AS BIGINT) AS found, CAST(wanted AS BIGINT) AS wanted, round(found / wanted, 6) AS recall, round(found / (found + violations), 6) AS precision FROM v, r",
    "events_rollup": "SELECT coalesce(event_type, 'TOTAL') AS event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY ROLLUP (event_type)",
    "events_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL",
}
ORACLE_SQL["resolve_mentions"] = f"{resolved(rows='mentions').replace('WITH RECURSIVE', f'WITH RECURSIVE mentions AS ({MENTIONS_SQL}),', 1)} SELECT coalesce(match_type, 'SKIPPED') AS match_type, count(*) AS n, count(DISTINCT master_id) AS masters FROM res GROUP BY ALL"

_PAIR_SLOP = "len(a.tk) = len(b.tk) AND a.tk = b.tk AND list_max(list_transform(range(1, len(a.pos) + 1), lambda i: a.pos[i] - b.pos[i])) - list_min(list_transform(range(1, len(a.pos) + 1), lambda i: a.pos[i] - b.pos[i])) <= 1"
ORACLE_SQL |= {
    "stage_waterfall": f"{resolved()}, o AS (SELECT CASE match_type WHEN 'CANONICAL_EXACT' THEN 1 WHEN 'PHRASE_SLOP' THEN 2 WHEN 'TOKEN_COVERAGE' THEN 3 ELSE 4 END AS o FROM res WHERE match_type <> 'EXCLUDED') SELECT CAST(stage_order AS INT) AS stage_order, stage_name, count(*) FILTER (o >= stage_order) AS asked, count(*) FILTER (o = stage_order) AS matched, count(*) FILTER (o > stage_order) AS left FROM o, {_TRACE} GROUP BY ALL",
    "stage_hits": f"{resolved()} SELECT stage_name, count(*) AS asked, count(*) FILTER (stage_name = match_type) AS won FROM res, {_TRACE} WHERE match_type <> 'EXCLUDED' AND stage_order <= CASE match_type WHEN 'CANONICAL_EXACT' THEN 1 WHEN 'PHRASE_SLOP' THEN 2 ELSE 3 END GROUP BY stage_name",
    "legacy_writer": f"{resolved()} SELECT id, CAST(master_id AS VARCHAR) AS master_code, CAST({_SCORE} AS INT) AS match_score FROM res WHERE master_id IS NOT NULL",
    "matched_rows": f"{resolved()} SELECT id, master_id AS master_code, trim(name) AS name, country_code AS country, match_type FROM res WHERE match_type <> 'EXCLUDED'",
    "exact_name_masters": f"WITH firms AS ({FIRMS_SQL}) SELECT country_code, lower(trim(name)) AS key, min(id) AS master_id, count(*) AS rows FROM firms WHERE trim(name) <> '' GROUP BY ALL",
    "anti_self_probe": f"WITH {CHAIN}, k AS (SELECT f.id, f.country_code, an.gap_signature AS g FROM firms f JOIN an USING (name, country_code) WHERE an.core AND an.reason IS NULL), m AS (SELECT country_code, g, list_sort(list(id)) AS ids FROM k GROUP BY ALL HAVING count(*) > 1) SELECT k.id, CASE WHEN ids[1] = k.id THEN ids[2] ELSE ids[1] END AS other_id FROM k JOIN m USING (country_code, g)",
    "boosted_probe": f"WITH {CHAIN}, r AS (SELECT f.id, f.country_code, f.phone, an.canonical_full AS a, an.fingerprint AS b FROM firms f JOIN an USING (name, country_code) WHERE an.reason IS NULL), h AS (SELECT id AS probe_id, min(id) OVER (PARTITION BY country_code, a) AS master_id FROM r WHERE a <> '' UNION ALL SELECT id, min(id) OVER (PARTITION BY country_code, b) FROM r WHERE b <> ''), s AS (SELECT probe_id, master_id, count(*)::DOUBLE AS p FROM h WHERE probe_id > master_id GROUP BY ALL) SELECT probe_id, master_id, p + CASE WHEN x.phone = y.phone THEN 5.0 ELSE 0.0 END AS score FROM s JOIN r x ON x.id = probe_id JOIN r y ON y.id = master_id",
    "count_remaining": f"{resolved()} SELECT country_code, count(*) FILTER (master_id IS NULL) AS remaining, count(*) AS n FROM res GROUP BY country_code",
    "verify_pairs": f"""{resolved()}, n AS (SELECT name, country_code, substr(fingerprint, 1, 6) AS k FROM an WHERE reason IS NULL), m AS (SELECT country_code, k, min(name) AS master FROM n GROUP BY ALL),
p AS (SELECT n.country_code, n.name AS probe, m.master FROM n JOIN m ON n.country_code = m.country_code AND n.k = m.k WHERE n.name <> m.master)
SELECT p.country_code, probe, master, a.class_key = b.class_key AND a.core AND a.gap_signature = b.gap_signature AS canonical_exact, a.class_key = b.class_key AND a.alpha_core AND coalesce({_PAIR_SLOP}, false) AS phrase_slop, a.class_key = b.class_key AND a.lettered AS token_coverage
FROM p JOIN ar a ON a.country_code = p.country_code AND a.name = probe JOIN ar b ON b.country_code = p.country_code AND b.name = master""",
}
#: The firms as a table with other column names, of which every third row has a master already.
_TABLE = f"firms AS ({FIRMS_SQL}), tb AS (SELECT id AS row_no, name AS title, country_code AS cc, CASE WHEN id % 3 = 0 THEN 'old' END AS master_code FROM firms)"
ORACLE_SQL |= {
    "stage_phrase_slop_wide": f"{resolved(slop=3)} SELECT id, master_id FROM res WHERE match_type = 'PHRASE_SLOP'",
    "unprocessed_rows": f"WITH {_TABLE} SELECT row_no AS id, title AS name, cc AS country_code FROM tb WHERE master_code IS NULL AND cc = 'MX'",
    "bulk_update": f"{resolved()} SELECT id AS row_no, name AS title, country_code AS cc, coalesce(CAST(master_id AS VARCHAR), CASE WHEN id % 3 = 0 THEN 'old' END) AS master_code, {_SCORE} AS match_score, match_type FROM res",
    "reset_results": f"WITH {_TABLE} SELECT row_no, cc, CASE WHEN cc = 'MX' THEN NULL ELSE master_code END AS master_code FROM tb",
    "boosted_tax_probe": ORACLE_SQL["boosted_probe"].replace("f.id, f.country_code, f.phone,", "f.id, f.country_code, f.phone, upper(regexp_replace(concat('t-', f.phone, substr(f.name, 1, 1)), '[^\\w]', '', 'g')) AS tax,").replace("ELSE 0.0 END AS score", "ELSE 0.0 END + CASE WHEN x.tax = y.tax THEN 10.0 ELSE 0.0 END AS score"),
    "retired_scalars": rf"""WITH firms AS ({FIRMS_SQL}), n AS (SELECT DISTINCT name, concat(name, ' SUITE 5') AS x FROM firms)
SELECT name, regexp_replace(regexp_replace(lower(name), '\bl t d\b', 'ltd', 'g'), '\bi n c\b', 'inc', 'g') AS spelled,
  trim(regexp_replace(regexp_replace(concat(name, ' (old) [x]'), '\([^)]*\)|\[[^\]]*\]', ' ', 'g'), '\s+', ' ', 'g')) AS unbracketed,
  CASE WHEN regexp_extract(x, '(?i)^(.*\b(?:limited|ltd)\b)', 1) <> '' THEN regexp_extract(x, '(?i)^(.*\b(?:limited|ltd)\b)', 1) ELSE x END AS anchored,
  concat('pvt|ltd|', replace(lower(name), ' ', '|')) AS unfused FROM n""",
}
