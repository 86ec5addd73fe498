"""SQL for DuckDB that gives the same rows as the registered queries.

DuckDB's regular expressions know no look-around and only ASCII words. The SQL therefore brackets
every word with two control characters first, so that a word boundary becomes a plain character.
"""

from __future__ import annotations

from millrace.functions import rules
from millrace.functions.regex import SPACE, WORD
from millrace.inputs import item_sql
from millrace.operators.words import byte_letters

S = f"[{SPACE}]"
OPEN, CLOSE = "\x01", "\x02"
SEP = " ¦ "


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rx(expr: str, pattern: str, new: str = "", flags: str = "g") -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(new)}, '{flags}')"


def mark(expr: str) -> str:
    return rx(expr, f"([{WORD}]+)", rf"{OPEN}\1{CLOSE}")


def unmark(expr: str) -> str:
    return rx(expr, f"[{OPEN}{CLOSE}]")


def py(pattern: str) -> str:
    return pattern.replace(r"\s", S).replace(r"\d", r"\p{Nd}").replace(r"\w", f"[{WORD}]")


def strip(expr: str) -> str:
    return rx(expr, py(r"^\s+|\s+$"))


# ---- normalizer ---------------------------------------------------------------------------------

GAP = f"{CLOSE}{S}+{OPEN}"


def marked_words(text: str) -> str:
    """A rule text as a pattern over bracketed words."""
    special = {
        "campbell[’']?s?": f"campbell(?:{CLOSE}[’']{OPEN}s{CLOSE}|s?{CLOSE}|{CLOSE}[’']({OPEN}))",
        "smucker[’']?s?": f"smucker(?:{CLOSE}[’']{OPEN}s{CLOSE}|s?{CLOSE}|{CLOSE}[’']({OPEN}))",
        r"jell[-\s]?o": f"jell(?:{CLOSE}[-{SPACE}]{OPEN})?o{CLOSE}",
        r"e\s*tract": f"e(?:{GAP})?tract{CLOSE}",
        r"low\s*fat": f"low(?:{GAP})?fat{CLOSE}",
        r"carefully washed,\s*dried and": (
            f"carefully{GAP}washed{CLOSE},{S}*{OPEN}dried{GAP}and{CLOSE}"
        ),
    }
    return OPEN + special.get(text, text.replace(" ", GAP) + CLOSE)


def any_of(texts: list[str]) -> str:
    return "(?:" + "|".join(marked_words(t) for t in texts) + ")"


def words_text(text: str) -> str:
    return " ".join(f"{OPEN}{w}{CLOSE}" for w in text.split(" "))


def rewrite(expr: str) -> str:
    s = rx(mark(expr), any_of(rules.BRANDS), "", "gi")
    for i, (first, second) in enumerate(rules.STUCK_PAIRS):
        if i == len(rules.STUCK_PAIRS) - 1:
            s = rx(s, marked_words(rules.STUCK_PREFIX) + f"{S}+", "", "gi")
        pattern = f"{OPEN}({first}){GAP}{second.replace(' ', GAP)}{CLOSE}"
        s = rx(s, pattern, rf"{OPEN}\1{CLOSE} {words_text('or ' + second)}", "gi")
    for wrong, right in rules.MISREADINGS:
        s = rx(s, marked_words(wrong), words_text(right), "gi")
    return unmark(s)


def drop_parens(expr: str) -> str:
    return rx(expr, py(r"\s*\([^)]*\)"))


NUMBER = (
    rf"{OPEN}\p{{Nd}}+{CLOSE}(?:\.{OPEN}\p{{Nd}}+{CLOSE})?(?:{S}*/{S}*{OPEN}\p{{Nd}}+{CLOSE})?"
    rf"|{OPEN}[{rules.FRACTIONS}]{CLOSE}"
)
UNIT = f"{OPEN}(?:{'|'.join(rules.UNITS)}){CLOSE}"


def quantities(expr: str) -> str:
    return unmark(rx(mark(expr), NUMBER))


def units(expr: str) -> str:
    return unmark(rx(mark(expr), UNIT, "", "gi"))


def has_quantity(expr: str) -> str:
    return (
        f"(regexp_matches({mark(expr)}, {q(NUMBER)}) "
        f"OR regexp_matches({mark(expr)}, {q(UNIT)}, 'i'))::INT"
    )


def collapse(expr: str) -> str:
    return strip(rx(expr, py(r"\s+"), " "))


def no_stopwords(tokens: str) -> str:
    listed = ", ".join(q(w) for w in rules.DESCRIPTORS)
    return f"list_filter({tokens}, lambda t: t NOT IN ({listed}))"


def singular(w: str) -> str:
    keep_es = " AND ".join(f"{w} NOT LIKE '%{s}'" for s in rules.KEEP_ES)
    keep_s = " AND ".join(f"{w} NOT LIKE '%{s}'" for s in rules.KEEP_S)
    return (
        f"CASE WHEN length({w}) > 3 AND {w} LIKE '%ies' THEN left({w}, length({w}) - 3) || 'y' "
        f"WHEN length({w}) > 3 AND {w} LIKE '%ves' THEN left({w}, length({w}) - 3) || 'f' "
        f"WHEN length({w}) > 3 AND {w} LIKE '%es' AND {keep_es} THEN left({w}, length({w}) - 2) "
        f"WHEN length({w}) > 2 AND {w} LIKE '%s' AND {keep_s} THEN left({w}, length({w}) - 1) "
        f"ELSE {w} END"
    )


def lookup(expr: str, table: dict[str, str]) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + " END"


def preferred(expr: str) -> str:
    spelled = f"list_transform([{expr}], lambda n: coalesce({lookup('n', rules.SPELLING)}, n))"
    return f"list_transform({spelled}, lambda n: coalesce({lookup('n', rules.ALIASES)}, n))[1]"


def normalize(expr: str) -> str:
    s = rewrite(f"lower({expr})")
    ten = (
        f"{OPEN}10(?:{GAP})?x?(?:{GAP})?sugar{CLOSE}"
        rf"|{OPEN}10{CLOSE}{S}*[×\-]{S}*{OPEN}sugar{CLOSE}"
    )
    s = unmark(rx(mark(s), ten, words_text(rules.TEN_X[1])))
    s = drop_parens(s)
    s = unmark(rx(mark(s), any_of(rules.PHRASES), " ", "gi"))
    s = units(quantities(s))
    s = rx(rx(s, rules.DASHES, " "), rules.STOPS, " ")
    s = collapse(s)
    tokens = no_stopwords(f"string_split({s}, ' ')")
    s = f"array_to_string(list_transform({tokens}, lambda w: {singular('w')}), ' ')"
    return preferred(rx(s, f"^[^{WORD}]+|[^{WORD}]+$"))


# ---- lists --------------------------------------------------------------------------------------


def split_cell(expr: str) -> str:
    parts = f"string_split_regex({strip(expr)}, {q(py(r'\s*[;,]\s*'))})"
    return f"list_filter({parts}, lambda p: {strip('p')} <> '')"


def alternatives(expr: str) -> str:
    # slashes beside a digit are set aside, the others split
    s = rx(rx(strip(expr), r"(\p{Nd})/", "\\1\x03"), r"/(\p{Nd})", "\x03\\1")
    parts = f"string_split_regex({s}, {q(py(r'(?i)\s+(?:or|\|)\s+|\s*/\s*'))})"
    trimmed = f"list_transform({parts}, lambda p: {strip(rx('p', chr(3), '/'))})"
    return f"list_filter({trimmed}, lambda p: p <> '')"


def expand(items: str) -> str:
    each = f"list_transform({items}, lambda x: {drop_parens(rewrite('x'))})"
    alts = (
        f"list_transform({each}, lambda x: CASE WHEN len({alternatives('x')}) > 0 "
        f"THEN {alternatives('x')} ELSE [{strip('x')}] END)"
    )
    return f"list_filter(flatten({alts}), lambda y: y <> '')"


def keys(items: str) -> str:
    return (
        f"list_filter(list_distinct(list_transform({expand(items)}, lambda z: {normalize('z')})), "
        "lambda k: k <> '')"
    )


# ---- inputs -------------------------------------------------------------------------------------

RECIPES = """
recipes AS (SELECT doc_id AS row_id, source, lang, trim(split_part(text, '.', 1)) AS title,
  replace(text, chr(10), ', ') AS ingredients,
  array_to_string(list_sort(list_distinct(string_split(lower(text), ' '))), ', ') AS ner,
  string_split(text, chr(10)) AS directions FROM documents)"""
ITEMS = f"""
part_items AS (SELECT p_partkey AS row_id, {item_sql()} AS item, p_name FROM part)"""
CELLS = f"""{RECIPES}, {ITEMS},
cells AS (SELECT row_id, ingredients AS items, ner AS second FROM recipes
  UNION ALL SELECT -1 - row_id, item, lower(p_name) || ', butter; eggs' FROM part_items)"""
TEXTS = f"""{ITEMS},
texts AS (SELECT doc_id AS row_id, text FROM documents
  UNION ALL SELECT -1 - row_id, item FROM part_items)"""
ROUND = "round({}, {})"


def clean(expr: str) -> str:
    s = rx(strip(expr), f"https?://[^{SPACE}]+")
    s = rx(s, py(r"(?m)^[•\-*]\s*"))
    return rx(s, py(r"\s+"), " ")


def target(title: str, steps: str) -> str:
    lines = (
        f"list_transform(list_filter(list_zip(range(1, len({steps}) + 1), "
        f"list_transform({steps}, lambda s: {clean('s')})), lambda z: z[2] <> ''), "
        "lambda z: 'Step ' || z[1] || ': ' || z[2])"
    )
    head = f"CASE WHEN {strip(title)} <> '' THEN ['Title: ' || {strip(title)}] ELSE [] END"
    return f"array_to_string(list_concat({head}, {lines}), chr(10))"


def split_of(key: str, seed: int = 42, train: float = 0.9, val: float = 0.05) -> str:
    # 52 leading bits of the digest as a fraction
    r = f"('0x' || substr(md5({key} || '#{seed}'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE"
    return (
        f"CASE WHEN {r} < {train!r}::DOUBLE THEN 'train' "
        f"WHEN {r} < {train + val!r}::DOUBLE THEN 'val' ELSE 'test' END"
    )


ROWS = f"""{RECIPES},
targets AS (SELECT row_id, title, ingredients, {target('title', 'directions')} AS recipe FROM recipes),
processed AS (SELECT *, {split_of('title')} AS split FROM targets
  WHERE length(ingredients) > 0 AND length(recipe) > 0)"""

RAW_JSONL = f"""
raw AS (SELECT doc_id AS row_id, replace(text, chr(10), ', ') AS ingredients, text AS recipe
  FROM documents),
cleaned AS (SELECT row_id, {clean('ingredients')} AS ingredients, {clean('recipe')} AS recipe FROM raw),
processed AS (SELECT *, {split_of('ingredients')} AS split FROM cleaned
  WHERE length(ingredients) > 0 AND length(recipe) > 0)"""

ORACLES: dict[str, str] = {}


def on_texts(expr: str) -> str:
    return f"WITH {TEXTS} SELECT row_id, {expr} AS result FROM texts"


# A
ORACLES["src_csv_roundtrip"] = """
SELECT trim(split_part(text, '.', 1)) AS title, replace(text, chr(10), ', ') AS ingredients,
  text AS directions, '' AS ner FROM documents"""
ORACLES["src_jsonl_roundtrip"] = """
SELECT replace(text, chr(10), ', ') AS ingredients, text AS recipe FROM documents"""
ORACLES["sink_split_counts"] = f"""WITH {RAW_JSONL}
SELECT split, count(*) AS n, sum(length(recipe))::BIGINT AS chars FROM processed GROUP BY split"""

# B
ORACLES["clean_text"] = f"""
WITH lines AS (SELECT doc_id, text FROM documents UNION ALL
  SELECT -1 - page_id, '• ' || url || chr(10) || '*' || chr(9) || html || ' ' FROM pages)
SELECT doc_id, {clean('text')} AS cleaned FROM lines"""
ORACLES["parse_list"] = f"""
WITH parts AS (
  SELECT doc_id, 'cell' AS kind, {split_cell('text')} AS l FROM documents UNION ALL
  SELECT doc_id, 'literal', list_filter(list_transform(string_split(text, chr(10)),
    lambda x: {strip('x')}), lambda x: x <> '') FROM documents)
SELECT doc_id, kind, len(l)::BIGINT AS n, array_to_string(l, '{SEP}') AS parts FROM parts"""
ORACLES["rewrite_rules"] = on_texts(rewrite("text"))
ORACLES["split_alternatives"] = on_texts(f"array_to_string({alternatives('text')}, '{SEP}')")
ORACLES["strip_quantities"] = on_texts(quantities("text"))
ORACLES["strip_units"] = on_texts(units("text"))
ORACLES["collapse_ws"] = on_texts(collapse("text"))
ORACLES["collapse_commas"] = on_texts(
    rx(rx("text", py(r"\s*,(?:\s*,)*\s*"), ", "), "^[ ,]+|[ ,]+$")
)
ORACLES["stopword_drop"] = on_texts(
    f"array_to_string({no_stopwords('string_split(lower(text), chr(32))')}, ' ')"
)
ORACLES["singularize"] = on_texts(
    f"array_to_string(list_transform(string_split(lower(text), ' '), lambda w: {singular('w')}), ' ')"
)
ORACLES["has_quantity"] = on_texts(has_quantity("text"))
ORACLES["readable_text"] = on_texts(strip(rx("replace(text, 'Ġ', ' ')", " {2,}", " ")))
ORACLES["dict_map"] = f"""WITH {ITEMS},
w AS (SELECT unnest(string_split_regex(lower(item), '[ ,;.]+')) AS w FROM part_items)
SELECT {preferred('w')} AS name, count(*) AS n FROM w WHERE w <> '' GROUP BY 1"""
ORACLES["normalize_item"] = f"""WITH {RECIPES}, {ITEMS},
split AS (SELECT row_id, {split_cell('ingredients')} AS l FROM recipes),
one AS (SELECT row_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS item FROM split
  UNION ALL SELECT -1 - row_id, 0, item FROM part_items)
SELECT row_id, pos::BIGINT AS pos, {normalize('item')} AS name FROM one"""
ORACLES["format_target"] = f"""WITH {RECIPES}
SELECT row_id, {target('title', 'directions')} AS recipe FROM recipes"""
ORACLES["title_line"] = f"""WITH {ROWS}
SELECT row_id, {strip("split_part(recipe, chr(10), 1)")} AS first_line FROM processed"""
ORACLES["prompt_template"] = f"""WITH {RECIPES}
SELECT row_id, 'Ingredients: ' || ingredients || chr(10) || CASE WHEN row_id % 3 = 0
    THEN 'Recipe:' || chr(10) || 'Title:' ELSE 'Recipe:' END AS prompt,
  'Ingredients: ' || ingredients || chr(10) || 'Recipe: ' || title AS sample FROM recipes"""

ORACLES["stopword_drop_table"] = ORACLES["stopword_drop"]
ORACLES["part_names_replaced"] = f"""WITH {ITEMS},
tokens AS (SELECT row_id, generate_subscripts(w, 1) AS pos, unnest(w) AS word
  FROM (SELECT row_id, string_split(lower(item), ' ') AS w FROM part_items)),
words AS (SELECT DISTINCT word FROM tokens WHERE length(word) > 4),
names AS (SELECT word, min(word) OVER (PARTITION BY word[1:4]) AS name FROM words)
SELECT row_id, string_agg(coalesce(name, word), ' ' ORDER BY pos) AS result
FROM tokens LEFT JOIN names USING (word) GROUP BY row_id"""

# C
ORACLES["drop_empty"] = f"""WITH {ITEMS},
named AS (SELECT row_id, {normalize('item')} AS name FROM part_items)
SELECT row_id, name FROM named WHERE name <> ''"""
ORACLES["first_n"] = f"""WITH {RECIPES}
SELECT row_id, title FROM recipes WHERE title <> '' AND ingredients <> ''
ORDER BY row_id LIMIT 200"""

# D
ORACLES["expand_items"] = f"""WITH {CELLS}
SELECT row_id, array_to_string({expand(split_cell('items'))}, '{SEP}') AS items FROM cells"""
KEYS = f"""{CELLS},
sets AS (SELECT row_id, {keys(split_cell('items'))} AS a, {keys(split_cell('second'))} AS b FROM cells)"""
for name, merged in {
    "merge_union": "list_distinct(list_concat(a, b))",
    "merge_intersection": "list_intersect(a, b)",
    "merge_second_only": "b",
    "merge_raw": "a",
}.items():
    ORACLES[name] = f"""WITH {KEYS}
SELECT row_id, array_to_string(list_sort({merged}), ', ') AS merged FROM sets"""


def dedup(source: str, column: str) -> str:
    """Best display per key by window, for a table (row_id, column)."""
    return f"""
d_split AS (SELECT row_id, {split_cell(rewrite(column))} AS l FROM {source}),
d_items AS (SELECT row_id, generate_subscripts(l, 1) AS pos, unnest(l) AS raw FROM d_split),
d_trim AS (SELECT row_id, pos, {strip('raw')} AS item FROM d_items),
d_keys AS (SELECT *, {normalize('item')} AS k, {has_quantity('item')} AS rich FROM d_trim),
d_rank AS (SELECT *, min(pos) OVER (PARTITION BY row_id, k) AS first, row_number() OVER (
  PARTITION BY row_id, k ORDER BY rich DESC, length(item) DESC, pos) AS rn FROM d_keys WHERE k <> ''),
d_text AS (SELECT row_id, string_agg(item, ', ' ORDER BY first) AS items FROM d_rank
  WHERE rn = 1 GROUP BY row_id)"""


ORACLES["dedup_best_display"] = f"""WITH {CELLS}, {dedup('cells', 'items')}
SELECT row_id, coalesce(d.items, '') AS items FROM cells LEFT JOIN d_text d USING (row_id)"""
ORACLES["dedup_keep_first"] = f"""WITH {CELLS},
f_items AS (SELECT row_id, generate_subscripts(l, 1) AS pos, unnest(l) AS raw
  FROM (SELECT row_id, string_split(items, ',') AS l FROM cells)),
f_trim AS (SELECT row_id, pos, {strip('raw')} AS item FROM f_items),
f_rank AS (SELECT *, row_number() OVER (PARTITION BY row_id, k ORDER BY pos) AS rn
  FROM (SELECT *, {normalize('item')} AS k FROM f_trim WHERE item <> '')),
f_text AS (SELECT row_id, string_agg(item, ', ' ORDER BY pos) AS items FROM f_rank
  WHERE rn = 1 GROUP BY row_id)
SELECT row_id, coalesce(f.items, '') AS items FROM cells LEFT JOIN f_text f USING (row_id)"""
ORACLES["dedup_best_display_all"] = f"""WITH {CELLS},
a_split AS (SELECT row_id, {split_cell('items')} AS l FROM cells),
a_items AS (SELECT row_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS item FROM a_split),
a_keys AS (SELECT *, {normalize('item')} AS name, {has_quantity('item')} AS rich FROM a_items),
a_rank AS (SELECT *, count(*) OVER w AS n, first_value(row_id) OVER f AS first_row, first_value(pos) OVER f AS first_place,
  row_number() OVER (PARTITION BY name ORDER BY rich DESC, length(item) DESC, row_id, pos) AS rn
  FROM a_keys WHERE name <> '' WINDOW w AS (PARTITION BY name), f AS (PARTITION BY name ORDER BY row_id, pos))
SELECT name, item, n, first_row, first_place FROM a_rank WHERE rn = 1"""
MERGED = f"""{KEYS},
merged AS (SELECT row_id, array_to_string(list_sort(list_distinct(list_concat(a, b))), ', ') AS m
  FROM sets), {dedup('merged', 'm')}"""
ORACLES["build_input"] = f"""WITH {MERGED}
SELECT row_id, lower(coalesce(d.items, '')) AS ingredients
FROM merged LEFT JOIN d_text d USING (row_id)"""


def shown(expr: str) -> str:
    """An item tidied for display."""
    t = drop_parens(clean(rewrite(expr)))
    t = rx(rx(f"replace({t}, ' .', '.')", py(r"\s*,(?:\s*,)*\s*"), ", "), "^[ ,]+|[ ,]+$")
    return rx(f"replace({t}, '.', '')", f"^[^{WORD}]+|[^{WORD}]+$")


def components(table: str, column: str) -> str:
    """Keys of every part of a cell: (row_id, pos, item, k)."""
    return f"""
{table}_l AS (SELECT row_id, {split_cell(column)} AS l FROM cells),
{table}_i AS (SELECT row_id, generate_subscripts(l, 1) AS pos, {strip('unnest(l)')} AS item FROM {table}_l),
{table}_a AS (SELECT *, {expand('[item]')} AS alts FROM {table}_i),
{table}_u AS (SELECT row_id, pos, item, generate_subscripts(alts, 1) AS sub, unnest(alts) AS alt FROM {table}_a),
{table} AS (SELECT row_id, pos, item, sub, {normalize('alt')} AS k FROM {table}_u)"""


ORACLES["merge_keep_display"] = f"""WITH {CELLS}, {components('one', 'items')}, {components('two', 'second')},
disp AS (SELECT *, {shown('item')} AS d FROM one WHERE k <> ''),
rich AS (SELECT *, {has_quantity('d')} AS rich FROM disp WHERE d <> ''),
ranked AS (SELECT *, min(pos * 1000000000 + sub) OVER (PARTITION BY row_id, k) AS seen, row_number() OVER (
  PARTITION BY row_id, k ORDER BY rich DESC, length(d) DESC, pos, sub) AS rn FROM rich),
best AS (SELECT row_id, 1 AS list, seen, k, d FROM ranked WHERE rn = 1),
extra AS (SELECT row_id, 2 AS list, min(pos * 1000000000 + sub) AS seen, k, k AS d FROM two
  WHERE k <> '' AND NOT EXISTS (SELECT 1 FROM best b WHERE b.row_id = two.row_id AND b.k = two.k)
  GROUP BY row_id, k),
joined AS (SELECT row_id, string_agg(d, ', ' ORDER BY list, seen) AS t FROM
  (SELECT * FROM best UNION ALL SELECT * FROM extra) GROUP BY row_id),
merged AS (SELECT row_id, {rx(rx('t', py(r'\s*,(?:\s*,)*\s*'), ', '), '^[ ,]+|[ ,]+$')} AS m FROM joined),
{dedup('merged', 'm')}
SELECT row_id, lower(coalesce(d.items, '')) AS ingredients FROM cells LEFT JOIN d_text d USING (row_id)"""
ORACLES["prepared_rows"] = f"""WITH {MERGED},
built AS (SELECT row_id, lower(coalesce(d.items, '')) AS ingredients
  FROM merged LEFT JOIN d_text d USING (row_id))
SELECT row_id, {strip('title')} AS title, b.ingredients, {target('title', 'steps')} AS recipe,
  {split_of(f"CASE WHEN {strip('title')} <> '' THEN {strip('title')} ELSE b.ingredients END")} AS split
FROM (SELECT *, {split_cell("array_to_string(directions, ';')")} AS steps FROM recipes) JOIN built b USING (row_id)
WHERE b.ingredients <> '' AND {target('title', 'steps')} <> ''"""

# E
ORACLES["hash_split"] = f"""WITH {RECIPES}
SELECT row_id, {split_of('title')} AS split FROM recipes"""
ORACLES["split_counts"] = f"""WITH {ROWS}
SELECT split, count(*) AS n, round(avg(length(recipe)), 6) AS avg_chars FROM processed GROUP BY split"""
ORACLES["split_leakage_audit"] = f"""WITH {RECIPES},
s AS (SELECT title, {split_of('row_id::VARCHAR')} AS split FROM recipes)
SELECT title, min(split) AS lowest, max(split) AS highest, count(*) AS n FROM s
GROUP BY title HAVING min(split) <> max(split)"""
ORACLES["seeded_sample"] = f"""WITH {RECIPES}
SELECT row_id, title FROM recipes ORDER BY md5(row_id || '#123'), row_id LIMIT 200"""
ORACLES["epoch_order"] = """
SELECT doc_id AS row_id, row_number() OVER (ORDER BY md5(doc_id || '#42-1'), doc_id) - 1 AS idx
FROM documents"""
ORACLES["dedup_exact"] = f"""
SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY lower({clean('text')})"""
ORACLES["dedup_exact_rows"] = f"""
SELECT doc_id, lang, length(text) AS chars FROM documents QUALIFY row_number() OVER (
  PARTITION BY lower({clean('text')}) ORDER BY doc_id) = 1"""

# F
ORACLES["corpus_text"] = f"""WITH {ROWS}
SELECT row_id, '<TITLE> ' || {strip("split_part(recipe, chr(10), 1)")} || ' <ING> ' || ingredients
  || ' <REC> ' || recipe AS text FROM processed"""
WHITE = SPACE.replace(r"\x{1c}-\x{20}", r"\x{20}")
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{WHITE}\p{{L}}\p{{N}}{OPEN}]+|[{WHITE}]+"
)


def pieces(expr: str) -> str:
    """A cut before the last white character of a run that a word follows stands for look-ahead."""
    cut = rx(expr, rf"([{WHITE}]+)([{WHITE}][^{WHITE}])", rf"\1{OPEN}\2")
    return f"regexp_extract_all({cut}, {q(PIECES)})"


WORDS = f"""
tokens AS (SELECT unnest({pieces('lower(text)')}) AS word FROM documents),
words AS (SELECT word, count(*) AS n FROM tokens GROUP BY word)"""
LETTERS = "letters AS (SELECT * FROM (VALUES {}) v(code, letter))".format(
    ", ".join(f"('{b:02X}', {q(c)})" for b, c in enumerate(byte_letters()))
)
CODES = "regexp_extract_all(hex(encode(word)), '..')"
ORACLES["pretokenize"] = f"""
SELECT doc_id, len(w)::BIGINT AS n, array_to_string(w, '{SEP}') AS words
FROM (SELECT doc_id, {pieces('text')} AS w FROM documents)"""
ORACLES["word_counts"] = f"WITH {WORDS} SELECT word, n FROM words"
ORACLES["byte_alphabet"] = f"""WITH {LETTERS},
t AS (SELECT lower(text) AS word FROM documents),
c AS (SELECT unnest({CODES}) AS code FROM t)
SELECT letter, count(*) AS n FROM c JOIN letters USING (code) GROUP BY letter"""
ORACLES["pair_counts_round1"] = f"""WITH {WORDS}, {LETTERS},
w AS (SELECT n, {CODES} AS c FROM words),
p AS (SELECT n, unnest(list_zip(c[:-2], c[2:])) AS p FROM w WHERE len(c) > 1)
SELECT a.letter || b.letter AS pair, sum(n)::BIGINT AS n FROM p
JOIN letters a ON p[1] = a.code JOIN letters b ON p[2] = b.code GROUP BY 1"""

# G
ORACLES["decode_roundtrip"] = "SELECT doc_id, lower(text) AS text FROM documents"
TURNS = """
turns AS (SELECT (conv_id::BIGINT << 32) + turn AS row_id, role,
  list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::INT + 8) AS raw
  FROM conversations),
full_ids AS (SELECT row_id, role, list_concat([1], raw, [2]) AS ids FROM turns)"""


def ids_text(expr: str) -> str:
    return f"array_to_string({expr}, ' ')"


ORACLES["add_specials"] = f"WITH {TURNS} SELECT row_id, {ids_text('ids')} AS ids FROM full_ids"
ORACLES["truncate_ids"] = f"WITH {TURNS} SELECT row_id, {ids_text('ids[1:64]')} AS ids FROM full_ids"
BATCHES = f"""{TURNS},
numbered AS (SELECT row_id, ids,
  (row_number() OVER (ORDER BY row_id) - 1) // 16 AS batch_id FROM full_ids),
gaps AS (SELECT *, list_transform(range(max(len(ids)) OVER (PARTITION BY batch_id) - len(ids)),
  lambda i: 0) AS gap, list_transform(ids, lambda i: 1) AS ones FROM numbered)"""
ORACLES["pad_batch"] = f"""WITH {BATCHES}
SELECT row_id, batch_id, {ids_text('list_concat(ids, gap)')} AS input_ids,
  {ids_text('list_concat(ones, gap)')} AS mask FROM gaps"""
ORACLES["pad_left"] = f"""WITH {BATCHES}
SELECT row_id, batch_id, {ids_text('list_concat(gap, ids)')} AS input_ids,
  {ids_text('list_concat(gap, ones)')} AS mask FROM gaps"""
ORACLES["shift_mask"] = f"""WITH {BATCHES}
SELECT row_id, batch_id, {ids_text('list_concat(ids, gap)[:-2]')} AS x,
  {ids_text('list_transform(list_concat(ids, gap)[2:], lambda t: CASE WHEN t = 0 THEN -100 ELSE t END)')}
  AS y FROM gaps"""
ORACLES["min_length"] = f"""
WITH t AS (SELECT p_partkey, list_transform(regexp_extract_all(hex(encode(p_size::VARCHAR)), '..'),
  lambda h: ('0x' || h)::INT + 8) AS ids FROM part)
SELECT p_partkey, {ids_text('CASE WHEN len(ids) < 2 THEN list_concat(ids, [0]) ELSE ids END')} AS ids FROM t"""
ORACLES["vocabulary_meta"] = """
SELECT * FROM (VALUES ('vocab_size', '160'), ('lower', 'true'), ('nfkc', 'true')) v(key, value)
UNION ALL SELECT 'special:' || unnest(['[PAD]', '[BOS]', '[EOS]', '[UNK]', '<ING>', '<REC>', '<TITLE>', '<STEP>']),
  unnest(['0', '1', '2', '3', '4', '5', '6', '7'])"""
ORACLES["run_log_sink"] = """
SELECT event_type || '-' || strftime(ts, '%Y%m%d') AS run_id, event_id::INT AS epoch, value AS train_loss,
  value / 2 AS val_loss, NULL::DOUBLE AS val_ppl, user_id::DOUBLE AS epoch_time_sec FROM events"""
ORACLES["assign_batches"] = f"""WITH {TURNS},
numbered AS (SELECT row_id, row_number() OVER (ORDER BY md5(row_id || '#42-2'), row_id) - 1 AS idx
  FROM turns)
SELECT row_id, idx // 16 AS batch_id, idx % 16 AS pos FROM numbered"""
ORACLES["token_stats"] = f"""WITH {TURNS},
s AS (SELECT role, len(ids) AS size, least(len(ids), 256) AS kept FROM full_ids)
SELECT role, count(*) AS samples, sum(kept - 1)::BIGINT AS tokens,
  (ceil(count(*) / 16.0) * 16 * (max(kept) - 2))::BIGINT AS approx_tokens,
  round(avg((size > 256)::INT), 6) AS truncated_share,
  round(1 - sum(kept) / (count(*) * max(kept))::DOUBLE, 6) AS pad_share FROM s GROUP BY role"""

# H
PAIRS = """
pairs AS (SELECT a.conv_id, a.turn, a.role, a.text AS reference, b.text AS hypothesis
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn)"""


def tokens_13a(expr: str) -> str:
    s = rx(expr, py(r"\s+$"))
    for old, new in [("<skipped>", ""), ("-\n", ""), ("\n", " ")]:
        s = f"replace({s}, {q(old)}, {q(new)})"
    for old, new in [("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]:
        s = f"replace({s}, {q(old)}, {q(new)})"
    s = f"(' ' || {s} || ' ')"
    s = rx(s, r"([!-&(-+:-@\[-`{-~/ ])", r" \1 ")
    s = rx(s, r"([^0-9])([.,])", r"\1 \2 ")
    s = rx(s, r"([.,])([^0-9])", r" \1 \2")
    s = rx(s, r"([0-9])(-)", r"\1 \2 ")
    return f"list_filter(string_split_regex({s}, {q(py(r'\s+'))}), lambda t: t <> '')"


def grams(column: str, out: str) -> str:
    return f"""
{out} AS (SELECT conv_id, turn, n, array_to_string({column}[i : i + n - 1], ' ') AS g, count(*) AS c
  FROM (SELECT conv_id, turn, {column}, n, unnest(range(1, len({column}) - n + 2)) AS i
    FROM toks, (VALUES (1), (2), (3), (4)) o(n)) GROUP BY ALL)"""


BLEU = f"""{PAIRS},
toks AS (SELECT conv_id, turn, {tokens_13a('reference')} AS r, {tokens_13a('hypothesis')} AS h
  FROM pairs), {grams('h', 'hg')}, {grams('r', 'rg')},
stats AS (SELECT p.role, n, sum(least(coalesce(hg.c, 0), coalesce(rg.c, 0))) AS m,
    sum(coalesce(hg.c, 0)) AS t, sum(coalesce(rg.c, 0)) AS rt
  FROM hg FULL JOIN rg USING (conv_id, turn, n, g) JOIN pairs p USING (conv_id, turn) GROUP BY ALL)"""


def bleu(group: str) -> str:
    by = f"GROUP BY {group}, n" if group else "GROUP BY n"
    pick = f"{group}, " if group else ""
    final = f"GROUP BY {group}" if group else ""
    return f"""
orders AS (SELECT {pick}n, sum(m) AS m, sum(t) AS t, sum(rt) AS rt FROM stats {by}),
smooth AS (SELECT *, count(*) FILTER (m = 0) OVER ({'PARTITION BY ' + group if group else ''}
  ORDER BY n) AS zeros FROM orders),
score AS (SELECT {pick}CASE WHEN sum(m) = 0 OR min(t) = 0 OR count(*) FILTER (t > 0) < 4 THEN 0.0
  ELSE 100 * CASE WHEN max(t) FILTER (n = 1) < max(rt) FILTER (n = 1)
    THEN exp(1 - max(rt) FILTER (n = 1) / (max(t) FILTER (n = 1))::DOUBLE) ELSE 1 END
  * exp(avg(ln(CASE WHEN m > 0 THEN m ELSE pow(2.0, -zeros) END / t::DOUBLE))) END AS bleu
  FROM smooth {final})"""


ORACLES["prediction_sink"] = f"""WITH {PAIRS}
SELECT role AS ingredients, reference, hypothesis, kind FROM pairs, (VALUES ('csv'), ('json')) k(kind)"""
ORACLES["eval_pairs"] = f"""WITH {PAIRS}
SELECT conv_id, turn, role, reference, hypothesis FROM pairs"""
ORACLES["bleu_ngram_stats"] = f"""WITH {BLEU}
SELECT n, sum(m)::BIGINT AS matches, sum(t)::BIGINT AS total, sum(rt)::BIGINT AS ref_total
FROM stats GROUP BY n"""
ORACLES["corpus_bleu"] = f"WITH {BLEU}, {bleu('')} SELECT round(bleu, 6) AS bleu FROM score"
ORACLES["corpus_bleu_by_group"] = f"""WITH {BLEU}, {bleu('role')}
SELECT role, round(bleu, 6) AS bleu FROM score"""


def rouge_words(expr: str) -> str:
    s = f"trim({rx(f'lower({expr})', '[^a-z0-9]+', ' ')})"
    return f"list_filter(string_split({s}, ' '), lambda t: t <> '')"


# The length table row by row: for each word of h, a running maximum over the row before.
LCS = f"""
rt AS (SELECT conv_id, turn, {rouge_words('reference')} AS r, {rouge_words('hypothesis')} AS h FROM pairs),
lcs AS (SELECT conv_id, turn, len(r) AS nr, len(h) AS nh,
  list_reduce(h, lambda acc, tok:
    list_transform([list_transform(range(len(r) + 1), lambda k: CASE WHEN k = 0 THEN 0
      ELSE greatest(acc[k + 1], acc[k] + (r[k] = tok)::INT) END)],
      lambda c: list_transform(range(1, len(c) + 1), lambda j: list_max(c[1:j])))[1],
    list_transform(range(len(r) + 1), lambda j: 0)) AS row FROM rt),
rouge AS (SELECT conv_id, turn, CASE WHEN nr = 0 OR nh = 0 THEN 0.0
  ELSE 2.0 * row[nr + 1] / (nr + nh) END AS f1 FROM lcs)"""
ORACLES["rouge_l"] = f"""WITH {PAIRS}, {LCS}
SELECT conv_id, turn, round(f1, 6) AS rouge_l FROM rouge"""
ORACLES["metrics_row"] = f"""WITH {BLEU}, {bleu('')}, {LCS}
SELECT 'val' AS split, (SELECT count(*) FROM pairs) AS "N",
  round(100 * (SELECT avg(f1) FROM rouge), 6) AS "rougeL_f1",
  round((SELECT bleu FROM score), 6) AS bleu"""

ORACLES["perplexity"] = """
SELECT event_type, user_id, round(avg(value / 10), 6) AS mean_loss,
  round(exp(least(20, avg(value / 10))), 2) AS ppl FROM events GROUP BY event_type, user_id"""
LOG = """
log AS (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
  AS epoch, value AS loss FROM events)"""
STOPS = """
best AS (SELECT *, min(loss) OVER (PARTITION BY run_id ORDER BY epoch
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM log),
imp AS (SELECT run_id, epoch, loss, (best IS NULL OR loss < best)::INT AS improved FROM best),
bad AS (SELECT *, epoch - max(CASE WHEN improved = 1 THEN epoch END) OVER (
  PARTITION BY run_id ORDER BY epoch) AS bad_epochs FROM imp),
stops AS (SELECT *, min(CASE WHEN bad_epochs >= {patience} THEN epoch END) OVER (
  PARTITION BY run_id) AS stop_epoch FROM bad)"""
BEST = """
SELECT run_id, max(epoch) FILTER (improved = 1) AS best_epoch,
  min(loss) FILTER (improved = 1) AS best_loss, max(epoch) AS last_epoch
FROM stops WHERE stop_epoch IS NULL OR epoch <= stop_epoch GROUP BY run_id"""
ORACLES["early_stop"] = f"""WITH {LOG}, {STOPS.format(patience=3)}
SELECT run_id, epoch, loss, improved, bad_epochs, stop_epoch FROM stops"""
ORACLES["best_epoch"] = f"WITH {LOG}, {STOPS.format(patience=5)} {BEST}"
ORACLES["early_stop_delta"] = f"""WITH RECURSIVE {LOG},
walk AS (SELECT run_id, epoch, loss, loss AS best, 1 AS improved FROM log WHERE epoch = 1
  UNION ALL
  SELECT l.run_id, l.epoch, l.loss, CASE WHEN l.loss < w.best - 1.5 THEN l.loss ELSE w.best END,
    (l.loss < w.best - 1.5)::INT
  FROM walk w JOIN log l ON l.run_id = w.run_id AND l.epoch = w.epoch + 1),
bad AS (SELECT *, epoch - max(CASE WHEN improved = 1 THEN epoch END) OVER (
  PARTITION BY run_id ORDER BY epoch) AS bad_epochs FROM walk),
stops AS (SELECT *, min(CASE WHEN bad_epochs >= 8 THEN epoch END) OVER (
  PARTITION BY run_id) AS stop_epoch FROM bad) {BEST}"""
ORACLES["sweep_rank"] = """
SELECT event_type, user_id, best_loss, epochs, rank FROM (
  SELECT *, rank() OVER (PARTITION BY event_type ORDER BY best_loss) AS rank FROM (
    SELECT event_type, user_id, min(value) AS best_loss, count(*) AS epochs
    FROM events GROUP BY event_type, user_id))"""


def head(total: str, p: float, where: str = "WHERE place <= 20") -> str:
    return f"""
WITH w AS (SELECT l_suppkey, l_partkey, sum(l_quantity) AS weight FROM lineitem GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY weight DESC, l_partkey) AS place,
  sum(weight) OVER (PARTITION BY l_suppkey) AS whole FROM w),
k AS (SELECT *, sum(weight) OVER (PARTITION BY l_suppkey) AS top FROM r {where}),
c AS (SELECT *, sum(weight) OVER (PARTITION BY l_suppkey ORDER BY place) / {total} AS cum FROM k),
h AS (SELECT * FROM c WHERE cum <= {p} OR place = 1)
SELECT l_suppkey, l_partkey, weight, place, round(cum, 9) AS cum,
  round(weight / sum(weight) OVER (PARTITION BY l_suppkey), 9) AS share FROM h"""


ORACLES["head_mass"] = head("top", 0.6)
ORACLES["head_mass_raw"] = head("whole", 0.05)
ORACLES["head_mass_all"] = head("whole", 0.4, "")
ORACLES["group_softmax"] = """
WITH m AS (SELECT p_brand, p_partkey, p_retailprice / 50 AS s,
  max(p_retailprice / 50) OVER (PARTITION BY p_brand) AS top FROM part)
SELECT p_brand, p_partkey, round(exp(s - top) / sum(exp(s - top)) OVER (PARTITION BY p_brand), 9) AS prob
FROM m"""

# I
ORACLES["stream_preprocess"] = f"""WITH {RAW_JSONL}
SELECT row_id, ingredients, recipe, split FROM processed"""
ORACLES["stream_word_counts"] = f"""
WITH tokens AS (SELECT unnest({pieces('text')}) AS word FROM documents)
SELECT word, count(*) AS n FROM tokens GROUP BY word"""
