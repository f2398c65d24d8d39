"""DuckDB SQL for the rows of the queries, where SQL can tell them."""

from __future__ import annotations

from .licenses import PHRASES, TEMPLATES

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL: dict[str, str] = {}

SQL["op3_mixing"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS w,
   2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * (SELECT sum(source_size) FROM s) AS budget FROM s),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER before, 0)) / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER before, 0)) AS per_weight
   FROM w WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(per_weight, cap / w) AS x FROM l WHERE cap > per_weight * w),
t AS (SELECT source, source_size, CASE WHEN cap <= per_weight * w THEN cap ELSE least(cap, (SELECT x FROM level) * w) END AS target FROM l),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
v AS (SELECT d.*, u.source_size, u.target, u.whole, u.target - u.whole * u.source_size AS rest,
   sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
   sum(size) OVER (PARTITION BY d.source, h) AS tied
   FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, source_size, target,
  size * (whole + CASE WHEN run <= rest OR (run - tied <= rest AND (rest - (run - tied)) * 2 >= tied) THEN 1 ELSE 0 END)::BIGINT AS taken FROM v"""

_SYMBOLS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(sha, {5 * k + 1}, 5))::BIGINT >> {15 - 5 * j}) & 31)::BIGINT, 1)"
                       for k in range(8) for j in range(4))
SQL["op4_warc"] = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first_id FROM p)
SELECT page_id, payload_bytes, {_SYMBOLS} AS payload_digest,
  CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_id THEN first_id END AS refers_to FROM f"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TEMPLATES = ", ".join(f"('{label}', '{text.replace(chr(39), chr(39) * 2)}')" for label, text in TEMPLATES.items())


def _places(phrase: str) -> str:
    words = phrase.split()
    return " AND ".join(f"w[i{f' + {k}' if k else ''}] = '{x}'" for k, x in enumerate(words))


_PHRASES = " UNION ALL ".join(
    f"SELECT doc_id, i - 1 AS place, '{label}' AS label FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE {_places(p)}"
    for p, label in PHRASES.items())
SQL["op6_licenses"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORDS}') AS w FROM documents),
hit AS ({_PHRASES}),
base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word FROM hit GROUP BY 1),
t AS (SELECT label, unnest(list_distinct(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_WORDS}'))) AS word FROM (VALUES {_TEMPLATES}) x(label, text)),
size AS (SELECT label, count(*) AS n FROM t GROUP BY 1),
block AS (SELECT doc_id, b, unnest(list_distinct(w[b * 32 + 1 : b * 32 + 64])) AS word FROM (SELECT doc_id, w, unnest(range(0, (len(w) + 31) // 32)) AS b FROM d)),
part AS (SELECT doc_id, b, label, count(*) AS shared FROM block JOIN t USING (word) GROUP BY ALL),
found AS (SELECT doc_id, label, max(shared / n) AS part FROM part JOIN size USING (label) WHERE shared * 10 >= n * 8 GROUP BY ALL),
labels AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM hit UNION SELECT doc_id, label FROM found) GROUP BY 1),
base_labels AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM hit GROUP BY 1),
best AS (SELECT doc_id, max(part) AS best FROM found GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN labels USING (doc_id) LEFT JOIN base_labels USING (doc_id) LEFT JOIN best USING (doc_id)"""

SQL["op7_embeddings"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND list_dot_product(a.e, b.e) / a.n / b.n >= 0.98),
reach AS (SELECT a AS node, a AS seen FROM near UNION SELECT r.node, n.b FROM reach r JOIN near n ON r.seen = n.a),
c AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
k AS (SELECT a, count(*) AS n_links FROM near GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
  vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN c ON vec_id = node LEFT JOIN k ON vec_id = a"""

SQL["op9_exact_dedup"] = rf"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""

SQL["op10_line_dedup"] = rf"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
line AS (SELECT doc_id, k - 1 AS line_no, list_sort(list_distinct(regexp_extract_all(lower(l[k]), '{WORD}'))) AS w
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS k FROM d)),
cls AS (SELECT w, min((doc_id, line_no)) AS first, row_number() OVER () AS c, len(w) AS n FROM line WHERE len(w) > 0 GROUP BY w),
sized AS (SELECT *, unnest(range((4 * n + 4) // 5, 5 * n // 4 + 1)) AS other FROM cls),
gone AS (SELECT DISTINCT y.c FROM sized x JOIN cls y ON y.n = x.other AND x.first < y.first AND len(list_intersect(x.w, y.w)) * 9 >= 4 * (x.n + y.n)),
off AS (SELECT line.doc_id, line.line_no FROM line JOIN cls ON line.w = cls.w LEFT JOIN gone ON gone.c = cls.c
  WHERE gone.c IS NOT NULL OR (line.doc_id, line.line_no) <> cls.first)
SELECT d.doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, count(off.line_no)::BIGINT AS n_removed,
  coalesce(string_agg(off.line_no::VARCHAR, ',' ORDER BY off.line_no), '') AS removed_lines
FROM d LEFT JOIN off ON d.doc_id = off.doc_id GROUP BY d.doc_id, l"""

# CRC-32 of the decimal digits, a bit at a time; its polynomial, reversed, is a fixed value.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
SQL["op12_prefix_trie"] = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT conv_id, turn, octet_length(encode(text))::BIGINT AS bytes, substr(sha256(octet_length(encode(role)) || ':' || role || text), 1, 32) AS id FROM t),
own AS (SELECT conv_id, list({{'id': id, 'bytes': bytes}} ORDER BY turn NULLS FIRST, id) AS t, {_CRC} % 9 AS h FROM i GROUP BY conv_id),
r AS (SELECT o.conv_id, list_concat(coalesce(b.t[1:o.h], []), o.t[o.h + 1:]) AS t FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
m AS (SELECT conv_id, len(t) AS turns, t, unnest(range(0, len(t) + 1)) AS depth FROM r),
k AS (SELECT conv_id, turns, depth, array_to_string(list_transform(t[1:depth], lambda x: x.id), '') AS key, coalesce(t[depth].bytes, 0) AS bytes FROM m),
n AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
   coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = depth), '') AS ends FROM k GROUP BY key, depth),
c AS (SELECT left(key, 32 * (depth - 1)::INT) AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM n LEFT JOIN c ON n.key = c.key),
a AS (SELECT left(key, 32 * up::INT) AS key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
   FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM f) GROUP BY 1)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, a.n_leaves::BIGINT AS n_leaves,
  a.saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN a ON f.key = a.key LEFT JOIN f p ON f.depth > 0 AND p.key = left(f.key, 32 * (f.depth - 1)::INT)"""

SQL["op13_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS words, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines FROM d),
x AS (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS n FROM (SELECT r, unnest(range(1, len(words) - 1)) AS i,
   unnest(list_transform(list_zip(words[:-3], words[2:-2], words[3:]), lambda z: z[1] || ' ' || z[2] || ' ' || z[3])) AS three FROM w WHERE len(words) > 2)),
y AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM x WHERE n > 1) GROUP BY r),
f AS (SELECT w.r, doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
   len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(y.n, 0) AS n_repeat_words,
   len(list_filter(words, lambda v: regexp_full_match(v, '[^a-z]*[A-Z][^a-z]*'))) AS n_capitals FROM w LEFT JOIN y ON w.r = y.r),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
v AS (SELECT r, doc_id, lang, base_failed, unnest([
   {{'rule': 'symbols', 'value': least(1000, 1000 * n_symbols // greatest(word_chars, 1))}}, {{'rule': 'duplicate_lines', 'value': 1000 * n_dup_lines // greatest(n_lines, 1)}},
   {{'rule': 'repeated_words', 'value': 1000 * n_repeat_words // greatest(n_words, 1)}}, {{'rule': 'capitals', 'value': 1000 * n_capitals // greatest(n_words, 1)}},
   {{'rule': 'long_words', 'value': least(1000, 10 * word_chars // greatest(n_words, 1))}}, {{'rule': 'short_words', 'value': 1000 - least(1000, 10 * word_chars // greatest(n_words, 1))}}]) AS u FROM b),
l AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
h AS (SELECT lang, u.rule AS rule, u.value AS value, count(*) FILTER (good AND fold = 0) AS good, count(*) FILTER (NOT good AND fold = 0) AS bad, count(*) FILTER (good AND fold = 1) AS held
   FROM (SELECT *, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 2 AS fold FROM v JOIN l USING (doc_id) WHERE NOT base_failed) GROUP BY ALL),
s AS (SELECT lang, rule, value, sum(good) OVER down AS good, sum(bad) OVER down AS bad, sum(held) OVER down AS held, sum(held) OVER (PARTITION BY lang, rule) AS n_held
   FROM h WINDOW down AS (PARTITION BY lang, rule ORDER BY value DESC)),
g AS (SELECT *, max(bad - 10 * good) OVER (PARTITION BY lang, rule) AS gain FROM s),
o AS (SELECT *, max(CASE WHEN bad - 10 * good = gain THEN value END) OVER (PARTITION BY lang, rule) AS least_value FROM g),
c AS (SELECT lang, rule, value, held::BIGINT AS k, n_held::BIGINT AS n FROM o WHERE gain > 0 AND value >= least_value),
q AS (SELECT lang, 0.05::DOUBLE / count(DISTINCT rule) AS p FROM c GROUP BY lang),
z AS (SELECT c.lang, rule, min(value) AS cutoff FROM c JOIN q ON c.lang IS NOT DISTINCT FROM q.lang
   WHERE (CASE WHEN k >= n THEN 1 ELSE list_sum(list_transform(range(0, k + 1),
     lambda e: exp(lgamma(n + 1) - lgamma(e + 1) - lgamma(n - e + 1) + e * ln(p) + (n - e) * ln(1 - p)))) END)
     <= 0.05 / greatest(1, (SELECT count(*) FROM (SELECT DISTINCT lang, rule FROM c))) GROUP BY c.lang, rule),
x2 AS (SELECT r, count(*) AS n FROM v JOIN z ON v.lang IS NOT DISTINCT FROM z.lang AND v.u.rule = z.rule AND v.u.value >= z.cutoff GROUP BY r)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  base_failed, NOT base_failed AND x2.n IS NULL AS kept FROM b LEFT JOIN x2 ON b.r = x2.r"""
