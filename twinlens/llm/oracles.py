"""DuckDB SQL of the queries that SQL can express.

Not here: op1 (base32 digests, resolved entities), op4, op7 (XXH64), op8 (too
slow over whole tables) and those with a trained model or a ranked index
(op2, op6, op9, op10). They are tested against brute force.
"""

_URL_PARTS = r"""
  coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path"""
_NODE = r"""CASE WHEN host <> '' THEN host || '|' || regexp_replace(path, '(?:/|\.html?)$', '') END"""

_RULE = """CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END"""

#: Links' targets are resolved against their page's url; aliases are walked from each linked node; a
#: component's root is the least node reached.
_URLS = rf"""
WITH RECURSIVE parts AS (SELECT page_id, url, coalesce(html, '') AS html, {_URL_PARTS} FROM pages),
judged AS (SELECT page_id, url, html, host, path, {_NODE} AS node, {_RULE} AS rule FROM parts),
targets AS (
  SELECT url, host, path, node AS a, regexp_extract(url, '^((?s:.*?)://[^/?#]*)', 1) AS site, unnest([
    regexp_extract(regexp_extract(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
                   '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract(regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'),
                   '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]) AS target
  FROM judged),
linked AS (
  SELECT a, regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') AS absolute,
    CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
         WHEN starts_with(target, '//') THEN regexp_extract(url, '^((?s:.*?):)//', 1) || target
         WHEN starts_with(target, '/') THEN site || target
         WHEN starts_with(target, '?') OR starts_with(target, '#') THEN site || path || target
         ELSE site || CASE WHEN contains(path, '/') THEN regexp_replace(path, '[^/]*$', '') ELSE '/' END || target
    END AS url
  FROM targets WHERE a IS NOT NULL AND target <> ''
    AND (regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') OR NOT regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:'))),
found AS (SELECT a, absolute, {_URL_PARTS} FROM linked),
straight AS (
  SELECT a, host, CASE WHEN absolute OR NOT regexp_matches(path, '(?:^|/)\.{{1,2}}(?:/|$)') THEN path ELSE
    list_reduce(list_concat([''], string_split(regexp_replace(path, '^/', ''), '/')),
                lambda done, x: CASE x WHEN '.' THEN done WHEN '..' THEN regexp_replace(done, '/[^/]*$', '')
                                ELSE done || '/' || x END)
    || CASE WHEN regexp_matches(path, '(?:^|/)\.{{1,2}}$') THEN '/' ELSE '' END END AS path
  FROM found),
ends AS (SELECT a, {_NODE} AS b, {_RULE} AS rule FROM straight WHERE host <> ''),
edges AS (
  SELECT a, b FROM ends WHERE a <> b
  UNION SELECT b, a FROM ends WHERE a <> b),
reach AS (
  SELECT a AS node, a AS other FROM edges
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node),
said AS (SELECT node, rule FROM judged WHERE node IS NOT NULL UNION ALL SELECT b, rule FROM ends),
nodes AS (
  SELECT s.node, coalesce(any_value(r.root), s.node) AS root,
         bool_or(coalesce(rule IN ('org/', 'com/fr/'), false)) AS allowed,
         bool_or(coalesce(rule NOT IN ('org/', 'com/fr/'), false)) AS blocked
  FROM said s LEFT JOIN roots r ON s.node = r.node GROUP BY s.node),
groups AS (SELECT root, bool_or(blocked) AND NOT bool_or(allowed) AS block FROM nodes GROUP BY root)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN g.block THEN 'block' ELSE 'allow' END AS verdict
FROM judged j LEFT JOIN nodes n ON j.node = n.node LEFT JOIN groups g ON n.root = g.root"""

_CLASSES = ["lower", "upper", "digit", "space", "mark", "symbol", "other"]


def _terms(p: str, q: str) -> str:
    """The two summands of the Jensen-Shannon divergence for one bin."""
    return (f"(CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END"
            f" + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END)")


_CHARS = " + ".join(f"c_{c}" for c in _CLASSES)
_CLASS_SUM = " + ".join(_terms(f"(c_{c} / chars)", f"(r_{c} / r_chars)") for c in _CLASSES)

_DIVERGENCE = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, lang, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT k, doc_id, lang, t,
    list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    regexp_replace(t, '[a-z\x20\x09-\x0D\p{{Ll}}]+', '', 'g') AS rest
  FROM docs),
word AS (
  SELECT k, lang, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split),
common AS (
  SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS r
  FROM word WHERE length(word) <= 3 GROUP BY lang, word QUALIFY r <= 16),
five AS (
  SELECT k, pos, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' '
    || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS five
  FROM word WINDOW o AS (PARTITION BY k ORDER BY pos)),
twice AS (SELECT k, pos FROM five WHERE five IS NOT NULL QUALIFY count(*) OVER (PARTITION BY k, five) > 1),
step AS (SELECT k, least(5, coalesce(lead(pos) OVER (PARTITION BY k ORDER BY pos) - pos, 5)) AS step FROM twice),
rep AS (SELECT k, CAST(sum(step) AS BIGINT) AS n FROM step GROUP BY k),
counted AS (
  SELECT s.k, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, length(t) AS n_chars, length(rest) AS n_rest,
    CAST(length(rest) - length(regexp_replace(rest, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words,
    length(rest) - length(regexp_replace(rest, '\p{{Lu}}+', '', 'g')) AS c_upper,
    length(rest) - length(regexp_replace(rest, '\p{{Nd}}+', '', 'g')) AS c_digit,
    length(rest) - length(regexp_replace(rest, '[.,;:!?''"()\-]+', '', 'g')) AS c_mark
  FROM split s LEFT JOIN rep ON s.k = rep.k),
m AS (
  SELECT *, word_chars - n_rest AS c_lower, n_chars - word_chars AS c_space, n_symbols AS c_symbol,
    n_rest - c_upper - c_digit - c_mark - n_symbols AS c_other FROM counted),
class_ref AS (
  SELECT lang, sum(n_words) AS r_words, {", ".join(f"sum(c_{c}) AS r_{c}" for c in _CLASSES)},
    sum({_CHARS}) AS r_chars FROM m GROUP BY lang),
hit AS (
  SELECT w.k, c.r, count(*) AS n FROM word w JOIN common c
    ON w.word = c.word AND w.lang IS NOT DISTINCT FROM c.lang GROUP BY w.k, c.r),
word_ref AS (
  SELECT m.lang, hit.r, sum(hit.n) AS n FROM hit JOIN m ON hit.k = m.k GROUP BY m.lang, hit.r),
bins AS (
  SELECT m.k, coalesce(hit.n, 0) / m.n_words AS p, wr.n / cr.r_words AS q
  FROM m JOIN class_ref cr ON m.lang IS NOT DISTINCT FROM cr.lang
  JOIN word_ref wr ON m.lang IS NOT DISTINCT FROM wr.lang
  LEFT JOIN hit ON hit.k = m.k AND hit.r = wr.r WHERE m.n_words >= 50
  UNION ALL
  SELECT m.k, (m.n_words - coalesce(h.n, 0)) / m.n_words, (cr.r_words - coalesce(wr.n, 0)) / cr.r_words
  FROM m JOIN class_ref cr ON m.lang IS NOT DISTINCT FROM cr.lang
  LEFT JOIN (SELECT k, sum(n) AS n FROM hit GROUP BY k) h ON h.k = m.k
  LEFT JOIN (SELECT lang, sum(n) AS n FROM word_ref GROUP BY lang) wr ON m.lang IS NOT DISTINCT FROM wr.lang
  WHERE m.n_words >= 50),
word_far AS (SELECT k, sqrt(greatest(sum({_terms("p", "q")}) / 2, 0)) AS d FROM bins GROUP BY k),
class_far AS (
  SELECT k, sqrt(greatest(({_CLASS_SUM}) / 2, 0)) AS d
  FROM (SELECT *, {_CHARS} AS chars FROM m) m JOIN class_ref cr ON m.lang IS NOT DISTINCT FROM cr.lang
  WHERE chars >= 100),
letters AS (
  SELECT k, lang, list_filter(string_split_regex(lower(t), '\P{{L}}+'), lambda x: x <> '') AS lw FROM docs),
letter AS (SELECT k, lang, unnest(lw) AS word FROM letters),
listed AS (
  SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(DISTINCT k) DESC, word) AS r
  FROM letter GROUP BY lang, word QUALIFY r <= 300),
found AS (
  SELECT l.k, count(*) AS n FROM letter l JOIN listed s
    ON l.word = s.word AND l.lang IS NOT DISTINCT FROM s.lang GROUP BY l.k),
share AS (
  SELECT l.k, lang, len(lw) AS n, coalesce(f.n, 0) AS n_listed FROM letters l LEFT JOIN found f ON l.k = f.k),
usual AS (SELECT lang, sum(n_listed) / sum(n) AS q FROM share GROUP BY lang),
reach AS (
  SELECT k, n_listed / n AS p, 1 - n_listed / n AS p1, q, 1 - q AS q1, CAST(0 AS DOUBLE) AS z, CAST(1 AS DOUBLE) AS o
  FROM share s JOIN usual u ON s.lang IS NOT DISTINCT FROM u.lang WHERE n >= 50 AND n * q >= 20),
listed_far AS (
  SELECT k, p < q AS fewer, sqrt(greatest(({_terms("p", "q")} + {_terms("p1", "q1")}) / 2, 0)) AS d,
    sqrt(greatest(({_terms("z", "q")} + {_terms("o", "q1")}) / 2, 0)) AS reach FROM reach),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(c.d, 0) <= 0.3 AND coalesce(w.d, 0) <= 0.4
    AND NOT coalesce(l.fewer AND l.d > 0.5 * l.reach, false) AS kept,
  round(c.d, 9) AS class_distance, round(w.d, 9) AS word_distance,
  round(l.d, 9) AS listed_distance, round(l.reach, 9) AS listed_reach
FROM failed f LEFT JOIN class_far c ON f.k = c.k LEFT JOIN word_far w ON f.k = w.k
LEFT JOIN listed_far l ON f.k = l.k"""

SQL: dict[str, str] = {"op3_url_redirects": _URLS, "op5_quality_divergence": _DIVERGENCE}
