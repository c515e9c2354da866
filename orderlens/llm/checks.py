"""SQL for the registered text queries, as DuckDB reads it."""

from __future__ import annotations

_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

_CHAT = """
WITH spoken AS (
  SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role,
         coalesce(text, '') AS text
  FROM conversations),
voices AS (SELECT DISTINCT conv_id, role AS speaker FROM spoken WHERE role <> 'system'),
segments AS (
  SELECT s.conv_id, v.speaker, CAST(floor(s.turn / 256) AS BIGINT) AS part, s.turn, s.role, s.text,
         '<|im_start|>' || CASE WHEN s.role = 'system' THEN s.role
                                WHEN s.role = v.speaker THEN 'assistant'
                                ELSE 'user name=' || s.role END || chr(10) AS header,
         s.text || '<|im_end|>' || chr(10) AS body
  FROM spoken s JOIN voices v ON s.conv_id IS NOT DISTINCT FROM v.conv_id),
placed AS (
  SELECT *, sum(length(header) + length(body)) OVER (
           PARTITION BY conv_id, speaker, part ORDER BY turn, role, text
           ROWS UNBOUNDED PRECEDING) AS stop
  FROM segments)
SELECT conv_id, speaker, part, count(*) AS n_turns,
       string_agg(header || body, '' ORDER BY turn, role, text) AS text,
       coalesce(string_agg(CASE WHEN role = speaker THEN
         CAST(stop - length(body) AS BIGINT) || '-' || CAST(stop AS BIGINT) END, ','
         ORDER BY turn, role, text), '') AS spans
FROM placed GROUP BY conv_id, speaker, part
"""

_URLS = """
WITH captures AS (
  SELECT page_id, DATE '2024-01-01' + CAST((page_id * 37) % 730 AS INTEGER) AS fetched_on,
         nullif(regexp_replace(lower(regexp_extract(url,
           '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '\\.+$', ''), '') AS host
  FROM pages),
hosts AS (SELECT DISTINCT host AS pattern FROM captures WHERE host IS NOT NULL),
domains AS (
  SELECT DISTINCT array_to_string(list_slice(string_split(pattern, '.'), -2, -1), '.') AS pattern
  FROM hosts),
entries AS (
  SELECT 'watch' AS list_name, pattern, 'block' AS action,
         DATE '2024-01-01' + CAST(('0x' || substr(md5(pattern), 1, 4))::INTEGER % 700 AS INTEGER) AS listed_on
  FROM hosts
  UNION ALL
  SELECT 'watch', pattern, 'drop',
         DATE '2024-01-01' + CAST(('0x' || substr(md5(pattern), 5, 4))::INTEGER % 700 AS INTEGER)
  FROM hosts
  UNION ALL
  SELECT 'partners', pattern, CASE WHEN substr(md5(pattern), 9, 1) < '8' THEN 'allow' ELSE 'block' END,
         DATE '2024-01-01' + CAST(('0x' || substr(md5(pattern), 1, 4))::INTEGER % 400 AS INTEGER)
  FROM domains),
active AS (
  SELECT c.page_id, e.list_name, e.pattern,
         max_by(e.action, (e.listed_on, e.action)) AS verdict
  FROM captures c
  JOIN entries e ON (c.host = e.pattern OR ends_with(c.host, '.' || e.pattern))
                AND e.listed_on <= c.fetched_on
  GROUP BY c.page_id, e.list_name, e.pattern),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC,
           CASE WHEN verdict = 'block' THEN 0 ELSE 1 END, list_name) AS place
  FROM active WHERE verdict <> 'drop')
SELECT c.page_id, c.host, c.fetched_on, r.verdict, r.pattern, r.list_name
FROM captures c LEFT JOIN ranked r ON c.page_id = r.page_id AND r.place = 1
"""

_MIX = f"""
WITH drawn AS (
  SELECT doc_id, source, len({_WORDS}) AS size FROM documents),
keyed AS (
  SELECT *, ('0x' || substr(md5('place29|' || coalesce(CAST(doc_id AS VARCHAR), '-') || '|'
               || CAST(size AS VARCHAR)), 1, 15))::BIGINT AS random
  FROM drawn),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM keyed GROUP BY source),
filled AS (
  SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS place,
         sum(source_size) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
                                ROWS UNBOUNDED PRECEDING) AS full_size,
         sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
                           ROWS UNBOUNDED PRECEDING) AS full_weight,
         sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight
  FROM sources),
open AS (
  SELECT *, full_size - source_size AS capped_size, all_weight - full_weight + weight AS open_weight
  FROM filled),
level AS (
  SELECT CAST(3 * all_size - 4 * capped_size AS BIGINT) AS twice, CAST(open_weight AS BIGINT) AS shared, place AS first_open
  FROM open
  WHERE (3 * all_size - 4 * capped_size) * weight <= 4 * source_size * open_weight
  ORDER BY place LIMIT 1),
goals AS (
  SELECT f.source, f.source_size,
         CASE WHEN l.first_open IS NOT NULL AND f.place >= l.first_open
              THEN CAST(l.twice * f.weight AS DOUBLE) / CAST(2 * l.shared AS DOUBLE)
              ELSE CAST(2 * f.source_size AS DOUBLE) END AS target
  FROM filled f LEFT JOIN level l ON true),
placed AS (
  SELECT k.doc_id, k.size, g.source_size, g.target,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.random, k.doc_id, k.size
                           ROWS UNBOUNDED PRECEDING) AS to_here
  FROM keyed k JOIN goals g ON k.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE CAST(size * (floor(target / source_size)
         + CASE WHEN 2 * to_here - size <= 2 * (target - source_size * floor(target / source_size))
                THEN 1 ELSE 0 END) AS BIGINT) END AS taken
FROM placed
"""

_CLASSES = ("[#*$%&|<>]", "[A-Z]", "[0-9]", "[.,;:!?''\"()\\-]", "[/\\\\=+_@{}~^`\\[\\]]")
_CLASS_LIST = ", ".join(
    f"length(body) - length(regexp_replace(body, '{pattern}', '', 'g'))" for pattern in _CLASSES
)
_LISTED = """
  ('de', ['der', 'die', 'und', 'das', 'ist', 'zu', 'den', 'mit', 'ein', 'nicht', 'eine', 'für']),
  ('en', ['the', 'of', 'and', 'to', 'in', 'a', 'is', 'that', 'for', 'it', 'was', 'with']),
  ('es', ['de', 'la', 'que', 'el', 'en', 'y', 'los', 'se', 'del', 'las', 'por', 'un']),
  ('fr', ['de', 'la', 'le', 'et', 'les', 'des', 'en', 'un', 'du', 'une', 'que', 'est'])
"""


def _distance(left: str, right: str) -> str:
    half = (
        "list_sum(list_transform(list_zip({0}, {1}), lambda x: CASE WHEN x[1] > 0 "
        "THEN x[1] * log2(2 * x[1] / (x[1] + x[2])) ELSE 0 END))"
    )
    return f"sqrt(greatest(0, ({half.format(left, right)} + {half.format(right, left)}) / 2))"


_SPOKEN = (
    "list_filter(string_split_regex(regexp_replace(lower(coalesce(text, '')), "
    "'[\\x21-\\x40\\x5B-\\x60\\x7B-\\x7E]', ' ', 'g'), '[\\x20\\x09-\\x0D]+'), lambda v: v <> '')"
)
_QUALITY = f"""
WITH numbered AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, coalesce(text, '') AS body, {_WORDS} AS w,
         {_SPOKEN} AS spoken
  FROM documents),
often AS (
  SELECT lang, list(word ORDER BY place) AS frequent
  FROM (SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS place
        FROM (SELECT lang, unnest(spoken) AS word FROM numbered) GROUP BY lang, word
        QUALIFY place <= 24)
  GROUP BY lang),
top(lang, common) AS (VALUES {_LISTED}),
windows AS (
  SELECT row_id, pos, (w[pos], w[pos + 1], w[pos + 2]) AS triple
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS pos FROM numbered)),
twice AS (
  SELECT row_id, pos FROM windows
  QUALIFY count(*) OVER (PARTITION BY row_id, triple) > 1),
covered AS (
  SELECT row_id, count(DISTINCT pos + d) AS n_repeat_words
  FROM twice CROSS JOIN (SELECT unnest([0, 1, 2]) AS d) GROUP BY row_id),
counted AS (
  SELECT n.row_id, n.doc_id, n.lang, len(w) AS n_words, length(body) AS n_chars,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')))
         - len(list_distinct(list_filter(string_split(body, chr(10)),
                lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
         [{_CLASS_LIST},
          length(body) - coalesce(list_sum(list_transform(w, lambda x: length(x))), 0),
          strlen(body) - length(body)] AS classes,
         list_transform(coalesce(t.common, []), lambda c: len(list_filter(w, lambda x: x = c))) AS found,
         len(spoken) AS n_spoken,
         list_transform(coalesce(o.frequent, []), lambda c: len(list_filter(spoken, lambda x: x = c))) AS heard
  FROM numbered n LEFT JOIN top t ON n.lang IS NOT DISTINCT FROM t.lang
  LEFT JOIN often o ON n.lang IS NOT DISTINCT FROM o.lang),
shaped AS (
  SELECT *, list_append(classes, greatest(0, n_chars - list_sum(classes))) AS class_counts,
         list_append(found, n_words - coalesce(list_sum(found), 0)) AS word_counts,
         list_append(heard, n_spoken - coalesce(list_sum(heard), 0)) AS heard_counts,
         list_append(list_transform(heard, lambda x: 0), 1) AS unheard
  FROM counted),
class_sums AS (
  SELECT lang, pos, sum(class_counts[pos]) AS n
  FROM (SELECT lang, class_counts, unnest(range(1, 9)) AS pos FROM shaped) GROUP BY lang, pos),
word_sums AS (
  SELECT lang, pos, sum(word_counts[pos]) AS n
  FROM (SELECT lang, word_counts, unnest(range(1, len(word_counts) + 1)) AS pos FROM shaped)
  GROUP BY lang, pos),
heard_sums AS (
  SELECT lang, pos, sum(heard_counts[pos]) AS n
  FROM (SELECT lang, heard_counts, unnest(range(1, len(heard_counts) + 1)) AS pos FROM shaped)
  GROUP BY lang, pos),
shares AS (
  SELECT c.lang, c.class_share, w.common_share, f.heard_share
  FROM (SELECT lang, list(n / greatest(total, 1) ORDER BY pos) AS class_share FROM (
          SELECT *, sum(n) OVER (PARTITION BY lang) AS total FROM class_sums) GROUP BY lang) c
  JOIN (SELECT lang, list(n / greatest(total, 1) ORDER BY pos) AS common_share FROM (
          SELECT *, sum(n) OVER (PARTITION BY lang) AS total FROM word_sums) GROUP BY lang) w
    ON c.lang IS NOT DISTINCT FROM w.lang
  JOIN (SELECT lang, list(n / greatest(total, 1) ORDER BY pos) AS heard_share FROM (
          SELECT *, sum(n) OVER (PARTITION BY lang) AS total FROM heard_sums) GROUP BY lang) f
    ON c.lang IS NOT DISTINCT FROM f.lang),
judged AS (
  SELECT s.*, coalesce(c.n_repeat_words, 0) AS n_repeat_words,
         CASE WHEN n_chars >= 200 THEN {_distance('list_transform(class_counts, lambda x: x / list_sum(class_counts))', 'class_share')} END AS char_distance,
         CASE WHEN n_words >= 50 AND len(found) > 0 THEN {_distance('list_transform(word_counts, lambda x: x / n_words)', 'common_share')} END AS word_distance,
         CASE WHEN n_spoken >= 50 AND len(heard) > 0 THEN
           {_distance('list_transform(heard_counts, lambda x: x / n_spoken)', 'heard_share')}
           / {_distance('unheard', 'heard_share')} END AS heard_distance
  FROM shaped s JOIN shares h ON s.lang IS NOT DISTINCT FROM h.lang
  LEFT JOIN covered c ON s.row_id = c.row_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND coalesce(char_distance, 0) <= 0.25 AND coalesce(word_distance, 0) <= 0.45
         AND coalesce(heard_distance, 0) <= 0.9 AS kept
FROM judged
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_perspective_rotation": _CHAT,
        "op7_temporal_list_join": _URLS,
        "op9_mixing_tree": _MIX,
        "op10_distribution_divergence": _QUALITY,
    }
