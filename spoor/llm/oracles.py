"""SQL for the operators' queries that DuckDB runs on the same tables."""

from spoor.llm import rules

_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_SPACE = r"[\x20\x09-\x0D]"


def _texts(texts) -> str:
    return "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in texts) + "]"


_SUBSTRINGS = f"""
WITH doc AS (
  SELECT row_number() OVER () AS row_no, doc_id, {_WORDS.format(text="coalesce(text, '')")} AS words
  FROM documents
), word AS (
  SELECT row_no, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM doc
), passage AS (
  SELECT row_no, place, array_to_string(words[place:place + 34], ' ') AS seq
  FROM (SELECT row_no, words, unnest(range(1, len(words) - 33)) AS place FROM doc WHERE len(words) >= 35)
), hit AS (
  SELECT row_no, place, TRUE AS is_hit
  FROM (SELECT row_no, place, count(*) OVER (PARTITION BY seq) AS n FROM passage) WHERE n > 1
), marked AS (
  SELECT w.row_no, w.place, w.word, coalesce(bool_or(h.is_hit) OVER (
    PARTITION BY w.row_no ORDER BY w.place ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), FALSE) AS gone
  FROM word w LEFT JOIN hit h ON h.row_no = w.row_no AND h.place = w.place
), cut AS (
  SELECT row_no, count(*) FILTER (WHERE gone) AS n_removed,
    string_agg(word, ' ' ORDER BY place) FILTER (WHERE NOT gone) AS kept
  FROM marked GROUP BY row_no
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words,
  CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(c.kept, '')) AS kept_sha256
FROM doc d LEFT JOIN cut c ON c.row_no = d.row_no
"""

_NEAR = f"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS row_no, doc_id, {_WORDS.format(
    text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words
  FROM documents
), shingle AS (
  SELECT DISTINCT row_no, array_to_string(words[place:place + 4], ' ') AS shingle
  FROM (SELECT row_no, words, unnest(range(1, greatest(len(words) - 3, 2))) AS place FROM doc WHERE len(words) > 0)
), own AS MATERIALIZED (
  SELECT row_no, count(*) AS n, string_agg(shingle, chr(10) ORDER BY shingle) AS whole FROM shingle GROUP BY row_no
), class AS MATERIALIZED (
  SELECT o.whole, o.n, min(o.row_no) AS node, min(d.doc_id) AS least
  FROM own o JOIN doc d ON d.row_no = o.row_no GROUP BY o.whole, o.n
), part AS MATERIALIZED (
  SELECT c.node, c.n, s.shingle FROM class c JOIN shingle s ON s.row_no = c.node
), link AS MATERIALIZED (
  SELECT a.node AS a, b.node AS b
  FROM part a JOIN part b ON a.shingle = b.shingle AND a.node <> b.node
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT node, node AS seen FROM class
  UNION
  SELECT r.node, l.b FROM reach r JOIN link l ON l.a = r.seen
), component AS (
  SELECT r.node, min(c.least) AS component_id FROM reach r JOIN class c ON c.node = r.seen GROUP BY r.node
)
SELECT d.doc_id, CAST(coalesce(o.n, 0) AS BIGINT) AS n_shingles,
  coalesce(k.component_id, d.doc_id) AS component_id, d.doc_id = coalesce(k.component_id, d.doc_id) AS kept
FROM doc d
LEFT JOIN own o ON o.row_no = d.row_no
LEFT JOIN class c ON c.whole = o.whole
LEFT JOIN component k ON k.node = c.node
"""

_RULES = f"""
WITH doc AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text,
    {_WORDS.format(text="coalesce(text, '')")} AS words
  FROM documents
), line AS (
  SELECT row_no, line, {_WORDS.format(text="line")} AS words, regexp_replace(line, '{_SPACE}', '', 'g') AS seen
  FROM (SELECT row_no, unnest(string_split(text, chr(10))) AS line FROM doc)
), lone AS (
  SELECT *, len(list_filter(words, lambda w: list_contains({_texts(sorted(s.decode() for s in rules.SEPARATORS))}, w))) AS lone,
    len(list_filter({_texts(c.decode() for c in rules.CLOSING)}, lambda c: ends_with(words[-1], c))) > 0 AS closed
  FROM line WHERE len(words) > 0
), failing AS (
  SELECT row_no, line, len(words) AS n,
    (lone >= 2 AND 3 * lone >= len(words))
    OR 10 * (strlen(seen) - strlen(regexp_replace(seen, '[#*$%&|<>]', '', 'g'))) > strlen(seen)
    OR 2 * (strlen(line) - strlen(replace(line, '!', ''))) >= len(words)
    OR (len(words) < 10 AND NOT closed)
    OR regexp_matches(line, '{"|".join(rules.BOILERPLATE)}', 'i') AS fails
  FROM lone
), lines AS (
  SELECT row_no, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(n) FILTER (WHERE fails), 0) AS lost
  FROM failing GROUP BY row_no
), passage AS (
  SELECT row_no, place, array_to_string(words[place:place + 2], ' ') AS seq
  FROM (SELECT row_no, words, unnest(range(1, len(words) - 1)) AS place FROM doc WHERE len(words) >= 3)
), hit AS (
  SELECT row_no, place FROM (SELECT row_no, place, count(*) OVER (PARTITION BY row_no, seq) AS n FROM passage) WHERE n > 1
), repeated AS (
  SELECT row_no, count(DISTINCT place + step) AS n FROM hit, (VALUES (0), (1), (2)) AS s(step) GROUP BY row_no
), counted AS (
  SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(d.text, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(l.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, coalesce(l.lost, 0) AS lost
  FROM doc d LEFT JOIN lines l ON l.row_no = d.row_no LEFT JOIN repeated r ON r.row_no = d.row_no
), base AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND lost <= {rules.MOST_LOST} * n_words AS kept
FROM base
"""

_PLAIN_WORDS = r"""list_filter(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

_BENCHMARKS = f"""
WITH doc AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, doc_id, {_PLAIN_WORDS} AS words FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_PLAIN_WORDS} AS words FROM benchmark
), wanted AS MATERIALIZED (
  SELECT DISTINCT item, least(len(words), 10) AS size, array_to_string(words[place:place + 9], ' ') AS seq
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 8, 2))) AS place FROM item WHERE len(words) > 0)
), passage AS (
  SELECT row_no, place, size, array_to_string(words[place:place + size - 1], ' ') AS seq
  FROM (
    SELECT d.row_no, d.words, s.size, unnest(range(1, len(d.words) - s.size + 2)) AS place
    FROM doc d JOIN (SELECT DISTINCT size FROM wanted) s ON len(d.words) >= s.size
  )
), met AS MATERIALIZED (
  SELECT p.row_no, p.place, p.size, w.item FROM passage p JOIN wanted w ON w.seq = p.seq AND w.size = p.size
), hit AS (
  SELECT row_no, count(DISTINCT word) AS n
  FROM (SELECT DISTINCT row_no, unnest(range(place, place + size)) AS word FROM met) GROUP BY row_no
), named AS (
  SELECT row_no, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_no, item FROM met WHERE item IS NOT NULL) GROUP BY row_no
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n.n, 0) AS BIGINT) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM doc d LEFT JOIN hit h ON h.row_no = d.row_no LEFT JOIN named n ON n.row_no = d.row_no
"""

_RESAMPLING = f"""
WITH RECURSIVE shift AS (
  SELECT i, i AS c, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, step + 1 FROM shift WHERE step < 8
), crc AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM shift WHERE step = 8
), doc AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, doc_id, {_PLAIN_WORDS} AS words FROM documents
), word AS MATERIALIZED (
  SELECT row_no, unnest(words) AS word FROM doc
), wanted AS MATERIALIZED (
  SELECT unnest({_PLAIN_WORDS}) AS word FROM benchmark
), bytes AS (
  SELECT word, list_transform(range(1, strlen(word) + 1),
    lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i - 1, 2) AS BIGINT)) AS b
  FROM (SELECT word FROM word UNION SELECT word FROM wanted)
), bucket AS MATERIALIZED (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, b),
    lambda c, x: xor(t[CAST(xor(c, x) & 255 AS BIGINT) + 1], c >> 8))) % 10000 AS bucket
  FROM bytes, crc
), own AS (
  SELECT bucket, count(*) AS n FROM word JOIN bucket USING (word) GROUP BY bucket
), target AS (
  SELECT bucket, count(*) AS n FROM wanted JOIN bucket USING (word) GROUP BY bucket
), total AS (
  SELECT (SELECT count(*) FROM word) AS s, (SELECT count(*) FROM wanted) AS t
), gain AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln(
    (CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST(total.s + 10000 AS DOUBLE))
    / (CAST(coalesce(o.n, 0) + 1 AS DOUBLE) * CAST(total.t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM own o FULL JOIN target t USING (bucket), total
), weighed AS (
  SELECT row_no, CAST(sum(gain) AS BIGINT) AS weight FROM word JOIN bucket USING (word) JOIN gain USING (bucket) GROUP BY row_no
), scored AS (
  SELECT d.row_no, d.doc_id, CAST(len(d.words) AS BIGINT) AS n_features, CAST(coalesce(w.weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(w.weight, 0) + floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM doc d LEFT JOIN weighed w USING (row_no)
), ranked AS (
  SELECT row_no, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN r.rank <= 10 * r.n // 100 THEN r.rank END AS rank
FROM scored s LEFT JOIN ranked r USING (row_no)
"""

_INFILL = r"""
WITH doc AS (
  SELECT doc_id, text, units, len(units) AS n, sha256('1:' || doc_id) AS h
  FROM (SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units FROM documents)
), drawn AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS one, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS two,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS three, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS four
  FROM doc
), cut AS (
  SELECT doc_id, text, n,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR three % 100 >= 90
      THEN 'plain' WHEN four % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1:least(one, two)], '') AS prefix,
    array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
    array_to_string(units[greatest(one, two) + 1:n], '') AS suffix
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""

ORACLE: dict[str, str] = {
    "op4_substrings": _SUBSTRINGS,
    "op8_rules": _RULES,
    "op10_near_duplicates": _NEAR,
    "op11_decontamination": _BENCHMARKS,
    "op12_resampling": _RESAMPLING,
    "op13_infill": _INFILL,
}
