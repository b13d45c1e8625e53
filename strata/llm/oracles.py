"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

QUALITY_RULES = rf"""WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {WORDS.format(text='text')} AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
m AS (SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(ls) AS BIGINT) AS n_lines FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
h AS (SELECT source, count(*) AS n, [sum(CAST(n_words < 10 AS INT)), sum(CAST(100 * n_repeat_words > 20 * n_words AS INT)),
        sum(CAST(10 * n_symbols > n_words AS INT)), sum(CAST(10 * n_dup_lines > 3 * n_lines AS INT)),
        sum(CAST(word_chars < 3 * n_words OR word_chars > 12 * n_words AS INT))] AS ks FROM m WHERE source IS NOT NULL GROUP BY source),
r AS (SELECT source, CAST(n AS DOUBLE) AS n, unnest([1, 2, 3, 4, 5]) AS rule, CAST(unnest(ks) AS DOUBLE) AS k FROM h),
p AS (SELECT rule, sum(k) / sum(n) AS mean, count(*) / sum(n) AS noise FROM r GROUP BY rule),
s AS (SELECT rule, any_value(mean) AS mean, sum(n * pow(k / n - mean, 2)) / sum(n) - any_value(mean * (1 - mean) * noise) AS beyond
      FROM r JOIN p USING (rule) GROUP BY rule),
b AS (SELECT rule, mean, CASE WHEN beyond > 0 THEN least(greatest(mean * (1 - mean) / beyond - 1, 2), 1000) ELSE 1000 END AS weight FROM s),
v AS (SELECT source, bool_or((k + mean * weight) / (n + weight) >= 0.5) AS rejected FROM r JOIN b USING (rule) GROUP BY source),
f AS (SELECT m.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, coalesce(rejected, false) AS host_rejected
      FROM m LEFT JOIN v ON v.source = m.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rejected,
  NOT base_failed AND NOT host_rejected AS kept FROM f"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(text=_LOWER)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS k FROM (
        SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN least ON least.a = w.doc_id"""

REPEATS = f"""WITH w AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS c FROM g) WHERE c > 1),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM rep),
t AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.p) AS txt, count(*) AS n FROM t LEFT JOIN cov ON cov.doc_id = t.doc_id AND cov.p = t.p
         WHERE cov.p IS NULL GROUP BY t.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(txt, '')) AS kept_sha256 FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id"""

_LINE_KEY = "translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES = f"""WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM s),
k AS (SELECT doc_id, i, line, {_LINE_KEY} AS k FROM l),
rep AS (SELECT k FROM k WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
kept AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS txt FROM k LEFT JOIN rep USING (k)
         WHERE rep.k IS NULL GROUP BY doc_id)
SELECT s.doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - coalesce(n, 0) AS BIGINT) AS n_dropped,
  sha256(coalesce(txt, '')) AS kept_sha256 FROM s LEFT JOIN kept ON kept.doc_id = s.doc_id"""

_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

RANKED = f"""WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id), c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, p.doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM q JOIN p ON p.term = q.term JOIN w ON w.term = p.term JOIN d ON d.doc_id = p.doc_id CROSS JOIN c GROUP BY item_id, p.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10"""
