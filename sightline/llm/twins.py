"""DuckDB statements that compute the same rows as the queries, by plainer means."""

SUBSTRING_DEDUP = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(generate_series(1, len(ws) - 49)) AS i, ws FROM w WHERE len(ws) >= 50),
win AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS h FROM p),
firsts AS (SELECT h, min(doc_id) AS least FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS k FROM win JOIN firsts USING (h) WHERE doc_id > least),
cut AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ks IS NULL THEN ws ELSE
           list_transform(list_filter(list_zip(ws, generate_series(1, len(ws))), lambda x: NOT list_contains(ks, x[2])), lambda x: x[1]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id)
"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bi AS (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(generate_series(1, len(ws) - least(10, len(ws)) + 1)) AS i FROM b WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS s FROM bi),
di AS (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM iw) WHERE len(ws) >= n),
hits AS (SELECT doc_id, i, n, item_id FROM (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS s FROM di) JOIN iw USING (n, s)),
hw AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""

JACCARD_JOIN = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 2))) AS k FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[k:k + 2], ' ') AS t FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT edges.b, seen FROM reach JOIN edges ON node = edges.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node) USING (doc_id)
"""

QUALITY_RULES = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, unnest(generate_series(1, len(ws) - 2)) AS k, ws FROM w WHERE len(ws) >= 3),
g AS (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[k:k + 2], ' ')) AS n FROM i),
r AS (SELECT doc_id, count(DISTINCT k + j) AS n FROM g, (VALUES (0), (1), (2)) v(j) WHERE n >= 2 GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
       CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
       list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
       CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
       CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper, CAST(length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS BIGINT) AS n_letters
     FROM w LEFT JOIN r USING (doc_id)),
f AS (SELECT * EXCLUDE (ls), CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines FROM m)
SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT + 8 * (100 * n_dup_lines > 75 * n_lines)::INT
       + 16 * (100 * n_upper > 50 * n_letters)::INT + 32 * (word_chars < 2 * n_words)::INT + 64 * (word_chars > 16 * n_words)::INT AS BIGINT) AS failed,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words OR 100 * n_dup_lines > 75 * n_lines OR 100 * n_upper > 50 * n_letters
            OR word_chars < 2 * n_words OR word_chars > 16 * n_words) AS kept
FROM f
"""

LINE_DEDUP = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
nb AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, seq, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY seq) AS s FROM nb),
r AS (SELECT doc_id, seq, row_number() OVER (PARTITION BY s ORDER BY doc_id, seq) AS n FROM w WHERE s IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, seq + j AS seq FROM r, (VALUES (0), (1)) v(j) WHERE n > 1),
kept AS (SELECT l.doc_id, l.pos, l.line, nb.seq, gone.seq AS cut FROM l LEFT JOIN nb USING (doc_id, pos) LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.seq = nb.seq)
SELECT doc_id, count(seq) AS n_lines, count(cut) AS n_deleted, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (cut IS NULL), '')) AS kept_sha256
FROM kept GROUP BY doc_id
"""

FIM = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
d AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
             CAST('0x' || h[17:24] AS BIGINT) % 100 AS c3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS c4 FROM h),
f AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c3 >= 90 THEN 'plain' WHEN c4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

CHAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(regexp_replace(text, '(<)(\\*)(/?s>|</?SYS>>|</?ROLE>>)', '\1\\\2\3', 'g'), '(\[)(\\*)(/?INST\])', '\1\\\2\3', 'g') AS esc,
             CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 5 WHEN 'system' THEN 15 ELSE 21 + length(role) END AS around FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(esc) + around) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
