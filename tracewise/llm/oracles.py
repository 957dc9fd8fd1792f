"""DuckDB SQL for the operators that SQL can express."""

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: the marks and the escape of tracewise.llm.chat, written out
CHAT = r"""
WITH talk AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', NULL
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', NULL),
e AS (SELECT *, length(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))
               + length('<|turn|><|text|><|end|>') AS n FROM talk)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id, lone"""

_CLOSE = r"""["'')\]}»’”」』）】]"""
_PIECE = (rf"[^\x20\x09-\x0D]*?[。！？](?:{_CLOSE}*[。！？])*{_CLOSE}*[\x20\x09-\x0D]*"
          rf"|{_WORD}[\x20\x09-\x0D]*")

#: runs of sentences by their words; the first occurrence stays
SENTENCES = rf"""
WITH pieces AS (
  SELECT doc_id, text, regexp_extract_all(text, '{_PIECE}') AS ps FROM documents),
w AS (SELECT doc_id, generate_subscripts(ps, 1) AS k, unnest(ps) AS p FROM pieces),
w2 AS (SELECT doc_id, k, p, {_LOWER.format(f"regexp_extract(p, '{_WORD}')")} AS word,
         greatest(1, length(regexp_replace(regexp_extract(p, '{_WORD}'), '[\x00-\x{{7FF}}]', '', 'g')) // 2) AS units,
         regexp_matches(p, '[.!?。！？]{_CLOSE}*[\x20\x09-\x0D]*$') OR contains(p, chr(10)) AS closed FROM w),
w3 AS (SELECT *, coalesce(sum(CAST(closed AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY k
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM w2),
sent AS (SELECT doc_id, CAST(s AS BIGINT) AS s, string_agg(p, '' ORDER BY k) AS body, string_agg(word, ' ' ORDER BY k) AS words,
           sum(units) AS n FROM w3 GROUP BY doc_id, s),
c AS (SELECT *, CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY s) AS BIGINT) AS upto,
        CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY s) - n AS BIGINT) AS before,
        max(s) OVER (PARTITION BY doc_id) AS last_s, sum(n) OVER (PARTITION BY doc_id) AS total FROM sent),
forward AS (SELECT a.doc_id, a.s AS i, min(b.s) AS j FROM c a JOIN c b
            ON a.doc_id = b.doc_id AND b.s >= a.s + 1 AND b.upto - a.before >= 25 GROUP BY 1, 2),
tail AS (SELECT doc_id, max(s) AS i, max(last_s) AS j FROM c WHERE s <= last_s - 1 AND total - before >= 25 GROUP BY 1),
span AS (SELECT * FROM forward UNION SELECT doc_id, s, s FROM c WHERE n >= 25 UNION SELECT * FROM tail),
body AS (SELECT span.doc_id, i, j, string_agg(c.words, ' ' ORDER BY c.s) AS run FROM span JOIN c
         ON c.doc_id = span.doc_id AND c.s BETWEEN i AND j GROUP BY 1, 2, 3),
again AS (SELECT doc_id, i, j FROM body QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT c.doc_id, c.s FROM again JOIN c ON c.doc_id = again.doc_id AND c.s BETWEEN i AND j),
kept AS (SELECT c.doc_id, coalesce(string_agg(c.body, '' ORDER BY c.s) FILTER (WHERE gone.s IS NULL), '') AS body,
           count(gone.s) AS n FROM c LEFT JOIN gone USING (doc_id, s) GROUP BY c.doc_id),
lead_ws AS (SELECT doc_id, regexp_extract(text, '^[\x20\x09-\x0D]*') AS ws,
              NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = documents.doc_id AND gone.s = 0) AS keep_ws FROM documents)
SELECT d.doc_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_removed,
  CASE WHEN k.doc_id IS NULL THEN d.text WHEN l.keep_ws THEN l.ws || k.body ELSE k.body END AS text
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN lead_ws l USING (doc_id)"""

#: all pairs that share a shingle, exact likeness, then components
NEAR = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
sh AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i:i+3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM t),
f AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sh),
pr AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m, any_value(a.n) AS na, any_value(b.n) AS nb
       FROM f a JOIN f b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pr WHERE 100 * m >= 80 * (na + nb - m)),
reach(id, r) AS (SELECT a, a FROM link UNION SELECT l.b, reach.r FROM reach JOIN link l ON l.a = reach.id),
comp AS (SELECT id, min(r) AS c FROM reach GROUP BY id)
SELECT sh.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(sh.doc_id, coalesce(c, sh.doc_id)) AS component_id,
  sh.doc_id = least(sh.doc_id, coalesce(c, sh.doc_id)) AS kept FROM sh LEFT JOIN comp ON comp.id = sh.doc_id"""

#: rules, then classes over absolute canonical links and redirects
URLS = r"""
WITH RECURSIVE rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
tag AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS t FROM pages),
link0 AS (SELECT url, regexp_extract(t, '(?is)[\s"''/]href\s*=\s*["'']?([^"''>]*)', 1) AS target FROM tag
          WHERE regexp_matches(regexp_extract(t, '(?is)[\s"''/]rel\s*=\s*(?:"[^"]*|''[^'']*|[^"''\s>]+)'), '(?i)[\s="'']canonical(?:\s|$)')
          UNION SELECT url, regexp_extract(t, '(?is)url\s*=\s*["'']?([^"''>]*)', 1) FROM tag
          WHERE regexp_matches(t, '(?is)[\s"''/]http-equiv\s*=\s*["'']?\s*refresh\b')),
link1 AS (SELECT url, target FROM link0 WHERE contains(url, '://') AND contains(target, '://')),
urls AS (SELECT url FROM pages UNION SELECT target FROM link1),
parsed AS (SELECT url, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
             regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS rest FROM urls),
ruled AS (SELECT parsed.*, rules.h || rules.p AS rule, rules.verdict FROM parsed LEFT JOIN rules
          ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
          QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(h || p) DESC NULLS LAST, rules.verdict) = 1),
edge AS (SELECT a.host || a.rest AS x, b.host || b.rest AS y FROM link1 JOIN parsed a USING (url)
         JOIN parsed b ON b.url = link1.target),
both_ways AS (SELECT x, y FROM edge UNION SELECT y, x FROM edge),
reach(x, y) AS (SELECT x, x FROM both_ways UNION SELECT reach.x, b.y FROM reach JOIN both_ways b ON b.x = reach.y),
class AS (SELECT reach.x AS node, bool_or(r.verdict = 'allow') AS allowed, count(r.verdict) AS n
          FROM reach JOIN ruled r ON r.host || r.rest = reach.y GROUP BY 1)
SELECT page_id, coalesce(r.host, '') AS host, coalesce(r.path, '') AS path, r.rule,
  coalesce(r.verdict, CASE WHEN c.n > 0 AND NOT c.allowed THEN 'block' ELSE 'allow' END) AS verdict
FROM pages LEFT JOIN ruled r ON pages.url = r.url
LEFT JOIN class c ON contains(pages.url, '://') AND c.node = r.host || r.rest"""

#: crc32 of a list of bytes, bit by bit
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform({0}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""

#: rebuilt conversations, their prefixes, then sums over each prefix's extensions
TRIE = rf"""
WITH t0 AS (SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
     FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(t ORDER BY k) AS ts FROM t0 GROUP BY 1),
h AS (SELECT conv_id, ts, {_CRC.format("list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))")} % 6 AS h FROM own),
built AS (SELECT a.conv_id, list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) AS ts
          FROM h a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
p AS (SELECT conv_id, len(ts) AS last, unnest(range(0, len(ts) + 1)) AS depth, ts FROM built),
q AS (SELECT conv_id, last, depth, ts[1:depth] AS pre, CASE WHEN depth > 0 THEN ts[1:depth - 1] END AS up,
             CASE WHEN depth > 0 THEN length(ts[depth].text) ELSE 0 END AS len FROM p),
node AS (SELECT pre, any_value(up) AS up, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           any_value(len) AS len, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
             FILTER (WHERE last = depth), '')) AS ends_sha256 FROM q GROUP BY pre),
kids AS (SELECT up AS pre, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY 1),
flat AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (pre)),
below AS (SELECT pre[1:k] AS pre, CAST(sum((n_convs - 1) * len) AS BIGINT) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
          FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM flat) GROUP BY 1)
SELECT a.conv_id, a.depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children, s.leaves AS n_leaves,
  s.saved AS saved_tokens, a.ends_sha256
FROM flat a LEFT JOIN flat b ON a.up = b.pre JOIN below s ON s.pre = a.pre"""

#: damaged words; neighbours by the word without one character
SPELLING = rf"""
WITH RECURSIVE run AS (
  SELECT doc_id, {_LOWER.format("unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'))")} AS w FROM documents),
per_doc AS (SELECT doc_id, w, count(*) AS n FROM run GROUP BY 1, 2),
bytes AS (SELECT w, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM per_doc),
h AS (SELECT w, n, {_CRC.format("list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))")} AS h FROM bytes),
word AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2)
           ELSE w END AS w, n FROM h),
words AS (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM word WHERE length(w) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
cut AS (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS c
        FROM (SELECT w, n, CAST(unnest(range(1, length(w) + 1)) AS INTEGER) AS i FROM words)),
pair AS (SELECT a.w, b.w AS v, b.n AS vn FROM cut a JOIN cut b ON a.i = b.i AND a.c = b.c AND a.w <> b.w
         UNION SELECT a.w, b.w, b.n FROM cut a JOIN words b ON a.c = b.w
         UNION SELECT b.w, a.w, a.n FROM cut a JOIN words b ON a.c = b.w),
best AS (SELECT w, count(*) AS n_near, min({{'m': -vn, 'v': v}}) AS b FROM pair GROUP BY 1),
f AS (SELECT words.w, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 2 * words.n THEN b.v END AS form,
        CASE WHEN -b.m >= 2 * words.n THEN -b.m END AS form_n FROM words LEFT JOIN best USING (w)),
walk(w, here) AS (SELECT w, w FROM f UNION ALL SELECT walk.w, f.form FROM walk JOIN f ON f.w = walk.here WHERE f.form IS NOT NULL),
root AS (SELECT walk.w, walk.here FROM walk JOIN f ON f.w = walk.here WHERE f.form IS NULL)
SELECT f.w AS word, form, root.here AS root, n, n_near, form_n FROM f JOIN root ON root.w = f.w"""

#: lines by their stripped, lower-cased keys
LINES = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, {_LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key FROM l),
often AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(often.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE often.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN often USING (key) GROUP BY k.doc_id"""
