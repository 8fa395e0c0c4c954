"""DuckDB twins of the registered queries that SQL can express."""

from tapeloom.llm.queries import CRAWL, LISTED

WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS lines,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
  FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
counted AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS k FROM windows),
again AS (
  SELECT doc_id, count(*) AS n
  FROM (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE k > 1) GROUP BY doc_id),
base AS (
  SELECT doc_id, t, lines, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(lines, lambda x: regexp_matches(x, '{WORD}')))
              - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '{WORD}')))) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS upper,
         length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS letters,
         length(regexp_replace(t, '[\x00-\x7F]', '', 'g')) AS beyond
  FROM d LEFT JOIN again USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (10 * n_symbols > n_words) AND NOT (word_chars < 2 * n_words OR word_chars > 15 * n_words)
       AND NOT (2 * n_dup_lines > len(lines)) AND NOT (2 * upper > letters)
       AND NOT (2 * (letters + beyond) < word_chars) AS kept
FROM failed
"""

LINES = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, i, lines[i] AS line FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
k AS (
  SELECT *, translate(regexp_replace(line, '^{WHITE}+|{WHITE}+$', '', 'g'), {ASCII_LOWER}) AS key FROM l),
f AS (
  SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.*, first_doc IS NOT NULL AND first_doc <> doc_id AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

NEAR = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {ASCII_LOWER}), '{WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(list_aggregate(w[i:i + 4], 'string_agg', ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(reach.b) AS component_id,
       min(reach.b) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n.n
"""

URLS = rf"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), {ASCII_LOWER}) AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule, says) AS (
  VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')),
parts AS (SELECT rule, says, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS p FROM rules),
fits AS (
  SELECT page_id, rule, says FROM u JOIN parts ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1),
blocked AS (SELECT DISTINCT host || path AS key FROM u WHERE regexp_matches(host, '{{LISTED}}'))
SELECT u.page_id, host, path, fits.rule AS rule,
       CASE WHEN says IS NOT NULL THEN says WHEN blocked.key IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM u LEFT JOIN fits USING (page_id) LEFT JOIN blocked ON blocked.key = host || path
"""

CHAT = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS position
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
c AS (
  SELECT conv_id, count(*) AS n, string_agg(concat(length(role), ':', role, length(text), ':', text), '' ORDER BY position) AS body
  FROM t GROUP BY conv_id),
u AS (SELECT body, n, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY body, n),
kept AS (SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM u l WHERE l.n > u.n AND starts_with(l.body, u.body)))
SELECT conv_id, position AS position, n AS n_turns, n_copies,
       concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)) AS rendered
FROM kept JOIN t USING (conv_id)
"""

REVISITS = """
WITH records AS ({CRAWL}),
parts AS (
  SELECT *, regexp_replace(lower(regexp_extract(url, '://(?:[^/?#@]*@)?([^/?#]*)', 1)), ':(80|443)$', '') AS host,
         regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '://[^?#]*[?]([^#]*)', 1) AS query
  FROM records),
canonical AS (
  SELECT * EXCLUDE (url),
         array_to_string(list_sort(list_filter(string_split(query, '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') AS kept,
         CASE WHEN contains(url, '://') THEN concat(host, CASE path WHEN '' THEN '/' ELSE path END,
           CASE kept WHEN '' THEN '' ELSE concat('?', kept) END) END AS url
  FROM parts),
answered AS (
  SELECT v.*, r.record_id AS answer, r.headers AS stored, r.payload_digest AS digest
  FROM canonical v LEFT JOIN canonical r ON r.kind = 'response' AND r.status = 200 AND r.url = v.url AND r.ts < v.ts
  WHERE v.kind = 'revisit'
  QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY r.ts DESC NULLS LAST, r.record_id DESC) = 1),
judged AS (
  SELECT *, CASE WHEN answer IS NULL THEN 'missing'
    WHEN headers IS NULL THEN CASE WHEN digest = payload_digest THEN 'matched' ELSE 'changed' END
    WHEN regexp_extract(stored, 'ETag: ("[^"]*")', 1) = regexp_extract(headers, 'etag: W/("[^"]*")', 1) THEN 'matched'
    ELSE 'changed' END AS verdict
  FROM answered)
SELECT record_id, url, ts, answer, verdict AS status,
       CASE WHEN verdict = 'matched' THEN concat_ws(chr(10),
         'cache-control: ' || CASE WHEN headers IS NULL THEN 'max-age=60' ELSE regexp_extract(headers, 'cache-control: ([^\r\n]*)', 1) END,
         'content-length: ' || regexp_extract(stored, 'Content-Length: ([0-9]+)', 1),
         'content-type: text/html',
         CASE WHEN headers IS NOT NULL THEN 'date: ' || regexp_extract(headers, 'date: (.*)$', 1) END,
         'etag: ' || CASE WHEN headers IS NULL THEN regexp_extract(stored, 'ETag: ("[^"]*")', 1)
                          ELSE regexp_extract(headers, 'etag: (W/"[^"]*")', 1) END,
         'last-modified: ' || regexp_extract(stored, 'Last-Modified: ([^\r\n]*)', 1)) END AS headers,
       CASE WHEN verdict = 'matched' THEN digest END AS payload_digest
FROM judged
"""

#: The remainders of the 256 bytes, and the checksum of a list of bytes, for a row of that table.
CRC_TABLE = """crc AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS v FROM range(256) r(i)))"""


def crc32(of: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295, {of}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def ascii_bytes(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda x: CAST(unicode(x) AS BIGINT))"


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')} || {_field(text)})"


MERKLE = f"""
WITH RECURSIVE {CRC_TABLE},
h AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf,
         CASE WHEN {crc32(ascii_bytes("CAST(doc_id AS VARCHAR)"))} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")}
              ELSE {_leaf("text")} END AS now
  FROM documents, crc),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM h),
up AS (
  SELECT tree, 0 AS lvl, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM l
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY tree, lvl, pos // 3, n),
s AS (SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS lvl, pos, node, n FROM s
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n),
below AS (
  SELECT l.pos, l.tree, up.lvl,
         coalesce(string_agg(up.node, '' ORDER BY up.pos) FILTER (up.pos < l.pos // CAST(3 ** up.lvl AS BIGINT)), '') AS lft,
         coalesce(string_agg(up.node, '' ORDER BY up.pos) FILTER (up.pos > l.pos // CAST(3 ** up.lvl AS BIGINT)), '') AS rgt
  FROM l JOIN up ON l.tree = up.tree AND up.n > 1 AND up.pos // 3 = l.pos // CAST(3 ** (up.lvl + 1) AS BIGINT)
  GROUP BY l.pos, l.tree, up.lvl),
above AS (
  SELECT s.tree, 1000 + top.lvl AS lvl,
         coalesce(string_agg(top.node, '' ORDER BY top.pos) FILTER (top.pos < s.pos // CAST(3 ** top.lvl AS BIGINT)), '') AS lft,
         coalesce(string_agg(top.node, '' ORDER BY top.pos) FILTER (top.pos > s.pos // CAST(3 ** top.lvl AS BIGINT)), '') AS rgt
  FROM s JOIN top ON top.n > 1 AND top.pos // 3 = s.pos // CAST(3 ** (top.lvl + 1) AS BIGINT)
  GROUP BY s.tree, s.pos, top.lvl),
steps AS (
  SELECT tree, pos, lvl, lft, rgt FROM below UNION ALL SELECT l.tree, l.pos, lvl, lft, rgt FROM l JOIN above USING (tree)),
paths AS (
  SELECT tree, pos, string_agg(lft || rgt, '' ORDER BY lvl) AS siblings, list(lft || '|' || rgt ORDER BY lvl) AS path
  FROM steps GROUP BY tree, pos),
folded AS (
  SELECT l.doc_id, l.leaf, s.node AS subroot, (SELECT node FROM top WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(list_prepend(l.now, coalesce(path, [])), lambda x, p: sha256(split_part(p, '|', 1) || x || split_part(p, '|', 2)))
           AS folded_root
  FROM l JOIN s USING (tree) LEFT JOIN paths ON paths.tree = l.tree AND paths.pos = l.pos)
SELECT *, folded_root = root AS verified FROM folded
"""

#: Characters from U+00C0 to U+00FF are the byte xC3 and their number less 64.
RUN_BYTES = """flatten(list_transform(string_split(concat(doc_id, ':', run), ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, unicode(x) - 64] END))"""

SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE},
r AS (
  SELECT doc_id, run, count(*) AS k
  FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {ASCII_LOWER}), '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
    FROM documents)
  GROUP BY ALL),
h AS (SELECT run, k, {crc32(RUN_BYTES)} AS h FROM r, crc),
c AS (
  SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h),
w AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM c WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
d AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS x FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
lost AS (SELECT DISTINCT d.word, w.word AS other FROM d JOIN w ON d.x = w.word),
near AS (
  SELECT word, other FROM lost UNION SELECT other, word FROM lost
  UNION SELECT a.word, b.word FROM d a JOIN d b ON a.i = b.i AND a.x = b.x AND a.word <> b.word),
best AS (
  SELECT near.word, count(*) AS n_near, min({{'n': -w.n, 'word': w.word}}) AS b FROM near JOIN w ON w.word = near.other GROUP BY near.word),
f AS MATERIALIZED (
  SELECT word, n, CASE WHEN -b.n >= 2 * n THEN b.word END AS form, CASE WHEN -b.n >= 2 * n THEN -b.n END AS form_n,
         CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
  FROM w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM f JOIN walk ON walk.word = f.word JOIN f AS e ON e.word = walk.at AND e.form IS NULL
"""

SQL: dict[str, str] = {
    "op2_url_filter": URLS.replace("{LISTED}", LISTED),
    "op3_chat_format": CHAT,
    "op5_quality_rules": QUALITY,
    "op6_line_dedup": LINES,
    "op8_warc_revisits": REVISITS.replace("{CRAWL}", CRAWL),
    "op9_minhash": NEAR,
    "op11_merkle": MERKLE,
    "op13_spelling": SPELLING,
}
