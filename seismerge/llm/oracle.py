"""DuckDB statements for the operator queries, written from the result contract."""

_HOST = "translate(regexp_extract({0}, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({0}, '^.*?://[^/?#]*([^?#]*)', 1, 's')"
_RULE = """(SELECT max_by(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path)) FROM rules r
 WHERE ({host} = r.host OR suffix({host}, '.' || r.host)) AND starts_with({path}, r.path))"""
_NODE = """CASE WHEN contains({0}, '://') THEN lower(regexp_extract({0}, '^([^#]*?)://', 1, 's')) || '://' || """ + _HOST.format(
    "regexp_extract({0}, '^([^#]*)', 1, 's')") + """ || CASE WHEN regexp_extract(regexp_extract({0}, '^([^#]*)', 1, 's'), '^.*?://[^/?]*(.*)$', 1, 's') = '' THEN '/'
 ELSE regexp_extract(regexp_extract({0}, '^([^#]*)', 1, 's'), '^.*?://[^/?]*(.*)$', 1, 's') END END"""
_STEPS = "string_split(regexp_extract({0}, '^/([^?#]*)', 1, 's'), '/')"
_FOLDED = "'/' || array_to_string(list_reduce(list_prepend([]::VARCHAR[], list_transform(" + _STEPS + """, lambda s: [s])),
  lambda done, s: CASE s[1] WHEN '..' THEN done[:len(done) - 1] WHEN '.' THEN done ELSE done || s END)
  || CASE WHEN """ + _STEPS + """[-1] IN ('.', '..') THEN [''] ELSE [] END, '/') || regexp_extract({0}, '^[^?#]*(.*)$', 1, 's')"""
OWN_PATH = _PATH.format("url")
RESOLVED = f"""CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
 WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
 WHEN starts_with(link, '//') THEN regexp_extract(url, '^(.*?:)//', 1, 's') || link
 WHEN starts_with(link, '/') THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1, 's') || {_FOLDED.format('link')}
 WHEN starts_with(link, '#') THEN regexp_extract(url, '^([^#]*)', 1, 's') || link
 WHEN starts_with(link, '?') THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1, 's') || own || link
 ELSE regexp_extract(url, '^(.*?://[^/?#]*)', 1, 's')
  || {_FOLDED.format("(CASE WHEN contains(own, '/') THEN regexp_extract(own, '^(.*/)', 1, 's') ELSE '/' END || link)")} END"""

URL_FILTER = f"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
 ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
page AS (SELECT page_id, url, html, coalesce({_HOST.format('url')}, '') AS host, coalesce({_PATH.format('url')}, '') AS path,
 {_NODE.format('url')} AS node FROM pages),
tags AS (SELECT url, unnest(regexp_extract_all(html, '<(?:link|meta)\\b[^>]*>', 0, 'is')) AS tag FROM page
 WHERE contains(url, '://') AND (regexp_matches(html, 'canonical', 'i') OR regexp_matches(html, 'http-equiv', 'i'))),
hrefs AS (SELECT url, replace(CASE
 WHEN regexp_matches(tag, '\\brel\\s*=\\s*["'']?[^"''>]*\\bcanonical\\b', 'is') THEN regexp_extract(tag, '\\bhref\\s*=\\s*["'']?\\s*([^"''\\s>]+)', 1, 'is')
 WHEN regexp_matches(tag, '\\bhttp-equiv\\s*=\\s*["'']?\\s*refresh\\b', 'is') THEN regexp_extract(tag, '\\bcontent\\s*=\\s*["'']?[^"''>]*?\\burl\\s*=\\s*[''"]?\\s*([^"''\\s>]+)', 1, 'is')
 END, '&amp;', '&') AS link FROM tags),
links AS (SELECT url, {RESOLVED} AS link FROM (SELECT *, {OWN_PATH} AS own FROM hrefs) WHERE link <> ''),
one AS (SELECT {_NODE.format('url')} AS a, {_NODE.format('link')} AS b FROM links),
edge AS (SELECT a, b FROM one WHERE a <> b UNION SELECT b, a FROM one WHERE a <> b),
reach(node, other) AS (SELECT a, a FROM edge UNION SELECT r.node, e.b FROM reach r JOIN edge e ON e.a = r.other),
alias AS (SELECT node, min(other) AS component, bool_or(coalesce(o.hit.verdict = 'block', false)) AS blocked
 FROM reach JOIN (SELECT a AS n, {_RULE.format(host=_HOST.format('a'), path=_PATH.format('a'))} AS hit FROM (SELECT DISTINCT a FROM edge)) o ON o.n = reach.other
 GROUP BY node),
judged AS (SELECT page_id, host, path, node, {_RULE.format(host='page.host', path='page.path')} AS hit FROM page)
SELECT page_id, host, path, hit.rule AS rule,
 coalesce(hit.verdict, CASE WHEN blocked THEN 'block' END, 'allow') AS verdict, component
FROM judged LEFT JOIN alias USING (node)
"""

DECONTAMINATION = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, l, array_to_string(w[i + 1:i + l], ' ') AS s FROM
  (SELECT item_id, w, least(len(w), 10) AS l, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, l, i, array_to_string(w[i + 1:i + l], ' ') AS s FROM
  (SELECT doc_id, w, l, unnest(range(0, len(w) - l + 1)) AS i FROM d, (SELECT DISTINCT l FROM bw))),
hit AS (SELECT DISTINCT doc_id, i, dw.l FROM dw SEMI JOIN (SELECT DISTINCT s, l FROM bw) k ON dw.s = k.s AND dw.l = k.l),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM
  (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM dw JOIN bw USING (s, l)) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
 CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""

EXACT_DEDUP = """
WITH g AS (SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size FROM documents GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents d JOIN g ON coalesce(d.text, '') = g.t
"""

NEAR_DEDUP = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 5], ' ') AS s FROM
  (SELECT doc_id, w, unnest(range(0, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
comp AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
 d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""

_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"

def _crc32(ids: str) -> str:
    """CTEs ending in crc(id, crc): CRC-32 of the decimal text of ``ids`` (a column ``id``), bit by bit."""
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""crc_step(id, s, k, bit, c) AS (
 SELECT id, CAST(id AS VARCHAR), 1, 0, xor(4294967295, ascii(CAST(id AS VARCHAR))) FROM ({ids}) WHERE id IS NOT NULL
 UNION ALL SELECT id, s, CASE WHEN bit = 8 THEN k + 1 ELSE k END, CASE WHEN bit = 8 THEN 0 ELSE bit + 1 END,
  CASE WHEN bit = 8 THEN xor(c, ascii(substr(s, k + 1, 1))) ELSE {bit} END
 FROM crc_step WHERE bit < 8 OR k < length(s)),
crc AS (SELECT id, xor(4294967295, c) AS crc FROM crc_step WHERE bit = 8 AND k = length(s))"""


def _tree(name: str, start: str) -> str:
    """CTEs of a forest: ``name`` has every node (tree, level, pos, h, n nodes on its level), ``name``_step
    its siblings before and after it, level by level."""
    return f"""{name}(tree, level, pos, h, n) AS ({start}
 UNION ALL SELECT tree, level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 15) // 16
 FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 16),
{name}_step AS (SELECT tree, level, pos,
 coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
 coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
 FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY tree, level, pos // 16 ORDER BY pos))"""


MERKLE_MANIFEST = f"""
WITH RECURSIVE {_crc32("SELECT DISTINCT doc_id AS id FROM documents")},
leaf AS (SELECT doc_id, source, {_LEAF.format(text="text")} AS leaf, CASE WHEN crc % 5 = 0 THEN
 {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
 FROM documents LEFT JOIN crc ON id = doc_id),
placed AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
 row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
 count(*) OVER (PARTITION BY source) AS n FROM leaf),
{_tree("low", "SELECT tree, 0, pos, leaf, n FROM placed")},
subroot AS (SELECT tree, max(level) AS height, max_by(h, level) AS subroot FROM low GROUP BY tree),
{_tree("high", "SELECT 0, 0, tree, subroot, count(*) OVER () FROM subroot")},
path AS (SELECT p.tree, p.pos, level, before, after FROM placed p JOIN low_step s
  ON s.tree = p.tree AND s.pos = p.pos // CAST(power(16, level) AS BIGINT)
 UNION ALL SELECT p.tree, p.pos, height + level, before, after FROM placed p JOIN subroot r USING (tree) JOIN high_step s
  ON s.pos = p.tree // CAST(power(16, level) AS BIGINT)),
fold(tree, pos, level, x) AS (SELECT tree, pos, 0, coalesce(tampered, leaf) FROM placed
 UNION ALL SELECT f.tree, f.pos, f.level + 1, sha256(before || x || after) FROM fold f JOIN path p
  ON p.tree = f.tree AND p.pos = f.pos AND p.level = f.level),
folded AS (SELECT tree, pos, max_by(x, level) AS folded_root FROM fold GROUP BY tree, pos),
proof AS (SELECT tree, pos, string_agg(before || after, '' ORDER BY level) AS siblings FROM path GROUP BY tree, pos),
root AS (SELECT max_by(h, level) AS root FROM high)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroot USING (tree) JOIN folded USING (tree, pos) LEFT JOIN proof USING (tree, pos), root
"""

CONVERSATION_TRIE = f"""
WITH RECURSIVE {_crc32("SELECT DISTINCT conv_id AS id FROM conversations")},
turns AS (SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT id AS conv, crc % 4 AS h, (SELECT count(*) FROM turns t WHERE t.conv = id - id % 20 AND pos <= crc % 4) AS taken FROM crc),
rebuilt AS (SELECT c.conv, pos AS depth, role, text FROM convs c JOIN turns t ON t.conv = c.conv - c.conv % 20 AND pos <= h
 UNION ALL SELECT c.conv, taken + pos - h, role, text FROM convs c JOIN turns t ON t.conv = c.conv AND pos > h),
path AS (SELECT conv, 0 AS depth, '' AS node, 0 AS words FROM convs
 UNION ALL SELECT conv, depth, string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (PARTITION BY conv ORDER BY depth),
 len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) FROM rebuilt),
ends AS (SELECT conv, max(depth) AS last FROM path GROUP BY conv),
nodes AS (SELECT depth, node, min(conv) AS conv, count(*) AS n, any_value(words) AS words,
 sha256(coalesce(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv) FILTER (depth = last), '')) AS ends_sha256
 FROM path JOIN ends USING (conv) GROUP BY depth, node),
linked AS (SELECT v.*, up.node AS up FROM nodes v LEFT JOIN path up ON up.conv = v.conv AND up.depth = v.depth - 1),
kids AS (SELECT up, depth - 1 AS depth, count(*) AS kids FROM linked WHERE up IS NOT NULL GROUP BY ALL),
sums AS (SELECT a.depth, a.node, count(*) FILTER (kids IS NULL) AS leaves, sum((n - 1) * v.words) AS saved
 FROM nodes v JOIN path a ON a.conv = v.conv AND a.depth <= v.depth LEFT JOIN kids k ON k.up = v.node AND k.depth = v.depth GROUP BY ALL)
SELECT v.conv AS conv_id, v.depth AS depth, p.conv AS parent_conv_id, v.n AS n_convs, coalesce(kids, 0) AS n_children, leaves AS n_leaves,
 CAST(saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM linked v LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.node = v.up
LEFT JOIN kids k ON k.up = v.node AND k.depth = v.depth JOIN sums s ON s.depth = v.depth AND s.node = v.node
"""
