"""DuckDB SQL of the queries that SQL can express on whole tables. The SQL
carries its own patterns and constants."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op1_nearest"] = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.v, v.v) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.v) = len(v.v) WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLE["op5_token_rollups"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
  WHERE doc_id IS NOT NULL AND doc_id % 7 <> 3
), f AS (
  SELECT lang, CASE WHEN doc_id % 11 = 2 AND doc_id % 5 <> 1 THEN 'moved' ELSE source END AS source,
    CASE WHEN doc_id % 5 = 1 THEN text || ' ' || text ELSE text END AS text FROM d
), c AS (
  SELECT source, lang, 'words-1' AS tokenizer,
    len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS tokens FROM f
  UNION ALL
  SELECT source, lang, 'quarter-1', CAST((length(text) + 3) // 4 AS BIGINT) FROM f
)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens FROM c GROUP BY ALL
"""

_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

ORACLE["op9_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS o FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, array_to_string(w[o + 1 : o + 10], ' ') AS g, CAST(least(len(w), 10) AS BIGINT) AS n FROM bw),
lens AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, s, array_to_string(w[s + 1 : s + n], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, lens WHERE len(w) >= n)
),
hit AS (SELECT doc_id, s, win.n, item_id FROM grams JOIN win ON grams.g = win.g AND grams.n = win.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)
"""


_WILD = r"'*' || regexp_extract({0}, '(\.[A-Za-z][A-Za-z0-9]{{0,4}})$', 1)"

ORACLE["op10_url_filter"] = (
    r"""
WITH RECURSIVE u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
), r AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u
), m AS (SELECT CAST(doc_id AS VARCHAR) AS key, max(1 - quality) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY 1),
p AS (
  SELECT host, path, count(*) AS w, count(bad) AS lab, coalesce(sum(bad), 0) AS bad
  FROM r LEFT JOIN m ON regexp_extract(path, '/([0-9]+)(?:[./]|$)', 1) = m.key GROUP BY ALL
),
-- one level of the paths a step; a level is that of the last node above
grow(host, path, w, lab, bad, template, level, segs) AS (
  SELECT host, path, w, lab, bad, '', 0, string_split(regexp_replace(path, '^/', ''), '/') FROM p
  UNION ALL
  SELECT host, path, w, lab, bad,
    CASE WHEN nn < 4 THEN template || '/' || array_to_string(list_transform(segs, lambda x: WILD(x)), '/')
      WHEN cand AND (4.0::DOUBLE * n >= sqrt(nn) OR abs(nb - nl * rate)
        > (1.96::DOUBLE + sqrt(2.0::DOUBLE * ln(greatest(d, 1)))) * sqrt(nl * rate * (1.0::DOUBLE - rate))) THEN template || '/' || s
      ELSE template || '/' || WILD(s) END,
    CASE WHEN nn < 4 THEN level ELSE level + 1 END, CASE WHEN nn < 4 THEN segs[1:0] ELSE segs[2:] END
  FROM (SELECT *, count(DISTINCT CASE WHEN cand THEN s END) OVER (PARTITION BY host, template) AS d FROM (
    SELECT *, n >= 4 AND NOT starts_with(s, '*') AS cand FROM (
      SELECT *, sum(w) OVER b AS n, CAST(sum(lab) OVER b AS DOUBLE) AS nl, CAST(sum(bad) OVER b AS DOUBLE) AS nb, sum(w) OVER k AS nn,
        CAST(sum(bad) OVER k AS DOUBLE) / greatest(sum(lab) OVER k, 1) AS rate
      FROM (SELECT *, segs[1] AS s FROM grow WHERE len(segs) > 0)
      WINDOW b AS (PARTITION BY host, template, s), k AS (PARTITION BY host, template)
  )))
),
t AS (SELECT * FROM grow WHERE len(segs) = 0),
leaf AS (SELECT host, template, level, sum(lab) AS n, sum(bad) AS bad FROM t GROUP BY ALL),
whole AS (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0.0) AS prior FROM leaf),
-- from the deepest level up: pools go to the node above, the others are groups
items(host, node, level, origin, place, grp, n, bad) AS (
  SELECT host, array_to_string(string_split(template, '/')[1 : level + 1], '/'), level, template, -1, false, CAST(n AS DOUBLE), CAST(bad AS DOUBLE) FROM leaf
  UNION ALL
  SELECT host, CASE WHEN act AND near THEN array_to_string(string_split(node, '/')[1 : level], '/') ELSE node END AS node,
    CASE WHEN act AND near THEN level - 1 ELSE level END AS level, CASE WHEN act AND near THEN node ELSE origin END AS origin,
    CASE WHEN act AND near THEN level ELSE place END AS place, act AND NOT near AS grp, sum(n), sum(bad)
  FROM (SELECT *, abs(bad - n * rate) <= 1.96::DOUBLE * sqrt(n * rate * (1.0::DOUBLE - rate)) AS near FROM (
    SELECT *, level = max(level) OVER () AS act, sum(bad) OVER k / greatest(sum(n) OVER k, 1) AS rate FROM items WHERE NOT grp AND level >= 0
    WINDOW k AS (PARTITION BY host, node, level)))
  GROUP BY 1, 2, 3, 4, 5, 6
),
groups AS (SELECT host, origin, place, n, bad FROM items WHERE grp OR level = -1),
chain AS (
  SELECT host, template, template AS origin, -1 AS place, level + 1 AS depth FROM leaf
  UNION ALL
  SELECT host, template, array_to_string(string_split(template, '/')[1 : i + 1], '/'), i, i
  FROM (SELECT host, template, unnest(range(0, level + 1)) AS i FROM leaf)
),
judged AS (
  SELECT host, template, arg_max(bad, depth) AS b, arg_max(n, depth) AS k FROM chain JOIN groups USING (host, origin, place) GROUP BY ALL
)
SELECT page_id, r.host, r.path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN (b + 8.0::DOUBLE * prior) / (k + 8.0::DOUBLE) >= 0.5 THEN 'block' ELSE 'allow' END AS verdict,
  t.template
FROM r JOIN t ON r.host = t.host AND r.path = t.path JOIN judged ON t.host = judged.host AND t.template = judged.template, whole
"""
    .replace("WILD(x)", _WILD.format("x")).replace("WILD(s)", _WILD.format("s"))
)

ORACLE["op13_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.v, v.v) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0) AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.v) = len(v.v)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_TERMS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

ORACLE["op12_ranked"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
whole AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(len(w)) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, w, unnest(w) AS term FROM d) GROUP BY r, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * whole.n + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole
),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL),
s AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * tf.n * whole.n) // whole.l)))) AS BIGINT) AS score
  FROM q JOIN weight USING (term) JOIN tf USING (term), whole GROUP BY item_id, r
),
x AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM x WHERE rank <= 10
"""

_CRC32 = (
    "xor(list_reduce([4294967295]::BIGINT[] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT), "
    "lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda e, z: xor(e >> 1, 3988292384 * (e & 1)))), 4294967295)"
)

ORACLE["op11_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS sha,
    strlen(coalesce(text, '')) AS bytes FROM conversations WHERE conv_id IS NOT NULL
), o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha) AS pos FROM t),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base, {_CRC32} % 9 AS h FROM o GROUP BY conv_id),
k AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS kept FROM c LEFT JOIN c AS b ON b.conv_id = c.base),
rebuilt AS (
  SELECT k.conv_id, o.pos, o.sha, o.bytes FROM k JOIN o ON o.conv_id = k.base AND o.pos <= k.h
  UNION ALL
  SELECT k.conv_id, o.pos - k.h + k.kept, o.sha, o.bytes FROM k JOIN o ON o.conv_id = k.conv_id AND o.pos > k.h
), path AS (
  SELECT conv_id, pos AS depth, bytes, string_agg(sha, ',') OVER w AS node, coalesce(string_agg(sha, ',') OVER b, '') AS parent FROM rebuilt
  WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM c
), node AS (SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs FROM path GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n FROM node WHERE parent IS NOT NULL GROUP BY parent),
own AS (
  SELECT node.*, coalesce(kids.n, 0) AS n_children, (n_convs - 1) * bytes AS saved FROM node LEFT JOIN kids USING (node)
), sub AS (
  SELECT path.node, count(*) FILTER (WHERE own.n_children = 0) AS n_leaves, sum(own.saved) AS saved FROM own
  JOIN path ON path.conv_id = own.conv_id AND path.depth <= own.depth GROUP BY path.node
), last AS (SELECT conv_id, max(depth) AS depth FROM path GROUP BY conv_id),
fin AS (SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM path JOIN last USING (conv_id, depth) GROUP BY node)
SELECT own.conv_id, CAST(own.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, own.n_convs, own.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM own JOIN sub USING (node) LEFT JOIN own AS up ON up.node = own.parent LEFT JOIN fin ON fin.node = own.node
"""
