"""DuckDB SQL for the pipeline operators that SQL can express."""

# crc32 of the text's bytes, bit by bit, then the seeded order, fractional rank and even cut
SHARDS = """
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
bytes AS (SELECT *, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM d),
crc AS (SELECT doc_id, source, octet_length(encode(t)) + 16 AS size,
  xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x:
    list_reduce(list_prepend(xor(c, x), [0::BIGINT,0,0,0,0,0,0,0]), lambda r, z: xor(r >> 1, (r & 1) * 3988292384)))) AS text_crc32
  FROM bytes),
mixed AS (SELECT *, ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32::VARCHAR), 1, 15))::BIGINT AS mix FROM crc),
shared AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY mix, doc_id, text_crc32) - 0.5::DOUBLE)
  / count(*) OVER (PARTITION BY source) AS share FROM mixed),
placed AS (SELECT *, row_number() OVER (ORDER BY share, source NULLS FIRST, mix, doc_id, text_crc32) - 1 AS place, count(*) OVER () AS n FROM shared)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (place * 40 // n)::INTEGER AS shard,
  (place - ((place * 40 // n) * n + 39) // 40)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""

# every 10-word window (or shorter whole item) joined as text, hit words by position
DECONTAMINATION = r"""
WITH dw AS (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
bw AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bx AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM bw WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + 9], ' ') AS t FROM bx),
sizes AS (SELECT DISTINCT n FROM windows),
dx AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM dw),
dwin AS (SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS t FROM dx, sizes WHERE p + n - 1 <= len(w)),
met AS (SELECT r, p, n, item_id FROM dwin JOIN windows USING (n, t)),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM met) GROUP BY r),
own AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM met) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN own USING (r)
"""

# lines' token sets, prefix join on tokens in (count, word) order, exact Jaccard, any earlier match removes
LINE_DEDUP = r"""
WITH l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS s, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS p FROM documents),
t AS (SELECT doc_id, p, list_distinct(list_filter(regexp_split_to_array(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w FROM l),
u AS (SELECT doc_id, p, len(w) AS n, unnest(w) AS x, w FROM t WHERE len(w) > 0),
f AS (SELECT x, count(*) AS c FROM u GROUP BY x),
o AS (SELECT doc_id, p, n, w, x, row_number() OVER (PARTITION BY doc_id, p ORDER BY c, x) AS k FROM u JOIN f USING (x)),
pre AS (SELECT * FROM o WHERE k <= n - (80 * n + 99) // 100 + 1),
cand AS (SELECT DISTINCT a.doc_id, a.p, a.w, a.n, b.w AS v, b.n AS m FROM pre a JOIN pre b USING (x)
  WHERE (b.doc_id, b.p) < (a.doc_id, a.p) AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
gone AS (SELECT DISTINCT doc_id, p FROM cand WHERE 100 * len(list_intersect(w, v)) >= 80 * (n + m - len(list_intersect(w, v))))
SELECT l.doc_id, count(*)::BIGINT AS n_lines, count(g.p)::BIGINT AS n_removed,
  coalesce(string_agg(s, chr(10) ORDER BY l.p) FILTER (WHERE g.p IS NULL), '') AS text
FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.p = g.p GROUP BY l.doc_id
"""

# counts of all terms of documents and items, scored pair by pair
SEARCH = r"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
total AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM dw),
dt AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM dw) GROUP BY r, t),
iw AS (SELECT DISTINCT item_id, text FROM benchmark),
it AS (SELECT item_id, text, t, count(*) AS times FROM (SELECT item_id, text, unnest(list_filter(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS t FROM iw)
  GROUP BY item_id, text, t),
weight AS (SELECT t, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM dt, total GROUP BY t, n),
scored AS (SELECT item_id, text, r, sum(times * weight.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(dw.w) * total.n) // total.l))))::BIGINT AS score
  FROM it JOIN dt USING (t) JOIN weight USING (t) JOIN dw USING (r), total GROUP BY item_id, text, r),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scored JOIN dw USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# every conversation's prefixes as lists, grouped; a subtree is what has the node's list as a prefix
TRIE = """
WITH o AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
  substr(sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id FROM o),
crc AS (SELECT conv_id, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT)), lambda c, x:
    list_reduce(list_prepend(xor(c, x), [0::BIGINT,0,0,0,0,0,0,0]), lambda r, z: xor(r >> 1, (r & 1) * 3988292384)))) % 6 AS h FROM c),
w AS (SELECT crc.conv_id, 0 AS part, pos, r, t FROM crc JOIN o ON o.conv_id = crc.conv_id - crc.conv_id % 100 AND pos < h
  UNION ALL SELECT conv_id, 1, pos, r, t FROM crc JOIN o USING (conv_id) WHERE pos >= h),
p AS (SELECT conv_id, list({'r': r, 't': t} ORDER BY part, pos) AS turns FROM w GROUP BY conv_id),
q AS (SELECT conv_id, coalesce(turns, []) AS turns, len(coalesce(turns, [])) AS size FROM c LEFT JOIN p USING (conv_id)),
cells AS (SELECT conv_id, turns, size, unnest(range(0, size + 1)) AS d FROM q),
nodes AS (SELECT sha256(turns[1:d]::VARCHAR) AS k, d, any_value(turns[1:d]) AS path, min(conv_id) AS conv_id, count(*) AS n,
  coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = d), '') AS ends FROM cells GROUP BY turns[1:d], d),
own AS (SELECT *, CASE WHEN d > 0 THEN sha256(path[1:d - 1]::VARCHAR) END AS up, CASE WHEN d > 0 THEN (n - 1) * length(path[d].t) ELSE 0 END AS saved FROM nodes),
kids AS (SELECT up AS k, count(*) AS n_children FROM own WHERE d > 0 GROUP BY up),
full_nodes AS (SELECT own.*, coalesce(n_children, 0) AS n_children FROM own LEFT JOIN kids USING (k)),
above AS (SELECT sha256(path[1:a]::VARCHAR) AS k, saved, n_children FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_nodes)),
sums AS (SELECT k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY k)
SELECT f.conv_id::BIGINT AS conv_id, f.d::BIGINT AS depth, u.conv_id::BIGINT AS parent_conv_id, f.n::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN sums ON sums.k = f.k LEFT JOIN nodes u ON u.k = f.up
"""

ORACLE_SQL = {"op4_line_dedup": LINE_DEDUP, "op7_decontamination": DECONTAMINATION, "op9_shards": SHARDS, "op12_search": SEARCH,
              "op13_conversation_trie": TRIE}
