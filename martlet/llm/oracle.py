"""DuckDB statements of the operators that SQL can express; the others are tested against brute force."""

from __future__ import annotations

_OP3 = """
WITH paid AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
coded AS (
  SELECT *, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)),
    'string_agg', '') AS payload_digest
  FROM paid),
ranked AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM coded)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN top IS NULL OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM ranked
"""

_WORDS10 = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP10 = f"""
WITH item AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item_id, {_WORDS10} AS w FROM benchmark),
sized AS (SELECT *, least(10, len(w)) AS n FROM item WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM sized)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS10} AS w FROM documents),
spot AS (
  SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS k
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT spot.r, spot.s, spot.n, win.item_id FROM spot JOIN win USING (n, k)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
own AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN pos USING (r) LEFT JOIN own USING (r)
"""

_OP9 = """
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
spot AS (SELECT r, s, md5(substr(h, 2 * s + 1, 400)) AS k
       FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 199)) AS s FROM doc WHERE len(h) >= 400)),
hit AS (SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY k) AS n FROM spot) WHERE n > 1),
step AS (SELECT r, s, CASE WHEN s - lag(s) OVER (PARTITION BY r ORDER BY s) <= 200 THEN 0 ELSE 1 END AS fresh FROM hit),
span AS (SELECT r, g, min(s) AS a, max(s) + 200 AS b
         FROM (SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS g FROM step) GROUP BY r, g),
kept AS (SELECT r, a, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) + 1,
                             2 * (a - coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0))) AS piece
         FROM span JOIN doc USING (r)),
cut AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last FROM span GROUP BY r),
text AS (SELECT r, string_agg(piece, '' ORDER BY a) AS body FROM kept GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN last IS NULL THEN h ELSE body || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM doc LEFT JOIN cut USING (r) LEFT JOIN text USING (r)
"""

_TERMS11 = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_OP11 = f"""
WITH doc AS (SELECT * FROM (SELECT row_number() OVER () AS r, doc_id, {_TERMS11} AS w FROM documents) WHERE len(w) > 0),
whole AS (SELECT count(*)::BIGINT AS n, sum(len(w))::BIGINT AS l FROM doc),
item AS (SELECT i, item_id, t, count(*)::BIGINT AS times
         FROM (SELECT i, item_id, unnest(w) AS t FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS11} AS w FROM benchmark))
         GROUP BY i, item_id, t),
post AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM doc) WHERE t IN (SELECT t FROM item) GROUP BY r, t),
term AS (SELECT t, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
         FROM (SELECT t, count(*)::BIGINT AS df FROM post GROUP BY t), whole),
long AS (SELECT r, doc_id, 100 - 25 + ((25 * len(w)::BIGINT * n) // l) AS m FROM doc, whole),
worth AS (SELECT r, doc_id, t, weight * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS v
          FROM post JOIN term USING (t) JOIN long USING (r)),
total AS (SELECT i, item_id, r, doc_id, sum(times * v)::BIGINT AS score FROM item JOIN worth USING (t) GROUP BY i, item_id, r, doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS place FROM total WHERE score > 0)
SELECT item_id, place::INT AS rank, doc_id, score FROM placed WHERE place <= 20
"""

_BIT12 = "xor(x >> 1, (x & 1) * 3988292384)"
for _ in range(7):
    _BIT12 = f"list_transform([{_BIT12}], lambda x: xor(x >> 1, (x & 1) * 3988292384))[1]"

_OP12 = f"""
WITH turns AS (
  SELECT conv_id AS c, turn, md5(length(coalesce(role, '')) || ' ' || coalesce(role, '') || coalesce(text, '')) AS g, length(coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT c, g, n, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, g) AS p FROM turns),
coded AS (
  SELECT c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda k: ascii(s[k])::BIGINT)),
    lambda a, b: list_transform([xor(a, b)], lambda x: {_BIT12})[1])) % 6 AS h
  FROM (SELECT DISTINCT c, c::VARCHAR AS s FROM placed)),
built AS (
  SELECT coded.c, p AS q, g, n FROM coded JOIN placed ON placed.c = coded.c - coded.c % 100 AND p <= h
  UNION ALL
  SELECT coded.c, p - h + least(h, (SELECT count(*) FROM placed AS base WHERE base.c = coded.c - coded.c % 100)), g, n
  FROM coded JOIN placed ON placed.c = coded.c AND p > h),
path AS (SELECT coded.c, list(g ORDER BY q) FILTER (g IS NOT NULL) AS gs, list(n ORDER BY q) FILTER (g IS NOT NULL) AS ns
         FROM coded LEFT JOIN built ON built.c = coded.c GROUP BY coded.c),
spot AS (
  SELECT c, d, coalesce(len(gs), 0) AS long, CASE WHEN d = 0 THEN '' ELSE md5(array_to_string(gs[1:d], '')) END AS node,
    CASE WHEN d < 2 THEN '' ELSE md5(array_to_string(gs[1:d - 1], '')) END AS parent, CASE WHEN d = 0 THEN 0 ELSE ns[d] END AS n
  FROM (SELECT *, unnest(range(0, coalesce(len(gs), 0) + 1)) AS d FROM path)),
node AS (
  SELECT node, d, parent, min(c) AS c, count(*) AS members, any_value(n) AS n,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (long = d), '') AS ends
  FROM spot GROUP BY node, d, parent),
kids AS (SELECT parent AS node, count(*) AS kids FROM node WHERE d > 0 GROUP BY parent),
full_ AS (SELECT node.*, coalesce(kids.kids, 0) AS kids FROM node LEFT JOIN kids USING (node)),
below AS (
  SELECT spot.node, count(*) FILTER (full_.kids = 0) AS leaves, sum((full_.members - 1) * full_.n) AS saved
  FROM full_ JOIN spot ON spot.c = full_.c AND spot.d <= full_.d GROUP BY spot.node)
SELECT f.c AS conv_id, f.d::BIGINT AS depth, CASE WHEN f.d = 0 THEN NULL ELSE up.c END AS parent_conv_id, f.members::BIGINT AS n_convs,
  f.kids::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_ AS f JOIN below USING (node) LEFT JOIN node AS up ON up.node = f.parent
"""

ORACLE = {"op3_warc": _OP3, "op9_substrings": _OP9, "op10_decontaminate": _OP10, "op11_shared_queries": _OP11, "op12_prefix_trie": _OP12}
