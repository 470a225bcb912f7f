"""DuckDB SQL for the queries of this subpackage that SQL can express over whole tables."""

from __future__ import annotations

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
WITH items AS (
  SELECT item_id, regexp_extract_all({LOWER}, '{WORDS}') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS window_text
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '{WORDS}') AS w FROM documents
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS window_text
  FROM (SELECT r, w, size, unnest(range(1, greatest(len(w) - size + 1, 0) + 1)) AS i FROM docs, sizes)
), found AS (
  SELECT r, i, places.size, item_id FROM places JOIN windows USING (size, window_text)
), hit AS (
  SELECT r, count(DISTINCT k) AS n_hit
  FROM (SELECT r, unnest(range(i, i + size)) AS k FROM (SELECT DISTINCT r, i, size FROM found)) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS name FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


# The pages name no canonical address and no redirect, so only spellings of one address are aliases.
OP1 = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), parsed AS (
  SELECT row_number() OVER () AS r, page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
         list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '^[^?#]*\?([^#]*)', 1, 's'), '&'),
                     lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid|msclkid|mc_[ce]id)(=|$)', 'i'))) AS args
  FROM pages
), keyed AS (
  SELECT r, page_id, host, path, CASE WHEN host <> '' THEN
         regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') || regexp_replace(path, '/$', '')
         || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END END AS key
  FROM parsed
), best AS (
  SELECT r, arg_min(struct_pack(rule := rule_host || rule_path, v := rule_verdict),
                    (-length(rule_host || rule_path), rule_verdict <> 'allow', rule_host || rule_path)) AS b
  FROM keyed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY r
), blocked AS (
  SELECT DISTINCT key FROM keyed JOIN best USING (r) WHERE b.v = 'block'
)
SELECT page_id, host, path, b.rule AS rule,
       coalesce(b.v, CASE WHEN blocked.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM keyed LEFT JOIN best USING (r) LEFT JOIN blocked ON keyed.key = blocked.key
"""

# Reading the template back must give the table again; its length follows from the roles and the escaped texts.
OP8 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(/?(?:s>|SYS\]|INST\]|ROLE\]|TEXT\]))', '\1\\\2\3', 'g') AS body,
         regexp_replace(role, '([<\[])(\\*)(/?(?:s>|SYS\]|INST\]|ROLE\]|TEXT\]))', '\1\\\2\3', 'g') AS name FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(length(body) + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 5
                               ELSE 23 + length(name) END))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


# CRC-32 of a decimal number: its bytes, each followed by eight steps of the bitwise division.
OP12 = r"""
WITH turns AS (
  SELECT conv_id::BIGINT AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p,
         sha256(coalesce(role, '') || chr(10) || coalesce(text, '')) AS said, octet_length(encode(coalesce(text, ''))) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT c, count(*) AS size, xor(4294967295::BIGINT, list_reduce(
           [4294967295::BIGINT] || flatten(list_transform(string_split(c::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) % 9 AS h
  FROM turns GROUP BY c
), plans AS (
  SELECT s.c, s.h, s.c - s.c % 5 AS source, least(s.h, coalesce(o.size, 0)) AS taken FROM sizes s LEFT JOIN sizes o ON o.c = s.c - s.c % 5
), seqs AS (
  SELECT plans.c, p + 1 AS d, said, bytes FROM plans JOIN turns ON turns.c = source WHERE p < h
  UNION ALL
  SELECT plans.c, p - h + taken + 1, said, bytes FROM plans JOIN turns USING (c) WHERE p >= h
), prefixes AS (
  SELECT c, d, bytes, sha256(string_agg(said, '') OVER (PARTITION BY c ORDER BY d)) AS prefix FROM seqs
  UNION ALL
  SELECT c, 0, 0, '' FROM sizes
), named AS (
  SELECT c, d, bytes, min(c) OVER (PARTITION BY d, prefix) AS node FROM prefixes
), nodes AS (
  SELECT d, node, count(*) AS n, max(bytes) AS bytes FROM named GROUP BY d, node
), edges AS (
  SELECT nodes.d, nodes.node, nodes.n, nodes.bytes, up.node AS parent FROM nodes LEFT JOIN named up ON up.c = nodes.node AND up.d = nodes.d - 1
), kids AS (
  SELECT d - 1 AS d, parent AS node, count(*) AS kids FROM edges WHERE d > 0 GROUP BY ALL
), sums AS (
  SELECT up.d, up.node, sum(CASE WHEN kids IS NULL THEN 1 ELSE 0 END) AS leaves, sum((edges.n - 1) * edges.bytes) AS saved
  FROM edges LEFT JOIN kids USING (d, node) JOIN named up ON up.c = edges.node AND up.d <= edges.d GROUP BY up.d, up.node
), ends AS (
  SELECT d, node, string_agg(c::VARCHAR, ',' ORDER BY c) AS members
  FROM (SELECT c, max_by(node, d) AS node, max(d) AS d FROM named GROUP BY c) GROUP BY d, node
)
SELECT node AS conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n::BIGINT AS n_convs, coalesce(kids, 0)::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(members, '')) AS ends_sha256
FROM edges JOIN sums USING (d, node) LEFT JOIN kids USING (d, node) LEFT JOIN ends USING (d, node)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": OP1, "op4_decontamination": OP4, "op8_chat": OP8, "op12_prefix_trie": OP12}
