"""DuckDB queries over the driver's tables that give the results of the registered queries."""

from __future__ import annotations

from checks.registry import CENTERS, ROUNDS, VECTORS
from checks.views import SEED, STOP_WORDS, TAGS
from loomwork.operators.word_vectors import NEGATIVES, RATE
from loomwork.plans.forum import CLUSTERS, DOMAINS, ETA, MAX_ITER, SPREAD


def quoted(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


STOP = f"stop AS (SELECT unnest([{quoted(STOP_WORDS)}]) AS word)"

WORDS = r"""
corpus AS (SELECT 0 AS source, text FROM documents UNION ALL SELECT 1, text FROM conversations),
words AS (
  SELECT source, word
  FROM (SELECT source, unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM corpus)
  WHERE word <> '')"""

PAIRED = """
paired AS (
  SELECT word, count(*) FILTER (source = 0) AS n0, count(*) FILTER (source = 1) AS n1
  FROM words WHERE word NOT IN (SELECT word FROM stop) GROUP BY word)"""

def line_ratings(item: str) -> str:
    return f"""
ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS "user", CAST({item} AS INTEGER) AS item, l_quantity AS score
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
entries AS (SELECT "user", item, max(score) AS score, count(*) AS n FROM ratings GROUP BY ALL)"""


ENTRIES = """
ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(split_part(p_brand, '#', 2) AS INTEGER) AS item,
         l_quantity AS score
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
entries AS (SELECT "user", item, max(score) AS score, count(*) AS n FROM ratings GROUP BY ALL)"""

LATEST = """
entries AS (
  SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(split_part(p_brand, '#', 2) AS INTEGER) AS item,
         CAST(arg_max(l_quantity, row(o_orderdate, o_orderkey, l_linenumber, l_quantity)) AS DOUBLE) AS score, count(*) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""

MATRIX = """
matrix AS (
  SELECT a.item AS item1, b.item AS item2,
         CAST(sum(CASE WHEN a.item = b.item THEN a.n * a.n - a.n ELSE a.n * b.n END) AS BIGINT) AS n
  FROM entries a JOIN entries b ON a."user" = b."user"
  GROUP BY ALL)"""

PREDICTED = """
predicted AS (
  SELECT e."user", m.item2 AS item, sum(e.score * m.n) AS score
  FROM entries e JOIN matrix m ON e.item = m.item1
  GROUP BY ALL)"""

TAG_CASES = "\n".join(
    f"    WHEN o_orderpriority = '{priority}'{f" AND o_orderstatus = '{status}'" if status else ''} THEN '{tag}'"
    for (priority, status), tag in TAGS.items()
)

QUESTIONS = f"""
questions AS (
  SELECT CAST(o_orderkey AS INTEGER) AS id, CAST(floor(o_totalprice / 1000) AS INTEGER) AS score,
    CASE
{TAG_CASES}
    END AS tags
  FROM orders),
answers AS (
  SELECT CAST(l_orderkey AS INTEGER) AS parent_id, CAST(floor(l_extendedprice / 100) - 500 AS INTEGER) AS score
  FROM lineitem),
scored AS (
  SELECT q.id, q.tags, q.score, greatest(0, max(a.score)) AS best
  FROM questions q JOIN answers a ON q.id = a.parent_id
  GROUP BY q.id, q.tags, q.score)"""

POINTS = f"""
points AS (
  SELECT id, (coalesce(list_position([{quoted(DOMAINS)}], tags), 0) - 1) * CAST({SPREAD} AS BIGINT) AS x,
         CAST(best AS BIGINT) AS y
  FROM scored WHERE tags IS NOT NULL),
weighted AS MATERIALIZED (SELECT x, y, count(*) AS w FROM points GROUP BY ALL)"""

DRAWS = f"""
draws AS MATERIALIZED (
  SELECT cluster, x AS cx, y AS cy
  FROM (SELECT cluster, x, y,
               -ln((CAST(CAST('0x' || substr(md5(concat_ws('#', {SEED}, cluster, x, y)), 1, 13) AS BIGINT) AS DOUBLE)
                    + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE)) / w AS finish
        FROM weighted, (SELECT CAST(unnest(range({CLUSTERS})) AS INTEGER) AS cluster))
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY finish, x, y) = 1)"""


def squared(x: str, y: str) -> str:
    return f"(CAST({x} AS DOUBLE) * ({x}) + CAST({y} AS DOUBLE) * ({y}))"


def located(points: str, centroids: str, columns: str) -> str:
    """Every row of ``points`` with the cluster of its nearest centroid."""
    distance = squared("p.x - c.cx", "p.y - c.cy")
    return f"""
  SELECT {columns}, arg_min(c.cluster, row({distance}, c.cluster)) AS cluster
  FROM {points} p, {centroids} c
  GROUP BY {columns}"""


MEANS = """
  SELECT cluster, CAST(sum(x * w) AS BIGINT) // CAST(sum(w) AS BIGINT) AS cx,
         CAST(sum(y * w) AS BIGINT) // CAST(sum(w) AS BIGINT) AS cy, CAST(sum(w) AS BIGINT) AS size
"""

LLOYD = f"""
lloyd AS (
  SELECT 0 AS round, cluster, cx, cy, CAST('infinity' AS DOUBLE) AS shift FROM draws
  UNION ALL
  SELECT round + 1, cluster, coalesce(mx, cx), coalesce(my, cy),
         sum({squared("cx - coalesce(mx, cx)", "cy - coalesce(my, cy)")}) OVER ()
  FROM lloyd LEFT JOIN (
    SELECT cluster, cx AS mx, cy AS my
    FROM ({MEANS} FROM ({located("weighted", "lloyd", "p.x, p.y, p.w")}) GROUP BY cluster)) means USING (cluster)
  WHERE shift >= {ETA} AND round <= {MAX_ITER}),
final AS MATERIALIZED (SELECT cluster, cx, cy FROM lloyd WHERE round = (SELECT max(round) FROM lloyd))"""

TOKENS = (
    r"""
cleaned AS (
  SELECT doc_id, list_filter(
    CASE WHEN text <> '' AND trimmed = '' THEN [] ELSE string_split_regex(trimmed, '[ \t\n\x0B\f\r]') END,
    lambda t: NOT list_contains([STOP_WORDS], t)) AS tokens
  FROM (SELECT doc_id, text, regexp_replace(lower(text), '[ \t\n\x0B\f\r]+$', '') AS trimmed
        FROM documents WHERE text IS NOT NULL))"""
).replace("STOP_WORDS", quoted(STOP_WORDS))

SILHOUETTE = """
WITH coords AS (
  SELECT vec_id, label, unnest(range(len(embedding))) AS d, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
sums AS (SELECT label, d, sum(v) AS s FROM coords GROUP BY ALL),
norms AS (SELECT vec_id, label, sum(v * v) AS norm FROM coords GROUP BY ALL),
clusters AS (SELECT label, count(*) AS n, sum(norm) AS norm FROM norms GROUP BY ALL),
dots AS (SELECT c.vec_id, s.label, sum(c.v * s.s) AS dot FROM coords c JOIN sums s USING (d) GROUP BY ALL),
means AS (
  SELECT p.vec_id, p.label AS own, c.label, c.n, p.norm + c.norm / c.n - 2 * d.dot / c.n AS dist
  FROM norms p JOIN dots d USING (vec_id) JOIN clusters c ON c.label = d.label),
ab AS (
  SELECT vec_id, max(CASE WHEN own = label THEN n END) AS n,
         max(CASE WHEN own = label THEN dist * n / nullif(n - 1, 0) END) AS a,
         min(CASE WHEN own <> label THEN dist END) AS b
  FROM means GROUP BY vec_id)
"""
ROW_SILHOUETTE = "CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END"


SIZE = VECTORS["vector_size"]


def listed(term: str, dimensions: int = SIZE) -> str:
    return "[" + ", ".join(term.replace("@", str(i + 1)) for i in range(dimensions)) + "]"


def dot(a: str, b: str) -> str:
    return "(" + " + ".join(f"{a}[{i + 1}] * {b}[{i + 1}]" for i in range(SIZE)) + ")"


def start(kind: str) -> str:
    hashes = [
        f"""((CAST(CAST('0x' || substr(md5(concat_ws('#', {VECTORS["seed"]}, token, '{kind}', {i})), 1, 13) AS BIGINT) AS DOUBLE)
        + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE) - CAST(0.5 AS DOUBLE)) / {SIZE}"""
        for i in range(SIZE)
    ]
    return f"[{', '.join(hashes)}]"


def step(n: int) -> str:
    """One step of the word vectors, from ``words{n}`` to the next."""
    gap = f"p.n * (1 - 1 / (1 + exp(-{dot('a.u', 'b.v')})))"
    means = ", ".join(listed(f"sum(total * {c}[@]) / sum(total)") + f" AS m{c}" for c in "uv")
    new = ", ".join(
        listed(f"{own}[@] + {RATE} * (pull_{own}[@] / total - {NEGATIVES} * (1 / (1 + exp(-{dot(own, 'm' + other)}))) * m{other}[@])")
        + f" AS {own}"
        for own, other in ("uv", "vu")
    )
    return f"""
met{n} AS MATERIALIZED (
  SELECT p.token, p.context, a.u, b.v, {gap} AS g
  FROM pairs p JOIN words{n} a ON p.token = a.token JOIN words{n} b ON p.context = b.token),
words{n + 1} AS MATERIALIZED (
  SELECT token, total, {new}
  FROM words{n}
    JOIN (SELECT token, {listed("sum(g * v[@])")} AS pull_u FROM met{n} GROUP BY token) USING (token)
    JOIN (SELECT context AS token, {listed("sum(g * u[@])")} AS pull_v FROM met{n} GROUP BY context) USING (token),
    (SELECT {means} FROM words{n}))"""


WORD_VECTORS = (
    f"""
known AS (SELECT token FROM (SELECT unnest(tokens) AS token FROM cleaned) GROUP BY token HAVING count(*) >= {VECTORS["min_count"]}),
apart AS (
  SELECT tokens[i] AS a, tokens[i + d] AS b
  FROM (SELECT tokens, d, unnest(range(1, len(tokens) - d + 1)) AS i FROM cleaned, (SELECT unnest(range(1, {VECTORS["window"]} + 1)) AS d))),
once AS (
  SELECT a, b, count(*) AS n FROM apart WHERE a IN (SELECT token FROM known) AND b IN (SELECT token FROM known) GROUP BY ALL),
pairs AS MATERIALIZED (
  SELECT token, context, CAST(sum(n) AS DOUBLE) AS n
  FROM (SELECT a AS token, b AS context, n FROM once UNION ALL SELECT b, a, n FROM once) GROUP BY ALL),
words0 AS MATERIALIZED (
  SELECT token, total, {start("input")} AS u, {start("output")} AS v
  FROM (SELECT token, sum(n) AS total FROM pairs GROUP BY token))""",
    *(step(n) for n in range(VECTORS["steps"])),
)

MEANS_OF_TEXTS = ", ".join(
    f"round(coalesce(sum(u[{i + 1}]), 0) / greatest(any_value(n), 1), 6) + 0.0 AS v{i}" for i in range(SIZE)
)


def center_round(n: int) -> str:
    """Assignment to the centres ``centers{n}`` and their means."""
    return f"""
assigned{n} AS MATERIALIZED (
  SELECT vec_id, arg_min(cluster, row(dist, cluster)) AS cluster
  FROM (SELECT vec_id, cluster, sum((p.v - c.v) * (p.v - c.v)) AS dist FROM coords p JOIN centers{n} c USING (d) GROUP BY ALL)
  GROUP BY vec_id),
centers{n + 1} AS MATERIALIZED (
  SELECT c.cluster, c.d, coalesce(m.v, c.v) AS v
  FROM centers{n} c LEFT JOIN (
    SELECT cluster, d, avg(v) AS v FROM coords JOIN assigned{n} USING (vec_id) GROUP BY ALL) m USING (cluster, d))"""


VECTOR_CLUSTERS = (
    f"""
coords AS MATERIALIZED (
  SELECT vec_id, unnest(range(len(embedding))) AS d, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
centers0 AS MATERIALIZED (
  SELECT CAST(r - 1 AS INTEGER) AS cluster, d, v
  FROM coords JOIN (SELECT vec_id, row_number() OVER (ORDER BY md5('{SEED}#' || vec_id)) AS r FROM embeddings) USING (vec_id)
  WHERE r <= {CENTERS})""",
    *(center_round(n) for n in range(ROUNDS + 1)),
)


def draw_round(n: int) -> str:
    """Candidates after round ``n``: rows drawn by their share of the cost are added to those before."""
    uniform = f"""((CAST(CAST('0x' || substr(md5('{SEED}#{n}#' || vec_id), 1, 13) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE))
      / CAST(4503599627370496 AS DOUBLE))"""
    return f"""
drawn{n} AS MATERIALIZED (
  SELECT vec, drawn, v FROM drawn{n - 1}
  UNION ALL
  SELECT vec_id, {n}, v FROM whole JOIN (SELECT vec_id, min(dist) AS dist FROM far{n - 1} GROUP BY vec_id) USING (vec_id)
  WHERE {uniform} < dist * CAST({2.0 * CENTERS} AS DOUBLE) / (SELECT sum(dist) FROM (SELECT min(dist) AS dist FROM far{n - 1} GROUP BY vec_id))),
far{n} AS MATERIALIZED (
  SELECT w.vec_id, d.vec, list_sum(list_transform(list_zip(w.v, d.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS dist FROM whole w, drawn{n} d)"""


CANDIDATES = (
    f"""
whole AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
drawn0 AS MATERIALIZED (SELECT vec_id AS vec, 0 AS drawn, v FROM whole ORDER BY md5('{SEED}#' || vec_id) LIMIT 1),
far0 AS MATERIALIZED (
  SELECT w.vec_id, d.vec, list_sum(list_transform(list_zip(w.v, d.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS dist FROM whole w, drawn0 d)""",
    draw_round(1),
    draw_round(2),
)


def with_(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{','.join(parts)}\n"


FORUM = (QUESTIONS, POINTS, DRAWS)


def oracle_sql() -> dict[str, str]:
    return {
        "word_counts_by_source": with_(WORDS) + "SELECT word, source, count(*) AS n FROM words GROUP BY ALL",
        "stopword_filtered_counts": with_(WORDS, STOP, PAIRED) + "SELECT word, n0, n1 FROM paired",
        "common_word_counts": with_(WORDS, STOP, PAIRED)
        + "SELECT word, least(n0, n1) AS count FROM paired WHERE least(n0, n1) > 0",
        "written_word_counts": with_(WORDS, STOP, PAIRED)
        + "SELECT word || chr(9) || n0 || ',' || n1 AS line FROM paired",
        "csv_texts": "SELECT p_name AS text FROM part",
        "parsed_ratings": with_(ENTRIES) + 'SELECT "user", item, score FROM ratings',
        "kept_ratings": with_(ENTRIES) + 'SELECT "user", item, score FROM ratings',
        "rejected_lines": """SELECT o_custkey || ',' || o_orderpriority || ',' || o_orderkey AS value, 'item' AS reason FROM orders
UNION ALL SELECT c_name || ',' || c_custkey || ',' || c_nationkey, 'user' FROM customer
UNION ALL SELECT s_suppkey || ',' || s_nationkey, 'score' FROM supplier""",
        "parsed_postings": with_(QUESTIONS)
        + """SELECT 1 AS posting_type, id, CAST(-1 AS INTEGER) AS parent_id, score, tags, false AS has_parent FROM questions
UNION ALL SELECT 2, CAST(l_partkey AS INTEGER), CAST(l_orderkey AS INTEGER),
                 CAST(floor(l_extendedprice / 100) - 500 AS INTEGER), NULL, true FROM lineitem""",
        "stop_file_counts": with_(WORDS)
        + """SELECT word, count(*) FILTER (source = 0) AS n0, count(*) FILTER (source = 1) AS n1 FROM words
WHERE word NOT IN (SELECT word FROM words WHERE source = 1 AND regexp_matches(word, '^[ad]')) GROUP BY word""",
        "ordered_recommendations": with_(ENTRIES, MATRIX, PREDICTED)
        + """SELECT "user" || chr(9) || item || ',' || CAST(score AS BIGINT) AS line,
       row_number() OVER (ORDER BY "user" || ',' || item) AS place
FROM predicted p WHERE NOT EXISTS (SELECT 1 FROM entries e WHERE e."user" = p."user" AND e.item = p.item)""",
        "top_common_words": with_(WORDS, STOP, PAIRED)
        + """SELECT least(n0, n1) AS count, word FROM paired
WHERE least(n0, n1) > 0 ORDER BY count DESC, word LIMIT 20""",
        "user_score_vectors": with_(line_ratings("l_partkey * 5003"))
        + """SELECT "user", CAST((rank - 1) // 64 AS BIGINT) AS block,
       string_agg(item || ':' || score || ':' || n, ',' ORDER BY item, score) AS scores
FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY item, score) AS rank
      FROM (SELECT "user", item, score, count(*) AS n FROM ratings GROUP BY ALL))
GROUP BY ALL""",
        "part_co_occurrence": with_(line_ratings("l_partkey * 5003"), MATRIX) + "SELECT item1, item2, n FROM matrix",
        "supplier_scores": with_(line_ratings("l_suppkey"), MATRIX, PREDICTED)
        + 'SELECT "user", item, score FROM predicted',
        "supplier_recommendations": with_(line_ratings("l_suppkey"), MATRIX, PREDICTED)
        + """SELECT "user", item, score FROM predicted p
WHERE NOT EXISTS (SELECT 1 FROM entries e WHERE e."user" = p."user" AND e.item = p.item)""",
        "co_occurrence": with_(ENTRIES, MATRIX) + "SELECT item1, item2, n FROM matrix",
        "score_products": with_(ENTRIES, MATRIX)
        + """SELECT e."user", e.item AS via, m.item2 AS item, e.score * m.n AS product
FROM entries e JOIN matrix m ON e.item = m.item1""",
        "predicted_scores": with_(ENTRIES, MATRIX, PREDICTED) + 'SELECT "user", item, score FROM predicted',
        "recommend": with_(ENTRIES, MATRIX, PREDICTED)
        + """SELECT "user", item, score FROM predicted p
WHERE NOT EXISTS (SELECT 1 FROM entries e WHERE e."user" = p."user" AND e.item = p.item)""",
        "scored_questions": with_(QUESTIONS) + "SELECT id, tags, score, best FROM scored",
        "domain_points": with_(QUESTIONS, POINTS) + "SELECT id, x, y FROM points",
        "sample_centroids": with_(*FORUM) + "SELECT cluster, cx, cy FROM draws",
        "nearest_centroid": with_(*FORUM) + located("points", "draws", "p.id, p.x, p.y"),
        "lloyd_step": with_(*FORUM)
        + f"{MEANS} FROM ({located('weighted', 'draws', 'p.x, p.y, p.w')}) GROUP BY cluster",
        "centroid_shift": with_(*FORUM)
        + f"""SELECT sum({squared("d.cx - m.cx", "d.cy - m.cy")}) AS shift
FROM draws d
  JOIN ({MEANS} FROM ({located("weighted", "draws", "p.x, p.y, p.w")}) GROUP BY cluster) m USING (cluster)""",
        "lloyd_kmeans": with_(*FORUM, LLOYD, recursive=True) + "SELECT cluster, cx, cy FROM final",
        "cluster_report": with_(*FORUM, LLOYD, recursive=True)
        + f"""SELECT cluster, any_value(c.cx) AS cx, any_value(c.cy) AS cy,
       any_value(CASE WHEN c.cx // {SPREAD} >= 0 THEN [{quoted(DOMAINS)}][CAST(c.cx // {SPREAD} AS INTEGER) + 1] END)
         AS domain,
       count(*) AS size, CAST(trunc(quantile_cont(y, 0.5)) AS BIGINT) AS median,
       CAST(sum(y) AS BIGINT) // count(*) AS avg
FROM ({located("points", "final", "p.id, p.x, p.y")}) JOIN final c USING (cluster) GROUP BY cluster""",
        "clean_tokens": with_(TOKENS)
        + "SELECT doc_id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM cleaned",
        "w2v_vocabulary": with_(TOKENS)
        + """SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM cleaned)
GROUP BY token HAVING count(*) >= 5""",
        "embed_texts": with_(TOKENS, *WORD_VECTORS)
        + f"""SELECT doc_id, {MEANS_OF_TEXTS}
FROM (SELECT doc_id, len(tokens) AS n, unnest(CASE WHEN len(tokens) = 0 THEN [NULL] ELSE tokens END) AS token FROM cleaned)
  LEFT JOIN words{VECTORS["steps"]} USING (token) GROUP BY doc_id""",
        "cluster_vectors": with_(*VECTOR_CLUSTERS)
        + f"""SELECT cluster, coalesce(size, 0) AS size, CAST(d AS INTEGER) AS dim, round(v, 6) + 0.0 AS value
FROM centers{ROUNDS} LEFT JOIN (SELECT cluster, count(*) AS size FROM assigned{ROUNDS} GROUP BY cluster) USING (cluster)""",
        "vector_assignments": with_(*VECTOR_CLUSTERS) + f"SELECT vec_id, cluster AS predicted_cluster FROM assigned{ROUNDS}",
        "silhouette": SILHOUETTE + f"SELECT round(avg({ROW_SILHOUETTE}), 9) AS silhouette FROM ab",
        "row_silhouettes": SILHOUETTE + f"SELECT vec_id, round({ROW_SILHOUETTE}, 9) AS silhouette FROM ab",
        "kmeans_candidates": with_(*CANDIDATES)
        + """SELECT CAST(drawn AS BIGINT) AS drawn, count(*) AS weight, round(any_value(v0), 6) + 0.0 AS v0, round(any_value(v1), 6) + 0.0 AS v1
FROM (SELECT vec_id, arg_min(c.vec, row(dist, c.drawn, c.v)) AS vec FROM far2 JOIN drawn2 c ON c.vec = far2.vec GROUP BY vec_id)
  JOIN (SELECT vec, drawn, v[1] AS v0, v[2] AS v1 FROM drawn2) USING (vec) GROUP BY vec, drawn""",
        "part_medians": """SELECT l_partkey, count(*) AS size, median(CAST(round(l_extendedprice * 100) AS BIGINT)) AS median
FROM lineitem GROUP BY l_partkey""",
        "latest_ratings": with_(LATEST) + 'SELECT "user", item, score, n FROM entries',
        "latest_recommendations": with_(LATEST, MATRIX, PREDICTED)
        + """SELECT "user", item, score FROM predicted p
WHERE NOT EXISTS (SELECT 1 FROM entries e WHERE e."user" = p."user" AND e.item = p.item)""",
    }
