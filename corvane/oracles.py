"""SQL texts that compute the registered queries on one machine, for checking.

Scores are rounded on both sides: sums in another order differ in the last bits.
"""

from __future__ import annotations

TERM = "the"
TARGET = 200.005


# In the text, fixed values: the patterns of a tag, of a written-out line break and of what separates words.
def _words(title: str, text: str, table: str) -> str:
    return f"""
words AS (
  SELECT {title} AS title, unnest(string_split(trim(regexp_replace(replace(lower(
    regexp_replace({text}, '[<](.*?)[>]', ' ', 'g')), '\\n', ' '), '[^\\p{{L}}]+', ' ', 'g')), ' ')) AS word
  FROM {table}),
tf AS (SELECT word, title, count(*) AS tf FROM words WHERE word <> '' GROUP BY ALL)"""


DOCUMENTS = f"""WITH {_words("CAST(doc_id AS VARCHAR)", "text", "documents")},
df AS (SELECT word, count(*) AS df FROM tf GROUP BY ALL),
n AS (SELECT count(DISTINCT doc_id) AS n FROM documents)
"""

SCORED = "FROM tf JOIN df USING (word) CROSS JOIN n"

TRADE = """WITH sold AS (
  SELECT 'c' || o_custkey AS c, 'p' || l_partkey AS p, 's' || l_suppkey AS s, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
arcs AS (
  SELECT c AS src, p AS dst FROM sold
  UNION ALL SELECT 'p' || l_partkey, 's' || l_suppkey FROM lineitem
  UNION ALL SELECT s, c FROM sold WHERE l_suppkey % 2 = 0),
mapping AS (
  SELECT 'c' || c_custkey AS id, c_name AS title FROM customer
  UNION ALL SELECT 'p' || p_partkey, p_name || ' #' || p_partkey FROM part
  UNION ALL SELECT 's' || s_suppkey, s_name FROM supplier)"""

PAGES = """WITH arcs AS (
  SELECT url AS src, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst FROM pages),
mapping AS (SELECT url AS id, url AS title FROM pages)"""

NODES = """,
nodes AS (SELECT id FROM mapping UNION SELECT src FROM arcs UNION SELECT dst FROM arcs),
outs AS (SELECT src AS id, count(*) AS k, list_sort(list(dst)) AS neighbors FROM arcs GROUP BY src),
ins AS (SELECT dst AS id, count(*) AS k, list_sort(list(src)) AS linked_from FROM arcs GROUP BY dst),
dangling AS (SELECT id FROM nodes WHERE id NOT IN (SELECT src FROM arcs))
"""

# A small limit, so that lists of the sample tables have several parts.
SHORT_LIST = 7


def _cut(max_list: int) -> str:
    """The sorted lists cut by position: ``out_parts`` and ``in_parts``."""
    runs = f"CAST((row_number() OVER (PARTITION BY {{0}} ORDER BY {{1}}) - 1) // {max_list} AS INTEGER) AS part"
    return f""",
out_parts AS (SELECT id, part, list_sort(list(dst)) AS neighbors
  FROM (SELECT src AS id, dst, {runs.format("src", "dst")} FROM arcs) GROUP BY ALL),
in_parts AS (SELECT id, part, list_sort(list(src)) AS linked_from
  FROM (SELECT dst AS id, src, {runs.format("dst", "src")} FROM arcs) GROUP BY ALL)
"""


LISTS = NODES.rstrip() + _cut(10_000)
SHORT_LISTS = NODES.rstrip() + _cut(SHORT_LIST)
BOTH = """SELECT id, coalesce(part, 0) AS part, coalesce(outs.k, 0) AS out_degree, coalesce(ins.k, 0) AS in_degree,
  l.neighbors, l.linked_from
FROM nodes LEFT JOIN (SELECT * FROM out_parts FULL JOIN in_parts USING (id, part)) l USING (id)
LEFT JOIN outs USING (id) LEFT JOIN ins USING (id)"""


def _iterated(graph: str, iterations: int) -> str:
    """The graph and ``iterations`` rounds of ranks, r0 to the last."""
    parts = [
        graph + NODES.rstrip() + ",",
        "links AS MATERIALIZED (SELECT src, dst, k FROM arcs JOIN outs ON src = id),",
        "size AS (SELECT count(*) AS n FROM nodes),",
        "r0 AS MATERIALIZED (SELECT id, CAST(1 AS DOUBLE) AS rank FROM nodes)",
    ]
    for i in range(iterations):
        parts.append(f""", r{i + 1} AS MATERIALIZED (
  SELECT nodes.id, 0.15e0 + 0.85e0 * (coalesce(c, 0) + coalesce(m, 0) / n) AS rank
  FROM nodes
  LEFT JOIN (SELECT dst, sum(rank / k) AS c FROM links JOIN r{i} ON src = id GROUP BY dst) ON dst = nodes.id
  CROSS JOIN (SELECT sum(rank) AS m FROM r{i} JOIN dangling USING (id)) CROSS JOIN size)""")
    return "\n".join(parts) + "\n"


SECTIONS = """WITH rows AS (
  SELECT event_type AS test_id, CAST(floor(epoch(ts) / 3600) AS INTEGER) AS minute,
    CAST(user_id AS VARCHAR) AS node, value AS rps FROM events),
totals AS (SELECT test_id, minute, sum(rps) AS total_rps FROM rows GROUP BY ALL)
"""

# Tests by number, in the order of their names.
NUMBERED = """, numbers AS (SELECT test_id, CAST(row_number() OVER (ORDER BY test_id) AS VARCHAR) AS test FROM (SELECT DISTINCT test_id FROM rows))
"""


def _degrees(graph: str) -> str:
    return graph + NODES + """SELECT nodes.id, coalesce(outs.k, 0) AS out_degree, coalesce(ins.k, 0) AS in_degree
FROM nodes LEFT JOIN outs USING (id) LEFT JOIN ins USING (id)"""


def _dangling_with_inlinks(graph: str) -> str:
    return graph + LISTS + "SELECT id, part, linked_from FROM in_parts SEMI JOIN dangling USING (id)"


def oracle_sql() -> dict[str, str]:
    ten = _iterated(TRADE, 10)
    return {
        "clean_tokens": f"""WITH {_words("url", "html", "pages")} SELECT title, word, tf AS cnt FROM tf""",
        "corpus_size": "SELECT count(DISTINCT doc_id) AS n FROM documents",
        "term_frequency": DOCUMENTS + "SELECT word, title, tf FROM tf",
        "document_frequency": DOCUMENTS + "SELECT word, df FROM df",
        "idf": DOCUMENTS + f"SELECT word, title, round(ln(n / df), 6) AS idf {SCORED}",
        "tfidf": DOCUMENTS + f"SELECT word, title, tf, df, round(tf * ln(n / df), 6) AS tfidf {SCORED}",
        "tfidf_search": DOCUMENTS
        + f"SELECT title, round(tf * ln(n / df), 6) AS tfidf {SCORED} WHERE word = '{TERM}'",
        "tfidf_topk": DOCUMENTS
        + f"""SELECT title, round(tf * ln(n / df), 6) AS tfidf {SCORED} WHERE word = '{TERM}'
ORDER BY tf DESC, title LIMIT 100""",
        "tfidf_of_index": DOCUMENTS
        + f"SELECT title, round(tf * ln(n / df), 6) AS tfidf {SCORED} WHERE word = '{TERM}'",
        "tfidf_top_titles": DOCUMENTS + f"""SELECT word, title, round(tf * ln(n / df), 6) AS tfidf, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY word ORDER BY tf DESC, title) AS INTEGER) AS rank {SCORED}) WHERE rank <= 100""",
        "tfidf_added": f"""WITH {_words("CAST(conv_id AS VARCHAR)", "coalesce(text, '')", "conversations")},
df AS (SELECT word, count(*) AS df FROM tf GROUP BY ALL),
n AS (SELECT count(DISTINCT conv_id) AS n FROM conversations)
SELECT word, title, tf, df, round(tf * ln(n / df), 6) AS tfidf {SCORED}""",
        "published_degrees": _degrees(TRADE),
        "pagerank_progress": ten + " UNION ALL ".join(
            f"""SELECT {i} AS iteration, round((SELECT sum(rank) FROM r{i}), 6) AS mass,
  round((SELECT sum(rank) FROM r{i} JOIN dangling USING (id)), 6) AS dangling,
  round((SELECT max(abs(r{i}.rank - r{i - 1}.rank)) FROM r{i} JOIN r{i - 1} USING (id)), 6) AS change"""
            for i in range(1, 11)),
        "link_graph": PAGES + " SELECT src, dst FROM arcs",
        "adjacency": TRADE + LISTS + "SELECT id, part, neighbors FROM out_parts",
        "adjacency_parts": TRADE + SHORT_LISTS + "SELECT id, part, neighbors FROM out_parts",
        "reverse_adjacency": TRADE + LISTS + "SELECT id, part, linked_from FROM in_parts",
        "degrees": _degrees(TRADE),
        "degrees_pages": _degrees(PAGES),
        "dangling_nodes": TRADE + NODES + "SELECT id FROM dangling",
        "dangling_with_inlinks": _dangling_with_inlinks(TRADE),
        "dangling_with_inlinks_pages": _dangling_with_inlinks(PAGES),
        "adjacency_with_dangling": TRADE + LISTS
        + "SELECT id, part, neighbors FROM out_parts UNION ALL SELECT id, 0, NULL FROM dangling",
        "adjacency_both": TRADE + LISTS + BOTH,
        "adjacency_both_parts": TRADE + SHORT_LISTS + BOTH,
        "initial_ranks": TRADE + NODES + "SELECT id, CAST(1 AS DOUBLE) AS rank FROM nodes",
        "rank_contributions": TRADE + NODES + """SELECT dst AS id, round(sum(1 / k), 6) AS contribution
FROM arcs JOIN outs ON src = outs.id GROUP BY dst""",
        "dangling_mass": TRADE + NODES + "SELECT CAST(count(*) AS DOUBLE) AS mass FROM dangling",
        "pagerank_step": _iterated(TRADE, 1) + "SELECT id, round(rank, 6) AS rank FROM r1",
        "pagerank": ten + "SELECT id, round(rank, 6) AS rank FROM r10",
        "pagerank_pages": _iterated(PAGES, 10) + "SELECT id, round(rank, 6) AS rank FROM r10",
        "pagerank_topk": ten + """SELECT coalesce(title, id) AS title, round(rank, 6) AS pagerank
FROM r10 LEFT JOIN mapping USING (id) ORDER BY pagerank DESC, title LIMIT 100""",
        "file_lines": """SELECT 'corpus' AS file, count(*) AS lines, count(*) FILTER (coalesce(text, '') = '') AS rejected FROM documents
UNION ALL SELECT 'arcs', 3 * count(*), CAST(sum(CASE WHEN l_suppkey % 2 = 0 THEN 0 ELSE 1 END) AS BIGINT) FROM lineitem
UNION ALL SELECT 'nodes', (SELECT count(*) FROM customer) + (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier), 0""",
        "file_terms": f"""WITH {_words("'Document ' || doc_id", "text", "documents")} SELECT word, title, tf FROM tf""",
        "file_degrees": _degrees(TRADE),
        "log_rows": SECTIONS + NUMBERED + "SELECT test AS test_id, minute, node, rps FROM rows JOIN numbers USING (test_id)",
        "log_report": SECTIONS + NUMBERED + f"""SELECT test AS test_id, round(arg_max(total_rps, minute), 6) AS total_rps,
  min(minute) FILTER (total_rps >= {TARGET}) AS first_minute
FROM totals JOIN numbers USING (test_id) GROUP BY test""",
        "rps_rows": SECTIONS + "SELECT test_id, minute, node, rps FROM rows",
        "rps_per_minute": SECTIONS + "SELECT test_id, minute, round(total_rps, 6) AS total_rps FROM totals",
        "rps_latest": SECTIONS
        + "SELECT test_id, round(arg_max(total_rps, minute), 6) AS total_rps FROM totals GROUP BY test_id",
        "rps_target": SECTIONS + f"""SELECT test_id, min(minute) AS first_minute
FROM totals WHERE total_rps >= {TARGET} GROUP BY test_id""",
        "rps_watch_latest": SECTIONS
        + "SELECT test_id, round(arg_max(total_rps, minute), 6) AS total_rps FROM totals GROUP BY test_id",
        "rps_watch_target": SECTIONS + f"""SELECT test_id, min(minute) AS first_minute FROM totals
WHERE total_rps >= {TARGET} AND 3600 * (minute + 1) <= (SELECT epoch(max(ts)) - 600 FROM events) GROUP BY test_id""",
        "rps_stream": """WITH windows AS (
  SELECT event_type AS test_id, date_trunc('minute', ts) AS window_start, sum(value) AS total_rps
  FROM events GROUP BY ALL)
SELECT test_id, window_start, round(total_rps, 6) AS total_rps FROM windows
WHERE window_start + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
    }
