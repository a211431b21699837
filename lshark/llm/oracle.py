"""DuckDB twins of the operators that SQL can express.

They are written from the queries' contracts, not from the operators: windows
are compared as whole strings, pairs are formed outright and groups are closed
by recursion.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _closure(edges: str, nodes: str, node: str) -> str:
    """``cls(node, low)``: smallest node reachable over both directions of ``edges(a, b)``."""
    return (f"step AS (SELECT a, b FROM {edges} UNION SELECT b, a FROM {edges}), "
            f"reach AS (SELECT DISTINCT a AS x, a AS y FROM step UNION SELECT reach.x, step.b FROM reach "
            f"JOIN step ON step.a = reach.y), "
            f"low AS (SELECT x, min(y) AS low FROM reach GROUP BY x), "
            f"cls AS (SELECT n.{node} AS node, coalesce(low.low, n.{node}) AS low FROM {nodes} n LEFT JOIN low ON low.x = n.{node})")


def op4_sql() -> str:
    shingle = ("SELECT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s, count(*) AS c FROM "
               "(SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0) GROUP BY ALL")
    return (f"WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents), sh AS MATERIALIZED ({shingle}), "
            "size AS (SELECT doc_id, sum(c) AS n FROM sh GROUP BY doc_id), "
            "inter AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.c, y.c)) AS m FROM sh x JOIN sh y "
            "ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL), "
            "link AS (SELECT a, b FROM inter JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b "
            "WHERE m >= 0.8 * (p.n + q.n - m)), "
            f"{_closure('link', 'documents', 'doc_id')} "
            "SELECT node AS doc_id, low AS class_id, node = low AS kept FROM cls")


def op5_sql() -> str:
    return ("WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings "
            "WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0), "
            "s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score "
            "FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id), "
            "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) "
            "SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5")


def op7_sql() -> str:
    return ("WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages), "
            "f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d) "
            "SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest, "
            "CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type, "
            "CASE WHEN first <> page_id THEN first END AS refers_to FROM p LEFT JOIN f ON f.d = p.d")


def op8_sql() -> str:
    return (f"WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents), "
            "win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS s FROM "
            "(SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words)), "
            "later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k "
            "FROM win) WHERE k > 1), "
            "gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later), "
            "each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words), "
            "kept AS (SELECT e.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY e.i) AS t FROM each e "
            "ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id) "
            "SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, "
            "sha256(coalesce(t, '')) AS kept_sha256 FROM words LEFT JOIN kept ON kept.doc_id = words.doc_id")


def op9_sql() -> str:
    return ("WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e "
            "FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND "
            "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 "
            "AND len(list_filter(embedding, lambda x: x <> 0)) > 0), "
            "link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id "
            "AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.93), "
            f"{_closure('link', 'embeddings', 'vec_id')}, "
            "n AS (SELECT a, count(*) AS n FROM step GROUP BY a) "
            "SELECT node AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, low AS component_id, node = low AS kept "
            "FROM cls LEFT JOIN n ON n.a = node")


def op10_sql() -> str:
    return ("WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents), "
            "win AS MATERIALIZED (SELECT doc_id, i, md5(substr(x, 2 * i - 1, 400)) AS s FROM "
            "(SELECT doc_id, x, unnest(range(1, CAST(len(x) / 2 - 198 AS BIGINT))) AS i FROM raw)), "
            "twice AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1), "
            "hit AS (SELECT doc_id, i FROM win SEMI JOIN twice ON twice.s = win.s), "
            "run AS (SELECT doc_id, min(i) AS lo, max(i) + 199 AS hi FROM (SELECT doc_id, i, sum(fresh) OVER "
            "(PARTITION BY doc_id ORDER BY i) AS g FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER "
            "(PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh FROM hit)) GROUP BY doc_id, g), "
            "gap AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM run), "
            "part AS (SELECT gap.doc_id, lo, substr(x, 2 * before + 1, 2 * (lo - before - 1)) AS p FROM gap "
            "JOIN raw ON raw.doc_id = gap.doc_id), "
            "done AS (SELECT doc_id, count(*) AS n, sum(hi - lo + 1) AS gone, max(hi) AS last FROM run GROUP BY doc_id), "
            "front AS (SELECT doc_id, string_agg(p, '' ORDER BY lo) AS p FROM part GROUP BY doc_id) "
            "SELECT raw.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, "
            "CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(front.p, '') || substr(x, 2 * coalesce(last, 0) + 1))) "
            "AS kept_sha256 FROM raw LEFT JOIN done ON done.doc_id = raw.doc_id LEFT JOIN front ON front.doc_id = raw.doc_id")


def op12_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return (f"WITH it AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark), "
            "win AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(list_slice(w, i, i + 9), ' ') AS s FROM "
            "(SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM it WHERE len(w) > 0)), "
            f"doc AS (SELECT doc_id, {words} AS w FROM documents), "
            "dw AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s FROM "
            "(SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM win))), "
            "hit AS (SELECT doc_id, dw.k, i, item FROM dw JOIN win ON win.s = dw.s AND win.k = dw.k), "
            "gone AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id), "
            "found AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS t FROM "
            "(SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id) "
            "SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_hit, "
            "CAST(coalesce(found.n, 0) AS BIGINT) AS n_items, sha256(coalesce(t, '')) AS items_sha256, "
            "coalesce(gone.n, 0) > 0 AS contaminated FROM doc LEFT JOIN gone ON gone.doc_id = doc.doc_id "
            "LEFT JOIN found ON found.doc_id = doc.doc_id")


ORACLE = {
    "op4_minhash_dedup": op4_sql,
    "op5_topk_search": op5_sql,
    "op7_warc": op7_sql,
    "op8_substring_dedup": op8_sql,
    "op9_embedding_dedup": op9_sql,
    "op10_suffix_dedup": op10_sql,
    "op12_decontamination": op12_sql,
}
