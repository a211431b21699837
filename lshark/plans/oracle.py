"""SQL fragments for the DuckDB oracle: the same semantics written as plain
ANSI SQL so every Spark query has an independent twin."""

from __future__ import annotations

from lshark.functions.minhash import HASH_PRIME, MinHashModel


def hash_sql(model: MinHashModel, t: int, item: str = "i") -> str:
    a, b = model.coeffs[t]
    m = f"(({item} % {HASH_PRIME}) + {HASH_PRIME}) % {HASH_PRIME}"
    return f"(((1 + {m}) % {HASH_PRIME}) * {a} + {b}) % {HASH_PRIME}"


def sig_long(model: MinHashModel, src: str) -> str:
    """``(u, tb, hv)`` rows: one ``UNION ALL`` branch per table."""
    return " UNION ALL ".join(
        f"SELECT u, CAST({t} AS INTEGER) AS tb, min({hash_sql(model, t)}) AS hv FROM {src} GROUP BY u"
        for t in range(model.num_tables))


def sig_wide(model: MinHashModel, src: str) -> str:
    hs = ", ".join(f"min({hash_sql(model, t)}) AS h{t}" for t in range(model.num_tables))
    return f"SELECT u, CAST(count(*) AS BIGINT) AS n, {hs} FROM {src} GROUP BY u"


def lsh_cte(model: MinHashModel, src: str, threshold: float | None = None,
            src_b: str | None = None) -> str:
    """CTEs ``sz``/``sig`` (and ``szb``/``sigb``), ``cand``, ``ov``, ``sim0``,
    ``sim`` over distinct ``(u, i)`` relations.  Self join unless ``src_b``.
    No size bound or other filter of the Spark side is repeated here."""
    other = src_b or src
    order = "" if src_b else " AND x.u < y.u"
    where = "" if threshold is None else f" WHERE 1.0 - sim < {threshold!r}"
    two = ""
    if src_b:
        two = f""",
szb AS (SELECT u, count(*) AS n FROM {src_b} GROUP BY u),
sigb AS (SELECT s.u, s.tb, s.hv, z.n FROM ({sig_long(model, src_b)}) s JOIN szb z ON z.u = s.u)"""
    return f"""
sz AS (SELECT u, count(*) AS n FROM {src} GROUP BY u),
sig AS (SELECT s.u, s.tb, s.hv, z.n FROM ({sig_long(model, src)}) s JOIN sz z ON z.u = s.u){two},
cand AS (SELECT DISTINCT x.u AS a, y.u AS b FROM sig x JOIN {'sigb' if src_b else 'sig'} y
         ON x.tb = y.tb AND x.hv = y.hv{order}),
ov AS (SELECT c.a, c.b, count(*) AS inter FROM cand c
       JOIN {src} pa ON pa.u = c.a JOIN {other} pb ON pb.u = c.b AND pb.i = pa.i
       GROUP BY c.a, c.b),
sim0 AS (SELECT o.a, o.b, CAST(o.inter AS BIGINT) AS inter, CAST(za.n AS BIGINT) AS n_a,
                CAST(zb.n AS BIGINT) AS n_b,
                CAST(o.inter AS DOUBLE) / CAST(za.n + zb.n - o.inter AS DOUBLE) AS sim
         FROM ov o JOIN sz za ON za.u = o.a JOIN {'szb' if src_b else 'sz'} zb ON zb.u = o.b),
sim AS (SELECT * FROM sim0{where})"""


def exact_cte(src: str, threshold: float) -> str:
    """CTEs ``sz``, ``eov``, ``exact``: every pair under the threshold."""
    return f"""
sz AS (SELECT u, count(*) AS n FROM {src} GROUP BY u),
eov AS (SELECT x.u AS a, y.u AS b, count(*) AS inter FROM {src} x JOIN {src} y
        ON x.i = y.i AND x.u < y.u GROUP BY x.u, y.u),
exact AS (SELECT * FROM (SELECT o.a, o.b, CAST(o.inter AS BIGINT) AS inter, CAST(za.n AS BIGINT) AS n_a,
                 CAST(zb.n AS BIGINT) AS n_b,
                 CAST(o.inter AS DOUBLE) / CAST(za.n + zb.n - o.inter AS DOUBLE) AS sim
          FROM eov o JOIN sz za ON za.u = o.a JOIN sz zb ON zb.u = o.b) WHERE 1.0 - sim < {threshold!r})"""


def neighbors_cte(k: int) -> str:
    return f"""
both_dir AS (SELECT a AS u, b AS v, sim FROM sim UNION ALL SELECT b AS u, a AS v, sim FROM sim),
nb AS (SELECT u, v, sim, rn AS rank FROM (SELECT *, row_number() OVER
       (PARTITION BY u ORDER BY sim DESC, v) AS rn FROM both_dir) WHERE rn <= {k})"""


def scores_cte(src: str, decimals: int = 6) -> str:
    return f"""
sc AS (SELECT nb.u, p.i, round(sum(nb.sim), {decimals}) AS score FROM nb JOIN {src} p ON p.u = nb.v
       GROUP BY nb.u, p.i),
unseen AS (SELECT * FROM sc WHERE NOT EXISTS
           (SELECT 1 FROM {src} p WHERE p.u = sc.u AND p.i = sc.i))"""


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"
