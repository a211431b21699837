"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the whole input tables; :func:`oracle` gives its DuckDB twin.

Parameters are fixed here and shared by both sides: seed 42, 5 hash tables,
10 neighbours, 5 recommendations, distance thresholds 0.6 (events, parts) and
0.2 (documents).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lshark.functions.minhash import fit
from lshark.operators import features, index, lsh, prep, recommend, text, topk
from lshark.plans import oracle as O
from lshark.session import cut_lineage, stage_path
from lshark.sources import tables

SEED = 42
TABLES = 5
K_NEIGHBORS = 10
N_ITEMS = 5
K_ITEMS = 5
EVENT_THRESHOLD = 0.6
PART_THRESHOLD = 0.6
DOC_THRESHOLD = 0.2
TWO_THRESHOLD = 0.8
SUBSET_FRACTION = 0.25
EVENT_TYPES = ("view", "click", "purchase")
MODEL = fit(TABLES, SEED)

# ------------------------------------------------------------------ inputs


def event_interactions(spark: SparkSession, base: str, types=None) -> DataFrame:
    """Interactions of all events; the flagship takes :data:`EVENT_TYPES` only."""
    ev = tables.load(spark, base, "events")
    where = None if types is None else F.col("event_type").isin(*types)
    return prep.interactions(ev, "user_id", prep.event_item(), where)


def _events_sql(name: str, types=None) -> str:
    cond = "" if types is None else "event_type IN (" + ", ".join(f"'{t}'" for t in types) + ") AND "
    return (f"{name} AS (SELECT DISTINCT CAST(user_id AS BIGINT) AS u, "
            f"CAST(json_extract_string(props, '$.k') AS BIGINT) AS i FROM events "
            f"WHERE {cond}user_id IS NOT NULL AND json_extract_string(props, '$.k') IS NOT NULL)")


UP = _events_sql("up")
UPF = _events_sql("up", EVENT_TYPES)


def purchases(spark: SparkSession, base: str, user: str, item: str) -> DataFrame:
    li = tables.load(spark, base, "lineitem").select("l_orderkey", "l_partkey")
    od = tables.load(spark, base, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(od, li.l_orderkey == od.o_orderkey)
    return prep.interactions(joined, user, item)


def _purchases_sql(name: str, user: str, item: str) -> str:
    return (f"{name} AS (SELECT DISTINCT CAST({user} AS BIGINT) AS u, CAST({item} AS BIGINT) AS i "
            f"FROM lineitem JOIN orders ON o_orderkey = l_orderkey "
            f"WHERE {user} IS NOT NULL AND {item} IS NOT NULL)")


def _sig_cols(sig: DataFrame, n: int = TABLES) -> DataFrame:
    return sig.select("u", "n", *[F.col("hashes")[t].alias(f"h{t}") for t in range(n)])


# ---------------------------------------------------------------- B1, B2

def q_interactions(spark, base):
    return event_interactions(spark, base)


def q_interactions_sql():
    return f"WITH {UP} SELECT u, i FROM up"


def q_entity_sets(spark, base):
    sets = prep.entity_sets(purchases(spark, base, "o_custkey", "l_partkey"))
    return sets.select("u", "n", "part", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


def q_entity_sets_sql():
    return (f"WITH {_purchases_sql('cp', 'o_custkey', 'l_partkey')} "
            f"SELECT u, CAST(count(*) AS BIGINT) AS n, 0 AS part, array_to_string(list_sort(list(i)), ',') AS items "
            f"FROM cp GROUP BY u")


# ---------------------------------------------------------------- D1-D4

def q_minhash_signature(spark, base):
    return _sig_cols(lsh.signatures(event_interactions(spark, base), MODEL))


def q_minhash_signature_sql():
    return f"WITH {UP} {O.sig_wide(MODEL, 'up')}"


def q_lsh_buckets(spark, base):
    return lsh.buckets(lsh.signatures(event_interactions(spark, base), MODEL))


def q_lsh_buckets_sql():
    return (f"WITH {UP}, sz AS (SELECT u, CAST(count(*) AS BIGINT) AS n FROM up GROUP BY u) "
            f"SELECT s.u, z.n, s.tb, s.hv FROM ({O.sig_long(MODEL, 'up')}) s JOIN sz z ON z.u = s.u")


def _buckets(inter):
    return cut_lineage(lsh.buckets(lsh.signatures(inter, MODEL), with_hashes=True), "buckets")


def q_lsh_candidates(spark, base):
    return lsh.candidates(_buckets(event_interactions(spark, base)))


def q_lsh_candidates_sql():
    return f"WITH {UP},{O.lsh_cte(MODEL, 'up')} SELECT a, b FROM cand"


# ---------------------------------------------------------------- D5, D8, D9

def q_similarity_join(spark, base):
    return lsh.similarity_join(event_interactions(spark, base), MODEL, EVENT_THRESHOLD)


def q_similarity_join_sql():
    return f"WITH {UP},{O.lsh_cte(MODEL, 'up', EVENT_THRESHOLD)} SELECT * FROM sim"


def q_similarity_join_two(spark, base):
    left = event_interactions(spark, base, ("view",))
    right = event_interactions(spark, base, ("purchase",))
    return lsh.similarity_join_two(left, right, MODEL, TWO_THRESHOLD)


def q_similarity_join_two_sql():
    return (f"WITH {_events_sql('lv', ('view',))}, {_events_sql('rp', ('purchase',))},"
            f"{O.lsh_cte(MODEL, 'lv', TWO_THRESHOLD, src_b='rp')} SELECT * FROM sim")


def q_exact_jaccard(spark, base):
    return lsh.exact_jaccard(event_interactions(spark, base), EVENT_THRESHOLD)


def q_exact_jaccard_sql():
    return f"WITH {UP},{O.exact_cte('up', EVENT_THRESHOLD)} SELECT * FROM exact"


def q_lsh_report(spark, base):
    inter = cut_lineage(event_interactions(spark, base), "interactions")
    approx = lsh.similarity_join(inter, MODEL, EVENT_THRESHOLD, materialize=False)
    exact = lsh.exact_jaccard(inter, EVENT_THRESHOLD, materialize=False)
    cands = lsh.candidates(_buckets(inter))
    n = inter.agg(F.countDistinct("u").alias("n"))
    return lsh.lsh_report(approx, exact, cands, n)


def q_lsh_report_sql():
    return (f"WITH {UP},{O.lsh_cte(MODEL, 'up', EVENT_THRESHOLD)},"
            f"true_ov AS (SELECT x.u AS a, y.u AS b, count(*) AS m FROM up x JOIN up y ON x.i = y.i AND x.u < y.u GROUP BY ALL),"
            f"exact AS (SELECT a, b FROM true_ov JOIN sz p ON p.u = a JOIN sz q ON q.u = b "
            f"WHERE 1.0 - m / (p.n + q.n - m) < {EVENT_THRESHOLD!r}),"
            f"c AS (SELECT (SELECT count(*) FROM exact) AS exact_pairs, (SELECT count(*) FROM sim) AS found_pairs, "
            f"(SELECT count(*) FROM exact SEMI JOIN sim USING (a, b)) AS true_pairs, "
            f"(SELECT count(*) FROM cand) AS candidate_pairs, "
            f"(SELECT CAST(n * (n - 1) / 2 AS BIGINT) FROM (SELECT count(DISTINCT u) AS n FROM up)) AS all_pairs) "
            f"SELECT exact_pairs, found_pairs, true_pairs, "
            f"round(CASE WHEN exact_pairs > 0 THEN true_pairs / exact_pairs END, 6) AS recall, "
            f"round(CASE WHEN found_pairs > 0 THEN true_pairs / found_pairs END, 6) AS precision, candidate_pairs, all_pairs, "
            f"round(candidate_pairs / all_pairs, 6) AS candidate_ratio FROM c")


# ---------------------------------------------------------------- D6, D7

def q_neighbors(spark, base):
    inter = cut_lineage(event_interactions(spark, base), "interactions")
    key = inter.agg(F.min("u")).first()[0]          # one scalar: the probe key
    return lsh.neighbors(inter, MODEL, key, K_NEIGHBORS)


def q_neighbors_sql():
    return (f"WITH {UP}, sz AS (SELECT u, count(*) AS n FROM up GROUP BY u), "
            f"sig AS ({O.sig_long(MODEL, 'up')}), key AS (SELECT min(u) AS k FROM up), "
            f"kb AS (SELECT s.tb, s.hv FROM sig s JOIN key ON s.u = key.k), "
            f"cand AS (SELECT DISTINCT s.u FROM sig s JOIN kb ON s.tb = kb.tb AND s.hv = kb.hv), "
            f"ov AS (SELECT p.u, count(*) AS inter FROM up p JOIN up q ON q.i = p.i "
            f"JOIN key ON q.u = key.k GROUP BY p.u), "
            f"r AS (SELECT key.k AS u, c.u AS v, CAST(ov.inter AS DOUBLE) / CAST(z.n + zk.n - ov.inter AS DOUBLE) "
            f"AS sim FROM cand c JOIN ov ON ov.u = c.u JOIN sz z ON z.u = c.u CROSS JOIN key "
            f"JOIN sz zk ON zk.u = key.k) "
            f"SELECT * FROM (SELECT u, v, sim, CAST(row_number() OVER (ORDER BY sim DESC, v) AS BIGINT) "
            f"AS rank FROM r) WHERE rank <= {K_NEIGHBORS}")


def q_index_neighbors(spark, base):
    """The same probe against a written bucket index: it reads one folder per table."""
    inter = cut_lineage(event_interactions(spark, base), "interactions")
    where = _scratch(spark, "bucket-index")
    index.write_index(inter, MODEL, where)
    key = inter.agg(F.min("u")).first()[0]
    return index.neighbors(spark, index.open_index(spark, where), key, K_NEIGHBORS)


def _neighbours(spark, base, types=None):
    # one written copy of the interactions feeds signatures, sets, CF scores
    # and the seen-item filter
    inter = cut_lineage(event_interactions(spark, base, types), "interactions")
    return inter, topk.nearest(inter, MODEL, K_NEIGHBORS, materialize=False)


def q_all_neighbors(spark, base):
    return _neighbours(spark, base)[1]


def _flag_cte(events=UP):
    return f"WITH {events},{O.lsh_cte(MODEL, 'up')},{O.neighbors_cte(K_NEIGHBORS)}"


def q_all_neighbors_sql():
    return f"{_flag_cte()} SELECT u, v, sim, CAST(rank AS BIGINT) AS rank FROM nb"


# ---------------------------------------------------------------- E1-E4

def _scores(spark, base):
    inter, neigh = _neighbours(spark, base)
    return inter, recommend.cf_scores(neigh, inter)


def q_cf_scores(spark, base):
    return _scores(spark, base)[1]


def q_cf_scores_sql():
    return f"{_flag_cte()},{O.scores_cte('up')} SELECT u, i, score FROM sc"


def q_exclude_seen(spark, base):
    inter, sc = _scores(spark, base)
    return recommend.exclude_seen(sc, inter)


def q_exclude_seen_sql():
    return f"{_flag_cte()},{O.scores_cte('up')} SELECT u, i, score FROM unseen"


def q_top_n(spark, base):
    return recommend.top_n(_scores(spark, base)[1], N_ITEMS)


def q_top_n_sql():
    return (f"{_flag_cte()},{O.scores_cte('up')} SELECT u, i, score, CAST(rank AS BIGINT) AS rank FROM "
            f"(SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, i) AS rank FROM sc) "
            f"WHERE rank <= {N_ITEMS}")


def user_recommendations(spark: SparkSession, base: str) -> DataFrame:
    """Flagship: top-5 unseen items per user from the 10 nearest LSH neighbours."""
    inter, neigh = _neighbours(spark, base, EVENT_TYPES)
    return recommend.recommend_from(neigh, inter, N_ITEMS)


def user_recommendations_sql() -> str:
    return (f"{_flag_cte(UPF)},{O.scores_cte('up')} SELECT u, i, score, CAST(rank AS BIGINT) AS rank FROM "
            f"(SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, i) AS rank FROM unseen) "
            f"WHERE rank <= {N_ITEMS}")


def q_unseen_scores(spark, base):
    """Scores of unseen items, seen ones dropped before the sum: as ``exclude_seen``."""
    inter, neigh = _neighbours(spark, base)
    return recommend.unseen_scores(neigh, inter)


def q_named_recommendations(spark, base):
    """The flagship over string keys: customers by name, parts by name."""
    li = tables.load(spark, base, "lineitem").select("l_orderkey", "l_partkey")
    od = tables.load(spark, base, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    cu = tables.load(spark, base, "customer").select("c_custkey", "c_name")
    pa = tables.load(spark, base, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    # rows that repeat a key go before they multiply in the next join
    bought = li.distinct().join(od.distinct(), "l_orderkey").select("c_custkey", "l_partkey").distinct()
    bought = bought.join(cu.distinct(), "c_custkey").join(pa.distinct(), "l_partkey")
    inter, users, items = prep.keyed_interactions(bought, "c_name", "p_name")
    inter = cut_lineage(inter, "interactions")
    found = recommend.recommend_from(topk.nearest(inter, MODEL, K_NEIGHBORS, materialize=False), inter, N_ITEMS)
    return prep.named(found, u=users, i=items)


def q_named_recommendations_sql():
    return (f"WITH b AS (SELECT DISTINCT c_name, p_name FROM lineitem JOIN orders ON o_orderkey = l_orderkey "
            f"JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey "
            f"WHERE c_name IS NOT NULL AND p_name IS NOT NULL), "
            f"num AS (SELECT *, dense_rank() OVER (ORDER BY c_name) - 1 AS u, dense_rank() OVER (ORDER BY p_name) - 1 AS i FROM b), "
            f"up AS (SELECT u, i FROM num),{O.lsh_cte(MODEL, 'up')},{O.neighbors_cte(K_NEIGHBORS)},{O.scores_cte('up')}, "
            f"best AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, i) AS rank FROM unseen) "
            f"SELECT c.c_name AS u, p.p_name AS i, score, CAST(rank AS BIGINT) AS rank FROM best "
            f"JOIN (SELECT DISTINCT u, c_name FROM num) c ON c.u = best.u JOIN (SELECT DISTINCT i, p_name FROM num) p ON p.i = best.i "
            f"WHERE rank <= {N_ITEMS}")


PART_ATTRS = ("p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def q_similar_items(spark, base):
    inter = purchases(spark, base, "l_partkey", "o_custkey")
    neigh = topk.nearest(inter, MODEL, K_ITEMS)
    attrs = tables.load(spark, base, "part").select("p_partkey", *PART_ATTRS)
    return recommend.with_attributes(neigh, attrs, "p_partkey")


def q_similar_items_sql():
    cols = ", ".join(f"p.{c}" for c in PART_ATTRS)
    return (f"WITH {_purchases_sql('pu', 'l_partkey', 'o_custkey')},{O.lsh_cte(MODEL, 'pu')},"
            f"{O.neighbors_cte(K_ITEMS)} SELECT nb.u, nb.v, nb.sim, CAST(nb.rank AS BIGINT) AS rank, {cols} "
            f"FROM nb JOIN part p ON p.p_partkey = nb.v")


# ---------------------------------------------------------------- C1-C3

def load_documents(spark, base, *cols):
    return tables.spread(tables.load(spark, base, "documents").select(*cols))


def q_element_index(spark, base):
    docs = load_documents(spark, base, "text")
    toks = docs.select(F.explode(text.tokens(F.col("text"))).alias("token"))
    idx = features.dense_index(toks, "token")
    return idx.select(F.col("value").alias("token"), "idx",
                      features.hashed_index(F.col("value")).alias("hidx"))


def q_element_index_sql():
    return ("WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS token "
            "FROM documents) SELECT token, CAST(dense_rank() OVER (ORDER BY token) - 1 AS BIGINT) AS idx, "
            "CAST('0x' || substr(md5(token), 1, 15) AS BIGINT) AS hidx FROM t")


def q_growing_index(spark, base):
    """The vocabulary of the benchmark, then that of the documents appended."""
    def words(df):
        return df.select(F.explode(text.tokens(F.col("text"))).alias("token"))

    old = cut_lineage(features.dense_index(words(tables.load(spark, base, "benchmark")), "token"), "vocabulary")
    return features.extend_index(old, words(load_documents(spark, base, "text")), "token").withColumnRenamed("value", "token")


def q_growing_index_sql():
    return ("WITH w1 AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS token FROM benchmark), "
            "w2 AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS token FROM documents), "
            "fresh AS (SELECT token FROM w2 ANTI JOIN w1 USING (token)) "
            "SELECT token, CAST(dense_rank() OVER (ORDER BY token) - 1 AS BIGINT) AS idx FROM w1 UNION ALL "
            "SELECT token, CAST((SELECT count(*) FROM w1) + dense_rank() OVER (ORDER BY token) - 1 AS BIGINT) AS idx FROM fresh")


PART_CATEGORICAL = ("p_brand", "p_type", "p_size")


def _part_vec(spark, base, numeric=("p_retailprice",)):
    part = tables.load(spark, base, "part")
    vec, dim = features.assemble(part, "p_partkey", list(PART_CATEGORICAL), list(numeric))
    return part, vec, dim


def _part_vec_sql(numeric: bool = True) -> str:
    ctes, parts, offs = [], [], []
    for n, c in enumerate(PART_CATEGORICAL):
        ctes.append(f"c{n} AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS r FROM "
                    f"(SELECT DISTINCT {c} AS v FROM part WHERE {c} IS NOT NULL)), "
                    f"k{n} AS (SELECT count(*) AS c FROM c{n})")
        off = " + ".join(["0"] + [f"(SELECT c FROM k{m})" for m in range(n)])
        parts.append(f"SELECT p.p_partkey AS id, CAST(c{n}.r + {off} AS BIGINT) AS idx, 1.0 AS val "
                     f"FROM part p JOIN c{n} ON c{n}.v = p.{c}")
        offs.append(f"(SELECT c FROM k{n})")
    if numeric:
        parts.append(f"SELECT p_partkey AS id, CAST({' + '.join(offs)} AS BIGINT) AS idx, p_retailprice AS val "
                     f"FROM part WHERE p_retailprice IS NOT NULL AND p_retailprice <> 0")
    return ", ".join(ctes) + ", vec AS (" + " UNION ALL ".join(parts) + ")"


def q_assembled_features(spark, base):
    return _part_vec(spark, base)[1]


def q_assembled_features_sql():
    return f"WITH {_part_vec_sql()} SELECT id, idx, val FROM vec"


def _scaled_sql(formula: str, numeric: bool = True) -> str:
    """Scaled cells over the dense table; ``formula`` uses the column's statistics."""
    return (f"WITH {_part_vec_sql(numeric)}, cells AS (SELECT p.p_partkey AS id, f.idx, coalesce(v.val, 0.0) AS val "
            f"FROM part p CROSS JOIN (SELECT DISTINCT idx FROM vec) f LEFT JOIN vec v ON v.id = p.p_partkey AND v.idx = f.idx), "
            f"st AS (SELECT idx, avg(val) AS mean, coalesce(stddev_samp(val), 0.0) AS sd, min(val) AS mn, max(val) AS mx, "
            f"max(abs(val)) AS ma FROM cells GROUP BY idx), "
            f"scaled AS (SELECT c.id, c.idx, round({formula}, 6) AS val FROM cells c JOIN st ON st.idx = c.idx) ")


_STD = "CASE WHEN sd <> 0 THEN val / sd ELSE 0.0 END"
_SCALED = "SELECT id, idx, val FROM scaled WHERE val <> 0"


def _scaled(spark, base, method):
    part, vec, dim = _part_vec(spark, base)
    ids = part.select(F.col("p_partkey").alias("id"))
    return features.scale(vec, part.count(), dim, method, for_minhash=False, ids=ids)


def q_scaled_features(spark, base):
    return _scaled(spark, base, "std")


def q_scaled_features_sql():
    return _scaled_sql(_STD) + _SCALED


def q_scaled_maxabs(spark, base):
    return _scaled(spark, base, "maxabs")


def q_scaled_maxabs_sql():
    return _scaled_sql("CASE WHEN ma <> 0 THEN val / ma ELSE 0.0 END") + _SCALED


def q_scaled_minmax(spark, base):
    return _scaled(spark, base, "minmax")


def q_scaled_minmax_sql():
    return _scaled_sql("CASE WHEN mx <> mn THEN (val - mn) / (mx - mn) ELSE 0.5 END") + _SCALED


def q_scaled_std_mean(spark, base):
    return _scaled(spark, base, "std_mean")


def q_scaled_std_mean_sql():
    return _scaled_sql("CASE WHEN sd <> 0 THEN (val - mean) / sd ELSE 0.0 END") + _SCALED


def q_feature_neighbors(spark, base):
    part, vec, dim = _part_vec(spark, base, numeric=())
    sets = features.nonzero_sets(features.scale(vec, part.count(), dim, "std"))
    return lsh.grouped_neighbors(sets, MODEL, PART_THRESHOLD, K_NEIGHBORS)


def q_feature_neighbors_sql():
    return (_scaled_sql(_STD, False) + ", pf AS (SELECT DISTINCT id AS u, idx AS i FROM scaled WHERE val <> 0), "
            + O.lsh_cte(MODEL, "pf", PART_THRESHOLD) + "," + O.neighbors_cte(K_NEIGHBORS)
            + " SELECT u, v, sim, CAST(rank AS BIGINT) AS rank FROM nb")


# ---------------------------------------------------------------- C4-C6

_TOK_SQL = "regexp_extract_all(lower(text), '\\p{L}+')"


def q_document_tokens(spark, base):
    docs = text.tokenize(load_documents(spark, base, "doc_id", "text"))
    return docs.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                       F.size(F.array_distinct("tokens")).cast("bigint").alias("n_distinct"),
                       F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


def q_document_tokens_sql():
    return (f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, CAST(len(list_distinct(t)) AS BIGINT) "
            f"AS n_distinct, md5(array_to_string(t, ' ')) AS tokens_md5 FROM "
            f"(SELECT doc_id, {_TOK_SQL} AS t FROM documents)")


def q_document_stopwords(spark, base):
    docs = load_documents(spark, base, "doc_id", "text")
    kept = docs.select("doc_id", text.remove_stopwords(text.tokens(F.col("text"))).alias("t"))
    return kept.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"),
                       F.md5(F.array_join("t", " ")).alias("tokens_md5"))


def q_document_stopwords_sql():
    words = O.sql_list(sorted(set(text.STOPWORDS)))
    return (f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 "
            f"FROM (SELECT doc_id, list_filter({_TOK_SQL}, lambda x: NOT list_contains({words}, x)) AS t "
            f"FROM documents)")


def q_document_dense_sets(spark, base):
    docs = text.tokenize(load_documents(spark, base, "doc_id", "text"))
    return text.dense_token_sets(docs, "doc_id")


def q_document_dense_sets_sql():
    return (f"WITH t AS (SELECT DISTINCT doc_id AS u, unnest({_TOK_SQL}) AS w FROM documents) "
            f"SELECT u, CAST(dense_rank() OVER (ORDER BY w) - 1 AS BIGINT) AS i FROM t")


def document_sets(spark, base):
    docs = text.tokenize(load_documents(spark, base, "doc_id", "text"))
    return text.token_sets(docs, "doc_id")


def q_document_near_copies(spark, base):
    return lsh.similarity_join(document_sets(spark, base), MODEL, DOC_THRESHOLD)


def q_document_near_copies_sql():
    # overlaps are counted on the words themselves; only signatures use their index
    words = f"(SELECT DISTINCT doc_id AS u, unnest({_TOK_SQL}) AS i FROM documents)"
    return (f"WITH dw AS {words}, di AS (SELECT u, CAST('0x' || substr(md5(i), 1, 15) AS BIGINT) AS i FROM dw),"
            f"{O.lsh_cte(MODEL, 'di', DOC_THRESHOLD)}, wn AS (SELECT u, count(*) AS n FROM dw GROUP BY u), "
            f"wo AS (SELECT c.a, c.b, count(*) AS m FROM cand c JOIN dw x ON x.u = c.a JOIN dw y ON y.u = c.b AND y.i = x.i "
            f"GROUP BY ALL) SELECT a, b, CAST(m AS BIGINT) AS inter, CAST(p.n AS BIGINT) AS n_a, CAST(q.n AS BIGINT) AS n_b, "
            f"CAST(m AS DOUBLE) / CAST(p.n + q.n - m AS DOUBLE) AS sim FROM wo JOIN wn p ON p.u = a JOIN wn q ON q.u = b "
            f"WHERE 1.0 - CAST(m AS DOUBLE) / CAST(p.n + q.n - m AS DOUBLE) < {DOC_THRESHOLD!r}")


COPIED_SOURCE = "src0"


def q_source_copies(spark, base):
    """Near copies of one source's documents in all other sources, by the prefix
    route of the two-table join."""
    docs = text.tokenize(load_documents(spark, base, "doc_id", "text", "source"))
    own = F.col("source") == COPIED_SOURCE
    return lsh.similarity_join_two(text.token_sets(docs.where(own), "doc_id"), text.token_sets(docs.where(~own), "doc_id"),
                                   MODEL, DOC_THRESHOLD)


def q_source_copies_sql():
    def sets(name, cond):
        return (f"{name} AS (SELECT u, CAST('0x' || substr(md5(w), 1, 15) AS BIGINT) AS i FROM "
                f"(SELECT DISTINCT doc_id AS u, unnest({_TOK_SQL}) AS w FROM documents WHERE source {cond} '{COPIED_SOURCE}'))")

    return (f"WITH {sets('own', '=')}, {sets('rest', '<>')},"
            f"{O.lsh_cte(MODEL, 'own', DOC_THRESHOLD, src_b='rest')} SELECT * FROM sim")


# ---------------------------------------------------------------- A2-A4

def q_subset(spark, base):
    return prep.subset(tables.load(spark, base, "part"), "p_partkey", SUBSET_FRACTION)


def q_subset_sql():
    return (f"SELECT * FROM part WHERE CAST('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 15) AS BIGINT) "
            f"< {int(SUBSET_FRACTION * 2 ** 60)}")


def _scratch(spark, what: str) -> str:
    """A new folder in the checkpoint folder, deleted with the stage scope."""
    return stage_path(spark, what)


def q_csv_read(spark, base):
    """The same table by the csv route: declared schema, nothing inferred."""
    folder = _scratch(spark, "csv")
    tables.load(spark, base, "part").write.option("header", True).csv(f"{folder}/part")
    return tables.load(spark, folder, "part", fmt="csv", header=True)


def q_csv_read_sql():
    return "SELECT * FROM part"


def q_preprocessed_roundtrip(spark, base):
    path = tables.write_preprocessed(event_interactions(spark, base), _scratch(spark, "preprocessed"))
    return tables.read_preprocessed(spark, path)


def q_model_roundtrip(spark, base):
    path = tables.save_model(spark, MODEL, _scratch(spark, "model"))
    model = tables.load_model(spark, path)
    return _sig_cols(lsh.signatures(event_interactions(spark, base), model), model.num_tables)


def q_ml_model_roundtrip(spark, base):
    """The model through a Spark ML model directory."""
    path = tables.save_ml_model(spark, MODEL, _scratch(spark, "ml-model"))
    model = tables.load_model(spark, path)
    return _sig_cols(lsh.signatures(event_interactions(spark, base), model), model.num_tables)


# ---------------------------------------------------------------- registry

QUERIES = {
    "user_recommendations": user_recommendations,
    "interactions": q_interactions,
    "entity_sets": q_entity_sets,
    "minhash_signature": q_minhash_signature,
    "lsh_buckets": q_lsh_buckets,
    "lsh_candidates": q_lsh_candidates,
    "similarity_join": q_similarity_join,
    "similarity_join_two": q_similarity_join_two,
    "exact_jaccard": q_exact_jaccard,
    "lsh_report": q_lsh_report,
    "neighbors": q_neighbors,
    "index_neighbors": q_index_neighbors,
    "all_neighbors": q_all_neighbors,
    "cf_scores": q_cf_scores,
    "exclude_seen": q_exclude_seen,
    "top_n": q_top_n,
    "similar_items": q_similar_items,
    "element_index": q_element_index,
    "assembled_features": q_assembled_features,
    "scaled_features": q_scaled_features,
    "scaled_maxabs": q_scaled_maxabs,
    "scaled_minmax": q_scaled_minmax,
    "scaled_std_mean": q_scaled_std_mean,
    "feature_neighbors": q_feature_neighbors,
    "document_tokens": q_document_tokens,
    "document_stopwords": q_document_stopwords,
    "document_near_copies": q_document_near_copies,
    "document_dense_sets": q_document_dense_sets,
    "subset": q_subset,
    "csv_read": q_csv_read,
    "preprocessed_roundtrip": q_preprocessed_roundtrip,
    "model_roundtrip": q_model_roundtrip,
    "ml_model_roundtrip": q_ml_model_roundtrip,
    "growing_index": q_growing_index,
    "unseen_scores": q_unseen_scores,
    "named_recommendations": q_named_recommendations,
    "source_copies": q_source_copies,
}

ORACLE = {
    "user_recommendations": user_recommendations_sql,
    "interactions": q_interactions_sql,
    "entity_sets": q_entity_sets_sql,
    "minhash_signature": q_minhash_signature_sql,
    "lsh_buckets": q_lsh_buckets_sql,
    "lsh_candidates": q_lsh_candidates_sql,
    "similarity_join": q_similarity_join_sql,
    "similarity_join_two": q_similarity_join_two_sql,
    "exact_jaccard": q_exact_jaccard_sql,
    "lsh_report": q_lsh_report_sql,
    "neighbors": q_neighbors_sql,
    "index_neighbors": q_neighbors_sql,
    "all_neighbors": q_all_neighbors_sql,
    "cf_scores": q_cf_scores_sql,
    "exclude_seen": q_exclude_seen_sql,
    "top_n": q_top_n_sql,
    "similar_items": q_similar_items_sql,
    "element_index": q_element_index_sql,
    "assembled_features": q_assembled_features_sql,
    "scaled_features": q_scaled_features_sql,
    "scaled_maxabs": q_scaled_maxabs_sql,
    "scaled_minmax": q_scaled_minmax_sql,
    "scaled_std_mean": q_scaled_std_mean_sql,
    "feature_neighbors": q_feature_neighbors_sql,
    "document_tokens": q_document_tokens_sql,
    "document_stopwords": q_document_stopwords_sql,
    "document_near_copies": q_document_near_copies_sql,
    "document_dense_sets": q_document_dense_sets_sql,
    "subset": q_subset_sql,
    "csv_read": q_csv_read_sql,
    "preprocessed_roundtrip": q_interactions_sql,
    "model_roundtrip": q_minhash_signature_sql,
    "ml_model_roundtrip": q_minhash_signature_sql,
    "growing_index": q_growing_index_sql,
    "unseen_scores": q_exclude_seen_sql,
    "named_recommendations": q_named_recommendations_sql,
    "source_copies": q_source_copies_sql,
}


def queries():
    return dict(QUERIES)


def oracle():
    return {k: f() for k, f in ORACLE.items()}
