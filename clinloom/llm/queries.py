"""Registered queries of the training-data operators and their DuckDB SQL."""
from __future__ import annotations

from clinloom.llm.bit_sliced import op7_bit_sliced
from clinloom.llm.byte_bpe import op2_byte_bpe
from clinloom.llm.drift_clustering import op12_drift_clustering
from clinloom.llm.grammar_runs import op11_grammar_runs
from clinloom.llm.nearest import op6_nearest
from clinloom.llm.ngram_join import op1_ngram_join
from clinloom.llm.packing import op8_packing
from clinloom.llm.personal_data import op4_personal_data
from clinloom.llm.quality import op9_quality
from clinloom.llm.secret_scan import op10_secret_scan
from clinloom.llm.token_frames import op3_token_frames
from clinloom.llm.toxicity import op5_toxicity
from clinloom.llm.winnowing import op13_winnowing

QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_token_frames": op3_token_frames,
    "op4_personal_data": op4_personal_data,
    "op5_toxicity": op5_toxicity,
    "op6_nearest": op6_nearest,
    "op7_bit_sliced": op7_bit_sliced,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_secret_scan": op10_secret_scan,
    "op11_grammar_runs": op11_grammar_runs,
    "op12_drift_clustering": op12_drift_clustering,
    "op13_winnowing": op13_winnowing,
}

_USABLE = """SELECT vec_id, min([CAST(x AS DOUBLE) for x in embedding]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 GROUP BY vec_id"""


def _top(vectors: str, score: str, step: int, k: int) -> str:
    return f"""
WITH e AS ({vectors}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, {score} AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {step} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {k}"""


def _clusters(clusters: int = 40, rounds: int = 5) -> str:
    """k-means by integers, a round after the other."""
    near = "list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(x.v, c.v)])"
    parts = [f"""x AS (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT) for e in embedding] AS v
  FROM embeddings WHERE len(embedding) = 64 AND len([e for e in embedding if e IS NULL OR NOT isfinite(e)]) = 0),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS INTEGER) AS cluster, v FROM x
  WHERE vec_id IS NOT NULL ORDER BY cluster LIMIT {clusters})"""]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT r, min(struct_pack(d := CAST({near} AS BIGINT), cluster := cluster)) AS m FROM x CROSS JOIN c{i} c GROUP BY r)")
        if i < rounds:
            parts.append(f"""m{i} AS (SELECT m.cluster AS cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS y FROM (
  SELECT m, i, sum(x.v[i]) AS s, count(*) AS n FROM (SELECT {{'cluster': m.cluster}} AS m, r FROM a{i}) JOIN x USING (r),
  range(1, 65) AS g(i) GROUP BY m, i)),
c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(w.v, c.v) AS v FROM c{i} c LEFT JOIN
  (SELECT cluster, list(y ORDER BY i) AS v FROM m{i} GROUP BY cluster) w USING (cluster))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, a.m.cluster AS cluster, a.m.d AS distance, CAST(sum(a.m.d) OVER (PARTITION BY a.m.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN x USING (r) JOIN c{rounds} c ON c.cluster = a.m.cluster"""


# Tokenizers, trained models and packing are beyond SQL: tests/llm holds those queries
# against the libraries, plain Python versions and brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_ngram_join": r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:least(i + 4, len(w))], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n, sha256(string_agg(g, chr(10) ORDER BY g)) AS set_hash FROM s GROUP BY doc_id),
c AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY set_hash) AS class_id FROM n),
l AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
      JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
      GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 80 * (nx.n + ny.n - count(*))),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM t UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.root = l.a)
SELECT t.doc_id, coalesce(c.n, 0) AS n_shingles, m.component_id, coalesce(c.class_id, t.doc_id) AS class_id
FROM t LEFT JOIN c ON t.doc_id = c.doc_id
JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id) m ON t.doc_id = m.doc_id""",
    "op6_nearest": _top(f"SELECT * FROM ({_USABLE}) WHERE len([x for x in v if x <> 0]) > 0", "list_inner_product(q.v, c.v)", 20, 20),
    "op7_bit_sliced": _top(f"SELECT vec_id, [CAST(floor(1024 * x) AS BIGINT) for x in v] AS v FROM ({_USABLE})",
                           "CAST(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) AS BIGINT)", 100, 10),
    "op12_drift_clustering": _clusters(),
    "op13_winnowing": r"""
WITH w AS (
  SELECT kind, id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT 'doc' AS kind, CAST(doc_id AS VARCHAR) AS id, row_number() OVER () AS r, text FROM documents
        UNION ALL SELECT 'item', CAST(item_id AS VARCHAR), row_number() OVER (), text FROM benchmark)),
i AS (SELECT DISTINCT id, least(10, len(w)) AS m, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS g
      FROM (SELECT id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM w WHERE kind = 'item' AND len(w) > 0)),
m AS (SELECT DISTINCT m FROM i),
d AS (SELECT r, p, m.m, array_to_string(w[p:p + m.m - 1], ' ') AS g
      FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM w WHERE kind = 'doc') JOIN m ON p + m.m - 1 <= len(w)),
h AS (SELECT d.r, d.p, i.m, i.id FROM d JOIN i ON d.g = i.g AND d.m = i.m),
n AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + m)) AS q FROM (SELECT DISTINCT r, p, m FROM h)) GROUP BY r),
l AS (SELECT r, count(DISTINCT id) AS n_items, string_agg(DISTINCT id, ',' ORDER BY id) AS items FROM h GROUP BY r)
SELECT t.doc_id, len(w.w) AS n_words, coalesce(n.n_hit, 0) AS n_hit, coalesce(l.n_items, 0) AS n_items,
  sha256(coalesce(l.items, '')) AS items_sha256, coalesce(n.n_hit, 0) > 0 AS contaminated
FROM (SELECT doc_id, row_number() OVER () AS r FROM documents) t JOIN w ON w.kind = 'doc' AND w.r = t.r
LEFT JOIN n ON n.r = t.r LEFT JOIN l ON l.r = t.r""",
}
