"""Exact top-k search over the embeddings."""

from __future__ import annotations

from savora.llm import metric_tree
from savora.llm.common import table
from savora.llm.queries import query

SQL = """WITH v AS (SELECT vec_id, row_number() OVER () AS i, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.i, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.i <> c.i AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@query("op11_metric_tree", SQL)
def _(spark, folder):
    return metric_tree.search(table(spark, folder, "embeddings"), 50)
