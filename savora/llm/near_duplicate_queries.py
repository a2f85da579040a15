"""N-gram Jaccard join of the documents."""

from __future__ import annotations

from savora.llm import signature_tree
from savora.llm.common import table
from savora.llm.queries import query


# every document against every other, and all that can be reached over links
SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [md5_number_lower(array_to_string(ws, ' '))]
  ELSE list_distinct(list_transform(generate_series(1, len(ws) - 4), lambda i: md5_number_lower(array_to_string(ws[i:i + 4], ' ')))) END AS shingles FROM w),
one AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (SELECT a.doc_id AS u, b.doc_id AS v FROM one a JOIN one b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
ends AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reached AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM reached r JOIN ends l ON l.u = r.v)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id FROM s JOIN (SELECT u AS doc_id, min(v) AS component_id FROM reached GROUP BY 1) USING (doc_id)"""


@query("op10_signature_tree", SQL)
def _(spark, folder):
    return signature_tree.similar_components(table(spark, folder, "documents").select("doc_id", "text"))
