"""License scans over the documents."""

from __future__ import annotations

from savora.llm import license_scan as ls
from savora.llm.common import table
from savora.llm.queries import query

_SETS = ", ".join("('{}', [{}], {})".format(label, ", ".join(f"'{w}'" for w in words), ls.need_of(len(words), ls.THRESHOLD))
                  for label, words in ((k, ls.template_words(v)) for k, v in ls.TEMPLATES.items()))
_AT = " UNION ALL ".join(
    f"SELECT doc_id, '{label}' AS label, i - 1 AS i FROM places WHERE " + " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase))
    for label, phrase in ls.PHRASES.items())

SQL = f"""WITH w AS (SELECT doc_id, translate(coalesce(text, ''), '{ls.CAPITALS}', '{ls.SMALL}') AS t FROM documents),
d AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM w),
places AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM d),
found AS ({_AT}),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels FROM found GROUP BY 1),
blocks AS (SELECT doc_id, list_distinct(regexp_extract_all(p, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS words
  FROM (SELECT doc_id, unnest(regexp_split_to_array(t, '\\n[ \\t\\r]*\\n')) AS p FROM d)),
templates(label, words, need) AS (VALUES {_SETS}),
links AS (SELECT doc_id, label, len(list_intersect(b.words, m.words)) / len(m.words) AS containment FROM blocks b, templates m
  WHERE len(list_intersect(b.words, m.words)) >= need),
more AS (SELECT doc_id, list(DISTINCT label) AS labels, max(containment) AS score FROM links GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
  coalesce(score, 0.0) AS score FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)"""


@query("op5_license_join", SQL)
def _(spark, folder):
    return ls.scan(table(spark, folder, "documents").select("doc_id", "text"))
