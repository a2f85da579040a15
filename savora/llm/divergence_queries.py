"""Source divergence over the documents."""

from __future__ import annotations

from savora.llm import divergence
from savora.llm.common import table
from savora.llm.queries import query

SQL = r"""WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS i,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT lang, source, i, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
lt AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
v AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM lt GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN lt USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS source_n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (source_n + 2 * v) AS p,
  1 + (1000000000::HUGEINT * (total + 2)) // (lang_n + 2 * v) AS q FROM g JOIN lt USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""


@query("op12_divergence", SQL)
def _(spark, folder):
    return divergence.audit(table(spark, folder, "documents").select("text", "lang", "source"))
