"""The classifier as SQL: the same terms and weights, trained apart by accelerated gradient steps until nothing moves.

The penalised, class-weighted logistic loss has one minimum, so a model trained in another way must give the same scores.  Steps are taken
in the space of the training rows: the coefficients are sums of rows, ``a`` says how much of each, and ``m`` holds the inner products of all pairs.
"""

from __future__ import annotations

from catalog.text_queries import TOKENS_SQL, score_of
from savora import fixed_values as fixed

STEPS = 500
STEP = 2.0  # the loss of unit rows, weights of mean 1 and an intercept bends by at most 1/2
MINORITY, POSITIVE = fixed.MINORITY_CLASS, fixed.POSITIVE_CLASS

LABELLED = f"""labelled AS (SELECT review_id, review_text, toxic, CASE WHEN review_rating >= {fixed.POSITIVE_FROM_RATING} THEN '{POSITIVE}' ELSE '{MINORITY}' END AS actual
  FROM texts JOIN (SELECT doc_id AS review_id, toxic FROM labels) USING (review_id) WHERE review_rating IS NOT NULL AND trim(review_text) <> '')"""

RANKED = ("ranked AS (SELECT *, row_number() OVER (PARTITION BY actual ORDER BY md5(review_id || ':42'), review_id) AS place, "
          "count(*) OVER (PARTITION BY actual) AS n_class, count(*) OVER () AS n_all FROM {rows})")


def sample(rows: str, size: str) -> str:
    """``sampled``: the rows with ``inside``, true for ``size`` of them in the class proportions."""
    return f"""{RANKED.format(rows=rows)},
sampled AS (SELECT review_id, actual, place <= q AS inside FROM ranked JOIN (SELECT actual, floor({size} * n_class / n_all) + CASE WHEN
  row_number() OVER (ORDER BY ({size} * n_class / n_all) % 1 DESC, actual) <= {size} - sum(floor({size} * n_class / n_all)) OVER () THEN 1 ELSE 0 END AS q
  FROM (SELECT DISTINCT actual, n_class, n_all FROM ranked)) USING (actual))"""


def fold_parts(rows: str, first: int = 0, prefix: str = "") -> str:
    """``parts`` rows of five folds over the rows: each fit learns from four of them."""
    return f"""{prefix}places AS (SELECT review_id, (row_number() OVER (PARTITION BY actual ORDER BY md5(review_id || ':42'), review_id) - 1) % 5 AS fold FROM {rows}),
{prefix}folds AS (SELECT {first} + f AS fit, review_id, fold <> f AS train FROM {prefix}places, (SELECT unnest(generate_series(0, 4)) AS f))"""


# parts(fit, review_id, train) -> probability(fit, review_id, actual, train, score), coefficients(fit, term, weight)
TRAINED = rf"""words AS (SELECT review_id, list_filter(regexp_extract_all(strip_accents(lower(review_text)), '[\p{{L}}\p{{N}}_]{{2,}}'),
  lambda w: w NOT IN ({", ".join(f"'{w}'" for w in fixed.MODEL_STOPWORDS)})) AS ws FROM labelled),
grams AS (SELECT review_id, unnest(ws) AS term FROM words UNION ALL
  SELECT review_id, unnest(list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1])) FROM words),
tf AS (SELECT review_id, term, count(*) AS tf FROM grams GROUP BY 1, 2),
sizes AS (SELECT fit, count(*) AS n FROM parts WHERE train GROUP BY 1),
vocabulary AS (SELECT fit, term, ln((1.0 + n) / (1.0 + count(*))) + 1 AS idf FROM parts JOIN tf USING (review_id) JOIN sizes USING (fit) WHERE train GROUP BY fit, term, n
  HAVING count(*) >= 2 AND count(*) <= 0.9 * n),
raw AS (SELECT fit, review_id, train, term, (1 + ln(tf)) * idf AS w FROM parts JOIN tf USING (review_id) JOIN vocabulary USING (fit, term)),
x AS (SELECT fit, review_id, train, term, w / sqrt(sum(w * w) OVER (PARTITION BY fit, review_id)) AS w FROM raw),
learners AS (SELECT fit, review_id, row_number() OVER (PARTITION BY fit ORDER BY review_id) AS j, actual, n / (2.0 * count(*) OVER (PARTITION BY fit, actual)) AS weight, n
  FROM parts JOIN labelled USING (review_id) JOIN sizes USING (fit) WHERE train),
met AS (SELECT a.fit, a.review_id, l.j, sum(a.w * b.w) AS k FROM x a JOIN x b ON a.fit = b.fit AND a.term = b.term AND b.train JOIN learners l ON l.fit = b.fit AND l.review_id = b.review_id GROUP BY 1, 2, 3),
rows_of AS (SELECT p.fit, p.review_id, list(coalesce(k, 0) ORDER BY l.j) AS k FROM parts p JOIN learners l ON l.fit = p.fit LEFT JOIN met m ON m.fit = p.fit AND m.review_id = p.review_id AND m.j = l.j GROUP BY 1, 2),
problem AS (SELECT fit, list(k ORDER BY j) AS m, list(CASE actual WHEN '{MINORITY}' THEN 1.0::DOUBLE ELSE 0 END ORDER BY j) AS y, list(weight::DOUBLE ORDER BY j) AS w, any_value(n)::DOUBLE AS n
  FROM learners JOIN rows_of USING (fit, review_id) GROUP BY fit),
steps AS (SELECT fit, 0 AS t, list_transform(y, lambda v: 0.0::DOUBLE) AS a, list_transform(y, lambda v: 0.0::DOUBLE) AS past, 0.0::DOUBLE AS b, 0.0::DOUBLE AS past_b FROM problem
  UNION ALL
  SELECT fit, t + 1, list_transform(ya, lambda v, i: v - {STEP} * (g[i] + v / n)), ya_from, yb - {STEP} * list_sum(g), b FROM (
    SELECT *, list_transform(m, lambda r, i: w[i] * (1 / (1 + exp(-(list_dot_product(r, ya) + yb))) - y[i]) / n) AS g FROM (
      SELECT s.fit, s.t, p.m, p.y, p.w, p.n, s.a AS ya_from, s.b, list_transform(s.a, lambda v, i: v + pace * (v - s.past[i])) AS ya, s.b + pace * (s.b - s.past_b) AS yb
      FROM steps s JOIN problem p ON p.fit = s.fit, LATERAL (SELECT (sqrt(p.n * 0.5) - 1) / (sqrt(p.n * 0.5) + 1) AS pace) WHERE s.t < {STEPS}))),
solved AS (SELECT fit, a, b FROM steps WHERE t = {STEPS}),
probability AS (SELECT p.fit, p.review_id, l.actual, p.train, 1 / (1 + exp(-(list_dot_product(r.k, s.a) + s.b))) AS score FROM parts p JOIN rows_of r USING (fit, review_id) JOIN solved s USING (fit) JOIN labelled l USING (review_id)),
coefficients AS (SELECT x.fit, term, sum(x.w * s.a[l.j]) AS weight FROM x JOIN learners l ON l.fit = x.fit AND l.review_id = x.review_id JOIN solved s ON s.fit = x.fit GROUP BY 1, 2)"""

WHOLE = "parts AS (SELECT 0 AS fit, review_id, true AS train FROM labelled)"
