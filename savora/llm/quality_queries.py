"""Quality rules over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from savora.llm import line_quality as lq
from savora.llm.common import table
from savora.llm.queries import query

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SPACED = f"trim(translate(line, {_WHITE}, '      '))"
_COUNT = "(length(line) - length(translate(line, '{}', '')))"
_PHRASES = " OR ".join(f"contains(lowered, '{p}')" for p in lq.BOILERPLATE)
_CLOSING = ", ".join(f"'{c}'" for c in lq.CLOSING)


def judged_sql(source: str) -> str:
    """SQL of ``judge`` over a table or CTE with ``doc_id`` and ``text``; one row per document."""
    return f"""d AS (SELECT doc_id, coalesce(text, '') AS text FROM {source}),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(8) r(k) GROUP BY 1),
lines AS (SELECT doc_id, line_no, line, translate(line, '{lq.CAPITALS}', '{lq.SMALL}') AS lowered, length(translate(line, {_WHITE}, '')) AS chars,
    len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM d)
  WHERE length(translate(line, {_WHITE}, '')) > 0),
judged AS (SELECT *, ({_COUNT.format(lq.SYMBOLS)} * 10 > chars) OR ((length(line) - length(replace(line, '!!', ''))) * 2 > n)
    OR ({_COUNT.format(lq.SMALL)} = 0 AND {_COUNT.format(lq.CAPITALS)} >= 10)
    OR ({_COUNT.format('|')} >= 3 AND n <= {_COUNT.format('|')} * 5) OR (n <= 3 AND right({_SPACED}, 1) NOT IN ({_CLOSING}))
    OR (n < {lq.LINE_WORDS} AND ({_PHRASES})) AS fails FROM lines),
per_doc AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (WHERE fails) AS n_lines_removed,
    coalesce(sum(chars) FILTER (WHERE fails), 0) AS lost_chars, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT fails), '') AS clean_text FROM judged GROUP BY 1),
base AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '{lq.SYMBOLS}', '')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
    CAST(coalesce(n_lines_removed, 0) AS BIGINT) AS n_lines_removed, CAST(coalesce(lost_chars, 0) AS BIGINT) AS lost_chars, coalesce(clean_text, '') AS clean_text
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN per_doc USING (doc_id)),
verdict AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND lost_chars <= {lq.MAX_LOST} * word_chars AS kept FROM base)"""


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_lines_removed", "lost_chars")


@query("op2_line_quality", f"WITH {judged_sql('documents')} SELECT {', '.join(COLUMNS)}, sha256(clean_text) AS clean_sha256 FROM verdict")
def _(spark, folder):
    judged = lq.judge(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select(*COLUMNS, F.sha2("clean_text", 256).alias("clean_sha256"))
