"""A training corpus from raw documents: quality rules, near duplicates, decontamination, secrets, tokens.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over what its predecessor kept, and all but the last return the
columns of the documents.  Columns beyond ``doc_id`` and ``text`` pass through, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from savora.llm import bm25_wand, bpe_speculate, line_quality, secret_novelty, signature_tree
from savora.llm.common import stored, table

ROW = "_document"
# workers live through all stages: what the last one remembers lies beside the memory of the others
WORDS_IN_MEMORY = 100_000


def _packed(docs: DataFrame) -> DataFrame:
    """The text beside the whole row, so that no column an operator adds can clash with one of the documents."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), "text")


def _unpacked(rows: DataFrame, columns: list[str], text: Column | None = None) -> DataFrame:
    """The documents' columns, with a new text and its length if one is given."""
    new = {} if text is None else {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[new.get(c, F.col(f"{ROW}.`{c}`")).alias(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that fail.  A null text fails."""
    judged = line_quality.judge(_packed(docs)).filter("kept")
    return _unpacked(judged, docs.columns, F.col("clean_text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays; rows without an id or without words stay."""
    return signature_tree.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold question and answer of a benchmark item go."""
    found = bm25_wand.find_leaks(_packed(docs), table(spark, sf_dir, "benchmark"))
    return _unpacked(found.filter(F.size("leaks") == 0), docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by the name of their kind in brackets; every document stays."""
    clean = secret_novelty.redact(_packed(docs))
    return _unpacked(clean, docs.columns, F.col("text"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text; a null text has none."""
    encoded = bpe_speculate.encode(_packed(docs), public_tokenizers.path("word_bpe_49k.json"), remembered=WORDS_IN_MEMORY)
    kept = [F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns if c not in ("text", "n_tokens", "ids")]
    return encoded.select(*kept, F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("tokens", tokens)]

# tokens cannot be expressed in SQL: tests/llm hold the rows against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
