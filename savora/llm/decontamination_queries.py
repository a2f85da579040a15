"""Benchmark decontamination of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from savora.llm import bm25_wand
from savora.llm.common import table
from savora.llm.queries import query


@query("op8_benchmark_wand")
def _(spark, folder):
    found = bm25_wand.find_leaks(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
