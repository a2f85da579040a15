"""Repeated byte strings of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from savora.llm import radix_repeats
from savora.llm.common import table
from savora.llm.queries import query


@query("op7_radix_repeats")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cleaned = radix_repeats.remove(docs, radix_repeats.repeated_spans(docs))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return cleaned.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
