"""BPE over the documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from savora.llm import bpe_speculate
from savora.llm.common import table
from savora.llm.queries import query


@query("op4_bpe_speculate")
def _(spark, folder):
    path = public_tokenizers.path("word_bpe_49k.json")
    both = bpe_speculate.decode(bpe_speculate.encode(table(spark, folder, "documents").select("doc_id", "text"), path).select("doc_id", "ids"), path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
