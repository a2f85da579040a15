"""Secret scans over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from savora.llm import secret_novelty
from savora.llm.common import table
from savora.llm.queries import query


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op1_secret_novelty")
def _(spark, folder):
    found = secret_novelty.scan(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"] != "novel")

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"), of("novel"))
