"""WARC bundles of the pages, written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from savora.llm import warc_bundles
from savora.llm.common import table
from savora.llm.queries import query

SQL = """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to FROM f"""


@query("op6_warc_bundles", SQL)
def _(spark, folder):
    index, archive = warc_bundles.archive(table(spark, folder, "pages").select("page_id", "url", "html"))
    records = warc_bundles.read_records(index, archive)
    own = F.when(F.col("record_type") == "response", F.sha2("payload", 256)).otherwise(F.col("payload_digest"))
    size = F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes"))
    return records.select("page_id", size.alias("payload_bytes"), own.alias("payload_digest"), "record_type", "refers_to")
