"""Incremental extraction: new pages become review rows batch by batch.

Each batch is written as it completes and recorded in the checkpoint, so a run
that is stopped keeps what it has and the next one continues behind it.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

PAGE_SCHEMA = "page_id long, url string, html string"
POLL_SECONDS = 0.05


def extract_new_pages(spark: SparkSession, pages_dir: str, out_dir: str, checkpoint_dir: str,
                      extract: Callable[[DataFrame], DataFrame], files_per_batch: int = 5,
                      max_batches: int | None = None, page_schema: str = PAGE_SCHEMA) -> int:
    """Process page files that earlier runs did not, then stop; says how many batches were kept.

    ``extract`` maps pages to review rows without any shuffle, so each batch is
    one scan and one write.  With ``max_batches`` the run is stopped once that many are kept; a batch under way then is left to the next run.
    All folders must be reachable by every executor.
    """
    pages = (spark.readStream.schema(page_schema).option("maxFilesPerTrigger", files_per_batch)
             .parquet(pages_dir))
    query = (extract(pages).writeStream.format("parquet").outputMode("append")
             .option("path", out_dir).option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start())
    first = last = None
    while True:
        done = [p.batchId for p in query.recentProgress if p.numInputRows > 0]
        if done:
            first, last = done[0] if first is None else first, done[-1]
        kept = last - first + 1 if done else 0
        if not query.isActive or (max_batches and kept >= max_batches):
            break
        query.awaitTermination(POLL_SECONDS)
    query.stop()
    query.awaitTermination()
    return kept
