"""Reading and writing: files that Spark derives from the given tables, in a fresh place of the shared folder, and what comes back."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from catalog.page_queries import REVIEWS_SQL, review_pages
from catalog.registry import query, r6
from catalog.text_queries import KEY, LEXICON, NAME_KEY
from savora.operators.ordering import keep_first
from savora.plans import batch
from savora.sources import pages, shared, tables as stored
from savora.streaming.incremental import extract_new_pages

DOCUMENTS = T.StructType([T.StructField(n, k) for n, k in (("lang", T.StringType()), ("doc_id", T.LongType()), ("text", T.StringType()), ("n_chars", T.LongType()), ("absent", T.DoubleType()))])
_CSV_SQL = "SELECT doc_id, lang, n_chars, md5(text) AS digest, CAST(NULL AS DOUBLE) AS absent FROM documents"


def _csv_round_trip(t, escaped_breaks: bool):
    path = shared.fresh_path(t.spark, "documents.csv")
    stored.write_table(t.documents.select("doc_id", "text", "lang", "n_chars"), path, escaped_breaks=escaped_breaks)
    back = stored.read_csv(t.spark, path, DOCUMENTS, escaped_breaks)
    return back.select("doc_id", "lang", "n_chars", F.md5("text").alias("digest"), "absent")


@query("s01_csv_scan", _CSV_SQL)
def _(t):
    """Texts with quotes, commas and line breaks; columns in another order, one of them missing."""
    return _csv_round_trip(t, escaped_breaks=False)


@query("s01_csv_scan_split", _CSV_SQL)
def _(t):
    """The same with escaped line breaks, which lets several tasks read one file."""
    return _csv_round_trip(t, escaped_breaks=True)


# rows of both sources, numbered in file order: the documents first, then the labels
_ORDERED = """d AS (SELECT doc_id, row_number() OVER () - 1 AS row_idx, CAST(NULL AS BIGINT) AS quality FROM documents),
l AS (SELECT doc_id, (SELECT count(*) FROM documents) + row_number() OVER () - 1 AS row_idx, CAST(quality AS BIGINT) AS quality FROM labels),
both_sources AS (SELECT * FROM d UNION ALL SELECT * FROM l)"""


def _both(t):
    return stored.load_sources(t.spark, [f"{t.folder}/{n}.parquet" for n in ("documents", "no_such_source", "labels")]).select("doc_id", "row_idx", F.col("quality").cast("long"))


@query("s02_row_order", f"WITH {_ORDERED} SELECT * FROM both_sources")
def _(t):
    """Every row of two sources with the same ids and its number: source, file and position in the file decide."""
    return _both(t)


@query("s02_first_of_sources", f"WITH {_ORDERED} SELECT doc_id, row_idx, quality FROM both_sources QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY row_idx DESC) = 1")
def _(t):
    """Of rows with one id the last one wins: a label, where there is one."""
    return keep_first(_both(t), ["doc_id"], [F.desc("row_idx")])


@query("s04_csv_sink", "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(NULL AS VARCHAR) AS price_range FROM orders")
def _(t):
    """Columns in their fixed order, an absent one empty; read back by header."""
    columns = ["o_orderstatus", "o_orderkey", "price_range", "o_totalprice", "o_custkey", "o_orderdate"]
    path = shared.fresh_path(t.spark, "orders.csv")
    stored.write_table(t.orders.withColumn("o_orderdate", F.to_date("o_orderdate")), path, columns, escaped_breaks=True)
    kinds = {"o_orderkey": T.LongType(), "o_custkey": T.LongType(), "o_totalprice": T.DoubleType(), "o_orderdate": T.DateType()}
    back = stored.read_csv(t.spark, path, T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in columns]), escaped_breaks=True)
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", r6("o_totalprice"), "o_orderdate", "price_range")


@query("s05_gated_write", """
SELECT 'whole' AS attempt, c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 2
UNION ALL SELECT 'replaced', c_mktsegment, count(*), round(sum(c_acctbal), 2) FROM customer WHERE c_acctbal > 0 GROUP BY 2""")
def _(t):
    """A table without a required column writes nothing, not even over an older table; a valid one replaces it."""
    required = ("c_custkey", "c_mktsegment", "c_acctbal")
    path, older = (shared.fresh_path(t.spark, "customer") for _ in range(2))
    stored.write_if_valid(t.customer, path, required)
    stored.write_if_valid(t.customer.drop("c_acctbal"), path, required)
    stored.write_if_valid(t.customer, older, required)
    stored.write_if_valid(t.customer.filter("c_acctbal > 0"), older, required)
    lost = shared.fresh_path(t.spark, "no_customer")
    stored.write_if_valid(t.customer.drop("c_custkey"), lost, required)
    found = [("whole", path), ("replaced", older)] + [("lost", lost)] * stored.exists(t.spark, lost)
    read = [t.spark.read.parquet(p).select(F.lit(name).alias("attempt"), "c_mktsegment", "c_acctbal") for name, p in found]
    return stored.union_sources(read).groupBy("attempt", "c_mktsegment").agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


_CHAIN = f"""kept AS (SELECT row_idx, 'r_' || substr(md5({NAME_KEY.format('restaurant_name')}), 1, 10) AS restaurant_id, trim(regexp_replace(restaurant_name, '\\s+', ' ', 'g')) AS restaurant_name, source
  FROM texts WHERE length({KEY.format('review_text')}) >= 10 QUALIFY row_number() OVER (PARTITION BY {NAME_KEY.format('restaurant_name')}, {KEY.format('review_text')} ORDER BY row_idx) = 1)"""


@query("batch_chain", f"WITH {_CHAIN} SELECT row_idx, restaurant_id, restaurant_name, source, count(*) OVER (PARTITION BY restaurant_id, restaurant_name) AS review_count, true AS clustered FROM kept", "texts")
def _(t):
    """Sources to clustered reviews: identity, duplicates, metadata, sentiment, cleaning, features, clusters."""
    featured, clustered = batch.run(t.texts, F.lit("2026-07-19"), LEXICON, restarts=2)
    labels = clustered.select("row_idx", (F.col("cluster").isNotNull() & F.col("cluster_name").isNotNull()).alias("clustered"))
    return featured.select("row_idx", "restaurant_id", "restaurant_name", "source", "review_count").join(labels, "row_idx")


@query("s09_incremental_extraction", f"WITH {REVIEWS_SQL} SELECT 'dg_' || conv_id AS restaurant_id, review_text, reviewer_name, review_rating, review_date, 'site' AS source FROM reviews")
def _(t):
    """Page files become review rows batch by batch; the first run is stopped after two batches, the second one goes on behind them."""
    folders = [shared.fresh_path(t.spark, n) for n in ("pages", "reviews", "progress")]
    review_pages(t).repartition(8, "page_id").write.parquet(folders[0])

    def extract(df):
        return pages.flatten_reviews(df, pages.microdata_reviews(F.col("html")), "site", "dg_").drop("page_id")

    schema = "page_id long, restaurant_id long, html string"
    extract_new_pages(t.spark, *folders, extract, files_per_batch=2, max_batches=2, page_schema=schema)
    extract_new_pages(t.spark, *folders, extract, files_per_batch=2, page_schema=schema)
    return t.spark.read.parquet(folders[1]).withColumn("review_rating", r6("review_rating"))
