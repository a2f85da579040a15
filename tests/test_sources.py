import pytest
from pyspark.sql import functions as F, types as T

from savora import schemas
from savora.plans import batch
from savora.sources import pages, tables
from savora.streaming.incremental import extract_new_pages

ROWS = [("dg_1", "Brisa del Mar Restaurant", 'La comida, "excelente"\ny barata', "siteA"), ("dg_2", "Otro", "El servicio fue lento y malo", "siteA")]


def write_csv(folder, name, header, rows):
    import csv
    path = folder / name
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


@pytest.fixture
def sources(tmp_path):
    a = write_csv(tmp_path, "a.csv", ["restaurant_id", "restaurant_name", "review_text", "source"], ROWS)
    b = write_csv(tmp_path, "b.csv", ["source", "restaurant_id", "review_text", "overall_rating", "restaurant_name", "price_range"],
                  [("siteB", "rg_9", "La comida excelente y barata", "4.5", "Brisa del Mar Restaurante", "$$"), ("siteB", "rg_9", "ambiente acogedor y limpio", "n/a", "Brisa del Mar Restaurante", "")])
    empty = write_csv(tmp_path, "empty.csv", ["restaurant_id", "restaurant_name", "review_text", "source"], [])
    return [a, str(tmp_path / "missing.csv"), empty, b]


def test_load_sources(spark, sources):
    rows = tables.load_sources(spark, sources).orderBy("row_idx").collect()
    assert [r.source for r in rows] == ["siteA", "siteA", "siteB", "siteB"]
    assert rows[0].review_text == 'La comida, "excelente"\ny barata'
    assert (rows[2].overall_rating, rows[3].overall_rating, rows[0].overall_rating) == (4.5, None, None)


def test_no_source_is_an_error(spark, sources):
    with pytest.raises(FileNotFoundError):
        tables.load_sources(spark, sources[1:3])


def test_fallback_chain(spark, sources):
    assert tables.load_first(spark, [sources[1], sources[0]]).count() == 2
    none = tables.load_first(spark, [sources[1]])
    assert none.count() == 0 and none.columns == schemas.SOURCE_SCHEMA.names


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x, "y"\nz', {"comida": "positive"})], "restaurant_id string, review_text string, aspect_sentiments map<string,string>")
    path = str(tmp_path / "out.csv")
    tables.write_table(df, path, ["review_text", "restaurant_id", "price_range", "aspect_sentiments"])
    back = tables.read_csv(spark, path)
    assert spark.read.option("header", True).csv(path).columns == ["review_text", "restaurant_id", "price_range", "aspect_sentiments"]
    assert back.first().review_text == 'x, "y"\nz'


def test_gated_write(spark, tmp_path):
    good = spark.createDataFrame([("a", "b", "c")], "restaurant_id string, restaurant_name string, source string")
    assert tables.write_if_valid(good, str(tmp_path / "good")) is True
    assert tables.write_if_valid(good.drop("source"), str(tmp_path / "bad")) is False
    assert not (tmp_path / "bad").exists()


def resplit(spark, size, path, schema=None, escaped=False):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        frame = tables.read_positioned(spark, path, schema, escaped)
        ordered = tables.with_row_order([frame])
        return frame.rdd.getNumPartitions(), [(r.row_idx, r.n) for r in ordered.orderBy("row_idx").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_row_order_does_not_depend_on_splits(spark, tmp_path, kind):
    rows = spark.range(4000).select(F.col("id").alias("n"), F.concat(F.lit("x\ny \\"), F.col("id")).alias("t")).repartition(3)
    path = str(tmp_path / f"rows.{kind}")
    tables.write_table(rows, path, escaped_breaks=True)
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])
    parts, whole = resplit(spark, 1 << 27, path, schema, True)
    more, split = resplit(spark, 9000, path, schema, True)
    assert whole == split and [i for i, _ in whole] == list(range(4000)) and sorted(n for _, n in whole) == list(range(4000))
    assert more > parts or kind == "parquet"
    # inside a file, rows follow each other as they were written
    files = [[r.n for r in spark.read.parquet(f).collect()] for f in sorted(str(f) for f in (tmp_path / "rows.parquet").glob("*.parquet"))] if kind == "parquet" else []
    assert not files or [n for _, n in whole] == [n for f in files for n in f]


def test_sources_follow_each_other(spark, sources):
    once, again = ([(r.row_idx, r.source, r.review_text) for r in tables.load_sources(spark, order).orderBy("row_idx").collect()] for order in (sources, sources[::-1]))
    assert [i for i, *_ in once] == [0, 1, 2, 3] and [s for _, s, _ in once] == ["siteA", "siteA", "siteB", "siteB"]
    assert [s for _, s, _ in again] == ["siteB", "siteB", "siteA", "siteA"]


def test_many_files_are_joined_instead_of_broadcast(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "many")
    spark.range(50).withColumnRenamed("id", "n").repartition(7).write.parquet(path)
    small = [(r.row_idx, r.n) for r in tables.with_row_order([tables.read_positioned(spark, path)]).orderBy("row_idx").collect()]
    monkeypatch.setattr(tables, "FILES_TO_BROADCAST", 2)
    assert [(r.row_idx, r.n) for r in tables.with_row_order([tables.read_positioned(spark, path)]).orderBy("row_idx").collect()] == small


BREAKS = ["a\nb", "a\r\n\\n", "\\", "\\\\n\n", "\\\\\\r", "", None, "plain", "\n", 'q"\n,"', "\\r\\n"]


def test_escaped_breaks(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(BREAKS)), "n long, t string")
    path = str(tmp_path / "breaks.csv")
    tables.write_table(df, path, escaped_breaks=True)
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])
    assert [r.t for r in tables.read_csv(spark, path, schema, escaped_breaks=True).orderBy("n").collect()] == BREAKS
    lines = [x for f in (tmp_path / "breaks.csv").glob("*.csv") for x in f.read_text().splitlines() if x != "n,t"]
    assert len(lines) == len(BREAKS)


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "kept")
    assert tables.write_table(spark.range(5), path) == 5
    broken = spark.range(8).select(F.when(F.col("id") == 7, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.write_table(broken, path)
    assert spark.read.parquet(path).count() == 5
    assert tables.write_table(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 3 and [f.name for f in tmp_path.iterdir()] == ["kept"]


def test_append(spark, tmp_path):
    path = str(tmp_path / "rows.csv")
    for value in ("a", "b"):
        tables.append_table(spark.createDataFrame([(value, 1)], "x string, y int"), path, ["y", "x"])
    assert sorted(r.x for r in spark.read.option("header", True).csv(path).collect()) == ["a", "b"]


def test_upsert(spark):
    old = spark.createDataFrame([("h1", "a", 1), ("h2", "b", 1)], "key string, result string, v long")
    new = spark.createDataFrame([("h2", "c", 2), ("h2", "d", 3), ("h3", "e", 1)], "key string, result string, v long")
    assert {(r.key, r.result) for r in tables.upsert(old, new, "key", "v").collect()} == {("h1", "a"), ("h2", "d"), ("h3", "e")}


# --- pages -------------------------------------------------------------------

LISTING = ('<a href="/restaurante/uno_12">a</a><a class="x" href="/restaurante/uno_12?x">b</a><a href="/restaurante/dos_7/reservar">r</a>'
           '<a href="http://s.x/restaurante/tres_9">c</a><a href="/otro">o</a>')


def test_links(spark):
    listing = spark.createDataFrame([(1, LISTING), (2, '<a href="/restaurante/cuatro_4">d</a>' + LISTING)], "page_id long, html string")
    found = pages.links(listing, keep="/restaurante/", drop=("reservar", "agregar"), base_url="http://s.x", link_id=r"restaurante/[^_]+_(\d+)")
    first = [(r.link_id, r.url) for r in found.filter("page_id = 1").orderBy("pos").collect()]
    assert first == [("12", "http://s.x/restaurante/uno_12"), ("9", "http://s.x/restaurante/tres_9")]
    assert [r.link_id for r in pages.discover(found).orderBy("page_id", "pos").collect()] == ["12", "9", "4"]
    assert [r.link_id for r in pages.discover(found, limit=2).collect()] == ["12", "9"]
    assert [(r.links, r.new_links) for r in pages.discovery_log(found).orderBy("page_id").collect()] == [(2, 2), (3, 1)]


DETAIL = """<html><h1>Casa <b>Uno</b></h1><span itemprop="servesCuisine">Italiana</span><meta itemprop="priceRange" content="$$">
<div itemprop="aggregateRating"><span itemprop="ratingValue">4,6</span><span itemprop="reviewCount">1.9K</span></div>
<div class="dg-reviews-stats x">Comida 4.4 /5 Servicio 4.5 /5 Ambiente 7 /5</div><p itemprop="streetAddress">Casa Azul & Co - Colina</p>
<div itemprop="review"><span itemprop="author">Ana</span><div itemprop="reviewRating"><span itemprop="ratingValue">5</span></div>
<meta itemprop="datePublished" content="2025-03-12"><p itemprop="reviewBody">Muy rico &amp; barato</p></div>
<div itemprop="review"><p itemprop="reviewBody">corto</p></div>
<div itemprop="review"><p itemprop="reviewBody">Sin autor ni fecha aqui</p><span itemprop="ratingValue">2</span></div></html>"""


def test_microdata(spark):
    df = spark.createDataFrame([(12, DETAIL), (13, "<html></html>")], "id long, html string")
    row, empty = pages.microdata_record(df, F.col("id")).orderBy("id").collect()
    assert (row.restaurant_name, row.category, row.price_range, row.overall_rating, row.review_count) == ("Casa Uno", "Italiana", "$$", 4.6, 1900.0)
    assert (row.food_rating, row.service_rating, row.ambiance_rating, row.location) == (4.4, 4.5, None, "Colina")
    assert (empty.restaurant_name, empty.overall_rating, empty.location) == (None, None, None)


def test_microdata_reviews(value):
    got = value(pages.microdata_reviews, DETAIL)
    assert [tuple(r) for r in got] == [("Muy rico & barato", "Ana", 5.0, "2025-03-12"), ("Sin autor ni fecha aqui", None, 2.0, None)]
    assert value(pages.microdata_reviews, "<html></html>") == []


CARDS = ('<div class="o_review big"><span class="text_full">Comida muy buena de verdad</span><a class="author_name">Luis</a><time datetime="2025-01-02T10:00">x</time></div>'
         '<div class="o_review"><p class="text">Otra opinion mas corta</p><span class="user_date">hace 2 meses</span></div>')


def test_card_reviews(value):
    got = value(pages.card_reviews, CARDS)
    assert [(r.review_text, r.reviewer_name, r.review_date) for r in got] == [
        ("Comida muy buena de verdad", "Luis", "2025-01-02"), ("Otra opinion mas corta", None, "hace 2 meses")]


LD = ('<script type="application/ld+json">{oops</script><script type="application/ld+json">[{"name": ""}, {"name": "Uno", "aggregateRating": {"ratingValue": "x"}}]</script>'
      '<script type="application/ld+json">{"name": "Dos", "aggregateRating": {"ratingValue": "4.2"}, "servesCuisine": ["Pizza", "Sushi"], "address": {"streetAddress": "Calle 1"}}</script>')


def test_json_ld(value):
    got = value(pages.json_ld, LD)
    assert tuple(got) == ("Uno", 4.2, None, "Pizza, Sushi", "Calle 1")
    assert tuple(value(pages.json_ld, "<html></html>")) == (None,) * 5


def test_json_ld_record(spark):
    df = spark.createDataFrame([("http://x/Uno-Panama/", LD + CARDS)], "url string, html string")
    rows = pages.flatten_reviews(pages.json_ld_record(df), pages.card_reviews(F.col("html")), "siteB").collect()
    assert len(rows) == 2 and rows[0].restaurant_id.startswith("rg_") and rows[0].restaurant_name == "Uno"


def test_outer_flatten(spark):
    df = spark.createDataFrame([(1, DETAIL), (2, "<p>nada</p>")], "restaurant_id long, html string")
    inner = pages.flatten_reviews(df, pages.microdata_reviews(F.col("html")), "s", "ta_")
    outer = pages.flatten_reviews(df, pages.microdata_reviews(F.col("html")), "s", "ta_", keep_empty=True)
    assert inner.count() == 2 and outer.count() == 3
    assert outer.filter("restaurant_id = 'ta_2'").first().review_text is None


def test_incremental_extraction_keeps_and_continues(spark, tmp_path):
    store, out, state = (str(tmp_path / n) for n in ("pages", "out", "state"))

    def extract(df):
        records = pages.microdata_record(df, F.col("page_id")).select("restaurant_id", "restaurant_name", "html")
        return pages.flatten_reviews(records, pages.microdata_reviews(F.col("html")), "siteA", "dg_")

    def add(page):
        spark.createDataFrame([(page, "u", DETAIL)], "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(store)

    add(1)
    extract_new_pages(spark, store, out, state, extract)
    assert spark.read.parquet(out).count() == 2
    add(2)
    extract_new_pages(spark, store, out, state, extract)
    assert {r.restaurant_id: r["count"] for r in spark.read.parquet(out).groupBy("restaurant_id").count().collect()} == {"dg_1": 2, "dg_2": 2}


def test_a_stopped_run_keeps_its_batches(spark, tmp_path):
    store, out, state = (str(tmp_path / n) for n in ("pages", "out", "state"))
    for page in range(6):
        spark.createDataFrame([(page, "u", DETAIL)], "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(store)

    def extract(df):
        return df.select("page_id")
    kept = extract_new_pages(spark, store, out, state, extract, files_per_batch=1, max_batches=2)
    assert kept >= 2 and spark.read.parquet(out).count() >= 2
    extract_new_pages(spark, store, out, state, extract, files_per_batch=4)
    assert sorted(r.page_id for r in spark.read.parquet(out).collect()) == list(range(6))
    assert extract_new_pages(spark, store, out, state, extract) == 0


# --- the chain ---------------------------------------------------------------

def test_batch_chain(spark, sources):
    featured, clustered = batch.run(tables.load_sources(spark, sources), F.lit("2026-07-19"), restarts=1)
    rows = clustered.orderBy("row_idx").collect()
    assert len(rows) == 3  # one copy was dropped before it could donate its price
    assert len({r.restaurant_id for r in rows}) == 2
    assert {r.sentiment_comida for r in rows} <= {"positive", "neutral", "negative"}
    assert all(r.cluster_name for r in rows) or {r.cluster for r in rows} <= {0, 1, None}
    assert rows[1].sentiment_servicio == "negative"
    assert "review_count" in featured.columns
    assert all(r.price_range is None for r in rows)


def test_a_metadata_record_reads_each_piece_once(spark):
    """pieces written out wherever a field reads them came to 308 extractions a page."""
    page = spark.createDataFrame([(1, '<h1>Casa</h1><p itemprop="address">Calle 2 - Bella Vista - Panamá</p><div itemprop="aggregateRating"><b itemprop="reviewCount">1,5 K</b></div>'
                                      '<div class="dg-reviews-stats">Comida 4.5 Servicio 9</div>')], "id long, html string").repartition(1)
    record = pages.microdata_record(page, F.col("id"))
    plan = record._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") < 50 and plan.count("regexp_replace(") < 50
    row = record.first()
    assert (row.location, row.review_count, row.food_rating, row.service_rating, row.category) == ("Bella Vista", 1500.0, 4.5, None, None)
    assert record.columns[:3] == ["id", "html", "restaurant_id"] and not any(c.startswith("_") for c in record.columns)


def test_an_entity_is_filled_by_several_tasks(spark):
    """One entity, 60,000 rows: before, its texts met in a single group of a window."""
    from savora.operators import unify
    rows = spark.range(60_000).select(F.col("id").alias("row_idx"), F.lit("r").alias("restaurant_id"), F.when(F.col("id") == 41_000, "Zona").alias("location"))
    filled = unify.fill_metadata(rows, ["location"])
    assert filled.filter("location = 'Zona'").count() == 60_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        held = unify.fill_metadata(rows, ["location"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in held) <= 40_000
