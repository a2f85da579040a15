"""Extraction from stored pages, and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, r6
from catalog.text_queries import LEXICON, TOKENS_SQL, score_of
from savora.functions import parse
from savora.operators import explore, features
from savora.sources import pages

BASE_URL = "https://reviews.example"

LINKS_SQL = rf"""found AS (SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) - 1 AS pos FROM (SELECT page_id, regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1) AS l FROM pages)),
links AS (SELECT page_id, href AS link_id, CAST(min(pos) AS INT) AS pos, CASE WHEN starts_with(href, 'http') THEN href ELSE '{BASE_URL}' || href END AS url FROM found
  WHERE starts_with(href, '/') AND NOT contains(href, 'the') GROUP BY 1, 2)"""


def _links(t):
    return pages.links(t.pages, keep="^/", drop=("the",), base_url=BASE_URL)


@query("s10_page_links", f"WITH {LINKS_SQL} SELECT * FROM links")
def _(t):
    return _links(t)


@query("s11_discover", f"WITH {LINKS_SQL} SELECT link_id, page_id, pos, url FROM links QUALIFY row_number() OVER (PARTITION BY link_id ORDER BY page_id, pos) = 1")
def _(t):
    return pages.discover(_links(t))


@query("s11_discovery_log", f"""WITH {LINKS_SQL}, firsts AS (SELECT *, min(page_id) OVER (PARTITION BY link_id) AS f FROM links)
SELECT page_id, count(*) AS links, count(*) FILTER (page_id = f) AS new_links FROM firsts GROUP BY 1""")
def _(t):
    return pages.discovery_log(_links(t))


_TITLE = r"trim(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '\s+', ' ', 'g'))".replace('\\"', '"')


@query("s12_itemprop", f"SELECT page_id, nullif({_TITLE}, '') AS name, CAST(page_id AS VARCHAR) AS rating, NULL::VARCHAR AS absent FROM pages")
def _(t):
    marked = t.pages.withColumn("html", F.concat(F.replace("html", F.lit("<h1>"), F.lit('<h1 itemprop="name">')),
                                                 F.lit('<meta content="'), F.col("page_id").cast("string"), F.lit('" itemprop="ratingValue"/>')))
    html = F.col("html")
    return marked.select("page_id", pages.itemprop(html, "name").alias("name"), pages.itemprop(html, "ratingValue").alias("rating"),
                         pages.itemprop(html, "telephone").alias("absent"))


@query("s13_microdata_record", """
SELECT c_custkey, 'Casa ' || c_custkey AS restaurant_name, c_mktsegment AS category, CASE WHEN c_custkey % 3 <> 0 THEN '$$' END AS price_range,
  round(CAST((c_custkey % 5) + 0.5 AS DOUBLE), 6) AS overall_rating, round(CAST(c_nationkey * 1000 AS DOUBLE), 6) AS review_count, round(CAST(4.5 AS DOUBLE), 6) AS food_rating,
  CASE WHEN c_custkey % 2 = 0 THEN 'Calle ' || c_nationkey || ' - Bella Vista - Panamá' END AS address, CASE WHEN c_custkey % 2 = 0 THEN 'Bella Vista' END AS location FROM customer""")
def _(t):
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    html = F.concat(
        F.lit("<html><h1><b>Casa</b> "), key, F.lit('</h1><span itemprop="servesCuisine">'), F.col("c_mktsegment"), F.lit("</span>"),
        F.when(F.col("c_custkey") % 3 != 0, '<meta itemprop="priceRange" content="$$">').otherwise(""),
        F.lit('<div itemprop="aggregateRating"><span itemprop="ratingValue">'), (F.col("c_custkey") % 5).cast("string"), F.lit(",5</span> de <span itemprop='reviewCount'>"), nation,
        F.lit('K</span></div><div class="dg-reviews-stats">Comida 4.5 /5 Servicio 9 /5</div>'),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('<p itemprop="streetAddress">Calle '), nation, F.lit(" - Bella Vista - Panamá</p>"))).otherwise(""), F.lit("</html>"))
    out = pages.microdata_record(t.dealt("customer", "c_custkey").select("c_custkey", html.alias("html")), F.col("c_custkey"))
    return out.select("c_custkey", "restaurant_name", "category", "price_range", r6("overall_rating"), r6("review_count"), r6("food_rating"), "address", "location")


# one page per conversation, one review per turn
def _escaped(column: str):
    out = F.col(column)
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def review_pages(t, gaps: bool = False):
    day = F.lpad((F.col("turn") % 28 + 1).cast("string"), 2, "0")
    review = F.concat(
        F.lit('<div class="r" itemprop="review"><span itemprop="author">'), "role", F.lit('</span><div itemprop="reviewRating"><meta itemprop="ratingValue" content="'),
        (F.col("turn") % 5).cast("string"), F.lit(',5"></div><meta itemprop="datePublished" content="2024-01-'), day, F.lit('"><p itemprop="reviewBody">'), _escaped("text"), F.lit("</p></div>"))
    turns = t.conversations.select("conv_id", "turn", review.alias("r"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "r"))), lambda x: x["r"]), "\n")
    grouped = turns.groupBy("conv_id").agg(body.alias("b"))
    # with gaps, every fifth page has no reviews at all
    html = F.when(F.col("conv_id") % 5 == 0, "<p>empty</p>").otherwise(F.col("b")) if gaps else F.col("b")
    return grouped.select(F.col("conv_id").alias("page_id"), F.col("conv_id").alias("restaurant_id"), html.alias("html"))


REVIEWS_SQL = r"""reviews AS (SELECT conv_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS review_text, role AS reviewer_name, round(CAST((turn % 5) + 0.5 AS DOUBLE), 6) AS review_rating,
  '2024-01-' || lpad(CAST(turn % 28 + 1 AS VARCHAR), 2, '0') AS review_date FROM conversations WHERE length(trim(regexp_replace(text, '\s+', ' ', 'g'))) >= 10)"""


@query("s14_page_reviews", f"WITH {REVIEWS_SQL} SELECT * FROM reviews")
def _(t):
    out = review_pages(t).select(F.col("page_id").alias("conv_id"), F.inline(pages.microdata_reviews(F.col("html"))))
    return out.withColumn("review_rating", r6("review_rating"))


@query("s17_flatten_reviews", f"WITH {REVIEWS_SQL} SELECT 'dg_' || conv_id AS restaurant_id, review_text, reviewer_name, review_rating, review_date, 'site' AS source FROM reviews")
def _(t):
    out = pages.flatten_reviews(review_pages(t), pages.microdata_reviews(F.col("html")), "site", "dg_")
    return out.drop("page_id").withColumn("review_rating", r6("review_rating"))


@query("s17_flatten_outer", f"""WITH {REVIEWS_SQL.replace('WHERE length(', 'WHERE conv_id % 5 <> 0 AND length(')} SELECT 'ta_' || c.conv_id AS restaurant_id, review_text, review_rating, 'site' AS source
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN reviews USING (conv_id)""")
def _(t):
    out = pages.flatten_reviews(review_pages(t, gaps=True), pages.microdata_reviews(F.col("html")), "site", "ta_", keep_empty=True)
    return out.select("restaurant_id", "review_text", r6("review_rating"), "source")


@query("s15_json_ld", """
SELECT s_suppkey, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN round(s_acctbal, 6) END AS rating, '$$' AS price_range,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Pizza, Sushi' ELSE 'Pizza' END AS category, CASE WHEN s_suppkey % 4 = 0 THEN 'Paitilla' ELSE 'Calle ' || s_nationkey END AS location FROM supplier""")
def _(t):
    key = F.col("s_suppkey")
    block = lambda body: F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    place = F.when(key % 4 == 0, '{"addressLocality": "Paitilla", "streetAddress": "x"}').otherwise(
        F.concat(F.lit('{"addressLocality": "", "streetAddress": "Calle '), F.col("s_nationkey").cast("string"), F.lit('"}')))
    rating = F.when(key % 2 == 0, F.col("s_acctbal").cast("string")).otherwise("not a number")
    first = F.concat(F.lit('{"@type": "Restaurant", "name": "'), "s_name", F.lit('", "priceRange": "", "address": '), place, F.lit("}"))
    second = F.concat(F.lit('[{"name": "other"}, {"priceRange": "$$", "aggregateRating": {"ratingValue": "'), rating, F.lit('"}, "servesCuisine": '),
                      F.when(key % 3 == 0, '["Pizza", "Sushi"]').otherwise('"Pizza"'), F.lit("}]"))
    html = F.concat(block(F.lit("{broken")), F.lit("<p>x</p>"), block(first), block(second))
    out = t.supplier.select("s_suppkey", pages.json_ld(html).alias("m"))
    return out.select("s_suppkey", "m.name", r6("m.rating", "rating"), "m.price_range", "m.category", "m.location")


@query("s14_card_reviews", r"""
SELECT conv_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS review_text, CASE WHEN turn % 3 <> 0 THEN role END AS reviewer_name, CAST(NULL AS DOUBLE) AS review_rating,
  CASE WHEN turn % 2 = 0 THEN '2024-02-' || lpad(CAST(turn % 28 + 1 AS VARCHAR), 2, '0') ELSE 'hace ' || turn || ' meses' END AS review_date
FROM conversations WHERE length(trim(regexp_replace(text, '\s+', ' ', 'g'))) >= 10""")
def _(t):
    """Pages that mark reviews by class: bodies of three kinds, some without an author, dates for machines or for readers."""
    turn = F.col("turn")
    kind = F.when(turn % 3 == 0, "text").when(turn % 3 == 1, "text_full").otherwise("text_overflow")
    author = F.when(turn % 3 == 1, F.concat(F.lit('<a class="author_name">'), "role", F.lit("</a>"))).when(turn % 3 == 2, F.concat(F.lit('<i class="card author">'), "role", F.lit("</i>"))).otherwise("")
    date = F.when(turn % 2 == 0, F.concat(F.lit('<time datetime="2024-02-'), F.lpad((turn % 28 + 1).cast("string"), 2, "0"), F.lit('T08:00">x</time>'))).otherwise(
        F.concat(F.lit('<span class="user_date">hace '), turn.cast("string"), F.lit(" meses</span>")))
    card = F.concat(F.lit('<div class="o_review big"><p class="'), kind, F.lit('">'), _escaped("text"), F.lit("</p>"), author, date, F.lit("</div>"))
    grouped = t.conversations.select("conv_id", "turn", card.alias("r")).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "r"))).alias("cards"))
    html = F.array_join(F.transform("cards", lambda x: x["r"]), "\n")
    return grouped.select("conv_id", F.inline(pages.card_reviews(html)))


@query("s15_json_ld_record", """
SELECT s_suppkey, 'rg_' || substr(md5(lower(replace(s_name, '#', '-'))), 1, 10) AS restaurant_id, CASE WHEN s_suppkey % 3 = 0 THEN 'Titulo ' || s_suppkey ELSE s_name END AS restaurant_name,
  'Pizza' AS category, CAST(NULL AS VARCHAR) AS location, CASE WHEN s_suppkey % 2 = 0 THEN '$$' END AS price_range, round(s_acctbal, 6) AS overall_rating FROM supplier""")
def _(t):
    """Records with an id from the URL; where the block has no name, the heading gives it."""
    key = F.col("s_suppkey")
    name = F.when(key % 3 == 0, "").otherwise(F.col("s_name"))
    body = F.concat(F.lit('{"name": "'), name, F.lit('", "servesCuisine": "Pizza", "priceRange": "'), F.when(key % 2 == 0, "$$").otherwise(""),
                    F.lit('", "aggregateRating": {"ratingValue": '), F.col("s_acctbal").cast("string"), F.lit("}}"))
    html = F.concat(F.lit("<h1>Titulo "), key.cast("string"), F.lit('</h1><script type="application/ld+json">'), body, F.lit("</script>"))
    url = F.concat(F.lit("http://x.y/restaurante/"), F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))), F.when(key % 2 == 0, "/").otherwise(""))
    out = pages.json_ld_record(t.supplier.select("s_suppkey", html.alias("html"), url.alias("url")))
    return out.select("s_suppkey", "restaurant_id", "restaurant_name", "category", "location", "price_range", r6("overall_rating"))


@query("s16_review_date", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m-%d') WHEN 2 THEN 'hace ' || user_id || ' meses' ELSE 'mes ' || user_id END AS review_date FROM events""")
def _(t):
    stamp, day = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.date_format("ts", "yyyy-MM-dd")
    kind = F.col("event_id") % 4
    block = (F.when(kind == 0, F.concat(F.lit('<time datetime="'), stamp, F.lit('">hoy</time>')))
             .when(kind == 1, F.concat(F.lit('<span class="review-date">Publicado el '), day, F.lit(" por alguien que escribe mucho</span>")))
             .when(kind == 2, F.concat(F.lit('<span class="date">hace '), F.col("user_id").cast("string"), F.lit(" meses</span>")))
             .otherwise(F.concat(F.lit('<span class="date">un texto que es demasiado largo para ser una fecha</span><p class="x time">mes '), F.col("user_id").cast("string"), F.lit("</p>"))))
    return t.events.select("event_id", pages.review_date(block).alias("review_date"))


@query("s18_card_ratings", """
SELECT l_orderkey, l_linenumber, round(round(l_quantity) / 10, 6) AS bubble, round(CAST(l_linenumber + 0.5 AS DOUBLE), 6) AS spoken, CAST(l_partkey + 1000 AS BIGINT) AS reviews FROM lineitem""")
def _(t):
    css = F.concat(F.lit("ui_rating bubble_"), F.round("l_quantity").cast("int").cast("string"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", r6(parse.class_token_rating(css), "bubble"),
        r6(parse.first_decimal(F.concat(F.col("l_linenumber").cast("string"), F.lit(".5 of 5 bubbles"))), "spoken"),
        parse.grouped_count(F.concat(F.format_number(F.col("l_partkey") + 1000, 0), F.lit(" reviews"))).alias("reviews"))


# --- flagship ----------------------------------------------------------------

_FLAG = "\nUNION ALL ".join(
    f"SELECT '{a}' AS aspect, count(*) FILTER (n{i}) AS mentions, count(*) AS total, round(avg({score_of(f'l{i}')}) FILTER (n{i}), 6) AS mean, round(count(*) FILTER (n{i}) / count(*), 6) AS coverage FROM details"
    for i, a in enumerate(LEXICON.aspects, 1))


@query("flagship_aspect_summary", f"WITH {TOKENS_SQL} {_FLAG}")
def _(t):
    """Review texts to mention-aware means and coverage per aspect: one scan, one small aggregate."""
    wide = features.score_aspects(t.documents, LEXICON, "text")
    out = explore.aspect_summaries(wide, with_data_only=False)
    return out.select("aspect", "mentions", "total", r6("mean"), r6("coverage"))
