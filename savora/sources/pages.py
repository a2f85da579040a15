"""Reviews and metadata out of stored web pages, as column expressions."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from savora.functions import parse, text
from savora.functions.text import SPACE, U, blank_to_null, let
from savora.operators.ordering import keep_first

MIN_REVIEW_LENGTH = 10
LINK = r'(?is)<a\s[^>]*?href="([^"]*)"'

# Labels the site prints next to its aspect ratings.
SITE_ASPECTS = {"food_rating": "Comida", "service_rating": "Servicio", "ambiance_rating": "Ambiente"}


# --- links -------------------------------------------------------------------

def links(pages: DataFrame, keep: str | None = None, drop: Sequence[str] = (), base_url: str = "",
          link_id: str | None = None, page: str = "page_id") -> DataFrame:
    """Distinct links of every page in order of appearance: (page, pos, link_id, url).

    ``keep`` is a pattern the link must match, ``drop`` are words it must not
    contain, ``link_id`` extracts what makes a link distinct (else the URL does).
    """
    found = pages.select(page, F.posexplode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("pos", "href"))
    if keep:
        found = found.filter(F.col("href").rlike(keep))
    for word in drop:
        found = found.filter(~F.contains("href", F.lit(word)))
    identity = F.regexp_extract("href", link_id, 1) if link_id else F.col("href")
    found = found.withColumn("link_id", identity).filter(F.col("link_id") != "")
    first = found.groupBy(page, "link_id").agg(F.min("pos").alias("pos"), F.min_by("href", "pos").alias("href"))
    absolute = F.when(F.startswith("href", F.lit("http")), F.col("href")).otherwise(F.concat(F.lit(base_url), "href"))
    return first.select(page, "pos", "link_id", absolute.alias("url"))


def discover(page_links: DataFrame, page: str = "page_id", limit: int | None = None) -> DataFrame:
    """Union of the links of all listing pages; the first sighting of each wins."""
    seen = page_links.groupBy("link_id").agg(F.min_by(F.struct(page, "pos", "url"), F.struct(page, "pos")).alias("s"))
    out = seen.select("link_id", f"s.{page}", "s.pos", "s.url")
    return out.orderBy(page, "pos").limit(limit) if limit else out


def discovery_log(page_links: DataFrame, page: str = "page_id") -> DataFrame:
    """Links per page and how many of them no earlier page had."""
    first = page_links.groupBy("link_id").agg(F.min(page).alias("_first"))
    return (page_links.join(first, "link_id").groupBy(page)
            .agg(F.count("*").alias("links"), F.count_if(F.col(page) == F.col("_first")).alias("new_links")))


# --- microdata ---------------------------------------------------------------

def inner_text(html: Column) -> Column:
    """Text without tags, common entities decoded, white space squeezed."""
    plain = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " ")
    plain = F.regexp_replace(plain, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return text.squeeze(plain)


def _attribute(tag: Column, name: str) -> Column:
    return blank_to_null(F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*["']([^"']*)["']""", 1))


def _tag_with(html: Column, marker: str) -> Column:
    return blank_to_null(F.regexp_extract(html, rf"(?is)<[^>]*?{marker}[^>]*>", 0))


def _body_of(html: Column, marker: str) -> Column:
    """Inside of the first element whose tag matches ``marker``."""
    return F.regexp_extract(html, rf"(?is)<([a-z][a-z0-9]*)\b[^>]*?{marker}[^>]*>(.*?)</\1\s*>", 2)


def _prop(prop: str) -> str:
    return rf"""\bitemprop\s*=\s*["']{prop}["']"""


def _class(name: str) -> str:
    return rf"""\bclass\s*=\s*["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["']"""


def itemprop(html: Column, prop: str) -> Column:
    """Value of the first element with this property: its content, else its text."""
    content = _attribute(_tag_with(html, _prop(prop)), "content")
    value = F.coalesce(content, inner_text(_body_of(html, _prop(prop))))
    return blank_to_null(text.strip(value))


def heading(html: Column) -> Column:
    return blank_to_null(inner_text(F.regexp_extract(html, r"(?is)<h1\b[^>]*>(.*?)</h1>", 1)))


def _from(html: Column, marker: str) -> Column:
    """The page from the first element that matches ``marker`` on; '' without one."""
    return F.regexp_extract(html, rf"(?is)<[^>]*?{marker}[^>]*>.*", 0)


def microdata_record(pages: DataFrame, entity_id: Column, html: str = "html") -> DataFrame:
    """One metadata row per detail page."""
    page = F.col(html)
    # pieces that several fields read are columns of their own, found once per page
    pieces = {"_aggregate": _from(page, _prop("aggregateRating")), "_stats": inner_text(_from(page, _class("dg-reviews-stats"))),
              "_street": F.coalesce(itemprop(page, "streetAddress"), itemprop(page, "address"))}
    aggregate, stats, street = map(F.col, pieces)
    zone = F.coalesce(parse.zone_of_address(street), itemprop(page, "addressRegion"))
    return pages.withColumns(pieces).select(
        "*", entity_id.cast("string").alias("restaurant_id"), heading(page).alias("restaurant_name"),
        itemprop(page, "servesCuisine").alias("category"), itemprop(page, "priceRange").alias("price_range"),
        parse.number_with_suffix(itemprop(aggregate, "ratingValue")).alias("overall_rating"),
        parse.number_with_suffix(itemprop(aggregate, "reviewCount")).alias("review_count"),
        *[parse.labelled_rating(stats, label).alias(name) for name, label in SITE_ASPECTS.items()],
        street.alias("address"), F.when(street.isNotNull(), zone).alias("location")).drop(*pieces)


def _blocks(html: Column, marker: str) -> Column:
    """One piece of page per element that matches ``marker``, up to the next one."""
    return F.filter(F.split(html, rf"(?is)<[^>]*?{marker}[^>]*>", -1), lambda piece, i: i > 0)


def microdata_reviews(html: Column) -> Column:
    """Array of the reviews of a page that say at least ten characters."""
    def review(block: Column) -> Column:
        rating = F.coalesce(itemprop(_from(block, _prop("reviewRating")), "ratingValue"), itemprop(block, "ratingValue"))
        return F.struct(
            inner_text(_body_of(block, _prop("reviewBody"))).alias("review_text"),
            blank_to_null(inner_text(_body_of(block, _prop("author")))).alias("reviewer_name"),
            parse.number_with_suffix(rating).alias("review_rating"),
            itemprop(block, "datePublished").alias("review_date"))
    found = F.transform(_blocks(html, _prop("review")), review)
    return F.filter(found, lambda r: F.length(r["review_text"]) >= MIN_REVIEW_LENGTH)


def card_reviews(html: Column) -> Column:
    """The same for pages that mark reviews by class instead of property."""
    def review(block: Column) -> Column:
        bodies = [blank_to_null(inner_text(_body_of(block, _class(c)))) for c in ("text_full", "text_overflow", "text")]
        author = F.coalesce(*[blank_to_null(inner_text(_body_of(block, _class(c)))) for c in ("author_name", "name")],
                            blank_to_null(inner_text(_body_of(block, r"""\bclass\s*=\s*["'][^"']*author[^"']*["']"""))))
        return F.struct(F.coalesce(*bodies).alias("review_text"), author.alias("reviewer_name"),
                        F.lit(None).cast("double").alias("review_rating"), review_date(block).alias("review_date"))
    found = F.transform(_blocks(html, _class("o_review")), review)
    return F.filter(found, lambda r: F.length(r["review_text"]) >= MIN_REVIEW_LENGTH)


MACHINE_DATE = r"""(?is)(<meta\b[^>]*\bitemprop\s*=\s*["']datePublished["'][^>]*>|<time\b[^>]*\bdatetime\s*=[^>]*>)"""
# a time element, or one whose class holds "date" or is "time", and what is inside it
SHOWN_DATE = (r"""(?is)<(?:(time)\b[^>]*|(\w+)\b[^>]*\bclass\s*=\s*["'](?:[^"']*date[^"']*|(?:[^"']*\s)?time(?:\s[^"']*)?)["'][^>]*)>"""
              r"""(.*?)</(?:\1|\2)\s*>""")


def review_date(block: Column) -> Column:
    """Machine-readable date, else of the shown elements the first with an ISO date or a short text."""
    tag = F.regexp_extract(block, MACHINE_DATE, 1)
    machine = F.coalesce(_attribute(tag, "content"), _attribute(tag, "datetime"))

    def shown(body: Column) -> Column:
        iso = blank_to_null(F.regexp_extract(body, r"\d{4}-\d{2}-\d{2}", 0))
        return F.coalesce(iso, F.when(F.length(body) <= 40, blank_to_null(body)))
    bodies = F.transform(F.regexp_extract_all(block, F.lit(SHOWN_DATE), F.lit(3)), lambda x: shown(inner_text(x)))
    return F.coalesce(F.substring(machine, 1, 10), F.get(F.array_compact(bodies), F.lit(0)))


# --- JSON-LD -----------------------------------------------------------------

def json_ld(html: Column) -> Column:
    """Struct (name, rating, price_range, category, location) of the page's blocks.

    A block is an object or a list; for every field the first non-empty value in
    page order wins, and a block that is not JSON is skipped.
    """
    blocks = F.regexp_extract_all(html, F.lit(
        r"""(?is)<script[^>]*type\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))
    objects = F.flatten(F.transform(blocks, lambda b: F.coalesce(
        F.when(F.startswith(text.strip(b), F.lit("[")), F.from_json(b, "array<string>")).otherwise(F.array(b)),
        F.array().cast("array<string>"))))

    def first(found: Column, pick) -> Column:
        values = F.filter(F.transform(found, pick), lambda v: v.isNotNull())
        return F.get(values, F.lit(0))

    def value(path: str):
        return lambda o: blank_to_null(F.get_json_object(o, path))

    def cuisine(o: Column) -> Column:
        raw = blank_to_null(F.get_json_object(o, "$.servesCuisine"))
        listed = blank_to_null(F.array_join(F.from_json(raw, "array<string>"), ", "))
        return F.when(F.startswith(raw, F.lit("[")), listed).otherwise(raw)

    def place(o: Column) -> Column:
        return F.coalesce(value("$.address.addressLocality")(o), value("$.address.streetAddress")(o))

    return let(objects, lambda found: F.struct(
        first(found, value("$.name")).alias("name"),
        first(found, lambda o: value("$.aggregateRating.ratingValue")(o).try_cast("double")).alias("rating"),
        first(found, value("$.priceRange")).alias("price_range"),
        first(found, cuisine).alias("category"),
        first(found, place).alias("location")))


def json_ld_record(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One metadata row per detail page, its id built from the last part of the URL."""
    slug = F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)
    meta = F.col("_meta")
    return (pages.withColumn("_meta", json_ld(F.col(html)))
            .withColumns({
                "restaurant_id": text.stable_id(slug, "rg_"),
                "restaurant_name": F.coalesce(meta["name"], heading(F.col(html))),
                "category": meta["category"], "location": meta["location"],
                "price_range": meta["price_range"], "overall_rating": meta["rating"]})
            .drop("_meta"))


# --- pages to rows -----------------------------------------------------------

def flatten_reviews(records: DataFrame, reviews: Column, source: str, id_prefix: str = "",
                    keep_empty: bool = False) -> DataFrame:
    """One row per review with its page's metadata.

    ``keep_empty`` keeps a page without reviews as one row with NULL review fields.
    """
    explode = F.inline_outer if keep_empty else F.inline
    columns = [c for c in records.columns if c not in ("html", "restaurant_id")]
    return records.select(
        F.concat(F.lit(id_prefix), F.col("restaurant_id").cast("string")).alias("restaurant_id"),
        *columns, explode(reviews), ).withColumn("source", F.lit(source))
