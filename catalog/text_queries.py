"""Scalar functions and row-level projections over texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, r6
from savora import fixed_values as fixed
from savora.functions import parse, scores, sentiment, text
from savora.operators import clean, explore, features, normalize, unify
from savora.operators.ordering import keep_first
from savora.sources import tables as stored

REFERENCE_DATE = "2026-07-19"
KEY = "trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', ' ', 'g'))"
NAME_KEY = ("trim(regexp_replace(regexp_replace(lower(strip_accents({0})), "
            r"'\b(restaurante?|resto|bar|grill|cafe)\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))")
SQUEEZED = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"


def sql_list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


# --- F01-F13 -----------------------------------------------------------------

@query("f01_accent_fold", "SELECT doc_id, md5(strip_accents(text)) AS folded FROM documents")
def _(t):
    return t.documents.select("doc_id", F.md5(text.fold_accents(F.col("text"))).alias("folded"))


@query("f02_name_key", f"SELECT review_id, {NAME_KEY.format('restaurant_name')} AS name_key FROM texts", "texts")
def _(t):
    return t.texts.select("review_id", text.name_key(F.col("restaurant_name")).alias("name_key"))


@query("f03_review_key", f"SELECT doc_id, md5({KEY.format('text')}) AS text_key, length({KEY.format('text')}) AS key_length FROM documents")
def _(t):
    key = text.review_key(F.col("text"))
    return t.documents.select("doc_id", F.md5(key).alias("text_key"), F.length(key).cast("long").alias("key_length"))


@query("f04_stable_id", f"""
SELECT review_id, 'r_' || substr(md5({NAME_KEY.format('restaurant_name')}), 1, 10) AS entity_id,
       'rg_' || substr(md5(restaurant_id), 1, 10) AS slug_id, 'dg_' || restaurant_id AS prefixed_id FROM texts""", "texts")
def _(t):
    return t.texts.select("review_id", text.stable_id(text.name_key(F.col("restaurant_name"))).alias("entity_id"),
                          text.stable_id(F.col("restaurant_id"), "rg_").alias("slug_id"),
                          F.concat(F.lit("dg_"), "restaurant_id").alias("prefixed_id"))


CLEAN = (r"regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace({0}, 'http\S+|www\.\S+', '', 'g'), "
         r"'<[^>]+>', '', 'g'), '\s+', ' ', 'g')), '[^\p{{L}}\p{{N}}_\s.,!?¡¿]', '', 'g')")


@query("f05_clean_text", f"SELECT doc_id, {CLEAN.format('text')} AS cleaned FROM documents")
def _(t):
    return t.documents.select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


RELATIVE = f"""
CASE WHEN regexp_matches(review_date, '(?i)hace\\s+(un|una|\\d+)\\s*mes') THEN
       CAST(TIMESTAMP '{REFERENCE_DATE}' - to_months(CAST(regexp_extract(review_date, '(\\d+)', 1) AS INTEGER)) AS TIMESTAMP)
     WHEN regexp_matches(review_date, '(?i)hace\\s+un\\s*año') THEN TIMESTAMP '2025-07-19' END"""


@query("f06_relative_date", f"SELECT review_id, {RELATIVE} AS parsed FROM texts", "texts")
def _(t):
    return t.texts.select("review_id", parse.relative_date(F.col("review_date"), F.lit(REFERENCE_DATE).cast("timestamp_ntz")).alias("parsed"))


@query("f07_mixed_date", f"""
SELECT review_id, coalesce({RELATIVE}, TRY_CAST(review_date AS TIMESTAMP)) AS parsed FROM texts""", "texts")
def _(t):
    return t.texts.select("review_id", parse.mixed_date(F.col("review_date"), F.lit(REFERENCE_DATE).cast("timestamp_ntz")).alias("parsed"))


@query("f08_normalize_text", f"SELECT doc_id, {SQUEEZED.format('strip_accents(lower(text))')} AS normalized FROM documents")
def _(t):
    return t.documents.select("doc_id", text.normalize_text(F.col("text")).alias("normalized"))


@query("f09_remove_stopwords", f"""
SELECT doc_id, array_to_string(list_filter(regexp_extract_all({SQUEEZED.format('strip_accents(lower(text))')}, '\\S+'),
       lambda w: w NOT IN {sql_list(fixed.MODEL_STOPWORDS)}), ' ') AS kept FROM documents""")
def _(t):
    body = text.normalize_text(F.col("text"))
    return t.documents.select("doc_id", text.remove_stopwords(body, fixed.MODEL_STOPWORDS).alias("kept"))


@query("f10_tokenize", r"""
SELECT doc_id, CAST(len(k) AS BIGINT) AS tokens, md5(array_to_string(k, '|')) AS digest
FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]') AS k FROM documents)""")
def _(t):
    tokens = t.documents.select("doc_id", text.tokenize(F.col("text")).alias("k"))
    return tokens.select("doc_id", F.size("k").cast("long").alias("tokens"), F.md5(F.array_join("k", "|")).alias("digest"))


def _hits(words) -> str:
    return "(" + " + ".join(f"CAST(contains(lower(text), '{w}') AS INT)" for w in words) + ")"


@query("f11_detect_language", f"""
SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 'unknown' WHEN {_hits(fixed.SPANISH_INDICATORS)} > {_hits(fixed.ENGLISH_INDICATORS)} THEN 'spanish'
  WHEN {_hits(fixed.ENGLISH_INDICATORS)} > {_hits(fixed.SPANISH_INDICATORS)} THEN 'english' ELSE 'mixed' END AS review_language FROM documents""")
def _(t):
    return t.documents.select("doc_id", text.detect_language(F.col("text")).alias("review_language"))


@query("f12_text_stats", r"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS word_count, CAST(length(text) AS BIGINT) AS char_count,
  round(length(regexp_replace(text, '\s+', '', 'g')) / greatest(len(regexp_extract_all(text, '\S+')), 1), 6) AS avg_word_length FROM documents""")
def _(t):
    out = normalize.add_text_features(t.documents.withColumnRenamed("text", "review_text"))
    return out.select("doc_id", "word_count", "char_count", r6("avg_word_length"))


@query("f13_slug", r"""
SELECT p_partkey, coalesce(nullif(regexp_replace(substr(regexp_replace(regexp_replace(lower(strip_accents(x)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 24), '_+$', '', 'g'), ''), 'otros') AS slug
FROM (SELECT p_partkey, concat('¡', p_name, ' (', p_brand, ') — ', p_type, ' Ñandú') AS x FROM part)""")
def _(t):
    label = F.concat(F.lit("¡"), "p_name", F.lit(" ("), "p_brand", F.lit(") — "), "p_type", F.lit(" Ñandú"))
    return t.part.select("p_partkey", text.slug(label).alias("slug"))


# --- F14-F16, P04-P09 --------------------------------------------------------

@query("f14_number_with_suffix", r"""
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_linenumber % 3 = 0 THEN 1000 ELSE 1 END * (CASE WHEN l_linenumber % 3 = 1 THEN round(l_quantity) + 0.5 ELSE round(l_quantity) END), 6) AS parsed FROM lineitem""")
def _(t):
    q = F.round("l_quantity").cast("int").cast("string")
    written = (F.when(F.col("l_linenumber") % 3 == 0, F.concat(q, F.lit("K reseñas")))
               .when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("nota "), q, F.lit(",5 / 5")))
               .otherwise(F.concat(q, F.lit(" de 50"))))
    return t.lineitem.select("l_orderkey", "l_linenumber", r6(parse.number_with_suffix(written), "parsed"))


@query("f15_zone_of_address", """
SELECT review_id, CASE WHEN address LIKE 'Calle%' THEN 'Bella Vista' WHEN address LIKE 'Local%' THEN split_part(address, ' - ', 2) END AS zone FROM texts""", "texts")
def _(t):
    return t.texts.select("review_id", parse.zone_of_address(F.col("address")).alias("zone"))


@query("f16_labelled_ratings", """
SELECT o_orderkey, CAST(CASE WHEN q <= 5 THEN q END AS DOUBLE) AS food, round(CAST((q % 5) + 0.5 AS DOUBLE), 6) AS service
FROM (SELECT o_orderkey, o_orderkey % 9 AS q FROM orders)""")
def _(t):
    q = F.col("o_orderkey") % 9
    page = F.concat(F.lit("Comida "), q.cast("string"), F.lit(" /5 Servicio "), (q % 5).cast("string"), F.lit(",5 /5"))
    return t.orders.select("o_orderkey", parse.labelled_rating(page, "Comida").alias("food"),
                           r6(parse.labelled_rating(page, "Servicio"), "service"))


@query("p04_coerce_ratings", """
SELECT review_id, round(CASE WHEN review_id % 9 = 0 THEN NULL ELSE n_chars / 10 END, 6) AS overall_rating FROM texts""", "texts")
def _(t):
    written = t.texts.withColumn("overall_rating", F.when(F.col("review_id") % 9 == 0, "n/a").otherwise(
        (F.col("n_chars") / 10).cast("string")))
    return clean.coerce_ratings(written).select("review_id", r6("overall_rating"))


@query("p05_trim_price", "SELECT review_id, trim(price_range) AS price_range FROM texts", "texts")
def _(t):
    return t.texts.select("review_id", text.strip(F.col("price_range")).alias("price_range"))


LEVEL = """CASE WHEN lower(trim(price_range)) IN ('hasta $15', 'menos de $15', '$', 'cheap eats') THEN 1.0
 WHEN lower(trim(price_range)) IN ('desde $15 hasta $25', '$$', '$$ - $$$', 'mid-range') THEN 2.0
 WHEN lower(trim(price_range)) IN ('desde $25 hasta $35', '$$$', '$$$ - $$$$') THEN 3.0
 WHEN lower(trim(price_range)) IN ('mas de $35', 'más de $35', '$$$$', 'fine dining') THEN 4.0 END"""


@query("p06_price_level", f"SELECT review_id, CAST({LEVEL} AS DOUBLE) AS price_level FROM texts", "texts")
def _(t):
    return t.texts.select("review_id", parse.price_level(F.col("price_range")).alias("price_level"))


@query("p07_price_band", f"""
SELECT review_id, CASE {LEVEL} WHEN 1 THEN '$ (hasta $15)' WHEN 2 THEN '$$ ($15-$25)' WHEN 3 THEN '$$$ ($25-$35)'
  WHEN 4 THEN '$$$$ (mas de $35)' END AS price_band FROM texts""", "texts")
def _(t):
    return clean.add_price_band(t.texts).select("review_id", "price_band")


@query("p08_primary_category", "SELECT review_id, nullif(trim(split_part(category, ',', 1)), '') AS category_primary FROM texts", "texts")
def _(t):
    return clean.add_primary_category(t.texts).select("review_id", "category_primary")


@query("p09_split_categories", r"SELECT review_id, regexp_replace(category, '\s*[·/|]\s*', ', ', 'g') AS category FROM texts", "texts")
def _(t):
    return t.texts.select("review_id", parse.split_categories(F.col("category")).alias("category"))


# --- filters on rows ---------------------------------------------------------

@query("p01_required_fields", """
SELECT review_id FROM (SELECT review_id, CASE WHEN review_id % 5 = 0 THEN NULL ELSE restaurant_name END AS n FROM texts) WHERE n IS NOT NULL""", "texts")
def _(t):
    gaps = t.texts.withColumn("restaurant_name", F.when(F.col("review_id") % 5 != 0, F.col("restaurant_name")))
    return clean.require_fields(gaps).select("review_id")


@query("p02_min_length", f"SELECT doc_id FROM documents WHERE length({KEY.format('text')}) >= 10")
def _(t):
    return unify.long_enough(t.documents, text.review_key(F.col("text"))).select("doc_id")


@query("p03_blank_key", f"""
SELECT review_id, coalesce(nullif({NAME_KEY.format("CASE WHEN review_id % 4 = 0 THEN 'Café Bar' ELSE restaurant_name END")}, ''), restaurant_id) AS restaurant_key FROM texts""", "texts")
def _(t):
    named = t.texts.withColumn("restaurant_name", F.when(F.col("review_id") % 4 == 0, "Café Bar").otherwise(F.col("restaurant_name")))
    return unify.unify_restaurants(named).select("review_id", "restaurant_key")


# --- translations and display ------------------------------------------------

@query("p23_translate_values", """
SELECT doc_id, CASE lang WHEN 'en' THEN 'Inglés' WHEN 'es' THEN 'Español' ELSE lang END AS "Idioma", source AS "Fuente" FROM documents""")
def _(t):
    out = t.documents.select("doc_id", text.translate_value(F.col("lang")).alias("review_language"), "source")
    return out.withColumnsRenamed({c: fixed.COLUMN_LABELS[c] for c in out.columns if c in fixed.COLUMN_LABELS})


@query("p24_translate_phrases", """
SELECT doc_id, CASE WHEN text = 'the' THEN 'EXACT' WHEN starts_with(text, 'The ') THEN 'PREFIX'
  ELSE replace(replace(text, 'the', 'el'), 'el and', 'el y') END AS shown FROM documents""")
def _(t):
    shown = text.translate_phrases(F.col("text"), {"the": "EXACT"}, [("The ", "PREFIX")], [("the", "el"), ("el and", "el y")])
    return t.documents.select("doc_id", shown.alias("shown"))


@query("p33_preview", "SELECT doc_id, CASE WHEN length(text) > 220 THEN substr(text, 1, 220) || '...' ELSE text END AS preview FROM documents")
def _(t):
    return t.documents.select("doc_id", text.preview(F.col("text"), 220).alias("preview"))


# --- lexicon sentiment -------------------------------------------------------

# Words that do occur in the given texts, in the four roles.
LEXICON = sentiment.Lexicon(
    aspects={"comida": ("the", "der", "le"), "servicio": ("and", "und", "et"),
             "precio": ("of", "von"), "ambiente": ("in", "mit", "dans", "the")},
    phrases={"precio": ("de la", "with the")},
    positive=("that", "la", "die", "on", "of"), negative=("on", "das", "un", "by", "que"),
    negators=("was", "est", "is"), intensifiers=("for", "por", "ist", "des"))

TOKENS_SQL = rf"""
tokens AS (SELECT doc_id, low, unnest(k) AS w, generate_subscripts(k, 1) AS i
  FROM (SELECT doc_id, lower(text) AS low, regexp_extract_all(lower(text), '[{fixed.WORD_LETTERS}]+') AS k FROM documents)),
coded AS (SELECT doc_id, i,
  CASE WHEN w IN ('that', 'la', 'die', 'on', 'of') THEN 1.0 WHEN w IN ('das', 'un', 'by', 'que') THEN -1.0 ELSE 0.0 END AS p,
  w IN ('was', 'est', 'is') AS neg, w IN ('for', 'por', 'ist', 'des') AS strong,
  w IN ('the', 'der', 'le') AS m1, w IN ('and', 'und', 'et') AS m2,
  (w IN ('of', 'von') OR (w = 'de' AND contains(low, 'de la')) OR (w = 'with' AND contains(low, 'with the'))) AS m3,
  w IN ('in', 'mit', 'dans', 'the') AS m4 FROM tokens),
placed AS (SELECT *, CASE WHEN m1 THEN 1 WHEN m2 THEN 2 WHEN m3 THEN 3 WHEN m4 THEN 4 END AS a FROM coded),
polar AS (SELECT doc_id, i, m1, m2, m3, m4, p
   * CASE WHEN coalesce(lag(neg, 1) OVER x, false) OR coalesce(lag(neg, 2) OVER x, false) OR coalesce(lag(neg, 3) OVER x, false) THEN -1 ELSE 1 END
   * CASE WHEN coalesce(lag(strong, 1) OVER x, false) OR coalesce(lag(strong, 2) OVER x, false) THEN 1.5 ELSE 1 END AS pol,
  coalesce(lag(a, 1) OVER x, lead(a, 1) OVER x, lag(a, 2) OVER x, lead(a, 2) OVER x, lag(a, 3) OVER x, lead(a, 3) OVER x,
           lag(a, 4) OVER x, lag(a, 5) OVER x, lag(a, 6) OVER x) AS near
  FROM placed WINDOW x AS (PARTITION BY doc_id ORDER BY i)),
summed AS (SELECT doc_id, sum(pol) AS total, bool_or(m1) AS n1, bool_or(m2) AS n2, bool_or(m3) AS n3, bool_or(m4) AS n4,
  coalesce(sum(pol) FILTER (near = 1), 0) AS s1, coalesce(sum(pol) FILTER (near = 2), 0) AS s2,
  coalesce(sum(pol) FILTER (near = 3), 0) AS s3, coalesce(sum(pol) FILTER (near = 4), 0) AS s4 FROM polar GROUP BY doc_id),
details AS (SELECT d.doc_id,
  CASE WHEN coalesce(n1, false) THEN CASE WHEN s1 > 0 THEN 'positive' WHEN s1 < 0 THEN 'negative' ELSE 'neutral' END
       ELSE CASE WHEN total > 0 THEN 'positive' WHEN total < 0 THEN 'negative' ELSE 'neutral' END END AS l1,
  CASE WHEN n2 THEN CASE WHEN s2 > 0 THEN 'positive' WHEN s2 < 0 THEN 'negative' ELSE 'neutral' END ELSE 'neutral' END AS l2,
  CASE WHEN n3 THEN CASE WHEN s3 > 0 THEN 'positive' WHEN s3 < 0 THEN 'negative' ELSE 'neutral' END ELSE 'neutral' END AS l3,
  CASE WHEN n4 THEN CASE WHEN s4 > 0 THEN 'positive' WHEN s4 < 0 THEN 'negative' ELSE 'neutral' END ELSE 'neutral' END AS l4,
  coalesce(n1, false) AS n1, coalesce(n2, false) AS n2, coalesce(n3, false) AS n3, coalesce(n4, false) AS n4, coalesce(total, 0) AS total
  FROM documents d LEFT JOIN summed USING (doc_id))"""


def score_of(label: str) -> str:
    return f"CASE {label} WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END"


@query("f21_lexicon_score", f"WITH {TOKENS_SQL} SELECT doc_id, round(CAST(total AS DOUBLE), 6) AS score FROM details")
def _(t):
    return t.documents.select("doc_id", r6(sentiment.lexicon_score(F.col("text"), LEXICON), "score"))


@query("f22_aspect_attribution", f"""WITH {TOKENS_SQL}
SELECT doc_id, l1 AS comida, l2 AS servicio, l3 AS precio, l4 AS ambiente, n1 AS mentions_comida, n2 AS mentions_servicio,
  n3 AS mentions_precio, n4 AS mentions_ambiente FROM details""")
def _(t):
    detailed = t.documents.select("doc_id", sentiment.aspect_details(F.col("text"), LEXICON).alias("d"))
    return detailed.select("doc_id", *[F.col(f"d.{a}.label").alias(a) for a in LEXICON.aspects],
                           *[F.col(f"d.{a}.mentioned").alias(f"mentions_{a}") for a in LEXICON.aspects])


@query("w14_neighbour_words", f"""WITH {TOKENS_SQL}
SELECT doc_id, count(*) FILTER (pol <> 0) AS polar_words, count(*) FILTER (abs(pol) = 1.5) AS stressed,
  round(CAST(coalesce(sum(pol) FILTER (pol > 0), 0) AS DOUBLE), 6) AS positive_sum FROM documents LEFT JOIN polar USING (doc_id) GROUP BY doc_id""")
def _(t):
    codes = sentiment._word_codes(F.lower("text"), LEXICON)
    words = text.let(codes, lambda c: F.transform(sentiment._polar_positions(c), lambda i: sentiment._double_polarity(c, i) / 2))
    rows = t.documents.select("doc_id", words.alias("pol"))
    gains = F.aggregate(F.filter("pol", lambda p: p > 0), F.lit(0.0), lambda a, p: a + p)
    return rows.select("doc_id", F.size("pol").cast("long").alias("polar_words"), F.size(F.filter("pol", lambda p: F.abs(p) == 1.5)).cast("long").alias("stressed"),
                       r6(gains, "positive_sum"))


@query("j09_nearest_mention", f"""WITH {TOKENS_SQL}
SELECT doc_id, near AS aspect, count(*) AS words, round(CAST(sum(pol) AS DOUBLE), 6) AS score FROM polar WHERE pol <> 0 AND near IS NOT NULL GROUP BY 1, 2""")
def _(t):
    """Which mention every polar word joins, counted per document and aspect."""
    codes = sentiment._word_codes(F.lower("text"), LEXICON)
    hits = text.let(codes, lambda c: F.transform(sentiment._polar_positions(c), lambda i: F.struct(
        (sentiment._nearest_aspect(c, i, LEXICON) + 1).alias("aspect"), (sentiment._double_polarity(c, i) / 2).alias("pol"))))
    return (t.documents.select("doc_id", F.inline(hits)).filter("aspect IS NOT NULL").groupBy("doc_id", "aspect")
            .agg(F.count("*").alias("words"), r6(F.sum("pol"), "score")))


SENTENCE_WORDS = ("the", "and")


@query("f23_sentence_label", rf"""
WITH s AS (SELECT doc_id, array_to_string(list_filter(string_split(text, '.'), lambda x: contains(lower(x), 'the') OR contains(lower(x), 'and')), ' ') AS body,
  len(list_filter(string_split(text, '.'), lambda x: contains(lower(x), 'the') OR contains(lower(x), 'and'))) AS n FROM documents),
counts AS (SELECT doc_id, n, len(list_filter(k, lambda w: w IN ('that', 'la', 'die'))) - len(list_filter(k, lambda w: w IN ('on', 'das', 'un'))) AS score
  FROM (SELECT doc_id, n, regexp_extract_all(lower(body), '[{fixed.WORD_LETTERS}]+') AS k FROM s))
SELECT doc_id, CASE WHEN n = 0 THEN 'neutral' WHEN score / sqrt(score * score + 15.0) >= 0.05 THEN 'positive'
  WHEN score / sqrt(score * score + 15.0) <= -0.05 THEN 'negative' ELSE 'neutral' END AS label FROM counts""")
def _(t):
    plain = sentiment.Lexicon(aspects={"comida": ("the",)}, positive=("that", "la", "die"), negative=("on", "das", "un"),
                              negators=("#",), intensifiers=("#",))
    label = sentiment.sentence_label(F.col("text"), SENTENCE_WORDS, lambda c: sentiment.bounded_polarity(c, plain))
    return t.documents.select("doc_id", label.alias("label"))


@query("f24_first_available", f"""WITH {TOKENS_SQL}
SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN 'positive' END, CASE WHEN doc_id % 3 = 1 THEN l2 END, 'neutral') AS label FROM details""")
def _(t):
    detailed = t.documents.withColumn("d", sentiment.aspect_details(F.col("text"), LEXICON))
    return detailed.select("doc_id", sentiment.first_available(
        F.when(F.col("doc_id") % 3 == 0, "positive"), F.when(F.col("doc_id") % 3 == 1, F.col("d.servicio.label"))).alias("label"))


@query("f25_rating_class", """
SELECT review_id, CASE WHEN review_rating >= 4 THEN 'positiva' ELSE 'no positiva' END AS actual FROM texts
WHERE review_rating IS NOT NULL AND trim(review_text) <> ''""", "texts")
def _(t):
    from savora.operators.textmodel import labelled_reviews
    return labelled_reviews(t.texts).select("review_id", "actual")


@query("f26_lexicon_class", f"""WITH {TOKENS_SQL}
SELECT doc_id, CASE WHEN coalesce((CASE WHEN n1 THEN {score_of('l1')} ELSE 0 END + CASE WHEN n2 THEN {score_of('l2')} ELSE 0 END
   + CASE WHEN n3 THEN {score_of('l3')} ELSE 0 END + CASE WHEN n4 THEN {score_of('l4')} ELSE 0 END)
   / nullif(CAST(n1 AS INT) + CAST(n2 AS INT) + CAST(n3 AS INT) + CAST(n4 AS INT), 0), {score_of('l1')}) > 0
   THEN 'positiva' ELSE 'no positiva' END AS predicted FROM details""")
def _(t):
    from savora.operators.textmodel import lexicon_predictions
    return lexicon_predictions(t.documents, LEXICON, "text").select("doc_id", "predicted")


_RESPONSE = ("CASE conv_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'no json here' "
             "ELSE concat('Sure:\n{{\"comida\": \"', CASE turn % 2 WHEN 0 THEN 'Positive' ELSE 'negative' END, "
             "'\", \"precio\": \"', CASE conv_id % 3 WHEN 0 THEN 'negative' ELSE 'neutral' END, '\"}}\ndone') END").format()


@query("f27_external_answers", f"""
WITH r AS (SELECT conv_id, turn, {_RESPONSE} AS response FROM conversations),
p AS (SELECT conv_id, turn, response, CASE WHEN conv_id % 4 < 2 THEN 'neutral' WHEN turn % 2 = 0 THEN 'positive' ELSE 'negative' END AS comida,
  CASE WHEN conv_id % 4 < 2 THEN 'neutral' WHEN conv_id % 3 = 0 THEN 'negative' ELSE 'neutral' END AS precio FROM r)
SELECT conv_id, turn, comida, precio, CASE WHEN response IS NULL OR {score_of('comida')} + {score_of('precio')} > 0 THEN 'positiva' ELSE 'no positiva' END AS predicted FROM p""")
def _(t):
    told = t.conversations.select("conv_id", "turn", F.expr(_RESPONSE).alias("response"))
    read = told.withColumn("answer", parse.external_labels(F.col("response")))
    label = lambda a: F.lower(F.coalesce(F.try_element_at("answer", F.lit(a)), F.lit("neutral"))).alias(a)
    return read.select("conv_id", "turn", label("comida"), label("precio"),
                       sentiment.external_class(F.col("response"), F.col("answer")).alias("predicted"))


# --- stored maps -------------------------------------------------------------

_CELL = "CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'garbage' ELSE concat('{\\'comida\\': \\'', CASE doc_id % 3 WHEN 0 THEN 'Positive' ELSE 'negative' END, '\\', \\'precio\\': \\'neutral\\'}') END"
_FLAGS = "CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'garbage' ELSE concat('{\\'comida\\': ', CASE doc_id % 3 WHEN 0 THEN 'True' ELSE 'False' END, '}') END"


@query("p18_stored_labels", """
SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN 'neutral' WHEN doc_id % 3 = 0 THEN 'positive' ELSE 'negative' END AS comida, 'neutral' AS servicio FROM documents""")
def _(t):
    cells = t.documents.select("doc_id", F.expr(_CELL).alias("cell"))
    return cells.select("doc_id", *[parse.stored_label(F.col("cell"), a).alias(a) for a in ("comida", "servicio")])


@query("p19_stored_flags", """
SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN true ELSE doc_id % 3 = 0 END AS comida, true AS servicio FROM documents""")
def _(t):
    cells = t.documents.select("doc_id", F.expr(_FLAGS).alias("cell"))
    return cells.select("doc_id", *[parse.stored_flag(F.col("cell"), a).alias(a) for a in ("comida", "servicio")])


@query("p20_derived_columns", """
SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN 'neutral' WHEN doc_id % 3 = 0 THEN 'positive' ELSE 'negative' END AS sentiment_comida,
  CASE WHEN doc_id % 4 < 2 THEN 0.0::DOUBLE WHEN doc_id % 3 = 0 THEN 1.0::DOUBLE ELSE (-1.0)::DOUBLE END AS sentiment_comida_score,
  CASE WHEN doc_id % 4 < 2 THEN true ELSE doc_id % 3 = 0 END AS mentions_comida, true AS mentions_ambiente FROM documents""")
def _(t):
    cells = t.documents.select("doc_id", F.expr(_CELL).alias("aspect_sentiments"), F.expr(_FLAGS).alias("aspect_mentions"))
    return features.derive_aspect_columns(cells).select(
        "doc_id", "sentiment_comida", "sentiment_comida_score", "mentions_comida", "mentions_ambiente")


# --- unify -------------------------------------------------------------------

@query("a02_shared_entities", """
SELECT 'casa ' || (review_id % 43) AS restaurant_key, count(DISTINCT restaurant_id) AS source_ids FROM texts
GROUP BY 1 HAVING count(DISTINCT restaurant_id) > 1""", "texts")
def _(t):
    """Names that several source ids share."""
    shared = t.texts.withColumn("restaurant_name", F.concat(F.lit("Café Casa  "), F.col("review_id") % 43))
    return unify.shared_entities(unify.unify_restaurants(shared))


@query("a03_field_coverage", "\nUNION ALL ".join(
    f"SELECT '{c}' AS field, count({c}) AS present, count(*) AS total, round(count({c}) * 100.0 / count(*), 6) AS pct FROM texts"
    for c in ("category", "price_range", "location", "overall_rating", "review_rating", "review_date")), "texts")
def _(t):
    out = unify.field_coverage(t.texts, ["category", "price_range", "location", "overall_rating", "review_rating", "review_date"])
    return out.select("field", "present", "total", r6("pct"))


def _ffill(c: str) -> str:
    return (f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY restaurant_id ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER (PARTITION BY restaurant_id ORDER BY row_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}")


@query("w01_fill_metadata", f"SELECT review_id, {_ffill('category')}, {_ffill('location')}, {_ffill('price_range')}, round({_ffill('overall_rating').replace(' AS overall_rating', '')}, 6) AS overall_rating FROM texts", "texts")
def _(t):
    columns = ["category", "location", "price_range", "overall_rating"]
    out = unify.fill_metadata(t.texts, columns, rows_per_chunk=128)
    return out.select("review_id", "category", "location", "price_range", r6("overall_rating"))


@query("w01_fill_metadata_whole", f"SELECT review_id, {_ffill('restaurant_name')}, {_ffill('category')}, {_ffill('location')}, {_ffill('address')}, {_ffill('price_range')}, round({_ffill('overall_rating').replace(' AS overall_rating', '')}, 6) AS overall_rating FROM texts", "texts")
def _(t):
    out = unify.fill_metadata(t.texts)
    return out.select("review_id", "restaurant_name", "category", "location", "address", "price_range", r6("overall_rating"))


@query("w02_deduplicate_reviews", f"""
SELECT review_id FROM (SELECT review_id, row_number() OVER (PARTITION BY restaurant_id, {KEY.format('review_text')} ORDER BY row_idx) AS n
FROM texts WHERE length({KEY.format('review_text')}) >= 10) WHERE n = 1""", "texts")
def _(t):
    return unify.deduplicate_reviews(t.texts).select("review_id")


@query("w03_remove_duplicates", """
SELECT review_id FROM (SELECT review_id, row_number() OVER (PARTITION BY restaurant_id, category, location ORDER BY row_idx) AS n FROM texts) WHERE n = 1""", "texts")
def _(t):
    return unify.remove_duplicates(t.texts, ["restaurant_id", "category", "location"]).select("review_id")


@query("u01_union_sources", """
SELECT o_orderkey AS id, CAST(NULL AS VARCHAR) AS name, o_totalprice AS amount FROM orders
UNION ALL SELECT c_custkey, c_name, NULL FROM customer""")
def _(t):
    return stored.union_sources([t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount")),
                                 t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))])


@query("s02_load_sources", """
SELECT l_orderkey AS k, CAST(NULL AS DOUBLE) AS o_totalprice, count(*) AS lines FROM lineitem GROUP BY 1
UNION ALL SELECT o_orderkey, o_totalprice, 0 FROM orders""")
def _(t):
    """A missing source is skipped; columns a source lacks are NULL."""
    loaded = stored.load_sources(t.spark, [f"{t.folder}/{n}.parquet" for n in ("lineitem", "no_such_source", "orders")])
    lines = loaded.filter("l_orderkey IS NOT NULL").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.max("o_totalprice").alias("o_totalprice"), F.count("*").alias("lines"))
    orders = loaded.filter("o_orderkey IS NOT NULL").select(F.col("o_orderkey").alias("k"), "o_totalprice", F.lit(0).cast("long").alias("lines"))
    return lines.unionByName(orders)


@query("s03_load_first", "SELECT c_custkey, c_name FROM customer")
def _(t):
    return stored.load_first(t.spark, [f"{t.folder}/{n}.parquet" for n in ("no_such_table", "customer", "orders")]).select("c_custkey", "c_name")


@query("s06_keyed_upsert", """
WITH latest AS (SELECT user_id, value, event_id FROM events WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
stored AS (SELECT user_id, value, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)
SELECT user_id, value, event_id FROM stored WHERE user_id NOT IN (SELECT user_id FROM latest WHERE user_id % 3 = 0)
UNION ALL SELECT user_id, value, event_id FROM latest WHERE user_id % 3 = 0""")
def _(t):
    events = t.events.select("user_id", "value", "event_id", "event_type")
    old = keep_first(events, ["user_id"], ["event_id"]).drop("event_type")
    new = events.filter((F.col("event_type") == "click") & (F.col("user_id") % 3 == 0)).drop("event_type")
    return stored.upsert(old, new, "user_id", "event_id")


@query("s06_keyed_upsert_all", """
WITH latest AS (SELECT user_id, value, event_id FROM events WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
stored AS (SELECT user_id, value, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)
SELECT user_id, value, event_id FROM stored WHERE user_id NOT IN (SELECT user_id FROM latest) UNION ALL SELECT user_id, value, event_id FROM latest""")
def _(t):
    events = t.events.select("user_id", "value", "event_id", "event_type")
    old = keep_first(events, ["user_id"], ["event_id"]).drop("event_type")
    return stored.upsert(old, events.filter("event_type = 'click'").drop("event_type"), "user_id", "event_id")


INVENTORY = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels",
             "conversations")


@query("s07_inventory", "\nUNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS rows FROM {n}" for n in INVENTORY))
def _(t):
    return stored.inventory({n: getattr(t, n) for n in INVENTORY})


@query("s08_surrogate_key", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_id FROM orders")
def _(t):
    from savora.operators.ordering import surrogate_key
    return surrogate_key(t.orders.select("o_orderkey"), "o_orderkey")
