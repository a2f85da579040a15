"""Lexicon sentiment as array expressions: one pass per review, no shuffle.

A review becomes an array with one small integer per word.  The bits say whether
the word is polar, negates, intensifies or names an aspect.  Everything after
that reads this array at a few fixed offsets, so the work is linear in the
length of the text and never leaves the row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, functions as F

from savora import fixed_values as fixed
from savora.functions import scores
from savora.functions.text import let

POSITIVE, NEGATIVE, NEGATOR, INTENSIFIER = 1, 2, 4, 8
FIRST_ASPECT_BIT = 4


@dataclass(frozen=True)
class Lexicon:
    """Words that carry polarity and words that name an aspect.

    ``aspects`` keeps its order: at one position the earlier aspect wins.
    """

    aspects: dict[str, Sequence[str]]
    positive: Sequence[str]
    negative: Sequence[str]
    intensifiers: Sequence[str] = tuple(fixed.INTENSIFIER_WORDS)
    negators: Sequence[str] = tuple(fixed.NEGATOR_WORDS)
    phrases: dict[str, Sequence[str]] = field(default_factory=dict)
    fallback_aspect: str | None = fixed.ASPECTS[0]
    letters: str = fixed.WORD_LETTERS

    @property
    def aspect_names(self) -> list[str]:
        return list(self.aspects)


RESTAURANT_LEXICON = Lexicon(
    aspects={
        "comida": fixed.FOOD_WORDS,
        "servicio": fixed.SERVICE_WORDS,
        "precio": fixed.PRICE_WORDS,
        "ambiente": fixed.AMBIENCE_WORDS,
    },
    phrases={"precio": fixed.PRICE_PHRASES, "ambiente": fixed.AMBIENCE_PHRASES},
    positive=fixed.POSITIVE_WORDS,
    negative=fixed.NEGATIVE_WORDS,
)


def _has(code: Column, bits: int) -> Column:
    return F.coalesce(code.bitwiseAND(F.lit(bits)), F.lit(0)) != 0


def _any(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def _word_codes(lowered: Column, lexicon: Lexicon) -> Column:
    """One integer per word of the text."""
    words = F.regexp_extract_all(lowered, F.lit(f"([{lexicon.letters}]+)"), F.lit(1))
    phrases = [(aspect, phrase) for aspect in lexicon.aspects
               for phrase in lexicon.phrases.get(aspect, ())]
    known = {w for ws in lexicon.aspects.values() for w in ws}
    known |= {*lexicon.positive, *lexicon.negative, *lexicon.intensifiers, *lexicon.negators}
    known |= {phrase.split()[0] for _, phrase in phrases}

    def code(word: Column, present: Column) -> Column:
        polarity = (F.when(word.isin(list(lexicon.positive)), POSITIVE)
                    .when(word.isin(list(lexicon.negative)), NEGATIVE).otherwise(0))
        total = (polarity
                 + F.when(word.isin(list(lexicon.negators)), NEGATOR).otherwise(0)
                 + F.when(word.isin(list(lexicon.intensifiers)), INTENSIFIER).otherwise(0))
        for i, (aspect, singles) in enumerate(lexicon.aspects.items()):
            hits = [word.isin(list(singles))]
            hits += [(word == phrase.split()[0]) & F.get(present, F.lit(j))
                     for j, (owner, phrase) in enumerate(phrases) if owner == aspect]
            total = total + F.when(_any(hits), 1 << (FIRST_ASPECT_BIT + i)).otherwise(0)
        return F.when(word.isin(sorted(known)), total).otherwise(0)

    flags = (F.array(*[F.contains(lowered, F.lit(p)) for _, p in phrases])
             if phrases else F.array(F.lit(False)))
    return let(flags, lambda present: F.transform(words, lambda w: code(w, present)))


def _double_polarity(codes: Column, i: Column) -> Column:
    """Twice the polarity of word ``i``, so that the 1.5 of an intensifier stays whole."""
    base = F.when(_has(F.get(codes, i), POSITIVE), 2).otherwise(-2)
    negated = _any([_has(F.get(codes, i - d), NEGATOR)
                    for d in range(1, fixed.NEGATION_REACH + 1)])
    stressed = _any([_has(F.get(codes, i - d), INTENSIFIER)
                     for d in range(1, fixed.INTENSITY_REACH + 1)])
    size = F.when(stressed, base * 3 / 2).otherwise(base).cast("int")
    return F.when(negated, -size).otherwise(size)


def _aspect_at(codes: Column, i: Column, lexicon: Lexicon) -> Column:
    """Index of the aspect named at position ``i``; NULL when none is."""
    found = None
    for n, _ in enumerate(lexicon.aspects):
        hit = _has(F.get(codes, i), 1 << (FIRST_ASPECT_BIT + n))
        found = F.when(hit, n) if found is None else found.when(hit, n)
    return found


def _nearest_aspect(codes: Column, i: Column, lexicon: Lexicon) -> Column:
    """The closest mention; one that precedes the word beats one that follows it
    at the same distance.  The word itself never counts."""
    after, before = fixed.REACH_AFTER_MENTION, fixed.REACH_BEFORE_MENTION
    offsets = sorted([(d, -d) for d in range(1, after + 1)]
                     + [(d + 0.5, d) for d in range(1, before + 1)])
    return F.coalesce(*[_aspect_at(codes, i + step, lexicon) for _, step in offsets])


def _polar_positions(codes: Column) -> Column:
    return F.array_compact(F.transform(
        codes, lambda c, i: F.when(_has(c, POSITIVE | NEGATIVE), i)))


def _sum_ints(values: Column, pick: Callable[[Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, v: total + pick(v))


def lexicon_score(text: Column, lexicon: Lexicon = RESTAURANT_LEXICON) -> Column:
    """Sum of the polar words, with negation and intensity."""
    def total(codes: Column) -> Column:
        return F.aggregate(_polar_positions(codes), F.lit(0),
                           lambda acc, i: acc + _double_polarity(codes, i)) / F.lit(2.0)
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return let(lowered, lambda low: let(_word_codes(low, lexicon), total))


def score_label(score: Column) -> Column:
    return F.when(score > 0, "positive").when(score < 0, "negative").otherwise("neutral")


def aspect_details(text: Column, lexicon: Lexicon = RESTAURANT_LEXICON) -> Column:
    """Struct aspect -> (label, mentioned).

    Each polar word counts for the nearest mention only.  The fallback aspect,
    when nobody names it, takes the tone of the whole text and stays unmentioned.
    """
    def detail(codes: Column) -> Column:
        # (aspect index or NULL, doubled polarity) per polar word
        hits = F.transform(_polar_positions(codes), lambda i: F.struct(
            _nearest_aspect(codes, i, lexicon).alias("aspect"),
            _double_polarity(codes, i).alias("weight")))
        mask = F.aggregate(codes, F.lit(0), lambda seen, c: seen.bitwiseOR(c))
        return let(F.struct(hits.alias("hits"), mask.alias("mask")), label_all)

    def label_all(found: Column) -> Column:
        hits, mask = found["hits"], found["mask"]
        columns = []
        for n, aspect in enumerate(lexicon.aspects):
            named = _has(mask, 1 << (FIRST_ASPECT_BIT + n))
            own = _sum_ints(hits, lambda h, n=n: F.when(h["aspect"] == n, h["weight"]).otherwise(0))
            unnamed = F.lit("neutral")
            if aspect == lexicon.fallback_aspect:
                unnamed = score_label(_sum_ints(hits, lambda h: h["weight"]))
            label = F.when(named, score_label(own)).otherwise(unnamed)
            columns.append(F.struct(label.alias("label"), named.alias("mentioned")).alias(aspect))
        return F.struct(*columns)

    lowered = F.lower(F.coalesce(text, F.lit("")))
    return let(lowered, lambda low: let(_word_codes(low, lexicon), detail))


# --- sentences ---------------------------------------------------------------

def bounded_polarity(text: Column, lexicon: Lexicon = RESTAURANT_LEXICON) -> Column:
    """Lexicon score squashed into -1..1."""
    return let(lexicon_score(text, lexicon), lambda s: s / F.sqrt(s * s + F.lit(15.0)))


def sentence_label(text: Column, keywords: Sequence[str],
                   polarity: Callable[[Column], Column] = bounded_polarity,
                   threshold: float = 0.05) -> Column:
    """Tone of the sentences that contain any keyword as a substring."""
    def about(sentence: Column) -> Column:
        return _any([F.contains(F.lower(sentence), F.lit(k.lower())) for k in keywords])

    def label(sentences: Column) -> Column:
        return (F.when(F.size(sentences) == 0, "neutral")
                .otherwise(let(polarity(F.array_join(sentences, " ")), threshold_label)))

    def threshold_label(score: Column) -> Column:
        return (F.when(score >= threshold, "positive")
                .when(score <= -threshold, "negative").otherwise("neutral"))

    sentences = F.split(F.coalesce(text, F.lit("")), r"\.", -1)
    return let(F.filter(sentences, about), label)


def first_available(*labels: Column) -> Column:
    """First analyser that answered; nobody answering is neutral."""
    return F.coalesce(*labels, F.lit("neutral"))


# --- binary class ------------------------------------------------------------

def lexicon_class(details: Column, lexicon: Lexicon = RESTAURANT_LEXICON) -> Column:
    """Mean of the mentioned aspects above zero is positive."""
    mentioned = [F.when(details[a]["mentioned"], scores.label_score(details[a]["label"]))
                 for a in lexicon.aspects]
    mean = F.coalesce(scores.row_mean(mentioned),
                      scores.label_score(details[lexicon.fallback_aspect]["label"]))
    return F.when(mean > 0, fixed.POSITIVE_CLASS).otherwise(fixed.MINORITY_CLASS)


def external_class(response: Column, answer: Column,
                   aspects: Sequence[str] = fixed.ASPECTS) -> Column:
    """Class of an external answer map; a call that failed counts as positive."""
    points = [scores.label_score(F.coalesce(F.try_element_at(answer, F.lit(a)), F.lit("neutral")))
              for a in aspects]
    positive = response.isNull() | (scores.row_mean(points) > 0)
    return F.when(positive, fixed.POSITIVE_CLASS).otherwise(fixed.MINORITY_CLASS)
