"""Sentence sentiment: splitting, lexicon scores, classes and labels.

A scorer is any function ``Column -> Column`` from message text to
``ARRAY<STRUCT<score INT, class STRING>>``, one element per sentence, scores 0 to 4.
``lexicon_scorer`` builds one from built-in expressions; a model wrapped as a pandas UDF
with that return type plugs in the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

Scorer = Callable[[Column], Column]

# Names of the five sentence classes, by score.
CLASS_NAMES = ("Very negative", "Negative", "Neutral", "Positive", "Very positive")

# Lowest average of each window label, best first.
LABEL_FLOORS = (
    (3.5, "very positive"),
    (2.5, "positive"),
    (1.5, "neutral"),
    (0.5, "negative"),
)
LOWEST_LABEL = "very negative"

# A message counts as clearly positive or negative beyond these scores.
POSITIVE_FLOOR = 2.5
NEGATIVE_CEILING = 1.5

# Sentences end at . ! ? or a line break and hold a letter or digit. Tokens are letters of any script.
SENTENCE = r"[^.!?\n\p{L}\p{N}]*[\p{L}\p{N}][^.!?\n]*"
TOKEN = r"\p{L}+"
NEUTRAL_SCORE = 2
TOP_SCORE = 4

#: Small general-purpose lexicon: token -> weight.
ENGLISH_LEXICON: dict[str, int] = {
    "amazing": 2,
    "awesome": 2,
    "excellent": 2,
    "fantastic": 2,
    "love": 2,
    "perfect": 2,
    "wonderful": 2,
    "better": 1,
    "enjoyed": 1,
    "good": 1,
    "great": 1,
    "happy": 1,
    "like": 1,
    "nice": 1,
    "thanks": 1,
    "bad": -1,
    "boring": -1,
    "broken": -1,
    "disappointing": -1,
    "poor": -1,
    "sad": -1,
    "slow": -1,
    "wrong": -1,
    "awful": -2,
    "dreadful": -2,
    "hate": -2,
    "horrible": -2,
    "terrible": -2,
    "worst": -2,
}


def sentences_of(text: Column) -> Column:
    """Lower-case sentences of a text, blank ones dropped; empty for null or blank text.

    Matching keeps its compiled pattern from row to row; splitting would compile it again
    for every text.
    """
    found = F.regexp_extract_all(F.lower(text), F.lit(SENTENCE), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def tokens_of(sentence: Column) -> Column:
    """Runs of letters a to z of a lower-case sentence."""
    return F.regexp_extract_all(sentence, F.lit(TOKEN), F.lit(0))


def clamp_score(weight: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(TOP_SCORE), weight + F.lit(NEUTRAL_SCORE))).cast("int")


def class_name(score: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in CLASS_NAMES]), score + 1)


def label_of(average: Column) -> Column:
    """Five-level label of an unrounded average."""
    floors = iter(LABEL_FLOORS)
    floor, name = next(floors)
    chain = F.when(average >= floor, name)
    for floor, name in floors:
        chain = chain.when(average >= floor, name)
    return chain.otherwise(LOWEST_LABEL)


def scored_sentences(scores: Column) -> Column:
    """Attach class names to an array of scores."""
    return F.transform(scores, lambda v: F.struct(v.alias("score"), class_name(v).alias("class")))


class LexiconScorer:
    """Scores a sentence as ``clamp(2 + sum of token weights, 0, 4)``, inside the plan.

    The words become set-membership tests, so no shuffle, join or Python is involved. They are
    part of the plan: a lexicon of tens of thousands of words is better kept in a table and
    joined (``score_with_lexicon_table``).
    """

    def __init__(self, weights: Mapping[str, int]) -> None:
        words = {word: int(weight) for word, weight in weights.items() if int(weight) != 0}
        if not words:
            raise ValueError("the lexicon has no words with a weight")
        self._by_weight: dict[int, list[str]] = {}
        for word in sorted(words):
            self._by_weight.setdefault(words[word], []).append(word)

    def _weight_of(self, token: Column) -> Column:
        cases = [(token.isin(members), weight) for weight, members in sorted(self._by_weight.items())]
        condition, weight = cases[0]
        chain = F.when(condition, weight)
        for condition, weight in cases[1:]:
            chain = chain.when(condition, weight)
        return chain.otherwise(0)

    def _sentence_score(self, sentence: Column) -> Column:
        total = F.aggregate(tokens_of(sentence), F.lit(0), lambda acc, t: acc + self._weight_of(t))
        return clamp_score(total)

    def scores(self, text: Column) -> Column:
        """Scores only, for summaries that never look at class names."""
        return F.transform(sentences_of(text), self._sentence_score)

    def __call__(self, text: Column) -> Column:
        return scored_sentences(self.scores(text))


def lexicon_scorer(weights: Mapping[str, int]) -> LexiconScorer:
    return LexiconScorer(weights)


def scores_only(scorer: Scorer, text: Column) -> Column:
    """Array of sentence scores, the short way where the scorer has one."""
    check_scorer(scorer)
    return scorer.scores(text) if hasattr(scorer, "scores") else scorer(text)["score"]


def check_scorer(scorer: Scorer | None) -> Scorer:
    if scorer is None or not callable(scorer):
        raise ValueError("no scorer set up: pass a function from text column to sentence scores")
    return scorer
