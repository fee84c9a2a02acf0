"""Phrases, negation and breaks against brute force."""

import random
import re

import pytest

from chatpulse.functions.phrases import ENGLISH_PHRASES, PhraseScorer, english_phrase_scorer
from chatpulse.operators.scoring import score_messages, score_stats
from chatpulse.plans.branches import sentiment_branch
from tests.helpers import messages, plan_text

MARKS = ",;:()"


def brute(tokens, weights, negations, breaks):
    """All matches, those inside a longer one dropped, counted from left to right."""
    kinds = {tuple(t.split()): ("w", w) for t, w in weights.items()}
    kinds |= {tuple(t.split()): ("n", 0) for t in negations} | {tuple(t.split()): ("b", 0) for t in breaks} | {(m,): ("b", 0) for m in MARKS}
    longest = max(map(len, kinds))
    found = [(i, i + k) for i in range(len(tokens)) for k in range(1, longest + 1) if tuple(tokens[i : i + k]) in kinds and i + k <= len(tokens)]
    kept = [a for a in found if not any(b != a and b[0] <= a[0] and a[1] <= b[1] for b in found)]
    total, turned = 0, False
    for i, j in sorted(kept):
        kind, weight = kinds[tuple(tokens[i:j])]
        total += -weight if turned else weight
        turned = kind == "n" or (turned and kind != "b")
    return max(0, min(4, 2 + total))


def scores_of(spark, scorer, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "seq long, message string")
    return {r["seq"]: [s["score"] for s in r["sentences"]] for r in score_messages(frame, scorer).collect()}


@pytest.mark.parametrize("seed", range(4))
def test_random_lexicons(spark, seed):
    rng = random.Random(seed)
    words = list("abcde")
    phrase = lambda: " ".join(rng.choice(words) for _ in range(rng.choice([1, 1, 2, 2, 3, 4])))
    pool = list({phrase() for _ in range(14)})
    weights = {p: rng.choice([-2, -1, 0, 1, 2]) for p in pool[:9]} | {"zz": 1}
    negations, breaks = pool[9:11], pool[11:12]
    texts = [[rng.choice([*words, *words, "x", ",", ";", "zz"]) for _ in range(rng.randrange(1, 25))] for _ in range(300)]
    texts = [t for t in texts if re.search(r"\w", " ".join(t))]
    found = scores_of(spark, PhraseScorer(weights, negations, breaks), [" ".join(t) for t in texts])
    assert found == {i: [brute(t, weights, negations, breaks)] for i, t in enumerate(texts)}


def test_english(spark):
    cases = {
        "Fantastic!": [4], "Good job!": [3], "It's so-so.": [2], "This is bad.": [1], "Terrible!": [0], "": [], None: [],
        "not good": [1], "no longer broken": [3], "Not bad": [3], "It isn’t good, but the team is great": [2],
        "never, good": [3], "I don't hate it": [4], "not only good": [3], "no good. Good": [1, 3], "GOOD not (good) good": [4],
        "bad not": [1], "a long way without a word of praise that is good": [1], "so so good": [3],
    }
    found = scores_of(spark, english_phrase_scorer(), list(cases))
    assert found == dict(enumerate(cases.values()))


def test_no_join_no_python_and_plugs_in(spark):
    scorer = english_phrase_scorer()
    frame = messages(spark, [(0, "not good"), (1, "no longer broken"), (2, "so-so")])
    plan = plan_text(score_stats(frame, scorer))
    assert "Join" not in plan and "Python" not in plan and "Exchange" not in plan
    row = sentiment_branch(frame, scorer).first()
    assert (row.score_sum, row.most_positive, row.most_negative) == (6, "no longer broken", "not good")


def test_a_long_sentence(spark):
    text = " ".join(["good", "bad", "plain"] * 4000 + ["fantastic"])
    assert scores_of(spark, english_phrase_scorer(), [text]) == {0: [4]}


def test_lexicon_in_a_table(spark):
    rows = [("really good", "weight", 2), ("good", "weight", 1), ("not", "negation", None), ("but", "break", None)]
    scorer = PhraseScorer.from_table(spark.createDataFrame(rows, "phrase string, kind string, weight int"))
    assert scores_of(spark, scorer, ["really good", "not really good", "not x but good"]) == {0: [4], 1: [0], 2: [3]}
    for bad in ({"Good": 1}, {"": 1}, {"x": 0}):
        with pytest.raises(ValueError):
            PhraseScorer(bad)
    with pytest.raises(ValueError):
        PhraseScorer({"no": 1}, ["no"])
    name = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    big = PhraseScorer(ENGLISH_PHRASES | {f"w{name(i)} v{name(i)}": 1 for i in range(3000)}, ["not"])
    assert scores_of(spark, big, [f"w{name(77)} v{name(77)}", "wb vc", f"not w{name(2999)} v{name(2999)}"]) == {0: [3], 1: [2], 2: [1]}
