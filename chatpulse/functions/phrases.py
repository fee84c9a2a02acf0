"""Sentence scores from weighted phrases with negation: an automaton folded over the tokens, inside the plan."""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatpulse.functions.sentiment import ENGLISH_LEXICON, clamp_score, scored_sentences, sentences_of

#: Words with what an apostrophe joins, and the marks that end a negation. Hyphens part words: ``so-so`` is ``so so``.
PHRASE_TOKEN = r"\p{L}+(?:['’]\p{L}+)*|[,;:()]"
BREAK_MARKS = (",", ";", ":", "(", ")")
WEIGHT, NEGATION, BREAK = 0, 1, 2

#: Phrases that turn the weights after them until the next break.
ENGLISH_NEGATIONS = (
    "not", "no", "never", "no longer", "neither", "nor", "without", "hardly", "cannot", "isn't", "aren't", "wasn't",
    "weren't", "don't", "doesn't", "didn't", "can't", "couldn't", "won't", "wouldn't", "shouldn't", "hasn't", "haven't",
)
ENGLISH_BREAKS = ("but", "however", "although", "though", "yet")
#: Words of ``ENGLISH_LEXICON``, and phrases that mean something else than their words.
ENGLISH_PHRASES: dict[str, int] = ENGLISH_LEXICON | {
    "so so": 0,
    "not bad": 1,
    "no good": -1,
    "not only": 0,
    "no problem": 1,
    "like this": 0,
    "looks like": 0,
    "too good to be true": -1,
    "fed up": -2,
    "falling apart": -2,
    "well done": 2,
}


def phrase_tokens(sentence: Column) -> Column:
    return F.regexp_extract_all(F.translate(sentence, "’", "'"), F.lit(PHRASE_TOKEN), F.lit(0))


class PhraseAutomaton:
    """States are beginnings of phrases; a step goes to the longest beginning that the tokens so far end with.

    Failure links are followed when the automaton is built. What is kept is, per state and
    token, the state to go to, wherever that differs from starting anew with the token; and per state
    the longest phrase that ends there.
    """

    def __init__(self, phrases: Mapping[tuple[str, ...], tuple[int, int]]):
        """``phrases``: tokens -> (kind, weight)."""
        children: list[dict[str, int]] = [{}]
        ends: list[tuple[int, int, int] | None] = [None]
        for tokens, (kind, weight) in phrases.items():
            state = 0
            for token in tokens:
                if token not in children[state]:
                    children[state][token] = len(children)
                    children.append({})
                    ends.append(None)
                state = children[state][token]
            ends[state] = (len(tokens), kind, weight)
        fail = [0] * len(children)
        steps = [dict(children[0])] + [{} for _ in children[1:]]
        waiting = deque(children[0].values())
        while waiting:
            state = waiting.popleft()
            ends[state] = ends[state] or ends[fail[state]]
            steps[state] = steps[fail[state]] | children[state]
            for token, child in children[state].items():
                fail[child] = steps[fail[state]].get(token, 0)
                waiting.append(child)
        self.first = steps[0]
        self.steps = [{t: to for t, to in own.items() if self.first.get(t) != to} for own in steps]
        self.ends = ends
        self.longest = max(map(len, phrases), default=1)

    def rows(self) -> list[tuple[int, str, int]]:
        """``(state, token, next)`` of all kept steps, those of state 0 first."""
        return [(0, t, to) for t, to in self.first.items()] + [(s, t, to) for s, own in enumerate(self.steps) for t, to in own.items()]


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _bucketed(entries: list[dict], place: str, buckets: int) -> Column:
    """Constant ``array<array<struct>>``: entries by the bucket of their key, found in one look."""
    table: list[list[dict]] = [[] for _ in range(buckets)]
    for entry in entries:
        table[entry.pop("_at") % buckets].append(entry)
    return F.from_json(F.lit(json.dumps(table)), f"array<array<struct<{place}>>>")


class PhraseScorer:
    """Scores a sentence as ``clamp(2 + sum, 0, 4)`` over its phrases.

    A phrase counts wherever it stands, unless a longer phrase holds it there. Its weight
    counts the other way round after a negation, up to the next break: a mark, a break word, or the sentence's end.
    Phrases are written as lower-case words with blanks between. One fold over the tokens of a sentence finds them all, whatever their
    number: a token is looked up in one bucket, a step in another. There is no join, no
    shuffle and no Python; the tables are constants of the plan.
    """

    def __init__(
        self, weights: Mapping[str, int], negations: Iterable[str] = (), breaks: Iterable[str] = ()
    ) -> None:
        phrases: dict[tuple[str, ...], tuple[int, int]] = {}
        for text, entry in (
            [(t, (WEIGHT, int(w))) for t, w in weights.items()]
            + [(t, (NEGATION, 0)) for t in negations]
            + [(t, (BREAK, 0)) for t in breaks]
        ):
            tokens = tuple(text.split())
            if not tokens or text != text.lower() or phrases.setdefault(tokens, entry) != entry:
                raise ValueError(f"phrases are lower-case words, each with one meaning: {text!r}")
        if not any(weight for _, weight in phrases.values()):
            raise ValueError("no phrase has a weight")
        for mark in BREAK_MARKS:
            phrases[(mark,)] = (BREAK, 0)
        self.automaton = PhraseAutomaton(phrases)
        self._numbers = {t: i for i, t in enumerate(sorted({t for tokens in phrases for t in tokens}), 1)}

    @staticmethod
    def from_table(lexicon: DataFrame) -> PhraseScorer:
        """From rows ``phrase, kind, weight``, kind being weight, negation or break. Plans hold a lexicon of thousands of phrases."""
        rows = lexicon.select("phrase", "kind", "weight").collect()
        of = lambda kind: [r for r in rows if r["kind"] == kind]
        weights = {r["phrase"]: r["weight"] for r in of("weight")}
        return PhraseScorer(weights, [r["phrase"] for r in of("negation")], [r["phrase"] for r in of("break")])

    def _tables(self) -> tuple[Column, Column, int, Column, int]:
        """(tokens, steps, buckets of each, ends by state)"""
        auto, number = self.automaton, self._numbers
        words = 1 << max(4, (2 * len(number)).bit_length())
        token_entries = [
            {"_at": zlib.crc32(t.encode()), "token": t, "number": n, "first": auto.first.get(t, 0)} for t, n in number.items()
        ]
        kept = [(s, t, to) for s, t, to in auto.rows()[len(auto.first) :]]
        steps = 1 << max(4, (2 * len(kept)).bit_length())
        step_entries = [{"_at": (key := s * (len(number) + 1) + number[t]), "key": key, "next": to} for s, t, to in kept]
        ends = [{"size": e[0], "kind": e[1], "weight": e[2]} if e else {"size": 0, "kind": 0, "weight": 0} for e in auto.ends]
        return (
            _bucketed(token_entries, "token: string, number: int, first: int", words),
            _bucketed(step_entries, "key: int, next: int", steps),
            words,
            F.from_json(F.lit(json.dumps(ends)), "array<struct<size: int, kind: int, weight: int>>"),
            steps,
        )

    def _sentence_score(self, sentence: Column) -> Column:
        tokens, steps, words, ends, step_buckets = self._tables()
        per_state, longest = len(self._numbers) + 1, self.automaton.longest
        whole = lambda n: F.lit(n).cast("int")
        none = F.expr("cast(array() AS array<struct<start: int, kind: int, weight: int>>)")
        zero = F.struct(
            whole(0).alias("state"), whole(0).alias("at"), none.alias("open"), F.lit(False).alias("turned"), whole(0).alias("sum")
        )

        def settle(acc: Column, entries: Column) -> Column:
            """Count entries in order; ``turned`` is whether a negation holds."""

            def one(done: Column, e: Column) -> Column:
                signed = F.when(done["turned"], -e["weight"]).otherwise(e["weight"])
                turned = F.when(e["kind"] == NEGATION, True).when(e["kind"] == BREAK, False).otherwise(done["turned"])
                return F.struct(turned.alias("turned"), (done["sum"] + signed).cast("int").alias("sum"))

            return F.aggregate(entries, F.struct(acc["turned"].alias("turned"), acc["sum"].alias("sum")), one)

        def looked_up(token: Column) -> Column:
            """``number, first`` of a token; null for one of no phrase."""
            bucket = F.get(tokens, F.pmod(F.crc32(token), F.lit(words)).cast("int"))
            return F.get(F.filter(bucket, lambda e: e["token"] == token), F.lit(0))

        def after(acc: Column, token: Column) -> Column:
            key = (acc["state"] * per_state + token["number"]).cast("int")
            bucket = F.get(steps, F.pmod(key, F.lit(step_buckets)).cast("int"))
            found = F.get(F.filter(bucket, lambda e: e["key"] == key), F.lit(0))
            # A token of no phrase leads back to the start.
            return F.coalesce(found["next"], token["first"], whole(0))

        def opened(acc: Column, end: Column) -> Column:
            start = (acc["at"] - end["size"] + 1).cast("int")
            new = F.struct(start.alias("start"), end["kind"].alias("kind"), end["weight"].alias("weight"))
            # Phrases inside the new one don't count.
            outside = F.filter(acc["open"], lambda e: e["start"] < start)
            return F.when(end["size"] > 0, F.array_append(outside, new)).otherwise(acc["open"])

        def moved(acc: Column, state: Column, entries: Column) -> Column:
            # Later phrases can hold only what begins less than the longest phrase before them.
            border = acc["at"] + 2 - longest
            done = settle(acc, F.filter(entries, lambda e: e["start"] < border))
            return once(
                done,
                lambda d: F.struct(
                    state.alias("state"),
                    (acc["at"] + 1).cast("int").alias("at"),
                    F.filter(entries, lambda e: e["start"] >= border).alias("open"),
                    d["turned"].alias("turned"),
                    d["sum"].alias("sum"),
                ),
            )

        def step(acc: Column, token: Column) -> Column:
            passed = F.struct(
                whole(0).alias("state"),
                (acc["at"] + 1).cast("int").alias("at"),
                acc["open"].alias("open"),
                acc["turned"].alias("turned"),
                acc["sum"].alias("sum"),
            )
            nothing = token.isNull() & (F.size(acc["open"]) == 0)
            full = once(after(acc, token), lambda state: once(opened(acc, F.get(ends, state)), lambda entries: moved(acc, state, entries)))
            return F.when(nothing, passed).otherwise(full)

        known = F.transform(phrase_tokens(sentence), looked_up)
        return F.aggregate(known, zero, step, lambda acc: clamp_score(settle(acc, acc["open"])["sum"]))

    def scores(self, text: Column) -> Column:
        return F.transform(sentences_of(text), self._sentence_score)

    def __call__(self, text: Column) -> Column:
        return scored_sentences(self.scores(text))


def english_phrase_scorer() -> PhraseScorer:
    return PhraseScorer(ENGLISH_PHRASES, ENGLISH_NEGATIONS, ENGLISH_BREAKS)
