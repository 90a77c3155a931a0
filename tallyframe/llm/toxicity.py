"""Toxicity by a lexicon matched through Levenshtein automata, with context windows.

The lexicon has a short fixed list of insults and the words that labelled documents prove to go with
toxic ones, however rare: the log-likelihood ratio of a word's toxic share to that of all labelled
documents must exceed what the best of all words tested reaches by chance. A word's reliability is the
toxic share of the labelled documents that have it, drawn to the overall share by ``PRIOR_DOCS``, so that
words of little evidence count less and reach the threshold together only; each counts once in a text.
The ``MAX_TERMS`` most frequent of the nearly sure words and the fixed list are terms that also match
misspelled; all others match exactly, by their hash. The terms form tries, one for each number of
errors allowed (insertions, deletions, substitutions or swaps of neighbours; none below five letters, one
below eight, two from there on). The tries are intersected with the Levenshtein automata of that many
errors, and the intersection is made deterministic once, so that matching a word costs a table lookup per
byte. Misspellings must keep the first letter. A misspelled hit counts what labelled documents show about the
misspellings of its term with that many errors, if they have ``MIN_DOCS`` of them, else a fixed part of an
exact one. Words that automata accept are exempt if ``MIN_CLEAN`` clean labelled documents or more
have them, and more than toxic ones.

Each hit is scored in its window of six words to both sides: less if it stands in quotation marks or the
window speaks about words (quotation), more if it addresses somebody (abuse). The score is the chance
that one hit at least is abuse, ``1 - product(1 - hit)``.

Learning uses at most ``MAX_TRAINING`` labelled documents, chosen by a hash of their ids.

Defined results: null and empty texts have no hits and score ``NO_HIT``, the lowest score. Without labels
the fixed list is used alone.
"""

from __future__ import annotations

import re
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.learning import labelled_sample
from tallyframe.llm.staging import Workspace
from tallyframe.llm.words import LOWERED, Words, word_chunks

MAX_TRAINING = 20_000
MAX_TERMS = 200
MIN_DOCS, MIN_SHARE, MIN_RELIABILITY = 5, 0.6, 0.9
#: The chance of one false word among all words tested, and documents of the overall share added to a word's.
CHANCE, PRIOR_DOCS = 0.05, 2
MIN_CLEAN = 3
THRESHOLD = 0.7
NO_HIT = 0.01
WINDOW = 6

#: Common insults (fixed values).
SEEDS = (
    "asshole bastard bitch bullshit clown cretin disgusting dumbass fucker idiot imbecile jerk loser moron "
    "pathetic retard scum shithead stupid trash vermin worthless"
).split()
SEED_RELIABILITY = 0.9
#: What a hit counts by its number of errors, and in its context (fixed values). An exact insult is enough
#: for the threshold; misspelled ones, which may be other words, need company unless labelled documents show them to be insults.
EXACTNESS = (0.85, 0.65, 0.5)
QUOTED, REPORTED, ADDRESSED = 0.25, 0.5, 1.1
#: Ordinary words that are a small error away from an insult (fixed values).
HARMLESS = "idiom idioms jerky looser lower moon moons motion".split()
#: Words that speak about words, and words that address somebody (fixed values).
REPORTING = frozenset(
    "word words term terms phrase called calls calling quote quoted quotes said says wrote writes written means "
    "meaning definition defined insult insults slur slurs spelled pronounced translates mot mots terme wort "
    "wörter begriff palabra término".split()
)
ADDRESSING = frozenset("you your youre yours u ur yourself du dich dir dein tu te toi vous votre eres usted ustedes".split())
_QUOTES = re.compile("[\"“”„«»‹›`]|(?<!\\w)['‘]|['’](?!\\w)")
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def errors_allowed(term: bytes) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


@dataclass
class Automaton:
    """Deterministic intersection of the lexicon's trie with the automata of its terms; state 0 is dead, 1 the start."""

    terms: list[bytes]
    classes: np.ndarray  # the column of each byte
    step: np.ndarray  # state, column -> state
    term: np.ndarray  # the nearest accepted term of each state, or -1
    errors: np.ndarray
    longest: int = field(init=False)

    def __post_init__(self) -> None:
        self.longest = max((len(t) + errors_allowed(t) for t in self.terms), default=0)

    def match(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, term, errors) of the words that are accepted."""
        length = words.ends - words.starts
        state = np.ones(len(length), np.int32)
        going = np.flatnonzero(length <= self.longest)
        done = []
        for j in range(self.longest):
            state[going] = self.step[state[going], self.classes[words.data[words.starts[going] + j]]]
            going = going[state[going] > 0]
            ends = length[going] == j + 1
            done.append(going[ends])
            going = going[~ends]
        found = np.sort(np.concatenate(done)) if done else going[:0]
        found = found[self.term[state[found]] >= 0]
        return found, self.term[state[found]], self.errors[state[found]]


def build_automaton(terms: list[bytes]) -> Automaton:
    """Walk the trie of the terms and the automata's error counts together, one byte class at a time.

    A state is a set of (trie node, errors left, byte still owed by a swap); the start holds the roots
    of all tries.
    """
    alphabet = sorted({b for t in terms for b in t})
    classes = np.full(256, len(alphabet), np.int64)
    for i, b in enumerate(alphabet):
        classes[b] = i
    classes = classes[LOWERED]
    children: list[dict[int, int]] = []
    ends: dict[int, int] = {}
    roots: dict[int, int] = {}

    def node() -> int:
        children.append({})
        return len(children) - 1

    for i, term in enumerate(terms):
        at = roots.setdefault(errors_allowed(term), -1)
        if at < 0:
            at = roots[errors_allowed(term)] = node()
        for b in term:
            column = alphabet.index(b)
            if column not in children[at]:
                children[at][column] = node()
            at = children[at][column]
        ends[at] = i

    first = set(roots.values())

    def closed(items: set) -> frozenset:
        """With the deletions that are still allowed; the first letter cannot be deleted."""
        items, todo = set(items), list(items)
        while todo:
            at, left, owed = todo.pop()
            if left and owed is None and at not in first:
                for child in children[at].values():
                    if (child, left - 1, None) not in items:
                        items.add((child, left - 1, None))
                        todo.append((child, left - 1, None))
        # Of equal nodes the one with most errors left covers the others.
        best: dict = {}
        for at, left, owed in items:
            best[at, owed] = max(best.get((at, owed), -1), left)
        return frozenset((at, left, owed) for (at, owed), left in best.items())

    def after(state: frozenset, column: int) -> frozenset:
        out = set()
        for at, left, owed in state:
            if owed is not None:
                if owed == column:
                    out.add((at, left, None))
                continue
            if column in children[at]:
                out.add((children[at][column], left, None))
            if left and at not in first:
                out.add((at, left - 1, None))
                for b, child in children[at].items():
                    if b != column:
                        out.add((child, left - 1, None))
                        if column in children[child]:
                            out.add((children[child][column], left - 1, b))
        return closed(out)

    start = closed({(root, k, None) for k, root in roots.items()})
    numbers = {frozenset(): 0, start: 1}
    steps = [[0] * (len(alphabet) + 1)]
    queue = deque([start])
    while queue:
        state = queue.popleft()
        row = []
        for column in range(len(alphabet) + 1):
            to = after(state, column)
            if to not in numbers:
                numbers[to] = len(numbers)
                queue.append(to)
            row.append(numbers[to])
        steps.append(row)
    term, errors = np.full(len(numbers), -1), np.zeros(len(numbers), np.int64)
    for state, number in numbers.items():
        accepted = [(errors_allowed(terms[ends[at]]) - left, ends[at]) for at, left, owed in state if owed is None and at in ends]
        if accepted:
            errors[number], term[number] = min(accepted)
    return Automaton(terms, classes, np.array(steps, np.int32), term, errors)


@dataclass
class Lexicon:
    automaton: Automaton
    reliability: np.ndarray  # of each term
    exempt: frozenset[bytes]  # words the automata accept that are harmless
    exact: dict[bytes, float] = field(default_factory=dict)  # reliability of the words that match exactly only
    misspelled: dict[tuple[int, int], float] = field(default_factory=dict)  # reliability by term and errors, where known

    def __post_init__(self) -> None:
        self.worth = self.reliability[:, None] * np.array(EXACTNESS)
        for (t, e), share in self.misspelled.items():
            self.worth[t, e] = share * EXACTNESS[0]
        hashes = np.array([next(word_chunks(pa.array([w.decode()]))).hashes[0] for w in self.exact], np.uint64)
        order = np.argsort(hashes)
        self._hashes, self._known = hashes[order], np.array(list(self.exact.values()), np.float64)[order]

    def _exact_hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, place in the table) of the words that match exactly."""
        if not len(self._hashes) or not len(words.hashes):
            none = np.zeros(0, np.int64)
            return none, none
        at = np.minimum(np.searchsorted(self._hashes, words.hashes), len(self._hashes) - 1)
        found = np.flatnonzero(self._hashes[at] == words.hashes)
        return found, at[found]

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), NO_HIT)
        for words in word_chunks(texts):
            known, place = self._exact_hits(words)
            word, term, errors = self.automaton.match(words)
            other = ~np.isin(word, known)
            word, term, errors = word[other], term[other], errors[other]
            doc = np.searchsorted(words.begins, word, "right") - 1
            clean = np.ones(words.n_docs)
            for w, t, e, d in zip(word.tolist(), term.tolist(), errors.tolist(), doc.tolist()):
                if e and LOWERED[words.data[words.starts[w] : words.ends[w]]].tobytes() in self.exempt:
                    continue
                hit = self.worth[t, e] * context_factor(words, w, d)
                clean[d] *= 1 - min(hit, 0.99)
            best: dict[tuple[int, int], float] = {}
            for w, k, d in zip(known.tolist(), place.tolist(), (np.searchsorted(words.begins, known, "right") - 1).tolist()):
                hit = self._known[k] * EXACTNESS[0] * context_factor(words, w, d)
                best[d, k] = max(best.get((d, k), 0.0), hit)
            for (d, _), hit in best.items():
                clean[d] *= 1 - min(hit, 0.99)
            out[words.first : words.first + words.n_docs] = np.maximum(NO_HIT, 1 - clean)
        return out


def context_factor(words: Words, word: int, doc: int) -> float:
    """How the window around a hit changes what the hit counts."""
    low = max(words.begins[doc], word - WINDOW)
    high = min(words.begins[doc + 1], word + WINDOW + 1)

    def said(a: int, b: int) -> str:
        return words.data[a:b].tobytes().decode("utf-8", "replace")

    start = words.offsets[doc] if low == words.begins[doc] else words.starts[low]
    stop = words.offsets[doc + 1] if high == words.begins[doc + 1] else words.ends[high - 1]
    before, after = said(start, words.starts[word]), said(words.ends[word], stop)
    around = {x.lower() for x in re.findall(r"\w+", f"{before} {after}")}
    # Inside a quotation marks stand on both sides, with no sentence end between them and the hit.
    quoted = _QUOTES.search(re.split(r"[.!?\n]", before)[-1]) and _QUOTES.search(re.split(r"[.!?\n]", after)[0])
    factor = QUOTED if quoted else 1.0
    if around & REPORTING:
        factor *= REPORTED
    elif around & ADDRESSING and not quoted:
        factor *= ADDRESSED
    return factor


def learn_lexicon(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> Lexicon:
    """``docs`` has doc_id and text; ``labels`` has doc_id and toxic, only of rows that may be learned from."""
    sample = labelled_sample(docs, labels, "toxic", most)
    said = F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), CAPITALS, SMALL), F.lit(LETTERS), 0))
    # Read by six actions below, so written once.
    work = Workspace(docs.sparkSession, "toxicity")
    by_word = work.keep(
        # An empty word stands for the document itself.
        sample.select("label", F.explode(F.array_append(said, F.lit(""))).alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    )
    # The lists below are bounded by the sample: words that many of its toxic documents have, and what few errors make of terms.
    total = by_word.where("word = ''").first()
    n_toxic, n_all = (total["toxic"], total["toxic"] + total["clean"]) if total else (0, 0)
    overall = min(max(n_toxic / max(n_all, 1), 1e-9), 1 - 1e-9)
    tested = by_word.where((F.length("word") >= 4) & (F.col("toxic") >= MIN_DOCS))
    n = F.col("toxic") + F.col("clean")
    ratio = F.col("toxic") * F.log(F.col("toxic") / n / overall) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / n / (1 - overall))
    ).otherwise(0.0)
    needed = np.log(max(tested.count(), 1) / CHANCE)
    proven = tested.where((F.col("toxic") > overall * n) & (F.col("toxic") >= MIN_SHARE * n) & (ratio >= float(needed)))
    rows = proven.orderBy(F.col("toxic").desc(), "word").collect()
    share = {r["word"].encode(): (r["toxic"] + PRIOR_DOCS * overall) / (r["toxic"] + r["clean"] + PRIOR_DOCS) for r in rows}
    sure = [r["word"].encode() for r in rows if r["toxic"] / (r["toxic"] + r["clean"] + 1) >= MIN_RELIABILITY][:MAX_TERMS]
    reliability = {w: share[w] for w in sure}
    seen = {r["word"]: r for r in by_word.where(F.col("word").isin(SEEDS)).collect()}
    for seed in SEEDS:
        row = seen.get(seed)
        known = row is not None and row["toxic"] + row["clean"] >= MIN_DOCS
        share_of = (row["toxic"] + 0.5) / (row["toxic"] + row["clean"] + 0.5) if known else SEED_RELIABILITY
        reliability.setdefault(seed.encode(), share_of)
    terms = sorted(reliability)
    exact = {w: p for w, p in share.items() if w not in reliability}
    automaton = build_automaton(terms)
    marked = docs.sparkSession.sparkContext.broadcast(automaton)

    @F.arrow_udf("struct<term int, errors int>")
    def matched(words: pa.Array) -> pa.Array:
        terms_of, errors_of = np.full(len(words), -1), np.zeros(len(words), np.int64)
        for chunk in word_chunks(words):
            word, term, errors = marked.value.match(chunk)
            at = chunk.first + np.searchsorted(chunk.begins, word, "right") - 1
            terms_of[at], errors_of[at] = term, errors
        return pa.StructArray.from_arrays([pa.array(terms_of, pa.int32()), pa.array(errors_of, pa.int32())], ["term", "errors"])

    short = by_word.where((F.length("word") <= automaton.longest) & (F.length("word") >= 4))
    # Written before it is filtered: a filter on the match would be pushed below it and match again in the same task, which
    # takes a second Python worker for every core, and executors keep their workers.
    tried = work.keep(short.withColumn("match", matched("word")))
    near = tried.where("match.errors > 0").select("word", "toxic", "clean", "match.*")
    harmless = (F.col("clean") > F.col("toxic")) & (F.col("clean") >= MIN_CLEAN)
    exempt = [w.encode() for w in HARMLESS] + [r["word"].encode() for r in near.where(harmless).select("word").collect()]
    # At most a row for each term and number of errors.
    seen_near = (
        near.where(~harmless & ~F.col("word").isin(HARMLESS))
        .join(F.broadcast(proven.select("word")), "word", "left_anti")
        .groupBy("term", "errors")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    misspelled = {
        (r["term"], r["errors"]): (r["toxic"] + PRIOR_DOCS * overall) / (r["toxic"] + r["clean"] + PRIOR_DOCS)
        for r in seen_near.collect()
        if r["toxic"] + r["clean"] >= MIN_DOCS
    }
    work.drop(by_word, tried)
    return Lexicon(automaton, np.array([reliability[t] for t in terms]), frozenset(exempt), exact, misspelled)


def toxicity(lexicon: Lexicon, spark):
    """Column function: the score of a text."""
    known = spark.sparkContext.broadcast(lexicon)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(known.value.scores(texts))

    return score


def without_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their columns."""
    score: Column = toxicity(lexicon, docs.sparkSession)(F.col("text"))
    return docs.where(score < threshold)
