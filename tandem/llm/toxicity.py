"""Toxicity scores from a learned lexicon, found also where it is misspelled, and weighed by context.

Finding terms: whole-word terms form a trie. The Levenshtein automata of all of them are run at once by intersecting
them with the trie: a state is a set of (trie node, edits so far), and the steps between such states are remembered,
so a word costs a look-up for each letter until no term is near. Stems match the beginnings of words exactly.

Context: a term counts less inside quotation marks or beside words that report speech. A window slides over the places
of the hits; the highest sum of weights in one window tells a burst of abuse from single words far apart.

Learning: terms (words and stems) come from a bounded sample of labelled rows, ``SAMPLE`` at most, picked by a hash of their
ids. Chosen are, one after the other, the terms that explain most toxic rows not yet explained, with clean rows
counted against them. A logistic model of four figures of a text then gives the score. Nothing but the text is an input.

Defined results: a null or empty text has no hits and gets the score of such texts; without labels of both kinds every
score is 0; each row is scored for itself, so repeated rows get the same score. A null id is never learned from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import log, log1p

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.session import store

#: Labelled rows that are learned from, at most about; the only bound, of the training sample alone.
SAMPLE = 20_000
#: Candidate terms that are counted in clean rows, and terms in the lexicon, at most.
CANDIDATES, TERMS = 30_000, 400
#: Letters in the shortest term or stem; a clean row weighs as much as so many toxic ones when terms are chosen.
SHORTEST, CLEAN_WEIGHT = 4, 2
#: Tokens in a context window, and the shares of its weight that a misspelled or quoted term keeps.
CONTEXT, MISSPELT, QUOTED = 25, 0.6, 0.3

_WORD = re.compile(r"[^\W_]+")
_OPEN, _CLOSE = "\"'“„«‹‘", "\"'”“»›’"
_REPORTS = frozenset(
    "said says called calls quote quoted quotes wrote word term sagte sagt nannte wort zitat dit disait mot terme citation"
    " dijo dice palabra cita".split()
)


def letters(token: str) -> list[str]:
    """The words of a token in lower case."""
    return _WORD.findall(token)


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Trie:
    """Terms as nodes: ``ways`` by letter, ``term`` that ends here."""

    def __init__(self, terms: Iterable[tuple[str, int]]) -> None:
        self.ways: list[dict[str, int]] = [{}]
        self.term: list[tuple[str, int] | None] = [None]
        self.most: list[int] = [0]  # edits that some term below a node allows
        for term, edits in terms:
            node = 0
            self.most[0] = max(self.most[0], edits)
            for ch in term:
                if ch not in self.ways[node]:
                    self.ways[node][ch] = len(self.ways)
                    self.ways.append({})
                    self.term.append(None)
                    self.most.append(0)
                node = self.ways[node][ch]
                self.most[node] = max(self.most[node], edits)
            self.term[node] = (term, edits)


class Matcher:
    """The nearest term of a word: the Levenshtein automata of all terms, run on the trie."""

    def __init__(self, terms: Iterable[tuple[str, int]]) -> None:
        self.trie = Trie(terms)
        self.letters = {ch for ways in self.trie.ways for ch in ways}
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.ends: list[tuple[str, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """The number of the state with these nodes and their fewest edits, missing letters added."""
        todo = list(reached)
        while todo:
            node = todo.pop()
            edits = reached[node] + 1
            for child in self.trie.ways[node].values():
                if edits <= self.trie.most[child] and edits < reached.get(child, 9):
                    reached[child] = edits
                    todo.append(child)
        key = frozenset(reached.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            ended = [(e, self.trie.term[n][0]) for n, e in key if self.trie.term[n] and e <= self.trie.term[n][1]]
            self.ends.append(min(ended)[::-1] if ended else None)
        return self.states[key]

    def _step(self, state: int, ch: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.trie.most[node] and edits < reached.get(node, 9):
                reached[node] = edits

        for node, edits in self.sets[state]:
            reach(node, edits + 1)  # a letter too many
            for letter, child in self.trie.ways[node].items():
                reach(child, edits + (letter != ch))
        return self._state(reached) if reached else -1

    def nearest(self, word: str) -> tuple[str, int] | None:
        """(term, edits) with the fewest edits, ties by term; None if none is within its limit."""
        state = self.start
        for ch in word:
            ch = ch if ch in self.letters else "\0"
            after = self.steps[state].get(ch)
            if after is None:
                after = self.steps[state][ch] = self._step(state, ch)
            if after < 0:
                return None
            state = after
        return self.ends[state]


@dataclass
class Model:
    """Terms and stems with their weights, and the coefficients of the figures."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    fuzzy: dict[str, int] = field(default_factory=dict)  # edits allowed, by whole-word term
    centre: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    slopes: list[float] = field(default_factory=list)
    base: float | None = None


class Scorer:
    """Applies a model to texts; remembers the weight of the tokens it has met."""

    REMEMBERED = 250_000

    def __init__(self, model: Model) -> None:
        self.model = model
        self.matcher = Matcher([(w, model.fuzzy.get(w, 0)) for w in model.words])
        self.stems = tuple(model.stems)
        self.met: set[str] = set()
        self.hot: dict[str, float] = {}

    def weight(self, token: str) -> float:
        """The weight of a token in lower case: of its exact term or stem, or a share of that of a near one."""
        best = 0.0
        for word in letters(token):
            found = self.matcher.nearest(word)
            if found is not None:
                best = max(best, self.model.words[found[0]] * (1.0 if found[1] == 0 else MISSPELT))
            if self.stems and word.startswith(self.stems):
                best = max(best, max(w for s, w in self.model.stems.items() if word.startswith(s)))
        return best

    def hits(self, text: str) -> tuple[list[tuple[int, float]], int]:
        """Places and weights of the hits, and the number of tokens."""
        tokens = text.lower().split()
        new = set(tokens).difference(self.met)
        if new:
            if len(self.met) > self.REMEMBERED:
                self.met.clear()
                self.hot.clear()
                new = set(tokens)
            for token in new:
                if w := self.weight(token):
                    self.hot[token] = w
            self.met |= new
        if self.hot.keys().isdisjoint(tokens):
            return [], len(tokens)
        hot = self.hot
        places = [(i, hot[t]) for i, t in enumerate(tokens) if t in hot]
        return [(i, w * (QUOTED if quoted(tokens, i) else 1.0)) for i, w in places], len(tokens)

    def figures(self, text: str | None) -> tuple[float, float, float, float]:
        """The sum of all weights, the highest sum in a window, the share of tokens hit, and whether there is any hit."""
        found, n = self.hits(text or "")
        if not found:
            return 0.0, 0.0, 0.0, 0.0
        total = sum(w for _, w in found)
        return log1p(total), log1p(highest_window(found, CONTEXT)), log1p(100 * total / n), 1.0

    def score(self, text: str | None) -> float:
        m = self.model
        if m.base is None:
            return 0.0
        z = m.base + sum(k * (x - c) / s for x, k, c, s in zip(self.figures(text), m.slopes, m.centre, m.scale, strict=True))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def quoted(tokens: list[str], at: int, reach: int = 6) -> bool:
    """Whether a token lies between quotation marks, or shortly after a word that reports speech."""
    before, after = tokens[max(0, at - reach) : at + 1], tokens[at : at + reach + 1]
    opens = next((True for t in reversed(before) if t[0] in _OPEN), False)
    closes = next((True for t in after if t.rstrip(".,;:!?")[-1:] in _CLOSE and t.rstrip(".,;:!?")), False)
    return (opens and closes) or any(t.strip(".,;:!?\"'") in _REPORTS for t in tokens[max(0, at - 2) : at])


def highest_window(found: list[tuple[int, float]], width: int) -> float:
    best = now = 0.0
    first = 0
    for place, weight in found:
        now += weight
        while place - found[first][0] >= width:
            now -= found[first][1]
            first += 1
        best = max(best, now)
    return best


def terms_of(text: str | None) -> set[str]:
    """The different words of a text, and their beginnings as stems, marked by a star."""
    words = set(letters((text or "").lower()))
    return {w for w in words if len(w) >= SHORTEST} | {f"{w[:k]}*" for w in words for k in range(SHORTEST, len(w))}


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """``text, toxic`` of labelled rows that aren't held out, each text once; about ``most`` of them, picked by a hash of the id."""
    known = labels.select(F.col("doc_id").alias("_i"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isNotNull() & F.col("_i").isNotNull()).where(~held_out(F.col("_i")))
    n = known.count()
    if n > most:
        known = known.where(F.pmod(F.xxhash64(F.lit(3), "_i"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    rows = docs.select(F.col("doc_id").alias("_d"), "text").join(F.broadcast(known.groupBy("_i").agg(F.max("toxic").alias("toxic"))), F.col("_d") == F.col("_i"))
    return rows.groupBy("text").agg(F.max("toxic").alias("toxic"))


def _counts(sample: DataFrame, toxic: int, among: frozenset[str] | None) -> DataFrame:
    """``term, n``: the rows of one label that hold each term; only terms ``among`` those given."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                terms = terms_of(text)
                n.update(terms if among is None else terms & among)
            if len(n) > 500_000:
                yield pd.DataFrame(list(n.items()), columns=["term", "n"])
                n.clear()
        yield pd.DataFrame(list(n.items()), columns=["term", "n"])

    found = sample.where(F.col("toxic") == toxic).select("text").mapInPandas(run, "term string, n long")
    return found.groupBy("term").agg(F.sum("n").alias("n"))


def choose_terms(holders: dict[str, set[int]], clean: dict[str, int], least: int) -> list[str]:
    """Terms by the toxic rows they add to those already explained, less ``CLEAN_WEIGHT`` for each clean row."""
    left = {t: rows for t, rows in holders.items()}
    explained: set[int] = set()
    chosen: list[str] = []
    while left and len(chosen) < TERMS:
        gains = {t: len(rows - explained) - CLEAN_WEIGHT * clean.get(t, 0) for t, rows in left.items()}
        # Of equal gains a whole word, then the longer one: the narrower claim.
        best = max(gains, key=lambda t: (gains[t], not t.endswith("*"), len(t), t))
        if gains[best] < least:
            break
        chosen.append(best)
        explained |= left.pop(best)
        left = {t: rows for t, rows in left.items() if gains[t] >= least}
    return chosen


def train(sample: DataFrame) -> Model:
    """Learn the lexicon and the model; what comes to the driver is bounded by the sample."""
    sample = store(sample, "toxic-sample")
    sizes = dict(sample.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model()
    least = max(2, n_toxic // 200)
    frequent = _counts(sample, 1, None).where(F.col("n") >= least).orderBy(F.desc("n"), "term").limit(CANDIDATES)
    toxic = {r["term"]: r["n"] for r in frequent.collect()}
    clean = {r["term"]: r["n"] for r in _counts(sample, 0, frozenset(toxic)).collect()}
    useful = frozenset(t for t, n in toxic.items() if n - CLEAN_WEIGHT * clean.get(t, 0) >= least)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"terms": [sorted(terms_of(t) & useful) for t in batch["text"]]})

    holders: dict[str, set[int]] = {}
    for i, row in enumerate(sample.where("toxic = 1").select("text").mapInPandas(run, "terms array<string>").collect()):
        for term in row["terms"]:
            holders.setdefault(term, set()).add(i)
    chosen = choose_terms(holders, clean, least)
    # A term's own words and the stems of the same word are one clue: keep every useful whole word that a hit may be.
    weight = {t: min(6.0, log((toxic[t] + 0.5) / (n_toxic + 1)) - log((clean.get(t, 0) + 0.5) / (n_clean + 1))) for t in useful}
    words = {t: weight[t] for t in chosen if not t.endswith("*")}
    words |= {t: weight[t] for t in useful if not t.endswith("*") and toxic[t] >= max(5, 0.02 * n_toxic) and not clean.get(t)}
    stems = {t[:-1]: weight[t] for t in chosen if t.endswith("*")}
    model = Model(words, stems, {w: edits_allowed(w) for w in words})
    model.fuzzy = _safe_edits(sample, model)
    return _fit(sample, model)


def _safe_edits(sample: DataFrame, model: Model) -> dict[str, int]:
    """Edits by term; none where words of clean rows lie as near to the term as those of toxic rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(model.fuzzy.items())
        seen: dict[str, tuple[str, int] | None] = {}
        n: Counter[tuple[str, int]] = Counter()
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                near = set()
                for word in set(letters((text or "").lower())):
                    if word not in seen:
                        seen[word] = matcher.nearest(word)
                    if seen[word] is not None and seen[word][1]:
                        near.add(seen[word][0])
                n.update((t, int(toxic)) for t in near)
        yield pd.DataFrame([(t, k, c) for (t, k), c in n.items()], columns=["term", "toxic", "n"])

    found = sample.mapInPandas(run, "term string, toxic int, n long").groupBy("term", "toxic").agg(F.sum("n").alias("n"))
    n = {(r["term"], r["toxic"]): r["n"] for r in found.collect()}
    return {t: e if n.get((t, 1), 0) >= n.get((t, 0), 0) else 0 for t, e in model.fuzzy.items()}


def _fit(sample: DataFrame, model: Model) -> Model:
    """Logistic regression with a ridge, by Newton's method, on the figures of the sample."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for batch in batches:
            out = [(*scorer.figures(t), float(y)) for t, y in zip(batch["text"], batch["toxic"], strict=True)]
            yield pd.DataFrame(out, columns=["a", "b", "c", "d", "y"])

    # Equal rows are counted, so that the order of rows changes nothing.
    rows = sample.mapInPandas(run, "a double, b double, c double, d double, y double").groupBy("a", "b", "c", "d", "y").count()
    data = np.array(sorted(map(tuple, rows.collect())), float)
    x, y, n = data[:, :4], data[:, 4], data[:, 5]
    centre = np.average(x, axis=0, weights=n)
    scale = np.sqrt(np.average((x - centre) ** 2, axis=0, weights=n)) + 1e-6
    z = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    beta, ridge = np.zeros(z.shape[1]), np.diag([1e-6] + [0.1] * 4)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (n * (p - y)) + ridge @ beta
        hessian = (z.T * (n * p * (1 - p) + 1e-9)) @ z + ridge
        step = np.linalg.solve(hessian, gradient)
        beta -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    model.centre, model.scale = centre.tolist(), scale.tolist()
    model.slopes, model.base = beta[1:].tolist(), float(beta[0])
    return model


def add_score(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """All columns and the score of each text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype=float)

    return docs.withColumn(score, F.pandas_udf(run, "double")(text))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    model = train(training_sample(docs, labels))
    scored = add_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents that are not judged toxic, with all their columns."""
    own = "_toxicity"
    return add_score(docs, train(training_sample(docs, labels)), score=own).where(F.col(own) < threshold).drop(own)
