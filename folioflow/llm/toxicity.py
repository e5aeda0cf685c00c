"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored in context windows.

The lexicon is learned: words and word stems whose presence marks a text as toxic in a bounded, labelled sample. It is
held in a trie; the automaton for one edit is intersected with it state by state, each product state built once and
kept, so a word costs a few dictionary steps and misspellings ("idiiot", "m0ron") are caught. A term that one edit
turns into words of clean texts is matched exactly only.

A stem that clean texts have too, but never in several words of one text, is a weak term: it says nothing once and much when a
text has it again in another word. Weak terms are matched exactly.

Each match is read in its context: inside quotation marks it counts as quotation, outside as abuse, and the densest
window of 20 words counts beside the whole. A logistic model weighs these counts.

Learning runs in the cluster: terms are counted there, the automata meet the clean words there, and texts are scored
there. The driver gets the terms that pass the thresholds and six numbers for each row of the sample, never a text.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace

SPAN = 20
_EDGE = ".,;:!?()[]{}<>\"'“”„«»‚‘’*#%&$~_-+=|/\\…"
#: What closes a quotation that a word begins with; a mark that is never closed quotes nothing.
_CLOSING = {'"': '"', "'": "'", "“": "”", "„": "“”", "”": "”", "«": "»", "»": "«", "‘": "’", "‚": "‘’", "’": "’"}
_BEFORE, _AFTER = "([{*_-", ".,;:!?)]}*_-…"
_MOST_SEEN, _MOST_COUNTED = 120_000, 50_000
SIZE = 8  # features
_APART = 0.6
_STEM = (4, 8)  # letters of stems
_RUN, _GAP = 1 << 20, re.compile(r"\s")


class Lexicon:
    """Product automaton of the trie of terms and the one-edit Levenshtein automaton."""

    def __init__(self, stems: list[str], words: list[str], exact_only: frozenset[str] = frozenset(), weak: frozenset[str] = frozenset()):
        self.weak = weak
        self.kids: list[dict[str, int]] = [{}]
        self.stem: list[bool] = [False]
        self.word: list[bool] = [False]
        self.fuzzy: list[bool] = [False]
        for terms, flags in ((stems, self.stem), (words, self.word)):
            for term in terms:
                node = 0
                for c in term:
                    if c not in self.kids[node]:
                        self.kids[node][c] = len(self.kids)
                        self.kids.append({})
                        for own in (self.stem, self.word, self.fuzzy):
                            own.append(False)
                    node = self.kids[node][c]
                flags[node] = True
                self.fuzzy[node] |= len(term) >= 5 and term not in exact_only
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.mid: list[int] = []
        self.last: list[int] = []
        self.start = self._state(frozenset([(0, 0)]))

    def _state(self, positions: frozenset) -> int:
        if positions in self.ids:
            return self.ids[positions]
        mid = last = 0
        for node, edits in positions:
            ok = 1 if edits == 0 else 2 if self.fuzzy[node] else 0
            if ok and self.stem[node]:
                mid = ok if not mid else min(mid, ok)
            if ok and (self.stem[node] or self.word[node]):
                last = ok if not last else min(last, ok)
            if edits == 0:  # the term's last letter may be missing
                for kid in self.kids[node].values():
                    if (self.word[kid] or self.stem[kid]) and self.fuzzy[kid]:
                        last = last or 2
        self.ids[positions] = len(self.sets)
        self.sets.append(positions)
        self.next.append({})
        self.mid.append(mid)
        self.last.append(last)
        return len(self.sets) - 1

    def _step(self, state: int, c: str) -> int:
        out = set()
        for node, edits in self.sets[state]:
            kids = self.kids[node]
            if c in kids:
                out.add((kids[c], edits))
            if edits == 0:
                out.add((node, 1))
                for other, kid in kids.items():
                    if other != c:
                        out.add((kid, 1))
                    if c in self.kids[kid]:
                        out.add((self.kids[kid][c], 1))
        new = self._state(frozenset(x for x in out if not (x[1] == 1 and (x[0], 0) in out))) if out else -1
        if len(self.next) < 50_000:
            self.next[state][c] = new
        return new

    def weakly(self, word: str) -> bool:
        """Whether the word begins with a weak stem."""
        return bool(self.weak) and any(word[:k] in self.weak for k in range(_STEM[0], min(_STEM[1], len(word)) + 1))

    def match(self, word: str) -> int:
        """0 no term, 1 a term or a word that begins with a stem, 2 the same with one edit."""
        state, best = self.start, 0
        for c in word:
            new = self.next[state].get(c)
            state = self._step(state, c) if new is None else new
            if state < 0:
                return best
            if self.mid[state]:
                if self.mid[state] == 1:
                    return 1
                best = 2
        return self.last[state] or best


class Scorer:
    """Features of a text; words already judged are remembered, in sets that are emptied when they grow large."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.clean, self.hits = lexicon, set(), {}

    def features(self, text: str) -> list[float]:
        n, some = 0, False
        for words in _runs(text):
            n += len(words)
            own = set(words)
            for w in own - self.clean:
                if w not in self.hits:
                    bare = w.strip(_EDGE)
                    if kind := self.lexicon.match(bare) or 3 * self.lexicon.weakly(bare):
                        self.hits[w] = kind
                    else:
                        self.clean.add(w)
            some = some or not own.isdisjoint(self.hits)
            if len(self.clean) > _MOST_SEEN:
                self.clean.clear()
        exact = fuzzy = aside = densest = weak = 0
        forms: set[str] = set()
        if some:
            near: deque[int] = deque()  # the last terms outside quotations, SPAN words at most
            for i, w, inside in self._settled(text):
                kind = self.hits[w]
                if kind == 3:
                    if not inside:
                        weak += 1
                        forms.add(w.strip(_EDGE))
                elif inside:
                    aside += 1
                else:
                    exact, fuzzy = exact + (kind == 1), fuzzy + (kind == 2)
                    near.append(i)
                    while near[0] <= i - SPAN:
                        near.popleft()
                    densest = max(densest, len(near))
        if len(self.hits) > _MOST_SEEN:
            self.hits.clear()
        share = (exact + fuzzy) / n if n else 0.0
        weight = exact + 0.7 * fuzzy  # a misspelled term counts a little less
        return [1.0, float(weight > 0), math.log1p(weight), math.log1p(aside), math.log1p(densest), min(1.0, 10 * share), math.log1p(weak), math.log1p(max(0, len(forms) - 1))]

    def _settled(self, text: str):
        """(place, word, whether in a quotation) of the words that hold a term, in order; those behind an opening mark wait until it is
        closed or not."""
        marks, waiting, base = Quotes(), [], 0
        for words in _runs(text):
            for i, w in enumerate(words, base):
                run = None if w.isalpha() else marks.feed(i, w)
                if marks.begun == i or marks.begun is None and run is None and waiting:  # what came before was no quotation
                    yield from ((j, x, False) for j, x in waiting)
                    waiting = []
                if w in self.hits:
                    waiting.append((i, w))
                if run:
                    yield from ((j, x, j >= run[0]) for j, x in waiting)
                    waiting = []
            base += len(words)
        yield from ((j, x, False) for j, x in waiting)


class Quotes:
    """Quotation marks of a text, word by word: a quotation goes from a word that begins with a mark to the next one that ends with its
    counterpart.

    A mark inside a word (don't) or at the end of one with nothing open (5") is none; one that opens again before it is
    closed starts anew, so a stray mark does not turn the rest of the text around.
    """

    def __init__(self):
        self.begun, self.ends = None, None

    def feed(self, i: int, w: str) -> tuple[int, int] | None:
        """The places of the quotation that the word closes."""
        if w.isalpha():
            return None
        first = w.lstrip(_BEFORE)[:1]
        if first in _CLOSING and first and (self.ends is None or first not in self.ends or len(w) > 1 and w[-1:] not in self.ends):
            self.begun, self.ends = i, _CLOSING[first]
            if len(w.strip(_BEFORE + _AFTER)) == 1:
                return None
        tail = w.rstrip(_AFTER)[-1:]
        if self.begun is not None and tail and tail in self.ends and (i > self.begun or len(w.strip(_BEFORE + _AFTER)) > 1):
            run, self.begun, self.ends = (self.begun, i), None, None
            return run
        return None


def quoted(words: list[str]) -> list[bool]:
    """Which words stand in quotation marks."""
    out, marks = [False] * len(words), Quotes()
    for i, w in enumerate(words):
        if run := marks.feed(i, w):
            out[run[0] : i + 1] = [True] * (i + 1 - run[0])
    return out


def _runs(text: str):
    """The words of a text, lower-cased, in lists of about _RUN characters each: a very long text is never held as words."""
    a, n = 0, len(text)
    while a < n:
        b = a + _RUN
        if b < n:
            gap = _GAP.search(text, b)
            b = gap.start() if gap else n
        yield text[a : min(b, n)].lower().split()
        a = b


def _bag(text: str | None) -> set[str]:
    return {w.strip(_EDGE) for words in _runs(text or "") for w in words}


def _terms(words: set[str]):
    for w in words:
        if len(w) >= 3:
            yield w + "$"
        for k in range(_STEM[0], min(_STEM[1] + 1, len(w))):
            yield w[:k]


def _first_places(text: str) -> dict[str, str]:
    """The words on both sides of each word's first place."""
    first: dict[str, str] = {}
    before = last = None
    for words in _runs(text):
        for w in (w.strip(_EDGE) for w in words):
            if last is not None and last not in first:
                first[last] = f"{before or ''}\n{w}"
            before, last = last, w
    if last is not None and last not in first:
        first[last] = f"{before or ''}\n"
    return first


def _again(words: set[str]) -> set[str]:
    """Stems that several of the words begin with, each with a + at its end."""
    seen, again = set(), set()
    for w in words:
        for k in range(_STEM[0], min(_STEM[1], len(w)) + 1):
            (again if w[:k] in seen else seen).add(w[:k])
    return {t + "+" for t in again}


def _tally(batches):
    """(term, rows labelled 1, rows labelled 0, places) of a task, in runs of bounded size.

    places has one of 64 bits for the words on both sides of the term's first place in each toxic row, so rows that are
    copies of each other share a bit.
    """
    seen, places = (Counter(), Counter()), {}

    def flush():
        terms = list(seen[0].keys() | seen[1].keys())
        bits = np.array([places.get(t, 0) for t in terms], np.uint64).view(np.int64)
        batch = pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([seen[y][t] for t in terms], pa.int64()) for y in (1, 0)), pa.array(bits)], ["term", "toxic", "clean", "places"])
        seen[0].clear(), seen[1].clear(), places.clear()
        return batch

    for batch in batches:
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if y:
                first = _first_places(text.as_py() or "")
                own: dict[str, int] = {}
                for w, around in first.items():
                    bit = 1 << (crc32(around.encode("utf-8", "surrogatepass")) & 63)
                    for t in _terms((w,)):
                        own.setdefault(t, bit)
                for t in _again(set(first)):
                    own[t] = own.get(t[:-1]) or bit  # the stem's first place; a stem that is a whole word has the row's last
                for t, bit in own.items():
                    places[t] = places.get(t, 0) | bit
            else:
                bag = _bag(text.as_py())
                own = {*_terms(bag), *_again(bag)}
            seen[y].update(own.keys() if y else own)
            if len(seen[0]) + len(seen[1]) > _MOST_COUNTED:
                yield flush()
    yield flush()


def _split(terms: list[str]) -> tuple[list[str], list[str]]:
    return [t for t in terms if not t.endswith("$")], [t[:-1] for t in terms if t.endswith("$")]


def _risky(terms: list[str]):
    """Terms that one edit turns into a word of a clean text."""
    stems, words = _split(terms)
    every, alone = Lexicon(stems, words), {t: Lexicon(*_split([t])) for t in terms if len(t.rstrip("$")) >= 5}

    def run(batches):
        left, known = dict(alone), set()
        for batch in batches:
            for text in batch.column(0):
                for w in _bag(text.as_py()) - known:
                    if len(known) < _MOST_SEEN:
                        known.add(w)
                    if every.match(w):
                        for t in [t for t, own in left.items() if own.match(w) == 2]:
                            del left[t]
        yield pa.RecordBatch.from_arrays([pa.array([t for t in alone if t not in left], pa.string())], ["term"])

    return run


def choose(good: dict[str, int], most_terms: int) -> list[str]:
    """Terms of the lexicon from those that pass (with their rows): short ones first, none that begins with a chosen stem;
    then a stem gives way to the longest term that holds nearly all of its rows, the word or stem it was cut from."""
    chosen: list[str] = []
    stems: set[str] = set()
    for t in sorted(good, key=lambda t: (len(t.rstrip("$")), -good[t], t)):
        if not any(t[:k] in stems for k in range(1, len(t))):
            chosen.append(t)
            if not t.endswith("$"):
                stems.add(t)
    chosen = sorted(chosen, key=lambda t: (-good[t], t))[:most_terms]
    whole = []
    for t in chosen:
        longer = [u for u in good if u.startswith(t.rstrip("$")) and good[u] >= 0.9 * good[t]]
        whole.append(max(longer, key=lambda u: (len(u), u)) if longer and not t.endswith("$") else t)
    return sorted(set(whole), key=whole.index)


def fit(x: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """Weights of the logistic model by Newton's method; prior is the share of toxic rows among all labelled ones."""
    w, n1 = np.zeros(SIZE), max(1, int(y.sum()))
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (y - p) - 0.05 * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(SIZE), grad)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    w[0] += math.log(prior / (1 - prior)) - math.log(n1 / max(1, len(y) - n1))
    return w


def learn(sample: DataFrame, prior: float, most_terms: int = 2000) -> tuple[Lexicon, np.ndarray]:
    """Lexicon and weights from sample(toxic, text), which should be a stored table: it is read four times.

    A term passes when at least 3 toxic rows have it, when its share of clean rows is at most 2 % of its share of toxic
    ones, when so many rows would not all be toxic by chance for any of the terms counted, and when its neighbours differ
    from row to row: what only copies of a text share is no term. A stem is a weak term when all this holds for the rows that have
    it in two words. At most most_terms terms make the lexicon (see choose), from the 4 * most_terms of the most toxic rows; as many
    may be weak.
    """
    n = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = max(1, n.get(0, 0)), max(1, n.get(1, 0))
    tallies = sample.select("toxic", "text").mapInArrow(_tally, "term string, toxic long, clean long, places long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_count(F.bit_or("places")).alias("places"))
    often = tallies.where("toxic >= 3").persist()
    by_chance = n1 / (n0 + n1)
    apart = 64 * (1 - F.exp(-F.col("toxic") / 64))  # bits that so many unrelated rows would set
    good: dict[bool, dict[str, int]] = {}
    for weak in (False, True):
        own = often.where(F.col("term").endswith("+") == F.lit(weak))
        least = max(3, n1 // 200, math.ceil(math.log(max(1, own.count())) / -math.log(by_chance)) if by_chance < 1 else 3)
        passed = own.where((F.col("toxic") >= least) & (F.col("clean") * n1 <= 0.02 * n0 * F.col("toxic")) & (F.col("places") >= _APART * apart)).orderBy(F.desc("toxic"), "term").limit(4 * most_terms)
        good[weak] = {r[0]: r[1] for r in passed.select("term", "toxic").collect()}  # at most 4 * most_terms terms
    often.unpersist()
    chosen = choose(good[False], most_terms)
    strong = set(_split(chosen)[0])
    weak = frozenset(t[:-1] for t in good[True] if not any(t[:k] in strong for k in range(1, len(t))))
    risky = {r[0].rstrip("$") for r in sample.where("toxic = 0").select("text").mapInArrow(_risky(chosen), "term string").distinct().collect()} if chosen else set()
    lexicon = Lexicon(*_split(chosen), frozenset(risky), weak)

    def features(batches):
        scorer = Scorer(lexicon)
        for batch in batches:
            x = np.array([scorer.features(t.as_py() or "") for t in batch.column(1)]).reshape(-1, SIZE)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x[:, k]) for k in range(SIZE))], ["y", *(f"x{k}" for k in range(SIZE))])

    got = sample.select("toxic", "text").mapInArrow(features, ", ".join(["y int", *(f"x{k} double" for k in range(SIZE))])).toArrow()  # seven numbers a row
    own = np.array([c.to_numpy() for c in got.columns]).reshape(SIZE + 1, -1)
    own = own[:, np.lexsort(own)]  # sums in the same order whatever the partitions
    return lexicon, fit(own[1:].T, own[0], prior)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 3000, most_terms: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> tuple[Lexicon, np.ndarray]:
    """Learn from at most sample_rows labelled documents of each class, those with the smallest hashes among the rows held in."""
    ws = Workspace(docs.sparkSession, "toxicity")
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    counts = {r[0]: r[1] for r in usable.groupBy("toxic").count().collect()}
    ids = None
    for y in (0, 1):
        own = usable.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
        ids = own if ids is None else ids.union(own)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sample = ws.table(rows.join(F.broadcast(ids), "doc_id").select("toxic", "text"), "sample")  # at most 2 * sample_rows ids
    try:
        return learn(sample, counts.get(1, 0) / max(1, sum(counts.values())), most_terms)
    finally:
        ws.drop("sample")


def score(text: Column, lexicon: Lexicon, weights: np.ndarray) -> Column:
    """The score of a text; null counts as empty and gets the model's intercept."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(lexicon)
        for texts in batches:
            x = np.array([scorer.features(t or "") for t in texts]).reshape(-1, SIZE)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))))

    return run(text)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = 3000, most_terms: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Null and empty texts get the score of a text without terms. Rows are scored by their text alone, so repeated rows
    and rows without a doc_id (not held out) fare like any other; a doc_id that is repeated or labelled twice is learned
    from in every pairing. Texts are read whole, however long. Without labels, or with labels of one class only, nothing
    is a term and every score is near that class's share; an empty table gives an empty result; extra columns are ignored.
    """
    lexicon, weights = train(docs, labels, sample_rows, most_terms, id_col, text_col)
    held = F.crc32(F.col(id_col).cast("string")) % 3 == 1
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"), score(F.col(text_col), lexicon, weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, text_col: str = "text", **options) -> DataFrame:
    """The rows of docs whose own text is not predicted toxic, with all their columns."""
    lexicon, weights = train(docs, labels, text_col=text_col, **options)
    return docs.where(score(F.col(text_col), lexicon, weights) < threshold)
