"""Toxicity: a lexicon learned from labels, matched with misspellings, scored in context.

A deterministic automaton is compiled that is the intersection of the terms' Levenshtein automata with the trie of
the lexicon: its states are sets of (trie node, errors so far). All words of a batch run through it together, one
character a step. A hit's surroundings tell abuse from quotation: hits between quotation marks and hits in the open
are counted apart, as is how densely hits crowd in a window of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, with_field
from .hashing import slices
from .labelled import labelled_sample

#: The training sample's bound by label.
SAMPLE = {0: 5000, 1: 5000}
HELD_OUT = 1
#: A term must occur in so many different surroundings of toxic documents, in at most a share of that elsewhere, and so
#: many standard deviations more often than the share of toxic documents in the sample explains.
MIN_SUPPORT, MOST_ELSEWHERE, MIN_DEVIATIONS = 5, 0.05, 4.4
#: Terms an automaton is made of; a larger lexicon becomes several.
TERMS_TOGETHER = 100
WINDOW = 12
_OPENING, _CLOSING = "“«„‹", "”»›"
_POINTS = 0x110000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: is it part of a word; is it a straight quote (1), an opening (2) or closing one (3)."""
    word = np.array([chr(i).isalnum() or i == 95 for i in range(_POINTS)])
    quote = np.zeros(_POINTS, np.uint8)
    quote[34] = 1
    for marks, kind in ((_OPENING, 2), (_CLOSING, 3)):
        quote[[ord(c) for c in marks]] = kind
    return word, quote


_WORD, _QUOTE = _tables()


def _lowered(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts of a slice as one lower-case string, its code points, and where each text begins."""
    raw = data.tobytes()
    texts = [raw[a:b].decode("utf-8", "replace").lower() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    whole = "".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    return whole, points, np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)


def _spans(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of letters and digits, and the text of each."""
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = _WORD[points]
    edge = np.zeros(len(points) + 1, bool)
    edge[bounds] = True
    shifted = np.concatenate([[False], solid[:-1]])
    starts = np.flatnonzero(solid & (~shifted | edge[:-1]))
    after = np.concatenate([solid[1:], [False]])
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends - starts, np.searchsorted(bounds, starts, "right") - 1


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(y, text) to the distinct (word, y, hash of the words before and after)."""
    for batch in batches:
        labels = batch.column("y").to_pylist()
        for at, end, data, offsets in slices(batch.column("text"), 500_000):
            whole, points, bounds = _lowered(data, offsets)
            starts, sizes, text = _spans(points, bounds)
            words = [whole[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
            owner = text.tolist()
            seen = set()
            for i, w in enumerate(words):
                before = words[i - 1] if i and owner[i - 1] == owner[i] else ""
                after = words[i + 1] if i + 1 < len(words) and owner[i + 1] == owner[i] else ""
                seen.add((w, labels[at + owner[i]], f"{before} {after}"))
            if seen:
                w, y, around = zip(*seen, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(y, pa.int32()), pa.array(around)], names=["word", "y", "around"])


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Terms and weights from (text, y).

    A term counts once for each pair of neighbours, so copies of one document, however many, count once too. All terms
    that pass the test are taken; as the sample is bounded, so are they.
    """
    toxic, all_ = sample.agg(F.count(F.when(F.col("y") == 1, 1)), F.count("*")).first()
    share = toxic / max(all_, 1)
    seen = sample.select("y", "text").mapInArrow(_surroundings, "word string, y int, around string")
    counted = seen.groupBy("word").agg(
        F.countDistinct(F.when(F.col("y") == 1, F.xxhash64("around"))).alias("toxic"), F.countDistinct(F.when(F.col("y") == 0, F.xxhash64("around"))).alias("other")
    )
    many = F.col("toxic") + F.col("other")
    surprise = (F.col("toxic") - many * share) / F.sqrt(many * (share * (1 - share)))
    good = counted.where((F.col("toxic") >= MIN_SUPPORT) & (F.col("other") <= F.col("toxic") * MOST_ELSEWHERE) & (F.coalesce(surprise, F.lit(0.0)) >= MIN_DEVIATIONS))
    rows = good.orderBy(F.desc("toxic"), "word").collect()
    return {r["word"]: float(np.log((r["toxic"] + 0.5) / (r["other"] + 0.5))) for r in rows}


def allowed_errors(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Matcher:
    """Finds a lexicon's terms, misspelled or not, by one automaton for every TERMS_TOGETHER of them."""

    def __init__(self, terms: list[str], errors=allowed_errors):
        self.terms = list(terms)
        self.parts = [(at, Automaton(self.terms[at : at + TERMS_TOGETHER], errors)) for at in range(0, len(self.terms), TERMS_TOGETHER)]

    def match(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the word, term, errors) for the words that match; each with its nearest term, the first on ties."""
        found = [(word, term + at, errors) for at, part in self.parts for word, term, errors in [part.match(points, starts, sizes)]]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        word, term, errors = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
        order = np.lexsort((term, errors, word))
        word, term, errors = word[order], term[order], errors[order]
        first = np.ones(len(word), bool)
        first[1:] = word[1:] != word[:-1]
        return word[first], term[first], errors[first]


class Automaton:
    """The automaton as arrays: step[state, class of character] and, by state, the term it accepts (-1: none) and errors."""

    def __init__(self, terms: list[str], errors=allowed_errors):
        self.terms = list(terms)
        alphabet = sorted(set("".join(terms)))
        class_of = {c: i + 1 for i, c in enumerate(alphabet)}
        # by code point for those of two bytes; the alphabet's few others are looked up
        self.classes = np.zeros(1 << 16, np.uint8 if len(alphabet) < 255 else np.uint16)
        for c, k in class_of.items():
            if ord(c) < 1 << 16:
                self.classes[ord(c)] = k
        self.wide = np.array([ord(c) for c in alphabet if ord(c) >= 1 << 16], np.uint32)
        self.wide_classes = np.array([class_of[chr(p)] for p in self.wide.tolist()], self.classes.dtype)
        children: list[dict[int, int]] = [{}]
        ends, reach = [-1], [0]
        for k, term in enumerate(terms):
            node = 0
            reach[0] = max(reach[0], errors(term))
            for c in term:
                c = class_of[c]
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ends.append(-1)
                    reach.append(0)
                node = children[node][c]
                reach[node] = max(reach[node], errors(term))
            if ends[node] < 0:
                ends[node] = k

        def closed(found: dict[int, int]) -> frozenset:
            """With the nodes that skipping characters of terms reaches; a node keeps its fewest errors."""
            todo = list(found.items())
            while todo:
                node, e = todo.pop()
                if found.get(node, 99) < e:
                    continue
                for child in children[node].values():
                    if e + 1 <= reach[child] and e + 1 < found.get(child, 99):
                        found[child] = e + 1
                        todo.append((child, e + 1))
            return frozenset(found.items())

        def after(state: frozenset, c: int) -> frozenset:
            found: dict[int, int] = {}
            for node, e in state:
                for symbol, child in children[node].items():
                    cost = e + (symbol != c)
                    if cost <= reach[child] and cost < found.get(child, 99):
                        found[child] = cost
                if e + 1 <= reach[node] and e + 1 < found.get(node, 99):
                    found[node] = e + 1
            return closed(found)

        start = closed({0: 0})
        ids, todo, rows = {frozenset(): 0, start: 1}, [start], [[0] * (len(alphabet) + 1)]
        accept = [(-1, 0)]
        for state in todo:  # grows while it runs
            best = min(((e, ends[n]) for n, e in state if ends[n] >= 0 and e <= errors(self.terms[ends[n]])), default=(0, -1))
            accept.append((best[1], best[0]))
            row = []
            common: frozenset | None = None
            live = {symbol for node, _ in state for symbol in children[node]}
            for c in range(len(alphabet) + 1):
                if c in live:
                    target = after(state, c)
                else:  # every character that no edge bears leads to the same state
                    common = after(state, -1) if common is None else common
                    target = common
                if target not in ids:
                    ids[target] = len(ids)
                    todo.append(target)
                row.append(ids[target])
            rows.append(row)
        self.step = np.array(rows, np.int32)
        self.accept = np.array([a for a, _ in accept], np.int32)
        self.errors = np.array([e for _, e in accept], np.int8)
        self.longest = max((len(t) + errors(t) for t in terms), default=0)

    def class_numbers(self, points: np.ndarray) -> np.ndarray:
        out = np.where(points < 1 << 16, self.classes[np.minimum(points, 0xFFFF)], 0)
        if len(self.wide):
            at = np.minimum(np.searchsorted(self.wide, points), len(self.wide) - 1)
            out = np.where(self.wide[at] == points, self.wide_classes[at], out)
        return out

    def match(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the word, term, errors) for the words that match a term."""
        alive = np.flatnonzero(sizes <= self.longest)
        state = np.ones(len(alive), np.int32)
        hits = [(np.zeros(0, np.int64), np.zeros(0, np.int32))]
        for k in range(self.longest + 1):
            ended = sizes[alive] == k
            if ended.any():
                ok = ended & (self.accept[state] >= 0)
                hits.append((alive[ok], state[ok]))
                alive, state = alive[~ended], state[~ended]
            if not len(alive):
                break
            state = self.step[state, self.class_numbers(points[starts[alive] + k])]
            live = state > 0
            alive, state = alive[live], state[live]
        word = np.concatenate([h[0] for h in hits])
        final = np.concatenate([h[1] for h in hits])
        order = np.argsort(word, kind="stable")
        return word[order], self.accept[final[order]], self.errors[final[order]]


def quoted(points: np.ndarray, bounds: np.ndarray, at: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Is each position between quotation marks of its text that open before it and close after it."""
    kind = _QUOTE[points]
    counts = [np.concatenate([[0], np.cumsum(kind == k)]) for k in (1, 2, 3)]
    first, last = bounds[text], bounds[text + 1]
    straight = counts[0]
    inside = ((straight[at] - straight[first]) % 2 == 1) & (straight[last] > straight[at])
    curly = ((counts[1][at] - counts[1][first]) > (counts[2][at] - counts[2][first])) & (counts[2][last] > counts[2][at])
    return inside | curly


N_FEATURES = 7


def describe(matcher: Matcher, weights: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Features [texts, N_FEATURES] of whole texts: a one, then what exact, misspelled and quoted hits show."""
    n = len(offsets) - 1
    out = np.zeros((n, N_FEATURES))
    out[:, 0] = 1
    _, points, bounds = _lowered(data, offsets)
    starts, sizes, text = _spans(points, bounds)
    word, term, errors = matcher.match(points, starts, sizes)
    if not len(word):
        return out
    owner, weight = text[word], weights[term]
    cited = quoted(points, bounds, starts[word], owner)
    exact, loose = ~cited & (errors == 0), ~cited & (errors > 0)
    out[:, 1] = np.log1p(np.bincount(owner[exact], weight[exact], n))
    np.maximum.at(out[:, 2], owner[exact], weight[exact])
    out[:, 3] = np.log1p(np.bincount(owner[loose], weight[loose], n))
    out[:, 4] = np.log1p(np.bincount(owner[cited], weight[cited], n))
    open_hits = np.flatnonzero(~cited)
    place = word[open_hits]
    if len(place):  # a window that reaches into another text counts only its own
        own = owner[open_hits]
        low, high = np.searchsorted(own, own), np.searchsorted(own, own, "right")
        crowd = np.minimum(np.searchsorted(place, place + WINDOW, "right"), high) - np.maximum(np.searchsorted(place, place - WINDOW), low) - 1
        np.maximum.at(out[:, 5], own, crowd.astype(float))
    out[:, 5] = np.log1p(out[:, 5])
    pairs = np.unique(owner[exact] * (len(matcher.terms) + 1) + term[exact]) // (len(matcher.terms) + 1)
    out[:, 6] = np.log1p(np.bincount(pairs, minlength=n))
    return out


#: What the coefficients are drawn to where labels say little: hits in the open count, quoted ones hardly.
_PRIOR = np.array([-4.0, 1.0, 0.5, 0.3, 0.1, 0.3, 0.5])


_LEAST = 0.05


def fit_logistic(x: np.ndarray, y: np.ndarray, strength: float = 1.0) -> np.ndarray:
    w = _PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + strength * (w - _PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return np.concatenate([w[:1], np.maximum(w[1:], _LEAST)])  # a hit never speaks for a text


def _scores(matcher: Matcher, weights: np.ndarray, coefficients: np.ndarray | None, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in slices(batch.column("text")):
                x = describe(matcher, weights, data, offsets)
                kept = [batch.column(i).slice(at, end - at) for i in range(batch.num_columns)]
                if coefficients is None:
                    yield pa.RecordBatch.from_arrays([kept[batch.schema.get_field_index("y")].cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])
                else:
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(1 / (1 + np.exp(-np.clip(x @ coefficients, -30, 30))))], names=[*batch.schema.names, column])

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> tuple[Matcher, np.ndarray, np.ndarray]:
    """Lexicon, its automaton and the scorer's coefficients, from a bounded labelled sample outside the held-out fold."""
    chosen = labelled_sample(docs, labels, "toxic", sample or SAMPLE, HELD_OUT)
    lexicon = learn_lexicon(chosen)
    matcher, weights = Matcher(list(lexicon)), np.array(list(lexicon.values()), float)
    rows = chosen.select("y", "text").mapInArrow(_scores(matcher, weights, None, ""), "y int, x array<double>").collect()
    x, y = np.array([r["x"] for r in rows], float).reshape(-1, N_FEATURES), np.array([r["y"] for r in rows], float)
    order = np.lexsort([*x.T, y])  # rows come in any order; the sums don't depend on it
    return matcher, weights, fit_logistic(x[order], y[order])


def with_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with ``score`` added (a column of that name is replaced): the chance of label 1 by the whole text alone.

    Without labelled documents nothing is toxic; null and empty texts have no hits. Rows, repeated ones too, stay as
    they are, and an empty table stays empty.
    """
    kept = docs.drop("score")
    return kept.mapInArrow(_scores(*fit_toxicity(docs, labels), "score"), with_field(kept, "score", "double"))


def classify_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 where score >= threshold).

    Null and empty texts have no hits and score the base rate; without labels the lexicon is empty and so all do. A
    null doc_id is kept with a null held_out; repeated rows are scored each; an empty table gives no rows; other
    columns are never read.
    """
    scored = with_toxicity(docs.select("doc_id", "text"), labels)
    held = fold_of(F.col("doc_id"), 3) == HELD_OUT
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
