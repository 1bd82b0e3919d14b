"""Spelling variants: words one edit apart, found with minimal automata of the vocabulary read in both directions.

Two words that differ by one edit agree on half of their code points, at the beginning or at the end. Each shard of the
vocabulary becomes a minimal acyclic automaton of its words and another of its reversed words. A word walks the first
half exactly in the forward automaton and completes the rest with one error, and its last half in the backward one. The
automata number their words (the count of words before a path's end), so a hit is a number that looks up the word's
count. A pair that agrees on the first half is taken from the forward walk alone, so none is found twice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, release, saved

LETTERS = r"[A-Za-zÀ-ÿ]+"
#: A word is kept with at least so many code points and occurrences; a form has so many times the occurrences.
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
#: One run in so many has a code point deleted.
DAMAGED = 97
#: Code points of the words of one automaton; words that agree on more than that are cut to pages that all are searched.
SHARD_CHARS = 400_000
#: Words are sharded by so many first (or last) code points at most.
KEY = 4
#: The words that ask at a page are dealt over so many tasks, each of which builds its automaton.
BLOCKS = 4
#: Tables of so many rows may be broadcast.
SMALL = 50_000


class Automaton:
    """Minimal acyclic automaton of sorted distinct words; a word's number is its rank.

    ``first[s]`` to ``first[s + 1]`` are the edges of state s, sorted by code point; ``skip`` is how many of the
    state's words come before those of the edge.
    """

    def __init__(self, words: list[str]):
        parent, label, final = _trie(words)
        self._minimise(parent, label, final)

    def _minimise(self, parent: np.ndarray, label: np.ndarray, final: np.ndarray) -> None:
        n = len(parent)
        # nodes were made level after level, so a parent comes before its children
        depth = np.zeros(n, np.int64)
        bounds = _levels(parent, depth)
        height = np.zeros(n, np.int64)
        for a, b in reversed(bounds[1:]):
            np.maximum.at(height, parent[a:b], height[a:b] + 1)
        by = np.argsort(parent[1:], kind="stable") + 1  # children in order of label, as words were sorted
        begin = np.concatenate([[0], np.cumsum(np.bincount(parent[1:], minlength=n))])
        degree = np.diff(begin)
        state = np.zeros(n, np.int64)
        rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        made = 0
        order = np.lexsort([degree, height])
        cuts = np.flatnonzero(np.diff(height[order]) | np.diff(degree[order])) + 1
        for nodes in np.split(order, cuts):
            k = int(degree[nodes[0]])
            own = by[begin[nodes][:, None] + np.arange(k)]
            sign = np.concatenate([final[nodes][:, None].astype(np.int64), label[own], state[own]], axis=1)
            kinds, which = np.unique(sign, axis=0, return_inverse=True)
            state[nodes] = made + which.ravel()
            rows.append((kinds[:, 0].astype(bool), kinds[:, 1 : 1 + k], kinds[:, 1 + k :]))
            made += len(kinds)
        self.root = int(state[0])
        self.final = np.concatenate([r[0] for r in rows])
        self.first = np.concatenate([[0], np.cumsum(np.concatenate([np.full(len(r[0]), r[1].shape[1]) for r in rows]))])
        self.label = np.concatenate([r[1].ravel() for r in rows])
        self.target = np.concatenate([r[2].ravel() for r in rows])
        self.skip = np.zeros(len(self.label), np.int64)
        words_of = np.zeros(made, np.int64)
        at = 0
        for ends, labels, targets in rows:  # lower states first: a state's targets are counted before it
            k = labels.shape[1]
            count = words_of[targets]
            before = ends[:, None] + np.cumsum(count, axis=1) - count
            self.skip[self.first[at] : self.first[at] + before.size] = before.ravel()
            words_of[at : at + len(ends)] = ends + count.sum(axis=1)
            at += len(ends)
        self.keys = np.repeat(np.arange(made), np.diff(self.first)) << 32 | self.label

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edges, which of the states have one) for a code point each."""
        asked = state << 32 | code
        at = np.searchsorted(self.keys, asked)
        at = np.minimum(at, max(0, len(self.keys) - 1))
        has = self.keys[at] == asked if len(self.keys) else np.zeros(len(asked), bool)
        return at[has], np.flatnonzero(has)

    def one_error(self, codes: np.ndarray, exact: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, number of the word met): all words one edit from a row of codes [rows, length] behind ``exact`` places.

        Of the places where an edit gives the same word (in a run of one letter) only the last is tried.
        """
        n, length = codes.shape
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        row, state, number = np.arange(n), np.full(n, self.root), np.zeros(n, np.int64)

        def rest(row: np.ndarray, edge: np.ndarray, number: np.ndarray, at: int) -> None:
            finish(row, self.target[edge], number + self.skip[edge], at)

        def finish(row: np.ndarray, state: np.ndarray, number: np.ndarray, at: int) -> None:
            while at < length and len(row):
                edge, has = self.step(state, codes[row, at])
                row, state, number = row[has], self.target[edge], number[has] + self.skip[edge]
                at += 1
            ends = self.final[state]
            found.append((row[ends], number[ends]))

        for at in range(length + 1):
            if at >= exact:
                here = codes[row, at] if at < length else np.full(len(row), -1)
                if at < length:
                    last = here != codes[row, at + 1] if at + 1 < length else np.ones(len(row), bool)
                    finish(row[last], state[last], number[last], at + 1)
                many = self.first[state + 1] - self.first[state]
                which = np.repeat(np.arange(len(row)), many)
                edge = np.repeat(self.first[state] - (np.cumsum(many) - many), many) + np.arange(len(which))
                other = self.label[edge] != here[which]
                which, edge = which[other], edge[other]
                rest(row[which], edge, number[which], at)  # inserted before this place
                if at < length:
                    rest(row[which], edge, number[which], at + 1)  # in this one's place
            if at < length:
                edge, has = self.step(state, codes[row, at])
                row, state, number = row[has], self.target[edge], number[has] + self.skip[edge]
            if not len(row):
                break
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' code points one after another, and where each word begins (one more than words)."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return flat, np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])


def _trie(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent, label, whether a word ends there) of the nodes, level after level; the root is node 0."""
    flat, begin = _codes(words)
    size = np.diff(begin)
    at = np.zeros(len(words), np.int64)
    parents, labels, made, alive, depth = [np.array([-1])], [np.array([-1])], 1, np.flatnonzero(size > 0), 0
    while len(alive):
        code = flat[begin[alive] + depth]
        new = np.ones(len(alive), bool)
        new[1:] = (at[alive][1:] != at[alive][:-1]) | (code[1:] != code[:-1])
        parents.append(at[alive[new]])
        labels.append(code[new])
        at[alive] = made + np.cumsum(new) - 1
        made += int(new.sum())
        depth += 1
        alive = alive[size[alive] > depth]
    final = np.zeros(made, bool)
    final[at] = True
    return np.concatenate(parents), np.concatenate(labels), final


def _levels(parent: np.ndarray, depth: np.ndarray) -> list[tuple[int, int]]:
    """Where each level's nodes begin and end; fills in the depths."""
    bounds, a, b = [(0, 1)], 0, 1
    while b < len(parent):
        end = b + int(np.searchsorted(parent[b:], b, "left"))  # parents of one level rise and lie before it
        depth[b:end] = depth[a] + 1
        bounds.append((b, end))
        a, b = b, end
    return bounds


def _near(table: pa.Table) -> pa.Table:
    """A shard's words and those that ask there, to (word, n_near, best_n, best) of the askers that meet one."""
    asks = table.column("asks").to_numpy(zero_copy_only=False)
    words, counts = np.array(table.column("word").to_pylist(), object), table.column("n").to_numpy()
    backward = bool(table.column("backward")[0].as_py())
    turn = (lambda w: w[::-1]) if backward else (lambda w: w)
    base = sorted({turn(w): int(c) for w, c in zip(words[~asks], counts[~asks], strict=True)}.items())  # two keys of a word may share a shard
    out = {"word": [], "n_near": [np.zeros(0, np.int64)], "best_n": [np.zeros(0, np.int64)], "best": []}
    if base:
        names, n = [w for w, _ in base], np.array([c for _, c in base])
        automaton = Automaton(names)
        begin = None
        forward = np.array([turn(w) for w in names], object)
        by_word = np.argsort(np.argsort(forward)) if backward else np.arange(len(names))  # ranks for ties
        queries: dict[int, list[str]] = {}
        for w in words[asks]:
            queries.setdefault(len(w), []).append(w)
        for length, own in queries.items():
            for k in range(0, len(own), 20_000):
                part = own[k : k + 20_000]
                codes = _codes([turn(w) for w in part])[0].reshape(len(part), length)
                row, number = automaton.one_error(codes, length - length // 2 if backward else length // 2)
                if backward:  # what agrees on the first half is found forward
                    if begin is None:
                        flat, begin = _codes(names)
                    half, ends = length // 2, begin[number + 1]
                    alike = np.ones(len(row), bool)
                    for p in range(half):
                        alike &= flat[np.maximum(ends - 1 - p, 0)] == codes[row, length - 1 - p]
                    row, number = row[~alike], number[~alike]
                order = np.lexsort([by_word[number], -n[number], row])
                row, number = row[order], number[order]
                some, first, many = np.unique(row, return_index=True, return_counts=True)
                out["word"] += [part[i] for i in some.tolist()]
                out["n_near"].append(many)
                out["best_n"].append(n[number[first]])
                out["best"] += forward[number[first]].tolist()
    return pa.table({"word": pa.array(out["word"], pa.string()), "n_near": np.concatenate(out["n_near"]).astype(np.int64), "best_n": np.concatenate(out["best_n"]).astype(np.int64), "best": pa.array(out["best"], pa.string())})


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased, one in DAMAGED with a code point deleted, of LEAST_LENGTH or
    more code points and LEAST_COUNT or more occurrences. A null id counts as an empty one, a null text has no runs."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), place), F.col("run").substr(place + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for the words of (word, n) that are one edit from another: how many, and the one
    with the largest n (ties: the smallest in code-point order). Words are distinct and have LEAST_LENGTH code points."""
    chars = words.agg(F.coalesce(F.sum(F.length("word")), F.lit(0))).first()[0]
    # each word is stored under up to two key lengths, in both directions
    shards = max(1, -(-4 * chars // SHARD_CHARS))

    def width(length):
        return F.least(F.floor(length / 2), F.lit(KEY)).cast("int")

    size = F.length("word")
    both = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("backward"))
    keyed = F.struct("backward", F.expr("if(backward, right(word, m), left(word, m))").alias("part"))
    stored = both.withColumn("m", F.explode(F.array_distinct(F.array(width(F.greatest(size - 1, F.lit(LEAST_LENGTH))), width(size), width(size + 1)))))
    stored = stored.select("word", "n", keyed.alias("key"))
    asks = both.withColumn("m", width(size)).select("word", "n", keyed.alias("key"))
    # keys that hold more than a shard are cut to pages of their own
    large = saved(stored.groupBy("key").agg(F.sum(F.length("word")).alias("chars")).where(F.col("chars") > SHARD_CHARS).select("key", F.ceil(F.col("chars") / SHARD_CHARS).alias("pages")), "large-keys")
    if large.count() <= SMALL:
        large = F.broadcast(large)
    stored, asks = (t.join(large, "key", "left").withColumn("pages", F.coalesce("pages", F.lit(1))) for t in (stored, asks))
    one = F.col("pages") == 1
    shard = F.pmod(F.xxhash64("key"), F.lit(shards))
    kinds = F.when(one, F.struct(shard.alias("shard"), F.lit(None).cast("string").alias("part"))).otherwise(F.struct(F.lit(-1).cast("long").alias("shard"), F.col("key.part").alias("part")))
    stored = stored.select("word", "n", F.lit(False).alias("asks"), F.col("key.backward").alias("backward"), kinds.alias("at"), F.when(one, 0).otherwise(F.pmod(F.xxhash64("word"), F.col("pages"))).alias("page"))
    asks = asks.select("word", "n", F.lit(True).alias("asks"), F.col("key.backward").alias("backward"), kinds.alias("at"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("pages") - 1)).alias("page"))
    block = F.when(F.col("at.part").isNull(), 0).otherwise(F.pmod(F.xxhash64("word", F.lit("ask")), F.lit(BLOCKS)))
    asks = asks.withColumn("block", block)
    stored = stored.withColumn("block", F.explode(F.when(F.col("at.part").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.lit(BLOCKS - 1).cast("long")))))
    met = stored.unionByName(asks).groupBy("backward", "at", "page", "block").applyInArrow(_near, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def with_roots(forms: DataFrame) -> DataFrame:
    """(word, form) with ``root``: the last word that forms lead to, the word itself if it has none.

    Forms have larger counts than their words, so they end. Each step looks up the root of the root so far, which
    doubles the way it has gone, until nothing changes.
    """
    now = saved(forms.select("word", "form", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        ahead = now.where("form is not null").select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = saved(now.join(ahead, "root", "left").select("word", "form", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        release(now)
        now = stepped
        if now.where("moved").isEmpty():
            return now.drop("moved")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word of word_counts: word, form, root, n, n_near, form_n.

    n_near is how many words differ from it by one inserted, deleted or replaced code point; form is the one of these
    with the largest n (ties: the smallest in code-point order) if that is TIMES as much as the word's own, else null.

    Null and empty texts have no words; rows that repeat, with or without an id, count each; words of any length are
    taken whole; an empty table gives no rows; other columns are ignored.
    """
    words = saved(word_counts(docs, id_col, text_col), "words")
    near = saved(words.join(near_words(words), "word", "left"), "near-words")
    takes = F.col("best_n") >= TIMES * F.col("n")
    forms = near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(takes, F.col("best")).alias("form"), F.when(takes, F.col("best_n")).alias("form_n"))
    forms = saved(forms, "forms")
    return forms.join(with_roots(forms).select("word", "root"), "word").select("word", "form", "root", "n", "n_near", "form_n")
