"""A bounded store of what a tokenizer makes of single pieces of text, which mostly recur."""

from __future__ import annotations

import numpy as np


class PieceStore:
    """Encodes texts as the joined ids of their pieces; subclasses cut texts and encode new pieces.

    Cutting must not change what the tokenizer gives. The store forgets everything when it has grown past ``most``
    pieces, so memory is bounded whatever the texts.
    """

    def __init__(self, most: int = 300_000):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def cut(self, text: str) -> list[str]:
        raise NotImplementedError

    def learn(self, fresh: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(the same pieces in any order, their ids one after another, how many each has)."""
        raise NotImplementedError

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.number) > self.most:
            self._clear()
        pieces = [self.cut(t) for t in texts]
        every = [p for own in pieces for p in own]
        fresh = list(set(every).difference(self.number))
        if fresh:
            order, flat, sizes = self.learn(fresh)
            for p in order:
                self.number[p] = len(self.number)
            self.flat = np.concatenate([self.flat, flat])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        which = np.fromiter(map(self.number.__getitem__, every), np.int64, len(every))
        sizes = self.ends[which + 1] - self.ends[which]
        stops = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.ends[which] - (stops - sizes), sizes) + np.arange(stops[-1] if len(stops) else 0)]
        cuts = np.concatenate([[0], stops])[np.cumsum([len(own) for own in pieces])]
        return np.split(ids, cuts[:-1])

