"""Exact byte-pair merges of many pre-tokens at a time: a step joins the pair of lowest rank in every unfinished one."""

from __future__ import annotations

import numpy as np

#: Bytes that are merged at once.
AT_ONCE = 400_000


class Merger:
    """``single``: the id of each byte; ``merge``: (left id, right id) to (rank, id of both)."""

    def __init__(self, single: list[int], merge: dict[tuple[int, int], tuple[int, int]]):
        self.single = np.array(single, np.int64)
        pairs = np.array([(a << 32 | b, rank, new) for (a, b), (rank, new) in merge.items()], np.int64).reshape(-1, 3)
        self.pair, self.rank, self.new = np.ascontiguousarray(pairs[np.argsort(pairs[:, 0])].T)
        self.never = np.int64(len(pairs) + 1)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``never`` for pairs without one) and its place in the table."""
        key = left << 32 | right
        if not len(self.pair):
            return np.full(len(key), self.never), np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.rank[at], self.never), at

    def counts(self, words: list[bytes]) -> np.ndarray:
        """How many tokens each pre-token (not empty) becomes."""
        out = np.zeros(len(words), np.int64)
        for some, word, _ in self._batches(words):
            out[some] = np.bincount(word, minlength=len(some))
        return out

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each pre-token (not empty) as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = [b""] * len(words)
        for some, word, token in self._batches(words):
            raw, ends = token.astype("<u4").tobytes(), 4 * np.cumsum(np.bincount(word, minlength=len(some)))
            for i, a, b in zip(some.tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                out[i] = raw[a:b]
        return out

    def _batches(self, words: list[bytes]):
        """(which words, word of each token, tokens in order); words of equal lengths go together, as they finish together."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        ends, at = np.cumsum(sizes[order]), 0
        while at < len(order):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
            some = order[at:stop]
            yield some, *self._merged(b"".join([words[i] for i in some]), sizes[some])
            at = stop

    def _merged(self, text: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        token = self.single[np.frombuffer(text, np.uint8)]
        word = np.repeat(np.arange(len(sizes)), sizes)
        done_tokens, done_words = [], []
        while len(token) > 1:
            rank, at = self.ranks(token[:-1], token[1:])
            rank[word[:-1] != word[1:]] = self.never
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))          # of each unfinished word
            least = np.minimum.reduceat(np.append(rank, self.never), first)
            n = np.diff(np.append(first, len(token)))
            done = np.repeat(least == self.never, n)
            if done.any():
                done_tokens.append(token[done])
                done_words.append(word[done])
            places = np.flatnonzero((rank == np.repeat(least, n)[:-1]) & (rank < self.never))
            if len(places):                                                                  # of a run like aaaa every second pair
                run = np.concatenate([[True], np.diff(places) > 1])
                places = places[(places - np.repeat(places[run], np.diff(np.append(np.flatnonzero(run), len(places))))) % 2 == 0]
                token[places] = self.new[at[places]]
            keep = ~done
            keep[places + 1] = False
            token, word = token[keep], word[keep]
        token, word = np.concatenate([*done_tokens, token]), np.concatenate([*done_words, word])
        order = np.argsort(word, kind="stable")
        return word[order], token[order]
