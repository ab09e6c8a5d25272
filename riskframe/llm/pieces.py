"""Cutting texts where byte-level BPE never merges across, with a bounded memory of what each part encodes to.

The pre-tokeniser of the byte-level vocabularies splits a text by ``PATTERN`` and merges inside the parts only. A
single space or newline between two visible characters always starts a part, so a text without two white-space
characters in a row may be cut there and its parts encoded alone; any other text is cut by the pattern itself.
Arrow does the cutting and finds the distinct parts of a slice, so Python meets each distinct part once a slice.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed value: the split pattern of the byte-level BPE vocabularies.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space at the ends or twice in a row, any other than space and newline, or the mark of whole parts.
_UNEVEN = (r"\A[ \n]|[ \n]\z|[ \n][ \n]|[\x01\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
           r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\A\z")
#: Bytes of remembered parts (twice: those met since the last turn, and before), of a slice, and parts encoded at once.
MEMO, SLICE, AT_ONCE = 24_000_000, 8_000_000, 10_000
#: By name: encoders that the tasks of one Python worker share, so that each doesn't start with an empty memory.
_SHARED: dict[str, Callable] = {}


def pieces(text: str, specials: list[str]) -> list[str]:
    """The pre-tokeniser's parts of a text; special tokens are parts of their own."""
    if not specials or not any(s in text for s in specials):
        return PATTERN.findall(text)
    out: list[str] = []
    for k, part in enumerate(re.split("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")", text)):
        out += [part] if k % 2 else PATTERN.findall(part)
    return out


def part_of(key: str) -> str:
    """The text that a key of ``cut`` stands for."""
    return key[1:] if key[:1] == "\x01" else key if key[:1] == "\n" else " " + key


def cut(texts: pa.Array, specials: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Keys of all parts of all texts in order, and the number of parts of each text.

    A key is what follows a space, or a newline and what follows, or \\x01 and a whole part.
    """
    uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
    plain = texts.filter(pa.array(~uneven))
    lists = pc.split_pattern(pc.binary_join_element_wise("\x01", pc.replace_substring(plain, "\n", " \n"), ""), " ")
    if not uneven.any():
        return lists.flatten(), np.diff(lists.offsets.to_numpy()).astype(np.int64)
    other = [["\x01" + p for p in pieces(t, specials)] for t in texts.filter(pa.array(uneven)).to_pylist()]
    n = np.zeros(len(texts), np.int64)
    n[~uneven], n[uneven] = np.diff(lists.offsets.to_numpy()), [len(x) for x in other]
    first = np.zeros(len(texts), np.int64)
    first[~uneven] = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
    own = len(flat := lists.flatten())
    first[uneven] = own + np.concatenate([[0], np.cumsum(n[uneven])[:-1]])
    both = pa.concat_arrays([flat, pa.array([p for x in other for p in x], flat.type)])
    return both.take(pa.array(spread(first, n))), n


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The indices first[i] .. first[i] + n[i] - 1 of every i, one after the other."""
    n = n.astype(np.int64)
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


class PartEncoder:
    """Encodes whole texts through ``encode(parts) -> list of little-endian uint32 bytes``.

    ``memo`` bounds the bytes of remembered parts: when so many are new, those not met since the last time are forgotten,
    which costs time but changes nothing.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], specials: list[str], memo: int = MEMO):
        self.encode, self.specials, self.limit, self.memo, self.older, self.held = encode, specials, memo, {}, {}, 0

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (uint32) and the number of ids of each."""
        keys, parts = cut(texts, self.specials)
        if not len(keys):
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        coded = keys.dictionary_encode()
        distinct, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if self.held > self.limit:
            self.memo, self.older, self.held = {}, self.memo, 0
        own = list(map(self.memo.get, distinct))
        missed = [i for i, v in enumerate(own) if v is None]
        if missed and self.older:
            for i in missed:
                if (known := self.older.get(distinct[i])) is not None:
                    own[i] = self.memo[distinct[i]] = known
                    self.held += 150 + len(distinct[i]) + len(known)          # 150: two objects and an entry in the dictionary
            missed = [i for i in missed if own[i] is None]
        for k in range(0, len(missed), AT_ONCE):
            some = missed[k:k + AT_ONCE]
            for i, v in zip(some, self.encode([part_of(distinct[i]) for i in some]), strict=True):
                own[i] = self.memo[distinct[i]] = v
                self.held += 150 + len(distinct[i]) + len(v)
        ids = np.frombuffer(b"".join(own), "<u4")
        n = np.fromiter(map(len, own), np.int64, len(own)) // 4
        first = np.cumsum(n) - n
        of_part = n[codes]
        ends = np.concatenate([[0], np.cumsum(of_part)])
        stops = np.cumsum(parts)
        return ids[spread(first[codes], of_part)], ends[stops] - ends[stops - parts]


def shared(name: str, make: Callable[[], Callable]) -> Callable:
    """The worker's encoder of that name; another name takes its place, so one memory is held at a time."""
    if name not in _SHARED:
        _SHARED.clear()
        _SHARED[name] = make()
    return _SHARED[name]


def slices(texts: pa.Array, chars: int = SLICE) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows): slices of about so many bytes, of one text at least."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + chars, "right")))
        yield at, texts.slice(at, stop - at)
        at = stop
