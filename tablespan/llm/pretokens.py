"""Token ids of many texts at once, equal to those of the byte-level BPE file of 50,257 ids.

Texts are cut into pretokens with numpy over code points; only the distinct pretokens of a block that
this process has not met go through the BPE merges. A text that names the special token is encoded by
the library as a whole.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
from functools import cache

import numpy as np

from tablespan.llm.words import SpanHashes, mixed

#: Fixed values of the vocabulary.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: The code points with the property White_Space.
WHITE_SPACE = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
KNOWN_PRETOKENS = 200_000  # a process keeps so many, then starts anew


@cache
def _classes(upto: int) -> np.ndarray:
    kinds = np.full(upto, OTHER, dtype=np.int8)
    for c in range(upto):
        major = unicodedata.category(chr(c))[0]
        if major == "L":
            kinds[c] = LETTER
        elif major == "N":
            kinds[c] = NUMBER
    kinds[[c for c in WHITE_SPACE if c < upto]] = SPACE
    return kinds


def classes(points: np.ndarray) -> np.ndarray:
    top = int(points.max(initial=0)) + 1
    return _classes(0x500 if top <= 0x500 else 0x10000 if top <= 0x10000 else sys.maxunicode + 1)[points]


def pretoken_starts(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where pretokens start; they tile the texts, which start at `begins` and follow without a gap.

    A pretoken is a contraction's end, or one class of letters, digits or other signs with one blank
    before it if there is one, or white space without the last sign before a following word.
    """
    n = len(points)
    kind = classes(points)
    text_start = np.zeros(n + 1, dtype=bool)
    text_start[begins] = True
    text_start[n] = True
    run = text_start[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    run[0] = True
    starts = run.copy()
    runs = np.flatnonzero(run)
    after = np.append(runs[1:], n)
    white = kind[runs] == SPACE
    # White space before a word of the same text gives its last sign up: to the word if it is a blank.
    gives = white & ~text_start[after]
    last = after[gives] - 1
    starts[last] = True
    starts[last[points[last] == 0x20] + 1] = False
    # A lone apostrophe that nothing joins from the left takes its contraction from the letters.
    lone = runs[(points[runs] == 0x27) & (after - runs == 1) & ~text_start[after] & starts[runs]]
    for at in lone.tolist():
        if kind[at + 1] != LETTER:
            continue
        for tail in CONTRACTIONS:
            end = at + 1 + len(tail)
            if end <= n and not text_start[at + 2 : end].any() and "".join(map(chr, points[at + 1 : end])) == tail:
                starts[at + 1] = False
                if end < n:
                    starts[end] = starts[end] or kind[end] == LETTER
                break
    return np.flatnonzero(starts)


def distinct_values(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values, one place of each, and for each value its number among them."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(values), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], order[new], place


class Encoder:
    """Token ids of texts by the vocabulary of ranks in a file."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.library = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})
        self.token_bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        self.token_bytes[list(ranks.values())] = [len(word) for word in ranks]
        self.known: dict[int, bytes] = {}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin, with the end."""
        whole = [SPECIAL in text for text in texts]
        plain = ["" if odd else text for text, odd in zip(texts, whole, strict=True)]
        ids, bounds = self._plain(plain)
        if not any(whole):
            return ids, bounds
        parts = [
            np.array(self.library.encode(text, allowed_special="all"), dtype=np.uint32) if odd else ids[bounds[i] : bounds[i + 1]]
            for i, (text, odd) in enumerate(zip(texts, whole, strict=True))
        ]
        return np.concatenate(parts), np.append(0, np.cumsum([len(x) for x in parts]))

    def _merged(self, pieces: list[str]) -> list[bytes]:
        """The ids of each pretoken. Words that begin with a blank stay apart when joined: one call does them all."""
        apart = [i for i, piece in enumerate(pieces) if piece[0] == " " and piece[1:].isalpha()]
        together = np.array(self.library.encode_ordinary("".join(pieces[i] for i in apart)), dtype="<u4")
        ends = np.cumsum(self.token_bytes[together])
        cuts = np.searchsorted(ends, np.cumsum([len(pieces[i].encode()) for i in apart]), side="left") + 1
        out: list[bytes] = [b""] * len(pieces)
        for i, a, b in zip(apart, [0, *cuts.tolist()], cuts.tolist(), strict=False):
            out[i] = together[a:b].tobytes()
        for i, ids in enumerate(out):
            if not ids:
                out[i] = np.array(self.library.encode_ordinary(pieces[i]), dtype="<u4").tobytes()
        return out

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        lengths = np.array([len(x) for x in texts], dtype=np.int64)
        if not joined:
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts) + 1, dtype=np.int64)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        begins = (np.cumsum(lengths) - lengths)[lengths > 0]
        starts = pretoken_starts(points, begins)
        ends = np.append(starts[1:], len(points))
        hashes = SpanHashes(mixed(points.astype(np.uint64) + np.uint64(1))).of(starts, ends)
        distinct, first, place = distinct_values(hashes)
        if len(self.known) > KNOWN_PRETOKENS:
            self.known.clear()
        pieces = list(map(self.known.get, distinct.tolist()))
        missing = [i for i, ids in enumerate(pieces) if ids is None]
        if missing:
            at = first[missing]
            found = self._merged([joined[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            for i, key, ids in zip(missing, distinct[missing].tolist(), found, strict=True):
                pieces[i] = self.known[key] = ids
        sizes = np.array(list(map(len, pieces)), dtype=np.int64) // 4
        flat = np.frombuffer(b"".join(pieces), dtype="<u4")
        offsets = np.cumsum(sizes) - sizes
        counts = sizes[place]
        stops = np.cumsum(counts)
        at = np.repeat(offsets[place] - (stops - counts), counts) + np.arange(stops[-1])
        before = np.append(0, stops)
        bounds = before[np.searchsorted(starts, np.append(np.cumsum(lengths) - lengths, len(points)))]
        return flat[at], bounds


@cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)
