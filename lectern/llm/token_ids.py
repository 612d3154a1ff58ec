"""Token ids of many texts at once.

The ids are those of the ``tokenizers`` file. Texts of plain letters, digits
and punctuation with single blanks are cut at their blanks; each different
piece of a block is encoded once, by the rank file of the same vocabulary.
Every other text goes through ``tokenizers`` itself, so both ways agree; so does
a text with a mark that the file adds to its vocabulary (``<|endoftext|>``),
which has an id of its own.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from lectern.llm.arrow import byte_codes, ragged, span_hashes, worker_cache

# Bytes of text that are encoded in one go, and pieces that a worker remembers.
BLOCK_BYTES = 1 << 22
MOST_PIECES = 600_000
# Pieces longer than this are not remembered.
LONG_PIECE = 64
SPACE, NEWLINE = 32, 10


@dataclass(frozen=True)
class Vocabulary:
    """Where executors find the tokenizer; ``ranks`` is None if there is no rank file of the same vocabulary."""

    path: str = public_tokenizers.path("byte_bpe_50k.json")
    ranks: str | None = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern: str = public_tokenizers.PATTERN


class Pieces:
    """A worker's encoders and the pieces it knows: sorted hashes, each with a range of ``flat``."""

    def __init__(self, vocabulary: Vocabulary):
        self.whole = Tokenizer.from_file(vocabulary.path)
        self.marks = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values() if t.content]
        self.ranks = None
        if vocabulary.ranks:
            with open(vocabulary.ranks, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
            self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
            for token, i in ranks.items():
                self.sizes[i] = len(token)
            self.newline = ranks[b"\n"]
        self.codes = byte_codes()
        self.forget()

    def forget(self):
        """Know the line break alone: it is the one piece that cannot be joined with others."""
        one = np.ones(1, np.int64)
        self.known = span_hashes(np.array([NEWLINE], np.uint8), one - 1, one, self.codes)
        self.first, self.count = one - 1, one
        self.flat = np.array([self.newline if self.ranks else 0], np.uint32)

    def learn(self, data: np.ndarray, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """Encode the given new pieces, joined so that none touches another."""
        bare = data[begin] != SPACE
        sizes = end - begin + bare
        cuts = np.cumsum(sizes)
        joined = np.full(int(cuts[-1]), NEWLINE, np.uint8)
        joined[ragged(cuts - sizes + bare, end - begin)] = data[ragged(begin, end - begin)]
        ids = self.ranks.encode_to_numpy(joined.tobytes().decode(), disallowed_special=())
        at = np.cumsum(self.sizes[ids])
        last = np.searchsorted(at, cuts) + 1
        first = np.concatenate([[0], last[:-1]]) + bare
        if not np.array_equal(at[last - 1], cuts) or (ids[first[bare] - 1] != self.newline).any():
            raise ValueError("pieces ran into each other")
        order = np.argsort(np.concatenate([self.known, hashes]))
        self.first = np.concatenate([self.first, first + len(self.flat)])[order]
        self.count = np.concatenate([self.count, last - first])[order]
        self.known = np.concatenate([self.known, hashes])[order]
        self.flat = np.concatenate([self.flat, ids])

    def plain(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which rows are of plain characters with single blanks, none at the end."""
        kind = np.zeros(256, bool)
        kind[:32] = kind[127] = kind[0xCA:] = True
        kind[NEWLINE] = kind[0xE2] = False
        odd = kind[data]
        following = lambda k: np.concatenate([data[k:], np.zeros(min(k, len(data)), np.uint8)])
        one, two = following(1), following(2)
        odd |= (data == 0xC2) & (one < 0xA1)
        odd |= (data == 0xE2) & ((one != 0x80) | (two < 0x90) | (two > 0xA7))
        blank = (data == SPACE) | (data == NEWLINE)
        odd[:-1] |= blank[:-1] & blank[1:]
        odd[starts[1:][np.diff(starts) > 0] - 1] |= blank[starts[1:][np.diff(starts) > 0] - 1]
        bad = np.concatenate([[0], np.cumsum(odd)])
        return (bad[starts[1:]] == bad[starts[:-1]]) & ~self.marked(data, starts)

    def marked(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which rows hold a mark."""
        found = np.zeros(len(starts) - 1, bool)
        raw = data.tobytes()
        for mark in self.marks:
            at = raw.find(mark)
            while at >= 0:
                row = int(np.searchsorted(starts, at, "right")) - 1
                inside = at + len(mark) <= starts[row + 1]
                found[row] |= inside
                # The rest of a marked row need not be looked through.
                at = raw.find(mark, int(starts[row + 1]) if inside else at + 1)
        return found

    def encode(self, data: np.ndarray, starts: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, ``end`` after each row's own unless it is None, and where each row's begin."""
        n = len(starts) - 1
        easy = self.plain(data, starts) if self.ranks and len(data) else np.zeros(n, bool)
        row_of = np.repeat(np.arange(n), np.diff(starts))
        blank = (data == SPACE) | (data == NEWLINE)
        cut = blank.copy()
        cut[1:] |= data[:-1] == NEWLINE
        cut[starts[:-1][np.diff(starts) > 0]] = True
        begin = np.flatnonzero(cut)
        stop = np.concatenate([begin[1:], [len(data)]]) if len(begin) else begin
        own = row_of[begin]
        easy[own[stop - begin > LONG_PIECE]] = False
        stay = easy[own]
        begin, stop, own = begin[stay], stop[stay], own[stay]
        counts = np.zeros(n, np.int64)
        ids = np.zeros(0, np.uint32)
        if len(begin):
            hashes = span_hashes(data, begin, stop, self.codes)
            each, where, back = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.known) + len(each) > MOST_PIECES:
                self.forget()
            at = np.searchsorted(self.known, each)
            new = self.known[np.minimum(at, len(self.known) - 1)] != each
            if new.any():
                self.learn(data, each[new], begin[where[new]], stop[where[new]])
                at = np.searchsorted(self.known, each)
            sizes = self.count[at][back]
            ids = self.flat[ragged(self.first[at][back], sizes)]
            counts = np.bincount(own, sizes, n).astype(np.int64)
        others = {}
        for k in np.flatnonzero(~easy):
            found = np.array(self.whole.encode(data[starts[k] : starts[k + 1]].tobytes().decode(), add_special_tokens=False).ids, np.uint32)
            others[k], counts[k] = found, len(found)
        more = int(end is not None)
        places = np.concatenate([[0], np.cumsum(counts + more)])
        out = np.full(int(places[-1]), end or 0, np.uint32)
        quick = np.flatnonzero(easy)
        out[ragged(places[quick], counts[quick])] = ids
        for k, found in others.items():
            out[places[k] : places[k] + len(found)] = found
        return out, places


def worker_pieces(vocabulary: Vocabulary) -> Pieces:
    """This worker's encoders for a vocabulary, read once."""
    cache = worker_cache()
    have = getattr(cache, "pieces", None)
    if have is None or have[0] != (vocabulary.path, vocabulary.ranks, vocabulary.pattern):
        have = cache.pieces = ((vocabulary.path, vocabulary.ranks, vocabulary.pattern), Pieces(vocabulary))
    return have[1]
