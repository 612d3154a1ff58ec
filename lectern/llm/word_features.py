"""Hashed features of the words of many texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from lectern.llm.arrow import byte_codes, mix, row_groups, span_hashes, text_bytes

# Frequent function words.
FUNCTION_WORDS = {
    "en": "the of and to in a is that for it was on are as with his they at be this from have or by one had not but what all were",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si",
}
LANGUAGES = ["other", *FUNCTION_WORDS]


@dataclass
class Words:
    """The letter runs of some texts in lower case."""

    data: np.ndarray
    starts: np.ndarray
    first: np.ndarray
    last: np.ndarray
    row: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=len(self.starts) - 1)


def lowered(data: np.ndarray) -> np.ndarray:
    """A to Z and the capitals from À to Þ in lower case, byte by byte."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    out[after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
    return out


def letter_words(data: np.ndarray, starts: np.ndarray) -> Words:
    """Runs of ASCII letters and of bytes of other characters; none goes over a row's end."""
    low = lowered(data)
    letter = (low >= 97) & (low <= 122) | (low >= 0x80)
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begins = letter.copy()
    begins[1:] &= ~letter[:-1] | edge[1:-1]
    ends = letter.copy()
    ends[:-1] &= ~letter[1:] | edge[1:-1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = span_hashes(low, first, last, byte_codes())
    return Words(low, starts, first, last, np.searchsorted(starts, first, "right") - 1, hashes)


def prefix_hashes(words: Words, size: int) -> np.ndarray:
    """Hashes of the first ``size`` bytes of each word, apart from those of whole words."""
    return mix(span_hashes(words.data, words.first, np.minimum(words.last, words.first + size), byte_codes()) + np.uint64(size))


def word_hash(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(lowered(raw), np.array([0]), np.array([len(raw)]), byte_codes())[0])


def function_word_table(bits: int) -> np.ndarray:
    """For each hash bucket a bit for each language that has a function word there."""
    table = np.zeros(1 << bits, np.uint8)
    for k, words in enumerate(FUNCTION_WORDS.values()):
        for word in words.split():
            table[word_hash(word) >> (64 - bits)] |= 1 << k
    return table


def guessed_languages(words: Words, table: np.ndarray) -> np.ndarray:
    """For each text the number (in LANGUAGES) of the language with most function words; 0 without any."""
    bits = int(len(table)).bit_length() - 1
    marks = table[(words.hashes >> np.uint64(64 - bits)).astype(np.int64)]
    n = len(words.starts) - 1
    counts = np.stack([np.bincount(words.row, (marks >> k) & 1, n) for k in range(len(FUNCTION_WORDS))])
    return np.where(counts.max(axis=0) > 0, counts.argmax(axis=0) + 1, 0)


def text_blocks(column: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The texts of a column in blocks: first and last row, bytes, row starts."""
    data, starts = text_bytes(column)
    for lo, hi in row_groups(starts, most):
        yield lo, hi, data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo]
