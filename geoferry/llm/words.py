"""Words of many texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are hashed in slices of about so many bytes.
SLICE_BYTES = 1 << 20


class WordHasher:
    """64-bit hashes of the words in UTF-8 bytes, with A-Z in lower case and without a loop over words.

    ``inside``: the bytes that words are made of. Equal words have equal hashes; the reverse holds up to chance.
    """

    def __init__(self, inside) -> None:
        letters = np.arange(256)
        lowered = np.where((letters >= 65) & (letters <= 90), letters + 32, letters)
        self.is_word = np.isin(letters, list(inside))
        self.of_letter = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)[lowered] | np.uint64(1)
        self.base = 0x9E3779B97F4A7C15
        self.powers = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) <= size:
            steps = np.full(max(size + 1, SLICE_BYTES), self.base, np.uint64)
            steps[0] = 1
            self.powers = np.cumprod(steps, dtype=np.uint64)
            inverse = np.full(len(steps), pow(self.base, -1, 1 << 64), np.uint64)
            inverse[0] = 1
            self.inverses = np.cumprod(inverse, dtype=np.uint64)

    def __call__(self, data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last byte (exclusive) and hash of each word; no word goes over a place in ``breaks``."""
        self._grow(len(data))
        inside = self.is_word[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = breaks[(breaks > 0) & (breaks < len(data))]
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.of_letter[data] * self.powers[: len(data)], out=total[1:])
        return first, last, (total[last] - total[first]) * self.inverses[first]

    def beginnings(self, data: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of words, which must be that long."""
        total = np.zeros(len(first), np.uint64)
        for place in range(size):
            total += self.of_letter[data[first + place]] * self.powers[place]
        return total

    def slices(self, data: np.ndarray, breaks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The same for long data, slice by slice, so that memory doesn't grow with the longest text."""
        at = 0
        while at < len(data):
            end = min(len(data), at + SLICE_BYTES)
            while end < len(data) and self.is_word[data[end]] and self.is_word[data[end - 1]]:
                end += 1  # not within a word
            first, last, hashes = self(data[at:end], breaks - at)
            yield first + at, last + at, hashes
            at = end


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the 64-bit value (a public finalizer's constants)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def text_arrays(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[np.ndarray, list[int]]]:
    """A column of texts as bytes and places where texts begin (and the last ends), in runs of about ``most`` bytes.

    Null is an empty text. Every row is in one run, in order.
    """
    texts = column.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield data[offsets[first] : offsets[last]], (offsets[first : last + 1] - offsets[first]).tolist()
        first = last
